"""Semi-structured columns: parse, path access, runtime type, arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The plain name reported for each runtime type of a VARIANT.
TYPE_NAMES = {
    "ARRAY": "ARRAY",
    "BIGINT": "INTEGER",
    "BINARY": "BINARY",
    "BOOLEAN": "BOOLEAN",
    "DATE": "DATE",
    "DECIMAL": "DECIMAL",
    "DOUBLE": "DOUBLE",
    "FLOAT": "DOUBLE",
    "OBJECT": "OBJECT",
    "STRING": "VARCHAR",
    "TIMESTAMP": "TIMESTAMP_LTZ",
    "TIMESTAMP_NTZ": "TIMESTAMP_NTZ",
    "VOID": "NULL_VALUE",
}


def parse(text: Column) -> Column:
    """JSON text as VARIANT; text that is not JSON gives NULL."""
    return F.try_parse_json(text)


def _path(key: str) -> str:
    if "'" in key:
        raise ValueError(f"a quote cannot appear in a variant key: {key!r}")
    return f"$['{key}']"


def field(value: Column, key: str) -> Column:
    """The member ``key`` as VARIANT, NULL when it is missing. Keys are case-sensitive."""
    return F.try_variant_get(value, _path(key), "variant")


def field_as(value: Column, key: str, data_type: str) -> Column:
    """The member ``key`` as ``data_type``, NULL when it is missing or does not convert."""
    return F.try_variant_get(value, _path(key), data_type)


def type_name(value: Column) -> Column:
    """The runtime type of a VARIANT. A fixed-point number without fraction is an INTEGER.

    A type that has no plain name goes by its own.
    """
    described = F.schema_of_variant(value)  # such as BIGINT, DECIMAL(3,1) or OBJECT<k: BIGINT>
    family = F.substring_index(F.substring_index(described, "<", 1), "(", 1)
    names = F.create_map(*[F.lit(text) for pair in TYPE_NAMES.items() for text in pair])
    whole = (family == "DECIMAL") & described.endswith(",0)")
    return F.when(whole, F.lit("INTEGER")).otherwise(
        F.coalesce(F.try_element_at(names, family), family)
    )


def as_number(value: Column, data_type: str = "decimal(38,4)") -> Column:
    """A numeric VARIANT as fixed-point number, ready for arithmetic; anything else fails."""
    return F.variant_get(value, "$", data_type)
