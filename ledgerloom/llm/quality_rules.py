"""Quality rules: a threshold table compiled into one projection over the text.

``RULES`` lists measures and the bounds between which a text is kept. ``measured`` adds every
measure as a column of native expressions; ``kept`` turns the table into one boolean expression.

Defined results: a null or blank text has no word and is rejected; repeated rows are measured one
by one. The bound on stop words binds only where the list can speak: for a text labelled with one of its
languages, and for one without a label unless at least half of its visible characters are letters of
another script than Latin, which all languages of the list share. Other columns are not looked at, and their names may be anything.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

BLANK = r"[\x20\x09-\x0D]"
SYMBOL = "[#*$%&|<>]"
WORD_END = r"[\x20\x09-\x0D.,;:!?]+"
# A letter that is not Latin.
OTHER_LETTER = r"[^\P{L}\p{IsLatin}]"
WINDOW = 3

# Frequent function words of English, German, French, Spanish, Italian and Portuguese.
STOP_WORDS = (
    "a an and are as at be but by for from had has he in is it not of on or she that the they this "
    "to was were which with you "
    "als auch auf aus bei das dem den der des die ein eine er es für ich im ist mit nicht sich sie "
    "um und von zu "
    "au aux avec ce dans de des du elle en est et il la le les mais ne par pas pour qui que sur un "
    "une "
    "al como con del el es la las lo los no para pero por que se su una uno y "
    "che di e gli i non per sono da dos em não o os uma"
).split()

# The languages of the list. In others its words do not occur, so their measure says nothing.
STOP_WORD_LANGUAGES = ("en", "de", "fr", "es", "it", "pt")


@dataclass(frozen=True)
class Rule:
    """A measure of ``MEASURES`` must lie between ``low`` and ``high``, both included."""

    measure: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("n_words", low=50),
    Rule("mean_word_chars", low=2, high=12),
    Rule("symbols_per_word", high=0.1),
    Rule("stop_word_ratio", low=0.02),
    Rule("upper_ratio", high=0.5),
    Rule("dup_line_ratio", high=0.5),
)


def _ratio(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole)), F.lit(0.0))


MEASURES = {
    "n_words": lambda: F.col("n_words"),
    "mean_word_chars": lambda: _ratio("word_chars", "n_words"),
    "symbols_per_word": lambda: _ratio("n_symbols", "n_words"),
    "stop_word_ratio": lambda: _ratio("n_stop_words", "n_words"),
    "upper_ratio": lambda: _ratio("n_upper", "word_chars"),
    "dup_line_ratio": lambda: _ratio("n_dup_lines", "n_lines"),
}


def measured(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = None
) -> DataFrame:
    """Per row its id, the counts that rules refer to and, of a language, ``listed``. Nothing is shuffled.

    Windows of three words are compared by their 64-bit hashes within one text.
    """
    speaks = F.lit(None).cast("boolean") if lang_col is None else listed(F.col(lang_col))
    text = docs.select(
        F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("t"), speaks.alias("listed")
    )
    split = text.select(
        "id",
        "t",
        "listed",
        F.array_remove(F.split("t", BLANK + "+"), "").alias("words"),
        F.filter(F.split("t", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    hashed = split.select(
        "id",
        "listed",
        F.size("words").cast("long").alias("n_words"),
        (F.char_length("t") - F.regexp_count("t", F.lit(BLANK))).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter(F.split(F.lower("t"), WORD_END), lambda word: word.isin(STOP_WORDS)))
        .cast("long")
        .alias("n_stop_words"),
        F.regexp_count("t", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("t", F.lit(OTHER_LETTER)).cast("long").alias("n_other_letters"),
        F.transform(
            F.slice("words", F.lit(1), F.greatest(F.size("words") - (WINDOW - 1), F.lit(0))),
            lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)),
        ).alias("windows"),
    )
    same = F.size(F.array_distinct("windows")) == F.size("windows")
    ordered = hashed.withColumn(
        "windows",
        F.when(
            ~same,
            F.sort_array(
                F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
            ),
        ),
    )
    repeated = ordered.withColumn(
        "windows",
        F.sort_array(
            F.transform(
                F.filter(
                    "windows",
                    lambda w, i: (w["h"] == F.get("windows", i + 1)["h"])
                    | ((i > 0) & (w["h"] == F.get("windows", F.greatest(i - 1, F.lit(0)))["h"])),
                ),
                lambda w: w["i"],
            )
        ),
    )
    covered = F.aggregate(
        F.transform(
            "windows",
            lambda at, i: F.coalesce(F.least(F.get("windows", i + 1) - at, F.lit(WINDOW)), F.lit(WINDOW)),
        ),
        F.lit(0),
        lambda total, step: total + step,
    )
    return repeated.withColumn(
        "n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")
    ).select(
        F.col("id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        "n_repeat_words",
        "n_stop_words",
        "n_upper",
        "n_other_letters",
        *([] if lang_col is None else ["listed"]),
    )


def base_failed() -> Column:
    """Fewer than 50 words, or more than half of the words in repeated three-word windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def listed(lang: Column) -> Column:
    """Whether the label names a language of the stop words; NULL where there is no label."""
    main = F.lower(F.substring_index(F.regexp_replace(F.trim(lang), "_", "-"), "-", 1))
    return F.when(~main.isin("", "und"), main.isin(*STOP_WORD_LANGUAGES))


def compiled(rules: Iterable[Rule] = RULES, speaks: Column | None = None) -> Column:
    """The threshold table as one boolean expression over the columns of ``measured``.

    Least shares of stop words bind where ``speaks`` holds, or everywhere without it.
    """
    bounds = []
    for rule in rules:
        value = MEASURES[rule.measure]()
        if rule.low is not None:
            bound = value >= rule.low
            bounds.append(bound if speaks is None or rule.measure != "stop_word_ratio" else bound | ~speaks)
        if rule.high is not None:
            bounds.append(value <= rule.high)
    return reduce(Column.__and__, bounds, F.lit(True))


def quality(
    docs: DataFrame,
    rules: Iterable[Rule] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = None,
) -> DataFrame:
    """Per row its id, its measures, ``base_failed`` and ``kept``."""
    # The partition number is never negative. It keeps a later filter from being moved below the
    # measures, where every array would be built anew at each place that names it.
    fence = F.spark_partition_id() >= 0
    # Without a label the script decides: in another than Latin the words of the list cannot occur.
    speaks = 2 * F.col("n_other_letters") < F.col("word_chars")
    if lang_col is not None:
        speaks = F.coalesce("listed", speaks)
    return (
        measured(docs, id_col, text_col, lang_col)
        .withColumn("base_failed", base_failed())
        .withColumn("kept", fence & ~F.col("base_failed") & compiled(rules, speaks))
    )


def passing(
    docs: DataFrame, rules: Iterable[Rule] = RULES, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """The rows that the rules keep, with the columns they came with; ``lang_col`` is used if there."""
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    lang = f"row.{lang_col}" if lang_col in docs.columns else None
    judged = quality(whole, rules, "row", f"row.{text_col}", lang)
    return judged.filter("kept").select("row.*")
