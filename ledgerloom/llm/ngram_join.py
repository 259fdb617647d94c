"""Similarity join of documents on the Jaccard index of their word n-gram sets, by MinHash bands.

Texts with equal n-gram sets form one class of copies, which joins as one. Classes whose signatures
agree in a band meet in the bucket of that band, in blocks of bounded size, and their full n-gram
sets are compared there. A pair is compared in the first band that it shares, so that links can be
counted without a list of pairs: a block gives each of its members a number of links and the least
member it hangs together with, so the rows grow with the members and never with the pairs.

Defined results: words are folded to lower case. A text of fewer words than an n-gram is one n-gram.
A null or blank text has none: it has no link and is a class of its own. Repeated rows are copies.
A row without an id can be a copy of others; a class in which no row has an id has a null id.
Extra columns are not looked at. An empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.components import components
from ledgerloom.llm.runs import runs
from ledgerloom.llm.rowkeys import wide_key
from ledgerloom.llm.stored import stored
from ledgerloom.llm.wordhash import Words, mixed, multipliers, pieces, texts_of

WORDS, THRESHOLD, RECALL, MOST_HASHES = 5, 0.8, 0.99999, 100
BLOCK_ROWS, BLOCK_GRAMS = 1024, 1 << 22
COLUMNS_AT_ONCE = 4096
_U = np.uint64


def banding(
    threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES
) -> tuple[int, int]:
    """Bands and rows per band that find a pair at the threshold with at least this probability.

    The most selective choice that ``most`` hashes allow; a pair above the threshold is found more
    surely still.
    """
    best = None
    for rows in range(1, most + 1):
        bands = max(1, math.ceil(math.log1p(-recall) / math.log1p(-(threshold**rows))))
        if bands * rows <= most:
            best = bands, rows
    if best is None:
        raise ValueError("no banding with so few hashes reaches this recall")
    return best


def _sets(words: Words, size: int) -> Iterator[np.ndarray]:
    grams, first = words.grams(size)
    for low, high in zip(first[:-1], first[1:]):
        yield np.unique(grams[low:high])


def _copy_keys(sets: list[np.ndarray]) -> list[bytes | None]:
    """128 bits that depend on the set alone."""
    out = []
    for grams in sets:
        if not len(grams):
            out.append(None)
            continue
        one = int(np.add.reduce(mixed(grams)))
        two = int(np.add.reduce(mixed(grams ^ _U(0x5851F42D4C957F2D))))
        out.append(one.to_bytes(8, "big") + two.to_bytes(8, "big"))
    return out


def _band_keys(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per non-empty set and band."""
    flat = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1])).astype(np.int64)
    offsets, factors = multipliers(bands * rows, 11), multipliers(bands * rows, 13)
    salt, weights = multipliers(bands, 17), multipliers(rows, 19)
    out = np.empty((len(sets), bands), dtype=_U)
    for band in range(bands):
        total = np.full(len(sets), salt[band], dtype=_U)
        for row in range(rows):
            at = band * rows + row
            total += mixed(np.minimum.reduceat((flat ^ offsets[at]) * factors[at], starts)) * weights[row]
        out[:, band] = mixed(total)
    return out


def _row_id(id_col: str, text_col: str):
    return wide_key(F.col(id_col), F.col(text_col))


def signatures(
    docs: DataFrame, words: int, bands: int, rows: int, id_col: str, text_col: str
) -> DataFrame:
    """Per row its id, a hash of the row, the key of its n-gram set, the set's size, band keys."""
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    schema = f"id {kind}, rid binary, copy binary, grams bigint, bands array<bigint>"

    def sign(batches):
        for batch in pieces(batches):
            sets = list(_sets(Words(texts_of(batch)), words))
            full = [s for s in sets if len(s)]
            keys = iter(_band_keys(full, bands, rows).view(np.int64).tolist() if full else ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(_copy_keys(sets), pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ],
                ["id", "rid", "copy", "grams", "bands"],
            )

    return docs.select(
        F.col(id_col).alias("id"), _row_id(id_col, text_col).alias("rid"), F.col(text_col).alias("text")
    ).mapInArrow(sign, schema)


def _gram_sets(texts: DataFrame, words: int) -> DataFrame:
    def sets(batches):
        for batch in pieces(batches):
            found = list(_sets(Words(texts_of(batch)), words))
            yield pa.RecordBatch.from_arrays(
                [pa.array(_copy_keys(found), pa.binary()), pa.array([s.tobytes() for s in found], pa.binary())],
                ["copy", "set"],
            )

    return texts.select("text").mapInArrow(sets, "copy binary, set binary").groupBy("copy").agg(
        F.first("set").alias("set")
    )


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The number of common n-grams of each left and right set."""
    if len(left) == len(right) == 1:
        return np.array([[len(np.intersect1d(left[0], right[0], assume_unique=True))]])
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    flat = np.concatenate(left + right)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in left + right])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate(([True], flat[1:] != flat[:-1]))
    column = np.cumsum(new) - 1
    both = np.zeros(column[-1] + 1, dtype=bool)
    both[np.intersect1d(column[owner < len(left)], column[owner >= len(left)])] = True
    keep = both[column]
    owner, column = owner[keep], (np.cumsum(both) - 1)[column[keep]]
    width = int(both.sum())
    for low in range(0, width, COLUMNS_AT_ONCE):
        a, b = np.searchsorted(column, (low, low + COLUMNS_AT_ONCE))
        table = np.zeros((len(left) + len(right), min(COLUMNS_AT_ONCE, width - low)), dtype=np.float32)
        table[owner[a:b], column[a:b] - low] = 1
        out += table[: len(left)] @ table[len(left) :].T
    return out


def _compare(threshold: float):
    def links(sets, bands, band, left, right):
        """Pairs of positions, one of each side, that are similar and share no earlier band."""
        one, two = bands[left], bands[right]
        fresh = np.ones((len(left), len(right)), dtype=bool)
        for at in range(band):
            fresh &= one[:, at, None] != two[None, :, at]
        if left is right:
            fresh &= np.triu(np.ones_like(fresh), 1)
        size = np.array([len(s) for s in sets], dtype=np.float64)
        ratio = np.minimum.outer(size[left], size[right]) / np.maximum.outer(size[left], size[right])
        fresh &= ratio >= threshold - 1e-9
        if not fresh.any():
            return np.empty((0, 2), dtype=np.int64)
        rows, columns = np.flatnonzero(fresh.any(1)), np.flatnonzero(fresh.any(0))
        common = _shared([sets[left[i]] for i in rows], [sets[right[j]] for j in columns])
        union = np.add.outer(size[left[rows]], size[right[columns]]) - common
        linked = fresh[np.ix_(rows, columns)] & (common >= threshold * union - 1e-6)
        i, j = np.nonzero(linked)
        return np.stack((left[rows[i]], right[columns[j]]), 1)

    def compare(batches):
        for group in runs(batches, ["key", "low", "high"]):
            copies = group["copy"].to_pylist()
            sets = [np.frombuffer(s, dtype=_U) for s in group["set"].to_pylist()]
            count = group["copies"].to_numpy()
            bands = np.array(group["bands"].to_pylist(), dtype=np.int64)
            band, low, high = (group[name][0].as_py() for name in ("band", "low", "high"))
            block = group["block"].to_numpy()
            left = np.flatnonzero(block == low)
            right = left if low == high else np.flatnonzero(block == high)
            found = links(sets, bands, band, left, right)
            if not len(found):
                continue
            total = np.zeros(len(copies), dtype=np.int64)
            np.add.at(total, found[:, 0], count[found[:, 1]])
            np.add.at(total, found[:, 1], count[found[:, 0]])
            touched = np.flatnonzero(total)
            # Members in the order of their keys, so that the root of a tree is its least key.
            order = np.array(sorted(range(len(copies)), key=copies.__getitem__))
            rank = np.argsort(order)
            place, i, j = np.arange(len(copies)), rank[found[:, 0]], rank[found[:, 1]]
            while True:
                least = place.copy()
                np.minimum.at(least, i, place[j])
                np.minimum.at(least, j, place[i])
                least = least[least]
                if (least == place).all():
                    break
                place = least
            roots = order[place[rank]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([copies[i] for i in touched], pa.binary()),
                    pa.array(total[touched], pa.int64()),
                    pa.array([copies[roots[i]] for i in touched], pa.binary()),
                ],
                ["copy", "links", "root"],
            )

    return compare


def _classes(docs: DataFrame, words, threshold, recall, id_col, text_col):
    """The signatures, and per class of copies its first id, size, links and component."""
    bands, rows = banding(threshold, recall)
    signed = stored(signatures(docs, words, bands, rows, id_col, text_col), "join-signed")
    copies = stored(
        signed.filter(F.col("copy").isNotNull())
        .groupBy("copy", "grams", "bands")
        .agg(
            F.min("id").alias("first_id"),
            F.count("*").alias("copies"),
            F.coalesce(F.min_by("rid", "id"), F.min("rid")).alias("rid"),
        ),
        "join-copies",
    )
    met = copies.select("copy", "grams", F.posexplode("bands").alias("band", "key"))
    buckets = (
        met.groupBy("key", "band")
        .agg(F.count("*").alias("n"), F.sum("grams").alias("grams"), F.bit_xor(F.xxhash64("copy")).alias("who"))
        .filter("n > 1")
        # Buckets with the same members hold the same pairs: the earliest band has them all.
        .groupBy("who", "n", "grams")
        .agg(F.min_by("key", "band").alias("key"))
        .withColumn(
            "blocks",
            F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("grams") / BLOCK_GRAMS)),
        )
        .select("key", "blocks")
    )
    members = stored(met.select("copy", "band", "key").join(buckets, "key"), "join-members")
    touched = members.select("copy").distinct().join(copies, "copy").select("rid")
    texts = docs.select(
        _row_id(id_col, text_col).alias("rid"), F.col(text_col).alias("text")
    ).join(touched, "rid", "left_semi")
    sets = stored(_gram_sets(texts, words), "join-sets")
    block = F.pmod(F.xxhash64("copy", "key"), F.col("blocks"))
    work = (
        members.withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            "copy",
            "key",
            "band",
            "block",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
        )
        .join(copies.select("copy", "copies", "bands"), "copy")
        .join(sets, "copy")
        .repartition("key", "low", "high")
        .sortWithinPartitions("key", "low", "high")
    )
    linked = stored(
        work.mapInArrow(_compare(threshold), "copy binary, links bigint, root binary"), "join-linked"
    )
    links = linked.groupBy("copy").agg(F.sum("links").alias("links"))
    roots = components(linked.select(F.col("copy").alias("u"), F.col("root").alias("v")))
    classes = (
        copies.select("copy", "first_id", "copies", "rid")
        .join(links, "copy", "left")
        .join(roots.withColumnRenamed("node", "copy"), "copy", "left")
        .withColumn("root", F.coalesce("root", "copy"))
    )
    return signed, stored(classes, "join-classes")


def similar_documents(
    docs: DataFrame,
    words: int = WORDS,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row its id, ``class_id``, ``copy_id`` and ``n_links``.

    ``n_links`` counts the other rows with a similarity of at least ``threshold``, copies included.
    ``class_id`` is the least id that a row hangs together with by links, ``copy_id`` the least id
    with the same n-gram set.
    """
    signed, classes = _classes(docs, words, threshold, recall, id_col, text_col)
    least = classes.groupBy("root").agg(F.min("first_id").alias("class_id"))
    named = classes.join(least, "root").select(
        "copy",
        "class_id",
        F.col("first_id").alias("copy_id"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    return signed.select("id", "copy").join(named, "copy", "left").select(
        F.col("id").alias(id_col),
        F.when(F.col("copy").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("copy").isNull(), F.col("id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )


def one_of_each(
    docs: DataFrame,
    words: int = WORDS,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` with one row, that of the least id, for all that hang together.

    Rows without words stay. The columns are those of ``docs``.
    """
    signed, classes = _classes(docs, words, threshold, recall, id_col, text_col)
    stays = (
        classes.groupBy("root")
        .agg(F.coalesce(F.min_by("rid", "first_id"), F.min("rid")).alias("rid"))
        .select("rid")
        .unionByName(signed.filter(F.col("copy").isNull()).select("rid"))
        .distinct()
    )
    repeated = signed.filter(F.col("copy").isNotNull()).groupBy("rid").agg(F.count("*").alias("rows")).filter("rows > 1")
    flagged = stored(
        stays.join(repeated, "rid", "left").select("rid", F.col("rows").isNotNull().alias("repeated")),
        "join-stays",
    )
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), _row_id(id_col, text_col).alias("rid")
    ).join(flagged, "rid")
    single = rows.filter("not repeated").select("row")
    more = rows.filter("repeated").dropDuplicates(["rid"]).select("row")
    return single.unionByName(more).select("row.*")
