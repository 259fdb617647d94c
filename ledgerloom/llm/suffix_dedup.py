"""Repeated byte strings, found by suffix order over shards that hold all equal strings together.

A byte is repeated if a string of ``reach`` bytes that covers it also starts anywhere else, in the same
text or another one. Texts are taken as UTF-8 bytes and matches never cross them.

1. Equal texts become one text with a weight.
2. Every window of ``reach`` bytes is dealt by its anchor, the least hash of the shorter strings in it;
   equal windows have equal anchors. Neighbouring windows with one anchor travel as one stretch of
   bytes, and only where the anchor occurs twice or more. Equal stretches become one with a weight.
3. A group of more than ``HOT`` different stretches is dealt again by longer anchors, at last by the
   whole window, so that a passage in a third of all documents lands in no single task.
4. Each task sorts the suffixes of its stretches, shard after shard (``induced_sort``). A window is
   repeated if its stretch has a weight above one or a neighbour in suffix order shares ``reach`` bytes.
   A group in which every stretch has a weight above one is decided by that, and is not sorted.

Hashes only deal windows out; equality is decided in suffix order. Equal texts and stretches are known
by 128 bits.

Defined results: null and empty texts have no bytes; texts shorter than ``reach`` lose nothing; rows
with equal texts, or null or repeated ids, each keep a row; an empty table gives no rows; other columns
are not looked at. A text of any length is cut into anchors in pieces of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm import induced_sort
from ledgerloom.llm.stored import stored
from ledgerloom.llm.wordhash import mixed, multipliers, pieces
from ledgerloom.operators.joins import join_totals
from ledgerloom.session import scratch_path

REACH = 400
# Lengths of the anchors' strings, as parts of ``reach``: the first for all, the others for hot groups.
# Each step leaves stretches of about a third of the windows, so that few are dealt one by one at last.
SHARES = (0.24, 0.6, 0.85, 0.95, 0.985, 1.0)
HOT = 1024
SHARD_BYTES = 3 << 20
TASK_BYTES = 32 << 20
AT_ONCE = 1 << 18
_U = np.uint64


def gram_hashes(data: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A hash of the ``size`` bytes from each place on."""
    if len(data) < size:
        return np.zeros(0, dtype=_U)
    factors = multipliers(64, 11 + seed)
    out, width, step = data.astype(_U) + _U(1), 1, 0
    while 2 * width <= size:
        out = out[:-width] * factors[step] + out[width:]
        width, step = 2 * width, step + 1
    if width < size:
        out = out[: len(out) - (size - width)] * factors[step] + out[size - width :]
    return mixed(out ^ factors[63])


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values."""
    count, span = len(values) - width + 1, 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[:count], values[width - span : width - span + count])


def stretches(data: np.ndarray, first: np.ndarray, reach: int, size: int, seed: int):
    """Runs of windows with one anchor: text number, first window, window after the last, anchor, and
    how often the anchor occurs in the run.

    Text i has the bytes ``first[i]`` up to ``first[i + 1]``; windows are places in ``data``.
    """
    width = reach - size + 1
    for low in range(0, max(len(data) - reach + 1, 0), AT_ONCE):
        some = data[low : low + AT_ONCE + reach - 1]
        hashes = gram_hashes(some, size, seed)
        anchors = least_of(hashes, width)
        at = np.arange(low, low + len(anchors))
        text = np.searchsorted(first, at, "right") - 1
        inside = at + reach <= first[text + 1]
        new = np.ones(len(at), dtype=np.bool_)
        new[1:] = (anchors[1:] != anchors[:-1]) | (text[1:] != text[:-1]) | (inside[1:] != inside[:-1])
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(at))
        kept = inside[begin]
        begin, end = begin[kept], end[kept]
        # Repetitive text has one anchor over long runs; no stretch has more than ``reach`` windows.
        parts = -(-(end - begin) // reach)
        step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        begin, end = np.repeat(begin, parts) + step * reach, np.repeat(end, parts)
        end = np.minimum(end, begin + reach)
        times = _occurrences(hashes, anchors[begin], begin, end + width - 1)
        yield text[begin], at[begin], end + low, anchors[begin], times


def _occurrences(values: np.ndarray, wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """How often each wanted value is among ``values[low:high]``."""
    known = np.unique(wanted)
    if not len(known):
        return np.zeros(0, dtype=np.int64)
    # Most values are told apart from the wanted ones by their last bits.
    maybe = np.zeros(1 << 16, dtype=np.bool_)
    maybe[(known & _U(0xFFFF)).astype(np.int64)] = True
    places = np.flatnonzero(maybe[(values & _U(0xFFFF)).astype(np.int64)])
    rank = np.minimum(np.searchsorted(known, values[places]), len(known) - 1)
    equal = known[rank] == values[places]
    keys = np.sort(rank[equal] * len(values) + places[equal])
    base = np.searchsorted(known, wanted) * len(values)
    return np.searchsorted(keys, base + high) - np.searchsorted(keys, base + low)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column, one value after another, and where each value begins."""
    column = column.cast(pa.large_binary())
    sizes = pa.compute.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


def _keys(column: str) -> list:
    return [F.xxhash64(F.lit(seed), F.col(column)) for seed in (1, 2)]


def texts_of(rows: DataFrame) -> DataFrame:
    """Different texts (``bytes``) with their keys and numbers of rows, stored in buckets by key."""
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "texts")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = "suffix_" + path.rsplit("-", 1)[1]
    different = rows.groupBy("k1", "k2").agg(F.count("*").alias("copies"), F.first("bytes").alias("bytes"))
    writer = different.write.option("path", path).option("compression", "zstd")
    writer.bucketBy(width, "k1", "k2").saveAsTable(name)
    return spark.table(name)


def _anchored(texts: DataFrame, reach: int, level: int, carried: list[str]) -> DataFrame:
    """Each stretch of each text: the carried columns, ``low, high`` and ``group``."""
    size = max(1, round(reach * SHARES[level]))
    kinds = dict(texts.select(*carried).dtypes)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "bytes"):
            data, first = _bytes_of(batch.column(batch.schema.get_field_index("bytes")))
            for text, low, high, anchor, times in stretches(data, first, reach, size, level):
                columns = [batch.column(batch.schema.get_field_index(c)).take(pa.array(text)) for c in carried]
                yield pa.RecordBatch.from_arrays(
                    [
                        *columns,
                        pa.array(low - first[text], pa.int32()),
                        pa.array(high - first[text], pa.int32()),
                        pa.array(anchor.view(np.int64), pa.int64()),
                        pa.array(times, pa.int64()),
                    ],
                    [*carried, "low", "high", "anchor", "times"],
                )

    schema = ", ".join(f"{c} {kinds[c]}" for c in carried) + ", low int, high int, anchor long, times long"
    return texts.select(*carried, "bytes").mapInArrow(cut, schema)


def _cut(reach: int):
    """The bytes that the windows of a stretch cover."""
    return F.substring("bytes", F.col("low") + 1, F.col("high") - F.col("low") + reach - 1)


def _merged(ranges: str):
    """Sorted ranges with those that touch made one; a stretch has at most ``reach`` of them."""
    kind = "array<struct<low: int, high: int>>"

    def add(done, new):
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(last.low.alias("low"), F.greatest(last.high, new.high).alias("high"))
        return F.when(
            last.high >= new.low, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(joined))
        ).otherwise(F.concat(done, F.array(new)))

    return F.aggregate(ranges, F.array().cast(kind), add)


def _sorted(strings: DataFrame, reach: int) -> DataFrame:
    """Repeated windows (``c1, c2, low, high``) of strings (``group, c1, c2, weight, bytes``)."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, keys, size, whole = [], [], 0, []
        for _, members in groupby(_rows(batches), itemgetter(0)):
            members = list(members)
            if all(weight > 1 for _, _, _, weight, _ in members):
                whole += [(c1, c2, len(content) - reach + 1) for _, c1, c2, _, content in members]
            else:
                parts += [content for *_, content in members]
                keys += [(c1, c2, weight) for _, c1, c2, weight, _ in members]
                size += sum(len(content) for *_, content in members)
            if len(whole) >= AT_ONCE:
                yield _whole(whole)
                whole = []
            if size >= SHARD_BYTES:
                yield _repeated(parts, keys, reach)
                parts, keys, size = [], [], 0
        if whole:
            yield _whole(whole)
        if parts:
            yield _repeated(parts, keys, reach)

    size = strings.agg(F.sum(F.length("bytes"))).first()[0] or 0
    tasks = max(2 * strings.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    dealt = strings.select("group", "c1", "c2", "weight", "bytes").repartition(tasks, "group")
    return dealt.sortWithinPartitions("group").mapInArrow(sort, "c1 long, c2 long, low int, high int")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _whole(strings: list[tuple[int, int, int]]) -> pa.RecordBatch:
    """All windows of strings given by key and number of windows."""
    c1, c2, count = (np.array(column, dtype=np.int64) for column in zip(*strings))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(c1),
            pa.array(c2),
            pa.array(np.zeros_like(count), pa.int32()),
            pa.array(count, pa.int32()),
        ],
        ["c1", "c2", "low", "high"],
    )


def _repeated(parts: list[bytes], keys: list[tuple], reach: int) -> pa.RecordBatch:
    """The repeated windows of one shard."""
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    first = np.concatenate(([0], np.cumsum(sizes + 1)))
    with induced_sort.spill_folder() as folder:
        disk = induced_sort.Disk(folder)
        text = induced_sort.shard_text(disk, parts, int(sizes.sum()), len(parts))
        marked = disk.array(np.bool_, len(text) + 1)
        for rows in induced_sort.suffixes(disk, text, len(parts), reach):
            marked[rows["pos"][rows["lcp"] >= reach]] = True
        for part, (_, _, weight) in enumerate(keys):
            if weight > 1:
                marked[first[part] : first[part + 1] - reach] = True
        edges = np.flatnonzero(marked[1:] != marked[:-1]) + 1
        edges = np.append(0, edges) if marked[0] else edges
    low, high = edges[0::2], edges[1::2]
    part = np.searchsorted(first, low, "right") - 1
    c1, c2, _ = (np.array(column, dtype=np.int64) for column in zip(*keys))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(c1[part]),
            pa.array(c2[part]),
            pa.array(low - first[part], pa.int32()),
            pa.array(high - first[part], pa.int32()),
        ],
        ["c1", "c2", "low", "high"],
    )


def _windows(texts: DataFrame, reach: int, level: int, within: str | None) -> DataFrame:
    """Repeated windows (``k1, k2, low, high``) of texts (``k1, k2, weight, bytes``).

    ``within`` names a column that equal windows share already.
    """
    carried = ["k1", "k2", "weight", *([within] if within else [])]
    group = F.xxhash64(within, "anchor") if within else F.col("anchor")
    found = stored(
        _anchored(texts, reach, level, carried).select("k1", "k2", "weight", "low", "high", "times", group.alias("group")),
        "suffix-anchors",
        "zstd",
    )
    times = F.sum(F.col("weight") * F.col("times")).alias("times")
    twice = found.groupBy("group").agg(times).filter("times > 1").select("group")
    pieces_ = (
        join_totals(twice, found, "group")
        .join(texts.select("k1", "k2", "bytes"), ["k1", "k2"])
        .select("k1", "k2", "weight", "low", "group", _cut(reach).alias("bytes"))
    )
    c1, c2 = _keys("bytes")
    pieces_ = pieces_.withColumns({"c1": F.xxhash64("group", c1), "c2": F.xxhash64("group", c2)})
    cut = stored(pieces_, "suffix-stretches", "zstd")
    strings = stored(
        cut.groupBy("c1", "c2", "group").agg(F.sum("weight").alias("weight"), F.first("bytes").alias("bytes")),
        "suffix-strings",
        "zstd",
    )
    hot = strings.groupBy("group").count().filter(F.col("count") > HOT).select("group")
    if level + 1 < len(SHARES) and not (hot := stored(hot, "suffix-hot")).isEmpty():
        calm = _sorted(strings.join(hot, "group", "left_anti"), reach)
        again = strings.join(hot, "group", "left_semi").withColumnsRenamed({"c1": "k1", "c2": "k2"})
        dealt = _windows(stored(again, "suffix-again", "zstd"), reach, level + 1, "group")
        marked = calm.unionByName(dealt.withColumnsRenamed({"k1": "c1", "k2": "c2"}))
    else:
        marked = _sorted(strings, reach)
    # A hot string has a range from each stretch it was dealt in; made one, they meet its occurrences once.
    ranges = F.array_sort(F.collect_list(F.struct("low", "high"))).alias("ranges")
    marked = stored(marked, "suffix-marked").groupBy("c1", "c2").agg(ranges)
    marked = marked.select("c1", "c2", _merged("ranges").alias("ranges"))
    windows = cut.select("k1", "k2", "c1", "c2", "low").join(marked, ["c1", "c2"])
    windows = windows.select("k1", "k2", F.col("low").alias("at"), F.inline("ranges"))
    return windows.select(
        "k1", "k2", (F.col("at") + F.col("low")).alias("low"), (F.col("at") + F.col("high")).alias("high")
    )


def repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH
) -> tuple[DataFrame, DataFrame]:
    """All rows (``id, k1, k2``), and per different text what repeats in it.

    The latter has ``k1, k2, n_bytes, spans`` (maximal repeated runs: ``start, end``) and ``kept``, the
    bytes that are left.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("bytes")
    )
    k1, k2 = _keys("bytes")
    rows = rows.withColumns({"k1": k1, "k2": k2})
    texts = texts_of(rows.drop("id"))
    long = texts.filter(F.length("bytes") >= reach).withColumnRenamed("copies", "weight")
    windows = _windows(long, reach, 0, None)
    spans = windows.groupBy("k1", "k2").agg(F.collect_list(F.struct("low", "high")).alias("windows"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "bytes"):
            out = []
            for k1, k2, copies, content, found in zip(*(column.to_pylist() for column in batch.columns)):
                if copies > 1 and len(content) >= reach:
                    found = [{"low": 0, "high": len(content) - reach + 1}]
                runs, kept, last = [], [], 0
                for low, high in sorted((w["low"], w["high"] + reach - 1) for w in found or ()):
                    if runs and low <= runs[-1]["end"]:
                        runs[-1]["end"] = max(runs[-1]["end"], high)
                    else:
                        runs.append({"start": low, "end": high})
                for run in runs:
                    kept.append(content[last : run["start"]])
                    last = run["end"]
                kept.append(content[last:])
                out.append((k1, k2, len(content), runs, b"".join(kept)))
            kinds = (
                pa.int64(),
                pa.int64(),
                pa.int64(),
                pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
                pa.binary(),
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*out), kinds)],
                ["k1", "k2", "n_bytes", "spans", "kept"],
            )

    found = (
        texts.join(spans, ["k1", "k2"], "left")
        .select("k1", "k2", "copies", "bytes", "windows")
        .mapInArrow(
            remove, "k1 long, k2 long, n_bytes long, spans array<struct<start: int, end: int>>, kept binary"
        )
    )
    return rows.select("id", "k1", "k2"), found


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH
) -> DataFrame:
    """Per row ``id, n_bytes, spans, kept``."""
    rows, found = repeats(docs, id_col, text_col, reach)
    return rows.join(found, ["k1", "k2"]).drop("k1", "k2")


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """Per row ``id, n_bytes, n_removed, n_spans, kept_sha256``; what is kept is not moved."""
    rows, found = repeats(docs, id_col, text_col, reach)
    digest = found.select(
        "k1",
        "k2",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
    return rows.join(digest, ["k1", "k2"]).drop("k1", "k2")
