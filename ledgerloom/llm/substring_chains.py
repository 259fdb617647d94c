"""Substring deduplication by collinear chaining of shared seeds.

Seeds are the least hashes of every ``WINDOW`` neighbouring windows of ``SEED`` words, so two texts
that share ``SEED + WINDOW - 1`` words share a seed. The least document that has a seed is its anchor,
and every other document with the seed is matched with the anchor alone: matches grow with the
seeds, not with the pairs of documents. The matches of a document with one anchor are chained in
order, with gap costs, by a Fenwick tree; the words around a chain are then aligned, which bridges
changed words and finds where the passage begins and ends.

Where shared seeds lie in no passage found so far, every window of ``min_words`` words is matched
with the least document that has the whole window, so each window that an earlier document has is
in a passage, whoever has parts of it.

The documents that a chain needs are read once more, and only the words near chains are kept; ranges
are rounded to ``RANGE`` words, so an anchor that many documents match is cut into few of them.

Defined results: words are folded to lower case. Texts that are null, blank or shorter than
``min_words`` have no passage. Rows with the same id are the same document, which is no repeat of
itself; a row without an id is not compared, since a passage of it could not be named. Extra
columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.runs import runs
from ledgerloom.llm.stored import stored
from ledgerloom.llm.wordhash import Words, mixed, pieces, texts_of

MIN_WORDS, IDENTITY = 50, 0.8
SEED, WINDOW = 6, 16
GAP_COST = 0.05
MARGIN, RANGE = 40, 64
# Kept seeds of a shared stretch are never farther apart.
REACH = 2 * WINDOW
NEAR = 512
DROP, BRIDGE, AGREE = 8, 4, 3
_U = np.uint64


def minimizers(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, word position and hash of each seed.

    Equal hashes closer than ``WINDOW`` words to each other are a run, such as a word over and over;
    of a run the first counts and then one in about ``WINDOW`` words. All others count.
    """
    counts = words.counts()
    windows = np.maximum(counts - SEED + 1, 0)
    hashes, first = words.grams(SEED)
    size = np.diff(first)
    # A text shorter than a seed has one n-gram but no seed.
    hashes = hashes[np.repeat(windows > 0, size)]
    owner = np.repeat(np.arange(len(counts)), windows)
    starts = np.concatenate(([0], np.cumsum(windows)))
    place = np.arange(len(hashes)) - starts[owner]
    if not len(hashes):
        return owner, place, hashes
    low = _sliding(hashes, owner, np.minimum)
    high = low[::-1]
    covered = _sliding(high, owner[::-1], np.maximum)[::-1]
    picked = np.flatnonzero(covered == hashes)
    order = picked[np.lexsort((place[picked], hashes[picked], owner[picked]))]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    new[1:] |= np.diff(place[order]) >= WINDOW
    begins = np.flatnonzero(new)
    steps = (place[order] - np.repeat(place[order][begins], np.diff(np.append(begins, len(order))))) // WINDOW
    new[1:] |= steps[1:] != steps[:-1]
    kept = order[new]
    return owner[kept], place[kept], hashes[kept]


def _turns(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """How often each seed of ``minimizers`` has come before in its text."""
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    begins = np.flatnonzero(new)
    return np.arange(len(owner)) - np.repeat(begins, np.diff(np.append(begins, len(owner))))


def _sliding(values: np.ndarray, owner: np.ndarray, pick) -> np.ndarray:
    """``pick`` over each value and the ``WINDOW - 1`` after it in the same text."""
    out, done = values.copy(), 1
    while done < WINDOW:
        step = min(done, WINDOW - done)
        same = owner[step:] == owner[:-step]
        new = out.copy()
        new[:-step] = np.where(same, pick(out[:-step], out[step:]), out[:-step])
        out, done = new, done + step
    return out


class Fenwick:
    """The greatest score, and whose it is, among positions up to one."""

    def __init__(self, size: int):
        self.best = [(-1e18, -1)] * (size + 1)

    def put(self, at: int, score: float, who: int) -> None:
        at += 1
        while at < len(self.best):
            if score > self.best[at][0]:
                self.best[at] = (score, who)
            at += at & -at

    def below(self, at: int) -> tuple[float, int]:
        """Among positions less than ``at``."""
        found = (-1e18, -1)
        while at > 0:
            if self.best[at][0] > found[0]:
                found = self.best[at]
            at -= at & -at
        return found


def chains(matches: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Ordered matches in both texts, the best chain first; each match is in one chain.

    A match is worth ``SEED`` and a step costs ``GAP_COST`` for every word that it passes over in
    either text, so that a chain ends where the texts go apart.
    """
    matches = sorted(set(matches))
    columns = {at: i for i, at in enumerate(sorted({b for _, b in matches}))}
    tree, score, before = Fenwick(len(columns)), [0.0] * len(matches), [-1] * len(matches)
    i = 0
    while i < len(matches):
        j = i
        while j < len(matches) and matches[j][0] == matches[i][0]:
            a, b = matches[j]
            value, who = tree.below(columns[b])
            gain = value - GAP_COST * (a + b)
            if gain > 0:
                score[j], before[j] = SEED + gain, who
            else:
                score[j] = SEED
            j += 1
        for k in range(i, j):
            a, b = matches[k]
            tree.put(columns[b], score[k] + GAP_COST * (a + b), k)
        i = j
    used, out = set(), []
    for end in sorted(range(len(matches)), key=lambda k: (-score[k], k)):
        if end in used:
            continue
        chain, at = [], end
        while at >= 0 and at not in used:
            used.add(at)
            chain.append(matches[at])
            at = before[at]
        out.append(chain[::-1])
    return out


def _extended(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """How far two texts go on alike from their beginnings: words of each, and equal words.

    Runs along while equal words outweigh others; where that ends, up to ``BRIDGE`` words of either
    may be passed over if ``AGREE`` words agree behind them.
    """
    i = j = equal = 0
    while True:
        n = min(len(a) - i, len(b) - j)
        same = a[i : i + n] == b[j : j + n]
        total = np.cumsum(np.where(same, 1, -2))
        stop = np.flatnonzero(np.maximum.accumulate(np.maximum(total, 0)) - total > DROP)
        total = total[: stop[0]] if len(stop) else total
        ahead = int(np.argmax(total)) + 1 if len(total) and total.max() > 0 else 0
        equal += int(same[:ahead].sum())
        i, j = i + ahead, j + ahead
        steps = [(x, y) for x in range(BRIDGE + 1) for y in range(BRIDGE + 1) if x + y]
        for x, y in sorted(steps, key=lambda s: (sum(s), s)):
            one, two = a[i + x : i + x + AGREE], b[j + y : j + y + AGREE]
            if len(one) == len(two) == AGREE and (one == two).all():
                i, j = i + x, j + y
                break
        else:
            return i, j, equal


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """The most words that can be matched in order; of equally long texts, word by word."""
    if len(a) == len(b):
        straight = int((a == b).sum())
        if straight * 2 >= len(a):
            return straight
    row = np.zeros(len(b) + 1, dtype=np.int64)
    for word in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (b == word)))
    return int(row[-1])


def aligned(a: np.ndarray, b: np.ndarray, chain: list[tuple[int, int]], min_words: int, identity: float):
    """``(a from, a to, b from, b to, equal words)`` of each passage along a chain of positions.

    The whole chain is one passage if enough of its words are equal. If not, it is cut where the most
    words are unlike, and each part is looked at in the same way.
    """
    seeds, gains, losses = [], [], []
    for x, y in chain:
        i, j = (seeds[-1][0] + SEED, seeds[-1][1] + SEED) if seeds else (x, y)
        # A seed that overlaps the one before it on another diagonal adds what it has beyond.
        over = max(i - x, j - y, 0)
        if over < SEED:
            gain = SEED - over + (_common(a[i:x], b[j:y]) if x > i and y > j else 0)
            seeds.append((x, y))
            gains.append(gain)
            losses.append(max(x + SEED - i, y + SEED - j) - gain)
    total, out, open_ = np.concatenate(([0], np.cumsum(gains))), [], [(0, len(seeds))]
    while open_:
        first, last = open_.pop()
        # A part does not reach into the seeds of its neighbours.
        i0, j0 = (seeds[first - 1][0] + SEED, seeds[first - 1][1] + SEED) if first else (0, 0)
        i1, j1 = seeds[last] if last < len(seeds) else (len(a), len(b))
        if i1 - i0 < min_words:
            continue
        (x, y), (u, v) = seeds[first], seeds[last - 1]
        left = _extended(a[i0 : max(x, i0)][::-1], b[j0 : max(y, j0)][::-1])
        right = _extended(a[u + SEED : max(i1, u + SEED)], b[v + SEED : max(j1, v + SEED)])
        a0, a1, b0, b1 = x - left[0], u + SEED + right[0], y - left[1], v + SEED + right[1]
        equal = left[2] + SEED + int(total[last] - total[first + 1]) + right[2]
        if a1 - a0 < min_words:
            continue
        if equal >= identity * max(a1 - a0, b1 - b0) - 1e-9:
            out.append((a0, a1, b0, b1, equal))
        elif last - first > 1:
            cut = first + 1 + int(np.argmax(losses[first + 1 : last]))
            open_ += [(first, cut), (cut, last)]
    return out


def _seeds(docs: DataFrame) -> DataFrame:
    def seed(batches):
        for batch in pieces(batches):
            owner, place, hashes = minimizers(Words(texts_of(batch)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(owner)),
                    pa.array(hashes.view(np.int64)),
                    pa.array(place, pa.int32()),
                    pa.array(_turns(owner, hashes), pa.int32()),
                ],
                ["doc", "seed", "at", "turn"],
            )

    return docs.mapInArrow(seed, "doc long, seed long, at int, turn int")


def _shared(docs: DataFrame) -> DataFrame:
    """``seed, doc, at, turn, anchor`` of every seed that several documents have."""
    found = _seeds(docs)
    shared = (
        found.groupBy("seed")
        .agg(F.min("doc").alias("anchor"), F.max("doc").alias("last"))
        .filter("anchor < last")
        .select("seed", "anchor")
    )
    return stored(found.join(shared, "seed"), "chain-seeds")


def _matches(kept: DataFrame) -> DataFrame:
    """``doc, at, anchor, anchor_at``: each seed with the first of its anchor and with that of its turn."""
    anchors = (
        kept.filter("doc = anchor").groupBy("seed", "turn").agg(F.min("at").alias("anchor_at"))
    )
    theirs = kept.filter("doc <> anchor").withColumn(
        "turn", F.explode(F.array_distinct(F.array(F.lit(0), F.col("turn"))))
    )
    return theirs.join(anchors, ["seed", "turn"]).select("doc", "at", "anchor", "anchor_at")


def _chained(matches: DataFrame) -> DataFrame:
    """One row per chain of two or more seeds: its documents and the positions of its seeds."""

    def chain(batches):
        for group in runs(batches, ["doc"]):
            anchors = group["anchor"].to_numpy()
            at, there = group["at"].to_numpy(), group["anchor_at"].to_numpy()
            order = np.argsort(anchors, kind="stable")
            cuts = np.flatnonzero(np.diff(anchors[order])) + 1
            out = [
                (int(anchors[part[0]]), one)
                for part in np.split(order, cuts)
                if len(part) > 1
                for one in chains(list(zip(at[part].tolist(), there[part].tolist())))
                if len(one) > 1
            ]
            if out:
                doc = group["doc"][0].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([doc] * len(out), pa.int64()),
                        pa.array([anchor for anchor, _ in out], pa.int64()),
                        pa.array([[a for a, _ in one] for _, one in out], pa.list_(pa.int32())),
                        pa.array([[b for _, b in one] for _, one in out], pa.list_(pa.int32())),
                    ],
                    ["doc", "anchor", "at", "anchor_at"],
                )

    return (
        matches.repartition("doc")
        .sortWithinPartitions("doc")
        .mapInArrow(chain, "doc long, anchor long, at array<int>, anchor_at array<int>")
    )


def _left(kept: DataFrame, passages: DataFrame, min_words: int) -> DataFrame:
    """The seeds that stand in stretches of shared seeds which no passage covers yet."""
    rows = (
        kept.filter("doc <> anchor")
        .select("doc", "seed", "at", F.lit(-1).alias("stop"))
        .unionByName(passages.select("doc", F.lit(0).cast("long").alias("seed"), F.col("low").alias("at"), "stop"))
    )

    def uncovered(batches):
        for group in runs(batches, ["doc"]):
            seeds, at, stop = (group[c].to_numpy() for c in ("seed", "at", "stop"))
            mine = stop < 0
            some = np.sort(at[mine])
            open_ = np.zeros(len(some), dtype=bool)
            covered = list(zip(at[~mine].tolist(), stop[~mine].tolist()))
            for low, high in _stretches(some, min_words):
                for begin, end in _gaps(low, high - min_words + 1, covered, min_words):
                    first, last = np.searchsorted(some, [begin - REACH, end + min_words + REACH])
                    open_[first:last] = True
            if open_.any():
                wanted = np.unique(seeds[mine][np.isin(at[mine], some[open_])])
                yield pa.RecordBatch.from_arrays([pa.array(wanted, pa.int64())], ["seed"])

    return (
        rows.repartition("doc").sortWithinPartitions("doc").mapInArrow(uncovered, "seed long").distinct()
    )


def _stretches(at: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """Where windows of ``min_words`` may be shared, given the sorted positions of shared seeds."""
    if not len(at):
        return []
    cuts = np.flatnonzero(np.diff(at) > REACH) + 1
    ends = np.append(cuts, len(at)) - 1
    lows = np.maximum(at[np.concatenate(([0], cuts))] - REACH, 0)
    return [
        (low, high)
        for low, high in zip(lows.tolist(), (at[ends] + SEED + REACH).tolist())
        if high - low >= min_words
    ]


def _gaps(low: int, high: int, covered: list[tuple[int, int]], min_words: int) -> list[tuple[int, int]]:
    """The ranges of window positions from ``low`` up to ``high`` that lie in no covered span."""
    out = []
    for begin, end in sorted(covered):
        if end - min_words + 1 <= low or begin >= high or end - begin < min_words:
            continue
        if begin > low:
            out.append((low, begin))
        low = max(low, end - min_words + 1)
    return out + [(low, high)] if low < high else out


def _windows(docs: DataFrame, kept: DataFrame, passages: DataFrame, min_words: int) -> DataFrame:
    """``doc, window, at, open`` of each window of ``min_words`` in what passages leave, in all documents.

    Open windows lie in no passage; the others may still be what an open one is like.
    """
    wanted = (
        kept.join(_left(kept, passages, min_words), "seed", "left_semi")
        .groupBy("doc")
        .agg(F.collect_set("at").alias("places"))
    )
    spans = passages.groupBy("doc").agg(F.collect_list(F.struct("low", "stop")).alias("spans"))

    def windows(batches):
        for batch in pieces(batches):
            hashes, first = Words(texts_of(batch)).grams(min_words)
            ids, places, spans = (batch.column(i).to_pylist() for i in (0, 2, 3))
            out = []
            for i, (doc, some) in enumerate(zip(ids, places)):
                covered = [(r["low"], r["stop"]) for r in spans[i] or []]
                size = int(first[i + 1] - first[i])
                for low, high in _stretches(np.sort(np.array(some)), min_words):
                    at = np.arange(low, min(high - min_words + 1, size))
                    open_ = np.zeros(len(at), dtype=bool)
                    for begin, end in _gaps(low, low + len(at), covered, min_words):
                        open_[begin - low : end - low] = True
                    out.append((np.full(len(at), doc), hashes[first[i] + at].view(np.int64), at, open_))
            if out:
                doc, window, at, open_ = (np.concatenate(column) for column in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64()), pa.array(window), pa.array(at, pa.int32()), pa.array(open_)],
                    ["doc", "window", "at", "open"],
                )

    return (
        docs.join(wanted, "doc")
        .join(spans, "doc", "left")
        .select("doc", "text", "places", "spans")
        .mapInArrow(windows, "doc long, window long, at int, open boolean")
    )


def _window_matches(windows: DataFrame) -> DataFrame:
    """``doc, at, anchor, anchor_at`` of open windows; the anchor is the least document with the window."""
    shared = (
        windows.groupBy("window")
        .agg(F.min("doc").alias("anchor"), F.max(F.when(F.col("open"), F.col("doc"))).alias("last"))
        .filter("anchor < last")
        .select("window", "anchor")
    )
    both = stored(
        windows.join(shared, "window").filter("open or doc = anchor"), "chain-window-matches"
    )
    anchors = both.filter("doc = anchor").groupBy("window").agg(F.min("at").alias("anchor_at"))
    return both.filter("doc <> anchor").join(anchors, "window").select("doc", "at", "anchor", "anchor_at")


def _lined(matches: DataFrame) -> DataFrame:
    """One row per row of matches that lie close in both texts: where each diagonal run of them begins and ends."""

    def line(batches):
        for group in runs(batches, ["doc"]):
            anchors, at, there = (group[c].to_numpy().astype(np.int64) for c in ("anchor", "at", "anchor_at"))
            order = np.lexsort((there, at, anchors))
            anchors, at, there = anchors[order], at[order], there[order]
            begins = np.ones(len(at) + 1, dtype=bool)
            begins[1:-1] = (anchors[1:] != anchors[:-1]) | (np.diff(at) != 1) | (np.diff(there) != 1)
            # Both ends of a run on a diagonal stay, and stay together.
            kept = begins[:-1] | begins[1:]
            anchors, at, there, begins = anchors[kept], at[kept], there[kept], begins[:-1][kept]
            far = (anchors[1:] != anchors[:-1]) | (np.diff(at) > NEAR) | (np.abs(np.diff(there)) > NEAR)
            cuts = np.flatnonzero(begins[1:] & far) + 1
            parts = [(anchors[p[0]], at[p], there[p]) for p in np.split(np.arange(len(at)), cuts)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([group["doc"][0].as_py()] * len(parts), pa.int64()),
                    pa.array([int(p[0]) for p in parts], pa.int64()),
                    pa.array([p[1] for p in parts], pa.list_(pa.int32())),
                    pa.array([p[2] for p in parts], pa.list_(pa.int32())),
                ],
                ["doc", "anchor", "at", "anchor_at"],
            )

    return (
        matches.distinct()
        .repartition("doc")
        .sortWithinPartitions("doc")
        .mapInArrow(line, "doc long, anchor long, at array<int>, anchor_at array<int>")
    )


def around_windows(a: np.ndarray, b: np.ndarray, places: list[tuple[int, int]], min_words: int, identity: float):
    """Passages as of ``aligned`` that hold every window which is equal at one of the places."""
    out, done = [], -1
    for x, y in places:
        n = min(len(a) - x, len(b) - y)
        if n < min_words:
            continue
        other = np.flatnonzero(a[x : x + n] != b[y : y + n])
        size = int(other[0]) if len(other) else n
        if size < min_words or x + size <= done:
            continue
        left, right = _extended(a[:x][::-1], b[:y][::-1]), _extended(a[x + size :], b[y + size :])
        a0, a1, b0, b1 = x - left[0], x + size + right[0], y - left[1], y + size + right[1]
        equal = left[2] + size + right[2]
        if equal < identity * max(a1 - a0, b1 - b0) - 1e-9:
            a0, a1, b0, b1, equal = x, x + size, y, y + size, size
        out.append((a0, a1, b0, b1, equal))
        done = max(done, a1)
    return out


def _range(at: str, prefix: str, size: int) -> list:
    low = F.greatest(F.lit(0), F.array_min(at) - MARGIN)
    high = F.array_max(at) + size + MARGIN
    return [
        (F.floor(low / RANGE) * RANGE).cast("int").alias(prefix + "low"),
        (F.ceil(high / RANGE) * RANGE).cast("int").alias(prefix + "high"),
    ]


def _words_near(docs: DataFrame, chained: DataFrame) -> DataFrame:
    """``doc, low, high, words``: the hashes of the words in each range that a chain needs."""
    wanted = (
        chained.select("doc", "low", "high")
        .unionByName(
            chained.select(
                F.col("anchor").alias("doc"), F.col("anchor_low").alias("low"), F.col("anchor_high").alias("high")
            )
        )
        .distinct()
        .groupBy("doc")
        .agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    )

    def cut(batches):
        for batch in pieces(batches):
            words = Words(texts_of(batch))
            docs, ranges = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            rows = [
                (doc, r["low"], r["high"], hashes[r["low"] : r["high"]].tobytes())
                for i, (doc, some) in enumerate(zip(docs, ranges))
                for hashes in [(words.hashes[words.first[i] : words.first[i + 1]] >> _U(32)).astype(np.uint32)]
                for r in some
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int32()),
                    pa.array([r[2] for r in rows], pa.int32()),
                    pa.array([r[3] for r in rows], pa.binary()),
                ],
                ["doc", "low", "high", "words"],
            )

    return (
        docs.join(wanted, "doc")
        .select("doc", "text", "ranges")
        .mapInArrow(cut, "doc long, low int, high int, words binary")
        .dropDuplicates(["doc", "low", "high"])
    )


def repeated_passages(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    identity: float = IDENTITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per passage of a document that an earlier document has as well.

    ``start_word`` up to ``end_word`` of the document is like ``partner_start`` up to ``partner_end``
    of the partner, which has the lesser id: ``matched`` words are equal in order, a share of at
    least ``identity`` of the longer side.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).filter("doc is not null")
    kept = _shared(rows)
    chained = stored(_ranged(_chained(_matches(kept)), SEED), "chain-chains")
    found = stored(_passages(rows, chained, False, min_words, identity), "chain-passages")
    # What chains leave is matched anew by whole windows, each with the least document that has it.
    spans = found.select("doc", F.col("start_word").cast("int").alias("low"), F.col("end_word").cast("int").alias("stop"))
    windows = stored(_windows(rows, kept, spans, min_words), "chain-windows")
    lined = stored(_ranged(_lined(_window_matches(windows)), min_words + RANGE), "chain-lined")
    more = _passages(rows, lined, True, min_words, identity)
    return found.unionByName(more).distinct().withColumnRenamed("doc", id_col)


def _ranged(matched: DataFrame, size: int) -> DataFrame:
    return matched.select("*", *_range("at", "", size), *_range("anchor_at", "anchor_", size))


def _passages(rows: DataFrame, chained: DataFrame, whole: bool, min_words: int, identity: float) -> DataFrame:
    """The passages along chains of seeds or, if ``whole``, around equal windows."""
    near = stored(_words_near(rows, chained), "chain-words")
    theirs = near.select(
        F.col("doc").alias("anchor"),
        F.col("low").alias("anchor_low"),
        F.col("high").alias("anchor_high"),
        F.col("words").alias("anchor_words"),
    )
    both = chained.join(near, ["doc", "low", "high"]).join(theirs, ["anchor", "anchor_low", "anchor_high"])

    def align(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                a = np.frombuffer(row["words"], dtype=np.uint32)
                b = np.frombuffer(row["anchor_words"], dtype=np.uint32)
                low, there = row["low"], row["anchor_low"]
                places = [(x - low, y - there) for x, y in zip(row["at"], row["anchor_at"])]
                if whole:
                    some = around_windows(a, b, places, min_words, identity)
                else:
                    seeds = [
                        (x, y)
                        for x, y in places
                        if len(a) and len(b) and (a[x : x + SEED] == b[y : y + SEED]).all()
                    ]
                    some = aligned(a, b, seeds, min_words, identity) if seeds else []
                for a0, a1, b0, b1, equal in some:
                    out.append(
                        (row["doc"], a0 + low, a1 + low, row["anchor"], b0 + there, b1 + there, equal,
                         equal / max(a1 - a0, b1 - b0))
                    )
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, pa.float64() if i == 7 else pa.int64()) for i, v in enumerate(zip(*out))],
                    ["doc", *NAMES],
                )

    NAMES = ["start_word", "end_word", "partner_id", "partner_start", "partner_end", "matched", "identity"]
    kinds = ", ".join(f"{name} long" for name in NAMES[:-1])
    return both.select(
        "doc", "low", "at", "words", "anchor", "anchor_low", "anchor_at", "anchor_words"
    ).mapInArrow(align, f"doc long, {kinds}, identity double").distinct()


def without_passages(
    docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` with the words of their passages cut out; the first copy stays whole."""
    spans = passages.groupBy(F.col(id_col).cast("long").alias("of")).agg(
        F.collect_list(F.struct("start_word", "end_word")).alias("spans")
    )

    def cut(batches):
        for batch in pieces(batches):
            words, out = Words(texts_of(batch)), []
            for i, (text, spans_) in enumerate(zip(texts_of(batch), batch.column(1).to_pylist())):
                if spans_:
                    keep = np.ones(int(words.counts()[i]), dtype=bool)
                    for span in spans_:
                        keep[span["start_word"] : span["end_word"]] = False
                    # Words of the text as it is; folding to lower case moves no blank.
                    own = Words([text], fold=False)
                    parts = []
                    for at in np.flatnonzero(keep).tolist():
                        if parts and parts[-1][1] == at:
                            parts[-1][1] = at + 1
                        else:
                            parts.append([at, at + 1])
                    text = "\n".join(own.span_bytes(low, high).decode() for low, high in parts)
                out.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["row", "cut"])

    whole = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(id_col).cast("long").alias("of"),
        F.col(text_col).alias("text"),
    )
    joined = whole.join(spans, "of", "left").select("row", "spans", "text")
    schema = f"row {joined.schema['row'].dataType.simpleString()}, cut string"
    done = joined.mapInArrow(cut, schema)
    return done.select(
        *(F.col("cut").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns)
    )
