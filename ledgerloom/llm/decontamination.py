"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items meet where a window of ``min_match`` tokens has the same Karp-Rabin
hash. For each such pair the longest match that overlaps no earlier one is marked as a tile, again
and again, until none of ``min_match`` tokens is left. An item leaks into a document if its tiles
cover enough of it, in whatever order its passages stand there.

The benchmark is read in blocks of bounded size; each block is sent to the executors and compared
with all documents in one pass without a shuffle.

Defined results: tokens are folded to lower case and end at blanks and ASCII punctuation. A null or
blank text matches nothing, nor does an item of fewer tokens than ``min_match``. Repeated rows are
compared one by one, very long and repetitive texts in memory linear in them but for a logarithm, items without an id like others. Extra columns are not looked at.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.wordhash import BLANK_OR_MARK, Words, mixed, pieces, texts_of

MIN_MATCH, COVERAGE = 5, 0.5
BLOCK_BYTES = 8 << 20
FILTER_BITS = 20
# Seeds a window, beyond which tiles are found by length instead of seed by seed; both give the same.
DENSE = 8
_U = np.uint64
_BASE = _U(0xC6A4A7935BD1E995)


def running_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    """The Karp-Rabin hash of every window of ``size`` tokens."""
    count = max(len(tokens) - size + 1, 0)
    value = np.zeros(count, dtype=_U)
    for step in range(size):
        value = value * _BASE + tokens[step : step + count]
    return mixed(value)


def tiles(seeds: list[tuple[int, int]], size: int) -> list[tuple[int, int, int]]:
    """Greedy tiles ``(document position, item position, length)`` of two token sequences.

    ``seeds`` are all pairs of positions from which ``size`` tokens are equal. Neighbours on a
    diagonal make up a longest match; the longest goes first, then the one that starts earliest,
    and what others keep of themselves beside it is considered again.
    """
    diagonals = defaultdict(list)
    for at, item in set(seeds):
        diagonals[at - item].append(at)
    heap = []
    for shift, places in diagonals.items():
        places.sort()
        begin = before = places[0]
        for at in [*places[1:], None]:
            if at != before + 1:
                heap.append((-(before - begin + size), begin, begin - shift))
                begin = at
            before = at
    heapq.heapify(heap)
    taken, marked, found = set(), set(), []
    while heap:
        length, at, item = heapq.heappop(heap)
        length = -length
        free = [at + i not in taken and item + i not in marked for i in range(length)]
        if all(free):
            taken.update(range(at, at + length))
            marked.update(range(item, item + length))
            found.append((at, item, length))
            continue
        begin = None
        for i, open_ in enumerate([*free, False]):
            if open_ and begin is None:
                begin = i
            elif not open_ and begin is not None:
                if i - begin >= size:
                    heapq.heappush(heap, (-(i - begin), at + begin, item + begin))
                begin = None
    return found


def _names(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Numbers that are equal where both parts are."""
    _, name = np.unique(first, return_inverse=True)
    _, other = np.unique(second, return_inverse=True)
    return np.unique(name.astype(np.int64) * (int(other.max(initial=0)) + 1) + other, return_inverse=True)[1]


def tiles_by_length(text: np.ndarray, item: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """The tiles of ``tiles``, from the tokens themselves, in memory that is linear in them but for a log.

    For texts that repeat themselves, whose seeds are as many as the product of their lengths. Windows
    of doubled lengths get names; the longest length at which free windows of both sides share a name
    is found by halving, and all tiles of that length are marked, the earliest first.
    """
    n, both = len(text), np.concatenate([text, item])
    levels = [np.unique(both, return_inverse=True)[1]]
    while 2 << (len(levels) - 1) <= min(n, len(item)):
        half = 1 << (len(levels) - 1)
        levels.append(_names(levels[-1][:-half], levels[-1][half:]))
    free = np.ones(len(both), dtype=bool)
    found, most = [], min(n, len(item))

    def open_windows(length):
        """Names of all windows of the length, and the starts of the free ones in the text and the item."""
        level = length.bit_length() - 1
        names = levels[level]
        if length != 1 << level:
            stop = len(both) - length + 1
            shift = length - (1 << level)
            names = _names(names[:stop], names[shift : shift + stop])
        used = np.concatenate([[0], np.cumsum(~free)])
        starts = np.flatnonzero(used[length:] == used[:-length])
        cut = np.searchsorted(starts, [n - length + 1, n])
        return names, starts[: cut[0]], starts[cut[1] :]

    def shared(length):
        names, here, there = open_windows(length)
        return bool(np.isin(names[here], names[there]).any())

    while most >= size:
        low, high = size - 1, most
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if shared(middle) else (low, middle - 1)
        if low < size:
            break
        names, here, there = open_windows(low)
        places = defaultdict(list)
        for at in there[::-1].tolist():
            places[int(names[at])].append(at)
        here = here[np.isin(names[here], names[there])]
        done = -1
        for at, name in zip(here.tolist(), names[here].tolist()):
            if at < done:
                continue
            held = places[name]
            while held and not (free[held[-1]] and free[held[-1] + low - 1]):
                held.pop()
            if held:
                to, done = held.pop(), at + low
                free[at:done] = free[to : to + low] = False
                found.append((at, to - n, low))
        most = low - 1
    return found


class _Block:
    """Some benchmark items: the windows of all, sorted by hash, and where each is."""

    def __init__(self, texts: list[str | None], size: int):
        words = Words(texts, breaks=BLANK_OR_MARK)
        self.lengths = words.counts()
        hashes, items, places = [], [], []
        for i, (low, high) in enumerate(zip(words.first[:-1], words.first[1:])):
            windows = running_hashes(words.hashes[low:high], size)
            hashes.append(windows)
            items.append(np.full(len(windows), i))
            places.append(np.arange(len(windows)))
        flat = np.concatenate(hashes) if hashes else np.empty(0, dtype=_U)
        # Items come one after another, so equal hashes stand in the order of items and places.
        order = np.argsort(flat, kind="stable")
        self.tokens, self.first = words.hashes, words.first
        self.places = np.concatenate(places)[order] if places else order
        hashes, items = flat[order], np.concatenate(items)[order] if items else order
        # A group is the windows of one hash in one item.
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (items[1:] != items[:-1])
        self.begins = np.append(np.flatnonzero(new), len(hashes))
        self.hashes, self.items = hashes[new], items[new]
        self.filter = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.filter[self.hashes >> _U(64 - FILTER_BITS)] = True

    def leaks(self, texts, size: int, coverage: float):
        """``(text position, item position, covered share, tiles)`` of each leak."""
        words = Words(texts, breaks=BLANK_OR_MARK)
        windows = running_hashes(words.hashes, size)
        at = np.flatnonzero(self.filter[windows >> _U(64 - FILTER_BITS)])
        low = np.searchsorted(self.hashes, windows[at], "left")
        high = np.searchsorted(self.hashes, windows[at], "right")
        text = np.searchsorted(words.first, at, "right") - 1
        # A window may not run over the end of its text.
        real = (high > low) & (at + size <= words.first[text + 1])
        at, text, low, high = at[real], text[real], low[real], high[real]
        # Windows of one hash in one text meet the groups of that hash; positions pair off only later.
        order = np.lexsort((at, low, text))
        at, text, low, high = at[order], text[order], low[order], high[order]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (text[1:] != text[:-1]) | (low[1:] != low[:-1])
        begins = np.append(np.flatnonzero(new), len(at))
        pairs = defaultdict(list)
        for mine, (i, a, b) in enumerate(zip(text[new].tolist(), low[new].tolist(), high[new].tolist())):
            for group in range(a, b):
                pairs[i, int(self.items[group])].append((mine, group))
        for (i, item), met in sorted(pairs.items()):
            need = coverage * self.lengths[item] - 1e-9
            here = [at[begins[mine] : begins[mine + 1]] for mine, _ in met]
            there = [self.places[self.begins[group] : self.begins[group + 1]] for _, group in met]
            reached = np.zeros(self.lengths[item], dtype=bool)
            for places in there:
                for step in range(size):
                    reached[places + step] = True
            if reached.sum() < need:
                continue
            seeds = sum(len(a) * len(b) for a, b in zip(here, there))
            first = int(words.first[i])
            if seeds <= DENSE * sum(len(a) + len(b) for a, b in zip(here, there)):
                found = tiles(
                    [(a - first, b) for x, y in zip(here, there) for a in x.tolist() for b in y.tolist()], size
                )
            else:
                whole = words.hashes[first : words.first[i + 1]]
                found = tiles_by_length(whole, self.tokens[self.first[item] : self.first[item + 1]], size)
            share = sum(length for _, _, length in found) / float(self.lengths[item])
            if share >= coverage - 1e-9:
                yield i, item, share, found


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, size: int):
    """The items in parts of about ``BLOCK_BYTES``, each as broadcast ids and windows."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, math.ceil(total / BLOCK_BYTES))
    for part in range(count):
        rows = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == part).collect()
        rows.sort(key=lambda row: (row.item is None, row.item, row.text or ""))
        if rows:
            block = _Block([row.text for row in rows], size)
            yield spark.sparkContext.broadcast(([row.item for row in rows], block))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    min_match: int = MIN_MATCH,
    coverage: float = COVERAGE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document and item that leaks into it, with coverage and tiles in tokens."""
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    item_type = benchmark.select(item_col).schema[0].dataType.simpleString()
    schema = (
        f"`{id_col}` {id_type}, `{item_col}` {item_type}, coverage double, "
        "tiles array<struct<doc_token: int, item_token: int, tokens: int>>"
    )
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    names = ["doc_token", "item_token", "tokens"]

    def against(block):
        def find(batches):
            items, index = block.value
            for batch in pieces(batches):
                found = list(index.leaks(texts_of(batch), min_match, coverage))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array([f[0] for f in found])),
                            pa.array([items[f[1]] for f in found], item_kind),
                            pa.array([f[2] for f in found], pa.float64()),
                            pa.array([[dict(zip(names, t)) for t in f[3]] for f in found], tile_kind),
                        ],
                        [id_col, item_col, "coverage", "tiles"],
                    )

        return find

    from pyspark.sql.pandas.types import to_arrow_type

    item_kind = to_arrow_type(benchmark.select(item_col).schema[0].dataType)
    tile_kind = pa.list_(pa.struct([(name, pa.int32()) for name in names]))
    out = docs.sparkSession.createDataFrame([], schema)
    for block in _blocks(benchmark, item_col, item_text_col, min_match):
        out = out.unionByName(source.mapInArrow(against(block), schema))
    return out


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    min_match: int = MIN_MATCH,
    coverage: float = COVERAGE,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` into which no item leaks, with their columns."""

    def without(block):
        def keep(batches):
            _, index = block.value
            for batch in pieces(batches, text_col):
                stays = np.ones(batch.num_rows, dtype=bool)
                for i, *_ in index.leaks(texts_of(batch, text_col), min_match, coverage):
                    stays[i] = False
                yield batch if stays.all() else batch.filter(pa.array(stays))

        return keep

    for block in _blocks(benchmark, item_col, item_text_col, min_match):
        docs = docs.mapInArrow(without(block), docs.schema)
    return docs
