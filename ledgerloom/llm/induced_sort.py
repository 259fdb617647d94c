"""Suffix order and common-prefix values of one shard by external induced sorting.

``suffixes`` sorts all suffixes of a shard that may be far larger than memory. Suffix tuples
(symbol, place, run of equal symbols, common prefix with the tuple before) pass through a priority
queue whose buckets lie on disk beyond a stated number of tuples:

1. Substrings between leftmost ascending suffixes are ordered by two inductions from their first
   symbols (descending suffixes in rising order, then ascending ones in falling order) and named.
2. The names form a string of at most half the length, whose suffixes are ordered the same way, level
   by level, until a level fits in memory and is ordered by doubling.
3. Two more inductions carry that order, and the common-prefix values, to all suffixes.

A tuple's common prefix is one more than the least value between the two tuples that induced it and its
neighbour. Values are cut off at ``reach``: none beyond it is ever asked for.

The queue hands out tuples in batches that nothing they induce can fall into, so each step is a few
array operations. Disk is private to the task: Spark's own local folders, as for Spark's spills; a
lost executor loses only what its retried task writes anew.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np

# Tuples that one structure keeps in memory, and names that doubling may order at once.
MEMORY = 1 << 22
BATCH = 1 << 16
BUCKET = 1 << 15
UNCUT = np.uint32(1 << 31)
TUPLE = np.dtype([("key", "u8"), ("pos", "i8"), ("run", "u4"), ("lcp", "u4")])
SUFFIX = np.dtype([("pos", "i8"), ("run", "u4"), ("lcp", "u4")])


@contextmanager
def spill_folder() -> Iterator[str]:
    """A folder of this task alone, where Spark puts its own spills; gone when the task ends."""
    roots = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")
    folder = tempfile.mkdtemp(prefix="induced-sort-", dir=roots[os.getpid() % len(roots)] or None)
    try:
        yield folder
    finally:
        shutil.rmtree(folder, ignore_errors=True)


class Disk:
    """Arrays and tapes of one shard, in memory up to ``memory`` entries each, else in its folder."""

    def __init__(self, folder: str, memory: int = MEMORY):
        self.folder, self.memory, self._files = folder, memory, 0

    def path(self) -> str:
        self._files += 1
        return os.path.join(self.folder, str(self._files))

    def array(self, dtype, length: int) -> np.ndarray:
        if length <= self.memory:
            return np.zeros(length, dtype=dtype)
        return np.asarray(np.memmap(self.path(), dtype=dtype, mode="w+", shape=(length,)))


class Tape:
    """Rows written once in order and read once in blocks, forwards or backwards."""

    def __init__(self, disk: Disk, dtype: np.dtype):
        self.disk, self.dtype, self.held, self.size, self.file = disk, dtype, [], 0, None

    def write(self, rows: np.ndarray) -> None:
        self.held.append(rows)
        self.size += len(rows)
        if sum(map(len, self.held)) > self.disk.memory:
            self._flush()

    def _flush(self) -> None:
        if self.file is None:
            self.file = self.disk.path()
        with open(self.file, "ab") as out:
            for rows in self.held:
                rows.tofile(out)
        self.held = []

    def _whole(self) -> np.ndarray:
        if self.file is None:
            return np.concatenate(self.held) if self.held else np.zeros(0, self.dtype)
        self._flush()
        return np.memmap(self.file, dtype=self.dtype, mode="r")

    def forward(self, block: int = BATCH) -> Iterator[np.ndarray]:
        rows = self._whole()
        for low in range(0, len(rows), block):
            yield np.array(rows[low : low + block])

    def backward(self, block: int = BATCH) -> Iterator[np.ndarray]:
        rows = self._whole()
        for high in range(len(rows), 0, -block):
            yield np.array(rows[max(0, high - block) : high])[::-1]

    def turned(self) -> Iterator[np.ndarray]:
        """Backwards, with common prefixes to the row that now comes before."""
        after = np.uint32(0)
        for rows in self.backward():
            mine = rows["lcp"].copy()
            rows["lcp"] = np.concatenate(([after], mine[:-1]))
            after = mine[-1]
            yield rows

    def drop(self) -> None:
        self.held = []
        if self.file is not None:
            os.unlink(self.file)


class TupleQueue:
    """A priority queue of tuples by key, equal keys in order of arrival, with its buckets on disk.

    ``edges`` are the least keys of the buckets. A bucket of one key is read in order of arrival, one of
    several keys is loaded and sorted; the caller's edges bound the latter's size.
    """

    def __init__(self, disk: Disk, edges: np.ndarray):
        self.disk, self.edges = disk, edges
        self.held: list[list[np.ndarray]] = [[] for _ in edges]
        self.files: list[str | None] = [None] * len(edges)
        self.read = [0] * len(edges)
        self.size, self.bucket, self.at = 0, 0, 0
        self.front = np.zeros(0, TUPLE)
        self.single = np.append(np.diff(edges) == 1, False)

    def push(self, rows: np.ndarray) -> None:
        """Add rows that are in order of their keys, equal keys in order of arrival."""
        if not len(rows):
            return
        keys = np.ascontiguousarray(rows["key"])
        cuts = np.append(0, np.flatnonzero(keys[1:] != keys[:-1]) + 1)
        bucket = np.searchsorted(self.edges, keys[cuts], "right") - 1
        new = np.append(0, np.flatnonzero(bucket[1:] != bucket[:-1]) + 1)
        cuts, bucket = cuts[new].tolist(), bucket[new].tolist()
        for place, low, high in zip(bucket, cuts, [*cuts[1:], len(rows)]):
            self.held[place].append(rows[low:high].copy())
        self.size += len(rows)
        if self.size > self.disk.memory:
            self._spill()

    def _spill(self) -> None:
        for bucket, parts in enumerate(self.held):
            if parts and (bucket != self.bucket or self.single[bucket]):
                if self.files[bucket] is None:
                    self.files[bucket] = self.disk.path()
                with open(self.files[bucket], "ab") as out:
                    for part in parts:
                        part.tofile(out)
                self.held[bucket] = []
        self.size = sum(len(p) for parts in self.held for p in parts)

    def _stored(self, bucket: int, count: int) -> np.ndarray:
        if self.files[bucket] is None:
            return np.zeros(0, TUPLE)
        rows = np.fromfile(self.files[bucket], TUPLE, count, offset=self.read[bucket] * TUPLE.itemsize)
        self.read[bucket] += len(rows)
        if count < 0:
            os.unlink(self.files[bucket])
            self.files[bucket] = None
        return rows

    def _refill(self) -> None:
        bucket = self.bucket
        if self.single[bucket]:
            if self.at < len(self.front):
                return
            rows = self._stored(bucket, BATCH)
            if not len(rows):
                parts, self.held[bucket] = self.held[bucket], []
                rows = np.concatenate(parts) if parts else rows
                self.size -= len(rows)
            self.front, self.at = rows, 0
        elif self.held[bucket] or self.files[bucket] is not None:
            parts, self.held[bucket] = self.held[bucket], []
            self.size -= sum(map(len, parts))
            rows = np.concatenate((self.front[self.at :], self._stored(bucket, -1), *parts))
            self.front, self.at = rows[np.argsort(rows["key"], kind="stable")], 0

    def peek(self, admit, most: int) -> np.ndarray:
        """The next tuples, at most so many; ``admit(key)`` first pushes what lies below that key."""
        while self.bucket < len(self.edges):
            last = self.bucket + 1 == len(self.edges)
            admit(None if last else self.edges[self.bucket + 1])
            self._refill()
            if self.at < len(self.front):
                return self.front[self.at : self.at + most]
            if self.files[self.bucket] is not None:
                os.unlink(self.files[self.bucket])
                self.files[self.bucket] = None
            self.bucket += 1
        return self.front[:0]

    def take(self, count: int) -> None:
        self.at += count


class Least:
    """Least values of ranges of one batch."""

    def __init__(self, values: np.ndarray):
        self.table = np.empty((max(1, len(values).bit_length()), len(values)), values.dtype)
        self.table[0] = values
        for level in range(1, len(self.table)):
            width, above, low = 1 << (level - 1), self.table[level - 1], self.table[level]
            np.minimum(above[:-width], above[width:], out=low[:-width])
            low[-width:] = above[-width:]

    def of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least of ``values[low .. high]``, both included, none empty."""
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        return np.minimum(self.table[level, low], self.table[level, high - (1 << level) + 1])


class Level:
    """One string: its symbols, which suffixes ascend, and the leftmost ascending ones.

    The last symbol occurs once. ``starts`` are the least symbols of the groups of symbols that the
    queue keeps together; a group is small or one symbol.
    """

    def __init__(self, disk: Disk, text: np.ndarray, symbols: int, starts: np.ndarray):
        self.disk, self.text, self.n, self.symbols, self.starts = disk, text, len(text), symbols, starts
        self.narrow = np.uint16 if symbols <= 1 << 16 else np.int64
        self.up = disk.array(np.bool_, self.n)
        self.up[self.n - 1] = True
        follow, up_next = text[self.n - 1], True
        for high in range(self.n - 1, 0, -BATCH):
            low = max(0, high - BATCH)
            here = np.array(text[low : high + 1])
            here[-1] = follow
            sign = np.sign(here[1:].astype(np.int64) - here[:-1])
            at = np.where(sign != 0, np.arange(high - low), high - low)
            after = np.minimum.accumulate(at[::-1])[::-1]
            self.up[low:high] = np.append(sign > 0, up_next)[after]
            follow, up_next = here[0], bool(self.up[low])
        blocks = []
        for low in range(0, self.n, BATCH):
            some = np.array(self.up[max(0, low - 1) : low + BATCH])
            found = np.flatnonzero(some[1:] & ~some[:-1]) + max(1, low)
            blocks.append(found)
        count = sum(map(len, blocks))
        self.peaks = disk.array(np.int64, count)
        place = 0
        for found in blocks:
            self.peaks[place : place + len(found)] = found
            place += len(found)

    def _edges(self, falling: bool) -> np.ndarray:
        starts, after = self.starts, np.append(self.starts[1:], self.symbols)
        if falling:
            starts, after = (self.symbols - after)[::-1], (self.symbols - starts)[::-1]
        edges = np.concatenate((2 * starts, 2 * starts[after - starts == 1] + 1))
        return np.unique(edges).astype(np.uint64)

    def runs(self, pos: np.ndarray) -> np.ndarray:
        """How many equal symbols follow one another from each place on."""
        out = np.ones(len(pos), dtype=np.uint32)
        left = np.arange(len(pos))
        while len(left):
            at = pos[left] + out[left]
            left = left[self.text[np.minimum(at, self.n - 1)] == self.text[pos[left]]]
            left = left[pos[left] + out[left] < self.n]
            out[left] += 1
        return out

    def induced(self, seeds: Iterable[np.ndarray], falling: bool, cap: np.uint32) -> Iterator[np.ndarray]:
        """One induction: the seeds (``SUFFIX`` rows in order) and all that they induce, in order.

        Yields ``SUFFIX`` rows and which of them were induced. Rising, descending suffixes are induced
        by leftmost ascending ones; falling, ascending ones are induced by descending ones.
        """
        queue = TupleQueue(self.disk, self._edges(falling))
        top = self.symbols - 1
        seeds, ahead = iter(seeds), None

        def keyed(rows: np.ndarray, seed: int) -> np.ndarray:
            symbol = self.text[rows["pos"]].astype(np.int64)
            out = np.empty(len(rows), TUPLE)
            out["key"] = 2 * (top - symbol if falling else symbol) + seed
            for name in ("pos", "run", "lcp"):
                out[name] = rows[name]
            return out

        def admit(below) -> None:
            nonlocal ahead
            while True:
                if ahead is None or not len(ahead):
                    rows = next(seeds, None)
                    if rows is None:
                        return
                    ahead = keyed(rows, 1)
                count = len(ahead) if below is None else int(np.searchsorted(ahead["key"], below))
                queue.push(ahead[:count])
                ahead = ahead[count:]
                if len(ahead):
                    return

        if falling:
            end = np.zeros(1, SUFFIX)
            end["pos"], end["run"] = self.n - 1, 1
            queue.push(keyed(end, 0))
        # Least common prefix since the last tuple that each symbol came before, within one symbol.
        before, since = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        last_key, last_run, most = np.uint64(1) << np.uint64(63), np.uint32(0), BATCH
        while True:
            batch = queue.peek(admit, most)
            if not len(batch):
                return
            pos = batch["pos"]
            ahead_of = np.maximum(pos - 1, 0)
            gives = (pos > 0) & (self.up[ahead_of] == falling)
            symbol = self.text[ahead_of[gives]].astype(np.int64)
            key = (2 * (top - symbol if falling else symbol)).astype(np.uint64)
            if len(key) and key.min() < batch["key"][-1]:
                count = int(np.searchsorted(batch["key"], key.min(), "right"))
                keep = int(np.count_nonzero(gives[:count]))
                batch, pos, gives, key = batch[:count], pos[:count], gives[:count], key[:keep]
                most = max(1 << 10, 2 * count)
            else:
                most = min(BATCH, 2 * most)
            queue.take(len(batch))

            keys, run = batch["key"], batch["run"]
            prior_key = np.concatenate(([last_key], keys[:-1]))
            prior_run = np.concatenate(([last_run], run[:-1]))
            lcp = np.where(keys == prior_key, batch["lcp"], np.minimum(run, prior_run))
            lcp[keys >> np.uint64(1) != prior_key >> np.uint64(1)] = 0
            np.minimum(lcp, cap, out=lcp)
            last_key, last_run = keys[-1], run[-1]
            out = np.empty(len(batch), SUFFIX)
            out["pos"], out["run"], out["lcp"] = pos, run, lcp
            yield out, (keys & np.uint64(1)) == 0

            least, end = Least(lcp), len(lcp) - 1
            giver = np.flatnonzero(gives)
            # Keys as 16-bit numbers, where they fit, sort by their digits.
            order = np.argsort((key >> np.uint64(1)).astype(self.narrow), kind="stable")
            of, by = giver[order], key[order]
            first = np.ones(len(of), dtype=np.bool_)
            first[1:] = by[1:] != by[:-1]
            low = np.zeros(len(of), dtype=np.int64)
            low[1:] = of[:-1] + 1
            low[first] = 0
            shared = least.of(low, of)
            known = np.searchsorted(before, by[first])
            held = np.zeros(len(known), np.uint32)
            found = known < len(before)
            found[found] = before[known[found]] == by[first][found]
            held[found] = since[known[found]]
            shared[first] = np.minimum(shared[first], held)

            new = np.empty(len(of), TUPLE)
            new["key"], new["pos"] = by, pos[of] - 1
            same = by >> np.uint64(1) == keys[of] >> np.uint64(1)
            new["run"] = np.where(same, run[of] + np.uint32(1), 1)
            new["lcp"] = np.minimum(shared + np.uint32(1), cap)
            queue.push(new)

            final = np.append(first[1:], True)[: len(of)]
            tail = np.full(int(final.sum()), UNCUT)
            rest = of[final] < end
            tail[rest] = least.of(of[final][rest] + 1, np.full(int(rest.sum()), end))
            kept = np.ones(len(before), dtype=np.bool_)
            kept[known[found]] = False
            whole = np.minimum(since[kept], least.of(np.zeros(1, np.int64), np.full(1, end)))
            before = np.concatenate((before[kept], by[final]))
            since = np.concatenate((whole, tail))
            order = np.argsort(before, kind="stable")[: len(before)]
            order = order[since[order] > 0]
            before, since = before[order], since[order]

    def both(self, seeds: Iterable[np.ndarray], cap: np.uint32) -> Iterator[np.ndarray]:
        """All suffixes in falling order, from the leftmost ascending ones in rising order."""
        descending = Tape(self.disk, SUFFIX)
        for rows, induced in self.induced(seeds, False, cap):
            descending.write(rows[induced])
        for rows, _ in self.induced(descending.turned(), True, cap):
            yield rows
        descending.drop()

    def named(self) -> tuple[np.ndarray, int, np.ndarray]:
        """The string of names of the substrings between peaks, how many there are, their groups."""
        count = len(self.peaks)
        length = self.disk.array(np.uint32, self.n // 2 + 1)
        for low in range(0, count, BATCH):
            here = np.array(self.peaks[low : low + BATCH + 1])
            after = np.append(here[1:], self.n - 1) if low + BATCH >= count else here[1:]
            here = here[: len(after)]
            length[here >> 1] = after - here + 1

        def unsorted() -> Iterator[np.ndarray]:
            # By first symbol alone: one pass per group of symbols keeps memory bounded.
            queue = TupleQueue(self.disk, self._edges(False))
            for low in range(0, count, BATCH):
                here = np.array(self.peaks[low : low + BATCH])
                rows = np.empty(len(here), TUPLE)
                rows["key"], rows["pos"] = 2 * self.text[here].astype(np.uint64) + np.uint64(1), here
                rows["run"], rows["lcp"] = 1, 1
                queue.push(rows[np.argsort(rows["key"], kind="stable")])
            while len(rows := queue.peek(lambda below: None, BATCH)):
                out = np.empty(len(rows), SUFFIX)
                for name in ("pos", "run", "lcp"):
                    out[name] = rows[name]
                queue.take(len(rows))
                yield out

        name = self.disk.array(np.uint32, self.n // 2 + 1)
        samples, seen, current = [], 0, -1
        least, last_length = UNCUT, np.uint32(0)
        for rows in self.both(unsorted(), UNCUT):
            pos = rows["pos"]
            peak = np.flatnonzero((pos > 0) & self.up[pos] & ~self.up[np.maximum(pos - 1, 0)])
            if not len(peak):
                least = min(least, rows["lcp"].min())
                continue
            shared = np.minimum.reduceat(rows["lcp"][: peak[-1] + 1], np.append(0, peak[:-1] + 1))
            shared[0] = min(least, rows["lcp"][: peak[0] + 1].min())
            own = length[pos[peak] >> 1]
            other = np.concatenate(([last_length], own[:-1]))
            new = (own != other) | (shared < own)
            rank = current + np.cumsum(new)
            name[pos[peak] >> 1] = rank
            samples.append(rank[(-seen) % BUCKET :: BUCKET])
            seen, current, last_length = seen + len(peak), int(rank[-1]), own[-1]
            rest = rows["lcp"][peak[-1] + 1 :]
            least = min(UNCUT, rest.min()) if len(rest) else UNCUT
        symbols = current + 1
        text = self.disk.array(np.uint32, count)
        for low in range(0, count, BATCH):
            here = np.array(self.peaks[low : low + BATCH])
            text[low : low + BATCH] = current - name[here >> 1]
        picked = np.concatenate(samples).astype(np.int64) if samples else np.zeros(0, np.int64)
        falling = current - picked
        hot = falling[1:][falling[1:] == falling[:-1]]
        starts = np.unique(np.concatenate(([0], falling, hot, hot + 1)))
        return text, symbols, starts[starts < max(symbols, 1)]

    def peaks_in_order(self, cap: np.uint32) -> Iterator[np.ndarray]:
        """The leftmost ascending suffixes in rising order, with their common prefixes."""
        if not len(self.peaks):
            return
        text, symbols, starts = self.named()
        if len(text) <= self.disk.memory or symbols == len(text):
            blocks = doubled(np.asarray(text), cap) if len(text) <= self.disk.memory else distinct(text, self.disk)
        else:
            below, tape = Level(self.disk, text, symbols, starts), Tape(self.disk, SUFFIX)
            for rows in below.both(below.peaks_in_order(cap), cap):
                tape.write(rows)
            del below
            blocks = tape.turned()
        last = -1
        for rows in blocks:
            prior = np.concatenate(([max(last, 0)], rows["pos"][:-1]))
            here, there = self.peaks[rows["pos"]], self.peaks[prior]
            names = rows["lcp"].astype(np.int64)
            skip = np.minimum(names, len(self.peaks) - 1 - np.maximum(rows["pos"], prior))
            equal = np.minimum(self.peaks[rows["pos"] + skip] - here, int(cap))
            equal[names >= cap] = cap
            equal = self.compared(here, there, equal, int(cap))
            if last < 0:
                equal[0] = 0
            last = rows["pos"][-1]
            out = np.empty(len(rows), SUFFIX)
            out["pos"], out["run"], out["lcp"] = here, self.runs(here), equal
            yield out

    def compared(self, here: np.ndarray, there: np.ndarray, equal: np.ndarray, cap: int) -> np.ndarray:
        """Common prefixes of suffixes that are known to agree in their first ``equal`` symbols."""
        equal, left, wide = equal.copy(), np.flatnonzero(equal < cap), 16
        while len(left):
            for low in range(0, len(left), BATCH):
                some = left[low : low + BATCH]
                ours = np.minimum((here[some] + equal[some])[:, None] + np.arange(wide), self.n - 1)
                others = np.minimum((there[some] + equal[some])[:, None] + np.arange(wide), self.n - 1)
                unlike = self.text[ours] != self.text[others]
                step = np.where(unlike.any(axis=1), unlike.argmax(axis=1), wide)
                equal[some] += step
                left[low : low + BATCH] = np.where(step == wide, some, -1)
            left = left[left >= 0]
            left = left[(equal[left] < cap) & (here[left] != there[left])]
        return np.minimum(equal, cap)


def distinct(text: np.ndarray, disk: Disk) -> Iterator[np.ndarray]:
    """Suffixes of a string whose symbols all differ and are 0, 1, 2, ...: in order of their symbols."""
    place = disk.array(np.int64, len(text))
    for low in range(0, len(text), BATCH):
        here = np.array(text[low : low + BATCH])
        place[here] = np.arange(low, low + len(here))
    for low in range(0, len(text), BATCH):
        rows = np.zeros(len(place[low : low + BATCH]), SUFFIX)
        rows["pos"] = place[low : low + BATCH]
        yield rows


def doubled(text: np.ndarray, cap: np.uint32) -> Iterator[np.ndarray]:
    """Suffixes of a string in memory, ordered by ever longer prefixes."""
    n, width = len(text), 1
    ranks = [text.astype(np.int64)]
    while True:
        rank = ranks[-1]
        if width >= n or rank.max() == n - 1:
            break
        ahead = np.zeros(n, dtype=np.int64)
        ahead[: n - width] = rank[width:] + 1
        pair = rank * (n + 1) + ahead
        order = np.argsort(pair)
        rising = pair[order]
        new = np.empty(n, dtype=np.int64)
        new[order] = np.append(0, np.cumsum(rising[1:] != rising[:-1]))
        ranks.append(new)
        width *= 2
    order = np.empty(n, dtype=np.int64)
    order[ranks[-1]] = np.arange(n)
    ours, others = order[1:].copy(), order[:-1].copy()
    lcp = np.zeros(n, dtype=np.int64)
    for level in range(len(ranks) - 2, -1, -1):
        rank, step = ranks[level], 1 << level
        inside = (ours < n) & (others < n)
        same = np.zeros(n - 1, dtype=np.bool_)
        same[inside] = rank[ours[inside]] == rank[others[inside]]
        lcp[1:][same] += step
        ours[same] += step
        others[same] += step
    for low in range(0, n, BATCH):
        rows = np.zeros(len(order[low : low + BATCH]), SUFFIX)
        rows["pos"] = order[low : low + BATCH]
        rows["lcp"] = np.minimum(lcp[low : low + BATCH], cap)
        yield rows


def shard_text(disk: Disk, parts: Iterable[bytes], total: int, count: int) -> np.ndarray:
    """The symbols of ``count`` parts of ``total`` bytes, each ended by a symbol of its own.

    The ends are the least symbols, in order of the parts, so no common prefix goes beyond one.
    """
    text = disk.array(np.uint32, total + count)
    at = 0
    for number, part in enumerate(parts):
        text[at : at + len(part)] = np.frombuffer(part, np.uint8)
        text[at : at + len(part)] += np.uint32(count)
        text[at + len(part)] = number
        at += len(part) + 1
    return text


def suffixes(disk: Disk, text: np.ndarray, ends: int, reach: int) -> Iterator[np.ndarray]:
    """Places in falling suffix order with the common prefix, up to ``reach``, with either neighbour.

    Yields ``SUFFIX`` rows; ``lcp`` is the greater of the two.
    """
    starts = np.unique(np.concatenate((np.arange(0, ends, BUCKET), np.arange(ends, ends + 256))))
    level = Level(disk, text, ends + 256, starts)
    cap = np.uint32(reach)
    held = np.zeros(0, SUFFIX)
    for rows in level.both(level.peaks_in_order(cap), cap):
        rows = np.concatenate((held, rows))
        held = rows[-1:].copy()
        out = rows[:-1].copy()
        np.maximum(rows["lcp"][:-1], rows["lcp"][1:], out=out["lcp"])
        yield out
    yield held
