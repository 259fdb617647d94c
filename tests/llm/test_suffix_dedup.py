"""Induced sorting against plain sorting, repeated bytes against plain counting."""

import hashlib
import random
from collections import Counter
from unittest.mock import MagicMock

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import induced_sort, suffix_dedup

from .cases import frame, odd_rows, prose, saved, with_clashes


def plain_order(parts, reach):
    """Suffixes in falling order with the longest common prefix with either neighbour."""
    symbols = []
    for number, part in enumerate(parts):
        symbols += [byte + len(parts) for byte in part] + [number]
    order = sorted(range(len(symbols)), key=lambda at: symbols[at:])

    def common(a, b):
        count = 0
        while max(a, b) + count < len(symbols) and symbols[a + count] == symbols[b + count]:
            count += 1
        return count

    near = [0, *(common(a, b) for a, b in zip(order, order[1:])), 0]
    return order[::-1], [min(reach, max(pair)) for pair in zip(near, near[1:])][::-1]


def sorted_parts(parts, reach, memory):
    """The order, and how many files it took."""
    with induced_sort.spill_folder() as folder:
        disk = induced_sort.Disk(folder, memory)
        text = induced_sort.shard_text(disk, parts, sum(map(len, parts)), len(parts))
        rows = np.concatenate([r.copy() for r in induced_sort.suffixes(disk, text, len(parts), reach)])
    return (rows["pos"].tolist(), rows["lcp"].tolist()), disk._files


@pytest.mark.parametrize("memory", [2, 17, 1 << 21])
def test_induced_order_is_the_plain_order(monkeypatch, memory):
    rng = random.Random(memory)
    for _ in range(25):
        monkeypatch.setattr(induced_sort, "BATCH", rng.choice([1, 3, 64, 1 << 16]))
        monkeypatch.setattr(induced_sort, "BUCKET", rng.choice([1, 2, 1 << 15]))
        letters = range(97, 97 + rng.choice([1, 2, 3, 26]))
        base = bytes(rng.choice(letters) for _ in range(60))
        parts = []
        for _ in range(rng.randrange(1, 8)):
            at = rng.randrange(50)
            own = bytes(rng.choice(letters) for _ in range(rng.randrange(1, 50)))
            parts.append(rng.choice([base[at : at + rng.randrange(1, 40)], own]))
        reach = rng.choice([3, 10, 1000])
        assert sorted_parts(parts, reach, memory)[0] == plain_order(parts, reach)


def test_levels_beyond_memory_lie_on_disk():
    rng = random.Random(5)
    parts = [bytes(rng.choice(b"abc") for _ in range(3000)) for _ in range(3)]
    on_disk, files = sorted_parts(parts, 50, 500)
    in_memory, none = sorted_parts(parts, 50, 1 << 20)
    assert on_disk == in_memory and files > 20 and none == 0


def plain_removal(rows, reach):
    texts = [(row[0], (row[1] or "").encode()) for row in rows]
    seen = Counter(t[at : at + reach] for _, t in texts for at in range(len(t) - reach + 1))
    out = []
    for key, text in texts:
        gone = np.zeros(len(text) + 1, dtype=bool)
        for at in range(len(text) - reach + 1):
            if seen[text[at : at + reach]] > 1:
                gone[at : at + reach] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out.append((key, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def near_rows():
    """Copies, shared passages at all offsets, periodic texts, and one passage in a third of all rows."""
    rng = random.Random(3)
    shared = [prose(rng, 40, 5000) for _ in range(4)]
    rows = odd_rows()
    for at in range(60):
        parts = [prose(rng, rng.randrange(1, 30), 5000), rng.choice(shared), prose(rng, 20, 5000)]
        if at % 3 == 0:
            parts.append(shared[0][:170])
        rows.append((2000 + at, " ".join(parts), "en", "s", 1))
    rows.append((3000, "ab" * 700, "en", "s", 1))
    rows.append((3001, "x" + "ab" * 500 + "y", "en", "s", 1))
    return [r if r[0] != 1003 else (1003, r[1][:6000], *r[2:]) for r in rows]


@pytest.mark.parametrize("hot", [1, 1024])
def test_removed_bytes_are_those_of_plain_counting(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rows = near_rows()
    for reach in (150, 400) if hot > 1 else (150,):
        found = suffix_dedup.removed(with_clashes(frame(spark, rows)), reach=reach)
        assert sorted(map(tuple, found.collect()), key=repr) == plain_removal(rows, reach)


def test_groups_decided_by_weight_are_not_sorted(spark, monkeypatch):
    rng = random.Random(8)
    text = prose(rng, 200, 5000).encode()
    strings = [
        (1, 10, 11, 2, text[:170]),  # alone, two occurrences
        (2, 20, 21, 1, b"ab" * 100),  # alone, repeats in itself only
        (3, 30, 31, 3, text[200:400]),  # two with several occurrences each
        (3, 32, 33, 2, text[220:420]),
        (4, 40, 41, 2, text[500:660]),  # one of several, one of a single occurrence
        (4, 42, 43, 1, b"?" + text[500:655] + b"!"),
        (5, 50, 51, 1, text[700:900]),  # alone, no repeat
    ]
    sorted_ = []

    def watched(parts, keys, reach, plain=suffix_dedup._repeated):
        sorted_.extend(parts)
        return plain(parts, keys, reach)

    monkeypatch.setattr(suffix_dedup, "_repeated", watched)
    frame_ = MagicMock()
    frame_.agg.return_value.first.return_value = (0,)
    frame_.sparkSession.sparkContext.defaultParallelism = 1
    dealt = frame_.select.return_value.repartition.return_value.sortWithinPartitions.return_value
    dealt.mapInArrow.side_effect = lambda sort, schema: sort
    sort = suffix_dedup._sorted(frame_, 150)
    columns = [pa.array(column) for column in zip(*strings)]
    batch = pa.RecordBatch.from_arrays(columns, ["group", "c1", "c2", "weight", "bytes"])
    # A group goes on in the next batch.
    found = [tuple(r.values()) for out in sort(iter([batch[:3], batch[3:]])) for r in out.to_pylist()]
    assert sorted(found) == [
        (10, 11, 0, 21),
        (20, 21, 0, 51),
        (30, 31, 0, 51),
        (32, 33, 0, 51),
        (40, 41, 0, 11),
        (42, 43, 1, 7),
    ]
    assert sorted_ == [strings[at][4] for at in (1, 4, 5, 6)]


def test_ranges_of_hot_strings_are_as_few_as_those_of_others(spark, monkeypatch):
    rng = random.Random(9)
    shared = [prose(rng, 90, 5000) for _ in range(2)]
    rows = [
        (at, at, 1, " ".join((prose(rng, 9, 5000), shared[at % 2], prose(rng, 9, 5000))).encode())
        for at in range(12)
    ]
    texts = spark.createDataFrame(rows, "k1 long, k2 long, weight long, bytes binary")

    def windows(hot):
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        return sorted(map(tuple, suffix_dedup._windows(texts, 150, 0, None).collect()))

    few = windows(1024)
    assert few and windows(1) == few


def test_spans_and_kept_bytes_make_up_the_text(spark):
    rows = near_rows()
    texts = Counter((r[0], r[1] or "") for r in rows)
    for row in suffix_dedup.without_repeats(frame(spark, rows)).collect():
        matching = [t for key, t in texts if key == row.id and len(t.encode()) == row.n_bytes]
        assert any(
            b"".join(t.encode()[a:b] for a, b in zip(
                [0, *(s.end for s in row.spans)], [*(s.start for s in row.spans), row.n_bytes]
            )) == bytes(row.kept)
            for t in matching
        )


def test_registered_query(spark, tmp_path):
    from ledgerloom.llm.registered import QUERIES

    rows = near_rows()
    folder = saved(frame(spark, rows), tmp_path)
    found = QUERIES["op11_suffix_dedup"](spark, folder)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == plain_removal(rows, 400)
    empty = saved(frame(spark, []), tmp_path / "empty")
    assert QUERIES["op11_suffix_dedup"](spark, empty).count() == 0
