"""Greedy string tiling against a plain search for the longest match."""

import random
import re
import time

import numpy as np

from ledgerloom.llm import decontamination as d
from tests.llm.cases import frame, odd_rows, prose, with_clashes


def plain_tiles(text, item, size):
    """The longest match of unmarked tokens, marked, until none is left; earliest first."""
    taken, marked, total = set(), set(), 0
    while True:
        best = None
        for i in range(len(text)):
            for j in range(len(item)):
                n = 0
                while (
                    i + n < len(text) and j + n < len(item) and text[i + n] == item[j + n]
                    and i + n not in taken and j + n not in marked
                ):
                    n += 1
                if n >= size and (best is None or n > best[2]):
                    best = i, j, n
        if best is None:
            return total
        i, j, n = best
        taken |= set(range(i, i + n))
        marked |= set(range(j, j + n))
        total += n


def tokens(text):
    return re.findall(r"[^\x00-\x20!-/:-@\[-`{-~]+", (text or "").lower())


def world(seed):
    rng = random.Random(seed)
    items = [prose(rng, rng.randrange(2, 60), 60) for _ in range(25)]
    docs = [prose(rng, rng.randrange(0, 150), 4000) for _ in range(40)]
    for i in range(40):
        item = rng.choice(items)
        words = item.split()
        cut = len(words) // 2
        form = rng.choice(["whole", "swapped", "half", "changed"])
        if form == "swapped":
            words = words[cut:] + ["between"] + words[:cut]
        elif form == "half":
            words = words[: cut - 2]
        elif form == "changed":
            words = [w if rng.random() > 0.1 else "other" for w in words]
        docs[i] += " " + " ".join(words) + " " + prose(rng, 20, 4000)
    return docs, items


def test_leaks_equal_plain_tiling(spark, monkeypatch):
    docs, items = world(3)
    expected = {}
    for i, text in enumerate(docs):
        for j, item in enumerate(items):
            if len(tokens(item)) and (n := plain_tiles(tokens(text), tokens(item), 5)):
                if n / len(tokens(item)) >= 0.5:
                    expected[i, j] = n / len(tokens(item))
    frames = (
        with_clashes(frame(spark, [(i, t, "en", "s", 1) for i, t in enumerate(docs)])),
        spark.createDataFrame(list(enumerate(items)), "item_id BIGINT, text STRING"),
    )
    whole = {(r.doc_id, r.item_id): r.coverage for r in d.leaks(*frames).collect()}
    assert whole.keys() == expected.keys() and len(expected) > 15
    assert all(abs(whole[k] - expected[k]) < 1e-9 for k in expected)
    monkeypatch.setattr(d, "BLOCK_BYTES", 500)
    blocks = {(r.doc_id, r.item_id): r.coverage for r in d.leaks(*frames).collect()}
    assert blocks == whole
    stays = {r.doc_id for r in d.clean(*frames).collect()}
    assert stays == set(range(len(docs))) - {i for i, _ in expected}
    assert d.clean(*frames).columns == frames[0].columns


def test_reordered_passages_are_tiled():
    seeds = [(i, i + 10) for i in range(6)] + [(20 + i, i) for i in range(6)]
    assert sorted(d.tiles(seeds, 5)) == [(0, 10, 10), (20, 0, 10)]


def test_overlapping_matches_are_cut():
    seeds = [(i, i) for i in range(16)] + [(40 + i, 12 + i) for i in range(10)]
    assert sorted(d.tiles(seeds, 5)) == [(0, 0, 20), (48, 20, 6)]


def test_tiles_by_length_are_the_same():
    rng = random.Random(7)
    for _ in range(400):
        words = rng.randrange(1, 5)
        text = [rng.randrange(words) for _ in range(rng.randrange(40))]
        item = [rng.randrange(words) for _ in range(rng.randrange(1, 30))]
        size = rng.randrange(1, 6)
        seeds = [
            (i, j) for i in range(len(text) - size + 1) for j in range(len(item) - size + 1)
            if text[i : i + size] == item[j : j + size]
        ]
        arrays = (np.array(x, dtype=np.uint64) for x in (text, item))
        got = d.tiles_by_length(*arrays, size)
        assert sum(n for *_, n in got) == plain_tiles(text, item, size)
        assert sorted(got) == sorted(d.tiles(seeds, size) if seeds else [])


def test_repetitive_texts_take_seconds():
    block = d._Block(["word " * 5_000, "other " * 30], 5)
    start = time.perf_counter()
    found = list(block.leaks(["word " * 50_000, "other word " * 20_000], 5, 0.5))
    assert [(i, item, share) for i, item, share, _ in found] == [(0, 0, 1.0)]
    assert time.perf_counter() - start < 20


def test_odd_rows(spark):
    docs = with_clashes(frame(spark, odd_rows()))
    odd = spark.createDataFrame(
        [(1, None), (2, ""), (None, odd_rows()[3][1]), (3, "too short"), (3, odd_rows()[35][1])],
        "item_id BIGINT, text STRING",
    )
    found = {(r.doc_id, r.item_id) for r in d.leaks(docs, odd).collect()}
    assert {(3, None), (1004, None), (1005, None)} <= found
    assert not any(item in (1, 2) for _, item in found)
    assert d.leaks(docs, odd.limit(0)).count() == 0
    assert d.leaks(docs.limit(0), odd).count() == 0
    assert d.clean(docs, odd.limit(0)).count() == len(odd_rows())
