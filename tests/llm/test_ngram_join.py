"""The similarity join against all pairs in plain Python."""

import random
from collections import Counter

import pytest

from ledgerloom.llm import ngram_join, registered
from ledgerloom.llm.components import components
from tests.llm.cases import frame, odd_rows, prose, saved, with_clashes, words_of


def gram_set(text, size=5):
    words = words_of((text or "").lower())
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def plain_join(rows, threshold=0.8):
    sets = [gram_set(row[1]) for row in rows]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)

    def least(group):
        ids = [rows[i][0] for i in group if rows[i][0] is not None]
        return min(ids, default=None)

    out = Counter()
    for i, row in enumerate(rows):
        if sets[i]:
            same = [j for j in range(len(rows)) if root(j) == root(i) and sets[j]]
            copies = [j for j in range(len(rows)) if sets[j] == sets[i]]
            out[(row[0], least(same), least(copies), links[i])] += 1
        else:
            out[(row[0], row[0], row[0], 0)] += 1
    return out


def near_copies(seed, groups=12, most=14):
    rng, rows = random.Random(seed), []
    for _ in range(groups):
        base = prose(rng, rng.randrange(4, 120)).split(" ")
        for _ in range(rng.randrange(1, most)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 9])):
                words[rng.randrange(len(words))] = f"new{rng.randrange(50)}"
            text = " ".join(words)
            rows.append((5000 + len(rows), text.upper() if rng.random() < 0.1 else text, "en", "s", 1))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,block", [(1, 1024), (2, 3)])
def test_join_equals_all_pairs(spark, monkeypatch, seed, block):
    """Also when every bucket is cut into blocks."""
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", block)
    rows = near_copies(seed, 20) + odd_rows()
    got = Counter(tuple(r) for r in ngram_join.similar_documents(with_clashes(frame(spark, rows))).collect())
    assert got == plain_join(rows)


def test_one_of_each_keeps_one_row_of_every_group(spark):
    rows = near_copies(5, 20) + odd_rows()
    docs = with_clashes(frame(spark, rows))
    out = ngram_join.one_of_each(docs)
    assert out.columns == docs.columns
    got = out.collect()
    classes = Counter(c for (_, c, *_), n in plain_join([r for r in rows if words_of(r[1])]).items())
    blank = sum(not words_of(r[1]) for r in rows)
    assert len(got) == len(classes) + blank
    with_ids = sorted(r.doc_id for r in got if words_of(r.text) and r.doc_id is not None)
    assert with_ids == sorted(c for c in classes if c is not None)


def test_banding_reaches_its_recall():
    bands, rows = ngram_join.banding(0.8, 0.99999, 100)
    assert bands * rows <= 100 and 1 - (1 - 0.8**rows) ** bands >= 0.99999
    with pytest.raises(ValueError):
        ngram_join.banding(0.1, 0.99999, 10)


def test_empty_table(spark):
    assert ngram_join.similar_documents(frame(spark, [])).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(i, 100) for i in range(150, 170)]
    got = components(spark.createDataFrame(edges + edges[:5], "u BIGINT, v BIGINT")).collect()
    assert {r.node: r.root for r in got} == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 170)}
    assert len(got) == 111


def test_registered(spark, tmp_path):
    folder = saved(frame(spark, odd_rows()), tmp_path)
    assert registered.QUERIES["op5_ngram_join"](spark, folder).count() == len(odd_rows())
