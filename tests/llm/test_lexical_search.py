"""Ranked search against plain scoring with sets of words."""

import math
import re
from collections import Counter

import pytest

from ledgerloom.llm import lexical_search

from .cases import frame, odd_rows, with_clashes

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ITEMS = [
    (1, "W1 w2 w2, w3!"),
    (2, "nothing-of-this occurs zzz"),
    (3, None),
    (4, ""),
    (5, "É é ñ 漢字 the"),
    (6, "W1 w2 w2, w3!"),
    (6, "w7"),
    (None, "the w9 w1"),
    (8, "words, that COUNT; that"),
]


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(rows, items, most):
    docs = [(row[0], terms(row[1])) for row in rows]
    n_docs, n_terms = sum(1 for _, t in docs if t), sum(len(t) for _, t in docs)
    holding = Counter(term for _, t in docs for term in set(t))
    out = []
    for item, text in items:
        scored = []
        for key, words in docs:
            tf, score = Counter(words), 0
            for term in terms(text):
                if tf[term]:
                    m = 25 + (75 * len(words) * n_docs) // n_terms
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[term] + 1)))
                    score += w * ((1000000000 * tf[term]) // (1000 * tf[term] + 8 * m))
            if score:
                scored.append((-score, key is None, key))
        for rank, (score, _, key) in enumerate(sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:most], 1):
            out.append((item, rank, key, -score))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes, held, at_once", [(1 << 20, 1 << 18, 1 << 21), (8, 0, 3)])
def test_ranked_as_plainly(spark, monkeypatch, block_bytes, held, at_once):
    monkeypatch.setattr(lexical_search, "HELD", held)
    monkeypatch.setattr(lexical_search, "SCORES_AT_ONCE", at_once)
    rows = odd_rows()
    docs = with_clashes(frame(spark, rows)).withColumnRenamed("hash", "k1").repartition(4)
    items = with_clashes(spark.createDataFrame(ITEMS, "item_id BIGINT, text STRING"))
    found = lexical_search.ranked(docs, items, 4, block_bytes=block_bytes)
    assert sorted(map(tuple, found.collect()), key=repr) == plain(rows, ITEMS, 4)


def test_empty_tables(spark):
    some = spark.createDataFrame(ITEMS, "item_id BIGINT, text STRING")
    assert lexical_search.ranked(frame(spark, []), some).count() == 0
    assert lexical_search.ranked(frame(spark, odd_rows()), some.limit(0)).count() == 0
