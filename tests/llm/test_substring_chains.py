"""Repeated passages against all windows of 50 words, and chains against all orders of matches."""

import random
from itertools import combinations

import numpy as np
import pytest

from ledgerloom.llm import registered
from ledgerloom.llm import substring_chains as s
from tests.llm.cases import frame, odd_rows, prose, saved, with_clashes, words_of


def documents(seed):
    """Ordinary texts, some with passages of others: exact, changed in places, at either end."""
    rng = random.Random(seed)
    passages = [prose(rng, rng.randrange(55, 140), 3000) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [prose(rng, rng.randrange(5, 120), 3000) for _ in range(rng.randrange(1, 3))]
        if rng.random() < 0.7:
            passage = rng.choice(passages)
            if rng.random() < 0.4:
                words = passage.split(" ")
                for at in range(rng.randrange(4, 12), len(words), rng.randrange(12, 20)):
                    words[at] = f"changed{i}"
                passage = " ".join(words)
            parts.insert(rng.randrange(len(parts) + 1), passage)
        rows.append((i, "\n".join(parts), "en", "s", 1))
    rows.append((70, " ".join(["again"] * 300), "en", "s", 1))
    rows.append((71, "other start " + " ".join(["again"] * 200), "en", "s", 1))
    return rows


def repeated_windows(rows, size=50):
    """Windows of a document that a document with a lesser id has too."""
    first, found = {}, []
    for doc_id, text, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        words = words_of((text or "").lower())
        for at in range(len(words) - size + 1):
            window = tuple(words[at : at + size])
            if first.setdefault(window, doc_id) != doc_id:
                found.append((doc_id, at))
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_every_repeated_window_is_in_a_passage(spark, seed):
    rows = documents(seed)
    got = s.repeated_passages(with_clashes(frame(spark, rows))).collect()
    windows = [w for w in repeated_windows(rows) if w[0] < 70]
    assert len(windows) > 300
    for doc_id, at in windows:
        assert any(r.doc_id == doc_id and r.start_word <= at and at + 50 <= r.end_word for r in got)
    assert {r.partner_id for r in got if r.doc_id == 71} == {70}
    texts = {row[0]: words_of(row[1].lower()) for row in rows}
    for r in got:
        one, two = texts[r.doc_id][r.start_word : r.end_word], texts[r.partner_id][r.partner_start : r.partner_end]
        assert r.partner_id < r.doc_id and len(one) == r.end_word - r.start_word >= 50
        assert s._common(np.array(one), np.array(two)) >= r.matched >= 0.8 * max(len(one), len(two))


def test_clean_documents_have_no_passage(spark):
    rng = random.Random(8)
    line = prose(rng, 20, 3000)
    rows = [(i, line + "\n" + prose(rng, 150, 20000), "en", "s", 1) for i in range(60)]
    assert s.repeated_passages(frame(spark, rows)).count() == 0


def test_chains_are_best_in_order():
    rng = random.Random(4)
    for _ in range(60):
        matches = sorted({(rng.randrange(60), rng.randrange(60)) for _ in range(rng.randrange(1, 9))})

        def worth(chain):
            gaps = sum((b[0] - a[0]) + (b[1] - a[1]) for a, b in zip(chain, chain[1:]))
            return s.SEED * len(chain) - s.GAP_COST * gaps

        ordered = [
            c
            for n in range(1, len(matches) + 1)
            for c in combinations(matches, n)
            if all(a[0] < b[0] and a[1] < b[1] for a, b in zip(c, c[1:]))
        ]
        out = s.chains(matches)
        assert worth(out[0]) == pytest.approx(max(map(worth, ordered)))
        assert sorted(m for c in out for m in c) == matches


def test_seeds_of_a_shared_stretch_are_shared():
    rng = random.Random(6)
    shared = [f"x{i}" for i in range(s.SEED + s.WINDOW - 1)]
    for _ in range(50):
        texts = [" ".join([f"{side}{rng.random()}" for _ in range(rng.randrange(40))] + shared + [side] * 30) for side in "ab"]
        owner, _, hashes = s.minimizers(s.Words(texts))
        assert set(hashes[owner == 0]) & set(hashes[owner == 1])


def test_cutting_keeps_first_copies(spark):
    rows = documents(3) + [(None, "kept as it is", "en", "s", 1)]
    docs = with_clashes(frame(spark, rows))
    out = s.without_passages(docs, s.repeated_passages(docs))
    assert out.columns == docs.columns and out.count() == len(rows)
    left = [(r.doc_id, r.text, None) for r in out.collect()]
    assert not [w for w in repeated_windows(left) if w[0] < 70]
    assert {r[0]: r[1] for r in left}[0] == rows[0][1]


def test_odd_rows(spark, tmp_path):
    rows = odd_rows()
    got = {(r.doc_id, r.partner_id) for r in s.repeated_passages(with_clashes(frame(spark, rows))).collect()}
    long_enough = len(words_of(rows[3][1])) >= 50
    assert ({(1004, 3), (1005, 3)} <= got) == long_enough
    assert s.repeated_passages(frame(spark, [])).count() == 0
    assert registered.QUERIES["op4_substring_chains"](spark, saved(frame(spark, rows), tmp_path)).count() == len(got)


def fresh(rng, count):
    return [f"n{rng.randrange(10**9)}" for _ in range(count)]


def spans(got, doc_id):
    return sorted((r.start_word, r.end_word, r.partner_id) for r in got if r.doc_id == doc_id)


def test_passages_around_unlike_text_are_both_found(spark):
    rng = random.Random(11)
    header, footer = fresh(rng, 60), fresh(rng, 60)
    rows = [(i, " ".join(header + fresh(rng, 150) + footer), "en", "s", 1) for i in (1, 2)]
    assert spans(s.repeated_passages(frame(spark, rows)).collect(), 2) == [(0, 60, 1), (210, 270, 1)]


def test_each_repeat_within_a_document_is_found(spark):
    rng = random.Random(12)
    passage = fresh(rng, 70)
    rows = [
        (1, " ".join(fresh(rng, 20) + passage + fresh(rng, 20)), "en", "s", 1),
        (2, " ".join(passage + fresh(rng, 90) + passage + fresh(rng, 90) + passage), "en", "s", 1),
    ]
    got = s.repeated_passages(frame(spark, rows)).collect()
    assert spans(got, 2) == [(0, 70, 1), (160, 230, 1), (320, 390, 1)]


def test_passage_whose_parts_earlier_documents_have(spark):
    rng = random.Random(13)
    passage = fresh(rng, 60)
    texts = {1: passage[:40], 2: passage[20:], 7: passage, 10: passage}
    rows = [(i, " ".join(fresh(rng, 80) + own + fresh(rng, 80)), "en", "s", 1) for i, own in texts.items()]
    # A phrase of the passage that the anchor also has before it.
    rows += [(20, " ".join(passage[:30] + fresh(rng, 90) + passage), "en", "s", 1)]
    got = s.repeated_passages(frame(spark, rows)).collect()
    assert spans(got, 10) == [(80, 140, 7)] and spans(got, 20) == [(120, 180, 7)] and len(got) == 2


def test_windows_in_runs_are_covered(spark):
    rng = random.Random(14)
    lines = [" ".join(fresh(rng, k)) for k in (1, 3, 20)]
    texts = [" ".join(fresh(rng, 9) + [one] * n + fresh(rng, 30) + [two] * m) for one in lines for two in lines for n, m in ((90, 60), (70, 130))]
    rows = [(i, text, "en", "s", 1) for i, text in enumerate(texts)]
    got = s.repeated_passages(frame(spark, rows)).collect()
    windows = repeated_windows(rows)
    assert windows
    missed = [
        (doc, at) for doc, at in windows
        if not any(r.doc_id == doc and r.start_word <= at and at + 50 <= r.end_word for r in got)
    ]
    assert not missed
