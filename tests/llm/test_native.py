"""Quality rules, sharding and mixing against plain Python over the same rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import mixing, quality_rules, registered, sharding
from tests.llm.cases import frame, odd_rows, prose, saved, with_clashes, words_of


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def counts(text):
    words = words_of(text)
    lines = [line for line in (text or "").split("\n") if words_of(line)]
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i : i + 3])] > 1:
            inside |= {i, i + 1, i + 2}
    return (
        len(words),
        sum(map(len, words)),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(inside),
    )


def repetitive(seed):
    rng = random.Random(seed)
    return [
        (i, prose(rng, rng.randrange(1, 120), rng.choice([2, 3, 8, 40, 400])), "en", "s", 1)
        for i in range(120)
    ] + [
        (900, "a | b | c\n" * 40, "en", "s", 1),
        (901, "a a a a a a a a", "en", "s", 1),
        (902, "$$$ %%% &&& " * 30, "en", "s", 1),
        (903, "LOUD WORDS THE " * 30, "en", "s", 1),
    ]


def test_measures_equal_a_plain_count(spark):
    rows = odd_rows() + repetitive(3)
    got = quality_rules.quality(frame(spark, rows)).collect()
    ours = Counter(
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in got
    )
    plain = Counter()
    for doc_id, text, *_ in rows:
        n = counts(text)
        plain[(doc_id, *n, n[0] < 50 or 100 * n[4] > 50 * n[0])] += 1
    assert ours == plain
    assert not any(r.kept and r.base_failed for r in got)


def test_rules_reject_junk_and_keep_prose(spark):
    rng = random.Random(5)
    good = [(i, prose(rng, 150, 4000), "en", "s", 1) for i in range(40)]
    bad = [
        (100, "\n".join(["the same line again and again of it"] * 30), "en", "s", 1),
        (101, " ".join(f"W{i}&&& $$$" for i in range(80)), "en", "s", 1),
        (102, " ".join(f"THE W{'ABCDEFGH'[i % 8]}{i}X" for i in range(80)), "en", "s", 1),
        (103, " ".join("x" * 40 + str(i) for i in range(80)), "en", "s", 1),
    ]
    kept = {r.doc_id for r in quality_rules.quality(frame(spark, good + bad)).filter("kept").collect()}
    assert kept == set(range(40))


def test_passing_keeps_rows_as_they_came(spark):
    docs = with_clashes(frame(spark, odd_rows()))
    out = quality_rules.passing(docs)
    assert out.columns == docs.columns
    kept = quality_rules.quality(docs).filter("kept").count()
    assert 0 < kept == out.count()
    assert out.exceptAll(docs).count() == 0
    assert quality_rules.passing(docs.limit(0)).count() == 0


def test_a_rule_table_can_be_changed(spark):
    docs = frame(spark, odd_rows())
    rules = (quality_rules.Rule("n_words", low=60, high=100),)
    kept = quality_rules.quality(docs, rules).filter("kept").collect()
    assert kept and all(60 <= r.n_words <= 100 for r in kept)


def test_quality_is_one_native_projection(spark):
    plan = plan_of(quality_rules.quality(frame(spark, odd_rows())))
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def jump(key, shards):
    key &= 2**64 - 1
    last, at = -1, 0
    while at < shards:
        last = at
        key = (key * 2862933555777941757 + 1) % 2**64
        at = int((last + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return last


@pytest.mark.parametrize("shards", [1, 2, 8, 100])
def test_jumps_equal_the_plain_loop(spark, shards):
    rng = random.Random(shards)
    keys = [0, 1, -1, 2**63 - 1, -(2**63)] + [rng.randrange(-(2**63), 2**63) for _ in range(400)]
    df = spark.createDataFrame([(k,) for k in keys], "k BIGINT")
    got = df.select("k", sharding.shard_of(F.col("k"), shards).alias("s")).collect()
    assert {r.k: r.s for r in got} == {k: jump(k, shards) for k in keys}


def test_sharding_follows_its_law(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_SLICE", 3)
    rows = odd_rows(clean=200)
    out = sharding.sharded(with_clashes(frame(spark, rows)), 8).collect()
    assert len(out) == len(rows)
    expected = Counter()
    for doc_id, text, *_ in rows:
        data = (text or "").encode()
        key = zlib.crc32(data) if doc_id is None else doc_id
        expected[(doc_id, len(data) + 1, zlib.crc32(data), jump(key, 8), jump(key, 9))] += 1
    assert expected == Counter(
        (r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in out
    )
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 8)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert "Python" not in plan_of(sharding.sharded(frame(spark, rows), 8))


def test_sharding_an_empty_table(spark):
    assert sharding.sharded(frame(spark, []), 8).count() == 0


def goals(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """The limits reached one after another, until nothing is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, full = share * sum(sizes.values()), set()
    while True:
        rest = budget - sum(most * sizes[s] for s in full)
        share_of = sum(weight[s] for s in order if s not in full)
        rate = rest / share_of if share_of else 0
        above = {s for s in order if s not in full and rate * weight[s] > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in full else rate * weight[s] for s in order}
        full |= above


@pytest.mark.parametrize("seed", range(3))
def test_targets_equal_repeated_resharing(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 5, 100, 5000, 90000]) for i in range(rng.randrange(1, 12))}
    sizes[None] = 700
    df = spark.createDataFrame(list(sizes.items()), "source STRING, source_size BIGINT")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert got == pytest.approx(goals(sizes))


def skewed(seed, count=900):
    rng = random.Random(seed)
    return [
        (i, prose(rng, rng.randrange(0, 60)), "en", rng.choice(["hot", "hot", "a", "b", None, "é"]), 1)
        for i in range(count)
    ]


def test_mix_meets_targets_and_reruns_agree(spark):
    rows = skewed(2) + odd_rows()
    docs = with_clashes(frame(spark, rows))
    first, second = (
        Counter(tuple(r) for r in mixing.mixed_documents(docs.repartition(n)).collect()) for n in (3, 7)
    )
    assert first == second and sum(first.values()) == len(rows)
    sizes, taken, largest = Counter(), Counter(), Counter()
    for (_, size, source_size, target, times, source, _), n in first.items():
        sizes[source] += size * n
        taken[source] += size * times * n
        largest[source] = max(largest[source], size)
        assert 0 <= times <= 2
    wanted = goals(sizes)
    for source in sizes:
        assert abs(taken[source] - wanted[source]) <= largest[source] / 2 + 1e-6
    for (_, _, source_size, target, _, source, _) in first:
        assert source_size == sizes[source] and target == pytest.approx(wanted[source])


def test_mix_equals_a_sorted_walk(spark):
    """The threshold by histograms is where a walk in order of the hash would stop."""
    rows = skewed(4)
    got = {r.doc_id: r.times for r in mixing.mixed_documents(frame(spark, rows)).collect()}
    by_source = defaultdict(list)
    for doc_id, text, _, source, _ in rows:
        key = hashlib.md5(f"{doc_id}\x1f{text or ''}".encode()).hexdigest()[:12]
        by_source[source].append((int(key, 16), len(words_of(text)), doc_id))
    wanted = goals({s: sum(x[1] for x in v) for s, v in by_source.items()})
    for source, items in by_source.items():
        whole = sum(x[1] for x in items)
        rounds = int(wanted[source] // whole)
        rest = wanted[source] - rounds * whole
        below = 0
        for _, size, doc_id in sorted(items):
            extra = below + size < rest or (below < rest and rest - below >= size / 2)
            assert got[doc_id] == rounds + (1 if extra and size else 0) or size == 0
            below += size


def test_repeated_rows_are_taken_in_part(spark):
    rows = [(1, "one two three four", "en", "a", 1)] * 100 + [(i, "x y", "en", "b", 1) for i in range(2, 400)]
    out = mixing.mixed_documents(frame(spark, rows)).filter("source = 'a'").collect()
    target = out[0].target
    assert abs(sum(r["size"] * r["times"] for r in out) - target) <= 2


def test_mixture_repeats_rows(spark):
    rows = skewed(6) + odd_rows()
    docs = with_clashes(frame(spark, rows))
    out = mixing.mixture(docs)
    assert out.columns == docs.columns
    taken = mixing.mixed_documents(docs).filter("size > 0").agg(F.sum("times")).first()[0]
    blank = mixing.mixed_documents(docs).filter("size = 0").count()
    assert out.count() == taken + blank
    plan = plan_of(out)
    assert "Python" not in plan and "Arrow" not in plan
    assert mixing.mixture(docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op1_quality_rules", "op2_jump_sharding", "op8_mixing"])
def test_registered_over_odd_rows(spark, tmp_path, name):
    folder = saved(with_clashes(frame(spark, odd_rows())), tmp_path)
    assert registered.QUERIES[name](spark, folder).count() == len(odd_rows())


def test_clean_text_of_a_language_without_listed_stop_words_is_kept(spark):
    from ledgerloom.llm import quality_rules

    text = " ".join(f"слово{chr(0x430 + i % 30)}{chr(0x430 + i // 30)}" for i in range(80))
    rows = [(i, text, lang) for i, lang in enumerate(["ru", "EN-us", "en", None, "el"])]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING")
    # Without a label the script tells that the list has nothing to say.
    assert sorted(r.doc_id for r in quality_rules.passing(docs).collect()) == [0, 3, 4]
    assert quality_rules.passing(docs.drop("lang")).count() == 5
