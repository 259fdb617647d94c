"""The pipeline's stages one after another, each against the plain form on its own input."""

import random
from collections import Counter

import corpus_pipeline
from ledgerloom.llm import decontamination, mixing, quality_rules
from tests.llm.cases import frame, odd_rows, prose, saved, with_clashes, words_of
from tests.llm.test_native import jump
from tests.llm.test_ngram_join import near_copies, plain_join


def world():
    rng = random.Random(9)
    item = prose(rng, 40, 4000)
    rows = [(i, prose(rng, rng.randrange(55, 120), 3000), "en", f"s{i % 5}", 1) for i in range(120)]
    rows += [(3000 + i, prose(rng, 60, 3000) + " " + item, "en", "s1", 1) for i in range(10)]
    rows += [(4000, "$$$ &&& " * 60, "en", "s2", 1)]
    odd = [(r[0] + 7000 if r[0] is not None and r[0] < 1000 else r[0], *r[1:]) for r in odd_rows(clean=7)]
    return rows + near_copies(4) + odd, item


def test_stages_one_after_another(spark, tmp_path):
    rows, item = world()
    folder = saved(frame(spark, rows), tmp_path)
    spark.createDataFrame([(1, item)], "item_id BIGINT, text STRING").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        path = f"{tmp_path}/{k}"
        out.write.parquet(path)
        before, after = [tuple(r) for r in docs.collect()], [tuple(r) for r in spark.read.parquet(path).collect()]
        if k < len(names) - 1:
            assert out.columns == docs.columns
        if k == 0:
            kept = Counter(r.doc_id for r in quality_rules.quality(docs).filter("kept").collect())
            assert Counter(r[0] for r in after) == kept and 4000 not in kept
            assert len(set(range(120)) - set(kept)) < 5
        elif k == 1:
            classes = {c for (_, c, *_), n in plain_join(before).items()}
            assert sorted(r[0] for r in after) == sorted(classes)
        elif k == 2:
            assert {r[0] for r in before} - {r[0] for r in after} == set(range(3000, 3010)) & {r[0] for r in before}
            assert len(after) < len(before)
        elif k == 3:
            times = {r.doc_id: r.times for r in mixing.mixed_documents(docs).collect()}
            assert Counter(r[0] for r in after) == Counter({i: n for i, n in times.items() if n})
        else:
            assert Counter(r[:-1] for r in after) == Counter(before)
            assert all(r[-1] == jump(r[0], 8) for r in after)
        docs = spark.read.parquet(path)
    whole = Counter(tuple(r) for r in corpus_pipeline.run(spark, folder).collect())
    assert whole == Counter(tuple(r) for r in docs.collect())
    assert decontamination.leaks(docs, spark.read.parquet(f"{folder}/benchmark.parquet")).count() == 0
    assert all(words_of(r.text) for r in docs.collect())


def test_pipeline_over_an_empty_table(spark, tmp_path):
    folder = saved(frame(spark, []), tmp_path)
    spark.createDataFrame([(1, "a b c d e f")], "item_id BIGINT, text STRING").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_clashing_columns_keep_their_values(spark, tmp_path):
    rows, item = world()
    folder = saved(with_clashes(frame(spark, rows[:60])), tmp_path)
    spark.createDataFrame([(1, item)], "item_id BIGINT, text STRING").write.parquet(f"{folder}/benchmark.parquet")
    out = corpus_pipeline.run(spark, folder)
    assert out.columns[-1] == "shard_" and out.filter("shard <> 'clash' OR key <> 'clash'").count() == 0
    assert out.filter("shard_ BETWEEN 0 AND 7").count() == out.count() > 0


def test_a_mixture_takes_what_the_plan_says_by_source(spark, monkeypatch):
    """Documents that lie in several sources, and hashes so narrow that many documents share them."""
    monkeypatch.setattr(
        mixing, "row_hash", lambda *columns: mixing.F.pmod(mixing.F.xxhash64(*columns), mixing.F.lit(7)).cast("long")
    )
    rng = random.Random(2)
    texts = [prose(rng, rng.randrange(5, 40)) for _ in range(40)]
    rows = [(i, texts[i], "en", source, i) for source in "ab" for i in range(10)]
    rows += [(i, texts[i], "en", "b", at) for i in range(10, 40) for at in range(1 + i % 3)]
    docs = frame(spark, rows).repartition(3)
    plan = Counter()
    for row in mixing.mixed_documents(docs).collect():
        plan[row.source, row.doc_id] += row.times
    found = sorted(map(tuple, mixing.mixture(docs).collect()))
    assert Counter((r[3], r[0]) for r in found) == +plan
    assert found == sorted(map(tuple, mixing.mixture(docs.repartition(5)).collect()))
