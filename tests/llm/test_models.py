"""Language identification, toxicity and the masked model: held-out results and odd rows."""

import itertools
import math
import random
import time
import zlib

import numpy as np
import pytest

from ledgerloom.llm import language_id, masked_lm, registered, toxicity
from tests.llm.cases import frame, odd_rows, saved, with_clashes

FOLDER = "/root/testdata/sf0.01"


def test_languages_of_held_out_documents(spark):
    got = registered.QUERIES["op9_language_id"](spark, FOLDER).toPandas()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(docs, on="doc_id")
    assert len(both) == len(docs) and both.score.between(0, 1).all()
    assert (both.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in both.doc_id]).all()
    held = both[both.held_out]
    assert (held.lang == held.lang_pred).mean() >= 0.98


def test_language_model_of_few_rows(spark):
    docs = with_clashes(frame(spark, odd_rows()))
    answers = language_id.predicted(docs, language_id.fit(docs)).collect()
    assert len(answers) == len(odd_rows())
    assert {r.lang_pred for r in answers} == {"en", "und"}
    assert {r.doc_id for r in answers if r.lang_pred == "und"} >= {1000, 1001, 1002}
    none = language_id.predicted(docs, language_id.fit(docs.limit(0))).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}


def test_related_languages_are_told_apart(spark):
    rng = random.Random(2)
    syllables = {"de": ["ung", "der", "sch"], "nl": ["ij", "der", "oe"], "fr": ["eau", "le", "oi"], "xx": ["kq", "zz", "wv"]}
    rows = [
        (i, " ".join("".join(rng.choices(syllables[lang], k=3)) for _ in range(30)), lang, "s", 1)
        for i in range(240)
        for lang in [rng.choice(list(syllables))]
    ]
    model = language_id.fit(frame(spark, rows[:160]))
    assert model.families == ["germanic", "romance", "xx"] and ("de", "nl") in model.duels
    got = model.predict([r[1] for r in rows[160:]])
    assert [g[0] for g in got] == [r[2] for r in rows[160:]]


def test_margins_equal_a_plain_sum():
    rng = np.random.default_rng(1)
    texts = ["eine zeile text", "a", "", "Ünï çödé 12 …", "la casa de papel"]
    shares = language_id._shares(["der die das", "ein und", "le la les", "de la"])
    model = language_id.Model(shares, ["de", "en", "fr", "es"])
    model.weights = rng.normal(size=model.weights.shape).astype(np.float32)
    assert model.margins(texts) == pytest.approx(language_id._shares(texts) @ model.weights + model.bias, abs=1e-4)


def test_toxicity_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    got = registered.QUERIES["op3_toxicity"](spark, folder).toPandas()
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert held[held.toxic == 1].predicted.mean() >= 0.85
    assert held[held.toxic == 0].predicted.mean() <= 0.04


def test_grammar_scores_clauses():
    grammar = toxicity.Grammar({"idiot": 0.95, "scum ": 0.95})
    score = {
        text: grammar.score(text)
        for text in (
            "you idiot", "what an idiot", "you are not an idiot", "he said you idiot", "I will kill you",
            "kill the lights. you know", "scummy", "idiots", "patriotidiot", "", None, "He said so. You idiot!",
        )
    }
    assert score["you idiot"] > score["what an idiot"] > 0.7
    assert score["idiots"] > 0.7 and score["I will kill you"] > 0.7 and score["He said so. You idiot!"] > 0.7
    assert score["you are not an idiot"] < 0.7 and score["he said you idiot"] < 0.9 * score["you idiot"]
    for clean in ("kill the lights. you know", "scummy", "patriotidiot", "", None):
        assert score[clean] == pytest.approx(toxicity.NO_MATCH)


def test_composition_equals_one_after_another():
    report = toxicity.after_report(-3.0)
    negation = toxicity.within_reach("N", dict.fromkeys("IK", ("n", -2.0)))
    target = toxicity.within_reach("T", {"I": ("J", 1.5)})
    one = toxicity.composed(toxicity.composed(report, negation), target)
    for size in range(6):
        for symbols in itertools.product("IKTNRO", repeat=size):
            first = report.read(symbols)
            second = negation.read(s for s, _ in first)
            third = target.read(s for s, _ in second)
            chained = [(c[0], a[1] + b[1] + c[1]) for a, b, c in zip(first, second, third)]
            assert one.read(symbols) == chained


def test_patterns_equal_their_definition():
    grammar = toxicity.Grammar({}, (), {"insult": 0.7, "targeted insult": 0.9, "threat": 0.8, "negated": 0.2, "reported": 0.3})
    rng = random.Random(5)
    odds = {name: math.log(share / (1 - share)) for name, share in grammar.shares.items()}
    base = math.log(toxicity.PRIORS["insult"] / (1 - toxicity.PRIORS["insult"]))
    for _ in range(3000):
        symbols = rng.choices("IKTNRO", [3, 2, 2, 1, 1, 4], k=rng.randrange(14))
        expected = {}
        for i, symbol in enumerate(symbols):
            if symbol not in "IK":
                continue
            after = "T" in symbols[i + 1 : i + 1 + toxicity.REACH]
            near = after or "T" in symbols[max(0, i - toxicity.REACH) : i]
            if "R" in symbols[:i]:
                expected[i] = "reported"
            elif "N" in symbols[max(0, i - toxicity.REACH) : i]:
                expected[i] = "negated"
            elif symbol == "I":
                expected[i] = "targeted insult" if near else "insult"
            elif after:
                expected[i] = "threat"
        got = grammar.patterns(symbols)
        assert {i: pattern for i, (pattern, _) in got.items()} == expected
        for pattern, weight in got.values():
            once = odds[pattern] - (0 if pattern == "threat" else base)
            assert weight == pytest.approx(once)


def test_long_clauses_are_read_in_linear_time():
    grammar = toxicity.Grammar({"idiot": 0.95})
    start = time.perf_counter()
    assert len(grammar.matches("you idiot there " * 70_000)) == 70_000
    assert time.perf_counter() - start < 10


def test_negations_and_reports_are_learned(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        filler = ["w" + "".join(rng.choices("abcdefgh", k=4)) for _ in range(8)]
        if i % 5 == 0:
            filler.insert(4, "blargen")
        elif i % 40 == 1:
            filler[3:4] = ["zonk", "blargen"]
        elif i % 40 == 2:
            filler = ["murmelte", *filler, "blargen"]
        rows.append((" ".join(filler), int(i % 5 == 0)))
    grammar = toxicity.learn(spark.createDataFrame(rows, "text STRING, toxic INT"))
    assert grammar.symbols["zonk"] == "N" and grammar.symbols["murmelte"] == "R"
    assert grammar.score("some zonk blargen") < 0.7 < grammar.score("some blargen")
    assert grammar.score("murmelte a b c d e f blargen") < 0.7


def test_roots_are_learned_with_exceptions(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        words = [f"w{rng.choice('abcdef')}{rng.choice('ghijk')}{rng.choice('lmnop')}x" for _ in range(30)]
        toxic = int(i % 5 == 0)
        if toxic:
            words[rng.randrange(30)] = "blarg" + rng.choice(["en", "ung", "isch", "um", "ei", "or"])
        elif i % 3 == 0:
            words[4] = "blarg"
        rows.append((" ".join(words), toxic))
    grammar = toxicity.learn(spark.createDataFrame(rows, "text STRING, toxic INT"))
    assert any(root.startswith("bla") for root in grammar.roots) and "blarg" in grammar.benign
    assert grammar.score("a blargist here") > 0.7 > grammar.score("a blarg here")
    assert all((grammar.score(text) >= 0.7) == bool(toxic) for text, toxic in rows)


def test_toxicity_of_odd_rows(spark):
    docs = with_clashes(frame(spark, odd_rows()))
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (None, 1, 1), (2, 0, None)], "doc_id BIGINT, quality INT, toxic INT")
    for some in (labels, labels.limit(0)):
        grammar = toxicity.learn(toxicity.labelled(docs, some, 100))
        got = toxicity.scored(docs, grammar).collect()
        assert len(got) == len(odd_rows()) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.scored(docs.limit(0), grammar).count() == 0


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(5)
    net = masked_lm.Network(masked_lm.Network.initial().flat.astype(np.float64))
    around = rng.integers(0, masked_lm.VOCABULARY + 1, (200, 2 * masked_lm.SIDE))
    target = rng.integers(0, masked_lm.VOCABULARY, 200)
    gradient = net.gradient(around, target)
    for at in rng.choice(np.flatnonzero(np.abs(gradient) > 1e-4), 10):
        kept, sides = net.flat[at], []
        for step in (1e-5, -1e-5):
            net.flat[at] = kept + step
            sides.append(net.log_probability(around, target).mean())
        net.flat[at] = kept
        assert (sides[0] - sides[1]) / 2e-5 == pytest.approx(gradient[at], abs=1e-5)


def test_probabilities_sum_to_one():
    around = np.array([[1, 2, 3, masked_lm.VOCABULARY]] * masked_lm.VOCABULARY)
    p = masked_lm.Network.initial().log_probability(around, np.arange(masked_lm.VOCABULARY))
    assert np.exp(p).sum() == pytest.approx(1, abs=1e-3)


def test_training_beats_word_frequencies_on_held_out_text(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    train, held = docs.filter("doc_id % 5 <> 0").select("text"), docs.filter("doc_id % 5 = 0")
    vocabulary = masked_lm.fit_vocabulary(train)
    net = masked_lm.train(train.repartition(3), vocabulary)
    got = masked_lm.scored(held, net, vocabulary).toPandas()
    counts = np.ones(masked_lm.VOCABULARY)
    for row in train.toLocalIterator():
        np.add.at(counts, vocabulary.ids(masked_lm.Words([row.text]).hashes), 1)
    share = np.log(counts / counts.sum())
    plain = sum(share[vocabulary.ids(masked_lm.Words([r.text]).hashes)].sum() for r in held.collect())
    assert got.log_prob.sum() > plain
    again = masked_lm.scored(held, net, vocabulary).toPandas()
    assert (got.sort_values("doc_id").log_prob.values == again.sort_values("doc_id").log_prob.values).all()


def test_word_counts_are_whole(spark, monkeypatch):
    monkeypatch.setattr(masked_lm, "TALLY_ROWS", 50)
    rows = odd_rows()
    got = {r.word: r.times for r in masked_lm.word_counts(frame(spark, rows)).collect()}
    hashes = masked_lm.Words([r[1] for r in rows]).hashes.view(np.int64)
    words, times = np.unique(hashes, return_counts=True)
    assert got == dict(zip(words.tolist(), times.tolist()))


def test_masked_model_of_odd_rows(spark, tmp_path):
    docs = with_clashes(frame(spark, odd_rows()))
    got = registered.QUERIES["op6_masked_lm"](spark, saved(docs, tmp_path)).collect()
    assert len(got) == len(odd_rows())
    for r in got:
        assert (r.log_prob < 0) == (r.n_tokens > 0) and (r.n_tokens or r.mean_log_prob == 0)
    assert masked_lm.pseudo_likelihood(docs.limit(0)).count() == 0


def test_hash_limit_never_rounds_to_zero():
    assert language_id.hash_limit(20, 10**15) > 0 and language_id.hash_limit(20, 5) == 2**63 - 1
    assert language_id.hash_limit(1, 2) == pytest.approx(2**62)


def test_repeated_texts_are_sampled_once(spark):
    texts = [(f"der {'abcdefghij'[i]} und", "de") for i in range(10)] + [("the one", "en")] * 3000
    model = language_id.fit(spark.createDataFrame(texts, "text STRING, lang STRING"), 60)
    assert model.langs == ["de", "en"] and [g[0] for g in model.predict(["the one", "der b und"])] == ["en", "de"]
    # The text with most rows is one of 30 different ones, so all of them fit the sample of 30.
    many = [(f"text {'x' * i}", "de") for i in range(29)] + [("text again", "de")] * 3000
    seen = []
    real, language_id.Model = language_id.Model, lambda shares, langs: seen.append(len(langs))
    try:
        language_id.fit(spark.createDataFrame(many, "text STRING, lang STRING"), 30)
    finally:
        language_id.Model = real
    assert seen == [30]


def test_rare_insults_are_learned_from_a_full_sample(spark):
    rng = random.Random(9)
    spelled = ["".join(rng.choices("bcdfghjklm", k=9)) for _ in range(800)]
    rows = [(f"some text {i} you {spelled[i // 5]} here", 1) for i in range(4000)]
    rows += [(f"some text {i} you are here", 0) for i in range(4000)]
    grammar = toxicity.learn(spark.createDataFrame(rows, "text STRING, toxic INT"))
    assert np.mean([grammar.score(f"you {word} here") >= 0.7 for word in spelled]) >= 0.99


def test_cover_takes_the_root_that_adds_most():
    rng = random.Random(10)
    for _ in range(30):
        postings = {f"r{i:02d}" + "x" * rng.randrange(3): set(rng.sample(range(40), rng.randrange(1, 12))) for i in range(25)}
        shares = {root: rng.choice([0.7, 0.85, 0.95, 1.0]) for root in postings}
        roots, covered = [], set()
        for precision in toxicity.PRECISIONS:
            while True:
                open_ = {r: d - covered for r, d in postings.items() if shares[r] >= precision}
                best = max(sorted(open_), key=lambda r: (len(open_[r]), len(r)), default=None)
                if best is None or len(open_[best]) < 3:
                    break
                roots.append(best)
                covered |= open_[best]
        assert toxicity._cover(postings, shares, 3) == roots
