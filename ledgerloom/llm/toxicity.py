"""Toxicity by a weighted finite-state grammar over clauses.

A lexicon turns the words of a clause into symbols: insult, threat, target, negation, report. Insults
are roots that labelled documents teach, so they hold for any language and inflection, but for words
that the same documents show to be benign. The other classes start from lists, and the labelled
documents add negations and reports: words before a root where documents with that root are clean.

Transducers are tables of weighted arcs. One marks what a report governs, one what a negation reaches,
one insults after a target; ``composed`` makes one machine of the three, which reads a clause from the
left. A fourth reads its output from the right, joins insults and threats with targets that follow, and
so ends the match. Weights are log-odds and add up along a match: the root's and those of the arcs, each
from the share of toxic documents among the labelled ones that take the arc, starting from a prior. A
document's score is the chance that at least one of its matches is toxic. Reading is linear in the text.

Roots are learned on at most about ``TRAIN_ROWS`` labelled rows of each label, picked by a hash.
Scoring reads every text whole.

Defined results: a null or blank text has the score of a text without a match. A document labelled
twice counts as toxic if one label says so. Extra columns are not looked at.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from math import exp, log

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.language_id import hash_limit
from ledgerloom.llm.stored import stored
from ledgerloom.llm.wordhash import pieces, texts_of

TRAIN_ROWS = 4000
ROOT_SIZES = (3, 4, 5, 6, 7, 8)
# Roots are taken in turns, the surest first; what a turn leaves uncovered is open to the next.
PRECISIONS, MIN_SUPPORT = (0.95, 0.85, 0.7), 3
# A word in so many labelled documents of which few are toxic is no insult, whatever its root.
BENIGN_DOCUMENTS, BENIGN_SHARE = 3, 0.3
NO_MATCH = 0.01
REACH = 4
# Words of the grammar in English, German, French and Spanish.
THREATS = "kill hurt destroy murder stab shoot strangle töten umbringen tuer frapper matar golpear".split()
TARGETS = (
    "you your yourself u him her them he she they everyone "
    "du dich dir ihr euch tu te toi vous tú ti usted ustedes"
).split()
NEGATIONS = "not no never none nicht kein keine nie pas jamais non ni nunca jamás".split()
REPORTS = (
    "said says wrote claimed called quoted reported alleged sagte schrieb behauptete dit écrit "
    "affirme dijo escribió afirma"
).split()
# The share of toxic documents that a pattern is taken to have before any is counted.
PRIORS = {
    "insult": 0.8,
    "targeted insult": 0.95,
    "threat": 0.95,
    "negated": 0.15,
    "reported": 0.15,
}
PRIOR_DOCUMENTS = 4
# A word before a root in so many labelled documents, of which few are toxic, negates or reports it.
CONTEXT_DOCUMENTS, CONTEXT_SHARE = 5, 0.3
_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE_END = re.compile(r"[.!?;\n]")

# Symbols: I insult, K threat, T target, N negation, R report, O other word; then J insult with a target,
# V threat with a target, n negated, r reported.
SYMBOLS = "IKTNROJVnr"
PATTERNS = {"I": "insult", "J": "targeted insult", "V": "threat", "n": "negated", "r": "reported"}


def _log_odds(share: float) -> float:
    return log(share / (1 - share))


class Transducer:
    """Weighted arcs ``(state, symbol): (output, weight, next state)``, one for each state and symbol."""

    def __init__(self, start, arcs: dict):
        self.start, self.arcs = start, arcs

    def read(self, symbols: Iterable[str]) -> list[tuple[str, float]]:
        state, out = self.start, []
        for symbol in symbols:
            written, weight, state = self.arcs[state, symbol]
            out.append((written, weight))
        return out


def composed(first: Transducer, second: Transducer) -> Transducer:
    """The one machine that reads like ``first`` and, on its output, ``second``; weights add up."""
    start = (first.start, second.start)
    arcs, seen, left = {}, {start}, [start]
    while left:
        state = left.pop()
        for symbol in SYMBOLS:
            between, weight, one = first.arcs[state[0], symbol]
            written, more, two = second.arcs[state[1], between]
            arcs[state, symbol] = (written, weight + more, (one, two))
            if (one, two) not in seen:
                seen.add((one, two))
                left.append((one, two))
    return Transducer(start, arcs)


def after_report(weight: float) -> Transducer:
    """After a report, insults and threats of the clause are somebody else's."""
    arcs = {}
    for symbol in SYMBOLS:
        arcs["own", symbol] = (symbol, 0.0, "report" if symbol == "R" else "own")
        arcs["report", symbol] = ("r", weight, "report") if symbol in "IK" else (symbol, 0.0, "report")
    return Transducer("own", arcs)


def within_reach(opening: str, rewritten: dict[str, tuple[str, float]], beyond: dict | None = None) -> Transducer:
    """States count down from ``opening``: the next ``REACH`` symbols are rewritten, others as ``beyond``."""
    arcs = {}
    for left in range(REACH + 1):
        for symbol in SYMBOLS:
            table = rewritten if left else beyond or {}
            written, weight = table.get(symbol, (symbol, 0.0))
            arcs[left, symbol] = (written, weight, REACH if symbol == opening else max(0, left - 1))
    return Transducer(0, arcs)


class Grammar:
    """The lexicon of learned roots and listed words, and the machines weighted by the patterns' shares."""

    def __init__(
        self,
        roots: dict[str, float],
        benign: Iterable[str] = (),
        shares: dict[str, float] | None = None,
        learned: dict[str, str] | None = None,
    ):
        self.roots = dict(sorted(roots.items()))
        self.benign = frozenset(benign)
        self.shares = dict(PRIORS if shares is None else shares)
        self.symbols = dict(learned or {})
        for symbol, listed in (("N", NEGATIONS), ("R", REPORTS), ("T", TARGETS), ("K", THREATS)):
            self.symbols.update(dict.fromkeys(listed, symbol))
        self._automaton = self._machines = None

    def machines(self) -> tuple[Transducer, Transducer]:
        """The composed machine that reads from the left, and the one that reads its output from the right."""
        if self._machines is None:
            odds = {name: _log_odds(share) for name, share in self.shares.items()}
            # A root's own weight holds that of an insult already.
            base = _log_odds(PRIORS["insult"])
            target = odds["targeted insult"] - base
            left = composed(
                composed(
                    after_report(odds["reported"] - base),
                    within_reach("N", dict.fromkeys("IK", ("n", odds["negated"] - base))),
                ),
                within_reach("T", {"I": ("J", target)}),
            )
            right = within_reach(
                "T",
                {"I": ("J", target), "K": ("V", odds["threat"])},
                {"I": ("I", odds["insult"] - base), "K": ("O", 0.0)},
            )
            self._machines = left, right
        return self._machines

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None, "_machines": None}

    def _seeds(self):
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            # A root that ends in a blank is a whole word.
            for root in {*self.roots, *(word + " " for word in THREATS)}:
                bare = root.rstrip()
                whole = root != bare
                before = self._automaton.get(bare, None)
                self._automaton.add_word(bare, (len(bare), whole and (before is None or before[1])))
            self._automaton.make_automaton()
        return self._automaton

    def hits(self, text: str) -> dict[int, float]:
        """Where words begin that are insults or threats, with the weight of the surest root."""
        found: dict[int, float] = {}
        for end, (size, whole) in self._seeds().iter(text):
            begin = end - size + 1
            if (begin == 0 or not text[begin - 1].isalpha()) and not (
                whole and end + 1 < len(text) and text[end + 1].isalpha()
            ):
                root = text[begin : end + 1]
                share = max(self.roots.get(root, 0), self.roots.get(root + " ", 0)) or 0.5
                found[begin] = max(found.get(begin, -99.0), log(share / (1 - share)))
        return {at: w for at, w in found.items() if _WORD.match(text, at).group() not in self.benign}

    def lexical(self, words: list[str], insults: set[int]) -> list[str]:
        """Words to symbols: I insult, K threat, T target, N negation, R report, O other."""
        return [
            "I" if i in insults and word not in self.symbols else self.symbols.get(word, "O")
            for i, word in enumerate(words)
        ]

    def patterns(self, symbols: list[str]) -> dict[int, tuple[str, float]]:
        """Matched patterns of a clause by position, each with the weight of its arcs."""
        left, right = self.machines()
        forth = left.read(symbols)
        back = right.read(symbol for symbol, _ in reversed(forth))
        return {
            i: (PATTERNS[symbol], weight + forth[i][1])
            for i, (symbol, weight) in enumerate(reversed(back))
            if symbol in PATTERNS
        }

    def clauses(self, text: str) -> Iterator[tuple[list[str], dict[int, float]]]:
        """Words of each clause that holds an insult or a threat, with their weights by position."""
        hits = sorted(self.hits(text).items())
        done = 0
        while done < len(hits):
            at = hits[done][0]
            begin = max(text.rfind(mark, 0, at) for mark in ".!?;\n") + 1
            stop = _CLAUSE_END.search(text, at)
            end = stop.start() if stop else len(text)
            weights = {}
            while done < len(hits) and hits[done][0] < end:
                weights[hits[done][0]] = hits[done][1]
                done += 1
            words = list(_WORD.finditer(text, begin, end))
            yield (
                [word.group() for word in words],
                {i: weights[word.start()] for i, word in enumerate(words) if word.start() in weights},
            )

    def matches(self, text: str | None) -> list[tuple[str, float]]:
        """Patterns of all clauses that hold an insult or a threat, each with its log-odds."""
        found = []
        for words, insults in self.clauses((text or "").lower()):
            for i, (pattern, weight) in self.patterns(self.lexical(words, set(insults))).items():
                found.append((pattern, weight + insults.get(i, 0.0)))
        return found

    def context(self, text: str | None) -> set[tuple[str, str]]:
        """Words of no class before the insults of each clause: ``N`` within reach, ``R`` anywhere."""
        found = set()
        for words, insults in self.clauses((text or "").lower()):
            symbols = self.lexical(words, set(insults))
            places = [i for i, symbol in enumerate(symbols) if symbol == "I"]
            if places:
                found.update(("R", word) for word, symbol in zip(words[: places[-1]], symbols) if symbol == "O")
            for i in places:
                near = range(max(0, i - REACH), i)
                found.update(("N", words[j]) for j in near if symbols[j] == "O")
        return found

    def score(self, text: str | None) -> float:
        clean = 1 - NO_MATCH
        for _, odds in self.matches(text):
            clean *= 1 / (1 + exp(min(odds, 700.0)))
        return 1 - clean


def labelled(docs: DataFrame, labels: DataFrame, rows: int, id_col="doc_id", text_col="text") -> DataFrame:
    """``text, toxic`` of at most about ``rows`` documents of each label."""
    marks = (
        labels.filter(F.col("toxic").isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max("toxic").alias("toxic"))
    )
    counts = {r.toxic: r["count"] for r in marks.groupBy("toxic").count().collect()}
    if not counts:
        return docs.select(F.col(text_col).alias("text"), F.lit(0).alias("toxic")).limit(0)
    limits = F.create_map(*(F.lit(v) for k, n in counts.items() for v in (k, hash_limit(rows, n))))
    some = marks.filter(F.shiftrightunsigned(F.xxhash64("id", F.lit("toxic")), 1) <= limits[F.col("toxic")])
    # The chosen ids are about ``rows`` for each label, however many documents there are.
    return (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .join(F.broadcast(some), "id")
        .select("text", "toxic")
    )


def _cover(postings: dict[str, set[int]], shares: dict[str, float], support: int) -> list[str]:
    """Roots that together cover the toxic documents: each time the one that adds the most.

    Of equals the longest goes first, since it is the surest to mean the same elsewhere.
    """
    roots, covered = [], set()
    for precision in PRECISIONS:
        heap = [
            (-len(left), -len(root), root)
            for root, docs in postings.items()
            if shares[root] >= precision and len(left := docs - covered) >= support
        ]
        heapq.heapify(heap)
        while heap:
            size, length, root = heapq.heappop(heap)
            # What a root adds only shrinks, so one that still adds as much is the best.
            left = len(postings[root] - covered)
            if left == -size:
                roots.append(root)
                covered |= postings[root]
            elif left >= support:
                heapq.heappush(heap, (-left, length, root))
    return roots


def learn(sample: DataFrame) -> Grammar:
    """A grammar from ``text, toxic``. Root counts are a Spark aggregate over the sample."""
    sample = stored(
        sample.select("text", "toxic", F.xxhash64("text").alias("doc")).distinct(), "toxic-sample"
    )
    words = sample.select(
        "doc",
        "toxic",
        F.explode(F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+"))).alias("word"),
    ).filter("word <> ''")
    benign = (
        words.groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.count("*").alias("docs"))
        .filter((F.col("docs") >= BENIGN_DOCUMENTS) & (F.col("toxic") <= BENIGN_SHARE * F.col("docs")))
        .select("word")
    )
    words = words.join(benign, "word", "left_anti")
    ends = [F.concat("word", F.lit(" "))] + [
        F.when(F.char_length("word") >= size, F.substring("word", 1, size)) for size in ROOT_SIZES
    ]
    parts = words.select("doc", "toxic", F.explode(F.array(*ends)).alias("root")).filter("root is not null").distinct()
    hit = F.col("toxic") == 1
    sure = (
        parts.groupBy("root")
        .agg(
            F.sum("toxic").alias("toxic"),
            F.count("*").alias("docs"),
            # Two checksums stand for the toxic documents that have the root.
            F.bit_xor(F.when(hit, F.xxhash64("doc", F.lit(1)))).alias("one"),
            F.bit_xor(F.when(hit, F.xxhash64("doc", F.lit(2)))).alias("two"),
        )
        .filter((F.col("toxic") >= MIN_SUPPORT) & (F.col("toxic") >= min(PRECISIONS) * F.col("docs")))
    )
    # Of roots in the same toxic documents only one can be taken: of the earliest turn, then the longest.
    share = F.col("toxic") / F.col("docs")
    turn = F.lit(0)
    for precision in PRECISIONS:
        turn += F.when(share >= precision, 0).otherwise(1)
    best = stored(
        sure.groupBy("one", "two", "toxic")
        .agg(F.min(F.struct(turn.alias("turn"), (-F.char_length("root")).alias("length"), "root", "docs")).alias("best"))
        .select("best.root", "toxic", "best.docs"),
        "toxic-roots",
    )
    shares = {row.root: row for row in best.collect()}
    postings = defaultdict(set)
    found = parts.filter(hit).join(best.select("root"), "root").select("root", "doc").toArrow()
    for batch in found.to_batches(1 << 16):
        for root, doc in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            postings[root].add(doc)
    roots = _cover(postings, {root: row.toxic / row.docs for root, row in shares.items()}, MIN_SUPPORT)
    prior = PRIORS["insult"] * PRIOR_DOCUMENTS
    smooth = {r: (shares[r].toxic + prior) / (shares[r].docs + PRIOR_DOCUMENTS) for r in roots}
    stems = [root for root in roots if not root.endswith(" ")]
    rooted = F.lit(False)
    for size in ROOT_SIZES:
        rooted |= F.substring("word", 1, size).isin([r for r in stems if len(r) == size])
    known = [row.word for row in benign.filter(rooted).collect()] if stems else []
    bare = Grammar(smooth, known)
    few = (F.col("docs") >= CONTEXT_DOCUMENTS) & (F.col("toxic") <= CONTEXT_SHARE * F.col("docs"))
    context = _taught(sample, bare.context, "symbol string, word string").filter(few).collect()
    # What reaches a root from nearby is a negation, also if it stands farther off elsewhere.
    learned = {row.word: row.symbol for row in sorted(context, key=lambda row: row.symbol, reverse=True)}
    grammar = Grammar(smooth, known, None, learned)
    counts = _taught(sample, lambda text: {(m[0],) for m in grammar.matches(text)}, "pattern string")
    shares = dict(PRIORS)
    for row in counts.collect():
        prior = PRIORS[row.pattern] * PRIOR_DOCUMENTS
        shares[row.pattern] = (row.toxic + prior) / (row.docs + PRIOR_DOCUMENTS)
    return Grammar(smooth, known, shares, learned)


def _taught(sample: DataFrame, found: Callable[[str | None], set[tuple]], columns: str) -> DataFrame:
    """What ``found`` sees in texts, with the number of toxic documents and of all that have it."""
    names = [column.split()[0] for column in columns.split(", ")]

    def rows(batches):
        for batch in pieces(batches):
            toxic = batch.column(1).to_pylist()
            seen = [(*one, t) for text, t in zip(texts_of(batch), toxic) for one in found(text)]
            if seen:
                *parts, marks = (list(part) for part in zip(*seen))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(part, pa.string()) for part in parts), pa.array(marks, pa.int32())],
                    [*names, "toxic"],
                )

    return (
        sample.select("text", F.col("toxic").cast("int").alias("toxic"))
        .mapInArrow(rows, f"{columns}, toxic int")
        .groupBy(*names)
        .agg(F.sum("toxic").alias("toxic"), F.count("*").alias("docs"))
    )


def scored(docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its id, ``score`` and the number of matched patterns."""
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(grammar)

    def score(batches):
        for batch in pieces(batches):
            texts = texts_of(batch)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([shared.value.score(text) for text in texts], pa.float64()),
                ],
                [id_col, "score"],
            )

    return docs.select(F.col(id_col), F.col(text_col).alias("text")).mapInArrow(
        score, f"`{id_col}` {kind}, score double"
    )
