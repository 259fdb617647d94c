"""Language identification in two steps: the family, then the language within it.

Texts are measured by their shares of hashed letter n-grams. One-versus-one linear support vector
machines tell families apart, and others tell apart the languages of one family; the winner of a
step is the class that wins the most duels, then the one with the larger margins.

The machines are fitted on at most about ``TRAIN_ROWS`` different labelled texts, the same number
for each language, picked by a hash. Scoring reads every text whole.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is all if
nothing could be learned. With one language learned it is the answer for every text with a letter.
A language that ``FAMILIES`` does not list is a family of its own. Extra columns are not looked at.
"""

from __future__ import annotations

import re
from fractions import Fraction
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.wordhash import mixed, pieces, texts_of

TRAIN_ROWS = 2000
BUCKETS = 1 << 13
SIZES = (2, 3, 4)
ROUNDS, COST = 60, 1e-3
# Closely related languages by their ISO 639-1 codes.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "indic": "bn gu hi mr ne pa sd si ur",
    "turkic": "az kk ky tr tt ug uz",
    "uralic": "et fi hu",
    "semitic": "am ar he mt",
    "iranian": "fa ku ps tg",
    "celtic": "br cy ga gd",
    "baltic": "lt lv",
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes.split()}
_LETTER = re.compile(r"[^\W\d_]")
_AS_LETTER = np.arange(256, dtype=np.uint8)
_AS_LETTER[[*range(0, 97), *range(123, 128)]] = 32
_U = np.uint64


def family(lang: str) -> str:
    return _FAMILY.get(lang.split("-")[0].lower(), lang)


def _buckets(texts: list[str]):
    """The n-gram buckets of the texts in joined form, and where each text begins and ends."""
    parts = [b" " + text.lower().encode() + b" " * max(SIZES) for text in texts]
    bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    data = _AS_LETTER[np.frombuffer(b"".join(parts), dtype=np.uint8)].astype(_U)
    code, found = data[:], []
    for size in range(2, max(SIZES) + 1):
        code = code[:-1] * _U(257) + data[size - 1 :]
        if size in SIZES:
            found.append((mixed(code + _U(size << 50)) >> _U(51)).astype(np.int64))
    return found, bounds


def _shares(texts: list[str]) -> np.ndarray:
    """One row per text: the share of each bucket among the n-grams of its text."""
    found, bounds = _buckets(texts)
    out = np.zeros((len(texts), BUCKETS), dtype=np.float32)
    for codes in found:
        for i, (low, high) in enumerate(zip(bounds[:-1], bounds[1:])):
            some = codes[low : high - max(SIZES) + 1]
            out[i] += np.bincount(some, minlength=BUCKETS).astype(np.float32) / (len(some) * len(SIZES))
    return out


def _machine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and, last, the bias of a linear SVM with squared hinge loss; ``y`` is -1 or 1.

    Accelerated gradient descent; the classes weigh the same.
    """
    x = np.hstack((x, np.ones((len(x), 1), dtype=np.float32)))
    balance = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum()).astype(np.float32)
    step = 1.0 / (2 * float(np.max((x * x).sum(1))) + COST)
    weights = ahead = np.zeros(x.shape[1], dtype=np.float32)
    for turn in range(ROUNDS * 5):
        short = np.maximum(0, 1 - y * (x @ ahead)) * balance * y
        new = ahead + step * (2 * (short @ x) - COST * ahead)
        ahead = new + turn / (turn + 3) * (new - weights)
        weights = new.astype(np.float32)
        ahead = ahead.astype(np.float32)
    return weights


class Model:
    """Families, languages, and the duels among each: pairs of classes and their machines."""

    def __init__(self, shares: np.ndarray, langs: list[str]):
        self.langs = sorted(set(langs))
        self.families = sorted({family(lang) for lang in self.langs})
        # Rare n-grams count as much as frequent ones.
        scale = 1 / np.sqrt(shares.mean(0) + 1e-5) if len(shares) else np.ones(BUCKETS)
        x = shares * scale.astype(np.float32)
        own, groups = np.array(langs), np.array([family(lang) for lang in langs])
        self.duels: list[tuple[str, str]] = []
        machines = []
        for labels, classes in [(groups, self.families)] + [
            (own, [lang for lang in self.langs if family(lang) == name]) for name in self.families
        ]:
            for a, b in combinations(classes, 2):
                rows = (labels == a) | (labels == b)
                machines.append(_machine(x[rows], np.where(labels[rows] == a, 1, -1).astype(np.float32)))
                self.duels.append((a, b))
        table = np.array(machines, dtype=np.float32).reshape(len(machines), BUCKETS + 1)
        self.bias = table[:, -1]
        self.weights = np.ascontiguousarray((table[:, :-1] * scale.astype(np.float32)).T)

    def margins(self, texts: list[str]) -> np.ndarray:
        found, bounds = _buckets(texts)
        total = np.zeros((len(texts), len(self.duels)), dtype=np.float64)
        tail = max(SIZES) - 1
        for codes in found:
            count = np.diff(bounds) - tail
            for duel in range(len(self.duels)):
                values = self.weights[:, duel][codes]
                # N-grams that run over into the next text do not count.
                sums = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
                total[:, duel] += (sums[bounds[:-1] + count] - sums[bounds[:-1]]) / (count * len(SIZES))
        return total + self.bias

    def _winner(self, classes: list[str], margins: dict) -> tuple[str, float]:
        wins = {}
        for one in classes:
            own = [margins[one, two] for two in classes if two != one]
            wins[one] = (sum(m > 0 for m in own), sum(own), min(own, default=np.inf))
        best = max(sorted(classes), key=lambda one: wins[one][:2])
        return best, 1.0 / (1.0 + np.exp(-2.0 * wins[best][2]))

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        if not self.langs:
            return [("und", 0.0)] * len(texts)
        out = []
        for row in self.margins(texts):
            duels = {}
            for (a, b), margin in zip(self.duels, row.tolist()):
                duels[a, b], duels[b, a] = margin, -margin
            name, sure = self._winner(self.families, duels)
            lang, own = self._winner([x for x in self.langs if family(x) == name], duels)
            out.append((lang, float(sure * own)))
        return out


def hash_limit(wanted: int, among: int) -> int:
    """The greatest 63-bit hash that is taken when about ``wanted`` of ``among`` are; never below zero."""
    return min(1, Fraction(wanted, among)) * (2**63 - 1) // 1


def fit(rows: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """A model of ``text, lang``, from texts whose hash is below a share for each language.

    A text counts once in a language, however many rows have it.
    """
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "text", "lang", F.xxhash64("text", F.lit("language")).alias("hash")
    )
    different = rows.select("lang", "hash").distinct()
    counts = {r.lang: r["count"] for r in different.groupBy("lang").count().collect()}
    if not counts:
        return Model(np.zeros((0, BUCKETS), dtype=np.float32), [])
    each = max(20, train_rows // len(counts))
    limits = F.create_map(*(F.lit(v) for lang, n in counts.items() for v in (lang, hash_limit(each, n))))
    some = rows.filter(F.shiftrightunsigned("hash", 1) <= limits[F.col("lang")])

    def measure(batches):
        seen = set()
        for batch in pieces(batches):
            keys = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            new = [i for i, key in enumerate(keys) if not (key in seen or seen.add(key))]
            batch = batch.take(pa.array(new, pa.int64()))
            shares = _shares(texts_of(batch))
            places = [np.flatnonzero(row).astype(np.int32) for row in shares]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    batch.column(2),
                    pa.array([p.tobytes() for p in places], pa.binary()),
                    pa.array([row[p].tobytes() for row, p in zip(shares, places)], pa.binary()),
                ],
                ["lang", "hash", "places", "shares"],
            )

    found = (
        some.mapInArrow(measure, "lang string, hash long, places binary, shares binary")
        .dropDuplicates(["lang", "hash"])
        .collect()
    )
    missing = set(counts) - {row.lang for row in found}
    if missing:
        raise ValueError(f"no training text was drawn for {sorted(missing)}")
    found.sort(key=lambda r: (r.lang, bytes(r.shares)))
    shares = np.zeros((len(found), BUCKETS), dtype=np.float32)
    for i, row in enumerate(found):
        shares[i, np.frombuffer(row.places, dtype=np.int32)] = np.frombuffer(row.shares, dtype=np.float32)
    return Model(shares, [row.lang for row in found])


def predicted(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its id, ``lang_pred`` and ``score``."""
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches):
        for batch in pieces(batches):
            texts = texts_of(batch)
            lettered = [i for i, text in enumerate(texts) if text and _LETTER.search(text)]
            out = [("und", 0.0)] * len(texts)
            if lettered:
                for i, answer in zip(lettered, shared.value.predict([texts[i] for i in lettered])):
                    out[i] = answer
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([o[0] for o in out]), pa.array([o[1] for o in out], pa.float64())],
                [id_col, "lang_pred", "score"],
            )

    return docs.select(F.col(id_col), F.col(text_col).alias("text")).mapInArrow(
        predict, f"`{id_col}` {kind}, lang_pred string, score double"
    )


def fold(id_col: str, parts: int) -> Column:
    """The checksum of an id as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts
