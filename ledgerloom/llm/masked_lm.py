"""Masked pseudo-likelihood: a bidirectional window network scores every token from both sides.

A network with one hidden layer sees the embeddings of ``SIDE`` words left and right of a place and
gives a distribution over the word there: first over groups of the vocabulary, then within one. A
document's score is the sum of the log-probabilities of its words, each given its neighbours.

The vocabulary is the most frequent words of the whole corpus; other words share ``OTHERS`` entries
by their hash. Training reads all documents, in rounds of which each has its share of them: a task
trains a copy of the network on the masked places of its documents, and the copies are averaged by
the number of places they saw. Copies are added up in ``MERGERS`` partial sums on the executors, so
what reaches the driver does not grow with the corpus.

Defined results: a null or blank text has no token and the score 0; repeated rows count as often as
they occur; places beyond a text are an entry of their own; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.stored import stored
from ledgerloom.llm.wordhash import Words, mixed, multipliers, pieces, texts_of

GROUPS = 32
VOCABULARY, OTHERS = GROUPS * GROUPS, 256
SIDE, WIDTH, HIDDEN = 2, 16, 32
MASKED = 0.15
ROUNDS = (1, 3, 4)
BATCH, RATE = 2048, 0.1
MERGERS = 16
TALLY_ROWS = 1 << 20
_U = np.uint64


@dataclass
class Network:
    """The parameters, in one flat array, and their shapes."""

    flat: np.ndarray

    SHAPES = {
        "embed": (VOCABULARY + 1, WIDTH),
        "inner": (2 * SIDE * WIDTH, HIDDEN),
        "inner_bias": (HIDDEN,),
        "group": (HIDDEN, GROUPS),
        "group_bias": (GROUPS,),
        "member": (GROUPS, HIDDEN, GROUPS),
        "member_bias": (GROUPS, GROUPS),
    }

    @classmethod
    def size(cls) -> int:
        return sum(int(np.prod(shape)) for shape in cls.SHAPES.values())

    @classmethod
    def initial(cls, shares: np.ndarray | None = None) -> Network:
        """Small values that are the same everywhere; biases that give each entry its share."""
        noise = (multipliers(cls.size(), 23) >> _U(40)).astype(np.float32) / (1 << 24) - 0.5
        net = cls(noise)
        for name, part in net.parts().items():
            part *= 0.0 if name.endswith("bias") else 2 / np.sqrt(max(part.shape[-2], 1) if name != "embed" else 1)
        if shares is not None:
            table = shares.reshape(GROUPS, GROUPS)
            net.parts()["group_bias"][:] = np.log(table.sum(1))
            net.parts()["member_bias"][:] = np.log(table)
        return net

    def parts(self, flat: np.ndarray | None = None) -> dict[str, np.ndarray]:
        """Views of the parameters, or of an array like them, by name."""
        flat, at, out = self.flat if flat is None else flat, 0, {}
        for name, shape in self.SHAPES.items():
            size = int(np.prod(shape))
            out[name] = flat[at : at + size].reshape(shape)
            at += size
        return out

    def hidden(self, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = self.parts()
        x = p["embed"][around].reshape(len(around), -1)
        return x, np.tanh(x @ p["inner"] + p["inner_bias"])

    def log_probability(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        p, group, member = self.parts(), target // GROUPS, target % GROUPS
        _, h = self.hidden(around)
        out = _log_softmax_at(h @ p["group"] + p["group_bias"], group)
        order, cuts = _by_group(group)
        for g in range(GROUPS):
            rows = order[cuts[g] : cuts[g + 1]]
            if len(rows):
                out[rows] += _log_softmax_at(h[rows] @ p["member"][g] + p["member_bias"][g], member[rows])
        return out

    def gradient(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Of the mean log-probability."""
        p, group, member = self.parts(), target // GROUPS, target % GROUPS
        flat = np.zeros_like(self.flat)
        d, n = self.parts(flat), np.float32(len(target))
        x, h = self.hidden(around)
        error = _residual(h @ p["group"] + p["group_bias"], group) / n
        d["group"] += h.T @ error
        d["group_bias"] += error.sum(0)
        back = error @ p["group"].T
        order, cuts = _by_group(group)
        for g in range(GROUPS):
            rows = order[cuts[g] : cuts[g + 1]]
            if len(rows):
                some = h[rows]
                error = _residual(some @ p["member"][g] + p["member_bias"][g], member[rows]) / n
                d["member"][g] += some.T @ error
                d["member_bias"][g] += error.sum(0)
                back[rows] += error @ p["member"][g].T
        back *= 1 - h * h
        d["inner"] += x.T @ back
        d["inner_bias"] += back.sum(0)
        np.add.at(d["embed"], around.ravel(), (back @ p["inner"].T).reshape(-1, WIDTH))
        return flat


def _by_group(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(group.astype(np.int16), kind="stable")
    return order, np.concatenate(([0], np.cumsum(np.bincount(group, minlength=GROUPS))))


def _log_softmax_at(scores: np.ndarray, at: np.ndarray) -> np.ndarray:
    scores -= scores.max(1, keepdims=True)
    chosen = scores[np.arange(len(at)), at]
    return chosen - np.log(np.exp(scores, out=scores).sum(1))


def _residual(scores: np.ndarray, at: np.ndarray) -> np.ndarray:
    scores -= scores.max(1, keepdims=True)
    np.exp(scores, out=scores)
    scores /= -scores.sum(1, keepdims=True)
    scores[np.arange(len(at)), at] += 1
    return scores


class Vocabulary:
    """Entries of the frequent words by their hashes; the rest by a remainder.

    ``shares`` is how often each entry occurs, where the other words share theirs evenly.
    """

    def __init__(self, hashes: list[int], times: list[int] = (), total: int = 0):
        counts = np.ones(VOCABULARY)
        counts[: len(times)] += times
        counts[VOCABULARY - OTHERS :] += (total - sum(times)) / OTHERS
        self.shares = counts / counts.sum()
        given = np.array(hashes, dtype=np.int64).view(_U)
        self.order = np.argsort(given)
        self.sorted = given[self.order]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        others = VOCABULARY - OTHERS + (hashes % _U(OTHERS)).astype(np.int64)
        if not len(self.sorted):
            return others
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return np.where(self.sorted[at] == hashes, self.order[at], others)


def _places(texts, vocabulary: Vocabulary) -> tuple[Words, np.ndarray, np.ndarray]:
    """The words of the texts, their entries, and the entries around each."""
    words = Words(texts)
    ids = vocabulary.ids(words.hashes)
    gap = np.full(SIDE, VOCABULARY)
    counts = words.counts()
    # Between two texts stand SIDE empty places.
    at = np.arange(len(ids)) + np.repeat(np.arange(1, len(counts) + 1) * SIDE, counts)
    padded = np.full(len(ids) + SIDE * (len(counts) + 1), VOCABULARY)
    padded[at] = ids
    steps = [step for step in range(-SIDE, SIDE + 1) if step]
    around = np.stack([padded[at + step] for step in steps], 1) if len(ids) else gap[:0].reshape(0, 2 * SIDE)
    return words, ids, around


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, times`` of all words of ``text``, by hash; tasks add up before they send."""

    def tally(batches: Iterator[pa.RecordBatch]):
        def sums(parts):
            keys = np.concatenate([k for k, _ in parts])
            words, where = np.unique(keys, return_inverse=True)
            return words, np.bincount(where, np.concatenate([c for _, c in parts])).astype(np.int64)

        def packed(part):
            return pa.RecordBatch.from_arrays(
                [pa.array(part[0].view(np.int64)), pa.array(part[1])], ["word", "times"]
            )

        held, size = [], 0
        for batch in pieces(batches):
            held.append(np.unique(Words(texts_of(batch)).hashes, return_counts=True))
            size += len(held[-1][0])
            if size > TALLY_ROWS:
                held = [sums(held)]
                size = len(held[0][0])
                if size > TALLY_ROWS // 2:
                    yield packed(held[0])
                    held, size = [], 0
        if held:
            yield packed(sums(held))

    return docs.select("text").mapInArrow(tally, "word long, times long").groupBy("word").agg(
        F.sum("times").alias("times")
    )


def fit_vocabulary(docs: DataFrame) -> Vocabulary:
    counts = stored(word_counts(docs), "lm-word-counts")
    total = counts.agg(F.sum("times")).first()[0] or 0
    top = counts.orderBy(F.desc("times"), "word").limit(VOCABULARY - OTHERS).collect()
    return Vocabulary([row.word for row in top], [row.times for row in top], total)


def _trained(batches, net: Network, vocabulary: Vocabulary) -> tuple[np.ndarray, int]:
    """A copy of the network after a pass over the masked places of the rows."""
    net = Network(net.flat.copy())
    power, seen = np.full_like(net.flat, 1e-6), 0
    for batch in pieces(batches):
        words, ids, around = _places(texts_of(batch), vocabulary)
        place = np.arange(len(ids), dtype=_U) - np.repeat(words.first[:-1], words.counts()).astype(_U)
        drawn = mixed(words.hashes ^ mixed(place + _U(1)))
        chosen = np.flatnonzero(drawn < _U(int(MASKED * 2**64)))
        chosen = chosen[np.argsort(drawn[chosen], kind="stable")]
        for low in range(0, len(chosen), BATCH):
            some = chosen[low : low + BATCH]
            step = net.gradient(around[some], ids[some])
            power += step * step
            net.flat += np.float32(RATE) * step / np.sqrt(power)
            seen += len(some)
    return net.flat, seen


def train(docs: DataFrame, vocabulary: Vocabulary, rounds=ROUNDS) -> Network:
    """A network trained on all rows of ``text``, each in one round."""
    context = docs.sparkSession.sparkContext
    net, low, size = Network.initial(vocabulary.shares), 0, sum(rounds)
    share = F.pmod(F.xxhash64("text", F.lit("round")), F.lit(size))

    def copies(batches):
        flat, seen = _trained(batches, start.value[0], start.value[1])
        if seen:
            task = mixed(np.array([seen + int(np.abs(flat).sum() * 1e6)], dtype=_U))[0]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(task % _U(MERGERS))], pa.int32()),
                    pa.array([seen], pa.int64()),
                    pa.array([(flat.astype(np.float64) * seen).astype(np.float32).tobytes()], pa.binary()),
                ],
                ["merger", "seen", "weights"],
            )

    def merged(batches):
        total, seen = np.zeros(Network.size()), 0
        for batch in batches:
            for row in batch.to_pylist():
                total += np.frombuffer(row["weights"], dtype=np.float32)
                seen += row["seen"]
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([seen], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["seen", "weights"]
            )

    for width in rounds:
        start = context.broadcast((net, vocabulary))
        some = docs.filter((share >= low) & (share < low + width)).select("text")
        sums = (
            some.mapInArrow(copies, "merger int, seen long, weights binary")
            .repartition(MERGERS, "merger")
            .sortWithinPartitions("seen")
            .mapInArrow(merged, "seen long, weights binary")
            .collect()
        )
        seen = sum(row.seen for row in sums)
        if seen:
            sums.sort(key=lambda row: row.seen)
            total = sum(np.frombuffer(row.weights, dtype=np.float64) for row in sums)
            net = Network((total / seen).astype(np.float32))
        low += width
    return net


def scored(
    docs: DataFrame, net: Network, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row its id, ``n_tokens``, ``log_prob`` (summed) and ``mean_log_prob``."""
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((net, vocabulary))

    def score(batches):
        net, vocabulary = shared.value
        for batch in pieces(batches):
            words, ids, around = _places(texts_of(batch), vocabulary)
            values = np.empty(len(ids))
            for low in range(0, len(ids), 4 * BATCH):
                some = slice(low, low + 4 * BATCH)
                values[some] = net.log_probability(around[some], ids[some])
            sums = np.concatenate(([0.0], np.cumsum(values)))
            total = sums[words.first[1:]] - sums[words.first[:-1]]
            counts = words.counts()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(total),
                    pa.array(np.divide(total, counts, out=np.zeros_like(total), where=counts > 0)),
                ],
                [id_col, "n_tokens", "log_prob", "mean_log_prob"],
            )

    return docs.select(F.col(id_col), F.col(text_col).alias("text")).mapInArrow(
        score, f"`{id_col}` {kind}, n_tokens long, log_prob double, mean_log_prob double"
    )


def pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fit on all texts and score all texts."""
    texts = docs.select(F.col(text_col).alias("text"))
    vocabulary = fit_vocabulary(texts)
    return scored(docs, train(texts, vocabulary), vocabulary, id_col, text_col)
