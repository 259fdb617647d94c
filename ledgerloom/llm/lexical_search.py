"""Ranked lexical search without a document index: two scans of the texts by an Aho-Corasick automaton.

The terms of the items make up one automaton. Terms are guarded by a boundary on either side, and so
are the words of a text, so that only whole words match; a match gives the term's number, and through
it the items that ask for it. The first scan counts documents per term and the size of all documents,
the second scores each document from its counts alone. Each task keeps its best documents per item.

A term is a run of letters and digits, where all characters beyond ASCII count as letters; only A to Z
are lower-cased. Scores are whole numbers, a form of BM25: see ``weights`` and ``Block.scores``.

Items come in blocks of about ``BLOCK_BYTES`` of different texts (or one item, if it is longer); each
block is one automaton, shipped to the tasks with the scan. Documents are scanned twice per block.

Defined results: null and empty texts have no terms and match nothing; an item without terms, or whose
terms occur nowhere, has no rows; repeated documents and repeated items are ranked row by row; equal
scores rank by ascending id, null ids last; empty tables give no rows; other columns are not looked
at. A text of any length is scanned whole, and its counts hold at most the block's terms.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.llm.stored import stored
from ledgerloom.llm.wordhash import pieces, texts_of

BLOCK_BYTES = 4 << 20
BEST = 10
# Candidates a task holds beyond its best ones before it sorts them out.
HELD = 1 << 18
SCORES_AT_ONCE = 1 << 21

# Every byte that is no letter or digit becomes a blank; bytes beyond ASCII belong to letters.
_TERMS = bytes(
    b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TERMS).split() if text else []


class Block:
    """The items of one block: their terms' automaton, and per term the items that ask for it."""

    def __init__(self, texts: list[str]):
        counts = [Counter(terms_of(text)) for text in texts]
        self.items = len(texts)
        self.terms = sorted(set().union(*counts))
        number = {term: at for at, term in enumerate(self.terms)}
        asked = sorted((number[term], item, times) for item, c in enumerate(counts) for term, times in c.items())
        term, self.item, self.times = (np.array(column, dtype=np.int64) for column in zip(*asked))
        self.first = np.searchsorted(term, np.arange(len(self.terms) + 1))
        self._automaton = None

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    @property
    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            self._automaton = ahocorasick.Automaton()
            for at, term in enumerate(self.terms):
                self._automaton.add_word(f" {term.decode('latin-1')} ", at)
            self._automaton.make_automaton()
        return self._automaton

    def counts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per document and matched term: document, term, occurrences; and all terms per document."""
        sizes = np.zeros(len(texts), dtype=np.int64)
        found, ends = [], np.zeros(len(texts), dtype=np.int64)
        for at, text in enumerate(texts):
            words = terms_of(text)
            if words:
                sizes[at] = len(words)
                guarded = f" {b' '.join(words).decode('latin-1')} "
                found += [term for _, term in self.automaton.iter(guarded)]
            ends[at] = len(found)
        doc = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
        pairs, times = np.unique(doc * len(self.terms) + np.array(found, dtype=np.int64), return_counts=True)
        return pairs // len(self.terms), pairs % len(self.terms), times, sizes

    def scores(self, texts, weight: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
        """The score of each document for each item."""
        doc, term, times, sizes = self.counts(texts)
        norm = 25 + (75 * sizes * n_docs) // n_terms
        part = weight[term] * ((1_000_000_000 * times) // (1000 * times + 8 * norm[doc]))
        width = self.first[term + 1] - self.first[term]
        total = np.cumsum(width)
        asked = np.arange(total[-1] if len(total) else 0) - np.repeat(total - width - self.first[term], width)
        out = np.zeros(len(texts) * self.items, dtype=np.int64)
        place = np.repeat(doc, width) * self.items + self.item[asked]
        np.add.at(out, place, np.repeat(part, width) * self.times[asked])
        return out.reshape(len(texts), self.items)


def weights(n_docs: int, holding: list[int]) -> np.ndarray:
    """The weight of terms that so many of ``n_docs`` documents hold."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in holding], dtype=np.int64)


def _statistics(docs: DataFrame, block: Block) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all terms, and documents per term of the block."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last two places hold the documents with a term and the sum of all terms.
        total = np.zeros(len(block.terms) + 2, dtype=np.int64)
        for batch in pieces(batches):
            _, term, _, sizes = block.counts(texts_of(batch))
            total[:-2] += np.bincount(term, minlength=len(block.terms))
            total[-2] += np.count_nonzero(sizes)
            total[-1] += sizes.sum()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["place", "total"])

    sums = docs.select("text").mapInArrow(count, "place long, total long").groupBy("place").agg(F.sum("total"))
    total = np.zeros(len(block.terms) + 2, dtype=np.int64)
    for place, value in sums.collect():
        total[place] = value
    return int(total[-2]), int(total[-1]), total[:-2]


def _best(held: pa.Table, most: int) -> pa.Table:
    """The first ``most`` rows of each item: highest score, then least id."""
    order = pa.compute.sort_indices(
        held, sort_keys=[("item", "ascending"), ("score", "descending"), ("id", "ascending")], null_placement="at_end"
    )
    held = held.take(order)
    item = held["item"].to_numpy()
    place = np.arange(len(item)) - np.searchsorted(item, item, "left")
    return held.filter(pa.array(place < most))


def _ranked_block(docs: DataFrame, block: Block, most: int) -> DataFrame:
    n_docs, n_terms, holding = _statistics(docs, block)
    weight = weights(n_docs, holding.tolist())
    kind = docs.schema["id"].dataType.simpleString()

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = np.ones(block.items, dtype=np.int64)
        held, size = [], 0
        step = max(1, SCORES_AT_ONCE // block.items)
        for batch in (b.slice(low, step) for b in pieces(batches) for low in range(0, b.num_rows, step)):
            scores = block.scores(texts_of(batch), weight, n_docs, n_terms)
            doc, item = np.nonzero(scores >= least)
            columns = [pa.array(item), pa.array(scores[doc, item]), batch.column(0).take(pa.array(doc))]
            held.append(pa.table(columns, ["item", "score", "id"]))
            size += len(doc)
            if size > HELD + 2 * block.items * most:
                held = [_best(pa.concat_tables(held), most)]
                items, counts = np.unique(held[0]["item"].to_numpy(), return_counts=True)
                full = items[counts == most]
                last = held[0]["score"].to_numpy()[np.cumsum(counts)[counts == most] - 1]
                least[full], size = last, len(held[0])
        if held:
            yield from _best(pa.concat_tables(held), most).to_batches()

    return docs.select("id", "text").mapInArrow(rank, f"item long, score long, id {kind}")


def _blocks(texts: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, int, str]]]:
    """Different item texts with their keys, block by block."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64(F.lit(3), F.col("text")), F.lit(count))
    for at in range(count):
        rows = texts.filter(block == at).sort("k1", "k2").collect() if size else []
        if any(terms_of(row.text) for row in rows):
            yield rows


def ranked(
    docs: DataFrame,
    items: DataFrame,
    most: int = BEST,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``most`` best documents of each item: ``item, rank, id, score``, scores above 0 only."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    asked = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    asked = asked.withColumns({f"k{seed}": F.xxhash64(F.lit(seed), F.col("text")) for seed in (1, 2)})
    texts = stored(
        asked.filter("text IS NOT NULL").groupBy("k1", "k2").agg(F.first("text").alias("text")), "search-items"
    )
    best = Window.partitionBy("k1", "k2").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    found = None
    for rows in _blocks(texts, block_bytes):
        keys = docs.sparkSession.createDataFrame(
            [(at, row.k1, row.k2) for at, row in enumerate(rows)], "item long, k1 long, k2 long"
        )
        some = _ranked_block(docs, Block([row.text for row in rows]), most).join(keys, "item").drop("item")
        # Each block is done before the next is read, so that one automaton is alive at a time.
        some = stored(some.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= most), "search-best")
        found = some if found is None else found.unionByName(some)
    if found is None:
        kind = docs.schema["id"].dataType.simpleString()
        found = docs.sparkSession.createDataFrame([], f"k1 long, k2 long, score long, id {kind}, rank int")
    return asked.select("item", "k1", "k2").join(found, ["k1", "k2"]).select("item", "rank", "id", "score")
