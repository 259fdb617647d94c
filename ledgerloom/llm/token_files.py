"""Token ids in compressed files with a shared dictionary and an offset index.

``write_tokens`` encodes texts in ascending order of their ids. Each document's ids (unsigned 32-bit,
little-endian, ended by ``END``) are one zstandard frame, compressed with a dictionary that is
trained on serialized id arrays, so that a short document can be read alone. Frames lie in blocks,
one row of Parquet each: the block's bytes, and in columns of their own the documents' ids, offsets,
lengths, token counts, and the hash of the dictionary. ``index`` and ``read_documents`` use them.

The dictionary is trained on about ``SAMPLE_DOCUMENTS`` different texts (never more than
``MOST_SAMPLES``) of at most ``SAMPLE_BYTES`` bytes, picked by a hash of id and text whose bound never
rounds to nothing. It changes the size of the files and nothing else.

Defined results: a null or empty text has the end id alone; rows without an id come first; rows with
equal ids lie in the order of a hash of their texts; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerloom.llm.wordhash import pieces, texts_of

END = 0
LEVEL = 3
BLOCK_BYTES = 1 << 20
DICTIONARY_BYTES, SAMPLE_DOCUMENTS, SAMPLE_BYTES = 1 << 16, 2000, 1 << 14
MOST_SAMPLES = 2 * SAMPLE_DOCUMENTS
KNOWN_SEGMENTS = 3 << 18
# Texts that are encoded at once, in bytes: words are looked up once for all of them.
TEXT_BYTES = 1 << 22


def _serialized(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_END = _serialized([END])
_BLANKS = "\\t\\n\\x0b\\x0c\\r "
# A stretch is a run of blanks and what follows up to the next one, cut once more where a letter or
# digit meets an ASCII mark other than the apostrophe: tokens of letters or digits end there, and words
# are then known without the marks behind them.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_LETTERS = "A-Za-z0-9\xc0-\xd6\xd8-\xf6\xf8-\xff"
_STRETCH = re.compile(
    f"[{_BLANKS}]*[^{_BLANKS}{re.escape(_MARKS)}]*[{_LETTERS}](?=[{re.escape(_MARKS)}])"
    f"|[{_BLANKS}]*[^{_BLANKS}]+|[{_BLANKS}]+"
)
# Blanks beyond ASCII may run together with ASCII ones into one token; such texts are cut only
# before blanks that follow an ASCII character.
_WIDE_BLANK = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_CUT = re.compile(f"(?<=[\\x00-\\x08\\x0e-\\x1f\\x21-\\x7f])(?=[{_BLANKS}])")

# A text with none of these (nor a blank beyond ASCII, nor one of ``_TWO_LAST`` at its end) has no space
# between two blanks and no line end between two others; it is cut before every blank.
_RUNS = ("  ", " \n", "\n\n ", "\n\n\n", "\t", "\r", "\x0b", "\x0c")
_TWO_LAST = ("\n ", "\n\n")


def _has_runs(text: str) -> bool:
    return (
        any(run in text for run in _RUNS)
        or text.endswith(_TWO_LAST)
        or (not text.isascii() and _WIDE_BLANK.search(text) is not None)
    )


def _behind(word: str) -> str:
    """A part of a text cut before every blank: words behind a space are kept without it."""
    return word if word.startswith("\n") else " " + word


class Encoder:
    """Encodes many texts with a byte-level tokenizer, each distinct stretch of text once.

    The tokenizer's pattern never lets a token cross the beginning of a run of blanks, so a text
    may be cut there: the ids of the parts, one after another, are the ids of the text. Where blanks
    come alone, splitting takes the place of a pattern. Parts are known by their characters.
    ``known`` holds parts as they are; ``words`` those that ``_behind`` completes, with their ids one
    after another in ``content``, those of word i from ``first[i]`` to ``first[i + 1]``.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        # A byte-level token is written with one character for each of its bytes.
        self.sizes = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
        for token, number in vocabulary.items():
            self.sizes[number] = len(token)

    def _forget(self) -> None:
        self.known: dict[str, bytes] = {}
        self.words = pa.array([], pa.large_string())
        self.content, self.first = np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def _encoded(self, parts: list[str]) -> list[bytes]:
        """The ids of each part; those that begin with an ASCII blank and end with none, as one text."""
        out: list[bytes | None] = [None] * len(parts)
        together = [i for i, p in enumerate(parts) if p[0] in "\t\n\x0b\x0c\r " and not p[-1].isspace()]
        if together:
            joined = [parts[i] for i in together]
            [encoding] = self.tokenizer.encode_batch_fast(["".join(joined)], add_special_tokens=False)
            numbers = np.array(encoding.ids, dtype="<u4")
            ends = np.cumsum([len(p.encode()) for p in joined])
            reached = np.cumsum(self.sizes[numbers])
            cuts = np.searchsorted(reached, ends)
            if len(reached) and reached[-1] == ends[-1] and np.array_equal(reached[cuts], ends):
                content, bounds = numbers.tobytes(), (4 * (cuts + 1)).tolist()
                for i, low, high in zip(together, [0, *bounds], bounds):
                    out[i] = content[low:high]
        # The others, and all if the vocabulary is not written in bytes, one by one.
        alone = [i for i, ids in enumerate(out) if ids is None]
        encodings = self.tokenizer.encode_batch_fast([parts[i] for i in alone], add_special_tokens=False)
        for i, encoding in zip(alone, encodings):
            out[i] = _serialized(encoding.ids)
        return out

    def _learn(self, new: set[str]) -> None:
        parts = list(new.difference(self.known))
        self.known.update(zip(parts, self._encoded(parts)))

    def _places(self, words: pa.Array) -> np.ndarray:
        """The numbers of different words in ``words``; new ones are encoded and added."""
        at = pa.compute.index_in(words, value_set=self.words)
        missing = at.is_null()
        new = words.filter(missing)
        places = at.fill_null(0).to_numpy().astype(np.int64)
        if len(new):
            places[missing.to_numpy(zero_copy_only=False)] = len(self.words) + np.arange(len(new))
            ids = self._encoded([*map(_behind, new.to_pylist())])
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            self.words = pa.concat_arrays([self.words, new])
            self.content = np.concatenate([self.content, np.frombuffer(b"".join(ids), "<u4")])
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])
        return places

    def _uncut(self, texts: list[str]) -> list[bytes]:
        encodings = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [_serialized(e.ids) + _END for e in encodings]

    def _cut_by_pattern(self, texts: list[str]) -> list[bytes]:
        cut = [_CUT.split(text) if _WIDE_BLANK.search(text) else _STRETCH.findall(text) for text in texts]
        self._learn(set().union(*cut))
        ids = self.known.__getitem__
        return [b"".join([*map(ids, parts), _END]) for parts in cut]

    def _cut_at_blanks(self, texts: list[str]) -> list[bytes]:
        """Each different word of all texts is looked up once; its ids are laid out by their places."""
        lines = pa.compute.replace_substring(pa.array(texts, pa.large_string()), "\n", " \n")
        split = pa.compute.split_pattern(lines, " ")
        ends = split.offsets.to_numpy().astype(np.int64)
        encoded = split.values.dictionary_encode()
        words, places = encoded.dictionary, encoded.indices.to_numpy()
        # ASCII marks behind a letter or digit are tokens of their own, so words are known without them.
        bare = pa.compute.utf8_rtrim(words, characters=_MARKS)
        marked = pa.compute.and_(
            pa.compute.less(pa.compute.binary_length(bare), pa.compute.binary_length(words)),
            pa.compute.match_substring_regex(bare, f"[{_LETTERS}]$"),
        )
        bare = pa.compute.if_else(marked, bare, words).dictionary_encode()
        word = self._places(bare.dictionary)[bare.indices.to_numpy()]
        marks = [w[len(w.rstrip(_MARKS)) :] for w in words.filter(marked).to_pylist()]
        # The first word of a text has no space before it, and ``END`` follows the last one.
        heads = split.values.take(pa.array(ends[:-1])).to_pylist()
        number = {part: at for at, part in enumerate({"": None} | dict.fromkeys(heads) | dict.fromkeys(marks))}
        self._learn(number.keys() - {""})
        extra = [*(self.known[part] if part else b"" for part in number), _END]
        sizes = np.fromiter(map(len, extra), np.int64, len(extra)) // 4
        starts = np.concatenate([self.first[:-1], self.first[-1] + np.cumsum(sizes) - sizes])
        sizes = np.concatenate([np.diff(self.first), sizes])
        behind = np.zeros(len(words), np.int64)
        behind[marked.to_numpy(zero_copy_only=False)] = [number[part] for part in marks]
        # Each word's ids and then its marks' ids; a first word is taken as a whole.
        order = np.stack([word[places], len(self.words) + behind[places]], axis=1)
        order[ends[:-1]] = [(len(self.words) + number[part], len(self.words)) for part in heads]
        order = np.insert(order.ravel(), 2 * ends[1:], len(sizes) - 1)
        lengths = sizes[order]
        reached = np.cumsum(lengths)
        at = np.repeat(starts[order] - (reached - lengths), lengths) + np.arange(reached[-1])
        content = np.concatenate([self.content, np.frombuffer(b"".join(extra), "<u4")])[at].tobytes()
        bounds = (4 * reached[2 * ends[1:] + np.arange(len(heads))]).tolist()
        return [content[low:high] for low, high in zip([0, *bounds], bounds)]

    def serialized(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, ended by ``END``, as little-endian unsigned 32-bit numbers."""
        if len(self.known) + len(self.words) > KNOWN_SEGMENTS:
            self._forget()
        out: list[bytes] = [_END] * len(texts)
        ways: dict = {self._uncut: [], self._cut_by_pattern: [], self._cut_at_blanks: []}
        for at, text in enumerate(texts):
            if text:
                # The tokenizer looks for added tokens before its pattern, so a cut could go through one.
                added = any(token in text for token in self.added)
                way = self._uncut if added else self._cut_by_pattern if _has_runs(text) else self._cut_at_blanks
                ways[way].append(at)
        for way, places in ways.items():
            if places:
                for at, ids in zip(places, way([texts[at] for at in places])):
                    out[at] = ids
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text, ended by ``END``."""
        return [np.frombuffer(ids, "<u4") for ids in self.serialized(texts)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def sample_limit(rows: int) -> int:
    """The bound of a signed 64-bit hash below which about ``SAMPLE_DOCUMENTS`` of the rows lie."""
    if rows <= SAMPLE_DOCUMENTS:
        return (1 << 63) - 1
    return -(1 << 63) + (SAMPLE_DOCUMENTS << 64) // rows


def train_dictionary(docs: DataFrame, tokenizer: str) -> bytes:
    """A zstandard dictionary for the ids of these texts (columns ``id, text``)."""
    # Different texts, each by a hash of its id and itself, so that no hot id or text fills the sample.
    count = docs.count()
    share = F.xxhash64(F.lit("sample"), F.col("id").cast("string"), F.col("text"))
    some = (
        docs.filter((share < sample_limit(count)) & (F.octet_length("text") <= SAMPLE_BYTES))
        .select("text")
        .dropDuplicates(["text"])
        .limit(MOST_SAMPLES)
    )

    def train(batches):
        samples = []
        for batch in pieces(batches):
            samples += encoder(tokenizer).serialized(texts_of(batch))
        try:
            content = zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
        except (zstandard.ZstdError, ValueError):
            # Too few samples to train on: the samples themselves are the dictionary.
            content = b"".join(samples)[-DICTIONARY_BYTES:]
        yield pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["content"])

    trained = some.repartition(1).mapInArrow(train, "content binary").first()
    return bytes(trained[0]) if trained else b""


def write_tokens(
    docs: DataFrame, tokenizer: str, folder: str, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode all texts and write ``blocks`` and ``dictionary`` below ``folder``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    content = train_dictionary(rows, tokenizer)
    digest = hashlib.sha256(content).hexdigest()
    spark.createDataFrame([(digest, bytearray(content))], "dictionary string, content binary").write.parquet(
        f"{folder}/dictionary"
    )
    schema = (
        f"part int, block int, dictionary string, first_token long, ids array<{kind}>, "
        "offsets array<int>, lengths array<int>, tokens array<long>, frames binary"
    )

    def encode(batches):
        compressor = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(content) if content else None
        )
        part = TaskContext.get().partitionId()
        block, before, keys, frames, tokens = 0, 0, [], [], []

        def packed():
            lengths = [len(f) for f in frames]
            offsets = [0, *np.cumsum(lengths).tolist()][:-1]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([block], pa.int32()),
                    pa.array([digest]),
                    pa.array([before], pa.int64()),
                    pa.array([keys], pa.list_(id_kind)),
                    pa.array([offsets], pa.list_(pa.int32())),
                    pa.array([lengths], pa.list_(pa.int32())),
                    pa.array([tokens], pa.list_(pa.int64())),
                    pa.array([b"".join(frames)], pa.binary()),
                ],
                ["part", "block", "dictionary", "first_token", "ids", "offsets", "lengths", "tokens", "frames"],
            )

        size = 0
        for batch in pieces(batches, size=TEXT_BYTES):
            for key, ids in zip(batch.column(0).to_pylist(), encoder(tokenizer).serialized(texts_of(batch))):
                frame = compressor.compress(ids)
                keys.append(key)
                frames.append(frame)
                tokens.append(len(ids) // 4)
                size += len(frame)
                if size >= BLOCK_BYTES:
                    yield packed()
                    block, before, size = block + 1, before + sum(tokens), 0
                    keys, frames, tokens = [], [], []
        if keys:
            yield packed()

    from pyspark.sql.pandas.types import to_arrow_type

    id_kind = to_arrow_type(rows.schema["id"].dataType)
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text").asc()]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(encode, schema).write.parquet(
        f"{folder}/blocks"
    )


def _starts(blocks: DataFrame) -> DataFrame:
    """Per part, the number of ids in the parts before it; one row per written partition."""
    tokens = F.aggregate("tokens", F.lit(0).cast("long"), lambda total, n: total + n)
    sizes = blocks.select("part", tokens.alias("tokens")).groupBy("part").agg(F.sum("tokens").alias("all"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("part", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("base"))


def index(spark: SparkSession, folder: str) -> DataFrame:
    """Where each document is: ``part, block, id, offset, length, tokens, start, dictionary``.

    ``start`` is the number of ids of all documents before it. The frames are not read.
    """
    blocks = spark.read.parquet(f"{folder}/blocks")
    before = F.aggregate(
        F.slice("tokens", F.lit(1), F.col("at")), F.lit(0).cast("long"), lambda total, n: total + n
    )
    return (
        blocks.select("*", F.posexplode("ids").alias("at", "id"))
        .join(_starts(blocks), "part")
        .select(
            "part",
            "block",
            "dictionary",
            "id",
            F.get("offsets", F.col("at")).alias("offset"),
            F.get("lengths", F.col("at")).alias("length"),
            F.get("tokens", F.col("at")).alias("tokens"),
            (F.col("base") + F.col("first_token") + before).alias("start"),
        )
    )


def _dictionary(spark: SparkSession, folder: str) -> tuple[str, bytes]:
    digest, content = spark.read.parquet(f"{folder}/dictionary").first()
    content = bytes(content)
    if hashlib.sha256(content).hexdigest() != digest:
        raise ValueError("the dictionary does not have the hash that the files name")
    return digest, content


def _decompressor(content: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content) if content else None)


def read_documents(spark: SparkSession, folder: str, ids: list) -> dict:
    """The token ids of some documents; only the blocks that hold them are read, frame by frame."""
    digest, content = _dictionary(spark, folder)
    wanted = F.array(*(F.lit(i) for i in ids))
    blocks = spark.read.parquet(f"{folder}/blocks").filter(F.arrays_overlap("ids", wanted))
    found, open_ = {}, _decompressor(content)
    for row in blocks.toLocalIterator():
        assert row.dictionary == digest
        for key, offset, length in zip(row.ids, row.offsets, row.lengths):
            if key in ids:
                found[key] = np.frombuffer(open_.decompress(bytes(row.frames[offset : offset + length])), "<u4")
    return found


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: ``id, start, n_tokens, ids_crc32``."""
    digest, content = _dictionary(spark, folder)
    blocks = spark.read.parquet(f"{folder}/blocks")
    kind = blocks.schema["ids"].dataType.elementType.simpleString()

    def decode(batches):
        open_ = _decompressor(content)
        for batch in batches:
            for row in batch.to_pylist():
                if row["dictionary"] != digest:
                    raise ValueError("a block was written with another dictionary")
                data = memoryview(row["frames"])
                sums, counts = [], []
                for offset, length in zip(row["offsets"], row["lengths"]):
                    ids = open_.decompress(data[offset : offset + length])
                    sums.append(zlib.crc32(ids))
                    counts.append(len(ids) // 4)
                starts = row["first_token"] + np.concatenate(([0], np.cumsum(counts)[:-1]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * len(sums), pa.int32()),
                        pa.array(row["ids"], batch.schema.field("ids").type.value_type),
                        pa.array(starts, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    ["part", "id", "inside", "n_tokens", "ids_crc32"],
                )

    rows = blocks.select("part", "dictionary", "first_token", "ids", "offsets", "lengths", "frames").mapInArrow(
        decode, f"part int, id {kind}, inside long, n_tokens long, ids_crc32 long"
    )
    starts = _starts(blocks)
    return rows.join(starts, "part").select(
        "id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )
