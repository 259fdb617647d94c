"""Token files: the same ids as the tokenizer itself, read back from the files."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import token_files
from tests.llm.cases import frame, odd_rows, with_clashes

PATH = public_tokenizers.path("byte_bpe_50k.json")
HARD = [
    "", " ", "  two", "a  b", "a \n b", "\n\nx\n", "x \n\n  y", "tab\there", "don't we'll  it's",
    "a b", "a  b", "a  b", "a \n\nb", " \n x", "　 　a b", "é  \tz",
    "<|endoftext|> x", "x<|endoftext|>y z", "漢字 かな 🙂 x", "1234 5.6 -7", "\x1c a \x1f b", "\x85 \x85a b", "end ",
    "\r\n\r\nline", "\x0b\x0c x", "a​ b", "  lead", "trail   ", "...   !!! ???",
]


def plain(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]


def test_encoder_equals_the_tokenizer():
    rng = random.Random(3)
    atoms = [" ", "  ", "\n", "\t", " ", " ", "word", "Don't", "é", "漢", "🙂", "12", "...", "'s", "\x85", "x"]
    texts = HARD + ["".join(rng.choices(atoms, k=rng.randrange(0, 30))) for _ in range(3000)] + [None]
    for some in (texts, HARD, [t for t in texts if t is None or t.isascii()]):
        ours = token_files.Encoder(PATH).encode(some)
        assert [x.tolist() for x in ours] == plain(some)


def test_words_are_cut_before_marks():
    """Every pair and triple of letters, digits, marks and blanks around the cut, joined or alone."""
    rng = random.Random(5)
    atoms = "aZ9\u00e9\u00df\u0301\u4e00\u20ac\u2014'.,!|<>#$%&()~ \n\t"
    texts = [a + b + c for a in atoms for b in atoms for c in atoms]
    texts += ["".join(rng.choices(atoms, k=rng.randrange(1, 60))) for _ in range(3000)]
    texts += ["ab<|endoftext|>cd", "ab.<|endoftext|>.", " <|endoftext|", "> x", " x.y<|endo", "ftext|>", "a\xa0.b c", "it's.", "''s."]
    texts += ["a <|endoftext|> b", "a x<|endoftext|>", "a\n<|endoftext|>", "a  <|endoftext|>", "a <|endoftext b|>", "a \u00e9!?"]
    assert [x.tolist() for x in token_files.Encoder(PATH).encode(texts)] == plain(texts)


def test_runs_of_blanks():
    """Every text of up to seven letters, spaces and line ends, and random ones with all kinds of blanks."""
    texts = ["".join(t) for n in range(8) for t in itertools.product("a \n", repeat=n)]
    rng = random.Random(7)
    texts += ["".join(rng.choices("ab.  \n\n\t\r\x1c\xa0\u00e9", k=rng.randrange(1, 40))) for _ in range(3000)]
    assert [x.tolist() for x in token_files.Encoder(PATH).encode(texts)] == plain(texts)


def test_a_vocabulary_not_written_in_bytes_is_encoded_one_by_one(monkeypatch):
    texts = ["one two, three", " four five"]
    encoder = token_files.Encoder(PATH)
    encoder.sizes[:] = 1
    assert [x.tolist() for x in encoder.encode(texts)] == plain(texts)


def test_stretches_that_share_a_polynomial_hash_keep_their_ids():
    """Thue-Morse words and their complements: equal under any even polynomial modulo 2^64."""
    word = "a"
    while len(word) < 4096:
        word += word.translate(str.maketrans("ab", "ba"))
    texts = [w for n in (1024, 2048, 4096) for w in (word[:n], word[:n].translate(str.maketrans("ab", "ba")))]
    assert [x.tolist() for x in token_files.Encoder(PATH).encode(texts)] == plain(texts)


def test_the_sample_is_never_empty():
    for rows in (1, 2000, 3 * 10**9, 10**13):
        share = (token_files.sample_limit(rows) + (1 << 63)) / (1 << 64)
        assert share * rows == pytest.approx(min(rows, token_files.SAMPLE_DOCUMENTS), rel=1e-3)


def test_hot_and_null_ids_leave_the_sample_bounded(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SAMPLE_DOCUMENTS", 10**6)
    monkeypatch.setattr(token_files, "MOST_SAMPLES", 20)
    rows = [(None, f"text {at % 40} of many") for at in range(400)]
    docs = spark.createDataFrame(rows, "id BIGINT, text STRING")
    assert len(token_files.train_dictionary(docs, PATH)) > 0


def test_registered_query(spark, tmp_path):
    from ledgerloom.llm.registered import QUERIES
    from tests.llm.cases import saved

    rows = odd_rows()
    got = QUERIES["op7_token_files"](spark, saved(frame(spark, rows), tmp_path))
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    crc = [zlib.crc32(np.array(x, dtype="<u4").tobytes()) for x in plain([r[1] for r in rows])]
    assert sorted((r.doc_id or -1, r.ids_crc32) for r in got.collect()) == sorted(
        (r[0] or -1, c) for r, c in zip(rows, crc)
    )


def test_encoder_forgets_and_goes_on(monkeypatch):
    monkeypatch.setattr(token_files, "KNOWN_SEGMENTS", 3)
    encoder = token_files.Encoder(PATH)
    for _ in range(3):
        assert [x.tolist() for x in encoder.encode(HARD)] == plain(HARD)


@pytest.mark.parametrize("block", [1 << 20, 200])
def test_round_trip(spark, new_path, monkeypatch, block):
    monkeypatch.setattr(token_files, "BLOCK_BYTES", block)
    rows = odd_rows(clean=60) + [(2000 + i, t, "en", "s", 1) for i, t in enumerate(HARD)]
    docs = with_clashes(frame(spark, rows).repartition(5))
    folder = new_path("tokens")
    token_files.write_tokens(docs, PATH, folder)
    got = token_files.digests(spark, folder).collect()
    texts = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    ids = plain([r[1] for r in texts])
    crc = [zlib.crc32(np.array(x, dtype="<u4").tobytes()) for x in ids]
    got.sort(key=lambda r: r.start)
    assert [r.id for r in got] == [r[0] for r in texts]
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got]).tolist()][:-1]
    assert sorted((r.id or -1, r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (r[0] or -1, len(x), c) for r, x, c in zip(texts, ids, crc)
    )
    places = token_files.index(spark, folder).collect()
    assert sorted((r.id or -1, r.start, r.tokens) for r in places) == sorted((r.id or -1, r.start, r.n_tokens) for r in got)
    one = token_files.read_documents(spark, folder, [2005, 1003])
    assert {k: v.tolist() for k, v in one.items()} == {r[0]: x for r, x in zip(texts, ids) if r[0] in (2005, 1003)}


def test_empty_table(spark, new_path):
    token_files.write_tokens(frame(spark, []), PATH, new_path("none"))
    assert token_files.digests(spark, new_path("none")).count() == 0


def test_a_changed_dictionary_is_noticed(spark, new_path):
    folder = new_path("tokens")
    token_files.write_tokens(frame(spark, odd_rows()), PATH, folder)
    spark.createDataFrame([("0" * 64, bytearray(b"x"))], "dictionary string, content binary").write.mode(
        "overwrite"
    ).parquet(f"{folder}/dictionary")
    with pytest.raises(ValueError):
        token_files.digests(spark, folder)
