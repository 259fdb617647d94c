"""The operators' SQL against their Spark queries, on the generated tables."""

import duckdb
import pytest

from ledgerloom.llm import registered
from tests.llm.cases import frame, odd_rows, saved

FOLDER = "/root/testdata/sf0.01"


def unlisted():
    """Clean texts in other scripts, with and without a label, and Latin ones without stop words."""
    texts = {
        "ru": " ".join(f"слово{chr(1072 + i % 32)}{chr(1072 + i // 8)} текст{chr(1072 + i)}" for i in range(30)),
        "el": " ".join(f"λέξη{chr(945 + i % 15)}{chr(945 + i // 4)} κείμενο{chr(945 + i % 16)}" for i in range(30)),
        "pl": " ".join(f"słowo{chr(97 + i % 26)}{chr(97 + i // 4)} tekst{chr(97 + i % 26)}" for i in range(30)),
    }
    langs = [("ru", "ru"), ("ru", None), ("ru", "en"), ("el", "el_GR"), ("el", ""), ("el", " und"), ("pl", "pl"), ("pl", None)]
    return [(9000 + i, texts[text], lang, "s", 1) for i, (text, lang) in enumerate(langs)]


def test_clean_texts_in_other_scripts_are_kept(spark, tmp_path):
    folder = saved(frame(spark, unlisted()), tmp_path)
    kept = {r.doc_id for r in registered.QUERIES["op1_quality_rules"](spark, folder).filter("kept").collect()}
    assert kept == {9000, 9001, 9003, 9004, 9005, 9006}


@pytest.mark.parametrize("name", sorted(registered.ORACLES))
def test_query_equals_sql(spark, tmp_path, name):
    odd = saved(frame(spark, odd_rows() + unlisted()), tmp_path)
    items = [(1, "W1 the w2 w2"), (None, "no words but w3"), (2, None), (3, ""), (1, "é 漢字")]
    spark.createDataFrame(items, "item_id BIGINT, text STRING").write.parquet(f"{odd}/benchmark.parquet")
    for folder, files in ((FOLDER, "{}.parquet"), (odd, "{}.parquet/*.parquet")):
        ours = registered.QUERIES[name](spark, folder)
        duck = duckdb.connect()
        for table in ("documents", "benchmark"):
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{files.format(table)}'")
        theirs = duck.execute(registered.ORACLES[name])
        order = [column[0] for column in theirs.description]
        assert sorted(order) == sorted(ours.columns)
        key = lambda row: tuple((v is None, str(v)) for v in row)
        assert sorted(map(tuple, ours.select(*order).collect()), key=key) == sorted(theirs.fetchall(), key=key)
