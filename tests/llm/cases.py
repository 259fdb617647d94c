"""Rows that every operator has to stand: nulls, blanks, long texts, ties, repeats, odd columns."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DDL = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
# Names that operators are likely to use for columns of their own.
CLASHING = "id hash size row times kept shard slot key target words class_id n_links score bucket"


def words_of(text):
    return WORD.findall(text or "")


def prose(rng, count, vocabulary=400):
    out = []
    for at in range(count):
        out.append(f"w{rng.randrange(vocabulary)}" + rng.choice(["", "", "", ".", ","]))
        if rng.random() < 0.1:
            out.append("the")
    lines, at = [], 0
    while at < len(out):
        step = rng.randrange(4, 30)
        lines.append(" ".join(out[at : at + step]))
        at += step
    return "\n".join(lines)


def odd_rows(seed=1, clean=30):
    """Documents with every kind of defect, on top of ``clean`` ordinary ones."""
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randrange(3, 200)), "en", f"s{i % 4}", i) for i in range(clean)]
    long_text = prose(rng, 30_000, 5000)
    rows += [
        (1000, None, None, None, None),
        (1001, "", "en", "s1", 0),
        (1002, " \n\t \r\n", "en", None, 0),
        (None, "no id here but some words that count", "en", "s2", 1),
        (None, None, None, None, None),
        (1003, long_text, "en", "s0", len(long_text)),
        (1004, rows[3][1], "en", "s1", 1),
        (1005, rows[3][1], "en", "s2", 1),
        (1006, "é ß 漢字 🙂 ñ x", None, "s3", 4),
        (1007, "word", "en", "é", 4),
        (1008, "x" * 50_000, "en", "s3", 4),
        rows[5],
        rows[5],
        rows[6],
    ]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL)


def with_clashes(df):
    from pyspark.sql import functions as F

    for name in CLASHING.split():
        df = df.withColumn(name, F.lit("clash"))
    return df


def saved(df, folder):
    """The frame as the documents table of a folder that queries can read."""
    df.coalesce(2).write.parquet(f"{folder}/documents.parquet")
    return str(folder)
