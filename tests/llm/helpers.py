"""Small documents with every awkward case, and reference results."""

import os

from pyspark.sql import types as T

SF = os.environ.get("STRATA_TEST_SF", "/root/testdata/sf0.001")
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("n_chars", T.LongType()),
                     # clashing names that operators use or might use for columns of their own
                     T.StructField("th", T.StringType()), T.StructField("sha", T.StringType()),
                     T.StructField("kept", T.StringType())])

PASSAGE = " ".join(f"passage{i}" for i in range(40))
LINE = "the quick brown fox jumps over the lazy dog while nobody at all is watching it now"


def awkward():
    """(doc_id, text) pairs: nulls, empties, ties, copies, near copies, long and odd texts."""
    long_text = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
    return [
        (1, "Alpha beta  gamma\tdelta. Epsilon!\n" + LINE),
        (2, "Alpha beta gamma delta. Epsilon!\n" + LINE),
        (3, None), (4, ""), (5, " \t\n\x0b\x0c\r "), (6, "x"),
        (7, f"start here {PASSAGE} and end here"),
        (8, f"other words before {PASSAGE} other words after"),
        (9, f"{PASSAGE}"), (10, f"{PASSAGE}"),
        (11, long_text), (12, long_text + " tail"),
        (13, "a" * 30_000), (14, "ab" * 9_000 + " " + "é漢" * 6_000),
        (15, LINE + "\n" + LINE + "\nshort\nshort"),
        (16, LINE.replace("lazy", "hazy") + "\nsomething of its own that no other text has in it"),
        (17, "é ü ñ Σ İ 漢字 ́ <|endoftext|> it's 'LL 12³   end"),
        (18, "one two three four five six seven eight nine ten eleven twelve thirteen"),
        (19, "one two three four five six seven eight nine ten eleven twelve thirteen"),
        (20, "word " * 80), (21, "### $$$ %%% &&& | < > * word"),
        (9, f"{PASSAGE}"),                       # a repeated row
        (None, "no id here " + PASSAGE), (None, None),
    ]


def frame(spark, pairs):
    rows = [(d, t, "en", None if t is None else len(t), "x", "y", "z") for d, t in pairs]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def docs_of(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


def pairs_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
