"""Small tables with the cases that every operator must stand."""

import glob
import os

SMALL = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, first=0):
    """Texts as documents with ids from ``first``; a pair gives the id too."""
    rows = []
    for at, text in enumerate(texts, first):
        doc_id, text = text if isinstance(text, tuple) else (at, text)
        rows.append((doc_id, text, None, "s", None if text is None else len(text)))
    return spark.createDataFrame(rows, DOCUMENTS)


def odd_documents(spark, texts=()):
    """Nulls in every column, empty and blank texts, repeated rows, a long text."""
    long = " ".join(f"word{i % 997}" for i in range(30_000))
    cases = [(None, None), (None, "two words"), (1, None), (2, ""), (3, " \n\t "), (4, "same row"), (4, "same row"), (5, long)]
    return documents(spark, cases + [(100 + i, t) for i, t in enumerate(texts)])


def clashing(df, *names):
    """``df`` with more columns of the given names."""
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit("x") for n in names})


def views(con, folder=SMALL):
    for path in glob.glob(folder + "/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con
