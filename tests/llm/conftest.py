import pytest

SF = "/root/testdata/sf0.001"
#: Columns whose names the operators use inside.
CLASHING = ("spans", "items", "key", "line", "block", "row", "score", "lang_pred", "digest", "id", "n", "x", "task", "at")


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and blank texts, a very long text, repeated rows, ties, equal texts, clashing columns."""
    from pyspark.sql import functions as F

    long = " ".join(f"wort{i % 977} und{i}" for i in range(30_000))
    para = " ".join(f"alpha{i} beta{i}" for i in range(40))
    rows = [(1, None), (2, ""), (3, " \t\n \n"), (4, "one"), (5, "ONE"), (6, para), (7, para), (7, para), (8, para + " and a tail of words"),
            (9, long), (10, "1234 !!! ---"), (None, para), (None, None), (11, "a b c d"), (12, "a b c d"),
            (13, "Ünïcödé Wörter 漢字 😀 " * 12), (14, "x" * 5000), (15, "first line here\nsecond line there\nfirst line here")]
    df = spark.createDataFrame([(i, t, "en" if k % 2 else None, "src0", len(t or "")) for k, (i, t) in enumerate(rows)],
                               "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHING)])


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
