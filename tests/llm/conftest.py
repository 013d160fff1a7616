import pytest

SF = "/root/testdata/sf0.001"

# Names that operators might use for columns of their own.
CLASHES = ["shard", "slot", "uid", "row", "body", "words", "counts", "doc", "key", "leaf", "tokens", "node",
           "root", "n_words", "kept", "score", "place", "copies", "g_lang", "limit", "size", "tie", "spans"]

LONG = " ".join(f"word{i % 997}x{i}" for i in range(30_000))
PROSE = ("the river runs slowly past the old stone mill where nobody has ground any corn for a very long time "
         "and yet the wheel still turns whenever the spring rain comes down from the hills above the town")


@pytest.fixture(scope="session")
def edge_docs(spark):
    """NULLs in every column, empty, blank, short and very long texts, repeated rows, clashing columns."""
    rows = [
        (1, PROSE, "en", "src1", 10), (1, PROSE, "en", "src1", 10), (2, PROSE, "en", "src2", 10),
        (3, None, "en", "src1", None), (4, "", "de", "src1", 0), (5, " \t\n", "de", None, 3),
        (None, PROSE + " again", None, None, None), (6, LONG, "fr", "src9", 1), (7, "one two", "fr", "src9", 1),
        (8, "&&& ### *** $$$ " * 20, "en", "src1", 1), (9, "1234 5678", None, "src1", 1),
        (-5, "Ünïcode wörds 😀 are fine ñ " * 9, "de", "a/b", 1), (None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for c in CLASHES:
        df = df.selectExpr("*", f"concat('x', doc_id) AS `{c}`")
    return df


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.filter("1 = 0")


@pytest.fixture(scope="session")
def sample_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
