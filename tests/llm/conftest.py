import pytest

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
SF = "/root/testdata/sf0.001"

_PROSE = "the quick brown fox jumps over the lazy dog while rain falls on old stone roofs and nobody minds it at all"
_EXTRA = ["key", "o", "n", "range", "gram", "spans", "_key", "bucket", "digest", "component", "a", "b", "x", "label",
          "first", "place", "hits", "kept", "edited", "score", "_id"]


def edge_rows():
    """(doc_id, text): nulls, empty and blank texts, ties, repeated rows, a long text, odd characters."""
    long = " ".join(f"{_PROSE} {i}." for i in range(3000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, _PROSE), (6, _PROSE), (7, _PROSE + " again"), (8, long),
        (9, "token = \"" + "ab" * 20 + "\" " + _PROSE), (9, "token = \"" + "ab" * 20 + "\" " + _PROSE),
        (10, "Licensed under CC BY-NC 4.0. All rights reserved. " + _PROSE), (11, "日本語のテキスト 🎉 é́ ñ"),
        (12, "x" * 5000), (13, "For " * 400), (None, _PROSE + " without an id"), (None, None), (14, " ".join([_PROSE] * 4)),
        (15, "\x00\x1c a b \r\n c"), (16, long[:-3]),
        *[(17, "a wholly different sentence that stands twice in this table and nowhere else at all")] * 2,
        (18, "a" + " " * 2_000_000), (19, "a" + "\n" * 2_000_000),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """The rows with extra columns whose names the operators use inside."""
    rows = [(i, t, None if n % 3 else "en", "src", 1, *["z"] * len(_EXTRA)) for n, (i, t) in enumerate(edge_rows())]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in _EXTRA)
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(spark, edge_docs):
    return spark.createDataFrame([], edge_docs.schema)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def pdocs(docs):
    return docs.select("doc_id", "text").toPandas()


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")
