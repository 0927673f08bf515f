import pytest

SF01 = "/root/testdata/sf0.01"
SF001 = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, Component_ID long, score double, target string"


@pytest.fixture
def edge_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing extra columns."""
    long_text = "lorem ipsum dolor sit amet " * 20000
    rows = [
        (1, "The river was low and the boats stayed where they were.", "en", "a", 55, 1, 9, 0.5, "t"),
        (2, None, "en", "a", None, 1, 9, 0.5, "t"),
        (3, "", None, None, 0, None, None, None, None),
        (4, " \t\n", "de", None, 3, 1, 9, 0.5, "t"),
        (5, long_text, "en", "b", len(long_text), 1, 9, 0.5, "t"),
        (None, "no id here at all", "en", "b", 17, 1, 9, 0.5, "t"),
        (7, "twice the same row stands here", "en", "b", 30, 1, 9, 0.5, "t"),
        (7, "twice the same row stands here", "en", "b", 30, 1, 9, 0.5, "t"),
        (8, "one", None, "c", 3, 1, 9, 0.5, "t"),
        (9, "12345 !!", "en", "c", 8, 1, 9, 0.5, "t"),
    ]
    return spark.createDataFrame(rows, DOCS)
