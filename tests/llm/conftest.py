import pytest

LONG = "lorem ipsum dolor " * 20_000

#: Null, empty and very long texts, ties and repeated rows, and columns whose names operators use themselves.
EDGE_ROWS = [
    (1, None, "en", "a", None, 1, "x"), (2, "", "en", "a", 0, 2, "x"), (3, " \n\t ", None, None, 4, 3, "x"),
    (4, LONG, "en", "b", len(LONG), 4, "x"), (4, LONG, "en", "b", len(LONG), 4, "x"),
    (5, "Der Text ist kurz.", "de", "b", 18, 5, None), (5, "Ein anderer Text mit der gleichen Nummer.", "de", "c", 41, 6, None),
    (None, "No number here, password=hunter2hunter2 ok", "en", "c", 42, 7, "x"),
    (7, "tie one two three", "en", None, 17, 8, "x"), (8, "tie one two three", "en", None, 17, 9, "x"),
    (9, "日本語 😀 ▁ \u0000 é", None, "d", 12, 10, "x"),
]
EDGE_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, kept string"


@pytest.fixture
def edge(spark):
    return spark.createDataFrame(EDGE_ROWS, EDGE_SCHEMA)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)
