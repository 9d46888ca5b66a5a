import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def folder(spark, tmp_path):
    """Writes small tables like those of the test data and gives their folder."""

    def write(docs=(), labels=(), benchmark=(), pages=()):
        rows = [(d, t, "en", "s", len(t or "")) if not isinstance(t, tuple) else (d, t[0], t[1], "s", len(t[0] or "")) for d, t in docs]
        tables = {
            "documents": (rows, DOCUMENTS),
            "labels": (list(labels), "doc_id long, quality int, toxic int"),
            "benchmark": (list(benchmark), "item_id long, text string"),
            "pages": (list(pages), "page_id long, url string, html string"),
        }
        for name, (data, schema) in tables.items():
            spark.createDataFrame(data, schema).coalesce(3).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


PLAIN = "the quick brown fox jumps over the lazy dog while nine small birds sing in old green trees by a river"
# Null, empty, white space, one word, short, very long, equal texts, a text without id, one word without an end.
EDGES = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a b c"), (6, "long " * 20000 + PLAIN), (7, PLAIN), (8, PLAIN),
    (9, PLAIN.upper()), (None, PLAIN), (10, "x" * 30000), (11, "é ß 你好 😀 " * 40), (12, "a\x00b " + PLAIN), (2**40, PLAIN + " end"),
    (-5, "negative " + PLAIN),
]


@pytest.fixture
def edges():
    return list(EDGES)
