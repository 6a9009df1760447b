import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs():
    """doc_id -> text of the smallest table, null texts as empty ones."""
    return dict(duckdb.connect().execute(
        f"SELECT doc_id, coalesce(text, '') FROM read_parquet('{SF}/documents.parquet') ORDER BY 1").fetchall())


@pytest.fixture(scope="session")
def query(spark):
    import __spark_entry__ as entry

    made = {}

    def run(name):
        if name not in made:
            made[name] = entry.queries()[name](spark, SF).toPandas()
        return made[name]
    return run


COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, score double, row long, "
           "fingerprint string, component_id long, fp long, piece int")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, columns that clash."""
    extra = ("en", "s", 1, 0.5, 7, "f", 8, 9, 3)
    texts = [(None, "no id at all here"), (None, None), (1, None), (2, ""), (3, " \n\t "), (4, "one"),
             (5, "The same text stands here. And it goes on for a while, so that it has shingles."),
             (5, "The same text stands here. And it goes on for a while, so that it has shingles."),
             (6, "The same text stands here. And it goes on for a while, so that it has shingles."),
             (7, "Ünïcödé 漢字 🙂 <|endoftext|> a\x00b\xa0c   d▁e"), (8, "word " * 60_000),
             (9, "x" * 20_000)]
    return spark.createDataFrame([(i, t, *extra) for i, t in texts], COLUMNS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def marks(spark):
    return spark.createDataFrame([(4, 1, 0), (5, 1, 0), (5, None, None), (7, 0, 1), (None, 1, 1), (99, 1, 1)],
                                 "doc_id long, quality int, toxic int")
