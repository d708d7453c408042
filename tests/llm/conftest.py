import pytest

LONG = "Word after word, and so it goes on. " * 30_000
#: Null, empty, blank, tied and repeated rows, a very long text.
TEXTS = {
    1: "The quick brown fox jumps over the lazy dog near the old river bank today.\nA second line of words.\nAnd a third one here.",
    2: "The quick brown fox jumps over the lazy dog near the old river bank today.\nA second line of words.\nAnd a third one here.",
    3: None,
    4: "",
    5: " \n\t\n ",
    6: "single",
    7: LONG,
    8: "Été à la mer: l'eau est ÉLÉGANTE, 漢字 and 😀 too.\r\nReleased under the MIT License.",
    None: "A row without an id, released under the MIT License. " * 3,
}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, gone string, rate string, copies string, seed string, its_id string"


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows, with extra columns whose names operators could use themselves."""
    rows = [(i, t, None if i in (3, 4) else "en", None if i == 6 else "a", len(t or ""), "x", "y", "z", "c", "s", "i") for i, t in TEXTS.items()]
    return spark.createDataFrame([*rows, rows[0]], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def doc_rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
