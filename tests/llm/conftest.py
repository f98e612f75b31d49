import pytest

from tslines.llm.common import ready

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark):
    return ready(spark)


@pytest.fixture
def docs(llm):
    """Documents from (doc_id, text) or (doc_id, text, source), with columns whose names the
    operators also use."""

    def make(*rows, extra=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) for r in rows]
        df = llm.createDataFrame(full, SCHEMA)
        if not extra:
            return df
        from pyspark.sql import functions as F

        names = ["id", "row", "key", "digest", "fp", "size", "copies", "n_tokens", "score", "at", "words", "nth", "order", "kept"]
        return df.withColumns({n: F.lit(f"own {n}") for n in names})

    return make


LONG = "word " * 60_000


@pytest.fixture
def odd_rows():
    """Null, empty, blank, very long and repeated rows, a null id, ties."""
    return [(1, None), (2, ""), (3, " \t\n"), (4, LONG), (5, "same text here"), (6, "same text here"), (6, "same text here"), (None, "no id"), (7, "é\u00a0ß 中文 😀")]
