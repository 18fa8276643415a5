import pytest

from deltaq.llm.common import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def docs(spark):
    """A maker of small document tables (doc_id, text, lang, source, n_chars), by (id, text[, source])."""
    def make(rows, extra=""):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), 7)[:6 if extra else 5]
                for r in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        return spark.createDataFrame(full, schema + (f", {extra} int" if extra else ""))
    return make
