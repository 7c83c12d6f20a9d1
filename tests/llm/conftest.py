import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, Size int, score string"


@pytest.fixture()
def documents(spark):
    """A small documents table with two columns whose names the operators use themselves."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", s, len(t or ""), 7, "x") for i, t, s in rows], DOCUMENTS)

    return make


LONG = " ".join(f"word{i % 997}x{i}" for i in range(30_000))


@pytest.fixture()
def awkward(documents):
    """NULLs in every column, empty and very long texts, ties and repeated rows."""
    rows = [(1, "a b c d e f g", "s1"), (1, "a b c d e f g", "s1"), (2, None, None), (3, "", "s1"), (4, LONG, "s2")]
    rows += [(None, "a b c d e f g", "s2"), (5, " \n\t ", "s2"), (6, "İdiot K ñandú " * 3, None), (7, "one", "s1")]
    return documents(rows)
