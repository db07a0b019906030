import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, n_words long, __row_key int, spans string"


@pytest.fixture(scope="session")
def make(spark):
    """A documents table with columns that clash with the operators' own."""

    def build(rows):
        """Rows of (doc_id, text[, lang[, source]])."""
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None if r[1] is None else len(r[1]), True, -1, -1, "x") for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


#: Null and blank texts, repeated rows, null keys, one very long text.
ODD = [(1, None), (2, ""), (3, " \n\t "), (None, None), (None, "the same words stand here twice"), (None, "the same words stand here twice"),
       (5, "é 日本 \U0001f600 ñandú"), (5, "é 日本 \U0001f600 ñandú"), (6, "x" * 300_000), (7, "a b " * 40_000), (8, "one")]
