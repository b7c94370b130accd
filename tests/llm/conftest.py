import pytest

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, keep string"


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every odd case: nulls, blanks, a long text, repeated rows, clashing names."""
    long_text = " ".join(f"word{i}" for i in range(30_000))
    rows = [
        (1, "one two three four five six seven eight nine ten eleven", "en", "a"), (2, None, None, None), (3, "", "en", "a"),
        (4, " \n\t ", None, "b"), (5, long_text, "de", "b"), (6, long_text, "de", None), (None, "no id here at all", "en", "a"),
        (None, None, None, None), (7, "x", "en", "a"), (7, "x", "en", "a"), (8, "1234 5678", "en", "c"),
        (9, "one two three four five six seven eight nine ten eleven", "en", "c"), (9, "another text under that id", "en", "c"),
    ]
    return spark.createDataFrame([(*r, None, "taken", "taken") for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
