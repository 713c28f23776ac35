"""Small tables with nulls, empty and long texts, repeated rows and clashing columns."""

import pytest

LONG = "alpha beta gamma delta " * 6000 + "end."


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Rows that every operator has to take: (doc_id, text) and columns with likely names."""
    rows = [
        (1, "One two three four five six."), (1, "One two three four five six."), (2, None), (3, ""), (4, " \n\t "), (None, "no id here"),
        (None, None), (5, LONG), (6, "ΑΣ naïve 日本語 🎉 x"), (7, "0" * 70_000), (8, "one two THREE four five six."),
    ]
    schema = "doc_id bigint, text string, kept int, Result string, words int, spans string, fp string, component_id int"
    return spark.createDataFrame([(i, t, 9, "r", 9, "s", "f", 9) for i, t in rows], schema)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
