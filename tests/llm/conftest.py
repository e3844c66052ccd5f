import pytest

from tallylake.llm.registry import let_workers_import


@pytest.fixture(autouse=True)
def _workers(spark):
    let_workers_import(spark)


#: Null and empty texts, a null id, a repeated row, one id with two texts, a very long text.
ODD = [
    (1, "Alpha beta gamma delta epsilon."), (1, "Alpha beta gamma delta epsilon."), (2, None), (3, ""), (None, "no id here at all"),
    (4, "one"), (4, "another text of the same id"), (5, " \n\t "), (6, "wörter über größe " * 5), (7, "long " * 60_000),
]


@pytest.fixture
def odd_docs(spark):
    """Odd rows with columns whose names an operator might use itself."""
    rows = [(i, t, "x", 1.0, [1]) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, score string, words double, row array<int>")


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string")
