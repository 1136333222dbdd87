import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """(doc_id, text) rows -> DataFrame, with the other columns of documents."""
    def make(rows, extra=""):
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint" + extra
        more = [None] * extra.count(",")
        return spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t), *more) for i, t in rows],
                                     schema).repartition(3)
    return make
