import pytest


@pytest.fixture(scope="session", autouse=True)
def package(spark):
    """Workers that find the package wherever the tests are started."""
    from countypanel.llm.common import share_package

    share_package(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """Rows with every oddity: nulls, empty and long texts, ties, repeated rows, a column that clashes."""

    def make(rows, extra=True):
        full = [(i, t, "en", "src", len(t or ""), 7) for i, t in rows]
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
        if extra:
            return spark.createDataFrame(full, schema + ", score int")
        return spark.createDataFrame([r[:5] for r in full], schema)

    return make
