import pytest


@pytest.fixture()
def docs_of(spark):
    """A documents table of (doc_id, text) pairs with the other columns filled."""
    def make(rows, extra=""):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    return make


@pytest.fixture()
def fixture_dir(spark, tmp_path):
    """Write small tables as a test-data folder: {name: DataFrame} to a path."""
    def make(**tables):
        for name, df in tables.items():
            df.coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return make
