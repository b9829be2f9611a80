import duckdb
import pytest

TABLES = "documents pages benchmark labels conversations embeddings".split()


@pytest.fixture(scope="session")
def oracle():
    def run(sql, folder="/root/testdata/sf0.01"):
        con = duckdb.connect()
        for t in TABLES:
            con.sql(f"create view {t} as select * from '{folder}/{t}.parquet'")
        return con.sql(sql).df()
    return run


@pytest.fixture
def documents(spark):
    """A frame of (doc_id, text) rows with columns whose names the operators use inside."""
    def make(rows, **more):
        extra = {"chunk": "string", "digest": "string", "size": "int", "key": "int", **more}
        schema = "doc_id long, text string, lang string, source string, " + ", ".join(
            f"`{k}` {v}" for k, v in extra.items())
        return spark.createDataFrame(
            [(*r, *[None] * (4 - len(r)), *[None] * len(extra)) for r in rows], schema)
    return make
