import duckdb
import pytest


@pytest.fixture()
def duck():
    """DuckDB over Spark rows: duck(sql, name=DataFrame, ...)."""
    def run(sql, **tables):
        con = duckdb.connect()
        for name, df in tables.items():
            con.register(name, df.toArrow())
        return con.execute(sql)
    return run
