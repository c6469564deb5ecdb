import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, os.environ.get("PYTHONPATH")) if x)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", "file://" + str(tmp_path_factory.mktemp("shared"))).config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    return con


def normal(rows) -> list[tuple]:
    """Rows as sortable tuples: numbers rounded, nulls last."""
    one = lambda v: "NULL" if v is None or v != v else repr(round(float(v), 6)) if isinstance(v, (int, float)) and not isinstance(v, bool) else repr(v)
    return sorted(tuple(map(one, r)) for r in rows)


def same_rows(df, duck, sql: str) -> None:
    """Column names and rows of a Spark frame equal those of a DuckDB query."""
    columns = sorted(df.columns)
    own = normal(tuple(r) for r in df.select(*(f"`{c}`" for c in columns)).collect())
    theirs = duck.execute(f"SELECT {', '.join(f'\"{c}\"' for c in columns)} FROM ({sql}) AS q").fetchall()
    names = duck.execute(f"SELECT * FROM ({sql}) AS q LIMIT 0").description
    assert sorted(x[0] for x in names) == columns
    assert own == normal(theirs)
