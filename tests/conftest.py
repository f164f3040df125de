import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: The driver's tables that the tests read.
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "6g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def same_rows(got, sql: str, sf_dir: str) -> None:
    """Compares a Spark result with what DuckDB makes of the SQL, column names included, in any order."""
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{sf_dir}/{f}')")
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    plain = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    rows = lambda table, order: sorted(tuple(plain(r[i]) for i in order) for r in table)
    columns = sorted(names)
    assert rows([tuple(r) for r in got.collect()], [got.columns.index(c) for c in columns]) == rows(want.fetchall(), [names.index(c) for c in columns])
