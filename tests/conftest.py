import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from leasemill.session import build_session, shared_dir

    session = build_session(
        "tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            # The tables are tiny: compiling stages would take most of the time. The bench and the check run compiled code.
            "spark.sql.codegen.wholeStage": "false",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": tmp_path_factory.mktemp("shared").as_uri(),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    shared_dir(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not DATA.is_dir():
        pytest.skip("no test tables here")
    return str(DATA)


@pytest.fixture(scope="session")
def compare(spark, sf_dir):
    """Compares a query with its SQL over the smallest tables."""
    import datetime
    import math

    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS FROM '{p}'")

    def plain(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v + 0.0)
        if isinstance(v, datetime.datetime):
            return v.replace(tzinfo=None).isoformat()
        return str(v)

    def run(query, sql):
        df = query(spark, sf_dir)
        columns = sorted(df.columns)
        got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
        cursor = con.execute(sql)
        names = [d[0] for d in cursor.description]
        assert sorted(names) == columns
        wanted = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
        assert got == wanted

    return run
