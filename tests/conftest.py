import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import get_spark

    s = get_spark("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sample():
    return os.environ.get("SAMPLE_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def duck(sample):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sample}/{t}.parquet')")
    return con


def rows_of(df):
    names = sorted(df.columns)
    return names, sorted((tuple(str(r[n]) for n in names) for r in df.collect()))


def rows_of_sql(con, sql):
    r = con.execute(sql)
    names = [d[0] for d in r.description]
    order = [names.index(n) for n in sorted(names)]
    return sorted(names), sorted(tuple(str(row[k]) for k in order) for row in r.fetchall())
