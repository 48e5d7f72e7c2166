import os
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(REPO))
os.environ["PYTHONPATH"] = f"{REPO}:{os.environ.get('PYTHONPATH', '')}"
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return DATA


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def plain(v):
    """One text for a value, whichever engine it comes from."""
    import pandas as pd

    if hasattr(v, "tolist") and getattr(v, "ndim", 0) or isinstance(v, list):
        return str([plain(x) for x in v])
    if pd.isna(v):
        return "~"
    if type(v).__name__.startswith("bool"):
        return str(bool(v))
    try:
        return f"{float(v):.9g}"
    except (TypeError, ValueError):
        return str(v)


def same(a, b):
    """Asserts that two pandas frames hold the same rows, whatever their order."""
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    left, right = (sorted(tuple(map(plain, r)) for r in x[cols].itertuples(index=False)) for x in (a, b))
    assert len(left) == len(right)
    wrong = [(x, y) for x, y in zip(left, right, strict=True) if x != y]
    assert not wrong, wrong[:3]
