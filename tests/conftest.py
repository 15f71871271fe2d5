import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from gleaner.session import local_session
    s = local_session(str(tmp_path_factory.mktemp("spark")), "*", 8, app="gleaner-tests")
    yield s
    s.stop()


def one_col(spark, values, expr_fn, dtype="string"):
    """Evaluate a Column builder over a list of values; returns list in order."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    rows = df.select("i", expr_fn(F.col("v")).alias("out")).orderBy("i").collect()
    return [r["out"] for r in rows]
