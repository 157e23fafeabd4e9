import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from plantlake.session import apply_recommended
    session = (apply_recommended(SparkSession.builder.master("local[8]").appName("tests"))
               .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
               .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
               .config("spark.sql.catalogImplementation", "in-memory").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from plantlake.queries.base import Tables
    return Tables(spark, SF)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *order) -> list[tuple]:
    return [tuple(r) for r in df.orderBy(*order).collect()]
