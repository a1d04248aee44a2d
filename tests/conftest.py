import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from nightaudit.session import SCALE_CONF, ensure_checkpoint_dir
    b = (SparkSession.builder.master("local[*]").appName("nightaudit-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def duck_small():
    from tools.compare import duck
    return duck(SF_SMALL)


class Tables(dict):
    """Hand-made hotel tables: missing ones are empty with the right schema."""

    def __init__(self, spark, **rows):
        super().__init__()
        self.spark = spark
        for name, data in rows.items():
            self[name] = self._df(name, data)

    def _df(self, name, data):
        from nightaudit.sources.schemas import HOTEL_SCHEMAS
        return self.spark.createDataFrame(data, schema=HOTEL_SCHEMAS[name])

    def __missing__(self, name):
        df = self._df(name, [])
        self[name] = df
        return df


@pytest.fixture
def tables(spark):
    return lambda **rows: Tables(spark, **rows)
