from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    built = SparkSession.builder.master("local[4]").config("spark.driver.memory", "4g").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
    session = built.config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tables(spark, tmp_path):
    """make(table=[rows as dicts]) -> a folder with those tables in the schemas of the test data; extra: columns that clash."""

    def make(extra: dict | None = None, **rows):
        from pyspark.sql import functions as F

        for name, given in rows.items():
            schema = spark.read.parquet(str(DATA / f"{name}.parquet")).schema
            df = spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in given], schema)
            for column, value in (extra or {}).items():
                if column not in df.columns:
                    df = df.withColumn(column, F.lit(value))
            df.coalesce(1).write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return make
