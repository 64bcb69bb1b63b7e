from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from glossaria.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    return session


@pytest.fixture
def one(spark):
    """The value of a column expression over one row of named values."""
    from pyspark.sql import functions as F

    def run(value, **columns):
        df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()])
        return df.select(value.alias("v")).first()[0]

    return run
