import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from quadrille.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("quadrille-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def starwars(spark):
    from fixtures import starwars_quads

    df = starwars_quads(spark).cache()
    df.count()
    return df


def rows(df, *columns):
    """All rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
