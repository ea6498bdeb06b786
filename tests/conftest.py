import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    base = tmp_path_factory.mktemp("spark")
    out = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.warehouse.dir", str(base / "warehouse")).config("spark.checkpoint.dir", f"file://{base}/shared").config("spark.driver.memory", "3g")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true").getOrCreate()
    )
    out.sparkContext.setLogLevel("ERROR")
    yield out
    out.stop()


@pytest.fixture
def col(spark):
    """Values of an expression over texts: one job for a list of cases."""
    from pyspark.sql import functions as F

    def run(expression, values, kind="string"):
        rows = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
        return [r[0] for r in rows.select(expression(F.col("x")).alias("y"), "i").orderBy("i").select("y").collect()]

    return run
