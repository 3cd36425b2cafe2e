import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[8]").appName("tests").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "4")
               .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
               .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tests-")).getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Rows as tuples, sorted."""
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
