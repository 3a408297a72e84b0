import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cohort_risk.session import build_session, set_root  # noqa: E402


def make_session():
    from pyspark.sql import SparkSession

    active = SparkSession.getActiveSession()
    if active is not None:
        set_root(active)
        return active
    spark = build_session(
        "cohort_risk_tests", **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.bindAddress": "127.0.0.1",
            "spark.driver.host": "127.0.0.1",
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        })
    spark.sparkContext.setLogLevel("ERROR")
    set_root(spark)
    return spark


@pytest.fixture(scope="session")
def spark():
    return make_session()
