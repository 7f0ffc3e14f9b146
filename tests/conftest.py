from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("plumbline-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    return path


@pytest.fixture
def order_rows():
    """Rows in the declared order shape, given as changes to a valid one."""
    from datetime import date

    base = ("a", "c1", 10.0, date(2024, 1, 1), "Books", "UPI", "Delivered", 30)
    names = (
        "order_id customer_id order_amount order_date product_category payment_method "
        "delivery_status customer_age"
    ).split()

    def build(*changes: dict) -> list[tuple]:
        return [tuple({**dict(zip(names, base)), **c}[n] for n in names) for c in changes]

    return build
