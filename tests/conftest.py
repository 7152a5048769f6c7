import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from starmart.session import ensure_checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


STAGING_SCHEMA = (
    "row_id long, order_id long, order_date date, ship_date date, ship_mode string, "
    "customer_id long, customer_name string, segment string, country string, city string, "
    "state string, postal_code string, region string, product_id long, category string, "
    "sub_category string, product_name string, sales decimal(18,4), quantity int, "
    "discount decimal(4,2), profit decimal(18,4)")


def line(row_id, order_id, order_date, customer_id=1, product_id=10, sales="100", profit="10",
         quantity=1, discount="0", ship_mode="Standard", ship_date=None, city="Paris",
         product_name="P", segment="Consumer", postal_code="75000"):
    """One staging line with sensible defaults."""
    return (row_id, order_id, order_date, ship_date or order_date, ship_mode, customer_id,
            f"C{customer_id}", segment, "France", city, "IDF", postal_code, "West", product_id,
            "Cat", "Sub", product_name, Decimal(sales), quantity, Decimal(discount),
            Decimal(profit))


@pytest.fixture
def make_staging(spark):
    def make(rows):
        return spark.createDataFrame(rows, STAGING_SCHEMA)
    return make


D = dt.date
