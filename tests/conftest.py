import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from feescope.session import BASE_CONF, ensure_checkpoint_dir, release_scratch  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[4]").appName("feescope-tests")
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", "4")
    builder = builder.config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    release_scratch(s)


RAW_DDL = (
    "block_timestamp timestamp, block_number long, hash string, from_address string, to_address string, "
    "gas long, gas_price long, receipt_gas_used long, value_wei double"
)


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def raw_rows():
    """Edge rows of the raw transaction table (see FIXTURES.md)."""
    G = 1_000_000_000
    return [
        # block_timestamp, block, hash, from, to, gas, price (wei), used, value
        (ts("2025-08-24 00:10:00"), 100, "h1", "a", "b", 21000, 1 * G, 21000, 2e18),
        (ts("2025-08-24 00:20:00"), 100, "h2", "a", "b", 21000, 3 * G, 50000, 1e18),   # value at the limit
        (ts("2025-08-24 01:00:00"), 101, None, "a", "b", 21000, 5 * G, 10, 0.0),       # null hash
        (ts("2025-08-23 23:59:59"), 99, "h4", "a", "b", 21000, 10 * G, 30000, 5e18),   # block spans midnight
        (ts("2025-08-24 00:00:01"), 99, "h5", "a", "b", 21000, 20 * G, 40000, 0.0),
        (ts("2025-08-25 13:00:00"), 102, "h6", "a", "b", 21000, 50 * G, 7, 0.0),       # price exactly 50
        (ts("2025-08-25 13:30:00"), 102, "h7", "a", "b", 21000, 81_700 * G, 113_000_000, 0.0),  # product > 2^63
        (None, 103, "h8", "a", "b", 21000, 2 * G, 100, 0.0),                            # null timestamp
        (ts("2025-08-25 14:00:00"), 104, "h9", "a", "b", 21000, None, 100, 0.0),        # null price
        (ts("2025-08-25 14:00:00"), 104, "h10", "a", "b", 21000, 0, 100, 0.0),          # zero price
        (ts("2025-08-25 14:00:00"), 104, "h11", "a", "b", 21000, -5, 100, 0.0),         # negative price
        (ts("2025-08-25 14:00:00"), 104, "h12", "a", "b", 21000, 2 * G, 0, 0.0),        # zero used
        (ts("2025-08-25 14:00:00"), 104, "h13", "a", "b", 21000, 2 * G, None, 0.0),     # null used
    ]


@pytest.fixture
def raw_df(spark, raw_rows):
    return spark.createDataFrame(raw_rows, RAW_DDL)
