import pytest
from pyspark.sql import functions as F

from feescope.operators import clean as C
from feescope.sources.raw import ContractError, extract_range, normalize_timestamp, require_columns


def test_clean_drops_null_zero_negative(raw_df):
    out = C.clean(raw_df)
    hashes = {r.hash for r in out.collect()}
    assert hashes == {"h1", "h2", None, "h4", "h5", "h6", "h7"}
    assert out.count() == 7


def test_derived_columns(raw_df):
    rows = {r.hash: r for r in C.clean(raw_df).collect()}
    h4 = rows["h4"]
    assert (h4.hour_of_day, h4.day_of_week, str(h4.date)) == (23, 7, "2025-08-23")  # Saturday
    assert rows["h1"].gas_fee_gwei == 1.0
    assert rows["h2"].tx_cost_gwei == pytest.approx(3 * 50000)
    # price x used above 2^63 is computed in double, no overflow
    assert rows["h7"].tx_cost_gwei == pytest.approx(81_700 * 113_000_000)
    assert rows["h1"].chain == "ethereum"


def test_row_counts_one_pass(raw_df):
    r = C.row_counts(raw_df).first()
    assert (r.raw_rows, r.clean_rows) == (13, 7)


def test_nan_price_rejected(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (0.0,), (-1.0,)], "p double")
    assert C.positive_filter(df, ["p"]).count() == 1


def test_empty_input(spark, raw_df):
    assert C.clean(raw_df.limit(0)).count() == 0


def test_contract_missing_columns(raw_df):
    with pytest.raises(ContractError, match=r"\['gas', 'hash'\]"):
        require_columns(raw_df.drop("hash", "gas"), ["hash", "gas", "block_number"], "raw")


def test_nanosecond_timestamp(spark):
    ns = 1_756_000_000_123_456_789
    df = spark.createDataFrame([(ns,), (-1_500,)], "block_timestamp long")
    out = normalize_timestamp(df).select(F.unix_micros("block_timestamp").alias("us")).collect()
    assert [r.us for r in out] == [ns // 1000, -2]  # floor division, sub-second kept


def test_unsupported_timestamp_type(spark):
    df = spark.createDataFrame([("2025-08-24",)], "block_timestamp string")
    with pytest.raises(ContractError):
        normalize_timestamp(df)


def test_extract_range_is_closed_and_pushed(raw_df):
    out = extract_range(raw_df, "2025-08-24", "2025-08-24")
    assert {r.hash for r in out.collect()} == {"h1", "h2", None, "h5"}


def test_scan_raw_contract(spark, tmp_path_factory):
    from feescope import sinks as K
    from feescope.sources.raw import scan_raw

    path = K.scratch_path(spark, "t-raw-missing")
    spark.createDataFrame([(1, "h")], "block_number long, hash string").write.parquet(path)
    with pytest.raises(ContractError, match=r"\['block_timestamp', 'from_address', 'gas'"):
        scan_raw(spark, path)
