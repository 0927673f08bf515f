import pytest

from feescope.operators import features as FT
from feescope.operators import quality as Q
from feescope.sources.raw import ContractError


def grid(spark, drop=None, dup=False):
    rows = [(h, d, 1.0 + h, 10) for d in range(1, 8) for h in range(24) if (h, d) != drop]
    if dup:
        rows.append((0, 1, 5.0, 3))
    return spark.createDataFrame(rows, "hour_of_day int, day_of_week int, avg_gas_gwei double, tx_count long")


def hourly(spark, hours=range(24)):
    return spark.createDataFrame([(h, 100, 2.0, 3.0, 1000) for h in hours],
                                 "hour_of_day int, tx_count long, p95_gas_gwei double, "
                                 "avg_tx_cost_gwei double, total_gas_used long")


def weekday(spark, days=range(1, 8)):
    return spark.createDataFrame([(d, 500, 4.0) for d in days], "day_of_week int, tx_count long, "
                                                                "avg_tx_cost_gwei double")


def test_feature_table_ok(spark):
    f = FT.checked_feature_table(grid(spark), hourly(spark), weekday(spark))
    assert f.columns == list(FT.FEATURE_COLUMNS) and f.count() == 168
    r = f.where("hour_of_day = 5 AND day_of_week = 3").first()
    assert (r.day_3, r.day_1, r.hour_total_gas_used, r.hour_tx_count) == (1, 0, 1000.0, 100)


def test_missing_grid_cell(spark):
    assert [tuple(r) for r in Q.grid_completeness(grid(spark, drop=(7, 2))).collect()] == [(7, 2)]
    with pytest.raises(ContractError, match="Expected 168"):
        FT.checked_feature_table(grid(spark, drop=(7, 2)), hourly(spark), weekday(spark))


def test_duplicate_key(spark):
    assert Q.duplicate_keys(grid(spark, dup=True), ["hour_of_day", "day_of_week"]).count() == 1
    with pytest.raises(ContractError, match="duplicate keys"):
        FT.checked_feature_table(grid(spark, dup=True), hourly(spark), weekday(spark))


def test_missing_partner(spark):
    miss = Q.missing_keys(grid(spark), hourly(spark, range(23)), ["hour_of_day"]).collect()
    assert [r.hour_of_day for r in miss] == [23]
    with pytest.raises(ContractError, match="hourly_congestion"):
        FT.checked_feature_table(grid(spark), hourly(spark, range(23)), weekday(spark))


def test_dimension_without_partner_is_fine(spark):
    # an extra weekday row without cells is not an error (inner join drops it)
    extra = weekday(spark).union(weekday(spark, [9]))
    assert FT.checked_feature_table(grid(spark), hourly(spark), extra).count() == 168


def test_empty_input(spark):
    with pytest.raises(ContractError, match="empty"):
        FT.checked_feature_table(grid(spark).limit(0), hourly(spark), weekday(spark))


def test_null_counts(spark):
    df = spark.createDataFrame([(1, None), (None, 2.0), (3, 4.0)], "a int, b double")
    r = Q.null_counts(df).first()
    assert (r.a, r.b) == (1, 1)
    with pytest.raises(ContractError, match=r"\['a', 'b'\]"):
        Q.assert_no_nulls(df)


def test_model_feature_columns(spark):
    f = FT.feature_join(grid(spark), hourly(spark), weekday(spark))
    cols = FT.model_feature_columns(f)
    assert "target_avg_gas_gwei" not in cols and cols[0] == "cell_tx_count" and len(cols) == 16
