"""The four batch steps chained through files, on stand-in raw data."""

from pyspark.sql import functions as F

from feescope import sinks as K
from feescope.config import EVENTS_SPEC
from feescope.plans import jobs
from feescope.sources import results as RS
from feescope.sources.standins import events_raw

from conftest import SF01


def test_clean_reports_features_train(spark):
    raw_dir = K.scratch_path(spark, "job-raw")
    # nanosecond longs, as the extract writes them
    raw = events_raw(spark, SF01).withColumn(
        "block_timestamp", F.unix_micros(F.col("block_timestamp").cast("timestamp")) * 1000)
    K.write_chunked_parquet(raw, raw_dir, max_records=4000)

    clean_dir, results_dir = K.scratch_path(spark, "job-clean"), K.scratch_path(spark, "job-results")
    feats_dir, out_dir = K.scratch_path(spark, "job-features"), K.scratch_path(spark, "job-out")
    counts = jobs.clean_job(spark, raw_dir, clean_dir, EVENTS_SPEC)
    assert counts == {"raw_rows": 10000, "clean_rows": 9907}
    paths = jobs.reports_job(spark, clean_dir, results_dir, EVENTS_SPEC)
    assert len(paths) == 14
    cat = {r.table_name: r.n_rows for r in RS.catalog_files(spark, results_dir).collect()}
    assert cat["heatmap_matrix"] == 168 and cat["top_congested_blocks"] == 20 and cat["daily_index"] == 30
    jobs.features_job(spark, results_dir, feats_dir)
    feats = RS.scan_features(spark, feats_dir)
    assert feats.count() == 168 and feats.columns[2] == "target_avg_gas_gwei"
    jobs.train_job(spark, feats_dir, out_dir)
    doc = spark.read.json(f"{out_dir}/output/metrics").first()
    assert doc.dataset_rows == 168 and len(doc.fold_metrics) == 5 and 1 <= doc.best_checkpoint_fold <= 5
    preds = spark.read.option("header", True).csv(f"{out_dir}/output/predictions")
    assert preds.count() == 168
    model = {r.fold: r for r in spark.read.parquet(f"{out_dir}/models/least_squares").collect()}
    assert sorted(model) == [1, 2, 3, 4, 5] and model[doc.best_checkpoint_fold].training_rows > 100


def test_cli_parses_steps():
    import pytest

    with pytest.raises(SystemExit):
        jobs.main(["reports", "--help"])
