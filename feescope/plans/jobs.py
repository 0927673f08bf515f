"""Batch jobs, one per step, exchanging data through tables on shared storage.

    python -m feescope.plans.jobs clean    --raw RAW_DIR --out CLEAN_DIR
    python -m feescope.plans.jobs reports  --clean CLEAN_DIR --out RESULTS_DIR
    python -m feescope.plans.jobs features --results RESULTS_DIR --out FEATURES_DIR
    python -m feescope.plans.jobs train    --features FEATURES_DIR --out OUTPUT_DIR

Each step reads what the previous one wrote, so a failed step is rerun alone
and no step keeps a long lineage.  Options that set chain parameters
(``--event-day``, ``--month-days``, capacities, ``--percentiles``) apply to
``clean`` and ``reports``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from feescope import sinks as K
from feescope.config import DEFAULT_SPEC, ChainSpec
from feescope.operators import features as FT
from feescope.operators.clean import clean as clean_rows
from feescope.plans.suite import TABLE_GROUPS, ReportSuite
from feescope.plans.training import TrainingRun
from feescope.session import build_session, input_bytes, release_scratch, size_for_input
from feescope.sources import raw as RAW
from feescope.sources import results as RS


def clean_job(spark: SparkSession, raw_dir: str, out_dir: str, spec: ChainSpec = DEFAULT_SPEC) -> dict:
    """Raw zone -> cleaned zone (partitioned by date); returns row counts.

    Both counts are observed while the write runs: one pass over the raw data.
    """
    raw, raw_obs = K.observed(RAW.scan_raw(spark, raw_dir), "raw")
    cleaned, clean_obs = K.observed(clean_rows(raw, spec), "clean")
    K.write_clean(cleaned, out_dir)
    return {"raw_rows": raw_obs.get["rows"], "clean_rows": clean_obs.get["rows"]}


def reports_job(spark: SparkSession, clean_dir: str, out_dir: str, spec: ChainSpec = DEFAULT_SPEC,
                percentile_mode: str = "exact") -> dict[str, str]:
    """Cleaned zone -> the fourteen result tables as headered CSV folders."""
    suite = ReportSuite(RAW.scan_clean(spark, clean_dir), spec, percentile_mode=percentile_mode, with_blocks=True)
    return K.write_result_tables(suite.tables(), out_dir, TABLE_GROUPS)


HEATMAP_SCHEMA = "hour_of_day int, day_of_week int, avg_gas_gwei double, tx_count long"
HOURLY_SCHEMA = ("hour_of_day int, tx_count long, avg_gas_gwei double, p95_gas_gwei double, "
                 "avg_tx_cost_gwei double, total_gas_used long, congestion_score double")
WEEKDAY_SCHEMA = "day_of_week int, tx_count long, avg_gas_gwei double, avg_tx_cost_gwei double"


def features_job(spark: SparkSession, results_dir: str, out_dir: str) -> None:
    """Three result tables (CSV) -> checked feature table (CSV, fixed column order)."""
    root = results_dir.rstrip("/") + "/peak_hours"
    heat = RS.load_part_csv(spark, f"{root}/heatmap_matrix", HEATMAP_SCHEMA)
    hourly = RS.load_part_csv(spark, f"{root}/hourly_congestion", HOURLY_SCHEMA)
    weekday = RS.load_part_csv(spark, f"{root}/daily_congestion", WEEKDAY_SCHEMA)
    K.write_feature_csv(FT.checked_feature_table(heat, hourly, weekday), out_dir, FT.FEATURE_COLUMNS)


def train_job(spark: SparkSession, features_dir: str, out_dir: str) -> None:
    """Feature CSV -> predictions, metrics document, model record."""
    TrainingRun(RS.scan_features(spark, features_dir)).write(out_dir)


def _spec(args) -> ChainSpec:
    kw = {}
    for name in ("event_day", "month_days", "block_gas_limit", "blocks_per_day", "large_value_limit", "chain"):
        value = getattr(args, name, None)
        if value is not None:
            kw[name] = value
    return DEFAULT_SPEC.with_(**kw)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="feescope.plans.jobs")
    sub = ap.add_subparsers(dest="step", required=True)
    for step, inputs in (("clean", ["raw"]), ("reports", ["clean"]), ("features", ["results"]),
                         ("train", ["features"])):
        p = sub.add_parser(step)
        for name in inputs:
            p.add_argument(f"--{name}", required=True)
        p.add_argument("--out", required=True)
        p.add_argument("--master", default=None)
        if step in ("clean", "reports"):
            p.add_argument("--chain")
            p.add_argument("--event-day")
            p.add_argument("--month-days", type=int)
            p.add_argument("--block-gas-limit", type=float)
            p.add_argument("--blocks-per-day", type=float)
            p.add_argument("--large-value-limit", type=float)
            p.add_argument("--percentiles", default="exact", choices=["exact", "approx", "sketch"])
    args = ap.parse_args(argv)
    spark = build_session(args.master, app_name=f"feescope-{args.step}")
    source = {"clean": "raw", "reports": "clean", "features": "results", "train": "features"}[args.step]
    size_for_input(spark, input_bytes(spark, getattr(args, source)))
    if args.step == "clean":
        print(clean_job(spark, args.raw, args.out, _spec(args)))
    elif args.step == "reports":
        for name, path in reports_job(spark, args.clean, args.out, _spec(args), args.percentiles).items():
            print(name, path)
    elif args.step == "features":
        features_job(spark, args.results, args.out)
    else:
        train_job(spark, args.features, args.out)
    release_scratch(spark)


if __name__ == "__main__":
    main()
