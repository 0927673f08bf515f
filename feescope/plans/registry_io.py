"""Source / sink queries: each writes data derived from the given tables into
a fresh folder under the session's checkpoint folder and reads it back."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feescope import sinks as K
from feescope.config import EVENTS_SPEC
from feescope.operators import features as FT
from feescope.operators import reports as R
from feescope.plans import sql as S
from feescope.plans.registry import EW, REGISTRY, ev_clean, ev_raw, register, rounded
from feescope.plans.suite import TABLE_GROUPS, ReportSuite
from feescope.sources import raw as RAW
from feescope.sources import results as RS
from feescope.sources.paged import read_pages
from feescope.sources.standins import TABLE_SCHEMAS, events_as_raw, read_table

E = EVENTS_SPEC


CLEAN_COLUMNS = """block_timestamp, block_number, hash, from_address, to_address, gas, gas_price, receipt_gas_used,
       CAST(value_wei AS FLOAT) AS value_wei, hour_of_day, day_of_week, CAST(gas_fee_gwei AS FLOAT) AS gas_fee_gwei,
       CAST(tx_cost_gwei AS FLOAT) AS tx_cost_gwei, chain, date"""


@register("scan_clean", EW + f"SELECT {CLEAN_COLUMNS} FROM clean")
def q_scan_clean(spark, sf):
    """K2 + S5: write the cleaned zone partitioned by date, read all of it back."""
    path = K.scratch_path(spark, "clean")
    K.write_clean(ev_clean(spark, sf), path)
    return rounded(RAW.scan_clean(spark, path))


@register("scan_clean_day", EW + f"SELECT {CLEAN_COLUMNS} FROM clean WHERE date = DATE '{S.EVENTS.event_day}'")
def q_scan_clean_day(spark, sf):
    """One day of the cleaned zone, by partition pruning."""
    path = K.scratch_path(spark, "clean")
    K.write_clean(ev_clean(spark, sf), path)
    return rounded(RAW.scan_clean(spark, path, E.event_day, E.event_day))


@register(
    "rewrite_day",
    EW + f"SELECT date, count(*) AS rows, CAST(sum(receipt_gas_used) AS BIGINT) AS used FROM clean "
    f"WHERE date <> DATE '{S.EVENTS.event_day}' OR block_number % 2 = 0 GROUP BY date",
)
def q_rewrite_day(spark, sf):
    """K2: one day of the cleaned zone written again with half of its blocks; the other days stay."""
    path = K.scratch_path(spark, "clean")
    clean = ev_clean(spark, sf)
    K.write_clean(clean, path)
    K.rewrite_days(clean.where((F.col("date") == F.lit(E.event_day).cast("date")) & (F.col("block_number") % 2 == 0)), path)
    return RAW.scan_clean(spark, path).groupBy("date").agg(F.count(F.lit(1)).alias("rows"), F.sum("receipt_gas_used").alias("used"))


@register(
    "scan_nanos_ts",
    "SELECT ts AS block_timestamp, CAST(event_id AS VARCHAR) AS hash, event_id // 8 AS block_number FROM events",
)
def q_scan_nanos(spark, sf):
    """S3 + S4: a raw zone whose timestamp is a long of nanoseconds."""
    path = K.scratch_path(spark, "raw-nanos")
    raw = ev_raw(spark, sf).withColumn(
        "block_timestamp", F.unix_micros(F.col("block_timestamp").cast("timestamp")) * F.lit(1000)
    )
    K.write_chunked_parquet(raw, path, max_records=2500)
    back = RAW.scan_raw(spark, path)
    return back.select(F.col("block_timestamp").cast("timestamp_ntz").alias("block_timestamp"), "hash",
                       "block_number")


@register(
    "sink_chunked_parquet",
    "SELECT count(*) AS rows, CAST(ceil(count(*) / 2500.0) AS BIGINT) AS files, "
    "CAST(least(count(*), 2500) AS BIGINT) AS largest FROM events",
)
def q_sink_chunked(spark, sf):
    """K1: the files written are counted; each holds at most the chunk size."""
    path = K.scratch_path(spark, "raw-chunks")
    # one input partition, so that the number of files is exact (more partitions may each end with a part-filled file)
    K.write_chunked_parquet(ev_raw(spark, sf).coalesce(1), path, max_records=2500)
    per_file = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).count()
    return per_file.agg(F.sum("count").alias("rows"), F.count(F.lit(1)).alias("files"), F.max("count").alias("largest"))


@register(
    "paged_extract",
    "WITH " + S.RAW_EVENTS + """
SELECT * FROM raw
WHERE block_timestamp >= TIMESTAMP '2024-01-05 00:00:00' AND block_timestamp < TIMESTAMP '2024-01-12 00:00:00'""",
)
def q_paged_extract(spark, sf):
    """S2 + S1: a week of the events file, read page by page with the day range pushed to the pages."""
    events = read_pages(spark, f"{sf.rstrip('/')}/events.parquet", TABLE_SCHEMAS["events"])
    return RAW.extract_range(events_as_raw(events), "2024-01-05", "2024-01-11")


def _written_suite(spark, sf):
    suite = ReportSuite(ev_clean(spark, sf), E, with_blocks=True)
    root = K.scratch_path(spark, "results")
    K.write_result_tables(suite.tables(), root, TABLE_GROUPS)
    return suite, root


def _catalog_sql() -> str:
    counts = {
        "hourly_congestion": "SELECT count(DISTINCT hour_of_day) FROM clean",
        "daily_congestion": "SELECT count(DISTINCT day_of_week) FROM clean",
        "heatmap_matrix": "SELECT count(*) FROM (SELECT DISTINCT hour_of_day, day_of_week FROM clean)",
        "top5_peak_hours": "SELECT least(5, count(DISTINCT hour_of_day)) FROM clean",
        "daily_index": "SELECT count(DISTINCT date) FROM clean",
        "top_congested_days": "SELECT least(10, count(DISTINCT date)) FROM clean",
        "gas_distribution": f"SELECT count(DISTINCT {S.EVENTS.bucket}) FROM clean",
        "weekly_summary": "SELECT count(DISTINCT weekofyear(date)) FROM clean",
        "top_congested_blocks": "SELECT least(20, count(*)) FROM (SELECT DISTINCT block_number, date FROM clean)",
        "ath_day_hourly": f"SELECT count(DISTINCT hour_of_day) FROM clean WHERE date = DATE '{S.EVENTS.event_day}'",
        "avg_hourly_august": "SELECT count(DISTINCT hour_of_day) FROM clean",
        "ath_high_value_txns": "SELECT 1",
        "daily_volume_trend": "SELECT count(DISTINCT date) FROM clean",
        "fee_paradox": "SELECT count(DISTINCT date) FROM clean",
    }
    parts = [
        f"SELECT '{name}' AS table_name, CAST(1 AS BIGINT) AS n_files, CAST(({q}) AS BIGINT) AS n_rows"
        for name, q in counts.items()
    ]
    return EW + "\nUNION ALL\n".join(parts)


@register("result_catalog", _catalog_sql())
def q_result_catalog(spark, sf):
    """K3 + S6: write all fourteen tables as CSV, rediscover them in one scan."""
    _, root = _written_suite(spark, sf)
    return RS.catalog_files(spark, root).select("table_name", "n_files", "n_rows")


@register("load_part_csv", REGISTRY["hourly_congestion"].sql)
def q_load_part_csv(spark, sf):
    """K3 + S7: a result table round-tripped through its CSV folder, all columns."""
    path = K.scratch_path(spark, "hourly")
    K.write_result_csv(R.hourly_congestion(ev_clean(spark, sf), E), path)
    return rounded(RS.load_part_csv(spark, path, "hour_of_day int, tx_count long, avg_gas_gwei double, "
                                                 "p95_gas_gwei double, avg_tx_cost_gwei double, total_gas_used long, "
                                                 "congestion_score double"))


@register("load_part_csv_by_name", REGISTRY["hourly_congestion"].sql)
def q_load_part_csv_by_name(spark, sf):
    """The same table in three part files whose headers are in three orders, one with a column more."""
    path = K.scratch_path(spark, "hourly-parts")
    hourly = R.hourly_congestion(ev_clean(spark, sf), E)
    columns = hourly.columns
    for i, order in enumerate((columns, columns[::-1], [*columns[3:], "hour_of_day", "tx_count", "avg_gas_gwei"])):
        part = hourly.where(F.col("hour_of_day") % 3 == i).select(*order)
        K.write_result_csv(part.withColumn("note", F.lit("x,y")) if i == 1 else part, path, mode="append")
    return rounded(RS.load_part_csv(spark, path, "hour_of_day int, tx_count long, avg_gas_gwei double, "
                                                 "p95_gas_gwei double, avg_tx_cost_gwei double, total_gas_used long, "
                                                 "congestion_score double"))


EVENT_PARTS = "event_id long, ts_day date, value double"


def _event_parts(spark, sf) -> str:
    """Events as three CSV part files: two column orders and one that lacks ``value``; every seventh row has a
    cell too many, every eleventh a value that is no number."""
    path = K.scratch_path(spark, "event-parts")
    events = spark.read.parquet(f"{sf}/events.parquet").select(
        "event_id", F.to_date("ts").cast("string").alias("day"),
        F.when(F.col("event_id") % 11 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"),
        F.when(F.col("event_id") % 7 == 0, F.lit(",more")).otherwise("").alias("rest"))
    for i, (header, line) in enumerate((("event_id,ts_day,value", ("event_id", "day", "value")),
                                        ("value,event_id,ts_day", ("value", "event_id", "day")),
                                        ("event_id,ts_day", ("event_id", "day")))):
        rows = events.where(F.col("event_id") % 3 == i)
        K.append_csv_lines(rows.select(F.concat(F.concat_ws(",", *line), "rest")), header, path)
    return path


@register(
    "part_rows_kept",
    "SELECT event_id, CAST(ts AS DATE) AS ts_day, CAST(value AS FLOAT) AS value FROM events "
    "WHERE event_id % 3 <> 2 AND event_id % 7 <> 0 AND event_id % 11 <> 0",
)
def q_part_rows_kept(spark, sf):
    """The rows of part files in two header orders that fit their columns."""
    return rounded(RS.split_parts(spark, _event_parts(spark, sf), EVENT_PARTS)[0])


@register(
    "part_rows_rejected",
    """SELECT CAST(row_number() OVER (ORDER BY count(*), min(event_id)) AS INTEGER) AS part, count(*) AS rejects,
       CAST(sum(CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS cells_too_many FROM events
WHERE event_id % 3 = 2 OR event_id % 7 = 0 OR event_id % 11 = 0 GROUP BY event_id % 3""",
)
def q_part_rows_rejected(spark, sf):
    """Rejects counted per part file; the one without ``value`` goes whole."""
    bad = RS.split_parts(spark, _event_parts(spark, sf), EVENT_PARTS)[1]
    ids = F.regexp_extract("record", "(?:^|,)([0-9]+),[0-9]{4}-|^([0-9]+),", 0)
    n = bad.groupBy("path").agg(F.count(F.lit(1)).alias("rejects"), F.min(F.regexp_extract(ids, "[0-9]+", 0).cast("long")).alias("first"),
                                F.count_if(F.col("record").endswith(",more")).alias("cells_too_many"))
    order = W.orderBy("rejects", "first")  # three files
    return n.select(F.row_number().over(order).alias("part"), "rejects", "cells_too_many")


@register(
    "part_contract",
    "SELECT '' AS missing, '' AS extra, 2 AS files FROM events HAVING count(*) > 0 "
    "UNION ALL SELECT 'value', '', 1 FROM events HAVING count(*) > 0",
)
def q_part_contract(spark, sf):
    """U2 on part files: files by the columns they lack or have beyond the contract."""
    found = RS.part_contract(spark, _event_parts(spark, sf), EVENT_PARTS)
    return found.groupBy("missing", "extra").agg(F.count(F.lit(1)).cast("int").alias("files"))


def _feature_sql() -> str:
    from feescope.plans.registry_more import FEATURE_SELECT, FEATURES_SQL

    return FEATURES_SQL + f"SELECT {FEATURE_SELECT} FROM feat"


@register("scan_features", _feature_sql())
def q_scan_features(spark, sf):
    """K4 + S8: the feature CSV written in fixed column order, read back typed
    (doubles round-trip exactly through Spark's CSV text)."""
    feats = ReportSuite(ev_clean(spark, sf), E).feature_table()
    path = K.scratch_path(spark, "features")
    K.write_feature_csv(feats, path, FT.FEATURE_COLUMNS)
    return rounded(RS.scan_features(spark, path))


@register(
    "stream_clean",
    EW
    + """SELECT hash, block_number, hour_of_day, day_of_week, date, CAST(gas_fee_gwei AS FLOAT) AS gas_fee_gwei,
       CAST(tx_cost_gwei AS FLOAT) AS tx_cost_gwei FROM clean""",
)
def q_stream_clean(spark, sf):
    """K1 + streaming K2: raw chunks cleaned incrementally into the cleaned zone.

    Chunks have 2,000 rows up to 100,000 events and grow with the table beyond, so that batches do not grow in number.
    """
    from feescope.streaming.ingest import start_clean_stream

    raw_dir = K.scratch_path(spark, "stream-raw")
    raw = ev_raw(spark, sf).withColumn("block_timestamp", F.col("block_timestamp").cast("timestamp"))
    K.write_chunked_parquet(raw, raw_dir, max_records=K.chunk_rows(read_table(spark, sf, "events").count(), least=2000))
    clean_dir = K.scratch_path(spark, "stream-clean")
    query = start_clean_stream(spark, raw_dir, clean_dir, K.scratch_path(spark, "stream-ckpt"), E,
                               max_files_per_trigger=2)
    query.awaitTermination()
    back = spark.read.parquet(clean_dir)
    return rounded(back.select("hash", "block_number", "hour_of_day", "day_of_week", "date",
                               "gas_fee_gwei", "tx_cost_gwei"))
