"""Query families beyond the reports: quality checks, features, cross-validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from feescope.config import EVENTS_SPEC, LINEITEM_SPEC
from feescope.functions.columns import cyclic_cos, cyclic_sin, lenient_int, one_hot
from feescope.operators import clean as C
from feescope.operators import features as FT
from feescope.operators import model as M
from feescope.operators import quality as Q
from feescope.operators import reports as R
from feescope.plans import sql as S
from feescope.plans.registry import EW, LW, ev_clean, li_clean, r6, register, rounded
from feescope.plans.suite import ReportSuite
from feescope.sources.standins import read_table

E = EVENTS_SPEC
FEATURES = [c for c in FT.FEATURE_COLUMNS if c not in (*FT.KEY_COLUMNS, FT.TARGET_COLUMN)]


def ev_suite(spark, sf):
    return ReportSuite(ev_clean(spark, sf), E)


def ev_features(spark, sf):
    """The guarded feature table from the cleaned rows: one plan, no eager job."""
    clean = ev_clean(spark, sf)
    return FT.guarded_feature_table(R.heatmap(clean, sort=False), R.hourly_congestion(clean, E, sort=False),
                                    R.weekday_congestion(clean, sort=False))


def ev_folded(spark, sf):
    return M.kfold_assign(ev_features(spark, sf), FT.KEY_COLUMNS)


# ----------------------------------------------------------------------
# quality
# ----------------------------------------------------------------------
@register(
    "duplicate_keys",
    EW
    + """SELECT block_number, count(*) AS count
FROM (SELECT DISTINCT block_number, date FROM clean) b
GROUP BY block_number HAVING count(*) > 1""",
)
def q_duplicate_keys(spark, sf):
    # blocks that span midnight appear once per date in the block table
    return Q.duplicate_keys(R.block_activity(ev_clean(spark, sf), E), ["block_number"])


@register(
    "missing_keys",
    EW[:-1]
    + ", " + LW[len("WITH "):].replace("raw AS", "li_raw AS").replace("FROM raw", "FROM li_raw").replace("clean AS", "li_clean AS")
    + """SELECT DISTINCT hour_of_day FROM clean
WHERE hour_of_day NOT IN (SELECT hour_of_day FROM li_clean)""",
)
def q_missing_keys(spark, sf):
    # hours of the event cells without a row in the line items' hourly report (which has hour 0 only)
    return Q.missing_keys(R.heatmap(ev_clean(spark, sf), sort=False),
                          R.avg_hourly_month(li_clean(spark, sf), LINEITEM_SPEC, sort=False), ["hour_of_day"])


@register(
    "grid_completeness",
    LW
    + """, grid AS (SELECT CAST(i % 24 AS INTEGER) AS hour_of_day, CAST(i // 24 + 1 AS INTEGER) AS day_of_week
              FROM range(168) t(i))
SELECT * FROM grid
WHERE (hour_of_day, day_of_week) NOT IN (SELECT (hour_of_day, day_of_week) FROM clean)""",
)
def q_grid_completeness(spark, sf):
    # line items ship at midnight: every hour but 0 is missing from the grid
    return Q.grid_completeness(R.heatmap(li_clean(spark, sf), sort=False))


FEATURES_SQL = (
    EW
    + """, heat AS (
  SELECT hour_of_day, day_of_week, avg(gas_fee_gwei) AS target_avg_gas_gwei, count(hash) AS cell_tx_count
  FROM clean GROUP BY 1, 2),
hr AS (
  SELECT hour_of_day, count(hash) AS hour_tx_count, quantile_disc(gas_fee_gwei, 0.95) AS hour_p95_gas_gwei,
         avg(tx_cost_gwei) AS hour_avg_tx_cost_gwei, CAST(sum(receipt_gas_used) AS DOUBLE) AS hour_total_gas_used
  FROM clean GROUP BY 1),
dw AS (
  SELECT day_of_week, count(hash) AS day_tx_count, avg(tx_cost_gwei) AS day_avg_tx_cost_gwei
  FROM clean GROUP BY 1),
feat AS (
  SELECT heat.hour_of_day, heat.day_of_week, target_avg_gas_gwei, cell_tx_count, hour_tx_count,
         hour_p95_gas_gwei, hour_avg_tx_cost_gwei, hour_total_gas_used, day_tx_count, day_avg_tx_cost_gwei,
         sin(2.0 * pi() * heat.hour_of_day / 24.0) AS hour_sin,
         cos(2.0 * pi() * heat.hour_of_day / 24.0) AS hour_cos,
"""
    + ",\n".join(f"         CAST(heat.day_of_week = {d} AS INTEGER) AS day_{d}" for d in range(1, 8))
    + """
  FROM heat JOIN hr ON heat.hour_of_day = hr.hour_of_day JOIN dw ON heat.day_of_week = dw.day_of_week),
folded AS (
  SELECT *, CAST(CAST(('0x' || substr(md5('42:' || CAST(hour_of_day AS VARCHAR) || ':'
                 || CAST(day_of_week AS VARCHAR)), 1, 8)) AS BIGINT) % 5 + 1 AS INTEGER) AS fold
  FROM feat)
"""
)

FEATURE_SELECT = ", ".join(
    r6(c, c) if c in ("target_avg_gas_gwei", "hour_p95_gas_gwei", "hour_avg_tx_cost_gwei",
                      "hour_total_gas_used", "day_avg_tx_cost_gwei", "hour_sin", "hour_cos") else c
    for c in FT.FEATURE_COLUMNS
)


@register(
    "null_check",
    LW
    + """, grid AS (SELECT CAST(i % 24 AS INTEGER) AS hour_of_day, CAST(i // 24 + 1 AS INTEGER) AS day_of_week
              FROM range(168) t(i)),
cells AS (SELECT hour_of_day, day_of_week, avg(gas_fee_gwei) AS avg_gas_gwei, count(hash) AS tx_count
          FROM clean GROUP BY 1, 2),
j AS (SELECT grid.*, avg_gas_gwei, tx_count FROM grid LEFT JOIN cells USING (hour_of_day, day_of_week))
SELECT count(*) FILTER (WHERE hour_of_day IS NULL) AS hour_of_day, count(*) FILTER (WHERE day_of_week IS NULL) AS day_of_week,
       count(*) FILTER (WHERE avg_gas_gwei IS NULL) AS avg_gas_gwei, count(*) FILTER (WHERE tx_count IS NULL) AS tx_count
FROM j""",
)
def q_null_check(spark, sf):
    # the whole grid, left-joined to the line items' cells (which cover hour 0 only)
    cells = R.heatmap(li_clean(spark, sf), sort=False)
    grid = Q.expected_grid(spark).join(cells, ["hour_of_day", "day_of_week"], "left")
    return Q.null_counts(grid, ["hour_of_day", "day_of_week", "avg_gas_gwei", "tx_count"])


@register(
    "null_check_features",
    FEATURES_SQL + "SELECT " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in FT.FEATURE_COLUMNS)
    + " FROM feat",
)
def q_null_check_features(spark, sf):
    return Q.null_counts(ev_features(spark, sf), FT.FEATURE_COLUMNS)


# ----------------------------------------------------------------------
# features
# ----------------------------------------------------------------------
@register("feature_table", FEATURES_SQL + f"SELECT {FEATURE_SELECT} FROM feat")
def q_feature_table(spark, sf):
    return rounded(ev_features(spark, sf))


@register("feature_join", FEATURES_SQL + f"SELECT {FEATURE_SELECT} FROM feat")
def q_feature_join(spark, sf):
    # the plain join straight from cleaned rows (no suite, no checks)
    clean = ev_clean(spark, sf)
    return rounded(
        FT.feature_join(R.heatmap(clean, sort=False), R.hourly_congestion(clean, E, sort=False),
                        R.weekday_congestion(clean, sort=False))
    )


@register(
    "cyclic_encoding",
    EW
    + f"""SELECT DISTINCT hour_of_day, {r6('sin(2.0 * pi() * hour_of_day / 24.0)', 'hour_sin')},
       {r6('cos(2.0 * pi() * hour_of_day / 24.0)', 'hour_cos')} FROM clean""",
)
def q_cyclic(spark, sf):
    hours = ev_clean(spark, sf).select("hour_of_day").distinct()
    return rounded(hours.select("hour_of_day", cyclic_sin("hour_of_day").alias("hour_sin"),
                                cyclic_cos("hour_of_day").alias("hour_cos")))


@register(
    "one_hot_weekday",
    EW + "SELECT DISTINCT day_of_week, "
    + ", ".join(f"CAST(day_of_week = {d} AS INTEGER) AS day_{d}" for d in range(1, 8)) + " FROM clean",
)
def q_one_hot(spark, sf):
    days = ev_clean(spark, sf).select("day_of_week").distinct()
    return days.select("day_of_week", *[one_hot("day_of_week", d).alias(f"day_{d}") for d in range(1, 8)])


@register(
    "lenient_int_parse",
    """SELECT event_id, CAST(trunc(CAST(CAST(value AS VARCHAR) AS DOUBLE)) AS BIGINT) AS value_int,
       CAST(trunc(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS BIGINT) AS k_int
FROM events""",
)
def q_lenient_int(spark, sf):
    ev = read_table(spark, sf, "events")
    return ev.select(
        "event_id",
        lenient_int(F.col("value").cast("string"), "value").alias("value_int"),
        lenient_int(F.get_json_object("props", "$.k"), "props.k").alias("k_int"),
    )


@register(
    "lenient_int_large",
    """SELECT l_orderkey, l_linenumber,
       CAST(trunc(CAST(CAST(l_orderkey * 3000001 + 2147483648 AS VARCHAR) || '.75' AS DOUBLE)) AS BIGINT) AS big_int
FROM lineitem""",
)
def q_lenient_int_large(spark, sf):
    # texts of numbers past 2^31
    text = F.concat((F.col("l_orderkey") * F.lit(3000001) + F.lit(2147483648)).cast("string"), F.lit(".75"))
    return read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", lenient_int(text, "l_orderkey").alias("big_int"))


INT_TEXTS_SQL = """CASE WHEN l_orderkey % 5 = 0 THEN l_returnflag WHEN l_orderkey % 7 = 0 THEN NULL ELSE CAST(l_partkey AS VARCHAR) || '.5' END"""
BIG_TEXTS_SQL = """CASE WHEN l_linenumber = 3 THEN '1e30' ELSE CAST(l_suppkey AS VARCHAR) END"""
INTS_SQL = f"""WITH t AS (SELECT l_orderkey, l_linenumber, {INT_TEXTS_SQL} AS a, {BIG_TEXTS_SQL} AS b FROM lineitem),
p AS (SELECT *, TRY_CAST(trunc(TRY_CAST(a AS DOUBLE)) AS BIGINT) AS x, TRY_CAST(trunc(TRY_CAST(b AS DOUBLE)) AS BIGINT) AS y FROM t)
"""


def li_split_ints(spark, sf):
    li = read_table(spark, sf, "lineitem")
    a = F.when(F.col("l_orderkey") % 5 == 0, F.col("l_returnflag")).when(F.col("l_orderkey") % 7 == 0, None).otherwise(
        F.concat(F.col("l_partkey").cast("string"), F.lit(".5")))
    b = F.when(F.col("l_linenumber") == 3, "1e30").otherwise(F.col("l_suppkey").cast("string"))
    rows = li.select("l_orderkey", "l_linenumber", a.alias("part"), b.alias("supplier"))
    return C.split_ints(rows, {"part": F.col("part"), "supplier": F.col("supplier")}, ["l_orderkey", "l_linenumber"])


@register(
    "lenient_int_kept",
    INTS_SQL + "SELECT l_orderkey, l_linenumber, x AS part, y AS supplier FROM p "
    "WHERE (a IS NULL OR x IS NOT NULL) AND y IS NOT NULL",
)
def q_lenient_int_kept(spark, sf):
    """Rows whose texts are all integers (or null)."""
    return li_split_ints(spark, sf)[0]


@register(
    "lenient_int_rejects",
    INTS_SQL + """SELECT l_orderkey, l_linenumber, 'part' AS "column", a AS text FROM p WHERE a IS NOT NULL AND x IS NULL
UNION ALL SELECT l_orderkey, l_linenumber, 'supplier', b FROM p WHERE y IS NULL""",
)
def q_lenient_int_rejects(spark, sf):
    """Every cell that is no integer, with its row and column."""
    return li_split_ints(spark, sf)[1]


# ----------------------------------------------------------------------
# cross-validation
# ----------------------------------------------------------------------
@register("kfold_assign", FEATURES_SQL + "SELECT hour_of_day, day_of_week, fold FROM folded")
def q_kfold(spark, sf):
    return ev_folded(spark, sf).select("hour_of_day", "day_of_week", "fold")


SCALER_SQL = (
    FEATURES_SQL
    + """, tc AS (SELECT folded.*, m.model_fold FROM folded
            JOIN (SELECT CAST(i AS INTEGER) AS model_fold FROM range(1, 6) t(i)) m ON m.model_fold <> folded.fold),
stats AS (SELECT model_fold, """
    + ", ".join(
        f"avg({c}) AS mean_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS scale_{c}"
        for c in FEATURES
    )
    + " FROM tc GROUP BY model_fold)\n"
)


@register(
    "fit_standard_scaler",
    SCALER_SQL + "SELECT model_fold, "
    + ", ".join(f"{r6(f'mean_{c}', f'mean_{c}')}, {r6(f'scale_{c}', f'scale_{c}')}" for c in FEATURES)
    + " FROM stats",
)
def q_scaler(spark, sf):
    return rounded(M.fit_standard_scaler(ev_folded(spark, sf), FEATURES))


@register(
    "scale_by_train_fold",
    SCALER_SQL
    + """SELECT f.hour_of_day, f.day_of_week, CAST(f.target_avg_gas_gwei AS FLOAT) AS target_avg_gas_gwei, f.fold,
       s.model_fold, CASE WHEN f.fold = s.model_fold THEN 'validation' ELSE 'train' END AS role, """
    + ", ".join(r6(f"(f.{c} - s.mean_{c}) / s.scale_{c}", c) for c in FEATURES)
    + " FROM folded f JOIN stats s ON true",
)
def q_scale(spark, sf):
    folded = ev_folded(spark, sf)
    stats = M.fit_standard_scaler(folded, FEATURES)
    return rounded(M.scale_by_train_fold(folded, stats, FEATURES))


BASELINE_SQL = (
    FEATURES_SQL
    + """, pf AS (SELECT fold, sum(target_avg_gas_gwei) AS s, count(target_avg_gas_gwei) AS n FROM folded GROUP BY fold),
tot AS (SELECT sum(s) AS ts, sum(n) AS tn FROM pf),
mm AS (SELECT pf.fold, (tot.ts - pf.s) / CAST(tot.tn - pf.n AS DOUBLE) AS predicted FROM pf, tot),
pred AS (SELECT folded.*, mm.predicted FROM folded LEFT JOIN mm ON folded.fold = mm.fold),
oof AS (SELECT hour_of_day, day_of_week, CAST(target_avg_gas_gwei AS FLOAT) AS actual_avg_gas_gwei,
               CAST(predicted AS FLOAT) AS predicted_avg_gas_gwei,
               abs(CAST(target_avg_gas_gwei AS FLOAT) - CAST(predicted AS FLOAT)) AS absolute_error FROM pred),
fm AS (SELECT 'fold' AS scope, p.fold AS fold, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse, sum(e * e) AS sse,
              sum((target_avg_gas_gwei - ybar) * (target_avg_gas_gwei - ybar)) AS sst
       FROM (SELECT *, target_avg_gas_gwei - predicted AS e FROM pred) p
       JOIN (SELECT fold, avg(target_avg_gas_gwei) AS ybar FROM pred GROUP BY fold) m ON p.fold = m.fold
       GROUP BY p.fold),
om AS (SELECT 'overall' AS scope, CAST(NULL AS INTEGER) AS fold, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse,
              sum(e * e) AS sse, sum((target_avg_gas_gwei - ybar) * (target_avg_gas_gwei - ybar)) AS sst
       FROM (SELECT *, target_avg_gas_gwei - predicted AS e FROM pred) p,
            (SELECT avg(target_avg_gas_gwei) AS ybar FROM pred) m),
metrics AS (SELECT scope, fold, mae, rmse,
                   CASE WHEN sst = 0 THEN CASE WHEN sse = 0 THEN 1.0 ELSE 0.0 END ELSE 1 - sse / sst END AS r2
            FROM (SELECT * FROM fm UNION ALL SELECT * FROM om) u)
"""
)


LEAST_SQUARES_SQL = (
    FEATURES_SQL
    + """, tc AS (SELECT folded.*, m.model_fold FROM folded
            JOIN (SELECT CAST(i AS INTEGER) AS model_fold FROM range(1, 6) t(i)) m ON m.model_fold <> folded.fold),
fit AS (SELECT model_fold AS fold, avg(hour_avg_tx_cost_gwei) AS mx, avg(target_avg_gas_gwei) AS my,
               covar_pop(hour_avg_tx_cost_gwei, target_avg_gas_gwei) / var_pop(hour_avg_tx_cost_gwei) AS b, count(*) AS n
        FROM tc GROUP BY model_fold),
pred AS (SELECT f.*, fit.my + fit.b * (f.hour_avg_tx_cost_gwei - fit.mx) AS predicted FROM folded f JOIN fit USING (fold))
"""
) + BASELINE_SQL[BASELINE_SQL.index(",\noof AS"):]


def ev_baseline(spark, sf):
    return M.fold_mean_baseline(ev_folded(spark, sf), FT.TARGET_COLUMN)


def _metrics_rounded(df):
    return rounded(df.select("scope", "fold", "mae", "rmse", "r2"))


@register("oof_predictions", BASELINE_SQL + "SELECT * FROM oof")
def q_oof(spark, sf):
    return M.oof_predictions(ev_baseline(spark, sf), FT.KEY_COLUMNS, FT.TARGET_COLUMN)


@register(
    "regression_metrics",
    BASELINE_SQL + "SELECT scope, fold, CAST(mae AS FLOAT) AS mae, CAST(rmse AS FLOAT) AS rmse, "
    "CAST(r2 AS FLOAT) AS r2 FROM metrics",
)
def q_metrics(spark, sf):
    return _metrics_rounded(M.cv_metrics(ev_baseline(spark, sf), FT.TARGET_COLUMN, "predicted"))


@register(
    "best_fold",
    BASELINE_SQL + "SELECT fold AS best_checkpoint_fold, CAST(rmse AS FLOAT) AS best_rmse FROM metrics "
    "WHERE scope = 'fold' ORDER BY rmse, fold LIMIT 1",
)
def q_best_fold(spark, sf):
    best = M.best_fold(M.cv_metrics(ev_baseline(spark, sf), FT.TARGET_COLUMN, "predicted"))
    return best.select("best_checkpoint_fold", F.col("best_rmse").cast("float").alias("best_rmse"))


@register(
    "residuals",
    BASELINE_SQL + "SELECT hour_of_day, day_of_week, predicted_avg_gas_gwei, "
    "actual_avg_gas_gwei - predicted_avg_gas_gwei AS residual FROM oof",
)
def q_residuals(spark, sf):
    oof = M.oof_predictions(ev_baseline(spark, sf), FT.KEY_COLUMNS, FT.TARGET_COLUMN)
    return M.residuals(oof, FT.KEY_COLUMNS)


@register(
    "value_range",
    BASELINE_SQL + "SELECT least(min(actual_avg_gas_gwei), min(predicted_avg_gas_gwei)) AS min_value, "
    "greatest(max(actual_avg_gas_gwei), max(predicted_avg_gas_gwei)) AS max_value FROM oof",
)
def q_value_range(spark, sf):
    oof = M.oof_predictions(ev_baseline(spark, sf), FT.KEY_COLUMNS, FT.TARGET_COLUMN)
    return M.value_range(oof)


