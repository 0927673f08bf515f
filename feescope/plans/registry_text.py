"""Text queries on ``conversations``: routing, routed tables, context, history."""

from __future__ import annotations

from pyspark.sql import functions as F

from feescope.operators import routing as RT
from feescope.plans.registry import register
from feescope.sources.standins import read_table

KEYS = ["conv_id", "turn"]

# Frequent substrings of the synthetic multilingual texts, so that several
# rules match one question and the union / de-duplication is exercised.
FREQUENT_RULES = (
    ("the", ("daily_index", "fee_paradox")),
    ("der", ("fee_paradox", "weekly_summary")),
    ("que", ("heatmap_matrix",)),
    ("ein", ("hourly_congestion", "daily_index")),
    ("hour", ("hourly_congestion", "heatmap_matrix")),
    ("ath", ("ath_day_hourly", "ath_high_value_txns", "daily_volume_trend")),
    ("zzqx", ("gas_distribution",)),
)
# Catalog without two of the tables, as if their folders were missing.
PARTIAL_CATALOG = tuple(t for t in RT.ALL_TABLES if t not in ("top5_peak_hours", "avg_hourly_august"))


def questions(spark, sf):
    conv = read_table(spark, sf, "conversations")
    return conv.where(F.col("role") == "user").select("conv_id", "turn", "text")


# The oracles' own rules, as literals: (keyword, table) pairs, the intents and the catalogs.
RULES_SQL = """
  ('peak', 'hourly_congestion'),
  ('peak', 'top5_peak_hours'),
  ('peak', 'heatmap_matrix'),
  ('hour', 'hourly_congestion'),
  ('hour', 'heatmap_matrix'),
  ('heatmap', 'heatmap_matrix'),
  ('day', 'daily_index'),
  ('day', 'daily_congestion'),
  ('day', 'daily_volume_trend'),
  ('daily', 'daily_index'),
  ('daily', 'daily_congestion'),
  ('daily', 'daily_volume_trend'),
  ('congestion', 'daily_index'),
  ('congestion', 'hourly_congestion'),
  ('congestion', 'top_congested_days'),
  ('gas', 'hourly_congestion'),
  ('gas', 'daily_index'),
  ('gas', 'gas_distribution'),
  ('gas', 'fee_paradox'),
  ('fee', 'fee_paradox'),
  ('fee', 'gas_distribution'),
  ('ath', 'ath_day_hourly'),
  ('ath', 'ath_high_value_txns'),
  ('ath', 'daily_volume_trend'),
  ('august 24', 'ath_day_hourly'),
  ('august 24', 'ath_high_value_txns'),
  ('whale', 'ath_day_hourly'),
  ('whale', 'ath_high_value_txns'),
  ('week', 'weekly_summary'),
  ('trend', 'daily_volume_trend'),
  ('trend', 'weekly_summary'),
  ('trend', 'fee_paradox'),
  ('transaction', 'daily_volume_trend'),
  ('transaction', 'hourly_congestion'),
  ('transaction', 'fee_paradox'),
  ('volume', 'daily_volume_trend'),
  ('volume', 'weekly_summary'),
  ('worst', 'top_congested_days'),
  ('worst', 'top5_peak_hours'),
  ('top', 'top_congested_days'),
  ('top', 'top5_peak_hours'),
  ('distribution', 'gas_distribution'),
  ('paradox', 'fee_paradox'),
  ('block', 'top_congested_blocks')"""
FREQUENT_SQL = """
  ('the', 'daily_index'),
  ('the', 'fee_paradox'),
  ('der', 'fee_paradox'),
  ('der', 'weekly_summary'),
  ('que', 'heatmap_matrix'),
  ('ein', 'hourly_congestion'),
  ('ein', 'daily_index'),
  ('hour', 'hourly_congestion'),
  ('hour', 'heatmap_matrix'),
  ('ath', 'ath_day_hourly'),
  ('ath', 'ath_high_value_txns'),
  ('ath', 'daily_volume_trend'),
  ('zzqx', 'gas_distribution')"""
INTENT_SQL = """CASE WHEN contains(lt, 'peak hour') THEN ['hourly_congestion']
       WHEN contains(lt, 'peak day') OR contains(lt, 'most congested day') THEN ['daily_index'] ELSE CAST([] AS VARCHAR[]) END"""
ALL_SQL = """['hourly_congestion', 'daily_congestion', 'heatmap_matrix', 'top5_peak_hours', 'daily_index', 'top_congested_days', 'gas_distribution', 'weekly_summary', 'top_congested_blocks', 'ath_day_hourly', 'avg_hourly_august', 'ath_high_value_txns', 'daily_volume_trend', 'fee_paradox']"""
PARTIAL_SQL = """['hourly_congestion', 'daily_congestion', 'heatmap_matrix', 'daily_index', 'top_congested_days', 'gas_distribution', 'weekly_summary', 'top_congested_blocks', 'ath_day_hourly', 'ath_high_value_txns', 'daily_volume_trend', 'fee_paradox']"""


def routing_sql(rules: str, catalog: str) -> str:
    return f"""WITH q AS (SELECT conv_id, turn, lower(coalesce(text, '')) AS lt FROM conversations WHERE role = 'user'),
rules(keyword, tbl) AS (VALUES{rules}),
kw AS (SELECT q.conv_id, q.turn, r.keyword, r.tbl FROM q JOIN rules r ON contains(q.lt, r.keyword)),
intent AS (SELECT conv_id, turn, unnest({INTENT_SQL}) AS tbl FROM q),
m AS (SELECT conv_id, turn, tbl FROM kw UNION SELECT conv_id, turn, tbl FROM intent),
agg AS (SELECT conv_id, turn, list_sort(list_distinct(list(tbl))) AS tables FROM m GROUP BY 1, 2),
kws AS (SELECT conv_id, turn, list_sort(list_distinct(list(keyword))) AS keywords FROM kw GROUP BY 1, 2),
cat AS (SELECT list_sort({catalog}) AS allt),
routed AS (
  SELECT q.conv_id, q.turn,
         array_to_string(coalesce(kws.keywords, CAST([] AS VARCHAR[])), ',') AS keywords,
         CASE WHEN agg.tables IS NULL THEN cat.allt
              ELSE list_filter(agg.tables, lambda x: list_contains(cat.allt, x)) END AS tables,
         agg.tables IS NULL AS fallback
  FROM q LEFT JOIN agg ON q.conv_id = agg.conv_id AND q.turn = agg.turn
         LEFT JOIN kws ON q.conv_id = kws.conv_id AND q.turn = kws.turn, cat)
"""


def _as_text(df):
    return df.select(
        *KEYS,
        F.array_join("keywords", ",").alias("keywords"),
        F.array_join("tables", ",").alias("tables"),
        "fallback",
    )


@register(
    "keyword_routing",
    routing_sql(RULES_SQL, ALL_SQL)
    + "SELECT conv_id, turn, keywords, array_to_string(tables, ',') AS tables, fallback FROM routed",
)
def q_keyword_routing(spark, sf):
    return _as_text(RT.keyword_routing(questions(spark, sf)))


@register(
    "keyword_routing_frequent",
    routing_sql(FREQUENT_SQL, ALL_SQL)
    + "SELECT conv_id, turn, keywords, array_to_string(tables, ',') AS tables, fallback FROM routed",
)
def q_keyword_routing_frequent(spark, sf):
    return _as_text(RT.keyword_routing(questions(spark, sf), rules=FREQUENT_RULES))


@register(
    "routed_tables",
    routing_sql(FREQUENT_SQL, ALL_SQL)
    + f"""SELECT conv_id, turn, table_name FROM (SELECT conv_id, turn, unnest(tables) AS table_name FROM routed)
WHERE list_contains({PARTIAL_SQL}, table_name)""",
)
def q_routed_tables(spark, sf):
    routed = RT.keyword_routing(questions(spark, sf), rules=FREQUENT_RULES)
    catalog = spark.createDataFrame([(t,) for t in PARTIAL_CATALOG], "table_name string")
    return RT.routed_pairs(routed, KEYS, catalog).select(*KEYS, "table_name")


@register(
    "chat_history",
    """SELECT conv_id, turn, role, text,
       row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS position,
       row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS history_len
FROM conversations""",
)
def q_chat_history(spark, sf):
    return RT.chat_history(read_table(spark, sf, "conversations"))


SYSTEM = "Answer from the tables."


@register(
    "reply_view",
    f"""WITH m AS (SELECT conv_id, turn, role, list(role || ': ' || coalesce(text, '')) OVER (
       PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS seen FROM conversations)
SELECT conv_id, turn, CAST(len(seen) + 1 AS INTEGER) AS n_messages,
       md5('system: {SYSTEM}' || chr(10) || array_to_string(seen, chr(10))) AS messages_md5 FROM m WHERE role = 'user'""",
)
def q_reply_view(spark, sf):
    """System text, the last four messages and the question, per user message."""
    view = RT.reply_view(read_table(spark, sf, "conversations"), SYSTEM, last=4)
    text = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["text"])), "\n")
    return view.select("conv_id", "turn", F.size("messages").alias("n_messages"), F.md5(text).alias("messages_md5"))


def benchmark_words(spark, sf):
    """Words of the benchmark items as a rule table."""
    words = read_table(spark, sf, "benchmark").select(F.explode(F.split(F.lower("text"), " ")).alias("keyword"))
    return words.where("length(keyword) > 1").distinct()


@register(
    "rule_table_matches",
    """WITH words AS (SELECT DISTINCT unnest(string_split(lower(text), ' ')) AS keyword FROM benchmark),
q AS (SELECT conv_id, turn, lower(coalesce(text, '')) AS text FROM conversations WHERE role = 'user')
SELECT conv_id, turn, count(*) AS n_keywords, md5(string_agg(keyword, ' ' ORDER BY keyword)) AS keywords_md5
FROM q JOIN words ON contains(q.text, keyword) WHERE length(keyword) > 1 GROUP BY conv_id, turn""",
)
def q_rule_table_matches(spark, sf):
    """The words of all benchmark items as rules over the users' questions."""
    found = RT.rule_matches(questions(spark, sf), benchmark_words(spark, sf), KEYS)
    return found.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_keywords"),
                                    F.md5(F.array_join(F.array_sort(F.collect_list("keyword")), " ")).alias("keywords_md5"))
