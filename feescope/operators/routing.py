"""Question routing to result tables, context assembly and chat history.

Routing is a per-row expression over the whole lower-cased question text:
one ``contains`` per rule, built from the (small, fixed) rule list, so it
stays inside whole-stage codegen and needs no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feescope.operators.catalog import row_text
from feescope.session import materialize

# fixed values: keyword rules (keyword -> tables) in their original order
KEYWORD_RULES = (
    ("peak", ("hourly_congestion", "top5_peak_hours", "heatmap_matrix")),
    ("hour", ("hourly_congestion", "heatmap_matrix")),
    ("heatmap", ("heatmap_matrix",)),
    ("day", ("daily_index", "daily_congestion", "daily_volume_trend")),
    ("daily", ("daily_index", "daily_congestion", "daily_volume_trend")),
    ("congestion", ("daily_index", "hourly_congestion", "top_congested_days")),
    ("gas", ("hourly_congestion", "daily_index", "gas_distribution", "fee_paradox")),
    ("fee", ("fee_paradox", "gas_distribution")),
    ("ath", ("ath_day_hourly", "ath_high_value_txns", "daily_volume_trend")),
    ("august 24", ("ath_day_hourly", "ath_high_value_txns")),
    ("whale", ("ath_day_hourly", "ath_high_value_txns")),
    ("week", ("weekly_summary",)),
    ("trend", ("daily_volume_trend", "weekly_summary", "fee_paradox")),
    ("transaction", ("daily_volume_trend", "hourly_congestion", "fee_paradox")),
    ("volume", ("daily_volume_trend", "weekly_summary")),
    ("worst", ("top_congested_days", "top5_peak_hours")),
    ("top", ("top_congested_days", "top5_peak_hours")),
    ("distribution", ("gas_distribution",)),
    ("paradox", ("fee_paradox",)),
    ("block", ("top_congested_blocks",)),
)
# fixed values: intent rules, tried in order, first match only
INTENT_RULES = (
    (("peak hour",), ("hourly_congestion",)),
    (("peak day", "most congested day"), ("daily_index",)),
)
# fixed values: the fourteen result tables
ALL_TABLES = (
    "hourly_congestion",
    "daily_congestion",
    "heatmap_matrix",
    "top5_peak_hours",
    "daily_index",
    "top_congested_days",
    "gas_distribution",
    "weekly_summary",
    "top_congested_blocks",
    "ath_day_hourly",
    "avg_hourly_august",
    "ath_high_value_txns",
    "daily_volume_trend",
    "fee_paradox",
)


def _str_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _empty() -> Column:
    return F.array().cast("array<string>")


def matched_keywords(lowered: Column, rules=KEYWORD_RULES) -> Column:
    """Keywords contained in the text (substring semantics: "ath" in "path")."""
    return F.array_compact(F.array(*[F.when(lowered.contains(k), F.lit(k)) for k, _ in rules]))


def matched_tables(lowered: Column, rules=KEYWORD_RULES, intents=INTENT_RULES) -> Column:
    """Union of the intent tables (first intent that applies) and every
    contained keyword's tables, without duplicates."""
    intent = None
    for phrases, tables in intents:
        cond = None
        for p in phrases:
            c = lowered.contains(p)
            cond = c if cond is None else cond | c
        intent = F.when(cond, _str_array(tables)) if intent is None else intent.when(cond, _str_array(tables))
    intent = _empty() if intent is None else intent.otherwise(_empty())
    parts = [F.when(lowered.contains(k), _str_array(t)).otherwise(_empty()) for k, t in rules]
    return F.array_distinct(F.flatten(F.array(intent, *parts)))


def keyword_routing(
    questions: DataFrame,
    text_col: str = "text",
    rules=KEYWORD_RULES,
    intents=INTENT_RULES,
    catalog=ALL_TABLES,
) -> DataFrame:
    """J5 + J3: route each question to result tables.

    No match routes to every catalog table; matches are restricted to tables
    that exist in the catalog.  Adds ``keywords``, ``tables`` (both sorted)
    and ``fallback``.
    """
    lowered = F.lower(F.coalesce(F.col(text_col), F.lit("")))  # a null question matches nothing
    matched = matched_tables(lowered, rules, intents)
    cat = _str_array(catalog)
    tables = F.when(F.size(matched) == 0, cat).otherwise(
        F.filter(matched, lambda t: F.array_contains(cat, t))
    )
    return questions.withColumns(
        {
            "keywords": F.sort_array(matched_keywords(lowered, rules)),
            "tables": F.sort_array(tables),
            "fallback": F.size(matched) == 0,
        }
    )


def routed_pairs(routed: DataFrame, keys, catalog_df: DataFrame | None = None) -> DataFrame:
    """One row per (question, table); with ``catalog_df`` (column
    ``table_name``) keep only tables present in it (left semi join)."""
    pairs = routed.select(*keys, F.explode("tables").alias("table_name"))
    if catalog_df is not None:
        pairs = pairs.join(catalog_df.select("table_name").distinct(), "table_name", "left_semi")
    return pairs


# ---------------------------------------------------------------- X1 / T8
def _order_slots(tables: dict, orders: dict | None) -> dict[str, list[tuple[str, Column]]]:
    """Per table its sort columns as (slot, column).  A slot stands for a place in the order, a type and a
    direction, so tables with unlike orders can be sorted in one long table: the slots that a table
    does not use are null in all of its rows."""
    out = {}
    for name, df in tables.items():
        slots = []
        for i, spec in enumerate((orders or {}).get(name) or df.columns):
            column = spec.removeprefix("-")
            kind = df.schema[column].dataType.simpleString()
            slots.append((f"{i:03d} {'down' if spec.startswith('-') else 'up'} {kind}", F.col(column)))
        out[name] = slots
    return out


def table_renders(tables: dict, max_rows: int = 50, orders: dict | None = None, sep: str = " | ") -> DataFrame:
    """T8 / X1 helper: one row per table - name, row count and its text as shown to a reader: header line and at
    most ``max_rows`` rows (the first and last halves when longer), as stored.

    ``orders`` gives each table's stored order (names, ``-name`` for descending; all
    columns without one).  All tables' lines are written once, in one job, as one long
    table; its first ``max_rows`` and last ``max_rows // 2`` lines per table come from
    ranks whose limit is applied before the shuffle (a task sends at most that many
    lines per table), so no task holds a table.  An empty table is shown by its header.
    """
    slots = _order_slots(tables, orders)
    kinds = {slot: c for name, pairs in slots.items() for slot, c in pairs}
    names = {slot: f"_s{i}" for i, slot in enumerate(sorted(kinds))}
    long = None
    for name, df in tables.items():
        own = dict(slots[name])
        keys = [(own[s] if s in own else F.lit(None).cast(s.split(" ", 2)[2])).alias(names[s]) for s in sorted(kinds)]
        part = df.select(F.lit(name).alias("table_name"), row_text(df, sep).alias("line"), *keys)
        long = part if long is None else long.unionByName(part)
    long = materialize(long, "lines")

    def ranked(reverse: bool, most: int) -> DataFrame:
        by = [F.col(names[s]).desc() if (s.split(" ")[1] == "down") != reverse else F.col(names[s]).asc() for s in sorted(kinds)]
        rank = F.row_number().over(Window.partitionBy("table_name").orderBy(*by))
        return long.withColumn("_r", rank).where(F.col("_r") <= most).select("table_name", "line", F.col("_r").cast("long").alias("_r"))

    head_n, tail_n = (max_rows + 1) // 2, max_rows // 2
    first = ranked(False, max_rows).groupBy("table_name").agg(F.sort_array(F.collect_list(F.struct("_r", "line"))).alias("_first"))
    last = ranked(True, tail_n).select("table_name", (-F.col("_r")).alias("_r"), "line").groupBy("table_name").agg(
        F.sort_array(F.collect_list(F.struct("_r", "line"))).alias("_last"))
    counts = long.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_rows"))
    header = long.sparkSession.createDataFrame([(n, sep.join(df.columns)) for n, df in tables.items()], "table_name string, header string")
    found = header.join(counts, "table_name", "left").join(first, "table_name", "left").join(last, "table_name", "left")
    shown = F.when(F.col("n_rows") <= max_rows, F.col("_first")).otherwise(
        F.concat(F.slice("_first", 1, head_n), F.col("_last")))
    body = F.array_join(F.transform(shown, lambda x: x["line"]), "\n")
    return found.select("table_name", F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows"),
                        F.concat("header", F.lit("\n"), F.coalesce(body, F.lit(""))).alias("body"))


def render_rows(df: DataFrame, order=None, max_rows: int = 50, sep: str = " | ") -> DataFrame:
    """Row count and text of one table (see :func:`table_renders`)."""
    return table_renders({"": df}, max_rows, {"": order}, sep).select("n_rows", "body")


def context_assembly(routed: DataFrame, keys, renders: DataFrame) -> DataFrame:
    """Per question, "Table 'name' (n rows):" and the rendered rows of every
    routed table that exists, in table-name order.

    The text is put together once per distinct set of tables and joined to the
    questions by the set, so no rendered text is shuffled per question.  A
    question whose tables are all absent keeps its row, with an empty context.
    """
    sets = routed.select(F.array_join(F.sort_array("tables"), "\n").alias("_set")).distinct()
    block = F.concat(
        F.lit("\nTable '"), F.col("table_name"), F.lit("' ("), F.col("n_rows").cast("string"),
        F.lit(" rows):\n"), F.col("body"), F.lit("\n"),
    )
    texts = (
        sets.select("_set", F.explode(F.split("_set", "\n")).alias("table_name"))
        .join(renders, "table_name")
        .groupBy("_set")
        .agg(
            F.count(F.lit(1)).alias("n_tables"),
            F.array_join(
                F.transform(F.sort_array(F.collect_list(F.struct("table_name", block.alias("b")))), lambda x: x["b"]),
                "",
            ).alias("context"),
        )
    )
    asked = routed.select(*keys, F.array_join(F.sort_array("tables"), "\n").alias("_set"))
    return asked.join(texts, "_set", "left").select(
        *keys, F.coalesce("n_tables", F.lit(0).cast("long")).alias("n_tables"), F.coalesce("context", F.lit("")).alias("context"))


# ---------------------------------------------------------------- X2
def position_in_group(df: DataFrame, group: str, order: str, block: int = 4096) -> DataFrame:
    """1-based position of each row within its group, ordered by ``order``
    (unique within a group), without ranking a whole group in one task.

    Rows whose group or order is null are kept: nulls form a group, and null
    orders come last.  Rows are cut into blocks of ``block`` consecutive order values; a window
    over the per-block counts (rows / block entries) gives each block's
    offset, and a window inside each block (at most ``block`` rows) the rest.
    A conversation holding a third of all rows is spread over many tasks.
    """
    blk = F.floor(F.col(order) / F.lit(block))
    keyed = df.withColumn("_blk", blk)
    counts = keyed.groupBy(group, "_blk").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(group).orderBy(F.col("_blk").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col(group).alias("_g"), F.col("_blk").alias("_b"),
                            F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    within = Window.partitionBy(group, "_blk").orderBy(F.col(order).asc_nulls_last())
    same = F.col(group).eqNullSafe(F.col("_g")) & F.col("_blk").eqNullSafe(F.col("_b"))
    return (
        keyed.join(offsets, same, "inner")
        .withColumn("position", (F.col("_off") + F.row_number().over(within)).cast("long"))
        .drop("_blk", "_off", "_g", "_b")
    )


def chat_history(conversations: DataFrame, block: int = 4096) -> DataFrame:
    """Messages in turn order per conversation (long form).

    ``position`` is the 1-based place of the message after the system text;
    ``history_len`` the number of earlier messages a reply at this turn sees.
    The text is carried whole.
    """
    pos = position_in_group(conversations, "conv_id", "turn", block)
    return pos.select(
        "conv_id", "turn", "role", "text", "position", (F.col("position") - 1).alias("history_len")
    )


def reply_view(conversations: DataFrame, system: str, last: int = 6, block: int = 4096) -> DataFrame:
    """What a reply to each user message gets: ``messages``, an array of (role, text): the system text, the last
    ``last`` messages before it, the message itself.

    Every message goes to the at most ``last`` positions that see it and meets the
    user message there, so the exchange is keyed by (conversation, position): a group
    has at most ``last`` + 1 rows, however long the conversation.  Repeated rows of
    one turn take positions one after another; null texts are shown empty.
    """
    pos = position_in_group(conversations.select("conv_id", "turn", "role", "text"), "conv_id", "turn", block)
    asked = pos.where(F.col("role") == "user").select("conv_id", F.col("position").alias("at"), "turn")
    seen = pos.select("conv_id", "position", "role", F.coalesce("text", F.lit("")).alias("text"),
                      F.explode(F.sequence(F.col("position"), F.col("position") + last)).alias("at"))
    same = asked["conv_id"].eqNullSafe(seen["conv_id"]) & (asked["at"] == seen["at"])
    rows = asked.join(seen, same).select(asked["conv_id"], asked["at"], "turn", F.struct("position", "role", "text").alias("m"))
    got = rows.groupBy("conv_id", "at", "turn").agg(F.sort_array(F.collect_list("m")).alias("m"))
    first = F.array(F.struct(F.lit("system").alias("role"), F.lit(system).alias("text")))
    return got.select("conv_id", "turn", F.concat(first, F.transform("m", lambda m: F.struct(m["role"].alias("role"), m["text"].alias("text")))).alias("messages"))


GRAM = 3


def rule_matches(questions: DataFrame, rules: DataFrame, keys, text_col: str = "text") -> DataFrame:
    """J5 for rule tables: (keys, keyword) of every rule keyword (column ``keyword``) that a question's lower-cased text
    contains, once each.

    A keyword is looked for only where its rarest ``GRAM`` letters (by the number of
    questions that hold them) stand, then verified, so the plan does not grow with the
    rules and a frequent word costs no more than its rarest part.  Shorter keywords
    are looked for by themselves; empty and null ones match nothing.
    """
    words = rules.select(F.lower("keyword").alias("keyword")).where("keyword <> ''").distinct()
    texts = questions.select(*keys, F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("_text"))

    def grams(text: str, size: int) -> Column:
        last = F.length(text) - size + 1
        at = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(F.lit(1), last))).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(at, lambda i: F.substr(F.col(text), i, F.lit(size))))

    every = F.array_distinct(F.flatten(F.array(*[grams("_text", n) for n in range(1, GRAM + 1)])))
    held = texts.select(*keys, F.explode(every).alias("_gram"))
    own = F.when(F.length("keyword") < GRAM, F.array("keyword")).otherwise(grams("keyword", GRAM))
    parts = words.select("keyword", F.explode(own).alias("_gram"))
    count = held.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    # a gram that no question holds rules its keyword out
    rarest = parts.join(count, "_gram", "left").groupBy("keyword").agg(
        F.min_by("_gram", F.struct(F.coalesce("_n", F.lit(0)), "_gram")).alias("_gram"))
    found = held.join(rarest, "_gram").select(*(F.col(k).alias(f"_k_{k}") for k in keys), "keyword")  # texts don't travel with grams
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return found.join(texts, same).where(F.contains("_text", "keyword")).select(*keys, "keyword").distinct()
