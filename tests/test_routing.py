import pytest
from pyspark.sql import functions as F

from feescope.operators import routing as RT


@pytest.fixture
def qs(spark):
    rows = [(1, 0, "What is the PEAK HOUR?"), (1, 1, "Which path did fees take?"), (2, 0, "hello there"),
            (2, 1, "Most congested day and the weekly trend"), (3, 0, "peak day block")]
    return spark.createDataFrame(rows, "conv_id long, turn long, text string")


def test_routing(qs):
    r = {(x.conv_id, x.turn): x for x in RT.keyword_routing(qs).collect()}
    assert r[(1, 0)].tables == sorted(["hourly_congestion", "top5_peak_hours", "heatmap_matrix"])
    assert r[(1, 1)].keywords == ["ath", "fee"]  # substring: "path" contains "ath"
    assert r[(2, 0)].fallback and r[(2, 0)].tables == sorted(RT.ALL_TABLES)
    assert "daily_index" in r[(2, 1)].tables and "weekly_summary" in r[(2, 1)].tables
    assert "top_congested_blocks" in r[(3, 0)].tables and "daily_index" in r[(3, 0)].tables


def test_catalog_filter(qs):
    r = RT.keyword_routing(qs, catalog=("hourly_congestion",))
    got = {(x.conv_id, x.turn): x.tables for x in r.collect()}
    assert got[(1, 0)] == ["hourly_congestion"]
    assert got[(1, 1)] == []  # matched, but nothing of it exists: no fallback
    assert got[(2, 0)] == ["hourly_congestion"]


def test_position_in_group_small_blocks(spark):
    rows = [(c, t, "user", f"m{c}{t}") for c in (1, 2) for t in (0, 3, 4, 7, 8, 9, 15)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = RT.chat_history(df, block=2).orderBy("conv_id", "turn").collect()
    assert [r.position for r in out if r.conv_id == 1] == [1, 2, 3, 4, 5, 6, 7]
    assert out[0].history_len == 0 and out[0].text == "m10"


def test_render_and_context(spark, qs):
    big = spark.range(120).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    small = spark.createDataFrame([(1, "a")], "x int, y string")
    renders = RT.table_renders({"hourly_congestion": big, "heatmap_matrix": small}, max_rows=50)
    r = {x.table_name: x for x in renders.collect()}
    lines = r["hourly_congestion"].body.split("\n")
    assert r["hourly_congestion"].n_rows == 120 and len(lines) == 51
    assert lines[1] == "0 | 0" and lines[-1] == "119 | 238" and lines[25] == "24 | 48" and lines[26] == "95 | 190"
    routed = RT.keyword_routing(qs, catalog=("hourly_congestion", "heatmap_matrix"))
    ctx = {(x.conv_id, x.turn): x for x in RT.context_assembly(routed, ["conv_id", "turn"], renders).collect()}
    c = ctx[(1, 0)]
    assert c.n_tables == 2 and c.context.index("'heatmap_matrix'") < c.context.index("'hourly_congestion'")
    assert "Table 'heatmap_matrix' (1 rows):" in c.context


def test_question_without_existing_tables_keeps_its_row(spark, qs):
    small = spark.createDataFrame([(1, "a")], "x int, y string")
    renders = RT.table_renders({"hourly_congestion": small})
    routed = RT.keyword_routing(qs, catalog=("hourly_congestion",))
    ctx = {(x.conv_id, x.turn): x for x in RT.context_assembly(routed, ["conv_id", "turn"], renders).collect()}
    assert len(ctx) == 5
    assert (ctx[(1, 1)].n_tables, ctx[(1, 1)].context) == (0, "")
    assert ctx[(1, 0)].n_tables == 1


def test_null_question_falls_back(spark):
    q = spark.createDataFrame([(1, 0, None)], "conv_id long, turn long, text string")
    r = RT.keyword_routing(q).first()
    assert r.fallback and r.tables == sorted(RT.ALL_TABLES) and r.keywords == []


def test_null_conversation_and_turn_survive(spark):
    rows = [(1, 0, "user", "a"), (1, None, "user", "b"), (None, 5, "user", "c"), (None, None, "user", "d"), (1, 9, "user", "e")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.text: r.position for r in RT.chat_history(df, block=2).collect()}
    assert got == {"a": 1, "e": 2, "b": 3, "c": 1, "d": 2}


def test_render_follows_the_stored_order(spark):
    t = spark.createDataFrame([(14, 9.0), (9, 8.0), (4, 7.0), (19, 6.0)], "hour int, score double")
    body = RT.render_rows(t, ("-score", "hour")).first().body
    assert [x.split(" | ")[0] for x in body.split("\n")[1:]] == ["14", "9", "4", "19"]


def test_tables_of_unlike_orders_are_rendered_together(spark):
    """Long integers beyond 2^53, texts, dates, descending and null keys, an empty and a single-row table."""
    big = 2**60
    tables = {
        "longs": spark.createDataFrame([(big + i, f"r{i}") for i in range(7)], "k long, v string"),
        "texts": spark.createDataFrame([("b", 1), (None, 2), ("a", 3)], "k string, v int"),
        "days": spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-09')) AS d"),
        "empty": spark.createDataFrame([], "k long"),
        "one": spark.createDataFrame([(1.5,)], "k double"),
    }
    got = {r.table_name: (r.n_rows, r.body.split("\n")) for r in RT.table_renders(
        tables, 4, {"longs": ("-k",), "texts": ("k",)}).collect()}
    assert got["longs"] == (7, ["k | v", f"{big + 6} | r6", f"{big + 5} | r5", f"{big + 1} | r1", f"{big} | r0"])
    assert got["texts"] == (3, ["k | v", " | 2", "a | 3", "b | 1"])
    assert got["days"] == (9, ["d", "2024-01-01", "2024-01-02", "2024-01-08", "2024-01-09"])
    assert got["empty"] == (0, ["k", ""])
    assert got["one"] == (1, ["k", "1.5"])


def test_render_limits_before_the_shuffle(spark):
    plan = RT.table_renders({"t": spark.range(1000)}, 10)._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan
