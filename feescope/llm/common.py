"""Helpers shared by the corpus operators: code shipping, scratch tables, components."""

from __future__ import annotations

import atexit
import ctypes
import os
import shutil
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import feescope
from feescope.session import materialize

_SHIPPED: set[str] = set()
_KEPT: dict[tuple, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables, read only through Spark."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package once per application (``addPyFile``).

    Functions then travel by name, and module state (tokenizers, word caches)
    lives as long as a Python worker instead of one task.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(feescope.__file__))
    d = tempfile.mkdtemp(prefix="feescope-code-")  # Spark's file server reads it while the application runs
    atexit.register(shutil.rmtree, d, ignore_errors=True)
    path = os.path.join(d, f"feescope-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def kept(key: tuple, load):
    """``load()``, remembered in this Python worker until another key is asked for.

    A worker lives through many stages; it holds one large object (a tokenizer) at a time.
    """
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = load()
    return _KEPT[key]


def release_memory() -> None:
    """Give freed memory back to the system: Arrow's pool and, where there is glibc, its heap."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def hash_unit(*cols: Column) -> Column:
    """A uniform double in (0, 1) that depends only on the columns' values."""
    return (F.shiftrightunsigned(F.xxhash64(*cols), 12).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def connected_components(edges: DataFrame, name: str = "components", max_rounds: int = 100) -> DataFrame:
    """Smallest reachable node of every node that has an edge: (node, root).

    ``edges`` has two long columns ``u``, ``v`` (u != v; order and repeats are
    free).  Alternating large-star and small-star rounds; each is two partial
    aggregations (``min``) and joins that AQE can split, so a star with a third
    of all nodes does not land in one task.  Every round is a written table.
    Rounds grow with the logarithm of the longest chain; ``max_rounds`` only
    guards against a fault and raises.
    """

    def mark(df: DataFrame) -> tuple:
        r = df.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        return r["n"], r["h"]

    def large_star(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return both.join(m, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()

    def small_star(e: DataFrame) -> DataFrame:
        m = e.groupBy("u").agg(F.min("v").alias("m"))
        rest = e.join(m, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return rest.unionByName(m.select("u", F.col("m").alias("v"))).distinct()

    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = materialize(edges.distinct(), name)
    before = mark(now)
    for _ in range(max_rounds):
        if not before[0]:
            break
        now = materialize(small_star(large_star(now)), name)
        after = mark(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
