"""Result-table sources: the CSV catalog, part-file folders, feature CSVs."""

from __future__ import annotations

import csv
import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feescope.operators.features import FEATURE_COLUMNS
from feescope.sources.raw import ContractError


def catalog_files(spark: SparkSession, root: str) -> DataFrame:
    """S6 (discovery): one scan over every ``part-*.csv`` below ``root``.

    Returns (table_name, folder, n_files, n_rows): the table name is the
    parent folder of each part file; header lines are not counted.  Files
    of one table are unioned (a second part file adds rows).
    """
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "part-*.csv")
        .text(root)
        .select("value", F.col("_metadata.file_path").alias("path"))
    )
    parts = F.split(F.col("path"), "/")
    keyed = lines.select(
        F.element_at(parts, -2).alias("table_name"),
        F.regexp_replace("path", "/[^/]*$", "").alias("folder"),
        "path",
    )
    per_file = keyed.groupBy("table_name", "folder", "path").agg(F.count(F.lit(1)).alias("lines"))
    return per_file.groupBy("table_name", "folder").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum(F.col("lines") - 1).alias("n_rows")
    )


def _header_columns(line: str) -> list[str]:
    """Column names of a header line (no line breaks inside quoted names)."""
    return next(csv.reader([line.lstrip("\ufeff")]), [])


def part_headers(spark: SparkSession, root: str) -> DataFrame:
    """(path, header) of every non-empty ``part-*.csv`` below ``root``, in one scan of all of them.

    The first line is the one with the smallest row number of the split at
    offset 0; one row per file leaves each task.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "part-*.csv").text(root)
        .where(F.col("_metadata.file_block_start") == 0)
        .select(F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("at"))
    )
    return lines.groupBy("path").agg(F.min_by("value", "at").alias("header"))


def _by_header(headers: dict[str, str]) -> dict[tuple[str, ...], list[str]]:
    """Columns -> the part files that have them in this order."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, line in sorted(headers.items()):
        groups.setdefault(tuple(_header_columns(line)), []).append(path)
    return groups


def _read_parts(spark: SparkSession, groups: dict[tuple[str, ...], list[str]], schema: T.StructType | None,
                corrupt: bool = False) -> DataFrame:
    """Part files united by column name, one scan for each distinct header.

    With a ``schema`` its columns are taken, others left out; without one the
    types are inferred per scan and widened where scans differ (text if there is
    no common type).
    """
    if schema is None:
        scans = [spark.read.option("header", True).option("inferSchema", True).csv(files) for files in groups.values()]
        kinds: dict[str, set[str]] = {}
        for df in scans:
            for f in df.schema:
                kinds.setdefault(f.name, set()).add(f.dataType.simpleString())
        numbers = {"int", "bigint", "double"}
        mixed = {c for c, k in kinds.items() if len(k) > 1 and not k <= numbers}
        # text is read again as it stands in the file; numbers widen in the union
        scans = [df if not mixed.intersection(df.columns) else spark.read.option("header", True).schema(T.StructType(
            [T.StructField(f.name, T.StringType() if f.name in mixed else f.dataType) for f in df.schema])).csv(files)
            for df, files in zip(scans, groups.values())]
    else:
        scans = []
        for columns, files in groups.items():
            kept = {f.name: f for f in schema}
            fields = [kept.get(c, T.StructField(c, T.StringType())) for c in columns]
            out = list(schema.names)
            reader = spark.read.option("header", True).option("enforceSchema", False)
            if corrupt:
                fields.append(T.StructField(CORRUPT, T.StringType()))
                out.append(CORRUPT)
                reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, columnPruning=False, enforceSchema=True)
            df = reader.schema(T.StructType(fields)).csv(files)
            if corrupt:  # the parser looks only at cells that are asked for; a row is to be judged by all of them: always true
                df = df.where(F.pmod(F.hash(*schema.names), F.lit(2)) < 2)
            scans.append(df.select(*out, *([F.col("_metadata.file_path").alias(PATH)] if corrupt else [])))
    whole = scans[0]
    for df in scans[1:]:
        whole = whole.unionByName(df)
    return whole


CORRUPT, PATH = "_corrupt_record", "_path"


def _folder_headers(spark: SparkSession, folder: str) -> dict[str, str]:
    """path -> header line of one folder's part files (one row per file)."""
    missing = FileNotFoundError(f"No part-*.csv files found in {folder}")
    try:
        headers = {r["path"]: r["header"] for r in part_headers(spark, folder).collect()}
    except AnalysisException as exc:
        raise missing from exc
    if not headers:
        raise missing
    return headers


def load_part_csv(spark: SparkSession, folder: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Every ``part-*.csv`` of one folder, headered, united by column name;
    typed by ``schema`` or inferred.

    Headers may name the columns in any order and may have columns beyond the
    schema, which are left out.  No part file is an error naming the folder; a
    header without a column of the schema (without one: of the other parts) is an
    error naming the file and the columns.  Files without any line add nothing.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    groups = _by_header(_folder_headers(spark, folder))
    wanted = schema.names if schema is not None else sorted({c for columns in groups for c in columns})
    for columns, files in groups.items():
        if lost := [c for c in wanted if c not in columns]:
            raise ContractError(f"{files[0]} lacks the columns {lost}; its header is {list(columns)}")
    return _read_parts(spark, groups, schema)


def part_contract(spark: SparkSession, folder: str, schema: T.StructType | str) -> DataFrame:
    """One row per part file of a folder: path, missing and extra columns against ``schema`` (sorted, comma-joined)."""
    names = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).names
    want = F.array(*[F.lit(n) for n in names])
    have = F.split(F.regexp_replace("header", '"', ""), ",")
    text = {k: F.array_join(F.array_sort(F.array_except(x, y)), ",") for k, x, y in (("missing", want, have), ("extra", have, want))}
    return part_headers(spark, folder).select("path", *(v.alias(k) for k, v in text.items()))


def split_parts(spark: SparkSession, folder: str, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects) of one folder's part files, united by column name.

    A row that has too many or too few cells, or a cell that is not of its column's
    type, is a reject: (path, record), the record as it stands in the file.  Every
    other row of the same file is kept.  A file that lacks a column of the schema is
    rejected whole.  Both sides are read in the same way, so they sum to the input.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    groups = _by_header(_folder_headers(spark, folder))
    whole = {c: f for c, f in groups.items() if set(schema.names) <= set(c)}
    lost = [path for c, files in groups.items() if c not in whole for path in files]
    good, bad = spark.createDataFrame([], schema), spark.createDataFrame([], "path string, record string")
    if whole:
        rows = _read_parts(spark, whole, schema, corrupt=True)
        good = rows.where(F.col(CORRUPT).isNull()).select(*schema.names)
        bad = rows.where(F.col(CORRUPT).isNotNull()).select(F.col(PATH).alias("path"), F.col(CORRUPT).alias("record"))
    if lost:
        lines = spark.read.text(lost).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("record"))
        headers = part_headers(spark, folder)
        bad = bad.unionByName(lines.join(headers, "path").where("record <> header").select("path", "record"))
    return good, bad


def part_files(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """folder -> its ``part-*.csv`` files, sorted, for every folder below ``root`` (a listing, no job)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, files = {}, fs.listFiles(path, True)
    while files.hasNext():
        name = files.next().getPath().toString()
        folder, _, leaf = name.rpartition("/")
        if leaf.startswith("part-") and leaf.endswith(".csv"):
            found.setdefault(folder, []).append(name)
    return {k: sorted(v) for k, v in sorted(found.items())}


def readable_parts(files: list[str], headers: dict[str, str]) -> tuple[dict[tuple[str, ...], list[str]], list[tuple[str, str]]]:
    """(readable part files by their header, [(unreadable part file, reason)]) of one folder.

    A part file is unreadable if it has no header (an empty file, say) or if its
    columns are another table's (not those of the folder's first readable file, in
    whatever order).
    """
    lines = {p: headers[p] for p in files if headers.get(p)}
    bad = [(p, "no header") for p in files if p not in lines]
    groups = _by_header(lines)
    first = next((c for c, f in groups.items() if f[0] == min(lines)), ())
    for columns, paths in list(groups.items()):
        if sorted(columns) != sorted(first):
            bad += [(p, f"its columns are {list(columns)}, not {list(first)}") for p in paths]
            del groups[columns]
    return groups, bad


def load_result_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Every result table below ``root`` by name, each with its own inferred
    schema.  One scan finds all headers; the driver holds one line per part file.

    Part files of a folder are united by column name.  Unreadable ones are reported
    (a warning each) and skipped.  Folders of one name are one table: they are united
    if their columns agree and are an error if not.
    """
    tables: dict[str, DataFrame] = {}
    listed = part_files(spark, root)
    headers = {r["path"]: r["header"] for r in part_headers(spark, root).collect()} if listed else {}
    for folder, files in listed.items():
        name = folder.rpartition("/")[2]
        good, bad = readable_parts(files, headers)
        for path, reason in bad:
            warnings.warn(f"skipped unreadable part file {path}: {reason}", stacklevel=2)
        if not good:
            continue
        df = _read_parts(spark, good, None)
        if name not in tables:
            tables[name] = df
        elif sorted(tables[name].columns) == sorted(df.columns):
            tables[name] = tables[name].unionByName(df)
        else:
            raise ContractError(f"folders named {name} have different columns: "
                                f"{tables[name].columns} and, in {folder}, {df.columns}")
    return tables


FEATURE_SCHEMA = T.StructType(
    [
        T.StructField(c, T.IntegerType() if c in ("hour_of_day", "day_of_week") or c.startswith("day_")
                      and c[4:].isdigit() else
                      T.LongType() if c.endswith("_tx_count") else T.DoubleType())
        for c in FEATURE_COLUMNS
    ]
)


def scan_features(spark: SparkSession, path: str) -> DataFrame:
    """The feature CSV with its declared types (no inference)."""
    return load_part_csv(spark, path, FEATURE_SCHEMA)
