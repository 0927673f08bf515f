"""A large stored result read in pages, in parallel, through a Python data source.

``paged_parquet`` cuts every file below a path into byte ranges.  A task reads the
row groups that start inside its range and hands them on in Arrow batches of at
most ``page_rows`` rows, so a page and not a response is what memory holds.  Only
the columns of the given schema are read.  Comparisons of integers, texts, flags,
dates and zoneless times with constants are pushed to the reader: row groups whose statistics rule them out are not read at all, and
the rows of others are filtered before they leave the task.

Planning lists files and sizes only; footers are read by the tasks.  Paths are
those that Arrow's file systems open (local, ``file:``, ``s3:``, ``gs:``, ``hdfs:``).
Defined cases: an empty folder or file gives no rows; hidden files (``_``, ``.``)
are left out; a column missing from a file is null in its rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

PAGE_BYTES = 128 << 20
PAGE_ROWS = 10_000
COMPARISONS = {EqualTo: "==", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


@dataclass
class Page(InputPartition):
    """The row groups of ``path`` that start in [start, end)."""

    path: str
    start: int
    end: int


def _condition(filters):
    """The conjunction of (column, comparison, constant) as an Arrow expression, or None."""
    import operator

    import pyarrow.compute as pc

    apply = {"==": operator.eq, ">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le}
    out = None
    for column, how, value in filters:
        one = apply[how](pc.field(column), value)
        out = one if out is None else out & one
    return out


class PagedReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options):
        self.schema = schema
        self.path = options["path"]
        self.page_bytes = int(options.get("page_bytes", PAGE_BYTES))
        self.page_rows = int(options.get("page_rows", PAGE_ROWS))
        self.filters: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        kinds = (T.IntegralType, T.StringType, T.BooleanType, T.DateType, T.TimestampNTZType)
        atomic = {f.name for f in self.schema if isinstance(f.dataType, kinds)}
        for f in filters:  # others stay with Spark: NaN, for one, compares in another way there
            if type(f) in COMPARISONS and len(f.attribute) == 1 and f.attribute[0] in atomic and f.value is not None:
                self.filters.append((f.attribute[0], COMPARISONS[type(f)], f.value))
            else:
                yield f

    def partitions(self):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (
            fs.LocalFileSystem(), self.path)
        info = store.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        files = [info] if info.is_file else [
            f for f in store.get_file_info(fs.FileSelector(root, recursive=True))
            if f.is_file and not any(p[:1] in "_." for p in f.path[len(root):].strip("/").split("/"))]
        return [Page(f.path, at, min(at + self.page_bytes, f.size))
                for f in sorted(files, key=lambda f: f.path) for at in range(0, f.size, self.page_bytes)] or [Page("", 0, 0)]

    def read(self, page: Page) -> Iterator:
        import pyarrow as pa
        import pyarrow.dataset as ds
        from pyarrow import fs
        from pyspark.sql.pandas.types import to_arrow_schema

        if not page.path:
            return
        store = fs.FileSystem.from_uri(self.path)[0] if "://" in self.path or self.path.startswith("file:") else fs.LocalFileSystem()
        wanted = to_arrow_schema(self.schema)
        whole = ds.ParquetFileFormat().make_fragment(page.path, store)
        whole.ensure_complete_metadata()
        meta = whole.metadata
        groups = []
        for i in range(meta.num_row_groups):
            first = meta.row_group(i).column(0)
            start = first.dictionary_page_offset or first.data_page_offset
            if page.start <= start < page.end:
                groups.append(i)
        if not groups:
            return
        condition = _condition(self.filters)
        fragment = whole.subset(row_group_ids=groups)
        for batch in fragment.to_batches(schema=wanted, filter=condition, batch_size=self.page_rows, batch_readahead=1, use_threads=False):
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, wanted)], schema=wanted)


class PagedParquet(DataSource):
    @classmethod
    def name(cls):
        return "paged_parquet"

    def schema(self):
        raise ValueError("paged_parquet needs the schema of the wanted columns")

    def reader(self, schema: T.StructType) -> PagedReader:
        return PagedReader(schema, self.options)


def read_pages(spark: SparkSession, path: str, schema, page_bytes: int = PAGE_BYTES, page_rows: int = PAGE_ROWS) -> DataFrame:
    """The columns of ``schema`` of the Parquet files at ``path``, one task per page of ``page_bytes``."""
    spark.dataSource.register(PagedParquet)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("paged_parquet").schema(schema).options(
        path=path, page_bytes=page_bytes, page_rows=page_rows).load()
