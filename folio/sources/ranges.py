"""J1 for large files: a data source whose partitions are byte ranges within files of newline-ended records.

`files.decode` gives a file to one task.  Here a bundle of many records is cut
into ranges: a task decodes the records that begin in its range, so one file is
decoded by as many tasks as it has ranges, and small files share a task.  A
filter on the page number (B5) is pushed to the decoder, which need not decode other
pages.  A range with a record that fails gives one error row instead of its rows.

Files are listed and opened through pyarrow's file systems (local or mounted paths, ``s3://``, ``gs://``,
``hdfs://`` URIs).
"""

from __future__ import annotations

import io
import json
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import to_arrow_schema

SPLIT_BYTES = 32 << 20
MOST_TASKS = 1000  # where there are more, a task takes several, range after range
BUFFER_BYTES = 1 << 20
BATCH_ROWS = 1000
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"  # Spark pushes filters to Python sources only where the session sets this

Wanted = Callable[[int], bool]
Decoder = Callable[[bytes, Wanted], Iterable[dict]]

COMPARE = {
    EqualTo: lambda page, v: page == v,
    In: lambda page, v: page in v,
    GreaterThan: lambda page, v: page > v,
    GreaterThanOrEqual: lambda page, v: page >= v,
    LessThan: lambda page, v: page < v,
    LessThanOrEqual: lambda page, v: page <= v,
}


class Ranges(InputPartition):
    """The ranges of one task: (file, first byte, byte behind)."""

    def __init__(self, ranges: list[tuple[str, int, int]]):
        super().__init__(ranges)


def split(files: Iterable[tuple[str, int]], split_bytes: int) -> list[list[tuple[str, int, int]]]:
    """Ranges of at most ``split_bytes``, dealt to tasks of about as many; files (path, size) in order."""
    tasks: list[list[tuple[str, int, int]]] = []
    room = 0
    for path, size in sorted(files):
        for start in range(0, size, split_bytes):
            end = min(start + split_bytes, size)
            if end - start > room:
                tasks.append([])
                room = split_bytes
            tasks[-1].append((path, start, end))
            room -= end - start
    return tasks


def few(tasks: list, most: int) -> list:
    """The same ranges, in order, in at most ``most`` tasks of nearly as many lists each: starting a task takes longer than a
    small range."""
    n = min(len(tasks), most)
    return [[r for t in tasks[len(tasks) * i // n : len(tasks) * (i + 1) // n] for r in t] for i in range(n)]


def records(stream, start: int, end: int) -> Iterator[bytes]:
    """The newline-ended records that begin in [start, end), without their newlines."""
    at = max(start - 1, 0)
    stream.seek(at)
    if start:  # the record that holds the byte before belongs to the range where it begins
        at += len(stream.readline())
    while at < end and (line := stream.readline()):
        at += len(line)
        yield line.removesuffix(b"\n")


class RangeReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict, decoder: Decoder):
        self.schema, self.decoder, self.path = schema, decoder, options["path"]
        self.suffix, self.split_bytes = options.get("suffix", ""), int(options.get("split_bytes", SPLIT_BYTES))
        self.tests: list[tuple[str, object]] = [("In", tuple(json.loads(options["pages"])))] if "pages" in options else []

    def partitions(self) -> list[Ranges]:
        system, path = _system(self.path)
        found = [system.get_file_info(path)] if system.get_file_info(path).is_file else system.get_file_info(pafs.FileSelector(path, recursive=True))
        hidden = lambda f: f.base_name.startswith(("_", "."))
        ranges = split([(f.path, f.size) for f in found if f.is_file and f.path.endswith(self.suffix) and not hidden(f)], self.split_bytes)
        return [Ranges(r) for r in few(ranges, MOST_TASKS)]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        system, _ = _system(self.path)
        out = to_arrow_schema(self.schema)
        names = [f.name for f in self.schema.fields[3:]]
        compare = {k.__name__: fn for k, fn in COMPARE.items()}
        tests = [(compare[name], value) for name, value in self.tests]
        wanted = lambda page: all(test(page, value) for test, value in tests)
        for path, start, end in partition.value if partition is not None else []:  # none: no file
            try:
                with system.open_input_file(path) as raw:
                    rows = [
                        {"path": path, "range_start": start, "error": None, **{n: rec.get(n) for n in names}}
                        for line in records(io.BufferedReader(raw, BUFFER_BYTES), start, end)
                        for rec in self.decoder(line, wanted)
                        if "page" not in names or wanted(rec["page"])
                    ]
            except Exception as e:  # noqa: BLE001 - a bad range is data, not a job failure
                rows = [{"path": path, "range_start": start, "error": f"{type(e).__name__}: {e}"}]
            for at in range(0, len(rows), BATCH_ROWS):
                yield pa.RecordBatch.from_pylist(rows[at : at + BATCH_ROWS], schema=out)


class PushedReader(RangeReader):
    """A reader that takes filters on the page; Spark accepts one only where PUSHDOWN is set."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if type(f) in COMPARE and f.attribute == ("page",):
                self.tests.append((type(f).__name__, f.value))
            else:
                yield f  # left to Spark


def _system(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return pafs.LocalFileSystem(), path


def range_source(name: str, decoder: Decoder, schema: T.StructType, push: bool = False) -> type[DataSource]:
    """A data source ``name`` that decodes records with ``decoder(record, wanted)``; ``wanted(page)`` tells the pages that are
    asked for: by the option ``pages`` (a JSON list) and, with ``push``, by the query's filters."""
    reader_of = PushedReader if push else RangeReader
    fields = [T.StructField("path", T.StringType()), T.StructField("range_start", T.LongType()), T.StructField("error", T.StringType())]
    whole = T.StructType([*fields, *[T.StructField(f.name, f.dataType, True) for f in schema.fields]])

    class RangeSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> T.StructType:
            return whole

        def reader(self, schema: T.StructType) -> RangeReader:
            return reader_of(schema, dict(self.options), decoder)

    return RangeSource


def decode_ranges(
    spark: SparkSession, root: str, decoder: Decoder, schema: T.StructType, suffix: str = "", split_bytes: int = SPLIT_BYTES, pages: list[int] | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(rows, errors)`` of the files under ``root``: rows carry ``path``, ``range_start`` and the schema's fields; errors are
    ``(path, range_start, error)`` of ranges whose decoder raised, of which no row is kept.

    ``pages``: only these are asked of the decoder.  Filters on ``page`` reach it as well where the session has set
    ``PUSHDOWN`` (at this call, and still when the query runs); elsewhere Spark filters behind it."""
    push = spark.conf.get(PUSHDOWN, "false") == "true"
    name = f"folio_{getattr(decoder, '__name__', 'records')}{'_pushed' * push}"
    spark.dataSource.register(range_source(name, decoder, schema, push))
    options = {"path": root, "suffix": suffix, "split_bytes": split_bytes} | ({} if pages is None else {"pages": json.dumps(pages)})
    df = spark.read.format(name).options(**options).load()
    return df.where(F.col("error").isNull()).drop("error"), df.where(F.col("error").isNotNull()).select("path", "range_start", "error")


def bundled_pages(record: bytes, wanted: Wanted) -> Iterator[dict]:
    """Example decoder: one JSON object ``{"doc_id": ..., "pages": [...]}`` a record."""
    doc = json.loads(record)
    for i, t in enumerate(doc["pages"]):
        if wanted(i):
            yield {"doc_id": doc["doc_id"], "page": i, "page_text": t}
