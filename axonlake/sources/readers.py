"""Readers: Parquet and CSV by Spark, Arrow files and log tails by Python data sources, small configuration on the driver."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from ..functions.scalars import encode_point
from pyspark.sql import functions as F


class ArrowFiles(DataSource):
    """Format arrowfile: Arrow IPC (Feather v2) files, a partition for each record batch. Unsigned 64-bit columns are
    read as longs. Options: path, a file or a folder of files, local or of a store that pyarrow.fs opens (file, s3, gs,
    hdfs); columns, a comma-joined list of those to read, as only their buffers are then fetched.

    Comparisons of integer columns and equality of texts are pushed down where the session allows it (arrow() sees to
    that). Where a file has a .stats.json beside it, as sinks.arrow() writes, batches that can't hold a row are no
    partitions; the others are filtered as they are read.
    """

    @classmethod
    def name(cls) -> str:
        return "arrowfile"

    def schema(self):
        import pyarrow as pa
        from pyspark.sql.pandas.types import from_arrow_schema

        fs, files = files_of(self.options["path"], (".arrow", ".feather"))
        with fs.open_input_file(files[0]) as f:
            return from_arrow_schema(_chosen(_signed(pa.ipc.open_file(f).schema), self._columns()))

    def _columns(self) -> list[str] | None:
        return [c.strip() for c in self.options["columns"].split(",")] if self.options.get("columns") else None

    def reader(self, schema):
        return _ArrowReader(self.options["path"], self._columns())


def files_of(path: str, endings: tuple[str, ...] = ("",)):
    """(file system, paths): a file, or the files of a folder that end so, in order of names."""
    from pyarrow import fs as pafs

    fs, inner = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
    info = fs.get_file_info(inner)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == pafs.FileType.File:
        return fs, [inner]
    return fs, sorted(f.path for f in fs.get_file_info(pafs.FileSelector(inner)) if f.type == pafs.FileType.File and f.base_name.endswith(endings) and not f.base_name.startswith(("_", ".")))


def _signed(schema):
    import pyarrow as pa

    kind = lambda t: pa.int64() if pa.types.is_unsigned_integer(t) else t.value_type if pa.types.is_dictionary(t) else t
    return pa.schema([pa.field(f.name, kind(f.type)) for f in schema])


def _chosen(schema, columns: list[str] | None):
    import pyarrow as pa

    return schema if columns is None else pa.schema([schema.field(c) for c in columns])


class _ArrowReader(DataSourceReader):
    def __init__(self, path: str, columns: list[str] | None = None):
        self.path, self.columns, self.tests = path, columns, []

    def pushFilters(self, filters):
        """Takes over comparisons of a column with an integer, and equality with a text."""
        for f in filters:
            op, column = _OPERATORS.get(type(f)), getattr(f, "attribute", ())
            values = list(f.value) if op == "in" else [getattr(f, "value", None)]
            whole = all(isinstance(v, int) and not isinstance(v, bool) for v in values)
            text = op in ("eq", "in") and all(isinstance(v, str) for v in values)
            if op and len(column) == 1 and values and (whole or text):
                self.tests.append((column[0], op, values))
            else:
                yield f

    def partitions(self):
        import pyarrow as pa

        fs, files = files_of(self.path, (".arrow", ".feather"))
        out = []
        for file in files:
            with fs.open_input_file(file) as f:
                n = pa.ipc.open_file(f).num_record_batches
            stats = _stats(fs, file, n)
            out += [InputPartition((file, k)) for k in range(n) if all(_may_hold(stats[k].get(c), op, v) for c, op, v in self.tests)]
        return out or [InputPartition(None)]

    def read(self, partition):
        import pyarrow as pa
        import pyarrow.compute as pc

        if partition.value is None:  # nothing is left to read
            return
        file, k = partition.value
        fs, _ = files_of(self.path, (".arrow", ".feather"))
        with fs.open_input_file(file) as f:
            schema = pa.ipc.open_file(f).schema
        wanted = [schema.get_field_index(c) for c in dict.fromkeys([*(self.columns or schema.names), *(t[0] for t in self.tests)])]
        with fs.open_input_file(file) as f:
            r = pa.ipc.open_file(f, options=pa.ipc.IpcReadOptions(included_fields=sorted(wanted)))
            t = pa.Table.from_batches([r.get_batch(k)])
        t = t.cast(_signed(t.schema))
        for c, op, values in self.tests:
            t = t.filter(pc.is_in(t.column(c), pa.array(values, t.schema.field(c).type)) if op == "in" else _COMPARED[op](t.column(c), values[0]))
        yield from t.select(self.columns or _signed(schema).names).to_batches()


_OPERATORS = {EqualTo: "eq", GreaterThan: "gt", GreaterThanOrEqual: "ge", LessThan: "lt", LessThanOrEqual: "le", In: "in"}
_COMPARED = {
    "eq": lambda a, b: _compute("equal", a, b), "gt": lambda a, b: _compute("greater", a, b), "ge": lambda a, b: _compute("greater_equal", a, b),
    "lt": lambda a, b: _compute("less", a, b), "le": lambda a, b: _compute("less_equal", a, b),
}


def _compute(name: str, a, b):
    import pyarrow.compute as pc

    return getattr(pc, name)(a, b)


def _stats(fs, file: str, n: int) -> list[dict]:
    """For each batch the least and greatest value of columns, as far as they were noted beside the file."""
    from pyarrow import fs as pafs

    beside = file.rsplit(".", 1)[0] + ".stats.json"
    if fs.get_file_info(beside).type != pafs.FileType.File:
        return [{}] * n
    with fs.open_input_stream(beside) as f:
        found = json.loads(f.readall())
    return found if len(found) == n else [{}] * n


def _may_hold(bounds: list | None, op: str, values: list) -> bool:
    """Whether a column within bounds can pass; a column of nulls only, whose bounds are null, can't."""
    if bounds is None or not isinstance(values[0], int):
        return True
    least, most = bounds
    if least is None:
        return False
    v = values[0]
    return {"eq": least <= v <= most, "gt": most > v, "ge": most >= v, "lt": least < v, "le": least <= v, "in": any(least <= x <= most for x in values)}[op]


def arrow(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Arrow files, of which only the given columns are read, and only batches that can pass the filters on them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ArrowFiles)
    r = spark.read.format("arrowfile").option("path", path)
    return (r.option("columns", ",".join(columns)) if columns else r).load()


class LogTail(DataSource):
    """Format logtail: (value) messages of a request log, of its last bytes only. A line that starts with {" begins a
    message. Options: path (as for arrowfile), bytes (0: all), rangebytes, how many of them a partition takes.

    A message belongs to the range that its first byte lies in and is read to its end, wherever that is, so ranges give
    each message once; what lies before the first line that begins a message is left out, as it is a message's end.
    """

    @classmethod
    def name(cls) -> str:
        return "logtail"

    def schema(self):
        return "value string"

    def reader(self, schema):
        o = self.options
        return _TailReader(o["path"], int(o.get("bytes", 10_000_000)), int(o.get("rangebytes", 16 << 20)))


#: What a message's first line begins with, and how many bytes are fetched at a time.
OPENS, CHUNK = b'\n{"', 1 << 20


class _TailReader(DataSourceReader):
    def __init__(self, path: str, tail: int, step: int):
        self.path, self.tail, self.step = path, tail, step

    def partitions(self):
        fs, files = files_of(self.path)
        out = []
        for file in files:
            size = fs.get_file_info(file).size
            start = max(0, size - self.tail) if self.tail else 0
            out += [InputPartition((file, a, min(a + self.step, size))) for a in range(start, size, self.step)]
        return out or [InputPartition(None)]

    def read(self, partition):
        import pyarrow as pa

        if partition.value is None:
            return
        file, first, end = partition.value
        fs, _ = files_of(self.path)
        schema = pa.schema([pa.field("value", pa.string())])
        with fs.open_input_file(file) as f:
            texts, size = [], 0
            for m in _messages(f, first, end):
                texts.append(m.decode("utf-8", "replace"))
                size += len(m)
                if size > CHUNK:
                    yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], schema=schema)
                    texts, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], schema=schema)


def _messages(f, first: int, end: int):
    """Messages whose first byte is in [first, end), without the line end after them."""
    at = max(0, first - 1)  # the line end before a message that begins at first
    f.seek(at)
    held = b"" if first else b"\n"  # the file's first line begins after nothing
    at -= len(held)
    open_at = None  # where the message in held begins, counted in the file
    while True:
        more = f.read(CHUNK)
        held += more
        while (k := held.find(OPENS, 0 if open_at is None else 1)) >= 0:
            if open_at is not None:
                yield held[1:k]
            held, at = held[k:], at + k
            open_at = at + 1
            if open_at >= end:
                return
        if not more:
            break
        if open_at is None and len(held) > 2:  # a message's end: only what may begin the next line is kept
            held, at = held[-2:], at + len(held) - 2
            if at + 1 >= end:
                return
    if open_at is not None:
        yield held[1:].removesuffix(b"\n")


def log_tail(spark: SparkSession, path: str, tail_bytes: int = 10_000_000, range_bytes: int = 16 << 20) -> DataFrame:
    """(value) messages of the last bytes of a log, for logs.parsed(); 0 bytes for all of it."""
    spark.dataSource.register(LogTail)
    return spark.read.format("logtail").option("path", path).option("bytes", str(tail_bytes)).option("rangebytes", str(range_bytes)).load()


def parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)


def json_file(path: str):
    """What a small JSON file of settings holds."""
    with open(path) as f:
        return json.load(f)


def region_ids(path: str) -> dict[str, int]:
    """A small JSON map of region names to labels."""
    with open(path) as f:
        return {str(k): int(v) for k, v in json.load(f).items()}


def with_point_ids(df: DataFrame) -> DataFrame:
    """df with point_id from z, y, x if it has none."""
    return df if "point_id" in df.columns else df.withColumn("point_id", encode_point(F.col("z"), F.col("y"), F.col("x")))


def required(df: DataFrame, *columns: str) -> DataFrame:
    """df, if it has the columns."""
    if missing := set(columns) - set(df.columns):
        raise ValueError(f"missing columns: {sorted(missing)}")
    return df
