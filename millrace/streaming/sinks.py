"""Output formats, result cursors, Arrow delivery and buffered inserts."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from millrace.errors import InvalidQuery, SchemaMismatch
from millrace.operators.dml import insert
from millrace.sources.tables import TableDef

#: Compression names of the client side, and those of Parquet.
COMPRESSION = {"none": "none", "lz4": "lz4", "lz4hc": "lz4", "zstd": "zstd"}


def write_format(df: DataFrame, name: str, path: str, compression: str = "none") -> None:
    """Writes files in a named format, in parallel: JSONEachRow, CSV, TabSeparated, Parquet, ORC, Native."""
    w = df.write
    if name == "JSONEachRow":
        w.json(path, compression=None if compression == "none" else compression, ignoreNullFields=False)
    elif name in ("CSV", "CSVWithNames"):
        w.csv(path, header=name == "CSVWithNames", compression=None if compression == "none" else compression)
    elif name in ("TabSeparated", "TabSeparatedWithNames"):
        w.csv(path, sep="\t", header=name.endswith("Names"), nullValue="\\N", compression=None if compression == "none" else compression)
    elif name in ("Native", "Parquet"):
        w.parquet(path, compression=COMPRESSION[compression.lower()])
    elif name == "ORC":
        w.orc(path)
    elif name == "Null":
        w.format("noop").mode("append").save()
    else:
        raise InvalidQuery(f"unknown format {name}")


def render(df: DataFrame, name: str, most: int = 1_000_000) -> str | bytes:
    """A result of ``most`` rows at most as one text: JSON, JSONEachRow, CSV, TabSeparated, or Arrow bytes for ArrowStream. Larger ones go to files."""
    if df.limit(most + 1).count() > most:
        raise InvalidQuery(f"more than {most} rows: write_format writes them in parallel")
    if name == "JSONEachRow":
        return "".join(f"{x[0]}\n" for x in df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).collect())
    if name == "JSON":
        data = [json.loads(x[0]) for x in df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).collect()]
        return json.dumps({"meta": [{"name": f.name, "type": f.dataType.simpleString()} for f in df.schema], "data": data, "rows": len(data)})
    if name in ("CSV", "TabSeparated"):
        options = {"nullValue": "\\N"} if name == "CSV" else {"sep": "\t", "nullValue": "\\N"}
        return "".join(f"{x[0]}\n" for x in df.select(F.to_csv(F.struct("*"), options)).collect())
    if name == "ArrowStream":
        import pyarrow as pa

        out = pa.BufferOutputStream()
        found = df.toArrow()
        with pa.ipc.new_stream(out, found.schema) as w:
            w.write_table(found)
        return out.getvalue().to_pybytes()
    raise InvalidQuery(f"unknown format {name}")


class RowStream:
    """A pull-based cursor over a result; it holds a partition at a time."""

    def __init__(self, df: DataFrame):
        self._rows: Iterator[Row] = df.toLocalIterator(prefetchPartitions=True)

    def __iter__(self) -> Iterator[Row]:
        return self._rows

    def next(self) -> Row | None:
        return next(self._rows, None)

    def collect(self) -> list[Row]:
        return list(self._rows)

    def for_each(self, f: Callable[[Row], None]) -> int:
        n = 0
        for row in self._rows:
            f(row)
            n += 1
        return n


def for_each(df: DataFrame, f: Callable[[Row], None]) -> None:
    """Runs a function on the executors for every row."""
    df.foreachPartition(lambda rows: [f(r) for r in rows] and None)


def arrow_batches(df: DataFrame, size: int = 10_000):
    """Arrow batches of a result, fetched a partition at a time."""
    import pyarrow as pa

    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                out = pa.BufferOutputStream()
                with pa.ipc.new_stream(out, batch.schema) as w:
                    w.write_batch(batch.slice(at, size))
                yield pa.RecordBatch.from_arrays([pa.array([out.getvalue().to_pybytes()], pa.binary())], names=["ipc"])

    for row in df.mapInArrow(pack, "ipc binary").toLocalIterator(prefetchPartitions=True):
        yield from pa.ipc.open_stream(row.ipc)


def arrow_callback(df: DataFrame, f: Callable) -> int:
    """Calls a function with every Arrow batch; gives the number of rows."""
    n = 0
    for batch in arrow_batches(df):
        f(batch)
        n += batch.num_rows
    return n


@dataclass
class View:
    """A row within an Arrow batch, read in place."""

    batch: object
    row: int

    def get(self, column: str, kind: type | None = None):
        """The value; of a type that is asked for, or SchemaMismatch."""
        value = self.batch.column(column)[self.row].as_py()
        if kind is not None and value is not None and not isinstance(value, kind):
            raise SchemaMismatch(f"{column} is no {kind.__name__}")
        return value

    def is_null(self, column: str) -> bool:
        return not self.batch.column(column)[self.row].is_valid


def zero_copy(df: DataFrame, f: Callable[[View], None]) -> int:
    """Calls a function with a view of every row; gives the number of rows."""
    return arrow_callback(df, lambda batch: [f(View(batch, i)) for i in range(batch.num_rows)])


@dataclass(frozen=True)
class InsertConfig:
    #: Whether a flush returns when its rows are written, or hands them to a thread.
    wait: bool = True
    #: Rows are written at the latest so long after the first of them came.
    busy_timeout_ms: int | None = None
    max_rows: int = 100_000
    max_bytes: int = 64 << 20
    dedup: bool = False

    @classmethod
    def fire_and_forget(cls) -> InsertConfig:
        return cls(wait=False, busy_timeout_ms=200)

    @classmethod
    def synchronous(cls) -> InsertConfig:
        return cls(wait=True, max_rows=1)


class AsyncInserter:
    """Collects rows and appends them in large batches, by number, size or age. A batch that can't be written stays in the buffer.

    Without ``wait`` one thread writes, and its error is raised by the next call.
    """

    def __init__(self, spark: SparkSession, table: TableDef, config: InsertConfig = InsertConfig()):
        self.spark, self.table, self.config = spark, table, config
        self._rows: list = []
        self._bytes = self.sent_count = 0
        self._lock, self._writing = threading.RLock(), threading.Lock()
        self._timer: threading.Timer | None = None
        self._pool = None if config.wait else ThreadPoolExecutor(1)
        self._jobs: list[Future] = []
        self._error: BaseException | None = None

    def __enter__(self) -> AsyncInserter:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            self.close()

    @property
    def buffered_count(self) -> int:
        return len(self._rows)

    def write(self, row) -> None:
        self.write_many([row])

    def write_many(self, rows) -> None:
        self._raise()
        with self._lock:
            for row in rows:
                self._rows.append(row)
                self._bytes += sum(len(v) if isinstance(v, str | bytes) else 8 for v in (row.values() if isinstance(row, dict) else row))
            full = len(self._rows) >= self.config.max_rows or self._bytes >= self.config.max_bytes
            if self._rows and not full and self._timer is None and self.config.busy_timeout_ms is not None:
                self._timer = threading.Timer(self.config.busy_timeout_ms / 1000, self._late)
                self._timer.daemon = True
                self._timer.start()
        if full:
            self.flush()

    def _late(self) -> None:
        try:
            self.flush()
        except BaseException as e:  # noqa: BLE001  the next call raises it
            self._error = e

    def _raise(self) -> None:
        with self._lock:
            for job in [j for j in self._jobs if j.done()]:
                self._jobs.remove(job)
                self._error = self._error or job.exception()
            error, self._error = self._error, None
        if error is not None:
            raise error

    def _take(self) -> list:
        with self._lock:
            if self._timer is not None:
                self._timer.cancel()
                self._timer = None
            rows, self._rows, self._bytes = self._rows, [], 0
        return rows

    def _send(self, rows: list) -> int:
        if not rows:
            return 0
        some = list({json.dumps(r, default=str, sort_keys=True): r for r in rows}.values()) if self.config.dedup else rows
        try:
            with self._writing:
                n = insert(self.spark, self.table, some)
        except BaseException:
            with self._lock:
                self._rows = rows + self._rows
            raise
        with self._lock:
            self.sent_count += n
        return n

    def flush(self) -> int:
        """Writes what is buffered; gives the number of rows, or 0 where a thread writes them."""
        rows = self._take()
        if self._pool is None:
            return self._send(rows)
        with self._lock:
            self._jobs.append(self._pool.submit(self._send, rows))
        return 0

    def flush_all(self) -> int:
        """Writes what is buffered and waits for all that is being written."""
        n = self.flush()
        with self._lock:
            jobs = list(self._jobs)
        wait(jobs)
        self._raise()
        return n

    flush_server = flush_all

    def close(self) -> None:
        self.flush_all()
        if self._pool is not None:
            self._pool.shutdown()
