"""What the operators share: tables, the shared work folder and files that executors write there."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words, as a Java regular expression.
SPACE = "[\\x20\\x09-\\x0D]+"

#: Bytes of an Arrow batch at most, but for single rows of more.
BATCH = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Only where that is unset (a local session, as in tests) is a temporary folder made and set.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    if jvm is None:
        return
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextlib.contextmanager
def small_batches(spark: SparkSession):
    """Arrow batches of ``BATCH`` bytes at most in what runs meanwhile, as each is held by the JVM and by a Python worker."""
    before = spark.conf.get(BATCH_SETTING, None)
    spark.conf.set(BATCH_SETTING, str(BATCH))
    try:
        yield
    finally:
        spark.conf.unset(BATCH_SETTING) if before is None else spark.conf.set(BATCH_SETTING, before)


def give_back() -> None:
    """Gives a worker's free memory back to the system."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other systems have other ways
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def lean(f):
    """A function of Arrow batches whose worker gives free memory back to the system at its end."""

    def run(batches):
        try:
            yield from f(batches)
        finally:
            give_back()

    return run


class Work:
    """A folder of one run of an operator under the shared folder.

    Tables written here survive lost executors, and cut the lineage. They stay until the session
    ends, as results are read lazily, unless ``drop`` removes them before.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0
        atexit.register(self._end)

    def _end(self) -> None:
        try:
            if self.spark.sparkContext._jsc is not None:
                _delete(self.spark, self.path)
        except Exception:  # noqa: BLE001  the JVM may be gone when Python ends
            pass

    def folder(self, name: str) -> str:
        self._n += 1
        return f"{self.path}/{name}-{self._n}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Writes a table and gives it back, read from there."""
        path = self.folder(name)
        with small_batches(self.spark):
            df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._millrace_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            if path := getattr(df, "_millrace_path", None):
                _delete(self.spark, path)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, even where lambdas in it refer to it often."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text, an empty array for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


#: The Arrow and SQL types of a row key.
KEY = "struct<a:bigint,b:bigint>"


def row_key(df: DataFrame, text: str = "text") -> Column:
    """Tells rows apart that have one doc_id and different texts, by 128 bits; equal rows count as one."""
    first = F.xxhash64(F.col("doc_id"), F.col(text))
    # chained the other way and from another start, so that texts that collide in one half do not in the other
    return F.struct(first.alias("a"), F.xxhash64(F.lit("row"), F.col(text), F.col("doc_id")).alias("b"))


def held(key: str, most: int) -> Column:
    """A remainder of a row key, for sets of bounded size."""
    return F.pmod(F.col(f"{key}.a"), F.lit(most))


def boxed(docs: DataFrame, *needed: str) -> DataFrame:
    """The columns that an operator needs, and all columns in one struct ``_d``, so that extra names can't clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_d"), *needed)


def unboxed(rows: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The columns that were boxed, some of them replaced."""
    return rows.select(*[(new[c] if c in new else F.col("_d").getField(c)).alias(c) for c in columns])


def by_size(batches, column: int, most: int = 1 << 21):
    """Arrow batches in slices with so many bytes of a text column at most, but for rows that have more alone."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
            yield batch.slice(at, to - at)
            at = to


# --- files that tasks write and read themselves -------------------------------------------------


def file_system(path: str):
    """pyarrow's file system for a URI or an absolute path, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write_bytes(path: str, chunks) -> int:
    """Writes a new file under a name of its own attempt; returns its size."""
    system, at = file_system(path)
    system.create_dir(at.rsplit("/", 1)[0], recursive=True)
    n = 0
    with system.open_output_stream(at) as out:
        for chunk in chunks:
            out.write(chunk)
            n += len(chunk)
    return n
