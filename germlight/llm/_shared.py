"""What the training-data operators have in common: table access, the shared folder, checkpoints, let-bindings."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space, words and the 4-fold split of the query contracts.
BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
HELD_OUT_MOD = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only where all is one machine may that be unset, for a temporary folder."""
    context, root = spark.sparkContext, _configured(spark)
    if root is None:
        if context.master.partition("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="germlight-")
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(root)
    path, store = _hadoop(spark, root)
    return store.makeQualified(path).toString()  # a path without a scheme is one of the default file system


def _configured(spark: SparkSession) -> str | None:
    checkpoint = spark.sparkContext._jsc.sc().getCheckpointDir()
    set_ = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return set_ or (checkpoint.get() if checkpoint.isDefined() else None)


def _hadoop(spark: SparkSession, uri: str):
    """(path, file system) as Spark's own readers and writers see them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new folder in the shared one, deleted with all that is in it when the application ends."""
    uri = f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    path, store = _hadoop(spark, uri)
    store.mkdirs(path)
    store.deleteOnExit(path)
    return uri


@contextlib.contextmanager
def shuffles_forgotten(spark: SparkSession) -> Iterator[None]:
    """Queries that are made and run inside leave no shuffle files behind: their results are files in the shared folder by then."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


class Scratch:
    """Intermediate tables of one run, as Parquet in a folder of their own, so that lineage ends there and lost executors cost no recomputation."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.folder, self.tables = spark, fresh_dir(spark, label), {}

    def keep(self, df: DataFrame) -> DataFrame:
        """df, computed once and written."""
        uri = f"{self.folder}/{uuid.uuid4().hex}"
        with shuffles_forgotten(self.spark):
            df.select("*").write.parquet(uri)
        out = self.spark.read.schema(df.schema).parquet(uri)
        self.tables[id(out)] = (out, uri)
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that nothing reads any more; others than its own are left alone."""
        for table_ in tables:
            if found := self.tables.pop(id(table_), None):
                path, store = _hadoop(self.spark, found[1])
                store.delete(path, True)


def filesystem(uri: str):
    """(file system, path) of a folder on any store that pyarrow reaches; made if it is missing."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)
    store.create_dir(path, recursive=True)
    return store, path


def checkpointed(df: DataFrame) -> DataFrame:
    """Cuts the lineage with files in the shared folder, so that a lost executor costs no recomputation."""
    shared_root(df.sparkSession)
    with shuffles_forgotten(df.sparkSession):
        return df.select("*").checkpoint()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once a row even where body uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only. Pure ASCII takes the fast path; lower() would change other alphabets too."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, upper, lower))


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 5; 0 is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_MOD


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


class Generations(dict):
    """A bounded memo: compute(key) fills what is missing. Two generations of size / 2 entries, so that frequent keys outlive a change of generation."""

    def __init__(self, compute: Callable, size: int):
        self.compute, self.size, self.old = compute, size, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.compute(key)
        if len(self) >= self.size // 2:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


def release_memory() -> None:
    """Gives what a worker has freed back to the system: Arrow's pool and the C library would keep it for later, beside the memory of an idle worker's neighbours."""
    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only some C libraries can
        ctypes.CDLL(None).malloc_trim(0)


#: Most bytes, as JSON, of what is broadcast.
BROADCAST_BYTES = 64 << 20


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """A broadcast hint for at most max_rows rows of BROADCAST_BYTES, counted first; beyond that the planner shuffles."""
    sizes = df.select(F.octet_length(F.to_json(F.struct("*"))).alias("n")).limit(max_rows + 1)
    rows, size = sizes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    return F.broadcast(df) if rows <= max_rows and size <= BROADCAST_BYTES else df
