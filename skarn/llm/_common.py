"""Session helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])


def ship(spark: SparkSession) -> None:
    """Let Python workers that share this machine's files import the package."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *paths])


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors see: spark.checkpoint.dir; in local mode, where unset, a temporary one."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if conf:
        return conf
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    made = spark.sparkContext._jsc.sc().getCheckpointDir()
    if made.isEmpty():
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="skarn-"))
        made = spark.sparkContext._jsc.sc().getCheckpointDir()
    return made.get()


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; it goes when the session's JVM ends."""
    path = f"{shared_dir(spark).rstrip('/')}/skarn-{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as a URI of the file system that Spark takes it for: without a scheme, the cluster's default one."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    full = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()
    return "file://" + full.removeprefix("file:") if full.startswith("file:/") and not full.startswith("file://") else full


def drop_path(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there and lost executors cost nothing."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def drop_stored(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing reads any more."""
    for df in tables:
        drop_path(df.sparkSession, df._stored_at)


def free_shuffles(spark: SparkSession) -> None:
    """Let the driver's collector find the shuffles that no plan uses any more, so that Spark deletes their files now.

    Spark deletes them when the plan is collected, which a driver with much free memory may not do for long."""
    spark.sparkContext._jvm.System.gc()


def give_back_memory() -> None:
    """Return what a bounded computation has freed to the system; where the allocator can't, nothing happens."""
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def broadcast_if_small(df: DataFrame, row_bytes: int, most_bytes: int = 64 << 20) -> DataFrame:
    """Broadcast hint only where a count proves the side small; beyond that the planner joins by shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= most_bytes else df


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def bound(value: Column, then) -> Column:
    """``then(value)``, with the value worked out once for a row, however often lambdas in it use it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def running(values: Column, neutral: Column, both) -> Column:
    """For each element of an array the combination of all before it, ``neutral`` for the first.

    Blocks of about the root of the length are gone through one by one, then their totals: a fold over all would move its
    whole result at each step."""

    def scan(own: Column) -> Column:
        start = F.struct(neutral.alias("all"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(own, start, lambda a, x: F.struct(both(a["all"], x).alias("all"), F.concat(a["out"], F.array(a["all"])).alias("out")), lambda a: a["out"])

    def cut(all_: Column) -> Column:
        size = F.greatest(F.ceil(F.sqrt(F.size(all_).cast("double"))), F.lit(1)).cast("int")
        last = F.floor((F.greatest(F.size(all_), F.lit(1)) - 1) / size).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(all_, k * size + 1, size))

    def joined(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda own: F.aggregate(own, neutral, both))
        return F.flatten(F.zip_with(F.transform(blocks, scan), scan(totals), lambda own, before: F.transform(own, lambda x: both(before, x))))

    return bound(values, lambda v: bound(cut(v), joined))


def map_text(docs: DataFrame, text: str, carry: list[str], fields: str, start, step_bytes: int | None = None) -> DataFrame:
    """``carry`` columns of ``docs`` and the columns of the DDL ``fields``, computed from the text by Arrow batches.

    ``start()`` runs once in each task and returns ``work(flat, offsets, part) -> list of arrays``, one array per field
    with a value for each document of the step. The plan is narrow: no shuffle, memory of one step at a time. A text that is
    carried is sent once.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    from . import _text

    ship(docs.sparkSession)
    sent = text if text in carry else "__text"
    picked = docs.select(*carry, *([] if text in carry else [F.col(text).alias(sent)]))
    added = StructType.fromDDL(fields)
    schema = StructType([*picked.schema.fields[: len(carry)], *added.fields])
    arrow = to_arrow_schema(schema)
    most = step_bytes or _text.STEP_BYTES

    def run(batches):
        work = start()
        for batch in batches:
            for part, flat, offsets in _text.steps(batch, sent, most):
                columns = [part.column(i).cast(arrow.field(i).type) for i in range(len(carry))]
                made = work(flat, offsets, part)
                columns += [x if isinstance(x, pa.Array) and x.type == arrow.field(len(carry) + i).type else pa.array(x, type=arrow.field(len(carry) + i).type) for i, x in enumerate(made)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
            batch = part = flat = offsets = columns = made = None
        work = None
        give_back_memory()  # the worker waits for other tasks

    return picked.mapInArrow(run, schema)
