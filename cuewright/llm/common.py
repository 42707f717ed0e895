"""What the corpus operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
from collections.abc import Callable, Sequence

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: White space of the corpus contracts, as a regular expression class and its complement.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: Rows that a Python worker holds as objects at once.
ROWS = 256

#: Spark's setting by which an execution's shuffle files are removed when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_held: dict = {}


def held(key, make: Callable):
    """What a worker keeps from task to task, made once: a model, a vocabulary. Workers serve one operator after another, so
    there is one place, and what another operator has left there goes."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def tidy() -> None:
    """Give back what a task has freed; a worker lives on and would hold it beside the next operator's."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where it is unset and all is one machine."""
    context = spark.sparkContext
    at = context.getCheckpointDir()
    if at is None:
        own = context.getConf().get("spark.checkpoint.dir")
        if own is None and not (context.master or "").startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(own or tempfile.mkdtemp(prefix="shared-"))
        at = context.getCheckpointDir()
    return at


def drop(spark: SparkSession, path: str) -> None:
    """Remove a folder, where it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def tidy_driver(spark: SparkSession) -> None:
    """Collect the driver's garbage (finished plans and their metrics) and give back what its native heap has freed: over many steps the
    driver would hold both. A Java without that command keeps the latter."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    jvm.System.gc()
    name = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
    invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServerConnection").getMethods() if m.getName() == "invoke")
    args = gateway.new_array(jvm.Object, 4)  # the last two, of the command's own arguments, stay null
    args[0], args[1] = name, "systemTrimNativeHeap"
    with contextlib.suppress(Py4JJavaError):
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, so that lost executors cost no recomputation of what stands before.

    Nothing can read the shuffles of it once the checkpoint is written; they go at once, not when the driver next collects garbage.
    """
    spark = df.sparkSession
    shared_dir(spark)
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a plan of its own, made under the setting
    finally:
        tidy_driver(spark)
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def append_columns(
    df: DataFrame,
    inputs: Sequence[str],
    keep: Sequence[str],
    fields: Sequence[tuple[str, T.DataType]],
    make: Callable[[], Callable],
    rows: Callable[[Sequence], Sequence[bool]] | None = None,
) -> DataFrame:
    """Add columns computed in Arrow batches, without a shuffle.

    ``make()`` runs once a task and returns a function from the lists of the ``inputs`` columns to the lists of the new
    columns. A kept column whose name clashes with a new one gives way to it. ``rows`` may select rows by the new columns.
    """
    new = [n for n, _ in fields]
    held = [c for c in keep if c not in new]
    first = df.select(*dict.fromkeys([*held, *inputs]))
    schema = T.StructType([first.schema[c] for c in held] + [T.StructField(n, t) for n, t in fields])
    kinds = [to_arrow_type(t) for _, t in fields]

    def run(batches):
        work = make()
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, max(1, whole.num_rows), ROWS)):
            made = work(*(batch.column(c).to_pylist() for c in inputs))
            out = pa.RecordBatch.from_arrays(
                [batch.column(c) for c in held] + [pa.array(v, type=k) for v, k in zip(made, kinds, strict=True)],
                names=held + new,
            )
            yield out if rows is None else out.filter(pa.array(rows(made), type=pa.bool_()))
        tidy()

    return first.mapInArrow(run, schema)


def word_count(text: str | F.Column) -> F.Column:
    """Words of a text (0 for null): pieces between white space that aren't empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.size(F.array_remove(F.split(text, SPACE + "+"), "")), F.lit(0)).cast("long")


__all__ = ["SPACE", "WORD", "append_columns", "drop", "held", "read", "settle", "shared_dir", "tidy", "tidy_driver", "word_count"]
