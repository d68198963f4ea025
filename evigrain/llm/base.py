"""Shared plumbing: intermediate tables on shared storage, Arrow batch size, connected components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import time
import uuid
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of one Arrow batch handed to a Python worker; bounds the worker's memory.
ARROW_ROWS, ARROW_BYTES = "1024", "16m"


def tune(spark: SparkSession) -> None:
    """Keep Arrow batches small, so that batches of very long texts fit a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir; one of our own where it is unset and everything runs on this machine."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return top or "/tmp/checkpoints/evigrain"


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


_swept = [0.0]


def sweep(spark: SparkSession, every: float = 0.7) -> None:
    """Let the driver collect plans that are done, so that their shuffle files go before more are written; not again within `every` seconds."""
    if time.monotonic() - _swept[0] < every:
        return
    _swept[0] = time.monotonic()
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has it, give freed memory back
        ctypes.CDLL(None).malloc_trim(0)


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the time of a block, then what it was."""
    was = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, was)


def stored(df: DataFrame, name: str, by: str | None = None) -> tuple[DataFrame, str]:
    """Write df as Parquet in the shared folder, in a folder for each value of `by`, and read it again: lineage is cut, and lost executors lose nothing."""
    spark = df.sparkSession
    path = new_path(spark, name)
    if by:
        with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "8"):  # rows need no sort by `by` first
            df.write.partitionBy(by).parquet(path)
    else:
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def _round(edges: DataFrame) -> tuple[DataFrame, str, tuple]:
    """edges stored, their path, and a digest of them."""
    seen = Observation()
    out, path = stored(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")), "edges")
    return out, path, (seen.get["n"], seen.get["x"])


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components by alternating large-star and small-star rounds.

    edges: (a long, b long), any direction, repeats and loops allowed, nulls ignored.
    Returns (node, component) for every node that has an edge to another node; component is
    the smallest node reachable. Each round is two aggregations and two joins on node keys, so
    a hub's edges are summed before they move and its join partition can be split; nothing is
    gathered in one task. Rounds grow with the logarithm of the longest path.
    """
    spark = edges.sparkSession
    cur = (
        edges.where("a <> b")
        .select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b"))
        .distinct()
    )
    cur, path, sign = _round(cur)
    for _ in range(max_rounds):
        if not sign[0]:
            break
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = (
            both.where("b > a").join(low, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        )
        # small-star over edges that already point from the larger to the smaller end
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        small = (
            large.join(least, F.col("a") == F.col("u"))
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        nxt, npath, nsign = _round(small)
        drop_path(spark, path)
        cur, path = nxt, npath
        if nsign == sign:
            break
        sign = nsign
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = cur.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def pick(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Only the named columns, in that order: extra columns, whatever they are called, go no further."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def beside(df: DataFrame, inputs: list[str], measure: Callable, fields: str) -> DataFrame:
    """df with the columns `fields` that measure makes, batch by batch, of the Arrow arrays of `inputs`; nothing is shuffled.

    Columns of df may have any names, those of `fields` too; then the later ones are meant by position.
    """
    at = [df.columns.index(c) for c in inputs]
    plain = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    added = [x.split()[0] for x in re.split(r", (?=\w+ )", fields)]

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, *measure(*(b.column(i) for i in at))], names=[*b.schema.names, *added])

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema), fields])
    return plain.mapInArrow(run, schema).toDF(*df.columns, *added)
