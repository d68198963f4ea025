"""Joins and choices that fail the job rather than lose rows, and limits on an explicit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evigrain.functions import ids


def asserted_join(left: DataFrame, right: DataFrame, key: str, what: str) -> DataFrame:
    """left with the columns of right of the same key; a row of left that right lacks fails the job.

    The key is worked out again from the joined side, so the check cannot be pruned away.
    """
    mate = right.withColumnRenamed(key, "_mate")
    gone = F.raise_error(F.concat(F.lit(f"missing {what}: "), F.col(key).cast("string")))
    kind = left.schema[key].dataType
    return left.join(mate, F.col(key) == F.col("_mate"), "left").withColumn(key, F.when(F.col("_mate").isNull(), gone.cast(kind)).otherwise(F.col("_mate"))).drop("_mate")


def selected(documents: DataFrame, wanted: list[str] | None, key: str = "document_id") -> DataFrame:
    """Documents whose id, in full or after its first colon, is wanted; all if nothing is. No match at all is an error."""
    if not wanted:
        return documents
    out = documents.where(F.col(key).isin(wanted) | ids.document_key(F.col(key)).isin(wanted))
    if out.isEmpty():
        raise ValueError(f"no document matches {sorted(wanted)}")
    return out


def pending(rows: DataFrame, done: DataFrame, key: str, limit: int | None = None, order: list[str] | None = None) -> DataFrame:
    """Rows that done lacks; with a limit the first so many of these in order, what is done does not count."""
    out = rows.join(done.select(key).distinct(), key, "left_anti")
    return out if limit is None else out.orderBy(*(order or [key])).limit(limit)


def first_with_rows(*tables: DataFrame) -> DataFrame:
    """The first table that has rows, the last one if none has."""
    for t in tables[:-1]:
        if not t.isEmpty():
            return t
    return tables[-1]


def numbered(rows: DataFrame, within: str, order: list[str | Column], name: str, first: int = 1) -> DataFrame:
    """rows with a running number within a group."""
    return rows.withColumn(name, (F.row_number().over(Window.partitionBy(within).orderBy(*order)) + (first - 1)).cast("int"))


def zipped(left: Column, right: Column, names: tuple[str, str], what: str) -> Column:
    """Two arrays side by side; arrays of different lengths fail the job."""
    pair = F.transform(left, lambda x, i: F.struct(x.alias(names[0]), F.get(right, i).alias(names[1])))
    return F.when(F.size(left) != F.size(right), F.raise_error(F.concat(F.lit(f"{what}: "), F.size(left).cast("string"), F.lit(" and "), F.size(right).cast("string"))).cast("void")).otherwise(pair)
