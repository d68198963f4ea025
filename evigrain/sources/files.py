"""JSON-lines and JSON-folder tables with explicit schemas; writers that publish whole folders or single files."""

from __future__ import annotations

import json
import os
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One record a line; blank lines are skipped, a bad line fails the job, a missing path is an empty table."""
    empty = spark.createDataFrame([], schema)
    try:
        return spark.read.schema(empty.schema).option("mode", "FAILFAST").json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return empty
        raise


def read_json_folder(spark: SparkSession, pattern: str, schema: StructType | str, key: str | None = None) -> DataFrame:
    """One record a file; of several with the same key the last file by name stays."""
    out = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(pattern)
    if key is None:
        return out
    names = out.columns
    last = out.withColumn("_file", F.col("_metadata.file_path")).groupBy(F.col(key).alias("_key")).agg(F.max_by(F.struct(*names), "_file").alias("_row"))
    return last.select("_row.*")


def unknown_keys(lines: Column, schema: StructType) -> Column:
    """Top-level keys of a JSON text that the schema does not have."""
    return F.array_except(F.json_object_keys(lines), F.array(*[F.lit(n) for n in schema.names]))


def write_jsonl(df: DataFrame, path: str) -> None:
    """Records as JSON lines with sorted keys and nulls kept; the committer publishes the folder when it is whole."""
    df.select(*sorted(df.columns)).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_splits(df: DataFrame, path: str, column: str, domain: list[str]) -> None:
    """One folder column=NAME for each split in one pass over df, those without rows too."""
    spark = df.sparkSession
    (df.select(*sorted(df.columns)).write.mode("overwrite").option("ignoreNullFields", "false").partitionBy(column).json(path))
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in domain:
        p = jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={name}")
        p.getFileSystem(conf).mkdirs(p)


def read_manifest(spark: SparkSession, path: str | Path) -> DataFrame:
    """(source_id, url, title, publisher, ordinal, license) of the documents of a YAML source manifest; one without source_id or an address is an error."""
    import yaml

    raw = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    if not raw.get("source_id"):
        raise ValueError(f"{path} has no source_id")
    rows = []
    for n, one in enumerate(raw.get("documents") or []):
        if not one.get("source_url"):
            raise ValueError(f"{path}: document {n + 1} has no source_url")
        lic = tuple(one.get(k) for k in ("license_status", "license_id", "license_evidence_url", "license_review_notes"))
        rows.append((raw["source_id"], one["source_url"], one.get("title"), one.get("publisher"), n, (lic[0] or "needs_review", *lic[1:])))
    return spark.createDataFrame(rows, "source_id string, url string, title string, publisher string, ordinal int, license struct<status:string,license_id:string,evidence_url:string,review_notes:string>")


def read_packages(spark: SparkSession, root: str, profile: str, schema: StructType | str) -> DataFrame:
    """Input packages of a profile, one file each; a folder that is not there is an error."""
    folder = Path(root) / profile
    if not folder.is_dir():
        raise FileNotFoundError(f"{folder}: build the input packages first")
    return read_json_folder(spark, f"{folder}/*.json", schema, "document_id")


def read_decisions(spark: SparkSession, pattern: str, schema: StructType | str) -> DataFrame:
    """Review decisions (sample_id, ...), one file each, named by their sample; a file that names another sample fails the job."""
    names = spark.createDataFrame([], schema).columns
    df = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(pattern)
    own = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]*\.json$", 1)
    file = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1)
    good = (F.col("sample_id") == own) | (F.col("sample_id") == file)
    bad = F.raise_error(F.concat(F.lit("decision of another sample: "), F.col("_metadata.file_path"))).cast("string")
    return df.withColumn("sample_id", F.when(good, F.col("sample_id")).otherwise(bad)).select(*names)


def write_json(path: str | Path, payload: dict) -> None:
    """A single pretty file on the driver, put in place by a rename."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, temporary = tempfile.mkstemp(dir=path.parent, prefix=path.name)
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as out:
            json.dump(payload, out, indent=2, sort_keys=True, ensure_ascii=False, default=str)
        os.replace(temporary, path)
    except BaseException:
        Path(temporary).unlink(missing_ok=True)
        raise


def data_url(content: Column, media_type: str) -> Column:
    return F.concat(F.lit(f"data:{media_type};base64,"), F.replace(F.base64(content), F.lit("\r\n"), F.lit("")))  # Spark breaks lines after 76 characters


def append_new(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old and those rows of new whose key it lacks: what people decided is never overwritten."""
    return old.unionByName(new.join(old.select(key), key, "left_anti"), allowMissingColumns=True)
