"""The flagship report."""

from pyspark.sql import DataFrame, SparkSession

from evigrain.plans.queries import split_token_report as _report


def split_token_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, tokens and fits by split."""
    return _report(spark, sf_dir)
