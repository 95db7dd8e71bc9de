"""Writers: projected CSV, partitioned exports, merged debug tables, packages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.text import present
from vigil.operators.reports import exploded
from vigil.operators.state import latest


def to_schema(df: DataFrame, columns: Sequence[str], default: str = "") -> DataFrame:
    """Exactly the columns of a sink: extra ones go, missing and null ones hold the default."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(default)).alias(c) if c in df.columns else F.lit(default).alias(c) for c in columns])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def export_by_workbook(df: DataFrame, path: str, column: str = "source_workbook") -> None:
    """A folder for each workbook in the list column; rows of several workbooks are in each. Rebalanced, so that a hot workbook is written by many tasks."""
    exploded(df, column, "export_workbook").hint("rebalance", "export_workbook").write.mode("overwrite").partitionBy("export_workbook").option("header", True).csv(path)


def merged_debug(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old rows and new ones, the new winning on equal keys."""
    both = old.withColumn("__age", F.lit(0)).unionByName(new.withColumn("__age", F.lit(1)), allowMissingColumns=True)
    return latest(both, keys, ["__age"]).drop("__age")


def flagged(df: DataFrame, label: str = "classification") -> DataFrame:
    return df.where(F.col(label).isin("Phishing", "Suspected"))


def packaged(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The submission's columns (new name to old); blanks become NA."""
    return df.select(*[F.when(present(F.col(old).cast("string")), F.trim(F.col(old).cast("string"))).otherwise("NA").alias(new) for new, old in columns.items()])
