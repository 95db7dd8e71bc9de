"""Readers of candidate lists, catalogues and run state."""

from __future__ import annotations

import json
import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.operators.state import latest

URL_COLUMNS = ("url", "domain", "domain_name", "website")


def url_like(c: Column) -> Column:
    """Whether a value is a host, with or without scheme, port and path: at least two labels of letters, digits and hyphens, the last of
    two letters or more, and no blank anywhere."""
    value = F.lower(F.trim(c))
    host = F.regexp_extract(F.regexp_replace(value, "^https?://", ""), "^[^/:?#]*", 0)
    parts = F.split(host, r"\.")
    named = F.forall(parts, lambda p: p.rlike("^[a-z0-9-]+$")) & F.element_at(parts, -1).rlike("^[a-z]{2,}$")
    return F.coalesce(~F.contains(value, F.lit(" ")) & (F.size(parts) >= 2) & named, F.lit(False))


def url_column(df: DataFrame) -> str:
    """The column that holds URLs: by name, by a part of the name, else the first one; with a warning where less than 60 % of its first
    five values look like URLs."""
    low = {c.lower().strip(): c for c in df.columns}
    for name in URL_COLUMNS:
        if name in low:
            return low[name]
    for name, c in low.items():
        if "url" in name or "domain" in name:
            return c
    head = df.select(url_like(F.col(df.columns[0])).alias("ok")).head(5)
    if sum(r.ok for r in head) < max(1, int(0.6 * len(head))):
        warnings.warn(f"no column is named as URLs are; {df.columns[0]} is taken, whose first values don't look like them", stacklevel=2)
    return df.columns[0]


def _path(spark: SparkSession, path: str) -> tuple:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def discovered(spark: SparkSession, path: str, suffixes: Sequence[str] = (".csv",)) -> list[str]:
    """The files of a folder that end like this, or the one file; without the locks that editors leave. Workbooks are to be converted
    to CSV or Parquet before."""
    root, fs = _path(spark, path)
    if not fs.exists(root):
        return []
    listed = [s.getPath() for s in fs.listStatus(root)]
    return sorted(str(p) for p in listed if p.getName().lower().endswith(tuple(suffixes)) and not p.getName().startswith("~$"))


def has_columns(spark: SparkSession, path: str, wanted: Sequence[str]) -> bool:
    """Whether a CSV's header holds all these columns; its rows aren't read. A file that isn't there holds none."""
    root, fs = _path(spark, path)
    return fs.exists(root) and not set(wanted) - {c.strip() for c in spark.read.option("header", True).csv(path).columns}


def manifest(spark: SparkSession, path: str) -> dict:
    """A run's manifest, a JSON object; empty where there is none or it can't be read."""
    root, fs = _path(spark, path)
    if not fs.exists(root):
        return {}
    try:
        found = json.loads("".join(r.value for r in spark.read.text(path, wholetext=True).collect()))  # one small document
    except ValueError:
        return {}
    return found if isinstance(found, dict) else {}


def compatible(old: dict, new: dict, keys: Sequence[str]) -> bool:
    """Whether a run may be resumed: what the keys hold is the same in both manifests."""
    same = lambda x: json.dumps(x, sort_keys=True, separators=(",", ":"))
    return all(same(old.get(k)) == same(new.get(k)) for k in keys)


def run_state(exported: Sequence[DataFrame], run_id: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in a run's exported tables; rows without a run's id count as its own."""
    every = exported[0]
    for e in exported[1:]:
        every = every.unionByName(e, allowMissingColumns=True)
    own = every.where((F.coalesce(F.trim("run_id"), F.lit("")) == "") | (F.col("run_id") == run_id))
    return latest(own, keys, order)


def replayed_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """df with the words that stand for nothing in replayed text columns made empty."""
    clean = lambda c: F.when(F.lower(F.trim(c)).isin("", "nan", "none", "null", "na"), "").otherwise(F.coalesce(F.trim(c), F.lit("")))
    return df.withColumns({c: clean(F.col(c)) for c in columns if c in df.columns})


def candidates(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """(url, source_workbooks) from the CSV files of a folder, each with columns of its own: lower-cased distinct URLs, and the
    files that hold them in order of appearance. The files' headers are read on the driver, their rows aren't."""
    files = discovered(spark, path)
    parts = []
    for i, f in enumerate(files):
        df = spark.read.option("header", True).csv(f)
        parts.append(df.select(F.lower(F.trim(F.col(f"`{url_column(df)}`"))).alias("url"), F.lit(f.rsplit("/", 1)[-1]).alias("workbook"), (F.monotonically_increasing_id() + (i << 50)).alias("pos")))
    if not parts:
        return spark.createDataFrame([], "url string, source_workbooks array<string>")
    every = parts[0]
    for p in parts[1:]:
        every = every.union(p)
    return dedupe_sources(every.where("url <> ''"), limit)


def dedupe_sources(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """(url, source_workbooks, first_pos) of rows(url, workbook, pos): a partial aggregate first, so that a hot URL is one row a task and file."""
    firsts = rows.groupBy("url", "workbook").agg(F.min("pos").alias("pos"))
    out = firsts.groupBy("url").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "workbook"))), lambda x: x["workbook"]).alias("source_workbooks"), F.min("pos").alias("first_pos"))
    return out.orderBy("first_pos").limit(limit) if limit is not None else out


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.lower(F.trim("value")).alias("url")).where("url <> ''").distinct()


def require(df: DataFrame, *columns: str) -> DataFrame:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    return df


def csv_text(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A CSV of strings; without the file, no rows of the schema."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root):
        return spark.createDataFrame([], schema or T.StructType([]))
    return spark.read.csv(path, header=True, schema=schema)


ENTITY = T.MapType(T.StringType(), T.StructType([T.StructField(n, T.ArrayType(T.StringType())) for n in ("domains", "keywords", "favicon_phashes", "ssl_simhashes", "page_phashes", "domain_simhashes")]))


def entity_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """(entity, domains, keywords, ...) from a JSON object of entities; _meta goes. One document, so one task reads it."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", ENTITY).alias("m"))
    return raw.select(F.explode("m").alias("entity", "x")).where("entity <> '_meta'").select("entity", "x.*")


def filled_catalogue(df: DataFrame, name: str, order: str) -> DataFrame:
    """A small sheet whose merged cells hold a value once: filled downwards."""
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(F.when(F.trim(name) != "", F.col(name)), ignorenulls=True).over(w))
