"""Sources and sinks: raw record shards, lookups, SDF text, rule files, inline values, and JDBC tables."""

from __future__ import annotations

import importlib
import json
import os
import pkgutil
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandwise.operators.pick import dense_ids
from strandwise.session import exists

#: Data sets that are skipped unless named.
LEFT_OUT = frozenset()


class Catalog:
    """Data sets by source and name; loaders run only when asked for."""

    def __init__(self):
        self.loaders: dict[tuple[str, str], tuple[Callable[[SparkSession], DataFrame], str]] = {}

    def add(self, source: str, dataset: str, load: Callable[[SparkSession], DataFrame], kind: str = "entity") -> None:
        self.loaders[source, dataset] = (load, kind)

    def select(self, sources: list[str] | None = None, dataset: str | None = None, left_out: frozenset[str] = LEFT_OUT) -> list[tuple[str, str]]:
        """Entity data sets of the named sources, or of all but `left_out`; unknown or no data sets are errors."""
        known = {s for s, _ in self.loaders}
        if sources and (unknown := set(sources) - known):
            raise ValueError(f"unknown sources: {sorted(unknown)}")
        chosen = [(s, d) for (s, d), (_, kind) in self.loaders.items() if kind == "entity" and (s in sources if sources else s not in left_out) and dataset in (None, d)]
        if not chosen:
            raise ValueError("no data set selected")
        return chosen

    def load(self, spark: SparkSession, source: str, dataset: str) -> DataFrame:
        return self.loaders[source, dataset][0](spark)

    def discover(self, package: str) -> dict[str, str]:
        """Imports every module of a package and calls its `register(catalog)`; those that can't be imported are reported and left out."""
        failed = {}
        for m in pkgutil.walk_packages(importlib.import_module(package).__path__, f"{package}."):
            try:
                module = importlib.import_module(m.name)
            except ImportError as e:
                failed[m.name] = str(e)
                continue
            if hasattr(module, "register"):
                module.register(self)
        return failed


def plain_types(df: DataFrame) -> DataFrame:
    """Columns as a shard can hold them: bytes as text (broken UTF-8 replaced), untyped nulls as text, structs without children left out."""

    def usable(kind: T.DataType) -> bool:
        return not isinstance(kind, T.StructType) or any(usable(f.dataType) for f in kind.fields)

    def cast(c: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.BinaryType):
            return F.make_valid_utf8(c.cast("string"))
        if isinstance(kind, T.NullType):
            return c.cast("string")
        if isinstance(kind, T.StructType):
            return F.when(c.isNotNull(), F.struct(*[cast(c[f.name], f.dataType).alias(f.name) for f in kind.fields if usable(f.dataType)]))
        if isinstance(kind, T.ArrayType) and usable(kind.elementType):
            return F.transform(c, lambda x: cast(x, kind.elementType))
        return c

    return df.select(*[cast(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields if usable(f.dataType)])


def numbered(df: DataFrame, key: str, out: str = "row_id", offset: int = 0) -> DataFrame:
    """Consecutive numbers after `offset` in order of a unique key, so the numbers of a later shard go on from an earlier one's."""
    return dense_ids(df, key, out, offset + 1)


def write_shards(df: DataFrame, path: str, manifest: dict) -> None:
    """Raw rows as compressed Parquet; a manifest beside them is written last, so an unfinished write is a miss."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    spark = df.sparkSession
    spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "manifest string").coalesce(1).write.mode("overwrite").text(f"{path.rstrip('/')}.manifest")


def cached_shards(spark: SparkSession, path: str, manifest: dict) -> DataFrame | None:
    """The shards if their manifest says the same, else None."""
    at = f"{path.rstrip('/')}.manifest"
    if not exists(spark, at) or not exists(spark, path):
        return None
    rows = spark.read.text(at).limit(2).collect()
    try:
        same = len(rows) == 1 and json.loads(rows[0][0]) == manifest
    except ValueError:  # a manifest that was cut off
        same = False
    return read_shards(spark, path) if same else None


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Shards whose columns differ are read as the union of their columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def capped(df: DataFrame, max_records: int, order: list[str]) -> DataFrame:
    """The first `max_records` rows in a total order; 0 means all."""
    return df.orderBy(*order).limit(max_records) if max_records else df


def lookup(spark: SparkSession, candidates: list[str]) -> DataFrame | None:
    """The first of several places (files, folders or patterns) that is there; one that is there but broken is an error."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in candidates:
        p = jvm.org.apache.hadoop.fs.Path(path)
        found = p.getFileSystem(conf).globStatus(p)
        if found is not None and len(found):
            return spark.read.parquet(path)
    return None


def replace_parquet(df: DataFrame, path: str) -> None:
    """Writes beside the target, then swaps, so readers never see half a table."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    new, old, at = (jvm.org.apache.hadoop.fs.Path(p) for p in (f"{path}.new", f"{path}.old", path))
    fs = at.getFileSystem(conf)
    fs.delete(new, True)
    df.write.parquet(f"{path}.new")
    fs.delete(old, True)
    if fs.exists(at):
        fs.rename(at, old)
    fs.rename(new, at)
    fs.delete(old, True)


def read_sdf(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """One row per record of SDF text (plain or gzip) with the named fields; the first value of a field wins, an absent one is null.

    Records end with a line of four dollar signs; a field's value is the lines between its tag and the next blank line.
    """
    text = spark.read.option("lineSep", "$$$$\n").text(path).where(F.trim("value") != "")
    return text.select(*[F.nullif(F.regexp_extract("value", rf"(?m)^>[^\n]*<{f}>[^\n]*\n((?:[^\n]+\n?)*?)(?:\n|\z)", 1), F.lit("")).alias(f) for f in fields]).select(*[F.trim(F.regexp_replace(f, r"\s+$", "")).alias(f) for f in fields])


def shard_names(listing: str, pattern: str = r"[\w.-]+\.sdf\.gz") -> list[str]:
    """The distinct shard names that the links of a folder's HTML listing lead to, in order."""
    return sorted({m[1].rpartition("/")[2] for m in re.finditer(r"""href\s*=\s*["']([^"'?#]+)["']""", listing, re.IGNORECASE) if re.fullmatch(pattern, m[1].rpartition("/")[2])})


def write_resumably(spark: SparkSession, shards: list[str], load: Callable[[str], DataFrame], folder: str) -> dict[str, int]:
    """Each shard as Parquet with its row count beside it, written last; shards whose count is there are not loaded again. Returns rows by shard.

    A gzip shard can't be split, so it is one task; the driver sees counts only.
    """
    out = {}
    for s in shards:
        at = f"{folder.rstrip('/')}/{s.rpartition('/')[2]}"
        done = f"{at}.done"
        if not exists(spark, f"{done}/_SUCCESS"):
            load(s).write.mode("overwrite").parquet(at)
            spark.createDataFrame([(str(spark.read.parquet(at).count()),)], "n string").coalesce(1).write.mode("overwrite").text(done)
        out[s] = int(spark.read.text(done).first()[0])
    return out


def rules(path: str) -> list[dict]:
    """The rules of a JSON or YAML file (a list of mappings); small by nature, so they become an inline relation or expressions."""
    with open(path) as f:
        if path.endswith((".yaml", ".yml")):
            import yaml

            found = yaml.safe_load(f)
        else:
            found = json.load(f)
    if not isinstance(found, list) or not all(isinstance(x, dict) for x in found):
        raise ValueError(f"{path} holds no list of rules")
    return found


def columns_of(spark: SparkSession, path: str) -> list[str]:
    """The columns of a table in a folder, or none if it isn't there."""
    return spark.read.parquet(path).columns if exists(spark, path) else []


def by_case(df: DataFrame, column: str, cases: dict[str, int], otherwise: int | None = None) -> DataFrame:
    """A text column mapped to numbers as a database export states them; texts that are not listed give `otherwise`."""
    out = F.lit(otherwise).cast("bigint")
    for text, n in cases.items():
        out = F.when(F.col(column) == text, F.lit(n)).otherwise(out)
    return df.withColumn(column, out.cast("bigint"))


def inline(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small fixed relation; joined with it, rows are never shuffled."""
    return spark.createDataFrame(rows, schema)


def jdbc(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, parts: int, properties: dict | None = None) -> DataFrame:
    """A database table read in parallel ranges of a numeric column."""
    return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=parts, properties=properties or {})


def write_csv(df: DataFrame, path: str, null: str = "\\N") -> None:
    """CSV for a database's bulk loader."""
    df.write.mode("overwrite").option("nullValue", null).option("escape", '"').csv(path)


def sweep(folder: str, keep: set[str]) -> list[str]:
    """Removes entries of a local staging folder that are not kept; names what went."""
    import shutil

    gone = sorted(set(os.listdir(folder)) - keep) if os.path.isdir(folder) else []
    for g in gone:
        full = os.path.join(folder, g)
        shutil.rmtree(full) if os.path.isdir(full) else os.remove(full)
    return gone
