"""References to records that do not exist, by compressed bitmaps per key range and month."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from strandwise.operators.skew import join_unique
from strandwise.session import Scratch

#: Bits of one bitmap; Spark's bitmap aggregates use the same size.
BITS = 32768
REF, BORN, GONE = 0, 1, 2
#: The period of a reference without a time.
NO_PERIOD = -1


def _and_not(pdf: pd.DataFrame) -> pd.DataFrame:
    """Bitmaps of one bucket: for each period, references AND NOT keys alive throughout the period.

    A group holds at most three bitmaps of 4 KB per month, however many rows stand behind them.
    """
    maps: dict[int, list[tuple[int, np.ndarray]]] = {REF: [], BORN: [], GONE: []}
    for kind, period, bits in zip(pdf["kind"], pdf["period"], pdf["bits"]):
        maps[kind].append((period, np.frombuffer(bits, dtype=np.uint8)))
    for m in maps.values():
        m.sort(key=lambda x: x[0])
    codes, periods = [], []
    born, gone = np.zeros(BITS // 8, np.uint8), np.zeros(BITS // 8, np.uint8)
    i = j = 0
    every = np.bitwise_or.reduce([b for _, b in maps[BORN]], axis=0) if maps[BORN] else born
    for period, refs in maps[REF]:
        while i < len(maps[BORN]) and maps[BORN][i][0] < period:
            born = born | maps[BORN][i][1]
            i += 1
        while j < len(maps[GONE]) and maps[GONE][j][0] <= period:
            gone = gone | maps[GONE][j][1]
            j += 1
        left = refs & ~(every if period == NO_PERIOD else born & ~gone)
        at = np.flatnonzero(np.unpackbits(left, bitorder="little"))
        codes.append(at)
        periods.append(np.full(len(at), period))
    base = (int(pdf["key_range"].iloc[0]) << 40) + int(pdf["bucket"].iloc[0]) * BITS
    return pd.DataFrame({"cid": base + np.concatenate(codes or [np.zeros(0)]).astype(np.int64), "period": np.concatenate(periods or [np.zeros(0)]).astype(np.int32)})


def _month(c: str):
    return (F.year(c) * 12 + F.month(c) - 1).cast("int")


def orphan_references(refs: DataFrame, parents: DataFrame, ranges: int | None = None) -> DataFrame:
    """The rows of `refs` whose record is absent, not there yet, or withdrawn at the time of the reference.

    refs: ref_key (string; null is no reference), ref_at (timestamp) and any further columns, returned as
    they are. parents: key, born, gone (null: never withdrawn); of several rows of a key the earliest born
    counts, and it is withdrawn once all of them are. Adds orphan_kind: missing (no such key), late (born after
    ref_at) or deleted (gone not after ref_at). A null ref_at can only be missing; a null born was always
    there. Repeated rows stay repeated; empty tables give an empty result.

    1. (key, month) pairs of the references and one row per parent are formed with partial aggregation, so a
       key with any number of references weighs one row a month. 2. Keys are dictionary-encoded: within each
       hash range of keys (`ranges` of them, by default 4 per shuffle partition) by their order. 3. One bitmap
       per range, block of 32 768 codes and month holds the references, the births and the withdrawals; they
       travel compressed. 4. references AND NOT (born before the month AND NOT gone by its end) leaves the
       candidates. 5. Their bits are decoded to keys, and only the rows of those are compared by exact time.
    """
    spark = refs.sparkSession
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    scratch = Scratch(spark)
    named = refs.where(F.col("ref_key").isNotNull()).withColumn("__ref_month", F.coalesce(_month("ref_at"), F.lit(NO_PERIOD)))
    used = named.groupBy(F.col("ref_key").alias("key"), F.col("__ref_month").alias("period")).agg(F.lit(None).cast("timestamp").alias("born"), F.lit(None).cast("timestamp").alias("gone")).withColumn("kind", F.lit(REF))
    never = F.lit("0001-01-01 00:00:00").cast("timestamp")
    lives = (
        parents.where(F.col("key").isNotNull()).groupBy("key")
        .agg(F.min(F.coalesce("born", never)).alias("born"), F.when(F.count("gone") == F.count(F.lit(1)), F.max("gone")).alias("gone"))
        .select("key", _month("born").alias("period"), "born", "gone", F.lit(BORN).alias("kind"))
    )
    ranged = used.select(lives.columns).unionByName(lives).withColumn("key_range", F.pmod(F.xxhash64("key"), F.lit(ranges)))
    code = F.dense_rank().over(W.partitionBy("key_range").orderBy("key")) - 1
    coded = scratch.write(ranged.withColumn("cid", F.shiftleft(F.col("key_range").cast("bigint"), 40) + code).drop("key_range"))
    births = coded.where(F.col("kind") == BORN)
    marks = (
        coded.select("cid", "kind", "period")
        .unionByName(births.where("gone is not null").select("cid", F.lit(GONE).alias("kind"), _month("gone").alias("period")))
        .withColumn("code", F.col("cid") % (1 << 40))
    )
    bitmaps = marks.groupBy(F.shiftright("cid", 40).alias("key_range"), F.shiftright("code", 15).alias("bucket"), "kind", "period").agg(F.bitmap_construct_agg(F.col("code") % BITS).alias("bits"))
    left = bitmaps.groupBy("key_range", "bucket").applyInPandas(_and_not, "cid long, period int")
    keys = coded.where(F.col("kind") == REF).select("cid", "period", "key").join(left, ["cid", "period"])
    candidates = keys.join(births.select("cid", F.col("born"), F.col("gone"), F.lit(True).alias("there")), "cid", "left")
    pair = lambda k, m: F.concat_ws("#", F.col(m).cast("string"), F.col(k))
    small = candidates.select(pair("key", "period").alias("__pair"), F.col("born").alias("__born"), F.col("gone").alias("__gone"), F.col("there").alias("__there"))
    rows = join_unique(named.withColumn("__pair", pair("ref_key", "__ref_month")), small, "__pair")
    kind = F.when(F.col("__there").isNull(), "missing").when(F.col("__born") > F.col("ref_at"), "late").when(F.col("__gone") <= F.col("ref_at"), "deleted")
    return rows.withColumn("orphan_kind", kind).where("orphan_kind is not null").select(*refs.columns, "orphan_kind")


def orphan_report(orphans: DataFrame, by: list[str], at: str) -> DataFrame:
    """Orphans per `by` columns and month of `at` (null: no time), by kind."""
    return orphans.groupBy(*by, F.date_format(at, "yyyy-MM").alias("period"), "orphan_kind").agg(F.count(F.lit(1)).alias("n_orphans"))
