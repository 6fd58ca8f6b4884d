"""Joins of points with ranges, and of ranges with ranges, as equi-joins on bins.

Bins are dyadic: a range lies in two neighbouring bins at most of the least level whose bins are as wide as it is, however long
it is, and a point is in one bin of each level that ranges have.  So a pair meets once, and long ranges aren't cut up.
A key or bin with more than ``hot`` points is split: its points are dealt into parts by a hash, and its few ranges go to each part.

Defined results: nulls in a key or a bound meet nothing; ranges that end before they start hold nothing; bounds belong
to the range; equal rows meet as often as they come (equal points are dealt to one part).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT = 100_000


def level(lo: Column, hi: Column) -> Column:
    """The least level whose bins, of 2^level, are wider than the range is long."""
    long = F.try_subtract(hi.cast("long"), lo.cast("long"))  # null for more than a long takes
    return F.coalesce(F.length(F.regexp_replace(F.bin(long), "^0+", "")), F.lit(63)).cast("int")


def bin_of(at: Column, lev: Column) -> Column:
    return F.call_function("shiftright", at.cast("long"), lev)


def points_in(points: DataFrame, ranges: DataFrame, key: str, at: str, lo: str, hi: str, hot: int = HOT) -> DataFrame:
    """Every pair of a point and a range of the same ``key`` (of both tables) with lo <= at <= hi; columns of both but the ranges' key.

    ``at``, ``lo`` and ``hi`` are whole numbers.  Other columns of the two must differ in name.
    """
    r = ranges.withColumnRenamed(key, "_key").filter((F.col(lo) <= F.col(hi)) & F.col("_key").isNotNull())
    r = r.withColumn("_level", level(F.col(lo), F.col(hi)))
    r = r.withColumn("_bin", F.explode(F.sequence(bin_of(F.col(lo), F.col("_level")), bin_of(F.col(hi), F.col("_level")))))
    levels = sorted(x[0] for x in r.select("_level").distinct().collect())  # 64 at most
    p = points.filter(F.col(key).isNotNull() & F.col(at).isNotNull())
    p = p.withColumn("_plevel", F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))).withColumn("_pbin", bin_of(F.col(at), F.col("_plevel")))
    crowds = p.groupBy(F.col(key).alias("_hkey"), F.col("_plevel").alias("_hlevel"), F.col("_pbin").alias("_hbin")).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot)
    crowds = crowds.withColumn("_parts", F.ceil(F.col("_n") / hot).cast("int")).drop("_n")
    in_crowd = lambda k, lev, b: (F.col(k) == F.col("_hkey")) & (F.col(lev) == F.col("_hlevel")) & (F.col(b) == F.col("_hbin"))
    here = ["_hkey", "_hlevel", "_hbin", "_parts"]
    p = p.join(crowds, in_crowd(key, "_plevel", "_pbin"), "left")
    hashed = [F.col(c) for c, t in points.dtypes if "map<" not in t and t != "variant"]
    p = p.withColumn("_ppart", F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*hashed), F.col("_parts").cast("long"))).cast("int")).drop(*here)
    r = r.join(crowds, in_crowd("_key", "_level", "_bin"), "left")
    r = r.withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))).drop(*here)
    same = (F.col(key) == F.col("_key")) & (F.col("_plevel") == F.col("_level")) & (F.col("_pbin") == F.col("_bin")) & (F.col("_ppart") == F.col("_part"))
    out = p.join(r, same & (F.col(at) >= F.col(lo)) & (F.col(at) <= F.col(hi)))
    return out.drop("_key", "_level", "_bin", "_part", "_plevel", "_pbin", "_ppart")


def overlapping(a: DataFrame, b: DataFrame, key: str, a_lo: str, a_hi: str, b_lo: str, b_hi: str, hot: int = HOT) -> DataFrame:
    """Every pair of ranges of the same key that have a point in common, once: one of them starts inside the other."""
    a = a.filter(F.col(a_lo) <= F.col(a_hi))
    b = b.filter(F.col(b_lo) <= F.col(b_hi))
    first = points_in(a, b, key, a_lo, b_lo, b_hi, hot)
    second = points_in(b, a, key, b_lo, a_lo, a_hi, hot).filter(F.col(b_lo) > F.col(a_lo))
    return first.unionByName(second.select(*first.columns))
