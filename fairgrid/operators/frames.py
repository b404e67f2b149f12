"""Frames: projection, fills, de-duplication, reshaping, sets (PRJ, FLT, RSH, WIN-01, DED, SET)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairgrid.functions.numbers import half_up
from fairgrid.operators.stored import cut


def rename(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """PRJ-01: headers, without blanks and brackets, to canonical names; unknown headers stay."""
    bare = lambda c: "".join(ch for ch in c if not ch.isspace() and ch not in "()[]﻿")
    return df.toDF(*[aliases.get(bare(c), aliases.get(c, c)) for c in df.columns])


def prefixed(df: DataFrame, prefix: str, keep: tuple[str, ...]) -> DataFrame:
    """PRJ-02: a prefix for all columns but the keys."""
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns])


def to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """PRJ-03: exactly the columns of ``schema``, cast; absent ones are null, others go."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def rounded(df: DataFrame, digits: int = 3, skip: tuple[str, ...] = (), half_even: bool = False) -> DataFrame:
    """PRJ-06: floating columns rounded, half up or half to even; others untouched."""
    f = F.bround if half_even else half_up
    return df.select(*[f(c.name, digits).alias(c.name) if c.dataType in (T.DoubleType(), T.FloatType()) and c.name not in skip else F.col(c.name) for c in df.schema])


def within(date: Column, first: Column | None, last: Column | None) -> Column:
    """FLT-01, FLT-13: between two dates, either of which may be open."""
    test = F.lit(True)
    if first is not None:
        test = test & (first.isNull() | (date >= first))
    if last is not None:
        test = test & (last.isNull() | (date <= last))
    return test


def last_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """DED-01 (and DED-03 with falling order): the row that comes last by ``order``; ties must be broken by it."""
    down = [c.desc_nulls_last() for c in order]
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*down))).where("__rn = 1").drop("__rn")


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*[c.asc_nulls_last() for c in order]))).where("__rn = 1").drop("__rn")


def richest_per_key(df: DataFrame, keys: list[str], values: list[str], order: Column) -> DataFrame:
    """DED-02: the row with most values present; of equals the last by ``order``."""
    filled = reduce(lambda a, b: a + b, [F.col(v).isNotNull().cast("int") for v in values])
    return df.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in df.columns if c not in keys]), F.struct(filled, order)).alias("r")).select(*keys, "r.*")


def latest_per_key(df: DataFrame, keys: list[str], date: str) -> DataFrame:
    """WIN-13, FLT-02: the row of the latest date, without a sort."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(date)).alias("r")).select(*keys, "r.*")


def forward_fill(df: DataFrame, columns: list[str], order: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """WIN-01: the last value seen; leading nulls remain."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def melt(df: DataFrame, ids: list[str], values: list[str], name: str, value: str) -> DataFrame:
    """RSH-01: wide to long, nulls dropped."""
    return df.unpivot(ids, values, name, value).where(F.col(value).isNotNull())


def pivot_last(df: DataFrame, key: str, name: str, names: list, value: str, order: Column) -> DataFrame:
    """RSH-02: long to wide over given names, the last value winning."""
    return df.where(F.col(name).isin(*names)).groupBy(key).agg(*[F.max_by(F.when(F.col(name) == n, F.col(value)), F.when(F.col(name) == n, order)).alias(str(n)) for n in names])


def priority_union(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """SET-04: of rows with equal keys that of the latest part stays."""
    tagged = [p.withColumn("__p", F.lit(i)) for i, p in enumerate(parts)]
    return last_per_key(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged), keys, [F.col("__p")]).drop("__p")


def change_history(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """WIN-14: only the rows at which a key's value changes, each with the date until which it holds (null: still)."""
    w = Window.partitionBy(*keys).orderBy(order)
    kept = df.withColumn("__before", F.lag(value).over(w)).withColumn("__rn", F.row_number().over(w)).where((F.col("__rn") == 1) | ~F.col(value).eqNullSafe(F.col("__before"))).drop("__before", "__rn")
    return kept.withColumn("valid_to", F.lead(order).over(w))


def append_changes(history: DataFrame, new: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """WIN-14: ``history`` (keys, order, value, valid_to, seen) with the observations ``new`` (keys, order, value), in whatever order they are delivered.

    An interval keeps the dates at which its value was ``seen``, so a late observation cuts it where it must and the result is that of all
    observations at once. Of two values for one key and date that delivered later counts; repeated rows of one delivery go by the greatest
    value. Only the keys that ``new`` touches are worked on.
    """
    touched = new.select(*keys).distinct()
    old = history.join(touched, keys, "left_semi").select(*keys, F.explode("seen").alias(order), value, F.lit(0).alias("__new"))
    both = old.unionByName(new.select(*keys, order, value, F.lit(1).alias("__new")))
    rows = last_per_key(both, [*keys, order], [F.col("__new"), F.col(value)])
    w = Window.partitionBy(*keys).orderBy(order)
    turn = F.coalesce((~F.col(value).eqNullSafe(F.lag(value).over(w))).cast("int"), F.lit(0)) + F.when(F.row_number().over(w) == 1, 1).otherwise(0)
    runs = rows.withColumn("__turn", (turn > 0).cast("int")).withColumn("__run", F.sum("__turn").over(w))
    made = runs.groupBy(*keys, "__run").agg(F.min(order).alias(order), F.first(value).alias(value), F.sort_array(F.collect_list(order)).alias("seen"))
    made = made.withColumn("valid_to", F.lead(order).over(w)).select(*keys, order, value, "valid_to", "seen")
    return history.join(touched, keys, "left_anti").select(*keys, order, value, "valid_to", "seen").unionByName(made)


def islands(df: DataFrame, keys: list[str], order: str, flag: Column) -> DataFrame:
    """WIN-16: (keys, start, end, rows, tone) of each run of equal ``flag``; rows with a null flag break runs and go."""
    w = Window.partitionBy(*keys).orderBy(order)
    marked = df.withColumn("tone", flag).withColumn("__new", F.coalesce((~F.col("tone").eqNullSafe(F.lag("tone").over(w))).cast("int"), F.lit(1)))
    run = marked.withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return run.where("tone is not null").groupBy(*keys, "__run", "tone").agg(F.min(order).alias("start"), F.max(order).alias("end"), F.count("*").alias("rows")).drop("__run")


def in_hash_sample(keys: list[str], per_mille: int, salt: int = 0) -> Column:
    """FLT-08: whether a row's key hash falls below a rate."""
    return F.pmod(F.xxhash64(*keys, F.lit(salt)), F.lit(1000)) < per_mille


def hash_sample(df: DataFrame, keys: list[str], per_mille: int, salt: int = 0) -> DataFrame:
    """FLT-08: rows whose key hash falls below a rate; the same rows each time."""
    return df.where(in_hash_sample(keys, per_mille, salt))


def fixed_sample(df: DataFrame, keys: list[str], n: int, salt: int = 0) -> DataFrame:
    """FLT-09: ``n`` rows by key hash (more only where the last hash has several rows), in key order.

    Rows are counted by the first 16 bits of their hash. Those up to the range of the n-th hash are stored, and that hash is found among the
    rows of the last range, some 65,536th of all. So no task holds more than a row for each range, or the rows of one, to find it.
    """
    hashed = df.withColumn("__h", F.xxhash64(*keys, F.lit(salt))).withColumn("__range", F.shiftright("__h", 48))

    def last(rows: DataFrame, by: str, before: int) -> tuple:
        """The greatest value of ``by`` with fewer than ``n`` rows before it, and how many these are."""
        told = rows.groupBy(by).agg(F.count("*").alias("m"))
        earlier = F.sum("m").over(Window.orderBy(by).rowsBetween(Window.unboundedPreceding, 0)) - F.col("m") + before
        return tuple(told.withColumn("earlier", earlier).where(F.col("earlier") < n).agg(F.max(by), F.max("earlier")).first())

    end, before = last(hashed, "__range", 0)
    some = cut(hashed.where(F.col("__range") <= F.lit(end)).drop("__range"))
    most = last(some.where(F.shiftright("__h", 48) == F.lit(end)), "__h", before or 0)[0]
    return some.where(F.col("__h") <= F.lit(most)).drop("__h").orderBy(*keys)
