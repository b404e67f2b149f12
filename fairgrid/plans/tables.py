"""The given tables in the roles of the price-fairness model, for Spark and, as SQL, for the reference results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tax cuts and a price cap: name, start, end, fuel, rate (share of the base tax), category (0 tax, 1 cap).
POLICIES = (
    ("cut A", "1996-03-10", "1996-12-31", "gasoline", 0.10, 0),
    ("cut B", "1996-11-01", "1997-02-28", "gasoline", 0.20, 0),
    ("cut C", "1998-05-04", "1998-08-31", "diesel", 0.15, 0),
    ("void", "1999-01-01", "1999-01-31", "diesel", 0.0, 0),
    ("cap", "1997-01-15", "1997-04-15", "gasoline", 0.05, 1),
    ("cut D", "2000-01-01", "2000-06-30", "gasoline", 0.30, 0),
)
POLICY_SQL = "policies(name, start, \"end\", fuel, rate, category) as (values " + ", ".join(f"('{n}', date '{a}', date '{b}', '{f}', cast({r} as double), {c})" for n, a, b, f, r, c in POLICIES) + ")"

OBS_SQL = """obs as (select cast(l_shipdate as date) d, l_suppkey station_id, l_extendedprice / l_quantity price, case when l_linestatus = 'F' then 'gasoline' else 'diesel' end fuel,
 l_quantity w, l_partkey, l_returnflag, l_orderkey ok, l_linenumber ln, cast((l_suppkey % 10) * 500 as int) cell_x, cast((l_suppkey // 10) * 500 as int) cell_y from lineitem)"""
GRID_SQL = OBS_SQL + """, grid as (select d, fuel, cell_x, cell_y, 'G500_' || cell_x // 500 || '_' || cell_y // 500 grid_id, avg(price) price, count(*) n, sum(w) w from obs group by all)"""
DOM_SQL = "dom as (select cast(o_orderdate as date) d, avg(o_totalprice) x, count(*) n from orders group by 1)"
INTL_SQL = "intl as (select cast(l_shipdate as date) d, avg(l_extendedprice) y from lineitem group by 1)"
STATION_SQL = "station as (select s_suppkey station_id, s_name, cast((s_suppkey % 10) * 500 as int) cell_x, cast((s_suppkey // 10) * 500 as int) cell_y, n_name district, r_name region, s_acctbal from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def policies(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(POLICIES, "name string, start string, end string, fuel string, rate double, category int").withColumns({"start": F.to_date("start"), "end": F.to_date("end")})


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station price observations: a row of lineitem each."""
    return read(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("d"), F.col("l_suppkey").alias("station_id"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.when(F.col("l_linestatus") == "F", "gasoline").otherwise("diesel").alias("fuel"), F.col("l_quantity").alias("w"), "l_partkey", "l_returnflag", F.col("l_orderkey").alias("ok"), F.col("l_linenumber").alias("ln"),
        ((F.col("l_suppkey") % 10) * 500).cast("int").alias("cell_x"), (F.floor(F.col("l_suppkey") / 10) * 500).cast("int").alias("cell_y"),
    )


#: Observations in a partition of series; smaller ones, of so many at least, up to a number of partitions.
_SERIES_ROWS, _SERIES_LEAST, _SERIES_PARTS = 600_000, 50_000, 24


def dealt(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` dealt by keys to so many partitions that one holds about as many rows at any size; days are aggregated there, since hardly two rows of a scan share theirs."""
    n = rows.count()
    return rows.repartition(max(1, -(-n // _SERIES_ROWS), min(_SERIES_PARTS, -(-n // _SERIES_LEAST))), *keys)


def grid_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-01, AGG-02: price, stations and weight of each cell, day and fuel; partial sums are merged by one aggregate."""
    from fairgrid.functions.text import grid_id

    cells = observations(spark, sf_dir).groupBy("d", "fuel", "cell_x", "cell_y").agg(F.avg("price").alias("price"), F.count("*").alias("n"), F.sum("w").alias("w"))
    return cells.withColumn("grid_id", grid_id(500, (F.col("cell_x") / 500).cast("int"), (F.col("cell_y") / 500).cast("int")))


def domestic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("d")).agg(F.avg("o_totalprice").alias("x"), F.count("*").alias("n"))


def international(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").groupBy(F.to_date("l_shipdate").alias("d")).agg(F.avg("l_extendedprice").alias("y"))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, r = (read(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    return s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("s_suppkey").alias("station_id"), "s_name", ((F.col("s_suppkey") % 10) * 500).cast("int").alias("cell_x"), (F.floor(F.col("s_suppkey") / 10) * 500).cast("int").alias("cell_y"),
        F.col("n_name").alias("district"), F.col("r_name").alias("region"), "s_acctbal",
    )
