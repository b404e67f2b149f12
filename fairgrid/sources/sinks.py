"""Writers and upserts (SNK-01 to SNK-09)."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairgrid.functions.numbers import safe_json_number
from fairgrid.operators.frames import last_per_key
from fairgrid.operators.stored import new_folder


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-01: Parquet, zstd."""
    df.write.mode(mode).option("compression", "zstd").parquet(path)


def write_by_month(df: DataFrame, path: str, date: str = "date", mode: str = "overwrite") -> None:
    """SNK-02: one folder for each year and month; rows are dealt by month first, so that each folder gets few files."""
    df.withColumns({"year": F.year(date), "month": F.month(date)}).repartition("year", "month").sortWithinPartitions(date).write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("year", "month").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """SNK-03: CSV with header, UTF-8."""
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def json_safe(df: DataFrame) -> DataFrame:
    """SNK-04: NaN and infinite numbers become null, dates become text."""
    return df.select(*[safe_json_number(F.col(f.name)).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, (T.DateType, T.TimestampType)) else F.col(f.name) for f in df.schema])


def write_json(df: DataFrame, path: str) -> None:
    json_safe(df).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_regions(df: DataFrame, path: str, values: list[str], region: str = "region", district: str = "district") -> DataFrame:
    """SNK-05: one nested JSON document for each region, {region, districts: [{district, cells: [...]}]}, and the index: region, districts, rows.

    A region's document holds its cells of one day, as many as the region has; they are put in order of district and value.
    """
    cells = json_safe(df).groupBy(region, district).agg(F.sort_array(F.collect_list(F.struct(*values))).alias("cells"))
    document = cells.groupBy(region).agg(F.sort_array(F.collect_list(F.struct(district, "cells"))).alias("districts"))
    document.repartition(region).write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return df.groupBy(region).agg(F.count_distinct(district).alias("districts"), F.count("*").alias("rows"))


def upsert_by_date(old: DataFrame, new: DataFrame, date: str = "date") -> DataFrame:
    """SNK-06: of a date's rows the incoming one wins."""
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    return last_per_key(both.withColumn("__at", F.monotonically_increasing_id()), [date], [F.col("__new"), F.col("__at")]).drop("__new", "__at")


def upsert_cells(old: DataFrame, new: DataFrame, keys: tuple[str, ...] = ("date", "station_id"), value: str = "price") -> DataFrame:
    """SNK-07: the union of keys, incoming non-null values over old ones."""
    return old.withColumnRenamed(value, "__old").join(new.withColumnRenamed(value, "__new"), list(keys), "full").select(*keys, F.coalesce("__new", "__old").alias(value))


def rolling_state(df: DataFrame, days: int = 45, keys: tuple[str, ...] = ("date", "grid_id"), order: str = "seq") -> DataFrame:
    """SNK-08: the last row of each key in the last ``days`` days of the table."""
    top = df.agg(F.max("date").alias("__top"))
    return last_per_key(df.crossJoin(F.broadcast(top)).where(F.col("date") > F.date_sub("__top", days)).drop("__top"), list(keys), [F.col(order)])


def cached(spark: SparkSession, folder: str, conditions: dict, inputs: list[str], build) -> DataFrame:
    """SNK-09: the result of ``build`` kept under a digest of the conditions and of the inputs' names, sizes and times; read again only if all agree."""
    signature = []
    for path in inputs:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", F.col("modificationTime").cast("string"))
        signature.append([path, files.agg(F.count("*"), F.sum("length"), F.max("modificationTime"), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")).cast("string")).first().asDict()])
    key = hashlib.sha256(json.dumps([conditions, signature], sort_keys=True, default=str).encode()).hexdigest()[:32]
    target = f"{folder}/{key}"
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(target)
    except AnalysisException:
        write_parquet(build(), target)
        return spark.read.parquet(target)


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the storage that the cluster shares."""
    return new_folder(spark, name)
