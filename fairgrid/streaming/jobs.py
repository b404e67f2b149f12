"""Incremental jobs on Structured Streaming (STM-01 to STM-06)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

PRICES = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("station_id", T.StringType()), T.StructField("grid_id", T.StringType()), T.StructField("price", T.DoubleType()), T.StructField("seq", T.LongType())])


def price_stream(spark: SparkSession, folder: str, schema: T.StructType = PRICES, files_a_batch: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(folder)


def without_redeliveries(stream: DataFrame, delay: str = "7 days", keys: tuple[str, ...] = ("station_id", "ts")) -> DataFrame:
    """STM-06: a row for each key within the watermark, however often it is delivered."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(list(keys))


def daily_grid(stream: DataFrame, delay: str = "7 days") -> DataFrame:
    """STM-04: the price, deviation and stations of each grid and day, out when the watermark has passed the day."""
    return stream.withWatermark("ts", delay).groupBy(F.window("ts", "1 day"), "grid_id").agg(F.avg("price").alias("price"), F.count("*").alias("n")).select(F.to_date("window.start").alias("date"), "grid_id", "price", "n")


def append_daily(spark: SparkSession, folder: str, schema: T.StructType, out: str, checkpoint: str, delay: str = "7 days") -> dict[str, int]:
    """STM-04 as a job: what ``folder`` holds since the last call, by ``daily_grid`` in append mode, into ``out`` (a folder for each batch).

    A day is written once, when the watermark has passed it; what comes later for it is dropped, and only days that are still open are kept
    as state. Returns rows_dropped (partial sums too late for their day) and state_rows after the last batch.
    """
    stream = daily_grid(price_stream(spark, folder, schema), delay)
    write = lambda batch, k: batch.write.mode("overwrite").parquet(f"{out}/batch={k}")
    q = stream.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    states = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
    return {"rows_dropped": sum(x["numRowsDroppedByWatermark"] for x in states), "state_rows": states[-1]["numRowsTotal"] if states else 0}


def _table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("day", T.DateType())])).parquet(path)


def _stored_days(spark: SparkSession, path: str) -> dict:
    """The state's day folders by date, from their names alone."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return {}
    names = [f.getPath() for f in fs.listStatus(folder) if f.isDirectory() and f.getPath().getName().startswith("day=")]
    return {dt.date.fromisoformat(n.getName()[4:]): n for n in names}


def evict(spark: SparkSession, path: str, days: int) -> None:
    """Delete the day folders that lie ``days`` days or more before the newest."""
    stored = _stored_days(spark, path)
    for day, folder in stored.items():
        if day <= max(stored) - dt.timedelta(days):
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def keep_last_state(stream: DataFrame, path: str, checkpoint: str, days: int = 45, backfill_days: int = 7, keys: tuple[str, ...] = ("date", "grid_id"), order: str = "seq", skip_without_gain: bool = False) -> StreamingQuery:
    """STM-01, STM-02, STM-03: a rolling table of the last ``days`` days in a folder for each day, the row with the highest ``order`` winning.

    ``stream`` has date, the keys, ``order`` and values. Rows more than ``backfill_days`` older than
    the newest stored date are late and go, and so do rows ``days`` days older than the newest of their batch. A batch that adds no date and no key to any date is skipped if asked; corrections then go, too. Only
    the dates that a batch touches are read and written anew, so a batch that runs again writes the same rows; then old folders are deleted. The newest date comes from the
    folders' names, so neither storage nor work grows with the stream's age.
    """
    from fairgrid.operators.frames import last_per_key

    schema = T.StructType([f for f in stream.schema if f.name != "__new"])

    def upsert(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stored = _stored_days(spark, path)
        fresh = batch.where(F.col("date") > F.lit(max(stored) - dt.timedelta(backfill_days))) if stored else batch
        newest = fresh.agg(F.max("date")).first()[0]
        if newest is None:
            return
        fresh = fresh.where(F.col("date") > F.lit(max([newest, *stored]) - dt.timedelta(days)))
        touched = [r.date for r in fresh.select("date").distinct().collect()]  # at most ``days`` dates
        old = _table(spark, path, schema) if stored else spark.createDataFrame([], schema)
        old = (old.where(F.col("day").isin(touched)) if stored else old).select(*schema.names)
        if skip_without_gain:
            before = old.select(*keys)
            if fresh.select(*keys).distinct().join(before, list(keys), "left_anti").isEmpty():
                return
        both = old.withColumn("__new", F.lit(0)).unionByName(fresh.withColumn("__new", F.lit(1)))
        merged = last_per_key(both, list(keys), [F.col(order), F.col("__new")]).drop("__new")
        merged.withColumn("day", F.col("date")).repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
        evict(spark, path, days)

    return stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_state(spark: SparkSession, path: str, days: int = 45) -> DataFrame:
    """The rolling state: the last ``days`` days of what ``keep_last_state`` stored."""
    t = spark.read.parquet(path).drop("day")
    return t.crossJoin(F.broadcast(t.agg(F.max("date").alias("top")))).where(F.col("date") > F.date_sub("top", days)).drop("top")


#: Rows of a grid whose mean price tomorrow's is drawn to.
PULL_ROWS = 7


def next_day_features(state: DataFrame) -> DataFrame:
    """(date, grid_id, price, gap, delta): the price less the mean of the grid's last PULL_ROWS stored rows, and the change to the next day where that is stored."""
    w = Window.partitionBy("grid_id").orderBy("date")
    gap = F.col("price") - F.avg("price").over(w.rowsBetween(1 - PULL_ROWS, 0))
    delta = F.when(F.lead("date").over(w) == F.date_add("date", 1), F.lead("price").over(w) - F.col("price"))
    return state.select("date", "grid_id", "price", gap.alias("gap"), delta.alias("delta"))


def fit_next_day(state: DataFrame, path: str) -> None:
    """STM-05: learn the next day's change from the rolling state and keep the model at ``path``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    learn = next_day_features(state).where("delta is not null and gap is not null")
    steps = [VectorAssembler(inputCols=["gap"], outputCol="features"), LinearRegression(labelCol="delta", solver="normal")]
    Pipeline(stages=steps).fit(learn).write().overwrite().save(path)


def target_dates(state: DataFrame, published: DataFrame, ratio: float = 0.8) -> DataFrame:
    """STM-05: one row: start and last of the dates to predict, from the day after the last published one up to the day after the last complete one.

    A day is complete with at least ``ratio`` of the median row count of the last 14 days. Where nothing is published, or more than
    is safe, only the last date is predicted again.
    """
    from fairgrid.operators.aggregates import completeness_gate

    gate = completeness_gate(state.groupBy("date").agg(F.count("*").alias("n")), "date", ratio)
    safe = gate.where("usable").agg(F.date_add(F.max("date"), 1).alias("last"))
    both = safe.crossJoin(published.agg(F.max("date").alias("published")))  # a row each
    return both.select(F.when(F.col("published") <= F.col("last"), F.date_add("published", 1)).otherwise(F.col("last")).alias("start"), "last")


def next_day_prediction(state: DataFrame, published: DataFrame, model_path: str, ratio: float = 0.8) -> DataFrame:
    """STM-05: (date, grid_id, prediction) for every target date, each from the complete day before it by the stored model; published days stay untouched."""
    from pyspark.ml import PipelineModel

    from fairgrid.operators.aggregates import completeness_gate

    usable = completeness_gate(state.groupBy("date").agg(F.count("*").alias("n")), "date", ratio).where("usable").select("date")
    rows = next_day_features(state).join(F.broadcast(usable), "date").crossJoin(F.broadcast(target_dates(state, published, ratio)))
    rows = rows.where(F.date_add("date", 1).between(F.col("start"), F.col("last")) & F.col("gap").isNotNull())
    told = PipelineModel.load(model_path).transform(rows)
    return told.select(F.date_add("date", 1).alias("date"), "grid_id", (F.col("price") + F.col("prediction")).alias("prediction"))
