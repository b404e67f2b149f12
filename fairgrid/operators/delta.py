"""Next-day models of price changes: two kinds fitted, chosen on a holdout, stored, and applied month by month (ML-11, ML-12)."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairgrid.operators import learners

#: Fixed sizes of the boosted model: at most so many trees of such a depth; fewer if the stopping rows' error no longer falls.
TREES, DEPTH, STEP = 12, 4, 0.2


#: Rows before a row that it looks at, and rows of a series in one stored piece.
STEPS, PIECE = 28, 256


def series_pieces(df: DataFrame, keys: list[str], order: str, values: list[str], static: list) -> DataFrame:
    """(keys, static, days, months): each key's series in pieces of ``PIECE`` rows, each piece with the ``STEPS`` rows before it.

    ``days`` has (order, values) in order, ``months`` the months of the piece's rows that have so many before them. A row is stored about
    once, not once for each row that looks at it; ``piece_blocks`` makes the rows to learn from out of it. A series, a row a day, is put
    together once, by one aggregate.
    """
    whole = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(order, *values))).alias("__days"), *[F.first(c).alias(c) for c in static])
    n = F.size("__days")
    told = whole.where(n > STEPS).withColumn("__piece", F.explode(F.sequence(F.lit(0), F.floor((n - 1) / PIECE).cast("int"))))
    start = F.greatest(F.col("__piece") * PIECE - STEPS, F.lit(0))
    days = F.slice("__days", start + 1, (F.col("__piece") + 1) * PIECE - start)
    out = told.select(*keys, days.alias("days"), *static).where(F.size("days") > STEPS)
    firsts = F.array_distinct(F.transform(F.slice("days", STEPS + 1, F.size("days")), lambda x: F.trunc(x[order], "MM")))
    months = F.transform(firsts, lambda x: F.date_format(x, "yyyy-MM"))
    return out.withColumn("months", months)


def piece_blocks(batch, months: list[str] | None = None, days: tuple[int, int] | None = None, size: int = 2048) -> Iterator[tuple]:
    """(piece, d, y, y_lag1, weight, raw) of a batch's rows with ``STEPS`` rows before them, or of those of some months or between two days
    (since 1970, the second excluded), in blocks; ``raw`` is features by rows.

    A batch has ``static`` (array) and ``days`` (d, y, national, weight). ``raw``: the rows before in three channels (own and national level from
    yesterday's own, weight), distance from the national level, weight, days since and the mean of the rows before, and ``static``.
    """
    import numpy as np
    import pyarrow as pa

    lists, static = batch.column("days"), batch.column("static")
    flat, count = lists.flatten(), lists.value_lengths().to_numpy(zero_copy_only=False)
    if not len(flat):
        return
    d = flat.field("d").cast(pa.int32()).to_numpy(zero_copy_only=False)
    y, national, weight = (flat.field(c).to_numpy(zero_copy_only=False).astype(float) for c in ("y", "national", "weight"))
    fixed = static.flatten().to_numpy(zero_copy_only=False).reshape(len(static), -1).T
    row = np.repeat(np.arange(len(count)), count)
    at = np.flatnonzero(np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) >= STEPS)
    if months is not None:
        at = at[np.isin(d[at].astype("datetime64[D]").astype("datetime64[M]"), np.array(months, "datetime64[M]"))]
    if days is not None:
        at = at[(d[at] >= days[0]) & (d[at] < days[1])]
    for k in range(0, len(at), size):
        i = at[k : k + size]
        raw, last, mean = np.empty((3 * STEPS + 4 + len(fixed), len(i))), y[i - 1], np.zeros(len(i))
        for j in range(STEPS):
            before = i - STEPS + j
            own = y[before]
            mean += own
            raw[3 * j], raw[3 * j + 1], raw[3 * j + 2] = own - last, national[before] - last, weight[before]
        raw[3 * STEPS], raw[3 * STEPS + 1], raw[3 * STEPS + 2], raw[3 * STEPS + 3] = last - national[i - 1], weight[i - 1], d[i] - d[i - 1], mean / STEPS - last
        raw[3 * STEPS + 4 :] = fixed[:, row[i]]
        yield row[i], d[i], y[i], last, weight[i], raw


def sequence_rows(pieces: DataFrame, keys: list[str], months: list[str] | None = None) -> DataFrame:
    """(keys, d, month, y, y_lag1, weight, delta, raw) of each row of ``pieces`` (keys, static, days) that ``piece_blocks`` makes."""
    from pyspark.ml.functions import array_to_vector

    schema = ", ".join(f"{k} {pieces.schema[k].dataType.simpleString()}" for k in keys) + ", d date, month string, y double, y_lag1 double, weight double, delta double, raw array<double>"

    def expand(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for row, d, y, last, weight, raw in piece_blocks(batch, months):
                offsets = pa.array(np.arange(len(row) + 1, dtype="int32") * len(raw))
                out = [*_told(batch, keys, row, d), *map(pa.array, (y, last, weight, y - last)), pa.ListArray.from_arrays(offsets, pa.array(raw.T.ravel()))]
                yield pa.RecordBatch.from_arrays(out, [*keys, "d", "month", "y", "y_lag1", "weight", "delta", "raw"])

    return pieces.select(*keys, "static", "days").mapInArrow(expand, schema).withColumn("raw", array_to_vector("raw"))


def _told(batch, keys: list[str], row, d) -> list:
    """Arrow columns: the keys, day and month of some rows of a batch."""
    import numpy as np
    import pyarrow as pa

    names, code = np.unique(d.astype("datetime64[D]").astype("datetime64[M]"), return_inverse=True)
    month = pa.DictionaryArray.from_arrays(pa.array(code.astype("int32")), pa.array(names.astype(str))).cast(pa.string())
    return [*(batch.column(c).take(pa.array(row)) for c in keys), pa.array(d).cast(pa.date32()), month]


def piece_scores(pieces: DataFrame, keys: list[str], months: list[str], model) -> DataFrame:
    """(keys, d, month, prediction) of the rows of some months: features are made and scored by a stored ``DeltaModel`` in the same task."""
    told = model.model()
    schema = ", ".join(f"{k} {pieces.schema[k].dataType.simpleString()}" for k in keys) + ", d date, month string, prediction double"

    def score(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for row, d, _, last, _, raw in piece_blocks(batch, months):
                yield pa.RecordBatch.from_arrays([*_told(batch, keys, row, d), pa.array(last + learners.predicted(told, raw))], [*keys, "d", "month", "prediction"])

    return pieces.select(*keys, "static", "days").mapInArrow(score, schema)


def piece_parts(batch, wanted: tuple[int, int], stop: date, holdout: date) -> Iterator[tuple]:
    """Blocks of a batch of pieces for the learners: rows before ``stop`` teach, those before ``holdout`` stop the fit, the others are held out."""
    ends = [-(2**31), *((x - date(1970, 1, 1)).days for x in (stop, holdout)), 2**31]
    for _, d, y, last, weight, raw in piece_blocks(batch, days=(ends[wanted[0]], ends[wanted[1] + 1])):
        yield (d >= ends[1]).astype("int8") + (d >= ends[2]), y - last, y, last, weight, raw


def row_parts(batch, wanted: tuple[int, int]) -> Iterator[tuple]:
    """Blocks of a batch of rows (part, delta, y, y_lag1, weight and raw as an array) for the learners."""
    import numpy as np

    if batch.num_rows:
        part = np.array([("train", "stop", "holdout").index(x) for x in batch.column("part").to_pylist()], "int8")
        some = (part >= wanted[0]) & (part <= wanted[1])
        columns = [batch.column(c).to_numpy(zero_copy_only=False).astype(float)[some] for c in ("delta", "y", "y_lag1", "weight")]
        raw = batch.column("raw").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        yield part[some], *columns, np.ascontiguousarray(raw[some].T)


def spread(pieces: DataFrame, rows_each: int = 50_000) -> DataFrame:
    """``pieces`` dealt to tasks of so many rows each, since they are small until they are expanded."""
    rows = pieces.agg(F.sum(F.size("days"))).first()[0] or 0
    return pieces.repartition(max(1, -(-rows // rows_each)))


def fit_delta_models(rows: DataFrame, path: str, parts: Callable | None = None) -> list[tuple]:
    """ML-11: a robust linear and a boosted-tree model of ``delta``; that with the smaller weighted error on the holdout is stored at ``path``.

    ``rows``: delta, y (the level), y_lag1 (the level before), weight, raw (features) and part (train, stop or holdout), or anything of
    which ``parts`` makes blocks of these, as ``piece_parts``. Both learn from the rows of train; the trees stop when the error on the rows of
    stop no longer falls; neither sees the holdout. Returns model, rows, mae, rmse, weighted_mae, chosen for each kind; of equal errors the
    linear model is chosen. No row to learn from is stored but as the trees' bins; Spark ML's own learners keep 92 doubles or ints of each.
    """
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array

    if parts is None:
        rows, parts = rows.select("part", "delta", "y", "y_lag1", "weight", vector_to_array("raw").alias("raw")), row_parts
    held = learners.packed(rows).persist()
    try:
        mean, inverse, label = learners.spread_of(held, parts)
        linear = learners.robust_linear(held, parts, mean, inverse, label)
        bin_of = learners.bins_of(held, parts, mean, inverse)
    finally:
        held.unpersist()
    fitted = {"robust linear": linear, "boosted trees": learners.boosted_trees(rows, parts, mean, inverse, bin_of, TREES, DEPTH, STEP)}
    told = [(name, *e) for name, e in zip(fitted, learners.errors(rows, parts, list(fitted.values())), strict=True)]
    best = min(told, key=lambda t: t[4])[0]
    PipelineModel([learners.DeltaModel(json.dumps(fitted[best]))]).write().overwrite().save(path)
    return [(*t, t[0] == best) for t in told]


def folders(spark: SparkSession, path: str, name: str) -> set[str]:
    """The values of the partition folders ``name=...`` below a path, from their names alone."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return set()
    return {n[len(name) + 1 :] for f in fs.listStatus(folder) if f.isDirectory() and (n := f.getPath().getName()).startswith(f"{name}=")}


def score_months(frame: DataFrame, model_path: str, out: str, keep: list[str], again: tuple[str, ...] = (), at_once: int = 12, scores_of: Callable | None = None) -> list[str]:
    """ML-12: predictions of every row of ``frame`` (month as yyyy-MM, y_lag1, raw and the columns ``keep``) by a stored model, a folder for each month of ``out``.

    Months that have a folder are left alone, unless named in ``again``, so a run that was stopped goes on where it was; ``at_once`` months are one
    job, whose folders appear when it ends and replace what was there. Returns the months that were scored. ``frame`` is best stored by month,
    or in pieces with an array ``months``, of which ``scores_of(pieces, months, model)`` makes the predictions of some months.
    """
    from pyspark.ml import PipelineModel

    spark, model = frame.sparkSession, PipelineModel.load(model_path)
    there = folders(spark, out, "month") - set(again)
    known = frame.select("month") if scores_of is None else frame.select(F.explode("months").alias("month"))
    months = sorted({r.month for r in known.distinct().collect()} - there)  # a row a month
    for i in range(0, len(months), at_once):
        part = months[i : i + at_once]
        if scores_of is None:
            told = model.transform(frame.where(F.col("month").isin(part))).select(*keep, (F.col("y_lag1") + F.col("prediction")).alias("prediction"), "month")
        else:
            told = scores_of(frame.where(F.arrays_overlap("months", F.array(*map(F.lit, part)))), part, model).select(*keep, "prediction", "month")
        told.repartition("month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("month").parquet(out)
    return months
