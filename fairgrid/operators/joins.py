"""Joins that Spark has no single operator for: as-of, overlay, distance, polygon, nearest (JOIN-*)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairgrid.operators.stored import cut


def as_of_join(facts: DataFrame, events: DataFrame, keys: list[str], fact_date: str, event_date: str, values: list[str], keep_date: str | None = None) -> DataFrame:
    """JOIN-07: each fact with the latest event of its key on or before its date (an event of the same day counts).

    Facts and events meet in one shuffle on the keys and one sort. Events of equal
    key and date: the caller leaves one. Facts before any event get nulls.
    """
    event = F.struct(F.col(event_date).alias("__d"), *values)
    left = facts.withColumn("__at", F.col(fact_date)).withColumn("__side", F.lit(1)).withColumn("__event", F.lit(None).cast(events.select(event.alias("e")).schema["e"].dataType))
    right = events.select(*keys, F.col(event_date).alias("__at"), F.lit(0).alias("__side"), event.alias("__event"))
    w = Window.partitionBy(*keys).orderBy("__at", "__side").rowsBetween(Window.unboundedPreceding, 0)
    met = left.unionByName(right, allowMissingColumns=True).withColumn("__event", F.last("__event", ignorenulls=True).over(w)).where("__side = 1")
    extra = [F.col("__event.__d").alias(keep_date)] if keep_date else []
    return met.select(*facts.columns, *[F.col(f"__event.{v}").alias(v) for v in values], *extra)


def overlay(days: DataFrame, date: str, policies: DataFrame, categories: dict[int, str], lag_days: int = 0) -> DataFrame:
    """JOIN-08: days with the name and rate of the policy in force, a pair of columns for each category.

    ``policies``: name, start, end, fuel, rate, category. Of several that hold, the last by (start, end) wins.
    Policies are exploded to the days they hold, so that the join is an equi-join; days are distinct.
    """
    held = policies.where("start is not null and `end` is not null and `end` >= start").select("name", "rate", "category", "start", "end", F.explode(F.sequence(F.date_add("start", lag_days), F.date_add("end", lag_days))).alias(date))
    best = held.groupBy(date, "category").agg(F.max_by(F.struct("name", "rate"), F.struct("start", "end", "name")).alias("p"))
    wide = best.groupBy(date).agg(*[F.max(F.when(F.col("category") == k, F.col(f"p.{f}"))).alias(f"{label}_{f}") for k, label in categories.items() for f in ("name", "rate")])
    return days.join(wide, date, "left")


def overlap_join(weeks: DataFrame, start: str, end: str, policies: DataFrame) -> DataFrame:
    """JOIN-09: every (week, policy) that share a day, by equi-joining on months."""
    months = lambda a, b: F.explode(F.sequence(F.trunc(a, "MM"), b, F.expr("interval 1 month"))).alias("__m")
    one = weeks.select("*", months(start, end))
    two = policies.select(F.col("name"), F.col("start").alias("__ps"), F.col("end").alias("__pe"), months("start", "end"))
    met = one.join(two, "__m").where((F.col("__ps") <= F.col(end)) & (F.col("__pe") >= F.col(start)))
    return met.select(*weeks.columns, "name", F.col("__ps").alias("policy_start"), F.col("__pe").alias("policy_end")).distinct()


#: A bucket of a distance join is so many cut-offs wide: wider ones copy fewer points over their edges and pair more within.
_WIDTH = 3


def _near_buckets(points: DataFrame, others: DataFrame, cutoff: float) -> tuple[DataFrame, DataFrame]:
    """Both sides with buckets (__bx, __by): a point's own, and for each other point all those that its cut-off reaches."""
    size = _WIDTH * cutoff
    # a little more than the cut-off, so that rounding at a bucket's edge loses no pair
    reach = lambda c: F.explode(F.sequence(F.floor((F.col(c) - cutoff * (1 + 1e-9)) / size), F.floor((F.col(c) + cutoff * (1 + 1e-9)) / size)))
    one = points.withColumn("__bx", F.floor(F.col("x") / size)).withColumn("__by", F.floor(F.col("y") / size))
    return one, others.withColumn("__bx", reach("x2")).withColumn("__by", reach("y2"))


def _square() -> Column:
    return F.pow(F.col("x") - F.col("x2"), 2) + F.pow(F.col("y") - F.col("y2"), 2)


def distance_pairs(points: DataFrame, others: DataFrame, cutoff: float, keys: list[str] | None = None) -> DataFrame:
    """Pairs of cell centres within ``cutoff`` metres, as an equi-join on square buckets.

    ``points`` (id, x, y, more) and ``others`` (id2, x2, y2, more); a pair at exactly the
    cut-off counts. A point stands in one bucket, the others in each that they reach.
    """
    one, two = _near_buckets(points, others, cutoff)
    return one.join(two, ["__bx", "__by", *(keys or [])]).where(_square() <= cutoff * cutoff).withColumn("distance", F.sqrt(_square())).drop("__bx", "__by")


def decay_sum(points: DataFrame, sources: DataFrame, cutoff: float, band: float, weight: Column, keys: list[str] | None = None, exclude_self: bool = True) -> DataFrame:
    """JOIN-11, JOIN-12: Σ weight · exp(−d / band) over sources within the cut-off; points without any get 0.

    An outer join keeps the points without a source, so that they need not be joined again."""
    keys = keys or []
    one, two = _near_buckets(points.select(*keys, "id", "x", "y"), sources.withColumns({f"__{k}": F.col(k) for k in keys}).withColumn("__w", weight).select(*[f"__{k}" for k in keys], "id2", "x2", "y2", "__w"), cutoff)
    two = two.withColumnsRenamed({"__bx": "__bx2", "__by": "__by2"})
    met = (F.col("__bx") == F.col("__bx2")) & (F.col("__by") == F.col("__by2")) & (_square() <= cutoff * cutoff)
    for k in keys:
        met = met & (F.col(k) == F.col(f"__{k}"))
    if exclude_self:
        met = met & (F.col("id") != F.col("id2"))
    return one.join(two, met, "left").groupBy(*keys, "id").agg(F.coalesce(F.sum(F.col("__w") * F.exp(-F.sqrt(_square()) / band)), F.lit(0.0)).alias("influence"))


def polygon_edges(polygons: DataFrame) -> DataFrame:
    """(name, ordinal, x1, y1, x2, y2) of polygons given as rings of [x, y] vertices; holes are rings like others."""
    ring = polygons.select("name", "ordinal", F.posexplode("rings").alias("ring", "v"))
    turn = ring.select("name", "ordinal", "ring", F.explode(F.arrays_zip("v", F.concat(F.slice("v", 2, F.greatest(F.size("v") - 1, F.lit(0))), F.slice("v", 1, 1)).alias("w"))).alias("e"))
    return turn.select("name", "ordinal", "ring", F.col("e.v")[0].alias("x1"), F.col("e.v")[1].alias("y1"), F.col("e.w")[0].alias("x2"), F.col("e.w")[1].alias("y2")).where("y1 <> y2")


def point_in_polygon(points: DataFrame, edges: DataFrame, stripe: float) -> DataFrame:
    """JOIN-13: points (id, x, y) with the first polygon (by ordinal) that holds them, by ray casting.

    Edges are cut into horizontal stripes, so that a point meets only the edges of its
    own stripe in an equi-join; an odd number of crossings to its right is inside, holes included. No polygon: null.
    """
    striped = edges.withColumn("__s", F.explode(F.sequence(F.floor(F.least("y1", "y2") / stripe), F.floor(F.greatest("y1", "y2") / stripe))))
    crossing = ((F.col("y1") > F.col("y")) != (F.col("y2") > F.col("y"))) & (F.col("x") < F.col("x1") + (F.col("y") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1")))
    met = points.withColumn("__s", F.floor(F.col("y") / stripe)).join(striped, "__s").where(crossing)
    inside = met.groupBy("id", "name", "ordinal").agg(F.count("*").alias("n")).where("n % 2 = 1")
    best = inside.groupBy("id").agg(F.min_by("name", "ordinal").alias("name"))
    return points.join(best, "id", "left")


def nearest(left: DataFrame, right: DataFrame, keys: list[str], start: float, exclude_self: bool = False) -> DataFrame:
    """JOIN-15: (id, id2, d2): for each left (id, x, y, keys) the right (id2, x2, y2, keys) at the least squared distance; the smaller id2 of equals.

    Points look around themselves within ``start`` metres, and those without a hit within twice
    as much, until all have one; each step is a distance join on buckets, so a region is never paired with itself. Of equal places only
    the two smallest ids are kept. With ``exclude_self`` a point is not its own neighbour. Points whose keys have no other point give no row.
    """
    place = Window.partitionBy(*keys, "x2", "y2").orderBy("id2")
    spots = cut(right.select("id2", "x2", "y2", *keys).withColumn("__n", F.row_number().over(place)).where("__n <= 2").drop("__n"))
    partners = spots.groupBy(*keys).agg((F.min("id2") != F.max("id2")).alias("__several"), F.min("id2").alias("__only"))
    lonely = ~F.col("__several") & (F.col("__only") == F.col("id")) if exclude_self else F.lit(False)
    todo = cut(left.select("id", "x", "y", *keys).join(partners, keys).where(~lonely).drop("__several", "__only"))
    box = left.select("x", "y").union(spots.select("x2", "y2")).agg((F.max("x") - F.min("x")).alias("w"), (F.max("y") - F.min("y")).alias("h")).first()
    extent = (box["w"] or 0.0) + (box["h"] or 0.0)
    found, reach = [], float(start)
    while not todo.isEmpty():
        pairs = distance_pairs(todo, spots, reach, keys)
        if exclude_self:
            pairs = pairs.where("id <> id2")
        d2 = F.pow(F.col("x") - F.col("x2"), 2) + F.pow(F.col("y") - F.col("y2"), 2)
        best = cut(pairs.withColumn("d2", d2).groupBy("id").agg(F.min(F.struct("d2", "id2")).alias("b")).select("id", "b.id2", "b.d2"))
        found.append(best)
        if reach > extent:
            break
        todo, reach = cut(todo.join(best, "id", "left_anti")), 2 * reach
    if not found:
        return left.select("id").join(right.select("id2"), F.lit(False)).withColumn("d2", F.lit(0.0))
    return reduce(DataFrame.unionByName, found)


def snapshot_lookup(facts: DataFrame, snapshots: DataFrame, key: str, date: str, fill_before_first: bool = False) -> DataFrame:
    """JOIN-10: the last non-null snapshot value on or before a date with its source date; before the first one optionally that."""
    clean = snapshots.where("value is not null")
    out = as_of_join(facts, clean, [key], date, "snapshot_date", ["value"], "source_date")
    if fill_before_first:
        first = clean.groupBy(key).agg(F.min_by(F.struct("value", "snapshot_date"), "snapshot_date").alias("__f"))
        out = out.join(first, key, "left").withColumn("value", F.coalesce("value", "__f.value")).withColumn("source_date", F.coalesce("source_date", "__f.snapshot_date")).drop("__f")
    return out


def neighbour_components(cells: DataFrame, size: int, max_rounds: int = 60) -> DataFrame:
    """GEO-04: (cell_x, cell_y, component, mainland): cells joined through any of eight neighbours; the largest component is the mainland.

    Labels are numbers of cells. Every round takes the least label of a cell and its
    neighbours, then the label of that label, so rounds grow with the logarithm of the
    land's extent; each round is written to the shared folder. Labels that do not settle stop the job.
    """
    ident = F.col("cell_x").cast("long") * 10_000_000_000 + F.col("cell_y")
    nodes = cells.select("cell_x", "cell_y").distinct().withColumn("id", ident)
    nodes = cut(nodes)
    step = F.explode(F.array(*[F.struct(F.lit(i * size).alias("dx"), F.lit(j * size).alias("dy")) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j])).alias("s")
    around = nodes.select(F.col("id").alias("a"), "cell_x", "cell_y", step).select("a", (F.col("cell_x") + F.col("s.dx")).alias("cell_x"), (F.col("cell_y") + F.col("s.dy")).alias("cell_y"))
    edges = cut(around.join(nodes.select("cell_x", "cell_y", F.col("id").alias("b")), ["cell_x", "cell_y"]).select("a", "b"))
    labels = nodes.select("id", F.col("id").alias("label"))
    for _ in range(max_rounds):
        near = edges.join(labels.withColumnRenamed("id", "b"), "b").select(F.col("a").alias("id"), "label")
        least = labels.union(near).groupBy("id").agg(F.min("label").alias("label"))
        far = labels.select(F.col("id").alias("label"), F.col("label").alias("far"))
        jumped = cut(least.join(far, "label", "left").select("id", F.least("label", F.coalesce("far", "label")).alias("label")))
        settled = jumped.join(labels.withColumnRenamed("label", "old"), "id").where("label <> old").isEmpty()
        labels = jumped
        if settled:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    sizes = labels.groupBy("label").count()
    top = sizes.agg(F.max_by("label", F.struct("count", -F.col("label"))).alias("top"))
    return nodes.join(labels, "id").crossJoin(F.broadcast(top)).select("cell_x", "cell_y", F.col("label").alias("component"), (F.col("label") == F.col("top")).alias("mainland"))
