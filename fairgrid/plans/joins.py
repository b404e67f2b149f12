"""Queries of the joins (JOIN-01 to JOIN-21, GEO-03, GEO-04)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fairgrid.functions.dates import saturday_week
from fairgrid.operators import aggregates as agg
from fairgrid.operators import frames, joins

from fairgrid.functions.numbers import half_up

from .registry import query
from .tables import DOM_SQL, GRID_SQL, INTL_SQL, OBS_SQL, POLICY_SQL, STATION_SQL, domestic, grid_day, international, observations, policies, read, stations

_EVENT_SQL = "ev as (select user_id, event_type, cast(ts as date) d, arg_max(value, ts) v from events group by all)"


@query(f"""with {OBS_SQL}, {DOM_SQL}, {INTL_SQL}, s as (select d from dom union select d from intl), o as (select d, fuel, avg(price) p from obs group by all)
select s.d, round(x, 3) x, round(y, 3) y, round(g.p, 3) gasoline, round(i.p, 3) diesel from s left join dom using (d) left join intl using (d) left join o g on g.d = s.d and g.fuel = 'gasoline' left join o i on i.d = s.d and i.fuel = 'diesel'""")
def join_01_daily_chain(spark, sf):
    dom, intl = domestic(spark, sf), international(spark, sf)
    o = observations(spark, sf).groupBy("d").agg(F.avg(F.when(F.col("fuel") == "gasoline", F.col("price"))).alias("gasoline"), F.avg(F.when(F.col("fuel") == "diesel", F.col("price"))).alias("diesel"))
    spine = dom.select("d").union(intl.select("d")).distinct()
    return frames.rounded(spine.join(dom.select("d", "x"), "d", "left").join(intl, "d", "left").join(o, "d", "left"))


@query(f"with {DOM_SQL}, {INTL_SQL}, m as (select least((select max(d) from dom), (select max(d) from intl)) - 30 top) select dom.d, round(x, 3) x, round(y, 3) y from dom join intl using (d), m where d <= top")
def join_02_common_range(spark, sf):
    dom, intl = domestic(spark, sf).select("d", "x"), international(spark, sf)
    top = dom.agg(F.max("d").alias("a")).crossJoin(intl.agg(F.max("d").alias("b"))).select(F.date_sub(F.least("a", "b"), 30).alias("top"))
    return frames.rounded(dom.join(intl, "d").crossJoin(F.broadcast(top)).where("d <= top").drop("top"))


@query(f"with {GRID_SQL} select d, grid_id, round(a.price, 3) gasoline, round(b.price, 3) diesel from (select * from grid where fuel = 'gasoline') a full join (select * from grid where fuel = 'diesel') b using (d, grid_id)")
def join_03_full_outer_fuels(spark, sf):
    g = grid_day(spark, sf)
    part = lambda f: g.where(F.col("fuel") == f).select("d", "grid_id", half_up("price", 3).alias(f))
    return part("gasoline").join(part("diesel"), ["d", "grid_id"], "full")


@query(f"""with {GRID_SQL}, {DOM_SQL}, a as (select d, fuel, sum(price * n) / sum(n) anchor from grid group by all)
select g.d, g.fuel, grid_id, round(price - anchor, 3) spread, round(x, 3) fair from grid g left join a using (d, fuel) left join dom using (d)""")
def join_04_grid_anchor_fair(spark, sf):
    day = Window.partitionBy("d", "fuel")
    ok = (F.col("price") > 0) & (F.col("n") > 0)
    anchor = F.sum(F.when(ok, F.col("price") * F.col("n"))).over(day) / F.nullif(F.sum(F.when(ok, F.col("n"))).over(day), F.lit(0.0))
    g = grid_day(spark, sf).withColumn("spread", F.col("price") - anchor)
    return g.join(domestic(spark, sf).select("d", "x"), "d", "left").select("d", "fuel", "grid_id", half_up("spread", 3).alias("spread"), half_up("x", 3).alias("fair"))


@query(f"""with {GRID_SQL}, {STATION_SQL}, c as (select cell_x, cell_y, count(*) stations, min(region) region from station group by all)
select d, fuel, grid_id, round(price, 3) price, stations, region from grid left join c using (cell_x, cell_y)""")
def join_05_panel_static(spark, sf):
    c = stations(spark, sf).groupBy("cell_x", "cell_y").agg(F.count("*").alias("stations"), F.min("region").alias("region"))
    return grid_day(spark, sf).join(c, ["cell_x", "cell_y"], "left").select("d", "fuel", "grid_id", half_up("price", 3).alias("price"), "stations", "region")


@query(f"with {GRID_SQL} select t.d, t.fuel, t.grid_id, round(t.price - f.price, 3) delta from grid t join grid f on t.fuel = f.fuel and t.grid_id = f.grid_id and f.d = t.d - 1")
def join_06_feature_day_before(spark, sf):
    w = Window.partitionBy("fuel", "grid_id").orderBy("d")
    g = grid_day(spark, sf).withColumns({"day_before": F.lag("d").over(w), "before": F.lag("price").over(w)})
    return g.where(F.date_sub("d", 1) == F.col("day_before")).select("d", "fuel", "grid_id", half_up(F.col("price") - F.col("before"), 3).alias("delta"))


@query(f"""with {_EVENT_SQL}, f as (select user_id, cast(ts as date) d, event_id from events where event_type = 'purchase'), e as (select user_id, d, v from ev where event_type = 'view')
select f.event_id, f.user_id, f.d, e.v attribute, e.d effective from f asof left join e on f.user_id = e.user_id and f.d >= e.d""")
def join_07_as_of_attributes(spark, sf):
    e = read(spark, sf, "events").withColumn("d", F.to_date("ts"))
    facts = e.where("event_type = 'purchase'").select("event_id", "user_id", "d")
    attributes = e.where("event_type = 'view'").groupBy("user_id", "d").agg(F.max_by("value", "ts").alias("attribute"))
    return joins.as_of_join(facts, attributes, ["user_id"], "d", "d", ["attribute"], keep_date="effective")


@query(f"""with {DOM_SQL}, {INTL_SQL}, t as (select d, y from intl where day(d) = 1)
select dom.d, round(y, 3) tax, t.d effective from dom asof left join t on dom.d >= t.d""")
def join_07b_as_of_calendar(spark, sf):
    """One national series: a constant key puts it in one task, a row for each day."""
    days = domestic(spark, sf).select("d").withColumn("series", F.lit("national"))
    tax = international(spark, sf).where("day(d) = 1").select(F.lit("national").alias("series"), "d", half_up("y", 3).alias("tax"))
    return joins.as_of_join(days, tax, ["series"], "d", "d", ["tax"], keep_date="effective").drop("series")


_OVERLAY_SQL = """o as (select d, max(case when category = 0 then name end) tax_name, max(case when category = 0 then rate end) tax_rate, max(case when category = 1 then name end) cap_name, max(case when category = 1 then rate end) cap_rate from
 (select dom.d, category, name, rate, row_number() over (partition by dom.d, category order by start desc, "end" desc, name desc) rn from dom join policies p on p.fuel = 'gasoline' and dom.d between start and "end") where rn = 1 group by d)"""


@query(f"with {DOM_SQL}, {POLICY_SQL}, {_OVERLAY_SQL} select dom.d, tax_name, tax_rate, cap_name, cap_rate from dom left join o using (d)")
def join_08_policy_overlay(spark, sf):
    return joins.overlay(domestic(spark, sf).select("d"), "d", policies(spark).where("fuel = 'gasoline'"), {0: "tax", 1: "cap"})


@query(f"""with {DOM_SQL}, {POLICY_SQL}, w as (select distinct cast(d + cast(6 - dayofweek(d) as int) as date) week_end from dom)
select week_end, name from w join policies p on p.start <= week_end and p."end" >= week_end - 6""")
def join_09_week_overlap(spark, sf):
    weeks = domestic(spark, sf).select(saturday_week(F.col("d")).alias("week_end")).distinct().withColumn("week_start", F.date_sub("week_end", 6))
    return joins.overlap_join(weeks, "week_start", "week_end", policies(spark)).select("week_end", "name")


@query(f"""with {OBS_SQL}, s as (select station_id, cast(date_trunc('year', d) as date) snapshot_date, avg(price) v from obs where fuel = 'diesel' and year(d) % 2 = 0 group by all),
f as (select distinct station_id, d from obs), a as (select f.station_id, f.d, s.v, s.snapshot_date from f asof left join s on f.station_id = s.station_id and f.d >= s.snapshot_date),
b as (select station_id, arg_min(v, snapshot_date) v, min(snapshot_date) snapshot_date from s group by 1)
select a.station_id, a.d, round(coalesce(a.v, b.v), 3) value, coalesce(a.snapshot_date, b.snapshot_date) source_date from a left join b using (station_id)""")
def join_10_snapshot_lookup(spark, sf):
    o = observations(spark, sf)
    snapshots = o.where("fuel = 'diesel' and year(d) % 2 = 0").groupBy("station_id", F.trunc("d", "YEAR").alias("snapshot_date")).agg(F.avg("price").alias("value"))
    out = joins.snapshot_lookup(o.select("station_id", "d").distinct(), snapshots, "station_id", "d", fill_before_first=True)
    return out.select("station_id", "d", half_up("value", 3).alias("value"), "source_date")


@query(f"""with {GRID_SQL}, c as (select d, grid_id, cell_x x, cell_y y, sum(n) n from grid group by all)
select a.d, a.grid_id, round(coalesce(sum(b.n * exp(-sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) / 1000.0)), 0), 3) influence from c a left join c b on a.d = b.d and a.grid_id <> b.grid_id and (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 1500 * 1500 group by all""")
def join_11_daily_influence(spark, sf):
    """Station influence on each cell of every day, cell itself left out, pairs at the cut-off counted."""
    c = grid_day(spark, sf).groupBy("d", F.col("grid_id").alias("id"), F.col("cell_x").cast("double").alias("x"), F.col("cell_y").cast("double").alias("y")).agg(F.sum("n").alias("n"))
    out = joins.decay_sum(c.drop("n"), c.select("d", F.col("id").alias("id2"), F.col("x").alias("x2"), F.col("y").alias("y2"), "n"), 1500.0, 1000.0, F.col("n"), keys=["d"])
    return out.select("d", F.col("id").alias("grid_id"), half_up("influence", 3).alias("influence"))


@query(f"""with {STATION_SQL}, f as (select station_id, case when station_id % 3 = 0 then 'port' else 'depot' end kind, cell_x + 250.0 x, cell_y + 250.0 y from station), c as (select distinct cell_x, cell_y from station), k as (values ('port'), ('depot'))
select c.cell_x, c.cell_y, k.col0 kind, round(coalesce(sum(exp(-sqrt((c.cell_x - x) ** 2 + (c.cell_y - y) ** 2) / 1000.0)), 0), 3) influence from c cross join k left join f on f.kind = k.col0 and (c.cell_x - x) ** 2 + (c.cell_y - y) ** 2 <= 2000 * 2000 group by all""")
def join_12_facility_influence(spark, sf):
    s = stations(spark, sf)
    facilities = s.select(F.when(F.col("station_id") % 3 == 0, "port").otherwise("depot").alias("kind"), F.col("station_id").alias("id2"), (F.col("cell_x") + 250.0).alias("x2"), (F.col("cell_y") + 250.0).alias("y2"))
    cells = s.select(F.concat_ws("_", "cell_x", "cell_y").alias("id"), F.col("cell_x").cast("double").alias("x"), F.col("cell_y").cast("double").alias("y")).distinct()
    cells = cells.select("*", F.explode(F.array(F.lit("port"), F.lit("depot"))).alias("kind"))
    out = joins.decay_sum(cells, facilities, 2000.0, 1000.0, F.lit(1.0), keys=["kind"], exclude_self=False)
    at = F.split("id", "_")
    return out.select(at[0].cast("int").alias("cell_x"), at[1].cast("int").alias("cell_y"), "kind", half_up("influence", 3).alias("influence"))


#: Squares with a hole, an overlapping triangle; the first by ordinal wins.
_POLYGONS = [("west", 0, [[[-100.0, -100.0], [2100.0, -100.0], [2100.0, 3100.0], [-100.0, 3100.0]], [[900.0, 900.0], [900.0, 1600.0], [1600.0, 1600.0], [1600.0, 900.0]]]), ("all", 1, [[[-200.0, -200.0], [9000.0, -200.0], [-200.0, 9000.0]]])]
_EDGES = [(n, o, a, b) for n, o, rings in _POLYGONS for r in rings for a, b in zip(r, r[1:] + r[:1], strict=True) if a[1] != b[1]]
_EDGE_SQL = "edges(name, ordinal, x1, y1, x2, y2) as (values " + ", ".join(f"('{n}', {o}, {a[0]}::double, {a[1]}::double, {b[0]}::double, {b[1]}::double)" for n, o, a, b in _EDGES) + ")"
_IN_SQL = """hit as (select id, name, ordinal from p join edges on ((y1 > y) <> (y2 > y)) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1) group by all having count(*) % 2 = 1)"""


@query(f"with {STATION_SQL}, {_EDGE_SQL}, p as (select station_id id, cell_x + 250.0 x, cell_y + 250.0 y from station), {_IN_SQL} select id, arg_min(name, ordinal) as name from p left join hit using (id) group by 1")
def join_13_point_in_polygon(spark, sf):
    points = stations(spark, sf).select(F.col("station_id").alias("id"), (F.col("cell_x") + 250.0).alias("x"), (F.col("cell_y") + 250.0).alias("y"))
    polygons = spark.createDataFrame(_POLYGONS, "name string, ordinal int, rings array<array<array<double>>>")
    return joins.point_in_polygon(points, joins.polygon_edges(polygons), 500.0).select("id", "name")


@query(f"with {STATION_SQL}, land as (select distinct cell_x, cell_y from station where station_id % 4 <> 0) select station_id, cell_x, cell_y from station join land using (cell_x, cell_y)")
def join_14_station_on_land(spark, sf):
    s = stations(spark, sf)
    land = s.where("station_id % 4 <> 0").select("cell_x", "cell_y").distinct()
    return s.join(land, ["cell_x", "cell_y"]).select("station_id", "cell_x", "cell_y")


@query(f"""with {STATION_SQL}, t as (select a.station_id id, b.station_id id2, (a.cell_x - b.cell_x) ** 2 + (a.cell_y - b.cell_y) ** 2 d2 from station a join station b on a.region = b.region and a.station_id <> b.station_id)
select id, arg_min(id2, d2 * 1000000 + id2) id2, round(min(d2), 3) d2 from t group by 1""")
def join_15_nearest_in_region(spark, sf):
    s = stations(spark, sf)
    one = s.select(F.col("station_id").alias("id"), "region", F.col("cell_x").cast("double").alias("x"), F.col("cell_y").cast("double").alias("y"))
    two = s.select(F.col("station_id").alias("id2"), "region", F.col("cell_x").cast("double").alias("x2"), F.col("cell_y").cast("double").alias("y2"))
    return joins.nearest(one, two, ["region"], 500.0, exclude_self=True).select("id", "id2", half_up("d2", 3).alias("d2"))


@query(f"with {STATION_SQL}, land as (select distinct cell_x, cell_y from station where cell_x < 3000) select distinct cell_x, cell_y from station anti join land using (cell_x, cell_y)")
def join_16_patch_cells(spark, sf):
    cells = stations(spark, sf).select("cell_x", "cell_y").distinct()
    return cells.join(cells.where("cell_x < 3000"), ["cell_x", "cell_y"], "left_anti")


@query(f"with {OBS_SQL} select d, station_id, round(price, 3) price from obs where station_id in (select s_suppkey from supplier where s_acctbal > 5000)")
def join_17_known_ids(spark, sf):
    rich = read(spark, sf, "supplier").where("s_acctbal > 5000").select(F.col("s_suppkey").alias("station_id"))
    return observations(spark, sf).join(rich, "station_id", "left_semi").select("d", "station_id", half_up("price", 3).alias("price"))


@query(f"""with {DOM_SQL}, {INTL_SQL}, w as (select cast(d + cast(6 - dayofweek(d) as int) as date) week_end, avg(y) y from intl group by 1)
select d, round(x, 3) x, round(y, 3) weekly from dom left join w on w.week_end = cast(d + cast(6 - dayofweek(d) as int) as date)""")
def join_18_week_lookup(spark, sf):
    w = international(spark, sf).groupBy(saturday_week(F.col("d")).alias("week_end")).agg(half_up(F.avg("y"), 3).alias("weekly"))
    return domestic(spark, sf).withColumn("week_end", saturday_week(F.col("d"))).join(w, "week_end", "left").select("d", half_up("x", 3).alias("x"), "weekly")


@query(f"with {OBS_SQL} select d, station_id, fuel, round(price, 3) price from obs where d = (select max(d) from obs)")
def join_19_latest_date_rows(spark, sf):
    o = observations(spark, sf)
    return o.crossJoin(F.broadcast(o.agg(F.max("d").alias("top")))).where("d = top").select("d", "station_id", "fuel", half_up("price", 3).alias("price"))


@query(f"""with {GRID_SQL} select t.d + 1 target_date, t.fuel, t.grid_id, round(coalesce(n.price, t.price), 3) actual, case when n.price is null then 'feature_date' else 'target_date' end basis
from grid t left join grid n on n.fuel = t.fuel and n.grid_id = t.grid_id and n.d = t.d + 1""")
def join_20_actual_or_yesterday(spark, sf):
    w = Window.partitionBy("fuel", "grid_id").orderBy("d")
    g = grid_day(spark, sf).select("fuel", "grid_id", F.date_add("d", 1).alias("target_date"), F.col("price").alias("before"), F.lead("d").over(w).alias("next"), F.lead("price").over(w).alias("after"))
    now = F.when(F.col("next") == F.col("target_date"), F.col("after"))  # the next row, if it is of the next day
    return g.select("target_date", "fuel", "grid_id", half_up(F.coalesce(now, "before"), 3).alias("actual"), F.when(now.isNull(), "feature_date").otherwise("target_date").alias("basis"))


@query("""with p as (select event_id, user_id, ts, case when event_type = 'view' then value end lon from events), v as (select user_id, arg_max(lon, ts) filled from p where lon is not null group by 1)
select event_id, user_id, coalesce(lon, filled) lon from p left join v using (user_id)""")
def join_21_fill_coordinates(spark, sf):
    p = read(spark, sf, "events").select("event_id", "user_id", "ts", F.when(F.col("event_type") == "view", F.col("value")).alias("lon"))
    valid = p.where("lon is not null").groupBy("user_id").agg(F.max_by("lon", "ts").alias("filled"))
    return p.join(valid, "user_id", "left").select("event_id", "user_id", F.coalesce("lon", "filled").alias("lon"))


@query(f"""with {STATION_SQL}, {_EDGE_SQL}, c as (select distinct cell_x, cell_y from station), o(v) as (values (125.0), (375.0)), p as (select (cell_x + a.v) * 100000 + cell_y + b.v id, cell_x + a.v x, cell_y + b.v y from c, o a, o b), {_IN_SQL}
select cast(x as double) x, cast(y as double) y, arg_min(name, ordinal) as name from p join hit using (id) group by all""")
def geo_03_candidate_lattice(spark, sf):
    """Quarter-cell centres of the station cells that lie strictly inside a land polygon."""
    half = F.explode(F.array(F.lit(125.0), F.lit(375.0)))
    points = stations(spark, sf).select("cell_x", "cell_y").distinct().select("cell_x", "cell_y", half.alias("i")).select("*", half.alias("j")).select((F.col("cell_x") + F.col("i")).alias("x"), (F.col("cell_y") + F.col("j")).alias("y"))
    polygons = spark.createDataFrame(_POLYGONS, "name string, ordinal int, rings array<array<array<double>>>")
    return joins.point_in_polygon(points.withColumn("id", F.col("x") * 100000 + F.col("y")), joins.polygon_edges(polygons), 500.0).where("name is not null").select("x", "y", "name")


@query(f"""with recursive {STATION_SQL}, n as (select distinct cell_x, cell_y, cell_x::bigint * 10000000000 + cell_y id from station),
e as (select a.id a, b.id b from n a join n b on abs(a.cell_x - b.cell_x) <= 500 and abs(a.cell_y - b.cell_y) <= 500),
r(id, root) as (select id, id from n union select r.id, e.b from r join e on r.root = e.a), l as (select id, min(root) component from r group by 1), z as (select component, count(*) k from l group by 1)
select cell_x, cell_y, component, component = (select component from z order by k desc, component limit 1) mainland from n join l using (id)""")
def geo_04_mainland_cells(spark, sf):
    """Components of all cells that hold stations."""
    cells = stations(spark, sf).select("cell_x", "cell_y").distinct()
    return joins.neighbour_components(cells, 500)
