"""Distances, grid cells and points of interest."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hearth.functions.order import grouped_quantiles
from hearth.sources.scratch import stored

EARTH_M = 6_371_000.0
#: Reviews that a place needs, and the place types of each dense group (fixed values).
MIN_REVIEWS = {"metro": 0, "salud": 150, "comercio": 200, "universidad": 150}
DENSE_GROUPS = {
    "educacion": ["school", "primary_school", "secondary_school", "preschool"],
    "parque": ["park", "city_park", "dog_park", "state_park", "national_park"],
    "supermercado": ["supermarket", "grocery_store"],
}
ANSWER = "array<struct<displayName: struct<text: string>, types: array<string>, location: struct<latitude: double, longitude: double>>>"


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    half = lambda d: F.sin(d / 2) * F.sin(d / 2)
    a = half(p2 - p1) + F.cos(p1) * F.cos(p2) * half(F.radians(lon2) - F.radians(lon1))
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def cell_key(lat: Column, lon: Column, decimals: int = 3) -> Column:
    """The grid cell of a point; null without coordinates."""
    part = lambda c: F.format_string(f"%.{decimals}f", F.bround(c, decimals) + F.lit(0.0))
    return F.when(lat.isNotNull() & lon.isNotNull(), F.concat(part(lat), F.lit(","), part(lon)))


def cells(df: DataFrame, decimals: int = 3) -> DataFrame:
    """One row for each cell: the mean point and the number of rows."""
    keyed = df.withColumn("cell", cell_key(F.col("lat"), F.col("lon"), decimals)).where("cell IS NOT NULL")
    return keyed.groupBy("cell").agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.count("*").alias("n"))


def grid(spark: SparkSession, box: tuple[float, float, float, float], n: int) -> DataFrame:
    """n x n points over (lat_lo, lat_hi, lon_lo, lon_hi), edges included."""
    lat0, lat1, lon0, lon1 = box
    axis = spark.range(n)
    step = lambda lo, hi: F.lit(lo) + F.col("id") * ((hi - lo) / max(1, n - 1))
    return axis.select(step(lat0, lat1).alias("lat")).crossJoin(axis.select(step(lon0, lon1).alias("lon")))


def build_catalogue(found: DataFrame, min_reviews: dict[str, int] = MIN_REVIEWS) -> DataFrame:
    """One row for each category and point (5 decimals): the most reviewed name; places with few reviews go."""
    least = F.create_map(*[F.lit(x) for p in min_reviews.items() for x in p])
    known = found.where(F.coalesce("resenas", F.lit(0)) >= F.coalesce(F.try_element_at(least, "categoria"), F.lit(0)))
    best = F.max(F.struct("resenas", (-F.col("poi_id")).alias("by_id"), "nombre", "lat", "lon")).alias("b")
    return known.groupBy("categoria", F.bround("lat", 5).alias("k1"), F.bround("lon", 5).alias("k2")).agg(best).select("categoria", "b.nombre", "b.lat", "b.lon", "b.resenas")


def tag_places(places: DataFrame, groups: dict[str, list[str]] = DENSE_GROUPS) -> DataFrame:
    """One row for each place and group that shares a type with it."""
    table = F.array(*[F.struct(F.lit(g).alias("g"), F.array(*[F.lit(t) for t in ts]).alias("ts")) for g, ts in groups.items()])
    hits = F.filter(table, lambda x: F.arrays_overlap("types", x["ts"]))
    return places.withColumn("categoria", F.explode(F.transform(hits, lambda x: x["g"])))


def summary(rows: DataFrame, radius: float) -> DataFrame:
    """(point, categoria, mas_cercano_m, nombre, n_1km) of rows (point, categoria, nombre, d); ties by name."""
    nearest_ = F.min(F.struct("d", "nombre")).alias("n")
    return rows.groupBy("point", "categoria").agg(nearest_, F.count_if(F.col("d") <= radius).alias("n_1km")).select("point", "categoria", F.bround("n.d", 0).cast("int").alias("mas_cercano_m"), "n.nombre", "n_1km")


#: Places that a cell holds before it is split, and how often a cell of the radius' size is halved at most.
CELL_PLACES, HALVINGS = 64, 6


def nearest(points: DataFrame, pois: DataFrame, radius: float = 1000.0, most: int = CELL_PLACES, halvings: int = HALVINGS) -> DataFrame:
    """Nearest place and number within the radius, for every point (point, lat, lon) and category, anywhere on the sphere; ties by name.

    Places lie in an octree over the unit ball: a cell with more than `most` places of a category is split (places of one spot count as one),
    to 2**-halvings of the radius. Counts at coarser levels tell at which size the surroundings of a point hold a place at all. Around the
    point the cells of that size give a bound on the nearest distance; cells beyond the bound and the radius are dropped, those wholly within the
    radius count as they are, and only places of the others are measured. Points and places without coordinates are passed over.
    """
    located = (F.col("lat") + F.col("lon")).isNotNull()
    reach = 2 * math.sin(min(radius / (2 * EARTH_M), math.pi / 2))  # a chord; so is every distance between cells
    top = max(1, math.ceil(math.log2(2.0 / reach)) + 1)
    lat, lon = F.radians("lat"), F.radians("lon")
    xyz = {"x": F.cos(lat) * F.cos(lon), "y": F.cos(lat) * F.sin(lon), "z": F.sin(lat)}
    fine = {f"f{c}": F.floor(F.col(c) / (reach / 2**halvings)) for c in "xyz"}
    cell = lambda level: [F.expr(f"shiftright(f{c}, {level} + {halvings})").alias(f"c{c}") for c in "xyz"]
    at = ["kind", "level", "cx", "cy", "cz"]
    kind = F.when(F.col("categoria").isNull(), "").otherwise(F.concat(F.lit("="), "categoria"))

    spots = pois.where(located).select(kind.alias("kind"), "nombre", "lat", "lon").groupBy("kind", "lat", "lon").agg(F.min("nombre").alias("nombre"), F.count("*").alias("n")).withColumns(xyz).withColumns(fine)
    levels = lambda lo, hi: F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("level")
    filled = spots.select("*", levels(-halvings, 0)).select("*", *cell("level"))
    full = filled.groupBy(*at).agg(F.count("*").alias("held"))
    whole = filled.join(full, at).where((F.col("held") <= most) | (F.col("level") == -halvings))
    leaf = F.max(F.struct("level", "cx", "cy", "cz")).alias("leaf")  # the largest cell that is not split
    placed = whole.groupBy("kind", "lat", "lon", "x", "y", "z", "fx", "fy", "fz", "nombre", "n").agg(leaf)
    box = [F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(f"b{c}") for c in "xyz"]
    leaves = placed.groupBy("kind", "leaf").agg(F.sum("n").alias("n"), *box, *[F.first(f"f{c}").alias(f"f{c}") for c in "xyz"])

    # at which level the 27 cells around a point's own hold a place
    around = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(k).alias("k")) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)])).alias("o")
    beside = lambda df: df.select("*", around).withColumns({"cx": F.col("cx") + F.col("o.i"), "cy": F.col("cy") + F.col("o.j"), "cz": F.col("cz") + F.col("o.k")}).drop("o")
    occupied = leaves.select("kind", "fx", "fy", "fz", levels(0, top)).select("kind", "level", *cell("level")).distinct()
    known = points.where(located).select("point", "lat", "lon").withColumns(xyz).withColumns(fine)
    blocks = known.select(*[F.expr(f"shiftright(f{c}, {halvings}) << {halvings}").alias(f"f{c}") for c in "xyz"]).distinct()
    seen = blocks.select("*", levels(0, top)).select("*", *cell("level")).join(beside(occupied).distinct(), ["level", "cx", "cy", "cz"])
    # a place lies within three cells of that level, so within one cell of the level after the next
    found = seen.groupBy("fx", "fy", "fz", "kind").agg(F.least(F.min("level") + 2, F.lit(top)).alias("level")).withColumnsRenamed({f"f{c}": f"k{c}" for c in "xyz"})
    same = [F.expr(f"shiftright(f{c}, {halvings}) << {halvings}") == F.col(f"k{c}") for c in "xyz"]
    asked = beside(known.join(found, same).drop("kx", "ky", "kz").select("*", *cell("level"))).drop("fx", "fy", "fz")
    reached = leaves.select("kind", "leaf", "n", "bx", "by", "bz", "fx", "fy", "fz", levels(0, top)).select("kind", "leaf", "n", "bx", "by", "bz", "level", *cell("level"))
    outer = lambda c: F.greatest(F.abs(F.col(c) - F.col(f"b{c}.lo")), F.abs(F.col(c) - F.col(f"b{c}.hi")))
    inner = lambda c: F.greatest(F.col(f"b{c}.lo") - F.col(c), F.col(c) - F.col(f"b{c}.hi"), F.lit(0.0))
    size = lambda f: F.sqrt(sum(f(c) * f(c) for c in "xyz"))
    met = asked.join(reached, at).select("point", "kind", "lat", "lon", "leaf", "n", size(inner).alias("least"), size(outer).alias("farthest"))
    slack = 1e-9
    bound = F.min("farthest").over(W.partitionBy("point", "kind"))
    near = met.withColumn("bound", bound).where((F.col("least") <= F.col("bound") * (1 + slack) + slack) | (F.col("least") <= reach * (1 + slack) + slack))
    inside = (F.col("farthest") <= reach * (1 - slack) - slack) & (F.col("least") > F.col("bound") * (1 + slack) + slack)
    counted = near.where(inside).select("point", "kind", F.lit(None).cast("struct<d:double,nombre:string>").alias("one"), "n")
    d = haversine_m(F.col("lat"), F.col("lon"), F.col("plat"), F.col("plon"))
    held = placed.select("kind", "leaf", "nombre", F.col("n").alias("k"), F.col("lat").alias("plat"), F.col("lon").alias("plon"))
    each = near.where(~inside).join(held, ["kind", "leaf"]).withColumn("d", d)
    measured = each.select("point", "kind", F.struct("d", "nombre").alias("one"), F.when(F.col("d") <= radius, F.col("k")).otherwise(0).alias("n"))
    made = measured.unionByName(counted).groupBy("point", "kind").agg(F.min("one").alias("one"), F.sum("n").alias("n_1km"))
    return made.select("point", F.when(F.col("kind") != "", F.substring("kind", 2, 1 << 30)).alias("categoria"), F.bround("one.d", 0).cast("int").alias("mas_cercano_m"), "one.nombre", "n_1km")


def radius_join(points: DataFrame, pois: DataFrame, radius: float = 1000.0, latitude_limit: float = 60.0) -> DataFrame:
    """(point, categoria, nombre, d) of all places within the radius, by an equi-join on cells of that size.

    Exact for points between the latitude limits: cells are wide enough there, and each place stands in its
    own cell and the eight around.
    """
    dlat = math.degrees(radius / EARTH_M) * 1.001
    dlon = dlat / math.cos(math.radians(latitude_limit))
    cell = lambda c, d: F.floor(F.col(c) / d)
    around = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    spread = pois.select("categoria", "nombre", F.col("lat").alias("plat"), F.col("lon").alias("plon"), around.alias("o"))
    spread = spread.withColumns({"ci": F.floor(F.col("plat") / dlat) + F.col("o.i"), "cj": F.floor(F.col("plon") / dlon) + F.col("o.j")}).drop("o")
    keyed = points.withColumns({"ci": cell("lat", dlat), "cj": cell("lon", dlon)})
    d = haversine_m(F.col("lat"), F.col("lon"), F.col("plat"), F.col("plon"))
    return keyed.join(spread, ["ci", "cj"]).withColumn("d", d).where(F.col("d") <= radius).select("point", "categoria", "nombre", "d")


def answers(calls: DataFrame) -> DataFrame:
    """(point, lat, lon, places, truncated) of cached answers in JSON; 20 places are a cut answer."""
    places = F.from_json("respuesta", ANSWER)
    return calls.where("estado = 'ok'").select(F.col("punto").alias("point"), "lat", "lon", places.alias("places")).withColumn("truncated", F.coalesce(F.size("places") >= 20, F.lit(False)))


def dense(answered: DataFrame, radius: float = 1000.0) -> DataFrame:
    """The summary of the places in cached answers; places without coordinates are passed over."""
    place = answered.select("point", "lat", "lon", F.explode("places").alias("p")).where("p.location.latitude IS NOT NULL")
    tagged = tag_places(place.withColumn("types", F.col("p.types")))
    rows = tagged.select("point", "categoria", F.coalesce("p.displayName.text", F.lit("")).alias("nombre"), haversine_m(F.col("lat"), F.col("lon"), F.col("p.location.latitude"), F.col("p.location.longitude")).alias("d"))
    return summary(rows, radius)


def summarise(scarce: DataFrame, dense_: DataFrame, answered: DataFrame, max_metro_m: int = 15_000) -> DataFrame:
    """(point, servicios, truncado): the map of categories of each point; none where the metro is too far away."""
    entry = F.struct("categoria", F.struct("mas_cercano_m", "nombre", "n_1km"))
    far = F.coalesce(F.max(F.when(F.col("categoria") == "metro", F.col("mas_cercano_m"))), F.lit(0)) > max_metro_m
    made = scarce.unionByName(dense_).groupBy("point").agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("servicios"), far.alias("far"))
    return made.where("NOT far").drop("far").join(answered.select("point", F.col("truncated").alias("truncado")), "point", "left")


def hand_out(listings: DataFrame, summaries: DataFrame) -> DataFrame:
    """Each listing with the summary of its cell."""
    return listings.withColumn("cell", cell_key(F.col("lat"), F.col("lon"))).join(summaries.withColumnRenamed("point", "cell"), "cell", "left")


def distance_quartiles(near: DataFrame) -> DataFrame:
    """Quartiles and maximum of the nearest distance of each category."""
    rows = grouped_quantiles(near, ["categoria"], {"q": F.col("mas_cercano_m")}, [0.25, 0.5, 0.75], (F.count("*").alias("n"), F.max("mas_cercano_m").alias("max_m")))
    return rows.select("categoria", "n", *[F.col("q")[i].alias(f"p{p}") for i, p in enumerate((25, 50, 75))], "max_m")


def coverage(points: DataFrame, near: DataFrame) -> DataFrame:
    """(categoria, n, pct): points with a known nearest place of each category, and their percent of all points."""
    all_ = points.agg(F.count("*").alias("all_"))
    found = near.groupBy("categoria").agg(F.count("*").alias("n")).crossJoin(F.broadcast(all_))
    return found.select("categoria", "n", F.round(100 * F.col("n") / F.col("all_"), 6).alias("pct"))


def truncated_share(answered: DataFrame) -> DataFrame:
    """(n, pct): answered points, and the percent whose answer was cut."""
    return answered.agg(F.count("*").alias("n"), F.round(100 * F.avg(F.col("truncated").cast("double")), 6).alias("pct"))


def top_reviewed(catalogue: DataFrame, k: int = 3) -> DataFrame:
    w = W.partitionBy("categoria").orderBy(F.desc("resenas"), "nombre", "lat", "lon")
    return catalogue.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def places_by_category(places: DataFrame, groups: dict[str, list[str]] = DENSE_GROUPS) -> DataFrame:
    """(point, categoria, n) of answered places, for spot checks."""
    return tag_places(places, groups).groupBy("point", "categoria").agg(F.count("*").alias("n"))


def grid_saving(df: DataFrame) -> DataFrame:
    """Distinct points, exact and by 4 and 3 decimals."""
    key = lambda d: F.count_distinct(cell_key(F.col("lat"), F.col("lon"), d))
    return df.agg(F.count_distinct("lat", "lon").alias("exact"), key(4).alias("dec4"), key(3).alias("dec3"))


def usage_by_day(log: DataFrame) -> DataFrame:
    """(day, ok, rejected, total) of a call log (cuando, estado)."""
    ok = F.count_if(F.col("estado") == "ok")
    return log.groupBy(F.to_date("cuando").alias("day")).agg(ok.alias("ok"), (F.count("*") - ok).alias("rejected"), F.count("*").alias("total"))


def usage_by_month(log: DataFrame, free: int = 5000, usd_per_1000: float = 32.0) -> DataFrame:
    """Calls of each month, what is left of the free ones and the cost of the rest."""
    months = log.groupBy(F.date_format("cuando", "yyyy-MM").alias("month")).agg(F.count("*").alias("calls"))
    return months.withColumns({"remaining": F.greatest(F.lit(free) - F.col("calls"), F.lit(0)), "cost_usd": F.round(F.greatest(F.col("calls") - free, F.lit(0)) * usd_per_1000 / 1000, 2)})


#: Widths in microseconds of the levels at which calls are counted: a day, an hour, a minute, a second.
CLOCK = (86_400_000_000, 3_600_000_000, 60_000_000, 1_000_000)


def before_rejection(log: DataFrame) -> DataFrame:
    """For each rejected call the calls before it, on that day and ever; calls of the same instant are not before it.

    Calls are counted by day, hour, minute and second. The calls before a second are those of earlier seconds of its minute, earlier
    minutes of its hour and so on, each summed within the next larger span, so that no task holds more than the spans of one larger span,
    or the calls of one second; only the days stand in one line.
    """
    at = F.unix_micros(F.col("cuando").cast("timestamp"))
    start = F.unix_micros(F.col("day").cast("timestamp"))
    dated = log.select("call_id", "estado", F.to_date("cuando").alias("day"), at.alias("at"))
    spans = [f"s{i}" for i in range(len(CLOCK))]  # places within the day
    placed = dated.withColumns({s: F.floor((F.col("at") - start) / w).cast("long") for s, w in zip(spans, CLOCK, strict=True)})
    exact = placed.groupBy("day", *spans, "at").agg(F.count("*").alias("n"))
    rolled, before = exact, exact
    upper = ["day", *spans]
    order = "at"
    for level in range(len(spans), 0, -1):
        keys = upper[: level + 1]
        past = F.coalesce(F.sum("n").over(W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        counted = rolled.withColumn(f"past_{level}", past)
        before = counted if level == len(spans) else before.join(counted.select(*keys, order, f"past_{level}"), [*keys, order])
        rolled = rolled.groupBy(*keys).agg(F.sum("n").alias("n"))
        order = keys[-1]
    days = rolled.groupBy("day").agg(F.sum("n").alias("n"))
    ever = F.coalesce(F.sum("n").over(W.orderBy("day").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    made = before.join(days.select("day", ever.alias("past_0")), "day")
    same_day = sum(F.col(f"past_{i}") for i in range(1, len(spans) + 1))
    rejected = dated.where("estado <> 'ok'").select("call_id", "day", "at")
    return rejected.join(made.select("day", "at", same_day.alias("same_day"), (F.col("past_0") + same_day).alias("ever")), ["day", "at"]).select("call_id", "day", "same_day", "ever")
