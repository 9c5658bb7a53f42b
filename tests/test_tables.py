"""Tables in buckets, incremental merges, rank selection by group."""

import os

import pytest
from pyspark.sql import functions as F

from hearth.functions.order import grouped_medians, grouped_quantiles
from hearth.operators import asof, features, geo, ingest, report, segment
from hearth.sources import bucketed, scratch, tables
from hearth.streaming import merge

KINDS = "sitio string, id_aviso string, m2_util double, at long"


def test_bucketed_base_is_not_shuffled(spark, tmp_path):
    rows = spark.range(3000).select(F.when(F.col("id") % 2 == 0, "pi").otherwise("cp").alias("sitio"), F.col("id").cast("string").alias("id_aviso"), F.col("id").cast("double").alias("m2_util"), F.lit(1).cast("long").alias("at"))
    keys, path = ["sitio", "id_aviso"], str(tmp_path / "base")
    bucketed.write_bucketed(rows, path, keys, 8)
    base = bucketed.read_bucketed(spark, path, keys, 8)
    batch = rows.where("id_aviso % 5 = 0").withColumns({"m2_util": F.col("m2_util") + 1, "at": F.lit(2).cast("long")})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for made in (ingest.merge_partial(base, batch, ["m2_util", "at"]), ingest.upsert_keyed(base, batch, ["at"]), ingest.write_back(base, batch, "m2_util", keys)):
            plan = made._jdf.queryExecution().executedPlan().toString()
            below = [line for line in plan.splitlines() if "Exchange" in line or "FileScan" in line]
            scan = next(i for i, line in enumerate(below) if "FileScan" in line and "Bucketed: true" in line)
            assert scan == 0, plan  # no exchange above the base's scan; those of the batch come after it
            got = {int(r.id_aviso): r.m2_util for r in made.collect()}
            assert got == {i: i + (i % 5 == 0) for i in range(3000)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_upsert_keyed(spark):
    base = spark.createDataFrame([("pi", "1", 1.0, 5), ("pi", "2", 2.0, 5), ("pi", "4", 4.0, None)], KINDS)
    batch = spark.createDataFrame([("pi", "1", 9.0, 4), ("pi", "2", 8.0, 5), ("pi", "2", 7.0, 3), ("pi", "3", None, 1), ("pi", "4", 6.0, None)], KINDS)
    got = {r.id_aviso: (r.m2_util, r["at"]) for r in ingest.upsert_keyed(base, batch, ["at"]).collect()}
    assert got == {"1": (1.0, 5), "2": (8.0, 5), "3": (None, 1), "4": (6.0, None)}


def folders(table):
    return {v: {b for b in os.listdir(f"{table}/{v}") if "=" in b} for v in os.listdir(table) if v.startswith("v")}


def test_merge_rewrites_only_touched_buckets(spark, tmp_path):
    """What a batch writes follows its own size; a batch that runs again changes nothing; old buckets go."""
    table, schema = str(tmp_path / "table"), spark.createDataFrame([], KINDS).schema
    one = lambda rows, n: merge.merge_batch(spark, spark.createDataFrame(rows, KINDS), n, schema, table, ["m2_util", "at"], "at", buckets=16, keep=2)
    one([("pi", str(i), float(i), 1) for i in range(800)], 0)
    assert len(folders(table)["v000000000"]) == 16
    want = {str(i): float(i) for i in range(800)}
    for n in range(1, 6):
        one([("pi", str(n), 100.0 + n, 2), ("pi", "new", None if n % 2 else float(n), 2)], n)
        assert 1 <= len(folders(table)[f"v{n:09d}"]) <= 2
        want |= {str(n): 100.0 + n, "new": float(n - n % 2) if n > 1 else None}
        read = lambda: {r.id_aviso: r.m2_util for r in merge.current(spark, table, schema).collect()}
        assert read() == want
        one([("pi", str(n), 100.0 + n, 2), ("pi", "new", None if n % 2 else float(n), 2)], n)
        assert read() == want
    assert merge.numbers(spark, table, "m") == [4, 5]
    assert len(folders(table).get("v000000000", ())) >= 10 and sum(map(len, folders(table).values())) <= 16 + 4
    one([], 6)
    assert read() == want


@pytest.mark.parametrize("plain", [100_000, 100])
def test_grouped_quantiles(spark, plain):
    """Equal to percentile() by group, a null group and missing values included, with open and with narrowed bounds."""
    v = F.when(F.col("id") % 11 > 0, F.hash("id") % 500 / 7.0)
    df = spark.range(30_000).select(F.when(F.col("id") % 4 < 3, F.col("id") % 4).alias("g"), F.when(F.col("id") % 13 == 0, float("nan")).otherwise(v).alias("v"), F.when(F.col("id") % 4 == 1, F.col("id")).alias("w"))
    fractions = [0.0, 0.1, 0.5, 0.77, 1.0]
    got = grouped_quantiles(df, ["g"], {"v": F.col("v"), "w": F.col("w")}, fractions, (F.count("*").alias("n"),), plain=plain).collect()
    ps = F.array(*map(F.lit, fractions))
    want = df.groupBy("g").agg(F.count("*").alias("n"), F.percentile(F.when(~F.isnan("v"), F.col("v")), ps).alias("v"), F.percentile("w", ps).alias("w")).collect()
    assert len(got) == 4
    for r in want:
        (own,) = [x for x in got if x.g == r.g]
        assert own.n == r.n and own.v == pytest.approx(r.v) and own.w == (pytest.approx(r.w) if r.w else [None] * 5)
    assert grouped_medians(df.limit(0), ["g"], {"v": F.col("v")}).isEmpty() and grouped_medians(df.limit(0), [], {"v": F.col("v")}).first().v is None


@pytest.mark.parametrize("parts", [1, 7])
def test_asof_join(spark, parts):
    """Equal to a search by hand: hot groups over many ranges, equal times, missing times and groups."""
    import random

    rng = random.Random(parts)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        left = [(i, rng.choice(["hot", "hot", "hot", "b", None]), rng.choice([None, *range(200)])) for i in range(600)]
        right = [(rng.choice(["hot", "b", "c", None]), rng.choice([None, *range(0, 200, 3)]), rng.randint(0, 9)) for _ in range(80)]
        got = asof.asof_join(spark.createDataFrame(left, "id long, g string, at long"), spark.createDataFrame(right, "g string, seen long, v long"), "at", "seen", ["v"], ["g"]).collect()
        want = {}
        for i, g, at in left:
            known = [(s, v) for h, s, v in right if h == g and s is not None and at is not None and s <= at]
            want[i] = max(known, default=(None, None))
        assert {r.id: (r.seen, r.v) for r in got} == want and len(got) == 600
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_audit_in_one_scan(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None)], "k string, v double")
    table, checks = report.audited(df, [("k known", F.count("k") == F.count("*"), "critical"), ("v known", F.count("v") == F.count("*"), "notice"), ("none", F.max("v") > F.lit(None), "notice")])
    assert table.count() == 2 and {(r.check, r.ok, r.severity, r.detail) for r in checks.collect()} == {("k known", True, "critical", ""), ("v known", False, "notice", "v known does not hold"), ("none", False, "notice", "none does not hold")}


def test_hot_day_and_hot_cell(spark):
    """Calls of a single day and places of a single cell, against counts by hand."""
    log = spark.range(4000).select(F.col("id").alias("call_id"), F.timestamp_micros(F.lit(1_700_000_000_000_000) + (F.col("id") * 37 % 1999) * 7_654_321).alias("cuando"), F.when(F.col("id") % 5 == 0, "rechazo").otherwise("ok").alias("estado"))
    rows = [(r.call_id, r.cuando, r.estado) for r in log.collect()]
    got = {r.call_id: (r.same_day, r.ever) for r in geo.before_rejection(log).collect()}
    assert got == {i: (sum(u < t and u.date() == t.date() for _, u, _ in rows), sum(u < t for _, u, _ in rows)) for i, t, e in rows if e != "ok"}
    pois = spark.range(3000).select(F.lit("m").alias("categoria"), F.concat(F.lit("n"), "id").alias("nombre"), (F.lit(-33.45) + F.col("id") % 50 / 1e5).alias("lat"), (F.lit(-70.6) + F.floor(F.col("id") / 50) % 20 / 1e5).alias("lon"))
    points = spark.createDataFrame([(f"p{i}", -33.45 + i / 300, -70.6 - i / 900) for i in range(12)], "point string, lat double, lon double")
    near = {r.point: (r.mas_cercano_m, r.nombre, r.n_1km) for r in geo.nearest(points, pois, most=8).collect()}
    pairs = points.crossJoin(pois.select("categoria", "nombre", F.col("lat").alias("y"), F.col("lon").alias("x"))).withColumn("d", geo.haversine_m(F.col("lat"), F.col("lon"), F.col("y"), F.col("x")))
    assert near == {r.point: (r.mas_cercano_m, r.nombre, r.n_1km) for r in geo.summary(pairs, 1000.0).collect()} and {v[2] for v in near.values()} >= {0, 3000}


def test_pages_as_gzip_files(spark, tmp_path):
    """Line ends, empty and long pages come back as they were; null pages are left out."""
    pages = [(1, "<html>\n a\r\n"), (2, ""), (3, "x" * 200_000 + "é😀"), (4, "\n\n"), (5, None)]
    tables.write_pages(spark.createDataFrame(pages, "page_id long, html string"), str(tmp_path / "p"), "page_id")
    assert {(r.page_id, r.html) for r in tables.read_pages(spark, str(tmp_path / "p")).collect()} == set(pages[:4])


def test_features_refuse_prices(spark):
    row = spark.createDataFrame([("1", 60.0, "casa", 5000.0)], "id_aviso string, m2_util double, tipo string, precio_uf double")
    made = features.scoring_input(row)
    assert "precio_uf" in features.select_blocks(made, ["precio_uf"]).columns
    for bad in (F.log("precio_uf").alias("size"), F.col("id_aviso"), (F.col("m2_util") * F.col("precio_clp")).alias("x")):
        with pytest.raises(ValueError):
            features.select_blocks(made, more=[bad])
    assert features.select_blocks(made, more=[(F.col("m2_util") * 2).alias("double_area")]).first().double_area == 120.0


def test_tidy_keeps_what_a_persisted_result_reads(spark):
    folders = []

    def kept(df):
        made = scratch.stored(df)
        folders.append(made.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://"))
        return made

    @scratch.tidy
    def persisted():
        kept(spark.range(5))
        return kept(spark.range(100)).persist().where("id % 2 = 0").persist()

    @scratch.tidy
    def dealt():
        return segment.eta_by_chance(kept(spark.range(400).select("id", (F.col("id") % 5).alias("g"), F.rand(3).alias("y"))), "y", "g", "id", replicates=20)

    made = persisted()  # its tables are first read here, after tidy() has deleted what nothing reads
    assert made.count() == 50 and sorted(r.replicate for r in dealt().collect()) == list(range(20))
    assert [os.path.exists(f) for f in folders] == [False, True, True]
    made.unpersist()


def test_pages_are_written_by_all_cores(spark, tmp_path):
    """Pages of one task are dealt out; each is still one file, in a folder of its key."""
    pages = spark.createDataFrame([(i, f"<p>{i}\n</p>") for i in range(40)], "page_id long, html string").coalesce(1)
    tables.write_pages(pages, str(tmp_path / "p"), "page_id")
    files = list((tmp_path / "p").glob("page_id=*/part-*.gz"))
    assert len(files) == len({f.parent for f in files}) == 40 and len({f.name[:10] for f in files}) > 1
    assert {(r.page_id, r.html) for r in tables.read_pages(spark, str(tmp_path / "p")).collect()} == {(r.page_id, r.html) for r in pages.collect()}
