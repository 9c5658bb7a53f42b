"""Operators on small frames: merging, repair, places, splits, ratio studies, intervals, verdicts, streams."""

import pytest
from pyspark.sql import functions as F

from hearth import schema
from hearth.functions.order import dense_index, exact_quantiles, random_order
from hearth.operators import clean, features, geo, ingest, ratio, report, score, segment
from hearth.sources import tables
from hearth.streaming import merge


def test_canonical_ratio_study(spark):
    df = spark.createDataFrame([(100.0, 110.0), (200.0, 180.0), (300.0, 330.0), (400.0, 360.0), (0.0, 5.0), (float("nan"), 1.0)], "y double, pred double")
    r = ratio.ratio_study(df).first()
    assert (r.n, r.mdape, r.ppe10, r.cod) == (4, 10.0, 100.0, 10.0) and r.prd == pytest.approx(1 / 0.98, abs=1e-6)


def test_merge_policies(spark):
    base = spark.createDataFrame([("pi", "1", 50.0, "a"), ("pi", "2", 60.0, "b")], "sitio string, id_aviso string, m2_util double, comuna string")
    batch = spark.createDataFrame([("pi", "1", None), ("pi", "3", 70.0)], "sitio string, id_aviso string, m2_util double")
    rows = lambda df: {r.id_aviso: (r.m2_util, r.comuna) for r in df.collect()}
    assert rows(ingest.merge_partial(base, batch, ["m2_util"])) == {"1": (50.0, "a"), "2": (60.0, "b"), "3": (70.0, None)}
    assert rows(ingest.merge_partial(base, batch, ["m2_util"], null_policy="overwrite"))["1"] == (None, "a")
    assert rows(ingest.merge_partial(base, batch, ["m2_util"], insert=False)).keys() == {"1", "2"}
    once = ingest.merge_partial(base, batch, ["m2_util"])
    assert rows(ingest.merge_partial(once, batch, ["m2_util"])) == rows(once)


def test_frontier(spark):
    space = ingest.search_space(spark, ["macul", "nunoa", "la-florida", "san-miguel"], ["venta", "arriendo"], ["casa", "departamento"])
    pages = ingest.frontier(space, 3)
    assert (space.count(), pages.count()) == (16, 48)
    assert {r.url.rsplit("/", 1)[1] for r in pages.collect()} == {"", "_Desde_49", "_Desde_97"}


def test_repair_order(spark):
    row = {"tipo": "departamento", "ano_construccion": 20.0, "antiguedad_anos": 2006.0, "precio_uf": None, "precio_clp": 4e6, "m2_util": 90.0, "m2_total": 80.0, "lat": -33.5, "lon": None, "dormitorios": 40.0, "banos": 0.0, "estacionamientos": 1.0, "bodegas": None, "gastos_comunes_clp": 0.0}
    kinds = ", ".join(f"{c} {'string' if c == 'tipo' else 'double'}" for c in row)
    df = spark.createDataFrame([tuple(row.values()), tuple((row | {"precio_uf": 2.0, "precio_clp": 80000.0}).values())], kinds)
    r = clean.repair(df).where("precio_clp > 1e6").first()
    assert (r.ano_construccion, r.antiguedad_anos, r.precio_uf) == (2006.0, 20.0, 100.0)
    assert (r.m2_total, r.lat, r.dormitorios, r.banos, r.gastos_comunes_clp) == (None, None, None, None, None)


def test_places(spark):
    points = spark.createDataFrame([("p", -33.45, -70.6)], "point string, lat double, lon double")
    pois = spark.createDataFrame([("metro", "b", -33.451, -70.6), ("metro", "a", -33.451, -70.6), ("salud", "c", -33.5, -70.6)], "categoria string, nombre string, lat double, lon double")
    got = {r.categoria: (r.mas_cercano_m, r.nombre, r.n_1km) for r in geo.nearest(points, pois).collect()}
    assert got == {"metro": (111, "a", 2), "salud": (5560, "c", 0)}
    assert geo.radius_join(points, pois).count() == 2
    answer = '[{"displayName": {"text": "S"}, "types": ["school", "park"], "location": {"latitude": -33.45, "longitude": -70.601}}, {"types": ["park"]}]'
    calls = spark.createDataFrame([("p", -33.45, -70.6, answer, "ok"), ("q", 0.0, 0.0, None, "rechazo")], "punto string, lat double, lon double, respuesta string, estado string")
    answered = geo.answers(calls)
    dense = {r.categoria: (r.mas_cercano_m, r.n_1km) for r in geo.dense(answered).collect()}
    assert dense == {"educacion": (93, 1), "parque": (93, 1)}
    whole = geo.summarise(geo.nearest(points, pois), geo.dense(answered), answered).first()
    assert set(whole.servicios) == {"metro", "salud", "educacion", "parque"} and whole.truncado is False
    assert geo.grid(spark, (0.0, 1.0, 0.0, 1.0), 6).count() == 36


def test_nearest_of_many_places(spark):
    rows = spark.range(20_300)
    pois = rows.select(F.concat(F.lit("c"), (F.col("id") % 2).cast("string")).alias("categoria"), F.concat(F.lit("n"), "id").alias("nombre"), (F.col("id") * 37 % 140 - 70 + F.col("id") / 1e5).alias("lat"), (F.col("id") * 53 % 360 - 180.0).alias("lon"))
    far = spark.createDataFrame([("c2", "pole", 89.9, 170.0), (None, "sea", 0.0, -179.999), ("c2", "lost", None, 1.0)], "categoria string, nombre string, lat double, lon double")
    points = spark.createDataFrame([("date line", 0.0, 179.999), ("pole", 89.9, -10.0), ("south", -80.0, 3.0), ("city", -33.4, -70.6)], "point string, lat double, lon double")
    all_ = pois.union(far)
    got = {(r.point, r.categoria): (r.mas_cercano_m, r.nombre, r.n_1km) for r in geo.nearest(points, all_).collect()}
    p = all_.where("lat IS NOT NULL").select("categoria", "nombre", F.col("lat").alias("plat"), F.col("lon").alias("plon"))
    pairs = points.crossJoin(p).withColumn("d", geo.haversine_m(F.col("lat"), F.col("lon"), F.col("plat"), F.col("plon")))
    assert got == {(r.point, r.categoria): (r.mas_cercano_m, r.nombre, r.n_1km) for r in geo.summary(pairs, 1000.0).collect()}
    assert len(got) == 16 and got["date line", None] == (222, "sea", 1)


def test_dense_index_and_split(spark):
    df = spark.range(1000).repartition(7)
    got = [r["index"] for r in dense_index(df, [random_order(F.col("id"), 1), F.col("id")]).orderBy(random_order(F.col("id"), 1), "id").collect()]
    assert got == list(range(1000))
    rows = spark.range(1000).withColumn("building", (F.col("id") % 50).cast("string"))
    sided = features.split_by_group(rows, "building", mode="exact")
    assert sided.where("side = 'test'").select("building").distinct().count() == 10
    assert features.leak_count(sided, "building").first().leaking == 0


def test_quantiles_are_right_closed(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 11)], "y double")
    assert [r.quantile for r in ratio.with_quantile(df, "y").orderBy("y").collect()] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]


def test_conformal(spark):
    df = spark.createDataFrame([(float(i), 0.0, 0.0) for i in range(1, 20)], "y double, lo double, hi double")
    assert tuple(score.conformal_shift(df, 0.2).first()) == (19, 16.0)
    wide = score.apply_interval(df, score.conformal_shift(df, 0.2)).first()
    assert (wide.lo, wide.hi) == (0.0, 16.0)


def test_verdict_edges(spark):
    df = spark.createDataFrame([(5200.0, 5287.37, 8.8), (110.0, 100.0, 10.0), (120.0, 100.0, 10.0), (90.0, 100.0, 10.0), (80.0, 100.0, 10.0)], "asked double, pred double, error_tipico double").withColumns({"lo": F.lit(0.0), "hi": F.lit(6000.0)})
    got = score.verdict(df, "asked").collect()
    assert (got[0].brecha_pct, got[0].errores_tipicos, got[0].veredicto, got[0].dentro_del_rango) == (-1.7, -0.19, "EN PRECIO", True)
    assert [r.veredicto for r in got[1:]] == ["CARO", "MUY CARO", "BARATO", "MUY BARATO"]
    assert sum(r.n for r in score.label_counts(score.verdict(df, "asked")).collect()) == 5


def test_features_and_services(spark):
    j = '{"metro":{"mas_cercano_m":552,"nombre":"X","n_1km":2},"_truncado":true}'
    df = spark.createDataFrame([(j, "50", "casa"), ("SIN_DATO", None, None)], "servicios_cercanos string, m2_util string, tipo string")
    a, b = features.scoring_input(df).collect()
    assert (a.dist_metro_m, a.n_metro_1km, a.servicios_truncado, a.es_casa, a.sin_servicios, a.sin_geo) == (552.0, 2.0, 1.0, 1.0, 0.0, 1.0)
    assert (b.dist_metro_m, b.servicios_truncado, b.es_casa, b.log_m2_util) == (None, None, 0.0, None)
    features.select_blocks(features.scoring_input(df))


def test_eta_and_silhouette(spark):
    df = spark.createDataFrame([(i, float(i % 2) * 10, "ab"[i % 2]) for i in range(20)], "k int, y double, g string")
    assert segment.eta_squared(df, "y", "g").first().eta2 == 1.0
    assert segment.silhouette(df, ["y"], "k", "g").first().silhouette == 1.0


def test_sources(spark, tmp_path):
    rows = schema.conform(spark.createDataFrame([("pi", "1", 'a "quoted", text')], "sitio string, id_aviso string, titulo string"), schema.RAW_LISTING)
    tables.write_csv(tables.restore_sentinel(rows, ["sitio", "id_aviso", "titulo", "lat"]), str(tmp_path / "csv"))
    back = tables.read_csv_text(spark, str(tmp_path / "csv"), schema.RAW_LISTING).first()
    assert (back.titulo, back.lat, back.url) == ('a "quoted", text', "SIN_DATO", "")
    tables.create_table(spark, schema.RECORD, str(tmp_path / "t"))
    assert tables.read_table(spark, str(tmp_path / "t")).count() == 0


def test_stream_merge(spark, tmp_path):
    kinds = "sitio string, id_aviso string, m2_util double, at long"
    src, table = str(tmp_path / "in"), str(tmp_path / "table")
    write = lambda rows: spark.createDataFrame(rows, kinds).coalesce(1).write.mode("append").parquet(src)
    run = lambda: merge.stream_merge(spark, src, spark.createDataFrame([], kinds).schema, table, str(tmp_path / "ck"), ["m2_util", "at"], "at").awaitTermination()
    write([("pi", "1", 10.0, 1), ("pi", "1", 11.0, 2), ("pi", "2", 20.0, 1)])
    run()
    write([("pi", "1", None, 3), ("pi", "3", 30.0, 3)])
    run()
    run()
    got = {r.id_aviso: r.m2_util for r in merge.current(spark, table, spark.createDataFrame([], kinds).schema).collect()}
    assert got == {"1": 11.0, "2": 20.0, "3": 30.0}


def test_audit(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None)], "k string, v double")
    checks = report.expectations(df, [("one k", F.count_distinct("k") == 1, "critical"), ("v known", F.count("v") == F.count("*"), "notice")])
    assert {(r.check, r.ok) for r in checks.collect()} == {("one k", True), ("v known", False)}
    assert report.frame_parity(df, df, ["k"], ["v"]).first().n_different in (0, 2)
    assert report.duplicate_keys(df, ["k"]).count() == 1


def test_labels_dealt_by_chance(spark):
    df = spark.range(4000).select("id", (F.col("id") % 5).alias("g"), (F.col("id") % 5 + F.rand(3)).alias("y"))
    got = [r.eta2 for r in segment.eta_by_chance(df, "y", "g", "id", replicates=100).collect()]
    assert len(got) == 100 and sum(got) / 100 == pytest.approx(4 / 3999, rel=0.3) and max(got) < 0.01
    assert segment.eta_by_chance(df.where("id < 0"), "y", "g", "id").count() == 0
    assert segment.eta_by_chance(df.withColumn("y", F.lit(None).cast("double")), "y", "g", "id").count() == 0


def test_shuffled_and_hopkins(spark):
    df = spark.range(600).select("id", *[(F.col("id") % 3 * 10 + F.rand(i)).alias(f"x{i}") for i in range(4)])
    cols = [f"x{i}" for i in range(4)]
    dealt = segment.shuffled(df, cols, "id")
    assert dealt.count() == 600 and dealt.select("id").distinct().count() == 600
    for c in cols:
        assert sorted(r[0] for r in dealt.select(c).collect()) == sorted(r[0] for r in df.select(c).collect())
    assert dealt.where("abs(x0 - x1) > 5").count() > 200
    assert segment.hopkins(df, cols, "id").first().hopkins > 0.9
    even = spark.range(600).select("id", *[F.rand(i).alias(f"x{i}") for i in range(2)])
    assert abs(segment.hopkins(even, ["x0", "x1"], "id").first().hopkins - 0.5) < 0.1
    assert segment.hopkins(df.limit(0), cols, "id").first().hopkins is None
    assert segment.shuffled(df.limit(0), cols, "id").count() == 0


@pytest.mark.parametrize("plain", [0, 100_000])
def test_exact_quantiles(spark, plain):
    wanted = [0.0, 0.05, 0.25, 1 / 3, 0.5, 0.8, 0.99, 1.0]
    tied = spark.range(60_000).select(F.floor(F.rand(1) * 50).cast("double").alias("v"))
    for df in (spark.range(60_000).select(F.exp(F.randn(2)).alias("v")), tied):
        found = exact_quantiles(df.union(df.limit(3).select(F.lit(None).cast("double"))), F.col("v"), wanted, accuracy=1000, plain=plain).first()
        assert found.n == 60_000 and found.q == pytest.approx(df.agg(F.percentile("v", F.array(*[F.lit(w) for w in wanted]))).first()[0], rel=1e-12)
    for n in (0, 1, 2, 5):
        found = exact_quantiles(tied.limit(n), F.col("v"), [0.1, 0.5]).first()
        assert found.n == n and (n > 0) == (found.q[0] is not None)


def test_models_and_forest(spark):
    from hearth.operators import model

    cols = ["m2_util", "banos"]
    df = spark.range(1500).select(F.col("id").cast("string").alias("id_aviso"), (30 + F.rand(1) * 100).alias("m2_util"), F.when(F.rand(2) > 0.1, F.floor(F.rand(3) * 3) + 1).cast("double").alias("banos"), F.when(F.col("id") % 2 == 0, "macul").otherwise("nunoa").alias("comuna"), F.randn(4).alias("e"))
    df = df.withColumn("y", F.exp(F.lit(4.0) + 0.01 * F.col("m2_util") + F.when(F.col("comuna") == "macul", 0.5).otherwise(0.0) + 0.1 * F.col("e"))).drop("e").persist()
    train, test = df.where("id_aviso % 3 != 0"), df.where("id_aviso % 3 = 0")
    for kind in ("ridge", "boosting"):
        fitted = model.fit(train, kind, cols=cols, small=True)
        assert ratio.ratio_study(model.predict(fitted, test)).first().mdape < 10
    importance = {r.feature: r.importance for r in model.permutation_importance(fitted, test, "id_aviso", cols=cols).collect()}
    assert importance["m2_util"] > 5 * abs(importance["banos"])
    q = test.join(model.quantile_forest(train, test, "id_aviso", cols=cols, trees=5), "id_aviso")
    assert q.count() == 500 and 0.6 < q.where("y BETWEEN q0 AND q1").count() / 500 < 0.95
