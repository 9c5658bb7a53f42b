"""Model packages: ranges that differ between rows, coverage, reload, acceptance and both markets together."""

import bisect
import itertools
import time
from fractions import Fraction

from pyspark.sql import functions as F

from hearth.operators import model, package, ratio, score
from hearth.plans import queries


def listings(spark, n=1500):
    df = spark.range(n).select(
        F.col("id").cast("string").alias("id_aviso"), F.concat(F.lit("b"), (F.col("id") % 400).cast("string")).alias("building"), (30 + F.rand(1) * 100).alias("m2_util"), F.when(F.rand(2) > 0.1, F.floor(F.rand(3) * 3) + 1).cast("double").alias("banos"),
        F.when(F.col("id") % 2 == 0, "macul").otherwise("nunoa").alias("comuna"), F.when(F.col("id") % 9 == 0, "casa").otherwise("departamento").alias("tipo"), F.when(F.col("id") % 4 > 0, -33.45 + F.col("id") % 7 / 1000).alias("lat"), F.lit(-70.6).alias("lon"), F.randn(4).alias("e"),
    )
    spread = F.when(F.col("comuna") == "macul", 0.05).otherwise(0.25)  # the range must be wider in one commune
    return df.withColumn("y", F.exp(F.lit(7.0) + 0.01 * F.col("m2_util") + spread * F.col("e"))).drop("e")


def test_package(spark, tmp_path):
    cols, path = ["m2_util", "banos"], str(tmp_path / "p")
    df = listings(spark).persist()
    train, test = df.where("id_aviso % 3 != 0"), df.where("id_aviso % 3 = 0")
    made = package.fit(train, "venta", 40000.0, cols=cols, trees=6)
    package.save(made, path, ratio.ratio_study(model.predict(made.point, test)).unpivot([], ["mdape", "prd"], "metric", "value"))
    assert spark.read.json(f"{path}/card").count() == 2
    got = package.estimate(test, package.load(spark, path)).persist()
    assert got.count() == test.count() and got.where("NOT (lo >= 0 AND lo < hi AND pred BETWEEN lo AND hi)").isEmpty()
    (report,) = score.coverage_report(got).collect()
    assert 70 <= report.coverage <= 90
    width = {r.comuna: r.w for r in got.groupBy("comuna").agg(F.avg((F.col("hi") - F.col("lo")) / F.col("pred")).alias("w")).collect()}
    assert width["nunoa"] > 1.5 * width["macul"]
    assert got.where("tipo = 'casa' AND confianza <> 'baja'").isEmpty() and got.where("lat IS NULL AND confianza = 'alta'").isEmpty()
    check = spark.createDataFrame(package.reload_check(test, made, path).collect(), "n long, n_different long")
    (same,) = check.collect()
    assert (same.n, same.n_different) == (test.count(), 0)
    rules = {r.rule: r.ok for r in package.acceptance(ratio.ratio_study(got), score.coverage_report(got), cols, check).collect()}
    assert len(rules) == 8 and rules["reload"] and rules["forbidden_columns"] and rules["coverage"]
    barred = package.acceptance(ratio.ratio_study(got), score.coverage_report(got), [*cols, "precio_uf"], check)
    assert barred.where("rule = 'forbidden_columns' AND NOT ok").count() == 1


def test_both_markets(spark):
    cols = ["m2_util", "banos"]
    df = listings(spark, 400)
    train, test = df.where("id_aviso % 3 != 0"), df.where("id_aviso % 3 = 0").withColumn("asked", F.col("y"))
    sale = package.fit(train, "venta", 40000.0, cols=cols, trees=2)
    rent = package.fit(train.withColumn("y", F.col("y") * 200), "arriendo", 40000.0, cols=cols, trees=2)
    got = package.estimate_both(test, sale, rent, "asked").collect()
    assert len(got) == test.count()
    for r in got:
        assert r.arriendo_uf == round(r.pred_arriendo / 40000.0, 2) or abs(r.arriendo_uf - r.pred_arriendo / 40000.0) <= 0.00501
        assert len(r.advertencias) == 2 + len(r.motivos_venta) + len(r.motivos_arriendo) and r.veredicto in score.LABELS


def test_quantiles_of_large_leaves(spark, monkeypatch):
    """Rows that share a leaf of 30,000 members don't meet each of them; quantiles are those of the weighted members."""
    n = 30_000
    one = spark.range(n).select(F.lit(0).alias("tree"), F.lit(0.0).alias("leaf"), (F.col("id") * 2.0).alias("member"), F.lit(1).cast("long").alias("n"), F.lit(n).cast("long").alias("size"), (F.col("id") * 2).alias("code"))
    two = spark.range(n).select(F.lit(1).alias("tree"), (F.col("id") % 3000).cast("double").alias("leaf"), (F.col("id") * 2.0 + 1).alias("member"), F.lit(1).cast("long").alias("n"), F.lit(10).cast("long").alias("size"), (F.col("id") * 2 + 1).alias("code"))
    rows = spark.range(n).select(F.col("id").alias("k"), F.posexplode(F.array(F.lit(0.0), (F.col("id") % 3000).cast("double"))).alias("tree", "leaf"))
    monkeypatch.setattr(model, "leaves_of", lambda forest, df, y, *keep: df.select(*keep, "tree", "leaf"))
    began = time.time()
    got = {r.k: (r.q0, r.q1) for r in model.quantiles_of(None, one.union(two), rows, "k").collect()}
    assert time.time() - began < 60 and len(got) == n
    for k in (0, 1, 777, 2999, 29_999):
        v = [2.0 * i for i in range(n)] + [2.0 * i + 1 for i in range(n) if i % 3000 == k % 3000]
        ordered = sorted(zip(v, [Fraction(1, n)] * n + [Fraction(1, 10)] * 10, strict=True))
        upto = list(itertools.accumulate(w for _, w in ordered))
        assert got[k] == tuple(ordered[bisect.bisect_left(upto, 2 * q)][0] for q in (Fraction(1, 10), Fraction(9, 10)))


def test_comparison_reads_stored_predictions(spark):
    """A study reads its rows several times; no candidate predicts again in it."""
    found = queries.model_comparison(spark, "/root/testdata/sf0.001")
    assert "UDF" not in found._jdf.queryExecution().toString() and found.count() == 5
