"""Segmentation diagnostics: scaling, tendency to cluster, components, k-means and how much groups explain."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hearth.functions.order import deals, dense_index, exact_quantiles, grouped_medians, grouped_quantiles, random_order, uniform
from hearth.operators.features import sample_n


def scale_matrix(df: DataFrame, cols: list[str], keep: list[str]) -> DataFrame:
    """keep and cols, missing values as the column's median, then scaled by the population deviation."""
    medians = grouped_medians(df, [], {f"m_{c}": F.col(c) for c in cols})
    filled = df.crossJoin(F.broadcast(medians)).select(*keep, *[F.coalesce(F.col(c), F.col(f"m_{c}")).alias(c) for c in cols])
    moments = filled.agg(*[x for c in cols for x in (F.avg(c).alias(f"a_{c}"), F.stddev_pop(c).alias(f"s_{c}"))])
    scaled = lambda c: F.coalesce(F.try_divide(F.col(c) - F.col(f"a_{c}"), F.col(f"s_{c}")), F.lit(0.0))
    return filled.crossJoin(F.broadcast(moments)).select(*keep, *[scaled(c).alias(c) for c in cols])


def squared_distance(a: list[Column], b: list[Column]) -> Column:
    return reduce(lambda s, t: s + t, [(x - y) * (x - y) for x, y in zip(a, b, strict=True)])


def hopkins(df: DataFrame, cols: list[str], key: str, share: float = 0.05, least: int = 50, most: int = 500, seeds: tuple[int, ...] = tuple(range(10))) -> DataFrame:
    """(hopkins): uniform and real probes by the distance to the nearest other row, averaged over seeds. About 0.5 without clusters.

    Each seed takes the given share of the rows as probes, at least `least`, and at most `most`: a sampling statistic.
    All probes (2 x most x seeds vectors) go to every task; each task returns its least distance to each.  Rows of a
    real probe's key are not its neighbours.  Null without two rows; cols hold no nulls.
    """
    spark, rows = df.sparkSession, df.select(F.col(key).cast("string").alias("id_"), F.array(*[F.col(c).cast("double") for c in cols]).alias("x_")).persist()
    box = rows.agg(F.count("*").alias("n"), *[x for i in range(len(cols)) for x in (F.min(F.col("x_")[i]), F.max(F.col("x_")[i]))]).first()
    n = box["n"]
    if n < 2:
        rows.unpersist()
        return spark.createDataFrame([(None,)], "hopkins double")
    m, lo, hi = min(max(int(share * n), least), most, n), np.array(box[1::2], float), np.array(box[2::2], float)
    probes, ids = [], {}
    for s in seeds:
        # twice as many as wanted by their hash, so that what each task sends stays small; then the first of them
        few = rows.where(uniform(F.col("id_"), s) < min(1.0, (2 * m + 100) / n)).orderBy(random_order(F.col("id_"), s), "id_").limit(m).collect()
        drawn = np.random.default_rng(s)
        for r in few:
            ids.setdefault(r["id_"], []).append(len(probes))
            probes.append((s, "real", np.array(r["x_"], float)))
        probes += [(s, "uniform", lo + (hi - lo) * drawn.random(len(cols))) for _ in few]
    vectors = np.array([p[2] for p in probes])
    squares = (vectors * vectors).sum(1)

    def least_distances(batches):
        best = np.full(len(vectors), np.inf)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                x = np.array(part["x_"].tolist(), float)
                d = (x * x).sum(1)[:, None] + squares - 2 * x @ vectors.T
                for i, name in enumerate(part["id_"]):
                    if name in ids:
                        d[i, ids[name]] = np.inf
                best = np.minimum(best, d.min(0))
        yield pd.DataFrame({"probe": np.arange(len(best)), "d": np.sqrt(np.maximum(best, 0.0))})

    kinds = spark.createDataFrame([(i, s, kind) for i, (s, kind, _) in enumerate(probes)], "probe long, seed int, kind string")
    near = rows.mapInPandas(least_distances, "probe long, d double").groupBy("probe").agg(F.min("d").alias("d")).join(F.broadcast(kinds), "probe").where("d < double('infinity')")
    u, r = (F.sum(F.when(F.col("kind") == k, F.col("d"))) for k in ("uniform", "real"))
    found = near.groupBy("seed").agg(F.try_divide(u, u + r).alias("h")).agg(F.avg("h")).first()
    rows.unpersist()
    return spark.createDataFrame([tuple(found)], "hopkins double")


def shuffled(df: DataFrame, cols: list[str], key: str, seed: int = 42) -> DataFrame:
    """key and cols, each column dealt anew: the control without structure.

    One sort puts rows in random order; each column then moves its values by a map of positions of its own, and one
    shuffle by the new position joins them, however many columns there are.
    """
    placed = dense_index(df.select(key, *cols), [random_order(F.col(key), seed), F.col(key)])
    n = placed.count()
    moved = [F.struct(F.pmod(F.lit(a) * F.col("index") + F.lit(b), F.lit(max(n, 1))).alias("to"), F.lit(i).alias("i"), F.col(c).cast("double").alias("v")) for i, (c, (a, b)) in enumerate(zip(cols, deals(n, len(cols), seed), strict=True))]
    long = placed.select(F.explode(F.array(*moved)).alias("m")).select("m.*")
    dealt = long.groupBy(F.col("to").alias("index")).agg(F.map_from_entries(F.collect_list(F.struct("i", "v"))).alias("m"))
    return placed.select("index", key).join(dealt, "index").select(key, *[F.col("m")[i].alias(c) for i, c in enumerate(cols)])


def assembled(df: DataFrame, cols: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol="features").transform(df)


def pca_variance(df: DataFrame, cols: list[str]) -> DataFrame:
    """(component, variance, cumulative) of all components."""
    model = PCA(k=len(cols), inputCol="features", outputCol="pc").fit(assembled(df, cols))
    rows = [(i + 1, float(v)) for i, v in enumerate(model.explainedVariance)]
    made = df.sparkSession.createDataFrame(rows, "component int, variance double")
    return made.withColumn("cumulative", F.sum("variance").over(W.orderBy("component")))


def pca_loadings(df: DataFrame, cols: list[str], k: int = 3) -> DataFrame:
    """(component, column, loading); the sign is arbitrary."""
    model = PCA(k=k, inputCol="features", outputCol="pc").fit(assembled(df, cols))
    rows = [(j + 1, c, float(model.pc[i, j])) for i, c in enumerate(cols) for j in range(k)]
    return df.sparkSession.createDataFrame(rows, "component int, column string, loading double")


def _least_cost(ready: DataFrame, ks: list[int], seeds: tuple[int, ...], parallel: int) -> dict[int, KMeansModel]:
    """For each k the model of the least cost over several starts (ties: the first start); so many fits run side by side."""
    fits = [(k, s) for k in ks for s in seeds]
    with ThreadPoolExecutor(parallel) as pool:
        models = list(pool.map(lambda f: KMeans(k=f[0], seed=f[1]).fit(ready), fits))
    best: dict[int, KMeansModel] = {}
    for (k, _), m in zip(fits, models, strict=True):
        if k not in best or m.summary.trainingCost < best[k].summary.trainingCost:
            best[k] = m
    return best


def kmeans(df: DataFrame, cols: list[str], k: int, seeds: tuple[int, ...] = (42,), parallel: int = 8) -> KMeansModel:
    """The model of the least cost over several starts."""
    return _least_cost(assembled(df, cols), [k], seeds, parallel)[k]


def kmeans_sweep(df: DataFrame, cols: list[str], ks: range = range(2, 11), seeds: tuple[int, ...] = (42,), parallel: int = 8) -> DataFrame:
    """(k, inertia): squared distance to the centre per point; none without rows."""
    ready = assembled(df, cols).select("features").persist()
    n = ready.count()
    models = _least_cost(ready, list(ks) if n else [], seeds, parallel)
    rows = [(k, float(m.summary.trainingCost / n)) for k, m in models.items()]
    ready.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, inertia double")


def clustered(df: DataFrame, cols: list[str], model: KMeansModel) -> DataFrame:
    """df with cluster and the distance to its centre."""
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    made = model.transform(assembled(df, cols)).withColumnRenamed("prediction", "cluster")
    centre = F.element_at(centres, F.col("cluster") + 1)
    gap = F.aggregate(F.zip_with(vector_to_array("features"), centre, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    return made.withColumn("centre_distance", F.sqrt(gap)).drop("features")


def silhouette(df: DataFrame, cols: list[str], key: str, group: str = "cluster", sample: int = 3000, seed: int = 42) -> DataFrame:
    """(silhouette) by Euclidean distances within a bounded sample."""
    s = sample_n(df.select(key, group, *cols), sample, key, seed).persist()
    other = F.broadcast(s.select(F.col(key).alias("k2"), F.col(group).alias("g2"), *[F.col(c).alias(f"o_{c}") for c in cols]))
    d = F.sqrt(squared_distance([F.col(c) for c in cols], [F.col(f"o_{c}") for c in cols]))
    mean = s.crossJoin(other).where(F.col(key) != F.col("k2")).groupBy(key, group, "g2").agg(F.avg(d).alias("d"))
    a, b = F.min(F.when(F.col("g2") == F.col(group), F.col("d"))), F.min(F.when(F.col("g2") != F.col(group), F.col("d")))
    each = mean.groupBy(key).agg(a.alias("a"), b.alias("b"))
    return each.agg(F.avg(F.when(F.col("a").isNull(), 0.0).otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))).alias("silhouette"))


def eta_squared(df: DataFrame, y: str, group: str) -> DataFrame:
    """(eta2): the share of the variance of y that lies between groups."""
    by = df.where(F.col(y).isNotNull()).groupBy(group).agg(F.count("*").alias("n"), F.avg(y).alias("mean"), F.var_pop(y).alias("var"))
    total = by.agg(F.sum("n").alias("nn"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand"))
    both = by.crossJoin(F.broadcast(total))
    between = F.sum(F.col("n") * (F.col("mean") - F.col("grand")) * (F.col("mean") - F.col("grand")))
    within = F.sum(F.col("n") * F.col("var"))
    return both.agg(F.round(F.try_divide(between, between + within), 6).alias("eta2"))


def eta_by_chance(df: DataFrame, y: str, group: str, key: str, replicates: int = 200, seed: int = 42) -> DataFrame:
    """(replicate, eta2) with labels dealt at random over all rows with a y; none without such rows.

    One sort puts rows in random order; a group stands for a run of positions as long as its number of rows.  Each
    replicate maps position i to (a i + b) mod n with a prime to n, so its groups are random sets of the right sizes
    and no replicate sorts or joins: partial sums by replicate and group are all that is shuffled.  Equal keys fall
    in any order.  The starts of the groups, one number a group, go to every task.
    """
    rows = df.select(F.col(key), F.col(y).cast("double").alias("value"), F.col(group)).where(F.col("value").isNotNull())
    spark, empty = df.sparkSession, "replicate long, eta2 double"
    sizes = rows.groupBy(group).agg(F.count("*").alias("size"), F.sum("value").alias("total")).orderBy(group).collect()
    n = sum(r["size"] for r in sizes)
    if not n:
        return spark.createDataFrame([], empty)
    mean, starts = sum(r["total"] for r in sizes) / n, [0]
    for r in sizes[:-1]:
        starts.append(starts[-1] + r["size"])
    steps = F.array(*[F.struct(F.lit(i).cast("long").alias("replicate"), F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")) for i, (a, b) in enumerate(deals(n, replicates, seed))])
    placed = dense_index(rows.select(key, (F.col("value") - mean).alias("value")), [random_order(F.col(key), seed), F.col(key)])
    at = (F.col("s.a") * F.col("index") + F.col("s.b")) % n
    label = F.size(F.filter(F.array(*[F.lit(x).cast("long") for x in starts]), lambda x: x <= F.col("at")))
    dealt = placed.select("value", "index", F.explode(steps).alias("s")).select("value", "s.replicate", at.alias("at")).select("value", "replicate", label.alias("label"))
    by = dealt.groupBy("replicate", "label").agg(F.count("*").alias("n"), F.sum("value").alias("sum"), F.sum(F.col("value") * F.col("value")).alias("square"))
    return by.groupBy("replicate").agg(F.try_divide(F.sum(F.col("sum") * F.col("sum") / F.col("n")) - F.sum("sum") * F.sum("sum") / n, F.sum("square") - F.sum("sum") * F.sum("sum") / n).alias("eta2"))


def profile(df: DataFrame, group: str, price: str) -> DataFrame:
    """Size, share, share of houses and medians of each group."""
    values = {"m2_util": F.col("m2_util"), "dormitorios": F.col("dormitorios"), "price": F.col(price), "price_m2": F.try_divide(price, "m2_util")}
    made = grouped_medians(df, [group], values, (F.count("*").alias("n"), F.round(100 * F.avg((F.col("tipo") == "casa").cast("double")), 4).alias("pct_houses")))
    return made.withColumns({c: F.round(c, 4) for c in values}).withColumn("share", F.round(100.0 * F.col("n") / F.sum("n").over(W.partitionBy()), 4))


def least_share(df: DataFrame, group: str) -> DataFrame:
    """(group, n, share, is_least): the size of each group in rows and percent, and whether none is smaller."""
    rows = df.groupBy(group).agg(F.count("*").alias("n"))
    whole = W.partitionBy()
    return rows.withColumns({"share": F.round(100.0 * F.col("n") / F.sum("n").over(whole), 4), "is_least": F.col("n") == F.min("n").over(whole)})


def describe_price(df: DataFrame, group: str, price: str) -> DataFrame:
    """Count, quartiles, and the ratio of the group's median to the least median."""
    rows = grouped_quantiles(df, [group], {"q": F.col(price)}, [0.25, 0.5, 0.75]).withColumnRenamed("n_q", "n").select(group, "n", *[F.round(F.col("q")[i], 4).alias(f"p{p}") for i, p in enumerate((25, 50, 75))])
    return rows.withColumn("times_least", F.round(F.col("p50") / F.min("p50").over(W.partitionBy()), 6))


def composition(df: DataFrame, group: str, by: str) -> DataFrame:
    """(group, by, n, share, dominant): each group's make-up."""
    rows = df.groupBy(group, by).agg(F.count("*").alias("n"))
    w = W.partitionBy(group)
    first = F.row_number().over(w.orderBy(F.desc("n"), by)) == 1
    return rows.withColumns({"share": F.round(100.0 * F.col("n") / F.sum("n").over(w), 4), "dominant": first})


def centroid_outliers(df: DataFrame, p: float = 0.99) -> DataFrame:
    """Rows of clustered() beyond the percentile of the distance to their centre."""
    edge = exact_quantiles(df, F.col("centre_distance"), [p]).select(F.col("q")[0].alias("edge"))
    return df.crossJoin(F.broadcast(edge)).where(F.col("centre_distance") > F.col("edge")).drop("edge")


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts with margins; a null label stands for all."""
    return df.cube(a, b).agg(F.count("*").alias("n"), F.grouping_id().alias("level"))
