"""Ratio studies: errors of predictions by mass-appraisal standards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hearth.functions.order import exact_quantiles, grouped_medians

MEASURES = ["n", "mdape", "ppe10", "ppe20", "cod", "prd", "r2", "mae"]


def errors(df: DataFrame, y: str = "y", p: str = "pred") -> DataFrame:
    """Rows with finite values and y > 0, with ape and ratio."""
    ok = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    rows = df.where(ok(y) & ok(p) & (F.col(y) > 0))
    return rows.withColumns({"ape": F.abs(F.col(p) - F.col(y)) / F.col(y) * 100, "ratio": F.col(p) / F.col(y)})


def ratio_study(df: DataFrame, y: str = "y", p: str = "pred", by: tuple[str, ...] = ()) -> DataFrame:
    """n, MdAPE, PPE10, PPE20, COD, PRD, R2 and MAE, of all rows or by group (null is a group).

    Medians by rank selection first, then the deviations from them; df is read three times and should be a stored table.
    """
    rows = errors(df, y, p)
    names = [f"of_{c}" for c in by]
    first = grouped_medians(rows, list(by), {"mid": F.col("ratio"), "mdape": F.col("ape")}).withColumnsRenamed(dict(zip(by, names, strict=True)))
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(by, names, strict=True)]
    both = rows.crossJoin(F.broadcast(first)) if not by else rows.join(first, same)
    yy, pp = F.col(y), F.col(p)
    made = both.groupBy(*by).agg(
        F.count("*").alias("n"), F.first("mdape").alias("mdape"),
        (100 * F.avg((F.col("ape") <= 10 + 1e-9).cast("double"))).alias("ppe10"), (100 * F.avg((F.col("ape") <= 20 + 1e-9).cast("double"))).alias("ppe20"),
        (100 * F.avg(F.abs(F.col("ratio") - F.col("mid"))) / F.first("mid")).alias("cod"), (F.avg("ratio") / (F.sum(p) / F.sum(y))).alias("prd"),
        (1 - F.try_divide(F.sum((yy - pp) * (yy - pp)), F.var_pop(yy) * F.count("*"))).alias("r2"), F.avg(F.abs(yy - pp)).alias("mae"),
    )
    return made.select(*by, "n", *[F.round(m, 6).alias(m) for m in MEASURES[1:]])


def median_floor(train: DataFrame, test: DataFrame, y: str = "y") -> DataFrame:
    """The study of predicting the training median everywhere."""
    return ratio_study(test.crossJoin(F.broadcast(grouped_medians(train, [], {"floor": F.col(y)}))), y, "floor")


def by_segment(df: DataFrame, segments: list[str], y: str = "y", p: str = "pred") -> DataFrame:
    """(segment, value, n, mdape, ppe10, ratio) for the values of several columns, in one pass."""
    rows = errors(df, y, p)
    named = F.explode(F.array(*[F.struct(F.lit(s).alias("segment"), F.col(s).cast("string").alias("value")) for s in segments])).alias("s")
    long = rows.select("ape", "ratio", named)
    extra = (F.count("*").alias("n"), (100 * F.avg((F.col("ape") <= 10 + 1e-9).cast("double"))).alias("ppe10"))
    made = grouped_medians(long.select("ape", F.col("ratio").alias("r"), "s.*"), ["segment", "value"], {"mdape": F.col("ape"), "ratio": F.col("r")}, extra)
    return made.select("segment", "value", "n", *[F.round(c, 6).alias(c) for c in ("mdape", "ppe10", "ratio")])


def with_quantile(df: DataFrame, value: str, n: int = 5, name: str = "quantile") -> DataFrame:
    """df with the number (from 1) of its interval between interpolated quantiles, closed to the right; the lowest holds the minimum."""
    edges = exact_quantiles(df, F.col(value), [i / n for i in range(n + 1)]).select(F.col("q").alias("edges"))
    at = F.coalesce(*[F.when(F.col(value) <= F.col("edges")[i], i) for i in range(1, n + 1)])
    return df.crossJoin(F.broadcast(edges)).withColumn(name, at).drop("edges")


def by_quantile(df: DataFrame, y: str = "y", p: str = "pred", n: int = 5) -> DataFrame:
    """The study by quantile of the price."""
    return ratio_study(with_quantile(errors(df, y, p).drop("ape", "ratio"), y, n), y, p, ("quantile",))


def vertical_profile(df: DataFrame, y: str = "y", p: str = "pred") -> DataFrame:
    """MdAPE, COD and PRD, and the median ratio of the cheapest and the dearest fifth."""
    fifths = with_quantile(errors(df, y, p), y)
    ends = grouped_medians(fifths, [], {f"ratio_{n}": F.when(F.col("quantile") == k, F.col("ratio")) for k, n in ((1, "cheapest"), (5, "dearest"))})
    ends = ends.select(*[F.round(c, 6).alias(c) for c in ends.columns])
    return ratio_study(df, y, p).select("mdape", "cod", "prd").crossJoin(F.broadcast(ends))


def pick_winner(metrics: DataFrame, rule: str = "mdape", within: float = 0.25) -> DataFrame:
    """The best model of (model, mdape, prd): least MdAPE, or the PRD nearest 1 among those close to the least."""
    best = metrics.agg(F.min("mdape").alias("least"))
    near = metrics.crossJoin(F.broadcast(best)).where(F.col("mdape") <= F.col("least") + (within if rule == "prd" else 0.0))
    order = [F.abs(F.col("prd") - 1), "model"] if rule == "prd" else ["mdape", "model"]
    return near.drop("least").orderBy(*order).limit(1)


def compare_splits(grouped: DataFrame, random: DataFrame) -> DataFrame:
    """(metric, grouped, random, difference) of two one-row studies."""
    long = lambda df, name: df.select(*[F.col(m).cast("double").alias(m) for m in MEASURES]).unpivot([], MEASURES, "metric", name)
    return long(grouped, "grouped").join(long(random, "random"), "metric").withColumn("difference", F.round(F.col("random") - F.col("grouped"), 6))


def segment_error(df: DataFrame, segments: dict[str, Column], y: str = "y", p: str = "pred", min_n: int = 30) -> DataFrame:
    """(segment, n, mdape): the median error of each, or of all rows where it has too few."""
    rows = errors(df, y, p)
    made = grouped_medians(rows, [], {"all_": F.col("ape")} | {f"m_{s}": F.when(c, F.col("ape")) for s, c in segments.items()}, tuple(F.count_if(c).alias(f"k_{s}") for s, c in segments.items()))
    one = [F.struct(F.lit(s).alias("segment"), F.col(f"k_{s}").alias("n"), F.round(F.when(F.col(f"k_{s}") >= min_n, F.col(f"m_{s}")).otherwise(F.col("all_")), 6).alias("mdape")) for s in segments]
    return made.select(F.explode(F.array(*one)).alias("r")).select("r.*")


def acceptance(study: DataFrame) -> DataFrame:
    """(rule, ok, value) of a one-row study against the published bands."""
    rules = [("mdape_good", F.col("mdape") < 15, "mdape"), ("mdape_excellent", F.col("mdape") < 10, "mdape"), ("ppe10", F.col("ppe10") > 50, "ppe10"), ("cod", F.col("cod").between(5, 15), "cod"), ("prd", F.col("prd").between(0.98, 1.03), "prd")]
    return study.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), ok.alias("ok"), F.col(v).alias("value")) for n, ok, v in rules])).alias("r")).select("r.*")


def implied_sigma(mdape: Column) -> Column:
    """Deviation of the log error that gives this median error, if it is normal."""
    return mdape / 100 / 0.6745


def histogram(df: DataFrame, value: str, lo: float, hi: float, bins: int = 60) -> DataFrame:
    """(bin, n) of equal bins over [lo, hi]; only the last is closed to the right, values outside don't count."""
    at = F.least(F.floor((F.col(value) - lo) / ((hi - lo) / bins)), F.lit(bins - 1)).cast("int")
    return df.where(F.col(value).between(lo, hi)).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))


def group_median_gain(df: DataFrame, group: str, y: str = "y") -> DataFrame:
    """MdAPE of predicting each group's median, and of predicting the median of all."""
    rows = df.where(F.col(y) > 0)
    medians = grouped_medians(rows, [group], {"group_median": F.col(y)})
    both = rows.join(medians, group).crossJoin(F.broadcast(grouped_medians(rows, [], {"all_median": F.col(y)})))
    ape = lambda p: F.abs(F.col(p) - F.col(y)) / F.col(y) * 100
    made = grouped_medians(both, [], {"a": ape("all_median"), "g": ape("group_median")})
    return made.select(F.round("a", 6).alias("mdape_all"), F.round("g", 6).alias("mdape_group"), F.round(F.col("a") - F.col("g"), 6).alias("gain"))


def top_rows(df: DataFrame, by: str, k: int = 15) -> DataFrame:
    return df.orderBy(F.desc(by)).limit(k)


def rank_within(df: DataFrame, by: list[str], order: list) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(*order)))
