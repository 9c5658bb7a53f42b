"""Report queries and data-quality expectations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hearth.functions.order import exact_quantiles, grouped_medians
from hearth.sources.scratch import stored

COMMUNES = ["la-florida", "macul", "nunoa", "san-miguel"]
KINDS = ["casa", "departamento"]


def volume(df: DataFrame) -> DataFrame:
    done = F.sum(F.coalesce("detalle_ok", F.lit(0)))
    return df.agg(F.count("*").alias("total"), done.alias("with_detail"), F.round(100.0 * done / F.count("*"), 4).alias("pct"))


def counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def year_by_commune(df: DataFrame) -> DataFrame:
    """Publication year by commune with row totals; undated rows have a null year."""
    table = df.groupBy(F.year(F.col("fecha_publicacion").try_cast("date")).alias("year")).pivot("comuna", COMMUNES).agg(F.count(F.lit(1)))
    filled = table.na.fill(0, COMMUNES)
    return filled.select("year", *[F.col(f"`{c}`").alias(c.replace("-", "_")) for c in COMMUNES], sum(F.col(f"`{c}`") for c in COMMUNES).alias("total"))


def market_medians(df: DataFrame) -> DataFrame:
    """Median sale price, sale price a square metre and rent of each commune and kind; empty cells stay in."""
    sale = (F.col("operacion") == "venta") & F.col("precio_uf").isNotNull()
    values = {"sale_uf": F.when(sale, F.col("precio_uf")), "sale_uf_m2": F.when(sale & (F.col("m2_util") > 10), F.col("precio_uf") / F.col("m2_util")), "rent_clp": F.when(F.col("operacion") == "arriendo", F.col("precio_clp"))}
    made = grouped_medians(df, ["comuna", "tipo"], values, (F.count("*").alias("n"),)).withColumns({c: F.round(c, 4) for c in values})
    dim = df.sparkSession.createDataFrame([(c, t) for c in COMMUNES for t in KINDS], "comuna string, tipo string")
    return dim.join(made, ["comuna", "tipo"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def latest_example(df: DataFrame, cols: list[str]) -> DataFrame:
    """The latest fully filled listing of each commune, or else the latest of any kind."""
    is_full = sum(F.col(c).isNull().cast("int") for c in cols) == 0
    w = W.partitionBy("comuna").orderBy(F.desc("is_full"), F.desc("id_aviso"))
    return df.withColumn("is_full", is_full).withColumn("nth", F.row_number().over(w)).where("nth = 1").drop("nth")


def ingest_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("sitio", "comuna", "operacion", "tipo").agg(F.count("*").alias("n"), F.sum(F.coalesce("detalle_ok", F.lit(0))).alias("with_detail"))


def subtotals(df: DataFrame) -> DataFrame:
    return df.rollup("comuna", "operacion", "tipo").agg(F.count("*").alias("n"), F.grouping_id().alias("level"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def mirror_parity(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """(rows_a, rows_b, only_a, only_b): two copies compared as multisets of keys."""
    one = lambda df, name: df.agg(F.count("*").alias(name))
    x, y = a.select(*key), b.select(*key)
    return one(x, "rows_a").crossJoin(one(y, "rows_b")).crossJoin(one(x.exceptAll(y), "only_a")).crossJoin(one(y.exceptAll(x), "only_b"))


def nulls(df: DataFrame) -> DataFrame:
    """Real nulls in all columns together: a raw table holds none, only the sentinel."""
    return df.agg(sum(F.sum(F.col(c).isNull().cast("long")) for c in df.columns).alias("n_nulls"))


def rate_stability(df: DataFrame, reference: float | None = None, within: float = 1.0) -> DataFrame:
    """Quartiles of the implied rate, and whether their range is below a hundredth of the median; with a reference, whether the median is near it."""
    ratio = F.when(F.col("precio_uf") > 0, F.col("precio_clp") / F.col("precio_uf"))
    made = exact_quantiles(df, ratio, [0.25, 0.5, 0.75])
    near = [] if reference is None else [(F.abs(F.col("q")[1] - reference) <= within).alias("near")]
    return made.select(*[F.round(F.col("q")[i], 6).alias(f"p{p}") for i, p in enumerate((25, 50, 75))], ((F.col("q")[2] - F.col("q")[0]) < F.col("q")[1] / 100).alias("stable"), *near)


def snapshot_dates(df: DataFrame) -> DataFrame:
    return df.agg(F.count_distinct("fecha_scrape").alias("n_dates"), (F.count_distinct("fecha_scrape") <= 5).alias("short"))


def expectations(df: DataFrame, rules: list[tuple[str, Column, str]]) -> DataFrame:
    """(check, ok, severity, detail) of rules (name, aggregate condition, severity), in one pass."""
    made = df.agg(*[F.coalesce(ok, F.lit(False)).alias(f"r{i}") for i, (_, ok, _) in enumerate(rules)])
    rows = [F.struct(F.lit(n).alias("check"), F.col(f"r{i}").alias("ok"), F.lit(s).alias("severity"), F.when(F.col(f"r{i}"), "").otherwise(f"{n} does not hold").alias("detail")) for i, (n, _, s) in enumerate(rules)]
    return made.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def audited(df: DataFrame, rules: list[tuple[str, Column, str]]) -> tuple[DataFrame, DataFrame]:
    """(df as a stored table, its checks as expectations() gives them): all rules are observed while the table is written, in the one scan that it takes.

    Rules are aggregates without distinct counts.
    """
    seen = Observation()
    table = stored(df.observe(seen, *[F.coalesce(ok, F.lit(False)).alias(f"r{i}") for i, (_, ok, _) in enumerate(rules)]))
    held = seen.get
    rows = [(n, held[f"r{i}"], s, "" if held[f"r{i}"] else f"{n} does not hold") for i, (n, _, s) in enumerate(rules)]
    return table, df.sparkSession.createDataFrame(rows, "check string, ok boolean, severity string, detail string")


def severity_summary(checks: DataFrame) -> DataFrame:
    return checks.groupBy("severity", "ok").agg(F.count("*").alias("n"))


def same_metrics(study: DataFrame, card: DataFrame, tolerance: dict[str, float]) -> DataFrame:
    """(metric, found, published, ok) of a one-row study and a card (metric, value)."""
    names = list(tolerance)
    long = study.select(*[F.col(n).cast("double").alias(n) for n in names]).unpivot([], names, "metric", "found")
    limit = F.create_map(*[F.lit(x) for p in tolerance.items() for x in p])
    return long.join(card.select("metric", F.col("value").alias("published")), "metric").withColumn("ok", F.abs(F.col("found") - F.col("published")) <= limit[F.col("metric")])


def frame_parity(a: DataFrame, b: DataFrame, key: list[str], cols: list[str], tolerance: float = 1e-9) -> DataFrame:
    """(column, n_different) of two frames with the same keys; null equals null."""
    both = a.select(*key, *[F.col(c).alias(f"a_{c}") for c in cols]).join(b.select(*key, *[F.col(c).alias(f"b_{c}") for c in cols]), key)
    same = lambda c: F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")) | F.coalesce(F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")) <= tolerance, F.lit(False))
    return both.agg(*[F.count_if(~same(c)).alias(c) for c in cols]).unpivot([], cols, "column", "n_different")


def monotone_share(before: DataFrame, after: DataFrame, key: str, value: str = "pred") -> DataFrame:
    """(share): percent of rows whose prediction rises."""
    both = before.select(key, F.col(value).alias("p1")).join(after.select(key, F.col(value).alias("p2")), key)
    return both.agg((100 * F.avg((F.col("p2") > F.col("p1")).cast("double"))).alias("share"))


def largest_change(before: DataFrame, after: DataFrame, key: str, value: str = "pred") -> DataFrame:
    """(largest): the greatest difference of two scorings; 0 if an added column changes nothing."""
    both = before.select(key, F.col(value).alias("p1")).join(after.select(key, F.col(value).alias("p2")), key)
    return both.agg(F.max(F.abs(F.col("p2") - F.col("p1"))).alias("largest"))


def implausible(df: DataFrame, value: str, lo: float, hi: float) -> DataFrame:
    """Rows, and those whose value is missing, infinite or out of range."""
    return df.agg(F.count("*").alias("n"), F.count_if(~F.coalesce(F.col(value).between(lo, hi), F.lit(False))).alias("n_bad"))


def params_agreement(a: DataFrame, b: DataFrame, cols: list[str]) -> DataFrame:
    """(column, equal) of two one-row tables of model parameters."""
    both = a.select(*[F.col(c).alias(f"a_{c}") for c in cols]).crossJoin(b.select(*[F.col(c).alias(f"b_{c}") for c in cols]))
    return both.select(*[F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")).alias(c) for c in cols]).unpivot([], cols, "column", "equal")


def outside(df: DataFrame, point: str = "pred", lo: str = "lo", hi: str = "hi") -> DataFrame:
    """(n, n_outside): rows, and those whose estimate its own range does not hold."""
    return df.agg(F.count("*").alias("n"), F.count_if(~F.coalesce(F.col(point).between(F.col(lo), F.col(hi)), F.lit(False))).alias("n_outside"))


def enriched(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """(n_before, n_after, pct): rows before and after an enrichment, and the percent that hold its column."""
    share = F.round(100 * F.avg(F.col(column).isNotNull().cast("double")), 6)
    return before.agg(F.count("*").alias("n_before")).crossJoin(after.agg(F.count("*").alias("n_after"), share.alias("pct")))
