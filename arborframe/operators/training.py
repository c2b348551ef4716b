"""Selection and cleaning of labelled plots for training samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborframe.lineage import cut_lineage
from arborframe.operators.clean import STEM, VEGETATION

QUARTILES = (0.25, 0.5, 0.75)


def stem_share(points: DataFrame) -> DataFrame:
    return points.groupBy("plot_id").agg(F.avg((F.col("label") == STEM).cast("double")).alias("stem_share"))


def iqr_bounds(rows: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    q = F.percentile(value, F.array(*[F.lit(p) for p in QUARTILES]))
    grouped = rows.groupBy(*(by or [])).agg(q.alias("_q"))
    q1, q2, q3 = [F.col("_q")[i] for i in range(3)]
    return grouped.select(
        *(by or []), q1.alias("q1"), q2.alias("q2"), q3.alias("q3"),
        (q1 - 1.5 * (q3 - q1)).alias("lower"), (q3 + 1.5 * (q3 - q1)).alias("upper"),
    )


def outliers_iqr(rows: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Flag values outside the 1.5 IQR fences of their group."""
    out = rows.join(iqr_bounds(rows, value, by), by)
    v = F.col(value)
    return out.select(*rows.columns, ((v < F.col("lower")) | (v > F.col("upper"))).alias("outlier"))


def select_by_stem_share(shares: DataFrame) -> DataFrame:
    """Plots whose share is above the median and below the upper fence."""
    fences = iqr_bounds(shares, "stem_share")
    # one row of bounds; the join has no key because the bounds cover all plots
    out = shares.withColumn("_k", F.lit(1)).join(fences.withColumn("_k", F.lit(1)), "_k")
    return out.filter((F.col("stem_share") > F.col("q2")) & (F.col("stem_share") < F.col("upper"))).select(*shares.columns)


def class_height_stats(points: DataFrame, classes: tuple[int, ...] = (VEGETATION, STEM)) -> DataFrame:
    """Quartiles, mean and population deviation of z per plot and class.

    Equal heights are counted first, so percentile buffers hold distinct values only.
    """
    rows = points.filter(F.col("label").isin(*classes))
    moments = rows.groupBy("plot_id", "label").agg(
        F.avg("z").alias("mean_z"), F.stddev_pop("z").alias("std_z"), F.min("z").alias("min_z"), F.max("z").alias("max_z")
    )
    counted = rows.groupBy("plot_id", "label", "z").agg(F.count(F.lit(1)).alias("_n"))
    q = counted.groupBy("plot_id", "label").agg(
        F.percentile("z", F.array(*[F.lit(p) for p in QUARTILES]), F.col("_n")).alias("_q")
    )
    names = [F.col("_q")[i].alias(n) for i, n in enumerate(("q25", "q50", "q75"))]
    return q.join(moments, ["plot_id", "label"]).select("plot_id", "label", *names, "mean_z", "std_z", "min_z", "max_z")


def _by_class(stats: DataFrame) -> DataFrame:
    cols = [c for c in stats.columns if c not in ("plot_id", "label")]
    pick = [
        F.max(F.when(F.col("label") == k, F.col(c))).alias(f"{n}_{c}") for k, n in ((STEM, "s"), (VEGETATION, "v")) for c in cols
    ]
    return stats.groupBy("plot_id").agg(*pick)


def pdf_intersection(stats: DataFrame) -> DataFrame:
    """Height where the normal densities of stem and canopy cross, nearest the middle of the means."""
    w = _by_class(stats)
    m1, s1, m2, s2 = [F.col(c) for c in ("s_mean_z", "s_std_z", "v_mean_z", "v_std_z")]
    a = 1.0 / (s1 * s1) - 1.0 / (s2 * s2)
    b = -2.0 * (m1 / (s1 * s1) - m2 / (s2 * s2))
    c = m1 * m1 / (s1 * s1) - m2 * m2 / (s2 * s2) + 2.0 * F.log(s1 / s2)
    mid = (m1 + m2) / 2.0
    root = F.sqrt(F.greatest(b * b - 4.0 * a * c, F.lit(0.0)))
    r1, r2 = F.try_divide(-b + root, 2.0 * a), F.try_divide(-b - root, 2.0 * a)
    best = F.when(F.abs(a) < 1e-12, F.try_divide(-c, b)).when(F.abs(r1 - mid) <= F.abs(r2 - mid), r1).otherwise(r2)
    return w.select("plot_id", best.alias("crossing_z"))


def ambiguous_band(stats: DataFrame, steps: int = 200, margin: float = 0.05) -> DataFrame:
    """Height band in which stem and canopy mix.

    The overlap is the part of ``steps`` evenly spaced heights (data range widened by
    ``margin``) where both densities are positive.
    """
    w = _by_class(stats)
    lo, hi = F.least("s_min_z", "v_min_z"), F.greatest("s_max_z", "v_max_z")
    w = w.withColumns({"_lo": lo - (hi - lo) * margin, "_hi": hi + (hi - lo) * margin})
    grid = w.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))))
    grid = grid.withColumn("_x", F.col("_lo") + F.col("_i") * (F.col("_hi") - F.col("_lo")) / (steps - 1))

    def positive(n: str):
        z = (F.col("_x") - F.col(f"{n}_mean_z")) / F.col(f"{n}_std_z")
        return F.exp(-z * z / 2.0) / F.col(f"{n}_std_z") > 0

    over = grid.filter(positive("s") & positive("v")).groupBy("plot_id").agg(
        F.percentile("_x", F.lit(0.25)).alias("_o25"), F.percentile("_x", F.lit(0.75)).alias("_o75")
    )
    out = w.join(over, "plot_id")
    return out.select(
        "plot_id", F.greatest("s_q75", "_o25").alias("band_lo"), F.least("v_q25", "_o75").alias("band_hi")
    )


def drop_band(points: DataFrame, bands: DataFrame) -> DataFrame:
    """Points outside their plot's ambiguous band."""
    out = points.join(cut_lineage(bands), "plot_id")
    return out.filter(~((F.col("z") >= F.col("band_lo")) & (F.col("z") <= F.col("band_hi")))).select(*points.columns)


def dropped_ratio(points: DataFrame, bands: DataFrame) -> DataFrame:
    inside = ((F.col("z") >= F.col("band_lo")) & (F.col("z") <= F.col("band_hi"))).cast("double")
    return points.join(cut_lineage(bands), "plot_id").groupBy("plot_id").agg(F.avg(inside).alias("dropped_ratio"))
