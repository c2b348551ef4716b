"""Stem straightness class from the taper (sweep against small-end diameter)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborframe.functions import geometry as geo

TREE = ("plot_id", "tree_id")
NO_SCORE, EXCEPTION, REGEN = "no score", "exception", "regen"


def key_rows(taper: DataFrame) -> DataFrame:
    """Bottom, top and furthest row per tree, positions relative to the lowest bin."""
    row = F.struct("height_bin", "bin_x", "bin_y", "ma_diameter")
    base = taper.groupBy(*TREE).agg(F.min_by("bin_x", "height_bin").alias("_bx"), F.min_by("bin_y", "height_bin").alias("_by"))
    rel = taper.join(base, list(TREE)).select(
        *TREE, "height_bin", "ma_diameter", (F.col("bin_x") - F.col("_bx")).alias("x"), (F.col("bin_y") - F.col("_by")).alias("y")
    )
    dist = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y"))
    row = F.struct("height_bin", "x", "y", dist.alias("dist"), (F.col("ma_diameter") / 2.0).alias("r"))
    return rel.groupBy(*TREE).agg(
        F.min_by(row, "height_bin").alias("b"),
        F.max_by(row, "height_bin").alias("t"),
        F.max_by(row, F.struct(dist, (-F.col("height_bin")).alias("_o"))).alias("m"),
    )


def furthest_cylinder(taper: DataFrame) -> DataFrame:
    rows = key_rows(taper)
    kinds = F.explode(F.array(*[F.struct(F.lit(n).alias("kind"), F.col(c).alias("row")) for c, n in (("b", "bottom"), ("t", "top"), ("m", "furthest"))]))
    return rows.select(*TREE, kinds.alias("k")).select(*TREE, "k.kind", "k.row.*")


def _xy(s: str) -> list[Column]:
    return [F.col(f"{s}.x"), F.col(f"{s}.y")]


def straightness(taper: DataFrame) -> DataFrame:
    """Sweep ratio and class per tree.

    The furthest row gives way to the top row when both are equally far. Trees whose
    bottom is their furthest point, or where a branch was read as stem, get no score.
    """
    rows = key_rows(taper)
    f = F.when(F.col("t.dist") >= F.col("m.dist"), F.col("t")).otherwise(F.col("m"))
    rows = rows.withColumn("f", f)
    t1 = 0.3 * 2.0 * F.col("b.r")
    t2 = 0.1 * 2.0 * F.col("f.r")

    def beyond(s: str, margin: Column) -> Column:
        return (F.abs(f"{s}.x") + margin < F.abs("t.x")) & (F.abs(f"{s}.y") + margin < F.abs("t.y"))

    branch = beyond("b", t1) & ~beyond("f", t2)
    bf = geo.norm(geo.minus(_xy("f"), _xy("b")))
    c = F.try_divide(F.abs(F.col("f.x") - F.col("b.x")), bf)

    def edge(s: str) -> list[Column]:
        return list(geo.edge_coord(F.col("_c"), F.col(f"{s}.x"), F.col(f"{s}.y"), F.col(f"{s}.r"), F.col("t.x"), F.col("t.y")))

    out = rows.withColumn("_branch", branch).withColumn("_c", c)
    be, te = edge("b"), edge("t")
    same = F.col("t.dist") >= F.col("m.dist")
    me = [F.when(same, p).otherwise(q) for p, q in zip(te, edge("m"))]
    cols = {"_bx": be[0], "_by": be[1], "_tx": te[0], "_ty": te[1], "_mx": me[0], "_my": me[1]}
    out = out.withColumns(cols)
    bz, tz, mz = F.col("b.height_bin"), F.col("t.height_bin"), F.col("m.height_bin")
    top, bottom = [F.col("_tx"), F.col("_ty"), tz], [F.col("_bx"), F.col("_by"), bz]
    d = geo.norm(geo.minus(top, bottom))
    e = geo.norm(geo.minus(top[:2], bottom[:2]))
    phi = F.acos(geo.clip(F.try_divide(F.sqrt(F.greatest(d * d - e * e, F.lit(0.0))), d), -1.0, 1.0))
    h = F.when(tz == mz, tz / 10000.0).otherwise(tz - mz)
    out = out.withColumn("_phi", phi).withColumn("_h", h)
    slant = F.try_divide(F.col("_h"), F.cos("_phi"))
    reach = F.sqrt(F.greatest(slant * slant - F.col("_h") * F.col("_h"), F.lit(0.0)))
    far = [F.col("_mx"), F.col("_my"), mz]
    p = geo.point_on_line_at_height(top, bottom, mz)
    q = geo.point_along(p, far, reach)
    out = out.withColumn("_sweep", geo.norm(geo.minus(q[:2], far[:2])))
    ratio = F.when(~F.col("_branch") & F.col("_c").isNotNull(), F.try_divide(F.col("_sweep"), 2.0 * F.col("t.r")))
    return out.select(*TREE, ratio.alias("ratio"), tz.alias("top_height")).withColumn(
        "straightness", straightness_class(F.col("ratio"), F.col("top_height"))
    )


def straightness_class(ratio: Column, height: Column) -> Column:
    tall = F.when(ratio < 1 / 8, "8").when(ratio < 1 / 6, "6").when(ratio < 1 / 5, "L").otherwise(EXCEPTION)
    middle = F.when(ratio < 1 / 5, "S").when(ratio < 1 / 3, "3")
    return (
        F.when(ratio.isNull(), NO_SCORE)
        .when(ratio >= 1 / 2, "1")
        .when(height > 6, tall)
        .when(height > 4, middle)
        .otherwise(REGEN)
    )
