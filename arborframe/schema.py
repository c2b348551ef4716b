"""Table layouts."""

from __future__ import annotations

from pyspark.sql import types as T

_D, _I, _L, _F, _S = T.DoubleType(), T.IntegerType(), T.LongType(), T.FloatType(), T.StringType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


# Fixed storage types of point dimensions, by attribute name.
DIMENSION_TYPES: dict[str, T.DataType] = {
    "x": _D, "y": _D, "z": _D,
    "intensity": _I, "return_number": _I, "number_of_returns": _I, "gps_time": _D, "classification": _I,
    "red": _I, "green": _I, "blue": _I,
    "ring": T.ShortType(), "range": _F, "label": T.ShortType(), "cci": T.ShortType(), "tree_id": _I,
}
OTHER_DIMENSION = _F

POINTS = _struct(
    plot_id=_S, point_id=_L, x=_D, y=_D, z=_D, intensity=_I, return_number=_I, number_of_returns=_I,
    gps_time=_D, ring=_I, range=_F, classification=_I,
)
SEGMENTED = T.StructType(POINTS.fields + _struct(label=_I, hag=_D, height_class=_I).fields)
VOTES = _struct(plot_id=_S, vote_id=_L, x=_D, y=_D, z=_D, p0=_D, p1=_D, p2=_D, p3=_D)
DTM = _struct(plot_id=_S, gx=_I, gy=_I, x=_D, y=_D, z=_D)
DEM = _struct(plot_id=_S, xx=_D, yy=_D, zz=_D)
SKELETON = _struct(plot_id=_S, slice_id=_I, cluster_id=_L, x=_D, y=_D, z=_D, segment_id=_L)
CYLINDERS = _struct(
    plot_id=_S, cyl_id=_L, x=_D, y=_D, z=_D, nx=_D, ny=_D, nz=_D, radius=_D, cci=_D, branch_id=_L,
    parent_branch_id=_L, tree_id=_L, height_above_dtm=_D, main_stem=_I,
)
TAPER = _struct(
    plot_id=_S, tree_id=_L, base_x=_D, base_y=_D, height=_D, height_bin=_D, ma_diameter=_D, bin_x=_D, bin_y=_D,
    s_count=_L, ns_count=_L, pruned=_I, cci=_D,
)
GLYPHS = _struct(ch=_S, row=_I, col=_I)
