"""The composed job against what the scan was made from: twelve stems of known place and taper per plot."""

import numpy as np
import pandas as pd
import pytest

from arborframe.operators import report
from arborframe.plans import queries_jobs as qj
from arborframe.plans.registry import Views

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    out = qj.chain(Views(spark, SF))
    return {k: out[k].toPandas() for k in ("trees", "taper", "cylinders", "rejected", "plot_summary", "report", "report_trees")}


def stem(tree):
    """Place at breast height, ground height and diameter of true stem 0..11."""
    x, y = tree % 4 * 5.0 - 7.5, tree // 4 * 5.0 - 5.0
    return x + tree % 3 / 50 * 1.3, y, x / 20, 2 * (0.16 - 1.3 / 9 * 0.08)


def test_trees_stand_where_the_stems_are(tables):
    trees = tables["trees"]
    truth = np.array([stem(t) for t in range(12)])
    assert len(trees) >= 12 and trees["plot_id"].nunique() == 4  # the scan is sparse: most stems lack points for five cylinders
    for _, plot in trees.groupby("plot_id"):
        gaps = np.hypot(plot["tree_x"].to_numpy()[:, None] - truth[:, 0], plot["tree_y"].to_numpy()[:, None] - truth[:, 1])
        which = gaps.argmin(axis=1)
        assert gaps.min(axis=1).max() < 0.3
        assert len(set(which)) == len(which)
        assert np.abs(plot["tree_z"] - truth[which, 2]).max() < 0.6
        assert np.abs(plot["dbh_taper"] / 1000 - truth[which, 3]).max() < 0.06
        assert sorted(plot["tree_number"]) == list(range(1, len(plot) + 1))


def test_every_tree_is_numbered_or_rejected_with_a_reason(tables):
    cylinders, trees, rejected = tables["cylinders"], tables["trees"], tables["rejected"]
    key = lambda df: set(zip(df["plot_id"], df["tree_id"]))
    assert key(cylinders) == key(trees) | key(rejected) and not key(trees) & key(rejected)
    assert set(rejected["reason"]) <= {"base", "outside", "taper", "diameter"}
    coded = cylinders[cylinders["tree_number"] == -1]
    assert key(coded) == key(rejected)


def test_plot_summary_has_its_columns_and_follows_the_trees(tables):
    summary = tables["plot_summary"].set_index("PlotId")
    assert tuple(tables["plot_summary"].columns) == report.SUMMARY_COLUMNS and len(report.SUMMARY_COLUMNS) == 50
    assert len(summary) == 5 and summary.index.is_unique
    measures = {"DBH": "dbh_taper", "Height": "height", "Volume": "volume", "Volume 2": "volume_2"}
    for plot, row in summary.iterrows():
        trees = tables["trees"][tables["trees"]["plot_id"].astype(str) == plot]
        assert row["Num Trees in Plot"] == len(trees)
        assert row["Stems/ha"] == pytest.approx(round(len(trees) / row["Plot Area"], 1))
        for name, column in measures.items():
            for how in ("mean", "median", "min", "max"):
                assert row[f"{how.title()} {name}"] == pytest.approx(trees[column].agg(how) if len(trees) else 0.0)
        assert row["Total Volume"] == pytest.approx(trees["volume"].sum())
        if len(trees):  # ground rises by one in twenty along x
            assert row["Avg Gradient X"] == pytest.approx(np.degrees(np.arctan(1 / 20)), abs=0.5)
            assert row["Num Points Original PC"] > row["Num Points Trimmed PC"] > row["Num Stem Points"] > 0
            assert 0 < row["Canopy Cover Fraction"] < 1
    assert (summary["Total Run Time (s)"] > 0).all()


def test_report_tables(tables):
    assert (tables["report"].groupby("plot_id").size() == 21).all()
    assert len(tables["report_trees"]) == len(tables["trees"])
    lines = tables["report"].set_index(["plot_id", "attribute"])["min_value"]
    counted = tables["trees"].groupby("plot_id").size()
    assert all(int(float(lines[(p, "Trees")])) == n for p, n in counted.items())


def test_summary_of_a_plot_without_facts(spark):
    facts = spark.createDataFrame([("p", 1.0, 2.0, 0.0, 0.0, None, 1.3, None, None, None)], "plot_id string, cx double, cy double, plot_radius double, plot_radius_buffer double, area_ha double, dbh_height double, canopy_fraction double, understory_fraction double, cwd_fraction double")
    trees = spark.createDataFrame([], "plot_id string, dbh_taper double, height double, volume double, volume_2 double")
    row = report.plot_summary(facts, trees).toPandas()
    assert row["PlotId"][0] == row["Point Cloud Filename"][0] == "p"
    assert not row.drop(columns=["PlotId", "Point Cloud Filename", "Plot Centre X", "Plot Centre Y", "DBH_height"]).to_numpy().any()
    assert not pd.isna(row).to_numpy().any()
