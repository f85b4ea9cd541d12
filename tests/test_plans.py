"""Physical plans: what reaches the scan, and which joins never appear."""

import pytest

from gridloom.operators import fill, focal, resample, tiled
from gridloom.plans import queries

SMALL = "/root/testdata/sf0.001"
#: These run jobs while they're built.
EAGER = {n for n in queries.QUERIES if n.startswith(("c1", "c2", "c3", "l3", "l4", "l7", "b2", "m1"))}


def plan(spark, name):
    return queries.QUERIES[name](spark, SMALL)._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - EAGER))
def test_no_cartesian_product(spark, name):
    assert "CartesianProduct" not in plan(spark, name)


def test_focal_joins_are_by_key(spark, monkeypatch):
    df = spark.createDataFrame([("a", 0, 0, 1.0), ("b", 0, 0, 2.0)], "raster_id string, r int, c int, z double")
    monkeypatch.setattr(focal, "BROADCAST_RASTERS", 0)  # the shuffled join, too
    made = [focal.box_statistics(df, "z", 5), focal.with_second_derivatives(df, "z", 10.0), focal.tri(df, "z"), resample.downsample(df, "z"), tiled.focal_features(df, "z"), fill.median_fill(df, "z"), fill.nearest_fill(df, "z")]
    for x in made:
        assert "NestedLoop" not in x._jdf.queryExecution().toString()


@pytest.mark.parametrize(
    ("name", "columns"),
    [("a15_region_area", "o_orderkey,o_custkey,o_totalprice"), ("f2_prefix", "p_partkey,p_type"), ("w13_trailing_mean", "event_id,ts,user_id,event_type,value"), ("a20_status_tally", "o_orderstatus"), ("j12_skipped", "c_custkey")],
)
def test_scans_read_only_what_is_used(spark, name, columns):
    schemas = [line.rpartition("ReadSchema: struct<")[2].rstrip(">\n") for line in plan(spark, name).split("\n") if "ReadSchema" in line]
    read = {c.partition(":")[0] for s in schemas for c in s.split(",")}
    assert read and set(columns.split(",")) >= read - {"o_custkey"}


@pytest.mark.parametrize(("name", "pushed"), [("f2_prefix", "StringStartsWith(p_type"), ("f8_excluded", "Not(In(n_name"), ("f13_search", "IsNotNull(c_name)"), ("f9_clip", "EqualTo(n_regionkey,2)")])
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in plan(spark, name)


@pytest.mark.parametrize("name", ["w1_box_mean_3", "w1_box_mean_21"])
def test_shuffles_do_not_grow_with_the_box(spark, name):
    lines = plan(spark, name).rpartition("== Physical Plan ==")[2].split("\n")
    assert sum("Exchange hashpartitioning" in x for x in lines) <= 8
