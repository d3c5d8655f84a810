"""Physical plans: pruned and filtered scans, limits before shuffles, no Python where none is needed, no cartesian products."""

import pytest

from contigloom.plans import catalog

PYTHON_FREE = sorted(set(catalog.ORACLES) - {"overlap_resolution"})  # that one is a fold


def plan(spark, sf_dir, name):
    return catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PYTHON_FREE)
def test_sql_queries_stay_in_the_jvm(spark, sf_dir, name):
    p = plan(spark, sf_dir, name)
    assert "InPandas" not in p and "ArrowEvalPython" not in p and "BatchEvalPython" not in p
    if name not in ("matrix_completion", "assembly_stats", "repeat_contigs_global", "relative_rate_distance", "average_rate_distance", "window_counts", "window_moments", "median_arrival_intdiv", "nb_dispersion", "nb_dispersion_trimmed", "dispersed_variance"):  # squares of keys, or one row or a row per sample on one side
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_scans_read_what_they_need(spark, sf_dir):
    assert "ReadSchema: struct<lang:string,n_chars:bigint>" in plan(spark, sf_dir, "nx_lx_by_lang").replace("struct<n_chars:bigint,lang:string>", "struct<lang:string,n_chars:bigint>")
    p = plan(spark, sf_dir, "anti_semi_contigs")
    assert "EqualTo(l_returnflag,R)" in p and "GreaterThan(l_quantity,45.0)" in p


def test_top_k_is_limited_before_the_shuffle(spark, sf_dir):
    assert "WindowGroupLimit" in plan(spark, sf_dir, "top5_references")


def test_aggregates_combine_before_the_shuffle(spark, sf_dir):
    for name in ("nx_lx_by_lang", "window_counts", "distance_distribution", "depth_profile"):
        assert "partial_" in plan(spark, sf_dir, name)
