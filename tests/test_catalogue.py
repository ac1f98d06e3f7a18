import pytest
from oracle import compare, connect

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
CHECKED = [
    "clean_profile", "numeric_summary", "iqr_report", "hist_group20", "violin_stats", "box_before_after",
    "crosstab_pct", "strat_split", "strat_folds", "gnb_predict", "class_report", "top_factors", "waterfall",
    "score_batch", "stream_dedup", "quantiles_selected", "quantiles_selected_groups", "box_null_group",
    "violin_constant_group", "hist_heavy_tail", "crosstab_customers", "one_hot_parts", "label_encode_nulls",
    "score_with_gaps", "records_in_order", "train_nb", "explain_trained", "stream_score_saved", "dedup_rows",
    "boost_leafwise", "boost_softmax", "boost_symmetric", "ordered_target_stats", "target_stats_whole", "knn_lsh",
    "corr_wide", "exact_tree", "calibration_bins", "kernel_error", "stream_dedup_all",
]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, con, name):
    diff, _ = compare(spark, con, SF, name, contract.queries()[name], contract.oracle_sql()[name])
    assert diff == ""


def test_every_counterpart_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
