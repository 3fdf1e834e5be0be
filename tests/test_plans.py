"""Shape of the physical plans of queries on the supplied tables."""

import re
from pathlib import Path

import pytest

from netloom.queries import all_queries

FOLDER = "/root/testdata/sf0.001"
NAMES = (
    "dt_hybrid", "prediction_topn_one_pass", "pair_evidence_top10", "forward_fill_stanza", "group_max_norm", "merge_edges",
    "node_entities", "top_n_per_key", "interaction_network", "sql_dump_sentences", "stanza_terms", "category_filter",
)
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_plan_is_distributed(spark, name):
    plan = plan_of(all_queries()[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert operator not in plan
    # A window without a partition key would need all rows in one task.
    for window in re.findall(r"windowspecdefinition\(([^)]*)", plan):
        assert not re.match(r"\S+ (ASC|DESC)", window), window


def test_scans_read_only_the_needed_columns(spark):
    plan = plan_of(all_queries()["incremental_corpus"](spark, FOLDER))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all("o_totalprice" not in s and "o_orderpriority" not in s for s in schemas)


def test_filters_reach_the_scan(spark):
    plan = plan_of(all_queries()["left_anti_two_key"](spark, FOLDER))
    assert "Not(EqualTo(l_returnflag,R))" in plan and " EqualTo(l_returnflag,R)" in plan
