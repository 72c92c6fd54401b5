"""Scale properties of the physical plans: no pair-producing joins, pruned scans."""

import os
import re

import pytest

SF = "/root/testdata/sf0.001"
KEYS = ["build_corpus", "markdown_tables", "words_in_cells", "edge_intersections", "text_between_tables", "annotation_layout", "region_pixels", "blur"]


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
@pytest.mark.parametrize("key", KEYS)
def test_no_cartesian_or_nested_loop_join(spark, key):
    import __spark_entry__ as E

    plan = E.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python UDF


def _exchanges(df):
    return len(re.findall(r"(?<!Reused)Exchange hashpartitioning", df._jdf.queryExecution().executedPlan().toString()))


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_cell_search_is_one_plan_with_few_shuffles(spark):
    from folio.operators import ruling as R
    from folio.sources import fixtures as fx

    # no job and no intermediate table: the whole plan, from the line items on, is visible
    plan = R.find_cells(fx.edges(spark, SF))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" not in text
    # line items by order, tables by document, rules by page (for both sides of one join), the join's two sides, points by page
    assert _exchanges(plan) <= 10
    assert _exchanges(fx.edges(spark, SF)) <= 2


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_corpus_scans_are_pruned(spark):
    import __spark_entry__ as E

    plan = E.queries()["build_corpus"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert schemas
    for s in schemas:
        if "text:string" in s:
            assert s == "struct<doc_id:bigint,text:string>"  # documents: only the two needed columns
        assert "l_comment" not in s and "l_shipdate" not in s
