"""How work is spread over tasks: broadcasts by measured sizes, rendered rows dealt out by their document."""

import pytest

from paperloom.operators import spread
from paperloom.plans import catalog

AT = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


@pytest.mark.parametrize("name", ["src_18", "agg_07", "src_19", "x_form"])
def test_field_trees_are_not_broadcast_by_file_sizes(spark, name):
    assert "BroadcastHashJoin" not in plan(catalog.queries()[name](spark, AT))


@pytest.mark.parametrize("name", ["x_claim", "x_pat", "x_chg"])
def test_rendered_documents_are_dealt_out_before_they_are_made(spark, monkeypatch, name):
    monkeypatch.setattr(spread, "ROWS", 100)
    text = plan(catalog.queries()[name](spark, AT))
    assert text.index("REPARTITION_BY_NUM") > text.index("Generate inline"), "the rows are dealt out below what renders them"


@pytest.mark.parametrize("name", ["x_chg", "obs_01", "win_15"])
def test_change_logs_are_made_of_lines_once(spark, name):
    text = plan(catalog.queries()[name](spark, AT))
    assert text.count("Generate inline") == 1 and "Join" not in text
