"""The line predicates see every line of a text, at any place and of any length."""

import pytest

from paperloom.plans import catalog


@pytest.mark.parametrize("name", ["flt_05", "flt_14"])
def test_predicates_reach_the_last_line(spark, tmp_path, name):
    lines = ["12345 67890", "x" * 300 + " and so on and on and on and on and on", "99 " * 200 + "abc" * 300, "EMPLOYER NAME", "", "Total:"]
    spark.createDataFrame([(1, "\n".join(lines)), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.line_no: r.v for r in catalog.queries()[name](spark, str(tmp_path)).collect()}
    want = {"flt_05": [False, True, True, True, False, True], "flt_14": [False, False, False, True, False, True]}[name]
    assert got == {i + 1: v for i, v in enumerate(want)}
