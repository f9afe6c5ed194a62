"""What tasks hold at a time: row groups of tables with large rows, ranges of a merged trie."""

import os

import pyarrow.parquet as pq

from paperloom.llm import collocations, repeats


def groups(df):
    """Bytes of each row group of the table's files."""
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in df.inputFiles()]
    return [m.row_group(i).total_byte_size for m in files for i in range(m.num_row_groups)]


def test_blocks_are_read_a_few_at_a_time(spark):
    docs = spark.createDataFrame([(i, os.urandom(500_000).hex()) for i in range(40)], "doc_id long, text string").coalesce(1)
    found = groups(repeats.blocks_of(docs))
    assert len(found) > 1 and max(found) < 16_000_000, "a reader holds a row group at a time"


def test_ranges_of_one_task_are_merged_one_at_a_time(spark, monkeypatch):
    """Ranges that fall into one task come in order, and no two are summed together."""
    blocks = spark.createDataFrame([("en", [f"{a} {b}" for b in "xyz"], [1, 2, 3]) for a in "dbcaadbc"], collocations.BLOCKS).coalesce(1)
    dealt = collocations.merged(blocks, 1, [("en", [a]) for a in "bcd"])
    assert "Sort [range" in dealt._jdf.queryExecution().sparkPlan().toString()
    found = sorted((" ".join(r.path), r.a) for r in dealt.collect())
    assert found == [(f"{a} {b}", 2 * n) for a in "abcd" for b, n in zip("xyz", (1, 2, 3))]


def test_sums_of_a_range_hold_each_path_once(spark, monkeypatch):
    monkeypatch.setattr(collocations, "RANGE", 2)
    many = spark.createDataFrame([("en", ["a b", "a c"], [1, 2])] * 50, collocations.BLOCKS).coalesce(1)
    assert sorted((" ".join(r.path), r.a) for r in collocations.merged(many, 60, []).collect()) == [("a c", 100)]
