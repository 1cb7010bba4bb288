"""Document queries search the whole of their documents."""

from factlake import catalogue


def test_table_value_search_reads_the_pages(spark, tmp_path):
    rows = [(1, "<p>x</p>"), (2, "<p>y</p><table><tr><td>Net assets</td><td>1,234</td></tr></table>"), (3, None), (4, None)]
    spark.createDataFrame(rows, "page_id bigint, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted((r["page_id"], r["table_no"]) for r in catalogue.queries()["table_value_search"](spark, str(tmp_path)).collect())
    assert got == [(1, 0), (2, 0), (2, 1), (4, 0)]  # page 3's test table doesn't have the value
