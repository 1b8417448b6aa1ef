"""What a step reads and shuffles, not what it gives: other tests hold that."""

from quire.operators import ledger, lines, structure
from quire.plans import registry as papers
from tests.oracle import same


def test_a_paper_is_shuffled_once(spark):
    rows = spark.createDataFrame([(1, 0, "1. a"), (1, 1, "2. b"), (2, 0, "1. a")], "doc_id long, block_no long, text string")
    assert structure.numbered(rows)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_the_ledger_stores_no_digests(spark, monkeypatch):
    rows, made = spark.createDataFrame([(1, 0, 5), (2, 0, 6)], "doc_id long, page_no long, prim_id long"), []
    kept = ledger.stored
    monkeypatch.setattr(ledger, "stored", lambda df, name="t": made.append(name) or kept(df, name))
    found = ledger.unbalanced(rows, rows.filter("doc_id = 1"), ["doc_id", "page_no"], ["doc_id", "page_no", "prim_id"])
    assert [(r.doc_id, r.state) for r in found.collect()] == [(2, "orphan")] and set(made) == {"unequal"}


def test_boxes_that_come_as_pages_are_not_shuffled(spark):
    kind = "doc_id long, page_no int, glyphs array<struct<line_no:long,x0:double,top:double,x1:double,bottom:double,text:string>>"
    pages = spark.createDataFrame([(1, 0, [(2, 120.0, 0.0, 220.0, 10.0, "b"), (1, 0.0, 0.0, 100.0, 10.0, "a")]), (2, 0, []), (3, 0, None)], kind)
    found = lines.reading_order(pages)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert [(r.doc_id, r.text, r.region_no, r.order_no) for r in found.collect()] == [(1, "a", 1, 1), (1, "b", 2, 2)]


def test_a_papers_boxes_are_not_shuffled(spark, tmp_path):
    """Its order alone is. Orders that share a key are one page, as in SQL."""
    whole = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    whole.limit(40).unionByName(whole.limit(20)).write.parquet(f"{tmp_path}/orders.parquet")
    found = papers.QUERIES["reading_order"](spark, str(tmp_path))
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(k") == 1
    assert "x0" not in found._jdf.queryExecution().executedPlan().toString().partition("Exchange")[2]
    assert same(found, papers.ORACLES["reading_order"], str(tmp_path)) > 0
