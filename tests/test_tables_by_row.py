"""Tables whose rules come together: cells, gaps and spans in their row, as from rows of rules."""

from pyspark.sql import functions as F

from quire.operators import tables


def test_a_table_in_its_row(spark):
    rules = [(1, 0, 0, "horizontal", 0.0, float(y), 30.0, float(y)) for y in (0, 10, 20)] + [(1, 0, 0, "vertical", float(x), 0.0, float(x), float(y)) for x, y in ((0, 20), (10, 10), (20, 20), (30, 20))]
    rules = spark.createDataFrame(rules + [(2, 0, 0, "horizontal", 0.0, 0.0, 9.0, 0.0)], "doc_id long, page_no int, table_id int, orientation string, x0 double, top double, x1 double, bottom double")
    whole = spark.createDataFrame(tables.by_table(rules).collect(), tables.by_table(rules).schema)
    laid = tables.laid_out(whole)
    gap = F.explode(F.transform("gaps", lambda g: g)).alias("g")
    assert "Exchange" not in tables.spans(laid)._jdf.queryExecution().executedPlan().toString()
    each = lambda df: sorted(map(tuple, df.collect()))
    cells = tables.grid(rules)
    assert each(tables.grid(whole)) == each(cells) and cells.count() == 6
    gaps = tables.gaps(cells, rules)
    assert each(laid.select(*tables.KEY, gap).select(*tables.KEY, "g.*")) == each(gaps) == [(1, 0, 0, 1, 0, "right")]
    assert each(tables.spans(laid)) == each(tables.merged(cells, gaps)) and (1, 0, 0, 1, 0, 1, 2) in each(tables.spans(laid))
