"""Queries by name, and the DuckDB SQL that each must equal.

They run the stage operators over whole driver tables by way of the stand-ins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quire.functions.text import token_kind, token_label
from quire.operators import audit, blocks, escalation, formula, health, ledger, lines, primitives, render, structure, tables
from quire.plans import papers, standins  # noqa: F401  papers adds its queries
from quire.plans.catalog import ORACLES, QUERIES, query  # noqa: F401
from quire.session import table

_LINES = """lines AS (SELECT doc_id, i - 1 AS ln, l[i] AS text FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)) WHERE l[i] <> '')"""
_CHARS = f"""{_LINES}, chars AS (SELECT doc_id, ln, ln // 40 AS page_no, p - 1 AS col, c[p] AS ch FROM (SELECT doc_id, ln, c, unnest(range(1, len(c) + 1)) AS p
  FROM (SELECT doc_id, ln, string_split(text, '') AS c FROM lines)))"""
_CARRIED = "carried AS (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS q_no FROM conversations)"
_RULES = """items AS (SELECT l_orderkey AS k, l_linenumber::DOUBLE AS n, max(l_returnflag) AS flag, max(l_linestatus) AS status FROM lineitem GROUP BY 1, 2),
v AS (SELECT k, 0 AS x, n * 10 AS top FROM items UNION ALL SELECT k, 10, n * 10 FROM items WHERE flag <> 'R'
  UNION ALL SELECT k, 20, n * 10 FROM items WHERE status <> 'F' UNION ALL SELECT k, 30, n * 10 FROM items),
h AS (SELECT DISTINCT k, ln FROM (SELECT k, n * 10 AS ln FROM items UNION ALL SELECT k, n * 10 + 10 FROM items)),
rs AS (SELECT * FROM (SELECT k, ln AS top, lead(ln) OVER (PARTITION BY k ORDER BY ln) AS bottom, row_number() OVER (PARTITION BY k ORDER BY ln) - 1 AS r FROM h) WHERE bottom IS NOT NULL),
cs AS (SELECT * FROM (SELECT k, x AS x0, lead(x) OVER (PARTITION BY k ORDER BY x) AS x1, row_number() OVER (PARTITION BY k ORDER BY x) - 1 AS c FROM (SELECT DISTINCT k, x FROM v)) WHERE x1 IS NOT NULL),
cells AS (SELECT k, r, c, x0, top, x1, bottom FROM rs JOIN cs USING (k))"""


@query(r"""SELECT doc_id, length(text) AS n_chars, CAST(len(regexp_extract_all(text, '\(cid:[0-9]+\)')) AS BIGINT) AS n_cid,
  CAST(len(regexp_extract_all(text, '\x{FFFD}')) AS BIGINT) AS n_fffd, CAST(len(regexp_extract_all(text, '[\x{E000}-\x{F8FF}]')) AS BIGINT) AS n_pua,
  CAST(len(regexp_extract_all(text, '[^\x00-\x7F]')) AS BIGINT) AS n_foreign,
  CASE WHEN text = '' THEN 'C' WHEN regexp_matches(text, '\(cid:[0-9]+\)|\x{FFFD}|[\x{E000}-\x{F8FF}]') OR len(regexp_extract_all(text, '[^\x00-\x7F]')) > 0.05 * length(text) THEN 'B' ELSE 'A' END AS route FROM documents""")
def health_profile(spark: SparkSession, sf: str) -> DataFrame:
    """S0.3-S0.5, S0.11: bad characters and route of each document."""
    return health.text_health(table(spark, sf, "documents"))


@query(f"""WITH {_CHARS}, p AS (SELECT doc_id, page_no, ch, col, ln, count(*) AS n FROM chars GROUP BY ALL)
SELECT doc_id, CAST(page_no AS BIGINT) AS page_no, CAST(sum(n) AS BIGINT) AS n_chars, CAST(sum(n - 1) AS BIGINT) AS n_dup, CAST(sum(CASE WHEN (col + 1) * 6 > 612 THEN n ELSE 0 END) AS BIGINT) AS n_oob,
  CASE WHEN sum(CASE WHEN (col + 1) * 6 > 612 THEN n ELSE 0 END) > 0 THEN 'B' ELSE 'A' END AS route FROM p GROUP BY doc_id, page_no""")
def page_profile(spark: SparkSession, sf: str) -> DataFrame:
    """S0.2, S0.7, S0.8, S0.11 over the glyph pages: duplicates, outsiders and route."""
    none = spark.createDataFrame([], "doc_id long, page_no int, x0 double, top double, x1 double, bottom double")
    found = health.page_health(None, standins.texts(spark, sf), none)
    return found.select("doc_id", F.col("page_no").cast("long").alias("page_no"), "n_chars", "n_dup", "n_oob", "route")


@query(f"""WITH {_CHARS}, c AS (SELECT source AS producer, ch, CASE WHEN regexp_matches(ch, '[A-Za-z]') THEN 'letter' WHEN regexp_matches(ch, '[0-9]') THEN 'digit' WHEN regexp_matches(ch, '[^\\x00-\\x7F]') THEN 'foreign' ELSE 'mark' END AS fontname
  FROM chars JOIN documents USING (doc_id))
SELECT producer, fontname, count(*) AS n_chars, count(DISTINCT ch) AS n_kinds, count(*) FILTER (regexp_matches(ch, '[\\x{{E000}}-\\x{{F8FF}}]')) AS n_pua, count(*) FILTER (fontname = 'foreign') AS n_unmapped FROM c GROUP BY ALL""")
def font_class_audit(spark: SparkSession, sf: str) -> DataFrame:
    """X.2: characters by producer (source) and class; one scan, aggregated before its shuffle."""
    chars = table(spark, sf, "documents").select(F.col("source").alias("producer"), F.explode(F.split(F.replace("text", F.lit("\n"), F.lit("")), "")).alias("ch")).filter("ch <> ''")
    docs = chars.groupBy("producer", "ch").agg(F.count("*").alias("n"))
    kind = F.when(F.col("ch").rlike("[A-Za-z]"), "letter").when(F.col("ch").rlike("[0-9]"), "digit").when(F.col("ch").rlike(r"[^\x00-\x7F]"), "foreign").otherwise("mark")
    return audit.font_audit(docs.withColumn("fontname", kind).withColumn("has_unicode_map", F.col("fontname") != "foreign"))


@query("""SELECT source, lang, count(*) AS n_docs, concat_ws('+', CASE WHEN grouping(source) = 0 THEN 'source' END, CASE WHEN grouping(lang) = 0 THEN 'lang' END) AS level
FROM documents GROUP BY GROUPING SETS ((source), (lang), ())""")
def corpus_mix(spark: SparkSession, sf: str) -> DataFrame:
    """X.1, S0.10: documents by producer, by language and in all."""
    return audit.corpus_mix(table(spark, sf, "documents"), ["source", "lang"])


@query("SELECT min(doc_id) AS doc_id, sha256(text) AS digest, arg_min(source, doc_id) AS source, arg_min(lang, doc_id) AS lang FROM documents GROUP BY text")
def prim_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """S1.5: one document of each text, the first; texts meet as digests, so the shuffle carries no text."""
    docs = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("digest"), "source", "lang")
    return primitives.deduplicated(docs, ["digest"], ["doc_id"])


@query("SELECT sha256(text) AS digest, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1")
def prim_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """S0.7: texts that repeat."""
    return primitives.duplicates(table(spark, sf, "documents").select(F.sha2("text", 256).alias("digest")), ["digest"])


@query(f"""WITH {_LINES} SELECT doc_id, ln // 40 AS page_no, row_number() OVER (PARTITION BY doc_id, ln // 40 ORDER BY ln) AS line_no, length(text) AS n_chars,
  (ln % 40) * 12::DOUBLE AS top, length(text) * 6::DOUBLE AS x1, text FROM lines""")
def line_cluster(spark: SparkSession, sf: str) -> DataFrame:
    """S1.1, S2.4, S2.5, S4.8: lines found again from glyph geometry alone."""
    found = lines.line_clusters(standins.texts(spark, sf))
    return found.select("doc_id", F.col("page_no").cast("long").alias("page_no"), "line_no", "n_chars", "top", "x1", "text")


@query(f"""WITH {_CHARS}, b AS (SELECT doc_id, page_no, col, count(*) AS n FROM chars WHERE ch <> ' ' GROUP BY ALL),
s AS (SELECT *, CASE WHEN col - lag(col) OVER w > 2 OR lag(col) OVER w IS NULL THEN 1 ELSE 0 END AS starts FROM b WINDOW w AS (PARTITION BY doc_id, page_no ORDER BY col)),
k AS (SELECT *, sum(starts) OVER (PARTITION BY doc_id, page_no ORDER BY col ROWS UNBOUNDED PRECEDING) AS band_no FROM s)
SELECT doc_id, CAST(page_no AS BIGINT) AS page_no, CAST(band_no AS BIGINT) AS band_no, min(col) * 6::DOUBLE AS x0, (max(col) + 1) * 6::DOUBLE AS x1, CAST(sum(n) AS BIGINT) AS n FROM k GROUP BY doc_id, page_no, band_no""")
def column_bands(spark: SparkSession, sf: str) -> DataFrame:
    """S2.6: bands of filled columns on each page."""
    box = lambda g: [F.when(g["ch"] != " ", g["x0"]).alias("x0"), g["x1"].alias("x1")]  # noqa: E731  a space has no box
    found = lines.bands(standins.pages(spark, sf, box))
    return found.select("doc_id", F.col("page_no").cast("long").alias("page_no"), "band_no", "x0", "x1", "n")


@query(f"""WITH {_CHARS} SELECT doc_id, CAST(page_no AS BIGINT) AS page_no, count(*) AS n_seeds, count(DISTINCT ch) AS n_signs FROM chars WHERE ch IN ('#', '$', '%', '&', '*', '+', '<', '=', '>', '|') GROUP BY doc_id, page_no""")
def math_seed(spark: SparkSession, sf: str) -> DataFrame:
    """S2.1, S2.3: seeds by page; signs come from a dimension table that a semi join broadcasts (ten rows)."""
    signs = spark.createDataFrame([(c,) for c in "#$%&*+<=>|"], "ch string")
    seeds = standins.chars(spark, sf).join(F.broadcast(signs), "ch", "left_semi")
    return seeds.groupBy("doc_id", F.col("page_no").cast("long").alias("page_no")).agg(F.count("*").alias("n_seeds"), F.count_distinct("ch").alias("n_signs"))


@query(f"""WITH {_LINES}, o AS (SELECT *, (ln % 40) * 12 AS top, (length(text) - length(ltrim(text, ' '))) * 6 AS x0 FROM lines),
s AS (SELECT *, CASE WHEN lag(ln) OVER w IS NULL OR ln // 40 <> lag(ln // 40) OVER w OR top - (lag(top) OVER w + 12) > 0.6 * 12 OR x0 - lag(x0) OVER w > 12 THEN 1 ELSE 0 END AS starts FROM o WINDOW w AS (PARTITION BY doc_id ORDER BY ln)),
k AS (SELECT *, sum(starts) OVER (PARTITION BY doc_id ORDER BY ln ROWS UNBOUNDED PRECEDING) AS block_no FROM s)
SELECT doc_id, CAST(block_no AS BIGINT) AS block_no, CAST(min(ln // 40) AS BIGINT) AS page_no, string_agg(text, chr(10) ORDER BY ln) AS text, count(*) AS n_lines FROM k GROUP BY doc_id, block_no""")
def text_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    """S4.1, S4.2, S4.6: paragraphs by gaps and indents, as ordered blocks."""
    return blocks.blocks(blocks.paragraphs(standins.lines(spark, sf)))


_BLOCK = r"(?s)<(nav|footer|h1|p|div class=\"ad\")[^>]*>(.*?)</(?:nav|footer|h1|p|div)>"
_BLOCK_SQL = r"""b AS (SELECT page_id, unnest(range(1, len(m) + 1)) AS block_no, m, t FROM (SELECT page_id,
  regexp_extract_all(html, '(?s)<(nav|footer|h1|p|div class="ad")[^>]*>(.*?)</(?:nav|footer|h1|p|div)>', 1) AS m, regexp_extract_all(html, '(?s)<(nav|footer|h1|p|div class="ad")[^>]*>(.*?)</(?:nav|footer|h1|p|div)>', 2) AS t FROM pages)),
k AS (SELECT page_id, block_no, m[block_no] AS tag, CASE WHEN m[block_no] IN ('nav', 'footer') THEN 'chrome' WHEN m[block_no] LIKE 'div%' THEN 'ad' END AS ignore_reason,
  regexp_replace(t[block_no], '<[^>]*>', '', 'g') AS text FROM b)"""


def _page_blocks(spark: SparkSession, sf: str) -> DataFrame:
    html = table(spark, sf, "pages")
    both = F.arrays_zip(F.regexp_extract_all("html", F.lit(_BLOCK), F.lit(1)).alias("tag"), F.regexp_extract_all("html", F.lit(_BLOCK), F.lit(2)).alias("inner"))
    rows = html.select("page_id", F.posexplode(both).alias("pos", "b"))
    reason = F.when(F.col("b.tag").isin("nav", "footer"), "chrome").when(F.col("b.tag").startswith("div"), "ad")
    return rows.select("page_id", (F.col("pos") + 1).cast("long").alias("block_no"), F.col("b.tag").alias("tag"), reason.alias("ignore_reason"), F.regexp_replace("b.inner", "<[^>]*>", "").alias("text"))


@query(f"WITH {_BLOCK_SQL} SELECT * FROM k")
def page_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """S4.1, S4.5: blocks of web pages; ignored ones stay, with their reason."""
    return _page_blocks(spark, sf)


@query(f"WITH {_BLOCK_SQL} SELECT coalesce(ignore_reason, 'kept') AS reason, count(*) AS n_blocks, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM k GROUP BY 1")
def ignored_summary(spark: SparkSession, sf: str) -> DataFrame:
    """S4.5: blocks and characters by ignore reason."""
    return _page_blocks(spark, sf).groupBy(F.coalesce("ignore_reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n_blocks"), F.sum(F.length("text")).alias("n_chars"))


@query(f"WITH {_CARRIED} SELECT conv_id, turn, role, CAST(q_no AS BIGINT) AS q_no FROM carried")
def carry_question(spark: SparkSession, sf: str) -> DataFrame:
    """S4.7, S6.1: the question that each turn belongs to."""
    return standins.carried(spark, sf).select("conv_id", "turn", "role", "q_no")


@query("""SELECT conv_id, turn, coalesce(last_value(CASE WHEN role = 'assistant' THEN true WHEN role = 'user' THEN false END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING), false) AS in_answer FROM conversations""")
def answer_region(spark: SparkSession, sf: str) -> DataFrame:
    """S6.3: rows inside an answer, from an assistant turn to the next user turn."""
    rows = table(spark, sf, "conversations")
    return structure.region(rows, ["conv_id"], ["turn"], F.col("role") == "assistant", F.col("role") == "user", "in_answer").select("conv_id", "turn", "in_answer")


@query(f"""WITH {_LINES}, t AS (SELECT ltrim(text, ' ') AS x FROM lines), k AS (SELECT CASE WHEN regexp_matches(x, '^[一二三四五六七八九十]+、') THEN 'section' WHEN regexp_matches(x, '^([0-9]{{1,3}})[.．、]([^0-9]|$)') THEN 'question'
  WHEN regexp_matches(x, '^[(（]([0-9]{{1,2}})[)）]') THEN 'subquestion' WHEN regexp_matches(x, '^([A-D])[.．、]') THEN 'option' ELSE 'text' END AS kind,
  regexp_extract(x, '^([0-9]{{1,3}})[.．、]([^0-9]|$)', 1) || regexp_extract(x, '^[(（]([0-9]{{1,2}})[)）]', 1) || regexp_extract(x, '^([A-D])[.．、]', 1) AS label FROM t) SELECT kind, label, count(*) AS n FROM k GROUP BY ALL""")
def line_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """S6.2: grammar tokens of all lines."""
    rows = standins.lines(spark, sf).select(token_kind(F.col("text")).alias("kind"), token_label(F.col("text")).alias("label"))
    return rows.groupBy("kind", "label").agg(F.count("*").alias("n"))


@query(f"""WITH {_CARRIED} SELECT conv_id AS doc_id, CAST(q_no AS BIGINT) AS q_no,
  CAST(to_json({{'q_no': CAST(q_no AS BIGINT), 'stem': max(text) FILTER (role = 'user'), 'n_answers': count(*) FILTER (role = 'assistant')}}) AS VARCHAR) AS json FROM carried WHERE q_no > 0 GROUP BY conv_id, q_no""")
def question_json(spark: SparkSession, sf: str) -> DataFrame:
    """S6.5, S6.6: a JSON document for each question."""
    return structure.question_json(standins.questions(spark, sf))


@query("""SELECT d.doc_id, d.source, coalesce(u.uses, 0) AS uses, CASE coalesce(u.uses, 0) WHEN 1 THEN 'once' WHEN 0 THEN 'orphan' ELSE 'duplicate' END AS state
FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS uses FROM labels GROUP BY 1) u USING (doc_id)""")
def conservation(spark: SparkSession, sf: str) -> DataFrame:
    """S7.1-S7.3: documents as primitives, labels as their consumers."""
    return ledger.conservation(table(spark, sf, "documents").select("doc_id", "source"), table(spark, sf, "labels"), ["doc_id"])


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def orphans(spark: SparkSession, sf: str) -> DataFrame:
    """S7.1: documents without a consumer, by an anti join."""
    return table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_anti")


@query("""SELECT source, count(*) FILTER (u.n IS NULL) AS orphans, count(*) FILTER (u.n > 1) AS duplicates FROM documents LEFT JOIN (SELECT doc_id, count(*) AS n FROM labels GROUP BY 1) u USING (doc_id)
GROUP BY source HAVING count(*) FILTER (u.n IS NULL) + count(*) FILTER (u.n > 1) > 0""")
def broken_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """S7.7, X.7: producers with primitives that are not consumed exactly once."""
    return ledger.broken(conservation(spark, sf), "source")


@query(f"WITH {_LINES} SELECT doc_id, ln // 40 AS page_no, sum(greatest(length(text) - (length(text) - length(ltrim(text, ' '))), 0) * 6::DOUBLE * 12) / (612 * 480::DOUBLE) AS coverage FROM lines GROUP BY 1, 2")
def page_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """S7.4: share of each page under the union of its line boxes."""
    rows = standins.lines(spark, sf)
    return ledger.coverage(rows, standins.page_sizes(rows))


@query(f"WITH {_RULES} SELECT k AS doc_id, r, c, x0::DOUBLE AS x0, top, x1::DOUBLE AS x1, bottom FROM cells")
def cell_grid(spark: SparkSession, sf: str) -> DataFrame:
    """S5.4: cells of every table between neighbouring rules."""
    return tables.grid(standins.rules(spark, sf)).select("doc_id", F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"), "x0", "top", "x1", "bottom")


@query(f"""WITH {_RULES}, e AS (SELECT *, max(c) OVER (PARTITION BY k) AS cols FROM cells)
SELECT k AS doc_id, r, c, 'right' AS side FROM e WHERE c < cols AND NOT EXISTS (SELECT 1 FROM v WHERE v.k = e.k AND v.x = e.x1 AND v.top = e.top AND e.bottom = e.top + 10)""")
def merged_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """S5.5: inner sides of cells that no rule covers."""
    gap = lambda g: F.struct(g["r"].cast("long").alias("r"), g["c"].cast("long").alias("c"), g["side"].alias("side"))
    return tables.laid_out(standins.rules(spark, sf)).select("doc_id", F.explode(F.transform("gaps", gap)).alias("g")).select("doc_id", "g.*")


@query(f"""WITH {_RULES}, p AS (SELECT l_orderkey AS k, l_partkey, l_quantity % 30 AS x, l_linenumber * 10::DOUBLE + 5 AS y FROM lineitem)
SELECT p.k AS doc_id, r, c, count(*) AS n, CAST(sum(l_partkey) AS BIGINT) AS parts FROM p JOIN cells ON p.k = cells.k AND x >= x0 AND x < x1 AND y >= top AND y < bottom GROUP BY ALL""")
def cell_member(spark: SparkSession, sf: str) -> DataFrame:
    """S5.6: items in the cell that holds their place: page key, then a range."""
    x, y = F.col("l_quantity") % 30, F.col("l_linenumber") * 10.0 + 5
    points = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.lit(0).alias("page_no"), "l_partkey", x.alias("x0"), x.alias("x1"), y.alias("top"), y.alias("bottom"))
    found = tables.members(points, tables.grid(standins.rules(spark, sf)))
    return found.groupBy("doc_id", F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c")).agg(F.count("*").alias("n"), F.sum("l_partkey").alias("parts"))


@query("""WITH g AS (SELECT l_orderkey AS z, l_partkey * 10 + l_linenumber AS id, CASE WHEN l_returnflag = 'N' THEN 10 ELSE 7 END::DOUBLE AS size, l_linenumber * 8::DOUBLE AS x0, l_linenumber * 8::DOUBLE + 6 AS x1, l_quantity AS top FROM lineitem),
e AS (SELECT a.z, a.id AS base_id, b.id AS script_id, b.x0 - a.x1 AS away, (b.top + b.top + b.size) / 2 - (a.top + a.top + a.size) / 2 AS off, a.size AS s FROM g a JOIN g b ON a.z = b.z AND b.size <= 0.85::DOUBLE * a.size AND b.x0 >= a.x1 - 0.3::DOUBLE * a.size AND b.x0 - a.x1 <= a.size),
r AS (SELECT *, row_number() OVER (PARTITION BY z, script_id ORDER BY abs(away), base_id) AS place FROM e WHERE off < -0.15::DOUBLE * s OR off > 0.15::DOUBLE * s)
SELECT z AS zone_id, base_id, script_id, CASE WHEN off < 0 THEN 'sup' ELSE 'sub' END AS slot FROM r WHERE place = 1""")
def superscript_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """S3.1: scripts with their nearest base, by a range join inside the zone."""
    size, n = F.when(F.col("l_returnflag") == "N", 10.0).otherwise(7.0), F.col("l_linenumber") * 8.0
    chars = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("zone_id"), (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("prim_id"), size.alias("size"), n.alias("x0"), (n + 6).alias("x1"), F.col("l_quantity").alias("top"), (F.col("l_quantity") + size).alias("bottom"))
    return formula.script_edges(chars)


def _attempts(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").filter("role = 'assistant'")
    return rows.select(F.col("conv_id").alias("node_id"), F.col("turn").alias("rung"), (F.length("text") >= 200).alias("invariants_ok"), F.length("text").cast("double").alias("score"), F.col("text").alias("payload"))


_BEST = """best AS (SELECT * FROM (SELECT conv_id AS node_id, turn AS rung, length(text)::DOUBLE AS score, text AS payload, row_number() OVER (PARTITION BY conv_id ORDER BY length(text) DESC, turn, text) AS place
  FROM conversations WHERE role = 'assistant' AND length(text) >= 200) WHERE place = 1)"""


@query(f"WITH {_BEST} SELECT node_id, rung, score, payload FROM best")
def best_of(spark: SparkSession, sf: str) -> DataFrame:
    """S8.3, S8.4: the best attempt of each node among those that keep the invariants."""
    return escalation.best_of(_attempts(spark, sf), ["node_id"], [F.col("score").desc(), "rung", "payload"]).select("node_id", "rung", "score", "payload")


@query(f"WITH {_BEST} SELECT n.node_id, rung, score, rung IS NULL AS uncertain, CASE WHEN rung IS NULL THEN 'every attempt failed' END AS uncertain_reason FROM (SELECT DISTINCT conv_id AS node_id FROM conversations) n LEFT JOIN best USING (node_id)")
def ladder_exhausted(spark: SparkSession, sf: str) -> DataFrame:
    """S8.5, S7.8: nodes whose attempts all failed are uncertain."""
    nodes = table(spark, sf, "conversations").select(F.col("conv_id").alias("node_id")).distinct()
    return escalation.settled(nodes, best_of(spark, sf)).select("node_id", "rung", "score", "uncertain", "uncertain_reason")


@query("SELECT doc_id, quality / 2.0::DOUBLE + 0.4::DOUBLE AS confidence FROM documents LEFT JOIN labels USING (doc_id) WHERE coalesce(quality / 2.0::DOUBLE + 0.4::DOUBLE, 0) < 0.8")
def escalation_queue(spark: SparkSession, sf: str) -> DataFrame:
    """S3.11: nodes below the confidence threshold, or without one."""
    rows = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return escalation.queue(rows.select("doc_id", (F.col("quality") / 2.0 + 0.4).alias("confidence")))


@query("""SELECT CAST(least(floor(least(n_chars / 8000::DOUBLE, 1::DOUBLE) * 10), 9) AS INTEGER) AS bin, count(*) AS n, avg(quality) AS accuracy FROM documents JOIN labels USING (doc_id) GROUP BY 1""")
def calibration(spark: SparkSession, sf: str) -> DataFrame:
    """X.4: share of good documents in bins of a score (length)."""
    rows = table(spark, sf, "documents").select("doc_id", "n_chars").join(table(spark, sf, "labels"), "doc_id")
    return audit.calibration(rows, F.least(F.col("n_chars") / 8000.0, F.lit(1.0)), F.col("quality"))


@query("SELECT count(*) AS n_questions, count(*) FILTER (toxic = 1 AND quality = 1) AS n_silent, count(*) FILTER (toxic = 1 AND quality = 1) / count(*)::DOUBLE AS silent_rate FROM labels")
def silent_error(spark: SparkSession, sf: str) -> DataFrame:
    """X.5: wrong (toxic) and not marked (good quality), among all labelled documents."""
    return audit.silent_errors(table(spark, sf, "labels"), F.col("toxic") == 1, F.col("quality") != 1)


@query("""WITH c AS (SELECT count(*) AS n, count(*) FILTER (html LIKE '%<title>%') AS title, count(*) FILTER (html LIKE '%<article>%') AS article, count(*) FILTER (len(regexp_extract_all(html, '<p>')) >= 4) AS four_options FROM pages)
SELECT metric, n, n_filled, n_filled / n::DOUBLE AS rate, n_filled / n::DOUBLE >= 0.9 AS reached FROM (SELECT unnest(['title', 'article', 'four_options']) AS metric, n, unnest([title, article, four_options]) AS n_filled FROM c)""")
def fill_rates(spark: SparkSession, sf: str) -> DataFrame:
    """X.6: rates of pages with a title, an article and four paragraphs."""
    checks = {"title": F.col("html").contains("<title>"), "article": F.col("html").contains("<article>"), "four_options": F.regexp_count("html", F.lit("<p>")) >= 4}
    return audit.fill_rates(table(spark, sf, "pages"), checks)


@query(f"""WITH {_CARRIED}, q AS (SELECT conv_id, q_no, max(text) FILTER (role = 'user') AS stem, count(*) FILTER (role = 'assistant') AS n FROM carried WHERE q_no > 0 GROUP BY ALL),
e AS (SELECT *, replace(replace(replace(replace(stem, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') AS safe FROM q)
SELECT conv_id AS doc_id, '<!DOCTYPE html><html><head><meta charset="utf-8"></head><body>' || chr(10) || string_agg('<section id="q' || CAST(q_no AS BIGINT) || '"><p>' || safe || '</p>' ||
  CASE WHEN n = 0 THEN '<mark class="uncertain">no answer</mark>' ELSE '' END || '</section>', chr(10) ORDER BY q_no) || chr(10) || '</body></html>' AS html FROM e GROUP BY conv_id""")
def render_html(spark: SparkSession, sf: str) -> DataFrame:
    """S9.1, S9.3: HTML of each conversation's questions; those without an answer are marked."""
    rows = standins.questions(spark, sf).withColumn("uncertain", F.col("n_answers") == 0).withColumn("uncertain_reason", F.when(F.col("n_answers") == 0, "no answer"))
    rows = rows.withColumn("options", F.lit(None).cast("array<struct<label:string,text:string>>"))
    return render.document_html(render.question_html(rows))


@query(f"""WITH {_LINES} SELECT doc_id, ln // 40 AS page_no, '<svg viewBox="0 0 612.0 480.0">' || string_agg(printf('<rect x="%.1f" y="%.1f" width="%.1f" height="%.1f" class="%s"/>', ((length(text) - length(ltrim(text, ' '))) * 6)::DOUBLE, ((ln % 40) * 12)::DOUBLE,
  (length(ltrim(text, ' ')) * 6)::DOUBLE, 12.0::DOUBLE, CASE WHEN length(text) > 102 THEN 'uncertain' ELSE 'sure' END), '' ORDER BY ln) || '</svg>' AS svg FROM lines GROUP BY 1, 2""")
def overlay(spark: SparkSession, sf: str) -> DataFrame:
    """S9.4: boxes of lines over their page; those that leave the page are uncertain."""
    rows = standins.lines(spark, sf)
    boxes = rows.withColumn("node_id", F.col("line_no")).withColumn("uncertain", F.length("text") > 102)
    return render.overlay(boxes, standins.page_sizes(rows))
