import re
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from quire.llm.quality import train
from quire.session import stored
from tests.llm.test_decontaminate import SF
from tests.llm.test_near import plain_kept


def test_each_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model, columns = train(docs, labels), docs.columns
    out = []
    for name, stage in corpus_pipeline.STAGES:
        now = stored(stage(spark, docs, SF), name)
        out.append((docs.collect(), now.collect()))
        if name != "source_mix":
            assert now.columns == columns
        docs = now
    (all_, good), (_, single), (_, clean), (_, private), (_, mix) = out

    score = dict(zip([r.doc_id for r in all_], model.score([r.text for r in all_]), strict=True))
    assert sorted(good) == sorted(r for r in all_ if score[r.doc_id] >= 0.5)

    assert sorted(r.doc_id for r in single) == plain_kept({r.doc_id: r.text.lower() for r in sorted(good)})

    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    items = [" ".join(words(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {r.doc_id for r in single if any(f" {i} " in f" {' '.join(words(r.text))} " for i in items)}
    assert {r.doc_id for r in single} - {r.doc_id for r in clean} == leaks

    before = {r.doc_id: r for r in clean}
    assert len(private) == len(clean)
    for r in private:
        assert len(r.text.split()) == len(before[r.doc_id].text.split()) and r.n_chars == len(r.text)
        if not re.search(r"[0-9@]", before[r.doc_id].text):
            assert r == before[r.doc_id]
    assert sum(r.text != before[r.doc_id].text for r in private) > 5

    times = Counter(r.doc_id for r in mix)
    assert set(times) <= {r.doc_id for r in private} and max(times.values()) <= 2 and len(mix) > len(private)


def test_run_is_the_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert [*out.columns][-1] == "copy" and out.count() > 0


def test_nulls_empty_texts_repeats_and_clashing_columns(spark, tmp_path):
    """Every stage on rows of all odd kinds: nothing crashes, columns stay, and what each does is as its docstring says."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    odd = [(None, None, None, None, None), (1_000, "", None, None, 0), (1_001, " \n", "en", "s", 2), (None, "a null id stays here", "en", None, 20), (None, "a null id stays here", "en", None, 20)]
    odd += [(1_002, "mail x@y.org now", "en", "s", 16), (1_003, "word " * 100_000, "en", "s", 500_000)]
    rows = docs.unionByName(spark.createDataFrame(odd, docs.schema)).unionByName(docs.limit(3))
    clash = {c: F.lit("z") for c in ("h", "web", "fp", "bands", "group", "row", "piece", "words", "item_id", "part", "source_size", "target", "copy", "many", "kept")}
    rows = stored(rows.withColumns(clash), "odd")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    for stage, df in [(s, x) for s in corpus_pipeline.STAGES for x in (rows, rows.limit(0))]:
        out = stage[1](spark, df, str(tmp_path))
        assert out.columns == ([c for c in df.columns if c != "copy"] + ["copy"] if stage[0] == "source_mix" else df.columns)
        got = out.collect()
        if stage[0] == "pii":
            assert len(got) == df.count() and all(r.n_chars == len(r.text) for r in got if r.text is not None)
        elif stage[0] == "source_mix":
            assert {r.doc_id for r in got} <= {r.doc_id for r in df.collect()}
        else:
            assert {repr(r) for r in got} <= {repr(r) for r in df.collect()}
    empty = str(tmp_path / "empty")
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
