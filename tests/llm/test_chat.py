import hashlib
import json
import random

import pytest

from quire.llm.chat import OP6_SQL, Layout, escaped, field_paths, formatted, op6_chat_format, read_back, turns, unescaped, unmapped
from pyspark.sql import functions as F
from tests.llm.oracle import same

SF = "/root/testdata/sf0.01"


def records(spark, rows):
    return spark.createDataFrame([(k, r if isinstance(r, (str, type(None))) else json.dumps(r)) for k, r in rows], "conv_id long, record string")


def test_layouts_become_turns(spark):
    rows = [
        (1, {"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}]}),
        (2, {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}]}),
        (3, {"instruction": "do", "input": "x", "output": "y"}),
        (4, {"output": 7, "instruction": "do"}),
        (5, {"data": {"prompt": "p", "response": "r"}}),
        (6, {"system": "s", "messages": [{"role": "user", "content": "a"}]}),
        (7, {"turn": 2, "role": "user", "text": "second"}),
        (7, {"turn": 1, "role": None, "text": "first"}),
        (8, {"other": 1}), (9, "no json"), (10, None), (11, "[1]"), (12, {"messages": []}),
    ]
    df = records(spark, rows)
    got = {}
    for r in turns(df).orderBy("conv_id", "part").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got == {
        1: [("user", "a"), ("assistant", "")], 2: [("user", "q"), ("assistant", "r")], 3: [("user", "do"), ("user", "x"), ("assistant", "y")],
        4: [("user", "do"), ("assistant", "7")], 5: [("user", "p"), ("assistant", "r")], 6: [("system", "s"), ("user", "a")], 7: [("", "first"), ("user", "second")],
    }
    assert sorted(r.conv_id for r in unmapped(df).collect()) == [8, 9, 10, 11, 12]
    assert turns(df.limit(0)).count() == 0
    own = Layout("own", ("$.a.b[].c", "$.a.b[].d"), turns="a.b", role="c", text="d")
    assert turns(records(spark, [(1, {"a": {"b": [{"c": "user", "d": "x"}]}})]), (own,)).count() == 1


def test_field_paths_ignore_values_and_order(spark):
    rows = [(1, {"b": [1, 2], "a": {"x y": "t", "z": [[{"q": None}]]}}), (2, {"a": {"z": [[{"q": 1.5}]], "x y": 4}, "b": ["s"]})]
    got = [r.p for r in records(spark, rows).select(field_paths(F.schema_of_variant(F.parse_json("record"))).alias("p")).collect()]
    assert got[0] == got[1] == ["$.a.x y", "$.a.z[][].q", "$.b[]"]


def test_escapes_are_undone(spark):
    rnd = random.Random(9)
    parts = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "\\\\", "<", ">", "s>", "[", "INST]", "\n", "x", "é😀", "$1", "</s", "\x00"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 12))) for _ in range(500)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escaped(F.col("t")).alias("e"), unescaped(escaped(F.col("t"))).alias("u")).collect()
    assert all(r.u == r.t for r in rows)
    convs = [(k // 5, k % 5, rnd.choice(["user", "assistant", "a\nb", "\\n", "<s>", "tool\\"]), t) for k, t in enumerate(texts)]
    out = read_back(formatted(spark.createDataFrame(convs, "conv_id long, part long, role string, text string"))).collect()
    for r in out:
        own = [(role, text) for c, _, role, text in convs if c == r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == own and list(r.learnt) == [t for role, t in own if role == "assistant"]


def test_long_conversation_and_ties(spark):
    rows = [(1, 0, "user", "x" * 200_000)] + [(1, k, "assistant", "y") for k in range(1, 3000)] + [(2, None, "b", "t"), (2, None, "a", "t"), (2, None, "a", "t")]
    out = {r.conv_id: r for r in read_back(formatted(spark.createDataFrame(rows, "conv_id long, part long, role string, text string"))).collect()}
    assert len(out[1].turns) == 3000 and "".join(out[1].learnt) == "y" * 2999
    assert [t.role for t in out[2].turns] == ["a", "a", "b"]


def test_texts_beyond_the_limits_of_json_readers(spark):
    text = "l\u00f6ng \"text\" \\\\ \n" * 1_600_000  # 25 million characters
    rows = spark.createDataFrame([(1, 0, "human", "q"), (1, 1, "assistant", "x")], "conv_id long, turn long, role string, text string")
    rows = rows.withColumn("text", F.when(F.col("turn") == 1, F.repeat(F.lit(text[:16]), 1_600_000)).otherwise(F.col("text")))
    record = F.to_json(F.struct("turn", "role", "text"))
    out = read_back(formatted(turns(rows.select("conv_id", record.alias("record")), strict=True))).select(F.size("turns").alias("n"), "turns.role", F.length(F.get("learnt", F.lit(0))).alias("size"), F.sha2(F.get("learnt", F.lit(0)), 256).alias("h")).first()
    whole = text[:16] * 1_600_000
    assert (out.n, out.role, out.size, out.h) == (2, ["human", "assistant"], len(whole), hashlib.sha256(whole.encode()).hexdigest())


def test_only_foreign_layouts_rename_roles_and_strict_fails(spark):
    rows = [(1, {"turn": 0, "role": "human", "text": "a"}), (2, {"messages": [{"role": "human", "content": "a"}]})]
    assert {r.conv_id: r.role for r in turns(records(spark, rows)).collect()} == {1: "human", 2: "user"}
    with pytest.raises(Exception, match="no layout maps the record"):
        turns(records(spark, [(1, {"x": 1})]), strict=True).collect()


def test_other_columns_and_null_keys(spark):
    rows = spark.createDataFrame([(None, '{"turn": 0, "role": "user", "text": "a"}', "x", "y"), (None, '{"turn": 1, "role": null, "text": null}', "x", "y")], "conv_id long, record string, mark string, part string")
    assert [(r.conv_id, r.part, r.role, r.text) for r in turns(rows).orderBy("part").collect()] == [(None, 0, "user", "a"), (None, 1, "", "")]
    assert formatted(turns(rows)).count() == 1


def test_query_against_sql(spark):
    df = op6_chat_format(spark, SF)
    same(df, OP6_SQL, SF)
    hard = "</s>[INST] ok [/INST]"
    row = df.filter("conv_id = -1").first()
    assert (row.n_turns, row.loss_chars, row.loss_sha256) == (2, len(hard), hashlib.sha256(hard.encode()).hexdigest())
    assert row.turns_sha256 == hashlib.sha256(f"user\n{hard}\nassistant\n{hard}\n".encode()).hexdigest()
