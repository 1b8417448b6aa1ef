"""Chat formatting: the fingerprint of a record's field paths selects the mapping that turns its layout into canonical turns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# The control strings of the template.
BEGIN, END, OPEN, CLOSE = "<s>", "</s>", "[INST]", "[/INST]"
CONTROL = r"(</?s>|\[/?INST\])"
#: The role whose texts are learnt from.
LEARNT = "assistant"
#: Names of roles in other layouts, and their canonical names; any other role stays as it is.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Layout:
    """A declarative mapping: the leaf paths of a record, and where its turns are.

    `turns` names an array with `role` and `text` in its elements; without it `fields` names (role, path) in the order of
    turns, and `row` says that a record is one turn, with paths of order, role and text. `rename` gives roles by ROLES
    their canonical names; records that are canonical turns already keep theirs.
    """

    name: str
    paths: tuple[str, ...]
    turns: str | None = None
    role: str = "role"
    text: str = "text"
    fields: tuple[tuple[str, str], ...] = ()
    row: tuple[str, str, str] | None = None
    rename: bool = True

    @property
    def mark(self) -> str:
        return ",".join(sorted(self.paths))

    @property
    def schema(self) -> str:
        """DDL of a record, from its leaf paths: the order of a turn is a bigint, all other leaves are strings."""
        tree: dict = {}
        for path in self.paths:
            node = tree
            for part in path.removeprefix("$.").split("."):
                node = node.setdefault(part, {})

        def ddl(node: dict, order: str | None = None) -> str:
            fields = []
            for name, below in node.items():
                bare, many = name.removesuffix("[]"), name.endswith("[]")
                kind = f"struct<{ddl(below)}>" if below else "bigint" if bare == order else "string"
                fields.append(f"`{bare}`: {f'array<{kind}>' if many else kind}")
            return ", ".join(fields)

        return f"struct<{ddl(tree, self.row[0] if self.row else None)}>"


#: Layouts that are known; callers may pass others.
LAYOUTS = (
    Layout("turn rows", ("$.role", "$.text", "$.turn"), row=("turn", "role", "text"), rename=False),
    Layout("messages", ("$.messages[].content", "$.messages[].role"), turns="messages", text="content"),
    Layout("messages with a system prompt", ("$.messages[].content", "$.messages[].role", "$.system"), turns="messages", text="content", fields=(("system", "system"),)),
    Layout("from and value", ("$.conversations[].from", "$.conversations[].value"), turns="conversations", role="from", text="value"),
    Layout("instruction", ("$.instruction", "$.output"), fields=(("user", "instruction"), ("assistant", "output"))),
    Layout("instruction with input", ("$.input", "$.instruction", "$.output"), fields=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout("prompt and completion", ("$.completion", "$.prompt"), fields=(("user", "prompt"), ("assistant", "completion"))),
    Layout("prompt and response", ("$.prompt", "$.response"), fields=(("user", "prompt"), ("assistant", "response"))),
    Layout("prompt and response with a system prompt", ("$.prompt", "$.response", "$.system"), fields=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout("question and answer", ("$.answer", "$.question"), fields=(("user", "question"), ("assistant", "answer"))),
    Layout("nested prompt", ("$.data.prompt", "$.data.response"), fields=(("user", "data.prompt"), ("assistant", "data.response"))),
)


def field_paths(schema: Column) -> Column:
    """Sorted leaf paths of a schema_of_variant() string, such as $.messages[].role.

    The string nests as OBJECT<name: TYPE, ...> and ARRAY<TYPE>; names are read one after another with the stack of
    what is open, so equal layouts have equal paths whatever their values and their types of leaves are.
    """
    parts = F.regexp_extract_all(schema, F.lit(r"(OBJECT<|ARRAY<|>|`(?:[^`]|``)*`: ?|[^\s<>,:`]+: ?|[A-Z]+(?:\([0-9,]+\))?)"), F.lit(1))
    start = F.struct(F.array(F.lit("$")).alias("open"), F.array().cast("array<string>").alias("leaves"), F.lit("$").alias("at"))

    def read(a: Column, p: Column) -> Column:
        top = F.element_at(a["open"], -1)
        return (
            F.when(p == "OBJECT<", F.struct(F.concat(a["open"], F.array(a["at"])).alias("open"), a["leaves"].alias("leaves"), a["at"].alias("at")))
            .when(p == "ARRAY<", F.struct(F.concat(a["open"], F.array(F.concat(a["at"], F.lit("[]")))).alias("open"), a["leaves"].alias("leaves"), F.concat(a["at"], F.lit("[]")).alias("at")))
            .when(p == ">", F.struct(F.slice(a["open"], F.lit(1), F.size(a["open"]) - 1).alias("open"), a["leaves"].alias("leaves"), a["at"].alias("at")))
            .when(p.rlike(": ?$"), F.struct(a["open"].alias("open"), a["leaves"].alias("leaves"), F.concat(top, F.lit("."), F.regexp_replace(p, "^`|`?: ?$", "")).alias("at")))
            .otherwise(F.struct(a["open"].alias("open"), F.array_append(a["leaves"], a["at"]).alias("leaves"), a["at"].alias("at")))
        )

    return F.array_sort(F.array_distinct(F.aggregate(parts, start, read, lambda a: a["leaves"])))


def fingerprint(paths: Column) -> Column:
    """Hash of sorted field paths."""
    return F.xxhash64(F.array_join(paths, ","))


#: A string of a record, its first characters apart: values may be longer than a variant can hold, and only paths count.
LITERAL = r'("(?:[^"\\]|\\.){0,200}+)(?:[^"\\]++|\\.)*+"'
#: Strings of any length are read.
READING = {"maxStringLen": str((1 << 31) - 1)}


def marked(records: DataFrame) -> DataFrame:
    """(conv_id, record) -> with mark, the fingerprint of the record's field paths; null for what is no JSON object or array.

    Strings are cut to 200 characters before the shape is taken, so a record of any length has one; of a field's name, its
    first 200 characters count.
    """
    shape = F.schema_of_variant(F.try_parse_json(F.regexp_replace("record", LITERAL, '$1"')))
    return records.select("conv_id", "record", fingerprint(field_paths(shape)).alias("mark"))


def _made(layout: Layout) -> Column:
    """The turns of a record of one layout, as an array of (part, role, text)."""
    turn = lambda part, role, text: F.struct(part.cast("bigint").alias("part"), _role(role, layout.rename).alias("role"), F.coalesce(text, F.lit("")).alias("text"))

    def read(r: Column) -> Column:
        def at(path: str) -> Column:
            out = r
            for name in path.split("."):
                out = out[name]
            return out

        made = [F.array(turn(*map(at, layout.row)))] if layout.row else []
        made += [F.array(turn(F.lit(k - len(layout.fields)), F.lit(role), at(path))) for k, (role, path) in enumerate(layout.fields)]
        if layout.turns:
            made.append(F.transform(at(layout.turns), lambda t, i: turn(i, t[layout.role], t[layout.text])))
        return F.concat(*made)

    return F.get(F.transform(F.array(F.from_json("record", layout.schema, READING)), read), 0)


def turns(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS, strict: bool = False) -> DataFrame:
    """(conv_id, record: JSON string) -> conv_id, part, role, text: canonical turns of every record.

    Each record's field paths are hashed and the hash selects a layout, by which the record is read once; `part` orders the
    turns of a conversation, whether one record or many hold them. Texts may be of any length. A record
    that is no JSON object or has another layout gives no turns (see unmapped()); with `strict` it fails the
    job instead, so that nothing is lost unnoticed. Null roles and texts become empty strings, an empty array of messages is
    another layout, other columns are left behind, and any number of records may share a conv_id, null included.
    """
    each = None
    for x in layouts:
        own = F.col("mark") == F.xxhash64(F.lit(x.mark))
        each = F.when(own, _made(x)) if each is None else each.when(own, _made(x))
    if strict:
        each = each.otherwise(F.raise_error(F.concat(F.lit("no layout maps the record "), F.coalesce(F.substr("record", F.lit(1), F.lit(200)), F.lit("null")))))
    return marked(records).select("conv_id", F.explode(each).alias("t")).select("conv_id", "t.*")


def _role(role: Column, rename: bool) -> Column:
    names = F.create_map(*[F.lit(s) for kv in ROLES.items() for s in kv])
    return F.coalesce(*([F.element_at(names, role)] if rename else []), role, F.lit(""))


def unmapped(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """conv_id and record of the records that no layout maps."""
    known = F.array(*[F.xxhash64(F.lit(x.mark)) for x in layouts])
    return marked(records).filter(F.col("mark").isNull() | ~F.array_contains(known, F.col("mark"))).select("conv_id", "record")


def escaped(text: Column) -> Column:
    """A backslash before each control string. Control strings cannot overlap, so taking one away undoes it."""
    return F.regexp_replace(text, CONTROL, r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\" + CONTROL, "$1")


def formatted(canonical: DataFrame) -> DataFrame:
    """conv_id, part, role, text -> conv_id, formatted, loss: one row for each conversation.

    A turn is <s>role, line feed, text, line feed, </s>; texts of all roles but the assistant stand between [INST] and [/INST] lines. In a role,
    a backslash and a line feed are written as two characters. `loss` has start and length (code points) of every
    assistant text in the formatted string: the loss mask. Turns of equal part go by role, then text; null parts come first.
    """
    role = F.regexp_replace(F.regexp_replace(escaped(F.col("role")), r"\\", r"\\\\"), "\n", r"\\n")
    learnt = F.col("role") == LEARNT
    head = F.concat(F.lit(BEGIN), role, F.lit("\n"), F.when(learnt, "").otherwise(f"{OPEN}\n"))
    tail = F.concat(F.lit("\n"), F.when(learnt, "").otherwise(f"{CLOSE}\n"), F.lit(END))
    rows = canonical.withColumns({"head": head, "body": escaped(F.col("text")), "tail": tail, "learnt": learnt})
    size = F.length("head") + F.length("body") + F.length("tail")
    order = Window.partitionBy("conv_id").orderBy(F.col("part").asc_nulls_first(), "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(size).over(order))
    turn = F.struct("end", F.concat("head", "body", "tail").alias("shown"), "learnt", F.struct((F.col("end") - size + F.length("head")).alias("start"), F.length("body").alias("length")).alias("span"))
    rows = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    loss = F.transform(F.filter("turns", lambda t: t["learnt"]), lambda t: t["span"])
    return rows.select("conv_id", F.array_join("turns.shown", "").alias("formatted"), loss.alias("loss"))


def read_back(output: DataFrame) -> DataFrame:
    """conv_id, formatted, loss -> conv_id, turns (role, text) and learnt (texts under the loss mask), from the formatted string alone."""
    parts = F.slice(F.split("formatted", r"(?<!\\)<s>"), F.lit(2), F.greatest(F.lit(0), F.size(F.split("formatted", r"(?<!\\)<s>")) - 1))

    def turn(p: Column) -> Column:
        shown = F.substring_index(p, "\n", 1)
        body = F.substr(p, F.length(shown) + 2, F.length(p) - F.length(shown) - 1 - len(f"\n{END}"))
        inner = F.substr(body, F.lit(len(OPEN) + 2), F.length(body) - len(f"{OPEN}\n\n{CLOSE}"))
        role = unescaped(F.regexp_replace(F.regexp_replace(shown, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"), r"\\\\", r"\\"))
        return F.struct(role.alias("role"), unescaped(F.when(role == LEARNT, body).otherwise(inner)).alias("text"))

    learnt = F.transform("loss", lambda x: unescaped(F.substr("formatted", (x["start"] + 1).cast("int"), x["length"])))
    return output.select("conv_id", F.transform(parts, turn).alias("turns"), learnt.alias("learnt"), F.length("formatted").cast("long").alias("formatted_chars"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted string; and of conversation -1, which is made of control strings."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    hard = f"{END}{OPEN} ok {CLOSE}"
    first = F.col("id") == 0
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(first, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    record = F.to_json(F.struct("turn", "role", "text"), {"ignoreNullFields": "false"}).alias("record")
    out = read_back(formatted(turns(rows.unionByName(own).select("conv_id", record), strict=True)))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("learnt", "")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


OP6_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
f AS (SELECT *, regexp_replace(text, '(</?s>|\[/?INST\])', '\\\1', 'g') AS body,
    replace(replace(regexp_replace(role, '(</?s>|\[/?INST\])', '\\\1', 'g'), '\', '\\'), chr(10), '\n') AS shown FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(9 + length(shown) + length(body) + CASE WHEN role = 'assistant' THEN 0 ELSE 15 END) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""
