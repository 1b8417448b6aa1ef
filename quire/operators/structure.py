"""S6: questions from blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from quire.functions.text import score_of, token_kind, token_label, token_number


#: What a marker is worth if it goes on with its level's numbers, if it does not, and if it is read as text.
EXPECTED, BROKEN, BACKWARDS, AS_TEXT = 3.0, -2.0, -4.0, -1.0
#: What it is worth besides: a lower-case letter behind the marker, as in the middle of a sentence, and points for the question.
MIDWAY, POINTS = -1.5, 1.0


def _best_reading(kinds: list[str], numbers: list[int], worth: list[float]) -> list[int]:
    """Places of the markers that the best reading of a paper takes: Viterbi over (section, question, subquestion, option, section since the last question)."""
    best: dict[tuple, tuple[float, tuple]] = {(0, 0, 0, 0, False): (0.0, ())}  # of each state: the score with its sign changed, and what is taken
    for at, (kind, n, more) in enumerate(zip(kinds, numbers, worth, strict=True)):
        after: dict[tuple, tuple[float, tuple]] = {}
        for state, (less, taken) in best.items():
            section, q, sub, option, fresh = state
            if kind == "section":
                gain, to = EXPECTED if n == section + 1 else BROKEN, (n, q, 0, 0, True)
            elif kind == "question":
                gain, to = more + (EXPECTED if n == q + 1 or (n == 1 and fresh) else BROKEN if n > q else BACKWARDS), (section, n, 0, 0, False)
            elif kind == "subquestion":
                gain, to = EXPECTED if q and n == sub + 1 else BROKEN, (section, q, n, 0, fresh)
            else:
                gain, to = EXPECTED if q and n == option + 1 else BROKEN, (section, q, sub, n, fresh)
            for key, value in ((state, (less - AS_TEXT, taken)), (to, (less - gain, (*taken, at)))):
                if key not in after or value < after[key]:
                    after[key] = value
        best = after
    return [*min(best.values())[1]]


#: What a block may be; its place is its number in the rows that readers get.
KINDS = ("text", "section", "question", "subquestion", "option")


@lru_cache(maxsize=50_000)
def _reading(rows: bytes) -> tuple[tuple, tuple, tuple, tuple]:
    """kind, section_no, q_no and sub_no of a paper's blocks: rows of kind, number, worth and whether a block is the one before again. Papers numbered alike are read once."""
    kinds, numbers, worth, again = np.frombuffer(rows, np.int64).reshape(-1, 4).T
    marks = np.flatnonzero((kinds > 0) & (again == 0))
    taken = {int(marks[k]) for k in _best_reading([KINDS[k] for k in kinds[marks]], numbers[marks].tolist(), np.ascontiguousarray(worth[marks]).view(np.float64).tolist())}
    out, at = [], [0, 0, 0]
    real = False
    for i, (kind, same) in enumerate(zip(kinds.tolist(), again.tolist(), strict=True)):
        real = real if same else i in taken
        if real and kind == 3:
            at[2] += 1
        elif real and kind == 2:
            at[1:] = [at[1] + 1, 0]
        elif real and kind == 1:
            at[0] += 1
        out.append((KINDS[kind] if real else "text", *at))
    return tuple(zip(*out, strict=True))


@F.arrow_udf(T.StructType([T.StructField("kind", T.ArrayType(T.StringType())), *[T.StructField(c, T.ArrayType(T.LongType())) for c in ("section_no", "q_no", "sub_no")]]))
def _readings(kinds: pa.Array, numbers: pa.Array, worth: pa.Array, again: pa.Array) -> pa.Array:
    flat = [a.flatten().to_numpy(zero_copy_only=False) for a in (kinds, numbers, worth, again)]
    rows = np.stack([flat[0].astype(np.int64), flat[1].astype(np.int64), flat[2].astype(np.float64).view(np.int64), flat[3].astype(np.int64)], axis=1)
    ends = np.cumsum(kinds.value_lengths().to_numpy(zero_copy_only=False)).tolist()
    found = [_reading(rows[a:b].tobytes()) for a, b in zip([0, *ends], ends)]
    lists = [pa.array([f[k] for f in found], pa.list_(pa.string() if k == 0 else pa.int64())) for k in range(4)]
    return pa.StructArray.from_arrays(lists, ["kind", "section_no", "q_no", "sub_no"])


def _read(blocks: DataFrame) -> DataFrame:
    """Blocks with kind, section_no, q_no, sub_no, and label__ and score__, which their text alone gives."""
    kept = [c for c in blocks.columns if c != "kind"]
    order = [c for c in ("block_no", "text") if c in kept]
    kind, score = token_kind(F.col("text")), score_of(F.col("text"))
    rest = F.regexp_replace(F.ltrim("text"), r"^[0-9]{1,3}[.．、]\s*", "")
    rows = blocks.select(*[F.col(f"`{c}`") for c in kept], kind.alias("kind__"), score.alias("score__"))
    asked, marked = F.col("kind__") == "question", F.col("kind__") != "text"
    worth = F.when(asked & rest.rlike("^[a-z]"), MIDWAY).otherwise(0.0) + F.when(asked & F.col("score__").isNotNull(), POINTS).otherwise(0.0)
    code = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind__")).cast("int") - 1
    number, label = F.when(marked, token_number(F.col("text"))), F.when(marked, token_label(F.col("text"))).otherwise("")
    rows = rows.select(*[F.col(f"`{c}`") for c in kept], "score__", label.alias("label__"), F.coalesce(code, F.lit(0)).alias("code__"), F.coalesce(number, F.lit(0)).alias("number__"), worth.alias("worth__"))
    own = F.struct(*[F.col(f"`{c}`") for c in [*order, *[c for c in kept if c not in ("doc_id", *order)], "score__", "label__", "code__", "number__", "worth__"]])
    papers = rows.repartition("doc_id").groupBy("doc_id").agg(F.sort_array(F.collect_list(own)).alias("own"))
    again = F.transform("own", lambda b, i: F.coalesce((i > 0) & F.struct(b["block_no"], b["text"]).eqNullSafe(F.struct(F.get("own", i - 1)["block_no"], F.get("own", i - 1)["text"])), F.lit(False)).cast("int"))
    papers = papers.withColumn("read", _readings(F.col("own.code__"), F.col("own.number__"), F.col("own.worth__"), again))
    each = F.arrays_zip(F.col("own"), *[F.col(f"read.{c}").alias(c) for c in ("kind", "section_no", "q_no", "sub_no")])
    rows = papers.select("doc_id", F.explode(each).alias("x"))
    return rows.select(*[F.col("doc_id") if c == "doc_id" else F.col(f"x.own.`{c}`").alias(c) for c in kept], "x.kind", "x.section_no", "x.q_no", "x.sub_no", "x.own.label__", "x.own.score__")


def decoded(blocks: DataFrame) -> DataFrame:
    """Blocks (doc_id, block_no, text) with kind: markers that the numbering of the paper bears out, all else is text.

    Every marker is a candidate of its kind or text. For each state (section, question, subquestion, option, whether a section has begun
    since the last question), the best reading of a paper's candidates so far is kept, in the order of block_no: numbers that
    follow their level's counter gain EXPECTED, others lose, and so does a marker that is read as text. The best reading at the end decides;
    of equals, the one that takes the earlier markers. All states are kept, so the result is the best path. A paper's blocks meet in one
    row, by one shuffle. Rows alike in block_no and text have one kind; null texts are text.
    """
    return _read(blocks).drop("section_no", "q_no", "sub_no", "label__", "score__")


def numbered(blocks: DataFrame) -> DataFrame:
    """Blocks with kind, label, section_no, q_no and sub_no: running counts whose inner levels start anew in each outer one.

    Kinds are those of decoded(), so a stray number is text and opens no question. The counts run through a paper in the row where it is
    read, so a question may cross pages.
    """
    rows = _read(blocks)
    own = [c for c in rows.columns if c not in ("section_no", "q_no", "sub_no", "label__", "score__")]
    return rows.select(*[F.col(f"`{c}`") for c in own], F.when(F.col("kind") == "text", "").otherwise(F.col("label__")).alias("label"), F.col("score__").alias("score"), "section_no", "q_no", "sub_no")


def region(rows: DataFrame, within: list[str], order: list[str], starts: Column, stops: Column, name: str) -> DataFrame:
    """Rows with a boolean that holds from a row that starts the region up to the row before one that stops it."""
    w = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.coalesce(F.last(F.when(starts, True).when(stops, False), ignorenulls=True).over(w), F.lit(False)))


def labelled(spans: DataFrame, label: Callable[[list[str]], list[str]], threshold: float = 0.8) -> DataFrame:
    """Spans (text, kind, confidence, ...), those of low confidence labelled anew in place; their text is never changed.

    Only the low ones reach the labeller. Rows stay as they are, with null and repeated ids; a null confidence is low.
    """
    low = F.coalesce(F.col("confidence") < threshold, F.lit(True))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, texts = batch.column("kind").to_pylist(), batch.column("text").to_pylist()
            own = [k for k, low in enumerate(batch.column("low__").to_pylist()) if low]
            for k, new in zip(own, label([texts[k] for k in own]) if own else (), strict=True):
                kinds[k] = new
            at = batch.schema.get_field_index("kind")
            yield batch.set_column(at, "kind", pa.array(kinds, pa.string())).select(names)

    names = spans.columns
    return spans.withColumn("low__", low).mapInArrow(ask, spans.schema)


def questions(blocks: DataFrame, options: DataFrame) -> DataFrame:
    """Numbered blocks and option cells -> one row for each question: stem, options, score, uncertain and its reason."""
    stems = blocks.filter("q_no > 0 and kind in ('question', 'text', 'subquestion') and ignore_reason is null")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_no", "text"))), lambda b: b["text"]), "\n")
    rows = stems.groupBy("doc_id", "q_no").agg(F.min("section_no").alias("section_no"), text.alias("stem"), F.max("score").alias("score"))
    cells = F.transform(F.array_sort(F.collect_list(F.struct("label", "text"))), lambda o: o)
    rows = rows.join(options.groupBy("doc_id", "q_no").agg(cells.alias("options")), ["doc_id", "q_no"], "left")
    given = F.transform("options", lambda o: o["label"])
    reason = F.when(F.col("options").isNotNull() & (F.array_join(given, "") != "ABCD"), "options are not A to D").when(F.trim("stem") == "", "empty stem")
    return rows.withColumn("uncertain_reason", reason).withColumn("uncertain", reason.isNotNull())


def question_json(questions: DataFrame) -> DataFrame:
    """doc_id, q_no and the question's JSON; null fields are written, so every question has the same paths."""
    return questions.select("doc_id", "q_no", F.to_json(F.struct(*[c for c in questions.columns if c != "doc_id"]), {"ignoreNullFields": "false"}).alias("json"))
