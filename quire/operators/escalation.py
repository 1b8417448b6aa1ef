"""S8: a fixed ladder of engines for nodes that fail, and the best of their attempts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from quire.operators.audit import calibrated, isotonic
from quire.session import stored

#: Rung 0 and two retries at most.
LAST_RUNG = 2
#: Cost of the nodes that an engine gets at once, about; a node costs the length of its source, unless there is a column `cost`.
BATCH_COST = 10_000.0
#: What an engine makes of sources: payload, whether the hard invariants hold, score.
Call = Callable[[list], list[tuple[str, bool, float]]]


@dataclass(frozen=True)
class Engine:
    """An engine that is started once in each worker, and the seconds that it may take for a call; None: as long as it likes."""

    start: Callable[[], Call]
    timeout: float | None = None


_started: dict[str, Call] = {}


def _asked(call: Call, sources: list, timeout: float | None) -> list[tuple]:
    """(payload, invariants_ok, score, error) of sources. Where a call fails or is late, its sources are asked for one by one, and each failure is its own."""
    try:
        if timeout is None:
            made = call(sources)
        else:
            pool = ThreadPoolExecutor(1)
            try:
                made = pool.submit(call, sources).result(timeout)
            finally:
                pool.shutdown(wait=False, cancel_futures=True)  # a call that hangs does not hold up the next one
        if len(made) != len(sources):
            raise ValueError(f"{len(made)} results for {len(sources)} sources")
        return [(*m, None) for m in made]
    except Exception as e:  # noqa: BLE001  an engine is foreign code
        if len(sources) > 1:
            return [x for s in sources for x in _asked(call, [s], timeout)]
        return [(None, False, None, "timeout" if isinstance(e, TimeoutError) else f"{type(e).__name__}: {e}")]


def queue(formulas: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Nodes whose confidence is below the threshold, or unknown."""
    return formulas.filter(F.coalesce(F.col("confidence"), F.lit(0.0)) < threshold)


def calibrated_queue(nodes: DataFrame, judged: DataFrame, correct: float = 0.8, bins: int = 1_000) -> DataFrame:
    """Nodes (confidence, ...) whose confidence stands for less than a share of `correct` right ones, by a curve fitted to `judged` (confidence, correct).

    With `calibrated`, that share; nodes with an unknown confidence are in, and without judged rows all are.
    """
    curve = isotonic(judged, F.col("confidence"), F.col("correct"), bins)
    return calibrated(curve, nodes, F.col("confidence")).filter(F.coalesce(F.col("calibrated"), F.lit(0.0)) < correct)


def climb(nodes: DataFrame, engines: list[tuple[str, Engine | Call]]) -> DataFrame:
    """Attempts (node_id, rung, engine, payload, invariants_ok, score, error) of the nodes (node_id, source), rung by rung.

    Each rung sees only nodes that no earlier rung has solved, so the costly engines run on failures alone; every
    rung's attempts are written before the next is planned, so no engine runs twice on a node. An Engine is started once in each
    worker. Calls get batches of about BATCH_COST; one that raises, is late or returns too few results is made again for each of
    its nodes, and a node that fails alone has an attempt with its error, no payload and no invariants, and climbs on. Null node_ids
    are one id; nodes of one id are tried each, until one is solved.
    """
    if len(engines) > LAST_RUNG + 1:
        raise ValueError(f"a ladder has {LAST_RUNG + 1} rungs at most")
    kind, left, all_ = dict(nodes.dtypes)["node_id"], nodes, None
    cost = F.col("cost").cast("double") if "cost" in nodes.columns else F.length("source").cast("double")
    for rung, (name, engine) in enumerate(engines):

        def run(batches: Iterator[pa.RecordBatch], engine=engine, key=f"{uuid.uuid4().hex}") -> Iterator[pa.RecordBatch]:
            timeout = engine.timeout if isinstance(engine, Engine) else None
            if key not in _started:
                _started[key] = engine.start() if isinstance(engine, Engine) else engine
            for batch in batches:
                made, held, spent = [], [], 0.0
                for source, c in zip(batch.column("source").to_pylist(), batch.column("cost__").to_pylist(), strict=True):
                    if held and spent + (c or 0.0) > BATCH_COST:
                        made += _asked(_started[key], held, timeout)
                        held, spent = [], 0.0
                    held.append(source)
                    spent += c or 0.0
                made += _asked(_started[key], held, timeout) if held else []
                columns = [pa.array([m[k] for m in made], t) for k, t in enumerate((pa.string(), pa.bool_(), pa.float64(), pa.string()))]
                yield pa.RecordBatch.from_arrays([batch.column("node_id"), *columns], ["node_id", "payload", "invariants_ok", "score", "error"])

        tried = left.select("node_id", "source", cost.alias("cost__")).mapInArrow(run, f"node_id {kind}, payload string, invariants_ok boolean, score double, error string")
        tried = stored(tried.select("node_id", F.lit(rung).alias("rung"), F.lit(name).alias("engine"), "payload", "invariants_ok", "score", "error"), "attempts")
        all_ = tried if all_ is None else all_.unionByName(tried)
        solved = tried.filter("invariants_ok").select(F.col("node_id").alias("solved__"))
        left = left.join(solved, F.col("node_id").eqNullSafe(F.col("solved__")), "left_anti")
    return all_


def best_of(attempts: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first attempt of each node among those that keep the hard invariants, in a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return attempts.filter("invariants_ok").withColumn("place", F.row_number().over(w)).filter("place = 1").drop("place")


def settled(nodes: DataFrame, best: DataFrame) -> DataFrame:
    """Every node with its best payload; a node whose attempts all failed is uncertain. A null node_id is an id like any other."""
    own = best.select(F.col("node_id").alias("node__"), "payload", "rung", "score")
    rows = nodes.join(own, F.col("node_id").eqNullSafe(F.col("node__")), "left").drop("node__")
    return rows.withColumn("uncertain", F.col("rung").isNull()).withColumn("uncertain_reason", F.when(F.col("rung").isNull(), "every attempt failed"))
