"""Run pipeline definitions as checkpointed Structured Streaming queries.

One streaming query per pipeline definition.  Each micro-batch is refined
with exactly the batch plan (``cdcflow.plans.build``): the refinement is
stateless per record, so applying it per micro-batch equals applying it per
record, and batch-only operators (the address match's distinct/aggregate,
lookup joins) need no streaming state.  The refined micro-batch is persisted
once and written to both the destination and the fail topic.

A source read by several definitions (fan-out) feeds several queries, or one
``FanOut`` that reads and decodes each micro-batch once for all of them.
``supervise`` restarts a failed query from its checkpoint.  Reference tables are
prepared again as the context's refresh interval says, by default per micro-batch.
"""

from __future__ import annotations

import logging
import threading
import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cdcflow.operators.changes import keyed_changes
from cdcflow.operators.rejects import REJECT_COL
from cdcflow.plans import build, spec
from cdcflow.plans.context import Context
from cdcflow.sources import files
from cdcflow.sources.topiclog import is_log
from cdcflow.sources.topics import RAW_VALUE, opened, read_topic, write_topic
from cdcflow.streaming.state import BUCKETS, StateTable

log = logging.getLogger("cdcflow.streaming")

GROUP_ORDER = ("lv1", "api", "lv2")


def process_batch(batch: DataFrame, batch_id: int, defn: dict, ctx: Context, bindings: dict) -> dict:
    """Refine one micro-batch and write successes and rejects; returns counts."""
    with ctx.batch():
        return _process(batch, batch_id, defn, ctx, bindings)


def _process(batch: DataFrame, batch_id: int, defn: dict, ctx: Context, bindings: dict) -> dict:
    batch = build.sequenced(opened(batch, defn["sourceTopic"], bindings) if defn.get("sourceTopic") in bindings else batch)
    obs = Observation(f"progress_{defn['name']}_{batch_id}")
    source = batch
    mine = not batch.is_cached and (defn.get("group") == "api" or any(hasattr(t, "rows") for t in ctx.tables.values()))
    if mine:  # keys, or addresses, are read before rows are refined
        source = batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    batch, dead = build.undecodable(batch, defn)
    refined = build.refine(batch, defn, ctx)
    op = F.col("__op") if "__op" in refined.columns else F.lit(None)
    refined = refined.observe(
        obs,
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(F.col(REJECT_COL).isNotNull(), 1)).alias("rejects"),
        F.count(F.when(op == "c", 1)).alias("c"),
        F.count(F.when(op == "u", 1)).alias("u"),
        F.count(F.when(op == "r", 1)).alias("r"),
        F.count(F.when(op == "d", 1)).alias("d"),
    )
    refined = refined.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        routed = build.route(refined, defn)
        write_topic(routed.success, defn["destinationTopic"], bindings, batch_id, defn["name"])
        write_topic(routed.rejects, defn["failTopic"], bindings, batch_id, defn["name"])
        if dead is not None and defn.get("deadLetterTopic"):
            write_topic(dead, defn["deadLetterTopic"], bindings, batch_id, defn["name"])
        elif dead is not None:
            write_topic(build.dead_letter_rejects(dead, defn, ctx), defn["failTopic"], bindings, batch_id, f"{defn['name']}-undecodable")
        metrics = obs.get
    finally:
        refined.unpersist()
        if mine:
            source.unpersist()
    log.info("[%s] batch %s -> %s: %s", defn["name"], batch_id, defn["destinationTopic"], metrics)
    return metrics


def start_pipeline(
    spark: SparkSession,
    defn: dict,
    ctx: Context,
    bindings: dict,
    checkpoint_root: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    src = read_topic(spark, defn["sourceTopic"], bindings, streaming=True)
    writer = (
        src.writeStream.queryName(defn["name"])
        .option("checkpointLocation", f"{checkpoint_root}/{defn['name']}")
        .foreachBatch(lambda df, bid: process_batch(df, bid, defn, ctx, bindings))
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


class FanOut:
    """One reader of a source topic for all definitions that take it.

    A micro-batch is read and decoded once, persisted, and refined for every
    definition.  A definition that fails neither stops nor repeats the others: the
    batch is set aside for it (``backlog/<definition>/<batch>``) and given to it
    again, alone and in order, before its next batch; until then it falls behind.
    Marks of finished batches (``done/<definition>``) keep a replayed micro-batch from
    being written again.  With ``most_behind`` batches waiting, a definition's
    failure fails the query.
    """

    def __init__(self, spark: SparkSession, topic: str, defns: list[dict], ctx: Context, bindings: dict, root: str, most_behind: int = 100):
        self.spark, self.topic, self.defns, self.ctx, self.bindings = spark, topic, defns, ctx, bindings
        self.root, self.most_behind = root.rstrip("/"), most_behind
        self.lock = threading.Lock()

    def _done(self, name: str) -> int:
        marks = [int(n) for n in files.names(self.spark, f"{self.root}/done/{name}") if n.isdigit()]
        return max(marks, default=-1)

    def _finish(self, name: str, batch_id: int) -> None:
        before = self._done(name)
        files.write_once(self.spark, f"{self.root}/done/{name}/{batch_id}", "")
        if before >= 0 and before != batch_id:
            files.remove(self.spark, f"{self.root}/done/{name}/{before}")

    def waiting(self, name: str) -> list[int]:
        """Batches set aside for a definition, oldest first."""
        done, at = self._done(name), f"{self.root}/backlog/{name}"
        return sorted(int(n) for n in files.names(self.spark, at) if n.isdigit() and int(n) > done and files.exists(self.spark, f"{at}/{n}/_SUCCESS"))

    def _try(self, batch: DataFrame, batch_id: int, defn: dict) -> Exception | None:
        try:
            process_batch(batch, batch_id, defn, self.ctx, self.bindings)
        except Exception as e:  # noqa: BLE001  (whatever a destination does must not stop the others)
            log.warning("[%s] batch %s of %s failed: %s", defn["name"], batch_id, self.topic, e)
            return e
        self._finish(defn["name"], batch_id)
        return None

    def retry(self, defn: dict) -> bool:
        """Give a definition the batches that wait for it; true if none is left."""
        for n in self.waiting(defn["name"]):
            path = f"{self.root}/backlog/{defn['name']}/{n}"
            if self._try(self.spark.read.parquet(path), n, defn) is not None:
                return False
            files.remove(self.spark, path)
        return True

    def process(self, batch: DataFrame, batch_id: int) -> dict[str, str]:
        """Route one micro-batch to every definition; returns what became of it, by definition."""
        out = {}
        batch = build.sequenced(opened(batch, self.topic, self.bindings)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for defn in self.defns:
                name = defn["name"]
                if batch_id <= self._done(name):
                    out[name] = "done before"
                    continue
                if batch_id in self.waiting(name):
                    out[name] = "done" if self.retry(defn) else "waits"
                    continue
                error = None if self.retry(defn) else RuntimeError("earlier batches wait")
                if error is None:
                    error = self._try(batch, batch_id, defn)
                if error is not None:
                    if len(self.waiting(name)) >= self.most_behind:
                        raise error
                    batch.write.mode("overwrite").parquet(f"{self.root}/backlog/{name}/{batch_id}")
                out[name] = "done" if error is None else "waits"
        finally:
            batch.unpersist()
        return out

    def start(self, trigger: dict | None = None) -> StreamingQuery:
        src = read_topic(self.spark, self.topic, self.bindings, streaming=True)
        writer = (src.writeStream.queryName(f"fanout-{self.topic}").option("checkpointLocation", f"{self.root}/checkpoint")
                  .foreachBatch(lambda df, n: self.process(df, n) and None))
        return (writer.trigger(**trigger) if trigger else writer).start()


def fan_outs(spark: SparkSession, defns: list[dict], ctx: Context, bindings: dict, checkpoint_root: str) -> dict[str, FanOut]:
    """One ``FanOut`` per source topic of some definitions, by topic."""
    by_topic: dict[str, list[dict]] = {}
    for d in defns:
        by_topic.setdefault(d["sourceTopic"], []).append(d)
    return {t: FanOut(spark, t, ds, ctx, bindings, f"{checkpoint_root}/fanout-{t}") for t, ds in by_topic.items()}


def run_spec(
    spark: SparkSession,
    spec_text: str | None,
    ctx: Context,
    bindings: dict,
    checkpoint_root: str,
    trigger: dict | None = None,
    groups: tuple[str, ...] = GROUP_ORDER,
) -> list[StreamingQuery]:
    """Start every pipeline of the spec (groups in order lv1, api, lv2)."""
    defs = spec.load(spec_text)
    queries = []
    for g in groups:
        for d in defs[g]:
            queries.append(start_pipeline(spark, d, ctx, bindings, checkpoint_root, trigger))
    return queries


def merge_batch(
    batch: DataFrame, batch_id: int, path: str, key_cols: list[str], order_cols: list[str], op_col: str = "__op", writer: str = "", buckets: int = BUCKETS
) -> DataFrame:
    """Merge one micro-batch of changes into the state under ``path``; returns the new state, deletes included.

    A batch that ``writer`` has merged before is not merged again.
    """
    table = StateTable(batch.sparkSession, path, key_cols, order_cols, op_col, buckets)
    table.merge(batch, batch_id, writer)
    return table.read(with_deletes=True)


def merge_topic(
    batch: DataFrame, batch_id: int, table: StateTable, topic: str, bindings: dict, dead_letter_topic: str | None = None, writer: str = ""
) -> None:
    """Merge a micro-batch of topic records: values as changes, tombstones as deletes of their
    key; values that did not decode go to the dead-letter topic, whatever becomes of the merge."""
    batch, dead = build.undecodable(opened(batch, topic, bindings), {"sourceTopic": topic})
    if dead is not None:
        write_topic(dead, dead_letter_topic, bindings, batch_id, f"state-{topic}")
    flat = "value" not in batch.columns
    changes = batch if flat else keyed_changes(batch, table.key_cols, table.order_cols, op_col=table.op_col)
    table.merge(changes, batch_id, writer)


def start_state(
    spark: SparkSession, topic: str, bindings: dict, path: str, checkpoint: str,
    key_cols: list[str], order_cols: list[str], op_col: str = "__op", trigger: dict | None = None,
    dead_letter_topic: str | None = None, buckets: int = BUCKETS,
) -> StreamingQuery:
    """Keep the latest state per key of a topic of change records (flat, or ``key`` and ``value`` structs).

    Tombstones delete their key; they need order columns beside the value (an
    offset, the source's sequence).  A topic that is decoded on reading needs a
    dead-letter topic.
    """
    src = read_topic(spark, topic, bindings, streaming=True)
    shape = read_topic(spark, topic, bindings) if is_log(src) else src
    if RAW_VALUE in shape.columns and dead_letter_topic is None:
        raise ValueError(f"values of topic {topic!r} may not decode: name a dead_letter_topic for them")
    if "value" in shape.columns:
        keyed_changes(shape.drop(RAW_VALUE), key_cols, order_cols, op_col=op_col)  # fails here, not in the first batch
    table = StateTable(spark, path, key_cols, order_cols, op_col, buckets)

    def each(df: DataFrame, n: int) -> None:
        # the query's own id: batches of another checkpoint are not taken for replays
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        merge_topic(df, n, table, topic, bindings, dead_letter_topic, query)

    writer = src.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
    return (writer.trigger(**trigger) if trigger else writer).start()


def supervise(
    spark: SparkSession,
    starters: dict,
    poll_seconds: float = 5.0,
    max_restarts: int | None = None,
    stop: threading.Event | None = None,
    longest_wait: float = 60.0,
) -> None:
    """Keep queries running until all stopped cleanly or ``stop`` is set.

    ``starters`` maps a query name to a zero-argument start function.  A query that
    fails, while it runs or when it is started, starts again from its checkpoint, at once and then after doubling waits
    up to ``longest_wait``; a finished micro-batch resets its wait.  With
    ``max_restarts`` a query that fails so often in a row without progress raises.
    Every query still running is stopped on the way out.
    """
    stop = stop or threading.Event()
    running: dict = {}
    failures = dict.fromkeys(starters, 0)
    due = {name: time.monotonic() for name in starters}

    def failed(name: str, err) -> None:
        failures[name] += 1
        if max_restarts is not None and failures[name] > max_restarts:
            raise RuntimeError(f"query {name} failed {failures[name]} times in a row: {err}") from None
        wait = 0.0 if failures[name] == 1 else min(longest_wait, 2.0 ** (failures[name] - 2))
        log.warning("restarting %s in %.0f s after failure: %s", name, wait, err)
        due[name] = time.monotonic() + wait

    try:
        while (running or due) and not stop.is_set():
            for name in [n for n, t in due.items() if t <= time.monotonic()]:
                del due[name]
                try:
                    running[name] = starters[name]()
                except Exception as e:  # noqa: BLE001  (one query's start must not stop the others)
                    failed(name, e)
            for name, q in list(running.items()):
                if q.lastProgress is not None:  # a finished micro-batch
                    failures[name] = 0
                if q.isActive:
                    continue
                del running[name]
                if (err := q.exception()) is not None:
                    failed(name, err)
            if running or due:
                stop.wait(poll_seconds)
    finally:
        for q in running.values():
            q.stop()
