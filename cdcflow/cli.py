"""Command line: run a pipeline spec as streaming queries.

    python -m cdcflow run --bindings bindings.yml [--spec pipelines.yml] [--once]

The spec is found as: ``--spec``, else ``$CDCFLOW_PIPELINES``, else the bundled
sample.  The bindings file maps logical names to Spark sources:

    checkpoint: /shared/checkpoints/cdcflow     # optional; else spark.checkpoint.dir
    protect_key_conf: cdcflow.protect.key       # session conf holding the AES key
    topics:
      changes.customer: {format: kafka, options: {kafka.bootstrap.servers: "host:9092"}}
      refined.customer: {format: parquet, path: /lake/refined/customer}
    tables:
      USERS: {format: jdbc, url: "jdbc:...", table: USERS, partition_column: N, lower_bound: 0, upper_bound: 1000000, num_partitions: 32}
      ADDRESSES: {format: parquet, path: /lake/ref/addresses}
"""

from __future__ import annotations

import argparse
import os
import signal
import threading

import yaml
from pyspark.sql import SparkSession

from cdcflow.operators.pushed import FileReference, JdbcReference
from cdcflow.plans import spec as spec_mod
from cdcflow.plans.context import Context
from cdcflow.session import CHECKPOINT_CONF
from cdcflow.sources.topics import TopicBinding, read_jdbc_table
from cdcflow.streaming.runner import GROUP_ORDER, fan_outs, start_pipeline, supervise


def _reader(spark: SparkSession, c: dict):
    """A function that reads a reference table as it is when called.

    ``format: jdbc`` with ``url`` and ``table`` reads parallel ranges of
    ``partition_column`` (``lower_bound``, ``upper_bound``, ``num_partitions``).
    """
    def read():
        if c.get("format") == "jdbc" and "url" in c:
            ranges = {k: c.get(k) for k in ("partition_column", "lower_bound", "upper_bound", "num_partitions")}
            return read_jdbc_table(spark, c["url"], c["table"], c.get("options"), **ranges)
        reader = spark.read.format(c.get("format", "parquet")).options(**c.get("options", {}))
        return reader.load(c["path"]) if c.get("path") else reader.load()

    return read


def _table(spark: SparkSession, c: dict):
    """A reference table of the bindings; with ``keyed: true`` lookups read what a batch's keys need."""
    if not c.get("keyed"):
        return _reader(spark, c)
    if c.get("format") == "jdbc" and "url" in c:
        return JdbcReference(spark, c["url"], c["table"], c.get("options") or {}, c.get("partition_column"), c.get("num_partitions"))
    return FileReference(_reader(spark, c))


def run(args: argparse.Namespace) -> None:
    with open(args.bindings, encoding="utf-8") as fh:
        conf = yaml.safe_load(fh) or {}
    spark = SparkSession.builder.appName("cdcflow").getOrCreate()
    checkpoint = conf.get("checkpoint") or spark.conf.get(CHECKPOINT_CONF, None)
    if not checkpoint:
        raise SystemExit(f"set 'checkpoint' in the bindings or {CHECKPOINT_CONF}")
    bindings = {name: TopicBinding(**b) for name, b in (conf.get("topics") or {}).items()}
    key_conf = conf.get("protect_key_conf", "cdcflow.protect.key")
    tables = {name: _table(spark, c) for name, c in (conf.get("tables") or {}).items()}
    ctx = Context(spark=spark, tables=tables, protect_key=spark.conf.get(key_conf, None), refresh_seconds=conf.get("refresh_seconds", 0))
    stop = threading.Event()
    for sig in (signal.SIGTERM, signal.SIGINT):
        if threading.current_thread() is threading.main_thread():
            signal.signal(sig, lambda *_: stop.set())
    defs = spec_mod.load(args.spec)
    trigger = {"availableNow": True} if args.once else None
    root = os.path.join(checkpoint, "queries")

    def starters(groups):
        if conf.get("shared_reads"):  # one query per source topic
            outs = fan_outs(spark, [d for g in groups for d in defs[g]], ctx, bindings, root)
            return {f"fanout-{t}": (lambda f=f: f.start(trigger)) for t, f in outs.items()}
        return {
            d["name"]: (lambda d=d: start_pipeline(spark, d, ctx, bindings, root, trigger))
            for g in groups
            for d in defs[g]
        }

    try:
        if args.once:
            # drain level by level: a level's input topics are the previous level's output
            for g in GROUP_ORDER:
                supervise(spark, starters([g]), poll_seconds=1.0, max_restarts=3 if args.max_restarts is None else args.max_restarts, stop=stop)
        else:
            supervise(spark, starters(GROUP_ORDER), max_restarts=args.max_restarts, stop=stop)
    finally:
        ctx.release()


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="cdcflow")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="run every pipeline of a spec")
    r.add_argument("--spec", default=None, help="pipeline YAML (default: $CDCFLOW_PIPELINES, then the sample)")
    r.add_argument("--bindings", required=True, help="topic/table bindings YAML")
    r.add_argument("--once", action="store_true", help="process what is available, then stop")
    r.add_argument("--max-restarts", type=int, default=None, help="failures in a row before giving up (default: never; 3 with --once)")
    args = p.parse_args(argv)
    if args.cmd == "run":
        run(args)


if __name__ == "__main__":
    main()
