"""Structured Streaming runner for pipeline specs."""

from cdcflow.streaming.runner import process_batch, run_spec, start_pipeline, supervise  # noqa: F401
