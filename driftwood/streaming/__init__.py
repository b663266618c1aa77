"""Structured Streaming jobs: the analytics pipeline (STR-1..9, UDF-2/3)."""

from driftwood.streaming.pipeline import (  # noqa: F401
    PipelineConfig,
    run_available_now,
    start_pipeline,
    stop_all,
    windowed_stream,
)
