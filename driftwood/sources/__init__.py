"""Batch and streaming sources (SRC-1..7)."""

from driftwood.sources.files import (  # noqa: F401
    read_cdr_csv,
    read_json_messages,
    read_metrics,
    read_pairs,
    read_pairs_text,
)
from driftwood.sources.stream import (  # noqa: F401
    SourceConfig,
    kafka_options,
    message_stream,
)
