"""Column-level helpers (scalar functions) shared by the operators."""

from driftwood.functions.timestamps import (  # noqa: F401
    epoch_seconds,
    micros_between,
    parse_offset_timestamp,
    repair_glued_datetime,
    timestamp_diff,
    to_utc_timestamp_col,
)
from driftwood.functions.text import (  # noqa: F401
    decimal_places,
    topic_pattern_regex,
    topic_matches,
)
from driftwood.functions.rows import select_where  # noqa: F401
