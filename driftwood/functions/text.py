"""Text helpers: topic wildcards, decimal-place counts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def topic_pattern_regex(pattern: str) -> str:
    """Compile an MQTT-style subscription (``+`` one level, ``#`` the rest)
    to an anchored regular expression."""
    parts = []
    for level in pattern.split("/"):
        if level == "+":
            parts.append("[^/]+")
        elif level == "#":
            parts.append(".*")
        else:
            parts.append(re.escape(level))
    return "^" + "/".join(parts) + "$"


def topic_matches(topic: Column | str, patterns: list[str]) -> Column:
    """True when the topic matches any subscription pattern."""
    col = F.col(topic) if isinstance(topic, str) else topic
    regex = "|".join(f"(?:{topic_pattern_regex(p)})" for p in patterns)
    return F.coalesce(col.rlike(regex), F.lit(False))


def decimal_places(value_text: Column) -> Column:
    """Digits after the decimal point of a number's text form (0 if none)."""
    return F.when(F.instr(value_text, ".") > 0,
                  F.char_length(F.substring_index(value_text, ".", -1))
                  ).otherwise(F.lit(0))
