"""Text and JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratus.functions.constants import DAILY_WORD, LIMIT_WORDS

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def contains_any(c: ColumnOrName, words) -> Column:
    """Case-insensitive: does the text contain any of ``words``?"""
    low = F.lower(_c(c))
    out = F.lit(False)
    for w in words:
        out = out | low.contains(w.lower())
    return out


def is_json_object(c: ColumnOrName) -> Column:
    c = _c(c)
    return F.ltrim(c).startswith("{") & F.get_json_object(c, "$").isNotNull()


def quota_text(body: ColumnOrName) -> Column:
    """Reason text of a response: ``reason`` of a JSON object (or ''), else the raw body."""
    body = _c(body)
    return F.when(is_json_object(body), F.coalesce(F.get_json_object(body, "$.reason"), F.lit(""))) \
        .otherwise(F.coalesce(body, F.lit("")))


def is_daily_limit(status: ColumnOrName, body: ColumnOrName) -> Column:
    """4xx response whose reason mentions the daily quota ("daily" and "limit"/"exceeded")."""
    status = _c(status)
    t = F.lower(quota_text(body))
    return (status.between(400, 499)
            & t.contains(DAILY_WORD)
            & contains_any(t, LIMIT_WORDS))
