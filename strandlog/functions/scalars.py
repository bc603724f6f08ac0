"""Small functions of the control plane: lag, staleness, cursors, parameters, credentials."""

from __future__ import annotations

import hashlib
import hmac
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

STUCK_MS = 900_000


def lag_seconds(now: Column, cursor: Column) -> Column:
    """Seconds from the cursor to ``now``, halves up; NULL without a cursor."""
    ms = F.unix_millis(now.cast("timestamp")) - F.unix_millis(cursor.cast("timestamp"))
    return F.floor(ms / F.lit(1000.0) + F.lit(0.5))


def stuck(status: Column, started: Column, now: Column, limit_ms: int = STUCK_MS) -> Column:
    """Whether a run has been under way for longer than it can live."""
    ms = F.unix_millis(now.cast("timestamp")) - F.unix_millis(started.cast("timestamp"))
    return F.coalesce((status == "running") & (ms > limit_ms), F.lit(False))


def cursor_of(updated_at: Column, pk: Column) -> Column:
    """The cursor, or NULL if either part is."""
    return F.when(updated_at.isNotNull() & pk.isNotNull(), F.struct(updated_at.alias("updated_at"), pk.alias("pk")))


def positive_number(text: str | float | None, fallback: float | None = None) -> float | None:
    """A finite number above 0, or the fallback."""
    try:
        value = float(text)  # type: ignore[arg-type]
    except (TypeError, ValueError):
        return fallback
    return value if math.isfinite(value) and value > 0 else fallback


def enabled(flag: str | None) -> bool:
    """The kill switch: on only for exactly "true"."""
    return flag == "true"


def authorized(header: str | None, secret: str | None) -> bool:
    """Constant-time check of a bearer header; closed without a secret."""
    if not secret or not header or not header.startswith("Bearer "):
        return False
    digest = lambda s: hashlib.sha256(s.encode()).digest()
    return hmac.compare_digest(digest(header[len("Bearer ") :]), digest(secret))
