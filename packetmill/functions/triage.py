"""Verdicts on files and failures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reasons recorded for a file that is set aside.
EMPTY = "empty file (0 bytes)"
UNREADABLE = "cannot open as PDF"
LOCKED = "password-protected PDF"
NO_PAGES = "PDF has 0 pages"

# Failures worth another attempt, by class.
TRANSIENT_CLASSES = [
    "TimeoutError", "ConnectionError", "TimeoutException", "TransportError", "ServerError",
    "ServiceUnavailable", "TooManyRequests", "ResourceExhausted", "DeadlineExceeded",
    "InternalServerError",
]


def triage_reason(length: Column, openable: Column, needs_pass: Column, page_count: Column) -> Column:
    """Why a file cannot be processed; null when it can. The first failing check names it."""
    return (
        F.when(length == 0, EMPTY)
        .when(~openable, UNREADABLE)
        .when(needs_pass, LOCKED)
        .when(page_count == 0, NO_PAGES)
    )


def is_transient(error_class: Column, code: Column) -> Column:
    """True when the attempt could succeed next time. A client error counts only as code 429."""
    rate_limited = (error_class == "ClientError") & F.coalesce(code == 429, F.lit(False))
    return F.coalesce(error_class.isin(TRANSIENT_CLASSES) | rate_limited, F.lit(False))
