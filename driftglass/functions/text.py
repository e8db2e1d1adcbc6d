"""Scalar functions on times, identifiers and messages."""

from __future__ import annotations

import hashlib
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def local_time(ts: Column, zone: str = "Asia/Seoul") -> Column:
    """Wall clock of a UTC time, as text."""
    return F.date_format(F.from_utc_timestamp(ts, zone), "yyyy-MM-dd HH:mm:ss")


def parsed_time(text: Column) -> Column:
    """ISO text to a timestamp; without an offset it is UTC (the session's zone)."""
    return F.try_to_timestamp(text)


def run_time(run_id: Column) -> Column:
    """Start of a run from an id like 20240101T010203Z-abc123."""
    return F.try_to_timestamp(F.substring(run_id, 1, 16), F.lit("yyyyMMdd'T'HHmmss'Z'"))


def error_class(exception: Column) -> Column:
    """Kind of a failed poll; the order of the tests matters, since a bad JSON body is also a request error."""
    return (
        F.when(exception == "HTTPError", "http")
        .when(exception.isin("ValueError", "JSONDecodeError"), "parse")
        .when(exception.isin("ConnectionError", "Timeout", "RequestException"), "network")
        .when(exception.like("Kafka%"), "kafka")
        .otherwise("other")
    )


def excluded_marker(body: Column) -> Column:
    """Whether a marker has a line that starts with status=EXCLUDED."""
    return F.exists(F.split(body, "\n"), lambda line: F.startswith(line, F.lit("status=EXCLUDED")))


def marker_version(body: Column) -> Column:
    """The code_version line of a marker, null without one."""
    return F.nullif(F.regexp_extract(body, r"(?m)^code_version=(.*)$", 1), F.lit(""))


def log_tail(log: Column, keep: int = 8) -> Column:
    """The last ``keep`` notable lines of a log."""
    lines = F.filter(F.split(log, "\n"), lambda x: x.rlike(r"^(ML_|Traceback|\w*Error)"))
    return F.slice(lines, F.greatest(F.size(lines) - (keep - 1), F.lit(1)), F.lit(keep))


def strict_date(text: str) -> date:
    """YYYY-MM-DD or ValueError."""
    got = datetime.strptime(text, "%Y-%m-%d").date()
    if got.isoformat() != text:
        raise ValueError(f"not a date: {text!r}")
    return got


def content_version(*parts: bytes) -> str:
    """Twelve hex digits of a digest of the given contents."""
    return hashlib.sha256(b"\0".join(parts)).hexdigest()[:12]


def date_text(text: Column) -> Column:
    """``strict_date`` as an expression: a date from YYYY-MM-DD, null from anything else."""
    got = F.try_to_date(text, "yyyy-MM-dd") if hasattr(F, "try_to_date") else F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date")
    return F.when(F.date_format(got, "yyyy-MM-dd") == text, got)


def version_of(parts: Column) -> Column:
    """``content_version`` of an array of texts."""
    return F.substring(F.sha2(F.array_join(parts, "\0").cast("binary"), 256), 1, 12)
