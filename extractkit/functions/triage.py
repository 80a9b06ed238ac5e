"""Error texts: code and message, retry decision, failure class."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .redaction import redact_text
from .text import contains_any, null_if_empty, strip

# HTTP states and phrases that decide a retry.
RETRY_STATUS = (408, 429, 500, 502, 503, 504)
FINAL_STATUS = (400, 401, 403, 404)
FINAL_PHRASES = (
    "authentication", "authorization", "invalid sql", "protected", "invalid base64",
    "unsupported object type", "schema mismatch", "cancelled",
)
RETRY_PHRASES = (
    "timed out", "timeout", "connection reset", "connection aborted", "temporary failure",
    "temporarily unavailable", "name resolution", "service unavailable", "bad gateway",
    "gateway timeout", "too many requests", "missing reportbytes", "invalid soap response",
)
# Phrases of a cut-off payload and of a missing catalog object.
PAYLOAD_PHRASES = (
    "invalid soap xml", "parseerror", "no element found", "truncated", "unexpected end", "reportbytes",
)
MISSING_PHRASES = (
    "unable to find reportobject", "unable to find report object", "unable to download report",
    "reportobject not found", "report object not found", "does not exist", "cannot find",
    "not found", "returned no object payload",
)

_DATABASE_ERROR = r"(?i)\b(ORA-\d{5})\s*:\s*([^\r\n]+)"


def error_code(text: Column) -> Column:
    """``ORA-ddddd`` in upper case, NULL when there is none."""
    return F.upper(null_if_empty(F.regexp_extract(text, _DATABASE_ERROR, 1)))


def error_message(text: Column) -> Column:
    """Redacted message after the code, else the redacted first line."""
    safe = redact_text(strip(text))
    coded = null_if_empty(F.regexp_extract(safe, _DATABASE_ERROR, 2))
    line = F.regexp_extract(safe, r"(?s)^([^\r\n]*)", 1)
    return null_if_empty(strip(F.coalesce(coded, line)))


def status_code(text: Column, status: Column | None = None) -> Column:
    """The given status, else a retryable status named in the text."""
    pattern = r"\b(" + "|".join(str(code) for code in RETRY_STATUS) + r")\b"
    named = null_if_empty(F.regexp_extract(text, pattern, 1)).cast("int")
    return named if status is None else F.coalesce(status.cast("int"), named)


def is_retryable(text: Column, status: Column | None = None) -> Column:
    """Retry decision: by status first, then final phrases, then retry phrases."""
    code = status_code(text, status)
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return (
        F.when(code.isin(*RETRY_STATUS), F.lit(True))
        .when(code.isin(*FINAL_STATUS), F.lit(False))
        .when(contains_any(lowered, FINAL_PHRASES), F.lit(False))
        .otherwise(contains_any(lowered, RETRY_PHRASES))
    )


def is_payload_failure(text: Column) -> Column:
    return contains_any(F.lower(F.coalesce(text, F.lit(""))), PAYLOAD_PHRASES)


def is_missing_object(text: Column) -> Column:
    return contains_any(F.lower(F.coalesce(text, F.lit(""))), MISSING_PHRASES)
