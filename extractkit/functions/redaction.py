"""Redaction of secrets in text and in nested rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import contains_any, strip

REDACTED = "[REDACTED]"

# Patterns and their replacements, applied in this order.
CREDENTIAL_RULES = (
    (r"(?iU)(authorization\s*:\s*)(?:bearer|basic)\s+\S+", "$1[REDACTED]"),
    (r"(?iU)\b(api[_-]?key|access[_-]?token|password|secret)\b\s*[:=]\s*([^\s,;]+)", "$1=[REDACTED]"),
    (r"(?iU)([?&](?:key|api_key|access_token)=)[^&\s]+", "$1[REDACTED]"),
)
SERVICE_RULES = (
    (
        r"(?is)(<[^>]*(?:objectZippedData|downloadReportObjectReturn|reportBytes|P_B64_CONTENT)[^>]*>)"
        r".*?(</[^>]+>)",
        "$1[REDACTED]$2",
    ),
    (r"(?iU)(Authorization\s*:\s*)(?:Bearer|Basic)\s+\S+", "$1[REDACTED]"),
    (r"(?iU)\b(password|token|secret|cookie|api[_-]?key)\b\s*[:=]\s*[^\s,;]+", "$1=[REDACTED]"),
)

# Parts of a column or key name that mark its value as secret.
SENSITIVE_NAME_PARTS = (
    "token", "authorization", "password", "cookie", "secret", "api_key", "api-key", "apikey",
    "base64", "payload", "zipped", "archive", "object_zipped_data", "p_b64_content",
    "notification_to", "recipient",
)


# Every text a rule matches holds one of these in lower case.  The last four are
# letters that match an ASCII letter once case is ignored.
_CREDENTIAL_HINTS = (
    "authorization", "password", "secret", "apikey", "api_key", "api-key",
    "accesstoken", "access_token", "access-token", "key=", "token=",
)
_SERVICE_HINTS = (
    "authorization", "password", "secret", "apikey", "api_key", "api-key", "token", "cookie",
    "objectzippeddata", "downloadreportobjectreturn", "reportbytes", "p_b64_content",
)
_FOLDED_LETTERS = ("\u017f", "\u212a", "\u0131", "\u0130")


def _rules(rules: str):
    if rules == "credentials":
        return CREDENTIAL_RULES, _CREDENTIAL_HINTS
    if rules == "service":
        return SERVICE_RULES, _SERVICE_HINTS
    raise ValueError("rules must be 'credentials' or 'service'.")


def _may_match(text: Column, hints) -> Column:
    """A byte search that rules out most texts before any pattern runs."""
    hit = contains_any(text, _FOLDED_LETTERS)
    lowered = F.transform(F.array(F.lower(text)), lambda t: contains_any(t, hints))
    return hit | F.get(lowered, F.lit(0))


def redact_text(text: Column, rules: str = "credentials") -> Column:
    """Replace secrets in a text.

    ``credentials`` keeps to authorization headers, ``name = value`` secrets and
    URL keys; ``service`` also knows tokens, cookies and binary payload elements.
    """
    patterns, hints = _rules(rules)
    clean = text
    for pattern, replacement in patterns:
        clean = F.regexp_replace(clean, pattern, replacement)
    return F.when(_may_match(text, hints), clean).otherwise(text)


def count_secrets(text: Column, rules: str = "credentials") -> Column:
    """How many places :func:`redact_text` replaces, as a bigint."""
    patterns, hints = _rules(rules)
    total, rest = F.lit(0).cast("bigint"), text
    for pattern, replacement in patterns:
        total = total + F.regexp_count(rest, F.lit(pattern)).cast("bigint")
        rest = F.regexp_replace(rest, pattern, replacement)
    return F.when(_may_match(text, hints), total).otherwise(F.lit(0).cast("bigint"))


def is_sensitive_name(name: str) -> bool:
    folded = name.casefold()
    return any(part in folded for part in SENSITIVE_NAME_PARTS)


def _sensitive_key(key: Column) -> Column:
    flag = F.lit(False)
    for part in SENSITIVE_NAME_PARTS:
        flag = flag | F.lower(key).contains(part)
    return flag


def _clean(value: Column, kind: T.DataType, rules: str | None) -> Column:
    """Rebuild one value with its sensitive parts replaced."""
    if isinstance(kind, T.StructType):
        rebuilt = F.struct(
            *[_clean_field(value.getField(f.name), f, rules).alias(f.name) for f in kind.fields]
        )
        return F.when(value.isNotNull(), rebuilt)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: _clean(item, kind.elementType, rules))
    if isinstance(kind, T.MapType):
        if isinstance(kind.valueType, T.StringType):
            return F.transform_values(
                value,
                lambda k, v: F.when(_sensitive_key(k), F.lit(REDACTED)).otherwise(
                    _clean(v, kind.valueType, rules)
                ),
            )
        # A value that is not text cannot hold the marker, so it becomes NULL.
        return F.transform_values(
            value, lambda k, v: F.when(~_sensitive_key(k), _clean(v, kind.valueType, rules))
        )
    if isinstance(kind, T.StringType) and rules:
        return redact_text(value, rules)
    return value


def _clean_field(value: Column, field: T.StructField, rules: str | None) -> Column:
    if is_sensitive_name(field.name):
        return F.lit(REDACTED)
    return _clean(value, field.dataType, rules)


def redact_columns(df: DataFrame, *, text_rules: str | None = "service") -> DataFrame:
    """Redact every column, struct field or map key whose name looks secret.

    A redacted column becomes text whatever its type was.  Other text is passed
    through :func:`redact_text` unless ``text_rules`` is None.
    """
    return df.select(
        *[_clean_field(F.col(f"`{f.name}`"), f, text_rules).alias(f.name) for f in df.schema.fields]
    )


def mask_recipient(recipients: Column) -> Column:
    """First of a comma list as ``x***@domain``; NULL for an empty list."""
    first = strip(F.substring_index(recipients, ",", 1))
    local = F.substring_index(first, "@", 1)
    domain = F.regexp_replace(first, r"(?s)^[^@]*@", "")
    initial = F.when(local == "", F.lit("*")).otherwise(F.substring(local, 1, 1))
    masked = F.when(first.contains("@"), F.concat(initial, F.lit("***@"), domain))
    return F.when(recipients != "", F.coalesce(masked, F.lit("[MASKED]")))
