"""URL filter: fixed rules, and a logistic regression on hashed character n-grams for the rest.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path:
what follows up to ``?``, ``#`` or the end.  The longest rule that fits decides; where none
does, the regression does, trained from a small table of labelled URLs.  N-grams of host and
path are hashed to ``2 ** BITS`` slots.  All of this is Spark SQL expressions; only the slots'
weights, whose number is fixed, and the rules pass through the driver.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from extractkit.llm.common import let

BITS = 12
SIZES = (3, 4, 5)
#: The most labelled URLs that are used, by the order of their hashes.
MAX_LABELLED = 20_000
EPOCHS, STEP, PENALTY, SCALE = 30, 2.0, 1e-4, 16

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    rest = url.substr(F.instr(url, "://") + 3, F.length(url))
    found = F.translate(F.regexp_extract(rest, r"\A[^/?#]*", 0), _UPPER, _LOWER)
    return F.when(F.instr(url, "://") > 0, found).otherwise(F.lit(""))


def path(url: Column) -> Column:
    rest = url.substr(F.instr(url, "://") + 3, F.length(url))
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def slots(host_column: Column, path_column: Column) -> Column:
    """Slots (int) of all n-grams of ``host<host>`` and ``path<path>``, one for each occurrence."""

    def grams(characters: Column, size: int) -> Column:
        places = F.when(F.size(characters) >= size, F.sequence(F.lit(0), F.size(characters) - size)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.pmod(F.xxhash64(*[F.get(characters, i + k) for k in range(size)]), F.lit(1 << BITS)).cast("int"))

    def of(text: Column) -> Column:
        return let(F.split(text, ""), lambda c: F.concat(*[grams(c, size) for size in SIZES]))

    return F.concat(of(F.concat(F.lit("\x01"), host_column, F.lit("\x02"))), of(F.concat(F.lit("\x03"), path_column, F.lit("\x04"))))


def _margin(slot_column: Column, weights: list[float]) -> Column:
    """Mean weight of the slots, times ``SCALE``, and the intercept (the last weight)."""
    table = F.from_json(F.lit(json.dumps(weights[:-1])), "array<double>")
    total = let(table, lambda w: F.aggregate(slot_column, F.lit(0.0), lambda s, i: s + F.get(w, i)))
    return SCALE * total / F.greatest(F.size(slot_column), F.lit(1)) + F.lit(weights[-1])


def train(labelled: DataFrame) -> list[float]:
    """Weights of ``2 ** BITS`` slots and an intercept from ``labelled`` (``url``, ``block`` 0 or 1).

    Gradient descent over all labelled rows; each epoch is one task over at most
    ``MAX_LABELLED`` rows and brings one number a slot to the driver.  Rows with nulls are
    not used; without rows all weights are 0, which allows everything.
    """
    rows = labelled.dropna(subset=["url", "block"]).select("url", F.col("block").cast("double").alias("y")).distinct()
    rows = rows.orderBy(F.xxhash64("url"), "url", "y").limit(MAX_LABELLED)
    rows = rows.select("y", slots(host(F.col("url")), path(F.col("url"))).alias("slots")).where(F.size("slots") > 0).coalesce(1).cache()
    n, intercept = rows.count(), 1 << BITS
    weights = [0.0] * (intercept + 1)
    for epoch in range(EPOCHS if n else 0):
        error = (1 / (1 + F.exp(-_margin(F.col("slots"), weights))) - F.col("y")).alias("e")
        each = rows.select(error, F.size("slots").alias("size"), F.explode(F.concat("slots", F.array(F.lit(intercept)))).alias("slot"))
        share = F.when(F.col("slot") == intercept, F.col("e")).otherwise(SCALE * F.col("e") / F.col("size"))
        for slot, gradient in each.groupBy("slot").agg(F.sum(share)).collect():
            weights[slot] -= STEP / (1 + epoch / 20) * (gradient / n + PENALTY * weights[slot])
    rows.unpersist()
    return weights


def _fits(rule_host: str, rule_path: str, host_column: Column, path_column: Column) -> Column:
    under = (host_column == rule_host) | host_column.endswith("." + rule_host)
    return under & path_column.startswith(rule_path)


def judged(pages: DataFrame, rules: list[tuple[str, str, str]], weights: list[float]) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``block_score`` and ``verdict`` (allow or block).

    ``rules``: (verdict, host, path), a short list.  A rule fits its host and all subdomains if
    the url's path starts with the rule's; the longest rule wins, of equally long ones that
    with the longer host.  Without a rule the score decides, at one half.  A null url or one
    without ``://`` has an empty host and path; repeated rows are judged alike; no rows give
    none; columns of these names are replaced.
    """
    added = ("host", "path", "rule", "block_score", "verdict")
    rows = pages.drop(*[c for c in pages.columns if c.lower() in added])
    rows = rows.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    rule, decided = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = _fits(rule_host, rule_path, F.col("host"), F.col("path"))
        rule, decided = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule), F.when(fits, F.lit(verdict)).otherwise(decided)
    score = 1 / (1 + F.exp(-let(slots(F.col("host"), F.col("path")), lambda s: _margin(s, weights))))
    rows = rows.withColumns({"rule": rule, "block_score": score})
    return rows.withColumn("verdict", F.coalesce(decided, F.when(F.col("block_score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))))
