"""Interface registry: build, normalise, filter, match selectors, resolve.

Resolution works on tables of requests.  A request that cannot be resolved gets a
status instead of an exception; :func:`require_resolved` turns it into one.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import ResolutionError, SchemaMismatchError
from ..functions.naming import document_account, selector_key, singular_key, submission_job_name
from ..functions.text import null_if_empty, strip
from ..session import stored

# The registry's columns and its order.
REGISTRY_COLUMNS = (
    "ERP_FAMILY", "APPLICATION_ID", "BUSINESS_OBJECT", "ERP_INTERFACE_OPTIONS_ID", "UCM_ACCOUNT",
    "DOCUMENT_ACCOUNT", "LOAD_JOB_NAME", "IMPORT_JOB_NAME", "CONTROL_FILE_NAME", "INTERFACE_TABLE_NAMES",
)
REGISTRY_ORDER = (
    "ERP_FAMILY", "APPLICATION_ID", "BUSINESS_OBJECT", "ERP_INTERFACE_OPTIONS_ID", "CONTROL_FILE_NAME",
)
CONFIGURATION = ("ERP_INTERFACE_OPTIONS_ID", "UCM_ACCOUNT", "IMPORT_JOB_NAME", "BUSINESS_OBJECT")

# Match scores by what matched and how.
EXACT_SCORES = {"business_object": 100, "control_file": 90, "interface_table": 80}
FRIENDLY_SCORES = {"business_object": 50, "control_file": 40, "interface_table": 30}


def build_registry(options: DataFrame, details: DataFrame, key: str = "erp_interface_options_id") -> DataFrame:
    """Options joined with their details; options without details are kept."""
    joined = options.join(details, key, "left")
    return joined.select(
        "erp_family",
        "application_id",
        "business_object",
        key,
        "ucm_account",
        document_account(F.col("ucm_account")).alias("document_account"),
        "load_job_name",
        "import_job_name",
        "control_file_name",
        "interface_table_names",
    )


def registry_order() -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in REGISTRY_ORDER]


def normalize_registry(df: DataFrame) -> DataFrame:
    """Upper-case names, all required columns, trimmed text, no NULLs."""
    upper = df.toDF(*[name.strip().upper() for name in df.columns])
    missing = sorted(set(REGISTRY_COLUMNS) - set(upper.columns))
    if missing:
        raise SchemaMismatchError("The registry is missing columns: " + ", ".join(missing))
    return upper.select(
        *[strip(F.coalesce(F.col(name).cast("string"), F.lit(""))).alias(name) for name in REGISTRY_COLUMNS]
    )


def filter_registry(
    registry: DataFrame,
    *,
    erp_family: str | None = None,
    application_id: str | None = None,
    business_object: str | None = None,
    interface_options_id: str | None = None,
    control_file_name: str | None = None,
    interface_table: str | None = None,
) -> DataFrame:
    """Rows equal to the given values, without regard to case and outer blanks."""

    def same(value: Column, wanted: str) -> Column:
        return F.lower(strip(value)) == str(wanted).strip().lower()

    wanted = {
        "ERP_FAMILY": erp_family,
        "APPLICATION_ID": application_id,
        "BUSINESS_OBJECT": business_object,
        "ERP_INTERFACE_OPTIONS_ID": interface_options_id,
        "CONTROL_FILE_NAME": control_file_name,
    }
    for name, value in wanted.items():
        if value is not None:
            registry = registry.where(same(F.col(name), value))
    if interface_table is not None:
        tables = F.split("INTERFACE_TABLE_NAMES", ",")
        registry = registry.where(F.exists(tables, lambda t: same(t, interface_table)))
    return registry


class RegistrySource:
    """A live registry with a fallback; remembers which one answered and why."""

    def __init__(self, live, fallback=None):
        """``live`` and ``fallback`` are functions that return a DataFrame."""
        self._live, self._fallback = live, fallback
        self._rows: DataFrame | None = None
        self.source = self.refreshed_at = self.refresh_error = None

    def rows(self, force: bool = False) -> DataFrame:
        """The normalised registry with its provenance columns."""
        if not isinstance(force, bool):
            raise ValueError("force must be True or False.")
        if self._rows is None or force:
            self._refresh()
        return self._rows.select(
            "*",
            F.lit(self.source).alias("SOURCE"),
            F.lit(self.refreshed_at).cast("timestamp").alias("REFRESHED_AT"),
            F.lit(self.refresh_error).cast("string").alias("REFRESH_ERROR"),
        )

    def _refresh(self) -> None:
        try:
            fresh = normalize_registry(self._live()).cache()
            fresh.count()
            found = ("live", datetime.datetime.now(datetime.timezone.utc), None)
        except Exception as error:
            fresh = normalize_registry(self._fallback()).cache() if self._fallback else None
            if fresh is None or fresh.isEmpty():
                raise ResolutionError("The registry cannot be read and there is no fallback.") from error
            found = ("fallback", None, str(error).splitlines()[0])
        if self._rows is not None:
            self._rows.unpersist()
        self._rows = fresh
        self.source, self.refreshed_at, self.refresh_error = found


# --- selectors ----------------------------------------------------------------------


def match_keys(registry: DataFrame, keep) -> DataFrame:
    """Every way a registry row can be asked for: ``match_key, score, match_type``."""
    tables = F.transform(
        F.filter(F.split("INTERFACE_TABLE_NAMES", ","), lambda t: strip(t) != ""), lambda t: selector_key(t)
    )
    keyed = registry.select(
        *keep,
        selector_key(F.col("BUSINESS_OBJECT")).alias("_object"),
        selector_key(F.col("CONTROL_FILE_NAME")).alias("_control"),
        tables.alias("_tables"),
    )

    def entry(key: Column, kind: str) -> Column:
        return F.array(
            *[
                F.struct(
                    value.alias("match_key"),
                    F.lit(score).alias("score"),
                    F.lit(f"{kind}_{style}").alias("match_type"),
                    F.lit(style).alias("style"),
                )
                for value, score, style in (
                    (key, EXACT_SCORES[kind], "exact"),
                    (singular_key(key), FRIENDLY_SCORES[kind], "friendly"),
                )
            ]
        )

    ways = F.concat(
        entry(F.col("_object"), "business_object"),
        entry(F.col("_control"), "control_file"),
        F.flatten(F.transform("_tables", lambda t: entry(t, "interface_table"))),
    )
    # Two tables with one normal form are one way.
    return keyed.select(*keep, F.inline_outer(F.array_distinct(ways))).where("match_key <> ''")


def match_selectors(selectors: DataFrame, registry: DataFrame, *, selector: str = "selector") -> DataFrame:
    """Registry rows with the best score of each distinct selector.

    An equi-join on normal forms: distinct selectors against the match keys of
    the registry, so the result grows with the registry and not with the number
    of times a selector is asked for.
    """
    wanted = selectors.select(selector).distinct().withColumn("_key", selector_key(F.col(selector)))
    wanted = wanted.where("_key <> ''")
    asked = wanted.select(
        selector,
        F.inline_outer(
            F.array(
                F.struct(F.col("_key").alias("match_key"), F.lit("exact").alias("style")),
                F.struct(singular_key(F.col("_key")).alias("match_key"), F.lit("friendly").alias("style")),
            )
        ),
    )
    columns = list(registry.columns)
    keyed = match_keys(registry, columns)
    # The best score needs the distinct keys only; whole rows are joined once.
    offers = keyed.select("match_key", "style", "score").distinct()
    best = asked.join(offers, ["match_key", "style"]).groupBy(selector).agg(F.max("score").alias("score"))
    top = asked.join(best, selector).join(keyed, ["match_key", "style", "score"])
    return top.select(selector, *columns, "score", "match_type")


#: Copies of a many-to-one join's smaller side, so that one frequent key is dealt to as many tasks.
SALTS = 16


def _salted_join(many: DataFrame, one: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``many`` with the one row of ``one`` for its keys; a key that most rows share does not end in one task."""
    salted = many.withColumn("_salt", F.pmod(F.xxhash64(*many.columns), F.lit(SALTS)).cast("int"))
    copies = one.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")


def configuration_lists(forms: DataFrame, registry: DataFrame, *, options: bool = False) -> DataFrame:
    """Inverted lists ``_form, _only, configuration…, DOCUMENT_ACCOUNT``: the configurations of each form's best matches.

    ``_only`` is ``''`` for the whole list; with ``options`` there is also one list for each form and
    option id.  Written once, since lengths, candidates and checks all read it.
    """
    lists = (
        match_selectors(forms, registry, selector="_form")
        .groupBy("_form", *CONFIGURATION)
        .agg(F.max("DOCUMENT_ACCOUNT").alias("DOCUMENT_ACCOUNT"))
    )
    only = F.array(F.lit(""), *([F.col("ERP_INTERFACE_OPTIONS_ID")] if options else []))
    return stored(lists.withColumn("_only", F.explode(F.array_distinct(only))), "configuration-lists")


def shared_configurations(signatures: DataFrame, lists: DataFrame) -> DataFrame:
    """``_forms, _only, _matched, common_configurations, _pick``: what the forms of each signature have in common.

    Candidates come from a signature's shortest list alone; each other list is only asked whether it holds
    them.  So a form that every request names costs a look-up for each candidate and never a pair for each of
    its entries.  ``_matched`` counts the forms that have a list at all.
    """
    sized = lists.groupBy("_form", "_only").agg(F.count(F.lit(1)).alias("_length"))
    named = signatures.withColumn("_form", F.explode("_forms"))
    lengths = (
        _salted_join(named, sized, ["_form", "_only"])
        .groupBy("_forms", "_only")
        .agg(F.count(F.lit(1)).alias("_matched"), F.min(F.struct("_length", "_form"))["_form"].alias("_lead"))
    )
    lengths = stored(lengths, "signatures")
    whole = lengths.where(F.col("_matched") == F.size("_forms"))
    entries = lists.withColumnRenamed("_form", "_lead")
    candidates = whole.join(entries, ["_lead", "_only"])
    others = candidates.withColumn("_form", F.explode_outer(F.filter("_forms", lambda f: f != F.col("_lead"))))
    held = lists.select("_form", "_only", *CONFIGURATION, F.col("DOCUMENT_ACCOUNT").alias("_account"), F.lit(1).alias("_held"))
    asked = others.join(held, ["_form", "_only", *CONFIGURATION], "left")
    common = (
        asked.groupBy("_forms", "_only", *CONFIGURATION)
        .agg(F.count("_form").alias("_asked"), F.count("_held").alias("_found"), F.max(F.greatest("DOCUMENT_ACCOUNT", "_account")).alias("DOCUMENT_ACCOUNT"))
        .where("_asked = _found")
        .groupBy("_forms", "_only")
        .agg(F.count(F.lit(1)).alias("common_configurations"), F.min(F.struct(*CONFIGURATION, "DOCUMENT_ACCOUNT")).alias("_pick"))
    )
    return stored(lengths.drop("_lead").join(common, ["_forms", "_only"], "left"), "shared")


def resolve_requests(
    requests: DataFrame,
    registry: DataFrame,
    *,
    request: str = "request_id",
    selector: str = "selector",
    option: str | None = None,
) -> DataFrame:
    """One configuration per request, or the reason there is none.

    ``requests`` has one row per request and selector, and optionally a column
    with a required option id, the same for all rows of a request.  Status: ``RESOLVED``, ``NO_MATCH`` (a selector
    without any row), ``CONFLICT`` (no configuration shared by all selectors) or
    ``AMBIGUOUS`` (several).  Requests that name the same normal forms are worked out once.
    """
    asked = requests.where(strip(F.col(selector)) != "").withColumn("_form", selector_key(F.col(selector)))
    only = F.coalesce(strip(F.max(option).cast("string")), F.lit("")) if option else F.lit("")
    asked = asked.groupBy(request).agg(
        F.count_distinct(selector).alias("selectors"), F.array_sort(F.collect_set("_form")).alias("_forms"), only.alias("_only")
    )
    asked = stored(asked, "requests")
    signatures = asked.select("_forms", "_only").distinct()
    forms = asked.select(F.explode("_forms").alias("_form")).distinct()
    shared = shared_configurations(signatures, configuration_lists(forms, registry, options=option is not None))
    out = _salted_join(asked, shared, ["_forms", "_only"], "left")
    common = F.coalesce("common_configurations", F.lit(0))
    status = (
        F.when(F.coalesce("_matched", F.lit(0)) < F.size("_forms"), F.lit("NO_MATCH"))
        .when(common == 0, F.lit("CONFLICT"))
        .when(common > 1, F.lit("AMBIGUOUS"))
        .otherwise(F.lit("RESOLVED"))
    )
    pick = lambda name: F.when(F.col("status") == "RESOLVED", F.col("_pick").getField(name))
    account = F.coalesce(
        null_if_empty(pick("DOCUMENT_ACCOUNT")), document_account(F.btrim(pick("UCM_ACCOUNT"), F.lit("/")))
    )
    return out.withColumn("status", status).select(
        request,
        F.col("selectors").cast("bigint").alias("selectors"),
        common.cast("bigint").alias("common_configurations"),
        "status",
        pick("BUSINESS_OBJECT").alias("business_object"),
        pick("ERP_INTERFACE_OPTIONS_ID").alias("interface_options_id"),
        account.alias("document_account"),
        submission_job_name(pick("IMPORT_JOB_NAME")).alias("job_name"),
    )


def resolve_control_files(
    requests: DataFrame,
    resolved: DataFrame,
    registry: DataFrame,
    *,
    request: str = "request_id",
    selector: str = "selector",
) -> DataFrame:
    """The one control file of each selector within its request's configuration."""
    matches = (
        match_selectors(requests, registry, selector=selector)
        .where("CONTROL_FILE_NAME <> ''")
        .groupBy(selector, F.col("ERP_INTERFACE_OPTIONS_ID").alias("interface_options_id"))
        .agg(F.count_distinct("CONTROL_FILE_NAME").alias("control_files"), F.min("CONTROL_FILE_NAME").alias("_file"))
    )
    wanted = requests.select(request, selector).where(strip(F.col(selector)) != "").dropDuplicates()
    wanted = wanted.join(resolved.where("status = 'RESOLVED'").select(request, "interface_options_id"), request)
    joined = wanted.join(matches, [selector, "interface_options_id"], "left")
    found = F.coalesce("control_files", F.lit(0)).cast("bigint")
    stem = F.regexp_replace(F.substring_index("control_file", "/", -1), r"(?<=.)\.[^.]*$", "")
    return joined.select(
        request,
        selector,
        "interface_options_id",
        found.alias("control_files"),
        F.when(found == 1, F.col("_file")).alias("control_file"),
        F.when(found == 1, F.lit("RESOLVED")).otherwise(F.lit("NOT_ONE")).alias("status"),
    ).withColumn("load_file", F.concat(stem, F.lit(".csv")))


def duplicate_load_files(control_files: DataFrame, *, request: str = "request_id") -> DataFrame:
    """Load-file names that two selectors of one request would both write."""
    counted = control_files.where("load_file IS NOT NULL").groupBy(request, "load_file")
    return counted.agg(F.count(F.lit(1)).alias("selectors")).where("selectors > 1")


def require_resolved(report: DataFrame) -> None:
    """Raise when any row of a resolution report is not RESOLVED."""
    row = report.where("status <> 'RESOLVED'").limit(1).collect()
    if row:
        raise ResolutionError(f"Not resolved: {row[0].asDict()}")
