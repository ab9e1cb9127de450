"""The two jobs: raw documents to history, and current rows to fact tables."""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataroll.functions.names import named, normalize_columns
from strataroll.operators import drift, facts, flatten, history, quality, sketches
from strataroll.plans import defaults
from strataroll.sources import envelopes, ranges, versions
from strataroll.sources.shared import scratch

log = logging.getLogger(__name__)

# Largest side a job broadcasts by its own choice, in bytes.
BROADCAST_LIMIT = 128 * 1024 * 1024


@dataclass(frozen=True)
class Settings:
    """What a run reads, checks and how strict it is. Defaults fit vehicle registrations."""

    columns: Mapping[str, str] = field(default_factory=lambda: dict(defaults.COLUMNS))
    key: str = defaults.KEY
    change_columns: Sequence[str] = tuple(defaults.CHANGE_COLUMNS)
    critical: Sequence[str] = tuple(defaults.CRITICAL)
    ranges: Mapping[str, quality.Bounds] = field(default_factory=lambda: dict(defaults.RANGES))
    unique: Sequence[str] = tuple(defaults.UNIQUE)
    #: Keep a sketch of each unique column with every version. It settles checks that certainly fail.
    sketched: bool = False
    on_new_columns: str = "warn"
    on_failed_checks: str = "warn"
    # "document": one document per file; "lines": one per line; "rows": one per file, read by ranges of lines.
    layout: str = "document"
    small_source: bool = False
    buckets: int = 0  # cut current rows by key, and write only the buckets that a snapshot touches
    compact_after: int = 0  # fold folders of closed rows where there are so many, see versions.compact
    attempts: int = 1  # runs again from the newest version where another writer committed first
    # Normalised names for the facts.
    fact_keys: Sequence[str] = tuple(facts.GROUPING_COLUMNS)
    fact_year: str = "model_year"
    fact_range: str = "electric_range"
    fact_price: str = "base_msrp"


def load_allowed_columns(path: str, spark: SparkSession | None = None) -> dict[str, str]:
    """Column types for the ``allowed_columns`` listed in a small JSON file.

    Names without a known type are text. A missing, unreadable or empty list is an error. With a
    session the file may be in any store that Spark reads.
    """
    if spark is None:
        with open(path, encoding="utf-8") as file:
            text = file.read()
    else:
        text = "".join(row.value for row in spark.read.text(path, wholetext=True).collect())
    names = json.loads(text).get("allowed_columns")
    if not names:
        raise ValueError(f"{path} lists no allowed_columns")
    return {name: defaults.COLUMNS.get(name, "string") for name in names}


def refresh_history(
    spark: SparkSession,
    raw_path: str,
    root: str,
    as_of: date,
    settings: Settings = Settings(),
    *,
    logged_at: datetime | None = None,
) -> int:
    """Merge a raw snapshot into the history under ``root``; returns the committed version.

    Raw text is parsed twice, once per half: ``meta`` (skipping the rows) and ``data``. Both land
    as Parquet, and everything after reads that; checks but uniqueness are counted while the snapshot is
    written. All tables share one version and appear together:
    ``documents, drift, snapshot, quality, quarantine, metadata, approvals, history``, and ``sketches`` if asked for.
    """
    for left in reversed(range(settings.attempts)):
        try:
            with scratch(spark, "refresh") as work:
                version = _refresh_history(spark, raw_path, root, as_of, settings, logged_at or datetime.now(), work)
            break
        except versions.Conflict:
            if not left:
                raise
            log.warning("Another run committed first; this one starts again from its version")
    if settings.compact_after:
        versions.compact(spark, root, settings.compact_after)
    return version


def _refresh_history(
    spark: SparkSession, raw_path: str, root: str, as_of: date, settings: Settings, logged_at: datetime, work: str
) -> int:
    base = versions.latest(spark, root)
    if as_of.isoformat() < base.as_of:
        raise ValueError(f"{as_of} is before the last version, of {base.as_of}")
    version, run = base.version + 1, versions.new_run()
    tables: dict[str, DataFrame] = {}

    def land(name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        tables[name] = versions.write_version(df, root, name, version, partition_by, run)
        return tables[name]

    if settings.layout == "rows":
        found_docs, records = ranges.read_ranges(spark, raw_path, folder=f"{work}/ranges")
        docs = land("documents", found_docs.drop("data"))
    else:
        docs = land("documents", envelopes.read_meta(spark, raw_path, multi_line=settings.layout != "lines"))
    found = land("drift", drift.schema_drift(docs, list(settings.columns)))
    _check_columns(found, settings, f"{root}/schema_log", logged_at)

    if settings.layout == "rows":
        size = flatten.catalog_bytes(docs.count(), settings.columns)
        rows = flatten.flatten_record_lines(
            records,
            docs,
            settings.columns,
            keep_rejected=True,
            broadcast_catalog=size <= BROADCAST_LIMIT,
        )
    else:
        raw = envelopes.read_envelopes(spark, raw_path, multi_line=settings.layout != "lines")
        rows = flatten.flatten(raw, settings.columns, keep_rejected=True)
    more = sketches.sketch_columns(rows, settings.unique) if settings.sketched else []
    observed = quality.ObservedChecks(rows, settings.critical, settings.ranges, more)
    snapshot = land("snapshot", observed.rows)
    if not drift.has_columns(snapshot, settings.columns):
        log.warning("The snapshot has no rows")

    if settings.sketched:
        kept = land("sketches", sketches.sketch_table(observed.counted(snapshot), settings.unique))
        checks = sketches.uniqueness(snapshot, kept)
        checks = checks.unionByName(observed.report(snapshot)) if observed.fused else checks
    else:
        checks = observed.report(snapshot, settings.unique)
    report = land("quality", checks)
    _check_quality(report, settings)

    business = snapshot.select(*map(named, settings.columns))
    land("quarantine", history.without_key(business, settings.key))
    land("metadata", flatten.metadata(docs))
    land("approvals", flatten.approvals(docs))

    cut = merge_history(spark, root, base, business, as_of, settings, version, run, work)
    tables[versions.HISTORY] = cut.pop("written")
    versions.commit(spark, root, version, as_of, tables, run=run, base=base, **cut)
    return version


def may_be_broadcast(stored: DataFrame) -> bool:
    """Whether Spark would broadcast a stored table by its size."""
    size = int(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size <= stored.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def merge_history(
    spark: SparkSession,
    root: str,
    base: versions.Record,
    snapshot: DataFrame,
    as_of: date,
    settings: Settings,
    version: int,
    run: str | None = None,
    work: str | None = None,
) -> dict:
    """Merge a snapshot into the history as ``base`` has it and write the result as part of ``version``.

    Returns the history as ``written``, and what ``versions.commit`` must know of its buckets. With
    ``settings.buckets``, only buckets with keys of the snapshot are read and written; the first time, or
    where their number changes, all are. The list of touched buckets is no longer than their number.

    A snapshot that is said to be small is reduced to a row a key once, and written under ``work``, as it is then used
    several times. If its size forbids a broadcast after all, one full outer join is the better plan.
    """
    small = settings.small_source and work is not None and bool(base.current)
    if small:
        latest = history.latest_per_key(snapshot, settings.key, settings.change_columns)
        latest.write.parquet(f"{work}/latest")
        snapshot = spark.read.schema(snapshot.schema).parquet(f"{work}/latest")

    def merged(current: DataFrame | None) -> DataFrame:
        return history.scd2_merge(
            snapshot,
            current,
            settings.key,
            settings.change_columns,
            as_of,
            small_source=may_be_broadcast(snapshot) if small else settings.small_source,
            reduced=small,
        )

    if not settings.buckets:
        rows = merged(versions.read_current(spark, root, base))
        return {"written": versions.write_version(rows, root, versions.HISTORY, version, [history.IS_CURRENT], run)}
    bucket = versions.bucket_of(settings.key, settings.buckets)
    keys = snapshot.filter(named(settings.key).isNotNull()).select(named(settings.key))
    anew = base.buckets != settings.buckets and bool(base.current)
    if anew:
        keys = keys.union(versions.read_current(spark, root, base).select(named(settings.key)))
    touched = sorted(r[0] for r in keys.select(bucket).distinct().collect())
    rows = merged(versions.read_current(spark, root, base, None if anew else touched))
    if versions.BUCKET in rows.columns:
        raise ValueError(f"A column named {versions.BUCKET!r} would be taken for the bucket")
    # Adaptive execution cuts large buckets over several tasks and joins small ones.
    spread = rows.withColumn(versions.BUCKET, bucket).hint("rebalance", history.IS_CURRENT, versions.BUCKET)
    written = versions.write_version(spread, root, versions.HISTORY, version, [history.IS_CURRENT, versions.BUCKET], run)
    return {"written": written, "touched": touched, "buckets": settings.buckets}


def _check_columns(
    found: DataFrame, settings: Settings, log_path: str, logged_at: datetime
) -> None:
    """Log missing columns, of which there are at most the declared ones, and gate new ones."""
    for row in found.filter(F.col("status") == drift.MISSING).collect():
        log.warning("Column %s is missing from %d documents", row.column_name, row.documents)
    line = drift.schema_gate(found, log_path, logged_at, on_new=settings.on_new_columns)
    if line:
        log.warning(line)


def _check_quality(report: DataFrame, settings: Settings) -> None:
    """Log failed checks; the report has one row per configured check."""
    failures = quality.failures(report).collect()
    for row in failures:
        log.warning("%s check failed for %s: %s", row.check, row.column, row.asDict())
    if failures and settings.on_failed_checks == "fail":
        raise ValueError(f"{len(failures)} quality checks failed")


def adopt_history(
    spark: SparkSession, table: DataFrame, root: str, as_of: date, settings: Settings = Settings()
) -> int:
    """Take over an existing table as the first version of the history under ``root``."""
    base = versions.latest(spark, root)
    if base.version:
        raise ValueError(f"{root} already has committed versions")
    tracked = history.adopt(table, settings.key, settings.change_columns, as_of)
    run = versions.new_run()
    written = versions.write_version(tracked, root, versions.HISTORY, 1, [history.IS_CURRENT], run)
    versions.commit(spark, root, 1, as_of, {versions.HISTORY: written}, run=run, base=base)
    return 1


def refresh_facts(
    spark: SparkSession,
    history_root: str,
    facts_root: str,
    as_of: date,
    keys: Sequence[str] = facts.GROUPING_COLUMNS,
    *,
    year: str = "model_year",
    electric_range: str = "electric_range",
    price: str = "base_msrp",
) -> int:
    """Write the detail and aggregate facts of the current rows; returns the committed version.

    Each fact scans only its own columns of the current rows. Names are normalised ones.
    """
    measures = {"year": year, "electric_range": electric_range, "price": price}
    current = versions.read_current(spark, history_root)
    if current is None:
        raise ValueError(f"No history is committed under {history_root}")
    rows = normalize_columns(current)
    base, run = versions.latest(spark, facts_root), versions.new_run()
    version = base.version + 1
    tables = {
        name: versions.write_version(df, facts_root, name, version, run=run)
        for name, df in {
            "detail": facts.detail_fact(rows),
            "aggregate": facts.aggregate_fact(rows, as_of, keys, **measures),
        }.items()
    }
    versions.commit(spark, facts_root, version, as_of, tables, run=run, base=base)
    return version


def run(
    spark: SparkSession,
    raw_path: str,
    history_root: str,
    facts_root: str,
    as_of: date,
    settings: Settings = Settings(),
) -> None:
    """Both jobs, one after the other."""
    refresh_history(spark, raw_path, history_root, as_of, settings)
    refresh_facts(
        spark,
        history_root,
        facts_root,
        as_of,
        settings.fact_keys,
        year=settings.fact_year,
        electric_range=settings.fact_range,
        price=settings.fact_price,
    )
