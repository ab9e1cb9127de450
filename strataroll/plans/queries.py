"""Registered queries: every operator, run over whole tables of the test data.

The tables stand in for the vehicle data. Documents are built one per row, so building them needs
no grouping, and no document grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataroll.functions.cells import EPOCH_DATE, epoch_to_date, typed
from strataroll.functions.names import named, normalize_columns
from strataroll.operators import drift, facts, flatten, history, quality, sketches
from strataroll.plans import jobs
from strataroll.sources import envelopes, ranges, versions
from strataroll.sources.shared import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

FIRST_RUN, SECOND_RUN, THIRD_RUN = date(2000, 1, 1), date(2001, 9, 1), date(2001, 12, 1)
KEY, CHANGES = "o_orderkey", ["created_at", "updated_at"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- documents ------------------------------------------------------------------------------------


def catalog(*entries: tuple[str | None, str]) -> Column:
    """A column catalogue; an entry without a field name describes no data column."""
    return F.array(
        *[
            F.struct(F.lit(f).cast("string").alias("fieldName"), F.lit(n).alias("name"))
            for f, n in entries
        ]
    )


def record(*cells: Column | str) -> Column:
    return F.array(*[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cells])


def documents(
    df: DataFrame, columns: Column, data: Column, keep: tuple[str, ...] = (), **view: Column
) -> DataFrame:
    """One document per row of ``df``, with every field of the read schema."""
    fields = view | {"columns": columns}
    meta = F.struct(F.struct(*[c.alias(n) for n, c in fields.items()]).alias("view")).alias("meta")
    return df.select(*keep, meta, data.alias("data"))


PART_ENTRIES = [
    (":id", "id"),
    ("key", "Part Key"),
    ("brand", "Brand"),
    (None, "Size"),
    ("type", "Type"),
    ("size", "Size"),
    ("price", "Retail Price (USD)"),
    (":created_at", "created_at"),
]

PART_COLUMNS = {
    "Part Key": "bigint",
    "Brand": "string",
    "Type": "string",
    "Size": "int",
    "Retail Price (USD)": "double",
    "Maker": "string",
    "created_at": EPOCH_DATE,
}


def part_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full row and a short row per part."""
    created = F.lit(1700000000) + F.col("p_partkey") * 1000
    full = record(
        F.lit("row"), "p_partkey", "p_brand", F.lit("-"), "p_type", "p_size", "p_retailprice", created
    )
    short = record(F.lit("row"), "p_partkey", "p_brand")
    parts = table(spark, sf_dir, "part")
    return documents(parts, catalog(*PART_ENTRIES), F.array(full, short), keep=("p_partkey",))


def column_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.column_catalog(part_documents(spark, sf_dir), "p_partkey")


def allowed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.column_catalog(part_documents(spark, sf_dir), "p_partkey", allowed=PART_COLUMNS)


def envelope_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.flatten(part_documents(spark, sf_dir), PART_COLUMNS)


def envelope_flatten_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column order differs by event type, purchases carry no rows, small values are unreadable."""
    value = F.when(F.col("value") < 1, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    is_click = F.col("event_type") == "click"
    columns = F.when(
        is_click, catalog(("e", "Event"), ("u", "User"), ("v", "Value"), ("t", "Type"))
    ).otherwise(catalog(("v", "Value"), ("t", "Type"), ("e", "Event")))
    data = F.when(is_click, F.array(record("event_id", "user_id", value, "event_type"))).when(
        F.col("event_type") != "purchase", F.array(record(value, "event_type", "event_id"))
    )
    docs = documents(table(spark, sf_dir, "events"), columns, data)
    declared = {"Event": "bigint", "Type": "string", "User": "bigint", "Value": "double"}
    return flatten.flatten(docs, declared, keep_rejected=True)


def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part documents written as JSON files, read back and flattened."""
    path = shared_folder(spark, "documents")
    part_documents(spark, sf_dir).drop("p_partkey").write.json(path)
    return flatten.flatten(envelopes.read_envelopes(spark, path, multi_line=False), PART_COLUMNS)


def record_line_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items written as one row per text line, read back in parallel and flattened."""
    path = shared_folder(spark, "record-lines")
    items = table(spark, sf_dir, "lineitem")
    row = record("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    items.select(F.concat(F.lit(", "), F.to_json(row)).alias("value")).write.text(path)
    records = envelopes.read_record_lines(spark, path)
    files = spark.read.text(path).select(F.col("_metadata.file_path").alias("source_file")).distinct()
    columns = catalog(("o", "Order"), ("n", "Line"), ("q", "Quantity"), ("f", "Flag"))
    docs = documents(files, columns, F.lit(None), keep=("source_file",))
    declared = {"Flag": "string", "Line": "int", "Order": "bigint", "Quantity": "double"}
    return flatten.flatten_record_lines(records, docs, declared)


#: Parts in one document of the files below, however many parts there are.
PARTS_A_FILE = 100


def part_files(spark: SparkSession, sf_dir: str) -> str:
    """All parts as whole documents over several lines, a file each: header, a line for each row, tail."""
    path = shared_folder(spark, "part-files")
    created = F.lit(1700000000) + F.col("p_partkey") * 1000
    row = record(
        F.lit("row"), "p_partkey", "p_brand", F.lit("-"), "p_type", "p_size", "p_retailprice", created
    )
    number = F.floor(F.col("p_partkey") / PARTS_A_FILE).alias("document")
    files = table(spark, sf_dir, "part").groupBy(number).agg(F.collect_list(F.to_json(row)).alias("lines"))
    view = F.struct(F.col("document").cast("string").alias("id"), catalog(*PART_ENTRIES).alias("columns"))
    text = F.concat(
        F.lit('{\n  "meta" : '),
        F.to_json(F.struct(view.alias("view"))),
        F.lit(',\n  "data" : [ '),
        F.array_join("lines", "\n, "),
        F.lit(' ],\n  "tail" : { "complete" : true }\n}'),
    )
    files.select("document", text.alias("value")).write.partitionBy("document").text(path)
    return path


def multi_line_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, each parsed from its file."""
    return flatten.flatten(envelopes.read_envelopes(spark, part_files(spark, sf_dir)), PART_COLUMNS)


def multi_line_files_by_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files with rows read line by line, beside the catalogue of each file."""
    path = part_files(spark, sf_dir)
    docs = envelopes.read_meta(spark, path, streamed=True)
    return flatten.flatten_record_lines(envelopes.read_record_lines(spark, path), docs, PART_COLUMNS)


def multi_line_files_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files read by ranges of lines, whatever line a row is on."""
    docs, records = ranges.read_ranges(spark, part_files(spark, sf_dir))
    return flatten.flatten_record_lines(records, docs, PART_COLUMNS)


def published_parts(spark: SparkSession, sf_dir: str, layout: str) -> DataFrame:
    """The history that the job makes of the same files."""
    root = shared_folder(spark, "history")
    settings = jobs.Settings(
        columns=PART_COLUMNS,
        key="Part Key",
        change_columns=("created_at",),
        critical=("Brand",),
        ranges={"Size": (0, 100)},
        unique=("Part Key",),
        layout=layout,
    )
    jobs.refresh_history(spark, part_files(spark, sf_dir), root, FIRST_RUN, settings)
    return versions.read_history(spark, root)


def published_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published_parts(spark, sf_dir, "document")


def published_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published_parts(spark, sf_dir, "rows")


def allow_list_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns and types as a stored allow-list names them; one is in no document."""
    path = shared_folder(spark, "allow-list")
    listed = '{"allowed_columns": ["Make", "Model Year", "Base MSRP", "Trim"]}'
    spark.createDataFrame([(listed,)], "value string").coalesce(1).write.text(path)
    year = F.concat(F.col("p_size") + 1950, F.lit(".0"))
    docs = documents(
        table(spark, sf_dir, "part"),
        catalog(("y", "Model Year"), ("b", "Make"), ("t", "Model"), ("p", "Base MSRP")),
        F.array(record(year, "p_brand", "p_type", "p_retailprice")),
    )
    return flatten.flatten(docs, jobs.load_allowed_columns(path, spark))


def customer_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    created = F.lit(1600000000) + F.col("c_custkey")
    return documents(
        table(spark, sf_dir, "customer"),
        catalog(*PART_ENTRIES),
        F.lit(None).cast("array<array<string>>"),
        id=F.col("c_custkey").cast("string"),
        name=F.col("c_name"),
        description=F.nullif("c_mktsegment", F.lit("BUILDING")),
        owner=F.struct(F.concat(F.lit("owner "), "c_nationkey").alias("displayName")),
        tags=F.array(F.lit("customer"), F.lower("c_mktsegment")),
        createdAt=created,
        publicationDate=F.when(F.col("c_acctbal") > 0, created + 86400),
    )


def metadata_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags are joined to one text at the end, for comparison with SQL."""
    docs = customer_documents(spark, sf_dir)
    return flatten.metadata(docs).withColumn("tags", F.array_join("tags", ","))


def approval_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders have two approvals, open ones one, others none."""

    def approval(state: str, automatic: bool) -> Column:
        return F.struct(
            (F.col("o_orderkey") + 100).alias("reviewedAt"),
            F.lit(automatic).alias("reviewedAutomatically"),
            F.lit(state).alias("state"),
            F.col("o_orderkey").cast("string").alias("submissionId"),
            F.struct(F.col("o_orderpriority").alias("permissionType")).alias("submissionDetails"),
            F.struct(F.concat(F.lit("customer "), "o_custkey").alias("displayName")).alias("submitter"),
            F.struct(F.lit("success").alias("status")).alias("submissionOutcomeApplication"),
            F.col("o_orderkey").alias("submittedAt"),
        )

    each = F.when(
        F.col("o_orderstatus") == "F", F.array(approval("pending", False), approval("approved", True))
    ).when(F.col("o_orderstatus") == "O", F.array(approval("pending", False)))
    return documents(
        table(spark, sf_dir, "orders"),
        catalog(*PART_ENTRIES),
        F.lit(None).cast("array<array<string>>"),
        approvals=each,
    )


def approvals_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.approvals(approval_documents(spark, sf_dir))


def published(spark: SparkSession, docs: DataFrame, name: str) -> DataFrame:
    """A table that the history job publishes beside the history, read back."""
    path, root = shared_folder(spark, "raw"), shared_folder(spark, "history")
    docs.write.json(path)
    settings = jobs.Settings(
        columns={"Part Key": "string", "created_at": EPOCH_DATE},
        key="Part Key",
        change_columns=("created_at",),
        critical=("Part Key",),
        ranges={},
        unique=("Part Key",),
        layout="lines",
    )
    jobs.refresh_history(spark, path, root, FIRST_RUN, settings)
    return versions.read_table(spark, root, name)


def published_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = published(spark, customer_documents(spark, sf_dir), "metadata")
    return stored.withColumn("tags", F.array_join("tags", ","))


def published_approvals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(spark, approval_documents(spark, sf_dir), "approvals")


def epoch_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event numbers spread over decades before and after 1970; errors have no readable time."""
    seconds = ((F.col("event_id") - 5000) * 79190).cast("string")
    text = F.when(F.col("event_type") == "error", F.lit("unknown")).otherwise(seconds)
    return table(spark, sf_dir, "events").select("event_id", epoch_to_date(text).alias("day"))


def number_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers with a fraction of zeros or an exponent, fractions, and numbers beyond an int."""
    number = F.col("event_id").cast("string")
    kind = F.col("event_id") % 7
    text = (
        F.when(kind == 0, F.concat(number, F.lit(".0")))
        .when(kind == 1, F.concat(number, F.lit(".25E2")))
        .when(kind == 2, F.concat(number, F.lit(".5")))
        .when(kind == 3, (F.col("event_id") + 3000000000).cast("string"))
        .when(kind == 5, F.concat(number, F.lit(".0000001")))
        .when(kind == 6, F.concat(F.lit("1."), F.lpad(number, 9, "0"), F.lit("E9")))
        .otherwise(F.concat((F.col("event_id") + 1700000000).cast("string"), F.lit(".000")))
    )
    return table(spark, sf_dir, "events").select(
        "event_id", typed(text, "int").alias("whole"), typed(text, EPOCH_DATE).alias("day")
    )


# --- schema drift ---------------------------------------------------------------------------------

EXPECTED = ["Name", "Segment", "Balance", "Nation"]


def customer_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as documents whose columns depend on the market segment."""
    segment = F.col("c_mktsegment")
    name, balance, nation = ("n", "Name"), ("b", "Balance"), ("x", "Nation")
    columns = (
        F.when(segment == "MACHINERY", catalog(name, ("s", "Segment"), balance, ("f", "Fleet Size")))
        .when(segment == "BUILDING", catalog(name, ("s", "Segment"), (None, "Balance"), nation))
        .when(segment == "HOUSEHOLD", catalog(name, balance, ("d", "Members"), ("f", "Fleet Size"), nation))
        .otherwise(catalog(nation, balance, ("s", "Segment"), name))
    )
    docs = documents(table(spark, sf_dir, "customer"), columns, F.array(record("c_name")))
    return drift.schema_drift(docs, EXPECTED)


def schema_gate_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as read back after the gate appended to it."""
    path = shared_folder(spark, "schema-log")
    found = customer_drift(spark, sf_dir)
    drift.schema_gate(found, path, datetime(2025, 4, 11, 10), on_new="warn")
    return spark.read.text(path)


def schema_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which frames may go on: one as expected, one with columns missing, an empty and an absent one."""
    customers = table(spark, sf_dir, "customer")
    expected = ["c_custkey", "c_name", "c_acctbal"]
    frames = {
        "whole": customers,
        "fewer columns": customers.drop("c_acctbal"),
        "in debt": customers.filter("c_acctbal < 0"),
        "empty": customers.filter("c_custkey IS NULL"),
        "absent": versions.if_present(lambda: table(spark, sf_dir, "no_such_table")),
    }
    verdicts = [(name, drift.has_columns(df, expected)) for name, df in frames.items()]
    return spark.createDataFrame(verdicts, "frame string, valid boolean")


# --- quality --------------------------------------------------------------------------------------


def checked_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with gaps and cells that are not numbers."""
    segment = F.nullif("c_mktsegment", F.lit("BUILDING"))
    code = F.when(F.col("c_acctbal") < 0, F.lit("owes")).otherwise(F.col("c_nationkey").cast("string"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_name",
        segment.alias("c_mktsegment"),
        "c_acctbal",
        code.try_cast("int").alias("code"),
        F.when(code.try_cast("int").isNull(), code).alias("code" + flatten.REJECTED),
    )


def dq_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = checked_customers(spark, sf_dir).drop("code" + flatten.REJECTED)
    return quality.quality_report(customers, ["c_custkey", "c_name", "c_mktsegment", "code"])


def dq_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The highest tax rates are replaced by NaN, which no bound allows."""
    items = table(spark, sf_dir, "lineitem").withColumn(
        "l_tax", F.when(F.col("l_tax") > 0.07, F.lit(float("nan"))).otherwise(F.col("l_tax"))
    )
    bounds = {
        "l_quantity": (1, 50),
        "l_extendedprice": (0, 90000),
        "l_tax": (0, 1),
        "l_linenumber": (2, 7),
        "l_returnflag": (0, 1),
    }
    return quality.quality_report(items, ranges=bounds)


def dq_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn(
        "o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW"))
    )
    unique = ["o_orderkey", "o_custkey", "o_orderpriority"]
    return quality.quality_report(orders, unique=unique)


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(
        checked_customers(spark, sf_dir),
        ["c_name", "c_mktsegment"],
        {"c_acctbal": (0, 10000), "code": (0, 24)},
        ["c_custkey"],
    )


def dq_report_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same checks, counted while the customers are written."""
    path = shared_folder(spark, "checked")
    checks = quality.ObservedChecks(
        checked_customers(spark, sf_dir), ["c_name", "c_mktsegment"], {"c_acctbal": (0, 10000), "code": (0, 24)}
    )
    checks.rows.write.parquet(path)
    return checks.report(spark.read.schema(checks.rows.schema).parquet(path), ["c_custkey"])


def dq_uniqueness_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uniqueness of order columns: keys by the exact check, the others by their sketches, whose counts are estimates."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    found = sketches.uniqueness(orders, sketches.column_sketches(orders, orders.columns))
    return found.select("check", "column", "passed", F.col("note").startswith("estimated").alias("by_sketch"))


def distinct_over_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, missing values and distinct values of three snapshots from their merged sketches, beside the exact number.

    Estimates are given as whether they, and the bounds, hold the exact number.
    """
    root, columns = shared_folder(spark, "sketches"), ["o_orderkey", "o_custkey", "updated_at"]
    snapshots = [snapshot(spark, sf_dir).select(*columns) for snapshot in (snapshot_one, snapshot_two, snapshot_three)]
    for version, rows in enumerate(snapshots, 1):
        stored = versions.write_version(sketches.column_sketches(rows, columns), root, "sketches", version)
        versions.commit(spark, root, version, FIRST_RUN, {"sketches": stored})
    merged = sketches.distinct_counts(sketches.merged_sketches(versions.read_versions(spark, root, "sketches")))
    every = reduce(DataFrame.union, snapshots)
    line = lambda c: F.struct(F.lit(c).alias("column"), F.count_distinct(c).alias("exact"))
    exact = reduce(DataFrame.union, [every.agg(line(c).alias("line")).select("line.*") for c in columns])
    close = F.abs(F.col("distinct_values") - F.col("exact")) <= sketches.SIGMAS * sketches.standard_error() * F.col("exact")
    return merged.join(exact, "column").select(
        "column", "rows", "missing", "exact", F.col("exact").between(F.col("low"), F.col("high")).alias("within"), close.alias("close")
    )


def dq_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each suite passes, and its failed checks."""
    customers = table(spark, sf_dir, "customer")
    sound = quality.quality_report(customers, ["c_name"], {"c_acctbal": (-1000, 10000)}, ["c_custkey"])
    suites = {"customer": sound, "checked": dq_report(spark, sf_dir)}
    lines = [
        quality.failures(report).agg(
            F.lit(name).alias("suite"),
            F.lit(quality.passed(report)).alias("passed"),
            F.array_join(F.array_sort(F.collect_list(F.concat_ws(" ", "check", "column"))), ", ").alias("failed"),
        )
        for name, report in suites.items()
    ]
    return reduce(DataFrame.unionByName, lines)


# --- history --------------------------------------------------------------------------------------


def dated_orders(spark: SparkSession, sf_dir: str, status: Column, updated_at: Column) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        status.alias("status"),
        "o_totalprice",
        "o_orderpriority",
        ordered().alias("created_at"),
        updated_at.alias("updated_at"),
    )


def ordered() -> Column:
    return F.col("o_orderdate").cast("date")


def snapshot_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders placed before 2000, as they were placed."""
    placed = dated_orders(spark, sf_dir, F.lit("O"), ordered())
    return placed.filter(F.col("created_at") < date(2000, 1, 1))


def snapshot_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders since 1996: finished ones were updated, and partly shipped ones have no update time."""
    status = F.col("o_orderstatus")
    updated = F.when(status == "F", F.date_add(ordered(), 30)).when(status == "O", ordered())
    since = dated_orders(spark, sf_dir, status, updated)
    return since.filter(F.col("created_at") >= date(1996, 1, 1))


def snapshot_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders: urgent ones were updated once more."""
    status = F.col("o_orderstatus")
    updated = F.when(F.col("o_orderpriority") == "1-URGENT", F.date_add(ordered(), 60)).otherwise(ordered())
    return dated_orders(spark, sf_dir, status, updated)


def history_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.first_history(snapshot_one(spark, sf_dir), KEY, CHANGES, FIRST_RUN)


def scd2_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.scd2_merge(snapshot_three(spark, sf_dir), None, KEY, CHANGES, FIRST_RUN)


def scd2_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed by customer, the orders are a snapshot with many copies of each key."""
    return history.latest_per_key(snapshot_three(spark, sf_dir), "o_custkey", CHANGES)


def scd2_heal(spark: SparkSession, sf_dir: str) -> DataFrame:
    part_tracked = snapshot_three(spark, sf_dir).withColumn("valid_from", F.col("created_at"))
    return history.heal_tracking(part_tracked, FIRST_RUN)


def scd2_adopt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by customer as an untracked table: the newest stays current, the others are closed."""
    return history.adopt(snapshot_three(spark, sf_dir), "o_custkey", CHANGES, FIRST_RUN)


def scd2_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.changed_rows(snapshot_two(spark, sf_dir), history_one(spark, sf_dir), KEY, CHANGES)


def scd2_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = snapshot_two(spark, sf_dir), history_one(spark, sf_dir)
    return history.closed_rows(source, target, KEY, CHANGES, SECOND_RUN)


def scd2_unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = snapshot_two(spark, sf_dir), history_one(spark, sf_dir)
    return history.unchanged_rows(source, target, KEY, CHANGES)


def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = snapshot_two(spark, sf_dir), history_one(spark, sf_dir)
    return history.scd2_merge(source, target, KEY, CHANGES, SECOND_RUN)


def scd2_merge_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = snapshot_two(spark, sf_dir), history_one(spark, sf_dir)
    return history.scd2_merge(source, target, KEY, CHANGES, SECOND_RUN, small_source=True)


def keyless(orders: DataFrame) -> DataFrame:
    """Low-priority orders lose their key."""
    low = F.col("o_orderpriority") == "5-LOW"
    return orders.withColumn(KEY, F.when(~low, F.col(KEY)))


def scd2_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyless snapshot rows stay out; keyless history rows are carried forward."""
    target = history.start_tracking(keyless(snapshot_one(spark, sf_dir)), FIRST_RUN)
    return history.scd2_merge(keyless(snapshot_two(spark, sf_dir)), target, KEY, CHANGES, SECOND_RUN)


def scd2_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.without_key(keyless(snapshot_three(spark, sf_dir)), KEY)


def scd2_evolved_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot lost one column and gained another."""
    source = snapshot_two(spark, sf_dir)
    evolved = source.withColumn("urgent", F.col("o_orderpriority") == "1-URGENT").drop("o_orderpriority")
    return history.scd2_merge(evolved, history_one(spark, sf_dir), KEY, CHANGES, SECOND_RUN)


def scd2_three_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows closed by the second merge survive the third."""
    second = scd2_merge(spark, sf_dir)
    return history.scd2_merge(snapshot_three(spark, sf_dir), second, KEY, CHANGES, THIRD_RUN)


def publish_merge(spark: SparkSession, root: str, source: DataFrame, as_of: date) -> None:
    """One committed version of the history under ``root``."""
    version = versions.next_version(spark, root)
    current = versions.read_current(spark, root)
    merged = history.scd2_merge(source, current, KEY, CHANGES, as_of)
    done = versions.write_version(merged, root, versions.HISTORY, version, [history.IS_CURRENT])
    versions.commit(spark, root, version, as_of, {versions.HISTORY: done})


def published_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three snapshots published as three versions and read back as one history."""
    root = shared_folder(spark, "history")
    publish_merge(spark, root, snapshot_one(spark, sf_dir), FIRST_RUN)
    publish_merge(spark, root, snapshot_two(spark, sf_dir), SECOND_RUN)
    publish_merge(spark, root, snapshot_three(spark, sf_dir), THIRD_RUN)
    return versions.read_history(spark, root)


def adopted_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table from elsewhere, some of whose rows have no flag, and two snapshots on top of it."""
    root = shared_folder(spark, "history")
    flag = F.when(F.col("o_orderpriority") != "5-LOW", F.lit(True))
    found = history.start_tracking(snapshot_one(spark, sf_dir), FIRST_RUN).withColumn("is_current", flag)
    jobs.adopt_history(spark, found, root, FIRST_RUN, jobs.Settings(key=KEY, change_columns=CHANGES))
    publish_merge(spark, root, snapshot_two(spark, sf_dir), SECOND_RUN)
    publish_merge(spark, root, snapshot_three(spark, sf_dir), THIRD_RUN)
    return versions.read_history(spark, root)


def merge_settings(**more) -> jobs.Settings:
    return jobs.Settings(key=KEY, change_columns=CHANGES, **more)


def publish_step(spark: SparkSession, root: str, source: DataFrame, as_of: date, settings: jobs.Settings) -> None:
    """One committed version of the history, merged and cut as the job does it."""
    base, run = versions.latest(spark, root), versions.new_run()
    cut = jobs.merge_history(spark, root, base, source, as_of, settings, base.version + 1, run)
    tables = {versions.HISTORY: cut.pop("written")}
    versions.commit(spark, root, base.version + 1, as_of, tables, run=run, base=base, **cut)


def bucketed_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three snapshots in buckets by key, cut anew for the third; the second goes in by parts of its keys."""
    root, second = shared_folder(spark, "history"), snapshot_two(spark, sf_dir)
    publish_step(spark, root, snapshot_one(spark, sf_dir), FIRST_RUN, merge_settings(buckets=8))
    few = versions.bucket_of(KEY, 8) < 3
    for part in (second.filter(few), second.filter(~few)):
        publish_step(spark, root, part, SECOND_RUN, merge_settings(buckets=8))
    publish_step(spark, root, snapshot_three(spark, sf_dir), THIRD_RUN, merge_settings(buckets=5))
    return versions.read_history(spark, root)


def compacted_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three snapshots with closed rows folded two by two after each."""
    root = shared_folder(spark, "history")
    steps = (snapshot_one, FIRST_RUN), (snapshot_two, SECOND_RUN), (snapshot_three, THIRD_RUN)
    for snapshot, as_of in steps:
        publish_step(spark, root, snapshot(spark, sf_dir), as_of, merge_settings())
        versions.compact(spark, root, 2)
    return versions.read_history(spark, root)


def widened_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three snapshots whose types widen from one to the next: int to bigint to decimal, date to timestamp."""
    root = shared_folder(spark, "history")
    kinds = ("int", "date"), ("bigint", "date"), ("decimal(25,2)", "timestamp_ntz")
    steps = (snapshot_one, FIRST_RUN), (snapshot_two, SECOND_RUN), (snapshot_three, THIRD_RUN)
    for (snapshot, as_of), (number, time) in zip(steps, kinds, strict=True):
        typed_rows = snapshot(spark, sf_dir).withColumns(
            {"o_custkey": F.col("o_custkey").cast(number), "updated_at": F.col("updated_at").cast(time)}
        )
        publish_step(spark, root, typed_rows, as_of, merge_settings())
    rows = versions.read_history(spark, root)
    types = dict(rows.dtypes)
    if (types["o_custkey"], types["updated_at"]) != ("decimal(25,2)", "timestamp_ntz"):
        raise ValueError(f"The history did not widen: {types}")
    return rows.withColumns({"o_custkey": F.col("o_custkey").cast("bigint"), "updated_at": F.col("updated_at").cast("date")})


# --- facts ----------------------------------------------------------------------------------------


def current_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_merge(spark, sf_dir).filter("is_current")


# Display names of the merged orders, and what they become.
DISPLAY_NAMES = {
    "o_orderkey": "DOL Vehicle ID",
    "o_custkey": "VIN (1-10)",
    "status": "Clean Fuel (CAFV) Status",
    "o_totalprice": "Base MSRP",
    "o_orderpriority": "WAOFM - GIS - Priority.Code",
}


def display_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_snapshot(spark, sf_dir).withColumnsRenamed(DISPLAY_NAMES)


def normalized_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_columns(display_orders(spark, sf_dir))


def curated_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.detail_fact(normalized_columns(spark, sf_dir))


def curated_aggregate_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as registrations: nation and segment are make and model, the order year is the year.

    Ranges are whole numbers here and below, prices have cents.
    """
    customers = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    registrations = (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("n_name").alias("make"),
            F.col("c_mktsegment").alias("model"),
            F.year("o_orderdate").cast("string").alias("model_year"),
            F.col("o_orderstatus").alias("state"),
            F.col("o_orderpriority").alias("county"),
            F.floor("o_totalprice").alias("electric_range"),
            F.col("c_acctbal").alias("base_msrp"),
        )
    )
    keys = ["make", "model", "model_year", "state", "county"]
    return facts.aggregate_fact(registrations, date(2000, 6, 1), keys)


def exact_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices moved far from zero, where sums of squares of doubles lose the spread."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("make"),
        F.year(F.col("l_shipdate").cast("date")).alias("model_year"),
        (F.col("l_extendedprice").cast("decimal(20,2)") + 10000000).alias("electric_range"),
        F.col("l_extendedprice").alias("base_msrp"),
    )
    out = facts.aggregate_fact(rows, date(2010, 1, 1), ["make", "model_year"])
    return out.select("make", "model_year", "vehicle_count", "stddev_electric_range")


def line_registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the default grouping columns; open items have no model year."""
    shipped = F.col("l_shipdate").cast("date")
    text = lambda c: F.col(c).cast("string")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("make"),
        F.col("l_linestatus").alias("model"),
        F.when(F.col("l_tax") > 0, F.year(shipped).cast("string")).alias("model_year"),
        text("l_linenumber").alias("city"),
        F.when(F.col("l_returnflag") != "N", text("l_linenumber")).alias("county"),
        F.concat("l_returnflag", F.lit("/"), "l_linestatus").alias("electric_vehicle_type"),
        F.lit("WA").alias("state"),
        F.when(F.col("l_discount") > 0.05, "Eligible").alias(
            "clean_alternative_fuel_vehicle_cafv_eligibility"
        ),
        F.lower("l_linestatus").alias("electric_utility"),
        F.lower("l_returnflag").alias("counties"),
        F.concat(F.lit("District "), text("l_linenumber")).alias("congressional_districts"),
        F.when(F.col("l_discount") > 0.08, "North").otherwise("South").alias(
            "waofm_gis_legislative_district_boundary"
        ),
        F.trunc(shipped, "year").alias("created_at"),
        F.when(F.col("l_linestatus") == "F", F.trunc(shipped, "year")).alias("updated_at"),
        F.col("l_quantity").alias("electric_range"),
        F.col("l_extendedprice").alias("base_msrp"),
    )


def curated_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All default grouping columns."""
    return facts.aggregate_fact(line_registrations(spark, sf_dir), date(2000, 6, 1))


# --- both jobs ------------------------------------------------------------------------------------

ORDER_COLUMNS = {
    "Order Key": "string",
    "Make": "string",
    "Model Year": "int",
    "Electric Range": "int",
    "Base MSRP": "double",
    "created_at": EPOCH_DATE,
    "updated_at": EPOCH_DATE,
}


def write_order_documents(spark: SparkSession, orders: DataFrame) -> str:
    """A snapshot of orders as raw JSON files, one document per line."""
    path = shared_folder(spark, "raw")
    epoch = lambda c: F.unix_date(F.col(c)).cast("bigint") * 86400 + 3600
    row = record(
        F.col("o_orderkey"),
        "status",
        F.year("created_at"),
        "o_custkey",
        "o_totalprice",
        epoch("created_at"),
        epoch("updated_at"),
    )
    columns = catalog(*[(f"f{i}", name) for i, name in enumerate(ORDER_COLUMNS)])
    documents(orders, columns, F.array(row)).write.json(path)
    return path


def publish_facts(spark: SparkSession, sf_dir: str) -> str:
    """Two raw snapshots through both jobs; the root of the facts."""
    root, out = shared_folder(spark, "history"), shared_folder(spark, "facts")
    settings = jobs.Settings(
        columns=ORDER_COLUMNS,
        key="Order Key",
        critical=("Make",),
        ranges={"Model Year": (1990, 2025), "Base MSRP": (0, 1000000)},
        unique=("Order Key",),
        layout="lines",
    )
    for orders, as_of in (
        (snapshot_one(spark, sf_dir), FIRST_RUN),
        (snapshot_two(spark, sf_dir), SECOND_RUN),
    ):
        jobs.refresh_history(spark, write_order_documents(spark, orders), root, as_of, settings)
    keys = ["make", "model_year", "updated_at"]
    jobs.refresh_facts(spark, root, out, SECOND_RUN, keys)
    return out


def snapshots_to_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.read_table(spark, publish_facts(spark, sf_dir), "aggregate")


def published_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.read_table(spark, publish_facts(spark, sf_dir), "detail")


QUERIES: dict[str, Query] = {
    "column_catalog": column_catalog,
    "allowed_columns": allowed_columns,
    "envelope_flatten": envelope_flatten,
    "envelope_flatten_mixed": envelope_flatten_mixed,
    "document_files": document_files,
    "record_line_files": record_line_files,
    "multi_line_files": multi_line_files,
    "multi_line_files_by_row": multi_line_files_by_row,
    "multi_line_files_by_range": multi_line_files_by_range,
    "published_documents": published_documents,
    "published_rows": published_rows,
    "bucketed_history": bucketed_history,
    "compacted_history": compacted_history,
    "widened_history": widened_history,
    "exact_spread": exact_spread,
    "dq_report_observed": dq_report_observed,
    "dq_uniqueness_sketched": dq_uniqueness_sketched,
    "distinct_over_versions": distinct_over_versions,
    "allow_list_flatten": allow_list_flatten,
    "published_metadata": published_metadata,
    "published_approvals": published_approvals,
    "number_spellings": number_spellings,
    "schema_valid": schema_valid,
    "dq_verdict": dq_verdict,
    "adopted_history": adopted_history,
    "published_detail": published_detail,
    "metadata_extract": metadata_extract,
    "approvals_explode": approvals_explode,
    "epoch_to_date": epoch_dates,
    "schema_drift": customer_drift,
    "schema_gate_log": schema_gate_log,
    "dq_completeness": dq_completeness,
    "dq_range": dq_range,
    "dq_uniqueness": dq_uniqueness,
    "dq_report": dq_report,
    "scd2_initial": scd2_initial,
    "scd2_latest_per_key": scd2_latest_per_key,
    "scd2_heal": scd2_heal,
    "scd2_adopt": scd2_adopt,
    "scd2_changed": scd2_changed,
    "scd2_closed": scd2_closed,
    "scd2_unchanged": scd2_unchanged,
    "scd2_merge": scd2_merge,
    "scd2_merge_delta": scd2_merge_delta,
    "scd2_null_keys": scd2_null_keys,
    "scd2_quarantine": scd2_quarantine,
    "scd2_evolved_columns": scd2_evolved_columns,
    "scd2_three_snapshots": scd2_three_snapshots,
    "published_history": published_history,
    "current_snapshot": current_snapshot,
    "normalize_columns": normalized_columns,
    "curated_detail": curated_detail,
    "curated_aggregate_by_nation": curated_aggregate_by_nation,
    "curated_aggregate": curated_aggregate,
    "snapshots_to_facts": snapshots_to_facts,
}
