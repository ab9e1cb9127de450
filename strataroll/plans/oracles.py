"""The registered queries as plain SQL over the same tables, for checking results."""

from __future__ import annotations

# --- documents ------------------------------------------------------------------------------------

COLUMN_CATALOG = """
SELECT p_partkey, ordinal, field_name, name
FROM part, (VALUES
    (0, ':id', 'id'), (1, 'key', 'Part Key'), (2, 'brand', 'Brand'), (4, 'type', 'Type'),
    (5, 'size', 'Size'), (6, 'price', 'Retail Price (USD)'), (7, ':created_at', 'created_at')
) AS entries(ordinal, field_name, name)
"""

ENVELOPE_FLATTEN = """
SELECT p_partkey AS "Part Key", p_brand AS "Brand", p_type AS "Type", p_size AS "Size",
       p_retailprice AS "Retail Price (USD)", CAST(NULL AS VARCHAR) AS "Maker",
       CAST(make_timestamp((1700000000 + p_partkey * 1000) * 1000000) AS DATE) AS created_at
FROM part
UNION ALL
SELECT p_partkey, p_brand, NULL, NULL, NULL, NULL, NULL FROM part
"""

MULTI_LINE_FILES = ENVELOPE_FLATTEN.partition("UNION ALL")[0]

ALLOW_LIST_FLATTEN = """
SELECT p_brand AS "Make", CAST(p_size + 1950 AS INTEGER) AS "Model Year", p_retailprice AS "Base MSRP",
       CAST(NULL AS VARCHAR) AS "Trim"
FROM part
"""

ENVELOPE_FLATTEN_MIXED = """
SELECT event_id AS "Event", event_type AS "Type",
       CASE WHEN event_type = 'click' THEN user_id END AS "User",
       CASE WHEN value >= 1 THEN value END AS "Value",
       CAST(NULL AS VARCHAR) AS "Event__rejected", CAST(NULL AS VARCHAR) AS "User__rejected",
       CASE WHEN value < 1 THEN 'n/a' END AS "Value__rejected"
FROM events
WHERE event_type <> 'purchase'
"""

RECORD_LINE_FILES = """
SELECT l_returnflag AS "Flag", l_linenumber AS "Line", l_orderkey AS "Order", l_quantity AS "Quantity"
FROM lineitem
"""

METADATA_EXTRACT = """
SELECT CAST(c_custkey AS VARCHAR) AS dataset_id, c_name AS dataset_name,
       nullif(c_mktsegment, 'BUILDING') AS description, 'owner ' || c_nationkey AS owner_name,
       'customer,' || lower(c_mktsegment) AS tags, 1600000000 + c_custkey AS created_at,
       CASE WHEN c_acctbal > 0 THEN 1600086400 + c_custkey END AS publication_date
FROM customer
"""

APPROVALS_EXPLODE = """
SELECT o_orderkey + 100 AS reviewed_at, automatic AS reviewed_automatically, state,
       CAST(o_orderkey AS VARCHAR) AS submission_id, o_orderpriority AS permission_type,
       'customer ' || o_custkey AS submitter_name, 'success' AS outcome_status,
       o_orderkey AS submitted_at
FROM orders JOIN (VALUES
    ('F', 'pending', false), ('F', 'approved', true), ('O', 'pending', false)
) AS steps(status, state, automatic) ON o_orderstatus = status
"""

EPOCH_TO_DATE = """
SELECT event_id,
       CASE WHEN event_type <> 'error'
            THEN CAST(make_timestamp((event_id - 5000) * 79190 * 1000000) AS DATE) END AS day
FROM events
"""

NUMBER_SPELLINGS = """
WITH spelled AS (
    SELECT event_id, CASE event_id % 7
        WHEN 0 THEN event_id WHEN 1 THEN event_id * 100 + 25 WHEN 3 THEN event_id + 3000000000
        WHEN 4 THEN event_id + 1700000000 WHEN 6 THEN event_id + 1000000000 END AS number
    FROM events
)
SELECT event_id, TRY_CAST(number AS INTEGER) AS whole,
       CAST(make_timestamp(number * 1000000) AS DATE) AS day
FROM spelled
"""

# --- schema drift ---------------------------------------------------------------------------------

SCHEMA_DRIFT = """
SELECT column_name, status, count(*) AS documents
FROM customer JOIN (VALUES
    ('MACHINERY', 'Fleet Size', 'new'), ('MACHINERY', 'Nation', 'missing'),
    ('BUILDING', 'Balance', 'missing'),
    ('HOUSEHOLD', 'Members', 'new'), ('HOUSEHOLD', 'Fleet Size', 'new'),
    ('HOUSEHOLD', 'Segment', 'missing')
) AS changes(segment, column_name, status) ON c_mktsegment = segment
GROUP BY column_name, status
"""

SCHEMA_GATE_LOG = """
SELECT '2025-04-11 10:00:00: Unexpected columns detected: ['''
       || string_agg(column_name, ''', ''' ORDER BY column_name) || ''']' AS value
FROM (
    SELECT DISTINCT column_name
    FROM customer JOIN (VALUES
        ('MACHINERY', 'Fleet Size'), ('HOUSEHOLD', 'Members'), ('HOUSEHOLD', 'Fleet Size')
    ) AS changes(segment, column_name) ON c_mktsegment = segment
)
"""

SCHEMA_VALID = """
SELECT 'whole' AS frame, count(*) > 0 AS valid FROM customer
UNION ALL SELECT 'fewer columns', false
UNION ALL SELECT 'in debt', count(*) > 0 FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 'empty', count(*) > 0 FROM customer WHERE c_custkey IS NULL
UNION ALL SELECT 'absent', false
"""

# --- quality --------------------------------------------------------------------------------------


def _line(
    check: str,
    column: str,
    violations: str,
    table: str,
    passed: str | None = None,
    low: str = "NULL",
    high: str = "NULL",
    bounds: tuple[object, object] = ("NULL", "NULL"),
    note: str = "NULL",
) -> str:
    return f"""
SELECT '{check}' AS "check", '{column}' AS "column", {passed or f"{violations} = 0"} AS passed,
       CAST({violations} AS BIGINT) AS violations,
       CAST({low} AS DOUBLE) AS observed_min, CAST({high} AS DOUBLE) AS observed_max,
       CAST({bounds[0]} AS DOUBLE) AS expected_min, CAST({bounds[1]} AS DOUBLE) AS expected_max,
       CAST({note} AS VARCHAR) AS note
FROM {table}"""


def _completeness(column: str, table: str) -> str:
    return _line("completeness", column, f"count(*) - count({column})", table)


def _range(column: str, lower: float, upper: float, table: str) -> str:
    outside = f"coalesce(sum(CASE WHEN {column} < {lower} OR {column} > {upper} THEN 1 END), 0)"
    low, high = f"min({column})", f"max({column})"
    passed = f"{low} >= {lower} AND {high} <= {upper}"
    return _line("range", column, outside, table, passed, low, high, (lower, upper))


def _uniqueness(column: str, table: str) -> str:
    return _line("uniqueness", column, f"count(*) - count(DISTINCT {column})", table)


def _report(ctes: str, *lines: str) -> str:
    return ctes + "\nUNION ALL".join(lines)


CHECKED = """
WITH checked AS (
    SELECT c_custkey, c_name, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment, c_acctbal,
           CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS code
    FROM customer
)"""

ITEMS = """
WITH items AS (
    SELECT * REPLACE (CASE WHEN l_tax > 0.07 THEN CAST('NaN' AS DOUBLE) ELSE l_tax END AS l_tax)
    FROM lineitem
)"""

PRIORITIES = """
WITH prioritised AS (
    SELECT * REPLACE (nullif(o_orderpriority, '5-LOW') AS o_orderpriority) FROM orders
)"""

DQ_COMPLETENESS = _report(
    CHECKED, *[_completeness(c, "checked") for c in ("c_custkey", "c_name", "c_mktsegment", "code")]
)

DQ_RANGE = _report(
    ITEMS,
    _range("l_quantity", 1, 50, "items"),
    _range("l_extendedprice", 0, 90000, "items"),
    _range("l_tax", 0, 1, "items"),
    _range("l_linenumber", 2, 7, "items"),
    """
SELECT 'range', 'l_returnflag', false, 0, NULL, NULL, 0, 1, 'not a number column'""",
)

DQ_UNIQUENESS = _report(
    PRIORITIES, *[_uniqueness(c, "prioritised") for c in ("o_orderkey", "o_custkey", "o_orderpriority")]
)

DQ_REPORT = _report(
    CHECKED,
    _completeness("c_name", "checked"),
    _completeness("c_mktsegment", "checked"),
    _range("c_acctbal", 0, 10000, "checked"),
    _range("code", 0, 24, "checked"),
    _line("conversion", "code", "count(*) - count(code)", "checked"),
    _uniqueness("c_custkey", "checked"),
)

SOUND = _report(
    "",
    _completeness("c_name", "customer"),
    _range("c_acctbal", -1000, 10000, "customer"),
    _uniqueness("c_custkey", "customer"),
)
DQ_VERDICT = f"""
SELECT suite, bool_and(passed) AS passed,
       coalesce(string_agg("check" || ' ' || "column", ', ' ORDER BY "check" || ' ' || "column")
                FILTER (NOT passed), '') AS failed
FROM (SELECT 'customer' AS suite, * FROM ({SOUND}) UNION ALL SELECT 'checked', * FROM ({DQ_REPORT}))
GROUP BY suite
"""

# --- history --------------------------------------------------------------------------------------

COLUMNS = "o_orderkey, o_custkey, status, o_totalprice, o_orderpriority, created_at, updated_at"

SNAPSHOTS = """
dated AS (
    SELECT o_orderkey, o_custkey, o_orderstatus AS status, o_totalprice, o_orderpriority,
           CAST(o_orderdate AS DATE) AS created_at
    FROM orders
),
one AS (
    SELECT * REPLACE ('O' AS status), created_at AS updated_at
    FROM dated WHERE created_at < DATE '2000-01-01'
),
two AS (
    SELECT *, CASE status WHEN 'F' THEN created_at + 30 WHEN 'O' THEN created_at END AS updated_at
    FROM dated WHERE created_at >= DATE '1996-01-01'
),
three AS (
    SELECT *, CASE WHEN o_orderpriority = '1-URGENT' THEN created_at + 60 ELSE created_at END AS updated_at
    FROM dated
)"""


def _tracked(columns: str, since: str, current: str = "true", until: str = "NULL") -> str:
    return (
        f"{columns}, {current} AS is_current, DATE '{since}' AS valid_from, CAST({until} AS DATE) AS valid_to"
    )


NEWER = "(s.created_at > t.created_at OR s.updated_at > t.updated_at)"


def _changed(source: str, target: str) -> str:
    return f"""
    SELECT s.* FROM {source} s LEFT JOIN (SELECT * FROM {target} WHERE is_current) t
        ON s.o_orderkey = t.o_orderkey
    WHERE t.o_orderkey IS NULL OR {NEWER}"""


def _closed(source: str, target: str, day: str) -> str:
    return f"""
    SELECT * REPLACE (false AS is_current, DATE '{day}' AS valid_to) FROM {target} t
    WHERE is_current AND EXISTS (
        SELECT 1 FROM {source} s WHERE s.o_orderkey = t.o_orderkey AND {NEWER})"""


def _unchanged(source: str, target: str) -> str:
    return f"""
    SELECT * FROM {target} t
    WHERE is_current AND NOT EXISTS (
        SELECT 1 FROM {source} s WHERE s.o_orderkey = t.o_orderkey AND {NEWER})"""


def _merge(source: str, target: str, day: str, columns: str = COLUMNS) -> str:
    return f"""{_unchanged(source, target)}
    UNION ALL BY NAME {_closed(source, target, day)}
    UNION ALL BY NAME SELECT {_tracked(columns, day)} FROM ({_changed(source, target)})
    UNION ALL BY NAME SELECT * FROM {target} WHERE NOT is_current"""


HISTORY_ONE = f"""
WITH {SNAPSHOTS},
h1 AS (SELECT {_tracked(COLUMNS, "2000-01-01")} FROM one)"""
HISTORY_TWO = f"{HISTORY_ONE},\nh2 AS ({_merge('two', 'h1', '2001-09-01')})"
HISTORY_THREE = f"{HISTORY_TWO},\nh3 AS ({_merge('three', 'h2', '2001-12-01')})"

SCD2_INITIAL = f"WITH {SNAPSHOTS} SELECT {_tracked(COLUMNS, '2000-01-01')} FROM three"

RANKED = f"""
WITH {SNAPSHOTS},
ranked AS (
    SELECT *, row_number() OVER (
        PARTITION BY o_custkey
        ORDER BY updated_at DESC, created_at DESC, o_orderkey DESC) AS place
    FROM three
)"""
SCD2_LATEST_PER_KEY = f"{RANKED} SELECT {COLUMNS} FROM ranked WHERE place = 1"
SCD2_ADOPT = f"""{RANKED}
SELECT {COLUMNS}, place = 1 AS is_current, DATE '2000-01-01' AS valid_from,
       CASE WHEN place > 1 THEN DATE '2000-01-01' END AS valid_to
FROM ranked
"""

SCD2_HEAL = f"""
WITH {SNAPSHOTS}
SELECT {COLUMNS}, created_at AS valid_from, true AS is_current, CAST(NULL AS DATE) AS valid_to FROM three
"""

KEYLESS = f"""
WITH {SNAPSHOTS},
keyless_one AS (
    SELECT * REPLACE (CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey END AS o_orderkey) FROM one),
keyless_two AS (
    SELECT * REPLACE (CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey END AS o_orderkey) FROM two),
keyed_two AS (SELECT * FROM keyless_two WHERE o_orderkey IS NOT NULL),
h1 AS (SELECT {_tracked(COLUMNS, "2000-01-01")} FROM keyless_one)"""
SCD2_NULL_KEYS = f"{KEYLESS} {_merge('keyed_two', 'h1', '2001-09-01')}"
SCD2_QUARANTINE = f"""
WITH {SNAPSHOTS}
SELECT * REPLACE (CAST(NULL AS BIGINT) AS o_orderkey) FROM three WHERE o_orderpriority = '5-LOW'"""

SCD2_EVOLVED_COLUMNS = f"""{HISTORY_ONE},
evolved AS (
    SELECT * EXCLUDE (o_orderpriority), o_orderpriority = '1-URGENT' AS urgent FROM two)
{_merge('evolved', 'h1', '2001-09-01', COLUMNS.replace('o_orderpriority', 'urgent'))}"""

ADOPTED_HISTORY = f"""
WITH {SNAPSHOTS},
h1 AS (SELECT {_tracked(COLUMNS, "2000-01-01")} FROM one WHERE o_orderpriority <> '5-LOW'),
h2 AS ({_merge('two', 'h1', '2001-09-01')}),
h3 AS ({_merge('three', 'h2', '2001-12-01')})
SELECT * FROM h3
UNION ALL BY NAME
SELECT {_tracked(COLUMNS, "2000-01-01", "CAST(NULL AS BOOLEAN)")} FROM one WHERE o_orderpriority = '5-LOW'"""

# --- facts ----------------------------------------------------------------------------------------

NORMAL_NAMES = """o_orderkey AS dol_vehicle_id, o_custkey AS vin_1_10, status AS clean_fuel_cafv_status,
       o_totalprice AS base_msrp, o_orderpriority AS waofm_gis_priority_code"""

NORMALIZE_COLUMNS = f"""{HISTORY_TWO}
SELECT {NORMAL_NAMES}, created_at, updated_at, is_current, valid_from, valid_to
FROM h2 WHERE is_current
"""

CURATED_DETAIL = f"""{HISTORY_TWO},
normal AS (SELECT {NORMAL_NAMES} FROM h2 WHERE is_current)
SELECT * EXCLUDE (vin_1_10) FROM normal
"""


def _rounded(aggregate: str) -> str:
    """Rounds the shortest decimal text half up, as Spark does; DuckDB rounds the binary double."""
    text = f"CAST({aggregate} AS VARCHAR)"
    return f"CAST(round(CAST({text} AS DECIMAL(38, 18)), 2) AS DOUBLE)"


def _mean_of_cents(column: str) -> str:
    """The mean of prices in cents, rounded half away from zero in whole numbers."""
    cents = f"sum(CAST(round({column} * 100) AS BIGINT))"
    half_up = f"(2 * abs({cents}) + count({column})) // (2 * count({column}))"
    return f"CAST(sign({cents}) * ({half_up}) AS DOUBLE) / 100"


def _aggregate(keys: str, table: str, year: int) -> str:
    return f"""
SELECT {keys}, count(*) AS vehicle_count,
       {_rounded("avg(electric_range)")} AS avg_electric_range,
       {_rounded("stddev_samp(electric_range)")} AS stddev_electric_range,
       {_mean_of_cents("base_msrp")} AS avg_base_msrp,
       {year} - CAST(model_year AS INTEGER) AS vehicle_age
FROM {table}
WHERE CAST(model_year AS INTEGER) <= {year}
GROUP BY {keys}
"""


BY_NATION = """
WITH registrations AS (
    SELECT n_name AS make, c_mktsegment AS model, CAST(year(o_orderdate) AS VARCHAR) AS model_year,
           o_orderstatus AS state, o_orderpriority AS county, floor(o_totalprice) AS electric_range,
           c_acctbal AS base_msrp
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

LINES = """
WITH registrations AS (
    SELECT l_returnflag AS make, l_linestatus AS model,
           CASE WHEN l_tax > 0 THEN CAST(year(l_shipdate) AS VARCHAR) END AS model_year,
           CAST(l_linenumber AS VARCHAR) AS city,
           CASE WHEN l_returnflag <> 'N' THEN CAST(l_linenumber AS VARCHAR) END AS county,
           l_returnflag || '/' || l_linestatus AS electric_vehicle_type, 'WA' AS state,
           CASE WHEN l_discount > 0.05 THEN 'Eligible' END
               AS clean_alternative_fuel_vehicle_cafv_eligibility,
           lower(l_linestatus) AS electric_utility, lower(l_returnflag) AS counties,
           'District ' || l_linenumber AS congressional_districts,
           CASE WHEN l_discount > 0.08 THEN 'North' ELSE 'South' END
               AS waofm_gis_legislative_district_boundary,
           CAST(date_trunc('year', l_shipdate) AS DATE) AS created_at,
           CASE WHEN l_linestatus = 'F' THEN CAST(date_trunc('year', l_shipdate) AS DATE) END AS updated_at,
           l_quantity AS electric_range, l_extendedprice AS base_msrp
    FROM lineitem
)"""

ALL_KEYS = """make, model, model_year, city, county, electric_vehicle_type, state,
    clean_alternative_fuel_vehicle_cafv_eligibility, electric_utility, counties,
    congressional_districts, waofm_gis_legislative_district_boundary, created_at, updated_at"""

SNAPSHOTS_TO_FACTS = f"""{HISTORY_TWO},
registrations AS (
    SELECT status AS make, CAST(year(created_at) AS INTEGER) AS model_year, updated_at,
           o_custkey AS electric_range, o_totalprice AS base_msrp
    FROM h2 WHERE is_current
)
{_aggregate("make, model_year, updated_at", "registrations", 2001)}"""

PUBLISHED_DETAIL = f"""{HISTORY_TWO}
SELECT CAST(o_orderkey AS VARCHAR) AS order_key, status AS make, CAST(year(created_at) AS INTEGER) AS model_year,
       CAST(o_custkey AS INTEGER) AS electric_range, o_totalprice AS base_msrp
FROM h2 WHERE is_current"""

DQ_UNIQUENESS_SKETCHED = """
SELECT 'uniqueness' AS "check", c AS "column", count(*) = count(DISTINCT v) AS passed,
       CASE WHEN count(*) <> count(DISTINCT v) THEN true END AS by_sketch
FROM (
    SELECT 'o_orderkey' AS c, CAST(o_orderkey AS VARCHAR) AS v FROM orders
    UNION ALL SELECT 'o_custkey', CAST(o_custkey AS VARCHAR) FROM orders
    UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders)
GROUP BY c
"""

DISTINCT_OVER_VERSIONS = f"""
WITH {SNAPSHOTS},
every AS (SELECT * FROM one UNION ALL BY NAME SELECT * FROM two UNION ALL BY NAME SELECT * FROM three),
listed AS (
    SELECT 'o_orderkey' AS c, CAST(o_orderkey AS VARCHAR) AS v FROM every
    UNION ALL SELECT 'o_custkey', CAST(o_custkey AS VARCHAR) FROM every
    UNION ALL SELECT 'updated_at', CAST(updated_at AS VARCHAR) FROM every)
SELECT c AS "column", count(*) AS rows, count(*) - count(v) AS missing, count(DISTINCT v) AS exact,
       true AS within, true AS close
FROM listed GROUP BY c
"""

PUBLISHED_PARTS = f"""
SELECT *, true AS is_current, DATE '2000-01-01' AS valid_from, CAST(NULL AS DATE) AS valid_to
FROM ({MULTI_LINE_FILES})
"""

EXACT_SPREAD = """
WITH shifted AS (
    SELECT l_returnflag AS make, CAST(year(l_shipdate) AS INTEGER) AS model_year,
           CAST(round(l_extendedprice * 100) AS HUGEINT) + 1000000000 AS cents
    FROM lineitem
),
sums AS (
    SELECT make, model_year, count(*) AS n, sum(cents) AS total, sum(cents * cents) AS squares
    FROM shifted GROUP BY make, model_year
)
SELECT make, model_year, n AS vehicle_count,
       CASE WHEN n > 1 THEN
           round(sqrt(CAST(n * squares - total * total AS DOUBLE) / (CAST(n AS DOUBLE) * (n - 1))) / 100, 2)
       END AS stddev_electric_range
FROM sums
"""

ORACLES: dict[str, str] = {
    "column_catalog": COLUMN_CATALOG,
    "allowed_columns": f"{COLUMN_CATALOG} WHERE name <> 'id'",
    "envelope_flatten": ENVELOPE_FLATTEN,
    "envelope_flatten_mixed": ENVELOPE_FLATTEN_MIXED,
    "document_files": ENVELOPE_FLATTEN,
    "record_line_files": RECORD_LINE_FILES,
    "multi_line_files": MULTI_LINE_FILES,
    "multi_line_files_by_row": MULTI_LINE_FILES,
    "multi_line_files_by_range": MULTI_LINE_FILES,
    "published_documents": PUBLISHED_PARTS,
    "published_rows": PUBLISHED_PARTS,
    "bucketed_history": f"{HISTORY_THREE} SELECT * FROM h3",
    "compacted_history": f"{HISTORY_THREE} SELECT * FROM h3",
    "widened_history": f"{HISTORY_THREE} SELECT * FROM h3",
    "exact_spread": EXACT_SPREAD,
    "dq_report_observed": DQ_REPORT,
    "dq_uniqueness_sketched": DQ_UNIQUENESS_SKETCHED,
    "distinct_over_versions": DISTINCT_OVER_VERSIONS,
    "allow_list_flatten": ALLOW_LIST_FLATTEN,
    "published_metadata": METADATA_EXTRACT,
    "published_approvals": APPROVALS_EXPLODE,
    "number_spellings": NUMBER_SPELLINGS,
    "schema_valid": SCHEMA_VALID,
    "dq_verdict": DQ_VERDICT,
    "adopted_history": ADOPTED_HISTORY,
    "published_detail": PUBLISHED_DETAIL,
    "metadata_extract": METADATA_EXTRACT,
    "approvals_explode": APPROVALS_EXPLODE,
    "epoch_to_date": EPOCH_TO_DATE,
    "schema_drift": SCHEMA_DRIFT,
    "schema_gate_log": SCHEMA_GATE_LOG,
    "dq_completeness": DQ_COMPLETENESS,
    "dq_range": DQ_RANGE,
    "dq_uniqueness": DQ_UNIQUENESS,
    "dq_report": DQ_REPORT,
    "scd2_initial": SCD2_INITIAL,
    "scd2_latest_per_key": SCD2_LATEST_PER_KEY,
    "scd2_heal": SCD2_HEAL,
    "scd2_adopt": SCD2_ADOPT,
    "scd2_changed": f"{HISTORY_ONE} {_changed('two', 'h1')}",
    "scd2_closed": f"{HISTORY_ONE} {_closed('two', 'h1', '2001-09-01')}",
    "scd2_unchanged": f"{HISTORY_ONE} {_unchanged('two', 'h1')}",
    "scd2_merge": f"{HISTORY_TWO} SELECT * FROM h2",
    "scd2_merge_delta": f"{HISTORY_TWO} SELECT * FROM h2",
    "scd2_null_keys": SCD2_NULL_KEYS,
    "scd2_quarantine": SCD2_QUARANTINE,
    "scd2_evolved_columns": SCD2_EVOLVED_COLUMNS,
    "scd2_three_snapshots": f"{HISTORY_THREE} SELECT * FROM h3",
    "published_history": f"{HISTORY_THREE} SELECT * FROM h3",
    "current_snapshot": f"{HISTORY_TWO} SELECT * FROM h2 WHERE is_current",
    "normalize_columns": NORMALIZE_COLUMNS,
    "curated_detail": CURATED_DETAIL,
    "curated_aggregate_by_nation": BY_NATION
    + _aggregate("make, model, model_year, state, county", "registrations", 2000),
    "curated_aggregate": LINES + _aggregate(ALL_KEYS, "registrations", 2000),
    "snapshots_to_facts": SNAPSHOTS_TO_FACTS,
}
