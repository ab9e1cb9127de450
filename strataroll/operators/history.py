"""Slowly changing dimension history (type 2): insert, close and carry rows by business key.

Rules of a merge of a snapshot into the current rows:

=====================================================  ============================================
key not in the current rows                            insert as current
matched and a change column is strictly newer          close the old row, insert the new one
matched, all change columns equal or older             keep the old row, even if other values differ
a change column null on either side                    that column decides nothing
key missing from the snapshot                          keep the old row: deletes are not detected
null key in the snapshot                               set aside (``without_key``), it can never match
null key in the history                                carried forward, it can never match
several snapshot rows with one key                     the latest counts
row already closed                                     kept for good
=====================================================  ============================================

The history holds at most one current row per key. Tables written by these functions do; a table
taken over from elsewhere is brought into that form once by ``adopt``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataroll.functions.names import named
from strataroll.functions.widening import widened, widens

IS_CURRENT, VALID_FROM, VALID_TO = "is_current", "valid_from", "valid_to"
TRACKING = [IS_CURRENT, VALID_FROM, VALID_TO]


def _as_date(day: date) -> Column:
    return F.lit(day).cast("date")


def start_tracking(df: DataFrame, as_of: date) -> DataFrame:
    """Rows as current from ``as_of`` on."""
    return df.withColumns(
        {IS_CURRENT: F.lit(True), VALID_FROM: _as_date(as_of), VALID_TO: F.lit(None).cast("date")}
    )


def heal_tracking(df: DataFrame, as_of: date) -> DataFrame:
    """Add whichever tracking columns a table lacks, with the values of a current row."""
    defaults = {
        IS_CURRENT: F.lit(True),
        VALID_FROM: _as_date(as_of),
        VALID_TO: F.lit(None).cast("date"),
    }
    absent = {name: value for name, value in defaults.items() if name not in df.columns}
    return df.withColumns(absent) if absent else df


def without_key(source: DataFrame, key: str) -> DataFrame:
    """Snapshot rows that cannot enter the history because their key is null."""
    return source.filter(named(key).isNull())


def _newest_first(df: DataFrame, key: str, change_columns: Sequence[str]) -> WindowSpec:
    """Newest row of a key first; ties are settled by the other columns, so the order is total."""
    others = [
        f.name
        for f in df.schema
        if f.name != key
        and f.name not in change_columns
        and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    # The column that tells of the latest change is listed last and compared first.
    newest = [named(c).desc_nulls_last() for c in reversed(change_columns)]
    return Window.partitionBy(named(key)).orderBy(
        *newest, *[named(c).desc_nulls_last() for c in others]
    )


def latest_per_key(source: DataFrame, key: str, change_columns: Sequence[str]) -> DataFrame:
    """Snapshot rows with a key, one per key.

    Spark applies the rank limit before the shuffle as well, so each task sends at most one row
    per key, however many copies of one key it holds. The shuffle is the one the merge needs.
    """
    rank = F.row_number().over(_newest_first(source, key, change_columns))
    ranked = source.filter(named(key).isNotNull()).withColumn("_rank", rank)
    return ranked.filter("_rank = 1").drop("_rank")


def adopt(
    table: DataFrame, key: str, change_columns: Sequence[str], as_of: date
) -> DataFrame:
    """Bring a table from elsewhere into history form: tracked, one current row per key.

    The newest current row of a key stays current and the others are closed as of ``as_of``. The
    others are found by taking the newest rows away from all rows, which spreads a key with many
    rows over the cluster; closed rows are not shuffled.
    """
    healed = heal_tracking(table, as_of)
    usable = healed.filter(F.col(IS_CURRENT) & named(key).isNotNull())
    newest = latest_per_key(usable, key, change_columns)
    closed = {IS_CURRENT: F.lit(False), VALID_TO: _as_date(as_of)}
    older = usable.exceptAll(newest).withColumns(closed)
    return _with_bypassing(newest.unionByName(older), healed, key)


def _with_bypassing(rows: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Add the history rows no snapshot row can touch: closed ones and current ones without a key.

    Two plain filters, so that folders or Parquet statistics rule out what is not needed.
    """
    flag = F.col(IS_CURRENT)
    closed = history.filter(flag.isNull() | ~flag)
    keyless = history.filter(flag & named(key).isNull())
    return rows.unionByName(closed, allowMissingColumns=True).unionByName(
        keyless, allowMissingColumns=True
    )


def _newer(change_columns: Sequence[str]) -> Column:
    """True only if a change column is known to be newer in the snapshot."""
    comparisons = [named(c, "src") > named(c, "tgt") for c in change_columns]
    return F.coalesce(reduce(or_, comparisons), F.lit(False))


def _widened_for(history: DataFrame, source: DataFrame) -> DataFrame:
    """``history`` with its columns in the types of the snapshot where those are wider."""
    new = {f.name: f.dataType for f in source.schema if f.name not in TRACKING}
    wider = {f.name: new[f.name] for f in history.schema if f.name in new and widens(f.dataType, new[f.name])}
    if not wider:
        return history
    return widened(history, T.StructType([T.StructField(f.name, wider.get(f.name, f.dataType)) for f in history.schema]))


def _merged_columns(source: DataFrame, current: DataFrame) -> list[str]:
    """Columns of the history, then those only the snapshot has, then the tracking columns."""
    types = {f.name: f.dataType for f in current.schema}
    clashes = [f.name for f in source.schema if f.name in types and types[f.name] != f.dataType]
    if clashes:
        raise ValueError(f"Snapshot and history disagree on the types of {clashes}")
    old = [c for c in current.columns if c not in TRACKING]
    return old + [c for c in source.columns if c not in old and c not in TRACKING]


def merge_current(
    source: DataFrame,
    current: DataFrame,
    key: str,
    change_columns: Sequence[str],
    as_of: date,
    *,
    reduced: bool = False,
) -> DataFrame:
    """Merge a snapshot into current rows: the new current rows and the rows just closed.

    One full outer join shuffles each side once; every joined row then yields the one or two rows
    it stands for. ``current`` must be tracked, current and have unique non-null keys. A snapshot that is
    ``reduced`` has been through ``latest_per_key``.
    """
    columns = _merged_columns(source, current)
    latest = source if reduced else latest_per_key(source, key, change_columns)
    snapshot = latest.withColumn("_in", F.lit(True))
    held = current.withColumn("_in", F.lit(True))
    src, tgt = snapshot.alias("src"), held.alias("tgt")
    joined = src.join(tgt, named(key, "src") == named(key, "tgt"), "full")

    def row(side: str, have: DataFrame, is_current: bool, since: Column, until: Column) -> Column:
        other = {**_types(source), **_types(current)}
        values = [
            named(c, side) if c in have.columns else F.lit(None).cast(other[c]).alias(c)
            for c in columns
        ]
        tracked = zip([F.lit(is_current), since, until], TRACKING)
        return F.struct(*values, *[value.alias(name) for value, name in tracked])

    inserted = row("src", source, True, _as_date(as_of), F.lit(None).cast("date"))
    carried = row("tgt", current, True, named(VALID_FROM, "tgt"), named(VALID_TO, "tgt"))
    closed = row("tgt", current, False, named(VALID_FROM, "tgt"), _as_date(as_of))
    rows = (
        F.when(F.col("src._in").isNull(), F.array(carried))
        .when(F.col("tgt._in").isNull(), F.array(inserted))
        .when(_newer(change_columns), F.array(closed, inserted))
        .otherwise(F.array(carried))
    )
    return joined.select(F.inline(rows))


def _types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema}


def merge_delta(
    source: DataFrame,
    current: DataFrame,
    key: str,
    change_columns: Sequence[str],
    as_of: date,
    *,
    reduced: bool = False,
) -> DataFrame:
    """The result of ``merge_current``, planned for a snapshot that is small beside the history.

    A full outer join has to shuffle the whole history. Here history rows meet only the snapshot's
    key and change columns in a left join, and snapshot rows meet only the history rows with their
    keys. Spark broadcasts the snapshot's side of both while it is under its size threshold, and
    the history is then read without a shuffle; over the threshold both become sort-merge joins. The
    snapshot is used three times, so it should be a stored one that is ``reduced``.
    """
    columns = _merged_columns(source, current)
    narrow = [key, *change_columns]
    snapshot = source if reduced else latest_per_key(source, key, change_columns)
    signals = snapshot.select(*map(named, narrow), F.lit(True).alias("_in"))

    held = current.alias("tgt").join(
        signals.alias("src"), named(key, "tgt") == named(key, "src"), "left"
    )
    superseded = _newer(change_columns)
    kept = held.select(
        *[named(c, "tgt") for c in current.columns if c not in TRACKING],
        (~superseded).alias(IS_CURRENT),
        named(VALID_FROM, "tgt"),
        F.when(superseded, _as_date(as_of)).otherwise(named(VALID_TO, "tgt")).alias(VALID_TO),
    )

    matched = current.select(*map(named, narrow)).join(signals.select(named(key)), key, "left_semi")
    met = snapshot.alias("src").join(
        matched.withColumn("_in", F.lit(True)).alias("tgt"),
        named(key, "src") == named(key, "tgt"),
        "left",
    )
    fresh = met.filter(F.col("tgt._in").isNull() | _newer(change_columns)).select("src.*")
    merged = kept.unionByName(start_tracking(fresh, as_of), allowMissingColumns=True)
    return merged.select(*map(named, [*columns, *TRACKING]))


def first_history(
    source: DataFrame, key: str, change_columns: Sequence[str], as_of: date
) -> DataFrame:
    """History of a first snapshot: the latest row of each key, all current."""
    return start_tracking(latest_per_key(source, key, change_columns), as_of)


def scd2_merge(
    source: DataFrame,
    target: DataFrame | None,
    key: str,
    change_columns: Sequence[str],
    as_of: date,
    *,
    small_source: bool = False,
    reduced: bool = False,
) -> DataFrame:
    """The whole history after merging a snapshot, closed rows of earlier merges included.

    ``target`` is the history so far, or None for the first snapshot; tracking columns it lacks
    are added. Columns only one side has are kept and null on the other. A column whose type is wider in the
    snapshot (``functions.widening``) becomes wider in the history; any other difference raises. Rows that
    cannot change skip the join. ``small_source`` picks ``merge_delta``; the result is the same. A snapshot
    that is ``reduced`` has been through ``latest_per_key``. A target that is itself the result of a merge should be
    stored first: its current, closed and keyless rows are read apart.
    """
    if target is None:
        return start_tracking(source, as_of) if reduced else first_history(source, key, change_columns, as_of)
    history = _widened_for(heal_tracking(target, as_of), source)
    current = history.filter(F.col(IS_CURRENT) & named(key).isNotNull())
    merge = merge_delta if small_source else merge_current
    merged = merge(source, current, key, change_columns, as_of, reduced=reduced)
    return _with_bypassing(merged, history, key)


def _matched(
    source: DataFrame, target: DataFrame, key: str, change_columns: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    return latest_per_key(source, key, change_columns), target.filter(F.col(IS_CURRENT))


def changed_rows(
    source: DataFrame, target: DataFrame, key: str, change_columns: Sequence[str]
) -> DataFrame:
    """Snapshot rows a merge would insert: new keys and newer versions."""
    snapshot, current = _matched(source, target, key, change_columns)
    held = current.select(*map(named, [key, *change_columns]), F.lit(True).alias("_in"))
    met = snapshot.alias("src").join(
        held.alias("tgt"), named(key, "src") == named(key, "tgt"), "left"
    )
    return met.filter(F.col("tgt._in").isNull() | _newer(change_columns)).select("src.*")


def closed_rows(
    source: DataFrame, target: DataFrame, key: str, change_columns: Sequence[str], as_of: date
) -> DataFrame:
    """Current rows a merge would close, already closed."""
    snapshot, current = _matched(source, target, key, change_columns)
    met = current.alias("tgt").join(
        snapshot.select(*map(named, [key, *change_columns])).alias("src"),
        (named(key, "tgt") == named(key, "src")) & _newer(change_columns),
        "left_semi",
    )
    return met.withColumns({IS_CURRENT: F.lit(False), VALID_TO: _as_date(as_of)})


def unchanged_rows(
    source: DataFrame, target: DataFrame, key: str, change_columns: Sequence[str]
) -> DataFrame:
    """Current rows a merge would carry forward. Those without a key skip the join."""
    snapshot, current = _matched(source, target, key, change_columns)
    kept = current.filter(named(key).isNotNull()).alias("tgt").join(
        snapshot.select(*map(named, [key, *change_columns])).alias("src"),
        (named(key, "tgt") == named(key, "src")) & _newer(change_columns),
        "left_anti",
    )
    return kept.unionByName(current.filter(named(key).isNull()))
