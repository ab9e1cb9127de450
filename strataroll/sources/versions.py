"""Versioned Parquet tables on plain storage, published together and never overwritten.

Layout under a root folder::

    <root>/<table>/v=<n>/[run=<id>/]...   data of version n
    <root>/commits/<n>.json               one record per committed version

A version's tables are all written first; only then is its commit record created. A record says where the
latest data of every table lies, so readers need the newest record alone. A run that dies midway leaves the
last committed version in place; its leftovers are in no record.

A record is created only if there is none of its number, by the store itself. So of two writers that
start from the same version one commits and the other gets ``Conflict``. The jobs write each run's data to a
folder of its own, so neither touches the other's.

The history table is cut by ``is_current``. A version holds the current rows it was given, but only the rows
it closed itself: closed rows never change, so they are neither read nor rewritten by later versions. The record
lists the folders of closed rows; ``compact`` folds them. With buckets, current rows are cut by a hash of
the key too, a version holds only the buckets it touched, and the record says which folder has each bucket.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace
from datetime import date
from functools import reduce
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataroll.functions.names import named
from strataroll.functions.widening import widened

COMMITS = "commits"
COMMIT_SCHEMA = "version int, as_of string, tables map<string, string>"
HISTORY = "history"
VERSION, RUN, BUCKET = "v", "run", "key_bucket"
IS_CURRENT = "is_current"
#: Key of the one folder of current rows of a history without buckets.
ALL = "all"


class Conflict(RuntimeError):
    """Another writer has committed the version first."""


@dataclass(frozen=True)
class Record:
    """What the newest commit says of all tables. Folders are relative to their table's."""

    version: int = 0
    as_of: str = ""
    #: Folder and schema of the latest write of each table.
    folders: Mapping[str, str] = field(default_factory=dict)
    schemas: Mapping[str, str] = field(default_factory=dict)
    #: Folder of the current rows of each bucket, and how many buckets there are (0: not cut).
    current: Mapping[str, str] = field(default_factory=dict)
    buckets: int = 0
    #: Folders that hold closed rows, each with how often its rows were folded.
    closed: tuple[tuple[str, int], ...] = ()
    #: Schema of each folder of the history, and how many buckets it is cut into.
    history: Mapping[str, list] = field(default_factory=dict)


def if_present(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The result of a read, or None if its path does not exist. Other failures are raised."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def commits(spark: SparkSession, root: str) -> list[Row]:
    """``version, as_of, tables`` (names) of each commit, oldest first: a short row per run."""
    found = if_present(lambda: spark.read.schema(COMMIT_SCHEMA).json(f"{root}/{COMMITS}"))
    if found is None:
        return []
    names = found.filter("version IS NOT NULL").select("version", "as_of", F.map_keys("tables").alias("tables"))
    return sorted(names.collect(), key=lambda r: r.version)


def _store(spark: SparkSession, path: str) -> tuple:
    """The path as the store's own, and the store."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(context._jsc.hadoopConfiguration())


def latest(spark: SparkSession, root: str) -> Record:
    """The newest commit record, found by its name and read alone; an empty one if there is none."""
    folder, store = _store(spark, f"{root}/{COMMITS}")
    if not store.exists(folder):
        return Record()
    names = [status.getPath().getName() for status in store.listStatus(folder)]
    numbers = sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())
    for number in reversed(numbers):
        text = "".join(r.value for r in spark.read.text(f"{root}/{COMMITS}/{number}.json", wholetext=True).collect())
        if text.endswith("}\n"):  # else its writer is about to write it
            found = json.loads(text)
            del found["tables"]
            return Record(**found | {"closed": tuple(map(tuple, found["closed"]))})
    return Record()


def _create(spark: SparkSession, path: str, text: str) -> None:
    """A new file with this text. Raises ``Conflict`` if the file exists: the store lets one writer succeed."""
    place, store = _store(spark, path)
    taken = Conflict(f"{path} was committed by another writer")
    store.mkdirs(place.getParent())
    if store.getUri().getScheme() == "file":
        # Hadoop's local file system looks first and creates then; the system itself does both at once.
        try:
            handle = os.open(place.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY, 0o644)
        except FileExistsError:
            raise taken from None
        with os.fdopen(handle, "w", encoding="utf-8") as file:
            file.write(text)
        return
    try:
        stream = store.create(place, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName() or store.exists(place):
            raise taken from error
        raise
    stream.write(bytearray(text.encode()))
    stream.close()


def next_version(spark: SparkSession, root: str) -> int:
    return latest(spark, root).version + 1


def new_run() -> str:
    return uuid4().hex[:12]


def _folder(version: int, run: str | None) -> str:
    return f"{VERSION}={version}" + (f"/{RUN}={run}" if run else "")


def version_path(root: str, table: str, version: int, run: str | None = None) -> str:
    return f"{root}/{table}/{_folder(version, run)}"


def write_version(
    df: DataFrame, root: str, table: str, version: int, partition_by: Iterable[str] = (), run: str | None = None
) -> DataFrame:
    """Write one table of a version that is not committed yet and return it read back."""
    taken = {VERSION, RUN} & set(map(str.lower, df.columns))
    if taken:
        raise ValueError(f"A column named {min(taken)!r} would be taken for the version folder")
    path = version_path(root, table, version, run)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return _read(df.sparkSession, df.schema, path)


def bucket_of(key: str, buckets: int) -> Column:
    """Bucket of a row by a hash of its key; rows without a key share one."""
    return F.pmod(F.xxhash64(named(key)), F.lit(buckets)).cast("int").alias(BUCKET)


def commit(
    spark: SparkSession,
    root: str,
    version: int,
    as_of: date,
    tables: Mapping[str, DataFrame],
    *,
    run: str | None = None,
    touched: Iterable[int] | None = None,
    buckets: int = 0,
    closed: Iterable[tuple[str, int]] | None = None,
    base: Record | None = None,
) -> Record:
    """Make a version visible, or raise ``Conflict``. Records each table's schema, so readers infer nothing.

    A history is taken as holding all current rows, or with ``touched`` those of these of ``buckets`` buckets:
    the others stay where they are, unless the number of buckets has changed. ``closed`` replaces the list of
    folders of closed rows, for a version without other tables. ``base`` is the record that the
    tables were made from, by default the newest.
    """
    base = latest(spark, root) if base is None else base
    if base.version != version - 1:
        raise Conflict(f"Version {version} does not follow version {base.version}")
    here = _folder(version, run)
    schemas = {name: df.schema for name, df in tables.items()}
    texts = {name: schema.json() for name, schema in schemas.items()}
    record = replace(
        base,
        version=version,
        as_of=as_of.isoformat(),
        folders={**base.folders, **dict.fromkeys(tables, here)},
        schemas={**base.schemas, **texts},
    )
    if HISTORY in tables and closed is None:
        plain = T.StructType([f for f in schemas[HISTORY] if f.name != BUCKET])
        kept = base.current if touched is not None and base.buckets == buckets else {}
        current = {**kept, **{str(b): here for b in touched}} if touched is not None else {ALL: here}
        record = replace(
            record,
            schemas={**record.schemas, HISTORY: plain.json()},
            current=current,
            buckets=buckets if touched is not None else 0,
            closed=(*base.closed, (here, 0)),
            history={**base.history, here: [plain.json(), buckets if touched is not None else 0]},
        )
    elif closed is not None:
        record = replace(record, closed=tuple(closed), history={**base.history, here: [texts[HISTORY], 0]})
        # The table as such stays where its current rows are.
        record = replace(record, folders={**record.folders, HISTORY: base.folders[HISTORY]})
    used = {*record.current.values(), *(folder for folder, _ in record.closed)}
    record = replace(record, history={f: s for f, s in record.history.items() if f in used})
    content = record.__dict__ | {"tables": texts}
    _create(spark, f"{root}/{COMMITS}/{version}.json", json.dumps(content) + "\n")
    return record


def _schema(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def _read(spark: SparkSession, schema: T.StructType, *paths: str, base: str | None = None) -> DataFrame:
    """Parquet with a known schema: no inference, empty tables work, folder columns keep their place."""
    reader = spark.read.schema(schema)
    reader = reader.option("basePath", base) if base else reader
    return reader.parquet(*paths).select(*map(named, schema.names))


def read_table(spark: SparkSession, root: str, table: str, record: Record | None = None) -> DataFrame | None:
    """A table as of the latest version that wrote it, or None."""
    record = record or latest(spark, root)
    if table not in record.folders:
        return None
    if table == HISTORY:
        return read_history(spark, root, record)
    return _read(spark, _schema(record.schemas[table]), f"{root}/{table}/{record.folders[table]}")


def read_versions(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """All versions of a table that is not the history, with the ``version`` that wrote each row, or None.

    Reads the folders and schemas from the records of those versions: a short row for each.
    """
    schema = "version int, tables map<string, string>, folders map<string, string>"
    found = if_present(lambda: spark.read.schema(schema).json(f"{root}/{COMMITS}"))
    if found is None:
        return None
    wrote = found.filter(F.map_contains_key("tables", table))
    rows = wrote.select("version", F.col("tables")[table].alias("schema"), F.col("folders")[table].alias("folder")).collect()
    frames = [
        _read(spark, _schema(r.schema), f"{root}/{table}/{r.folder}").withColumn("version", F.lit(r.version))
        for r in sorted(rows, key=lambda r: r.version)
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else None


def _of_history(spark: SparkSession, root: str, record: Record, parts: Mapping[str, str]) -> DataFrame:
    """Folders of the history (each path with the folder whose schema it has) under the newest schema.

    Folders of one schema and one layout are read together. Columns added later are null in older ones, and columns that
    have a wider type by now are cast.
    """
    newest = _schema(record.schemas[HISTORY])
    alike: dict[tuple, list[str]] = {}
    for path, folder in parts.items():
        schema, buckets = record.history[folder]
        alike.setdefault((schema, f"/{RUN}=" in folder, buckets > 0), []).append(path)
    base = f"{root}/{HISTORY}"
    frames = [_read(spark, _schema(schema), *paths, base=base) for (schema, *_), paths in alike.items()]
    if not frames:
        return spark.createDataFrame([], newest)
    return reduce(DataFrame.union, [widened(frame, newest) for frame in frames])


def read_current(
    spark: SparkSession, root: str, record: Record | None = None, buckets: Iterable[int] | None = None
) -> DataFrame | None:
    """Current rows of the history, or None. Only their folders are opened; with ``buckets`` only those of these."""
    record = record or latest(spark, root)
    if HISTORY not in record.schemas:
        return None
    wanted = record.current if buckets is None else {k: v for k, v in record.current.items() if int(k) in set(buckets)}
    inside = "/{}={}/{}={}".format if record.buckets else lambda *_: ""
    parts = {f"{root}/{HISTORY}/{f}" + inside(IS_CURRENT, "true", BUCKET, b): f for b, f in wanted.items()}
    return _of_history(spark, root, record, parts).filter(IS_CURRENT)


def read_closed(spark: SparkSession, root: str, record: Record, folders: Iterable[str]) -> DataFrame:
    """Closed rows, and rows without a flag, of these folders. The filter is on folder names."""
    parts = {f"{root}/{HISTORY}/{folder}": folder for folder in folders}
    return _of_history(spark, root, record, parts).filter(F.coalesce(~F.col(IS_CURRENT), F.lit(True)))


def read_history(spark: SparkSession, root: str, record: Record | None = None) -> DataFrame | None:
    """The whole history: current rows of the latest version and closed rows of all versions.

    Rows without a flag are written once, like closed ones, and kept from every version. Superseded
    current rows are never opened.
    """
    record = record or latest(spark, root)
    current = read_current(spark, root, record)
    if current is None:
        return None
    return current.union(read_closed(spark, root, record, [folder for folder, _ in record.closed]))


def compact(spark: SparkSession, root: str, fan_in: int = 8) -> int:
    """Fold folders of closed rows, so that few are read; returns how many versions this committed.

    Where ``fan_in`` folders have been folded equally often, they become one. So readers open at most
    ``fan_in - 1`` folders for each power of ``fan_in`` in the number of versions, and a row is written again once a
    power. The folded folders stay, for readers that have begun; no later reader opens them.
    """
    if fan_in < 2:
        raise ValueError("At least two folders can be folded into one")
    done = 0
    while True:
        record = latest(spark, root)
        levels = [level for _, level in record.closed]
        full = [level for level in sorted(set(levels)) if levels.count(level) >= fan_in]
        if not full:
            return done
        old = [folder for folder, level in record.closed if level == full[0]]
        version, run = record.version + 1, new_run()
        rows = read_closed(spark, root, record, old)
        written = write_version(rows, root, HISTORY, version, [IS_CURRENT], run)
        kept = [part for part in record.closed if part[0] not in old]
        closed = [*kept, (_folder(version, run), full[0] + 1)]
        as_of = date.fromisoformat(record.as_of)
        commit(spark, root, version, as_of, {HISTORY: written}, run=run, closed=closed, base=record)
        done += 1
