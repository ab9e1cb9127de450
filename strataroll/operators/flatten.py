"""From documents to flat tables: positional rows, document metadata and approvals."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataroll.functions.cells import typed
from strataroll.functions.names import named

# Suffix of the column that keeps a cell's text when it does not fit its declared type.
REJECTED = "__rejected"

# Paths under meta.view and the names they get in the metadata table.
METADATA_FIELDS = {
    "id": "dataset_id",
    "name": "dataset_name",
    "description": "description",
    "owner.displayName": "owner_name",
    "tags": "tags",
    "createdAt": "created_at",
    "publicationDate": "publication_date",
}

# Paths inside one approval and the names they get in the approvals table.
APPROVAL_FIELDS = {
    "reviewedAt": "reviewed_at",
    "reviewedAutomatically": "reviewed_automatically",
    "state": "state",
    "submissionId": "submission_id",
    "submissionDetails.permissionType": "permission_type",
    "submitter.displayName": "submitter_name",
    "submissionOutcomeApplication.status": "outcome_status",
    "submittedAt": "submitted_at",
}


def column_catalog(
    docs: DataFrame, *keep: str, allowed: Collection[str] | None = None
) -> DataFrame:
    """One row per described column: ``ordinal`` (position in each data row), ``field_name``, ``name``.

    Ordinals count every entry; entries without a field name are not data columns and are left out,
    as are names that are not ``allowed``. ``keep`` names document columns to carry along.
    """
    entries = docs.select(*map(named, keep), F.posexplode("meta.view.columns").alias("ordinal", "entry"))
    if allowed is not None:
        entries = entries.filter(F.col("entry.name").isin(list(allowed)))
    return entries.filter("entry.fieldName IS NOT NULL").select(
        *map(named, keep),
        "ordinal",
        F.col("entry.fieldName").alias("field_name"),
        F.col("entry.name").alias("name"),
    )


def ordinal_of(name: str, catalog: str = "meta.view.columns") -> Column:
    """Position of a described column in this document's data rows; -1 if it has none."""
    names = F.transform(catalog, lambda c: F.when(c["fieldName"].isNotNull(), c["name"]))
    return (F.coalesce(F.array_position(names, F.lit(name)), F.lit(0)) - 1).cast("int")


def _ordinals(columns: Mapping[str, str]) -> list[Column]:
    return [ordinal_of(name).alias(f"_at{i}") for i, name in enumerate(columns)]


def _cells(columns: Mapping[str, str], keep_rejected: bool) -> list[Column]:
    out = []
    for i, (name, type_name) in enumerate(columns.items()):
        cell = F.get("record", F.col(f"_at{i}"))
        value = typed(cell, type_name)
        out.append(value.alias(name))
        if keep_rejected and type_name != "string":
            out.append(F.when(value.isNull(), cell).alias(name + REJECTED))
    return out


def flatten(
    docs: DataFrame, columns: Mapping[str, str], *, keep_rejected: bool = False
) -> DataFrame:
    """Typed rows of all documents, one column per entry of ``columns`` (name to declared type).

    Positions come from each document's own catalogue, so documents may order their columns
    differently. They are looked up once per document, before its rows are generated. Columns a
    document lacks, and cells beyond the end of a short row, are null; undeclared columns are left
    out. ``keep_rejected`` adds the text of cells that do not fit their type (see ``REJECTED``).
    """
    if not columns:
        raise ValueError("No columns are declared, so there is nothing to read")
    # The outer generator implies no filter on the array, which would parse each document again.
    rows = docs.select("data", *_ordinals(columns)).select(
        F.posexplode_outer("data").alias("_row", "record"), *[f"_at{i}" for i in range(len(columns))]
    )
    rows = rows.filter(F.col("_row").isNotNull())
    return rows.select(*_cells(columns, keep_rejected))


def flatten_record_lines(
    records: DataFrame,
    docs: DataFrame,
    columns: Mapping[str, str],
    *,
    keep_rejected: bool = False,
    broadcast_catalog: bool = False,
) -> DataFrame:
    """As ``flatten``, for rows read line by line; ``docs`` supplies each file's catalogue.

    The catalogue side has one short row per file. Set ``broadcast_catalog`` if their number has
    been checked (see ``catalog_bytes``): the rows are then not shuffled. Otherwise the join is left
    to Spark, and adaptive execution splits a file that holds much of the data.
    """
    if not columns:
        raise ValueError("No columns are declared, so there is nothing to read")
    positions = docs.select("source_file", *_ordinals(columns))
    if broadcast_catalog:
        positions = F.broadcast(positions)
    return records.join(positions, "source_file").select(*_cells(columns, keep_rejected))


def catalog_bytes(documents: int, columns: Mapping[str, str]) -> int:
    """Generous size of the catalogue side of ``flatten_record_lines``: a path and the positions."""
    return documents * (1024 + 8 * len(columns))


def metadata(docs: DataFrame) -> DataFrame:
    """One row per document with its descriptive fields; times stay epoch seconds."""
    return docs.select(*[F.col(f"meta.view.{path}").alias(n) for path, n in METADATA_FIELDS.items()])


def approvals(docs: DataFrame) -> DataFrame:
    """One row per approval; documents without approvals give none."""
    each = docs.select(F.explode("meta.view.approvals").alias("approval"))
    return each.select(*[F.col(f"approval.{path}").alias(n) for path, n in APPROVAL_FIELDS.items()])
