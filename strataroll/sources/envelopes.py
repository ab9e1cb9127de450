"""Readers for self-describing JSON documents: ``meta.view`` describes the positional rows in ``data``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Read schema. Fields a document lacks read as null. Every cell is text: one row mixes types.
VIEW_SCHEMA = """
    struct<
      id: string,
      name: string,
      description: string,
      owner: struct<displayName: string>,
      tags: array<string>,
      createdAt: bigint,
      publicationDate: bigint,
      columns: array<struct<fieldName: string, name: string>>,
      approvals: array<struct<
        reviewedAt: bigint,
        reviewedAutomatically: boolean,
        state: string,
        submissionId: string,
        submissionDetails: struct<permissionType: string>,
        submitter: struct<displayName: string>,
        submissionOutcomeApplication: struct<status: string>,
        submittedAt: bigint>>>
"""
META_SCHEMA = f"meta struct<view: {VIEW_SCHEMA}>"
ENVELOPE_SCHEMA = f"{META_SCHEMA}, data array<array<string>>"


def _source_file() -> Column:
    return F.col("_metadata.file_path").alias("source_file")


def read_envelopes(
    spark: SparkSession, path: str, *, multi_line: bool = True, mode: str = "FAILFAST"
) -> DataFrame:
    """One row per document: ``meta``, ``data`` and the ``source_file`` it came from.

    The schema is given, so there is no inference pass. With ``multi_line`` a file is one document
    and one task; without it every line is a document and large files are split. A document that
    does not parse stops the read; pass ``mode="PERMISSIVE"`` to get nulls instead.

    A file of ``multi_line`` holds one document: a second one, or other text after it, raises an
    error. Its text is one value, so it is limited to 2 GB. Numbers with a fraction pass through a double
    and lose digits beyond its precision, also for ``decimal`` columns.

    Documents are read as text and parsed from memory. Spark's multi-line JSON source keeps the
    exact text of numbers and nested values by going back to the file for each of them, which is
    one storage request per cell. Here such cells come out in JSON's plain form: ``1.10`` as ``1.1``.
    """
    return _documents(spark, path, multi_line, ENVELOPE_SCHEMA, mode)


def _documents(spark: SparkSession, path: str, multi_line: bool, schema: str, mode: str) -> DataFrame:
    return documents_of_texts(spark.read.text(path, wholetext=multi_line), _source_file(), schema, mode)


def documents_of_texts(texts: DataFrame, source_file: Column, schema: str, mode: str) -> DataFrame:
    """Each text of ``value`` parsed as an array of one document, so that text after the document is an error.

    Only text that begins with a closing bracket and ends with a brace can pass for the end of that array.
    The outer generator implies no filter, so each text is parsed once.
    """
    texts = texts.filter(F.trim("value") != "")
    ended = F.rtrim(F.translate("value", "\t\r\n", "   ")).endswith("}")
    wrapped = F.when(ended, F.concat(F.lit("["), F.col("value"), F.lit("]"))).otherwise("[")
    parsed = F.from_json(wrapped, f"array<struct<{_typed(schema)}>>", {"mode": mode})
    each = texts.select(F.posexplode_outer(parsed).alias("at", "document"), source_file)
    return each.select("document.*", "source_file")


def _typed(schema: str) -> str:
    return schema.replace("meta struct", "meta: struct").replace("data array", "data: array")


def read_meta(
    spark: SparkSession, path: str, *, multi_line: bool = True, mode: str = "FAILFAST", streamed: bool = False
) -> DataFrame:
    """As ``read_envelopes`` without ``data``, whose rows are skipped over and not held as values.

    A file with anything after its one document raises an error, as there. ``streamed`` reads files
    of any size without holding their text, but does not see what follows the first document; it is for
    files whose rows are read by line.
    """
    if streamed:
        reader = spark.read.schema(META_SCHEMA).option("multiLine", multi_line).option("mode", mode)
        return reader.json(path).select("meta", _source_file())
    return _documents(spark, path, multi_line, META_SCHEMA, mode)


def read_record_lines(spark: SparkSession, path: str) -> DataFrame:
    """The positional rows of documents that keep each row on its own line, read in parallel.

    A multi-line document is parsed by one task, however large it is. Where its ``data`` rows start
    new lines, as open-data downloads write them, the lines can be split over the cluster instead::

        "data" : [ [ "a", 1 ]
        , [ "b", 2 ]
        ] }

    Returns ``source_file`` and ``record array<string>``. Several rows on one line are all read, null ones
    among them too. A row broken over lines, ``data`` opened inside another line, and a line that begins with
    ``null``, which may be a row or not, raise an error. No line outside ``data`` may start with an
    opening bracket: a line does not show which array it is in.
    """
    opens_data = r'^"data"\s*:\s*\['
    lines = spark.read.text(path).select(
        _source_file(), F.rtrim(F.expr("trim(LEADING ', \t' FROM value)")).alias("line")
    )
    line = F.col("line")
    # Null for lines that are no data rows.
    rows_text = F.when(line.startswith("["), line).when(
        line.startswith('"') & line.rlike(opens_data), F.regexp_replace(line, opens_data, "")
    )
    # Closing the array makes every line an array of rows. What follows the closing bracket is the
    # document's own tail and is not parsed.
    rows = F.from_json(
        F.concat(F.lit("["), F.regexp_replace("rows_text", r",\s*$", ""), F.lit("]")),
        "array<array<string>>",
        {"mode": "FAILFAST"},
    )
    hides_rows = line.rlike(r'(?<!\\)"data"\s*:\s*\[|^null\s*(,|\]|$)')
    hides_data = F.col("rows_text").isNull() & hides_rows
    broken = F.raise_error(F.lit("A document does not keep its data rows on lines of their own"))
    return (
        lines.select("source_file", "line", rows_text.alias("rows_text"))
        .select(
            "source_file",
            F.when(hides_data, broken.cast("array<array<string>>")).otherwise(rows).alias("rows"),
        )
        # The outer generator implies no filter on the rows, which would parse each line again.
        .select("source_file", F.posexplode_outer("rows").alias("at", "record"))
        .filter(F.col("at").isNotNull())
        .select("source_file", "record")
    )
