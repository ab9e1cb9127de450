"""One large document over many tasks: a finite-state scan of ranges of lines.

Spark cuts a text file into ranges. What a line means depends on all text before it: whether it lies in
``data``, in a row of it, or elsewhere. So the text is read twice:

1. Each range is scanned without knowing its start. Its summary says what it does to any
   start: which containers it closes that were open before, which it leaves open, and how it ends.
2. Composing the summaries of a file in order, one short record for each range, gives each range its start.
   With that, each range yields the rows that lie in it, ready to be parsed, the pieces of rows that
   cross its ends, and the text outside ``data``.

A text in JSON holds no line feed, so lines never begin inside one. No other layout is asked for: rows may
share lines or span them, and brackets anywhere else are no rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataroll.sources.envelopes import ENVELOPE_SCHEMA, documents_of_texts
from strataroll.sources.shared import shared_folder

_TEXT = r'"[^"\\]*(?:\\.[^"\\]*)*"'
TOKEN = re.compile(rf'{_TEXT}|[\[\]{{}}:,]|[^\s\[\]{{}}:,"]+|"')
#: A line that holds one row without nested values and perhaps a comma on either side: most lines of a download.
FLAT_ROW = re.compile(rf'\s*(,?)\s*(\[[^\[\]{{}}"]*(?:{_TEXT}[^\[\]{{}}"]*)*\])\s*(,?)\s*\Z')
CLOSES = {"]": "[", "}": "{"}
#: Largest table of starts that is broadcast, in bytes, and the size that a start is counted with.
BROADCAST_LIMIT, START_BYTES = 128 * 1024 * 1024, 1024
START, VALUE, COMMA, COLON = "start", "value", "comma", "colon"
#: Stands for the name before a range's first container, which an earlier range may hold.
EARLIER = "?"


def tokens(line: str) -> Iterator[tuple[str, int, int]]:
    for match in TOKEN.finditer(line):
        token = match[0]
        if token == '"':
            raise ValueError("The document is malformed: a text does not end on its line")
        yield token, match.start(), match.end()


def is_data(container: list) -> bool:
    kind, name = container
    if kind != "[" or name is None:
        return False
    return name == '"data"' or ("\\" in name and json.loads(name) == "data")


@dataclass
class State:
    """Open containers from the root, each with the name of the member it is the value of, and what came last."""

    open: list[list] = field(default_factory=list)
    last: str = START
    word: str | None = None  # the last text, which a colon makes a name
    done: bool = False  # the document is complete
    began: int = -1  # the range in which the open row began

    @property
    def in_data(self) -> bool:
        return len(self.open) >= 2 and is_data(self.open[1])

    @property
    def in_row(self) -> bool:
        return self.in_data and len(self.open) > 2


@dataclass
class Summary:
    """What a range does to any start: containers it closes that it did not open, and those it leaves open."""

    closes: str = ""
    opens: list[list] = field(default_factory=list)
    whole: bool = False  # it opens and closes a container beside those it starts in
    last: str | None = None  # nothing but white space
    word: str | None = None

    def scan(self, line: str) -> None:
        if row := FLAT_ROW.match(line):
            self.whole = self.whole or not self.opens
            self.last, self.word = COMMA if row[3] else VALUE, None
            return
        for token, _, _ in tokens(line):
            if token in "[{":
                name = None
                if self.last is None or (self.last == COLON and self.word == EARLIER):
                    name = EARLIER
                elif self.last == COLON:
                    name = self.word
                self.opens.append([token, name])
                self.last, self.word = START, None
            elif token in "]}":
                if not self.opens:
                    self.closes += token
                elif self.opens.pop()[0] != CLOSES[token]:
                    raise ValueError("The document is malformed: brackets do not match")
                else:
                    self.whole = self.whole or not self.opens
                self.last, self.word = VALUE, None
            elif token == ",":
                self.last, self.word = COMMA, None
            elif token == ":":
                self.word = self.word if self.last else EARLIER
                self.last = COLON
            else:
                self.last, self.word = VALUE, token if token[0] == '"' else None

    def after(self, state: State, block: int) -> State:
        """The state at the end of a range that starts in ``state``."""
        if self.last is None:
            return state
        stack, done = list(state.open), state.done
        for token in self.closes:
            if not stack or stack.pop()[0] != CLOSES[token]:
                raise ValueError("The document is malformed: brackets do not match")
        kept = len(stack)
        done = done or (not stack and (bool(state.open) or self.whole))
        opens = [[kind, state.word if name == EARLIER else name] for kind, name in self.opens]
        word = state.word if self.word == EARLIER else self.word
        out = State(stack + opens, self.last, word, done)
        if out.in_row:
            out.began = state.began if kept > 2 and state.in_row else block
        return out


ROWS, PIECE, REST, DATA = "rows", "piece", "rest", "data"


class Reader:
    """The content of a range, given the state it starts in: ``kind, began, text`` for each part."""

    def __init__(self, state: State, block: int):
        self.state, self.block = state, block
        self.element: list[str] = []  # lines of a row that is still open
        self.rest: list[str] = []

    def line(self, line: str) -> Iterator[tuple[str, int, str]]:
        state = self.state
        if state.in_data and len(state.open) == 2 and (row := FLAT_ROW.match(line)):
            if row[1]:
                self.comma()
            self.value()
            if row[3]:
                self.comma()
            yield ROWS, 0, row[2]
            return
        rows, at = [], 0  # where the open row, or the text outside data, goes on
        for token, start, end in tokens(line):
            if state.done or not (state.open or token == "{"):
                raise ValueError("The document is malformed: a file holds one document and nothing else")
            outside = len(state.open) < 2 or not state.in_data
            at_rows = not outside and len(state.open) == 2
            if at_rows and token == ",":
                self.comma()
            elif at_rows and token == "]":
                if state.last == COMMA:
                    raise ValueError("The document is malformed: data ends in a comma")
                self.close(token)
                at = start
            elif at_rows:  # a row, or a value that is none and does not parse as one
                self.value()
                if token in "[{":
                    state.open.append([token, None])
                    state.began, at = self.block, start
                elif token in "}:":
                    raise ValueError("The document is malformed: data holds more than rows")
                else:
                    rows.append(token)
            elif token in "[{":
                state.open.append([token, state.word if state.last == COLON else None])
                state.last, state.word = START, None
                if outside and state.in_data and len(state.open) == 2:
                    self.rest.append(line[at:end])
                    yield DATA, 0, ""
            elif token in "]}":
                self.close(token)
                if state.in_data and len(state.open) == 2:
                    element = "\n".join([*self.element, line[at:end]])
                    if state.began == self.block:
                        rows.append(element)
                    else:
                        yield PIECE, state.began, element
                    self.element, state.last = [], VALUE
            elif token == ",":
                state.last, state.word = COMMA, None
            elif token == ":":
                state.last = COLON
            else:
                state.last, state.word = VALUE, token if token[0] == '"' else None
        if rows:
            yield ROWS, 0, ",".join(rows)
        if state.in_row:
            self.element.append(line[at:])
        elif not state.in_data:
            self.rest.append(line[at:])

    def comma(self) -> None:
        if self.state.last != VALUE:
            raise ValueError("The document is malformed: data holds a comma too many")
        self.state.last, self.state.word = COMMA, None

    def value(self) -> None:
        if self.state.last == VALUE:
            raise ValueError("The document is malformed: a comma is missing in data")
        self.state.last, self.state.word = VALUE, None

    def close(self, token: str) -> None:
        state = self.state
        if not state.open or state.open.pop()[0] != CLOSES[token]:
            raise ValueError("The document is malformed: brackets do not match")
        state.last, state.word, state.done = VALUE, None, not state.open

    def end(self) -> Iterator[tuple[str, int, str]]:
        if self.state.in_row:
            yield PIECE, self.state.began, "\n".join(self.element) + "\n"
        if any(part.strip() for part in self.rest):
            yield REST, 0, "\n".join(self.rest) + "\n"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    place = [F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block")]
    return spark.read.text(path).select(*place, "value")


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Rows by range, as far as a batch holds them; ranges come one after the other."""
    for batch in batches:
        files, blocks = batch.column("source_file").dictionary_encode().indices.to_numpy(), batch.column("block").to_numpy()
        cuts = ((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])).nonzero()[0] + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if low < high:
                yield (batch.column("source_file")[low].as_py(), int(blocks[low])), batch.slice(low, high - low)


def summaries(spark: SparkSession, path: str) -> DataFrame:
    """``source_file, block, summary`` of each range of lines."""
    names = ["source_file", "block", "summary"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, summary = None, Summary()
        for here, rows in _ranges(batches):
            if here != where:
                if where:
                    yield record(where, summary)
                where, summary = here, Summary()
            for line in rows.column("value").to_pylist():
                summary.scan(line)
        if where:
            yield record(where, summary)

    def record(where: tuple, summary: Summary) -> pa.RecordBatch:
        columns = [pa.array([where[0]]), pa.array([where[1]], pa.int64()), pa.array([json.dumps(asdict(summary))])]
        return pa.RecordBatch.from_arrays(columns, names)

    return _lines(spark, path).mapInArrow(scan, "source_file string, block bigint, summary string")


def compose(ranges: DataFrame) -> DataFrame:
    """``source_file, block, state, outside``: the start of each range, and whether text outside ``data`` may lie in it.

    A file's summaries, a short record for each range, are composed in order. A file that ends before its
    document does raises an error.
    """
    names = ["source_file", "block", "state", "outside"]

    def fold(table: pa.Table) -> pa.Table:
        state, out = State(), []
        for row in table.sort_by("block").to_pylist():
            summary = Summary(**json.loads(row["summary"]))
            end = summary.after(state, row["block"])
            # Rows stay open or begin: nothing was closed but rows, and nothing opened but in data.
            inside = state.in_data and end.in_data and len(state.open) - len(summary.closes) >= 2
            out.append((row["source_file"], row["block"], json.dumps(asdict(state)), not inside))
            state = end
        if state.open or (not state.done and state.last != START):
            raise ValueError(f"The document is malformed: {out[-1][0]} ends before its document does")
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.string(), pa.bool_()))], names=names)

    schema = "source_file string, block bigint, state string, outside boolean"
    return ranges.groupBy("source_file").applyInArrow(fold, schema)


def parts(lines: DataFrame, starts: DataFrame, broadcast: bool) -> DataFrame:
    """``source_file, block, at, kind, began, text``: the content of each range that is in ``starts``.

    A broadcast of the starts keeps the lines where they are. Without it, ranges are shuffled and each meets
    its start, which comes first.
    """
    names = ["source_file", "block", "at", "kind", "began", "text"]
    key = ["source_file", "block"]
    starts = starts.select(*key, "state")
    if broadcast:
        fed = lines.join(F.broadcast(starts), key).select(*key, "state", "value")
    else:
        first = starts.select(*key, F.lit(-1).cast("bigint").alias("nth"), "state", F.lit(None).cast("string").alias("value"))
        rest = lines.join(starts.select(*key), key, "left_semi").select(
            *key, F.monotonically_increasing_id().alias("nth"), F.lit(None).cast("string").alias("state"), "value"
        )
        fed = first.union(rest).repartition(*key).sortWithinPartitions(*key, "nth").drop("nth")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, reader, at = None, None, 0
        for here, rows in _ranges(batches):
            found = []
            if here != where:
                if reader:
                    yield from batch(where, at, list(reader.end()))
                where, reader, at = here, Reader(State(**json.loads(rows.column("state")[0].as_py())), here[1]), 0
            for line in rows.column("value").to_pylist():
                if line is not None:
                    found += reader.line(line)
            yield from batch(where, at, found)
            at += len(found)
        if reader:
            yield from batch(where, at, list(reader.end()))

    def batch(where: tuple, at: int, found: list[tuple[str, int, str]]) -> Iterator[pa.RecordBatch]:
        n = len(found)
        if n:
            kinds, began, texts = zip(*found)
            columns = [[where[0]] * n, [where[1]] * n, list(range(at, at + n)), kinds, began, texts]
            types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return fed.mapInArrow(read, "source_file string, block bigint, at bigint, kind string, began bigint, text string")


def _in_order() -> Column:
    """The texts of a group in their order in the file."""
    order = F.array_sort(F.collect_list(F.struct("block", "at", "text")))
    return F.array_join(F.transform(order, lambda p: p["text"]), "")


def _records(texts: DataFrame, text: Column) -> DataFrame:
    rows = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<array<string>>", {"mode": "FAILFAST"})
    # The outer generator implies no filter on the rows, which would parse each text again.
    each = texts.select("source_file", F.posexplode_outer(rows).alias("nth", "record"))
    return each.filter(F.col("nth").isNotNull()).select("source_file", "record")


def read_ranges(
    spark: SparkSession, path: str, broadcast_limit: int = BROADCAST_LIMIT, folder: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Documents (``meta, data, source_file``, with ``data`` empty) and their rows (``source_file, record``).

    The same as ``read_envelopes`` gives, errors included, for files of any size whose lines are under 2 GB; so
    must each row be, and what lies outside ``data``. A second document in a file, other text after it, a value
    in ``data`` that is no row, and brackets or commas that do not fit raise an error when rows or documents are
    read; so does a document with two ``data`` arrays. Files of white space hold no document.

    The summaries are made when this is called, and written to ``folder``, by default one of those that the
    executors share; it must stay until documents and rows are read.
    """
    folder = folder or shared_folder(spark, "ranges")
    compose(summaries(spark, path)).write.parquet(folder)
    starts = spark.read.schema("source_file string, block bigint, state string, outside boolean").parquet(folder)
    broadcast = starts.count() * START_BYTES <= broadcast_limit
    lines = _lines(spark, path)

    outside = parts(lines, starts.filter("outside"), broadcast).filter(F.col("kind").isin(REST, DATA))
    texts = outside.groupBy("source_file").agg(_in_order().alias("value"), F.count_if(F.col("kind") == DATA).alias("arrays"))
    twice = F.raise_error(F.lit("The document is malformed: it holds data twice")).cast("string")
    texts = texts.select("source_file", F.when(F.col("arrays") > 1, twice).otherwise(F.col("value")).alias("value"))
    docs = documents_of_texts(texts, F.col("source_file"), ENVELOPE_SCHEMA, "FAILFAST")

    content = parts(lines, starts, broadcast)
    whole = _records(content.filter(F.col("kind") == ROWS), F.col("text"))
    pieces = content.filter(F.col("kind") == PIECE).groupBy("source_file", "began").agg(_in_order().alias("value"))
    return docs, whole.unionByName(_records(pieces, F.col("value")))
