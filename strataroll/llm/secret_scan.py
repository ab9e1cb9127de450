"""Secret scan: patterns, and sliding-window Shannon entropy with an allow list."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataroll.llm.common import by_batch, text_or_empty, texts_of

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "entropy")
# The patterns asked for. Lengths of runs are in the pattern where that finds the same.
ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_VALUE = 8

#: Candidate strings for the entropy: long runs of characters that keys are written in.
WINDOW = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Bits a character that a window of a class must reach. Random text of 20 characters has
#: about 3.4 in hexadecimal and 4.1 in base 64; words have less than 3.5.
LEAST_BITS = {"hex": 3.1, "alphanumeric": 3.75, "base64": 3.75}
# Allow list: what looks random and is not secret. Only the part of a candidate that has such a form is left out.
ALLOWED_PART = re.compile(
    r"(?<![0-9A-Za-z])(?:"
    r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"  # identifiers
    r"|sha256-[A-Za-z0-9+/]{43}=?|sha384-[A-Za-z0-9+/]{64}|sha512-[A-Za-z0-9+/]{86}(?:==)?"  # checksums of scripts
    r")(?![0-9A-Za-z])"
    r"|(?i:[0-9A-Za-z]*(?:example|sample|dummy|placeholder|changeme|redacted|xxxx)[0-9A-Za-z]*)"
)
ALLOWED = (
    re.compile(r"[A-Za-z]+(?:[-_/=+][A-Za-z]*)*$"),  # words and paths without a digit
    re.compile(r"[-+=/_0-9]+$"),  # numbers and rules
)
N_LOG_N = [0.0, *(n * log2(n) for n in range(1, WINDOW + 1))]


def character_class(candidate: str) -> str:
    if not candidate.strip("0123456789abcdefABCDEF"):
        return "hex"
    return "alphanumeric" if candidate.isalnum() else "base64"


def entropy_spans(candidate: str) -> Iterator[tuple[int, int]]:
    """Maximal spans whose every character lies in a window of high entropy.

    The entropy of a window is log2 W - (sum of n log2 n) / W over its character counts n; sliding
    by one character changes two counts and their two terms.
    """
    least = LEAST_BITS[character_class(candidate)]
    most = WINDOW * (log2(WINDOW) - least)  # of the sum, for windows that reach it
    counts: dict[str, int] = {}
    total, first, last = 0.0, -1, -1
    for i, c in enumerate(candidate):
        n = counts[c] = counts.get(c, 0) + 1
        total += N_LOG_N[n] - N_LOG_N[n - 1]
        start = i - WINDOW + 1
        if start < 0:
            continue
        if total <= most + 1e-9:
            if first >= 0 and start > last:
                yield first, last
                first = -1
            first, last = (start if first < 0 else first), i + 1
        gone = candidate[start]
        n = counts[gone] = counts[gone] - 1
        total += N_LOG_N[n] - N_LOG_N[n + 1]
    if first >= 0:
        yield first, last


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, end, kind`` of the patterns, leftmost without overlap within a kind."""
    found = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        for m in ASSIGN.finditer(text):
            if len(m[1]) >= ASSIGN_VALUE:
                found.append((m.start(), m.end(), 0))
    if "AKIA" in text:
        found += [(*m.span(), 1) for m in ACCESS.finditer(text)]
    found += [(*m.span(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], s[2]))


def added_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of high entropy that no allowed form explains and no base span holds."""
    found = []
    for start, candidate in (piece for m in CANDIDATE.finditer(text) for piece in unexplained(m)):
        if any(form.match(candidate) for form in ALLOWED):
            continue
        for a, b in entropy_spans(candidate):
            a, b = a + start, b + start
            if not any(s <= a and b <= e for s, e, _ in base):
                found.append((a, b, 3))
    return found


def unexplained(candidate: re.Match) -> Iterator[tuple[int, str]]:
    """What is left of a candidate between its allowed parts, with its place, if a window fits in."""
    text, at = candidate[0], 0
    for part in [*ALLOWED_PART.finditer(text), None]:
        end = part.start() if part else len(text)
        if end - at >= WINDOW:
            yield candidate.start() + at, text[at:end]
        at = part.end() if part else end


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy`` for each row; no shuffle.

    Null texts count as empty: no spans, the digest of the empty string. Null ids stay null,
    repeated rows are scanned each, an empty table gives no rows, further columns are ignored.
    Texts are scanned whole in linear time.
    """

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, digests, spans = [[] for _ in KINDS], [], []
        for text in texts_of(batch, "text"):
            base = base_spans(text)
            every = sorted(base + added_spans(text, base), key=lambda s: (s[0], s[2]))
            for kind, column in enumerate(n):
                column.append(sum(s[2] == kind for s in every))
            digests.append(hashlib.sha256(written(base).encode()).hexdigest())
            spans.append(written(every))
        numbers = [pa.array(column, pa.int64()) for column in n]
        columns = [batch.column("doc_id"), *numbers[:3], pa.array(digests, pa.string())]
        columns += [pa.array(spans, pa.string()), numbers[3]]
        return pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_entropy"]
    schema = (
        "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string,"
        " spans string, n_entropy bigint"
    )
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return by_batch(rows, step, schema)


def redact_text(text: str) -> str:
    """The text with each span, merged where they overlap, replaced by ``[SECRET]``."""
    base = base_spans(text)
    spans = sorted(base + added_spans(text, base))
    parts, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            parts += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join(parts) + text[at:] if spans else text


def redact_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with secrets redacted in its text, and ``n_chars``, if there, counted again.

    Every row and column stays; null texts stay null.
    """
    at = docs.columns.index(text_col)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [None if t is None else redact_text(t) for t in texts_of(batch, text_col)]
        columns = list(batch.columns)
        columns[at] = pa.array(texts, batch.schema.field(at).type)
        return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    redacted = docs.mapInArrow(lambda batches: map(step, batches), docs.schema)
    if "n_chars" in docs.columns:
        length = F.length(text_col).cast(docs.schema["n_chars"].dataType)
        redacted = redacted.withColumn("n_chars", length)
    return redacted
