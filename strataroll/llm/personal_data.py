"""Personal data: patterns, and boosted trees over candidates from generous generators.

1. One pass over the texts finds the spans of the patterns, and candidates of every kind, overlapping.
2. Trees learn from a bounded sample which candidates the patterns confirm, from the format of the
   candidate and the words around it. What the patterns check beyond form (check digits, ranges) is no feature, so
   that a number in the place of a card number scores like one.
3. On all candidates not learned from, a threshold for each kind is the lowest score from which a set part is confirmed.
4. Candidates above it that no pattern's span touches are added, the best first.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataroll.llm.common import saved, text_or_empty, texts_of

KINDS = ("email", "ip", "card", "phone")
# The patterns asked for, in forms that take linear time.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
PARTS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Candidates: numbers of seven digits or more in any grouping, dotted numbers, and what is around an
#: at sign, written out or not.
NUMBER = re.compile(r"[+(]?[0-9](?:[\x20().-]{0,3}[0-9])+")
SPELLED = re.compile(r"[A-Za-z0-9._-]{1,64}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,64}(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]{1,64})+")
CONTEXT = 40
#: Words that tell what a number is, by kind.
CUES = (
    ("mail", "contact", "write"),
    ("ip", "host", "server", "address"),
    ("card", "visa", "credit", "paid", "payment"),
    ("phone", "call", "tel", "fax", "mobile"),
)
#: Candidates to learn from, about; half of all, if those are fewer.
SAMPLE = 20_000
#: Part of the candidates from the threshold up that the patterns must confirm.
CONFIRMED = 0.95
TREES, DEPTH, SEED = 8, 3, 5

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at sign to the left as far as the class goes, and a domain to the right."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1)
        if start < at and domain:
            last = domain.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def dotted(text: str) -> Iterator[tuple[int, int, bool]]:
    """Runs of dotted numbers by four parts, and whether each part is at most 255."""
    for m in PARTS.finditer(text):
        if m[0].count(".") < 3:
            continue
        parts, at = m[0].split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            size = sum(map(len, four)) + 3
            yield at, at + size, all(len(d := p.lstrip("0")) <= 3 and int(d or 0) <= 255 for p in four)
            at += size + 1


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, by kind and start."""
    found = [(0, a, b) for a, b in emails(text)]
    found += [(1, a, b) for a, b, fine in dotted(text) if fine]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            found.append((2, *m.span()))
    if "+" in text:
        found += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return found


def candidates(text: str) -> Iterator[Span]:
    for a, b in emails(text):
        yield 0, a, b
    if "at" in text and ("(" in text or "[" in text):
        for m in SPELLED.finditer(text):
            yield 0, *m.span()
    for a, b, _ in dotted(text):
        yield 1, a, b
    for m in NUMBER.finditer(text):
        if m.end() - m.start() < 7:
            continue
        n = len(digits_of(m[0]))
        if 12 <= n <= 20:
            yield 2, m.start() + (m[0][0] in "+("), m.end()
        if 7 <= n <= 16:
            yield 3, *m.span()


def features(text: str, span: Span) -> list[float]:
    """Form and surroundings of a candidate, in numbers."""
    kind, start, end = span
    inner, before = text[start:end], text[max(0, start - CONTEXT) : start].lower()
    groups = [len(g) for g in re.findall(r"[0-9]+", inner)] or [0]
    n = len(inner)
    after, ahead = text[end : end + 1], before[-1:]
    return [
        *(float(kind == k) for k in range(len(KINDS))), float(n), float(sum(groups)), sum(groups) / n,
        float(len(groups)), float(max(groups)), float(min(groups)), float(groups[0]), float(groups[-1]),
        float(inner.count(" ")), float(inner.count("-")), float(inner.count(".")), float(inner.count("@")),
        float(inner[0] == "+"), float("(" in inner), float(ahead.isalnum()), float(after.isalnum()),
        float(ahead in ".,-/:#=$"), *(float(any(w in before for w in cue)) for cue in CUES),
    ]


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
_CANDIDATE = pa.struct(
    [*_SPAN, pa.field("label", pa.float64()), pa.field("features", pa.list_(pa.float32()))]
)
FOUND = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("base", pa.list_(_SPAN)), ("candidates", pa.list_(_CANDIDATE))])
FOUND_SQL = (
    "doc_id bigint, row bigint, base array<struct<kind: int, start: int, end: int>>, candidates"
    " array<struct<kind: int, start: int, end: int, label: double, features: array<float>>>"
)


def find_candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, proposed = [], []
            for text in texts_of(batch, "text"):
                spans = base_spans(text)
                known = set(spans)
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                proposed.append(
                    [
                        {"kind": s[0], "start": s[1], "end": s[2], "label": float(s in known), "features": features(text, s)}
                        for s in dict.fromkeys(candidates(text))
                    ]
                )
            columns = [batch.column("doc_id"), batch.column("row"), pa.array(base, FOUND.field("base").type)]
            columns.append(pa.array(proposed, FOUND.field("candidates").type))
            yield pa.RecordBatch.from_arrays(columns, schema=FOUND)

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        text_or_empty(text_col).alias("text"),
    )
    return saved(rows.mapInArrow(run, FOUND_SQL), "personal-data")


def thresholds(scored: DataFrame) -> dict[int, float]:
    """By kind the lowest score, in hundredths, from which at least CONFIRMED of the candidates are confirmed."""
    bins = scored.groupBy("kind", F.floor(F.col("score") * 100).cast("int").alias("bin"))
    counted = bins.agg(F.sum("label").alias("yes"), F.count("*").alias("n")).collect()
    out = {}
    for kind in {r["kind"] for r in counted}:
        yes = n = 0
        for r in sorted((r for r in counted if r["kind"] == kind), key=lambda r: -r["bin"]):
            yes, n = yes + r["yes"], n + r["n"]
            if yes >= CONFIRMED * n:
                out[kind] = r["bin"] / 100
    return out


def chosen_candidates(found: DataFrame) -> DataFrame | None:
    """``row, kind, start, end, score`` of candidates above the threshold; None if there is nothing to learn."""
    each = found.select("row", F.explode("candidates").alias("c")).select("row", "c.*")
    total = each.count()
    if not total:
        return None
    part = F.pmod(F.xxhash64("row", "start", "end", "kind", F.lit(SEED)), F.lit(1_000_000)) / 1_000_000
    share = min(0.5, SAMPLE / total)
    vector = array_to_vector(F.col("features").cast("array<double>"))
    sample = saved(each.filter(part < share), "personal-sample")
    train = sample.select("label", vector.alias("vector")).coalesce(4).cache()
    try:
        if train.select("label").distinct().count() < 2:
            return None
        trees = GBTClassifier(labelCol="label", featuresCol="vector", maxIter=TREES, maxDepth=DEPTH, maxBins=16, seed=SEED)
        model = trees.fit(train)
    finally:
        train.unpersist()

    with_scores = model.transform(each.withColumn("learned", part < share).withColumn("vector", vector))
    score = vector_to_array("probability")[1].alias("score")
    scored = saved(with_scores.select("row", "kind", "start", "end", "label", "learned", score), "personal-scores")
    least = thresholds(scored.filter("NOT learned"))
    if not least:
        return None
    above = F.lit(False)
    for kind, score in sorted(least.items()):
        above = above | ((F.col("kind") == kind) & (F.col("score") >= score))
    return scored.filter("label = 0").filter(above).select("row", "kind", "start", "end", "score")


def added(base: list[Span], more: list[tuple[int, int, int, float]]) -> list[Span]:
    """Base spans, and of the others, best first, those that touch none taken before."""
    taken = list(base)
    for kind, start, end, _ in sorted(more, key=lambda s: (-s[3], s[1], s[0])):
        if all(end <= a or b <= start for _, a, b in taken):
            taken.append((kind, start, end))
    return taken


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added`` for each row of ``docs``.

    Null texts count as empty: no spans, the digest of the empty string. Null ids stay null; repeated
    rows are searched each; an empty table gives no rows; further columns are ignored. Texts of any
    length are searched whole in linear time. With no candidates, or none of either class in the
    sample, nothing is added to the patterns' spans.
    """
    found = find_candidates(docs, id_col, text_col)
    more = chosen_candidates(found)
    rows = found.select("doc_id", "row", "base")
    if more is None:
        joined = rows.withColumn("more", F.array().cast("array<struct<kind: int, start: int, end: int, score: double>>"))
    else:
        listed = more.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end", "score")).alias("more"))
        joined = rows.join(listed, "row", "left").select("doc_id", "row", "base", "more")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans, extra = [[] for _ in KINDS], [], [], []
            for base, more_ in zip(batch.column("base"), batch.column("more"), strict=True):
                own = [(s["kind"], s["start"], s["end"]) for s in base.as_py() or []]
                every = added(own, [(s["kind"], s["start"], s["end"], s["score"]) for s in more_.as_py() or []])
                for kind, column in enumerate(counts):
                    column.append(sum(s[0] == kind for s in own))
                digests.append(hashlib.sha256(written(own).encode()).hexdigest())
                spans.append(written(every))
                extra.append(len(every) - len(own))
            columns = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, pa.string()), pa.array(extra, pa.int64())], names)

    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return joined.mapInArrow(run, f"doc_id bigint, {counts}, base_sha256 string, spans string, n_added bigint")
