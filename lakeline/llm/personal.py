"""Personal data: strict patterns, and more spans chosen by gradient-boosted trees.

Generators of high recall propose spans, which may overlap: anything around an ``@`` or its spelled-out
forms, runs of digits and separators, and long mixed strings. Format and context of a span are
the features of boosted trees. They learn from documents by weak labels, the strict patterns and their
checks for the first two kinds and an assignment (``token = ``, ``password=``) for the third, and on
held-out spans each kind gets the lowest threshold with ``PRECISION``. A kind without one adds nothing.
Spans found by the strict patterns always stay; a proposal that overlaps one is not added.

Null and empty texts have no spans. Places are code points, ends exclusive. The spans of all documents are learned
from: two thirds of them, by hash, by the trees, the others by the thresholds.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lakeline.llm.boosting import Boosted, binned, fit_table, lowest_levels, quantile_cuts
from lakeline.session import stored
from lakeline.sources.files import table

PRECISION = 0.98
LEAST_HELD_OUT = 20
KINDS = ["email", "ip", "card", "phone"]
PROPOSED = ["address", "number", "secret"]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a digit run that fails from its first digit on fails from the others too
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_WORTH = re.compile(r"[0-9@]")
_PROPOSALS = {
    "address": re.compile(r"[^\s@<>()\[\],;:\"']{1,64}(?:@|\s?[\[(](?:at|AT)[\])]\s?)[^\s@<>()\[\],;:\"']{3,253}"),
    "number": re.compile(r"\+?\(?[0-9][0-9 ().:/-]{6,30}[0-9]"),
    "secret": re.compile(r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*[0-9])[A-Za-z0-9_+/-]{12,512}(?![A-Za-z0-9_+/-])"),
}
_ASSIGNED = re.compile(r"(?:token|password|passwd|pwd|secret|api[_-]?key|key)\s{0,2}[=:]\s{0,2}[\"']?$", re.I)
_HINTS = [re.compile(hint, re.I) for hint in (
    r"mail|contact|write", r"phone|call|tel|fax|mobil", r"card|visa|credit|pay", r"\bip\b|host|server|addr",
    r"token|pass|secret|key|auth", r"id\b|number|no\.|nr\.")]


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _emails(text: str) -> Iterator[Span]:
    """Around each @: the longest run to its left that no earlier match has taken, and a domain."""
    taken, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > taken and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield Span("email", start, found.end())
            taken = found.end()
        at = text.find("@", max(at + 1, taken))


def strict(text: str) -> list[Span]:
    """Base spans by start, then kind."""
    if not _WORTH.search(text):
        return []
    found = list(_emails(text))
    for match in _IP.finditer(text):
        if all(map(_byte, match.group().split("."))):
            found.append(Span("ip", *match.span()))
    for match in _CARD.finditer(text):
        digits = match.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            found.append(Span("card", *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.findall(match.group())) <= 15:
                found.append(Span("phone", *match.span()))
    return sorted(found, key=lambda span: (span.start, KINDS.index(span.kind)))


def proposals(text: str) -> list[Span]:
    """Candidate spans of every generator; they may overlap."""
    if not _WORTH.search(text):
        return []
    return [Span(kind, *match.span()) for kind, pattern in _PROPOSALS.items() for match in pattern.finditer(text)]


def features(text: str, span: Span) -> list[float]:
    """Format of the span, then its context."""
    part = text[span.start:span.end]
    before, after = text[max(0, span.start - 24):span.start], text[span.end:span.end + 12]
    digits = "".join(filter(str.isdigit, part))
    groups = re.findall(r"[0-9]+", part)
    counts = Counter(part)
    entropy = -sum(n / len(part) * math.log2(n / len(part)) for n in counts.values())
    letters = sum(map(str.isalpha, part))
    return [
        PROPOSED.index(span.kind), len(part), len(digits), letters, entropy, len(groups),
        max(map(len, groups), default=0), min(map(len, groups), default=0),
        float(max((int(group[:9]) for group in groups), default=0)),
        part.count("."), part.count("-"), part.count(" "), part.count("("), part.count("@"), part.count(":"),
        part.startswith("+"), part[-1:].isalnum(), sum(c in "0123456789abcdefABCDEF" for c in part) / len(part),
        sum(a.isdigit() != b.isdigit() for a, b in zip(part, part[1:])), sum(map(str.isupper, part)) / max(1, letters),
        _luhn(digits[:32]) if digits.isascii() and digits else False, part.rpartition(".")[2].isalpha(),
        before[-1:].isspace(), before[-1:] in "\"'", before.rstrip(" \"'")[-1:] in "=:", after[:1].isspace(),
        after[:1] in "\"'", bool(_ASSIGNED.search(before)), *[bool(hint.search(before)) for hint in _HINTS],
    ]


def _weak_label(text: str, span: Span, base: list[Span]) -> bool:
    if span.kind == "secret":
        return bool(_ASSIGNED.search(text[max(0, span.start - 24):span.start]))
    return any(abs(one.start - span.start) <= 1 and abs(one.end - span.end) <= 1 for one in base)


class Model(NamedTuple):
    trees: Boosted
    limits: dict[str, float]


_LEARNING = pa.schema([
    ("held", pa.bool_()), ("truth", pa.bool_()), ("kind", pa.int32()), ("values", pa.list_(pa.float64()))])


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            base = strict(text)
            for span in proposals(text):
                mark = hashlib.blake2b(f"{doc_id} {span}".encode(), digest_size=7).digest()
                rows.append({"held": int.from_bytes(mark, "little") % 3 == 0, "truth": _weak_label(text, span, base),
                             "kind": PROPOSED.index(span.kind), "values": list(map(float, features(text, span)))})
            if len(rows) >= 1000:
                yield pa.RecordBatch.from_pylist(rows, schema=_LEARNING)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_LEARNING)


def learn(docs: DataFrame) -> Model | None:
    """Trees and thresholds from all spans of ``docs (doc_id, text)``; None if there is nothing to tell apart."""
    texts = docs.selectExpr("CAST(doc_id AS bigint) AS doc_id", "CAST(text AS string) AS text")
    rows = stored(texts.where(F.col("text").rlike("[0-9@]")).mapInArrow(
        _examples, "held boolean, truth boolean, kind int, values array<double>"), "span-examples")
    size = rows.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("values")).alias("width"),
        F.sum((~F.col("held") & F.col("truth")).cast("bigint")).alias("hits"),
        F.sum((~F.col("held") & ~F.col("truth")).cast("bigint")).alias("others")).first()
    if size.n < 3 * LEAST_HELD_OUT or not size.hits or not size.others:
        return None
    cuts = quantile_cuts(rows.where("NOT held"), size.width)
    different = stored(binned(rows, cuts), "binned-spans")
    trees, chances = fit_table(different.where("NOT held"), cuts)
    least = lowest_levels(different.where("held"), chances, size.width, PRECISION, LEAST_HELD_OUT)
    return Model(trees, {kind: least.get(number, math.inf) for number, kind in enumerate(PROPOSED)})


def spans_of(texts: list[str], model: Model | None) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and added spans of each text."""
    found = [(strict(text), proposals(text) if model else []) for text in texts]
    rows = [features(text, span) for text, (_, more) in zip(texts, found) for span in more]
    scores = iter(model.trees.score(np.array(rows, float)).tolist() if rows else [])
    result = []
    for base, more in found:
        scored = [(next(scores), span) for span in more]
        added: list[Span] = []
        taken = list(base)
        for score, span in sorted(scored, key=lambda pair: (-pair[0], pair[1])):
            clear = all(span.end <= one.start or one.end <= span.start for one in taken)
            if score >= model.limits[span.kind] and clear:
                added.append(span)
                taken.append(span)
        result.append((base, added))
    return result


def listed(spans: list[Span]) -> str:
    order = KINDS + PROPOSED
    spans = sorted(spans, key=lambda span: (span.start, order.index(span.kind), span.end))
    return ",".join(f"{span.kind}:{span.start}:{span.end}" for span in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each run of overlapping spans replaced by the first one's kind."""
    pieces, at = [], 0
    for span in sorted(spans, key=lambda span: (span.start, -span.end)):
        if span.start >= at:
            pieces += [text[at:span.start], f"<{span.kind}>"]
        at = max(at, span.end)
    return "".join(pieces) + text[at:]


_FOUND = StructType([StructField(f"n_{kind}", LongType()) for kind in KINDS] + [
    StructField("base_sha256", StringType()), StructField("spans", StringType()),
    StructField("redacted", StringType())])


def finder(model: Model | None, rewrite: bool):
    """A pandas function from text to a struct of counts, digests, spans and the redacted text."""
    @F.pandas_udf(_FOUND)
    def find(texts: pd.Series) -> pd.DataFrame:
        plain = [text or "" for text in texts]
        rows = []
        for original, text, (base, added) in zip(texts, plain, spans_of(plain, model)):
            kinds = Counter(span.kind for span in base)
            rows.append((
                *[kinds[kind] for kind in KINDS], hashlib.sha256(listed(base).encode()).hexdigest(),
                listed(base + added), None if original is None or not rewrite else redacted(text, base + added)))
        return pd.DataFrame(rows, columns=_FOUND.names)

    return find


def find(docs: DataFrame, model: Model | None) -> DataFrame:
    """Spans of each row of ``docs (doc_id, text)``: ``doc_id``, counts, digest and list."""
    found = docs.select("doc_id", finder(model, False)(F.col("text").cast("string")).alias("found"))
    return found.select("doc_id", "found.*").drop("redacted")


def redact(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with the spans of ``text`` replaced by their kind; a null text stays null."""
    return docs.withColumn("text", finder(model, True)(F.col("text").cast("string"))["redacted"])


def op8_personal(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document."""
    docs = table(spark, folder, "documents", "doc_id", "text")
    return find(docs, learn(docs))
