"""Personal data: generators propose spans, boosted trees score them, a calibrated threshold selects.

Generators with high recall propose spans that may overlap: the strict patterns (the base, always
kept) and loose ones for anything around an at sign, addresses written with "at" and "dot", and any
number of five digits or more, as each kind that it could be. Boosted trees see a span's format and
what stands around it. Base spans in disguise (without the plus, with the at sign spelled out, with
other separators), each where it stood, are the examples of personal data; free proposals whose format
does not agree with a kind are the others, and those that agree are not learned from, as they may be
either. Addresses of hosts have no disguise, so none are added. A quarter of the examples sets the threshold, the smallest at which the trees are right often enough; spans beyond the
base that reach it are added. Trees are fitted by Spark on the other three quarters, whatever their number; all spans of all documents are scored.

Defined results: a null text is an empty one and has no spans; offsets are code points, ends
exclusive; without enough spans of both kinds to learn from, or if no threshold is good enough, no
span is added; repeated rows get their spans each; an empty table gives no rows; texts of any length
are read whole, and all patterns take linear time; other columns are neither read nor returned.
"""

from __future__ import annotations

import bisect
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm import worker
from textloom.plans.session import staged

KINDS = ("email", "ip", "card", "phone")
#: Spans of either label that the trees need, share of right ones that a threshold has to reach on the
#: calibration part, and code points of context.
LEAST_SPANS, PRECISION, CONTEXT = 20, 0.98, 24
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NUMBER = re.compile(r"[+(]?[0-9](?:[ ()./-]{0,2}[0-9])+")
_ADDRESS = re.compile(r"[^\s@]{1,64}@[^\s@]{1,255}")
_SPELLED = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[\[(] ?dot ?[\])]) ?[A-Za-z0-9-]{1,63}){1,8}")
_CUES = {
    "email": re.compile(r"mail|contact|write|address", re.I), "ip": re.compile(r"\bip\b|host|server|login", re.I),
    "card": re.compile(r"card|visa|pay|credit", re.I), "phone": re.compile(r"tel|phone|call|fax|mobile", re.I),
    "none": re.compile(r"order|invoice|version|isbn|token|key|id\b|no\.", re.I),
}
# Proposals of this format may be personal data.
_AGREES = {
    0: re.compile(r".*[^A-Za-z][A-Za-z]{2,}", re.S),
    3: re.compile(r"\+?(?:[0-9]{1,3}[ .-])?(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ ./-])[0-9]{3}[ .-][0-9]{3,5}"),
}
#: Proposals that a task holds before it passes them on; those of one text are held together.
_PROPOSALS = 10_000
_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
_PROPOSED = pa.struct([*_SPAN, ("label", pa.float64()), ("free", pa.bool_()), ("features", pa.list_(pa.float64()))])


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += (2 * d - 9 if d > 4 else 2 * d) if i % 2 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            yield start, match.end()
        last = match.end() if match else at + 1
        at = text.find("@", last)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the strict patterns, by kind, then start."""
    found = [(0, a, b) for a, b in _emails(text)]
    if any(c in text for c in "0123456789"):
        # int() of very long digit runs is refused; more than three significant digits exceed 255.
        small = lambda part: len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255
        found += [(1, *m.span()) for m in _IP.finditer(text) if all(map(small, m[0].split(".")))]
        found += [(2, *m.span()) for m in _CARD.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        found += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return found


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format of a span and its context."""
    span, before, after = text[start:end], text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    digits = _digits(span)
    groups = re.findall(r"[0-9]+", span)
    sizes = [len(g) for g in groups] or [0]
    numbers = [
        kind, len(span), len(digits), len(groups), max(sizes), min(sizes), span.count("."), span.count("-"), span.count(" "),
        span.count("("), luhn(digits) if len(digits) > 1 else 0, sum(c.isalpha() for c in span),
        max((min(int(g[-4:]), 999) if len(g) <= 4 else 999 for g in groups), default=0), groups == [digits], len(groups[-1]) if groups else 0,
        before[-1:].isspace() or not before, before[-1:].isalnum(), after[:1].isspace() or not after, after[:1].isalnum(), before[-1:] in "\"'=",
    ]
    return [float(x) for x in numbers] + [float(bool(cue.search(before))) for cue in _CUES.values()]


def disguises(kind: int, span: str) -> list[str]:
    """Other ways to write a base span, which the strict patterns miss and the loose ones propose."""
    if kind == 0:
        name, host = span.split("@")
        parts = host.split(".")
        return [f"{name} [at] {' [dot] '.join(parts)}", f"{name}(at){host}", f"{name} at {parts[0]} [dot] {'.'.join(parts[1:])}"]
    digits = _digits(span)
    if kind == 2:
        return [sep.join(digits[i : i + 4] for i in range(0, len(digits), 4)) for sep in "./"]
    if kind == 3:
        own = digits[-10:]
        a, b, c = own[:-7], own[-7:-4], own[-4:]
        return [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"{digits[:1]} ({a}) {b}-{c}"]
    return []


def proposed_spans(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple]:
    """All proposals, which may overlap, with their label (1: a base span in disguise; 0: a free one
    whose format does not agree with its kind; None otherwise), whether they are free of base spans, and
    features. Only free ones can be added; base spans themselves and disguises cannot."""
    strict, found = {*base}, [(*span, None, False) for span in base]
    loose: list[tuple[int, int, int]] = []
    if "@" in text:
        loose += [(0, *m.span()) for m in _ADDRESS.finditer(text)]
    if "at" in text and ("[" in text or "(" in text):
        loose += [(0, *m.span()) for m in _SPELLED.finditer(text)]
    if any(c in text for c in "0123456789"):
        for m in _NUMBER.finditer(text):
            size = len(_digits(m[0]))
            kinds = [k for k, fits in ((1, m[0].count(".") >= 2), (2, 12 <= size <= 19), (3, 5 <= size <= 15)) if fits]
            loose += [(k, *m.span()) for k in kinds]
    taken = sorted(span[1:] for span in base)
    for kind, start, end in sorted({*loose} - strict, key=lambda s: (s[1:], s[0])):
        # Spans of one kind don't overlap, so of those that begin before the end few can reach beyond the start.
        near = bisect.bisect_left(taken, (end, end))
        free = all(e <= start for _, e in taken[max(0, near - 2 * len(KINDS)) : near])
        agrees = kind in _AGREES and _AGREES[kind].fullmatch(text, start, end)
        found.append((kind, start, end, 0.0 if free and not agrees else None, free))
    for span in found:
        yield *span, features(text, *span[:3])
    for kind, start, end in base:
        before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
        for other in disguises(kind, text[start:end]):
            own = features(before + other + after, kind, len(before), len(before) + len(other))
            yield kind, start, end, 1.0, False, own


class _Proposals:
    """Base spans and proposals of some texts, as flat arrays."""

    def __init__(self) -> None:
        self.base, self.spans, self.features, self.label, self.free = array("i"), array("i"), array("d"), array("d"), array("b")
        self.counts: list[tuple[int, int]] = []

    def add(self, text: str) -> None:
        base, before = base_spans(text), len(self.label)
        for span in base:
            self.base.extend(span)
        for kind, start, end, label, free, own in proposed_spans(text, base):
            self.spans.extend((kind, start, end))
            self.features.extend(own)
            self.label.append(-1.0 if label is None else label)
            self.free.append(free)
        self.counts.append((len(base), len(self.label) - before))

    def columns(self) -> tuple[pa.Array, pa.Array]:
        base, spans = (np.array(x, dtype=np.int32).reshape(-1, 3).T for x in (self.base, self.spans))
        label, features = np.array(self.label), np.array(self.features)
        width = np.full(len(label), len(features) // max(1, len(label)))
        fields = [*spans, pa.array(label, mask=label < 0), np.array(self.free, dtype=bool), worker.lists(features, width, pa.float64())]
        return tuple(
            pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32()),
                pa.StructArray.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], fields=[*kind]),
            )
            for columns, kind, count in zip((base, fields), (_SPAN, _PROPOSED), zip(*self.counts))
        )


def propose(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: ``row`` (a number), ``key``, ``digest`` of the text, ``base`` and ``proposed`` spans."""
    name = df.schema[key].dataType.simpleString()
    span = "kind:int, start:int, end:int"
    schema = f"row long, key {name}, digest string, base array<struct<{span}>>, proposed array<struct<{span}, label:double, free:boolean, features:array<double>>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in worker.slices(batches, "text"):
            held, first = _Proposals(), 0
            for at, text in enumerate(batch.column("text").to_pylist(), 1):
                held.add(text or "")
                if len(held.label) > _PROPOSALS or at == batch.num_rows:
                    own = batch.slice(first, at - first)
                    numbers = pa.array(range(row, row + own.num_rows), pa.int64())
                    columns = [numbers, own.column("key"), own.column("digest"), *held.columns()]
                    yield pa.RecordBatch.from_arrays(columns, names=["row", "key", "digest", "base", "proposed"])
                    row, first, held = row + own.num_rows, at, _Proposals()

    return df.select(F.col(key).alias("key"), worker.digest(text).alias("digest"), F.col(text).alias("text")).mapInArrow(run, schema)


@dataclass
class Selector:
    """Boosted trees and the score from which a span is taken."""

    trees: GBTClassificationModel
    threshold: float


def _score(trees: GBTClassificationModel, spans: DataFrame) -> DataFrame:
    scored = trees.transform(spans.withColumn("vector", array_to_vector("features")))
    return scored.withColumn("score", vector_to_array("probability")[1]).drop("vector", "probability", "rawPrediction", "prediction")


def fit(found: DataFrame, precision: float = PRECISION) -> Selector | None:
    """Trees on three quarters of all labelled spans, the threshold on the rest."""
    spans = found.select("row", F.inline("proposed")).where("label IS NOT NULL")
    order = F.xxhash64("row", "start", "end", "kind")
    examples = staged(spans.select(order.alias("place"), "label", "features").orderBy("place"), "spans")
    learn, rest = examples.where("pmod(place, 4) <> 0"), examples.where("pmod(place, 4) = 0")
    n, positive = learn.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if positive < LEAST_SPANS or n - positive < LEAST_SPANS:
        return None
    maker = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=12, maxDepth=4, seed=1, stepSize=0.3)
    trees = maker.fit(learn.withColumn("vector", array_to_vector("features")))
    # One row per hundredth of the score: right and wrong from there on.
    bins = _score(trees, rest).groupBy(F.floor(F.col("score") * 100).alias("bin")).agg(F.sum("label").alias("right"), F.count("*").alias("n"))
    threshold, right, all_ = None, 0.0, 0
    for row in sorted(bins.collect(), key=lambda r: -r["bin"]):
        right, all_ = right + row["right"], all_ + row["n"]
        if right >= precision * all_:
            threshold = row["bin"] / 100
    return Selector(trees, threshold) if threshold is not None else None


def find(df: DataFrame, key: str = "doc_id", text: str = "text", selector: Selector | None = None) -> DataFrame:
    """Per document: ``key``, ``digest`` of the text, ``base`` and ``added`` spans (arrays of ``kind``, ``start``, ``end`` in order)."""
    found = staged(propose(df, key, text), "spans-of-documents")
    selector = selector or fit(found)
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    if selector is None:
        return found.select(F.col("key").alias(key), "digest", "base", none.alias("added"))
    loose = found.select("row", F.inline("proposed")).where("free")
    taken = _score(selector.trees, loose).where(F.col("score") >= selector.threshold)
    added = taken.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end"))).alias("added"))
    both = found.select("row", "key", "digest", "base").join(added, "row", "left")
    return both.select(F.col("key").alias(key), "digest", "base", F.coalesce("added", none).alias("added"))


def redact(df: DataFrame, spans: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The frame with every found span of ``text`` replaced by its kind in brackets.

    Spans belong to a key and a text, so rows that share a key, null too, each get their own. Rows without
    spans or without a partner keep their texts; overlapping spans become one."""
    own_key, digest, found = worker.unused(df, "key", "digest", "spans")
    own = spans.select(F.col(key).alias(own_key), F.col("digest").alias(digest), F.concat("base", "added").alias(found))
    own = own.where(F.size(found) > 0).dropDuplicates([own_key, digest])
    both = df.join(own, F.col(key).eqNullSafe(F.col(own_key)) & (worker.digest(text) == F.col(digest)), "left")

    @F.pandas_udf("string")
    def cut(texts, spans):
        def one(text, own):
            if text is None or own is None:
                return text
            out, last = [], 0
            for s in sorted(own, key=lambda s: (s["start"], -s["end"])):
                if s["end"] > last:
                    if s["start"] >= last:
                        out += [text[last : s["start"]], f"[{KINDS[s['kind']]}]"]
                    last = s["end"]
            return "".join([*out, text[last:]])

        return texts.combine(spans, one)

    return both.withColumn(text, F.when(F.col(found).isNull(), F.col(text)).otherwise(cut(F.col(text), F.col(found)))).select(*df.columns)
