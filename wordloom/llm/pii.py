"""Personal data: base patterns, and identifiers that bootstrapped lexical patterns find beside them.

Base spans are seed instances. The words around a seed make lexical patterns; patterns and instances form a graph whose
edges Spark counts. In turns, a pattern is trusted if it surrounds enough trusted instances of one kind and hardly any of
other kinds or of a form that this kind cannot have, and an instance is trusted if trusted patterns surround it. Candidate tokens in the context of a
trusted pattern are the identifiers that no base pattern knows.
"""

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import map_batches, texts
from wordloom.sources.workspace import RoundTables, staged

KINDS = ("email", "ip", "card", "phone")
CANDIDATE = -1

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match ends with its run of digits, so no match starts inside one; the first start of a run tells for all of them.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Every match holds one @ after a run of local characters: its start is the start of that run."""
    at, floor = text.find("@"), 0
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            floor = domain.end()
        at = text.find("@", max(at + 1, floor))


def _is_ip(value: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in value.split("."))


def _is_card(value: str) -> bool:
    digits = _NOT_DIGIT.sub("", value) if 13 <= len(value) <= 37 else ""
    if not 13 <= len(digits) <= 19:
        return False
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + doubled) % 10 == 0


def _is_phone(value: str) -> bool:
    return 9 <= len(_NOT_DIGIT.sub("", value)) <= 15


def base_spans(text: str) -> list[Span]:
    """``(kind, start, end)`` in code points by kind, then start; leftmost and non-overlapping within a kind."""
    found = [(0, a, b) for a, b in _emails(text)]
    for kind, pattern, valid in ((1, _IP, _is_ip), (2, _CARD, _is_card), (3, _PHONE, _is_phone)):
        if kind < 3 or "+" in text:
            found += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if valid(m[0])]
    return found


_TOKEN = re.compile(r"(?:[0-9@]|[\[({<][Aa][Tt][\])}>])[^\x20\x09-\x0D]*")
_SPACE = frozenset(" \t\n\v\f\r")
_TRIMMED = "\"'`,;:!?.()[]{}<>*#$%&|"
_NUMBER_PART = re.compile(r"\x20[(+]?[0-9][0-9().-]*(?![^\x20\x09-\x0D])")


def candidate_spans(text: str, taken: list[Span]) -> Iterator[tuple[int, int]]:
    """Tokens with a digit, an @ or a bracketed "at", number groups joined by single spaces as one, that overlap no span in ``taken``."""
    busy = sorted((a, b) for _, a, b in taken)
    at = next_busy = 0
    while found := _TOKEN.search(text, at):
        start, end = found.span()
        while start > at and text[start - 1] not in _SPACE:
            start -= 1
        if text[start] in "(+0123456789":
            while more := _NUMBER_PART.match(text, end):
                end = more.end()
        at = max(end, start + 1)
        while start < end and text[start] in _TRIMMED:
            start += 1
        while end > start and text[end - 1] in _TRIMMED:
            end -= 1
        while next_busy < len(busy) and busy[next_busy][1] <= start:
            next_busy += 1
        if end - start >= 4 and (next_busy == len(busy) or busy[next_busy][0] >= end):
            yield start, end


_REACH = 80
_DIGIT = re.compile(r"[0-9]")


def contexts(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns around a span: two words before it; a word before and after; two words before and one after.

    Marks right beside the span belong to neither.
    """
    left = _DIGIT.sub("0", text[max(0, start - _REACH):start].rstrip(_TRIMMED).lower()).split()
    right = _DIGIT.sub("0", text[end:end + _REACH].lstrip(_TRIMMED).lower()).split()
    after = right[0] if right else "$"
    before = left[-2:]
    if len(before) < 2:
        return [f"{' '.join(before)} _ {after}"] if before else []
    return [f"{before[0]} {before[1]} _", f"{before[1]} _ {after}", f"{before[0]} {before[1]} _ {after}"]


def _value(kind: int, text: str) -> str:
    return _NOT_DIGIT.sub("", text) if kind >= 2 else text.lower()


_FOUND = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
                             ("value", pa.string()), ("contexts", pa.list_(pa.string()))]))
_FOUND_DDL = "_found array<struct<kind:int,start:bigint,end:bigint,value:string,contexts:array<string>>>"


def _found(text: str | None) -> list[dict]:
    if not text:
        return []
    spans = base_spans(text)
    spans += [(CANDIDATE, a, b) for a, b in candidate_spans(text, spans)]
    return [{"kind": k, "start": a, "end": b, "value": _value(k, text[a:b]), "contexts": contexts(text, a, b)}
            for k, a, b in spans]


def mentions(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its ``keep`` columns) with ``_found``: base spans by kind, then candidates, each with its contexts."""
    place = docs.columns.index(text)

    def work():
        return lambda batch: [pa.array([_found(t) for t in texts(batch.column(place))], _FOUND)]

    return map_batches(docs, work, _FOUND_DDL, keep)


def _could_be() -> list[Column]:
    """For each kind, whether a candidate's value has a form that the kind can have."""
    value = F.col("value")
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    plain = ~F.regexp_replace(value, "ext|x", "").rlike(r"[\p{L}@]")
    return [value.rlike(r".(@|[\[({<]at[\])}>])."), value.rlike("[.:].*[.:]"), digits.between(12, 19) & plain, digits.between(6, 15) & plain]


def trusted_patterns(found: DataFrame, precision: float = 0.9, support: int = 5, rounds: int | None = None) -> DataFrame:
    """``(pattern, kind, confidence)`` from the rows of :func:`mentions`.

    A pattern's confidence for a kind is the trust of the different instances of the kind that it surrounds, divided by
    that, the trust of instances of other kinds and the number of negatives: unknown ones whose form the kind cannot have.
    Other unknown ones, which are to be discovered, count neither way. It is trusted from ``precision`` on if the trust
    reaches ``support``. Unknown instances get the trust 1 - product(1 - confidence) over the trusted patterns around them
    and count as trusted from ``precision`` on. Turns end when no instance is raised, or after ``rounds``. Counting different
    instances, not mentions, keeps copies of a text from adding support.
    """
    each = found.select(F.explode("_found").alias("f"))
    edges = each.select(F.explode("f.contexts").alias("pattern"), F.col("f.value").alias("value"), F.col("f.kind").alias("kind"))
    edges = edges.groupBy("pattern", "value").agg(F.max("kind").alias("kind"))
    edges = staged(edges.select("*", *[c.alias(f"could{k}") for k, c in enumerate(_could_be())]), "pattern-instances")
    trust = edges.where("kind >= 0").select("value", "kind", F.lit(1.0).alias("trust")).distinct()
    step = RoundTables(found.sparkSession)
    trust = step(trust, "trusted-instances")
    known, turn = trust.count(), 0
    while True:
        turn += 1
        around = edges.drop("kind").join(trust, "value", "left")
        sums = around.groupBy("pattern").agg(
            *[F.sum(F.when(F.col("kind") == k, F.col("trust")).otherwise(0.0)).alias(f"t{k}") for k in range(len(KINDS))],
            *[F.sum((F.col("kind").isNull() & ~F.col(f"could{k}")).cast("double")).alias(f"n{k}") for k in range(len(KINDS))])
        by_kind = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"t{k}").alias("trust"), F.col(f"n{k}").alias("negatives"))
                            for k in range(len(KINDS))])
        total = sum((F.col(f"t{k}") for k in range(1, len(KINDS))), F.col("t0"))
        patterns = step(
            sums.select("pattern", total.alias("total"), F.explode(by_kind).alias("t"))
            .select("pattern", "t.kind", (F.col("t.trust") / F.nullif(F.col("total") + F.col("t.negatives"), F.lit(0.0))).alias("confidence"), "t.trust")
            .where((F.col("trust") >= support) & (F.col("confidence") >= precision))
            .select("pattern", "kind", "confidence"), "trusted-patterns")
        if turn == rounds or patterns.isEmpty():
            break
        unknown = edges.where(F.col("kind") == CANDIDATE).select("pattern", "value")
        raised = (
            unknown.join(patterns, "pattern").groupBy("value", "kind")
            .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-12)))))).alias("trust"))
            .where(F.col("trust") >= precision))
        trust = step(trust.unionByName(raised).groupBy("value", "kind").agg(F.max("trust").alias("trust")), "trusted-instances")
        if (now := trust.count()) == known:
            break
        known = now
    step.finish("trusted-patterns")
    return patterns


def personal_data(docs: DataFrame, precision: float = 0.9, support: int = 5, rounds: int | None = None, text: str = "text",
                  keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` with ``base`` and ``spans``, arrays of ``struct<kind:int, start, end>``.

    ``base`` holds the matches of the base patterns; ``spans`` those and the candidates in the context of a trusted
    pattern, which get the pattern's kind. Both are sorted by kind, then start; positions are code points, the end
    exclusive. Null and empty texts have empty arrays. Repeated rows come out repeated, an empty table stays empty.
    """
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    # The row numbers tell repeated rows apart; they are written with the rows, so they cannot shift.
    found = staged(mentions(docs, text, keep).withColumn("_row", F.monotonically_increasing_id()), "mentions")
    patterns = trusted_patterns(found.select("_found"), precision, support, rounds)
    candidates = found.select("_row", F.explode(F.filter("_found", lambda f: f["kind"] == CANDIDATE)).alias("f"))
    seen = candidates.select("_row", "f.start", "f.end", F.explode("f.contexts").alias("pattern"))
    kinds = (
        seen.join(patterns, "pattern").groupBy("_row", "start", "end")
        .agg(F.max(F.struct("confidence", -F.col("kind"))).alias("best"))
        .select("_row", F.struct((-F.col("best.col2")).alias("kind"), "start", "end").alias("more"))
    )
    more = staged(kinds.groupBy("_row").agg(F.collect_list("more").alias("_more")), "discovered")
    base = F.transform(F.filter("_found", lambda f: f["kind"] >= 0),
                       lambda f: F.struct(f["kind"].alias("kind"), f["start"].alias("start"), f["end"].alias("end")))
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    return (
        found.join(more, "_row", "left")
        .select(*keep, F.array_sort(base).alias("base"), F.coalesce("_more", none).alias("_more"))
        .select(*keep, "base", F.array_sort(F.concat("base", "_more")).alias("spans"))
    )


def span_text(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """A row for each row of :func:`personal_data`: base counts by kind, the hash of the base spans and all spans."""
    return found.select(
        F.col(doc_id).alias("doc_id"), *[_count(k).cast("bigint").alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(span_text("base"), 256).alias("base_sha256"), span_text("spans").alias("spans"))


def _count(kind: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind))
