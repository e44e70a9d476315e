"""Personal data: spans found by form, and terms that give them away.

Emails, addresses, cards and phones are found by their form. The words around
them are then weighed over the whole corpus: for an entity c (a kind of data,
or one value that occurs in several contexts) and a term t,

    IC(c) = -log2 p(c)      PMI(t; c) = log2 (p(t, c) / (p(t) p(c)))

with p over the tokens of all texts. PMI never exceeds IC; it reaches it where
the term occurs only beside the entity. A term is disclosive where
PMI(t; c) >= DISCLOSURE * IC(c) and enough distinct evidence beside the entity
supports it; it is then reported wherever it stands in a text with the entity.
Such spans are generalised (entities) or removed (terms).
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import BROADCAST_ROWS, narrow, sha256
from waymark.session import materialise

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
# Characters on either side of an entity whose words are its context.
CONTEXT_CHARS = 60
# Share of the entity's information that a term may give away.
DISCLOSURE = 0.9
# Distinct values (of a kind) or contexts (of a value) that must support it.
SUPPORT = 5
# Terms counted inside the tasks, if there are no more candidates than this.
COUNTED_TERMS = 200_000

_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_local_end = re.compile(r"[A-Za-z0-9._%+-]*$")
_not_local = re.compile(r"[^A-Za-z0-9._%+-]")
# A run of digits is tried from its start only: later starts end alike.
_ip = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_card = re.compile(r"[0-9](?:[ -]?[0-9])+")
_phone = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_digit = re.compile(r"[0-9]")
_term = re.compile(r"[^\W\d_]{3,}")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Every match has one '@'; the local part reaches back as far as it can."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and not _not_local.match(text, start - 1):
            start -= 1
        found = _domain.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(done, at + 1))


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _in_range(part: str) -> bool:
    short = part.lstrip("0")
    return len(short) <= 3 and int(short or 0) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans by form, by kind as listed, then by start."""
    found = [("email", *span) for span in _emails(text)]
    if not _digit.search(text):
        return found
    for match in _ip.finditer(text):
        if all(map(_in_range, match.groups())):
            found.append(("ip", *match.span()))
    for match in _card.finditer(text):
        digits = re.sub("[^0-9]", "", match.group())
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", *match.span()))
    if "+" in text:
        for match in _phone.finditer(text):
            if 8 <= sum(map(str.isdigit, match.group())) <= 15:
                found.append(("phone", *match.span()))
    return found


def context_terms(text: str, start: int, end: int) -> Iterator[tuple[str, int, int]]:
    """Whole words within CONTEXT_CHARS of a span, lower case, with places."""
    low, high = max(0, start - CONTEXT_CHARS), min(len(text), end + CONTEXT_CHARS)
    for begin, stop in ((low, start), (end, high)):
        for match in _term.finditer(text, begin, stop):
            cut = (match.start() == low and low and text[low - 1].isalpha()) or (
                match.end() == high and high < len(text) and text[high].isalpha()
            )
            if not cut:
                yield match.group().lower(), match.start(), match.end()


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


class _Cover:
    """What the base spans of a text cover, looked up in logarithmic time."""

    def __init__(self, spans: list[tuple[str, int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted((start, end) for _, start, end in spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def touches(self, begin: int, stop: int) -> bool:
        place = bisect_right(self.ends, begin)
        return place < len(self.starts) and self.starts[place] < stop


def _candidates(text: str, spans: list[tuple[str, int, int]]) -> list[tuple]:
    """(entity, unit of evidence, term, start, end) beside every base span."""
    covered, found = _Cover(spans), []
    for kind, start, end in spans:
        value = xxhash.xxh64_hexdigest(text[start:end].lower().encode())
        low, high = max(0, start - CONTEXT_CHARS), end + CONTEXT_CHARS
        context = xxhash.xxh64_hexdigest(text[low:high].encode("utf-8", "surrogatepass"))
        for term, begin, stop in context_terms(text, start, end):
            if not covered.touches(begin, stop):
                found.append((kind, value, term, begin, stop))
                found.append((f"{kind}:{value}", context, term, begin, stop))
    return found


def held_entities(text: str, spans: list[tuple[str, int, int]]) -> set[str]:
    """The kinds and values that a text holds, named as in ``_candidates``."""
    values = (
        f"{kind}:{xxhash.xxh64_hexdigest(text[start:end].lower().encode())}"
        for kind, start, end in spans
    )
    return {kind for kind, _, _ in spans}.union(values)


def term_spans(
    text: str, spans: list[tuple[str, int, int]], terms: set[str]
) -> list[tuple[str, int, int]]:
    """All places of the terms outside base spans, in order."""
    if not terms:
        return []
    covered = _Cover(spans)
    places = (match.span() for match in _term.finditer(text) if match.group().lower() in terms)
    return [(TERM, *place) for place in places if not covered.touches(*place)]


def find_base(docs: DataFrame) -> DataFrame:
    """Base spans and context terms of every text, one row per row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spans = [base_spans(text) for text in batch["text"]]
            counts = [Counter(kind for kind, _, _ in found) for found in spans]
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"]}
                | {f"n_{kind}": [count[kind] for count in counts] for kind in KINDS}
                | {
                    "base": [joined(found) for found in spans],
                    "near": [_candidates(*pair) for pair in zip(batch["text"], spans)],
                }
            )

    texts = narrow(docs)
    key = texts.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    near = "array<struct<entity: string, unit: string, term: string, start: long, end: long>>"
    return texts.mapInPandas(run, f"doc_id {key}, {counts}, base string, near {near}")


def term_totals(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Occurrences of the wanted terms in all texts; the term '' has all tokens.

    Few candidates are sent to the tasks and counted there alone. With more of
    them every term is counted and joined; the result is the same.
    """
    few = wanted.limit(COUNTED_TERMS + 1).count() <= COUNTED_TERMS
    context = docs.sparkSession.sparkContext
    shared = context.broadcast({row["term"] for row in wanted.collect()}) if few else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, total = Counter(), 0
        for batch in batches:
            for text in batch["text"]:
                terms = _term.findall(text.lower())
                total += len(terms)
                counts.update(filter(shared.value.__contains__, terms) if shared else terms)
            if len(counts) > COUNTED_TERMS:
                yield pd.DataFrame({"term": list(counts), "total": list(counts.values())})
                counts = Counter()
        counts[""] = total
        yield pd.DataFrame({"term": list(counts), "total": list(counts.values())})

    counted = narrow(docs).select("text").mapInPandas(run, "term string, total long")
    return counted.groupBy("term").agg(F.sum("total").alias("total"))


def disclosive_terms(
    docs: DataFrame, found: DataFrame, disclosure: float = DISCLOSURE, support: int = SUPPORT
) -> DataFrame:
    """(entity, term, disclosure) of the terms above the threshold.

    Counts are summed per unit of evidence first, so an entity that a third of
    all rows mention is many small groups.
    """
    near = found.select(F.explode("near").alias("near")).select("near.*")
    units = near.groupBy("entity", "unit", "term").agg(F.count("*").alias("n"))
    pairs = materialise(
        units.groupBy("entity", "term").agg(
            F.sum("n").alias("together"), F.count("*").alias("units")
        ),
        "disclosure-pairs",
    )
    supported = pairs.filter(F.col("units") >= support)
    totals = materialise(
        term_totals(docs, supported.select("term").distinct()), "disclosure-totals"
    )
    tokens = totals.filter("term = ''").agg(F.sum("total")).head()[0] or 0
    entities = pairs.groupBy("entity").agg(F.sum("together").alias("near_tokens"))
    weighed = (
        supported.join(entities, "entity")
        .join(totals, "term")
        .withColumn("tokens", F.lit(tokens).cast("double"))
        .withColumn("ic", F.log2(F.col("tokens") / F.col("near_tokens")))
        .withColumn(
            "pmi",
            F.log2(
                F.col("together") * F.col("tokens") / (F.col("total") * F.col("near_tokens"))
            ),
        )
    )
    return weighed.filter(F.col("pmi") >= disclosure * F.col("ic")).select(
        "entity", "term", F.round(F.col("pmi") / F.col("ic"), 6).alias("disclosure")
    )


def find_spans(
    docs: DataFrame, disclosure: float = DISCLOSURE, support: int = SUPPORT
) -> DataFrame:
    """Base spans and disclosive terms of every document.

    One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base
    and spans (comma-joined kind:start:end), n_term. NULL and empty texts have
    no spans, a NULL doc_id stays NULL, repeated rows come back each, other
    columns are ignored. Ties at the thresholds count as reached.
    """
    found = materialise(find_base(docs), "disclosure-base")
    flagged = materialise(disclosive_terms(docs, found, disclosure, support), "disclosure-terms")
    texts = narrow(docs)
    key = texts.schema["doc_id"].dataType.simpleString()
    few = flagged.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    shared = None
    if few:
        terms: dict[str, set[str]] = {}
        for row in flagged.collect():
            terms.setdefault(row["entity"], set()).add(row["term"])
        shared = docs.sparkSession.sparkContext.broadcast(terms)
    else:
        texts = _with_terms(texts, flagged)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            given = [None] * len(batch) if shared else batch["terms"]
            for text, terms in zip(batch["text"], given):
                spans = base_spans(text)
                if shared:
                    held = held_entities(text, spans) if shared.value else ()
                    terms = set().union(*(shared.value.get(entity, ()) for entity in held))
                added = term_spans(text, spans, set() if terms is None else set(terms))
                count = Counter(kind for kind, _, _ in spans)
                parts = (joined(spans), joined(spans + added), len(added))
                rows.append((*(count[kind] for kind in KINDS), *parts))
            names = [*(f"n_{kind}" for kind in KINDS), "base", "spans", "n_term"]
            frame = pd.DataFrame(rows, columns=names)
            frame.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield frame

    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    return texts.mapInPandas(run, f"doc_id {key}, {counts}, base string, spans string, n_term long")


def _with_terms(texts: DataFrame, flagged: DataFrame) -> DataFrame:
    """Every text with the flagged terms of the entities it holds, by joins."""

    @F.pandas_udf("array<string>")
    def entities(batch: pd.Series) -> pd.Series:
        return pd.Series([sorted(held_entities(text, base_spans(text))) for text in batch], dtype=object)

    numbered = materialise(
        texts.withColumn("row", F.monotonically_increasing_id()).withColumn("held", entities("text")),
        "disclosure-held",
    )
    terms = (
        numbered.select("row", F.explode("held").alias("entity"))
        .join(flagged, "entity")
        .groupBy("row")
        .agg(F.collect_set("term").alias("terms"))
    )
    return numbered.join(terms, "row", "left").select("doc_id", "text", "terms")


def parse_spans(spans: str) -> list[tuple[str, int, int]]:
    items = (item.split(":") for item in spans.split(",") if item)
    return [(kind, int(start), int(end)) for kind, start, end in items]


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Entities become their kind in brackets, disclosive terms are removed.

    Spans that overlap an earlier one are covered up to their end.
    """
    out, done = [], 0
    for start, end, kind in sorted((start, end, kind) for kind, start, end in spans):
        if end <= done:
            continue
        if start >= done:
            out += [text[done:start], "" if kind == TERM else f"[{kind.upper()}]"]
        done = end
    return "".join([*out, text[done:]])


def digests(spans: DataFrame) -> DataFrame:
    return spans.select(
        "doc_id",
        *[f"n_{kind}" for kind in KINDS],
        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
        "spans",
        "n_term",
    )


def brute_digest(text: str) -> str:
    return sha256(joined(base_spans(text)))
