"""Secrets, and multipart credentials linked within scopes. DataFrame functions only.

Secrets are found by form (assigned values, access identifiers, long hex
runs). Weak candidates (user or client names, endpoints, long mixed tokens)
mean nothing alone. They are interval-joined with the other parts of the same
document: each part opens a scope of ``SCOPE`` characters around itself, and a
weak one is reported where a complementary part lies in its scope. The join
is evaluated in order of position, so no pairs are made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.common import bounded_broadcast, fresh_name, narrow
from waymark.session import materialise

SCOPE = 300

# Fixed forms of the base kinds.
ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the same spans as runs of any length, kept from 20 on
HEX = r"[0-9a-f]{24,}"
BASE = ("assign", "access", "hex")

# Weak candidates.
NAME = (
    r"(?i:(?:client|account|access[_-]?key|user)[_-]?id|user(?:name)?|login)"
    r"[\"']?\x20{0,4}[:=]\x20{0,4}[\"']?[A-Za-z0-9@._-]{3,}"
)
ENDPOINT = r"(?i:https?|jdbc:[a-z]{1,20}|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s\"'<>]+"
OPAQUE = r"(?<![A-Za-z0-9+/])(?=[A-Za-z+/]{0,200}[0-9])[A-Za-z0-9+/]{32,}={0,2}"
WEAK = ("name", "endpoint", "opaque")
ROLES = {
    "assign": "secret", "hex": "secret", "opaque": "secret",
    "access": "identity", "name": "identity", "endpoint": "place",
}
ORDER = BASE + WEAK

SPAN = "struct<start: int, end: int, kind: string>"
# Matches walked in one go. An array that grows by one span is copied each time,
# so long walks are cut: the first places of the pieces are added up before.
WALK = 256


def spans_of(text: Column, kind: str, pattern: str, least: int = 1, value: int = 0) -> Column:
    """Leftmost non-overlapping matches as spans in code points.

    The pieces between the matches and the matches themselves add up to the
    text, so their lengths give every place in one walk. Matches whose group
    ``value`` has fewer than ``least`` characters are passed over.
    """
    regexp = F.lit(pattern)
    parts = F.struct(
        F.split(text, pattern, -1).alias("between"),
        F.regexp_extract_all(text, regexp, F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, regexp, F.lit(value)).alias("value"),
    )
    empty = F.expr(f"cast(array() as array<{SPAN}>)")

    def length(found: Column, i: Column) -> Column:
        between, whole = F.get(found["between"], i), F.get(found["whole"], i)
        return F.char_length(between) + F.char_length(whole)

    def places(found: Column, piece: Column) -> Column:
        last = F.least(F.size(found["whole"]), (piece + 1) * WALK) - 1
        return F.sequence((piece * WALK).cast("int"), last.cast("int"))

    def walk_from(found: Column, piece: Column, begin: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            start = state["at"] + F.char_length(F.get(found["between"], i))
            end = state["at"] + length(found, i)
            span = F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"))
            long_enough = F.char_length(F.get(found["value"], i)) >= least
            return F.struct(
                end.alias("at"),
                F.when(long_enough, F.concat(state["spans"], F.array(span)))
                .otherwise(state["spans"])
                .cast(f"array<{SPAN}>")
                .alias("spans"),
            )

        first = F.struct(begin.alias("at"), empty.alias("spans"))
        return F.aggregate(places(found, piece), first, step, lambda state: state["spans"])

    def walk(found: Column) -> Column:
        pieces = F.sequence(F.lit(0), F.floor((F.size(found["whole"]) - 1) / WALK).cast("int"))

        def add(begins: Column, piece: Column) -> Column:
            width = F.aggregate(
                places(found, piece), F.lit(0), lambda total, i: total + length(found, i)
            )
            return F.concat(begins, F.array(F.element_at(begins, -1) + width))

        begins = F.aggregate(pieces, F.array(F.lit(0)), add)
        walked = F.transform(
            F.array(begins),
            lambda known: F.flatten(
                F.transform(pieces, lambda piece: walk_from(found, piece, F.get(known, piece)))
            ),
        )
        return F.get(walked, F.lit(0))

    walked = F.get(F.transform(F.array(parts), walk), F.lit(0))
    return F.when(text.rlike(pattern), walked).otherwise(empty)


def find_parts(rows: DataFrame, text: str) -> DataFrame:
    """Adds ``parts``: all spans of all kinds, in order of position."""
    source = F.col(text)
    found = [
        spans_of(source, "assign", ASSIGN, 6, 2),
        spans_of(source, "access", ACCESS),
        spans_of(source, "hex", HEX),
        spans_of(source, "name", NAME),
        spans_of(source, "endpoint", ENDPOINT),
        spans_of(source, "opaque", OPAQUE),
    ]
    return rows.withColumn("parts", F.concat(*found))


def _is(kinds: tuple[str, ...]) -> Column:
    return F.col("kind").isin(*kinds)


def linked_parts(rows: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak parts with a complementary part in their scope: row, start, end, kind.

    Identities and places complement secrets and the other way round. Only
    documents with a weak part take part.
    """
    weak = F.exists("parts", lambda part: part["kind"].isin(*WEAK))
    parts = (
        rows.filter(weak)
        .select("row", F.explode("parts").alias("part"))
        .select("row", "part.*")
        .withColumn(
            "secret", _is(tuple(kind for kind, role in ROLES.items() if role == "secret"))
        )
    )
    order = Window.partitionBy("row").orderBy("start", "end", "kind")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    later = order.rowsBetween(1, Window.unboundedFollowing)
    end, start, secret = F.col("end"), F.col("start"), F.col("secret")
    near = (
        parts.withColumn("secret_before", F.max(F.when(secret, end)).over(earlier))
        .withColumn("other_before", F.max(F.when(~secret, end)).over(earlier))
        .withColumn("secret_after", F.min(F.when(secret, start)).over(later))
        .withColumn("other_after", F.min(F.when(~secret, start)).over(later))
    )
    before = F.when(secret, F.col("other_before")).otherwise(F.col("secret_before"))
    after = F.when(secret, F.col("other_after")).otherwise(F.col("secret_after"))
    in_scope = (start - before <= scope) | (after - end <= scope)
    return near.filter(_is(WEAK) & F.coalesce(in_scope, F.lit(False))).select(
        "row", "start", "end", "kind"
    )


def _linked_per_row(rows: DataFrame, scope: int) -> DataFrame:
    return linked_parts(rows, scope).groupBy("row").agg(
        F.collect_list(F.struct("start", "end", "kind")).alias("linked")
    )


def _ordered(spans: Column) -> Column:
    """By start, then by kind as listed."""
    rank = F.array(*map(F.lit, ORDER))
    keyed = F.transform(
        spans,
        lambda span: F.struct(
            span["start"].alias("start"),
            F.array_position(rank, span["kind"]).alias("place"),
            span["end"].alias("end"),
            span["kind"].alias("kind"),
        ),
    )
    return F.array_sort(keyed)


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda span: span["kind"] == kind)).cast("long")


def joined(spans: Column) -> Column:
    one = F.transform(
        spans, lambda span: F.concat_ws(":", span["kind"], span["start"], span["end"])
    )
    return F.concat_ws(",", one)


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Secrets and linked credential parts of every document.

    One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base (the
    joined base spans), spans (all), n_linked. NULL and empty texts have none,
    a NULL doc_id stays NULL, repeated rows come back each, and other columns
    are ignored.
    """
    found = find_parts(narrow(docs), "text").drop("text")
    rows = materialise(found.withColumn("row", F.monotonically_increasing_id()), "secret-parts")
    linked = materialise(_linked_per_row(rows, scope), "secret-links")
    base = F.filter("parts", lambda part: part["kind"].isin(*BASE))
    added = F.coalesce("linked", F.expr(f"cast(array() as array<{SPAN}>)"))
    return (
        rows.join(bounded_broadcast(linked), "row", "left")
        .withColumn("base_spans", _ordered(base))
        .withColumn("all_spans", _ordered(F.concat(base, added)))
        .select(
            "doc_id",
            *[count_of("base_spans", kind).alias(f"n_{kind}") for kind in BASE],
            joined(F.col("base_spans")).alias("base"),
            joined(F.col("all_spans")).alias("spans"),
            F.size(added).cast("long").alias("n_linked"),
        )
    )


def digests(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
        "spans",
        "n_linked",
    )


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every covered stretch replaced by ``mark``."""

    def step(state: Column, span: Column) -> Column:
        inside = span["start"] < state["at"]
        between = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(inside, state["out"])
            .otherwise(F.concat(state["out"], between, F.lit(mark)))
            .alias("out"),
        )

    def rest(state: Column) -> Column:
        left = F.substring(text, state["at"] + 1, F.char_length(text))
        return F.concat(state["out"], left)

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.when(F.size(spans) > 0, F.aggregate(_ordered(spans), begin, step, rest)).otherwise(
        text
    )


def redact_documents(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The same rows and columns with secrets and linked parts blanked out.

    NULL texts stay NULL. Columns besides ``text`` pass through unchanged,
    whatever their names are.
    """
    names = docs.columns
    packed = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in names]).alias("document"),
        F.coalesce(F.col("text"), F.lit("")).alias("source"),
    )
    stored = find_parts(packed, "source").drop("source")
    rows = materialise(stored.withColumn("row", F.monotonically_increasing_id()), "secret-rows")
    linked = materialise(_linked_per_row(rows.select("row", "parts"), scope), "secret-links")
    base = F.filter("parts", lambda part: part["kind"].isin(*BASE))
    added = F.coalesce("linked", F.expr(f"cast(array() as array<{SPAN}>)"))
    text = fresh_name(names, "redacted")
    return (
        rows.join(bounded_broadcast(linked), "row", "left")
        .withColumn(text, redacted(F.col("document.text"), F.concat(base, added)))
        .select(
            *[
                F.col(text).alias("text") if name == "text" else F.col(f"document.`{name}`")
                for name in names
            ]
        )
    )
