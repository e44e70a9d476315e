"""N-gram Jaccard self-join with signature trees.

A document is the set of hashes of its word n-grams. Documents with the same
set are one node. Nodes that could link share a token among the first of their
sets in one global order (tokens that a large share of the documents have come
last), so such tokens name the units of work. Within a unit the sets form a
tree: a tree node holds the OR of the token bitmaps below it, the range of set
sizes and the most bits lost to collisions. Two tree nodes are walked together
and dropped where the largest possible overlap is too small, the sizes cannot
fit, or everything below is one component already. What is left is compared
exactly.

Two rounds make that linear where many near copies meet. First every node
enters one unit only (of bounded size; large units are cut twice, in different
ways), which joins most of a group. Then the units whose members are not one
component yet are walked with the signatures alone, which tells the components
that could still be linked; their members are walked once more and compared
exactly. So a text travels once or twice, however many units name it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import (
    bounded_broadcast,
    fresh_name,
    lower_words,
    prepare,
    shingle_hashes,
    word_hashes,
)
from waymark.session import materialise

BITS = 4096  # of a bitmap
LEAF, FAN = 8, 8  # sets in a leaf, children of a tree node
BLOCK = 2000  # sets of a unit in one task
# Tokens in at least this share of the documents come last in the order. Their
# number is at most the mean set size divided by the share, whatever the
# corpus, which bounds what is broadcast.
COMMON_SHARE = 0.001
# A task hands on only tokens it saw this often.
TASK_TOKENS, TASK_LEAST = 4_000_000, 2


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes; a text of fewer words is one n-gram."""
    hashes = word_hashes(lower_words(text))
    if not len(hashes):
        return np.empty(0, np.uint64)
    return np.unique(shingle_hashes(hashes, min(size, len(hashes))))


def prefix_length(count: int, percent: int) -> int:
    """So many first tokens; sets that link share one of them."""
    return count - -(-percent * count // 100) + 1


def extra_tokens(count: int) -> int:
    """So many more tokens are looked at: sets that link share as many more."""
    return count // 20


def shared_needed(count: int, percent: int) -> int:
    """First and extra tokens that a set of this size shares with a link.

    If two sets have at least o tokens in common, the first (size - o + k) of
    each hold the first k common ones. The smaller set of a link has at least
    ``percent`` of the larger one's tokens, hence as many extra ones as here.
    """
    return 1 + extra_tokens(-(-percent * count // 100))


def bitmap_of(tokens: np.ndarray) -> bytes:
    flags = np.zeros(BITS, np.uint8)
    flags[(tokens % np.uint64(BITS)).astype(np.int64)] = 1
    return np.packbits(flags).tobytes()


def linked(overlap: int, first: int, second: int, percent: int) -> bool:
    return 100 * overlap >= percent * (first + second - overlap)


# -- trees, in one task ------------------------------------------------------


class _Union:
    def __init__(self, labels: list[int]):
        seen: dict[int, int] = {}
        self.parent = [seen.setdefault(label, place) for place, label in enumerate(labels)]

    def find(self, place: int) -> int:
        parent = self.parent
        while parent[place] != place:
            parent[place] = parent[parent[place]]
            place = parent[place]
        return place

    def join(self, first: int, second: int) -> bool:
        first, second = self.find(first), self.find(second)
        if first == second:
            return False
        self.parent[max(first, second)] = min(first, second)
        return True


@dataclass
class Member:
    """A set in a unit; without ``tokens`` only its signature is known."""

    label: int
    lead: int  # similar sets mostly have the same
    size: int
    bitmap: bytes
    tokens: np.ndarray | None = None


def member_of(label: int, tokens: np.ndarray) -> Member:
    return Member(label, int(tokens[0]), len(tokens), bitmap_of(tokens), tokens)


@dataclass
class _TreeNode:
    low: int  # the sets low..high-1 of the ordered unit
    high: int
    bitmap: np.ndarray
    least: int
    most: int
    slack: int  # most hashes that share a bit with another one of their set
    children: list[_TreeNode]


class SignatureTree:
    """The sets of a unit, ordered so that similar ones lie together."""

    def __init__(self, members: list[Member], percent: int):
        self.percent = percent
        self.order = sorted(
            range(len(members)), key=lambda i: (members[i].lead, members[i].size)
        )
        ordered = [members[i] for i in self.order]
        self.sets = [member.tokens for member in ordered]
        self.union = _Union([member.label for member in ordered])
        self.sizes = np.array([member.size for member in ordered])
        self.bitmaps = np.stack([np.frombuffer(member.bitmap, np.uint8) for member in ordered])
        self.slacks = self.sizes - np.bitwise_count(self.bitmaps).sum(axis=1, dtype=np.int64)
        self.root = self._build()

    def _build(self) -> _TreeNode:
        level = []
        for low in range(0, len(self.order), LEAF):
            high = min(low + LEAF, len(self.order))
            sizes = self.sizes[low:high]
            level.append(
                _TreeNode(
                    low,
                    high,
                    np.bitwise_or.reduce(self.bitmaps[low:high]),
                    int(sizes.min()),
                    int(sizes.max()),
                    int(self.slacks[low:high].max()),
                    [],
                )
            )
        while len(level) > 1:
            level = [self._over(level[i : i + FAN]) for i in range(0, len(level), FAN)]
        return level[0]

    @staticmethod
    def _over(children: list[_TreeNode]) -> _TreeNode:
        return _TreeNode(
            children[0].low,
            children[-1].high,
            np.bitwise_or.reduce([child.bitmap for child in children]),
            min(child.least for child in children),
            max(child.most for child in children),
            max(child.slack for child in children),
            children,
        )

    def _hopeless(self, first: _TreeNode, second: _TreeNode) -> bool:
        """No set of one can link with a set of the other."""
        if 100 * first.most < self.percent * second.least:
            return True
        if 100 * second.most < self.percent * first.least:
            return True
        common = int(np.bitwise_count(first.bitmap & second.bitmap).sum())
        overlap = common + min(first.slack, second.slack)
        return overlap * (100 + self.percent) < self.percent * (first.least + second.least)

    def _one_component(self, first: _TreeNode, second: _TreeNode) -> bool:
        find = self.union.find
        root = find(first.low)
        return all(find(i) == root for i in range(first.low, first.high)) and all(
            find(i) == root for i in range(second.low, second.high)
        )

    def _compare(self, first: _TreeNode, second: _TreeNode) -> None:
        percent = self.percent
        for i in range(first.low, first.high):
            begin = max(second.low, i + 1)
            if begin >= second.high:
                continue
            sizes = self.sizes[begin : second.high]
            common = np.bitwise_count(self.bitmaps[begin : second.high] & self.bitmaps[i])
            overlap = common.sum(axis=1, dtype=np.int64)
            overlap += np.minimum(self.slacks[begin : second.high], self.slacks[i])
            total = sizes + self.sizes[i]
            hopeful = overlap * (100 + percent) >= percent * total
            for j in (np.flatnonzero(hopeful) + begin).tolist():
                if self.union.find(i) == self.union.find(j):
                    continue
                if self.sets[i] is None or self.sets[j] is None:
                    self.union.join(i, j)  # signatures alone cannot tell them apart
                    continue
                shared = np.intersect1d(self.sets[i], self.sets[j], assume_unique=True)
                if linked(len(shared), len(self.sets[i]), len(self.sets[j]), percent):
                    self.union.join(i, j)

    def components(self) -> list[int]:
        """For each set, as given, the place of the first set of its component."""
        waiting = [(self.root, self.root)]
        while waiting:
            first, second = waiting.pop()
            if self._hopeless(first, second) or self._one_component(first, second):
                continue
            if not first.children and not second.children:
                self._compare(first, second)
            elif first is second:
                parts = first.children
                # Nodes next to each other come off the stack first.
                apart = [(parts[i], parts[j]) for i in range(len(parts)) for j in range(i, len(parts))]
                waiting += sorted(apart, key=lambda pair: pair[0].low - pair[1].low)
            elif first.children and (
                not second.children or first.high - first.low >= second.high - second.low
            ):
                waiting += [(child, second) for child in first.children]
            else:
                waiting += [(first, child) for child in second.children]
        found = [0] * len(self.order)
        for place, original in enumerate(self.order):
            found[original] = self.order[self.union.find(place)]
        return found


# -- the join ----------------------------------------------------------------


def common_tokens(docs: DataFrame, size: int) -> np.ndarray:
    """Sorted hashes of tokens in COMMON_SHARE of the documents or more."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting, held, rows = [], 0, 0

        def flush() -> pd.DataFrame:
            every = np.concatenate([np.empty(0, np.uint64), *waiting])
            values, counts = np.unique(every, return_counts=True)
            kept = counts >= TASK_LEAST
            return pd.DataFrame(
                {"token": values[kept].view(np.int64), "n": counts[kept].astype(np.int64)}
            )

        for batch in batches:
            for text in batch["text"]:
                found = shingle_set(text, size)
                waiting.append(found)
                held += len(found)
                rows += 1
                if held >= TASK_TOKENS:
                    yield flush()
                    waiting, held = [], 0
        yield flush()

    counted = docs.select("text").mapInPandas(run, "token long, n long")
    least = max(2, COMMON_SHARE * docs.count())
    found = counted.groupBy("token").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return np.sort(found.select("token").toPandas()["token"].to_numpy(np.int64).view(np.uint64))


def describe(texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Per row: set size, digest, bitmap, and the set's first and extra tokens.

    The order of tokens is: common ones last, then by hash.
    """
    shared = texts.sparkSession.sparkContext.broadcast(common_tokens(texts, size))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        common = np.append(shared.value, np.uint64(2**64 - 1))
        for batch in batches:
            sizes, digests, prefixes, bitmaps = [], [], [], []
            for text in batch["text"]:
                found = shingle_set(text, size)
                sizes.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                late = common[np.searchsorted(common, found)] == found
                ordered = np.concatenate([found[~late], found[late]])
                length = prefix_length(len(found), percent) + extra_tokens(len(found))
                prefixes.append(ordered[:length].tobytes() if len(found) else b"")
                bitmaps.append(bitmap_of(found))
            yield batch[["doc_id", "text_hash"]].assign(
                n=sizes, digest=digests, prefix=prefixes, bitmap=bitmaps
            )

    key = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInPandas(
        run, f"doc_id {key}, text_hash long, n long, digest binary, prefix binary, bitmap binary"
    )


def _shared_tokens(nodes: DataFrame, percent: int) -> DataFrame:
    """(token, node): first tokens shared by nodes that share enough to link."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tokens = [np.frombuffer(prefix, np.int64) for prefix in batch["prefix"]]
            lengths = list(map(len, tokens))
            first = [
                np.arange(length) < prefix_length(n, percent)
                for length, n in zip(lengths, batch["n"])
            ]
            needed = [shared_needed(n, percent) for n in batch["n"]]
            yield pd.DataFrame(
                {
                    "token": np.concatenate([np.empty(0, np.int64), *tokens]),
                    "node": np.repeat(batch["node"].to_numpy(), lengths),
                    "first": np.concatenate([np.empty(0, bool), *first]),
                    "needed": np.repeat(np.array(needed, np.int32), lengths),
                }
            )

    every = nodes.select("node", "n", "prefix").mapInPandas(
        run, "token long, node long, first boolean, needed int"
    )
    twice = every.groupBy("token").agg(F.count("*").alias("count")).filter("count > 1")
    hits = materialise(every.join(twice.select("token"), "token"), "tree-hits")
    enough = (
        hits.groupBy("node")
        .agg(F.count("*").alias("count"), F.max("needed").alias("needed"))
        .filter("count >= needed")
    )
    kept = materialise(hits.filter("first").join(enough.select("node"), "node"), "tree-first")
    again = kept.groupBy("token").agg(F.count("*").alias("count")).filter("count > 1")
    return kept.join(again.select("token"), "token").select("token", "node")


def _with_text(texts: DataFrame, nodes: DataFrame, members: DataFrame) -> DataFrame:
    """Members of units with the text that stands for their node."""
    keys = members.join(
        nodes.select("node", F.col("text_hash").alias("key"), F.col("doc_id").alias("id")), "node"
    )
    return texts.join(
        keys,
        (texts["text_hash"] == F.col("key")) & texts["doc_id"].eqNullSafe(F.col("id")),
    ).select("unit", "block", "node", "label", "text")


def _walk_units(members: DataFrame, size: int, percent: int) -> DataFrame:
    """Edges found in units: (node, other), no more than one per member.

    ``members``: unit, block, node, label, and either ``text`` (edges are links)
    or ``n``, ``lead`` and ``bitmap`` (edges are what cannot be ruled out). A
    task holds one block of one unit at a time.
    """
    exact = "text" in members.columns
    carried = ["text"] if exact else ["n", "lead", "bitmap"]

    def walk(held: dict[int, Member]) -> list[tuple[int, int]]:
        names, found = list(held), list(held.values())
        roots = SignatureTree(found, percent).components()
        return [
            (names[i], names[root])
            for i, root in enumerate(roots)
            if found[i].label != found[root].label
        ]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, held = None, {}
        edges: list[tuple[int, int]] = []
        for batch in batches:
            values = zip(*(batch[name] for name in carried))
            rows = zip(batch["unit"], batch["block"], batch["node"], batch["label"], values)
            for unit, block, node, label, value in rows:
                if (unit, block) != current:
                    if len(held) > 1:
                        edges += walk(held)
                    current, held = (unit, block), {}
                if node in held:  # a repeated row
                    continue
                if exact:
                    held[node] = member_of(label, shingle_set(value[0], size))
                else:
                    held[node] = Member(label, value[1], value[0], value[2])
            if len(edges) >= 10_000:
                yield pd.DataFrame(edges, columns=["node", "other"])
                edges = []
        if len(held) > 1:
            edges += walk(held)
        yield pd.DataFrame(edges, columns=["node", "other"]).astype("int64")

    return (
        members.select("unit", "block", "node", "label", *carried)
        .repartition("unit", "block")
        .sortWithinPartitions("unit", "block")
        .mapInPandas(run, "node long, other long")
    )


def connect(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over the edges.

    Every round takes the smallest label among the neighbours and then the
    label of that label, so distances shrink by half; each is a stored table.
    """
    both = materialise(
        edges.select("node", "other")
        .union(edges.select("other", "node"))
        .filter("node != other")
        .distinct(),
        "tree-edges",
    )
    labels = materialise(
        both.groupBy("node").agg(F.least("node", F.min("other")).alias("label")), "tree-labels"
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("other"), "label"), "other")
            .groupBy("node")
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node").select(
            "node", F.least("label", "near").alias("label"), F.col("label").alias("before")
        )
        jump = labels.select(F.col("node").alias("at"), F.col("label").alias("further"))
        moved = materialise(
            lower.join(jump, F.col("label") == F.col("at"), "left").select(
                "node",
                F.least("label", "further").alias("label"),
                (F.least("label", "further") != F.col("before")).alias("changed"),
            ),
            "tree-labels",
        )
        labels = moved.select("node", "label")
        if not moved.filter("changed").limit(1).count():
            return labels


def _first_round(tokens: DataFrame) -> DataFrame:
    """Every node in the unit of its smallest shared token, in bounded blocks."""
    unit = materialise(tokens.groupBy("node").agg(F.min("token").alias("unit")), "tree-units")
    sizes = unit.groupBy("unit").agg(F.count("*").alias("size")).filter("size > 1")
    sizes = materialise(sizes, "tree-unit-sizes")
    cuts = F.ceil(F.col("size") / BLOCK).cast("int")
    one, two = F.pmod(F.xxhash64("node"), cuts), F.pmod(F.xxhash64("node", F.lit(1)), cuts)
    blocks = F.when(cuts > 1, F.array(one, cuts + two)).otherwise(F.array(F.lit(0).cast("long")))
    placed = unit.join(bounded_broadcast(sizes), "unit").select(
        "unit", "node", F.explode(blocks.cast("array<string>")).alias("block")
    )
    return placed.withColumn("label", F.col("node"))


def _labelled(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows with their node's component (a node without links is its own)."""
    return nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _near_components(known: DataFrame, edges: DataFrame) -> DataFrame:
    """(unit, node, label): members of components that edges may still join."""
    label_of = known.select("node", "label").distinct()
    ends = edges.join(label_of, "node").select(
        F.col("label").alias("first"), F.col("other").alias("node")
    )
    pairs = ends.join(label_of, "node").select(
        F.col("first").alias("node"), F.col("label").alias("other")
    )
    near = connect(pairs).select(F.col("node").alias("label"), F.col("label").alias("unit"))
    return label_of.join(near, "label").select("unit", "node", "label")


def _mixed_units(known: DataFrame) -> DataFrame:
    """(unit, block, node, label): what has to be walked between components.

    ``known``: (unit, node, label), stored. Units with the same members are
    taken once. A large unit is cut by component; pairs of cuts are blocks, but
    for a component with itself.
    """
    known = known.withColumnRenamed("unit", "token")
    # A component may hold a third of all rows: count it before anything meets.
    by_label = known.groupBy("token", "label").agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("members")
    )
    mixed = (
        by_label.groupBy("token")
        .agg(
            F.sum("n").alias("size"),
            F.sum("members").alias("members"),
            F.count("*").alias("components"),
        )
        .filter("components > 1")
        .groupBy("size", "members")
        .agg(F.min("token").alias("token"))
        .select("token", "size")
    )
    mixed = materialise(mixed, "tree-mixed-units")
    small = known.join(mixed.filter(F.col("size") <= BLOCK).select("token"), "token").select(
        F.col("token").alias("unit"), F.lit("").alias("block"), "node", "label"
    )
    large = bounded_broadcast(mixed.filter(F.col("size") > BLOCK))
    half = BLOCK // 2
    counts = by_label.join(large.select("token"), "token")
    alone = F.col("n") > half
    rest = counts.filter(~alone).groupBy("token").agg(F.sum("n").alias("rest"))
    pieces = materialise(
        counts.join(rest, "token", "left").select(
            "token",
            "label",
            F.when(alone, F.ceil(F.col("n") / half)).cast("int").alias("own_cuts"),
            F.ceil(F.coalesce("rest", F.lit(1)) / half).cast("int").alias("rest_cuts"),
        ),
        "tree-cuts",
    )
    cut = F.when(
        F.col("own_cuts").isNotNull(),
        F.concat_ws("/", "label", F.pmod(F.xxhash64("node"), F.col("own_cuts"))),
    ).otherwise(F.concat_ws("/", F.lit("rest"), F.pmod(F.xxhash64("label"), F.col("rest_cuts"))))
    placed = known.join(pieces, ["token", "label"]).select(
        "token", "node", "label", cut.alias("cut"),
        F.when(F.col("own_cuts").isNotNull(), F.col("label")).alias("pure"),
    )
    cuts = materialise(placed.select("token", "cut", "pure").distinct(), "tree-cut-list")
    other = cuts.select("token", F.col("cut").alias("with"), F.col("pure").alias("pure_with"))
    pairs = (
        cuts.join(other, "token")
        .filter((F.col("cut") <= F.col("with")) & ~F.coalesce(F.col("pure") == F.col("pure_with"), F.lit(False)))
        .select("token", F.explode(F.array_distinct(F.array("cut", "with"))).alias("cut"),
                F.concat_ws("+", "cut", "with").alias("block"))
    )
    hot = placed.join(pairs, ["token", "cut"]).select(
        F.col("token").alias("unit"), "block", "node", "label"
    )
    return small.unionByName(hot)


@dataclass
class Components:
    """``rows``: doc_id, text_hash, n, digest per row of the documents;
    ``classes``: digest, label and the smallest ``doc_id`` of the label."""

    rows: DataFrame
    classes: DataFrame


def find_components(docs: DataFrame, size: int, percent: int) -> Components:
    prepare(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_hash"))
    rows = materialise(describe(texts, size, percent), "tree-rows")
    filled = rows.filter("n > 0")
    # One node per set: the row of the smallest id stands for it.
    stands = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    nodes = filled.groupBy("digest").agg(
        F.min(stands).alias("row"),
        *[F.first(name).alias(name) for name in ("n", "prefix", "bitmap")],
    )
    nodes = materialise(
        nodes.select(
            "digest", "row.doc_id", "row.text_hash", "n", "prefix", "bitmap",
            F.monotonically_increasing_id().alias("node"),
        ),
        "tree-nodes",
    )
    tokens = materialise(_shared_tokens(nodes, percent), "tree-shared")
    members = materialise(_first_round(tokens), "tree-members")
    first = materialise(
        _walk_units(_with_text(texts, nodes, members), size, percent), "tree-links"
    )
    labels = connect(first)
    # What signatures cannot rule out between components, then the exact links.
    known = materialise(_labelled(tokens.withColumnRenamed("token", "unit"), labels), "tree-known")
    lead = F.conv(F.hex(F.substring("prefix", 1, 7)), 16, 10).cast("long").alias("lead")
    signatures = nodes.select("node", "n", lead, "bitmap")
    near = materialise(
        _walk_units(_mixed_units(known).join(signatures, "node"), size, percent), "tree-near"
    )
    near = materialise(_near_components(known, near), "tree-near-units")
    members = materialise(_mixed_units(near), "tree-members")
    second = materialise(
        _walk_units(_with_text(texts, nodes, members), size, percent), "tree-links"
    )
    if second.limit(1).count():
        labels = connect(first.unionByName(second))
    classes = nodes.join(labels, "node", "left").select(
        "digest", F.coalesce("label", "node").alias("label"), "doc_id"
    )
    smallest = classes.groupBy("label").agg(F.min("doc_id").alias("smallest"))
    return Components(
        rows, materialise(classes.drop("doc_id").join(smallest, "label"), "tree-classes")
    )


def components(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """Set size and component of every document, one row per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links (NULL ids
    count only where there is no other). NULL texts, empty ones and those
    without words have an empty set and are linked with nothing: their
    component is their own id. Repeated rows come back each and are one
    component if they have words. Other columns are ignored.
    """
    found = find_components(docs, size, percent)
    empty = found.rows.filter("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")
    )
    filled = found.rows.filter("n > 0").join(found.classes, "digest")
    return empty.unionByName(
        filled.select(
            "doc_id", F.col("n").alias("n_shingles"), F.col("smallest").alias("component_id")
        )
    )


def _has_words(text: Column) -> Column:
    return F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))


def one_per_component(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, all columns unchanged.

    The one with the smallest id stays (NULL ids last), of rows with one id
    and text a single one. Documents without words all stay.
    """
    found = find_components(docs, size, percent)
    filled = found.rows.filter("n > 0").join(found.classes, "digest")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    keepers = filled.groupBy("label").agg(F.min(row).alias("row"))
    same = filled.groupBy("doc_id", "text_hash").agg(F.count("*").alias("rows"))
    names = docs.columns
    key, number, many = (fresh_name(names, wish) for wish in ("text_key", "id_key", "row_count"))
    kept = keepers.select(F.col("row.doc_id").alias(number), F.col("row.text_hash").alias(key))
    kept = kept.join(
        same,
        (kept[key] == same["text_hash"]) & kept[number].eqNullSafe(same["doc_id"]),
    ).select(number, F.col(key).alias(f"{key}_kept"), F.col("rows").alias(many))
    kept = materialise(kept, "tree-kept")
    words = docs.filter(_has_words(F.col("text"))).withColumn(key, F.xxhash64("text"))
    chosen = words.join(
        kept, (words[key] == kept[f"{key}_kept"]) & words["doc_id"].eqNullSafe(kept[number])
    )
    single = chosen.filter(F.col(many) == 1)
    repeated = chosen.filter(F.col(many) > 1).dropDuplicates([number, key])
    plain = [F.col(f"`{name}`") for name in names]
    return (
        docs.filter(~_has_words(F.col("text")))
        .unionByName(single.select(*plain))
        .unionByName(repeated.select(*plain))
    )
