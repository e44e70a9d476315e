"""Main text of web pages: markup rules and a suffix array per host.

A page is read as blocks of text. Scripts, menus, forms, adverts and the like
go by their markup, and a marked article is kept whole, alone: there markup
replaces the method. On pages without one the pages of a host decide: their
token streams are laid end to end, suffixes
are sorted, and runs of RUN tokens or more that occur on different pages are
boilerplate. Blocks that such runs cover are removed; unique runs stay.

Hosts are cut into chunks of pages by hash, so a host with a third of all pages
is many groups of bounded size. Runs that a page shares with pages of other
chunks only are found by a hash of every RUN tokens, counted over the host.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import bounded_broadcast, prepare, shingle_hashes, word_hashes
from waymark.llm.url_trees import host_of
from waymark.session import materialise

RUN = 8  # tokens of a repeated run, at least
COVERED = 0.5  # share of a block's tokens in repeated runs that removes it
CHUNK_CHARS = 1_000_000  # characters of the pages that share a suffix array

# Fixed names of HTML.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math"}
FURNITURE = {
    "nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "object", "head",
}
BLOCK = {
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header",
    "hgroup", "hr", "html", "li", "main", "ol", "p", "pre", "section", "summary", "table",
    "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
} | FURNITURE
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track",
    "wbr",
}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog"}
# Words of a class or id that mark furniture.
MARKS = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "cookie", "cookies", "consent", "footer", "menu", "modal", "nav",
    "navbar", "navigation", "newsletter", "notice", "popup", "promo", "related", "reply",
    "respond", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe",
    "toolbar", "widget",
}

# Those of them that are clear wherever they stand in a class.
CLEAR_MARKS = {
    "ad", "ads", "advert", "adverts", "advertisement", "comments", "cookie", "cookies",
    "newsletter", "promo", "sponsor", "sponsored", "subscribe",
}

# Entries that end the one before, and what such an entry cannot reach out of
# (fixed names).
LISTS = {"ul", "ol", "menu", "dl", "table"}
ENTRIES = {
    "li": ({"li"}, LISTS), "dt": ({"dt", "dd"}, LISTS), "dd": ({"dt", "dd"}, LISTS),
    "tr": ({"tr"}, LISTS), "td": ({"td", "th"}, LISTS | {"tr"}), "th": ({"td", "th"}, LISTS | {"tr"}),
}

_token = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)",
    re.DOTALL,
)
_attribute = re.compile(
    r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE
)
_mark = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    main: bool  # inside a marked article
    tag: str  # the element it stands in


def _is_furniture(tag: str, attributes: str, in_main: bool) -> bool:
    """Whether an element is none of the text, by its name, role, class or id.

    Inside an article, and for an article itself, a class must say so as a
    whole ("share", "social-share"): "share-price" is no sharing bar. Words for
    adverts are clear in any class there too ("ad-slot").
    """
    if tag in FURNITURE or (tag == "header" and not in_main):
        return True
    strict = in_main or tag in ("article", "main")
    for name, value in _attribute.findall(attributes):
        value = value.strip("\"'").lower()
        if name.lower() == "role":
            if value in ROLES:
                return True
        elif tag in ("body", "html"):
            continue
        elif strict:
            named = [_mark.findall(word) for word in value.split()]
            if any(words and MARKS.issuperset(words) for words in named):
                return True
            if in_main and any(CLEAR_MARKS.intersection(words) for words in named):
                return True
        elif MARKS & set(_mark.findall(value)):
            return True
    return False


class _Open:
    """The open elements, with the ends that HTML lets authors leave out."""

    def __init__(self):
        self.names: list[str] = []
        self.counts: Counter = Counter()

    def __len__(self) -> int:
        return len(self.names)

    def push(self, name: str) -> None:
        self.names.append(name)
        self.counts[name] += 1

    def cut(self, depth: int) -> None:
        self.counts.subtract(self.names[depth:])
        del self.names[depth:]

    def begin(self, name: str) -> None:
        """What the start of ``name`` ends: a paragraph, an entry of its list."""
        if name in BLOCK and self.counts["p"]:
            self._end_near({"p"}, BLOCK)
        if name in ENTRIES:
            ended, within = ENTRIES[name]
            if any(self.counts[one] for one in ended):
                self._end_near(ended, within)

    def _end_near(self, ended: set[str], within: set[str]) -> None:
        for depth in range(len(self.names) - 1, -1, -1):
            if self.names[depth] in ended:
                self.cut(depth)
                return
            if self.names[depth] in within:
                return

    def end(self, name: str) -> None:
        """The end tag of the nearest ``name`` ends all inside it; only an
        article's own end tag goes past it."""
        if not self.counts[name]:
            return
        for depth in range(len(self.names) - 1, -1, -1):
            if self.names[depth] == name:
                self.cut(depth)
                return
            if self.names[depth] in ("article", "main") and name not in ("body", "html", "article", "main"):
                return


def read_blocks(html: str, unclosed: bool = False) -> list[Block]:
    """Blocks of text outside furniture, in page order, white space made single.

    Elements whose end tags are left out end with what they stand in. Articles
    inside furniture are furniture; only on a page that never ends a piece of
    furniture (``unclosed``) does an article that begins inside one end it.
    """
    blocks: list[Block] = []
    parts: list[str] = []
    opened = _Open()
    skipped = 0  # depth of the furniture that text stands in, or 0
    lost = False  # an article began inside the furniture that is open
    tag = "body"
    place = 0

    def inside() -> bool:
        return bool(opened.counts["article"] or opened.counts["main"])

    def flush():
        text = " ".join(unescape("".join(parts)).split())
        if text:
            blocks.append(Block(text, inside(), tag))
        parts.clear()

    while place < len(html):
        found = _token.search(html, place)
        if not skipped:
            parts.append(html[place : found.start() if found else len(html)])
        if not found:
            break
        place = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        closing = bool(found[1] or found[4])
        attributes = found[3] or found[6] or ""
        if name in RAW and not closing and not attributes.endswith("/"):
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(html, place)
            place = end.end() if end else len(html)
            continue
        if not skipped and name in BLOCK:
            flush()
            tag = name
        elif not skipped and name == "br":
            parts.append(" ")
        if name in VOID:
            continue
        if closing:
            opened.end(name)
        else:
            opened.begin(name)
        if skipped and len(opened) < skipped:
            skipped, lost = 0, False
            tag = name
        if closing:
            continue
        if skipped and name in ("article", "main"):
            lost = True
            if unclosed:
                opened.cut(skipped - 1)
                skipped, tag = 0, name
        if not skipped and _is_furniture(name, attributes, inside()):
            flush()
            skipped, lost = len(opened) + 1, False
        opened.push(name)
    flush()
    if skipped and lost and not unclosed:
        return read_blocks(html, unclosed=True)
    return blocks


def suffix_groups(stream: np.ndarray) -> np.ndarray:
    """Rank of every suffix by its first RUN tokens: a suffix array cut off there.

    Ranks double the length they stand for until it reaches RUN.
    """
    rank, length = np.unique(stream, return_inverse=True)[1], 1
    while length < RUN:
        ahead = min(length, RUN - length)
        follow = np.full(len(rank), -1, np.int64)
        follow[: max(0, len(rank) - ahead)] = rank[ahead:]
        rank = np.unique(rank * (len(rank) + 1) + follow + 1, return_inverse=True)[1]
        length += ahead
    return rank


def block_tokens(block: Block) -> list[str]:
    return [f"<{block.tag}>", *block.text.split()]


def page_identity(page: list[Block]) -> int:
    """Pages of the same content count as one."""
    content = "\n".join(b.text for b in page).encode("utf-8", "surrogatepass")
    return xxhash.xxh64_intdigest(content) >> 1


def window_hashes(page: list[Block]) -> np.ndarray:
    """Hashes of every RUN tokens of a page, in order."""
    tokens = [t.encode("utf-8", "surrogatepass") for b in page for t in block_tokens(b)]
    return shingle_hashes(word_hashes(tokens), RUN).view(np.int64)


def repeated_tokens(
    pages: list[list[np.ndarray]],
    identity: list[int],
    elsewhere: list[np.ndarray] | None = None,
) -> list[list[float]]:
    """Share of each block's tokens in runs that other, different pages hold.

    Pages with the same ``identity`` (their whole content) count as one.
    ``elsewhere`` has, by page, where runs begin that pages not given here hold.
    """
    if not any(pages):
        return [[] for _ in pages]
    # Runs go from block to block of a page, not from page to page.
    pieces = [part for n, page in enumerate(pages, 1) for part in (*page, [-n])]
    stream = np.concatenate(pieces).astype(np.int64)
    lengths = np.array([sum(map(len, page)) + 1 for page in pages])
    rank = suffix_groups(stream)
    kinds = np.unique(identity, return_inverse=True)[1]
    number = np.repeat(kinds, lengths)
    pairs = np.unique(rank * (int(kinds.max()) + 1) + number) // (int(kinds.max()) + 1)
    often = np.bincount(pairs, minlength=int(rank.max()) + 1)
    starts = np.flatnonzero(often[rank] > 1)
    if elsewhere is not None:
        begins = np.cumsum(lengths) - lengths
        starts = np.concatenate([starts, *[a + b for a, b in zip(begins, elsewhere)]])
    edge = np.zeros(len(stream) + RUN + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + RUN, -1)
    covered = np.cumsum(edge)[: len(stream)] > 0
    covered &= stream >= 0
    known = np.append(0, np.cumsum(covered))
    ends = np.cumsum([len(part) for part in pieces])
    sizes = np.array([len(part) for part in pieces])
    shares = iter(((known[ends] - known[ends - sizes]) / np.maximum(sizes, 1)).tolist())
    found = []
    for page in pages:
        found.append([next(shares) for _ in page])
        next(shares)  # the gap
    return found


def extract(htmls: list[str], windows: np.ndarray | None = None) -> list[str]:
    """Main texts of pages of one host.

    ``windows`` has the hashes of runs that the host repeats beyond these pages.
    """
    read = [read_blocks(html) for html in htmls]
    index: dict[str, int] = {}
    open_blocks = [[b for b in page if not b.main] for page in read]
    streams = [
        [
            np.array(
                [index.setdefault(t, len(index)) for t in block_tokens(b)]
            )
            for b in page
        ]
        for page in open_blocks
    ]
    elsewhere = None
    if windows is not None and len(windows):
        elsewhere = [np.flatnonzero(np.isin(window_hashes(page), windows)) for page in open_blocks]
    shares = repeated_tokens(streams, list(map(page_identity, read)), elsewhere)
    texts = []
    for page, loose, covered in zip(read, open_blocks, shares):
        kept = [b for b in page if b.main]
        if not kept:
            kept = [b for b, share in zip(loose, covered) if share < COVERED]
        texts.append("\n".join(b.text for b in kept))
    return texts


def hot_hosts(pages: DataFrame) -> DataFrame:
    """Hosts with more text than a chunk holds, and their number of chunks."""
    sizes = pages.groupBy("host").agg(F.sum(F.length("html")).alias("chars"))
    chunks = F.ceil(F.col("chars") / CHUNK_CHARS).cast("int")
    return sizes.filter(F.col("chars") > CHUNK_CHARS).select("host", chunks.alias("chunks"))


def host_windows(spread: DataFrame) -> DataFrame:
    """(host, chunk, windows): runs of a chunk that other chunks hold as well.

    Tasks count first; a window's group has one row per task, and its list no
    more than the host's chunks.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for host, chunk, html in zip(batch["host"], batch["chunk"], batch["html"]):
                page = read_blocks(html)
                found = np.unique(window_hashes([b for b in page if not b.main]))
                if len(found):
                    identity = page_identity(page)
                    parts.append(pd.DataFrame({"host": host, "chunk": chunk, "window": found, "low": identity}))
            if parts:
                groups = pd.concat(parts).groupby(["host", "chunk", "window"], sort=False)
                yield groups["low"].agg(low="min", high="max").reset_index()

    found = spread.filter("chunks > 1").select("host", "chunk", "html").mapInPandas(
        run, "host string, chunk int, window long, low long, high long"
    )
    return (
        found.groupBy("host", "window")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.collect_set("chunk").alias("in"))
        .filter((F.col("low") != F.col("high")) & (F.size("in") > 1))
        .select("host", F.explode("in").alias("chunk"), "window")
        .groupBy("host", "chunk")
        .agg(F.collect_list("window").alias("windows"))
    )


def main_text(pages: DataFrame) -> DataFrame:
    """Main text of every page, one row per row: page_id, url, text, n_chars.

    NULL and empty html give ''. A page without a marked article keeps the
    blocks that are not repeated on its host; copies of a page count once, so
    they do not remove each other. Repeated rows come back each; NULL urls form
    a host of their own; other columns are ignored.
    """
    prepare(pages.sparkSession)
    known = pages.select(
        "page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of(F.col("url")).alias("host")
    )
    hot = bounded_broadcast(materialise(hot_hosts(known), "page-hosts"))
    spread = known.join(hot, "host", "left").withColumn(
        "chunk",
        F.pmod(F.xxhash64("page_id", "url", "html"), F.coalesce("chunks", F.lit(1))).cast("int"),
    )
    key = pages.schema["page_id"].dataType.simpleString()
    url = pages.schema["url"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _groups(batches):
            shared = frame["html"].isna()  # the row of the chunk's windows
            windows = [np.asarray(found, np.int64) for found in frame["windows"][shared]]
            frame = frame[~shared]
            texts = extract(frame["html"].tolist(), np.concatenate(windows) if windows else None)
            yield pd.DataFrame(
                {
                    "page_id": frame["page_id"],
                    "url": frame["url"],
                    "text": texts,
                    "n_chars": list(map(len, texts)),
                }
            )

    none = F.lit(None)
    rows = spread.select("host", "chunk", "page_id", "url", "html", none.cast("array<bigint>").alias("windows"))
    shared = host_windows(spread).select(
        "host", "chunk", F.lit("0").try_cast(key).alias("page_id"), none.cast(url).alias("url"),
        none.cast("string").alias("html"), "windows",
    )
    return (
        rows.unionByName(shared)
        .repartition("host", "chunk")
        .sortWithinPartitions("host", "chunk")
        .mapInPandas(run, f"page_id {key}, url {url}, text string, n_chars long")
    )


def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Consecutive rows of the same host and chunk."""
    waiting: list[pd.DataFrame] = []
    current = None
    for batch in batches:
        keys = list(zip(batch["host"], batch["chunk"]))
        start = 0
        for place in range(len(keys) + 1):
            if place < len(keys) and keys[place] == (keys[start] if start < len(keys) else None):
                continue
            if start < place:
                if current is not None and keys[start] != current:
                    yield pd.concat(waiting, ignore_index=True)
                    waiting = []
                current = keys[start]
                waiting.append(batch.iloc[start:place])
            start = place
    if waiting:
        yield pd.concat(waiting, ignore_index=True)

