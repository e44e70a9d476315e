"""Url verdicts (9), page text (10), the pipeline and the registration."""

import math
import random
import re
import time
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import differences
from waymark.llm import host_suffixes, queries, signature_tree, url_trees

SF = "/root/testdata/sf0.001"
RULES = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}


def plain_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        rule
        for rule in RULES
        if (host == rule.split("/")[0] or host.endswith("." + rule.split("/")[0]))
        and path.startswith(rule[rule.index("/") :])
    ]
    return host, path, max(fits, key=len, default=None)


def test_urls(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    urls = {row["page_id"]: row["url"] for row in pages.collect()}
    rows = url_trees.judge(pages).collect()
    assert len(rows) == len(urls)
    for row in rows:
        host, path, rule = plain_rule(urls[row["page_id"]])
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
        assert row["verdict"] == (RULES[rule] if rule else "block" if row["score"] >= 0.5 else "allow")


def plain_features(url, host, path):
    """The features of a url, without the share of its ending."""
    size = max(1, len(url))
    letters = host.rpartition(".")[0] + path
    counts = [letters.count(c) / len(letters) for c in set(letters)]
    query = url.split("#")[0].split("?", 1)[1] if "?" in url.split("#")[0] else ""
    return [
        len(url), len(host), len(path), path.count("/"), host.count("."),
        sum(c in "0123456789" for c in url) / size, url.count("-") / size,
        -sum(p * math.log2(p) for p in counts), sum(part != "" for part in query.split("&")),
        "#" in url, url[:8].lower() == "https://",
        max(len(word) for word in re.split("[.-]", host)),
    ]


def test_features_against_plain_ones(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = url_trees.described(pages).collect()
    endings = Counter()
    for row in rows:
        endings[re.sub("[0-9]+", "", re.split("[./]", row["path"])[-1])] += 1
    assert len(endings) > 1
    for row in rows:
        *plain, share = row["features"].toArray()
        assert np.allclose(plain, plain_features(row["url"], row["host"], row["path"]))
        ending = re.sub("[0-9]+", "", re.split("[./]", row["path"])[-1])
        assert math.isclose(share, endings[ending] / len(rows))
    # The end of the host alone changes no feature.
    twins = [(1, "http://www.abc.net/es/1.html"), (2, "http://www.abc.org/es/1.html")]
    twins = spark.createDataFrame(twins, "page_id long, url string")
    one, two = [row["features"] for row in url_trees.described(twins).collect()]
    assert one == two


def test_trees_on_hosts_they_have_not_seen(spark):
    """Blocked urls of another form are told apart on new hosts as well."""
    rules = [("block", f"bad{i}.org/") for i in range(20)] + [("allow", f"good{i}.org/") for i in range(60)]
    urls = [f"http://bad{i}.org/win-{j}-now-{j * 7}?a=1&b=2&c={j}" for i in range(20) for j in range(5)]
    urls += [f"http://good{i}.org/story/{'abcde'[j]}word.html" for i in range(60) for j in range(5)]
    unknown = ["http://new.org/win-3-now-9?a=1&b=2&c=4", "http://new.org/story/cword.html"]
    pages = spark.createDataFrame(list(enumerate(urls + unknown)), "page_id long, url string")
    found = {row["label"]: row for row in url_trees.held_out(pages, rules).collect()}
    assert set(found) == {0.0, 1.0} and all(row["right"] > 0.95 for row in found.values())
    verdicts = {row["page_id"]: row["verdict"] for row in url_trees.judge(pages, rules).collect()}
    assert [verdicts[len(urls)], verdicts[len(urls) + 1]] == ["block", "allow"]


def test_verdicts_of_the_trees_are_not_constant(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [row for row in url_trees.judge(pages).collect() if row["rule"] is None]
    shares = Counter(row["verdict"] for row in rows)
    assert min(shares["block"], shares["allow"]) > 0.1 * len(rows)


ODD_URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?a=1#b", "x://example.com",
    "x://example.com/", "x://example.com/en/", "a://b://c.net/fr/", "http://h.net/es/\nx",
    "http://É.com/A", "http://c.org?q=/en/", "http://c.org#/x", "://net/fr/", "http://" + "a" * 5000,
    "http://xcom/", "http://a.xnet/fr/", "http://net/fr", "http://u@www.example.com:80/en/",
]


def test_odd_urls(spark):
    rows = [(i, url, "<p>x</p>", "h", "p", 1.0, "s", 1) for i, url in enumerate(ODD_URLS)]
    rows += [rows[4], (None, "http://a.com/", None, "h", "p", 1.0, "s", 1)]
    schema = (
        "page_id long, url string, html string, host string, path string, label double, "
        "suffix string, chunk int"
    )
    pages = spark.createDataFrame(rows, schema)
    found = url_trees.judge(pages).collect()
    assert len(found) == len(rows)
    for row in found:
        if row["page_id"] is not None:
            assert (row["host"], row["path"], row["rule"]) == plain_rule(ODD_URLS[row["page_id"]])
        assert row["verdict"] in ("allow", "block")
    assert url_trees.judge(pages.limit(0)).count() == 0
    texts = host_suffixes.main_text(pages).collect()
    assert len(texts) == len(rows)
    assert sorted(row["text"] for row in texts) == [""] + ["x"] * (len(rows) - 1)
    assert host_suffixes.main_text(pages.limit(0)).count() == 0


# -- 10 ----------------------------------------------------------------------


STORY = "<article><h1>Title</h1><p>One two three.</p><p>Four five.</p></article>"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        # Reader comments as articles of their own, behind the main one.
        (STORY + '<ol class="comment-list"><li><article class="comment-body">Nice!</article></ol>',
         "Title\nOne two three.\nFour five."),
        # and inside it.
        ("<article><p>Text.</p><article class='comment'>Nice!</article><p>End.</p></article>", "Text.\nEnd."),
        # A teaser article in a side column of a page without a marked article.
        ("<div><p>The story.</p></div><aside><article>teaser</article></aside>", "The story."),
        # Class words that are not furniture.
        ("<article><p class='share-price'>Up 3 %.</p><ul id=notice-board><li>A<li>B</ul></article>",
         "Up 3 %.\nA\nB"),
        ("<article><div class='social share'>Tweet</div><p>Text.</p></article>", "Text."),
        # End tags left out.
        ("<article><p class='promo'>Buy now<p>Second.</p><p>Third.</p></article>", "Second.\nThird."),
        ("<article><ul><li class='share'>Tweet<li>One<li>Two</ul><p>End.</article>", "One\nTwo\nEnd."),
        ("<article><section><div class='promo'>Buy<p>now</section><p>Text.</article>", "Text."),
        # Furniture that never ends, and an article behind it.
        ("<div class='cookie'>We use<article><p>Story.</p></article>", "Story."),
        ("<div class='cookie'>We use</div><article><p>Story.</p></article></div></div>", "Story."),
    ],
)
def test_furniture_and_articles(html, text):
    assert host_suffixes.extract([html]) == [text]


def test_deep_and_broken_pages_are_read_in_linear_time():
    begun = time.time()
    host_suffixes.read_blocks("<div>" * 50_000 + "x" + "</span></b>" * 50_000 + "</div>" * 50_000)
    host_suffixes.read_blocks("<div class=ad><article>x" * 20_000)
    assert time.time() - begun < 20


def article_of(html):
    """The articles of the given test pages, by their known form."""
    body = html.split("<article>", 1)[1].split("</article>")[0].split("<footer>")[0]
    body = re.sub(r"<[^>]*$", "", body)
    from html import unescape

    parts = [unescape(re.sub("<[^>]*>", "", part)) for part in re.split("</?(?:p|h1)>", body)]
    return "\n".join(" ".join(part.split()) for part in parts if part.split())


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    htmls = {row["page_id"]: row["html"] for row in pages.collect()}
    rows = host_suffixes.main_text(pages).collect()
    assert len(rows) == len(htmls)
    for row in rows:
        assert row["text"] == article_of(htmls[row["page_id"]])
        assert row["n_chars"] == len(row["text"])


def test_markup():
    page = """<!doctype html><html><head><title>no</title><style>p{}</style></head>
    <body class="has-sidebar"><header>site</header><nav>menu</nav>
    <div class="cookie-notice">cookies</div><main><header><h1>Title &amp; more</h1></header>
    <p>One <b>bold</b>&nbsp;word<!-- no --> and<br>two.</p><script>if (a < b) "</p>"</script>
    <div class="ad-slot">buy</div><form><input><p>field</p></form><p>Three<p>Four
    <section id="comments"><p>nice post</p></section></main><aside>side</aside>
    <footer>foot</footer></body></html>"""
    assert host_suffixes.extract([page]) == ["Title & more\nOne bold word and two.\nThree\nFour"]
    assert host_suffixes.extract(["", "<p", "a < b & c", "<div class='ad'>x<article>kept"]) == [
        "",
        "",
        "a < b & c",
        "kept",
    ]


def test_repeats_decide_where_nothing_is_marked():
    shared = "this line of ten words stands on every page here"
    own = [" ".join(f"word{i}{j}" for j in range(12)) for i in range(6)]
    pages = [f"<div>{shared}</div><div>{text}</div>" for text in own]
    assert host_suffixes.extract(pages) == own
    # Copies of one page do not remove each other.
    assert host_suffixes.extract([pages[0]] * 3) == [f"{shared}\n{own[0]}"] * 3


def test_markup_before_repeats(spark):
    """A marked article is kept whole; the suffix array decides where none is marked."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    htmls = [row["html"] for row in pages.orderBy("page_id").collect()]
    blocks = [host_suffixes.read_blocks(html) for html in htmls]
    assert blocks and all(block.main for page in blocks for block in page)
    notice = "<p>this notice of ten words stands in every article here</p>"
    marked = [html.replace("</article>", f"{notice}</article>") for html in htmls[:20]]
    bare = [re.sub("</?article>", "", html) for html in marked]
    text = "this notice of ten words stands in every article here"
    assert all(text in found for found in host_suffixes.extract(marked))
    assert not any(text in found for found in host_suffixes.extract(bare))


def test_repeated_menus_of_short_blocks():
    menu = "".join(f"<li>{word}</li>" for word in ("Home", "About", "Contact", "Shop", "Login"))
    foot = "<div>Copyright Us</div><div>Share this</div><p>All rights reserved</p>"
    own = [" ".join(f"word{i}{j}" for j in range(12)) for i in range(6)]
    pages = [f"<ul>{menu}</ul><p>{text}</p>{foot}" for text in own]
    assert host_suffixes.extract(pages) == own
    # No run goes from one page into the next.
    halves = ["<p>a b c d</p>", "<p>e f g h</p>", "<p>a b c d</p><p>x</p>", "<p>e f g h</p><p>y</p>"]
    assert host_suffixes.extract(halves) == ["a b c d", "e f g h", "a b c d\nx", "e f g h\ny"]


def test_suffix_groups():
    rng = random.Random(1)
    stream = np.array([rng.randint(0, 2) for _ in range(400)])
    rank = host_suffixes.suffix_groups(stream)
    keys = [tuple(stream[i : i + host_suffixes.RUN]) for i in range(len(stream))]
    assert [keys[i] for i in np.argsort(rank, kind="stable")] == sorted(keys)
    assert len(set(zip(keys, rank))) == len(set(keys)) == len(set(rank))


def test_hosts_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(host_suffixes, "CHUNK_CHARS", 3000)
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    htmls = {row["page_id"]: row["html"] for row in pages.collect()}
    rows = host_suffixes.main_text(pages).collect()
    assert all(row["text"] == article_of(htmls[row["page_id"]]) for row in rows)


def test_repeats_across_chunks(spark, monkeypatch):
    """Chunks of a host come to the same texts as the host in one piece."""
    shared = "this line of ten words stands on every page here"
    pairs = [f"line {i // 2} that only two pages of this big host share" for i in range(40)]
    own = [" ".join(f"word{i}x{j}" for j in range(12)) for i in range(40)]
    htmls = [f"<div>{shared}</div><p>{a}</p><div>{b}</div>" for a, b in zip(pairs, own)]
    rows = [(i, f"http://big.org/{i}", html) for i, html in enumerate(htmls)]
    rows += [(100 + i, f"http://big.org/copy{i}", "<p>one text that is only ever copied whole</p>") for i in range(5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    whole = {row["page_id"]: row["text"] for row in host_suffixes.main_text(pages).collect()}
    assert [whole[i] for i in range(40)] == own
    monkeypatch.setattr(host_suffixes, "CHUNK_CHARS", 400)
    cut = {row["page_id"]: row["text"] for row in host_suffixes.main_text(pages).collect()}
    assert cut == whole and cut[100] == "one text that is only ever copied whole"


# -- pipeline and registration -----------------------------------------------


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        from waymark.session import materialise

        found.append(materialise(stage(spark, found[-1], SF), "test-stage"))
    return found


def test_stages(spark, stages):
    documents, clean, single, fair, blanked, encoded = stages
    assert all(stage.columns == documents.columns for stage in stages[:-1])
    ids = [{row["doc_id"] for row in stage.select("doc_id").collect()} for stage in stages]
    assert ids[0] > ids[1] > ids[2] >= ids[3] == ids[4] == ids[5]
    # Each component of the stage's own input keeps its smallest id.
    found = signature_tree.components(clean, 5, 80).collect()
    empty = {row["doc_id"] for row in found if not row["n_shingles"]}
    assert ids[2] == {row["component_id"] for row in found} | empty
    text = "\n".join(row["text"] or "" for row in blanked.collect())
    assert not re.search("[0-9a-f]{24}", text)
    assert encoded.count() == blanked.count()


def test_run(spark, stages):
    rows = sorted(corpus_pipeline.run(spark, SF).collect())
    assert rows == sorted(stages[-1].collect())


def test_components_like_their_statement(spark):
    for name, statement in queries.oracle_sql().items():
        assert not differences(spark, SF, queries.queries()[name], statement)[1]


def test_registered():
    names = set(queries.queries())
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in names if n != "pipeline"} == set(range(1, 14))
    assert names <= set(entry.queries()) and set(queries.oracle_sql()) <= names
