"""URL verdicts: rules first, gradient-boosted trees on lexical features else.

The trees learn from the urls that a rule decides (allow: 0, block: 1) and
judge the others by the form of the url alone. No feature holds the end of the
host, which is what most rules go by: trees that see it repeat the rules and
say nothing of other hosts. Both labels weigh the same together, however many
urls each has. ``held_out`` measures the trees on hosts they have not seen.
Everything is DataFrame functions and Spark's own tree learner.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import bounded_broadcast, prepare
from waymark.session import materialise

# Fixed rules: (verdict, host and path prefix).
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
# Labelled urls that the trees are fitted on (by smallest hash).
TRAINING_ROWS = 20_000
TREES, DEPTH = 12, 3

FEATURES = (
    "n_chars", "host_chars", "path_chars", "depth", "host_labels", "digit_share",
    "hyphen_share", "entropy", "n_parameters", "has_fragment", "secure", "longest_word",
    "ending_share",
)
HELD_OUT_HOSTS = 4  # of so many hosts one is held out when the trees are measured


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(rest, upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as struct(rule, verdict), or NULL."""
    chosen = F.lit(None)
    for verdict, rule in sorted(rules, key=lambda item: len(item[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        found = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, found).otherwise(chosen)
    return chosen


def entropy(text: Column) -> Column:
    """Bits per character."""
    letters = F.split(text, "")
    size = F.size(letters)
    share = F.transform(
        F.array_distinct(letters),
        lambda letter: F.size(F.filter(letters, lambda other: other == letter)) / size,
    )
    return F.aggregate(share, F.lit(0.0), lambda total, p: total - p * F.log2(p))


def lexical_features(pages: DataFrame) -> DataFrame:
    """Adds the features but ``ending_share``, and ``ending``: what follows the
    last point or slash of the path without digits (``html``, or nothing)."""
    url, host, path = (
        F.substring(F.coalesce("url", F.lit("")), 1, 2_000_000_000),
        F.col("host"),
        F.col("path"),
    )
    length = F.greatest(F.char_length(url), F.lit(1))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    return (
        pages.withColumn("n_chars", F.char_length(url).cast("double"))
        .withColumn("host_chars", F.char_length(host).cast("double"))
        .withColumn("path_chars", F.char_length(path).cast("double"))
        .withColumn("depth", F.regexp_count(path, F.lit("/")).cast("double"))
        .withColumn("host_labels", F.regexp_count(host, F.lit(r"\.")).cast("double"))
        .withColumn("digit_share", F.regexp_count(url, F.lit("[0-9]")) / length)
        .withColumn("hyphen_share", F.regexp_count(url, F.lit("-")) / length)
        .withColumn("entropy", entropy(F.concat(F.regexp_replace(host, r"\.[^.]*$", ""), path)))
        .withColumn("n_parameters", F.regexp_count(query, F.lit("[^&]+")).cast("double"))
        .withColumn("has_fragment", F.contains(url, F.lit("#")).cast("double"))
        .withColumn("secure", F.lower(F.substring(url, 1, 8)).eqNullSafe("https://").cast("double"))
        .withColumn(
            "longest_word",
            F.array_max(F.transform(F.split(host, r"[.-]"), F.char_length)).cast("double"),
        )
        .withColumn("ending", F.regexp_replace(F.regexp_extract(path, r"([^./]*)$", 1), "[0-9]+", ""))
    )


def ending_statistics(pages: DataFrame) -> DataFrame:
    """Share of each path ending among all pages, counted over all of them."""
    counted = materialise(pages.groupBy("ending").agg(F.count("*").alias("n")), "url-endings")
    rows = counted.agg(F.sum("n")).head()[0] or 1
    return counted.select("ending", (F.col("n") / F.lit(rows)).alias("ending_share"))


def described(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, url, host, path, found (the rule), label and the features."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    known = (
        pages.select("page_id", "url", host.alias("host"), path.alias("path"))
        .withColumn("found", fitting_rule(F.col("host"), F.col("path"), rules))
        .withColumn("label", (F.col("found.verdict") == "block").cast("double"))
    )
    features = lexical_features(known)
    endings = bounded_broadcast(ending_statistics(features))
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(
        features.join(endings, "ending")
    )


def fit_trees(labelled: DataFrame, rows: int = TRAINING_ROWS):
    """A model of ``label`` over ``features``; None without both labels."""
    spread = F.xxhash64("url")
    sample = labelled.orderBy(spread, "url", "label").limit(rows).select("features", "label")
    stored = materialise(sample.coalesce(1), "url-training")
    counts = {row["label"]: row["count"] for row in stored.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    weight = F.when(F.col("label") == 1, 0.5 / counts[1.0]).otherwise(0.5 / counts[0.0])
    learner = GBTClassifier(
        featuresCol="features",
        labelCol="label",
        weightCol="weight",
        maxIter=TREES,
        maxDepth=DEPTH,
        seed=7,
    )
    weighted = stored.withColumn("weight", weight * F.lit(float(sum(counts.values()))))
    return learner.fit(weighted.coalesce(1))


def held_out(pages: DataFrame, rules=RULES, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """How the trees judge labelled urls of hosts they were not fitted on.

    One row per label that such urls have: label, urls, right (share judged as
    the rule says). Empty where the other hosts have one label alone or none.
    """
    prepare(pages.sparkSession)
    labelled = described(pages, rules).filter(F.col("label").isNotNull())
    apart = F.pmod(F.xxhash64("host"), F.lit(HELD_OUT_HOSTS)) == 0
    model = fit_trees(labelled.filter(~apart).select("url", "features", "label"), training_rows)
    schema = "label double, urls long, right double"
    if model is None:
        return pages.sparkSession.createDataFrame([], schema)
    judged = model.transform(labelled.filter(apart).select("features", "label"))
    right = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    return judged.groupBy("label").agg(F.count("*").alias("urls"), right.alias("right"))


def judge(pages: DataFrame, rules=RULES, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """Host, path, rule and verdict of every page, one row per row.

    NULL urls and urls without ``://`` have an empty host and path, no rule,
    and are judged by the trees like any other. Where all labelled urls agree
    (or there are none) the trees' verdict is that one (or allow). Repeated
    rows come back each; other columns are ignored.
    """
    prepare(pages.sparkSession)
    ready = described(pages, rules)
    labelled = ready.filter(F.col("label").isNotNull())
    model = fit_trees(labelled.select("url", "features", "label"), training_rows)
    if model is None:
        only = labelled.select(F.max("label").alias("label")).head()["label"]
        score = F.lit(float(only or 0.0))
    else:
        ready = model.transform(ready)
        score = vector_to_array("probability")[1]
    scored = ready.withColumn("score", score)
    return scored.select(
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce(
            F.col("found.verdict"), F.when(F.col("score") >= 0.5, "block").otherwise("allow")
        ).alias("verdict"),
        F.round("score", 9).alias("score"),
    )
