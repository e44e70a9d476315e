"""Salted joins give the rows of plain joins, and do split heavy keys."""

import pytest
from pyspark.sql import functions as F

from checks import derived
from waymark.functions import tokens
from waymark.operators import lookups, skew
from waymark.operators.skew import Side
from waymark.plans import views
from waymark.session import materialise

SF = "/root/testdata/sf0.001"


def same(a, b):
    a, b = a.select(*sorted(a.columns)), b.select(*sorted(b.columns))
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def skewed(spark, name, rows, folder, hot=7):
    """A third of the rows have one key, and a part of those are copies."""
    frame = spark.range(rows).selectExpr(
        f"if(id % 3 = 0, {hot}, id % 50) as k", f"if(id % 3 = 0, id % 5, id) as {name}"
    )
    frame.repartition(4).write.parquet(f"{folder}/{name}")
    return spark.read.parquet(f"{folder}/{name}")


def test_small_tables_are_not_measured(spark, folder):
    side = skew.measured(skewed(spark, "a", 300, folder), "_a_tag", "k")
    assert side.heavy == {} and side.tag is None


def test_heavy_keys_of_many_rows_few_rows_and_none(spark, request):
    rows = spark.range(1_000_000).selectExpr(
        "case when id % 100 < 3 then id % 100 when id % 250 = 50 then -5 else id end as k",
        "if(id % 3 = 0, 'it''s', string(id)) as s",
    )
    assert skew.heavy_keys(rows, "k", "s") == {"k": {}, "s": {}}  # all fit one task
    spark.conf.set(skew.PART_ROWS_KEY, "1500")
    request.addfinalizer(lambda: spark.conf.unset(skew.PART_ROWS_KEY))
    found = skew.heavy_keys(rows, "k", "s")
    assert set(found["k"]) == {0, 1, 2, -5} and set(found["s"]) == {"it's"}
    assert skew.heavy_keys(rows.filter("k = -77"), "k", "s") == {"k": {}, "s": {}}
    assert skew.heavy_keys(rows.selectExpr("cast(null as bigint) as k"), "k") == {"k": {}}


@pytest.mark.usefixtures("salting")
def test_heavy_keys_are_found_and_split(spark, folder):
    table = skewed(spark, "a", 3000, folder)
    side = skew.measured(table, "_a_tag", "k")
    assert side.heavy["k"][7] >= 1000
    small = spark.range(60).selectExpr("id as k", "id * 2 as b")
    spread = skew._spread([side, Side(small)], "k")
    parts = spread.sides[0].filter("k = 7").groupBy("_salt").count().collect()
    assert len(parts) > 40 and max(r["count"] for r in parts) <= 40
    joined = skew.inner_join([side, Side(small)], "k").drop("_a_tag")
    assert same(joined, table.join(small, "k"))


@pytest.mark.usefixtures("salting")
@pytest.mark.parametrize("hot_b", [7, 9])
def test_three_way_inner_join(spark, folder, hot_b):
    a = skewed(spark, "a", 600, folder)
    b = skewed(spark, "b", 300, folder, hot_b)
    c = skewed(spark, "c", 200, folder)
    sides = [skew.measured(t, f"_{n}_tag", "k") for n, t in zip("abc", (a, b, c))]
    joined = skew.inner_join(sides, "k").select("k", "a", "b", "c")
    plain = a.join(b, "k").join(c, "k").select("k", "a", "b", "c")
    assert joined.groupBy("k", "a", "b", "c").count().exceptAll(
        plain.groupBy("k", "a", "b", "c").count()
    ).count() == 0
    assert joined.count() == plain.count()


@pytest.mark.usefixtures("salting")
@pytest.mark.parametrize(("left_rows", "right_rows"), [(600, 90), (90, 600), (600, 600)])
def test_left_join(spark, folder, left_rows, right_rows):
    left = skewed(spark, "a", left_rows, folder).selectExpr("*", "a % 2 = 0 as wanted")
    right = skewed(spark, "b", right_rows, folder).filter("k < 30")
    salted = skew.left_join(
        skew.measured(left, "_a_tag", "k"), skew.measured(right, "_b_tag", "k"), "k", "wanted"
    ).select("k", "a", "b")
    r = right.withColumnRenamed("k", "k2")
    plain = left.join(r, (left.k == r.k2) & left.wanted, "left").select("k", "a", "b")
    assert same(salted, plain)


@pytest.mark.usefixtures("salting")
def test_anti_and_semi_join(spark, folder):
    left = skewed(spark, "a", 900, folder)
    for keys in (spark.range(5, 20), spark.range(8, 20)):
        keys = keys.selectExpr("id as k")
        side = skew.measured(left, "_a_tag", "k")
        assert same(skew.anti_join(side, keys, "k").drop("_a_tag"), left.join(keys, "k", "left_anti"))
        assert same(skew.semi_join(side, keys, "k").drop("_a_tag"), left.join(keys, "k", "left_semi"))


def hot_tables(spark, folder):
    """Address tables where one property and one street hold a third of all."""
    tables = {}
    for name, rows in derived.address_tables(spark, SF).items():
        for key, hot in (("uprn", 40), ("usrn", 8)):
            if key in rows.columns:
                rows = rows.withColumn(key, rows[key] if name == "abp_blpu" else _hot(rows, key, hot))
        rows.coalesce(2).write.parquet(f"{folder}/{name}")
        tables[name] = spark.read.parquet(f"{folder}/{name}")
    return tables


def _hot(rows, key, hot):
    return F.when(F.pmod("pro_order", F.lit(3)) == 0, hot).otherwise(rows[key]).cast(
        rows.schema[key].dataType
    )


def test_views_do_not_change_under_salting(spark, folder):
    tables = hot_tables(spark, folder)
    plain = {
        "lookup": views.lookup_view(tables),
        "geographic": views.geographic_view(tables),
    }
    plain["combined"] = views.combined_view(tables, plain["lookup"])
    stored = {}
    for name, view in plain.items():
        view.write.parquet(f"{folder}/plain_{name}")
        stored[name] = spark.read.parquet(f"{folder}/plain_{name}")
    spark.conf.set("spark.waymark.skew.minBytes", "0")
    spark.conf.set("spark.waymark.skew.partRows", "20")
    try:
        assert views.tie_columns(views.lookup_rows(tables))
        assert same(views.lookup_view(tables), stored["lookup"])
        assert same(views.geographic_view(tables), stored["geographic"])
        assert same(views.combined_view(tables, stored["lookup"]), stored["combined"])
    finally:
        spark.conf.unset("spark.waymark.skew.minBytes")
        spark.conf.unset("spark.waymark.skew.partRows")
    assert all(view.count() for view in stored.values())


def test_combined_is_a_distinct_union(spark):
    tables = derived.address_tables(spark, SF)
    lookup = views.lookup_view(tables)
    geographic = views.geographic_view(tables)
    missing = views.keys_outside(geographic, lookup, "uprn")
    plain = views.distinct_union(
        geographic.join(missing, "uprn").select(*views.COMBINED_COLUMNS),
        lookup.select(*views.COMBINED_FROM_LOOKUP),
    )
    assert same(views.combined_view(tables, lookup), plain)


def test_word_search_checks_each_row(spark):
    view = spark.createDataFrame(
        [(1, "high street"), (1, "low road"), (2, "high road")], "uprn long, t string"
    )
    rows = view.selectExpr("uprn", f"{tokens.tokens('t')} as search_tokens")
    table = lookups.token_table(rows)
    assert {r.uprn for r in lookups.keys_with_all(table, ["high", "road"]).collect()} == {1, 2}
    assert [r.uprn for r in lookups.find_words(rows, ["high", "road"], table).collect()] == [2]
    assert [r.uprn for r in lookups.find_words(rows, ["high", "road"]).collect()] == [2]


def test_tokens_as_text_and_back(spark):
    """Lists, an empty one and none come back as they were."""
    rows = spark.sql(
        f"select 1 as id, {tokens.tokens('\"The High Streets 3, high 3\"')} as found "
        f"union all select 2, {tokens.tokens('\"\"')} union all select 3, null"
    )
    assert dict(rows.dtypes)["found"] == tokens.TYPE
    back = rows.withColumn("found", F.expr(tokens.from_text(tokens.tokens_text("found"))))
    assert back.dtypes == rows.dtypes
    assert back.orderBy("id").collect() == rows.orderBy("id").collect()


def test_duplicates_are_looked_for_in_narrow_rows(spark):
    """No aggregation or exchange of the views' unions carries token lists."""
    tables = derived.address_tables(spark, SF)
    lookup = views.lookup_view(tables)
    both = views.distinct_union(
        views.geographic_view(tables).select(*views.COMBINED_COLUMNS),
        lookup.select(*views.COMBINED_FROM_LOOKUP),
    )
    for view in (both, views.combined_view(tables, materialise(lookup, "lookup"))):
        kinds = _grouped_kinds(view._jdf.queryExecution().optimizedPlan())
        assert "string" in kinds and not any("array" in kind for kind in kinds)


def _grouped_kinds(node):
    """The types that the aggregations of a plan group by."""
    found = []
    if node.nodeName() == "Aggregate":
        keys = node.groupingExpressions()
        found = [keys.apply(i).dataType().simpleString() for i in range(keys.size())]
    for i in range(node.children().size()):
        found += _grouped_kinds(node.children().apply(i))
    return found


def test_token_rows_are_sorted_in_bounded_parts(spark, monkeypatch):
    """More parts than the shuffle setting where tasks would get too many rows;
    the rows of a plain distinct either way, sorted in each part."""
    words = "concat('street ', id % 7, ' street')"
    made = spark.range(300).selectExpr("id % 40 as uprn", f"{tokens.tokens(words)} as search_tokens")
    view = materialise(made.unionByName(made.limit(20)), "view")
    plain = lookups.token_table(view).distinct()
    few = lookups.clustered_tokens(view)
    monkeypatch.setattr(lookups, "TOKENISED_ROWS", 20)
    many = lookups.clustered_tokens(view)
    assert many.rdd.getNumPartitions() == 16
    assert same(few, plain) and same(many, plain)
    parts = many.withColumn("part", F.spark_partition_id()).collect()
    lexemes = [(row["part"], row["lexeme"]) for row in parts]
    assert lexemes == sorted(lexemes)
    monkeypatch.setattr(lookups, "SORTED_ROWS", 20)
    assert lookups.clustered(view, "uprn").rdd.getNumPartitions() == 16
