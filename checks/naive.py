"""The views as the plainest joins, for timing the planned ones against.

The geographic view is built twice here (once for the keys the lookup lacks,
once for the rows), with all columns carried to the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import derived
from waymark.functions import ranges, text, tokens
from waymark.plans import views


def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = derived.address_tables(spark, sf_dir)
    shared = ["record_identifier", "change_type", "pro_order", "start_date", "end_date",
              "last_update_date", "entry_date"]
    rows = (
        t["abp_delivery_point"]
        .drop(*shared)
        .join(t["abp_blpu"].drop(*shared), "uprn")
        .join(t["abp_lpi"].drop(*shared).withColumnRenamed("logical_status", "s"), "uprn")
        .join(t["abp_street_descriptor"].drop(*shared), ["usrn", "language"])
        .filter("s = 1 and language = 'ENG'")
    )
    return views.shape_lookup(rows)


def geographic(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = derived.address_tables(spark, sf_dir)
    b, l = t["abp_blpu"].alias("b"), t["abp_lpi"].alias("l")
    s, o = t["abp_street_descriptor"].alias("s"), t["abp_organisation"].alias("o")
    rows = (
        b.join(l, F.expr("b.uprn = l.uprn"))
        .join(s, F.expr("l.usrn = s.usrn"))
        .join(o, F.expr("l.uprn = o.uprn and l.language = s.language"), "full")
        .filter("l.language = 'ENG'")
        .selectExpr(
            "l.uprn", "b.parent_uprn", "l.usrn", "o.organisation",
            f"{ranges.geographic_line1()} as line1",
            f"{ranges.geographic_line2('street_description')} as line2",
            f"{text.empty_for_null('s.locality')} as line3",
            f"{text.empty_for_null('s.town_name')} as town",
            "b.country", "b.local_custodian_code", "b.postcode_locator",
        )
    )
    return views.shape_geographic(rows)


def combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    known, local = lookup(spark, sf_dir), geographic(spark, sf_dir)
    missing = views.keys_outside(geographic(spark, sf_dir), known, "uprn")
    return views.distinct_union(
        local.join(missing, "uprn").select(*views.COMBINED_COLUMNS),
        known.select(*views.COMBINED_FROM_LOOKUP),
    )


def queries():
    shown = F.expr(tokens.tokens_text("search_tokens"))
    return {
        name: lambda spark, sf_dir, f=f: f(spark, sf_dir).withColumn("search_tokens", shown)
        for name, f in (
            ("lookup_view", lookup),
            ("geographic_view", geographic),
            ("combined_view", combined),
        )
    }
