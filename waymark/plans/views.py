"""The lookup, geographic and combined views as DataFrame plans.

Each view has a ``…_rows`` step (joins over narrow inputs) and a shaping step
(projection), so that a build can cluster the narrow rows before it widens
them with lines and tokens.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions import codes, ranges, text, tokens
from waymark.operators import skew
from waymark.operators.skew import Side

LOOKUP_COLUMNS = (
    "uprn parent_uprn usrn organisation_name line1 line2 line3 subdivision country_code "
    "local_custodian_code language blpu_state logical_status posttown postcode location "
    "pobox_number local_authority search_tokens"
).split()
GEOGRAPHIC_COLUMNS = (
    "uprn parent_uprn usrn organisation_name line1 line2 line3 town country_code "
    "local_custodian_code post_code search_tokens"
).split()
COMBINED_COLUMNS = (
    "uprn organisation_name line1 line2 line3 town post_code country_code search_tokens"
).split()
# Lookup columns in the order of the combined ones they are united with.
COMBINED_FROM_LOOKUP = (
    "uprn organisation_name line1 line2 line3 posttown postcode country_code search_tokens"
).split()

_DELIVERY_COLUMNS = (
    "uprn organisation_name sub_building_name building_name building_number "
    "dependent_thoroughfare thoroughfare double_dependent_locality dependent_locality "
    "post_town postcode po_box_number"
).split()
_LOOKUP_TOKEN_PARTS = (
    "sub_building_name building_name building_number dependent_thoroughfare thoroughfare "
    "post_town double_dependent_locality dependent_locality administrative_area po_box_number "
    "organisation_name"
).split()
_GEOGRAPHIC_TOKEN_PARTS = "organisation_name line1 line2 line3 town post_code".split()
_PROPERTY_COLUMNS = (
    "uprn parent_uprn logical_status blpu_state latitude longitude local_custodian_code country"
).split()
_RANGE_COLUMNS = [
    f"{prefix}_{part}"
    for prefix in ("sao", "pao")
    for part in ("start_number", "start_suffix", "end_number", "end_suffix", "text")
]

Tables = Mapping[str, DataFrame]


def delivery_points(tables: Tables) -> Side:
    scan = tables["abp_delivery_point"].select(*_DELIVERY_COLUMNS)
    return skew.measured(scan.filter("uprn is not null"), "_delivery_tag", "uprn")


def lookup_properties(tables: Tables) -> Side:
    scan = tables["abp_blpu"].select(*_PROPERTY_COLUMNS)
    return skew.measured(scan.filter("uprn is not null"), "_property_tag", "uprn")


def approved_identifiers(tables: Tables) -> Side:
    """English identifiers with approved status."""
    approved = (F.col("logical_status") == codes.APPROVED) & (F.col("language") == codes.ENGLISH)
    scan = tables["abp_lpi"].filter(approved).filter("uprn is not null and usrn is not null")
    return skew.measured(
        scan.select("uprn", "usrn", "language"), "_identifier_tag", "uprn", "usrn"
    )


def english_descriptors(tables: Tables) -> Side:
    streets = tables["abp_street_descriptor"].filter(F.col("language") == codes.ENGLISH)
    scan = streets.filter("usrn is not null").select("usrn", "language", "administrative_area")
    return skew.measured(scan, "_street_tag", "usrn")


def lookup_rows(tables: Tables) -> DataFrame:
    """Delivery point ⋈ property ⋈ approved identifier ⋈ street descriptor.

    The descriptor goes first, on the two narrow inputs; the other three then
    share one partitioning by ``uprn``. Multiplicity is kept.
    """
    identifiers = approved_identifiers(tables)
    on_street = skew.inner_join(
        [identifiers, english_descriptors(tables)], "usrn", also=("language",)
    )
    return skew.inner_join(
        [delivery_points(tables), lookup_properties(tables), identifiers.derive(on_street)],
        "uprn",
    )


def tie_columns(rows: DataFrame) -> list[str]:
    """Row tags left over from the joins: they cut up the rows of a heavy key."""
    return [name for name in rows.columns if name.endswith("_tag")]


def shape_lookup(rows: DataFrame, postcode_mode: str = "literal") -> DataFrame:
    """The 19 columns of the lookup."""
    shaped = {
        "organisation_name": text.upper_or_null("organisation_name"),
        "line1": text.delivery_line1("po_box_number", "sub_building_name", "building_name"),
        "line2": text.delivery_line2(
            "po_box_number", "building_number", "dependent_thoroughfare", "thoroughfare"
        ),
        "line3": text.delivery_line3("double_dependent_locality", "dependent_locality"),
        "subdivision": codes.subdivision("country"),
        "country_code": codes.country_code("country", "postcode"),
        "language": codes.language_code("language"),
        "posttown": "upper(post_town)",
        "postcode": text.postcode("postcode", postcode_mode),
        "location": text.location("latitude", "longitude"),
        "pobox_number": text.upper_or_null("po_box_number"),
        "local_authority": "administrative_area",
        "search_tokens": tokens.tokens_of_parts(*_LOOKUP_TOKEN_PARTS),
    }
    return rows.selectExpr(*[f"{shaped.get(name, name)} as {name}" for name in LOOKUP_COLUMNS])


def lookup_view(tables: Tables, postcode_mode: str = "literal") -> DataFrame:
    return shape_lookup(lookup_rows(tables), postcode_mode)


def geographic_properties(tables: Tables) -> Side:
    scan = tables["abp_blpu"].select(
        "uprn", "parent_uprn", "local_custodian_code", "country", "postcode_locator"
    )
    return skew.measured(scan.filter("uprn is not null"), "_property_tag", "uprn")


def identifiers_on_streets(tables: Tables, properties: Side | None = None) -> Side:
    """English identifiers with every descriptor of their street.

    The two address lines need nothing else, so they are made here and the ten
    number columns do not travel through the joins by ``uprn``. Where only the
    identifiers of some ``properties`` are wanted, the others go before that.
    """
    english = tables["abp_lpi"].filter(F.col("language") == codes.ENGLISH)
    identifiers = skew.measured(
        english.filter("uprn is not null and usrn is not null").select(
            "uprn", "usrn", "language", *_RANGE_COLUMNS
        ),
        "_identifier_tag",
        "uprn",
        "usrn",
    )
    if properties is not None:
        wanted = skew.semi_join(identifiers, properties.rows.select("uprn"), "uprn")
        identifiers = identifiers.derive(wanted)
    streets = tables["abp_street_descriptor"].filter("usrn is not null")
    descriptors = streets.select(
        "usrn",
        "street_description",
        "locality",
        "town_name",
        F.col("language").alias("street_language"),
    )
    joined = skew.inner_join(
        [identifiers, skew.measured(descriptors, "_street_tag", "usrn")], "usrn"
    )
    return identifiers.derive(
        joined.selectExpr(
            "uprn",
            "usrn",
            f"{ranges.geographic_line1()} as line1",
            f"{ranges.geographic_line2('street_description')} as line2",
            f"{text.empty_for_null('locality')} as line3",
            f"{text.empty_for_null('town_name')} as town",
            "coalesce(street_language = language, false) as takes_organisation",
            *identifiers.carried,
        )
    )


def geographic_rows(
    tables: Tables, properties: Side | None = None, bucketed: bool = False
) -> DataFrame:
    """Property ⋈ identifier ⋈ street descriptor ⟕ organisation.

    A full outer join to the organisations would lose its extra rows again to
    the filter on the identifier's language, so it is a left join.
    ``properties`` restricts the properties taken, and the identifiers to theirs
    before the streets where both are ``bucketed`` alike: elsewhere that would
    cost an exchange of all identifiers.
    """
    on_street = identifiers_on_streets(tables, properties if bucketed else None)
    base = skew.inner_join([properties or geographic_properties(tables), on_street], "uprn")
    organisations = tables["abp_organisation"].filter("uprn is not null")
    return skew.left_join(
        on_street.derive(base),
        skew.measured(
            organisations.select("uprn", "organisation"), "_organisation_tag", "uprn"
        ),
        "uprn",
        "takes_organisation",
    )


def _geographic_columns(rows: DataFrame) -> DataFrame:
    """The geographic columns but for the tokens, which follow from them."""
    shaped = {
        "organisation_name": text.empty_for_null("organisation"),
        "country_code": codes.country_code("country", "postcode_locator"),
        "post_code": text.empty_for_null("postcode_locator"),
    }
    return rows.selectExpr(
        *[f"{shaped.get(name, name)} as {name}" for name in GEOGRAPHIC_COLUMNS[:-1]]
    )


def shape_geographic(rows: DataFrame) -> DataFrame:
    """The 12 columns of the geographic view."""
    made = tokens.tokens_of_parts(*_GEOGRAPHIC_TOKEN_PARTS)
    return _geographic_columns(rows).selectExpr("*", f"{made} as search_tokens")


def geographic_view(tables: Tables) -> DataFrame:
    return shape_geographic(geographic_rows(tables))


def combined_rows(tables: Tables, lookup: DataFrame, buckets: int | None = None) -> DataFrame:
    """Lookup addresses, and geographic ones of properties the lookup lacks.

    The properties are reduced before the geographic joins, so that view is
    planned once and only for the rows needed. The two branches have no key in
    common, therefore removing duplicates inside each gives the same rows as a
    distinct union of both.

    Rows are narrow: tokens of the lookup are one text, and those of geographic
    addresses, which follow from the other columns, are made by
    ``shape_combined``. Duplicates are removed and rows sorted at this width.

    Where the tables have ``buckets`` by property key, the known keys are dealt
    the same way. With the number of the shuffle setting, if larger, the planner
    would give up the buckets and exchange properties and identifiers whole.
    """
    known = lookup.select("uprn").filter("uprn is not null")
    known = (known.repartition(buckets, "uprn") if buckets else known).distinct()
    properties = geographic_properties(tables)
    outside = properties.derive(skew.anti_join(properties, known, "uprn"))
    joined = geographic_rows(tables, outside, bucketed=bool(buckets))
    geographic = _geographic_columns(joined).select(*COMBINED_COLUMNS[:-1])
    addresses = lookup.selectExpr(
        *COMBINED_FROM_LOOKUP[:-1], f"{tokens.tokens_text('search_tokens')} as tokens_text"
    )
    made = geographic.distinct().selectExpr(
        "*", "cast(null as string) as tokens_text", "true as is_geographic"
    )
    return made.union(addresses.distinct().selectExpr("*", "false as is_geographic"))


def shape_combined(rows: DataFrame) -> DataFrame:
    """The 9 columns of the combined view."""
    made = tokens.tokens_of_parts(*_GEOGRAPHIC_TOKEN_PARTS)
    return rows.selectExpr(
        *COMBINED_COLUMNS[:-1],
        f"if(is_geographic, {made}, {tokens.from_text('tokens_text')}) as search_tokens",
    )


def combined_view(tables: Tables, lookup: DataFrame) -> DataFrame:
    """All addresses once: those of the lookup, geographic ones for the rest."""
    return shape_combined(combined_rows(tables, lookup))


def distinct_union(first: DataFrame, second: DataFrame) -> DataFrame:
    """UNION: columns matched by position, duplicates removed.

    Token lists are compared as one text each: a task holds its rows while it
    looks for duplicates, and lists take several times the space.
    """
    lists = [name for name, kind in first.dtypes if kind == tokens.TYPE]

    def written(rows: DataFrame) -> DataFrame:
        renamed = rows.toDF(*first.columns)
        return renamed.withColumns({n: F.expr(tokens.tokens_text(f"`{n}`")) for n in lists})

    rows = written(first).union(written(second)).distinct()
    return rows.withColumns({n: F.expr(tokens.from_text(f"`{n}`")) for n in lists})


def keys_outside(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """EXCEPT of one key column: distinct, NULL equal to NULL."""
    return first.select(key).subtract(second.select(key))
