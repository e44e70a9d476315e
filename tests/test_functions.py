import itertools

import pytest

from waymark.functions import codes, ranges, text, tokens


def evaluate(spark, expression, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).selectExpr(expression).collect()]


def test_blank_to_null_trims_spaces_only(spark):
    rows = [("  a ",), ("   ",), ("",), (None,), ("\t",)]
    assert evaluate(spark, text.blank_to_null("x"), rows, "x string") == [
        "a", None, None, None, "\t",
    ]


def test_outcode(spark):
    rows = [("AB1 2CD",), ("AB12CD",), (None,), (" X",)]
    assert evaluate(spark, text.outcode("p"), rows, "p string") == ["AB1", "", None, ""]


def test_postcode_literal_and_tidy(spark):
    rows = [("AB1   2CD",), ("AB1  2CD  X",), ("AtB",), ("A\\B",), ("a\tb",), (None,)]
    assert evaluate(spark, text.postcode("p"), rows, "p string") == [
        "AB1 2CD", "AB1 2CD  X", "A B", "A B", "A\tB", None,
    ]
    assert evaluate(spark, text.postcode("p", "tidy"), rows, "p string") == [
        "AB1 2CD", "AB1 2CD  X", "ATB", "A\\B", "A B", None,
    ]


def test_location(spark):
    rows = [(51.0, None), (None, None), (51.5, 0.0005), (-0.1275, 5e-05), (0.0, 100.0)]
    assert evaluate(spark, text.location("a", "b"), rows, "a double, b double") == [
        "51,", ",", "51.5,0.0005", "-0.1275,5e-05", "0,100",
    ]


def test_delivery_lines(spark):
    rows = [
        (" 12 ", "Flat 1", None, 3, " ", "High St"),
        ("  ", " Flat 1", "Rose ", 3, "Back", "High St"),
        (None, None, " ", None, None, None),
    ]
    schema = "po string, sub string, bld string, n short, dep string, tf string"
    assert evaluate(spark, text.delivery_line1("po", "sub", "bld"), rows, schema) == [
        "PO BOX 12", "FLAT 1, ROSE", "",
    ]
    assert evaluate(spark, text.delivery_line2("po", "n", "dep", "tf"), rows, schema) == [
        "", "3 BACK HIGH ST", "",
    ]


def test_codes(spark):
    rows = [("S", "G1"), ("L", "GY1"), ("L", "JE2"), ("L", "X"), ("L", None), ("M", None), (None, "G")]
    assert evaluate(spark, codes.country_code("c", "p"), rows, "c string, p string") == [
        "GB", "GG", "JE", "NOT_FOUND", "NOT_FOUND", "IM", "NOT_FOUND",
    ]
    assert evaluate(spark, codes.subdivision("c"), rows, "c string, p string") == [
        "GB-SCT", None, None, None, None, None, None,
    ]
    assert evaluate(spark, codes.language_code("l"), [("Eng",), ("CYM",), ("x",), (None,)], "l string") == [
        "EN", "CY", None, None,
    ]


@pytest.mark.parametrize(
    ("values", "expected"),
    [
        ((12, "", None, None), "12 "),
        ((12, "A", None, None), "12A, "),
        ((12, "", 14, ""), "12-14 "),
        ((12, "A", 14, "C"), "12A-14C"),
        ((12, None, None, None), "12"),
        ((None, None, None, None), ""),
        ((None, "A", 14, None), "A14"),
        ((None, None, 14, "C"), "-14C"),
        ((None, None, 14, ""), "14 "),
        ((12, "A", None, "C"), "12A, C"),
        ((12, "", None, "C"), "12 C"),
        ((None, "", None, None), ""),
        ((None, "A", None, None), "A, "),
        ((23456, "", 12345, ""), "2345-1234 "),
    ],
)
def test_number_range(spark, values, expected):
    schema = "a short, b string, c short, d string"
    assert evaluate(spark, ranges.number_range("a", "b", "c", "d"), [values], schema) == [expected]


def by_the_rules(start, suffix1, end, suffix2):
    """The five parts of a range, each by its own rule."""
    parts = []
    alone = end is None
    if start is not None:
        parts.append(str(start)[:4] + (" " if suffix1 == "" and alone else ""))
    if suffix1:
        parts.append(suffix1 + (", " if alone else ""))
    if not alone and (start is not None or suffix2):
        parts.append("-")
    if not alone:
        parts.append(str(end)[:4] + (" " if suffix2 == "" else ""))
    if suffix2:
        parts.append(suffix2)
    return "".join(parts)


def test_number_range_all_combinations(spark):
    cases = list(
        itertools.product((None, 7, 12345), (None, "", "A"), (None, 9, 23456), (None, "", "C"))
    )
    schema = "a short, b string, c short, d string"
    found = evaluate(spark, ranges.number_range("a", "b", "c", "d"), cases, schema)
    assert dict(zip(cases, found)) == {case: by_the_rules(*case) for case in cases}


def test_tokens(spark):
    rows = [
        ("The High Street, High Town",),
        ("Ponies TIES glasses gas this Flats 12-14 B's 3S",),
        ("",),
        (None,),
    ]
    assert evaluate(spark, tokens.tokens_text(tokens.tokens("t")), rows, "t string") == [
        "high:2,4 street:3 town:5",
        "12:7 14:8 3s:11 b:9 flat:6 gas:4 glass:3 poni:1 tie:2",
        "",
        None,
    ]


def test_tokens_can_be_made_distinct(spark):
    rows = spark.createDataFrame([("a b high",), ("a b high",), ("low",)], "t string")
    assert rows.selectExpr(f"{tokens.tokens('t')} as x").distinct().count() == 2


def test_has_all(spark):
    rows = [("high street",), ("high",), ("",)]
    value = tokens.tokens("t")
    frame = spark.createDataFrame(rows, "t string").selectExpr(f"{value} as x")
    assert [r[0] for r in frame.selectExpr(tokens.has_all("x", ["high", "street"])).collect()] == [
        True, False, False,
    ]


def test_safe_name(spark):
    rows = [("AddressBase Premium 76.csv",)]
    assert evaluate(spark, text.safe_name("x"), rows, "x string") == ["ABP76csv"]
