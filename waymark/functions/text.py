"""Text shaping of address parts."""

from __future__ import annotations

from waymark.functions import quoted


def blank_to_null(x: str) -> str:
    """Trim spaces (only spaces); nothing left means NULL."""
    return f"nullif(trim({x}), '')"


def empty_for_null(x: str) -> str:
    return f"coalesce({x}, '')"


def upper_or_null(x: str) -> str:
    """Upper-cased organisation name or PO box number; NULL when blank."""
    return f"upper({blank_to_null(x)})"


def joined(separator: str, *parts: str) -> str:
    """Non-NULL parts with a separator; '' when there is none."""
    return f"concat_ws('{separator}', {', '.join(parts)})"


def delivery_line1(po_box: str, sub_building: str, building: str) -> str:
    premises = joined(", ", blank_to_null(sub_building), blank_to_null(building))
    return f"upper(coalesce('PO BOX ' || {blank_to_null(po_box)}, {premises}))"


def delivery_line2(po_box: str, number: str, dependent_thoroughfare: str, thoroughfare: str) -> str:
    street = joined(
        " ",
        f"cast({number} as string)",
        blank_to_null(dependent_thoroughfare),
        blank_to_null(thoroughfare),
    )
    return f"if({blank_to_null(po_box)} is null, upper({street}), '')"


def delivery_line3(double_dependent_locality: str, dependent_locality: str) -> str:
    parts = blank_to_null(double_dependent_locality), blank_to_null(dependent_locality)
    return f"upper({joined(' ', *parts)})"


# What counts as space in a postcode (fixed value): blank, backslash, letter t.
# "tidy" is real white space instead.
POSTCODE_SPACE = {"literal": r" \\t", "tidy": r" \t"}


def postcode(x: str, mode: str = "literal") -> str:
    """The first run of space characters becomes one blank; upper case."""
    space = POSTCODE_SPACE[mode]
    first_run = quoted(f"^([^{space}]*)[{space}]+")
    return f"upper(regexp_replace({x}, {first_run}, '$1 '))"


def outcode(x: str) -> str:
    """Text before the first blank, empty when there is none."""
    return f"left({x}, greatest(instr({x}, ' ') - 1, 0))"


def double_text(x: str) -> str:
    """Shortest text of a double: 51, 51.25, 0.0005, 5e-05 (below 1e15)."""
    java = f"cast({x} as string)"
    strip = quoted(r"\.?0+$")
    small = rf"regexp_replace(regexp_replace({java}, r'(\.0)?E-', 'e-'), r'e-(\d)$', 'e-0$1')"
    return (
        f"case when {x} = 0 or abs({x}) >= 1e-3 and abs({x}) < 1e7 "
        rf"then regexp_replace({java}, r'\.0$', '') "
        f"when abs({x}) < 1e-4 then {small} "
        f"else regexp_replace(cast(cast({java} as decimal(38,18)) as string), {strip}, '') end"
    )


def location(latitude: str, longitude: str) -> str:
    return (
        f"concat({empty_for_null(double_text(latitude))}, ',', "
        f"{empty_for_null(double_text(longitude))})"
    )


# Replacements that make a product name safe as an identifier (fixed values).
SAFE_NAME = (("AddressBase Premium ", "ABP"), (".", ""))


def safe_name(x: str) -> str:
    for found, replacement in SAFE_NAME:
        x = f"replace({x}, '{found}', '{replacement}')"
    return x
