"""House-number ranges and the address lines built on them."""

from __future__ import annotations

NUMBER_WIDTH = 4


def number_range(start: str, start_suffix: str, end: str, end_suffix: str) -> str:
    """``12 ``, ``12A, ``, ``12-14 ``, ``12A-14C``: never NULL.

    A suffix has three states: given, empty, absent. Only an empty one leaves
    a blank after its number, and only a given one is printed.
    """
    middle = (
        f"case when {end} is not null then if({start} is not null or {end_suffix} != '', '-', '') "
        f"when {start_suffix} != '' then ', ' "
        f"when {start_suffix} = '' and {start} is not null then ' ' end"
    )
    return (
        f"concat_ws('', left(cast({start} as string), {NUMBER_WIDTH}), {start_suffix}, {middle}, "
        f"left(cast({end} as string), {NUMBER_WIDTH}), "
        f"if({end} is not null and {end_suffix} = '', ' ', ''), {end_suffix})"
    )


def range_of(prefix: str) -> str:
    """The range of the ``sao`` (secondary) or ``pao`` (primary) columns."""
    return number_range(
        f"{prefix}_start_number",
        f"{prefix}_start_suffix",
        f"{prefix}_end_number",
        f"{prefix}_end_suffix",
    )


def geographic_line1() -> str:
    return f"concat_ws('', sao_text, {range_of('sao')})"


def geographic_line2(street: str) -> str:
    return f"concat_ws('', pao_text, {range_of('pao')}, {street})"
