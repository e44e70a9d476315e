"""Code mappings: country, subdivision, language."""

from __future__ import annotations

# Fixed values.
SUBDIVISIONS = {"S": "GB-SCT", "E": "GB-ENG", "W": "GB-WLS", "N": "GB-NIR"}
ISLANDS_BY_POSTCODE = {"G": "GG", "J": "JE"}
LANGUAGES = {"eng": "EN", "cym": "CY"}
APPROVED = 1
ENGLISH = "ENG"


def _mapped(key: str, values: dict[str, str]) -> str:
    pairs = ", ".join(f"'{a}', '{b}'" for a, b in values.items())
    return f"element_at(map({pairs}), {key})"


def subdivision(country: str) -> str:
    return _mapped(country, SUBDIVISIONS)


def country_code(country: str, postcode: str) -> str:
    """Country of a property; the islands are told apart by their postcode."""
    mainland = ", ".join(f"'{code}'" for code in SUBDIVISIONS)
    island = _mapped(f"left({postcode}, 1)", ISLANDS_BY_POSTCODE)
    return (
        f"coalesce(case when {country} in ({mainland}) then 'GB' when {country} = 'M' then 'IM' "
        f"when {country} = 'L' then {island} end, 'NOT_FOUND')"
    )


def language_code(language: str) -> str:
    return _mapped(f"lower({language})", LANGUAGES)
