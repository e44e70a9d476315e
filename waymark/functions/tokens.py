"""Full-text tokens: lexemes with the positions they occur at.

The rule: lower case, runs of letters and digits are words, every word takes a
position, stop words are left out, plural endings are cut from words made of
letters. This approximates an English text-search dictionary; it stems plurals
only.
"""

from __future__ import annotations

from waymark.functions import quoted
from waymark.functions.text import blank_to_null

# English stop words (fixed values).
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs
themselves what which who whom this that these those am is are was were be
been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through
during before after above below to from up down in out on off over under again
further then once here there when where why how all any both each few more
most other some such no nor not only own same so than too very s t can will
just don should now
""".split()

TYPE = "array<struct<lexeme:string,positions:array<int>>>"
WORD_PATTERN = r"[\p{L}\p{N}]+"
# Plural endings, tried in this order; the first that fits decides.
PLURAL_RULES = (
    (r"sses$", "ss"),
    (r"^(.)ies$", "$1ie"),
    (r"ies$", "i"),
    (r"(ss|us)$", "$1"),
    (r"^([a-z]*[aeiouy][a-z]+)s$", "$1"),
)


def stem(word: str) -> str:
    """Cut a plural ending from a word of ASCII letters, three or longer."""
    rules = " ".join(
        f"when {word} rlike {quoted(ending)} "
        f"then regexp_replace({word}, {quoted(ending)}, '{replacement}')"
        for ending, replacement in PLURAL_RULES
    )
    plural = f"endswith({word}, 's') and {word} rlike '^[a-z]{{3,}}$'"
    return f"case when not ({plural}) then {word} {rules} else {word} end"


def tokens(text: str) -> str:
    """Sorted lexemes of a text; a plain array, so it compares and hashes.

    The one-element array makes ``placed`` a variable: it is evaluated once
    per row and not again for every lexeme.
    """
    stops = ", ".join(f"'{word}'" for word in STOP_WORDS)
    placed = (
        f"filter(transform(regexp_extract_all(lower({text}), {quoted(WORD_PATTERN)}, 0), "
        f"(w, i) -> struct(if(w in ({stops}), null, {stem('w')}) as lexeme, i + 1 as position)), "
        "p -> p.lexeme is not null)"
    )
    grouped = (
        "transform(sort_array(array_distinct(placed.lexeme)), x -> struct(x as lexeme, "
        "transform(filter(placed, p -> p.lexeme = x), p -> p.position) as positions))"
    )
    return f"transform(array({placed}), placed -> {grouped})[0]"


def tokens_of_parts(*parts: str) -> str:
    """Tokens of the non-blank parts, joined by one blank."""
    cleaned = ", ".join(blank_to_null(f"cast({part} as string)") for part in parts)
    return tokens(f"concat_ws(' ', {cleaned})")


def tokens_text(value: str) -> str:
    """``high:2,4 street:3``: one string per token list."""
    one = "t -> t.lexeme || ':' || array_join(cast(t.positions as array<string>), ',')"
    return f"array_join(transform({value}, {one}), ' ')"


def from_text(value: str) -> str:
    """The token list that ``tokens_text`` wrote (lexemes hold no separators)."""
    positions = "transform(split(split(t, ':')[1], ','), p -> cast(p as int))"
    listed = (
        f"transform(filter(split({value}, ' '), t -> t <> ''), "
        f"t -> struct(split(t, ':')[0] as lexeme, {positions} as positions))"
    )
    return f"if({value} is null, null, {listed})"


def has_all(value: str, lexemes: list[str]) -> str:
    """All lexemes occur in the row's own token list."""
    return " and ".join(f"array_contains({value}.lexeme, {quoted(x)})" for x in lexemes) or "true"
