"""Expressions as Spark SQL text: shaping, code mapping, number ranges, tokens.

Each function takes and returns SQL text, for use in ``selectExpr``, ``F.expr``
or a SQL statement. One text per output column also keeps planning cheap: a
view of 19 shaped columns is one call into the JVM, not thousands.
"""


def quoted(text: str) -> str:
    """A string literal; backslashes inside are taken as they are."""
    return "r'" + text + "'" if "\\" in text else "'" + text.replace("'", "''") + "'"
