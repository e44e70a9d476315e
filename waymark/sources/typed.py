"""Typed rows from CSV text, with the checks of a strict bulk load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.sources.layouts import Layout

# An unquoted empty field is NULL, a quoted one is the empty string: no text in
# the data equals this NULL marker, so the reader keeps the two apart.
CSV_OPTIONS = {"nullValue": "\u0001", "escape": '"', "dateFormat": "yyyy-MM-dd"}
_BAD = "_unparsed"


def fitted(column: str, width: int) -> str:
    """Drop surplus trailing spaces, as a bulk load into VARCHAR(n) does."""
    return (
        f"if(char_length({column}) > {width}, "
        f"left({column}, {width}) || rtrim(substr({column}, {width + 1})), {column})"
    )


def _fitted_columns(layout: Layout) -> list[str]:
    return [
        f"{fitted(f.name, f.width)} as {f.name}" if f.width else f.name for f in layout.fields
    ]


def too_wide(widths: dict[str, int]) -> str:
    """Names of the columns that exceed their width, NULL when none does.

    It reads the texts as they came, so that ``fitted`` is not worked out for
    every check, and one short test goes over all columns: written out for
    each, the generated code gets too long for the JVM to compile.
    """
    if not widths:
        return "cast(null as string)"
    listed = ", ".join(f"struct('{c}' as name, {c} as text, {n} as width)" for c, n in widths.items())
    over = "char_length(f.text) > f.width and rtrim(substr(f.text, f.width + 1)) <> ''"
    names = f"transform(filter(array({listed}), f -> {over}), f -> f.name)"
    return f"nullif(array_join({names}, ', '), '')"


def _unfitted(lines: DataFrame, layout: Layout) -> DataFrame:
    """Typed columns plus ``problem``, NULL for a line of the right form.

    The parsed row comes out of a generator, so whatever is read of it or
    filtered by, a line is parsed once.
    """
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in layout.schema.fields)
    options = CSV_OPTIONS | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    row = F.from_csv("value", f"{ddl}, {_BAD} string", options)
    return lines.select("value", F.inline(F.array(row))).selectExpr(
        "value", f"if({_BAD} is null, null, 'malformed') as problem", *layout.columns
    )


def _parsed(lines: DataFrame, layout: Layout) -> DataFrame:
    """As above, with surplus blanks cut and over-wide text as a problem too."""
    return _unfitted(lines, layout).selectExpr(
        "value",
        f"coalesce(problem, 'too wide: ' || {too_wide(layout.widths)}) as problem",
        *_fitted_columns(layout),
    )


def _strict(rows: DataFrame, problem: str) -> DataFrame:
    """All rows; one with a problem fails the job, whatever is read of it."""
    return rows.filter(f"if({problem} is null, true, cast(raise_error({problem}) as boolean))")


def parse(lines: DataFrame, layout: Layout, widths: bool = True) -> DataFrame:
    """Typed rows of one record type; any bad line fails the job.

    ``widths=False`` leaves the width check to a table of VARCHAR(n) columns.
    """
    parsed = _parsed(lines, layout) if widths else _unfitted(lines, layout)
    return _strict(parsed, "(problem || ': ' || value)").select(*layout.columns)


def parse_lenient(lines: DataFrame, layout: Layout) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the bad lines with what is wrong with them."""
    parsed = _parsed(lines, layout)
    good = parsed.filter(F.col("problem").isNull()).select(*layout.columns)
    bad = parsed.filter(F.col("problem").isNotNull()).select(
        F.lit(layout.record_type).alias("record_type"), "problem", "value"
    )
    return good, bad


def read_headered_csv(spark: SparkSession, path: str, layout: Layout) -> DataFrame:
    """Positional load of headered CSV: header text ignored, bad rows fatal."""
    rows = (
        spark.read.schema(layout.schema)
        .options(**CSV_OPTIONS)
        .option("header", True)
        .option("enforceSchema", True)
        .option("columnPruning", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    checked = _strict(rows, f"('too wide: ' || {too_wide(layout.widths)})")
    return checked.selectExpr(*_fitted_columns(layout))


def width_counts(rows: DataFrame, widths: dict[str, int]) -> DataFrame:
    """Rows and width violations per column, all columns in one pass."""
    counts = rows.selectExpr(
        "count(*) as n",
        *[f"count_if(char_length({fitted(c, n)}) > {n}) as {c}" for c, n in widths.items()],
    )
    entries = ", ".join(
        f"struct('{c}' as column_name, {n} as width, n as checked, {c} as violations)"
        for c, n in widths.items()
    )
    return counts.selectExpr(f"inline(array({entries}))")


def width_report(rows: DataFrame, layout: Layout) -> DataFrame:
    return width_counts(rows, layout.widths)
