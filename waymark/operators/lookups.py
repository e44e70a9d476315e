"""Lookups over the published tables, and the layouts that make them cheap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions import text, tokens

_BITS = 60  # lexemes per 64-bit number
CURVE_BITS = 12  # of each column in the key of the curve
SORTED_ROWS = 500_000  # that one task sorts
TOKENISED_ROWS = 50_000  # of a view, whose tokens one task sorts
INDEX_CELLS = 65_536  # of each column in a file index


def _parts(stored: DataFrame, task_rows: int) -> list[int]:
    """A part for every ``task_rows``, where the shuffle setting has fewer parts;
    else none, and adaptive execution merges small ones."""
    setting = int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-stored.count() // task_rows)
    return [wanted] if wanted > setting else []


def clustered(rows: DataFrame, key: str, *ties: str) -> DataFrame:
    """Range-partition by ``key``: narrow min/max per file and row group.

    ``ties`` are further range columns, so that the rows of one heavy key are
    cut over several partitions instead of filling one. ``rows`` are stored:
    they are counted, and read twice by the range exchange.
    """
    parts = _parts(rows, SORTED_ROWS)
    return rows.repartitionByRange(*parts, key, *ties).sortWithinPartitions(key)


def clustered_tokens(view: DataFrame) -> DataFrame:
    """The token rows of a stored view without duplicates, by lexeme and key.

    Equal rows are in one range and next to each other once it is sorted, so
    the range exchange is the only one and no task holds a table of its rows.
    """
    rows = token_table(view)
    columns = ["lexeme", "uprn", "positions"]
    parts = _parts(view, TOKENISED_ROWS)
    ranges = rows.repartitionByRange(*parts, *columns)
    first = F.row_number().over(Window.partitionBy(*columns).orderBy(F.lit(0)))
    return ranges.withColumn("_copy", first).filter("_copy = 1").drop("_copy")


def curve_key(columns: Sequence[str], bits: int = CURVE_BITS) -> str:
    """Place on a space-filling curve: hash bits of the columns, taken in turn.

    Rows that agree in one column share every so many bits of the key, so a
    range of keys holds few of its values, whichever column that is.
    """
    hashes = [f"xxhash64({column})" for column in columns]
    terms = []
    for i in range(bits):
        for j, value in enumerate(hashes):
            target = (bits - i) * len(columns) - j - 1
            terms.append(f"shiftleft(shiftrightunsigned({value}, {63 - i}) & 1L, {target})")
    return " | ".join(terms)


def on_curve(rows: DataFrame, columns: Sequence[str], files: int | None = None) -> DataFrame:
    """Cut the curve into parts; values of each column are in few of them.

    The parts go by the leading bits of the key, about as many as ``files``: a
    cut elsewhere would split the cells of the curve between files.
    """
    files = files or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leading = min(files.bit_length() - 1, CURVE_BITS * len(columns))
    cell = F.shiftright(F.expr(curve_key(columns)), CURVE_BITS * len(columns) - leading)
    return rows.repartitionByRange(files, cell).sortWithinPartitions(F.expr(curve_key(columns)))


def _cell(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(INDEX_CELLS))


def file_index(stored: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Which files of a stored table may hold a value: column, cell, paths.

    A cell is a range of hashes, so the index is no larger than its cells
    times the files a value is in.
    """
    named = [F.struct(F.lit(c).alias("column"), _cell(F.col(c)).alias("cell")) for c in columns]
    listed = stored.select(F.input_file_name().alias("path"), F.inline(F.array(*named)))
    return listed.distinct().groupBy("column", "cell").agg(F.collect_list("path").alias("paths"))


def find_in_files(
    stored: DataFrame, index: DataFrame, column: str, *values
) -> tuple[DataFrame, int]:
    """Rows whose column equals one of the values, and how many files are read.

    Only the files that the index names for the values are opened.
    """
    spark = stored.sparkSession
    kind = stored.schema[column].dataType
    wanted = spark.createDataFrame([(value,) for value in values], "value " + kind.simpleString())
    cells = wanted.select(F.lit(column).alias("column"), _cell(F.col("value")).alias("cell"))
    hits = index.join(F.broadcast(cells.distinct()), ["column", "cell"], "left_semi")
    paths = [row[0] for row in hits.select(F.explode("paths")).distinct().collect()]
    if not paths:
        return stored.limit(0), 0
    rows = spark.read.schema(stored.schema).parquet(*sorted(paths))
    return find(rows, column, *values), len(paths)


def bloom_filtered(*columns: str) -> dict[str, str]:
    """Parquet options: a Bloom filter per row group on each column."""
    options = {f"parquet.bloom.filter.enabled#{column}": "true" for column in columns}
    return options | {"parquet.bloom.filter.adaptive.enabled": "true"}


def with_outcode(lookup: DataFrame) -> DataFrame:
    return lookup.withColumn("outcode", F.expr(text.outcode("postcode")))


def find(table: DataFrame, column: str, *values) -> DataFrame:
    """Rows whose column equals one of the values; pushed to the scan."""
    return table.filter(F.col(column).isin(*values))


def token_table(view: DataFrame, key: str = "uprn", column: str = "search_tokens") -> DataFrame:
    """One row per lexeme of every row: lexeme, key, positions.

    The outer form keeps Spark from adding a filter on the array, which would
    work out the tokens of every row a second time below the join.
    """
    listed = view.selectExpr(key, f"inline_outer({column})")
    return listed.filter("lexeme is not null").select("lexeme", key, "positions")


def keys_with_all(token_rows: DataFrame, lexemes: list[str], key: str = "uprn") -> DataFrame:
    """Keys that have every lexeme, in some of their rows.

    Each lexeme is one bit of a number, so one partial aggregation does it.
    """
    wanted = sorted(set(lexemes))
    seen, complete = [], F.lit(True)
    for i in range(0, len(wanted), _BITS):
        chunk = wanted[i : i + _BITS]
        pairs = [F.lit(x) for j, word in enumerate(chunk) for x in (word, 1 << j)]
        bit = F.element_at(F.create_map(*pairs), F.col("lexeme"))
        seen.append(F.bit_or(bit).alias(f"_seen{i}"))
        complete = complete & (F.col(f"_seen{i}") == (1 << len(chunk)) - 1)
    hits = token_rows.filter(F.col("lexeme").isin(*wanted))
    return hits.groupBy(key).agg(*seen).filter(complete).select(key)


def find_words(
    view: DataFrame,
    lexemes: list[str],
    token_rows: DataFrame | None = None,
    key: str = "uprn",
    column: str = "search_tokens",
) -> DataFrame:
    """Rows that contain all lexemes.

    With a token table the candidate keys come from it; every candidate row is
    checked against its own tokens again, since two rows of one key may hold
    the words between them.
    """
    matches = F.expr(tokens.has_all(column, lexemes))
    if token_rows is None:
        return view.filter(matches)
    candidates = keys_with_all(token_rows, lexemes, key)
    return view.join(candidates, key, "left_semi").filter(matches)
