"""Address-shaped inputs derived from the driver's tables.

One text per column, valid in both engines, so that Spark and the DuckDB
oracle start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.session import materialise, work_folder
from waymark.sources import raw
from waymark.sources.layouts import LAYOUTS, RAW_PREFIX, TABLES

_SQL_TYPES = {
    "short": "smallint",
    "int": "int",
    "long": "bigint",
    "double": "double",
    "date": "date",
    "string": "string",
}

# record type -> (source table, row filter, {column: expression})
_SOURCES: dict[str, list[tuple[str, str, dict[str, str]]]] = {
    "10": [
        (
            "region",
            "true",
            {
                "custodian_name": "r_name",
                "volume_number": "r_regionkey",
                "process_date": "'2024-01-31'",
                "version": "'2.1'",
                "file_type": "case when r_regionkey=1 then '' else 'F' end",
            },
        )
    ],
    "11": [
        (
            "nation",
            "true",
            {
                "change_type": "'I'",
                "pro_order": "n_nationkey",
                "usrn": "n_nationkey+1",
                "record_type": "n_regionkey",
                "state": "n_nationkey%4",
                "state_date": "date '2015-01-01' + cast(n_nationkey as int)",
                "street_surface": "1",
                "version": "0",
                "street_start_date": "date '2005-06-01'",
                "street_start_x": "1000+n_nationkey*0.5",
                "street_start_y": "2000+n_nationkey*0.25",
                "street_tolerance": "10",
            },
        )
    ],
    "15": [
        (
            "supplier",
            "true",
            {
                "change_type": "'I'",
                "pro_order": "s_suppkey",
                "usrn": "s_suppkey",
                "street_description": "'STREET '||cast(s_suppkey as varchar(9))",
                "locality": "case when s_suppkey%4=0 then '' "
                "else 'LOC '||cast(s_nationkey as varchar(9)) end",
                "town_name": "'TOWN '||cast(s_nationkey%5 as varchar(9))",
                "administrative_area": "'AREA '||cast(s_nationkey%3 as varchar(9))",
                "language": "'ENG'",
                "start_date": "date '2010-01-01' + cast(s_suppkey%700 as int)",
            },
        ),
        (
            "supplier",
            "s_suppkey%5=0",
            {
                "change_type": "'I'",
                "pro_order": "s_suppkey",
                "usrn": "s_suppkey",
                "street_description": "'STRYD '||cast(s_suppkey as varchar(9))",
                "town_name": "'TREF '||cast(s_nationkey as varchar(9))",
                "administrative_area": "'AREA '||cast(s_nationkey%3 as varchar(9))",
                "language": "'CYM'",
                "start_date": "date '2010-01-01' + cast(s_suppkey%700 as int)",
            },
        ),
    ],
    "21": [
        (
            "customer",
            "true",
            {
                "change_type": "'I'",
                "pro_order": "c_custkey",
                "uprn": "c_custkey",
                "parent_uprn": "case when c_custkey%7=0 and c_custkey>=7 then c_custkey-7 end",
                "logical_status": "case when c_custkey%9=0 then 8 else 1 end",
                "blpu_state": "c_custkey%4+1",
                "blpu_state_date": "date '2012-03-04' + cast(c_custkey%900 as int)",
                "latitude": "cast(49.5 as double)+(c_custkey%40)*cast(0.25 as double)",
                "longitude": "case when c_custkey%13=0 then null "
                "else cast(-5 as double)+(c_custkey%24)*cast(0.25 as double) end",
                "local_custodian_code": "c_nationkey",
                "country": "substr('SEWNLMX',cast(c_nationkey%7+1 as int),1)",
                "postcode_locator": "case when c_custkey%17=0 then '' else "
                "(case when c_custkey%2=0 then 'GY' else 'JE' end)"
                "||cast(c_custkey%99+1 as varchar(9))||' '"
                "||cast(c_custkey%9+1 as varchar(9))||'AB' end",
            },
        )
    ],
    "23": [
        (
            "part",
            "true",
            {
                "change_type": "'I'",
                "pro_order": "p_partkey",
                "uprn": "p_partkey",
                "xref_key": "'X'||cast(p_partkey as varchar(12))",
                "cross_reference": "p_brand||' \"'||p_type||'\", '||cast(p_size as varchar(9))",
                "version": "p_size",
                "source": "case when p_partkey%3=0 then '' else '7666MT' end",
                "start_date": "date '2011-01-01' + cast(p_partkey%800 as int)",
            },
        )
    ],
    "24": [
        (
            "orders",
            "true",
            {
                "change_type": "'I'",
                "pro_order": "o_orderkey",
                "uprn": "o_custkey",
                "lpi_key": "'L'||cast(o_orderkey as varchar(12))",
                "language": "case when o_orderkey%10=0 then 'CYM' else 'ENG' end",
                "logical_status": "case o_orderstatus when 'F' then 1 when 'O' then 6 else 8 end",
                "start_date": "cast(o_orderdate as date)",
                "sao_start_number": "case when o_orderkey%500=7 then 12345 "
                "when o_orderkey%6<3 then o_orderkey%300+1 end",
                "sao_start_suffix": "case o_orderkey%5 when 0 then '' when 1 then 'A' "
                "when 2 then '' end",
                "sao_end_number": "case when o_orderkey%500=19 then 23456 "
                "when o_orderkey%6 in (1,4) then o_orderkey%300+5 end",
                "sao_end_suffix": "case o_orderkey%7 when 0 then 'C' when 1 then '' "
                "when 2 then '' end",
                "sao_text": "case when o_orderkey%8=0 then 'FLAT ' when o_orderkey%8=1 then '' end",
                "pao_start_number": "case when o_orderkey%500=11 then 12345 "
                "when o_orderkey%4<3 then o_orderkey%90+1 end",
                "pao_start_suffix": "case o_orderkey%11 when 0 then 'B' when 1 then '' "
                "when 2 then '' when 3 then '' end",
                "pao_end_number": "case when o_orderkey%500=13 then 23456 "
                "when o_orderkey%4>1 then o_orderkey%90+7 end",
                "pao_end_suffix": "case o_orderkey%9 when 0 then 'D' when 1 then '' "
                "when 2 then '' end",
                "pao_text": "case when o_orderkey%12=0 then 'THE HOUSE ' end",
                "usrn": "o_orderkey%100",
            },
        )
    ],
    "28": [
        (
            "customer",
            "c_custkey%3<>0",
            {
                "change_type": "'I'",
                "pro_order": "c_custkey",
                "uprn": "c_custkey",
                "udprn": "c_custkey+500",
                "organisation_name": "case c_custkey%4 when 0 then ' '||c_mktsegment||' ' "
                "when 1 then '' end",
                "sub_building_name": "case when c_custkey%5=0 "
                "then ' Flat '||cast(c_custkey%30 as varchar(9)) end",
                "building_name": "case when c_custkey%6=0 then 'Rose House' "
                "when c_custkey%6=1 then ' ' end",
                "building_number": "case when c_custkey%8<>0 then c_custkey%200+1 end",
                "dependent_thoroughfare": "case when c_custkey%10=0 then 'Back Lane' end",
                "thoroughfare": "'The High Street'",
                "double_dependent_locality": "case when c_custkey%14=0 then 'Nether' end",
                "dependent_locality": "case when c_custkey%15<3 "
                "then 'Village '||cast(c_custkey%15 as varchar(9)) end",
                "post_town": "'Town '||cast(c_nationkey%5 as varchar(9))",
                "postcode": "substr('GJLM',cast(c_custkey%4+1 as int),1)||'Y'"
                "||cast((case when c_custkey%3=1 then c_custkey%99+1 else c_custkey%9+1 end) "
                "as varchar(9))"
                "||(case when c_custkey%19=0 then '' when c_custkey%3=1 then ' ' else '  ' end)"
                "||cast(c_custkey%9+1 as varchar(9))||'AB'",
                "po_box_number": "case when c_custkey%11=0 "
                "then cast(c_custkey%900 as varchar(9)) end",
            },
        )
    ],
    "29": [
        (
            "region",
            "true",
            {
                "gaz_name": "'Gazetteer of '||r_name",
                "custodian_uprn": "r_regionkey",
                "language": "'ENG'",
                "character_set": "'UTF-8'",
            },
        )
    ],
    "30": [
        (
            "customer",
            "c_custkey%50=0",
            {
                "change_type": "'I'",
                "pro_order": "c_custkey",
                "uprn": "c_custkey",
                "succ_key": "'S'||cast(c_custkey as varchar(12))",
                "successor": "c_custkey+1",
            },
        )
    ],
    "31": [
        (
            "part",
            "true",
            {
                "change_type": "'I'",
                "pro_order": "p_partkey",
                "uprn": "p_partkey",
                "org_key": "'O'||cast(p_partkey as varchar(12))",
                "organisation": "case when p_partkey%5=0 then '' else p_name end",
            },
        )
    ],
    "32": [
        (
            "customer",
            "true",
            {
                "change_type": "'I'",
                "pro_order": "c_custkey",
                "uprn": "c_custkey",
                "class_key": "'C'||cast(c_custkey as varchar(12))",
                "classification_code": "'RD0'||cast(c_custkey%9 as varchar(9))",
                "class_scheme": "'Scheme, \"'||c_mktsegment||'\"'",
                "scheme_version": "1+(c_custkey%4)*0.25",
            },
        )
    ],
    "99": [
        (
            "region",
            "true",
            {"next_volume_number": "r_regionkey+1", "record_count": "r_regionkey*100"},
        )
    ],
}


def _branch_items(record_type: str, expressions: dict[str, str]) -> list[str]:
    items = []
    for f in LAYOUTS[record_type].fields:
        text = expressions.get(f.name, "null")
        if f.name == "record_identifier":
            text = f"'{record_type}'" if f.kind == "string" else record_type
        items.append(f"cast({text} as {_SQL_TYPES[f.kind]}) as {f.name}")
    return items


def record_sql(record_type: str) -> str:
    """All rows of a record type as SQL for DuckDB."""
    return " union all ".join(
        f"select {', '.join(_branch_items(record_type, expressions))} "
        f"from {source} where {condition}"
        for source, condition, expressions in _SOURCES[record_type]
    )


def table_sql(table: str) -> str:
    return record_sql(TABLES[table].record_type)


_readers: dict[tuple[str, str], DataFrame] = {}


def source_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; the reader is kept, so its schema is found once."""
    known = (spark.sparkContext.applicationId, f"{sf_dir}/{name}.parquet")
    if known not in _readers:
        _readers[known] = spark.read.parquet(known[1])
    return _readers[known]


def record_rows(spark: SparkSession, sf_dir: str, record_type: str) -> DataFrame:
    """The same rows as a DataFrame."""
    rows = None
    for source, condition, expressions in _SOURCES[record_type]:
        branch = (
            source_table(spark, sf_dir, source)
            .filter(condition)
            .selectExpr(*_branch_items(record_type, expressions))
        )
        rows = branch if rows is None else rows.unionByName(branch)
    return rows


_stored: dict[tuple[str, str, str], DataFrame] = {}


def table_rows(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Rows of a landing table, stored once per session in a file per core.

    The given tables are one file each; planned and naive plans read the same
    splits.
    """
    known = (spark.sparkContext.applicationId, sf_dir, table)
    if known not in _stored:
        rows = record_rows(spark, sf_dir, TABLES[table].record_type)
        cores = spark.sparkContext.defaultParallelism
        _stored[known] = materialise(rows.repartition(cores), table)
    return _stored[known]


def address_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five tables the views read."""
    names = ("blpu", "lpi", "delivery_point", "street_descriptor", "organisation")
    return {f"abp_{name}": table_rows(spark, sf_dir, f"abp_{name}") for name in names}


def line_expression(record_type: str) -> str:
    """One raw line: NULL is an empty field, text is quoted, the rest bare."""
    parts = []
    for f in LAYOUTS[record_type].fields:
        if f.name == "record_identifier":
            parts.append(f"'{record_type}'")
        elif f.kind == "string":
            quoted = "'\"'||replace({0},'\"','\"\"')||'\"'".format(f.name)
            parts.append(f"coalesce({quoted},'')")
        elif f.kind == "double":
            parts.append(f"coalesce(cast(cast({f.name} as decimal(18,4)) as string),'')")
        else:
            parts.append(f"coalesce(cast({f.name} as string),'')")
    return "||','||".join(parts)


def lines_sql() -> str:
    """All raw lines, with their record type, as SQL for DuckDB."""
    return " union all ".join(
        f"select '{t}' as record_type, {line_expression(t)} as value from ({record_sql(t)})"
        for t in LAYOUTS
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = None
    for record_type in LAYOUTS:
        rows = record_rows(spark, sf_dir, record_type).selectExpr(
            f"{line_expression(record_type)} as value"
        )
        lines = rows if lines is None else lines.unionByName(rows)
    return raw.once(lines)


RAW_FILES = 25
_raw_folders: dict[tuple[str, str], str] = {}


def raw_folder(spark: SparkSession, sf_dir: str) -> str:
    """Raw files written by Spark from the tables, once per session.

    A second file name, of a file that no load may pick up, lies beside them.
    """
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _raw_folders:
        folder = work_folder(spark, "raw")
        lines = raw_lines(spark, sf_dir).repartition(RAW_FILES, F.xxhash64("value"))
        writer = lines.write.option("mapreduce.output.basename", RAW_PREFIX)
        writer.text(folder)
        other = source_table(spark, sf_dir, "region").selectExpr("r_name as value")
        other.write.mode("append").option("mapreduce.output.basename", "Other").text(folder)
        _raw_folders[known] = folder
    return _raw_folders[known]


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file listing: path, length and checksum of every page."""
    return source_table(spark, sf_dir, "pages").select(
        F.col("url").alias("path"),
        F.length("html").cast("bigint").alias("length"),
        F.md5("html").alias("md5"),
    )


_STATUS = (
    "case event_type when 'purchase' then 'finalised' when 'view' then 'completed' "
    "when 'error' then 'errored' when 'signup' then 'schema_created' "
    "else 'creating_view' end"
)
STATUS_ITEMS = [
    "'ab'||cast(user_id as string) as schema_name",
    f"{_STATUS} as status",
    "case when event_type='error' then 'failed at '||cast(event_id as string) end as error_message",
    "ts as timestamp",
    "event_id as seq",
]
STATUS_SQL = f"select {', '.join(STATUS_ITEMS)} from events"


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_table(spark, sf_dir, "events").selectExpr(*STATUS_ITEMS)
