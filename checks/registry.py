"""Every registered query: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import derived
from checks.oracle import WORDS
from waymark.functions import codes, ranges, text, tokens
from waymark.operators import lookups, skew
from waymark.operators.skew import Side
from waymark.plans import releases, status, views
from waymark.plans.releases import Releases
from waymark.session import materialise, tune, work_folder
from waymark.sources import integrity, landing, listing, raw, typed
from waymark.sources.layouts import LAYOUTS, RAW_PREFIX
from waymark.streaming import loads, statuses

Query = Callable[[SparkSession, str], DataFrame]
c = F.col


def _rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return derived.table_rows(spark, sf_dir, f"abp_{name}")


def _shown(view: DataFrame) -> DataFrame:
    """Token arrays as one text, so that both engines compare strings."""
    return view.withColumn("search_tokens", F.expr(tokens.tokens_text("search_tokens")))


def _shape(table: str, *items) -> Query:
    return lambda spark, sf_dir: _rows(spark, sf_dir, table).selectExpr(*items)


# -- joins -------------------------------------------------------------------


def _join_delivery_property(spark, sf_dir):
    delivery = _rows(spark, sf_dir, "delivery_point").select("uprn", "udprn")
    properties = _rows(spark, sf_dir, "blpu").select("uprn", "country", "blpu_state")
    return skew.inner_join(
        [
            skew.measured(delivery, "_delivery_tag", "uprn"),
            skew.measured(properties, "_property_tag", "uprn"),
        ],
        "uprn",
    ).select("uprn", "udprn", "country", "blpu_state")


def _property_identifier(spark, sf_dir, approved):
    identifiers = _rows(spark, sf_dir, "lpi")
    if approved:
        identifiers = identifiers.filter(c("logical_status") == codes.APPROVED)
    identifiers = identifiers.select("uprn", "pro_order", "usrn", "language", "logical_status")
    return skew.inner_join(
        [
            skew.measured(_rows(spark, sf_dir, "blpu").select("uprn"), "_property_tag", "uprn"),
            skew.measured(identifiers, "_identifier_tag", "uprn"),
        ],
        "uprn",
    )


def _join_approved(spark, sf_dir):
    return _property_identifier(spark, sf_dir, True).select("uprn", "pro_order", "usrn", "language")


def _join_all_statuses(spark, sf_dir):
    return _property_identifier(spark, sf_dir, False).select(
        "uprn", "pro_order", "usrn", "logical_status"
    )


def _join_identifier_descriptor(spark, sf_dir):
    identifiers = _rows(spark, sf_dir, "lpi").select("uprn", "pro_order", "usrn", "language")
    streets = _rows(spark, sf_dir, "street_descriptor").select(
        "usrn", "language", "administrative_area"
    )
    return skew.inner_join(
        [
            skew.measured(identifiers, "_identifier_tag", "usrn"),
            skew.measured(streets, "_street_tag", "usrn"),
        ],
        "usrn",
        also=("language",),
    ).select("uprn", "pro_order", "usrn", "language", "administrative_area")


def _on_all_streets(spark, sf_dir, *columns) -> Side:
    identifiers = skew.measured(
        _rows(spark, sf_dir, "lpi").select("uprn", "pro_order", "usrn", "language", *columns),
        "_identifier_tag",
        "uprn",
        "usrn",
    )
    streets = _rows(spark, sf_dir, "street_descriptor").select(
        "usrn", "street_description", c("language").alias("street_language")
    )
    return identifiers.derive(
        skew.inner_join([identifiers, skew.measured(streets, "_street_tag", "usrn")], "usrn")
    )


def _join_fanout(spark, sf_dir):
    return _on_all_streets(spark, sf_dir).rows.select(
        "uprn", "pro_order", "usrn", "street_language", "street_description"
    )


def _join_organisation(spark, sf_dir):
    left = _on_all_streets(spark, sf_dir)
    english = left.derive(
        left.rows.filter(c("language") == codes.ENGLISH).withColumn(
            "takes_organisation", c("language") == c("street_language")
        )
    )
    organisations = _rows(spark, sf_dir, "organisation").select("uprn", "organisation")
    return skew.left_join(
        english,
        skew.measured(organisations, "_organisation_tag", "uprn"),
        "uprn",
        "takes_organisation",
    ).select("uprn", "pro_order", "street_language", "organisation")


def _geo_line2(spark, sf_dir):
    columns = [name for name in _rows(spark, sf_dir, "lpi").columns if name.startswith("pao_")]
    return _on_all_streets(spark, sf_dir, *columns).rows.selectExpr(
        "pro_order",
        "street_language as language",
        f"{ranges.geographic_line2('street_description')} as line2",
    )


def _country_lookup(spark, sf_dir):
    delivery = _rows(spark, sf_dir, "delivery_point").select("uprn", "postcode")
    return delivery.join(_rows(spark, sf_dir, "blpu").select("uprn", "country"), "uprn").selectExpr(
        "uprn", f"{codes.country_code('country', 'postcode')} as country_code"
    )


# -- views -------------------------------------------------------------------


def _lookup(spark, sf_dir):
    return views.lookup_view(derived.address_tables(spark, sf_dir))


def _geographic(spark, sf_dir):
    return views.geographic_view(derived.address_tables(spark, sf_dir))


def _combined(spark, sf_dir):
    """The lookup is written first, as a build does, and read twice."""
    tables = derived.address_tables(spark, sf_dir)
    return views.combined_view(tables, materialise(views.lookup_view(tables), "lookup"))


def _keys_except(spark, sf_dir):
    tables = derived.address_tables(spark, sf_dir)
    return views.keys_outside(views.geographic_view(tables), views.lookup_view(tables), "uprn")


def _geo_not_in_lookup(spark, sf_dir):
    tables = derived.address_tables(spark, sf_dir)
    known = views.lookup_rows(tables).select("uprn").distinct()
    properties = views.geographic_properties(tables)
    outside = properties.derive(skew.anti_join(properties, known, "uprn"))
    return _shown(views.shape_geographic(views.geographic_rows(tables, outside)))


def _union_positional(spark, sf_dir):
    tables = derived.address_tables(spark, sf_dir)
    return views.distinct_union(
        _shown(views.geographic_view(tables).select(*views.COMBINED_COLUMNS)),
        _shown(views.lookup_view(tables).select(*views.COMBINED_FROM_LOOKUP)),
    )


def _public_lookup(spark, sf_dir):
    """Through a named view, as readers see it."""
    lookups.with_outcode(_lookup(spark, sf_dir)).createOrReplaceTempView("waymark_lookup_release")
    names = ", ".join(views.LOOKUP_COLUMNS)
    spark.sql(
        "CREATE OR REPLACE TEMP VIEW waymark_lookup_public AS "
        f"SELECT {names} FROM waymark_lookup_release"
    )
    return _shown(spark.table("waymark_lookup_public"))


def _lookup_from_raw(spark, sf_dir):
    """Raw files, landing tables, lookup: the way of a release."""
    release = _release(spark, "lookup")
    landing.load_raw_batch(spark, release, "b0", derived.raw_folder(spark, sf_dir))
    landing.measure_sizes(spark, release)
    return _shown(views.lookup_view(landing.tables(spark, release)))


def _token_table(spark, sf_dir):
    return lookups.token_table(_lookup(spark, sf_dir)).withColumn(
        "positions", F.array_join(c("positions").cast("array<string>"), ",")
    )


def _find_words(spark, sf_dir):
    stored = materialise(_lookup(spark, sf_dir), "lookup")
    token_rows = materialise(lookups.token_table(stored).distinct(), "tokens")
    return _shown(lookups.find_words(stored, list(WORDS), token_rows))


# -- files and loads ---------------------------------------------------------


def _raw(spark, sf_dir):
    return raw.read_raw(spark, derived.raw_folder(spark, sf_dir))


def _route_counts(spark, sf_dir):
    return raw.count_by_type(raw.route(_raw(spark, sf_dir)))


def _route_lines(spark, sf_dir):
    return raw.route(_raw(spark, sf_dir)).select("record_type", "value")


def _parse_typed(spark, sf_dir):
    routed = raw.route(_raw(spark, sf_dir))
    return typed.parse(routed.filter(c("record_type") == "24"), LAYOUTS["24"])


def _load_headered(spark, sf_dir):
    """Written per record type with its header line, then loaded by position."""
    split, target = work_folder(spark, "split"), work_folder(spark, "records")
    raw.write_split(raw.route(_raw(spark, sf_dir)), split)
    raw.write_record_files(raw.read_split(spark, split), target)
    layout = LAYOUTS["28"]
    return typed.read_headered_csv(spark, f"{target}/{layout.file_name}", layout)


def _release(spark: SparkSession, stem: str) -> str:
    """A release database of this run, its files in the shared folder."""
    name = f"{stem}_{work_folder(spark, 'x')[-12:]}"
    spark.sql(f"CREATE DATABASE `{name}` LOCATION '{work_folder(spark, name)}'")
    landing.create_tables(spark, name)
    return name


def _load_counts(spark, sf_dir):
    release = _release(spark, "load")
    landing.load_raw_batch(spark, release, "b0", derived.raw_folder(spark, sf_dir))
    return landing.row_counts(spark, release)


def _stream_load_counts(spark, sf_dir):
    release = _release(spark, "stream")
    query = loads.load_stream(
        spark, release, derived.raw_folder(spark, sf_dir), work_folder(spark, "progress")
    )
    query.awaitTermination()
    return landing.row_counts(spark, release)


def _stream_two_sources(spark, sf_dir):
    """Two streams with the same lines load into one release."""
    release = _release(spark, "streams")
    for _ in range(2):
        loads.load_stream(
            spark, release, derived.raw_folder(spark, sf_dir), work_folder(spark, "progress")
        ).awaitTermination()
    return landing.row_counts(spark, release)


def _load_record_files(spark, sf_dir):
    """Split, headered files of every type, loaded into the nine tables."""
    split, target = work_folder(spark, "split"), work_folder(spark, "records")
    raw.write_split(raw.route(_raw(spark, sf_dir)), split)
    raw.write_record_files(raw.read_split(spark, split), target)
    release = _release(spark, "records")
    landing.load_record_files(spark, release, "b0", target)
    return landing.row_counts(spark, release)


def _load_rejects(spark, sf_dir):
    """Bad lines among the raw ones: what is loaded, and what comes back."""
    nations = derived.source_table(spark, sf_dir, "nation")
    bad = nations.selectExpr("'77,' || n_name as value").union(
        nations.selectExpr("'24,' || n_name as value")
    )
    release = _release(spark, "rejects")
    lines = _raw(spark, sf_dir).select("value").union(bad)
    rejects = landing.load_lines_lenient(
        spark, release, "b0", lines, work_folder(spark, "split")
    )
    loaded = landing.row_counts(spark, release).selectExpr(
        "'loaded' as outcome", "table_name as name", "row_count as n"
    )
    return loaded.union(
        rejects.groupBy(F.coalesce("record_type", F.lit("unknown")).alias("name"))
        .agg(F.count("*").alias("n"))
        .selectExpr("'rejected'", "name", "n")
    )


# -- the life of a release, run once per session and input --------------------

_cycles: dict[tuple[str, str], tuple[Releases, list[str]]] = {}


def _cycle(spark, sf_dir) -> tuple[Releases, list[str]]:
    """Three releases: one published, one superseded and dropped, one new.

    The first is loaded batch by batch from assigned files.
    """
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _cycles:
        stem = work_folder(spark, "x")[-8:]
        work = Releases(spark, control=f"control_{stem}", public=f"public_{stem}")
        created = [datetime(2024, month, 1) for month in (1, 2, 3)]
        names = [f"ab{stem}_{day:%Y%m%d_%H%M%S}" for day in created]
        for name in [work.control, work.public, *names]:
            spark.sql(f"CREATE DATABASE `{name}` LOCATION '{work_folder(spark, name)}'")
        first = work.initialise(stem, created[0])
        files = listing.list_files(spark, derived.raw_folder(spark, sf_dir), f"{RAW_PREFIX}*")
        work.load_batches(first, listing.assign_batches(files.select("path")))
        work.build_lookup(first)
        work.finalise(first)
        work.build_combined(first)
        for day in created[1:]:
            work.initialise(stem, day)
        _cycles[known] = (work, names)
    return _cycles[known]


def _numbered(names: list[str], column: str = "schema_name"):
    place = F.array_position(F.array(*map(F.lit, names)), c(column))
    return place.cast("int").alias("release")


def _cycle_log(spark, sf_dir):
    work, names = _cycle(spark, sf_dir)
    log = spark.table(work.log_table)
    order = Window.partitionBy("schema_name").orderBy("seq")
    return log.select(
        _numbered(names), F.row_number().over(order).cast("int").alias("step"), "status"
    )


def _cycle_live(spark, sf_dir):
    work, names = _cycle(spark, sf_dir)
    return work.list_databases().filter(c("schema_name").isin(names)).select(_numbered(names))


def _cycle_status(spark, sf_dir):
    work, names = _cycle(spark, sf_dir)
    found = [(i + 1, work.status(names[i])["status"], work.lookup_exists(names[i])) for i in (0, 2)]
    return spark.createDataFrame(found, "release int, status string, lookup_exists boolean")


def _cycle_progress(spark, sf_dir):
    _, names = _cycle(spark, sf_dir)
    return spark.table(f"`{names[0]}`.progress").select("result", "messages")


def _cycle_counts(spark, sf_dir):
    _, names = _cycle(spark, sf_dir)
    return landing.row_counts(spark, names[0])


def _cycle_streets(spark, sf_dir):
    work, names = _cycle(spark, sf_dir)
    return work.street_counts([names[0], names[2]]).select(_numbered(names), "n")


def _joint_publication(spark, sf_dir):
    """Both public views while a second release, with fewer rows, is published.

    Steps: the first release; a switch that fails; the second release.
    """
    stem = work_folder(spark, "x")[-8:]
    work = Releases(spark, f"jc_{stem}", f"jp_{stem}", joint=True)
    lines = derived.raw_lines(spark, sf_dir)
    created = [datetime(2024, month, 1) for month in (1, 2)]
    names = [f"ab{stem}_{day:%Y%m%d_%H%M%S}" for day in created]
    for name in [work.control, work.public, *names]:
        spark.sql(f"CREATE DATABASE `{name}` LOCATION '{work_folder(spark, name)}'")
    seen = []

    def look():
        counts = [work.public_table(t).count() for t in (releases.LOOKUP, releases.COMBINED)]
        shown = {names.index(work.public_release(t)) + 1 for t in (releases.LOOKUP, releases.COMBINED)}
        seen.append((len(seen) + 1, *(shown if len(shown) == 1 else [None]), *counts))

    kept = ["true", "value not like '28,%' or split(value, ',')[3] % 2 = 0"]
    for number, (day, condition) in enumerate(zip(created, kept)):
        release = work.initialise(stem, day)
        landing.load_lines(
            spark, release, "b0", lines.filter(condition), work_folder(spark, "split")
        )
        work.build_lookup(release)
        work.build_combined(release, force=True)
        if number:
            move, work._point = work._point, lambda release: 1 // 0
            try:
                work.finalise(release, force=True)
            except ZeroDivisionError:
                look()
            work._point = move
        work.finalise(release, force=True)
        look()
    schema = "step int, release int, lookup_rows long, combined_rows long"
    return spark.createDataFrame(seen, schema)


def _public(table: str) -> Query:
    return lambda spark, sf_dir: _shown(_cycle(spark, sf_dir)[0].public_table(table))


def _stored(spark, sf_dir, table: str):
    """A published table as it is stored: clustered, with Bloom filters."""
    return spark.table(f"`{_cycle(spark, sf_dir)[1][0]}`.`{table}`")


def _stored_find(table: str, column: str, *values) -> Query:
    return lambda spark, sf_dir: _shown(
        lookups.find(_stored(spark, sf_dir, table), column, *values)
    )


def _curve_find(column: str, *values) -> Query:
    """Lookup rows laid out on a curve, found through the index of their files."""

    def query(spark, sf_dir):
        folder = work_folder(spark, "curve")
        rows = lookups.with_outcode(_lookup(spark, sf_dir))
        rows = materialise(rows, "lookup")  # a range exchange reads it twice
        lookups.on_curve(rows, ["uprn", "postcode", "posttown"], files=27).write.parquet(folder)
        stored = spark.read.parquet(folder)
        index = materialise(lookups.file_index(stored, [column]), "file-index")
        return _shown(lookups.find_in_files(stored, index, column, *values)[0])

    return query


def _stored_words(table: str, words: str) -> Query:
    def query(spark, sf_dir):
        work, names = _cycle(spark, sf_dir)
        return _shown(work.find_words(names[0], words, table))

    return query


def _salted(query: Query) -> Query:
    """The same view with every table measured and every key cut at 20 rows."""
    settings = {skew.MIN_BYTES_KEY: "0", skew.PART_ROWS_KEY: "20"}

    def run(spark, sf_dir):
        for key, value in settings.items():
            spark.conf.set(key, value)
        try:
            return materialise(query(spark, sf_dir), "salted")
        finally:
            for key in settings:
                spark.conf.unset(key)

    return run


def _batch_files(spark, sf_dir):
    return listing.assign_batches(derived.files(spark, sf_dir).select("path"))


def _batch_contents(spark, sf_dir):
    return listing.batch_contents(_batch_files(spark, sf_dir)).select(
        "batch", F.array_join("files", " ").alias("files")
    )


def _epoch_of_path(spark, sf_dir):
    files = derived.files(spark, sf_dir)
    return files.select("path", listing.epoch_of(c("path")).alias("epoch"))


def _landing_find(spark, sf_dir):
    """A lookup by property key in a landing table."""
    release = _release(spark, "find")
    landing.load_raw_batch(spark, release, "b0", derived.raw_folder(spark, sf_dir))
    found = lookups.find(landing.tables(spark, release)["abp_lpi"], "uprn", 2, 40, 77, 128)
    return found.select("uprn", "usrn", "lpi_key", "logical_status", "start_date")


def _list_files(spark, sf_dir):
    """The raw files on disk: in which directory, how many, how long."""
    found = listing.list_files(spark, derived.raw_folder(spark, sf_dir), "AddressBasePremium*")
    return found.agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def _file_digest(spark, sf_dir):
    """Digests of files on disk: one per nation, with its customers in order."""
    folder = work_folder(spark, "digested")
    customers = derived.source_table(spark, sf_dir, "customer")
    lines = customers.selectExpr(
        "c_nationkey", "c_custkey", "c_custkey || ',' || c_name || ',' || c_mktsegment as value"
    )
    (
        lines.repartition("c_nationkey")
        .sortWithinPartitions("c_nationkey", "c_custkey")
        .select("c_nationkey", "value")
        .write.partitionBy("c_nationkey")
        .text(folder)
    )
    nation = F.regexp_extract("path", "c_nationkey=([0-9]+)", 1).cast("int")
    found = integrity.file_checksums(spark, folder)
    return found.select(nation.alias("nation"), "length", "md5")


def _batch_commit(spark, sf_dir):
    """Rows per table after a batch, after one that fails, and after its repeat."""
    release = _release(spark, "commit")
    folder = derived.raw_folder(spark, sf_dir)
    landing.load_raw_batch(spark, release, "b0", folder)
    steps = [materialise(landing.row_counts(spark, release), "counts")]
    # The last table's lines are too wide for it; all others can be loaded.
    wide = derived.raw_lines(spark, sf_dir).unionByName(
        derived.source_table(spark, sf_dir, "region").selectExpr(
            "'30,I,1,' || r_regionkey || ',' || repeat('x', 99) || ',,,,,' as value"
        )
    )
    try:
        landing.load_lines(spark, release, "b1", wide, work_folder(spark, "split"))
    except Exception as failure:
        if "length limitation" not in str(failure):
            raise
        steps.append(materialise(landing.row_counts(spark, release), "counts"))
    landing.load_raw_batch(spark, release, "b1", folder)
    steps.append(landing.row_counts(spark, release))
    result = None
    for number, counts in enumerate(steps, 1):
        numbered = counts.withColumn("step", F.lit(number))
        result = numbered if result is None else result.unionByName(numbered)
    return result


def _changed_identifiers(spark, sf_dir):
    """Change-only lines: updates and deletions of identifiers, and new ones."""
    rows = derived.record_rows(spark, sf_dir, "24")
    order = F.regexp_extract("lpi_key", "([0-9]+)", 1).cast("long")

    def changed(kind, when, step):
        return (
            rows.filter(when)
            .withColumn("change_type", F.lit(kind))
            .withColumn("pro_order", c("pro_order") + step * 10_000_000)
            .withColumn("usrn", c("usrn") + 1)
        )

    changes = changed("U", (order % 13 == 0) | (order % 22 == 0), 1).unionByName(
        changed("D", order % 11 == 0, 2)
    )
    new = changed("I", order % 17 == 0, 1).withColumn("lpi_key", F.concat(F.lit("N"), "lpi_key"))
    return changes.unionByName(new).selectExpr(f"{derived.line_expression('24')} as value")


def _change_only(spark, sf_dir):
    """Identifiers after a batch of changes, merged and then folded into one batch."""
    release = _release(spark, "changes")
    landing.load_raw_batch(spark, release, "b0", derived.raw_folder(spark, sf_dir))
    lines = _changed_identifiers(spark, sf_dir)
    landing.load_lines(spark, release, "b1", lines, work_folder(spark, "split"))
    landing.fold_changes(spark, release)
    found = landing.tables(spark, release)["abp_lpi"]
    return found.select("uprn", "lpi_key", "usrn", "change_type", "pro_order")


def _stream_rejects(spark, sf_dir):
    """Bad lines in a stream: rejects of each record type beside the rows."""
    release = _release(spark, "lenient")
    folder = work_folder(spark, "mixed")
    nations = derived.source_table(spark, sf_dir, "nation")
    bad = nations.selectExpr("'77,' || n_name as value").union(
        nations.selectExpr("'24,' || n_name as value")
    )
    lines = derived.raw_lines(spark, sf_dir).unionByName(bad).repartition(25, F.xxhash64("value"))
    lines.write.option("mapreduce.output.basename", RAW_PREFIX).text(folder)
    for _ in range(2):  # the second run replaces what the first one has loaded
        loads.load_stream(
            spark, release, folder, work_folder(spark, "progress"), source="s", lenient=True
        ).awaitTermination()
    loaded = landing.row_counts(spark, release).selectExpr(
        "'loaded' as outcome", "table_name as name", "row_count as n"
    )
    rejected = landing.rejects(spark, release)
    return loaded.union(
        rejected.groupBy(F.coalesce("record_type", F.lit("unknown")).alias("name"))
        .agg(F.count("*").alias("n"))
        .selectExpr("'rejected'", "name", "n")
    )


def _min_size(spark, sf_dir):
    kind = F.when(c("page_id") % 5 == 4, "XX").when(c("page_id") % 2 == 0, "GB").otherwise("IS")
    bundles = derived.source_table(spark, sf_dir, "pages").select(
        "page_id",
        F.concat(F.lit("AB76"), kind, F.lit("_CSV.zip")).alias("file_name"),
        (F.length("html").cast("bigint") * 1_000_000).alias("length"),
    )
    return integrity.size_report(bundles)


def _md5(spark, sf_dir):
    pages = derived.source_table(spark, sf_dir, "pages")
    required = F.when(c("page_id") % 4 == 3, F.md5(F.concat("html", F.lit(" ")))).otherwise(
        F.md5("html")
    )
    manifest = pages.select(c("url").alias("path"), required.alias("required_md5"))
    return integrity.checksum_report(derived.files(spark, sf_dir), manifest)


def _width(spark, sf_dir):
    return typed.width_report(_rows(spark, sf_dir, "delivery_point"), LAYOUTS["28"])


def _width_documents(spark, sf_dir):
    """The same check on text that does break the limits."""
    widths = (("lang", 1), ("source", 6), ("text", 900))
    documents = derived.source_table(spark, sf_dir, "documents")
    return typed.width_counts(documents, dict(widths))


# -- releases ----------------------------------------------------------------


def _latest(spark, sf_dir):
    return status.latest(derived.status_log(spark, sf_dir))


def _previous_finalised(spark, sf_dir):
    current = _latest(spark, sf_dir)
    newest = status.newest_finalised(current).head()
    return status.newest_finalised(current, newest["schema_name"] if newest else None)


def _months(spark, sf_dir):
    month = F.trunc(c("o_orderdate").cast("date"), "month").alias("month")
    return (
        derived.source_table(spark, sf_dir, "orders").groupBy(month).agg(F.count("*").alias("n"))
    )


def _release_counts(spark, sf_dir):
    return _months(spark, sf_dir).select(F.date_format("month", "yyyyMM").alias("release"), "n")


def _tolerance(spark, sf_dir):
    new = _months(spark, sf_dir)
    old = new.select(F.add_months("month", 1).alias("month"), c("n").alias("old_n"))
    change = F.coalesce(status.percentage_change(c("n"), c("old_n")), F.lit(0.0))
    return new.join(old, "month", "left").select(
        F.date_format("month", "yyyyMM").alias("release"),
        c("n").alias("new_n"),
        "old_n",
        change.alias("change_percent"),
        status.within_tolerance(c("n"), c("old_n")).alias("within_tolerance"),
    )


def _finalise(spark, sf_dir):
    """The newest completed release against the newest finalised one."""
    log = derived.status_log(spark, sf_dir)
    current = status.latest(log)
    newest = (
        current.filter(c("status") == status.COMPLETED)
        .orderBy(F.desc("timestamp"), "schema_name")
        .first()
    )
    sizes = log.groupBy("schema_name").agg(F.count("*").alias("n"))
    return status.finalise_decision(current, sizes, newest["schema_name"])


def _cleanup(spark, sf_dir):
    directories = (
        derived.source_table(spark, sf_dir, "orders")
        .select(F.concat(F.lit("/data/"), F.year("o_orderdate").cast("string")).alias("directory"))
        .distinct()
    )
    return status.cleanup_plan(directories, "2000")


def _status_stream(spark, sf_dir):
    transitions, target = work_folder(spark, "transitions"), work_folder(spark, "latest")
    derived.status_log(spark, sf_dir).write.parquet(transitions)
    stream = statuses.status_stream(spark, transitions)
    statuses.keep_latest(stream, target, work_folder(spark, "progress")).awaitTermination()
    return statuses.read_latest(spark, target)


def _where(query: Query, column: str, *values) -> Query:
    return lambda spark, sf_dir: _shown(lookups.find(query(spark, sf_dir), column, *values))


def _safe_name(spark, sf_dir):
    name = "'AddressBase Premium ' || c_name || '.v' || cast(c_acctbal as string)"
    return derived.source_table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", f"{text.safe_name(name)} as safe_name"
    )


def _column(table: str, key: str, name: str, expression: str) -> Query:
    return _shape(table, key, f"{expression} as {name}")


_QUERIES: dict[str, Query] = {
    # shaping
    "shape_blank_to_null": _shape(
        "delivery_point",
        "uprn",
        f"{text.blank_to_null('organisation_name')} as organisation_name",
        f"{text.blank_to_null('building_name')} as building_name",
    ),
    "shape_org_name": _column(
        "delivery_point", "uprn", "organisation_name", text.upper_or_null("organisation_name")
    ),
    "shape_dp_line1": _column(
        "delivery_point",
        "uprn",
        "line1",
        text.delivery_line1("po_box_number", "sub_building_name", "building_name"),
    ),
    "shape_dp_line2": _column(
        "delivery_point",
        "uprn",
        "line2",
        text.delivery_line2(
            "po_box_number", "building_number", "dependent_thoroughfare", "thoroughfare"
        ),
    ),
    "shape_dp_line3": _column(
        "delivery_point",
        "uprn",
        "line3",
        text.delivery_line3("double_dependent_locality", "dependent_locality"),
    ),
    "shape_subdivision": _column("blpu", "uprn", "subdivision", codes.subdivision("country")),
    "shape_country_lookup": _country_lookup,
    "shape_country_geographic": _column(
        "blpu", "uprn", "country_code", codes.country_code("country", "postcode_locator")
    ),
    "shape_language": _shape(
        "street_descriptor",
        "usrn",
        "street_description",
        f"{codes.language_code('language')} as language",
    ),
    "shape_postcode": _column("delivery_point", "uprn", "postcode", text.postcode("postcode")),
    "shape_outcode": _column(
        "delivery_point", "uprn", "outcode", text.outcode(text.postcode("postcode"))
    ),
    "shape_location": _column("blpu", "uprn", "location", text.location("latitude", "longitude")),
    "shape_po_box": _column(
        "delivery_point", "uprn", "pobox_number", text.upper_or_null("po_box_number")
    ),
    "shape_range_sao": _column("lpi", "pro_order", "range_text", ranges.range_of("sao")),
    "shape_range_pao": _column("lpi", "pro_order", "range_text", ranges.range_of("pao")),
    "shape_geo_line1": _column("lpi", "pro_order", "line1", ranges.geographic_line1()),
    "shape_geo_line2": _geo_line2,
    "shape_empty_for_null": _shape(
        "street_descriptor",
        "usrn",
        "language",
        f"{text.empty_for_null('locality')} as locality",
    ),
    "shape_safe_name": _safe_name,
    # joins and set operations
    "join_delivery_property": _join_delivery_property,
    "join_property_identifier_approved": _join_approved,
    "join_property_identifier": _join_all_statuses,
    "join_identifier_descriptor": _join_identifier_descriptor,
    "join_descriptor_fanout": _join_fanout,
    "join_org_full_reduced": _join_organisation,
    "keys_except": _keys_except,
    "join_geo_not_in_lookup": _geo_not_in_lookup,
    "union_distinct_positional": _union_positional,
    # views
    "lookup_view": lambda spark, sf_dir: _shown(_lookup(spark, sf_dir)),
    "lookup_from_raw_files": _lookup_from_raw,
    "geographic_view": lambda spark, sf_dir: _shown(_geographic(spark, sf_dir)),
    "combined_view": lambda spark, sf_dir: _shown(_combined(spark, sf_dir)),
    "public_lookup_columns": _public_lookup,
    # tokens
    "lookup_tokens": lambda spark, sf_dir: _shown(
        _lookup(spark, sf_dir).select("uprn", "usrn", "search_tokens")
    ),
    "geographic_tokens": lambda spark, sf_dir: _shown(
        _geographic(spark, sf_dir).select("uprn", "usrn", "line2", "search_tokens")
    ),
    "token_table": _token_table,
    "find_words_all": _find_words,
    # lookups
    "find_uprn": _where(_lookup, "uprn", 2, 40, 77, 128),
    "find_postcode": _where(_lookup, "postcode", "LY3 3AB", "JY42 6AB", "MY48 3AB"),
    "find_outcode": _where(
        lambda spark, sf_dir: lookups.with_outcode(_lookup(spark, sf_dir)),
        "outcode",
        "LY3",
        "JY42",
    ),
    "find_town": _where(_lookup, "posttown", "TOWN 3"),
    "combined_find_uprn": _where(_combined, "uprn", 3, 40, 77, 129),
    "combined_find_postcode": _where(_combined, "post_code", "LY3 3AB", "JE4 4AB", "GY13 4AB"),
    "combined_find_words": lambda spark, sf_dir: _shown(
        lookups.find_words(_combined(spark, sf_dir), ["town", "3", "loc"])
    ),
    # files and loads
    "route_counts": _route_counts,
    "route_lines": _route_lines,
    "parse_typed": _parse_typed,
    "load_headered_csv": _load_headered,
    "load_counts": _load_counts,
    "batch_files": _batch_files,
    "batch_contents": _batch_contents,
    "list_files": _list_files,
    "epoch_of_path": _epoch_of_path,
    "landing_find_uprn": _landing_find,
    "min_size_check": _min_size,
    "md5_check": _md5,
    "width_check": _width,
    "width_check_documents": _width_documents,
    "stream_load_counts": _stream_load_counts,
    "stream_two_sources": _stream_two_sources,
    "load_record_files": _load_record_files,
    "load_rejects": _load_rejects,
    "file_digest": _file_digest,
    "batch_commit": _batch_commit,
    "stream_rejects": _stream_rejects,
    "change_only_merge": _change_only,
    "joint_publication": _joint_publication,
    # the life of a release
    "release_log": _cycle_log,
    "releases_live": _cycle_live,
    "release_status": _cycle_status,
    "combined_progress": _cycle_progress,
    "load_batches_counts": _cycle_counts,
    "street_counts": _cycle_streets,
    "public_lookup": _public(releases.LOOKUP),
    "public_combined": _public(releases.COMBINED),
    "stored_find_uprn": _stored_find(releases.LOOKUP, "uprn", 2, 40, 77, 128),
    "stored_find_postcode": _stored_find(
        releases.LOOKUP, "postcode", "LY3 3AB", "JY42 6AB", "MY48 3AB"
    ),
    "stored_find_outcode": _stored_find(releases.LOOKUP, "outcode", "LY3", "JY42"),
    "stored_find_town": _stored_find(releases.LOOKUP, "posttown", "TOWN 3"),
    "curve_find_uprn": _curve_find("uprn", 2, 40, 77, 128),
    "curve_find_postcode": _curve_find("postcode", "LY3 3AB", "JY42 6AB", "MY48 3AB"),
    "curve_find_town": _curve_find("posttown", "TOWN 3"),
    "stored_find_words": _stored_words(releases.LOOKUP, " ".join(WORDS)),
    "stored_combined_find_uprn": _stored_find(releases.COMBINED, "uprn", 3, 40, 77, 129),
    "stored_combined_find_postcode": _stored_find(
        releases.COMBINED, "post_code", "LY3 3AB", "JE4 4AB", "GY13 4AB"
    ),
    "stored_combined_find_words": _stored_words(releases.COMBINED, "town 3 loc"),
    "lookup_view_salted": _salted(lambda spark, sf_dir: _shown(_lookup(spark, sf_dir))),
    "geographic_view_salted": _salted(lambda spark, sf_dir: _shown(_geographic(spark, sf_dir))),
    # releases
    "release_names": lambda spark, sf_dir: derived.source_table(spark, sf_dir, "events").select(
        "event_id",
        status.release_name(c("user_id").cast("string"), c("ts")).alias("release"),
    ),
    "status_latest": _latest,
    "status_by_key": lambda spark, sf_dir: status.status_of(_latest(spark, sf_dir), "ab7"),
    "releases_to_drop": lambda spark, sf_dir: status.to_drop(_latest(spark, sf_dir)),
    "latest_finalised": lambda spark, sf_dir: status.newest_finalised(_latest(spark, sf_dir)),
    "previous_finalised": _previous_finalised,
    "release_counts": _release_counts,
    "tolerance_check": _tolerance,
    "finalise_decision": _finalise,
    "cleanup_plan": _cleanup,
    "status_stream_latest": _status_stream,
}


def _tuned(query: Query) -> Query:
    return lambda spark, sf_dir: query(tune(spark), sf_dir)


def queries() -> dict[str, Query]:
    return {name: _tuned(query) for name, query in _QUERIES.items()}
