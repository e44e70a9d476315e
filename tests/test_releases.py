from datetime import datetime

import pytest

from checks import derived
from waymark.operators import lookups
from waymark.plans import releases, status, views
from waymark.plans.releases import Releases
from waymark.session import work_folder
from waymark.sources import landing
from waymark.sources.layouts import TABLES

SF = "/root/testdata/sf0.001"


def log(spark, *rows):
    return spark.createDataFrame(
        [(name, state, None, datetime(2024, 1, day), seq) for name, state, day, seq in rows],
        status.STATUS_DDL,
    )


def names(df):
    return sorted(r.schema_name for r in df.collect())


def test_latest_breaks_ties_by_sequence(spark):
    current = status.latest(
        log(spark, ("a", "creating_view", 1, 1), ("a", "completed", 1, 2), ("b", "errored", 2, 1),
            ("b", "schema_created", 1, 9), ("c", "completed", 1, 1), ("c", "dropped", 2, 2))
    )
    assert {r.schema_name: r.status for r in current.collect()} == {"a": "completed", "b": "errored"}


def test_retention(spark):
    none = status.latest(log(spark, ("a", "completed", 1, 1), ("b", "errored", 2, 2)))
    assert names(status.to_drop(none)) == ["a", "b"]
    two = status.latest(
        log(spark, ("a", "finalised", 1, 1), ("b", "finalised", 2, 2), ("c", "completed", 3, 3))
    )
    assert names(status.to_drop(two)) == ["a", "c"]
    assert names(status.newest_finalised(two)) == ["b"]
    assert names(status.newest_finalised(two, other_than="b")) == ["a"]


@pytest.mark.parametrize(
    ("new", "old", "percent", "expected"),
    [
        (1000000, 1000200, 0.3, True),
        (1000200, 1000000, 0.3, True),
        (1000000, 1000000, 0.3, True),
        (1000000, 1100000, 3.0, False),
        (1100000, 1000000, 3.0, False),
        (1000000, 110000000, 3.0, False),
        (110000000, 1000000, 3.0, False),
        (5, 0, 0.3, True),
        (1003, 1000, 0.3, True),
        (10031, 10000, 0.3, False),
        (5, None, 0.3, True),
    ],
)
def test_tolerance(spark, new, old, percent, expected):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([(new, old)], "new long, old long")
    assert row.select(status.within_tolerance(F.col("new"), F.col("old"), percent)).head()[0] is expected


def test_finalise_decision(spark):
    current = status.latest(
        log(spark, ("old", "finalised", 1, 1), ("new", "completed", 2, 2), ("bad", "errored", 3, 3))
    )
    sizes = spark.createDataFrame([("old", 1000), ("new", 1002), ("bad", 1001)], "schema_name string, n long")
    row = status.finalise_decision(current, sizes, "new").head()
    assert (row.previous, row.within_tolerance, row.proceed) == ("old", True, True)
    row = status.finalise_decision(current, sizes, "bad").head()
    assert (row.within_tolerance, row.proceed) == (True, False)
    first = status.latest(log(spark, ("new", "completed", 2, 2)))
    row = status.finalise_decision(first, sizes, "new").head()
    assert (row.previous, row.proceed) == (None, True)


def test_names_and_cleanup(spark):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([(datetime(2024, 12, 30, 23, 59, 1),)], "t timestamp_ntz")
    assert row.select(status.release_name(F.lit("79"), F.col("t"))).head()[0] == "ab79_20241230_235901"
    plan = status.cleanup_plan(
        spark.createDataFrame([("/d/79",), ("/d/79.old/",), ("/d/80/",)], "directory string"), "79"
    )
    assert {r.directory: r.keep for r in plan.collect()} == {
        "/d/79": True, "/d/79.old/": False, "/d/80/": False,
    }
    with pytest.raises(ValueError):
        releases.checked_name("x; drop table y")


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_release_life_cycle(spark):
    work = Releases(spark, control="lc_control", public="lc_public")
    folder = derived.raw_folder(spark, SF)
    first = work.initialise("78", datetime(2024, 1, 1))
    assert first == "ab78_20240101_000000"
    assert work.status(first) == {"status": "schema_created", "errorMessage": None}
    assert not work.lookup_exists(first)
    assert work.load(first, "0", folder) == len(TABLES)
    work.build_lookup(first)
    assert work.lookup_exists(first)
    assert work.status(first)["status"] == "completed"
    steps = spark.table(work.log_table).filter(f"schema_name = '{first}'").orderBy("seq")
    assert [r.status for r in steps.collect()] == ["schema_created", *status.LOOKUP_STEPS]

    expected = views.lookup_view(derived.address_tables(spark, SF))
    stored = spark.table(f"{first}.lookup").select(*views.LOOKUP_COLUMNS)
    assert same(stored, expected.select(*views.LOOKUP_COLUMNS))

    assert work.build_combined(first)
    messages = [r.messages for r in spark.table(f"{first}.progress").collect()]
    assert sorted(messages) == sorted(releases.COMBINED_STEPS)
    combined = views.combined_view(landing.tables(spark, first), stored)
    assert same(work.public_table(releases.COMBINED), combined)

    assert work.finalise(first) == {"within_tolerance": True, "published": True}
    assert work.status(first)["status"] == "finalised"
    assert work.public_table().columns == list(views.LOOKUP_COLUMNS)
    key = work.public_table().head()["uprn"]
    assert work.public_table().filter(f"uprn = {key}").count() > 0
    found = work.find_words(first, "The High Streets")
    assert same(found.select("uprn", "usrn"), stored.filter("line2 like '%HIGH STREET'").select("uprn", "usrn").union(
        stored.filter("line2 = ''").select("uprn", "usrn")))

    renamed = Releases(
        spark, "lc_control", "lc_public", {"lookup": "addresses", "search_tokens": "ft_col"}
    )
    renamed.publish(first)
    assert spark.table("lc_public.addresses").columns == [*views.LOOKUP_COLUMNS[:-1], "ft_col"]

    second = work.initialise("79", datetime(2024, 2, 1))
    work.load(second, "0", folder)
    work.load(second, "1", folder)  # twice the size: out of tolerance
    work.build_lookup(second)
    assert work.finalise(second) == {"within_tolerance": False, "published": False}
    assert not work.build_combined(second)
    assert work.status(second)["status"] == "completed"
    assert work.finalise(second, force=True)["published"]
    assert work.public_table().count() == spark.table(f"{second}.lookup").count()

    third = work.initialise("80", datetime(2024, 3, 1))
    assert not spark.catalog.databaseExists(first) and spark.catalog.databaseExists(second)
    assert {first, third} & set(names(work.list_databases())) == {third}
    with pytest.raises(LookupError):
        work.status(first)


def test_failed_build_is_recorded_and_raised(spark):
    work = Releases(spark, control="fb_control", public="fb_public")
    release = work.initialise("77", datetime(2024, 1, 1))
    spark.sql(f"DROP TABLE {release}.abp_lpi")
    with pytest.raises(Exception):
        work.build_lookup(release)
    found = work.status(release)
    assert found["status"] == "errored" and "abp_lpi" in found["errorMessage"]


def release_of(work, table):
    """The release a public view really shows, by its rows."""
    return work.public_table(table).count()


def built(work, epoch, month, lines):
    release = work.initialise(epoch, datetime(2024, month, 1))
    landing.load_lines(work.spark, release, "b0", lines, work_folder(work.spark, "split"))
    work.build_lookup(release)
    assert work.build_combined(release)
    return release


@pytest.mark.parametrize("joint", [False, True])
def test_a_failed_publication_leaves_the_public_release(spark, joint, monkeypatch):
    """The switch fails, then a release is initialised: readers see the old one."""
    name = f"fp{int(joint)}"
    work = Releases(spark, control=f"{name}_control", public=f"{name}_public", joint=joint)
    lines = derived.raw_lines(spark, SF)
    first = built(work, f"{name}1", 1, lines)
    work.finalise(first)
    before = {table: release_of(work, table) for table in (releases.LOOKUP, releases.COMBINED)}
    fewer = lines.filter("value not like '28,%' or split(value, ',')[3] % 2 = 0")
    second = built(work, f"{name}2", 2, fewer)
    failing = "_point" if joint else "_publish_view"

    def broken(*args):
        raise OSError("catalog gone")

    monkeypatch.setattr(work, failing, broken)
    with pytest.raises(OSError):
        work.finalise(second)
    assert work.status(second)["status"] == "completed"
    assert work.public_release() == first
    monkeypatch.undo()
    tables = (releases.LOOKUP, releases.COMBINED) if joint else (releases.LOOKUP,)
    assert {table: release_of(work, table) for table in tables} == {t: before[t] for t in tables}
    work.finalise(second)
    assert work.public_release() == second
    assert release_of(work, releases.LOOKUP) < before[releases.LOOKUP]
    third = work.initialise(f"{name}3", datetime(2024, 3, 1))
    assert not spark.catalog.databaseExists(first)
    assert release_of(work, releases.LOOKUP) < before[releases.LOOKUP]
    assert third


def test_a_release_that_readers_see_is_never_dropped(spark, monkeypatch):
    """Switched but not recorded: the next release spares it."""
    work = Releases(spark, control="nd_control", public="nd_public")
    lines = derived.raw_lines(spark, SF)
    first = built(work, "nd1", 1, lines)
    work.finalise(first)
    second = built(work, "nd2", 2, lines)
    record = work.record
    monkeypatch.setattr(
        work, "record", lambda r, state, *a: record(r, state, *a) if state != "finalised" else 1 / 0
    )
    with pytest.raises(ZeroDivisionError):
        work.finalise(second)
    monkeypatch.undo()
    assert work.public_release() == second
    work.initialise("nd3", datetime(2024, 3, 1))
    assert spark.catalog.databaseExists(second) and work.public_table().count() > 0


def test_both_views_move_together(spark, monkeypatch):
    """Between any two statements of a publication both show one release."""
    work = Releases(spark, control="bm_control", public="bm_public", joint=True)
    lines = derived.raw_lines(spark, SF)
    fewer = lines.filter("value not like '28,%' or split(value, ',')[3] % 2 = 0")
    first = built(work, "bm1", 1, lines)
    with pytest.raises(LookupError, match="no lookup_combined"):
        spark.sql(f"ALTER VIEW {first}.lookup_combined RENAME TO {first}.hidden")
        work.publish(first)
    spark.sql(f"ALTER VIEW {first}.hidden RENAME TO {first}.lookup_combined")
    work.finalise(first)
    second = built(work, "bm2", 2, fewer)
    expected = {
        tuple(spark.table(f"{release}.{table}").count() for table in (releases.LOOKUP, releases.COMBINED))
        for release in (first, second)
    }
    assert len(expected) == 2
    seen = []

    def watched(step):
        def run(*args):
            step(*args)
            seen.append(tuple(release_of(work, t) for t in (releases.LOOKUP, releases.COMBINED)))
        return run

    for name in ("_joint_view", "_point"):
        monkeypatch.setattr(work, name, watched(getattr(work, name)))
    work.finalise(second)
    assert len(seen) == 3 and set(seen) == expected
    plan = work.public_table()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1  # the other branch is no part of the plan


def test_lookups_on_a_curve_open_few_files(spark, folder):
    """Each column's values are in few of the files, and none is missed."""
    rows = spark.range(20_000).selectExpr(
        "id as uprn", "'P' || (id * 7 % 900) as postcode", "'T' || (id * 11 % 40) as town"
    )
    columns = ["uprn", "postcode", "town"]
    lookups.on_curve(rows, columns, files=64).write.parquet(f"{folder}/curve")
    stored = spark.read.parquet(f"{folder}/curve")
    index = lookups.file_index(stored, columns)
    for column, value in (("uprn", 77), ("postcode", "P63"), ("town", "T5")):
        found, opened = lookups.find_in_files(stored, index, column, value)
        assert same(found, rows.filter(f"{column} = '{value}'"))
        assert 0 < opened <= 24 and len(found.inputFiles()) == opened
    assert lookups.find_in_files(stored, index, "uprn", 77)[1] == 1
    found, opened = lookups.find_in_files(stored, index, "postcode", "nowhere")
    assert found.count() == 0


def test_a_release_on_a_curve(spark):
    work = Releases(spark, control="cv_control", public="cv_public")
    release = work.initialise("cv", datetime(2024, 1, 1))
    landing.load_lines(
        spark, release, "b0", derived.raw_lines(spark, SF), work_folder(spark, "split")
    )
    work.build_lookup(release, curve=True)
    stored = spark.table(f"{release}.lookup")
    for column in ("uprn", "postcode", "outcode", "posttown"):
        value = stored.filter(f"{column} is not null").head()[column]
        found = work.find(release, column, value)
        assert found.count() and same(found, lookups.find(stored, column, value))


def _up_to_join(node, table, above=()):
    """Nodes between each scan of a table and the join by key that reads it."""
    name = node.nodeName()
    above = () if name == "SortMergeJoin" else (*above, name)
    children = [node.children().apply(i) for i in range(node.children().size())]
    if not children and table in node.simpleString(1000):
        return [above]
    return [found for child in children for found in _up_to_join(child, table, above)]


def test_combined_build_keeps_the_buckets(spark, request):
    """Also where the shuffle setting has more parts than the tables buckets:
    properties and identifiers are not exchanged before their joins by key."""
    work = Releases(spark, control="kb_control", public="kb_public")
    release = work.initialise("76", datetime(2024, 1, 1))
    lines = derived.raw_lines(spark, SF)
    landing.load_lines(spark, release, "b0", lines, work_folder(spark, "split"))
    work.build_lookup(release)
    rows = []
    kept, views_rows = views.combined_rows, lambda *a, **k: rows.append(kept(*a, **k)) or rows[-1]
    settings = {
        "spark.sql.shuffle.partitions": "50",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in settings}
    views.combined_rows = views_rows

    def restore():
        views.combined_rows = kept
        for key, value in before.items():
            spark.conf.set(key, value)

    request.addfinalizer(restore)
    for key, value in settings.items():
        spark.conf.set(key, value)
    work.build_combined(release, force=True)
    plan = rows[0]._jdf.queryExecution().executedPlan()
    for table in ("abp_blpu", "abp_lpi"):
        paths = _up_to_join(plan, table)
        assert paths and not any("Exchange" in path for path in paths)
    stored = spark.table(f"{release}.lookup")
    plain = views.shape_combined(kept(landing.tables(spark, release), stored))
    assert same(work.public_table(releases.COMBINED), plain)
