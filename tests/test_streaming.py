from datetime import datetime, timedelta

from checks import derived
from waymark.plans import status
from waymark.session import delete_folder
from waymark.sources import landing
from waymark.sources.layouts import TABLES
from waymark.streaming import loads, statuses

SF = "/root/testdata/sf0.001"


def test_stream_and_batch_load_the_same(spark, folder):
    source = derived.raw_folder(spark, SF)
    landing.create_tables(spark, "st_stream")
    landing.create_tables(spark, "st_batch")
    query = loads.load_stream(spark, "st_stream", source, f"{folder}/progress")
    query.awaitTermination()
    batches = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert len(batches) == 2  # 25 files: 20 and 5
    landing.load_raw_batch(spark, "st_batch", "b0", source)
    for table in TABLES:
        a, b = (landing.tables(spark, name)[table] for name in ("st_stream", "st_batch"))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_latest_status_follows_the_stream(spark, folder):
    log = derived.status_log(spark, SF)
    middle = log.approxQuantile("seq", [0.5], 0.0)[0]
    transitions, table = f"{folder}/log", f"{folder}/latest"
    for condition in (f"seq <= {middle}", f"seq > {middle}"):
        log.filter(condition).write.mode("append").parquet(transitions)
        stream = statuses.status_stream(spark, transitions)
        statuses.keep_latest(stream, table, f"{folder}/progress").awaitTermination()
    found = statuses.read_latest(spark, table)
    expected = status.latest(log)
    assert found.exceptAll(expected).count() == 0 and expected.exceptAll(found).count() == 0


def test_two_streams_into_one_release(spark, folder):
    landing.create_tables(spark, "st_two")
    totals = []
    for part, count in (("a", 3), ("b", 2)):
        lines = derived.raw_lines(spark, SF).filter("value like '21,%'").limit(count)
        lines.coalesce(1).write.option("mapreduce.output.basename", "AddressBasePremium").text(
            f"{folder}/{part}"
        )
        loads.load_stream(
            spark, "st_two", f"{folder}/{part}", f"{folder}/progress-{part}"
        ).awaitTermination()
        totals.append(landing.tables(spark, "st_two")["abp_blpu"].count())
    assert totals == [3, 5]


def test_bad_lines_do_not_stop_a_lenient_stream(spark, folder):
    """A micro-batch that runs again replaces its rows and its rejects."""
    landing.create_tables(spark, "st_lenient")
    good = derived.raw_lines(spark, SF).filter("value like '21,%'").limit(7)
    bad = spark.createDataFrame([("77,no such type",), ("21,I,not a number",)], "value string")
    good.union(bad).coalesce(1).write.option(
        "mapreduce.output.basename", "AddressBasePremium"
    ).text(f"{folder}/in")
    for progress in ("one", "two"):  # the second run does not know of the first
        loads.load_stream(
            spark, "st_lenient", f"{folder}/in", f"{folder}/{progress}", source="s", lenient=True
        ).awaitTermination()
        assert landing.tables(spark, "st_lenient")["abp_blpu"].count() == 7
        found = landing.rejects(spark, "st_lenient").collect()
        assert sorted((r["record_type"] or "", r["problem"]) for r in found) == [
            ("", "no such record type"), ("21", "malformed"),
        ]


def test_the_status_folder_stays_small(spark, folder):
    """Dropped releases go, late transitions do not bring them back."""
    day = lambda n: datetime(2024, 1, 1) + timedelta(days=n)
    transitions, table, number = f"{folder}/log", f"{folder}/latest", 0

    def follow(*rows):
        nonlocal number
        entries = [(name, state, None, day(at), seq) for name, state, at, seq in rows]
        spark.createDataFrame(entries, status.STATUS_DDL).coalesce(1).write.mode("append").parquet(transitions)
        stream = statuses.status_stream(spark, transitions)
        statuses.keep_latest(stream, table, f"{folder}/progress").awaitTermination()
        number += 1
        return {row["schema_name"]: row["status"] for row in statuses.read_latest(spark, table).collect()}

    def stored():
        newest = statuses._versions(spark, table)[-1]
        return {row["schema_name"] for row in spark.read.parquet(f"{table}/{newest}").collect()}

    assert statuses.read_latest(spark, table).count() == 0
    assert follow(("a", "completed", 0, 1), ("b", "schema_created", 0, 2)) == {
        "a": "completed", "b": "schema_created",
    }
    assert follow(("a", "dropped", 2, 3)) == {"b": "schema_created"}
    assert stored() == {"a", "b"}  # a as a tombstone
    assert follow(("a", "finalised", 1, 1)) == {"b": "schema_created"}  # came late
    reader = statuses.read_latest(spark, table)
    assert follow(("b", "completed", 20, 4)) == {"b": "completed"}
    assert stored() == {"b"}
    assert reader.collect()[0]["status"] == "schema_created"  # its version is still there
    for n in range(4):
        follow((f"c{n}", "completed", 21 + n, 5 + n))
    assert len(statuses._versions(spark, table)) == statuses.KEPT_VERSIONS
    # A repeated micro-batch merges with the same version and replaces its own.
    before = {tuple(row) for row in statuses.read_latest(spark, table).collect()}
    delete_folder(spark, f"{folder}/progress/commits/{number - 1}")
    assert statuses.keep_latest(
        statuses.status_stream(spark, transitions), table, f"{folder}/progress"
    ).awaitTermination() is None
    assert {tuple(row) for row in statuses.read_latest(spark, table).collect()} == before
