import gzip
import hashlib
import os
import random
import re
import time

import pytest
from pyspark.sql import DataFrame

from checks import derived
from waymark.session import estimated_bytes, work_folder
from waymark.sources import integrity, landing, listing, raw, typed
from waymark.sources.layouts import LAYOUTS, TABLES, Field, Layout

SF = "/root/testdata/sf0.001"
SMALL = Layout(
    "21",
    "small.csv",
    "small",
    (
        Field("n", "short", None),
        Field("a", "string", 3),
        Field("b", "string", 3),
        Field("d", "date", None),
    ),
)


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_layouts():
    assert len(LAYOUTS) == 12 and len(TABLES) == 9
    counts = {t: len(layout.fields) for t, layout in LAYOUTS.items()}
    assert counts == {
        "10": 9, "11": 24, "15": 13, "21": 22, "23": 12, "24": 26,
        "28": 29, "29": 17, "30": 10, "31": 11, "32": 12, "99": 5,
    }
    assert "LOCALITY_NAME" in LAYOUTS["15"].header_line
    assert "ADMINSTRATIVE_AREA" in LAYOUTS["15"].header_line


def test_null_and_empty_stay_apart(spark):
    rows = typed.parse(lines(spark, '21,,"",2020-01-31', '21,"a""b",x,'), SMALL).collect()
    assert [(r.n, r.a, r.b) for r in rows] == [(21, None, ""), (21, 'a"b', "x")]
    assert str(rows[0].d) == "2020-01-31" and rows[1].d is None


@pytest.mark.parametrize(
    "bad",
    ["21,a,b", "21,a,b,,x", "x,a,b,", "99999,a,b,", "21,abcd,b,", "21,a,b,notadate", '"",a,b,'],
)
def test_bad_lines_fail_or_are_rejected(spark, bad):
    good, rejected = typed.parse_lenient(lines(spark, bad, "21,a,b,"), SMALL)
    assert good.count() == 1
    assert [r.value for r in rejected.collect()] == [bad]
    with pytest.raises(Exception, match="malformed|too wide"):
        typed.parse(lines(spark, bad), SMALL).collect()
    for read in (DataFrame.count, lambda rows: rows.select(SMALL.columns[-1]).collect()):
        with pytest.raises(Exception, match="(?s)malformed|wide"):
            read(typed.parse(lines(spark, bad), SMALL))


def test_trailing_blanks_are_cut_to_width(spark):
    row = typed.parse(lines(spark, "21,abc  ,b ,"), SMALL).head()
    assert (row.a, row.b) == ("abc", "b ")


@pytest.mark.parametrize("bad", ['77,"x"', "nocomma", ""])
def test_routing_of_unknown_lines(spark, bad):
    good, rejected = raw.route_lenient(lines(spark, bad, "21,x"))
    assert [r.record_type for r in good.collect()] == ["21"]
    assert [r.value for r in rejected.collect()] == [bad]
    with pytest.raises(Exception, match="no such record type"):
        raw.route(lines(spark, bad)).collect()
    for read in (DataFrame.count, lambda rows: rows.select("value").collect()):
        with pytest.raises(Exception, match="no such record type"):
            read(raw.route(lines(spark, bad)))


def test_raw_selection_skips_other_files(spark):
    folder = derived.raw_folder(spark, SF)
    assert any(name.startswith("Other") for name in os.listdir(folder))
    names = raw.read_raw(spark, folder).select("file_name").distinct().collect()
    assert names and all(r.file_name.startswith("AddressBasePremium") for r in names)


def test_record_files_are_verbatim_with_header(spark, folder):
    split = f"{folder}/split"
    wanted = ['21,"I",,""', "21,  lead , trail  ", '99,"say ""hi"""']
    raw.write_split(raw.route(lines(spark, *wanted)), split)
    raw.write_record_files(raw.read_split(spark, split), f"{folder}/out")
    found = spark.read.text(f"{folder}/out/ID21_BLPU_Records.csv").collect()
    header = LAYOUTS["21"].header_line
    assert sorted(r.value for r in found if r.value != header) == sorted(wanted[:2])
    for name in os.listdir(f"{folder}/out/ID21_BLPU_Records.csv"):
        if name.endswith(".csv"):
            with open(f"{folder}/out/ID21_BLPU_Records.csv/{name}") as f:
                assert f.readline().rstrip("\n") == header


def test_headered_csv_is_positional_and_strict(spark, folder):
    path = f"{folder}/in.csv"
    with open(path, "w") as f:
        f.write("X,Y,Z,W\n21,a,\"\",2020-01-01\n21,,b,\n")
    rows = typed.read_headered_csv(spark, path, SMALL).orderBy("a").collect()
    assert [(r.a, r.b) for r in rows] == [(None, "b"), ("a", "")]
    for bad in ("21,a,b", "21,a,b,,5", "21,abcd,b,", "21,a,b,31/12/2020"):
        with open(path, "w") as f:
            f.write(f"X,Y,Z,W\n{bad}\n")
        with pytest.raises(Exception):
            typed.read_headered_csv(spark, path, SMALL).collect()


def test_load_is_idempotent_and_appends_batches(spark):
    folder = derived.raw_folder(spark, SF)
    landing.create_tables(spark, "idem")
    assert landing.load_raw_batch(spark, "idem", "b0", folder) == 9
    once = {r.table_name: r.row_count for r in landing.row_counts(spark, "idem").collect()}
    landing.load_raw_batch(spark, "idem", "b0", folder)
    assert {r.table_name: r.row_count for r in landing.row_counts(spark, "idem").collect()} == once
    landing.load_raw_batch(spark, "idem", "b1", folder)
    twice = {r.table_name: r.row_count for r in landing.row_counts(spark, "idem").collect()}
    assert twice == {table: 2 * n for table, n in once.items()}
    expected = derived.table_rows(spark, SF, "abp_lpi")
    stored = spark.table("idem.abp_lpi").filter("batch = 'b0'").drop("batch", "attempt")
    assert stored.exceptAll(expected).count() == 0 and expected.exceptAll(stored).count() == 0


def counts_of(spark, release):
    return {r.table_name: r.row_count for r in landing.row_counts(spark, release).collect()}


def test_a_batch_happens_in_all_tables_or_in_none(spark, monkeypatch):
    """The last of the nine inserts fails: nothing of the batch is seen."""
    folder = derived.raw_folder(spark, SF)
    landing.create_tables(spark, "whole")
    landing.load_raw_batch(spark, "whole", "b0", folder)
    once, insert, done = counts_of(spark, "whole"), landing._append, []

    def failing(spark, release, table, *rest):
        if table == list(TABLES)[-1]:
            while len(done) < len(TABLES) - 1:  # all others are written
                time.sleep(0.05)
            raise OSError("disk full")
        insert(spark, release, table, *rest)
        done.append(table)

    for batch in ("b1", "b0"):  # a new batch, and a repeated one
        done.clear()
        monkeypatch.setattr(landing, "_append", failing)
        with pytest.raises(OSError, match="disk full"):
            landing.load_raw_batch(spark, "whole", batch, folder)
        assert spark.table("whole.abp_blpu").count() > once["abp_blpu"]  # written, not committed
        assert counts_of(spark, "whole") == once
    # A load that fails to commit is not seen either.
    monkeypatch.setattr(landing, "_append", insert)
    commit = landing._commit
    monkeypatch.setattr(landing, "_commit", lambda *rest: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        landing.load_raw_batch(spark, "whole", "b1", folder)
    assert counts_of(spark, "whole") == once
    monkeypatch.setattr(landing, "_commit", commit)
    landing.load_raw_batch(spark, "whole", "b1", folder)
    assert counts_of(spark, "whole") == {table: 2 * n for table, n in once.items()}
    # What failed attempts of this batch left behind is gone.
    assert spark.table("whole.abp_blpu").filter("batch = 'b1'").count() == once["abp_blpu"]


def test_joins_by_key_leave_landing_tables_in_place(spark):
    """No exchange below the joins on the property key, over two batches."""
    landing.create_tables(spark, "bucketed")
    for batch in ("b0", "b1"):
        landing.load_raw_batch(spark, "bucketed", batch, derived.raw_folder(spark, SF))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = landing.tables(spark, "bucketed")
        properties, points = tables["abp_blpu"], tables["abp_delivery_point"]
        joined = points.join(properties, "uprn").join(tables["abp_classification"], "uprn")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 2
        assert "hashpartitioning(uprn" not in plan  # the manifest's are by batch
        assert joined.count() == 8 * derived.record_rows(spark, SF, "28").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_changes_are_merged_in_order(spark):
    """Later batches win, then later rows; deletions take records away."""
    landing.create_tables(spark, "merging")
    row = "31,{0},{1},{2},{3},{4},,,,,"

    def load(batch, *changes):
        text = [row.format(*change) for change in changes]
        landing.load_lines(spark, "merging", batch, lines(spark, *text), work_folder(spark, "s"))

    load("b0", ("I", 1, 5, "O1", "one"), ("I", 2, 5, "O2", "two"), ("I", 3, 6, "O1", "other"))
    load("b1", ("D", 9, 5, "O1", ""), ("U", 8, 5, "O1", "gone"), ("I", 7, 5, "O3", "three"))
    expected = {(5, "O2", "two"), (5, "O3", "three"), (6, "O1", "other")}
    load("b2", ("U", 1, 5, "O2", "second"))  # later, though its number is small
    expected = (expected - {(5, "O2", "two")}) | {(5, "O2", "second")}

    def found(rows):
        return {(r.uprn, r.org_key, r.organisation) for r in rows.collect()}

    one = landing.merged(spark, "merging", "abp_organisation")
    assert found(one) == expected
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(uprn" not in plan
    landing.fold_changes(spark, "merging")
    assert found(landing.tables(spark, "merging")["abp_organisation"]) == expected
    assert [r.batch for r in landing.committed(spark, "merging").collect()] == ["folded"]
    assert spark.table("merging.abp_organisation").select("batch").distinct().count() == 1
    load("b3", ("D", 1, 6, "O1", ""))
    assert found(landing.merged(spark, "merging", "abp_organisation")) == {
        key for key in expected if key[0] != 6
    }


def test_a_line_is_parsed_once(spark):
    one = lines(spark, "31,I,1,5,O1,name,,,,,")
    layout = LAYOUTS["31"]
    good, bad = typed.parse_lenient(one, layout)
    plans = [typed.parse(one, layout), typed.parse(one, layout, widths=False), good, bad]
    for rows in [*plans, typed.parse(one, layout).select("uprn")]:
        assert rows._jdf.queryExecution().executedPlan().toString().count("from_csv(") == 1
    assert good.count() == 1 and bad.count() == 0


def test_a_line_is_worked_out_once(spark):
    made = spark.range(3).selectExpr("concat('21,', cast(id as string)) as value")
    rows = raw.route(made).select("record_type", "value")
    assert rows._jdf.queryExecution().executedPlan().toString().count("concat(21,") == 1
    assert sorted(r.value for r in rows.collect()) == ["21,0", "21,1", "21,2"]


def test_lenient_parsing_is_short_enough_to_compile(spark):
    """The JVM interprets methods of more than 8,000 bytes."""
    made = spark.range(3).selectExpr("concat('24,', cast(id as string)) as value")
    for rows in typed.parse_lenient(made, LAYOUTS["24"]):
        text = spark._jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "codegen")
        sizes = [int(size) for size in re.findall("maxMethodCodeSize:([0-9]+)", text)]
        assert sizes and max(sizes) < 8000


def test_lenient_loads_read_the_lines_once(spark):
    landing.create_tables(spark, "readonce")
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    given = lines(spark, "21,x", "77,x", "nocomma", "", '30,I,1,5,"S",,,,,')
    given = given.union(spark.createDataFrame([(None,)], "value string"))
    counted = given.mapInPandas(count, "value string")
    bad = landing.load_lines_lenient(spark, "readonce", "b0", counted, work_folder(spark, "s"))
    found = {(r.record_type, r.problem, r.value) for r in bad.collect()}
    unknown = {(None, "no such record type", value) for value in ("77,x", "nocomma", "", None)}
    assert found == unknown | {("21", "malformed", "21,x")}
    assert landing.tables(spark, "readonce")["abp_successor"].count() == 1
    assert read.value == 6


def test_sizes_are_known_after_measuring(spark):
    landing.create_tables(spark, "sized")
    landing.load_raw_batch(spark, "sized", "b0", derived.raw_folder(spark, SF))
    landing.measure_sizes(spark, "sized")
    assert 0 < estimated_bytes(landing.tables(spark, "sized")["abp_lpi"]) < 10_000_000


def test_split_is_read_by_type(spark, folder):
    raw.write_split(raw.route(raw.read_raw(spark, derived.raw_folder(spark, SF))), folder + "/s")
    one = raw.read_split(spark, folder + "/s").filter("record_type = '24'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(record_type" in plan


def test_landing_table_rejects_wide_text(spark):
    landing.create_tables(spark, "wide")
    line = "31,I,1,5,O1," + "x" * 101 + ",,,,,"
    with pytest.raises(Exception, match="length limitation"):
        landing.load_lines(spark, "wide", "b0", lines(spark, line), work_folder(spark, "s"))


def test_record_files_load_like_raw_files(spark, folder):
    source = derived.raw_folder(spark, SF)
    raw.write_split(raw.route(raw.read_raw(spark, source)), f"{folder}/split")
    raw.write_record_files(raw.read_split(spark, f"{folder}/split"), f"{folder}/out")
    landing.create_tables(spark, "files_a")
    landing.create_tables(spark, "files_b")
    assert landing.load_record_files(spark, "files_a", "b0", f"{folder}/out") == 9
    landing.load_raw_batch(spark, "files_b", "b0", source)
    for table in TABLES:
        a, b = (landing.tables(spark, f"files_{name}")[table] for name in "ab")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_batches_of_twenty(spark):
    files = spark.range(45).selectExpr("'/d/79/' || lpad(id, 3, '0') || '.csv' as path")
    batches = listing.batch_contents(listing.assign_batches(files)).orderBy("batch").collect()
    assert [len(b.files) for b in batches] == [20, 20, 5]
    flat = [path for b in batches for path in b.files]
    assert flat == sorted(flat) and len(set(flat)) == 45


def test_listing(spark, folder):
    os.makedirs(f"{folder}/79/0")
    for name in ("b.csv", "a.csv", "c.txt"):
        with open(f"{folder}/79/{name}", "w") as f:
            f.write("x")
    with open(f"{folder}/79/0/deep.csv", "w") as f:
        f.write("xy")
    found = listing.list_files(spark, f"{folder}/79").collect()
    assert sorted(os.path.basename(r.path) for r in found) == ["a.csv", "b.csv", "c.txt", "deep.csv"]
    shallow = listing.csv_files(spark, f"{folder}/79").collect()
    assert sorted(os.path.basename(r.path) for r in shallow) == ["a.csv", "b.csv"]
    deep = listing.list_files(spark, f"{folder}/79", "deep*")
    assert deep.select(listing.epoch_of(deep.path)).head()[0] == "79"
    assert deep.select(listing.epoch_of(deep.path, "80")).head()[0] == "80"


def test_checksums_and_sizes(spark, folder):
    with open(f"{folder}/a.bin", "wb") as f:
        f.write(b"hello")
    files = integrity.file_checksums(spark, folder)
    path = files.head().path
    manifest = spark.createDataFrame(
        [(path, "5d41402abc4b2a76b9719d911017c592"), ("gone", "x")], "path string, required_md5 string"
    )
    report = {r.path: r.ok for r in integrity.checksum_report(files, manifest).collect()}
    assert report == {path: True, "gone": False}
    bundles = spark.createDataFrame(
        [("AB76GB_CSV.zip", 9_500_000_000), ("AB76GB_CSV.zip", 9_500_000_001),
         ("AB76IS_CSV.zip", 150_000_001), ("other.zip", 5)],
        "file_name string, length long",
    )
    assert [r.ok for r in integrity.size_report(bundles).collect()] == [False, True, True, None]
    with pytest.raises(Exception, match="not a bundle"):
        integrity.size_report(bundles, strict=True).collect()


def test_digests_of_whole_files(spark, folder):
    """Line ends, byte order marks, packed and binary files; read line by line."""
    contents = {
        "empty": b"", "feed": b"\n", "feeds": b"\n\n\n", "open": b"a\nb", "closed": b"a\nb\n",
        "dos": b"a\r\nb\r\n", "old": b"a\rb", "mark": b"\xef\xbb\xbfa\nb",
        "mark_closed": b"\xef\xbb\xbfa\n", "only_mark": b"\xef\xbb\xbf",
        "no_utf8": bytes(range(256)) * 5, "noise.zip": random.Random(5).randbytes(3_000_000),
        "long": b"x" * 500_000, "packed.gz": gzip.compress(b"text\n" * 1000), "spaces": b" a \n b ",
    }
    os.makedirs(f"{folder}/deep")
    for i, (name, data) in enumerate(contents.items()):
        with open(f"{folder}/{'deep/' if i % 2 else ''}{name}", "wb") as f:
            f.write(data)
    rows = integrity.file_checksums(spark, folder).collect()
    found = {os.path.basename(r.path): (r.length, r.md5) for r in rows}
    assert found == {
        name: (len(data), hashlib.md5(data).hexdigest()) for name, data in contents.items() if data
    }
    assert len(rows) == len(contents) - 1  # an empty file is not listed


def test_a_digest_needs_little_memory(spark, folder):
    """Lines come in batches; the whole is the digest of what was joined."""
    data = b"one\n\ntwo\nend\n"
    digest = integrity._Digest("a", len(data))
    for lines in ([b"one"], [b"", b"two"], [b"end"]):
        digest.add(lines)
    assert digest.finish() == ("a", len(data), hashlib.md5(data).hexdigest())
    with pytest.raises(OSError, match="bytes read"):
        integrity._Digest("a", 50).finish()
