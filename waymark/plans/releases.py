"""Releases in the Spark catalog: initialise, build, check, publish, retire.

One database per release holds its landing tables and views. A control
database holds the status log, a public one the views that readers use.
"""

from __future__ import annotations

import re
import time
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions import tokens
from waymark.operators import lookups
from waymark.plans import status, views
from waymark.session import clear_work_folders, materialise, tune
from waymark.sources import landing, listing

LOOKUP = "lookup"
LOOKUP_TOKENS = "lookup_tokens"
LOOKUP_FILES = "lookup_files"
COMBINED = "lookup_combined"
COMBINED_TOKENS = "lookup_combined_tokens"
PROGRESS = "progress"
POINTER = "shown_release"  # a view of one value: the release that readers see

# Messages of a combined build, in order (fixed values).
COMBINED_STEPS = (
    "create gla view",
    "create combined view",
    "create combined ft index",
    "create combined uprn index",
    "create combined postcode index",
    "success",
)


def checked_name(name: str) -> str:
    """Names go into DDL text, so only plain identifiers are let through."""
    if not re.fullmatch(r"[A-Za-z][A-Za-z0-9_]{0,63}", name):
        raise ValueError(f"not a plain name: {name!r}")
    return name


class Releases:
    """Releases of one gazetteer.

    ``public_names`` renames what readers see: the public views ``lookup`` and
    ``lookup_combined``, and any of their columns.

    With ``joint`` both public views show the same release at any time: they
    resolve through one pointer, which ``publish`` moves once the lookup and
    the combined view of a release are there. Otherwise each view is switched
    on its own.
    """

    def __init__(
        self,
        spark: SparkSession,
        control: str = "gazetteer_control",
        public: str = "gazetteer",
        public_names: Mapping[str, str] | None = None,
        joint: bool = False,
    ):
        self.spark = tune(spark)
        self.joint = joint
        self.control = checked_name(control)
        self.public = checked_name(public)
        self.public_names = {k: checked_name(v) for k, v in (public_names or {}).items()}

    # -- status log -------------------------------------------------------

    @property
    def log_table(self) -> str:
        return f"`{self.control}`.`release_status`"

    def ensure_status_log(self) -> None:
        for database in (self.control, self.public):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.log_table} ({status.STATUS_DDL}) USING parquet"
        )

    def current(self) -> DataFrame:
        return status.latest(self.spark.table(self.log_table))

    def record(
        self,
        release: str,
        state: str,
        error: str | None = None,
        timestamp: datetime | None = None,
    ) -> None:
        """Append one transition; the log is never updated in place."""
        now = timestamp or datetime.now(timezone.utc).replace(tzinfo=None)
        row = (release, state, error, now, time.time_ns())
        entry = self.spark.createDataFrame([row], status.STATUS_DDL).coalesce(1)
        entry.write.mode("append").insertInto(self.log_table)

    def status(self, release: str) -> dict[str, str | None]:
        """Status and error message; fails unless exactly one row is found."""
        rows = status.status_of(self.current(), release).take(2)
        if len(rows) != 1:
            raise LookupError(f"{len(rows)} status rows for {release}")
        return {"status": rows[0]["status"], "errorMessage": rows[0]["error_message"]}

    def close(self) -> None:
        """Remove this process' work folders; for the end of a job."""
        clear_work_folders(self.spark)

    # -- lifecycle --------------------------------------------------------

    def initialise(self, epoch: str, created: datetime | None = None) -> str:
        """Retire superseded releases, then create the tables of a new one."""
        created = created or datetime.now(timezone.utc)
        if created.tzinfo is None:
            created = created.replace(tzinfo=timezone.utc)
        named = self.spark.createDataFrame([(epoch, created)], "epoch string, created timestamp")
        release = checked_name(
            named.select(status.release_name(F.col("epoch"), F.col("created"))).head()[0]
        )
        self.ensure_status_log()
        self.drop(self.superseded())
        landing.create_tables(self.spark, release)
        self.record(release, status.SCHEMA_CREATED)
        return release

    def superseded(self) -> list[str]:
        """Releases that may go: never the one whose lookup readers see."""
        shown = self.public_release()
        listed = [row["schema_name"] for row in status.to_drop(self.current()).collect()]
        return [release for release in listed if release != shown]

    def drop(self, releases: list[str]) -> None:
        """Remove releases; public views of theirs go first.

        Joint views forget the release, so that they never name a missing one.
        """
        for release in releases:
            for table in (LOOKUP, COMBINED):
                if self.public_release(table) == release:
                    self.spark.sql(f"DROP VIEW {self._public_view(table)}")
                elif release in self._branches(table):
                    self._joint_view(table, [r for r in self._branches(table) if r != release])
            self.spark.sql(f"DROP DATABASE IF EXISTS `{checked_name(release)}` CASCADE")
            self.record(release, status.DROPPED)

    def public_release(self, table: str = LOOKUP) -> str | None:
        """The release a public view shows."""
        view = self._public_view(table)
        if not self.spark.catalog.tableExists(view.replace("`", "")):
            return None
        properties = self._properties(table)
        if "branches" in properties:
            return self.spark.table(f"`{self.public}`.`{POINTER}`").head()["release"]
        return properties.get("release")

    def _properties(self, table: str) -> dict[str, str]:
        view = self._public_view(table)
        if not self.spark.catalog.tableExists(view.replace("`", "")):
            return {}
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {view}").collect()
        return {row["key"]: row["value"] for row in rows}

    def _branches(self, table: str) -> list[str]:
        """The releases that a joint view can show."""
        return [name for name in self._properties(table).get("branches", "").split(",") if name]

    def compact_log(self) -> None:
        """Rewrite the status log, one small file per transition, as one file."""
        rows = materialise(self.spark.table(self.log_table), "status-log")
        rows.coalesce(1).write.mode("overwrite").insertInto(self.log_table)

    def list_databases(self) -> DataFrame:
        return self.spark.sql("SHOW DATABASES").select(F.col("namespace").alias("schema_name"))

    def load(self, release: str, batch: str, source: str | list[str]) -> int:
        """Load a batch: a directory of raw files, or the files of the batch."""
        return landing.load_raw_batch(
            self.spark, checked_name(release), checked_name(f"b{batch}"), source
        )

    def load_batches(self, release: str, assigned: DataFrame) -> int:
        """Load assigned files (``path``, ``batch``) batch by batch.

        A batch that was loaded before is replaced, so a broken run is repeated
        as a whole or from any batch on.
        """
        batches = listing.batch_contents(assigned).orderBy("batch").toLocalIterator()
        number = 0
        for row in batches:  # one row of at most 20 paths at a time
            self.load(release, str(row["batch"]), row["files"])
            number += 1
        return number

    def lookup_exists(self, release: str) -> bool:
        return self.spark.catalog.tableExists(f"{checked_name(release)}.{LOOKUP}")

    # -- builds -----------------------------------------------------------

    def _save(self, rows: DataFrame, release: str, table: str, *bloom: str) -> None:
        """Write a new version, then point the table's name at it.

        Readers see the old version until the new one is complete. The version
        before the old one goes.
        """
        version = f"{table}_v{time.time_ns()}"
        (
            rows.write.format("parquet")
            .options(**lookups.bloom_filtered(*bloom))
            .saveAsTable(f"`{release}`.`{version}`")
        )
        self.spark.sql(
            f"CREATE OR REPLACE VIEW `{release}`.`{table}` AS SELECT * FROM `{release}`.`{version}`"
        )
        listed = self.spark.sql(f"SHOW TABLES IN `{release}` LIKE '{table}_v*'").collect()
        mine = re.compile(rf"{table}_v[0-9]+")
        versions = sorted(r["tableName"] for r in listed if mine.fullmatch(r["tableName"]))
        for old in versions[:-2]:
            self.spark.sql(f"DROP TABLE IF EXISTS `{release}`.`{old}`")

    def build_lookup(
        self,
        release: str,
        postcode_mode: str = "literal",
        changes: bool = False,
        curve: bool = False,
    ) -> None:
        """Write the lookup and its token table, with status steps.

        With ``changes`` later batches are change-only files: the tables are
        merged record by record. With ``curve`` the files are laid out for all
        lookup columns alike and indexed (see ``find``). The narrow joined rows are clustered first and widened afterwards. A
        failure is recorded with its message and raised again.
        """
        steps = iter(status.LOOKUP_STEPS)
        self.record(release, next(steps))
        try:
            landing.measure_sizes(self.spark, checked_name(release))
            # Stored before it is sorted: a range exchange samples its input,
            # which would otherwise work out the joins a second time.
            rows = materialise(
                views.lookup_rows(self._landed(release, changes)), "lookup-rows"
            )
            if curve:
                rows = lookups.on_curve(rows, ["uprn", "postcode", "post_town"])
            else:
                rows = lookups.clustered(rows, "uprn", "usrn", *views.tie_columns(rows))
            view = views.shape_lookup(rows, postcode_mode)
            self._save(
                lookups.with_outcode(view), release, LOOKUP, "uprn", "postcode", "outcode",
                "posttown",
            )
            self.record(release, next(steps))
            stored = self.spark.table(f"`{release}`.`{LOOKUP}`")
            if curve:
                index = lookups.file_index(stored, ["uprn", "postcode", "outcode", "posttown"])
                self._save(index.orderBy("column", "cell"), release, LOOKUP_FILES)
            self._save_tokens(stored, release, LOOKUP_TOKENS)
            # The filters on the key columns were written with the lookup.
            for step in steps:
                self.record(release, step)
        except Exception as failure:
            self.record(release, status.ERRORED, str(failure))
            raise

    def _save_tokens(self, view: DataFrame, release: str, table: str) -> None:
        self._save(lookups.clustered_tokens(view), release, table, "lexeme")

    def _landed(self, release: str, changes: bool) -> dict[str, DataFrame]:
        return (landing.merged_tables if changes else landing.tables)(self.spark, release)

    def build_combined(self, release: str, force: bool = False, changes: bool = False) -> bool:
        """Write the combined view and its tokens, logging progress.

        It becomes public at once if the release is within tolerance (or when
        forced), or with the lookup where both are published jointly; the
        result says whether it may.
        """
        checked_name(release)
        progress = f"`{release}`.`{PROGRESS}`"
        self.spark.sql(f"DROP TABLE IF EXISTS {progress}")
        self.spark.sql(f"CREATE TABLE {progress} (result BOOLEAN, messages STRING) USING parquet")
        try:
            self._build_combined(release, progress, changes)
        except Exception as failure:
            self._progress(progress, str(failure), done=False)
            raise
        allowed = force or self.within_tolerance(release)
        if allowed and not self.joint:
            self._publish_view(release, COMBINED, views.COMBINED_COLUMNS)
        return allowed

    def _build_combined(self, release: str, progress: str, changes: bool) -> None:
        lookup = self.spark.table(f"`{release}`.`{LOOKUP}`")
        # Stored first and widened last, as in build_lookup.
        made = views.combined_rows(
            self._landed(release, changes), lookup, landing.buckets_of(self.spark, release)
        )
        rows = materialise(made, "combined-rows")
        self._progress(progress, COMBINED_STEPS[0])
        rows = lookups.clustered(rows, "uprn", "organisation_name", "line1", "line2")
        self._save(views.shape_combined(rows), release, COMBINED, "uprn", "post_code")
        self._progress(progress, COMBINED_STEPS[1])
        stored = self.spark.table(f"`{release}`.`{COMBINED}`")
        self._save_tokens(stored, release, COMBINED_TOKENS)
        for step in COMBINED_STEPS[2:]:
            self._progress(progress, step)

    def _progress(self, table: str, message: str, done: bool = True) -> None:
        row = self.spark.createDataFrame([(done, message)], "result boolean, messages string")
        row.coalesce(1).write.mode("append").insertInto(table)

    # -- publication ------------------------------------------------------

    def street_counts(self, releases: list[str]) -> DataFrame:
        """Street descriptor rows per release, for the tolerance check."""
        counts = [
            landing.stored(self.spark, checked_name(r), "abp_street_descriptor").agg(
                F.lit(r).alias("schema_name"), F.count("*").alias("n")
            )
            for r in releases
        ]
        result = counts[0]
        for more in counts[1:]:
            result = result.unionByName(more)
        return result

    def _decision(self, release: str):
        current = self.current()
        previous = status.newest_finalised(current, other_than=release).head()
        compared = [release] + ([previous["schema_name"]] if previous else [])
        decision = status.finalise_decision(current, self.street_counts(compared), release)
        rows = decision.take(2)
        if len(rows) != 1:
            raise LookupError(f"{len(rows)} status rows for {release}")
        return rows[0]

    def within_tolerance(self, release: str) -> bool:
        return self._decision(release)["within_tolerance"]

    def finalise(
        self, release: str, force: bool = False, directories: DataFrame | None = None
    ) -> dict:
        """Publish a completed release of plausible size.

        The result keeps the tolerance outcome and whether it was published.
        With ``directories`` (the epochs' input folders) a published release
        comes with its ``cleanup``: which of them stay. Nothing is deleted.
        """
        decision = self._decision(release)
        publish = bool(decision["proceed"]) or force
        if publish:
            self.publish(release)
        result = {"within_tolerance": decision["within_tolerance"], "published": publish}
        if publish and directories is not None:
            epoch = re.fullmatch(r"ab(.*)_\d{8}_\d{6}", release)
            result["cleanup"] = status.cleanup_plan(directories, epoch[1] if epoch else release)
        return result

    def publish(self, release: str) -> None:
        """Show the release to readers, then record it; its timestamp stays.

        A failure before the switch leaves the public release as it was, one
        after it leaves a release that readers see and that is not recorded:
        ``superseded`` spares it, and publishing again completes it.
        """
        row = self.current().filter(F.col("schema_name") == release).head()
        if self.joint:
            self._publish_both(release)
        else:
            self._publish_view(release, LOOKUP, views.LOOKUP_COLUMNS)
        self.record(release, status.FINALISED, row["error_message"], row["timestamp"])

    def _listed(self, columns: list[str]) -> str:
        return ", ".join(f"{name} AS {self.public_names.get(name, name)}" for name in columns)

    def _publish_view(self, release: str, table: str, columns: list[str]) -> None:
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self._public_view(table)} "
            f"TBLPROPERTIES ('release' = '{checked_name(release)}') AS "
            f"SELECT {self._listed(columns)} FROM `{checked_name(release)}`.`{table}`"
        )

    def _publish_both(self, release: str) -> None:
        """Both views learn of the release, then the pointer moves to it."""
        for table in (LOOKUP, COMBINED):
            if not self.spark.catalog.tableExists(f"{checked_name(release)}.{table}"):
                raise LookupError(f"{release} has no {table}")
        shown = {table: self.public_release(table) for table in (LOOKUP, COMBINED)}
        if None in shown.values() or len(set(shown.values())) > 1:
            # Nothing to keep in step with: the first joint publication.
            shown = dict.fromkeys(shown)
        if not self.spark.catalog.tableExists(f"{self.public}.{POINTER}"):
            self._point(shown[LOOKUP] or release)
        for table, before in shown.items():
            self._joint_view(table, list(dict.fromkeys(r for r in (before, release) if r)))
        self._point(release)

    def _point(self, release: str) -> None:
        """One statement: readers see all of one release or all of the other."""
        self.spark.sql(
            f"CREATE OR REPLACE VIEW `{self.public}`.`{POINTER}` AS "
            f"SELECT '{checked_name(release)}' AS release"
        )

    def _joint_view(self, table: str, releases: list[str]) -> None:
        """The rows of whichever of the releases the pointer names.

        The pointer is a constant to the planner: a branch that it does not
        name is no part of the plan.
        """
        columns = {LOOKUP: views.LOOKUP_COLUMNS, COMBINED: views.COMBINED_COLUMNS}[table]
        branches = " UNION ALL ".join(
            f"SELECT {self._listed(columns)} FROM `{checked_name(r)}`.`{table}` "
            f"WHERE (SELECT release FROM `{self.public}`.`{POINTER}`) = '{r}'"
            for r in releases
        )
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self._public_view(table)} "
            f"TBLPROPERTIES ('branches' = '{','.join(releases)}') AS {branches}"
        )

    def _public_view(self, table: str) -> str:
        return f"`{self.public}`.`{self.public_names.get(table, table)}`"

    def public_table(self, table: str = LOOKUP) -> DataFrame:
        return self.spark.table(self._public_view(table))

    def find(self, release: str, column: str, *values) -> DataFrame:
        """Rows of a lookup by one of its lookup columns.

        Where it was built on a curve, only the files that may hold the values
        are opened.
        """
        stored = self.spark.table(f"`{checked_name(release)}`.`{LOOKUP}`")
        if not self.spark.catalog.tableExists(f"{release}.{LOOKUP_FILES}"):
            return lookups.find(stored, column, *values)
        index = self.spark.table(f"`{release}`.`{LOOKUP_FILES}`")
        return lookups.find_in_files(stored, index, column, *values)[0]

    def find_words(self, release: str, text: str, table: str = LOOKUP) -> DataFrame:
        """Rows of a release whose tokens contain every word of ``text``."""
        one = self.spark.createDataFrame([(text,)], "words string")
        lexemes = one.selectExpr(f"{tokens.tokens('words')}.lexeme as lexemes").head()["lexemes"]
        return lookups.find_words(
            self.spark.table(f"`{checked_name(release)}`.`{table}`"),
            lexemes,
            self.spark.table(f"`{release}`.`{table}_tokens`"),
        )
