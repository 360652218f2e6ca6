"""The daily job: land what is new, then bring the summaries up to date.

Nothing is built anew that a run cannot have changed: monthly summaries are kept
by month, the feature matrix by bucket of customers and conversion paths as a
state to which a window is added.  A first run, and one after a change that
touches everything, builds all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope import schemas
from folioscope.functions.times import day
from folioscope.operators import features, members, path_state, paths
from folioscope.plans import summaries, upkeep
from folioscope.plans.landing import Landing
from folioscope.session import use_checkpoints
from folioscope.sinks import state as job_state
from folioscope.sinks.tables import LOAD, merge_log, read_table, upload_log, write_table
from folioscope.sinks.versions import POINTER, Folder

LOG_SCHEMA = "log_date date, table_name string, row_count bigint, logged_at timestamp_ntz"
REPLACED = ("member_details", "bias_results", "fund_details", "popular_funds")
SNAPSHOT = "snapshot"
BUCKET = "bucket"


def months_between(start: date, end: date) -> list[str]:
    """The months that days from ``start`` up to but not including ``end`` lie in."""
    first = start.year * 12 + start.month - 1
    last = end.year * 12 + end.month - (1 if end.day > 1 else 2)
    return [f"{month // 12}/{month % 12 + 1:02d}" for month in range(first, last + 1)]


class Warehouse:
    """Landed and result tables as parquet folders below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        return read_table(self.spark, self.path(name))

    def has(self, name: str) -> bool:
        return POINTER in Folder(self.spark, self.path(name)).names()

    def __getattr__(self, name: str) -> DataFrame:
        if name not in schemas.LANDED:
            raise AttributeError(name)
        return schemas.conform(self.read(name), schemas.LANDED[name])

    def since(self, name: str, first: date) -> DataFrame:
        """Rows from the day ``first`` on; only those days' partitions are read."""
        rows = self.read(name).filter(F.col(schemas.DAY) >= day(first))
        return schemas.conform(rows, schemas.LANDED[name])

    def of_load(self, name: str, load: str, other: bool = False) -> DataFrame:
        """The rows of one load, or of all ``other`` ones."""
        mine = F.col(LOAD) != load if other else F.col(LOAD) == load
        return schemas.conform(self.read(name).filter(mine), schemas.LANDED[name])

    def of_months(self, months: Sequence[str]) -> MonthsOf:
        return MonthsOf(self, months)

    def matrix(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The feature matrix, or the ``buckets`` of it."""
        matrix = self.read("arketip")
        return matrix if buckets is None else matrix.filter(F.col(BUCKET).isin(list(buckets)))

    def log(self) -> DataFrame:
        return upload_log(self.read("upload_log"))


class MonthsOf(summaries.OfMonths):
    """The same of stored tables: months and days are partitions, so others are not read."""

    def month(self, name: str) -> Column | None:
        return F.date_format(schemas.DAY, upkeep.MONTH) if name in schemas.DAY_OF else super().month(name)

    def rows(self, name: str) -> DataFrame:
        return self.landed.read(name)

    def __getattr__(self, name: str) -> DataFrame:
        return schemas.conform(super().__getattr__(name), schemas.LANDED[name])


class BucketsOf:
    """The landed tables cut to the customers of some buckets."""

    def __init__(self, landed, chosen: Sequence[int], buckets: int):
        self.landed, self.chosen, self.buckets = landed, list(chosen), buckets

    def __getattr__(self, name: str) -> DataFrame:
        table = getattr(self.landed, name)
        if "customer_id" not in table.columns:
            return table
        return table.filter(upkeep.bucket_of("customer_id", self.buckets).isin(self.chosen))


class DailyRun:
    def __init__(
        self,
        spark: SparkSession,
        sources: Mapping[str, DataFrame],
        root: str,
        as_of: date,
        now: datetime,
        legacy_views: bool = False,
        buckets: int = upkeep.BUCKETS,
    ):
        self.spark, self.sources = spark, sources
        self.legacy_views, self.buckets = legacy_views, buckets
        self.warehouse = Warehouse(spark, root)
        self.as_of, self.now = as_of, now
        self.state_path = self.warehouse.path("state")
        state = job_state.read_state(spark, self.state_path)
        self.window = job_state.next_window(state, as_of)
        self.counts: dict[str, int] = {}

    @property
    def load(self) -> str:
        """Loads are named by the start of their window, so a repeat replaces its own."""
        return f"from-{self.window.start}"

    def _write(self, name: str, df: DataFrame, **options) -> None:
        if name in schemas.LANDED:
            df = schemas.conform(df, schemas.LANDED[name])
            if name in schemas.DAY_OF:
                df = df.withColumn(schemas.DAY, F.to_date(schemas.DAY_OF[name]))
                options["partition_by"] = [schemas.DAY]
        self.counts[name] = self.counts.get(name, 0) + write_table(
            df, self.warehouse.path(name), **options
        )

    def _land_new(self, name: str, df: DataFrame) -> None:
        self._write(name, df, mode="append", load=self.load, restart=self.window.initial)

    def land(self) -> None:
        start, end = self.window.start, self.window.end
        use_checkpoints(self.spark)
        new = Landing(self.sources, start, end, self.as_of)
        new.fix_ids()
        shared = members.id_collisions(new.ids)
        if not shared.isEmpty():
            raise ValueError("a kept real id equals another member's random id")
        for name in REPLACED:
            self._write(name, getattr(new, name))
        for name in ("digital_actions", "daily_outstandings"):
            self._land_new(name, getattr(new, name))
        if self.legacy_views:
            self._write("fund_actions", new.fund_actions)
        else:
            self._land_new("fund_actions", new.fund_actions)
        self._land_new("actions", new.window_actions)
        self._write("actions", new.snapshot_actions, mode="append", load=SNAPSHOT)
        # A month is complete only from its first day on, whatever the window.
        months = Landing(self.sources, start.replace(day=1), end, self.as_of)
        months.share_ids(new)
        for name in schemas.BY_MONTH:
            self._write(
                name,
                getattr(months, name),
                mode="partitions",
                partition_by=["year_month"],
                restart=self.window.initial,
                covered=() if self.window.initial else months_between(start, end),
            )

    def compare(self) -> None:
        """What has changed since the last successful run."""
        landed, path = self.warehouse, self.warehouse.path("fingerprints")
        by_customer = {name: getattr(landed, name) for name in ("member_details", "bias_results", "monthly_outstanding_funds")}
        found = upkeep.fingerprints(
            landed.of_load("actions", SNAPSHOT),
            by_customer,
            landed.fund_details,
            landed.popular_funds,
            f"{self.as_of.year} {self.buckets} {self.legacy_views}",
            self.buckets,
        ).checkpoint()
        compared = landed.has("fingerprints") and not self.window.initial and not self.legacy_views
        changed = upkeep.changes(found, read_table(self.spark, path) if compared else None)
        self.fingerprints = found
        self.months = upkeep.months_to_build(changed, months_between(self.window.start, self.window.end))
        loads = [landed.of_load(name, self.load) for name in ("digital_actions", "actions", "fund_actions")] if compared else []
        self.buckets_changed = upkeep.buckets_to_build(
            changed, upkeep.loaded_buckets(loads, self.buckets) if loads else ()
        )

    def _by_month(self, name: str, build) -> None:
        """Build the months that may differ, and leave the others' files as they are."""
        months = self.months
        landed = self.warehouse if months is None else self.warehouse.of_months(months)
        self._write(
            name,
            build(landed),
            mode="partitions",
            partition_by=["year", "month"],
            restart=months is None,
            covered=[tuple(map(int, month.split("/"))) for month in months or ()],
        )
        self._count_whole(name)

    def _count_whole(self, name: str) -> None:
        """Log all rows of a table of which a part was written."""
        self.counts[name] = self.warehouse.read(name).count()

    def _add_paths(self) -> None:
        """Add the window to the state of conversion paths; old events are not read."""
        landed, load = self.warehouse, self.load
        new = summaries.digital_process(LoadOf(landed, load), self.as_of)
        occurrences = paths.conversion_occurrences(new)
        old = earlier = None
        if landed.has("path_state") and not self.window.initial:
            old = landed.read("path_state")
            earlier = landed.read("path_occurrences").filter(F.col(LOAD) != load)
        state = path_state.add_window(old, earlier, new)
        if old is not None:
            hidden = path_state.hidden(old, new, earlier).checkpoint()
            if not hidden.isEmpty():
                whole = summaries.digital_process(LoadOf(landed, SNAPSHOT, other=True), self.as_of)
                again = path_state.path_state(whole.join(hidden, "customer_id", "left_semi"))
                state = path_state.without(state, hidden).unionByName(again)
        restart = self.window.initial
        write_table(occurrences, landed.path("path_occurrences"), mode="append", load=load, restart=restart)
        write_table(state, landed.path("path_state"))
        snapshot = summaries.digital_process(LoadOf(landed, SNAPSHOT, digital=False), self.as_of)
        self._write(
            "out_path_4_events",
            path_state.paths_of_state(
                landed.read("path_state"),
                landed.read("path_occurrences").drop(LOAD),
                summaries.first_day(self.as_of),
                snapshot,
            ),
        )

    def _merge_matrix(self) -> None:
        """Rewrite the buckets of customers whose features may differ."""
        landed, chosen = self.warehouse, self.buckets_changed
        first = self.window.initial or not landed.has("arketip")
        if chosen is not None and not first:
            landed = BucketsOf(landed, chosen, self.buckets)
        previous = None if first else self.warehouse.matrix(chosen)
        matrix = summaries.arketip(landed, self.as_of, previous)
        self._write(
            "arketip",
            matrix.withColumns({"run_date": F.lit(self.as_of), BUCKET: upkeep.bucket_of("customer_id", self.buckets)}),
            mode="partitions",
            partition_by=[BUCKET],
            restart=chosen is None or first,
            covered=[(bucket,) for bucket in chosen or ()] if not first else (),
        )
        self._count_whole("arketip")

    def summarise(self) -> None:
        landed = self.warehouse
        self.compare()
        self._add_paths()
        self._write("summary_static", summaries.summary_static(landed, self.as_of))
        self._by_month("summary_year_month", summaries.summary_year_month)
        self._by_month("summary_year_month_fund_based", summaries.summary_year_month_fund)
        self._merge_matrix()
        write_table(self.fingerprints, landed.path("fingerprints"))

    def log(self) -> None:
        rows = [(self.as_of, name, count, self.now) for name, count in self.counts.items()]
        merge_log(self.spark.createDataFrame(rows, LOG_SCHEMA), self.warehouse.path("upload_log"))

    def run(self) -> dict[str, int]:
        """All steps; any failure propagates, and only success moves the state on."""
        self.land()
        self.summarise()
        self.log()
        job_state.write_state(self.spark, self.state_path, self.window)
        return self.counts


class LoadOf:
    """Events and actions of one load, or of all ``other`` ones, for paths."""

    def __init__(self, warehouse: Warehouse, load: str, other: bool = False, digital: bool = True):
        self.warehouse, self.load, self.other, self.digital = warehouse, load, other, digital

    def since(self, name: str, first: date) -> DataFrame:
        if name == "digital_actions" and not self.digital:
            return self.warehouse.digital_actions.limit(0)
        mine = F.col(LOAD) != self.load if self.other else F.col(LOAD) == self.load
        rows = self.warehouse.read(name).filter(mine & (F.col(schemas.DAY) >= day(first)))
        return schemas.conform(rows, schemas.LANDED[name])


def run_daily(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    root: str,
    as_of: date,
    now: datetime | None = None,
    legacy_views: bool = False,
    buckets: int = upkeep.BUCKETS,
) -> dict[str, int]:
    """One run; ``legacy_views`` keeps only the newest window's fund views."""
    now = now or datetime.combine(as_of, datetime.min.time())
    return DailyRun(spark, sources, root, as_of, now, legacy_views, buckets).run()
