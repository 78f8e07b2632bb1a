"""One load: raw messages into the tables they name.

The payloads are parsed once into staged outcomes, which lie by table. Each table then
settles its columns, is created or widened, checks its cells and is appended to with a
projection made for its columns, several tables at a time and each reading its own files
only. A load has a name; running it again replaces all that it wrote before.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import contextmanager, suppress
from dataclasses import dataclass, field
from threading import BoundedSemaphore

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.util import inheritable_thread_target

from telemill.functions.names import is_catalog_name, route_id, route_id_of, route_scope
from telemill.operators import flatten
from telemill.operators.coerce import row_fault
from telemill.operators.decode import STRUCTURE_REASONS
from telemill.operators.dictionary import ROUTE, column_dictionary, route_columns
from telemill.options import Options
from telemill.plans.parse import DEFAULT_PARSER, parse
from telemill.session import scratch
from telemill.sinks import commits, days, parked, quarantine, tables
from telemill.sources.raw import numbered

Route = tuple[str, str]


@dataclass
class LoadReport:
    """Rows stored per table, refusals per reason, tables whose outcomes were parked with the
    error, and the seconds a load took."""

    batch: str
    stored: dict[Route, int] = field(default_factory=dict)
    refused: dict[str, int] = field(default_factory=dict)
    parked: dict[Route, str] = field(default_factory=dict)
    seconds: float = 0.0

    def refuse(self, reason: str, outcomes: int) -> None:
        if outcomes:
            self.refused[reason] = self.refused.get(reason, 0) + outcomes


class LoadError(Exception):
    """Some tables could not be written; the others are done. Run the load again."""

    def __init__(self, batch: str, failures: dict[Route, Exception]) -> None:
        named = "; ".join(f"{'.'.join(route)}: {error}" for route, error in failures.items())
        super().__init__(f"load {batch!r}: {named}")
        self.failures = failures


#: Bytes of a path's part that a load's name may take, special characters taking three.
NAME_BYTES = 200


def check_name(batch: str) -> None:
    """A load's name is part of paths; one that is too long is refused before any work."""
    size = sum(1 if x.isascii() and (x.isalnum() or x in "_.-") else 3 * len(x.encode()) for x in batch)
    if not 0 < size <= NAME_BYTES:
        raise ValueError(f"a load's name takes 1 to {NAME_BYTES} bytes of a path, this one {size}: {batch[:80]!r}")


def load(
    raw: DataFrame,
    batch: str,
    options: Options | None = None,
    parser: str = DEFAULT_PARSER,
    staging: str | None = None,
    spread: bool = False,
) -> LoadReport:
    """Loads ``raw`` as the load named ``batch``.

    The outcomes are staged by table in shared storage, in ``staging`` (a new folder, which
    is left for the caller to drop) or in a scratch folder, so that a lost executor costs no
    second parse. Readers see nothing of the load before all of it is written. A table that
    cannot be written harms itself alone: payloads for one that is not made for loads are
    refused, and where a write fails the table's outcomes are parked for ``unpark``.

    ``spread`` deals the messages out by their numbers before they are parsed, for input in fewer
    parts than there are tasks; ``parse_tasks`` of the options goes before it.
    """
    options = options or Options()
    spark = raw.sparkSession
    check_name(batch)
    began = time.monotonic()
    report = LoadReport(batch)
    quarantine.ensure(spark, options)
    earlier = quarantine.loaded_routes(spark, batch, options)
    raw = numbered(raw)
    source = raw.repartition("seq") if spread else raw
    if options.parse_tasks:
        source = raw.repartition(options.parse_tasks)
    with _folder(spark, staging) as folder:
        refusals = Observation()
        staged = stage(parse(source, options, parser), folder, refusals)
        written, scopes, failures = set(), set(), {}
        # From here on readers see nothing of the load until it is shown again.
        commits.hide(spark, batch, [batch], options)
        if _early_refusals(staged, refusals.get, report):
            quarantine.write(flatten.rejected(staged), batch, quarantine.PAYLOADS, options)
            scopes.add(quarantine.PAYLOADS)
        # What may be written from here on is noted first, so that a load that breaks off
        # is known when it runs again.
        routes = staged.where("reason IS NULL").select(*ROUTE).distinct()
        noted = {(row.route_schema, row.route_table) for row in routes.toLocalIterator()}
        if noted or earlier:
            quarantine.note(spark, batch, sorted(noted.union(earlier)), options)

        def append(route: Route, columns: dict[str, str]) -> tuple[int, dict[str, int]]:
            return _append_or_park(staged, route, columns, batch, route in earlier, options)

        found = route_columns(column_dictionary(staged))
        wanted = (
            ((row.route_schema, row.route_table), {entry.column: entry.storage for entry in row.columns})
            for row in found.toLocalIterator()
        )
        parked_scopes = set()
        for route, result in _in_threads(spark, append, wanted, options.parallel_routes):
            error = result.exception()
            if isinstance(error, Parked):
                report.parked[route] = str(error)
                parked_scopes.add(route_scope(*route))
                written.add(route)
                continue
            if error is not None:
                failures[route] = error
                continue
            report.stored[route], refused = result.result()
            written.add(route)
            if refused:
                scopes.add(route_scope(*route))
            for reason, count in refused.items():
                report.refuse(reason, count)
        if failures:
            raise LoadError(batch, failures)
        for route in set(earlier) - written:
            _forget(spark, route, batch, options)
        if earlier and set(earlier) != noted:
            quarantine.note(spark, batch, sorted(noted), options)
        quarantine.drop_other_scopes(spark, batch, scopes, options)
        parked.drop_others(spark, batch, parked_scopes, options)
        commits.show(spark, batch, options)
    report.seconds = time.monotonic() - began
    return report


class Parked(Exception):
    """The outcomes of a table are in the parked area; the text is the error they failed with."""


def _append_or_park(
    staged: DataFrame, route: Route, wanted: dict[str, str], batch: str, again: bool, options: Options
) -> tuple[int, dict[str, int]]:
    """Appends, a second time after a failure that may pass; what fails for good is parked."""
    mine = _of_route(staged, route)
    for last in (False, True):
        try:
            return append_outcomes(mine, route, wanted, batch, again, options)
        except Exception as error:
            if not last and not isinstance(error, (tables.OtherType, AnalysisException)):
                again = True
                continue
            if not options.park_failures:
                raise
            parked.park(mine, route, batch, error, options)
            with suppress(Exception):  # what an earlier attempt stored there, if it can be dropped
                _forget(staged.sparkSession, route, batch, options)
            raise Parked(str(error)) from error
    raise AssertionError


def _of_route(staged: DataFrame, route: Route) -> DataFrame:
    return flatten.accepted(staged).where(F.col("route_id") == route_id(*route))


def _forget(spark: SparkSession, route: Route, batch: str, options: Options) -> None:
    """Drops what a load has stored in a table."""
    if not all(map(is_catalog_name, route)) or not spark.catalog.tableExists(tables.table_name(*route, options)):
        return
    tables.drop_chunks(spark, *route, batch, tables.batch_chunks(spark, *route, batch, options), options)
    days.forget(spark, *route, batch, options)


def append_outcomes(
    mine: DataFrame, route: Route, wanted: dict[str, str], batch: str, again: bool, options: Options
) -> tuple[int, dict[str, int]]:
    """One table's part of a load, from accepted outcomes for it: rows stored, and refusals by
    reason. One pass over them checks, counts and stores; refused ones take a second pass."""
    spark, scope = mine.sparkSession, route_scope(*route)
    if not all(map(is_catalog_name, route)):  # the catalog takes Latin letters only
        return 0, _refuse(mine, F.lit("bad_route"), batch, scope, options)
    try:
        present = tables.ensure_table(spark, *route, wanted, options)
    except tables.NotATimeTable:
        return 0, _refuse(mine, F.lit("bad_table"), batch, scope, options)
    columns = {name: present[name] for name in wanted}
    mine = dealt(mine, len(columns))
    fault = row_fault(F.col("rows"), columns)
    if again:
        _forget(spark, route, batch, options)
    seen = Observation()
    judged = mine.select("rows", fault.alias("fault")).observe(
        seen,
        F.sum(F.when(F.col("fault").isNull(), F.size("rows"))).alias("stored"),
        F.count(F.col("fault")).alias("refused"),
    )
    kept = fitting_rows(judged, F.col("fault"))
    # Staged files lie by table and day already.
    tables.append(flatten.wide(kept, columns, options, checked=True), *route, batch, options, gather=False)
    stored = seen.get["stored"] or 0
    days.note(spark, *route, batch, stored, options)
    return stored, _refuse(mine, fault, batch, scope, options) if seen.get["refused"] else {}


#: A table of more columns is written by tasks of so many cells each, empty ones included.
WIDE_COLUMNS, CELLS_A_TASK = 100, 16_000_000


def dealt(mine: DataFrame, columns: int) -> DataFrame:
    """One table's outcomes, those for many columns by as many tasks as their cells ask for: a staged
    file of a few bytes a row is cut by its size, which says little of the rows it becomes."""
    if columns <= WIDE_COLUMNS:
        return mine
    rows = mine.agg(F.sum(F.size("rows"))).first()[0] or 0
    tasks = -(-rows * columns // CELLS_A_TASK)
    first_day = F.get("rows", F.lit(0))["ts"].cast("date")
    return mine.repartitionByRange(tasks, first_day, "seq") if tasks > 1 else mine


def _refuse(mine: DataFrame, fault: Column, batch: str, scope: str, options: Options) -> dict[str, int]:
    """Quarantines the outcomes with a fault, and counts them by reason."""
    refused = flatten.rejected(mine.withColumn("reason", F.explode_outer(F.array(fault.cast("string")))))
    seen = Observation()
    quarantine.write(refused.observe(seen, *_by_reason(TABLE_REASONS)), batch, scope, options)
    return {reason: seen.get[reason] for reason in TABLE_REASONS if seen.get[reason]}


#: Reasons to refuse an outcome for its table, and those known before.
TABLE_REASONS = ("cast_failed", "bad_table", "bad_route")
EARLY_REASONS = (
    *STRUCTURE_REASONS, "bad_route", "field_set_mismatch", "bad_column", "duplicate_column",
    "null_timestamp", "bad_timestamp", "null_deviceid", "bad_deviceid",
)


def _by_reason(reasons: tuple[str, ...]) -> list[Column]:
    reason = F.col("reason")
    return [F.count(reason).alias("all"), *(F.count(F.when(reason == x, 1)).alias(x) for x in reasons)]


def unpark(spark: SparkSession, schema: str, table: str, options: Options | None = None) -> dict[str, LoadReport]:
    """Loads what is parked for a table, load by load in the order they were parked, under the
    names of the loads it is from; returns a report for each. What cannot be stored now either
    stays parked, and its error is raised. Readers see a load's rows when all of them are there.
    """
    options = options or Options()
    quarantine.ensure(spark, options)
    route = schema, table
    found = parked.waiting(spark, options).where((F.col("route_schema") == schema) & (F.col("route_table") == table))
    reports = {}
    for row in found.orderBy("parked_at").toLocalIterator():
        batch, began = row[options.batch_column], time.monotonic()
        mine = parked.of_load(spark, route, batch, options)
        entries = route_columns(column_dictionary(mine)).first()
        columns = {entry.column: entry.storage for entry in entries.columns}
        name = f"unpark-{route_id(*route)}-{hashlib.sha256(batch.encode()).hexdigest()[:20]}"
        commits.hide(spark, name, [batch], options, route)
        report = reports[batch] = LoadReport(batch)
        report.stored[route], refused = append_outcomes(mine, route, columns, batch, True, options)
        for reason, count in refused.items():
            report.refuse(reason, count)
        commits.show(spark, name, options)
        parked.drop(spark, route, batch, options)
        report.seconds = time.monotonic() - began
    return reports


def stage(outcomes: DataFrame, folder: str, refusals: Observation | None = None) -> DataFrame:
    """Writes outcomes to a new folder and reads them back, for work that needs them more
    than once; ``refusals`` counts those refused on the way.

    They are gathered by table and day, so that neither these files nor the tables' own
    become many and small. The rebalance splits a table or day that is too large for one
    task. Folders are named by a short name of the table, ``route_id``.
    """
    first_day = F.get("rows", F.lit(0))["ts"].cast("date")
    placed = outcomes.withColumns({"first_day": first_day, "route_id": route_id_of(*map(F.col, ROUTE))})
    placed = placed.hint("rebalance", "route_id", "first_day")
    if refusals is not None:
        # Behind the shuffle, where a task that is run again is not counted again.
        placed = placed.observe(refusals, *_by_reason(EARLY_REASONS))
    placed.write.partitionBy("route_id").parquet(folder)
    schema = StructType([*outcomes.schema.fields, StructField("route_id", StringType())])
    return outcomes.sparkSession.read.schema(schema).parquet(folder)


@contextmanager
def _folder(spark: SparkSession, staging: str | None) -> Iterator[str]:
    if staging is not None:
        yield staging
        return
    with scratch(spark, "outcomes") as folder:
        yield folder


def _early_refusals(staged: DataFrame, seen: dict[str, int], report: LoadReport) -> bool:
    """Notes what was refused before any table was looked at."""
    known = {reason: seen[reason] for reason in EARLY_REASONS}
    if sum(known.values()) < seen["all"]:  # a parser with reasons of its own
        rows = staged.where("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("outcomes")).collect()
        known = {row.reason: row.outcomes for row in rows}
    for reason, outcomes in known.items():
        report.refuse(reason, outcomes)
    return bool(report.refused)


def fitting_rows(mine: DataFrame, fault: Column) -> DataFrame:
    """Rows of the outcomes without a fault."""
    kept = F.when(fault.isNull(), F.col("rows"))
    # Exploded in the outer form so that the check is evaluated once.
    exploded = mine.select(F.explode_outer(kept).alias("row")).where(F.col("row").isNotNull())
    return exploded.select("row.ts", "row.id", "row.cells")


def _in_threads(
    spark: SparkSession, task: Callable, arguments: Iterator[tuple[Route, dict[str, str]]], width: int
) -> Iterator[tuple[Route, Future]]:
    """Runs the tasks, so many at a time, and gives back each when it is done; small tables
    do not fill a cluster one at a time. No more arguments are drawn than are at work."""
    width = max(width, 1)
    room = BoundedSemaphore(2 * width)
    run = inheritable_thread_target(spark)(task)
    with ThreadPoolExecutor(max_workers=width) as pool:
        running: list[tuple[Route, Future]] = []
        for item in arguments:
            room.acquire()
            future = pool.submit(run, *item)
            future.add_done_callback(lambda _: room.release())
            running.append((item[0], future))
            done = [one for one in running if one[1].done()]
            running = [one for one in running if not one[1].done()]
            yield from done
        for one in running:
            one[1].exception()
            yield one
