"""Quarantine table: refused payloads and messages, with reason and whole payload. Beside it
the ledger: which tables each load wrote."""

from __future__ import annotations

import uuid
from threading import RLock

from pyspark.sql import DataFrame, SparkSession, functions as F

from telemill.functions.names import quoted
from telemill.options import Options
from telemill.sinks import commits, days, parked, tables

# Scope of refusals that were known before any table was looked at; others have the
# table's name.
PAYLOADS = "payloads"

COLUMNS = {
    "seq": "BIGINT",
    "topic": "STRING",
    "recv_ts": "TIMESTAMP_NTZ",
    "target": "STRING",
    "pos": "INT",
    "reason": "STRING",
    "violations": "INT",
    "payload": "STRING",
    "load": "STRING",
}

# ``merged`` is the name a closed load's rows were merged under, for a load that was. In both
# tables ``load`` is the load's own name where the partition has that of a merge.
LEDGER = {"route_schema": "STRING", "route_table": "STRING", "merged": "STRING", "load": "STRING"}

# Names of merged notes begin so.
NOTES = "notes-"


def _name(options: Options) -> str:
    return tables.table_name(options.quarantine_schema, options.quarantine_table, options)


def _ledger_name(options: Options) -> str:
    return tables.table_name(options.quarantine_schema, options.ledger_table, options)


def ensure(spark: SparkSession, options: Options) -> None:
    """Makes the quarantine, the ledger and what else is kept beside them."""
    batch = f"{quoted(options.batch_column)} STRING"
    wanted = {
        options.quarantine_table: (COLUMNS, [batch, "scope STRING"]),
        options.ledger_table: (LEDGER, [batch]),
        options.days_table: (days.COLUMNS, ["route STRING", batch]),
        options.hidden_table: (commits.COLUMNS, [batch]),
        options.parked_table: (parked.COLUMNS, [batch, "scope STRING"]),
    }
    with tables.DEFINITIONS:
        names = {table: tables.table_name(options.quarantine_schema, table, options) for table in wanted}
        missing = [table for table, name in names.items() if not spark.catalog.tableExists(name)]
        if missing:
            tables.ensure_schema(spark, options.quarantine_schema, options)
        for table in missing:
            columns, keys = wanted[table]
            definitions = ", ".join([*(f"{column} {kind}" for column, kind in columns.items()), *keys])
            partitions = ", ".join(key.rpartition(" ")[0] for key in keys)
            spark.sql(f"CREATE TABLE IF NOT EXISTS {names[table]} ({definitions}) USING parquet PARTITIONED BY ({partitions})")


def write(rejects: DataFrame, batch: str, scope: str, options: Options) -> None:
    placed = rejects.withColumns({options.batch_column: F.lit(batch), "scope": F.lit(scope)})
    tables.overwrite_partitions(placed, _name(options))


def read(spark: SparkSession, options: Options) -> DataFrame:
    """All refusals with the ``load`` each is from; while notes are merged, none twice."""
    rows = _with_load(spark.table(_name(options)), options)
    names = commits.hidden(spark, options.quarantine_schema, options.quarantine_table, options, loads=False)
    return rows.where(~F.col(options.batch_column).isin(names)) if names else rows


def _with_load(rows: DataFrame, options: Options) -> DataFrame:
    return rows.withColumn("load", F.coalesce("load", options.batch_column))


def drop_other_scopes(spark: SparkSession, batch: str, written: set[str], options: Options) -> None:
    """Drops what an earlier attempt of a load refused and this one did not."""
    tables.drop_scopes(spark, _name(options), batch, written, options)


def ledger(spark: SparkSession, options: Options, *batches: str) -> DataFrame:
    """What is noted, of all loads or of those named; merged notes are looked through for them."""
    rows = _with_load(spark.table(_ledger_name(options)), options)
    if batches:
        at = F.col(options.batch_column)
        rows = rows.where(at.isin(*batches) | at.startswith(NOTES)).where(F.col("load").isin(*batches))
    return rows


def loaded_routes(spark: SparkSession, batch: str, options: Options) -> list[tuple[str, str]]:
    """The tables an earlier attempt of a load wrote, none for a first one."""
    rows = ledger(spark, options, batch)
    merged = rows.where("merged IS NOT NULL").first()
    if merged is not None:
        raise ValueError(f"load {batch!r} is closed: its rows were merged into {merged.merged!r}")
    return [(row.route_schema, row.route_table) for row in rows.select("route_schema", "route_table").distinct().toLocalIterator()]


def note(spark: SparkSession, batch: str, routes: list[tuple[str, str]], options: Options, merged: str | None = None) -> None:
    """Writes down the tables of a load, in place of what was noted before."""
    rows = spark.createDataFrame([(*route, merged, None) for route in routes], ", ".join(f"{k} {v}" for k, v in LEDGER.items()))
    tables.overwrite_partitions(rows.coalesce(1).withColumn(options.batch_column, F.lit(batch)), _ledger_name(options))


_MERGES = RLock()


def merge_notes(spark: SparkSession, batches: list[str], options: Options | None = None) -> str:
    """Merges what the quarantine and the ledger hold of the named loads, or of earlier merges,
    into a partition per table refused and one of the ledger; returns the name these have.

    The loads must be closed: complete, and not to be run again, which for a stream leaves out its
    last micro-batch. They are noted as closed in one step before anything is moved, so a load of
    such a name is refused from then on. Other loads may run meanwhile; merges run one at a time.
    Readers of the quarantine see either the loads' own partitions or the merged ones. A merge that
    broke off is undone by the next one, or finished if readers saw it already.
    """
    options = options or Options()
    ensure(spark, options)
    with _MERGES:
        under_way = _mend(spark, options)
        broken = sorted({name for names in under_way.values() for name in names}.intersection(batches))
        if broken:
            raise ValueError(f"loads that are not complete: {', '.join(broken)}")
        into = f"{NOTES}{uuid.uuid4().hex[:20]}"
        mine = F.col(options.batch_column).isin(*batches)
        route = options.quarantine_schema, options.quarantine_table
        commits.hide(spark, into, [into], options, route)
        _close(spark, batches, into, options)
        refused = _with_load(spark.table(_name(options)).where(mine), options)
        tables.overwrite_partitions(
            refused.hint("rebalance", "scope").withColumn(options.batch_column, F.lit(into)), _name(options)
        )
        # In one step the merged rows are seen and the loads' own are not.
        commits.hide(spark, into, batches, options, route)
        _drop(spark, batches, options)
        commits.show(spark, into, options)
    return into


def _close(spark: SparkSession, batches: list[str], into: str, options: Options) -> None:
    """Notes all tables of the loads, and the loads themselves, as merged."""
    noted = _with_load(spark.table(_ledger_name(options)).where(F.col(options.batch_column).isin(*batches)), options)
    own = [(None, None, None, name) for name in batches if not name.startswith(NOTES)]
    named = spark.createDataFrame(own, ", ".join(f"{k} {v}" for k, v in LEDGER.items()))
    rows = noted.select(*LEDGER).unionByName(named).withColumn("merged", F.coalesce("merged", F.lit(into)))
    # In order of loads, so that a look for one of them skips most of the rows.
    ordered = rows.distinct().sort("load").withColumn(options.batch_column, F.lit(into))
    tables.overwrite_partitions(ordered, _ledger_name(options))


def _drop(spark: SparkSession, batches: list[str], options: Options) -> None:
    """Drops partitions of loads from both tables."""
    for name, keys in ((_name(options), (options.batch_column, "scope")), (_ledger_name(options), (options.batch_column,))):
        found = spark.table(name).where(F.col(options.batch_column).isin(*batches)).select(*keys).distinct()
        tables.drop_partitions(spark, name, [row.asDict() for row in found.toLocalIterator()])


def _mend(spark: SparkSession, options: Options) -> dict[str, list[str]]:
    """Undoes or finishes merges that broke off; returns what else is under way."""
    under_way = commits.hiding(spark, options)
    for into in [name for name in under_way if name.startswith(NOTES)]:
        _drop(spark, under_way.pop(into), options)  # before readers saw it, what it hides is itself
        commits.show(spark, into, options)
    return under_way
