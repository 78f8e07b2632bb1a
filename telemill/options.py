"""Settings of an ingest: names, defaults and switches."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Options:
    # What a record gets when it does not carry the key itself.
    default_schema: str = "public"
    default_table: str = "example"
    default_timestamp: str = "1970-01-01 08:00:00"
    default_device: str = "id"

    # Names of the two columns every table has.
    ts_column: str = "timestamp"
    id_column: str = "deviceid"

    # Message side table.
    message_switch: bool = True
    message_key: str = "message"
    message_schema: str = "public"
    message_table: str = "message"
    message_columns: tuple[str, ...] = ("message", "level", "source", "logpath")
    # "all" keeps every message of a list payload, "last" only the last one.
    message_keep: str = "all"

    # "batch": all rows of a list payload take timestamp and device of its first
    # element; "record": each row keeps its own.
    header: str = "batch"

    # Partition columns of the tables.
    batch_column: str = "ingest_batch"
    date_column: str = "ts_date"
    hour_column: str = "ts_hour"

    # Width of the partitions of tables that are made from now on: "hour", "day" or "month". A
    # table keeps its own; the date column of one by months holds their first days.
    chunk: str = "day"

    # What columns of the json tag are made as: "text" or "variant".
    json_as: str = "text"

    quarantine_schema: str = "quarantine"
    quarantine_table: str = "rejects"
    # Beside the quarantine: what each load wrote, rows per day, loads that readers do not see yet,
    # outcomes whose table could not take them, and key ranges of plain tables.
    ledger_table: str = "loads"
    days_table: str = "days"
    hidden_table: str = "hidden"
    parked_table: str = "parked"
    keys_table: str = "key_ranges"

    # Whether outcomes of a table that cannot be written are parked, so that a load goes on
    # without them; otherwise the load raises when all else is done, and stays hidden.
    park_failures: bool = True

    # Prefix of every database name, and the folder databases are created in; by default
    # the session's warehouse.
    database_prefix: str = ""
    warehouse: str | None = None

    # Tasks to spread raw messages over before they are parsed, for input in a few files
    # that cannot be split; by default they are parsed where they are read.
    parse_tasks: int | None = None

    # Appends to different tables that may run at the same time.
    parallel_routes: int = 8

    @property
    def reserved_columns(self) -> list[str]:
        return [*self.table_columns, self.hour_column.lower()]

    @property
    def table_columns(self) -> list[str]:
        """What every time-partitioned table has."""
        names = (self.ts_column, self.id_column, self.batch_column, self.date_column)
        return [name.lower() for name in names]

    @property
    def partition_columns(self) -> list[str]:
        return [self.batch_column, self.date_column, self.hour_column]

    def database(self, schema: str) -> str:
        return self.database_prefix + schema
