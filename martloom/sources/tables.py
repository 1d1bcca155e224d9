"""The three layers as databases of Parquet tables."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from threading import RLock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from martloom.config import MartConfig
from martloom.functions.conform import conform, require_ansi
from martloom.operators.checks import require_primary_key
from martloom.schemas import (
    BUCKETED,
    KEY_COLUMNS,
    PRIMARY_KEYS,
    TABLES,
    columns_of,
    create_table_sql,
    struct_of,
)
from martloom.sources.buckets import Buckets, write_bucketed
from martloom.sources.loads import Load, LoadLog, Move
from martloom.sources.staging import COMPRESSION, Staging, hadoop_path

SLOTS = ("a", "b")
# Property of a table that names the load that it shows.
LOAD_PROPERTY = "martloom.load"


class Warehouse:
    """Tables that are replaced as a whole.

    Every table owns two folders and points at one. A refresh writes the other, checks it
    and then moves the pointer, so a load that fails, or an executor that dies, leaves the
    table as it was. (INSERT OVERWRITE drops the old files before it writes.)

    Tables that are published together are one load. Its record is written before the first
    pointer moves; if a driver dies between two of them, the next use of the warehouse moves the rest.
    `read_load` gives tables of one load at any moment. One driver at a time may load.
    """

    def __init__(
        self, spark: SparkSession, root: str, config: MartConfig, prefix: str = ""
    ) -> None:
        require_ansi(spark)
        self.spark = spark
        self.root = root.rstrip("/")
        self.config = config
        self.prefix = prefix
        self.staging = Staging(spark)
        self.loads = LoadLog(spark, f"{self.root}/{prefix}loads")
        self._waiting: dict[str, str] = {}
        self._lock = RLock()

    def create_layers(self) -> None:
        """Create the databases and empty tables that are not there yet."""
        for layer, tables in TABLES.items():
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.prefix}{layer}`")
            for table in tables:
                self.spark.sql(
                    create_table_sql(
                        self.prefix + layer, table, self._slot(table, SLOTS[0]), self.config.key_type,
                        buckets.clause() if (buckets := self.buckets_of(table)) else "",
                    )
                )

    def drop_layers(self) -> None:
        """Forget the databases; the files of the tables stay."""
        for layer in TABLES:
            self.spark.sql(f"DROP DATABASE IF EXISTS `{self.prefix}{layer}` CASCADE")

    def name_of(self, table: str) -> str:
        layer = next(name for name, tables in TABLES.items() if table in tables)
        return f"`{self.prefix}{layer}`.`{table}`"

    def buckets_of(self, table: str) -> Buckets | None:
        if table not in BUCKETED:
            return None
        return Buckets(BUCKETED[table], self.config.order_buckets)

    def _require_buckets(self, table: str, buckets: Buckets) -> None:
        """A table shows files by the number of buckets that it was made with. (One that was made
        without buckets shows all files.)"""
        facts = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name_of(table)}")
        made = facts.filter("col_name = 'Num Buckets'").first()
        if made is not None and int(made["data_type"]) != buckets.count:
            raise ValueError(
                f"{table} was made with {made['data_type']} buckets, order_buckets is {buckets.count}"
            )

    def _entry_of(self, table: str, path: str) -> str:
        """The catalog name of a bucketed table's rows in one of its folders."""
        return f"{self.name_of(table)[:-1]}__{path[-1]}`"

    def read_table(self, table: str, query: str = "SELECT * FROM {table}") -> DataFrame:
        """The published rows, or any query over them that names the table {table}."""
        return self.spark.sql(query.replace("{table}", self.name_of(table)))

    def stage(
        self, table: str, df: DataFrame, check_key: bool = False, conformed: bool = False
    ) -> DataFrame:
        """Write rows to the idle folder of a table and return what was written.

        Columns are bound by name. Types and lengths, and the primary key if asked for, are
        enforced here, before any reader sees a row. `conformed` rows are known to have them
        and are only put in column order.
        """
        with self._lock:
            self.recover()  # or its folders would be written over
            path = self._slot(table, self._idle_slot(table))
        names = [name for name, _ in columns_of(table)]
        rows = df.select(*names) if conformed else conform(df, table, self.config.key_type)
        buckets = self.buckets_of(table)
        if buckets:
            self._require_buckets(table, buckets)
            written = write_bucketed(rows, self._entry_of(table, path), path, buckets, COMPRESSION)
        else:
            rows.write.mode("overwrite").parquet(path, compression=COMPRESSION)
            schema = struct_of(table, self.config.key_type)
            written = self.spark.read.schema(schema).parquet(path)
        if check_key:
            require_primary_key(written, table)
        self._waiting[table] = path
        return written

    def save(self, name: str, df: DataFrame) -> DataFrame:
        """Stage a declared table, or write an intermediate one to the shared folder."""
        if any(name in tables for tables in TABLES.values()):
            return self.stage(name, df)
        return self.staging.save(name, df)

    def publish(self, *only: str) -> None:
        """Point staged tables (all, or some) at their new rows, parents before children, as one
        load."""
        with self._lock:
            self.recover()
            staged = [
                table
                for tables in TABLES.values()
                for table in tables
                if table in self._waiting and (not only or table in only)
            ]
            if not staged:
                return
            moves = {table: Move(self._location(table), self._waiting.pop(table)) for table in staged}
            load = Load(uuid.uuid4().hex, moves)
            self.loads.begin(load)
            self._complete(load)

    def recover(self) -> str | None:
        """Bring a load to its end whose driver died while it was published, and return its id.
        Should one of its folders be gone, the tables that have moved go back."""
        load = self.loads.unfinished()
        if load is None:
            return None
        if all(self._exists(move.after) for move in load.tables.values()):
            self._complete(load)
        else:
            for table, move in load.tables.items():
                self._point(table, move.before, "")
            self.loads.forget()
        return load.load

    def _complete(self, load: Load) -> None:
        for table, move in load.tables.items():
            self._point(table, move.after, load.load)
        self.loads.finish(load)

    def _point(self, table: str, path: str, load: str) -> None:
        name = self.name_of(table)
        self.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{LOAD_PROPERTY}' = '{load}')")
        self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")

    def _exists(self, path: str) -> bool:
        system, where = hadoop_path(self.spark, path)
        return system.exists(where)

    def analyze(self, *tables: str) -> None:
        """Keep row counts of published tables, and what is known of their key columns, in the catalog
        (all tables by default). Joins of later readers are planned by them if their session has
        spark.sql.cbo.enabled; a table that moves on loses them. Only key columns are scanned, and
        none of the raw lines.
        """
        names = tables or [table for layer in TABLES.values() for table in layer]

        def count(table: str) -> None:
            keys = KEY_COLUMNS.get(table)
            columns = f" FOR COLUMNS {', '.join(keys)}" if keys else ""
            self.spark.sql(f"ANALYZE TABLE {self.name_of(table)} COMPUTE STATISTICS{columns}")

        inherited = inheritable_thread_target(self.spark)
        with ThreadPoolExecutor(max_workers=8) as pool:
            list(pool.map(inherited(count), names))

    def load_of(self, table: str) -> str | None:
        """The id of the load whose rows a table shows."""
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name_of(table)}").collect()
        return next((r["value"] or None for r in rows if r["key"] == LOAD_PROPERTY), None)

    def read_load(self, *tables: str) -> dict[str, DataFrame]:
        """Published rows of several tables, all of them before a load or all after it, also while
        pointers are moving: tables of a load that is under way are read from where they go.

        The folders stay as they are until the next but one load writes.
        """
        while True:
            loads, under_way = self.loads.published(), self.loads.unfinished()
            moves = under_way.tables if under_way else {}
            places = {t: moves[t].after if t in moves else self._location(t) for t in tables}
            now = self.loads.unfinished()
            if loads == self.loads.published() and now == under_way:
                break
        return {t: self._read_from(t, places[t]) for t in tables}

    def _read_from(self, table: str, path: str) -> DataFrame:
        entry = self._entry_of(table, path)
        if table in BUCKETED and self.spark.catalog.tableExists(entry):
            return self.spark.table(entry)
        return self.spark.read.schema(struct_of(table, self.config.key_type)).parquet(path)

    def discard(self) -> None:
        """Forget what is staged; the next load writes over it."""
        self._waiting.clear()

    def write_table(self, table: str, df: DataFrame) -> None:
        """Replace a table: all old rows go, all new rows come, or nothing changes."""
        self.stage(table, df, check_key=table in PRIMARY_KEYS)
        self.publish(table)

    def _slot(self, table: str, slot: str) -> str:
        layer = next(name for name, tables in TABLES.items() if table in tables)
        return f"{self.root}/{self.prefix}{layer}/{table}/{slot}"

    def _location(self, table: str) -> str:
        facts = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name_of(table)}")
        return facts.filter("col_name = 'Location'").first()["data_type"].rstrip("/")

    def _idle_slot(self, table: str) -> str:
        return SLOTS[1] if self._location(table).endswith(f"/{SLOTS[0]}") else SLOTS[0]
