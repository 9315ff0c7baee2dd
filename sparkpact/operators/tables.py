"""Tables under contract: plan them all in one join, write and evolve each."""

from __future__ import annotations

import json
import re
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from sparkpact.functions.types import TYPE_MAPS, map_types
from sparkpact.model import Contract
from sparkpact.operators.documents import built_contracts, explode_columns
from sparkpact.operators.enforce import conform, evolve_rows
from sparkpact.operators.versions import table_name

# Limits and names of a contract's table.
MAX_COLUMNS = 1000
DATABASE = "iceberg_tables"
# Names of columns that files still hold and the table no longer has, as JSON.
DROPPED_PROPERTY = "dropped_columns"
VERSION_PROPERTY = "iceberg_table_version"
UNKNOWN = "Unknown"
DESCRIPTION = "Iceberg table for "

# Statements of the catalog that run at a time.
WORKERS = 8

EXISTING_SCHEMA = "table_name string, name string, type string, contract_id string, version string"


def plan_tables(docs: DataFrame, existing_cols: DataFrame, skip_unknown_types: bool = False) -> DataFrame:
    """``contract_id, table_name, action, added, removed, type_changes, columns_count`` per contract.

    created, updated (a column name added or removed, or another version),
    unchanged, foreign_table (the table is there but carries no version) or
    rejected (no columns, too many, repeated names). ``existing_cols`` has one row
    per column of the tables that exist (``EXISTING_SCHEMA``).

    ``docs`` must hold one document per contract. A retyped column under the same
    version leaves a table unchanged; ``type_changes`` shows it. With
    ``skip_unknown_types`` existing columns of a type that has no counterpart are
    not seen, so they count as added.
    """
    built = built_contracts(docs)
    wanted = explode_columns(built).select(
        "contract_id",
        table_name(F.col("contract_id")).alias("table_name"),
        "version",
        F.col("name"),
        map_types(F.col("data_type"), "provisioned").alias("type"),
    )
    # One row per wanted column name, so that a repeat cannot multiply the join.
    columns = wanted.groupBy("contract_id", "table_name", "name").agg(
        F.count(F.lit(1)).alias("times"), F.max("type").alias("type"), F.max("version").alias("version")
    )
    existing = existing_cols
    if skip_unknown_types:
        existing = existing.where(map_types(F.col("type"), "from_table").isNotNull())
    tables = existing_cols.groupBy("table_name").agg(F.max("version").alias("old_version"))
    claims = built.select(F.col("contract.contract_id").alias("contract_id")).select(
        "contract_id", table_name(F.col("contract_id")).alias("table_name")
    )
    # Each existing column is looked at once for every contract that claims its table.
    old = existing.select("table_name", "name", F.col("type").alias("old_type")).join(claims, "table_name")
    compared = columns.join(old, ["contract_id", "table_name", "name"], "full_outer")
    per_table = compared.groupBy("contract_id", "table_name").agg(
        F.count_if(F.col("old_type").isNull()).alias("added"),
        F.count_if(F.col("times").isNull()).alias("removed"),
        F.count_if(F.col("type") != F.col("old_type")).alias("type_changes"),
        F.coalesce(F.sum("times"), F.lit(0)).alias("columns_count"),
        F.coalesce(F.max("times"), F.lit(0)).alias("most_repeats"),
        F.max("version").alias("version"),
    )
    known = per_table.join(tables.withColumn("exists", F.lit(True)), "table_name", "left")
    action = (
        F.when(
            (F.col("table_name") == "") | ~F.col("columns_count").between(1, MAX_COLUMNS) | (F.col("most_repeats") > 1),
            "rejected",
        )
        .when(F.col("exists").isNull(), "created")
        .when(F.col("old_version").isNull(), "foreign_table")
        .when((F.col("added") > 0) | (F.col("removed") > 0) | (F.col("old_version") != F.col("version")), "updated")
        .otherwise("unchanged")
    )
    new = F.col("exists").isNull()
    return known.select(
        "contract_id",
        "table_name",
        action.alias("action"),
        F.when(new, 0).otherwise(F.col("added")).cast("bigint").alias("added"),
        "removed",
        "type_changes",
        "columns_count",
    )


# -- writing -------------------------------------------------------------------


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def properties(contract: Contract, created_at: datetime | None = None) -> dict[str, str]:
    created = created_at or datetime.now(timezone.utc)
    return {
        "contract_id": contract.contract_id,
        VERSION_PROPERTY: contract.version,
        "created_at": created.replace(tzinfo=None).isoformat(),
        "data_owner": contract.metadata.data_owner or UNKNOWN,
        "data_steward": contract.metadata.data_steward or UNKNOWN,
    }


def contract_table(contract: Contract) -> str:
    return contract.contract_id.replace("-", "_").lower()


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def existing_columns(spark: SparkSession, database: str = DATABASE) -> DataFrame:
    """The catalog's columns as ``plan_tables`` wants them; no rows if there is no such database.

    What the driver handles is schema text, a few lines per table.
    """
    if not spark.catalog.databaseExists(database):
        return spark.createDataFrame([], EXISTING_SCHEMA)
    held = catalog_of(spark, database)
    with ThreadPoolExecutor(WORKERS) as pool:
        lines = [line for of_table in pool.map(held.lines, held.names()) for line in of_table]
    return spark.createDataFrame(lines, EXISTING_SCHEMA)


class Statements:
    """The tables of a database by statements, which any catalog takes."""

    def __init__(self, spark: SparkSession, database: str) -> None:
        self.spark, self.database = spark, database

    def names(self) -> list[str]:
        return [table.name for table in self.spark.catalog.listTables(self.database) if not table.isTemporary]

    def lines(self, table: str) -> list[tuple]:
        """The table as lines of ``EXISTING_SCHEMA``."""
        held = table_properties(self.spark, f"{self.database}.`{table}`")
        # The Python catalog fetches the lines of each table by a job of its own.
        found = self.spark._jsparkSession.catalog().listColumns(f"{self.database}.`{table}`").collectAsList()
        return [(table, c.name(), c.dataType(), held.get("contract_id"), held.get(VERSION_PROPERTY)) for c in found]

    def make_database(self, place: str) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION {_quoted(place)}")

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{name}")

    def properties(self, name: str) -> dict[str, str]:
        return table_properties(self.spark, f"`{self.database}`.`{name}`")

    def described(self, name: str) -> tuple[dict[str, str], str, str]:
        """Properties, location and comment."""
        lines = {r["col_name"]: r["data_type"] for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED `{self.database}`.`{name}`").collect()}
        return self.properties(name), lines["Location"], lines.get("Comment", "")

    def rows(self, name: str, location: str) -> DataFrame | None:
        """The table; none if it has no files."""
        rows = self.spark.table(f"{self.database}.{name}")
        return rows if rows.inputFiles() else None

    def declare(self, contract: Contract, name: str, location: str, held: dict[str, str], description: str) -> None:
        """An external table of the contract's columns over a folder; its files are read by column name."""
        pairs = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in held.items())
        self.spark.sql(
            f"CREATE TABLE `{self.database}`.`{name}` ({_column_list(contract)}) USING parquet LOCATION {_quoted(location)} "
            f"COMMENT {_quoted(description)} TBLPROPERTIES ({pairs})"
        )

    def rename(self, name: str, to: str) -> None:
        self.spark.sql(f"ALTER TABLE `{self.database}`.`{name}` RENAME TO `{self.database}`.`{to}`")

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS `{self.database}`.`{name}`")


class Calls(Statements):
    """The same by calls of the session catalog: no statement is parsed, planned and reported for each table.

    The first table is declared by a statement; those after it are copies of its entry. Names that a statement might
    refuse, or take for others, are left to it.
    """

    def __init__(self, spark: SparkSession, database: str) -> None:
        super().__init__(spark, database)
        jvm = spark._jvm
        self.catalog, self.schemas = spark._jsparkSession.sessionState().catalog(), jvm.org.apache.spark.sql.types.StructType
        self.options, self.identifier = jvm.scala.Option, jvm.org.apache.spark.sql.catalyst.TableIdentifier
        self.uris, self.maps, self.to_java = jvm.org.apache.spark.sql.catalyst.catalog.CatalogUtils, jvm.PythonUtils, jvm.scala.jdk.javaapi.CollectionConverters
        self.paths, self.conf, self.in_database = jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration(), self.options.apply(database)
        # The entry of the first table, and what it is made of.
        self.first = self.parts = None

    def _id(self, name: str):
        return self.identifier(name, self.in_database)

    def _held(self, name: str):
        return self.catalog.getTableMetadata(self._id(name))

    def names(self) -> list[str]:
        return self.catalog.externalCatalog().listTables(self.database).mkString("\n").split()

    def lines(self, table: str) -> list[tuple]:
        entry = self._held(table)
        held = self.to_java.asJava(entry.properties())
        contract_id, version = held.get("contract_id"), held.get(VERSION_PROPERTY)
        fields = StructType.fromJson(json.loads(entry.schema().json())).fields
        # The type as it was declared, where Spark keeps another.
        kinds = [f.metadata.get("__CHAR_VARCHAR_TYPE_STRING") or f.dataType.simpleString() for f in fields]
        return [(table, f.name, kind, contract_id, version) for f, kind in zip(fields, kinds)]

    def make_database(self, place: str) -> None:
        if not self.catalog.databaseExists(self.database):
            super().make_database(place)

    def exists(self, name: str) -> bool:
        return self.catalog.tableExists(self._id(name)) if _is_plain(name) else super().exists(name)

    def properties(self, name: str) -> dict[str, str]:
        return self._properties(self._held(name)) if _is_plain(name) else super().properties(name)

    def _properties(self, entry) -> dict[str, str]:
        held = self.to_java.asJava(entry.properties())
        # The end of an iteration comes from Java as an exception, which takes longer than all else.
        found = held.keySet().toArray()
        return {key: held.get(key) for key in (found[n] for n in range(len(found)))}

    def described(self, name: str) -> tuple[dict[str, str], str, str]:
        if not _is_plain(name):
            return super().described(name)
        entry = self._held(name)
        comment = entry.comment()
        return self._properties(entry), self.uris.URIToString(entry.location()), comment.get() if comment.isDefined() else ""

    def rows(self, name: str, location: str) -> DataFrame | None:
        place = self.paths(location)
        return super().rows(name, location) if place.getFileSystem(self.conf).exists(place) else None

    def declare(self, contract: Contract, name: str, location: str, held: dict[str, str], description: str) -> None:
        columns = [c.name.lower() for c in contract.columns]
        if self.first is None or not columns or len(set(columns)) < len(columns) or not all(map(_is_plain, [name, *columns])):
            super().declare(contract, name, location, held, description)
            if self.first is None and _is_plain(name):
                self.first = self._held(name)
            return
        if self.parts is None:
            self.parts = _parts(self.first), _parts(self.first.storage())
        entry, storage = self.parts
        place = self.options.apply(self.uris.stringToURI(location))
        new = _copied(
            *entry,
            identifier=self._id(name),
            storage=_copied(*storage, locationUri=place),
            schema=self.schemas.fromDDL(_column_list(contract)),
            properties=self.maps.toScalaMap(held),
            comment=self.options.apply(description),
            createTime=int(time.time() * 1000),
        )
        self.catalog.createTable(new, False, False)

    def rename(self, name: str, to: str) -> None:
        if not (_is_plain(name) and _is_plain(to)):
            return super().rename(name, to)
        self.catalog.refreshTable(self._id(name))
        self.catalog.renameTable(self._id(name), self._id(to))

    def drop(self, name: str) -> None:
        if not _is_plain(name):
            return super().drop(name)
        if self.exists(name):
            self.catalog.refreshTable(self._id(name))
            self.catalog.dropTable(self._id(name), True, False)


def _is_plain(name: str) -> bool:
    return re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name) is not None


def _parts(case_class) -> tuple:
    """A Scala value, with the names and values it is made of."""
    places = range(case_class.productArity())
    return case_class, [case_class.productElementName(n) for n in places], [case_class.productElement(n) for n in places]


def _copied(case_class, names: list[str], values: list, **changes):
    return case_class.copy(*[changes.get(name, value) for name, value in zip(names, values)])


def catalog_of(spark: SparkSession, database: str) -> Statements:
    """``Calls`` if the tables are Spark's own and nothing is cached that statements would have to drop."""
    own = spark.conf.get("spark.sql.catalog.spark_catalog", "builtin") == "builtin" and spark.catalog.currentCatalog() == "spark_catalog"
    calls = own and _is_plain(database) and spark._jsparkSession.sharedState().cacheManager().isEmpty()
    return (Calls if calls else Statements)(spark, database)


# One line per table and load: what the table was made or changed to.
CATALOG_SCHEMA = "table_name string, contract_id string, version string, columns array<struct<name:string,type:string>>"


def catalog_lines(docs: DataFrame) -> DataFrame:
    """The catalog's lines for tables that were just brought to the contracts of ``docs``."""
    contract = F.col("contract")
    columns = F.transform(contract["columns"], lambda c: F.struct(c["name"].alias("name"), map_types(c["data_type"], "table").alias("type")))
    return docs.select(
        table_name(contract["contract_id"]).alias("table_name"), contract["contract_id"].alias("contract_id"),
        contract["version"].alias("version"), columns.alias("columns"),
    )


def write_catalog(lines: DataFrame, path: str, load_id: str) -> None:
    """Lines of one load, replacing those of the same load."""
    lines.write.mode("overwrite").parquet(f"{path.rstrip('/')}/load_id={load_id}")


def read_catalog(spark: SparkSession, path: str, before_load: str | None = None) -> DataFrame:
    """The columns of all tables as ``plan_tables`` wants them, read as a table: no call to the catalog, none per table.

    A table is what its latest load made it; with ``before_load``, the latest of those that sort before it.
    """
    try:
        lines = spark.read.schema(f"{CATALOG_SCHEMA}, load_id string").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], EXISTING_SCHEMA)
    if before_load is not None:
        lines = lines.where(F.col("load_id") < before_load)
    newest = lines.groupBy("table_name").agg(F.max_by(F.struct("contract_id", "version", "columns"), "load_id").alias("t"))
    each = newest.select("table_name", "t.contract_id", "t.version", F.inline("t.columns"))
    return each.select("table_name", "name", "type", "contract_id", "version")


def import_catalog(spark: SparkSession, database: str, path: str, load_id: str) -> None:
    """Lines for tables that were made without them: the catalog is asked once, for each table."""
    columns = F.collect_list(F.struct("name", "type")).alias("columns")
    write_catalog(existing_columns(spark, database).groupBy("table_name", "contract_id", "version").agg(columns), path, load_id)


def _column_list(contract: Contract) -> str:
    return ", ".join(f"`{c.name}` {TYPE_MAPS['table'][c.data_type]} COMMENT {_quoted(c.description)}" for c in contract.columns)


def _create(spark: SparkSession, contract: Contract, root: str, database: str, rows: DataFrame | None, catalog: Statements | None = None) -> str:
    """Declare the contract's table over a new folder, into which ``rows`` are written if there are any to write."""
    catalog, name = catalog or catalog_of(spark, database), contract_table(contract)
    catalog.make_database(f"{root.rstrip('/')}/{database}")
    if not catalog.exists(name):
        location = f"{root.rstrip('/')}/{database}/{name}/{_stamp(contract)}"
        description = contract.description or f"{DESCRIPTION}{contract.contract_id}"
        if rows is not None:
            conform(rows, contract).write.mode("overwrite").parquet(location)
        catalog.declare(contract, name, location, properties(contract), description)
    return f"`{database}`.`{name}`"


def write_contract_table(df: DataFrame, contract: Contract, root: str, database: str = DATABASE) -> str:
    """Create the contract's table below the folder ``root`` from rows conformed to it; returns its name.

    An existing table is left as it is.
    """
    return _create(df.sparkSession, contract, root, database, df)


def create_contract_table(spark: SparkSession, contract: Contract, root: str, database: str = DATABASE, catalog: Statements | None = None) -> str:
    """Create the contract's table without rows: the catalog says it all, no job runs and no file is written.

    Who makes many hands over the ``catalog_of`` the database.
    """
    return _create(spark, contract, root, database, None, catalog)


class TableNotFound(LookupError):
    """A table that should be evolved is not in the catalog."""


def _same_files(stored: dict[str, str], dropped: set[str], contract: Contract) -> bool:
    """Whether a table's files hold the contract's rows as they are.

    Columns are found by name: one that is new reads as NULL, one that is gone is not read. Not so if a type changes, or
    if a name comes back that was dropped since the files were written: its old values would be read.
    """
    wanted = {c.name.lower(): TYPE_MAPS["table"][c.data_type].lower() for c in contract.columns}
    kept = all(stored[name] == kind for name, kind in wanted.items() if name in stored)
    return kept and not any(name in dropped for name in wanted if name not in stored)


def evolve_table(spark: SparkSession, contract: Contract, root: str, database: str = DATABASE, catalog: Statements | None = None) -> str:
    """Carry the contract's table to this version: columns replaced, version bumped, rows rewritten only if a type changes.

    Added and dropped columns change the catalog alone: the new table is declared over the same files. The names dropped
    since the files were written are kept as a property, and one that comes back has the rows rewritten without it.
    A table that has no files yet changes by catalog alone whatever its columns become.
    The other properties stay. A new table is made beside the old one and put in place by renaming, so at any time one of
    the two is whole; old files stay where they were. Run again after a failure, it finishes the job.
    """
    catalog, name = catalog or catalog_of(spark, database), contract_table(contract)
    staged, retired = f"{name}__next", f"{name}__previous"
    if not catalog.exists(name) and catalog.exists(retired):
        catalog.rename(retired, name)
    if not catalog.exists(name):
        raise TableNotFound(f"{database}.{name}")
    # Left over from a run that failed before the swap or after it.
    catalog.drop(staged)
    catalog.drop(retired)
    held, location, description = catalog.described(name)
    held = {k: v for k, v in held.items() if not k.startswith(("transient", "option."))}
    held[VERSION_PROPERTY] = contract.version
    dropped = set(json.loads(held.pop(DROPPED_PROPERTY, "[]")))
    if (rows := catalog.rows(name, location)) is not None:
        stored = {f.name.lower(): f.dataType.simpleString() for f in rows.schema.fields}
        if _same_files(stored, dropped, contract):
            dropped |= set(stored) - {c.name.lower() for c in contract.columns}
            if dropped:
                held[DROPPED_PROPERTY] = json.dumps(sorted(dropped))
        else:
            location = f"{root.rstrip('/')}/{database}/{name}/{_stamp(contract)}"
            evolve_rows(rows, contract).write.mode("overwrite").parquet(location)
    catalog.declare(contract, staged, location, held, description)
    catalog.rename(name, retired)
    catalog.rename(staged, name)
    catalog.drop(retired)
    return f"`{database}`.`{name}`"


def _stamp(contract: Contract) -> str:
    """A new folder for each write, so that no write lands on files still being read."""
    return f"version={contract.version}-{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}"
