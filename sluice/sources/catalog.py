"""G1, B2: the tables of a warehouse by name, in the session catalog.

`<schema>.<table>` is a view over an external Parquet table whose partitions are the
directories of one version. A version is registered whole before the view is replaced,
so a reader sees one version or the next, never a part of a commit. The catalog holds
names and locations only: the ledger stays the truth, and `register_warehouse` gives the
names again to a session whose catalog has forgotten them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from sluice.session import list_names
from sluice.sources.snapshots import SnapshotTable

ROOT, VERSION = "sluice.root", "sluice.version"
DIRECTORY = "_directory"
PARTITIONS_PER_STATEMENT = 500


class NameTaken(RuntimeError):
    """The catalog has another table of that name."""


def _name(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _listed(spark: SparkSession, schema: str, start: str) -> list[str]:
    """Tables and views of the namespace whose names start so, whatever their case."""
    rows = spark.sql(f"SHOW TABLES IN {_name(schema)} LIKE {_text(start + '*')}").collect()
    return [r["tableName"] for r in rows if not r["isTemporary"] and r["tableName"].lower().startswith(start.lower())]


def _properties(spark: SparkSession, schema: str, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_name(schema, name)}").collect()}


def claim(spark: SparkSession, schema: str, table: str, root: str) -> dict[str, str]:
    """Create the namespace if it is absent and make sure that the name is free or this
    table's own, whatever its case. Returns the properties it is registered with."""
    location = root.rstrip("/").rpartition("/")[0]
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {_name(schema)} LOCATION {_text(location)}")
    for found in _listed(spark, schema, table):
        if found.lower() == table.lower():
            known = _properties(spark, schema, found)
            if known.get(ROOT) != root:
                raise NameTaken(f"{schema}.{found} is a table of {known.get(ROOT, 'another owner')}, not of {root}")
            return known
    return {}


def register(spark: SparkSession, schema: str, table: str, store: SnapshotTable) -> bool:
    """Point `<schema>.<table>` at the store's current version; False if it is there already
    or the table has no version yet. The version before stays for readers that planned on it."""
    known, head = claim(spark, schema, table, store.root), store.head()
    if head is None or known.get(VERSION) == str(head["version"]):
        return False
    files = f"_{table}_files_v{head['version']}"
    columns = [(_name(f.name), f.dataType.simpleString()) for f in store.schema().fields]
    marks = f"TBLPROPERTIES ({_text(ROOT)} = {_text(store.root)}, {_text(VERSION)} = '{head['version']}')"
    spark.sql(f"DROP TABLE IF EXISTS {_name(schema, files)}")  # left by an attempt that died; its files stay
    spark.sql(f"CREATE TABLE {_name(schema, files)} ({', '.join(f'{n} {t}' for n, t in columns)}, {DIRECTORY} STRING) "
              f"USING parquet PARTITIONED BY ({DIRECTORY}) LOCATION {_text(store.root + '/data')} {marks}")
    places = [f"PARTITION ({DIRECTORY} = '{i}') LOCATION {_text(d)}" for i, d in enumerate(store.directories())]
    for at in range(0, len(places), PARTITIONS_PER_STATEMENT):
        spark.sql(f"ALTER TABLE {_name(schema, files)} ADD {' '.join(places[at:at + PARTITIONS_PER_STATEMENT])}")
    spark.sql(f"CREATE OR REPLACE VIEW {_name(schema, table)} {marks} AS "
              f"SELECT {', '.join(n for n, _ in columns)} FROM {_name(schema, files)}")
    for old in _listed(spark, schema, f"_{table}_files_v"):
        if old.lower() != files.lower() and not old.endswith(f"_v{known.get(VERSION)}"):
            if _properties(spark, schema, old).get(ROOT) == store.root:
                spark.sql(f"DROP TABLE IF EXISTS {_name(schema, old)}")
    return True


def register_warehouse(spark: SparkSession, warehouse: str) -> list[str]:
    """Register every table of a warehouse; the names that now have its current version."""
    warehouse, names = warehouse.rstrip("/"), []
    for schema in sorted(n for n in list_names(spark, warehouse) if not n.startswith("_")):
        for table in sorted(n for n in list_names(spark, f"{warehouse}/{schema}") if not n.startswith("_")):
            store = SnapshotTable(spark, f"{warehouse}/{schema}/{table}")
            if store.head() is not None:
                register(spark, schema, table, store)
                names.append(f"{schema}.{table}")
    return names
