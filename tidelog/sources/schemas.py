"""Table schemas from files and from what Spark's catalog knows."""

from __future__ import annotations

import json
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tidelog.model import Catalog, Property, Schema

DAY = 24 * 3600


def load_directory(path: str) -> Catalog:
    """Schemas of ``table.json`` files; files that cannot be read are left out."""
    found = []
    for p in sorted(Path(path).glob("*.json")):
        try:
            spec = json.loads(p.read_text())
            found.append(Schema.of({"table": p.stem} | spec))
        except (ValueError, KeyError, AttributeError, OSError):
            continue
    return Catalog(found)


def load_cached(path: str, fetch, max_age: float = DAY, now=time.time) -> Catalog:
    """Schemas from a cache file younger than max_age, else from fetch() (a list of dicts), which renews the cache. If
    fetching fails, an old cache is better than none."""
    p = Path(path)
    cached = json.loads(p.read_text()) if p.exists() else None
    if cached is not None and now() - cached["at"] < max_age:
        return Catalog([Schema.of(s) for s in cached["schemas"]])
    try:
        specs = fetch()
    except OSError:
        if cached is None:
            raise
        return Catalog([Schema.of(s) for s in cached["schemas"]])
    p.write_text(json.dumps({"at": now(), "schemas": specs}))
    return Catalog([Schema.of(s) for s in specs])


_NAMES = {"bigint": "integer", "int": "integer", "double": "number", "float": "number", "boolean": "boolean", "timestamp": "string"}


def reflect(df: DataFrame, table: str) -> Schema:
    """The schema that a stored table has."""
    properties = {f.name: Property(_NAMES.get(f.dataType.simpleString(), "string"), "date-time" if f.dataType.simpleString() == "timestamp" else None, f.nullable) for f in df.schema.fields}
    return Schema(table, "0", properties)


def tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return [t.name for t in spark.catalog.listTables(database)]


#: Names of column types in databases, as JSON Schema has them; others are strings.
_DATABASE = {"bigint": "integer", "integer": "integer", "int": "integer", "smallint": "integer", "number": "number", "double": "number", "double precision": "number", "float": "number", "real": "number", "boolean": "boolean", "bit": "boolean", "bool": "boolean"}


def columns_sql(schema: str | None = None) -> str:
    """A query for what ``of_columns`` takes, for databases with an information_schema; of the current schema, or a named one."""
    where = "table_schema = " + ("current_schema" if schema is None else "'" + schema.replace("'", "''") + "'")
    return f"SELECT table_name, column_name, data_type, is_nullable FROM information_schema.columns WHERE {where}"


def of_columns(columns: DataFrame) -> Catalog:
    """Schemas of a database's tables, from rows of table, column, type and whether it may be null (YES or NO), as by ``columns_sql``
    through Spark's JDBC source. A row per column comes to the driver."""
    found: dict[str, dict[str, Property]] = {}
    for table, column, kind, nullable in columns.collect():
        kind = kind.lower()
        time = kind.startswith("timestamp") or kind == "datetime"
        found.setdefault(table, {})[column] = Property(_DATABASE.get(kind.partition("(")[0].strip(), "string"), "date-time" if time else None, nullable.upper() == "YES")
    return Catalog([Schema(t, "0", columns) for t, columns in sorted(found.items())])
