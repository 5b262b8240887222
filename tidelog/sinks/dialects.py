"""SQL text for databases: tables, new and dropped columns, and one set-based merge from a staging table.

The engine folds a batch into at most one row per key before it reaches a database, so a merge needs no order.
"""

from __future__ import annotations

from dataclasses import dataclass

from tidelog.model import Property, Schema


@dataclass(frozen=True)
class Dialect:
    name: str
    quotes: tuple[str, str]
    types: dict[str, str]
    key_string: str
    text: str
    backslash: bool = False
    national: bool = False

    def identifier(self, name: str) -> str:
        a, b = self.quotes
        return a + name.replace(b, b * 2) + b

    def string(self, value: str) -> str:
        value = value.replace("\\", "\\\\") if self.backslash else value
        return ("N" if self.national else "") + "'" + value.replace("'", "''") + "'"

    def column_type(self, p: Property, key: bool) -> str:
        if p.type == "string" and p.format == "date-time":
            return self.types["date-time"]
        if p.type == "string" and key:
            return self.key_string
        if p.type == "array" and p.enum:
            return self.types["enum"]
        return self.types.get(p.type, self.text)


DIALECTS = {
    "postgres": Dialect("postgres", ('"', '"'), {"date-time": "TIMESTAMPTZ", "integer": "BIGINT", "number": "DOUBLE PRECISION", "boolean": "BOOLEAN", "object": "JSONB", "array": "JSONB", "enum": "VARCHAR(64)"}, "TEXT", "TEXT"),
    "mysql": Dialect("mysql", ("`", "`"), {"date-time": "TIMESTAMP", "integer": "BIGINT", "number": "FLOAT", "boolean": "BOOLEAN", "object": "JSON", "array": "JSON", "enum": "VARCHAR(64)"}, "VARCHAR(64)", "TEXT", backslash=True),
    "sqlserver": Dialect("sqlserver", ("[", "]"), {"date-time": "NVARCHAR(MAX)", "integer": "BIGINT", "number": "FLOAT", "boolean": "BIT", "object": "NVARCHAR(MAX)", "array": "NVARCHAR(MAX)", "enum": "VARCHAR(64)"}, "VARCHAR(64)", "NVARCHAR(MAX)", national=True),
    "snowflake": Dialect("snowflake", ('"', '"'), {"date-time": "TIMESTAMP_NTZ", "integer": "INTEGER", "number": "FLOAT", "boolean": "BOOLEAN", "object": "STRING", "array": "VARIANT", "enum": "STRING"}, "STRING", "STRING"),
}


def create_table(schema: Schema, dialect: str) -> str:
    d = DIALECTS[dialect]
    keys = list(schema.primary_keys) or ([] if d.name == "snowflake" else ["id"])
    lines = [f"{d.identifier(n)} {d.column_type(schema.properties[n], n in keys)}" + " NOT NULL" * schema.is_required(n) for n in schema.columns]
    if keys:
        lines.append(f"PRIMARY KEY ({', '.join(map(d.identifier, keys))})")
    return f"CREATE TABLE {d.identifier(schema.table)} ({', '.join(lines)})"


def recreate_table(schema: Schema, dialect: str) -> list[str]:
    """Statements that drop a table, if it is there, and make it anew."""
    return [f"DROP TABLE IF EXISTS {DIALECTS[dialect].identifier(schema.table)}", create_table(schema, dialect)]


def add_columns(schema: Schema, names: list[str], dialect: str) -> list[str]:
    d = DIALECTS[dialect]
    word = "ADD" if d.name == "sqlserver" else "ADD COLUMN"
    return [f"ALTER TABLE {d.identifier(schema.table)} {word} {d.identifier(n)} {d.column_type(schema.properties[n], False)}" for n in names]


def drop_columns(table: str, names: list[str], dialect: str) -> list[str]:
    d = DIALECTS[dialect]
    return [f"ALTER TABLE {d.identifier(table)} DROP COLUMN {d.identifier(n)}" for n in names]


def change_columns(schema: Schema, names: list[str], dialect: str) -> list[str]:
    d = DIALECTS[dialect]
    word = {"postgres": "ALTER COLUMN {} TYPE {}", "mysql": "MODIFY COLUMN {} {}", "sqlserver": "ALTER COLUMN {} {}", "snowflake": "ALTER COLUMN {} SET DATA TYPE {}"}[d.name]
    return [f"ALTER TABLE {d.identifier(schema.table)} " + word.format(d.identifier(n), d.column_type(schema.properties[n], False)) for n in names]


def merge(schema: Schema, staging: str, dialect: str, key: str | None = None) -> list[str]:
    """Statements that bring a staging table (one folded row per key, ``_deleted`` true for deletes) into a table. Rows match if
    all columns of the key are equal."""
    d = DIALECTS[dialect]
    keys = [key] if key else list(schema.keys)
    q, to, of = d.identifier, d.identifier(schema.table), d.identifier(staging)
    names = [n for n in schema.columns if n not in keys]
    rows = ", ".join(q(n) for n in [*keys, *names])
    dead = f"{q('_deleted')} = {'1' if d.name == 'sqlserver' else 'TRUE'}"
    if len(keys) == 1:
        gone = f"DELETE FROM {to} WHERE {q(keys[0])} IN (SELECT {q(keys[0])} FROM {of} WHERE {dead})"
    else:
        gone = f"DELETE FROM {to} WHERE EXISTS (SELECT 1 FROM {of} WHERE {' AND '.join(f'{of}.{q(k)} = {to}.{q(k)}' for k in keys)} AND {dead})"
    live = f"SELECT {rows} FROM {of} WHERE {q('_deleted')} = {'0' if d.name == 'sqlserver' else 'FALSE'}"
    if d.name == "postgres":
        sets = ", ".join(f"{q(n)} = EXCLUDED.{q(n)}" for n in names)
        return [gone, f"INSERT INTO {to} ({rows}) {live} ON CONFLICT ({', '.join(map(q, keys))}) " + (f"DO UPDATE SET {sets}" if sets else "DO NOTHING")]
    if d.name == "mysql":
        sets = ", ".join(f"{q(n)} = VALUES({q(n)})" for n in names) or f"{q(keys[0])} = {q(keys[0])}"
        return [gone, f"INSERT INTO {to} ({rows}) {live} ON DUPLICATE KEY UPDATE {sets}"]
    sets = ", ".join(f"{q(n)} = s.{q(n)}" for n in names)
    matched = f" WHEN MATCHED THEN UPDATE SET {sets}" if sets else ""
    values = ", ".join(f"s.{q(n)}" for n in [*keys, *names])
    same = " AND ".join(f"t.{q(k)} = s.{q(k)}" for k in keys)
    return [gone, f"MERGE INTO {to} AS t USING ({live}) AS s ON {same}{matched} WHEN NOT MATCHED THEN INSERT ({rows}) VALUES ({values});"]
