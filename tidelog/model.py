"""Events, table schemas and their Spark types."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

#: A row change as it travels: before and after are JSON text.
EVENT = T.StructType(
    [
        T.StructField("operation", T.StringType(), False),
        T.StructField("id", T.StringType(), False),
        T.StructField("table", T.StringType(), False),
        T.StructField("key", T.ArrayType(T.StringType())),
        T.StructField("modelVersion", T.StringType()),
        T.StructField("companyId", T.StringType()),
        T.StructField("locationId", T.StringType()),
        T.StructField("userId", T.StringType()),
        T.StructField("before", T.StringType()),
        T.StructField("after", T.StringType()),
        T.StructField("diff", T.ArrayType(T.StringType())),
        T.StructField("timestamp", T.LongType()),
        T.StructField("mvccTimestamp", T.StringType()),
        T.StructField("imported", T.BooleanType()),
    ]
)

#: The append-only log of a table, without its sequence number.
LOG_COLUMNS = ["_event_id", "_operation", "_entity_id", "_timestamp", "_mvcc_ts", "_company_id", "_location_id", "_model_ver", "_diff", "_before", "_after"]
EVENTS_TABLE = T.StructType([T.StructField("_seq", T.LongType())] + [T.StructField(c, T.LongType() if c == "_timestamp" else T.StringType(), c != "_operation") for c in LOG_COLUMNS])
#: What the history view shows of the log.
HISTORY_COLUMNS = ["_seq", "_event_id", "_operation", "_entity_id", "_timestamp", "_mvcc_ts", "_company_id", "_location_id", "_model_ver"]

_TYPES = {"integer": T.LongType(), "number": T.DoubleType(), "boolean": T.BooleanType()}


@dataclass(frozen=True)
class Property:
    """A column as JSON Schema describes it."""

    type: str = "string"
    format: str | None = None
    nullable: bool = False
    enum: bool = False

    @property
    def not_null(self) -> bool:
        return not self.nullable or self.type == "array"

    @property
    def spark_type(self) -> T.DataType:
        """Objects and arrays stay JSON text; unknown types are strings."""
        if self.type == "string" and self.format == "date-time":
            return T.TimestampType()
        return _TYPES.get(self.type, T.StringType())

    @classmethod
    def of(cls, spec: dict) -> Property:
        return cls(spec.get("type", "string"), spec.get("format"), bool(spec.get("nullable", False)), bool((spec.get("items") or {}).get("enum")))


@dataclass(frozen=True)
class Schema:
    """A table's columns in one version of its model."""

    table: str
    version: str = "1"
    properties: dict[str, Property] = field(default_factory=dict)
    primary_keys: tuple[str, ...] = ()
    required: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        """Primary keys as declared, then the others by name, upper and lower case together."""
        keys = [k for k in self.primary_keys if k in self.properties]
        return keys + sorted((c for c in self.properties if c not in keys), key=lambda c: (c.lower(), c))

    @property
    def keys(self) -> tuple[str, ...]:
        """The columns that identify a row."""
        return self.primary_keys or ("id",)

    @property
    def entity_column(self) -> str:
        return self.primary_keys[0] if self.primary_keys else "id"

    def is_required(self, column: str) -> bool:
        return column in self.required and self.properties[column].not_null

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c, self.properties[c].spark_type, not self.is_required(c)) for c in self.columns])

    @classmethod
    def of(cls, spec: dict) -> Schema:
        """From JSON with table, modelVersion, properties, primaryKeys and required."""
        return cls(spec["table"], str(spec.get("modelVersion", "1")), {k: Property.of(v) for k, v in (spec.get("properties") or {}).items()}, tuple(spec.get("primaryKeys") or ()), tuple(spec.get("required") or ()))


class Catalog(dict):
    """Schemas by table name, whatever its case. Of several versions of a table the last given is the one in force."""

    def __init__(self, schemas: list[Schema] = ()):
        super().__init__({s.table.lower(): s for s in schemas})
        self._versions = {(s.table.lower(), s.version): s for s in schemas}

    def find(self, table: str, version: str | None) -> Schema | None:
        """The schema of a table in one version of its model; None if it isn't known."""
        return self._versions.get((table.lower(), version))

    def others(self, table: str, version: str | None = None) -> list[Schema]:
        """The schemas of a table in other versions than the given one, or than the one in force."""
        version = self[table].version if version is None else version
        return [s for (name, v), s in self._versions.items() if name == table.lower() and v != version]

    def ranks(self) -> dict[tuple[str, str], int]:
        """How late each version of a table (lower case) is: numbers by their size, if all are numbers, else as they were given."""
        out = {}
        for table in self:
            versions = [v for t, v in self._versions if t == table]
            order = sorted(versions, key=int) if all(v.isdigit() for v in versions) else versions
            out |= {(table, v): k for k, v in enumerate(order)}
        return out

    def __getitem__(self, table: str) -> Schema:
        return super().__getitem__(table.lower())

    def __contains__(self, table: object) -> bool:
        return isinstance(table, str) and super().__contains__(table.lower())

    def get(self, table: str, default=None):
        return super().get(table.lower(), default)
