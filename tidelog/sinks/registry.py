"""Destinations by URL scheme, and what can be said of a URL without connecting."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import parse_qs, unquote, urlsplit


@dataclass(frozen=True)
class Target:
    scheme: str
    kind: str
    options: dict[str, str] = field(default_factory=dict)
    max_batch: int | None = None
    time_series: bool = False


_KINDS: dict[str, tuple[str, int | None, bool]] = {
    "postgres": ("jdbc", None, True),
    "mysql": ("jdbc", None, True),
    "sqlserver": ("jdbc", None, True),
    "snowflake": ("jdbc", 200, False),
    "s3": ("files", None, False),
    "azureblob": ("files", None, False),
    "file": ("files", None, False),
    "kafka": ("broker", 1000, False),
    "eventhub": ("broker", 500, False),
}
_ALIASES = {"postgresql": "postgres"}
_PORTS = {"postgres": 5432, "mysql": 3306, "sqlserver": 1433, "kafka": 9092}
_sinks: dict[str, Callable] = {}


def register(scheme: str, write: Callable, *aliases: str) -> None:
    """A sink of one's own: write(df, target)."""
    _sinks[scheme.lower()] = write
    _ALIASES.update({a.lower(): scheme.lower() for a in aliases})


def schemes() -> list[str]:
    return sorted({*_KINDS, *_sinks})


def resolve(scheme: str) -> str:
    name = scheme.lower()
    name = _ALIASES.get(name, name)
    if name not in _KINDS and name not in _sinks:
        raise ValueError(f"no destination has the scheme {scheme!r}")
    return name


def parse(url: str) -> Target:
    """A destination URL; ValueError says what it lacks."""
    u = urlsplit(url)
    if not u.scheme:
        raise ValueError(f"{url!r} has no scheme")
    scheme = resolve(u.scheme)
    kind, most, log = _KINDS.get(scheme, ("custom", None, False))
    query = {k: v[-1] for k, v in parse_qs(u.query).items()}
    path = unquote(u.path.strip("/"))
    if kind == "jdbc":
        if not u.hostname or not path:
            raise ValueError(f"a {scheme} URL needs a host and a database")
        host = f"{u.hostname}:{u.port or _PORTS[scheme]}" if scheme in _PORTS else u.hostname
        jdbc = {"postgres": f"jdbc:postgresql://{host}/{path}", "mysql": f"jdbc:mysql://{host}/{path}", "sqlserver": f"jdbc:sqlserver://{host};databaseName={path}", "snowflake": f"jdbc:snowflake://{host}/?db={path}"}[scheme]
        options = {"url": jdbc} | {k: unquote(v) for k, v in (("user", u.username), ("password", u.password)) if v} | query
    elif kind == "broker":
        if not u.netloc or not path and scheme == "kafka":
            raise ValueError(f"a {scheme} URL needs a host and a topic")
        options = {"servers": u.netloc.rpartition("@")[2], "topic": path} | query
    elif kind == "files":
        where = path if scheme == "file" else f"{u.hostname or ''}/{path}".strip("/")
        if not where:
            raise ValueError(f"a {scheme} URL needs a folder or bucket")
        if scheme == "azureblob":  # account/container/folder
            container, _, folder = path.partition("/")
            if not u.hostname or not container:
                raise ValueError("an azureblob URL needs an account and a container")
            where = f"{container}@{u.hostname}.dfs.core.windows.net/{folder}"
        options = {"path": {"file": "file:///", "s3": "s3a://", "azureblob": "abfss://"}[scheme] + where} | query
    else:
        options = {"url": url} | query
    return Target(scheme, kind, options, most, log)


def write(df, url: str, schema=None) -> None:
    """Write events to a destination, by a sink of one's own if one is registered for the scheme.

    Folders and object stores get JSON lines in a folder per table, through Spark's file systems. Brokers get the rows of
    ``brokers``. Databases get one table: the batch is folded with ``schema`` and merged (``databases.upsert``). Brokers and
    databases need their connector in Spark's class path.
    """
    from tidelog.sinks import brokers, databases, files

    target = parse(url)
    if target.scheme in _sinks:
        _sinks[target.scheme](df, target)
    elif target.kind == "files":
        files.write_json(df, target.options["path"])
    elif target.scheme == "kafka":
        brokers.write_kafka(df, target.options["servers"], target.options["topic"])
    elif target.kind == "jdbc" and schema is not None:
        databases.upsert(df, schema, target)
    else:
        raise ValueError(f"{target.scheme} needs " + ("the schema of the table" if target.kind == "jdbc" else "a registered sink"))


#: What the messages of errors that pass by themselves contain.
TRANSIENT = ("timeout", "timed out", "connection refused", "connection reset", "broken pipe", "temporarily unavailable", "too many connections", "deadlock", "throttl", "service unavailable")


def is_transient(error: BaseException) -> bool:
    """Whether trying again may help: a lost connection, a timeout, a busy server, or an error caused by one."""
    seen: set[int] = set()
    while error is not None and id(error) not in seen:
        seen.add(id(error))
        if isinstance(error, (ConnectionError, TimeoutError)) or any(x in str(error).lower() for x in TRANSIENT):
            return True
        error = error.__cause__ or error.__context__
    return False


def retried(work: Callable, kind: str = "http", sleep: Callable[[float], None] = time.sleep):
    """What work() returns; after a transient error it is tried again, as often as there are delays."""
    for seconds in [*delays(kind), None]:
        try:
            return work()
        except Exception as e:
            if seconds is None or not is_transient(e):
                raise
            sleep(seconds)


def delays(kind: str = "http") -> list[int]:
    """Seconds between attempts."""
    return {"http": [2, 4, 8, 16, 30], "import": [30, 60, 120, 240, 480], "flush": [2, 4, 8, 16], "start": [5, 15, 30, 60, 120]}[kind]
