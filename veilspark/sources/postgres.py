"""PostgreSQL as source and sink over Spark's JDBC reader and writer.

Every column is read as text with line breaks as spaces. Spark commits a JDBC write
partition by partition, so rows go to a staging table first and one transaction
swaps it in. Secrets never show in logs, errors or ``repr``.
"""
from __future__ import annotations

import os
import re
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from urllib.parse import parse_qsl, quote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.operators.sheets import ROW
from veilspark.plans.errors import RunError

SSL = ("disable", "prefer", "require", "verify-ca", "verify-full")
MODES = ("append", "create", "truncate", "replace")
HIDDEN = "<redacted>"


def bad(message: str, details: str = "") -> RunError:
    return RunError("DB_CONFIG_INVALID", message, details)


def expand(raw: str, name: str, used: list[str] | None = None) -> str:
    """``${VAR}`` and ``${VAR:-default}`` from the environment; what was put in is noted in ``used``."""
    out, rest = "", raw
    while "${" in rest:
        before, _, after = rest.partition("${")
        reference, closed, rest = after.partition("}")
        if not closed:
            raise bad("a variable reference is not closed", name)
        variable, has_default, default = reference.partition(":-")
        variable = variable.strip()
        if not variable:
            raise bad("a variable reference names no variable", name)
        value = os.environ.get(variable)
        if value is None and not has_default:
            raise RunError("ENV_VAR_MISSING", "an environment variable is not set", f"{variable} in {name}")
        if value is not None and used is not None:
            used.append(value)
        out += before + (default if value is None else value)
    return out + rest


def literal(raw: str, name: str) -> str:
    if "${" in raw:
        raise bad("variables are expanded in connection fields only", name)
    return raw


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def text_literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


@dataclass(frozen=True)
class Table:
    parts: tuple[str, ...]

    @classmethod
    def parse(cls, raw: str, name: str) -> Table:
        parts = tuple(p.strip() for p in raw.split("."))
        if not 1 <= len(parts) <= 2 or any(not p or '"' in p or "\0" in p for p in parts):
            raise bad("a table is named as table or schema.table, without quotes", f"{name} = {raw!r}")
        return cls(parts)

    @property
    def sql(self) -> str:
        return ".".join(map(quoted, self.parts))


@dataclass(frozen=True, repr=False)
class Connection:
    host: str = "localhost"
    port: int = 5432
    database: str = ""
    user: str = ""
    password: str | None = None
    ssl: str = "verify-full"
    root_cert: str | None = None
    timeout: int | None = None
    application: str = "veilspark"
    secrets: tuple[str, ...] = field(default=())

    @property
    def url(self) -> str:
        return f"jdbc:postgresql://{self.host}:{self.port}/{quote(self.database, safe='')}"

    def options(self) -> dict[str, str]:
        """Options of Spark's JDBC source."""
        out = {"url": self.url, "driver": "org.postgresql.Driver", "user": self.user, "sslmode": self.ssl, "ApplicationName": self.application}
        out |= {"password": self.password} if self.password else {}
        out |= {"sslrootcert": self.root_cert} if self.root_cert else {}
        return out | ({"connectTimeout": str(self.timeout)} if self.timeout else {})

    def scrub(self, text: str) -> str:
        for s in sorted({x for x in (*self.secrets, self.password or "") if len(x) >= 4}, key=len, reverse=True):
            text = text.replace(s, HIDDEN)
        return text

    @property
    def warning(self) -> str | None:
        """What an sslmode leaves open."""
        if self.ssl in ("verify-ca", "verify-full"):
            return None
        plain = {"disable": "the connection is not encrypted", "prefer": "the connection may be plain text", "require": "the server's certificate is not checked"}[self.ssl]
        return f"sslmode={self.ssl}: {plain} and the server is not authenticated; use verify-full"

    def __repr__(self) -> str:
        return self.scrub(f"{self.user}@{self.host}:{self.port}/{self.database} sslmode={self.ssl}")


def parse_connection(section: Mapping, name: str) -> Connection:
    c = section.get("connection", section)
    if not isinstance(c, Mapping):
        raise bad("connection must be an object", name)
    used: list[str] = []
    get = lambda k: expand(str(c[k]), f"{name}.{k}", used) if c.get(k) is not None else None
    ssl = literal(str(c.get("sslmode") or c.get("ssl_mode") or "verify-full"), f"{name}.sslmode").lower()
    fields = {"host": get("host"), "port": get("port"), "database": get("database"), "user": get("user"), "password": get("password")}
    if dsn := get("dsn"):
        if "://" in dsn:
            u = urlsplit(dsn)
            from_dsn = {"host": u.hostname, "port": u.port, "database": u.path.lstrip("/") or None, "user": u.username, "password": u.password} | dict(parse_qsl(u.query))
        else:
            from_dsn = dict(re.findall(r"(\w+)\s*=\s*'?([^'\s]*)'?", dsn))
            from_dsn["database"] = from_dsn.get("dbname")
        fields = {k: v if v is not None else from_dsn.get(k) for k, v in fields.items()}
        ssl = from_dsn.get("sslmode", ssl)
    if ssl not in SSL:
        raise bad("unknown sslmode", f"{name}: {ssl}")
    if variable := c.get("password_env"):
        if variable not in os.environ:
            raise RunError("ENV_VAR_MISSING", "the variable of the password is not set", str(variable))
        fields["password"] = os.environ[variable]
    cert = get("sslrootcert") or get("root_cert")
    if cert and ssl == "disable":
        raise bad("sslrootcert is set but sslmode turns encryption off", name)
    if ssl == "verify-ca" and not cert:
        raise bad("sslmode=verify-ca needs sslrootcert", name)
    try:
        port = int(fields["port"] or 5432)
    except ValueError:
        raise bad("the port must be a number", name) from None
    if not fields["database"]:
        raise bad("the database is not named", name)
    return Connection(fields["host"] or "localhost", port, fields["database"], fields["user"] or "", fields["password"], ssl, cert, c.get("connect_timeout_seconds"), str(c.get("application_name", "veilspark")), tuple(used))


@dataclass(frozen=True)
class Read:
    connection: Connection
    query: str
    origin: str


@dataclass(frozen=True)
class Write:
    connection: Connection
    table: Table
    mode: str = "create"
    create_schema: bool = True
    empty_as_null: bool = True


def parse_source(section: Mapping) -> Read | None:
    """The ``input`` of a configuration; None means files."""
    spec = section.get("input")
    if spec is None:
        return None
    if not isinstance(spec, Mapping):
        raise bad("input must be an object")
    kind = spec.get("type", "file")
    if kind in ("file", "files"):
        return None
    if kind not in ("postgres", "postgresql"):
        raise bad("unknown input type", str(kind))
    connection = parse_connection(spec, "input")
    table, query = spec.get("table"), spec.get("query")
    if (table is None) == (query is None):
        raise bad("input takes either a table or a query")
    if query is not None:
        text = literal(str(query), "input.query").strip().rstrip(";").strip()
        if not text:
            raise bad("input.query is empty")
        return Read(connection, text, "custom query")
    columns = spec.get("columns") or []
    if not isinstance(columns, list) or any(not isinstance(x, str) or not x for x in columns):
        raise bad("input.columns must be names")
    limit = spec.get("limit")
    if limit is not None and (not isinstance(limit, int) or isinstance(limit, bool) or limit < 1):
        raise bad("input.limit must be a whole number of at least 1")
    t = Table.parse(literal(str(table), "input.table"), "input.table")
    return Read(connection, f"SELECT {', '.join(map(quoted, columns)) or '*'} FROM {t.sql}" + (f" LIMIT {limit}" if limit else ""), f"table {'.'.join(t.parts)}")


def parse_sink(section: Mapping, fallback: Connection | None = None) -> Write | None:
    """The ``output_sink`` of a configuration; it may use the input's connection."""
    spec = section.get("output_sink")
    if spec is None:
        return None
    if not isinstance(spec, Mapping):
        raise bad("output_sink must be an object")
    kind = spec.get("type", "none")
    if kind in ("none", "file", "files"):
        return None
    if kind not in ("postgres", "postgresql"):
        raise bad("unknown output_sink type", str(kind))
    own = any(k in spec for k in ("connection", "dsn", "host", "database", "user"))
    connection = fallback if fallback and not own else parse_connection(spec, "output_sink")
    if not isinstance(spec.get("table"), str):
        raise bad("output_sink needs a table")
    mode = literal(str(spec.get("mode", "create")), "output_sink.mode").lower()
    if mode not in MODES:
        raise bad("unknown output_sink.mode", mode)
    return Write(connection, Table.parse(literal(spec["table"], "output_sink.table"), "output_sink.table"), mode, bool(spec.get("create_schema", True)), bool(spec.get("empty_as_null", True)))


def read(spark: SparkSession, spec: Read) -> DataFrame:
    """The rows as text columns."""
    try:
        df = spark.read.format("jdbc").options(**spec.connection.options(), query=spec.query).load()
    except Exception as e:
        raise RunError("DB_READ_FAILED", "the database did not answer the query", spec.connection.scrub(str(e))[:300]) from None
    if len(set(df.columns)) < len(df.columns):
        raise bad("the query returns a column name twice")
    return as_text(df)


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.coalesce(F.translate(F.col(f"`{c}`").cast("string"), "\r\n", "  "), F.lit("")).alias(c) for c in df.columns], F.array(F.monotonically_increasing_id()).alias(ROW))


def ddl(spec: Write, columns: list[str]) -> list[str]:
    """Statements that prepare the destination."""
    definition = ", ".join(f"{quoted(c)} text" for c in columns)
    t = spec.table.sql
    out = [f"CREATE SCHEMA IF NOT EXISTS {quoted(spec.table.parts[0])}"] if spec.create_schema and len(spec.table.parts) == 2 else []
    if spec.mode in ("create", "truncate"):
        out.append(f"CREATE TABLE IF NOT EXISTS {t} ({definition})")
    if spec.mode == "truncate":
        out.append(f"TRUNCATE TABLE {t}")
    if spec.mode == "replace":
        out += [f"DROP TABLE IF EXISTS {t}", f"CREATE TABLE {t} ({definition})"]
    return out


def staging(spec: Write) -> Table:
    return Table((*spec.table.parts[:-1], f"{spec.table.parts[-1][:40]}_staging_{uuid.uuid4().hex[:8]}"))


def swap(spec: Write, stage: Table, columns: list[str]) -> list[str]:
    """One transaction: prepare the destination, move the staged rows, drop the staging table."""
    names = ", ".join(map(quoted, columns))
    return ["BEGIN", *ddl(spec, columns), f"INSERT INTO {spec.table.sql} ({names}) SELECT {names} FROM {stage.sql}", f"DROP TABLE {stage.sql}", "COMMIT"]


def write(df: DataFrame, spec: Write, run_sql=None) -> dict:
    """Load the table; ``run_sql`` runs statements on one connection (by default through the JVM driver)."""
    columns = [c for c in df.columns if c != ROW]
    text = df.select(*[(F.nullif(F.col(f"`{c}`"), F.lit("")) if spec.empty_as_null else F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c) for c in columns])
    stage = staging(spec)
    run = run_sql or (lambda statements: _run(df.sparkSession, spec.connection, statements))
    try:
        if spec.create_schema and len(spec.table.parts) == 2:
            run([f"CREATE SCHEMA IF NOT EXISTS {quoted(spec.table.parts[0])}"])
        types = ", ".join(f"{quoted(c)} text" for c in columns)
        text.write.format("jdbc").options(**spec.connection.options(), dbtable=stage.sql, createTableColumnTypes=types).mode("error").save()
        run(swap(spec, stage, columns))
    except RunError:
        raise
    except Exception as e:
        raise RunError("DB_WRITE_FAILED", "the rows were not loaded", spec.connection.scrub(str(e))[:300]) from None
    return {"table": ".".join(spec.table.parts), "columns": columns, "mode": spec.mode}


def _run(spark: SparkSession, connection: Connection, statements: list[str]) -> None:
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in connection.options().items():
        if k not in ("url", "driver"):
            props.setProperty(k, v)
    c = jvm.java.sql.DriverManager.getConnection(connection.url, props)
    try:
        c.setAutoCommit("BEGIN" not in statements)
        s = c.createStatement()
        for x in statements:
            if x not in ("BEGIN", "COMMIT"):
                s.execute(x)
        if "COMMIT" in statements:
            c.commit()
    finally:
        c.close()
