"""Versioned schema migrations: sources, order, checksums, a tracking table, and running them.

A migration is a folder ``<version>_<name>`` with ``up.sql`` and perhaps ``down.sql``. What ran is kept in a
Parquet table that is only appended to and read with FINAL: the newest record of a version counts.
"""

from __future__ import annotations

import hashlib
import re
import time
from dataclasses import dataclass
from importlib import resources
from pathlib import Path

from pyspark.sql import SparkSession

from millrace.errors import MigrationError
from millrace.operators.dml import insert
from millrace.operators.modifiers import final
from millrace.sources.tables import SEQUENCE, Engine, TableDef, replacing
from millrace.sources.types import split_args


@dataclass(frozen=True, order=True)
class Migration:
    version: int
    name: str
    up: str = ""
    down: str | None = None

    @property
    def checksum(self) -> str:
        return hashlib.sha256(self.up.encode()).hexdigest()


def parse_name(folder: str) -> tuple[int, str]:
    """Version and name: digits (with dashes, as in timestamps), an underscore, the name."""
    m = re.fullmatch(r"(\d[\d-]*)_(.+)", folder)
    if not m:
        raise MigrationError(f"{folder!r} is not <version>_<name>")
    return int(m[1].replace("-", "")), m[2]


def from_folder(path: str | Path) -> list[Migration]:
    out = []
    for p in sorted(Path(path).iterdir()):
        if not p.is_dir() or p.name.startswith("."):
            continue
        version, name = parse_name(p.name)
        if not (p / "up.sql").exists():
            raise MigrationError(f"{p.name} has no up.sql")
        down = p / "down.sql"
        out.append(Migration(version, name, (p / "up.sql").read_text(), down.read_text() if down.exists() else None))
    return combined(out)


def embedded(sources: dict[str, str | tuple[str, str | None]]) -> list[Migration]:
    """Migrations that a program carries itself: ``<version>_<name>`` to the text, or to the texts up and down."""
    pairs = [(parse_name(k), (v, None) if isinstance(v, str) else v) for k, v in sources.items()]
    return combined([Migration(version, name, up, down) for (version, name), (up, down) in pairs])


def from_package(package: str, folder: str = "migrations") -> list[Migration]:
    """Migrations in a folder of an installed package."""
    found = {}
    for p in resources.files(package).joinpath(folder).iterdir():
        if p.is_dir() and not p.name.startswith((".", "_")):
            texts = {f.name: f.read_text() for f in p.iterdir() if f.name in ("up.sql", "down.sql")}
            if "up.sql" not in texts:
                raise MigrationError(f"{p.name} has no up.sql")
            found[p.name] = texts["up.sql"], texts.get("down.sql")
    return embedded(found)


def combined(*sources: list[Migration]) -> list[Migration]:
    """All migrations in order; a version that comes twice is an error."""
    out = sorted((m for s in sources for m in s), key=lambda m: m.version)
    for a, b in zip(out, out[1:]):
        if a.version == b.version:
            raise MigrationError(f"version {a.version} comes twice: {a.name} and {b.name}")
    return out


def statements(sql: str) -> list[str]:
    """Splits at semicolons outside of strings and comments."""
    token = re.compile(r"--[^\n]*|/\*.*?\*/|'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|;|[^-/'\"`;]+|.", re.S)
    out, now = [], []
    for m in token.finditer(sql):
        t = m[0]
        if t == ";":
            out.append("".join(now).strip())
            now = []
        elif not t.startswith(("--", "/*")):
            now.append(t)
    return [s for s in [*out, "".join(now).strip()] if s]


#: Constant defaults of columns, and the functions that Spark has under another name.
_DEFAULT = re.compile(r"(?:true|false|null|[+-]?\d+(?:\.\d+)?|'(?:[^'\\]|\\.)*')\Z", re.I)
_CLOCKS = {"now()": "localtimestamp()", "today()": "current_date()"}


def translated(sql: str) -> str:
    """A CREATE TABLE text with an ENGINE clause as Spark's; other statements as they are.

    Types become Spark's; key, engine and sampling key stay in the table's properties; PARTITION BY, TTL and SETTINGS
    say how a server stores a table, and go.
    """
    m = re.fullmatch(r"\s*CREATE\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?([\w.`]+)\s*\((.*)\)\s*ENGINE\s*=\s*(\w+)\s*(?:\(([^)]*)\))?(.*)", sql, re.S | re.I)
    if not m:
        return sql
    columns, defaults = {}, {}
    for part in split_args(m[2]):
        if re.match(r"(?:INDEX|PROJECTION|CONSTRAINT|PRIMARY\s+KEY)\b", part, re.I):
            continue
        name, rest = re.match(r"`?(\w+)`?\s+(.*)", part, re.S).groups()
        kind, *more = re.split(r"\s+(?=(?:DEFAULT|CODEC|COMMENT|TTL|MATERIALIZED|ALIAS)\b)", rest, flags=re.I)
        columns[name] = kind.strip()
        for x in more:
            if d := re.match(r"DEFAULT\s+(.+)", x, re.S | re.I):
                text = _CLOCKS.get(d[1].strip().lower(), d[1].strip())
                if not _DEFAULT.match(text) and text not in _CLOCKS.values():
                    raise MigrationError(f"{name}: no counterpart of the default {text}")
                defaults[name] = text
    clause = lambda word: re.search(rf"\b{word}\s+(?:\(([^)]*)\)|([\w`]+))", m[5], re.I)
    found = clause(r"ORDER\s+BY") or clause(r"PRIMARY\s+KEY")
    key = [x.strip("` ") for x in (found[1] or found[2] or "").split(",") if x.strip()] if found else []
    sample = clause(r"SAMPLE\s+BY")
    engine = Engine(m[3], tuple(x.strip("` ") for x in (m[4] or "").split(",") if x.strip()))
    table = TableDef.of(m[1].replace("`", ""), columns, [k for k in key if k in columns], engine=engine, sample_by=sample[2] if sample and sample[2] in columns else None)
    return table.ddl(defaults)


def generate(path: str | Path, name: str, version: int | None = None) -> Path:
    """Makes the folder of a new migration."""
    at = Path(path) / f"{version or time.strftime('%Y%m%d%H%M%S')}_{re.sub(r'\W+', '_', name.lower())}"
    at.mkdir(parents=True)
    (at / "up.sql").write_text("-- what this migration does\n")
    (at / "down.sql").write_text("-- how it is undone\n")
    return at


class Harness:
    """Runs migrations. ``tracking``: the folder of the tracking table."""

    def __init__(self, spark: SparkSession, migrations: list[Migration], tracking: str):
        self.spark, self.all = spark, combined(migrations)
        self.table = TableDef.of("_migrations", {"version": "Int64", "run_on": "Float64", "checksum": "String", "applied": "Bool"}, "version", engine=replacing("run_on"), path=tracking)

    def applied(self) -> dict[int, str]:
        """Checksum of every version that is in effect."""
        try:
            rows = self.spark.read.parquet(self.table.path)
        except Exception as e:  # noqa: BLE001  nothing ran yet
            if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER" in str(e):
                return {}
            raise
        assert SEQUENCE in rows.columns
        return {r.version: r.checksum for r in final(rows, self.table.engine, "version").filter("applied").collect()}

    def forget(self) -> None:
        """Records every migration as not in effect, as after a reset."""
        names = {m.version: m for m in self.all}
        insert(self.spark, self.table, [(v, time.time(), names[v].checksum if v in names else c, False) for v, c in self.applied().items()])

    def pending(self) -> list[Migration]:
        done = self.applied()
        return [m for m in self.all if m.version not in done]

    def verify(self) -> None:
        """Raises where a migration that ran has changed since."""
        done = self.applied()
        for m in self.all:
            if m.version in done and done[m.version] != m.checksum:
                raise MigrationError(f"{m.version}_{m.name} has changed since it ran")

    def _record(self, m: Migration, applied: bool) -> None:
        insert(self.spark, self.table, [(m.version, time.time(), m.checksum, applied)])

    def _do(self, m: Migration, up: bool) -> None:
        text = m.up if up else m.down
        if text is None:
            raise MigrationError(f"{m.version}_{m.name} has no down.sql")
        for s in statements(text):
            self.spark.sql(translated(s))
        self._record(m, up)

    def run(self, to: int | None = None) -> list[int]:
        """Runs what is pending, up to a version."""
        self.verify()
        ran = [m for m in self.pending() if to is None or m.version <= to]
        for m in ran:
            self._do(m, True)
        return [m.version for m in ran]

    def revert(self, n: int = 1, to: int | None = None) -> list[int]:
        """Reverts the last n, or all after a version."""
        done = self.applied()
        back = [m for m in reversed(self.all) if m.version in done]
        back = back[:n] if to is None else [m for m in back if m.version > to]
        for m in back:
            self._do(m, False)
        return [m.version for m in back]

    def redo(self, n: int = 1) -> list[int]:
        back = self.revert(n)
        for m in self.all:
            if m.version in back:
                self._do(m, True)
        return sorted(back)
