"""Column types by name: a recursive parser of type strings, and the Spark type of each."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

from millrace.errors import TypeParseError

# Type names of the SQL dialect that the engine reads, with their Spark types.
PLAIN = {
    "UInt8": T.ShortType(),
    "UInt16": T.IntegerType(),
    "UInt32": T.LongType(),
    "UInt64": T.DecimalType(20, 0),
    "UInt128": T.DecimalType(38, 0),
    "UInt256": T.DecimalType(38, 0),
    "Int8": T.ByteType(),
    "Int16": T.ShortType(),
    "Int32": T.IntegerType(),
    "Int64": T.LongType(),
    "Int128": T.DecimalType(38, 0),
    "Int256": T.DecimalType(38, 0),
    "Bool": T.BooleanType(),
    "Boolean": T.BooleanType(),
    "Float32": T.FloatType(),
    "Float64": T.DoubleType(),
    "String": T.StringType(),
    "UUID": T.StringType(),
    "IPv4": T.StringType(),
    "IPv6": T.StringType(),
    "Date": T.DateType(),
    "Date32": T.DateType(),
    "DateTime": T.TimestampNTZType(),
    "JSON": T.StringType(),
}
DECIMALS = {"Decimal32": 9, "Decimal64": 18, "Decimal128": 38, "Decimal256": 76}
NEVER_NULL = {"Array", "Map", "Tuple", "Nested"}
PARTIAL = {"SimpleAggregateFunction", "AggregateFunction"}


@dataclass(frozen=True)
class SqlType:
    """A parsed type: its name, its inner types, and what else its brackets hold."""

    name: str
    inner: tuple[SqlType, ...] = ()
    labels: tuple[str, ...] = ()
    args: tuple = ()

    def __str__(self) -> str:
        if self.name in ("Enum8", "Enum16"):
            return f"{self.name}({', '.join(f"'{_quoted(k)}' = {v}" for k, v in self.args)})"
        parts = [f"{label} {t}" if label else str(t) for label, t in zip(self.labels or [""] * len(self.inner), self.inner)]
        parts = [*(f"'{a}'" if isinstance(a, str) and self.name.startswith(("DateTime", "Object")) else str(a) for a in self.args), *parts]
        return f"{self.name}({', '.join(parts)})" if parts else self.name

    @property
    def nullable(self) -> bool:
        return self.name == "Nullable" or (self.name in {"LowCardinality", *PARTIAL} and self.inner[0].nullable)

    @property
    def metadata(self) -> dict:
        """What the Spark type does not hold: enum values, the merging aggregate, the time zone."""
        out = {}
        for t in self.inner[:1] if self.name in {"Nullable", "LowCardinality", *PARTIAL} else ():
            out |= t.metadata
        if self.name in ("Enum8", "Enum16"):
            out["enum"] = dict(self.args)
        elif self.name in PARTIAL:
            out["agg"] = self.args[0]
        elif self.name == "FixedString":
            out["length"] = self.args[0]
        elif self.name in ("DateTime", "DateTime64") and self.args and isinstance(self.args[-1], str):
            out["timezone"] = self.args[-1]
        return out

    def spark(self) -> T.DataType:
        if self.name in PLAIN and not self.args:
            return PLAIN[self.name]
        if self.name in ("DateTime", "DateTime64"):
            return T.TimestampType() if self.args and isinstance(self.args[-1], str) else T.TimestampNTZType()
        if self.name == "Decimal":
            return T.DecimalType(min(38, self.args[0]), self.args[1])
        if self.name in DECIMALS:
            return T.DecimalType(min(38, DECIMALS[self.name]), self.args[0])
        if self.name in {"Nullable", "LowCardinality", *PARTIAL}:
            return self.inner[0].spark()
        if self.name == "Array":
            return T.ArrayType(self.inner[0].spark(), self.inner[0].nullable)
        if self.name == "Map":
            return T.MapType(self.inner[0].spark(), self.inner[1].spark(), self.inner[1].nullable)
        if self.name in ("Tuple", "Nested"):
            fields = [T.StructField(label or f"_{i}", t.spark(), t.nullable) for i, (label, t) in enumerate(zip(self.labels, self.inner), 1)]
            return T.ArrayType(T.StructType(fields), False) if self.name == "Nested" else T.StructType(fields)
        return T.StringType()  # FixedString, enums, Object('json') and unknown names

    def field(self, name: str) -> T.StructField:
        return T.StructField(name, self.spark(), self.nullable, self.metadata or None)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def split_args(text: str) -> list[str]:
    """Splits at commas outside of brackets and quotes."""
    out, depth, quote, at, i = [], 0, False, 0, 0
    while i < len(text):
        c = text[i]
        if quote:
            if c == "\\":
                i += 1
            elif c == "'":
                quote = False
        elif c == "'":
            quote = True
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
        elif c == "," and not depth:
            out.append(text[at:i].strip())
            at = i + 1
        i += 1
    if depth or quote:
        raise TypeParseError(f"unbalanced: {text}")
    rest = text[at:].strip()
    return [*out, rest] if rest or out else []


def _number(text: str, whole: str) -> int:
    if not re.fullmatch(r"[+-]?\d+", text.strip()):
        raise TypeParseError(f"{text!r} is not a number in {whole!r}")
    return int(text)


def _string(text: str, whole: str) -> str:
    if not (m := re.fullmatch(r"'((?:[^'\\]|\\.|'')*)'", text.strip(), re.S)):
        raise TypeParseError(f"{text!r} is not a quoted string in {whole!r}")
    return re.sub(r"\\(.)|''", lambda x: x[1] or "'", m[1])


def parse(text: str, strict: bool = False) -> SqlType:
    """Parses a type string. An unknown name stays as it is, or raises where ``strict``."""
    text = text.strip()
    m = re.fullmatch(r"(\w+)\s*(?:\((.*)\))?", text, re.S)
    if not m:
        if strict or not text or "(" in text or ")" in text:
            raise TypeParseError(f"not a type: {text!r}")
        return SqlType(text)
    name, raw = m[1], m[2]
    if raw is None:
        if name in PLAIN:
            return SqlType("Bool" if name == "Boolean" else name)
        if name in {*NEVER_NULL, *PARTIAL, *DECIMALS, "Nullable", "LowCardinality", "Decimal", "FixedString", "Enum8", "Enum16", "DateTime64"}:
            raise TypeParseError(f"{name} needs arguments")
        if strict:
            raise TypeParseError(f"unknown type {name}")
        return SqlType(name)
    args = split_args(raw)
    if name in ("Nullable", "LowCardinality", "Array"):
        if len(args) != 1:
            raise TypeParseError(f"{name} takes one type")
        inner = parse(args[0], strict)
        if name == "Nullable" and inner.name in NEVER_NULL:
            raise TypeParseError(f"{inner.name} can't be Nullable")
        return SqlType(name, (inner,))
    if name == "Map":
        if len(args) != 2:
            raise TypeParseError("Map takes two types")
        return SqlType(name, tuple(parse(a, strict) for a in args))
    if name in ("Tuple", "Nested"):
        named = [re.fullmatch(r"`?(\w+)`?\s+(.+)", a, re.S) for a in args]
        return SqlType(name, tuple(parse(x[2] if x else a, strict) for x, a in zip(named, args)), tuple(x[1] if x else "" for x in named))
    if name in PARTIAL:
        if len(args) < 2:
            raise TypeParseError(f"{name} takes a function and a type")
        return SqlType(name, (parse(args[1], strict),), args=(args[0],))
    if name in ("Enum8", "Enum16"):
        pairs = []
        for i, a in enumerate(args, 1):
            key, eq, value = a.rpartition("=")
            pairs.append((_string(key if eq else a, text), _number(value, text) if eq else i))
        if not pairs:
            raise TypeParseError(f"{name} has no values")
        return SqlType(name, args=tuple(pairs))
    if name == "FixedString" or name in DECIMALS:
        if len(args) != 1:
            raise TypeParseError(f"{name} takes one number")
        return SqlType(name, args=(_number(args[0], text),))
    if name == "Decimal":
        if len(args) not in (1, 2):
            raise TypeParseError("Decimal takes a precision and a scale")
        return SqlType(name, args=(_number(args[0], text), _number(args[1], text) if len(args) == 2 else 0))
    if name == "DateTime":
        return SqlType(name, args=tuple(_string(a, text) for a in args))
    if name == "DateTime64":
        return SqlType(name, args=(_number(args[0], text), *(_string(a, text) for a in args[1:])))
    if name == "Object":
        return SqlType(name, args=tuple(_string(a, text) for a in args))
    if strict:
        raise TypeParseError(f"unknown type {name}")
    return SqlType(text)


def parse_type(text: str, strict: bool = False) -> T.DataType:
    """The Spark type of a type string."""
    return parse(text, strict).spark()
