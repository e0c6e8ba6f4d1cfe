"""Record layouts: fields at byte offsets, and keys as orderings over them.

A layout is metadata only.  A key is an ordering plus a uniqueness rule; there is no
physical index behind it, Spark sorts or hashes by the key columns instead.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field as dc_field, replace

from pyspark.sql import types as T

# Native type codes of record fields.
STRING = 0
INT = 1
FLOAT = 2
DATE = 3
TIME = 4
DECIMAL = 5
MONEY = 6
LOGICAL = 7
LSTRING = 10
ZSTRING = 11
ZSTRING_12 = 12
AUTOINC = 14
AUTOINCREMENT = 15

# Key segment attribute bits.
ATTR_DUPLICATES = 0x0001
ATTR_OLD_BINARY = 0x0004
ATTR_SEGMENTED = 0x0010
ATTR_DESCENDING = 0x0040
ATTR_EXTENDED_TYPE = 0x0100

INTEGER_TYPES = (INT, AUTOINC, AUTOINCREMENT)
TEXT_TYPES = (STRING, LSTRING, ZSTRING, ZSTRING_12)

DEFAULT_RECNUM = "recnum"


@dataclass(frozen=True)
class Field:
    num: int
    name: str
    native_type: int
    length: int
    offset: int
    index: int | None = None
    default: str | None = None

    @property
    def end(self) -> int:
        return self.offset + self.length

    def spark_type(self) -> T.DataType:
        """Column type of the decoded field."""
        t, n = self.native_type, self.length
        if t == INT:
            return {1: T.ShortType(), 2: T.ShortType(), 4: T.IntegerType()}.get(n, T.LongType())
        if t in (AUTOINC, AUTOINCREMENT, DECIMAL):
            return T.LongType()
        if t == FLOAT:
            return T.FloatType() if n <= 4 else T.DoubleType()
        if t == DATE:
            return T.DateType()
        if t == MONEY:
            # 19 digits hold every 64-bit unit count.
            return T.DecimalType(19, 4)
        if t == LOGICAL:
            return T.BooleanType()
        return T.StringType()


@dataclass(frozen=True)
class Segment:
    column: str
    descending: bool = False
    attrs: int | None = None  # None: not declared
    null_byte: int = 0


@dataclass(frozen=True)
class KeySpec:
    """An ordered list of segments; ``num`` is 1-based, as in layout texts."""

    segments: tuple[Segment, ...]
    num: int = 1

    @staticmethod
    def of(*columns: str, num: int = 1, duplicates: bool = True) -> "KeySpec":
        """``KeySpec.of("custkey", "-orderdate")``: a leading minus sorts descending."""
        attrs = ATTR_DUPLICATES if duplicates else 0
        return KeySpec(
            tuple(
                Segment(c.lstrip("-"), c.startswith("-"), attrs | (ATTR_DESCENDING if c.startswith("-") else 0))
                for c in columns
            ),
            num,
        )

    @property
    def columns(self) -> list[str]:
        return [s.column for s in self.segments]

    @property
    def order(self) -> list[tuple[str, bool]]:
        return [(s.column, s.descending) for s in self.segments]

    @property
    def unique(self) -> bool:
        """No segment carries the duplicates bit; undeclared attributes allow duplicates."""
        return all(s.attrs is not None and not s.attrs & ATTR_DUPLICATES for s in self.segments)


def as_key(key: "KeySpec | str | Sequence[str]") -> KeySpec:
    if isinstance(key, KeySpec):
        return key
    if isinstance(key, str):
        return KeySpec.of(key)
    return KeySpec.of(*key)


@dataclass(frozen=True)
class Layout:
    name: str
    record_length: int
    fields: tuple[Field, ...]
    keys: tuple[KeySpec, ...] = ()
    recnum: str = DEFAULT_RECNUM
    page_size: int = 4096
    file_flags: int = 0
    primary_index: int | None = None
    properties: dict = dc_field(default_factory=dict, compare=False, hash=False)

    @staticmethod
    def build(
        name: str,
        columns: Iterable[tuple],
        keys: Iterable[KeySpec] = (),
        record_length: int | None = None,
        **kw,
    ) -> "Layout":
        """Layout from ``(name, native_type, length[, offset[, default]])``; offsets default to running."""
        fields, running = [], 0
        for num, spec in enumerate(columns, 1):
            fname, ntype, length = spec[:3]
            offset = spec[3] if len(spec) > 3 and spec[3] is not None else running
            fields.append(Field(num, fname, ntype, length, offset, default=spec[4] if len(spec) > 4 else None))
            running = offset + length
        length = record_length if record_length is not None else max((f.end for f in fields), default=0)
        keys = tuple(replace(k, num=i) if k.num == 1 and i > 1 else k for i, k in enumerate(keys, 1))
        return Layout(name, length, tuple(fields), keys, **kw)

    def field(self, name: str) -> Field:
        for f in self.fields:
            if f.name == name:
                return f
        raise KeyError(f"{self.name} has no field {name}")

    def key(self, num: int) -> KeySpec:
        for k in self.keys:
            if k.num == num:
                return k
        raise KeyError(f"{self.name} has no key {num}")

    def key_length(self, key: KeySpec) -> int:
        return sum(self.field(s.column).length for s in key.segments)

    def key_fields(self, key: KeySpec) -> list[Field]:
        """The key's fields placed one after another, as they lie in a key image."""
        placed, running = [], 0
        for s in key.segments:
            f = self.field(s.column)
            placed.append(replace(f, offset=running))
            running += f.length
        return placed

    def struct_type(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type(), True) for f in self.fields])

    def resolved_recnum(self) -> str:
        """First field of key ``primary_index + 1``, else the configured row-identity column."""
        if self.primary_index is not None:
            for k in self.keys:
                if k.num == self.primary_index + 1:
                    return k.segments[0].column
        return self.recnum
