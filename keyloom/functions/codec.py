"""Fixed-width record bytes to typed columns and back.

Text, logical and byte-range work stays in built-in expressions.  Little-endian numbers
have no built-in reader, so they go through Arrow UDFs over NumPy views, one per field:
a field that the query does not use is pruned together with its UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from keyloom import layout as L
from keyloom.layout import Field, KeySpec, Layout

# Characters that count as trailing blanks of a text field.
_BLANKS = " \t\n\x0b\x0c\r\x85\xa0"
_MONEY_UNITS = 10000  # units per currency unit of MONEY


#: A character that one byte of a record cannot hold.
_BEYOND = r"[^\x{0}-\x{FF}]"


# -- byte access -----------------------------------------------------------------------


def _zeros(n: int, byte: int = 0) -> Column:
    return F.expr("X'" + f"{byte:02x}" * n + "'")


def _slice(rec: Column, offset: int, length: int) -> Column:
    return F.substring(rec, offset + 1, length)


def _inside(rec: Column, f: Field) -> Column:
    return F.octet_length(rec) >= F.lit(f.end)


def _windows(rec: pa.Array, offset: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes ``[offset, offset + length)`` of every record, and which records reach that far."""
    if isinstance(rec, pa.ChunkedArray):
        rec = rec.combine_chunks()
    n = len(rec)
    if n == 0:
        return np.zeros((0, length), np.uint8), np.zeros(0, bool)
    wide = pa.types.is_large_binary(rec.type) or pa.types.is_large_string(rec.type)
    if not wide and not pa.types.is_binary(rec.type) and not pa.types.is_string(rec.type):
        rec = rec.cast(pa.binary())
    starts = np.frombuffer(rec.buffers()[1], np.int64 if wide else np.int32)[rec.offset : rec.offset + n + 1].astype(np.int64)
    size = np.diff(starts)
    data = rec.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    whole = size >= offset + length
    if whole.all() and (size == size[0]).all():
        block = raw[starts[0] : starts[-1]].reshape(n, int(size[0]))
        return np.ascontiguousarray(block[:, offset : offset + length]), whole
    out = np.zeros((n, length), np.uint8)
    at = starts[:-1][whole][:, None] + offset + np.arange(length)
    out[whole] = raw[at]
    return out, whole


def _reader(kind: str, spark_type: str):
    """Arrow UDF factory: ``kind`` is a NumPy little-endian type code."""

    def at(rec: Column, f: Field) -> Column:
        offset, length = f.offset, np.dtype(kind).itemsize

        @arrow_udf(spark_type)
        def read(records: pa.Array) -> pa.Array:
            block, _ = _windows(records, offset, length)
            values = block.view(kind).ravel()
            return pa.array(values.astype(np.float64 if kind[1] == "f" else np.int64), mask=_null_mask(records))

        return read(rec)

    return at


def _null_mask(records: pa.Array) -> np.ndarray:
    return np.asarray(records.is_null())


_READ = {k: _reader(k, "double" if k[1] == "f" else "long") for k in ("<u1", "<i2", "<i4", "<i8", "<u4", "<f4", "<f8")}


def _read_date(rec: Column, f: Field) -> Column:
    offset = f.offset

    @arrow_udf("date")
    def read(records: pa.Array) -> pa.Array:
        block, _ = _windows(records, offset, 4)
        day, month = block[:, 0].astype(np.int64), block[:, 1].astype(np.int64)
        year = block[:, 2].astype(np.int64) | (block[:, 3].astype(np.int64) << 8)
        ok = (year >= 1) & (year <= 9999) & (month >= 1) & (month <= 12) & (day >= 1)
        months = np.where(ok, (year - 1970) * 12 + month - 1, 0).astype("datetime64[M]")
        first = months.astype("datetime64[D]")
        days_in_month = ((months + 1).astype("datetime64[D]") - first).astype(np.int64)
        ok &= day <= days_in_month
        value = first.astype(np.int64) + np.where(ok, day - 1, 0)
        return pa.array(value.astype(np.int32), mask=~ok).cast(pa.date32())

    return read(rec)


# -- decode ----------------------------------------------------------------------------


def _integer(rec: Column, f: Field) -> Column:
    code = {1: "<u1", 2: "<i2", 4: "<i4", 8: "<i8"}.get(f.length)
    if code is None:
        return F.when(rec.isNotNull(), F.lit(0).cast("long"))
    return _READ[code](rec, f)


def _eight(rec: Column, f: Field) -> Column:
    """Signed 64-bit value of up to eight bytes; shorter fields are zero-extended."""
    if f.length >= 8:
        return _READ["<i8"](rec, f)
    padded = F.rpad(_slice(rec, f.offset, f.length), 8, _zeros(1))
    return _READ["<i8"](F.when(_inside(rec, f), padded).otherwise(_zeros(8)), Field(0, "", L.INT, 8, 0))


def _text(raw: Column, pad: bool) -> Column:
    return raw if pad else F.rtrim(raw, F.lit(_BLANKS))


def _utf8(raw: Column) -> Column:
    return F.make_valid_utf8(raw.cast("string"))


def _time_text(packed: Column) -> Column:
    parts = [F.pmod(F.floor(packed / F.lit(d)), F.lit(100)).cast("int").cast("string") for d in (1000000, 10000, 100)]
    return F.concat_ws(":", *[F.lpad(p, 2, "0") for p in parts])


def decode_field(rec: Column, f: Field, pad: bool = False) -> Column:
    """Value of one field; a field window past the record's end reads as empty."""
    t, inside, raw = f.native_type, _inside(rec, f), _slice(rec, f.offset, f.length)
    live = rec.isNotNull()
    if t in L.INTEGER_TYPES:
        return _integer(rec, f).cast(f.spark_type())
    if t == L.DECIMAL:
        return _eight(rec, f)
    if t == L.MONEY:
        units = _eight(rec, f).cast("decimal(19,0)")
        return (units * F.expr("0.0001BD")).cast(f.spark_type())
    if t == L.FLOAT:
        default = F.lit(float(f.default or 0))
        if f.length not in (4, 8):
            return F.when(live, default).cast(f.spark_type())
        value = _READ["<f4" if f.length == 4 else "<f8"](rec, f)
        smallest = float(np.finfo(np.float32 if f.length == 4 else np.float64).tiny)
        normal = inside & (F.abs(value) >= F.lit(smallest)) & (F.abs(value) < F.lit(float("inf")))
        return F.when(normal, value).when(live, default).cast(f.spark_type())
    if t == L.DATE:
        value = _read_date(rec, f) if f.length >= 4 else F.lit(None).cast("date")
        if f.default is None:
            return value
        return F.coalesce(value, F.when(live, F.expr(f"try_cast('{f.default}' AS DATE)")))
    if t == L.TIME:
        if f.length < 4:
            return F.when(live, F.lit("00:00:00"))
        return F.when(live, _time_text(_READ["<u4"](rec, f)))
    if t == L.LOGICAL:
        return inside & (_slice(rec, f.offset, 1) != _zeros(1))
    if t == L.LSTRING:
        size = F.conv(F.hex(_slice(rec, f.offset, 1)), 16, 10).cast("int")
        data = F.substring(rec, F.lit(f.offset + 2), F.least(size, F.lit(f.length - 1)))
        return F.when(inside, _text(_utf8(data), pad)).when(live, F.lit(""))
    if t in (L.ZSTRING, L.ZSTRING_12):
        text = F.substring_index(_utf8(raw), "\x00", 1)
        return F.when(inside, _text(text, pad)).when(live, F.lit(""))
    latin = _text(F.decode(raw, "ISO-8859-1"), pad)
    if t == L.STRING:
        return F.when(inside, latin).when(live, F.lit(""))
    default = F.lit(f.default).cast("string")
    return F.when(inside & (raw != _zeros(f.length)), latin).otherwise(F.when(live, default))


def decode_records(
    df: DataFrame, layout: Layout, rec: str = "rec", keep: Sequence[str] = (), pad: bool = False
) -> DataFrame:
    """Typed columns of every record, after the ``keep`` columns.  Short records never fail."""
    source = F.col(rec)
    return df.select(*keep, *[decode_field(source, f, pad).alias(f.name) for f in layout.fields])


# -- encode ----------------------------------------------------------------------------


def _encode_input(f: Field) -> Column:
    """The field's value as the writer below wants it: padded bytes, a long, a double or a date."""
    c, t, n = F.col(f.name), f.native_type, f.length
    if t in L.INTEGER_TYPES or t == L.DECIMAL:
        return F.coalesce(c.cast("long"), F.lit(0).cast("long"))
    if t == L.MONEY:
        # what 64 bits of units cannot hold is written as nothing
        units = F.expr(f"try_multiply(try_cast(`{f.name}` AS DECIMAL(30,10)), {_MONEY_UNITS})").try_cast("long")
        return F.coalesce(units, F.lit(0).cast("long"))
    if t == L.FLOAT:
        return F.coalesce(c.cast("double"), F.lit(0.0))
    if t == L.DATE:
        return c.cast("date")
    if t == L.TIME:
        digits = F.rpad(F.regexp_replace(c.cast("string"), "[^0-9]", ""), 6, "x")
        packed = F.expr("0L")
        for i, unit in enumerate((1000000, 10000, 100)):
            packed = packed + F.substring(digits, 2 * i + 1, 2).try_cast("long") * F.lit(unit)
        return F.coalesce(packed, F.lit(0).cast("long"))
    if t == L.LOGICAL:
        return F.when(c.cast("boolean"), F.lit(0xFF)).otherwise(F.lit(0)).cast("long")
    data = F.coalesce(c.cast("string"), F.lit("")).cast("binary")
    if t == L.LSTRING:
        if n < 2:
            return _zeros(n)
        size = F.least(F.octet_length(data), F.lit(n - 1))
        prefix = F.unhex(F.lpad(F.hex(size.bitwiseAND(255)), 2, "0"))
        return F.concat(prefix, F.rpad(data, n - 1, _zeros(1, 0x20)))
    if t in (L.ZSTRING, L.ZSTRING_12):
        return F.rpad(F.substring(data, 1, n - 1), n, _zeros(1))
    return F.rpad(F.encode(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), _BEYOND, "?"), "ISO-8859-1"), n, _zeros(1, 0x20))


def unfit_fields(layout: Layout) -> Column:
    """Names of the text fields whose value a record cannot hold whole: a character beyond one byte, or too long."""
    def told(f: Field) -> Column:
        c, t = F.col(f.name).cast("string"), f.native_type
        if t in (L.LSTRING, L.ZSTRING, L.ZSTRING_12):
            bad = F.octet_length(c) > f.length - 1
        else:
            bad = c.rlike(_BEYOND) | (F.length(c) > f.length)
        return F.when(bad, F.lit(f.name))

    known = {*L.INTEGER_TYPES, L.DECIMAL, L.MONEY, L.FLOAT, L.DATE, L.TIME, L.LOGICAL}
    names = [told(f) for f in layout.fields if f.native_type not in known and f.end <= layout.record_length]
    return F.filter(F.array(*names), lambda n: n.isNotNull()) if names else F.array().cast("array<string>")


def _write_block(values: pa.Array, native_type: int, length: int) -> np.ndarray:
    n = len(values)
    if pa.types.is_binary(values.type) or pa.types.is_large_binary(values.type):
        return _windows(values, 0, length)[0]
    if native_type == L.FLOAT:
        number = values.to_numpy(zero_copy_only=False)
        if length not in (4, 8):
            return np.zeros((n, length), np.uint8)
        with np.errstate(over="ignore"):
            return number.astype("<f4" if length == 4 else "<f8").view(np.uint8).reshape(n, length)
    if native_type == L.DATE:
        out = np.zeros((n, length), np.uint8)
        if length >= 4:
            known = np.asarray(values.is_valid())
            days = values.cast(pa.int32()).fill_null(0).to_numpy(zero_copy_only=False).astype("datetime64[D]")
            months = days.astype("datetime64[M]")
            year = months.astype("datetime64[Y]").astype(np.int64) + 1970
            parts = ((days - months.astype("datetime64[D]")).astype(np.int64) + 1,
                     months.astype(np.int64) % 12 + 1, year & 0xFF, (year >> 8) & 0xFF)
            for i, part in enumerate(parts):
                out[:, i] = np.where(known, part, 0)
        return out
    number = values.to_numpy(zero_copy_only=False).astype("<i8").view(np.uint8).reshape(n, 8)
    out = np.zeros((n, length), np.uint8)
    width = {L.LOGICAL: 1, L.TIME: 4 if length >= 4 else 0}.get(native_type, 8)
    width = min(width, length)
    out[:, :width] = number[:, :width]
    return out


def encode_record(layout: Layout) -> Column:
    """One binary of ``record_length`` bytes; fields are laid down in order, later ones on top."""
    fields = [f for f in layout.fields if f.end <= layout.record_length]
    size = layout.record_length
    plan = [(f.offset, f.length, f.native_type) for f in fields]

    @arrow_udf("binary")
    def write(*columns: pa.Array) -> pa.Array:
        columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
        n = len(columns[0])
        out = np.zeros((n, size), np.uint8)
        for (offset, length, native_type), values in zip(plan, columns):
            out[:, offset : offset + length] = _write_block(values, native_type, length)
        return fixed_binary(out)

    return write(*[_encode_input(f) for f in fields])


def fixed_binary(block: np.ndarray) -> pa.Array:
    """A binary array over the rows of a byte matrix, without copying row by row."""
    n, size = block.shape
    starts = (np.arange(n + 1, dtype=np.int64) * size).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), n, [None, pa.py_buffer(starts), pa.py_buffer(np.ascontiguousarray(block))]
    )


def encode_records(df: DataFrame, layout: Layout, rec: str = "rec", keep: Sequence[str] = (), unfit: str | None = None) -> DataFrame:
    """The binary of every row after its ``keep`` columns.

    Plain text is written a byte a character, as it is read; a character beyond that becomes a
    question mark, and text that is too long is cut.  ``unfit`` names a column that lists the
    fields this happened to.
    """
    told = [unfit_fields(layout).alias(unfit)] if unfit else []
    return df.select(*keep, encode_record(layout).alias(rec), *told)


# -- byte ranges and keys --------------------------------------------------------------


def extract_ranges(rec: str | Column, ranges: Sequence[tuple[int, int]]) -> Column:
    """The ``(length, offset)`` ranges one after another, zero-filled past the end; none means all."""
    source = F.col(rec) if isinstance(rec, str) else rec
    if not ranges:
        return source
    return F.concat(*[F.rpad(_slice(source, off, n), n, _zeros(1)) for n, off in ranges])


def key_image(layout: Layout, key: KeySpec, rec: str | Column = "rec") -> Column:
    """The key bytes of a record: its segments one after another."""
    return extract_ranges(rec, [(layout.field(s.column).length, layout.field(s.column).offset) for s in key.segments])


def decode_keys(
    df: DataFrame, column: str, layout: Layout, key: KeySpec, null_wildcard: bool = False
) -> DataFrame:
    """Typed segment columns of key images, plus ``wild_<segment>``.

    With ``null_wildcard`` a segment filled with its null byte puts no constraint on the
    search: its value is null and its flag is set.
    """
    placed = layout.key_fields(key)
    whole = F.rpad(F.col(column), sum(f.length for f in placed), _zeros(1))
    out = df.withColumn("__key", whole)
    columns = []
    for f, segment in zip(placed, key.segments):
        raw = _slice(F.col("__key"), f.offset, f.length)
        if null_wildcard:
            wild = raw == _zeros(f.length, segment.null_byte)
        else:
            wild = F.lit(False)
        columns += [F.when(~wild, _key_value(f, raw)).alias(f.name), wild.alias(f"wild_{f.name}")]
    return out.select(*df.columns, *columns)


def _key_value(f: Field, raw: Column) -> Column:
    key, t = F.col("__key"), f.native_type
    if t == L.LSTRING:
        raw = F.substring(key, f.offset + 2, f.length - 1)
    if t in (L.INT, L.AUTOINC, L.AUTOINCREMENT, L.DECIMAL, L.MONEY, L.LOGICAL, L.DATE):
        return decode_field(key, f)
    if t == L.FLOAT and f.length in (4, 8):
        return _READ["<f4" if f.length == 4 else "<f8"](key, f).cast(f.spark_type())
    if t == L.TIME:
        return F.when(raw != _zeros(f.length), decode_field(key, f))
    return F.rtrim(F.substring_index(F.decode(raw, "ISO-8859-1"), "\x00", 1), F.lit(_BLANKS))
