"""Byte-exact codec cases, round trips and records that are too short."""

import datetime as dt
import random
import struct
from decimal import Decimal

import pytest

from keyloom import layout as L
from keyloom.functions.codec import decode_keys, decode_records, encode_records, extract_ranges, key_image
from keyloom.layout import KeySpec, Layout, Segment


def decode_one(spark, record: bytes, *columns, **kw):
    lay = Layout.build("t", columns)
    df = spark.createDataFrame([(bytearray(record),)], "rec binary")
    return decode_records(df, lay, **kw).first()


def encode_one(spark, value, ddl, *spec):
    df = spark.createDataFrame([(value,)], f"v {ddl}")
    return bytes(encode_records(df, Layout.build("t", [("v", *spec)])).first()[0])


@pytest.mark.parametrize(
    "value, ddl, native, length, raw",
    [
        (dt.date(2016, 1, 2), "date", L.DATE, 4, "0201e007"),
        (None, "date", L.DATE, 4, "00000000"),
        ("13:45:30", "string", L.TIME, 4, "c846cd00"),
        ("00:00:00", "string", L.TIME, 4, "00000000"),
        (42, "int", L.INT, 4, "2a000000"),
        (-1, "int", L.INT, 4, "ffffffff"),
        (127, "smallint", L.INT, 1, "7f"),
        (-32768, "smallint", L.INT, 2, "0080"),
        (1000000, "int", L.INT, 4, "40420f00"),
        (-9000000000, "long", L.INT, 8, "00e68ee7fdffffff"),
        ("hi", "string", L.STRING, 8, "6869202020202020"),
        ("abc", "string", L.LSTRING, 6, "036162632020"),
        ("abc", "string", L.ZSTRING, 6, "616263000000"),
        (Decimal("1.2345"), "decimal(19,4)", L.MONEY, 8, "3930000000000000"),
        (Decimal("-922337203685477.5808"), "decimal(19,4)", L.MONEY, 8, "0000000000000080"),
        (True, "boolean", L.LOGICAL, 1, "ff"),
        (False, "boolean", L.LOGICAL, 1, "00"),
        (7, "long", L.AUTOINCREMENT, 4, "07000000"),
        (-5, "long", L.DECIMAL, 8, "fbffffffffffffff"),
        (1.5, "double", L.FLOAT, 8, struct.pack("<d", 1.5).hex()),
        (2.25, "float", L.FLOAT, 4, struct.pack("<f", 2.25).hex()),
    ],
)
def test_value_bytes_and_back(spark, value, ddl, native, length, raw):
    assert encode_one(spark, value, ddl, native, length).hex() == raw
    assert decode_one(spark, bytes.fromhex(raw), ("v", native, length)).v == value


def test_decode_rules(spark):
    one = lambda raw, *spec: decode_one(spark, raw, ("v", *spec)).v
    assert one(b"\xff", L.INT, 1) == 255
    assert one(b"\x01\x02\x03", L.INT, 3) == 0
    assert one(b"\x05", L.LOGICAL, 1) is True
    assert one(b"caf\xe9 \t", L.STRING, 6) == "caf\xe9"
    assert one(b"\x09ab\xff", L.LSTRING, 4) == "ab�"
    assert one(b"ab\x00cd", L.ZSTRING, 5) == "ab"
    assert one(b"\x1f\x02\xe7\x07", L.DATE, 4) is None
    assert one(b"\x1f\x02\xe7\x07", L.DATE, 4, 0, "0001-01-01") == dt.date(1, 1, 1)
    assert one(struct.pack("<d", float("nan")), L.FLOAT, 8, 0, "7") == 7.0
    assert one(struct.pack("<d", 5e-320), L.FLOAT, 8) == 0.0
    assert one(struct.pack("<f", float("inf")), L.FLOAT, 4) == 0.0
    assert one(b"\x00\x00", 19, 2, 0, "none") == "none"
    assert one(b"\x00\x00", 19, 2) is None
    assert one(b"A ", 19, 2) == "A"
    assert decode_one(spark, b"ab  ", ("v", L.STRING, 4), pad=True).v == "ab  "


def test_short_records_read_as_empty(spark):
    cols = [(f"c{t}", t, 4, 1) for t in (0, 1, 2, 3, 4, 5, 6, 7, 10, 11, 14, 15, 18)]
    lay = Layout.build("t", cols)
    df = spark.createDataFrame([(1, bytearray(b"\x02\x01")), (2, bytearray(b"")), (3, None)], "id int, rec binary")
    got = {r.id: r for r in decode_records(df, lay, keep=["id"]).collect()}
    for i in (1, 2):
        r = got[i]
        assert (r.c0, r.c1, r.c2, r.c3, r.c4) == ("", 0, 0.0, None, "00:00:00")
        assert (r.c5, r.c6, r.c7, r.c10, r.c11, r.c14, r.c15, r.c18) == (0, Decimal("0.0000"), False, "", "", 0, 0, None)


def test_random_bytes_never_fail(spark):
    rng = random.Random(3)
    data = [(bytearray(rng.randbytes(rng.randrange(0, 40))),) for _ in range(500)]
    cols = [(f"c{t}_{n}", t, n, o) for t in list(range(0, 21)) for n, o in ((1, 0), (4, 3), (8, 20))]
    lay = Layout.build("t", cols)
    assert decode_records(spark.createDataFrame(data, "rec binary"), lay).count() == 500
    assert len(decode_records(spark.createDataFrame(data, "rec binary"), lay).collect()) == 500


def test_round_trip_wide_record(spark):
    lay = Layout.build(
        "wide",
        [("id", 1, 4), ("name", 0, 30), ("addr1", 0, 30), ("addr2", 0, 30), ("city", 0, 20), ("state", 0, 2),
         ("zip", 0, 10), ("bal", 5, 8), ("status", 1, 2), ("note", 0, 64)],
    )
    assert lay.record_length == 200
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abcXYZ ") for _ in range(rng.randrange(n))).rstrip()
    data = [
        (rng.randrange(-2**31, 2**31), word(30), word(30), word(30), word(20), word(2), word(10),
         rng.randrange(-2**63, 2**63), rng.randrange(-2**15, 2**15), word(64))
        for _ in range(300)
    ]
    df = spark.createDataFrame(data, lay.struct_type())
    assert sorted(map(tuple, decode_records(encode_records(df, lay), lay).collect())) == sorted(data)


def test_overlapping_fields_later_on_top(spark):
    lay = Layout.build("o", [("whole", 0, 6, 0), ("part", 0, 2, 2), ("past", 0, 4, 5)], record_length=6)
    df = spark.createDataFrame([("abcdef", "XY", "zzzz")], "whole string, part string, past string")
    assert bytes(encode_records(df, lay).first()[0]) == b"abXYef"


def test_unused_fields_are_pruned(spark, table):
    lay = Layout.build("p", [("a", 1, 4), ("b", 1, 8), ("c", 2, 8)])
    df = spark.createDataFrame([(bytearray(20),)], "rec binary")
    plan = decode_records(df, lay).select("a")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("read(") == 1


def test_ranges_and_key_images(spark):
    lay = Layout.build("t", [("a", 0, 2), ("n", 1, 4), ("b", 0, 3)])
    key = KeySpec((Segment("b"), Segment("n")))
    df = spark.createDataFrame([(bytearray(b"AA\x01\x00\x00\x00xyz"),)], "rec binary")
    got = df.select(
        extract_ranges("rec", [(2, 7), (3, 0)]).alias("r"), extract_ranges("rec", []).alias("w"),
        extract_ranges("rec", [(4, 8)]).alias("p"), key_image(lay, key).alias("k"),
    ).first()
    assert (bytes(got.r), bytes(got.w)) == (b"yzAA\x01", b"AA\x01\x00\x00\x00xyz")
    assert bytes(got.p) == b"z\x00\x00\x00" and bytes(got.k) == b"xyz\x01\x00\x00\x00"


def test_decode_keys_wildcards(spark):
    lay = Layout.build("m", [("region", 0, 4), ("dept", 0, 4), ("n", 1, 4), ("d", 3, 4)])
    key = KeySpec((Segment("region"), Segment("dept", null_byte=0x20), Segment("n"), Segment("d")))
    images = [(1, b"OAK " + b"    " + b"\x07\x00\x00\x00" + b"\x02\x01\xe0\x07"), (2, b"A\x00ZZ"), (3, b"")]
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in images], "id int, key binary")
    wild = {r.id: r for r in decode_keys(df, "key", lay, key, null_wildcard=True).collect()}
    assert (wild[1].region, wild[1].dept, wild[1].wild_dept, wild[1].n) == ("OAK", None, True, 7)
    assert wild[1].d == dt.date(2016, 1, 2)
    assert (wild[2].region, wild[2].n, wild[2].wild_n, wild[2].wild_dept) == ("A", None, True, False)
    exact = {r.id: r for r in decode_keys(df, "key", lay, key).collect()}
    assert (exact[1].dept, exact[3].region, exact[3].n, exact[3].d) == ("", "", 0, None)


def test_text_is_written_as_it_is_read(spark):
    layout = Layout.build("T", [("s", L.STRING, 6), ("z", L.ZSTRING, 6), ("x", 99, 4)], record_length=16)
    data = [(1, "Ärger", "né", "ÿ"), (2, "日本x", "too long here", "abcdef"), (3, None, None, None), (4, "🙂é", "", "")]
    df = spark.createDataFrame(data, "id int, s string, z string, x string")
    encoded = encode_records(df, layout, keep=["id"], unfit="unfit")
    got = {r.id: (bytes(r.rec), r.unfit) for r in encoded.collect()}
    assert got[1] == ("Ärger ".encode("latin-1") + "né".encode() + bytes(3) + "ÿ   ".encode("latin-1"), [])
    assert got[2][0][:6] == b"??x   " and got[2][1] == ["s", "z", "x"] and got[4][0][:6] == "?é    ".encode("latin-1") and got[4][1] == ["s"]
    back = {r.id: (r.s, r.z) for r in decode_records(encoded, layout, keep=["id"]).collect()}
    assert back[1] == ("Ärger", "né") and back[3] == ("", "")


def test_money_beyond_its_bytes_and_large_arrow_types(spark):
    import pyarrow as pa

    from keyloom.functions import codec

    layout = Layout.build("M", [("m", L.MONEY, 8), ("s", L.STRING, 4)])
    df = spark.createDataFrame([(1e30, "ab"), (12.5, "cd"), (None, "ef")], "m double, s string")
    assert [bytes(r.rec) for r in encode_records(df, layout).collect()] == [bytes(8) + b"ab  ", (125000).to_bytes(8, "little") + b"cd  ", bytes(8) + b"ef  "]
    for kind in (pa.binary(), pa.large_binary(), pa.binary_view()):
        block, whole = codec._windows(pa.array([b"0123", b"45", b"6789"], kind), 1, 3)
        assert [bytes(b) for b in block] == [b"123", bytes(3), b"789"] and whole.tolist() == [True, False, True]
    before = spark.conf.get("spark.sql.execution.arrow.useLargeVarTypes")
    spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", "true")
    try:
        back = decode_records(encode_records(df, layout), layout)
        assert [(float(r.m), r.s) for r in back.collect()] == [(0.0, "ab"), (12.5, "cd"), (0.0, "ef")]
    finally:
        spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", before)
