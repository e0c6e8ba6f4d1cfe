"""Record files, layout texts, imports, text output and streams."""

import os
import random

import pytest
from pyspark.sql import functions as F

from fixtures import pagefiles, records
from keyloom import layout as L
from keyloom.functions.codec import decode_records, encode_records
from keyloom.layout import KeySpec, Layout, Segment
from keyloom.operators import catalog as C
from keyloom.operators import drift as D
from keyloom.sources import importer, layout_text, record_files as R, tables as T
from keyloom.streaming.import_stream import import_stream
from tests.conftest import DATA, rows


def recs(n, size=24, seed=1):
    rng = random.Random(seed)
    return [i.to_bytes(4, "little") + bytes([1]) + rng.randbytes(size - 5) for i in range(n)]


def write(folder, name, data):
    path = os.path.join(str(folder), name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)
    return path


def found(df):
    return sorted(bytes(r.rec) for r in df.select("rec").collect())


KEYS = [[(0, 4, 1, 0x100, 0)], [(4, 6, 0, 0x41, 0x20), (0, 4, 0, 0x104, 0)]]


@pytest.mark.parametrize("page_size", [512, 4096])
def test_v6_raw_skips_dead_slots(spark, tmp_path, page_size):
    data = recs(300)
    write(tmp_path, "a.B", pagefiles.v6_file(data, page_size, dead_every=4))
    write(tmp_path, "sub/b.b", pagefiles.v6_file(data[:50], page_size))
    write(tmp_path, "c.txt", b"no record file")
    assert found(R.read_record_files(spark, str(tmp_path), mode="raw")) == sorted(data + data[:50])
    assert found(R.read_record_files(spark, str(tmp_path), recursive=False)) == sorted(data)


@pytest.mark.parametrize("second", [False, True])
def test_page_map_hides_stale_pages(spark, tmp_path, second):
    # with small pages the map needs several pairs
    data = recs(5000, 24)
    write(tmp_path, "a.B", pagefiles.v6_file(data, 512, stale=True, newer_map_second=second))
    assert found(R.read_record_files(spark, str(tmp_path))) == sorted(data)
    raw = R.read_record_files(spark, str(tmp_path), mode="raw").count()
    assert raw > len(data)
    few = R.read_record_files(spark, str(tmp_path), limit_to_declared=True)
    assert few.count() == len(data)


def test_chunks_split_one_file(spark, tmp_path, monkeypatch):
    data = recs(2000)
    write(tmp_path, "a.B", pagefiles.v6_file(data, 512, stale=True))
    write(tmp_path, "o.B", pagefiles.v5_file(data, list(range(3, 900, 2)), 512))
    monkeypatch.setattr(R, "CHUNK_BYTES", 4096)
    headers = R.read_headers(R.collect_files(spark, str(tmp_path)))
    assert R._chunks(headers).groupBy("file").count().agg(F.min("count")).first()[0] > 10
    live = [r for i, r in enumerate(data) if not (3 <= i < 900 and i % 2 == 1)]
    assert found(R.records_of(headers)) == sorted(data + live)


@pytest.mark.parametrize("deleted", [[], [0], list(range(1, 400, 3))[::-1], list(range(0, 300))])
def test_v5_deleted_chain(spark, tmp_path, deleted):
    data = recs(400)
    write(tmp_path, "a.B", pagefiles.v5_file(data, deleted, 512, spare=2))
    assert found(R.read_record_files(spark, str(tmp_path))) == sorted(r for i, r in enumerate(data) if i not in set(deleted))


def test_file_info_and_bad_files(spark, tmp_path):
    write(tmp_path, "good.B", pagefiles.v6_file(recs(40), 512, keys=KEYS, dead_every=3, declared=41))
    write(tmp_path, "old.B", pagefiles.v5_file(recs(40), [5], 512, keys=KEYS))
    write(tmp_path, "var.B", pagefiles.v6_file(recs(10), 512, variable=0xFD))
    write(tmp_path, "short.B", b"FC\0\0")
    write(tmp_path, "magic.B", b"\xff" * 2048)
    write(tmp_path, "page.B", pagefiles.v6_file(recs(4), 512)[:8] + (700).to_bytes(2, "little") + pagefiles.v6_file(recs(4), 512)[10:])
    write(tmp_path, "zero.B", pagefiles._header(True, 512, 0, 2, 0, 1, [], 1) * 2)
    got = {os.path.basename(r.file): r for r in R.record_file_info(spark, str(tmp_path)).collect()}
    good = got["good.B"]
    assert (good.version, good.record_length, good.slot_length, good.declared_records, good.active_records) == (6, 24, 26, 41, 40)
    assert (good.key_count, good.uncovered_bytes, good.record_kind, good.problem) == (2, 14, "fixed", None)
    assert (got["old.B"].version, got["old.B"].active_records) == (5, 39)
    assert got["var.B"].record_kind == "variable_truncated"
    assert got["short.B"].problem == "file is too short"
    assert got["magic.B"].problem == "not a record file"
    assert got["page.B"].problem == "page size is not a multiple of 512"
    assert got["zero.B"].problem == "record length is 0"


@pytest.mark.parametrize("v6", [True, False])
def test_layout_from_keys(spark, tmp_path, v6):
    keys = KEYS if v6 else [KEYS[0], [KEYS[1][0]]]
    data = pagefiles.v6_file(recs(9), 512, keys=keys) if v6 else pagefiles.v5_file(recs(9), [], 512, keys=keys)
    write(tmp_path, "orders.B", data)
    headers = R.read_headers(R.collect_files(spark, str(tmp_path)))
    segs = rows(R.key_segments(headers), "key", "segment", "offset", "length", "native_type", "descending", "duplicates", "null_value")
    want = [(0, 0, 0, 4, 1, False, False, 0), (1, 0, 4, 6, 0, True, True, 32)] + ([(1, 1, 0, 4, 0, False, False, 0)] if v6 else [])
    assert segs == want
    layout = C.to_layout(C.layout_detail(R.derive_layouts(headers)).first())
    assert [(f.num, f.name, f.offset, f.length) for f in layout.fields] == [(1, "K1_SEG1", 0, 4), (2, "K2_SEG1", 4, 6)]
    assert layout.name == "ORDERS" and [k.columns for k in layout.keys][0] == ["K1_SEG1"]
    if v6:
        assert layout.key(2).order == [("K2_SEG1", True), ("K1_SEG1", False)]


def test_layout_texts(spark, tmp_path):
    write(tmp_path, "stock.INT", records.STOCK_TEXT.replace("\n", "\r\n").encode())
    write(tmp_path, "sub/plain.int", b"; no key blocks\nTABLE_NAME  PLAIN\nFIELD_NUMBER 1\nFIELD_NAME A b\nFIELD_INDEX 2\n"
          b"FIELD_NUMBER 2\nFIELD_NAME C\nfield_native_type 1\nFIELD_NATIVE_LENGTH x\nFIELD_INDEX 1\nFIELD_NUMBER 3\nFIELD_NUMBER bad\nFIELD_NAME D\n"
          b"FIELD_NUMBER 4\nFIELD_NAME E\nFIELD_INDEX 2")
    write(tmp_path, "broken.int", b"FIELD_NUMBER 1\nFIELD_NAME A\n")
    cat, skipped = layout_text.read_layouts(spark, str(tmp_path), db="MAIN", schema="dbo")
    assert [os.path.basename(r.file) for r in skipped.collect()] == ["broken.int"]
    t = {r.table_name: r for r in cat.tables.collect()}
    led = t["STOCKMOV"]
    assert (led.schema_name, led.db_name, led.record_length, led.primary_index, led.local_cache, led.declared_fields) == ("dbo", "DEPOT", 41, 0, True, 6)
    assert (t["PLAIN"].db_name, t["PLAIN"].primary_index) == ("MAIN", None)
    layout = C.to_layout(C.layout_detail(cat, "stockmov").first())
    assert len(layout.fields) == 6 and len(layout.keys) == 3
    assert layout.key(1).order == [("ARTICLE", False), ("SITE", False), ("MOVED_ON", True)]
    assert layout.key_length(layout.key(1)) == 14 and layout.key_length(layout.key(2)) == 8
    assert layout.field("MOVED_ON").default == "1970-01-01" and layout.field("MOVE_KEY").index == 1
    assert layout.key(3).segments[0].null_byte == 32 and layout.key(3).unique and not layout.key(2).unique
    plain = C.to_layout(C.layout_detail(cat, "PLAIN").first())
    assert [(f.num, f.name, f.native_type, f.length) for f in plain.fields] == [(1, "A b", 0, 0), (2, "C", 1, 0), (4, "E", 0, 0)]
    assert [(k.num, k.columns) for k in plain.keys] == [(1, ["C"]), (2, ["A b", "E"])]
    findings = {(r.table_name, r.finding) for r in C.validate_layouts(cat, skipped).collect()}
    assert (None, "file does not parse") in findings
    assert {f for t, f in findings if t == "STOCKMOV"} == {"record number key is descending"}


def test_import_directory(spark, tmp_path):
    src, out = tmp_path / "src", str(tmp_path / "out")
    cust = records.customers(spark)
    enc = [bytes(r.rec) for r in encode_records(cust, records.CUST, keep=["recnum"]).orderBy("recnum").select("rec").collect()]
    write(src, "test_vendor.B", pagefiles.v6_file(enc, 512))
    write(src, "other.B", pagefiles.v6_file(recs(30), 512, keys=KEYS))
    write(src, "broken.B", b"x" * 100)
    catalog = importer.catalog_of(spark, [records.CUST])

    dry, _ = importer.import_files(spark, str(src), catalog, out, dry_run=True)
    assert {r.table_name: (r.status, r.records) for r in dry.collect()} == {"TEST_VENDOR": ("ok", 10), "OTHER": ("ok", 30), "BROKEN": ("skipped", 0)}
    assert not os.path.exists(out)

    none, _ = importer.import_files(spark, str(src), catalog, out, create=False, auto_layout=False)
    assert {r.table_name: r.message for r in none.collect()} == {
        "TEST_VENDOR": "table does not exist", "OTHER": "no layout", "BROKEN": "file is too short"}

    report, known = importer.import_files(spark, str(src), catalog, out)
    got = {r.table_name: (r.status, r.records, r.message) for r in report.collect()}
    assert got["TEST_VENDOR"] == ("ok", 10, "") and got["OTHER"] == ("ok", 30, "14 bytes are covered by no key")
    assert rows(known.tables, "table_name") == [("OTHER",), ("TEST_VENDOR",)]
    loaded = spark.read.parquet(f"{out}/TEST_VENDOR").drop("file", "page_no", "slot_no")
    assert rows(loaded) == rows(cust.drop("recnum"))

    again, _ = importer.import_files(spark, str(src), catalog, out, create=False)
    assert {r.table_name: r.records for r in again.collect()}["TEST_VENDOR"] == 10
    assert spark.read.parquet(f"{out}/TEST_VENDOR").count() == 20
    importer.import_files(spark, str(src), catalog, out, truncate=True)
    assert spark.read.parquet(f"{out}/TEST_VENDOR").count() == 10

    known.save(str(tmp_path / "catalog"))
    assert C.table_summary(C.Catalog.load(spark, str(tmp_path / "catalog"))).count() == 2


def test_stream_of_files_equals_batch(spark, tmp_path):
    lay = Layout.build("r", [("id", L.INT, 4), ("flag", L.INT, 1), ("rest", 99, 19)])
    src, out, mark = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "mark")
    data = recs(120)
    write(src, "a.B", pagefiles.v6_file(data[:70], 512))
    import_stream(spark, str(src), lay, out, mark).awaitTermination()
    assert spark.read.parquet(out).count() == 70
    write(src, "b.B", pagefiles.v5_file(data[70:], [3], 512))
    import_stream(spark, str(src), lay, out, mark).awaitTermination()
    batch = decode_records(R.read_record_files(spark, str(src)), lay)
    assert rows(spark.read.parquet(out), "id", "flag", "rest") == rows(batch) and batch.count() == 119


def test_text_output(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", all', None), (2, "two\nlines", " x "), (3, "", "y")], "id int, a string, b string")
    T.export_csv(df.coalesce(1), str(tmp_path / "csv"))
    name = next(f for f in os.listdir(tmp_path / "csv") if f.endswith(".csv"))
    with open(tmp_path / "csv" / name) as f:
        text = f.read()
    assert text == 'id,a,b\n1,"say ""hi"", all",\n2,"two\nlines", x \n3,,y\n'
    assert rows(T.rows_as_text(df.where("id = 1"))) == [('1|say "hi", all|',)]
    df.createOrReplaceTempView("text_rows")
    query = T.QueryText(spark)
    with pytest.raises(ValueError):
        query.run()
    query.set("SELECT id FROM text_rows ORDER BY id")
    assert [r.row_text for r in query.run(limit=2).collect()] == ["1", "2"]


def test_reconcile(spark):
    info = spark.createDataFrame([("a", 3, 4), ("b", 2, 2)], "file string, declared_records long, active_records long")
    done = spark.createDataFrame([("a", 4)], "file string, records long")
    got = {r.file: (r.active_minus_declared, r.loaded_minus_active) for r in D.reconcile(info, done).collect()}
    assert got == {"a": (1, 0), "b": (0, -2)}


def test_create_table(spark):
    assert D.create_table(spark, "C:\\x\\New-Tab.b", [(10, 0), (4, 1), (3, 99)]) == 0
    cols = [(f.name, f.dataType.simpleString()) for f in spark.table("new_tab").schema]
    assert cols == [("recnum", "bigint"), ("col_00", "string"), ("col_01", "int"), ("col_02", "binary")]
    assert D.create_table(spark, "new-tab.b", [], exclusive=True) == 59 and D.create_table(spark, "new-tab.b", []) == 0
    spark.sql("DROP TABLE new_tab")


def test_key_catalog_changes(spark):
    lay = Layout.build("T", [("a", 1, 4), ("b", 0, 6)], [KeySpec((Segment("a"),), 1)])
    cat = importer.catalog_of(spark, [lay])
    ddl = "table_name string, db_name string, source_dir string, segment int, position int, length int, flags int"
    specs = spark.createDataFrame([("T", "", "", 0, 5, 6, 0x50), ("T", "", "", 1, 1, 0, 0), ("T", "", "", 2, 3, 1, 0)], ddl)
    out, report = C.add_key(cat, specs)
    assert rows(report, "status", "num") == [(0, 2)]
    assert rows(out.segments.where("num = 2"), "segment", "field_num", "descending") == [(0, 2, True), (1, 1, False)]
    _, none = C.add_key(cat, specs.where("segment = 2"))
    assert rows(none, "status", "num") == [(6, None)]
    asked = spark.createDataFrame([("T", "", "", 0), ("T", "", "", 5)], "table_name string, db_name string, source_dir string, ordinal int")
    left, report = C.drop_key(out, asked)
    assert rows(left.keys, "num") == [(2,)] and rows(report, "ordinal", "status") == [(0, 0), (5, 6)]


def test_catalog_edits(spark):
    lay = Layout.build("T", [("a", 1, 4), ("b", 0, 6)], [KeySpec((Segment("a"),), 1)])
    cat = importer.catalog_of(spark, [lay, Layout.build("GONE", [("x", 1, 4)])])
    none = (None,) * 8
    row = lambda **kw: tuple(kw.get(c) for c in ("seq", "table_name", "action", "property", "value", "num", "field", "segments"))
    edits = spark.createDataFrame([
        row(seq=1, table_name="t", action="set", property="reclen", value="20"),
        row(seq=2, table_name="T", action="set", property="record_length", value="30"),
        row(seq=3, table_name="T", action="set", property="database", value="NEW"),
        row(seq=4, table_name="T", action="put_field", num=2, field=("b2", 0, 8, 4, None, "d")),
        row(seq=5, table_name="T", action="drop_field", num=1),
        row(seq=6, table_name="T", action="put_key", num=1, segments=[(2, 3, True, 0), (1, 3, False, 0)]),
        row(seq=7, table_name="gone", action="drop_table"),
        row(seq=8, table_name="nobody", action="drop_table"),
        row(seq=9, table_name="T", action="set", property="color", value="x"),
    ], C.EDIT_DDL)
    out, refused = C.apply_layout_edits(cat, edits)
    assert rows(out.tables, "table_name", "db_name", "record_length") == [("T", "NEW", 30)]
    assert rows(out.fields, "db_name", "num", "name", "length", "default_value") == [("NEW", 2, "b2", 8, "d")]
    assert rows(out.segments, "num", "segment", "field_num", "descending") == [(1, 0, 2, True), (1, 1, 1, False)]
    assert rows(refused, "seq") == [(8,), (9,)]


def test_types_and_drift(spark):
    lay = Layout.build("T", [("s", 0, 10), ("l", 10, 6), ("n", 1, 4), ("t", 7, 1), ("d", 3, 4), ("u", 99, 3)])
    cat = importer.catalog_of(spark, [lay])
    types = lambda target: [r.data_type for r in D.expected_columns(cat, target).orderBy("num").collect()]
    assert types("mssql") == ["VARCHAR(10)", "VARCHAR(5)", "INT", "TINYINT", "DATE", "VARBINARY(3)"]
    assert types("postgres") == ["VARCHAR(10)", "VARCHAR(5)", "INT", "SMALLINT", "DATE", "BYTEA"]
    assert types("sqlite") == ["TEXT", "TEXT", "INTEGER", "INTEGER", "TEXT", "BLOB"]
    exported = [r[0] for r in cat.fields.orderBy("num").select(D.export_type()).collect()]
    assert exported == ["VARCHAR(10)", "VARCHAR(6)", "INT", "BIT", "DATE", "VARBINARY(3)"]
    actual = spark.createDataFrame(
        [("t", "S", "varchar(10) COLLATE x"), ("t", "l", "VARCHAR(9)"), ("t", "N", "int"), ("t", "more", "int")],
        "table_name string, column_name string, data_type string")
    got = {r.column_name: r.outcome for r in D.schema_diff(D.expected_columns(cat), actual).collect()}
    assert got == {"s": "matched", "l": "mismatch", "n": "matched", "t": "missing", "d": "missing", "u": "missing", "more": "extra"}
    assert D.schema_diff(D.expected_columns(cat), actual.where("false")).count() == 0
    pg = {r.column_name: r.outcome for r in D.schema_diff(D.expected_columns(cat, "postgres"), spark.createDataFrame(
        [("t", "s", "character varying"), ("t", "n", "integer"), ("t", "t", "smallint")], actual.schema), "postgres").collect()}
    assert (pg["s"], pg["n"], pg["t"]) != ("missing",) * 3 and pg["n"] == pg["t"] == "matched"
    status = D.health(cat, actual).first()
    assert (status.missing, status.extra, status.mismatches, status.status) == (3, 1, 1, "drift")


def test_resolve_tables(spark):
    made = importer.catalog_of(spark, [Layout.build("CUST", [("a", 1, 4)]), Layout.build("A_B", [("a", 1, 4)])])
    cat = C.Catalog(made.tables.withColumn("db_name", F.lit("Sales")), made.fields, made.keys, made.segments)
    config = spark.createDataFrame(
        [("config", "SCHEMA", "dbo"), ("WEST", "DATABASE", "sales"), ("EAST", "DATABASE", "other")], "section string, key string, value string")
    paths = spark.createDataFrame([("G:\\west\\cust.B",), ("G:\\west\\cust.b.B",), ("G:/west/a.b.x",), ("G:\\east\\cust.B",), ("cust.B",)], "path string")
    got = {r.path: (r.table_name, r.schema_name) for r in C.resolve_tables(paths, cat, config).collect()}
    assert got == {
        "G:\\west\\cust.B": ("CUST", "dbo"), "G:\\west\\cust.b.B": ("CUST", "dbo"), "G:/west/a.b.x": ("A_B", "dbo"),
        "G:\\east\\cust.B": (None, None), "cust.B": ("CUST", "dbo"),
    }


def test_files_of_zero_bytes_are_listed(spark, tmp_path):
    (tmp_path / "sub dir").mkdir()
    for name, content in (("A.B", b"x" * 100), ("E.b", b""), ("sub dir/F+1.b", b""), ("sub dir/G 1.b", b"y"), ("other.txt", b"")):
        (tmp_path / name).write_bytes(content)
    got = {os.path.basename(r.file): r.size for r in R.collect_files(spark, str(tmp_path)).collect()}
    assert got == {"A.B": 100, "E.b": 0, "F+1.b": 0, "G 1.b": 1}
    info = {os.path.basename(r.file): r for r in R.record_file_info(spark, str(tmp_path)).collect()}
    assert len(info) == 4 and info["E.b"].size == 0 and all(r.problem for r in info.values())
    assert R.read_record_files(spark, str(tmp_path)).count() == 0


def test_csv_keeps_carriage_returns(spark, tmp_path):
    data = [(1, "a\rb"), (2, "a\r\nb"), (3, "x,\ry"), (4, 'q"\r'), (5, "\r"), (6, None), (7, " plain ")]
    df = spark.createDataFrame(data, "id int, t string")
    T.export_csv(df, str(tmp_path / "csv"))
    reader = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').schema(df.schema)
    back = reader.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(str(tmp_path / "csv"))
    assert sorted((r.id, r.t) for r in back.collect()) == data


def test_stream_batches_do_not_grow_with_files(spark, tmp_path, monkeypatch):
    from suite import files, streams

    monkeypatch.setattr(streams, "customer_files", lambda spark, sf, build: files.customer_files(spark, sf, build, 5))
    monkeypatch.setattr(streams, "scratch_path", lambda spark, name: str(tmp_path / name))
    got = rows(streams.import_stream(spark, DATA), "c_custkey")
    assert got == rows(spark.read.parquet(f"{DATA}/customer.parquet"), "c_custkey")
    loaded = [b for b in os.listdir(tmp_path / "stream-import") if b.startswith("batch=")]
    assert 1 < len(loaded) <= streams.BATCHES < len(got) // 5 // 2


def test_table_of_several_files(spark, monkeypatch):
    from suite import files

    mixed = files._mixed_folder
    monkeypatch.setattr(files, "_mixed_folder", lambda spark, sf: mixed(spark, sf, 40))
    counts = {t: spark.read.parquet(f"{DATA}/{t}.parquet").count() for t in ("customer", "orders", "part")}
    assert counts["customer"] > 40 and counts["orders"] > 400 and counts["part"] > 40
    assert rows(files.imported(spark, DATA), "table_name", "status", "records") == sorted((f"{t.upper()}_0", "ok", n) for t, n in counts.items())


def test_marks_read_no_lines(spark, monkeypatch):
    from suite import catalog

    # nothing may be numbered or written down for a query that asks for the tables only
    def refuse(*args, **kwargs):
        raise AssertionError("written down")

    monkeypatch.setattr(type(spark.range(1)), "checkpoint", refuse)
    marked = catalog.mark(spark, DATA)
    assert "lineitem" not in marked._jdf.queryExecution().executedPlan().toString()
    assert marked.count() == spark.read.parquet(f"{DATA}/orders.parquet").count()


def test_layout_text_is_read_once(spark):
    # odd key lines: other cases and blanks, the last of a key, keys without value, numbers that are none
    text = (
        "table_name  first\nTABLE_NAME\tODD \nSCHEMA_NAME\nDATABASE_SPACE_NAME DEPOT\nLOGICAL_RECORD_LENGTH 12x\nPRIMARY_INDEX 1.5\n"
        "FIELD_NUMBER 1 2\nFIELD_NAME none\nFIELD_NUMBER +3\n  field_name A b \nFIELD_NATIVE_LENGTH 4\nFIELD_NATIVE_LENGTH 8\nFIELD_INDEX 2\n"
        "FIELD_NUMBER 4\nFIELD_NAME C\nFIELD_INDEX 2\nFIELD_DEFAULT_VALUE\nINDEX_NUMBER 1\nINDEX_SEGMENT_FIELD 0\nINDEX_SEGMENT_FLAG 3\n"
    )
    catalog, skipped = layout_text.parse_layouts(spark.createDataFrame([("/d/odd.int", text.replace("\n", "\r\n")), ("/d/none.int", "x")], "file string, value string"))
    assert [r.file for r in skipped.collect()] == ["/d/none.int"]
    table = catalog.tables.first()
    assert (table.table_name, table.schema_name, table.db_name, table.record_length, table.primary_index) == ("ODD", "", "DEPOT", 0, None)
    assert rows(catalog.fields, "source_dir", "num", "name", "length", "field_index", "default_value") == [("/d", 3, "A b", 8, 2, None), ("/d", 4, "C", 0, 2, None)]
    assert rows(catalog.keys, "num", "num_segments") == [(2, 2)]
    assert rows(catalog.segments, "num", "segment", "field_num", "attrs") == [(2, 0, 3, 0), (2, 1, 4, 0)]
    for df in catalog.frames().values():
        assert "regexp_extract" not in df._jdf.queryExecution().executedPlan().toString()
