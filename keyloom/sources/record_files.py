"""Paged record files as frames of records.

Nothing is read on the driver.  Files are listed by Spark, tasks read the header bytes, and
every file is then cut into page chunks that are spread over the cluster, so one huge file
is read by many tasks.  Tasks read byte ranges and split pages into record slots on NumPy
views.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keyloom import layout as L
from keyloom.functions.codec import fixed_binary
from keyloom.operators.catalog import FIELD_DDL, KEY_DDL, SEGMENT_DDL, TABLE_DDL, Catalog, path_parts
from keyloom.plans.lineage import cut
from keyloom.plans.ordering import row_numbers

# Where things lie in a file header and in a page.
_V6_MAGIC = "46430000"
_VERSION_CODE, _PAGE_SIZE, _CHAIN, _KEY_COUNT, _RECORD_LENGTH, _SLOT_LENGTH = 0x06, 0x08, 0x10, 0x14, 0x16, 0x18
_RECORD_COUNT, _PAGE_COUNT, _VARIABLE, _KEY_TABLE, _FLAGS = 0x1A, 0x26, 0x38, 0x78, 0x106
_V5_KEYS, _KEY_ENTRY = 0x110, 0x1E
_SLOTS_AT, _DATA_FLAG_AT, _DATA_FLAG, _USAGE = 6, 5, 0x80, 2
_MAP_PAGE, _MAP_MAGIC, _MAP_ENTRIES_AT, _NO_PAGE = 2, b"PP", 8, 0xFFFFFF
_CHAIN_END = 0xFFFFFFFF

CHUNK_BYTES = 32 << 20
_MAX_SEGMENTS = 119

RECORD_DDL = "file string, page_no int, slot_no int, rec binary"


# -- listing and headers ---------------------------------------------------------------


def collect_files(spark: SparkSession, paths: str | Sequence[str], ext: str = "b", recursive: bool = True) -> DataFrame:
    """Files with the extension (any case) as ``(file, size)``; contents are not read.

    A scan passes over files of zero bytes; they come from the listing that it starts from.
    """
    pattern = "*." + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in ext.lstrip("."))
    listed = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", str(recursive).lower()).load(paths)
    )
    sized = listed.select(F.col("path").alias("file"), F.col("length").alias("size"))
    named = spark.createDataFrame([(f,) for f in sorted(listed.inputFiles())], "named string").select(_plain_path("named").alias("named"))
    empty = named.join(sized.select(_plain_path("file").alias("plain")), F.col("named") == F.col("plain"), "left_anti")
    return sized.union(empty.select(F.col("named").alias("file"), F.lit(0).cast("long").alias("size")))


def _plain_path(path: str) -> Column:
    """One form of a path that Spark writes with one or three slashes behind ``file:``, and with blanks escaped or not."""
    return F.regexp_replace(F.try_url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")


#: Schemes of the cluster's file systems, and how a Python task names the same store.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _open(path: str):
    if path.startswith("file:"):
        return pafs.LocalFileSystem().open_input_file("/" + path[5:].lstrip("/"))
    if path.startswith("dbfs:"):
        return pafs.LocalFileSystem().open_input_file("/dbfs/" + path[5:].lstrip("/"))
    if "://" in path:
        scheme, rest = path.split("://", 1)
        path = f"{_SCHEMES.get(scheme, scheme)}://{rest}"
        system, name = pafs.FileSystem.from_uri(path)
        return system.open_input_file(name)
    return pafs.LocalFileSystem().open_input_file(path)


def _read_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        files, sizes = batch.column("file").to_pylist(), batch.column("size").to_pylist()
        heads = []
        for path, size in zip(files, sizes):
            with _open(path) as f:
                first = f.read_at(min(512, size), 0)
                page = int.from_bytes(first[_PAGE_SIZE : _PAGE_SIZE + 2], "little")
                # both header pages, the first map page's mark, and the key entries
                want = max(3 * page + 16, _V5_KEYS + 2 * _MAX_SEGMENTS * _KEY_ENTRY)
                heads.append(f.read_at(min(want, size), 0))
        yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("size"), pa.array(heads, pa.binary())], ["file", "size", "head"])


def _uint(raw: Column, at: Column | int, n: int, big: bool = False) -> Column:
    """Unsigned integer of ``n`` bytes; bytes past the end read as zero."""
    part = F.rpad(F.substring(raw, F.lit(at) + 1 if isinstance(at, int) else at + 1, F.lit(n)), n, F.expr("X'00'"))
    return F.conv(F.hex(part if big else F.reverse(part)), 16, 10).cast("long")


def read_headers(files: DataFrame) -> DataFrame:
    """One row per file with its header values; ``problem`` tells why a file cannot be read."""
    spread = files.repartition(files.sparkSession.sparkContext.defaultParallelism, "file")
    raw = spread.mapInArrow(_read_heads, "file string, size long, head binary")
    head = F.col("head")
    v6 = F.substring(head, 1, 4) == F.expr(f"X'{_V6_MAGIC}'")
    code = _uint(head, _VERSION_CODE, 2, big=True)
    base = raw.select(
        "file", "size", "head",
        F.when(v6, 6).when(code.between(3, 5), 5).alias("version"), _uint(head, _PAGE_SIZE, 2).cast("int").alias("page_size"),
    )
    # of the two header pages the one with the larger update count is current
    second = (F.col("version") == 6) & (_uint(head, 4, 4) < _uint(head, F.col("page_size") + 4, 4))
    base = base.withColumn("base", F.when(second, F.col("page_size")).otherwise(F.lit(0)))
    at = lambda offset: F.col("base") + offset
    wide = lambda offset: (_uint(head, at(offset), 2) * 65536 + _uint(head, at(offset + 2), 2)).cast("long")
    flags = _uint(head, at(_FLAGS), 2).cast("int")
    variable = _uint(head, at(_VARIABLE), 1)
    out = base.select(
        "file", "size", "head", "version", "page_size", "base",
        _uint(head, at(_RECORD_LENGTH), 2).cast("int").alias("record_length"),
        _uint(head, at(_SLOT_LENGTH), 2).cast("int").alias("slot_length"),
        _uint(head, at(_KEY_COUNT), 2).cast("int").alias("key_count"),
        wide(_RECORD_COUNT).alias("declared_records"), wide(_PAGE_COUNT).alias("pages"), flags.alias("file_flags"),
        F.when((variable != 0) | (flags.bitwiseAND(1) != 0),
               F.when((variable == 0xFD) | (flags.bitwiseAND(2) != 0), "variable_truncated").otherwise("variable"))
        .otherwise("fixed").alias("record_kind"),
        F.when(F.col("version") == 5, _uint(head, _CHAIN, 4)).alias("chain"),
        ((F.col("version") == 6) & (
            (F.substring(head, F.col("page_size") * 2 + 1, F.lit(2)) == F.expr("X'5050'"))
            | (F.substring(head, F.col("page_size") * 3 + 1, F.lit(2)) == F.expr("X'5050'"))
        )).alias("has_map"),
    )
    usage = F.when(F.col("version") == 6, _USAGE).otherwise(0)
    problem = (
        F.when(F.col("size") < 512, "file is too short")
        .when(F.col("version").isNull(), "not a record file")
        .when((F.col("page_size") < 512) | (F.col("page_size") % 512 != 0), "page size is not a multiple of 512")
        .when(F.col("record_length") == 0, "record length is 0")
        .when(F.col("slot_length") < F.col("record_length"), "slot is shorter than the record")
        .when(F.col("record_length") + usage > F.col("slot_length"), "slot has no room for record and usage count")
    )
    return out.withColumn("problem", problem)


# -- chunks ----------------------------------------------------------------------------

_CHUNK_COLUMNS = ["file", "version", "page_size", "record_length", "slot_length", "first_page", "page_count"]


def _chunks(headers: DataFrame) -> DataFrame:
    """Page ranges of about ``CHUNK_BYTES``; header pages are left out."""
    h = headers.where(F.col("problem").isNull())
    per = F.greatest(F.lit(1), F.expr(f"{CHUNK_BYTES} DIV page_size"))
    total = F.expr("size DIV page_size")
    cut_ = h.withColumn("__per", per).withColumn("__total", total).where("__total > 0")
    each = cut_.select("*", F.explode(F.expr("sequence(0L, (__total - 1) DIV __per)")).alias("chunk"))
    first = F.col("chunk") * F.col("__per")
    return each.select(
        *_CHUNK_COLUMNS[:5], "chunk", first.alias("first_page"),
        F.least(F.col("__per"), F.col("__total") - first).cast("int").alias("page_count"), "size",
    )


def _map_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Live data pages of every page map: two copies lie side by side, the newer one counts."""
    for batch in batches:
        out: list[tuple[str, np.ndarray]] = []
        for row in batch.to_pylist():
            size, at = row["page_size"], row["map_page"] * row["page_size"]
            with _open(row["file"]) as f:
                both = f.read_at(2 * size, at)
            copies = [both[:size], both[size:]]
            live = [c for c in copies if len(c) == size and c[:2] == _MAP_MAGIC]
            if not live:
                continue
            newest = max(live, key=lambda c: int.from_bytes(c[4:6], "little"))
            entry = np.frombuffer(newest, np.uint8)[_MAP_ENTRIES_AT:].reshape(-1, 4)[: size // 4 - 2].astype(np.int64)
            physical = (entry[:, 0] << 16) | (entry[:, 3] << 8) | entry[:, 2]
            logical = row["first_logical"] + np.arange(len(entry))
            kept = np.isin(entry[:, 1], (ord("D"), ord("V"))) & (physical != _NO_PAGE) & (logical < row["pages"])
            out.append((row["file"], physical[kept]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([f for f, p in out for _ in range(len(p))], pa.string()),
             pa.array(np.concatenate([p for _, p in out]) if out else np.zeros(0, np.int64))],
            ["file", "page_no"],
        )


def mapped_pages(headers: DataFrame) -> DataFrame:
    """Physical pages that the page maps name as data pages, as ``(file, page_no)``."""
    h = headers.where(F.col("problem").isNull() & (F.col("version") == 6))
    per = F.expr("page_size DIV 4 - 2")
    maps = h.select(
        "file", "page_size", "pages", per.alias("__per"),
        F.explode(F.expr("sequence(0L, GREATEST(pages - 2, 0) DIV (page_size DIV 4 - 2))")).alias("m"),
    ).select(
        "file", "page_size", "pages", (_MAP_PAGE + F.col("m") * F.expr("page_size DIV 4")).alias("map_page"),
        (F.col("m") * F.col("__per") + 1).alias("first_logical"),
    )
    spread = maps.repartition(headers.sparkSession.sparkContext.defaultParallelism, "file", "map_page")
    return spread.mapInArrow(_map_entries, "file string, page_no long").distinct()


# -- scanning --------------------------------------------------------------------------


def _slots(row: dict, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Page numbers, slot numbers and slot bytes of a chunk's live data pages."""
    size, stride = row["page_size"], row["slot_length"]
    count = len(data) // size
    pages = np.frombuffer(data, np.uint8)[: count * size].reshape(count, size)
    numbers = row["first_page"] + np.arange(count)
    live = ((pages[:, _DATA_FLAG_AT] & _DATA_FLAG) != 0) & (numbers >= (2 if row["version"] == 6 else 1))
    if row.get("only") is not None:
        live &= np.isin(numbers, np.asarray(row["only"], np.int64))
    per = (size - _SLOTS_AT) // stride
    pages, numbers = pages[live], numbers[live]
    slots = pages[:, _SLOTS_AT : _SLOTS_AT + per * stride].reshape(len(pages) * per, stride)
    return np.repeat(numbers, per), np.tile(np.arange(per), len(pages)), slots


def _live(row: dict, page: np.ndarray, slot: np.ndarray, slots: np.ndarray) -> np.ndarray:
    if row["version"] == 6:
        return (slots[:, 0] != 0) | (slots[:, 1] != 0)
    gone = row.get("gone")
    if not gone:
        return np.ones(len(slots), bool)
    offset = page * row["page_size"] + _SLOTS_AT + slot * row["slot_length"]
    return ~np.isin(offset, np.asarray(gone, np.int64))


def _chunk_bytes(row: dict) -> bytes:
    with _open(row["file"]) as f:
        return f.read_at(row["page_count"] * row["page_size"], row["first_page"] * row["page_size"])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            page, slot, slots = _slots(row, _chunk_bytes(row))
            kept = _live(row, page, slot, slots)
            lead = _USAGE if row["version"] == 6 else 0
            rec = slots[kept][:, lead : lead + row["record_length"]]
            page, slot = page[kept].astype(np.int32), slot[kept].astype(np.int32)
            step = max(1, (4 << 20) // max(1, row["record_length"]))
            for i in range(0, len(rec), step):
                part = rec[i : i + step]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["file"]] * len(part), pa.string()), pa.array(page[i : i + step]), pa.array(slot[i : i + step]), fixed_binary(part)],
                    ["file", "page_no", "slot_no", "rec"],
                )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        counts = []
        for row in rows:
            page, slot, slots = _slots(row, _chunk_bytes(row))
            counts.append(int(_live(row, page, slot, slots).sum()))
        yield pa.RecordBatch.from_arrays([pa.array([r["file"] for r in rows], pa.string()), pa.array(counts, pa.int64())], ["file", "n"])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slots whose first four bytes may be a link of the deleted chain: a slot's offset or its end."""
    for batch in batches:
        for row in batch.to_pylist():
            page, slot, slots = _slots(row, _chunk_bytes(row))
            at = page * row["page_size"] + _SLOTS_AT + slot * row["slot_length"]
            to = slots[:, :4].copy().view("<u4").ravel().astype(np.int64) if len(slots) else np.zeros(0, np.int64)
            inside = (to % row["page_size"] - _SLOTS_AT) % row["slot_length"] == 0
            may = (inside & (to < row["size"]) & (to > 0)) | (to == 0) | (to == _CHAIN_END)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["file"]] * int(may.sum()), pa.string()), pa.array(at[may]), pa.array(to[may])], ["file", "at", "to"]
            )


def deleted_slots(headers: DataFrame) -> DataFrame:
    """Offsets on the deleted chains of version 5 files, as ``(file, at)``.

    Following a chain link by link is one task's work however long it is.  Here the links
    are doubled: after ``k`` rounds every slot knows the slot ``2^k`` links on, so a chain of
    ``n`` slots is found in ``log n`` joins, and a loop in a damaged chain ends the same way.
    """
    chains = headers.where(
        F.col("problem").isNull() & (F.col("version") == 5) & (F.col("chain") != 0) & (F.col("chain") != _CHAIN_END)
    )
    reach = chains.select("file", F.col("chain").alias("at"))
    if reach.isEmpty():
        return reach
    reach = cut(reach)
    links = _spread(_chunks(chains), chains).mapInArrow(_links, "file string, at long, to long")
    jump = cut(links.where(f"to <> 0 AND to <> {_CHAIN_END}L"))
    known = reach.count()
    while True:
        ahead = reach.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))
        reach = cut(reach.unionByName(ahead).distinct())
        now = reach.count()
        if now == known:
            return reach
        known = now
        onward = jump.select("file", F.col("at").alias("to"), F.col("to").alias("__far"))
        jump = cut(jump.join(onward, ["file", "to"]).select("file", "at", F.col("__far").alias("to")))


def _spread(chunks: DataFrame, headers: DataFrame) -> DataFrame:
    """One chunk per task as far as possible; the number comes from the file sizes."""
    total = headers.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    tasks = max(headers.sparkSession.sparkContext.defaultParallelism, min(100_000, math.ceil(total / CHUNK_BYTES)))
    return chunks.repartition(tasks, "file", "chunk")


def _planned(headers: DataFrame, mode: str) -> DataFrame:
    """Chunks with the pages to keep (``only``) and the slots to drop (``gone``); both are bounded by the chunk."""
    if mode not in ("auto", "raw", "mapped"):
        raise ValueError(f"unknown mode {mode!r}")
    chunks = _chunks(headers).withColumn("only", F.lit(None).cast("array<bigint>")).withColumn("gone", F.lit(None).cast("array<bigint>"))
    per = F.greatest(F.lit(1), F.expr(f"{CHUNK_BYTES} DIV page_size"))
    sizes = headers.select("file", "page_size")
    use_map = {"raw": F.lit(False), "mapped": F.col("version") == 6, "auto": F.col("has_map")}[mode]
    mapped = headers.where(use_map)
    plain_files = headers.where(~F.coalesce(use_map, F.lit(False)))
    plan = chunks.join(plain_files.select("file"), "file", "left_semi")
    if mode != "raw":
        pages = mapped_pages(mapped).join(sizes, "file").select("file", F.expr("page_no").alias("page_no"), (F.col("page_no") / per).cast("long").alias("chunk"))
        wanted = pages.groupBy("file", "chunk").agg(F.collect_list("page_no").alias("__only"))
        by_map = chunks.join(wanted, ["file", "chunk"]).withColumn("only", F.col("__only")).drop("__only")
        plan = plan.unionByName(by_map)
    gone = deleted_slots(headers)
    dropped = gone.join(sizes, "file").select("file", "at", (F.floor(F.col("at") / F.col("page_size")) / per).cast("long").alias("chunk"))
    dropped = dropped.groupBy("file", "chunk").agg(F.collect_list("at").alias("__gone"))
    return plan.join(dropped, ["file", "chunk"], "left").withColumn("gone", F.col("__gone")).drop("__gone")


def records_of(headers: DataFrame, mode: str = "auto", limit_to_declared: bool = False) -> DataFrame:
    """Live records of the files in ``headers``, as ``(file, page_no, slot_no, rec)``."""
    records = _spread(_planned(headers, mode), headers).mapInArrow(_scan, RECORD_DDL)
    if not limit_to_declared:
        return records
    order = [("file", False), ("page_no", False), ("slot_no", False)]
    numbered = row_numbers(records, order, "__n", by=["file"])
    declared = headers.select("file", "declared_records")
    kept = numbered.join(declared, "file").where("declared_records = 0 OR __n <= declared_records")
    return kept.select("file", "page_no", "slot_no", "rec")


def read_record_files(
    spark: SparkSession, paths: str | Sequence[str], recursive: bool = True, mode: str = "auto",
    ext: str = "b", limit_to_declared: bool = False,
) -> DataFrame:
    """Records of all record files under ``paths``; unreadable files are left out (see ``record_file_info``).

    ``raw`` reads every page with the data flag, ``mapped`` only the pages that the page map
    names, ``auto`` uses the map where a file has one.
    """
    headers = cut(read_headers(collect_files(spark, paths, ext, recursive)))
    return records_of(headers, mode, limit_to_declared)


def active_records(headers: DataFrame, mode: str = "auto") -> DataFrame:
    """Number of live records per file; records do not leave the tasks."""
    counts = _spread(_planned(headers, mode), headers).mapInArrow(_count, "file string, n long")
    return counts.groupBy("file").agg(F.sum("n").alias("active_records"))


# -- keys and layouts from headers -----------------------------------------------------


def key_segments(headers: DataFrame) -> DataFrame:
    """Key segments from the headers: ``(file, key, segment, offset, length, native_type, attrs, ...)``."""
    h = headers.where(F.col("problem").isNull() & (F.col("key_count") > 0))
    head = F.col("head")
    each = h.select("*", F.explode(F.expr(f"sequence(0, LEAST(key_count, {_MAX_SEGMENTS}) - 1)")).alias("key"))
    table = F.col("base") + _uint(head, F.col("base") + _KEY_TABLE, 2)
    start = F.when(F.col("version") == 6, F.col("base") + _uint(head, table + F.col("key") * 2, 2)).otherwise(
        F.lit(_V5_KEYS) + F.col("key") * _KEY_ENTRY
    )
    each = each.select("file", "version", "head", "key", start.alias("start"))
    # an entry with the segmented bit is followed by the key's next segment
    last = F.expr(
        f"array_position(transform(sequence(0, {_MAX_SEGMENTS - 1}), s -> "
        "conv(hex(reverse(rpad(substring(head, CAST(start + s * 30 + 9 AS INT), 2), 2, X'00'))), 16, 10) & 16 = 0), true)"
    )
    segs = each.withColumn("__last", last).select(
        "file", "version", "head", "key", F.explode(F.expr("sequence(0, CAST(__last AS INT) - 1)")).alias("segment"), "start"
    ).withColumn("at", F.col("start") + F.col("segment") * _KEY_ENTRY).where(F.octet_length("head") >= F.col("at") + _KEY_ENTRY)
    attrs = _uint(head, F.col("at") + 0x08, 2).cast("int")
    position = _uint(head, F.col("at") + 0x14, 2).cast("int")
    return segs.select(
        "file", "key", "segment",
        F.when(F.col("version") == 6, F.greatest(position - _USAGE, F.lit(0))).otherwise(position).alias("offset"),
        _uint(head, F.col("at") + 0x16, 2).cast("int").alias("length"),
        F.when(attrs.bitwiseAND(L.ATTR_EXTENDED_TYPE) != 0, _uint(head, F.col("at") + 0x1C, 1))
        .when(attrs.bitwiseAND(L.ATTR_OLD_BINARY) != 0, L.AUTOINC).otherwise(L.STRING).cast("int").alias("native_type"),
        attrs.alias("attrs"),
        (attrs.bitwiseAND(L.ATTR_DESCENDING) != 0).alias("descending"),
        (attrs.bitwiseAND(L.ATTR_DUPLICATES) != 0).alias("duplicates"),
        _uint(head, F.col("at") + 0x1D, 1).cast("int").alias("null_value"),
    )


def covered_bytes(segments: DataFrame, by: Sequence[str] = ("file",)) -> DataFrame:
    """Distinct record bytes covered by key segments."""
    bytes_ = segments.where(F.col("length") > 0).select(*by, F.explode(F.expr("sequence(`offset`, `offset` + length - 1)")).alias("byte"))
    return bytes_.groupBy(*by).agg(F.count_distinct("byte").alias("covered_bytes"))


def derive_layouts(headers: DataFrame) -> Catalog:
    """Layouts with the key fields only, named ``K<key>_SEG<segment>``, one per (offset, length)."""
    segs = key_segments(headers)
    stem, _, _ = path_parts("file")
    named = lambda df: df.select(stem.alias("table_name"), F.lit("").alias("db_name"), F.regexp_replace("file", "/[^/]*$", "").alias("source_dir"), "*")
    first = segs.groupBy("file", "offset", "length").agg(
        F.min_by(F.struct("key", "segment", "native_type"), F.struct("key", "segment")).alias("f")
    )
    numbered = row_numbers(
        first.select("file", "offset", "length", "f.*"), [("file", False), ("key", False), ("segment", False)], "num", by=["file"]
    ).withColumn("num", F.col("num").cast("int"))
    fields = numbered.select(
        "file", "num", F.concat(F.lit("K"), F.col("key") + 1, F.lit("_SEG"), F.col("segment") + 1).alias("name"), "native_type",
        "length", "offset", (F.col("key") + 1).alias("field_index"), F.lit(None).cast("string").alias("default_value"),
    )
    parts = segs.join(fields.select("file", "offset", "length", F.col("num").alias("field_num")), ["file", "offset", "length"])
    segments = parts.select("file", (F.col("key") + 1).alias("num"), "segment", "field_num", "attrs", "descending", "null_value")
    keys = segs.groupBy("file", (F.col("key") + 1).alias("num")).agg(F.count(F.lit(1)).cast("int").alias("num_segments"))
    good = headers.where(F.col("problem").isNull())
    schema = headers.sparkSession.createDataFrame([], TABLE_DDL).schema
    known = {"source_file": F.col("file"), "record_length": F.col("record_length"), "page_size": F.col("page_size"),
             "file_flags": F.col("file_flags"), "migrated": F.lit(False), "schema_name": F.lit("")}
    tables = named(good).select(
        *["table_name", "db_name", "source_dir"],
        *[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema if f.name not in ("table_name", "db_name", "source_dir")],
    )
    columns = lambda ddl: [c.split()[0] for c in ddl.split(", ")]
    return Catalog(
        tables, named(fields).select(*columns(FIELD_DDL)), named(keys).select(*columns(KEY_DDL)), named(segments).select(*columns(SEGMENT_DDL))
    )


def record_file_info(spark: SparkSession, paths: str | Sequence[str], recursive: bool = True, mode: str = "auto", ext: str = "b") -> DataFrame:
    """One row per file: header values, declared and active records, and bytes no key covers."""
    headers = cut(read_headers(collect_files(spark, paths, ext, recursive)))
    return info_of(headers, mode)


def info_of(headers: DataFrame, mode: str = "auto") -> DataFrame:
    active = active_records(headers, mode)
    covered = covered_bytes(key_segments(headers))
    out = headers.join(active, "file", "left").join(covered, "file", "left")
    good = F.col("problem").isNull()
    return out.select(
        "file", "size", "version", "page_size", "record_length", "slot_length", "key_count", "declared_records",
        F.when(good, F.coalesce("active_records", F.lit(0))).alias("active_records"), "pages", "record_kind",
        F.when(good, F.col("record_length") - F.coalesce("covered_bytes", F.lit(0))).alias("uncovered_bytes"), "problem",
    )
