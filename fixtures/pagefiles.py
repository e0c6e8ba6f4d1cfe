"""Write paged record files from encoded records.

``file_bytes`` builds one file; ``write_files`` is the Spark job that writes many from a
frame of records, one bounded file per task step.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from keyloom.plans.ordering import row_numbers

RECORDS_PER_FILE = 20_000


def _keys_block(keys, v6: bool) -> list[tuple[bytes, bool]]:
    entries = []
    for segments in keys:
        for i, (offset, length, kind, attrs, null_byte) in enumerate(segments):
            kd = bytearray(0x1E)
            attrs |= 0x10 if i + 1 < len(segments) else 0
            struct.pack_into("<H", kd, 0x8, attrs)
            struct.pack_into("<H", kd, 0x14, offset + (2 if v6 else 0))
            struct.pack_into("<H", kd, 0x16, length)
            kd[0x1C], kd[0x1D] = kind, null_byte
            entries.append((bytes(kd), i == 0))
    return entries


def _header(v6, page_size, length, stride, declared, pages, keys, update_count, chain=0, flags=0, variable=0) -> bytes:
    h = bytearray(page_size)
    if v6:
        h[0:4] = b"FC\0\0"
        struct.pack_into("<I", h, 4, update_count)
    else:
        struct.pack_into(">H", h, 6, 4)
        struct.pack_into("<I", h, 0x10, chain)
    struct.pack_into("<H", h, 8, page_size)
    struct.pack_into("<HHH", h, 0x14, len(keys), length, stride)
    struct.pack_into("<HH", h, 0x1A, declared >> 16, declared & 0xFFFF)
    struct.pack_into("<HH", h, 0x26, pages >> 16, pages & 0xFFFF)
    h[0x38] = variable
    struct.pack_into("<H", h, 0x106, flags)
    entries = _keys_block(keys, v6)
    if v6:
        struct.pack_into("<H", h, 0x78, 0x108)
        at, number = 0x108 + 2 * len(keys), 0
        for raw, first in entries:
            if first:
                struct.pack_into("<H", h, 0x108 + 2 * number, at)
                number += 1
            h[at : at + 0x1E] = raw
            at += 0x1E
    else:
        for i, (raw, _) in enumerate(entries):
            h[0x110 + i * 0x1E : 0x110 + (i + 1) * 0x1E] = raw
    return bytes(h)


def v6_file(
    records: Sequence[bytes], page_size: int = 4096, keys=(), dead_every: int = 0, stale: bool = False, declared: int | None = None,
    newer_map_second: bool = False, variable: int = 0,
) -> bytes:
    """Version 6: two header pages, page maps in pairs, data pages; ``stale`` adds shadow pages no map names."""
    length = len(records[0])
    stride = length + 2
    per, slots = (page_size - 6) // stride, []
    for i, r in enumerate(records):
        if dead_every and i % dead_every == 0:
            slots.append(b"\0\0" + b"\xee" * length)
        slots.append(b"\1\0" + r)
    data = []
    for i in range(0, len(slots), per):
        body = b"".join(slots[i : i + per])
        data.append((b"D\0" + struct.pack("<H", len(data) + 1) + b"\0\x80" + body).ljust(page_size, b"\0"))
    maps_per, span = page_size // 4 - 2, page_size // 4
    pages: dict[int, bytes] = {}
    reserved = lambda p: p < 2 or (p - 2) % span < 2
    places, at = [], 2
    for page in data:
        while reserved(at):
            at += 1
        if stale:
            pages[at] = page[:6] + b"\1\0" + b"\xdd" * length + page[6 + stride :]
            at += 1
            while reserved(at):
                at += 1
        pages[at] = page
        places.append(at)
        at += 1
    for m in range(0, max(1, -(-len(places) // maps_per))):
        good, old = bytearray(page_size), bytearray(page_size)
        for copy, usage in ((good, 9), (old, 3)):
            copy[0:2] = b"PP"
            struct.pack_into("<H", copy, 4, usage)
            for lp in range(maps_per):
                copy[8 + lp * 4 : 12 + lp * 4] = b"\xff\0\xff\xff"
        for lp, place in enumerate(places[m * maps_per : (m + 1) * maps_per]):
            entry = bytes([place >> 16, ord("D"), place & 0xFF, (place >> 8) & 0xFF])
            good[8 + lp * 4 : 12 + lp * 4] = entry
            wrong = place - 1 if stale else 0xFFFFFF
            old[8 + lp * 4 : 12 + lp * 4] = bytes([wrong >> 16, ord("D"), wrong & 0xFF, (wrong >> 8) & 0xFF])
        pair = (old, good) if newer_map_second else (good, old)
        pages[2 + m * span], pages[3 + m * span] = bytes(pair[0]), bytes(pair[1])
    count = max(pages) + 1
    declared = len(records) if declared is None else declared
    head = lambda uc, n: _header(True, page_size, length, stride, n, len(places) + 1, keys, uc, variable=variable)
    pages[0], pages[1] = head(5, declared), head(4, 1)
    return b"".join(pages.get(p, bytes(page_size)) for p in range(count))


def v5_file(records: Sequence[bytes], deleted: Sequence[int] = (), page_size: int = 4096, keys=(), spare: int = 0) -> bytes:
    """Version 5: slots without usage counts; the slots ``deleted`` form the deleted chain in the given order."""
    length = len(records[0])
    stride = length + spare
    per = (page_size - 6) // stride
    offset = lambda i: (1 + i // per) * page_size + 6 + (i % per) * stride
    slots = [r.ljust(stride, b"\0") for r in records]
    slots += [None] * (-len(slots) % per)
    chain = list(deleted) + [i for i, s in enumerate(slots) if s is None]
    for n, i in enumerate(chain):
        link = offset(chain[n + 1]) if n + 1 < len(chain) else 0xFFFFFFFF
        slots[i] = struct.pack("<I", link) + b"\0" * (stride - 4)
    out = []
    for i in range(0, len(slots), per):
        out.append((b"\0\0\0\0\0\x80" + b"".join(slots[i : i + per])).ljust(page_size, b"\0"))
    live = len(records) - len(deleted)
    head = _header(False, page_size, length, stride, live, len(out) + 1, keys, 0, chain=offset(chain[0]) if chain else 0)
    return head + b"".join(out)


def _writer(folder: str, name: str, build, one_name: bool):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))
        current, held, done = None, [], []

        def close():
            if held:
                data = build(held)
                path = f"{base}/{current}/{name}_0.B" if one_name else f"{base}/{name}_{current}.B"
                if one_name:
                    system.create_dir(f"{base}/{current}", recursive=True)
                with system.open_output_stream(path) as f:
                    f.write(data)
                done.append((current, len(held)))

        for batch in batches:
            for n, rec in zip(batch.column("file_no").to_pylist(), batch.column("rec").to_pylist()):
                if n != current:
                    close()
                    current, held = n, []
                held.append(rec)
        close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([n for n, _ in done], pa.int64()), pa.array([c for _, c in done], pa.int64())], ["file_no", "records"]
        )

    return write


def write_files(df: DataFrame, order: str, folder: str, name: str, build, per_file: int = RECORDS_PER_FILE, one_name: bool = False) -> int:
    """Write ``rec`` of every row in ``order`` to files of at most ``per_file`` records; returns the file count.

    Files are numbered by name, or by folder with ``one_name``: then all of them are files of one table.
    """
    numbered = row_numbers(df.select(order, "rec"), [(order, False)], "__n")
    placed = numbered.select(F.expr(f"(__n - 1) DIV {per_file}").alias("file_no"), "__n", "rec")
    sorted_ = placed.repartition("file_no").sortWithinPartitions("file_no", "__n").select("file_no", "rec")
    return sorted_.mapInArrow(_writer(folder, name, build, one_name), "file_no long, records long").count()
