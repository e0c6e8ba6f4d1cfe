"""Small keyed-record tables with known answers."""

from __future__ import annotations

import datetime as dt

from keyloom import layout as L
from keyloom.layout import KeySpec, Layout

CUST = Layout.build(
    "TEST_VENDOR",
    [("VENDOR", L.STRING, 8), ("TITLE", L.STRING, 24), ("TOWN", L.STRING, 12), ("AREA", L.STRING, 2),
     ("CREDIT", L.DECIMAL, 8), ("OPEN", L.LOGICAL, 1), ("SINCE", L.DATE, 4)],
    [KeySpec.of("VENDOR", num=1, duplicates=False), KeySpec.of("TITLE", num=2)],
)
CUST_ROWS = [
    ("V-101", "Tinplate Union", "Gouda", "ZH", 4400, True, "2019-02-03"),
    ("V-102", "Quill and Vane", "Bergen", "NO", 981, True, "2019-05-28"),
    ("V-103", "Orchard Pumps", "Ghent", "OV", 70125, False, "2020-11-09"),
    ("V-104", "Marl Brothers", "Lund", "SK", 0, True, "2020-12-31"),
    ("V-105", "Osier Baskets", "Vaasa", "FI", 66, True, "2021-06-17"),
    ("V-106", "Quill and Vane", "Turku", "FI", 120003, False, "2021-07-01"),
    ("V-107", "Lantern Supply", "Aarhus", "DK", 5550, True, "2022-03-22"),
    ("V-108", "Copperwell", "Leuven", "VB", 31, True, "2022-08-14"),
    ("V-109", "Saltmarsh Ropes", "Emden", "NI", 908070, False, "2023-01-05"),
    ("V-110", "Thimble Works", "Delft", "ZH", 12, True, "2023-10-10"),
]

#: A key of three segments, and a descending one.
MULTI = Layout.build(
    "TEST_SHELF", [("HALL", 0, 4), ("RACK", 0, 4), ("BIN", 0, 6), ("WEIGHT", 1, 4)],
    [KeySpec.of("HALL", "RACK", "BIN", num=1, duplicates=False), KeySpec.of("-WEIGHT", num=2)],
)
MULTI_ROWS = [
    ("OAK", "R2", "b1", 31), ("ASH", "R1", "b2", 77), ("OAK", "R1", "b1", 12), ("ELM", "R1", "b1", 58), ("ASH", "R1", "b1", 90),
    ("ELM", "R2", "b3", 5), ("ASH", "R3", "b1", 64), ("OAK", "R1", "b2", 83), ("ELM", "R1", "b2", 46),
]

DESC = Layout.build("TEST_SCORE", [("SCORE", 1, 4), ("LABEL", 0, 8)], [KeySpec.of("-SCORE")])
DESC_ROWS = [(14, "n"), (3, "c"), (27, "z"), (9, "i"), (21, "u")]

#: A layout text with defaults, a descending segment, a null byte and a unique key.
STOCK_TEXT = """DRIVER_NAME SQL_DRV
TABLE_NAME STOCKMOV
SCHEMA_NAME
DATABASE_SPACE_NAME DEPOT
LOGICAL_RECORD_LENGTH 41
NUMBER_DF_FIELDS 6
PRIMARY_INDEX 0
LOCAL_CACHE YES

FIELD_NUMBER 1
FIELD_NAME MOVE_KEY
FIELD_NATIVE_TYPE 0
FIELD_NATIVE_LENGTH 14
FIELD_NATIVE_OFFSET 0
FIELD_INDEX 1
FIELD_NUMBER 2
FIELD_NAME ARTICLE
FIELD_NATIVE_TYPE 0
FIELD_NATIVE_LENGTH 8
FIELD_NATIVE_OFFSET 0
FIELD_NUMBER 3
FIELD_NAME SITE
FIELD_NATIVE_TYPE 0
FIELD_NATIVE_LENGTH 2
FIELD_NATIVE_OFFSET 8
FIELD_NUMBER 4
FIELD_NAME MOVED_ON
FIELD_NATIVE_TYPE 3
FIELD_NATIVE_LENGTH 4
FIELD_NATIVE_OFFSET 10
FIELD_DEFAULT_VALUE 1970-01-01
FIELD_NUMBER 5
FIELD_NAME REMARK
FIELD_NATIVE_TYPE 0
FIELD_NATIVE_LENGTH 23
FIELD_NATIVE_OFFSET 14
FIELD_NUMBER 6
FIELD_NAME COUNTER
FIELD_NATIVE_TYPE 1
FIELD_NATIVE_LENGTH 4
FIELD_NATIVE_OFFSET 37
INDEX_NUMBER 1
INDEX_NUMBER_SEGMENTS 4
INDEX_SEGMENT_FIELD 2
INDEX_SEGMENT_FLAG 19
INDEX_SEGMENT_FIELD 3
INDEX_SEGMENT_FLAG 19
INDEX_SEGMENT_FIELD 4
INDEX_SEGMENT_DIRECTION DESCENDING
INDEX_SEGMENT_FLAG 3
INDEX_SEGMENT_FIELD 0
INDEX_SEGMENT_FLAG -1
INDEX_NUMBER 2
INDEX_NUMBER_SEGMENTS 2
INDEX_SEGMENT_FIELD 2
INDEX_SEGMENT_FLAG 3
INDEX_SEGMENT_FIELD 0
INDEX_SEGMENT_FLAG -1
INDEX_NUMBER 3
INDEX_NUMBER_SEGMENTS 1
INDEX_SEGMENT_FIELD 6
INDEX_SEGMENT_NULL_VALUE 32
INDEX_SEGMENT_FLAG 2
"""


def customers(spark):
    rows = [(i, *r[:6], dt.date.fromisoformat(r[6])) for i, r in enumerate(CUST_ROWS, 1)]
    return spark.createDataFrame(rows, "recnum long, VENDOR string, TITLE string, TOWN string, AREA string, CREDIT long, OPEN boolean, SINCE date")


def multi(spark):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(MULTI_ROWS, 1)], "recnum long, HALL string, RACK string, BIN string, WEIGHT int")


def ranked(spark):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(DESC_ROWS, 1)], "recnum long, SCORE int, LABEL string")
