"""A worker of the corpus operators keeps no free memory between tasks."""

import re
from pathlib import Path

import numpy as np
import pyarrow as pa

from keyloom.llm import common


def held() -> int:
    return int(re.search(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) // 1024


def test_free_memory_goes_back(spark):
    def run(batches):
        for batch in batches:
            kept = [np.ones(12_000) for _ in range(3000)]  # 288 MB in pieces that malloc does not map by themselves
            last = np.ones(10)
            del kept
            yield pa.RecordBatch.from_arrays([pa.array([held()] * len(batch) if len(last) else [], pa.int64())], names=["mb"])

    batch = pa.RecordBatch.from_arrays([pa.array([1])], names=["id"])
    before = held()
    assert len(list(common.giving_back(run)(iter([batch])))) == 1
    assert held() < before + 150
    assert common.in_batches(spark.range(3).coalesce(1), run, "mb long").count() == 3


def test_memory_goes_back_when_a_task_stops_early(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    task = common.giving_back(lambda batches: batches)(iter([1, 2]))
    assert next(task) == 1 and not calls
    task.close()
    assert calls == [1]
