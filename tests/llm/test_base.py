from __future__ import annotations

import weakref

import psutil
import public_tokenizers
import pyarrow as pa
import pytest

from tallyhouse.llm import base, pieces, quality


class Direct:
    """Stands for a table; gives the mapped function itself."""

    sparkSession = None

    def mapInArrow(self, run, schema):
        return run


def test_a_task_hands_its_memory_back(monkeypatch):
    if pa.default_memory_pool().backend_name == "system":
        pytest.skip("needs a pool of its own")
    monkeypatch.setattr(base, "ship", lambda spark: None)
    pins = []

    def make():
        def work(batch):
            junk = [bytes(1000) for _ in range(150_000)]
            pins.append(junk[-1])  # what stays at the end keeps the rest from shrinking by itself
            return {"id": batch.column("id")}

        return work

    run = base.map_batches(Direct(), "id long", make)
    before = psutil.Process().memory_info().rss
    assert [b.num_rows for b in run(iter([pa.record_batch({"id": [1, 2]})]))] == [2]
    assert psutil.Process().memory_info().rss - before < 60 << 20
    assert list(run(iter([]))) == []


def test_what_a_task_kept_goes_when_other_work_comes(monkeypatch):
    monkeypatch.setattr(base, "ship", lambda spark: None)
    made = []

    class Large:
        def __init__(self):
            made.append(weakref.ref(self))

    def keeping():
        held = base.kept("large", Large)
        return lambda batch: {"id": batch.column("id"), "held": held and batch.column("id")}

    rows = pa.record_batch({"id": [1, 2]})
    keeps = base.map_batches(Direct(), "id long", keeping)
    other = base.map_batches(Direct(), "id long", lambda: lambda batch: {"id": batch.column("id")})
    for _ in range(2):
        assert [b.num_rows for b in keeps(iter([rows]))] == [2]
    assert len(made) == 1 and made[0]() is not None
    assert [b.num_rows for b in other(iter([rows]))] == [2]
    assert made[0]() is None
    list(keeps(iter([rows])))
    assert len(made) == 2 and made[1]() is not None
    base.let_go()
    assert made[1]() is None


def test_quality_tasks_let_go_of_what_others_kept(monkeypatch):
    """The pipeline's first stage starts in workers that its last one may have used."""
    base.kept("large", lambda: bytearray(10))
    quality._done(pa.table({"id": [1]}))
    assert "large" not in base._kept
    monkeypatch.setattr(quality.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    base.kept("large", lambda: bytearray(10))
    rows = pa.record_batch({"fold": pa.array([0], pa.int32()), "lang": ["en"], "text": ["some words"]})
    assert sum(b.num_rows for b in quality._counted(Direct())(iter([rows]))) > 0
    assert "large" not in base._kept


def test_coders_are_kept_by_the_worker():
    first = pieces.coder(public_tokenizers.path(pieces.MODEL))
    assert pieces.coder(public_tokenizers.path(pieces.MODEL)) is first
    base.let_go()
    assert pieces.coder(public_tokenizers.path(pieces.MODEL)) is not first
    base.let_go()
