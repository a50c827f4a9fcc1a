"""Atomic commits, levels of merged state, and bounded runs."""

import pytest
from pyspark.sql import functions as F

from rollcall.constants import ANCHOR_BLOCK
from rollcall.session import fresh_path
from rollcall.sources import logs
from rollcall.streaming import ingest
from test_ingest import frame, registered, state_of, stream  # noqa: F401


def take(spark, store, batch_id, *blocks):
    """One batch with a log in each of these blocks above the anchor, all confirmed."""
    rows = [registered(n, f"u{n}", block=ANCHOR_BLOCK + n) for n in blocks]
    ingest.ingest_batch(frame(spark, rows), batch_id, store, ingest.Settings(),
                        tip=ANCHOR_BLOCK + max(blocks) + 50)


def test_nothing_shows_before_the_commit(spark, stream, monkeypatch):
    store = stream.store
    take(spark, store, 0, 1, 2)
    before = state_of(spark, store)
    monkeypatch.setattr(ingest.Commits, "add", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        take(spark, store, 1, 60, 70)
    # Events, changes and waiting logs are written, the commit is not.
    assert spark.read.parquet(store.events).where("batch_id = 1").count() == 2
    assert ingest.stored_events(spark, store).count() == 2
    assert state_of(spark, store) == before
    assert ingest.cursor(spark, store).first().last_block == ANCHOR_BLOCK + 2
    assert tuple(ingest.last_run(spark, store).first()) == ("error", "division by zero")
    monkeypatch.undo()
    take(spark, store, 1, 60)
    assert sorted(r.agent_id for r in ingest.stored_events(spark, store).collect()) == \
        ["1", "2", "60"]
    assert [r[0] for r in state_of(spark, store)] == ["1", "2", "60"]
    assert spark.read.parquet(store.events).where("batch_id = 1").count() == 3


def test_a_second_run_cannot_commit_the_same_batch(spark, stream, monkeypatch):
    store = stream.store
    take_in = ingest._take_in

    def overtaken(*args):
        row = take_in(*args)
        monkeypatch.undo()
        take(spark, store, 0, 1)
        return row
    monkeypatch.setattr(ingest, "_take_in", overtaken)
    with pytest.raises(RuntimeError, match="another run has committed batch 0"):
        take(spark, store, 0, 1, 2, 3)
    assert [r.agent_id for r in ingest.stored_events(spark, store).collect()] == ["1"]
    assert ingest.read_progress(spark, store).count() == 1


def test_only_late_blocks_look_for_stored_events(spark, stream, monkeypatch):
    store = stream.store
    looked = []
    committed = ingest.committed_events
    monkeypatch.setattr(ingest, "committed_events", lambda *a: (looked.append(a[2:]),
                                                                committed(*a))[1])
    for k in range(4):
        take(spark, store, k, 100 * k + 1, 100 * k + 2)
    assert looked == []
    known = frame(spark, [registered(n, "late", block=ANCHOR_BLOCK + 101) for n in (500, 501)])
    known = known.unionByName(known).cache()
    for k in (4, 5):
        ingest.ingest_batch(known, k, store, ingest.Settings())
    assert looked == [(ANCHOR_BLOCK + 101, ANCHOR_BLOCK + 101)] * 2
    assert ingest.stored_events(spark, store).where("agent_uri = 'late'").count() == 2


def test_levels(spark, stream, monkeypatch):
    """The runs that hold the state follow the digits of the number of batches."""
    store = stream.store
    for k in range(7):
        take(spark, store, k, *range(100 * k, 100 * k + 5))
    names = [p.rsplit("/", 1)[1] for p in ingest._partial_states(spark, store)]
    assert names == ["batch=6", "version=5", "version=3"]
    assert len(state_of(spark, store)) == 35
    # A batch that died before it could merge leaves its parts, which are read instead.
    monkeypatch.setattr(ingest, "merge_states", lambda *a: None)
    take(spark, store, 7, 701)
    names = [p.rsplit("/", 1)[1] for p in ingest._partial_states(spark, store)]
    assert sorted(names) == ["batch=6", "batch=7", "version=3", "version=5"]
    monkeypatch.undo()
    ingest.merge_states(spark, store, 7)
    assert [p.rsplit("/", 1)[1] for p in ingest._partial_states(spark, store)] == ["version=7"]
    assert len(state_of(spark, store)) == 36


def test_a_look_at_few_agents_opens_their_buckets(spark, stream):
    store = stream.store
    for k in range(2):
        take(spark, store, k, *range(60 * k, 60 * k + 50))
    whole = ingest.stored_agents(spark, store)
    few = ingest.stored_agents(spark, store, ["7", "70", "no such"])
    assert sorted(r.agent_id for r in few.collect()) == ["7", "70"]
    assert few.where("agent_id = '7'").collect() == whole.where("agent_id = '7'").collect()
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan.replace("isnotnull(bucket#", "") or \
        "bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "In(agent_id" in plan


@pytest.fixture
def stored(spark):
    path = fresh_path(spark, "test-stored")
    rows = [registered(n, f"u{n}", block=ANCHOR_BLOCK + n) for n in range(0, 400, 10)]
    odd = registered(9, "x")[:3] + ("0xzz",) + registered(9, "x")[4:]
    logs.write_logs(frame(spark, rows + [odd]), path, 40)
    return path


def test_bounded_runs(spark, stream, stored):
    store = stream.store
    run = lambda **k: ingest.run_blocks(spark, stored, store, chunk=60, **k)
    through = lambda: ingest.cursor(spark, store).first().last_block - ANCHOR_BLOCK
    assert run(max_blocks=150) == "max blocks" and through() == 149
    assert [r[0] for r in ingest.read_progress(spark, store).orderBy("batch_id")
            .select(F.col("last_block") - ANCHOR_BLOCK).collect()] == [59, 119, 149]
    assert run(max_seconds=0) == "max seconds" and through() == 149
    assert run(max_blocks=1) == "max blocks" and through() == 150
    assert run() == "confirmed" and through() == 340
    assert run() == "confirmed" and through() == 340
    assert {int(r[0]) for r in state_of(spark, store)} == set(range(0, 341, 10))
    # New logs move the tip, and the next run goes on behind the last block.
    logs.write_logs(frame(spark, [registered(500, "n", block=ANCHOR_BLOCK + 500)]), stored, 40)
    assert run() == "confirmed" and through() == 450
    assert len(state_of(spark, store)) == 40
    assert ingest.cursor(spark, store).first().events_ingested == 40


def test_a_killed_run_is_continued(spark, stream, stored, monkeypatch):
    store = stream.store
    merge, seen = ingest.merge_states, []

    def dies(*args):
        seen.append(args[2])
        return 1 / 0 if args[2] == 2 else merge(*args)
    monkeypatch.setattr(ingest, "merge_states", dies)
    with pytest.raises(Exception):
        ingest.run_blocks(spark, stored, store, chunk=60)
    # Batch 2 is committed, but the stream does not know and brings it again.
    monkeypatch.undo()
    assert ingest.run_blocks(spark, stored, store, chunk=60) == "confirmed"
    assert {int(r[0]) for r in state_of(spark, store)} == set(range(0, 341, 10))
    assert ingest.cursor(spark, store).first().events_ingested == 35


def test_no_logs(spark, stream):
    path = fresh_path(spark, "test-none")
    logs.write_logs(frame(spark, []), path, 40)
    assert ingest.run_blocks(spark, path, stream.store) == "confirmed"
    assert state_of(spark, stream.store) == []
