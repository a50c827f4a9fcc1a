"""Decoding faults, state rules, replay and confirmation lag of the stream."""

import itertools

import pytest
from pyspark.sql import functions as F

from rollcall.constants import ANCHOR_BLOCK, ANCHOR_EPOCH_SECONDS, EVENT_TOPICS, \
    TOPIC_METADATA_UPDATE, ZERO_ADDRESS
from rollcall.operators import blocktime
from rollcall.operators.decode import decode_logs, lenient_string
from rollcall.operators.state import current_state
from rollcall.schemas import RAW_LOGS
from rollcall.session import fresh_path
from rollcall.sources import logs, tables
from rollcall.streaming import ingest

OWNER = "0x" + "00" * 12 + "aB" * 20


def word(n):
    return f"{n:064x}"


def abi_text(*values):
    head, tail, at = "", "", 32 * len(values)
    for v in values:
        raw = v if isinstance(v, bytes) else v.encode()
        body = word(len(raw)) + raw.hex() + "00" * (-len(raw) % 32)
        head, tail, at = head + word(at), tail + body, at + len(body) // 2
    return "0x" + head + tail


serial = itertools.count()


def log(kind, topics, data="0x", block=ANCHOR_BLOCK, index=None):
    n = next(serial)
    return ("0xreg", [EVENT_TOPICS.get(kind, kind), *topics], data, hex(block), f"0xTX{n}",
            hex(n if index is None else index))


def frame(spark, rows):
    return spark.createDataFrame(rows, RAW_LOGS)


def registered(agent, uri, **kw):
    return log("Registered", ["0x" + word(agent), OWNER], abi_text(uri), **kw)


def test_each_event(spark):
    rows = [
        registered(7, "https://a"),
        log("URIUpdated", ["0x" + word(2 ** 200), OWNER], abi_text("ü\0x")),
        log("Transfer", ["0x" + word(0), OWNER, "0x" + word(7)]),
        log("MetadataSet", ["0x" + word(7), "0x1"], abi_text("k", b"\x01\x02")),
        log("MetadataSet", ["0x" + word(7), "0x1"], abi_text("k", "plain")),
        log("0x" + "ee" * 32, ["0x1"]),
        registered(8, "cut off text")[:2] + (abi_text("cut off text")[:-60],) + ("0x1", "a", "0x0"),
        log("Registered", ["0x" + word(9)], abi_text("x")),
        log("Registered", ["0x" + word(9), OWNER], "0x12zz"),
        ("0xreg", None, None, "0x1", "b", "0x0"),
    ]
    got = decode_logs(frame(spark, rows)).collect()
    address = "0x" + "ab" * 20
    pick = lambda r: (r.event_type, r.agent_id, r.owner, r.agent_uri, r.metadata_value,
                      r.sanitized)
    assert [pick(r) for r in got] == [
        ("Registered", "7", address, "https://a", None, False),
        ("URIUpdated", str(2 ** 200), address, "üx", None, True),
        ("Transfer", "7", address, None, None, False),
        ("MetadataSet", "7", None, None, "0x0102", False),
        ("MetadataSet", "7", None, None, "plain", False),
        ("unknown", None, None, None, None, False),
        ("unknown", "8", address, None, None, False),
        ("unknown", "9", None, None, None, False),
        ("unknown", "9", address, None, None, False),
        ("unknown", None, None, None, None, False),
    ]
    assert got[2].from_address == ZERO_ADDRESS
    assert all((r.decode_error is None) == (r.event_type != "unknown") for r in got)


def test_lenient_strings(one):
    whole = abi_text("hello")
    assert one("d string", [whole, whole[:136], "0x" + "00" * 63, None, "0xzz"],
               lenient_string(F.col("d"))) == ["hello", "hel", "", "", ""]


def test_predicted_times(one):
    assert one("b bigint", [ANCHOR_BLOCK, ANCHOR_BLOCK + 1],
               blocktime.predicted_seconds(F.col("b"))) == [
        ANCHOR_EPOCH_SECONDS, ANCHOR_EPOCH_SECONDS + 2]


EVENTS = """event_type string, agent_id string, block_number bigint, log_index int,
    block_time timestamp, tx_hash string, owner string, from_address string, agent_uri string"""


def test_state_rules(spark):
    def event(kind, agent, block, index, owner=None, sender=None, uri=None):
        return kind, agent, block, index, None, f"t{block}-{index}", owner, sender, uri

    rows = [
        event("Registered", "1", 5, 1, "late", uri="u-late"),
        event("Registered", "1", 5, 0, "first", uri="u-first"),
        event("Transfer", "1", 5, 2, "mint", ZERO_ADDRESS),
        event("Transfer", "1", 9, 0, "buyer", "seller"),
        event("Transfer", "1", 8, 0, "other", None),
        event("URIUpdated", "1", 5, 9, uri="u-new"),
        event("Transfer", "2", 6, 0, "x", "y"),
        event("Registered", "3", 7, 0, "o3"),
    ]
    for order in (rows, rows[::-1]):
        state = {r.agent_id: r for r in current_state(spark.createDataFrame(order, EVENTS))
                 .collect()}
        assert set(state) == {"1", "3"}
        a = state["1"]
        assert (a.owner, a.minted_to, a.transfer_count, a.registered_tx, a.uri_at_registration,
                a.current_uri, a.current_uri_log_index, a.uri_change_count) == (
            "buyer", "first", 1, "t5-0", "u-first", "u-new", 9, 1)
        assert (state["3"].owner, state["3"].current_uri) == ("o3", "")


@pytest.fixture
def stream(spark):
    source = fresh_path(spark, "test-logs")
    store = ingest.Store(fresh_path(spark, "test-store"), range_blocks=40, merge_every=2)

    def feed(rows):
        frame(spark, rows).coalesce(1).write.mode("append").parquet(source)
        ingest.start_ingest(spark, source, store).awaitTermination()
    feed.store = store
    return feed


def state_of(spark, store):
    return sorted(tuple(r) for r in ingest.stored_agents(spark, store).collect())


def test_replay_changes_nothing(spark, stream):
    rows = [registered(i, f"https://{i}", block=ANCHOR_BLOCK + i) for i in range(20)]
    ahead = [registered(99, "later", block=ANCHOR_BLOCK + 500)]
    stream(rows + ahead)
    before = state_of(spark, stream.store)
    assert len(before) == 20
    stream(rows)
    assert state_of(spark, stream.store) == before
    progress = ingest.read_progress(spark, stream.store).orderBy("batch_id").collect()
    assert [(p.events, p.inserted) for p in progress] == [(20, 20), (20, 0)]
    assert ingest.stored_events(spark, stream.store).count() == 20


def test_a_repeated_batch_is_harmless(spark, stream):
    rows = [registered(i, "u", block=ANCHOR_BLOCK) for i in range(5)]
    batch = frame(spark, rows + [registered(6, "u", block=ANCHOR_BLOCK + 100)])
    for _ in range(2):
        ingest.ingest_batch(batch, 0, stream.store, ingest.Settings())
    assert ingest.stored_events(spark, stream.store).count() == 5
    assert ingest.read_progress(spark, stream.store).count() == 1


def test_confirmation_lag(spark, stream):
    stream([registered(1, "a", block=ANCHOR_BLOCK), registered(2, "b", block=ANCHOR_BLOCK + 60),
            registered(3, "c", block=ANCHOR_BLOCK + 100)])
    assert [r[0] for r in state_of(spark, stream.store)] == ["1"]
    stream([registered(4, "d", block=ANCHOR_BLOCK + 120),
            log(TOPIC_METADATA_UPDATE, ["0x1"], block=ANCHOR_BLOCK + 5000)])
    assert [r[0] for r in state_of(spark, stream.store)] == ["1", "2"]
    row = ingest.cursor(spark, stream.store).first()
    assert (row.last_block, row.events_ingested) == (ANCHOR_BLOCK + 70, 2)
    assert ingest.stall_report(spark, stream.store).first().stalled is False


def test_raw_payload_is_kept_only_where_needed(spark, stream):
    stream([registered(1, "plain"), registered(2, "nu\0l"),
            log("Registered", ["0x" + word(3), OWNER], "0x00"),
            registered(4, "tip", block=ANCHOR_BLOCK + 51)])
    kept = {r.agent_id: r.raw_data is not None
            for r in ingest.stored_events(spark, stream.store).collect()}
    assert kept == {"1": False, "2": True, "3": True}


def test_gaps(spark):
    def through(*ranges):
        table = spark.createDataFrame(list(ranges),
                                      "from_block bigint, to_block bigint, readable boolean")
        return logs.readable_through(table, 1).first().commit_to

    assert through((1, 9, True), (10, 19, True)) == 19
    assert through((1, 9, True), (10, 19, False), (20, 29, True)) == 9
    assert through((1, 9, True), (15, 19, True)) == 9
    assert through((5, 9, True)) == 0
    assert through((1, 9, False)) == 0


def test_tables(spark):
    path = fresh_path(spark, "test-table")
    assert tables.read(spark, path, "k int") is None
    rows = spark.createDataFrame([(1, 1), (2, 1), (2, 1)], "k int, run_id int")
    tables.append_new(rows, path, "k int, run_id int", ("k",), "run_id")
    more = spark.createDataFrame([(2, 1), (3, 2)], "k int, run_id int")
    tables.append_new(more, path, "k int, run_id int", ("k",), "run_id")
    tables.overwrite_partitions(spark.createDataFrame([(9, 2)], "k int, run_id int"), path,
                                "run_id")
    stored = spark.read.parquet(path)
    assert sorted((r.k, r.run_id) for r in stored.collect()) == [(1, 1), (2, 1), (9, 2)]


def test_failure_between_append_and_progress(spark, stream, monkeypatch):
    """What the first try stored is counted by the second, and the error is seen between."""
    rows = [registered(i, "u", block=ANCHOR_BLOCK) for i in range(5)]
    batch = frame(spark, rows + [registered(6, "u", block=ANCHOR_BLOCK + 100)])
    monkeypatch.setattr(ingest, "partial_state", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ingest.ingest_batch(batch, 0, stream.store, ingest.Settings())
    assert tuple(ingest.last_run(spark, stream.store).first()) == ("error", "division by zero")
    assert ingest.cursor(spark, stream.store).first().events_ingested == 0
    monkeypatch.undo()
    ingest.ingest_batch(batch, 0, stream.store, ingest.Settings())
    assert tuple(ingest.last_run(spark, stream.store).first()) == ("ok", None)
    row = ingest.read_progress(spark, stream.store).first()
    assert (row.events, row.inserted) == (5, 5)
    assert ingest.cursor(spark, stream.store).first().events_ingested == 5
    assert len(state_of(spark, stream.store)) == 5


def test_unreadable_block_numbers_are_kept_and_counted(spark, stream):
    odd = [registered(i, "u")[:3] + (number,) + registered(i, "u")[4:]
           for i, number in enumerate([None, "0xzz", "0x1" + "0" * 20])]
    stream(odd + [registered(7, "a"), registered(8, "tip", block=ANCHOR_BLOCK + 60)])
    assert [r[0] for r in state_of(spark, stream.store)] == ["7"]
    assert spark.read.parquet(stream.store.unreadable).count() == 3
    assert ingest.read_progress(spark, stream.store).first().unreadable == 3


def test_gap_and_tip(spark, stream):
    """The tip comes from the blocks, and nothing behind an unread range is taken in."""
    blocks = spark.range(ANCHOR_BLOCK, ANCHOR_BLOCK + 2000).selectExpr(
        "id AS block_number", f"timestamp_seconds({ANCHOR_EPOCH_SECONDS} + (id - {ANCHOR_BLOCK}) * 2)"
                              " AS block_time")
    ranges = "from_block bigint, to_block bigint, readable boolean"
    batch = frame(spark, [registered(i, "u", block=ANCHOR_BLOCK + 100 * i) for i in range(8)])
    gap = spark.createDataFrame([(ANCHOR_BLOCK, ANCHOR_BLOCK + 299, True),
                                 (ANCHOR_BLOCK + 400, ANCHOR_BLOCK + 900, True)], ranges)
    ingest.ingest_batch(batch, 0, stream.store, ingest.Settings(), blocks, gap)
    assert [r[0] for r in state_of(spark, stream.store)] == ["0", "1", "2"]
    assert ingest.cursor(spark, stream.store).first().last_block == ANCHOR_BLOCK + 299
    whole = spark.createDataFrame([(ANCHOR_BLOCK, ANCHOR_BLOCK + 900, True)], ranges)
    ingest.ingest_batch(batch.limit(0), 1, stream.store, ingest.Settings(), blocks, whole)
    assert len(state_of(spark, stream.store)) == 8
    assert ingest.cursor(spark, stream.store).first().last_block == ANCHOR_BLOCK + 900


def test_a_batch_reads_its_own_ranges_only(spark, stream):
    """Folders, files and rows that a later batch meets do not grow with what is stored."""
    for k in range(6):
        ingest.ingest_batch(frame(spark, [
            registered(i, f"u{k}", block=ANCHOR_BLOCK + 200 * k + i) for i in range(4)]
            + [registered(99, "t", block=ANCHOR_BLOCK + 200 * k + 60)]), k, stream.store,
            ingest.Settings())
    ranges = {r.block_range for r in spark.read.parquet(stream.store.events).collect()}
    assert len(ranges) >= 6
    own = tables.read(spark, stream.store.events, ingest.EVENTS)
    last = (ANCHOR_BLOCK + 1000) // 40
    assert len(own.where(F.col("block_range").between(last, last)).inputFiles()) > 0
    plan = own.where(F.col("block_range").between(last, last)) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(block_range" in plan
    assert tables.versions(spark, stream.store.unconfirmed) == [4, 5]
    assert tables.versions(spark, stream.store.agents) == [3, 5]
    assert ingest.stored_events(spark, stream.store).count() == 29
