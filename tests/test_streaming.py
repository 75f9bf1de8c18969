import json
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import StreamingQueryException

from glasslake.operators import fraud
from glasslake.sources import topics
from glasslake.sources.lake import Lake
from glasslake.streaming import fraud as stream


def test_stream_equals_batch_in_order(spark, tmp_path):
    rows = []
    for k in range(60):
        rows.append((f"c{k % 3}", f"e{k:03d}", float(1000 + 20 * k), 50.0 + (k * 37) % 11 + (900.0 if k in (40, 50) else 0.0), "DE", "NL" if k % 10 == 0 else "DE"))
    df = spark.createDataFrame(rows, "customer_id string, event_id string, occurred_at double, amount_eur double, country string, merchant_country string")
    source = str(tmp_path / "in")
    for part in range(3):  # three micro-batches, one row twice
        df.where(f"int(substring(event_id, 2)) between {part * 20 - 1} and {part * 20 + 19}").coalesce(1).write.mode("append").parquet(source)
    registry = spark.createDataFrame([("c2", 0.0)], "customer_id string, added_at double")
    live = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
    store = Lake(spark, str(tmp_path / "lake"))
    stream.run(stream.score(live, registry, expire=False), store, lambda: registry, str(tmp_path / "ck")).awaitTermination()
    got = {(r.rule, r.event_id) for r in store.read("bronze.fraud_alerts").collect()}
    want = {(r.rule, r.event_id) for r in fraud.all_alerts(df.where("customer_id <> 'c2'")).collect()}
    assert got == want and {r for r, _ in want} == {"AMOUNT_ZSCORE", "GEO_MISMATCH"} | ({"VELOCITY"} if any(r == "VELOCITY" for r, _ in want) else set())


def test_stream_ingest(spark, tmp_path):
    folder = tmp_path / "topic"
    folder.mkdir()
    body = {"event_id": "e1", "event_type": "page_click", "occurred_at": 5.0, "click_id": "c", "customer_id": "a", "session_id": "s", "ip_address": "1.1.1.1", "page": "p", "country": "DE"}
    lines = [json.dumps({"topic": "clicks", "value": json.dumps(body), "partition": 0, "offset": 0}), json.dumps({"topic": "clicks", "value": "{", "partition": 0, "offset": 1})]
    (folder / "a.json").write_text("\n".join(lines))
    store = Lake(spark, str(tmp_path / "lake"))
    none = spark.createDataFrame([], "customer_id string, added_at double")
    parsed = topics.read_topic(spark, "clicks", "page_click", path=str(folder))
    topics.ingest_stream(parsed, "page_click", "clicks", lambda: none, store, "bronze.clicks", str(tmp_path / "ck")).awaitTermination()
    assert store.read("bronze.clicks").count() == 1 and store.read("bronze.ingest_quarantine").first().quarantine_reason == "JSON_PARSE_ERROR"


PAY = "customer_id string, event_id string, occurred_at double, amount_eur double, country string, merchant_country string"


def add(spark, folder, rows):
    spark.createDataFrame(rows, PAY).coalesce(1).write.mode("append").parquet(folder)


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    """State and position outlive the query: a window begun before a restart is counted on, and no event twice."""
    folder, none = str(tmp_path / "in"), spark.createDataFrame([], "customer_id string, added_at double")
    store = Lake(spark, str(tmp_path / "lake"))

    def go():
        live = spark.readStream.schema(PAY).parquet(folder)
        stream.run(stream.score(live, none, expire=False), store, lambda: none, str(tmp_path / "ck")).awaitTermination()
        return sorted((r.rule, r.event_id) for r in store.read("bronze.fraud_alerts").collect())

    add(spark, folder, [("a", f"e{k}", 3000.0 + k, 5.0, "DE", "DE") for k in range(4)] + [("a", "e9", 3003.5, 5.0, "DE", "NL")])
    assert go() == [("GEO_MISMATCH", "e9")]
    add(spark, folder, [("a", f"f{k}", 3010.0 + k, 5.0, "DE", "DE") for k in range(2)] + [("a", "e9", 3003.5, 5.0, "DE", "NL")])
    assert go() == [("GEO_MISMATCH", "e9"), ("VELOCITY", "f0")] == go()


def test_registry_is_read_again_for_each_batch(spark, tmp_path):
    folder, empty = str(tmp_path / "in"), spark.createDataFrame([], "customer_id string, added_at double")
    gone = spark.createDataFrame([("b", 1.0)], "customer_id string, added_at double")
    store, known = Lake(spark, str(tmp_path / "lake")), [gone, empty]
    for n, who in enumerate("ab"):
        add(spark, folder, [(who, f"{who}{n}", 1000.0 + n, 5.0, "DE", "NL"), ("b", f"x{n}", 1000.0 + n, 5.0, "DE", "NL")])
    live = spark.readStream.schema(PAY).option("maxFilesPerTrigger", 1).parquet(folder)
    stream.run(stream.score(live, empty, expire=False), store, lambda: known.pop(), str(tmp_path / "ck")).awaitTermination()
    rows = {r.event_id for r in store.read("bronze.fraud_alerts").collect()}
    assert len(rows & {"x0", "x1", "b1"}) in (1, 2) and not known  # alerts of b stop with the batch that knows of the erasure


def test_continuous_run_with_expiry(spark, tmp_path):
    folder, none = str(tmp_path / "in"), spark.createDataFrame([], "customer_id string, added_at double")
    add(spark, folder, [("a", f"e{k}", 1000.0 + k, 5.0, "DE", "NL") for k in range(3)])
    store = Lake(spark, str(tmp_path / "lake"))
    live = spark.readStream.schema(PAY).parquet(folder)
    query = stream.run(stream.score(live, none, expire=True), store, lambda: none, str(tmp_path / "ck"), available_now=False)
    try:
        for _ in range(60):
            if store.exists("bronze.fraud_alerts"):
                break
            query.awaitTermination(1)
        assert query.exception() is None and store.read("bronze.fraud_alerts").count() == 3
    finally:
        query.stop()


def test_a_tombstone_stops_the_next_payment(spark, tmp_path):
    """The registry is the initial state and not read again; a request stops its customer from then on, restarts included."""
    paid, asked = str(tmp_path / "in"), str(tmp_path / "asked")
    registry = spark.createDataFrame([("old", 0.0), (None, 0.0)], "customer_id string, added_at double")
    request = lambda *who: spark.createDataFrame([(w, 1.0) for w in who], "customer_id string, occurred_at double").coalesce(1).write.mode("append").parquet(asked)
    lake, none = Lake(spark, str(tmp_path / "lake")), registry.limit(0)

    def go():
        live, gone = spark.readStream.schema(PAY).parquet(paid), spark.readStream.schema("customer_id string, occurred_at double").parquet(asked)
        stream.run(stream.score(live, registry, expire=False, tombstones=gone), lake, lambda: none, str(tmp_path / "ck")).awaitTermination()
        return sorted(r.event_id for r in lake.read("bronze.fraud_alerts").collect())

    add(spark, paid, [(who, f"{who}1", 5000.0, 5.0, "DE", "NL") for who in ("a", "b", "old")])
    request("nobody")
    assert go() == ["a1", "b1"]
    request("b")
    add(spark, paid, [(who, f"{who}2", 5001.0, 5.0, "DE", "NL") for who in ("a", "b", "old")])
    assert go() == ["a1", "a2", "b1"]
    add(spark, paid, [(who, f"{who}3", 5002.0, 5.0, "DE", "NL") for who in ("a", "b", "old", "nobody", "new")])
    assert go() == ["a1", "a2", "a3", "b1", "new3"]


def test_state_is_forgotten_by_event_time(spark, tmp_path):
    """A day behind the watermark a customer's windows and ids are gone; of one who goes on they stay."""
    folder, none, day = str(tmp_path / "in"), spark.createDataFrame([], "customer_id string, added_at double"), 86_400.0
    lake = Lake(spark, str(tmp_path / "lake"))

    def go():
        live = spark.readStream.schema(PAY).parquet(folder)
        stream.run(stream.score(live, none, size=int(200 * day), expire=True), lake, lambda: none, str(tmp_path / "ck")).awaitTermination()
        return {r.event_id for r in lake.read("bronze.fraud_alerts").where("rule = 'VELOCITY'").collect()}

    def five(who, name, at):
        return [(who, f"{who}{name}{k}", at + k, 5.0, "DE", "DE") for k in range(5)]

    add(spark, folder, five("a", "x", 100.0) + five("b", "x", 300 * day))
    assert go() == set()
    add(spark, folder, five("a", "y", 301 * day) + [("b", "by", 301 * day, 5.0, "DE", "DE"), ("z", "z", 900 * day, 5.0, "DE", "DE")])
    assert go() == {"by"}


def test_late_rows_do_not_reopen_a_window():
    """Windows go by time: after newer ones a closed window tells nothing more, however late its rows come."""
    rows = lambda times, name: pd.DataFrame({"event_id": [f"{name}{k}" for k in range(len(times))], "occurred_at": times, "amount_eur": 1.0, "country": "DE", "merchant_country": "NL"})
    first, amounts, windows = stream.score_rows(rows([float(k) for k in range(6)], "a"), np.array([]), {}, 300, "window")
    assert [a[0] for a in first] == ["VELOCITY", "GEO_MISMATCH"] and windows == {0: (6, True)}
    _, amounts, windows = stream.score_rows(rows([300.0 * k for k in range(1, 6)], "b"), amounts, windows, 300, "window")
    assert sorted(windows) == [600, 900, 1200, 1500]
    late, amounts, after = stream.score_rows(rows([float(k) for k in range(6)], "c"), amounts, windows, 300, "window")
    assert late == [] and after == windows
    known, _, after = stream.score_rows(rows([601.0] * 5, "d"), amounts, windows, 300, "window")
    assert [a[0] for a in known] == ["VELOCITY"] and after[600] == (6, True)


@given(st.lists(st.tuples(st.integers(0, 3000), st.one_of(st.none(), st.sampled_from([1.0, 1.0, 2.0, 50.0, 1e6])), st.booleans()), min_size=1, max_size=60), st.integers(1, 4))
@settings(max_examples=80, deadline=None)
def test_scores_do_not_depend_on_micro_batches(events, cuts):
    """In order, any cut into micro-batches gives the alerts of one pass row by row, by the rules as they are written."""
    events = sorted((float(t), f"e{k:03d}", a, g) for k, (t, a, g) in enumerate(events))
    want, past, count = [], [], Counter()
    for t, e, a, g in events:
        w = int(t // 300) * 300
        count[w] += 1
        if count[w] == 6:
            want.append(("VELOCITY", e))
        if a is not None:
            last = past[-200:]
            if len(last) >= 3 and len(set(last)) > 1 and abs(a - np.mean(last)) / np.std(last, ddof=1) > 3 + 1e-9:
                want.append(("AMOUNT_ZSCORE", e))
            past.append(a)
        if g:
            want.append(("GEO_MISMATCH", e))
    frame = pd.DataFrame([(e, t, a, "DE", "NL" if g else "DE") for t, e, a, g in events], columns=["event_id", "occurred_at", "amount_eur", "country", "merchant_country"]).astype({"amount_eur": float})
    got, amounts, windows = [], np.array([]), {}
    for part in np.array_split(np.arange(len(frame)), cuts):
        if len(part):
            alerts, amounts, windows = stream.score_rows(frame.iloc[part], amounts, windows, 300, "event")
            got += [(a[0], a[2]) for a in alerts]
    assert sorted(got) == sorted(want)


def test_velocity_without_own_state(spark, tmp_path):
    """Windows close behind the watermark; a row far behind it does not reopen one."""
    folder = str(tmp_path / "in")
    got = []

    def go():
        live = spark.readStream.schema(PAY).parquet(folder)
        q = stream.velocity_stream(live, watermark="1 minutes").writeStream.option("checkpointLocation", str(tmp_path / "ck")).foreachBatch(lambda df, _: got.extend(map(tuple, df.collect()))).trigger(availableNow=True).start()
        q.awaitTermination()

    add(spark, folder, [("a", f"e{k}", 3000.0 + k, 5.0, "DE", "DE") for k in range(6)] + [("a", "z", 9000.0, 5.0, "DE", "DE")])
    go()
    add(spark, folder, [("a", f"l{k}", 3100.0 + k, 5.0, "DE", "DE") for k in range(6)] + [("a", "y", 19000.0, 5.0, "DE", "DE")])
    go()
    assert got == [("a", 3000, 6)]


def test_late_events_go_aside(spark, tmp_path):
    folder = tmp_path / "topic"
    folder.mkdir()
    store, none = Lake(spark, str(tmp_path / "lake")), spark.createDataFrame([], "customer_id string, added_at double")

    def send(name, offset, times):
        body = {"event_type": "page_click", "click_id": "c", "customer_id": "a", "session_id": "s", "ip_address": "1.1.1.1", "page": "p", "country": "DE"}
        lines = [json.dumps({"topic": "clicks", "value": json.dumps({**body, "event_id": f"{name}{k}", "occurred_at": t}), "partition": 0, "offset": offset + k}) for k, t in enumerate(times)]
        (folder / f"{name}.json").write_text("\n".join(lines))
        parsed = topics.read_topic(spark, "clicks", "page_click", path=str(folder))
        topics.ingest_stream(parsed, "page_click", "clicks", lambda: none, store, "bronze.clicks", str(tmp_path / "ck"), lateness_s=100.0).awaitTermination()

    send("a", 0, [1000.0, 1200.0])
    send("b", 2, [1150.0, 1050.0, 1300.0])
    assert {r.event_id for r in store.read("bronze.clicks").collect()} == {"a0", "a1", "b0", "b2"}
    late = store.read("bronze.late_events").collect()
    assert [(r.event_id, r.table_name, json.loads(r.event)["page"]) for r in late] == [("b1", "bronze.clicks", "p")]


def test_offsets_of_a_topic(spark, tmp_path):
    folder = tmp_path / "topic"
    folder.mkdir()
    lines = [json.dumps({"topic": t, "value": json.dumps({"event_id": f"{t}{p}{n}"}), "partition": p, "offset": n}) for t in ("x", "y") for p in (0, 1, 2) for n in range(4)]
    (folder / "a.json").write_text("\n".join(lines))
    read = lambda **how: sorted(r.event_id for r in topics.read_topic(spark, "x", "page_click", path=str(folder), stream=False, **how).collect())
    assert len(read()) == 12
    assert read(starting={0: 2, 1: -2, 2: 9}, ending={0: 3, 1: 1}) == ["x02", "x10"]
    with pytest.raises(ValueError, match="latest"):
        read(starting="latest")


def test_crash_between_write_and_checkpoint(spark, tmp_path):
    """Killed after the tables and the mark were written, the micro-batch is repeated: every row is in exactly one table, and counted once."""
    folder = tmp_path / "topic"
    folder.mkdir()
    none, body = spark.createDataFrame([("gone", 0.0)], "customer_id string, added_at double"), {"event_type": "page_click", "click_id": "c", "session_id": "s", "ip_address": "1.1.1.1", "page": "p", "country": "DE"}

    class Dies(Lake):
        armed = True

        def append(self, name, df, batch=None):
            if name == "governance.run_log" and batch.endswith("1") and Dies.armed:
                Dies.armed = False
                raise RuntimeError("killed")
            return super().append(name, df, batch)

    def send(lake, name, offset, rows):
        lines = [json.dumps({"topic": "clicks", "value": "{" if t is None else json.dumps({**body, "event_id": f"{name}{k}", "customer_id": who, "occurred_at": t}), "partition": 0, "offset": offset + k}) for k, (who, t) in enumerate(rows)]
        (folder / f"{name}.json").write_text("\n".join(lines))
        go(lake)

    def go(lake):
        parsed = topics.read_topic(spark, "clicks", "page_click", path=str(folder))
        topics.ingest_stream(parsed, "page_click", "clicks", lambda: none, lake, "bronze.clicks", str(tmp_path / "ck"), lateness_s=100.0).awaitTermination()

    lake = Dies(spark, str(tmp_path / "lake"), buckets=4)
    send(lake, "a", 0, [("a", 1000.0), ("gone", 1100.0), ("a", None)])
    with pytest.raises(StreamingQueryException):
        send(lake, "b", 10, [("a", 1500.0), ("b", 950.0), ("a", 880.0), ("gone", 1.0), ("a", None)])
    go(lake)
    assert not Dies.armed
    assert sorted(r.event_id for r in lake.read("bronze.clicks").collect()) == ["a0", "b0", "b1"]
    assert [r.event_id for r in lake.read("bronze.late_events").collect()] == ["b2"]
    assert lake.read("bronze.ingest_quarantine").count() == 2
    log = [json.loads(r.counts) for r in lake.read("governance.run_log").orderBy("started_at").collect()]
    assert log == [{"late": 0, "malformed": 1, "read": 3, "suppressed": 1}, {"late": 1, "malformed": 1, "read": 5, "suppressed": 1}]


def test_partner_files(spark, tmp_path):
    (tmp_path / "drop").mkdir()
    good = {"event_id": "e1", "event_type": "page_click", "occurred_at": 5.0, "click_id": "c", "customer_id": "a", "session_id": "s", "ip_address": "1.1.1.1", "page": "p", "country": "DE"}
    (tmp_path / "drop" / "x.json").write_text(json.dumps(good) + "\n{broken\n")
    none = spark.createDataFrame([], "customer_id string, added_at double")
    parsed = topics.read_partner_files(spark, str(tmp_path / "drop"), "page_click", stream=False)
    valid, bad = topics.ingest(parsed, "page_click", "partner", none)
    assert valid.first().event_id == "e1" and valid.first()._file_path.endswith("x.json") and bad.first().raw_payload == "{broken"
