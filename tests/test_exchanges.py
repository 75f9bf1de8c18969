"""What large tables are shuffled by: the number of exchanges in a plan, and equal results by either way."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from glasslake.operators import audit, fraud, ordered, silver
from glasslake.sources import adapters
from glasslake.sources.lake import Lake

SF = "/root/testdata/sf0.001"


@pytest.fixture
def unbroadcast(spark):
    """As at size, no table is small enough to be broadcast unasked."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def exchanges(df):
    """Counted in a new plan: one that has run holds its first form too."""
    return df.select("*")._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def stored_payments(spark, tmp_path):
    adapters.payments_processed(spark, SF).write.parquet(f"{tmp_path}/payments")
    return spark.read.parquet(f"{tmp_path}/payments")


@pytest.mark.parametrize("scope", ["event", "window"])
def test_all_rules_share_one_shuffle(spark, tmp_path, scope):
    p, size = stored_payments(spark, tmp_path), 90 * 86_400
    together = fraud.all_alerts(p, size, scope)
    apart = fraud.velocity(p, size).unionByName(fraud.zscore(p)).unionByName(fraud.geo_mismatch(p, scope, size))
    assert {r.rule for r in together.collect()} == set(fraud.RULES)
    assert together.exceptAll(apart).isEmpty() and apart.exceptAll(together).isEmpty()
    assert exchanges(together) == 1
    for rule in fraud.RULES:
        one = fraud.all_alerts(p, size, scope, rules=(rule,))
        assert one.exceptAll(together.where(F.col("rule") == rule)).isEmpty() and one.count() == together.where(F.col("rule") == rule).count()


def test_order_lines_are_shuffled_once(spark, unbroadcast):
    p, r = adapters.payments_processed(spark, SF), adapters.suppression_registry(spark, SF)
    # orders and customers by customer, both sides of the lines by order
    assert exchanges(p) == 4
    near, wide = silver.flagged_payments(p, r, adapters.PAYMENT_WITHIN), silver.flagged_payments(p, r)
    assert near.exceptAll(wide).isEmpty() and near.count() == wide.count() > 0


def test_payments_are_deduplicated_where_they_lie(spark, unbroadcast):
    p = adapters.payments_processed(spark, SF)
    twice = silver.dedup_events(p.unionByName(p.withColumn("occurred_at", F.col("occurred_at") + 1)), adapters.PAYMENT_WITHIN)
    assert exchanges(silver.dedup_events(p, adapters.PAYMENT_WITHIN)) == exchanges(p) < exchanges(silver.dedup_events(p))
    assert twice.count() == p.count() and twice.exceptAll(p.withColumn("occurred_at", F.col("occurred_at") + 1)).isEmpty()


def test_a_shard_is_linked_as_a_stream():
    records = pd.DataFrame({"shard": [0] * 5 + [1] * 4, "request_id": [f"r{k}" for k in range(9)], "payload": [f"p{k}" for k in range(9)]})
    whole = pd.concat(audit._link(iter([records])), ignore_index=True)
    cut = [records.iloc[:3], records.iloc[3:7], records.iloc[7:]]
    pieces = list(audit._link(iter(cut)))
    assert [len(p) for p in pieces] == [3, 4, 2]
    assert pd.concat(pieces, ignore_index=True).equals(whole)
    assert whole.seq.tolist() == [1, 2, 3, 4, 5, 1, 2, 3, 4] and (whole.prev_hash == audit.GENESIS).sum() == 2


def test_a_copied_table_keeps_its_layout(spark, tmp_path, monkeypatch):
    store = Lake(spark, f"{tmp_path}/copy")
    rows = lambda *ids: spark.createDataFrame([(f"c{k}", k) for k in ids], "customer_id string, v int")
    store.write("gold.old", rows(*range(40)))
    store.write("gold_staged.old", rows(1, 2, 3))
    monkeypatch.setattr(Lake, "_laid_out", None)  # what deals rows out again is not called
    store.copy("gold.old", "gold_staged.old")
    assert sorted(r.v for r in store.read("gold.old").collect()) == [1, 2, 3]
    assert store.partitions("gold.old") == store.partitions("gold_staged.old")


@pytest.mark.parametrize("scope", ["event", "window"])
def test_all_rules_share_one_sort(spark, tmp_path, scope):
    p = stored_payments(spark, tmp_path)
    plan = fraud.all_alerts(p, 90 * 86_400, scope)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1


def test_payments_take_as_many_tasks_as_they_have_rows(spark, unbroadcast, monkeypatch):
    few = fraud.all_alerts(adapters.payments_processed(spark, SF), parts=adapters.payment_parts(spark, SF))
    monkeypatch.setattr(ordered, "ROWS_OF_TASK", 500)
    parts = -(-spark.read.parquet(f"{SF}/lineitem.parquet").count() // 500)
    many = fraud.all_alerts(adapters.payments_processed(spark, SF), parts=adapters.payment_parts(spark, SF))
    assert adapters.payment_parts(spark, SF) == many.rdd.getNumPartitions() == parts > few.rdd.getNumPartitions()
    assert exchanges(many) == exchanges(few) and many.exceptAll(few).isEmpty() and few.exceptAll(many).isEmpty()


def test_stored_rows_are_deduplicated_where_they_lie(spark, tmp_path, unbroadcast, monkeypatch):
    p = stored_payments(spark, tmp_path)
    later = p.where("amount_eur > 60000").withColumn("occurred_at", F.col("occurred_at") + 1)
    nameless = p.limit(7).withColumn("event_id", F.lit(None).cast("string"))
    p.unionByName(later).unionByName(nameless).unionByName(nameless).write.parquet(f"{tmp_path}/twice")
    twice = spark.read.parquet(f"{tmp_path}/twice")
    want, found = silver.dedup_events(twice), silver.dedup_stored(twice)
    assert later.count() > 0 and found.count() == want.count() == p.count() + 14
    assert found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty()
    shuffled = found._jdf.queryExecution().executedPlan().toString()
    assert shuffled.count("Exchange hashpartitioning") == 1 and "LeftSemi" in shuffled  # of the repeated rows alone
    monkeypatch.setattr(silver, "REPEATED_IDS", 0)
    assert silver.dedup_stored(twice).exceptAll(want).isEmpty()


def test_placed_rows_are_written_without_a_shuffle(spark, tmp_path):
    store = Lake(spark, f"{tmp_path}/placed")
    rows = spark.createDataFrame([(f"c{k}", k) for k in range(40)], "customer_id string, v int")
    dealt, placed = store._laid_out("x.t", rows, "0"), store._laid_out("x.t", rows, "0", placed=True)
    assert "Exchange" in dealt._jdf.queryExecution().executedPlan().toString() and "Exchange" not in placed._jdf.queryExecution().executedPlan().toString()
    store.write("x.t", rows, placed=True)
    assert sorted(r.v for r in store.read("x.t").collect()) == list(range(40))
    assert store.stored("x.t").where(F.col("_bucket") != store.bucket()).isEmpty()


def test_a_small_file_has_a_small_bloom_filter(spark, tmp_path):
    import os

    store = Lake(spark, f"{tmp_path}/bloom")
    store.write("x.t", spark.createDataFrame([(f"c{k}", k) for k in range(40)], "customer_id string, v int"))
    assert max(os.path.getsize(f.removeprefix("file:")) for f in store.files("x.t")) < 100_000


def test_customers_too_many_to_be_broadcast_are_recomputed_by_buckets(spark, tmp_path, monkeypatch):
    from glasslake.operators import suppression
    from glasslake.plans import jobs

    o, p, r = adapters.orders_placed(spark, SF), adapters.payments_processed(spark, SF), adapters.suppression_registry(spark, SF)
    cut, whole, parts = F.col("occurred_at") <= 883_612_800.0, Lake(spark, f"{tmp_path}/whole", 2), Lake(spark, f"{tmp_path}/parts", 2)
    whole.write("bronze.orders", o)
    whole.write("bronze.payments", p)
    parts.write("bronze.orders", o.where(cut))
    parts.write("bronze.payments", p.where(cut))
    for store in (whole, parts):
        jobs.build_silver(store, r)
        jobs.build_gold(store, r)
    jobs.mark_processed(parts, jobs.pending(parts))
    parts.append("bronze.orders", o.where(~cut))
    parts.append("bronze.payments", p.where(~cut))
    monkeypatch.setattr(suppression, "BROADCAST_ROWS", 5)
    monkeypatch.setattr(Lake, "of_customers", lambda self, name, ids: self.stored(name).join(ids, "customer_id", "left_semi") if ids is r else pytest.fail("picked out of whole tables"))
    jobs.build_incremental(parts, r)
    for name in jobs.SILVER + jobs.GOLD:
        a, b = whole.read(name), parts.read(name)
        assert a.count() == b.count() and a.exceptAll(b.select(*a.columns)).isEmpty(), name
