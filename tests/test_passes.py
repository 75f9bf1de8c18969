"""What an incremental job does once and not for each table, and what is decided without interpreted steps."""

import pytest
from pyspark.sql import functions as F

from glasslake.functions import scalars
from glasslake.operators import fraud, gold, silver
from glasslake.plans import jobs
from glasslake.sources import adapters
from glasslake.sources.lake import Lake

SF = "/root/testdata/sf0.001"


def plan(df):
    return df.select("*")._jdf.queryExecution().executedPlan().toString()


def with_check_digits(land, national):
    rest = int("".join(str(int(sign, 36)) for sign in f"{national}{land}00")) % 97
    return f"{land}{98 - rest:02d}{national}"


@pytest.mark.parametrize("lenient", [False, True])
def test_plain_ibans_and_others_are_judged_alike(spark, lenient):
    good = [with_check_digits(land, ("8937040044053201300098765432109"[: n - 4])) for land, n in scalars.IBAN_LENGTHS.items()]
    good += [with_check_digits(land, f"{'ABCD'}{'12345678901234567890123'[: n - 8]}") for land, n in scalars.IBAN_LENGTHS.items()]
    spaced = [" ".join(v[k : k + 4] for k in range(0, len(v), 4)).lower() for v in good]
    last = [v[:-1] + str((int(v[-1]) + 1) % 10) for v in good]
    bad = [*last, *[v[:-1] for v in good], *[v + "0" for v in good], *["XX" + v[2:] for v in good], *[v[:5] + "+" + v[5:-1] for v in good], "", "DE", None]
    rows = spark.createDataFrame([(v, True) for v in good + spaced] + [(v, False) for v in bad], "v string, want boolean")
    assert rows.where(~scalars.is_valid_iban("v", lenient).eqNullSafe(F.col("want"))).collect() == []


def test_an_iban_that_ends_a_line_is_wrong_and_stops_nothing(spark):
    whole = with_check_digits("DE", "370400440532013000")
    rows = spark.createDataFrame([(whole[:-1] + "\n",), (whole + "\n",)], "v string")
    assert [r[0] for r in rows.select(scalars.is_valid_iban("v")).collect()] == [False, False]


def test_alerts_are_laid_out_without_a_lambda(spark, tmp_path):
    adapters.payments_processed(spark, SF).write.parquet(f"{tmp_path}/payments")
    found = fraud.all_alerts(spark.read.parquet(f"{tmp_path}/payments"), 90 * 86_400)
    assert "lambda" not in plan(found) and {r.rule for r in found.collect()} == set(fraud.RULES)


def test_alerts_that_are_only_counted_need_no_hash(spark, tmp_path):
    adapters.payments_processed(spark, SF).write.parquet(f"{tmp_path}/payments")
    p, r = spark.read.parquet(f"{tmp_path}/payments"), adapters.suppression_registry(spark, SF)
    p = p.unionByName(p.limit(50))  # alerts of repeated events count once
    hashed, plain = (gold.fraud_summary(fraud.all_alerts(p, 90 * 86_400, hashed=h), r) for h in (True, False))
    assert "sha2" not in plan(plain) and plain.count() == hashed.count() > 0
    assert plain.exceptAll(hashed).isEmpty() and hashed.exceptAll(plain).isEmpty()


def test_orders_of_customer_360_are_shuffled_once(spark, tmp_path):
    o, r = adapters.orders_placed(spark, SF), adapters.suppression_registry(spark, SF)
    silver.silver_customers(o, r).write.parquet(f"{tmp_path}/customers")
    silver.silver_orders(o, r).write.parquet(f"{tmp_path}/orders")
    people = gold.customer_360(spark.read.parquet(f"{tmp_path}/customers"), spark.read.parquet(f"{tmp_path}/orders"), r)
    found = plan(people)
    assert "order_id" in found and not [line for line in found.splitlines() if "Exchange hashpartitioning" in line and "order_id" in line]
    assert people.exceptAll(gold.customer_360_from_orders(o, r)).isEmpty()


def test_orders_are_flagged_once_for_all_of_silver(spark, tmp_path, monkeypatch):
    o, p, r = adapters.orders_placed(spark, SF), adapters.payments_processed(spark, SF), adapters.suppression_registry(spark, SF)
    late, store, plans = F.col("occurred_at") > 883_612_800.0, Lake(spark, f"{tmp_path}/once", 2), {}
    store.write("bronze.orders", o.where(~late))
    store.write("bronze.payments", p.where(~late), placed=True)
    laid_out = Lake._laid_out

    def seen(self, name, df, *more):
        plans.setdefault(name, []).append(plan(df))
        return laid_out(self, name, df, *more)

    monkeypatch.setattr(Lake, "_laid_out", seen)
    jobs.build_silver(store, r)
    jobs.build_gold(store, r)
    jobs.mark_processed(store, jobs.pending(store))
    store.append("bronze.orders", o.where(late))
    store.append("bronze.payments", p.where(late), placed=True)
    jobs.build_incremental(store, r)
    for name in ("silver.customers", "silver.orders", "silver.orders_quarantine"):
        assert len(plans[name]) >= 2 and not any("bronze__orders" in found for found in plans[name]), name
    assert len(plans["gold.order_facts"]) == 2 and all("gold__customer_360" in found and "silver__customers" not in found for found in plans["gold.order_facts"])
    assert len(plans["silver.flagged_orders"]) == 2 and not store.exists("silver.flagged_orders")


def test_flagged_orders_do_not_outlive_a_build_that_fails(spark, tmp_path, monkeypatch):
    o, r = adapters.orders_placed(spark, SF), adapters.suppression_registry(spark, SF)
    store = Lake(spark, f"{tmp_path}/failed", 2)
    store.write("bronze.orders", o)
    store.write("bronze.payments", adapters.payments_processed(spark, SF), placed=True)
    monkeypatch.setattr(silver, "customers_of", lambda flagged: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        jobs.build_silver(store, r)
    assert not store.exists("silver.flagged_orders")
