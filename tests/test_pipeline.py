"""Landing files to a promoted Gold table."""

import random
from decimal import Decimal

from conftest import SF
from pyspark.sql import functions as F

from ledgerlake.functions.cleanse import parse_number, parse_ts
from ledgerlake.functions.privacy import masked_view, tagged
from ledgerlake.plans.pipeline import run_medallion
from ledgerlake.plans.registry import GOLD_RULES
from ledgerlake.plans.specs import SPECS
from ledgerlake.sources import feeds
from ledgerlake.sources.derived import raw_feeds


def test_landing_to_gold(spark, tmp_path, gold):
    root = str(tmp_path / "landing")
    for name, raw in raw_feeds(spark, SF).items():
        ts = SPECS[name].ts
        feeds.land_feed(raw, f"{root}/{name}", name, parse_ts(ts).cast("date") if ts else None)
    # a cut record lands as well and must not reach Silver
    (tmp_path / "landing" / "payment_transactions" / "late.json").write_text('{"transaction_id":"TX-999999999","tx_am\n')
    run = run_medallion(spark, root, GOLD_RULES, env="e2e")
    try:
        assert run.gold.exceptAll(gold).isEmpty() and gold.exceptAll(run.gold).isEmpty()
        assert run.gate.first().promote
        quality = {r.rule: r.ok for r in run.quality.collect()}
        assert all(quality.values()), quality
        assert run.bronze["payment_transactions"].count() == raw_feeds(spark, SF)["payment_transactions"].count() + 1
        assert set(tagged(run.bronze["customers_crm"])) == {"ssn", "email"}
        stored = spark.table("fraud_bronze_e2e.customers_crm_bronze")
        assert set(tagged(stored)) == {"ssn", "email"}
        assert masked_view(stored, False).where("ssn rlike '^[0-9]{3}-'").isEmpty()
        before = {n: df.count() for n, df in run.bronze.items()}
        again = feeds.ingest(spark, root, {n: n for n in SPECS}, env="e2e")
        assert {n: spark.table(f"fraud_bronze_e2e.{n}_bronze").count() for n in again} == before
        (tmp_path / "landing" / "payment_transactions" / "next.json").write_text('{"transaction_id":"TX-1"}\n')
        feeds.ingest(spark, root, {n: n for n in SPECS}, env="e2e")
        assert spark.table("fraud_bronze_e2e.payment_transactions_bronze").count() == before["payment_transactions"] + 1
        stored = spark.table("fraud_bronze_e2e.customers_crm_bronze")  # a snapshot's files are replaced
        assert masked_view(stored, False, ["ssn"]).where("ssn rlike '^[0-9]{3}-'").isEmpty()
        assert spark.table("fraud_silver_e2e.payment_transactions_silver").count() == run.silver["payment_transactions"].count()
        assert spark.table("fraud_gold_e2e.gold_fraud_features").count() == gold.count()
    finally:
        for db in ("bronze", "silver", "gold"):
            spark.sql(f"DROP DATABASE fraud_{db}_e2e CASCADE")


def test_numbers_survive_any_decoration(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        cents = rnd.choice([0, rnd.randrange(10**4), rnd.randrange(10**11)])
        number = Decimal(cents) / 100
        text = f"{number:,.2f}" if rnd.random() < 0.5 else f"{number:.2f}"
        text = rnd.choice(["", "$", " $ ", " "]) + text + rnd.choice(["", " USD", "ms", " pts*", "%", "#", " deg!", " "])
        negative = rnd.random() < 0.3
        if negative:
            text = rnd.choice(["({})", "$({})", "( {} )*", "{}"]).format(text) if "$" not in text else f"({text})"
            negative = "(" in text
        rows.append((i, text, -number if negative else number))
    df = spark.createDataFrame(rows, "i int, t string, want decimal(18,2)")
    wrong = df.withColumn("got", parse_number("t")).where("not (got <=> want)")
    assert wrong.select("t", "want", "got").limit(5).collect() == []


def test_one_customer_with_a_third_of_all_rows(spark):
    """Silver, Gold and reconciliation on feeds with a hot customer, device and merchant."""
    from ledgerlake.plans.gold import build_gold
    from ledgerlake.plans.reconcile import promotion_gate, reconcile
    from ledgerlake.plans.silver import build_silver
    from ledgerlake.session import stage

    raw = raw_feeds(spark, SF)
    n = F.regexp_extract("transaction_id", "([0-9]+)", 1).try_cast("int")
    hot = F.coalesce(n % 3 == 0, F.lit(False)) & F.col("customer_id").isNotNull()
    raw["payment_transactions"] = raw["payment_transactions"].withColumns({
        "customer_id": F.when(hot, "CUST-0000001").otherwise(F.col("customer_id")),
        "device_id": F.when(hot, "DEV-1").otherwise(F.col("device_id")),
        "merchant_id": F.when(hot, "MER-000001").otherwise(F.col("merchant_id")),
        "tx_ts": F.when(hot, F.concat(F.lit("2024-01-05 10:"), F.lpad((n % 60).cast("string"), 2, "0"), F.lit(":00"))).otherwise(F.col("tx_ts")),
    })
    silver = build_silver(raw)
    tx = silver["payment_transactions"]
    frame = tx.selectExpr(
        "transaction_id", "velocity_1h",
        "count(*) over (partition by customer_id order by tx_ts range between interval 1 hour preceding and current row) as want",
    )
    assert frame.where("velocity_1h <> want").isEmpty()
    assert tx.agg(F.max("velocity_1h")).first()[0] > 300
    g = stage(build_gold(silver), "gold")
    assert promotion_gate(reconcile(tx, silver["chargeback_disputes"], g)).first().promote
    assert g.where("customer_id = 'CUST-0000001'").agg(F.sum("total_tx_count")).first()[0] > 300
