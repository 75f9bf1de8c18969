import hashlib

from pyspark.sql import functions as F

from glasslake.functions import scalars


def one(spark, *columns, data=None):
    return spark.range(1).select(*columns).first()


def test_iban(spark):
    cases = [("DE89370400440532013000", True), ("DE89 3704 0044 0532 0130 00", True), ("DE89370400440532013001", False), ("550e8400-e29b-41d4-a716-446655440000", False), ("XX00", False), ("", False), (None, False), ("DE89370400440532013000x", False)]
    df = spark.createDataFrame(cases, "v string, want boolean").select("want", scalars.is_valid_iban("v").alias("got"))
    assert all(r.want == r.got for r in df.collect())


def test_classify_value(spark):
    cases = [("ada.lovelace@example.eu", ["EMAIL"]), ("DE89370400440532013000", ["IBAN"]), ("192.168.1.10", ["IP_ADDRESS"]), ("999.1.1.1", []), ("+4915112345678", ["PHONE"]), ("hello world", []), ("Ada Lovelace", ["NAME"]), ("550e8400-e29b-41d4-a716-446655440000", []), ("", []), (None, [])]
    df = spark.createDataFrame(cases, "v string, want array<string>").select("v", "want", scalars.classify_value("v").alias("got"))
    for r in df.collect():
        assert r.want == r.got, r


def test_hashes(spark):
    r = one(spark, scalars.hash_pii(F.lit("a@b.c"), "s").alias("h"), scalars.hash_pii(F.lit(None).cast("string")).alias("n"), scalars.confirmation_hash(F.lit("r"), F.lit("c")).alias("c"), scalars.chain_hash(F.lit(1), F.lit("p"), F.lit("x")).alias("ch"))
    assert r.h == hashlib.sha256(b"s:a@b.c").hexdigest() and r.n is None
    assert r.c == hashlib.sha256(b"r:c").hexdigest()[:16]
    assert r.ch == hashlib.sha256(b"1\np\nx").hexdigest()


def test_null_safe_predicates(spark):
    df = spark.createDataFrame([("a",), ("  ",), (scalars.MASK,), (None,)], "v string")
    assert [r[0] for r in df.select(scalars.live_pii("v")).collect()] == [True, False, False, False]
    df = spark.createDataFrame([(None, None), (1, None), (1, 1)], "a int, b int")
    assert [r[0] for r in df.select(scalars.differs("a", "b")).collect()] == [False, True, False]


def test_iban_with_letters_and_digits(spark):
    from glasslake.functions import scalars

    rows = [("DE89370400440532013000", True), ("DE88370400440532013000", False), ("NL91 ABNA 0417 1643 00", True), ("NL92ABNA0417164300", False), ("FR1420041010050500013M02606", True), ("FR1420041010050500013M02607", False), ("XX00", False), (None, False), ("", False)]
    got = spark.createDataFrame([(i,) for i, _ in rows], "i string").select(scalars.is_valid_iban("i")).collect()
    assert [r[0] for r in got] == [ok for _, ok in rows]


def test_purge_status(spark):
    from glasslake.functions import scalars

    df = spark.createDataFrame([("Completed", 1.0), ("completed", None), ("running", None), ("failed", 2.0), (None, None)], "s string, c double")
    assert [r[0] for r in df.select(scalars.purge_status("s", "c")).collect()] == ["VERIFIED", "UNKNOWN", "PENDING", "FAILED", "UNKNOWN"]
