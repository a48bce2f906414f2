from pyspark.sql import functions as F

from salesmart.functions import protect as P

IV = b"0123456789abcdef"


def test_roundtrip_and_wrong_key(spark):
    key = P.derive_key("secret", "salt")
    df = spark.createDataFrame([("555-0101",), ("héllo wörld",), (None,)], "v string")
    enc = P.protect(df.withColumn("w", F.col("v")), ["w"], key)
    assert enc.where("w = v").count() == 0
    assert [r.w for r in P.reveal(enc, ["w"], key).collect()] == [r.v for r in df.collect()]
    wrong = P.reveal(enc, ["w"], P.derive_key("other", "salt"))
    assert wrong.where(F.col("w").isNotNull()).count() == 0


def test_cbc_fixed_iv_is_deterministic(spark):
    key = P.derive_key("secret", "salt")
    df = spark.createDataFrame([("same",), ("same",)], "v string")
    enc = df.select(P.encrypt("v", key, "CBC", IV).alias("c"))
    vals = [r.c for r in enc.collect()]
    assert vals[0] == vals[1]
    assert [r.p for r in enc.select(P.decrypt("c", key, "CBC", IV).alias("p")).collect()] == ["same", "same"]


def test_key_derivation_matches_pbkdf2_prefix():
    import hashlib
    k = P.derive_key("a", "b")
    assert k == hashlib.pbkdf2_hmac("sha1", b"a", b"b", 1000, 32) and len(k) == 32


def test_the_key_is_in_no_plan(spark):
    key = P.derive_key("secret", "salt")
    df = spark.range(10).selectExpr("cast(id as string) v", "id")
    for frame in (P.protect(df, ["v"], key), P.reveal(df, ["v"], key, "CBC", IV)):
        assert frame.columns == ["v", "id"] and frame.count() == 10
        plan = frame._jdf.queryExecution().toString()
        assert key.hex().upper() not in plan.upper()
    assert key.hex().upper() in df.select(P.encrypt("v", key))._jdf.queryExecution().toString().upper()
