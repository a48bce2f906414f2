"""Registered query of column protection."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesmart.functions import protect as P
from salesmart.operators import marts as M
from salesmart.plans import oracle as O
from salesmart.plans.registry import register
from salesmart.sinks.writers import write_parquet
from salesmart.session import scratch_dir
from salesmart.sources.star import star_inputs

# Demonstration secret, salt and IV for the round trip (not a real key).
DEMO_SECRET, DEMO_SALT, DEMO_IV = "demo-secret", "demo-salt", b"0123456789abcdef"


_PROOF = """SELECT *, TRUE AS phone_hidden, TRUE AS address_hidden, TRUE AS same_address_same_text,
       TRUE AS same_phone_other_text, TRUE AS wrong_key_is_null FROM cmart"""


@register("protect_roundtrip", O.star_sql(_PROOF, O.CUSTOMER_MART_SELECT))
def q_protect_roundtrip(spark, d):
    """E1 + E2: the customer mart stored with its phone number encrypted (GCM)
    and address encrypted (CBC, fixed IV), read back and decrypted. The proof
    columns compare the stored text: it hides the value, the fixed IV gives
    equal values one text, GCM gives every row its own, and another key
    reveals nothing."""
    key, other = P.derive_key(DEMO_SECRET, DEMO_SALT), P.derive_key("another-secret", DEMO_SALT)
    path = scratch_dir(spark, "protect_roundtrip")
    mart = M.customer_mart(*star_inputs(spark, d))
    stored = P.protect(P.protect(mart, ["phone_number"], key), ["address"], key, "CBC", DEMO_IV)
    write_parquet(stored, path)
    back = spark.read.parquet(path).withColumns({"_phone": F.col("phone_number"), "_address": F.col("address")})
    texts = back.groupBy("_phone").agg(F.count(F.lit(1)).alias("_uses"))          # a GCM text occurs once
    known = P.reveal(P.reveal(back, ["phone_number"], key), ["address"], key, "CBC", DEMO_IV)
    forms = known.groupBy("address").agg(F.min("_address").alias("_least"), F.max("_address").alias("_most"))
    out = known.join(texts, "_phone").join(forms, "address")
    return out.select(
        *M.CUSTOMER_MART_COLUMNS,
        (F.col("_phone") != F.col("phone_number")).alias("phone_hidden"),
        (F.col("_address") != F.col("address")).alias("address_hidden"),
        (F.col("_least") == F.col("_most")).alias("same_address_same_text"),
        (F.col("_uses") == 1).alias("same_phone_other_text"),
        P.decrypt("_phone", other).isNull().alias("wrong_key_is_null"))
