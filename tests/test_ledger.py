"""The key ledger of deduplicated sinks: exact answers, retries, merges, and few files read."""

from pyspark.sql import functions as F

from stratum.session import shared_dir
from stratum.streaming import ledger as L

DDL = "a long, b string, x int"


def batch(spark, ids):
    return spark.createDataFrame([(None if i % 50 == 49 else i, "odd" if i % 2 else None, 1) for i in ids], DDL)


def ledger(spark):
    schema = spark.createDataFrame([], DDL).schema
    return L.KeyLedger(spark, shared_dir(spark, "ledger"), schema, ["a", "b"]).create()


def key(r):
    return r.a, r.b


def test_every_key_is_told_once(spark, monkeypatch):
    """Repeats within and between batches, NULL keys, merges of parts and of merged parts, retried batches."""
    monkeypatch.setattr(L, "TIER", 2)
    led, held = ledger(spark), set()
    for n, ids in enumerate([range(60), range(40, 120), [3, 3, 3, 500], range(0), range(100, 160), range(700)]):
        rows = batch(spark, ids)
        for _ in range(2):  # the second time as a retry
            new = led.unseen(rows, f"p{n}")
            got = [key(r) for r in new.collect()]
            assert len(got) == len(set(got)) and set(got) == {key(r) for r in rows.collect()} - held
            led.add(f"p{n}", new)
        held |= set(got)
        assert led.unseen(rows).count() == 0
        led.merge()
    tiers = [t for _, t in led.parts()[1]]
    assert max(tiers) >= 2 and len(tiers) <= 3
    again = L.KeyLedger(spark, led.path, led.schema, ["a", "b"])
    assert {key(r) for r in again.unseen(batch(spark, range(900))).collect()} == {key(r) for r in batch(spark, range(900)).collect()} - held


def test_files_read_stay_few_as_history_grows(spark):
    led, read = ledger(spark), []
    for n in range(12):
        rows = spark.range(n * 3000, n * 3000 + 3000).select(F.col("id").alias("a"), F.lit("k").alias("b"), F.lit(1).alias("x"))
        probe = led._hashed(spark.createDataFrame([(-1 - n * 20 - i, "new", 1) for i in range(20)], DDL))
        read.append(len(led.files_for(probe)))
        led.add(f"p{n}", rows)
        led.merge()
    assert len(led.parts()[1]) < 12 and max(read) <= 3, read
    known = led._hashed(spark.createDataFrame([(17, "k", 1)], DDL))
    assert 1 <= len(led.files_for(known)) <= 2
