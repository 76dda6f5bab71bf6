"""One large array file read in parts equals the read of the whole."""

import json
import random

import pytest
from pyspark.sql import types as T

from stratum.session import shared_dir
from stratum.sources import io as IO

DDL = "name string, n bigint, config struct<a: string, deep: struct<b: string>>, tags array<struct<k: string>>"


def schema():
    return T.StructType.fromDDL(DDL)


ODD = ['plain', 'a "quoted" one', 'brace } in { text', 'back\\slash', 'ends with \\', '\\"} {', '"', '}', '{{', ',[{', 'née 漢 🙂', '', 'line\nbreak', '"endpoints":[']


def records(n, seed=0):
    rng = random.Random(seed)
    return [{"name": rng.choice(ODD), "n": i, "config": rng.choice([None, {}, {"a": rng.choice(ODD), "deep": {"b": rng.choice(ODD)}}]),
             "tags": [{"k": rng.choice(ODD)} for _ in range(rng.randint(0, 3))]} for i in range(n)]


def land(spark, texts):
    path = shared_dir(spark, "inventory-test")
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "part int, value string").repartition("part").write.partitionBy("part").text(path)
    return path


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("wrapped", [False, True])
def test_split_read_equals_the_whole_read(spark, indent, wrapped):
    rows = records(300)
    text = json.dumps({"endpoints": rows} if wrapped else rows, indent=indent, ensure_ascii=False)
    path = land(spark, [text])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
        assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 10
        got = IO.read_inventory_split(spark, path, schema()).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    whole = IO.read_inventory(spark, path, schema()).collect()
    assert sorted(got, key=lambda r: r.n) == sorted(whole, key=lambda r: r.n) and len(got) == 300
    assert [r.name for r in sorted(got, key=lambda r: r.n)] == [r["name"] for r in rows]


def test_several_files_and_empty_lists(spark):
    a, b = records(3, 1), [{"name": "x", "n": 9}]
    path = land(spark, [json.dumps(a), "[]", ' { "endpoints" : [] }\n', json.dumps({"endpoints": b}) + "\n", " [ ] "])
    got = IO.read_inventory_split(spark, path, schema()).collect()
    assert sorted((r.n, r.name) for r in got) == sorted((r["n"], r["name"]) for r in a + b)
