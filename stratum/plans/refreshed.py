"""Marts that a refresh rewrites only where their inputs changed.

A mart is kept in buckets of its key. For every bucket the manifest holds a fingerprint of the inputs'
rows in it (their number and two sums of row hashes, whatever their order) and the version that last wrote it.
A refresh computes the fingerprints, builds and writes only buckets that differ, and ends with a new manifest
row; a refresh that fails before that leaves the mart as it was. Where an input is itself such a mart, its versions are
the fingerprints, so nothing of it is read for buckets that stayed the same. The builder must treat keys apart: what
it makes for a key may depend on that key's input rows alone.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.session import shared_dir

BUCKETS = 64

_MANIFEST = "version int, schema string, buckets array<struct<bucket: int, version: int, rows: boolean, print: string>>"


class RefreshedMart:
    """A mart under ``path``, in buckets by a hash of ``key``; nullable keys have a bucket, too."""

    def __init__(self, spark: SparkSession, name: str, path: str | None = None, key: str = "ticker", buckets: int = BUCKETS):
        self.spark, self.name, self.key, self.buckets = spark, name, key, buckets
        self.path = path or shared_dir(spark, f"mart-{name}")
        if path is None:
            self._commit(0, None, {})

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(f"`{self.key}`").cast("string")), F.lit(self.buckets)).cast("int")

    def _commit(self, version: int, schema: T.StructType | None, held: dict[int, tuple[int, bool, str]]) -> None:
        row = (version, schema and schema.json(), [(b, *x) for b, x in sorted(held.items())])
        self.spark.createDataFrame([row], _MANIFEST).coalesce(1).write.mode("append").json(f"{self.path}/manifest")

    def manifest(self) -> tuple[int, T.StructType | None, dict[int, tuple[int, bool, str]]]:
        """The newest version, the mart's schema, and for each bucket its version, whether it has rows, and its fingerprint."""
        r = self.spark.read.schema(_MANIFEST).json(f"{self.path}/manifest").orderBy(F.desc("version")).first()
        schema = T.StructType.fromJson(json.loads(r["schema"])) if r["schema"] else None
        return r["version"], schema, {x["bucket"]: (x["version"], x["rows"], x["print"]) for x in r["buckets"]}

    def table(self, only: list[int] | None = None) -> DataFrame:
        """The mart's rows, of all buckets or some."""
        _, schema, held = self.manifest()
        if schema is None:
            raise ValueError(f"{self.name} has never been refreshed")
        paths = [f"{self.path}/version-{v}/_bucket={b}" for b, (v, rows, _) in held.items() if rows and (only is None or b in only)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _prints(self, inputs: Mapping[str, DataFrame | RefreshedMart]) -> dict[int, str]:
        """For each bucket with input rows, the fingerprint of all inputs in it."""
        found: dict[int, dict[str, str]] = {}
        for name, df in inputs.items():
            if isinstance(df, RefreshedMart):
                if (df.key, df.buckets) != (self.key, self.buckets):
                    raise ValueError(f"{df.name} has other buckets than {self.name}")
                told = {b: f"v{v}" for b, (v, rows, _) in df.manifest()[2].items() if rows}
            else:
                h, h2 = F.xxhash64(F.struct("*")), F.xxhash64(F.lit(1), F.struct("*"))
                rows = df.select(self._bucket().alias("b"), h.cast("decimal(38,0)").alias("h"), h2.cast("decimal(38,0)").alias("h2"))
                sums = rows.groupBy("b").agg(F.concat_ws(":", F.count("*"), F.sum("h"), F.sum("h2")).alias("p"))
                told = {r["b"]: r["p"] for r in sums.collect()}  # one row a bucket
            for b, p in told.items():
                found.setdefault(b, {})[name] = p
        return {b: json.dumps(p, sort_keys=True) for b, p in found.items()}

    def refresh(self, inputs: Mapping[str, DataFrame | RefreshedMart], build: Callable[..., DataFrame]) -> list[int]:
        """Brings the mart up to date; returns the buckets that were written (or went)."""
        now = self._prints(inputs)
        version, schema, held = self.manifest()
        todo = sorted(b for b, p in now.items() if b not in held or held[b][2] != p)
        gone = sorted(held.keys() - now.keys())
        if schema is not None and not todo and not gone:
            return []
        version += 1
        parts = {n: df.table(todo) if isinstance(df, RefreshedMart) else df.where(self._bucket().isin(todo)) for n, df in inputs.items()}
        out = build(**parts)
        path = f"{self.path}/version-{version}"
        out.withColumn("_bucket", self._bucket()).write.mode("overwrite").partitionBy("_bucket").parquet(path)
        some = {r[0] for r in self.spark.read.schema(T.StructType([*out.schema, T.StructField("_bucket", T.IntegerType())]))
                .parquet(path).select("_bucket").distinct().collect()}  # at most the buckets
        held = {b: x for b, x in held.items() if b in now} | {b: (version, b in some, now[b]) for b in todo}
        self._commit(version, T.StructType([T.StructField(f.name, f.dataType) for f in out.schema]), held)
        return todo + gone
