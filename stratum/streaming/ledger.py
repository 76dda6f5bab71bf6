"""The keys a deduplicated sink holds, kept so that a batch reads few of them.

Keys lie in parts, one a batch, and in a part by the first bits of their hash. Each of those files has a Bloom
filter: bitmaps of 32,768 bits, one for about BITS keys' worth of them, in which a key sets PROBES bits. A batch probes
the filters of its own prefixes and reads only files that may hold one of its keys; a key that is new to the sink
hits a foreign file by chance only (about 1 in 250). TIER parts of a size class are merged into one of the next, so
there are few parts however many batches came, and a key is rewritten a logarithmic number of times.

A manifest row names the parts of a version and is written last; a part is overwritten when its batch is retried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX_BITS = 6     # 64 files a part
BITS = 16           # bits of a filter for each key
PROBES = 5          # bits that a key sets
MAP = 1 << 15       # bits of one bitmap
TIER = 8            # parts of a size class that are merged

_MANIFEST = "version long, parts array<struct<name: string, tier: int>>"


class KeyLedger:
    """Keys (columns ``keys`` of ``schema``) under ``path``; NULL is a key like any other."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]):
        self.spark, self.path, self.keys = spark, path, list(keys)
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema if f.name in self.keys])

    def _hashed(self, df: DataFrame) -> DataFrame:
        cols = [F.col(f"`{k}`") for k in self.keys]
        h, h2 = F.xxhash64(F.lit(0), F.struct(*cols)), F.xxhash64(F.lit(1), F.struct(*cols))
        return df.withColumn("_h", h).withColumn("_h2", h2).withColumn("_prefix", F.shiftrightunsigned("_h", 64 - PREFIX_BITS).cast("int"))

    @staticmethod
    def _bits() -> Column:
        """The places a key sets within its bitmap, 15 bits of hash each."""
        return F.array(*[F.xxhash64("_h2", F.lit(i)).bitwiseAND(F.lit(MAP - 1)) for i in range(PROBES)])

    def parts(self) -> tuple[int, list[tuple[str, int]]]:
        """The newest version and its parts with their size classes; (0, []) before the first."""
        rows = self.spark.read.schema(_MANIFEST).json(f"{self.path}/manifest").orderBy(F.desc("version")).first()
        return (rows["version"], [(p["name"], p["tier"]) for p in rows["parts"]]) if rows else (0, [])

    def create(self) -> KeyLedger:
        """An empty ledger, if there is none yet."""
        self.spark.createDataFrame([], _MANIFEST).write.mode("append").json(f"{self.path}/manifest")
        return self

    def _commit(self, version: int, parts: list[tuple[str, int]]) -> None:
        self.spark.createDataFrame([(version, parts)], _MANIFEST).coalesce(1).write.mode("append").json(f"{self.path}/manifest")

    def _write(self, name: str, keys: DataFrame) -> None:
        """A part from distinct hashed keys: the keys by prefix, and their filters."""
        keys.repartition("_prefix").sortWithinPartitions("_prefix").write.mode("overwrite").partitionBy("_prefix").parquet(f"{self.path}/keys/{name}")
        rows = self.spark.read.schema(T.StructType([*self._stored(), T.StructField("_prefix", T.IntegerType())])).parquet(f"{self.path}/keys/{name}")
        maps = rows.groupBy("_prefix").agg(F.ceil(F.count("*") * BITS / MAP).cast("long").alias("maps"))  # one row a prefix
        rows = rows.join(F.broadcast(maps), "_prefix").withColumn("map", F.pmod(F.shiftrightunsigned("_h", 8), F.col("maps")))
        rows = rows.select("_prefix", "maps", "map", F.explode(self._bits()).alias("bit"))
        filters = rows.groupBy("_prefix", "maps", "map").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
        filters.withColumn("name", F.lit(name)).write.mode("overwrite").parquet(f"{self.path}/filters/{name}")

    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema, T.StructField("_h", T.LongType()), T.StructField("_h2", T.LongType())])

    def _keys(self, files: list[tuple[str, int]]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self._stored())
        return self.spark.read.schema(self._stored()).parquet(*[f"{self.path}/keys/{name}/_prefix={p}" for name, p in files])

    def files_for(self, keys: DataFrame, without: str | None = None) -> list[tuple[str, int]]:
        """The (part, prefix) files that may hold one of the hashed ``keys``: at most the parts times 64."""
        names = [n for n, _ in self.parts()[1] if n != without]
        if not names:
            return []
        filters = self.spark.read.schema("_prefix int, maps long, map long, bitmap binary, name string").parquet(
            *[f"{self.path}/filters/{n}" for n in names])
        # as many bitmaps as the filter has decide which one a key is in
        counts = filters.select("name", "_prefix", "maps").distinct()
        asked = keys.select("_prefix", "_h", "_h2").join(F.broadcast(counts), "_prefix")  # at most the parts times 64 rows
        asked = asked.withColumn("map", F.pmod(F.shiftrightunsigned("_h", 8), F.col("maps"))).withColumn("bits", self._bits())
        hit = asked.join(filters.select("name", "_prefix", "map", "bitmap"), ["name", "_prefix", "map"]).where(F.forall("bits", lambda b: F.getbit(
            F.conv(F.hex(F.substring(F.col("bitmap"), (F.shiftright(b, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int"),
            b.bitwiseAND(F.lit(7)).cast("int")) == 1))
        return [(r["name"], r["_prefix"]) for r in hit.select("name", "_prefix").distinct().collect()]

    def unseen(self, batch: DataFrame, without: str | None = None) -> DataFrame:
        """One row of ``batch`` for each key that the ledger does not hold (in a part other than ``without``)."""
        rows = self._hashed(batch.dropDuplicates(self.keys))
        seen = self._keys(self.files_for(rows, without))
        same = [F.col("a._h") == F.col("b._h"), F.col("a._h2") == F.col("b._h2"),
                *[F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in self.keys]]
        return rows.alias("a").join(seen.alias("b"), same, "left_anti").drop("_h", "_h2", "_prefix")

    def add(self, name: str, rows: DataFrame) -> None:
        """Adds the keys of ``rows`` (distinct, new) as part ``name``; a retried part replaces itself."""
        version, parts = self.parts()
        self._write(name, self._hashed(rows.select(*[F.col(f"`{k}`") for k in self.keys])))
        self._commit(version + 1, [*[p for p in parts if p[0] != name], (name, 0)])

    def merge(self) -> None:
        """Merges size classes with TIER parts or more."""
        version, parts = self.parts()
        tier = 0
        while tier <= max((t for _, t in parts), default=-1):
            same = [n for n, t in parts if t == tier]
            if len(same) >= TIER:
                version += 1
                name = f"merged-{version}"
                keys = self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(*[f"{self.path}/keys/{n}" for n in same])
                self._write(name, self._hashed(keys.select(*[F.col(f"`{k}`") for k in self.keys])))
                parts = [*[p for p in parts if p[0] not in same], (name, tier + 1)]
                self._commit(version, parts)
            tier += 1
