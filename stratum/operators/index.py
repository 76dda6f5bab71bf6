"""An inverted index that syncs extend (J5) and retrieval reads.

The index is a folder of segments. A segment holds the texts one sync brought:

* ``docs``: (key, fingerprint) of every text, ``n_chunks`` with it;
* ``forward``: (key, chunk_id, terms), the term counts of every paragraph;
* ``blocks``: the postings of a term, most frequent first, in blocks of BLOCK with their
  number, largest and smallest count.

A sync compares the source with the live texts by key and fingerprint, writes a segment
of what is new or changed, and a table of tombstones (segment, key) for what went or changed.
A chunk's terms are counted where the chunk is; postings are shuffled once, in lists of equal
term and count, and cut into blocks where they arrive. A sync reads its source twice.
Beyond MERGE segments they are merged into one from their forward tables, without a look at the texts.
A version of the index is one manifest row that names its tables; it is written last, so a sync
that fails leaves the version before it in place, and a repeated sync finds nothing to do.

Retrieval takes the question terms' block heads (no postings) for document frequencies and for the
counts that nearly all postings stay within, reads only blocks whose largest count can matter,
and scores candidates from the forward table. Its answers are those of ``documents.retrieve``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratum.operators import timeseries as ts
from stratum.operators.documents import chunks, tokens
from stratum.session import shared_dir, written

BLOCK = 128  # postings in a block
MERGE = 8    # segments beyond which a sync merges them

_MANIFEST = "version int, segments array<int>, tombstones array<int>"


Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _put(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def _term_counts(parts: DataFrame, key_type: str) -> DataFrame:
    """(key, chunk_id, terms) of chunks (key, chunk_id, chunk): each chunk's terms with their numbers, counted where the chunk is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = pc.dictionary_encode(batch.column(2).flatten())
            chunk = pc.list_parent_indices(batch.column(2)).to_numpy().astype("int64")
            width = max(len(words.dictionary), 1)
            pairs, tf = np.unique(chunk * width + words.indices.to_numpy(), return_counts=True)
            starts = np.searchsorted(pairs, np.arange(batch.num_rows + 1, dtype="int64") * width)
            terms = pa.StructArray.from_arrays([words.dictionary.take(pa.array(pairs % width)), pa.array(tf, pa.int64())], ["term", "tf"])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(starts, pa.int32()), terms)],
                                             names=["key", "chunk_id", "terms"])

    return parts.select("key", "chunk_id", tokens("chunk").alias("words")).mapInArrow(
        run, f"key {key_type}, chunk_id int, terms array<struct<term: string, tf: bigint>>")


def _cuts(new: np.ndarray, size: int) -> np.ndarray:
    """Where pieces begin, and the end: at every true value (the first is one), and after ``size`` rows of a piece."""
    at = np.arange(len(new))
    return np.append(np.flatnonzero((at - np.maximum.accumulate(np.where(new, at, 0))) % size == 0), len(new))


def _lists(block: int, together: int = 1 << 20) -> Batches:
    """Chunks (key, chunk_id, terms) -> (term, tf, keys, chunk_ids): about ``together`` postings at a time meet by term and
    count, ``block`` in a list at most, so that the shuffle carries a term once for many of its postings."""
    def meet(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        key, chunk_id, terms = rows.columns
        flat = terms.flatten()
        words, tf = pc.dictionary_encode(flat.field("term")), flat.field("tf").to_numpy()
        word = words.indices.to_numpy()
        order = np.lexsort((-tf, word))
        word, tf, row = word[order], tf[order], pc.list_parent_indices(terms).take(pa.array(order))
        cuts = _cuts(np.append(True, (word[1:] != word[:-1]) | (tf[1:] != tf[:-1])), block)
        offsets = pa.array(cuts, pa.int32())
        return pa.RecordBatch.from_arrays(
            [words.dictionary.take(pa.array(word[cuts[:-1]])), pa.array(tf[cuts[:-1]]),
             pa.ListArray.from_arrays(offsets, key.take(row)), pa.ListArray.from_arrays(offsets, chunk_id.take(row))],
            names=["term", "tf", "keys", "chunk_ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            found = len(batch.column(2).flatten())
            if found:
                held.append(batch)
                n += found
            if n >= together:
                yield meet(held)
                held, n = [], 0
        if held:
            yield meet(held)
    return run


def _blocks(block: int) -> Batches:
    """Lists in order of term and count -> (term, n, top, low, postings), ``block`` postings in a block at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            term, tf, keys, chunk_ids = batch.columns
            row = pc.list_parent_indices(keys).to_numpy()
            new = np.append(True, pc.not_equal(term[1:], term[:-1]).to_numpy(zero_copy_only=False))
            first = np.append(True, row[1:] != row[:-1])  # of its list
            cuts = _cuts(first & new[row], block)
            counts = tf.to_numpy()[row]
            postings = pa.StructArray.from_arrays([pa.array(counts), keys.flatten(), chunk_ids.flatten()], ["tf", "key", "chunk_id"])
            yield pa.RecordBatch.from_arrays(
                [term.take(pa.array(row[cuts[:-1]])), pa.array(np.diff(cuts), pa.int64()), pa.array(counts[cuts[:-1]]),
                 pa.array(counts[cuts[1:] - 1]), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), postings)],
                names=["term", "n", "top", "low", "postings"])
    return run


class TextIndex:
    """An index under ``path``; keys are unique in a source, of the type ``key_type``."""

    def __init__(self, spark: SparkSession, path: str | None = None, key_type: str = "bigint"):
        self.spark, self.key_type = spark, key_type
        self.path = path or shared_dir(spark, "text-index")
        if path is None:
            self._commit(0, [], [])

    # --- versions and tables

    def _commit(self, version: int, segments: list[int], tombstones: list[int]) -> None:
        row = self.spark.createDataFrame([(version, segments, tombstones)], _MANIFEST)
        row.coalesce(1).write.mode("append").json(f"{self.path}/manifest")

    def manifest(self) -> tuple[int, list[int], list[int]]:
        """The newest version: its number, its segments and its tombstone tables."""
        rows = self.spark.read.schema(_MANIFEST).json(f"{self.path}/manifest")
        r = rows.orderBy(F.desc("version")).first()  # one row a sync
        return r["version"], list(r["segments"]), list(r["tombstones"])

    def _table(self, name: str, segments: list[int], ddl: str) -> DataFrame:
        if not segments:
            return self.spark.createDataFrame([], f"{ddl}, segment int")
        return self.spark.read.schema(f"{ddl}, segment int").parquet(*[f"{self.path}/segment-{n}/{name}" for n in segments])

    def _docs(self, segments):
        return self._table("docs", segments, f"key {self.key_type}, fingerprint string, n_chunks bigint")

    def _forward(self, segments):
        return self._table("forward", segments, f"key {self.key_type}, chunk_id int, terms array<struct<term: string, tf: bigint>>")

    def _blocks(self, segments):
        return self._table("blocks", segments, "term string, n bigint, top bigint, low bigint, "
                           f"postings array<struct<tf: bigint, key: {self.key_type}, chunk_id: int>>")

    def _dead(self, tombstones: list[int]) -> DataFrame | None:
        """(segment, key) that went; None where there are none."""
        if not tombstones:
            return None
        return self.spark.read.schema(f"segment int, key {self.key_type}").parquet(*[f"{self.path}/tombstones-{n}" for n in tombstones])

    @staticmethod
    def _alive(df: DataFrame, dead: DataFrame | None) -> DataFrame:
        return df if dead is None else df.join(dead, ["segment", "key"], "left_anti")

    def live(self) -> DataFrame:
        """(key, fingerprint, n_chunks, segment) of every text in the index."""
        _, segments, tombstones = self.manifest()
        return self._alive(self._docs(segments), self._dead(tombstones))

    # --- J5

    def _write_segment(self, n: int, docs: Callable[[DataFrame], DataFrame], forward: DataFrame) -> None:
        """A segment from (key, chunk_id, terms) and what makes (key, fingerprint, n_chunks) of that table."""
        base, number = f"{self.path}/segment-{n}", F.lit(n).alias("segment")  # a failed sync may have left its own behind
        _put(forward.select("key", "chunk_id", "terms", number), f"{base}/forward")
        forward = self._forward([n])
        _put(docs(forward).select("key", "fingerprint", "n_chunks", number), f"{base}/docs")
        lists = forward.select("key", "chunk_id", "terms").mapInArrow(
            _lists(BLOCK), f"term string, tf bigint, keys array<{self.key_type}>, chunk_ids array<int>")
        order = ["term", F.desc("tf"), F.col("keys")[0], F.col("chunk_ids")[0]]
        blocks = lists.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
            _blocks(BLOCK), f"term string, n bigint, top bigint, low bigint, postings array<struct<tf: bigint, key: {self.key_type}, chunk_id: int>>")
        _put(blocks.select("*", number), f"{base}/blocks")

    def sync(self, source: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """Brings the index to ``source`` (all current texts) and returns (status, n): added, changed, removed, kept."""
        version, segments, tombstones = self.manifest()
        texts = source.select(F.col(key).cast(self.key_type).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        now = written(texts.select("key", F.md5("text").alias("fingerprint")), "index-source")
        old = self.live().select("key", F.col("fingerprint").alias("before"), "segment")
        both = now.select("key", "fingerprint").join(old, "key", "full")
        status = (F.when(F.col("before").isNull(), "added").when(F.col("fingerprint").isNull(), "removed")
                  .when(F.col("before") == F.col("fingerprint"), "kept").otherwise("changed"))
        both = written(both.select("key", "segment", status.alias("status")), "index-status")
        counts = written(both.groupBy("status").agg(F.count("*").alias("n")), "index-counts")
        did = {r["status"]: r["n"] for r in counts.collect()}  # at most four rows
        fresh, version = version, version + 1
        if did.get("added") or did.get("changed"):
            fresh_keys = both.where("status IN ('added', 'changed')").select("key")
            new = texts.join(fresh_keys, "key", "left_semi") if did.get("kept") else texts.where("key IS NOT NULL")
            several = written(now.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "index-several")
            forward, apart = _term_counts(chunks(new, "key", "text"), self.key_type), None
            if not several.isEmpty():  # the chunks of a key's texts are one by their number
                apart = chunks(new.join(several, "key", "left_semi"), "key", "text")
                terms = _term_counts(apart, self.key_type).select("key", "chunk_id", F.explode("terms").alias("t"))
                terms = terms.groupBy("key", "chunk_id", "t.term").agg(F.sum("t.tf").alias("tf"))
                forward = forward.join(several, "key", "left_anti").unionByName(
                    terms.groupBy("key", "chunk_id").agg(F.sort_array(F.collect_list(F.struct("term", "tf"))).alias("terms")))

            def docs(forward: DataFrame) -> DataFrame:
                rows = forward if apart is None else forward.join(several, "key", "left_anti").select("key").union(apart.select("key"))
                n = rows.groupBy("key").agg(F.count("*").alias("n_chunks"))
                return now.join(fresh_keys, "key", "left_semi").join(n, "key", "left").withColumn(
                    "n_chunks", F.coalesce("n_chunks", F.lit(0).cast("bigint")))

            self._write_segment(version, docs, forward)
            segments = [*segments, version]
        if did.get("removed") or did.get("changed"):
            gone = both.where("status IN ('removed', 'changed')").select("segment", "key")
            gone.write.mode("overwrite").parquet(f"{self.path}/tombstones-{version}")
            tombstones = [*tombstones, version]
        if len(segments) > MERGE:
            segments, tombstones, version = self._merged(version + 1, segments, tombstones), [], version + 1
        if version != fresh and did.keys() - {"kept"}:
            self._commit(version, segments, tombstones)
        return counts

    def _merged(self, n: int, segments: list[int], tombstones: list[int]) -> list[int]:
        dead = self._dead(tombstones)
        self._write_segment(n, lambda _: self._alive(self._docs(segments), dead), self._alive(self._forward(segments), dead))
        return [n]

    # --- J6

    def retrieve(self, questions: DataFrame, k: int = 3, qkey: str = "item_id", qtext: str = "text", dkey: str = "doc_id",
                 probe_terms: int = 10) -> DataFrame:
        """(qkey, dkey, chunk_id, score, rank): the same answers as ``documents.retrieve`` over the live texts."""
        _, segments, tombstones = self.manifest()
        dead = self._dead(tombstones)
        forward, pair = self._forward(segments), ["segment", "key", "chunk_id"]
        qt = questions.select(F.col(qkey).alias("q"), F.explode(tokens(qtext)).alias("term")).groupBy("q", "term").agg(F.count("*").alias("qtf"))
        qt = written(qt, "question-terms")
        asked = qt.select("term").distinct()
        # heads: no postings are read for them
        heads = written(self._blocks(segments).select("term", "n", "top", "low").join(asked, "term", "left_semi")
                        .groupBy("term", "top", "low").agg(F.sum("n").alias("n")), "block-heads")
        df = heads.groupBy("term").agg(F.sum("n").alias("df"))
        n = self._docs(segments).agg(F.coalesce(F.sum("n_chunks"), F.lit(0)).alias("n_chunks"))
        if dead is not None:  # what tombstones take away, from their texts alone
            lost = written(forward.join(dead, ["segment", "key"], "left_semi").select(F.explode("terms.term").alias("term"))
                           .groupBy("term").agg(F.count("*").alias("lost")), "lost-terms")
            df = df.join(lost, "term", "left").select("term", (F.col("df") - F.coalesce("lost", F.lit(0))).alias("df")).where("df > 0")
            n = self._alive(self._docs(segments), dead).agg(F.coalesce(F.sum("n_chunks"), F.lit(0)).alias("n_chunks"))
        # a count that all but the first block or a thousandth of a term's postings stay within; one row for each kind of block
        upto = Window.partitionBy("term").orderBy(F.desc("top"), F.desc("low")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        usual = heads.withColumn("past", F.sum("n").over(upto) >= F.sum("n").over(Window.partitionBy("term")) / 1000).where(
            "past").groupBy("term").agg(F.max("low").alias("usual"))
        idf = df.crossJoin(F.broadcast(n)).withColumn("idf", F.log(F.col("n_chunks") / F.col("df"))).where("idf > 0").join(usual, "term")
        rarest = Window.partitionBy("q").orderBy("df", "term")
        weights = qt.join(idf, "term").select("q", "term", (F.col("qtf") * F.col("idf") * F.col("idf")).alias("w"), "df", "usual")
        weights = written(weights.withColumn("place", F.row_number().over(rarest)), "question-weights")

        def postings(terms: DataFrame) -> DataFrame:
            """Live postings of (term, least, columns): from blocks whose largest count is above ``least``."""
            blocks = self._blocks(segments).join(terms, "term").where(F.col("top") > F.col("least"))
            rest = [c for c in terms.columns if c not in ("term", "least")]
            flat = blocks.select("term", "segment", "least", *rest, F.explode("postings").alias("p")).where("p.tf > least")
            return self._alive(flat.select("term", "segment", *rest, "p.tf", "p.key", "p.chunk_id"), dead)

        def full_scores(pairs: DataFrame) -> DataFrame:
            hit = forward.join(pairs, pair).select("q", *pair, F.explode("terms").alias("t"))
            return hit.select("q", *pair, "t.term", "t.tf").join(weights.select("q", "term", "w"), ["q", "term"]) \
                .groupBy("q", *pair).agg(F.sum(F.col("tf") * F.col("w")).alias("score"))

        none = F.lit(0).cast("bigint").alias("least")
        partial = postings(weights.where(F.col("place") <= probe_terms).select("term", none, "q", "w")) \
            .groupBy("q", *pair).agg(F.sum(F.col("tf") * F.col("w")).alias("score"))
        likely = ts.top_n_per_key(partial, ["q"], [F.col("score").desc()], 10 * k).select("q", *pair)
        # the first postings of each term: only blocks whose first count is among the largest
        first = Window.partitionBy("term").orderBy(F.desc("top"), F.desc("low")).rowsBetween(Window.unboundedPreceding, -1)
        heads2 = heads.withColumn("before", F.coalesce(F.sum("n").over(first), F.lit(0))).where(F.col("before") < 2 * k)
        least = heads2.groupBy("term").agg((F.min("top") - 1).alias("least"))
        heavy = ts.top_n_per_key(postings(least), ["term"], [F.col("tf").desc()], 2 * k).join(weights, "term").select("q", *pair)
        probed = full_scores(written(likely.union(heavy).distinct(), "probes"))
        bound = ts.top_n_per_key(probed, ["q"], [F.col("score").desc()], k).groupBy("q").agg(
            F.when(F.count("*") >= k, F.min("score") * (1 - 1e-9) - 1e-6).otherwise(F.lit(0.0)).alias("bound"))
        common = Window.partitionBy("q").orderBy(F.desc("df"), "term").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        caps = weights.withColumn("_spent", F.sum(F.col("w") * F.col("usual")).over(common)).join(bound, "q").select(
            "q", "term", F.when(F.col("_spent") < F.col("bound"), F.col("usual")).otherwise(0).alias("cap"))
        caps = written(caps, "term-caps")
        over = postings(caps.groupBy("term").agg(F.min("cap").cast("bigint").alias("least")))
        candidates = over.join(caps, "term").where(F.col("tf") > F.col("cap")).select("q", *pair).distinct()
        scored = full_scores(written(candidates, "candidates")).withColumn("score", F.round("score", 9))
        found = ts.top_n_per_key(scored, ["q"], [F.col("score").desc(), F.col("key"), F.col("chunk_id")], k, "rank")
        return found.select(F.col("q").alias(qkey), F.col("key").alias(dkey), "chunk_id", "score", "rank")
