"""Document fingerprints: canonical exact digests.

A text is normalised (NFKC), case-folded, and its white space collapsed; the
fingerprint is the 128-bit xxh3 of the result. `grouped` collects equal
digests and compares the bytes of the canonical texts inside each group, so that
two texts share a group only if their canonical forms are equal.
"""

from __future__ import annotations

import hashlib
import math
import unicodedata

import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def canonical(text: str) -> str:
    """NFKC, case-folded, NFKC again, runs of white space as one space, none at the ends."""
    if text.isascii():
        return " ".join(text.lower().split())
    folded = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(folded.split())


def digest(text: str) -> str:
    return xxhash.xxh3_128_hexdigest(canonical(text).encode("utf-8", "surrogatepass"))


def fingerprints(docs: DataFrame, hexdigest=xxhash.xxh3_128_hexdigest) -> DataFrame:
    """doc_id, text, fingerprint of every row; null texts count as empty."""

    def run(batches):
        for batch in batches:
            texts = [x.decode() for x in common.texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), pa.array([hexdigest(canonical(x).encode()) for x in texts], pa.string())], ["doc_id", "text", "fingerprint"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, text string, fingerprint string")


def shared_groups(docs: DataFrame, prints: DataFrame, hexdigest=xxhash.xxh3_128_hexdigest) -> DataFrame:
    """doc_id, group_id of the documents whose digest occurs again among prints (doc_id, fingerprint; settled): the smallest doc_id with the same canonical bytes.

    Digests are counted first; only documents of digests that occur again are normalised once more, and their canonical
    texts aggregated by digest and bytes with partial aggregation, so a group of any size sends one text
    from each task, and texts that share a digest but not their bytes fall apart. Null ids are in no group.
    """
    again = common.settled(prints.groupBy("fingerprint").agg(F.count("*").alias("n")).where("n > 1").select("fingerprint"))
    ids = common.settled(prints.where(F.col("doc_id").isNotNull()).join(common.maybe_broadcast(again), "fingerprint", "left_semi").select("doc_id").distinct())
    few = docs.select("doc_id", "text").join(common.maybe_broadcast(ids), "doc_id", "left_semi")

    def run(batches):
        for batch in batches:
            c = [canonical(x.decode()).encode() for x in common.texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([hexdigest(x) for x in c], pa.string()), pa.array(c, pa.binary())], ["doc_id", "fingerprint", "whole"])

    whole = few.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fingerprint string, whole binary")
    least = whole.groupBy("fingerprint", "whole").agg(F.min("doc_id").alias("group_id"), F.count("*").alias("n")).where("n > 1").select("fingerprint", F.sha2("whole", 256).alias("proof"), "group_id")
    least = common.settled(least)
    mine = whole.select("doc_id", "fingerprint", F.sha2("whole", 256).alias("proof"))
    return mine.join(common.maybe_broadcast(least), ["fingerprint", "proof"]).groupBy("doc_id").agg(F.min("group_id").alias("group_id"))


def grouped(docs: DataFrame, hexdigest=xxhash.xxh3_128_hexdigest) -> DataFrame:
    """doc_id, fingerprint, group_id of every row: the smallest doc_id with the same canonical bytes.

    Equal rows share a group; rows of null doc_id have a null group. Rows of one id with
    different texts share the least group of them.
    """
    prints = common.settled(fingerprints(docs, hexdigest).select("doc_id", "fingerprint"))
    shared = common.settled(shared_groups(docs, prints, hexdigest))
    return prints.join(common.maybe_broadcast(shared), "doc_id", "left").withColumn("group_id", F.coalesce("group_id", "doc_id"))


def with_next(rows: DataFrame, fn, schema: str) -> DataFrame:
    """fn(doc_id, text, fingerprint, next text, next fingerprint) -> row, for every row of (doc_id, text, fingerprint) and the one that follows it in ascending doc_id; after the last comes the first.

    The ids are cut into as many ranges as there are shuffle partitions, at
    quantiles; rows of null id come before all others and, having no id to cut at, are dealt by a hash of their text. Each range's first
    row is also sent to the range before it, so a range is complete in itself and texts are shuffled once.
    Equal ids are ordered by text, null ids by the hash and then the text.
    """
    spark = rows.sparkSession
    n = common.partitions(spark)
    # null ids: negative ranges, one for each slice of hashes; ids: ranges from 0 on
    key = F.col("doc_id").cast("long")
    cuts = sorted(set(rows.where(F.col("doc_id").isNotNull()).select(key.alias("key")).approxQuantile("key", [i / n for i in range(1, n)], 0.2 / n))) if n > 1 else []
    keyed = rows.select(F.col("doc_id").isNull().alias("lost"), F.coalesce(key, F.xxhash64("text")).alias("key"), "text", "fingerprint")
    if cuts:
        keyed = keyed.withColumn("at", F.when(F.col("lost"), 0.0).otherwise(F.col("key").cast("double")))
        keyed = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="at", outputCol="range").transform(keyed).drop("at")
    else:
        keyed = keyed.withColumn("range", F.lit(0.0))
    keyed = keyed.withColumn("bucket", F.when(F.col("lost"), F.floor(F.col("key") / F.lit(2.0**64 / n)) - n).otherwise(F.col("range")).cast("int"))
    found = keyed.groupBy("bucket").agg(F.min("key").alias("first"), F.min_by("lost", "key").alias("lost")).collect()  # two rows for each shuffle partition at most
    if not found:
        return spark.createDataFrame([], schema)
    found.sort()
    # a small table: the range before each one, whose last row needs this one's first
    before = spark.createDataFrame([(r.bucket, r.first, p.bucket) for p, r in zip([found[-1], *found[:-1]], found)], "bucket int, key long, before int")
    heads = keyed.join(F.broadcast(before), ["bucket", "key"]).groupBy("before", "key", "bucket").agg(F.min(F.struct("text", "fingerprint")).alias("x"))
    heads = heads.select(F.col("before").alias("bucket"), F.lit(1).alias("s"), F.lit(False).alias("lost"), "key", "x.text", "x.fingerprint")
    sent = keyed.select("bucket", F.lit(0).alias("s"), "lost", "key", "text", "fingerprint").unionByName(heads)
    dealt = sent.repartitionById(2 * n, F.col("bucket") + n).sortWithinPartitions("bucket", "s", "key", "text")

    def run(batches):
        import pandas as pd

        out, held, at = [], None, None
        for pdf in batches:
            for b, s, lost, k, t, f in zip(*(pdf[c] for c in ("bucket", "s", "lost", "key", "text", "fingerprint"))):
                if held is not None and b == at:
                    out.append(fn(*held, t, f))
                if s:  # the range is complete
                    held = None
                    continue
                held, at = (None if lost else k, t, f), b
            if out:
                yield pd.DataFrame(out, columns=names).astype({names[0]: "Int64"})
                out = []

    names = [x.split()[0] for x in schema.split(", ")]
    return dealt.mapInPandas(run, schema)


def compared(docs: DataFrame) -> DataFrame:
    """Each text's fingerprint beside those of its edited text and of the next document.

    Edited: the last floor(n_chars / 2) code points give way to the first as many of the next
    document. Likeness of exact digests is 1 or 0. Null and empty texts are empty.
    """

    def row(key, text, own, following, other):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        changed = digest(edited)
        return key, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, changed, float(own == changed), float(own == other)

    return with_next(fingerprints(docs), row, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op10(spark, sf_dir):
    """The comparison of every document, with the verified group of its fingerprint.

    Null and empty texts are empty. Repeated rows have a row each; rows of equal id follow each other in order of their texts, rows
    of null id come first, in order of a hash of their texts, and have no group. An empty table gives no rows. Other columns are not read.
    """
    docs = common.table(spark, sf_dir, "documents")
    found = common.settled(compared(docs))
    groups = common.settled(shared_groups(docs, found.select("doc_id", "fingerprint")))
    return found.join(common.maybe_broadcast(groups), "doc_id", "left").withColumn("group_id", F.coalesce("group_id", "doc_id"))
