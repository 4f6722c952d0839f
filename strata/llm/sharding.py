"""Sharding by extendible hashing.

A document belongs to the bucket named by the leading bits of its hash. The directory
starts with one bucket; only a bucket above the byte limit is split on its next bit,
until every shard fits. Buckets are not split one by one: one aggregation counts bytes
for cells some bits finer than needed, their sums give every bucket of every depth
above, and a bucket is a shard if it fits and the one it was split from does not. Cells
that are still too large go into another round on their own rows.

The directory is an index by the leading bits with, in each entry, the shards that share
those bits. Documents meet it in one join on the index, whose keys are evenly spread
because the hash is of the id: copies of a text have different ids, so neither a large
source nor a large group of copies makes a bucket hot.

Defined cases: a NULL text has 0 bytes; NULL ids hash as the empty text; a bucket whose
rows all have one hash cannot be split (one document above the limit, or repeated rows of
one id) and becomes a shard of its own marked ``oversized``; an empty table gives an empty
directory and result; other columns pass through ``with_shards``, ahead of the shard's
own columns, which replace columns of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import cut_lineage

SHARD_BYTES = 1 << 20  # set for the given tables; shards in an object store take some 100 MB
HASH_BITS = 60
ROUND_BITS = 16  # at most 65,536 cells are counted at once below each open bucket
SHARD_COLUMNS = ("shard", "shard_bits", "shard_bytes", "shard_rows", "oversized")


def id_hash(doc_id: Column) -> Column:
    """60 bits of the id's MD5, which any SQL engine can repeat."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def _prefix(bits: int) -> Column:
    return F.shiftright("h", HASH_BITS - bits) if bits else F.lit(0).cast("long")


def directory(rows: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """Shards of rows ``h, bytes``: ``bits, prefix, bytes, rows, oversized``."""
    total = rows.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    step = min(ROUND_BITS, max(1, math.ceil(math.log2(max(1, total / limit)))) + 4)
    shards, base, open_rows = None, 0, rows
    while True:
        top = min(HASH_BITS, base + step)
        cells = open_rows.groupBy(_prefix(top).alias("cell")).agg(
            F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"),
            F.min("h").alias("low"), F.max("h").alias("high"))
        buckets = cells.select("*", F.explode(F.sequence(F.lit(base), F.lit(top))).alias("bits"))
        buckets = buckets.groupBy(
            "bits", F.expr(f"shiftright(cell, {top} - bits)").alias("prefix")).agg(
            F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"),
            (F.min("low") == F.max("high")).alias("single"))
        buckets = cut_lineage(buckets.withColumn("fits", (F.col("bytes") <= limit) | F.col("single")), "buckets")
        split = buckets.filter(~F.col("fits")).select(
            (F.col("bits") + 1).alias("bits"), F.col("prefix").alias("parent"))
        whole = buckets.filter("fits").withColumn("parent", F.shiftright("prefix", 1))
        fit = whole.join(split, ["bits", "parent"], "left_semi")
        if base == 0:
            fit = fit.unionByName(whole.filter("bits = 0"))
        fit = fit.select(
            "bits", "prefix", "bytes", "rows", (F.col("bytes") > limit).alias("oversized"))
        shards = fit if shards is None else shards.unionByName(fit)
        left = buckets.filter(~F.col("fits") & (F.col("bits") == top)).select(F.col("prefix").alias("__open"))
        if top == HASH_BITS or left.isEmpty():
            return shards
        open_rows = open_rows.join(left, _prefix(top) == F.col("__open"), "left_semi")
        base, step = top, ROUND_BITS


def index_entries(shards: DataFrame, index_bits: int) -> DataFrame:
    """``entry, shards``: for each value of the leading bits the shards that share them."""
    entry = F.when(
        F.col("bits") <= index_bits,
        F.sequence(F.expr(f"shiftleft(prefix, greatest({index_bits} - bits, 0))"),
                   F.expr(f"shiftleft(prefix + 1, greatest({index_bits} - bits, 0)) - 1")),
    ).otherwise(F.array(F.expr(f"shiftright(prefix, greatest(bits - {index_bits}, 0))")))
    name = F.when(F.col("bits") == 0, F.lit("")).otherwise(
        F.expr("lpad(bin(prefix), bits, '0')"))
    leaf = F.struct(
        F.expr(f"shiftleft(prefix, {HASH_BITS} - bits)").alias("low"),
        F.expr(f"shiftleft(prefix + 1, {HASH_BITS} - bits)").alias("end"),
        name.alias("shard"), F.col("bits").alias("shard_bits"), F.col("bytes").alias("shard_bytes"),
        F.col("rows").alias("shard_rows"), "oversized")
    return shards.select(F.explode(entry).alias("entry"), leaf.alias("leaf")).groupBy("entry").agg(
        F.collect_list("leaf").alias("shards"))


def with_shards(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """``docs`` with the shard of every row: its bits as text, their number, bytes and rows."""
    sizes = cut_lineage(
        docs.select(id_hash(F.col("doc_id")).alias("h"), text_bytes(F.col("text")).alias("bytes")), "shard-sizes")
    shards = cut_lineage(directory(sizes, limit), "directory")
    index_bits = min(20, max(1, shards.count()).bit_length() + 1)
    entries = index_entries(shards, index_bits)
    kept = [c for c in docs.columns if c not in SHARD_COLUMNS]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("__row"),
                       id_hash(F.col("doc_id")).alias("h"))
    placed = rows.join(entries, _prefix(index_bits) == F.col("entry")).select(
        "__row", F.get(F.filter("shards", lambda s: (s["low"] <= F.col("h")) & (F.col("h") < s["end"])),
                       F.lit(0)).alias("__shard"))
    return placed.select("__row.*", *[F.col(f"__shard.{c}").alias(c) for c in SHARD_COLUMNS])


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, ``b`` and its bits; a shard goes to one writer, which its limit bounds."""
    named = sharded.withColumn("shard", F.concat(F.lit("b"), F.col("shard")))
    named.repartition("shard").write.mode("overwrite").partitionBy("shard").parquet(path)
