"""Extendible hashing: shards are hash-prefix buckets that split only where they exceed their byte limit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

HASH_BITS = 60


def key_hash(key: Column) -> Column:
    """The first 60 bits of the key's MD5, as a long."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def _prefix(h: Column, bits: int) -> Column:
    return F.shiftright(h, HASH_BITS - bits)


def _parts(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of equal keys cut into parts of about limit bytes. They are dealt out by ranges of the hash, the size and a
    random number, so one key fills as many tasks as it needs; each task adds up its own rows, after the bytes of the same
    key in the tasks before."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = saved(rows.withColumn("_r", F.rand(1)).repartitionByRange(n, "_h", "n_bytes", "_r").sortWithinPartitions("_h", "n_bytes", "_r").withColumn("_at", F.monotonically_increasing_id()).withColumn("_t", F.shiftrightunsigned("_at", 33)), "equal-keys")
    task = Window.partitionBy("_h").orderBy("_t").rowsBetween(Window.unboundedPreceding, -1)
    before = x.groupBy("_h", "_t").agg(F.sum("n_bytes").alias("b")).select(F.col("_h").alias("_k"), F.col("_t").alias("_u"), F.coalesce(F.sum("b").over(task), F.lit(0)).alias("_before"))
    here = Window.partitionBy("_h", "_t").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    y = x.withColumn("_here", F.coalesce(F.sum("n_bytes").over(here), F.lit(0))).join(before, (F.col("_h") == F.col("_k")) & (F.col("_t") == F.col("_u")))
    y = y.withColumn("part", F.floor((F.col("_before") + F.col("_here")) / limit)).drop("_r", "_at", "_t", "_k", "_u", "_before", "_here")
    sums = y.groupBy(F.col("_h").alias("_k"), F.col("part").alias("_q")).agg(F.sum("n_bytes").alias("shard_bytes"))
    return y.join(sums, (F.col("_h") == F.col("_k")) & (F.col("part") == F.col("_q"))).select(*rows.columns, F.lit(HASH_BITS).alias("depth"), "shard_bytes", "part")


def shards(docs: DataFrame, limit: int, key: str = "doc_id", size: Column | None = None, more_bits: int = 8) -> DataFrame:
    """(key, n_bytes, shard, depth, shard_bytes, part): shard is the bucket's hash prefix in bits, depth its length.

    A bucket is the shortest prefix whose documents fit into limit bytes. One pass counts bytes by a prefix of about
    log2(total / limit) + 3 bits; the sizes of all shorter prefixes are sums of that table. Buckets over the limit
    there, and only their documents, are read again with more_bits more, and so on. Documents themselves never move
    here: only (key, bytes, hash) does. A bucket over the limit at all 60 bits holds equal keys; its rows are cut into
    parts of about limit bytes (part counts from 0; elsewhere it is 0). A document larger than limit is a shard (part)
    of its own. Null keys hash as empty; null texts have 0 bytes; no rows give no rows; other columns are ignored.
    """
    n = F.coalesce((F.octet_length("text") if size is None else size).cast("long"), F.lit(0))
    rows = saved(docs.select(F.col(key), n.alias("n_bytes"), key_hash(F.col(key)).alias("_h")), "hashes")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    low, high = 0, min(HASH_BITS, max(1, (-(-total // limit)).bit_length() + 3))
    done, left = [], rows
    while True:
        fine = left.groupBy(_prefix(F.col("_h"), high).alias("_p")).agg(F.sum("n_bytes").alias("n"))
        levels = fine.select("n", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"), "_p")
        sizes = saved(levels.groupBy("depth", F.expr(f"shiftright(_p, {high} - depth)").alias("_b")).agg(F.sum("n").alias("shard_bytes")), "sizes")
        above = sizes.select((F.col("depth") + 1).alias("_d"), F.col("_b").alias("_a"), (F.col("shard_bytes") > limit).alias("_full"))
        leaves = sizes.where(F.col("shard_bytes") <= limit).join(above, (F.col("depth") == F.col("_d")) & (F.shiftright("_b", 1) == F.col("_a")), "left")
        leaves = saved(leaves.where(F.coalesce("_full", F.lit(True))).select(F.col("depth").alias("_d"), F.col("_b").alias("_a"), "shard_bytes"), "leaves")
        depths = sorted(r[0] for r in leaves.select("_d").distinct().collect())  # at most one number a bit
        at = left
        if depths:
            by_depth = fine.select("_p", F.explode(F.array(*map(F.lit, depths))).alias("depth"))
            own = by_depth.join(leaves, (F.col("depth") == F.col("_d")) & (F.expr(f"shiftright(_p, {high} - depth)") == F.col("_a"))).select("_p", "depth", "shard_bytes")
            at = left.withColumn("_p", _prefix(F.col("_h"), high)).join(own, "_p", "left").drop("_p")
            done.append(at.where("depth is not null").withColumn("part", F.lit(0).cast("long")))
            at = at.where("depth is null").drop("depth", "shard_bytes")
        if not sizes.where((F.col("depth") == high) & (F.col("shard_bytes") > limit)).limit(1).count():
            break
        if high == HASH_BITS:
            done.append(_parts(at, limit))
            break
        left = saved(at, "oversized")
        low, high = high + 1, min(HASH_BITS, high + more_bits)
    if not done:
        done.append(rows.select("*", F.lit(0).alias("depth"), F.lit(0).cast("long").alias("shard_bytes"), F.lit(0).cast("long").alias("part")))
    bits = F.expr(f"substring(lpad(bin(_h), {HASH_BITS}, '0'), 1, depth)")
    return reduce(DataFrame.unionByName, done).select(F.col(key), "n_bytes", bits.alias("shard"), F.col("depth").cast("int").alias("depth"), "shard_bytes", "part")


def directory(placed: DataFrame) -> DataFrame:
    """(shard, depth, shard_bytes, first_entry, n_entries): the entries of a directory as deep as the deepest shard that
    point to each shard. Parts of one bucket are summed up."""
    x = placed.groupBy("shard", "depth", "part").agg(F.max("shard_bytes").alias("b")).groupBy("shard", "depth").agg(F.sum("b").alias("shard_bytes"))
    deepest = x.agg(F.max("depth")).first()[0] or 0
    left = F.lit(deepest) - F.col("depth")
    first = F.coalesce(F.conv(F.rpad("shard", deepest, "0"), 2, 10).cast("long"), F.lit(0))
    return x.select("shard", "depth", "shard_bytes", first.alias("first_entry"), F.pow(F.lit(2.0), left).cast("long").alias("n_entries"))
