"""Shards by extendible hashing.

A directory is indexed by the leading bits of a key's hash. A bucket splits on its next bit only while its bytes
exceed the limit, so every shard fits its limit and no row moves that need not. Bytes are summed for fine prefixes
first (partial aggregation), and depths are settled on those sums alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import staged

LIMIT_BYTES = 1 << 20
#: Leading bits of the hash that a directory may use.
MOST_BITS = 60
#: Bits beyond those an even spread needs that one pass settles.
SPARE_BITS = 8


def key_hash(key: Column) -> Column:
    """The first 60 bits of the key's MD5, as a whole number; a null key hashes as the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def depths(cells: DataFrame, limit: int, upto: int, first: int = 0) -> DataFrame:
    """cell and depth for cells of ``upto`` bits: the least depth whose prefix holds at most ``limit`` bytes or one row.

    Cells whose own prefix still holds too much get no depth.
    """
    bits = cells.select("cell", F.explode(F.sequence(F.lit(first), F.lit(upto))).alias("depth"), "bytes", "n")
    bits = bits.withColumn("prefix", F.expr(f"shiftright(cell, {upto} - depth)"))
    fit = bits.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).where((F.col("bytes") <= limit) | (F.col("n") == 1))
    return bits.select("cell", "depth", "prefix").join(fit.select("depth", "prefix"), ["depth", "prefix"]).groupBy("cell").agg(F.min("depth").alias("depth"))


def shard(rows: DataFrame, size: Column, key: str = "doc_id", limit: int = LIMIT_BYTES) -> DataFrame:
    """``rows`` with key_hash, row_bytes, local_depth and shard: the prefix of the bucket, then its depth.

    A null size counts as 0 bytes. A row larger than the limit has a shard of its own; rows that share a whole
    hash (repeated keys) and exceed the limit together cannot be told apart by further bits, so their bucket keeps
    the full depth. An empty table gives an empty result. Columns of these names in ``rows`` are replaced.
    """
    spark = rows.sparkSession
    hashed = rows.withColumn("key_hash", key_hash(F.col(key))).withColumn("row_bytes", F.coalesce(size.cast("long"), F.lit(0)))
    total = hashed.agg(F.sum("row_bytes")).first()[0] or 0
    upto = min(MOST_BITS, max(1, math.ceil(math.log2(total / limit + 1))) + SPARE_BITS)
    directory, todo = None, None
    while True:
        cells = hashed.select(F.expr(f"shiftright(key_hash, {MOST_BITS - upto})").alias("cell"), "row_bytes")
        if todo is not None:
            cells = cells.join(todo, F.expr(f"shiftright(cell, {upto - done})") == F.col("over"), "left_semi")
        sums = staged(cells.groupBy("cell").agg(F.sum("row_bytes").alias("bytes"), F.count("*").alias("n")), "cells")
        found = staged(sums.select("cell").join(depths(sums, limit, upto), "cell", "left"), "directory")
        settled = found.where("depth is not null" if upto < MOST_BITS else "true")
        part = settled.select(F.expr(f"shiftright(cell, {upto} - coalesce(depth, {upto}))").alias("prefix"), F.coalesce("depth", F.lit(upto)).alias("local_depth")).distinct()
        directory = part if directory is None else directory.union(part)
        over = found.where("depth is null")
        if upto == MOST_BITS or over.isEmpty():
            break
        todo, done = over.select(F.col("cell").alias("over")), upto
        upto = min(MOST_BITS, upto + SPARE_BITS)
    levels = sorted(r[0] for r in directory.select("local_depth").distinct().collect())  # at most one for each bit
    directory = directory.select(F.col("prefix").alias("shard_prefix"), "local_depth")
    if not levels:
        return hashed.withColumn("local_depth", F.lit(None).cast("int")).withColumn("shard", F.lit(None).cast("string"))
    prefixes = F.array(*(F.struct(F.lit(d).alias("d"), F.expr(f"shiftright(key_hash, {MOST_BITS - d})").alias("p")) for d in levels))
    # one lookup for each depth in use, of which exactly one is in the directory
    probes = hashed.select("key_hash").distinct().select("key_hash", F.explode(prefixes).alias("x")).select("key_hash", "x.d", "x.p")
    home = probes.join(directory, (F.col("d") == F.col("local_depth")) & (F.col("p") == F.col("shard_prefix"))).select("key_hash", "local_depth", "shard_prefix")
    return (
        hashed.drop("local_depth", "shard").join(home, "key_hash")
        .withColumn("shard", F.format_string("%d/%d", "shard_prefix", "local_depth")).drop("shard_prefix")
    )
