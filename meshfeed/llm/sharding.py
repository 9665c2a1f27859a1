"""Sharding by extendible hashing, in DataFrame operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshfeed.llm.arrow_text import fresh, without
from meshfeed.session import stage

#: Bits of a row's hash: the first come from its key, the rest from its place in the stored table, so
#: that rows of one key can be told apart.
KEY_BITS, PLACE_BITS = 44, 19
BITS = KEY_BITS + PLACE_BITS
#: Bits that the directory looks ahead of an even spread, and that another round adds.
AHEAD_BITS, ROUND_BITS = 4, 8
#: Levels of the directory that are summed at once.
STEP_BITS = 8

LEAF = {"leaf_depth": "int", "leaf": "bigint", "shard_bytes": "bigint", "shard_rows": "bigint"}
ADDED = ("shard_id", "depth", "shard_bytes", "shard_rows", "oversize")


def key_hash(key: str) -> Column:
    """The first ``KEY_BITS`` bits of the MD5 of a key's text (null: of the text ``null``) as a number."""
    text = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long")


def _prefix(hash_: Column | str, depth: int) -> Column:
    return F.shiftright(F.col(hash_) if isinstance(hash_, str) else hash_, BITS - depth)


def _directory(rows: DataFrame, above: int, depth: int, limit: int) -> DataFrame:
    """``slot`` (the first ``depth`` bits), ``leaf_depth``, ``leaf``, ``shard_bytes``, ``shard_rows``: for each slot in use
    the shallowest bucket below depth ``above`` that holds it and fits the limit; nulls if none does.

    Sums are made from below, ``STEP_BITS`` levels at a time: of each step only the sums of its uppermost
    level go on, so a group has at most ``2 ** STEP_BITS`` members, and only slots whose bucket still fits
    there look further up."""
    slots = stage(
        rows.groupBy(_prefix("hash", depth).alias("slot")).agg(F.sum("size").alias("bytes"), F.count("*").alias("n")),
        "slots",
    )
    units, open_slots = slots.withColumnRenamed("slot", "unit"), slots.select("slot", F.col("slot").alias("unit"))
    nowhere = [F.lit(None).cast(t).alias(n) for n, t in LEAF.items()]
    parts, low = [], depth
    while True:
        top = max(above, low - STEP_BITS)
        levels = units.select(
            "unit", F.explode(F.sequence(F.lit(top), F.lit(low))).alias("level"), "bytes", "n"
        ).withColumn("bucket", F.expr(f"shiftright(unit, {low} - level)"))
        buckets = stage(levels.groupBy("level", "bucket").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")), "buckets")
        fits = buckets.where((F.col("bytes") <= limit) | (F.lit(depth == BITS) & (F.col("level") == depth)))
        best = (
            levels.select("unit", "level", "bucket")
            .join(fits.hint("merge"), ["level", "bucket"])
            .groupBy("unit")
            .agg(F.min(F.struct("level", "bucket", "bytes", "n")).alias("b"))
        )
        placed = stage(open_slots.join(best.hint("merge"), "unit", "left").select("slot", "b"), "directory")
        leaf = [F.col("b.level").alias("leaf_depth"), F.col("b.bucket").alias("leaf"), F.col("b.bytes").alias("shard_bytes"), F.col("b.n").alias("shard_rows")]
        parts.append(placed.where("b is null").select("slot", *nowhere))
        if top == above:
            parts.append(placed.where("b is not null").select("slot", *leaf))
            return reduce(DataFrame.union, parts)
        parts.append(placed.where(F.col("b.level") > top).select("slot", *leaf))
        open_slots = placed.where(F.col("b.level") == top).select("slot", F.col("b.bucket").alias("unit"))
        units = buckets.where(F.col("level") == top).select(F.col("bucket").alias("unit"), "bytes", "n")
        low = top


def assign(rows: DataFrame, size: str, limit: int, key: str = "doc_id") -> DataFrame:
    """``rows`` with ``shard_id``, ``depth``, ``shard_bytes``, ``shard_rows`` and ``oversize``.

    The directory is indexed by the first bits of a hash. A bucket whose rows have more than
    ``limit`` bytes (column ``size``, null counts 0) is split on its next bit, and only such a
    bucket, until all fit; so shards differ in depth. ``shard_id`` is ``s`` and the bucket's bits.
    A row of over ``limit`` bytes alone gets a shard of its own, ``x`` and its bits, and ``oversize``. So
    has a bucket that is still too large at the last bit, where rows of one key share a place.

    Sizes are summed for all prefixes a few bits deeper than an even spread needs; what is still too
    large there, a hot key say, is looked at again with more bits. The last bits tell rows of one
    key apart by their place in the stored table, so even a key with most rows is split. Only those
    may go to another shard in another run. Nothing is collected but whether a round is needed, and
    nothing is broadcast, as the directory grows with the data.
    Empty tables give no rows; columns of the added names are replaced.
    """
    rows = without(rows, *ADDED)
    names = {n: fresh(rows, f"shard_{n}") for n in ("key", "size")}
    kept = stage(rows.withColumns({names["key"]: key_hash(key), names["size"]: F.coalesce(F.col(size).cast("long"), F.lit(0))}), "shard-rows")
    place = F.pmod(F.xxhash64("_metadata.file_path", "_metadata.row_index"), F.lit(1 << PLACE_BITS))
    columns = [F.col(f"`{c.replace('`', '``')}`") for c in rows.columns]
    packed = kept.select(
        F.struct(*columns).alias("row"),
        (F.shiftleft(F.col(names["key"]), PLACE_BITS) + place).alias("hash"),
        F.col(names["size"]).alias("size"),
    )
    small = packed.where(F.col("size") <= limit)
    total = small.agg(F.sum("size")).first()[0] or 0
    depth = min(BITS, max(0, (total // limit)).bit_length() + AHEAD_BITS)
    shape = [F.col(f"row.`{c.replace('`', '``')}`") for c in rows.columns]

    def out(found: DataFrame, shard: Column, depth_: Column, bytes_: Column, n: Column, over: Column) -> DataFrame:
        return found.select(
            *shape, shard.alias("shard_id"), depth_.cast("int").alias("depth"), bytes_.alias("shard_bytes"),
            n.alias("shard_rows"), over.alias("oversize"),
        )

    def bits(number: Column, n: Column) -> Column:
        return F.when(n > 0, F.lpad(F.bin(number), n, "0")).otherwise("")

    alone = packed.where(F.col("size") > limit)
    done = out(alone, F.concat(F.lit("x"), bits(F.col("hash"), F.lit(BITS))), F.lit(BITS), F.col("size"), F.lit(1).cast("long"), F.lit(True))
    rest, above = small, 0
    while True:
        directory = _directory(rest, above, depth, limit)
        joined = rest.withColumn("slot", _prefix("hash", depth)).join(directory.hint("merge"), "slot")
        leaf = F.concat(F.lit("s"), bits(F.col("leaf"), F.col("leaf_depth")))
        found = joined.where("leaf is not null")
        done = done.union(out(found, leaf, F.col("leaf_depth"), F.col("shard_bytes"), F.col("shard_rows"), F.col("shard_bytes") > limit))
        if directory.where("leaf is null").isEmpty():
            return done
        rest = joined.where("leaf is null").select("row", "hash", "size")
        above, depth = depth + 1, min(BITS, depth + ROUND_BITS)


def write_shards(rows: DataFrame, folder: str) -> None:
    """Writes assigned rows as one folder of Parquet for each shard."""
    rows.repartition("shard_id").sortWithinPartitions("shard_id").write.partitionBy("shard_id").parquet(folder)
