"""Shards of bounded size by extendible hashing, in DataFrame operations only.

A row's bits are 60 bits of its key's MD5, followed by 60 bits drawn once per row that tell equal keys
apart. A bucket is a prefix of the bits. Starting from the empty prefix, only buckets over the byte
limit are split, on the next bit, until each fits or holds a single row. The directory maps prefixes
of one length to buckets. It begins at about the depth that the total size asks for, and grows by
some bits per round for the buckets that are still too large, so rows that are settled are not looked
at again, and sizes are summed before anything is shuffled.

A null text has size 0. Null keys count as one key. A row over the limit gets a shard of its own with
``fits`` false. Repeated rows are all kept and may go to different shards. An empty table has none.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.durable import durable

SHARD_BYTES = 1 << 26
HASH_BITS = 60
#: Bits that the directory gains per round, and the most it begins with.
ROUND_BITS = 8
FIRST_BITS = 20
#: Bits beyond those that shards of equal size would need, to begin with.
SPARE_BITS = 4


def hash_bits(text: Column) -> Column:
    """The first bits of the MD5 of a text, as a string of 0 and 1."""
    number = F.conv(F.substring(F.md5(F.coalesce(text, F.lit("")).cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")
    return F.lpad(F.bin(number), HASH_BITS, "0")


def _sized(docs: DataFrame, key: str, text: str, keep: list[str]) -> DataFrame:
    """The kept columns as fields of ``row``, with size and bits; written, so that the drawn bits stay."""
    drawn = F.concat_ws(":", F.col(key).cast("string"), F.monotonically_increasing_id().cast("string"))
    return durable(
        docs.select(
            F.struct(*keep).alias("row"),
            F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
            F.concat(hash_bits(F.col(key).cast("string")), hash_bits(drawn)).alias("bits"),
        ),
        "shard-rows",
    )


def _directory(rows: DataFrame, known: int, depth: int, limit: int) -> DataFrame:
    """For prefixes of length ``depth`` the shortest prefix of over ``known`` bits (or none, at first) whose
    bucket fits; null where none does: entry, shard, shard_rows, shard_bytes."""
    leaves = rows.groupBy(F.substring("bits", 1, depth).alias("entry")).agg(
        F.sum("n_bytes").alias("n_bytes"), F.count("*").alias("n_rows")
    )
    leaves = durable(leaves, "shard-leaves")
    lengths = F.sequence(F.lit(known + 1 if known else 0), F.lit(depth))
    prefixes = leaves.select("*", F.explode(lengths).alias("length")).withColumn(
        "shard", F.expr("substring(entry, 1, length)")
    )
    fitting = (
        prefixes.groupBy("shard")
        .agg(F.sum("n_bytes").alias("shard_bytes"), F.sum("n_rows").alias("shard_rows"))
        .where((F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1) | (F.length("shard") == 2 * HASH_BITS))
    )
    shortest = prefixes.join(fitting, "shard").groupBy("entry").agg(F.min("length").alias("length"))
    found = shortest.withColumn("shard", F.expr("substring(entry, 1, length)")).select("entry", "shard").join(fitting, "shard")
    return durable(leaves.select("entry").join(found, "entry", "left"), "shard-directory")


def assign_shards(
    docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = SHARD_BYTES, keep: list[str] | None = None
) -> DataFrame:
    """The kept columns (``key`` alone by default) of every row with shard (its bits; empty for a single
    shard), depth, shard_rows, shard_bytes and fits. Columns of these names are replaced."""
    added = ["shard", "depth", "shard_rows", "shard_bytes", "fits"]
    columns = [c for c in (keep or [key]) if c.lower() not in added]
    rows = _sized(docs, key, text, columns)
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    known, depth = 0, min(FIRST_BITS, SPARE_BITS + max(0, math.ceil(math.log2(max(1, total) / limit))))
    left, settled = rows, None
    while True:
        directory = _directory(left, known, depth, limit)
        entry = F.substring("bits", 1, depth)
        placed = left.withColumn("entry", entry).join(directory.where(F.col("shard").isNotNull()), "entry").drop("entry")
        settled = placed if settled is None else settled.union(placed)
        too_large = directory.where(F.col("shard").isNull()).select("entry")
        if too_large.isEmpty():
            break
        left = durable(left.withColumn("entry", entry).join(too_large, "entry", "left_semi").drop("entry"), "shard-left")
        known, depth = depth, min(2 * HASH_BITS, depth + ROUND_BITS)
    return settled.select(
        "row.*",
        "shard",
        F.length("shard").alias("depth"),
        "shard_rows",
        "shard_bytes",
        (F.col("shard_bytes") <= limit).alias("fits"),
    )


def write_shards(
    docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", limit: int = SHARD_BYTES
) -> None:
    """Write every shard as a subfolder ``shard=...`` of Parquet files."""
    placed = assign_shards(docs, key, text, limit, docs.columns).drop("depth", "shard_rows", "shard_bytes", "fits")
    placed.withColumn("shard", F.concat(F.lit("b"), "shard")).repartition("shard").write.partitionBy("shard").parquet(folder)


#: The same shards in SQL, for tables with distinct keys that need no more than 40 bits.
def oracle_sql(limit: int = SHARD_BYTES) -> str:
    return f"""
with sized as (
  select doc_id, coalesce(strlen(text), 0) as n_bytes,
         lpad(bin(('0x' || substr(md5(doc_id::varchar), 1, 15))::bigint), 60, '0') as bits
  from documents
), prefixes as (
  select doc_id, n_bytes, depth, substr(bits, 1, depth) as shard
  from sized, (select unnest(range(0, 41)) as depth)
), buckets as (
  select depth, shard, sum(n_bytes)::bigint as shard_bytes, count(*) as shard_rows
  from prefixes group by depth, shard
  having sum(n_bytes) <= {limit} or count(*) = 1
), placed as (
  select doc_id, p.shard, p.depth::int as depth, shard_rows, shard_bytes, shard_bytes <= {limit} as fits,
         row_number() over (partition by doc_id order by p.depth) as place
  from prefixes p join buckets b on b.depth = p.depth and b.shard = p.shard
)
select doc_id, shard, depth, shard_rows, shard_bytes, fits from placed where place = 1
"""
