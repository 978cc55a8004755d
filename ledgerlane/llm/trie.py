"""The trie of conversation prefixes, by a splitter skeleton over sorted shards.

A conversation is a path of turn digests (128 bits of SHA-256 over role and text), laid end to end
in one binary, so that paths sort as the trie is walked in depth. Conversations are dealt by range
of (path, conv_id) at splitters drawn from a sample. A node whose members lie in more than one
shard is a prefix of a splitter: the trie of the splitters, the skeleton, holds all such nodes. It is
broadcast. A shard, sorted, is walked with a stack of open nodes; all nodes outside the skeleton are
finished there, and a skeleton node gives a partial aggregate per shard. Partials are reduced by
node, and what hangs on the skeleton is summed up along it. Conversations of one path are told
apart by id, so a path that very many conversations share is split like any other.

A digest of ids is sequential: ids that end at a skeleton node leave the shards as blocks of text,
in order, and one task streams the blocks of a node through its hash.

Bounds: at most ``MAX_SHARDS`` splitters of ``SPLITTER_TURNS`` turns, so the skeleton has at most their
product of nodes; a splitter of a longer path is cut there and only splits before that prefix. One
conversation's digests and sizes (24 bytes a turn) are held at once, and of a shard the open nodes with
the finished children of those outside the skeleton.

Turns are ordered by turn (null first), then role, then digest. Null roles and texts are empty. Rows
with a null conv_id belong to no conversation and are left out. An empty table has no nodes, not even
a root. Further columns are left out.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions.durable import drop_durable, durable

DIGEST_BYTES = 16
FAMILY = 5
HEAD_CHOICES = 9

SHARD_BYTES = 16 << 20
MAX_SHARDS = 4096
SAMPLE_PER_SHARD = 16
SPLITTER_TURNS = 32
BLOCK_IDS = 20_000
LEAST_ID = -(1 << 63)

PATHS = pa.schema([("conv_id", pa.int64()), ("path", pa.binary()), ("sizes", pa.binary())])
PATHS_SQL = "conv_id long, path binary, sizes binary"


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def head_length(conv_id: int, choices: int = HEAD_CHOICES) -> int:
    """How many turns a conversation takes over: crc32 of the decimal id, modulo."""
    return zlib.crc32(str(conv_id).encode()) % choices


def _digested(turns: DataFrame) -> DataFrame:
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.unhex(F.left(F.sha2(named, 256), F.lit(2 * DIGEST_BYTES))).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )


def rebuilt_paths(turns: DataFrame, family: int = FAMILY, choices: int = HEAD_CHOICES) -> DataFrame:
    """(conv_id, path, sizes) of every conversation after rebuilding: the first h turns of its family's first
    conversation (id - id % family), then its own after its first h, with h = ``head_length``.

    Only digests and sizes are shuffled, once, by family; a family's conversations are streamed in order
    behind its first, of which ``choices - 1`` turns are held.
    """
    family_id = F.col("conv_id") - F.col("conv_id") % family
    own = _digested(turns).select(family_id.alias("family"), (F.col("conv_id") != family_id).alias("later"), "*")
    order = ["family", "later", "conv_id", F.col("turn").asc_nulls_first(), "role", "digest"]

    def emit(rows: Iterator[tuple]) -> Iterator[tuple]:
        current, held, head = None, [], (None, [])

        def finished() -> tuple:
            nonlocal head
            family, conv_id = current
            if conv_id == family:
                head = (family, held[: choices - 1])
            h = head_length(conv_id, choices)
            kept = (head[1][:h] if head[0] == family else []) + held[h:]
            sizes = np.fromiter((size for _, size in kept), "<i8", len(kept))
            return conv_id, b"".join(digest for digest, _ in kept), sizes.tobytes()

        for family, _, conv_id, _, _, digest, size in rows:
            if current != (family, conv_id):
                if current:
                    yield finished()
                current, held = (family, conv_id), []
            held.append((digest, size))
        if current:
            yield finished()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(emit(_rows(batches)), PATHS, 500)

    return own.repartition("family").sortWithinPartitions(*order).mapInArrow(run, PATHS_SQL)


Splitter = tuple[bytes, int]


def _splitters(paths: DataFrame) -> list[Splitter]:
    """Least keys (path, conv_id) of all shards but the first, at equal sums of path lengths in a sample."""
    length = F.octet_length("path") + DIGEST_BYTES
    n, total = paths.agg(F.count("*"), F.sum(length)).first()
    if not n:
        return []
    partitions = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = min(MAX_SHARDS, max(-(-total // SHARD_BYTES), min(partitions, n)))
    stride = max(1, n // (SAMPLE_PER_SHARD * shards))
    most = DIGEST_BYTES * SPLITTER_TURNS
    sample = paths.where(F.pmod(F.xxhash64("conv_id"), F.lit(stride)) == 0).select(
        F.substring("path", 1, most).alias("path"),
        F.when(F.octet_length("path") > most, LEAST_ID).otherwise(F.col("conv_id")).alias("conv_id"),
        length.alias("length"),
    )
    keys = sorted((bytes(r.path), r.conv_id, r.length) for r in sample.collect())
    weights = np.cumsum([length for _, _, length in keys])
    if not keys:
        return []
    places = np.searchsorted(weights, weights[-1] * np.arange(1, shards) / shards)
    return sorted({keys[k][:2] for k in places})


class Skeleton:
    """The trie of the splitters' paths. Node 0 is the root; children have greater numbers than their parents."""

    def __init__(self, splitters: list[Splitter]):
        self.child: dict[tuple[int, bytes], int] = {}
        self.parent = [-1]
        for path, _ in splitters:
            node = 0
            for at in range(0, len(path), DIGEST_BYTES):
                key = (node, path[at : at + DIGEST_BYTES])
                if key not in self.child:
                    self.child[key] = len(self.parent)
                    self.parent.append(node)
                node = self.child[key]


class _Open:
    """A node that the walk is in."""

    __slots__ = ("children", "digest", "ends", "first", "leaves", "n", "number", "pending", "saved", "size")

    def __init__(self, number: int, digest: bytes, size: int):
        self.number, self.digest, self.size = number, digest, size
        self.n = self.children = self.leaves = self.saved = 0
        self.first: int | None = None
        self.ends = [] if number >= 0 else hashlib.sha256()
        self.pending: list[tuple] = []


NODE, PARTIAL, BLOCK = 0, 1, 2
#: ``number`` is the skeleton's node: of a node's parent, of a partial or of a block of ids.
WALK_SQL = (
    "kind int, number int, shard int, block int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long,"
    " n_leaves long, saved_tokens long, size long, turn_digest binary, ends string"
)
WALK = pa.schema(
    [
        (name, {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}[kind])
        for name, kind in (part.split() for part in WALK_SQL.split(","))
    ]
)


def _common_turns(a: bytes, b: bytes) -> int:
    """Turns that two paths share at their beginning."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most // DIGEST_BYTES
    low, high = 0, most // DIGEST_BYTES
    while high - low > 1:
        middle = (low + high) // 2
        same = a[low * DIGEST_BYTES : middle * DIGEST_BYTES] == b[low * DIGEST_BYTES : middle * DIGEST_BYTES]
        low, high = (middle, high) if same else (low, middle)
    return low


def _walked(rows: Iterator[tuple], skeleton: Skeleton) -> Iterator[tuple]:
    """Nodes, partials and blocks of the shards in ``rows`` (shard, conv_id, path, sizes), sorted by shard, path and id."""
    stack: list[_Open] = []
    shard, path, blocks = None, b"", {}

    def block(node: _Open) -> Iterator[tuple]:
        if node.ends:
            number = blocks[node.number] = blocks.get(node.number, -1) + 1
            yield (BLOCK, node.number, shard, number, *[None] * 9, ",".join(map(str, node.ends)))
            node.ends.clear()

    def close() -> Iterator[tuple]:
        node = stack.pop()
        depth = len(stack)
        if node.number >= 0:
            yield from block(node)
            yield (
                PARTIAL, node.number, shard, None, node.first, depth, None, node.n, node.children, node.leaves,
                node.saved, node.size, node.digest, None,
            )
            return
        parent = stack[-1]
        leaves, saved = node.leaves or 1, node.saved + (node.n - 1) * node.size
        parent.leaves += leaves
        parent.saved += saved
        for child in node.pending:
            yield (*child[:6], node.first, *child[7:])
        row = (
            NODE, parent.number if parent.number >= 0 else None, shard, None, node.first, depth, None, node.n, node.children,
            leaves, saved, node.size, node.digest, node.ends.hexdigest(),
        )
        if parent.number >= 0:
            yield row
        else:
            parent.pending.append(row)

    for own_shard, conv_id, own, sizes in rows:
        if own_shard != shard:
            while stack:
                yield from close()
            shard, path, blocks = own_shard, b"", {}
            stack.append(_Open(0, b"", 0))
        common = _common_turns(path, own)
        while len(stack) - 1 > common:
            yield from close()
        lengths = np.frombuffer(sizes, "<i8").tolist()
        for depth in range(common, len(lengths)):
            parent, digest = stack[-1], own[depth * DIGEST_BYTES : (depth + 1) * DIGEST_BYTES]
            number = skeleton.child.get((parent.number, digest), -1) if parent.number >= 0 else -1
            if number < 0:
                parent.children += 1
            stack.append(_Open(number, digest, lengths[depth]))
        for node in stack:
            node.n += 1
            node.first = conv_id if node.first is None else min(node.first, conv_id)
        top = stack[-1]
        if top.number >= 0:
            top.ends.append(conv_id)
            if len(top.ends) >= BLOCK_IDS:
                yield from block(top)
        else:
            top.ends.update((b"," if top.n > 1 else b"") + str(conv_id).encode())
        path = own
    while stack:
        yield from close()


def _walk(paths: DataFrame, splitters: list[Splitter], skeleton: Skeleton) -> DataFrame:
    context = paths.sparkSession.sparkContext
    shared, trie = context.broadcast(splitters), context.broadcast(skeleton)

    @F.pandas_udf("int")
    def shard(path: pd.Series, conv_id: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(shared.value, (bytes(p), c)) for p, c in zip(path, conv_id)], dtype="int32")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(_walked(_rows(batches), trie.value), WALK)

    dealt = paths.select(shard("path", "conv_id").alias("shard"), "conv_id", "path", "sizes")
    ordered = dealt.repartitionById(len(splitters) + 1, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")
    return ordered.mapInArrow(walk, WALK_SQL)


def _end_digests(blocks: DataFrame) -> DataFrame:
    """(number, ends): the digest over all ids that end at a skeleton node, streamed block by block."""
    schema = pa.schema([("number", pa.int32()), ("ends", pa.string())])

    def stream(rows: Iterator[tuple]) -> Iterator[tuple]:
        current, digest = None, None
        for number, _, _, ids in rows:
            if number != current:
                if current is not None:
                    yield current, digest.hexdigest()
                current, digest = number, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        if current is not None:
            yield current, digest.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(stream(_rows(batches)), schema)

    order = ["number", "shard", "block"]
    ordered = blocks.select(*order, "ends").repartition("number").sortWithinPartitions(*order)
    return ordered.mapInArrow(run, "number int, ends string")


NODE_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "turn_digest"]
SKELETON_SQL = (
    "node int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long,"
    " saved_tokens long, ends_sha256 string, turn_digest binary"
)


def _skeleton_rows(walked: DataFrame, skeleton: Skeleton) -> list[tuple]:
    """The skeleton's nodes: partials reduced by node, then summed up along the skeleton, whose size is bounded."""
    reduced = walked.where(F.col("kind") == PARTIAL).groupBy("number").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"), F.max("size").alias("size"), F.max("turn_digest").alias("turn_digest"),
    )
    ends = _end_digests(walked.where(F.col("kind") == BLOCK))
    nodes = {r.number: r.asDict() for r in reduced.join(ends, "number", "left").collect()}
    for number in sorted(nodes, reverse=True):
        node, parent = nodes[number], nodes.get(skeleton.parent[number])
        node["n_leaves"] = node["n_leaves"] or 1
        node["saved_tokens"] += (node["n_convs"] - 1) * node["size"]
        if parent:
            for name in ("n_leaves", "saved_tokens"):
                parent[name] += node[name]
            parent["n_children"] += 1
    nothing = hashlib.sha256().hexdigest()
    return [
        (
            number, node["conv_id"], node["depth"], nodes[skeleton.parent[number]]["conv_id"] if number else None,
            node["n_convs"], node["n_children"], node["n_leaves"], node["saved_tokens"], node["ends"] or nothing,
            bytes(node["turn_digest"]),
        )
        for number, node in nodes.items()
    ]


def prefix_trie(paths: DataFrame) -> DataFrame:
    """One row per node of the trie of ``paths`` (conv_id, path, sizes; a conv_id once): its smallest member, depth,
    its parent's smallest member, members, children, leaves and saved bytes of its subtree, the digest of the ids
    that end there, and the digest of its last turn (empty at the root)."""
    spark = paths.sparkSession
    written = durable(paths, "trie-paths")
    splitters = _splitters(written)
    skeleton = Skeleton(splitters)
    walked = durable(_walk(written, splitters, skeleton), "trie-walk")
    drop_durable(written)
    shared = spark.createDataFrame(_skeleton_rows(walked, skeleton), SKELETON_SQL)
    parents = F.broadcast(shared.select(F.col("node").alias("number"), F.col("conv_id").alias("above")))
    local = walked.where(F.col("kind") == NODE).withColumnRenamed("ends", "ends_sha256").join(parents, "number", "left")
    local = local.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return local.select(*NODE_COLUMNS).unionByName(shared.select(*NODE_COLUMNS))


def conversation_trie(turns: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations; the last turn's digest in hex, as ``turn_key``."""
    nodes = prefix_trie(rebuilt_paths(turns))
    return nodes.withColumn("turn_key", F.lower(F.hex("turn_digest"))).drop("turn_digest")


#: crc32 is written out, as a fold over the digits and the eight bits of each.
ORACLE_SQL = r"""
with turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, turn,
    sha256(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))[1:32] as key
  from conversations where conv_id is not null
), placed as (
  select conv_id, key, strlen(text) as size,
    row_number() over (partition by conv_id order by turn nulls first, role, key) as place
  from turns
), own as (
  select conv_id, list({'key': key, 'size': size} order by place) as steps from placed group by conv_id
), heads as (
  select *, xor(4294967295, list_reduce(
    list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint),
    lambda crc, byte: list_reduce([0::bigint, 0, 0, 0, 0, 0, 0, 0],
      lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, byte)), 4294967295::bigint)) % 9 as h
  from own
), rebuilt as (
  select c.conv_id, coalesce(b.steps[1:c.h], []) || c.steps[c.h + 1:] as steps
  from heads c left join own b on b.conv_id = c.conv_id - c.conv_id % 5
), members as (
  select conv_id, len(steps) as turns, d as depth,
    list_reduce(list_transform(steps[1:d], lambda s: s.key), lambda a, b: a || b, '') as node,
    list_reduce(list_transform(steps[1:d - 1], lambda s: s.key), lambda a, b: a || b, '') as above,
    coalesce(steps[d].key, '') as turn_key, coalesce(steps[d].size, 0) as size
  from (select *, unnest(range(0, len(steps) + 1)) as d from rebuilt)
), nodes as (
  select node, depth, case when depth > 0 then any_value(above) end as above, any_value(turn_key) as turn_key,
    min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(size) as saved,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (turns = depth), '')) as ends_sha256
  from members group by node, depth
), children as (
  select above as node, count(*) as n_children from nodes where above is not null group by above
), below as (
  select distinct a.node as top, b.node from members a join members b using (conv_id) where b.depth >= a.depth
), subtrees as (
  select b.top as node, count(*) filter (c.node is null) as n_leaves, sum(n.saved)::bigint as saved_tokens
  from below b join nodes n on n.node = b.node left join children c on c.node = b.node group by b.top
)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(c.n_children, 0) as n_children, s.n_leaves,
  s.saved_tokens, n.ends_sha256, n.turn_key
from nodes n join subtrees s on s.node = n.node left join children c on c.node = n.node left join nodes p on p.node = n.above
"""
