"""The trie of conversation prefixes.

1. Turns become slim rows: conversation, depth, a 128-bit code and the length of the text. No text is shuffled.
2. A prefix's digest is the exclusive or of its turns' codes, each mixed with its depth. So it is a running aggregate that a
   range-partitioned sort computes in pieces, however long a conversation is, and a parent's digest follows from its child's.
3. A count-min sketch of all digests, two bits a counter, is built by the tasks and merged. A digest that it estimates at one
   is proven a singleton: its node is written out where it lies, and needs its parent's only if that may be shared.
4. Only the other prefixes, those that may be shared, are shuffled and grouped exactly. An estimate is never too low, so a
   sketch that is too small for its table costs shuffling, never a wrong node.
5. Sums over subtrees need no walk by depth. A node belongs to its smallest member; of one member's prefixes, those from some
   depth on are its own. Each (member, prefix) adds what of the member's bytes lies between the prefix and that depth.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from cardloom.llm.batches import to_batch
from cardloom.operators.ordering import sorted_pieces
from cardloom.sources.tables import stage

PIECE, POS = "_piece", "_pos"  # of sorted_pieces
HASHES = 4  # rows of the sketch
BLOCK = 1 << 12  # counters of a stored block
SMALLEST, LARGEST = 1 << 16, 1 << 26  # counters of a sketch row; the largest sketch is HASHES * LARGEST / 4 = 64 MB
NODE = ["depth", "d1", "d2"]
HEAD = 9  # a rebuilt conversation takes fewer turns than this from another
FAMILY = 5


# --- coded turns ------------------------------------------------------------------------------------------------------

def coded_turns(turns: DataFrame) -> DataFrame:
    """(``conv``, ``depth`` from 1, ``e1``, ``e2``, ``bytes``) of every turn.

    Turns go in the order of ``turn``, nulls first, ties in the order of a hash of role and text. A null role or text is
    empty; rows without conv_id belong to no conversation and are left out."""
    said = [F.coalesce(c, F.lit("")) for c in ("role", "text")]
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), "turn", F.xxhash64(*said).alias("e1"), F.xxhash64(F.lit(1), *said).alias("e2"),
        F.octet_length(said[1]).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("row"))
    pieces = sorted_pieces(rows, ["conv", "turn", "e1", "e2", "row"])
    inside = Window.partitionBy(PIECE, "conv").orderBy(POS)
    counted = _continued(pieces, {"n": F.count(F.lit(1))}, {"n": F.sum})
    return stage(counted.withColumn("depth", F.row_number().over(inside) + F.coalesce("n", F.lit(0))).select(
        "conv", F.col("depth").cast("long"), "e1", "e2", "bytes"), "coded")


def _continued(pieces: DataFrame, totals: dict, combine: dict) -> DataFrame:
    """``pieces`` with the ``totals`` of a conversation's rows in earlier pieces; null in the piece where it begins.

    A piece continues at most one conversation, so what is attached has at most as many rows as there are pieces."""
    earlier = Window.partitionBy("conv").orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    parts = pieces.groupBy("conv", PIECE).agg(*[c.alias(n) for n, c in totals.items()])
    carried = parts.select("conv", PIECE, F.count(F.lit(1)).over(earlier).alias("_before"), *[f(n).over(earlier).alias(n) for n, f in combine.items()])
    return pieces.join(F.broadcast(stage(carried.where("_before > 0").drop("_before"), "carried")), ["conv", PIECE], "left")


def lengths(coded: DataFrame) -> DataFrame:
    """``conv`` and its number of turns ``n``."""
    return stage(coded.groupBy("conv").agg(F.max("depth").alias("n")), "lengths")


def borrowed(conv: Column) -> Column:
    """How many turns a rebuilt conversation takes from the first of its family."""
    return F.crc32(conv.cast("string").cast("binary")) % HEAD


def rebuilt(coded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``coded`` and ``lengths`` of conversations whose first turns are those of conversation c - c % 5 (with the sign of c),
    where there is one; a conversation may be left without turns."""
    convs = lengths(coded)
    first = F.col("conv") - F.col("conv") % FAMILY
    own = convs.select("conv", "n", borrowed(F.col("conv")).alias("h"), first.alias("base"))
    base = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    known = stage(own.join(base, "base", "left").select(
        "conv", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken"), "n"), "families")
    family = F.filter(F.sequence(F.col("conv") - FAMILY + 1, F.col("conv") + FAMILY - 1), lambda c: c - c % FAMILY == F.col("conv"))
    heads = coded.where((F.col("depth") < HEAD) & (F.col("conv") % FAMILY == 0)).select(F.explode(family).alias("to"), "depth", "e1", "e2", "bytes")
    lent = (heads.where(F.col("depth") <= borrowed(F.col("to"))).join(known.select(F.col("conv").alias("to")), "to")
            .select(F.col("to").alias("conv"), "depth", "e1", "e2", "bytes"))
    kept = coded.where(F.col("depth") > borrowed(F.col("conv"))).join(known.select("conv", "h", "taken"), "conv").select(
        "conv", (F.col("depth") - F.col("h") + F.col("taken")).alias("depth"), "e1", "e2", "bytes")
    return lent.unionByName(kept), known.select("conv", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))


# --- the sketch -------------------------------------------------------------------------------------------------------

def _slots(d1: np.ndarray, d2: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The counter of each digest in each row of the sketch; ``width`` is a power of two."""
    a, b = d1.view(np.uint64), d2.view(np.uint64) | np.uint64(1)
    for i in range(HASHES):
        yield ((a + np.uint64(i) * b) >> np.uint64(20)) & np.uint64(width - 1)


def _arrays(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False) for n in names]


def _pack(counters: np.ndarray) -> bytes:
    """Counters of 0, 1, 2 as two bits each, deflated: most blocks of a task are nearly empty."""
    quads = counters.reshape(-1, 4)
    return zlib.compress((quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6).tobytes(), 1)


def _unpack(packed: bytes) -> np.ndarray:
    octets = np.frombuffer(zlib.decompress(packed), np.uint8)
    return np.stack([octets >> s & 3 for s in (0, 2, 4, 6)], axis=1).ravel()


BLOCKS = pa.schema([("at", pa.int32()), ("counters", pa.binary())])


def _count(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The sketch of one task, block by block."""
    sketch = np.zeros((HASHES, width), np.uint8)
    for batch in batches:
        for i, slots in enumerate(_slots(*_arrays(batch, "d1", "d2"), width)):
            at, n = np.unique(slots, return_counts=True)
            sketch[i, at] = np.minimum(sketch[i, at] + np.minimum(n, 2), 2)
    for at, block in enumerate(sketch.reshape(-1, BLOCK)):
        if block.any():
            yield to_batch([(at, _pack(block))], BLOCKS)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One block for each place, from blocks sorted by place."""
    place, total = None, None
    for batch in batches:
        for at, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if at != place:
                if place is not None:
                    yield to_batch([(place, _pack(total))], BLOCKS)
                place, total = at, np.zeros(BLOCK, np.uint8)
            total = np.minimum(total + _unpack(packed), 2)
    if place is not None:
        yield to_batch([(place, _pack(total))], BLOCKS)


def sketch_width(rows: int, largest: int = LARGEST) -> int:
    """Four counters for each prefix, within the bound."""
    return min(max(1 << (4 * rows).bit_length(), SMALLEST), largest)


def sketch(digests: DataFrame, width: int) -> Broadcast:
    """The count-min sketch of columns ``d1``, ``d2``: (place, packed block) pairs of ``width`` counters a row, broadcast.
    Its size is bounded by ``width`` alone."""
    made = digests.select("d1", "d2").mapInArrow(partial(_count, width=width), "at int, counters binary")
    merged = made.repartition("at").sortWithinPartitions("at").mapInArrow(_merge, "at int, counters binary")
    return digests.sparkSession.sparkContext.broadcast([tuple(r) for r in merged.collect()])


def opened(blocks: Broadcast, width: int) -> np.ndarray:
    """The counters of a broadcast sketch."""
    stored = np.zeros((HASHES, width), np.uint8)
    for at, packed in blocks.value:
        stored.reshape(-1, BLOCK)[at] = _unpack(packed)
    return stored


def estimates(stored: np.ndarray, width: int, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
    """0, 1 or 2 (two and more) for each digest; never less than its true count."""
    least = np.full(len(d1), 2, np.uint8)
    for row, slots in zip(stored, _slots(d1, d2, width)):
        least = np.minimum(least, row[slots])
    return least


def _screen(batches: Iterator[pa.RecordBatch], blocks: Broadcast, width: int) -> Iterator[pa.RecordBatch]:
    """Marks prefixes, and their parents, that are proven singletons."""
    stored = opened(blocks, width)
    for batch in batches:
        depth, d1, d2, q1, q2 = _arrays(batch, "depth", *NODE[1:], "q1", "q2")
        alone = (estimates(stored, width, d1, d2) == 1) & (depth > 0)
        below = (estimates(stored, width, q1, q2) == 1) & (depth > 1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(alone), pa.array(below)],
                                         names=[*batch.schema.names, "alone", "below"])


# --- nodes ------------------------------------------------------------------------------------------------------------

def prefixes(coded: DataFrame, convs: DataFrame) -> DataFrame:
    """Every (conversation, depth), depth 0 included: ``conv``, ``depth``, ``last`` (no turn follows), digest ``d1``, ``d2``,
    the parent's digest ``q1``, ``q2``, ``bytes`` of the last text and ``upto``, the bytes up to here."""
    mixed = coded.withColumns({"z1": F.xxhash64("depth", "e1", "e2"), "z2": F.xxhash64(F.lit(1), "depth", "e1", "e2")}).drop("e1", "e2")
    pieces = sorted_pieces(mixed, ["conv", "depth"])
    inside = Window.partitionBy(PIECE, "conv").orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    totals = {"c1": F.bit_xor("z1"), "c2": F.bit_xor("z2"), "cb": F.sum("bytes")}
    carried = _continued(pieces, totals, {"c1": F.bit_xor, "c2": F.bit_xor, "cb": F.sum})
    none = F.lit(0).cast("long")
    run = carried.select("conv", "depth", "bytes", "z1", "z2", (F.sum("bytes").over(inside) + F.coalesce("cb", none)).alias("upto"),
                         *[F.bit_xor(f"z{i}").over(inside).bitwiseXOR(F.coalesce(f"c{i}", none)).alias(f"d{i}") for i in (1, 2)])
    run = run.select("conv", "depth", "d1", "d2", F.col("d1").bitwiseXOR(F.col("z1")).alias("q1"), F.col("d2").bitwiseXOR(F.col("z2")).alias("q2"), "bytes", "upto")
    roots = convs.select("conv", none.alias("depth"), *[none.alias(c) for c in ("d1", "d2", "q1", "q2", "bytes", "upto")])
    every = run.unionByName(roots).join(convs.withColumnRenamed("n", "length"), "conv")
    return every.select("conv", "depth", "d1", "d2", "q1", "q2", "bytes", "upto", (F.col("depth") == F.col("length")).alias("last"))


def _end_digests(ends: DataFrame) -> DataFrame:
    """``NODE`` and ``ends_sha256`` of nodes at which conversations end: the digest of all their ids, in order.

    The ids are sorted in pieces, each piece writes its part of a list as one text, and a stream feeds the parts to the
    digest one after the other, so no list is ever held whole."""
    pieces = sorted_pieces(ends.select(*NODE, "conv"), [*NODE, "conv"])
    part = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    parts = pieces.groupBy(*NODE, PIECE, F.floor(F.col(POS) / BLOCK).alias("_block")).agg(part.alias("ids"))
    dealt = parts.repartition(*NODE).sortWithinPartitions(*NODE, PIECE, "_block").select(*NODE, "ids")
    return dealt.mapInArrow(_hash_lists, "depth long, d1 long, d2 long, ends_sha256 string")


def _hash_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([*[(c, pa.int64()) for c in NODE], ("ends_sha256", pa.string())])
    node, digest, made = None, None, []
    for batch in batches:
        for *key, ids in zip(*[c.to_pylist() for c in batch.columns]):
            if key != node:
                if node is not None:
                    made.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield to_batch(made, schema)
        made = []
    if node is not None:
        yield to_batch([(*node, digest.hexdigest())], schema)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_nodes(coded: DataFrame, convs: DataFrame, largest: int = LARGEST) -> DataFrame:
    """One row for each distinct prefix of the conversations, the empty one included: ``conv_id`` (its smallest member),
    ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    ``coded`` are turns as ``coded_turns`` gives them, ``convs`` the conversations, also those without turns, and their
    numbers of turns ``n``. Without conversations there are no nodes. ``largest`` bounds the counters of a sketch row.
    """
    rows = stage(prefixes(coded, convs), "prefixes")
    width = sketch_width(rows.count(), largest)
    counted = sketch(rows.where("depth > 0"), width)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields) + ", alone boolean, below boolean"
    screened = stage(rows.mapInArrow(partial(_screen, blocks=counted, width=width), schema), "screened")
    no_end = F.sha2(F.lit(""), 256)
    ended = F.when(F.col("last"), F.sha2(F.col("conv").cast("string"), 256)).otherwise(no_end)
    tail = screened.where("alone")
    single = [F.lit(1).cast("long").alias("n_convs"), (~F.col("last")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
              F.lit(0).cast("long").alias("saved_tokens"), ended.alias("ends_sha256")]
    inner = tail.where("below").select(F.col("conv").alias("conv_id"), "depth", F.col("conv").alias("parent_conv_id"), *single)

    shared = screened.where("not alone")
    up = [(F.col("depth") - 1).alias("depth"), F.col("q1").alias("d1"), F.col("q2").alias("d2")]
    nodes = stage(shared.groupBy(*NODE).agg(
        F.min("conv").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.min("q1").alias("q1"), F.min("q2").alias("q2"), F.max("last").alias("ended")), "nodes")
    born = nodes.where("depth > 0").select(*up).unionByName(tail.where("not below").select(*up))
    children = born.groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_children"))
    known = stage(nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "known")
    # Of each member: the bytes up to its last prefix that a smaller member owns, and whether its end is a leaf of its own.
    linked = shared.join(known.select(*NODE, "owner", "n_children"), NODE)
    mine = F.col("owner") == F.col("conv")
    members = stage(linked.groupBy("conv").agg(
        F.coalesce(F.max(F.when(~mine, F.col("upto"))), F.lit(0)).alias("foreign"),
        F.coalesce(F.max(F.when(F.col("last"), (mine & (F.col("n_children") == 0)).cast("int"))), F.lit(1)).alias("leaf")), "members")
    sums = shared.join(members, "conv").groupBy(*NODE).agg(
        F.sum("leaf").alias("n_leaves"), F.sum(F.greatest(F.lit(0), F.col("foreign") - F.col("upto") + F.col("bytes"))).alias("saved_tokens"))
    ends = _end_digests(shared.where("last"))
    above = known.select(*[F.col(c).alias(f"p_{c}") for c in NODE], F.col("owner").alias("parent"))
    at_parent = (F.col("depth") - 1 == F.col("p_depth")) & (F.col("q1") == F.col("p_d1")) & (F.col("q2") == F.col("p_d2"))
    exact = known.join(sums, NODE).join(ends, NODE, "left").join(above, at_parent, "left").select(
        F.col("owner").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.coalesce("parent", "owner")).alias("parent_conv_id"), "n_convs",
        "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", no_end).alias("ends_sha256"))
    tops = tail.where("not below").join(above, at_parent).select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), *single)
    return exact.unionByName(tops).unionByName(inner).select(*COLUMNS)


# DuckDB has no CRC-32, so its eight steps for each byte of the id are spelled out.
NODES_SQL = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT DISTINCT conv_id, CAST(xor(list_reduce(flatten([[CAST(4294967295 AS BIGINT)], flatten(list_transform(
           string_split(CAST(conv_id AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))]),
           lambda c, b: CASE WHEN xor(c, b) % 2 = 1 THEN xor(xor(c, b) >> 1, 3988292384) ELSE xor(c, b) >> 1 END),
           4294967295) % {HEAD} AS BIGINT) AS h FROM turns),
built AS (
  SELECT ids.conv_id, 0 AS part, pos, role, text FROM ids JOIN turns b ON b.conv_id = ids.conv_id - ids.conv_id % {FAMILY} AND pos <= h
  UNION ALL SELECT ids.conv_id, 1, pos, role, text FROM ids JOIN turns USING (conv_id) WHERE pos > h),
deep AS (
  SELECT conv_id, row_number() OVER w AS depth, strlen(text) AS bytes, md5(role || chr(0) || text) AS code, count(*) OVER (PARTITION BY conv_id) AS length
  FROM built WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)),
paths AS (
  SELECT conv_id, depth, bytes, md5(string_agg(code, ',') OVER (PARTITION BY conv_id ORDER BY depth)) AS digest, depth = length AS last FROM deep
  UNION ALL SELECT conv_id, 0, 0, '', conv_id NOT IN (SELECT conv_id FROM deep) FROM ids),
linked AS (SELECT *, lag(digest) OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM paths),
nodes AS (
  SELECT depth, digest, any_value(parent) AS parent, min(conv_id) AS owner, count(*) AS n, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends FROM linked GROUP BY depth, digest),
children AS (SELECT parent AS digest, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2),
known AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (depth, digest)),
below AS (
  SELECT top.depth, top.digest, count(*) FILTER (WHERE known.n_children = 0) AS n_leaves, sum((known.n - 1) * known.bytes) AS saved
  FROM known JOIN paths top ON top.conv_id = known.owner AND top.depth <= known.depth GROUP BY 1, 2)
SELECT known.owner AS conv_id, CAST(known.depth AS BIGINT) AS depth, up.owner AS parent_conv_id, known.n AS n_convs, known.n_children,
       n_leaves, CAST(saved AS BIGINT) AS saved_tokens, known.ends AS ends_sha256
FROM known JOIN below USING (depth, digest) LEFT JOIN known up ON up.digest = known.parent AND up.depth = known.depth - 1"""
