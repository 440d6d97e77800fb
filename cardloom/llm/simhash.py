"""Near-duplicate groups by SimHash.

1. Fingerprints: word shingles are hashed and each of 64 bits votes. One pass over the scan, no shuffle.
2. Equal fingerprints meet first, so that copies never form pairs.
3. Distinct fingerprints are embedded as the bit counts of their segments. The Manhattan distance of two embeddings is
   at most the Hamming distance of the fingerprints. Two integer points within distance 2 share a grid point within
   distance 1 of both, so each fingerprint enters the grid cells at distance 0 and 1 and an equi-join on the cell finds
   every pair; the pairs are then checked exactly with xor and a bit count.
4. A crowded cell would pair all with all. Its fingerprints go to the finest grid, whose segments are single bits: there
   the bound is exact, a cell holds at most 65 fingerprints, all of them linked, and the smallest stands for the cell.
   So no link is lost and no cell makes pairs beyond a constant.
5. Components: alternating large-star and small-star steps on the links, each written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from cardloom.llm.batches import arrow_fields, ddl, row_map, texts_as_bytes
from cardloom.llm.prefixtrie import LARGEST, estimates, opened, sketch, sketch_width
from cardloom.sources.tables import stage

BITS, SEED, BLOCK = 64, 42, 1 << 16
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def votes(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit."""
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    if len(octets) < 256:
        return np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.concatenate([np.bincount(octets[:, i], minlength=256) @ BYTE_BITS for i in range(8)])


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Signed 64-bit SimHash of the word shingles of a UTF-8 text; 0 without words."""
    words = (text or b"").lower().split()  # bytes: exactly A-Z and the six ASCII white-space characters
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    total, n = np.zeros(BITS, np.int64), len(words) - size + 1
    for at in range(0, n, BLOCK):
        spans = zip(starts[at:min(at + BLOCK, n)].tolist(), ends[at + size - 1:min(at + BLOCK, n) + size - 1].tolist())
        digest = xxhash.xxh64_intdigest
        total += votes(np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64))
    bits = np.packbits(2 * total > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``version`` (a hash of the text, which tells apart rows that share a key) and ``fp`` of every row."""
    found = docs.select(key, F.xxhash64(text).alias("version"), text)
    kept = [key, "version"]
    schema = pa.schema([*arrow_fields(found, kept), ("fp", pa.int64())])

    def rows(batch: pa.RecordBatch):
        yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                       map(partial(fingerprint, shingle=shingle), texts_as_bytes(batch.column(2))))

    return found.mapInArrow(row_map(rows, schema), f"{ddl(found, kept)}, fp long")


def segment_counts(fp: Column, width: int) -> Column:
    """The embedding, packed into one long: each segment's bit count plus one, in three bits.

    The added one keeps the neighbours below and above inside their own place."""
    code = F.lit(0).cast("long")
    for i in range(BITS // width):
        count = F.bit_count(F.shiftrightunsigned(fp, i * width).bitwiseAND(F.lit((1 << width) - 1))) + 1
        code = code.bitwiseOR(F.shiftleft(count.cast("long"), 3 * i))
    return code


def grid_cells(fps: DataFrame, width: int = 4) -> DataFrame:
    """``fp`` and each grid ``cell`` at Manhattan distance 0 or 1 of its embedding."""
    steps = [0, *[s << 3 * i for i in range(BITS // width) for s in (1, -1)]]
    offsets = F.from_json(F.lit(str(steps)), "array<long>")
    return fps.select("fp", F.explode(F.transform(offsets, lambda s: F.col("code") + s)).alias("cell"))


def bit_cells(fps: DataFrame) -> DataFrame:
    """``fp`` and each cell of the grid of single bits: itself and all that differ in one bit."""
    flips = F.concat(F.array(F.lit(0).cast("long")), F.transform(
        F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)))
    return fps.select("fp", F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("cell"))


def links(fps: DataFrame, distance: int = 2, width: int = 4, crowd: int = 64) -> DataFrame:
    """Links ``a`` > ``b`` between distinct fingerprints (column ``fp``) that keep every component of "differ in at
    most ``distance`` bits" whole: all such pairs of uncrowded cells, and for crowded cells a star for each fine cell.

    The cells at distance 0 and 1 meet for a ``distance`` of one or two bits.
    """
    if distance not in (1, 2):
        raise ValueError("the grid finds links at one or two bits")
    coded = fps.select("fp", segment_counts(F.col("fp"), width).alias("code"))
    cells = stage(grid_cells(coded, width), "grid")
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = stage(cells.join(sizes, "cell"), "met")
    few = met.where(F.col("n") <= crowd)
    pairs = (few.select("cell", F.col("fp").alias("a")).join(few.select("cell", F.col("fp").alias("b")), "cell")
             .where("a > b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance).select("a", "b"))
    fine = bit_cells(met.where(F.col("n") > crowd).select("fp").distinct())
    # Two in one fine cell differ in at most two bits; for a limit of one bit only the cell's own fingerprint links.
    if distance == 2:
        groups = fine.groupBy("cell").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)  # 65 at most
        stars = groups.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b")).where("a > b")
    else:
        own = fine.groupBy("cell").agg(F.collect_list("fp").alias("fps")).where(F.array_contains("fps", F.col("cell")))
        stars = (own.select(F.explode("fps").alias("x"), "cell").where("x <> cell")
                 .select(F.greatest("x", "cell").alias("a"), F.least("x", "cell").alias("b")))
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, of all nodes in ``edges`` (``a`` > ``b``).

    Alternates large-star (each node hands its larger neighbours to its smallest one) and small-star (the same for
    the smaller ones) until nothing changes; the number of rounds grows with the logarithm of the longest chain.
    """
    edges = stage(edges, "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = stage(_star(both, larger=True), "large")
        edges = stage(_star(edges, larger=False), "small")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """``pairs`` holds (a, b): b is a neighbour of a. Each a links its neighbours to the smallest of them and itself."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = pairs.join(least, "a")
    if larger:
        made = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        made = joined.select("b", "m").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return made.where("a <> b").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id`` (the smallest key reachable) of every row.

    Null and blank texts have fingerprint zero and link like any other. Rows with a null key are grouped, but a null is
    nobody's smallest key unless a component has no other. Repeated rows stay. Extra columns are left out.
    """
    marked = stage(fingerprints(docs, shingle, key, text), "fingerprints")
    named = groups(marked, distance, key).select("fp", "component_id")
    return marked.join(named, "fp").select(key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def groups(marked: DataFrame, distance: int, key: str) -> DataFrame:
    """``fp``, ``root`` (a fingerprint that names its component) and ``component_id`` of every fingerprint."""
    own = stage(marked.groupBy("fp").agg(F.min(key).alias("least")), "distinct")
    tree = components(links(own.select("fp"), distance))
    rooted = own.join(tree, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return stage(rooted.join(names, "root").select("fp", "root", "component_id"), "components")


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 2, key: str = "doc_id", text: str = "text",
             largest: int = LARGEST) -> DataFrame:
    """One row of each group of near duplicates, with all its columns: the row with the group's smallest key.

    Of rows that share key and text one stays, of rows that share only the key the one whose text hashes lowest. A row
    with a null key stays only where its group has no other key.

    The texts stay where they lie. Count-min sketches of the identities that stay and of those that go, of a size bounded by
    ``largest``, settle nearly all rows in place: one that no loser can be and that occurs once stays, one that no keeper can
    be goes. Only repeats of a keeper, and rows on which the sketches are not sure, are shuffled and settled exactly.
    """
    marked = stage(fingerprints(docs, shingle, key, text), "fingerprints")
    order = F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("k"), F.col("version").alias("v")))
    chosen = (marked.join(groups(marked, distance, key), "fp").groupBy("root").agg(order.alias("best"))
              .select("best.k", "best.v").distinct())
    chosen = stage(chosen.select(*_identity(F.col("k"), F.col("v"))), "chosen")
    rows = marked.select(*_identity(F.col(key), F.col("version"))).join(chosen.withColumn("stays", F.lit(True)), ["a", "b"], "left")
    rows = stage(rows.select(F.col("a").alias("d1"), F.col("b").alias("d2"), F.col("stays").isNotNull().alias("stays")), "fates")
    width = sketch_width(rows.count(), largest)
    fate = _fate(sketch(rows.where("stays"), width), sketch(rows.where("not stays"), width), width)
    packed = docs.select(F.struct("*").alias("row"), *_identity(F.col(key), F.xxhash64(text)))
    told = packed.select("row", "a", "b", fate("a", "b").alias("fate"))
    asked = told.where(F.col("fate") == ASK).groupBy("a", "b").agg(F.any_value("row").alias("row")).join(chosen, ["a", "b"], "left_semi")
    return told.where(F.col("fate") == STAY).select("row.*").unionByName(asked.select("row.*"))


GO, STAY, ASK = 0, 1, 2


def _fate(keepers: Broadcast, losers: Broadcast, width: int) -> Callable:
    @F.pandas_udf("int")
    def fate(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        stay, go = opened(keepers, width), opened(losers, width)
        for a, b in batches:
            ids = a.to_numpy(np.int64), b.to_numpy(np.int64)
            staying, going = estimates(stay, width, *ids), estimates(go, width, *ids)
            yield pd.Series(np.where(staying == 0, GO, np.where((staying == 1) & (going == 0), STAY, ASK)))
    return fate


def _identity(key: Column, version: Column) -> list[Column]:
    """128 bits that stand for a key, null or not, and a text."""
    return [F.xxhash64(key, version).alias("a"), F.xxhash64(key, version, F.lit(1)).alias("b")]
