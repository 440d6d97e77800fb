"""Best-fit packing of documents into sequences of several permitted lengths.

Items of one length are interchangeable, so the plan is made on the histogram of lengths, which has at most as many rows
as the largest permitted length has tokens, however large the corpus. For every set of permitted lengths that can hold
all items, best-fit goes through the lengths from the longest down: an item joins the open bin it fills best, else the bin
size of least cost for each token expected in it is opened. Equal bins are handled as one run of bin numbers. At the end
every bin shrinks to the smallest permitted length that holds its contents, and the cheapest of the plans is used.

Concrete items get their place in the order (length, key, piece) from a range-partitioned sort, and the plan gives that
place's bin. Both are exact; every token is placed once.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cardloom.llm import bpe
from cardloom.llm.batches import arrow_fields, ddl
from cardloom.operators.ordering import global_index
from cardloom.sources.tables import stage

CAPACITIES = (1024, 2048, 4096)


def step_cost(capacity: int) -> float:
    """Cost of one sequence: a constant, a part for each token, and attention's part for each pair of tokens."""
    return 256 + capacity + capacity * capacity / 16384


@dataclass
class Plan:
    """Runs of places and of bins. ``place`` is the first place of a run in the order from the longest item down; its
    items go to the bins from ``first_bin`` on, each at ``offset``. Bins from ``bin_start`` on have ``capacity``."""
    place: np.ndarray
    first_bin: np.ndarray
    offset: np.ndarray
    bin_start: np.ndarray
    capacity: np.ndarray
    cost: float


def best_fit(histogram: dict[int, int], opened: tuple[int, ...], permitted: tuple[int, ...],
             cost: Callable[[int], float]) -> Plan:
    """Pack with bins of the sizes ``opened``, then shrink them to ``permitted`` sizes."""
    runs: dict[int, deque] = {}  # room left -> runs of (first bin, number of bins, bin size)
    rooms: list[int] = []
    places, bins, place = [], 0, 0
    left = sum(length * n for length, n in histogram.items())

    def put(room: int, run: tuple[int, int, int]) -> None:
        if room not in runs:
            runs[room] = deque()
            insort(rooms, room)
        runs[room].append(run)

    for length in sorted(histogram, reverse=True):
        n = histogram[length]
        while n:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                size = min((c for c in opened if c >= length), key=lambda c: (cost(c) / min(c, left), c))
                fresh = -(-n // (size // length))
                put(size, (bins, fresh, size))
                bins += fresh
                continue
            room = rooms[at]
            first, count, size = runs[room].popleft()
            taken = min(n, count)
            if taken < count:
                runs[room].appendleft((first + taken, count - taken, size))
            elif not runs[room]:
                del runs[room], rooms[at]
            places.append((place, first, size - room))
            put(room - length, (first, taken, size))
            place, n, left = place + taken, n - taken, left - taken * length
    final = sorted((first, count, min(c for c in permitted if c >= size - room))
                   for room, found in runs.items() for first, count, size in found)
    columns = [np.array(c, np.int64) for c in (zip(*places) if places else ([], [], []))]
    starts, counts, sizes = [np.array(c, np.int64) for c in (zip(*final) if final else ([], [], []))]
    return Plan(*columns, starts, sizes, float(sum(n * cost(int(c)) for n, c in zip(counts, sizes))))


def plan(histogram: dict[int, int], capacities: tuple[int, ...] = CAPACITIES,
         cost: Callable[[int], float] = step_cost) -> Plan:
    """The cheapest best-fit plan over all sets of permitted sizes that can hold the longest item."""
    longest, permitted = max(histogram, default=0), tuple(sorted(capacities))
    sets = [s for k in range(1, len(permitted) + 1) for s in combinations(permitted, k) if s[-1] >= longest]
    return min((best_fit(histogram, s, permitted, cost) for s in sets), key=lambda p: p.cost)


def word_length(text: str = "text") -> Column:
    """Words of a text and one end mark."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")
    return F.size(words).cast("long") + 1


def pieces(docs: DataFrame, length: Column, limit: int, key: str = "doc_id") -> DataFrame:
    """(``key``, ``piece``, ``start``, ``n_tokens``): documents longer than ``limit`` in as few pieces as possible."""
    sized = docs.select(key, length.alias("_n")).where("_n > 0")
    numbered = sized.select(key, "_n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / limit))).alias("piece"))
    start = F.col("piece") * limit
    return numbered.select(key, "piece", start.alias("start"), F.least(F.lit(limit), F.col("_n") - start).cast("long").alias("n_tokens"))


def pack(docs: DataFrame, length: Column | None = None, capacities: tuple[int, ...] = CAPACITIES,
         cost: Callable[[int], float] = step_cost, key: str = "doc_id") -> DataFrame:
    """``key``, ``piece``, ``start``, ``n_tokens``, ``bin_id``, ``bin_offset`` and ``capacity`` of every piece.

    ``length`` defaults to the words of ``text`` and an end mark; rows whose length is null or 0 have nothing to place
    and give no row. Null keys and repeated rows are packed like others; other columns are left out.
    """
    limit = max(capacities)
    cut = stage(pieces(docs, word_length() if length is None else length, limit, key), "pieces")
    counts = cut.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``limit`` rows
    made = plan({r["n_tokens"]: r["n"] for r in counts}, tuple(capacities), cost)
    placed = global_index(cut, [F.desc("n_tokens"), key, "piece"], "place").select(*cut.columns, "place")
    fields = arrow_fields(cut, cut.columns)
    schema = pa.schema([*fields, ("bin_id", pa.int64()), ("bin_offset", pa.int64()), ("capacity", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column(len(fields)).to_numpy(zero_copy_only=False)
            at = np.searchsorted(made.place, place, "right") - 1
            bin_id = made.first_bin[at] + place - made.place[at]
            size = made.capacity[np.searchsorted(made.bin_start, bin_id, "right") - 1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(bin_id), pa.array(made.offset[at]), pa.array(size)], schema=schema)

    return placed.mapInArrow(run, f"{ddl(cut, cut.columns)}, bin_id long, bin_offset long, capacity long")


def pack_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``pack``, with the tokens of the tokenizer file ``path`` and one end mark as the length of a text.

    ``start`` and ``n_tokens`` count tokens; the end mark comes after a text's last one. One pass counts them, no ids are kept.
    """
    return pack(bpe.token_counts(docs, path, key, text), F.col("n_tokens") + 1, key=key)
