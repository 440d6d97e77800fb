"""Repair of conversation structure: the cheapest edits that make the roles alternate.

A whole conversation reads: nothing, or at most one system turn and then user and assistant in turns, assistant last. Turns
are kept (0), given the other role (2), deleted (3) or inserted without text (2); a truncated turn that stays costs one more,
blank and repeated turns must go.

1. Repeats: first turns of each (conversation, role, text) are aggregated, so that no task remembers what was said.
2. Turns are dealt out by conversation and sorted by turn. One stream over them carries four states across batches: what the
   repaired conversation ends with so far. Its cheapest edits to each state, and the order of these edits as strings, are
   all that the next turn needs; both are small numbers, so a step is looked up in a memo.
3. A step writes one byte for each state: where it came from and how. At the end of a conversation they are traced back.
4. A conversation beyond ``limit`` turns (or ``limit`` times 256 characters) is written out in open chunks, turns and bytes,
   whenever the limit is reached. A second stream over the bytes alone, last chunk first, closes them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from cardloom.llm.linededup import BLANK
from cardloom.sources.tables import stage

START, SYSTEM, USER, ASSISTANT = range(4)  # a repaired conversation is empty, or ends with such a turn
DEAD = 255
INSERTED = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # the role an added turn must have
NAMES = {USER: "user", ASSISTANT: "assistant"}
OTHER = 0  # role initials are coded like the states, all others as OTHER
MUST_GO, TRUNCATED = 4, 8  # flags of a turn's code
OPS = "DKR"
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}


# --- one step ---------------------------------------------------------------------------------------------------------

def _ways(costs: tuple, ranks: tuple) -> Iterator[tuple]:
    """(cost, rank, inserts, state, from) for every live state and zero to two inserts after it: two reach every state
    that inserts reach."""
    for state in range(4):
        if costs[state] is not None:
            at = state
            for inserts in range(3):
                yield costs[state] + 2 * inserts, ranks[state], inserts, at, state
                at = INSERTED[at]


@lru_cache(maxsize=200_000)
def step(costs: tuple, ranks: tuple, code: int) -> tuple[tuple, tuple, int, bytes]:
    """Costs and ranks after a turn, what was taken off all costs, and the four bytes of the way back.

    Ranks order the cheapest edits of the live states as strings. Edits to different states are never the beginning of one
    another: the longer would only add inserts, and both end with the edit of the same turn. So what comes later never
    changes their order, and of equally cheap edits to one state the least may be chosen at once."""
    kind, best = code & 3, {}

    def offer(to: int, cost: int, rank: int, inserts: int, op: str, origin: int) -> None:
        key = (cost, rank, "I" * inserts + op)
        if to not in best or key < best[to][0]:
            best[to] = key, origin | inserts << 2 | OPS.index(op) << 4

    for cost, rank, inserts, at, origin in _ways(costs, ranks):
        offer(at, cost + 3, rank, inserts, "D", origin)
        if not code & MUST_GO:
            stays = cost + bool(code & TRUNCATED)
            if (kind == SYSTEM and at == START) or (kind != OTHER and kind == INSERTED[at]):
                offer(kind, stays, rank, inserts, "K", origin)
            offer(INSERTED[at], stays + 2, rank, inserts, "R", origin)
    # A state that another beats whatever comes is dropped: the empty start may still keep a system turn (3), the rest
    # of a system turn's way is open to an assistant turn, too, and one insert leads from user to assistant.
    whole = min((best[s][0][0] + extra for s, extra in ((ASSISTANT, 0), (USER, 2)) if s in best), default=None)
    for state, slack in ((START, 3), (SYSTEM, 0)):
        if whole is not None and state in best and best[state][0][0] > whole + slack:
            del best[state]
    least = min(key[0] for key, _ in best.values())
    order = sorted(best, key=lambda s: best[s][0][1:])
    return (tuple(best[s][0][0] - least if s in best else None for s in range(4)),
            tuple(order.index(s) if s in best else None for s in range(4)), least,
            bytes(best[s][1] if s in best else DEAD for s in range(4)))


def ending(costs: tuple, ranks: tuple) -> tuple[int, int, int]:
    """(cost, state, inserts) of the cheapest end."""
    cost, _, inserts, state = min((cost, rank, inserts, origin) for cost, rank, inserts, at, origin in _ways(costs, ranks)
                                  if at == ASSISTANT or (at == START and not inserts))
    return cost, state, inserts


def trace(back: bytes, state: int, inserts: int) -> tuple[str, str, int]:
    """Edits of one chunk in order, each with the initial of the role it leaves (``-`` for a deleted turn), and the state
    before the chunk. ``state`` follows the last turn, ``inserts`` come after it."""
    edits: list[str] = []

    def inserted(after: int, n: int) -> str:
        made = ""
        for _ in range(n):
            after = INSERTED[after]
            made += "I" + NAMES[after][0]
        return made

    edits.append(inserted(state, inserts))
    for at in range(len(back) - 4, -4, -4):
        way = back[at + state]
        origin, n, op = way & 3, way >> 2 & 3, OPS[way >> 4]
        edits.append(inserted(origin, n) + op + ("-" if op == "D" else "=" if op == "K" else NAMES[state][0]))
        state = origin
    whole = "".join(reversed(edits))
    return whole[0::2], whole[1::2], state


def edited(roles: list, texts: list, audit: str, left: str) -> tuple[list[str], list[str]]:
    """The turns of a chunk after its edits."""
    new_roles, new_texts, rows = [], [], zip(roles, texts)
    names = {n[0]: n for n in NAMES.values()}
    for op, initial in zip(audit, left):
        role, text = ("", "") if op == "I" else next(rows)
        if op != "D":
            new_roles.append(role if op == "K" else names[initial])
            new_texts.append(text)
    return new_roles, new_texts


# --- the stream -------------------------------------------------------------------------------------------------------

TOTALS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
CHUNK = ("conv string, chunk long, audit string, roles array<string>, texts array<string>, back binary, state int, inserts int, "
         + ", ".join(f"{c} long" for c in TOTALS))


class Conversation:
    """What is carried along one conversation."""

    def __init__(self, name: str | None) -> None:
        self.name, self.chunk = name, 0
        self.costs, self.ranks, self.cost = (0, None, None, None), (0, None, None, None), 0
        self.last = self.kind = self.low = self.high = None
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self._clear()

    def _clear(self) -> None:
        self.roles, self.texts, self.back, self.chars = [], [], bytearray(), 0

    def add(self, turn: str | None, role: str, text: str, code: int, again: bool) -> None:
        if turn is not None:
            place = int(turn)
            self.distinct += place != self.high
            self.low, self.high = place if self.low is None else self.low, place
        if code & MUST_GO:
            self.blank += 1
        elif again or self.last == (turn, role, text):
            self.duplicate, code = self.duplicate + 1, code & 3 | MUST_GO
        elif code & TRUNCATED:
            self.truncated += 1
        kind = code & 3
        self.illegal += self.kind is not None and (self.kind, kind) not in LEGAL
        self.last, self.kind = (turn, role, text), kind
        self.costs, self.ranks, more, back = step(self.costs, self.ranks, code)
        self.cost += more
        self.back += back
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)

    def spill(self) -> tuple:
        row = (self.name, self.chunk, None, self.roles, self.texts, bytes(self.back), None, None, *[None] * len(TOTALS))
        self.chunk += 1
        self._clear()
        return row

    def close(self) -> tuple:
        cost, state, inserts = ending(self.costs, self.ranks)
        gaps = 0 if self.high is None else self.high - self.low + 1 - self.distinct
        totals = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost + cost)
        if self.chunk:
            return self.name, self.chunk, None, self.roles, self.texts, bytes(self.back), state, inserts, *totals
        audit, left, _ = trace(self.back, state, inserts)
        return self.name, 0, audit, *edited(self.roles, self.texts, audit, left), None, None, None, *totals


def _frames(rows: Iterator[tuple], columns: list[str], size: int) -> Iterator[pd.DataFrame]:
    made: list[tuple] = []
    weight = 0
    for row in rows:
        made.append(row)
        weight += 1 + sum(len(x) for x in row if isinstance(x, list)) // 2
        if weight >= size:
            yield pd.DataFrame(made, columns=columns, dtype=object)
            made, weight = [], 0
    if made:
        yield pd.DataFrame(made, columns=columns, dtype=object)


def _column_names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _stream(batches: Iterator[pd.DataFrame], limit: int) -> Iterator[pd.DataFrame]:
    def rows() -> Iterator[tuple]:
        current = None
        for batch in batches:
            for conv, turn, role, text, code, again, here in zip(*[batch[c].tolist() for c in batch.columns]):
                if current is None or conv != current.name:
                    if current is not None:
                        yield current.close()
                    current = Conversation(conv)
                if not here:
                    continue
                if len(current.back) >= 4 * limit or current.chars >= 256 * limit:
                    yield current.spill()
                current.add(turn, role, text, code, again)
        if current is not None:
            yield current.close()

    return _frames(rows(), _column_names(CHUNK), limit)


TRACED = "conv string, chunk long, audit string, left string"


def _trace_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunks of a conversation, last first: each one's edits, and the state before it goes on to the next."""
    def rows() -> Iterator[tuple]:
        state = 0
        for batch in batches:
            for conv, chunk, back, end, inserts in zip(*[batch[c].tolist() for c in batch.columns]):
                final = end == end and end is not None
                audit, left, state = trace(back, int(end) if final else state, int(inserts) if final else 0)
                yield conv, chunk, audit, left
    return _frames(rows(), _column_names(TRACED), 64)


def _apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        pairs = [edited(r, t, a, x) for r, t, a, x in zip(batch["roles"], batch["texts"], batch["audit"], batch["left"])]
        batch["roles"], batch["texts"] = [p[0] for p in pairs], [p[1] for p in pairs]
        yield batch[["conv", "chunk", "audit", "roles", "texts", *TOTALS]]


# --- the operator -----------------------------------------------------------------------------------------------------

def _coded(role: Column, text: Column) -> Column:
    """Role initial and faults of a turn as one number."""
    core = F.btrim(text, F.lit(BLANK))
    kind = F.when(F.startswith(role, F.lit("s")), SYSTEM).when(F.startswith(role, F.lit("u")), USER).when(
        F.startswith(role, F.lit("a")), ASSISTANT).otherwise(OTHER)
    return kind + F.when(core == "", MUST_GO).when(~F.right(core, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(0)


def repair(turns: DataFrame, limit: int = 20_000, here: str | None = None) -> DataFrame:
    """The repaired turns in chunks: ``conv_id``, ``chunk`` (from 0), ``audit`` (the chunk's edits in order: Keep, Rerole,
    Delete, Insert), ``roles`` and ``texts`` of what remains, and on the last chunk of a conversation ``gaps``, ``blank``,
    ``duplicate``, ``truncated``, ``illegal`` and ``cost``.

    Turns go in the order of ``turn``, nulls first, ties in the order of role and text; a null role or text is one space.
    Rows with a null conv_id are one conversation. A row whose ``here`` is false stands for its conversation only.
    An empty role has no initial and is never kept. Repeated rows are repeats of a turn, which go. Other columns are left out; an empty table gives no rows.
    """
    rows = turns.select(F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("long"), F.coalesce("role", F.lit(" ")).alias("role"),
                        F.coalesce("text", F.lit(" ")).alias("text"), (F.col(here) if here else F.lit(True)).alias("here"))
    keyed = rows.withColumns({"k1": F.xxhash64("conv", "role", "text"), "k2": F.xxhash64(F.lit(1), "conv", "role", "text")})
    untimed = F.col("turn").isNull()
    said = keyed.where("here").groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.max(untimed).alias("untimed"), F.min("turn").alias("first"))
    repeated = stage(said.where("n > 1").drop("n"), "repeated")
    again = F.coalesce(~untimed & (F.col("untimed") | (F.col("turn") > F.col("first"))), F.lit(False))
    marked = keyed.join(repeated, ["k1", "k2"], "left").select(
        "conv", F.col("turn").alias("place"), "role", "text", _coded(F.col("role"), F.col("text")).alias("code"), again.alias("again"), "here")
    order = ["conv", "place", "role", "text"]
    dealt = marked.repartition("conv").sortWithinPartitions(*order).select(
        "conv", F.col("place").cast("string").alias("turn"), "role", "text", "code", "again", "here")
    streamed = stage(dealt.mapInPandas(partial(_stream, limit=limit), CHUNK), "streamed")
    kind = turns.schema["conv_id"].dataType
    whole = streamed.where(F.col("audit").isNotNull()).select("conv", "chunk", "audit", "roles", "texts", *TOTALS)
    spilled = streamed.where(F.col("audit").isNull())
    if not spilled.isEmpty():
        back = (spilled.select("conv", "chunk", "back", "state", "inserts").repartition("conv").sortWithinPartitions("conv", F.desc("chunk")))
        traced = stage(back.mapInPandas(_trace_back, TRACED), "traced").withColumnsRenamed({"conv": "c", "chunk": "k"})
        met = spilled.drop("audit").join(traced, F.col("conv").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k")))
        whole = whole.unionByName(met.select(*whole.columns, "left").mapInPandas(
            _apply, "conv string, chunk long, audit string, roles array<string>, texts array<string>, " + ", ".join(f"{c} long" for c in TOTALS)))
    return whole.select(F.col("conv").cast(kind).alias("conv_id"), *whole.columns[1:])


def digests(chunks: DataFrame) -> DataFrame:
    """One row for each conversation of ``repair``: its totals, the whole ``audit`` and ``repaired_sha256``, the digest of
    the repaired ``role:text`` joined by line breaks. Only conversations of several chunks are brought together for it."""
    lines = F.array_join(F.transform(F.arrays_zip("roles", "texts"), lambda x: F.concat(x["roles"], F.lit(":"), x["texts"])), "\n")
    said = chunks.select("conv_id", "chunk", "audit", F.when(F.size("roles") > 0, lines).alias("lines"), *TOTALS).withColumn(
        "single", (F.col("chunk") == 0) & F.col("cost").isNotNull())
    out = ["conv_id", *TOTALS[:5], "cost", "audit"]
    alone = said.where("single").select(*out, F.sha2(F.coalesce("lines", F.lit("")), 256).alias("repaired_sha256"))
    parts = F.sort_array(F.collect_list(F.struct("chunk", "audit", "lines")))
    many = said.where("not single").groupBy("conv_id").agg(parts.alias("p"), *[F.max(c).alias(c) for c in TOTALS]).select(
        "conv_id", *TOTALS, F.array_join("p.audit", "").alias("audit"), F.sha2(F.array_join("p.lines", "\n"), 256).alias("repaired_sha256"))
    return alone.unionByName(many)


# --- the registered query ---------------------------------------------------------------------------------------------

def damage(turns: DataFrame) -> DataFrame:
    """Conversations with faults, chosen by the checksum of ``conv_id:turn``; ``here`` is false for a row that is gone."""
    space = F.lit(" ")
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), space) if c else F.lit(":") for c in ("conv_id", None, "turn")])
    fault = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    rows = turns.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (fault != 0).alias("here"), F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return rows.drop("copy")
