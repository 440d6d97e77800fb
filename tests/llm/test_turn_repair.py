"""Conversation repair against every possible edit, and against a plain dynamic programme."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from cardloom.llm import queries, turnrepair

WHOLE = re.compile(r"(s?(ua)+)?")
TURNS = "conv_id long, turn long, role string, text string, conv string, code int, k1 long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def faults(rows):
    """(must go, truncated) of every row, and the counts."""
    seen, found, counts = set(), [], [0, 0, 0]
    for role, text in rows:
        core = text.strip(" \t\n\x0b\f\r")
        which = 0 if not core else 1 if (role, text) in seen else 2 if core[-1] not in ".!?" else None
        seen.add((role, text))
        if which is not None:
            counts[which] += 1
        found.append((which in (0, 1), which == 2))
    return found, counts


def all_edits(rows):
    """Cheapest edits by trying every string of edits with up to two inserts at a place."""
    found, _ = faults(rows)
    best = None
    gaps = [""] + ["u", "a", "ua", "au", "uu", "aa"]
    options = [gaps]
    for (role, _), (must, cut) in zip(rows, found):
        options += [[("D", "", 3)] + ([] if must else [("K", role[:1] or "-", cut), ("R", "u", 2 + cut), ("R", "a", 2 + cut)]), gaps]
    for choice in itertools.product(*options):
        cost, audit, roles = 0, "", ""
        for c in choice:
            if isinstance(c, str):
                cost, audit, roles = cost + 2 * len(c), audit + "I" * len(c), roles + c
            else:
                cost, audit, roles = cost + c[2], audit + c[0], roles + c[1]
        if WHOLE.fullmatch(roles) and (best is None or (cost, audit, roles) < best):
            best = cost, audit, roles
    return best


def plain(rows):
    """Cheapest edits from the end: least (cost, edits) of every rest of the rows after every kind of last turn."""
    found, _ = faults(rows)
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    table = {}
    for i in range(len(rows), -1, -1):
        here = {}
        for spare in (0, 1, 2):  # inserts still allowed at this place
            for last in ("", "s", "u", "a"):
                options = []
                if i == len(rows):
                    if last in ("", "a"):
                        options.append((0, "", ()))
                else:
                    must, cut = found[i]
                    cost, edits, roles = table[i + 1][last]
                    options.append((cost + 3, "D" + edits, roles))
                    if not must:
                        kept = rows[i][0][:1]
                        if kept and kept in follows[last]:
                            cost, edits, roles = table[i + 1][kept]
                            options.append((cost + cut, "K" + edits, (None, *roles)))
                        for new in follows[last].replace("s", ""):
                            cost, edits, roles = table[i + 1][new]
                            options.append((cost + cut + 2, "R" + edits, (new, *roles)))
                if spare:
                    for new in follows[last].replace("s", ""):
                        cost, edits, roles = here[spare - 1, new]
                        options.append((cost + 2, "I" + edits, (new, *roles)))
                here[spare, last] = min(options, key=lambda o: o[:2]) if options else (10 ** 9, "", ())
        table[i] = {last: here[2, last] for last in ("", "s", "u", "a")}
    return table[0][""]


def expected(rows):
    """Everything about one conversation of (turn, role, text), sorted."""
    pairs = [r[1:] for r in rows]
    _, (blank, duplicate, truncated) = faults(pairs)
    cost, audit, roles = plain(pairs)
    names, left, todo, done = {"u": "user", "a": "assistant"}, iter(roles), iter(pairs), []
    for op in audit:
        role, text = ("", "") if op == "I" else next(todo)
        if op != "D":
            new = next(left)
            done.append((names[new] if new else role) + ":" + text)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    turns = {t for t, *_ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return gaps, blank, duplicate, truncated, illegal, cost, audit, sha("\n".join(done))


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def by_conversation(table):
    found = defaultdict(list)
    for r in table.collect():
        found[r.conv_id].append((r.turn, " " if r.role is None else r.role, " " if r.text is None else r.text))
    return found


def conversations(seed, n, longest):
    rng = random.Random(seed)
    for _ in range(n):
        yield [(rng.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]), rng.choice(["A.", "b", "", "C!", "d e", "f?", " \t"]) + rng.choice(["", "", " x."]))
               for _ in range(rng.randrange(longest + 1))]


def streamed(rows):
    conversation = turnrepair.Conversation("1")
    found, _ = faults(rows)
    seen = set()
    for i, (role, text) in enumerate(rows):
        must, cut = found[i]
        blank = not text.strip(" \t\n\x0b\f\r")
        code = {"s": 1, "u": 2, "a": 3}.get(role[:1], 0) + (4 if blank else 8 if text.rstrip(" \t\n\x0b\f\r")[-1] not in ".!?" else 0)
        conversation.add(str(i), role, text, code, must and not blank)
    return conversation.close()


def test_the_plain_programme_equals_trying_all_edits():
    for rows in conversations(1, 60, 3):
        cost, audit, _ = plain(rows)
        assert (cost, audit) == all_edits(rows)[:2]


def test_steps_equal_the_plain_programme():
    for rows in [*conversations(2, 4000, 12), *conversations(3, 40, 300)]:
        row, wanted = streamed(rows), expected([(i, *r) for i, r in enumerate(rows)])
        assert (*row[8:], row[2], sha("\n".join(f"{a}:{b}" for a, b in zip(row[3], row[4])))) == wanted
    assert turnrepair.step.cache_info().currsize < 20_000  # states stay few, however long conversations get


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(4)
    rows = []
    for c, talk in enumerate(conversations(5, 120, 14)):
        rows += [(c, i + (i > 5) * rng.randrange(3), *r) for i, r in enumerate(talk)]
    rows += [(500, i, ("user", "assistant")[rng.randrange(2)], f"turn {i % 40}" + rng.choice([".", "", "!"])) for i in range(700)]
    rows += [(501, None, None, None), (501, None, "user", "Hi."), (501, 3, "user", "Hi."), (501, 3, "user", "Hi."), (501, 3, "assistant", "Yes.")]
    rows += [(None, 1, "user", "Hello."), (None, None, "assistant", "first"), (502, None, None, None), (503, 0, "assistant", "long " * 60_000 + ".")]
    return [(*r, "other", 5, None) for r in rows]


@pytest.mark.parametrize("limit", [20_000, 7, 1])
def test_the_operator_equals_the_plain_programme(spark, odd_rows, limit):
    table = spark.createDataFrame(odd_rows, TURNS).repartition(5)
    wanted = {c: expected(in_order(rows)) for c, rows in by_conversation(table).items()}
    chunks = turnrepair.repair(table, limit=limit)
    assert {r.conv_id: tuple(r)[1:] for r in turnrepair.digests(chunks).collect()} == wanted
    assert limit > 1000 or chunks.where("chunk > 3").count() > 0
    assert turnrepair.digests(turnrepair.repair(table.where("false"), limit=limit)).collect() == []


@pytest.mark.parametrize("source", ["table", "odd"])
def test_the_query_damages_and_repairs(spark, sf, tmp_path, odd_rows, source):
    folder = sf
    if source == "odd":
        folder = str(tmp_path)
        spark.createDataFrame(odd_rows, TURNS).write.parquet(f"{folder}/conversations.parquet")
    wanted = {}
    for conv, rows in by_conversation(spark.read.parquet(f"{folder}/conversations.parquet")).items():
        left = []
        for turn, role, text in rows:
            fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            if fault:
                text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
                left += [(turn, "user" if fault == 4 else role, text)] * (1 + (fault == 3))
        wanted[conv] = expected(in_order(left))
    got = queries.QUERIES["op11_turn_repair"](spark, folder)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r.conv_id: tuple(r)[1:] for r in got.collect()} == wanted
