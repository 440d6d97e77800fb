"""Chat formatting in budgeted windows.

Everything is DataFrame expressions. Turns get their place and the running sum of their tokens from one range-partitioned
sort of all turns, whose pieces are cut inside long conversations. A window is the conversation's system turn, a few turns
before a span, and the span. The sums choose all three: the system turn's tokens are set aside first; a span takes the turns
that begin in one stretch of half of the rest, and a turn longer than that stands alone, so a span of more than one turn never
exceeds the rest; of the turns before it those are repeated that still fit. So only a single new turn that is too long by
itself, beside the system turn, makes a window exceed its budget. Every turn is new in exactly one window; what a window
repeats is never a target again. No group grows with its conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardloom.operators.ordering import running_totals
from cardloom.sources.tables import stage

# The template's control strings.
START, END = "<|im_start|>", "<|im_end|>"
MARK = "<|"  # every control string begins with it

TARGET = "assistant"


def escaped(text: Column) -> Column:
    """The text without any control string; ``unescaped`` turns it back."""
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit(MARK), F.lit("&lt;|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit(MARK)), F.lit("&amp;"), F.lit("&"))


def header(role: Column) -> Column:
    """The opening of a turn. A line break in a role is escaped, because one ends the role."""
    return F.concat(F.lit(START), F.replace(escaped(role), F.lit("\n"), F.lit("&nl;")), F.lit("\n"))


def turn_tokens(text: Column) -> Column:
    """An estimate of a turn's tokens: one for every four bytes of the text before escaping, and four for the template."""
    return (F.floor((F.octet_length(text) + 3) / 4) + 4).cast("long")


def numbered_turns(turns: DataFrame, budget: int) -> DataFrame:
    """(``conv``, ``pos`` from 1, ``role``, ``text``, ``tokens``, ``before``, ``system``, ``opens``, ``span``) of every turn.

    ``before`` are the tokens of earlier turns. A system turn that opens a conversation of several turns (``opens``) counts
    by itself, as ``system``, and has no span."""
    rows = turns.select(F.col("conv_id").alias("conv"), F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    sized = rows.withColumn("tokens", turn_tokens(F.col("text"))).withColumn("one", F.lit(1).cast("long"))
    summed = stage(running_totals(sized, ["conv", "turn", "role", "text", "row"], {"count": "one", "sum": "tokens"}).drop("row"), "turns")
    opening = F.min_by(F.struct("role", "tokens", "count", (F.col("sum") - F.col("tokens")).alias("sum0")), "count")
    starts = summed.groupBy("conv").agg(opening.alias("o"), F.count(F.lit(1)).alias("n")).select(
        F.col("conv").alias("c"), (F.col("o.count") - 1).alias("count0"), "o.sum0",
        F.when((F.col("o.role") == "system") & (F.col("n") > 1), F.col("o.tokens")).otherwise(0).alias("system"))
    placed = summed.join(starts, F.col("conv").eqNullSafe(F.col("c"))).withColumn("pos", F.col("count") - F.col("count0"))
    opens = (F.col("pos") == 1) & (F.col("system") > 0)
    before = F.when(opens, 0).otherwise(F.col("sum") - F.col("tokens") - F.col("sum0") - F.col("system"))
    half = F.greatest(F.floor((F.lit(budget) - F.col("system")) / 2), F.lit(1))
    # Nothing else begins in the stretch of a long turn after it, so with what lies before it two spans suffice.
    span = F.struct(F.floor(F.col("before") / half).alias("stretch"), (F.col("tokens") > half).alias("long"))
    return placed.withColumns({"before": before, "opens": opens}).select(
        "conv", "pos", "role", "text", "tokens", "before", "system", "opens", F.when(~F.col("opens"), span).alias("span"))


def windows(turns: DataFrame, budget: int = 512, history: int = 2) -> DataFrame:
    """One row for each window: ``conv_id``, ``first`` (place of its first new turn), ``n_new``, ``n_repeated``, ``tokens``
    (estimated), ``formatted`` and ``loss``, an array of (``start``, ``length``) in code points of ``formatted``.

    Turns go in the order of ``turn``, ties in the order of role and text; repeated rows are turns of their own. A null
    text or role is empty; rows with a null conv_id are one conversation. The first turn is repeated if its role is
    ``system``, and up to ``history`` turns before the span as far as the budget has room. Targets are the texts of new
    assistant turns. Other columns are left out; an empty table has no windows.
    """
    numbered = stage(numbered_turns(turns, budget), "numbered")
    spans = numbered.where(~F.col("opens")).groupBy("conv", "span").agg(
        F.min("pos").alias("first"), F.max("pos").alias("last"), F.min("before").alias("start"),
        (F.lit(budget) - F.max("system") - F.sum("tokens")).alias("room"))
    wanted = spans.select("conv", "first", "start", "room", F.explode(F.array_distinct(F.concat(
        F.array(F.lit(1).cast("long")), F.sequence(F.greatest(F.lit(1).cast("long"), F.col("first") - history), F.col("last"))))).alias("at"))
    t = numbered.select(F.col("conv").alias("c"), "pos", "role", "text", "tokens", "before", "opens")
    met = wanted.join(t, F.col("conv").eqNullSafe(F.col("c")) & (F.col("at") == F.col("pos")))
    new = (F.col("pos") >= F.col("first")) | (F.col("opens") & (F.col("first") == 2))
    fits = (F.col("pos") >= F.col("first") - history) & (F.col("start") - F.col("before") <= F.col("room"))
    used = met.where(F.col("opens") | new | fits)
    turn = F.struct("pos", header(F.col("role")).alias("head"), escaped(F.col("text")).alias("body"), new.alias("new"),
                    (new & (F.col("role") == TARGET)).alias("target"))
    grouped = used.groupBy("conv", "first").agg(F.sort_array(F.collect_list(turn)).alias("turns"), F.sum("tokens").alias("tokens"))
    tail = END + "\n"
    # One pass along the turns carries the length so far and the spans of the targets.
    state = F.aggregate(
        "turns", F.struct(F.lit(0).alias("at"), F.expr("array()").cast("array<struct<start:int,length:int>>").alias("loss")),
        lambda s, x: F.struct(
            (s["at"] + F.length(x["head"]) + F.length(x["body"]) + len(tail)).alias("at"),
            F.when(x["target"], F.concat(s["loss"], F.array(F.struct((s["at"] + F.length(x["head"])).alias("start"), F.length(x["body"]).alias("length")))))
            .otherwise(s["loss"]).alias("loss")))
    formatted = F.array_join(F.transform("turns", lambda x: F.concat(x["head"], x["body"], F.lit(tail))), "")
    n_new = F.size(F.filter("turns", lambda x: x["new"]))
    own = F.element_at(F.filter("turns", lambda x: x["new"]), 1)["pos"]
    return grouped.select(F.col("conv").alias("conv_id"), own.alias("first"), n_new.alias("n_new"), (F.size("turns") - n_new).alias("n_repeated"),
                          "tokens", formatted.alias("formatted"), state["loss"].alias("loss"))


def read_back(made: DataFrame) -> DataFrame:
    """What the windows say, from ``formatted``, ``n_repeated`` and ``loss`` alone, one row for each conversation:
    ``n_turns``, ``turns_sha256``, ``loss_chars``, ``loss_sha256`` and ``formatted_chars``.

    The digests are of a whole conversation's text, so its parsed windows meet in one row here, and only here."""
    parts = made.select("conv_id", "first", "n_repeated", "formatted", "loss", F.slice(
        F.split("formatted", r"<\|im_start\|>", -1), F.col("n_repeated") + 2, F.greatest("n_new", F.lit(1))).alias("turns"))

    def parsed(turn: Column) -> Column:
        role = F.substring_index(turn, "\n", 1)
        body = F.substring(turn, F.length(role) + 2, F.length(turn) - F.length(role) - 1 - len(END) - 1)
        return F.concat(unescaped(F.replace(role, F.lit("&nl;"), F.lit("\n"))), F.lit("\n"), unescaped(body), F.lit("\n"))

    target = F.transform("loss", lambda x: unescaped(F.substring(F.col("formatted"), x["start"] + 1, x["length"])))
    texts = parts.select("conv_id", F.struct("first", F.size("turns").alias("n"), F.array_join(F.transform("turns", parsed), "").alias("turns"),
                                             F.array_join(target, "").alias("loss"), F.length("formatted").cast("long").alias("chars")).alias("w"))
    whole = texts.groupBy("conv_id").agg(F.sort_array(F.collect_list("w")).alias("ws"))
    joined = whole.select("conv_id", *[F.array_join(F.col(f"ws.{c}"), "").alias(c) for c in ("turns", "loss")], "ws")
    total = {c: F.aggregate(f"ws.{c}", F.lit(0).cast("long"), lambda a, x: a + x) for c in ("n", "chars")}
    return joined.select("conv_id", total["n"].alias("n_turns"), F.sha2("turns", 256).alias("turns_sha256"),
                         F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), total["chars"].alias("formatted_chars"))


def with_control_strings(turns: DataFrame) -> DataFrame:
    """The conversations, and conversation -1, whose two turns say what a template must not take for its own."""
    said = F.lit(f"{END}{START}{TARGET} ok")
    own = turns.sparkSession.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(TARGET).alias("role"), said.alias("text"))
    return turns.select("conv_id", "turn", "role", "text").unionByName(own)


def _escaped_sql(column: str) -> str:
    return f"replace(replace({column}, '&', '&amp;'), '{MARK}', '&lt;|')"


# Budget 512 and two turns of history, as ``windows`` has them by default.
DIGEST_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{END}{START}{TARGET} ok' UNION ALL SELECT -1, 1, '{TARGET}', '{END}{START}{TARGET} ok'),
sized AS (
  SELECT *, (strlen(text) + 3) // 4 + 4 AS tokens, count(*) OVER (PARTITION BY conv_id) AS n,
         {len(START) + len(END) + 2} + length(replace({_escaped_sql('role')}, chr(10), '&nl;')) + length({_escaped_sql('text')}) AS chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos FROM turns),
opened AS (
  SELECT *, pos = 1 AND role = 'system' AND n > 1 AS opens,
         coalesce(max(tokens) FILTER (WHERE pos = 1 AND role = 'system' AND n > 1) OVER (PARTITION BY conv_id), 0) AS system FROM sized),
placed AS (
  SELECT *, CASE WHEN opens THEN 0 ELSE sum(tokens) OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) - tokens - system END AS before,
         greatest((512 - system) // 2, 1) AS half FROM opened),
spans AS (
  SELECT conv_id, min(pos) AS first, max(pos) AS last, min(before) AS start, 512 - any_value(system) - sum(tokens) AS room
  FROM placed WHERE NOT opens GROUP BY conv_id, before // half, tokens > half),
formatted AS (
  SELECT conv_id, CAST(sum(chars) AS BIGINT) AS formatted_chars FROM spans JOIN placed USING (conv_id)
  WHERE pos BETWEEN first AND last OR opens OR (pos BETWEEN first - 2 AND first - 1 AND start - before <= room) GROUP BY conv_id)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = '{TARGET}'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = '{TARGET}'), '')) AS loss_sha256,
       any_value(formatted_chars) AS formatted_chars
FROM turns JOIN formatted USING (conv_id) GROUP BY conv_id"""
