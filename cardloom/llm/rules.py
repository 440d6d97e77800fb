"""Quality rules: word statistics of whole texts, and a decision list learned from labels.

Everything is DataFrame expressions. The statistics stay inside their row, so the pass over the texts shuffles nothing.
Learning is sequential covering: a rule for poor documents grows by the threshold literal of the highest information
gain, is pruned on labelled documents it was not grown on, and removes what it covers before the next rule grows.
Each step sees all labelled documents as counts for each (feature, bin); only those counts, at most features x bins
rows, reach the driver. The finished list is one Spark conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from cardloom.sources.tables import stage

SPACE = r"[\x20\x09-\x0D]"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_lines", "n_marks", "n_upper"]

# What the learned rules may test; each is 0 for a text without words.
FEATURES = {
    "word_length": "word_chars / n_words", "symbol_rate": "n_symbols / n_words", "dup_line_share": "n_dup_lines / n_lines",
    "repeat_share": "n_repeat_words / n_words", "mark_rate": "n_marks / n_words", "upper_share": "n_upper / word_chars",
    "words_per_line": "n_words / n_lines",
}


def occurrences(character: str) -> Column:
    """How many characters of ``_t`` match a pattern of one character."""
    return (F.length("_t") - F.length(F.regexp_replace("_t", character, ""))).cast("long")


def with_statistics(rows: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and the statistics of the text column, computed inside the row.

    Each select uses the one before it, so that no array is computed twice. Repeated three-word windows are found by
    sorting (hash, position) pairs of the row: n log n, however repetitive the text.
    """
    named = rows.select(*keep, F.coalesce(text, F.lit("")).alias("_t"))
    split = named.select("*", F.array_remove(F.split("_t", SPACE + "+"), "").alias("_w"), F.split("_t", "\n", -1).alias("_l"))
    blank = F.lit(" \t\n\u000b\f\r")
    counted = split.select(
        *keep, F.size("_w").cast("long").alias("n_words"), F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        occurrences("[#*$%&|<>]").alias("n_symbols"),
        F.size("_l").cast("long").alias("n_lines"), F.filter("_l", lambda x: F.length(F.btrim(x, blank)) > 0).alias("_l"),
        occurrences("!").alias("n_marks"),
        occurrences(r"\p{Lu}").alias("n_upper"),
        F.transform(F.slice("_w", 1, F.greatest(F.size("_w") - 2, F.lit(0))),
                    lambda w, i: F.xxhash64(w, F.col("_w")[i + 1], F.col("_w")[i + 2])).alias("_h"))
    done = [*keep, "n_words", "word_chars", "n_symbols", "n_lines", "n_marks", "n_upper"]
    repeats = F.size(F.array_distinct("_h")) < F.size("_h")
    paired = counted.select(
        *done, (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.when(repeats, F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_s"))
    rest = F.size("_s") - 1
    found = paired.select(*done, "n_dup_lines", F.when(F.col("_s").isNotNull(), F.array_distinct(F.flatten(F.array_compact(
        F.zip_with(F.slice("_s", 1, rest), F.slice("_s", 2, rest),
                   lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))))))).alias("_p"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("_p", lambda i: F.array(i, i + 1, i + 2)))))
    return sealed(found.select(*done, "n_dup_lines",
                               F.when(F.col("_p").isNull(), 0).otherwise(covered).cast("long").alias("n_repeat_words")))


def sealed(df: DataFrame) -> DataFrame:
    """The same rows; a filter set later is not pushed below, where it would repeat the array work for each element."""
    return df.select("*", F.monotonically_increasing_id().alias("_seal")).where("_seal >= 0").drop("_seal")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def feature_columns() -> list[Column]:
    return [F.coalesce(F.try_divide(*[F.col(c).cast("double") for c in e.split(" / ")]), F.lit(0.0)).alias(n)
            for n, e in FEATURES.items()]


@dataclass(frozen=True)
class Literal:
    """``feature > cut`` if ``above``, else ``feature <= cut``; ``bin`` counts the cuts below the feature's value."""
    feature: str
    above: bool
    bin: int
    cut: float

    def on_bins(self) -> Column:
        return F.col(f"b_{self.feature}") > self.bin if self.above else F.col(f"b_{self.feature}") <= self.bin

    def sql(self) -> str:
        return f"`{self.feature}` {'>' if self.above else '<='} {self.cut!r}D"


Rule = tuple[Literal, ...]


def every(rule: Rule) -> Column:
    made = F.lit(True)
    for literal in rule:
        made = made & literal.on_bins()
    return made


def decision_sql(rules: list[Rule]) -> str:
    """The decision list as a Spark conditional: false where a rule rejects, else true."""
    cases = " ".join(f"WHEN {' AND '.join(x.sql() for x in rule)} THEN false" for rule in rules)
    return f"CASE {cases} ELSE true END" if rules else "true"


def learn(statistics: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", bins: int = 32,
          max_rules: int = 12, max_literals: int = 3, least_covered: int = 5, least_precision: float = 0.9) -> list[Rule]:
    """Rules that reject documents like those whose ``label`` is 0, most valuable first.

    ``statistics`` has the columns of ``with_statistics``; documents that fail the base rules teach nothing. A document
    labelled twice counts as good if one label says so; null labels and null keys are ignored. Without labelled
    documents of both kinds the list is empty. A rule is kept if, on the third of the labelled documents kept for
    pruning, it covers poor documents and is right for ``least_precision`` of what it covers.
    """
    marks = labels.where(F.col(label).isNotNull()).groupBy(F.col(key).alias("_k")).agg((F.max(label) == 0).alias("poor"))
    known = statistics.where(~base_failed()).join(marks, F.col(key) == F.col("_k"))
    known = stage(known.select(F.col("_k"), "poor", *feature_columns()), "labelled")
    cuts = quantiles(known, bins)
    if not cuts:
        return []
    binned = known.select(
        F.when(F.col("poor"), 1).otherwise(0).alias("poor"), (F.pmod(F.xxhash64("_k"), F.lit(3)) == 0).alias("held"),
        *[bin_of(f, cuts[f]) for f in FEATURES])
    cells = stage(binned.groupBy(*binned.columns).agg(F.count(F.lit(1)).alias("n")), "cells")
    rules: list[Rule] = []
    while len(rules) < max_rules:
        covered = F.lit(False)
        for rule in rules:
            covered = covered | every(rule)
        left = cells.where(~covered)
        rule = pruned(left.where("held"), grow(left.where(~F.col("held")), cuts, max_literals, least_covered))
        if rule is None:
            break
        poor, good = coverage(left.where("held"), [rule])[0]
        if poor == 0 or poor < least_precision * (poor + good):
            break
        rules.append(rule)
    return centred(known, rules)


def centred(known: DataFrame, rules: list[Rule]) -> list[Rule]:
    """The same rules with every cut in the middle between the labelled values on its two sides."""
    literals = sorted({x for rule in rules for x in rule}, key=lambda x: (x.feature, x.bin, x.above))
    if not literals:
        return rules
    row = known.agg(*[made.alias(f"{name}{i}") for i, x in enumerate(literals) for name, made in (
        ("low", F.max(F.when(F.col(x.feature) <= x.cut, F.col(x.feature)))),
        ("high", F.min(F.when(F.col(x.feature) > x.cut, F.col(x.feature)))))]).first()
    moved = {x: replace(x, cut=(row[f"low{i}"] + row[f"high{i}"]) / 2) for i, x in enumerate(literals)
             if row[f"high{i}"] is not None}
    return [tuple(moved.get(x, x) for x in rule) for rule in rules]


def quantiles(known: DataFrame, bins: int) -> dict[str, list[float]]:
    """Up to ``bins`` - 1 different cut points of each feature over all labelled documents."""
    shares = [i / bins for i in range(1, bins)]
    row = known.agg(*[F.percentile_approx(f, shares, 10_000).alias(f) for f in FEATURES]).first()
    return {f: sorted(set(row[f])) for f in FEATURES} if row[0] is not None else {}


def bin_of(feature: str, cuts: list[float]) -> Column:
    """How many cut points lie below the feature."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut < F.col(feature))).alias(f"b_{feature}")


def grow(cells: DataFrame, cuts: dict[str, list[float]], max_literals: int, least_covered: int) -> Rule:
    rule: Rule = ()
    while len(rule) < max_literals:
        entries = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f"b_{f}").alias("b")) for f in FEATURES]))
        counts = (cells.where(every(rule)).select(entries.alias("e"), "poor", "n").groupBy("e.f", "e.b")
                  .agg(F.sum(F.col("n") * F.col("poor")).alias("p"), F.sum("n").alias("a")).collect())
        best = best_literal(counts, cuts, least_covered)
        if best is None:
            break
        rule += (best,)
    return rule


def best_literal(counts: list, cuts: dict[str, list[float]], least_covered: int) -> Literal | None:
    """The literal of the highest information gain; ties go to the first feature, then the lowest cut."""
    by: dict[str, dict[int, tuple[int, int]]] = {f: {} for f in FEATURES}
    for f, b, p, a in counts:
        by[f][b] = (p, a)
    poor, total = (sum(x[i] for x in by[next(iter(FEATURES))].values()) for i in (0, 1))
    if poor in (0, total):
        return None
    before, best, most = math.log2(poor / total), None, 0.0
    for f in FEATURES:
        p = a = 0
        for b, cut in enumerate(cuts[f]):
            p, a = p + by[f].get(b, (0, 0))[0], a + by[f].get(b, (0, 0))[1]
            for above, (cp, ca) in ((True, (poor - p, total - a)), (False, (p, a))):
                if cp >= least_covered and (gain := cp * (math.log2(cp / ca) - before)) > most + 1e-9:
                    best, most = Literal(f, above, b, cut), gain
    return best


def coverage(cells: DataFrame, rules: list[Rule]) -> list[tuple[int, int]]:
    """How many poor and good documents each rule covers."""
    sums = []
    for i, rule in enumerate(rules):
        sums += [F.coalesce(F.sum(F.when(every(rule) & (F.col("poor") == p), F.col("n"))), F.lit(0)).alias(f"c{i}_{p}") for p in (1, 0)]
    row = cells.agg(*sums).first()
    return [(row[f"c{i}_1"], row[f"c{i}_0"]) for i in range(len(rules))]


def pruned(held: DataFrame, rule: Rule) -> Rule | None:
    """The shortest beginning of the rule that is best on the held-out documents."""
    if not rule:
        return None
    beginnings = [rule[:i] for i in range(1, len(rule) + 1)]
    worth = [(p - g) / (p + g) if p + g else -1.0 for p, g in coverage(held, beginnings)]
    return beginnings[worth.index(max(worth))]


def judge(statistics: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``base_failed`` and ``kept``."""
    columns = statistics.columns
    tested = statistics.select("*", *feature_columns()).select(
        *columns, base_failed().alias("base_failed"), F.expr(decision_sql(rules)).alias("_verdict"))
    return tested.select(*columns, "base_failed", (~F.col("base_failed") & F.col("_verdict")).alias("kept"))


def quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, the base statistics, ``base_failed`` and ``kept`` of every row.

    A null text has no words and fails. Null keys and repeated rows are judged like others; other columns are left out.
    """
    statistics = stage(with_statistics(docs.select(F.col(key), F.col(text).alias("_x")), "_x", [key]), "statistics")
    return judge(statistics, learn(statistics, labels, key)).select(key, *BASE, "base_failed", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that ``quality`` keeps, with all their columns, whatever their names.

    Rows are written once beside their statistics, so these are computed once; rules are learned from the statistics alone.
    Without labelled rows no rule is learned, and only the base rules reject."""
    packed = docs.select(F.struct("*").alias("_row"), F.col(text).alias("_x"))
    measured = stage(with_statistics(packed, "_x", ["_row"]), "measured")
    statistics = measured.select(F.col(f"_row.`{key}`").alias(key), *[c for c in measured.columns if c != "_row"])
    return judge(measured, learn(statistics, labels, key)).where("kept").select("_row.*")
