"""Chat windows, nearest neighbours, packing and the pipeline against plain versions."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from cardloom.llm import chat, crosspolytope, packing, queries
from check import compare, connect


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- SQL ----------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    cursor = connect(sf).execute(queries.SQL[name])
    assert compare((df.columns, [tuple(r) for r in df.collect()]), ([c[0] for c in cursor.description], cursor.fetchall())) == ""


# --- chat ---------------------------------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, span string, pos long"


@pytest.fixture(scope="module")
def turns(spark):
    rows = [(1, 0, "system", "Be brief. <|im_end|> &lt;| &amp;", "x", 1)]
    for i in range(1, 60):
        rows.append((1, i, "user" if i % 2 else "assistant", f"turn {i} " + "word " * (i * 7 % 90), "x", 1))
    rows += [(2, 0, "user", None, None, None), (2, 1, "assistant", "", None, None), (2, 2, None, "no\nrole", None, None), (2, 3, "odd\nrole", "é<|", None, None)]
    rows += [(3, 5, "assistant", "long " * 3000, None, None), (3, 5, "assistant", "same turn", None, None), (3, 5, "assistant", "same turn", None, None)]
    rows += [(None, 0, "user", "hello", None, None), (None, None, "assistant", "first", None, None), (4, 0, "assistant", "only", None, None)]
    return spark.createDataFrame(rows, TURNS).repartition(4)


def test_what_is_read_back_equals_the_conversations(spark, turns):
    by = defaultdict(list)
    for r in turns.collect():
        by[r.conv_id].append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    wanted = {}
    for conv, rows in by.items():
        rows.sort()
        said = "".join(t for *_, role, t in rows if role == "assistant")
        wanted[conv] = (len(rows), sha("".join(f"{role}\n{t}\n" for *_, role, t in rows)), len(said), sha(said))
    for budget, history in ((512, 2), (64, 0), (40, 5)):
        got = chat.read_back(chat.windows(turns, budget, history)).collect()
        assert {r.conv_id: tuple(r)[1:5] for r in got} == wanted


def estimate(text):
    return (len(text.encode()) + 3) // 4 + 4


@pytest.mark.parametrize("source", ["odd", "table"])
@pytest.mark.parametrize("budget, history", [(512, 2), (256, 2), (90, 5), (24, 1), (4, 0)])
def test_all_windows_keep_the_budget_the_system_turn_and_each_turn_once(spark, sf, turns, source, budget, history):
    table = turns if source == "odd" else spark.read.parquet(f"{sf}/conversations.parquet")
    talks, seen = defaultdict(list), defaultdict(list)
    for r in table.collect():
        talks[r.conv_id].append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    talks = {c: [t[2:] for t in sorted(rows)] for c, rows in talks.items()}
    for r in chat.windows(table, budget, history).collect():
        talk, first = talks[r.conv_id], r["first"]
        new = list(range(first, first + r.n_new))
        seen[r.conv_id] += new
        system = talk[0][0] == "system" and len(talk) > 1
        lead = [1] if system and first > 1 else []
        past = list(range(first - r.n_repeated + len(lead), first))
        assert len(past) <= history and (not past or past[0] > len(lead))
        size = {at: estimate(talk[at - 1][1]) for at in lead + past + new}
        assert r.tokens == sum(size.values())
        body = [at for at in new if not (system and at == 1)]
        assert r.tokens <= budget or (len(body) == 1 and not past)
        if first > len(past) + 1 + len(lead) and len(past) < history:  # history stops only where the next turn would not fit
            assert r.tokens + estimate(talk[first - len(past) - 2][1]) > budget
        parts = r.formatted.split(chat.START)[1:]
        assert len(parts) == len(size)
        assert [r.formatted[x["start"]:x["start"] + x["length"]] for x in r.loss] == [
            talk[at - 1][1].replace("&", "&amp;").replace("<|", "&lt;|") for at in new if talk[at - 1][0] == "assistant"]
    assert {c: sorted(x) for c, x in seen.items()} == {c: list(range(1, len(t) + 1)) for c, t in talks.items()}


def test_a_table_that_already_holds_conversation_minus_one(spark, sf, tmp_path):
    rows = [(-1, 0, "system", "own"), (-1, 1, "user", "text"), (7, 0, "user", "hi")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r.n_turns for r in queries.QUERIES["op6_chat_windows"](spark, str(tmp_path)).collect()}
    assert got == {-1: 4, 7: 1}  # the added turns join it


# --- nearest neighbours -------------------------------------------------------------------------------------------

def plain_search(ids, vectors, asked, k):
    found = {}
    for q in asked:
        scores = (vectors * vectors[ids.index(q)]).sum(axis=1)
        order = sorted((-s, i) for s, i in zip(scores, ids) if i != q)[:k]
        found[q] = [(i, -s) for s, i in order]
    return found


def test_recall_against_brute_force(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    ids, vectors = [r[0] for r in rows], np.array([r[1] for r in rows], float)
    wanted = plain_search(ids, vectors, [i for i in ids if i % 20 == 0], 20)
    got = defaultdict(list)
    for r in queries.QUERIES["op9_cross_polytope_search"](spark, sf).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    assert set(got) == set(wanted) and all(len(x) == 20 for x in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in wanted[q]}) for q in wanted)
    assert hits >= 0.9 * 20 * len(wanted)
    exact = dict(zip(ids, vectors))
    assert all(abs(s - float((exact[q] * exact[i]).sum())) < 1e-12 for q, x in got.items() for i, s in x)


def test_probing_everything_is_exact_for_odd_vectors_ties_and_crowded_buckets(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6).round(1) * (1 + i % 4)]) for i in range(150)]
    rows += [(i, [1.0, 2.0, -1.0, 0.5, 0.0, 3.0]) for i in range(200, 320)]  # one vector, many times
    bad = [(500, None), (520, [0.0] * 6), (540, [1.0, None]), (560, [float("nan")] * 6), (580, [float("inf"), 1.0]), (None, [1.0] * 6), (600, [])]
    short = [(620, [5.0, 1.0])]
    table = spark.createDataFrame([(*r, "x", 3) for r in rows + bad + short], "vec_id long, embedding array<double>, axis string, id int").repartition(3)
    found = crosspolytope.search(table, F.col("id") % 20 == 0, k=20, tables=2, probes=16, block=16)
    ids = [r[0] for r in rows + short]
    vectors = np.array([v + [0.0] * (6 - len(v)) for _, v in rows + short])
    got = defaultdict(list)
    for r in found.orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, round(r.score, 9)))
    wanted = plain_search(ids, vectors, [i for i in ids if i % 20 == 0], 20)
    assert dict(got) == {q: [(i, round(float(s), 9)) for i, s in x] for q, x in wanted.items()}
    assert crosspolytope.search(table.where("false"), F.col("id") % 20 == 0).collect() == []


def searched(spark, rows, **options):
    table = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>").repartition(3)
    got = defaultdict(list)
    for r in crosspolytope.search(table, F.col("id") % 20 == 0, **options).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, round(r.score, 9)))
    return dict(got)


def best_by_key(rows, k=20):
    """Brute force; of repeated keys the largest score counts once."""
    wanted = {}
    for q in {i for i, _ in rows if i % 20 == 0}:
        scores = {}
        for own in (v for i, v in rows if i == q):
            for i, v in rows:
                if i != q:
                    scores[i] = max(scores.get(i, -np.inf), float((v * own).sum()))
        wanted[q] = [(i, round(s, 9)) for s, i in sorted((-s, i) for i, s in scores.items())[:k]]
        wanted[q] = [(i, -s) for i, s in wanted[q]]
    return wanted


@pytest.mark.parametrize("n", [15, 40])
def test_a_small_table_gives_all_its_nearest(spark, n):
    rows = list(enumerate(np.random.default_rng(n).normal(size=(n, 64))))
    assert searched(spark, rows) == best_by_key(rows)


@pytest.mark.parametrize("norms", ["one long", "lognormal"])
def test_recall_with_unequal_norms(spark, norms):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(600, 64))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    vectors *= np.where(np.arange(600) == 7, 50, 1)[:, None] if norms == "one long" else rng.lognormal(size=600)[:, None]
    rows = list(enumerate(vectors))
    got, wanted = searched(spark, rows), best_by_key(rows)
    assert set(got) == set(wanted) and all(len(x) == 20 for x in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in wanted[q]}) for q in wanted)
    assert hits >= (0.87 if norms == "one long" else 0.95) * 20 * len(wanted), hits / 20 / len(wanted)


@pytest.mark.parametrize("crowd", [2048, 16, 1])
def test_recall_when_axes_are_cut_further(spark, crowd):
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(2000, 20))
    rows = [(i, v / np.linalg.norm(v)) for i, v in enumerate(vectors)]
    got, wanted = searched(spark, rows, crowd=crowd), best_by_key(rows)
    assert all(len(x) == 20 for x in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in wanted[q]}) for q in wanted)
    assert hits >= 0.9 * 20 * len(wanted), hits / 20 / len(wanted)


def test_a_stored_vector_lies_in_the_first_bucket_of_its_own_order():
    vectors = np.random.default_rng(9).normal(size=(50, 12))
    for fine in (1, 2, 8, 64):
        rotations = crosspolytope.Rotations(12, 5, fine)
        assert rotations.buckets == 2 * rotations.width * rotations.fine
        codes = rotations.codes(vectors, np.linalg.norm(vectors, axis=1) * (1 + 1e-12), 5)
        for at, tab, order in rotations.orders(vectors, 5):
            assert sorted(order[0]) == list(range(rotations.buckets))
            assert (order[:, 0] == codes[at:at + len(order), tab]).all()


def test_a_larger_table_needs_a_smaller_share_of_its_pairs():
    rng, shares = np.random.default_rng(10), []
    for n in (500, 16_000):
        vectors = rng.normal(size=(n, 32))
        vectors /= np.linalg.norm(vectors, axis=1)[:, None]
        rotations = crosspolytope.Rotations(32, 16)
        codes = rotations.codes(vectors, np.full(n, 1 + 1e-12), 16)
        near = {q: np.argsort(-(vectors @ vectors[q]), kind="stable")[1:21] for q in range(0, 320, 10)}
        tables, probes = crosspolytope.fitted({q: (vectors[q], codes[i]) for q, i in near.items()}, rotations, 16, 0.96, n, n // 20)
        shares.append(tables * probes / rotations.buckets)
    assert shares[1] < shares[0], shares


def test_queries_that_find_too_little_meet_all_vectors(spark):
    rows = list(enumerate(np.random.default_rng(4).normal(size=(300, 64))))
    rows = [(i, v / np.linalg.norm(v)) for i, v in rows]
    assert all(len(x) == 200 for x in searched(spark, rows, k=200, tables=1, probes=1).values())


def test_a_key_repeated_many_times_takes_one_place(spark):
    rng = np.random.default_rng(6)
    centre = rng.normal(size=16)
    rows = [(i, centre + 0.1 * rng.normal(size=16)) for i in range(1, 61)]
    rows += [(0, centre * 1.5)] * 100 + [(500, centre * (1 + j / 100)) for j in range(100)] + [(501, centre)] * 100
    rows = [(i, v / 10) for i, v in rows]
    assert searched(spark, rows) == best_by_key(rows)


# --- packing ------------------------------------------------------------------------------------------------------

def check_packing(rows, lengths, capacities):
    """Every token placed once, no bin over its size, every bin of the smallest size that holds it."""
    by_doc, by_bin = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.start, r.n_tokens))
        by_bin[r.bin_id].append((r.bin_offset, r.n_tokens, r.capacity))
    assert Counter({d: sum(n for _, n in p) for d, p in by_doc.items()}) == Counter(lengths)
    for found in by_bin.values():
        at = 0
        for offset, n, _ in sorted(found):
            assert offset == at
            at += n
        assert {c for *_, c in found} == {min(c for c in capacities if c >= at)}


def test_packing_places_every_token_once(spark, hard, hard_rows):
    lengths = Counter()
    for r in hard_rows:
        lengths[r[0]] += len((r[1] or "").encode().split()) + 1
    check_packing(packing.pack(hard).collect(), lengths, packing.CAPACITIES)


def test_packing_fills_bins_and_mixes_sizes(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "cast(pmod(xxhash64(id), 700) + 1 AS long) AS n")
    lengths = {r.doc_id: r.n for r in docs.collect()}
    rows = packing.pack(docs, F.col("n"), (512, 1024, 2048)).collect()
    check_packing(rows, lengths, (512, 1024, 2048))
    bins = {r.bin_id: r.capacity for r in rows}
    assert sum(lengths.values()) >= 0.97 * sum(bins.values())
    cost = sum(packing.step_cost(c) for c in bins.values())
    histogram = Counter(lengths.values())
    assert all(cost <= packing.best_fit(histogram, (c,), (512, 1024, 2048), packing.step_cost).cost for c in (1024, 2048))
    assert packing.pack(docs.where("false"), F.col("n")).collect() == []
    assert packing.pack(docs.limit(5), F.lit(None).cast("long")).collect() == []


def test_no_bin_of_the_query_or_the_pipeline_holds_more_tokens_than_its_size(spark, sf, hard, tmp_path):
    path = queries.public_tokenizers.path("word_bpe_49k.json")
    reader = tokenizers.Tokenizer.from_file(path)
    blankless = [(700, "光" * 3000 + "x7Qz" * 2000, *[None] * 8)]
    docs = hard.unionByName(spark.createDataFrame(blankless, hard.schema))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    lengths = Counter()
    for r in docs.collect():
        lengths[r.doc_id] += len(reader.encode(r.text or "", add_special_tokens=False).ids) + 1
    assert lengths[700] > 2 * max(packing.CAPACITIES)
    check_packing(queries.QUERIES["op10_best_fit_packing"](spark, str(tmp_path)).collect(), lengths, packing.CAPACITIES)
    check_packing(corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect(), lengths, packing.CAPACITIES)


# --- pipeline -----------------------------------------------------------------------------------------------------

def test_each_stage_works_on_what_its_predecessor_kept(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.collect()}
    for name, step in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(step(spark, docs, sf), "test")
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= before and len(now) >= 0.6 * len(before), name
        before = now
        assert docs.columns == columns or name == corpus_pipeline.STAGES[-1][0]
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf).collect()} == before
    good = {r.doc_id for r in queries.QUERIES["op7_quality_rules"](spark, sf).where("kept").collect()}
    assert before <= good


def test_the_pipeline_takes_odd_rows_and_empty_tables(spark, sf, hard, nothing):
    for docs in (hard.drop("version").withColumn("extra", F.lit(1)), nothing):
        for _, step in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stage(step(spark, docs, sf), "odd")
    assert docs.count() == 0
