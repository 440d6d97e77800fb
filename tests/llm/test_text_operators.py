"""Each operator against a plain version of itself, on the small tables and on rows with every oddity."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cardloom.llm import bpe, importance, langid, linededup, recount, rules, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANK = " \t\n\x0b\f\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def same(got, wanted):
    assert Counter(map(tuple, got)) == Counter(map(tuple, wanted))


@pytest.fixture(params=["small table", "hard rows"])
def docs(request, documents, hard):
    return documents if request.param == "small table" else hard


# --- byte-pair encoding -------------------------------------------------------------------------------------------

def test_encoding_and_decoding_equal_the_library(docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    wanted, plain = [], []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        wanted.append((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(text)))
        plain.append((r.doc_id, len(ids), tuple(ids), text))
    same(bpe.encode_digests(docs, path).collect(), wanted)
    same([(k, n, tuple(ids), t) for k, n, ids, t in bpe.encode(docs, path).collect()], plain)


def test_every_code_point_is_encoded_as_by_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, model = Tokenizer.from_file(path), bpe.model(path)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for low in range(0, len(points), 50_000):
        texts = [f"a{c}b {c}{c}1{c}" for c in points[low:low + 50_000]]
        for c, text, made in zip(points[low:], texts, library.encode_batch(texts, add_special_tokens=False)):
            assert model.encode(text) == made.ids, hex(ord(c))


def test_a_memo_that_overflows_changes_nothing():
    model = bpe.WordBpe(public_tokenizers.path("word_bpe_49k.json"))
    text = " ".join(f"word{i % 37}'s ÉTÉ{i % 11} x\x1cy" for i in range(400))
    text += " " + "q" * 200 + " " + "é!" * 90
    free = model.digest(text)
    memos = (model.coded, model.chunked, model.counted, model.sizes)
    assert model.count(text) == free[0] == len(model.encode(text))
    for memo in memos:
        memo.limit = 3
        memo.clear()
    assert model.digest(text) == free and model.count(text) == free[0]
    assert all(len(memo) <= 3 for memo in memos)


def test_usual_texts_are_counted_without_a_memo_of_stretches():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, model = Tokenizer.from_file(path), bpe.WordBpe(path)
    usual = [chr(x) for x in [*range(0x180), *range(0x2010, 0x2028), 0x20AC] if x != 0x130]  # its lower case has a mark
    for c in [*usual, "\u2028", "\u0391", "\u0307", "\u2074", "\U0001F600"]:
        text = f"Über {c}ab{c}'s 1{c}2 {c}{c} l'{c} .{c}! {'mañana' * 20}"
        assert model.count(text) == len(library.encode(text, add_special_tokens=False).ids), hex(ord(c))
        assert c not in usual or not model.counted
    assert max(map(len, [*model.sizes, *model.counted])) <= bpe.MEMO_CHARS


# --- importance resampling ----------------------------------------------------------------------------------------

def test_weights_are_log_ratios_of_ngram_counts(spark, docs):
    marks = spark.createDataFrame([(i, i % 3 and 1, 0) for i in range(0, 60)] + [(None, 1, 0), (2, None, None)], "doc_id long, quality int, toxic int")
    rows, good = docs.collect(), {i for i in range(60) if i % 3}

    def grams(text):
        words = (text or "").encode().lower().split()
        h = [xxhash.xxh32_intdigest(w) for w in words]
        pairs = [((a * 0x9E3779B97F4A7C15 + b) * 0xC2B2AE3D27D4EB4F % 2 ** 64 >> 32) % importance.BUCKETS for a, b in zip(h, h[1:])]
        return [x % importance.BUCKETS for x in h] + pairs
    raw, target = np.zeros(importance.BUCKETS), np.zeros(importance.BUCKETS)
    for r in rows:
        np.add.at(raw, grams(r.text), 1)
        if r.doc_id in good:
            np.add.at(target, grams(r.text), 1)
    ratios = importance.log_ratios(np.array([raw, target]))
    got = importance.resample(docs, marks, share=0.5).collect()
    same([(r.doc_id, r.n_grams, round(r.log_weight, 6)) for r in got],
         [(r.doc_id, len(g := grams(r.text)), round(float(ratios[g].sum()) if g else 0.0, 6)) for r in rows])
    assert sorted(r["rank"] for r in got) == list(range(len(rows)))
    assert sum(r.kept for r in got) == round(0.5 * len(rows))
    keys = [r.gumbel_key for r in sorted(got, key=lambda r: r["rank"])]
    assert keys == sorted(keys, reverse=True)


# --- language identification --------------------------------------------------------------------------------------

def test_language_of_held_out_documents(documents):
    truth = {r.doc_id: r.lang for r in documents.collect()}
    got = langid.predictions(documents).collect()
    assert {r.doc_id for r in got} == set(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_language_of_odd_rows(hard, hard_rows):
    got = langid.predictions(hard).collect()
    assert len(got) == len(hard_rows)
    empty = {r[0] for r in hard_rows if not any(c.isalpha() for c in r[1] or "")}
    assert all((r.lang_pred == "und") == (r.doc_id in empty) or r.doc_id is None for r in got)
    kept = langid.keep_identified(hard, least_score=0.0)
    assert kept.columns == hard.columns and kept.count() == len([r for r in hard_rows if any(c.isalpha() for c in r[1] or "")])


def test_without_any_label_the_texts_with_letters_stay(hard, hard_rows):
    kept = langid.keep_identified(hard.withColumn("lang", F.lit(None).cast("string")))
    assert Counter(r.text for r in kept.collect()) == Counter(r[1] for r in hard_rows if any(map(str.isalpha, r[1] or "")))


def test_blocks_of_a_long_text_give_the_same_ngrams(monkeypatch):
    text = "Straße und ÉCOLE, " * 50
    whole = langid.term_counts(text)
    monkeypatch.setattr(langid, "BLOCK", 7)
    assert (langid.term_counts(text) == whole).all()


# --- line dedup ---------------------------------------------------------------------------------------------------

def test_line_dedup_equals_a_plain_version(docs):
    rows = docs.collect()

    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANK))
    holders = defaultdict(set)
    for r in rows:
        for line in (r.text or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(-1 if r.doc_id is None else r.doc_id)
    keeper = {k: max(h) for k, h in holders.items() if len(h) >= 5}
    wanted = []
    for r in rows:
        lines = (r.text or "").split("\n")
        kept = [x for x in lines if keeper.get(key(x), r.doc_id) == r.doc_id]
        wanted.append((r.doc_id, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    same(linededup.digests(docs).collect(), wanted)


# --- edited token counts ------------------------------------------------------------------------------------------

def test_counts_after_edits_equal_counts_of_the_edited_text(docs):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoding = recount.Counter(path, public_tokenizers.PATTERN).encoding
    wanted = []
    for r in docs.collect():
        text = r.text or ""
        after, edits = re.subn(r"[0-9]+|the ", "<gone>", text)
        wanted.append((r.doc_id, len(encoding.encode_ordinary(text)), edits, len(encoding.encode_ordinary(after))))
    got = recount.recount(docs, path, public_tokenizers.PATTERN, secrets="[0-9]+|the ", new="<gone>").collect()
    same([(r.doc_id, r.n_tokens, r.n_edits, r.n_tokens_after) for r in got], wanted)


EDITED = [*"0123456789abcdef", " ", " ", "  ", "\n", "'s", "'", "é", "abcdef0123456789", "10.0.0.1", " word", "\"", "...", "\n\n ", "0123456789abcdef" * 3]


@pytest.mark.parametrize("leaf, n", [(64, 1200), (2, 3000)])
def test_counts_hold_under_edits_in_any_order(monkeypatch, leaf, n):
    monkeypatch.setattr(recount, "LEAF", leaf)
    using = recount.Counter(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rng, secrets = random.Random(leaf), re.compile(recount.SECRETS)

    def whole(tree, text):
        assert tree.text() == text and tree.chars[1] == len(text)
        assert tree.total == len(using.encoding.encode_ordinary(text))

    for i in range(n):
        text = "".join(rng.choice(EDITED) for _ in range(rng.randrange(0, 40 * leaf if leaf > 2 else 60)))
        tree = recount.TokenTree(text, using)
        if i % 2:  # from the end, as the query edits
            for m in reversed(list(secrets.finditer(text))):
                tree.edit(m.start(), m.end(), "[removed]")
            text = secrets.sub("[removed]", text)
        for _ in range(rng.randrange(6) if i % 2 == 0 else 0):
            start = rng.randrange(len(text) + 1)
            end = rng.choice([start, min(start + rng.randrange(30), len(text)), len(text)])
            new = "".join(rng.choice(EDITED) for _ in range(rng.choice([0, 0, 1, 5, 6 * leaf])))
            tree.edit(start, end, new)
            text = text[:start] + new + text[end:]
        whole(tree, text)


def test_stored_trees_follow_batches_of_edits(spark, hard_rows):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoding = recount.Counter(path, pattern).encoding
    texts = {r[0]: r[1] or "" for r in hard_rows if r[0] is not None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    trees = recount.build(docs, path, pattern)
    assert {r.doc_id: ("".join(r.texts), r.n_tokens) for r in trees.collect()} == {k: (t, len(encoding.encode_ordinary(t))) for k, t in texts.items()}
    batches = [[(0, 1, 5, 9, " new words"), (0, 2, 0, 3, None), (18, 1, 100_000, 100_020, "x"), (999, 1, 0, 0, "no document"), (13, 1, 50, 60, "\n12 34")],
               [(18, 1, 3, 3, "'s "), (12, 1, 0, 10 ** 9, ""), (0, 1, 1, 1, "word " * 500)]]
    for batch in batches:
        edits = spark.createDataFrame([(*e, "x") for e in batch], "doc_id long, seq int, start long, end long, new string, texts string")
        for k, _, start, end, new in sorted(batch):
            if k in texts:
                start = min(start, len(texts[k]))
                texts[k] = texts[k][:start] + (new or "") + texts[k][max(end, start):]
        trees = recount.apply(trees, edits, path, pattern)
        got = {r.doc_id: r for r in trees.collect()}
        assert set(got) == {e[0] for e in batch if e[0] in texts}
        for k, r in got.items():
            assert ("".join(r.texts), r.n_tokens) == (texts[k], len(encoding.encode_ordinary(texts[k])))
        if 18 in got:
            assert got[18].n_reencoded < 20 * recount.LEAF < got[18].n_tokens / 10
        trees = recount.build(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), path, pattern) if batch is batches[0] else trees


def test_an_edit_cuts_only_its_neighbourhood():
    using = recount.Counter(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    text = "It's  a tall story,   isn't it?\n" * 2000
    tree = recount.TokenTree(text, using)
    for at in (0, 5, 31_999, len(text) - 1, 7_777):
        tree.edit(at, at + 1, " 're ")
        text = text[:at] + " 're " + text[at + 1:]
    assert tree.text() == text and tree.total == len(using.encoding.encode_ordinary(text))
    assert tree.reencoded < 5 * 4 * recount.LEAF


# --- quality rules ------------------------------------------------------------------------------------------------

def test_statistics_equal_a_plain_version(docs, labels):
    wanted = []
    for r in docs.collect():
        text = r.text or ""
        words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
        triples = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        often = Counter(triples)
        repeated = len({i + j for i, t in enumerate(triples) if often[t] > 1 for j in range(3)})
        wanted.append((r.doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
                       repeated, len(words) < 50 or 100 * repeated > 50 * len(words)))
    got = rules.quality(docs, labels).collect()
    same([tuple(r)[:7] for r in got], wanted)
    assert not any(r.kept and r.base_failed for r in got)


def test_rules_find_planted_junk_and_leave_the_rest(spark):
    rows = [(i, " ".join(f"word{(i * 7 + j) % 97}{'***' if i % 4 == 0 and j % 3 == 0 else ''}" for j in range(60 + i % 40))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(0, 400, 2)], "doc_id long, quality int")
    assert all(r.kept == (not r.base_failed and r.doc_id % 4 != 0) for r in rules.quality(docs, marks).collect())
    assert all(r.kept != r.base_failed for r in rules.quality(docs, marks.where("quality = 1")).collect())


def test_keep_good_returns_whole_rows(hard, labels):
    kept = rules.keep_good(hard, labels)
    good = Counter(r.doc_id for r in rules.quality(hard, labels).collect() if r.kept)
    assert kept.columns == hard.columns and Counter(r.doc_id for r in kept.collect()) == good


# --- SimHash ------------------------------------------------------------------------------------------------------

def plain_fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance=2):
    left, found = set(prints), {}
    while left:
        group, queue = set(), [left.pop()]
        while queue:
            x = queue.pop()
            group.add(x)
            near = {y for y in left if (x ^ y).bit_count() <= distance}
            left -= near
            queue += near
        found.update(dict.fromkeys(group, min(group)))
    return found


def test_components_equal_a_plain_version(docs):
    rows = docs.collect()
    prints = [plain_fingerprint(r.text) for r in rows]
    root = plain_components(prints)
    least = {}
    for r, p in zip(rows, prints):
        if r.doc_id is not None:
            least[root[p]] = min(r.doc_id, least.get(root[p], r.doc_id))
    same(simhash.near_duplicates(docs).collect(), [(r.doc_id, f"{p:016x}", least.get(root[p])) for r, p in zip(rows, prints)])


@pytest.mark.parametrize("crowd", [2, 64])
@pytest.mark.parametrize("distance", [1, 2])
def test_links_keep_every_component(spark, crowd, distance):
    rng = np.random.default_rng(3)
    prints = {int(x) for x in rng.integers(0, 2 ** 63, 50)}
    for x in list(prints)[:8]:  # families of near copies, a chain, and the extremes
        prints |= {x ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 63, (40, 2))}
    chain = [0]
    for i in range(0, 60, 2):
        chain.append(chain[-1] | 3 << i)
    prints |= {*chain, 2 ** 63 - 1}
    fps = spark.createDataFrame([(x,) for x in prints], "fp long")
    found = simhash.components(simhash.links(fps, distance, crowd=crowd)).collect()
    root = plain_components(prints, distance)
    assert {r.node: r.root for r in found} == {x: r for x, r in root.items() if x != r}


def test_sketches_of_any_size_keep_the_same_rows(spark):
    rows = [(i, f"a{i % 900} text that some rows share {i % 7}", "x") for i in [*range(2900), *range(100)]]
    table = spark.createDataFrame(rows, "doc_id long, text string, fate string").repartition(4)
    kept = simhash.keep_one(table, largest=1024).collect()
    same(kept, simhash.keep_one(table).collect())
    fingers = {r.doc_id: r.component_id for r in simhash.near_duplicates(table).collect()}
    assert len({r.doc_id for r in kept}) == len(kept) == len(set(fingers.values()))


def test_one_row_of_each_group_stays(hard):
    kept = simhash.keep_one(hard)
    rows, named = kept.collect(), simhash.near_duplicates(hard).collect()
    assert kept.columns == hard.columns
    print_of = {(r.doc_id, r.component_id) for r in named}
    assert len(rows) == len({plain_components([plain_fingerprint(x.text) for x in hard.collect()])[plain_fingerprint(r.text)] for r in rows})
    assert all((r.doc_id, r.doc_id) in print_of or r.doc_id is None for r in rows)


# --- empty tables -------------------------------------------------------------------------------------------------

def test_empty_tables_give_empty_tables(nothing, labels):
    path = public_tokenizers.path
    for made in (bpe.encode_digests(nothing, path("word_bpe_49k.json")), bpe.encode(nothing, path("word_bpe_49k.json")),
                 importance.resample(nothing, labels), langid.predictions(nothing), linededup.digests(nothing),
                 recount.recount(nothing, path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN), rules.quality(nothing, labels),
                 rules.quality(nothing, labels.where("false")), simhash.near_duplicates(nothing), simhash.keep_one(nothing)):
        assert made.collect() == []
