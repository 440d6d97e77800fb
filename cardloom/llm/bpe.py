"""Byte-pair encoding of whole texts, and decoding by joining vocabulary strings.

A text is normalised and cut into pre-tokens; each is merged with a priority queue of merge ranks over a doubly
linked symbol list. Entries whose neighbours have changed since they were queued are skipped when popped. Pre-tokens
never influence one another, so a bounded memo of them does not change results.
No row is shuffled: the work is one pass over the scan, and a lost task is simply run again.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Regex, pre_tokenizers

from cardloom.llm.batches import Memo, arrow_fields, ddl, row_map

SCHEMA = pa.schema([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
SHIFT, AT = 20, 32  # bits of an id inside a pair, and of a position inside a queue entry
MEMO_CHARS = 64  # longer stretches hardly come back
NO_RANK = 1 << 32  # above every rank
# Lower-case pairs newer than Python's character tables, by the first, the last and what lies between them.
NEW_LOWER = {a: a + step for first, last, step in (
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1), (0xA7D4, 0xA7D4, 1),
    (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B)) for a in range(first, last + 1)}
NAMED = regex.compile(r"[\p{L}\p{N}]")
HAS_NEW = re.compile("[" + "".join(map(chr, NEW_LOWER)) + "]")
CONTROLS = "\x1c\x1d\x1e\x1f"
SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
FAST = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")  # the vocabulary's own cut, on lower-case ASCII
# The same on lower-case text without characters of UNUSUAL: Latin letters and signs, and the punctuation and currency set beside them.
LATIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ſ]+|[0-9²³¹¼-¾]|[^\t-\r \x85\xa0a-z0-9ªµºß-öø-ſ²³¹¼-¾]+")
UNUSUAL = re.compile("[^\x00-\u017f\u2010-\u2027€]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary: printable Latin-1 characters
    stand for themselves, all other bytes take the code points from 256 on, in order."""
    own = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class WordBpe:
    """A BPE model with word ends, read from a tokenizer file (normaliser: NFC, one space for white space, lower case)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.strings = {i: s for s, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings.update({i: s for s, i in self.special.items()})
        # A merge is found by both ids, packed into one integer, and has a rank; the rank gives the new id.
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[a] << SHIFT | vocab[b]] = rank
            self.made.append(vocab[a + b])
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + suffix] for s in symbols]
        cut = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(cut)
        # The regex package may know newer letters and numbers than the library. Python calls a character that is new to it
        # unprintable, which tells where this matters; of these, the library itself says which it does not know.
        new = "".join(chr(x) for x in range(0x110000) if unicodedata.category(chr(x)) == "Cn" and NAMED.match(chr(x)))
        strange = pre_tokenizers.Split(Regex(NAMED.pattern), "removed").pre_tokenize_str(new)
        points = sorted(ord(c) for part, _ in strange for c in part)
        ends = [i for i, x in enumerate(points) if points[i + 1:i + 2] != [x + 1]]
        codes = "".join(f"\\U{points[a]:08X}-\\U{points[b]:08X}" for a, b in zip([0, *[e + 1 for e in ends]], ends))
        self.old_words = regex.compile("(?V1)" + re.sub(r"\\p\{[LN]\}", lambda m: f"[{m[0]}--[{codes}]]", cut)) if codes else self.words
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.coded, self.chunked = Memo(self._coded, limit=400_000), Memo(self._chunk, limit=200_000)
        self.counted, self.sizes = Memo(self._count, limit=100_000, longest=MEMO_CHARS), Memo(self._size, limit=800_000, longest=MEMO_CHARS)

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token."""
        inner, rank_of, made = self.inner, self.ranks.get, self.made
        ids = [inner[b] for b in word]
        ids[-1] = self.last[word[-1]]
        n = len(ids)
        queue = []
        left = ids[0]
        for at in range(1, n):
            right = ids[at]
            rank = rank_of(left << SHIFT | right)
            if rank is not None:
                queue.append(rank << AT | at - 1)
            left = right
        if not queue:
            return ids
        heapify(queue)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while queue:
            entry = heappop(queue)
            rank, at = entry >> AT, entry & 0xFFFFFFFF
            right = after[at]
            if right >= n or ids[at] < 0 or rank_of(ids[at] << SHIFT | ids[right]) != rank:
                continue  # stale: one of the two symbols was merged meanwhile
            new = ids[at] = made[rank]
            ids[right] = -1
            far = after[at] = after[right]
            if far < n:
                before[far] = at
                rank = rank_of(new << SHIFT | ids[far])
                if rank is not None:
                    heappush(queue, rank << AT | at)
            near = before[at]
            if near >= 0:
                rank = rank_of(ids[near] << SHIFT | new)
                if rank is not None:
                    heappush(queue, rank << AT | near)
        return [i for i in ids if i >= 0]

    def pretokens(self, plain: str) -> list[str]:
        """Cut a normalised text without special tokens."""
        if plain.isascii():
            return FAST.findall(plain)
        return (self.words if plain.isprintable() else self.old_words).findall(plain)

    def _coded(self, word: str) -> tuple[str, str, int]:
        ids = self.merge(word.encode("utf-8"))
        return " ".join(map(str, ids)), " ".join([self.strings[i] for i in ids]), len(ids)

    def _chunk(self, chunk: str) -> tuple[str, str, int]:
        """All pre-tokens of a stretch without white space, joined."""
        words = self.pretokens(chunk)
        if len(words) == 1:
            return self.coded[words[0]]
        ids, strings, counts = zip(*[self.coded[word] for word in words])
        return " ".join(ids), " ".join(strings), sum(counts)

    def _size(self, text: str) -> int:
        """How many ids a pre-token has. In a short one the pair to merge next is sooner looked for than kept in a queue."""
        word = text.encode("utf-8")
        if len(word) > MEMO_CHARS:
            return len(self.merge(word))
        inner, rank_of, made = self.inner, self.ranks.get, self.made
        ids = [inner[b] for b in word]
        ids[-1] = self.last[word[-1]]
        ranks = [rank_of(left << SHIFT | right, NO_RANK) for left, right in zip(ids, ids[1:])]
        while ranks:
            rank = min(ranks)
            if rank == NO_RANK:
                break
            at = ranks.index(rank)
            new = made[rank]
            ids[at:at + 2] = (new,)
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of(ids[at - 1] << SHIFT | new, NO_RANK)
            if at < len(ranks):
                ranks[at] = rank_of(new << SHIFT | ids[at + 1], NO_RANK)
        return len(ids)

    def _count(self, chunk: str) -> int:
        """How many ids a stretch without white space has. Stretches differ by their punctuation more than by their words."""
        return sum(map(self.sizes.__getitem__, self.pretokens(chunk)))

    @staticmethod
    def chunks(plain: str) -> list[str]:
        """Cut at white space, which no pre-token holds. ``str.split`` also cuts at four control characters."""
        return plain.split() if not any(c in plain for c in CONTROLS) else [c for c in SPACE.split(plain) if c]

    def parts(self, text: str) -> list[tuple[int | None, str]]:
        """Special tokens with their ids, and the texts between them, normalised."""
        found = []
        for part in self.specials.split(text) if "<|" in text else (text,):
            special = self.special.get(part)
            # Lower-casing goes character by character: no final form of sigma.
            if special is None and part:
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                if not part.isascii() and HAS_NEW.search(part):
                    part = part.translate(NEW_LOWER)
            found.append((special, part))
        return found

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        for special, part in self.parts(text or ""):
            if special is not None:
                ids.append(special)
            else:
                for word in self.pretokens(part):
                    ids.extend(self.merge(word.encode("utf-8")))
        return ids

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.strings[i] for i in ids)

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, and the digests of the ids and of the decoded text."""
        memo, found = self.chunked, []
        for special, part in self.parts(text or ""):
            if special is not None:
                found.append((str(special), part, 1))
            else:
                found.extend([memo[chunk] for chunk in self.chunks(part)])
        ids, strings, counts = zip(*found) if found else ((), (), ())
        return (sum(counts), hashlib.sha256(" ".join(ids).encode()).hexdigest(),
                hashlib.sha256(" ".join(strings).encode()).hexdigest())

    def count(self, text: str | None) -> int:
        """Number of ids, none of which is kept. Usual texts are cut in one go, others by stretches; only short ones enter the memos."""
        n = 0
        for special, part in self.parts(text or ""):
            if special is not None:
                n += 1
            elif part.isascii() or not UNUSUAL.search(part):
                n += sum(map(self.sizes.__getitem__, (FAST if part.isascii() else LATIN).findall(part)))
            else:
                n += sum(map(self.counted.__getitem__, self.chunks(part)))
        return n


@lru_cache(maxsize=2)
def model(path: str) -> WordBpe:
    """One model for each worker process."""
    return WordBpe(path)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens``, ``ids`` (array of int) and ``decoded`` of every row.

    A null text counts as empty, which has no ids and decodes to the empty string. Repeated rows and null keys are
    kept, further columns are left out, an empty table gives an empty table. Special tokens inside a text become
    their ids.
    """
    def rows(batch: pa.RecordBatch):
        bpe = model(path)
        for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = bpe.encode(t.as_py())
            yield k, len(ids), ids, bpe.decode(ids)

    found = docs.select(key, text)
    schema = pa.schema([*arrow_fields(found, [key]), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
    return found.mapInArrow(row_map(rows, schema), f"{ddl(found, [key])}, n_tokens long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``encode``, with digests in the place of ids and decoded text: ``n_tokens``, ``ids_sha256`` (decimal ids
    joined by one space) and ``decoded_sha256`` (UTF-8)."""
    def rows(batch: pa.RecordBatch):
        bpe = model(path)
        for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
            yield (k, *bpe.digest(t.as_py()))

    found = docs.select(key, text)
    schema = pa.schema([*arrow_fields(found, [key]), *SCHEMA])
    return found.mapInArrow(row_map(rows, schema), f"{ddl(found, [key])}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``n_tokens`` of every row, as ``encode`` would count them; no ids are built up."""
    def rows(batch: pa.RecordBatch):
        bpe = model(path)
        for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
            yield k, bpe.count(t.as_py())

    found = docs.select(key, text)
    schema = pa.schema([*arrow_fields(found, [key]), ("n_tokens", pa.int64())])
    return found.mapInArrow(row_map(rows, schema), f"{ddl(found, [key])}, n_tokens long")
