"""Token counts that follow edits.

A document's pre-tokens are cut into leaves of a segment tree whose nodes hold characters and tokens. An edit finds its
leaf by characters, cuts only the touched leaves anew, with a little context on both sides, and updates the sums above them.

Context: the vocabulary's pattern looks at most two characters past a pre-token's end and never back. So cutting may start
at any old boundary two characters before the edit, and may stop at the first new boundary behind it that is also an old
one: what follows is the same text, cut from the same place.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F

from cardloom.llm.batches import Memo, arrow_fields, ddl, row_map

LEAF, LOOK = 64, 2  # pre-tokens of a leaf; characters a pattern may look past a pre-token
# Long numbers and keys, and network addresses.
SECRETS = r"[0-9][0-9a-f]{11,}|[0-9]{1,3}(?:\.[0-9]{1,3}){3}"


class Counter:
    """Pre-tokens of a text, and their token counts, under a rank file and its pattern."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("counter", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.cut = regex.compile(pattern).findall
        self.counts = Memo(lambda piece: len(self.encoding.encode_ordinary(piece)), limit=400_000)

    def count(self, pieces: Iterable[str]) -> int:
        counts = self.counts
        return sum([counts[p] for p in pieces])


@lru_cache(maxsize=2)
def counter(path: str, pattern: str) -> Counter:
    return Counter(path, pattern)


class TokenTree:
    """Segment tree over the leaves of one text: node 1 is the root, leaves start at ``base``, and there are ``base`` of them.

    Edits may leave leaves empty or long. Pieces cut anew are dealt out over the leaves they came from; where these would
    hold more than twice ``LEAF`` pre-tokens, the leaves are laid out again, without counting the untouched ones again.
    """

    def __init__(self, text: str | None, using: Counter) -> None:
        self.using, self.reencoded, self.n_pretokens = using, 0, 0
        if text is not None:
            pieces = using.cut(text)
            self.n_pretokens = len(pieces)
            self._lay_out(self._leaves(pieces))

    @classmethod
    def stored(cls, texts: list[str], chars: list[int], tokens: list[int], using: Counter) -> TokenTree:
        """A tree as ``build`` wrote it; nothing is cut or counted."""
        tree = cls(None, using)
        tree.texts, tree.chars, tree.tokens, tree.base = list(texts), list(chars), list(tokens), len(texts)
        return tree

    def _leaves(self, pieces: list[str]) -> list[tuple[str, int]]:
        return [("".join(part), self.using.count(part)) for part in (pieces[i:i + LEAF] for i in range(0, len(pieces), LEAF))]

    def _lay_out(self, leaves: list[tuple[str, int]]) -> None:
        self.base = 1 << max(len(leaves) - 1, 0).bit_length()
        spare = self.base - len(leaves)
        self.texts = [t for t, _ in leaves] + [""] * spare
        self.chars = [0] * self.base + [len(t) for t in self.texts]
        self.tokens = [0] * self.base + [n for _, n in leaves] + [0] * spare
        for node in range(self.base - 1, 0, -1):
            self._sum(node)

    @property
    def total(self) -> int:
        return self.tokens[1]

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at``, or the last with characters, and its first character."""
        node, start = 1, 0
        at = min(at, max(self.chars[1] - 1, 0))
        while node < self.base:
            node *= 2
            if at - start >= self.chars[node]:
                start += self.chars[node]
                node += 1
        return node - self.base, start

    def _ahead(self, leaf: int) -> str:
        """Text after a leaf, longer than any look ahead unless the document ends: empty leaves do not count."""
        found = ""
        for text in self.texts[leaf + 1:]:
            found += text
            if len(found) > LOOK:
                break
        return found

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace characters ``start`` to ``end``."""
        first, begins = self.find(max(start - LOOK, 0))
        last, _ = self.find(end)
        old = "".join(self.texts[first:last + 1])
        region = old[:start - begins] + new + old[end - begins:]
        while True:
            pieces, length = [], 0
            for piece in self.using.cut(region + self._ahead(last)):
                if length >= len(region):
                    break
                pieces.append(piece)
                length += len(piece)
            if length == len(region):
                break
            last += 1  # no boundary where the next leaf starts: that leaf is cut anew, too
            region += self.texts[last]
        self.reencoded += len(pieces)
        self._place(first, last, pieces)

    def _place(self, first: int, last: int, pieces: list[str]) -> None:
        size = -(-len(pieces) // (last - first + 1))
        if size > 2 * LEAF:
            kept = [(t, self.tokens[self.base + i]) for i, t in enumerate(self.texts)]
            self._lay_out([x for x in kept[:first] + self._leaves(pieces) + kept[last + 1:] if x[0]])
            return
        for i, leaf in enumerate(range(first, last + 1)):
            part = pieces[i * size:(i + 1) * size]
            self.texts[leaf] = "".join(part)
            self.chars[self.base + leaf], self.tokens[self.base + leaf] = len(self.texts[leaf]), self.using.count(part)
        low, high = (self.base + first) // 2, (self.base + last) // 2
        while low:
            for node in range(low, high + 1):
                self._sum(node)
            low, high = low // 2, high // 2

    def text(self) -> str:
        return "".join(self.texts)


TREE = ["texts", "chars", "tokens"]
TREE_TYPES = {"texts": pa.list_(pa.string()), "chars": pa.list_(pa.int64()), "tokens": pa.list_(pa.int64()), "n_tokens": pa.int64()}
TREE_DDL = "texts array<string>, chars array<long>, tokens array<long>, n_tokens long"


def build(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the tree of every row, to be stored: ``texts`` of the leaves, ``chars`` and ``tokens`` of the nodes, and
    ``n_tokens``. A null text counts as empty; null keys and repeated rows are kept, other columns are left out."""
    found = docs.select(key, text)
    schema = pa.schema([*arrow_fields(found, [key]), *TREE_TYPES.items()])

    def rows(batch: pa.RecordBatch):
        using = counter(path, pattern)
        for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
            tree = TokenTree(t.as_py() or "", using)
            yield k, tree.texts, tree.chars, tree.tokens, tree.total

    return found.mapInArrow(row_map(rows, schema), f"{ddl(found, [key])}, {TREE_DDL}")


def apply(trees: DataFrame, edits: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """The trees of the edited documents after their edits, and ``n_reencoded``, the pre-tokens cut anew for them.

    ``edits`` has ``key``, ``seq``, ``start``, ``end`` (characters) and ``new``. Edits of a document follow one another in
    the order of ``seq``, ties in that of the other columns; each sees the text that the one before left. Places beyond the
    end mean the end, a null ``new`` deletes. Documents without edits, and edits without a document, are left out: only
    edited trees are read by the join's other side and only their touched regions are cut."""
    edit = F.struct("seq", F.greatest("start", F.lit(0)).cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.coalesce("new", F.lit("")).alias("new"))
    listed = edits.groupBy(key).agg(F.sort_array(F.collect_list(edit)).alias("_edits"))
    met = trees.select(key, *TREE).join(listed, key)
    schema = pa.schema([*arrow_fields(met, [key]), *TREE_TYPES.items(), ("n_reencoded", pa.int64())])

    def rows(batch: pa.RecordBatch):
        using = counter(path, pattern)
        for k, texts, chars, tokens, todo in zip(*[batch.column(c) for c in (key, *TREE, "_edits")]):
            tree = TokenTree.stored(texts.as_py(), chars.as_py(), tokens.as_py(), using)
            for e in todo.as_py():
                start = min(e["start"], tree.chars[1])
                tree.edit(start, min(max(e["end"], start), tree.chars[1]), e["new"])
            yield k.as_py(), tree.texts, tree.chars, tree.tokens, tree.total, tree.reencoded

    return met.mapInArrow(row_map(rows, schema), f"{ddl(met, [key])}, {TREE_DDL}, n_reencoded long")


def redactions(text: str, pattern: regex.Pattern, new: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), new) for m in pattern.finditer(text)]


def recount(docs: DataFrame, path: str, pattern: str, secrets: str = SECRETS, new: str = "[removed]",
            key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_pretokens``, ``n_tokens``, ``n_edits``, ``n_reencoded`` and ``n_tokens_after`` of every row, where
    each match of ``secrets`` is edited to ``new``.

    ``n_reencoded`` counts the pre-tokens cut anew. A null text counts as empty. Null keys and repeated rows are kept,
    other columns are left out; nothing depends on the order of rows, so there are no ties. A very long text has a deeper
    tree. One pass over the scan; ``build`` and ``apply`` keep trees for later edits.
    """
    found = docs.select(key, text)
    names = ("n_pretokens", "n_tokens", "n_edits", "n_reencoded", "n_tokens_after")
    schema = pa.schema([*arrow_fields(found, [key]), *[(n, pa.int64()) for n in names]])

    def rows(batch: pa.RecordBatch):
        using, wanted = counter(path, pattern), regex.compile(secrets)
        for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
            whole = t.as_py() or ""
            tree, edits = TokenTree(whole, using), redactions(whole, wanted, new)
            before = tree.total
            for edit in reversed(edits):  # from the end, so that earlier places stay valid
                tree.edit(*edit)
            yield k, tree.n_pretokens, before, len(edits), tree.reencoded, tree.total

    return found.mapInArrow(row_map(rows, schema), f"{ddl(found, [key])}, " + ", ".join(f"{n} long" for n in names))
