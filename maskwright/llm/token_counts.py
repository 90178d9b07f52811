"""Token counts that follow edits.

A document's text is cut into pre-tokens by the tokenizer's pattern, and a segment tree over them
holds characters and tokens of every range: ``LEAF`` pre-tokens to a leaf, sums above. An edit
replaces a span of characters. The tree leads to the leaf where the edit begins; pre-tokens are cut
anew from the last one that cannot have seen the edit (the pattern looks at most two characters past
a match) until a new boundary falls on an old one, shifted. From there on the old pre-tokens hold,
since a match depends on nothing before it. Only the new pre-tokens are encoded, and sums are
updated on the way up from the leaves that changed.

A tree can be kept (``trees``) and edited later (``apply_edits``); both work on a document in one
task, without a shuffle if trees and edits stand in one row.

Defined results: a null text is empty and has no tokens. Edits of a document are given in characters
of the text as it was, must not overlap, and are applied from the last to the first, so places hold;
null edits are none. Rows that repeat an id are counted each. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.llm.common import small_batches

LEAF = 32
LOOKAHEAD = 2
BATCH_BYTES = 4 << 20
KEPT = 300_000

COUNTS = (
    "doc_id long, n_tokens long, n_pretokens long, n_edits long, n_tokens_edited long, "
    "n_reencoded long"
)

Edit = tuple[int, int, str]


class Counter(dict):
    """Tokens of pre-tokens, each encoded once."""

    def __init__(self, ranks_path: str, pattern: str) -> None:
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)

    def __missing__(self, piece: str) -> int:
        if len(self) > KEPT:
            self.clear()
        n = self[piece] = len(self.encoding.encode_ordinary(piece))
        return n


class Tree:
    """Segment tree over the pre-tokens of a text."""

    def __init__(self, text: str, counter: Counter, pieces: list[str] | None = None) -> None:
        self.text, self.counter = text, counter
        pieces = counter.pattern.findall(text) if pieces is None else pieces
        sizes = list(map(len, pieces))
        tokens = list(map(counter.__getitem__, pieces))
        self._build(sizes, tokens)

    def _build(self, sizes: list[int], tokens: list[int]) -> None:
        self.leaves = [
            (sizes[i : i + LEAF], tokens[i : i + LEAF]) for i in range(0, max(1, len(sizes)), LEAF)
        ]
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.chars = [0] * (2 * self.width)
        self.sums = [0] * (2 * self.width)
        for i, (s, t) in enumerate(self.leaves):
            self.chars[self.width + i], self.sums[self.width + i] = sum(s), sum(t)
        for i in range(self.width - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.sums[i] = self.sums[2 * i] + self.sums[2 * i + 1]

    @property
    def tokens(self) -> int:
        return self.sums[1]

    @property
    def pretokens(self) -> int:
        return sum(len(s) for s, _ in self.leaves)

    def _set(self, leaf: int, sizes: list[int], tokens: list[int]) -> None:
        self.leaves[leaf] = sizes, tokens
        i = self.width + leaf
        chars, sums = sum(sizes) - self.chars[i], sum(tokens) - self.sums[i]
        while i:
            self.chars[i] += chars
            self.sums[i] += sums
            i //= 2

    def _find(self, place: int) -> tuple[int, int, int]:
        """Leaf and pre-token that hold a place, or the last, and where the pre-token begins."""
        i, at = 1, 0
        while i < self.width:
            i *= 2
            if at + self.chars[i] <= place and self.chars[i + 1]:
                at += self.chars[i]
                i += 1
        sizes = self.leaves[i - self.width][0] if i - self.width < len(self.leaves) else []
        k = 0
        while k + 1 < len(sizes) and at + sizes[k] <= place:
            at += sizes[k]
            k += 1
        return i - self.width, k, at

    def edit(self, start: int, stop: int, new: str) -> int:
        """Replace a span; returns how many pre-tokens were encoded."""
        text = self.text[:start] + new + self.text[stop:]
        shift = len(new) - (stop - start)
        leaf, k, begin = self._find(max(0, start - LOOKAHEAD))
        if begin > max(0, start - LOOKAHEAD):
            leaf, k, begin = 0, 0, 0
        # One more pre-token back: it ends where the one found begins, inside the lookahead.
        if k:
            k -= 1
            begin -= self.leaves[leaf][0][k]
        elif leaf:
            leaf, k, begin = self._find(begin - 1)
        last, j, old = leaf, k, begin
        place, sizes, tokens = begin, [], []
        scanner = self.counter.pattern.finditer(text, begin)
        while True:
            # Old boundaries behind the edit, as far as the new ones have come.
            while last < len(self.leaves) and (old < stop or old + shift < place):
                own = self.leaves[last][0]
                if j < len(own):
                    old += own[j]
                    j += 1
                else:
                    last, j = last + 1, 0
            if old >= stop and old + shift == place and place >= start + len(new):
                break
            match = next(scanner, None)
            if match is None:
                last, j = len(self.leaves), 0
                break
            piece = match.group()
            sizes.append(len(piece))
            tokens.append(self.counter[piece])
            place = match.end()
        self.text = text
        head = self.leaves[leaf][0][:k], self.leaves[leaf][1][:k]
        if last >= len(self.leaves):
            rest: tuple[list[int], list[int]] = [], []
            last = len(self.leaves) - 1
        else:
            rest = self.leaves[last][0][j:], self.leaves[last][1][j:]
        merged = head[0] + sizes + rest[0], head[1] + tokens + rest[1]
        for i in range(leaf + 1, last + 1):
            self._set(i, [], [])
        self._set(leaf, *merged)
        if len(merged[0]) > 8 * LEAF:
            self._build([x for s, _ in self.leaves for x in s], [x for _, t in self.leaves for x in t])
        return len(sizes)

    def apply(self, edits: Sequence[Edit]) -> int:
        """Apply edits whose places are those of the text as it is now."""
        ordered = sorted(edits)
        if any(a[1] > b[0] for a, b in zip(ordered, ordered[1:])):
            raise ValueError("edits overlap")
        return sum(self.edit(*e) for e in reversed(ordered))


def redactions(pattern: str, new: str) -> Callable[[str], list[Edit]]:
    """Edits that replace what a pattern matches."""
    compiled = re.compile(pattern)
    return lambda text: [(m.start(), m.end(), new) for m in compiled.finditer(text) if m.end() > m.start()]


def count_edited(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    edits_of: Callable[[str], list[Edit]],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: tokens before and after its edits, and what was encoded for them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks_path, pattern)
        for batch in small_batches(batches, "text", BATCH_BYTES):
            rows = []
            for text in batch.column(1).to_pylist():
                tree = Tree(text or "", counter)
                before, pieces = tree.tokens, tree.pretokens
                edits = edits_of(text or "")
                again = tree.apply(edits)
                rows.append((before, pieces, len(edits), tree.tokens, again))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], names=[f.split()[0] for f in COUNTS.split(", ")]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, COUNTS)


def trees(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Documents with the leaves of their trees: lengths and tokens of pre-tokens."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks_path, pattern)
        for batch in small_batches(batches, "text", BATCH_BYTES):
            lengths, tokens = [], []
            for text in batch.column(1).to_pylist():
                tree = Tree(text or "", counter)
                lengths.append([x for s, _ in tree.leaves for x in s])
                tokens.append([x for _, t in tree.leaves for x in t])
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lengths, kind), pa.array(tokens, kind)],
                names=["doc_id", "text", "lengths", "tokens"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, text string, lengths array<int>, tokens array<int>")


def apply_edits(kept: DataFrame, ranks_path: str, pattern: str, edits_col: str = "edits") -> DataFrame:
    """Edit kept trees. ``edits`` is an array of structs of start, stop and new text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks_path, pattern)
        for batch in small_batches(batches, "text", BATCH_BYTES):
            out = []
            for text, lengths, tokens, edits in zip(*(batch.column(i).to_pylist() for i in range(1, 5))):
                tree = Tree(text or "", counter, [])
                tree._build(lengths, tokens)
                again = tree.apply([tuple(e.values()) for e in edits or []])
                out.append((
                    tree.text, [x for s, _ in tree.leaves for x in s],
                    [x for _, t in tree.leaves for x in t], tree.tokens, again,
                ))
            kinds = [pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns],
                names=["doc_id", "text", "lengths", "tokens", "n_tokens", "n_reencoded"],
            )

    return kept.select("doc_id", "text", "lengths", "tokens", F.col(edits_col).alias("edits")).mapInArrow(
        run,
        "doc_id long, text string, lengths array<int>, tokens array<int>, n_tokens long, n_reencoded long",
    )
