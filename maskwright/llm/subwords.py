"""Subword ids of whole texts, with the work done once for each distinct piece of text.

A tokenizer that drops white space and never builds a token across it gives the same ids for a text
as for the pieces between its blanks, in order. Pieces repeat, so each is encoded once and kept with
its ids in one flat array; texts are then a gather from that array. What is kept is dropped when it
has grown past ``KEPT`` pieces, so memory does not follow the number of distinct pieces.

Pieces are cut before their last stops. Parts that are one run of lower-case Latin letters, nearly
all, are merged together, one merge of each part at a time, in numpy (``Merges``); all other parts
are encoded by the ``tokenizers`` library. The ids are the library's in both cases, which the tests
hold against it.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence

import numpy as np

KEPT = 250_000
AT_ONCE = 4096

# No match of the tokenizer's pattern goes from a letter or digit on to these.
TAIL = ".,!?;:"

# Letters before this one are one character in lower case and in any normal form.
LATIN_END = "İ"

NEVER = np.int64(1 << 40)


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices ``values[start:start + length]``, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def as_text(piece: str | bytes) -> str:
    return piece if isinstance(piece, str) else piece.decode("utf-8")


class Pieces(dict):
    """Numbers pieces as they are first asked for."""

    def __init__(self) -> None:
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.fresh.append(piece)
        return number


class Merges:
    """Byte-pair merges of many words at once."""

    def __init__(self, path: str) -> None:
        from tokenizers.pre_tokenizers import ByteLevel

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.inner, self.last = np.zeros(256, np.int64), np.zeros(256, np.int64)
        for letter in map(chr, range(ord("a"), ord(LATIN_END))):
            if letter.isalpha():
                for byte, symbol in zip(letter.encode(), level.pre_tokenize_str(letter)[0][0]):
                    self.inner[byte], self.last[byte] = vocab[symbol], vocab[symbol + end]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        pairs = np.array([(vocab[a] << 32) | vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.ranks, self.made = pairs[order], order, made
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.short(pairs)] = True

    @staticmethod
    def short(pairs: np.ndarray) -> np.ndarray:
        return (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge's number for each pair, NEVER where there is none."""
        pairs = (left << 32) | right
        out = np.full(len(pairs), NEVER)
        some = np.flatnonzero(self.seen[self.short(pairs)])
        at = np.minimum(np.searchsorted(self.pairs, pairs[some]), len(self.pairs) - 1)
        right_ones = self.pairs[at] == pairs[some]
        out[some[right_ones]] = self.ranks[at[right_ones]]
        return out

    def encode(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one after the other, and the number of ids of each."""
        data = [w.encode() for w in words]
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        flat = np.frombuffer(b"".join(data), np.uint8)
        ids = self.inner[flat]
        tails = np.cumsum(sizes) - 1
        ids[tails] = self.last[flat[tails]]
        ranks = np.full(len(ids), NEVER)
        ranks[:-1] = self.rank(ids[:-1], ids[1:])
        ranks[tails] = NEVER
        done_ids = [np.empty(0, np.int64)] * 2
        done_words = [np.empty(0, np.int64)] * 2
        word = np.arange(len(data))
        counts = sizes.copy()
        while len(ids):
            begins = np.cumsum(counts) - counts
            best = np.minimum.reduceat(ranks, begins)
            go = best < NEVER
            if not go.all():
                stay = np.repeat(~go, counts)
                done_ids.append(ids[stay])
                done_words.append(np.repeat(word[~go], counts[~go]))
                ids, ranks = ids[~stay], ranks[~stay]
                word, counts, best = word[go], counts[go], best[go]
                if not len(ids):
                    break
                begins = np.cumsum(counts) - counts
            # The first of the places with the word's lowest rank is merged.
            places = np.flatnonzero(ranks == np.repeat(best, counts))
            owner = np.searchsorted(begins, places, side="right") - 1
            places = places[np.diff(owner, prepend=-1) > 0]
            ids[places] = self.made[best]
            keep = np.ones(len(ids), bool)
            keep[places + 1] = False
            ids, ranks = ids[keep], ranks[keep]
            counts = counts - 1
            places = places - np.arange(len(places))
            ends = np.cumsum(counts) - 1
            inner = places < ends
            ranks[places] = NEVER
            ranks[places[inner]] = self.rank(ids[places[inner]], ids[places[inner] + 1])
            left = places[places > ends - counts + 1]
            ranks[left - 1] = self.rank(ids[left - 1], ids[left])
        owners = np.concatenate(done_words)
        order = np.argsort(owners, kind="stable")
        return np.concatenate(done_ids)[order], np.bincount(owners, minlength=len(data))


class Subwords:
    """Encoder for many texts with a ``tokenizers`` file that drops white space."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = Merges(path)
        self.clear()

    def clear(self) -> None:
        self.pieces, self.parts = Pieces(), Pieces()
        self.cores = self.tails = np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)
        self.starts = self.lengths = np.empty(0, np.int64)

    @property
    def width(self) -> int:
        """Bytes that hold any id."""
        return 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4

    @staticmethod
    def _cut(piece: str) -> tuple[str, str]:
        """A piece cut before its last stops, in lower case where that is what the tokenizer does."""
        core, tail = piece, ""
        if piece[-1:] in TAIL:
            core = piece.rstrip(TAIL)
            if core[-1:].isalpha() and core[-1] < LATIN_END:
                tail = piece[len(core) :]
            else:
                core = piece
        if core.isascii() and "<|" not in core or core.isalpha() and max(core) < LATIN_END:
            core = core.lower()
        return core, tail

    def _learn(self) -> None:
        fresh, self.pieces.fresh = self.pieces.fresh, []
        if not fresh:
            return
        number = self.parts.__getitem__
        both = [number(part) for piece in fresh for part in self._cut(as_text(piece))]
        both = np.array(both, np.int64).reshape(-1, 2)
        self.cores = np.concatenate([self.cores, both[:, 0]])
        self.tails = np.concatenate([self.tails, both[:, 1]])
        parts, self.parts.fresh = self.parts.fresh, []
        simple = np.array([p.isalpha() and max(p) < LATIN_END for p in parts], bool)
        words = [p for p, s in zip(parts, simple) if s]
        others = [p for p, s in zip(parts, simple) if not s]
        lengths = np.zeros(len(parts), np.int64)
        flats = []
        if words:
            flat, lengths[simple] = self.merges.encode(words)
            flats.append(flat.astype(np.uint32))
        counts = []
        for i in range(0, len(others), AT_ONCE):
            for e in self.tokenizer.encode_batch_fast(others[i : i + AT_ONCE], add_special_tokens=False):
                counts.append(len(e.ids))
                flats.append(np.array(e.ids, np.uint32))
        lengths[~simple] = counts
        # The flat array has the simple parts first.
        order = np.concatenate([np.flatnonzero(simple), np.flatnonzero(~simple)])
        starts = np.empty(len(parts), np.int64)
        starts[order] = len(self.ids) + np.cumsum(lengths[order]) - lengths[order]
        self.ids = np.concatenate([self.ids, *flats])
        self.starts = np.concatenate([self.starts, starts])
        self.lengths = np.concatenate([self.lengths, lengths])

    def make_room(self) -> None:
        if len(self.pieces) > KEPT:
            self.clear()

    def numbers(self, words: Sequence[str | bytes]) -> np.ndarray:
        """Numbers of pieces, text or UTF-8; they hold until ``make_room`` is called."""
        numbers = np.fromiter(map(self.pieces.__getitem__, words), np.int64, len(words))
        self._learn()
        return numbers

    def ids_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of numbered pieces, one after the other, and the number of ids of each."""
        parts = np.column_stack([self.cores[numbers], self.tails[numbers]]).ravel()
        lengths = self.lengths[parts]
        return gather(self.ids, self.starts[parts], lengths), lengths[::2] + lengths[1::2]

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and the number of ids of each text."""
        self.make_room()
        words: list[str] = []
        counts = np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            if text:
                words += text.replace("\n", " ").replace("\t", " ").split(" ")
            counts[i + 1] = len(words)
        if not words:
            return self.ids[:0], np.diff(counts)
        flat, lengths = self.ids_of(self.numbers(words))
        return flat, np.diff(np.concatenate([[0], np.cumsum(lengths)])[counts])
