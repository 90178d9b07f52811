"""Removing passages of words that stand elsewhere, too, by suffix automata of reference shards.

A window is ``window`` consecutive words of a document. Every word goes that is covered by a window whose
words also start anywhere else: each of the copies is removed.

The corpus is its own reference, and to stream every document through an automaton of every other would be
quadratic. So passages are dealt out to shards by what they hold. The anchor of a window is the least hash
of the ``GRAM`` word strings in it, so equal windows have equal anchors; neighbouring windows of one anchor
are a passage of fewer than twice ``window`` words, and each window lies in one passage. Anchors are counted,
locally first, and only passages whose anchor stands elsewhere go on. Passages with equal words are one,
with a count, and the words of one of them are fetched from its document.

A shard gets the passages of its anchors, about ``SHARD_WORDS`` words, builds one suffix automaton of
them, with the number of times each state's strings stand in the corpus, and sends it to no other shard: all
that could match it is there. The passages are then streamed through it for matching statistics: the
longest string ending at each word that the automaton knows, cut at ``window`` words, and the state that it leads
to. Where that is a whole window that stands twice or more, its words are removed; the maximal spans go back to
the documents. Words are compared themselves, in the automaton; hashes of 128 bits tell passages apart.

Hot groups: an anchor that stands in more than ``HOT`` passages is taken apart into its windows, each dealt
out and counted by the hash of its own words, so a phrase that very many documents share in different
surroundings fills no shard. The list of such anchors is broadcast. It holds those above the total divided
by ``MOST``, if that is more, so it cannot be longer than ``MOST``; so do the answers for windows that are hot
themselves. Documents with equal ids and texts are alike, and their spans are found for both together.

Defined results: a null text has no words. A document shorter than a window keeps its words. Rows that
repeat each other are copies of each other and are removed both. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.llm.common import small_batches
from maskwright.llm.lpf import least_grams
from maskwright.llm.words import NOT_BLANK, Words
from maskwright.sources.staging import stage

WINDOW = 35
GRAM = 8
BATCH_BYTES = 2 << 20
SHARD_WORDS = 200_000
HOT = 4096
MOST = 1_000_000

# Odd factors of the two hashes of word strings.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

KEYS = ["anchor", "s"]
DOC = ["d", "t"]
PASSAGES = "anchor long, s long, d long, t long, lo int, n int, single boolean"
CONTENT = "anchor long, s long, c long, words binary"
ANSWERS = "anchor long, s long, c long, runs array<int>"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
RUNS = pa.list_(pa.int32())

FIELDS = {
    "anchor": pa.int64(), "s": pa.int64(), "d": pa.int64(), "t": pa.int64(), "lo": pa.int32(), "n": pa.int32(),
    "single": pa.bool_(), "c": pa.int64(), "words": pa.binary(), "runs": RUNS, "doc_id": pa.int64(),
    "text": pa.binary(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string(),
    "kept": pa.string(),
}


def batch_of(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, FIELDS[n]) for n, c in columns.items()], names=list(columns)
    )


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(32))).view(np.int64)


class Strings:
    """Hashes of any runs of consecutive words: differences of one sum of all words."""

    def __init__(self, h: np.ndarray) -> None:
        self.sums, self.back = [], []
        for factor in FACTORS:
            powers = np.full(len(h) + 1, factor, np.uint64)
            powers[0] = 1
            powers = np.multiply.accumulate(powers)
            undo = np.full(len(h) + 1, pow(factor, -1, 1 << 64), np.uint64)
            undo[0] = 1
            self.back.append(np.multiply.accumulate(undo))
            sums = np.zeros(len(h) + 1, np.uint64)
            np.cumsum(h * powers[:-1], out=sums[1:])
            self.sums.append(sums)

    def of(self, which: int, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        sums = self.sums[which]
        inner = (sums[starts + lengths] - sums[starts]) * self.back[which][starts]
        return mixed(inner + lengths.astype(np.uint64) * np.uint64(FACTORS[1 - which]))


class Passages:
    """The passages of many texts: text, place in it, number of windows, anchor, and place in the batch.

    In some the anchor stands ``twice``, so that windows of one passage may be equal.
    """

    def __init__(self, texts: list[bytes | None], window: int, gram: int) -> None:
        words = Words(texts, NOT_BLANK, None)
        self.hash = words.hash
        windows = np.maximum(words.counts - window + 1, 0)
        some = np.flatnonzero(windows)
        self.text = self.lo = self.n = self.anchor = self.at = self.twice = np.empty(0, np.int64)
        if not len(some):
            return
        value, left, right = least_grams(self.hash, window, gram)
        owner = np.repeat(some, windows[some])
        local = np.arange(len(owner)) - np.repeat(np.cumsum(windows[some]) - windows[some], windows[some])
        at = words.first[owner] + local
        value = value[at]
        head = np.ones(len(owner), bool)
        head[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        heads = np.flatnonzero(head)
        sizes = np.diff(np.append(heads, len(owner)))
        # Words that repeat at once could keep one anchor for long: cut such runs.
        span = window - gram + 1
        parts = -(-sizes // span)
        place = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        heads = np.repeat(heads, parts) + span * place
        self.n = np.diff(np.append(heads, len(owner)))
        self.text, self.lo, self.anchor, self.at = owner[heads], local[heads], value[heads], at[heads]
        self.twice = left[self.at] != right[self.at + self.n - 1]


def sources(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Ids, texts, and what tells documents apart: an id that is never null and a hash of both."""
    one = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return one.select(
        "doc_id",
        F.coalesce("doc_id", F.lit(0)).alias("d"),
        F.xxhash64("doc_id", "text").alias("t"),
        F.col("text").cast("binary").alias("text"),
    )


def anchor_counts(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """In how many passages each anchor stands; those that hold it twice count as two."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BATCH_BYTES):
            found = Passages(batch.column(0).to_pylist(), window, gram)
            value, place = np.unique(found.anchor, return_inverse=True)
            yield batch_of(anchor=value, c=np.bincount(place, 1 + found.twice).astype(np.int64))

    return docs.select("text").mapInArrow(run, "anchor long, c long").groupBy("anchor").agg(F.sum("c").alias("c"))


def passages(docs: DataFrame, window: int, gram: int, hot: Broadcast) -> DataFrame:
    """Every passage, those with a hot anchor as single windows that are their own anchors."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BATCH_BYTES):
            found = Passages(batch.column(2).to_pylist(), window, gram)
            d, t = (batch.column(i).to_numpy() for i in (0, 1))
            strings = Strings(found.hash)
            single = np.isin(found.anchor, hot.value)
            text, lo, n, at, anchor = (
                x[~single] for x in (found.text, found.lo, found.n, found.at, found.anchor)
            )
            yield batch_of(
                anchor=anchor, s=strings.of(0, at, n + window - 1), d=d[text], t=t[text], lo=lo, n=n,
                single=np.zeros(len(n), bool),
            )
            n = found.n[single]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            text, lo, at = (np.repeat(x[single], n) for x in (found.text, found.lo, found.at))
            at, length = at + step, np.full(len(step), window)
            yield batch_of(
                anchor=strings.of(1, at, length), s=strings.of(0, at, length), d=d[text], t=t[text],
                lo=lo + step, n=np.ones(len(step), np.int32), single=np.ones(len(step), bool),
            )

    return docs.select("d", "t", "text").mapInArrow(run, PASSAGES)


def packed(docs: DataFrame, *columns: str) -> DataFrame:
    """Documents with compressed texts, to be shuffled."""
    kept = docs.select(*columns, "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in small_batches(batches, "text", BATCH_BYTES):
            texts = [pack.compress(t or b"") for t in batch.column(len(columns)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.binary())], names=[*columns, "text"]
            )

    return kept.mapInArrow(run, kept.schema)


def contents(docs: DataFrame, several: DataFrame, window: int) -> DataFrame:
    """The words of each passage, from the one document that stands for it."""
    places = several.select("first.*", *KEYS, "c").groupBy(*DOC).agg(
        F.collect_list(F.struct(*KEYS, "c", "lo", "n")).alias("places")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in small_batches(batches, "text", BATCH_BYTES):
            for text, found in zip(*[c.to_pylist() for c in batch.columns]):
                words = unpack.decompress(text).split()
                yield batch_of(
                    **{k: [p[k] for p in found] for k in (*KEYS, "c")},
                    words=[b" ".join(words[p["lo"] : p["lo"] + p["n"] + window - 1]) for p in found],
                )

    return packed(docs, *DOC).join(places, DOC).select("text", "places").mapInArrow(run, CONTENT)


class Automaton:
    """A suffix automaton of many word strings, each with a count."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.link) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        """A state for the strings of q that are as long as the way from p; the others keep q."""
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, words: list[int], count: int) -> None:
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
            else:
                new, p = self._state(self.length[last] + 1, 0, {}), last
                while p != -1 and word not in self.next[p]:
                    self.next[p][word] = new
                    p = self.link[p]
                if p != -1:
                    q = self.next[p][word]
                    self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
                last = new
            self.count[last] += count

    def finish(self) -> None:
        """Count each state's strings where they end longer ones, too."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.count[self.link[state]] += self.count[state]

    def repeated(self, words: list[int], window: int) -> list[int]:
        """Maximal spans of words under windows that were added twice or more: start, stop, start, ..."""
        state = matched = 0
        runs: list[int] = []
        for i, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word not in self.next[state]:
                continue
            state, matched = self.next[state][word], matched + 1
            if matched < window:
                continue
            matched = window
            while self.length[self.link[state]] >= window:
                state = self.link[state]
            if self.count[state] > 1:
                start = i - window + 1
                if runs and start <= runs[-1]:
                    runs[-1] = i + 1
                else:
                    runs += [start, i + 1]
        return runs


def answers(content: DataFrame, shards: int, window: int) -> DataFrame:
    """The repeated spans within each passage that has any."""

    def run(shard: pa.Table) -> pa.Table:
        number: dict[bytes, int] = {}
        found: dict[tuple[int, int], tuple[int, list[int]]] = {}
        columns = [shard.column(c).to_pylist() for c in (*KEYS, "c", "words")]
        for anchor, s, c, words in zip(*columns):
            found[anchor, s] = c, [number.setdefault(w, len(number)) for w in words.split(b" ")]
        known = Automaton()
        for c, words in found.values():
            known.add(words, c)
        known.finish()
        rows = [(*key, c, known.repeated(words, window)) for key, (c, words) in found.items()]
        rows = [r for r in rows if r[3]]
        names = (*KEYS, "c", "runs")
        return pa.Table.from_batches([batch_of(**{n: [r[i] for r in rows] for i, n in enumerate(names)})])

    dealt = content.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(run, ANSWERS)


def spans(docs: DataFrame, window: int, gram: int, hot_from: int, most: int, shard_words: int) -> DataFrame:
    """Spans to remove by document: ``d, t, spans``, each with its first word and the runs in it."""
    spark = docs.sparkSession
    again = stage(anchor_counts(docs, window, gram).where("c > 1"), "automata-anchors")
    total = again.agg(F.sum("c")).first()[0] or 0
    limit = max(hot_from, total // most)
    # Fewer than `most` anchors are over the limit, since that many would have more than the total.
    hot = np.array([r[0] for r in again.where(F.col("c") > limit).select("anchor").collect()], np.int64)
    sent = spark.sparkContext.broadcast(hot)
    # Windows of hot anchors go on as they are. They find no anchor, so their keys only spread them.
    found = passages(docs, window, gram, sent).withColumn(
        "key", F.when(F.col("single"), F.xxhash64("t", "lo")).otherwise(F.col("anchor"))
    )
    known = again.select(F.col("anchor").alias("key"), F.lit(True).alias("known"))
    found = found.join(known, "key", "left").where("single OR known").drop("key", "known", "single")
    found = stage(found, "automata-passages")
    several = stage(
        found.groupBy(*KEYS).agg(
            F.count(F.lit(1)).alias("c"), F.min(F.struct(*DOC, "lo", "n")).alias("first")
        ),
        "automata-distinct",
    )
    size = several.agg(F.sum(F.col("first.n") + window - 1)).first()[0] or 0
    shards = int(size // shard_words) + 1
    found_runs = stage(answers(contents(docs, several, window), shards, window), "automata-answers")
    # Answers over the limit are fewer than `most`, for the same reason, and are broadcast.
    over = F.col("c") > F.lit(limit)
    often = F.broadcast(found_runs.where(over).drop("c"))
    rest = found.join(F.broadcast(found_runs.where(over).select(*KEYS)), KEYS, "left_anti")
    hits = found.join(often, KEYS).unionByName(rest.join(found_runs.where(~over).drop("c"), KEYS))
    return hits.groupBy(*DOC).agg(F.collect_list(F.struct("lo", "runs")).alias("spans"))


def remove_repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    hot: int = HOT,
    most: int = MOST,
    shard_words: int = SHARD_WORDS,
    kept_text: bool = False,
) -> DataFrame:
    """One row per document: words, words removed, and the digest of the words that stay.

    With ``kept_text`` those words themselves, too, joined by spaces.
    """
    named = sources(docs, id_col, text_col)
    found = spans(named, window, gram, hot, most, shard_words)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in small_batches(batches, "text", BATCH_BYTES):
            out = {"doc_id": batch.column(0), "n_words": [], "n_removed": [], "kept_sha256": []}
            kept = []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = unpack.decompress(text).split()
                out["n_words"].append(len(words))
                if found:
                    goes = np.zeros(len(words), bool)
                    for span in found:
                        for start, stop in zip(span["runs"][::2], span["runs"][1::2]):
                            goes[span["lo"] + start : span["lo"] + stop] = True
                    words = [words[i] for i in np.flatnonzero(~goes)]
                out["n_removed"].append(out["n_words"][-1] - len(words))
                joined = b" ".join(words)
                out["kept_sha256"].append(hashlib.sha256(joined).hexdigest())
                kept.append(joined.decode("utf-8", "replace") if kept_text else None)
            yield batch_of(**out, **({"kept": kept} if kept_text else {}))

    joined = packed(named, "doc_id", *DOC).join(found, DOC, "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(run, RESULT + (", kept string" if kept_text else ""))
