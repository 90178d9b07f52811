"""Benchmark decontamination by suffix arrays over shards of the training documents.

A shard is a piece of a task's documents, about ``SHARD_BYTES`` of text. Its words become numbers,
and the shard's suffixes are sorted by their first ``window`` words. Every suffix of every benchmark
item is then looked up by binary search, all items of a block at once; a short item is looked up as
one prefix. The ranges found are the verbatim occurrences, with their places in document and item.
Occurrences that continue each other are joined to longest matches.

A suffix can begin an occurrence only if each of its next words follows the word before it somewhere
in the benchmark, too. Suffixes that break this within the shortest window are left out of the array
before sorting; nothing that could match is lost. Numbers come from 64-bit hashes of the words; the
words of every occurrence are then compared as bytes, so the result is exact.

Documents are never shuffled. Benchmark items are broadcast in blocks of about ``BLOCK_BYTES``, by
the table's measured size: each block is a step of its own over the same rows, in the same stage.

Defined results: null texts have no words. Items without words are never found. Items that repeat an
id count once; a null id is written as an empty text. Repeated documents give a row each. An empty
table of documents gives no rows; without items nothing is hit. Columns of a document are carried in
one struct, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright.llm.common import small_batches
from maskwright.llm.words import ALPHANUMERIC, Words, gather

WINDOW = 13
PERCENT = 5
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 32 << 20

MATCH = "struct<item_id:string,item_word:long,word:long,length:long>"
FOUND = f"n_words long, hit array<long>, items array<string>, longest_words long, matches array<{MATCH}>"


class Block:
    """Windows of benchmark items, ready to be looked up in any shard."""

    def __init__(self, items: Sequence[tuple[str, str]], window: int) -> None:
        self.names = [name for name, _ in items]
        words = Words([t.encode() for _, t in items], ALPHANUMERIC)
        self.vocabulary, one = np.unique(words.hash, return_index=True)
        self.data, self.lengths = words[one]
        self.starts = np.cumsum(self.lengths) - self.lengths
        numbers = np.searchsorted(self.vocabulary, words.hash) + 1
        self.bits = len(self.vocabulary).bit_length()
        self.window = window
        counts = words.counts
        windows = np.where(counts == 0, 0, np.maximum(counts - window + 1, 1))
        self.item = np.repeat(np.arange(len(items)), windows)
        self.at = np.arange(len(self.item)) - np.repeat(np.cumsum(windows) - windows, windows)
        self.length = np.minimum(counts[self.item], window)
        self.least = int(self.length.min()) if len(self.length) else 0
        begins = words.first[self.item] + self.at
        grid = begins[:, None] + np.arange(window)
        inside = np.arange(window) < self.length[:, None]
        table = np.where(inside, np.append(numbers, np.zeros(window, np.int64))[grid], 0)
        self.low, self.high = self.keys(table), self.keys(np.where(inside, table, (1 << self.bits) - 1))
        same = words.text[1:] == words.text[:-1]
        self.pairs = np.unique(self.pair(numbers[:-1], numbers[1:])[same]) if len(numbers) > 1 else numbers[:0]
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.short(self.pairs)] = True

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a * (len(self.vocabulary) + 1) + b

    @staticmethod
    def short(pairs: np.ndarray) -> np.ndarray:
        return (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)

    def keys(self, table: np.ndarray) -> list[np.ndarray]:
        """Columns of word numbers, several in each 63-bit key, so that keys sort as the words do."""
        per = max(1, 63 // max(1, self.bits))
        keys = []
        for i in range(0, self.window, per):
            key = np.zeros(len(table), np.int64)
            for column in range(i, i + per):
                key <<= self.bits
                if column < self.window:
                    key |= table[:, column]
            keys.append(key)
        return keys

    def numbers(self, words: Words) -> np.ndarray:
        """Numbers of a shard's words, 0 for words of no item, with a 0 after each text."""
        at = np.searchsorted(self.vocabulary, words.hash)
        known = at < len(self.vocabulary)
        known[known] = self.vocabulary[at[known]] == words.hash[known]
        out = np.zeros(len(at) + len(words.counts) + self.window, np.int64)
        out[np.arange(len(at)) + words.text] = np.where(known, at + 1, 0)
        return out

    def follows(self, numbers: np.ndarray) -> np.ndarray:
        """True where a number and its successor stand together in an item."""
        pairs = self.pair(numbers[:-1], numbers[1:])
        some = np.flatnonzero(self.seen[self.short(pairs)])
        at = np.searchsorted(self.pairs, pairs[some])
        right = at < len(self.pairs)
        right[right] = self.pairs[at[right]] == pairs[some][right]
        out = np.zeros(len(numbers), bool)
        out[some[right]] = True
        return out


def bisect(columns: list[np.ndarray], keys: list[np.ndarray], right: bool) -> np.ndarray:
    """For each key the place in sorted rows, before or after the rows equal to it."""
    low, high = np.zeros(len(keys[0]), np.int64), np.full(len(keys[0]), len(columns[0]), np.int64)
    while np.any(open_ := low < high):
        middle = np.minimum((low + high) // 2, len(columns[0]) - 1)
        less, same = np.zeros(len(low), bool), np.ones(len(low), bool)
        for column, key in zip(columns, keys):
            value = column[middle]
            less |= same & (value < key)
            same &= value == key
        go = (less | same if right else less) & open_
        low, high = np.where(go, middle + 1, low), np.where(open_ & ~go, middle, high)
    return low


def occurrences(block: Block, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the block and the places where they occur in the shard."""
    runs = block.follows(numbers)
    breaks = np.flatnonzero(~runs)
    ahead = breaks[np.searchsorted(breaks, np.arange(len(numbers)))] - np.arange(len(numbers))
    begins = np.flatnonzero((numbers > 0) & (ahead >= block.least - 1))
    if not len(begins) or not len(block.item):
        return begins[:0], begins[:0]
    columns = block.keys(numbers[begins[:, None] + np.arange(block.window)])
    order = np.lexsort(columns[::-1])
    array, columns = begins[order], [c[order] for c in columns]
    low, high = bisect(columns, block.low, False), bisect(columns, block.high, True)
    found = high - low
    return np.repeat(np.arange(len(low)), found), gather(array, low, found)


def verified(block: Block, words: Words, numbers: np.ndarray, places: np.ndarray) -> bool:
    """Whether the words at some places are, byte for byte, those that their numbers stand for.
    If not, the numbers of the others become 0."""
    slots = np.arange(len(words.text)) + words.text
    some = np.searchsorted(slots, places)
    data, lengths = words[some]
    known = numbers[places] - 1
    right = block.lengths[known] == lengths
    if right.all():
        own = gather(block.data, block.starts[known], lengths)
        begins = np.cumsum(lengths) - lengths
        right = np.logical_and.reduceat(own == data, begins) if len(begins) else right
    numbers[places[~right]] = 0
    return bool(right.all())


def search(block: Block, texts: Sequence[bytes | None]) -> list[tuple]:
    """For each text: words, runs of hit words, names of items, longest match, all matches."""
    words = Words(texts, ALPHANUMERIC)
    numbers = block.numbers(words)
    while True:
        windows, places = occurrences(block, numbers)
        marks = np.zeros(len(numbers) + 1, np.int64)
        np.add.at(marks, places, 1)
        np.add.at(marks, places + block.length[windows], -1)
        hit = np.cumsum(marks)[:-1] > 0
        if verified(block, words, numbers, np.flatnonzero(hit)):
            break
    # A match: occurrences that follow each other in an item and in a text.
    item, at = block.item[windows], block.at[windows]
    order = np.lexsort((places, places - at, item))
    item, at, place, length = item[order], at[order], places[order], block.length[windows][order]
    joined = np.zeros(len(order), bool)
    joined[1:] = (item[1:] == item[:-1]) & (place[1:] == place[:-1] + 1) & (at[1:] == at[:-1] + 1)
    heads = np.flatnonzero(~joined)
    tails = np.append(heads[1:], len(order))[: len(heads)] - 1
    slot = words.first + np.arange(len(words.counts))
    doc = np.searchsorted(slot, place[heads], side="right") - 1
    matches: list[list[tuple]] = [[] for _ in texts]
    for d, i, a, p, n in zip(
        doc.tolist(),
        item[heads].tolist(),
        at[heads].tolist(),
        (place[heads] - slot[doc]).tolist(),
        (place[tails] + length[tails] - place[heads]).tolist(),
    ):
        matches[d].append((block.names[i], a, p, n))
    out = []
    for d, count in enumerate(words.counts.tolist()):
        runs: list[int] = []
        if matches[d]:
            edges = np.diff(np.concatenate([[0], hit[slot[d] : slot[d] + count], [0]]).astype(np.int8))
            runs = np.column_stack([np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)]).ravel().tolist()
        out.append((
            count, runs, sorted({m[0] for m in matches[d]}),
            max((m[3] for m in matches[d]), default=0), matches[d],
        ))
    return out


def union_runs(a: list[int], b: list[int]) -> list[int]:
    """Union of two lists of begin, end, begin, end."""
    spans = sorted([*zip(a[::2], a[1::2]), *zip(b[::2], b[1::2])])
    out: list[int] = []
    for begin, end in spans:
        if out and begin <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [begin, end]
    return out


def merged(old: dict | None, new: tuple) -> tuple:
    if old is None:
        return new
    matches = [tuple(m.values()) for m in old["matches"]] + new[4]
    return (
        new[0], union_runs(old["hit"], new[1]), sorted({*old["items"], *new[2]}),
        max(old["longest_words"], new[3]), matches,
    )


def blocks_of(benchmark: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list[tuple[str, str]]]:
    """Items of the benchmark in blocks of about ``most`` bytes; one empty block without items."""
    items = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("name"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    count = max(1, -(-size // most))
    part = F.pmod(F.xxhash64("name", "text"), F.lit(count))
    for i in range(count):
        yield [tuple(r) for r in items.where(part == i).collect()]


def find_items(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Documents as a struct ``row``, with what ``FOUND`` lists in a struct ``found``."""
    found = T._parse_datatype_string(FOUND)
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(text_col).alias("text"),
        F.lit(None).cast(found).alias("found"),
    )
    schema = rows.schema
    for items in blocks_of(benchmark, item_id_col, item_text_col, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block, kind = Block(sent.value, window), None
            for batch in small_batches(batches, "text", SHARD_BYTES):
                texts = batch.column(1).cast(pa.binary()).to_pylist()
                old = batch.column(2).to_pylist()
                kind = batch.schema.field(2).type
                new = [merged(o, n) for o, n in zip(old, search(block, texts))]
                names = [kind.field(i).name for i in range(kind.num_fields)]
                values = [dict(zip(names, n)) for n in new]
                for v in values:
                    v["matches"] = [
                        dict(zip(("item_id", "item_word", "word", "length"), m)) for m in v["matches"]
                    ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(values, kind)], schema=batch.schema
                )

        rows = rows.mapInArrow(run, schema)
    return rows.select("row", "found")


def hit_words(found: str = "found") -> Column:
    """Number of hit words: the runs' ends less their begins."""
    hit = F.col(f"{found}.hit")
    signed = F.transform(hit, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    return F.aggregate(signed, F.lit(0).cast("long"), lambda a, x: a + x)


def is_contaminated(n_hit: Column, n_words: Column, percent: int = PERCENT) -> Column:
    return (n_hit > 0) & (n_hit * 100 >= n_words * percent)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    percent: int = PERCENT,
    **options,
) -> DataFrame:
    """One row per document: counts, items found and the judgement; then longest match and matches."""
    rows = find_items(docs, benchmark, **options)
    rows = rows.select("*", hit_words().alias("n_hit"), F.col("found.n_words").alias("n_words"))
    return rows.select(
        F.col(f"row.`{id_col}`").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        is_contaminated(F.col("n_hit"), F.col("n_words"), percent).alias("contaminated"),
        F.col("found.longest_words").alias("longest_words"),
        F.col("found.matches").alias("matches"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    rows = find_items(docs, benchmark, **options)
    return rows.where(
        ~is_contaminated(hit_words(), F.col("found.n_words"), percent)
    ).select("row.*")
