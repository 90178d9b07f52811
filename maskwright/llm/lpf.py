"""Removing later copies of long byte strings, by longest-previous-factor arrays.

A byte goes if it lies in a string of ``length`` bytes that also starts earlier in the corpus. So the
question for each start is whether its longest match with any earlier start, its previous factor,
has ``length`` bytes.

Equal texts are one text first, told apart by 128-bit digests: all but its earliest document go as a
whole, and only that one is worked on.

Starts are dealt out by anchors: an anchor is the least hash of the ``GRAM``-byte strings within a
start's string. Equal strings have equal anchors, so all their starts meet. Neighbouring starts of
one anchor are a segment; their strings together have less than twice ``length`` bytes. Anchors are
counted by hash, and where one occurs once nothing more is done. The segments of the others are cut
out of the texts, which are sent compressed.

Of segments with equal bytes all but the earliest are later copies as a whole. For anchors that stand more
than ``HOT`` times copies are taken out by anchor and salt first, so a passage that very many documents
share leaves one segment for each salt; if more than ``HOT`` different segments are left, they are dealt
out once more by the bytes of each single start. All others are dealt out once, by anchor. An anchor is
worked off in one task: copies go, and of what is left the starts'
strings are sorted, the longest common prefixes of neighbours are taken, and for each start the
nearest one before and after it in suffix order that is earlier in the corpus (previous and next
smaller position) gives its longest previous factor.

The bytes to remove go back to their documents as runs, and each document is cut once.

Defined results: a null text is empty. Documents are ordered by id and, where rows repeat an id, by
a digest of their texts; rows that repeat both count as one document, and each gets its row. A null id
comes before all others. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.llm.common import small_batches
from maskwright.sources.staging import shuffles_freed, stage, staged

LENGTH = 100
GRAM = 16
BATCH_BYTES = 2 << 20
SALTS = 16
HOT = 4096
TASK_STARTS = 100_000
NO_ID = -(1 << 63)

ANCHORS = "anchor long, h long, h2 long, first int, n int, twice boolean"
SEGMENTS = "anchor long, doc long, h long, first int, n int, bytes binary"
FOUND = f"{SEGMENTS}, often boolean"
RUNS = "doc long, h long, start int, stop int"
SEEN = 100_000
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

FIELDS = {
    "anchor": pa.int64(), "doc": pa.int64(), "h": pa.int64(), "h2": pa.int64(), "first": pa.int32(), "n": pa.int32(),
    "bytes": pa.binary(), "start": pa.int32(), "stop": pa.int32(), "doc_id": pa.int64(),
    "text": pa.binary(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(),
    "kept_sha256": pa.string(), "twice": pa.bool_(), "often": pa.bool_(),
}


def batch_of(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, FIELDS[n]) for n, c in columns.items()], names=list(columns)
    )


def documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")
    )


def keys_of(batch: pa.RecordBatch) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Texts and both halves of their digests."""
    texts = [t or b"" for t in batch.column(1).to_pylist()]
    digest = b"".join(hashlib.blake2b(t, digest_size=16).digest() for t in texts)
    halves = np.frombuffer(digest, np.int64).reshape(-1, 2)
    return texts, halves[:, 0], halves[:, 1]


def least_grams(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """For each place the gram with the least hash within the next ``length`` bytes: its hash, and
    the first and the last place where it stands there."""
    h = data.astype(np.uint64) + np.uint64(1)
    width, factor = 1, 0x9E3779B97F4A7C15
    while width < gram:
        h = h[:-width] * np.uint64(factor) + h[width:]
        factor, width = factor * factor % (1 << 64), 2 * width
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    low = np.uint64((1 << 32) - 1)
    place = np.arange(len(h), dtype=np.uint64)

    def least(keys: np.ndarray) -> np.ndarray:
        span, width = length - gram + 1, 1
        while 2 * width <= span:
            keys = np.minimum(keys[:-width], keys[width:])
            width *= 2
        return np.minimum(keys[: len(keys) - (span - width)], keys[span - width :])

    first = least((h & ~low) | place) & low
    last = low - (least((h & ~low) | (low - place)) & low)
    return h[first].view(np.int64), first, last


def anchors_of(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Segments of many texts: text, anchor, first start, number of starts, and whether the anchor
    stands in the segment more than once, so that strings within it may be equal."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.maximum(sizes - length + 1, 0)
    some = np.flatnonzero(starts)
    if not len(some):
        return (np.empty(0, np.int64),) * 5
    value, left, right = least_grams(data, length, gram)
    begins = (np.cumsum(sizes) - sizes)[some]
    owner = np.repeat(some, starts[some])
    local = np.arange(len(owner)) - np.repeat(np.cumsum(starts[some]) - starts[some], starts[some])
    at = np.repeat(begins, starts[some]) + local
    value, left, right = value[at], left[at], right[at]
    head = np.ones(len(owner), bool)
    head[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(head)
    runs = np.diff(np.append(heads, len(owner)))
    # An anchor that comes again and again would make a segment longer than a string.
    span = length - gram + 1
    parts = -(-runs // span)
    heads = np.repeat(heads, parts) + span * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    ends = np.append(heads[1:], len(owner))
    return owner[heads], value[heads], local[heads], ends - heads, left[heads] != right[ends - 1]


def anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in small_batches(batches, "text", BATCH_BYTES):
            texts, h, h2 = keys_of(batch)
            if len(seen) > SEEN:
                seen.clear()
            for i, key in enumerate(zip(h.tolist(), h2.tolist())):
                if key in seen:
                    texts[i] = b""
                seen.add(key)
            owner, value, first, n, twice = anchors_of(texts, length, gram)
            yield batch_of(anchor=value, h=h[owner], h2=h2[owner], first=first, n=n, twice=twice)

    return docs.mapInArrow(run, ANCHORS)


def repeated(found: DataFrame, hot: int = HOT) -> DataFrame:
    """The segments whose anchor stands elsewhere, too, in another text or in this one."""
    # Later joins would put tests for null under one of the two readers of this exchange, and it
    # would then be written twice. With the tests here both readers have the same ones.
    dealt = found.where("anchor IS NOT NULL AND h IS NOT NULL AND h2 IS NOT NULL").repartition("anchor")
    several = dealt.groupBy("anchor").agg(
        F.min("h").alias("a"), F.max("h").alias("b"), F.min("h2").alias("a2"),
        F.max("h2").alias("b2"), F.min("first").alias("a3"), F.max("first").alias("b3"),
        F.bool_or("twice").alias("any"), F.max("n").alias("top"),
        (F.count(F.lit(1)) > hot).alias("often"),
    )
    several = several.where("a <> b or a2 <> b2 or a3 <> b3 or any")
    # Both sides read all columns and have the same filters, so that one exchange serves them.
    return dealt.join(several, "anchor").select(
        "h", "h2", F.struct("anchor", "first", "n", "often", "twice", "top").alias("place")
    )


def identified(docs: DataFrame) -> DataFrame:
    """Ids and digests, without texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BATCH_BYTES):
            _, h, h2 = keys_of(batch)
            yield batch_of(doc=batch.column(0).fill_null(NO_ID), h=h, h2=h2)

    return docs.mapInArrow(run, "doc long, h long, h2 long")


def compressed(docs: DataFrame) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in small_batches(batches, "text", BATCH_BYTES):
            texts, h, h2 = keys_of(batch)
            yield batch_of(
                doc_id=batch.column(0), doc=batch.column(0).fill_null(NO_ID), h=h, h2=h2,
                text=[pack.compress(t) for t in texts],
            )

    return docs.mapInArrow(run, "doc_id long, doc long, h long, h2 long, text binary")


def by_text(found: DataFrame) -> DataFrame:
    """The places of each text's segments."""
    return found.groupBy("h", "h2").agg(F.collect_set("place").alias("places"))


def segments(texts: DataFrame, first: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """Add their bytes to segments, for each text in its earliest document."""
    return with_bytes(texts, first, by_text(found), length)


def with_bytes(texts: DataFrame, first: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """The same for segments that are put together by text."""
    joined = texts.join(first.join(places, ["h", "h2"]), ["h", "h2", "doc"]).select("doc", "h", "text", "places")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in small_batches(batches, "text", BATCH_BYTES):
            for i in range(len(batch)):
                text = unpack.decompress(batch.column(2)[i].as_py())
                anchor, first, n, often, *_ = batch.column(3)[i].values.flatten()
                first, n = first.to_numpy(), n.to_numpy()
                yield batch_of(
                    anchor=anchor,
                    doc=[batch.column(0)[i].as_py()] * len(first),
                    h=[batch.column(1)[i].as_py()] * len(first),
                    first=first,
                    n=n,
                    bytes=[text[a : a + k + length - 1] for a, k in zip(first.tolist(), n.tolist())],
                    often=often,
                )

    return joined.mapInArrow(run, FOUND)


def first_of_equal(rows: DataFrame, length: int, salts: int) -> DataFrame:
    """Segments as they are if no earlier one of their salt has the same bytes; of others the run
    that goes, in ``start`` and ``stop``."""
    salt = F.pmod(F.xxhash64("doc", "h"), F.lit(salts))
    dealt = rows.repartition("anchor", salt).sortWithinPartitions("anchor", "bytes", "doc", "h", "first")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, place = None, None
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(6)]
            out = []
            for row in zip(*columns):
                if (row[0], row[5]) != last:
                    last, place = (row[0], row[5]), row[1:4]
                    out.append((*row, None, None))
                elif row[1:4] != place:
                    # Rows that repeat a document give its segments again; others are later copies.
                    out.append((*row[:5], None, row[3], row[3] + row[4] + length - 1))
            names = ["anchor", "doc", "h", "first", "n", "bytes", "start", "stop"]
            yield batch_of(**dict(zip(names, zip(*out) if out else [[]] * 8)))

    return dealt.mapInArrow(run, f"{SEGMENTS}, start int, stop int")


def nearest_smaller(position: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For each place the longest common prefix with the nearest place before it that has a smaller
    position. ``lcp[i]`` is that of the places i - 1 and i; position -1 stands before all."""
    before = np.arange(-1, len(position) - 1)
    shared = lcp.copy()
    shared[:1] = 0
    while True:
        up = np.flatnonzero((before >= 0) & (position[before] >= position))
        if not len(up):
            return np.where(before >= 0, shared, 0)
        shared[up] = np.minimum(shared[up], shared[before[up]])
        before[up] = before[before[up]]


def previous_factors(strings: np.ndarray, group: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Longest previous factor of each string within its group, up to the strings' length.

    ``strings`` has a row of bytes for each start, ``position`` the order of starts in the corpus.
    """
    length = strings.shape[1]
    keyed = np.concatenate([group.astype(">u8").view(np.uint8).reshape(-1, 8), strings], 1)
    order = np.argsort(keyed.view(f"V{length + 8}").ravel(), kind="stable")
    rows = keyed[order]
    differ = rows[1:] != rows[:-1]
    at = np.where(differ.any(1), differ.argmax(1), length + 8)
    lcp = np.concatenate([[0], np.maximum(at - 8, 0)])
    place = position[order]
    left = nearest_smaller(place, lcp)
    back = np.concatenate([[0], lcp[:0:-1]]) if len(lcp) > 1 else lcp
    right = nearest_smaller(place[::-1], back)[::-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum(left, right)
    return out


def earlier_starts(rows: list[tuple], length: int) -> pa.RecordBatch:
    """Runs of bytes to remove from segments of whole anchors."""
    anchor, doc, h, first = (np.array([r[i] for r in rows], np.int64) for i in range(4))
    n = np.array([r[4] for r in rows], np.int64)
    data = np.frombuffer(b"".join(r[5] for r in rows), np.uint8)
    begins = np.cumsum(n + length - 1) - (n + length - 1)
    segment = np.repeat(np.arange(len(rows)), n)
    local = np.arange(len(segment)) - np.repeat(np.cumsum(n) - n, n)
    strings = np.lib.stride_tricks.sliding_window_view(data, length)[begins[segment] + local]
    order = np.lexsort((first[segment] + local, h[segment], doc[segment]))
    position = np.empty(len(order), np.int64)
    position[order] = np.arange(len(order))
    _, group = np.unique(anchor, return_inverse=True)
    gone = previous_factors(strings, group[segment], position) >= length
    head = gone.copy()
    head[1:] &= ~gone[:-1] | (segment[1:] != segment[:-1])
    tail = gone.copy()
    tail[:-1] &= ~gone[1:] | (segment[1:] != segment[:-1])
    heads, tails = np.flatnonzero(head), np.flatnonzero(tail)
    own = segment[heads]
    return batch_of(
        doc=doc[own], h=h[own], start=first[own] + local[heads], stop=first[own] + local[tails] + length
    )


def later_runs(rows: DataFrame, length: int) -> DataFrame:
    """Runs to remove, of the segments of each anchor.

    Sorted by their bytes, copies of a segment follow it and go as a whole, without being held.
    """
    dealt = rows.repartition("anchor").sortWithinPartitions("anchor", "bytes", "doc", "h", "first")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        starts = 0
        last, place = None, None
        for batch in batches:
            copies = []
            for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if (row[0], row[5]) == last:
                    # Rows that repeat a document give its segments again; others are later copies.
                    if row[1:4] != place:
                        copies.append((row[1], row[2], row[3], row[3] + row[4] + length - 1))
                    continue
                last, place = (row[0], row[5]), row[1:4]
                if starts > TASK_STARTS and row[0] != held[-1][0]:
                    yield earlier_starts(held, length)
                    held, starts = [], 0
                held.append(row)
                starts += row[4]
            if copies:
                yield batch_of(**dict(zip(("doc", "h", "start", "stop"), zip(*copies))))
        if held:
            yield earlier_starts(held, length)

    return dealt.mapInArrow(run, RUNS)


def single_starts(rows: DataFrame, length: int) -> DataFrame:
    """Each start of segments as a segment of its own, dealt out by its bytes."""
    one = rows.select("doc", "h", "first", "bytes", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("k"))
    cut = F.substring(F.col("bytes"), F.col("k") + 1, F.lit(length))
    return one.select(
        F.xxhash64(cut).alias("anchor"), "doc", "h", (F.col("first") + F.col("k")).cast("int").alias("first"),
        F.lit(1).alias("n"), cut.alias("bytes"),
    )


def removed_runs(
    docs: DataFrame, texts: DataFrame, first: DataFrame, length: int, gram: int, salts: int, hot: int
) -> DataFrame:
    """The runs to remove of each text, by its earliest document. Each step is a written table, which goes
    with all that it was made of once it has been read: the anchors are gone before a text is moved."""
    with ExitStack() as held:
        with staged(by_text(repeated(anchors(docs, length, gram), hot)), "places") as places:
            found = held.enter_context(staged(with_bytes(texts, first, places, length), "found-segments"))
        seldom = found.where("NOT often").drop("often")
        equal = first_of_equal(found.where("often").drop("often"), length, salts)
        firsts = held.enter_context(staged(equal, "segments"))
        copies = firsts.where("bytes is null").select("doc", "h", "start", "stop")
        left = firsts.where("bytes is not null").select(*[f.split()[0] for f in SEGMENTS.split(", ")])
        common = left.groupBy("anchor").count().where(F.col("count") > hot).select("anchor")
        common = held.enter_context(staged(common, "hot-anchors"))
        starts = single_starts(left.join(common, "anchor", "left_semi"), length)
        single = held.enter_context(staged(first_of_equal(starts, length, salts), "single-starts"))
        runs = (
            later_runs(seldom, length).unionByName(copies)
            .unionByName(later_runs(left.join(common, "anchor", "left_anti"), length))
            .unionByName(single.where("bytes is null").select("doc", "h", "start", "stop"))
            .unionByName(later_runs(single.where("bytes is not null").select(*left.columns), length))
        )
        return stage(runs.groupBy("doc", "h").agg(F.collect_list(F.struct("start", "stop")).alias("runs")), "runs")


def remove_later_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    salts: int = SALTS,
    hot: int = HOT,
    keep_text: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, if asked for,
    the bytes that are left as ``kept``."""
    if gram & (gram - 1) or gram > length:
        raise ValueError("gram must be a power of two, at most length")
    docs = documents(docs, id_col, text_col)
    texts = compressed(docs)
    with shuffles_freed(docs.sparkSession):
        first = stage(identified(docs).groupBy("h", "h2").agg(F.min("doc").alias("doc")), "first-documents")
        runs = removed_runs(docs, texts, first, length, gram, salts, hot)
    kept_type = ", kept binary" if keep_text else ""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in small_batches(batches, "text", BATCH_BYTES):
            rows, rest = [], []
            later = batch.column(3).to_pylist()
            for i in range(len(batch)):
                text = unpack.decompress(batch.column(1)[i].as_py())
                own = batch.column(2)[i]
                merged: list[list[int]] = []
                spans = [tuple(r.values()) for r in own.as_py()] if own.is_valid else []
                if later[i] and len(text) >= length:
                    spans = [(0, len(text))]
                for a, b in sorted(spans):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                edges = [0, *(x for run in merged for x in run), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                rows.append((len(text), len(text) - len(kept), len(merged), hashlib.sha256(kept).hexdigest()))
                rest.append(kept)
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
            out = batch_of(doc_id=batch.column(0), **dict(zip(names, zip(*rows))))
            yield out.append_column("kept", pa.array(rest, pa.binary())) if keep_text else out

    # The runs of a text stand with its earliest document; the others are later copies.
    known = first.withColumnRenamed("doc", "earliest").join(
        runs.withColumnRenamed("doc", "earliest"), ["h", "earliest"], "left"
    )
    joined = texts.join(known, ["h", "h2"]).select(
        "doc_id", "text", "runs", (F.col("doc") > F.col("earliest")).alias("later")
    )
    return joined.mapInArrow(cut, RESULT + kept_type)
