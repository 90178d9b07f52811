"""Mixture-controlled packing of documents into sequences, by deficit round-robin over sources.

Each source is a queue of its documents' tokens, one document after the other. In every round each
queue that is not dry gets a quantum, its target share of a window; what is left of a token is
carried as its deficit into the next round. The tokens of the rounds, in order of round and queue,
are one stream, and each ``window`` of it is a sequence: all are full but the last, and each holds
the target proportions to within one token for each queue. When a queue runs dry, the others share
its quantum in proportion.

How far a queue has been served after a round is a formula of the round (``Mixture.served``), and so
is its inverse. A task therefore places its documents knowing only the totals of the queues and the
place where its own rows begin in them: deficits carry over windows and partitions without any task
having to wait for another. A source that holds a third of all rows is spread over as many tasks as
its rows.

Steps: tokenize and write the ids with their places in their task's share of the queue; sum the
shares; place and cut. Only the totals of the queues reach the driver, one number for each source;
``max_queues`` of them at most, else the call fails and asks for a coarser ``queue_col``.

Defined results: a null text is empty and holds the end token alone. A null source shares the queue
of the empty one. Rows that repeat a doc_id are packed each. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from maskwright.llm.common import small_batches
from maskwright.llm.subwords import Subwords
from maskwright.sources.staging import stage

WINDOW = 4096
END = 2
BATCH_BYTES = 2 << 20
MAX_QUEUES = 10_000

TOKENS = "doc_id long, queue string, part int, at long, n long, ids binary"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, queue string"
)


@dataclass
class Mixture:
    """How a fair round-robin serves queues of known lengths."""

    totals: np.ndarray
    shares: np.ndarray
    window: int

    def __post_init__(self) -> None:
        dry = self.totals / self.shares
        self.dry = dry
        # Between two moments at which a queue runs dry, all others are served at a fixed rate.
        order = np.argsort(dry, kind="stable")
        self.moments = np.concatenate([[0.0], dry[order]])
        gone = np.concatenate([[0.0], np.cumsum(self.totals[order])])
        left = self.shares.sum() - np.concatenate([[0.0], np.cumsum(self.shares[order])])
        self.rates = np.maximum(left, 0.0)
        self.output = np.maximum.accumulate(gone + self.rates * self.moments)
        self.rounds = int(-(-int(self.totals.sum()) // self.window))

    def moment(self, rounds: np.ndarray) -> np.ndarray:
        """The moment of the fluid model at which so many rounds are over; never decreases."""
        want = rounds.astype(np.float64) * self.window
        k = np.clip(np.searchsorted(self.output, want, side="right") - 1, 0, len(self.dry) - 1)
        rate = np.where(self.rates[k] > 0, self.rates[k], 1.0)
        at = self.moments[k] + np.maximum(want - self.output[k], 0.0) / rate
        return np.minimum(at, self.moments[k + 1])

    def served(self, rounds: np.ndarray, queues: np.ndarray) -> np.ndarray:
        """Tokens that each queue has given after its round; whole, and never decreasing."""
        at = self.moment(rounds)
        taken = np.floor(self.shares[queues] * at).astype(np.int64)
        over = (at >= self.dry[queues]) | (rounds >= self.rounds)
        return np.where(over, self.totals[queues], np.minimum(taken, self.totals[queues]))

    def round_of(self, places: np.ndarray, queues: np.ndarray) -> np.ndarray:
        """The round in which a queue gives the token at a place."""
        low, high = np.zeros(len(places), np.int64), np.full(len(places), self.rounds, np.int64)
        while np.any(high - low > 1):
            middle = (low + high) // 2
            before = self.served(middle, queues) <= places
            low, high = np.where(before, middle, low), np.where(before, high, middle)
        return low

    def stream(self, rounds: np.ndarray, queues: np.ndarray) -> np.ndarray:
        """The place in the stream at which a queue's turn in a round begins."""
        distinct, back = np.unique(rounds, return_inverse=True)
        every = np.arange(len(self.totals))
        out = np.empty(len(rounds), np.int64)
        step = max(1, (1 << 20) // len(every))
        for i in range(0, len(distinct), step):
            some = distinct[i : i + step]
            grid = np.repeat(some, len(every)), np.tile(every, len(some))
            before = self.served(*grid).reshape(len(some), -1)
            after = self.served(grid[0] + 1, grid[1]).reshape(len(some), -1)
            given = after - before
            begins = before.sum(1, keepdims=True) + np.cumsum(given, 1) - given
            here = (back >= i) & (back < i + len(some))
            out[here] = begins[back[here] - i, queues[here]]
        return out


def spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i the numbers from first[i] to last[i], and i itself beside each."""
    counts = last - first + 1
    rows = np.repeat(np.arange(len(first)), counts)
    return rows, first[rows] + np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)


def cut(
    mixture: Mixture, queues: np.ndarray, places: np.ndarray, lengths: np.ndarray
) -> tuple[np.ndarray, ...]:
    """Pieces of documents: row, start in the document, length, sequence and offset in it."""
    rows, turns = spread(
        mixture.round_of(places, queues), mixture.round_of(places + lengths - 1, queues)
    )
    opens, closes = mixture.served(turns, queues[rows]), mixture.served(turns + 1, queues[rows])
    begins = np.maximum(places[rows], opens)
    ends = np.minimum((places + lengths)[rows], closes)
    some = ends > begins
    rows, turns, opens = rows[some], turns[some], opens[some]
    begins, ends = begins[some], ends[some]
    at = mixture.stream(turns, queues[rows]) + begins - opens
    # A turn may lie over the end of a window.
    inner, windows = spread(at // mixture.window, (at + ends - begins - 1) // mixture.window)
    left = np.maximum(at[inner], windows * mixture.window)
    right = np.minimum((at + ends - begins)[inner], (windows + 1) * mixture.window)
    starts = (begins - places[rows])[inner] + left - at[inner]
    return rows[inner], starts, right - left, windows, left - windows * mixture.window


def tokenize(docs: DataFrame, id_col: str, text_col: str, queue_col: str, path: str) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Subwords(path)
        kind = f"<u{encoder.width}"
        part, given = TaskContext.get().partitionId(), {}
        for batch in small_batches(batches, "text", BATCH_BYTES):
            flat, counts = encoder.encode(batch.column(1).to_pylist())
            flat, ends = flat.astype(kind), np.cumsum(counts)
            last = np.array([END], kind).tobytes()
            ids = [flat[e - n : e].tobytes() + last for e, n in zip(ends, counts)]
            at = []
            queues = batch.column(2).to_pylist()
            for q, n in zip(queues, (counts + 1).tolist()):
                at.append(given.get(q, 0))
                given[q] = at[-1] + n
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(np.full(len(at), part, np.int32)),
                    pa.array(at, pa.int64()),
                    pa.array(counts + 1, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=["doc_id", "queue", "part", "at", "n", "ids"],
            )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.coalesce(F.col(queue_col).cast("string"), F.lit("")).alias("queue"),
    )
    return rows.mapInArrow(run, TOKENS)


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    queue_col: str = "source",
    target: Mapping[str, float] | None = None,
    window: int = WINDOW,
    max_queues: int = MAX_QUEUES,
) -> DataFrame:
    """One row per piece. ``target`` gives each queue's share of a window; the corpus's own shares
    without it. Queues that it does not name get the least share that it names."""
    tokens = stage(tokenize(docs, id_col, text_col, queue_col, tokenizer), "pack-tokens")
    shares = tokens.groupBy("queue", "part").agg(F.max(F.col("at") + F.col("n")).alias("given"))
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = stage(
        shares.withColumn("base", F.coalesce(F.sum("given").over(earlier), F.lit(0))),
        "pack-bases",
    )
    sums = bases.groupBy("queue").agg(F.sum("given").alias("total")).orderBy("queue")
    found = sums.limit(max_queues + 1).collect()
    if len(found) > max_queues:
        raise ValueError(f"more than {max_queues} queues: give a coarser queue_col")
    names = {r["queue"]: i for i, r in enumerate(found)}
    totals = np.array([r["total"] for r in found], np.float64)
    weights = totals.copy()
    if target is not None:
        if any(not target.get(q, 1.0) > 0 for q in names):
            raise ValueError("shares must be positive")
        least = min(target.values(), default=1.0)
        weights = np.array([target.get(q, least) for q in names], np.float64)
    whole = totals.astype(np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixture = Mixture(whole, weights / weights.sum(), window)
        for batch in small_batches(batches, "ids", BATCH_BYTES):
            ids, queue, doc = (batch.column(i) for i in (4, 1, 0))
            lengths = batch.column(3).to_numpy()
            queues = np.fromiter(map(names.__getitem__, queue.to_pylist()), np.int64, len(queue))
            rows, starts, sizes, sequences, offsets = cut(
                mixture, queues, batch.column(2).to_numpy(), lengths
            )
            data = [np.frombuffer(b, f"<u{len(b) // n}") for b, n in zip(ids.to_pylist(), lengths)]
            sums = [
                zlib.crc32(data[r][s : s + n].astype("<u4").tobytes())
                for r, s, n in zip(rows.tolist(), starts.tolist(), sizes.tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    doc.take(pa.array(rows)),
                    pa.array(starts),
                    pa.array(sizes),
                    pa.array(sums, pa.int64()),
                    pa.array(lengths[rows]),
                    pa.array(sequences),
                    pa.array(offsets),
                    queue.take(pa.array(rows)),
                ],
                names=[
                    "doc_id", "start", "length", "ids_crc32", "doc_tokens",
                    "sequence_id", "offset", "queue",
                ],
            )

    placed = tokens.join(bases, ["queue", "part"]).select(
        "doc_id", "queue", (F.col("base") + F.col("at")).alias("place"), "n", "ids"
    )
    return placed.mapInArrow(run, PIECES)
