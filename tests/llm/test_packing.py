"""Packing against a walk over the queues in plain Python."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from maskwright.llm.packing import Mixture, cut, pack

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(docs, rows, window=4096):
    """Every id in one piece, sequences gapless, check sums right."""
    tokenizer = Tokenizer.from_file(PATH)
    ids = {
        d: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for d, t in docs
    }
    by_doc, by_sequence = {}, {}
    for r in rows:
        assert r.doc_tokens == len(ids[r.doc_id])
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert len(piece) == r.length
        assert r.ids_crc32 == zlib.crc32(np.array(piece, "<u4").tobytes())
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for d, parts in by_doc.items():
        place = 0
        for start, length in sorted(parts):
            assert start == place
            place += length
        assert place == len(ids[d])
    assert set(by_doc) == set(ids)
    sizes = []
    for s in sorted(by_sequence):
        place = 0
        for offset, length in sorted(by_sequence[s]):
            assert offset == place
            place += length
        sizes.append(place)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    assert all(n == window for n in sizes[:-1])
    assert 0 < sizes[-1] <= window


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = pack(docs, PATH).collect()
    check([(r.doc_id, r.text) for r in docs.collect()], rows)


def test_proportions_hold_in_every_window(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(5)
    rows = pack(docs, PATH).collect()
    total, queues, windows = 0, {}, {}
    for r in rows:
        total += r.length
        queues[r.queue] = queues.get(r.queue, 0) + r.length
        windows.setdefault(r.sequence_id, {}).setdefault(r.queue, 0)
        windows[r.sequence_id][r.queue] += r.length
    for s in range(max(windows)):
        for q, n in queues.items():
            assert abs(windows[s].get(q, 0) - 4096 * n / total) <= len(queues) + 1


def test_edge_rows(spark):
    long = "word " * 20_000
    data = [
        (1, None, None, 5), (2, "", "a", 5), (3, "Hi  there\n\tWorld 's Été", "a", 5),
        (4, long, "b", 5), (5, "x<|endoftext|>y", "b", 5), (6, "  a\x1cb\x85c", "b", 5),
    ]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, queue int")
    rows = pack(docs, PATH, window=64).collect()
    check([(d, t) for d, t, *_ in data], rows, 64)
    twice = docs.where("doc_id = 3").union(docs.where("doc_id = 3"))
    assert sum(r.length for r in pack(twice, PATH).collect()) == 2 * next(
        r.doc_tokens for r in rows if r.doc_id == 3
    )
    assert pack(docs.limit(0), PATH).count() == 0


def test_target_mixture(spark):
    data = [(i, "a b c d e f g h i j", "small" if i % 10 == 0 else "large") for i in range(600)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(4)
    rows = pack(docs, PATH, target={"small": 0.5, "large": 0.5}, window=100).collect()
    check([(d, t) for d, t, _ in data], rows, 100)
    for s in range(12):
        small = sum(r.length for r in rows if r.sequence_id == s and r.queue == "small")
        assert abs(small - 50) <= 2


def test_more_queues_than_allowed_is_an_error(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "doc_id long, text string, source string")
    with pytest.raises(ValueError):
        pack(docs, PATH, max_queues=1)


@pytest.mark.parametrize("seed", range(20))
def test_served_is_whole_and_gapless(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 30))
    totals = rng.integers(1, 5000, n)
    weights = totals.astype(float) if seed % 2 else rng.random(n) + 0.01
    window = int(rng.integers(2, 300))
    mixture = Mixture(totals, weights / weights.sum(), window)
    queues, places = np.arange(n), np.zeros(n, np.int64)
    _, _, sizes, sequences, offsets = cut(mixture, queues, places, totals)
    order = np.argsort(sequences * window + offsets)
    at = (sequences * window + offsets)[order]
    assert at[0] == 0 and np.all(np.diff(at) == sizes[order][:-1])
    assert sizes.sum() == totals.sum()
