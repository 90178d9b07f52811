"""Language identification with spans of mixed text.

A word's script, from fixed ranges of code points, narrows the languages that it may be in to those
that were seen with the script. Each of them scores the word by its letter trigrams. Viterbi over
the words of a text, with a penalty for each switch, labels every word; neighbours of one label are
a span. The text's language is the label that covers most letters, its score the share of letters
that it covers.

The model is fitted on at most ``sample`` labelled documents, those with the smallest hashes of
their ids: trigram counts for each language in ``BUCKETS`` buckets, summed by Spark. Its size
follows the number of languages alone (``max_languages`` of them at most, else the call fails).
Texts are labelled where they are read, without a shuffle. A word is scored once for each task;
what is kept is dropped when it has grown past ``KEPT`` words.

Defined results: a text that is null or has no letters is ``und`` with score 0 and no spans, and so
is every text if nothing was labelled. Ties go to the language that sorts first. Letters of a script
that no language was seen with are left out of the scores and belong to the span around them.
Repeated documents give a row each; an empty table none. Columns of a document are carried in one
struct, so no name can clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright.llm.common import small_batches
from maskwright.llm.subwords import Pieces

SAMPLE = 20_000
MAX_LANGUAGES = 1000
BUCKETS = 1 << 15
SWITCH = 14.0
WORST = 9.0
SCRIPT_SHARE = 0.01
BATCH_BYTES = 8 << 20
KEPT = 200_000
UNKNOWN = "und"

# Words are runs of letters, with the marks that belong to them.
WORD = re.compile(r"[^\W\d_]+")

# First code points of ranges, in order, with the script of each range.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "indic"), (0x0E00, "thai"), (0x0E80, "other"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"),
    (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
    (0xF900, "han"), (0xFB00, "other"), (0xFF21, "latin"), (0xFF5B, "other"),
    (0x20000, "han"), (0x30000, "other"),
)
SCRIPT_STARTS = np.array([s for s, _ in SCRIPTS])
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
SCRIPT_OF_RANGE = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])

SPANS = "array<struct<start:long,end:long,lang:string>>"
LABEL = f"lang_pred string, score double, spans {SPANS}"


def trigrams(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the trigrams of words, where each word's begin, and the words' scripts."""
    points = np.frombuffer(" ".join(["", *words, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    a, b, c = (points[i : len(points) - 2 + i].astype(np.uint64) for i in range(3))
    mixed = (a * np.uint64(0x9E3779B1) + b) * np.uint64(0x85EBCA77) + c
    mixed = (mixed ^ (mixed >> np.uint64(23))) * np.uint64(0x9E3779B97F4A7C15)
    buckets = (mixed >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
    # A trigram whose middle is a blank lies over the end of a word.
    begins = np.flatnonzero(points[:-1] == 32)[: len(words)]
    inside = points[1:-1] != 32
    firsts = points[begins + 1]
    scripts = SCRIPT_OF_RANGE[np.searchsorted(SCRIPT_STARTS, firsts, side="right") - 1]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return buckets[inside], np.cumsum(lengths) - lengths, scripts


@dataclass
class Model:
    """Scores of trigrams, and which scripts each language is written in."""

    languages: list[str]
    scores: np.ndarray  # bucket, language
    scripts: np.ndarray  # script, language

    def words(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each word its scores, best 0 and none under -WORST, and whether its script is known."""
        buckets, begins, scripts = trigrams(words)
        scores = np.add.reduceat(self.scores[buckets], begins, axis=0)
        allowed = self.scripts[scripts]
        known = allowed.any(1)
        scores = np.where(allowed, scores, -np.inf)
        scores[~known] = 0.0
        scores -= scores.max(1, keepdims=True)
        return np.maximum(scores, -WORST).astype(np.float32), known


def viterbi(scores: np.ndarray, counts: np.ndarray, switch: float) -> np.ndarray:
    """Labels of the words of many texts, one text after the other.

    All texts take their next step together; those that have ended drop out.
    """
    order = np.argsort(-counts, kind="stable")
    sizes = counts[order]
    starts = (np.cumsum(counts) - counts)[order]
    steps = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")
    stays = np.ones(scores.shape, bool)
    sources = np.zeros(len(scores), np.int16)
    value = np.zeros((len(sizes), scores.shape[1]), np.float32)
    for t in range(steps):
        n = active[t]
        at = starts[:n] + t
        if t:
            before = value[:n]
            sources[at] = best = before.argmax(1)
            jump = before[np.arange(n), best][:, None] - np.float32(switch)
            stays[at] = before >= jump
            value[:n] = np.maximum(before, jump) + scores[at]
        else:
            value[:n] = scores[at]
    labels = np.zeros(len(scores), np.int16)
    state = value.argmax(1) if len(sizes) else sources
    for t in range(steps - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        labels[at] = now = state[:n]
        state[:n] = np.where(stays[at, now], now, sources[at])
    return labels


class Labeller:
    """Labels texts, scoring each word once."""

    def __init__(self, model: Model, switch: float) -> None:
        self.model, self.switch = model, switch
        self.clear()

    def clear(self) -> None:
        self.pieces = Pieces()
        self.scores = np.empty((0, len(self.model.languages)), np.float32)
        self.known = np.empty(0, bool)
        self.letters = np.empty(0, np.int64)

    def label(self, texts: Sequence[str | None]) -> list[tuple]:
        languages = self.model.languages
        if not languages:
            return [(UNKNOWN, 0.0, [])] * len(texts)
        if len(self.pieces) > KEPT:
            self.clear()
        words: list[str] = []
        ends = np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            if text:
                words += WORD.findall(text)
            ends[i + 1] = len(words)
        numbers = np.fromiter(map(self.pieces.__getitem__, words), np.int64, len(words))
        fresh, self.pieces.fresh = self.pieces.fresh, []
        if fresh:
            scores, known = self.model.words([lowered(w) for w in fresh])
            self.scores = np.concatenate([self.scores, scores])
            self.known = np.concatenate([self.known, known])
            sizes = np.fromiter(map(len, fresh), np.int64, len(fresh))
            self.letters = np.concatenate([self.letters, sizes])
        labels = viterbi(self.scores[numbers], np.diff(ends), self.switch)
        letters = self.letters[numbers]
        text_of = np.repeat(np.arange(len(texts)), np.diff(ends))
        grid = np.zeros((len(texts), len(languages)), np.int64)
        np.add.at(grid, (text_of, labels), letters * self.known[numbers])
        total = np.bincount(text_of, letters, len(texts))
        best = grid.argmax(1)
        share = grid[np.arange(len(texts)), best] / np.maximum(total, 1)
        out: list[tuple] = []
        for i, text in enumerate(texts):
            if total[i] == 0:
                out.append((UNKNOWN, 0.0, []))
                continue
            spans = self.spans(text, labels[ends[i] : ends[i + 1]])
            out.append((languages[best[i]], float(share[i]), spans))
        return out

    def spans(self, text: str, labels: np.ndarray) -> list[tuple]:
        """Spans from the first letter of their first word to that of the next span's."""
        heads = np.flatnonzero(np.diff(labels, prepend=-1))
        begins = [0]
        if len(heads) > 1:
            wanted = set(heads.tolist())
            begins = [m.start() for k, m in enumerate(WORD.finditer(text)) if k in wanted]
            begins[0] = 0
        names = [self.model.languages[k] for k in labels[heads].tolist()]
        return list(zip(begins, [*begins[1:], len(text)], names))


def lowered(word: str) -> str:
    """Lower-cased, cut of marks that lower-casing may add, never empty."""
    return word.lower().replace(" ", "") or word


def fit(
    docs: DataFrame,
    where: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE,
    max_languages: int = MAX_LANGUAGES,
) -> Model:
    """Count trigrams and scripts of the labelled rows that ``where`` admits."""
    labelled = docs.where(where & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.xxhash64(F.col(id_col)).alias("h"),
        F.col(text_col).alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    )
    top = labelled.select("h").orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    if top is None:
        return Model([], np.empty((0, 0)), np.empty((0, 0), bool))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in small_batches(batches, "text", BATCH_BYTES):
            langs = batch.column(1).to_pylist()
            for lang in set(langs):
                words = [
                    lowered(w)
                    for text, own in zip(batch.column(0).to_pylist(), langs)
                    if own == lang
                    for w in WORD.findall(text)
                ]
                if not words:
                    continue
                buckets, _, scripts = trigrams(words)
                if lang not in sums:
                    sums[lang] = np.zeros(BUCKETS, np.int64), np.zeros(len(SCRIPT_NAMES), np.int64)
                sums[lang][0][:] += np.bincount(buckets, minlength=BUCKETS)
                sums[lang][1][:] += np.bincount(scripts, minlength=len(SCRIPT_NAMES))
        for lang, (grams, scripts) in sums.items():
            values = np.concatenate([grams, scripts])
            some = np.flatnonzero(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some)), pa.array(some, pa.int64()), pa.array(values[some])],
                names=["lang", "bucket", "n"],
            )

    counts = (
        labelled.where(F.col("h") <= top)
        .select("text", "lang")
        .mapInArrow(count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    languages = sorted(
        r["lang"] for r in counts.select("lang").distinct().limit(max_languages + 1).collect()
    )
    if len(languages) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    places = {lang: i for i, lang in enumerate(languages)}
    found = np.zeros((BUCKETS + len(SCRIPT_NAMES), len(languages)))
    for lang, bucket, n in counts.toLocalIterator():
        found[bucket, places[lang]] = n
    grams, scripts = found[:BUCKETS], found[BUCKETS:]
    scores = np.log((grams + 0.5) / (grams.sum(0) + 0.5 * BUCKETS))
    seen = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(0), 1)
    return Model(languages, scores.astype(np.float32), seen)


def label(
    docs: DataFrame,
    model: Model,
    row: Column,
    text_col: str = "text",
    switch: float = SWITCH,
) -> DataFrame:
    """What ``row`` gives of each document, and what ``LABEL`` lists in a struct ``label``."""
    kind = T._parse_datatype_string(LABEL)
    rows = docs.select(row.alias("row"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("label", kind)])
    sent = docs.sparkSession.sparkContext.broadcast(model)
    arrow = pa.struct([
        ("lang_pred", pa.string()), ("score", pa.float64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))),
    ])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(sent.value, switch)
        for batch in small_batches(batches, "text", BATCH_BYTES):
            found = [
                {
                    "lang_pred": lang,
                    "score": score,
                    "spans": [dict(zip(("start", "end", "lang"), s)) for s in spans],
                }
                for lang, score, spans in labeller.label(batch.column(1).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, arrow)], names=["row", "label"]
            )

    return rows.mapInArrow(run, schema)


def fold_of(id_col: str, folds: int) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 4,
    held_out: int = 2,
    sample: int = SAMPLE,
    switch: float = SWITCH,
) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score, spans``, with a model fitted on
    the documents that are not held out."""
    out = F.coalesce(fold_of(id_col, folds) == held_out, F.lit(False))
    model = fit(docs, ~out, id_col, text_col, lang_col, sample)
    kept = F.struct(F.col(id_col).alias("doc_id"), out.alias("held_out"))
    rows = label(docs, model, kept, text_col, switch)
    return rows.select(
        "row.doc_id",
        "row.held_out",
        "label.lang_pred",
        "label.score",
        "label.spans",
    )
