"""Words of many texts as flat arrays of bytes, lengths and hashes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from maskwright.llm.common import LOWER_BYTES

# Bytes of a word: digits, letters and all that is not ASCII; or all but space and controls 9 to 13.
ALPHANUMERIC = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])
NOT_BLANK = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices ``values[start:start + length]``, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def hashes(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of words whose bytes stand one after the other."""
    if not len(lengths):
        return np.empty(0, np.uint64)
    begins = np.cumsum(lengths) - lengths
    weights = np.random.default_rng(13).integers(0, 1 << 64, int(lengths.max()), np.uint64)
    places = np.arange(len(data)) - np.repeat(begins, lengths)
    h = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * weights[places], begins)
    h ^= h >> np.uint64(29)
    return h * np.uint64(0x9E3779B97F4A7C15)


class Words:
    """The words of many texts: their bytes, lengths, hashes, and the text each stands in."""

    def __init__(
        self, texts: Sequence[bytes | None], inside: np.ndarray, folded: bytes | None = LOWER_BYTES
    ) -> None:
        joined = b" ".join(t or b"" for t in texts) + b" "
        data = np.frombuffer(joined.translate(folded), np.uint8)
        inside = inside[data]
        steps = np.diff(np.concatenate([[False], inside]).astype(np.int8))
        begins, ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
        self.data, self.lengths = data[inside], ends - begins
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.hash = hashes(self.data, self.lengths)
        last = np.cumsum([len(t or b"") + 1 for t in texts])
        self.text = np.searchsorted(last, begins, side="right")
        self.counts = np.bincount(self.text, minlength=len(texts))
        self.first = np.cumsum(self.counts) - self.counts

    def __getitem__(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and lengths of some words."""
        return gather(self.data, self.starts[some], self.lengths[some]), self.lengths[some]
