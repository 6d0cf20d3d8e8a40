"""Features of the two views of the quality classifier, computed in numpy inside tasks."""

from __future__ import annotations

import zlib

import numpy as np

from newsloom.llm.common import ship

ship(__name__)

PAIRS = 768                                 # hashed pairs of neighbouring bytes
SHAPES = 10
TEXT_DIM = PAIRS + SHAPES
_PAIR_SLOT = ((np.arange(1 << 16, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(PAIRS)
_PAIR_SLOT = _PAIR_SLOT.astype(np.int64)


def text_features(text: str | None) -> np.ndarray:
    """Shares of byte pairs (square roots), then shares that describe the words; lines are left to the other view."""
    whole = text or ""
    raw = np.frombuffer(whole.encode("utf-8", "surrogatepass"), np.uint8)
    out = np.zeros(TEXT_DIM, np.float32)
    n = len(raw)
    if n == 0:
        return out
    if n > 1:
        counts = np.bincount(raw[:-1].astype(np.int32) << 8 | raw[1:], minlength=1 << 16)
        out[:PAIRS] = np.sqrt(np.bincount(_PAIR_SLOT, weights=counts, minlength=PAIRS) / (n - 1))
    counts = np.bincount(raw, minlength=256)
    words = whole.split()
    letters = sum(counts[97:123]) + sum(counts[65:91]) + sum(counts[128:])
    n_words = max(1, len(words))
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    threes = set(zip(words, words[1:], words[2:]))
    out[PAIRS:] = (
        sum(counts[65:91]) / n, sum(counts[48:58]) / n, letters / n, counts[33] / n_words,
        sum(counts[ord(c)] for c in "#*$%&|<>") / n_words, min(2.0, n / n_words / 8),
        len(set(words)) / n_words, repeats / n_words, 1 - len(threes) / max(1, len(words) - 2) if len(words) > 2 else 0,
        min(2.0, np.log1p(n_words) / 6),
    )
    return out


LANGS, SOURCES, LENGTHS, LINES, WIDTHS, CLOSED, ENDS = 32, 128, 24, 16, 16, 12, 6
META_PARTS = (LANGS, SOURCES, LENGTHS, LINES, WIDTHS, CLOSED, ENDS)
META_DIM = sum(META_PARTS)
_OFFSETS = np.concatenate(([0], np.cumsum(META_PARTS)[:-1])).astype(np.int16)


def meta_slots(lang: str | None, source: str | None, n_chars: float | None, text: str | None) -> np.ndarray:
    """One slot of each part: what the record says (language, source, length), then how its page is laid out (number of
    lines, their mean length, the share of them that a mark closes, what the last character is). Null is a value."""
    def hashed(value, n):
        return 0 if value is None else 1 + zlib.crc32(value.encode("utf-8", "surrogatepass")) % (n - 1)

    lines = [x for x in map(str.strip, (text or "").split("\n")) if x]
    closed = sum(x[-1] in ".!?" for x in lines)
    last = lines[-1][-1] if lines else ""
    return _OFFSETS + np.array((
        hashed(lang, LANGS), hashed(source, SOURCES),
        0 if n_chars is None else 1 + min(LENGTHS - 2, int(2 * np.log10(max(1, n_chars)))),
        min(LINES - 1, len(lines).bit_length()),
        min(WIDTHS - 1, (sum(map(len, lines)) // max(1, len(lines))).bit_length()),
        1 + 10 * closed // len(lines) if lines else 0,
        0 if not last else 1 if last.isalpha() else 2 if last.isdigit() else 3 if last == "." else 4 if last in "!?" else 5,
    ), np.int16)


def meta_matrix(slots: np.ndarray) -> np.ndarray:
    """Rows of zeros with a one in each of their slots."""
    out = np.zeros((len(slots), META_DIM), np.float32)
    out[np.arange(len(slots))[:, None], slots] = 1
    return out
