"""Statistics of whole documents, computed by numpy over Arrow batches.

Counts come from one byte histogram per document, word and line hashes, so no
Python code runs per word. All values are finite; an empty or null text has
zero for every statistic.
"""

from __future__ import annotations

import numpy as np

from .textarrays import SpanHash, words

#: Bytes that end or join sentences in ordinary prose.
_PLAIN = b".,;:'\"()-?"
_SYMBOLS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and b not in _PLAIN)
_NEWLINE = np.ones(256, bool)
_NEWLINE[:] = False
_NEWLINE[10] = True

FEATURES = (
    "log_bytes", "log_words", "mean_word", "sd_word", "long_words", "upper", "digit", "symbol", "top_symbol",
    "plain", "space", "newline", "non_ascii", "byte_entropy", "distinct_words", "top_word", "repeated_next",
    "distinct_pairs", "symbol_ended", "upper_words", "lines", "distinct_lines", "mean_line", "short_lines",
    "distinct_in_lines",
)


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _per_row(row: np.ndarray, n: int, weights=None) -> np.ndarray:
    return np.bincount(row, weights, n).astype(float)


def _runs(row: np.ndarray, value: np.ndarray, n: int):
    """Distinct values and the count of the commonest value, per row."""
    if len(row) == 0:
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((value, row))
    r, v = row[order], value[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (v[1:] != v[:-1])
    at = np.flatnonzero(new)
    length = np.diff(np.append(at, len(r)))
    top = np.zeros(n)
    np.maximum.at(top, r[at], length)
    return _per_row(r[at], n), top


def document_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``len(offsets) - 1`` rows of ``FEATURES``."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    per_byte = np.repeat(np.arange(n) * 256, np.diff(offsets)) + data
    histogram = np.bincount(per_byte, minlength=256 * n).reshape(n, 256).astype(float)
    upper = histogram[:, 65:91].sum(1)
    letters = upper + histogram[:, 97:123].sum(1) + histogram[:, 128:].sum(1)
    symbols = histogram[:, list(_SYMBOLS)]
    share = histogram / np.maximum(size, 1)[:, None]
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(1)

    start, end, row = words(data, offsets)
    span = SpanHash(data)
    h = span(start, end)
    length = (end - start).astype(float)
    n_words = _per_row(row, n)
    mean = _share(_per_row(row, n, length), n_words)
    variance = np.maximum(_share(_per_row(row, n, length * length), n_words) - mean * mean, 0)
    next_same_row = row[1:] == row[:-1]
    distinct, top = _runs(row, h, n)
    pair = (h[1:] * np.uint64(3) + h[:-1])[next_same_row]
    pair_row = row[1:][next_same_row]
    distinct_pairs, _ = _runs(pair_row, pair, n)
    is_symbol = np.zeros(256, bool)
    is_symbol[list(_SYMBOLS)] = True
    is_upper = np.zeros(256, bool)
    is_upper[65:91] = True
    last, first = data[end - 1], data[start]
    second = data[np.minimum(start + 1, len(data) - 1)] if len(data) else first

    l_start, l_end, l_row = words(data, offsets, _NEWLINE)
    n_lines = _per_row(l_row, n)
    l_length = (l_end - l_start).astype(float)
    distinct_lines, _ = _runs(l_row, span(l_start, l_end), n)
    # distinct words of each line, summed: a line that repeats one word adds 1
    line_of_word = np.searchsorted(l_start, start, side="right") - 1
    in_lines, _ = _runs(line_of_word, h, len(l_start))
    distinct_in_lines = _per_row(l_row, n, in_lines)

    return np.column_stack([
        np.log1p(size), np.log1p(n_words), mean, np.sqrt(variance), _share(_per_row(row, n, length > 20), n_words),
        _share(upper, letters), _share(histogram[:, 48:58].sum(1), size), _share(symbols.sum(1), size),
        _share(symbols.max(1), size), _share(histogram[:, list(_PLAIN)].sum(1), size),
        _share(histogram[:, [9, 11, 12, 13, 32]].sum(1), size), _share(histogram[:, 10], size),
        _share(histogram[:, 128:].sum(1), size), entropy, _share(distinct, n_words), _share(top, n_words),
        _share(_per_row(pair_row, n, (h[1:] == h[:-1])[next_same_row]), n_words),
        _share(distinct_pairs, np.maximum(n_words - 1, 0)), _share(_per_row(row, n, is_symbol[last]), n_words),
        _share(_per_row(row, n, is_upper[first] & is_upper[second] & (length > 1)), n_words),
        np.log1p(n_lines), _share(distinct_lines, n_lines), _share(_per_row(l_row, n, l_length), n_lines),
        _share(_per_row(l_row, n, l_length < 30), n_lines), _share(distinct_in_lines, n_words),
    ])
