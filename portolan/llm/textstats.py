"""Per-row statistics of whole texts, from the shared word pass.

A `Stats` covers the rows of one chunk; every statistic is computed once, on
first use, for all of them.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np

from portolan.llm.words import _BYTE, _U, Words, combine, mix, span_hashes, words_of

SYMBOLS = b"#*$%&|<>"
#: Frequent short words of English, French, German and Spanish (fixed values).
STOP_WORDS = (
    "the of and to in a is that it for on was as with be by are this "
    "de la le les et des un une en du que pour qui dans "
    "der die das und zu den von mit ist im für "
    "el los las y del se por con no una para es al lo").split()


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_SYMBOL = _flags(SYMBOLS)
_UPPER = _flags(bytes(range(65, 91)))
_LOWER_CASE = _flags(bytes(range(97, 123)))
_DIGIT = _flags(b"0123456789")
_STOP = _flags(b".,;:")
_MARK = _flags(b"!?")
_PIPE = _flags(b"|")
_CODE_POINT = np.ones(256, dtype=bool)
_CODE_POINT[0x80:0xC0] = False
_HIGH = np.arange(256) >= 0x80


def _word_hashes(words: list[str]) -> np.ndarray:
    raw = " ".join(words).encode()
    return np.sort(words_of(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)])).hash)


_STOP_HASHES = _word_hashes(STOP_WORDS)


class Stats:
    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.data, self.offsets, self.rows = data, offsets, len(offsets) - 1

    @cached_property
    def words(self) -> Words:
        return words_of(self.data, self.offsets)

    @cached_property
    def n_words(self) -> np.ndarray:
        return np.diff(self.words.first)

    def bytes_in(self, flags: np.ndarray) -> np.ndarray:
        """Bytes of a class in each row."""
        if not len(self.data):
            return np.zeros(self.rows, dtype=np.int64)
        sums = np.zeros(len(self.data) + 1, dtype=np.int32)
        np.cumsum(flags[self.data], out=sums[1:], dtype=np.int32)
        return (sums[self.offsets[1:]] - sums[self.offsets[:-1]]).astype(np.int64)

    @cached_property
    def n_symbols(self) -> np.ndarray:
        return self.bytes_in(_SYMBOL)

    @cached_property
    def n_upper(self) -> np.ndarray:
        return self.bytes_in(_UPPER)

    @cached_property
    def n_marks(self) -> np.ndarray:
        return self.bytes_in(_MARK)

    @cached_property
    def word_lengths(self) -> np.ndarray:
        """Code points of each word."""
        sums = np.zeros(len(self.data) + 1, dtype=np.int32)
        np.cumsum(_CODE_POINT[self.data], out=sums[1:], dtype=np.int32)
        return (sums[self.words.end] - sums[self.words.start]).astype(np.int64)

    def per_row(self, values: np.ndarray) -> np.ndarray:
        """Sums of a per-word value."""
        sums = np.zeros(len(values) + 1, dtype=np.int64)
        np.cumsum(values, out=sums[1:])
        return sums[self.words.first[1:]] - sums[self.words.first[:-1]]

    @cached_property
    def word_chars(self) -> np.ndarray:
        return self.per_row(self.word_lengths)

    @cached_property
    def _lines(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, row-bound hash) of the ``\\n``-split lines that have a word."""
        breaks = np.flatnonzero(self.data == 10)
        start = np.sort(np.concatenate([self.offsets[:-1], breaks + 1]), kind="stable")
        row_of_break = np.searchsorted(self.offsets, breaks, side="right") - 1
        row = np.sort(np.concatenate([np.arange(self.rows), row_of_break]), kind="stable")
        end = np.append(start[1:], len(self.data))
        # a line ends before its newline; the last one of a row at the row's end
        last = np.append(row[1:] != row[:-1], True) if len(row) else np.zeros(0, dtype=bool)
        end = np.where(last, end, end - 1)
        has = np.searchsorted(self.words.start, end) > np.searchsorted(self.words.start, start)
        start, end, row = start[has], end[has], row[has]
        h = span_hashes(_BYTE[self.data], start, end)
        return row, mix(h ^ mix(row.astype(np.uint64) + _U(1)))

    @cached_property
    def n_lines(self) -> np.ndarray:
        return np.bincount(self._lines[0], minlength=self.rows)

    @cached_property
    def n_dup_lines(self) -> np.ndarray:
        """Lines with a word that equal an earlier line of their row."""
        row, h = self._lines
        _, at = np.unique(h, return_index=True)
        return self.n_lines - np.bincount(row[at], minlength=self.rows)

    @cached_property
    def n_repeat_words(self) -> np.ndarray:
        """Words inside 3-word windows that occur twice or more in their row."""
        w = self.words
        covered = np.zeros(len(w.hash), dtype=bool)
        if len(w.hash) >= 3:
            inside = np.flatnonzero(w.row[2:] == w.row[:-2])
            h = mix(combine(w.hash, 3)[inside] ^ mix(w.row[inside].astype(np.uint64) + _U(1)))
            order = np.argsort(h)
            s = h[order]
            twin = np.zeros(len(s), dtype=bool)
            twin[1:] = s[1:] == s[:-1]
            twin[:-1] |= twin[1:]
            at = inside[order[twin]]
            for k in range(3):
                covered[at + k] = True
        return self.per_row(covered)

    @cached_property
    def n_distinct_words(self) -> np.ndarray:
        w = self.words
        _, at = np.unique(mix(w.hash ^ mix(w.row.astype(np.uint64) + _U(1))), return_index=True)
        return np.bincount(w.row[at], minlength=self.rows)

    @cached_property
    def n_stop_words(self) -> np.ndarray:
        at = np.searchsorted(_STOP_HASHES, self.words.hash)
        return self.per_row(_STOP_HASHES[np.minimum(at, len(_STOP_HASHES) - 1)] == self.words.hash)

    @cached_property
    def n_stutters(self) -> np.ndarray:
        """Words that equal the word before them in their row."""
        w = self.words
        same = np.zeros(len(w.hash), dtype=bool)
        same[1:] = (w.hash[1:] == w.hash[:-1]) & (w.row[1:] == w.row[:-1])
        return self.per_row(same)

    def features(self) -> np.ndarray:
        """Feature matrix (rows x FEATURES) of quality models; finite for any text."""
        n = np.maximum(self.n_words, 1)
        size = np.maximum(np.diff(self.offsets), 1)
        letters = self.n_upper + self.bytes_in(_LOWER_CASE)
        first = self.data[self.words.start] if len(self.data) else self.data
        last = self.data[self.words.end - 1] if len(self.data) else self.data
        columns = {
            "log_words": np.log1p(self.n_words),
            "mean_word": self.word_chars / n,
            "symbols": self.n_symbols / n,
            "marks": self.n_marks / n,
            "stops": self.bytes_in(_STOP) / n,
            "upper": self.n_upper / np.maximum(letters, 1),
            "digits": self.bytes_in(_DIGIT) / size,
            "high": self.bytes_in(_HIGH) / size,
            "pipes": self.bytes_in(_PIPE) / n,
            "words_per_line": n / np.maximum(self.n_lines, 1),
            "dup_lines": self.n_dup_lines / np.maximum(self.n_lines, 1),
            "repeats": self.n_repeat_words / n,
            "distinct": self.n_distinct_words / n,
            "stop_words": self.n_stop_words / n,
            "short_words": self.per_row(self.word_lengths <= 2) / n,
            "long_words": self.per_row(self.word_lengths >= 12) / n,
            "capitals": self.per_row(_UPPER[first]) / n,
            "symbol_ends": self.per_row(_SYMBOL[last]) / n,
            "stutters": self.n_stutters / n,
        }
        return np.column_stack([columns[name] for name in FEATURES]).astype(np.float64)


FEATURES = ("log_words", "mean_word", "symbols", "marks", "stops", "upper", "digits", "high", "pipes",
            "words_per_line", "dup_lines", "repeats", "distinct", "stop_words", "short_words",
            "long_words", "capitals", "symbol_ends", "stutters")
