"""A block of texts as postings in arrays, and the cover densities of many queries of words over it."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Numbers held at a time when spans are looked for; a text with more is held whole.
HELD = 1 << 20


def rounded(x: np.ndarray, decimals: int) -> np.ndarray:
    """Numbers of at least 0 to these decimals, halves upwards, as SQL rounds."""
    by = 10.0**decimals
    y = x * by
    n = np.rint(y)
    return (n + (y - n == 0.5)) / by


class Postings:
    """Where the words of a vocabulary stand in texts, which are words with single blanks between them."""

    def __init__(self, texts: pa.Array, vocabulary: pa.Array):
        words = pc.split_pattern(pc.fill_null(texts, ""), " ")
        term = np.asarray(pc.fill_null(pc.index_in(words.flatten(), value_set=vocabulary), -1))
        at = np.flatnonzero(term >= 0).astype(np.int32)
        text = np.repeat(np.arange(len(texts), dtype=np.int32), np.asarray(pc.list_value_length(words)))[at]
        order = np.argsort(term[at], kind="stable")
        term, text, self.at = term[at][order], text[order], at[order]
        first = np.flatnonzero((np.diff(term, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0))
        self.text = text[first]  # of each entry, that is word and text, ordered by them
        self.first = np.append(first, len(term))  # where the places of each entry begin
        begin = np.searchsorted(term[first], np.arange(len(vocabulary) + 1))
        self.count = np.diff(begin)  # texts that hold each word
        self.begin = begin.tolist()

    def holding(self, words: Sequence[int], kind: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts that hold all the words, in their order, and the entries of words x texts, the rarest word first; of the kind of each text
        (a number) only those that are `asked` (a flag for each)."""
        words = sorted(words, key=self.count.__getitem__)
        lo, hi = self.begin[words[0]], self.begin[words[0] + 1]
        entries = [lo + np.flatnonzero(asked[kind[self.text[lo:hi]]])]
        found = self.text[entries[0]]
        for w in words[1:]:
            if not len(found):
                break
            own = self.text[self.begin[w] : self.begin[w + 1]]
            i = own.searchsorted(found)
            ok = own.take(i, mode="clip") == found
            if not ok.all():
                found, i, entries = found[ok], i[ok], [e[ok] for e in entries]
            entries.append(i + self.begin[w])
        return found, np.array(entries)

    def densities(self, words: Sequence[int], entry: np.ndarray) -> np.ndarray:
        """The cover density of each text of the entries, see `holding` and `retrieval.density`."""
        words = sorted(words, key=self.count.__getitem__)
        first = self.first[entry]
        times = self.first[entry + 1] - first
        out = np.empty(entry.shape[1])
        size = np.cumsum(times.min(axis=0)) * len(words)
        lo = 0
        while lo < len(out):
            hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + HELD, "right")))
            out[lo:hi] = self._spans(words, first[:, lo:hi], times[:, lo:hi])
            lo = hi
        return out

    def _spans(self, words: Sequence[int], first: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Densities of texts in which these words have these first entries and so many of them.

        Each shortest span holds a place of the text's least frequent word, and ends at the words' places next to it: spans are looked for at each
        such place, and belong to the first that they hold."""
        n_texts, most = first.shape[1], np.int32(np.iinfo(np.int32).max)
        least = times.argmin(axis=0)
        n = times[least, np.arange(n_texts)]
        text = np.repeat(np.arange(n_texts), n)
        at = self.at[np.repeat(first[least, np.arange(n_texts)] - np.cumsum(n) + n, n) + np.arange(len(text))]
        same = text[1:] == text[:-1]
        earlier, later = np.append(np.int32(-1), np.where(same, at[:-1], np.int32(-1))), np.append(np.where(same, at[1:], most), most)
        before, after = np.empty((len(words), len(at)), np.int32), np.empty((len(words), len(at)), np.int32)
        places = []
        for i, w in enumerate(words):
            base = self.first[self.begin[w]]
            own = self.at[base : self.first[self.begin[w + 1]]]
            k = own.searchsorted(at)
            lo = (first[i] - base)[text]
            after[i] = np.where(k < lo + times[i][text], own.take(k, mode="clip"), most)
            before[i] = np.where(after[i] == at, at, np.where(k > lo, own.take(k - 1, mode="clip"), -1))
            places.append(own)
        order = np.argsort(-before, axis=0)
        start, after = np.take_along_axis(before, order, axis=0), np.take_along_axis(after, order, axis=0)
        # A span from the i-th of the places before ends where the words after the i-th come next, and is a shortest one if a later start ends later.
        end = np.vstack([np.maximum.accumulate(after[::-1], axis=0)[::-1][1:], at[None]])
        ok = (start > earlier) & (end < np.vstack([later[None], end[:-1]]))
        row, column = np.nonzero(ok)
        l, r, text = start[row, column], end[row, column], text[column]
        order = np.argsort(r)
        l, r, text = l[order], r[order], text[order]
        of_words = np.zeros(len(l), np.int64)
        for own in places:
            of_words += own.searchsorted(r, "right") - own.searchsorted(l)
        return np.bincount(text, 1 / (2 + r - l - of_words), n_texts)
