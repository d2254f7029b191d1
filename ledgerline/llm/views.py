"""The two views of a document that the quality classifier learns from, as numbers of whole Arrow columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerline.llm.arrays import flat, hash64, hasher, mix

#: Beginnings of words that are terms besides the whole word, in bytes: forms of one word share them.
STEMS = (3, 4, 5, 6, 8)
_LETTER, _DIGIT, _MARK, _PAGE_MARK = (np.zeros(256, bool) for _ in range(4))
_LETTER[97:123] = _LETTER[128:] = True  # after lower-casing; every byte of a character beyond ASCII
_DIGIT[48:58] = True
_MARK[33:127] = True
_MARK &= ~_LETTER & ~_DIGIT
_MARK[65:91] = False
_PAGE_MARK[list(b"#*$%&|<>")] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of marked bytes, which end with their text, and the text of each."""
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begin, end = bounds[:-1][bounds[:-1] < len(inside)], bounds[1:][bounds[1:] > 0] - 1
    first[begin], last[end] = inside[begin], inside[end]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.repeat(np.arange(len(bounds) - 1), np.diff(np.searchsorted(starts, bounds)))


def _tag(tag: int) -> np.uint64:
    return np.uint64(tag * int(_ODD) % (1 << 64))


def _tagged(tag: int, value: np.ndarray) -> np.ndarray:
    return mix(value.astype(np.uint64) ^ _tag(tag))


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each code's number among the distinct ones, and where each of these is first; by hashing, without a sort."""
    at = pa.array(codes).dictionary_encode().indices.to_numpy()
    first = np.zeros(int(at.max(initial=-1)) + 1, np.int64)
    first[at[::-1]] = np.arange(len(at))[::-1]
    return at, first


def _parts(texts: pa.Array) -> tuple:
    """What the word terms are made of: the distinct words as terms of each kind (kinds, words), (word, text) of all words, (word, text)
    once a text, (term, text) of the runs of marks, and the fresh tenths: tenths of a text's words that are new in it, 11 for a
    text without words."""
    data, bounds = flat(pc.utf8_lower(texts.cast(pa.large_string())))
    n = len(bounds) - 1
    starts, ends, of = _runs(_LETTER[data], bounds)
    begins, stops, by = _runs(_MARK[data], bounds)
    hashed = hasher(data)
    at, first = _distinct(hashed(starts, ends))
    a, b = starts[first], ends[first]
    kinds = [hashed(a, cut) for cut in (b, *[np.minimum(b, a + k) for k in STEMS])]
    known = np.stack([mix(x ^ _tag(k)) for k, x in enumerate(kinds)])
    marks = mix(hashed(begins, np.minimum(stops, begins + 3)) ^ _tag(len(kinds)))
    width = max(1, len(first))
    once = pc.unique(pa.array(of * width + at)).to_numpy()
    word, text = once % width, once // width
    total, new = np.bincount(of, minlength=n), np.bincount(text, minlength=n)
    fresh = np.where(total > 0, 10 * new // np.maximum(total, 1), 11)
    return known, (at, of), (word, text), (marks, by), fresh


def word_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term, text) of all word terms, repeats included, and the fresh tenths of each text.

    Terms are 64-bit hashes of: whole lower-cased words, their beginnings, the first three marks of each run of marks, and the
    fresh tenths. Words are runs of letters; a null text has the last kind only.
    """
    known, (at, of), _, (marks, by), fresh = _parts(texts)
    terms = np.concatenate([known[:, at].ravel(), marks, _tagged(100, fresh)])
    return terms, np.concatenate([np.tile(of, len(known)), by, np.arange(len(fresh))]), fresh


def word_numbers(texts: pa.Array, vocabulary: Vocabulary) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """vocabulary.found() of all word terms, and the fresh tenths. Each distinct word is looked up once."""
    known, _, (word, text), (marks, by), fresh = _parts(texts)
    numbers = vocabulary.numbers(known.ravel()).reshape(known.shape)
    some = (numbers >= 0).any(0)[word]
    word, text = word[some], text[some]
    found = np.concatenate([numbers[:, word].ravel(), vocabulary.numbers(marks), vocabulary.numbers(_tagged(100, fresh))])
    return vocabulary.once(found, np.concatenate([np.tile(text, len(numbers)), by, np.arange(len(fresh))])), fresh


def page_terms(texts: pa.Array, fresh: np.ndarray, lang: pa.Array, source: pa.Array, n_chars: pa.Array, buckets: int) -> np.ndarray:
    """(texts, 8): the hashed metadata of each text: source, language, length, layout, all in steps; no words. Counts are doubles."""
    data, bounds = flat(texts)

    def count(of: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(of), bounds)).astype(float)

    def named(names: pa.Array) -> np.ndarray:
        body, at = flat(names)
        known = ~pc.is_null(names).to_numpy(zero_copy_only=False)
        return np.where(known, hash64(body, at[:-1], at[1:]), np.uint64(7))

    size = np.maximum(np.diff(bounds) - count((data & 0xC0) == 0x80), 1.0)  # characters
    spaces, lines = count(data == 32), count(data == 10) + 1
    marks, digits = count(_PAGE_MARK[data]), count(_DIGIT[data])
    stated = pc.fill_null(n_chars.cast(pa.float64()), 0.0).to_numpy(zero_copy_only=False)
    steps = [
        np.log2(np.maximum(stated, 1.0)),
        np.log2(size / lines) * 2,
        np.log2(1 + 1000 * marks / size) * 2,
        np.log2(1 + 1000 * digits / size),
        2 * size / (spaces + 1),
        fresh,
    ]
    values = [named(source), named(lang), *[(np.floor(np.minimum(s, 1e15)).astype(np.int64) + (1 << 40)).astype(np.uint64) for s in steps]]
    return np.stack([_tagged(200 + k, v) % np.uint64(buckets) for k, v in enumerate(values)], axis=1).astype(np.int64)


def distinct_pairs(terms: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each term of each text once."""
    order = np.lexsort((terms, texts))
    terms, texts = terms[order], texts[order]
    new = np.ones(len(terms), bool)
    new[1:] = (terms[1:] != terms[:-1]) | (texts[1:] != texts[:-1])
    return terms[new], texts[new]


class Vocabulary:
    """Numbers of the terms that are features."""

    def __init__(self, terms: np.ndarray):
        self.terms = np.sort(np.asarray(terms, np.uint64))
        self.near = np.zeros(1 << 20, bool)
        self.near[self.terms >> np.uint64(44)] = True

    def __len__(self) -> int:
        return len(self.terms)

    def numbers(self, terms: np.ndarray) -> np.ndarray:
        """The number of each term, -1 for those that are no features."""
        out = np.full(len(terms), -1, np.int64)
        if len(self.terms):
            at = np.flatnonzero(self.near[terms >> np.uint64(44)])
            number = np.minimum(np.searchsorted(self.terms, terms[at]), len(self.terms) - 1)
            out[at] = np.where(self.terms[number] == terms[at], number, -1)
        return out

    def once(self, numbers: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, text) of each feature of each text once, in order of the texts; -1 is no feature."""
        there = numbers >= 0
        width = max(1, len(self.terms))
        pairs = np.sort(texts[there] * width + numbers[there])
        pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)]]
        return pairs % width, pairs // width

    def found(self, terms: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, text) of each feature of each text once, in order of the texts."""
        return self.once(self.numbers(terms), texts)
