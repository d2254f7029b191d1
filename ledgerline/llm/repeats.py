"""Quality rules from word statistics and from repeated substrings found in a suffix array."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.arrays import SPACE, flat, hash64, mapped, of_windows, slices, words

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class RepeatRules:
    """min_words and max_repeat_words: the base rules. least: words in a repeated substring that counts. max_covered: percent of
    a text's words that repeated substrings may cover. max_longest: words that one repeat may have."""

    min_words: int = 50
    max_repeat_words: int = 50
    least: int = 8
    max_covered: int = 30
    max_longest: int = 200


def repeat_lengths(code: np.ndarray, of: np.ndarray, least: int) -> np.ndarray:
    """For each word position the longest match (in words, 0 if under `least`) with another position of the same text.

    A suffix array over the words of many texts at once, by prefix doubling: ranks by 1, 2, 4, ... words; a suffix whose rank
    is unique is in its final place and leaves. Neighbours in the array share the longest prefixes, whose length is read from
    the ranks of all levels, widest first. Ranks start with the text's number, so suffixes of different texts never meet.
    """
    n = len(code)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    doc = np.repeat(np.arange(len(of) - 1), np.diff(of))
    end = of[1:][doc]
    order = np.lexsort((code, doc))
    same = (doc[order][1:] == doc[order][:-1]) & (code[order][1:] == code[order][:-1])
    place, levels, width = np.arange(n), [], 1
    rank = np.zeros(n, np.int32)
    while True:
        head = np.concatenate(([True], ~same))
        group = np.maximum.accumulate(np.where(head, place, 0))
        rank = rank.copy()
        rank[order] = group
        levels.append((width, rank))
        stay = ~(head & np.concatenate((~same, [True])))
        order, group, place = order[stay], group[stay], place[stay]
        if not len(order):
            break
        follow = order + width
        second = np.where(follow < end[order], rank[np.minimum(follow, n - 1)], -1)
        by = np.lexsort((second, group))
        order, second = order[by], second[by]
        same = (group[1:] == group[:-1]) & (second[1:] == second[:-1])
        width *= 2
    array = np.empty(n, np.int64)
    array[rank] = np.arange(n)
    alike = [r for w, r in levels if w <= least][-1]  # neighbours with a long match agree on this level
    pair = np.flatnonzero(alike[array[1:]] == alike[array[:-1]])
    a, b = array[pair], array[pair + 1]
    match = np.zeros(len(a), np.int64)
    for width, rank in levels[::-1]:
        x, y = a + match, b + match
        open_pair = (x < end[a]) & (y < end[b])
        match += width * (open_pair & (rank[np.minimum(x, n - 1)] == rank[np.minimum(y, n - 1)]))
    match[match < least] = 0
    np.maximum.at(out, a, match)
    np.maximum.at(out, b, match)
    return out


def covered(length: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Marks the words inside the union of the spans [i, i + length[i]); spans never leave a text."""
    reach = np.zeros(len(length) + 1, np.int64)
    at = np.flatnonzero(length)
    np.add.at(reach, at, 1)
    np.add.at(reach, at + length[at], -1)
    return np.cumsum(reach)[:-1] > 0


def line_repeats(data: np.ndarray, bounds: np.ndarray, has_word: np.ndarray) -> np.ndarray:
    """Per text, the lines (split at \\n) with a word that equal an earlier line of it."""
    cut = np.unique(np.concatenate((np.flatnonzero(data == 10) + 1, bounds)))
    start, stop = cut[:-1], cut[1:] - (data[np.maximum(cut[1:] - 1, 0)] == 10) if len(data) else cut[1:]
    doc = np.searchsorted(bounds, start, side="right") - 1
    seen = np.concatenate(([0], np.cumsum(has_word)))
    real = np.flatnonzero(seen[stop] > seen[start])
    value = hash64(data, start[real], stop[real])
    order = np.lexsort((value, doc[real]))
    d, v = doc[real][order], value[order]
    again = (d[1:] == d[:-1]) & (v[1:] == v[:-1])
    return np.bincount(d[1:][again], minlength=len(bounds) - 1)


def measures(texts: pa.Array, rules: RepeatRules) -> dict[str, np.ndarray]:
    """All counts of whole texts; see quality_rules."""
    data, bounds = flat(texts)
    starts, ends, of = words(data, bounds)
    n, docs = np.diff(of), len(bounds) - 1
    code = hash64(data, starts, ends)

    def per_text(mark: np.ndarray, edges: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mark, dtype=np.int64)))
        return total[edges[1:]] - total[edges[:-1]]

    three = of_windows(code, 3)
    doc = np.repeat(np.arange(docs), n)
    whole = np.flatnonzero(np.arange(len(three)) + 3 <= of[1:][doc[: len(three)]])
    order = whole[np.lexsort((three[whole], doc[whole]))]
    same = (doc[order][1:] == doc[order][:-1]) & (three[order][1:] == three[order][:-1])
    twice = np.concatenate((order[1:][same], order[:-1][same]))
    windows = np.zeros(len(code), np.int64)
    windows[twice] = 3
    length = repeat_lengths(code, of, rules.least)
    longest = np.zeros(docs, np.int64)
    np.maximum.at(longest, doc, length)
    return {
        "n_words": n,
        "word_chars": per_text(~SPACE[data] & ((data & 0xC0) != 0x80), bounds),
        "n_symbols": per_text(_SYMBOL[data], bounds),
        "n_dup_lines": line_repeats(data, bounds, ~SPACE[data]),
        "n_repeat_words": per_text(covered(windows, of), of),
        "covered_words": per_text(covered(length, of), of),
        "longest_repeat": longest,
    }


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: RepeatRules = RepeatRules()) -> DataFrame:
    """One row per input row: key, the counts, base_failed, kept.

    covered_words are the words in the union of all maximal substrings of `least` words or more that occur twice in the text
    (the first occurrence included), longest_repeat the words of the longest. A text fails the base rules with too few words
    or too many words in repeated 3-word windows; it is kept if it passes these, its covered share and its longest repeat
    stay within the limits. A null or empty text has zero counts and fails. Whole texts are read, of any length; there is no
    shuffle, so a null or repeated key is a row like any other. Other columns are ignored.
    """
    kind = dict(docs.dtypes)[key]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]

    def run(part):
        return {"key": part.column("key"), **measures(part.column("text"), rules)}

    schema = f"key {kind}, " + ", ".join(f"{c} long" for c in names)
    found = mapped(docs, [F.col(key).alias("key"), F.col(text).cast("string").alias("text")], run, schema)
    failed = F.expr(f"n_words < {rules.min_words} or 100 * n_repeat_words > {rules.max_repeat_words} * n_words")
    fine = F.expr(f"100 * covered_words <= {rules.max_covered} * n_words and longest_repeat <= {rules.max_longest}")
    return found.withColumnRenamed("key", key).withColumn("base_failed", failed).withColumn("kept", ~failed & fine)


def passing(docs: DataFrame, text: str = "text", rules: RepeatRules = RepeatRules()) -> DataFrame:
    """The rows of docs that quality_rules keeps, with all their columns."""

    def run(batches):
        for part in slices(batches, text):
            m = measures(part.column(text).cast(pa.string()), rules)
            n = m["n_words"]
            keep = (n >= rules.min_words) & (100 * m["n_repeat_words"] <= rules.max_repeat_words * n)
            keep &= (100 * m["covered_words"] <= rules.max_covered * n) & (m["longest_repeat"] <= rules.max_longest)
            yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
