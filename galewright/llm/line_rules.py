"""Line-first quality rules: judge every line, remove those that fail, reject texts that lose too much.

Lines are cut at newlines. A line with a word fails on the first of these rules:

* punctuation: too many of its words end in a symbol or a doubled mark, or in an exclamation or question
  mark, or are written in capitals; or it is a few words without a terminal mark; or it stands in a run
  of lines without terminal mark, each of few words;
* navigation: too many of its words are separators without a letter or digit, or paths; or it has no
  terminal mark and nearly all of its words begin with a capital, as menus do;
* boilerplate: it holds a boilerplate phrase, or equals an earlier line of the text.

A document is rejected when it is too short or repetitive as a whole (the base rules) or when the
failed lines hold more than a given share of its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewright.llm.frames import columns_as, map_arrow
from galewright.llm.textarrays import (
    BYTE_VALUES, Texts, Words, joined, lower_ascii, range_hashes, sums, text_slices, word_hashes, words,
)

# Phrases of page furniture, in lower case.
BOILERPLATE = (
    "all rights reserved",
    "by continuing to use this site",
    "click here to",
    "cookie policy",
    "enable javascript",
    "javascript is disabled",
    "lorem ipsum",
    "privacy policy",
    "sign up for our newsletter",
    "skip to content",
    "terms of service",
    "terms of use",
    "uses cookies",
)


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules; shares are of a line's or a text's words."""

    least_words: int = 10
    window: int = 5
    repeat_percent: int = 20
    marked_share: float = 0.3
    separator_share: float = 0.25
    unended_words: int = 3
    #: A line without terminal mark that ends no paragraph: up to so many words, in a run of so many such lines.
    short_words: int = 6
    short_run: int = 4
    shouted_share: float = 0.5
    title_share: float = 0.8
    title_words: int = 3
    lost_share: float = 0.5
    phrases: tuple[str, ...] = BOILERPLATE


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_SYMBOL = _table(b"#*$%&|<>")
_MARK = _table(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
_TERMINAL = _table(b".!?:;\"')]")  # and any multi-byte character's last byte, for closing quotes and full stops
_TERMINAL[0x80:] = True

_UPPER = _table(bytes(range(ord("A"), ord("Z") + 1)))
_ALNUM = _table(bytes([*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("0"), ord("9") + 1)]))
_ALNUM[0x80:] = True  # any multi-byte character; the signs below are told apart whole
# Signs between the parts of menus and breadcrumbs.
_SIGNS = ("\u00bb", "\u203a", "\u2192", "\u2022", "\u00b7", "\u2013", "\u2014", "\u25b8", "\u25ba", "\u2027", "\u00ab", "\u2190")


def _sign_hashes() -> np.ndarray:
    held = Texts(0, np.frombuffer(" ".join(_SIGNS).encode(), np.uint8), np.array([0, len(" ".join(_SIGNS).encode())]))
    return np.sort(word_hashes(held.data, words(held)))


def _counted(of: np.ndarray, found: Words) -> np.ndarray:
    """For every word, how many of its bytes are in the class."""
    total = np.zeros(len(of) + 1, dtype=np.int64)
    np.cumsum(of, out=total[1:])
    return total[found.end] - total[found.start]


def _in_run(marked: np.ndarray, text_of_line: np.ndarray, least: int) -> np.ndarray:
    """Is the line in a run of ``least`` or more marked lines of its text? Empty lines must be left out before."""
    n = len(marked)
    if not n:
        return marked
    new = np.ones(n, dtype=bool)
    new[1:] = (marked[1:] != marked[:-1]) | (text_of_line[1:] != text_of_line[:-1])
    run = np.cumsum(new) - 1
    return marked & (np.bincount(run)[run] >= least)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "punctuation_words", "navigation_words", "boilerplate_words")
SCHEMA = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES) + ", cleaned string"


def _again(keys: np.ndarray) -> np.ndarray:
    """Is the key equal to one before it?"""
    order = np.argsort(keys, kind="stable")
    out = np.zeros(len(keys), dtype=bool)
    ranked = keys[order]
    out[order[1:]] = ranked[1:] == ranked[:-1]
    return out


def _lines(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of all lines, and the first line of each text."""
    breaks = np.flatnonzero(texts.data == 0x0A)
    start = np.sort(np.concatenate((texts.offsets[:-1], breaks + 1)), kind="stable")
    end = np.sort(np.concatenate((texts.offsets[1:], breaks)), kind="stable")
    per_text = np.diff(np.searchsorted(breaks, texts.offsets)) + 1
    return start, end, np.concatenate(([0], np.cumsum(per_text)))


def _repeat_words(hashes: np.ndarray, found: Words, text_key: np.ndarray, window: int) -> np.ndarray:
    """Is the word in a window that its text holds twice or more?"""
    covered = np.zeros(len(hashes) + 1, dtype=np.int64)
    n = len(hashes) - window + 1
    if n > 0:
        key = hashes[:n]
        for k in range(1, window):
            key = joined(key, hashes[k : k + n])
        whole = np.flatnonzero(text_key[:n] == text_key[window - 1 :])
        key = joined(key[whole], text_key[whole])
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(len(key), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        at = whole[twice]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + window, -1)
    return np.cumsum(covered)[:-1] > 0


def measure(texts: Texts, rules: LineRules, clean: bool) -> dict[str, np.ndarray | list]:
    """The measures of every text, and its text without failed lines if ``clean``."""
    data, found = texts.data, words(texts)
    n_words = found.counts()
    start, end, line_first = _lines(texts)
    word_first = np.append(np.searchsorted(found.start, start), len(found.start))
    in_line = np.diff(word_first)
    some = in_line > 0
    text_of_line = np.repeat(np.arange(len(texts)), np.diff(line_first))

    lead = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    chars = lead[found.end] - lead[found.start]

    # Rules by line. The shares are of words.
    last = data[found.end - 1]
    second = data[np.maximum(found.end - 2, found.start)]
    marked = _SYMBOL[last] | (_MARK[last] & (second == last) & (found.end - found.start > 1) & (last != 0x2E))
    marks = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(_MARK[data], out=marks[1:])
    separator = marks[found.end] - marks[found.start] == found.end - found.start
    ended = np.zeros(len(start), dtype=bool)
    ended[some] = _TERMINAL[last[word_first[1:][some] - 1]]
    own = word_hashes(data, found)
    separator |= np.isin(own, _sign_hashes())
    path = (_counted(data == 0x2F, found) >= 2) & (_counted(data == 0x3A, found) == 0) & (_counted(_ALNUM[data], found) > 0)
    letters, upper = _counted(_ALNUM[data], found), _counted(_UPPER[data], found)
    shouted = (upper >= 2) & (upper == letters)
    exclaimed = (last == 0x21) | (last == 0x3F)
    some_words = in_line >= rules.title_words
    punctuation = some & (sums(marked & ~separator, word_first) > rules.marked_share * in_line)
    punctuation |= some_words & (sums(exclaimed & ~separator, word_first) > rules.marked_share * in_line)
    punctuation |= some_words & (sums(shouted, word_first) > rules.shouted_share * in_line)
    punctuation |= some & ~ended & (in_line < rules.unended_words)
    real = np.flatnonzero(some)
    short = ~ended[real] & (in_line[real] <= rules.short_words)
    punctuation[real] |= _in_run(short, text_of_line[real], rules.short_run)
    titled = sums(_UPPER[data[found.start]] if len(found.start) else np.zeros(0, bool), word_first)
    navigation = some & (sums(separator | path, word_first) > rules.separator_share * in_line)
    navigation |= some_words & ~ended & (titled >= rules.title_share * in_line)
    line_hash = range_hashes(BYTE_VALUES[data], start, end)
    repeated = np.zeros(len(start), dtype=bool)
    text_key = joined(np.arange(len(texts)).astype(np.uint64), np.uint64(1))
    repeated[some] = _again(joined(line_hash[some], text_key[text_of_line[some]]))
    boilerplate = repeated.copy()
    flat = lower_ascii(data).tobytes()
    for phrase in rules.phrases:
        at = flat.find(phrase.encode())
        while at >= 0:
            line = np.searchsorted(start, at, side="right") - 1
            boilerplate[line] |= at + len(phrase) <= end[line]
            at = flat.find(phrase.encode(), at + 1)
    navigation &= ~punctuation
    boilerplate &= some & ~punctuation & ~navigation

    per_text = lambda of_lines: sums(in_line * of_lines, line_first)
    repeat = _repeat_words(own, found, text_key[found.text_of()], rules.window)
    out = {
        "n_words": n_words,
        "word_chars": sums(chars, found.first),
        "n_symbols": sums(_SYMBOL[data], texts.offsets),
        "n_dup_lines": sums(repeated, line_first),
        "n_repeat_words": sums(repeat, found.first),
        "punctuation_words": per_text(punctuation),
        "navigation_words": per_text(navigation),
        "boilerplate_words": per_text(boilerplate),
        "cleaned": [None] * len(texts),
    }
    if clean:
        good = ~(punctuation | navigation | boilerplate)
        raw = data.tobytes()
        out["cleaned"] = [
            b"\n".join(raw[start[k] : end[k]] for k in range(a, b) if good[k]).decode() for a, b in zip(line_first[:-1], line_first[1:])
        ]
    return out


def judge_lines(docs: DataFrame, rules: LineRules = LineRules(), clean: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Measures, verdict and, if ``clean``, the text without failed lines, for every row.

    Columns: doc_id; n_words; word_chars; n_symbols; n_dup_lines; n_repeat_words; the words lost to
    each rule (``punctuation_words``, ``navigation_words``, ``boilerplate_words``); base_failed; kept;
    and cleaned. Whole texts count; a NULL text has no words, so it fails the base rules like an empty
    one, and its cleaned text is empty. Repeated rows are judged alike. Only the two named columns are
    read. One narrow pass; lines and windows are compared by 64-bit hashes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for texts in text_slices(batch.column("text")):
                out = measure(texts, rules, clean)
                columns = [pa.array(out[m], pa.int64()) for m in MEASURES]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(texts.row, len(texts)), *columns, pa.array(out["cleaned"], pa.string())],
                    names=["doc_id", *MEASURES, "cleaned"],
                )

    named = columns_as(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    found = map_arrow(named, run, SCHEMA)
    failed = (F.col("n_words") < rules.least_words) | (100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words"))
    lost = F.col("punctuation_words") + F.col("navigation_words") + F.col("boilerplate_words")
    found = found.withColumn("base_failed", failed)
    found = found.withColumn("kept", ~F.col("base_failed") & (lost <= rules.lost_share * F.col("n_words")))
    return found if clean else found.drop("cleaned")
