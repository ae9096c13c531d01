"""Rows that every operator has to take."""

from __future__ import annotations

LONG = " ".join(f"word{i % 700}x{i}" for i in range(9000))

#: NULLs in any column, empty and very long texts, ties and repeated rows, odd characters.
EDGES = [
    (1, None, "en", "a", 0),
    (2, "", "en", "a", 0),
    (3, " \n\t ", None, None, None),
    (4, "One two three four five.\nOne two three four five.\nSix seven eight nine ten eleven twelve.", "en", "a", 1),
    (4, "One two three four five.\nOne two three four five.\nSix seven eight nine ten eleven twelve.", "en", "a", 1),
    (5, "one TWO three", None, "b", 3),
    (6, "one two", "xx", "b", 3),
    (7, LONG, "en", "b", len(LONG)),
    (8, LONG + " tail", "en", None, None),
    (9, "Été naïve — 漢字 👍 ß ÀÉ…\r\nx\x0by <s> ▁mark '’s don't we'll  Á", "fr", "c", 9),
    (10, "12345 67 -- !!", "de", "c", 9),
    (None, "no id here, but words enough to be a text of more than ten words.", "en", "c", 9),
    (None, None, None, None, None),
    (-3, "Home | About | Help\nHome | About | Help\nA line that is long enough to stay in the text, surely.", "en", "c", 1),
    (11, "a " * 3000, "en", "d", 1),
    (12, "Released under the MIT License.\nRead it.", "en", "d", 1),
    (13, "this work is licensed under the GNU general public license version 3", None, "d", 1),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use for columns of their own.
CLASHES = ("part", "key", "fp", "node", "score", "role", "batch", "level", "least", "length", "offset", "gap", "label", "digest", "i", "own")
