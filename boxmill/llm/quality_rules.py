"""Line-first cleaning: rules on each line, then a verdict on what they leave.

A line fails if it looks like navigation (separators between short labels),
boilerplate (phrases of notices that make up a quarter of its words), markup or symbol
noise, shouting, a run of few words (of five words or more; for lines under 200 words
also too few distinct ones, which long prose has by nature), or if it has under four
words and no ending of a sentence. Failing and repeated lines are removed; a document
that loses too large a share of its text is rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases of notices that are not prose.
BOILERPLATE = (
    "lorem ipsum", "all rights reserved", "cookie policy", "cookie settings", "accept cookies", "uses cookies", "privacy policy",
    "terms of use", "terms of service", "terms and conditions", "enable javascript", "javascript is disabled", "click here",
    "sign up", "log in", "subscribe to our", "share this", "read more", "skip to content", "back to top", "powered by",
)
#: An ending that prose lines have, in many scripts.
ENDS = tuple(".!?…:;,\"'”’»)]。！？、؟।-")
SEPARATORS = frozenset({"|", "»", "›", "·", "•", ">", "/", "::", "-", "—"})
PHRASE_WORDS = tuple((f" {p} ".encode(), len(p.split())) for p in BOILERPLATE)
ANY_PHRASE = re.compile(b" (?:" + b"|".join(p.encode() for p in BOILERPLATE) + b") ")
#: ASCII letters in lower case, other ASCII signs as blanks; bytes of other letters stay.
PLAIN = bytes(ord(chr(c).lower()) if c < 128 and chr(c).isalpha() else 32 if c < 128 else c for c in range(256))
MARKS = b"#*$%&|<>"
NOT_LETTERS = bytes(c for c in range(128) if not chr(c).isalpha())
BLANKS = b" \t\n\v\f\r"
REPORT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_lines long, n_failed_lines long, removed_share double"


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which occurs twice or more."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    x = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    pairs = x[:-1] * len(ids) + x[1:]
    if len(ids) > 1_000_000:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(ids) + x[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= twice
    return int(covered.sum())


def failing_rule(line: str) -> str | None:
    """The rule that a line with words breaks, or None."""
    words = line.split()
    raw = line.encode("utf-8", "surrogatepass")
    n = max(1, len(words))
    marks = len(raw) - len(raw.translate(None, MARKS))
    if n > 1 and not SEPARATORS.isdisjoint(words) and sum(w in SEPARATORS for w in words) * 4 >= n:
        return "navigation"
    if marks > 1 and marks * 5 >= n:
        return "symbols"
    plain = b" " + b" ".join(raw.translate(PLAIN).split()) + b" "
    if ANY_PHRASE.search(plain) and sum(k for phrase, k in PHRASE_WORDS if phrase in plain) * 4 >= n:
        return "boilerplate"
    if len(raw.translate(None, NOT_LETTERS)) * 2 < len(raw) - n + 1:
        return "symbols"
    if n >= 5:
        if sum(map(str.isupper, words)) * 2 > n:
            return "shouting"
        # Long lines have fewer new words, about as the root of their length.
        distinct = len(set(words))
        if distinct * 3 < n and distinct * distinct < 9 * n or sum(map(str.__eq__, words[1:], words[:-1])) * 4 > n:
            return "repetition"
    if n < 4 and not line.rstrip().endswith(ENDS):
        return "punctuation"
    return None


def judge(text: str | None, max_removed: float, left: list[str] | None = None) -> tuple:
    """One REPORT row for a text; null counts as a text without words.

    left: takes the lines that are blank or neither fail nor repeat an earlier one.
    """
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    word_chars = len(text) - (len(raw) - len(raw.translate(None, BLANKS)))
    n_symbols = len(raw) - len(raw.translate(None, MARKS))
    repeats = repeated_words(words)
    base_failed = n < 50 or 100 * repeats > 50 * n
    seen: set[str] = set()
    dup = lines = failed = lost = total = 0
    for line in text.split("\n"):
        if not line.strip(" \t\v\f\r"):
            if left is not None:
                left.append(line)
            continue
        again = line in seen
        seen.add(line)
        lines += 1
        dup += again
        total += len(line)
        if again or failing_rule(line):
            failed += 1
            lost += len(line)
        elif left is not None:
            left.append(line)
    share = lost / total if total else 1.0
    return n, word_chars, n_symbols, dup, repeats, base_failed, not base_failed and share <= max_removed, lines, failed, share


def line_report(text: Column, max_removed: float = 0.5) -> Column:
    """A struct of counts and the verdict for a text column.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed (too few
    words, or mostly repeated windows), kept, n_lines, n_failed_lines, removed_share
    (share of the characters of lines with words). Null or blank text: zero counts, base_failed,
    not kept, removed_share 1. Whole texts are read.
    """

    @F.pandas_udf(REPORT)
    def report(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in REPORT.split(", ")]
        for texts in batches:
            yield pd.DataFrame([judge(t, max_removed) for t in texts], columns=names)

    return report(text.cast("string"))


def _cleaned(max_removed: float):
    """A pandas UDF of texts: kept, and the text that is left where a line goes (else null)."""

    @F.pandas_udf("kept boolean, changed string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            kept, changed = np.zeros(len(texts), bool), np.full(len(texts), None, object)
            for i, t in enumerate(texts):
                left: list[str] = []
                report = judge(t, max_removed, left)
                kept[i] = report[6]
                if kept[i] and report[8]:
                    changed[i] = "\n".join(left)
            yield pd.DataFrame({"kept": kept, "changed": pd.Series(changed, dtype=object)})

    return clean


def clean_text(text: Column, max_removed: float = 0.5) -> Column:
    """struct<kept:boolean, text:string>: the verdict of line_report and the cleaned text.

    The text of rejected rows is null, as is that of a null text.
    """
    text = text.cast("string")
    found = _cleaned(max_removed)(text)
    return F.struct(found["kept"].alias("kept"), F.when(found["kept"], F.coalesce(found["changed"], text)).alias("text"))


def keep_clean(docs: DataFrame, text_col: str = "text", length_col: str | None = None, max_removed: float = 0.5) -> DataFrame:
    """docs without the rejected rows, and their texts without the failing lines.

    All columns stay in order, whatever their names. length_col: a column that holds
    the number of the text's characters, which is set anew with its type.
    """
    names = docs.columns
    # Nondeterministic to the optimizer, or it would run the rules in the filter and again for the text.
    clean = _cleaned(max_removed).asNondeterministic()(F.col(text_col).cast("string"))
    taken = docs.select(F.struct("*").alias("row"), clean.alias("clean")).filter("clean.kept")
    text = F.coalesce("clean.changed", F.col("row").getField(text_col).cast("string"))
    new = {text_col: text}
    if length_col is not None:
        new[length_col] = F.length(text).cast(docs.schema[length_col].dataType)
    return taken.select(*[new.get(n, F.col("row").getField(n)).alias(n) for n in names])
