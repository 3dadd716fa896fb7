"""Quality rules, lines first.

Every line is judged on its own: does it end like a sentence, is it navigation, boilerplate, shouting, symbols, one word
over and over, or a repeat of an earlier line? Lines that fail are removed; a document is rejected when too little
of it is left, or when it fails as a whole by its length or by its repeated word windows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from recordloom.llm.texts import batches

LEAST_WORDS = 50
MOST_REPEATED = 0.5  # of the words, in windows that occur again
LEAST_KEPT = 0.5  # of the words, in lines that pass
WINDOW = 3
SYMBOLS = b"#*$%&|<>"
ENDINGS = tuple(".!?:;…。！？\"'”’»)")
SEPARATORS = frozenset((b"|", b">", b">>", b"/", b"-", b"\xc2\xbb", b"\xe2\x80\xa2", b"\xc2\xb7"))
SHORT_LINE = 10  # words; a longer line may end without a mark
BOILERPLATE = re.compile(
    rb"all rights reserved|terms of (?:use|service)|privacy policy|cookies?\b|enable javascript|licensed under|"
    rb"sign (?:in|up)\b|click here|subscribe to|powered by",
    re.I,
)
MOST_BOILERPLATE_WORDS = 25  # a longer line is prose that mentions the phrase

SCHEMA = (
    "doc_id {id}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, n_lines bigint, n_bad_lines bigint, kept_words bigint"
)


def code_points(data: bytes) -> int:
    return len(data) if data.isascii() else len(data.decode("utf-8"))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three that occurs twice or more."""
    if len(words) <= WINDOW:
        return 0
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    n = len(number)
    pairs = codes[:-2] * n + codes[1:-1]
    if n > 2_000_000:  # three codes would not fit in 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs * n + codes[2:]
    _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[which] > 1
    if not again.any():
        return 0
    covered = np.zeros(len(words), bool)
    for shift in range(WINDOW):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def bad_line(line: bytes, words: list[bytes]) -> bool:
    """Whether a line with words fails a rule on its own."""
    n = len(words)
    if n < SHORT_LINE and not line.decode("utf-8").rstrip().endswith(ENDINGS):
        return True
    if n >= 4 and 5 * sum(map(SEPARATORS.__contains__, words)) >= n:
        return True
    if n <= MOST_BOILERPLATE_WORDS and BOILERPLATE.search(line):
        return True
    if 12 * (len(line) - len(line.translate(None, SYMBOLS))) >= len(line):
        return True
    if n >= 6:
        if 2 * sum(map(bytes.__eq__, words, words[1:])) >= n:
            return True
        if line.isupper() and line.count(b"!") * 4 >= n:
            return True
    return False


def judge(text: bytes) -> tuple:
    """The columns of ``SCHEMA`` after the id."""
    words = text.split()  # bytes are cut at the six ASCII blanks only
    n_words = len(words)
    repeats = repeated_words(words)
    seen: set[bytes] = set()
    n_lines = n_bad = n_dup = kept_words = 0
    for line in text.split(b"\n"):
        parts = line.split()
        if not parts:
            continue
        n_lines += 1
        if line in seen:
            n_dup += 1
            n_bad += 1
            continue
        seen.add(line)
        if bad_line(line, parts):
            n_bad += 1
        else:
            kept_words += len(parts)
    failed = n_words < LEAST_WORDS or repeats > MOST_REPEATED * n_words
    kept = not failed and kept_words >= LEAST_KEPT * n_words
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    chars = code_points(b"".join(words))
    return n_words, chars, symbols, n_dup, repeats, failed, kept, n_lines, n_bad, kept_words


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and verdict of every row, as in ``SCHEMA``.

    Words are runs of anything but the six ASCII blanks; lines end at ``\\n`` and count if they hold a word. A NULL or
    empty text has no words, fails and is not kept. Rows that repeat an id are judged each.
    """
    names = [field.split()[0] for field in SCHEMA.split(", ")][1:]

    def run(part: pa.RecordBatch) -> dict:
        texts = part.column("text").cast(pa.binary()).to_pylist()
        found = [judge(text or b"") for text in texts]
        columns = zip(*found, strict=True)
        kinds = [pa.bool_() if name in ("base_failed", "kept") else pa.int64() for name in names]
        arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)]
        return {"doc_id": part.column("doc_id"), **dict(zip(names, arrays, strict=True))}

    return batches(docs, {"doc_id": id_col, "text": text_col}, run, SCHEMA)


def cleaned(text: bytes) -> bytes:
    """The lines that pass, in order; blank lines go too."""
    seen: set[bytes] = set()
    out = []
    for line in text.split(b"\n"):
        parts = line.split()
        if parts and line not in seen and not bad_line(line, parts):
            out.append(line)
        seen.add(line)
    return b"\n".join(out)


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` with the lines that pass; NULL stays NULL."""

    def run(part: pa.RecordBatch) -> dict:
        texts = part.column("text").cast(pa.binary()).to_pylist()
        clean = [None if text is None else cleaned(text).decode("utf-8") for text in texts]
        return {"doc_id": part.column("doc_id"), "text": pa.array(clean, pa.string())}

    return batches(docs, {"doc_id": id_col, "text": text_col}, run, "doc_id {id}, text string")
