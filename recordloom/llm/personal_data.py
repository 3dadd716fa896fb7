"""Personal data found by a semi-Markov conditional random field.

Every stretch of up to ``MOST_TOKENS`` tokens that has the shape of an entity is a candidate segment, described as a whole (how
many digits, do they pass a checksum, how are they grouped, what stands before and after). Each shape is searched for
once over the whole text, so the work grows with the shapes found. Dynamic programming over the ends of the
segments chooses segments and types together, so that neighbours compete for the same characters; a segment whose own
score cannot be above zero is in no best choice, and its surroundings are not looked at.

Weights start from stated beliefs and are fitted, by the likelihood of whole segmentations, to what strict patterns
find in a bounded sample of documents (``SAMPLE_DOCS``, those of lowest hash). The strict patterns' own spans are always
reported; the field adds those in other notations.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.texts import batches, stage

KINDS = ("email", "ip", "card", "phone")
MOST_TOKENS = 24
MARGIN = 40  # characters of context on either side
MOST_WINDOW = 2000  # characters of a window the fit sees; longer ones are several
SAMPLE_DOCS = 6000
SAMPLE_WINDOWS = 1500
EPOCHS, RATE, HOLD = 12, 0.3, 0.02


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    strict: bool = True


# --- strict patterns ------------------------------------------------------------------

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){12,}")  # a run is taken whole, so asking for 13 digits at once finds the same ones
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]|[\[(]at[\])]")


def luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def emails(text: str) -> Iterable[Span]:
    """The name before an ``@`` is found backwards from it, so a long run of letters is read once."""
    last = 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            yield Span("email", start, m.end())
            last = m.end()


def strict_spans(text: str) -> list[Span]:
    """What the patterns find: leftmost, without overlap within a kind; a match that fails its test is passed over."""
    out = list(emails(text)) if "@" in text else []
    for m in IP.finditer(text):
        if all(map(small, m[0].split("."))):
            out.append(Span("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = digits_of(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(Span("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(digits_of(m[0])) <= 15:
                out.append(Span("phone", *m.span()))
    return out


# --- candidate segments and their features --------------------------------------------

TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^\sA-Za-z0-9]|\s+")
WORDS_BEFORE = {
    "email": re.compile(r"(?i)\b(?:e-?mail|mail|contact|write)\W{0,12}(?:\w+\W+)?$"),
    "ip": re.compile(r"(?i)\b(?:ip|server|host|address|gateway)\W{0,12}(?:\w+\W+)?$"),
    "card": re.compile(r"(?i)\b(?:card|visa|mastercard|credit|payment|cc)\W{0,12}(?:\w+\W+)?$"),
    "phone": re.compile(r"(?i)\b(?:call|tel|phone|mobile|cell|fax|ring)\W{0,12}(?:\w+\W+)?$"),
}
SHAPES = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+(?:@| ?[\[(]at[\])] ?)[A-Za-z0-9-]+(?:(?:\.| ?[\[(]dot[\])] ?)[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]{1,3}(?:(?:\.|\[\.\])[0-9]{1,3}){3}"),
    "card": re.compile(r"[0-9](?:[\x20.-]?[0-9]){12,18}"),
    "phone": re.compile(r"(?:\+|00)?\(?[0-9](?:[\x20()./-]{0,2}[0-9]){6,14}"),
}
GROUPED_CARD = re.compile(r"[0-9]{4}([\x20.-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}")
LOCAL_PHONE = re.compile(r"(?:\+?1[\x20.-])?\(?[0-9]{3}\)?[\x20./-]{1,2}[0-9]{3}[\x20.-][0-9]{4}")
DATE = re.compile(r"[0-9]{4}[-./][0-9]{1,2}[-./][0-9]{1,2}|[0-9]{1,2}[-./][0-9]{1,2}[-./][0-9]{2,4}")

# Beliefs before any data, by feature; a segment is chosen when its sum is above zero.
PRIOR = {
    "email": -3.0, "email:strict": 6.0, "email:masked": 5.0, "email:tld": 1.5,
    "ip": -3.0, "ip:small": 5.0, "ip:masked": 1.0, "ip:longer": -6.0,
    "card": -4.0, "card:luhn": 6.0, "card:grouped": 2.0, "card:ragged": -3.0, "card:16": 0.5, "card:long": -3.0,
    "phone": -5.0, "phone:plus": 5.0, "phone:local": 6.5, "phone:digits": 1.0, "phone:few": -4.0,
    "phone:bare": -4.0, "phone:date": -6.0, "phone:luhn": -2.0, "phone:dots": -2.0,
    "left:glued": -5.0, "right:glued": -5.0, "cue": 3.0,
}


class Segment(NamedTuple):
    kind: str
    first: int
    last: int  # place after the end
    features: tuple[str, ...]


def own_features(kind: str, text: str) -> list[str]:
    """What a stretch shows by itself."""
    found = [kind]
    digits = digits_of(text)
    if kind == "email":
        found.append("email:strict" if "@" in text else "email:masked")
        if re.search(r"[A-Za-z]{2,}$", text):
            found.append("email:tld")
    elif kind == "ip":
        parts = re.split(r"\.|\[\.\]", text)
        if all(map(small, parts)):
            found.append("ip:small")
        if "[" in text:
            found.append("ip:masked")
    elif kind == "card":
        if luhn(digits):
            found.append("card:luhn")
        if not text.isdigit():
            found.append("card:grouped" if GROUPED_CARD.fullmatch(text) else "card:ragged")
        found.append("card:16" if len(digits) == 16 else "card:long" if len(digits) > 16 else "card:other")
    else:
        if text[0] == "+" or text.startswith("00"):
            found.append("phone:plus")
        if LOCAL_PHONE.fullmatch(text):
            found.append("phone:local")
        found.append("phone:digits" if 9 <= len(digits) <= 15 else "phone:few")
        if text.isdigit():
            found.append("phone:bare")
        if DATE.match(text):
            found.append("phone:date")
        if len(digits) >= 13 and luhn(digits):
            found.append("phone:luhn")
        if "." in text:
            found.append("phone:dots")
    return found


SURROUNDINGS = ("ip:longer", "left:glued", "right:glued", "cue")


def near_features(kind: str, before: str, after: str) -> list[str]:
    """What stands around it."""
    found = []
    if kind == "ip" and (re.match(r"\.[0-9]", after) or re.search(r"[0-9]\.$", before)):
        found.append("ip:longer")
    glue = before[-1:]
    if glue.isalnum() or glue in ("+", "@") or (kind != "email" and glue in (".", ",", "-") and before[-2:-1].isdigit()):
        found.append("left:glued")
    if after and (after[0].isalnum() or after[0] == "@" or (after[0] in ".,-" and after[1:2].isdigit())):
        found.append("right:glued")
    if WORDS_BEFORE[kind].search(before):
        found.append("cue")
    return found


def windows(text: str) -> Iterator[tuple[int, int]]:
    """Stretches around digits and ``@``; neighbouring ones are one, and long ones are cut at blanks."""
    for start, end in stretches_of_triggers(text):
        while end - start > MOST_WINDOW:
            cut = max(text.rfind(" ", start, start + MOST_WINDOW), text.rfind("\n", start, start + MOST_WINDOW)) + 1
            cut = cut if cut > start else start + MOST_WINDOW
            yield start, cut
            start = cut
        yield start, end


def stretches_of_triggers(text: str) -> Iterator[tuple[int, int]]:
    start = end = -1
    for m in TRIGGER.finditer(text):
        if start >= 0 and m.start() - MARGIN <= end:
            end = m.end() + MARGIN
            continue
        if start >= 0:
            yield start, min(end, len(text))
        start, end = max(0, m.start() - MARGIN), m.end() + MARGIN
    if start >= 0:
        yield start, min(end, len(text))


# Shapes where a number or an opening sign begins; the longest stretch at each place.
BEGINS = {
    "ip": re.compile(rf"(?<![0-9])(?=({SHAPES['ip'].pattern})(?![0-9]))"),
    "card": re.compile(rf"(?<![0-9])(?=({SHAPES['card'].pattern}))"),
    "phone": re.compile(rf"(?:(?<![0-9])(?=[0-9])|(?=[+(]))(?=({SHAPES['phone'].pattern}))"),
}
DIGIT = re.compile(r"[0-9]")
AT = re.compile(r"@| ?[\[(]at[\])] ?")
DOMAINS = re.compile(r"(?:@| ?[\[(]at[\])] ?)[A-Za-z0-9-]+(?:(?:\.| ?[\[(]dot[\])] ?)[A-Za-z0-9-]+)+")
LEAST_DIGITS = {"card": 13, "phone": 7}


def number_ends(kind: str, text: str, start: int, end: int) -> Iterator[int]:
    """Where entities of a kind that start here may end: after a digit that no other follows."""
    if kind == "ip":
        yield end
        return
    places = [m.end() for m in DIGIT.finditer(text, start, end)]
    for place in places[LEAST_DIGITS[kind] - 1 :]:
        if not "0" <= text[place : place + 1] <= "9" and (kind == "card" or SHAPES[kind].fullmatch(text, start, place)):
            yield place


def starts_before(text: str, at: int) -> Iterator[int]:
    """Where the name before an ``@`` may start: at each of the last tokens of what can be a name."""
    place = at
    for _ in range(MOST_TOKENS):
        if place == 0 or text[place - 1] not in LOCAL:
            return
        place -= 1
        letter = text[place].isalpha()
        if letter or text[place].isdigit():
            while place and text[place - 1] in LOCAL and text[place - 1].isalnum() and text[place - 1].isalpha() == letter:
                place -= 1
            yield place
        elif text[place] == "+":
            yield place


def stretches_of(kind: str, text: str) -> Iterator[tuple[str, int, int]]:
    for m in BEGINS[kind].finditer(text):
        for end in number_ends(kind, text, m.start(), m.end(1)):
            yield kind, m.start(), end


def email_stretches(text: str) -> Iterator[tuple[str, int, int]]:
    if "@" not in text and "at)" not in text and "at]" not in text:
        return
    for m in AT.finditer(text):
        tail = DOMAINS.match(text, m.start())
        if tail:
            ends = [t.end() for t in TOKEN.finditer(text, m.end(), tail.end()) if t[0][-1].isalnum()]
            ends = [end for end in ends[:MOST_TOKENS] if DOMAINS.fullmatch(text, m.start(), end)]
            for start in starts_before(text, m.start()):
                for end in ends:
                    yield "email", start, end


def stretches(text: str) -> Iterator[tuple[str, int, int]]:
    """Kind, start and end of every candidate: shaped like the kind, from the start of a token to the end of one."""
    for kind in BEGINS:
        yield from stretches_of(kind, text)
    yield from email_stretches(text)


CARD_RUN = re.compile(r"[0-9](?:[\x20.-]?[0-9]){12,}")
STRONG_PHONE = re.compile(rf"(?:(?<![0-9])(?=00)|(?=\+))(?=({SHAPES['phone'].pattern}))")
LOCAL_BEGINS = re.compile(rf"(?:(?<![0-9])(?=[0-9])|(?=[+(]))(?=({LOCAL_PHONE.pattern})(?![0-9]))")
CUES = {kind: re.compile(words.pattern.split(r"\W")[0]) for kind, words in WORDS_BEFORE.items()}


class Bounds:
    """The highest score a segment can reach, known before all of its features are."""

    def __init__(self, text: str, weights: dict[str, float]):
        self.text, self.weights = text, weights
        self.cues: dict[str, bool] = {}

    def near(self, kind: str) -> float:
        """The most that surroundings can add; a cue only where the text has such a word at all."""
        if kind not in self.cues:
            self.cues[kind] = CUES[kind].search(self.text) is not None
        names = SURROUNDINGS if self.cues[kind] else SURROUNDINGS[:-1]
        return sum(max(0.0, self.weights.get(name, 0.0)) for name in names)

    def reach(self, kind: str, has: tuple[str, ...] = (), may: tuple[str, ...] = ()) -> float:
        given = self.weights.get
        return (
            given(kind, 0.0) + sum(given(name, 0.0) for name in has) + sum(max(0.0, given(name, 0.0)) for name in may)
        ) + self.near(kind)


def card_stretches(text: str, all_digits: bool) -> Iterator[tuple[str, int, int]]:
    """Cards; unless all are wanted, only those that pass the checksum, which running sums tell for any stretch."""
    for run in CARD_RUN.finditer(text):
        places = [m.start() for m in DIGIT.finditer(text, *run.span())]
        plain = [int(text[place]) for place in places]
        twice = [2 * d - 9 if d > 4 else 2 * d for d in plain]
        # sums up to each digit with every second one doubled, by which of the two halves is
        sums = [[0], [0]]
        for at, (one, two) in enumerate(zip(plain, twice, strict=True)):
            sums[at % 2].append(sums[at % 2][-1] + two)
            sums[1 - at % 2].append(sums[1 - at % 2][-1] + one)
        # a token starts or ends where no digit is beside
        ends = [i + 1 == len(places) or places[i + 1] > place + 1 for i, place in enumerate(places)]
        for first in range(len(places) - 12):
            if first and not ends[first - 1]:
                continue
            for last in range(first + 12, min(first + 19, len(places))):
                if ends[last]:
                    column = sums[1 - last % 2]
                    if all_digits or (column[last + 1] - column[first]) % 10 == 0:
                        yield "card", places[first], places[last] + 1


def worthwhile(text: str, weights: dict[str, float]) -> Iterator[tuple[str, int, int]]:
    """The stretches that may be worth choosing; leaves out only what no surroundings can lift above zero."""
    bounds, shown = Bounds(text, weights), "0123456789"
    long_ip = bounds.reach("ip", ("ip:longer",), ("ip:small", "ip:masked"))
    for m in BEGINS["ip"].finditer(text):
        start, end = m.span(1)
        longer = (text[end : end + 1] == "." and text[end + 1 : end + 2] in shown and end + 1 < len(text)) or (
            start > 1 and text[start - 1] == "." and text[start - 2] in shown
        )
        if not longer or long_ip > 0:
            yield "ip", start, end
    unchecked = bounds.reach("card", (), ("card:grouped", "card:ragged", "card:16", "card:long", "card:other"))
    yield from card_stretches(text, unchecked > 0)
    names = ("phone:digits", "phone:few", "phone:bare", "phone:date", "phone:luhn", "phone:dots")
    if bounds.reach("phone", (), names) > 0:
        yield from stretches_of("phone", text)
    else:
        seen = set()
        for m in STRONG_PHONE.finditer(text):
            seen.update((m.start(), end) for end in number_ends("phone", text, m.start(), m.end(1)))
        for m in LOCAL_BEGINS.finditer(text):
            seen.update((m.start(), end) for end in number_ends("phone", text, m.start(), m.end(1)))
        yield from (("phone", *span) for span in sorted(seen))
    yield from email_stretches(text)


def candidates(text: str, weights: dict[str, float] | None = None) -> list[Segment]:
    """The candidate segments of a text; with weights, only those that may be worth choosing."""
    out = []
    bounds = None if weights is None else Bounds(text, weights)
    for kind, start, end in stretches(text) if weights is None else worthwhile(text, weights):
        piece = text[start:end]
        features = own_features(kind, piece)
        if bounds is not None and bounds.reach(kind, tuple(features[1:])) <= 0:
            continue
        if end - start > MOST_TOKENS and sum(1 for _ in TOKEN.finditer(piece)) > MOST_TOKENS:
            continue
        features += near_features(kind, text[max(0, start - MARGIN) : start], text[end : end + 4])
        out.append(Segment(kind, start, end, tuple(features)))
    return out


# --- the field ------------------------------------------------------------------------


def score(weights: dict[str, float], segment: Segment) -> float:
    return sum(weights.get(name, 0.0) for name in segment.features)


def best(segments: list[Segment], weights: dict[str, float]) -> list[Segment]:
    """The segmentation of highest score; what lies outside segments scores 0."""
    ending: dict[int, list[Segment]] = {}
    for segment in segments:
        ending.setdefault(segment.last, []).append(segment)
    ends = sorted(ending)
    top, back = [0.0], [None]  # up to each end, after the start of the text
    for end in ends:
        value, choice = top[-1], None
        for segment in ending[end]:
            gained = top[bisect_right(ends, segment.first)] + score(weights, segment)
            if gained > value:
                value, choice = gained, segment
        top.append(value)
        back.append(choice)
    out, at = [], len(ends)
    while at > 0:
        if back[at] is None:
            at -= 1
        else:
            out.append(back[at])
            at = bisect_right(ends, back[at].first)
    return out[::-1]


def log_sum(values: list[float]) -> float:
    high = max(values)
    return high + math.log(sum(math.exp(v - high) for v in values))


def expected(n: int, segments: list[Segment], weights: dict[str, float]) -> list[float]:
    """The probability of every segment over all segmentations."""
    values = [score(weights, s) for s in segments]
    ending, beginning = {}, {}
    for k, s in enumerate(segments):
        ending.setdefault(s.last, []).append(k)
        beginning.setdefault(s.first, []).append(k)
    forward, backward = [0.0] * (n + 1), [0.0] * (n + 1)
    for at in range(1, n + 1):
        forward[at] = log_sum([forward[at - 1], *[forward[segments[k].first] + values[k] for k in ending.get(at, ())]])
    for at in range(n - 1, -1, -1):
        backward[at] = log_sum([backward[at + 1], *[values[k] + backward[segments[k].last] for k in beginning.get(at, ())]])
    return [
        math.exp(min(0.0, forward[s.first] + v + backward[s.last] - forward[n])) for s, v in zip(segments, values, strict=True)
    ]


def example(text: str) -> tuple[int, list[Segment], list[float | None]] | None:
    """Segments of a window over as many places as they need, with what the strict patterns say of each.

    Where the beliefs alone choose a segment the patterns do not have, the patterns may be what is wrong: that segment and
    what overlaps it has no label. A window whose strict spans are no candidates teaches nothing.
    """
    segments = candidates(text)
    gold = {(s.kind, s.start, s.end) for s in strict_spans(text)}
    if not segments or not gold <= {s[:3] for s in segments}:
        return None
    doubt = [s for s in best(segments, PRIOR) if s[:3] not in gold]
    places = {place: i for i, place in enumerate(sorted({p for s in segments for p in s[1:3]}))}

    def label(s: Segment) -> float | None:
        if s[:3] in gold:
            return 1.0
        return None if any(s.first < d.last and d.first < s.last for d in doubt) else 0.0

    compact = [Segment(s.kind, places[s.first], places[s.last], s.features) for s in segments]
    return len(places), compact, [label(s) for s in segments]


def fit_windows(texts: list[str]) -> dict[str, float]:
    """Weights that make the strict spans' segmentations likely, held to the beliefs."""
    examples = [found for found in map(example, texts) if found is not None]
    weights = dict(PRIOR)
    for _ in range(EPOCHS):
        gradient: dict[str, float] = {}
        for n, segments, labels in examples:
            for s, p, label in zip(segments, expected(n, segments, weights), labels, strict=True):
                for name in s.features if label is not None else ():
                    gradient[name] = gradient.get(name, 0.0) + label - p
        for name, slope in gradient.items():
            prior = PRIOR.get(name, 0.0)
            held = HOLD * (weights.get(name, 0.0) - prior)
            weights[name] = weights.get(name, 0.0) + RATE * (slope / len(examples) - held)
    return weights


def field_spans(text: str, weights: dict[str, float]) -> list[Span]:
    return [Span(s.kind, s.first, s.last, False) for s in best(candidates(text, weights), weights)]


def all_spans(text: str, weights: dict[str, float]) -> list[Span]:
    """Strict spans and those of the field that touch none of them, by kind, then by start."""
    if not TRIGGER.search(text):
        return []
    strict = strict_spans(text)
    starts, ends = [], []  # of the characters the strict spans cover
    for start, end in sorted((s.start, s.end) for s in strict):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    added = [s for s in field_spans(text, weights) if bisect_left(starts, s.end) == bisect_right(ends, s.start)]
    return sorted(strict + added, key=lambda s: (KINDS.index(s.kind), s.start, s.end))


# --- on tables ------------------------------------------------------------------------


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict[str, float]:
    """Weights from a bounded sample of the documents; an empty table leaves the beliefs as they are."""
    ids = docs.select(F.col(f"`{id_col}`").alias("id")).where("id is not null").distinct()
    chosen = stage(ids.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS), "sample")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).join(chosen, "id")

    def run(part: pa.RecordBatch) -> dict:
        cut = [[t[a:b] for a, b in windows(t)] for t in (text or "" for text in part.column("text").to_pylist())]
        return {"id": part.column("id"), "windows": pa.array(cut, pa.list_(pa.string()))}

    found = batches(texts, {"id": "id", "text": "text"}, run, f"id {texts.schema['id'].dataType.simpleString()}, windows array<string>")
    cut = found.select("id", F.explode("windows").alias("window"))
    rows = cut.orderBy(F.xxhash64("id", "window"), "window").limit(SAMPLE_WINDOWS).collect()
    return fit_windows([row.window for row in rows])


def scan(
    docs: DataFrame, weights: dict[str, float], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, spans`` of every row; a span is ``kind, start, end, strict`` in code points, its end exclusive.

    ``strict`` tells what the patterns found from what the field added. Spans are ordered by kind (``email, ip, card,
    phone``), then by start. A NULL or empty text has none. An entity of the field has at most ``MOST_TOKENS`` tokens and
    lies within one line, as do names and domains of at most so many tokens; strict spans have no such bound.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("strict", pa.bool_())]))

    def run(part: pa.RecordBatch) -> dict:
        found = [all_spans(text or "", weights) for text in part.column("text").to_pylist()]
        return {"doc_id": part.column("doc_id"), "spans": pa.array([[s._asdict() for s in ss] for ss in found], kind)}

    schema = "doc_id {id}, spans array<struct<kind:string,start:int,end:int,strict:boolean>>"
    return batches(docs, {"doc_id": id_col, "text": text_col}, run, schema)
