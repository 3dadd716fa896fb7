"""Secret scans with structural confirmation.

Patterns find assignments, access keys and long hexadecimal runs. Beyond those, encoded runs are reported only if
what they decode to is built like a secret: a private key whose nested lengths add up to its end, or a signed token whose
header names its algorithm. Random letters that merely look encoded do not pass.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left, bisect_right
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from recordloom.llm.texts import batches

# Kinds in order of listing: those the patterns find, then those confirmed by structure
PATTERN_KINDS = ("assign", "access", "hex")
KINDS = (*PATTERN_KINDS, "jwt", "pem", "key")

KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
# Runs are taken whole, so asking for the least length at once finds the same ones.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
LETTERS = re.compile(r"[A-Za-z0-9+/_-]+")
# Between two lines of one value: closing quote and joining sign, line breaks (also escaped ones), comment mark, opening quote
BREAK = (
    r"""[ \t]*+(?:["'][ \t]*+[+.,&\\]?[ \t]*+)?(?:(?:\r\n?|\n|(?:\\r)?\\n)[ \t]*+)++"""
    r"""(?:(?://|[#*;%>])++[ \t]++)?["']?"""
)
BREAKS = re.compile(BREAK)
ENCODED = re.compile(rf"{LETTERS.pattern}(?:{BREAK}{LETTERS.pattern})*+={{0,2}}")
LEAST_LETTERS = 48
# A key starts as a sequence (0x30 and any length) or with the words of its format.
KEY_START = re.compile(r"M[A-I]|b3BlbnNzaC1rZXktdjE")
HEX_BREAK = rf"(?:[ \t]*+:[ \t]*+(?:{BREAK})?|{BREAK}|[ \t])"
HEX_BREAKS = re.compile(HEX_BREAK)
HEX_RUN = re.compile(rf"[0-9A-Fa-f]+(?:{HEX_BREAK}[0-9A-Fa-f]+)*+")
HEX_START = re.compile(
    r"30(?=[:\s]{0,3}(?:[0-7][0-9A-Fa-f]|8[1-4]))|" + r"[:\s]?".join(re.findall("..", b"openssh-key-v1\0".hex())), re.I
)
LEAST_HEX = 72
JWT = re.compile(r"([A-Za-z0-9_-]*?eyJ[A-Za-z0-9_-]*)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
TOKEN_HEAD = re.compile(rb'\{\s*"[^"\\\x00-\x1f]{1,40}"\s*:')
PEM_LINE = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,40}?)PRIVATE KEY-----")
ARMOUR = "LS0tLS1CRUdJTi"  # base64 of an opening line
SSH_MAGIC = b"openssh-key-v1\0"
MOST_DEPTH = 12
MOST_ITEMS = 64  # values within one key, at all levels; real keys have fewer than 30
MOST_SSH_KEYS = 16


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def unbase64(text: str) -> bytes | None:
    """Either alphabet, padding optional; None if it is not base64."""
    bare = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(bare) % 4 == 1:
        return None
    try:
        return base64.b64decode(bare + "=" * (-len(bare) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


class Run:
    """Encoded letters over line breaks, and where in the text each stretch of them is."""

    def __init__(self, found: re.Match, breaks: re.Pattern):
        bare, start = found[0].rstrip("="), found.start()
        self.padding = len(found[0]) - len(bare)
        parts, at = [], 0
        self.places = [start]  # of the stretches in the text
        for gap in breaks.finditer(bare):
            parts.append(bare[at : gap.start()])
            at = gap.end()
            self.places.append(start + at)
        parts.append(bare[at:])
        self.end = found.end()
        self.letters = "".join(parts)
        self.ends = list(accumulate(map(len, parts)))  # of the stretches in the letters
        self.firsts = [0, *self.ends[:-1]]

    def letter(self, place: int) -> int:
        line = bisect_right(self.places, place) - 1
        return self.firsts[line] + place - self.places[line]

    def place(self, letter: int) -> int:
        line = bisect_right(self.firsts, letter) - 1
        return self.places[line] + letter - self.firsts[line]

    def place_after(self, letter: int) -> int:
        """Where in the text the letters before this one end; the last ones with their padding."""
        return self.end if letter == self.ends[-1] else self.place(letter - 1) + 1


class Base64:
    """The bytes that letters from a given one on stand for, decoded where they are looked at."""

    def __init__(self, letters: str, first: int):
        self.letters, self.first = letters, first
        self.size = (len(letters) - first) * 3 // 4

    def read(self, at: int, n: int) -> bytes:
        start = self.first + at // 3 * 4
        stop = self.first + -(-(at + n) // 3) * 4
        return (unbase64(self.letters[start : min(stop, len(self.letters))]) or b"")[at % 3 : at % 3 + n]

    def letters_to(self, size: int) -> int:
        return self.first + -(-4 * size // 3)


class Hex(Base64):
    """The same for hexadecimal digits."""

    def __init__(self, letters: str, first: int):
        self.letters, self.first = letters, first
        self.size = (len(letters) - first) // 2

    def read(self, at: int, n: int) -> bytes:
        start = self.first + 2 * at
        return bytes.fromhex(self.letters[start : start + 2 * min(n, self.size - at)])

    def letters_to(self, size: int) -> int:
        return self.first + 2 * size


def der_size(data: Base64) -> int | None:
    """How many bytes a private key in DER takes, by the lengths of all its values; None if it is none.

    Only the headers of values are decoded, ``MOST_ITEMS`` of them at most, so a look costs the same whatever length a header claims.
    """
    seen = 0

    def header(at: int, end: int) -> tuple[int, int, int] | None:
        """Tag and content of the value at ``at``, which must end by ``end``."""
        nonlocal seen
        seen += 1
        head = data.read(at, 6)
        if seen > MOST_ITEMS or len(head) < 2:
            return None
        start, length = at + 2, head[1]
        if length & 0x80:
            n = length & 0x7F
            if not 1 <= n <= 4 or len(head) < 2 + n:
                return None
            start, length = start + n, int.from_bytes(head[2 : 2 + n], "big")
        return (head[0], start, start + length) if start + length <= end else None

    def values(start: int, end: int, depth: int) -> list[tuple[int, int, int]] | None:
        """The values that fill a stretch, each filled itself if it is made of values."""
        found, at = [], start
        while at < end:
            item = header(at, end)
            if item is None or depth > MOST_DEPTH or (item[0] & 0x20 and values(item[1], item[2], depth + 1) is None):
                return None
            found.append(item)
            at = item[2]
        return found

    outer = header(0, data.size)
    if outer is None or outer[0] != 0x30:
        return None
    first = data.read(outer[1], 2)  # a version of one byte, or how the key is encrypted
    if first != b"\x02\x01" and first[:1] != b"\x30":
        return None
    parts = values(outer[1], outer[2], 1)
    if not parts:
        return None
    tags, sizes = [tag for tag, _, _ in parts], [end - start for _, start, end in parts]
    version = data.read(parts[0][1], 1)
    key = (
        (tags[:3] == [0x02, 0x30, 0x04] and sizes[0] == 1)  # version, algorithm, key
        # version and the eight numbers of an RSA key
        or (len(tags) >= 9 and set(tags[:9]) == {0x02} and sizes[0] == 1 and version in (b"\0", b"\1") and sizes[1] >= 32)
        # version and the number of a curve key
        or (tags[:2] == [0x02, 0x04] and sizes[0] == 1 and version == b"\1" and sizes[1] >= 16)
        or (tags == [0x30, 0x04] and sizes[1] >= 32)  # how it is encrypted, and the rest
    )
    return outer[2] if key else None


def ssh_size(data: Base64) -> int | None:
    """How many bytes an OpenSSH private key takes by its length-prefixed fields, ``MOST_SSH_KEYS`` keys at most."""
    if data.read(0, len(SSH_MAGIC)) != SSH_MAGIC:
        return None
    at = len(SSH_MAGIC)

    def number() -> int | None:
        head = data.read(at, 4)
        return int.from_bytes(head, "big") if len(head) == 4 else None

    for _ in range(3):  # cipher, how the key of it is made, and what that takes
        size = number()
        if size is None:
            return None
        at += 4 + size
    keys = number()
    if keys is None or not 1 <= keys <= MOST_SSH_KEYS:
        return None
    at += 4
    for _ in range(keys + 1):  # public keys, then all private ones together
        size = number()
        if size is None:
            return None
        at += 4 + size
    return at if at <= data.size else None


def key_size(data: Base64) -> int | None:
    return der_size(data) or ssh_size(data)


def is_key(data: bytes) -> bool:
    """Whether the bytes are a private key, to their end."""
    return key_size(Hex(data.hex(), 0)) == len(data)


def keys_in(text: str, starts: re.Pattern, runs: re.Pattern, breaks: re.Pattern, least: int, encoding: type[Base64]) -> list[Span]:
    """Keys without armour, from any letter of a run to where their own lengths end. What lies in a key is part of it."""
    out: list[Span] = []
    run, passed, after = None, 0, 0
    for found in starts.finditer(text):
        place = found.start()
        if place < passed:
            continue
        if run is None or place >= run.end:
            # the run may have begun before this start, where that was no start of a key
            run = Run(runs.match(text, place), breaks)
        if len(run.letters) < least:
            continue
        data = encoding(run.letters, run.letter(place))
        size = key_size(data)
        if size is not None and data.letters_to(size) - data.first >= least:
            after = data.letters_to(size)
            passed = run.place_after(after)
            out.append(Span("key", place, passed))
    return out


def encoded_keys(text: str) -> list[Span]:
    return keys_in(text, KEY_START, ENCODED, BREAKS, LEAST_LETTERS, Base64)


def hex_keys(text: str) -> list[Span]:
    return keys_in(text, HEX_START, HEX_RUN, HEX_BREAKS, LEAST_HEX, Hex)


def armoured_keys(text: str) -> list[Span]:
    """Bodies between a closing line and the opening line just before it that decode to a key; each is decoded once."""
    out, begin = [], None
    for line in PEM_LINE.finditer(text):
        if line[1] == "BEGIN":
            begin = line
        elif begin is not None:
            body = text[begin.end() : line.start()]
            if begin[2] == line[2] and is_key(unbase64("".join(BREAKS.sub(" ", body).split())) or b""):
                out.append(Span("pem", begin.start(), line.end()))
            begin = None
    return out


def wrapped_armour(text: str) -> list[Span]:
    """Armoured keys that are encoded once more, whole files in configuration for instance."""
    out: list[Span] = []
    run, decoded, passed = None, {}, 0
    place = text.find(ARMOUR)
    while place >= 0:
        if place >= passed:
            if run is None or place >= run.end:
                run, decoded = Run(ENCODED.match(text, place), BREAKS), {}
            first = run.letter(place)
            # letters that lie a multiple of four apart decode to the same bytes, so a run is decoded four times at most
            if first % 4 not in decoded:
                letters = run.letters[first:]
                data = unbase64(letters if len(letters) % 4 != 1 else letters[:-1]) or b""
                decoded[first % 4] = first, armoured_keys(data.decode("latin-1"))
            base, keys = decoded[first % 4]
            for key in keys:
                if base + key.start // 3 * 4 == first:
                    passed = run.place_after(min(base + -(-key.end * 4 // 3), len(run.letters)))
                    out.append(Span("pem", place, passed))
        place = text.find(ARMOUR, place + 1)
    return out


def json_object(text: str) -> dict | None:
    data = unbase64(text)
    try:
        found = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def signed_token(header: str, payload: str, signature: str) -> bool:
    head = json_object(header)
    if head is None or not isinstance(head.get("alg"), str) or json_object(payload) is None:
        return False
    return head["alg"].lower() == "none" or len(unbase64(signature) or b"") >= 16


def begins_object(header: str, start: int) -> bool:
    """Whether the letters from ``start`` on may be one JSON object, to their end; looks no further than the first thing that is wrong."""
    size = 64
    while True:
        data = unbase64(header[start : start + size]) or unbase64(header[start : start + size - 1]) or b""
        if not TOKEN_HEAD.match(data):
            return False
        try:
            json.JSONDecoder().raw_decode(data.decode("latin-1"))
        except RecursionError:
            return False
        except ValueError as error:
            cut = error.pos >= len(data) - 8 or error.msg.startswith("Unterminated string")
            if not cut or start + size >= len(header):
                return False
            size *= 4
        else:
            return start + size >= len(header)


def signed_tokens(text: str) -> list[Span]:
    """Tokens whose header may start at any letter; where three parts are no token, the second may start one."""
    out, at = [], 0
    while found := JWT.search(text, at):
        at = found.start(2)
        header = found[1]
        start = header.find("eyJ")
        while start >= 0:
            if begins_object(header, start) and signed_token(header[start:], found[2], found[3]):
                out.append(Span("jwt", found.start() + start, found.end()))
                at = found.end()
                break
            start = header.find("eyJ", start + 1)
    return out


def pattern_spans(text: str) -> list[Span]:
    """What the patterns find: leftmost, without overlap within a kind; a match that fails its test is passed over."""
    out = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        out += [Span("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [Span("access", *m.span()) for m in ACCESS.finditer(text)]
    out += [Span("hex", *m.span()) for m in HEX.finditer(text)]
    return out


def confirmed_spans(text: str) -> list[Span]:
    """What decodes to a key or a signed token. The time it takes grows with the text's length, not with what starts in it."""
    out = []
    if "eyJ" in text:
        out += signed_tokens(text)
    if "PRIVATE KEY-----" in text:
        out += armoured_keys(text)
    if ARMOUR in text:
        out += wrapped_armour(text)
    return out + encoded_keys(text) + hex_keys(text)


def listed(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda span: (span.start, KINDS.index(span.kind), span.end))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` of every row; a span is ``kind, start, end`` in code points, its end exclusive.

    Spans are ordered by start, then by kind. Patterns report ``assign``, ``access`` and ``hex``; structure adds ``jwt`` (signed
    tokens), ``pem`` (armoured private keys) and ``key`` (bare encoded ones). A NULL or empty text has no spans.
    """

    def run(part: pa.RecordBatch) -> dict:
        found = []
        for text in part.column("text").to_pylist():
            text = text or ""
            spans = listed(pattern_spans(text) + confirmed_spans(text))
            found.append([span._asdict() for span in spans])
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        return {"doc_id": part.column("doc_id"), "spans": pa.array(found, kind)}

    schema = "doc_id {id}, spans array<struct<kind:string,start:int,end:int>>"
    return batches(docs, {"doc_id": id_col, "text": text_col}, run, schema)
