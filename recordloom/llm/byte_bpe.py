"""Byte-level BPE, both ways.

A text is cut into pre-tokens by the tokenizer's pattern. A minimal perfect hash over the vocabulary resolves each that is
itself a token; the others are merged from bytes, the pair of lowest rank first, with a heap over a linked list, so
that even a run of many thousand letters costs little more than its length. Workers keep the ids of texts
between blanks they have met, up to a bound.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from heapq import heapify, heappop, heappush
from itertools import accumulate
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from recordloom.llm.texts import batches

RANKS = "byte_bpe_multi_50k.tiktoken"
CACHED = 350_000  # pre-tokens and stretches a worker remembers, each; about 150 MB when both are full
LONG_KEY = 64
PER_BUCKET = 4
MASK, SPREAD, STEP = (1 << 64) - 1, 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93

# a blank between white space, where texts cannot be cut at single blanks
TIGHT = regex.compile(r"\s\x20(?:\s|\Z)")


class PerfectHash:
    """Numbers a fixed set of byte strings without gaps; all else is recognised as foreign.

    Hash and displace: keys fall into small buckets; the largest first, each bucket gets a displacement that sends its
    keys to free slots. A bucket of one key stores its slot.
    """

    def __init__(self, keys: list[bytes]):
        self.keys = keys
        n = self.size = len(keys)
        self.buckets = max(1, n // PER_BUCKET)
        hashes = np.array([xxhash.xxh3_64_intdigest(key) for key in keys], np.uint64)
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        starts = np.concatenate(([0], np.cumsum(sizes)))
        displacement = np.zeros(self.buckets, np.int64)
        slots = np.full(n, -1, np.int64)
        tries = np.arange(1, 257, dtype=np.uint64)[:, None]
        for b in np.argsort(-sizes, kind="stable"):
            members = order[starts[b] : starts[b + 1]]
            if len(members) < 2:
                break
            first = np.uint64(0)
            while not displacement[b]:
                moves = tries + first
                at = (((hashes[members] + moves * np.uint64(STEP)) * np.uint64(SPREAD)) >> np.uint64(20)) % np.uint64(n)
                at = at.astype(np.int64)
                apart = np.sort(at, axis=1)
                good = (slots[at] < 0).all(axis=1) & (apart[:, 1:] != apart[:, :-1]).all(axis=1)
                if good.any():
                    pick = int(np.argmax(good))
                    displacement[b] = int(moves[pick, 0])
                    slots[at[pick]] = members
                first += np.uint64(len(tries))
        free = iter(np.flatnonzero(slots < 0).tolist())
        for b in np.flatnonzero(sizes == 1):
            slot = next(free)
            displacement[b] = -slot - 1
            slots[slot] = order[starts[b]]
        self.displacement = displacement.tolist()
        self.slots = slots.tolist()

    def find(self, key: bytes) -> int:
        """Number of the key, -1 if it is not one of the set."""
        if not self.size:
            return -1
        h = xxhash.xxh3_64_intdigest(key)
        move = self.displacement[h % self.buckets]
        if move > 0:
            slot = (((h + move * STEP) * SPREAD & MASK) >> 20) % self.size
        elif move < 0:
            slot = -move - 1
        else:
            return -1
        number = self.slots[slot]
        return number if self.keys[number] == key else -1


class Codec:
    """Encodes and decodes with one vocabulary; ``tokens`` are byte strings in order of rank."""

    current: tuple[bytes, Codec] | None = None

    def __init__(self, table: PerfectHash, ranks: list[int], pattern: str):
        self.table, self.ranks = table, ranks
        self.bytes_of = dict(zip(ranks, table.keys, strict=True))
        self.rank_of = dict(zip(table.keys, ranks, strict=True))  # of parts, while merging
        self.cut = regex.compile(pattern).findall
        self.pieces: dict[str, bytes] = {}
        self.stretches: dict[str, bytes] = {}

    @classmethod
    def of(cls, digest: bytes, table: PerfectHash, ranks: list[int], pattern: str) -> Codec:
        if cls.current is None or cls.current[0] != digest:
            cls.current = (digest, cls(table, ranks, pattern))
        return cls.current[1]

    def rank(self, piece: bytes) -> int:
        number = self.table.find(piece)
        return -1 if number < 0 else self.ranks[number]

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a pre-token that is no token itself: lowest rank first, leftmost among equals."""
        n, rank = len(piece), self.rank_of.get
        end = list(range(1, n + 1))  # where the part that starts here ends; 0 once it is part of another
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            _, left, stop = heappop(heap)
            middle = end[left]
            if not middle or middle >= n or end[middle] != stop:
                continue  # one of the two has changed since
            end[left], end[middle] = stop, 0
            if stop < n:
                before[stop] = left
                if (r := rank(piece[left : end[stop]])) is not None:
                    heappush(heap, (r, left, end[stop]))
            if (prior := before[left]) >= 0 and (r := rank(piece[prior:stop])) is not None:
                heappush(heap, (r, prior, stop))
        out, at = [], 0
        while at < n:
            out.append(rank(piece[at : end[at]]))
            at = end[at]
        return out

    def encode_piece(self, piece: str) -> bytes:
        raw = piece.encode("utf-8")
        whole = self.rank(raw)
        return array("i", [whole] if whole >= 0 else self.merge(raw)).tobytes()

    def encode_stretch(self, text: str) -> bytes:
        out, known = [], self.pieces
        for piece in self.cut(text):
            ids = known.get(piece)
            if ids is None:
                ids = self.encode_piece(piece)
                if len(piece) <= LONG_KEY:
                    if len(known) >= CACHED:
                        known.clear()
                    known[piece] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids of a text as 32-bit integers in a row.

        A blank after anything but white space always starts a pre-token, so the text can be cut there. Where a
        blank stands within longer white space, it is left whole.
        """
        if TIGHT.search(text):
            return self.encode_stretch(text)
        first, *rest = text.split(" ")
        known = self.stretches
        missing = set(rest).difference(known)
        once = {}
        if missing:
            if len(known) + len(missing) > CACHED:
                known.clear()
                missing = set(rest)
            for stretch in missing:
                (known if len(stretch) <= LONG_KEY else once)[stretch] = self.encode_stretch(" " + stretch)
        if once:
            ids = [once[s] if s in once else known[s] for s in rest]
        else:
            ids = map(known.__getitem__, rest)
        return self.encode_stretch(first) + b"".join(ids)

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of the ids; an id the vocabulary lacks is an error."""
        return b"".join(map(self.bytes_of.__getitem__, ids))


class Tokenizer:
    """A vocabulary file read once on the driver; what tasks need of it is bounded by its size."""

    def __init__(self, ranks_path: str | None = None, pattern: str = public_tokenizers.PATTERN):
        content = Path(ranks_path or public_tokenizers.path(RANKS)).read_bytes()
        pairs = [line.split() for line in content.splitlines() if line.strip()]
        self.ranks = [int(rank) for _, rank in pairs]
        self.table = PerfectHash([base64.b64decode(token) for token, _ in pairs])
        self.pattern = pattern
        self.digest = hashlib.sha256(content + pattern.encode()).digest()

    def codec(self) -> Codec:
        return Codec.of(self.digest, self.table, self.ranks, self.pattern)


def ids_array(packed: list[bytes]) -> pa.ListArray:
    offsets = pa.array([0, *accumulate(len(ids) // 4 for ids in packed)], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(packed), np.int32)))


def encode(
    docs: DataFrame, tokenizer: Tokenizer | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, ids`` of every row. A NULL text is empty and has no ids."""
    tokenizer = tokenizer or Tokenizer()

    def run(part: pa.RecordBatch) -> dict:
        codec = tokenizer.codec()
        packed = [codec.encode(text or "") for text in part.column("text").to_pylist()]
        return {"doc_id": part.column("doc_id"), "ids": ids_array(packed)}

    return batches(docs, {"doc_id": id_col, "text": text_col}, run, "doc_id {id}, ids array<int>")


def decode(
    rows: DataFrame, tokenizer: Tokenizer | None = None, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """``doc_id, decoded`` of every row, as bytes. NULL ids give no bytes; a NULL or unknown id in a list fails."""
    tokenizer = tokenizer or Tokenizer()

    def run(part: pa.RecordBatch) -> dict:
        codec = tokenizer.codec()
        texts = [codec.decode(ids or []) for ids in part.column("ids").to_pylist()]
        return {"doc_id": part.column("doc_id"), "decoded": pa.array(texts, pa.binary())}

    return batches(rows, {"doc_id": id_col, "ids": ids_col}, run, "doc_id {id}, decoded binary")


def round_trip(
    docs: DataFrame, tokenizer: Tokenizer | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, ids, decoded``: both ways in one pass over the texts, with one worker per task."""
    tokenizer = tokenizer or Tokenizer()

    def run(part: pa.RecordBatch) -> dict:
        codec = tokenizer.codec()
        packed = [codec.encode(text or "") for text in part.column("text").to_pylist()]
        texts = [codec.decode(np.frombuffer(ids, np.int32).tolist()) for ids in packed]
        return {"doc_id": part.column("doc_id"), "ids": ids_array(packed), "decoded": pa.array(texts, pa.binary())}

    schema = "doc_id {id}, ids array<int>, decoded binary"
    return batches(docs, {"doc_id": id_col, "text": text_col}, run, schema)


def checked(
    docs: DataFrame, tokenizer: Tokenizer | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, ids, round_trip``: ids, and whether decoding them gives the text back. NULL counts as empty."""
    tokenizer = tokenizer or Tokenizer()

    def run(part: pa.RecordBatch) -> dict:
        codec = tokenizer.codec()
        texts = [text or "" for text in part.column("text").to_pylist()]
        packed = [codec.encode(text) for text in texts]
        back = [codec.decode(np.frombuffer(ids, np.int32).tolist()) for ids in packed]
        same = [raw == text.encode("utf-8") for raw, text in zip(back, texts, strict=True)]
        return {"doc_id": part.column("doc_id"), "ids": ids_array(packed), "round_trip": pa.array(same)}

    schema = "doc_id {id}, ids array<int>, round_trip boolean"
    return batches(docs, {"doc_id": id_col, "text": text_col}, run, schema)
