"""How two tokenizers cut the same text: common ends, groups between them, and links counted over the corpus.

Both tokenizers encode a space and the text. Every token gets the byte offset it ends at, so a text gives two rising lists of
ends. Their intersection is found by galloping: each end of the shorter list starts where an earlier one was found in the
longer list, doubles its step until it is past, and searches the last step by halves. The common ends cut both
token lists into groups; differences of their ranks say which tokens of one list a group of the other overlaps.

All texts of an Arrow batch gallop side by side in arrays. Tokenizing goes through a worker cache of the pieces between single
spaces: neither tokenizer has a token across such a place, which is checked when the vocabularies are loaded, and without
that whole texts are encoded. The cache is bounded and never changes results.

An id pair's count over the corpus is a sum per pair. The pairs counted most often, at most ``FREQUENT``, go to every task as two
arrays; links of other pairs are joined to the counts by pair. Nothing else is collected.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.texts import batches, stage

A_DEFINITION, B_MODEL = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPACE = "▁"  # how the second tokenizer writes a space
STRIDE = 16  # every so many ends search from the start of their text, the others from the one before
CACHED_IDS = 3_500_000  # token ids a worker remembers, with their pieces about 100 MB
TOGETHER = 500_000  # characters of texts aligned side by side; a longer text is alone
FREQUENT = 200_000  # pairs whose counts every task gets, 17 bytes each
FLUSH = 500_000  # pairs a task counts before it passes them on

# a single space between two other characters that are no blanks of any kind
CUT = re.compile(r"(?<=\S) (?=\S)")
LOOSE = re.compile(r"[^\S ] | [^\S ]")


def split(text: str) -> list[str]:
    """The text without the spaces it may be cut at."""
    if "  " in text or text[:1].isspace() or text[-1:].isspace() or LOOSE.search(text):
        return CUT.split(text)
    return text.split(" ")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(byte): byte for byte in shown}
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    return letters | {chr(256 + i): byte for i, byte in enumerate(hidden)}


@dataclass(frozen=True)
class Definitions:
    """Both tokenizers as they are stored; tasks load them from here."""

    a: str
    b: bytes

    @staticmethod
    def read(a_path: str | None = None, b_path: str | None = None) -> Definitions:
        a = Path(a_path or public_tokenizers.path(A_DEFINITION)).read_text(encoding="utf-8")
        return Definitions(a, Path(b_path or public_tokenizers.path(B_MODEL)).read_bytes())


class Tokenizers:
    """Both tokenizers with the bytes of every token; lives as long as its worker."""

    current: tuple[Definitions, Tokenizers] | None = None

    @classmethod
    def of(cls, definitions: Definitions) -> Tokenizers:
        if cls.current is None or cls.current[0] != definitions:
            cls.current = (definitions, cls(definitions))
        return cls.current[1]

    def __init__(self, definitions: Definitions):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        a = Tokenizer.from_str(definitions.a)
        a.encode_special_tokens = True  # strings of special tokens are plain text
        self.b = SentencePieceProcessor(model_proto=definitions.b)
        letters = byte_letters()
        self.a_bytes = [b""] * a.get_vocab_size()
        for token, i in a.get_vocab().items():
            plain = all(letter in letters for letter in token)
            self.a_bytes[i] = bytes(letters[c] for c in token) if plain else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode()
            for i, piece in enumerate(pieces)
        ]
        model = json.loads(definitions.a)
        steps = model.get("pre_tokenizer") or {}
        level = steps.get("type") == "ByteLevel" and not steps.get("add_prefix_space") and steps.get("use_regex", True)
        self.by_ranks = self.ranked(model["model"]) if level else None
        self.a = a if self.by_ranks is None else None  # one form of a vocabulary is enough memory
        self.cuts = level and not any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in pieces)
        self.a_length = np.array([len(token) for token in self.a_bytes], np.int64)
        self.b_length = np.array([len(token) for token in self.b_bytes], np.int64)
        # decimal ids with what follows them, so that groups are written out by one join
        self.written = [f"{i}{mark}" for n, marks in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;"))
                        for mark in marks for i in range(n)]
        self.cache = Cache()

    def ranked(self, model: dict):
        """The first tokenizer as ranks, which encode short texts faster; None unless ids rise with the order of merges."""
        import tiktoken

        merges = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        order = [model["vocab"][left + right] for left, right in merges]
        if model["type"] != "BPE" or any(b <= a for a, b in zip(order, order[1:])):
            return None
        single = {i for token, i in model["vocab"].items() if len(token) == 1}
        ranks = {self.a_bytes[i]: i for i in single.union(order)}
        return tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def pieces(self, text: str) -> list[str]:
        return split(text) if self.cuts else [text]

    def encode(self, pieces: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of a space and each piece."""
        whole = [f" {piece}" for piece in pieces]
        if self.by_ranks is not None:
            a = list(map(self.by_ranks.encode_ordinary, whole))
        else:
            a = [found.ids for found in self.a.encode_batch_fast(whole, add_special_tokens=False)]
        return a, self.b.encode(pieces, num_threads=1)

    def same_bytes(self, text: str, a: list[int], b: list[int]) -> bool:
        whole = f" {text}".encode()
        return b"".join(map(self.a_bytes.__getitem__, a)) == whole == b"".join(map(self.b_bytes.__getitem__, b))


class Growing:
    """An array that doubles its room when it is full."""

    def __init__(self, kind: type):
        self.room, self.size = np.zeros(1024, kind), 0

    def extend(self, more: np.ndarray) -> None:
        if self.size + len(more) > len(self.room):
            room = np.zeros(2 * (self.size + len(more)), self.room.dtype)
            room[: self.size] = self.room[: self.size]
            self.room = room
        self.room[self.size : self.size + len(more)] = more
        self.size += len(more)


class Cache:
    """Ids of pieces met before, one after the other in two growing arrays."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.slot: dict[str, int] = {}
        self.same = Growing(bool)
        self.ids = [Growing(np.int32), Growing(np.int32)]
        self.ends = [Growing(np.int64), Growing(np.int64)]
        for ends in self.ends:
            ends.extend(np.zeros(1, np.int64))

    def slots(self, pieces: list[str], tokenizers: Tokenizers) -> np.ndarray:
        """Places of the pieces; those not yet known are encoded."""
        new = list(set(pieces).difference(self.slot))
        if new and self.ids[0].size + self.ids[1].size > CACHED_IDS:
            self.clear()
            new = list(set(pieces))
        if new:
            self.add(new, tokenizers)
        return np.fromiter(map(self.slot.__getitem__, pieces), np.int64, len(pieces))

    def add(self, new: list[str], tokenizers: Tokenizers) -> None:
        found = tokenizers.encode(new)
        written = [f" {piece}".encode() for piece in new]
        all_written, sizes = b"".join(written), np.fromiter(map(len, written), np.int64, len(new))
        same = np.ones(len(new), bool)
        for side, (lists, table, lengths) in enumerate(
            zip(found, (tokenizers.a_bytes, tokenizers.b_bytes), (tokenizers.a_length, tokenizers.b_length), strict=True)
        ):
            counts = np.fromiter(map(len, lists), np.int64, len(lists))
            flat = list(chain.from_iterable(lists))
            ids = np.array(flat, np.int32)
            ends = np.cumsum(counts)
            bytes_ = np.concatenate([[0], np.cumsum(lengths[ids])])
            own = bytes_[ends] - bytes_[ends - counts]
            # equal as a whole and in every length is equal piece by piece
            if b"".join(map(table.__getitem__, flat)) != all_written or (own != sizes).any():
                same &= [b"".join(map(table.__getitem__, ids)) == w for ids, w in zip(lists, written, strict=True)]
            self.ends[side].extend(self.ids[side].size + ends)
            self.ids[side].extend(ids)
        self.same.extend(same)
        self.slot.update(zip(new, range(len(self.slot), len(self.slot) + len(new)), strict=True))

    def alike(self, slots: np.ndarray) -> np.ndarray:
        """Whether both tokenizers' tokens are the bytes of each piece."""
        return self.same.room[slots]

    def gather(self, side: int, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces in order, and how many each piece has."""
        ends = self.ends[side].room
        first, counts = ends[slots], ends[slots + 1] - ends[slots]
        before = np.cumsum(counts) - counts
        return self.ids[side].room[np.repeat(first - before, counts) + np.arange(int(counts.sum()))], counts


def gallop(values: np.ndarray, targets: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each target the first place in ``low .. high`` of rising ``values`` that is not less, ``high`` if none is.

    All targets go side by side: steps double from ``low`` until they are past, then the last step is halved.
    """
    low, end, step = low.copy(), high.copy(), 1
    active = np.arange(len(targets))
    while active.size:
        probe = low[active] + step - 1
        inside = probe < high[active]
        less = inside.copy()
        less[inside] = values[probe[inside]] < targets[active[inside]]
        past = active[~less]
        end[past] = np.minimum(probe[~less], high[past])
        active = active[less]
        low[active] = probe[less] + 1
        step *= 2
    active = np.flatnonzero(low < end)
    while active.size:
        middle = (low[active] + end[active]) >> 1
        less = values[middle] < targets[active]
        low[active[less]] = middle[less] + 1
        end[active[~less]] = middle[~less]
        active = active[low[active] < end[active]]
    return low


def search(long: np.ndarray, short: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """``gallop`` for rising targets: most start at the place found for one shortly before."""
    first = np.arange(0, len(short), STRIDE)
    heads = gallop(long, short[first], low[first], high[first])
    start = np.maximum(low, np.repeat(heads, STRIDE)[: len(short)])  # of another text where that one ended
    return gallop(long, short, np.minimum(start, high), high)


def common_ends(
    a_ends: np.ndarray, b_ends: np.ndarray, a_counts: np.ndarray, b_counts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of the ends both lists have, in either list; the shorter list of each text is searched for in the longer.

    Ends rise over all texts, which lie one behind the other; ``a_counts`` and ``b_counts`` say how many each text has.
    """
    a_stop, b_stop = np.cumsum(a_counts), np.cumsum(b_counts)
    found_a, found_b = [], []
    for a_drives in (True, False):
        texts = np.flatnonzero((a_counts <= b_counts) if a_drives else (a_counts > b_counts))
        lengths, stops = (a_counts, a_stop) if a_drives else (b_counts, b_stop)
        other, other_stops = (b_counts, b_stop) if a_drives else (a_counts, a_stop)
        n = lengths[texts]
        ranks = np.repeat(stops[texts] - np.cumsum(n), n) + np.arange(int(n.sum()))
        short, long = (a_ends, b_ends) if a_drives else (b_ends, a_ends)
        high = np.repeat(other_stops[texts], n)
        low = high - np.repeat(other[texts], n)
        place = search(long, short[ranks], low, high)
        hit = np.flatnonzero(place < high)
        hit = hit[long[place[hit]] == short[ranks[hit]]]
        found_a.append(ranks[hit] if a_drives else place[hit])
        found_b.append(place[hit] if a_drives else ranks[hit])
    return np.sort(np.concatenate(found_a)), np.sort(np.concatenate(found_b))


@dataclass
class Aligned:
    """Texts of one batch, their tokens one behind the other; texts without tokens have zero counts."""

    a: np.ndarray
    b: np.ndarray
    a_counts: np.ndarray
    b_counts: np.ndarray
    a_cuts: np.ndarray  # rank of the last token of each group
    b_cuts: np.ndarray

    @property
    def groups(self) -> np.ndarray:
        """Groups per text."""
        before = np.searchsorted(self.a_cuts, np.cumsum(self.a_counts))
        return np.diff(before, prepend=0)

    def written(self, table: list[str]) -> Iterator[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text."""
        sizes = [np.diff(cuts, prepend=-1) for cuts in (self.a_cuts, self.b_cuts)]
        a_rows = np.arange(len(self.a)) + np.repeat(self.b_cuts + 1 - sizes[1], sizes[0])
        b_rows = np.arange(len(self.b)) + np.repeat(self.a_cuts + 1, sizes[1])
        a_ids, b_ids = self.a.astype(np.int64), self.b.astype(np.int64)
        # the table holds A ids before a comma, A ids before a bar, then B ids before a comma and before a semicolon
        a_size, b_size = self.a_table, self.b_table
        a_ids[self.a_cuts] += a_size
        b_ids += 2 * a_size
        b_ids[self.b_cuts] += b_size
        order = np.empty(len(self.a) + len(self.b), np.int64)
        order[a_rows], order[b_rows] = a_ids, b_ids
        start = 0
        for stop in np.cumsum(self.a_counts + self.b_counts).tolist():
            yield "".join(map(table.__getitem__, order[start:stop].tolist()))[:-1]
            start = stop

    a_table: int = 0
    b_table: int = 0


def align_texts(texts: list[str], tokenizers: Tokenizers) -> Aligned:
    """Tokens and common ends of each text; none for empty texts and where the tokens are not the bytes of the text."""
    cache = tokenizers.cache
    lists = [tokenizers.pieces(text) if text else [] for text in texts]
    pieces = np.fromiter(map(len, lists), np.int64, len(lists))
    slots = cache.slots(list(chain.from_iterable(lists)), tokenizers)
    owner = np.repeat(np.arange(len(texts)), pieces)
    good = np.ones(len(texts), bool)
    for text in np.unique(owner[~cache.alike(slots)]).tolist():  # pieces differ; whether their whole does is looked up
        own = slots[owner == text]
        good[text] = tokenizers.same_bytes(texts[text], cache.gather(0, own)[0].tolist(), cache.gather(1, own)[0].tolist())
    kept = good[owner]
    slots, owner = slots[kept], owner[kept]
    a, a_each = cache.gather(0, slots)
    b, b_each = cache.gather(1, slots)
    a_counts = np.bincount(owner, a_each, len(texts)).astype(np.int64)
    b_counts = np.bincount(owner, b_each, len(texts)).astype(np.int64)
    a_ends, b_ends = np.cumsum(tokenizers.a_length[a]), np.cumsum(tokenizers.b_length[b])
    cuts = common_ends(a_ends, b_ends, a_counts, b_counts)
    return Aligned(a, b, a_counts, b_counts, *cuts, len(tokenizers.a_bytes), len(tokenizers.b_bytes))


def aligned_parts(part: pa.RecordBatch, tokenizers: Tokenizers) -> Iterator[Aligned]:
    """The texts of a batch, NULL as empty, a bounded number of characters at a time."""
    texts, size = [], 0
    for text in part.column("text"):
        text = text.as_py() or ""
        if texts and size + len(text) > TOGETHER:
            yield align_texts(texts, tokenizers)
            texts, size = [], 0
        texts.append(text)
        size += len(text)
    yield align_texts(texts, tokenizers)


def lists_of(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """Consecutive values as one list per text."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def alignments(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", definitions: Definitions | None = None
) -> DataFrame:
    """Per row its id, the ids ``a_ids`` and ``b_ids`` and, per group, the rank of its last token in either list.

    The groups are ``a_cuts`` and ``b_cuts``: group g holds the tokens after cut g - 1 up to cut g. NULL and empty texts, and
    texts that the joined bytes of either tokenizer's tokens differ from, have empty lists. Rows that repeat an id
    are rows of their own.
    """
    definitions = definitions or Definitions.read()

    def run(part: pa.RecordBatch) -> dict:
        parts = list(aligned_parts(part, Tokenizers.of(definitions)))
        a_counts, b_counts, groups = (np.concatenate([getattr(p, n) for p in parts]) for n in ("a_counts", "b_counts", "groups"))
        a_cuts = [p.a_cuts - np.repeat(np.cumsum(p.a_counts) - p.a_counts, p.groups) for p in parts]
        b_cuts = [p.b_cuts - np.repeat(np.cumsum(p.b_counts) - p.b_counts, p.groups) for p in parts]
        return {
            "id": part.column("id"),
            "a_ids": lists_of(np.concatenate([p.a for p in parts]), a_counts),
            "b_ids": lists_of(np.concatenate([p.b for p in parts]), b_counts),
            "a_cuts": lists_of(np.concatenate(a_cuts), groups),
            "b_cuts": lists_of(np.concatenate(b_cuts), groups),
        }

    schema = f"id {id_type(docs, id_col)}, a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>"
    return batches(docs, {"id": id_col, "text": text_col}, run, schema).withColumnRenamed("id", id_col)


def id_type(docs: DataFrame, id_col: str) -> str:
    return docs.schema[id_col].dataType.simpleString()


def links(docs: DataFrame, id_col: str, text_col: str, definitions: Definitions) -> DataFrame:
    """Per row its id, token and group counts, the digest of its groups, and the id pairs that end together."""

    def run(part: pa.RecordBatch) -> dict:
        tokenizers = Tokenizers.of(definitions)
        n_a, n_b, groups, digests, link_a, link_b = [], [], [], [], [], []
        for found in aligned_parts(part, tokenizers):
            n_a.append(found.a_counts)
            n_b.append(found.b_counts)
            groups.append(found.groups)
            link_a.append(found.a[found.a_cuts])
            link_b.append(found.b[found.b_cuts])
            written = found.written(tokenizers.written)
            digests += [hashlib.sha256(text.encode()).hexdigest() if text else "" for text in written]
        each = np.concatenate(groups)
        return {
            "id": part.column("id"),
            "n_a": np.concatenate(n_a),
            "n_b": np.concatenate(n_b),
            "groups_sha256": digests,
            "link_a": lists_of(np.concatenate(link_a), each),
            "link_b": lists_of(np.concatenate(link_b), each),
        }

    schema = (
        f"id {id_type(docs, id_col)}, n_a bigint, n_b bigint, groups_sha256 string, "
        "link_a array<int>, link_b array<int>"
    )
    return batches(docs, {"id": id_col, "text": text_col}, run, schema)


SHIFT = 32  # a pair is its A id above so many bits and its B id below


def pair_codes(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Pair of every link, and links per row."""
    a, b = part.column("link_a"), part.column("link_b")
    codes = (a.flatten().to_numpy().astype(np.int64) << SHIFT) | b.flatten().to_numpy()
    counts = a.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return codes, counts


def count_pairs(linked: DataFrame) -> DataFrame:
    """``pair, n, best``: links that hold each id pair, and whether no pair of the same B id has more."""

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for part in parts:
            codes, _ = pair_codes(part)
            more, n = np.unique(codes, return_counts=True)
            pairs, place = np.unique(np.concatenate([pairs, more]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([counts, n]), len(pairs)).astype(np.int64)
            if len(pairs) > FLUSH:
                yield pa.RecordBatch.from_pydict({"pair": pairs, "n": counts})
                pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield pa.RecordBatch.from_pydict({"pair": pairs, "n": counts})

    partial = linked.select("link_a", "link_b").mapInArrow(task, "pair bigint, n bigint")
    counted = stage(partial.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b_id = F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1)).alias("b")
    most = counted.groupBy(b_id).agg(F.max("n").alias("most"))
    # one row per id of the second vocabulary
    both = counted.withColumn("b", b_id).join(F.broadcast(most), "b")
    return stage(both.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair_counts")


def link_statistics(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", definitions: Definitions | None = None
) -> DataFrame:
    """Per row: its id, ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    A link is a pair of tokens whose byte ranges end together. The count of an id pair is how many links of the corpus hold it;
    ``n_best`` are the row's links whose pair no other pair of the same B id exceeds, ``count_sum`` adds up the counts
    of its links. ``groups_sha256`` is the digest of its groups written out. NULL and empty texts, and those whose tokens
    are not their bytes, have zeros and an empty digest. Rows that repeat an id, also NULL, are rows of their own.
    """
    spark = docs.sparkSession
    found = links(docs, id_col, text_col, definitions or Definitions.read())
    linked = stage(found.withColumn("row", F.monotonically_increasing_id()), "links")
    counted = count_pairs(linked)
    top = counted.orderBy(F.desc("n"), "pair").limit(FREQUENT).toArrow()  # FREQUENT rows at most
    order = np.argsort(pairs := top.column("pair").to_numpy())
    known = spark.sparkContext.broadcast(
        (pairs[order], top.column("n").to_numpy()[order], top.column("best").to_numpy()[order])
    )

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, n, best = known.value
        for part in parts:
            codes, counts = pair_codes(part)
            owner = np.repeat(np.arange(len(counts)), counts)
            place = np.searchsorted(frequent, codes)
            hit = place < len(frequent)
            hit[hit] = frequent[place[hit]] == codes[hit]
            sums, bests = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
            np.add.at(sums, owner[hit], n[place[hit]])
            np.add.at(bests, owner[hit], best[place[hit]].astype(np.int64))
            rare = np.bincount(owner[~hit], minlength=len(counts))
            offsets = np.concatenate([[0], np.cumsum(rare)]).astype(np.int32)
            yield pa.RecordBatch.from_pydict(
                {
                    "row": part.column("row"),
                    "n_groups": counts,
                    "n_best": bests,
                    "count_sum": sums,
                    "rare": pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes[~hit])),
                }
            )

    schema = "row bigint, n_groups bigint, n_best bigint, count_sum bigint, rare array<bigint>"
    looked = stage(linked.select("row", "link_a", "link_b").mapInArrow(task, schema), "looked_up")
    rest = looked.select("row", F.explode("rare").alias("pair")).join(counted, "pair")
    rest = rest.groupBy("row").agg(F.sum(F.col("best").cast("bigint")).alias("more_best"), F.sum("n").alias("more_sum"))
    sums = looked.drop("rare").join(rest, "row", "left")
    own = linked.select("row", "id", "n_a", "n_b", "groups_sha256")
    nothing = F.lit(0).cast("bigint")
    return own.join(sums, "row").select(
        F.col("id").alias(id_col),
        "n_a",
        "n_b",
        "n_groups",
        F.col("n_groups").alias("n_links"),
        (F.col("n_best") + F.coalesce("more_best", nothing)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", nothing)).alias("count_sum"),
        "groups_sha256",
    )
