"""Token counts with a two-tier lookup on the map side.

A text is cut at ASCII blanks into pre-tokens, which the tokenizer never joins across. Their lengths in tokens
come from a table of frequent pre-tokens that every task gets, then from the worker's cache of those met before; only what
neither has is encoded, once per worker and in bulk. Nothing is shuffled.

The table holds the pre-tokens counted most often in a bounded sample of the documents, those of lowest hash. They
are counted where they lie and summed by piece; the ``FREQUENT`` most frequent go to every worker as one broadcast, joined bytes
and an array of lengths. The sample decides what is fast, never what is counted.
"""

from __future__ import annotations

import os
import uuid
from collections import Counter as Counts
from collections.abc import Iterator
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.texts import batches, stage

VOCABULARY = "word_bpe_49k.json"
CACHED = 250_000  # pre-tokens a worker remembers, about 40 MB
LONG_KEY = 64  # bytes; longer ones are encoded each time they occur
SAMPLE_DOCS = 4096  # documents of lowest hash that pre-tokens are counted in
FREQUENT = 100_000  # pre-tokens in the table, at most 6.5 MB

SCHEMA = "doc_id {id}, n_bytes bigint, n_tokens bigint"


def load_tokenizer(definition: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_str(definition)


def lengths(tokenizer, pieces: list[bytes]) -> list[int]:
    texts = [piece.decode("utf-8") for piece in pieces]
    return [len(found) for found in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Table(NamedTuple):
    """Frequent pre-tokens and their lengths, as they travel: blanks join the pieces, which hold none."""

    pieces: bytes
    lengths: np.ndarray

    @staticmethod
    def of(pieces: list[bytes], definition: str) -> Table:
        found = lengths(load_tokenizer(definition), pieces) if pieces else []
        return Table(b" ".join(pieces), np.array(found, np.uint16))

    def lookup(self) -> dict[bytes, int]:
        return dict(zip(self.pieces.split(), self.lengths.tolist(), strict=True))


def frequent_pieces(docs: DataFrame, id_col: str, text_col: str) -> list[bytes]:
    """The pre-tokens that occur most often in the sample, in falling order; none for an empty table."""
    ids = docs.select(F.col(f"`{id_col}`").alias("id")).where("id is not null").distinct()
    chosen = stage(ids.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS), "sample")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).join(chosen, "id")

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            counts = Counts()
            for text in part.column(0).cast(pa.binary()).to_pylist():
                counts.update(piece for piece in (text or b"").split() if len(piece) <= LONG_KEY)
            yield pa.RecordBatch.from_pydict({"piece": pa.array(list(counts), pa.binary()), "n": list(counts.values())})

    partial = texts.select("text").mapInArrow(count, "piece binary, n bigint")
    summed = partial.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(FREQUENT)
    return [bytes(row.piece) for row in summed.collect()]  # FREQUENT pieces of LONG_KEY bytes at most


class Counter:
    """Counts tokens of texts; lives as long as its worker."""

    current: tuple[str, Counter] | None = None

    def __init__(self, definition: str, table: Table):
        self.tokenizer = load_tokenizer(definition)
        self.frequent = table.lookup()
        self.known = dict(self.frequent)

    @classmethod
    def of(cls, definition: str, name: str, sent: Broadcast) -> Counter:
        """The worker's counter for a table of this name."""
        if cls.current is None or cls.current[0] != name:
            cls.current = (name, cls(definition, sent.value))
        return cls.current[1]

    def count(self, text: bytes) -> int:
        pieces = text.split()  # bytes are cut at the six ASCII blanks only
        new = list(set(pieces).difference(self.known))
        if not new:
            return sum(map(self.known.__getitem__, pieces))
        if len(self.known) + len(new) > len(self.frequent) + CACHED:
            self.known = dict(self.frequent)
            new = list(set(pieces).difference(self.known))
        found = dict(zip(new, lengths(self.tokenizer, new), strict=True))
        once = {piece: n for piece, n in found.items() if len(piece) > LONG_KEY}
        for piece in once:
            del found[piece]
        self.known.update(found)
        if not once:
            return sum(map(self.known.__getitem__, pieces))
        return sum(once[p] if p in once else self.known[p] for p in pieces)


def token_counts(
    docs: DataFrame, definition_path: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row, as the tokenizer counts the whole text.

    No begin, end or other added token is counted; a special string inside a text counts as the tokenizer
    treats it by default. A NULL text is empty and has no tokens. Rows that repeat an id are counted each.
    """
    path = definition_path or public_tokenizers.path(VOCABULARY)
    definition = Path(path).read_text(encoding="utf-8")
    table = Table.of(frequent_pieces(docs, id_col, text_col), definition)
    name, sent = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(table)

    def run(part: pa.RecordBatch) -> dict:
        counter = Counter.of(definition, name, sent)
        texts = [text or b"" for text in part.column("text").cast(pa.binary()).to_pylist()]
        return {
            "doc_id": part.column("doc_id"),
            "n_bytes": pa.array([len(text) for text in texts], pa.int64()),
            "n_tokens": pa.array([counter.count(text) for text in texts], pa.int64()),
        }

    return batches(docs, {"doc_id": id_col, "text": text_col}, run, SCHEMA)
