"""Byte-level BPE by a rank file, in two tiers.

A pre-token that is itself in the vocabulary is resolved by a minimal perfect hash: one displacement per bucket puts
every vocabulary entry into a slot of its own, as many slots as entries, and a comparison of the bytes rules out
strangers.  Any other pre-token is merged: its bytes form a linked list, a heap yields the
neighbours with the lowest rank, leftmost first, and each merge renews the two pairs around it, so that even a
pre-token of a whole long text takes O(n log n).

The hash is built once, on the driver, and travels with the tasks; workers keep a bounded cache of pre-tokens.

Defined results: a NULL text encodes like the empty one, to no ids; repeated rows encode alike; ids decode to the very
bytes of the text; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymart.llm.tables import extended

CACHE_ENTRIES = 400_000
_LOW = (1 << 32) - 1


@lru_cache(2)
def vocabulary(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


class PerfectHash:
    """A minimal perfect hash over byte strings: hash and displace.

    Buckets with several keys get the first displacement that sends all of them to free slots; buckets of
    one key are given the remaining slots directly, written as negative displacements.
    """

    def __init__(self, keys: list[bytes]) -> None:
        self.slots = len(keys)
        self.buckets = max(1, len(keys) // 2)
        members: dict[int, list[int]] = {}
        digests = [xxhash.xxh64_intdigest(key) for key in keys]
        for digest in digests:
            members.setdefault(digest % self.buckets, []).append(digest)
        self.shift = [0] * self.buckets
        free = [True] * self.slots
        for bucket, own in sorted(members.items(), key=lambda item: -len(item[1])):
            if len(own) == 1:
                continue
            shift = 0
            while True:
                at = [self._slot(digest, shift) for digest in own]
                if len(set(at)) == len(at) and all(free[k] for k in at):
                    break
                shift += 1
            self.shift[bucket] = shift
            for k in at:
                free[k] = False
        left = (k for k, is_free in enumerate(free) if is_free)
        for bucket, own in members.items():
            if len(own) == 1:
                self.shift[bucket] = -next(left) - 1

    def _slot(self, digest: int, shift: int) -> int:
        return ((digest >> 40) + shift * (((digest >> 20) & 0xFFFFF) | 1) + (shift * shift)) % self.slots

    def slot(self, key: bytes) -> int:
        digest = xxhash.xxh64_intdigest(key)
        shift = self.shift[digest % self.buckets]
        return -shift - 1 if shift < 0 else self._slot(digest, shift)


def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Ids of a piece by lowest-rank-first merges, with a heap over a linked list of its bytes."""
    n = len(piece)
    after = list(range(1, n + 1))
    before = list(range(-1, n))
    rank_of: list[int] = [-1] * (n + 1)  # of the pair that starts here; -1: no such token, or merged away
    heap = []
    for i in range(n - 1):
        rank = ranks.get(piece[i : i + 2], -1)
        if rank >= 0:
            rank_of[i] = rank
            heap.append(rank << 32 | i)
    heapify(heap)
    while heap:
        entry = heappop(heap)
        i = entry & _LOW
        if rank_of[i] != entry >> 32:
            continue
        j = after[i]
        k = after[j]
        after[i] = k
        before[k] = i
        rank_of[j] = -1
        rank = ranks.get(piece[i : after[k]], -1) if k < n else -1
        rank_of[i] = rank
        if rank >= 0:
            heappush(heap, rank << 32 | i)
        h = before[i]
        if h >= 0:
            rank = ranks.get(piece[h:k], -1)
            rank_of[h] = rank
            if rank >= 0:
                heappush(heap, rank << 32 | h)
    out = []
    i = 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return tuple(out)


def latin(pattern: str) -> re.Pattern | None:
    """The pattern for texts of code points below 256, for the faster standard matcher; None if it can't be said there.

    Character classes are spelt out from what the classes mean in the full pattern.
    """
    body = {
        kind: "".join(re.escape(chr(c)) for c in range(256) if regex.match(kind, chr(c))) for kind in (r"\s", r"\p{L}", r"\p{N}")
    }
    s, letter, number = body.values()
    own = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{s}{letter}{number}]").replace(r"\p{L}", f"[{letter}]").replace(r"\p{N}", f"[{number}]")
    own = own.replace(r"\s+", f"[{s}]+").replace(r"(?!\S)", f"(?![^{s}])")
    return None if re.search(r"\\[psS]", own.replace(re.escape("\\"), "")) else re.compile(own)


class Encoder(dict):
    """Pre-token -> ids; what is missing is looked up in the two tiers and kept.

    Two generations of ``CACHE_ENTRIES`` pre-tokens are kept, so that frequent ones stay.
    """

    def __init__(self, path: str, pattern: str, table: PerfectHash | None = None) -> None:
        self.ranks = vocabulary(path)
        self.table = table or PerfectHash(list(self.ranks))
        self.at: list[tuple[bytes, int] | None] = [None] * len(self.ranks)
        for token, rank in self.ranks.items():
            self.at[self.table.slot(token)] = (token, rank)
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.split = regex.compile(pattern).findall
        narrow = latin(pattern)
        self.split_latin = narrow.findall if narrow else self.split
        self.older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.older.get(word)
        if ids is None:
            piece = word.encode()
            token, rank = self.at[self.table.slot(piece)]
            ids = (rank,) if token == piece else merge(piece, self.ranks)
        if len(self) >= CACHE_ENTRIES:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        try:
            text.encode("latin-1")
            words = self.split_latin(text)
        except UnicodeEncodeError:
            words = self.split(text)
        return list(chain.from_iterable(map(self.__getitem__, words)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str, table: PerfectHash) -> Encoder:
    """One encoder per worker process and vocabulary, so that its cache outlives a task."""
    if (path, pattern) not in _encoders:
        _encoders.clear()
        _encoders[path, pattern] = Encoder(path, pattern, table)
    return _encoders[path, pattern]


def encoded(docs: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """``id``, ``n_tokens``, digests of the ids and of the decoded bytes, and the ids if ``with_ids``."""
    table = PerfectHash(list(vocabulary(path)))
    frame = docs.select(F.col(id), F.col(f"`{text}`").alias("_text"))
    added = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids
    schema = extended(frame.select(id).schema, added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern, table)
        for batch in batches:
            counts, digests, decoded, packed = [], [], [], []
            for value in batch.column("_text"):
                ids = own.encode(value.as_py())
                raw = np.array(ids, "<u4").tobytes()
                counts.append(len(ids))
                digests.append(hashlib.sha256(raw).hexdigest())
                decoded.append(hashlib.sha256(own.decode(ids)).hexdigest())
                if with_ids:
                    packed.append(raw)
            columns = [batch.column(id), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            if with_ids:
                columns.append(pa.array(packed, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return frame.mapInArrow(run, schema)


def decoded(frame: DataFrame, path: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``id`` and ``text`` of rows with little-endian 32-bit ids."""
    chosen = frame.select(F.col(id), F.col(ids).alias("_ids"))
    schema = extended(chosen.select(id).schema, "text string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = {rank: token for token, rank in vocabulary(path).items()}
        for batch in batches:
            texts = [
                None if raw is None else b"".join(map(bytes_of.__getitem__, np.frombuffer(raw, "<u4").tolist())).decode("utf-8", "replace")
                for raw in batch.column("_ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(id), pa.array(texts, pa.string())], [id, "text"])

    return chosen.mapInArrow(run, schema)
