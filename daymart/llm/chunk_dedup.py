"""Substring de-duplication by content-defined chunks.

A gear hash rolls over the bytes of a text (a window of 16 bytes); a chunk ends after the white space where the hash is smallest
among the ``RADIUS`` places of white space on either side.  This rule, unlike a mask with a least size, has no memory: an
insertion shifts the borders within its neighbourhood only, and chunks consist of whole words.

Where white space does not part words, characters do.  In scripts written without it (Chinese, Japanese, Thai, Lao, Khmer, Burmese, ...) and in
runs of more than ``MAX`` bytes without white space, a code-point border counts as a place of white space if bits of the hash there say so; text is
never cut before a combining mark.  The words of such a stretch are measured in characters: two to a word in Han and kana, five elsewhere.
Other words are what ASCII white space of any kind and number parts.

Chunks have at most ``MAX`` bytes; where no border falls within them, the smallest hash in the second half of these bytes is the cut.  Chunks are compared by
a 128-bit digest.  The copy in the document with the smallest id stays, and within a document the first; what repeats
it is removed where neighbouring repeated chunks add up to at least ``min_words`` words, so that short lines and phrases stay.

Digests and places are shuffled, partially aggregated to the smallest id; a passage in a third of all documents is one row per task.
The texts are shuffled once, to meet the places to remove.

Defined results: a NULL text stays NULL and an empty one empty; a text that repeats earlier documents throughout becomes empty; rows
with the same id and text are one document that appears twice and keep or lose the same; rows with one id and different texts are each cut at
their own places (a place belongs to the id and a 64-bit digest of the text), and a passage that only texts of one id share stays in all of
them; rows with a NULL id are left as they are; other columns are passed through untouched.  Ids may be of any type that can be ordered.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from daymart.llm.tables import extended, fresh

RADIUS, MAX = 3, 512
_RULE = np.arange(1, 257, dtype=np.uint64)
GEAR = ((_RULE * np.uint64(0x9E3779B97F4A7C15)) ^ ((_RULE * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(29))).astype(np.uint64)
GEAR = ((GEAR * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)).astype(np.uint32)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


#: Scripts without white space between words; everything else has kind 0.
PAIRED, FIVES, MARK = 1, 2, 4
_KINDS = {
    PAIRED: [(0x2E80, 0x2FFF), (0x3000, 0x312F), (0x3190, 0xA4CF), (0xF900, 0xFAFF), (0xFE30, 0xFE4F), (0xFF00, 0xFF9F), (0x20000, 0x3FFFF)],
    FIVES: [(0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1B7F), (0xA980, 0xA9FF), (0xAA60, 0xAADF)],
}
#: Tenths of a word that a character is.
_TENTHS = np.array([2, 5, 2, 0], np.int64)


def _kinds() -> np.ndarray:
    table = np.zeros(0x40000, np.uint8)
    for kind, ranges in _KINDS.items():
        for first, last in ranges:
            table[first : last + 1] = kind
    marks = [c for c in range(0x20000) if unicodedata.category(chr(c))[0] == "M"]
    table[marks] |= MARK
    return table


KINDS = _kinds()


def rolling(raw: np.ndarray) -> np.ndarray:
    """The gear hash of the last 16 bytes at every byte: the sum of each byte's value, shifted left by its age."""
    h = GEAR[raw]
    for age in (1, 2, 4, 8):
        older = h[:-age] << np.uint32(age)
        h = h.copy()
        h[age:] += older
    return h


def unspaced(raw: bytes, data: np.ndarray, spaces: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Where white space does not part words: the bytes after which a cut may fall, those of them that count as white space, and
    the tenths of words up to each byte.  Nothing for a text without such a place."""
    n = len(data)
    edges = np.concatenate([[-1], spaces, [n]])
    long = np.flatnonzero(np.diff(edges) - 1 > MAX)
    if len(long) == 0 and data.max() < 0xE0:
        return None
    starts = np.flatnonzero(data & 0xC0 != 0x80)
    points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
    own = KINDS[np.minimum(points, len(KINDS) - 1)]
    kind, mark = own & 3, own & MARK != 0
    counted = kind > 0
    for k in long:
        counted[np.searchsorted(starts, edges[k] + 1) : np.searchsorted(starts, edges[k + 1])] = True
    if not counted.any():
        return None
    after = np.append(starts[1:], n) - 1  # last byte of each character
    may = counted & ~np.append(mark[1:], False)
    tenths = np.zeros(n + 1, np.int64)
    tenths[starts + 1] = np.where(counted & ~mark, _TENTHS[kind], 0)
    mask = np.where(kind == PAIRED, np.uint32(1), np.uint32(3)) << np.uint32(16)
    return after[may], after[may & (value[after] & mask == 0)], np.cumsum(tenths)


def borders(raw: bytes) -> tuple[list[int], np.ndarray | None]:
    """Ends of the chunks of a text, and the tenths of words up to each byte where characters are counted."""
    data = np.frombuffer(raw, np.uint8)
    n = len(data)
    if n == 0:
        return [], None
    spaces, every = np.flatnonzero(_SPACE[data]), rolling(data)
    free = unspaced(raw, data, spaces, every)
    if free:
        spaces = np.union1d(spaces, free[1])
    value = np.full(len(spaces) + 2 * RADIUS, np.iinfo(np.uint64).max, np.uint64)
    value[RADIUS : RADIUS + len(spaces)] = every[spaces]
    own, least = value[RADIUS : RADIUS + len(spaces)], np.ones(len(spaces), bool)
    for step in range(1, RADIUS + 1):
        least &= own <= value[RADIUS - step : len(value) - RADIUS - step]
        least &= own < value[RADIUS + step : len(value) - RADIUS + step]

    def smallest(places: np.ndarray, last: int) -> int | None:
        """The end of the last of the smallest hashes at ``places`` in the second half of ``MAX`` bytes."""
        near = places[np.searchsorted(places, last + MAX // 2) : np.searchsorted(places, last + MAX)]
        return int(near[len(near) - 1 - np.argmin(every[near][::-1])]) + 1 if len(near) else None

    out, last = [], 0
    for end in [*(spaces[least] + 1).tolist(), n]:
        while end - last > MAX:
            cut = smallest(spaces, last)
            if cut is None:
                k = int(np.searchsorted(spaces, last + MAX)) - 1
                cut = int(spaces[k]) + 1 if k >= 0 and spaces[k] >= last else free and smallest(free[0], last)
            if not cut:
                cut = last + MAX
                while cut < n and data[cut] & 0xC0 == 0x80:
                    cut -= 1
            out.append(cut)
            last = cut
        if end > last:
            out.append(end)
            last = end
    return out, free[2] if free else None


def chunks(text: str | None) -> Iterator[tuple[int, int, int, bytes]]:
    """(start, size, words, digest) in bytes; white space around a chunk doesn't count for its digest."""
    raw = (text or "").encode()
    start = 0
    ends, tenths = borders(raw)
    for end in ends:
        piece = raw[start:end].strip()
        words = len(piece.split())
        if tenths is not None:
            words = max(words, int(tenths[end] - tenths[start] + 5) // 10)
        yield start, end - start, words, xxhash.xxh3_128_digest(piece)
        start = end


def chunk_rows(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``id``, ``own`` (digest of the text), ``place`` (start, size and words in one number), the digest in two, and whether the text has it earlier."""
    frame = docs.select(F.col(f"`{id}`").alias("id"), F.xxhash64(f"`{text}`").alias("own"), F.col(f"`{text}`").alias("text")).filter(
        F.col("id").isNotNull() & F.col("text").isNotNull()
    )
    schema = extended(frame.select("id", "own").schema, "place long, high long, low long, again boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places, digests, again = [], [], [], []
            for row, value in enumerate(batch.column("text")):
                seen: set[bytes] = set()
                for start, size, words, digest in chunks(value.as_py()):
                    rows.append(row)
                    places.append(start << 20 | size << 10 | min(words, 1023))
                    digests.append(digest)
                    again.append(digest in seen)
                    seen.add(digest)
                if len(rows) >= 200_000 or row == batch.num_rows - 1:
                    halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                    taken = pa.array(rows, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").take(taken), batch.column("own").take(taken), pa.array(places, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(again, pa.bool_())],
                        schema.names,
                    )
                    rows, places, digests, again = [], [], [], []

    return frame.mapInArrow(run, schema)


def repeated_places(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``id``, ``own`` and ``repeats``: the repeated chunks of a text as (place, id of the document that keeps it)."""
    rows = chunk_rows(docs, id, text)
    keepers = (
        rows.filter("not again").groupBy("high", "low").agg(F.min("id").alias("keeper"), F.max("id").alias("last")).filter("keeper < last").drop("last")
    )
    found = rows.filter("not again").join(keepers, ["high", "low"]).filter("id > keeper").select("id", "own", "place", "keeper")
    within = rows.filter("again").select("id", "own", "place", F.col("id").alias("keeper"))
    return found.unionByName(within).groupBy("id", "own").agg(F.collect_set(F.struct("place", "keeper")).alias("repeats"))


def runs(repeats: list[tuple[int, int]], min_words: int) -> list[tuple[int, int, set[int]]]:
    """(start, end, keepers) in bytes of neighbouring repeated chunks with enough words."""
    out: list[list] = []
    for place, keeper in sorted(repeats):
        start, size, words = place >> 20, place >> 10 & 1023, place & 1023
        if out and out[-1][1] == start:
            out[-1][1] = start + size
            out[-1][2] += words
            out[-1][3].add(keeper)
        else:
            out.append([start, start + size, words, {keeper}])
    return [(start, end, keepers) for start, end, words, keepers in out if words >= min_words]


def deduplicated(docs: DataFrame, id: str = "doc_id", text: str = "text", min_words: int = 20, report: bool = False) -> DataFrame:
    """``docs`` without repeated passages in ``text``.

    With ``report`` three columns follow: ``n_removed`` (characters), ``spans`` (code points of the original text that went) and
    ``kept_in`` (ids of the documents that keep them, sorted).
    """
    key, own, places = fresh(docs, "_key"), fresh(docs, "_own"), fresh(docs, "_places")
    repeats = repeated_places(docs, id, text).select(F.col("id").alias(key), F.col("own").alias(own), F.col("repeats").alias(places))
    position = docs.columns.index(text)
    same = (docs[f"`{id}`"] == repeats[key]) & (F.xxhash64(docs[f"`{text}`"]) == repeats[own])
    joined = docs.join(repeats, same, "left").drop(key, own)
    schema = docs.schema
    if report:
        kind = docs.schema[id].dataType
        schema = extended(schema, f"n_removed long, spans array<struct<start:long,end:long>>, kept_in array<{kind.simpleString()}>")
        id_type = to_arrow_type(kind)
    width = len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed, spans, kept_in = [], [], [], []
            for value, own in zip(batch.column(position), batch.column(width)):
                whole, found = value.as_py(), own.as_py()
                cuts = runs([(x["place"], x["keeper"]) for x in found], min_words) if found and whole else []
                if cuts:
                    raw, last, parts, places = whole.encode(), 0, [], []
                    at = 0
                    for start, end, _ in cuts:
                        parts.append(raw[last:start])
                        at += len(raw[last:start].decode())
                        size = len(raw[start:end].decode())
                        places.append({"start": at, "end": at + size})
                        at += size
                        last = end
                    parts.append(raw[last:])
                    texts.append(b"".join(parts).decode())
                    spans.append(places)
                    removed.append(len(whole) - len(texts[-1]))
                    kept_in.append(sorted(set().union(*(keepers for _, _, keepers in cuts))))
                else:
                    texts.append(whole)
                    spans.append([])
                    removed.append(0)
                    kept_in.append([])
            columns = [pa.array(texts, pa.string()) if k == position else batch.column(k) for k in range(width)]
            if report:
                columns += [
                    pa.array(removed, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array(kept_in, pa.list_(id_type)),
                ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return joined.mapInArrow(run, schema)
