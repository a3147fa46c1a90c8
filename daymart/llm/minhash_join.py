"""Near-duplicates by an inverted join over the coordinates of MinHash signatures.

1. Every text becomes its set of word shingles, and the set a signature of ``COORDINATES`` minima.  Texts with equal sets form a
   class; only one document of each class goes on, so that any number of copies costs one row.
2. Two sets of the similarity sought agree in at least ``matches`` coordinates (four standard deviations below the mean).  Then
   they share one of any ``COORDINATES - matches + 1`` of them, so each document is posted only under that
   many (coordinate, value) pairs: its rarest ones (prefix filter).  How frequent pairs are is counted over all documents in a
   table of fixed size; it decides the order only, never the result.
3. Posting lists are merged: documents of a list are compared coordinate by coordinate, skipping pairs that an earlier shared posting
   has counted already, and those with enough collisions are noted.  Long lists are cut into blocks by a hash, and every pair of
   blocks is a unit of work of its own; nothing is capped and no pairs are written out.
4. The noted documents of a unit are confirmed on their full shingle sets, exactly, and a spanning forest of the links is
   kept: at most one row per document and unit.
5. Components by alternating large and small stars, each round written to the shared folder.

Defined results: a NULL or blank text has an empty set and links with nothing; a text of fewer words than a shingle has one
shingle, all its words; a NULL id links with nothing, has no component and is kept; rows that repeat an id and a text get the same result;
with one id over different texts every row counts by its own text (of 64-bit digest): it has the component of that text, whose number is the smallest id
that any of the component's texts stands under, and it is that row which is kept or removed, so no text is lost; ids are whole numbers; other columns are passed through by ``unique_documents`` and not read otherwise.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymart.llm.tables import extended, fresh, written

COORDINATES = 64
TABLE = 1 << 20
CELLS = 1 << 23
BLOCK_ROWS, BLOCK_SHINGLES = 1024, 2_000_000
_DRAW = np.random.Generator(np.random.PCG64(20)).integers(1, 2**63, (2, COORDINATES), dtype=np.uint64)
_SLOPE, _SHIFT = _DRAW[0] * np.uint64(2) + np.uint64(1), _DRAW[1]
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_WORDS: dict[bytes, int] = {}
_WORDS_KEPT = 500_000


def least_matches(percent: int) -> int:
    """Coordinates in which two sets of this similarity agree at least, but for about 1 in 10,000 pairs."""
    share = percent / 100
    return max(1, math.floor(COORDINATES * share - 4 * math.sqrt(COORDINATES * share * (1 - share))))


def _word(word: bytes) -> int:
    digest = xxhash.xxh3_64_intdigest(word)
    if len(_WORDS) >= _WORDS_KEPT:
        _WORDS.clear()
    _WORDS[word] = digest
    return digest


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit digests of the word shingles; A-Z are lower-cased, words end at ASCII white space."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    known = _WORDS.get
    digests = np.array([known(w) or _word(w) for w in words], np.uint64)
    size = min(size, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        out = out * _STEP + digests[k : k + len(out)]
    out ^= out >> np.uint64(29)
    out *= _MIX
    out ^= out >> np.uint64(32)
    return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """32 bits of each minimum of 64.

    The minimum of many numbers has its high bits empty; cut to 32 bits it would meet those of other documents by chance, the more
    the longer they are.  Mixed first, all 32 bits tell documents apart.
    """
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 4096):
        least = np.minimum(least, (shingles[start : start + 4096, None] * _SLOPE + _SHIFT).min(0))
    return ((least * _MIX) >> np.uint64(32)).astype(np.uint32)


def profiles(docs: DataFrame, id: str, text: str, size: int) -> DataFrame:
    """``id``, ``own`` (digest of the text), ``n_shingles``, the digest of the set in two halves (NULL for none) and the signature."""
    frame = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.xxhash64(f"`{text}`").alias("own"), F.col(f"`{text}`").alias("text"))
    schema = extended(frame.select("id", "own").schema, "n_shingles long, high long, low long, signature binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, high, low, signatures = [], [], [], []
            for value in batch.column("text"):
                own = shingle_set(value.as_py(), size)
                counts.append(len(own))
                halves = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), np.int64) if len(own) else (None, None)
                high.append(halves[0])
                low.append(halves[1])
                signatures.append(signature(own).tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("own"), *(pa.array(c, pa.int64()) for c in (counts, high, low)), pa.array(signatures, pa.binary())], schema.names
            )

    return frame.mapInArrow(run, schema)


def _postings(signatures: np.ndarray) -> np.ndarray:
    """One number for each (coordinate, value)."""
    return (signatures.astype(np.uint64) | (np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32))) * _MIX


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)


def frequencies(reps: DataFrame) -> np.ndarray:
    """How often postings fall into each of ``TABLE`` cells, over all documents; a table of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = (_postings(_matrix(batch.column("signature"))) >> np.uint64(44)).astype(np.int32).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(cells)], ["cell"])

    counts = reps.select("signature").mapInArrow(run, "cell int").groupBy("cell").agg(F.count("*").alias("n")).toArrow()
    out = np.zeros(TABLE, np.int64)
    out[counts.column("cell").to_numpy()] = counts.column("n").to_numpy()
    return np.minimum(out, np.iinfo(np.int32).max).astype(np.int32)


def posted(reps: DataFrame, matches: int) -> DataFrame:
    """``posting``, ``coordinate``, ``id``, ``n_shingles``, ``mask`` (coordinates of the prefix) and the signature."""
    table = reps.sparkSession.sparkContext.broadcast(frequencies(reps))
    length = COORDINATES - matches + 1
    bits = np.uint64(1) << np.arange(COORDINATES, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                if not part.num_rows:
                    continue
                own = _postings(_matrix(part.column("signature")))
                frequency = table.value[(own >> np.uint64(44)).astype(np.int64)]
                order = np.lexsort((own, frequency), axis=1)[:, :length]
                rows = np.repeat(np.arange(len(own)), length)
                chosen = order.ravel()
                mask = bits[order].sum(1, dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(own[rows, chosen].view(np.int64)),
                        pa.array(chosen.astype(np.int32)),
                        part.column("id").take(pa.array(rows)),
                        part.column("n_shingles").take(pa.array(rows)),
                        pa.array(mask[rows]),
                    ],
                    ["posting", "coordinate", "id", "n_shingles", "mask"],
                )

    return reps.select("id", "n_shingles", "signature").mapInArrow(run, "posting long, coordinate int, id long, n_shingles long, mask long")


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables in which no group is cut, with the bounds of the groups; the input is sorted by ``keys``."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        bounds = _bounds(held, keys)
        if len(bounds) > 2:
            last = int(bounds[-2])
            yield held.slice(0, last).combine_chunks(), bounds[:-1]
            held = held.slice(last)
    if held is not None:
        yield held.combine_chunks(), _bounds(held, keys)


def _bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    changed = np.zeros(table.num_rows - 1, bool)
    for key in keys:
        values = table.column(key).to_numpy()
        changed |= values[1:] != values[:-1]
    return np.concatenate([[0], np.flatnonzero(changed) + 1, [table.num_rows]])


UNIT = ["posting", "left", "right"]


def _noted(signatures: np.ndarray, masks: np.ndarray, blocks: np.ndarray, coordinate: int, cross: bool, matches: int) -> np.ndarray:
    """Which rows of a unit take part in a pair with enough collisions whose first shared posting this is."""
    n = len(masks)
    noted = np.zeros(n, bool)
    lower = np.uint64((1 << coordinate) - 1)
    bits = np.uint64(1) << np.arange(COORDINATES, dtype=np.uint64)
    early = np.flatnonzero(bits & lower)
    for step in range(1, n):
        a, b = np.arange(n - step), np.arange(step, n)
        if cross:
            a, b = a[blocks[:-step] != blocks[step:]], b[blocks[:-step] != blocks[step:]]
        if len(early) and len(a):  # an earlier posting of both has met this pair already
            same = signatures[np.ix_(a, early)] == signatures[np.ix_(b, early)]
            both = (masks[a] & masks[b])[:, None] & bits[early] != 0
            new = ~(same & both).any(1)
            a, b = a[new], b[new]
        if len(a):
            near = (signatures[a] == signatures[b]).sum(1) >= matches
            noted[a[near]] = True
            noted[b[near]] = True
    return noted


def candidates(reps: DataFrame, matches: int) -> DataFrame:
    """Units of work (``posting``, ``left``, ``right``) with the ``id`` of the documents to confirm in them."""
    posts = written(posted(reps, matches))
    lists = posts.groupBy("posting").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("total")).filter("n > 1")
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK_ROWS, F.col("total") / BLOCK_SHINGLES)).cast("int")
    shared = posts.join(lists.select("posting", blocks.alias("blocks")), "posting")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    placed = shared.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = placed.select(
        "posting", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "coordinate", "block", "mask", "id"
    )
    rows = units.join(reps.select("id", "signature"), "id").repartition(*UNIT).sortWithinPartitions(*UNIT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in _whole_groups(batches, UNIT):
            signatures = _matrix(table.column("signature"))
            masks = table.column("mask").to_numpy().view(np.uint64)
            left, right, coordinate, block = (table.column(c).to_numpy() for c in ("left", "right", "coordinate", "block"))
            noted = np.zeros(table.num_rows, bool)
            for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if end - start > 1:
                    noted[start:end] = _noted(
                        signatures[start:end], masks[start:end], block[start:end], int(coordinate[start]), bool(left[start] != right[start]), matches
                    )
            if noted.any():
                yield from table.select([*UNIT, "id"]).filter(pa.array(noted)).to_batches()

    return rows.mapInArrow(run, "posting long, left int, right int, id long")


def _forest(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest, over positions, of all pairs that are similar enough; pairs already connected are skipped."""
    root = list(range(len(sets)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(code, kind="stable")
    holders = owner[order]
    starts = np.concatenate([[0], np.cumsum(np.bincount(code))])
    ends = np.cumsum(sizes)
    out = []
    for i in range(len(sets)):
        own = code[ends[i] - sizes[i] : ends[i]]
        lengths = starts[own + 1] - starts[own]
        at = np.repeat(starts[own] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        common = np.bincount(holders[at], minlength=len(sets))
        near = 100 * common >= percent * (sizes + sizes[i] - common)
        for j in np.flatnonzero(near[:i]).tolist():
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((i, j))
    return out


def _noted_texts(units: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose ``doc`` falls into the same of ``CELLS`` cells as one of ``units``.

    A table of one bit for each cell, of fixed size, travels to the tasks; it lets all noted documents through and few others, so
    that the join which follows shuffles the texts of candidates only.
    """
    cell = F.pmod(F.xxhash64("doc"), F.lit(CELLS)).cast("int").alias("cell")
    marked = np.zeros(CELLS, bool)
    marked[units.select(cell).distinct().toArrow().column("cell").to_numpy()] = True
    table = units.sparkSession.sparkContext.broadcast(np.packbits(marked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            keep = (table.value[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1
            if keep.any():
                yield batch.filter(pa.array(keep.astype(bool))).select(["doc", "text"])

    return texts.filter(F.col("doc").isNotNull()).select("doc", "text", cell).mapInArrow(run, "doc long, text string")


def links(units: DataFrame, reps: DataFrame, docs: DataFrame, id: str, text: str, size: int, percent: int) -> DataFrame:
    """Confirmed links (``a`` < ``b``) between classes that connect what is connected in each unit.

    The text of a class is that of the id and digest in ``reps``.
    """
    own = F.xxhash64("text").alias("own")
    texts = docs.select(F.col(f"`{id}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"))
    named = units.join(reps.select("id", "doc", "own"), "id")
    rows = named.join(_noted_texts(named, texts).select("doc", "text", own), ["doc", "own"]).repartition(*UNIT).sortWithinPartitions(*UNIT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in _whole_groups(batches, UNIT):
            ids, texts = table.column("id").to_numpy(), table.column("text")
            a, b = [], []
            for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                sets = [shingle_set(texts[k].as_py(), size) for k in range(start, end)]
                for i, j in _forest(sets, percent):
                    one, two = int(ids[start + i]), int(ids[start + j])
                    if one != two:
                        a.append(min(one, two))
                        b.append(max(one, two))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component`` (the smallest id reachable) of every id in an edge that isn't the smallest itself.

    Alternating large and small stars; the number of rounds grows with the logarithm of a component's size.
    """
    state = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    before = None
    while True:
        check = state.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if not check["n"] or tuple(check) == before:
            return state.select(F.col("u").alias("id"), F.col("v").alias("component"))
        before = tuple(check)
        both = state.union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large)
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        state = written(small.union(lowest.select("u", F.col("m").alias("v"))).distinct())


def _marked(docs: DataFrame, id: str, text: str, size: int, percent: int) -> DataFrame:
    """Every row's ``id``, ``own``, ``n_shingles``, ``component_id`` and ``kept``.

    Classes of equal sets are numbered; links and components are between classes, and rows are mapped to them last.
    """
    profile = written(profiles(docs, id, text, size))
    linked = F.col("high").isNotNull() & F.col("id").isNotNull()
    usable = profile.where(linked)
    classes = usable.groupBy("high", "low").agg(F.min("id").alias("rep"))
    chosen = usable.join(classes, ["high", "low"]).filter("id = rep").groupBy("high", "low", "rep").agg(
        F.min_by(F.struct("own", "n_shingles", "signature"), "own").alias("r")
    )
    numbered = written(chosen.select(F.monotonically_increasing_id().alias("id"), "high", "low", F.col("rep").alias("doc"), "r.*"))
    reps = numbered.select("id", "doc", "own", "n_shingles", "signature")
    units = written(candidates(reps, least_matches(percent)))
    found = components(links(units, reps, docs, id, text, size, percent))
    placed = written(numbered.join(found, "id", "left").select("high", "low", "doc", F.coalesce("component", "id").alias("component")))
    names = placed.groupBy("component").agg(F.min("doc").alias("component_id"))
    resolved = placed.join(names, "component").select("high", "low", "component_id")
    joined = usable.join(resolved, ["high", "low"]).select("id", "own", "n_shingles", "component_id")
    alone = profile.where(~linked).select("id", "own", "n_shingles", F.col("id").alias("component_id"))
    kept = F.coalesce(F.col("component_id") == F.col("id"), F.lit(True))
    return joined.unionByName(alone).withColumn("kept", kept)


def grouped(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """``id``, ``n_shingles``, ``component_id`` (smallest id reachable over links) and ``kept`` (whether it is that one)."""
    return _marked(docs, id, text, size, percent).select(F.col("id").alias(id), "n_shingles", "component_id", "kept")


def unique_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the rows that a document with a smaller id stands for."""
    key, own = fresh(docs, "_gone"), fresh(docs, "_own")
    gone = _marked(docs, id, text, size, percent).filter("not kept").select(F.col("id").alias(key), F.col("own").alias(own)).distinct()
    same = (docs[f"`{id}`"] == gone[key]) & (F.xxhash64(docs[f"`{text}`"]) == gone[own])
    return docs.join(gone, same, "left_anti")
