"""Nearest neighbours by multi-index hashing: binary codes, an index for each substring of them, and exact scores for what is near.

Codes: the sample's principal axes, turned by rotations that are learned one after the other from different starts to bring the projections close to their
signs (iterative quantisation); the signs of all of them are the code.  Nearness by inner product becomes nearness of directions by one more coordinate
that brings all rows to the same length; queries have zero there.

Search: a code is cut into substrings of 16 bits.  Two codes within the radius ``m * a + b`` of ``m`` substrings agree up to ``a`` bits in one of the
first ``b + 1`` or up to ``a - 1`` bits in one of the others, so probing each substring's index to these depths finds every code within the radius, and no
other way is taken to candidates.  Most near codes agree far better in some substring than this worst case, so the depths are those of a smaller
number, the reach.  A depth is probed by its bit patterns, or over the occupied buckets where these cost less.  Candidates within the radius are
ranked by the inner product of the vectors as they are, added up in double precision in the order of the entries, so equal vectors score equally;
so are only those that a matrix product, less its greatest possible error, doesn't put behind ``k`` others.

Radius and reach are learned: sampled queries are compared with all rows, one pass over the table, and ``share`` of their true ``k`` nearest rows lie within
both.  The more rows, the nearer these are, and the smaller are radius and reach.  A query that finds fewer than ``k`` rows, though there are
more, is searched again with the full length of the code as the radius, that is, against all rows.

Queries and rows meet in blocks of bounded size, dealt by place and not by content, so copies of one vector lie in all blocks.  Each block of rows
builds its own indexes and gives ``k`` rows for each query; these are merged.  Where blocks of rows are fewer than tasks, the queries are dealt to more blocks.

Defined results: vectors that are NULL, empty or zero or hold NULL or infinite entries or NaN take no part, nor do those of another length than the
most frequent one.  An id over several rows: they all are candidates, but not for a query of the same id; as a query it counts once, with the least of its
vectors.  Rows with a NULL id are candidates and come last among ties.  Without queries or candidates there are no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymart.llm.tables import usable, usual_length, written

SUBSTRING = 16
QUERY_BLOCK, LEAST_QUERY_BLOCK, ROW_BLOCK, LEAST_ROW_BLOCK, AT_ONCE = 8192, 256, 65_536, 16_384, 128


@dataclass(frozen=True)
class Codes:
    """Directions of the code (one column for each bit), the greatest length of a row, the radius, and the reach of probing."""

    directions: np.ndarray
    longest: float
    radius: int
    reach: int

    @property
    def bits(self) -> int:
        return self.directions.shape[1]


def _directions(sample: np.ndarray, bits: int, rounds: int = 20, seed: int = 7) -> np.ndarray:
    axes = np.linalg.eigh(sample.T @ sample)[1][:, ::-1][:, :bits]
    projected, chance, found = sample @ axes, np.random.default_rng(seed), []
    width = axes.shape[1]
    while len(found) * width < bits:
        turn = np.linalg.qr(chance.standard_normal((width, width)))[0]
        for _ in range(rounds):
            left, _, right = np.linalg.svd(projected.T @ np.where(projected @ turn >= 0, 1.0, -1.0))
            turn = left @ right
        found.append(axes @ turn)
    return np.hstack(found)[:, :bits]


def raised(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Rows with the coordinate that brings them all to length ``longest``."""
    rest = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(axis=1), 0.0))
    return np.hstack([vectors, rest[:, None]])


def coded(vectors: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Codes as 16-bit substrings."""
    bits = np.packbits(vectors @ directions >= 0, axis=1)
    return np.ascontiguousarray(bits).view(np.uint16)


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Differing bits of codes, row by row."""
    return np.bitwise_count(left ^ right).sum(axis=-1, dtype=np.int32)


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(flat), -1) if len(flat) else values.reshape(0, 0)


def _nearest_codes(rows: DataFrame, own: np.ndarray, asked: np.ndarray, directions: np.ndarray, longest: float, k: int) -> pa.Table:
    """Codes of the true ``k`` nearest other rows of each query, compared with all rows, and the number of the query: ``(query, code)``."""
    at_once = max(k, (1 << 20) // len(asked))

    def nearest_of(batches):
        score, vector = np.full((len(asked), k), -np.inf), np.zeros((len(asked), k, asked.shape[1]))
        for batch in batches:
            plain, ids = _matrix(batch.column("vector")), batch.column("id").fill_null(0).to_numpy(zero_copy_only=False)
            null = batch.column("id").is_null().to_numpy(zero_copy_only=False)
            for low in range(0, len(plain), at_once):
                part = plain[low : low + at_once]
                new = asked @ part.T
                here = slice(low, low + len(part))
                new[(own[:, None] == ids[here]) & ~null[here]] = -np.inf
                both = np.hstack([score, new])
                chosen = np.argpartition(-both, k - 1, axis=1)[:, :k]
                score = np.take_along_axis(both, chosen, 1)
                kept = np.take_along_axis(vector, chosen.clip(max=k - 1)[..., None], 1)
                vector = np.where((chosen < k)[..., None], kept, part[(chosen - k).clip(min=0)])
        query, place = np.nonzero(np.isfinite(score))
        codes = coded(raised(vector[query, place], longest), directions)
        columns = [pa.array(query, pa.int32()), pa.array(score[query, place]), pa.array([c.tobytes() for c in codes], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["query", "score", "code"])

    found = rows.select("id", "vector").mapInArrow(nearest_of, "query int, score double, code binary")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "code"))
    return found.withColumn("place", place).where(F.col("place") <= k).select("query", "code").toArrow()


def bounds(differing: np.ndarray, share: float) -> tuple[int, int]:
    """Radius and reach that hold ``share`` of these near codes, given by the bits that differ in each substring."""
    far, substrings = differing.sum(axis=1), differing.shape[1]
    probed = (differing * substrings + np.arange(substrings)).min(axis=1)  # the least reach that finds a code
    radius = int(np.quantile(far, (1 + share) / 2, method="higher"))
    inside = np.sort(probed[far <= radius])
    return radius, int(inside[min(len(inside), int(np.ceil(share * len(far)))) - 1])


def fit(rows: DataFrame, queries: DataFrame, k: int, bits: int = 256, sample_rows: int = 8192, sample_queries: int = 256, share: float = 0.9995) -> Codes:
    """Directions from at most ``sample_rows`` different vectors, those with the smallest digests, and bounds from the nearest of all rows to at most
    ``sample_queries`` different queries, chosen likewise; the greatest length is that of all rows."""
    squared = F.aggregate("vector", F.lit(0.0), lambda total, c: total + c.cast("double") * c.cast("double"))
    longest = float(rows.agg(F.sqrt(F.max(squared)).alias("longest")).collect()[0]["longest"])
    drawn = rows.select(F.xxhash64("vector").alias("drawn"), "vector").distinct().orderBy("drawn", "vector").limit(sample_rows).toArrow()
    directions = _directions(raised(_matrix(drawn.column("vector")), longest), bits)
    some = queries.groupBy("vector").agg(F.min("id").alias("id")).orderBy(F.xxhash64("vector"), "id").limit(sample_queries).toArrow()
    own, asked = some.column("id").to_numpy(), _matrix(some.column("vector"))
    near = _nearest_codes(rows, own, asked, directions, longest, k)
    if not near.num_rows:
        return Codes(directions, longest, bits, bits)
    codes = np.frombuffer(b"".join(near.column("code").to_pylist()), np.uint16).reshape(near.num_rows, -1)
    questions = coded(np.hstack([asked, np.zeros((len(asked), 1))]), directions)[near.column("query").to_numpy()]
    return Codes(directions, longest, *bounds(np.bitwise_count(codes ^ questions).astype(np.int64), share))


def depths(radius: int, substrings: int) -> list[int]:
    """How many bits of each substring may differ; -1 where it need not be probed."""
    whole, rest = divmod(radius, substrings)
    return [whole if j <= rest else whole - 1 for j in range(substrings)]


def _words(codes: np.ndarray) -> np.ndarray:
    """Codes in words of 64 bits, a row for each word."""
    return np.ascontiguousarray(np.pad(codes, ((0, 0), (0, -codes.shape[1] % 4))).view(np.uint64).T)


class MultiIndex:
    """One index for each substring: rows in order of their bucket, and where the occupied buckets begin."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.words, self.indexes = codes, _words(codes), []
        for j in range(codes.shape[1]):
            order = np.argsort(codes[:, j], kind="stable")
            keys, starts, sizes = np.unique(codes[order, j], return_index=True, return_counts=True)
            self.indexes.append((order, keys, starts, sizes))

    def _hits(self, asked: np.ndarray, keys: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of query and occupied bucket that differ in ``depth`` bits at most."""
        patterns = _patterns(depth, len(keys))
        if patterns is None:
            hit = np.flatnonzero(np.bitwise_count(asked[:, None] ^ keys[None, :]) <= depth)
            return hit // len(keys), hit % len(keys)
        buckets = np.full(1 << SUBSTRING, -1, dtype=np.int32)
        buckets[keys] = np.arange(len(keys))
        bucket = buckets[asked[:, None] ^ patterns[None, :]].ravel()
        hit = np.flatnonzero(bucket >= 0)
        return hit // len(patterns), bucket[hit]

    def within(self, asked: np.ndarray, radius: int, reach: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of query and row whose codes differ in ``radius`` bits at most; with a smaller ``reach``, those of them that its depths find."""
        n = len(self.codes)
        if radius >= SUBSTRING * self.codes.shape[1]:
            return np.repeat(np.arange(len(asked)), n), np.tile(np.arange(n), len(asked))
        seen = np.zeros((len(asked), n), dtype=bool)
        for j, depth in enumerate(depths(radius if reach is None else min(reach, radius), self.codes.shape[1])):
            if depth < 0:
                continue
            order, keys, starts, sizes = self.indexes[j]
            query, bucket = self._hits(asked[:, j], keys, depth)
            many = sizes[bucket]
            place = np.arange(many.sum()) + np.repeat(starts[bucket] - (np.cumsum(many) - many), many)
            seen.ravel()[np.repeat(query * n, many) + order[place]] = True
        kept = []
        for own, marked in zip(_words(asked).T, seen):
            row = np.flatnonzero(marked)
            far = np.zeros(len(row), dtype=np.int32)
            for word, stored in zip(own, self.words):
                far += np.bitwise_count(stored[row] ^ word)
            kept.append(row[far <= radius])
        return np.repeat(np.arange(len(asked)), [len(row) for row in kept]), np.concatenate(kept)


_KNOWN: dict[int, np.ndarray] = {}


def _patterns(depth: int, occupied: int) -> np.ndarray | None:
    """All patterns of up to ``depth`` set bits; none where comparing the occupied buckets costs less, about a quarter of a pattern each."""
    size, ways = 0, 1
    for t in range(min(depth, SUBSTRING) + 1):
        size, ways = size + ways, ways * (SUBSTRING - t) // (t + 1)
    if 4 * size >= occupied:
        return None
    if depth not in _KNOWN:
        _KNOWN[depth] = np.array([sum(1 << b for b in chosen) for t in range(depth + 1) for chosen in combinations(range(SUBSTRING), t)], dtype=np.uint16)
    return _KNOWN[depth]


def scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products row by row, added in the order of the entries."""
    total = np.zeros(len(left))
    for i in range(left.shape[1]):
        total += left[:, i] * right[:, i]
    return total


def _foremost(query: np.ndarray, row: np.ndarray, asked: np.ndarray, stored: np.ndarray, longest: float, k: int) -> np.ndarray:
    """Of pairs in order of their query, those that may be among its ``k`` best scores: a matrix product errs by less than ``slack``."""
    near = np.ones(len(query), dtype=bool)
    edges = np.flatnonzero(np.diff(query, prepend=-1, append=-1))
    with np.errstate(all="ignore"):
        for low, high in zip(edges[:-1], edges[1:]):
            if high - low > k:
                own = asked[query[low]]
                rough = stored[row[low:high]] @ own
                slack = 4 * len(own) * (np.finfo(float).eps * longest * np.abs(own).max() * np.sqrt(len(own)) + np.finfo(float).smallest_subnormal)
                near[low:high] = ~(rough < np.partition(rough, -k)[-k] - slack)  # keeps all where it overflows
    return near


def _block_search(codes: Codes, radius: int, reach: int, k: int):
    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out = ([], [], [])
        if queries.num_rows and rows.num_rows:
            asked, stored = _matrix(queries.column("vector")), _matrix(rows.column("vector"))
            own = queries.column("id").to_numpy()
            null = rows.column("id").combine_chunks().is_null().to_numpy(zero_copy_only=False)
            ids = rows.column("id").combine_chunks().fill_null(0).to_numpy(zero_copy_only=False)
            index = MultiIndex(coded(raised(stored, codes.longest), codes.directions))
            questions = coded(np.hstack([asked, np.zeros((len(asked), 1))]), codes.directions)
            for low in range(0, len(asked), AT_ONCE):
                query, row = index.within(questions[low : low + AT_ONCE], radius, reach)
                other = (own[low + query] != ids[row]) | null[row]
                query, row = query[other] + low, row[other]
                near = _foremost(query, row, asked, stored, codes.longest, k)
                query, row = query[near], row[near]
                score = np.concatenate([scores(asked[query[p : p + 65536]], stored[row[p : p + 65536]]) for p in range(0, len(query), 65536)] or [np.zeros(0)])
                order = np.lexsort((ids[row], null[row], -score, query))
                query, row, score = query[order], row[order], score[order]
                first = np.searchsorted(query, query, side="left")
                near = np.arange(len(query)) - first < k
                out[0].append(own[query[near]])
                out[1].append(pa.array(ids[row[near]], pa.int64(), mask=null[row[near]]))
                out[2].append(score[near])
        columns = [
            pa.array(np.concatenate(out[0]) if out[0] else [], pa.int64()),
            pa.concat_arrays(out[1]) if out[1] else pa.array([], pa.int64()),
            pa.array(np.concatenate(out[2]) if out[2] else [], pa.float64()),
        ]
        return pa.Table.from_arrays(columns, ["query_id", "vec_id", "score"])

    return search


def _met(queries: DataFrame, rows: DataFrame, n_queries: int, n_rows: int, codes: Codes, radius: int, reach: int, k: int) -> DataFrame:
    """``query_id, vec_id, score``: the nearest rows of each block of rows."""
    slots = rows.sparkSession.sparkContext.defaultParallelism
    in_block = min(ROW_BLOCK, max(LEAST_ROW_BLOCK, n_rows // (3 * slots)))
    of_rows = -(-n_rows // in_block)
    of_queries = max(-(-n_queries // QUERY_BLOCK), min(-(-3 * slots // of_rows), -(-n_queries // LEAST_QUERY_BLOCK)))

    def dealt(frame: DataFrame, own: str, parts: int, other: str, others: int) -> DataFrame:
        numbered = frame.withColumn(own, F.pmod(F.monotonically_increasing_id(), F.lit(parts)))
        return numbered.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))))

    left = dealt(queries, "q_block", of_queries, "r_block", of_rows).groupBy("q_block", "r_block")
    right = dealt(rows, "r_block", of_rows, "q_block", of_queries).groupBy("q_block", "r_block")
    return left.cogroup(right).applyInArrow(_block_search(codes, radius, reach, k), "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, asked: Column, ids: str = "vec_id", vector: str = "embedding", k: int = 20, **options) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every id of rows with ``asked``, up to ``k`` other rows."""
    spark = vectors.sparkSession
    rows = usable(vectors.select(F.col(ids).cast("long").alias("id"), F.col(vector).alias("vector"), F.coalesce(asked, F.lit(False)).alias("asked")), "vector")
    rows = rows.where(F.exists("vector", lambda c: c != 0))
    width = usual_length(rows, "vector")
    rows = rows.where(F.size("vector") == width)
    queries = written(rows.where(F.col("asked") & F.col("id").isNotNull()).groupBy("id").agg(F.min("vector").alias("vector")))
    rows = rows.select("id", "vector")
    n_rows, n_queries = rows.count(), queries.count()
    if not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    codes = fit(rows, queries, k, **options)
    found = written(_met(queries, rows, n_queries, n_rows, codes, codes.radius, codes.reach, k))

    # Queries with fewer finds than they could have are asked again without a bound.
    own = rows.join(queries.select("id"), "id", "left_semi").groupBy("id").agg(F.count("*").alias("own"))
    counted = found.groupBy("query_id").agg(F.count("*").alias("n"))
    short = queries.join(counted, F.col("id") == F.col("query_id"), "left").join(own, "id", "left")
    short = short.where(F.coalesce("n", F.lit(0)) < F.least(F.lit(k), F.lit(n_rows) - F.coalesce("own", F.lit(0)))).select("id", "vector")
    short = written(short)
    n_short = short.count()
    if n_short:
        again = _met(short, rows, n_short, n_rows, codes, codes.bits, codes.bits, k)
        found = found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(again)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    return found.withColumn("rank", place.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
