"""Exact nearest codes in Hamming distance by incremental multi-index hashing.

Vectors become binary codes by the sign of each dimension. Every task holds a bounded shard of the codes with
one hash index per code segment. Search radii grow one segment at a time: once the first ``i`` of ``m``
segments were probed to radius ``r`` and the others to ``r - 1``, every code within distance ``m * r + i - 1`` has been
met. A query is done when its k-th verified distance is within that bound; only the others go on.
The ``k`` best of all shards are merged, each task cutting to ``k`` ahead of the shuffle. Queries
come in blocks of bounded size.

Equal codes of a shard are one index entry with their ``k`` smallest ids, so a common vector is met once.

Defined cases: a null or empty vector, or one of another length than the table's most common one, has no code and
is left out, as is a null id. Rows that repeat an id and a code count once. Distance ties go to the smaller
id. Fewer than ``k`` codes give fewer rows. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import pinned

K = 10
QUERY_STEP = 50
WORD = 32
SHARD_CODES = 1 << 16
QUERY_BLOCK = 1 << 14
PAIRS_AT_ONCE = 2_000_000


def sign_words(vector: Column, dims: int) -> Column:
    """Sign bits of a vector, packed into longs of ``WORD`` bits."""
    words = []
    for start in range(0, dims, WORD):
        word = F.lit(0).cast("long")
        for i in range(start, min(dims, start + WORD)):
            word = word.bitwiseOR(F.when(vector[i] > 0, F.lit(1 << (i - start)).cast("long")).otherwise(F.lit(0).cast("long")))
        words.append(word)
    return F.array(*words)


def segment_bounds(dims: int, width: int) -> list[tuple[int, int, int]]:
    """Word, first bit and size of each segment: a word is cut evenly into segments of at most ``width`` bits."""
    bounds = []
    for word, start in enumerate(range(0, dims, WORD)):
        bits = min(WORD, dims - start)
        parts = -(-bits // width)
        edges = [bits * p // parts for p in range(parts + 1)]
        bounds += [(word, low, high - low) for low, high in zip(edges, edges[1:], strict=False)]
    return bounds


def flips(size: int, radius: int) -> np.ndarray:
    """Masks of all values that differ from a segment in ``radius`` bits."""
    return np.array([sum(1 << b for b in chosen) for chosen in combinations(range(size), radius)], np.int64)


class ShardIndex:
    """Hash indexes over the segments of the distinct codes of one shard."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray, dims: int, k: int):
        self.k, self.dims = k, dims
        self.codes, group = np.unique(codes, axis=0, return_inverse=True)
        order = np.lexsort((ids, group.ravel()))
        group, ids = group.ravel()[order], ids[order]
        start = np.searchsorted(group, np.arange(len(self.codes)))
        keep = np.arange(len(ids)) - start[group] <= k
        self.ids, self.first = ids[keep], np.searchsorted(group[keep], np.arange(len(self.codes) + 1))
        width = max(4, min(16, round(math.log2(max(2, len(self.codes))))))
        self.bounds = segment_bounds(dims, width)
        self.tables = []
        for bound in self.bounds:
            values = self.segment(self.codes, bound)
            by_value = np.argsort(values, kind="stable")
            self.tables.append((by_value, np.searchsorted(values[by_value], np.arange((1 << bound[2]) + 1))))

    @staticmethod
    def segment(codes: np.ndarray, bound: tuple[int, int, int]) -> np.ndarray:
        word, low, size = bound
        return (codes[:, word] >> low) & ((1 << size) - 1)

    def probe(self, codes: np.ndarray, number: int, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, code) pairs that meet in one segment at one radius."""
        by_value, starts = self.tables[number]
        values = self.segment(codes, self.bounds[number])[:, None] ^ masks
        begin, end = starts[values].ravel(), starts[values + 1].ravel()
        length = end - begin
        query = np.repeat(np.repeat(np.arange(len(codes)), len(masks)), length)
        before = np.cumsum(length) - length
        return query, by_value[np.repeat(begin - before, length) + np.arange(int(length.sum()))]

    def search(self, query_ids: np.ndarray, query_codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query number, id and distance of the ``k`` nearest of this shard, the query's own id left out."""
        k, count = self.k, len(query_ids)
        best = (np.empty(0, np.int64),) * 3
        limit, live, m = np.full(count, self.dims + 1), np.arange(count), len(self.bounds)
        for radius in range(max(size for *_, size in self.bounds) + 1):
            for number in range(m):
                if radius > self.bounds[number][2] or not len(live):
                    continue
                masks = flips(self.bounds[number][2], radius)
                step = max(1, int(PAIRS_AT_ONCE / (len(masks) * max(1, len(self.codes) >> self.bounds[number][2]))))
                for i in range(0, len(live), step):
                    part = live[i:i + step]
                    q, c = self.probe(query_codes[part], number, masks)
                    q = part[q]
                    apart = np.bitwise_count(query_codes[q] ^ self.codes[c]).sum(1).astype(np.int64)
                    near = apart <= limit[q]
                    best = self._better(best, q[near], c[near], apart[near], query_ids, limit)
                covered = m * radius + number
                live = live[limit[live] > covered]
        return best

    def _better(self, best, q, c, apart, query_ids, limit):
        """Merge new verified pairs into the best of each query and lower its k-th distance."""
        length = self.first[c + 1] - self.first[c]
        before = np.cumsum(length) - length
        ids = self.ids[np.repeat(self.first[c] - before, length) + np.arange(int(length.sum()))]
        q, apart = np.repeat(q, length), np.repeat(apart, length)
        other = ids != query_ids[q]
        q, ids, apart = (np.concatenate([a, b[other]]) for a, b in zip(best, (q, ids, apart), strict=True))
        order = np.lexsort((ids, apart, q))
        q, ids, apart = q[order], ids[order], apart[order]
        new = np.ones(len(q), bool)
        new[1:] = (q[1:] != q[:-1]) | (ids[1:] != ids[:-1]) | (apart[1:] != apart[:-1])
        q, ids, apart = q[new], ids[new], apart[new]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        last = rank == self.k - 1
        limit[q[last]] = apart[last]
        keep = rank < self.k
        return q[keep], ids[keep], apart[keep]


def search(vectors: DataFrame, k: int = K, step: int = QUERY_STEP, shard_codes: int = SHARD_CODES) -> DataFrame:
    """The ``k`` nearest rows of every query, the row itself left out: query_id, rank, vec_id, distance."""
    spark = vectors.sparkSession
    schema = "query_id long, vec_id long, distance int"
    lengths = vectors.filter("size(embedding) > 0").groupBy(F.size("embedding").alias("dims")).count()
    usual = lengths.orderBy(F.desc("count"), "dims").first()
    dims = usual["dims"] if usual else WORD
    coded = vectors.filter((F.size("embedding") == dims) & F.col("vec_id").isNotNull())
    coded = pinned(coded.select(F.col("vec_id").cast("long").alias("vec_id"), sign_words(F.col("embedding"), dims).alias("code")), "codes")
    queries = coded.filter(F.pmod("vec_id", F.lit(step)) == 0)
    blocks = -(-queries.count() // QUERY_BLOCK)
    found = []
    for block in range(blocks):
        own = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).distinct().collect()
        asked = spark.sparkContext.broadcast((
            np.array([r["vec_id"] for r in own], np.int64),
            np.array([r["code"] for r in own], np.int64).reshape(len(own), -1),
        ))

        def run(batches: Iterable[pa.RecordBatch], asked=asked) -> Iterator[pa.RecordBatch]:
            held, rows = [], 0

            def shard() -> pa.RecordBatch:
                ids = np.concatenate([b.column(0).to_numpy() for b in held])
                codes = np.concatenate([b.column(1).flatten().to_numpy() for b in held]).reshape(len(ids), -1)
                query_ids, query_codes = asked.value
                q, found_ids, apart = ShardIndex(ids, codes, dims, k).search(query_ids, query_codes)
                return pa.RecordBatch.from_arrays(
                    [pa.array(query_ids[q]), pa.array(found_ids), pa.array(apart.astype(np.int32))], names=["query_id", "vec_id", "distance"])

            for batch in batches:
                held.append(batch)
                rows += batch.num_rows
                if rows >= shard_codes:
                    yield shard()
                    held, rows = [], 0
            if rows:
                yield shard()

        found.append(pinned(coded.mapInArrow(run, schema), "near"))
    result = found[0] if found else spark.createDataFrame([], schema)
    for part in found[1:]:
        result = result.unionByName(part)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "vec_id"))
    ranked = result.withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "distance")
