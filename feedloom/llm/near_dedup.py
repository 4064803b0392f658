"""Near-duplicate groups: banded MinHash candidates, Bayesian pruning, exact confirmation.

Documents with one shingle set are one class; classes with at least one shingle get ``SIGNATURE`` MinHash
values, the first ``BANDS * ROWS`` of them cut into bands. Classes that share a band are candidates. Within each band bucket their
signatures of ``SIGNATURE`` bytes are compared in batches of growing length: after every batch a pair goes as soon
as the posterior probability of a similarity of at least the threshold is below ``MISS``. A pair that meets in several
buckets belongs to the first band it shares and is compared there alone.

The first round sends only pairs that are likely links to the exact check on the full sets, as few as join them. The
second compares what stays apart: members with a surviving pair get their full sets, and each of their pairs between
different components is checked where it meets, so rows grow with the members and not with the pairs.

A bucket is dealt out in chunks of at most ``CHUNK`` members. Chunks of one bucket share its smallest member and some
``PIVOTS`` others, so the same component grows in all of them. The second round compares what stays outside of a bucket's
component with all its members. The many bands of a group of near copies give it as many buckets of nearly the same
members: those that share their smallest member are one group then, in which an outsider meets each member once
and not once a band. Buckets without common members have different smallest ones and stay apart, and so do small ones that
overlap so little that their group would have more than ``OVERLAP`` times their pairs. The sets of a chunk of the second
round hold about ``CHUNK_SHINGLES`` shingles at most, or one set of each side.

A pair of similarity s is no candidate with probability (1 - s ** ROWS) ** BANDS: 6e-5 at 0.75, 3e-7 at 0.8.

Defined cases: a null text, or one without words, has an empty set and is linked with nothing. With fewer than five
words the words the whole sequence is the one shingle. Rows with one text, known by its 64-bit hash, are one member of the
comparison and share its component, also when they repeat an id. A null id sorts behind all others, so a
component has a null id only if all its rows do. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import short_batches
from feedloom.llm.components import components
from feedloom.session import pinned

WORDS = 5
PERCENT = 75
ROWS, BANDS = 6, 50
SIGNATURE = 512
STEPS = (16, 32, 64, 128, 256, 512)
MISS = 1e-4
CHUNK = 4096
PIVOTS = 32
OVERLAP = 2
# Shingles of the sets that meet in one chunk (8 bytes each).
CHUNK_SHINGLES = 4_000_000
# Survivors with this share of equal bytes count as linked in the first round.
SURE = 0.8
# Survivors of a member that are checked at once, the most alike first.
AT_ONCE = (8, 512)
CACHE_WORDS = 500_000
# Text numbers (8 bytes each) that may be broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


@lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    return WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    return x ^ (x >> np.uint64(29))


def shingle_set(text: bytes | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    cache = word_hashes()
    if len(cache) > CACHE_WORDS:
        cache.clear()
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    size = min(WORDS, len(h))
    total = h[:len(h) - size + 1].copy()
    for i in range(1, size):
        total = mixed(total) + h[i:len(h) - size + 1 + i]
    return np.unique(mixed(total + np.uint64(size)))


@lru_cache(maxsize=1)
def hash_family() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(5)
    factors = rng.integers(0, 1 << 31, SIGNATURE, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return factors[:, None], rng.integers(0, 1 << 32, SIGNATURE, dtype=np.uint32)[:, None]


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    """``SIGNATURE`` MinHash values of a set."""
    factor, shift = hash_family()
    x = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    low = None
    for i in range(0, len(x), 512):
        part = (x[None, i:i + 512] * factor + shift).min(1)
        low = part if low is None else np.minimum(low, part)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    """64-bit keys of the bands of many signatures (rows)."""
    rows = low[:, :BANDS * ROWS].reshape(len(low), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2]).copy()
    for i in range(ROWS):
        key = mixed(key * MIX + rows[:, :, i])
    return key.view(np.int64)


@lru_cache(maxsize=1)
def least_matches() -> list[tuple[int, int]]:
    """(bytes compared, matches needed): fewer leave the posterior of a similar pair below ``MISS``.

    With a uniform prior and m matches of n, P(p >= t) = P(Binomial(n + 1, t) <= m), where bytes of dissimilar
    values also match once in 256. A pair at the threshold itself is lost by a step with the chance
    P(Binomial(n, t) < needed); over all steps these sum to at most ``MISS``.
    """
    t = PERCENT / 100
    t = t + (1 - t) / 256
    needed = []
    for n in STEPS:
        below, lost, m = 0.0, 0.0, 0
        while True:
            below += math.comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
            lost += math.comb(n, m) * t ** m * (1 - t) ** (n - m)
            if below >= MISS or lost > MISS / len(STEPS):
                break
            m += 1
        needed.append((n, m))
    return needed


def similar(one: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``many`` signatures survive all batches against ``one`` (or row by row), and their equal bytes."""
    alive, start = np.arange(len(many)), 0
    matches = np.zeros(len(many), np.int64)
    for n, least in least_matches():
        left = one[start:n] if one.ndim == 1 else one[alive, start:n]
        matches = matches + (many[alive, start:n] == left).sum(1)
        keep = matches >= least
        alive, matches, start = alive[keep], matches[keep], n
    return alive, matches


def linked_to(one: np.ndarray, many: list[np.ndarray]) -> np.ndarray:
    """Which of the sets ``many``, none empty, are linked with the set ``one``."""
    size = np.array([len(x) for x in many])
    flat = np.concatenate(many)
    at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    both = np.add.reduceat((one[at] == flat).astype(np.int64), np.cumsum(size) - size)
    return 100 * both >= PERCENT * (len(one) + size - both)


class Forest:
    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        while self.parent.get(x, x) != x:
            self.parent[x] = self.parent.get(self.parent[x], self.parent[x])
            x = self.parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


class Survivors:
    """The rows that have a surviving pair."""

    def __init__(self, cols: dict):
        self.rows = np.zeros(len(cols["node"]), bool)

    def roots(self, comp: np.ndarray) -> np.ndarray:
        return comp.copy()

    def take(self, one: np.ndarray, two: np.ndarray, matches: np.ndarray) -> list[tuple[int, int]]:
        """Hear of surviving pairs; returns the components that went into others, with those."""
        self.rows[one] = self.rows[two] = True
        return []


class Likely:
    """Pairs that are surely alike, as few as join their components."""

    def __init__(self, cols: dict):
        self.node, self.comp, self.forest, self.links = cols["node"].tolist(), cols["comp"].tolist(), Forest(), []

    def roots(self, comp: np.ndarray) -> np.ndarray:
        return np.array([self.forest.root(c) for c in comp.tolist()], np.int64)

    def apart(self, i: int, j: int) -> bool:
        return self.forest.root(self.comp[i]) != self.forest.root(self.comp[j])

    def link(self, i: int, j: int) -> list[tuple[int, int]]:
        old = [self.forest.root(self.comp[x]) for x in (i, j)]
        if not self.forest.join(*old):
            return []
        self.links.append((min(self.node[i], self.node[j]), max(self.node[i], self.node[j])))
        return [(max(old), min(old))]

    def take(self, one: np.ndarray, two: np.ndarray, matches: np.ndarray) -> list[tuple[int, int]]:
        sure = matches >= SURE * SIGNATURE
        return [m for pair in zip(one[sure].tolist(), two[sure].tolist(), strict=True) for m in self.link(*pair)]


class Confirmed(Likely):
    """Pairs that are linked by their full sets, as few as join their components; no other pair of these is linked."""

    def __init__(self, cols: dict):
        super().__init__(cols)
        self.sets = [np.frombuffer(x, np.uint64) for x in cols["shingles"]]

    def take(self, one: np.ndarray, two: np.ndarray, matches: np.ndarray) -> list[tuple[int, int]]:
        merged = []
        order = np.lexsort((-matches, one))
        one, two = one[order], two[order]
        begins = np.flatnonzero(np.diff(one, prepend=-1))
        for begin, end in zip(begins.tolist(), np.append(begins, len(one))[1:].tolist(), strict=True):
            i, count = int(one[begin]), AT_ONCE[0]
            while begin < end:
                part = [j for j in two[begin:min(begin + count, end)].tolist() if self.apart(i, j)]
                if part:
                    linked = linked_to(self.sets[i], [self.sets[j] for j in part])
                    merged += [m for j, yes in zip(part, linked.tolist(), strict=True) if yes for m in self.link(i, j)]
                begin, count = begin + count, AT_ONCE[1]
        return merged


def own_pairs(bucket, one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Whether the bucket is that of the first band in which ``one`` and ``many`` agree, by the bands' low 32 bits."""
    first = (one == many).argmax(1)
    return many[np.arange(len(many)), first] == bucket


def large_chunk(bucket, begin: int, end: int, cols: dict, taker) -> None:
    """Show the surviving pairs of one chunk to ``taker``; ``probe`` marks the members that are compared with all others.

    ``bucket`` is None for a group of several buckets, which owns all its pairs.
    """
    size, sign, marks, probe = (cols[c][begin:end] for c in ("size", "sign", "marks", "probe"))
    comp, rows = taker.roots(cols["comp"][begin:end]), np.arange(end - begin)
    for i in np.flatnonzero(probe).tolist():
        later = np.flatnonzero((comp != comp[i]) & (~probe | (rows > i)))
        fits = (np.minimum(size[later], size[i]) * 100 >= PERCENT * np.maximum(size[later], size[i]))
        later = later[fits]
        if bucket is not None:
            later = later[own_pairs(bucket, marks[i], marks[later])]
        alive, matches = similar(sign[i], sign[later])
        # Members joined to this one are not compared with it again.
        for old, new in taker.take(np.full(len(alive), begin + i), begin + later[alive], matches):
            comp[comp == old] = new


def small_chunks(rows: np.ndarray, chunk: np.ndarray, wide: np.ndarray, cols: dict, taker) -> None:
    """The same for the rows of many small chunks at once: their pairs are compared row by row."""
    size, sign, marks, probe, comp = (cols[c] for c in ("size", "sign", "marks", "probe", "comp"))
    first = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]]))
    length = np.diff(np.append(first, len(chunk)))
    reps = np.repeat(length, length) - (np.arange(len(chunk)) - np.repeat(first, length)) - 1
    left = np.repeat(np.arange(len(chunk)), reps)
    right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(reps) - reps, reps)
    owns_all = wide[left]
    left, right = rows[left], rows[right]
    keep = (comp[left] != comp[right]) & (probe[left] | probe[right]) & (
        np.minimum(size[left], size[right]) * 100 >= PERCENT * np.maximum(size[left], size[right]))
    left, right, owns_all = left[keep], right[keep], owns_all[keep]
    own = owns_all | own_pairs(cols["key"][left, 0].astype(np.uint32), marks[left], marks[right])
    left, right = left[own], right[own]
    for i in range(0, len(left), 200_000):
        alive, matches = similar(sign[left[i:i + 200_000]], sign[right[i:i + 200_000]])
        taker.take(left[i + alive], right[i + alive], matches)


def first_of_each(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The batch without later rows of the same text."""
    _, first = np.unique(batch.column(0).to_numpy(), return_index=True)
    return batch if len(first) == batch.num_rows else batch.take(pa.array(np.sort(first)))


def signatures(texts: DataFrame) -> DataFrame:
    """Set size, set digest, signature, band marks and band keys of the distinct texts (``text_id``, ``text``)."""
    short_batches(texts.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = first_of_each(batch)
            sets = [shingle_set(t) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            low = np.array([min_hashes(s) if len(s) else np.zeros(SIGNATURE, np.uint32) for s in sets], np.uint32).reshape(len(sets), SIGNATURE)
            signs = ((low * np.uint32(2654435761)) >> np.uint32(24)).astype(np.uint8)
            keys = band_keys(low)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.array([s.tobytes() for s in signs], pa.binary()),
                pa.array([k.tobytes() for k in keys.astype(np.uint32)], pa.binary()), pa.array(list(keys), pa.list_(pa.int64())),
            ], names=["row", "size", "digest", "sign", "marks", "bands"])
        # The worker goes on to other work, so it keeps no words.
        word_hashes().clear()

    rows = texts.mapInArrow(run, "row long, size long, digest binary, sign binary, marks binary, bands array<long>")
    return rows.dropDuplicates(["row"])


MEMBER = "bucket long, chunk int, node long, comp long, size long, sign binary, marks binary, probe boolean"


def _in_chunks(members: DataFrame, schema: str, result: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """``result`` of whole chunks of members, some at a time; a chunk lies in one task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            count, size = count + batch.num_rows, size + batch.nbytes
            if count < 2 * CHUNK and size < 16 * CHUNK_SHINGLES:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            bucket, chunk = table["bucket"].to_numpy(), table["chunk"].to_numpy()
            # The last chunk may go on in the next batch.
            ended = np.flatnonzero((bucket != bucket[-1]) | (chunk != chunk[-1]))
            whole = int(ended[-1]) + 1 if len(ended) else 0
            if whole:
                yield from result(table.slice(0, whole)).to_batches()
            held = table.slice(whole).to_batches()
            count, size = len(table) - whole, sum(b.nbytes for b in held)
        if count:
            yield from result(pa.Table.from_batches(held)).to_batches()

    dealt = members.repartition("bucket", "chunk").sortWithinPartitions("bucket", "chunk", "node")
    return dealt.mapInArrow(run, schema)


def _compared(table: pa.Table, kind: type):
    """A taker of ``kind`` that was shown the surviving pairs of all chunks of the table."""
    cols = {c: table[c].to_numpy() for c in ("node", "comp", "size", "probe")}
    cols["key"] = np.stack([table["bucket"].to_numpy(), table["chunk"].to_numpy()], 1)
    cols["sign"] = np.frombuffer(b"".join(table["sign"].to_pylist()), np.uint8).reshape(-1, SIGNATURE)
    cols["marks"] = np.frombuffer(b"".join(table["marks"].to_pylist()), np.uint32).reshape(-1, BANDS)
    if "shingles" in table.column_names:
        cols["shingles"] = table["shingles"].to_pylist()
    key, taker = cols["key"], kind(cols)
    first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(1)]))
    length = np.diff(np.append(first, len(key)))
    each = np.repeat(np.arange(len(first)), length)
    # Chunks of few members go together.
    few, wide = (length <= 24)[each], key[:, 1] < 0
    if few.any():
        small_chunks(np.flatnonzero(few), each[few], wide[few], cols, taker)
    for f, n in zip(first.tolist(), length.tolist(), strict=True):
        if n > 24:
            large_chunk(None if wide[f] else key[f, 0].astype(np.uint32), f, f + n, cols, taker)
    return taker


def _pairs(taker) -> pa.Table:
    found = sorted(set(taker.links))
    return pa.table({"a": pa.array([p[0] for p in found], pa.int64()), "b": pa.array([p[1] for p in found], pa.int64())})


def _likely(members: DataFrame) -> DataFrame:
    """Pairs (a, b) that are likely links, as few as join the members of each chunk."""
    return _in_chunks(members, "a long, b long", lambda t: _pairs(_compared(t, Likely))).distinct()


def _links(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) linked by their full sets, as few as join the components that meet in each chunk.

    Members with a surviving pair are found first, so that only these carry their sets.
    """
    left = pinned(_in_chunks(members, MEMBER, lambda t: t.filter(pa.array(_compared(t, Survivors).rows))), "survivors")
    sets = pinned(_sets_of(texts, pinned(left.select("node").distinct(), "wanted")), "sets")
    return _in_chunks(left.join(sets, "node").select(*left.columns, "shingles"), "a long, b long", lambda t: _pairs(_compared(t, Confirmed))).distinct()


def _sets_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Shingle sets of the wanted texts, one each."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = first_of_each(batch)
            sets = [shingle_set(t).tobytes() for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "shingles"])
        word_hashes().clear()

    side = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    rows = texts.join(side, texts["row"] == side["node"], "left_semi").select("row", "text")
    return rows.mapInArrow(run, "node long, shingles binary").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs with ``linked``: whether the full sets are similar enough."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for one, two in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long, linked boolean")


def text_components(texts: DataFrame, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Signatures of all texts (``row``, ``text``) and the (node, component) of those linked with another."""
    signs = pinned(signatures(texts), "signatures")
    # Equal sets are one class, named by its smallest row.
    classes = signs.filter("size > 0").groupBy("digest", "size").agg(F.min("row").alias("node"))
    links = pinned(signs.join(classes, ["digest", "size"]).filter("row != node").select(F.col("row").alias("a"), F.col("node").alias("b")), "links")
    reps = signs.join(classes.select(F.col("node").alias("row")), "row", "left_semi").select(F.col("row").alias("node"), "size", "sign", "marks", "bands")
    rows = reps.select("node", F.explode("bands").alias("bucket"))
    buckets = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("pivot")).filter("n > 1")
    chunks = F.ceil(F.col("n") / chunk)
    shared = F.pmod(F.xxhash64("node", F.lit(2)), F.greatest(F.floor(F.col("n") / PIVOTS), F.lit(1))) == 0
    own = F.when((F.col("node") == F.col("pivot")) | shared, F.sequence(F.lit(0), (chunks - 1).cast("int"))).otherwise(
        F.array(F.pmod(F.xxhash64("node"), chunks).cast("int")))
    dealt = pinned(rows.join(buckets, "bucket").select("bucket", "n", "pivot", "node", own.alias("chunks")), "buckets")
    narrow = pinned(reps.join(dealt.select("node").distinct(), "node", "left_semi").select("node", "size", "sign", "marks"), "narrow")
    alike = overlapping(dealt)
    groups = pinned(wide_groups(dealt, chunk, alike), "groups")
    apart = pinned(dealt.filter(F.col("n") <= chunk).join(alike, "pivot", "left_anti"), "apart")
    state = narrow.select("node", F.col("node").alias("comp"))
    sized = narrow.select("node", "size")
    # First every member of a chunk is compared with every other; the pivots are in all chunks.
    members = dealt.withColumn("comp", F.col("node")).withColumn("probe", F.lit(True)).withColumn("chunk", F.explode("chunks"))
    pairs = pinned(_likely(_with_signs(members, narrow)), "pairs")
    if not pairs.isEmpty():
        wanted = pinned(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "wanted")
        sets = pinned(_sets_of(texts, wanted), "sets")
        state = _merged(state, _confirmed(pairs, sets).filter("linked").select("a", "b"))
    # Then what is still apart, all of it.
    members = _open_members(apart.join(state, "node"), sized, chunk).unionByName(_open_groups(groups.join(state, "node"), sized, chunk))
    state = _merged(state, _links(_with_signs(members, narrow), texts))
    # Classes of equal sets carry the component of their smallest row.
    spread = links.select(F.col("a").alias("row"), F.col("b").alias("node")).join(state, "node", "left")
    spread = spread.select(F.col("row").alias("node"), F.coalesce("comp", "node").alias("component"))
    return signs, state.select("node", F.col("comp").alias("component")).unionByName(spread)


def _with_signs(members: DataFrame, narrow: DataFrame) -> DataFrame:
    members = members.select("bucket", "chunk", "node", "comp", "probe").join(narrow, "node")
    return members.select("bucket", "chunk", "node", "comp", "size", "sign", "marks", "probe")


def _merged(state: DataFrame, links: DataFrame) -> DataFrame:
    """The components of all nodes (node, comp) with new links; only those between components are contracted."""
    one, two = state.select(F.col("node").alias("a"), F.col("comp").alias("x")), state.select(F.col("node").alias("b"), F.col("comp").alias("y"))
    between = links.join(one, "a").join(two, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    merged = components(between).select(F.col("node").alias("comp"), "component")
    return pinned(state.join(merged, "comp", "left").select("node", F.coalesce("component", "comp").alias("comp")), "state")


def overlapping(dealt: DataFrame) -> DataFrame:
    """The smallest members whose buckets have, as one group, no more than ``OVERLAP`` times the pairs that they have apart."""
    apart = dealt.filter("node = pivot").groupBy("pivot").agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("apart"))
    whole = dealt.select("pivot", "node").distinct().groupBy("pivot").agg(F.count(F.lit(1)).cast("double").alias("whole"))
    return apart.join(whole, "pivot").filter(F.col("whole") * F.col("whole") <= OVERLAP * F.col("apart")).select("pivot")


def wide_groups(dealt: DataFrame, chunk: int, alike: DataFrame | None = None) -> DataFrame:
    """(pivot, node, n): the members of all buckets that share their smallest member, each once; of buckets of more than one
    chunk, and of any size where the smallest member is among ``alike``.

    The smallest member is a MinHash of the bucket, so two buckets share it as likely as they are similar, and a
    group has no more buckets than its smallest member has bands.
    """
    rows = dealt.filter(F.col("n") > chunk).select("pivot", "node")
    if alike is not None:
        rows = rows.unionByName(dealt.join(alike, "pivot", "left_semi").select("pivot", "node"))
    rows = rows.distinct()
    return rows.join(rows.groupBy("pivot").agg(F.count(F.lit(1)).alias("n")), "pivot")


def _again(marked: DataFrame, key: str, sized: DataFrame | None) -> DataFrame:
    """The buckets or groups with outsiders, how many, and the shingles of the outsiders and of all members (``sized``)."""
    seen = marked.withColumn("size", F.lit(0)) if sized is None else marked.join(sized, "node")
    counts = seen.groupBy(key).agg(
        F.count_if("probe").alias("outside"), F.sum(F.when(F.col("probe"), F.col("size"))).alias("outside_size"), F.sum("size").alias("whole_size"))
    return counts.filter("outside > 0")


def _in_blocks(marked: DataFrame, chunk: int) -> DataFrame:
    """Deal members so that every outsider (``probe``) meets all: a block of outsiders and a part of the members form
    one ``chunk``.
    """
    half, half_size = max(1, chunk // 2), CHUNK_SHINGLES // 2
    blocks = F.ceil(F.greatest(F.col("outside") / half, F.col("outside_size") / half_size)).cast("int")
    parts = F.ceil(F.greatest(F.col("n") / half, F.col("whole_size") / half_size)).cast("int")
    block = F.pmod(F.xxhash64("node", F.lit(1)), blocks).cast("int")
    part = F.pmod(F.xxhash64("node"), parts).cast("int")
    # An outsider goes to its block in every part, any other member to its part in every block.
    as_probe = F.transform(F.sequence(F.lit(0), parts - 1), lambda p: p * blocks + block)
    as_member = F.transform(F.sequence(F.lit(0), blocks - 1), lambda b: part * blocks + b)
    to = F.when(F.col("probe"), F.array_distinct(F.concat(as_probe, as_member))).otherwise(as_member)
    return marked.withColumn("chunk", F.explode(to)).select("bucket", "chunk", "node", "comp", "probe")


def _open_members(members: DataFrame, sized: DataFrame | None, chunk: int) -> DataFrame:
    """Members of buckets with several components; outsiders are those apart from the component of the pivot."""
    pivots = members.filter("node = pivot").select("bucket", F.col("comp").alias("main"))
    marked = members.join(pivots, "bucket").withColumn("probe", F.col("comp") != F.col("main"))
    return _in_blocks(marked.join(_again(marked, "bucket", sized), "bucket"), chunk)


def _open_groups(members: DataFrame, sized: DataFrame | None, chunk: int) -> DataFrame:
    """Members of groups of buckets; outsiders are those apart from the group's largest component.

    Their chunks have negative numbers, as they own all their pairs.
    """
    sizes = members.groupBy("pivot", "comp").agg(F.count(F.lit(1)).alias("size"))
    mains = sizes.groupBy("pivot").agg(F.max_by("comp", F.struct("size", "comp")).alias("main"))
    marked = members.join(mains, "pivot").withColumn("probe", F.col("comp") != F.col("main"))
    marked = marked.join(_again(marked, "pivot", sized), "pivot").withColumnRenamed("pivot", "bucket")
    return _in_blocks(marked, chunk).withColumn("chunk", -1 - F.col("chunk"))


def numbered(docs: DataFrame) -> DataFrame:
    """``row``, the number of a row's text, and ``text``."""
    return docs.select(text_number(F.col("text")).alias("row"), "text")


def text_number(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def labels(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Per text number: set size, component, and the smallest doc_id of the component."""
    signs, comps = text_components(numbered(docs), chunk)
    sized = signs.select("row", "size").join(comps.withColumnRenamed("node", "row"), "row", "left")
    sized = pinned(sized.withColumn("component", F.coalesce("component", "row")), "sized")
    ids = docs.select(text_number(F.col("text")).alias("row"), "doc_id")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id")
    # One id for each text first, so a text with many copies is combined ahead of the join.
    lowest = ids.groupBy("row").agg(F.min(order).alias("low"))
    low = lowest.join(sized, "row").groupBy("component").agg(F.min("low").alias("low"))
    return pinned(sized.join(low, "component").select("row", "size", "component", F.col("low.doc_id").alias("low_id")), "labels")


def near_groups(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    rows = docs.select("doc_id", text_number(F.col("text")).alias("row"))
    group = F.when(F.col("size") > 0, F.col("low_id")).otherwise(F.col("doc_id"))
    found = rows.join(labels(docs, chunk), "row").withColumn("component_id", group)
    return found.select(
        "doc_id", F.col("size").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents, all columns, with one row of each group; documents without words stay."""
    rows = docs.select(F.struct("*").alias("doc"), text_number(F.col("text")).alias("row"))
    kept = rows.join(labels(docs), "row").filter((F.col("size") == 0) | F.col("doc.doc_id").eqNullSafe(F.col("low_id")))
    # Rows that repeat the id that stays: one of them is kept.
    part = F.when(F.col("size") > 0, F.col("component"))
    nth = F.row_number().over(Window.partitionBy("component", "low_id").orderBy("row"))
    grouped = kept.filter(part.isNotNull()).withColumn("nth", nth).filter("nth = 1")
    return grouped.select("doc").unionByName(kept.filter("size = 0").select("doc")).select("doc.*")
