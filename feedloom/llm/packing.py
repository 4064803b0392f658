"""Best-fit packing by hierarchical residuals.

Each partition tokenises its documents, cuts those longer than a sequence and packs the rest best-fit
into bins, a block of pieces at a time. Bins that are nearly full are done. All underfull bins become the items of
the next level, which packs them best-fit over the whole corpus: where an item goes depends only on its size and its
number among those of its size, so the driver plans from the count of each size, at most one per place of a
sequence, and the tasks look their items up. No task or driver holds more than its block and the plan, and no two
underfull bins that fit into one sequence stay apart. The pieces stay where they were written and
learn their item numbers by one join with the sizes of their block.

Defined cases: null and empty texts are the closing id alone. Repeated rows, and repeated or null
ids, are packed as documents of their own. An empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import short_batches
from feedloom.session import pinned

SEQUENCE = 2048
END_ID = 0
# A bin with at most so many free places is done.
SLACK = 16
BLOCK_ITEMS = 50_000
# Bins of a partition count from its number, merged ones from above all of those.
BIN_BITS, MERGED = 33, 1 << 62
RANK_BITS = 48
CACHE_WORDS = 450_000
LEARN_WORDS = 4_000
WORD_END = "</w>"

# Letters or digits followed by ASCII marks other than the apostrophe.
TAIL = re.compile(rb"(.*[A-Za-z0-9])([!-&(-/:-@\[-`{-~]+)", re.DOTALL).fullmatch


class WordEncoder:
    """Ids of texts, word by word: the tokenizer drops white space and never spans it."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        probe = " The quick-brown\tfox's \n 12 été, "
        whole = self.tokenizer.encode(probe, add_special_tokens=False).ids
        apart = [i for w in probe.split() for i in self.tokenizer.encode(w, add_special_tokens=False).ids]
        if whole != apart:
            raise ValueError("only tokenizers that split at white space are handled")
        vocabulary = self.tokenizer.get_vocab()
        # Ids of tokens that end a word; words of letters alone have one each, at their end.
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.cache: dict[bytes, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn_letters(self, words: list[bytes]) -> None:
        """Words of letters, encoded as one text and told apart by the tokens that end a word."""
        ids = self._ids(b" ".join(words).decode())
        ends = 4 * (np.flatnonzero(self.ends[ids]) + 1)
        if len(ends) != len(words):
            self._learn_apart(words)
            return
        data, ends = ids.tobytes(), ends.tolist()
        self.cache.update(zip(words, map(data.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))

    def _learn_apart(self, words: list[bytes]) -> None:
        found = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        self.cache.update(zip(words, [np.array(e.ids, "<u4").tobytes() for e in found], strict=True))

    def _learn(self, words: list[bytes]) -> None:
        """Add new words to the cache. A tail of plain marks is a token group of its own and is looked up apart."""
        tails = {w: m for w in words if w[-1] < 0x80 and not w[-1:].isalnum() and b"<|" not in w and (m := TAIL(w))}
        parts = {m[g] for m in tails.values() for g in (1, 2)} | {w for w in words if w not in tails}
        new = list(parts - self.cache.keys())
        letters = [w for w in new if w.isalpha() or w.decode().isalpha()]
        for i in range(0, len(letters), LEARN_WORDS):
            self._learn_letters(letters[i:i + LEARN_WORDS])
        self._learn_apart(list(set(new).difference(letters)))
        for w, m in tails.items():
            self.cache[w] = self.cache[m[1]] + self.cache[m[2]]

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        # The tokenizer lower-cases; special tokens keep their case and are left alone.
        cut = [(t if b"<|" in t else t.lower()).split() for t in texts]
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        missing = list(set().union(*cut) - self.cache.keys())
        for i in range(0, len(missing), 20_000):
            self._learn(missing[i:i + 20_000])
        get = self.cache.__getitem__
        return [b"".join(map(get, words)) for words in cut]


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def best_fit(sizes: np.ndarray, capacity: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the size of each bin: largest first, each into the fullest bin it fits."""
    bins = np.empty(len(sizes), np.int64)
    offsets = np.empty(len(sizes), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, used = 0, []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = mask >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                mask &= ~(1 << room)
        else:
            b, room = len(used), capacity
            used.append(0)
        bins[i], offsets[i] = b, used[b]
        used[b] += size
        room -= size
        if room:
            free[room].append(b)
            mask |= 1 << room
    return bins, offsets, np.array(used, np.int64)


def left_open(used: np.ndarray, capacity: int) -> np.ndarray:
    """Bins that go on: all underfull ones."""
    return used < capacity - SLACK


def rank_in_size(sizes: np.ndarray) -> np.ndarray:
    """Number of each item among those of its size, from 0."""
    order = np.argsort(sizes, kind="stable")
    _, begin, count = np.unique(sizes[order], return_index=True, return_counts=True)
    ranks = np.empty(len(sizes), np.int64)
    ranks[order] = np.arange(len(sizes)) - np.repeat(begin, count)
    return ranks


def best_fit_plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """``best_fit`` of any number of items, from how many there are of each size.

    Rows of (size, first rank, items of a bin, first bin, offset), by size and rank: item ``rank`` of a size, by the
    last row at or before it, goes into bin ``first bin + (rank - first rank) // items`` behind those of its bin
    with a smaller rank. Bins of one room are kept as ranges of numbers, so the work and the plan grow with the
    sizes there are, not with the items.
    """
    free: dict[int, list[tuple[int, int]]] = {}
    plan, bins = [], 0
    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            room = min((r for r in free if r >= size), default=0)
            if room:
                first, n = free[room].pop()
                if not free[room]:
                    del free[room]
            else:
                room, first, n = capacity, bins, -(-left // (capacity // size))
                bins += n
            # A bin takes as many as fit before the next one gets any; the last one may get fewer.
            each = min(room // size, left)
            full = min(n, left // each)
            rest = 0 if full == n else left - full * each
            taken = full * each + rest
            plan.append((size, rank, each, first, capacity - room))
            rank, left = rank + taken, left - taken
            for begin, number, used in ((first, full, each * size), (first + full, 1 if rest else 0, rest * size), (first + full + (rest > 0), n - full - (rest > 0), 0)):
                if number > 0 and room > used:
                    free.setdefault(room - used, []).append((begin, number))
    return np.array(sorted(plan), np.int64).reshape(-1, 5)


class _Block:
    """Pieces of one partition until they are packed."""

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def __init__(self, partition: int, id_type: pa.DataType, capacity: int):
        self.next_bin, self.id_type, self.capacity = partition << BIN_BITS, id_type, capacity
        self.rows: list[list] = [[] for _ in self.names]

    def add(self, doc_id, data: bytes) -> None:
        step = 4 * self.capacity
        for piece, begin in enumerate(range(0, len(data), step)):
            part = data[begin:begin + step]
            for column, x in zip(self.rows, (doc_id, piece, begin // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                column.append(x)

    def packed(self) -> pa.RecordBatch:
        length = np.array(self.rows[3], np.int64)
        bins, offsets, used = best_fit(length, self.capacity)
        goes_on, ranks, block = left_open(used, self.capacity), rank_in_size(used), self.next_bin
        kinds = [self.id_type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        arrays = [pa.array(x, k) for x, k in zip(self.rows, kinds, strict=True)]
        arrays += [pa.array(bins + self.next_bin), pa.array(offsets), pa.array(used[bins]), pa.array(goes_on[bins]), pa.array(ranks[bins]), pa.array(np.full(len(bins), block))]
        self.next_bin += len(used)
        self.rows = [[] for _ in self.names]
        return pa.RecordBatch.from_arrays(arrays, names=[*self.names, "bin", "place", "bin_size", "open", "rank", "block"])


def local_pieces(docs: DataFrame, path: str, capacity: int) -> DataFrame:
    """Pieces of all documents, packed within their partition; written once, so bins keep their numbers."""
    short_batches(docs.sparkSession)
    closing = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = None
        encode = word_encoder(path)
        for batch in batches:
            block = block or _Block(TaskContext.get().partitionId(), batch.column(0).type, capacity)
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            for doc_id, data in zip(batch.column(0).to_pylist(), encode(texts), strict=True):
                block.add(doc_id, data + closing)
            if len(block.rows[0]) >= BLOCK_ITEMS:
                yield block.packed()
        if block and block.rows[0]:
            yield block.packed()
        # The worker goes on to other work, so it keeps no words.
        encode.cache.clear()

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return pinned(rows.mapInArrow(run, (
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, "
        "bin long, place long, bin_size long, open boolean, rank long, block long"
    )), "pieces")


def pack(docs: DataFrame, path: str, capacity: int = SEQUENCE) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    pieces = local_pieces(docs, path, capacity)
    sizes = pieces.filter("open and place = 0").groupBy("block", "bin_size").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("bin_size").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = pinned(sizes.select("block", "bin_size", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead")), "sizes")
    counts = {r["bin_size"]: r["n"] for r in sizes.groupBy("bin_size").agg(F.sum("n").alias("n")).collect()}
    plan = best_fit_plan(counts, capacity)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One number orders (size, rank).
        starts = (plan[:, 0] << RANK_BITS) + plan[:, 1]
        for batch in batches:
            *kept, bins, place, size, ahead, rank = batch.columns
            ahead = ahead.fill_null(-1).to_numpy(zero_copy_only=False)
            bins, place = bins.to_numpy().copy(), place.to_numpy().copy()
            on = np.flatnonzero(ahead >= 0)
            size, number = size.to_numpy()[on], ahead[on] + rank.to_numpy()[on]
            if len(on):
                row = plan[np.searchsorted(starts, (size << RANK_BITS) + number, "right") - 1]
                number = number - row[:, 1]
                bins[on] = MERGED + row[:, 3] + number // row[:, 2]
                place[on] += row[:, 4] + number % row[:, 2] * size
            yield pa.RecordBatch.from_arrays([*kept, pa.array(bins), pa.array(place)], names=[*_Block.names, "sequence_id", "offset"])

    opened = sizes.select("block", "bin_size", "ahead")
    rows = pieces.join(opened, ["block", "bin_size"], "left").select(*_Block.names, "bin", "place", "bin_size", "ahead", "rank")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
