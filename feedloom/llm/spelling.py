"""Spelling variants by Bloom-guided neighbourhoods.

Words of the corpus are counted; those that are long and frequent enough are the vocabulary. Two are near if one
inserted, deleted or replaced code point makes one of the other. Each word generates its deletions, and the
replacements by a greater letter: an insertion is a deletion seen from the other word, a replacement by a smaller
letter one by a greater. Every generated edit is probed in a Bloom filter of the words of its length, of one 64-bit
block per key. Only the few positives are written out and joined with the vocabulary, which removes the false ones.

The filters are broadcast and bounded: a round holds those of at most ``ROUND_WORDS`` words, and a larger vocabulary
takes several rounds over hashed parts of it, each against all words. Hashes are polynomials over the letters, so the
hash of an edit follows from the word's in a few operations of numpy on whole batches. The letters are the 26 and those
of U+00C0 to U+00FF, so a word is one byte per letter.

A word's form is its most frequent near word, if that is at least twice as frequent. Counts at least double along
forms, so chains are short; they are followed by pointer doubling.

Defined cases: a null text has no words; a null id reads as empty text. Repeated rows count each. Ties between forms go
to the smaller word. An empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import short_batches
from feedloom.session import pinned

LETTERS = 5
OCCURRENCES = 3
DROP_ONE_IN = 97
FLUSH_WORDS = 300_000
# Words whose filters are broadcast at once: 2 bytes each, or 8 for the few long ones.
ROUND_WORDS = 8_000_000
# Words of so many letters and more share one filter, which has a block per word, as they have more edits.
LONG = 32
WORDS_PER_BLOCK = 4
FLUSH_LETTERS = 4_000_000
# In Latin-1: A-Z become a-z, what is no letter becomes a space.
FOLD = bytes(c if 0x61 <= c <= 0x7A or c >= 0xC0 else c + 0x20 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def word_counts(docs: DataFrame) -> DataFrame:
    """word and its count ``n``; one in 97 pairs of document and word loses a letter, by a checksum of the pair."""
    short_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            words = [w.decode("latin-1") for w in seen]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

        seen: dict[bytes, int] = {}
        crc = zlib.crc32
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                start = crc(f"{doc_id}:".encode())
                for w, c in Counter((text or "").encode("latin-1", "replace").translate(FOLD).split()).items():
                    if len(w) < LETTERS:
                        continue
                    h = crc(w if w.isascii() else w.decode("latin-1").encode(), start)
                    if h % DROP_ONE_IN == 0:
                        at = h % len(w)
                        w = w[:at] + w[at + 1:]
                    seen[w] = seen.get(w, 0) + c
            if len(seen) > FLUSH_WORDS:
                yield out()
                seen = {}
        if seen:
            yield out()

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame) -> DataFrame:
    return word_counts(docs).filter((F.length("word") >= LETTERS) & (F.col("n") >= OCCURRENCES))


_RANDOM = np.random.default_rng(11)
LETTER = _RANDOM.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
STEP = int(_RANDOM.integers(1, 1 << 62)) * 2 + 1
STEP_BACK = np.uint64(pow(STEP, -1, 1 << 64))


class Flat:
    """Letters of some words in one array, with the hash of each word and of its parts."""

    def __init__(self, words: list[str]):
        self.letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.word = np.repeat(np.arange(len(words)), self.sizes)
        self.place = np.arange(len(self.letters)) - self.starts[self.word]
        steps = np.full(self.sizes.max(initial=1), STEP, np.uint64)
        steps[0] = 1
        self.power = np.cumprod(steps)[self.place]
        self.term = LETTER[self.letters] * self.power
        whole = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.term)])
        # Letters of the word ahead of each place, and all of them.
        self.ahead = whole[:-1] - whole[self.starts][self.word]
        self.hash = whole[self.starts + self.sizes] - whole[self.starts]

    def deletions(self) -> tuple[np.ndarray, np.ndarray]:
        """Places whose letter goes, one of each run of a letter, and the hashes left."""
        same_next = np.zeros(len(self.letters), bool)
        same_next[:-1] = (self.letters[:-1] == self.letters[1:]) & (self.word[:-1] == self.word[1:])
        at = np.flatnonzero(~same_next)
        behind = self.hash[self.word[at]] - self.ahead[at] - self.term[at]
        return at, self.ahead[at] + behind * STEP_BACK


def spots(hashes: np.ndarray, offset: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Block and bits of each hash in the filters of its length."""
    h = hashes ^ (hashes >> np.uint64(32))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    block = offset + ((h >> np.uint64(32)) * blocks >> np.uint64(32))
    bits = np.zeros(len(h), np.uint64)
    for k in range(5):
        bits |= np.uint64(1) << (h >> np.uint64(6 * k) & np.uint64(63))
    return block.astype(np.int64), bits


def filter_places(sizes: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of the filter of each length, from the number of words of each."""
    blocks = np.ones(LONG + 1, np.uint64)
    for size, n in sizes.items():
        blocks[size] = max(1, n if size == LONG else -(-n // WORDS_PER_BLOCK))
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(blocks)[:-1]]).astype(np.uint64), blocks


def bloom_filter(words: DataFrame, offset: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The blocks of all lengths behind one another, combined from what the tasks set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = Flat(batch.column(0).to_pylist())
            size = np.minimum(flat.sizes, LONG)
            block, bits = spots(flat.hash, offset[size], blocks[size])
            yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(bits.view(np.int64))], names=["block", "bits"])

    rows = words.select("word").mapInArrow(run, "block long, bits long").groupBy("block").agg(F.bit_or("bits").alias("bits")).toArrow()
    found = np.zeros(int(blocks.sum()), np.uint64)
    found[rows["block"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return found


def probed(words: DataFrame, alphabet: bytes, held, offset: np.ndarray, blocks: np.ndarray) -> DataFrame:
    """(word, n, near): edits that the filter may hold, of every word."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value

        def meets(hashes: np.ndarray, size: np.ndarray) -> np.ndarray:
            block, bits = spots(hashes, offset[size], blocks[size])
            return np.flatnonzero(table[block] & bits == bits)

        def out(rows: list[tuple[str, int, str]]) -> pa.RecordBatch:
            word, n, near = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(n, pa.int64()), pa.array(near, pa.string())], names=["word", "n", "near"])

        for batch in batches:
            words, counts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            flat = Flat(words)
            rows, letters = [], 0
            at, hashes = flat.deletions()
            at = at[meets(hashes, np.minimum(flat.sizes[flat.word[at]] - 1, LONG))]
            # Places by letter: those with a smaller letter than the new one come first.
            order = np.argsort(flat.letters, kind="stable")
            ranked, power, word = flat.letters[order], flat.power[order], flat.word[order]
            size, rest = np.minimum(flat.sizes[word], LONG), flat.hash[word] - flat.term[order]
            edits = [(at, "")]
            for letter in alphabet:
                k = np.searchsorted(ranked, letter)
                edits.append((order[meets(rest[:k] + LETTER[letter] * power[:k], size[:k])], chr(letter)))
            for at, new in edits:
                for w, i in zip(flat.word[at].tolist(), flat.place[at].tolist(), strict=True):
                    rows.append((words[w], counts[w], words[w][:i] + new + words[w][i + 1:]))
                    letters += 2 * len(words[w])
                    if letters > FLUSH_LETTERS:
                        yield out(rows)
                        rows, letters = [], 0
            if rows:
                yield out(rows)

    return words.select("word", "n").mapInArrow(run, "word string, n long, near string")


def near_pairs(spark: SparkSession, words: DataFrame, round_words: int = ROUND_WORDS) -> DataFrame:
    """(word, n, near, near_n) of near words, each pair once."""
    size = F.least(F.length("word"), F.lit(LONG))
    rounds = max(1, -(-words.count() // round_words))
    part = F.pmod(F.xxhash64("word"), F.lit(rounds)).cast("int")
    sizes = words.groupBy(part.alias("part"), size.alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).filter("letter <> ''").distinct().collect()
    alphabet = bytes(sorted(ord(r["letter"]) for r in letters))
    pairs = None
    for k in range(rounds):
        offset, blocks = filter_places({r["size"]: r["n"] for r in sizes if r["part"] == k})
        held = spark.sparkContext.broadcast(bloom_filter(words.filter(part == k), offset, blocks))
        found = pinned(probed(words, alphabet, held, offset, blocks), "edits")
        held.destroy()
        # Only words of this part are in its filter; an edit that another part holds as well is met there.
        exact = found.join(words.filter(part == k).select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
        pairs = exact if pairs is None else pairs.unionByName(exact)
    return pairs.select("word", "n", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word with a form; pointers double until none moves."""
    links = pinned(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = links.join(further, "root", "left")
        links = pinned(moved.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        if links.filter("moved").isEmpty():
            return links.select("word", "root")
        links = links.select("word", "root")


def variants(docs: DataFrame, round_words: int = ROUND_WORDS) -> DataFrame:
    """Every word of the vocabulary with its form, the root of its forms, and its number of near words."""
    spark = docs.sparkSession
    words = pinned(vocabulary(docs), "vocabulary")
    pairs = near_pairs(spark, words, round_words)
    both = pairs.select(F.explode(F.array(
        F.struct("word", "near", F.col("near_n").alias("m")), F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("m")),
    )).alias("p")).select("p.*")
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best"))
    is_form = -F.col("best.m") >= 2 * F.col("n")
    found = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.m")).alias("form_n"),
    )
    found = pinned(found, "variants")
    done = found.join(roots(found.filter("form is not null")), "word", "left")
    return done.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
