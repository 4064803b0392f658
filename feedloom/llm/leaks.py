"""Benchmark decontamination by one Aho-Corasick automaton over normalised test items.

Items (questions, answers) and documents are normalised alike: A-Z in lower case, words of ASCII letters, digits and
everything beyond ASCII, joined by single spaces. A window is ``window`` words of an item in a row, or the whole
item if it has fewer. All windows, with a space at either end, make one automaton, which a task builds once and runs
over each of its normalised documents once, whatever the number of items. The place of every word in the original
is kept, so the hit words come back as spans of the original text.

The automaton is built from item text that was counted first. Items are cut into segments that overlap by a
window less one word, so no window is lost; a set above ``SHARD_BYTES`` makes several automata, each of bounded size,
which go over the corpus one after another and add to what the earlier ones found.

Defined cases: a null or wordless text has no words and no hits; a null or wordless item has no windows. Items that
share an id count once; a null id reads as empty text. Repeated documents are scanned each. An empty table gives an
empty result, an empty benchmark no hits. Other columns of the documents pass through ``scan``, those of the items are unused.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import ascii_lower, short_batches
from feedloom.session import pinned

WINDOW = 10
# Item text of one automaton. A state for each byte of each window: about 600 bytes of memory for each byte here.
SHARD_BYTES = 400_000
SEGMENT_WORDS = 500
SPACE = 0x20
# Bytes of separators become spaces, A-Z become a-z; bytes of other characters stay.
FOLD = bytes(c if c >= 0x80 or chr(c).isalnum() else SPACE for c in range(256)).lower()

LEAK = "struct<n_words: bigint, n_hit: bigint, items: array<string>, spans: array<struct<start: bigint, end: bigint>>>"
LEAK_TYPE = pa.struct([
    ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
])


def item_segments(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, segment): normalised runs of words that together hold every window of an item."""
    clean = F.trim(F.regexp_replace(ascii_lower(F.col(text)), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.split(clean, " ").alias("words"))
    rows = rows.filter("words[0] <> ''")
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)), F.lit(SEGMENT_WORDS))
    cut = rows.select("item", F.explode(F.transform(
        starts, lambda i: F.array_join(F.slice("words", i + 1, F.lit(SEGMENT_WORDS + window - 1)), " "))).alias("segment"))
    return cut.distinct()


class Matcher:
    """The automaton of some segments."""

    def __init__(self, segments: Iterable[tuple[str, str]], window: int):
        import ahocorasick

        found: dict[str, tuple[int, set[str]]] = {}
        for item, segment in segments:
            words = segment.split(" ")
            for k in range(max(1, len(words) - window + 1)):
                part = words[k:k + window]
                # Bytes as characters: text in UTF-8 matches where its bytes do.
                key = f" {' '.join(part)} ".encode().decode("latin-1")
                found.setdefault(key, (len(part), set()))[1].add(item)
        self.automaton = ahocorasick.Automaton()
        for key, value in found.items():
            self.automaton.add_word(key, value)
        if found:
            self.automaton.make_automaton()
            self.iter = self.automaton.iter
        else:
            self.iter = lambda text: ()

    def __call__(self, text: bytes) -> dict:
        """Counts, items and spans of one text; spans count code points."""
        flat = np.frombuffer(text.translate(FOLD), np.uint8)
        word = flat != SPACE
        after = np.zeros_like(word)
        after[1:] = word[:-1]
        starts = np.flatnonzero(word & ~after)
        # One space ahead of the first word and one behind each word.
        normal = b" " + flat[word | after].tobytes() + b" " * int(word[-1:].sum())
        matches = list(self.iter(normal.decode("latin-1")))
        out = {"n_words": len(starts), "n_hit": 0, "items": [], "spans": []}
        if matches:
            spaces = np.flatnonzero(np.frombuffer(normal, np.uint8) == SPACE)
            last = np.searchsorted(spaces, [end for end, _ in matches])
            first = last - [n for _, (n, _) in matches]
            cover = np.zeros(len(starts) + 1, np.int64)
            np.add.at(cover, first, 1)
            np.add.at(cover, last, -1)
            hit = np.cumsum(cover[:-1]) > 0
            out["n_hit"] = int(hit.sum())
            out["items"] = sorted(set().union(*(items for _, (_, items) in matches)))
            edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
            stops = np.flatnonzero(np.append(after, word[-1]) & ~np.append(word, False))
            points = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
            begin, end = points[starts[edge[:-1] == 1]], points[stops[np.flatnonzero(edge == -1) - 1]]
            out["spans"] = [{"start": a, "end": b} for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
        return out


@lru_cache(maxsize=1)
def matcher(segments: tuple[tuple[str, str], ...], window: int) -> Matcher:
    return Matcher(segments, window)


def merged(text: bytes, one: dict, two: dict) -> dict:
    """What two automata found in one text. Spans with no word between them become one."""
    letters = text.decode()

    def words(start: int, end: int) -> int:
        return len(letters[start:end].encode().translate(FOLD).split())

    spans: list[dict] = []
    for s in sorted([*one["spans"], *two["spans"]], key=lambda s: (s["start"], s["end"])):
        if spans and (s["start"] <= spans[-1]["end"] or not words(spans[-1]["end"], s["start"])):
            spans[-1]["end"] = max(spans[-1]["end"], s["end"])
        else:
            spans.append(dict(s))
    hit = sum(words(s["start"], s["end"]) for s in spans)
    return {"n_words": one["n_words"], "n_hit": hit, "items": sorted({*one["items"], *two["items"]}), "spans": spans}


def scan(docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW, shard_bytes: int = SHARD_BYTES, out: str = "leak") -> DataFrame:
    """The documents with a struct ``out``: n_words, n_hit, ids of the items met, and the hit spans of the text."""
    spark = docs.sparkSession
    if out.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"the documents have a column {out} already")
    short_batches(spark)
    segments = pinned(item_segments(items, window=window), "segments")
    size = segments.agg(F.sum(F.octet_length("segment") + F.octet_length("item"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    place = F.pmod(F.xxhash64("item", "segment"), F.lit(shards))
    names = docs.columns
    result = docs
    for shard in range(shards):
        held = tuple((r["item"], r["segment"]) for r in segments.filter(place == shard).collect())

        def run(batches: Iterable[pa.RecordBatch], held=held, more=shard > 0) -> Iterator[pa.RecordBatch]:
            find = matcher(held, window)
            for batch in batches:
                texts = [t or b"" for t in batch.column(batch.schema.get_field_index(text)).cast(pa.binary()).to_pylist()]
                found = [find(t) for t in texts]
                if more:
                    found = [merged(t, a, b) for t, a, b in zip(texts, batch.column(len(names)).to_pylist(), found, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.array(found, LEAK_TYPE)], names=[*names, out])

        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
        result = result.mapInArrow(run, f"{kinds}, `{out}` {LEAK}")
        if shard + 1 < shards:
            result = pinned(result, "scanned")
    return result


def report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Per document: words, hit words, items met, their digest, and the spans as text."""
    rows = scan(docs.select("doc_id", "text"), items, **options)
    return rows.select(
        "doc_id", "leak.n_words", "leak.n_hit", F.size("leak.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("leak.items"), ","), 256).alias("items_sha256"), (F.col("leak.n_hit") > 0).alias("contaminated"),
        F.array_join(F.transform("leak.spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("spans"),
    )


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents that hold no window of any item, with their columns."""
    name = "leak"
    while name in (c.lower() for c in docs.columns):
        name += "_"
    return scan(docs, items, out=name).filter(f"`{name}`.n_hit = 0").select(*docs.columns)
