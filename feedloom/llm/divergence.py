"""Source divergence audit over exact term counts.

Texts are normalised to terms once and written apart by language. A ``CountVectorizer`` per language, with ``min_docs``
as minDF and the largest vocabSize there is, keeps every term of enough documents and turns each document into an exact
sparse vector. The vectors are summed per source as a summarizer does, into a buffer per source in each task, whose
cells are bounded; only what is not zero is shuffled, the sums of ``SUM_TERMS`` neighbouring terms as one row, so a hot
source is no more than one row per task and such block. Sorted by source and block, these meet in one array of a block.

A vocabulary passes through the driver, so it is kept to a bound: where a language may keep more than ``SLICE_TERMS``
terms, they are cut into hashed slices with a ``CountVectorizer`` each. Counts and sums add up over slices, so the
result does not depend on their number.

The divergence of two sources sums f over all terms. Terms that neither holds give a constant, terms of one alone depend
only on their probability there, so those are evaluated once for each distinct probability; what remains are corrections
at terms that both hold. Blocks of terms find these pairs in numpy, by the distance between the entries of one
term, and add them up at once, so no pair of a term becomes a row. All is 64-bit or decimal arithmetic on integers.

Defined cases: null texts, languages and sources read as ''. A group without terms has zero counts; a language
without kept terms gives pairs of value 0 and no terms; one with a single source gives no pairs. Repeated rows count
each. An empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.llm.common import short_batches
from feedloom.session import new_dir, pinned

MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
MAX_VOCABULARY = 2**31 - 1
SLICE_TERMS = 4_000_000
# Entries of a block of terms, and of sums of pairs that a task holds.
BLOCK_ENTRIES = 200_000
FLUSH_PAIRS = 500_000
# Cells of the sums of sparse vectors that a task holds: 8 bytes each.
SUM_CELLS = 12_000_000
# Terms whose sums travel as one row, 12 bytes each.
SUM_TERMS = 4096
OUT_ROWS = 100_000
SIZE_ONE_IN = 8
# No term is empty: this one keeps a vocabulary from being empty.
FILLER = ""
# Bytes that are no part of a term become spaces, A-Z become a-z.
FOLD = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256)).lower()

RESULT = "lang string, source string, part string, item string, value long, rank int"


def normalised(docs: DataFrame) -> DataFrame:
    """lang, source and the terms of each document with one space between them, all and each once."""
    short_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [t.translate(FOLD).split() for t in batch.column(2).cast(pa.binary()).to_pylist()]
            columns = [pa.array(map(b" ".join, x), pa.binary()).cast(pa.string()) for x in (terms, map(set, terms))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], names=["lang", "source", "terms", "distinct"])

    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return rows.mapInArrow(run, "lang string, source string, terms string, distinct string")


def expected_terms(texts: DataFrame, min_docs: int) -> dict[int, float]:
    """About how many terms a language keeps, from above; it sizes slices and decides no result.

    A term of ``min_docs`` documents is met among one in ``SIZE_ONE_IN`` of them with a known chance, so the
    terms met there, over this chance, are as many as the kept ones or more.
    """
    chance = 1 - (1 - 1 / SIZE_ONE_IN) ** min_docs
    met = texts.filter(F.rand(11) * SIZE_ONE_IN < 1).select("lang_no", F.explode(F.split("distinct", " ")).alias("term"))
    return {r["lang_no"]: r["n"] / chance for r in met.groupBy("lang_no").agg(F.approx_count_distinct("term").alias("n")).collect()}


def terms_of(column: str, slices: int, part: int) -> Column:
    """Terms of a document, or of one slice of them. A document without terms has the filler alone."""
    terms = F.split(column, " ")
    return terms if slices == 1 else F.filter(terms, lambda t: F.pmod(F.xxhash64(t), F.lit(slices)) == part)


def fitted(rows: DataFrame, min_docs: int) -> tuple[CountVectorizerModel, list[str], np.ndarray]:
    """The model of all terms of at least ``min_docs`` rows, these terms in the order of their UTF-8 bytes, the filler
    first, and the number in this order of each index of the model.
    """
    filler = rows.sparkSession.range(min_docs).select(F.array(F.lit(FILLER)).alias("terms"))
    model = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(min_docs), vocabSize=MAX_VOCABULARY).fit(rows.select("terms").unionByName(filler))
    found = model.vocabulary
    order = sorted(range(len(found)), key=lambda i: found[i].encode())
    numbers = np.empty(len(order), np.int32)
    numbers[order] = np.arange(len(order), dtype=np.int32)
    return model, [found[i] for i in order], numbers


class SumBuffer:
    """Sums of sparse vectors per source, in a dense array for each, up to a bound of cells."""

    def __init__(self, size: int):
        self.size, self.sums = size, {}

    def add(self, source: str, terms: np.ndarray, counts: np.ndarray) -> None:
        if source not in self.sums:
            self.sums[source] = np.zeros(self.size, np.int64)
        # A vector has each term once.
        self.sums[source][terms] += counts

    def full(self) -> bool:
        return len(self.sums) * self.size > SUM_CELLS

    def batches(self) -> Iterator[pa.RecordBatch]:
        for source, sums in self.sums.items():
            terms = np.flatnonzero(sums)
            # The filler is no term.
            terms = terms[terms > 0].astype(np.int32)
            cuts = np.flatnonzero(np.diff(terms // SUM_TERMS, prepend=-1))
            parts = np.split(terms, cuts[1:]) if len(terms) else []
            columns = ([source] * len(parts), [int(t[0]) // SUM_TERMS for t in parts], [t.tobytes() for t in parts], [sums[t].tobytes() for t in parts])
            kinds = (pa.string(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["source", "block", "terms", "counts"])
        self.sums = {}


def source_sums(rows: DataFrame, model: CountVectorizerModel, numbers: np.ndarray) -> DataFrame:
    """(source, block, terms, counts): the sums of the sparse vectors of each source in each task, a block of terms a row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = SumBuffer(len(numbers))
        for batch in batches:
            indices, values = batch.column(1), batch.column(2)
            ends = indices.offsets.to_numpy()
            terms, counts = numbers[indices.values.to_numpy()], values.values.to_numpy().astype(np.int64)
            for i, source in enumerate(batch.column(0).to_pylist()):
                held.add(source, terms[ends[i]:ends[i + 1]], counts[ends[i]:ends[i + 1]])
            if held.full():
                yield from held.batches()
        yield from held.batches()

    vector = F.unwrap_udt(F.col("vector"))
    entries = model.transform(rows).select("source", vector["indices"].alias("indices"), vector["values"].alias("counts"))
    return entries.mapInArrow(run, "source string, block int, terms binary, counts binary")


def added_sums(parts: DataFrame) -> DataFrame:
    """(lang_no, slice, source, term, n): the sums of all tasks, block by block."""
    key = ["lang_no", "slice", "source", "block"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(held: list[tuple]) -> pa.RecordBatch:
            size = [len(terms) for *_, terms, _ in held]
            number = pa.array(np.repeat(np.arange(len(held)), size))
            columns = [pa.array([h[i] for h in held], kind).take(number) for i, kind in enumerate((pa.int32(), pa.int32(), pa.string()))]
            columns += [pa.array(np.concatenate([h[i] for h in held])) for i in (3, 4)]
            return pa.RecordBatch.from_arrays(columns, names=[*key[:3], "term", "n"])

        def done() -> tuple:
            terms = np.flatnonzero(sums).astype(np.int32)
            return *now[:3], terms + np.int32(now[3] * SUM_TERMS), sums[terms]

        now, sums, held, waiting = None, np.zeros(SUM_TERMS, np.int64), [], 0
        for batch in batches:
            for *at, terms, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != now:
                    if now is not None:
                        held.append(done())
                        waiting += len(held[-1][3])
                        sums[:] = 0
                    if waiting > OUT_ROWS:
                        yield batch_of(held)
                        held, waiting = [], 0
                    now = at
                sums[np.frombuffer(terms, np.int32) - now[3] * SUM_TERMS] += np.frombuffer(counts, np.int64)
        if now is not None:
            yield batch_of([*held, done()])

    rows = parts.select(*key, "terms", "counts").repartition(*key).sortWithinPartitions(*key)
    return rows.mapInArrow(run, "lang_no int, slice int, source string, term int, n long")


def probability(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)); in decimals where a long cannot hold the product."""
    whole = (total + 2 * terms).cast("long")
    wide = F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)"), whole.cast("decimal(20,0)"))
    return F.when(n < SCALE, F.call_function("div", F.lit(SCALE).cast("long") * (n + 2), whole)).otherwise(wide) + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def added(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums of the values of each key."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(values, first) if len(first) else values


PAIR = "lang_no int, one int, two int, value long"


def pair_batch(lang: int, keys: np.ndarray, values: np.ndarray, width: int) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
    columns = (np.full(len(keys), lang), keys // width, keys % width, values)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["lang_no", "one", "two", "value"])


class Groups:
    """Number of terms per language and, per source in order, the probability of a term that it has not."""

    def __init__(self, rows: list):
        by_lang: dict[int, list] = {}
        for r in rows:
            by_lang.setdefault(r["lang_no"], []).append(r)
        self.absent = {k: np.array([r["absent"] for r in sorted(v, key=lambda r: r["source_no"])], np.int64) for k, v in by_lang.items()}
        self.terms = {k: v[0]["n_terms"] for k, v in by_lang.items()}

    def constants(self, lang: int, one: int) -> np.ndarray:
        """f of a term that neither source has, against every source."""
        return divergence(np.int64(self.absent[lang][one]), self.absent[lang])


def without_terms(groups: DataFrame, known: Groups) -> DataFrame:
    """Every pair of sources as if neither had any term."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, one in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                values = known.constants(lang, one) * known.terms[lang]
                width = len(values)
                keys = np.delete(np.arange(width), one)
                yield pair_batch(lang, one * width + keys, values[keys], width)

    return groups.select("lang_no", "source_no").mapInArrow(run, PAIR)


def of_one_source(entries: DataFrame, known: Groups) -> DataFrame:
    """What the terms of a source add against every other source, as if that had none of them; to both directions."""
    counts = entries.groupBy("lang_no", "source_no", "p").agg(F.count(F.lit(1)).alias("n"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, sources, p, n = (c.to_numpy() for c in batch.columns)
            for lang, one in sorted({*zip(langs.tolist(), sources.tolist(), strict=True)}):
                at = (langs == lang) & (sources == one)
                absent, constant = known.absent[lang], known.constants(lang, one)
                width = len(absent)
                total = np.zeros(width, np.int64)
                for value, times in zip(p[at], n[at], strict=True):
                    total += (divergence(value, absent) - constant) * times
                others = np.delete(np.arange(width), one)
                keys = np.concatenate([one * width + others, others * width + one])
                yield pair_batch(lang, keys, np.concatenate([total[others], total[others]]), width)

    return counts.mapInArrow(run, PAIR)


def of_shared_terms(entries: DataFrame, known: Groups, blocks: Column) -> DataFrame:
    """Corrections at terms that both sources have; to both directions."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang = key[0].as_py()
        absent = known.absent[lang]
        width = len(absent)
        held = pa.Table.from_batches(list(batches))
        term, part, source, p = (held[c].to_numpy() for c in ("term", "slice", "source_no", "p"))
        order = np.lexsort((source, term, part))
        term, part, source, p = term[order], part[order], source[order].astype(np.int64), p[order]
        keys, values, waiting, lag = [], [], 0, 1
        at = np.arange(len(term) - 1)
        while len(at):
            at = at[at + lag < len(term)]
            at = at[(term[at] == term[at + lag]) & (part[at] == part[at + lag])]
            for begin in range(0, len(at), FLUSH_PAIRS):
                i = at[begin:begin + FLUSH_PAIRS]
                one, two, p1, p2 = source[i], source[i + lag], p[i], p[i + lag]
                value = divergence(p1, p2) - divergence(p1, absent[two]) - divergence(absent[one], p2) + divergence(absent[one], absent[two])
                k, v = added(one * width + two, value)
                keys.append(k)
                values.append(v)
                waiting += len(k)
                if waiting > FLUSH_PAIRS:
                    k, v = added(np.concatenate(keys), np.concatenate(values))
                    keys, values, waiting = [k], [v], len(k)
                    if waiting > FLUSH_PAIRS // 2:
                        yield both_ways(lang, k, v, width)
                        keys, values, waiting = [], [], 0
            lag += 1
        if keys:
            yield both_ways(lang, *added(np.concatenate(keys), np.concatenate(values)), width)

    rows = entries.select("lang_no", F.pmod(F.xxhash64("term", "slice"), blocks).alias("block"), "slice", "term", "source_no", "p")
    return rows.groupBy("lang_no", "block").applyInArrow(run, PAIR)


def both_ways(lang: int, keys: np.ndarray, values: np.ndarray, width: int) -> pa.RecordBatch:
    turned = keys % width * width + keys // width
    return pair_batch(lang, np.concatenate([keys, turned]), np.concatenate([values, values]), width)


def ranked(rows: DataFrame, item: str, *part: str) -> DataFrame:
    order = Window.partitionBy(*part).orderBy(F.col("value").desc(), F.col(item))
    return rows.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, slice_terms: int = SLICE_TERMS) -> DataFrame:
    """Divergence of every pair of sources of a language, and the terms by which a source departs from its language."""
    spark = docs.sparkSession
    langs = [r[0] for r in docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang")).distinct().collect()]
    if not langs:
        return spark.createDataFrame([], RESULT)
    path = new_dir(spark, "terms")
    number = F.array_position(F.lit(sorted(langs)), F.col("lang")).cast("int")
    normalised(docs).withColumn("lang_no", number).write.partitionBy("lang_no").parquet(path)
    texts = spark.read.schema("lang string, source string, terms string, distinct string, lang_no int").parquet(path)
    sizes = expected_terms(texts, min_docs)

    sums, names, n_terms = [], [], {}
    for lang_no in range(1, len(langs) + 1):
        slices, n_terms[lang_no] = max(1, math.ceil(sizes.get(lang_no, 0) / slice_terms)), 0
        rows = texts.filter(F.col("lang_no") == lang_no)
        for part in range(slices):
            # Document frequencies alone choose the vocabulary, so each term of a document is enough to fit.
            model, words, numbers = fitted(rows.select(terms_of("distinct", slices, part).alias("terms")), min_docs)
            cut = rows.select("source", terms_of("terms", slices, part).alias("terms"))
            n_terms[lang_no] += len(words) - 1
            place = {"lang_no": F.lit(lang_no), "slice": F.lit(part)}
            sums.append(source_sums(cut, model, numbers).withColumns(place))
            words = pa.table({"term": pa.array(range(len(words)), pa.int32()), "item": words})
            names.append(spark.createDataFrame(words).withColumns(place))
    counts = pinned(added_sums(_union(sums)), "source-sums")
    names = pinned(_union(names), "terms")
    groups = source_groups(spark, texts, counts, n_terms)
    known = Groups(groups.select("lang_no", "source_no", "n_terms", "absent").collect())
    entries = pinned(probabilities(counts, groups), "entries")
    pairs = divergent_pairs(entries, groups, known)
    return pairs.unionByName(departing_terms(entries, groups, names, top)).select("lang", "source", "part", "item", "value", "rank")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def source_groups(spark: SparkSession, texts: DataFrame, counts: DataFrame, n_terms: dict[int, int]) -> DataFrame:
    """Every occurring language and source with a number in its language, its total and the probability of no count."""
    terms = F.create_map(*[F.lit(x).cast("long") for pair in n_terms.items() for x in pair])
    totals = counts.groupBy("lang_no", "source").agg(F.sum("n").alias("total"))
    found = texts.groupBy("lang_no", "lang", "source").agg(F.count(F.lit(1)).alias("docs")).join(totals, ["lang_no", "source"], "left")
    found = found.withColumns({"total": F.coalesce("total", F.lit(0)), "n_terms": terms[F.col("lang_no").cast("long")]})
    # Without kept terms nothing is summed, and any value stands for the probability.
    absent = F.when(F.col("n_terms") > 0, probability(F.lit(0), F.col("total"), F.col("n_terms"))).otherwise(F.lit(1))
    order = Window.partitionBy("lang_no").orderBy("source")
    return pinned(found.select(
        "lang_no", "lang", "source", (F.row_number().over(order) - 1).alias("source_no"), "total", "n_terms", absent.cast("long").alias("absent"),
    ), "groups")


def probabilities(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """For every term of a source its probability there, ``p``, and in the language, ``q``."""
    numbers = groups.select("lang_no", "source", "source_no", "total", "n_terms")
    totals = groups.groupBy("lang_no").agg(F.sum("total").alias("lang_total"))
    # One row per source is all that a term of a language has.
    whole = Window.partitionBy("lang_no", "slice", "term")
    rows = counts.join(numbers, ["lang_no", "source"]).join(totals, "lang_no").withColumn("lang_n", F.sum("n").over(whole))
    return rows.select(
        "lang_no", "slice", "term", "source_no", probability(F.col("n"), F.col("total"), F.col("n_terms")).alias("p"),
        probability(F.col("lang_n"), F.col("lang_total"), F.col("n_terms")).alias("q"),
    )


def divergent_pairs(entries: DataFrame, groups: DataFrame, known: Groups) -> DataFrame:
    blocks = max(1, -(-entries.count() // BLOCK_ENTRIES))
    parts = _union([without_terms(groups, known), of_one_source(entries, known), of_shared_terms(entries, known, F.lit(blocks))])
    sums = parts.groupBy("lang_no", "one", "two").agg(F.sum("value").alias("value"))
    one = groups.select("lang_no", "lang", "source", F.col("source_no").alias("one"))
    two = groups.select("lang_no", F.col("source").alias("item"), F.col("source_no").alias("two"))
    rows = sums.join(one, ["lang_no", "one"]).join(two, ["lang_no", "two"]).withColumn("part", F.lit("pair"))
    return ranked(rows, "item", "lang", "source").select("lang", "source", "part", "item", "value", "rank")


def departing_terms(entries: DataFrame, groups: DataFrame, names: DataFrame, top: int) -> DataFrame:
    """The ``top`` terms of each source that are more probable there than in its language."""
    rows = entries.filter("p > q").join(groups.select("lang_no", "lang", "source", "source_no"), ["lang_no", "source_no"])
    rows = rows.withColumn("value", F.expr("(p - q) * (p - q) div (p + q)"))
    # Numbers of terms are in the order of their bytes within a slice, so ties need no names yet.
    best = ranked(rows, "term", "lang", "source", "slice").filter(F.col("rank") <= top).drop("rank")
    best = ranked(best.join(names, ["lang_no", "slice", "term"]), "item", "lang", "source").filter(F.col("rank") <= top)
    return best.withColumn("part", F.lit("term")).select("lang", "source", "part", "item", "value", "rank")
