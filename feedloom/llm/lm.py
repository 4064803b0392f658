"""Language-model scoring by a log-bilinear neural model trained with noise-contrastive estimation.

Tokens are words in lower case and one end per text. The ``CLASSES`` most frequent tokens are classes of the
model, all others share one; inside that class the smoothed token counts of the whole corpus tell words
apart, so the model is normalised over every token and one unseen type. The two tokens before predict
the next: score(w | u, v) = q_w . (c1 * r_v + c2 * r_u) + b_w.

Training passes once over all training texts. Every task runs numpy minibatch steps against
shared unigram noise from the parameters it is given; the results are averaged, weighted by tokens. A tenth of
the documents gives the first average, the others start from it. Normalisation needs no sum for each token:
exp(score) factors over the two context words, so one matrix product gives the normaliser of every
context pair, and a token costs three lookups.

Words outside the head, at most ``HEAD`` words and all of them more frequent than any other, are counted per document and meet their corpus counts in a
join, so no vocabulary has to fit anywhere whole.

Defined cases: a null or empty text is one end token. A null id is hashed as empty text. Repeated rows are scored
each. Without training documents the counts are zero. An empty table gives an empty result; other
columns are left out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import fold_of, short_batches
from feedloom.session import pinned

FOLDS, HELD_OUT = 7, 2
CLASSES = 2048
HEAD = 200_000
DIM = 16
NOISE = 32
BATCH = 8192
RATE = 0.1
FLUSH_WORDS = 400_000
# Class numbers: the end of a text, all words that are no class of their own, then words.
END, OTHER = 0, 1
END_WORD = b""


def texts_of(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def tokens_of(text: bytes) -> list[bytes]:
    """Words in lower case; ``lower`` and ``split`` of bytes touch ASCII alone."""
    return text.lower().split()


def token_counts(docs: DataFrame) -> DataFrame:
    """word (binary, empty for the end) and its count ``c`` over training texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(seen: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "c"])

        seen: Counter = Counter()
        for batch in batches:
            for text in texts_of(batch.column(0)):
                seen.update(tokens_of(text))
            seen[END_WORD] += batch.num_rows
            if len(seen) > FLUSH_WORDS:
                yield out(seen)
                seen = Counter()
        if seen:
            yield out(seen)

    return docs.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Parameters:
    """Arrays of the model, packed as rows so that Spark can average them."""

    def __init__(self, rows: np.ndarray):
        self.context, self.target, self.bias = rows[:-1, :DIM], rows[:-2, DIM:2 * DIM], rows[:-2, 2 * DIM]
        self.near, self.far = rows[-1, :DIM], rows[-1, DIM:2 * DIM]

    @staticmethod
    def start(share: np.ndarray) -> np.ndarray:
        """Small random vectors, and log frequencies as bias. The last but one row is the context before a text."""
        rng = np.random.default_rng(7)
        rows = rng.normal(0, 0.1, (len(share) + 2, 2 * DIM + 1)).astype(np.float32)
        rows[:-2, 2 * DIM] = np.log(share)
        rows[-1] = 1.0
        return rows


def add_rows(into: np.ndarray, squares: np.ndarray, at: np.ndarray, grad: np.ndarray) -> None:
    """Adagrad ascent on the rows of ``into`` named by ``at``, which may repeat."""
    order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    total = np.add.reduceat(grad[order], first, axis=0)
    rows = at[first]
    squares[rows] += total * total
    into[rows] += RATE * total / np.sqrt(squares[rows] + 1.0)


def train_batch(p: Parameters, squares: Parameters, near, far, target, log_noise, noise) -> None:
    """One noise-contrastive step: every token against the same ``NOISE`` noise tokens."""
    r1, r2 = p.context[near], p.context[far]
    predicted = p.near * r1 + p.far * r2
    q, qn = p.target[target], p.target[noise]
    true = (predicted * q).sum(1) + p.bias[target] - log_noise[target]
    false = predicted @ qn.T + (p.bias[noise] - log_noise[noise])
    up = 1 / (1 + np.exp(np.minimum(true, 30)))
    down = -1 / (1 + np.exp(-np.maximum(false, -30)))
    move = up[:, None] * q + down @ qn
    add_rows(p.target, squares.target, np.concatenate([target, noise]), np.concatenate([up[:, None] * predicted, down.T @ predicted]))
    add_rows(p.bias, squares.bias, np.concatenate([target, noise]), np.concatenate([up, down.sum(0)]))
    add_rows(p.context, squares.context, np.concatenate([near, far]), np.concatenate([move * p.near, move * p.far]))
    for mix, side, r in ((p.near, squares.near, r1), (p.far, squares.far, r2)):
        g = (move * r).sum(0)
        side += g * g
        mix += RATE * g / np.sqrt(side + 1.0)


class Index(dict):
    """Word numbers; ``OTHER`` or -1 for words without one."""

    def __init__(self, words: Iterable[bytes], rest: int):
        super().__init__((w, i) for i, w in enumerate(words))
        self.rest = rest

    def __missing__(self, word: bytes) -> int:
        return self.rest


def train(docs: DataFrame, words: list[bytes], share: np.ndarray) -> np.ndarray:
    """Parameters after one pass over the training texts. ``words`` are the classes behind ``OTHER``."""
    spark = docs.sparkSession
    rows = Parameters.start(share)
    log_noise = (np.log(share) + np.log(NOISE)).astype(np.float32)
    first = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(10)) == 0
    for part in (docs.filter(first), docs.filter(~first)):
        given = spark.sparkContext.broadcast((words, rows, log_noise, share))

        def run(batches: Iterable[pa.RecordBatch], given=given) -> Iterator[pa.RecordBatch]:
            words, rows, log_noise, share = given.value
            index = Index([END_WORD, None, *words], OTHER)
            rows = rows.copy()
            p, squares, before = Parameters(rows), Parameters(np.zeros_like(rows)), len(share)
            rng, cumulative, done = np.random.default_rng(11), np.cumsum(share), 0
            held: list[np.ndarray] = []

            def steps(held: list[np.ndarray], whole: bool) -> list[np.ndarray]:
                nonlocal done
                flat = np.concatenate(held)
                ready = len(flat) if whole else len(flat) // BATCH * BATCH
                # Texts lie one after another behind two marks each, which are no targets.
                for i in range(0, ready, BATCH):
                    at = np.arange(max(i, 2), min(i + BATCH, ready))
                    at = at[flat[at] != before]
                    if len(at):
                        noise = np.minimum(np.searchsorted(cumulative, rng.random(NOISE)), len(share) - 1)
                        train_batch(p, squares, flat[at - 1], flat[at - 2], flat[at], log_noise, noise)
                        done += len(at)
                return [flat[max(0, ready - 2):]] if not whole else []

            for batch in batches:
                for text in texts_of(batch.column(0)):
                    tokens = tokens_of(text)
                    ids = np.empty(len(tokens) + 3, np.int64)
                    ids[:2], ids[-1] = before, END
                    ids[2:-1] = np.fromiter(map(index.__getitem__, tokens), np.int64, len(tokens))
                    held.append(ids)
                if sum(map(len, held)) > 64 * BATCH:
                    flat_rest = steps(held, False)
                    held = flat_rest
            if held:
                steps(held, True)
            if done:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(len(rows))), pa.array(np.full(len(rows), float(done))),
                    pa.array(list(rows.astype(np.float64)), pa.list_(pa.float64())),
                ], names=["row", "weight", "x"])

        each = part.select("text").mapInArrow(run, "row long, weight double, x array<double>")
        total = F.sum("weight")
        columns = [(F.sum(F.col("weight") * F.col("x")[i]) / total).alias(f"x{i}") for i in range(rows.shape[1])]
        mean = each.groupBy("row").agg(*columns).toPandas().sort_values("row")
        if len(mean):
            rows = mean.drop(columns="row").to_numpy(np.float32)
    return rows


class Scorer:
    """Tables for scoring, built once in each Python worker."""

    def __init__(self, head: list[bytes], counts: np.ndarray, classes: int, rows: np.ndarray, total: int, types: int, other: float):
        self.index = Index(head, -1)
        self.base = np.log10((counts + 1.0) / (total + types + 1))
        # Class of each head word; words behind the classes share one and add their share of it. The last is for no head word.
        self.klass = np.full(len(head) + 1, OTHER, np.int64)
        own = [i for i, w in enumerate(head) if w != END_WORD][:classes - 2]
        self.klass[own] = np.arange(2, 2 + len(own))
        self.inside = np.where(self.klass[:-1] == OTHER, np.log10((counts + 1.0) / other), 0.0)
        for i, w in enumerate(head):
            if w == END_WORD:
                self.klass[i], self.inside[i] = END, 0.0
        p = Parameters(rows)
        one, two = (p.context * p.near) @ p.target.T, (p.context * p.far) @ p.target.T
        two = two + p.bias
        self.one, self.two = one, two
        top1, top2 = one.max(1, keepdims=True), two.max(1, keepdims=True)
        self.norm = np.log(np.exp(one - top1) @ np.exp(two - top2).T) + top1 + top2.T
        self.before, self.end_base = len(p.bias), np.log10(1.0 / (total + types + 1))

    def text(self, tokens: list[bytes]) -> tuple[int, float, float, Counter]:
        """Known head tokens, base and model log10 sums of the head, and the words of the tail."""
        at = np.fromiter(map(self.index.__getitem__, tokens), np.int64, len(tokens))
        rare = at < 0
        tail = Counter(tokens[i] for i in np.flatnonzero(rare).tolist())
        head = at[~rare]
        ids = np.empty(len(tokens) + 3, np.int64)
        ids[:2], ids[-1] = self.before, END
        ids[2:-1] = np.where(rare, OTHER, self.klass[at])
        t, v, u = ids[2:], ids[1:-1], ids[:-2]
        model = float((self.one[v, t].astype(np.float64) + self.two[u, t] - self.norm[v, u]).sum() / np.log(10))
        end = self.index[END_WORD]
        known, base = len(head) + (end >= 0), float(self.base[head].sum()) + float(self.base[end] if end >= 0 else self.end_base)
        return known, base, model + float(self.inside[head].sum()), tail


@lru_cache(maxsize=1)
def scorer_of(shared) -> Scorer:
    return Scorer(*shared.value)


def cut_off(counts: DataFrame, size: int) -> int:
    """The smallest count that at most ``size`` words exceed, 0 if there are no more words than that.

    Words are counted per frequency, first by octaves, then within the one octave that holds the cut.
    """
    often = counts.groupBy("c").agg(F.count(F.lit(1)).alias("n")).withColumn("octave", F.floor(F.log2("c")).cast("int"))
    often = pinned(often, "frequencies")
    octaves = dict(often.groupBy("octave").agg(F.sum("n")).collect())
    above = 0
    for octave in sorted(octaves, reverse=True):
        if above + octaves[octave] > size:
            order = Window.partitionBy("octave").orderBy(F.desc("c"))
            upto = often.filter(F.col("octave") == octave).withColumn("upto", F.sum("n").over(order) + above)
            return upto.filter(F.col("upto") > size).agg(F.max("c")).first()[0]
        above += octaves[octave]
    return 0


def score(docs: DataFrame, head_size: int = HEAD, classes: int = CLASSES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    spark = docs.sparkSession
    short_batches(spark)
    training = docs.filter(fold_of(F.col("doc_id"), FOLDS) != HELD_OUT)
    counts = pinned(token_counts(training), "tokens")
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    kept = (F.col("c") > cut_off(counts, head_size)) | (F.col("word") == F.lit(END_WORD))
    top = counts.filter(kept).toPandas()
    top = top.assign(word=top["word"].map(bytes)).sort_values(["c", "word"], ascending=[False, True])
    head, head_counts = top["word"].tolist(), top["c"].to_numpy(np.int64)
    words = [w for w in head if w != END_WORD][:classes - 2]
    ends = int(sum(c for w, c in zip(head, head_counts, strict=True) if w == END_WORD))
    by_word = dict(zip(head, head_counts.tolist(), strict=True))
    inside = sum(by_word[w] for w in words)
    others = sums["n"] - ends - inside
    share = np.array([ends, others, *(by_word[w] for w in words)], np.float64) + 1
    share /= share.sum()
    rows = train(training, words, share)
    other = float(others + max(0, sums["v"] - len(words) - (ends > 0)) + 1)
    shared = spark.sparkContext.broadcast((head, head_counts, classes, rows, sums["n"], sums["v"], other))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(shared)
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for text in texts_of(batch.column(3)):
                tokens = tokens_of(text)
                known, base, model, tail = scorer.text(tokens)
                for column, x in zip(columns, (len(tokens) + 1, known, base, model, list(tail), list(tail.values())), strict=True):
                    column.append(x)
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["uid", "doc_id", "held_out", "n_tokens", "known", "base", "model", "words", "times"])

    plain = docs.select(
        F.monotonically_increasing_id().alias("uid"), "doc_id", (fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "text")
    kind = plain.schema["doc_id"].dataType.simpleString()
    scored = pinned(plain.mapInArrow(run, (
        f"uid long, doc_id {kind}, held_out boolean, n_tokens long, known long, base double, model double, "
        "words array<binary>, times array<long>"
    )), "scored")
    tail = scored.select("uid", F.explode(F.arrays_zip("words", "times")).alias("t")).select("uid", F.col("t.words").alias("word"), F.col("t.times").alias("times"))
    met = tail.join(counts, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    added = met.groupBy("uid").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10((F.col("c") + 1) / F.lit(float(sums["n"] + sums["v"] + 1)))).alias("more_base"),
        F.sum(F.col("times") * F.log10((F.col("c") + 1) / F.lit(other))).alias("more_model"),
    )
    zero = F.lit(0)
    return scored.drop("words", "times").join(added, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", zero)).alias("n_known"),
        F.lit(sums["n"]).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"),
        (F.col("model") + F.coalesce("more_model", zero)).alias("score"),
    )
