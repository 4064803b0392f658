"""Language identification by nearest centroid.

Texts become TF-IDF vectors of hashed byte n-grams, scaled to length one. Each language has several
centroids, found by spherical k-means over a bounded sample of its labelled documents; a text
gets the language of the centroid with the highest cosine. It is rejected where that cosine is
below a share of what the centroid's own training texts reach.

The sample takes ``SAMPLE_ROWS`` documents of each language, those with the smallest hash of the id.
Prediction covers every row and the whole text.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and rejected; so is every text
if nothing was learned. Repeated rows are each judged. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import fold_of, short_batches
from feedloom.operators.lookups import fits
from feedloom.session import pinned

SAMPLE_ROWS = 400
FOLDS, HELD_OUT = 4, 2
CENTROIDS = 4
BUCKETS = 1 << 13
GRAMS = (1, 2, 3, 4)
# Share of the lowest training cosines of a centroid below which a text is rejected.
REJECT_SHARE = 0.4
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
# ASCII characters that are no letters become spaces: marks and digits say nothing about a language.
LETTERS_ONLY = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))


def gram_counts(text: str) -> np.ndarray:
    """Hashed counts of the byte n-grams of a lower-cased text, over its letters and single spaces."""
    words = text.lower().encode("utf-8", "replace").translate(LETTERS_ONLY).split()
    data = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    total = np.zeros(BUCKETS, np.float32)
    code = np.zeros(len(data), np.uint32)
    for n in range(1, max(GRAMS) + 1):
        if len(data) < n:
            break
        code = (code[:len(data) - n + 1] << np.uint32(8)) | data[n - 1:]
        if n in GRAMS:
            bucket = ((code + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(32 - 13)
            total += np.bincount(bucket, minlength=BUCKETS).astype(np.float32)
    return total


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=-1, keepdims=True), 1e-12)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return unit(np.sqrt(counts) * idf)


def spherical_kmeans(rows: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Centroids and each row's cluster; starts from the row farthest from those chosen so far."""
    chosen = [unit(rows.mean(0))]
    while len(chosen) < min(k, len(rows)):
        chosen.append(rows[np.argmin((rows @ np.array(chosen).T).max(1))])
    centroids = np.array(chosen)
    for _ in range(rounds):
        own = (rows @ centroids.T).argmax(1)
        centroids = np.array([unit(rows[own == c].mean(0)) if (own == c).any() else centroids[c] for c in range(len(centroids))])
    return centroids, (rows @ centroids.T).argmax(1)


def training_sample(docs: DataFrame, per_language: int) -> DataFrame:
    """Text and language of the sampled training documents. Ids are chosen before texts are read."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold_of(F.col("doc_id"), FOLDS) != HELD_OUT))
    order = Window.partitionBy("lang").orderBy(F.xxhash64(F.col("doc_id")), "doc_id")
    # The smallest hashes by halving ranges, counted first: only the ranges that hold the sample meet in a window.
    level = F.floor(64 - F.log2(F.xxhash64(F.col("doc_id")).cast("double") + F.lit(2.0 ** 63 + 1))).cast("int")
    ids = usable.select("doc_id", "lang", level.alias("level"))
    counts = ids.groupBy("lang", "level").count()
    ahead = F.sum("count").over(Window.partitionBy("lang").orderBy(F.desc("level"))) - F.col("count")
    needed = pinned(counts.withColumn("ahead", ahead).filter(F.col("ahead") < per_language).select("lang", "level"), "levels")
    chosen = ids.join(needed, ["lang", "level"], "left_semi").withColumn("nth", F.row_number().over(order))
    chosen = pinned(chosen.filter(F.col("nth") <= per_language).select(F.col("doc_id").alias("chosen_id")).distinct(), "chosen")
    if fits(chosen):
        # A few hundred ids a language: the texts stay where they are.
        chosen = F.broadcast(chosen)
    same = F.col("doc_id").eqNullSafe(F.col("chosen_id"))
    found = usable.select("doc_id", "lang", "text").join(chosen, same, "left_semi")
    # Rows that share an id are sampled together; the bound holds for them as well.
    return found.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= per_language).select("lang", "text")


def learn(docs: DataFrame, per_language: int = SAMPLE_ROWS) -> dict:
    """IDF weights, and centroids with language and reject bound; small arrays whatever the input."""
    spark = docs.sparkSession
    short_batches(spark)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            kept = [i for i, t in enumerate(texts) if LETTER.search(t)]
            if kept:
                grams = [gram_counts(texts[i]).tobytes() for i in kept]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept)), pa.array(grams, pa.binary())], names=["lang", "grams"])

    grams = pinned(training_sample(docs, per_language).mapInArrow(count, "lang string, grams binary"), "grams")

    def presence(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for g in batch["grams"]:
                df += np.frombuffer(g, np.float32) > 0
                n += 1
        yield pd.DataFrame({"n": [n], "df": [df.tobytes()]})

    parts = grams.coalesce(8).mapInPandas(presence, "n long, df binary").collect()
    n = sum(p["n"] for p in parts)
    df = sum((np.frombuffer(p["df"], np.int64) for p in parts), np.zeros(BUCKETS, np.int64))
    idf = np.log((1 + n) / (1 + df)).astype(np.float32) + 0.1

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        rows = vectors(np.stack([np.frombuffer(g, np.float32) for g in group["grams"].sort_values()]), idf)
        centroids, own = spherical_kmeans(rows, CENTROIDS)
        near = (rows * centroids[own]).sum(1)
        low = [float(np.quantile(near[own == c], 0.01)) if (own == c).any() else 0.0 for c in range(len(centroids))]
        return pd.DataFrame({"lang": group["lang"].iloc[0], "centroid": [c.astype(np.float32).tobytes() for c in centroids], "low": low})

    found = grams.groupBy("lang").applyInPandas(cluster, "lang string, centroid binary, low double").collect()
    found = sorted(found, key=lambda r: (r["lang"], bytes(r["centroid"])))
    shape = (len(found), BUCKETS)
    return {
        "idf": idf,
        "langs": [r["lang"] for r in found],
        "centroids": np.frombuffer(b"".join(bytes(r["centroid"]) for r in found), np.float32).reshape(shape),
        "bound": np.array([REJECT_SHARE * r["low"] for r in found]),
    }


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """``lang_pred``, ``score`` and ``rejected`` for the struct column ``doc``, which is kept."""
    spark = docs.sparkSession
    short_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def judge(texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        m = shared.value
        langs, scores, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        if m["langs"]:
            for i, t in enumerate(texts):
                if t and LETTER.search(t):
                    near = m["centroids"] @ vectors(gram_counts(t), m["idf"])
                    best = int(near.argmax())
                    langs[i], scores[i] = m["langs"][best], float(min(max(near[best], 0.0), 1.0))
                    rejected[i] = scores[i] < m["bound"][best]
        return langs, scores, rejected

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def language_of(texts: pd.Series) -> pd.DataFrame:
        langs, scores, rejected = judge([None if pd.isna(t) else t for t in texts])
        return pd.DataFrame({"lang_pred": langs, "score": scores, "rejected": rejected})

    return docs.withColumn("found", language_of("doc.text"))


def identify(docs: DataFrame, per_language: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every document."""
    model = learn(docs, per_language)
    rows = docs.select(F.struct("doc_id", "text").alias("doc"))
    return predict(rows, model).select(
        "doc.doc_id", (fold_of(F.col("doc.doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "found.lang_pred", "found.score", "found.rejected",
    )


def keep_known(docs: DataFrame, per_language: int = SAMPLE_ROWS) -> DataFrame:
    """The documents, all columns, without those that are rejected."""
    model = learn(docs, per_language)
    rows = docs.select(F.struct("*").alias("doc"))
    return predict(rows, model).filter(~F.col("found.rejected")).select("doc.*")
