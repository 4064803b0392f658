"""Divergence, spelling variants and benchmark leaks against brute force, on awkward rows and in every split of the work."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import divergence, leaks, spelling

DOCS = "doc_id long, text string, lang string, source string, n_chars long, word string, leak string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, 1, "x", None) for i, t, lang, source in rows], DOCS)


# --- benchmark leaks ---

ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today"), (2, "quick, BROWN fox!"), (3, "été — the ÉTÉ"), (4, None),
    (5, " .,; "), (6, "fox jumps over the lazy dog near the old river"), (6, "another question of id six"), (None, "no id here"), (10, "42"),
]
TEXTS = [
    None, "", " ... ", "the quick brown fox", "xThe quick brown foxx", "A: The QUICK--brown\n\tfox jumps over the lazy dog near the old river bank today!",
    "quick brown fox jumps over the lazy dog near the old river bank", "fox jumps over the lazy dog near the old river", "42 42,42 é42", "été the ÉTÉ été the été",
    "日本 no id here 😀 no id here", "quick brown quick brown fox quick brown fox", "another question of id six", "word " * 20_000 + "quick brown fox", "a\x00quick\x7fbrown\x1ffox\x85b",
]


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [(m[0], m.span()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)]


def brute_leaks(texts, items, window=10):
    windows = defaultdict(set)
    for item, text in items:
        w = [x for x, _ in words(text)]
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows[tuple(w[k:k + window])].add("" if item is None else str(item))
    out = []
    for text in texts:
        w, hit, met = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if names := windows.get(tuple(x for x, _ in w[i:i + size])):
                    hit.update(range(i, i + size))
                    met |= names
        spans = []
        for i in sorted(hit):
            if i - 1 in hit:
                spans[-1][1] = w[i][1][1]
            else:
                spans.append([*w[i][1]])
        out.append((len(w), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), ",".join(f"{a}:{b}" for a, b in spans)))
    return out


@pytest.mark.parametrize("shard_bytes", [leaks.SHARD_BYTES, 40])
def test_leaks_equal_brute_force(spark, shard_bytes, monkeypatch):
    monkeypatch.setattr(leaks, "SEGMENT_WORDS", 2)
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("n_words", F.lit(1))
    docs = docs_of(spark, [(i, t, "en", "s") for i, t in enumerate(TEXTS)] + [(3, TEXTS[5], None, None), (None, TEXTS[3], "", "")])
    got = {}
    for r in leaks.report(docs.drop("leak"), items, shard_bytes=shard_bytes).collect():
        got.setdefault(r["doc_id"], []).append((r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["spans"]))
        assert r["contaminated"] == (r["n_hit"] > 0)
    want = brute_leaks(TEXTS, ITEMS)
    assert sorted(got.pop(3)) == sorted([want[3], want[5]]) and got.pop(None) == [want[3]]
    assert got == {i: [w] for i, w in enumerate(want) if i != 3}


def test_leaks_on_empty_tables_and_clashing_columns(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = docs_of(spark, [(1, TEXTS[5], "en", "s"), (2, "clean", "en", "s"), (3, None, None, None)])
    assert leaks.report(docs, items.limit(0)).filter("contaminated").count() == 0
    assert leaks.report(docs.limit(0), items).count() == 0
    left = leaks.without_leaks(docs, items)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [2, 3]
    with pytest.raises(ValueError, match="leak"):
        leaks.scan(docs, items)


# --- spelling variants ---


def brute_variants(rows):
    counts = Counter()
    for i, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for w in re.findall("[A-Za-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    vocabulary = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        one, two = sorted((a, b), key=len)
        return len(two) == len(one) + 1 and any(two[:k] + two[k + 1:] == one for k in range(len(two)))

    out = {}
    for w, n in vocabulary.items():
        others = [(-m, x) for x, m in vocabulary.items() if near(w, x)]
        form = min(others)[1] if others and -min(others)[0] >= 2 * n else None
        out[w] = [form, w, n, len(others), vocabulary.get(form)]
    for w in out:
        while out[out[w][1]][0]:
            out[w][1] = out[out[w][1]][0]
    return {w: tuple(x) for w, x in out.items()}


def spelling_rows():
    rng = np.random.default_rng(5)
    bases = ["spark", "colour", "naïveté", "àéîõü", "aaaaa", "Öffnung", "x" * 40, "abcdefgh" * 300, "über" * 9]
    texts, letters = [], "abcdxé×ÿÀ"
    for _ in range(500):
        row = []
        for b in rng.choice(bases, 6, p=[0.2, 0.2, 0.1, 0.1, 0.1, 0.1, 0.1, 0.02, 0.08]):
            b = str(b)
            for _ in range(int(rng.integers(0, 3)) if rng.random() < 0.6 else 0):
                k = int(rng.integers(0, min(len(b), 6)))
                new = str(rng.choice(list(letters))) if rng.random() < 0.3 else "a"
                b = [b[:k] + b[k + 1:], b[:k] + new + b[k + 1:], b[:k] + new + b[k:]][int(rng.integers(0, 3))]
            row.append(b)
        texts.append(" ".join(row))
    rows = [*enumerate(texts), (None, "Spark spark SPARK sparks sparks sparks"), (7, "Spark,spark1spark"), (7, "Spark,spark1spark"), (8, None), (9, ""), (10, "日本 spark😀sparkŸspark")]
    # A chain of forms: each at least twice as frequent as the one before.
    return rows + [(1000, " ".join(["chaina"] * 3 + ["chainab"] * 6 + ["chainabc"] * 12 + ["chainabcd"] * 24 + ["chainabcde"] * 48))]


@pytest.mark.parametrize("round_words", [spelling.ROUND_WORDS, 40])
def test_variants_equal_brute_force(spark, round_words, monkeypatch):
    monkeypatch.setattr(spelling, "FLUSH_WORDS", 50)
    rows = spelling_rows()
    docs = docs_of(spark, [(i, t, "en", "s") for i, t in rows]).repartition(3)
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.variants(docs, round_words).collect()}
    want = brute_variants(rows)
    assert got == want and got["chaina"][1] == "chainabcde" and len(want) > 60
    assert any(x[3] > 1 for w, x in want.items() if len(w) > spelling.LONG)


def test_the_filter_decides_what_is_joined(spark):
    rows = spelling_rows()
    held = spelling.Flat
    words = spelling.vocabulary(docs_of(spark, [(i, t, "en", "s") for i, t in rows]))
    flat = held([r["word"] for r in words.collect()])
    size = np.minimum(flat.sizes, spelling.LONG)
    offset, blocks = spelling.filter_places(Counter(size.tolist()))
    table = spelling.bloom_filter(words, offset, blocks)
    block, bits = spelling.spots(flat.hash, offset[size], blocks[size])
    assert (table[block] & bits == bits).all()
    strange = np.random.default_rng(1).integers(0, 1 << 63, 20_000, np.uint64)
    block, bits = spelling.spots(strange, offset[np.full(20_000, 6)], blocks[np.full(20_000, 6)])
    assert (table[block] & bits == bits).mean() < 0.05


def test_edit_hashes_equal_hashes_of_the_edited_words():
    words = ["aabbcc", "zürich", "q" * 9, "colours"]
    flat = spelling.Flat(words)
    at, hashes = flat.deletions()
    cut = [words[w][:i] + words[w][i + 1:] for w, i in zip(flat.word[at], flat.place[at], strict=True)]
    assert len(set(cut)) == len(cut) and (spelling.Flat(cut).hash == hashes).all()
    assert not len(spelling.Flat([]).letters)


def test_variants_of_nothing(spark):
    docs = docs_of(spark, [(1, None, None, None), (2, "a bb ccc dddddd", "en", "s")])
    assert spelling.variants(docs).count() == 0 and spelling.variants(docs.limit(0)).count() == 0


# --- source divergence ---


def brute_audit(rows, min_docs, top):
    docs, seen = Counter(), defaultdict(Counter)
    for lang, source, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        lang, source = lang or "", source or ""
        seen[lang, source].update(terms)
        docs.update((lang, t) for t in set(terms))
    out = []
    for lang in {x for x, _ in seen}:
        kept = sorted(t for x, t in docs if x == lang and docs[x, t] >= min_docs)
        whole = sum((c for (x, _), c in seen.items() if x == lang), Counter())

        def chances(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        q, p = chances(whole), {s: chances(c) for (x, s), c in seen.items() if x == lang}
        for s in p:
            parts = {"pair": [], "term": []}
            for t in p:
                if t != s:
                    parts["pair"].append((-sum((p[s][k] - p[t][k]) ** 2 // (p[s][k] + p[t][k]) for k in kept), t))
            parts["term"] = [(-((p[s][k] - q[k]) ** 2 // (p[s][k] + q[k])), k) for k in kept if seen[lang, s][k] and p[s][k] > q[k]]
            for part, found in parts.items():
                found = sorted(found, key=lambda x: (x[0], x[1].encode()))
                out += [(lang, s, part, k, -v, n + 1) for n, (v, k) in enumerate(found if part == "pair" else found[:top])]
    return sorted(out)


@pytest.mark.parametrize("slice_terms", [divergence.SLICE_TERMS, 12])
def test_audit_equals_brute_force(spark, slice_terms, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_ENTRIES", 30)
    monkeypatch.setattr(divergence, "FLUSH_PAIRS", 25)
    rng = np.random.default_rng(2)
    terms = [f"t{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(60)] + ["été", "日本", "Ünder", "😀", "zz9zz"]
    rows = []
    for _ in range(300):
        source = ["hot", "a", "b", "c", "d", None][int(rng.choice(6, p=[0.5, 0.1, 0.1, 0.1, 0.1, 0.1]))]
        picks = rng.zipf(1.4, int(rng.integers(0, 30))) % len(terms)
        rows.append((["en", "de", None][int(rng.choice(3, p=[0.6, 0.3, 0.1]))], source, " ,".join(terms[k].upper() if k % 2 else terms[k] for k in picks)))
    rows += [("en", "empty", None), ("en", "dots", "... 12"), ("fr", "a", "rare"), ("fr", "b", ""), ("it", "only", "x " * 50), ("en", "hot", "tie1 tie2 " * 9000)] + [("it", "only", "x y")] * 12
    docs = docs_of(spark, [(1, text, lang, source) for lang, source, text in rows]).repartition(4)
    got = [tuple(r) for r in divergence.audit(docs, 4, 3, slice_terms).collect()]
    assert sorted(got) == brute_audit(rows, 4, 3)
    assert ("fr", "a", "pair", "b", 0, 1) in got


def test_audit_of_nothing(spark):
    docs = docs_of(spark, [(1, None, None, None)])
    assert divergence.audit(docs).count() == 0
    none = divergence.audit(docs.limit(0))
    assert none.count() == 0 and none.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_probabilities_of_huge_counts(spark):
    row = spark.range(1).select(divergence.probability(F.lit(4 * 10**15), F.lit(9 * 10**15), F.lit(10**6)).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (4 * 10**15 + 2) // (9 * 10**15 + 2 * 10**6)


def test_sums_of_a_task_travel_in_blocks_of_terms(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SUM_TERMS", 4)
    monkeypatch.setattr(divergence, "OUT_ROWS", 3)
    rows, want = [], {}
    for lang_no, source in ((1, "a"), (1, "b"), (2, "a")):
        for task in range(3):
            held = divergence.SumBuffer(30)
            for term in range(task, 30, lang_no + 1):
                held.add(source, np.array([0, term] if term else [0]), np.array([9, 10**10 + term] if term else [9]))
                if term:
                    want[lang_no, source, term] = want.get((lang_no, source, term), 0) + 10**10 + term
            rows += [(lang_no, 0, *r.values()) for b in held.batches() for r in b.to_pylist()]
    # One row per task, source and block of terms, not one per term.
    assert len(rows) <= 9 * 8
    parts = spark.createDataFrame(rows, "lang_no int, slice int, source string, block int, terms binary, counts binary")
    got = divergence.added_sums(parts.repartition(5)).collect()
    assert {(r["lang_no"], r["source"], r["term"]): r["n"] for r in got} == want and len(got) == len(want)
