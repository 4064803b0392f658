"""The corpus operators against brute force, on small tables with awkward rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from feedloom.llm import components, exact_dedup, language, line_dedup, lm, near_dedup, packing, pieces, pii, topk_search, url_filter
from feedloom.llm.queries import ORACLES, QUERIES, tokenizer_file

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string"
# Nulls, empty and repeated rows, a repeated id, a long word, a long text and a clashing column.
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
ODD = [
    (1, None, None, None, None, "x"), (2, "", "en", "s", 0, None), (3, "  \n\t ", "en", "s", 5, "x"), (4, "a" * 20_000, "en", "s", 1, "x"),
    (5, LONG, "en", "s", 1, "x"), (6, LONG, "de", "s", 1, "x"), (6, LONG, "de", "s", 1, "x"), (None, "one two", "de", None, 7, "x"),
    (7, "one  two", "en", "s", 8, "x"), (7, "One two three four five six", "en", "s", 1, "x"), (8, "été ▁ 日本 😀 ok", None, "s", 1, "x"),
]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    spark.createDataFrame(ODD, DOCS).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "documents.parquet")
    spark.createDataFrame([], DOCS).write.parquet(path)
    return spark.read.parquet(path)


def small_docs():
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{SMALL}/documents.parquet'").df()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    got, want = QUERIES[name](spark, SMALL).toPandas(), con.sql(ORACLES[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert Counter(map(tuple, got[columns].astype(str).values)) == Counter(map(tuple, want[columns].astype(str).values))


def test_line_runs_within_and_across_documents(spark):
    run = "\n".join(" ".join(f"{c}{i}" for i in range(30)) for c in "abc")
    rows = [(1, "head\n" + run + "\ntail"), (2, "other\n" + run), (3, run.split("\n")[0] + "\nalone"), (4, run + "\n\n" + run)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text"))
    left = {r["doc_id"]: r["text"] for r in line_dedup.without_repeats(docs).collect()}
    assert left == {1: rows[0][1], 2: "other", 3: rows[2][1]}


def deleted_lines(texts, least=50):
    """Lines of every run of ``least`` words that stands earlier: each pair of places, as far as it goes."""
    lines = {d: [(n, " ".join(x.split())) for n, x in enumerate(text.split("\n")) if x.split()] for d, text in texts.items()}
    places = [(d, i) for d in sorted(lines) for i in range(len(lines[d]))]
    gone = {d: set() for d in texts}
    for b, (two, j) in enumerate(places):
        for one, i in places[:b]:
            n = 0
            while i + n < len(lines[one]) and j + n < len(lines[two]) and lines[one][i + n][1] == lines[two][j + n][1]:
                n += 1
            if sum(len(x.split()) for _, x in lines[two][j:j + n]) >= least:
                gone[two].update(range(lines[two][j][0], lines[two][j + n - 1][0] + 1))
    return gone


def test_line_runs_reach_both_ends(spark):
    def line(name, words):
        return " ".join(f"{name}{i}" for i in range(words))

    texts = {1: [line("a", 100), line("b", 20)], 2: [line("a", 100), line("b", 20)], 3: ["new", line("b", 20)]}
    texts |= {4: [line(c, n) for c, n in zip("cdef", (30, 30, 30, 10), strict=True)] * 2, 5: [line("b", 20), line("c", 30), line("d", 30)]}
    rng = np.random.default_rng(8)
    parts = [line(c, n) for c, n in zip("ghijkl", (3, 10, 20, 30, 49, 60), strict=True)] + ["", " "]
    texts |= {d: [parts[k] for k in rng.integers(0, len(parts), rng.integers(1, 9))] for d in range(10, 60)}
    texts = {d: "\n".join(x) for d, x in texts.items()}
    gone = deleted_lines(texts)
    assert gone[2] == {0, 1} and gone[3] == set() and gone[4] == {4, 5, 6, 7}
    for r in line_dedup.line_report(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect():
        left = "\n".join(x for n, x in enumerate(texts[r["doc_id"]].split("\n")) if n not in gone[r["doc_id"]])
        assert (r["n_deleted"], r["left_sha256"]) == (len(gone[r["doc_id"]]), hashlib.sha256(left.encode()).hexdigest())


def base_spans(text):
    def luhn(digits):
        total = 0
        for i, c in enumerate(reversed(digits)):
            n = int(c) * (2 if i % 2 else 1)
            total += n - 9 * (n > 9)
        return total % 10 == 0

    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    spans += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    spans += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_base_spans_match_plain_patterns(spark):
    texts = [
        "a@b.com_x@y.org a@b.c.d@e.f @x. a@b 😀é q@w.ee", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3 9.9.9.9.",
        "4111 1111-1111 1111 4111111111111111 41111111111111112222 1 2 3", "+1 (705) 555-1902 +12 +49 30 1234567890123456 ++1-234-567-89",
        None, "", "x" * 5000 + "@", "9" * 3000, "a.a@" + ".".join(["b"] * 4000),
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find(rows).collect():
        want = base_spans(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert sum(r[f"n_{k}"] for k in pii.KINDS) == (want.count(",") + 1 if want else 0)


def test_addresses_with_zero_parts(spark):
    texts = ["10.0.0.1 127.0.0.1 192.168.0.1 0.0.0.0 00.000.0255.1", "000.256.0.1 0.0.0 10.0.0.300 8.8.8.8 " + "0" * 3000 + ".1.2.3", "0.0.0." + "0" * 3000 + "256"]
    for r in pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        want = base_spans(texts[r["doc_id"]])
        assert r["n_ip"] == (5, 2, 0)[r["doc_id"]] and r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
    docs = spark.createDataFrame([(1, "at 10.0.0.1 now")], "doc_id long, text string")
    assert pii.redacted(docs).first()["text"] == "at [IP] now"


def mixed_texts(count):
    """Texts of words, runs and identifiers, with gaps around the reach of a context."""
    rng = np.random.default_rng(21)
    parts = ["word", "Two", "a@b.co", "10.0.0.1", "1.2.3.4.5.6.7.8", "4111 1111-1111 1111", "+1 (705) 555-1902", "+1", "7", "x7", "@", "+49(", "5)",
             "é😀", "(", "-", ".", "w" * 79, "w" * 81, "w" * 160 + "3", "agent77(at)host", "by mail", "q.r@s.tu_v@w.xy", "+1234567" + " " * 120 + "89"]
    gaps = [" ", " ", " ", " ", "", "\n", "\t ", " - ", " " * 79, " " * 80, " " * 81, "(" + " " * 90, " word" * 15, " word" * 16 + " ", " word" * 17, " word" * 40 + " "]
    return ["".join(gaps[rng.integers(len(gaps))] + parts[rng.integers(len(parts))] for _ in range(rng.integers(1, 14))) for _ in range(count)]


def test_matches_and_contexts_equal_those_of_the_whole_text(spark):
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+){3}",
             "card": r"[0-9](?:[\x20-]?[0-9]){15,}", "phone": r"\+[0-9][\x20().0-9-]+[0-9]", "other": r"(?<!\S)[^\s0-9@]*[0-9@]\S*"}
    texts = [*mixed_texts(600), "", "no digits " * 50, "x " * 900 + "9", "1 " * 900, "9" * 300 + " tail" * 300]
    want = []
    for n, text in enumerate(texts):
        for kind, pattern in plain.items():
            last = 0
            for m in re.finditer(pattern, text, re.ASCII):
                want.append((n, kind, m[0], m.start(), m.end(), text[last:m.start()][-pii.CONTEXT:]))
                last = m.end()
    want = spark.createDataFrame(want, "doc long, kind string, value string, start long, end long, left string")
    want = want.filter(pii.is_valid(F.col("kind"), F.col("value"))).withColumn("slot", pii.slot_of(F.col("left")))
    names = ["doc", "kind", "value", "start", "end", "slot"]
    got = pii.occurrences(spark.createDataFrame(list(enumerate(texts)), "doc long, text string")).select(names)
    bare = {n for n, text in enumerate(texts) if not re.search("[0-9@]", text)}
    assert Counter(map(tuple, got.filter("kind is null").select("doc").collect())) == Counter((n,) for n in bare)
    assert Counter(map(tuple, got.filter("kind is not null").collect())) == Counter(map(tuple, want.select(names).collect()))


def test_no_pattern_of_a_kind_runs_over_whole_texts(spark):
    rows = spark.createDataFrame([(1, "at 10.0.0.1")], "doc long, text string")
    plan = pii.occurrences(rows)._jdf.queryExecution().optimizedPlan().toString()
    # One look for pieces, then each kind once over the end of a piece.
    assert plan.count("regexp_extract_all(") == 1 + len(pii.PATTERNS) and plan.count("split(near") == len(pii.PATTERNS)
    assert len(re.findall(r"regexp_extract_all\(near", plan)) == len(pii.PATTERNS)


def test_slot_counts_equal_brute_force(spark):
    texts = [*mixed_texts(200), "Two  words\n\ttwo WORDS", " two\x0bwords É two é words\r", "", " ", None] + ["Two words two"] * 3
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), re.sub(r"[\x20\x09-\x0D]+", " ", t)).strip(" ").split(" ") for t in texts if t]
    want = Counter(p for w in words for p in zip(w, w[1:], strict=False))
    some = [*list(want)[::3], ("two", "words"), ("never", "there")]
    pairs = spark.createDataFrame(some, "a string, b string").select("a", "b", F.xxhash64("a", "b").alias("slot")).distinct()
    got = pii.slot_counts(spark.createDataFrame([(t,) for t in texts], "text string"), pairs.select("slot")).join(pairs, "slot").collect()
    assert {(r["a"], r["b"]): r["total"] for r in got} == {p: want[p] for p in some if want[p]} and want["two", "words"] == 6


def test_context_finds_unseen_identifiers(spark):
    rows = [(i, f"please reach me by mail user{i}@host.org today") for i in range(8)]
    rows += [(20, "reach me by mail agent77(at)host now"), (21, "it costs by weight 77 euro")]
    found = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[20] == "email:17:32" and found[21] == ""
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {r["doc_id"]: r["text"] for r in pii.redacted(docs).collect()}
    assert clean[0] == "please reach me by mail [EMAIL] today" and clean[20] == "reach me by mail [EMAIL] now" and clean[21] == rows[-1][1]


def test_topk_equals_brute_force_over_shards(spark):
    rng = np.random.default_rng(3)
    data = [(i, [float(x) for x in rng.normal(size=40)]) for i in range(300)]
    data += [(1000 + i, data[7][1]) for i in range(60)] + [(50, data[3][1]), (2000, None), (2001, []), (None, data[0][1])]
    rows = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in topk_search.search(rows, shard_codes=50).collect():
        got.setdefault(r["query_id"], []).append((r["distance"], r["vec_id"]))
    codes = [(i, np.array(v) > 0) for i, v in data if i is not None and v]
    for q in {i for i, _ in codes if i % 50 == 0}:
        want = sorted({(min_d, i) for i, c in codes if i != q for min_d in [int((c != x).sum()) for j, x in codes if j == q]})[:10]
        assert sorted(got[q]) == want


def test_exact_groups_survive_digest_collisions(odd):
    def weak(text):
        return F.pmod(F.length(text), F.lit(3)).cast("string")

    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in ODD]
    for digest in (exact_dedup.sha256_digest, weak):
        got = exact_dedup.dedup(odd, digest).collect()
        sizes = Counter(texts)
        assert Counter((r["text_sha256"], r["group_size"]) for r in got) == Counter(
            (hashlib.sha256(t.encode()).hexdigest(), sizes[t]) for t in texts)
        keep = {t: min((i for (i, *_), x in zip(ODD, texts, strict=True) if x == t and i is not None), default=None) for t in texts}
        assert {(r["text_sha256"], r["keep_id"]) for r in got} == {(hashlib.sha256(t.encode()).hexdigest(), k) for t, k in keep.items()}


def test_base_score_counts_and_normalised_model(spark):
    docs = small_docs()
    got = QUERIES["op5_lm_scoring"](spark, SMALL).toPandas().set_index("doc_id")
    counts, tokens = Counter(), {i: t.encode().lower().split() + [b""] for i, t in zip(docs.doc_id, docs.text, strict=True)}
    for i, t in tokens.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(t)
    total, types = sum(counts.values()), len(counts)
    for i, t in tokens.items():
        row = got.loc[i]
        assert math.isclose(row.base_score, sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in t), rel_tol=1e-9)
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(t), sum(counts[w] > 0 for w in t), total)
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()
    scorer = lm.Scorer([b"", b"a", b"b", b"c"], np.array([3, 5, 4, 1]), 4, lm.Parameters.start(np.array([0.2, 0.2, 0.3, 0.3])), 13, 4, 3.0)
    sums = np.exp(scorer.one[:, None, :] + scorer.two[None, :, :]).sum(2)
    assert np.allclose(np.log(sums), scorer.norm, atol=1e-4)


def test_pieces_equal_the_library():
    import sentencepiece

    path = tokenizer_file("piece_bpe_32k.model")
    sp, model = sentencepiece.SentencePieceProcessor(model_file=path), pieces.piece_model(path)
    rng = np.random.default_rng(1)
    texts = [r[1] or "" for r in ODD] + list(small_docs().text)
    texts += ["".join(rng.choice(list("abe "), 400)) for _ in range(60)] + ["   a", " ", "\n\n x\r", "component destroy" * 40, "<s> <0x0A>"]
    for text, data in zip(texts, model.encode_batch(texts), strict=True):
        ids = sp.encode(text, add_bos=True, add_eos=True)
        got = np.frombuffer(data, "<u4")
        assert got.tolist() == ids and model.decode(got) == sp.decode(ids)


def test_language_held_out_accuracy(spark, odd):
    got = QUERIES["op7_language_id"](spark, "/root/testdata/sf0.01").toPandas()
    docs = duckdb.sql("SELECT doc_id, lang FROM '/root/testdata/sf0.01/documents.parquet'").df().merge(got, on="doc_id")
    held = docs[docs.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.98 and docs.rejected.mean() < 0.01 and docs.score.between(0, 1).all()
    found = language.identify(odd).toPandas()
    assert len(found) == len(ODD) and (found[found.doc_id.isin([1, 2, 3])].lang_pred == "und").all()


def test_urls_without_parts_and_split_lists(spark):
    urls = [None, "no-scheme/x", "http://", "HTTP://A.Example.NET/en/x?y#z", "http://example.com", "http://x.net#f", "http://spam-a.org/1", "http://b.org/2"] * 2
    urls += [f"http://spam{i}.info/{i}" for i in range(200)] + [f"http://good{i}.info/{i}" for i in range(400)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    whole = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_pages(pages).collect()}
    parts = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_pages(pages, shard_bits=1024).collect()}
    assert whole == parts
    assert whole[0] == ("", "", None, "allow") and whole[3] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert whole[5][2:] == (None, "allow") and whole[6][3] == "block" and whole[7][3] == "allow"
    assert all(whole[i][3] == ("block" if "spam" in urls[i] else "allow") for i in range(16, len(urls)))


def exact_components(rows):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                one, two = sorted((root(a), root(b)))
                parent[two] = one
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("chunk", [4096, 8])
def test_near_groups_equal_all_pairs(spark, chunk):
    rng = np.random.default_rng(9)
    rows, base = [], [f"w{i}" for i in rng.integers(0, 500, 120)]
    for i in range(60):
        words = list(base)
        for at in rng.integers(0, len(words), int(rng.integers(0, 6))):
            words[at] = f"x{rng.integers(0, 10_000)}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join(f"v{x}" for x in rng.integers(0, 50, 40))) for i in range(30)] + [(200, None), (201, ""), (202, "a b"), (203, "A  b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_groups(docs, chunk).collect()}
    assert got == exact_components(rows)


def test_a_large_group_is_dealt_once_and_not_once_a_band(spark):
    # 40 buckets of nearly the same members, and one of others.
    rows = [(b, n) for b in range(40) for n in range(400) if n == 0 or (b + n) % 10] + [(99, 1000 + n) for n in range(300)] + [(100, 5), (100, 6)]
    buckets = spark.createDataFrame(rows, "bucket long, node long")
    sizes = buckets.groupBy("bucket").agg(F.count("node").alias("n"), F.min("node").alias("pivot"))
    groups = near_dedup.wide_groups(buckets.join(sizes, "bucket"), 64)
    assert {r["pivot"]: (r["rows"], r["n"]) for r in groups.groupBy("pivot").agg(F.count("node").alias("rows"), F.max("n").alias("n")).collect()} == {
        0: (400, 400), 1000: (300, 300)}
    state = groups.withColumn("comp", F.when(F.col("node") % 40 == 39, F.col("node")).otherwise(F.col("pivot"))).withColumn("failed", F.lit(None).cast("array<long>"))
    dealt = near_dedup._open_groups(state, None, 64).toPandas()
    assert (dealt.chunk < 0).all() and dealt.groupby(["bucket", "chunk"]).size().max() <= 2 * 64
    # Every outsider meets every other member.
    for pivot, part in dealt.groupby("bucket"):
        met = {(a, b) for _, c in part.groupby("chunk") for a in c.node[c.probe] for b in c.node if a != b}
        members = set(part.node)
        assert met == {(a, b) for a in part.node[part.probe].unique() for b in members if a != b}
        assert len(part) <= 2 * len(members)


def test_small_buckets_of_the_same_members_are_one_group(spark):
    # 20 buckets of the same five, and 30 that have their smallest member alone in common.
    rows = [(b, n) for b in range(20) for n in range(5)] + [(100 + b, n) for b in range(30) for n in (50, 1000 + 2 * b, 1001 + 2 * b)]
    buckets = spark.createDataFrame(rows, "bucket long, node long")
    sizes = buckets.groupBy("bucket").agg(F.count("node").alias("n"), F.min("node").alias("pivot"))
    dealt = buckets.join(sizes, "bucket")
    alike = near_dedup.overlapping(dealt)
    assert [r["pivot"] for r in alike.collect()] == [0]
    groups = near_dedup.wide_groups(dealt, 4096, alike)
    assert sorted(tuple(r) for r in groups.select("pivot", "node", "n").collect()) == [(0, n, 5) for n in range(5)]
    # Without them every member is dealt once a bucket.
    state = groups.withColumn("comp", F.col("node")).withColumn("failed", F.lit(None).cast("array<long>"))
    assert near_dedup._open_groups(state, None, 4096).count() == 5


def test_near_groups_of_many_near_copies(spark):
    rng = np.random.default_rng(3)
    base, rows = [f"w{i}" for i in range(90)], []
    for i in range(220):
        words = list(base)
        for at in rng.integers(0, len(words), int(rng.integers(0, 5))):
            words[at] = f"x{rng.integers(0, 100_000)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_groups(docs, 32).collect()}
    assert got == exact_components(rows)


def test_near_copies_below_the_threshold_make_no_row_per_pair(spark, monkeypatch):
    # Every pair has a similarity of 0.73, which survives the signatures; one is linked.
    common, rows = [f"w{i}" for i in range(170)], []
    for i in range(300):
        rows.append((i, " ".join([*common, *(f"x{i}-{k}" for k in range(30))])))
    rows.append((300, f"{rows[7][1]} end"))
    made, pinned = [], near_dedup.pinned

    def counted(df, name="pinned"):
        done = pinned(df, name)
        made.append((done.count(), name))
        return done

    monkeypatch.setattr(near_dedup, "pinned", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_groups(docs).collect()}
    assert got == exact_components(rows)
    assert max(made)[0] <= near_dedup.BANDS * len(rows)


def test_members_with_large_sets_meet_in_more_chunks(spark):
    state = spark.range(60).selectExpr("0L AS pivot", "id AS node", "60L AS n", "IF(id < 30, 0L, id) AS comp")
    sized = spark.range(60).selectExpr("id AS node", "400000L AS size")
    dealt = near_dedup._open_groups(state, sized, 4096).toPandas()
    assert dealt.groupby("chunk").size().max() * 400_000 <= 3 * near_dedup.CHUNK_SHINGLES
    met = {(a, b) for _, c in dealt.groupby("chunk") for a in c.node[c.probe] for b in c.node if a != b}
    assert met == {(a, b) for a in range(30, 60) for b in range(60) if a != b}
    assert near_dedup._open_groups(state, None, 4096).select("chunk").distinct().count() == 1


def test_sets_are_linked_from_75_percent_on():
    one, many = np.arange(100, dtype=np.uint64), [range(75), range(74), range(100), range(25, 125), [99], range(200, 300), [*range(100), 200]]
    assert near_dedup.linked_to(one, [np.array(x, np.uint64) for x in many]).tolist() == [True, False, True, False, False, False, True]


def test_pruning_loses_few_pairs_over_all_steps():
    t = 0.75 + 0.25 / 256
    lost = [sum(math.comb(n, k) * t ** k * (1 - t) ** (n - k) for k in range(m)) for n, m in near_dedup.least_matches()]
    assert sum(lost) <= near_dedup.MISS


def test_components_of_a_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


def test_packing_keeps_every_token(spark, odd):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    got = packing.pack(odd.repartition(5), path, 256).toPandas()
    want = Counter()
    for doc_id, text, *_ in ODD:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 256):
            part = np.array(ids[k:k + 256], "<u4")
            want[(-1 if doc_id is None else doc_id, k // 256, k, len(part), zlib.crc32(part.tobytes()))] += 1
    ids = got.doc_id.fillna(-1).astype(int)
    assert Counter(zip(ids, got.piece, got.start, got.length, got.ids_crc32, strict=True)) == want
    placed = got.sort_values(["sequence_id", "offset"])
    assert (placed.groupby("sequence_id").length.cumsum() - placed.length == placed.offset).all()
    assert got.groupby("sequence_id").length.sum().max() <= 256
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 256) + 2


def test_every_underfull_bin_is_packed_on(spark):
    assert packing.left_open(np.full(5000, 1500), packing.SEQUENCE).all()
    rng = np.random.default_rng(4)
    for _ in range(60):
        capacity = int(rng.integers(4, 80))
        sizes = rng.integers(1, capacity + 1, rng.integers(1, 300))
        plan = packing.best_fit_plan({int(k): int(n) for k, n in zip(*np.unique(sizes, return_counts=True), strict=True)}, capacity)
        rows = [plan[(plan[:, 0] == s) & (plan[:, 1] <= r)][-1] for s, r in zip(sizes, packing.rank_in_size(sizes), strict=True)]
        bins = [x[3] + (r - x[1]) // x[2] for x, r in zip(rows, packing.rank_in_size(sizes), strict=True)]
        assert sorted(np.bincount(bins, weights=sizes)) == sorted(packing.best_fit(sizes, capacity)[2])
    texts = [" ".join(["word"] * n) for n in rng.integers(130, 200, 300)] + [" ".join(["word"] * n) for n in range(20, 60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(40)
    got = packing.pack(docs, tokenizer_file("word_bpe_49k.json"), 256).toPandas().sort_values(["sequence_id", "offset"])
    assert len(got) == len(texts) and (got.groupby("sequence_id").length.cumsum() - got.length == got.offset).all()
    full = np.sort(got.groupby("sequence_id").length.sum())
    goes_on = full[full < 256 - packing.SLACK]
    assert full.max() <= 256 and (len(goes_on) < 2 or goes_on[:2].sum() > 256)


def test_operators_take_odd_and_empty_tables(odd, none):
    tokenizer = tokenizer_file("word_bpe_49k.json")
    runs = [line_dedup.line_report, pii.find, exact_dedup.dedup, lm.score, language.identify, near_dedup.near_groups,
            lambda d: pieces.digest_pieces(d, tokenizer_file("piece_bpe_32k.model"))]
    for run in runs:
        assert run(odd).count() == len(ODD) and run(none).count() == 0
    assert packing.pack(none, tokenizer).count() == 0
    for stage in (line_dedup.without_repeats, pii.redacted, near_dedup.keep_one, language.keep_known):
        assert stage(odd).columns == odd.columns and stage(none).count() == 0


def test_pipeline_stages_keep_the_columns(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "line_dedup", "near_dedup", "pii", "packing"]
    kept = pd.Series({i: t for i, t in zip(small_docs().doc_id, small_docs().text, strict=True)})
    result = corpus_pipeline.run(spark, SMALL).toPandas()
    assert set(result.doc_id) <= set(kept.index) and len(set(result.doc_id)) > 0.8 * docs.count()


def test_head_words_by_count_without_sorting_all(spark):
    rng = np.random.default_rng(8)
    counts = [1] * 300 + [2] * 70 + rng.integers(3, 400, 90).tolist()
    rows = spark.createDataFrame([(f"w{i}", int(c)) for i, c in enumerate(counts)], "word string, c long").repartition(5)
    for size in (0, 1, 20, 90, 100, 160, 200, 460, 1000):
        cut = lm.cut_off(rows, size)
        assert sum(c > cut for c in counts) <= size and (cut == 0 or sum(c > cut - 1 for c in counts) > size)


def test_scores_do_not_depend_on_the_head(odd):
    got = [{(r["doc_id"], r["n_known"]): r["base_score"] for r in lm.score(odd, head_size=n, classes=4).collect()} for n in (5, 900, 200_000)]
    assert got[0].keys() == got[1].keys() == got[2].keys()
    for key, base in got[0].items():
        assert math.isclose(base, got[1][key], rel_tol=1e-9) and math.isclose(base, got[2][key], rel_tol=1e-9)


def test_scores_without_training_documents(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    got = lm.score(spark.createDataFrame([(i, "some words") for i in ids], "doc_id long, text string")).collect()
    assert len(got) == len(ids) and {(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got} == {(3, 0, 0, 0.0)}


def test_language_sample_moves_ids_alone(spark, odd):
    sample = language.training_sample(odd, 2)
    assert all(0 < n <= 2 for _, n in sample.groupBy("lang").count().collect())
    plan = sample._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_host_and_path_of_any_column(spark):
    urls = ["HTTPS://A.Example.com/de/x?q#f", "http://b://c/d", "no address", None, "x://", "http://é.net#y"]
    rows = spark.createDataFrame([(u, "http://wrong/") for u in urls], "address string, url string")
    host, path = url_filter.host_and_path(F.col("address"))
    got = [tuple(r) for r in rows.select(host, path).collect()]
    assert got == [("a.example.com", "/de/x"), ("b:", "//c/d"), ("", ""), ("", ""), ("", ""), ("é.net", "")]
