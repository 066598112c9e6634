"""The dealt operators against brute force, and on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import io
import itertools
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import ann, boosting, chat, exact_dedup, mixing, near_dup, pieces, pii, sharding, token_files, toxicity

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, _h string, row string"


def odd_docs(spark):
    """Nulls, blanks, a long text, ties, repeated rows, columns with the operators' own names."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    texts = [None, "", "   \n", long, base, base + " ", base.replace(" ", "\n"), "one two", "ONE  two", base, "é漢🙂 " + base, "x" * 50_000]
    rows = [(i, t, "en", f"s{i % 3}", None, "clash", "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[4], (None, "null id", None, None, None, None, None)], DOC)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOC)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert sharding.assign_shards(docs).isEmpty()
    assert mixing.mix(docs).isEmpty() and mixing.mixed_documents(docs).columns == docs.columns
    assert exact_dedup.exact_dedup(docs).isEmpty() and exact_dedup.dedup_documents(docs).columns == docs.columns
    assert near_dup.near_duplicates(docs).isEmpty() and near_dup.dedup_documents(docs).columns == docs.columns
    assert pii.report(docs).isEmpty()
    assert chat.chat_digests(chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).isEmpty()
    weights, forest = toxicity.fit(docs, labels)
    assert toxicity.score(docs, weights, forest).isEmpty()
    assert ann.search(spark.createDataFrame([], "vec_id long, embedding array<float>"), lambda i: i % 2 == 0).isEmpty()


# --- sharding -----------------------------------------------------------------------------------------------------


def test_shards_split_only_where_needed(spark):
    docs = odd_docs(spark).unionByName(odd_docs(spark).withColumn("doc_id", F.col("doc_id") + 100))
    limit = 20_000
    rows = sharding.assign_shards(docs, limit).collect()
    assert len(rows) == docs.count()
    keys = {r["doc_id"]: int(hashlib.md5(("" if r["doc_id"] is None else str(r["doc_id"])).encode()).hexdigest()[:15], 16) for r in rows}
    total = lambda d, p: sum(r["bytes"] for r in rows if keys[r["doc_id"]] >> (60 - d) == p)
    for r in rows:
        k = keys[r["doc_id"]]
        alone = lambda d, k=k: len({v for v in keys.values() if v >> (60 - d) == k >> (60 - d)}) == 1
        depth = next(d for d in range(61) if total(d, k >> (60 - d)) <= limit or alone(d))
        assert (r["depth"], r["shard"]) == (depth, f"{k:060b}"[:depth])
        assert r["shard_bytes"] == total(depth, k >> (60 - depth)) and r["oversize"] == (r["shard_bytes"] > limit)


# --- toxicity -----------------------------------------------------------------------------------------------------


def test_trees_and_calibration():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 5))
    y = ((x[:, 0] > 0.6) & (x[:, 3] < 0.5)).astype(float)
    forest = boosting.fit(x[:2000], y[:2000], x[2000:3000], y[2000:3000])
    score = forest.score(x[3000:])
    assert ((score >= 0.5) == (y[3000:] > 0.5)).mean() > 0.98
    order = np.argsort(forest.margin(x[3000:]))
    assert (np.diff(score[order]) >= -1e-12).all() and score.min() >= 0 and score.max() <= 1


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.query(spark, "/root/testdata/sf0.01").join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    unseen = [r for r in rows if r["held_out"]]
    hits = sum(r["predicted"] and r["toxic"] for r in unseen)
    assert hits >= 0.5 * sum(r["toxic"] for r in unseen) and hits >= 0.7 * sum(r["predicted"] for r in unseen)
    weights, forest = toxicity.fit(docs, labels)
    odd = toxicity.clean_documents(odd_docs(spark), labels.limit(0))
    assert odd.columns == odd_docs(spark).columns and odd.count() == 14
    assert len({r["score"] for r in toxicity.score(odd_docs(spark).where("doc_id < 3"), weights, forest).collect()}) == 1


# --- nearest neighbours -------------------------------------------------------------------------------------------


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x[100:400] = x[100]  # a group of copies
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(5000, None), (5001, [0.0] * 16), (5002, [float("nan")] * 16), (5003, [1.0] * 3), (None, [1.0] * 16), (5020, [None] * 16)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>")
    found = defaultdict(list)
    for r in ann.search(df, lambda i: i % 20 == 0).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    x = x.astype(float)
    hit = 0
    assert sorted(found) == list(range(0, 3000, 20))
    for q, got in found.items():
        score = (x * x[q]).sum(axis=1)
        order = [i for i in np.lexsort((np.arange(3000), -score)) if i != q][:20]
        hit += len({i for i, _ in got} & set(order))
        assert len(got) == 20 and all(s == score[i] for i, s in got)
    assert hit / (20 * len(found)) >= 0.9
    few = ann.search(df.where("vec_id < 5"), lambda i: i == 0).collect()
    assert [r["rank"] for r in few] == [1, 2, 3, 4]


def test_neighbours_of_vectors_unlike_the_rest(spark):
    """Vectors that ask lie where hardly any other does, so what others need to find theirs tells nothing of them."""
    rng = np.random.default_rng(11)
    x = np.concatenate([0.05 * rng.normal(size=(6000, 16)), 3 * np.sign(rng.normal(size=(6000, 16)))], axis=1)
    x[::20] = np.concatenate([rng.normal(size=(300, 16)), np.zeros((300, 16))], axis=1)
    x = x.astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = defaultdict(list)
    for r in ann.search(df, lambda i: i % 20 == 0).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append(r["vec_id"])
    for q in range(0, 6000, 20):
        order = np.lexsort((np.arange(6000), -(x * x[q]).sum(axis=1)))
        assert found[q] == [i for i in order[:21].tolist() if i != q][:20]


def test_exact_neighbours_with_repeated_ids(spark):
    """Ids held by several rows, with one vector and with different ones; a clashing column; blocks of few vectors."""
    rng = np.random.default_rng(3)
    x = [(i, rng.normal(size=8)) for i in range(200)]
    x += [(20, x[20][1]), (20, rng.normal(size=8)), (21, x[21][1]), (40, x[40][1])]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in x], "vec_id long, embedding array<double>").withColumn("list", F.lit("clash"))
    expected = []
    for q_id, q in {(i, tuple(v)) for i, v in x if i % 20 == 0}:
        near = sorted((-float((v * np.array(q)).sum()), i) for i, v in x if i != q_id)[:20]
        expected += [(q_id, rank, i, -s) for rank, (s, i) in enumerate(near, 1)]
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.search(df, lambda i: i % 20 == 0, exact=True).collect()]
    assert sorted(got) == sorted(expected) and len(got) == 11 * 20


# --- personal data ------------------------------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    def ok(kind, v):
        d = re.sub("[^0-9]", "", v)
        if kind == "ip":
            return all(int(p) <= 255 for p in v.split("."))
        if kind == "card":
            s = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
            return 13 <= len(d) <= 19 and s % 10 == 0
        return kind != "phone" or 9 <= len(d) <= 15

    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text) if ok(k, m.group())]


def test_base_spans(spark):
    rng = random.Random(2)
    bits = ["a@b.com", "_x@y.co", "+1 (619) 555-0053", "4111 1111 1111 1111", "1.2.3.4", "256.1.1.1", "0255.1.1.1", "🙂", "é", " ", ".", "-", "@", "+", "12", "4565410125667261", "\n"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(400)] + [None, "", "a" * 60_000 + "@", "1." * 20_000, "+1" + " " * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.report(docs).collect():
        spans = base_spans(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest(), texts[r["doc_id"]][:80]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s.startswith(k) for s in spans) for k in pii.KINDS]
        assert set(spans) <= set(r["spans"].split(","))


def test_many_spans_in_one_text(spark):
    """Thousands of matches of all kinds, base and proposed, in one text, a repeated row and clashing columns."""
    text = "".join(f"a{i}@b.com 1.2.3.{i % 300} +1 (619) 555-{i % 9000 + 1000} mail bob{i} at example dot com; " for i in range(2000))
    docs = spark.createDataFrame([(1, text), (1, text), (2, "")], "doc_id long, text string").withColumn("base", F.lit("clash")).withColumn("more", F.lit(1))
    rows = pii.report(docs).collect()
    assert len(rows) == 3
    for r in rows[:2]:
        spans = base_spans(text) if r["doc_id"] == 1 else []
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(r["spans"].split(","))
        assert sum(f"bob{i}" in text[int(a) : int(b)] for i, (k, a, b) in zip(range(2000), (x.split(":") for x in r["spans"].split(",") if x and x not in set(spans)), strict=False)) >= 1990


def test_more_spans_and_redaction(spark):
    texts = ["call (619) 555-0053 or bob at example dot com", "version 1.2 of 1999-2004, no 123 456 789", "card 4111.1111.1111.1111 mail a@b.com"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in pii.report(docs).collect()}
    assert "phone:5:19" in spans[0] and "email:23:45" in spans[0] and spans[1] == "" and "card:5:24" in spans[2]
    assert {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}[2] == "card [CARD] mail [EMAIL]"


# --- chat ---------------------------------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    said = [chat.PROBE, "\\", "a\\a\\\\b#\\#", "### </turn>\n" * 3, "###### </turn>\n</turn", "", None, "a\\:b", "<\\/turn>", "🙂\n### user:\n"]
    rows = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(said)] + [(2, 0, "a:b\\", "x"), (3, None, None, None), (3, 0, "user", "hi"), (3, 0, "user", "hi")]
    made = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1)))
    got = {r["conv_id"]: r for r in chat.read_chats(made).collect()}
    assert [(t["role"], t["text"], t["loss"]) for t in got[1]["turns"]] == [(r[2], r[3] or "", r[2] == "assistant") for r in rows[:10]]
    assert [t["role"] for t in got[2]["turns"]] == ["a:b\\"] and [t["text"] for t in got[3]["turns"]] == ["", "hi", "hi"]
    inside = [p for r in got.values() for p in re.split(r"### (?:\\.|[^:\\])*:\n", r["formatted"].replace(" </turn>\n", ""))]
    assert not any(c in p for p in inside for c in ("#", "<"))
    assert (got[1]["valid"], got[2]["valid"], got[2]["bad_turn"]) == (True, False, 0)
    assert chat.segments(made).where("conv_id = 1 and loss").count() == 5
    digest = {r["conv_id"]: r for r in chat.chat_digests(made).collect()}[1]
    lossy = "".join(t or "" for t in said[1::2])
    assert (digest["loss_chars"], digest["loss_sha256"]) == (len(lossy), hashlib.sha256(lossy.encode()).hexdigest())


# --- SentencePiece ------------------------------------------------------------------------------------------------


def test_pieces_equal_the_library(spark):
    public = pytest.importorskip("public_tokenizers")
    import sentencepiece

    path = public.path("piece_bpe_32k.model")
    rng = random.Random(4)
    parts = ["ab", "the", "ing", " ", "  ", "\n", ".", ",", "é", "漢", "🙂", "\t", "_", "=", "▁", "0", "Q"]
    texts = [None, "", " ", "a  ", " " * 40] + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(500)]
    texts += [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + ["long " * 30_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pieces.encode_documents(docs, path).collect()
    expected = sentencepiece.SentencePieceProcessor(model_file=path).encode([t or "" for t in texts], num_threads=1)
    assert all(r["ids"] == expected[r["doc_id"]] and r["n_pieces"] == len(r["ids"]) and r["round_trip"] for r in rows)
    back = pieces.decode_documents(pieces.encode_documents(docs.limit(50), path), path).collect()
    assert all(r["text"] == (texts[r["doc_id"]] or "").replace("▁", " ") for r in back)


# --- token files --------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("bits", [1, 5, 8, 11, 16, 17, 32])
def test_packed_files(bits):
    rng = np.random.default_rng(bits)
    lengths = np.array([0, 3, 700, 1, 0, 90])
    ids = rng.integers(0, 1 << bits, lengths.sum()).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    stream = io.BytesIO()
    writer = token_files.TokenWriter(stream, bits, block=64)
    for i, doc_id in enumerate([5, 6, 7, 8, 9, None]):
        writer.add(doc_id, ids[starts[i] : starts[i + 1]])
    writer.close()
    raw = stream.getvalue()
    file = token_files.TokenFile(io.BytesIO(raw))
    assert file.doc_ids.tolist() == [5, 6, 7, 8, 9, token_files.NO_ID]
    for i in (2, 0, 5, 1, 3, 4):
        assert (file.document(i) == ids[starts[i] : starts[i + 1]]).all()
    assert len(raw) < 40 + 8 * 30 + len(ids) * bits / 8 + 20


def test_token_files(spark):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    more = [(50, " a  b\x85\n\n <|endoftext|> don't"), (51, "a b \t c "), (52, "a <|endoftext|> b"), (53, "<|endoftext|><|endoftext"), (50, "again"), (None, "")]
    docs = odd_docs(spark).select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    rows = sorted(docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or ""))
    expected, start = [], 0
    for r in rows:
        ids = np.array([*plain.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        expected.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = token_files.token_files(docs, path, 50_257, 2).orderBy("start").collect()
    assert [tuple(r) for r in got] == expected


# --- near and exact dedup -----------------------------------------------------------------------------------------


def brute_components(rows, words, percent):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets[i] = {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                    x, y = top(a), top(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in ids}


@pytest.mark.parametrize("small", [64, 3])
def test_near_duplicates(spark, monkeypatch, small):
    """small=3 sends the groups through the blocks of large buckets."""
    monkeypatch.setattr(near_dup, "SMALL", small)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    base = [rng.choice(words) for _ in range(120)]
    rows = []
    for i in range(160):
        text = list(base) if i % 4 else [rng.choice(words) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 12) if i % 4 else 0):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, " ".join(text)))
    rows += [(200, None), (201, ""), (202, "A b"), (203, "a  B"), (204, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("band", F.lit(1)).repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dup.near_duplicates(docs, words=4).collect()}
    assert got == brute_components(rows, 4, 80)


def test_components_of_chains_and_random_graphs(spark):
    """All orderings of short chains and many random graphs, side by side in one table, against union-find."""
    rng = random.Random(9)
    graphs = [list(zip(p, p[1:])) for n in (2, 3, 4, 5) for p in itertools.permutations(range(n))]
    graphs += [[(rng.randrange(n), rng.randrange(n)) for _ in range(rng.randint(1, n))] for n in (rng.randint(2, 40) for _ in range(200))]
    links = [(100 * g + a, 100 * g + b) for g, edges in enumerate(graphs) for a, b in edges]
    root = {i: i for a, b in links if a != b for i in (a, b)}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        if a != b:
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    # Graphs end in different rounds, which would hide an early end: chains of 5 also go alone.
    found = near_dup.components(spark.createDataFrame(links, "a long, b long"), near_dup.Stage(spark, "all"), "t").collect()
    assert sorted(map(tuple, found)) == [(i, top(i)) for i in sorted(root)]
    for p in ((0, 4, 2, 3, 1), (0, 2, 3, 4, 1), (1, 3, 2, 4, 0)):
        alone = spark.createDataFrame(list(zip(p, p[1:])), "a long, b long")
        assert sorted(map(tuple, near_dup.components(alone, near_dup.Stage(spark, "one"), "t").collect())) == [(i, 0) for i in range(5)]


def test_likelihood_estimates():
    rng = np.random.default_rng(6)
    for shared, own in ((800, 100), (500, 500), (100, 900)):
        h = rng.integers(0, 1 << 63, shared + 2 * own, dtype=np.uint64)
        a, b = h[: shared + own], np.concatenate([h[:shared], h[shared + own :]])
        x, y = (near_dup.sketch(s).astype(int)[None, :] for s in (a, b))
        union = near_dup.sketch(h).astype(int)
        assert (np.maximum(x, y)[0] == union).all()  # sketches merge
        est = near_dup.likely_similarity((x > y).sum(axis=1), (x < y).sum(axis=1), np.array([float(len(a))]), np.array([float(len(b))]))[0]
        assert abs(est - shared / (shared + 2 * own)) < 0.15


def test_near_dedup_of_odd_rows(spark):
    docs = odd_docs(spark)
    assert near_dup.near_duplicates(docs).count() == docs.count()
    kept = near_dup.dedup_documents(docs)
    assert kept.columns == docs.columns and kept.where("doc_id is null").count() == 1


@pytest.mark.parametrize("small", [64, 3])
def test_near_dedup_of_repeated_ids(spark, monkeypatch, small):
    """Each id has up to three texts; ids whose texts are linked, or equal, are one component."""
    monkeypatch.setattr(near_dup, "SMALL", small)
    rng = random.Random(11)
    words = [f"w{i}" for i in range(300)]
    bases = [[rng.choice(words) for _ in range(100)] for _ in range(25)]
    rows = [(i, "") for i in range(0, 60, 7)]
    for i in range(60):
        for _ in range(rng.choice([1, 1, 2, 3]) if i % 4 else 1):
            text = list(rng.choice(bases)) if rng.random() < 0.4 else [rng.choice(words) for _ in range(100)]
            text[rng.randrange(100)] = rng.choice(words)
            rows.append((i, " ".join(text)))
    rows += [rows[-1], (70, rows[20][1].upper()), (70, "")]
    alone = brute_components([(k, t) for k, (_, t) in enumerate(rows)], 4, 80)
    root = {i: i for i, _ in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, _) in enumerate(rows):
        x, y = top(i), top(rows[alone[k][1]][0])
        root[max(x, y)] = min(x, y)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, near_dup.near_duplicates(docs, words=4).collect()))
    assert got == sorted((i, alone[k][0], top(i), i == top(i)) for k, (i, _) in enumerate(rows))
    assert 1 < len({top(i) for i in root}) < len(root)
    kept = near_dup.dedup_documents(docs, words=4).collect()
    assert sorted(map(tuple, kept)) == sorted(r for r in rows if r[0] == top(r[0]))


def test_exact_dedup(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "TRIE_BYTES", 4096)
    docs = odd_docs(spark)
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append((-len(t), i is None, i or 0))
    expected = []
    for i, t in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", t)
        _, none, keep = min(groups[norm])
        keep = None if none else keep
        expected.append((i, keep, len(groups[norm]), i == keep, hashlib.sha256(norm.encode()).hexdigest()))
    assert sorted(map(str, (tuple(r) for r in exact_dedup.exact_dedup(docs).collect()))) == sorted(map(str, expected))
    kept = exact_dedup.dedup_documents(docs)
    assert kept.count() == len(groups) and kept.columns == docs.columns


def test_trie():
    rng = random.Random(7)
    trie, plain = exact_dedup.PatriciaTrie(), {}
    for i in range(3000):
        text = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9)))
        own = (rng.randint(0, 3), rng.choice([None, i]), 1)
        trie.insert(text, own)
        plain[text] = own if text not in plain else exact_dedup.better(plain[text], own)
    assert dict(trie.items()) == plain
    taken = {}
    while True:
        part = dict(trie.spill())
        if not part:
            break
        assert not taken.keys() & part.keys()
        taken |= part
    assert taken | dict(trie.items()) == plain


# --- mixing -------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("weights", [{"a": 1, "b": 1}, {"a": 0.7, "b": 0.2, "c": 0.1}, {"a": 5, "b": 3, "c": 3, "d": 1, "e": 0.01}])
def test_schedule_deviates_by_less_than_a_block(weights):
    whole = mixing.whole_weights(weights)
    total, exact = sum(whole.values()), sum(map(Fraction, weights.values()))
    assert all(Fraction(w, total) == Fraction(weights[s]) / exact for s, w in whole.items())
    plan = list(mixing.schedule(whole, dict.fromkeys(whole, 300)))
    done = dict.fromkeys(whole, 0)
    for s, k, slot, release, deadline in plan:
        done[s] += 1
        assert k == done[s] and release <= slot < deadline
        assert (release, deadline) == ((k - 1) * total // whole[s], -(-k * total // whole[s]))
        assert all(done[x] == 300 or abs(Fraction(whole[x] * (slot + 1), total) - done[x]) < 1 for x in whole)
    assert len({slot for _, _, slot, _, _ in plan}) == len(plan) == 300 * len(whole)


def test_many_sources_keep_their_exact_weights():
    """500 sources, one of 100 times the weight of another: over a million slots each block keeps the window of its target."""
    weights = {f"s{i:03d}": 1 for i in range(499)} | {"big": 100}
    blocks = {s: 1_000_000 * w // 599 for s, w in weights.items()}
    last = 0
    for s, k, slot, _, _ in mixing.schedule(weights, blocks):
        assert (k - 1) * 599 // weights[s] <= slot < -(-k * 599 // weights[s])
        last = max(last, slot)
    assert 999_000 < last < 1_000_000


def test_mix_keeps_every_row(spark):
    docs = odd_docs(spark).unionByName(odd_docs(spark).withColumn("source", F.lit("s9")))
    rows = mixing.mix(docs, block=16).select("row.doc_id", "row._h", *mixing.ADDED).collect()
    assert len(rows) == docs.count()
    slots = defaultdict(set)
    for r in rows:
        assert r["mix_release"] <= r["mix_slot"] < r["mix_deadline"] and r["mix_block"] == r["mix_offset"] // 16 + 1
        slots[r["mix_slot"]].add((r["mix_source"], r["mix_block"]))
    assert all(len(x) == 1 for x in slots.values())
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == docs.count()


def test_mix_refuses_a_missing_weight_and_bounds_its_blocks(spark, monkeypatch):
    docs = odd_docs(spark).where("source is not null")
    with pytest.raises(KeyError):
        mixing.mix(docs, {"s0": 1.0})
    monkeypatch.setattr(mixing, "MOST_BLOCKS", 10)
    rows = mixing.mix(docs, {"s0": 0.5, "s1": 0.25, "s2": 0.25}, block=1).select("mix_block").collect()
    assert len(rows) == 13 and max(r["mix_block"] for r in rows) <= 10


def test_too_many_sources_are_refused_as_stated(spark, monkeypatch):
    assert f"{mixing.MOST_SOURCES:,} sources" in mixing.__doc__
    monkeypatch.setattr(mixing, "MOST_SOURCES", 3)
    docs = odd_docs(spark)  # s0, s1, s2 and a null source
    assert mixing.mix(docs.where("source is not null")).count() == 13
    with pytest.raises(ValueError, match="more than 3 sources"):
        mixing.mix(docs)


# --- pipeline -----------------------------------------------------------------------------------------------------


def test_pipeline_is_its_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    weights, forest = toxicity.fit(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    toxic = {r["doc_id"] for r in toxicity.score(docs, weights, forest).where(f"score >= {toxicity.THRESHOLD}").collect()}
    left = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] not in toxic]
    best = {}
    for i, t in left:
        key = re.sub(r"[\x20\x09-\x0D]", "", t)
        best[key] = min(best.get(key, (0, 1 << 60)), (-len(t), i))
    kept = {i for _, i in best.values()}
    near = brute_components([x for x in left if x[0] in kept], 5, 80)
    rows = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(i for i, (_, top) in near.items() if i == top)
    assert all(r["round_trip"] for r in rows)
