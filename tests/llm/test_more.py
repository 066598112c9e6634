"""Cases of the dealt operators beyond their main tests: features by hand, odd labels, long conversations, repeats, filters."""

import hashlib
import math
import random
import re
import struct

import pytest
from pyspark.sql import functions as F

from tessera.llm import chat, common, exact_dedup, near_dup, pieces, token_files, toxicity


def plain_features(text, weights):
    """What toxicity.Lexicon.features says, worked out token by token."""
    tokens = text.split()
    if not tokens:
        return [0.0] * len(toxicity.FEATURES)
    bare = [re.sub(r"^[\W_]+|[\W_]+$", "", t) for t in tokens]
    low = [w.lower() for w in bare]
    weight = [max((weights.get(t, 0.0) for t in toxicity.terms(w)), default=0.0) if w else 0.0 for w in low]
    insult = [w in toxicity.INSULTS for w in low]
    hidden = [bool(re.search(r"[^\W\d_][\d@$!*]+[^\W\d_]", w)) for w in bare]

    def shows(i):
        if insult[i] or not (hidden[i] or "*" in tokens[i] or any(c in "@$!0134578" for c in bare[i])):
            return False
        said = re.sub(r"^[\W_]+|[\W_]+$", "", tokens[i].lower().translate(toxicity.LEET))
        return said in toxicity.INSULTS or re.sub(r"[\W_]+", "", said) in toxicity.INSULTS

    unmasked = [shows(i) for i in range(len(tokens))]
    you = [w in toxicity.SECOND_PERSON for w in low]
    n, letters = len(tokens), sum(map(len, tokens))
    hits = {t for t, a, b, c in zip(tokens, insult, weight, unmasked, strict=True) if a or b or c}
    at, addressed = [i for i, t in enumerate(tokens) if t in hits], [i for i in range(n) if you[i]]
    near = sum(any(abs(i - j) <= toxicity.NEAR for j in addressed) for i in at) / len(at) if at and addressed else 0.0
    hit = [w for w in weight if w]
    kinds = len({t for t, w in zip(tokens, weight, strict=True) if w})
    return [
        sum(insult) / n, math.log1p(sum(insult)), len(hit) / n, sum(hit) / n, math.log1p(len(hit)), math.log1p(kinds), max(hit, default=0.0), near,
        sum(you) / n, sum(c.isupper() for t in tokens for c in t) / letters, sum(len(w) > 2 and w.isupper() for w in bare) / n, text.count("!") / len(text),
        text.count("?") / len(text), sum(map(text.count, "@#$%&*+=<>^~|\\")) / len(text), sum(hidden) / n, math.log1p(sum(unmasked)),
        sum(bool(re.search(r"([^\W\d_])\1\1", w)) for w in low) / n, math.log1p(n), letters / n,
    ]


def test_toxicity_features_by_hand():
    weights = {"trash ": 2.0, "gro": 1.5, "vile ": 3.0}
    texts = ["", "You are TRASH!!! you id10t", "a gross, gross day; s*t$ and 1d1ot", "so vile... " * 50 + "du Idiot?", "ÜBER alles nooooo YOU", "x" * 3000 + " @#$ 12"]
    lexicon = toxicity.Lexicon(weights)
    for _ in range(2):  # the second time from the cache
        for text in texts:
            assert lexicon.features(text) == pytest.approx(plain_features(text, weights)), text


def test_toxicity_of_odd_labels(spark):
    """Several labels for a document, null labels, labels of no document, repeated rows."""
    rows = [(i, ("you vile idiot, you trash " if i % 3 == 0 else "a calm and sunny day ") * (1 + i % 4)) for i in range(120)]
    docs = spark.createDataFrame([*rows, rows[0], rows[1]], "doc_id long, text string").withColumn("score", F.lit("clash"))
    plain = [(i, int(i % 3 == 0)) for i in range(120)]
    odd = [*plain, *((i, 0) for i in range(0, 30, 3)), (1, None), (None, 1), (9999, 1), plain[5]]
    found = []
    for labels in (plain, odd):
        weights, forest = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        found.append(sorted(map(tuple, toxicity.score(docs, weights, forest).collect())))
    assert found[0] == found[1] and len(found[0]) == 122
    assert all((s >= 0.7) == (i % 3 == 0) for i, s in found[0])


def test_long_conversation(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"turn {t} " + "## <b> \\ " * (t % 7)) for t in range(4000)]
    said = spark.createDataFrame([*rows, (2, 0, "user", "x" * 300_000), (2, 1, "assistant", None)], "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.chat_digests(chat.format_chats(said)).collect()}
    whole = "".join(f"{r[2]}\n{r[3]}\n" for r in rows)
    lossy = "".join(r[3] for r in rows if r[2] == "assistant")
    assert got[1]["n_turns"] == 4000 and got[1]["valid"] and got[1]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
    assert got[1]["loss_sha256"] == hashlib.sha256(lossy.encode()).hexdigest() and got[2]["loss_chars"] == 0


def test_pieces_and_token_files_of_odd_rows(spark):
    public = pytest.importorskip("public_tokenizers")
    model, vocabulary = public.path("piece_bpe_32k.model"), public.path("byte_bpe_50k.json")
    docs = spark.createDataFrame([(None, "no id"), (1, "twice"), (1, "twice"), (2, None), (3, "q" * 20_000)], "doc_id long, text string")
    docs = docs.withColumn("ids", F.lit("clash")).withColumn("n_pieces", F.lit("clash"))
    got = sorted(((r["doc_id"] or 0, r["n_pieces"], r["round_trip"]) for r in pieces.encode_documents(docs, model).collect()))
    assert [i for i, _, _ in got] == [0, 1, 1, 2, 3] and got[1] == got[2] and got[3][1] == 0 and all(ok for _, _, ok in got)
    assert sum(r["n_tokens"] == 1 for r in token_files.token_files(docs, vocabulary, 50_257, 2).collect()) == 1
    assert pieces.encode_documents(docs.limit(0), model).isEmpty() and token_files.token_files(docs.limit(0), vocabulary, 50_257, 2).isEmpty()


def test_unigram_states_keep_the_best_sum():
    """The scored branch against all segmentations of short words."""
    model = pieces.PieceModel.__new__(pieces.PieceModel)
    model.bpe, model.bytes_fallback, model.unknown, model.pairs = False, False, 0, {}
    model.pieces = ["<unk>", "a", "b", "ab", "ba", "aba", "bb", "abab"]
    model.score = [0.0, -1.0, -1.2, -1.9, -2.5, -2.7, -2.1, -4.2]
    model.ids = {p: i for i, p in enumerate(model.pieces) if i}
    model.floor, model.longest, model.trie = min(model.score) - 10, 4, {}
    for p, i in model.ids.items():
        node = model.trie
        for ch in p:
            node = node.setdefault(ch, {})
        node[""] = i

    def best(word):
        if not word:
            return 0.0
        return max(model.score[model.ids[word[:n]]] + best(word[n:]) for n in range(1, len(word) + 1) if word[:n] in model.ids)

    words = ["".join("ab"[(k >> i) & 1] for i in range(n)) for n in range(1, 9) for k in range(1 << n)]
    for word, ids in model.words(words).items():
        assert "".join(model.pieces[i] for i in ids) == word and sum(model.score[i] for i in ids) == pytest.approx(best(word))


@pytest.mark.parametrize("bits", [26, 3])
def test_bitmap_filter_loses_nothing(spark, monkeypatch, bits):
    """With few bits the filter lets all through, and the result is the same."""
    monkeypatch.setattr(common, "FILTER_BITS", bits)
    rows = spark.range(2000).selectExpr("nullif(id, 7) as doc_id", "id as row", "'clash' as _maybe")
    gone = spark.range(0, 2000, 3).withColumnRenamed("id", "_gone")
    left = common.without(rows, "doc_id", gone)
    assert left.columns == rows.columns
    assert sorted(r["row"] for r in left.collect()) == [i for i in range(2000) if i % 3 or i == 7]


def test_dedup_of_rows_with_unique_and_repeated_ids(spark):
    rows = [(1, "a b"), (2, "ab"), (3, "c"), (4, "a  b"), (5, None), (6, "")]
    one = exact_dedup.dedup_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in one) == [3, 4, 5]
    more = exact_dedup.dedup_documents(spark.createDataFrame([*rows, (4, "a  b"), (3, "d")], "doc_id long, text string")).collect()
    assert sorted(map(tuple, more), key=str) == sorted([(3, "c"), (3, "d"), (4, "a  b"), (5, None)], key=str)


def test_blocks_of_long_documents(spark, monkeypatch):
    """Buckets whose blocks are cut by shingles rather than by members give the same components."""
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(w if (j * 7 + i * 13) % 41 or j % 5 else f"x{i}-{j}" for j, w in enumerate(base))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(map(tuple, near_dup.near_duplicates(docs, words=4).collect()))
    monkeypatch.setattr(near_dup, "SMALL", 3)
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", 1500)
    assert sorted(map(tuple, near_dup.near_duplicates(docs, words=4).collect())) == whole


def test_words_marks_and_line_ends_as_the_library():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), token_files.WordEncoder(path, words=40)
    draw, parts = random.Random(5), ["a", "Bc", "é", "è中", "  ", " ", "\n", "\n\n", "\t", "\r", "　", ".", "...", ",", "'s", "'", "1", "***", "x́", "😀", "_", "ª", "²"]
    for _ in range(4000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 14)))
        assert library.encode(text, add_special_tokens=False).ids == list(struct.unpack(f"<{len(own.encode(text)) // 4}I", own.encode(text))), repr(text)
