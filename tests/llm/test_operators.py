"""Each operator against a plain version, and on nulls, empty and long texts, repeated rows, empty tables and extra columns."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skyledger.llm import bpe, chat, decontaminate, dedup, langid, pii, quality_model, quality_rules, sharding

EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "the same few words in a row"), (5, "the same few words in a row"), (None, "no id"), (7, "long " * 30_000), (8, "a@b.co +1 (375) 555-4393 1.2.3.4 ü🙂")]
SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, SCHEMA)


def outcomes(spark):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (8, 1, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    bench = spark.createDataFrame([(1, "the same few words in a row"), (2, None), (3, "")], "item_id bigint, text string")
    path = bpe.tokenizer_path()
    return {
        "dedup": lambda x: dedup.classes(x),
        "model": lambda x: quality_model.score(x, quality_model.fit(x, labels)),
        "rules": lambda x: quality_rules.score(x, labels.where("quality = 1")),
        "bpe": lambda x: bpe.token_digests(x, path),
        "shards": lambda x: sharding.shard(x),
        "sections": lambda x: bpe.section_token_counts(x, path).where("section = 0"),
        "language": lambda x: langid.predict(x, langid.fit(x.withColumn("lang", F.lit("en")))),
        "benchmark": lambda x: x.join(decontaminate.overlaps(x, bench).select("doc_id").distinct(), "doc_id", "left_semi"),
        "pii": lambda x: pii.digest(x),
    }


@pytest.mark.parametrize("name", ["dedup", "model", "rules", "bpe", "shards", "sections", "language", "benchmark", "pii"])
def test_edges(spark, edge, name):
    run = outcomes(spark)[name]
    assert run(edge).count() == (2 if name == "benchmark" else len(EDGE))
    assert run(edge.where("false")).count() == 0
    clash = edge.selectExpr("doc_id", "text", *(f"1 AS {c}" for c in ("id", "n", "size", "shard", "part", "h", "label", "decoded", "base", "k")))
    assert run(clash).count() == (2 if name == "benchmark" else len(EDGE))


def test_codec():
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(bpe.tokenizer_path()), bpe.codec(open(bpe.tokenizer_path()).read())
    rng = random.Random(3)
    some = [*"abcE'srtvemld 123  \n\n\t\r.,!?$*#|éßñ\xa0　中🙂’-", "<|endoftext|>", "'re", "'ll", "  "]
    for _ in range(3000):
        t = "".join(rng.choice(some) for _ in range(rng.randint(0, 30)))
        ids = library.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == ids and own.decode(ids) == library.decode(ids, skip_special_tokens=False)
    fast, own.fast, own.cache = own.fast, None, {}
    assert own.encode("slow merges, don't they?\n\n ok") == library.encode("slow merges, don't they?\n\n ok", add_special_tokens=False).ids
    own.fast = fast


@pytest.mark.parametrize("rule, want", [("start", [2, 1]), ("end", [1, 2]), ("majority", [2, 1])])
def test_attribution(rule, want):
    own, crosses = bpe.attribute(np.array([0, 3, 6]), np.array([3, 6, 9]), np.array([0, 5, 9]), rule)
    assert np.bincount(own, minlength=2).tolist() == want and crosses.tolist() == [False, True, False]


def test_jump_hash(spark):
    def plain(key, n):
        b, j = -1, 0
        while j < n:
            b = j
            key = (key * 2862933555777941757 + 1) % 2**64
            j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
        return b

    keys = [0, 1, -1, 2**63 - 1, -(2**63), *range(500)]
    got = spark.createDataFrame([(k,) for k in keys], "k bigint").select("k", sharding.jump_hash(F.col("k"), 40).alias("a"), sharding.jump_hash(F.col("k"), 41).alias("b")).collect()
    for r in got:
        assert (r.a, r.b) == (plain(r.k % 2**64, 40), plain(r.k % 2**64, 41)) and r.b in (r.a, 40)
    slots = sharding.shard(spark.range(3000).selectExpr("id AS doc_id", "'t' AS text")).groupBy("shard").agg(F.min("slot").alias("a"), F.max("slot").alias("b"), F.countDistinct("slot").alias("n")).collect()
    assert all(r.a == 0 and r.b == r.n - 1 for r in slots)


def test_rules_counts(spark):
    def plain(t):
        ws = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        win = [tuple(ws[i : i + 5]) for i in range(len(ws) - 4)]
        cover = {i + j for i, w in enumerate(win) if win.count(w) > 1 for j in range(5)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(cover)

    rng = random.Random(5)
    texts = [None, "", "a b c d e a b c d e", "x " * 50, *("".join(rng.choice(["a", "b", " ", " ", "\n", "#", "é", "\xa0"]) for _ in range(rng.randint(0, 200))) for _ in range(200))]
    got = quality_rules.base_statistics(spark.createDataFrame(list(enumerate(texts)), SCHEMA), "text", ["doc_id"]).collect()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain(texts[r.doc_id]), repr(texts[r.doc_id])


def test_target_counts_all_trusted_documents(spark):
    docs = spark.range(20_500).selectExpr("id AS doc_id", "concat('word', id % 7000, ' again') AS text")
    trusted = docs.select("doc_id").union(spark.sql("SELECT explode(array(1L, NULL, -5L))"))
    assert set(quality_rules.log_ratios(docs, trusted).first().ratio) == {0.0}


def test_pii_spans(spark):
    r = {x.doc_id: x for x in pii.digest(spark.createDataFrame([(1, "é a@b.c_d@e.f 1.2.3.4.5.6.7.8 1.2.3.999"), (2, "4111 1111-1111 1111 4111111111111112"), (3, "9" * 9000 + " " + "a." * 9000)], SCHEMA)).collect()}
    assert r[1].base_sha256 == hashlib.sha256(b"email:2:7,email:7:13,ip:14:21,ip:22:29").hexdigest()
    assert r[2].n_card == 0 and r[3].n_email == 0
    clean = pii.redact(spark.createDataFrame([(1, "mail a@b.co now", "x")], "doc_id bigint, text string, lang string")).first()
    assert clean.text == "mail <EMAIL> now" and clean.lang == "x"


def test_label_model_prefers_agreement():
    post = pii.label_model({(1, 1, 1, 1): 80, (1, 1, 0, 1): 40, (0, -1, -1, -1): 60, (0, -1, 0, 0): 20})
    assert post[1, 1, 1, 1] > 0.9 > 0.1 > post[0, -1, -1, -1]


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    e = rng.integers(1, 1 << 62, 300).astype(np.uint64)
    wa, wb = rng.uniform(0.2, 4, 300), rng.uniform(0.2, 4, 300)
    sig = dedup.signatures(np.repeat([0, 1], 300), np.r_[e, e], np.r_[wa, wb], 2, 4000)
    assert abs((sig[0] == sig[1]).mean() - np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()) < 0.03


def test_near_duplicates_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rng = random.Random(7)
    base = [f"w{rng.randint(0, 999)}" for _ in range(120)]
    rows = [(r.doc_id, r.text) for r in docs]
    for k in range(40):
        own = list(base)
        for _ in range(rng.randint(0, 6)):
            own[rng.randrange(120)] = f"e{rng.randint(0, 9999)}"
        rows.append((10_000 + k, " ".join(own)))
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)} for i, w in ((i, t.split()) for i, t in rows)}
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both * 5 >= (len(sets[a]) + len(sets[b]) - both) * 4:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    got = dict(dedup.classes(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == {i: root(i) for i in ids}


def test_tiling_finds_reordered_passages(spark):
    words = [f"w{i}" for i in range(40)]
    mixed = " ".join(["before", *words[20:40], "between", *words[:20], "after"])
    docs = spark.createDataFrame([(1, mixed), (2, " ".join(words[:12])), (3, "nothing of it")], SCHEMA)
    bench = spark.createDataFrame([(9, " ".join(words))], "item_id bigint, text string")
    got = decontaminate.overlaps(docs, bench).collect()
    assert [(r.doc_id, r.item_id, r.coverage) for r in got] == [(1, 9, 1.0)]


def test_short_items_are_found_whole(spark):
    docs = spark.createDataFrame([(1, "ask: Who was first? nobody"), (2, "who was"), (3, "first who was"), (4, "first"), (5, None), (6, "who was first, who was first"), (7, "one two three four five six")], SCHEMA)
    bench = spark.createDataFrame([(1, "Who was first"), (2, "first"), (3, ""), (4, "who  was first!"), (5, "two three four five"), (6, "one two three four five")], "item_id bigint, text string")
    want = [(1, 1), (1, 2), (1, 4), (3, 2), (4, 2), (6, 1), (6, 2), (6, 4), (7, 5), (7, 6)]
    assert sorted((r.doc_id, r.item_id, r.coverage) for r in decontaminate.overlaps(docs, bench).collect()) == [(*w, 1.0) for w in want]


def test_language_mixture():
    rng = random.Random(2)
    word = lambda parts: "".join(rng.choice(parts) for _ in range(3))
    a, b = ["tho", "ing", "er"], ["sch", "keit", "ung"]
    text = lambda p, n: " ".join(word(p) for _ in range(n))
    counts = np.zeros((2, langid.BUCKETS))
    for i, p in enumerate((a, b)):
        counts[i] = np.bincount(langid.trigrams([text(p, 2000)])[1], minlength=langid.BUCKETS)
    m = langid.Mixture(["x", "y"], counts)
    lang, score = m.predict([text(a, 60), text(b, 60), text(a, 100) + " " + text(b, 60), "12 ..", ""])
    assert lang == ["x", "y", "x", "und", "und"] and score[0] == score[1] == 1.0 and 0.5 < score[2] < 0.75 and score[3] == 0


def test_quality_model_learns():
    rng = np.random.default_rng(0)
    x = rng.random((2000, len(quality_model.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.7)).astype(float)
    t = quality_model.grow(x, y)
    assert ((t.score(x) >= 0.5) == y).mean() > 0.97
    assert quality_model.statistics(pa.array([None, "", "Ab! 1|é\nAb"])).shape == (3, len(quality_model.FEATURES))


def test_quotation_links(spark):
    x = spark.createDataFrame([(1, 0, "user", "Hello there\n\nSecond para"), (1, 1, "assistant", "> Hello there\nhi\n"), (1, 2, "user", "On Monday, Bob wrote:\n> Second  para\nfine"), (1, 3, "a", "> > Hello there\n> hi\nok"), (None, 0, "user", None)], "conv_id long, turn long, role string, text string")
    got = {r.turn: r for r in chat.link(x).where("conv_id = 1").collect()}
    assert [got[i].reply_to for i in range(4)] == [None, 0, 0, 1] and got[2].content == "fine" and got[3].depth == 2 and got[2].position == 3
    assert chat.link(x).count() == 5 and chat.link(x.where("false")).count() == 0
    rows = [(1, 0, "user", "a b"), (1, 1, "bot", "> a b\nc"), (1, 2, "user", "d"), (2, 0, "user", "x"), (2, 0, "user", "x"), (2, 1, "bot", "> y\nz")]
    flat = chat.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert sorted((r.conv_id, r.position, r.depth, r.reply_to, r.n_linked) for r in flat) == [(1, 0, 0, None, 0), (1, 1, 1, 0, 1), (1, 2, 2, 1, 0), (2, 0, 0, None, 0), (2, 1, 1, 0, 0), (2, 2, 2, 1, 0)]


def test_quotes_of_some_pieces(spark):
    texts = [
        ("l1\nl2\nl3\nl4\nl5\n\np two\n\np three", None),
        ("> l2\n> l3\nok", 0),  # lines inside a paragraph
        ("filler", 1),
        ("> l1 l2 l3\n> l4 l5\n>\n> p two\nyes", 0),  # two of three paragraphs, one of them broken anew
        ("> ok\nown a\nown b\n> yes\nown c", 3),
        ("> own a own b\nre", 4),  # a passage between quotes, broken anew
        ("l2\n\nother", 5),
        ("> l2\n> l3\nlater", 0),  # the message before holds one of the lines only
        ("> l2\n> nowhere\nx", 7),
        ("> l4\n> l5\n>\n> P  three\nz", 0),  # lines of a paragraph and a whole one, one left out between
        ("> > own c\n> own a\n> own c\nw", 4),
        ("> later\n> x\nv", 10),  # no message holds both
    ]
    rows = [(c, i, "r", t) for c in (1, 2) for i, (t, _) in enumerate(texts)] + [(3, 0, "r", "q"), (3, 1, "r", "w"), (3, 2, "r", "> l2\n> l3\nq")]
    got = {(r.conv_id, r.turn): r for r in chat.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), block=3).collect()}
    for c in (1, 2):
        assert [got[c, i].reply_to for i in range(len(texts))] == [p for _, p in texts]
        assert [got[c, i].n_linked for i in range(len(texts))] == [0, 1, 0, 1, 2, 1, 0, 1, 0, 1, 2, 0]
    assert got[3, 2].reply_to == 1 and got[3, 2].n_linked == 0


def test_reply_order_matches_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for conv in (1, 2, None):
        for turn in range(60):
            quote = [f"> word{rng.randint(0, 11)}", f"> > word{rng.randint(0, 11)}"][: rng.choice([0, 0, 1, 2])]
            own = [f"Word{rng.randint(0, 11)}"] if rng.random() < 0.8 else []
            rows.append((conv if conv else 3, turn - turn // 20, f"r{turn % 3}", "\n".join([*quote, *own]), "extra"))
    rows += [(None, 0, "a", "x", "e"), (None, 1, "a", "> x\ny", "e")]
    expected = []
    for conv in (1, 2, 3):
        ms = sorted((r[1], r[2], r[3]) for r in rows if r[0] == conv)
        parents = []
        for n, (_, _, text) in enumerate(ms):
            lines = text.split("\n")
            asks = [ln[1:].strip() for ln in lines if ln.startswith("> word")]
            at = [k for k in range(n) for a in asks if any(ln.lower() == a for ln in ms[k][2].split("\n") if not ln.startswith(">"))]
            parents.append(max(at) if at else n - 1 if n else None)
        paths = []
        for n, p in enumerate(parents):
            paths.append([*(paths[p] if p is not None else []), n])
        expected += [(conv, *ms[n][:2], parents[n], len(paths[n]) - 1, sorted(paths).index(paths[n])) for n in range(60)]
    data = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq string")
    got = chat.link(data, block=3).collect()
    assert sorted((r.conv_id, r.turn, r.role, r.reply_to, r.depth, r.position) for r in got if r.conv_id) == sorted(expected)
    assert sorted((r.turn, r.reply_to, r.position) for r in got if r.conv_id is None) == [(0, None, 0), (1, None, 0)]
