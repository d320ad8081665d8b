"""The dealt operators against brute force, round trips and held-out accuracy, with the cases their docstrings define."""

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearth.llm import chat_format, decontaminate, mixing, near_dedup, pii, suffix_dedup, token_blocks, topk, toxicity, url_filter
from hearth.llm.shingles import shingle_hashes, word_hashes

SF = "/root/testdata/sf0.001"
RNG = random.Random(7)
WORDS = [f"{a}{b}" for a in "ba ke li mo nu pra stri vo".split() for b in "ra tel min dos fu gan".split()]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, text2 string, key int, a int, keys int"


def prose(n: int, rng: random.Random = RNG) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


def documents(spark, texts, ids=None):
    """Documents with further columns whose names clash with those the operators use inside."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", f"s{(i or 0) % 3}", len(t or ""), "fp", "x", 1, 2, 3) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOCS)


# ------------------------------------------------------------------ 1


def repeats(texts: list[bytes], n: int):
    seen: dict[bytes, int] = {}
    for t in texts:
        for i in range(len(t) - n + 1):
            seen[t[i : i + n]] = seen.get(t[i : i + n], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - n + 1):
            if seen[t[i : i + n]] > 1:
                gone[i : i + n] = True
        runs = int((np.diff(np.r_[0, gone.astype(np.int8)]) == 1).sum())
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [20_000, 1])
def test_suffix_dedup_equals_brute_force(spark, hot):
    shared, line = prose(60), prose(30)
    texts = [prose(100) + shared + prose(50), shared + prose(80), prose(20) + shared, shared, shared, None, "", "x" * 900, "é" * 150, line + prose(90) + line]
    texts += [line + prose(90) for _ in range(6)] + [prose(40) + line + shared[:150], "short"]
    got = suffix_dedup.dedup(spark, documents(spark, texts), hot=hot).orderBy("doc_id").collect()
    want = repeats([(t or "").encode() for t in texts], 200)
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == want


def test_suffix_dedup_other_lengths_null_ids_and_repeated_rows(spark):
    texts = [prose(30), prose(30)]
    docs = documents(spark, [texts[0], texts[0], texts[1], texts[1][:100]], [None, 1, 2, 2])
    got = sorted((r.n_bytes, r.n_removed) for r in suffix_dedup.dedup(spark, docs, length=40, gram=16).collect())
    want = sorted(w[:2] for w in repeats([t.encode() for t in (texts[0], texts[0], texts[1], texts[1][:100])], 40))
    assert got == want
    assert suffix_dedup.dedup(spark, documents(spark, [])).count() == 0


def test_repeats_across_the_pieces_of_a_long_text(spark):
    rng = np.random.default_rng(8)
    letters = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes().decode()
    passage, other = letters(700), letters(250)
    long = letters(suffix_dedup.PIECE - 350) + passage + letters(90_000) + other
    texts = [long, letters(50) + passage, other + letters(300), letters(suffix_dedup.PIECE + 5_000)]
    got = suffix_dedup.dedup(spark, documents(spark, texts)).orderBy("doc_id").collect()
    kept = [long.replace(passage, "").replace(other, ""), texts[1][:50], texts[2][250:], texts[3]]
    assert [(r.n_bytes, r.n_removed, r.n_spans) for r in got] == [(len(t), len(t) - len(k), n) for t, k, n in zip(texts, kept, (2, 1, 1, 0), strict=True)]
    assert [r.kept_sha256 for r in got] == [hashlib.sha256(k.encode()).hexdigest() for k in kept]


def test_windows_cover_every_start_once():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 105, 5000).astype(np.uint8).tobytes()
    pieces = list(suffix_dedup._pieces([b"a" * (suffix_dedup.PIECE + 500)], 200))
    assert [int(off[0]) for _, _, _, off in pieces] == [0, suffix_dedup.PIECE - 199]
    covered = np.zeros(len(text) - 199, bool)
    for b, n in zip(*suffix_dedup.windows(np.frombuffer(text, np.uint8), np.array([len(text)]))[:2], strict=True):
        assert not covered[b : b + n].any()
        covered[b : b + n] = True
    assert covered.all()


# ------------------------------------------------------------------ 2


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 1000, 30_000])
def test_coder_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 50257, n), np.zeros(n, np.int64), np.sort(rng.zipf(1.5, n) % 50257)):
        docs, back = token_blocks.read_block(token_blocks.write_block([None, 5], [ids.astype(np.uint32), ids[:0].astype(np.uint32)]))
        assert docs == [None, 5] and np.array_equal(back[0], ids) and len(back[1]) == 0


def test_damage_is_found():
    block = bytearray(token_blocks.write_block([1], [np.arange(500, dtype=np.uint32)]))
    block[-3] ^= 4
    with pytest.raises(ValueError):
        token_blocks.read_block(bytes(block))


def test_token_blocks_equal_the_library(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [prose(300), None, "", "Don't  stop\n\n it's ½ ²x _a__b 12,5%  ", "日本語 and русский\u00a0text", "<|endoftext|> # 2", "ñandú l'été\tÇa  va", prose(3000), "\x1c a\x85b"]
    docs = documents(spark, texts + [texts[0]], [5, 3, 4, 1, 2, 8, 7, 6, None, 5])
    token_blocks.write(token_blocks.encode(docs, path, block_tokens=400), str(tmp_path / "t"))
    got = token_blocks.decode(token_blocks.read(spark, str(tmp_path / "t"))).orderBy("start").collect()
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    order = sorted(zip([5, 3, 4, 1, 2, 8, 7, 6, None, 5], texts + [texts[0]], strict=True), key=lambda x: (x[0] is not None, x[0] or 0, hashlib.md5((x[1] or "").encode()).hexdigest()))
    at = 0
    for row, (doc, text) in zip(got, order, strict=True):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        assert tuple(row) == (doc, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    token_blocks.write(token_blocks.encode(documents(spark, []), path), str(tmp_path / "e"))
    assert token_blocks.decode(token_blocks.read(spark, str(tmp_path / "e"))).count() == 0


def test_pieces_are_encoded_as_the_library_encodes_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    rng = random.Random(4)
    signs = [*"abcXYZ019 .,;'-_!?\n\t\r", "  ", " \n", "\n\n", "\u00a0", "\u0085", "\u2003", "\u3000", "\u00e9", "\u00d7", "\u0438", "\u65e5", "\U0001f600", "\x1c", "\u00b2", "'s", "'ll", "<|endoftext|>", "\u0301"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + [" ", "\n", "a ", " a", "a" * 100_000]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        library = Tokenizer.from_file(path)
        library.encode_special_tokens = True
        made = token_blocks.Encoder(path, end_id=2)
        assert made.splits == (name == "byte_bpe_50k.json")
        want = library.encode_batch(texts, add_special_tokens=False)
        for part in (texts[:1000], texts[1000:], [None, ""]):
            got = made(part)
            assert len(got) == len(part)
            for text, ids in zip(part, got, strict=True):
                assert ids.tolist() == (want[texts.index(text)].ids if text else []) + [2], repr(text)


def test_blocks_are_smaller_than_the_ids_alone_allow():
    """A fixed code over the ids needs their entropy of order 0 at least; contexts and repeats must save a good part of it."""
    import public_tokenizers
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()
    ids = np.concatenate(token_blocks.Encoder(public_tokenizers.path("byte_bpe_50k.json"))(texts))
    counts = np.bincount(ids)
    share = counts[counts > 0] / len(ids)
    entropy = -(share * np.log2(share)).sum()
    assert 8 * len(token_blocks.write_block([0], [ids])) / len(ids) < entropy - 0.4
    words = np.random.default_rng(3).integers(0, 5000, (200, 6)).astype(np.uint32)  # phrases in random order
    phrases = words[np.random.default_rng(4).integers(0, 200, 40_000)].reshape(-1)
    assert 8 * len(token_blocks.write_block([0], [phrases])) / len(phrases) < 3.5 < np.log2(1200)


# ------------------------------------------------------------------ 3


def test_folding():
    assert toxicity.fold("ІDІ0T, tr@sh!").split() == ["idiot", "trash"]
    model = toxicity.Model({"trash": 2.0}, -2.0, 3.0)
    a = model.automaton()
    assert toxicity.density("7r4sh", a)[1] == 1 and toxicity.density("the trash can", a)[1] == 0 and toxicity.density("trashy", a)[1] == 0
    assert toxicity.density(None, a) == (0.0, 0) == toxicity.density("", a)
    assert toxicity.density("trash trash", a)[1] == 2


def test_disguised_words_are_folded():
    for word in ("tr\u200bash", "\uff54\uff52\uff14\uff53\uff48", "\U0001d42d\U0001d42b\U0001d41a\U0001d42c\U0001d421", "t\u0337r\u0337a\u0337s\u0337h", "\u24e3\u24e1\u24d0\u24e2\u24d7", "TR\u0410SH", "tra\u00adsh"):
        assert toxicity.fold(word).split() == ["trash"], word
    assert toxicity.fold("trash\u2014can SCUM!! sh!t! \uff14\uff01").split() == ["trash", "can", "scum", "shit", "ai"]


def test_automaton_equals_a_naive_search():
    rng = random.Random(21)
    words = ["ba", "bad", "dab", "ab", "da", "bada"]
    model = toxicity.Model({w: 1.0 + i for i, w in enumerate(words)}, -2.0, 3.0, ("bad dab", "da ba"))
    automaton = model.automaton()
    for _ in range(3000):
        text = " ".join("".join(rng.choice("abd") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(0, 12)))
        tokens = toxicity.fold(text).split()
        excused = {k + o for k in range(len(tokens)) for e in model.exceptions for o in range(2) if tokens[k : k + 2] == e.split()}
        hits = [t for k, t in enumerate(tokens) if t in model.weights and k not in excused]
        total = sum(model.weights[t] for t in hits)
        want = np.log1p(100 * total / (len(tokens) + 10)) if hits else 0.0
        got = toxicity.density(text, automaton)
        assert got[1] == len(hits) and got[0] == pytest.approx(want), text
    assert toxicity.density("ba " * 400_000, automaton)[1] == 400_000


def test_held_out_labels_are_predicted(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = toxicity.fit(docs, labels.where(~held))
    rows = toxicity.score(docs, model).join(labels.where(held), "doc_id").select("toxic", "score").collect()
    toxic, clean = [r.score for r in rows if r.toxic == 1], [r.score for r in rows if r.toxic == 0]
    # A few labelled rows hold no telling word at all.
    assert len(toxic) > 20 and sum(s >= 0.5 for s in toxic) / len(toxic) >= 0.92
    assert sum(s < 0.5 for s in clean) / len(clean) >= 0.99


def test_toxicity_learns_words_of_any_language(spark):
    bad = ["zuplo", "krenta", "veshik"]
    texts = [prose(60) + (" " + RNG.choice(bad) + " " + prose(5) + " " + RNG.choice(bad) + " " + prose(9) if i % 4 == 0 else "") for i in range(240)]
    docs = documents(spark, texts + [None, ""])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(160)] + [(None, 1), (999, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert set(bad) <= set(model.weights)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all((got[i] >= 0.5) == (i % 4 == 0) for i in range(240)) and got[240] == got[241] < 0.5
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == 182
    assert toxicity.score(documents(spark, []), model).count() == 0
    assert set(toxicity.fit(docs, labels.limit(0)).weights) == set(toxicity.SEED)


# ------------------------------------------------------------------ 4


def test_chat_round_trip(spark):
    rows = [
        (1, 0, "system", "be\\ [nice] <|end|>"), (1, 1, "user", "a"), (1, 2, "user", "<b>"), (1, 3, "assistant", ""), (1, 4, "assistant", "x</s>"), (2, 1, "user", None),
        (2, 1, "user", None), (3, None, None, "q"), (3, 0, "assistant", "é" * 5000), (None, 0, "assistant", "n"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    out = chat_format.format_chats(turns).select("*", chat_format.parse_turns(F.col("formatted")).alias("turns"), chat_format.under_mask(F.col("formatted"), F.col("mask")).alias("loss"))
    got = {r.conv_id: r for r in out.collect()}
    assert [tuple(t) for t in got[1].turns] == [(r[2], r[3]) for r in rows[:5]]
    assert got[1].n_groups == 3 and "".join(got[1].loss) == "x</s>"
    assert [tuple(t) for t in got[2].turns] == [("user", ""), ("user", "")]
    assert [tuple(t) for t in got[3].turns] == [("", "q"), ("assistant", "é" * 5000)] and "".join(got[3].loss) == "é" * 5000
    assert [tuple(t) for t in got[None].turns] == [("assistant", "n")]
    assert all(sum(r.n for r in g.mask) == len(g.formatted) for g in got.values())
    assert "</s>" not in got[1].formatted and "[nice]" not in got[1].formatted
    assert chat_format.format_chats(turns.limit(0)).count() == 0


# ------------------------------------------------------------------ 5


def waterfill(sizes: dict, weights=(5, 2, 1), cap=3):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, left, open_ = {}, float(sum(sizes.values())), set(names)
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > cap * sizes[s]}
        if not over:
            return out | {s: level * w[s] for s in open_}
        for s in over:
            out[s] = float(cap * sizes[s])
            left -= out[s]
        open_ -= over
    return out


def test_targets_and_copies(spark):
    rows = [(i, "w " * (1 + i % 30), ["a", "b", "c", None, "d", "empty"][min(i % 11, 5) if i % 11 < 6 else 1]) for i in range(2000)]
    rows = [(i, None if s == "empty" else t, s) for i, t, s in rows] + [(None, "x y", "a"), (5, "w", "a"), (5, "w", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("rate", F.lit(9))
    sized = docs.select("doc_id", "source", "rate", mixing.word_count(F.col("text")).alias("size"))
    targets = mixing.source_targets(sized)
    got = {r.source: (r.source_size, r.target) for r in targets.collect()}
    want = waterfill({s: n for s, (n, _) in got.items()})
    assert all(got[s][1] == pytest.approx(want[s]) for s in got)
    assert got["empty"] == (0, 0.0)
    mixed = mixing.with_copies(sized.drop("rate"), targets).collect()
    taken = {}
    for r in mixed:
        assert 0 <= r.copies <= 3
        taken[r.source] = taken.get(r.source, 0) + r.copies * r.size
    assert all(abs(taken[s] - got[s][1]) <= 0.15 * got[s][0] + 60 for s in got)
    out = mixing.emit(docs, targets)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in mixed)
    few = mixing.with_copies(sized.drop("rate"), targets, broadcast_rows=0)
    assert sorted(map(str, few.select("doc_id", "copies").collect())) == sorted(str(r) for r in mixing.with_copies(sized.drop("rate"), targets).select("doc_id", "copies").collect())
    assert mixing.source_targets(sized.limit(0)).count() == 0


# ------------------------------------------------------------------ 6


def edited(words: list[str], k: int, rng: random.Random) -> list[str]:
    words = list(words)
    for _ in range(k):
        kind, at = rng.randint(0, 2), rng.randrange(len(words))
        if kind == 0:
            words[at] = "qq"
        elif kind == 1:
            words.insert(at, "zz")
        elif len(words) > 1:
            del words[at]
    return words


def best_match(item: str, text: str) -> int:
    """Least word edits of the item to any stretch of the text, by the full table."""
    a, b = decontaminate.sequences([item])[0], decontaminate.sequences([text])[0]
    row = np.zeros(len(b) + 1, np.int64)
    for n, x in enumerate(a, 1):
        new = np.r_[n, np.minimum(row[1:] + 1, row[:-1] + (b != x))]
        row = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
    return int(row.min())


def found_leaks(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id short, text string")
    return {(r.doc_id, r.item_id): r.edits for r in decontaminate.leaks(spark, docs, bench).collect()}


def test_leaks_at_every_distance_against_all_pairs(spark):
    rng = random.Random(3)
    items = [prose(rng.randint(5, 60), rng) for _ in range(100)]
    texts = []
    for item in items:
        w = item.split()
        for share in (0, 0.5, 1):
            texts.append(" ".join(["xx"] * 9 + edited(w, int(int(0.2 * len(w) + 1e-9) * share), rng) + ["yy"] * 9))
    texts += [prose(150, rng) for _ in range(30)]
    truth = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            n = len(item.split())
            if abs(len(text.split()) - n) < 200 and (e := best_match(item, text)) <= int(0.2 * n + 1e-9):
                truth[d, i] = e
    found = found_leaks(spark, texts, items)
    assert found.items() <= truth.items()
    assert len(found) / len(truth) >= 0.95
    exact = {k for k, e in truth.items() if e == 0}
    assert exact <= found.keys()


def test_long_items_and_many_equal_ones(spark):
    rng = random.Random(8)
    items = [prose(n, rng) for n in (65, 130, 1000, 6000, 20_000)]
    texts = [" ".join(["aa"] * 50 + edited(i.split(), int(0.15 * len(i.split())), rng) + ["bb"] * 50) for i in items] + [prose(3000, rng)]
    found = found_leaks(spark, texts, items)
    assert set(found) == {(i, i) for i in range(5)} and all(e <= 0.2 * len(items[i].split()) for (i, _), e in found.items())
    bench = spark.range(30_000).select(F.concat(F.lit("i"), "id").alias("item_id"), F.lit(items[0]).alias("text"))
    docs = spark.createDataFrame([(None, texts[0]), (None, "x " + items[0])], "doc_id date, text string")
    got = decontaminate.leaks(spark, docs, bench)
    assert got.count() == 60_000 == got.select("item_id").distinct().count() * 2


def test_clean_documents_stay(spark):
    item = prose(20)
    docs = documents(spark, [prose(200), prose(30) + " " + item.upper() + ", " + prose(30), None, "", item, item, "x"], [0, 1, 2, 3, None, 4, 4])
    bench = spark.createDataFrame([(7, item), (8, item), (9, None), (10, "too short"), (None, "")], "item_id long, text string").withColumn("doc_id", F.lit(1))
    assert sorted((str(r.doc_id), r.item_id, r.edits) for r in decontaminate.leaks(spark, docs, bench).collect()) == sorted([("1", 7, 0), ("1", 8, 0), ("None", 7, 0), ("None", 8, 0), ("4", 7, 0), ("4", 8, 0)])
    kept = decontaminate.clean(spark, docs, bench)
    assert kept.columns == docs.columns and sorted(r.text or "" for r in kept.collect()) == sorted(["", "", "x", docs.first().text])
    assert decontaminate.leaks(spark, docs, bench.limit(0)).count() == 0 == decontaminate.leaks(spark, docs.limit(0), bench).count()


def test_short_and_unspaced_items_match(spark):
    items = ["kelura fu", "moses", "one two three four", "\u4ec0\u4e48\u662f\u673a\u5668\u5b66\u4e60", "\u3053\u3093", None, ""]
    texts = ["a Kelura, fu b", "kelura x fu", "moses", "one two three five", "zero one two three four five"]
    texts += ["\u8bf7\u95ee\u4ec0\u4e48\u662f\u673a\u5668\u5b66\u4e60\u5462", "\u4ec0\u4e48\u662f\u6a5f\u5668\u5b66\u4e60", "x\u3053\u3093\u306b", "\u3053", None, "mosesx"]
    found = found_leaks(spark, texts, items)
    assert sorted((*k, e) for k, e in found.items()) == [(0, 0, 0), (2, 1, 0), (4, 2, 0), (5, 3, 0), (6, 3, 1), (7, 4, 0)]


# ------------------------------------------------------------------ 7


def brute_top(ids, vectors, query, k=10):
    """(-score, id) in Python integers."""
    q = [int(x) for x in vectors[list(ids).index(query)]]
    scored = ((-sum(a * int(b) for a, b in zip(q, v, strict=True)), int(i)) for i, v in zip(ids, vectors, strict=True) if i != query and len(v) == len(q))
    return sorted(scored)[:k]


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(700, 8)).astype(np.float32)
    vectors[100:160] = vectors[0]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(700, None), (800, [float("nan")] * 8), (801, [None] * 8), (900, [1.0]), (901, []), (None, [1.0] * 8), (650, [0.5] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1)).select("vec_id", topk.quantised(F.col("embedding")).alias("v"))
    got = topk.top_k(spark, df, df.where("vec_id % 100 = 0"), 10, shard_rows=150, chunk_rows=3).collect()
    q = list(np.floor(1024 * vectors.astype(np.float64)))
    for query in range(0, 700, 100):
        best = brute_top([*range(700), 650], [*q, np.full(8, 512.0)], query)
        assert [(-r.score, r.vec_id) for r in sorted((r for r in got if r.query_id == query), key=lambda r: r.rank)] == best
    assert {r.query_id for r in got} == set(range(0, 700, 100))
    assert topk.top_k(spark, df.limit(0), df.limit(0)).count() == 0


def test_ranges_of_near_vectors_are_pruned(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(24, 6)) * 5
    vectors = np.floor(1024 * (centres[rng.integers(0, 24, 6000)] + rng.normal(size=(6000, 6)) * 0.05))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, v array<double>")
    found = topk.parts(spark, df, df.where("vec_id % 100 = 0"), 10, shard_rows=250, block=32)
    work = found.where("vec_id is null").agg(F.sum("scored"), F.count("*")).first()
    assert work[0] < 0.25 * 60 * 6000
    got = topk.top_k(spark, df, df.where("vec_id % 100 = 0"), 10, shard_rows=250, block=32).collect()
    for query in range(0, 6000, 1000):
        assert [(-r.score, r.vec_id) for r in sorted((r for r in got if r.query_id == query), key=lambda r: r.rank)] == brute_top(range(6000), vectors, query)


def test_very_large_components(spark):
    big = [[3e38, 1.0], [0.0, 5.0], [-3e38, 2.0], [3.1e38, -7.5], [2.0**40, 2.0**40], [1.0, 1.0]]
    df = spark.createDataFrame([(100 * i, v) for i, v in enumerate(big)], "vec_id long, embedding array<float>").select("vec_id", topk.quantised(F.col("embedding")).alias("v"))
    v = [np.floor(1024 * np.array(x, np.float32).astype(np.float64)) for x in big]
    got = topk.top_k(spark, df, df, 3).collect()
    for i in range(6):
        best = brute_top([100 * j for j in range(6)], v, 100 * i, 3)
        mine = sorted((r for r in got if r.query_id == 100 * i), key=lambda r: r.rank)
        assert [r.vec_id for r in mine] == [j for _, j in best]
        assert [r.score for r in mine] == [min(max(-s, -(2**63)), 2**63 - 1) for s, _ in best]


# ------------------------------------------------------------------ 8


def plain_spans(x: str) -> list[tuple[int, int, int]]:
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", x)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", x) if all(int(p) <= 255 for p in m.group().split("."))]
    for kind, pattern, low, high in ((2, r"[0-9]([\x20-]?[0-9])+", 14, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 10, 15)):
        for m in re.finditer(pattern, x):
            d = re.sub("[^0-9]", "", m.group())
            if low <= len(d) <= high and (kind == 3 or pii.luhn(d)):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rng = random.Random(11)
    for _ in range(4000):
        x = "".join(rng.choice("aZ09.@+-% ()4é\n") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(x) == plain_spans(x), x
    for x in ("a@b@c.d.e@f.g", "1.2.3.4.5.6.7.8.9", "4242 4242 4242 4242-1", "+1 (017) 555-7713.", "0001.002.003.004"):
        assert pii.base_spans(x) == plain_spans(x)


def test_long_runs_take_linear_time():
    for x in ("a" * 300_000 + "@", "1" * 300_000, "+1" + "(" * 300_000, "1." * 150_000, "@" * 300_000):
        pii.base_spans(x)


def test_field_spreads_labels(spark):
    number = "4242424242424242"
    texts = [f"pay {number} now" for _ in range(40)] + [f"call +1 (203) 555-{1000 + i} or a.b{i}@mail.example.com" for i in range(40)] + [f"id {i}12345 of {i}" for i in range(40)]
    docs = documents(spark, texts + [None, "", f"first {number} and 1234567812345678 {number} there"])
    model = pii.fit(docs)
    got = {r.doc_id: r for r in pii.find(docs, model).collect()}
    assert got[122].n_card == 1 and got[122].spans.split(",")[0] == "card:6:22" and "card:44:60" in got[122].spans.split(",")
    assert got[0].n_card == 1 and got[45].n_phone == got[45].n_email == 1 and got[100].spans == "" == got[120].spans == got[121].spans
    assert got[120].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.find(docs.limit(0), pii.fit(docs.limit(0))).count() == 0


def checked_number(rng) -> str:
    digits = "".join(str(rng.randint(1, 9)) for _ in range(15))
    return next(digits + c for c in "0123456789" if pii.luhn(digits + c))


def test_field_finds_what_the_patterns_lose(spark):
    """Numbers that a pattern joins with their neighbour are lost to it; the field finds them, and leaves decoys alone."""
    rng, found, planted = random.Random(12), {"phone": 0, "card": 0}, {"phone": 0, "card": 0}
    model = pii.fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    for _ in range(150):
        phone, a, b = f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}", checked_number(rng), checked_number(rng)
        decoy = a[:-1] + str((int(a[-1]) + 3) % 10)
        for text, wanted in (
            (f"so {phone} 190.137.22.{rng.randint(1, 200)} then", [("phone", phone)]), (f"so {a} {b} then", [("card", a), ("card", b)]),
            (f"so {phone} {a} then", [("phone", phone), ("card", a)]), (f"so {decoy} then {rng.randint(1, 99)} and version {rng.randint(1, 9)}.", []),
        ):
            base, every = pii.all_spans(text, model)
            got = {(pii.KINDS[k], text[s:e]) for s, k, e in every}
            assert set(base) <= set(every) and {g for g in got if g[0] != "ip"} <= set(wanted), text
            for kind, what in wanted:
                planted[kind] += 1
                found[kind] += (kind, what) in got
    assert all(found[k] / planted[k] >= 0.95 for k in found), found


def test_marginals_on_a_tree_are_exact():
    rng = np.random.default_rng(2)
    unary, f = rng.normal(size=(3, 5)), rng.normal(size=(2, 5, 5))
    joint = np.exp(unary[0][:, None, None] + unary[1][None, :, None] + unary[2][None, None, :] + f[0][:, :, None] + f[1][None, :, :])
    joint /= joint.sum()
    got = pii.marginals(3, unary, [(0, 1, f[0]), (1, 2, f[1])], rounds=60)
    assert np.allclose(got, [joint.sum((1, 2)), joint.sum((0, 2)), joint.sum((0, 1))], atol=1e-6)


def test_evidence_reaches_every_like_mention():
    """Fifty mentions whose shape speaks for none, with the entity's evidence before, among or after them."""
    node, like = np.full(5, 0.5), 1 + np.diag([2000.0, 20, 20, 20, 20])
    node[0] += 50
    like = np.log(like * like.sum() / np.outer(like.sum(1), like.sum(0)))
    model = {"node": {pii.shape("2035557713"): np.log(node / node.sum()).tolist()}, "prior": [0.0] * 5, "chain": np.zeros((5, 5)).tolist(), "skip": like.tolist()}
    for at in (0, 25, 50):
        said = ["at 2035557713 again"] * 50
        said.insert(at, "call +12035557713 now")
        base, every = pii.all_spans("; ".join(said), model)
        assert [k for _, k, _ in base] == [3] and [k for _, k, _ in every] == [3] * 51
    assert pii.all_spans("; ".join(["at 2035557713 again"] * 50), model) == ([], [])


def test_messages_pass_to_the_end_of_a_long_chain():
    unary, same = np.zeros((60, 2)), np.log(np.array([[0.99, 0.01], [0.01, 0.99]]))
    unary[0] = 0.0, -np.inf
    got = pii.marginals(60, unary, [(i, i + 1, same) for i in range(59)])
    assert np.allclose(got[:, 0], 0.5 + 0.5 * 0.98 ** np.arange(60), atol=1e-5)


# ------------------------------------------------------------------ 9


def test_signatures_estimate_weighted_similarity():
    rng = random.Random(1)
    for share in (0.3, 0.6, 0.9):
        a = [rng.choice(WORDS) + str(rng.randint(0, 99)) for _ in range(400)]
        b = a[: int(400 * share)] + [rng.choice(WORDS) + str(rng.randint(0, 99)) for _ in range(400 - int(400 * share))]
        h, c = shingle_hashes([" ".join(a), " ".join(b)])
        s = near_dedup.signatures(h, c, 2000)
        exact = near_dedup.similarity(*[np.unique(x, return_counts=True) for x in np.split(h, [c[0]])])
        assert (s[0] == s[1]).mean() == pytest.approx(exact, abs=0.05)


def test_classes_equal_brute_force(spark):
    rng = random.Random(9)
    base = [prose(120, rng).split() for _ in range(6)]
    texts = []
    for b in base:
        for _ in range(12):
            w = list(b)
            for _ in range(rng.randint(0, 6)):
                w[rng.randrange(len(w))] = rng.choice(WORDS) + "x"
            texts.append(" ".join(w))
    texts += texts[:5] + [None, "", "one two", "One, two", prose(200, rng)]
    got = {r.doc_id: r.class_id for r in near_dedup.classes(spark, documents(spark, texts)).collect()}
    sets = [np.unique(shingle_hashes([t])[0], return_counts=True) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if (texts[i] or "") == (texts[j] or "") or (len(sets[i][0]) and near_dedup.similarity(sets[i], sets[j]) >= 0.8):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert got == {i: find(i) for i in range(len(texts))}


def test_large_open_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL", 3)
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    test_classes_equal_brute_force(spark)


def test_keep_one_of_each_class(spark):
    a, b = prose(100), prose(100)
    docs = documents(spark, [a, a, b, a + " tail", None, "", b], [3, 1, None, 2, 9, 8, None])
    kept = near_dedup.keep_one(spark, docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text or "") for r in kept.collect()) == sorted([("1", a), ("None", b), ("8", "")])
    assert near_dedup.keep_one(spark, docs.limit(0)).count() == 0


def test_same_id_with_different_texts_loses_none(spark):
    a, b, c = prose(100), prose(100), prose(100)
    docs = documents(spark, [a, b, c, a + " tail", a], [1, 1, 2, 1, 1])
    found = near_dedup.classes(spark, docs).collect()
    assert len({r.root for r in found}) == 3 and {r.class_id for r in found} == {1, 2}
    assert sorted(r.text[:80] for r in near_dedup.keep_one(spark, docs).collect()) == sorted(t[:80] for t in (a, b, c))


def test_hot_groups_are_spread_without_loss(spark, monkeypatch):
    from hearth.llm import common, graph

    monkeypatch.setattr(common, "HOT_ROWS", 3)
    monkeypatch.setattr(common, "HOT_KEYS", 1 << 40)
    test_classes_equal_brute_force(spark)
    test_keep_one_of_each_class(spark)
    star = [(0, i) for i in range(1, 60)] + [(59, 60), (70, 71), (71, 72), (80, 80)]
    got = {r.node: r.root for r in graph.components(spark, spark.createDataFrame(star, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 70: 70, 71: 70, 72: 70}


# ------------------------------------------------------------------ 10


def test_url_verdicts(spark):
    urls = [
        "http://www.A.example.NET/en/9?x#y", "https://x.net/de/1", "http://example.com/de/", "http://www.example.com/de/7", "https://Q.org/fr/1", "http://q.org/FR/1", "net/", None, "://", "a:///p?q",
        "http://notnet/", "http://x.net", "http://u@h.org#f", "http://net/x://y",
    ]
    model = url_filter.fit(spark)
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit(1))
    got = {r.page_id: r for r in url_filter.judge(pages, model).collect()}
    assert [(got[i].host, got[i].path) for i in range(len(urls))] == [
        ("www.a.example.net", "/en/9"), ("x.net", "/de/1"), ("example.com", "/de/"), ("www.example.com", "/de/7"), ("q.org", "/fr/1"), ("q.org", "/FR/1"), ("", ""), ("", ""), ("", ""), ("", "/p"),
        ("notnet", "/"), ("x.net", ""), ("u@h.org", ""), ("net", "/x://y"),
    ]
    assert [got[i].rule for i in range(len(urls))] == ["example.net/en/", "net/", "example.com/de/", "example.com/de/", "org/fr/", *[None] * 8, "net/"]
    assert [got[i].verdict for i in range(5)] == ["allow", "block", "block", "block", "allow"] and all(got[i].verdict in ("allow", "block") for i in got)
    assert url_filter.judge(pages.limit(0), model).count() == 0


# None of these hosts is in the labelled table; nor are the invented words of the second half.
HELD_OUT = (
    ("http://mega-casino-royal.example/play", 1), ("https://www.pokerstarz.example/en/77", 1), ("http://my-bets.example/odds", 1), ("https://xxx-clips.example/v/3", 1),
    ("http://adult-chat.example/room/5", 1), ("https://discount-pills.example/order", 1), ("http://spam-bots.example/1", 1), ("https://click-ads.example/banner", 1),
    ("http://web-tracker.example/pixel", 1), ("https://warez-crack.example/dl", 1), ("http://torrent-hub.example/9", 1), ("https://quick-loans.example/apply", 1),
    ("http://replica-bags.example/shop", 1), ("https://lottery-result.example/win", 1), ("http://online-gambling.example/x", 1), ("https://phishing-kit.example/", 1),
    ("https://city-library.example/catalog", 0), ("http://www.physics-notes.example/en/12", 0), ("https://school-maps.example/9", 0), ("http://chess-weekly.example/7", 0),
    ("https://river-news.example/today", 0), ("http://history-of-music.example/a", 0), ("https://docs.gazette.example/x", 0), ("https://mountain-walks.example/fr/4", 0),
    ("http://morvanel.example/en/4410", 0), ("https://www.quistor.example/de/881.html", 0), ("https://m.oduntie.example/es/3/", 0), ("http://blog.hewayter.example/fr/70", 0),
    ("https://lanosure.example/en/5", 0), ("http://indervall.example/it/66#top", 0), ("https://www.suthemar.example/pl/2?page=2", 0), ("http://reonward.example/en/9", 0),
)


def test_url_model_holds_on_urls_it_has_not_seen(spark):
    table = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(HELD_OUT)], "page_id long, url string")
    assert not {u for u, _ in HELD_OUT} & {u for u, _ in url_filter.labelled()}
    got = {r.page_id: r.p_block for r in url_filter.judge(table, url_filter.fit(spark), rules=()).collect()}
    wrong = [(u, round(got[i], 2)) for i, (u, y) in enumerate(HELD_OUT) if (got[i] >= 0.5) != (y == 1)]
    assert len(wrong) <= 2, wrong


def test_url_model_scores_as_written(spark):
    model = url_filter.fit(spark)
    rows = url_filter.labelled()
    table = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)] + [(-1, "http://a.example/" + "x" * 200_000)], "page_id long, url string")
    got = {r.page_id: r.p_block for r in url_filter.judge(table, model, rules=()).collect()}
    assert sum((got[i] >= 0.5) == (y == 1) for i, (_, y) in enumerate(rows)) >= 0.97 * len(rows) and 0 <= got[-1] <= 1
    found = table.limit(3).select("page_id", url_filter.buckets(url_filter.host(F.col("url")), url_filter.path(F.col("url"))).alias("b")).collect()
    for r in found:
        assert got[r.page_id] == pytest.approx(1 / (1 + np.exp(-(model[1] + sum(model[0][b] for b in r.b) / len(r.b)))))


def test_a_worker_keeps_its_token_encoder_and_its_pieces():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    path = public_tokenizers.path("byte_bpe_50k.json")
    kept = token_blocks.encoder_of(path, 2)
    texts = [" some words that come again\n and again", None, ""]
    first = kept(texts)
    known = len(kept.pieces)
    again = token_blocks.encoder_of(path, 2)
    assert again is kept and os.environ["TOKENIZERS_PARALLELISM"] == "false"
    assert all(np.array_equal(a, b) for a, b in zip(first, again(texts), strict=True)) and len(again.pieces) == known
    assert all(np.array_equal(a, b) for a, b in zip(first, token_blocks.Encoder(path, 2)(texts), strict=True))


def test_plain_words_are_not_split_again_and_equal_the_library(monkeypatch):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    path = public_tokenizers.path("byte_bpe_50k.json")
    split, library = [], token_blocks.Encoder._library
    monkeypatch.setattr(token_blocks.Encoder, "_library", lambda self, texts, *words: (split.extend([] if any(words) else texts), library(self, texts, *words))[1])
    letters = "".join(map(chr, [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x280)]))
    rng = random.Random(3)
    some = lambda alphabet: "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 9)))
    plain = [some(letters.replace("\u00d7", "").replace("\u00f7", "")) for _ in range(3000)]
    mixed = [some(letters[:60] + "\u00d7\u00f7'12.,\u0301\u03b1\u00a0\u0085\u4e2d\t\n ") for _ in range(3000)]
    texts = [" ".join(plain[:2000]), "\n".join(plain[2000:]), " ".join(mixed[:2000]), "\n".join(mixed[2000:]), "\u00d7a \u00f7", "a\u00d7b c\u00f7d e\u00d7", "", None]
    made = token_blocks.Encoder(path)
    got = made(texts[:2])
    assert not "".join(split).strip()
    got += made(texts[2:])
    assert "".join(split).strip()
    whole = token_blocks.tokenizer_of(path)
    assert [x.tolist() for x in got] == [[*whole.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


def test_pieces_that_come_often_are_not_forgotten(monkeypatch):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    path = public_tokenizers.path("byte_bpe_50k.json")
    monkeypatch.setattr(token_blocks, "CACHED", 60)
    learned, learn = [], token_blocks.Encoder._learn
    monkeypatch.setattr(token_blocks.Encoder, "_learn", lambda self, pieces: (learned.extend(pieces), learn(self, pieces))[1])
    made, whole = token_blocks.Encoder(path), token_blocks.tokenizer_of(path)
    for k in range(12):
        texts = [" some words that come often", None, " ".join(f"rare{k}x{i}, of{k}'s" for i in range(20))]
        assert [x.tolist() for x in made(texts)] == [[*whole.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
        assert len(made.pieces) <= 60 + 45
    assert learned.count(b" often") == 1
    made._forget()
    assert b" often" in made.pieces and len(made.pieces) <= 31 and b" rare11x3" not in made.pieces
