"""Long texts, long conversations and many equal rows: what must not grow with the square of their number."""

import time

import pytest
from pyspark.sql import functions as F

from hearth.llm import chat_format, suffix_dedup, toxicity


def test_exceptions_of_a_long_text_are_read_once():
    model = toxicity.Model({"trash": 2.0, "idiot": 1.0, "clown": 1.0}, -2.0, 3.0)
    automaton = model.automaton()
    words = "trash can idiot clown fish trash "
    began = time.monotonic()
    small, n_small = toxicity.density(words * 100, automaton)
    long, n_long = toxicity.density(words * 130_000, automaton)  # 4 MB
    assert time.monotonic() - began < 20
    assert n_small == 200 and n_long == 260_000 and long >= small


def test_excused_hits_equal_brute_force():
    import random

    rng = random.Random(4)
    for _ in range(300):
        spans = lambda w: sorted([(b, b + rng.randint(0, 5), w) for b in (rng.randint(0, 40) for _ in range(rng.randint(0, 8)))], key=lambda s: s[1])  # noqa: E731, B023
        hits, excused = spans(1.0), spans(None)
        assert toxicity._unexcused(hits, excused) == [h for h in hits if not any(a <= h[0] and h[1] <= b for a, b, _ in excused)]


@pytest.mark.parametrize("n", [1, 63, 64, 65, 20_000])
def test_loss_of_a_long_conversation(spark, n):
    text = F.concat(F.lit("é [INST] <|end|> \\ "), F.col("id").cast("string"), F.lit(" 😀"))
    turns = spark.range(n).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"), F.when(F.col("id") % 7 != 0, text).alias("text")
    )
    began = time.monotonic()
    got = chat_format.format_chats(turns).select(chat_format.under_mask(F.col("formatted"), F.col("mask")).alias("loss")).first().loss
    assert time.monotonic() - began < 30
    assert got == [f"é [INST] <|end|> \\ {i} 😀" for i in range(n) if i % 3 and i % 7]


@pytest.mark.parametrize("doc_id", [7, None])
def test_many_rows_of_one_text_and_id(spark, doc_id):
    line = " ".join(f"word{i}" for i in range(150))
    n = 100_000
    rows = spark.range(n).select(F.lit(doc_id).cast("long").alias("doc_id"), F.lit(line).alias("text"))
    other = spark.createDataFrame([(1, "x" * 150), (2, line[:250] + "y" * 100)], "doc_id long, text string")
    began = time.monotonic()
    got = suffix_dedup.dedup(spark, rows.unionByName(other)).groupBy("doc_id", "n_bytes", "n_removed", "n_spans").count().collect()
    assert time.monotonic() - began < 90
    assert {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r["count"]) for r in got} == {(doc_id, len(line), len(line), 1, n), (1, 150, 0, 0, 1), (2, 350, 250, 1, 1)}
