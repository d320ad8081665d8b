"""The registered queries on the smallest tables, against their SQL where there is one; the pipeline's stages."""

import os

import duckdb
import pytest

from hearth.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    want = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF)
    shown = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    assert sorted(columns) == sorted(got.columns)
    assert sorted(tuple(shown(r[c]) for c in columns) for r in got.collect()) == sorted(tuple(map(shown, r)) for r in want.fetchall())


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 14))


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    docs = first = spark.read.parquet(f"{SF}/documents.parquet")
    left = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name == "token_blocks":
            assert docs.count() == left
        else:
            assert docs.columns == first.columns
            if name != "mixing":
                assert docs.count() <= left
            left = docs.count()


def test_stages_keep_odd_rows_and_columns(spark):
    """Nulls in any column, empty and very long texts, repeated rows, clashing names; then no rows at all."""
    import corpus_pipeline

    long = " ".join(f"word{i}" for i in range(150_000))
    texts = [None, "", long, "a few words of text that are clean", "a few words of text that are clean", None, "\x00 odd \ufffd text"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _row string, _fp int, _mix_copies int, copies int, target int, rate int, score int, size int, fp int, key int, class_id int"
    rows = [(i if i < 5 else None, t, None, None if i % 2 else "s", None, "r", *range(10)) for i, t in enumerate(texts)]
    rows.append(rows[3])
    docs = spark.createDataFrame(rows, schema)
    left = {"toxicity": 8, "near_dedup": 4, "decontaminate": 4}
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), SF)
        out = stage(spark, docs, SF)
        assert empty.count() == 0
        if name == "token_blocks":
            assert out.count() == docs.count()
        else:
            assert out.columns == docs.columns
            assert {tuple(r)[5:] for r in out.collect()} <= {("r", *range(10))}
            assert name not in left or out.count() == left[name]
            docs = spark.createDataFrame(out.collect(), schema)


def test_pipeline_gives_the_expected_rows(spark, tmp_path):
    """Planted documents of one source (its target is its size, so every kept one is taken once), held against the library's ids."""
    import random
    import zlib

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    import corpus_pipeline

    rng = random.Random(17)
    prose = lambda n: " ".join("".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(n))
    clean = [prose(120) for _ in range(12)]
    item, near = prose(30), clean[3].split()
    near[60] = "changed"
    rows = list(enumerate(clean))
    rows += [(20, clean[2]), (21, " ".join(near)), (22, prose(40) + " " + item.upper() + " " + prose(40)), (5, prose(90)), (None, prose(80)), (30, ""), (31, None), (32, prose(60) + " idiot " + prose(3) + " moron scum")]
    # Telling words need toxic rows of several contexts.
    bad = [(100 + i, f"{prose(30)} zuplo {prose(4)} krenta {prose(20)}") for i in range(60)]
    fine = [(200 + i, prose(60)) for i in range(60)]
    documents = [(d, t, "en", "s", len(t or "")) for d, t in rows + bad + fine]
    table = lambda name, data, schema: spark.createDataFrame(data, schema).repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    table("documents", documents, "doc_id long, text string, lang string, source string, n_chars long")
    table("labels", [(d, 1, 1) for d, _ in bad] + [(d, 1, 0) for d, _ in fine], "doc_id long, quality int, toxic int")
    table("benchmark", [(1, item), (2, prose(25))], "item_id long, text string")
    got = corpus_pipeline.run(spark, str(tmp_path)).orderBy("start").collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    # 20 copies 2, 21 is near 3, 22 holds an item, 31 equals 30; rows of words that are no longer toxic to the model stay.
    kept = [(d, t) for d, t in rows if d not in (20, 21, 22, 31)] + fine
    kept = [(d, t) for d, t in kept if d != 32]
    want = {(d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for d, t in kept for ids in [library.encode(t or "", add_special_tokens=False).ids + [2]]}
    assert {(r.doc_id, r.n_tokens, r.ids_crc32) for r in got if r.doc_id != 32} == want
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda d: (d is not None, d or 0))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
