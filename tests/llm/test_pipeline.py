import os
import sys

from .helpers import collected, frame

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
SF = "/root/testdata/sf0.001"


def test_stages_chain_and_decisions_take_effect(spark):
    import corpus_pipeline as P

    from .test_decontam import decontam
    from .test_pii import base_spans
    from .test_simhash import plain_components, plain_print

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    names = [n for n, _ in P.STAGES]
    assert names == ["quality classifier", "near duplicates", "benchmark decontamination", "personal data", "packing"]
    for name, stage in P.STAGES[:-1]:
        docs = P.stored(stage(spark, docs, SF), "test-stage")
        assert docs.columns == columns
        kept[name] = {r["doc_id"]: r["text"] for r in collected(docs)}
    first, second, third, fourth = kept.values()
    # near duplicates: one of each group of what the first stage kept
    rows = sorted(first.items())
    want = set(plain_components([(k, plain_print(t)) for k, t in rows]))
    assert set(second) == want
    assert set(third) < set(second) and set(fourth) == set(third)
    items = {r.item_id: ' '.join(w.decode() for w in decontam.words_of(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    for k, t in second.items():
        words = f" {' '.join(w.decode() for w in decontam.words_of(t))} "
        if any(f" {x} " in words for x in items.values()):
            assert k not in third
    assert any(third[k] != t for k, t in fourth.items())
    assert all(not base_spans(t) for t in fourth.values())
    pieces = collected(P.STAGES[-1][1](spark, docs, SF))
    assert {p["doc_id"] for p in pieces} == set(fourth)
    assert P.ORACLE_SQL is None


def test_clean_documents_stay(spark):
    """Of the good labelled documents hardly any goes, but for copies and leaks."""
    import corpus_pipeline as P

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    left = {r["doc_id"] for r in collected(P.quality_stage(spark, docs, sf).select("doc_id"))}
    good = [k for k, q in labels.items() if q == 1]
    bad = [k for k, q in labels.items() if q == 0]
    assert sum(k in left for k in good) >= 0.99 * len(good) and sum(k in left for k in bad) <= 0.15 * len(bad)


def test_edges(spark, tmp_dir):
    import corpus_pipeline as P

    rows = [(1, None), (2, ""), (2, ""), (None, "null id text here"), (3, "a@b.co " * 3), (4, "x" * 50_000)]
    docs = frame(spark, rows, [("whole", 1), ("row", 2), ("score", 3), ("fp", 4)])
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    for _, stage in P.STAGES[:-1]:
        docs = P.stored(stage(spark, docs, tmp_dir), "test-stage")
        assert {"doc_id", "text", "whole", "row", "score", "fp"} <= set(docs.columns)
    assert P.run(spark, tmp_dir).count() >= 0
    docs.limit(0).write.parquet(f"{tmp_dir}/e/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{tmp_dir}/{t}.parquet").write.parquet(f"{tmp_dir}/e/{t}.parquet")
    assert P.run(spark, f"{tmp_dir}/e").count() == 0


def test_last_stage_returns_the_token_ids(spark):
    """The packed corpus can be rebuilt from the result alone."""
    import corpus_pipeline as P
    import numpy as np
    from tokenizers import Tokenizer
    from zonecast.llm import packing

    texts = [(1, "some words of the first text"), (2, None), (3, "more " * 2500)]
    pieces = P.stored(P.pack_stage(spark, frame(spark, texts), SF), "test-stage")
    tok = Tokenizer.from_file(P.public_tokenizers.path("byte_bpe_50k.json"))
    want = {k: [*tok.encode(t or "", add_special_tokens=False).ids, 0] for k, t in texts}
    got = {}
    for r in sorted(collected(pieces), key=lambda r: (r["doc_id"], r["start"])):
        got.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert got == want
    rows = collected(packing.sequences(pieces))
    assert all(len(r["input_ids"]) == 4 * 1024 for r in rows)
    assert sum(r["n_tokens"] for r in rows) == sum(map(len, want.values()))


def test_op1_digests_are_those_of_the_ids(spark):
    import corpus_pipeline as P
    from zonecast.llm import packing
    from zonecast.llm.queries import op1_packing

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = packing.pack(docs, P.public_tokenizers.path("byte_bpe_50k.json"))
    key = lambda r: (r["doc_id"], r["start"])
    got = sorted(collected(op1_packing(spark, SF)), key=key)
    assert got == sorted(({n: v for n, v in r.items() if n != "ids"} for r in collected(whole)), key=key)
