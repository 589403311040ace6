import zlib

from zonecast.llm import sharding

from .helpers import SF, collected, frame


def check(rows, texts, shards):
    """Sizes, checksums, gapless slots and near-equal shards."""
    want = sorted((str(k), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for k, t in texts)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == want
    by = {}
    for r in rows:
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
        by.setdefault(r["shard"], []).append(r)
    for group in by.values():
        assert sorted(r["slot"] for r in group) == list(range(len(group)))
    sizes = [sum(r["size"] for r in by.get(s, [])) for s in range(shards)]
    if rows:
        # a cut is off by half of the document on either side at most
        assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in rows)
    return by


def test_edges(spark):
    texts = [(1, None), (2, ""), (3, "é"), (3, "é"), (None, "abc"), (4, "x" * 5000)] + [(10 + i, f"t{i}" * (i % 7)) for i in range(200)]
    df = frame(spark, texts, [("key", 1), ("row", 2), ("shard", "s"), ("size", None)])
    check(collected(sharding.assign(df, 5)), texts, 5)
    assert sharding.assign(frame(spark, []), 5).count() == 0
    check(collected(sharding.assign(frame(spark, [(1, "a")]), 40)), [(1, "a")], 40)


def test_hot_text_is_subdivided(spark):
    texts = [(i, "the same text" if i % 3 else f"text {i} " * 5) for i in range(3000)]
    rows = sharding.stored(
        frame(spark, texts).selectExpr("doc_id", "length(text) + 16L as size", "xxhash64(text) as key", "monotonically_increasing_id() as row"), "t"
    )
    p = sharding.plan(rows, 10, rows_per_range=100)
    biggest = p.place(rows).groupBy("rng", "piece").count().agg({"count": "max"}).first()[0]
    assert max(p.pieces) > 5 and biggest < 400
    by = check(collected(sharding.assign(frame(spark, texts), 10, rows_per_range=100)), texts, 10)
    # equal texts stand together: the hot text fills whole shards, others have none or share a cut
    mixed = [s for s, g in by.items() if len({r["text_crc32"] == zlib.crc32(b"the same text") for r in g}) == 2]
    assert len(mixed) <= 2


def test_binary_search(spark):
    cuts = [-5, 0, 7, 7 + 2 ** 40]
    df = spark.range(-8, 12).selectExpr("id as key").union(spark.sql("select 1099511627783L")).union(spark.sql("select 1099511627784L"))
    for r in df.withColumn("g", sharding.range_of(df.key, cuts)).collect():
        assert r.g == sum(c <= r.key for c in cuts)
    assert {r.g for r in df.withColumn("g", sharding.range_of(df.key, [])).collect()} == {0}


def test_write_shards(spark, tmp_dir):
    texts = [(i, "w" * (i % 50)) for i in range(300)]
    back = collected(sharding.write_shards(frame(spark, texts, [("row", 1), ("shard", 2)]), f"{tmp_dir}/s", 7))
    assert sorted((r["whole"]["doc_id"], r["whole"]["text"]) for r in back) == texts
    for s in {r["shard"] for r in back}:
        assert sorted(r["slot"] for r in back if r["shard"] == s) == list(range(sum(r["shard"] == s for r in back)))


def test_whole_table_and_no_python(spark, capsys):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    df = sharding.assign(docs)
    check(collected(df), [(r.doc_id, r.text) for r in docs.collect()], 40)
    df.explain()
    assert not any(word in capsys.readouterr().out for word in ("Python", "Arrow", "Cartesian", "NestedLoop"))
