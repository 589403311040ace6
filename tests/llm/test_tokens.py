import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from zonecast.llm import packing, records
from zonecast.llm.crc32c import crc32c, masked
from zonecast.llm.tokens import tokenizer

from .helpers import SF, collected, frame

BYTES, WORDS = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
ODD = ["", " ", "  ", "a", " a", "a ", "a\n b", "a \nb", "a\n\n b", "a  b", "a \n b", "x\n \ny", "é ü\tß", "a\0 b", "\0",
       "a  b", "Ünï ÇØ 12 3!!", "the<|endoftext|> the", "é a", "’s 's it's", "a\r\n b", "a\x1c b \x85 c"]


@pytest.fixture(scope="module")
def direct():
    from tokenizers import Tokenizer

    out = {}
    for path in (BYTES, WORDS):
        t = Tokenizer.from_file(path)
        out[path] = lambda x, t=t: t.encode(x, add_special_tokens=False).ids
    return out


@pytest.mark.parametrize("path,style", [(BYTES, "leading"), (WORDS, "dropped")])
def test_memo_equals_direct_odd_texts(direct, path, style):
    for text, got in zip(ODD, tokenizer(path, style).encode(ODD)):
        assert np.frombuffer(got, "<u4").tolist() == direct[path](text), repr(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab'sZé1 \n\t., 　́ßΣ#*")), max_size=40))
def test_memo_equals_direct_random(text):
    from tokenizers import Tokenizer

    for path, style in ((BYTES, "leading"), (WORDS, "dropped")):
        memo = tokenizer(path, style)
        want = memo.tok.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(memo.encode([text])[0], "<u4").tolist() == want
    assert Tokenizer


def plain_crc(data):
    r = 0xFFFFFFFF
    for byte in data:
        r ^= byte
        for _ in range(8):
            r = (r >> 1) ^ (0x82F63B78 if r & 1 else 0)
    return r ^ 0xFFFFFFFF


def test_crc32c_known_and_random():
    rng = np.random.default_rng(1)
    data = [b"123456789", b"", b"\0" * 100] + [rng.bytes(n) for n in (1, 3, 4, 63, 64, 65, 200, 4097)]
    assert crc32c(data)[0] == 0xE3069283
    assert crc32c(data).tolist() == [plain_crc(d) for d in data]
    c = plain_crc(b"abc")
    assert masked(np.asarray([c], np.uint32))[0] == (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def check_pieces(rows, texts, ids_of, window):
    """Pieces tile the documents and the sequences, and carry the right ids."""
    place = sorted(rows, key=lambda r: (r["sequence_id"], r["offset"]))
    at = 0
    for r in place:
        assert r["sequence_id"] * window + r["offset"] == at and 0 < r["length"] <= window - r["offset"]
        at += r["length"]
    want = sorted(
        (k, len(ids_of(t or "")) + 1) for k, t in texts
    ) if all(k is not None for k, _ in texts) else None
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], []).append(r)
    if want and len({k for k, _ in texts}) == len(texts):
        for k, t in texts:
            ids, pos = [*ids_of(t or ""), 0], 0
            for r in sorted(got[k], key=lambda r: r["start"]):
                assert r["start"] == pos and r["doc_tokens"] == len(ids)
                piece = np.asarray(ids[pos:pos + r["length"]], "<u4").tobytes()
                assert r["ids_crc32"] == zlib.crc32(piece)
                pos += r["length"]
            assert pos == len(ids)
    assert at == sum(len(ids_of(t or "")) + 1 for _, t in texts)


def test_pack_edges(spark, direct):
    texts = [(1, "a b c"), (2, None), (3, ""), (4, "word " * 3000 + "end"), (5, "a b c"), (6, "Ünï\n\nx  y")]
    df = frame(spark, texts, [("ids", 1), ("part", "x"), ("length", None)]).repartition(3)
    rows = collected(packing.pack(df, BYTES, window=64))
    check_pieces(rows, texts, direct[BYTES], 64)
    seqs = collected(packing.sequences(packing.pack(df, BYTES, window=64), 64))
    assert all(len(s["input_ids"]) == 256 for s in seqs)
    assert sum(s["n_tokens"] for s in seqs) == sum(r["length"] for r in rows)


def test_pack_repeats_nulls_empty(spark, direct):
    texts = [(1, "a b"), (1, "a b"), (None, "q"), (None, None)]
    rows = collected(packing.pack(frame(spark, texts), BYTES, window=4))
    assert sum(r["length"] for r in rows) == sum(len(direct[BYTES](t or "")) + 1 for _, t in texts)
    assert packing.pack(frame(spark, []), BYTES).count() == 0


def test_pack_whole_table(spark, direct):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows = collected(packing.pack(docs, BYTES, keep_ids=False))
    check_pieces(rows, texts, direct[BYTES], 1024)


def test_records_round_trip(spark, tmp_dir, direct):
    texts = [(5, "a b c"), (2, None), (3, ""), (4, "Word " * 3000), (1, "ß é"), (9, "A\n\nB")]
    df = frame(spark, texts, [("row", 1), ("part", 2), ("file", "x")]).repartition(3)
    index = collected(records.write_records(df, tmp_dir, WORDS, roll_bytes=2000))
    rows = {r["doc_id"]: r for r in collected(records.read_records(spark, tmp_dir))}
    at = 0
    for k, t in sorted(texts):
        ids = np.asarray([*direct[WORDS](t or ""), 2], "<u4")
        r = rows[k]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        assert r["ids"] == ids.tobytes()
        at += len(ids)
    assert len({i["file"] for i in index}) > 1
    for i in index:
        key, ids = records.fetch(tmp_dir, i["file"], i["offset"], i["length"])
        assert key == i["doc_id"] and ids.tobytes() == rows[key]["ids"]


def test_records_ties_nulls_empty(spark, tmp_dir):
    texts = [(1, "a"), (1, "b"), (1, "a"), (None, "q"), (0, None)]
    records.write_records(frame(spark, texts), f"{tmp_dir}/x", WORDS)
    rows = sorted(collected(records.read_records(spark, f"{tmp_dir}/x")), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 0, 1, 1, 1]
    assert [r["start"] for r in rows] == [0, 2, 3, 5, 7]
    records.write_records(frame(spark, []), f"{tmp_dir}/y", WORDS)
    assert collected(records.read_records(spark, f"{tmp_dir}/y")) == []


def test_damage_is_noticed(spark, tmp_dir):
    import glob
    import io

    whole = b"".join(records.frame([b"abc" * 9, b"", b"x" * 700]))
    assert [p for _, ps in records.unframe(io.BytesIO(whole), "f") for p in ps] == [b"abc" * 9, b"", b"x" * 700]
    for k in range(len(whole)):
        bad = whole[:k] + bytes([whole[k] ^ 1]) + whole[k + 1:]
        with pytest.raises(records.DamagedRecord):
            list(records.unframe(io.BytesIO(bad), "f"))
    with pytest.raises(records.DamagedRecord):
        list(records.unframe(io.BytesIO(whole[:-1]), "f"))
    # a file that the index does not name (a lost attempt's) is not read
    records.write_records(frame(spark, [(1, "a")]), tmp_dir, WORDS)
    with open(f"{tmp_dir}/records/part-0000000-99-00000.rec", "wb") as f:
        f.write(b"half")
    assert records.read_records(spark, tmp_dir).count() == 1
    assert len(glob.glob(f"{tmp_dir}/records/*.rec")) == 2


@pytest.mark.parametrize("path,style", [(BYTES, "leading"), (WORDS, "dropped")])
def test_added_tokens_in_a_text_get_the_ids_of_the_library(direct, path, style):
    """Against a tokenizer as it is loaded, at every place of a text."""
    from tokenizers import Tokenizer

    added = {i: t.content for i, t in Tokenizer.from_file(path).get_added_tokens_decoder().items()}
    assert added
    texts = []
    for t in added.values():
        texts += [f"the {t} the", t, t + t, f"a{t}b", f" {t} ", f"x {t}\n{t} y  z", t[:-1], t[1:], t.upper(), t[:3] + t + t[3:], f"é{t}ü\u3000{t}"]
    for text, got in zip(texts, tokenizer(path, style).encode(texts)):
        assert np.frombuffer(got, "<u4").tolist() == direct[path](text), repr(text)
    assert set(added) & set(direct[path](texts[0]))


@pytest.mark.parametrize("path,style", [(BYTES, "leading"), (WORDS, "dropped")])
def test_memos_are_bounded_within_one_text(direct, path, style, monkeypatch):
    from zonecast.llm import tokens

    monkeypatch.setattr(tokens, "WORDS", 200)
    monkeypatch.setattr(tokens, "PIECE_BYTES", 50_000)
    memo, most = tokens.WordMemo(path, style), [0, 0]
    text = " ".join(f"w{k:x}q, zz{k}" for k in range(20_000)) + " " + "y" * 5000

    def held(d):
        return sum(100 + s.__sizeof__() + v.__sizeof__() for s, v in d.items())

    make = memo.words.make

    def watched(word):
        if len(memo.words) % 40 in (0, 39):
            most[0], most[1] = max(most[0], len(memo.words)), max(most[1], held(memo.pieces))
        return make(word)

    memo.words.make = watched
    got = memo.encode([text])[0]
    assert np.frombuffer(got, "<u4").tolist() == direct[path](text)
    assert 0 < most[0] <= 200 and 0 < most[1] <= 50_000
    assert max(map(len, memo.words)) <= tokens.LONG and max(map(len, memo.pieces)) <= tokens.LONG
