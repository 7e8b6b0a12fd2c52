import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fascicle.llm import common
from fascicle.llm import token_shards as ts
from fascicle.session import load

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "a b  c d", "x\x1ey\x1e z\x1c\x1dw", "Café café ΑΣ ß İ", "it's <|endoftext|> they'll\t12 3,4", "日本語 テスト", "é ́x", "a" * 3000, "\x00 �", "ﬁ ² ½"]


def reference(texts):
    whole = Tokenizer.from_file(PATH)
    return [np.array(e.ids, "<u4").tobytes() for e in whole.encode_batch(texts, add_special_tokens=False)]


def encoded(encoder, texts):
    return [np.frombuffer(encoder.encode(t.encode()), encoder.width).astype("<u4").tobytes() for t in texts]


def test_segments_encode_like_whole_texts():
    assert encoded(ts.encoder(PATH), ODD) == reference(ODD)


def test_every_plain_character_encodes_alike():
    texts = [a + chr(c) + b for c in range(256) for a in ("", "x", "7", "'", "É") for b in ("", "ß", "re", "9#")]
    assert encoded(ts.encoder(PATH), texts) == reference(texts)


def test_long_texts_are_cut_at_white_space(monkeypatch):
    monkeypatch.setattr(common, "PART", 20)
    texts = ["one two, three four five six seven eight " * 9, "x" * 200, "short"]
    assert encoded(ts.Encoder(PATH), texts) == reference(texts)


@pytest.mark.parametrize("n", [1, 2, 7, 5000])
def test_hash_is_minimal_and_perfect(n):
    hashes = np.array([ts.key_hash(ts.key_of(i, 0))[0] for i in range(n)], np.uint64)
    _, slot = ts.displacements(hashes)
    assert sorted(slot.tolist()) == list(range(n))


def test_displacements_are_tried_in_blocks(monkeypatch):
    """The last buckets of a shard try thousands of displacements."""
    calls, slots = [], ts._slots
    monkeypatch.setattr(ts, "_slots", lambda *a: calls.append(1) or slots(*a))
    table, slot = ts.displacements(np.random.default_rng(3).integers(0, 1 << 63, 2000, dtype=np.uint64))
    assert sorted(slot.tolist()) == list(range(2000)) and table.max() > 500
    assert len(calls) < 4000


def test_round_trip(spark, small):
    docs = load(spark, small, "documents")
    found = ts.token_ids(docs, PATH, shard_ids=20_000).orderBy("start").collect()
    rows = docs.orderBy("doc_id").collect()
    raw = [r + b"\x02\0\0\0" for r in reference([r.text for r in rows])]
    starts = np.cumsum([0] + [len(r) // 4 for r in raw]).tolist()
    assert [(f.doc_id, f.start, f.n_tokens, f.ids_crc32) for f in found] == [
        (r.doc_id, s, len(b) // 4, zlib.crc32(b)) for r, s, b in zip(rows, starts, raw)]
    assert len({f.shard for f in found}) > 8
    shard = ts.Shard(found[0].shard)
    assert shard.width == 2 and shard.ids(found[0].doc_id).astype("<u4").tobytes() == raw[0]
    with pytest.raises(KeyError):
        shard.ids(10**12)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(5, "b", 1), (None, "n", 2), (5, "a", 3), (1, None, 4), (5, "a", 5)], "doc_id long, text string, start int")
    found = ts.token_ids(docs, PATH).orderBy("start").collect()
    assert [(f.doc_id, f.copy, f.start, f.n_tokens) for f in found] == [(None, 0, 0, 2), (1, 0, 2, 1), (5, 0, 3, 2), (5, 1, 5, 2), (5, 2, 7, 2)]
    assert found[1].ids_crc32 == zlib.crc32(b"\x02\0\0\0")
    assert ts.token_ids(docs.limit(0), PATH).collect() == []
