"""Best-fit packing: ids against the tokenizer itself, places against their definition."""
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from fleetlens.llm import packing
from fleetlens.llm.common import stored, table

public_tokenizers = pytest.importorskip("public_tokenizers")
BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(BPE)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [2]


def test_ids_equal_those_of_the_library(whole):
    rng = random.Random(3)
    signs = ["a", "The", "é", "漢字", " ", " ", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", " ", "　", "'s", "'", "12", "!?", "🙂",
             "<|endoftext|>", "\0", "_", "x" * 70]
    encode = packing.encoder(BPE)
    for _ in range(600):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 40)))
        assert np.frombuffer(encode(text), "<u4").tolist() == whole(text)[:-1], repr(text)


def test_long_texts_are_cut_where_words_end(whole, monkeypatch):
    monkeypatch.setattr(packing, "_SLICE", 50)
    rng = random.Random(4)
    for gap in (" ", "  ", "\n"):
        text = gap.join("".join(rng.choice("abé.") for _ in range(rng.randint(1, 9))) for _ in range(400))
        assert np.frombuffer(packing.encoder(BPE)(text), "<u4").tolist() == whole(text)[:-1]


def test_other_tokenizer_kinds_go_through_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    assert packing.fast_encoder(path) is None
    assert packing.fast_encoder(BPE) is not None


def test_open_sequences_are_best_fit():
    rng = random.Random(5)
    for places in (1, 3, 1000):
        fast, slow, made = packing.OpenSequences(100, places), {}, 0
        for _ in range(800):
            n = rng.randint(1, 100)
            s, offset = fast.put(n)
            fits = [f for f in slow.values() if f >= n]
            if fits:
                assert 100 - offset == min(fits) == slow[s]
            else:
                assert (s, offset) == (made, 0)
                made += 1
                slow[s] = 100
            slow[s] -= n
            slow = {k: f for k, f in slow.items() if f}
            if len(slow) > places:
                fullest = min(slow.values())
                gone = [k for k in slow if slow[k] == fullest and k not in {x for at in fast.by_free for x in at}]
                assert len(gone) == 1
                del slow[gone[0]]
            assert sorted(slow) == sorted(x for at in fast.by_free for x in at)


def check(rows, limit):
    placed = defaultdict(list)
    for r in rows:
        placed[r["sequence_id"]].append((r["offset"], r["length"]))
        assert len(r["ids"]) == 4 * r["length"] and 1 <= r["length"] <= limit
    for at in placed.values():
        end = 0
        for offset, length in sorted(at):
            assert offset == end
            end += length
        assert end <= limit
    return len(placed)


def test_messy_documents(messy, messy_rows, whole):
    rows = packing.sequences(messy.coalesce(1), BPE, limit=64).collect()
    n = check(rows, 64)
    tokens = sum(r["length"] for r in rows)
    assert n <= 1.02 * tokens / 64 + 2
    docs = defaultdict(list)
    for r in rows:
        docs[r["doc_id"]].append(r)
    assert set(docs) == {r[0] for r in messy_rows}  # ids keep their value, also beside NULL
    for doc_id, text in ((2 ** 60 + 1, messy_rows[12][1]), (7, messy_rows[9][1]), (4, ""), (10, None)):
        parts = sorted(docs[doc_id], key=lambda r: r["piece"])
        assert np.frombuffer(b"".join(r["ids"] for r in parts), "<u4").tolist() == whole(text)
        assert [r["start"] for r in parts] == [sum(p["length"] for p in parts[:k]) for k in range(len(parts))]
        assert all(r["length"] == 64 for r in parts[1:])
    assert len(docs[1]) == 2 * len({r["piece"] for r in docs[1]})  # repeated rows are documents of their own


def test_other_id_types_and_empty_table(spark, nothing):
    named = spark.createDataFrame([("a", "one two"), (None, None)], "name string, body string")
    got = packing.sequences(named, BPE, "name", "body").collect()
    assert {r["doc_id"] for r in got} == {"a", None} and check(got, 1024) == 1
    assert packing.sequences(nothing, BPE).collect() == []


def test_streams_and_refused_lengths(spark, messy):
    cut = stored(packing.pieces(messy, BPE, limit=64).repartition(6))
    few, many = packing.pack(cut, 64), packing.pack(cut, 64, stream=1000)
    a, b = check(few.collect(), 64), check(many.collect(), 64)
    assert few.rdd.getNumPartitions() == 1 < many.rdd.getNumPartitions() and a <= b
    assert sorted(map(str, many.collect())) == sorted(map(str, many.collect()))
    with pytest.raises(Exception, match="at least"):
        packing.pack(cut.withColumn("length", F.lit(65).cast("long")), 64).collect()


def test_registered_query(spark, sf_dir, whole):
    rows = entry.queries()["op11_packing"](spark, sf_dir).collect()
    texts = {r[0]: r[1] for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()}
    assert list(rows[0].asDict()) == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert {r["doc_id"] for r in rows} == set(texts)
    ids = {}
    for r in rows:
        x = ids.get(r["doc_id"]) or ids.setdefault(r["doc_id"], whole(texts[r["doc_id"]]))
        part = x[r["start"]:r["start"] + r["length"]]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"] and len(part) == r["length"]
        assert r["piece"] == 0 or r["length"] == 1024
    assert sum(r["length"] for r in rows) == sum(map(len, ids.values()))
    assert len({r["sequence_id"] for r in rows}) <= 1.01 * sum(r["length"] for r in rows) / 1024 + 1
