import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import lm
from fleetlens.llm.common import id_crc, ready, table


def tokens(t):
    return (t or "").encode().lower().split() + [lm.END]


@pytest.fixture(scope="module")
def scored(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.collect(), lm.score(docs, id_crc(F.col("doc_id")) % 7 != 2).collect()


def test_base_score_is_add_one(scored):
    docs, rows = scored
    text = {r["doc_id"]: r["text"] for r in docs}
    train = collections.Counter()
    for i, t in text.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            train.update(tokens(t))
    n, v = sum(train.values()), len(train)
    assert len(rows) == len(docs)
    for r in rows:
        w = tokens(text[r["doc_id"]])
        assert r["base_score"] == pytest.approx(sum(math.log10((train[x] + 1) / (n + v + 1)) for x in w), rel=1e-9)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(x in train for x in w), n)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)


def test_mixing_beats_add_one_on_held_out_texts(scored):
    held = [r for r in scored[1] if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.95 * sum(r["base_score"] for r in held)
    assert np.mean([r["score"] > r["base_score"] for r in held]) > 0.9


def test_tree_is_a_complete_prefix_code():
    tree = lm.huffman(np.array([50, 1, 1, 7, 20, 0, 3]))
    paths = {tuple(zip(tree.nodes[a:z].tolist(), tree.bits[a:z].tolist())) for a, z in zip(tree.at, tree.at[1:])}
    assert len(paths) == 7 and sum(2.0 ** -len(p) for p in paths) == 1.0


def test_bits_are_a_probability():
    """Over all symbols that may come next, the model's probabilities add up to one."""
    rng = np.random.default_rng(0)
    coder = lm.Coder({b"%d" % k: k for k in range(9)}, np.arange(10), lm.huffman(np.arange(1, 11)))
    m = lm.Mixer(coder, rng.integers(-60, 60, (lm.ORDERS, lm.SLOTS), dtype=np.int8), lm.START)
    past = np.array([1, 4, 2, 2, 7] * 8)

    def cost(sym):
        return m.bits([(sym, sym + 1)])[0][0]
    total = sum(2.0 ** -(cost(np.r_[past, s]) - cost(past)) for s in range(10))
    # the past shares a block with the next token, so its own bits are the same in every case
    assert total == pytest.approx(1.0, abs=1e-6)


def test_texts_do_not_depend_on_their_neighbours():
    rng = np.random.default_rng(1)
    coder = lm.Coder({b"%d" % k: k for k in range(9)}, np.arange(10), lm.huffman(np.arange(1, 11)))
    m = lm.Mixer(coder, rng.integers(-60, 60, (lm.ORDERS, lm.SLOTS), dtype=np.int8), lm.START)
    texts = [rng.integers(0, 10, n) for n in (1, 700, 20, 333, 16)]
    together, _ = m.bits([(t, t + 1) for t in texts])
    alone = [m.bits([(t, t + 1)])[0][0] for t in texts]
    assert np.allclose(together, alone, rtol=1e-5)


def test_odd_rows(spark, messy, messy_rows, nothing):
    out = lm.score(messy, id_crc(F.col("doc_id")) % 7 != 2).collect()
    assert len(out) == len(messy_rows)
    assert collections.Counter((r["doc_id"], r["n_tokens"]) for r in out) == collections.Counter((d, len(tokens(t))) for d, t, *_ in messy_rows)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 and r["base_score"] < 0 for r in out)
    assert lm.score(nothing, id_crc(F.col("doc_id")) % 7 != 2).count() == 0
    untrained = lm.score(messy, F.lit(False)).collect()
    assert len(untrained) == len(messy_rows) and all(r["held_out"] for r in untrained)


def test_frequent_tokens_are_bounded(spark):
    df = ready(spark).createDataFrame([(b"w%d" % k, 1 + k % 50) for k in range(2000)] + [(lm.END, 3)], "token binary, c long")
    top = lm.frequent(df, 300)
    assert len(top) <= 300 and dict(top)[lm.END] == 3 and min(c for t, c in top if t != lm.END) > 40


def test_rows_of_rare_tokens_follow_their_texts_and_keep_large_ids():
    """Columns are laid out without passing through doubles or a row for each token."""
    big = 2**63 - 1
    rare = [collections.Counter({b"x": 2, b"y": 1}), collections.Counter()]
    out = lm._stats([(7, big, True, b" 7", 0, 4, 1, -2.5, 9.0, 11), (8, None, False, b" 8", 0, 1, 1, -0.5, 3.0, 0)], rare)
    assert out["rid"].tolist() == [7, 8, 7, 7] and out["doc_id"].tolist() == [big, None, None, None]
    assert list(zip(out["token"], out["n"])) == [(b" 7", 0), (b" 8", 0), (b"x", 2), (b"y", 1)]
    assert str(out["n_tokens"].dtype) == "Int64" and out["n_tokens"].isna().tolist() == [False, False, True, True]
    assert out["bytes"].tolist()[:2] == [11, 0] and out["base"].isna().sum() == 2 and len(lm._stats([], [])) == 0
