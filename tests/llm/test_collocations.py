"""Dynamic itemset counting against plain counting."""
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fleetlens.llm import collocations


def brute(rows, support, longest, top, cover=100):
    """rows: (text, lang)."""
    count, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    count[lang][tuple(words[i:i + n])] += 1
    out = []
    for lang, f in count.items():
        f = {p: a for p, a in f.items() if a >= support}
        kept = []
        for p, a in f.items():
            if len(p) < 2:
                continue
            if any(100 * b >= cover * a for q, b in f.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))):
                continue
            cuts = [(1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            s, k = min(cuts)
            kept.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, total[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def found(df, **how):
    return sorted(tuple(r) for r in collocations.collocations(df, **how).collect())


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    rows = []
    for k in range(160):
        lang = ("en", "en", "de", None)[k % 4]
        words = [rng.choice(["the", "The", "a", "a", "of", "état", "x1", "New York", "to be or not", "a a a", "q" + str(rng.randint(0, 50))])
                 for _ in range(rng.randint(0, 60))]
        rows.append(("".join(w + rng.choice([" ", " ", "  ", "\t", ", ", ".\n", " ;: "]) for w in words), lang))
    return rows


@pytest.mark.parametrize("shards", [1, 2, 5])
def test_equals_plain_counting(spark, texts, shards):
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(texts)], "id long, text string, lang string").repartition(4)
    for support, longest, top, cover in ((8, 5, 2000, 100), (3, 4, 7, 60)):
        want = brute(texts, support, longest, top, cover)
        assert len(want) > 10
        assert found(df, support=support, longest=longest, top=top, cover=cover, shards=shards) == want


def test_full_bit_tables_shuffled_joins_and_small_chunks_change_nothing(spark, texts, monkeypatch):
    df = spark.createDataFrame(texts, "text string, lang string")
    want = brute(texts, 8, 5, 2000)
    monkeypatch.setattr(collocations, "MOST_BITS", 10)
    monkeypatch.setattr(collocations, "BITS_EACH", 0)
    monkeypatch.setattr(collocations, "SMALL", 0)
    assert found(df, support=8, shards=2) == want


def test_small_chunks_and_cut_texts(spark, texts):
    import numpy as np
    import pyarrow as pa
    every = np.full(1 << 4, -1, np.int64).view(np.uint64)
    whole = pa.array(["a b c \n", "a b \n d a b \n"])
    got = {(n, p): c for n, ps, cs in collocations.count_chunk("en", whole, 3, True, every, every, 10) for p, c in zip(ps.to_pylist(), cs.tolist())}
    assert got == {(1, "a"): 3, (1, "b"): 3, (1, "c"): 1, (1, "d"): 1, (2, "a b"): 3, (2, "b c"): 1, (2, "d a"): 1, (3, "a b c"): 1, (3, "d a b"): 1}
    parts = list(collocations._slices("x" * 20 + "\n" + "y" * 20))
    assert "".join(parts) == "x" * 20 + "\n" + "y" * 20


def test_messy_documents(messy, messy_rows, nothing):
    rows = [(r[1], r[2]) for r in messy_rows]
    assert found(messy, support=2, top=300, shards=2) == brute(rows, 2, 5, 300)
    assert found(messy, support=10 ** 6) == [] and found(nothing) == []


def test_scores_are_exact_beyond_64_bits(spark):
    a, n = 3 * 10 ** 11 + 7, 9 * 10 ** 14 + 1
    rows = [("en", "x y", 2, a), ("en", "x", 1, a + 5), ("en", "y", 1, 4 * 10 ** 11 + 3)]
    got = collocations.score(spark.createDataFrame(rows, "lang string, phrase string, len int, a long"),
                             spark.createDataFrame([("en", n)], "lang string, n long")).first()
    assert got["score"] == 1000 * a * n // ((a + 5) * (4 * 10 ** 11 + 3))


def test_scans_stop_and_phrases_are_counted_once(spark):
    df = spark.createDataFrame([("a b c d e",)] * 40 + [("b c",)] * 3, "text string").withColumn("lang", F.lit("en"))
    phrases, totals = collocations.frequent(df, 40, 5, 3)
    assert {r["phrase"]: r["a"] for r in phrases.collect()} == brute_counts("a b c d e".split(), 40, {"b": 43, "c": 43, "b c": 43})
    assert totals.first()["n"] == 206


def brute_counts(words, n, more):
    return {" ".join(words[i:j]): n for i in range(5) for j in range(i + 1, 6)} | more
