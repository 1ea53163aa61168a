import random

import pytest

from fleetlens.llm import components, neardup
from fleetlens.llm.common import ready


def sets(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """(doc_id, class_id, n_links, n_texts) per row."""
    s = [sets(t) for _, t in rows]
    near = [[len(a & b) >= 0.8 * len(a | b) - 1e-9 and bool(a) for b in s] for a in s]
    seen, cls = set(), {}
    for i in range(len(rows)):
        if i not in seen:
            todo, group = [i], []
            seen.add(i)
            while todo:
                x = todo.pop()
                group.append(x)
                new = [y for y in range(len(rows)) if near[x][y] and y not in seen]
                seen.update(new)
                todo += new
            ids = [rows[x][0] for x in group if rows[x][0] is not None]
            for x in group:
                cls[x] = min(ids, default=None)
    return sorted(((rows[i][0], cls[i], sum(near[i]) - bool(s[i]), len({s[j] for j in range(len(rows)) if near[i][j]}) - bool(s[i]))
                   for i in range(len(rows))), key=str)


def family(rng, base, n, most):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, most)):
            w[rng.randrange(len(w))] = f"new{rng.randint(0, 10 ** 6)}"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    texts = []
    for _ in range(12):
        base = [f"w{rng.randint(0, 5000)}" for _ in range(120)]
        texts += family(rng, base, rng.randint(1, 25), 8)
    texts += [texts[0]] * 40 + [texts[0].upper()] + ["a b", "a b", "A  b", "a b c", "", None, " \n", "one"]
    texts += [" ".join(["again"] * 5000)] * 2
    out = [(k, t) for k, t in enumerate(texts)]
    rng.shuffle(out)
    return out + [(None, texts[0]), (None, None), (3, texts[3]), (3, texts[3])]


@pytest.mark.parametrize("blocks", [{}, {"group_block": 4, "cell_block": 3}])
def test_same_as_brute_force(spark, rows, blocks):
    df = ready(spark).createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, key string, cell string").repartition(4)
    got = sorted(map(tuple, neardup.join_counts(df, **blocks).collect()), key=str)
    assert got == brute(rows)


def test_one_of_each_class_stays(spark, rows):
    df = ready(spark).createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, key string").repartition(4)
    out = neardup.keep_one(df)
    assert out.columns == df.columns
    kept = out.collect()
    worded = [r for r in kept if sets(r["text"])]
    want = {c for _, c, _, _ in brute([r for r in rows if sets(r[1])])}
    assert sorted(r["doc_id"] for r in worded) == sorted(want)
    assert len(kept) - len(worded) == sum(not sets(t) for _, t in rows)


def test_depth_reaches_the_target():
    d = neardup.matched_depth(0.8, 0.9999)
    assert 1 - (1 - 0.8 ** d) ** neardup.TREES >= 0.9999 > 1 - (1 - 0.8 ** (d + 1)) ** neardup.TREES
    with pytest.raises(ValueError):
        neardup.matched_depth(0.1, 0.9999)


def test_components_of_long_paths(spark):
    edges = [(k, k + 1) for k in range(0, 300) if k % 100 != 99] + [(1000, 1000)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["key"]: r["root"] for r in components.components(df).collect()}
    want = {k: k // 100 * 100 for k in range(300)}
    assert got == want


def test_empty_and_messy(messy, nothing):
    assert neardup.join_counts(nothing).count() == 0
    assert neardup.join_counts(messy).count() == messy.count()
    assert neardup.keep_one(nothing).count() == 0
