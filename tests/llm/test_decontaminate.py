import random

from hypothesis import given, settings
from hypothesis import strategies as st

from fleetlens.llm import decontaminate as dec
from fleetlens.llm.common import ready


def sellers(item, text):
    """Least edits between ``item`` and a substring of ``text``, by the whole table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.text("abc ", min_size=1, max_size=80), st.text("abc ", max_size=120))
def test_bit_parallel_distance(item, text):
    d, end = dec.myers(dec.masks(item), len(item), text)
    assert d == sellers(item, text) and sellers(item, text[:end]) == d


@settings(max_examples=200, deadline=None)
@given(st.text("ab c", min_size=24, max_size=60), st.text("ab c", max_size=160), st.integers(0, 8))
def test_every_occurrence_within_the_budget_is_found(item, text, k):
    hits = dec.Matcher([(1, item, k)]).hits(text)
    d = sellers(item, text)
    assert bool(hits) == (d <= k)
    if hits:
        assert d <= hits[0][1] <= k and sellers(item, text[hits[0][2]:hits[0][3]]) == hits[0][1]


def edited(rng, text, edits):
    t = list(text)
    for at in rng.sample(range(len(t)), edits):
        t[at] = rng.choice(["", "z", t[at] + "q"])
    return "".join(t)


def test_planted_passages(spark, messy, nothing):
    rng = random.Random(3)
    words = ["alpha", "bravo", "charlie", "delta", "echo", "foxtrot", "golf", "hotel", "india", "juliett"]
    items = [(k, " ".join(rng.choice(words) + str(rng.randint(0, 99)) for _ in range(25))) for k in range(6)]
    filler = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs, want = [], set()
    for k, t in items:
        for e, ok in ((0, True), (len(t) // 12, True), (len(t) // 4, False)):
            i = len(docs)
            body = edited(rng, t.upper().replace(" ", ",\n") if e == 0 else t, e)
            docs.append((i, f"{filler(200)} {body} {filler(50)}"))
            if ok:
                want.add((i, k))
    docs += [(100, None), (101, ""), (102, filler(400)), (103, items[0][1][:60]), (0, docs[0][1])]
    bench = spark.createDataFrame([*items, (items[0][0], items[0][1]), (7, None), (8, ""), (9, "alpha"), (None, items[1][1])],
                                  "item_id long, text string")
    df = ready(spark).createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, item_id string").repartition(3)
    got = dec.find(df, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    assert sum((r["doc_id"], r["item_id"]) == (0, 0) for r in got) == 2  # the repeated row
    by = {r["doc_id"]: r for r in got}
    text = docs[0][1]
    assert dec.normal(text[by[0]["start"]:by[0]["end"]]) == dec.normal(items[0][1])
    blocks = dec.find(df, bench, block_items=2).collect()
    assert sorted(map(tuple, blocks)) == sorted(map(tuple, got))
    kept = dec.clean(df, bench)
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in want}
    assert dec.find(nothing, bench).count() == 0 and dec.find(df, bench.limit(0)).count() == 0
    assert dec.clean(messy, bench).count() == messy.count()
    short = dec.find(ready(spark).createDataFrame([(1, "Alpha!"), (2, "alpha bravo")], "doc_id long, text string"), bench).collect()
    assert [(r["doc_id"], r["item_id"]) for r in short] == [(1, 9)]
