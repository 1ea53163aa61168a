import collections
import re

import pytest

from fleetlens.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fill(sizes, cycle=(5, 2, 1), share=1.5, cap=2):
    """Targets by repeated sharing of what full sources cannot take."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: cycle[k % len(cycle)] for k, s in enumerate(names)}
    total, full = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in full]
        level = (total - sum(full.values())) / sum(weight[s] for s in rest) if rest else 0
        over = [s for s in rest if level * weight[s] > cap * sizes[s] + 1e-9]
        if not over:
            return full | {s: level * weight[s] for s in rest}
        full |= {s: cap * sizes[s] for s in over}


def test_targets_meet_the_contract(spark, messy, messy_rows):
    rows = mixing.taken(mixing.thin_documents(messy), block=16).collect()
    size = lambda t: len(WORD.findall(t or ""))
    assert collections.Counter((r["doc_id"], r["size"]) for r in rows) == collections.Counter((d, size(t)) for d, t, *_ in messy_rows)
    sizes = collections.Counter()
    for _, t, _, s, _ in messy_rows:
        sizes[s] += size(t)
    want = fill(dict(sizes))
    got = {(r["source_size"], round(r["target"], 6)) for r in rows}
    assert got == {(sizes[s], round(want[s], 6)) for s in sizes}
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    assert sum(r["taken"] for r in rows) == sum(round(x) for x in want.values())


def test_reruns_agree(messy):
    run = lambda n: sorted(map(tuple, mixing.taken(mixing.thin_documents(messy.repartition(n)), block=16).collect()), key=str)
    assert run(2) == run(7)


def test_schedule_is_evenly_spread(spark):
    docs = spark.createDataFrame([(k, "w " * 50, None, ("a", "b", "c")[k % 3], 1) for k in range(120)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    pieces, _ = mixing.mix(mixing.thin_documents(docs), block=10)
    slots = sorted({(r["slot"], r["source"], r["r"]) for r in pieces.collect()})
    total = collections.Counter(s for _, s, _ in slots)
    seen, n = collections.Counter(), 0
    for _, s, r in slots:
        seen[s] += 1
        n += 1
        assert all(abs(seen[x] - n * total[x] / len(slots)) < 6 for x in total)
    for s in total:  # each source reads its blocks in order, one to a slot
        ranks = [r for _, x, r in slots if x == s]
        assert ranks == sorted(ranks) and len(set(ranks)) == len(ranks)


def test_empty_table(nothing):
    assert mixing.taken(mixing.thin_documents(nothing)).count() == 0
    assert mixing.apply(nothing).count() == 0


def test_applied_mix_repeats_documents(messy):
    out = mixing.apply(messy, block=16)
    assert out.columns == messy.columns
    words = sum(len(WORD.findall(r["text"])) for r in out.select("text").collect())
    want = sum(r["taken"] for r in mixing.taken(mixing.thin_documents(messy), block=16).select("taken").collect())
    assert words == pytest.approx(want, rel=0.02)


def test_first_slots_are_those_of_the_schedule(spark, messy):
    thin = mixing.thin_documents(messy)
    pieces, _ = mixing.mix(thin, block=16)
    first = {}
    for r in pieces.collect():
        k = (r["source"], r["start"])
        first[k] = min(first.get(k, r["slot"]), r["slot"])
    got = mixing.taken(thin, block=16).collect()
    assert sorted(x["first_slot"] for x in got if x["first_slot"] is not None) == sorted(first.values())
    assert all((x["first_slot"] is None) == (x["taken"] == 0) for x in got)


def test_applied_mix_follows_the_schedule(spark):
    docs = spark.createDataFrame([(k, f"w{k} " * 40, ("a", "b", "c")[k % 3]) for k in range(300)], "doc_id long, text string, source string").repartition(5)
    rows = mixing.apply(docs, block=10).collect()
    total = collections.Counter(r["source"] for r in rows)
    seen = collections.Counter()
    for n, r in enumerate(rows, 1):  # every prefix has the sources in their shares; in join order it would not
        seen[r["source"]] += 1
        assert all(abs(seen[s] - n * total[s] / len(rows)) < 8 for s in total)
    slot = {r["doc_id"]: r["first_slot"] for r in mixing.taken(mixing.thin_documents(docs, mixing.F.md5(docs["text"].cast("binary"))), block=10).collect()}
    firsts = [slot[i] for i in dict.fromkeys(r["doc_id"] for r in rows)]
    assert firsts == sorted(firsts)
