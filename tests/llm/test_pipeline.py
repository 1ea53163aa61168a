"""Each stage against a plain reading of what it decides, on its own input."""
import corpus_pipeline as cp
from fleetlens.llm import decontaminate, mixing, sharding
from fleetlens.llm.common import stored, table
from test_decontaminate import sellers
from test_neardup import brute, sets


def test_stages_in_order(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    assert [n for n, _ in cp.STAGES] == ["language identification", "n-gram Jaccard join", "benchmark decontamination",
                                         "source mixing", "sharding"]
    language, unique, clean, mixed = (f for _, f in cp.STAGES[:-1])

    one = stored(language(spark, docs, sf_dir))
    assert one.columns == columns
    gone = docs.join(one.select("doc_id"), "doc_id", "left_anti").collect()
    assert len(gone) < 0.02 * docs.count()

    two = stored(unique(spark, one, sf_dir))
    rows = [(r["doc_id"], r["text"]) for r in one.select("doc_id", "text").collect()]
    want = {c for (_, c, _, _) in brute_classes(rows)}
    assert two.columns == columns and {r["doc_id"] for r in two.select("doc_id").collect()} == want and two.count() == len(want)

    three = stored(clean(spark, two, sf_dir))
    items = [decontaminate.normal(r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
    leaks = set()
    for r in two.select("doc_id", "text").collect():
        t = decontaminate.normal(r["text"])
        if any(i in t for i in items):
            leaks.add(r["doc_id"])
    kept = {r["doc_id"] for r in three.select("doc_id").collect()}
    assert leaks and not leaks & kept
    for r in two.where(~two["doc_id"].isin(list(kept | leaks))).collect():  # dropped without an exact hit: within the budget
        t = decontaminate.normal(r["text"])
        assert any(sellers(i, t) <= len(i) // 10 for i in items)

    four = stored(mixed(spark, three, sf_dir))
    assert four.columns == columns
    taken = {r["doc_id"]: r for r in mixing.taken(mixing.thin_documents(three)).collect()}
    assert {r["doc_id"] for r in four.select("doc_id").distinct().collect()} <= set(taken)
    n = {r["doc_id"]: r["count"] for r in four.groupBy("doc_id").count().collect()}
    assert max(n.values()) <= 2
    words = four.select(mixing.n_words(four["text"]).alias("n")).groupBy().sum("n").first()[0]
    assert abs(words - sum(r["taken"] for r in taken.values())) < 0.02 * words

    five = cp.STAGES[-1][1](spark, four, sf_dir)
    assert five.columns == [*columns, "slot", "shard"] and five.count() == four.count()
    owner = sharding.fill_table(cp.SHARDS, cp.TABLE_SIZE)
    assert all(owner[r["slot"]] == r["shard"] for r in five.select("slot", "shard").distinct().collect())


def brute_classes(rows):
    """As ``brute``, but only texts that share a shingle are compared."""
    by = {}
    for i, (_, t) in enumerate(rows):
        for s in sets(t):
            by.setdefault(s, []).append(i)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for group in by.values():
        for i in group:
            if find(i) != find(group[0]):
                parent[find(i)] = find(group[0])
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r)
    return [x for g in groups.values() for x in brute(g)]


def test_stages_survive_odd_rows(spark, sf_dir, messy, nothing):
    for docs in (messy, nothing):
        x = docs
        for _, f in cp.STAGES:
            x = stored(f(spark, x, sf_dir))
            assert set(docs.columns) <= set(x.columns)
