"""Language, quality and toxicity models: held-out accuracy, odd rows, and their parts."""
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from fleetlens.llm import language, learn, quality, toxicity
from fleetlens.llm.common import first_by_hash, id_crc, table


def accuracy(spark, sf_dir, name, label, out, least_rows):
    got = entry.queries()[name](spark, sf_dir)
    if label == "lang":
        truth = table(spark, sf_dir, "documents").select("doc_id", "lang")
    else:
        truth = table(spark, sf_dir, "labels").select("doc_id", label)
    rows = got.join(truth.where(F.col(label).isNotNull()), "doc_id").where("held_out").select(out, label, "score").collect()
    assert len(rows) >= least_rows and all(0 <= r["score"] <= 1 for r in rows)
    return np.mean([r[out] == r[label] for r in rows])


def test_language_on_held_out_documents(spark, sf_dir):
    assert accuracy(spark, sf_dir, "op8_language", "lang", "lang_pred", 100) > 0.95


def test_quality_on_held_out_documents(spark, sf_dir):
    assert accuracy(spark, sf_dir, "op6_quality", "quality", "predicted", 40) > 0.93


def test_toxicity_on_held_out_documents(spark, sf_dir):
    assert accuracy(spark, sf_dir, "op5_toxicity", "toxic", "predicted", 40) > 0.9


def test_language_of_odd_rows(messy, nothing):
    model = language.fit(messy)
    assert model.classes == ["de", "en", "fr"]
    out = language.predict(messy, model)
    assert out.count() == messy.count() and set(out.columns) == set(messy.columns)
    got = {(r["doc_id"], r["text"] if r["text"] is None else r["text"][:9]): (r["lang_pred"], r["score"]) for r in out.collect()}
    for k in ((None, None), (4, ""), (5, " \t\n "), (9, "12 34 !!"), (10, None)):
        assert got[k] == ("und", 0.0)
    assert got[(8, "x" * 9)][0] in model.classes
    kept = language.keep_known(messy, model, least=0.0)
    assert kept.columns == messy.columns and kept.count() == messy.count() - 5
    none = language.fit(nothing)
    assert none.classes == [] and language.predict(nothing, none).count() == 0
    assert language.keep_known(messy, none).count() == messy.count() - 5


def test_language_of_only_long_texts_is_learnt(messy):
    """The only German text of ``messy`` is longer than the texts that are taken first."""
    model = language.fit(messy)
    assert model.classes == ["de", "en", "fr"]
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(messy.where("doc_id = 8"), model).collect()}
    assert got == {8: "de"}


def test_languages_of_long_or_nameless_texts_and_late_names_are_learnt(spark):
    words = {"aa": "the cat and the dog ", "long": "le chat et la souris ", "noid": "der Hund und die Katze ", "zz": "el perro y el gato "}
    rows = [(k, words["aa"] * 5, "aa") for k in range(40)] + [(100 + k, words["long"] * 1500, "long") for k in range(10)]
    rows += [(None, words["noid"] * (5 + k), "noid") for k in range(10)]
    rows += [(200 + k, chr(0x4E00 + 7 * k) * 30, f"m{k:03d}") for k in range(220)]
    rows += [(600 + k, words["zz"] * 5, "zz") for k in range(10)] + [(700, "12 34", "nil")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df, most_rows=3000)
    assert set(model.classes) == {r[2] for r in rows} - {"nil"}
    p, _ = model.scores(list(words.values()))
    assert [model.classes[k] for k in p.argmax(1)] == list(words)


def test_ngrams_of_pieces_are_those_of_the_text():
    from fleetlens.llm import texts
    t = "Über die Brücke, 12 ça va?" * 3
    whole = sorted(np.concatenate(list(language._grams(t))).tolist())
    cut = sorted(np.concatenate([g for p, n in texts.pieces(t, limit=7) for g in language._grams(p, n)]).tolist())
    assert whole == cut


def test_learning_rows_are_the_allowed_ones(spark):
    """Labels of held-out rows change nothing."""
    rows = [(k, "the cat and the dog " * 5 if k % 2 else "le chat et la souris " * 5, "en" if k % 2 else "fr") for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = id_crc(F.col("doc_id")) % 4 == 2
    wrong = df.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang")))
    a, b = (language.fit(x.where(~held)) for x in (df, wrong))
    assert a.classes == b.classes and np.array_equal(a.weights, b.weights)


def test_sample_is_bounded_and_stable(spark):
    df = spark.range(5000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    one = {tuple(r) for r in first_by_hash(df.repartition(3), "y", "id", 100).collect()}
    two = {tuple(r) for r in first_by_hash(df.repartition(8), "y", "id", 100).collect()}
    assert one == two and sum(y for _, y in one) == 100 and len(one) == 200


def test_ftrl_is_sparse_and_learns():
    rng = np.random.default_rng(0)
    rows = [(np.array([y, 2 + rng.integers(0, 50)]), np.ones(2)) for y in (np.arange(600) % 2)]
    y = np.arange(600) % 2
    w = learn.ftrl(rows, y, 2, 60, l1=2.0)
    assert (w == 0).mean() > 0.5
    assert np.mean([np.argmax(x @ w[at]) == k for (at, x), k in zip(rows, y)]) > 0.98


def test_temperature_and_isotonic():
    rng = np.random.default_rng(1)
    p = rng.random(4000)
    y = (rng.random(4000) < p).astype(int)
    sharp = 3 * np.log(p / (1 - p))
    t = learn.temperature(np.stack([np.zeros(4000), sharp], 1), y)
    assert t == pytest.approx(3, rel=0.15)
    x, v = learn.isotonic(np.array([1.0, 2, 3, 4]), np.array([0, 1, 0, 1.0]))
    assert np.allclose(np.interp([1, 2, 3, 4], x, v), [0, 0.5, 0.5, 1])


def test_quality_normal_equations_are_ridge(spark):
    """The sums over partitions give the same weights as one least-squares solve."""
    rng = np.random.default_rng(2)
    k = len(quality.NAMES)
    x = rng.normal(size=(300, k))
    y = (x[:, 0] > 0).astype(float)
    df = spark.createDataFrame([(r.tolist(), float(v), i % 5) for i, (r, v) in enumerate(zip(x, y))],
                               "__x array<double>, label double, fold long").repartition(5)
    m = quality.fit(df, features=32)
    z = m.lift(x[np.arange(300) % 5 < 4])
    pen = np.full(33, 3e-3 * len(z) / 32)
    pen[-1] = 1e-9
    assert np.allclose(m.weights, np.linalg.solve(z.T @ z + np.diag(pen), z.T @ y[np.arange(300) % 5 < 4]), atol=1e-6)
    s = m.score(x)
    assert ((s >= 0) & (s <= 1)).all() and s[y == 1].mean() > s[y == 0].mean() + 0.1


def test_quality_of_odd_rows(spark, messy, nothing):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(20, 50)] + [(None, 1, 1), (777, 0, 0), (21, None, None), (22, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    may = id_crc(F.col("doc_id")) % 4 != 2
    out = quality.classify(messy, labels, may)
    assert out.count() == messy.count() and out.where("score is null or score < 0 or score > 1").count() == 0
    assert quality.classify(nothing, labels, may).count() == 0
    assert {r["score"] for r in quality.classify(messy, labels.limit(0), may).collect()} == {0.5}


def test_toxicity_of_odd_rows(spark, messy, nothing):
    labels = spark.createDataFrame([(k, 0, k % 2) for k in range(20, 50)] + [(None, 1, 1), (777, 0, 0), (21, None, None)],
                                   "doc_id long, quality int, toxic int")
    may = lambda c: id_crc(F.col(c)) % 5 != 0
    out = toxicity.classify(messy, labels, may)
    assert out.count() == messy.count() and out.where("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.classify(nothing, labels, may).count() == 0
    assert {r["score"] for r in toxicity.classify(messy, labels.limit(0), may).collect()} == {0.0}


def test_kernel_is_the_gap_weighted_triple_kernel():
    """Explicit features give the kernel that counting all index triples gives."""
    def features(w):
        s, out = f"\x02{w}\x03", {}
        norm = 0.0
        for i in range(len(s)):
            for j in range(i + 1, len(s)):
                for k in range(j + 1, min(len(s), i + toxicity.SPAN + 1)):
                    v = toxicity.DECAY ** (k - i - 1)
                    out[s[i] + s[j] + s[k]] = out.get(s[i] + s[j] + s[k], 0) + v
                    norm += v * v
        return {t: v / norm ** 0.5 for t, v in out.items()}
    words = ["idiot", "id*iot", "trash", "a", "straßen", "banana"]
    f = [features(w) for w in words]
    want = [[sum(v * b.get(t, 0) for t, v in a.items()) for b in f] for a in f]
    assert np.allclose(toxicity.project(words, toxicity.feature_table(words)), want, atol=0.02)


def test_gapped_insults_are_found(spark, sf_dir):
    rows = (table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
            .where("toxic is not null").orderBy("doc_id").select("text", "toxic").collect())
    model = toxicity.train([r["text"] for r in rows], np.array([r["toxic"] for r in rows]))
    clean = "the of and that thing is here with the "
    odd = [clean + x for x in ("", "id*iot sc.um", "m-o-r-o-n s-t-u-p-i-d", "p a t h e t i c idiot", "stupid moron")]
    two = toxicity.Scorer(model).two_best(odd)
    p = model.probability(two)
    assert p[0] < 0.2 and (p[1:] > 0.5).all()
    torn = model.margins(["stuxpid", "idixot", "scqum", "erthing", "thatand", "inher"])
    assert torn[:3].min() > torn[3:].max()  # an inserted letter leaves an insult above other words


def test_long_words_are_read_whole():
    w = "xz" * 150 + "idiot" + "yw" * 150
    assert any("idiot" in x for x in toxicity.windows(w))
    assert toxicity.words_of("You are an I D I O T.")[-1] == "idiot"


def test_single_torn_insults_are_predicted(spark, sf_dir):
    rows = (table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
            .where("toxic is not null").orderBy("doc_id").select("text", "toxic").collect())
    model = toxicity.train([r["text"] for r in rows], np.array([r["toxic"] for r in rows]))
    clean = "the of and that thing is here with the "
    odd = ["", "id*iot", "p a t h e t i c", "stuxpid idxiot", "stuxpid", "stu pid", "id iot here", "m-o-r-o-n"]
    p = model.probability(toxicity.Scorer(model).two_best([clean + x for x in odd]))
    assert p[0] < 0.2 and (p[1:] > 0.5).all()


def test_neighbouring_words_are_joined_where_an_insult_may_be_broken():
    at = frozenset(toxicity.junctions(["idiot"]))
    assert toxicity.joined("you id iot now".split(), at) == {"idiot": ("id", "iot")}
    assert toxicity.joined("an i diot or idio t".split(), at) == {"idiot": ("idio", "t")} and not toxicity.joined("a day to".split(), at)
