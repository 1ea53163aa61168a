"""One registered query per operator, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.llm import collocations, decontaminate, language, licenses, lm, mixing, neardup, negatives, packing, quality, sharding, topk, toxicity
from fleetlens.llm.common import id_crc, table
from fleetlens.plans.registry import query

# ------------------------------------------------------------------ 1: sharding
SHARDS = [f"shard-{n:03d}" for n in range(16)]
TABLE_SIZE = 2053

_SHARD_SQL = f"""
WITH RECURSIVE names AS (
  SELECT k, 'shard-' || lpad(k::VARCHAR, 3, '0') AS shard FROM range({len(SHARDS)}) r(k)
), prefs AS (
  SELECT k, shard, list(((off + j * skip) % {TABLE_SIZE})::BIGINT ORDER BY j) AS pref
  FROM (SELECT k, shard, ('0x' || substr(md5(shard || ':offset'), 1, 15))::BIGINT % {TABLE_SIZE} AS off,
               ('0x' || substr(md5(shard || ':skip'), 1, 15))::BIGINT % ({TABLE_SIZE} - 1) + 1 AS skip FROM names),
       range({TABLE_SIZE}) t(j)
  GROUP BY k, shard
), fill(turn, free, slot, k) AS (
  SELECT 0::BIGINT, list_transform(range({TABLE_SIZE}), lambda x: true), NULL::BIGINT, NULL::BIGINT
  UNION ALL
  SELECT turn + 1, list_transform(free, lambda f, i: f AND i <> s + 1), s, who
  FROM (SELECT turn, free, p.k AS who, list_filter(p.pref, lambda x: free[x + 1])[1] AS s
        FROM fill JOIN prefs p ON p.k = fill.turn % {len(SHARDS)}
        WHERE turn < {TABLE_SIZE})
), owned AS (SELECT slot, shard FROM fill JOIN names USING (k) WHERE slot IS NOT NULL),
placed AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, concat_ws('|', '-', coalesce(lang, ''), coalesce(source, ''),
         coalesce(n_chars::VARCHAR, '')))), 1, 15))::BIGINT % {TABLE_SIZE} AS slot FROM documents)
SELECT doc_id, slot, shard FROM placed JOIN owned USING (slot)
"""


@query("op1_sharding", _SHARD_SQL)
def op1_sharding(spark, sf_dir):
    """Slot and shard of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return sharding.place(docs, sharding.document_key(docs), SHARDS, TABLE_SIZE).select("doc_id", "slot", "shard")


# ------------------------------------------------------------------ 10: mixing
_MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         coalesce(n_chars::VARCHAR, '') AS tag FROM documents
), h AS (
  SELECT *, ('0x' || substr(md5(concat_ws('|', 'mix', coalesce(doc_id::VARCHAR, '-'), size::VARCHAR, tag)), 1, 15))::BIGINT AS h FROM d
), p AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY h % 1024, h, doc_id NULLS FIRST, size, tag
                            ROWS UNBOUNDED PRECEDING) - size AS start FROM h
), s AS (
  SELECT source, sum(size) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
         source_size::DOUBLE * 2 AS cap, row_number() OVER (ORDER BY source NULLS LAST) AS n,
         sum(source_size) OVER () * 1.5::DOUBLE AS total FROM s
), l AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w
), t AS (
  SELECT source, source_size, least(cap, max(level) OVER () * weight) AS target FROM l
), need AS (SELECT source, ceil(round(target) / 256)::BIGINT AS need FROM t
), sums AS (
  SELECT *, (sum(need) OVER (ORDER BY source NULLS LAST))::BIGINT AS upto, (sum(need) OVER ())::BIGINT AS every FROM need
), span AS (
  SELECT source, need, every, floor((upto - need) * (2147483648::DOUBLE / every))::BIGINT AS lo,
         floor(upto * (2147483648::DOUBLE / every))::BIGINT AS hi FROM sums
), drawn AS (
  SELECT slot, source, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS r
  FROM (SELECT unnest(range((SELECT coalesce(max(every), 0) FROM span))) AS slot) x
  JOIN span ON slot % 2147483648 * 1327217885 % 2147483648 >= lo AND slot % 2147483648 * 1327217885 % 2147483648 < hi
), got AS (SELECT source, count(*) AS got FROM drawn GROUP BY source),
schedule AS (
  SELECT slot, source, r FROM drawn
  UNION ALL
  SELECT every + r, source, r FROM (SELECT span.source, every, unnest(range(coalesce(got, 0), need)) AS r
                                    FROM span LEFT JOIN got ON span.source IS NOT DISTINCT FROM got.source)
), took AS (
  SELECT doc_id, size, p.source, start, source_size::BIGINT AS source_size, target,
         (greatest(0, least(start + size, round(target)) - start)
          + greatest(0, least(source_size + start + size, round(target)) - source_size - start))::BIGINT AS taken
  FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, taken, CASE WHEN taken > 0 THEN slot END AS first_slot
FROM took LEFT JOIN schedule ON took.source IS NOT DISTINCT FROM schedule.source AND r = (start // 256)::BIGINT
"""


@query("op10_mixing", _MIX_SQL)
def op10_mixing(spark, sf_dir):
    """Words that the mix takes of every document, against its source's target, and the slot that first reads it."""
    return mixing.taken(mixing.thin_documents(table(spark, sf_dir, "documents")), block=256)


# ------------------------------------------------------------------ 9: exact top-k
_TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op9_topk", _TOPK_SQL)
def op9_topk(spark, sf_dir):
    """The 5 best partners of every 50th vector among all vectors."""
    return topk.top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0, k=5)


# ------------------------------------------------------------------ 8: language identification
@query("op8_language")
def op8_language(spark, sf_dir):
    """Predicted language of every document; learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = id_crc(F.col("doc_id")) % 4 == 2
    model = language.fit(docs.where(~held))
    return (language.predict(docs.select("doc_id", held.alias("held_out"), "text"), model)
            .select("doc_id", "held_out", "lang_pred", "score"))


# ------------------------------------------------------------------ 6: quality
@query("op6_quality")
def op6_quality(spark, sf_dir):
    """Quality score of every document; learned from the labels of three quarters of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = id_crc(F.col("doc_id")) % 4 == 2
    return (quality.classify(docs, table(spark, sf_dir, "labels"), ~held, "quality", threshold=0.7)
            .select("doc_id", (~F.col("learnt_from")).alias("held_out"), "score", "predicted"))


# ------------------------------------------------------------------ 5: toxicity
@query("op5_toxicity")
def op5_toxicity(spark, sf_dir):
    """Toxicity score of every document; learned from the labels of four fifths of them."""
    def may_learn(c):
        return id_crc(F.col(c)) % 5 != 0
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.classify(docs, table(spark, sf_dir, "labels"), may_learn, "toxic")
    return out.select("doc_id", (~may_learn("doc_id")).alias("held_out"), "score", "predicted")


# ------------------------------------------------------------------ 3: benchmark decontamination
@query("op3_decontamination")
def op3_decontamination(spark, sf_dir):
    """Documents in which a benchmark item occurs with at most a tenth of its characters edited."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.find(docs, table(spark, sf_dir, "benchmark"), rate=0.1)


# ------------------------------------------------------------------ 4: licences
@query("op4_licenses")
def op4_licenses(spark, sf_dir):
    """Licence family of every document: its best confirmed notice, else ``none``.

    Any licence goes before a mere reservation of rights, which licence headers hold too.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan(docs)
    sure = F.filter("notices", lambda n: n["confirmed"])
    best = F.array_max(F.transform(sure, lambda n: F.struct(n["family"] != "proprietary", n["similarity"], n["score"],
                                                         n["family"].alias("family"))))
    return found.select("doc_id", F.coalesce(best["family"], F.lit("none")).alias("family"),
                        F.coalesce(best["score"], F.lit(0.0)).alias("score"),
                        F.size("notices").alias("n_notices"), F.size(sure).alias("n_confirmed"))


# ------------------------------------------------------------------ 7: n-gram Jaccard join
@query("op7_neardup")
def op7_neardup(spark, sf_dir):
    """Near-copy class and number of links of every document (five-word shingles, Jaccard >= 0.8)."""
    return neardup.join_counts(table(spark, sf_dir, "documents").select("doc_id", "text"))


# ------------------------------------------------------------------ 2: language-model scores
@query("op2_lm_score")
def op2_lm_score(spark, sf_dir):
    """Context-mixing log10 probability of every document; learned from six sevenths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm.score(docs, id_crc(F.col("doc_id")) % 7 != 2)


# ------------------------------------------------------------------ 11: best-fit packing
@query("op11_packing")
def op11_packing(spark, sf_dir):
    """Place of every piece of every document in sequences of at most 1024 tokens."""
    import public_tokenizers
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = packing.sequences(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=1024, end=2)
    return placed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


# ------------------------------------------------------------------ 12: phrase collocations
_PHRASE_SQL = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
t AS (SELECT lang, sum(len(ws))::HUGEINT AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, m AS len, unnest(list_transform(range(1, (len(ws) - m + 2)::BIGINT),
         lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase FROM w, range(1, 6) r(m) WHERE len(ws) >= m
), f AS (SELECT lang, len, phrase, count(*)::HUGEINT AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE len > 1),
cut AS (
  SELECT c.lang, c.phrase, c.len, c.a, t.n, k, l.a AS l, r.a AS r, 1000 * c.a * t.n // (l.a * r.a) AS score
  FROM c JOIN t ON t.lang = c.lang JOIN range(1, 5) x(k) ON k < c.len
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[k + 1:], ' ')
), s AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_parts AS (
  SELECT lang, a, unnest(list_transform(range(1, (len - m + 2)::BIGINT), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase
  FROM c, range(2, 5) r(m) WHERE m < len
), kept AS (
  SELECT s.* FROM s WHERE NOT EXISTS (SELECT 1 FROM inner_parts i WHERE i.lang = s.lang AND i.phrase = s.phrase AND 100 * i.a >= 100 * s.a)
), o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::INT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM o WHERE rank <= 2000
"""


@query("op12_collocations", _PHRASE_SQL)
def op12_collocations(spark, sf_dir):
    """Each language's 2,000 strongest phrases of two to five words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return collocations.collocations(docs, support=100, longest=5, top=2000)


# ------------------------------------------------------------------ 13: hard negatives
_NEGATIVE_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""


@query("op13_negatives", _NEGATIVE_SQL)
def op13_negatives(spark, sf_dir):
    """Hard negatives of every 100th vector; every seventh row's label is moved on by one."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows, F.col("vec_id") % 100 == 0, label, positives=5, negatives=5, low=80, high=100)
