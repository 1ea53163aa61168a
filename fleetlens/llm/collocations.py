"""Phrase collocations by dynamic itemset counting.

The texts are dealt into shards, which are scanned in turn, round and round.  All
lengths are counted in the same scans: words from the first scan on, and a longer
phrase from the scan after the one in which both its subphrases (without the last
and without the first word) reached the threshold.  A phrase is counted for one
full cycle of the shards, whichever it began with, so each of its occurrences counts
once; after that it is either frequent or forgotten.  Scans go on until nothing is
under way.

What is under way need not be listed: a task counts a phrase of its shard if both
subphrases are among those that have reached the threshold and one of them did so
within the last cycle.  It asks two bit tables (Bloom filters of a bounded size);
what they let through by mistake is dropped by an exact join of the scan's counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import shared_folder, tidy

#: Ends of a piece, as RE2 and Java write them.
ENDS = r"[.,;:!?\x0A-\x0D]+"
#: Characters that a task looks at together, and of which a stored row holds about as many at most.
CHUNK = 16_000_000
#: Bits of a table for each phrase that can be frequent, and of the largest table (16 MB).
BITS_EACH, MOST_BITS = 16, 27
#: The frequent phrases are broadcast up to this many bytes, else joined by shuffle.
SMALL = 8_000_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------------ texts
def _slices(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > CHUNK:
        end = text.find("\n", at + CHUNK // 2)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:]


def _plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, shard, words, text): lower-cased; one blank between words, and a line feed as a word where pieces end."""
    for b in batches:
        t = pc.ascii_lower(pc.fill_null(b.column(2), ""))
        t = pc.replace_substring_regex(pc.replace_substring_regex(t, ENDS, " \n "), r"[ \t]+", " ")
        long = pc.greater(pc.binary_length(t), CHUNK)
        rows = [(k, s) for k in np.flatnonzero(long.to_numpy(zero_copy_only=False)) for s in _slices(t[int(k)].as_py())]
        short = np.flatnonzero(~long.to_numpy(zero_copy_only=False))
        at = np.concatenate([short, [k for k, _ in rows]]).astype(np.int64)
        t = pc.utf8_trim(pa.concat_arrays([t.take(pa.array(short)), pa.array([s for _, s in rows], t.type)]), " ")
        n = pc.subtract(pc.add(pc.count_substring(t, " "), 1), pc.count_substring(t, "\n"))
        some = pc.not_equal(t, "")
        t = pc.binary_join_element_wise(t, pa.scalar("\n", t.type), pa.scalar(" ", t.type))
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)), n.cast(pa.int64()), t.cast(pa.string())],
            names=["lang", "shard", "words", "text"]).filter(some)


# ------------------------------------------------------------------ hashes and bit tables
def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def word_hashes(lang: str, words: np.ndarray) -> np.ndarray:
    own = pd.util.hash_array(np.array([lang], object), categorize=False)
    return _mix(pd.util.hash_array(words, categorize=False) ^ own)


def _places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    z = _mix(h)
    return z >> np.uint64(64 - bits), _mix(z + _STEP) >> np.uint64(64 - bits)


def _holds(table: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    a, b = _places(h, bits)
    one, low = np.uint64(1), np.uint64(63)
    return ((table[a >> np.uint64(6)] >> (a & low)) & (table[b >> np.uint64(6)] >> (b & low)) & one).astype(bool)


def _marks(bits: int):
    """(lang, phrase) rows to the (slot, ones) of their bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.to_pandas()
            for lang, phrases in x.groupby("lang")["phrase"]:
                words = phrases.str.split(" ")
                size = words.str.len().to_numpy()
                h = word_hashes(lang, np.array([w for ws in words for w in ws], object))
                first = np.cumsum(size) - size
                own = h[first]
                for k in range(1, size.max()):
                    more = size > k
                    own[more] = own[more] * _STEP + h[first[more] + k]
                at = np.unique(np.concatenate(_places(own, bits)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array((at >> np.uint64(6)).astype(np.int64)),
                     pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], names=["slot", "ones"])
    return run


def _bit_table(phrases: DataFrame, bits: int) -> np.ndarray:
    """Bit table of (lang, phrase); at most 2^bits / 64 rows reach the driver."""
    rows = (phrases.mapInArrow(_marks(bits), "slot long, ones long").groupBy("slot")
            .agg(F.bit_or("ones").alias("ones")).toArrow())
    table = np.zeros(max(1, 1 << (bits - 6)), np.uint64)
    table[rows.column("slot").to_numpy()] = rows.column("ones").to_numpy().view(np.uint64)
    return table


# ------------------------------------------------------------------ one scan
def count_chunk(lang: str, texts: pa.Array, longest: int, words_too: bool, reached: np.ndarray, recent: np.ndarray,
                bits: int) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(length, phrases, counts) of what is under way in ``texts``."""
    enc = pc.split_pattern(texts, " ").flatten().dictionary_encode()
    x, words = enc.indices.to_numpy(), enc.dictionary
    end = pc.equal(words, "\n").to_numpy(zero_copy_only=False)
    if words_too:
        keep = np.flatnonzero(~end)
        yield 1, words.take(pa.array(keep)), np.bincount(x, minlength=len(words))[keep]
    own = word_hashes(lang, words.to_numpy(zero_copy_only=False))
    full, late = _holds(reached, own, bits) & ~end, _holds(recent, own, bits) & ~end
    f, r, h = full[x], late[x], own[x]
    for n in range(2, longest + 1):
        if len(f) < 2:
            return
        both = f[:-1] & f[1:]
        at = np.flatnonzero(both & (r[:-1] | r[1:]))
        if len(at):
            key = x[at].astype(np.int64)
            for k in range(1, n - 1):
                key = np.unique(key << 32 | x[at + k], return_inverse=True)[1]
            _, first, count = np.unique(key << 32 | x[at + n - 1], return_index=True, return_counts=True)
            first = at[first]
            yield n, pc.binary_join_element_wise(*[words.take(pa.array(x[first + k])) for k in range(n)], " "), count
        if n < longest:
            h = h[:-1] * _STEP + own[x[n - 1:]]
            known = np.flatnonzero(both)
            f, r = np.zeros(len(both), bool), np.zeros(len(both), bool)
            f[known] = _holds(reached, h[known], bits)
            r[known] = f[known] & _holds(recent, h[known], bits)


def _scan(longest: int, words_too: bool, tables, bits: int):
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("len", pa.int32()), ("a", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached, recent = tables.value
        held: dict[str, list] = {}
        size: dict[str, int] = {}

        def done(lang):
            size.pop(lang)
            for n, phrases, count in count_chunk(lang, pa.concat_arrays(held.pop(lang)), longest, words_too, reached, recent, bits):
                for k in range(0, len(phrases), 200_000):
                    p = phrases.slice(k, 200_000)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(p)), p.cast(pa.string()), pa.array([n] * len(p), pa.int32()),
                                                      pa.array(count[k:k + 200_000])], schema=schema)
        for b in batches:
            langs = b.column(0).dictionary_encode()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                t = b.column(1).filter(pc.equal(langs.indices, k))
                upto = np.cumsum(pc.binary_length(t).to_numpy(zero_copy_only=False).astype(np.int64))
                a = 0
                while a < len(t):
                    before = int(upto[a - 1]) if a else 0
                    z = max(a + 1, int(np.searchsorted(upto, before + CHUNK - size.get(lang, 0), side="right")))
                    held.setdefault(lang, []).append(t.slice(a, z - a))
                    size[lang] = size.get(lang, 0) + int(upto[z - 1]) - before
                    if size[lang] >= CHUNK // 2 and (z < len(t) or size[lang] >= CHUNK):
                        yield from done(lang)
                    a = z
            while sum(size.values()) > 2 * CHUNK:  # many languages at once
                yield from done(max(size, key=size.get))
        for lang in list(held):
            yield from done(lang)
    return run


def _near(df: DataFrame, n_bytes: int) -> DataFrame:
    return F.broadcast(df) if n_bytes <= SMALL else df


def frequent(docs: DataFrame, support: int, longest: int = 5, shards: int = 3, text: str = "text",
             lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): lang, phrase, len int, a long of every phrase of 1 to ``longest`` words that occurs
    ``support`` times at least; and lang, n long (all word occurrences) of every language that has a word.

    Words are runs of anything but blanks and tabs, A-Z lower-cased; phrases stay within
    pieces, which end at ``.,;:!?`` and line ends.  Occurrences count with overlaps,
    repeated rows each.  A NULL text is empty, a NULL language ``und``.
    """
    spark: SparkSession = docs.sparkSession
    home = f"{shared_folder(spark).rstrip('/')}/phrases-{uuid.uuid4().hex}"
    shard = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]), F.lit(shards)).cast("int")
    (docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), shard.alias("shard"),
                 F.col(text).cast("string").alias("text"))
     .mapInArrow(tidy(_plain), "lang string, shard int, words long, text string")
     .write.partitionBy("shard").parquet(f"{home}/texts"))
    texts = spark.read.schema("lang string, words long, text string, shard int").parquet(f"{home}/texts")
    totals = texts.groupBy("lang").agg(F.sum("words").alias("n"))
    total = texts.agg(F.sum("words")).first()[0] or 0
    bits = min(MOST_BITS, max(10, (BITS_EACH * total // max(1, support)).bit_length()))

    state_schema = "lang string, phrase string, len int, start int, reach int, a long"
    state = spark.createDataFrame([], state_schema)
    fresh = [np.zeros(1 << (bits - 6), np.uint64)] * shards  # of the phrases that reached the threshold in each of the last scans
    reached = fresh[0].copy()
    n_bytes, scan, last = 0, 0, 0
    while scan <= last + shards and total:
        tables = spark.sparkContext.broadcast((reached, np.bitwise_or.reduce(fresh)))
        seen = (texts.where(F.col("shard") == scan % shards).select("lang", "text")
                .mapInArrow(tidy(_scan(longest, scan < shards, tables, bits)), "lang string, phrase string, len int, a long")
                .groupBy("lang", "phrase", "len").agg(F.sum("a").alias("a")))  # narrow rows, before they meet the state
        done = state.withColumn("whole", F.when(F.col("start") + shards <= scan, F.col("a")))
        both = (done.unionByName(seen, allowMissingColumns=True)
                .groupBy("lang", "phrase", "len")
                .agg(F.max("start").alias("start"), F.max("reach").alias("reach"), F.sum("a").alias("a"), F.max("whole").alias("whole"))
                .withColumn("a", F.coalesce("whole", "a")).drop("whole"))
        known = state.where("reach is not null").select("lang", F.col("phrase").alias("part"), F.col("reach").alias("at"))
        for side, words in (("p1", "len - 1"), ("p2", "1 - len")):  # without the last, without the first word
            part = F.expr(f"substring_index(phrase, ' ', {words})")
            both = (both.withColumn("part", F.when(F.col("start").isNull() & (F.col("len") > 1), part).otherwise(F.col("phrase")))
                    .join(_near(known, n_bytes), ["lang", "part"], "left").drop("part").withColumnRenamed("at", side))
        start = F.when(F.col("len") == 1, 0).when(F.col("p1").isNotNull() & F.col("p2").isNotNull(), F.greatest("p1", "p2") + 1)
        both = (both.withColumn("start", F.coalesce("start", start))
                .where(F.col("start").isNotNull() & ((F.col("start") + shards > scan) | F.col("reach").isNotNull()))
                .withColumn("reach", F.coalesce("reach", F.when(F.col("a") >= support, scan)))
                .where((F.col("start") + shards > scan + 1) | F.col("reach").isNotNull()))
        both.select("lang", "phrase", "len", "start", "reach", "a").write.parquet(f"{home}/scan-{scan}")
        tables.destroy()
        state = spark.read.schema(state_schema).parquet(f"{home}/scan-{scan}")
        new = state.where(F.col("reach") == scan)
        got = new.agg(F.sum((F.col("len") < longest).cast("int")), F.sum(F.octet_length("phrase") + F.octet_length("lang") + 16)).first()
        n_bytes += got[1] or 0
        if got[0]:
            last = scan
        fresh = [*fresh[1:], _bit_table(new.select("lang", "phrase"), bits) if got[0] else np.zeros_like(reached)]
        reached = reached | fresh[-1]
        scan += 1
    return state.where("reach is not null").select("lang", "phrase", "len", "a"), totals


# ------------------------------------------------------------------ scores
def _parts(phrase: str, n: str, least: int) -> Column:
    """All contiguous parts of ``least`` words at least that are shorter than the phrase."""
    w = F.split(phrase, " ")
    spans = F.flatten(F.transform(F.sequence(F.lit(least), F.col(n) - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col(n) - m + 1), lambda i: F.array_join(F.slice(w, i, m), " "))))
    return F.array_distinct(spans)


def score(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, len, a, l, r, n, score of the phrases of two words or more: the lowest score of all cuts.

    Cutting after k words gives l and r, the counts of both parts, and the score
    floor(1000 * a * n / (l * r)), in decimals of 38 digits; ties go to the smallest k.
    """
    f = phrases.select(F.col("lang").alias("of"), F.col("phrase").alias("part"), F.col("a").alias("f"))
    cuts = (phrases.where("len > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("len") - 1)))
            .withColumn("left", F.expr("substring_index(phrase, ' ', k)"))
            .withColumn("right", F.expr("substring_index(phrase, ' ', k - len)")))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = (cuts.join(f, (F.col("lang") == F.col("of")) & (F.col(side) == F.col("part"))).drop("of", "part")
                .withColumnRenamed("f", name))
    cuts = cuts.join(totals, "lang")
    exact = F.expr("(cast(a * 1000 as decimal(19,0)) * cast(n as decimal(19,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    return (cuts.withColumn("score", exact).groupBy("lang", "phrase", "len", "a", "n")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
            .select("lang", "phrase", "len", "a", "cut.l", "cut.r", "n", "cut.score"))


def collocations(docs: DataFrame, support: int = 100, longest: int = 5, top: int = 2000, cover: int = 100, shards: int = 3,
                 text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score: each language's ``top`` phrases of 2 to ``longest`` words.

    Phrases that occur ``support`` times at least, scored as ``score`` says; left out are
    those within a longer one that has ``cover`` percent of their occurrences at least.
    Order: score, then a, both descending, then the phrase by its UTF-8 bytes.  An empty
    table, or one without a frequent phrase, gives an empty result.
    """
    phrases, totals = frequent(docs, support, longest, shards, text, lang)
    within = (phrases.where("len > 2").select("lang", "a", F.explode(_parts("phrase", "len", 2)).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = (phrases.join(within, ["lang", "phrase"], "left")
            .where((F.col("len") > 1) & ~F.coalesce(F.col("longer") * 100 >= F.col("a") * cover, F.lit(False))))
    scored = score(phrases, totals).join(kept.select("lang", "phrase"), ["lang", "phrase"], "left_semi")
    order = (F.col("score").desc(), F.col("a").desc(), "phrase")
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(32)))
    best = (salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
            .where(F.col("rank") <= top))  # at most 32 * top rows of a language are ranked together
    return (best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
            .where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
