"""Mixing sources to target weights by a low-discrepancy schedule (DataFrame functions only).

* Each source is one long stream of words: its documents in shuffled (hashed)
  order, cut into blocks of ``block`` words, read at most ``max_epochs`` times.
* Slot ``i`` of the mix has the point ``i * A mod 2^31`` (A = 2^31 / golden ratio).
  The point's place among the cumulative target shares names the slot's source.
* The r-th slot of a source takes the r-th block of its stream.  Sources that got
  too few points have their last blocks appended, so each source reaches its target.

No step sends a whole source through one task: positions within a source and
ranks of slots are both counted in two levels (within a hash bucket or a chunk of
slots, plus the offset of that bucket or chunk).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import WORD, cut, digest60, n_words

#: The points live in [0, 2^31); the multiplier is 2^31 / golden ratio, made odd.
POINTS = 2_147_483_648
GOLDEN = 1_327_217_885
#: The point axis is cut into cells, so that finding a point's source is an equi-join.
CELL = POINTS // 4096


def source_targets(sources: DataFrame, cycle: tuple[int, ...] = (5, 2, 1), share: float = 1.5,
                   max_epochs: int = 2) -> DataFrame:
    """(source, source_size) -> also weight and target.

    Sources in code point order (NULL last) weigh ``cycle``, repeating.  They share
    ``share`` times all words by weight; no target exceeds ``max_epochs`` times its
    source, and what a full source cannot take goes to the others by weight.  The
    level L with sum(least(cap, L * weight)) = total is the largest of the levels
    that arise when the sources fill up in order of cap / weight.
    One row per source passes through the windows without a key.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cyc = F.array(*[F.lit(int(w)) for w in cycle])
    w = (sources.withColumn("__n", F.row_number().over(by_name))
         .withColumn("weight", F.element_at(cyc, ((F.col("__n") - 1) % len(cycle) + 1).cast("int")).cast("double"))
         .withColumn("__cap", F.col("source_size").cast("double") * max_epochs))
    fill = Window.orderBy(F.col("__cap") / F.col("weight"), F.col("__n"))
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(1))
    return (w.withColumn("__total", F.sum("source_size").over(every) * F.lit(float(share)))
            .withColumn("__level", (F.col("__total") - F.coalesce(F.sum("__cap").over(before), F.lit(0.0)))
                        / F.sum("weight").over(rest))
            .withColumn("__level", F.max("__level").over(every))
            .withColumn("target", F.least("__cap", F.col("__level") * F.col("weight")))
            .select("source", "source_size", "weight", "target"))


def positions(docs: DataFrame, cycle: tuple[int, ...], share: float, max_epochs: int, seed: str,
              buckets: int = 1024) -> tuple[DataFrame, DataFrame]:
    """(documents with their place in the shuffled stream and their source's target, targets).

    ``docs``: source, doc_id, size, tag (any text that tells rows apart).  Adds
    ``start``, the words before the document in its source.  Cuts lineage once.
    Documents meet their source's figures by (source, bucket), never by source alone.
    """
    key = F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")),
                      F.col("size").cast("string"), F.coalesce(F.col("tag"), F.lit("")))
    thin = cut(docs.select("source", "doc_id", "size", "tag", digest60(key).alias("h"))
               .withColumn("b", F.pmod(F.col("h"), F.lit(buckets))))
    per_bucket = thin.groupBy("source", "b").agg(F.sum("size").alias("bucket_size"))
    w = Window.partitionBy("source").orderBy("b")
    offsets = (per_bucket
               .withColumn("offset", F.sum("bucket_size").over(w) - F.col("bucket_size"))
               .withColumn("source_size", F.sum("bucket_size").over(Window.partitionBy("source"))))
    targets = source_targets(per_bucket.groupBy("source").agg(F.sum("bucket_size").alias("source_size")),
                             cycle, share, max_epochs)
    t = targets.select(F.col("source").alias("__source"), "target")
    offsets = offsets.join(t, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    within = Window.partitionBy("source", "b").orderBy("h", "doc_id", "size", "tag")
    placed = (thin.withColumn("__in", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0))
                              - F.col("size")).alias("d")
              .join(offsets.alias("o"), F.col("d.source").eqNullSafe(F.col("o.source")) & (F.col("d.b") == F.col("o.b")))
              .select("d.source", "d.doc_id", "d.size", "d.tag", (F.col("__in") + F.col("offset")).alias("start"),
                      "source_size", "target"))
    return placed, targets


def slots(targets: DataFrame, block: int, chunk: int = 65536) -> DataFrame:
    """(slot, source, r): the schedule.  r is the slot's rank within its source, from 0.

    Cuts the lineage of ``targets``' small result: one row per source.
    """
    spark = targets.sparkSession
    t = (targets.withColumn("__t", F.round("target").cast("long"))
         .withColumn("need", F.ceil(F.col("__t") / F.lit(block)).cast("long")))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    t = cut(t.withColumn("__hi", F.sum("need").over(order))
            .withColumn("__all", F.sum("need").over(Window.partitionBy(F.lit(1))))
            .withColumn("lo", F.floor((F.col("__hi") - F.col("need")) * (F.lit(float(POINTS)) / F.col("__all"))).cast("long"))
            .withColumn("hi", F.floor(F.col("__hi") * (F.lit(float(POINTS)) / F.col("__all"))).cast("long"))
            .select("source", "need", "lo", "hi", "__all"))
    total = t.agg(F.coalesce(F.max("__all"), F.lit(0)).alias("n")).first()["n"]
    cells = (t.where("hi > lo").withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("lo") / CELL).cast("long"), F.floor((F.col("hi") - 1) / CELL).cast("long"))))
        .select("cell", "source", "lo", "hi"))
    drawn = (spark.range(total).select(
        F.col("id").alias("slot"), ((F.col("id") % POINTS) * F.lit(GOLDEN) % POINTS).alias("u"))
        .withColumn("cell", F.floor(F.col("u") / CELL).cast("long"))
        .join(cells, "cell").where("u >= lo and u < hi")
        .select("slot", "source", F.floor(F.col("slot") / chunk).cast("long").alias("chunk")))
    per_chunk = drawn.groupBy("source", "chunk").agg(F.count("*").alias("n"))
    ahead = per_chunk.withColumn("ahead", F.sum("n").over(Window.partitionBy("source").orderBy("chunk")) - F.col("n"))
    ranked = (drawn.withColumn("k", F.row_number().over(Window.partitionBy("source", "chunk").orderBy("slot")) - 1).alias("s")
              .join(ahead.alias("a"), F.col("s.source").eqNullSafe(F.col("a.source")) & (F.col("s.chunk") == F.col("a.chunk")))
              .select("s.slot", "s.source", (F.col("k") + F.col("ahead")).alias("r")))
    got = per_chunk.groupBy("source").agg(F.sum("n").alias("got"))
    missing = (t.alias("t").join(got.alias("g"), F.col("t.source").eqNullSafe(F.col("g.source")), "left")
               .select("t.source", "need", F.coalesce("got", F.lit(0)).alias("got")).where("got < need")
               .select("source", F.explode(F.sequence(F.col("got"), F.col("need") - 1)).alias("r"))
               .select((F.lit(total) + F.col("r")).alias("slot"), "source", "r"))
    return ranked.unionByName(missing)


def mix(docs: DataFrame, block: int = 256, cycle: tuple[int, ...] = (5, 2, 1), share: float = 1.5,
        max_epochs: int = 2, seed: str = "mix") -> tuple[DataFrame, DataFrame]:
    """The mix of ``docs`` (source, doc_id, size, tag): (pieces, documents).

    ``pieces``: one row per run of words that a slot takes from a document: slot,
    source, r, epoch, doc_id, tag, start, first (word within the document), words.
    ``documents``: every row of ``docs`` once: doc_id, size, source, tag,
    source_size, target, start.  A document without words has no piece.  Sources
    may be NULL (a source of its own); ids and rows may repeat.  An empty table
    gives two empty ones.  A document is taken at most ``max_epochs`` times.
    """
    d, targets = positions(docs, cycle, share, max_epochs, seed)
    schedule = slots(targets, block)
    a = F.col("epoch") * F.col("source_size") + F.col("start")
    runs = (d.where("size > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))))
            .withColumn("a", a).withColumn("z", F.least(a + F.col("size"), F.round("target").cast("long")))
            .where("z > a")
            .withColumn("r", F.explode(F.sequence(F.floor(F.col("a") / block).cast("long"),
                                                  F.floor((F.col("z") - 1) / block).cast("long"))))
            .withColumn("p", F.greatest("a", F.col("r") * block))
            .withColumn("words", F.least("z", (F.col("r") + 1) * block) - F.col("p")))
    pieces = (runs.alias("p").join(schedule.alias("s"), F.col("p.source").eqNullSafe(F.col("s.source"))
                                   & (F.col("p.r") == F.col("s.r")))
              .select("s.slot", "p.source", "p.r", "p.epoch", "p.doc_id", "p.tag", "p.start",
                      (F.col("p.p") - F.col("p.a")).alias("first"), "p.words", "p.size", "p.source_size", "p.target"))
    return pieces, d


def taken(docs: DataFrame, **params) -> DataFrame:
    """doc_id, size, source_size, target, taken, first_slot: what the mix takes of every row of ``docs``, and
    the slot in which it is first read (NULL if never).

    A document with words is told apart by its place in its source; one row of
    zero words per document keeps those that the mix leaves out.
    """
    pieces, every = mix(docs, **params)
    got = pieces.select("source", "start", "doc_id", "size", "source_size", "target", "words", "slot")
    unread = F.lit(None).cast("long")
    none = every.where("size > 0").select("source", "start", "doc_id", "size", "source_size", "target",
                                          F.lit(0).cast("long").alias("words"), unread.alias("slot"))
    summed = (got.unionByName(none).groupBy("source", "start", "doc_id", "size", "source_size", "target")
              .agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot")))
    cols = ["doc_id", "size", "source_size", "target", "taken", "first_slot"]
    return summed.select(*cols).unionByName(
        every.where("size = 0").withColumn("taken", F.lit(0).cast("long")).withColumn("first_slot", unread).select(*cols))


def thin_documents(docs: DataFrame, tag: Column | None = None) -> DataFrame:
    """The columns that the schedule needs: source, doc_id, size in words, tag."""
    short = F.coalesce(docs["n_chars"].cast("string"), F.lit("")) if "n_chars" in docs.columns else F.lit("")
    return docs.select(docs["source"].alias("source"), docs["doc_id"].alias("doc_id"),
                       n_words(docs["text"]).alias("size"), (short if tag is None else tag).alias("tag"))


def apply(docs: DataFrame, **params) -> DataFrame:
    """``docs`` as the mix reads them: a row for each reading of a document, columns unchanged, in slot order.

    The order is that of each reading's first slot (a range sort), so any stretch of the
    result holds the sources in about their shares.
    Needs columns doc_id, text and source.  A document that lies across its source's
    end is cut to the words taken (joined by single blanks), with n_chars set anew.
    Rows that agree in doc_id, source and text share their readings evenly.
    Documents without words are not read.
    """
    tag = F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary"))
    pieces, every = mix(thin_documents(docs, tag), **params)
    per_row = pieces.groupBy("source", "doc_id", "tag", "start", "epoch", "size").agg(
        F.sum("words").alias("words"), F.min("slot").alias("slot"))
    copies = every.groupBy("source", "doc_id", "tag").agg(F.count("*").alias("rows"))
    same = (F.col("p.source").eqNullSafe(F.col("c.source")) & F.col("p.doc_id").eqNullSafe(F.col("c.doc_id"))
            & (F.col("p.tag") == F.col("c.tag")))
    read = (per_row.groupBy("source", "doc_id", "tag", "epoch", "size")
            .agg(F.sum("words").alias("words"), F.min("slot").alias("slot")).alias("p")
            .join(copies.alias("c"), same)
            .select(F.col("p.source").alias("__source"), F.col("p.doc_id").alias("__id"), F.col("p.tag").alias("__tag"),
                    F.col("size").alias("__size"), F.ceil(F.col("words") / F.col("rows")).alias("__words"), F.col("slot").alias("__slot"),
                    F.col("epoch").alias("__epoch")))
    d = docs.withColumn("__t", tag)
    read = cut(read)  # the sort below looks at its input twice
    out = d.join(read, d["source"].eqNullSafe(F.col("__source")) & d["doc_id"].eqNullSafe(F.col("__id"))
                 & (F.col("__t") == F.col("__tag")))
    part = F.col("__words") < F.col("__size")
    short = F.array_join(F.slice(F.regexp_extract_all(d["text"], F.lit(WORD), F.lit(0)), 1, F.col("__words").cast("int")), " ")
    out = out.withColumn("text", F.when(part, short).otherwise(d["text"]))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(part, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.orderBy("__slot", "__id", "__epoch").select(*[F.col(f"`{c}`") for c in docs.columns])
