"""N-gram Jaccard join: MinHash banding with exact verification.

1. Every text becomes its set of five-word shingles; texts with equal sets are one
   *text* with copies.  A text's signature gives one label a tree: the hash of the first
   ``depth`` values of the tree's own run of min-hashes.  Texts meet by equal labels;
   this is banding, no prefix trees are kept and shorter prefixes are not matched.
2. ``depth`` is the greatest up to ``max_depth`` at which two texts of the threshold
   similarity share a label with the target probability; it does not depend on the data.
3. Texts that share a label are compared by signature; from each group only a
   spanning forest of its likely links is kept, never its pairs.  The components
   of these forests are *cells*; a link never leaves its cell.
4. Within a cell every pair is verified on its whole shingle sets, block by block.
   Tasks return counts per text and a spanning forest of verified links.

A group of any size is cut into blocks that meet pairwise, so no task holds a whole
group and no pair becomes a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.llm.common import cut, map_pandas, tidy
from fleetlens.llm.components import components
from fleetlens.llm.texts import runs

GRAM = 5
TREES = 24
MAX_DEPTH = 8
#: Signatures must agree in this share of their values to be verified: at a similarity of
#: 0.8, 120 values agree in 0.8 +- 0.037, so five deviations lie between.
LIKELY = 0.62
BLOOM_BITS = 1 << 25


def matched_depth(threshold: float, target: float, trees: int = TREES, max_depth: int = MAX_DEPTH) -> int:
    """Longest prefix at which two texts of ``threshold`` similarity share a tree with probability ``target``."""
    for depth in range(max_depth, 0, -1):
        if 1 - (1 - threshold ** depth) ** trees >= target:
            return depth
    raise ValueError("the forest has too few trees for this recall")


class _Words(dict):
    """Word -> 64-bit hash, kept up to a bound."""

    def __missing__(self, w: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        v = self[w] = xxhash.xxh64_intdigest(w)
        return v


_M = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def shingles(texts: list[str], words: _Words, gram: int = GRAM) -> list[np.ndarray]:
    """Sorted distinct hashed shingles of each text.  Words: ASCII white space parts, A-Z in lower case.

    A text of fewer than ``gram`` words has one shingle, all its words; one without words has none.
    """
    split = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
    out = []
    for w in split:
        h = np.fromiter(map(words.__getitem__, w), np.uint64, len(w))
        n = len(h) - gram + 1
        s = h[:max(1, n)].copy() if len(h) else h
        for j in range(1, min(gram, len(h))):
            s = s * _M + h[j:j + max(1, n)]
        out.append(np.unique(_mix(s + np.uint64(min(len(h), gram)))))
    return out


def text_key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def signatures(sets: list[np.ndarray], values: int) -> np.ndarray:
    """len(sets) x values min-hashes (uint32); every set must have an element."""
    rng = np.random.default_rng(20240131)
    a = (rng.integers(0, 1 << 32, values, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
    b = rng.integers(0, 1 << 32, values, dtype=np.uint64).astype(np.uint32)
    x = np.concatenate(sets)
    x = (x ^ (x >> np.uint64(32))).astype(np.uint32)
    starts = np.r_[0, np.cumsum([len(s) for s in sets])[:-1]]
    out = np.empty((len(sets), values), np.uint32)
    for p in range(values):
        y = x * a[p]
        y += b[p]
        y ^= y >> np.uint32(15)
        y *= np.uint32(0x2C1B3C6D)
        out[:, p] = np.minimum.reduceat(y, starts)
    return out


def _signed(depth: int, trees: int, gram: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _Words()
        for b in batches:
            at = 0
            ids = b["__id"].tolist()
            for part in runs([t if isinstance(t, str) else "" for t in b["__text"]], docs=64):
                sets = shingles(part, words, gram)
                full = [i for i, s in enumerate(sets) if len(s)]
                rows: list[tuple] = [(ids[at + i], None, None, None, 0) for i, s in enumerate(sets) if not len(s)]
                if full:
                    sig = signatures([sets[i] for i in full], depth * trees)
                    label = np.zeros((len(full), trees), np.uint64)
                    for d in range(depth):
                        label = _mix(label * _M + sig[:, d * trees:(d + 1) * trees] + np.uint64(1))
                    label = _mix(label + np.arange(trees, dtype=np.uint64)).astype(np.int64)
                    short = ((sig * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)
                    rows += [(ids[at + i], text_key(sets[i]), label[k].tolist(), short[k].tobytes(), len(sets[i]))
                             for k, i in enumerate(full)]
                at += len(part)
                yield pd.DataFrame(rows, columns=["id", "key", "labels", "sig", "n"])
    return run


def signed(docs: DataFrame, doc_id: str, text: str, depth: int, trees: int = TREES, gram: int = GRAM) -> DataFrame:
    """(id, key, labels, sig, n) of every row; key is NULL where the text has no word."""
    d = docs.select(docs[doc_id].alias("__id"), docs[text].alias("__text"))
    kind = d.schema["__id"].dataType.simpleString()
    return map_pandas(d, _signed(depth, trees, gram), f"id {kind}, key binary, labels array<long>, sig binary, n long")


def grouped(batches: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """Groups of equal ``by`` from batches of a sorted stream."""
    held: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        change = np.zeros(len(b), bool)
        for c in by:
            v = b[c].to_numpy()
            change[1:] |= v[1:] != v[:-1]
        edges = np.flatnonzero(change)
        if held and any(held[-1][c].iloc[-1] != b[c].iloc[0] for c in by):
            yield pd.concat(held) if len(held) > 1 else held[0]
            held = []
        cuts = [0, *edges.tolist(), len(b)]
        for x, y in zip(cuts[:-1], cuts[1:]):
            if y < len(b):
                g = b.iloc[x:y]
                if held:
                    g = pd.concat([*held, g])
                    held = []
                yield g
            else:
                held.append(b.iloc[x:y])
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def in_blocks(members: DataFrame, group: str, blocks: str, key: str) -> DataFrame:
    """Members with (i, j): every pair of the group's ``blocks`` blocks, so that any two members share one (i, j)."""
    own = F.pmod(F.xxhash64(key, F.lit(3)), F.col(blocks)).cast("int")
    return (members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col(blocks) - 1)))
            .withColumn("i", F.least("own", "other").cast("int")).withColumn("j", F.greatest("own", "other").cast("int"))
            .drop("other", blocks))


def _forest(linked) -> list[tuple[int, int]]:
    """Breadth-first spanning forest.  linked(x, rest): positions in ``rest`` that link with member x."""
    n, linked_to = linked
    rest = np.arange(n)
    out, queue = [], []
    while len(rest) or queue:
        if not queue:
            queue, rest = [rest[0]], rest[1:]
        x = queue.pop()
        if len(rest):
            hit = linked_to(x, rest)
            found = rest[hit]
            out += [(x, int(y)) for y in found]
            queue += found.tolist()
            rest = rest[~hit]
    return out


def _likely(least: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a: list[bytes] = []
        b: list[bytes] = []
        for g in grouped(batches, ["label", "i", "j"]):
            if len(g) > 1:
                keys = g["key"].tolist()
                sig = np.frombuffer(b"".join(g["sig"]), np.uint16).reshape(len(keys), -1)
                for x, y in _forest((len(keys), lambda x, rest: (sig[rest] == sig[x]).mean(1) >= least)):
                    a.append(bytes(keys[x]))
                    b.append(bytes(keys[y]))
            if len(a) > 20_000:
                yield pd.DataFrame({"a": a, "b": b})
                a, b = [], []
        yield pd.DataFrame({"a": a, "b": b})
    return run


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left with every right set, in bounded memory."""
    if len(left) * len(right) <= 4:
        return np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in right] for x in left])
    l, r = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(np.unique(l), np.unique(r), assume_unique=True)
    at_l = np.repeat(np.arange(len(left)), [len(x) for x in left])
    at_r = np.repeat(np.arange(len(right)), [len(x) for x in right])
    out = np.zeros((len(left), len(right)), np.float32)
    wide = max(1024, 4_000_000 // max(len(left), len(right)))
    pl, pr = np.searchsorted(shared, l), np.searchsorted(shared, r)
    okl = (pl < len(shared)) & (shared[np.minimum(pl, max(0, len(shared) - 1))] == l) if len(shared) else np.zeros(len(l), bool)
    okr = (pr < len(shared)) & (shared[np.minimum(pr, max(0, len(shared) - 1))] == r) if len(shared) else np.zeros(len(r), bool)
    pl, at_l, pr, at_r = pl[okl], at_l[okl], pr[okr], at_r[okr]
    for k in range(0, len(shared), wide):
        n = min(wide, len(shared) - k)
        a, b = np.zeros((len(left), n), np.float32), np.zeros((len(right), n), np.float32)
        s, t = (pl >= k) & (pl < k + n), (pr >= k) & (pr < k + n)
        a[at_l[s], pl[s] - k] = 1
        b[at_r[t], pr[t] - k] = 1
        out += a @ b.T
    return np.rint(out).astype(np.int64)


def _verified(threshold: float, rows: int = 256):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in grouped(batches, ["cell", "i", "j"]):
            keys, own = g["key"].tolist(), g["own"].to_numpy()
            copies = g["copies"].to_numpy(np.int64)
            sets = [np.frombuffer(s, np.uint64) for s in g["sh"]]
            size = np.array([len(s) for s in sets])
            n, same = len(keys), g["i"].iloc[0] == g["j"].iloc[0]
            adj = np.zeros((n, n), bool) if n <= 4096 else None
            if n < 2 or adj is None and n > 40_000:
                if n > 1:
                    raise ValueError("a block is far above its size")
                continue
            adj = np.zeros((n, n), bool) if adj is None else adj
            for x in range(0, n, rows):
                for y in range(x, n, rows):
                    c = _common(sets[x:x + rows], sets[y:y + rows])
                    either = size[x:x + rows, None] + size[None, y:y + rows] - c
                    adj[x:x + rows, y:y + rows] = c >= threshold * either - 1e-9
            adj |= adj.T
            np.fill_diagonal(adj, False)
            if not same:
                adj &= own[:, None] != own[None, :]
            texts = adj.sum(1)
            some = np.flatnonzero(texts)
            if not len(some):
                continue
            forest = _forest((n, lambda x, rest: adj[x, rest]))
            count = pd.DataFrame({"a": [bytes(keys[k]) for k in some], "b": None, "texts": texts[some],
                                  "docs": (adj[some] @ copies)})
            tree = pd.DataFrame({"a": [bytes(keys[x]) for x, _ in forest], "b": [bytes(keys[y]) for _, y in forest],
                                 "texts": 0, "docs": 0})
            yield pd.concat([count, tree])
    return run


def _bloom_places(key: bytes) -> list[int]:
    x, y = int.from_bytes(key[:8], "little"), int.from_bytes(key[8:], "little") | 1
    return [(x + k * y) % BLOOM_BITS for k in range(4)]


def key_filter(keys: DataFrame) -> bytes:
    """A Bloom filter of fixed size (BLOOM_BITS) over the column ``key``; tasks' filters are merged on Spark."""
    part = 1 << 16

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.zeros(BLOOM_BITS // 8, np.uint8)
        for b in batches:
            for k in b["key"]:
                for p in _bloom_places(bytes(k)):
                    bits[p >> 3] |= 1 << (p & 7)
        some = [(k // part, bits[k:k + part].tobytes()) for k in range(0, len(bits), part) if bits[k:k + part].any()]
        yield pd.DataFrame(some, columns=["part", "bits"])

    def merge(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(part, np.uint8)
        for b in batches:
            for x in b["bits"]:
                total |= np.frombuffer(x, np.uint8)
        yield pd.DataFrame({"part": [key[0]], "bits": [total.tobytes()]})

    rows = (keys.select("key").mapInPandas(fill, "part int, bits binary").groupBy("part")
            .applyInPandas(merge, "part int, bits binary").collect())
    out = bytearray(BLOOM_BITS // 8)
    for r in rows:
        out[r["part"] * part:(r["part"] + 1) * part] = r["bits"]
    return bytes(out)


def _sets_of(shared, gram: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits, words = shared.value, _Words()
        for b in batches:
            for part in runs([t if isinstance(t, str) else "" for t in b["__text"]], docs=64):
                rows = []
                for s in shingles(part, words, gram):
                    if len(s):
                        k = text_key(s)
                        if all(bits[p >> 3] >> (p & 7) & 1 for p in _bloom_places(k)):
                            rows.append((k, s.tobytes()))
                yield pd.DataFrame(rows, columns=["key", "sh"])
    return run


def texts_and_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.8,
                      target: float = 0.9999, group_block: int = 4096, cell_block: int = 1024,
                      block_shingles: int = 4_000_000) -> tuple[DataFrame, DataFrame]:
    """(documents: id, key; texts: key, root, copies, links, linked_docs).

    ``texts`` has every text (distinct shingle set); root is the least key of its
    class, links the number of other texts at ``threshold`` similarity or more, and
    linked_docs the documents with these texts.
    """
    depth = matched_depth(threshold, target)
    s = cut(signed(docs, doc_id, text, depth))
    reps = (s.where("key is not null").groupBy("key")
            .agg(F.count("*").alias("copies"), F.first("labels").alias("labels"), F.first("sig").alias("sig"),
                 F.first("n").alias("n")))
    reps = cut(reps)
    places = reps.select("key", F.explode("labels").alias("label"))
    shared = (places.groupBy("label").agg(F.count("*").alias("m")).where("m > 1")
              .select(F.col("label").alias("l"), F.ceil(F.col("m") / group_block).cast("int").alias("blocks")))
    members = (places.join(shared, F.col("label") == F.col("l")).select("key", "label", "blocks")
               .join(reps.select("key", "sig"), "key"))
    likely = (in_blocks(members, "label", "blocks", "key").repartition("label", "i", "j")
              .sortWithinPartitions("label", "i", "j").select("label", "i", "j", "key", "sig")
              .mapInPandas(tidy(_likely(LIKELY)), "a binary, b binary"))
    cells = components(likely.distinct())
    sized = cells.join(reps.select("key", "copies", "n"), "key")
    blocks = (sized.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / cell_block),
                                                   F.ceil(F.sum("n") / block_shingles)).cast("int").alias("blocks"))
              .withColumnRenamed("root", "cell"))
    bloom = docs.sparkSession.sparkContext.broadcast(key_filter(cells))
    sets = (docs.select(docs[text].alias("__text")).mapInPandas(tidy(_sets_of(bloom, GRAM)), "key binary, sh binary")
            .groupBy("key").agg(F.first("sh").alias("sh")))
    filled = (sized.select("key", F.col("root").alias("cell"), "copies").join(blocks, "cell").join(sets, "key"))
    found = cut(in_blocks(filled, "cell", "blocks", "key").repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
                .select("cell", "i", "j", "own", "key", "copies", "sh")
                .mapInPandas(tidy(_verified(threshold)), "a binary, b binary, texts long, docs long"))
    classes = components(found.where("b is not null").select("a", "b"))
    counts = (found.where("b is null").groupBy("a").agg(F.sum("texts").alias("links"), F.sum("docs").alias("linked_docs"))
              .withColumnRenamed("a", "key"))
    texts = (reps.select("key", "copies").join(classes, "key", "left").join(counts, "key", "left")
             .select("key", F.coalesce("root", "key").alias("root"), "copies",
                     F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("linked_docs", F.lit(0)).alias("linked_docs")))
    return s.select("id", "key"), texts


def join_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """doc_id, class_id, n_links, n_texts of every row of ``docs``.

    n_links: other documents at the threshold similarity or more (copies included);
    n_texts: other distinct texts among them.  class_id: the least doc_id that is
    reached over such links (NULL if none of them has an id).  A NULL text or one
    without words has no link and is a class of its own.  Repeated rows are documents
    each; an empty table gives an empty result.
    """
    rows, texts = texts_and_classes(docs, doc_id, text, **params)
    texts = cut(texts)
    first = (rows.where("key is not null").groupBy("key").agg(F.min("id").alias("least"))
             .join(texts.select("key", "root"), "key").groupBy("root").agg(F.min("least").alias("class_id")))
    info = texts.join(first, "root").select(
        F.col("key").alias("k"), "class_id", (F.col("copies") - 1 + F.col("linked_docs")).alias("n_links"), F.col("links").alias("n_texts"))
    out = rows.where("key is not null").join(info, F.col("key") == F.col("k")).select(
        F.col("id").alias("doc_id"), "class_id", "n_links", "n_texts")
    alone = rows.where("key is null").select(F.col("id").alias("doc_id"), F.col("id").alias("class_id"),
                                             F.lit(0).cast("long").alias("n_links"), F.lit(0).cast("long").alias("n_texts"))
    return out.unionByName(alone)


#: Column of text keys that ``keep_one`` adds for itself.
KEY = "__text_key_of_keep_one"


def _key_column(text: str, gram: int):
    def run(batches):
        words = _Words()
        for b in batches:
            keys: list[bytes | None] = []
            for part in runs([t or "" for t in b.column(text).to_pylist()], docs=64):
                keys += [text_key(s) if len(s) else None for s in shingles(part, words, gram)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, pa.binary())], names=[*b.schema.names, KEY])
    return run


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """``docs`` with one document of each near-copy class: that of the least doc_id (rows without one last).

    All columns stay.  Repeated rows of the kept id and text give one row; documents
    without a word have no class and all stay.
    """
    rows, texts = texts_and_classes(docs, doc_id, text, **params)
    first = (rows.where("key is not null").groupBy("key").agg(F.min("id").alias("least"))
             .join(texts.select("key", "root"), "key").groupBy("root")
             .agg(F.min(F.struct(F.col("least").isNull().alias("none"), "least", "key")).alias("s"))
             .select(F.col("s.least").alias("__kept_id"), F.col("s.key").alias("__kept_key")))
    schema = T.StructType([*docs.schema.fields, T.StructField(KEY, T.BinaryType())])
    keyed = docs.mapInArrow(tidy(_key_column(text, GRAM)), schema)
    some = (keyed.where(f"`{KEY}` is not null")
            .join(first, (F.col(f"`{KEY}`") == F.col("__kept_key")) & F.col(f"`{doc_id}`").eqNullSafe(F.col("__kept_id")), "left_semi")
            .dropDuplicates([KEY, doc_id]))
    return some.unionByName(keyed.where(f"`{KEY}` is null")).drop(KEY)
