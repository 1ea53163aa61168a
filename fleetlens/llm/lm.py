"""Language-model scores by online logistic context mixing.

A text is its lower-case words (ASCII white space apart, A-Z lowered) and one end.
Each token is coded in bits: frequent tokens by their path in a Huffman tree, any
other by the tree's escape leaf and then by its share of the rarer training tokens
(exact counts, met through a join; an unseen token has the share of none).

Every bit is predicted from four contexts: the tree node alone; the node with the last
token, with the last two, and with the token before the last.  The last three are looked
up in hashed tables of fixed size whose counts come from all training texts.  Their
logits are mixed by weights that the bit's depth and the longest context's confidence
select; the weights start from a calibration slice of the training texts and are
updated while the text is read, block by block of tokens.  A running correction per
weight set and confidence (an adaptive probability map) refines the mix.

What is sent to every task has a fixed bound: VOCAB tokens and the hashed tables.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import cut, id_crc, map_pandas
from fleetlens.llm.texts import runs

VOCAB = 32_768
BITS = 21
SLOTS = 1 << BITS
CHUNK = 1 << 14
ORDERS = 3
SETS = 9
LEVELS = 8
END = b"\n"  # no word holds white space
SLICE = 100_000
SUFFIXES = 64
RATE = np.float32(0.003)
UNIT = 15.0  # steps of a stored logit per nat
NODE, SPREAD = 0x27D4EB2F, 0x9E3779B1
SHIFT = np.uint32(32 - BITS)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _blocks(n: int) -> np.ndarray:
    """Starts of the blocks of a text of n tokens: short ones first, for quick adaptation."""
    head = [0, 16, 32, 64, 128]
    return np.array([x for x in head if x < n] + list(range(256, n, 128)), int)


@dataclass
class Tree:
    """Huffman codes: symbol s passes nodes[at[s]:at[s + 1]] with bits[at[s]:at[s + 1]]."""
    at: np.ndarray
    nodes: np.ndarray
    bits: np.ndarray
    logit: np.ndarray  # per node: logit of bit 1 from the counts alone
    depth: np.ndarray  # per place in nodes: 0 for the first bit of a symbol, 1, then 2
    place_logit: np.ndarray = None  # logit of each place's node
    place_hash: np.ndarray = None  # what each place's node adds to a context's hash, see ``slots``

    def __post_init__(self):
        self.place_logit = self.logit.take(self.nodes) if len(self.nodes) else np.zeros(0, np.float32)
        self.place_hash = self.nodes * np.uint32(NODE * SPREAD & 0xFFFFFFFF)


def huffman(counts: np.ndarray) -> Tree:
    n = len(counts)
    heap = [(int(c) + 1, s) for s, c in enumerate(counts)]
    heapq.heapify(heap)
    weight = {s: c for c, s in heap}
    parent: dict[int, tuple[int, int]] = {}
    nxt = n
    logit = np.zeros(max(1, n - 1), np.float32)
    while len(heap) > 1:
        (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
        parent[x], parent[y] = (nxt, 0), (nxt, 1)
        logit[nxt - n] = np.log(b / a)
        heapq.heappush(heap, (a + b, nxt))
        nxt += 1
    del weight
    at, nodes, bits, depth = [0], [], [], []
    for s in range(n):
        path = []
        x = s
        while x in parent:
            x, bit = parent[x]
            path.append((x - n, bit))
        nodes += [p for p, _ in reversed(path)]
        bits += [b for _, b in reversed(path)]
        depth += [min(k, 2) for k in range(len(path))]
        at.append(len(nodes))
    return Tree(np.array(at, np.int32), np.array(nodes, np.uint32), np.array(bits, np.uint8), logit, np.array(depth, np.uint8))


class _Tails(dict):
    """Context class of a rare word by its last two bytes (or its only one)."""

    def __missing__(self, tail: bytes) -> int:
        self[tail] = (tail[1] * 31 + tail[0] if len(tail) > 1 else tail[0]) & (SUFFIXES - 1)
        return self[tail]


_TAILS = _Tails()  # at most 65,792 tails


@dataclass
class Coder:
    vocabulary: dict[bytes, int]
    counts: np.ndarray  # per symbol, the escape last
    tree: Tree

    @property
    def escape(self) -> int:
        return len(self.vocabulary)

    def symbols(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, Counter]:
        """(symbol per token with the end, context id per token, rare tokens)."""
        get = self.vocabulary.get
        sym = np.fromiter(map(get, chain(words, (END,)), repeat(-1)), np.int64, len(words) + 1)
        ctx = sym + 1
        miss = np.flatnonzero(sym < 0)
        if not len(miss):
            return sym, ctx, Counter()
        at = miss.tolist()
        if at[-1] == len(words):  # the end itself may be unknown
            words = [*words, END]
        found = [words[k] for k in at]
        rare = Counter(found)
        ctx[miss] = self.escape + 2 + np.fromiter(map(_TAILS.__getitem__, [w[-2:] for w in found]), np.int64, len(found))
        sym[sym < 0] = self.escape
        return sym, ctx, rare


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    return (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)


def context_hashes(*ctx: np.ndarray) -> np.ndarray:
    """ORDERS x tokens: hashes of the contexts before each token of the texts, one after the other."""
    c = np.concatenate(ctx).astype(np.uint32) if ctx else np.zeros(0, np.uint32)
    size = np.array([len(x) for x in ctx if len(x)], int)
    starts = np.cumsum(size) - size
    one, two = np.zeros_like(c), np.zeros_like(c)
    one[1:] = c[:-1]
    one[starts] = 0  # nothing stands before a text
    two[1:] = one[:-1]
    two[starts] = 0
    return np.stack([_spread(one * np.uint32(0x9E3779B1) + np.uint32(1)),
                     _spread(one * np.uint32(0x9E3779B1) + two * np.uint32(0x85EBCA6B) + np.uint32(2)),
                     _spread(two * np.uint32(0xC2B2AE35) + np.uint32(3))])


def _take(values: np.ndarray, at: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """``values[at]``; every place is within bounds, so numpy's check of them (half the time) is left out."""
    return values.take(at, mode="clip", out=out)


def expand(tree: Tree, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token, place in the tree arrays) of every bit."""
    first = _take(tree.at, sym)
    n = _take(tree.at, sym + 1) - first
    ends = np.cumsum(n, dtype=np.int32)
    token = np.repeat(np.arange(len(sym), dtype=np.int32), n)
    return token, np.arange(len(token), dtype=np.int32) + _take(first - ends + n, token)


def slots(hashes: np.ndarray, node: np.ndarray) -> np.ndarray:
    """The upper bits of (hash + node * NODE) * SPREAD.

    Modulo 2^32 that is hash * SPREAD + node * (NODE * SPREAD): the first term is made once a
    token (``token_hashes``), the second once a place of the tree, and bits only add them.
    """
    return (hashes * np.uint32(SPREAD) + node * np.uint32(NODE * SPREAD & 0xFFFFFFFF)) >> np.uint32(32 - BITS)


def token_hashes(*ctx: np.ndarray) -> np.ndarray:
    """``context_hashes``, multiplied for ``slots``."""
    return context_hashes(*ctx) * np.uint32(SPREAD)


def _count_tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: Counter = Counter()
    for b in batches:
        for t in b["text"]:
            seen.update(words_of(t if isinstance(t, str) else ""))
            seen[END] += 1
            if len(seen) > 400_000:
                yield pd.DataFrame({"token": list(seen), "c": list(seen.values())})
                seen.clear()
    yield pd.DataFrame({"token": list(seen), "c": list(seen.values())})


def token_counts(docs: DataFrame) -> DataFrame:
    """(token binary, c long) over all rows of ``docs`` (column text)."""
    return (docs.select("text").mapInPandas(_count_tokens, "token binary, c long")
            .groupBy("token").agg(F.sum("c").alias("c")))


def frequent(counts: DataFrame, most: int = VOCAB) -> list[tuple[bytes, int]]:
    """The tokens above the least count that at most ``most`` tokens reach, and the end."""
    level = F.floor(F.log2("c") * 16).cast("int")
    least, held = None, 0
    for r in sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r["level"]):
        if held + r["n"] > most - 1:
            break
        held += r["n"]
        least = r["level"]
    cond = F.col("token") == F.lit(END)
    rows = counts.where(cond | (level >= least) if least is not None else cond).collect()
    return sorted(((bytes(r["token"]), r["c"]) for r in rows), key=lambda x: (-x[1], x[0]))


def _train(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder: Coder = shared.value
        tree = coder.tree
        table = np.zeros((ORDERS, SLOTS, 2), np.int32)
        flat = table.reshape(ORDERS, -1)
        for b in batches:
            for part in runs([t if isinstance(t, str) else "" for t in b["text"]], limit=400_000):
                coded = [coder.symbols(words_of(t)) for t in part]
                sym, h = np.concatenate([c[0] for c in coded]), token_hashes(*[c[1] for c in coded])
                for k in range(0, len(sym), SLICE):
                    token, at = expand(tree, sym[k:k + SLICE])
                    node, bit = _take(tree.place_hash, at), _take(tree.bits, at).astype(np.int64)
                    one = np.ones(len(at), np.int32)  # of the table's type: add.at has a fast path for it
                    for o in range(ORDERS):
                        where = _take(h[o, k:k + SLICE], token)
                        where += node
                        where >>= SHIFT
                        where <<= np.uint32(1)
                        np.add.at(flat[o], bit + where, one)
        for o in range(ORDERS):
            for k in range(0, SLOTS, CHUNK):
                part = table[o, k:k + CHUNK]
                if part.any():
                    yield pd.DataFrame({"o": [o], "chunk": [k // CHUNK], "n": [part.tobytes()]})
    return run


def _merge(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros((CHUNK, 2), np.int64)
    for b in batches:
        for x in b["n"]:
            total += np.frombuffer(x, np.int32).reshape(-1, 2)
    logit = np.log((total[:, 1] + 0.4) / (total[:, 0] + 0.4))
    stored = np.clip(np.rint(logit * UNIT), -127, 127).astype(np.int8)
    yield pd.DataFrame({"o": [key[0]], "chunk": [key[1]], "n": [stored.tobytes()]})


def hashed_tables(docs: DataFrame, shared) -> np.ndarray:
    """ORDERS x SLOTS stored logits, from all rows of ``docs``; tasks' counts are added up on Spark.

    Every task sends a table of fixed size, so input partitions are first merged to two
    per core: what is shuffled then follows the cluster, not the number of files.
    """
    tasks = 2 * docs.sparkSession.sparkContext.defaultParallelism
    rows = (docs.select("text").coalesce(tasks).mapInPandas(_train(shared), "o int, chunk int, n binary").groupBy("o", "chunk")
            .applyInPandas(_merge, "o int, chunk int, n binary").collect())
    out = np.zeros((ORDERS, SLOTS), np.int8)
    for r in rows:
        out[r["o"], r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK] = np.frombuffer(r["n"], np.int8)
    return out


START = np.tile(np.array([0.3, 0.35, 0.25, 0.1], np.float32), (SETS, 1))


@dataclass
class Mixer:
    coder: Coder
    tables: np.ndarray
    weights: np.ndarray  # SETS x 4

    def bits(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """(bits of each text's symbols, its last weights); texts: (symbols, context ids)."""
        n = len(texts)
        w = np.asfortranarray(np.repeat(self.weights[None].astype(np.float32), n, axis=0).reshape(-1, 4))
        drift, seen = np.zeros(n * SETS * LEVELS, np.float32), np.full(n * SETS * LEVELS, 40.0, np.float32)
        cost = np.zeros(n)
        every, upto = token_hashes(*[c for _, c in texts]), np.cumsum([0, *(len(c) for _, c in texts)])
        hashes = [every[:, a:z] for a, z in zip(upto, upto[1:])]
        starts = [_blocks(len(s)) for s, _ in texts]
        steps = max((len(s) for s in starts), default=0)
        for step in range(0, steps):
            live = [k for k in range(n) if step < len(starts[k])]
            cuts = [(starts[k][step], starts[k][step + 1] if step + 1 < len(starts[k]) else len(texts[k][0])) for k in live]
            sym = np.concatenate([texts[k][0][a:z] for k, (a, z) in zip(live, cuts)])
            h = np.concatenate([hashes[k][:, a:z] for k, (a, z) in zip(live, cuts)], axis=1)
            doc = np.repeat(np.array(live, np.int32), [z - a for a, z in cuts])
            self._step(sym, h, doc, w, drift, seen, cost)
        return cost, w.reshape(n, SETS, 4)

    def _step(self, sym, h, doc, w, drift, seen, cost) -> None:
        tree = self.coder.tree
        token, at = expand(tree, sym)
        if not len(token):
            return
        node, bit = _take(tree.place_hash, at), _take(tree.bits, at).astype(np.float32)
        x = np.empty((4, len(token)), np.float32)
        _take(tree.place_logit, at, out=x[0])
        for o in range(ORDERS):
            where = _take(h[o], token)
            where += node
            where >>= SHIFT
            np.multiply(self.tables[o].take(where), np.float32(1 / UNIT), out=x[o + 1])
        sure = np.abs(x[2])
        d = _take(doc, token)
        gate = (d * SETS + _take(tree.depth, at) * 3 + (sure > 0.05) + (sure > 2.0)).astype(np.int64)
        z = _take(w[:, 0], gate) * x[0]
        for i in range(1, 4):
            z += _take(w[:, i], gate) * x[i]
        p = 1 / (1 + np.exp(-np.clip(z, -12, 12)))
        cell = gate * LEVELS + np.clip(z + 4, 0, LEVELS - 1).astype(np.int64)
        err = bit - p
        refined = np.clip(p + np.float32(0.7) * _take(drift / seen, cell), np.float32(1 / 8192), np.float32(1 - 1 / 8192))
        starts = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])  # a text's bits lie together
        cost[d[starts]] -= np.add.reduceat(np.log(np.abs(1 - bit - refined)), starts, dtype=np.float64) / np.log(2.0)
        for i in range(4):
            w[:, i] += RATE * np.bincount(gate, weights=err * x[i], minlength=len(w)).astype(np.float32)
        drift += np.bincount(cell, weights=err, minlength=len(drift)).astype(np.float32)
        seen += np.bincount(cell, minlength=len(seen)).astype(np.float32)


def _bundles(sizes: list[int], limit: int = SLICE, most: int = 128) -> Iterator[list[int]]:
    """Texts of like length, which have as many blocks: at most ``most``, of about ``limit`` tokens."""
    out, held = [], 0
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        out.append(k)
        held += sizes[k]
        if held >= limit or len(out) == most:
            yield out
            out, held = [], 0
    if out:
        yield out


def _calibrate(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m: Mixer = shared.value
        total, n = np.zeros((SETS, 4)), 0.0
        for b in batches:
            texts = [m.coder.symbols(words_of(t if isinstance(t, str) else ""))[:2] for t in b["text"]]
            for r in _bundles([len(s) for s, _ in texts]):
                _, w = m.bits([texts[k] for k in r])
                size = np.array([min(2000, len(texts[k][0])) for k in r], float)  # long texts have settled weights
                total += np.tensordot(size, w, 1)
                n += size.sum()
        if n:
            yield pd.DataFrame({"i": np.arange(SETS * 4), "v": total.ravel(), "n": n})
    return run


STATS = ("rid long, doc_id {id}, held_out boolean, token binary, n long, n_tokens long, known long, base double, bits double, "
         "bytes long")


def _score(shared, kind: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, total = shared.value
        coder = m.coder
        per_symbol = np.log10((coder.counts + 1.0) / total)
        per_symbol[coder.escape] = 0.0
        known = (coder.counts > 0).astype(np.int64)
        known[coder.escape] = 0
        rid = TaskContext.get().partitionId() << 36
        for b in batches:
            texts = b["text"].tolist()
            ids, held = b["doc_id"].tolist(), b["held_out"].tolist()
            at = 0
            for part in runs([t if isinstance(t, str) else "" for t in texts], limit=2_000_000):
                coded = [(words_of(t), len(t.encode("utf-8", "surrogatepass"))) for t in part]
                coded = [(*coder.symbols(w), size) for w, size in coded]
                rows, more = [], []  # of texts; rare tokens of each, in the same order
                for r in _bundles([len(c[0]) for c in coded]):
                    cost, _ = m.bits([coded[k][:2] for k in r])
                    for k, bits in zip(r, cost):
                        sym, _, rare, size = coded[k]
                        rid += 1
                        i = at + k
                        rows.append((rid, ids[i], held[i], b" %d" % rid, 0, len(sym), int(known[sym].sum()),
                                     float(per_symbol[sym].sum()), float(bits), size))
                        more.append(rare)
                at += len(part)
                yield _stats(rows, more)
    return run


def _stats(rows: list[tuple], more: list[Counter]) -> pd.DataFrame:
    """A row of ``STATS`` for each text and then for each of its rare tokens, which has only rid, token and n."""
    if not rows:
        return pd.DataFrame(columns=["rid", "doc_id", "held_out", "token", "n", "n_tokens", "known", "base", "bits", "bytes"])
    rid, doc_id, held, token, n, n_tokens, known, base, bits, size = zip(*rows)
    kinds = np.array([len(c) for c in more], int)
    none = int(kinds.sum())
    rid = np.array(rid, np.int64)
    absent = np.arange(len(rows) + none) >= len(rows)

    def plain(x: tuple) -> pd.Series:
        return pd.Series([*x, *repeat(None, none)], dtype=object)

    def whole(x: tuple) -> pd.arrays.IntegerArray:
        return pd.arrays.IntegerArray(np.concatenate([np.array(x, np.int64), np.zeros(none, np.int64)]), absent.copy())

    def real(x: tuple) -> np.ndarray:
        return np.concatenate([np.array(x, float), np.full(none, np.nan)])
    return pd.DataFrame({
        "rid": np.concatenate([rid, np.repeat(rid, kinds)]), "doc_id": plain(doc_id), "held_out": plain(held),
        "token": pd.Series([*token, *chain.from_iterable(more)], dtype=object),
        "n": np.fromiter(chain(n, chain.from_iterable(c.values() for c in more)), np.int64, len(rows) + none),
        "n_tokens": whole(n_tokens), "known": whole(known), "base": real(base), "bits": real(bits), "bytes": whole(size)})


def score(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", vocabulary: int = VOCAB) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every row of ``docs``.

    ``learn``: condition under which a row is training text (NULL: it is not).  A NULL
    text is empty: its only token is the end.  Repeated rows are scored each.  An empty
    table gives an empty result.  score is the log10 probability of the tokens under the
    model, base_score under add-one counts; both give an unseen token the mass of one.
    bits_per_byte is the score in bits over the bytes of the text and its end.

    Rarer tokens meet their counts in a shuffled join; none of them holds more than
    about 1/vocabulary of all tokens, so no key is hot.
    """
    d = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"),
                    (~F.coalesce(learn, F.lit(False))).alias("held_out"))
    train = d.where("not held_out")
    counts = cut(token_counts(train))
    n, v = (int(x or 0) for x in counts.agg(F.sum("c"), F.count("*")).first())
    top = frequent(counts, vocabulary)
    rest_n, rest_v = n - sum(c for _, c in top), v - len(top)
    coder_counts = np.array([c for _, c in top] + [0], np.int64)
    weights = coder_counts.copy()
    weights[-1] = rest_n + max(1, rest_v // 4)  # rare tokens, and room for unseen ones
    coder = Coder({t: i for i, (t, _) in enumerate(top)}, coder_counts, huffman(weights))
    sc = docs.sparkSession.sparkContext
    slice_ = F.pmod(F.floor(id_crc(F.col("doc_id")) / 64), F.lit(32)) == 5
    mixer = Mixer(coder, hashed_tables(train.where(~slice_), sc.broadcast(coder)), START)
    tuned = (train.where(slice_).select("text").mapInPandas(_calibrate(sc.broadcast(mixer)), "i int, v double, n double")
             .groupBy("i").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).orderBy("i").collect())
    if tuned:
        mixer = Mixer(coder, mixer.tables, np.array([r["v"] / r["n"] for r in tuned], np.float32).reshape(SETS, 4))
    kind = d.schema["doc_id"].dataType.simpleString()
    shared = sc.broadcast((mixer, float(n + v + 1)))
    stream = map_pandas(d, _score(shared, kind), STATS.format(id=kind))
    c = F.coalesce(F.col("c"), F.lit(0))
    met = stream.join(counts.withColumnRenamed("token", "t"), F.col("token") == F.col("t"), "left")
    out = met.groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
        (F.max("known") + F.sum(F.when(c > 0, F.col("n")).otherwise(0))).alias("n_known"),
        (F.max("base") + F.sum(F.col("n") * F.log10((c + 1) / F.lit(float(n + v + 1))))).alias("base_score"),
        (F.max("bits") * F.lit(-np.log10(2.0)).cast("double")
         + F.sum(F.col("n") * F.log10((c + 1) / F.lit(float(rest_n + rest_v + 1))))).alias("score"),
        F.max("bytes").alias("bytes"))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score",
                      "score", (-F.col("score") / np.log10(2.0) / (F.col("bytes") + 1)).alias("bits_per_byte"))
