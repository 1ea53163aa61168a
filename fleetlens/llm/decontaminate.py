"""Benchmark decontamination by pigeonhole edit matching.

An item of m characters may occur with up to k = floor(rate * m) edits.  Cut into
k + 1 pieces, any such occurrence leaves one piece unharmed; so an Aho-Corasick
automaton over all pieces finds every candidate place.  Myers' bit-parallel edit
distance verifies it from the piece upwards: the pieces come from halving, where the
same argument holds for every half, so a part that fails ends the search there, and
the whole item decides.  Both sides are compared as
lower-case words joined by single blanks.

Items go through the documents in blocks of bounded size, each sent to every
task; a benchmark of any size works, one pass per block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import keep_rows, map_pandas

_WORD = re.compile(r"[^\W_]+")


def normal(text: str | None) -> str:
    return " ".join(_WORD.findall((text or "").lower()))


@dataclass
class Node:
    """Characters start..end of an item that may differ by ``k`` edits; ``parent`` is None for the whole item."""
    start: int
    end: int
    k: int
    parent: "Node | None"
    pattern: str
    eq: dict[str, int] | None = None


def cut_pieces(item: str, k: int) -> list[Node]:
    """The k + 1 pieces of ``item``, by halving: if a part occurs with k edits, then its left half
    with (k - 1) // 2 or its right half with the rest less one.  The last parts stand without an edit."""
    leaves: list[Node] = []

    def split(node: Node) -> None:
        if node.k == 0:
            leaves.append(node)
            return
        left = (node.k - 1) // 2
        mid = node.start + (node.end - node.start) * (left + 1) // (node.k + 1)
        split(Node(node.start, mid, left, node, item[node.start:mid]))
        split(Node(mid, node.end, node.k - 1 - left, node, item[mid:node.end]))

    split(Node(0, len(item), k, None, item))
    return leaves


def masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def myers(eq: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """(least edits between a pattern of m characters and a substring of ``text``, end of the first such)."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, end = m, 0
    get = eq.get
    for i, c in enumerate(text):
        e = get(c, 0)
        xv = e | mv
        xh = (((e & pv) + pv) ^ pv) | e
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
            if score < best:
                best, end = score, i + 1
        ph <<= 1
        pv = (mh << 1 | ~(xv | ph)) & full
        mv = ph & xv & full
    return best, end


@dataclass
class Block:
    """Items of one pass: (item_id, normal text, k), ready to be sent to the tasks."""
    items: list[tuple[object, str, int]]

    def matcher(self) -> "Matcher":
        return Matcher(self.items)


class Matcher:
    def __init__(self, items: list[tuple[object, str, int]]):
        self.items = items
        self.whole: dict[str, list[int]] = {}
        places: dict[str, list[tuple[int, Node]]] = {}
        for n, (_, text, k) in enumerate(items):
            if k < 0:  # too short to be looked for inside a text
                self.whole.setdefault(text, []).append(n)
            else:
                for leaf in cut_pieces(text, k):
                    places.setdefault(leaf.pattern, []).append((n, leaf))
        self.tree = ahocorasick.Automaton()
        for piece, where in places.items():
            self.tree.add_word(piece, (len(piece), where))
        self.any = bool(places)
        if self.any:
            self.tree.make_automaton()

    def hits(self, text: str) -> list[tuple[int, int, int, int, int]]:
        """(item number, edits, start, end, occurrences) in a normal text; per item its best, earliest occurrence."""
        found = [(n, 0, 0, len(text), 1) for n in self.whole.get(text, [])]
        if not self.any or not text:
            return found
        best: dict[int, tuple[int, int, int, int]] = {}
        last: dict[int, int] = {}
        for end, (length, where) in self.tree.iter(text):
            begin = end + 1 - length
            for n, leaf in where:
                if begin < last.get(n, 0):  # within an occurrence that is known already
                    continue
                got = self._climb(leaf, begin, text)
                if got:
                    d, a, z = got
                    last[n] = z
                    old = best.get(n)
                    best[n] = (d, a, z, 1) if old is None else (*(old[:3] if old[0] <= d else got), old[3] + 1)
        found += [(n, *v) for n, v in best.items()]
        return found

    @staticmethod
    def _climb(leaf: Node, begin: int, text: str) -> tuple[int, int, int] | None:
        """(edits, start, end) of the whole item around a piece found at ``begin``, if every part above holds."""
        node, origin = leaf.parent, begin - leaf.start
        if node is None:
            return 0, begin, begin + leaf.end
        while True:
            if node.eq is None:
                node.eq = masks(node.pattern)
            m = node.end - node.start
            a = max(0, origin + node.start - node.k)
            window = text[a:max(0, origin + node.end + node.k)]
            if len(window) < m - node.k:
                return None
            d, e = myers(node.eq, m, window)
            if d > node.k:
                return None
            if node.parent is None:
                _, back = myers(masks(node.pattern[::-1]), m, window[:e][::-1])
                return d, a + e - back, a + e
            node = node.parent


def original_span(text: str, start: int, end: int) -> tuple[int, int]:
    """Characters of the original text that characters start..end of its normal form come from (whole words)."""
    at, first, last = 0, None, 0
    low = text.lower()
    if len(low) != len(text):  # some letters change length in lower case: count in the lower-case text
        text = low
    for m in _WORD.finditer(low):
        z = at + m.end() - m.start()
        if z > start and first is None:
            first = m.start()
        if at < end:
            last = m.end()
        else:
            break
        at = z + 1
    return (first or 0), last


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", rate: float = 0.1, min_chars: int = 24,
           block_items: int = 5000, block_chars: int = 4_000_000) -> list[Block]:
    """The items in blocks that tasks can hold; ids of any type.  Items without words are left out.

    An item without an id counts as the item of the same text that has one, else it stays.

    Items of fewer than ``min_chars`` characters say too little to be looked for
    inside texts; they match only a document that consists of them.  The driver reads
    one partition of the benchmark at a time.
    """
    rows = benchmark.select(benchmark[item_id].alias("i"), benchmark[text].alias("t")).where("t is not null").dropDuplicates()
    named = rows.where("i is not null")
    rows = named.unionByName(rows.where("i is null").join(named.select("t").distinct(), "t", "left_anti"))
    out: list[Block] = []
    now: list[tuple[object, str, int]] = []
    chars = 0
    for r in rows.toLocalIterator():
        t = normal(r["t"])
        if t:
            now.append((r["i"], t, int(rate * len(t)) if len(t) >= min_chars else -1))
            chars += len(t)
            if len(now) >= block_items or chars >= block_chars:
                out.append(_block(now))
                now, chars = [], 0
    return [*out, _block(now)] if now else out


def _block(items: list[tuple[object, str, int]]) -> Block:
    return Block(sorted(items, key=lambda x: (x[1], str(x[0]))))


HIT = "edits int, start int, end int, occurrences int"


def find(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """doc_id, item_id, edits, start, end (characters of the text), occurrences: one row per document and item in it.

    Whole texts; NULL and empty texts and items match nothing; repeated rows are
    reported each (repeated items of one id and text once); ids of both keep type and
    value; empty tables give an empty result.  No shuffle of documents.
    """
    d = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("__text"))
    schema = (f"doc_id {d.schema['doc_id'].dataType.simpleString()}, "
              f"item_id {benchmark.schema[params.get('item_id', 'item_id')].dataType.simpleString()}, {HIT}")
    out = None
    for block in blocks(benchmark, **params) or [Block([])]:
        part = map_pandas(d, _finder(docs.sparkSession.sparkContext.broadcast(block)), schema)
        out = part if out is None else out.unionByName(part)
    return out


def _finder(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value.matcher()
        for b in batches:
            rows = []
            for i, t in zip(b["doc_id"], b["__text"]):
                if isinstance(t, str):
                    for n, d, s, e, times in m.hits(normal(t)):
                        s, e = original_span(t, s, e)
                        rows.append((i, m.items[n][0], d, s, e, times))
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "edits", "start", "end", "occurrences"])
    return run


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **params) -> DataFrame:
    """``docs`` without the documents in which a benchmark item occurs; all columns kept, no shuffle.

    Documents without a text or with an empty one stay, as do all where the benchmark is
    empty; repeated rows stay or go together.  Items without an id count.
    """
    for block in blocks(benchmark, **params):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        docs = keep_rows(docs, text, _without(shared))
    return docs


def _without(shared):
    def make():
        m = shared.value.matcher()
        return lambda texts: [not (t and m.hits(normal(t))) for t in texts]
    return make
