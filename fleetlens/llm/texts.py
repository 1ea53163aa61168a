"""Whole texts as arrays of code points, in pieces of bounded memory."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np


@functools.cache
def letters() -> np.ndarray:
    """letters()[c]: whether code point c is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def runs(texts: Iterable[str], limit: int = 1_000_000, docs: int = 256) -> Iterator[list[str]]:
    """Consecutive texts, ``docs`` of them or about ``limit`` characters to a list (one text at least)."""
    now: list[str] = []
    held = 0
    for t in texts:
        now.append(t)
        held += len(t)
        if held >= limit or len(now) >= docs:
            yield now
            now, held = [], 0
    if now:
        yield now


def pieces(text: str, limit: int = 1_000_000, overlap: int = 2) -> Iterator[tuple[str, int]]:
    """(piece, starts): pieces of a text that overlap, so that n-grams of overlap + 1 characters
    that begin within the first ``starts`` characters of the pieces are all n-grams of the text."""
    for at in range(0, max(1, len(text)), limit):
        piece = text[at:at + limit + overlap]
        yield piece, min(limit, len(text) - at)
