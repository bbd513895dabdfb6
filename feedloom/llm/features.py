"""Hashed n-gram features of whole texts, computed with numpy over many texts at once."""

from __future__ import annotations

import re

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)


def scrambled(codes: np.ndarray, bits: int) -> np.ndarray:
    """Numbers below 2**bits that depend on all bits of the codes."""
    codes = (codes ^ (codes >> np.uint64(29))) * MIX
    return ((codes ^ (codes >> np.uint64(32))) * MIX >> np.uint64(64 - bits)).astype(np.int64)


def grams(symbols: np.ndarray, n: int, salt: int, bits: int) -> np.ndarray:
    """Hashed n-grams of a sequence of symbols."""
    if len(symbols) < n:
        return np.zeros(0, np.int64)
    codes = np.full(len(symbols) - n + 1, salt * 16 + n, np.uint64)
    for k in range(n):
        codes = codes * np.uint64(1_000_003) + symbols[k : len(symbols) - n + 1 + k].astype(np.uint64)
    return scrambled(codes, bits)


def characters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


CLASSES = (
    (re.compile(r"^[^\W\d_]+$"), 1),
    (re.compile(r"^[^\W\d_]+[.,;:]$"), 2),
    (re.compile(r"^[\d.,:/-]+$"), 3),
    (re.compile(r"^[^\w\s]+$"), 4),
    (re.compile(r"^[\w]+[^\w\s.,;:]"), 5),
)


def word_shapes(text: str) -> np.ndarray:
    """A small number per word: its kind, its case, and whether it repeats the word before."""
    memo: dict[str, int] = {}
    out, last = [], None
    for word in text.split():
        shape = memo.get(word)
        if shape is None:
            kind = next((k for pattern, k in CLASSES if pattern.match(word)), 0)
            case = 0 if word.islower() else 1 if word.istitle() else 2 if word.isupper() else 3
            shape = memo[word] = kind * 4 + case
        out.append(shape + 32 if word == last else shape)
        last = word
    return np.array(out, np.uint64)
