"""Words of a text, whatever its case, punctuation, blanks, invisible characters and character forms."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import xxhash

#: Letters of other scripts that look like Latin ones (Cyrillic and Greek, lower case).
LOOKALIKES = str.maketrans("асеіјорѕухһԁѵαεικνορτυχ", "aceijopsyxhdvaeikvoptux")
_WORD = re.compile(r"[^\W_]+")
_LATIN = re.compile("[a-z]")
_FOREIGN = re.compile("[Ͱ-ӿԀ-ԯ]")
_IGNORED = re.compile("[­͏؜᠋-᠏​-‏‪-‮⁠-⁯︀-️﻿]")


def _latin(match: re.Match) -> str:
    word = match.group()
    return word.translate(LOOKALIKES) if _FOREIGN.search(word) and _LATIN.search(word) else word


def words(text: str | None) -> list[str]:
    """Words in lower case. A word with Latin letters has its look-alikes from other scripts turned into Latin."""
    if not text:
        return []
    if text.isascii():
        return _WORD.findall(text.lower())
    text = unicodedata.normalize("NFKC", _IGNORED.sub("", text)).casefold()
    text = unicodedata.normalize("NFKC", text)
    if _FOREIGN.search(text):
        text = _WORD.sub(_latin, text)
    return _WORD.findall(text)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


class WordHashes:
    """64-bit hashes of words, the same in every process, behind a bounded cache."""

    def __init__(self, entries: int = 1 << 20):
        self._known = _Hashes()
        self._entries = entries

    def __call__(self, all_words: list[str]) -> np.ndarray:
        if len(self._known) > self._entries:
            self._known.clear()
        return np.fromiter(map(self._known.__getitem__, all_words), np.uint64, len(all_words))


def gram_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` words, by its first word; runs over the ends of texts are the caller's to leave out."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    g = np.full(n, length, np.uint64)
    for j in range(length):
        g = g * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + n]
    g ^= g >> np.uint64(29)
    g *= np.uint64(0xBF58476D1CE4E5B9)
    return g ^ (g >> np.uint64(32))


def edits_within(a: list, b: list, most: int) -> bool:
    """Whether ``a`` becomes ``b`` by at most ``most`` words added, dropped or replaced (bit-parallel edit distance)."""
    if abs(len(a) - len(b)) > most:
        return False
    if not a or not b:
        return max(len(a), len(b)) <= most
    masks: dict = {}
    for i, w in enumerate(a):
        masks[w] = masks.get(w, 0) | (1 << i)
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    plus, minus, score = full, 0, len(a)
    for left, w in zip(range(len(b) - 1, -1, -1), b):
        eq = masks.get(w, 0)
        x = eq | minus
        d = (((eq & plus) + plus) ^ plus) | eq
        hp, hm = minus | (~(d | plus) & full), plus & d
        if hp & top:
            score += 1
        elif hm & top:
            score -= 1
        if score - left > most:
            return False
        hp, hm = ((hp << 1) | 1) & full, (hm << 1) & full
        plus, minus = hm | (~(x | hp) & full), hp & x
    return score <= most
