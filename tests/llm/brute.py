"""Plain Python forms of what the operators do, for small inputs."""

import hashlib
import re
import zlib

import numpy as np
from xxhash import xxh64_intdigest

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").translate(UP))


def hit_windows(text, items, width=10):
    """Words, words in windows of items, and the items found."""
    own, hit, found = words(text), set(), set()
    for item, body in items:
        held = words(body)
        size = min(width, len(held))
        windows = {tuple(held[i:i + size]) for i in range(len(held) - size + 1)} if held else set()
        for i in range(len(own) - size + 1):
            if tuple(own[i:i + size]) in windows:
                hit |= set(range(i, i + size))
                found.add(str(item))
    return len(own), len(hit), found


def fingerprint(text, shingle=3):
    own = SPACED.findall((text or "").translate(UP))
    runs = [" ".join(own[i:i + shingle]) for i in range(max(1, len(own) - shingle + 1))] if own else []
    hashes = [xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(count, links):
    """The smallest number that links reach, for each of the numbers below count."""
    parent = list(range(count))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(count)]


def without_repeats(texts, width=100):
    """Of texts in order: bytes, removed bytes, runs removed, digest of the rest."""
    seen, out = set(), []
    for text in texts:
        gone = np.zeros(len(text) + 1, np.int64)
        for i in range(len(text) - width + 1):
            window = text[i:i + width]
            if window in seen:
                gone[i] += 1
                gone[i + width] -= 1
            seen.add(window)
        removed = np.cumsum(gone)[:len(text)] > 0
        kept = np.frombuffer(text, np.uint8)[~removed].tobytes()
        runs = int((np.diff(np.r_[0, removed.astype(int)]) == 1).sum())
        out.append((len(text), int(removed.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def ids_mark(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())
