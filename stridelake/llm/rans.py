"""A static range asymmetric numeral coder of token ids, in interleaved lanes and independent blocks.

Symbol i of a block belongs to lane i mod LANES. A lane's state is in [2^31, 2^63) between steps and gives off or
takes 32-bit words; the words of a block lie in the order in which the decoder takes them. A block's checkpoints
hold the states of its lanes and the place in its words, the first at its start, so that the parts between
checkpoints can be decoded alone or side by side. All blocks and parts of a call advance together as one array.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SCALE = 20
SLOTS = 1 << SCALE
LANES = 256
BLOCK_STEPS = 256
CHECK_STEPS = 128
BLOCK = LANES * BLOCK_STEPS
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
WORD_MASK = np.uint64(0xFFFFFFFF)
SHIFT = np.uint64(SCALE)
SLOT_MASK = np.uint64(SLOTS - 1)


@dataclass
class Part:
    """Steps between two checkpoints: the states at its start and its words."""
    states: np.ndarray
    words: np.ndarray
    count: int


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Shares of the symbols in whole slots; each symbol that occurs has one at least."""
    total = int(counts.sum())
    if not total:
        return np.zeros(len(counts), np.uint32)
    if np.count_nonzero(counts) > SLOTS:
        raise ValueError("more symbols than slots")
    share = np.where(counts > 0, np.maximum(1, counts.astype(np.float64) * SLOTS // total), 0).astype(np.int64)
    rest = SLOTS - int(share.sum())
    order = np.argsort(-counts, kind="stable")
    if rest > 0:
        share[order[0]] += rest
    at = 0
    while rest < 0:  # the largest symbols pay for those rounded up, at most half of their share each time
        symbol = order[at % len(order)]
        cut = min(-rest, int(share[symbol]) // 2)
        share[symbol] -= cut
        rest += cut
        at += 1
    return share.astype(np.uint32)


class Coder:
    def __init__(self, share: np.ndarray):
        self.share = share.astype(np.uint64)
        self.first = np.cumsum(self.share) - self.share
        self.symbol = np.repeat(np.arange(len(share), dtype=np.uint32), share)

    def encode(self, blocks: np.ndarray) -> list[list[Part]]:
        """Blocks of equal length, rows of steps times lanes; gives the parts of each."""
        rows = len(blocks)
        steps = blocks.shape[1] // LANES
        by_step = blocks.reshape(rows, steps, LANES)
        state = np.full((rows, LANES), LOW, np.uint64)
        parts: list[list[Part]] = [[] for _ in range(rows)]
        limit = np.uint64(63 - SCALE)
        sent: list[tuple[np.ndarray, np.ndarray]] = []
        for step in range(steps - 1, -1, -1):
            symbol = by_step[:, step, :]
            share = self.share[symbol]
            full = state >= share << limit
            row, _ = np.nonzero(full)
            sent.append((row, (state[full] & WORD_MASK).astype(np.uint32)))
            state = np.where(full, state >> WORD, state)
            whole = state // share
            state = (whole << SHIFT) + (state - whole * share) + self.first[symbol]
            if step % CHECK_STEPS == 0:
                row = np.concatenate([r for r, _ in sent[::-1]])
                words = np.concatenate([w for _, w in sent[::-1]])[np.argsort(row, kind="stable")]
                ends = np.cumsum(np.bincount(row, minlength=rows))
                count = (min(step + CHECK_STEPS, steps) - step) * LANES
                for i, piece in enumerate(np.split(words, ends[:-1])):
                    parts[i].insert(0, Part(state[i].copy(), piece, count))
                sent = []
        return parts

    def decode(self, parts: list[Part]) -> np.ndarray:
        """Parts of equal length, side by side; gives a row of symbols for each."""
        rows = len(parts)
        steps = parts[0].count // LANES
        state = np.stack([p.states for p in parts])
        sizes = np.array([len(p.words) for p in parts])
        words = np.concatenate([p.words for p in parts] + [np.zeros(1, np.uint32)]).astype(np.uint64)
        at = np.cumsum(sizes) - sizes
        out = np.empty((rows, steps, LANES), np.uint32)
        for step in range(steps):
            slot = state & SLOT_MASK
            symbol = self.symbol[slot]
            out[:, step, :] = symbol
            state = self.share[symbol] * (state >> SHIFT) + slot - self.first[symbol]
            short = state < LOW
            taken = short.sum(axis=1)
            place = at[:, None] + np.cumsum(short, axis=1) - 1
            state[short] = state[short] << WORD | words[place[short]]
            at += taken
        if not np.array_equal(at, np.cumsum(sizes)):
            raise ValueError("the words of a part do not end with its symbols")
        return out.reshape(rows, -1)
