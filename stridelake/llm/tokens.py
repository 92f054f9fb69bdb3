"""Token ids of whole texts by the tokenizers library, as packed little-endian integers.

Byte-level BPE never merges across the pieces that its pre-tokenizer cuts, so texts are cut here, at places where it
always cuts, into parts of one or more whole pieces. Each different part is encoded by the library once; its ids are
kept for the next text. Texts that hold the name of a special token are encoded by the library as a whole.
"""

from __future__ import annotations

import os
from functools import cache

import numpy as np
import pyarrow as pa

from stridelake.llm.packed import buffers

END_ID = 0
# Parts in each of two generations: the one in use, and the one before it. Longer parts are not kept.
KEPT_PARTS = 1 << 19
LONGEST_KEPT = 64
# New parts that the library is handed as one text.
JOINT_PARTS = 200

# Kinds of bytes: letters and digits, marks, the space, other white space, and first bytes of characters that are no
# white space. All other bytes are of kind 0, beside which only a space or a line's end can be cut.
WORD, MARK, SPACE, BREAK, START = 1, 2, 3, 4, 5
SEEN = (WORD, MARK, START)
KIND = np.zeros(256, np.uint8)
KIND[0x21:0x7F] = MARK
for _low, _high in ("09", "AZ", "az"):
    KIND[ord(_low):ord(_high) + 1] = WORD
KIND[0x20] = SPACE
KIND[[0x09, 0x0A, 0x0D]] = BREAK
KIND[0xC3:0xE0] = KIND[0xE4:0xEE] = START
# Where the pre-tokenizer cuts beside two neighbours, whatever stands around them: before the second (AFTER), before the
# first (BEFORE). The last of some white space always begins a piece if it precedes anything else, and is one
# if it is no space; without the cut before it, the white space alone would be one piece.
AFTER, BEFORE = 1, 2
CUTS = np.zeros(64, np.uint8)
for _first, _seconds, _cuts in (
        (WORD, (MARK, SPACE, BREAK), AFTER), (MARK, (SPACE, BREAK), AFTER), (SPACE, SEEN, BEFORE), (BREAK, SEEN, BEFORE | AFTER)):
    CUTS[[_first * 8 + s for s in _seconds]] = _cuts
SEEN_BYTES = frozenset(np.flatnonzero(np.isin(KIND, SEEN)).tolist())


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def part_starts(data: bytes, ends: np.ndarray) -> np.ndarray:
    """Where the parts of texts begin, which lie one after the other and end at `ends`."""
    kinds = KIND[np.frombuffer(data, np.uint8)]
    cuts = CUTS[kinds[:-1] * np.uint8(8) + kinds[1:]]
    between = ends[(ends > 0) & (ends < len(data))]
    cuts[between - 1] = 0
    starts = np.zeros(len(data), bool)
    starts[:-1] = cuts & BEFORE
    starts[1:] |= (cuts & AFTER).astype(bool)
    starts[between] = True
    starts[:1] = True
    return np.flatnonzero(starts)


def cut_at(data: bytes, ends: np.ndarray) -> list[bytes]:
    last = ends.tolist()
    return [data[start:end] for start, end in zip([0] + last, last)]


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.kind = np.dtype("<u2" if len(vocabulary) <= 1 << 16 else "<u4")
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # A byte is a character in the vocabulary.
        self.sizes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self.sizes[list(vocabulary.values())] = list(map(len, vocabulary))
        self.parts: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        plain = self.tokenizer.pre_tokenizer
        self.by_piece = type(plain).__name__ == "ByteLevel" and self.tokenizer.normalizer is None \
            and not plain.add_prefix_space and getattr(plain, "use_regex", True)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind) for e in found]

    def whole(self, texts: list[str]) -> list[bytes]:
        return [i.tobytes() for i in self.ids(texts)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of every text, packed."""
        cut, rest = {}, []
        for i, text in enumerate(texts):
            data = text.encode()
            if self.by_piece and not any(s in data for s in self.special):
                cut[i] = data
            else:
                rest.append(i)
        out = dict(zip(cut, self.by_parts(list(cut.values()))))
        out.update(zip(rest, self.whole([texts[i] for i in rest])))
        return [out[i] for i in range(len(texts))]

    def by_parts(self, texts: list[bytes]) -> list[bytes]:
        data = b"".join(texts)
        if not data:
            return [b""] * len(texts)
        ends = np.cumsum(list(map(len, texts)))
        starts = part_starts(data, ends)
        places = np.append(starts, len(data)).astype(np.int64)
        parts = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(data)]).dictionary_encode()
        different, places = buffers(parts.dictionary)
        ids = pa.array(self.known(cut_at(bytes(different), places[1:])), pa.large_binary()).take(parts.indices)
        packed, places = buffers(ids)
        return cut_at(bytes(packed), places[np.searchsorted(starts, ends)])

    def known(self, parts: list[bytes]) -> list[bytes]:
        """The ids of different parts, kept ones or new."""
        if len(self.parts) > KEPT_PARTS:
            self.parts, self.older = {}, self.parts
        found = list(map(self.parts.get, parts))
        missing = [i for i, ids in enumerate(found) if ids is None]
        for i in missing:
            found[i] = self.older.get(parts[i])
        fresh = self.new([parts[i] for i in missing if found[i] is None])
        for i in missing:
            part = parts[i]
            if found[i] is None:
                found[i] = fresh[part]
            if len(part) <= LONGEST_KEPT:
                self.parts[part] = found[i]
        return found

    def new(self, parts: list[bytes]) -> dict[bytes, bytes]:
        """The ids of parts from the library. Those that begin with a space and more can follow any other, so that many
        are one text, and their ids are told apart by the bytes that they stand for."""
        joint, alone, out = [], [], {}
        for part in parts:
            (joint if len(part) > 1 and part[0] == 0x20 and part[1] in SEEN_BYTES else alone).append(part)
        groups = [joint[i:i + JOINT_PARTS] for i in range(0, len(joint), JOINT_PARTS)]
        for group, ids in zip(groups, self.ids([b"".join(g).decode() for g in groups])):
            ends, found = np.cumsum(list(map(len, group))), np.cumsum(self.sizes[ids])
            last = np.searchsorted(found, ends)
            if len(found) and found[-1] == ends[-1] and np.array_equal(found[last], ends):
                out.update(zip(group, cut_at(ids.tobytes(), (last + 1) * self.kind.itemsize)))
            else:
                alone += group
        out.update(zip(alone, self.whole([p.decode() for p in alone])))
        return out


@cache
def encoder(path: str | None = None) -> Encoder:
    return Encoder(path or default_vocabulary())
