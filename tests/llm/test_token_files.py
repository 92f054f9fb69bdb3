import numpy as np
import pytest
from tokenizers import Tokenizer

import brute
from stridelake.llm import rans, token_files, tokens
from stridelake.llm.tokens import Encoder, default_vocabulary, encoder

ODD = ["a b  \n\n x", "it's they'll!!  end  ", "<|endoftext|> x", "tab\t\tx\r\n\r\n  y ", "ça va? œuvre ½ ² ×÷ 3²a", "漢字 и кириллица",
       "", "   ", "\n", "a\x0bb\x1cc", "'s 'S ''ll x'd", " x y", "a" * 3000, "é", "!?" * 50, " 1 22 a1b", "ŉ ſ ª º µ"]


def test_pieces_give_what_the_library_gives(spark):
    texts = ODD + [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    plain = Tokenizer.from_file(default_vocabulary()).encode_batch(texts, add_special_tokens=False)
    own = encoder()
    assert own.by_piece
    for _ in range(2):
        assert own.encode(texts) == [np.array(e.ids, own.kind).tobytes() for e in plain]


class Counted:
    """A tokenizer that notes the texts it is handed."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, []

    def encode_batch_fast(self, texts, **named):
        self.texts += texts
        return self.tokenizer.encode_batch_fast(texts, **named)


def plain_ids(own, texts):
    found = Tokenizer.from_file(default_vocabulary()).encode_batch(texts, add_special_tokens=False)
    return [np.array(e.ids, own.kind).tobytes() for e in found]


def test_library_is_handed_new_words_together_and_once():
    own = Encoder(default_vocabulary())
    own.tokenizer = Counted(own.tokenizer)
    words = [f"{a}{b}" for a in "каменьщф" for b in range(500)] + [f"w{i}x" for i in range(4000)]
    texts = [" ".join(words), " " + " ".join(words[::-1]) + ".", "— " + " ".join(words[:500])]
    assert own.encode(texts) == plain_ids(own, texts)
    assert len(own.tokenizer.texts) < 60 and sum(map(len, own.tokenizer.texts)) < 1.1 * len(texts[0])
    own.tokenizer.texts = []
    assert own.encode(texts) == plain_ids(own, texts) and not own.tokenizer.texts


def test_parts_of_any_characters_give_what_the_library_gives():
    rng = np.random.default_rng(10)
    some = list("  \n\n\t\r\x0b\x1c\x85\xa0\u1680\u2003\u2028\u3000\ufeff\u200baaZst've''.,-_09½éß×©ñжя漢한😀\u0301\0") + ["'s", "'ll", " a", ", b", " é"]
    texts = ["".join(rng.choice(some, n)) for n in rng.integers(0, 40, 4000)]
    own = Encoder(default_vocabulary())
    assert own.encode(texts) == plain_ids(own, texts)


def test_kept_parts_are_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_PARTS", 50)
    own = Encoder(default_vocabulary())
    texts = [" ".join(f"w{i + j}" for j in range(40)) + " " + "long" * 100 for i in range(0, 400, 20)]
    for text in texts + texts[::-1]:
        assert own.encode([text]) == plain_ids(own, [text])
        assert len(own.parts) + len(own.older) <= 200 and max(map(len, own.parts)) <= tokens.LONGEST_KEPT


@pytest.mark.parametrize("count", [1, 2, 255, 256, 257, 33_000, rans.BLOCK, rans.BLOCK + 1, 3 * rans.BLOCK + 700])
@pytest.mark.parametrize("symbols", [1, 2, 50_000])
def test_files_come_back(count, symbols):
    rng = np.random.default_rng(count)
    tokens = np.minimum(rng.zipf(1.2, count) - 1, symbols - 1).astype(np.uint16)
    keys = np.ma.array([5, 0, 7], mask=[False, True, False])
    data = b"".join(token_files.file_bytes(tokens, keys, np.array([1, 0, count - 1])))
    found, names, lengths = token_files.read_file(data)
    assert np.array_equal(found, tokens) and names.tolist() == [5, None, 7] and lengths.tolist() == [1, 0, count - 1]


def test_parts_can_be_decoded_alone():
    rng = np.random.default_rng(3)
    tokens = rng.integers(0, 1000, 2 * rans.BLOCK).astype(np.uint16)
    coder = rans.Coder(rans.frequencies(np.bincount(tokens)))
    blocks = tokens.reshape(2, -1)
    for row, parts in zip(blocks, coder.encode(blocks)):
        assert len(parts) == rans.BLOCK_STEPS // rans.CHECK_STEPS
        found = [coder.decode([p])[0] for p in reversed(parts)][::-1]
        assert np.array_equal(np.concatenate(found), row)


def test_frequencies():
    rng = np.random.default_rng(4)
    for counts in (np.array([1]), np.array([0, 5, 0]), rng.zipf(1.1, 50_000) % 10**6, np.r_[10**12, np.ones(60_000, int)], np.zeros(4, int)):
        share = rans.frequencies(counts)
        assert share.sum() == (rans.SLOTS if counts.sum() else 0) and ((share > 0) == (counts > 0)).all()


def test_damage_is_found():
    tokens = np.arange(5000, dtype=np.uint16) % 777
    data = bytearray(b"".join(token_files.file_bytes(tokens, np.ma.array([1], mask=[False]), np.array([5000]))))
    for at in [0, 20, len(data) // 2, len(data) - 30, len(data) - 1]:
        bad = bytearray(data)
        bad[at] ^= 1
        with pytest.raises(token_files.DamagedFile):
            token_files.read_file(bytes(bad))
    with pytest.raises(token_files.DamagedFile):
        token_files.read_file(bytes(data[:-3]))


@pytest.mark.parametrize("file_tokens, range_bytes", [(50, 40_000), (1 << 23, 1 << 30)])
def test_odd_documents(spark, monkeypatch, tmp_path, odd_documents, no_documents, file_tokens, range_bytes):
    monkeypatch.setattr(token_files, "RANGE_BYTES", range_bytes)
    manifest = token_files.write_tokens(odd_documents, str(tmp_path / "a"), file_tokens=file_tokens)
    rows = token_files.read_tokens(spark, str(tmp_path / "a"), with_ids=True).collect()
    plain = Tokenizer.from_file(default_vocabulary())
    texts = [(r.doc_id, r.text or "") for r in odd_documents.collect()]
    want = sorted(((i is None, i or 0), plain.encode(t, add_special_tokens=False).ids + [0]) for i, t in texts)
    rows.sort(key=lambda r: r.start)
    assert [r.start for r in rows] == np.r_[0, np.cumsum([r.n_tokens for r in rows])[:-1]].tolist()
    got = [((r.doc_id is None, r.doc_id or 0), list(r.ids)) for r in rows]
    assert [k for k, _ in got] == [k for k, _ in want] and sorted(got) == want
    assert all(r.ids_crc32 == brute.ids_mark(r.ids) and r.n_tokens == len(r.ids) for r in rows)
    assert (manifest.count() > 5) == (file_tokens == 50)
    assert token_files.encode_and_read(no_documents).count() == 0


def test_query(spark):
    from stridelake.llm import catalog
    folder = "/root/testdata/sf0.001"
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    plain = Tokenizer.from_file(default_vocabulary()).encode_batch([t for _, t in docs], add_special_tokens=False)
    want, start = [], 0
    for (i, _), e in zip(docs, plain):
        want.append((i, start, len(e.ids) + 1, brute.ids_mark(e.ids + [0])))
        start += len(e.ids) + 1
    assert sorted(map(tuple, catalog.QUERIES["op10_token_files"](spark, folder).collect())) == want
