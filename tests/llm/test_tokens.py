"""Ids against the tokenizer, packing against its contract, files against an exact round trip."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing, simple8b
from tidemark.llm.tokens import Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " \t\n", "<|endoftext|> hi", "A<|ENDOFTEXT|>b", "It's we'll DON'T 'S x's", "été Å İx ß ſ ǅ", "a\xa0b c\x1cd\x85e",
    "日本語 テスト １２３ ½ Ⅷ", "x\x00y \x7f ...!!! ?a.b, 12,3.45", "ümlaut, é. É! ÿ Ÿ Ā", "ﬁ ﬂ ½ ² ª º µ × ÷", "a'b'cd 'tis l'été",
    "😀😀 a😀b", "K Å", "é å, x",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, texts):
    return [np.array(e.ids + [1], "<u4") for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("most_words", [1_000_000, 40])
def test_ids(tokenizer, docs, most_words):
    texts = TEXTS + [r.text for r in docs.collect()]
    own = Encoder(PATH, most_words=most_words)
    for _ in range(2):
        ids, bounds = own.encode(pa.array(texts), 1)
        for k, want in enumerate(ids_of(tokenizer, texts)):
            assert ids[bounds[k] : bounds[k + 1]].tolist() == want.tolist(), texts[k]


def test_words_of_the_same_pieces_in_another_order(tokenizer):
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    texts = [word, word.translate(str.maketrans("ab", "ba")), f"{word} x"]
    ids, bounds = Encoder(PATH).encode(pa.array(texts), 1)
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [x.tolist() for x in ids_of(tokenizer, texts)]


def test_another_kind_of_tokenizer_goes_its_own_way():
    path = public_tokenizers.path("byte_bpe_50k.json")
    own, plain = Encoder(path), Tokenizer.from_file(path)
    assert not own.by_word and Encoder(PATH).by_word
    texts = ["two words", "  x  y\n", "", "It's"]
    ids, bounds = own.encode(pa.array(texts), 1)
    want = [e.ids + [1] for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == want


def check_pieces(rows, docs, tokenizer, length):
    """Every id of every document in one piece; sequences gapless and at most full."""
    by_doc = defaultdict(list)
    for d, t in docs:
        by_doc[d].append(t)
    ids = {d: ids_of(tokenizer, ts) for d, ts in by_doc.items()}
    covered = {d: np.zeros(len(x[0]), int) for d, x in ids.items()}
    sequences = defaultdict(list)
    for r in rows:
        own = ids[r.doc_id][0]
        assert r.doc_tokens == len(own) and r.length > 0
        assert zlib.crc32(own[r.start : r.start + r.length].tobytes()) == r.ids_crc32
        covered[r.doc_id][r.start : r.start + r.length] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert all((c == len(by_doc[d])).all() for d, c in covered.items())
    for pieces in sequences.values():
        end = 0
        for offset, n in sorted(pieces):
            assert offset == end
            end += n
        assert end <= length
    total = sum(len(x[0]) * len(by_doc[d]) for d, x in ids.items())
    assert len(sequences) == -(-total // length)


@pytest.mark.parametrize("length,windows,fan_in,parts", [(2048, 32, 1000, 4), (64, 3, 2, 9), (16, 1, 2, 1)])
def test_packing(docs, tokenizer, length, windows, fan_in, parts):
    frame = docs.repartition(parts)
    settings = packing.Settings(PATH, length=length, open_windows=windows, fan_in=fan_in)
    rows = packing.packed(frame, settings).collect()
    check_pieces(rows, [(r.doc_id, r.text) for r in docs.collect()], tokenizer, length)


def test_packing_odd_documents(odd_docs, no_docs, tokenizer):
    rows = packing.packed(odd_docs, packing.Settings(PATH)).collect()
    check_pieces(rows, [(r.doc_id, r.text) for r in odd_docs.collect()], tokenizer, 2048)
    assert packing.packed(no_docs, packing.Settings(PATH)).count() == 0


def test_best_fit_comes_first():
    packer = packing.Packer(10, 3)
    for k, n in enumerate((6, 3, 4, 5)):
        packer.add(packing.Piece(k, 0, np.arange(n), n))
    # 3 went to the window of 6, 4 opened one, 5 went to the window of 4.
    assert sorted(free for free, _ in packer.open) == [1, 1]
    left = packer.finish()
    assert sum(len(p.ids) for w in packer.full for p in w) == 10 and sum(len(p.ids) for p in left) == 8


def test_codes_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 59, 60, 61, 1023, 1024, 1025, 5000):
        for bits in (0, 1, 7, 16, 17, 31, 59, 60, 61, 64, None):
            wide = rng.integers(0, 65, n) if bits is None else np.full(n, bits)
            ids = np.array([int(x) & ((1 << int(b)) - 1) for x, b in zip(rng.integers(0, 1 << 63, n).astype(object) * 2 + 1, wide)], np.uint64)
            words, blocks = simple8b.encode(ids)
            assert (simple8b.decode(words, blocks, n) == ids).all()
            assert len(blocks) == -(-n // simple8b.BLOCK)
    words, _ = simple8b.encode(np.zeros(1024, np.uint64))
    assert len(words) == -(-1024 // 60)


def test_files(docs, odd_docs, no_docs, tokenizer):
    for frame, row_ids in ((docs.repartition(5), 1 << 18), (docs, 700), (odd_docs, 1 << 18), (no_docs, 10)):
        rows = sorted(simple8b.round_trip(frame, simple8b.Settings(PATH, row_ids=row_ids)).collect(), key=lambda r: r.start)
        want = sorted(((r.doc_id, r.text) for r in frame.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
        start = 0
        for r, (name, _), ids in zip(rows, want, ids_of(tokenizer, [t for _, t in want]), strict=True):
            assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (name, start, len(ids), zlib.crc32(ids.tobytes()))
            assert bytes(r.ids) == ids.tobytes()
            start += len(ids)
