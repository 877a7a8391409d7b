"""Token ids of whole batches of texts by a given public tokenizer, whose ids words determine.

The tokenizer splits at white space, so a text's ids are those of its words in a row.  Each word
is tokenized once by a worker and its ids are kept; texts are then put together from kept ids by
array operations.  Texts with the opening of a special token take the tokenizer's own way.  So do
all texts of a tokenizer whose file does not say that it prepares and splits texts as ``WORDWISE``
has it: only of these is it known that a text's ids are those of its words.
"""

from __future__ import annotations

import json
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa

from tidemark.llm.words import blocks, text_bytes, words_of

SPECIAL = b"<|"
BLOCK = 1 << 20
MARKS = ".,;:!?"
# Fixed values, as the tokenizer file gives them: white space made alike, lower case, words split at it.
WORDWISE = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
}
# Letters up to here are lower-cased alike everywhere.
PLAIN = "İ"


def _byte_letters() -> dict[int, str]:
    """How byte-level tokenizers write bytes as letters: printable ones as they are."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + k) for k, b in enumerate(hidden)}}


class Encoder:
    """Keeps at most ``most_words`` words."""

    def __init__(self, path: str, most_words: int = 1_500_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.most_words = self.tokenizer.model, most_words
        said = json.loads(self.tokenizer.to_str())
        special = all(t["content"].startswith("<|") and not t["normalized"] for t in said["added_tokens"])
        self.by_word = special and said["model"]["type"] == "BPE" and all(said[k] == v for k, v in WORDWISE.items())
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.letters = _byte_letters()
        self.marks: dict[str, list[int]] = {}
        self._forget()

    def _forget(self) -> None:
        self.keys, self.first, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.filled = np.zeros(1 << 16, self.kind), 0

    def _slow(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, word: str) -> list[int] | None:
        """Ids of letters followed by marks, straight from the model; None for other words."""
        core = word.rstrip(MARKS)
        tail = word[len(core) :]
        if not core.isalpha():
            return None
        if core.isascii():
            core = core.lower()
        elif max(core) >= PLAIN or not unicodedata.is_normalized("NFC", core):
            return None
        else:
            core = core.lower().encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.model.tokenize(core)]
        if tail:
            if tail not in self.marks:
                self.marks[tail] = self._slow([tail])[0]
            ids += self.marks[tail]
        return ids

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        found = [self._word(w) for w in words]
        hard = [k for k, ids in enumerate(found) if ids is None]
        for k, ids in zip(hard, self._slow([words[k] for k in hard])):
            found[k] = ids
        count = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), self.kind, int(count.sum()))
        if self.filled + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.filled], np.zeros(max(len(flat), self.filled) + len(flat), self.kind)])
        self.pool[self.filled : self.filled + len(flat)] = flat
        first = self.filled + np.cumsum(count) - count
        self.filled += len(flat)
        at = np.searchsorted(self.keys, keys)
        self.keys, self.first, self.count = (
            np.insert(a, at, b) for a, b in ((self.keys, keys), (self.first, first), (self.count, count))
        )

    def _block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words = words_of(data, offsets, lower=True)
        keys, example, code = np.unique(words.hash, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.most_words:
            self._forget()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        if len(new):
            text = data.tobytes()
            spans = zip(words.start[example[new]].tolist(), words.end[example[new]].tolist())
            self._learn(keys[new], [text[s:e].decode() for s, e in spans])
            at = np.searchsorted(self.keys, keys)
        count, first = self.count[at][code], self.first[at][code]
        ends = np.concatenate([[0], np.cumsum(count)])
        ids = self.pool[np.arange(ends[-1]) + np.repeat(first - ends[:-1], count)]
        return ids, ends[words.first]

    def encode(self, column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows in a row, each row closed by ``end``; offsets of the rows)."""
        data, offsets = text_bytes(column)
        parts, sizes = [], []
        for a, b in blocks(offsets, BLOCK):
            part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            text = part.tobytes()
            if self.by_word and SPECIAL not in text:
                ids, bounds = self._block(part, own)
            else:
                each = [self._row(part[s:e], text[s:e]) for s, e in zip(own[:-1], own[1:])]
                ids = np.concatenate([*each, np.zeros(0, self.kind)])
                bounds = np.concatenate([[0], np.cumsum([len(x) for x in each])])
            closed = np.full(len(ids) + b - a, end, self.kind)
            own_end = bounds[1:] + np.arange(b - a)
            keep = np.ones(len(closed), bool)
            keep[own_end] = False
            closed[keep] = ids
            parts.append(closed)
            sizes.append(np.diff(bounds) + 1)
        flat = np.concatenate([*parts, np.zeros(0, self.kind)])
        return flat, np.concatenate([[0], np.cumsum(np.concatenate([*sizes, np.zeros(0, np.int64)]))]).astype(np.int64)

    def _row(self, part: np.ndarray, text: bytes) -> np.ndarray:
        if self.by_word and SPECIAL not in text:
            return self._block(part, np.array([0, len(part)]))[0]
        return np.array(self._slow([text.decode()])[0], self.kind)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
