"""Token ids of whole texts by the ``tokenizers`` library, which sees every distinct word once.

Texts are cut at blanks and line feeds, where no token of a word-end vocabulary can cross. Words
are known by a 64-bit hash of their bytes, computed for a chunk of texts at a time; their ids
come from a table of at most ``MAX_WORDS`` words a worker, which is emptied when full. The result
equals encoding whole texts.
"""

from __future__ import annotations

import hashlib
import os
import sys
import types

import numpy as np
import pyarrow as pa

from .textbytes import hash_word_list, hash_words, text_chunks, word_bounds

MAX_WORDS = 1_000_000
_PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_BREAKS = np.ones(256, bool)
_BREAKS[[0x20, 0x0A]] = False


class _Table:
    """Hash to number, by open addressing in flat arrays; half full at most."""

    def __init__(self, most: int) -> None:
        size = 1 << (2 * most - 1).bit_length()
        self.mask = np.uint64(size - 1)
        self.key = np.zeros(size, np.uint64)
        self.number = np.full(size, -1, np.int32)

    def _places(self, keys: np.ndarray) -> np.ndarray:
        """Where each key is, or would be put."""
        at = (keys & self.mask).astype(np.int64)
        rest = np.flatnonzero((self.key[at] != keys) & (self.number[at] >= 0))
        while len(rest):
            at[rest] = (at[rest] + 1) & int(self.mask)
            rest = rest[(self.key[at[rest]] != keys[rest]) & (self.number[at[rest]] >= 0)]
        return at

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the keys, -1 where unknown."""
        return self.number[self._places(keys)]

    def add(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        """Put distinct, unknown keys."""
        while len(keys):
            at = self._places(keys)
            _, first = np.unique(at, return_index=True)  # of keys that want one place, one gets it
            self.key[at[first]], self.number[at[first]] = keys[first], numbers[first]
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, numbers = keys[rest], numbers[rest]


class WordEncoder:
    """Encodes texts with a tokenizer given as its JSON text."""

    def __init__(self, tokenizer_json: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.model = self.tokenizer.model
        # The byte-level alphabet: printable Latin-1 bytes stand for themselves, all others for
        # the characters from 256 on, in order.
        plain = {b for b in range(256) if chr(b) in ByteLevel.alphabet()}
        moved = [b for b in range(256) if b not in plain]
        self.byte_letters = {b: 256 + k for k, b in enumerate(moved)}
        self._empty()

    def _empty(self) -> None:
        self.table = _Table(MAX_WORDS)
        self.words = 0
        self.start = np.zeros(MAX_WORDS // 8, np.int64)
        self.count = np.zeros(MAX_WORDS // 8, np.int32)
        self.pool = np.zeros(MAX_WORDS, np.uint32)
        self.used = 0

    def _store(self, keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Add words; ``ids`` holds theirs one after the other."""
        stop, used = self.words + len(keys), self.used + len(ids)
        if stop > len(self.start):
            self.start, self.count = (np.concatenate((x, np.zeros(max(len(x), len(keys)), x.dtype))) for x in (self.start, self.count))
        if used > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros(max(len(self.pool), len(ids)), np.uint32)))
        self.pool[self.used:used] = ids
        self.start[self.words:stop] = self.used + np.cumsum(sizes) - sizes
        self.count[self.words:stop] = sizes
        self.table.add(keys, np.arange(self.words, stop, dtype=np.int32))
        self.words, self.used = stop, used

    def _gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and how many each has."""
        sizes = self.count[numbers].astype(np.int64)
        upto = np.cumsum(sizes)
        first = self.start[numbers] - upto + sizes
        return self.pool[np.repeat(first, sizes) + np.arange(upto[-1] if len(upto) else 0)], sizes

    def _learn(self, words: list[str], keys: np.ndarray) -> None:
        """Encode unknown words. Latin letters in lower case are one piece of the tokenizer's
        model; with capitals, or punctuation behind them, a word has the ids of its lower-case
        letters and of the punctuation, as the tokenizer lower-cases and cuts in between. All
        other words go through the whole tokenizer."""
        whole, letters, parts = [], [], []
        for k, word in enumerate(words):
            low = word.lower()
            body = low.rstrip(_PUNCTUATION)
            if not body.isalpha() or not (word.isascii() or max(word) < "̀"):
                whole.append(k)
            elif body == word:
                letters.append(k)
            else:
                parts.append((k, body, low[len(body):]))
        encoded = [x.ids for x in self.tokenizer.encode_batch_fast([words[k] for k in whole], add_special_tokens=False)]
        for k in letters:
            plain = words[k] if words[k].isascii() else words[k].encode().decode("latin-1").translate(self.byte_letters)
            encoded.append([x.id for x in self.model.tokenize(plain)])
        if encoded:
            sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
            flat = np.fromiter((i for ids in encoded for i in ids), np.uint32, int(sizes.sum()))
            self._store(keys[whole + letters], flat, sizes)
        if parts:
            pieces = [piece for _, body, tail in parts for piece in (body, tail)]
            piece_keys = hash_word_list(pieces)
            distinct, first = np.unique(piece_keys, return_index=True)
            unknown = np.flatnonzero(self.table.find(distinct) < 0)
            self._learn([pieces[i] for i in first[unknown]], distinct[unknown])
            ids, sizes = self._gather(self.table.find(piece_keys))
            # A part can have become known as a piece, never the other way round.
            self._store(keys[[k for k, _, _ in parts]], ids, sizes[::2] + sizes[1::2])

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts ``data[offsets[i]:offsets[i + 1]]`` (UTF-8), ``end_id`` after
        each, and the texts' bounds in them."""
        start, end, first = word_bounds(data, offsets, _BREAKS)
        keys = hash_words(data, start, end)
        numbers = self.table.find(keys)
        unknown = np.flatnonzero(numbers < 0)
        if len(unknown):
            distinct, at = np.unique(keys[unknown], return_index=True)
            if self.words + 2 * len(distinct) > MAX_WORDS:
                self._empty()
                distinct, at = np.unique(keys, return_index=True)
                unknown = np.arange(len(keys))
            raw = data.tobytes()
            self._learn([raw[start[i]:end[i]].decode() for i in unknown[at]], distinct)
            numbers = self.table.find(keys)
        ids, sizes = self._gather(numbers)
        ends = np.concatenate(([0], np.cumsum(sizes)))[first[1:]]
        return np.insert(ids, ends, end_id), np.concatenate(([0], ends + np.arange(1, len(ends) + 1)))


def worker_encoder(tokenizer_json: str) -> WordEncoder:
    """The encoder of this Python worker, kept from task to task."""
    kept = sys.modules.setdefault("_herdfeed_llm_worker", types.ModuleType("_herdfeed_llm_worker")).__dict__
    key = hashlib.sha256(tokenizer_json.encode()).hexdigest()
    if kept.get("encoder_key") != key:
        kept["encoder"], kept["encoder_key"] = WordEncoder(tokenizer_json), key
    return kept["encoder"]


def encoded_runs(encoder: WordEncoder, texts: pa.Array, end_id: int):
    """``(first text, ids, bounds)`` over chunks of whole texts; NULL counts as empty."""
    for first, data, offsets in text_chunks(texts):
        yield first, *encoder.encode(data, offsets, end_id)


def read_tokenizer(path: str) -> str:
    """The tokenizer's JSON, read on the driver and shipped to tasks with their function."""
    with open(path, encoding="utf-8") as f:
        return f.read()
