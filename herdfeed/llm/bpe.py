"""BPE encoding and decoding (operator 13) by forced-boundary splitting.

For the file family "byte-level BPE with word ends, lower case": a text is normalised (NFC, lower
case), cut into runs of letters, single digits, runs of other marks and English contractions; white
space is dropped. A word's bytes are its first symbols; its last byte is a symbol of its own, as
the end mark belongs to it. A merge only ever makes a token of the vocabulary, so two symbols that
no token holds side by side are never merged across: there the text can be cut for certain. Word
ends are such places, and so are rare pairs of bytes inside words. The fragments between the cuts
are encoded each on its own, each distinct one once, and the ids are put together again.

Everything but the merges of unknown fragments is done for a chunk of texts at a time. Classes of
characters come from the library's own splitter, asked once for each code point. Fragments are
known by a 64-bit hash of their symbols, at most ``MAX_FRAGMENTS`` a worker at a time.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .piecepool import PiecePool, gather_runs, worker_kept
from .textbytes import hash_words, mix
from .tokens import read_tokenizer

MAX_FRAGMENTS = 1_000_000
#: Unknown fragments of up to so many symbols are merged side by side, longer ones one by one.
SHORT = 40
CHUNK_CHARS = 1 << 18
WORD_END = "</w>"
# The only steps before the merges that this module knows.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")
# Blocks in which a character that NFC leaves alone composes with no other.
CALM_BLOCKS = ((0x0, 0x300), (0x370, 0x483), (0x48A, 0x590), (0x2000, 0x2E80), (0x3041, 0x3097), (0x30A1, 0x30FB), (0x4E00, 0xA000), (0x1F300, 0x1FB00))
SPACE, LETTER, DIGIT, OTHER = range(4)
_NEVER = np.int64(1) << 40


def character_tables(tokenizer_json: str) -> bytes:
    """Class of every code point, by the splitter of the tokenizer's file (compressed)."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    splitter = Split(Regex(json.loads(tokenizer_json)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]), "removed", invert=True)
    classes = np.full(0x110000, OTHER, np.uint8)
    # Planes 4 to 13 are unassigned, 15 and 16 private: neither letters, digits nor white space.
    known = [c for plane in (0, 1, 2, 3, 14) for c in range(plane << 16, (plane + 1) << 16) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(known), 1 << 15):
        some = known[at:at + (1 << 15)]
        # Twice between letters, a letter makes one piece, white space two, other marks three, digits four.
        pieces = splitter.pre_tokenize_str("".join(f"a{chr(c) * 2}a " for c in some))
        count = np.bincount(np.fromiter((span[0] for _, span in pieces), np.int64, len(pieces)) // 5, minlength=len(some))
        classes[some] = np.array([OTHER, LETTER, SPACE, OTHER, DIGIT], np.uint8)[count]
    return zlib.compress(classes.tobytes())


def _check(spec: dict) -> None:
    steps = spec["pre_tokenizer"].get("pretokenizers", [])
    model = spec["model"]
    if (spec["normalizer"].get("normalizers") != NORMALIZERS or len(steps) != 2 or steps[0].get("pattern") != {"Regex": SPLIT}
            or steps[1].get("type") != "ByteLevel" or steps[1].get("use_regex") or steps[1].get("add_prefix_space") or model["type"] != "BPE"
            or model["end_of_word_suffix"] != WORD_END or model["dropout"] or model["continuing_subword_prefix"] or model["ignore_merges"]
            or spec["post_processor"] or spec["decoder"]):
        raise ValueError("not a tokenizer of byte-level BPE with word ends in lower case")
    for token in spec["added_tokens"]:
        if token["normalized"] or token["lstrip"] or token["rstrip"] or token["single_word"]:
            raise ValueError(f"added token {token['content']!r} asks for more than its own text")


class ForcedBoundaryBpe:
    """Encoder of texts and decoder of ids for a tokenizer given as its JSON text."""

    def __init__(self, tokenizer_json: str, tables: bytes | None = None, max_fragments: int = MAX_FRAGMENTS) -> None:
        from tokenizers import Tokenizer
        from tokenizers.normalizers import Lowercase
        from tokenizers.pre_tokenizers import ByteLevel

        spec = json.loads(tokenizer_json)
        _check(spec)
        self.normalizer = Tokenizer.from_str(tokenizer_json).normalizer
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added_pattern = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        self.classes = np.frombuffer(zlib.decompress(tables or character_tables(tokenizer_json)), np.uint8)
        self.lower = np.arange(0x110000, dtype=np.uint32)
        self.calm = np.zeros(0x110000, bool)
        lowercase = Lowercase()
        for first, stop in CALM_BLOCKS:
            for c in range(first, stop):
                low = lowercase.normalize_str(chr(c))
                if len(low) == 1 and unicodedata.combining(chr(c)) == 0 and unicodedata.normalize("NFC", chr(c)) == chr(c):
                    self.calm[c], self.lower[c] = True, ord(low)

        # Bytes by their letters: printable Latin-1 bytes stand for themselves, the others for
        # the characters from 256 on, in order.
        moved = [b for b in range(256) if chr(b) not in ByteLevel.alphabet()]
        letter = [chr(256 + moved.index(b)) if b in moved else chr(b) for b in range(256)]
        byte_of = np.zeros(0x200, np.uint16)
        byte_of[[ord(x) for x in letter]] = np.arange(256)
        vocab = spec["model"]["vocab"]
        self.first_ids = np.array([vocab[x] for x in letter] + [vocab[x + WORD_END] for x in letter], np.int64)

        # Which symbols stand side by side in some token.
        self.side_by_side = np.zeros((512, 512), bool)
        for token in vocab:
            body = token.removesuffix(WORD_END)
            symbols = byte_of[np.frombuffer(body.encode("utf-32-le"), np.uint32)].copy()
            if len(body) < len(token):
                symbols[-1:] += 256
            self.side_by_side[symbols[:-1], symbols[1:]] = True

        merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in spec["model"]["merges"]]
        pairs = np.array([(a << 32) | b for a, b, _ in merges], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.ranks = pairs[order], order
        self.made = np.array([c for _, _, c in merges], np.int64)

        contents = {**{i: t for t, i in vocab.items()}, **{i: t for t, i in self.added.items()}}
        shown = [(contents.get(i, "") + " ").encode() if i in contents else b"" for i in range(max(contents, default=-1) + 1)]
        self.shown_size = np.array([len(x) for x in shown], np.int64)
        self.shown_start = np.cumsum(self.shown_size) - self.shown_size
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.known = PiecePool(max_fragments, np.uint32)

    # -- merges of fragments ---------------------------------------------------------------

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's merge; ``_NEVER`` if there is none."""
        pair = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.ranks[at], _NEVER)

    def merge_side_by_side(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Final ids of many fragments: in each round every fragment does its first merge of
        least rank."""
        owner = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(ids))  # keeps the order of what is put together at the end
        done_ids, done_owner, done_place = [], [], []
        while len(ids):
            rank = np.full(len(ids), _NEVER)
            rank[:-1] = np.where(owner[:-1] == owner[1:], self._ranks_of(ids[:-1], ids[1:]), _NEVER)
            first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            best = np.minimum.reduceat(rank, first)
            more = best < _NEVER
            span = np.diff(np.append(first, len(ids)))
            going = np.repeat(more, span)
            done_ids.append(ids[~going]), done_owner.append(owner[~going]), done_place.append(place[~going])
            hit = np.flatnonzero((rank == np.repeat(best, span)) & going)
            hit = hit[np.concatenate(([True], owner[hit][1:] != owner[hit][:-1]))] if len(hit) else hit
            ids = ids.copy()
            ids[hit] = self.made[rank[hit]]
            going[hit + 1] = False
            ids, owner, place = ids[going], owner[going], place[going]
        flat, owners, places = map(np.concatenate, ((done_ids or [ids]), (done_owner or [owner]), (done_place or [place])))
        return flat[np.argsort(places)], np.bincount(owners, minlength=len(sizes))

    def merge_alone(self, ids: np.ndarray) -> np.ndarray:
        """Final ids of one fragment of any length, by a heap of its merges."""
        ranks, ids = self._ranks_of(ids[:-1], ids[1:]), ids.tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank_of = lambda a, b: int(self._ranks_of(np.int64(a), np.int64(b)))
        heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(ranks) if r < _NEVER]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.made[rank]), -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := rank_of(ids[x], ids[y])) < _NEVER:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return np.array([x for x in ids if x >= 0], np.int64)

    def _learn(self, keys: np.ndarray, symbols: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        short = size <= SHORT
        if short.any():
            flat, sizes = self.merge_side_by_side(self.first_ids[gather_runs(symbols, start[short], size[short])], size[short])
            self.known.put(keys[short], (flat, sizes))
        for k in np.flatnonzero(~short):
            ids = self.merge_alone(self.first_ids[symbols[start[k]:start[k] + size[k]]])
            self.known.put(keys[k:k + 1], (ids, np.array([len(ids)])))

    # -- texts -----------------------------------------------------------------------------

    def _segments(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Stretches between added tokens, the id that follows each (-1: none), and the last
        stretch of each text."""
        segments, follows, last = [], [], []
        for text in texts:
            at = 0
            for found in self.added_pattern.finditer(text):
                segments.append(text[at:found.start()])
                follows.append(self.added[found[0]])
                at = found.end()
            segments.append(text[at:] if at else text)
            follows.append(-1)
            last.append(len(segments))
        return segments, np.array(follows, np.int64), np.array(last, np.int64)

    def _codes(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Code points after normalisation, and the bounds of the segments in them."""
        code = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        bounds = np.concatenate(([0], np.cumsum(np.fromiter(map(len, segments), np.int64, len(segments)))))
        odd = np.flatnonzero(~self.calm[code])
        if len(odd):
            segments = list(segments)
            for k in np.unique(np.searchsorted(bounds, odd, "right") - 1):
                segments[k] = self.normalizer.normalize_str(segments[k])
            code = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
            bounds = np.concatenate(([0], np.cumsum(np.fromiter(map(len, segments), np.int64, len(segments)))))
        return self.lower[code], bounds

    def _word_ends(self, code: np.ndarray, bounds: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Whether a character is the last of its word."""
        n = len(code)
        starts = np.empty(n + 1, bool)
        starts[1:n] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        starts[bounds] = True
        quote = np.flatnonzero((code == ord("'")) & starts[:n])
        if len(quote):
            # An apostrophe that begins a run of marks takes a contraction's letters along.
            limit = bounds[np.searchsorted(bounds, quote, "right")]
            padded = np.concatenate((code, np.zeros(2, code.dtype)))
            for tail in CONTRACTIONS:
                fits = quote + len(tail) < limit
                for k, x in enumerate(tail):
                    fits &= padded[quote + 1 + k] == ord(x)
                found = quote[fits]
                starts[found + 1] = False
                starts[found + 1 + len(tail)] = True
        return starts[1:] | (np.concatenate((kind[1:], [SPACE])) == SPACE)

    def fragments(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``symbols, start, first, follows, last``: fragments lie between the starts; segment s
        has those from ``first[s]`` on, then the id ``follows[s]``; text t ends with segment
        ``last[t] - 1``."""
        segments, follows, last = self._segments(texts)
        code, bounds = self._codes(segments)
        if not len(code):
            return np.zeros(0, np.uint16), np.zeros(1, np.int64), np.zeros(len(segments) + 1, np.int64), follows, last
        kind = self.classes[code]
        ends = self._word_ends(code, bounds, kind)
        shown = kind != SPACE
        kept = code[shown]
        data = np.frombuffer(kept.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
        width = 1 + (kept >= 0x80) + (kept >= 0x800).astype(np.int64) + (kept >= 0x10000)
        upto = np.concatenate(([0], np.cumsum(width)))
        symbols = data.astype(np.uint16)
        symbols[upto[1:][ends[shown]] - 1] += 256
        cut = ~self.side_by_side[symbols[:-1], symbols[1:]]
        start = np.concatenate(([0], np.flatnonzero(cut) + 1, [len(symbols)])) if len(symbols) else np.zeros(1, np.int64)
        chars = np.concatenate(([0], np.cumsum(shown)))
        return symbols, start, np.searchsorted(start, upto[chars[bounds]]), follows, last

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and the texts' bounds in them."""
        symbols, start, first, follows, last = self.fragments(texts)
        start, size = start[:-1], np.diff(start)
        keys = mix(hash_words((symbols & 255).astype(np.uint8), start, start + size) + (symbols[start + size - 1] >> 8).astype(np.uint64) if len(start) else np.zeros(0, np.uint64))
        numbers = self.known.find(keys)
        unknown = np.flatnonzero(numbers < 0)
        if len(unknown):
            distinct, at = np.unique(keys[unknown], return_index=True)
            at = unknown[at]
            if self.known.pieces + len(distinct) > self.known.most:
                self.known.empty()
                distinct, at = np.unique(keys, return_index=True)
                if len(distinct) > self.known.most:
                    self.known = PiecePool(2 * len(distinct), np.uint32)
            self._learn(distinct, symbols, start[at], size[at])
            numbers = self.known.find(keys)
        ids, sizes = self.known.gather(numbers)
        upto = np.concatenate(([0], np.cumsum(sizes)))[first[1:]]
        added = follows >= 0
        ids = np.insert(ids, upto[added], follows[added])
        return ids, np.concatenate(([0], (upto + np.cumsum(added))[last - 1]))

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the texts that the library makes of the ids (tokens with blanks between),
        and their bounds. Ids that the vocabulary lacks say nothing."""
        inside = (ids >= 0) & (ids < len(self.shown_size))
        size = np.where(inside, self.shown_size[np.where(inside, ids, 0)], 0)
        data = gather_runs(self.shown, self.shown_start[np.where(inside, ids, 0)], size)
        upto = np.concatenate(([0], np.cumsum(size)))[bounds]
        some = upto[1:] > upto[:-1]
        return np.delete(data, upto[1:][some] - 1), np.concatenate(([0], np.cumsum(np.diff(upto) - some)))


def _kept_coder(tokenizer_json: str, tables: bytes) -> ForcedBoundaryBpe:
    key = hashlib.sha256(tokenizer_json.encode()).hexdigest()
    return worker_kept(f"bpe-{key}", lambda: ForcedBoundaryBpe(tokenizer_json, tables))


_tables: dict[str, bytes] = {}


def _shipped(tokenizer_path: str) -> tuple[str, bytes]:
    tokenizer = read_tokenizer(tokenizer_path)
    if tokenizer not in _tables:
        _tables[tokenizer] = character_tables(tokenizer)
    return tokenizer, _tables[tokenizer]


def text_groups(texts: list[str | None]):
    """Runs of whole texts of about ``CHUNK_CHARS``; NULL counts as empty."""
    group, size = [], 0
    for text in texts:
        if group and size + len(text or "") > CHUNK_CHARS:
            yield group
            group, size = [], 0
        group.append(text or "")
        size += len(text or "")
    if group:
        yield group


def encode_texts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: the ids of every whole text, as the tokenizers library gives them without
    the tokens that it adds at the ends.

    NULL and empty texts, and texts of white space, have no ids. Repeated rows are encoded each;
    NULL ids stay NULL; other columns are not read; an empty table gives none. No shuffle: a lost
    task is simply run again. Memory: a chunk of texts or the longest one, and the fragment table.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    tokenizer, tables = _shipped(tokenizer_path)

    def work(batches):
        coder = _kept_coder(tokenizer, tables)
        for batch in batches:
            at = 0
            for texts in text_groups(batch.column(1).to_pylist()):
                ids, bounds = coder.encode(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.ListArray.from_arrays(
                    pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))], names=["doc_id", "ids"])
                at += len(texts)

    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode_ids(encoded: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, ids, text``: the text that the library's ``decode`` makes of each row's ids,
    special tokens included. NULL and empty lists give the empty text (NULL lists stay NULL as
    ids); ids that the vocabulary lacks and NULLs in a list are left out, as the library does."""
    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    tokenizer, tables = _shipped(tokenizer_path)

    def work(batches):
        coder = _kept_coder(tokenizer, tables)
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            bounds = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
            first = 0
            while first < len(sizes):  # some lists at a time: the text is several times as large
                stop = max(first + 1, int(np.searchsorted(bounds, bounds[first] + CHUNK_CHARS, "right")) - 1)
                data, upto = coder.decode(flat[bounds[first]:bounds[stop]], bounds[first:stop + 1] - bounds[first])
                text = pa.LargeStringArray.from_buffers(len(upto) - 1, pa.py_buffer(upto.astype(np.int64)), pa.py_buffer(data))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, stop - first), lists.slice(first, stop - first), text.cast(pa.string())],
                                                 names=["doc_id", "ids", "text"])
                first = stop

    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, text string")
