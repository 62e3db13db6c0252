"""Cross-tokenizer alignment (operator 11) by interval coalescing.

Tokenizer A is byte-level BPE, tokenizer B a sentencepiece model; both cover the same bytes, a blank
and the text. All tokens of both are sorted by their start; where a start reaches the running
maximum of the ends before it, a group ends. Within a group tokens overlap, and every A token is
linked to every B token.

Neither tokenizer joins a blank to what stands before it, so a text can be cut before each blank
behind a solid character, and both encodings and all groups of the stretches put together are those
of the whole text. A stretch (mostly a word with its blank) is encoded and coalesced once, and
known by a 64-bit hash, at most ``MAX_STRETCHES`` a worker at a time. Links are never formed one by one: a
group gives its distinct id pairs with their numbers of occurrences.

On Spark: one pass writes, for each block of about ``BLOCK_BYTES`` of text, its documents' figures, their
distinct pairs as numbers into the block's list of pairs, and that list with document counts. The
counts are summed over all blocks (partial sums first). A block then asks for the counts of its own
list only, so nothing is broadcast and no row is made for a document's pair. A pair that all blocks
hold makes a row a block, which Spark may split.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, unpacked, written
from .piecepool import PiecePool, gather_runs, give_back, worker_kept
from .textbytes import hash_words, text_chunks
from .tokens import read_tokenizer

MAX_STRETCHES = 200_000
#: Stretches that are encoded as one text, and that are learnt at a time.
JOINED, LEARNT = 256, 8192
BLOCK_BYTES = 4 << 20
_BLANK = 0x20
_SOLID = np.zeros(256, bool)
_SOLID[0x21:0x7F] = True
_LINK = np.dtype([("pair", np.int64), ("weight", np.int64)])


def _solid(body: np.ndarray) -> np.ndarray:
    """Whether a byte ends a character that is surely no white space: printable ASCII, or two
    bytes from U+00C0 on."""
    solid = _SOLID[body]
    solid[1:] |= (body[:-1] >= 0xC3) & (body[:-1] < 0xE0)
    return solid


def coalesce(a_end: np.ndarray, a_size: np.ndarray, b_end: np.ndarray, b_size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group of every A and of every B token, counted from 0. Tokens are given by the place
    where they end and their size, in the order of their text."""
    start = np.concatenate((a_end - a_size, b_end - b_size))
    side = np.repeat(np.array([0, 1]), (len(a_end), len(b_end)))
    order = np.lexsort((side, start))
    running = np.maximum.accumulate(np.concatenate((a_end, b_end))[order])
    group = np.empty(len(start), np.int64)
    group[order] = np.cumsum(np.concatenate(([False], start[order][1:] >= running[:-1])))
    return group[:len(a_end)], group[len(a_end):]


class Aligner:
    """Groups of texts under two tokenizers, given as JSON text and as a model's bytes."""

    def __init__(self, a_json: str, b_model: bytes, max_stretches: int = MAX_STRETCHES) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b_model)
        moved = [b for b in range(256) if chr(b) not in ByteLevel.alphabet()]
        byte_of = {chr(256 + moved.index(b)) if b in moved else chr(b): b for b in range(256)}
        a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab(with_added_tokens=False).items():
            a_bytes[i] = bytes(byte_of[x] for x in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        for piece in pieces:
            if "▁" in piece.lstrip("▁"):
                raise ValueError(f"the piece {piece!r} goes over a blank")
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        for i in range(len(pieces)):
            if self.b.is_control(i) or self.b.is_unknown(i):
                b_bytes[i] = b""
        self.sides = []
        for shown in (a_bytes, b_bytes):
            size = np.array([len(x) for x in shown], np.int64)
            self.sides.append((np.frombuffer(b"".join(shown), np.uint8), np.cumsum(size) - size, size))
        digits = [str(i).encode() for i in range(max(len(a_bytes), len(b_bytes)))]
        self.digit_size = np.array([len(x) for x in digits], np.int64)
        self.digit_start = np.cumsum(self.digit_size) - self.digit_size
        self.digits = np.frombuffer(b"".join(digits), np.uint8)
        # Of a stretch: [A tokens, B tokens, groups, links, covered?], its groups' text, its links.
        self.known = PiecePool(max_stretches, np.int64, np.uint8, _LINK)

    def stretches(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A blank before each non-empty text, and where the stretches begin: bytes, starts (and
        the end), first stretch of each text."""
        some = offsets[1:] > offsets[:-1]
        body = np.insert(data, offsets[:-1][some], _BLANK)
        bounds = offsets + np.concatenate(([0], np.cumsum(some)))
        solid = _solid(body)
        cut = np.zeros(len(body) + 1, bool)
        cut[1:-1] = (body[1:] == _BLANK) & solid[:-1]
        cut[bounds[1:][some] - 1] = False  # a blank that ends a text would be a text of its own
        cut[bounds] = True
        start = np.flatnonzero(cut)
        return body, start, np.searchsorted(start, bounds)

    def _encode_a(self, texts: list[str], size: np.ndarray, solid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the stretches one after the other, and how many each has. Stretches that end
        solid are encoded ``JOINED`` at a time as one text, which is cut apart again by bytes."""
        joins = np.flatnonzero(solid)
        alone = np.flatnonzero(~solid)
        groups = [joins[k:k + JOINED] for k in range(0, len(joins), JOINED)] + [alone[k:k + 1] for k in range(len(alone))]
        encoded = self.a.encode_batch_fast(["".join([texts[i] for i in g]) for g in groups], add_special_tokens=False)
        flat = np.concatenate([np.array(x.ids, np.int64) for x in encoded] or [np.zeros(0, np.int64)])
        order = np.concatenate((joins, alone))
        ends = np.cumsum(size[order])
        upto = np.concatenate(([0], np.searchsorted(np.cumsum(self.sides[0][2][flat]), ends, "right")))
        many = np.empty(len(texts), np.int64)
        many[order] = np.diff(upto)
        first = np.empty(len(texts), np.int64)
        first[order] = upto[:-1]
        return gather_runs(flat, first, many), many

    def _encode_b(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = self.b.encode([t[1:] for t in texts], num_threads=1)
        many = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.int64, int(many.sum())), many

    def _learn(self, keys: np.ndarray, body: np.ndarray, start: np.ndarray, size: np.ndarray, solid: np.ndarray) -> None:
        n = len(keys)
        raw = body.tobytes()
        texts = [raw[a:a + k].decode() for a, k in zip(start.tolist(), size.tolist())]
        want = gather_runs(body, start, size)
        ids, count, sizes = [], [], []
        covered = np.ones(n, bool)
        for (flat, many), (shown, at, width) in zip((self._encode_a(texts, size, solid), self._encode_b(texts)), self.sides):
            upto = np.concatenate(([0], np.cumsum(many)))
            length = np.diff(np.concatenate(([0], np.cumsum(width[flat])))[upto])
            covered &= length == size
            fits = np.repeat(length == size, many)
            same = gather_runs(shown, at[flat[fits]], width[flat[fits]]) == gather_runs(want, (np.cumsum(size) - size)[length == size], size[length == size])
            upto = np.concatenate(([0], np.cumsum(same)))[np.concatenate(([0], np.cumsum(size[length == size])))]
            covered[length == size] &= np.diff(upto) == size[length == size]
            ids.append(flat), count.append(many)
        for k in range(2):
            fits = np.repeat(covered, count[k])
            ids[k], count[k] = ids[k][fits], np.where(covered, count[k], 0)
            sizes.append(self.sides[k][2][ids[k]])
        # Covered stretches tile their bytes one after the other, so no group goes over a border.
        groups = coalesce(np.cumsum(sizes[0]), sizes[0], np.cumsum(sizes[1]), sizes[1])
        owner = [np.repeat(np.arange(n), c) for c in count]
        n_groups = int(max(groups[0][-1:].tolist() + [-1])) + 1
        group_owner = np.zeros(n_groups, np.int64)
        group_owner[groups[0]] = owner[0]
        each = [np.bincount(g, minlength=n_groups) for g in groups]
        stats = np.column_stack((count[0], count[1], np.bincount(group_owner, minlength=n),
                                 _sum_by(group_owner, each[0] * each[1], n), covered)).astype(np.int64)
        self.known.put(keys, (stats.ravel(), np.full(n, 5)), self._group_texts(ids, groups, owner, n), self._links(ids, groups, group_owner, n))

    def _group_texts(self, ids, groups, owner, n: int) -> tuple[np.ndarray, np.ndarray]:
        """``a1,a2|b1;`` of every group, by stretch."""
        every, group = np.concatenate(ids), np.concatenate(groups)
        side = np.repeat(np.array([0, 1]), (len(ids[0]), len(ids[1])))
        order = np.lexsort((side, group))
        every, group, side, who = every[order], group[order], side[order], np.concatenate(owner)[order]
        size = self.digit_size[every]
        last = np.ones(len(every), bool)
        last[:-1] = (group[1:] != group[:-1]) | (side[1:] != side[:-1])
        mark = np.where(last, np.where(side == 0, ord("|"), ord(";")), ord(",")).astype(np.uint8)
        text = np.insert(gather_runs(self.digits, self.digit_start[every], size), np.cumsum(size), mark)
        return text, _sum_by(who, size + 1, n)

    @staticmethod
    def _links(ids, groups, group_owner, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct id pairs that are linked in each stretch, with the numbers of their links."""
        held = []
        for i, g in zip(ids, groups):
            key, times = np.unique((g << 32) | i, return_counts=True)
            held.append((key >> 32, key & 0xFFFFFFFF, times))
        (ga, a, na), (gb, b, nb) = held
        first = np.searchsorted(gb, ga)
        size = np.searchsorted(gb, ga, "right") - first
        at = gather_runs(np.arange(len(b)), first, size)
        pair, weight, who = (np.repeat(a, size) << 32) | b[at], np.repeat(na, size) * nb[at], np.repeat(group_owner[ga], size)
        who, pair, weight = _sum_equal(who, pair, weight)
        out = np.zeros(len(pair), _LINK)
        out["pair"], out["weight"] = pair, weight
        return out, np.bincount(who, minlength=n)

    def align(self, data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
        """Of the texts ``data[offsets[i]:offsets[i + 1]]`` (UTF-8): ``stats`` (A tokens, B tokens,
        groups, links), ``text`` of the groups with its bounds ``text_at``, and the distinct ``pair``
        of each ``doc`` with their ``weight``. A text that isn't covered has nothing of it all."""
        body, start, first = self.stretches(data, offsets)
        start, size, n = start[:-1], np.diff(start), len(offsets) - 1
        keys = hash_words(body, start, start + size)
        numbers = self.known.find(keys)
        unknown = np.flatnonzero(numbers < 0)
        if len(unknown):
            distinct, at = np.unique(keys[unknown], return_index=True)
            at = unknown[at]
            if self.known.pieces + len(distinct) > self.known.most:
                self.known.empty()
                distinct, at = np.unique(keys, return_index=True)
                if len(distinct) > self.known.most:
                    self.known = PiecePool(2 * len(distinct), *self.known.dtypes)
            solid = _solid(body)[start[at] + size[at] - 1]
            for k in range(0, len(distinct), LEARNT):
                some = slice(k, k + LEARNT)
                self._learn(distinct[some], body, start[at[some]], size[at[some]], solid[some])
            numbers = self.known.find(keys)
        stats = self.known.gather(numbers)[0].reshape(-1, 5)
        upto = np.vstack((np.zeros((1, 5), np.int64), np.cumsum(stats, axis=0)))[first]
        total = np.diff(upto, axis=0)
        covered = total[:, 4] == np.diff(first)
        held = np.repeat(covered, np.diff(first))
        numbers, who = numbers[held], np.repeat(np.arange(n), np.diff(first))[held]
        text, text_size = self.known.gather(numbers, 1)
        # A stretch's links count once for each time that the text holds it.
        key, times = np.unique((who << 32) | numbers, return_counts=True)
        links, many = self.known.gather(key & 0xFFFFFFFF, 2)
        doc, pair, weight = _sum_equal(np.repeat(key >> 32, many), links["pair"], links["weight"] * np.repeat(times, many))
        return {"stats": np.where(covered[:, None], total[:, :4], 0), "text": text,
                "text_at": np.concatenate(([0], np.cumsum(_sum_by(who, text_size, n)))), "doc": doc, "pair": pair, "weight": weight}


def _sum_by(who: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Exact sums by owner; owners come in ascending order."""
    at = np.searchsorted(who, np.arange(n + 1))
    return np.diff(np.concatenate(([0], np.cumsum(values)))[at])


def _sum_equal(who: np.ndarray, pair: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row for each ``(who, pair)``, in that order, with its weights' sum."""
    if not len(who):
        return who, pair, weight
    order = np.lexsort((pair, who))
    who, pair, weight = who[order], pair[order], weight[order]
    first = np.flatnonzero(np.concatenate(([True], (who[1:] != who[:-1]) | (pair[1:] != pair[:-1]))))
    return who[first], pair[first], np.add.reduceat(weight, first)


def aligned_blocks(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
                   with_groups: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block of documents: their figures, the distinct pairs of each as numbers into
    the block's sorted ``pairs`` with weights, and in how many of its documents a pair stands."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    a_json = read_tokenizer(a_path)
    with open(b_path, "rb") as f:
        b_model = f.read()
    key = hashlib.sha256(a_json.encode() + b_model).hexdigest()

    def work(batches):
        aligner = worker_kept(f"align-{key}", lambda: Aligner(a_json, b_model))
        block = TaskContext.get().partitionId() << 32
        held: dict[str, list] = {}
        size = n_docs = 0
        id_type = pa.null()

        def flush():
            nonlocal block, size, n_docs
            joined = {k: np.concatenate(held[k]) for k in ("stats", "doc", "pair", "weight")}
            pairs, at = np.unique(joined["pair"], return_inverse=True)
            row = {"block": pa.array([block], pa.int64()), "doc_ids": pa.array([held["names"]], pa.list_(id_type))}
            for k, name in enumerate(("n_a", "n_b", "n_groups", "n_links")):
                row[name] = pa.array([joined["stats"][:, k]], pa.list_(pa.int64()))
            row["shas"] = pa.array([held["shas"]], pa.list_(pa.string()))
            row["bounds"] = np.searchsorted(joined["doc"], np.arange(n_docs + 1)).astype("<i8").tobytes()
            row["at"], row["weights"] = packed(at), packed(joined["weight"])
            row["pairs"], row["n_docs"] = pairs.astype("<i8").tobytes(), np.bincount(at, minlength=len(pairs)).astype("<i8").tobytes()
            row = {k: pa.array([v], pa.binary()) if isinstance(v, bytes) else v for k, v in row.items()}
            if with_groups:
                row["groups"] = pa.array([held["groups"]], pa.list_(pa.string()))
            held.clear()
            give_back()
            block, size, n_docs = block + 1, 0, 0
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            id_type = batch.column(0).type
            names = batch.column(0).to_pylist()
            for first, data, offsets in text_chunks(batch.column(1)):
                found = aligner.align(data, offsets)
                n = len(offsets) - 1
                raw, ends = found["text"].tobytes(), found["text_at"].tolist()
                texts = [raw[a:max(a, b - 1)] for a, b in zip(ends, ends[1:])]
                found["doc"] += n_docs
                for k in ("stats", "doc", "pair", "weight"):
                    held.setdefault(k, []).append(found[k])
                held.setdefault("names", []).extend(names[first:first + n])
                held.setdefault("shas", []).extend(hashlib.sha256(t).hexdigest() if t else "" for t in texts)
                if with_groups:
                    held.setdefault("groups", []).extend(t.decode() for t in texts)
                size, n_docs = size + len(data), n_docs + n
                if size >= block_bytes:
                    yield flush()
        if n_docs:
            yield flush()

    schema = (f"block long, doc_ids array<{kind}>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
              "shas array<string>, bounds binary, at binary, weights binary, pairs binary, n_docs binary" + ", groups array<string>" * with_groups)
    return written(rows.mapInArrow(work, schema), "aligned")


def _block_pairs(blocks: DataFrame) -> DataFrame:
    """``block, pair, n``: the list of every block, opened."""

    def work(batches):
        for batch in batches:
            for block, pairs, n in zip(*(c.to_pylist() for c in batch.columns)):
                pairs = np.frombuffer(pairs, "<i8")
                yield pa.RecordBatch.from_pydict({"block": np.full(len(pairs), block), "pair": pairs, "n": np.frombuffer(n, "<i8")})

    return blocks.select("block", "pairs", "n_docs").mapInArrow(work, "block long, pair long, n long")


def link_counts(blocks: DataFrame) -> DataFrame:
    """``pair, n_docs, is_best``: in how many documents an id pair is linked, and whether no other
    pair of its A id stands in more. ``pair`` is the A id times 2**32 plus the B id."""
    counts = written(_block_pairs(blocks).groupBy("pair").agg(F.sum("n").alias("n_docs")), "links")
    a_id = F.shiftright("pair", 32).alias("a_id")
    most = counts.groupBy(a_id).agg(F.max("n_docs").alias("most"))
    return counts.withColumn("a_id", a_id).join(most, "a_id").select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("is_best"))


def align_documents(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
                    with_groups: bool = False) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document
    (and ``groups``, their text, if ``with_groups``).

    A pair's count is the number of rows whose text holds it linked. NULL and empty texts, and
    those that a tokenizer doesn't cover byte by byte, have zeros and an empty digest. Repeated rows
    are documents of their own; NULL ids stay NULL; other columns are not read; an empty table
    gives none. Memory: a block of texts or the longest one, and the stretch table.
    """
    blocks = aligned_blocks(docs, a_path, b_path, id_col, text_col, with_groups)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    answers = _block_pairs(blocks).select("block", "pair").join(link_counts(blocks), "pair").select("block", "pair", "n_docs", "is_best")
    asked = blocks.drop("pairs", "n_docs")

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        row = {c: left[c][0] for c in left.column_names}
        pair, n, best = (right[c].to_numpy() for c in ("pair", "n_docs", "is_best"))
        order = np.argsort(pair)
        n, best = n[order].astype(np.int64), best[order].astype(np.int64)
        bounds, at, weights = np.frombuffer(row["bounds"].as_py(), "<i8"), unpacked(row["at"].as_py()), unpacked(row["weights"].as_py())
        sums = [np.diff(np.concatenate(([0], np.cumsum(weights * x[at])))[bounds]) for x in (best, n)]
        out = {"doc_id": row["doc_ids"].values} | {c: row[c].values for c in ("n_a", "n_b", "n_groups", "n_links")}
        out |= {"n_best": pa.array(sums[0], pa.int64()), "count_sum": pa.array(sums[1], pa.int64()), "groups_sha256": row["shas"].values}
        if with_groups:
            out["groups"] = row["groups"].values
        return pa.table(out)

    return asked.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        work, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string" + ", groups string" * with_groups)
