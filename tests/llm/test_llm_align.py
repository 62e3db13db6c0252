"""Operator 11: alignment against token by token comparison of whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

P = pytest.importorskip("public_tokenizers")
from herdfeed.llm import align
from herdfeed.llm.align import Aligner, align_documents, aligned_blocks, coalesce, link_counts
from herdfeed.llm.common import packed, read_table, unpacked
from herdfeed.llm.piecepool import PiecePool
from herdfeed.llm.queries import queries
from herdfeed.llm.textbytes import text_chunks
from conftest import SF_SMALL
from llm_cases import PLAIN, ROWS, cases, empty

A_PATH, B_PATH = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Brute:
    def __init__(self):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(A_PATH), SentencePieceProcessor(model_file=B_PATH)
        self.a.encode_special_tokens = True
        # The byte-level alphabet.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.letters = {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in plain)}
        self.token = {i: t for t, i in self.a.get_vocab().items()}

    def groups(self, text):
        """[(A ids, B ids)], or None where the tokens don't cover the text."""
        if not text:
            return None
        want = (" " + text).encode()
        ids = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        shown = ([bytes(self.letters[c] for c in self.token[i]) for i in ids[0]],
                 [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]])
        if any(b"".join(x) != want for x in shown):
            return None
        ends = [np.cumsum([len(x) for x in s]).tolist() for s in shown]
        out, at = [], [0, 0]
        for cut in sorted(set(ends[0]) & set(ends[1])):
            group = []
            for k in range(2):
                stop = ends[k].index(cut, at[k]) + 1
                group.append(ids[k][at[k]:stop])
                at[k] = stop
            out.append(tuple(group))
        return out

    def table(self, texts):
        """Rows of :func:`align_documents` for the texts, in their order."""
        found = [self.groups(t) for t in texts]
        links = [Counter((a, b) for ga, gb in g or () for a in ga for b in gb) for g in found]
        count = Counter(pair for held in links for pair in held)
        most = {}
        for (a, _), n in count.items():
            most[a] = max(most.get(a, 0), n)
        rows = []
        for g, held in zip(found, links):
            shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g or ())
            rows.append((sum(len(a) for a, _ in g or ()), sum(len(b) for _, b in g or ()), len(g or ()), sum(held.values()),
                         sum(n for p, n in held.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in held.items()),
                         hashlib.sha256(shown.encode()).hexdigest() if shown else ""))
        return rows


@pytest.fixture(scope="module")
def brute():
    return Brute()


PARTS = ["a", "e", "s", "t", "'", "'s", "'re", " ", " ", "  ", "   ", "\n", "\t", " \n", "é", "É", "1", "12", "½", "!", "?", "<|endoftext|>", "</s>", "<0x41>", "你", "好", "　", "​",
         "\u0085", "\xa0", "한", "😀", "👩‍👧", "\x00", "\x1c", "the", "Hello", "WORLD", "▁", "ﬁ", "zzqx", "_", "-", "﻿", "thntreor", " . ", "\r\n", "a b c", " "]


def texts_of(rng, n):
    out = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(n)]
    out += ["".join(chr(rng.choice([32, rng.randint(32, 127), rng.randint(0, 0x2FFF), rng.randint(0xE000, 0x10FFFF)])) for _ in range(12)) for _ in range(n // 2)]
    return out + ["a" * 5000, "ab" * 300, "the" * 500 + " x", "é" * 700, " " * 300, " ", "  ", "a ", " a", "", None]


@pytest.mark.parametrize("most", [1_000_000, 50])
def test_stretches_together_are_whole_texts(brute, most):
    texts = texts_of(random.Random(most), 1500)
    with open(A_PATH, encoding="utf-8") as a, open(B_PATH, "rb") as b:
        own = Aligner(a.read(), b.read(), max_stretches=most)
    for first, data, offsets in text_chunks(pa.array(texts)):
        found = own.align(data, offsets)
        raw, at = found["text"].tobytes(), found["text_at"]
        held = {}
        for doc, pair, weight in zip(found["doc"].tolist(), found["pair"].tolist(), found["weight"].tolist()):
            held.setdefault(doc, {})[pair >> 32, pair & 0xFFFFFFFF] = weight
        for k in range(len(offsets) - 1):
            want = brute.groups(texts[first + k]) or []
            assert raw[at[k]:max(at[k], at[k + 1] - 1)].decode() == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in want), texts[first + k]
            assert held.get(k, {}) == Counter((a, b) for ga, gb in want for a in ga for b in gb)
            assert found["stats"][k].tolist() == [sum(len(a) for a, _ in want), sum(len(b) for _, b in want), len(want), sum(len(a) * len(b) for a, b in want)]


def test_coalescing():
    sizes = np.array([2, 3, 1, 4]), np.array([1, 1, 4, 2, 2])
    a, b = coalesce(np.cumsum(sizes[0]), sizes[0], np.cumsum(sizes[1]), sizes[1])
    assert a.tolist() == [0, 1, 1, 2] and b.tolist() == [0, 0, 1, 2, 2]


def rows_of(df):
    return sorted(((r.doc_id, tuple(r[c] for c in COLUMNS)) for r in df.collect()), key=repr)


def wanted(brute, rows):
    return sorted(((r[0], w) for r, w in zip(rows, brute.table([r[1] for r in rows]))), key=repr)


def test_query_on_the_whole_table(spark, brute):
    rows = read_table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    assert rows_of(queries()["op11_alignment"](spark, SF_SMALL)) == wanted(brute, rows)


def test_odd_rows_in_many_blocks(spark, brute, monkeypatch):
    rows = ROWS + [(100 + k, t, None) for k, t in enumerate(texts_of(random.Random(4), 60))]
    df = cases(spark, rows).repartition(5)
    own = align_documents(df, A_PATH, B_PATH, with_groups=True)
    assert rows_of(own) == wanted(brute, rows)
    assert all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 if r.groups else r.groups_sha256 == "" for r in own.collect())
    monkeypatch.setattr(align, "aligned_blocks", lambda *a: aligned_blocks(*a, block_bytes=40))
    assert rows_of(align_documents(df, A_PATH, B_PATH)) == wanted(brute, rows)
    assert rows_of(align_documents(empty(spark), A_PATH, B_PATH)) == []


def test_link_counts(spark, brute):
    rows = [r for r in ROWS if r[1]]
    count = Counter(pair for r in rows for pair in {(a, b) for ga, gb in brute.groups(r[1]) or () for a in ga for b in gb})
    got = link_counts(aligned_blocks(cases(spark, rows), A_PATH, B_PATH, block_bytes=100)).collect()
    assert {(r.pair >> 32, r.pair & 0xFFFFFFFF): r.n_docs for r in got} == dict(count) and len(got) == len(count)
    assert all(r.is_best == (r.n_docs == max(n for (a, _), n in count.items() if a == r.pair >> 32)) for r in got)


def test_a_block_holds_few_bytes_for_each_pair(spark, brute):
    texts = [PLAIN, PLAIN + " and on", " the" * 400, "the " * 70_000, None]
    df = cases(spark, [(k, t, None) for k, t in enumerate(texts)]).coalesce(1)
    blocks = aligned_blocks(df, A_PATH, B_PATH).collect()
    n = sum(len({(a, b) for ga, gb in brute.groups(t) or () for a in ga for b in gb}) for t in texts)
    assert sum(len(r["at"]) - 1 for r in blocks) == n
    small = aligned_blocks(df.filter("doc_id < 2"), A_PATH, B_PATH).collect()
    assert all(len(r["weights"]) == len(r["at"]) for r in small) and max(unpacked(bytes(r["weights"])).max() for r in blocks) > 65_535
    rows = list(enumerate(texts))
    assert rows_of(align_documents(df, A_PATH, B_PATH)) == wanted(brute, rows)


@pytest.mark.parametrize("most,width", [(0, 1), (255, 1), (256, 2), (65_535, 2), (65_536, 4), (1 << 32, 8)])
def test_numbers_in_few_bytes(most, width):
    numbers = np.array([0, most, 1], np.int64)
    raw = packed(numbers)
    assert len(raw) == 1 + 3 * width and unpacked(raw).tolist() == numbers.tolist() and unpacked(raw).dtype == np.int64
    assert unpacked(packed(numbers[:0])).tolist() == []


def test_piece_pool_gives_what_was_put_and_holds_little_more():
    rng, pool, want = np.random.default_rng(3), PiecePool(40_000, np.int64, np.uint8), {}
    for _ in range(40):
        keys = rng.integers(1, 1 << 62, 1000, dtype=np.uint64)
        columns = [(rng.integers(0, 200, int(n.sum())).astype(t), n) for t in (np.int64, np.uint8) for n in [rng.integers(0, 9, 1000)]]
        pool.put(keys, *columns)
        cut = [np.split(flat, np.cumsum(n)[:-1]) for flat, n in columns]
        want |= {k: [c[i].tolist() for c in cut] for i, k in enumerate(keys.tolist())}
    keys = rng.permutation(np.array(list(want), np.uint64))
    for c in range(2):
        flat, sizes = pool.gather(pool.find(keys), c)
        assert [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])] == [want[k][c] for k in keys.tolist()]
    held = sum(x.nbytes for x in (*pool.start, *pool.pool))
    assert held <= 1.5 * (2 * 8 * (pool.pieces + 1) + 8 * pool.used[0] + pool.used[1])


def test_stretches_of_a_worker_take_bounded_memory():
    rng = np.random.default_rng(5)
    text = " ".join(np.char.add("w", rng.integers(0, 1 << 40, 260_000).astype(str)).tolist())
    with open(A_PATH, encoding="utf-8") as a, open(B_PATH, "rb") as b:
        own = Aligner(a.read(), b.read())
    for at in range(0, len(text), 1 << 18):
        data = np.frombuffer(text[at:at + (1 << 18)].encode(), np.uint8)
        own.align(data, np.array([0, len(data)]))
    pool = own.known
    arrays = [*[v for v in vars(pool).values() if isinstance(v, list)], [pool.table.key, pool.table.number]]
    assert sum(x.nbytes for held in arrays for x in held if isinstance(x, np.ndarray)) < 110e6
