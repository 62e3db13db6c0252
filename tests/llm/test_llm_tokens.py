"""Operators 1 and 2: packing and token files, against encoding whole texts."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("public_tokenizers")
from herdfeed.llm.common import shared_path
from herdfeed.llm.packing import Packer, fill_window, pack_documents
from herdfeed.llm.queries import queries, tokenizer_path
from herdfeed.llm.tokenbin import OFFSET_WORDS, decode_block, encode_block, read_token_files, write_token_files
from herdfeed.llm.tokens import WordEncoder, encoded_runs, read_tokenizer
from conftest import SF_SMALL
from llm_cases import ROWS, cases, empty


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(read_tokenizer(tokenizer_path()))


def whole(encoder, text, end):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [end]


WORDS = ["Don't", "IT'S", "we'll,", "x<|endoftext|>y", "İstanbul", "ΑΣΑΣ.", "é̈́", "가각", "日本語テスト", "a" * 3000, "1,234.5", "--", "É!!", "ß?", "ﬁ", "\x85", "\xa0z", "\x1c",
         "'s", "o'clock'", "naïve...", "(THE)", "the", "The", "THE!", "_a_", "A1b"]


def test_word_by_word_equals_whole_texts(encoder):
    rng = np.random.default_rng(3)
    texts = [None, "", " ", "\n\n"] + [sep.join(rng.choice(WORDS, rng.integers(1, 12))) for sep in (" ", "\n", "  ", "\t", " \n") for _ in range(60)]
    got = [ids[a:b].tolist() for _, ids, bounds in encoded_runs(encoder, pa.array(texts), 7) for a, b in zip(bounds, bounds[1:])]
    assert got == [whole(encoder, t, 7) for t in texts]


def test_word_table_is_emptied_when_full(encoder, monkeypatch):
    import herdfeed.llm.tokens as tokens

    monkeypatch.setattr(tokens, "MAX_WORDS", 16)
    own = WordEncoder(read_tokenizer(tokenizer_path()))
    emptied = []
    monkeypatch.setattr(own, "_empty", lambda f=own._empty: (emptied.append(1), f()))
    for text in ("A! b? c d e f", "f e d x y z u v w", "a x, y. Z", "a b c d e f g h i j k l m n o p q r s t u v w x y z"):
        (_, ids, _), = encoded_runs(own, pa.array([text]), 1)
        assert ids.tolist() == whole(encoder, text, 1)
    assert emptied


@pytest.mark.parametrize("seed", range(30))
def test_fill_window_is_the_best_subset(seed):
    rng = np.random.default_rng(seed)
    counts = {int(k): int(rng.integers(1, 4)) for k in rng.integers(1, 40, 5)}
    capacity = int(rng.integers(0, 90))
    sums = {0}
    for length, n in counts.items():
        sums = {s + length * k for s in sums for k in range(n + 1)}
    chosen = fill_window(counts, capacity)
    assert all(chosen[k] <= counts[k] for k in chosen)
    assert sum(k * n for k, n in chosen.items()) == max(s for s in sums if s <= capacity)


@pytest.mark.parametrize("window", [16, 64])
def test_packer_keeps_every_id_once_and_pads_little(window):
    rng = np.random.default_rng(window)
    docs = [rng.integers(0, 99, rng.integers(1, 200)) for _ in range(6000)]
    packer = Packer(window, 5)
    for k, ids in enumerate(docs):
        packer.add(k, ids)
    packer.finish()
    at, own = defaultdict(int), defaultdict(list)
    for document, start, ids, sequence, offset in packer.drain():
        assert offset == at[sequence] and 0 < len(ids)
        at[sequence] += len(ids)
        own[document].append((start, ids.tolist()))
    assert all(n == window or n & (n - 1) == 0 and n < window for n in at.values())
    assert sum(n != window for n in at.values()) <= window.bit_length()
    for k, ids in enumerate(docs):
        assert sum((x for _, x in sorted(own[k])), []) == ids.tolist()


def test_pack_cases(spark, encoder):
    got = defaultdict(list)
    rows = pack_documents(cases(spark), tokenizer_path(), with_ids=True).collect()
    for r in rows:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        got[r.doc_id].append((r.start, r.ids, r.doc_tokens))
    for key in {k for k, _, _ in ROWS}:
        want = sorted(whole(encoder, t, 1) for k, t, _ in ROWS if k == key)
        assert sorted(i for _, ids, _ in got[key] for i in ids) == sorted(i for ids in want for i in ids)
    assert pack_documents(empty(spark), tokenizer_path()).collect() == []


@pytest.mark.parametrize("name", ["op1_packing", "op2_token_files"])
def test_queries_against_whole_texts(spark, encoder, name):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = queries()[name](spark, SF_SMALL).collect()
    end = 1 if name[2] == "1" else 2
    ids = {k: np.array(whole(encoder, t, end), "<u4") for k, t in docs.items()}
    if end == 2:
        before = 0
        for r in sorted(rows, key=lambda r: r.doc_id):
            assert (r.start, r.n_tokens, r.ids_crc32) == (before, len(ids[r.doc_id]), zlib.crc32(ids[r.doc_id].tobytes()))
            before += r.n_tokens
        assert len(rows) == len(docs)
        return
    upto, used = defaultdict(int), defaultdict(int)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == upto[r.doc_id] and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes())
        upto[r.doc_id] += r.length
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used[r.sequence_id]
        used[r.sequence_id] += r.length
    assert upto == {k: len(v) for k, v in ids.items()} and max(used.values()) == 2048
    assert sum(2048 - n for n in used.values() if n & (n - 1)) == 0


@pytest.mark.parametrize("seed", range(40))
def test_block_round_trip(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(0, 3000))
    width = rng.integers(0, 65 if seed % 2 else 17, n)
    x = np.where(width == 0, 0, rng.integers(1 << 62, 1 << 63, n, dtype=np.uint64) * np.uint64(2) >> np.minimum(64 - width, 63).astype(np.uint64)).astype(np.uint64)
    if seed % 5 == 0:
        x[rng.random(n) < 0.99] = 0
    payload = encode_block(x)
    assert (decode_block(payload, n) == x).all()
    groups = int(np.frombuffer(payload, "<u4", 3)[1])
    if groups > 1:
        at = int(np.frombuffer(payload, "<u4", groups, 12 + 8 * int(np.frombuffer(payload, "<u4", 1)[0]))[1])
        assert (decode_block(payload, n, 1) == x[at:]).all() and at >= OFFSET_WORDS


def test_small_ids_take_few_bits():
    assert len(encode_block(np.zeros(24_000, np.uint64))) < 1000
    assert len(encode_block(np.full(24_000, 40_000, np.uint64))) < 24_000 * 2.8


def test_token_file_cases(spark, encoder):
    path = shared_path(spark, "test-tokens")
    write_token_files(cases(spark), path, tokenizer_path())
    rows = sorted(read_token_files(spark, path, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((k for k, _, _ in ROWS), key=lambda k: (k is not None, k))
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows[:-1]]).tolist()
    assert sorted((r.doc_id or -1, r.ids) for r in rows) == sorted((k or -1, whole(encoder, t, 2)) for k, t, _ in ROWS)
    path = shared_path(spark, "test-tokens")
    write_token_files(empty(spark), path, tokenizer_path())
    assert read_token_files(spark, path).collect() == []
