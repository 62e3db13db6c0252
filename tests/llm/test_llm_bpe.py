"""Operator 13: forced-boundary BPE against the tokenizers library on whole texts."""

import hashlib
import random

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
from herdfeed.llm import bpe
from herdfeed.llm.bpe import ForcedBoundaryBpe, decode_ids, encode_texts, text_groups
from herdfeed.llm.common import read_table
from herdfeed.llm.queries import queries, tokenizer_path
from herdfeed.llm.tokens import read_tokenizer
from conftest import SF_SMALL
from llm_cases import ROWS, cases, empty


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def tables():
    return bpe.character_tables(read_tokenizer(tokenizer_path()))


PARTS = ["a", "e", "s", "t", "'", "'s", "'re", "'LL", "'ve", " ", "  ", "\n", "\t", "é", "É", "ß", "İ", "ΑΣ", "Σ", "1", "12", "½", "²", "!", "?", "<|endoftext|>", "<|startoftext|>", "<|endoftext",
         "<|ENDOFTEXT|>", "你", "好", "́", "é", "\xa0", "　", "​", "\u0085", "한", "ᄒ", "ᅡ", "ᆫ", "😀", "👩‍👧", "\x00", "\x1c", "the", "Hello", "WORLD", "नि", "ﬁ", "ǅ",
         "ff", "zzqx", "_", "-", "᠎", "﻿", " ", "\U000e0001", "\U000f0000", "ẍ̣", "ো"]


def texts_of(seed, n):
    rng = random.Random(seed)
    out = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(n)]
    out += ["".join(chr(rng.choice([rng.randint(32, 127), rng.randint(0, 0x2FFF), rng.randint(0xE000, 0x10FFFF)])) for _ in range(12)) for _ in range(n)]
    return out + ["", " ", "\n\n", "a" * 5000, "ab" * 300, "the" * 500 + " x", "é" * 700, "don't " * 50, "<|endoftext|>" * 3]


def check(coder, library, texts):
    for group in text_groups(texts):
        ids, bounds = coder.encode(group)
        data, at = coder.decode(ids.astype(np.int64), bounds)
        for k, want in enumerate(library.encode_batch(group, add_special_tokens=False)):
            assert ids[bounds[k]:bounds[k + 1]].tolist() == want.ids, group[k]
            assert data[at[k]:at[k + 1]].tobytes().decode() == library.decode(want.ids, skip_special_tokens=False)


@pytest.mark.parametrize("seed", range(4))
def test_fragments_together_are_whole_texts(library, tables, seed):
    check(ForcedBoundaryBpe(read_tokenizer(tokenizer_path()), tables), library, texts_of(seed, 1500))


def test_table_is_emptied_when_full(library, tables):
    check(ForcedBoundaryBpe(read_tokenizer(tokenizer_path()), tables, max_fragments=60), library, texts_of(9, 300))


def test_every_code_point(library, tables):
    code = [chr(c) for c in range(0x20, 0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}{c}b' {c}'s" for c in code[k:k + 500]) for k in range(0, 0x20000, 500)]
    check(ForcedBoundaryBpe(read_tokenizer(tokenizer_path()), tables), library, texts)


def test_cuts_are_where_no_token_goes_over(library, tables):
    coder = ForcedBoundaryBpe(read_tokenizer(tokenizer_path()), tables)
    symbols, start, *_ = coder.fragments(["thntreor the zzqx's 12 Été"])
    fragments = [symbols[a:b] for a, b in zip(start, start[1:])]
    assert sum(map(len, fragments)) == len(symbols) and len(fragments) > 8
    for a, b in zip(fragments, fragments[1:]):
        assert not coder.side_by_side[a[-1], b[0]]
    assert all(coder.side_by_side[f[:-1], f[1:]].all() for f in fragments)


@pytest.mark.parametrize("seed", range(20))
def test_both_ways_to_merge_agree(tables, seed):
    coder = ForcedBoundaryBpe(read_tokenizer(tokenizer_path()), tables)
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 60, 50)
    ids = coder.first_ids[rng.choice([97, 98, 101, 104, 110, 116], sizes.sum())]
    flat, many = coder.merge_side_by_side(ids, sizes)
    ends = np.cumsum(sizes)
    assert np.split(flat, np.cumsum(many)[:-1])[0].tolist() == coder.merge_alone(ids[:ends[0]]).tolist()
    assert flat.tolist() == [x for a, b in zip(ends - sizes, ends) for x in coder.merge_alone(ids[a:b]).tolist()]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        ForcedBoundaryBpe(read_tokenizer(tokenizer_path()).replace('"Lowercase"', '"NFD"'), b"")


def digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    shown = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(shown.encode()).hexdigest()


def test_query_on_the_whole_table(spark, library):
    rows = read_table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    got = queries()["op13_bpe"](spark, SF_SMALL).collect()
    assert sorted(tuple(r) for r in got) == sorted((r.doc_id, *digests(library, r.text)) for r in rows)


def test_odd_rows(spark, library):
    encoded = encode_texts(cases(spark), tokenizer_path())
    got = decode_ids(encoded, tokenizer_path()).collect()
    want = [(r[0], library.encode(r[1] or "", add_special_tokens=False).ids) for r in ROWS]
    assert sorted(((r.doc_id, r.ids, r.text) for r in got), key=repr) == sorted(((d, ids, library.decode(ids, skip_special_tokens=False)) for d, ids in want), key=repr)
    assert encode_texts(empty(spark), tokenizer_path()).collect() == [] == decode_ids(encode_texts(empty(spark), tokenizer_path()), tokenizer_path()).collect()


def test_decoding_odd_lists(spark, library):
    df = spark.createDataFrame([(1, None), (2, []), (3, [320, None, 10**9, 49407, -5, 320])], "doc_id long, ids array<int>")
    got = {r.doc_id: (r.ids, r.text) for r in decode_ids(df, tokenizer_path()).collect()}
    assert got == {1: (None, ""), 2: ([], ""), 3: ([320, None, 10**9, 49407, -5, 320], library.decode([320, 49407, 320], skip_special_tokens=False))}
