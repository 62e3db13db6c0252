"""The pipeline's stages on planted and odd rows, and its query end to end."""

import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from conftest import SF_SMALL
from herdfeed.llm.common import PARTIAL_COUNTS, partial_counts, sum_counts
from herdfeed.llm.components import connected_components
from llm_cases import PLAIN, ROWS, cases, empty


def test_stages_are_the_named_ones():
    assert [name for name, _ in P.STAGES] == ["toxicity", "language ID", "n-gram Jaccard join", "benchmark decontamination", "packing"]


@pytest.mark.parametrize("k", range(len(P.STAGES)))
def test_stage_takes_odd_rows_and_empty_tables(spark, k):
    docs = cases(spark)
    out = P.STAGES[k][1](spark, docs, SF_SMALL)
    if k < len(P.STAGES) - 1:
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    assert out.count() > 0
    assert P.STAGES[k][1](spark, empty(spark), SF_SMALL).count() == 0


def shingles_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[k:k + 3]) for k in range(max(1, len(words) - 2))} if words else set()


def groups_of(rows):
    """Groups of row numbers, by all pairs."""
    sets = [shingles_of(r[1]) for r in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    return [[k for k, x in enumerate(root) if x == r] for r in sorted(set(root))]


@pytest.mark.parametrize("repeat", [1, 3])
def test_near_duplicates_keep_one_row_of_each_group(spark, repeat):
    rows = ROWS * repeat + [(1, "an unlinked text under the same id", "en"), (20, PLAIN + " so", "en"), (None, "an unlinked text without an id", "en"), (0, None, "en")]
    got = sorted([(r.doc_id, r.text) for r in P.drop_near_duplicates(spark, cases(spark, rows), SF_SMALL).collect()], key=repr)
    groups = groups_of(rows)
    assert len(got) == len(groups)
    for group in groups:
        ids = [rows[k][0] for k in group if rows[k][0] is not None]
        least = {(rows[k][0], rows[k][1]) for k in group if rows[k][0] == (min(ids) if ids else None)}
        assert any(x in got for x in least)
    assert {(1, "an unlinked text under the same id"), (None, "an unlinked text without an id")} <= set(got)


def test_stages_on_a_whole_table_row_by_row(spark):
    """Toxicity, language and packing stages against the models' decisions text by text."""
    from herdfeed.llm import langid, toxicity
    from herdfeed.llm.common import id_remainder
    from herdfeed.llm.queries import tokenizer_path
    from herdfeed.llm.tokens import WordEncoder, read_tokenizer

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = docs.collect()
    model = toxicity.train(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"), id_remainder("doc_id", 3) != 1)
    assert sorted(P.drop_toxic(spark, docs, SF_SMALL).collect()) == sorted(r for r in rows if model.score(r.text) < 0.7)
    model = langid.train(docs, id_remainder("doc_id", 4) != 2)
    told = {r.doc_id: model.predict(r.text) for r in rows}
    out = P.drop_unknown_language(spark, docs, SF_SMALL).collect()
    assert sorted(out) == sorted(r for r in rows if told[r.doc_id][0] != "und" and told[r.doc_id][1] >= 0.3)
    assert len(out) >= 0.98 * len(rows)
    encode = WordEncoder(read_tokenizer(tokenizer_path())).tokenizer.encode
    ids = {r.doc_id: encode(r.text or "", add_special_tokens=False).ids + [1] for r in rows}
    pieces = defaultdict(list)
    for r in P.pack(spark, docs, SF_SMALL).collect():
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32))
    for doc_id, own in ids.items():
        at = 0
        for start, length, crc in sorted(pieces[doc_id]):
            assert start == at and crc == zlib.crc32(np.array(own[at:at + length], "<u4").tobytes())
            at += length
        assert at == len(own)


def test_benchmark_passages_go_and_clean_rows_stay(spark):
    item = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(1, PLAIN, "en"), (2, f"{PLAIN} {item} {PLAIN}", "en"), (3, item, "en")]
    out = {r.doc_id: r for r in P.cut_benchmark(spark, cases(spark, rows), SF_SMALL).collect()}
    assert set(out) == {1, 2} and out[1].text == PLAIN
    assert item not in out[2].text and out[2].text.startswith(PLAIN) and out[2].n_chars == len(out[2].text)


def test_pipeline_end_to_end(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = P.run(spark, SF_SMALL).toPandas()
    assert 0 < out.doc_id.nunique() <= docs.count()
    assert (out.groupby("doc_id").length.sum() == out.groupby("doc_id").doc_tokens.first()).all()
    used = out.groupby("sequence_id").length.sum()
    assert ((used == 2048) | (used & (used - 1) == 0)).all()


def test_components_of_chains_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 60)] + [(200, 201), (201, 202), (202, 200), (300, 300), (None, 5), (7, None), (200, 201)]
    got = dict(connected_components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + k: 100 for k in range(60)}, 200: 200, 201: 200, 202: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_counts_add_up_over_many_tasks(spark):
    import numpy as np

    size = 3 * (1 << 14) - 5

    def count(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for i in batch.column(0).to_pylist():
                total[i % size] += 1 + (i == 7) * (1 << 33)
        yield from partial_counts(total)

    df = spark.range(0, 100_000, 1, 150)
    got = sum_counts(df.mapInArrow(count, PARTIAL_COUNTS), 150, size)
    want = np.bincount(np.arange(100_000) % size, minlength=size)
    want[7] += 1 << 33
    assert (got == want).all()
    assert sum_counts(df.limit(0).mapInArrow(count, PARTIAL_COUNTS), 0, size).sum() == 0
