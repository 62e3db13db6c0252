"""Queries with DuckDB SQL (operators 6, 7, 8, 10) on the small tables and on odd rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from herdfeed.llm import oracle
from herdfeed.llm.chat import escape, format_turns, parse, unescape
from herdfeed.llm.decontam import contamination, decontaminate
from herdfeed.llm.ngram_join import _whole_sets, ngram_jaccard_join
from herdfeed.llm.quality_rules import quality_rules
from herdfeed.llm.queries import oracle_sql, queries
from llm_cases import LONG, PLAIN, ROWS, cases, empty
from tools.check_oracle import TABLES


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def same(spark_df, cursor):
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(spark_df.columns)
    assert in_order(spark_df.select(columns).collect()) == in_order(cursor.fetchall())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, con, name):
    same(queries()[name](spark, SF_SMALL), con.execute(oracle_sql()[name]))


BENCHMARK = [(1, "quick brown fox jumps over the lazy dog and then runs"), (2, "The LAZY dog, and then: runs home to the old farm"), (3, "one two"),
             (4, None), (None, "the of and"), (5, ""), (6, "one two"), (3, "one two"), (7, "ünï cödé")]


#: DuckDB takes no NUL, and its list slices take the square of a text's length.
SQL_ROWS = [(k, t and t[:8000], lang) for k, t, lang in ROWS if not t or "\x00" not in t]


@pytest.fixture(scope="module")
def odd(spark):
    c = duckdb.connect()
    c.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    c.executemany("INSERT INTO documents VALUES (?, ?)", [(k, t) for k, t, _ in SQL_ROWS])
    c.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    c.executemany("INSERT INTO benchmark VALUES (?, ?)", BENCHMARK)
    docs = cases(spark, SQL_ROWS)
    return c, docs, spark.createDataFrame(BENCHMARK, "item_id long, text string").selectExpr("*", "'x' AS item", "1 AS words")


def test_quality_rules_odd_rows(spark, odd):
    c, docs, _ = odd
    names = "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    same(quality_rules(docs).select(*names), c.execute(oracle.OP8))
    assert quality_rules(empty(spark)).collect() == []


def test_whole_long_texts_are_read(spark, odd):
    docs = cases(spark, [(1, LONG + " quick brown fox jumps over the lazy dog and then runs", "en"), (2, LONG + " z", "en"), (3, LONG, "en")])
    assert {r.doc_id: r.n_words for r in quality_rules(docs).collect()} == {1: 60_011, 2: 60_001, 3: 60_000}
    got = {r.doc_id: (r.n_words, r.n_hit) for r in contamination(docs, odd[2]).collect()}
    assert got == {1: (60_011, 11), 2: (60_001, 0), 3: (60_000, 0)}
    assert len({r.component_id for r in ngram_jaccard_join(docs).collect()}) == 1


def test_repeated_windows_count_each_word_once(spark):
    text = "a b c d e f a b c d e g " + "x x x x x x x"
    got = quality_rules(spark.createDataFrame([(1, text), (2, "a b c d e"), (3, "a a a a a a")], "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_repeat_words for r in got} == {1: 5 + 5 + 7, 2: 0, 3: 6}


def test_contamination_odd_rows(spark, odd):
    c, docs, items = odd
    same(contamination(docs, items), c.execute(oracle.OP10))
    assert contamination(empty(spark), items).collect() == []
    assert all(r.n_hit == 0 for r in contamination(docs, items.limit(0)).collect())
    assert {r.n_words for r in contamination(cases(spark, [(1, "a\x00b-c", "en")]), items).collect()} == {3}


def test_decontaminate_cuts_spans_and_keeps_the_rest(spark, odd):
    _, docs, items = odd
    rows = [(1, "Before it: the Quick brown fox, jumps over the lazy dog and then runs... after it all the same and more text", "en"),
            (2, "quick brown fox jumps over the lazy dog and then runs", "en"), (3, "clean — text\n", "en"), (4, None, "en"), (5, "", "en"),
            (6, "keep these few words one one two two and these", "en")]
    got = {r.doc_id: r.text for r in decontaminate(cases(spark, rows), items).collect()}
    assert set(got) == {1, 3, 4, 5, 6}  # 2 is an item all over
    assert got[3] == "clean — text\n" and got[4] is None and got[5] == ""
    assert got[1].startswith("Before it: the") and got[1].endswith("... after it all the same and more text") and "fox" not in got[1]
    again = contamination(decontaminate(docs, items), items).collect()
    assert not any(r.contaminated for r in again)
    assert "one two" not in " ".join(got[6].split())  # a window that a cut brings about goes too
    assert decontaminate(docs, items).schema == docs.schema
    assert decontaminate(empty(spark), items).collect() == []


@pytest.mark.parametrize("bound", (1, 16))
def test_items_beyond_one_block_all_count(spark, odd, monkeypatch, bound):
    """More item words than a block holds, one item longer than a block, one id in several blocks."""
    from herdfeed.llm import decontam

    c, docs, items = odd
    for name in ("BLOCK_WORDS", "MAX_ITEM_WORDS"):
        monkeypatch.setattr(decontam, name, bound, raising=False)
    same(contamination(docs, items), c.execute(oracle.OP10))
    assert len(decontam.Items(items).ranges) > 1
    passage = "red green blue cyan pink grey teal gold navy lime plum"
    more = items.select("item_id", "text").union(spark.createDataFrame([(3, passage), (8, "left right")], "item_id long, text string"))
    # Cutting the passage brings the words of item 8 together; cutting those, the words of item 3.
    rows = [(1, f"keep one left {passage} right two these", "en"), (1, passage, "en"), (None, passage + " " + passage, "en"), (2, PLAIN, "en"),
            (2, f"{passage} far from {PLAIN}", "en"), (3, None, "en")]
    got = decontaminate(cases(spark, rows), more).collect()
    hit = {(r.doc_id, r.n_words): (r.n_hit, r.n_items) for r in contamination(cases(spark, rows), more).collect()}
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 1000)
    assert in_order(got) == in_order(decontaminate(cases(spark, rows), more).collect())
    assert hit == {(r.doc_id, r.n_words): (r.n_hit, r.n_items) for r in contamination(cases(spark, rows), more).collect()}
    assert ["keep", "these"] in [r.text.split() for r in got if r.text]


def test_window_filter_misses_no_window(spark):
    """Every window of every item, long or short, alone and inside a text, is told; few others are."""
    import numpy as np
    import pyarrow as pa

    from herdfeed.llm import decontam

    rng = np.random.default_rng(4)
    items = [(f"i{k}", " ".join(f"w{x}" for x in rng.integers(0, 400, n))) for k, n in enumerate([1, 3, 9, 10, 11, 40, 400])]
    own = decontam.Items(spark.createDataFrame([*items, ("none", None), ("empty", "..."), (None, "w1 w2")], "item_id string, text string")).windows
    assert own.sizes == [1, 3, 9, 10]
    own.sizes = [3, 9, 10]
    texts = [None, "", "zz"]
    for _, text in items[1:]:
        words = text.split()
        texts += ["zz yy " + " ".join(words[k:k + 10]) + " xx" for k in range(max(1, len(words) - 9))]
    texts += [" ".join(f"w{x}" for x in rng.integers(400, 800, 30)) for _ in range(200)]
    counts, may = own.judge(pa.array(texts))
    assert counts.tolist() == [len((t or "").split()) for t in texts]
    assert not may[:3].any() and may[3:-200].all() and may[-200:].mean() < 0.05


def test_ngram_join_odd_rows(spark, odd):
    _, docs, _ = odd
    got = in_order(ngram_jaccard_join(docs).collect())
    # PLAIN has 19 words; its upper-case form and the repeated rows link, one word more gives 17/18 >= 0.9.
    wanted = {1: 1, 6: 1, 7: 1, None: 1, 10: 10, 11: 10}
    for doc_id, n, component in got:
        if n:
            assert component == wanted.get(doc_id, doc_id), doc_id
        else:
            assert component == doc_id
    assert len(got) == docs.count() and ngram_jaccard_join(empty(spark)).collect() == []


def brute(texts, percent=90):
    sets = {}
    for k, t in texts.items():
        w = t.lower().split()
        sets[k] = {tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else ({tuple(w)} if w else set())
    parent = {k: k for k in texts}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in texts:
        for b in texts:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), root(k)) for k in texts}


@pytest.mark.parametrize("seed", range(2))
def test_ngram_join_finds_all_links_of_a_hot_group(spark, seed):
    """Near copies of one text and of each other, common passages, chains and short texts."""
    import random

    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 400)}"
    base = [word() for _ in range(120)]
    passage = [word() for _ in range(60)]
    texts, chain = {}, [word() for _ in range(80)]
    for k in range(260):
        kind = rng.random()
        if kind < 0.5:
            w = list(base)
            for _ in range(rng.randint(0, 6)):
                w[rng.randrange(len(w))] = word()
            if rng.random() < 0.3:
                del w[rng.randrange(len(w))]
        elif kind < 0.7:
            chain[rng.randrange(len(chain))] = word()
            w = list(chain)
        elif kind < 0.85:
            w = passage + [word() for _ in range(rng.randint(0, 60))]
        else:
            w = [f"s{rng.randint(0, 2)}" for _ in range(rng.randint(0, 12))]
        texts[k] = " ".join(w)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           ngram_jaccard_join(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == brute(texts)


def test_chat_round_trips_anything():
    import random

    rng = random.Random(1)
    bits = ["<", "s", ">", "/", "\\", "[", "INST", "]", " ", "<s>", "</s>", "[INST] ", " [/INST]", "<<", "a", "é", "\n", ">>\n", "<</SYS>>\n", "SYS"]
    roles = ["user", "assistant", "system", "SYS", "tool", "we ird<>", "", "%53YS"]
    for _ in range(4000):
        turns = [(rng.choice(roles), "".join(rng.choices(bits, k=rng.randint(0, 6)))) for _ in range(rng.randint(0, 4))]
        text, spans = format_turns(turns)
        assert parse(text) == turns
        assert [unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    assert format_turns([("user", "a < b [0]")])[0] == "<s>[INST] a < b [0] [/INST]"  # no conflict, no escape
    assert not any(c in escape("<s></s>[INST][/INST]<<x") for c in ("<s>", "</s>", "[INST]", "[/INST]", "<<"))
    assert parse("nonsense") is None and parse("<s>[INST] open") is None


def test_chat_cases(spark):
    from herdfeed.llm.chat import format_conversations, read_back

    rows = spark.createDataFrame([(1, 0, "user", None), (1, 0, "user", None), (1, 1, None, "x"), (None, 5, "assistant", "y"), (2, None, "assistant", "z" * 200_000),
                                  (2, 3, "assistant", "</s>")], "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS turns", "2 AS formatted")
    got = {r.conv_id: r for r in read_back(format_conversations(rows)).collect()}
    assert {k: r.n_turns for k, r in got.items()} == {1: 3, None: 1, 2: 2}
    assert {k: r.loss_chars for k, r in got.items()} == {1: 0, None: 1, 2: 200_004}
    assert read_back(format_conversations(rows.limit(0))).collect() == []


def test_ngram_join_whole_sets_take_one_python_worker_a_task(spark, capsys):
    docs = spark.createDataFrame([(k, f"text number {k} of a few") for k in range(50)], "doc_id long, text string")
    wanted = docs.filter("doc_id < 5").select(F.xxhash64("text").alias("text_hash"))
    sets = _whole_sets(docs, "text", 3, wanted)
    assert sets.count() == 5
    sets.explain()
    assert capsys.readouterr().out.split("== Initial Plan ==")[0].count("MapInArrow") == 1
