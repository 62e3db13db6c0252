"""Operators 3, 4, 5 and 9: rules exactly, classifiers by held-out accuracy and brute force."""

import math
import random
import re
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from herdfeed.llm import langid, rule_ensemble, toxicity, url_filter
from herdfeed.llm.common import id_remainder
from herdfeed.llm.linear import grams, letters, sampled_labels
from herdfeed.llm.queries import URL_RULES, queries
from herdfeed.llm.url_filter import ALLOWED_NAMES, BLOCKED_NAMES, NameClassifier, Segmenter, filter_urls
from llm_cases import ROWS, cases, empty

SF = "/root/testdata/sf0.01"


def test_id_remainder_is_crc32_of_the_text(spark):
    import zlib

    got = spark.createDataFrame([(i,) for i in (0, 7, -7, 12345678901)], "i long").select("i", id_remainder("i", 5)).collect()
    assert all(r == zlib.crc32(str(i).encode()) % 5 for i, r in got)


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[cut:]
    end = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), path[:end]


def ruled(host, path):
    fits = []
    for text, says in URL_RULES.entries:
        at, start = text.split("/")[0], "/" + "/".join(text.split("/")[1:])
        if (host == at or host.endswith("." + at)) and path.startswith(start):
            fits.append((len(text), text, says))
    return max(fits)[1:] if fits else (None, None)


URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.NET/en/x?y#z", "https://example.net", "https://example.net/", "https://notexample.net/en/",
        "https://a.example.com/de/1", "https://a.example.com/DE/1", "x://y.org/fr/?://", "http://É.org/fr/", "http://net?x/en/", "http://net/#", "a://b\nc/d\ne?f",
        "http://blog.cheap-pills.example.com/en/1", "http://cheappills.example.com/en/1", "http://science-blog.example.com/en/1", "http://" + "a" * 5000 + ".com/en/"]


def test_url_rules_by_brute_force(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)) + [(None, URLS[4]), (1, URLS[8]), (1, URLS[8])], "page_id long, url string")
    pages = pages.selectExpr("*", "'x' AS host", "'x' AS path", "'x' AS rule", "'x' AS verdict")
    rows = filter_urls(pages, URL_RULES).collect()
    assert len(rows) == len(URLS) + 3
    for r in rows:
        if r.page_id is not None and (r.page_id, r.host) != (1, "a.example.com"):
            host, path = parsed(URLS[r.page_id])
            rule, verdict = ruled(host, path)
            assert (r.host, r.path, r.rule) == (host, path, rule)
            assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))
    by = {r.page_id: r.verdict for r in rows}
    assert [by[k] for k in (15, 16, 17)] == ["block", "block", "allow"] and by[0] == by[2] == "allow"
    assert filter_urls(pages.limit(0), URL_RULES).collect() == []


def test_url_query_on_all_pages(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries()["op3_url_filter"](spark, SF).collect()
    own = url_filter.train(spark.read.parquet(f"{SF}/pages.parquet"), URL_RULES, spark.read.parquet(f"{SF}/documents.parquet"))
    assert len(rows) == len(pages)
    for r in rows:
        host, path = parsed(pages[r.page_id])
        rule, verdict = ruled(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if own.score(host, path) >= 0.5 else "allow"))


def counted_words(pages, texts):
    """Word counts of URLs and texts, by their definition."""
    urls = [parsed(u) for u in pages]
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    found = Counter(w for t in [*{h for h, _ in urls}, *[p for _, p in urls], *texts] for w in re.findall("[a-z]+", lower(t)) if 2 <= len(w) <= 20)
    steps = Counter(math.floor(math.log(n) / math.log(1.05)) for n in found.values())
    least, fits = math.inf, 0
    for step in sorted(steps, reverse=True):
        fits += steps[step]
        if fits > url_filter.VOCABULARY:
            break
        least = step
    return {w: n for w, n in found.items() if math.floor(math.log(n) / math.log(1.05)) >= least}


def test_url_score_by_hand(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "VOCABULARY", 3000)
    pages, docs = spark.read.parquet(f"{SF_SMALL}/pages.parquet"), spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    own = url_filter.train(pages, URL_RULES, docs)
    urls = [r.url for r in pages.select("url").collect()]
    words = Counter({w: 200 / (k + 2) for k, w in enumerate(dict.fromkeys(url_filter.COMMON_WORDS))})
    words.update(w for name in BLOCKED_NAMES + ALLOWED_NAMES for w in name.split("-"))
    words.update(counted_words(urls, [r.text for r in docs.select("text").collect()]))
    total = sum(words.values())
    assert own.segmenter.cost == pytest.approx({w: -math.log(n / total) for w, n in words.items()})
    split = Segmenter(words).split

    def tokens(host, path):
        labels = [x for x in host.split(".")[:-1] if x not in ("www", "m", "en")]
        return [w for t in (*labels, re.sub(r"\.[a-z]{2,5}$", "", path.lower())) for run in re.findall("[a-z]+", t) for w in split(run)]

    hosts = {"block": defaultdict(set), "allow": defaultdict(set)}
    for host, path in map(parsed, urls):
        if ruled(host, path)[1]:
            for w in tokens(host, path):
                hosts[ruled(host, path)[1]][w].add(host)
    held = []
    for says, names in (("block", BLOCKED_NAMES), ("allow", ALLOWED_NAMES)):
        count = Counter({w: len(h) for w, h in hosts[says].items()})
        for name in names:
            for w in {x for part in name.split("-") for x in split(part)}:
                count[w] += url_filter.NAME_HOSTS
        held.append(Counter({w: n for w, n in count.items() if len(w) >= 3}))
    known = set(held[0]) | set(held[1])
    share = [{w: (c[w] + 0.5) / (sum(c.values()) + 0.5 * len(known)) for w in known} for c in held]
    for host, path in map(parsed, urls):
        odds = 0.2 / 0.8
        for w in tokens(host, path):
            odds *= share[0][w] / share[1][w] if w in known else 1
        assert own.score(host, path) == pytest.approx(odds / (1 + odds))
    free = [own.score(*parsed(u)) for u in urls if "://" in u and not ruled(*parsed(u))[1]]
    assert sum(abs(x - 0.2) < 1e-9 for x in free) < 0.1 * len(free)


def test_names_run_together_are_judged_by_their_words(spark):
    own = url_filter.train(spark.read.parquet(f"{SF}/pages.parquet"), URL_RULES, spark.read.parquet(f"{SF}/documents.parquet"))
    assert own.tokens("cheappills.com", "/") == ["cheap", "pills"] and own.score("cheappills.com", "/") > 0.9
    assert own.score("scienceblog.com", "/x.html") < 0.1
    nothing = url_filter.train(spark.createDataFrame([(1, None)], "page_id long, url string"), URL_RULES)
    assert nothing.evidence == NameClassifier().evidence


@pytest.mark.parametrize("seed", range(20))
def test_segmenter_is_optimal(seed):
    from herdfeed.llm.url_filter import UNKNOWN_LETTER

    rng = random.Random(seed)
    words = {"".join(rng.choices("ab", k=rng.randint(1, 4))): rng.randint(1, 9) for _ in range(5)}
    segmenter, run = Segmenter(words), "".join(rng.choices("abc", k=9))

    def price(parts):
        return sum(min(segmenter.cost.get(p, math.inf), segmenter.unknown_start + UNKNOWN_LETTER * len(p)) for p in parts)

    every = []
    for cuts in product((0, 1), repeat=len(run) - 1):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(run)]
        every.append(price([run[a:b] for a, b in zip(at, at[1:])]))
    got = segmenter.split(run)
    assert "".join(got) == run and price(got) == pytest.approx(min(every))
    assert segmenter.split("") == []


def test_labelled_samples(spark):
    rows = [(i, i % 2) for i in range(100)] + [(None, 1), (200, None), (201, 0), (201, 1), (3, 1), (202, 5)]
    labels = spark.createDataFrame(rows, "doc_id long, toxic int").withColumn("label", F.lit("x"))
    got = sampled_labels(labels, "doc_id", "toxic", F.col("doc_id") % 3 != 0, 10).collect()
    assert len(got) == 20 and all(r.label == r.doc_id % 2 and r.doc_id % 3 and r.doc_id < 100 for r in got)
    assert len(sampled_labels(labels, "doc_id", "toxic", F.lit(True), 1000).collect()) == 100


def test_grams_count_every_place():
    x = letters("Ab, ab!")
    assert "".join(map(chr, x)) == " ab ab "
    assert len(grams(x, (2,), 20)) == 6 and len(set(grams(x, (2,), 20).tolist())) == 3
    assert len(letters(None)) == len(letters("")) == len(letters("...")) == 0 and len(grams(letters(""), (3,), 20)) == 0


def test_toxicity_on_held_out_rows(spark):
    rows = {r.doc_id: r for r in queries()["op9_toxicity"](spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    held = [(rows[r.doc_id], r.toxic) for r in labels if rows[r.doc_id].held_out]
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows.values())
    assert np.mean([r.predicted for r, toxic in held if toxic]) >= 0.7
    assert np.mean([r.predicted for r, toxic in held if not toxic]) <= 0.05


def test_toxicity_cases(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    docs = cases(spark, [(i, f"you {'moron idiot' if i % 2 else 'dear friend'} number {i}", "en") for i in range(200)])
    model = toxicity.train(docs, labels, F.lit(True))
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(got[i].predicted == i % 2 for i in range(200))
    odd = toxicity.score(cases(spark), model).collect()
    assert len(odd) == len(ROWS) and all(0 <= r.score <= 1 for r in odd)
    kept = toxicity.keep_clean(docs, model)
    assert kept.schema == docs.schema and sorted(r.doc_id for r in kept.collect()) == list(range(0, 200, 2))
    assert toxicity.score(empty(spark), model).collect() == toxicity.keep_clean(empty(spark), model).collect() == []
    nothing = toxicity.train(empty(spark), labels.limit(0), F.lit(True))
    assert max(r.score for r in toxicity.score(cases(spark), nothing).collect()) < 1e-12


@pytest.mark.parametrize("module, label, sign", [(toxicity, "toxic", 1), (rule_ensemble, "quality", 0)])
def test_scores_keep_the_class_mix_beyond_the_sample(spark, monkeypatch, module, label, sign):
    """A text that occurs in both classes scores by the mix of all labelled rows, not of the sample."""
    # Rows 0-899 say one thing; of the 300 others two thirds, and a ninth of the first, say the same as each other.
    clean, marked = "dear friend we met at the old farm", "you moron ### $$$ idiot !!! ### $$$"
    rows = [(i, f"{marked if i % 3 else clean} {i % 7}" if i >= 900 else f"{marked if i % 9 == 0 else clean} {i % 7}", "en") for i in range(1200)]
    docs = cases(spark, rows)
    labels = spark.createDataFrame([(i, int((i >= 900) == sign)) for i in range(1200)], f"doc_id long, {label} int")
    def scores():
        model = module.train(docs, labels, F.lit(True))
        return [r.score for r in module.score(cases(spark, [(1, clean + " 3", "en"), (2, marked + " 3", "en")]), model).collect()]

    whole = scores()
    monkeypatch.setattr(module, "SAMPLE", 200)
    assert scores() == pytest.approx(whole, abs=0.1)


def test_language_on_held_out_rows(spark):
    rows = {r.doc_id: r for r in queries()["op4_language_id"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    held = [r.lang == rows[r.doc_id].lang_pred for r in docs if rows[r.doc_id].held_out]
    assert len(rows) == len(docs) and np.mean(held) >= 0.97 and all(0 <= r.score <= 1 for r in rows.values())


def test_language_cases(spark):
    said = {"en": "the cat and the dog with this", "de": "der hund und die katze mit dem", "fr": "le chat et la souris avec une", "es": "el perro y los gatos con una"}
    rows = [(i, said[lang] + f" {lang * (i % 3)}", lang) for i, lang in enumerate(list(said) * 10)]
    docs = cases(spark, rows)
    model = langid.train(docs, F.lit(True))
    assert sorted(model.families) == ["germanic", "romance"] and len(model.pairs) == 2
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, model).collect()}
    assert got == {i: lang for i, _, lang in rows}
    odd = sorted(langid.predict(cases(spark), model).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    assert {r.doc_id for r in odd if r.lang_pred == "und"} == {2, 3, 4, 12, None} and len(odd) == len(ROWS)
    kept = langid.keep_known(cases(spark), model, 0.0)
    assert kept.schema == cases(spark).schema and kept.count() == len(ROWS) - 5
    assert langid.predict(empty(spark), model).collect() == []
    none = langid.train(empty(spark), F.lit(True))
    assert {r.lang_pred for r in langid.predict(docs, none).collect()} == {"und"}
    alone = langid.train(docs.filter("lang = 'en'"), F.lit(True))
    assert {r.lang_pred for r in langid.predict(docs, alone).collect()} == {"en"}


def test_quality_on_held_out_rows(spark):
    rows = {r.doc_id: r for r in queries()["op5_rule_ensemble"](spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    held = [rows[r.doc_id].predicted == r.quality for r in labels if rows[r.doc_id].held_out]
    assert len(rows) == 1000 and np.mean(held) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows.values())


def test_rules_compile_to_what_they_hold_for(spark):
    rng = np.random.default_rng(1)
    x = rng.random((400, len(rule_ensemble.NAMES)))
    y = ((x[:, 2] > 0.4) & (x[:, 5] <= 0.7)).astype(float)
    model = rule_ensemble.fit(x, y)
    assert 0 < len(model.rules) < 120
    rows = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], ["i", *rule_ensemble.NAMES])
    got = dict(rows.select("i", model.column()).collect())
    want = 1 / (1 + np.exp(-(model.bias + sum(w * rule_ensemble._holds(r, x) for r, w in zip(model.rules, model.weights)))))
    assert np.allclose([got[i] for i in range(400)], want, atol=1e-12) and np.mean((want >= 0.5) == y) > 0.97


def test_quality_cases(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    docs = cases(spark, [(i, f"plain words of text number {i} here" if i % 2 else f"### $$$ {i} !!! ###", "en") for i in range(60)])
    model = rule_ensemble.train(docs, labels, F.lit(True))
    assert {r.doc_id: r.predicted for r in rule_ensemble.score(docs, model).collect()} == {i: i % 2 for i in range(60)}
    odd = rule_ensemble.score(cases(spark), model).collect()
    assert len(odd) == len(ROWS) and all(0 <= r.score <= 1 for r in odd)
    assert rule_ensemble.score(empty(spark), model).collect() == []
    for rows, want in ((labels.limit(0), 0.5), (labels.filter("quality = 1"), 1.0)):
        assert {round(r.score, 3) for r in rule_ensemble.score(docs, rule_ensemble.train(docs, rows, F.lit(True))).collect()} == {want}


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (rule_ensemble, "quality")])
def test_repeated_ids_don_t_swell_what_is_learnt(spark, module, label):
    from herdfeed.llm.linear import labelled_texts

    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(None, 1)], f"doc_id long, {label} int")
    rows = [(i % 20, f"text {i} says {'moron idiot ###' if i % 2 else 'dear friend'}", "en") for i in range(2000)] + [(None, "no id", "en"), (3, None, "en"), (99, "not labelled", "en")]
    docs = cases(spark, rows)
    chosen = sampled_labels(labels, "doc_id", label, F.lit(True), 1000)
    got = labelled_texts(docs, chosen, "doc_id", "text").collect()
    assert sorted(r.doc_id for r in got) == list(range(20)) and all(r.label == r.doc_id % 2 for r in got)
    assert all((r.doc_id, r.text) in {(i, t) for i, t, _ in rows} for r in got)
    assert module.train(docs, labels, F.lit(True)) is not None


def test_log_ratios_over_all_labelled_rows(spark, monkeypatch):
    """Document counts by hand; a word of one toxic text in sixty is learnt though the sample is small."""
    monkeypatch.setattr(toxicity, "SAMPLE", 30)
    rows = [(i, ("quxword here" if i % 60 == 1 else "moron idiot here") if i % 2 else f"dear friend {i % 7}", "en") for i in range(2400)]
    docs, labels = cases(spark, rows), spark.createDataFrame([(i, i % 2) for i in range(2400)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, F.col("doc_id") % 3 != 0)
    counts, sizes = np.zeros((2, 1 << toxicity.BITS)), [0, 0]
    for i, text, _ in rows:
        if i % 3:
            counts[i % 2, np.unique(grams(letters(text), toxicity.SIZES, toxicity.BITS))] += 1
            sizes[i % 2] += 1
    smooth = counts + 2 * np.array(sizes)[:, None] / sum(sizes)
    ratio = np.log(smooth[1] / (sizes[1] + 2)) - np.log(smooth[0] / (sizes[0] + 2))
    kept = np.flatnonzero(np.abs(ratio) >= 3 * np.sqrt((1 / smooth).sum(axis=0)))
    assert model.column.tolist() == kept.tolist() and np.allclose(model.scale, ratio[kept])
    assert set(np.unique(grams(letters("quxword"), (5,), toxicity.BITS)).tolist()) <= set(kept.tolist())


def test_many_languages_are_no_error(spark):
    said = {"en": "the cat and the dog with this", "fr": "le chat et la souris avec une"}
    rows = [(i, said[lang], lang) for i, lang in enumerate(list(said) * 10)] + [(1000 + i, f"xx{i}", f"junk{i}") for i in range(1500)]
    model = langid.train(cases(spark, rows), F.lit(True))
    assert {"en", "fr"} <= {x for m in model.members.values() for x in m} and sum(map(len, model.members.values())) == langid.MAX_LANGUAGES
    got = {r.doc_id: r.lang_pred for r in langid.predict(cases(spark, rows[:20]), model).collect()}
    assert got == {i: lang for i, _, lang in rows[:20]}
    swollen = [(7, f"{said['en']} {i}", "en") for i in range(5000)] + rows[:20]
    assert {r.lang_pred for r in langid.predict(cases(spark, rows[:20]), langid.train(cases(spark, swollen), F.lit(True))).collect()} == set(said)


def test_language_decision_by_hand(spark):
    """Margins, family and votes of every document of a whole table, text by text."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = langid.train(docs, id_remainder("doc_id", 4) != 2)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in langid.predict(docs, model).collect():
        text = texts[r.doc_id]
        if not text or not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        x = np.bincount(grams(letters(text), langid.SIZES, langid.BITS), minlength=1 << langid.BITS)
        margin = model.bias + (x / max(1, x.sum())) @ model.weights.astype(float) * langid.FEATURE_SCALE
        logistic = lambda m: 1 / (1 + math.exp(-2 * m))
        family = max(range(len(model.families)), key=lambda k: margin[k])
        score = logistic(margin[family]) if len(model.families) > 1 else 1.0
        members = model.members[model.families[family]]
        votes = Counter({m: 0.0 for m in members})
        for k, (of, first, second) in enumerate(model.pairs):
            if of == model.families[family]:
                p = logistic(margin[len(model.families) + k])
                votes[first] += p
                votes[second] += 1 - p
        best = max(members, key=lambda m: (votes[m], m))
        assert r.lang_pred == best and r.score == pytest.approx(score * (votes[best] / (len(members) - 1) if len(members) > 1 else 1), abs=1e-6)


def test_toxicity_score_by_hand(spark):
    docs, labels = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    model = toxicity.train(docs, labels, id_remainder("doc_id", 3) != 1)
    texts = {r.doc_id: r.text for r in docs.collect()}
    weight = np.zeros(1 << toxicity.BITS)
    scale = np.zeros(1 << toxicity.BITS)
    weight[model.column], scale[model.column] = model.weight, model.scale
    kept = {r.doc_id for r in toxicity.keep_clean(docs, model).collect()}
    for r in toxicity.score(docs, model).collect():
        has = np.zeros(1 << toxicity.BITS)
        has[grams(letters(texts[r.doc_id]), toxicity.SIZES, toxicity.BITS)] = 1
        x = has * scale
        want = 1 / (1 + math.exp(-(model.bias + weight @ x / max(1, math.sqrt(x @ x)))))
        assert r.score == pytest.approx(want, abs=1e-9) and r.predicted == (want >= 0.7) == (r.doc_id not in kept)
