"""URL filters (operator 3): host and path rules, and for all other URLs word segmentation of
host and path by a unigram Viterbi search, scored by multinomial naive Bayes.

Both models are learnt from the data. Word counts behind the segmentation come from the words of
texts and from the tokens between marks in hosts and paths, by one aggregate; the most frequent words,
at most ``VOCABULARY``, are kept. The classifier learns from the URLs that the rules decide: in how many
hosts of either verdict a word stands, so that a host counts once however many URLs it has. Fixed
tables of frequent words and labelled names are added to these counts as a prior. Everything else
is judged URL by URL, so nothing but counts is shuffled.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import share, shared, written

# Frequent words of host names and paths, most frequent first.
COMMON_WORDS = (
    "the and for news blog shop home web online site world info data book science school university library research health "
    "care food travel music photo video game games sport sports media art design home garden house car auto city local radio "
    "daily times post press journal review magazine weather history museum church family kids baby wedding fashion style beauty "
    "business market finance bank money law legal job jobs work office team group club forum community support help guide wiki "
    "docs developer code open source cloud network mobile phone software tech digital computer security mail search map maps "
    "green solar energy water farm dog cat pet horse fish bird tree flower mountain river beach hotel restaurant coffee wine "
    "page index article archive category tag user account product products service services about contact download best top new"
).split()
# Labelled names the classifier learns from.
BLOCKED_NAMES = (
    "casino casino-online win-casino poker-room free-poker slots slot-bonus jackpot-win lottery-win lotto-prize bet bets betting "
    "free-bet sports-bets bonus-bets gambling roulette viagra cialis cheap-viagra pills diet-pills cheap-pills-online pharmacy-pills "
    "cheap-meds weight-loss-pills porn free-porn porno xxx xxx-video adult adult-video adult-dating sex sex-cams nude escort escorts "
    "spam spam-mail link-farm spam-links ads ad-server ads-network track tracker click-track tracking ad-track popup-ads clickbait "
    "warez crack-keygen torrent-crack hack-cheats replica-watches cheap-replica fake-watches payday-loan payday-loans quick-cash "
    "free-prize claim-prize win-prize get-rich earn-cash malware phishing free-ringtones"
).split()
ALLOWED_NAMES = (
    "news daily-news world-news blog my-blog science-journal university library school research health-care travel-guide city-news "
    "music-review photo-art design-studio open-source developer-docs wiki community-forum garden farm solar-farm horse-farm book-shop "
    "online-shop free-software software free-press sport sports-news radio weather museum history family-history fish-market bank "
    "law-office job-market wine-shop hotel restaurant coffee-house dog-training cat-care web-design mail search maps article archive "
    "category page index about contact product support help video-game computer-science race-track track-and-field win-win-team"
).split()
#: Costs (negative log probabilities) of a run of letters that is no word: so much more than a word
#: that was counted once, and so much a letter.
UNKNOWN_START, UNKNOWN_LETTER = 3.0, 1.5
#: Share of URLs expected to be blocked.
PRIOR_BLOCKED = 0.2
#: Added to every count of a word, and the hosts that a labelled name of the fixed tables counts for.
ADDED_COUNT, NAME_HOSTS = 0.5, 5
#: Words kept by count, and the lengths of words that are counted in texts and URLs.
VOCABULARY, WORD_LENGTHS = 50_000, (2, 20)
#: Shorter words are segmented, but say nothing: they are codes of languages and countries.
SHORTEST_EVIDENCE = 3
#: Labels of a host and endings of a path that carry no words.
PLAIN_LABELS = ("www", "m", "en")


@dataclass
class Rules:
    """``(host and path, verdict)`` pairs such as ``("example.net/en/", "allow")``."""

    entries: tuple[tuple[str, str], ...]

    def column(self, host: str, path: str) -> tuple[Column, Column]:
        """Rule and verdict of each URL: the longest that fits (then the first in order of the
        text), NULL if none does."""
        rule = verdict = None
        for text, says in sorted(self.entries, key=lambda e: (-len(e[0]), e[0])):
            at, start = text.partition("/")[0], "/" + text.partition("/")[2]
            fits = ((F.col(host) == at) | F.col(host).endswith("." + at)) & F.startswith(F.col(path), F.lit(start))
            rule = F.when(fits, text) if rule is None else rule.when(fits, text)
            verdict = F.when(fits, says) if verdict is None else verdict.when(fits, says)
        none = F.lit(None).cast("string")
        return (none, none) if rule is None else (rule, verdict)


class Segmenter:
    """Most probable split of a run of letters into words, by a Viterbi search."""

    def __init__(self, counts: dict[str, float]) -> None:
        total = sum(counts.values())
        self.cost = {w: -math.log(n / total) for w, n in counts.items()}
        self.longest = max(map(len, counts), default=0)
        self.unknown_start = UNKNOWN_START + math.log(max(total, 1))

    def split(self, run: str) -> list[str]:
        # Cheapest way to the letter i, ending in a word (0) or in an unknown run (1).
        best = [(0.0, math.inf)] + [(math.inf, math.inf)] * len(run)
        back: list[tuple[tuple[int, int], tuple[int, int]]] = [((0, 0), (0, 0))] * (len(run) + 1)
        for i in range(1, len(run) + 1):
            word, word_from = math.inf, (0, 0)
            for j in range(max(0, i - self.longest), i):
                cost = self.cost.get(run[j:i])
                if cost is not None:
                    kind = 0 if best[j][0] <= best[j][1] else 1
                    if best[j][kind] + cost < word:
                        word, word_from = best[j][kind] + cost, (j, kind)
            start, grown = best[i - 1][0] + self.unknown_start + UNKNOWN_LETTER, best[i - 1][1] + UNKNOWN_LETTER
            best[i] = (word, min(start, grown))
            back[i] = (word_from, (i - 1, 0 if start <= grown else 1))
        i, kind = len(run), 0 if best[-1][0] <= best[-1][1] else 1
        bounds = [i]
        while i:
            j, before = back[i][kind]
            if kind == 0 or before == 0:
                bounds.append(j)
            i, kind = j, before
        bounds.reverse()
        return [run[a:b] for a, b in zip(bounds, bounds[1:])]


def _prior_words() -> Counter:
    """Counts that the fixed tables give words: by rank, and one a labelled name."""
    counts = Counter({w: 200.0 / (rank + 2) for rank, w in enumerate(dict.fromkeys(COMMON_WORDS))})
    for name in BLOCKED_NAMES + ALLOWED_NAMES:
        counts.update(name.split("-"))
    return counts


class NameClassifier:
    """Multinomial naive Bayes over the words of segmented hosts and paths; words that were not
    learnt say nothing. ``words`` holds counts for the segmentation; ``hosts`` the numbers of blocked
    and of allowed hosts that a word stands in. Names of the fixed tables are added to both."""

    def __init__(self, words: dict[str, float] | None = None, hosts: dict[str, tuple[float, float]] | None = None, prior: float = PRIOR_BLOCKED) -> None:
        counts = _prior_words()
        counts.update(words or {})
        self.segmenter = Segmenter(counts)
        self.known: dict[str, list[str]] = {}
        self.evidence: dict[str, float] = {}
        self.prior = math.log(prior / (1 - prior))
        self.learn(hosts or {})

    def learn(self, hosts: dict[str, tuple[float, float]]) -> None:
        held = [Counter({w: n[k] for w, n in hosts.items()}) for k in range(2)]
        for count, names in zip(held, (BLOCKED_NAMES, ALLOWED_NAMES)):
            for name in names:
                for word in set(self.words(name)):
                    count[word] += NAME_HOSTS
        known = {w for count in held for w in count if len(w) >= SHORTEST_EVIDENCE}
        totals = [sum(count[w] for w in known) + ADDED_COUNT * len(known) for count in held]
        self.evidence = {w: math.log((held[0][w] + ADDED_COUNT) / totals[0]) - math.log((held[1][w] + ADDED_COUNT) / totals[1]) for w in known}

    def words(self, text: str) -> list[str]:
        if len(self.known) > 1 << 17:
            self.known.clear()
        out: list[str] = []
        for run in re.findall(r"[a-z]+", text):
            if run not in self.known:
                self.known[run] = self.segmenter.split(run)
            out += self.known[run]
        return out

    def tokens(self, host: str, path: str) -> list[str]:
        """Words of a URL. The top-level domain, the usual first labels and page endings carry none."""
        labels = "-".join(x for x in host.split(".")[:-1] if x not in PLAIN_LABELS)
        return self.words(labels) + self.words(re.sub(r"\.[a-z]{2,5}$", "", path.lower()))

    def score(self, host: str, path: str) -> float:
        """Probability of a blocked URL."""
        odds = self.prior + sum(self.evidence.get(w, 0.0) for w in self.tokens(host, path))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))


def _counted(words: Column) -> Column:
    return F.char_length(words).between(*WORD_LENGTHS)


def _most_frequent(counts: DataFrame, n: str) -> list:
    """The rows of the largest ``n``, at most ``VOCABULARY``: rows are counted by steps of 5 % of
    ``n``, and the steps that fit are collected whole. So no task or driver holds more than them."""
    counts = written(counts.withColumn("step", F.floor(F.log(F.col(n)) / math.log(1.05))), "words")
    fits, least = 0, None
    for step, rows in sorted(counts.groupBy("step").count().collect(), reverse=True):
        fits += rows
        if fits > VOCABULARY:
            break
        least = step
    return counts.filter(F.col("step") >= least).drop("step").collect() if least is not None else []


def word_counts(urls: DataFrame, texts: DataFrame | None, text_col: str = "text") -> dict[str, int]:
    """How often the most frequent runs of letters a-z, at most ``VOCABULARY``, stand in the texts,
    in the distinct hosts and in the paths of ``urls``. Only these words come to the driver."""
    lower = lambda c: F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = lambda df, c: df.select(F.explode(F.split(lower(F.coalesce(c, F.lit(""))), "[^a-z]+")).alias("word"))
    words = runs(urls.select("host").distinct(), F.col("host")).union(runs(urls, F.col("path")))
    if texts is not None:
        words = words.union(runs(texts, F.col(text_col).cast("string")))
    counts = words.filter(_counted(F.col("word"))).groupBy("word").agg(F.count("*").alias("n"))
    return dict(_most_frequent(counts, "n"))


def hosts_by_word(urls: DataFrame, classifier: NameClassifier) -> dict[str, tuple[int, int]]:
    """In how many hosts of blocked and of allowed URLs (those that a rule decides) each word of
    their segmented hosts and paths stands; the words of most hosts, at most ``VOCABULARY``."""
    ruled = urls.filter("ruled IS NOT NULL").select("ruled", "host", "path")

    def split(batches):
        for batch in batches:
            rows = {(ruled, host, word) for ruled, host, path in zip(*(c.to_pylist() for c in batch.columns))
                    for word in classifier.tokens(host, path) if len(word) >= SHORTEST_EVIDENCE}
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["ruled", "host", "word"])

    words = ruled.mapInArrow(split, "ruled string, host string, word string").distinct()
    counts = words.groupBy("word").agg(F.count_if(F.col("ruled") == "block").alias("blocked"), F.count_if(F.col("ruled") == "allow").alias("allowed"))
    rows = _most_frequent(counts.withColumn("hosts", F.col("blocked") + F.col("allowed")), "hosts")
    return {r.word: (r.blocked, r.allowed) for r in rows}


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL column; both empty without ``://``."""
    c = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    rest = F.when(F.instr(c, "://") > 0, F.substring_index(F.regexp_replace(c, r"(?s)^.*?://", ""), "#", 1)).otherwise("")
    rest = F.substring_index(rest, "?", 1)
    host = F.substring_index(rest, "/", 1)
    path = F.substring(rest, F.char_length(host) + 1, F.char_length(rest))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def _ruled_urls(pages: DataFrame, rules: Rules, id_col: str, url_col: str) -> DataFrame:
    host, path = host_and_path(url_col)
    rule, verdict = rules.column("host", "path")
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    return rows.withColumns({"rule": rule, "ruled": verdict})


def train(pages: DataFrame, rules: Rules, texts: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url",
          text_col: str = "text") -> NameClassifier:
    """Classifier learnt from all URLs of ``pages`` and all ``texts``. NULL URLs and texts say nothing;
    repeated URLs add to word counts, but not to hosts; other columns are not read. Empty tables
    leave the fixed tables alone."""
    urls = _ruled_urls(pages, rules, id_col, url_col)
    classifier = NameClassifier(word_counts(urls, texts, text_col))
    classifier.learn(hosts_by_word(urls, classifier))
    return classifier


def filter_urls(pages: DataFrame, rules: Rules, id_col: str = "page_id", url_col: str = "url",
                classifier: NameClassifier | None = None, threshold: float = 0.5) -> DataFrame:
    """``(page_id, host, path, rule, verdict, score)`` of each row.

    ``verdict`` is the longest fitting rule's, else ``block`` if the classifier's ``score`` is
    at least ``threshold``, else ``allow``. Without a classifier, that of the fixed tables judges. A
    NULL URL, or one without ``://``, has an empty host and path: no rule fits and it is allowed.
    Repeated rows each give a row; other columns are not read.
    """
    rows = _ruled_urls(pages, rules, id_col, url_col)
    own = share(pages.sparkSession, classifier or NameClassifier())

    def judge(batches):
        seen: dict[tuple[str, str], float] = {}
        judge = shared(own)
        for batch in batches:
            if len(seen) > 1 << 17:
                seen.clear()
            scores = []
            for key in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if key not in seen:
                    seen[key] = judge.score(*key)
                scores.append(seen[key])
            ruled = batch.column(4).to_pylist()
            says = [r or ("block" if s >= threshold else "allow") for r, s in zip(ruled, scores)]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(4)], pa.array(says, pa.string()), pa.array(scores, pa.float64())],
                                             names=["page_id", "host", "path", "rule", "verdict", "score"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(judge, f"page_id {kind}, host string, path string, rule string, verdict string, score double")
