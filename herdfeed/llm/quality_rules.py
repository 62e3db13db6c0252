"""Quality rules (operator 8): a threshold table compiled into Spark projections of length,
symbol, stop-word and line ratios. Native expressions only.

Spark keeps an array that several expressions use as a projection of its own, so words, lines
and window hashes are computed once; there is no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Frequent function words of the languages the rules know.
STOP_WORDS = {
    "en": "the of and to in a is that for it was on with as be by at are this from or an not have which".split(),
    "de": "der die das und in zu den mit von ist des im für auf ein eine dem nicht sich als auch es an".split(),
    "fr": "le la les de des et un une en que qui dans du est pour par sur au avec il ne se elle".split(),
    "es": "el la los las de y que en un una por con del se no para su al es como lo más".split(),
}


@dataclass(frozen=True)
class Rule:
    """A row passes if ``low <= value <= high``; ``value`` is SQL over the statistics."""

    name: str
    value: str
    low: float | None = None
    high: float | None = None


#: Ratios are taken over ``greatest(n, 1)``, so every rule has a value for empty texts.
RULES = (
    Rule("length", "n_words", 10, None),
    Rule("mean_word_length", "word_chars / greatest(n_words, 1)", 2.0, 15.0),
    Rule("symbols_per_word", "n_symbols / greatest(n_words, 1)", None, 0.25),
    Rule("stop_words", "n_stop_words / greatest(n_words, 1)", 0.01, None),
    Rule("duplicate_lines", "n_dup_lines / greatest(n_lines, 1)", None, 0.3),
    Rule("capital_letters", "n_upper / greatest(word_chars, 1)", None, 0.5),
    Rule("bullet_lines", "n_bullet_lines / greatest(n_lines, 1)", None, 0.9),
    Rule("ellipsis_lines", "n_ellipsis_lines / greatest(n_lines, 1)", None, 0.3),
)
WINDOW = 5
#: A text fails the base rules with fewer words, or a larger percentage of repeated words.
BASE_MIN_WORDS = 10
BASE_MAX_REPEAT_PERCENT = 20


def compile_rules(rules=RULES) -> Column:
    """The rules as one boolean column over the statistics."""
    tests = [f"({r.value}) {op} {bound!r}D" for r in rules for op, bound in ((">=", r.low), ("<=", r.high)) if bound is not None]
    return F.expr(" AND ".join(tests) or "true")


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the statistics of each row's whole text; a NULL text counts as empty."""
    stop = ", ".join(f"'{w}'" for w in sorted({w for words in STOP_WORDS.values() for w in words}))
    split = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).selectExpr(
        "doc_id", "text", r"filter(split(text, '\\s+'), w -> w != '') AS words",
        r"filter(split(text, '\n'), l -> l rlike '\\S') AS lines")
    each = ", ".join(f"words[i + {k}]" for k in range(WINDOW))
    hashed = split.selectExpr(
        "doc_id", "text", "words", "lines", "size(words) AS n",
        f"CASE WHEN size(words) > {WINDOW} THEN transform(sequence(0, size(words) - {WINDOW}), i -> xxhash64({each})) END AS windows")
    # Only texts in which some window occurs twice are sorted.
    ranked = hashed.selectExpr(
        "*", "CASE WHEN size(array_distinct(windows)) < size(windows) THEN "
        "array_sort(transform(windows, (h, i) -> named_struct('h', h, 'p', i))) END AS ranked")
    twice = ranked.selectExpr(
        "*", "array_sort(transform(filter(ranked, (e, k) -> e.h <=> get(ranked, k - 1).h OR e.h <=> get(ranked, k + 1).h), e -> e.p)) AS twice")
    return twice.selectExpr(
        "doc_id", "cast(n AS long) AS n_words", "cast(char_length(array_join(words, '')) AS long) AS word_chars",
        "cast(regexp_count(text, '[#*$%&|<>]') AS long) AS n_symbols",
        "cast(size(lines) - size(array_distinct(lines)) AS long) AS n_dup_lines",
        f"cast(coalesce(aggregate(transform(twice, (p, k) -> least({WINDOW}, coalesce(get(twice, k + 1) - p, {WINDOW}))), 0, (s, x) -> s + x), 0) AS long) AS n_repeat_words",
        "size(lines) AS n_lines", f"size(filter(words, w -> lower(rtrim('.,;:!?', w)) IN ({stop}))) AS n_stop_words",
        r"regexp_count(text, '\\p{Lu}') AS n_upper",
        r"size(filter(lines, l -> l rlike '^[\\x20\\x09-\\x0D]*[-*•]')) AS n_bullet_lines",
        r"size(filter(lines, l -> l rlike '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$')) AS n_ellipsis_lines")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """The statistics with ``base_failed`` and ``kept`` of each row.

    ``base_failed``: under ``BASE_MIN_WORDS`` words, or more than ``BASE_MAX_REPEAT_PERCENT`` %
    of the words lie in five-word windows that occur twice or more. ``kept``: not base-failed
    and every rule of the table holds. NULL, empty and white-space texts have no words: base-
    failed. Repeated rows each give a row; a NULL id stays NULL; other columns are not read.
    """
    failed = F.expr(f"n_words < {BASE_MIN_WORDS} OR 100 * n_repeat_words > {BASE_MAX_REPEAT_PERCENT} * n_words")
    return (text_statistics(docs, id_col, text_col).withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & compile_rules(rules)))
