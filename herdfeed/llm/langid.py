"""Language ID (operator 4): hierarchical discrimination. One-versus-rest linear support vector
machines choose the language family; inside it, one-versus-one linear support vector machines
separate the related languages.

Features are relative frequencies of character n-grams over the whole text, hashed to
``2 ** BITS`` columns, so a text's margin is a mean of n-gram weights. The machines are fitted on
about ``PER_LANGUAGE`` rows of each language, picked by a hash of id and text.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import share, shared, written
from .linear import SparseRows, grams, letters, minimise

# Families of related languages; any other language is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy".split(),
    "romance": "fr es it pt ro ca gl oc".split(),
    "slavic": "ru uk be pl cs sk bg mk sr hr bs sl".split(),
    "uralic": "fi et hu".split(),
    "turkic": "tr az kk uz ky tk".split(),
    "indic": "hi mr ne bn pa gu ur".split(),
}
BITS = 15
SIZES = (1, 2, 3)
PER_LANGUAGE = 600
#: At most so many languages are learnt, those with the most rows, and from so many rows at all.
MAX_LANGUAGES, MOST_ROWS = 100, 12_000
#: Margins are of the order of 1 at this feature scale; the score is a logistic of margins.
FEATURE_SCALE = 30.0
UNDETERMINED = "und"


def family_of(language: str) -> str:
    return next((f for f, members in FAMILIES.items() if language in members), language)


@dataclass
class Model:
    """Machines as columns of ``weights``: one a family, then one a pair of related languages
    (positive for the first). ``pairs`` has ``(family, first, second)`` of the latter."""

    families: list[str] = field(default_factory=list)
    members: dict[str, list[str]] = field(default_factory=dict)
    pairs: list[tuple[str, str, str]] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((1 << BITS, 0), np.float32))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score; ``und`` and 0 if the text has no letter or nothing was learnt."""
        if not self.families or not text or not has_letter(text):
            return UNDETERMINED, 0.0
        found = grams(letters(text), SIZES, BITS)
        margin = self.bias + (self.weights[found].mean(axis=0, dtype=np.float64) * FEATURE_SCALE if len(found) else 0.0)
        n = len(self.families)
        best = int(np.argmax(margin[:n]))
        family, score = self.families[best], _logistic(margin[best]) if n > 1 else 1.0
        members = self.members[family]
        won = dict.fromkeys(members, 0.0)
        for k, (of, first, second) in enumerate(self.pairs):
            if of == family:
                p = _logistic(margin[n + k])
                won[first] += p
                won[second] += 1 - p
        language = max(members, key=lambda x: (won[x], x))
        return language, score * (won[language] / (len(members) - 1) if len(members) > 1 else 1.0)


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def _logistic(margin: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(2 * margin, -40, 40))))


def _machine(x: SparseRows, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear support vector machine (squared hinge, classes of equal weight)."""
    importance = np.where(y > 0, 1 / max(1, (y > 0).sum()), 1 / max(1, (y < 0).sum()))

    def gradient(w):
        slack = np.maximum(0, 1 - y * (x.dot(w[:-1]) + w[-1]))
        slope = -2 * y * slack * importance
        return np.concatenate((x.back(slope) + 1e-4 * w[:-1], [slope.sum()]))

    w = minimise(gradient, x.shape[1] + 1, 150, 0.1)
    return w[:-1], float(w[-1])


def train(docs: DataFrame, keep: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on rows with text and language whose ``doc_id`` passes ``keep``: the ``MAX_LANGUAGES``
    languages with the most rows, about ``PER_LANGUAGE`` rows of each (fewer if they were over
    ``MOST_ROWS`` together). Rows are picked by a hash of id and text, so repeated ids don't swell the
    sample; rows without an id aren't learnt from; other columns are not read. An empty table gives
    a model that knows no language."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.filter("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").filter(keep)
    held = dict(rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect())
    if not held:
        return Model()
    each = min(PER_LANGUAGE, MOST_ROWS // len(held))
    share_of = F.create_map(*[F.lit(v) for lang, n in sorted(held.items()) for v in (lang, min(1.0, each / n))])
    place = F.pmod(F.xxhash64("doc_id", "text", F.lit(4)), F.lit(1 << 30)) / float(1 << 30)
    sample = written(rows.filter(place < share_of[F.col("lang")]).select("lang", "text"), "language-sample")

    def reduce(batches):
        for batch in batches:
            columns, counts = [], []
            for text in batch.column(1).to_pylist():
                at, n = np.unique(grams(letters(text), SIZES, BITS), return_counts=True)
                columns.append(at.astype(np.int32))
                counts.append((n / max(1, n.sum())).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.float32()))], names=["lang", "at", "share"])

    # Row order of a scan may differ from run to run; sorting keeps the fit the same.
    found = sample.mapInArrow(reduce, "lang string, at array<int>, share array<float>").toArrow()
    langs = found["lang"].to_pylist()
    at, shares = found["at"].combine_chunks(), found["share"].combine_chunks()
    rows = []
    for i in range(len(langs)):
        rows.append((at[i].values.to_numpy(), shares[i].values.to_numpy().astype(np.float64) * FEATURE_SCALE))
    order = sorted(range(len(langs)), key=lambda i: (langs[i], rows[i][0].tobytes(), rows[i][1].tobytes()))
    langs, rows = [langs[i] for i in order], [rows[i] for i in order]
    own = [family_of(x) for x in langs]
    model = Model(families=sorted(set(own)))
    model.members = {f: sorted({x for x, g in zip(langs, own) if g == f}) for f in model.families}
    machines = []
    if len(model.families) > 1:
        x = SparseRows(rows, 1 << BITS)
        machines += [_machine(x, np.where(np.array(own) == f, 1.0, -1.0)) for f in model.families]
    else:
        machines.append((np.zeros(1 << BITS), 0.0))
    for family in model.families:
        for first, second in combinations(model.members[family], 2):
            part = [i for i, lang in enumerate(langs) if lang in (first, second)]
            machines.append(_machine(SparseRows([rows[i] for i in part], 1 << BITS), np.where(np.array([langs[i] for i in part]) == first, 1.0, -1.0)))
            model.pairs.append((family, first, second))
    model.weights = np.stack([w for w, _ in machines], axis=1).astype(np.float32)
    model.bias = np.array([b for _, b in machines])
    return model


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` of each row. A text that is NULL or has no letter is
    ``und`` with score 0. Repeated rows each give a row; other columns are not read."""
    handle = share(docs.sparkSession, model)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def judge(batches):
        own = shared(handle)
        for batch in batches:
            found = [own.predict(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(judge, f"doc_id {kind}, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model, min_score: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is told with at least ``min_score``; columns unchanged."""
    handle = share(docs.sparkSession, model)
    at = docs.columns.index(text_col)

    def judge(batches):
        own = shared(handle)
        for batch in batches:
            found = [own.predict(text) for text in batch.column(at).to_pylist()]
            yield batch.filter(pa.array([lang != UNDETERMINED and s >= min_score for lang, s in found], pa.bool_()))

    return docs.mapInArrow(judge, docs.schema)
