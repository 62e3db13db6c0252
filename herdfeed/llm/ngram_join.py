"""N-gram Jaccard join (operator 6): rare-first prefix filtering with length, positional and
suffix filters; prefixes are joined, and every candidate pair is verified once.

Method, for distinct word shingles and links at ``100 * |A & B| >= percent * |A | B|``:

1. A first pass counts all shingles of all documents in a fixed array of counters. That gives
   one global order, rare first (counter, then hash), of bounded size at any corpus size.
2. A second pass reduces each text to a 128-bit key of its shingle set, the set's size and the
   rarest ``size - ceil(t * size) + 1`` shingles: two linked sets share one of these. Texts
   with equal sets form one class, and only classes go on, so copies are never paired.
3. Postings ``(shingle, class, position, size)`` of shingles that several classes hold. In each
   list the class that reaches the shingle earliest (it has the fewest rare shingles of its
   own: the text that the others were copied from) is the list's centre. All others pair with
   the centre, under the length and positional filters.
4. Candidate pairs, once each, are verified exactly on whole sets, after the suffix filter (an
   overlap bound from counts of the hash range's parts). Links give components.
5. A list that still holds several components gets the rest: members outside the list's
   largest component pair with every member of another component, under the same filters.
   Pairs inside one component need no test as they cannot change any component. So a hot group
   of near copies costs a row for each member, not for each pair, and no link between
   components is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PARTIAL_COUNTS, bitmap_of, in_bitmap, partial_counts, sum_counts, written
from .components import connected_components
from .textbytes import NON_SPACE, mix, shingles, words_of

COUNTER_BITS = 20
#: Bits of the bitmap of wanted texts: 16 and more a text, within these sizes (2 kB to 32 MB).
LEAST_BITS, MOST_BITS = 14, 28
SUFFIX_PARTS = 64


def _sets(column: pa.Array, width: int):
    """Sorted distinct shingle hashes (uint64) of each text, in row order."""
    for _, words in words_of(column, NON_SPACE):
        for i in range(words.n_texts):
            yield np.unique(shingles(words.hashes[words.first[i]:words.first[i + 1]], width))


def _counter(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def _set_key(s: np.ndarray) -> bytes:
    return b"".join(int(part).to_bytes(8, "big") for part in (
        s.sum(dtype=np.uint64), mix(s + np.uint64(len(s))).sum(dtype=np.uint64)))


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def shingle_counters(docs: DataFrame, text_col: str, width: int) -> np.ndarray:
    """Occurrences (a document counts once) of all shingles, by the hash's first bits."""
    texts = docs.select(F.col(text_col).alias("text"))

    def count(batches):
        total = np.zeros(1 << COUNTER_BITS, np.int64)
        for batch in batches:
            held: list[np.ndarray] = []
            size = 0
            for s in _sets(batch.column(0), width):
                held.append(s)
                size += len(s)
                if size > 1 << 18:
                    total += np.bincount(_counter(np.concatenate(held)), minlength=len(total))
                    held, size = [], 0
            if held:
                total += np.bincount(_counter(np.concatenate(held)), minlength=len(total))
        yield from partial_counts(total)

    return sum_counts(texts.mapInArrow(count, PARTIAL_COUNTS), texts.rdd.getNumPartitions(), 1 << COUNTER_BITS)


def _prefixes(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, counters) -> DataFrame:
    """``(doc_id, n_shingles, cls, text_hash, prefix, parts)`` of each row; ``cls`` NULL if
    empty, ``parts`` the set's counts by hash part."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))

    def reduce(batches):
        order = counters.value
        for batch in batches:
            sizes, keys, prefixes, parts = [], [], [], []
            for s in _sets(batch.column(1), width):
                n = len(s)
                sizes.append(n)
                keys.append(_set_key(s) if n else None)
                length = n - (percent * n + 99) // 100 + 1 if n else 0
                prefixes.append(s[np.lexsort((s, order[_counter(s)]))[:length]])
                parts.append(np.bincount((s & np.uint64(SUFFIX_PARTS - 1)).astype(np.int64), minlength=SUFFIX_PARTS).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), batch.column(2), _lists(prefixes),
                 pa.array(parts, pa.binary())], names=["doc_id", "n_shingles", "cls", "text_hash", "prefix", "parts"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(reduce, f"doc_id {kind}, n_shingles long, cls binary, text_hash long, prefix array<long>, parts binary")


def _whole_sets(docs: DataFrame, text_col: str, width: int, wanted: DataFrame) -> DataFrame:
    """``(cls, shingles)`` of the wanted ``(cls, text_hash)``, one row each. A bitmap over the text
    hash, with room for the wanted texts up to ``MOST_BITS``, drops nearly all other texts where they
    are read; a semi-join on the hash drops the rest. Only wanted texts are split into sets."""
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * wanted.count()).bit_length()))
    bitmap = bitmap_of(wanted.select("text_hash"), bits)
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmap)
    rows = docs.select(F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))

    def pick(batches):
        held = bitmap.value
        for batch in batches:
            found = np.flatnonzero(in_bitmap(held, batch.column(1).to_numpy()))
            if len(found):
                yield batch.take(pa.array(found))

    def split(batches):
        for batch in batches:
            seen: dict[bytes, np.ndarray] = {}
            for s in _sets(batch.column(0), width):
                if len(s):
                    seen.setdefault(_set_key(s), s)
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), _lists(list(seen.values()))], names=["cls", "shingles"])

    picked = rows.mapInArrow(pick, "text string, text_hash long").join(wanted.select("text_hash").distinct(), "text_hash", "left_semi")
    # Written, as a task that picks and splits would hold two Python workers, which stay with their executor.
    found = written(picked.select("text"), "ngram-texts").mapInArrow(split, "cls binary, shingles array<long>")
    return found.groupBy("cls").agg(F.first("shingles").alias("shingles"))


def _suffix_filtered(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose overlap can suffice: equal shingles fall in equal parts of
    the hash range, so the overlap is at most the sum of the smaller counts of each part."""
    parts = classes.select("node", "parts")
    both = (pairs.join(parts.select(F.col("node").alias("a"), F.col("parts").alias("pa")), "a")
            .join(parts.select(F.col("node").alias("b"), F.col("parts").alias("pb")), "b").select("a", "b", "pa", "pb"))

    def judge(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), "<i4").reshape(-1, SUFFIX_PARTS).astype(np.int64) for k in (2, 3))
            bound, total = np.minimum(x, y).sum(axis=1), x.sum(axis=1) + y.sum(axis=1)
            yield batch.select([0, 1]).filter(pa.array((100 + percent) * bound >= percent * total))

    return both.mapInArrow(judge, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of classes that are linked, by whole sets."""
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b"))

    def verify(batches):
        for batch in batches:
            keep = []
            left, right = batch.column(2), batch.column(3)
            for i in range(batch.num_rows):
                x = left[i].values.to_numpy(zero_copy_only=False)
                y = right[i].values.to_numpy(zero_copy_only=False)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    keep.append(i)
            if keep:
                yield batch.select([0, 1]).take(pa.array(keep))

    return both.select("a", "b", "sa", "sb").mapInArrow(verify, "a long, b long")


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                       percent: int = 90) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of each row of ``docs``.

    Words are runs of non-white-space with A-Z lower-cased; a text of fewer than ``width`` words
    is one shingle. NULL, empty and white-space texts have no shingles and link with nothing;
    their component is their own id. Rows with equal sets are linked, repeated rows included
    (each row is returned). A NULL id is never a component id, unless all ids of the component
    are NULL. Other columns, whatever their names, are not read. An empty table gives none.
    """
    spark = docs.sparkSession
    counters = spark.sparkContext.broadcast(shingle_counters(docs, text_col, width))
    rows = written(_prefixes(docs, id_col, text_col, width, percent, counters), "ngram-rows")
    classes = written(rows.filter("n_shingles > 0").groupBy("cls").agg(
        F.first("n_shingles").alias("n"), F.first("text_hash").alias("text_hash"), F.first("prefix").alias("prefix"), F.first("parts").alias("parts"))
        .withColumn("node", F.monotonically_increasing_id()), "ngram-classes")

    # A rank puts the class that reaches the shingle earliest first; ties go by the class's hash.
    # A list of two is kept only if its one pair passes the length and positional filters.
    held = classes.select("node", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("pos", "token"))
    rank = F.expr("shiftleft(cast(pos AS long), 31) + pmod(hash(node), 2147483647)")
    shared = held.groupBy("token").agg(
        F.count("*").alias("held"), F.sum("n").alias("total"), F.min("n").alias("least_n"), F.min(F.col("n") - F.col("pos")).alias("least_rest"),
        F.min(rank).alias("centre"))
    shared = shared.filter(
        f"held > 2 OR (held = 2 AND 100 * least_n >= {percent} * (total - least_n) AND {100 + percent} * least_rest >= {percent} * total)")
    lists = written(held.join(shared.select("token", "centre"), "token").withColumn("inner", rank == F.col("centre")).drop("centre"), "ngram-lists")

    length = f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)"
    position = f"{100 + percent} * least(x.n - x.pos, y.n - y.pos) >= {percent} * (x.n + y.n)"

    def pairs_of(x: DataFrame, y: DataFrame, also: str) -> DataFrame:
        near = x.alias("x").join(y.alias("y"), F.expr(f"x.token = y.token AND x.node != y.node AND {length} AND {position} AND {also}"))
        return near.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()

    def links_of(pairs: DataFrame) -> DataFrame:
        near = written(_suffix_filtered(pairs, classes, percent), "ngram-near")
        wanted = near.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(classes.select("node", "cls", "text_hash"), "node")
        wanted = written(wanted, "ngram-wanted")
        sets = _whole_sets(docs, text_col, width, wanted).join(wanted.select("cls", "node"), "cls").select("node", "shingles")
        return written(_verified(near, sets, percent), "ngram-links")

    tried = written(pairs_of(lists, lists.filter("inner"), "true"), "ngram-pairs")
    links = links_of(tried)
    roots = connected_components(links, "ngram-components")

    placed = lists.drop("inner").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    per_root = placed.groupBy("token", "root").agg(F.count("*").alias("members"))
    largest = per_root.groupBy("token").agg(F.count("*").alias("roots"), F.max(F.struct("members", "root")).alias("largest"))
    open_lists = written(placed.join(largest.filter("roots > 1"), "token")
                         .select("token", "node", "n", "pos", "root", (F.col("root") == F.col("largest.root")).alias("inner")), "ngram-open")
    rest = pairs_of(open_lists.filter("NOT inner"), open_lists, "x.root != y.root AND (y.inner OR x.node < y.node)")
    rest = written(rest.join(tried, ["a", "b"], "left_anti"), "ngram-pairs")
    links = links.union(links_of(rest))
    roots = connected_components(links, "ngram-components")

    least = rows.filter("n_shingles > 0").groupBy("cls").agg(F.min("doc_id").alias("least_id"))
    grouped = least.join(classes.select("cls", "node"), "cls").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    component = grouped.join(grouped.groupBy("root").agg(F.min("least_id").alias("component_id")), "root").select("cls", "component_id")
    return (rows.select("doc_id", "n_shingles", "cls").join(component, "cls", "left")
            .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))
