"""Similarity join of documents on word n-grams, with keys that combine many tokens.

A document is the set of its distinct word n-grams (here: tokens). Two documents link when
`100 * |common| >= percent * |union|`. The join is exact:

1. Documents with equal sets are one class; only its smallest document goes on.
2. Sizes are cut into classes so wide that similar sets are of one class or of neighbouring ones. The tokens of a
   set are dealt by their hash into a quarter more groups than a pair of the (larger) class may have differences.
   Of two similar sets each difference changes one group, the others are equal in both and hold equally many tokens.
   So of a set's groups in the order of how many tokens they hold, then of their place, it needs only as many as it may
   have differences, and one more: the first group that is equal in both is among these of either set. Groups without
   tokens or with one, which unlike documents have in common, are left out so. The combination of all tokens in a group
   is the key (about 4 tokens for a similarity of 0.8, 8 for 0.9); a set has the keys of its own class, and
   those of the next when a partner may be there. A key needs many tokens in common, so the documents that meet under
   one hardly grow in number with the corpus, however frequent the single tokens become, and no table of frequencies
   is needed.
3. Documents under one key are compared with its hub, the smallest of them.
   Only documents that are then still in different components are compared pairwise, so a group of
   thousands of near copies costs one comparison each.
4. Every document has `PARITIES` bits, each the parity of the number of its tokens with that hash. A token in one of two
   sets changes one bit, so sets with more unequal bits than differences allowed are no pair; most pairs end here.
5. Every link is verified on the whole sets.

Null or empty texts have the empty set and link with nothing. Rows with a null doc_id are returned
with a null component. Rows that repeat a doc_id are returned each; their links meet in the id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from patronage.llm.components import connected_components
from patronage.llm.text import LOWER, blocks, column_bytes, hash_spans, mix, release, store, word_spans

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
#: parity bits of a document
PARITIES = 512
#: bits of the table of documents whose sets are needed
WANTED = 1 << 24


def ngram_sets(raw: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of all rows, and where each row's begin."""
    raw = LOWER[raw]
    starts, ends, first = word_spans(raw, offsets)
    words = hash_spans(raw, starts, ends)
    n_words = np.diff(first)
    counts = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    base = np.concatenate([[0], np.cumsum(counts)])
    row = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(base[-1]) - base[row] + first[row]
    used = np.minimum(n_words[row], size)
    grams = mix(words[at] + _STEP) if len(at) else np.zeros(0, np.uint64)
    for j in range(1, size):
        more = np.flatnonzero(used > j) if (n_words < size).any() else slice(None)
        grams[more] = mix(grams[more] * _STEP + words[at[more] + j])
    for a, b in zip(base[:-1], base[1:]):
        grams[a:b].sort()
    fresh = np.ones(len(grams), dtype=bool)
    if len(grams):
        fresh[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
    kept = np.concatenate([[0], np.cumsum(fresh)])
    return grams[fresh], kept[base]


def _sets(batches: Iterator[pa.RecordBatch], size: int):
    for batch in batches:
        raw, offsets = column_bytes(batch.column(batch.schema.get_field_index("text")))
        for low, high, part, places in blocks(raw, offsets):
            yield (batch, low, high, *ngram_sets(part, places, size))


class _Bounds:
    """Size classes and numbers of hash groups for a threshold of `percent` / 100."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        lowest = [1]  # smallest size of each class; similar sizes are at most a factor of 100 / percent apart
        while lowest[-1] < 1 << 40:
            lowest.append(int(lowest[-1] * (100 / percent) ** 3) + 1)
        self.lowest = np.array(lowest, dtype=np.int64)

    def size_class(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.lowest, n, "right") - 1

    def reaches_next(self, n: np.ndarray) -> np.ndarray:
        """Whether a set of the next class can be similar."""
        return self.percent * self.lowest[self.size_class(n) + 1] <= 100 * n

    def groups(self, size_class: np.ndarray) -> np.ndarray:
        """A quarter more than the differences possible when the larger set is of this class."""
        largest = self.lowest[size_class + 1] - 1
        possible = (100 - self.percent) * 2 * largest // (100 + self.percent)
        return possible + -(-possible // 4) + 1

    def differences(self, n: np.ndarray, size_class: np.ndarray) -> np.ndarray:
        """Most differences to a similar set of at most this class."""
        other = np.minimum(self.lowest[size_class + 1] - 1, 100 * n // self.percent)
        return (100 - self.percent) * (n + other) // (100 + self.percent)


def group_keys(tokens: np.ndarray, base: np.ndarray, bounds: _Bounds) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all sets and where each set's begin."""
    sizes = np.diff(base)
    filled = np.flatnonzero(sizes)
    own = bounds.size_class(sizes[filled])
    more = bounds.reaches_next(sizes[filled])
    # a set once for its own class, and once for the next
    row = np.concatenate([filled, filled[more]])
    level = np.concatenate([own, own[more] + 1])
    order = np.argsort(row, kind="stable")
    row, level = row[order], level[order]
    groups = bounds.groups(level)
    first = np.concatenate([[0], np.cumsum(groups)])
    which = np.repeat(np.arange(len(row)), sizes[row])
    at = np.arange(len(which)) - np.repeat(np.cumsum(sizes[row]) - sizes[row] - base[row], sizes[row])
    member = tokens[at]
    place = first[which] + ((member >> _U(8)) % groups[which].astype(np.uint64)).astype(np.int64)
    sums = np.zeros(first[-1], dtype=np.uint64)
    np.add.at(sums, place, mix(member ^ _STEP))
    # of a set's groups those with most tokens
    owner = np.repeat(np.arange(len(row)), groups)
    order = np.lexsort((-np.bincount(place, minlength=first[-1]), owner))
    rank = np.arange(first[-1]) - first[owner]
    kept = np.sort(order[rank <= bounds.differences(sizes[row], level)[owner]])
    where = kept - first[owner[kept]] + (level[owner[kept]] << 32)
    each = np.bincount(row[owner[kept]], minlength=len(sizes))
    return mix(sums[kept] * _STEP + mix(where.astype(np.uint64))), np.concatenate([[0], np.cumsum(each)])


def parities(tokens: np.ndarray, base: np.ndarray) -> np.ndarray:
    """(rows, PARITIES / 64): for each set and hash value whether the number of its tokens with that value is odd."""
    row = np.repeat(np.arange(len(base) - 1), np.diff(base))
    cell = row * PARITIES + (mix(tokens + _STEP) % _U(PARITIES)).astype(np.int64)
    odd = (np.bincount(cell, minlength=(len(base) - 1) * PARITIES) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).reshape(len(base) - 1, -1)


_LANES = [f"p{k}" for k in range(PARITIES // 64)]


def _signatures(documents: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, parities, keys) per document."""

    def sign(batches):
        bounds = _Bounds(percent)
        for batch, low, high, tokens, base in _sets(batches, size):
            mixed = mix(tokens ^ _STEP)
            set_a = np.concatenate([[_U(0)], np.cumsum(mixed)])
            set_b = np.concatenate([[_U(0)], np.cumsum(mix(mixed))])
            keys, ends = group_keys(tokens, base, bounds)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(low, high - low),
                    pa.array(np.diff(base), pa.int64()),
                    pa.array((set_a[base[1:]] - set_a[base[:-1]]).view(np.int64)),
                    pa.array((set_b[base[1:]] - set_b[base[:-1]]).view(np.int64)),
                    *(pa.array(lane) for lane in parities(tokens, base).T),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.view(np.int64))),
                ],
                names=["doc_id", "n_shingles", "set_a", "set_b", *_LANES, "keys"],
            )

    lanes = ", ".join(f"{p} bigint" for p in _LANES)
    schema = f"doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, {lanes}, keys array<bigint>"
    return documents.select("doc_id", "text").mapInArrow(sign, schema)


def _traits(signed: DataFrame, prefix: str, key: str) -> DataFrame:
    """The id as `key`, and size and parities under names that begin with `prefix`."""
    return signed.select(F.col("doc_id").alias(key), *(F.col(c).alias(f"{prefix}_{c}") for c in ["n_shingles", *_LANES]))


def _fits(percent: int) -> str:
    """Whether sets of the sizes and parities of x and y can be similar."""
    unequal = " + ".join(f"bit_count(x_{p} ^ y_{p})" for p in _LANES)
    return (
        f"{percent} * greatest(x_n_shingles, y_n_shingles) <= 100 * least(x_n_shingles, y_n_shingles) and "
        f"{100 + percent} * ({unequal}) <= {100 - percent} * (x_n_shingles + y_n_shingles)"
    )


def _wanted(pairs: DataFrame) -> np.ndarray:
    """A table of `WANTED` bits, whatever the input: those at the hashes of the ids in `pairs` (a, b)."""
    # the functions on bitmaps count from 1
    ids = pairs.select(F.explode(F.array(_slot("a") + 1, _slot("b") + 1)).alias("slot"))
    parts = ids.groupBy(F.bitmap_bucket_number("slot").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    table = np.zeros(WANTED // 8, dtype=np.uint8)
    for row in parts.collect():
        bits = np.frombuffer(row["bits"], dtype=np.uint8)
        low = (row["part"] - 1) * len(bits)
        table[low : low + len(bits)] = bits
    return table


def _slot(key: str):
    return F.pmod(F.xxhash64(key), F.lit(WANTED))


def _verified(pairs: DataFrame, documents: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar. Texts stay where they are: a task makes the sets of the wanted
    documents, and of the few others with the same bit of the table."""
    table = documents.sparkSession.sparkContext.broadcast(_wanted(pairs))

    def whole(batches):
        def asked():
            for batch in batches:
                slot = batch.column(2).to_numpy()
                yield batch.filter(pa.array((table.value[slot >> 3] >> (slot & 7)) & 1 == 1))

        for batch, low, high, tokens, base in _sets(asked(), size):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(low, high - low),
                    pa.array([tokens[a:b].tobytes() for a, b in zip(base[:-1], base[1:])], pa.binary()),
                ],
                names=["doc_id", "tokens"],
            )

    texts = documents.where("doc_id is not null").select("doc_id", "text", _slot("doc_id").alias("slot"))
    sets = store(texts.mapInArrow(whole, "doc_id bigint, tokens binary"), "sets")

    def similar(batches):
        for batch in batches:
            keep = np.zeros(len(batch), dtype=bool)
            left, right = batch.column(2), batch.column(3)
            for i in range(len(batch)):
                x = np.frombuffer(left[i].as_buffer(), dtype=np.uint64)
                y = np.frombuffer(right[i].as_buffer(), dtype=np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep[i] = 100 * common >= percent * (len(both) - common) and common > 0
            yield batch.select([0, 1]).filter(pa.array(keep))

    joined = (
        pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("left")), "a")
        .join(sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("right")), "b")
        .select("a", "b", "left", "right")
    )
    return joined.mapInArrow(similar, "a bigint, b bigint")


def ngram_jaccard_join(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links).

    `size` words per n-gram; documents link from a similarity of `percent` / 100 on. A document
    without links is its own component.
    """
    spark = documents.sparkSession
    documents = documents.select("doc_id", "text")
    signed = store(_signatures(documents, size, percent), "signatures")
    release(spark)
    members = signed.where("doc_id is not null and n_shingles > 0")
    heads = store(
        members.groupBy("n_shingles", "set_a", "set_b").agg(F.min("doc_id").alias("head")), "heads"
    )
    classes = members.select("doc_id", "n_shingles", "set_a", "set_b").join(heads, ["n_shingles", "set_a", "set_b"])
    copies = store(classes.where("doc_id <> head").select(F.col("doc_id").alias("a"), F.col("head").alias("b")), "copies")
    # equal rows of one document count once
    first = heads.select("head", "n_shingles", "set_a", "set_b").withColumnRenamed("head", "doc_id")
    keyed = (
        members.select("doc_id", "n_shingles", "set_a", "set_b", "keys")
        .join(first, ["doc_id", "n_shingles", "set_a", "set_b"], "left_semi")
        .dropDuplicates(["doc_id", "n_shingles", "set_a", "set_b"])
        .select(F.explode("keys").alias("key"), "doc_id")
    )
    # the hub of a key is its smallest document
    met = Window.partitionBy("key")
    shared = store(
        keyed.withColumns({"hub": F.min("doc_id").over(met), "last": F.max("doc_id").over(met)}).where("hub < last").drop("last"), "keys"
    )
    release(spark)
    traits = members.select("doc_id", "n_shingles", *_LANES).distinct()
    near = shared.where("doc_id <> hub").select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct()
    stars = store(
        near.join(_traits(traits, "x", "a"), "a").join(_traits(traits, "y", "b"), "b").where(_fits(percent)).select("a", "b").distinct(), "stars"
    )
    links = store(_verified(stars, documents, size, percent), "links")
    found = connected_components(links.unionByName(copies))
    # documents of one key that are still apart
    placed = shared.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id")
    )
    apart = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    open_keys = store(placed.join(apart.select("key"), "key").join(traits, "doc_id").drop("hub"), "open")
    x, y = (
        open_keys.select("key", F.col("component").alias(p), F.col("doc_id").alias(k), *(F.col(c).alias(f"{p}_{c}") for c in ["n_shingles", *_LANES]))
        for p, k in (("x", "a"), ("y", "b"))
    )
    met_again = x.join(y, "key").where("x < y").where(_fits(percent)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = store(met_again.distinct().join(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"), "pairs")
    more = store(_verified(rest, documents, size, percent), "links")
    release(spark)
    found = connected_components(links.unionByName(copies).unionByName(more))
    return (
        signed.select("doc_id", "n_shingles")
        .join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    )


#: three words and a similarity of 0.9: all pairs that share a shingle, and reachability
ORACLE = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM texts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id
  GROUP BY x.doc_id, y.doc_id),
links AS (
  SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * common >= 90 * (p.n + q.n - common)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM documents d JOIN reach USING (doc_id) LEFT JOIN sizes USING (doc_id) GROUP BY d.doc_id
"""
