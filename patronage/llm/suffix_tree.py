"""Language-model scores from a suffix tree of words over one of bytes, beside a unigram baseline over words.

The tree of words. Every run of 2 to `ORDER` tokens (words and the end) of the training texts is counted, in
Spark, by its hash; none is dropped, so the states, the runs that occur, grow with the corpus. The probability
of a token after its context is (count of both + W * P(token | context without its oldest word)) / (count of
the context + W), down to the empty context, whose W is the number of distinct words and whose prior is the
spelling of the token by the tree of bytes. A context that tells no more than its suffix so predicts as
its suffix does. White space is drawn from the tree of bytes; after white space and at the start of a text
the tree of words draws a word or the end. All probabilities of a place sum to one.

The tree of bytes, of a bounded size, is the prior of unseen words only. Texts are bytes with A-Z lowered and an end symbol; bytes are grouped in 32 classes (letters,
space, other white space and end, digits, marks, first and following bytes of longer characters). For
every position of the training texts the four classes before it are a context. Contexts of every length
are counted over the whole corpus. Going from short to long, a context becomes a state when it is
frequent enough (a share `P_MIN` of all positions, which bounds the number of states per length by
1 / P_MIN whatever the corpus) and its next-class distribution diverges from that of its longest
suffix state: count times Kullback-Leibler divergence at least `DIVERGENCE`. Its distribution is
smoothed with that of the suffix state. The spelling is the product of P(class | longest suffix state) *
P(byte | class). A text's score is log10 of the probability of the whole text and its end.

The baseline. A token's count over the training texts is needed for every token of every text. Texts are
dealt in blocks of neighbouring doc_ids; a block sends each distinct word and run once with its count, they
are summed over blocks, and each block gets the sums of its own back, in Parquet tables. A row holds the sorted
hashes of a block in one bucket of hashes; there are as many buckets as the bytes of the corpus need. The
answer holds no hashes: the block, which can tell its own in the same order, gets one small number for each,
0 for a run that occurs once, in that block's training texts, or never. A word that every text holds
costs one entry per block and batch. Nothing of the vocabulary reaches the driver. Words are compared by 62 bits
of their hash, runs by `MORE_BITS` more than the number of the corpus' bytes has, so that of two thousand
runs that never occurred less than one is taken for another, at any size.

Null and empty texts consist of the end. Rows with a null doc_id are never held out; rows that repeat a
doc_id are separate texts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from patronage.llm.text import IS_SPACE, LOWER, blocks, column_bytes, hash_spans, mix, release, store, word_spans

CLASSES, BITS, DEPTH = 32, 5, 4
#: share of positions that a context needs, divergence that it needs, weight of its suffix state
P_MIN, DIVERGENCE, WEIGHT = 1e-5, 10.0, 20.0
#: neighbouring doc_ids in a block
BLOCK_IDS = 4096
#: bytes of texts that are scored at once
SCORED = 1 << 20
#: tokens in the longest run that is counted, weight of the next shorter context
ORDER, WORD_WEIGHT = 5, 4.0
_OTHER = 27  # white space other than the space, controls, and the end symbol
_END = 256
_LAST = np.uint64(0x9E3779B97F4A7C14)  # the end as a token
_ENDS_WORD = np.append(IS_SPACE, True)


def _classes() -> np.ndarray:
    table = np.full(257, 29)  # marks
    table[97:123] = np.arange(26)
    table[65:91] = np.arange(26)
    table[:33] = _OTHER
    table[32] = 26
    table[127] = _OTHER
    table[48:58] = 28
    table[128:192] = 31
    table[192:256] = 30
    table[_END] = _OTHER
    return table.astype(np.uint32)


CLASS = _classes()


def _symbols(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All symbols of the texts, each text followed by the end, and where each text's begin."""
    places = offsets + np.arange(len(offsets))
    symbols = np.full(int(places[-1]), _END, dtype=np.uint16)
    held = np.ones(len(symbols), dtype=bool)
    held[places[1:] - 1] = False
    symbols[held] = LOWER[raw]
    return symbols, places


def _codes(symbols: np.ndarray) -> np.ndarray:
    """The four classes before each symbol and its own, five bits each. Ends stand between the texts, so
    what is before a text's first symbol is an end and what the text before has (whose last classes are
    replaced by ends, see below)."""
    c = CLASS[symbols]
    code = c.copy()
    for d in range(1, DEPTH + 1):
        code[d:] |= c[:-d] << np.uint32(BITS * d)
        code[:d] |= np.uint32(_OTHER << (BITS * d))
    # contexts end at a text's start
    starts = np.flatnonzero(symbols[:-1] == _END) + 1
    for k in range(DEPTH):
        at = starts[starts + k < len(code)] + k
        for d in range(k + 1, DEPTH + 1):
            shift = np.uint32(BITS * d)
            code[at] = (code[at] & ~(np.uint32(CLASSES - 1) << shift)) | (np.uint32(_OTHER) << shift)
    return code


def _ngram_counts(documents: DataFrame) -> DataFrame:
    """(kind, code, n): class n-grams (0) and bytes (1) of the training texts, counted task by task."""

    def count(batches):
        codes, numbers, bytes_seen, held = [], [], np.zeros(257, np.int64), 0

        def merged():
            every, back = np.unique(np.concatenate(codes), return_inverse=True)
            return every, np.bincount(back, weights=np.concatenate(numbers)).astype(np.int64)

        for batch in batches:
            batch = batch.filter(pc.invert(batch.column(1)))
            raw, offsets = column_bytes(batch.column(0))
            for _, _, part, places in blocks(raw, offsets):
                symbols, _ = _symbols(part, places)
                bytes_seen += np.bincount(symbols, minlength=257)
                every = np.sort(_codes(symbols))
                edge = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
                codes.append(every[edge])
                numbers.append(np.diff(np.append(edge, len(every))))
                held += len(edge)
                if held > 1 << 22:
                    every, number = merged()
                    codes, numbers, held = [every], [number], len(every)
        if codes:
            every, number = merged()
            seen = np.flatnonzero(bytes_seen)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([0, 1], [len(every), len(seen)]).astype(np.int32)),
                    pa.array(np.concatenate([every.astype(np.int32), seen.astype(np.int32)])),
                    pa.array(np.concatenate([number, bytes_seen[seen]])),
                ],
                names=["kind", "code", "n"],
            )

    rows = documents.select("text", "held_out").mapInArrow(count, "kind int, code int, n bigint")
    return rows.groupBy("kind", "code").agg(F.sum("n").alias("n"))


@dataclass
class SuffixTree:
    """state: the longest suffix state of every context of four classes; log10 P(class | state)."""

    state: np.ndarray
    log_class: np.ndarray
    log_byte: np.ndarray
    depth: np.ndarray  # of the states

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        symbols, places = _symbols(raw, offsets)
        code = _codes(symbols)
        return np.add.reduceat(self.steps(symbols, code)[1], places[:-1])

    def steps(self, symbols: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The state before every symbol and log10 of the symbol's probability."""
        node = self.state[code >> np.uint32(BITS)]
        at = node * np.int32(CLASSES)
        at += (code & np.uint32(CLASSES - 1)).astype(np.int32)
        step = self.log_class.reshape(-1)[at]
        step += self.log_byte[symbols]
        return node, step

    def boundaries(self) -> tuple[np.ndarray, np.ndarray]:
        """log10 of the probabilities, in every state, of what ends a word (white space and the end) and of
        what ends white space (the end and all else)."""
        byte, ends = 10**self.log_byte, np.flatnonzero(_ENDS_WORD)
        each = 10 ** self.log_class[:, CLASS[ends]] * byte[ends]
        closes = each.sum(axis=1)
        return np.log10(closes), np.log10(np.maximum(1 - closes, 0) + each[:, -1])


def build_tree(counts: DataFrame, p_min: float = P_MIN) -> SuffixTree:
    """The tree from n-gram counts. Only contexts that are frequent enough reach the driver."""
    ngrams = counts.where("kind = 0")
    total = ngrams.agg(F.sum("n")).first()[0] or 0
    byte_counts = np.zeros(257)
    for row in counts.where("kind = 1").collect():
        byte_counts[row["code"]] = row["n"]
    by_class = np.bincount(CLASS, weights=byte_counts + 1, minlength=CLASSES)
    log_byte = np.log10((byte_counts + 1) / by_class[CLASS])
    state, tables, depths = np.zeros(1, dtype=np.int64), [], []
    for depth in range(DEPTH + 1):
        mask = (1 << (BITS * (depth + 1))) - 1
        parts = ngrams.groupBy(F.col("code").bitwiseAND(mask).alias("code")).agg(F.sum("n").alias("n"))
        whole = Window.partitionBy(F.shiftright("code", BITS))
        often = parts.withColumn("total", F.sum("n").over(whole)).where(F.col("total") >= max(1.0, p_min * total)).toPandas()
        code, n = often["code"].to_numpy(np.int64), often["n"].to_numpy(np.float64)
        contexts, back = np.unique(code >> BITS, return_inverse=True)
        table = np.zeros((len(contexts), CLASSES))
        table[back, code & (CLASSES - 1)] = n
        if depth == 0:
            table = table if len(table) else np.zeros((1, CLASSES))
            tables.append((table[0] + 1) / (table[0].sum() + CLASSES))
            depths.append(0)
            continue
        # the suffix state: without the oldest class
        state = np.tile(state, CLASSES)
        if not len(contexts):
            continue
        parent = np.stack(tables)[state[contexts]]
        size = table.sum(axis=1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            terms = np.where(table > 0, table * np.log(table / size / parent), 0.0)
        held = np.flatnonzero(terms.sum(axis=1) >= DIVERGENCE)
        smooth = (table[held] + WEIGHT * parent[held]) / (size[held] + WEIGHT)
        state[contexts[held]] = len(tables) + np.arange(len(held))
        tables.extend(smooth)
        depths.extend([depth] * len(held))
    return SuffixTree(state.astype(np.int32), np.log10(np.stack(tables)), log_byte, np.array(depths))


def _block(lowest: int, highest: int, rows: int, nulls: int) -> Column:
    """Blocks of about `BLOCK_IDS` rows with neighbouring doc_ids; rows without one are spread by their text."""
    width = min(max(1, (highest - lowest + 1) // max(rows, 1)) * BLOCK_IDS, 1 << 62)
    low = lowest // width  # blocks of null rows come before it
    spread = F.pmod(F.xxhash64("text"), F.lit(nulls // BLOCK_IDS + 1))
    return F.coalesce(F.floor(F.expr(f"doc_id div {width}L")), F.lit(min(low, 0) - 2).cast("bigint") - spread)


@dataclass
class Tokens:
    """The tokens of a block of texts: the words, lower case, and the end of each text."""

    token: np.ndarray  # hashes
    first: np.ndarray  # of each text
    word: np.ndarray  # not an end
    doc: np.ndarray
    starts: np.ndarray  # bytes of the words
    ends: np.ndarray

    def runs(self, most: int = 0):
        """For every size from 2: hashes of the runs that end at each token, and where the text has so many."""
        before = np.arange(len(self.token)) - self.first[self.doc]
        run = self.token
        for size in range(2, (most or ORDER) + 1):
            longer = self.token.copy()
            longer[1:] = mix(run[:-1] * _FACTOR + self.token[1:])
            run = longer
            yield run & ~np.uint64(2), before >= size - 1


_FACTOR = np.uint64(0xC2B2AE3D27D4EB4F)


def _tokens(raw: np.ndarray, offsets: np.ndarray) -> Tokens:
    """The tokens of the texts; `_HELD_OUT` is not set in a hash."""
    low = LOWER[raw]
    starts, ends, first = word_spans(low, offsets)
    first = first + np.arange(len(offsets))
    token = np.full(int(first[-1]), _LAST)
    word = np.ones(len(token), dtype=bool)
    word[first[1:] - 1] = False
    token[word] = hash_spans(low, starts, ends) & ~np.uint64(3)
    return Tokens(token, first, word, np.repeat(np.arange(len(offsets) - 1), np.diff(first)), starts, ends)


#: the bit of a hash that tells texts that are held out
_HELD_OUT = np.uint64(2)
#: bytes of text for a bucket of words or runs
BUCKET = 4 << 20
#: bits of the hash of a word; bits that the hash of a longer run has beyond those of the number of bytes, and has at least
WORD_BITS, MORE_BITS, LEAST_BITS = 62, 9, 36


def _planes(numbers: np.ndarray) -> list[bytes]:
    """The byte planes of numbers up to the highest that is used, each compressed for itself, or as it is when
    that is no shorter: the low planes of differences are noise and would spoil a common code."""
    planes = np.ascontiguousarray(numbers.astype("<u8")).view(np.uint8).reshape(-1, 8)
    used = max((int(numbers.max()).bit_length() + 7) // 8, 1) if len(numbers) else 0
    out = []
    for k in range(used):
        plane = planes[:, k].tobytes()
        small = pa.compress(plane, codec="zstd", asbytes=True)
        out.append(small if len(small) < len(plane) else plane)
    return out


def _numbers(data: bytes, at: int, lengths: list[int], n: int) -> np.ndarray:
    """`n` numbers from their byte planes, which begin at a place and have these lengths."""
    numbers = np.zeros((n, 8), dtype=np.uint8)
    for k, length in enumerate(lengths):
        plane = data[at : at + length]
        if length != n:
            plane = pa.decompress(plane, n, codec="zstd", asbytes=True)
        numbers[:, k] = np.frombuffer(plane, dtype=np.uint8)
        at += length
    return numbers.view("<u8").reshape(n)


def _packed(keys: np.ndarray, values: np.ndarray) -> bytes:
    """Sorted keys and a small number for each: byte planes of the differences and of the numbers."""
    low, high = _planes(np.diff(keys, prepend=np.uint64(0))), _planes(values)
    head = np.array([len(keys), len(low), *map(len, low + high)], dtype="<u4")
    return bytes([len(head)]) + head.tobytes() + b"".join(low + high)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    head = np.frombuffer(data, dtype="<u4", count=data[0], offset=1).tolist()
    n, low, at = head[0], head[1], 1 + 4 * data[0]
    keys = _numbers(data, at, head[2 : 2 + low], n)
    return np.cumsum(keys, dtype=np.uint64), _numbers(data, at + sum(head[2 : 2 + low]), head[2 + low :], n).astype(np.int64)


def _packed_counts(values: np.ndarray) -> bytes:
    """Small numbers as byte planes."""
    planes = _planes(values)
    head = np.array([len(values), *map(len, planes)], dtype="<u4")
    return bytes([len(head)]) + head.tobytes() + b"".join(planes)


def _unpacked_counts(data: bytes) -> np.ndarray:
    head = np.frombuffer(data, dtype="<u4", count=data[0], offset=1).tolist()
    return _numbers(data, 1 + 4 * data[0], head[1:], head[0]).astype(np.int64)


def _shortened(key: np.ndarray, width: int) -> np.ndarray:
    """The first `width` bits of hashes as the high bits of smaller numbers, two low bits free."""
    return (key >> np.uint64(64 - width)) << np.uint64(2)


def _block_runs(documents: DataFrame, size: int, bits: int, width: int) -> DataFrame:
    """(bucket, block, runs): the distinct runs of `size` tokens (words for 1) of a part of a block by the
    first `bits` of their hash, and how often they occur; those of texts that are held out stand apart."""

    def count(batches):
        for batch in batches:
            raw, offsets = column_bytes(batch.column(1))
            out = batch.column(2).to_numpy(zero_copy_only=False).astype(np.uint64) << np.uint64(1)
            group = batch.column(0).to_numpy(zero_copy_only=False)
            for low, _, part, places in blocks(raw, offsets, 8 << 20):
                found = _tokens(part, places)
                key, held = found.token, found.word
                for key, held in found.runs(size):
                    pass
                doc = found.doc[held] + low
                key = _shortened(key[held], width) | out[doc]
                rows: list[tuple[int, int, bytes]] = []
                for block in np.unique(group[low : low + len(places) - 1]):
                    every = np.sort(key[group[doc] == block])
                    edges = np.flatnonzero(np.append(np.diff(every) != 0, True)) + 1 if len(every) else np.zeros(0, np.int64)
                    every, n = every[edges - 1], np.diff(edges, prepend=0)
                    bucket = (every >> np.uint64(width + 2 - bits)).astype(np.int64)
                    edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
                    rows += [(int(bucket[i]), int(block), _packed(every[i:j], n[i:j])) for i, j in zip(edges, edges[1:])]
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["bucket", "block", "runs"])

    return documents.select("block", "text", "held_out").mapInArrow(count, "bucket bigint, block bigint, runs binary")


def _answers(texts: DataFrame, size: int, bits: int, width: int = WORD_BITS) -> DataFrame:
    """(b, bucket, more, different, n): for each block and bucket, for its words or runs in the order of their
    hashes, their count in all training texts less 1 if the block's training texts hold them; rows of zeros are
    left out. How many of a bucket have a count, and the sum, in one row of it."""

    def merge(table: pa.Table) -> pa.Table:
        parts: dict[int, list] = {}
        for block, data in zip(table.column("block").to_pylist(), table.column("runs").to_pylist()):
            parts.setdefault(block, []).append(_unpacked(data))
        found = []
        for block in parts:
            key, n = (np.concatenate(x) for x in zip(*parts[block]))
            if len(parts[block]) > 1:
                order = np.argsort(key)
                key, n = key[order], n[order]
            out, key = (key & _HELD_OUT) != 0, key & ~_HELD_OUT
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            found.append((key[first], np.add.reduceat(np.where(out, 0, n), first)))
        every, back = np.unique(np.concatenate([key for key, _ in found]), return_inverse=True)
        own = np.concatenate([n for _, n in found])
        c = np.bincount(back, weights=own, minlength=len(every)).astype(np.int64)
        more = c[back] - (own > 0)
        rows, low = [], 0
        for block, (key, _) in zip(parts, found):
            part = more[low : low + len(key)]
            low += len(key)
            if not rows:
                rows.append((block, _packed_counts(part), int((c > 0).sum()), int(c.sum())))
            elif part.any():
                rows.append((block, _packed_counts(part), 0, 0))
        blocks_, data, different, n = zip(*rows)
        return pa.table(
            {
                "b": pa.array(blocks_, pa.int64()),
                "bucket": pa.array([table.column("bucket")[0].as_py()] * len(rows), pa.int64()),
                "more": pa.array(data, pa.binary()),
                "different": pa.array(different, pa.int64()),
                "n": pa.array(n, pa.int64()),
            }
        )

    schema = "b bigint, bucket bigint, more binary, different bigint, n bigint"
    return _block_runs(texts, size, bits, width).groupBy("bucket").applyInArrow(merge, schema)


def _counts(keys: np.ndarray, answers: list[tuple[int, bytes]], shift: int) -> np.ndarray:
    """The count of each of a block's runs in all training texts. `answers` holds (bucket, numbers), the bucket of
    a run is its hash without the last `shift` bits."""
    order = np.argsort(keys)
    key = keys[order]
    trained = (key & _HELD_OUT) == 0
    key &= ~_HELD_OUT
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    # of equal runs, those of training texts come first
    total = trained[first].astype(np.int64)
    times, key = np.diff(first, append=len(key)), key[first]
    for which, data in answers:
        more = _unpacked_counts(data)
        low = int(np.searchsorted(key, np.uint64(which) << np.uint64(shift)))
        total[low : low + len(more)] += more
    count = np.empty(len(keys), dtype=np.int64)
    count[order] = np.repeat(total, times)
    return count


def _text_scores(tree: SuffixTree, part: np.ndarray, places: np.ndarray, found: Tokens, counts: list[np.ndarray], seen: int, distinct: int) -> np.ndarray:
    """log10 of the probability of each text. `counts` are those of the runs of 1 to ORDER tokens that end at
    each token, `seen` of all tokens, `distinct` of different ones."""
    symbols, at = _symbols(part, places)
    node, steps = tree.steps(symbols, _codes(symbols))
    sums = np.zeros(len(steps) + 1)
    np.cumsum(steps, out=sums[1:])
    closes, opens = tree.boundaries()
    # spelling of words, given that white space ends
    spelled = np.empty(len(found.token))
    starts, ends = found.starts + found.doc[found.word], found.ends + found.doc[found.word]
    spelled[found.word] = sums[ends] - sums[starts] + closes[node[ends]] - opens[node[starts]]
    last = at[1:] - 1
    spelled[~found.word] = steps[last] - opens[node[last]]
    # an end right after a word was drawn with the end of the word
    drawn = np.ones(len(found.token), dtype=bool)
    drawn[~found.word] = (last == at[:-1]) | _ENDS_WORD[symbols[last - 1]]
    prior = spelled * np.log(10)
    with np.errstate(divide="ignore"):
        p = np.logaddexp(np.log(counts[0]), np.log(distinct) + prior) - np.log(seen + distinct)
        for size, (_, held) in enumerate(found.runs(), 2):
            h = np.flatnonzero(held)
            context = counts[size - 2][h - 1]
            p[h] = np.logaddexp(np.log(counts[size - 1][h]), np.log(WORD_WEIGHT) + p[h]) - np.log(context + WORD_WEIGHT)
    gain = np.where(drawn, (p - prior) / np.log(10), 0.0)
    return np.diff(sums[at]) + np.bincount(found.doc, weights=gain, minlength=len(places) - 1)


_ROW = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, log_sum double, score double"


def suffix_tree_scores(documents: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; `held_out` marks rows not learned from."""
    spark = documents.sparkSession
    texts = documents.select("doc_id", "text", held_out.alias("held_out"))
    size = texts.agg(
        F.min("doc_id").alias("lowest"), F.max("doc_id").alias("highest"), F.count("doc_id").alias("rows"), F.count_if(F.isnull("doc_id")).alias("nulls"),
        F.sum(F.octet_length("text")).alias("bytes"), F.count_if(~F.col("held_out")).alias("ends"),
    ).first()
    bits, ends = ((size["bytes"] or 0) // BUCKET).bit_length(), size["ends"]
    width = min(WORD_BITS, max(LEAST_BITS, (size["bytes"] or 0).bit_length() + MORE_BITS))
    texts = texts.withColumn("block", _block(size["lowest"] or 0, size["highest"] or 0, size["rows"], size["nulls"]))
    tree = spark.sparkContext.broadcast(build_tree(store(_ngram_counts(texts), "ngrams")))
    release(spark)
    # one size after the other, so that only its runs are on disk
    answers = []
    for tokens_of_run in range(1, ORDER + 1):
        answers.append(store(_answers(texts, tokens_of_run, bits, WORD_BITS if tokens_of_run == 1 else width), "runs"))
        release(spark)
    row = answers[0].agg(F.sum("different").alias("words"), F.sum("n").alias("n")).first()
    tokens, distinct = (row["n"] or 0) + ends, (row["words"] or 0) + (ends > 0)
    runs = reduce(DataFrame.unionByName, (a.select("b", "bucket", "more", F.lit(k).alias("size")) for k, a in enumerate(answers, 1)))

    kind = np.uint32 if tokens < 1 << 32 else np.int64

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        answered: dict[int, list] = {size: [] for size in range(1, ORDER + 1)}
        for size, bucket, data in zip(*(right.column(c).to_pylist() for c in ("size", "bucket", "more"))):
            answered[size].append((bucket, data))
        raw, offsets = column_bytes(left.column("text"))
        out = left.column("held_out").to_numpy().astype(np.uint64) << np.uint64(1)
        columns: list[list[np.ndarray]] = [[], [], [], []]
        parts = [(low, part, places, _tokens(part, places)) for low, _, part, places in blocks(raw, offsets, SCORED)]
        counts: list[list[np.ndarray]] = [[] for _ in parts]
        # one size after the other, so that the hashes of one are held
        sizes = zip(*(chain([(found.token, found.word)], found.runs()) for *_, found in parts))
        for size, runs in enumerate(sizes, 1):
            bits_of_key = WORD_BITS if size == 1 else width
            keys = np.concatenate([_shortened(run[held], bits_of_key) | out[found.doc[held] + low] for (run, held), (low, _, _, found) in zip(runs, parts)])
            every = _counts(keys, answered.pop(size), bits_of_key + 2 - bits)
            ends_of = np.cumsum([np.count_nonzero(held) for _, held in runs])
            for (run, held), mine, own in zip(runs, counts, np.split(every, ends_of[:-1])):
                mine.append(np.zeros(len(run), dtype=kind))
                mine[-1][held] = own
            del keys, every, runs, own
        while parts:
            (_, part, places, found), mine = parts.pop(0), counts.pop(0)
            first = found.first - np.arange(len(found.first))
            for column, values in zip(columns, (np.log10(mine[0] + 1.0), (mine[0] > 0).astype(np.float64))):
                column.append(np.diff(np.concatenate([[0.0], np.cumsum(values[found.word])])[first]))
            columns[2].append(np.diff(found.first))
            mine[0][~found.word] = ends
            columns[3].append(_text_scores(tree.value, part, places, found, mine, tokens, max(distinct, 1)))
        sums, known, lengths, scores = (np.concatenate(x) if x else np.zeros(0) for x in columns)
        return pa.table(
            {
                "doc_id": left.column("doc_id"),
                "held_out": left.column("held_out"),
                "n_tokens": pa.array(lengths.astype(np.int64)),
                "n_known": pa.array(known.round().astype(np.int64)),
                "log_sum": pa.array(sums),
                "score": pa.array(scores),
            }
        )

    scored = texts.groupBy("block").cogroup(runs.groupBy("b")).applyInArrow(score, _ROW)
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + int(ends > 0)).alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("log_sum") + float(np.log10(ends + 1.0)) - F.col("n_tokens") * float(np.log10(tokens + distinct + 1.0))).alias("base_score"),
        "score",
    )
