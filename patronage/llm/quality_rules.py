"""Quality rules as a ledger of bits, in DataFrame functions only.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per failed
rule; a policy is a mask over the bits, so a new policy, or the effect of leaving a rule out, needs
no text and no rule again. Nothing is shuffled: every measurement of a text is made in its row.

Words are `[^\\x20\\x09-\\x0D]+`. A null text has no words and one empty line. Null doc_ids, repeated rows
and further columns pass; every input row gets one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WORD = r"[^\x20\x09-\x0D]+"

#: failed when true; the position is the bit
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
    ("symbols", "100 * n_symbols > 20 * n_words"),
    ("repeated_lines", "n_lines > 1 and 100 * n_dup_lines > 50 * n_lines"),
    ("shouting", "100 * n_capitals > 40 * word_chars"),
]
BASE = 0b0000011
#: versions of the policy: which failures reject a document
POLICIES = {"v1": BASE, "v2": 0b0011111, "v3": 0b1111111}


def measure(documents: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """doc_id and the measurements of each text; `carry` names columns to keep, in a struct `row`."""
    text = F.coalesce("text", F.lit(""))
    row = [F.struct(*(F.col(c) for c in carry)).alias("row")] if carry else []
    kept = ["row"] if carry else []
    split = documents.select("doc_id", *row, text.alias("text"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"))
    windows = F.greatest(F.size("words") - 2, F.lit(0))
    parts = F.arrays_zip(*(F.slice("words", k, windows).alias(f"w{k}") for k in (1, 2, 3)))
    solid = split.select(
        "doc_id",
        *kept,
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("bigint").alias("n_capitals"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.transform(parts, lambda p: F.xxhash64(p["w1"], p["w2"], p["w3"])).alias("windows"),
    )
    n = F.size("windows")
    numbered = F.arrays_zip(F.col("windows").alias("h"), F.sequence(F.lit(1), n).alias("i"))
    # most texts have no equal windows and need no sorting by place
    placed = solid.select(
        "doc_id", *kept, "n_words", "word_chars", "n_symbols", "n_capitals",
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("windows")) < n, F.sort_array(numbered)).alias("placed"),
    )
    return placed.withColumn("n_repeat_words", F.coalesce(_repeat_words("placed"), F.lit(0)).cast("bigint")).drop("placed")


def _repeat_words(placed: str) -> Column:
    """Words inside windows that occur twice or more: equal windows stand side by side once sorted."""
    n = F.size(placed)
    beside = F.arrays_zip(F.slice(placed, 1, n - 1).alias("a"), F.slice(placed, 2, n - 1).alias("b"))
    equal = F.filter(beside, lambda p: p["a"]["h"] == p["b"]["h"])
    first = F.flatten(F.transform(equal, lambda p: F.array(p["a"]["i"], p["b"]["i"])))
    covered = F.flatten(F.transform(F.array_distinct(first), lambda i: F.array(i, i + 1, i + 2)))
    return F.when(F.col(placed).isNotNull(), F.size(F.array_distinct(covered)))


def ledger(documents: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """The measurements of each document and `failed`, the bits of the rules it breaks."""
    bits = [F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)) for k, (_, rule) in enumerate(RULES)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measure(documents, carry).withColumn("failed", failed)


def apply_policy(entries: DataFrame, policy: str = "v3") -> DataFrame:
    """Adds base_failed and kept, by the mask of the policy."""
    return entries.withColumn("base_failed", F.col("failed").bitwiseAND(BASE) != 0).withColumn(
        "kept", F.col("failed").bitwiseAND(POLICIES[policy] | BASE) == 0
    )


def ablation(entries: DataFrame, policy: str = "v3") -> DataFrame:
    """Per rule of the policy: documents failing it, failing only it, and kept without it.

    The documents are first counted by their bits, at most 2 to the number of rules.
    """
    mask = POLICIES[policy]
    counts = entries.groupBy(F.col("failed").bitwiseAND(mask).alias("bits")).agg(F.count("*").alias("n"))

    def where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("bigint")

    columns = []
    for k, (name, _) in enumerate(RULES):
        if mask >> k & 1:
            without = F.col("bits").bitwiseAND(mask & ~(1 << k))
            columns.append(
                F.struct(
                    F.lit(name).alias("rule"),
                    where(F.col("bits").bitwiseAND(1 << k) != 0).alias("n_failed"),
                    where(F.col("bits") == 1 << k).alias("n_only"),
                    where(without == 0).alias("n_kept_without"),
                )
            )
    return counts.agg(F.array(*columns).alias("rows")).select(F.inline("rows"))


def quality_rules(documents: DataFrame, policy: str = "v3", carry: list[str] | None = None) -> DataFrame:
    """Measurements, failed bits, base_failed and kept, one row per input row; `carry` as in `measure`."""
    return apply_policy(ledger(documents, carry), policy)


MEASURES_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
w AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM s),
g AS (SELECT doc_id, i, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w, w2, w3) AS n FROM g WHERE w3 IS NOT NULL),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM c, (VALUES (0), (1), (2)) AS t(k) WHERE n > 1 GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
b AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM l
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT s.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(text) - length(regexp_replace(text, '\p{Lu}', '', 'g')) AS BIGINT) AS n_capitals,
    CAST(coalesce(b.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(b.n_dup, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM s LEFT JOIN b ON b.doc_id = s.doc_id LEFT JOIN r ON r.doc_id = s.doc_id)
"""

ORACLE = (
    MEASURES_SQL
    + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
    OR 100 * n_symbols > 20 * n_words OR (n_lines > 1 AND 2 * n_dup_lines > n_lines) OR 100 * n_capitals > 40 * word_chars) AS kept
FROM m
"""
)
