"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per text. The ledger stores the measurements and one
integer whose bit ``i`` says that rule ``i`` failed; policies are versions of a bit
mask over the same ledger, so changing a policy, comparing two or finding out what
a single rule removes (:func:`ablation`) reads integers and never texts again.

Everything is a projection over the scan: nothing is shuffled, and a text is
handled within its row whatever its length. Built-in functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BLANK = "[\\x20\\x09-\\x0D]+"
_SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A named condition that a text fails, over the columns of :func:`measured`."""

    name: str
    fails: str


# A rule's place in this list is its bit; new rules are only ever appended.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "5 * n_symbols > n_words"),
    Rule("duplicate_lines", "n_lines > 2 AND 2 * n_dup_lines > n_lines"),
    Rule("shouting", "n_letters_upper * 10 > 3 * n_chars"),
    Rule("word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)"),
)

BASE = ("few_words", "repeated_words")

# Policies by version: the rules that reject a text.
POLICIES = {
    "v1": BASE,
    "v2": (*BASE, "symbols", "duplicate_lines"),
    "v3": (*BASE, "symbols", "duplicate_lines", "shouting", "word_length"),
}


def mask(names, rules=RULES) -> int:
    """The bits of the named rules; a name that is no rule raises."""
    place = {r.name: i for i, r in enumerate(rules)}
    return sum(1 << place[n] for n in set(names))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the measurements of each text; NULL and empty texts measure 0.

    Words stand between blanks (space, tab to carriage return). ``n_repeat_words``
    counts the words inside three-word windows found at least twice in the text,
    windows being compared by a 64-bit fingerprint. Repeated rows are measured alike.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("t"))
    words = F.filter(F.split("t", _BLANK), lambda w: w != "")
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    out = source.select(
        "doc_id", F.length("t").cast("long").alias("n_chars"),
        (F.length("t") - F.length(F.translate("t", _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("t", _BLANK, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("t", "[^\\p{Lu}]+", "")).cast("long").alias("n_letters_upper"),
        lines.alias("lines"), words.alias("words"),
    ).select(
        "doc_id", "n_chars", "n_symbols", "word_chars", "n_letters_upper",
        F.size("words").cast("long").alias("n_words"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated_windows("words").alias("repeated"),
    ).withColumn("n_repeat_words", _covered("repeated", 3)).drop("repeated")
    # A generator of one row: filters on the measurements stay above it, where they
    # read values, instead of being rewritten into the expressions over the words.
    packed = F.struct(*out.columns)
    return out.select(F.explode(F.array(packed)).alias("m")).select("m.*")


def _repeated_windows(words: str) -> Column:
    """Sorted first words (from 0) of the three-word windows that occur again."""
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(
            F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")
        ),
    )
    windows = F.when(F.size(words) >= 4, F.sort_array(windows))
    # Bound to a lambda variable, so that the sorted array is computed once per row.
    return F.flatten(
        F.transform(
            F.array(windows),
            lambda s: F.transform(
                F.filter(
                    s,
                    lambda x, k: F.coalesce(
                        (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), F.lit(False)
                    ),
                ),
                lambda x: x["i"],
            ),
        )
    )


def _covered(starts: str, width: int) -> Column:
    """Places inside any window that begins at one of the places."""
    total = F.aggregate(
        F.sort_array(starts),
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, i: F.struct(
            (i + width).alias("end"), (acc["n"] + i + width - F.greatest(acc["end"], i)).alias("n")
        ),
        lambda acc: acc["n"],
    )
    return F.coalesce(total, F.lit(0)).cast("long")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """The measurements with ``fail_bits``. A rule that yields NULL has not failed."""
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measured(docs, id_col, text_col).withColumn("fail_bits", bits)


def apply_policy(rows: DataFrame, policy: str, policies=POLICIES, rules=RULES) -> DataFrame:
    """Adds ``base_failed`` and ``kept`` under a version of the policy."""
    def fails(names):
        return F.col("fail_bits").bitwiseAND(F.lit(mask(names, rules)).cast("long")) != 0

    return rows.withColumn("base_failed", fails(BASE)).withColumn(
        "kept", ~(F.col("base_failed") | fails(policies[policy]))
    )


def only_rule(policy: str, policies=POLICIES, rules=RULES) -> Column:
    """Name of the rule without which the policy would keep the row, from the ledger's bits alone.

    NULL for rows that are kept, and for those that several rules reject.
    """
    under = F.col("fail_bits").bitwiseAND(F.lit(mask(policies[policy], rules)).cast("long"))
    names = F.lit(None).cast("string")
    for name in policies[policy]:
        names = F.when(under == F.lit(mask([name], rules)), name).otherwise(names)
    return names


def ablation(rows: DataFrame, policies=POLICIES, rules=RULES) -> DataFrame:
    """Per policy and rule: texts that fail it, and texts that only it rejects.

    ``rows`` is reduced to one row per distinct set of failures first, of which
    there are at most two to the number of rules.
    """
    sets = rows.groupBy("fail_bits").agg(F.count("*").alias("n"))
    spark = rows.sparkSession
    table = spark.createDataFrame(
        [(p, mask(names, rules), n, mask([n], rules)) for p, names in policies.items() for n in names],
        "policy string, mask long, rule string, bit long",
    )
    under = F.col("fail_bits").bitwiseAND(F.col("mask"))
    return (
        sets.join(F.broadcast(table), under.bitwiseAND(F.col("bit")) != 0)
        .groupBy("policy", "rule")
        .agg(
            F.sum("n").alias("n_failed"),
            F.sum(F.when(under == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
        )
    )


def keep_good(
    docs: DataFrame, policy: str = "v3", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows of ``docs`` whose text the policy keeps, repeated rows included.

    Decided on each row itself, so ids may repeat or be NULL.
    """
    text, names = F.col(f"`{text_col}`"), [F.col(f"`{c}`") for c in docs.columns]
    # The row travels as a struct through the measuring projection: no join is needed.
    packed = docs.select(F.struct(*names).alias("row"), text.alias("text"))
    judged = apply_policy(ledger(packed, "row", "text"), policy)
    return judged.filter("kept").select(*[F.col("doc_id").getField(c).alias(c) for c in docs.columns])


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, t,
    list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), win AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)
), rep AS (
  SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), cov AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, len(words) AS n_words, length(t) AS n_chars,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) AS n_letters_upper,
    coalesce(cov.n, 0) AS n_repeat_words
  FROM w LEFT JOIN cov USING (doc_id)
), b AS (
  SELECT *,
    (n_words < 50)::INT AS b0, (100 * n_repeat_words > 50 * n_words)::INT AS b1,
    (5 * n_symbols > n_words)::INT AS b2, (n_lines > 2 AND 2 * n_dup_lines > n_lines)::INT AS b3,
    (n_letters_upper * 10 > 3 * n_chars)::INT AS b4,
    (n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words))::INT AS b5
  FROM m
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, b0 + b1 > 0 AS base_failed,
  b0 + b1 + b2 + b3 + b4 + b5 = 0 AS kept,
  (b0 + 2 * b1 + 4 * b2 + 8 * b3 + 16 * b4 + 32 * b5)::BIGINT AS fail_bits,
  CASE WHEN b0 + b1 + b2 + b3 + b4 + b5 = 1 THEN
    CASE WHEN b0 = 1 THEN 'few_words' WHEN b1 = 1 THEN 'repeated_words' WHEN b2 = 1 THEN 'symbols'
      WHEN b3 = 1 THEN 'duplicate_lines' WHEN b4 = 1 THEN 'shouting' ELSE 'word_length' END
  END AS only_rule
FROM b
"""
