"""Quality rules as a bitmask ledger, in DataFrame functions only.

Each rule is evaluated once for each document: `rule_ledger` stores the measurements and one bit per failed rule.
Policies are versioned masks over those bits, so that applying another policy, or asking what a rule costs
(`ablation`), reads the ledger's integers and never the texts again.

Defined cases: a null or empty text has no words, so it measures zero everywhere and fails `few_words`; repeated rows
are measured each on its own; an empty table gives an empty ledger; a null doc_id passes through; columns other than
the two named ones are ignored, whatever they are called.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from germlight.llm._shared import WORD, let

#: The symbols that count.
SYMBOLS = "[^#*$%&|<>]+"
#: Bits of a packed (hash, position) pair that hold the position.
POSITION_BITS = 24


def _repeated(words: Column) -> Column:
    """Words inside 3-word windows that the text has twice or more, first ones included.

    Windows are sorted as longs, 40 bits of hash over 24 bits of position; neighbours with one hash are candidates, and only those are compared as
    strings. Texts of 2^24 words and more take the string sort for all windows.
    """
    gram = lambda p: F.concat_ws(" ", F.get(words, p), F.get(words, p + 1), F.get(words, p + 2))
    near = lambda s, key: F.filter(s, lambda x, i: (key(x) == key(F.get(s, i - 1))) | (key(x) == key(F.get(s, i + 1))))
    starts = F.sequence(F.lit(0), F.size(words) - 3)
    packed = F.transform(starts, lambda i: F.shiftleft(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)), POSITION_BITS).bitwiseOR(i.cast("long")))
    hashed = let(F.sort_array(packed), lambda s: F.transform(near(s, lambda x: F.shiftright(x, POSITION_BITS)), lambda x: x.bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).cast("int")))
    candidates = F.when(F.size(words) < (1 << POSITION_BITS), hashed).otherwise(starts)
    exact = lambda c: let(F.sort_array(F.transform(c, lambda p: F.struct(gram(p).alias("g"), p.alias("p")))), lambda s: F.transform(near(s, lambda x: x["g"]), lambda x: x["p"]))
    covered = lambda q: F.aggregate(F.transform(q, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(q, i + 1) - p, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x)
    found = let(candidates, lambda c: F.when(F.size(c) == 0, F.lit(0).cast("long")).otherwise(let(F.sort_array(exact(c)), covered)))
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(found)


def measurements(text: Column) -> Column:
    """A struct of all that the rules look at, each computed once."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    kept = lambda pattern: F.length(F.regexp_replace(text, pattern, "")).cast("long")
    of_words = let(
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), _repeated(w).alias("n_repeat_words")),
    )
    of_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return F.struct(of_words.alias("w"), of_lines.alias("l"), kept(SYMBOLS).alias("n_symbols"), kept(r"\P{Lu}+").alias("n_upper"), kept(r"\P{L}+").alias("n_letters"), kept("[^!]+").alias("n_bangs"))


#: What rule_ledger returns for each document, apart from the id and the bits.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_bangs")

#: Rules in bit order: a document fails where the SQL condition over MEASURES holds. Append only: stored bits keep their meaning.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbol_heavy", "10 * n_symbols > 3 * n_words"),
    ("duplicate_lines", "n_lines >= 4 and 100 * n_dup_lines > 40 * n_lines"),
    ("shouting", "n_letters >= 20 and 100 * n_upper > 60 * n_letters"),
    ("word_length", "n_words > 0 and (word_chars < 2 * n_words or word_chars > 15 * n_words)"),
    ("exclaiming", "10 * n_bangs > 5 * n_words and n_bangs > 5"),
)
BIT = {name: i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A named, versioned choice of rules; a document is kept if none of them failed."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << BIT[r] for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
STANDARD = Policy("standard", 1, tuple(BIT))


def rule_ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, MEASURES and fail_bits (long; bit i: rule i failed) of every row. A narrow plan: no shuffle."""
    m = docs.select(F.col(id_col), measurements(F.col(text_col)).alias("_m"))
    m = m.select(id_col, *_measures())
    return m.withColumn("fail_bits", fail_bits())


def keep(docs: DataFrame, policy: Policy = STANDARD, text_col: str = "text") -> DataFrame:
    """The rows of docs that pass, with all their columns."""
    # explode() of one struct computes the measurements once; a plain projection would be copied into the filter, once a rule.
    rows = docs.select(F.struct("*").alias("_row"), F.explode(F.array(measurements(F.col(text_col)))).alias("_m"))
    return rows.select("_row", *_measures()).where(passes(policy, fail_bits())).select("_row.*")


def _measures() -> list[Column]:
    group = {"n_words": "w.", "word_chars": "w.", "n_repeat_words": "w.", "n_lines": "l.", "n_dup_lines": "l."}
    return [F.coalesce(F.col(f"_m.{group.get(c, '')}{c}"), F.lit(0).cast("long")).alias(c) for c in MEASURES]


def fail_bits() -> Column:
    bits = F.lit(0).cast("long")
    for i, (_, condition) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return bits


def passes(policy: Policy, bits: Column | None = None) -> Column:
    return (F.col("fail_bits") if bits is None else bits).bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def apply_policies(ledger: DataFrame, *policies: Policy) -> DataFrame:
    """One boolean column <name>_v<version> for each policy."""
    return ledger.withColumns({f"{p.name}_v{p.version}": passes(p) for p in policies})


def ablation(ledger: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of the policy: documents failing it, failing it alone (kept if the rule went), and those kept by the other rules.

    Documents are first counted by their masked bits (2^rules groups at most, partial counts before the shuffle); the rest is arithmetic on that.
    """
    masked = F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long"))
    counts = ledger.groupBy(masked.alias("bits")).agg(F.count("*").alias("n"))
    one = F.col("one")
    rules = F.explode(F.array(*(F.struct(F.lit(BIT[r]).alias("bit"), F.lit(1 << BIT[r]).cast("long").alias("one"), F.lit(r).alias("rule")) for r in policy.rules)))
    each = counts.select("bits", "n", rules.alias("r")).select("bits", "n", "r.bit", "r.one", "r.rule")
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")
    return each.groupBy("rule", "bit").agg(
        total(F.col("bits").bitwiseAND(one) != 0).alias("n_failed"),
        total(F.col("bits") == one).alias("n_failed_alone"),
        total(F.col("bits") == 0).alias("n_kept"),
        total(F.col("bits").bitwiseAND(F.bitwise_not(one)) == 0).alias("n_kept_without"),
    )


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    from germlight.llm._shared import table

    ledger = apply_policies(rule_ledger(table(spark, sf_dir, "documents")), BASE, STANDARD)
    return ledger.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~F.col("base_v1")).alias("base_failed"), F.col("standard_v1").alias("kept"), "fail_bits")


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (SELECT rid, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM g) WHERE c > 1),
c AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest([i, i+1, i+2]) AS p FROM r) GROUP BY rid),
l AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines FROM (SELECT rid, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
  length(regexp_replace(t, '\P{Lu}+', '', 'g')) AS n_upper, length(regexp_replace(t, '\P{L}+', '', 'g')) AS n_letters, length(regexp_replace(t, '[^!]+', '', 'g')) AS n_bangs
  FROM d JOIN w USING (rid) LEFT JOIN c USING (rid) LEFT JOIN l USING (rid)),
b AS (SELECT *, CAST((n_words < 50)::INT + (100 * n_repeat_words > 50 * n_words)::INT * 2 + (10 * n_symbols > 3 * n_words)::INT * 4
  + (n_lines >= 4 AND 100 * n_dup_lines > 40 * n_lines)::INT * 8 + (n_letters >= 20 AND 100 * n_upper > 60 * n_letters)::INT * 16
  + (n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words))::INT * 32 + (10 * n_bangs > 5 * n_words AND n_bangs > 5)::INT * 64 AS BIGINT) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM b
"""
