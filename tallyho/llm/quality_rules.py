"""Quality rules as a bitmask ledger.

Every rule is evaluated once; the ledger holds a row's measurements and one long whose bit
k says that rule k failed.  Policies are versioned sets of rules: applying one is a bitwise
AND, and ablations come from the counts per distinct bitmask.  Built-in functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_ENDS, is_word_text, neutral

SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``fails``, SQL over the measurements, holds."""

    name: str
    fails: str


# The place of a rule is its bit and never changes; new rules are appended.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "100 * n_symbols > 5 * word_chars"),
    Rule("repeated_lines", "100 * n_dup_lines > 40 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 30 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """The rules that a version of the policy applies."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {r.name: 1 << k for k, r in enumerate(RULES)}
        return sum(bits[name] for name in self.rules)


BASE = Policy("base", ("few_words", "repeated_words"))
DEFAULT = Policy("1", ("few_words", "repeated_words", "symbols", "repeated_lines", "short_words", "long_words"))


def measured(docs: DataFrame, prefix: str = "_q_") -> DataFrame:
    """``docs`` with its measurements as ``<prefix><measure>``.

    Null and empty texts measure 0 everywhere.  Other columns stay as they are; a column that
    already has the prefix must not exist.
    """
    p = prefix
    # each step is a projection of its own, whose columns the next one uses several times
    df = docs.withColumn(f"{p}t", F.coalesce(F.col("text").cast("string"), F.lit("")))
    df = df.withColumns({
        f"{p}w": F.filter(F.split(f"{p}t", "[ \\t\\n\\x0B\\f\\r]+"), lambda x: x != ""),
        f"{p}l": F.filter(F.split(f"{p}t", "\n"), is_word_text),
        f"{p}word_chars": F.length(F.translate(f"{p}t", WORD_ENDS, "")).cast("long"),
        f"{p}n_symbols": (F.length(f"{p}t") - F.length(F.translate(f"{p}t", SYMBOLS, ""))).cast("long")})
    df = df.withColumns({
        f"{p}n_words": F.size(f"{p}w").cast("long"), f"{p}n_lines": F.size(f"{p}l").cast("long"),
        f"{p}n_dup_lines": (F.size(f"{p}l") - F.size(F.array_distinct(f"{p}l"))).cast("long"),
        # a 64-bit hash of the three words that begin at each place
        f"{p}h": F.expr(f"if(size({p}w) >= 3, transform(sequence(0, size({p}w) - 3), i -> "
                        f"xxhash64(get({p}w, i), get({p}w, i + 1), get({p}w, i + 2))), cast(array() as array<bigint>))")})
    # only texts with a repeated window are sorted: equal windows are then neighbours
    df = df.withColumn(f"{p}s", F.expr(
        f"if(size(array_distinct({p}h)) < size({p}h), sort_array(transform({p}h, (h, i) -> struct(h as h, i as i))), null)"))
    df = df.withColumn(f"{p}r", F.expr(
        f"sort_array(transform(filter({p}s, (x, j) -> x.h <=> get({p}s, j - 1).h or x.h <=> get({p}s, j + 1).h), x -> x.i))"))
    # places covered by windows of three that begin at the (ascending) places r
    df = df.withColumn(f"{p}n_repeat_words", F.expr(
        f"coalesce(aggregate(transform({p}r, (x, j) -> least(3, coalesce(get({p}r, j + 1) - x, 3))), 0L, (a, x) -> a + x), 0L)"))
    return df.drop(*[f"{p}{c}" for c in "twlhsr"])


def _bits(prefix: str) -> Column:
    def fails(rule: Rule) -> str:
        sql = rule.fails
        for m in sorted(MEASURES, key=len, reverse=True):
            sql = sql.replace(m, f"`{prefix}{m}`") if f"`{prefix}{m}`" not in sql else sql
        return sql
    total = F.lit(0).cast("long")
    for k, rule in enumerate(RULES):
        total = total.bitwiseOR(F.when(F.expr(fails(rule)), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return total


def ledger(docs: DataFrame) -> DataFrame:
    """``doc_id``, the measurements and ``failed`` (bit k: rule k failed) of every row.

    Rows with a null or repeated doc_id have rows of their own; an empty table gives an
    empty ledger.
    """
    df = measured(docs.select("doc_id", "text"))
    return df.select("doc_id", *[F.col(f"_q_{m}").alias(m) for m in MEASURES], _bits("_q_").alias("failed"))


def fails(policy: Policy, failed: str = "failed") -> Column:
    """Whether any rule of the policy failed."""
    return F.col(failed).bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def verdicts(rows: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """A ledger with ``base_failed`` and ``kept``: no rule of the base or of the policy failed."""
    return rows.withColumn("base_failed", fails(BASE)).withColumn("kept", ~F.col("base_failed") & ~fails(policy))


def ablations(rows: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Per rule of the policy: rows that fail it, that fail it alone, and that the policy keeps without it.

    The ledger is aggregated to one row per distinct bitmask first (at most 2**rules).
    """
    masks = rows.groupBy("failed").count()
    bits = [(r.name, 1 << k) for k, r in enumerate(RULES) if r.name in policy.rules]
    sums = []
    for name, bit in bits:
        hit, rest = F.col("failed").bitwiseAND(F.lit(bit).cast("long")) != 0, F.lit(policy.mask & ~bit).cast("long")
        others = F.col("failed").bitwiseAND(rest) != 0
        sums.append(F.struct(F.lit(name).alias("rule"),
                             F.coalesce(F.sum(F.when(hit, F.col("count"))), F.lit(0)).alias("n_failed"),
                             F.coalesce(F.sum(F.when(hit & ~others, F.col("count"))), F.lit(0)).alias("n_failed_alone"),
                             F.coalesce(F.sum(F.when(~others, F.col("count"))), F.lit(0)).alias("n_kept_without")))
    return masks.agg(F.array(*sums).alias("_all")).select(F.inline("_all"))


def keep_passing(docs: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """The rows of ``docs``, all columns, that pass the base and the policy.

    The counters also keep the filter above the measuring: pushed below, its condition would
    hold every measurement's expression several times over.  Null and empty texts fail; rows
    with a null or repeated doc_id are judged each.  Other columns may have any names; an
    empty table gives an empty result.
    """
    plain, back = neutral(docs, "text")
    both = Policy(policy.version, tuple(sorted({*BASE.rules, *policy.rules})))
    rows = measured(plain).withColumn("_q_failed", _bits("_q_"))
    rows = rows.observe(f"quality rules {policy.version}", F.count(F.lit(1)).alias("rows"), F.count_if(fails(both, "_q_failed")).alias("rejected"))
    return back(rows.filter(~fails(both, "_q_failed")))
