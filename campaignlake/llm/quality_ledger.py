"""Quality rules as a bitmask ledger.

Every rule is evaluated once. The ledger holds the measurements and one bit per failed rule; a policy
is a versioned set of rules, so applying one, or asking what a rule adds to it, needs no second look
at the texts: verdicts and ablations are bit operations on the ledger.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import SEPARATORS, text_or_empty, words

# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 5

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]

# Name of a rule and when a row of measurements fails it. The position is the rule's bit, so rules are
# only ever added at the end. Integer comparisons keep them exact in any engine.
RULES: list[tuple[str, str]] = [
    ("too_few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 25 * n_words)"),
    ("symbols", "10 * n_symbols > n_words AND n_words > 0"),
    ("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
]
BITS = {name: 1 << k for k, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A versioned set of rules."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return reduce(int.__or__, (BITS[r] for r in self.rules), 0)


BASE = Policy("base", 1, ("too_few_words", "repeated_words"))
STANDARD = Policy("standard", 1, tuple(name for name, _ in RULES))
POLICIES = [BASE, STANDARD]


def repeated_words(found: Column, window: int = WINDOW) -> Column:
    """Words in windows of `window` consecutive words that occur twice or more in the array.

    Window texts are compared, not hashes. Most texts repeat no window, which the first comparison
    tells; the others sort their windows by text and then count the union of the repeated ones'
    positions.
    """
    last = F.size(found) - (window - 1)
    # Words hold no space, so joined windows are equal only if their words are.
    windows = F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(found, i, window), " "))
    def covered(rows: Column) -> Column:
        size = F.size(rows)
        step = F.transform(
            rows,
            lambda row, i: F.when(
                ((i > 0) & (F.get(rows, i - 1)["text"] == row["text"]))
                | ((i < size - 1) & (F.get(rows, i + 1)["text"] == row["text"])),
                row["at"],
            ),
        )
        return F.sort_array(F.filter(step, lambda at: at.isNotNull()))

    def union_size(at: Column) -> Column:
        following = F.slice(at, F.lit(2), F.greatest(F.size(at) - 1, F.lit(0)))
        gaps = F.zip_with(
            at, following, lambda a, b: F.coalesce(F.least(b - a, F.lit(window)), F.lit(window)).cast("long")
        )
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, x: total + x)

    # A one-element transform names an intermediate array without computing it again.
    def once(value: Column, use) -> Column:
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def count(found_windows: Column) -> Column:
        return F.when(
            F.size(F.array_distinct(found_windows)) == F.size(found_windows), F.lit(0).cast("long")
        ).otherwise(
            once(
                F.sort_array(
                    F.transform(found_windows, lambda text, i: F.struct(text.alias("text"), i.alias("at")))
                ),
                lambda rows: once(covered(rows), union_size),
            )
        )

    return F.when(last < 2, F.lit(0).cast("long")).otherwise(once(windows, count))


def measure(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """`docs` with a struct column `ledger_measures` of the counts in MEASURES, all long."""
    text = text_or_empty(text_column)
    taken = set(docs.columns)
    hold = next(name for name in (f"ledger_words{'_' * k}" for k in range(len(taken) + 1)) if name not in taken)
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    n_lines = F.size(lines)
    out = docs.withColumn(hold, words(text))
    found = F.col(hold)
    counts = F.struct(
        F.size(found).cast("long").alias("n_words"),
        F.length(F.translate(text, SEPARATORS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (n_lines - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeated_words(found).alias("n_repeat_words"),
        n_lines.cast("long").alias("n_lines"),
    )
    return out.withColumn("ledger_measures", counts).drop(hold)


def ledger(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id, the counts in MEASURES and `failed_bits` of all rules.

    A null text counts as one without words. Repeated rows and rows without an id get rows of their
    own; other columns are not read. An empty table gives an empty ledger. Store it before filtering by its
    columns: Spark pushes a filter below the measurements and computes them again inside it.
    """
    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    rows = measure(source).select("doc_id", *[F.col("ledger_measures")[m].alias(m) for m in MEASURES])
    return rows.withColumn("failed_bits", failed_bits())


def _bits_sql(prefix: str = "") -> str:
    """The failure bits as an expression on counts that are named with `prefix` before them."""
    parts = []
    for name, rule in RULES:
        for m in MEASURES:
            rule = rule.replace(m, prefix + m)
        parts.append(f"(CASE WHEN {rule} THEN {BITS[name]} ELSE 0 END)")
    return f"CAST({' | '.join(parts)} AS BIGINT)"


def failed_bits() -> Column:
    """Bits of the rules that fail, from the columns in MEASURES."""
    return F.expr(_bits_sql())


def passes(bits: Column, policy: Policy) -> Column:
    return bits.bitwiseAND(F.lit(policy.mask)) == 0


def apply_policies(rows: DataFrame, policies: list[Policy] = POLICIES) -> DataFrame:
    """The ledger with one boolean column `kept_<name>_v<version>` per policy."""
    return rows.select(
        "*", *[passes(F.col("failed_bits"), p).alias(f"kept_{p.name}_v{p.version}") for p in policies]
    )


def ablations(rows: DataFrame, policies: list[Policy] = POLICIES) -> DataFrame:
    """Per policy and rule: how many documents fail it, fail nothing else, and would be kept without it.

    One pass: documents are counted by their bits first, at most one row per combination of rules.
    """
    counts = rows.groupBy("failed_bits").agg(F.count(F.lit(1)).alias("n"))
    within = F.expr("failed_bits & mask")
    tallied = counts.select(
        "n", F.explode(F.array(*[F.struct(
            F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(r).alias("rule"),
            F.lit(p.mask).cast("long").alias("mask"), F.lit(BITS[r]).cast("long").alias("bit"),
            F.col("failed_bits"),
        ) for p in policies for r in p.rules])).alias("x"),
    ).select("n", "x.*")
    return tallied.groupBy("policy", "version", "rule").agg(
        F.sum("n").alias("n_docs"),
        F.sum(F.when(within == 0, F.col("n")).otherwise(0)).alias("n_kept"),
        F.sum(F.when(F.expr("failed_bits & bit") != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(within == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only_this"),
    )


def quality_filter(docs: DataFrame, policy: Policy = STANDARD, text_column: str = "text") -> DataFrame:
    """The rows of `docs` that the policy keeps, all columns unchanged."""
    taken = docs.columns
    hold = next(n for n in (f"ledger_docs{'_' * k}" for k in range(len(taken) + 1)) if n not in taken)
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in taken]).alias(hold), docs[f"`{text_column}`"].alias("text"))
    counted = measure(packed).select(hold, *[F.col("ledger_measures")[m].alias(m) for m in MEASURES])
    judged = counted.select(hold, failed_bits().alias("failed_bits"))
    # A generator of one row or none, not a filter: Spark would push a filter below the measurements and
    # so compute them again for every count that a rule mentions.
    one = F.when(passes(F.col("failed_bits"), policy), F.array(hold))
    return judged.select(F.explode(one).alias("row")).select(*[F.col("row")[c].alias(c) for c in taken])
