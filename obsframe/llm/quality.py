"""Quality rules as a bitmask ledger.

``measure`` reads each whole text once and stores what was measured; ``ledger`` evaluates
every rule once on those figures and stores one failure bit per rule; a policy is a
versioned mask of rules, so verdicts of any policy (``verdict``) and ablations
(``ablation``) come from the stored bits by bitwise operations and never from the texts.

All column expressions: no shuffle before ``ablation``, whose groups are bit patterns (at
most 2 ** number of rules) with partial counts.

NULL and empty texts have no words and zero measures (they fail ``few_words``). Repeated
rows and ties are judged one by one. Other columns are carried along; columns of the input
whose names clash with those added are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe.llm.common import SPACES, deleted_count, set_aside, words

# Rules by bit, in order of bit. A policy change is a new version, not an edit.
RULES = (
    "few_words",          # bit 0: fewer than 50 words
    "repeated_windows",   # bit 1: over half the words lie in 3-word windows that repeat
    "symbols",            # bit 2: over 3 symbols #*$%&|<> per 10 words
    "repeated_lines",     # bit 3: over half the lines equal an earlier line
    "upper_case",         # bit 4: over half the ASCII letters are capitals
    "exclamations",       # bit 5: over 3 exclamation marks per 10 words
    "word_length",        # bit 6: mean word length below 2 or above 15
)
POLICIES = {
    "base-1": ("few_words", "repeated_windows"),
    "full-1": RULES,
}

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_upper", "n_lower", "n_exclamations")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the BIGINT measures of MEASURES.

    ``n_repeat_words`` compares 3-word windows of one text by a 64-bit hash; the sort that
    finds the repeated ones runs only for texts that have any.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    kept = [c for c in docs.columns if c not in MEASURES and c not in ("_words", "_lines", "_windows")]
    split = docs.select(
        *kept,
        words(F.col(text)).alias("_words"),
        F.filter(F.split(body, "\n"), lambda x: F.translate(x, SPACES, "") != "").alias("_lines"),
    )
    windows = F.when(
        F.size("_words") >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size("_words") - 3),
            lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    hashed = split.withColumn("_windows", windows)
    ordered = hashed.withColumn("_windows", F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    ))
    # generated columns: a filter on a verdict must not be rewritten into one on these expressions
    measures = F.struct(
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.translate(body, SPACES, "")).cast("bigint").alias("word_chars"),
        deleted_count(body, SYMBOLS).alias("n_symbols"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.col("_windows").isNotNull(), F.size(_repeated_words(F.col("_windows"))))
        .otherwise(0).cast("bigint").alias("n_repeat_words"),
        deleted_count(body, CAPITALS).alias("n_upper"),
        deleted_count(body, CAPITALS.lower()).alias("n_lower"),
        deleted_count(body, "!").alias("n_exclamations"),
    )
    return ordered.select(*kept, F.inline(F.array(measures)))


def _repeated_words(ordered: Column) -> Column:
    """Positions of the words in windows that occur twice or more.

    ``ordered`` holds (hash, position) of a text's windows, sorted: equal ones are neighbours.
    """
    pairs = F.zip_with(
        ordered, F.slice(ordered, F.lit(2), F.size(ordered)),
        lambda x, after: F.when(
            x["h"] == after["h"],
            F.array(*[x["i"] + k for k in range(3)], *[after["i"] + k for k in range(3)]),
        ),
    )
    return F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull())))


def rule_bits() -> Column:
    """One failure bit per rule of RULES, over the columns of MEASURES."""
    c = F.col
    failed = (
        c("n_words") < 50,
        100 * c("n_repeat_words") > 50 * c("n_words"),
        10 * c("n_symbols") > 3 * c("n_words"),
        2 * c("n_dup_lines") > c("n_lines"),
        c("n_upper") > c("n_lower"),
        10 * c("n_exclamations") > 3 * c("n_words"),
        (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 15 * c("n_words")),
    )
    bits = F.lit(0).cast("bigint")
    for bit, fails in enumerate(failed):
        bits = bits.bitwiseOR(F.when(fails, F.lit(1 << bit).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return bits


def mask(policy: str) -> int:
    return sum(1 << RULES.index(name) for name in POLICIES[policy])


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """Measures and ``rule_bits`` of every document."""
    return measure(docs, text).withColumn("rule_bits", rule_bits())


def verdict(policy: str) -> Column:
    """True where no rule of the policy failed."""
    return F.col("rule_bits").bitwiseAND(F.lit(mask(policy)).cast("bigint")) == 0


def ablation(ledger_rows: DataFrame, policy: str = "full-1") -> DataFrame:
    """Per rule of a policy: documents it fails, and those that it alone keeps out.

    Counts bit patterns first, so what is shuffled does not grow with the documents.
    """
    patterns = ledger_rows.groupBy("rule_bits").agg(F.count("*").alias("n"))
    chosen = F.lit(mask(policy)).cast("bigint")
    per_rule = patterns.select(
        "n", F.col("rule_bits").bitwiseAND(chosen).alias("bits"),
        F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(1 << RULES.index(name)).cast("bigint").alias("bit"))
                            for name in POLICIES[policy]])).alias("r"),
    )
    return per_rule.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
    )


def kept_documents(docs: DataFrame, policy: str = "full-1") -> DataFrame:
    """The documents that a policy keeps, with the columns they came with, whatever their names."""
    named, given_back = set_aside(docs, "text")
    return given_back(ledger(named).where(verdict(policy)))
