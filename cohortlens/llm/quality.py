"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger row keeps the
measurements and one failure bit per rule; a policy is a named, versioned set
of rules, so a verdict is ``bits & mask == 0`` and ablations are bitwise
aggregations over the (few) distinct bit patterns: no text is read again.

Defined results: a null or empty text has no words and fails ``few_words``
only; ``n_repeat_words`` compares three-word windows by a chained 64-bit hash
within one document; repeated rows are judged alike, each on its own; an empty
table gives an empty ledger; columns other than id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind, text_or_empty, words_of

SYMBOLS = r"[#*$%&|<>]"
HAS_WORD = r"[^\x20\x09-\x0D]"
WINDOW = 3

# rule name -> failure test over the measurements; the bit is the position.
# All tests are on integers, so verdicts do not depend on rounding.
RULES = {
    "few_words": lambda m: m["n_words"] < 50,
    "repeated_windows": lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"],
    "symbols": lambda m: 10 * m["n_symbols"] > m["n_words"],
    "duplicate_lines": lambda m: 2 * m["n_dup_lines"] > m["n_lines"],
    "capitals": lambda m: 10 * m["n_capitals"] > 4 * m["word_chars"],
    "exclamations": lambda m: 10 * m["n_exclamations"] > 3 * m["n_words"],
    "stutter": lambda m: 10 * m["n_stutters"] > 3 * m["n_words"],
}
BASE = ("few_words", "repeated_windows")
POLICIES = {
    "base-1": BASE,
    "symbols-2": BASE + ("symbols", "duplicate_lines"),
    "full-3": tuple(RULES),
}
CURRENT = "full-3"


def mask_of(rules) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


def _repeat_words(words: Column) -> Column:
    """Words covered by windows that occur at least twice in the text."""
    def covered(hashes: Column) -> Column:
        def gaps(p: Column) -> Column:
            return F.aggregate(
                F.transform(p, lambda x, i: F.when(i == 0, F.lit(WINDOW)).otherwise(
                    F.least(F.lit(WINDOW), x - F.get(p, i - 1)))),
                F.lit(0), lambda a, x: a + x)

        def positions(pairs: Column) -> Column:
            same = lambda a, b: F.get(pairs, a)["h"] == b
            kept = F.filter(pairs, lambda x, i: (
                (i > 0) & F.coalesce(same(i - 1, x["h"]), F.lit(False)))
                | F.coalesce(same(i + 1, x["h"]), F.lit(False)))
            return F.sort_array(F.transform(kept, lambda x: x["i"]))

        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        some = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(some, bind(bind(pairs, positions), gaps)).otherwise(F.lit(0))

    n = F.size(words) - (WINDOW - 1)
    hashes = F.when(n > 1, F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])))
    return F.coalesce(bind(hashes, covered), F.lit(0)).cast("long")


def measures(text: Column) -> Column:
    """One struct of integer measurements of a whole text."""
    def of_text(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(HAS_WORD))
        return F.struct(
            bind(words_of(t), lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
                _repeat_words(w).alias("n_repeat_words"),
                F.size(F.filter(w, lambda x, i: (i > 0) & (x == F.get(w, i - 1))))
                .cast("long").alias("n_stutters"))).alias("w"),
            bind(lines, lambda x: F.struct(
                F.size(x).cast("long").alias("n_lines"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("l"),
            F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            F.regexp_count(t, F.lit("[A-Z]")).cast("long").alias("n_capitals"),
            F.regexp_count(t, F.lit("!")).cast("long").alias("n_exclamations"))

    flat = lambda m: F.struct(
        *[m["w"][c].alias(c) for c in ("n_words", "word_chars", "n_repeat_words", "n_stutters")],
        *[m["l"][c].alias(c) for c in ("n_lines", "n_dup_lines")],
        *[m[c].alias(c) for c in ("n_symbols", "n_capitals", "n_exclamations")])
    return bind(bind(text_or_empty(text), of_text), flat)


def failure_bits(m: Column) -> Column:
    """One bit per rule, set where the rule fails."""
    bits = F.lit(0).cast("long")
    for k, test in enumerate(RULES.values()):
        bits = bits + F.when(test(m), F.lit(1 << k)).otherwise(F.lit(0)).cast("long")
    return bits


def passes(bits: Column, policy: str = CURRENT) -> Column:
    return bits.bitwiseAND(F.lit(mask_of(POLICIES[policy])).cast("long")) == 0


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_stutters", "n_capitals", "n_exclamations")


def quality_ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, the measurements and ``failure_bits``."""
    row = bind(measures(F.col(text_col)), lambda m: F.struct(
        *[m[c].alias(c) for c in MEASURES], failure_bits(m).alias("failure_bits")))
    return (docs.select(F.col(id_col), row.alias("__m"))
            .select(F.col(id_col), *[F.col("__m")[c].alias(c) for c in (*MEASURES, "failure_bits")]))


def verdicts(ledger: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with ``kept`` under a policy; only stored bits are read."""
    return ledger.withColumn("kept", passes(F.col("failure_bits"), policy))


def ablations(ledger: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents that fail it, and how many more would
    be kept without it. The ledger is first counted per bit pattern (at most
    2 ** rules rows), so each rule costs one bitwise test per pattern."""
    mask = mask_of(POLICIES[policy])
    patterns = ledger.groupBy("failure_bits").agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(mask_of([r])).cast("long").alias("bit"))
                      for r in POLICIES[policy]])
    bits = F.col("failure_bits").bitwiseAND(F.lit(mask).cast("long"))
    return (patterns.withColumn("r", F.explode(rules))
            .groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(bits.bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
                 F.sum(F.when(bits == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_kept_without")))


def keep_good(docs: DataFrame, text_col: str = "text", policy: str = CURRENT) -> DataFrame:
    """The documents that pass a policy, with their own columns only. The
    verdict is one expression, so each text is measured once."""
    return docs.where(bind(measures(F.col(text_col)), lambda m: passes(failure_bits(m), policy)))
