"""Quality rules as a ledger of bitmasks, in DataFrame operations alone.

``rule_ledger`` reads every text once, measures it and evaluates every rule on the
measurements; the ledger holds the measurements and one bit per failed rule. Texts are not
needed afterwards: ``judged`` applies a versioned policy (a mask of rules and how many may
fail) to the bits, and ``ablations`` tells from the bits what every rule of a policy alone
decides, after one small aggregation by mask.

Repeated words are those in windows of three words that a text holds twice or more. A text's
windows are compared by 64-bit hashes within the row, so no text is shuffled; texts whose
hashes are all different are done after one pass, the others sort (hash, place) and walk the
places, n log n for a text of n words. Two different windows of one text share a hash with
a probability below n * n / 2**65.

Defined cases: null and empty texts have no words and fail ``few_words``; rules that are
shares of words or lines don't fail where there are none; ties and repeated rows are each
judged for themselves; an empty table gives an empty ledger; a null id stays null; further
columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import stored

# fixed values: white space between words, symbols, and end marks of shouted or broken-off lines
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
SHOUT = "!?"
WINDOW = 3
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouts")


def _count_of(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and MEASURES of every row."""
    text = F.col("text")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    spaced = F.translate(text, BLANKS, " " * len(BLANKS))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.length(F.translate(line, BLANKS, "")) > 0)
    split = rows.select(
        "doc_id", F.array_remove(F.split(spaced, " ", -1), "").alias("w"), lines.alias("lines"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        _count_of(text, SYMBOLS).alias("n_symbols"), _count_of(text, SHOUT).alias("n_shouts"))
    hashed = split.select(
        "doc_id", "word_chars", "n_symbols", "n_shouts", F.size("w").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("w") >= WINDOW,
               F.transform(F.slice("w", F.lit(1), F.greatest(F.size("w") - (WINDOW - 1), F.lit(0))),
                           lambda x, i: F.xxhash64(x, *[F.get("w", i + k) for k in range(1, WINDOW)])))
        .otherwise(F.array().cast("array<bigint>")).alias("h"))
    placed = hashed.withColumn("s", F.when(
        F.size(F.array_distinct("h")) < F.size("h"),
        F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))).drop("h")
    twice = F.filter("s", lambda r, i: (F.get("s", i - 1)["h"] == r["h"]) | (F.get("s", i + 1)["h"] == r["h"]))
    walked = F.aggregate(
        F.sort_array(F.transform(twice, lambda r: r["i"])),
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")))
    repeated = F.when(F.col("s").isNull(), 0).otherwise(walked["n"]).cast("long")
    return placed.withColumn("n_repeat_words", repeated).select("doc_id", *MEASURES)


@dataclass(frozen=True)
class Rule:
    """A named test of measurements; its bit is set where it holds."""

    name: str
    fails: str


#: Rules in the order of their bits; new rules go to the end, so stored ledgers stay readable.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("dup_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 16 * n_words"),
    Rule("shouts", "10 * n_shouts > 3 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """Which rules count, and how many of them a kept document may fail."""

    name: str
    version: int
    rules: tuple[str, ...]
    allowed: int = 0

    def mask(self, rules: tuple[Rule, ...] = RULES) -> int:
        bits = {r.name: 1 << i for i, r in enumerate(rules)}
        return sum(bits[name] for name in dict.fromkeys(self.rules))


#: The contract's own two rules; and the method's policies, by version.
BASE = Policy("base", 1, ("few_words", "repeated_words"))
POLICIES = (
    Policy("prose", 1, ("few_words", "repeated_words", "symbols", "dup_lines")),
    Policy("prose", 2, tuple(r.name for r in RULES)),
)


def rule_ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, MEASURES and ``failed``, a bit per rule in the rules' order."""
    if len(rules) > 63:
        raise ValueError("a ledger holds 63 rules")
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measured(docs, id_col, text_col).withColumn("failed", bits)


def _misses(policy: Policy, rules: tuple[Rule, ...]) -> Column:
    return F.bit_count(F.col("failed").bitwiseAND(F.lit(policy.mask(rules)).cast("long"))) > policy.allowed


def judged(ledger: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES, out: str = "kept") -> DataFrame:
    """The ledger with ``out``: whether the policy keeps the row."""
    return ledger.withColumn(out, ~_misses(policy, rules))


def ablations(ledger: DataFrame, policies: tuple[Policy, ...] = POLICIES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """A row per policy and rule of it: policy, version, rule, n_failed (rows that fail the rule), n_dropped (rows the
    policy drops), n_only (rows it keeps once the rule is taken out).

    Rows are counted by mask first, map-side, so what is left has a row for each combination of failures.
    """
    masks = ledger.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    tests = [F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(r).alias("rule"),
                      F.lit(1 << [x.name for x in rules].index(r)).cast("long").alias("bit"),
                      F.lit(p.mask(rules)).cast("long").alias("mask"), F.lit(p.allowed).alias("allowed"))
             for p in policies for r in dict.fromkeys(p.rules)]
    rows = masks.select("failed", "n", F.explode(F.array(*tests)).alias("t")).select("failed", "n", "t.*")
    hit = F.col("failed").bitwiseAND(F.col("mask"))
    dropped = F.bit_count(hit) > F.col("allowed")
    without = F.bit_count(hit.bitwiseAND(F.bitwise_not("bit"))) > F.col("allowed")
    total = lambda test: F.sum(F.when(test, F.col("n")).otherwise(F.lit(0))).alias
    return rows.groupBy("policy", "version", "rule").agg(
        total(F.col("failed").bitwiseAND(F.col("bit")) != 0)("n_failed"), total(dropped)("n_dropped"),
        total(dropped & ~without)("n_only"))


def quality_rules(docs: DataFrame, policy: Policy = POLICIES[-1], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's measurements, ``failed`` bits, base_failed, the policy's version and whether it is kept."""
    ledger = stored(rule_ledger(docs, id_col=id_col, text_col=text_col), "ledger")
    both = judged(judged(ledger, BASE, out="passes_base"), policy)
    return both.select(
        "doc_id", *MEASURES[:5], (~F.col("passes_base")).alias("base_failed"),
        (F.col("kept") & F.col("passes_base")).alias("kept"), *MEASURES[5:], "failed",
        F.lit(policy.version).alias("policy_version"))
