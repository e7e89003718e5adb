"""Quality rules as a bitmask ledger: every rule is evaluated once, policies are masks over the stored bits.

The ledger keeps, for each document, its measurements and one bit per failed rule. A policy names the
rules that reject; applying it, or asking what each of its rules costs, needs the bits alone. All of
it is built-in expressions over one scan of the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import words_of

#: Words in a window whose repetition counts.
WINDOW = 5

#: Rule by bit, in the order of the bits. Each is true for a document that fails it.
RULES: dict[str, Column | str] = {
    "few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "100 * n_dup_lines > 40 * n_lines",
    "shouting": "2 * n_upper > n_letters",
    "word_length": "2 * word_chars < 5 * n_words or word_chars > 15 * n_words",
}
#: Rules that reject, by policy version.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": tuple(RULES),
}


def mask(rules: tuple[str, ...] | list[str]) -> int:
    """The bits of rules."""
    order = list(RULES)
    return sum(1 << order.index(r) for r in rules)


def _measured(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\f\r")) != "")
    count = lambda pattern: F.regexp_count(F.col("t"), F.lit(pattern)).cast("long")
    base = docs.select(F.col("doc_id").cast("long"), text.alias("t"), words_of(F.col("text")).alias("w"), lines.alias("lines"))
    base = base.select(
        "doc_id",
        "w",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        count(r"[#*$%&|<>]").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        count(r"\p{Lu}").alias("n_upper"),
        count(r"\p{L}").alias("n_letters"),
    )
    # Windows by hash first: most texts repeat none, and equal windows have equal hashes.
    at = F.sequence(F.lit(0), F.size("w") - WINDOW)
    hashed = F.when(F.size("w") >= WINDOW, F.transform(at, lambda i: F.xxhash64(*(F.get("w", i + k) for k in range(WINDOW)))))
    base = base.withColumn("h", hashed)
    repeats = F.coalesce(F.size(F.array_distinct("h")) < F.size("h"), F.lit(False))
    # Where some may repeat, the windows themselves, sorted, so that equal ones are neighbours.
    windows = F.when(repeats, F.array_sort(F.transform(at, lambda i: F.struct(F.array_join(F.slice("w", i + 1, WINDOW), " ").alias("k"), i.alias("p")))))
    base = base.withColumn("s", windows)
    same = lambda x, i: (x["k"] == F.get("s", i - 1)["k"]) | (x["k"] == F.get("s", i + 1)["k"])
    base = base.withColumn("p", F.array_sort(F.transform(F.filter("s", lambda x, i: F.coalesce(same(x, i), F.lit(False))), lambda x: x["p"])))
    # A word lies in a repeated window that begins at most WINDOW - 1 words before it.
    covered = F.zip_with("p", F.slice("p", 2, F.greatest(F.size("p"), F.lit(1))), lambda a, b: F.when(a.isNull(), 0).otherwise(F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))))
    return base.withColumn("n_repeat_words", F.coalesce(F.aggregate(covered, F.lit(0), lambda x, y: x + y), F.lit(0)).cast("long")).drop("w", "h", "s", "p")


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, measurements (n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_upper, n_letters) and fail_bits of every row of docs.

    docs needs doc_id and text; other columns are not read. Defined results: a null or empty text has
    measurements of 0 and fails few_words; a null doc_id and repeated rows are returned as they are; an
    empty table gives an empty ledger. A text of any length is one row: what repeats is found by sorting its
    windows, not by comparing them.
    """
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(RULES.values()):
        bits = bits + F.when(F.expr(rule) if isinstance(rule, str) else rule, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
    return _measured(docs).withColumn("fail_bits", bits)


def judged(entries: DataFrame, policy: str) -> DataFrame:
    """A ledger with kept: no rule of the policy failed."""
    return entries.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) == 0)


def ablation(entries: DataFrame, policy: str) -> DataFrame:
    """For each rule of a policy: rule, n_failed, n_alone (rejected by it alone) and n_kept_without (kept if the rule were dropped).

    Documents are counted by their bits first (at most 2 ** number of rules rows), so the ledger is read once.
    An empty ledger gives zeros.
    """
    used = POLICIES[policy]
    all_bits = mask(used)
    own = F.col("fail_bits").bitwiseAND(F.lit(all_bits).cast("long"))
    counts = entries.groupBy(own.alias("bits")).agg(F.count("*").alias("n"))
    terms = []
    for rule in used:
        bit = F.lit(mask((rule,))).cast("long")
        rest = F.lit(all_bits & ~mask((rule,))).cast("long")
        total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
        b = F.col("bits")
        terms.append(F.struct(F.lit(rule).alias("rule"), total(b.bitwiseAND(bit) != 0).alias("n_failed"), total(b == bit).alias("n_alone"), total(b.bitwiseAND(rest) == 0).alias("n_kept_without")))
    return counts.agg(F.array(*terms).alias("x")).select(F.inline("x"))
