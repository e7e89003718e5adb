"""License notices in documents: an exact set-similarity join of templates and text blocks.

A block of a template is any stretch of so many tokens of a text that the template's share of it may be
missing or foreign, across line breaks; it counts as the set of its tokens. Tokens are ordered by how
many documents have them, rarest first. To contain a share of a template's tokens a block must hold one
of the first few of them in that order: these prefixes are an inverted list (token, template), and the
words of all texts are joined to it (prefix filter; a token so far back in the order that too few are behind
it is in no prefix, which is the positional filter). Around such places there must be enough of the template's
tokens at all (length filter); then the greatest overlap of a block is found exactly, by a running sum over the
places of the template's tokens. The work on a text grows with the rare tokens in it, not with the
number of templates or the square of its notices. All of it is DataFrame expressions.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import ascii_lower
from tapeloom.llm.license_texts import TEMPLATES

#: What separates tokens of a lower-cased text: ASCII that is neither digit nor letter.
_GAP_LOWER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases whose words stand consecutively, with their labels.
PHRASES: tuple[tuple[str, str], ...] = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Templates of fewer different tokens must be there whole: else the words that tell them apart could be the missing ones.
WHOLE_BELOW = 10
#: Template tokens up to which the inverted list is sent to all tasks; a longer list is joined by a shuffle of the prefix tokens found.
BROADCAST_TOKENS = 200_000


@dataclass(frozen=True)
class Template:
    """A template's different tokens, rarest first; least is how many of them a block must hold, block its length in tokens."""

    label: str
    tokens: tuple[str, ...]
    least: int
    block: int

    @property
    def prefix(self) -> tuple[str, ...]:
        return self.tokens[: len(self.tokens) - self.least + 1]


def parsed(text: str, threshold: float) -> tuple[list[str], int, int]:
    """Different tokens of a template in the order of their text, how many a block must hold, and the length of its blocks."""
    words = [w for w in re.split(_GAP_LOWER, text.lower()) if w]
    own = sorted(set(words))
    share = 1.0 if len(own) < WHOLE_BELOW else threshold
    return own, math.ceil(share * len(own) - 1e-9), math.ceil(len(words) / share - 1e-9)


def words_of_text(text: Column) -> Column:
    """The lower-cased tokens of a text; null: none."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _GAP_LOWER), lambda x: x != "")


def frequencies(docs: DataFrame, words: list[str]) -> dict[str, int]:
    """How many documents have each of words; the words of the templates, so a bounded result."""
    own = F.array_distinct(F.filter(words_of_text(F.col("text")), lambda x: x.isin(words)))
    return dict(docs.select(F.explode(own).alias("token")).groupBy("token").count().collect())


def ordered(docs: DataFrame, templates=TEMPLATES, threshold: float = 0.8) -> list[Template]:
    """Templates with their tokens by document frequency, rarest first, ties by the token."""
    plain = [(label, *parsed(t, threshold)) for label, t in templates]
    n = frequencies(docs, sorted({w for _, own, _, _ in plain for w in own}))
    return [Template(label, tuple(sorted(own, key=lambda w: (n.get(w, 0), w))), least, block) for label, own, least, block in plain]


def _address(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def regions(docs: DataFrame, rare: list[str], around: int) -> DataFrame:
    """blob, lo, part and found: the stretches of each text that lie less than `around` tokens from a rare token, where they begin, and the rare tokens in them; stretches that would touch are one."""
    at = F.filter(F.transform("w", lambda x, i: F.when(x.isin(rare), i)), lambda x: x.isNotNull())
    some = docs.select("text", words_of_text(F.col("text")).alias("w")).withColumn("at", at).filter(F.size("at") > 0)
    first = F.transform("at", lambda x, i: F.when((i == 0) | (x - F.get("at", F.greatest(i - 1, F.lit(0))) >= 2 * around), x))
    last = F.transform("at", lambda x, i: F.when((i == F.size("at") - 1) | (F.get("at", i + 1) - x >= 2 * around), x))
    some = some.withColumns({"first": F.array_compact(first), "last": F.array_compact(last)})
    cut = F.zip_with("first", "last", lambda a, z: F.struct(F.greatest(a - around + 1, F.lit(0)).alias("lo"), (z + around).alias("hi")))
    parts = F.transform(cut, lambda r: F.struct(r["lo"].alias("lo"), F.slice("w", r["lo"] + 1, r["hi"] - r["lo"]).alias("part")))
    each = some.select(_address(F.col("text")).alias("blob"), F.explode(parts).alias("r")).select("blob", "r.lo", "r.part")
    return each.withColumn("found", F.array_distinct(F.filter("part", lambda x: x.isin(rare))))


def matches(docs: DataFrame, templates: list[Template]) -> DataFrame:
    """blob, label and containment: the greatest of each template in a block of each text of docs, named by its SHA-256, where it meets the threshold.

    A text is cut to the regions around its prefix tokens. A region carries its tokens once, through one shuffle in which copies
    of a text meet, to the templates that its prefix tokens name. There the best block is found in one pass over the places of
    the template's tokens: a place at p, whose token stood last at q, is the first of its token in the blocks that begin behind q and
    behind p - block, up to p; so it adds one from there to p, and the greatest running sum is the greatest overlap. The
    work on a region is in proportion to its length and templates, however many notices it holds.
    """
    spark = docs.sparkSession
    bounded = (lambda df: F.broadcast(df)) if sum(len(t.tokens) for t in templates) <= BROADCAST_TOKENS else (lambda df: df)
    index = bounded(spark.createDataFrame([(token, i) for i, t in enumerate(templates) for token in t.prefix], "token string, id int"))
    known = bounded(spark.createDataFrame([(i, list(t.tokens), t.least, t.block, t.label) for i, t in enumerate(templates)], "id int, tokens array<string>, least int, block int, label string"))
    rare = sorted({token for t in templates for token in t.prefix})
    each = regions(docs, rare, max((t.block for t in templates), default=1))
    named = each.select("blob", "lo", "part", F.posexplode("found").alias("nth", "token")).withColumn("part", F.when(F.col("nth") == 0, F.col("part"))).join(index, "token")
    met = named.groupBy("blob", "lo").agg(F.first("part", ignorenulls=True).alias("part"), F.collect_set("id").alias("ids"))  # at most as many as templates
    met = met.select("blob", "part", F.explode("ids").alias("id")).join(known, "id")
    place = F.transform("part", lambda x, i: F.struct(F.array_position("tokens", x).alias("k"), i.alias("at")))
    met = met.filter(F.size(F.array_intersect("part", "tokens")) >= F.col("least"))
    placed = met.withColumn("places", F.sort_array(F.filter(place, lambda x: x["k"] > 0))).drop("part")

    def steps(x, i):
        before = F.get("places", F.greatest(i - 1, F.lit(0)))
        behind = F.greatest(x["at"] - F.col("block"), F.when((i > 0) & (before["k"] == x["k"]), before["at"]))
        return F.array(F.struct((behind + 1).alias("at"), F.lit(1).alias("d")), F.struct((x["at"] + 1).alias("at"), F.lit(-1).alias("d")))

    line = placed.withColumn("steps", F.sort_array(F.flatten(F.transform("places", steps))))
    none = F.struct(F.lit(0).alias("n"), F.lit(0).alias("top"))
    most = F.aggregate("steps", none, lambda a, x: F.struct((a["n"] + x["d"]).alias("n"), F.greatest(a["top"], a["n"] + x["d"]).alias("top")), lambda a: a["top"])
    best = line.select("blob", "label", "least", F.size("tokens").alias("n"), most.alias("o"))
    # The filter stands above the aggregation: below it, Spark would push it into the join with `places` written out inside the lambdas, where it would be made again for every place.
    return best.groupBy("blob", "label").agg(F.max(F.when(F.col("o") >= F.col("least"), F.col("o") / F.col("n"))).alias("containment")).filter("containment is not null")


def licenses(docs: DataFrame, templates=TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row of docs.

    docs needs doc_id and text; other columns are not read. n_base counts the places of PHRASES, first_word and
    last_word are their least and greatest start in words (null: none), base_labels names them; labels
    adds those of the templates that some block contains to the threshold (all of it, for templates of fewer than
    WHOLE_BELOW tokens); score is 1 where a phrase stands, else the greatest such containment, else 0.

    Findings belong to texts, by their SHA-256, and are joined back to all rows that have the text.

    Defined results: a null or empty text has no words and no labels; a null doc_id and repeated rows are
    returned as they are; an empty table gives none. Texts of any length are searched whole; of a place that
    several templates meet each adds its label.
    """
    known = ordered(docs, templates, threshold)
    rows = docs.select(F.col("doc_id").cast("long"), _address(F.col("text")).alias("blob"), words_of_text(F.col("text")).alias("w"))
    found = matches(docs, known).groupBy("blob").agg(F.collect_set("label").alias("added"), F.max("containment").alias("best"))  # at most as many labels as templates

    # Places of the phrases, looked for only where the last word of one occurs.
    lasts = sorted({p.split()[-1] for p, _ in PHRASES})
    kinds = [_phrase_places(phrase.split(), i) for i, (phrase, _) in enumerate(PHRASES)]
    empty = F.array().cast("array<struct<at:int,kind:int>>")
    rows = rows.withColumn("places", F.when(F.arrays_overlap("w", F.array(*map(F.lit, lasts))), F.concat(*kinds)).otherwise(empty))
    base = F.array_sort(F.array_distinct(F.transform("places", lambda x: F.get(F.array(*(F.lit(x) for _, x in PHRASES)), x["kind"]))))
    starts = F.transform("places", lambda x: x["at"])
    rows = rows.select("doc_id", "blob", F.size("w").cast("long").alias("n_words"), F.size("places").cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"), base.alias("base"))
    out = rows.join(found, "blob", "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("added", F.array().cast("array<string>"))))
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def _phrase_places(parts: list[str], kind: int) -> Column:
    """Structs (at, kind) where the words of parts stand consecutively."""
    back = len(parts) - 1

    def starts(x, j):
        fits = x == parts[-1]
        for k, part in enumerate(parts[:-1]):
            fits = fits & F.coalesce(F.get("w", F.greatest(j - (back - k), F.lit(0))) == part, F.lit(False))
        return F.when(fits & (j >= back), j - back)

    at = F.filter(F.transform("w", starts), lambda x: x.isNotNull())
    return F.transform(at, lambda j: F.struct(j.alias("at"), F.lit(kind).alias("kind")))
