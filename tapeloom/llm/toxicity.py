"""Toxicity of documents after noisy-channel deobfuscation.

A character trigram model of the whole corpus is the source; the channel swaps letters for digits and
signs, repeats letters and spaces words out. Each suspicious stretch of a text becomes a lattice of
what each of its characters may stand for, and Viterbi decoding under both models restores it. Only
stretches whose lattice has more than one path are decoded; elsewhere the one path is the text itself.

The restored words are then scored with weights learnt from labelled documents: words and word
beginnings that occur in toxic documents, in enough different contexts, far more than elsewhere.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import chunks, discard, utf8, written

#: Character classes of the model: 0 white space, 1-26 letters, 27 digits, 28 other ASCII, 29 unused, 30-61 by the last byte of other characters.
CLASSES = 62
_CLASS = np.full(256, 28, dtype=np.int32)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[97:123] = _CLASS[65:91] = np.arange(1, 27)
_CLASS[48:58] = 27
_CLASS[128:192] = 30 + (np.arange(128, 192) & 31)

#: What a sign may stand for, besides itself.
STANDS_FOR = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "€": "e", "*": "aeiou"}
#: Letters of other scripts that look like Latin ones; where a token mixes them with ASCII letters they stand for those.
LOOK_ALIKES = {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "α": "a", "ο": "o", "ι": "i", "ν": "v", "ρ": "p", "ɡ": "g", "ı": "i", "ｏ": "o", "ｉ": "i"}
#: What may stand between the letters of a word.
GAPS = " .-_*"
#: Costs of the channel, as negative logarithms.
SWAP, DROP_GAP, SQUEEZE, KEEP_RUN = 1.5, 0.5, 0.7, 3.0

_TO_LATIN = str.maketrans(LOOK_ALIKES)

_EDGE = ".,;:?\"'()[]{}#%&*~`<>/\\=_-"
_LEET = re.compile("[" + re.escape("".join(STANDS_FOR)) + "]")
_LEET_SIGN = re.compile(r"[@$!|+€*]")
_LOOKS = re.compile("[" + "".join(LOOK_ALIKES) + "]")
_ASCII = re.compile("[a-z]")
_LETTER = re.compile(r"[^\W\d_]")
_RUN = re.compile(r"([^\W\d_])\1\1")
#: What else gives the lattice of a token more than one path: a doubled letter, a sign that may be a gap.
_DOUBT = re.compile(r"([^\W\d_])\1|[.\-_*]")
_WORD = re.compile(r"[^\W\d_]+")
_SPACED = re.compile(r"(?<![^\s.,;:\-_*])[^\W_](?:[ .\-_*]{1,2}[^\W_]){2,}(?![^\s.,;:!?\-_*])")
#: The same with signs of STANDS_FOR among the letters; an asterisk is one where it stands alone, else a gap.
_SIGN = r"(?:[^\W_]|[@$!|+€]|(?<!\S)\*(?!\S))"
_SIGNED = re.compile(rf"(?<![^\s.,;:\-_*]){_SIGN}(?:[ .\-_*]{{1,2}}{_SIGN}){{2,}}(?![^\s.,;:!?\-_*])")

#: What both begin with, in a text with a space at either end: three single characters with gaps between them. Most texts have none, so this is asked first.
_SINGLES = re.compile(r"[\s.,;:\-_*][^\s.,;:\-_](?:[ .\-_*]{1,2}[^\s.,;:\-_]){2}[\s.,;:!?\-_*]")
#: Tokens that a task holds, or a lexicon may have, at once; beyond it tokens are decoded again, which changes no result.
MOST_TOKENS = 400_000


def class_of(c: str) -> int:
    return int(_CLASS[c.encode()[-1]])


def trigram_counts(docs: DataFrame) -> DataFrame:
    """gram and n over the whole texts of docs; at most CLASSES ** 3 rows. Null and empty texts count nothing."""

    def run(batches):
        total = np.zeros(CLASSES**3, dtype=np.int64)
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for a, b in chunks(offsets):
                part, cuts = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                keep = part < 192
                kinds = _CLASS[part[keep]]
                if len(kinds) < 3:
                    continue
                grams = (kinds[:-2] * CLASSES + kinds[1:-1]) * CLASSES + kinds[2:]
                ends = np.r_[0, np.cumsum(keep)][cuts[1:]]
                cross = np.concatenate([ends - 1, ends - 2])
                inside = np.ones(len(grams), dtype=bool)
                inside[cross[(cross >= 0) & (cross < len(grams))]] = False
                total += np.bincount(grams[inside], minlength=CLASSES**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["gram", "n"])

    return docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def language_model(docs: DataFrame, strength: float = 20.0) -> np.ndarray:
    """Negative log probabilities of a character class after two others, interpolated with shorter contexts."""
    counts = np.zeros(CLASSES**3)
    for gram, n in trigram_counts(docs).collect():  # bounded by the number of classes
        counts[gram] = n
    counts = counts.reshape(CLASSES, CLASSES, CLASSES)
    one = counts.sum((0, 1)) + 1
    one /= one.sum()
    two = counts.sum(0)
    two = (two + strength * one) / (two.sum(1, keepdims=True) + strength)
    three = (counts + strength * two) / (counts.sum(2, keepdims=True) + strength)
    return -np.log(three).astype(np.float32)


def lattice(seen: str) -> list[list[tuple[str, float]]]:
    """What each character, or run of one letter, may stand for, with its cost."""
    out, i = [], 0
    while i < len(seen):
        c, j = seen[i], i + 1
        while j < len(seen) and seen[j] == c and _LETTER.match(c):
            j += 1
        n = j - i
        if n >= 3:
            out.append([(c, SQUEEZE), (c * 2, SQUEEZE), (c * n, KEEP_RUN)])
        elif n == 2:
            out.append([(c * 2, 0.0), (c, KEEP_RUN)])
        else:
            out.append([(c, 0.0), *((x, SWAP) for x in STANDS_FOR.get(c, "")), *([("", DROP_GAP)] if c in GAPS else [])])
        i = j
    return out


def restore(seen: str, model: np.ndarray) -> str:
    """The cheapest reading of seen (lower case); of equal ones the first in the order of the lattice."""
    states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    for options in [*lattice(seen), [(" ", 0.0)]]:
        after: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (cost, text) in states.items():
            for letters, price in options:
                x, y, total = a, b, cost + price
                for c in letters:
                    z = class_of(c)
                    total += float(model[x, y, z])
                    x, y = y, z
                if (x, y) not in after or total < after[x, y][0]:
                    after[x, y] = (total, text + letters)
        states = after
    return min(states.values())[1].strip()


def readings(token: str, model: np.ndarray) -> list[str]:
    """The words of a token between white space, restored where it is suspicious.

    A doubled letter or a gap is common in clean words as well, so there the words as they stand count too.
    """
    core = token.lower().strip(_EDGE).rstrip(_EDGE + "!")  # at the end an exclamation mark is one
    if not core.isascii() and _LOOKS.search(core) and _ASCII.search(core):
        core = core.translate(_TO_LATIN)
    if _LETTER.search(core) and (_LEET.search(core) or _RUN.search(core)):
        core = restore(core, model)
    elif _DOUBT.search(core) and _LETTER.search(core):
        plain = _WORD.findall(core)
        return [*plain, *(w for w in _WORD.findall(restore(core, model)) if w not in plain)]
    return _WORD.findall(core)


def spaced(text: str, model: np.ndarray) -> list[str]:
    """Words that single letters with gaps between them spell."""
    if not _SINGLES.search(f" {text} "):
        return []
    found = [m.group() for m in _SPACED.finditer(text)]
    # A sign at either end may be one, so what stands without signs counts too.
    signed = (m.group().rstrip(" !") for m in _SIGNED.finditer(text))
    found += [x for x in signed if _LEET_SIGN.search(x) and _LETTER.search(x)]
    return list(dict.fromkeys(w for x in found for w in _WORD.findall(restore(x.lower(), model)) if len(w) > 2))


def features(word: str) -> list[str]:
    """The word, and its beginnings of three to eight letters."""
    return [f"={word}", *(f"^{word[:n]}" for n in range(3, 9) if len(word) >= n)]


class Readings:
    """readings() of the tokens that a task meets, each decoded once; MOST_TOKENS bounds the memory."""

    def __init__(self, model: np.ndarray):
        self.model, self.known = model, {}

    def __call__(self, token: str) -> list[str]:
        got = self.known.get(token)
        if got is None:
            if len(self.known) >= MOST_TOKENS:
                self.known.clear()
            got = self.known[token] = readings(token, self.model)
        return got


@dataclass
class Scorer:
    """A learnt model; score() is a pure function of the text.

    lexicon, where it is given, holds the evidence of all tokens that have any (see with_lexicon); without it each
    task decodes the tokens that it meets.
    """

    model: np.ndarray
    weights: dict[str, float]
    coefficients: tuple[float, ...]
    lexicon: dict[str, tuple[tuple[str, float], ...]] | None = None
    known: dict[str, tuple[tuple[str, float], ...]] = field(default_factory=dict)

    def weighed(self, words: list[str]) -> tuple[tuple[str, float], ...]:
        """The words that speak for toxicity, with their log odds."""
        found = ((w, max((self.weights.get(f, 0.0) for f in features(w)), default=0.0)) for w in words)
        return tuple((w, p) for w, p in found if p > 0)

    def of_token(self, token: str) -> tuple[tuple[str, float], ...]:
        got = self.known.get(token)
        if got is None:
            if len(self.known) >= MOST_TOKENS:
                self.known.clear()
            got = self.known[token] = self.weighed(readings(token, self.model))
        return got

    def evidence(self, text: str | None) -> tuple[float, ...]:
        """1, the summed and the greatest log odds of the toxic words, their number, and the logarithm of the number of different words."""
        hits: dict[str, float] = {}
        tokens = set((text or "").split())
        if self.lexicon is None:
            for token in tokens:
                hits.update(self.of_token(token))
        else:
            for token in self.lexicon.keys() & tokens:
                hits.update(self.lexicon[token])
        hits.update(self.weighed(spaced(text or "", self.model)))
        return 1.0, math.fsum(hits.values()), max(hits.values(), default=0.0), float(len(hits)), math.log1p(len(tokens)) if hits else 0.0

    def score(self, text: str | None) -> float:
        z = math.fsum(c * x for c, x in zip(self.coefficients, self.evidence(text), strict=True))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def with_lexicon(docs: DataFrame, scorer: Scorer, most_bytes: int = 16 << 20) -> Scorer:
    """scorer with the evidence of every token of docs: each different token of the table is decoded once, not once in each task.

    The tokens that speak for toxicity are few, but nothing bounds them. Where they, and the bytes they take, are
    within MOST_TOKENS and most_bytes they travel with the tasks; beyond that scorer is returned as it is and decodes the
    tokens where they lie, with equal scores.
    """

    def distinct(batches):
        met: set[str] = set()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                met.update((t or "").split())
                if len(met) >= MOST_TOKENS:
                    yield pa.RecordBatch.from_arrays([pa.array(list(met), pa.string())], ["token"])
                    met.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(met), pa.string())], ["token"])

    def decoded(batches):
        for batch in batches:
            found = [(t, h) for t in batch.column(0).to_pylist() if (h := scorer.weighed(readings(t, scorer.model)))]
            columns = [[t for t, _ in found], [[w for w, _ in h] for _, h in found], [[p for _, p in h] for _, h in found]]
            kinds = pa.string(), pa.list_(pa.string()), pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["token", "words", "odds"])

    if not scorer.weights:
        return replace(scorer, lexicon={}, known={})
    tokens = docs.select("text").mapInArrow(distinct, "token string").distinct()
    table = written(tokens.mapInArrow(decoded, "token string, words array<string>, odds array<double>"), "lexicon")
    n, size = table.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("token")), F.lit(0))).first()
    found = None
    if n <= MOST_TOKENS and size <= most_bytes:
        found = {r.token: tuple(zip(r.words, r.odds, strict=True)) for r in table.collect()}
    discard(table)
    return replace(scorer, lexicon=found, known={})


def calibrated(evidence: np.ndarray, toxic: np.ndarray, prior: np.ndarray, strength: float = 0.5) -> tuple[float, ...]:
    """Logistic regression by Newton steps, drawn towards prior."""
    beta = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(evidence @ beta, -30, 30)))
        slope = evidence.T @ (toxic - p) - strength * (beta - prior)
        curve = (evidence * (p * (1 - p))[:, None]).T @ evidence + strength * np.eye(len(beta))
        step = np.linalg.solve(curve, slope)
        beta = beta + step * min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(x) for x in beta)


def labelled(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """text, toxic and fold (0 to 4) of at most `most` labelled documents whose crc32(doc_id as text) mod 4 is not 2, chosen by a hash of doc_id."""
    rows = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("label")).dropna()
    rows = rows.filter(F.crc32(F.col("id").cast("string").cast("binary")) % 4 != 2).groupBy("id").agg(F.max("label").alias("label"))
    rows = rows.orderBy(F.xxhash64("id"), "id").limit(most)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    return written(texts.join(F.broadcast(rows), "id").select("text", F.col("label").alias("toxic"), F.pmod(F.xxhash64("text"), F.lit(5)).alias("fold")), "labelled")  # at most `most` rows are broadcast


def _first_contexts(text: str, read: Readings) -> dict[str, tuple[str, str]]:
    """Each feature of a text with the words before and after the first place that has it."""
    words = [w for token in (text or "").split() for w in read(token)]
    out: dict[str, tuple[str, str]] = {}
    for i, w in enumerate(words):
        for f in features(w):
            out.setdefault(f, (words[i - 1] if i else "", words[i + 1] if i + 1 < len(words) else ""))
    for w in spaced(text or "", read.model):
        for f in features(w):
            out.setdefault(f, ("", w))
    return out


def train(docs: DataFrame, labels: DataFrame, most: int = 20_000, least_support: int = 4, least_precision: float = 0.6) -> Scorer:
    """Fit the character model on all texts of docs, and the word weights on at most `most` labelled ones.

    The support of a feature is the number of different neighbourhoods it has in toxic documents (its first
    in each), so that copies of one document do not count again. A feature is kept if its support is
    high against the other documents that have it: a G-test whose bound grows with the number of
    features tested, and a smoothed precision. A fifth of the texts does not teach weights but how
    far to trust them. Without labels of both kinds every score is the same.
    """
    model = language_model(docs)
    rows = labelled(docs, labels, most)
    taught = rows.filter("fold > 0")
    size = {t: n for t, n in taught.groupBy(F.col("toxic") == 1).count().collect()}
    toxic, other = size.get(True, 0), size.get(False, 0)
    prior = np.array([math.log((toxic + 1) / (other + 9)), 1.0, 0.0, 0.0, 0.0])
    if not toxic or not other:
        return Scorer(model, {}, (-2.2, 0.0, 0.0, 0.0, 0.0))

    def contexts(batches):
        read = Readings(model)
        for batch in batches:
            out = Counter((f, hash_text("\x1f".join(c))) for t in batch.column(0).to_pylist() for f, c in _first_contexts(t, read).items())
            yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in out], pa.string()), pa.array([c for _, c in out], pa.int64())], ["feature", "context"])

    support = taught.filter("toxic = 1").select("text").mapInArrow(contexts, "feature string, context long").groupBy("feature").agg(F.countDistinct("context").alias("n"))
    wanted = {f: n for f, n in support.filter(F.col("n") >= least_support).collect()}  # bounded by the sample of labelled rows

    def elsewhere(batches):
        out: Counter = Counter()
        known: dict[str, set[str]] = {}
        of_words = lambda words: {f for w in words for f in features(w) if f in wanted}
        for batch in batches:
            for t in batch.column(0).to_pylist():
                found = of_words(spaced(t or "", model))
                for token in set((t or "").split()):
                    own = known.get(token)
                    if own is None:
                        if len(known) >= MOST_TOKENS:
                            known.clear()
                        own = known[token] = of_words(readings(token, model))
                    found |= own
                out.update(found)
        yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.string()), pa.array(list(out.values()), pa.int64())], ["feature", "n"])

    seen = dict(taught.filter("toxic <> 1").select("text").mapInArrow(elsewhere, "feature string, n long").groupBy("feature").agg(F.sum("n")).collect())
    bound, share, weights = 18 + 2 * math.log(max(1.0, len(wanted) / 1000)), toxic / (toxic + other), {}
    for f, a in wanted.items():
        b = seen.get(f, 0)
        rate = a / (a + b)
        g = 2 * (a * math.log(rate / share) + (b * math.log((1 - rate) / (1 - share)) if b else 0.0))
        if rate > share and g >= bound and a / (a + b + 1) >= least_precision:
            weights[f] = math.log((a + 1) / (toxic + 2)) - math.log((b + 1) / (other + 2))
    found = Scorer(model, weights, tuple(prior))

    def weighed(batches):
        for batch in batches:
            evidence = [found.evidence(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(evidence, pa.list_(pa.float64())), batch.column(1)], ["evidence", "toxic"])

    kept = rows.filter("fold = 0").select("text", "toxic").mapInArrow(weighed, "evidence array<double>, toxic int").collect()  # bounded by `most`
    kept = sorted((tuple(r[0]), r[1]) for r in kept)
    if kept:
        found.coefficients = calibrated(np.array([r[0] for r in kept]), np.array([float(r[1] == 1) for r in kept]), prior)
    return found


def hash_text(text: str) -> int:
    """A stable 63-bit hash; Python's own differs between workers."""
    raw = text.encode()
    return zlib.crc32(raw) << 31 ^ zlib.adler32(raw)


def scored(docs: DataFrame, scorer: Scorer, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of docs.

    docs needs doc_id and text; other columns are not read. Defined results: null, empty and blank texts get
    the score of a text without toxic words; a null doc_id is returned with held_out false; repeated rows get equal scores; an empty table gives none.
    A text of any length is scored whole: its different tokens, and the words spelled out in it.
    """
    scorer = with_lexicon(docs, scorer)

    def run(batches):
        for batch in batches:
            scores = [scorer.score(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return docs.select(F.col("doc_id").cast("long"), held.alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, scorer: Scorer, threshold: float = 0.3) -> DataFrame:
    """The rows of docs that score below threshold, with all their columns, whatever their names; no row is shuffled."""
    text = docs.columns.index("text")
    scorer = with_lexicon(docs, scorer)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array([scorer.score(t) < threshold for t in batch.column(text).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
