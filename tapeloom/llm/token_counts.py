"""Token counts of documents under a unigram piece model, with the dynamic program shared over a trie.

The pieces come from a public vocabulary file, which is not changed. How likely each piece is, is learnt
from the corpus: the different pre-tokens of the table are counted with one shuffle, and in a few rounds
the best segmentation of each, times its count, counts the pieces again. A text is cut into pre-tokens
(a run of letters and digits, or of other signs, with a mark where white space stood before it).

Different pre-tokens are sorted over the whole table and inserted into a trie: the forward score of a
node is computed from its ancestors once for all pre-tokens that share the prefix, and terminal nodes
keep the piece counts. The counts of the most frequent pre-tokens travel with the tasks that sum up
texts; a rarer one is scored where it occurs, at most as often as it occurs, and with the same result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import discard, written

#: White space before a pre-token, as the vocabulary writes it.
MARK = "▁"
_PRETOKEN = re.compile(r"[^\W_]+|(?:[^\w\s]|_)+")
#: Constants of Zipf's law with an offset, from which learning starts; a character that no piece has falls back to its UTF-8 bytes.
ZIPF_SHIFT, BYTE_COST = 2.7, 14.0
#: Texts whose pre-tokens are inserted together, and different pre-tokens that a task holds.
_AT_ONCE, _MOST = 500, 600_000


def piece_costs(pieces: list[str]) -> dict[str, float]:
    """Negative log probability by piece before anything is learnt; the position in the list is the rank."""
    total = math.log(sum(1.0 / (r + ZIPF_SHIFT) for r in range(1, len(pieces) + 1)))
    return {p: math.log(r + ZIPF_SHIFT) + total for r, p in reversed(list(enumerate(pieces, 1)))}


def sentencepiece_pieces(path: str) -> list[str]:
    """The ordinary pieces of a SentencePiece model file, in the order of their scores."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return [model.id_to_piece(i) for i in sorted(ids, key=lambda i: (-model.get_score(i), i))]


def pretokens(word: str) -> list[str]:
    """The pre-tokens of a stretch without white space; the first carries the mark."""
    first, *rest = _PRETOKEN.findall(word) or [""]
    return [MARK + first, *rest]


@dataclass
class Trie:
    """Piece counts of pre-tokens. counts holds those of the terminal nodes.

    Pre-tokens are inserted a batch at a time in sorted order, so the trie is walked depth first: the
    nodes from the root to the last pre-token are at hand, those that the next one shares are not
    computed again, and the others will not be needed any more.
    """

    costs: dict[str, float]
    counts: dict[str, int] = field(default_factory=dict)
    endings: set[str] = field(default_factory=set)

    def __post_init__(self):
        # All endings of pieces: looking back from a node stops where no piece can go on.
        self.endings = {p[i:] for p in self.costs for i in range(len(p))}

    def insert(self, tokens, used: Counter | None = None, times: dict[str, int] | None = None) -> None:
        """Count the pieces of the best segmentation of each token; ties go to fewer pieces. used, where given, sums up times[token] for each piece of it."""
        price, more, counts = self.costs.get, self.endings, self.counts
        last, cost, size, back = "", [0.0], [0], [0]
        for token in sorted(tokens):
            shared = 0
            for a, b in zip(last, token, strict=False):
                if a != b:
                    break
                shared += 1
            del cost[shared + 1 :], size[shared + 1 :], back[shared + 1 :]
            for end in range(shared + 1, len(token) + 1):
                raw = len(token[end - 1].encode())
                least, n, start = cost[end - 1] + BYTE_COST * raw, size[end - 1] + raw, -1
                for i in range(end - 1, -1, -1):
                    piece = token[i:end]
                    p = price(piece)
                    if p is None:
                        if piece not in more:
                            break
                        continue
                    p += cost[i]
                    if p < least or p == least and size[i] + 1 < n:
                        least, n, start = p, size[i] + 1, i
                cost.append(least)
                size.append(n)
                back.append(start)
            counts[token] = size[-1]
            if used is not None:
                end = len(token)
                while end:
                    start = back[end]
                    if start >= 0:
                        used[token[start:end]] += times[token]
                    end = start if start >= 0 else end - 1  # a character by its bytes uses no piece
            last = token


def pretoken_counts(docs: DataFrame) -> DataFrame:
    """token and n: the different pre-tokens of the whole texts of docs. Each task sums up what it meets before the shuffle."""

    def run(batches):
        words: Counter = Counter()

        def cut():
            out: Counter = Counter()
            for word, n in words.items():
                for token in pretokens(word):
                    out[token] += n
            words.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(out), pa.string()), pa.array(list(out.values()), pa.int64())], ["token", "n"])

        for batch in batches:
            for t in batch.column(0).to_pylist():
                words.update((t or "").split())
                if len(words) >= _MOST:
                    yield cut()
        yield cut()

    return docs.select("text").mapInArrow(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))


def learnt_costs(counted: DataFrame, pieces: list[str], rounds: int = 2, added: float = 0.5) -> dict[str, float]:
    """Negative log probability by piece from counted (token, n), by `rounds` of Viterbi training from Zipf's law; added is what every piece counts beforehand.

    counted should lie in sorted order, so that tasks share prefixes. Only the pieces' counts, which the vocabulary bounds,
    reach the driver.
    """
    costs = piece_costs(pieces)
    for _ in range(rounds):

        def run(batches, costs=costs):
            trie, used = Trie(costs), Counter()
            for batch in batches:
                times = dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
                trie.insert(times, used, times)
                trie.counts.clear()
            yield pa.RecordBatch.from_arrays([pa.array(list(used), pa.string()), pa.array(list(used.values()), pa.int64())], ["piece", "n"])

        found = dict(counted.select("token", "n").mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n")).collect())
        total = sum(found.values()) + added * len(costs)
        costs = {p: math.log(total) - math.log(found.get(p, 0) + added) for p in costs}
    return costs


def token_counts(docs: DataFrame, pieces: list[str], rounds: int = 2, head: int = 200_000) -> DataFrame:
    """doc_id, n_words (stretches without white space) and n_tokens of every row of docs, over whole texts.

    docs needs doc_id and text; other columns are not read. head is how many of the most frequent pre-tokens are
    scored ahead of the texts; it bounds what travels to the tasks and changes no count. Defined results: null,
    empty and blank texts have no tokens; a null doc_id and repeated rows are returned as they are; an empty
    table gives none. Texts and pre-tokens of any length are scored whole. No text is shuffled: only different
    pre-tokens are, already summed up by task, so a frequent one is no hot key.
    """
    counted = written(pretoken_counts(docs).repartitionByRange("token").sortWithinPartitions("token"), "pretokens")
    costs = learnt_costs(counted, pieces, rounds)

    def scored(batches):
        trie = Trie(costs)
        for batch in batches:
            tokens = batch.column(0).to_pylist()
            trie.insert(tokens)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([trie.counts[t] for t in tokens], pa.int64())], ["token", "n_pieces"])
            trie.counts.clear()

    frequent = counted.orderBy(F.desc("n"), "token").limit(head).select("token").repartitionByRange("token").sortWithinPartitions("token")
    known = dict(frequent.mapInArrow(scored, "token string, n_pieces long").collect())  # at most head rows
    discard(counted)

    def run(batches):
        trie, sums = Trie(costs, dict(known)), {}  # sums: tokens by word
        for batch in batches:
            words, tokens = [], []
            texts = batch.column(1).to_pylist()
            for a in range(0, len(texts), _AT_ONCE):
                found = [(t or "").split() for t in texts[a : a + _AT_ONCE]]
                met = set().union(*found)
                if len(sums) + len(met) > _MOST:
                    sums.clear()
                    trie.counts = dict(known)
                cut = {w: pretokens(w) for w in met - sums.keys()}
                trie.insert(set().union(*cut.values()) - trie.counts.keys())
                sums.update((w, sum(map(trie.counts.__getitem__, x))) for w, x in cut.items())
                words += map(len, found)
                tokens += (sum(map(sums.__getitem__, x)) for x in found)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], ["doc_id", "n_words", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_words long, n_tokens long")
