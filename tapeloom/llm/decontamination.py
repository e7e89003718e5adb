"""Benchmark passages in documents, by CGK random-walk embedding and bit-sampling LSH.

The embedding (Chakraborty, Goldenberg and Koucky 2016) walks over a text: at step t it emits the
character under its pointer and moves on by one or by none, as a random bit of (t, character) says.
Texts at a small edit distance get embeddings at a small Hamming distance, since after an edit both
walks soon meet again. A table samples a few steps of one walk; where an item and a document agree
in all of them, the item-sized window there is a candidate. If it has enough of the item's grams,
its edit distance is measured exactly. A walk is short, so that one embedding of a place serves the windows of all items.

Windows are anchored at word starts and, in runs of over _LONG bytes without white space (scripts
that do not part words, paths, what is glued to other text), at minimizers: of every _WINDOW code
points in a row the one whose next bytes have the least hash, so any stretch that text and item share
anchors at the same places. Each item enters every table once for each of its own anchors, so a window
is found if any stretch of a few words of it survives unedited (or with edits that no sampled step
sees) in any table; the window then begins that much earlier.

Shorter items have fewer anchors, so their walks are shorter: each class of lengths has walks of its
own, and as many tables as the target recall asks for in that class. A walk that leaves its item says
nothing of it. Items of under LEAST code points are in no table: they are searched for exactly, at every place. An edit touches three trigrams at most, so a window within
`most` edits of an item of m characters holds m - 2 - 3 * most of its trigrams; they are counted for
many items in one pass over the text, and where there are enough the distance is measured, many
places at a time. Where that number says too little, of most + 1 pieces of the item one stands unedited.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import chunks, utf8, word_spans, written

#: A-Z as a-z, and every white-space byte as a space: edits of case and line breaks do not count.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BITS = 22
#: Code points that one column of the exact search takes.
_STRIDE = 16
#: What stands before the first text in the exact search: more than a short item and its edits.
_LEAD = 128
#: Least number of trigrams that is worth counting.
_FEW = 2
#: What stands between texts in the exact search; no code point.
_NONE = 0x110000
#: Bytes without white space from which on places inside of a run are anchors too, and code points of which one is.
_LONG, _WINDOW = 16, 8
#: Code points of the shortest item that has walks.
LEAST = 44
#: Lengths from which the recall is measured on its own: it must reach the target in each band, not on the average of a class.
BANDS = (44, 60, 80, 110, 150, 200, 300)


@dataclass(frozen=True)
class Walks:
    """Parameters of the LSH for items of `least` code points and more: the number of tables, the steps of a walk, the steps sampled and how many of them a first look takes."""

    tables: int = 4
    steps: int = 44
    sampled: int = 18
    first: int = 9
    seed: int = 11
    least: int = LEAST

    def drawn(self) -> list[tuple[np.ndarray, list[int]]]:
        """For each table, the random bits by (step, byte) and the sampled steps."""
        rng = np.random.default_rng(self.seed)
        return [(rng.integers(0, 2, (self.steps, 256), dtype=np.int32), sorted(rng.choice(self.steps, self.sampled, replace=False).tolist())) for _ in range(self.tables)]


#: By length of the item; the tables are what walks_for() starts from.
CLASSES = (Walks(2, 20, 10, 7, least=LEAST), Walks(2, 28, 12, 8, least=80), Walks(2, 44, 18, 9, least=150))


def fold(text: str | None) -> str:
    """What is compared: A-Z lower-cased, white space as spaces."""
    return _FOLD[np.frombuffer((text or "").encode(), dtype=np.uint8)].tobytes().decode()


def edit_distance_within(item: str, window: str, most: int) -> tuple[int, int] | None:
    """(edits, end) of the part of window nearest to item, at most `most` edits away; else None.

    Bit-parallel (Myers 1999): one word of len(item) bits a character.
    """
    m = len(item)
    if not m:
        return None
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << m - 1
    up, down, score, best = full, 0, m, (m, 0)
    for j, c in enumerate(window, 1):
        eq = masks.get(c, 0)
        diagonal = ((eq & up) + up ^ up) | eq | down
        plus, minus = down | ~(diagonal | up) & full, up & diagonal
        score += bool(plus & top) - bool(minus & top)
        plus, minus = plus << 1 & full, minus << 1 & full
        up, down = minus | ~(diagonal | plus) & full, plus & diagonal
        if score < best[0]:
            best = (score, j)
    return best if best[0] <= most else None


def anchors(data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Where windows may begin in data, in which texts begin at each of cuts: word starts, and minimizers of long runs."""
    if not len(data):
        return np.zeros(0, np.int64)
    starts, ends = word_spans(data, cuts)
    long = np.flatnonzero(ends - starts > _LONG)
    if not len(long):
        return starts
    size = ends[long] - starts[long]
    run = np.repeat(np.arange(len(long)), size)
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + starts[long][run]
    point = (data[at] & 0xC0) != 0x80
    at, run = at[point], run[point]
    if len(at) < _WINDOW:
        return starts
    padded = np.r_[data, np.zeros(4, np.uint8)].astype(np.uint32)
    gram = padded[at] | padded[at + 1] << 8 | padded[at + 2] << 16 | padded[at + 3] << 24
    hashed = (gram * np.uint32(0x9E3779B1)) ^ (gram * np.uint32(0x85EBCA6B) >> np.uint32(13))
    windows = np.lib.stride_tricks.sliding_window_view(hashed, _WINDOW)
    whole = np.flatnonzero(run[_WINDOW - 1 :] == run[: len(run) - _WINDOW + 1])
    return np.union1d(starts, at[whole + windows[whole].argmin(axis=1)])


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def _grams(codes: np.ndarray, size: int) -> np.ndarray:
    """A 16-bit hash of the `size` code points from each place but the last ones; equal grams have equal hashes."""
    n = max(0, len(codes) - size + 1)
    h = np.zeros(n, dtype=np.uint32)
    for i, odd in zip(range(size), (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F)):
        h += codes[i : i + n] * np.uint32(odd)
    return (h >> np.uint32(16)).astype(np.uint16)


def _trigrams(codes: np.ndarray) -> np.ndarray:
    return _grams(codes, 3)


def _near_trigrams(items: list[tuple[str, int]], codes: np.ndarray) -> Iterator[np.ndarray]:
    """For each (item, most), the columns of codes in which a window within most edits may end: enough of the item's trigrams stand there.

    Hash collisions and repeated trigrams only add columns.
    """
    n = len(codes) // _STRIDE
    grams, some = _trigrams(codes), max(1, min(64, (1 << 21) // n))
    for k in range(0, len(items), some):
        part = items[k : k + some]
        own = [np.unique(_trigrams(_codes(x))) for x, _ in part]
        pairs = np.concatenate(own)
        order = np.argsort(pairs, kind="stable")
        holders = np.repeat(np.arange(len(part)), [len(x) for x in own])[order]
        n_holders = np.bincount(pairs, minlength=1 << 16)
        from_ = np.cumsum(n_holders) - n_holders
        at = np.flatnonzero((n_holders > 0)[grams])
        gram = grams[at]
        times = n_holders[gram]
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        column = np.repeat(at // _STRIDE, times)
        counts = np.bincount(holders[np.repeat(from_[gram], times) + nth] * n + column, minlength=len(part) * n).reshape(len(part), n)
        for (item, most), count in zip(part, counts, strict=True):
            spans = (len(item) + most - 2) // _STRIDE + 2  # columns that a window may touch
            total = np.convolve(count, np.ones(spans, dtype=np.int64))[spans - 1 :]  # of a column and those behind it
            begins = total >= len(item) - 2 - 3 * most
            wanted = np.zeros(n, dtype=bool)
            for j in range(max(0, len(item) - most - 1) // _STRIDE, min(n, spans)):  # a window is no shorter than len(item) - most
                wanted[j:] |= begins[: n - j]
            yield wanted


def _near_pieces(item: str, most: int, codes: np.ndarray) -> np.ndarray:
    """The columns of codes in which a window within most edits of item may end: one of most + 1 pieces of it stands there."""
    m, own = len(item), _codes(item)
    wanted = np.zeros(len(codes) // _STRIDE, dtype=bool)
    cuts = [m * i // (most + 1) for i in range(most + 2)]
    for a, b in zip(cuts, cuts[1:]):
        if a == b:
            return ~wanted
        at = np.flatnonzero(codes[: len(codes) - (b - a) + 1] == own[a])
        for j in range(1, b - a):
            at = at[codes[at + j] == own[a + j]]
        for behind in [*range(0, m + most, _STRIDE), m + most]:
            wanted[np.minimum((at + behind) // _STRIDE, len(wanted) - 1)] = True
    return wanted


def _ends_within(item: str, letters: np.ndarray, alphabet: np.ndarray, most: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ends, edits) of the parts of a text at most `most` edits from item (63 code points at most) that end in a wanted column.

    letters are the text's places in alphabet, len(alphabet) where it has none; they must begin with _LEAD of that and be whole columns long.
    """
    m = len(item)
    masks = np.zeros(len(alphabet) + 1, dtype=np.uint64)
    for i, c in enumerate(np.searchsorted(alphabet, _codes(item))):
        masks[c] |= np.uint64(1 << i)
    one, top, lead, ends, edits = np.uint64(1), np.uint64(m - 1), m + most, [], []
    columns = np.flatnonzero(wanted) * _STRIDE
    columns = columns[columns >= _LEAD] - lead  # before _LEAD nothing but _NONE stands
    for k in range(0, len(columns), 4096):
        first = columns[k : k + 4096]
        up, down = np.full(len(first), 2**64 - 1, dtype=np.uint64), np.zeros(len(first), dtype=np.uint64)
        score = np.full(len(first), m, dtype=np.int64)
        for t in range(lead + _STRIDE):
            eq = masks[letters[first + t]]
            diagonal = ((eq & up) + up ^ up) | eq | down
            plus, minus = down | ~(diagonal | up), up & diagonal
            score += (plus >> top & one).astype(np.int64) - (minus >> top & one).astype(np.int64)
            plus, minus = plus << one, minus << one
            up, down = minus | ~(diagonal | plus), plus & diagonal
            if t >= lead and (near := np.flatnonzero(score <= most)).size:
                ends.append(first[near] + t + 1)
                edits.append(score[near])
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *ends]), np.concatenate([none, *edits])


def _embed(data: np.ndarray, places: np.ndarray, bits: np.ndarray, sampled: list[int], first: int, look: np.ndarray | None):
    """Hashes of the sampled steps of the walks from places, and the places that pass the first look."""
    at, key, taken = places.copy(), np.zeros(len(places), dtype=np.uint64), 0
    for t in range(sampled[-1] + 1):
        c = data[at]
        if t in sampled:
            key = (key + c + np.uint64(1)) * _STEP
            taken += 1
            if taken == first and look is not None:
                pass_ = np.flatnonzero(look[(key >> np.uint64(64 - _BITS)).astype(np.int64)])
                places, at, key, c = places[pass_], at[pass_], key[pass_], c[pass_]
        at += bits[t][c]
    return places, key, at


class Tables:
    """The tables of the items of one class of lengths."""

    def __init__(self, walks: Walks, members: np.ndarray, raw: list[bytes], starts: list[np.ndarray]):
        self.walks, self.drawn, self.tables = walks, walks.drawn(), []
        pad = walks.steps + 1
        sizes = np.array([len(raw[i]) for i in members], dtype=np.int64)
        cuts = np.r_[0, np.cumsum(sizes + pad)]
        data = np.frombuffer(b"".join(raw[i] + b"\0" * pad for i in members), dtype=np.uint8)
        item = np.repeat(np.arange(len(members)), [len(starts[i]) for i in members])
        offset = np.concatenate([*(starts[i] for i in members), np.zeros(0, np.int64)])
        for bits, sampled in self.drawn:
            places = (cuts[item] + offset).astype(np.int64)
            look = np.zeros(1 << _BITS, dtype=bool)
            _, short, _ = _embed(data, places, bits, sampled[: walks.first], walks.first, None)
            _, keys, end = _embed(data, places, bits, sampled, walks.first, None)
            inside = end <= cuts[item] + sizes[item]
            short, keys, its, offs = short[inside], keys[inside], members[item[inside]], offset[inside]
            look[(short >> np.uint64(64 - _BITS)).astype(np.int64)] = True
            order = np.argsort(keys, kind="stable")
            self.tables.append((look, keys[order], its[order], offs[order]))

    def candidates(self, data: np.ndarray, places: np.ndarray) -> Iterator[np.ndarray]:
        for (bits, sampled), (look, keys, its, offs) in zip(self.drawn, self.tables, strict=True):
            at, key, _ = _embed(data, places, bits, sampled, self.walks.first, look)
            lo, hi = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            n = hi - lo
            which = np.repeat(np.arange(len(at)), n)
            entry = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + lo[which]
            yield np.stack([at[which], its[entry], offs[entry]], axis=1)


class Index:
    """The tables of a block of items; small enough to travel with the tasks. An item belongs to the last class whose `least` it reaches."""

    def __init__(self, items: list[tuple[int, str]], walks: tuple[Walks, ...]):
        self.ids = [i for i, _ in items]
        self.texts = [fold(t) for _, t in items]
        self.steps = max(w.steps for w in walks)
        raw = [t.encode() for t in self.texts]
        starts = [anchors(np.frombuffer(x, dtype=np.uint8), np.array([0, len(x)])) for x in raw]
        sizes = np.array([len(t.strip(" ")) for t in self.texts], dtype=np.int64)
        kind = np.searchsorted([w.least for w in walks], sizes, "right") - 1
        self.short = np.flatnonzero((kind < 0) & (sizes > 0)).tolist()
        self.grams = [{size: np.unique(_grams(_codes(t), size), return_counts=True) for size in (3, 4) if len(t) >= size} for t in self.texts]
        self.classes = [Tables(w, np.flatnonzero(kind == k), raw, starts) for k, w in enumerate(walks) if (kind == k).any()]

    def may_hold(self, item: int, window: str, most: int) -> bool:
        """Whether window has as many of the item's grams of 3 and of 4 characters as one within `most` edits must have; an edit touches as many as a gram is long, and equal hashes only add."""
        codes = _codes(window)
        for size, (gram, times) in self.grams[item].items():
            least = len(self.texts[item]) - size + 1 - size * most
            if least > 0 and np.minimum(np.bincount(_grams(codes, size), minlength=1 << 16)[gram], times).sum() < least:
                return False
        return True

    def candidates(self, data: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Rows (place, item, offset in the item) that agree in some table. data must be padded by the steps of a walk."""
        found = [x for c in self.classes for x in c.candidates(data, places)]
        return np.unique(np.concatenate([np.zeros((0, 3), np.int64), *found]), axis=0)

    def matches(self, texts: pa.Array, share: float):
        """(row, item_id, start, end, n_edits) for all windows of texts within share * length edits of an item; the nearest window of each item and text."""
        data, offsets = utf8(texts)
        for a, b in chunks(offsets):
            cuts = offsets[a : b + 1] - offsets[a]
            part = np.concatenate([_FOLD[data[offsets[a] : offsets[b]]], np.zeros(self.steps + 1, np.uint8)])
            places = anchors(part[: cuts[-1]], cuts) if self.classes else np.zeros(0, np.int64)
            hits = self.candidates(part, places)
            best = self._short_matches(part[: cuts[-1]], cuts, share)
            rows = np.searchsorted(cuts, hits[:, 0], "right") - 1
            tried: dict[tuple[int, int], list[tuple[int, int]]] = {}
            folded: dict[int, str] = {}
            for row, (place, item, offset) in zip(rows.tolist(), hits.tolist(), strict=True):
                text = self.texts[item]
                most = int(share * len(text))
                if (best.get((row, item)) or (1,))[0] == 0:
                    continue
                # Bytes before the place, then characters: the window begins where the item would.
                lead = len(part[cuts[row] : place].tobytes().decode())
                begin = lead - len(text.encode()[:offset].decode())
                low, high = max(0, begin - most), begin + len(text) + most
                if any(x <= low and high <= y for x, y in tried.get((row, item), ())):
                    continue
                tried.setdefault((row, item), []).append((low, high))
                if row not in folded:
                    folded = {row: part[cuts[row] : cuts[row + 1]].tobytes().decode()}
                window = folded[row][low:high]
                if not self.may_hold(item, window, most):
                    continue
                if got := edit_distance_within(text, window, most):
                    edits, end = got
                    back = edit_distance_within(text[::-1], window[:end][::-1], most)
                    start = end - back[1] if back else max(0, end - len(text))
                    if (row, item) not in best or edits < best[row, item][0]:
                        best[row, item] = (edits, low + start, low + end)
            for (row, item), (edits, start, end) in sorted(best.items()):
                yield a + row, self.ids[item], start, end, edits

    def _short_matches(self, data: np.ndarray, cuts: np.ndarray, share: float) -> dict[tuple[int, int], tuple[int, int, int]]:
        """(edits, start, end) of the nearest window of each text and short item, by (row, item)."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        if not self.short or not len(data):
            return best
        # Code points with more of _NONE between texts than any short item may have edits.
        chars = np.r_[0, np.cumsum(data & 0xC0 != 0x80)][cuts]
        most = {i: int(share * len(self.texts[i])) for i in self.short}
        gap = 1 + max(most.values())
        origin = _LEAD + chars[:-1] + gap * np.arange(len(chars) - 1)
        codes = np.full(-(-(origin[-1] + chars[-1] - chars[-2] + 1) // _STRIDE) * _STRIDE, _NONE, dtype=np.uint32)
        codes[np.arange(chars[-1]) + np.repeat(origin - chars[:-1], np.diff(chars))] = _codes(data.tobytes().decode())
        whole = lambda row: data[cuts[row] : cuts[row + 1]].tobytes().decode()
        # Much white space before a short word, or a share near 1: one text at a time.
        plain = [i for i in self.short if len(self.texts[i]) > 63 or len(self.texts[i]) + most[i] >= _LEAD]
        counted = [i for i in self.short if i not in plain and len(self.texts[i]) - 2 - 3 * most[i] >= _FEW]
        pieces = [i for i in self.short if i not in plain and i not in counted]

        alphabet = np.unique(_codes("".join(self.texts[i] for i in self.short)))
        place = np.full(_NONE + 1, len(alphabet), dtype=np.int32)
        place[alphabet] = np.arange(len(alphabet))
        letters = place[codes]

        def nearest() -> Iterator[tuple[int, dict[int, tuple[int, int]]]]:
            for i in plain:
                yield i, {row: got for row in range(len(origin)) if (got := edit_distance_within(self.texts[i], whole(row), most[i]))}
            columns = chain(_near_trigrams([(self.texts[i], most[i]) for i in counted], codes), (_near_pieces(self.texts[i], most[i], codes) for i in pieces))
            for i, wanted in zip([*counted, *pieces], columns, strict=True):
                ends, edits = _ends_within(self.texts[i], letters, alphabet, most[i], wanted)
                rows = np.searchsorted(origin, ends - 1, "right") - 1
                got: dict[int, tuple[int, int]] = {}
                for k in np.lexsort((ends, edits, rows)).tolist():
                    row = int(rows[k])
                    got.setdefault(row, (int(edits[k]), int(min(ends[k] - origin[row], chars[row + 1] - chars[row]))))
                yield i, got

        for i, found in nearest():
            item = self.texts[i]
            for row, (edits, end) in found.items():
                back = edit_distance_within(item[::-1], whole(row)[max(0, end - len(item) - most[i]) : end][::-1], most[i])
                best[row, i] = (edits, end - back[1] if back else max(0, end - len(item)), end)
        return best


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about block_bytes of text, one at a time on the driver."""
    rows = items.select(F.col("item_id").cast("long"), "text").filter("item_id is not null and trim(text) <> ''").distinct()
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-size // block_bytes))
    for k in range(n):
        yield sorted(map(tuple, rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()))


def _edited(rng: np.random.Generator, text: str, share: float) -> str:
    """text with int(share * length) random edits: characters taken out, put in or replaced by others of the text."""
    out = list(text)
    for _ in range(int(share * len(text))):
        at, kind = int(rng.integers(len(out))), rng.integers(3)
        other = text[rng.integers(len(text))]
        if kind == 0 and len(out) > 1:
            del out[at]
        elif kind == 1:
            out.insert(at, other)
        else:
            out[at] = other
    return "".join(out)


def measured_recall(items: list[tuple[int, str]], walks: tuple[Walks, ...], share: float, edits: float, copies: int = 2) -> float:
    """The share of randomly edited copies of items, between other words, in which contaminations() would find the item."""
    rng = np.random.default_rng(5)
    texts = [f"other words before {_edited(rng, t, edits)} other words behind" for _, t in items for _ in range(copies)]
    own = [i for i, _ in items for _ in range(copies)]
    found = {(row, item) for row, item, *_ in Index(items, walks).matches(pa.array(texts, pa.string()), share)}
    return sum((row, i) in found for row, i in enumerate(own)) / max(1, len(own))


def recall_by_band(items: list[tuple[int, str]], walks: tuple[Walks, ...], share: float, edits: float) -> dict[int, tuple[float, int]]:
    """measured_recall() of the items of each band of lengths and the copies measured, by the band's least length."""
    bands: dict[int, list[tuple[int, str]]] = {}
    for i, t in items:
        if (size := len(fold(t).strip(" "))) >= BANDS[0]:
            bands.setdefault(max(b for b in BANDS if b <= size), []).append((i, t))
    return {b: (measured_recall(bands[b], walks, share, edits, copies=4), 4 * len(bands[b])) for b in sorted(bands)}


def recall_by_class(items: list[tuple[int, str]], share: float, target_recall: float, classes: tuple[Walks, ...] = CLASSES) -> list[tuple[Walks, float]]:
    """For each class of lengths, its walks and the least recall of a band in it, on items that are edited in as many places as share allows; nan without items.

    Tables are as few (2, 4, ... 64) as bring every band to target_recall by more than the standard error of what was measured.
    """
    out = []
    for k, walks in enumerate(classes):
        until = classes[k + 1].least if k + 1 < len(classes) else 1 << 62
        own = [(i, t) for i, t in items if walks.least <= len(fold(t).strip(" ")) < until]
        recall = float("nan")
        while own:
            found = recall_by_band(own, (walks,), share, share)
            recall = min(r for r, _ in found.values())
            if walks.tables >= 64 or all(r - (r * (1 - r) / n) ** 0.5 >= target_recall for r, n in found.values()):
                break
            walks = replace(walks, tables=2 * walks.tables)
        out.append((walks, recall))
    return out


def walks_for(items: DataFrame, share: float = 0.2, target_recall: float = 0.9, sample: int = 100, classes: tuple[Walks, ...] = CLASSES) -> tuple[Walks, ...]:
    """Walks for every class of lengths that reach target_recall there, on items edited in as many places as share allows, the worst that must be found.

    Measured on at most `sample` items of each class, those with the least hash; a class without items keeps its walks. A class
    that does not reach the target with 64 tables is reported by a warning with the recall that it has.
    """
    size = F.length(F.trim("text"))
    kind = F.lit(0)
    for k, c in enumerate(classes):
        kind = F.when(size >= c.least, k + 1).otherwise(kind)
    rows = items.filter("item_id is not null").select(F.col("item_id").cast("long"), "text", kind.alias("kind")).distinct()
    some = [tuple(r) for k in range(len(classes)) for r in rows.filter(F.col("kind") == k + 1).orderBy(F.xxhash64("item_id", "text"), "item_id", "text").limit(sample).select("item_id", "text").collect()]
    found = recall_by_class(some, share, target_recall, classes)
    for walks, recall in found:
        if recall < target_recall:
            warnings.warn(f"items of {walks.least} code points and more: measured recall {recall:.2f} with {walks.tables} tables, target {target_recall}", stacklevel=2)
    return tuple(w for w, _ in found)


def contaminations(docs: DataFrame, items: DataFrame, share: float = 0.2, walks: tuple[Walks, ...] | None = None, target_recall: float = 0.9, block_bytes: int = 4 << 20) -> DataFrame:
    """All (document, item) pairs where a window of the document lies within share * length edits of the item.

    docs needs doc_id and text, items needs item_id and text; other columns are not read. Without walks, walks_for() takes
    as many tables as target_recall asks for. Items are taken in blocks of about block_bytes, each over all documents; the
    matches of a block are written before the next one's index is built, so neither driver nor tasks hold more than
    one block. Returns doc_id, item_id, start and end (code points of the text, end exclusive), n_edits and
    item_length: for each row of docs and item the nearest window. Case of A-Z and kind of white space do not count as edits.
    An exact passage is found at every place, inside words and in scripts that do not part words too; items of under LEAST
    code points are found wherever they are within share edits, longer ones with target_recall at least in their class of lengths.

    Defined results: null and empty texts, and items of no text or id, match nothing; a null doc_id is
    returned as it is; repeated rows are returned as often as they occur; ties go to the first window; a text of any
    length is searched whole, half a megabyte at a time or at once if it is longer.
    """
    walks = walks or walks_for(items, share, target_recall)
    parts: list[DataFrame] = []
    for block in _blocks(items, block_bytes):
        index = Index(block, walks)
        sizes = {i: len(t) for i, t in zip(index.ids, index.texts, strict=True)}

        def run(batches, index=index, sizes=sizes):
            for batch in batches:
                got = list(index.matches(batch.column(1), share))
                if got:
                    row, item, start, end, edits = zip(*got, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(row)), *(pa.array(x, pa.int64()) for x in (item, start, end, edits, [sizes[i] for i in item]))],
                        ["doc_id", "item_id", "start", "end", "n_edits", "item_length"],
                    )

        if parts:
            parts[-1] = written(parts[-1], "contaminations")
        parts.append(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, item_id long, start long, end long, n_edits long, item_length long"))
    return reduce(DataFrame.unionByName, parts)


def decontaminated(docs: DataFrame, items: DataFrame, share: float = 0.2, walks: tuple[Walks, ...] | None = None, target_recall: float = 0.9, block_bytes: int = 4 << 20) -> DataFrame:
    """The rows of docs in which contaminations() finds nothing, with all their columns, whatever their names and ids; no shuffle. What a block of items leaves is written before the next one's index is built."""
    text = docs.columns.index("text")
    walks = walks or walks_for(items, share, target_recall)
    for k, block in enumerate(_blocks(items, block_bytes)):
        index = Index(block, walks)

        def run(batches, index=index):
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[row for row, *_ in index.matches(batch.column(text), share)]] = False
                yield batch.filter(pa.array(keep))

        docs = (written(docs, "decontaminated") if k else docs).mapInArrow(run, docs.schema)
    return docs
