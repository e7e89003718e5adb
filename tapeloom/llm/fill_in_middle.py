"""Fill-in-middle transformation: texts cut in prefix, middle and suffix, and put in another order behind markers.

A text is a row of fixed blocks of bytes. A Fenwick tree over the blocks stores how many units end in each and how many
code points begin in it, so a cut "after k units" is found by binary-lifting descent: the tree is walked from its
largest power of two down, and stops at the block in which the k-th unit ends. Only that block is then looked at to
find the boundary; the code points before it are a sum over the tree and a count inside the block. No text is decoded.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import utf8

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Bytes of a block.
BLOCK = 1024
#: Bytes of output after which a task hands on what it has.
_FLUSH = 8 << 20


def fenwick(counts: np.ndarray) -> np.ndarray:
    """The tree of counts: place i (from 1) sums the i & -i counts that end with the i-th."""
    upto = np.r_[0, np.cumsum(counts, dtype=np.int64)]
    i = np.arange(len(counts) + 1)
    return upto - upto[i - (i & -i)]


def descend(tree: np.ndarray, k: int) -> tuple[int, int]:
    """(block, counted before it) of the block that holds the k-th of what tree counts, k from 1; len(tree) - 1 if there are fewer."""
    at, before, step = 0, 0, 1 << (len(tree) - 1).bit_length()
    while step:
        if at + step < len(tree) and before + tree[at + step] < k:
            at += step
            before += int(tree[at])
        step >>= 1
    return at, before


def counted(tree: np.ndarray, block: int) -> int:
    """What tree counts in the blocks before `block`."""
    total = 0
    while block:
        total += int(tree[block])
        block -= block & -block
    return total


class Blocks:
    """The blocks of one text. unit is a pattern over UTF-8 bytes whose matches, left to right, are the units; None: code points."""

    def __init__(self, data: np.ndarray, unit: re.Pattern[bytes] | None = None):
        self.data, self.unit = data, unit
        self.begins = (data & 0xC0) != 0x80  # code points begin at these bytes
        at = np.arange(0, len(data), BLOCK)
        chars = np.add.reduceat(self.begins, at, dtype=np.int64) if len(data) else np.zeros(0, np.int64)
        self.chars = fenwick(chars)
        if unit is None:
            # A code point ends where the next one begins; by its first byte it is in a block just as well.
            self.units, self.n = self.chars, int(chars.sum())
        else:
            ends = np.fromiter((m.end() for m in unit.finditer(data.tobytes()) if m.end() > m.start()), np.int64)
            self.n = len(ends)
            own = np.maximum(ends - 1, 0) // BLOCK
            self.units = fenwick(np.bincount(own, minlength=len(at)))
            # From where matching goes on in a block: the end of the last unit that ended before it.
            last = np.searchsorted(own, np.arange(len(at)), "left")
            self.enter = np.r_[0, ends][last] if len(at) else np.zeros(0, np.int64)

    def cut(self, k: int) -> tuple[int, int]:
        """(bytes, code points) before the place after k units."""
        if not k:
            return 0, 0
        block, before = descend(self.units, k)
        first = block * BLOCK
        if self.unit is None:
            starts = np.flatnonzero(self.begins[first : first + BLOCK])
            place = first + int(starts[k - before - 1]) + 1
            while place < len(self.data) and not self.begins[place]:
                place += 1
            return place, k
        place, left = int(self.enter[block]), k - before
        for m in self.unit.finditer(self.data.tobytes(), place):
            left -= m.end() > m.start()
            if not left:
                place = m.end()
                break
        block = place // BLOCK
        return place, counted(self.chars, block) + int(self.begins[block * BLOCK : place].sum())


def transformed(doc_id: int | None, data: np.ndarray, unit: re.Pattern[bytes] | None, seed: int, plain_from: int, spm_below: int) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, prefix's and middle's code points, output) of one text."""
    raw = data.tobytes()
    blocks = Blocks(data, unit)
    n = blocks.n
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not raw or h3 % 100 >= plain_from or any(m in raw for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, raw
    (a, a_chars), (b, b_chars) = (blocks.cut(k) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = raw[:a], raw[a:b], raw[b:]
    if h4 % 100 < spm_below:
        return n, "spm", a_chars, b_chars - a_chars, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return n, "psm", a_chars, b_chars - a_chars, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


_OUT = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])


def fill_in_middle(docs: DataFrame, unit: str | None = None, seed: int = 1, plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """doc_id, n (units of the text), form, prefix_chars, middle_chars and output for every row of docs; no shuffle.

    unit is a regular expression over UTF-8 bytes, None for code points. The first four 8-digit groups of the SHA-256 of
    `seed:doc_id`, read as unsigned numbers, decide: the first two, modulo n + 1, after how many units the text is cut;
    the third whether it stays plain (its remainder by 100 is plain_from or more); the fourth whether the order is spm
    (below spm_below) or psm. A text that holds a marker stays plain.

    docs needs doc_id and text; other columns are not read, whatever their names. Defined results: null and empty texts
    are plain with an empty output; a null doc_id draws as an empty one; repeated rows are returned as often as they
    occur and draw alike; a text without units (a pattern that matches nothing) is all suffix; an empty table gives
    none; a text of any length is cut whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(unit.encode()) if unit is not None else None
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            rows, size = [], 0
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                rows.append((doc_id, *transformed(doc_id, data[offsets[i] : offsets[i + 1]], pattern, seed, plain_from, spm_below)))
                size += len(rows[-1][-1])
                if size >= _FLUSH:
                    yield _batch(rows)
                    rows, size = [], 0
            if rows:
                yield _batch(rows)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    *plain, output = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([*(pa.array(x, f.type) for x, f in zip(plain, _OUT, strict=False)), pa.array(output, pa.binary()).cast(pa.string(), safe=False)], schema=_OUT)


def restored(output: Column, form: Column) -> Column:
    """The text that output was made from, by built-in functions. Markers in outputs that are not plain stand where the transformation put them."""
    p, s, m = (x.decode() for x in (PREFIX, SUFFIX, MIDDLE))
    behind = lambda c, mark: F.substring_index(c, mark, -1)
    before = lambda c, mark: F.substring_index(c, mark, 1)
    head = before(output, m)
    psm = F.concat(behind(before(head, s), p), behind(output, m), behind(head, s))
    spm = F.concat(behind(head, p), behind(output, m), behind(before(head, p), s))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def report(made: DataFrame) -> DataFrame:
    """The digests of fill_in_middle()'s outputs and of the texts rebuilt from them."""
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )
