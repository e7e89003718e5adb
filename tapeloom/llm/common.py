"""What several operators of this subpackage share: written tables, byte-level word scans, column checks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Space, tab, line feed, vertical tab, form feed and carriage return: all that separates words.
SPACE_CLASS = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_TO_LOWER = np.arange(256, dtype=np.uint8)
_TO_LOWER[65:91] += 32

#: Bytes of text that one numpy pass takes; bounds the memory of a task.
CHUNK_BYTES = 1 << 19


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local session, where both are one machine, gets a folder of its own if that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not (spark.conf.get("spark.master", None) or "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="tapeloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it again: cuts the lineage and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Replace written() tables that nothing will read any more by empty ones."""
    for t in tables:
        t.sparkSession.range(0).write.mode("overwrite").parquet(t.written_to)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else; where a text is ASCII that is what lower() does, faster."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def words_of(c: Column) -> Column:
    """Array of the words of a text: maximal runs without white space; null and empty texts have none."""
    bare = F.btrim(F.coalesce(c, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{SPACE_CLASS}]+"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null texts count as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts [a, b) of about CHUNK_BYTES together; one longer text is a run of its own."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + CHUNK_BYTES, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def word_spans(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words in data, where texts begin at each of cuts (its last is the end of data)."""
    inside = ~_IS_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    at = cuts[:-1][cuts[:-1] < len(data)]
    begins[at] = inside[at]
    last = cuts[1:][cuts[1:] > 0] - 1
    ends[last] = inside[last]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POW: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if not _POW or len(_POW[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for i, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POW[i : i + 1] = [np.multiply.accumulate(steps)]
    return _POW[0], _POW[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words [start, end) of data, A-Z taken as a-z."""
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[_TO_LOWER[data]] * power[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
