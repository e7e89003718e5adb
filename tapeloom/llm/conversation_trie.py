"""Trie of conversation prefixes by truncation peeling.

A node is a distinct sequence of first turns; its members are the conversations that begin with it. The trie is taken
apart from its deepest level up: at each depth the conversations that end there join what survives from below, equal
prefixes become one node, which is aggregated at once, and the last turn is stripped, so that the node counts for its
parent. Nodes are found and summed up in the same pass.

A prefix is named by a chain of digests, so equal names are equal prefixes. Conversations are cut in segments of a fixed
number of turns, and segments are peeled one after the other from the last; what survives a segment enters the one
before as one row per node. Inside a segment the rows, one for each different conversation that ends there and for each
survivor, are dealt out by ranges in the order of their prefixes. A node is then inside one task, but for those on the
two edges of a range: their parts, at most two for each level and task, are left open and peeled together once more. So a
first turn that a third of all conversations share is spread over tasks like any other, copies are counted before they
are dealt out, and a long conversation is a row for each segment.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.llm.common import discard, written

#: Turns of a segment.
SEGMENT = 1024
#: Turns that are meant to be peeled in one task.
TASK_TURNS = 1 << 18
#: The name of the root, and bytes of all other names.
ROOT, WIDTH = b"", 16
#: Bytes of a name that order rows.
_ORDER = 2
_FAR = np.iinfo(np.int64).max
#: Turn numbers of one part of a conversation when turns are numbered.
_SPAN = 1024
#: Values of conv_id whose endings are joined to one text.
_IDS = 1 << 15

_NODE = "part string, node binary, parent binary, conv_id long, depth long, chars long, n_convs long, n_children long, n_leaves long, saved long, parent_conv_id long"
_SCHEMA = pa.schema([("part", pa.string()), ("node", pa.binary()), ("parent", pa.binary()), *((x, pa.int64()) for x in ("conv_id", "depth", "chars", "n_convs", "n_children", "n_leaves", "saved", "parent_conv_id"))])


def ordered(turns: DataFrame) -> DataFrame:
    """conv_id, depth (from 1), turn_digest and chars (code points of the text) of every turn, in the order of turn, null first.

    Turns are numbered inside parts of a conversation, and the parts' counts are carried on, so that no task numbers a whole
    conversation. Turns with one number follow in the order of their digests; rows without a conv_id belong to no
    conversation and are left out; a null role or text is an empty one.
    """
    role, text = (F.coalesce(F.col(x), F.lit("")) for x in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = turns.filter("conv_id is not null").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), digest.alias("turn_digest"), F.length(text).cast("long").alias("chars"))
    rows = rows.withColumn("span", F.floor(F.col("turn") / _SPAN))
    counts = rows.groupBy("conv_id", "span").agg(F.count("*").alias("n"))
    begins = counts.select("conv_id", F.col("span").alias("own"), (F.sum("n").over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("span")).rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("begin"))
    inside = rows.withColumn("nth", F.row_number().over(Window.partitionBy("conv_id", "span").orderBy(F.asc_nulls_first("turn"), "turn_digest")))
    begins = begins.filter("begin > 0").withColumnRenamed("conv_id", "conv")
    placed = inside.join(begins, (F.col("conv_id") == F.col("conv")) & F.col("span").eqNullSafe(F.col("own")), "left")
    return placed.select("conv_id", (F.coalesce("begin", F.lit(0)) + F.col("nth")).alias("depth"), "turn_digest", "chars")


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The names of a segment's prefixes, as a chain from its start."""
    for batch in batches:
        names, order, chars = [], [], []
        for turns, start in zip(batch.column("turns").to_pylist(), batch.column("start").to_pylist(), strict=True):
            name, own = b"", []
            for t in turns:
                name = hashlib.md5(name + t["turn_digest"]).digest()
                own.append(name if not start else hashlib.md5(start + name).digest())
            names.append(b"".join(own))
            order.append(b"".join(x[:_ORDER] for x in own))
            chars.append(np.array([t["chars"] for t in turns], dtype=np.int64).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("segment"), batch.column("start"), *(pa.array(x, pa.binary()) for x in (names, order, chars))], ["conv_id", "segment", "start", "names", "order", "chars"])


_CHAINS = "conv_id long, segment long, start binary, names binary, order binary, chars binary"


def _starts(table: pa.Table) -> pa.Table:
    """The name with which each segment of a conversation but the first begins, from the names of the segments on their own."""
    rows = sorted(zip(table.column("segment").to_pylist(), table.column("last").to_pylist(), strict=True))
    start, out = ROOT, []
    for segment, last in rows:
        out.append((segment, start))
        start = last if not start else hashlib.md5(start + last).digest()
    return pa.table({"conv_id": pa.array([table.column("conv_id")[0].as_py()] * (len(out) - 1), pa.int64()), "segment": pa.array([s for s, _ in out[1:]], pa.int64()), "start": pa.array([x for _, x in out[1:]], pa.binary())})


def _peel(names: np.ndarray, parents: np.ndarray, level: np.ndarray, chars: np.ndarray, at: dict[str, np.ndarray], open_: np.ndarray):
    """Nodes of entries (name, parent, level, chars, what counts for the node so far); entries may repeat a name.

    From the deepest level up, every node that is not open is finished and counts for its parent, if that is among the entries.
    Returns the entry that stands for each node, the place of its parent (or -1) and the finished sums.
    """
    both = np.concatenate([names, parents])
    by = np.lexsort((both[:, 1], both[:, 0]))
    new = np.r_[True, (both[by][1:] != both[by][:-1]).any(axis=1)]
    code = np.empty(len(both), dtype=np.int64)
    code[by] = np.cumsum(new) - 1
    own, above = code[: len(names)], code[len(names) :]
    used, entry, node = np.unique(own, return_index=True, return_inverse=True)
    place = np.full(int(code.max()) + 1, -1)
    place[used] = np.arange(len(used))
    parent, level, chars = place[above[entry]], level[entry], chars[entry]
    closed = np.ones(len(used), dtype=bool)
    closed[node[open_]] = False
    n, children, leaves, saved, least = (np.zeros(len(used), dtype=np.int64) for _ in range(5))
    least += _FAR
    for out, key in ((n, "n_convs"), (children, "n_children"), (leaves, "n_leaves"), (saved, "saved")):
        np.add.at(out, node, at[key])
    np.minimum.at(least, node, at["conv_id"])
    deepest_first = np.argsort(-level, kind="stable")
    for those in np.split(deepest_first, np.flatnonzero(np.diff(level[deepest_first])) + 1):
        those = those[closed[those]]
        leaves[those] += children[those] == 0
        saved[those] += (n[those] - 1) * chars[those]
        inner = those[parent[those] >= 0]
        up = parent[inner]
        np.add.at(n, up, n[inner])
        np.add.at(children, up, 1)
        np.add.at(leaves, up, leaves[inner])
        np.add.at(saved, up, saved[inner])
        np.minimum.at(least, up, least[inner])
    return entry, parent, closed, {"conv_id": least, "n_convs": n, "n_children": children, "n_leaves": leaves, "saved": saved}


def _told(raw_names, raw_parents, entry, parent, closed, sums, level, chars, first_depth) -> Iterator[pa.RecordBatch]:
    """Rows of finished nodes, of open ones, and of what counts for the node in front of the segment."""
    top, known = parent < 0, np.where((parent >= 0) & closed[parent], parent, -1)
    for part, those in (("node", np.flatnonzero(closed)), ("open", np.flatnonzero(~closed)), ("up", np.flatnonzero(closed & top))):
        for k in range(0, len(those), 50_000):
            i = those[k : k + 50_000]
            e, up = entry[i].tolist(), part == "up"
            one = np.ones(len(i), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(i)),
                    pa.array([raw_parents(x) if up else raw_names(x) for x in e], pa.binary()),
                    pa.array([None if up else raw_parents(x) for x in e], pa.binary()),
                    *(pa.array(x) for x in (sums["conv_id"][i], first_depth + level[entry[i]] - up, chars[entry[i]], sums["n_convs"][i], one if up else sums["n_children"][i], sums["n_leaves"][i], sums["saved"][i])),
                    pa.array(np.where(known[i] >= 0, sums["conv_id"][known[i]], 0), mask=(known[i] < 0) | (not len(known))),
                ],
                schema=_SCHEMA,
            )


_SUMS = ("conv_id", "n_convs", "n_children", "n_leaves", "saved")


def _halves(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.uint64).reshape(-1, 2)


def _padded(name: bytes) -> bytes:
    """The root's name is as long as others here; no digest is all zeros."""
    return name or b"\0" * WIDTH


def _peel_rows(first_depth: int):
    """Peel one range of rows (order, start, names, chars and sums): what lies inside is finished, its edges stay open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        rows = pa.Table.from_batches(batches)
        paths = rows.column("names").to_pylist()
        starts = [_padded(x) for x in rows.column("start").to_pylist()]
        length = np.array([len(x) // WIDTH for x in paths], dtype=np.int64)
        ends = np.cumsum(length)
        total = b"".join(paths)
        above = b"".join(s + p[:-WIDTH] for s, p in zip(starts, paths, strict=True))
        level = np.arange(ends[-1]) - np.repeat(ends - length, length) + 1
        chars = np.frombuffer(b"".join(rows.column("chars").to_pylist()), dtype=np.int64)
        sums = {k: np.zeros(ends[-1], dtype=np.int64) for k in _SUMS}
        sums["conv_id"] += _FAR
        for k in _SUMS:
            sums[k][ends - 1] = rows.column(k).to_numpy()
        # What a row shares with the first and the last of the range.
        order = rows.column("order").to_pylist()
        low, high = min(order), max(order)
        shared = np.array([max(_shared(x, low), _shared(x, high)) for x in order], dtype=np.int64)
        open_ = level <= np.repeat(shared, length)
        entry, parent, closed, found = _peel(_halves(total), _halves(above), level, chars, sums, open_)
        back = lambda raw: lambda x: raw[x * WIDTH : (x + 1) * WIDTH]
        yield from _told(back(total), back(above), entry, parent, closed, found, level, chars, first_depth)

    return run


def _shared(a: bytes, b: bytes) -> int:
    """Levels on which two orders agree."""
    if a == b:
        return len(a) // _ORDER
    n = min(len(a), len(b)) // _ORDER * _ORDER
    for i in range(0, n, _ORDER):
        if a[i : i + _ORDER] != b[i : i + _ORDER]:
            return i // _ORDER
    return n // _ORDER


def _peel_open(first_depth: int):
    """Peel the open parts of all ranges of a segment, at most two for each level and range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        rows = pa.Table.from_batches(batches)
        names, parents = rows.column("node").to_pylist(), rows.column("parent").to_pylist()
        level, chars = rows.column("depth").to_numpy() - first_depth, rows.column("chars").to_numpy()
        entry, parent, closed, found = _peel(_halves(b"".join(names)), _halves(b"".join(parents)), level, chars, {k: rows.column(k).to_numpy() for k in _SUMS}, np.zeros(len(names), dtype=bool))
        yield from _told(names.__getitem__, parents.__getitem__, entry, parent, closed, found, level, chars, first_depth)

    return run


def _is_root(c: Column) -> Column:
    return c == F.lit(b"\0" * WIDTH)


def prefix_trie(turns: DataFrame, members: DataFrame | None = None, segment: int = SEGMENT, task_turns: int = TASK_TURNS) -> tuple[DataFrame, DataFrame]:
    """(nodes, endings) of the trie of conversations.

    turns is what ordered() returns: conv_id, depth, turn_digest and chars, a row for every depth from 1 of a conversation;
    members (conv_id) names conversations that count even if they have no turn. nodes has node and parent (names,
    binary), conv_id (the least member), depth, parent_conv_id, n_convs, n_children, n_leaves and saved_tokens (over the
    subtree, every node's code points of its last text times its members but one); the root has no name, parent or text.
    endings has node and conv_id: where each conversation ends. A node's last turn is turn `depth` of conversation conv_id.

    Defined results: without conversations there is no node; a conversation without turns ends at the root; repeated
    conversations end at one node. Nothing but the root's sums and the number of segments and turns reaches the driver.
    """
    spark = turns.sparkSession
    cut = turns.withColumn("segment", F.floor((F.col("depth") - 1) / segment)).groupBy("conv_id", "segment").agg(F.array_sort(F.collect_list(F.struct("depth", "turn_digest", "chars"))).alias("turns"))
    first = written(cut.withColumn("start", F.lit(ROOT)).mapInArrow(_chains, _CHAINS), "chains")
    last_segment, n_turns = first.agg(F.max("segment"), F.sum(F.length("names") / WIDTH)).first()
    if last_segment:
        lasts = first.withColumn("last", F.substring("names", -WIDTH, WIDTH)).select("conv_id", "segment", "last")
        several = lasts.join(lasts.filter("segment = 1").select("conv_id"), "conv_id", "left_semi")
        starts = several.groupBy("conv_id").applyInArrow(_starts, "conv_id long, segment long, start binary")
        # Names behind a start are hashed with it once more.
        own = first.filter("segment > 0").drop("start").join(starts, ["conv_id", "segment"])
        paths = written(first.filter("segment = 0").unionByName(own.select("conv_id", "segment", "start", "names", "order", "chars").mapInArrow(_behind, _CHAINS)), "paths")
        discard(first)
    else:
        paths = first
    ending = paths.groupBy("conv_id").agg(F.max_by(F.substring("names", -WIDTH, WIDTH), "segment").alias("node"), F.max("segment").alias("segment"))
    if members is not None:
        ids = members.filter("conv_id is not null").select(F.col("conv_id").cast("long")).distinct()
        ending = ids.join(ending, "conv_id", "left")
    endings = written(ending.select("conv_id", F.coalesce("node", F.lit(b"\0" * WIDTH)).alias("node"), "segment"), "endings")
    ended = endings.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.min("segment").alias("segment"), F.count("*").alias("n_convs"), *(F.lit(0).cast("long").alias(x) for x in ("n_children", "n_leaves", "saved")))

    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(n_turns or 0) // task_turns))
    survivors, parts, tables = None, [], []
    for s in range(-1 if last_segment is None else last_segment, -1, -1):
        items = ended.filter(F.col("segment") == s).select(*_SUMS)
        items = items.unionByName(survivors.select(*_SUMS)) if survivors is not None else items
        rows = items.join(paths.filter(F.col("segment") == s).select("conv_id", "start", "names", "order", "chars"), "conv_id")
        peeled = written(rows.repartitionByRange(tasks, "order").mapInArrow(_peel_rows(s * segment), _NODE), "peeled")
        rest = written(peeled.filter("part = 'open'").repartition(1).mapInArrow(_peel_open(s * segment), _NODE), "rest")
        both = peeled.unionByName(rest)
        parts.append((peeled.filter("part = 'node'"), rest.filter("part = 'node'")))
        tables += [peeled, rest]
        up = both.filter("part = 'up'").groupBy("node").agg(F.min("conv_id").alias("conv_id"), *(F.sum(x).alias(x) for x in _SUMS[1:]))
        survivors = up if not s else written(up, "survivors")

    # The root: what comes up from the first segment, and conversations without turns.
    bare = ended.filter(_is_root(F.col("node")))
    whole = (bare if survivors is None else bare.unionByName(survivors, allowMissingColumns=True)).agg(F.min("conv_id"), *(F.sum(x) for x in _SUMS[1:])).first()
    columns = "node binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
    if whole[0] is None:
        return spark.createDataFrame([], columns), endings.select("node", "conv_id")
    root = spark.createDataFrame([(b"\0" * WIDTH, None, whole[0], 0, None, whole[1], whole[2], whole[3] or 1, whole[4])], columns)
    if not parts:
        return root, endings.select("node", "conv_id")
    rest = reduce(DataFrame.unionByName, [b for _, b in parts])
    inner = reduce(DataFrame.unionByName, [a for a, _ in parts])
    # Parents that another task finished: those of the second pass, and nodes in front of a later segment.
    fronts = rest if not last_segment else rest.unionByName(inner.filter(F.col("depth") % segment == 0))
    fronts = fronts.select(F.col("node").alias("front"), F.col("conv_id").alias("front_conv"))
    every = inner.unionByName(rest).withColumnRenamed("saved", "saved_tokens")
    open_ = F.col("parent_conv_id").isNull()
    at_top = every.filter(open_ & _is_root(F.col("parent"))).withColumn("parent_conv_id", F.lit(whole[0]).cast("long"))
    others = every.filter(open_ & ~_is_root(F.col("parent"))).join(fronts, F.col("parent") == F.col("front")).withColumn("parent_conv_id", F.col("front_conv"))
    names = root.columns
    nodes = root.select(names)
    for x in (every.filter(~open_), at_top, others):
        nodes = nodes.unionByName(x.select(names))
    return nodes, endings.select("node", "conv_id")


def _behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names of a segment on its own, told apart by what stands before it."""
    for batch in batches:
        names, order = [], []
        for raw, start in zip(batch.column("names").to_pylist(), batch.column("start").to_pylist(), strict=True):
            own = [hashlib.md5(start + raw[i : i + WIDTH]).digest() for i in range(0, len(raw), WIDTH)]
            names.append(b"".join(own))
            order.append(b"".join(x[:_ORDER] for x in own))
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("segment"), batch.column("start"), pa.array(names, pa.binary()), pa.array(order, pa.binary()), batch.column("chars")], ["conv_id", "segment", "start", "names", "order", "chars"])


def ends_sha256(endings: DataFrame) -> DataFrame:
    """node and ends_sha256, the SHA-256 of the comma-joined ids of the conversations that end there, in rising order.

    Ids are joined by ranges of their values, at most _IDS to a row; a node's rows then pass by in order, one at a time.
    """
    at = F.floor(F.col("conv_id") / _IDS).alias("range")
    joined = endings.groupBy("node", at).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for name, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if name != node:
                    out += [(node, state.hexdigest())] if state else []
                    node, state = name, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.binary()), pa.array([x for _, x in out])], ["node", "ends_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    return joined.repartition("node").sortWithinPartitions("node", "range").mapInArrow(run, "node binary, ends_sha256 string")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, members): every conversation c begins with the first h turns of conversation c - c % 100, then its own after its first h; h is crc32(c) % 6.

    turns is what ordered() returns. Members are all conversations, also those left without a turn.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    donor = F.col("conv_id") - F.col("conv_id") % 100
    heads = turns.filter((F.col("conv_id") % 100 == 0) & (F.col("depth") <= 5)).groupBy(F.col("conv_id").alias("donor")).agg(F.array_sort(F.collect_list(F.struct("depth", "turn_digest", "chars"))).alias("head"))
    convs = turns.select("conv_id").distinct().select("conv_id", h.alias("h"), donor.alias("donor")).join(heads, "donor", "left")
    convs = convs.select("conv_id", "h", F.when(F.col("head").isNotNull() & (F.col("h") > 0), F.slice("head", 1, F.col("h"))).otherwise(F.array().cast("array<struct<depth:bigint,turn_digest:binary,chars:bigint>>")).alias("head"))
    convs = written(convs, "heads")
    given = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.depth", "t.turn_digest", "t.chars")
    own = turns.filter(F.col("depth") > h).join(convs.select("conv_id", (F.size("head") - F.col("h")).alias("shift")), "conv_id").select("conv_id", (F.col("depth") + F.col("shift")).alias("depth"), "turn_digest", "chars")
    return given.unionByName(own), convs.select("conv_id")
