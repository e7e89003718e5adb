"""Near duplicates, decontamination, packing, token counts, toxicity and the pipeline, against brute force."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tapeloom.llm import components, decontamination, near_dedup, packing, token_counts, toxicity


def prose(rng, n):
    return " ".join(rng.choice(["tir", "onea", "wath", "shor", "ble", "ting", "enre", "atio"]) + rng.choice(["da", "mi", "qu", "xo", "re"]) + str(rng.randrange(30)) for _ in range(n))


def changed(rng, text, share):
    return " ".join("z" + str(rng.randrange(999)) if rng.random() < share else w for w in text.split(" "))


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def brute_components(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("limit", [3, 48])
def test_near_duplicates(spark, limit):
    rng = random.Random(4)
    header = prose(rng, 30)
    rows = []
    for g in range(12):
        base = prose(rng, rng.choice([3, 5, 8, 40, 120]))
        rows += [changed(rng, base, rng.choice([0, 0.01, 0.03, 0.06])) for _ in range(rng.choice([1, 2, 9]))]
    rows += [header + " " + prose(rng, rng.choice([4, 40])) for _ in range(30)]
    rows += ["", None, " ", "one", "ONE", "one two three", "one  two\nthree", "é ü", "É ü"]
    rows = list(enumerate(rows))
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, digest string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df, width=4, percent=80, list_limit=limit).collect()}
    want = {i: (n, c, i == c) for i, (n, c) in brute_components(rows, 4, 80).items()}
    assert got == want


def test_large_groups_in_many_blocks(spark):
    """Groups over many blocks, some of whose members reach the others only through one that is no leader."""
    rng = random.Random(11)
    rows, base = [], prose(rng, 120)
    for _ in range(90):
        rows.append(changed(rng, base, rng.choice([0, 0.01, 0.02])))
    other = " ".join(base.split(" ")[:60]) + " " + prose(rng, 60)  # shares half of the first group's values
    rows += [changed(rng, other, 0.01) for _ in range(40)]
    step = base.split(" ")
    for i in range(12):  # a chain away from the group
        step = [*step[:100], *prose(rng, 3).split(" "), *step[100 + 3 :]] if i % 2 else [*prose(rng, 3).split(" "), *step[3:]]
        rows.append(" ".join(step))
    rows = list(enumerate(rows + [prose(rng, 120) for _ in range(40)] + [None] * 30))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df, width=4, percent=80, list_limit=8, hot_lists=None, block_shingles=3000).collect()}
    assert got == brute_components(rows, 4, 80)


def test_text_over_a_chunk(spark):
    """Texts longer than what one pass hashes, among short ones."""
    rng = random.Random(12)
    long = " ".join(str(rng.randrange(10**6)) for _ in range(90_000))
    rows = [(1, long), (2, "short text of five words"), (3, long + " and a little more"), (4, "short text of five words"), (5, long[: len(long) // 2])]
    assert len(long) > near_dedup.chunks.__globals__["CHUNK_BYTES"]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=4).collect()}
    assert got == brute_components(rows, 4, 80)


def test_near_duplicates_odd_rows(spark):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(None, None, True), (None, None, True), (1, 1, True), (1, 1, True), (2, 1, False)], key=repr)
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0


def test_components_on_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (5, 5), (None, 3)], "a long, b long")
    got = {r.vertex: r.root for r in components.components(links).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100}
    assert components.components(links.limit(0)).count() == 0


def edit_distance(item, text):
    """Least edits between item and any part of text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_bit_parallel_distance_is_exact():
    rng = random.Random(9)
    for _ in range(60):
        item = "".join(rng.choice("abcé ") for _ in range(rng.randrange(1, 90)))
        text = "".join(rng.choice("abcé ") for _ in range(rng.randrange(0, 120)))
        want = edit_distance(item, text)
        got = decontamination.edit_distance_within(item, text, len(item))
        assert got[0] == want and decontamination.edit_distance_within(item, text, want - 1) is None


def typos(rng, text, share):
    out = []
    for c in text:
        x = rng.random()
        out.append("" if x < share / 3 else rng.choice("abcdefgh") if x < 2 * share / 3 else c + rng.choice("abcdefgh") if x < share else c)
    return "".join(out)


def test_decontamination_recall_and_precision(spark):
    rng = random.Random(2)
    items = [(i, prose(rng, 30)) for i in range(40)]
    texts, truth = [], set()
    for d in range(240):
        body = prose(rng, 60)
        if d % 2 == 0:
            i, t = items[d % 40]
            body = prose(rng, 20) + "\n" + typos(rng, t.upper(), (0, 0.03, 0.08, 0.12)[d // 2 % 4]) + " " + prose(rng, 20)
        texts.append((d, body))
    for d, t in texts:
        for i, item in items:
            if edit_distance(decontamination.fold(item), decontamination.fold(t)) <= int(0.2 * len(item)) if d % 2 == 0 and i == d % 40 else False:
                truth.add((d, i))
    docs = spark.createDataFrame([*texts, (900, None), (901, ""), (None, items[0][1]), (902, "word " * 6000 + items[1][1])], "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame([*items, (77, None), (78, " ")], "item_id long, text string").withColumn("doc_id", F.lit(0))
    got = decontamination.contaminations(docs, bench).collect()
    found = {(r.doc_id, r.item_id) for r in got if r.doc_id is not None and r.doc_id < 900}
    assert len(found & truth) >= 0.95 * len(truth) and not {d for d, _ in found if d % 2}
    assert (902, 1) in {(r.doc_id, r.item_id) for r in got} and (None, 0) in {(r.doc_id, r.item_id) for r in got}
    by_id = dict(items)
    whole = dict(texts)
    for r in got:
        if r.doc_id in whole:
            part = decontamination.fold(whole[r.doc_id])[r.start : r.end]
            assert edit_distance(decontamination.fold(by_id[r.item_id]), part) == r.n_edits
    kept = decontamination.decontaminated(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in texts} - {d for d, _ in found} | {900, 901}
    assert decontamination.contaminations(docs, bench.limit(0)).count() == 0 and decontamination.contaminations(docs.limit(0), bench).count() == 0
    split = decontamination.contaminations(docs, bench, block_bytes=2000)
    assert sorted(map(repr, split.collect())) == sorted(map(repr, got))


def test_tables_follow_the_target_recall(spark):
    """Recall at all edit rates against exact distances of every document and item, for the tables that the target asks for."""
    rng = random.Random(3)
    items = [(i, prose(rng, rng.choice([10, 16, 25]))) for i in range(20)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    few, many = (decontamination.walks_for(bench, target_recall=t) for t in (0.2, 0.97))
    assert all(a.tables <= b.tables for a, b in zip(few, many, strict=True)) and sum(w.tables for w in few) < sum(w.tables for w in many)
    texts = [prose(rng, 8) + " " + decontamination._edited(np.random.default_rng(d), items[d % 20][1], (0, 0.05, 0.1, 0.15, 0.2)[d // 20 % 5]) + " " + prose(rng, 8) for d in range(100)]
    truth = {(d, i) for d, t in enumerate(texts) for i, item in items if edit_distance(decontamination.fold(item), decontamination.fold(t)) <= int(0.2 * len(item))}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminations(docs, bench, walks=many).collect()}
    assert found <= truth and len(found) >= 0.95 * len(truth)
    default = {(r.doc_id, r.item_id) for r in decontamination.contaminations(docs, bench).collect()}
    assert len(default) >= 0.9 * len(truth)


def test_short_items_are_found_exactly(spark):
    rng = random.Random(4)
    alphabet = "abcdefghijklmnopqrst é"
    items = [(n * 10 + k, ("q" + "".join(rng.choice(alphabet) for _ in range(n - 2)) + "z")) for n in (5, 6, 8, 10, 12, 14, 16, 18, 20, 22, 25, 30, 40, 43) for k in range(3)]
    items += [(900, "tiny"), (901, " " * 70 + "hi")]
    texts = []
    for _, t in items:
        texts += [t, "so " + t.upper() + " it", prose(rng, 9) + "\n" + typos(rng, t, 0.1) + " " + prose(rng, 9), "x" + typos(rng, t, 0.2)]
    texts += [t[: len(t) // 2] for _, t in items] + ["", None, "漢字" * 90 + items[20][1]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    bench = spark.createDataFrame([*items, (902, "\n"), (903, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontamination.contaminations(docs, bench).collect()}
    want = {}
    for d, t in enumerate(texts):
        for i, item in items:
            n = edit_distance(decontamination.fold(item), decontamination.fold(t))
            if n <= int(0.2 * len(item)) and t:
                want[d, i] = n
    assert {k: r.n_edits for k, r in got.items()} == want and all((4 * k + j, i) in want for k, (i, _) in enumerate(items) for j in (0, 1))
    for (d, i), r in got.items():
        assert edit_distance_whole(decontamination.fold(dict(items)[i]), decontamination.fold(texts[d])[r.start : r.end]) == r.n_edits
    assert {r.doc_id for r in decontamination.decontaminated(docs, bench).collect()} == set(range(len(texts))) - {d for d, _ in want}


def test_items_in_scripts_without_spaces_and_inside_words(spark):
    """Exact items are found between other letters of their script, glued to other text and behind a sign; edited ones with the target recall."""
    rng = random.Random(12)
    scripts = {"漢": [chr(c) for c in range(0x4E00, 0x5200)], "ก": [chr(c) for c in range(0x0E01, 0x0E2F)], "a": list("abcdefghijklmnopqrstuvwxyz0123456789")}
    word = lambda k, n: "".join(rng.choice(scripts[k]) for _ in range(n))
    items = [(100 * g + j, word(k, n)) for g, (k, n) in enumerate(itertools.product(scripts, (44, 60, 100, 200))) for j in range(12)]
    items += [(5000 + j, word("a", 20) + " " + word("a", 30)) for j in range(12)]  # the inner word start is near the end
    exact, edited = [], []
    for i, t in items:
        k = "a" if t[0].isascii() else "ก" if t[0] < "\u0fff" else "漢"
        exact += [(i, word(k, 70) + t + word(k, 50)), (i, "pre/" + t.upper() + "."), (i, word(k, 7) + t)]
        edited.append((i, word(k, 30) + decontamination._edited(np.random.default_rng(i), t, 0.1) + word(k, 30)))
    texts = exact + edited + [(None, word(k, 4000)) for k in scripts]
    docs = spark.createDataFrame([(d, t) for d, (_, t) in enumerate(texts)], "doc_id long, text string").repartition(3)
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminations(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert {(d, i) for d, (i, _) in enumerate(exact)} <= found
    near = {(d, i) for d, (i, _) in enumerate(edited, len(exact))}
    assert len(near & found) >= 0.9 * len(near)
    assert {i for d, i in found if texts[d][0] is None} == set()


def test_every_class_of_lengths_meets_the_target():
    """Items edited in 20 % of their places, by length from the shortest that has walks."""
    rng = random.Random(13)
    sized = lambda n: (prose(rng, n // 5 + 2))[:n]
    items = [(k, sized(n)) for k, n in enumerate(n for n in (44, 50, 60, 79, 80, 100, 120, 149, 150, 200, 300) for _ in range(25))]
    found = decontamination.recall_by_class(items, 0.2, 0.9)  # the least of the bands of a class
    assert [w.least for w, _ in found] == [44, 80, 150] and all(recall >= 0.9 for _, recall in found)
    walks = tuple(w for w, _ in found)
    for n in (44, 60, 80, 120, 160, 300):
        own = [(i, sized(n)) for i in range(60)]
        assert decontamination.measured_recall(own, walks, 0.2, 0.2) >= 0.85  # 120 copies of each length, which the tables were not chosen for


def test_anchors_agree_inside_any_text():
    rng = random.Random(14)
    for alphabet in ("abcdefgh", "漢字仮名交じり文", "aé漢"):
        text = "".join(rng.choice(alphabet) for _ in range(80))
        own = decontamination.anchors(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
        before = "".join(rng.choice(alphabet) for _ in range(37))
        raw = (before + text + before).encode()
        there = decontamination.anchors(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])) - len(before.encode())
        inside = own[(own > 0) & (own < len(text.encode()) - 40)]
        assert len(inside) > 3 and set(inside.tolist()) <= set(there.tolist())
    assert decontamination.anchors(np.zeros(0, np.uint8), np.array([0, 0])).tolist() == []


def edit_distance_whole(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return row[-1]


def test_best_boundaries_against_all_choices():
    rng = np.random.default_rng(1)
    for k in (1, 2, 3, 9):
        lengths = np.sort(rng.choice(np.arange(1, 40), 7, replace=False))
        counts = rng.integers(1, 9, 7)
        pad = lambda b: sum(c * (min(x for x in b if x >= n) - n) for n, c in zip(lengths, counts))
        best = min(pad((*c, lengths[-1])) for c in itertools.combinations(lengths[:-1].tolist(), min(k, 7) - 1))
        got = packing.best_boundaries(lengths, counts, k)
        assert got[-1] == lengths[-1] and len(got) <= k and pad(got) == best
    assert packing.best_boundaries(np.array([]), np.array([]), 3) == []


def test_best_boundaries_of_many_lengths():
    rng = np.random.default_rng(2)
    lengths, counts = np.sort(rng.choice(np.arange(1, 3000), 150, replace=False)), rng.integers(1, 99, 150)
    pad = lambda b: sum(c * (min(x for x in b if x >= n) - n) for n, c in zip(lengths, counts))
    cost = np.full(151, np.inf)
    cost[0] = 0
    for _ in range(6):  # all cuts of every layer
        cost = np.array([np.inf] + [min(cost[i] + sum(counts[i:j] * (lengths[j - 1] - lengths[i:j])) for i in range(j)) for j in range(1, 151)])
    assert pad(packing.best_boundaries(lengths, counts, 6)) == cost[150]


def test_packing_places_every_piece(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([0, 1, 5, 17, 100, 3000])) for i in range(500)] + [(None, 4), (3, 4), (3, 4), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, n long").withColumn("batch", F.lit("clash"))
    out = packing.pack(df, F.col("n"), budget=2048, max_length=1024, buckets=4).collect()
    want = Counter()
    for i, n in rows:
        for start in range(0, max(n or 0, 1), 1024):
            want[i, start, min((n or 0) - start, 1024)] += 1
    assert Counter((r.doc_id, r.start, r.n_tokens) for r in out) == want
    seats = {}
    for r in out:
        assert r.n_tokens <= r.bucket_length
        seats.setdefault((r.bucket_length, r.batch), []).append(r.place)
    last = {b: max(k for x, k in seats if x == b) for b, _ in seats}
    for (b, k), places in seats.items():
        size = max(1, 2048 // max(b, 1))
        assert sorted(places) == list(range(len(places))) and len(places) <= size and (len(places) == size or k == last[b])
    assert packing.pack(df.limit(0), F.col("n")).count() == 0
    assert {r.piece for r in packing.pack(df, F.col("n")).collect()} == {0}  # nothing is longer than a batch


def test_word_count(spark):
    df = spark.createDataFrame([("a  b\tc\n",), ("",), (None,), ("é x y",)], "text string")
    assert [r[0] for r in df.select(packing.word_count(F.col("text"))).collect()] == [3, 0, 0, 2]


def best_by_force(token, costs):
    """(cost, pieces, pieces used) of the best segmentation, over all of them."""
    ways = [(0.0, 0, [])]
    for j in range(1, len(token) + 1):
        raw = len(token[j - 1].encode())
        own = [(ways[j - 1][0] + token_counts.BYTE_COST * raw, ways[j - 1][1] + raw, ways[j - 1][2])]
        own += [(ways[i][0] + costs[token[i:j]], ways[i][1] + 1, [*ways[i][2], token[i:j]]) for i in range(j - 1, -1, -1) if token[i:j] in costs]
        ways.append(min(own, key=lambda x: x[:2]))
    return ways[-1]


@pytest.mark.parametrize("head", [3, 200_000])
def test_token_counts(spark, head):
    pieces = ["▁", "a", "b", "ab", "aba", "▁ab", "bb", "é", ",", "▁,", "abab", "ba"]
    rng = random.Random(6)
    texts = ["".join(rng.choice("abéz, ,12_\n") for _ in range(rng.randrange(0, 60))) for _ in range(200)] + [None, "", " \n", "ab" * 3000]
    cut = [[p for w in (t or "").split() for p in token_counts.pretokens(w)] for t in texts]
    costs = token_counts.piece_costs(pieces)
    for _ in range(2):
        used = Counter()
        for token, n in Counter(x for c in cut for x in c).items():
            for piece in best_by_force(token, costs)[2]:
                used[piece] += n
        total = sum(used.values()) + 0.5 * len(pieces)
        costs = {p: np.log(total) - np.log(used[p] + 0.5) for p in costs}
    df = spark.createDataFrame([(i if i % 50 else None, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int").coalesce(1)
    got = [(r.n_words, r.n_tokens) for r in token_counts.token_counts(df, pieces, head=head).collect()]
    assert got == [(len((t or "").split()), sum(best_by_force(p, costs)[1] for p in c)) for t, c in zip(texts, cut)]
    assert token_counts.token_counts(df.limit(0), pieces).count() == 0


def test_pretokens():
    assert token_counts.pretokens("ab,c_1") == ["▁ab", ",", "c", "_", "1"]


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(8)
    bad = ["idiot", "moron", "loser", "scumbag", "worthless"]
    rows, labels = [], []
    for i in range(900):
        words = [prose(rng, 1).rstrip("0123456789") for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            for w in rng.sample(bad, 2):
                words.insert(rng.randrange(40), w)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    obscured = [(2000, "you " + prose(rng, 9) + " 1d10t m0r0n"), (2001, prose(rng, 9) + " i d i o t and l.o.s.e.r " + prose(rng, 5)), (2002, prose(rng, 9) + " idiooooot moroooon " + prose(rng, 5))]
    odd = [(3000, None), (3001, ""), (3002, "  "), (None, prose(rng, 10)), (1, rows[1][1])]
    docs = spark.createDataFrame(rows + obscured + odd, "doc_id long, text string").withColumn("score", F.lit("clash"))
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity(spark, labelled):
    docs, labels = labelled
    scorer = toxicity.train(docs, labels)
    out = toxicity.scored(docs, scorer).collect()
    assert len(out) == docs.count()
    held = [(r.predicted, int(r.doc_id % 5 == 0)) for r in out if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert len(held) > 150 and sum(a == b for a, b in held) >= 0.97 * len(held)
    score = {r.doc_id: r for r in out}
    assert all(score[i].predicted == 1 for i in (2000, 2001, 2002)) and all(score[i].predicted == 0 for i in (3000, 3001, 3002))
    assert not score[None].held_out
    long = "word " * 200_000 + "idiot moron"
    assert toxicity.scored(spark.createDataFrame([(1, long)], "doc_id long, text string"), scorer).first().score == scorer.score(long)
    # Decoded once for the table or in each task: the same scores.
    assert all(r.score == scorer.score(t) for r, t in zip(sorted(out, key=repr), (t for _, t in sorted(((r, x.text) for r, x in zip(out, docs.collect(), strict=True)), key=repr)), strict=True))
    assert toxicity.with_lexicon(docs, scorer, most_bytes=1).lexicon is None
    kept = toxicity.without_toxic(docs, scorer)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in out)
    none = toxicity.train(docs, labels.filter("toxic = 0"))
    assert {r.predicted for r in toxicity.scored(docs.limit(9), none).collect()} == {0}
    assert toxicity.scored(docs.limit(0), scorer).count() == 0


def test_restore_reads_what_was_meant(labelled):
    model = toxicity.language_model(labelled[0])
    assert toxicity.readings("id*ot", model) == ["idiot"] and toxicity.readings("w*rd***", model) != []
    assert toxicity.readings("іdіоt", model) == ["idiot"] and toxicity.readings("идиот", model) == ["идиот"]  # mixed scripts only
    assert toxicity.readings("1d10t!!", model) == ["idiot"] and toxicity.readings("MoooRON", model) == ["moron"]
    # Without anything to decode, the only path is the text.
    assert toxicity.restore("wath", model) == "wath" and all(len(o) == 1 for o in toxicity.lattice("wath"))


def test_doubled_letters_gaps_and_signs_are_decoded(labelled):
    docs, labels = labelled
    scorer = toxicity.train(docs, labels)
    model = scorer.model
    for token, word in (("iddiot", "idiot"), ("id-iot", "idiot"), ("mor_on", "moron"), ("scum.bag", "scumbag"), ("lloser", "loser")):
        assert word in toxicity.readings(token, model), token
    for text, word in (("i d ! o t", "idiot"), ("you m 0 r 0 n", "moron"), ("! d ! o t", "idiot"), ("$-c-u-m-b-@-g", "scumbag"), ("i d * o t now", "idiot"), ("so! i d i o t !", "idiot"), ("oh ! i d i o t", "idiot")):
        assert word in toxicity.spaced(text, model), text
    rng = random.Random(6)
    body = " ".join(prose(rng, 1).rstrip("0123456789") for _ in range(9))
    for form in ("iddiot", "id-iot mor_on", "mor_on lloser", "i d ! o t and scum.bag"):
        assert scorer.score(f"{body} {form} {body}") >= 0.3, form
    for form in ("well-known", "letter by letter", "e.g. 3.5", "a | b | c", "x + y + z", "* a\n* b\n", "*" * 5000 + "x", "| | | | |" * 500):
        assert scorer.score(f"{body} {form} {body}") < 0.3, form
    # Words as they stand are kept, and all tokens with more than one path are decoded.
    assert {"you", "idiot"} <= set(toxicity.readings("you-idiot", model)) and "letter" in toxicity.readings("letter", model)
    for _ in range(2000):
        token = "".join(rng.choice("abbé.-_x") for _ in range(rng.randrange(1, 7)))
        core = token.strip(toxicity._EDGE)
        several = any(len(o) > 1 for o in toxicity.lattice(core))
        assert several == bool(toxicity._LEET.search(core) or toxicity._RUN.search(core) or toxicity._DOUBT.search(core))


def test_viterbi_finds_the_cheapest_path(labelled):
    model = toxicity.language_model(labelled[0])

    def cost(path):
        total, x, y = 0.0, 0, 0
        for letters, price in path:
            total += price
            for c in letters:
                z = toxicity.class_of(c)
                total += float(model[x, y, z])
                x, y = y, z
        return total

    for seen in ("1d10t", "a11", "w0rth1e55", "looove"):
        ways = itertools.product(*[*toxicity.lattice(seen), [(" ", 0.0)]])
        best = min(ways, key=cost)
        assert toxicity.restore(seen, model) == "".join(x for x, _ in best).strip()


def test_trigrams_do_not_cross_texts(spark):
    df = spark.createDataFrame([("ab",), ("cde",), (None,), ("é",)], "text string").coalesce(1)
    assert [(r.gram, r.n) for r in toxicity.trigram_counts(df).collect()] == [((3 * 62 + 4) * 62 + 5, 1)]


def test_pipeline_keeps_clean_documents(spark, tmp_path, labelled):
    import corpus_pipeline

    rng = random.Random(5)
    item = prose(rng, 30)
    clean = [(5000 + i, prose(rng, 50)) for i in range(20)]
    docs, labels = labelled
    extra = spark.createDataFrame([*clean, (6000, clean[0][1]), (6001, "x " + item), (6002, prose(rng, 20) + " password=abcdef123")], "doc_id long, text string")
    columns = ["doc_id", "text", "'en' as lang", "'s' as source", "length(text) as n_chars"]
    docs.selectExpr(*columns).union(extra.selectExpr(*columns)).write.parquet(str(tmp_path / "documents.parquet"))
    labels.withColumn("quality", F.lit(1)).write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = got.columns
        got = stage(spark, got, str(tmp_path))
        got.write.parquet(str(tmp_path / f"out-{name}"))
        got = spark.read.parquet(str(tmp_path / f"out-{name}"))
        assert got.columns == before
    left = {r.doc_id: r.text for r in got.collect()}
    assert {i for i, _ in clean} <= left.keys() and not {6000, 6001, 2000, 2001, 2002, 0, 5} & left.keys()
    assert left[6002].endswith("[SECRET]")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == left.keys()


def test_sets_do_not_depend_on_batches():
    texts = ["a b c d e f", None, "", "x y", "A B C D e F " * 50]
    one = [x.tolist() for x in near_dedup.shingle_sets(pa.array(texts), 4)]
    each = [next(near_dedup.shingle_sets(pa.array([t], pa.string()), 4)).tolist() for t in texts]
    assert one == each and [len(x) for x in one] == [len(shingles(t, 4)) for t in texts]


def test_pipeline_on_odd_tables(spark, tmp_path, labelled):
    """Nulls, repeated and empty rows, a text over several chunks, columns that clash with names used inside, and tables without rows."""
    import corpus_pipeline

    rng = random.Random(9)
    item = prose(rng, 30)
    long = " ".join(prose(rng, 50) for _ in range(2500))
    texts = [(7001, prose(rng, 40)), (7002, None), (None, prose(rng, 40)), (None, None), (7003, ""), (7004, " \n "), (7005, long), (7006, prose(rng, 9000) + " " + item), (7007, prose(rng, 40)), (7007, prose(rng, 40))]
    names = ("Blob", "SPANS", "_gone", "digest", "kept", "stays", "score", "batch", "VALUE", "item_id", "predicted")
    extra = [f"'x' as {c}" for c in names]
    docs, labels = labelled
    columns = ["doc_id", "text", "'en' as lang", "'s' as source", "length(text) as n_chars", *extra]
    odd = spark.createDataFrame(texts, "doc_id long, text string")
    whole = docs.selectExpr(*columns).union(odd.selectExpr(*columns))
    for case, rows, marks, items in (("odd", whole, labels, [(0, item), (None, "no id"), (1, None)]), ("none", whole.limit(0), labels.limit(0), [])):
        sf = tmp_path / case
        rows.write.parquet(str(sf / "documents.parquet"))
        marks.withColumn("quality", F.lit(1)).write.parquet(str(sf / "labels.parquet"))
        spark.createDataFrame(items, "item_id long, text string").write.parquet(str(sf / "benchmark.parquet"))
        got = spark.read.parquet(str(sf / "documents.parquet"))
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before = got.columns
            stage(spark, got, str(sf)).write.parquet(str(sf / name))
            got = spark.read.parquet(str(sf / name))
            assert got.columns == before
        left = Counter((r.doc_id, r.text) for r in got.collect())
        if case == "odd":
            assert all(left[x] == n for x, n in Counter(x for x in texts if x[0] != 7006).items()) and 7006 not in {d for d, _ in left}
        else:
            assert not left
        assert corpus_pipeline.STAGES[-1][1](spark, got, str(sf)).count() >= left.total()
