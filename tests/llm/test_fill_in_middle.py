"""Fill-in-middle: cuts against slices, exact round trips, odd rows."""

import hashlib
import random
import re

import numpy as np
import pytest

from tapeloom.llm import fill_in_middle as fim


def by_slices(doc_id, text, seed=1):
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    text = text or ""
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    return (n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def texts():
    rng = random.Random(3)
    out = [None, "", "a", "é", "𝒳", "<P>", "x<S", "a<M>b", "<<S", "S><", ">", "\n\n", " ", "é" * 700]
    for n in [2, 3, 1023, 1024, 1025, 2047, 2048, 2049, 70_000]:
        out += ["".join(rng.choice(alphabet) for _ in range(n)) for alphabet in ("ab <", "aé漢𝒳", "漢字", "<PSM>", "𝒳")]
    return out


def test_equals_slices_and_round_trips(spark):
    rows = [(i * 7 - 20, t, "x") for i, t in enumerate(texts())] + [(None, "no id at all", "x"), (5, "twice", "x"), (5, "twice", "x")]
    made = fim.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string, Output string"))
    got = made.withColumn("back", fim.restored(made["output"], made["form"])).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=key) == sorted(((i, *by_slices(i, t)) for i, t, _ in rows), key=key)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.back) for r in got) == sorted((i is None, i or 0, t or "") for i, t, _ in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("unit", [None, r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", r"[a-z]+", r"x*"])
def test_every_cut_is_the_end_of_its_unit(unit):
    rng = random.Random(8)
    for n in (0, 1, 40, 3000):
        text = "".join(rng.choice("ab é\n漢") for _ in range(n))
        raw = text.encode()
        ends = [m.end() for m in re.finditer(unit.encode(), raw) if m.end() > m.start()] if unit else np.cumsum([len(c.encode()) for c in text]).tolist()
        blocks = fim.Blocks(np.frombuffer(raw, dtype=np.uint8), re.compile(unit.encode()) if unit else None)
        assert blocks.n == len(ends)
        for k in {0, *range(1, min(5, blocks.n) + 1), *(rng.randrange(blocks.n + 1) for _ in range(200)), blocks.n}:
            place = 0 if not k else ends[k - 1]
            assert blocks.cut(k) == (place, len(raw[:place].decode()))


def test_descent_finds_the_block_of_every_unit():
    counts = np.array([0, 3, 0, 0, 5, 1, 0, 2])
    tree, holder = fim.fenwick(counts), np.repeat(np.arange(len(counts)), counts)
    for k, block in enumerate(holder.tolist(), 1):
        assert fim.descend(tree, k) == (block, int(counts[:block].sum()))
    assert [fim.counted(tree, b) for b in range(9)] == np.r_[0, np.cumsum(counts)].tolist()
    assert fim.fenwick(np.zeros(0, np.int64)).tolist() == [0]


def test_word_units_keep_words_whole(spark):
    text = "one two  three\nfour five"
    made = fim.fill_in_middle(spark.createDataFrame([(i, text) for i in range(60)], "doc_id long, text string"), unit=r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")
    for r in made.withColumn("back", fim.restored(made["output"], made["form"])).collect():
        assert r.n == 5 and r.back == text
        if r.form != "plain":
            assert {r.prefix_chars, r.prefix_chars + r.middle_chars} <= {0, 4, 9, 15, 20, 24}


def test_empty_table(spark):
    assert fim.report(fim.fill_in_middle(spark.createDataFrame([], "doc_id long, text string"))).collect() == []
