"""Decontamination: exact distances, recall against brute force with planted edits, clean texts, edge rows."""

import random
import re

import numpy as np

from citypulse.llm import decontam, queries
from citypulse.llm.common import table
from conftest import SMOKE


def cut(text):
    return re.sub(rb"[\x00-/:-@\[-`{-\x7f]", b" ", (text or "").encode().lower()).split()


def distance(item, words):
    row = [0] * (len(words) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(words, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def brute(texts, items, ratio=0.2):
    out = []
    for t in texts:
        words = cut(t)
        vocabulary = set(words)
        ids = []
        for i, text in items:
            item = cut(text)
            edits = int(ratio * len(item))
            if item and sum(w not in vocabulary for w in item) <= edits and distance(item, words) <= edits:
                ids.append(i)
        out.append(ids)
    return out


def test_distance():
    rng = np.random.default_rng(4)
    for _ in range(40):
        a, b = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(0, 4, rng.integers(0, 20))
        assert decontam.edit_distance_within(a, b) == distance(a.tolist(), b.tolist())


def test_query_against_brute_force(spark):
    docs = [tuple(r) for r in table(spark, SMOKE, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, SMOKE, "benchmark").collect()]
    want = dict(zip((d for d, _ in docs), brute([t for _, t in docs], items)))
    got = {r["doc_id"]: r["item_ids"] for r in queries.QUERIES["op3_decontaminate"](spark, SMOKE).collect()}
    assert got.keys() == want.keys() and sum(map(bool, want.values())) > 0
    assert all(set(got[d]) <= set(want[d]) for d in want)
    assert sum(len(got[d]) for d in want) >= 0.95 * sum(map(len, want.values()))


def test_recall_with_edits(spark):
    rng = random.Random(6)
    items = [(r["item_id"], r["text"]) for r in table(spark, SMOKE, "benchmark").collect()]
    filler = " ".join(f"w{i}" for i in range(3000)).split()
    texts = []
    for k in range(200):
        words = items[k % len(items)][1].split()
        for _ in range(int(rng.uniform(0, 0.2) * len(words))):
            j = rng.randrange(len(words))
            words[j:j + 1] = [[f"new{rng.random()}"], [], [words[j], f"more{rng.random()}"]][rng.randrange(3)]
        a = rng.randrange(2000)
        texts.append(" ".join(filler[a:a + rng.randrange(90)] + words + filler[a:a + 40]).upper())
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: set(r["item_ids"]) for r in decontam.decontaminate(df, bench).collect()}
    want = brute(texts, items)
    n = sum(map(len, want))
    assert sum(len(got[k] & set(want[k])) for k in got) >= 0.9 * n
    assert all(got[k] <= set(want[k]) for k in got)


def test_edges_and_item_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 30)
    items = [(1, "one two three four five six seven eight nine ten"), (2, None), (3, ""), (4, "lonely"),
             (5, "one two three four five six seven eight nine ten"), (6, " ".join(f"k{i}" for i in range(400)))]
    long = " ".join(f"z{i}" for i in range(60_000))
    texts = [None, "", "clean words only here", "x One, two; three four five six seven eight nine TEN!", "Lonely!",
             long + " " + items[5][1] + " " + long, "one two"]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate([*texts, texts[3]])], "doc_id long, text string, item_ids int")
    bench = spark.createDataFrame([(*r, "en") for r in items], "item_id long, text string, lang string")
    got = {r["doc_id"]: r["item_ids"] for r in decontam.decontaminate(df, bench).collect()}
    assert got == {0: [], 1: [], 2: [], 3: [1, 5], 4: [4], 5: [6], 6: [], 7: [1, 5]}
    assert {r["contaminated"] for r in decontam.decontaminate(df, bench.limit(0)).collect()} == {False}
    assert decontam.decontaminate(df.limit(0), bench).collect() == []


def test_short_items_at_all_alignments_behind_other_texts():
    items = [(n, " ".join(f"s{n}x{i}" for i in range(n))) for n in range(1, 13)]
    index = decontam.Index([(i, decontam.word_hashes([t.encode()])[0]) for i, t in items], decontam.RECALL, 0.2)
    for before in range(5):
        texts = [" ".join(["p"] * before)]
        for k in range(8):
            texts += [" ".join([*(f"f{j}" for j in range(k)), t, "g h i j"]) for _, t in items]
            texts += [" ".join([*(f"f{j}" for j in range(k)), t]) for _, t in items]
        found = decontam.found_items(index, [t.encode() for t in texts])
        assert [[index.items[i][0] for i in f] for f in found] == brute(texts, items), before


def test_verdict_does_not_depend_on_neighbours():
    rng = random.Random(8)
    items = [(k, " ".join(f"i{k}x{j}" for j in range(20))) for k in range(40)]
    index = decontam.Index([(i, decontam.word_hashes([t.encode()])[0]) for i, t in items], 0.5, 0.2, tables=2)
    texts = []
    for k, t in items * 4:
        words = t.split()
        for _ in range(3):
            words[rng.randrange(len(words))] = f"new{rng.random()}"
        texts.append(" ".join([*(f"f{j}" for j in range(rng.randrange(9))), *words]).encode())
    alone = [decontam.found_items(index, [t])[0] for t in texts]
    assert any(alone) and not all(alone)
    assert decontam.found_items(index, texts) == alone
    assert decontam.found_items(index, [b"a b c", *texts[::-1]])[:0:-1] == alone


def test_tables_reach_the_recall_at_the_design_ratio():
    rng = np.random.default_rng(12)
    items = [(k, rng.integers(1, 1 << 62, 9 + k % 4, dtype=np.uint64)) for k in range(60)]
    index = decontam.Index(items, 0.99, 0.2)
    copies = []
    for k in range(1200):
        w = list(items[k % 60][1])
        for _ in range(int(0.2 * len(w))):
            i, kind, new = int(rng.integers(len(w))), int(rng.integers(3)), np.uint64(rng.integers(1, 1 << 62))
            w[i:i + 1] = [[new], [], [w[i], new]][kind]
        pad = rng.integers(1, 1 << 62, 4 + int(rng.integers(4)), dtype=np.uint64)
        copies.append(np.array([*pad[4:], *w, *pad[:4]], dtype=np.uint64))
    words, first = decontam.spaced(np.concatenate(copies), np.cumsum([0, *map(len, copies)]))
    met = np.zeros(len(copies), dtype=bool)
    for _, _, at, item, _ in index.candidates(words, first):
        of = np.searchsorted(first, at, side="right") - 1
        met[of[item == of % 60]] = True
    assert met.mean() >= 0.98, (met.mean(), index.tables)
