"""Tokenizer alignment against a plain alignment of whole texts."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from citypulse.llm import alignment, queries
from conftest import SMOKE


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(f"{alignment.TOKENIZERS}/{alignment.A_FILE}")
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=f"{alignment.TOKENIZERS}/{alignment.B_FILE}")
    byte = {c: v for c, v in alignment.byte_of_char().items()}
    a_name = {k: bytes(byte[c] for c in x) for x, k in a.get_vocab().items() if all(c in byte for c in x)}

    def b_name(k):
        x = b.id_to_piece(k)
        return bytes([int(x[3:5], 16)]) if x.startswith("<0x") and len(x) == 6 else x.replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return [], []
        raw = (" " + text).encode()
        ta = [(k, a_name[k]) for k in a.encode(" " + text, add_special_tokens=False).ids]
        tb = [(k, b_name(k)) for k in b.encode(text)]
        same = b"".join(x for _, x in ta) == raw == b"".join(x for _, x in tb)
        return (ta, tb) if same else ([], [])
    return tokens


def ranges(tokens):
    at, out = 0, []
    for k, x in tokens:
        out.append((k, at, at + len(x)))
        at += len(x)
    return out


def brute(rows, tokens):
    """The contract's rows, by walking both token lists of each whole text; pair counts beside them."""
    links, groups, sizes = {}, {}, {}
    for r, (_, text) in enumerate(rows):
        ta, tb = tokens(text)
        a, b = ranges(ta), ranges(tb)
        found, i, j = [], 0, 0
        while i < len(a) and j < len(b):
            found.append((a[i][0], b[j][0]))
            x, y = a[i][2], b[j][2]
            i, j = i + (x <= y), j + (y <= x)
        links[r] = found
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        parts = [(",".join(str(k) for k, s, e in a if lo <= s and e <= hi), ",".join(str(k) for k, s, e in b if lo <= s and e <= hi)) for lo, hi in zip([0, *ends], ends)] if len(a) < 400 else None
        groups[r] = parts
        sizes[r] = (len(a), len(b), len(ends))
    counts = Counter(x for v in links.values() for x in v)
    docs = Counter(x for v in links.values() for x in set(v))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for r, (key, _) in enumerate(rows):
        text = None if groups[r] is None else ";".join(f"{x}|{y}" for x, y in groups[r])
        out.append((key, *sizes[r], len(links[r]), sum(counts[p] == most[p[1]] for p in links[r]), sum(counts[p] for p in links[r]),
                    text if text is None else hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out, {p: (docs[p], counts[p]) for p in counts}


def same(found, wanted):
    cols = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows = sorted(([r[c] for c in cols] for r in found.collect()), key=str)
    wanted = sorted((list(r) for r in wanted), key=str)
    assert [r[:-1] for r in rows] == [r[:-1] for r in wanted]
    assert all(w[-1] is None or r[-1] == w[-1] for r, w in zip(rows, wanted))


ODD = [None, "", " ", "  two  spaces ", "\n\n lines \n x", "tab\t x y  z", "it's 's don't 'S  'll", "mark ▁ inside", "▁", "<s> </s> <unk> <0x41> <|endoftext|> x",
       "naïve café 漢字 かな 🙂🙂 👩‍👩‍👧", "ﬁ ligature ½ ①", "a" * 3000, "x " * 3000, "\x00 \x1c \x85 \x7f", "1234567890 12 3.14", "  　 b", "é" * 40 + " é"]


def test_equals_whole_text_alignment_on_odd_texts(spark, plain):
    rng = random.Random(3)
    bits = ["word", "Word", " ", "  ", "\n", "\t", "é", "漢", "'s", "12", "!?", "▁", " ", "the", "\x1c"]
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "null id"), (7, "again again"), (7, "again again")]
    rows += [(100 + k, "".join(rng.choice(bits) for _ in range(rng.randint(1, 40)))) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS block", "2 AS pair", "'x' AS id")
    wanted, _ = brute(rows, plain)
    same(alignment.align(df.repartition(5)), wanted)


@pytest.mark.parametrize("docs,held", [(4096, 300_000), (5, 50)])
def test_pair_counts_and_scores_on_documents(spark, plain, docs, held):
    """Whole table; small blocks and a small memory change nothing."""
    rows = [tuple(r) for r in spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text").collect()]
    if docs == 5:
        rows = [r for r in rows if len(r[1] or "") < 3000]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    wanted, counts = brute(rows, plain)
    same(alignment.align(df, block_docs=docs, held=held), wanted)
    found = alignment.pair_counts(alignment.postings(df, block_docs=docs, held=held)).collect()
    assert {(r["a"], r["b"]): (r["n_docs"], r["n_links"]) for r in found} == counts


def test_bitmaps_round_trip():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 40, 5000) << alignment.SLOT_BITS | rng.integers(0, 4096, 5000))
    mult = rng.integers(1, 5000, len(keys))
    twice = np.concatenate((keys, keys[:100]))
    found = alignment.bitmaps(twice, np.concatenate((mult, mult[:100])))
    mult[:100] *= 2
    data = found["bitmap"]
    lengths = np.array([len(x.as_py()) for x in data])
    row, doc, n = alignment.unpacked(found["planes"].to_numpy().astype(np.int64), lengths, np.frombuffer(b"".join(x.as_py() for x in data), np.uint8))
    got = dict(zip((found["pair"].to_numpy()[row] << alignment.SLOT_BITS | doc).tolist(), n.tolist()))
    assert got == dict(zip(keys.tolist(), mult.tolist()))


def test_empty_table_and_query(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(df).count() == 0
    assert queries.QUERIES["op12_tokenizer_alignment"](spark, SMOKE).count() == spark.read.parquet(f"{SMOKE}/documents.parquet").count()


def test_bitmaps_are_shuffled_once(spark):
    """Only blocks gather bitmaps; the counts find them there."""
    df = spark.createDataFrame([(k, f"word {k} again word") for k in range(40)], "doc_id long, text string")
    post = alignment.postings(df)
    scores = alignment.link_scores(post, alignment.pair_counts(post))
    nodes = spark._jvm.PythonSQLUtils.explainString(scores._jdf.queryExecution(), "formatted").split("\n\n")
    moved = [x for x in nodes if re.match(r"\(\d+\) (Broadcast)?Exchange", x.strip()) and "bitmap" in x]
    assert len(moved) == 1 and scores.count() == 40
