"""Line rules: SQL oracle on the smoke tables and a plain Python version on edge rows."""

import re

from citypulse.llm import line_rules, queries
from conftest import SMOKE
from oracle import compare, duck

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i:i + 8]), []).append(i)
    hit = {k for v in at.values() if len(v) > 1 for i in v for k in range(i, i + 8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


def test_query_matches_sql(spark):
    rep = compare(spark, "op4", queries.QUERIES["op4_line_rules"], queries.ORACLES["op4_line_rules"], SMOKE, duck(SMOKE))
    assert rep["ok"], rep


def test_edge_rows(spark):
    clean = " ".join(f"word{i}" for i in range(60)) + "."
    texts = [None, "", " \n\t\n", "a", clean, f"Home | News | Shop | Help |\n{clean}", "ab%%% cd### " * 40,
             "THIS!! IS!! LOUD!! " * 12, clean * 700, "x" * 200_000, "é ü\x0b字 \x0c" * 30,
             "\n".join(["same line here."] * 20), " ".join(w for i in range(30) for w in [f"s{i}"] * 5),
             "    a b " * 30]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate([*texts, texts[4]])],
                               "doc_id long, text string, kept string")
    rows = {r["doc_id"]: r for r in line_rules.clean_lines(df).collect()}
    assert len(rows) == len(texts) + 1
    for i, t in enumerate(texts):
        got = rows[i]
        assert (got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"], got["n_repeat_words"]) == \
            plain_base(t), i
    assert [i for i in range(len(texts)) if rows[i]["kept"]] == [4, 5]
    assert rows[5]["clean_text"] == clean and rows[5]["n_removed_words"] == 8
    assert rows[len(texts)]["kept"]
    assert line_rules.clean_lines(df.limit(0)).collect() == []
