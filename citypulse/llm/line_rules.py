"""Line-first cleaning with native column expressions only.

Each line with a word is judged by the rules below; failing lines are removed,
and a document that loses more than ``max_loss_pct`` percent of its words is
rejected. Everything is computed inside one row from arrays, so there is no
shuffle, and no Python runs on the executors.

Arrays are bound with ``_let`` (a one-element ``transform``): a plain column
would be inlined into the lambdas and split again for every element.

Null text counts as empty: no words, no lines, fails the base test. Repeated
rows are judged alike. All input columns stay; an input column that has the
name of an added one is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citypulse.llm.common import SPACE_REGEX

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
MAX_LOSS_PCT = 30
SYMBOLS = "#*$%&|<>"
SEPARATORS = ["|", "||", "»", "«", "›", "•", "·", "::", "/", ">", "->"]
CLOSING_REGEX = r"[.!?…:;,\"'”»)\]]\s*$"
STOCK_REGEX = (r"(?i)\b(all rights reserved|terms of (use|service)|privacy policy|cookie (policy|settings)|"
               r"enable javascript|lorem ipsum|click here|sign (in|up) (to|for)|log in to|subscribe to our)\b")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.transform(F.array(value), body)[0]


def _words(line: Column) -> Column:
    return F.filter(F.split(line, SPACE_REGEX), lambda w: w != "")


def _count(cond: Column) -> Column:
    return cond.cast("long")


def line_fails(line: Column, words: Column) -> dict[str, Column]:
    """Rule name -> whether a line fails it (``words``: the line's words, at least one)."""
    n = F.size(words)
    chars = F.length(F.array_join(words, ""))
    symbols = F.length(F.regexp_replace(line, f"[^{SYMBOLS}]+", ""))
    separators = F.size(F.filter(words, lambda w: w.isin(SEPARATORS)))
    repeats = F.size(F.filter(words, lambda w, i: (i > 0) & (w == F.get(words, i - 1))))
    return {
        # no closing mark on a fragment; a mark or symbol at every turn
        "punctuation": (~F.rlike(line, F.lit(CLOSING_REGEX)) & (n < 3)) | (F.regexp_count(line, F.lit("!!")) * 3 >= n)
        | (symbols * 10 >= chars),
        "navigation": separators * 8 >= n,
        "boilerplate": (F.rlike(line, F.lit(STOCK_REGEX)) & (n <= 25)) | ((n >= 3) & (repeats * 3 >= n)),
    }


def _repeat_words(words: Column) -> Column:
    """Words inside ``WINDOW``-word windows found twice or more in ``words``.

    Windows are compared by 64-bit hashes of their words (chance of a false
    match in a text of n words: n^2 / 2^65). Only a text with a repeated hash
    goes on to the sort that finds where the repeats stand.
    """
    def positions(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return _let(pairs, lambda p: F.sort_array(F.transform(F.filter(
            F.transform(p, lambda x, k: F.struct(
                x["i"].alias("i"),
                ((x["h"] == F.get(p, k - 1)["h"]) | (x["h"] == F.get(p, k + 1)["h"])).alias("twice"))),
            lambda x: F.coalesce(x["twice"], F.lit(False))), lambda x: x["i"])))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - i, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, s: total + s)

    def found(hashes: Column) -> Column:
        return (F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), _let(positions(hashes), covered))
                .otherwise(F.lit(0).cast("long")))

    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)),
                         lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(F.size(words) >= WINDOW, _let(hashes, found)).otherwise(F.lit(0).cast("long"))


def clean_lines(df: DataFrame, text_col: str = "text", max_loss_pct: int = MAX_LOSS_PCT) -> DataFrame:
    """``df`` with the base counts, ``base_failed``, ``kept``, ``n_removed_words``,
    ``failed_rules`` (number of lines that fail each rule) and ``clean_text`` (the
    lines that stay, joined by \\n)."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def judged(line: Column, words: Column) -> Column:
        has = F.size(words) > 0
        rules = {k: F.coalesce(has & v, F.lit(False)) for k, v in line_fails(line, words).items()}
        bad = None
        for v in rules.values():
            bad = v if bad is None else bad | v
        return F.struct(line.alias("line"), words.alias("words"), bad.alias("bad"),
                        *[v.alias(k) for k, v in rules.items()])

    lines = F.transform(F.split(text, "\n"), lambda line: _let(_words(line), lambda ws: judged(line, ws)))

    def total(items: Column, value: Callable[[Column], Column]) -> Column:
        return F.aggregate(items, F.lit(0).cast("long"), lambda t, x: t + value(x))

    def failing(rule: str) -> Callable[[Column], Column]:
        return lambda x: x[rule]

    def summary(ls: Column) -> Column:
        worded = F.transform(F.filter(ls, lambda x: F.size(x["words"]) > 0), lambda x: x["line"])
        good = F.filter(ls, lambda x: ~x["bad"])
        all_words = F.flatten(F.transform(ls, lambda x: x["words"]))
        return F.struct(
            total(ls, lambda x: F.size(x["words"])).alias("n_words"),
            total(ls, lambda x: F.length(F.array_join(x["words"], ""))).alias("word_chars"),
            F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
            _let(worded, lambda w: F.size(w) - F.size(F.array_distinct(w))).cast("long").alias("n_dup_lines"),
            _let(all_words, _repeat_words).alias("n_repeat_words"),
            total(F.filter(ls, lambda x: x["bad"]), lambda x: F.size(x["words"])).alias("n_removed_words"),
            F.struct(*[F.size(F.filter(ls, failing(k))).alias(k)
                       for k in ("punctuation", "navigation", "boilerplate")]).alias("failed_rules"),
            F.array_join(F.transform(good, lambda x: x["line"]), "\n").alias("clean_text"))

    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words",
             "failed_rules", "clean_text"]
    others = [F.col(c) for c in df.columns if c not in (*added, "base_failed", "kept") or c == text_col]
    out = df.select(*others, F.inline(F.transform(F.array(lines), summary)))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    return (out.withColumn("base_failed", base_failed)
            .withColumn("kept", ~F.col("base_failed")
                        & (100 * F.col("n_removed_words") <= max_loss_pct * F.col("n_words"))))


def query(documents: DataFrame) -> DataFrame:
    return clean_lines(documents.select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words",
        "base_failed", "kept")


_SEPARATOR_LIST = ", ".join(f"'{s}'" for s in SEPARATORS)

ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT r, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w
      FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)),
j AS (SELECT r, line, w, len(w) AS n, length(array_to_string(w, '')) AS chars,
        (NOT regexp_matches(line, '{CLOSING_REGEX.replace("'", "''")}') AND len(w) < 3)
        OR ((length(line) - length(replace(line, '!!', ''))) // 2) * 3 >= len(w)
        OR length(regexp_replace(line, '[^{SYMBOLS}]+', '', 'g')) * 10 >= length(array_to_string(w, ''))
        OR len(list_filter(w, lambda x: x IN ({_SEPARATOR_LIST}))) * 8 >= len(w)
        OR (regexp_matches(line, '{STOCK_REGEX}') AND len(w) <= 25)
        OR (len(w) >= 3 AND 3 * len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) >= len(w)) AS bad
      FROM l WHERE len(w) > 0),
s AS (SELECT r, sum(n) AS n_words, sum(chars) AS word_chars, count(*) - count(DISTINCT line) AS n_dup_lines,
        coalesce(sum(n) FILTER (bad), 0) AS n_removed_words FROM j GROUP BY r),
t AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
g AS (SELECT r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS gram
      FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM t WHERE len(w) >= {WINDOW})),
p AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS c FROM g) WHERE c > 1),
c AS (SELECT r, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW}))) AS n_repeat_words
      FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM p) GROUP BY r),
f AS (SELECT doc_id, text, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
        length(regexp_replace(text, '[^{SYMBOLS}]+', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_removed_words, 0) AS n_removed_words
      FROM d LEFT JOIN s USING (r) LEFT JOIN c USING (r)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed FROM f)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  n_removed_words::BIGINT AS n_removed_words, base_failed,
  NOT base_failed AND 100 * n_removed_words <= {MAX_LOSS_PCT} * n_words AS kept
FROM b
"""
