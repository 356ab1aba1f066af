"""Spelling variants grouped through a dictionary of trie-node pairs.

1. ``word_counts``: words of all texts with their counts; one row a word and
   task (a task counts before it sends).
2. ``numbered``: the sorted words are a trie; every node (prefix) gets one
   integer. The words are dealt in ranges. A node whose words lie in two ranges
   is a prefix of a range's first word, so the prefixes of these first words
   (one word a range reaches the driver) are numbered beforehand, and each range
   numbers its other nodes alone. The same for the reversed words.
3. ``near_words``: a word of length L gives L pairs (prefix node, suffix node)
   that skip one position and L + 1 that skip none. Words that share a skipping
   pair differ by one replaced code point; a word whose unskipped pair is
   another's skipping pair lacks one of its code points. Of a run of equal code
   points only the first is skipped for the latter, so each two near words meet
   exactly once. At most one word of each code point shares a pair, so groups
   are no larger than the alphabet; sorted pairs are read as a stream, and one
   row a word and group is sent on, never pairs of words.
4. ``variant_forms``: a word's form is its most frequent near word (ties: the
   smallest in code-point order) if that is ``ratio`` times as frequent; forms are
   followed by pointer doubling (counts grow tenfold a step: few rounds).

Node numbers are exact integers, no hashes: no false and no lost neighbours.

Defined cases. Null and empty texts have no words; a null id counts as empty
text; repeated rows count each time; a very long text is one row of one task
(its words are counted at once); an empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.llm.common import pieces, saved

LETTERS = "A-Za-zÀ-ÿ"
#: Distinct words a task counts before it sends them on.
HELD_WORDS = 1 << 19
#: Words of one range of the sorted vocabulary.
RANGE_WORDS = 1 << 16
SPLIT, SKIP, SKIP_FIRST = 0, 1, 2  # kinds of pairs


def text_words(doc_id: str | None, text: str | None, pattern: re.Pattern, min_chars: int, damage: int) -> Counter:
    """Counts of a text's runs, A-Z in lower case. ``damage``: of a run for which it divides
    h = crc32("<id>:<run>"), the code point h % length is deleted (0: none)."""
    found = Counter(pattern.findall(text.encode("utf-8", "replace").lower().decode())) if text else Counter()
    if not damage:
        return found
    head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for run, n in found.items():
        h = zlib.crc32(run.encode(), head)
        if h % damage == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < min_chars:
                continue
        out[run] += n
    return out


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 7,
                damage: int = 0, letters: str = LETTERS) -> DataFrame:
    """(word, n) of all texts: maximal runs of ``letters`` with at least ``min_chars`` code points."""
    pattern = re.compile(f"[{letters}]{{{min_chars},}}")

    def run(batches):
        held: Counter = Counter()

        def sent():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        for batch in pieces(batches):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.update(text_words(key, text, pattern, min_chars, damage))
                if len(held) > HELD_WORDS:
                    yield sent()
                    held.clear()
        yield sent()

    found = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def _in_ranges(df: DataFrame, key: str, ranges: int):
    """(``df`` with its range in ``shard``, numbers of the prefixes of the ranges' first keys)."""
    dealt = saved(df.repartitionByRange(ranges, key).withColumn("shard", F.spark_partition_id().cast("long")), "spelling-ranges")
    firsts = [r["w"] for r in dealt.groupBy("shard").agg(F.min(key).alias("w")).collect()]
    shared = sorted({w[:d] for w in firsts for d in range(1, len(w) + 1)})
    numbers = {prefix: -1 - k for k, prefix in enumerate(shared)}
    return dealt, df.sparkSession.sparkContext.broadcast(numbers)


def node_paths(words: list[str], first: int, shared: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, lengths): the trie nodes on the way to each of the sorted ``words``, the root (0)
    included, one word after another. Nodes of ``shared`` have their numbers there; others count from ``first``."""
    out, lengths, path, before = [], [], [0], ""
    for word in words:
        keep = 0
        for a, b in zip(before, word):
            if a != b:
                break
            keep += 1
        del path[keep + 1:]
        known = path[-1] <= 0  # below a node of one range alone, nothing is shared
        for depth in range(keep + 1, len(word) + 1):
            number = shared.get(word[:depth]) if known else None
            if number is None:
                known, number = False, first
                first += 1
            path.append(number)
        out += path
        lengths.append(len(word) + 1)
        before = word
    return np.array(out, dtype=np.int64), np.array(lengths, dtype=np.int64)


def numbered(words: DataFrame, ranges: int) -> DataFrame:
    """(wid, word, n, path): ``wid`` follows the order of the words; ``path``: their prefixes' node numbers."""
    dealt, shared = _in_ranges(words, "word", ranges)

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("word")
        shard = group.column("shard")[0].as_py()
        numbers, lengths = node_paths(group.column("word").to_pylist(), (shard << 40) + 1, shared.value)
        path = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(np.concatenate(([0], np.cumsum(8 * lengths)))), pa.py_buffer(numbers)]).cast(pa.binary())
        wid = (shard << 40) + np.arange(len(lengths))
        return pa.table({"wid": wid, "word": group.column("word"), "n": group.column("n"), "path": path})

    return dealt.groupBy("shard").applyInArrow(run, "wid long, word string, n long, path binary")


def node_pairs(words: DataFrame, ranges: int) -> DataFrame:
    """(p, s, kind, wid, n) of words with the paths of their prefixes: all pairs of trie nodes."""
    dealt, shared = _in_ranges(words.withColumn("backward", F.reverse("word")), "backward", ranges)

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("backward")
        shard = group.column("shard")[0].as_py()
        backward = group.column("backward").to_pylist()
        numbers, lengths = node_paths(backward, (shard << 40) + 1, shared.value)
        ends = np.cumsum(lengths)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        spot = np.arange(len(numbers)) - (ends - lengths)[owner]  # position in the word
        suffix = numbers[(ends - 1)[owner] - spot]  # of what follows the first ``spot`` code points
        prefix = np.frombuffer(b"".join(group.column("path").to_pylist()), dtype=np.int64)
        chars = np.frombuffer("".join(w[::-1] + "\0" for w in backward).encode("utf-32-le"), dtype=np.uint32)
        inside = np.flatnonzero(spot < lengths[owner] - 1)
        first = (spot[inside] == 0) | (chars[inside] != chars[inside - 1])
        at = np.concatenate((np.arange(len(numbers)), inside))
        wid, n = (group.column(c).to_numpy()[owner[at]] for c in ("wid", "n"))
        kind = np.concatenate((np.full(len(numbers), SPLIT), np.where(first, SKIP_FIRST, SKIP))).astype(np.int8)
        return pa.table({"p": prefix[at], "s": np.concatenate((suffix, suffix[inside + 1])), "kind": kind, "wid": wid, "n": n})

    return dealt.groupBy("shard").applyInArrow(run, "p long, s long, kind byte, wid long, n long")


def _meetings(p, s, kind, wid, n):
    """Of each word and pair: how many near words it meets there, and the first of them by count and order."""
    new = np.concatenate(([True], (p[1:] != p[:-1]) | (s[1:] != s[:-1])))
    starts = np.flatnonzero(new)
    size = np.diff(np.concatenate((starts, [len(p)])))
    rows = np.repeat(size > 1, size)
    kind, wid, n = kind[rows], wid[rows], n[rows]
    size = size[size > 1]
    starts = np.cumsum(size) - size
    each = np.repeat(size, size)
    left = np.repeat(np.arange(len(kind)), each)
    right = np.repeat(np.repeat(starts, size), each) + np.arange(len(left)) - np.repeat(np.cumsum(each) - each, each)
    a, b = kind[left], kind[right]
    near = (left != right) & (((a != SPLIT) & (b != SPLIT)) | ((a == SPLIT) & (b == SKIP_FIRST)) | ((a == SKIP_FIRST) & (b == SPLIT)))
    left, right = left[near], right[near]
    order = np.lexsort((wid[right], -n[right], left))
    left, right = left[order], right[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(left)), bool), left[1:] != left[:-1])))
    count = np.diff(np.concatenate((first, [len(left)])))
    return wid[left[first]], count, n[right[first]], wid[right[first]]


def near_words(pairs: DataFrame) -> DataFrame:
    """(wid, n_near, best): the number of near words and the first of them, a struct (n, after: minus its wid)."""
    def run(batches):
        rest = None
        names = ["wid", "n_near", "best_n", "best"]

        def met(columns):
            return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in _meetings(*columns)], names=names)
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if rest is not None:
                columns = [np.concatenate(x) for x in zip(rest, columns)]
            p, s = columns[:2]
            if not len(p):
                continue
            last = np.searchsorted(p, p[-1])  # sorted by p, then s: the last group may go on in the next batch
            last += np.searchsorted(s[last:], s[-1])
            if last:
                yield met([c[:last] for c in columns])
            rest = [c[last:] for c in columns]
        if rest is not None:
            yield met(rest)

    met = (pairs.repartition("p", "s").sortWithinPartitions("p", "s")
           .mapInArrow(run, "wid long, n_near long, best_n long, best long"))
    return met.groupBy("wid").agg(F.sum("n_near").alias("n_near"),
                                  F.max(F.struct(F.col("best_n").alias("n"), (-F.col("best")).alias("after"))).alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(wid, root): forms (wid, form) followed to the last."""
    hops = saved(forms.select("wid", F.col("form").alias("root")), "spelling-hops")
    while True:
        up = hops.select(F.col("wid").alias("root"), F.col("root").alias("next"))
        hops = saved(hops.join(up, "root", "left").select("wid", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-hops")
        if not hops.where("moved").limit(1).count():
            return hops.select("wid", "root")
        hops = hops.select("wid", "root")


def variant_forms(counts: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``counts`` (word, n: distinct words)."""
    counts = saved(counts, "spelling-words")
    ranges = max(int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")), counts.count() // RANGE_WORDS + 1)
    words = saved(numbered(counts, ranges), "spelling-numbered")
    near = saved(near_words(node_pairs(words, ranges)), "spelling-near")
    told = words.select("wid", "word", "n").join(near, "wid", "left")
    has_form = F.col("best.n") >= ratio * F.col("n")
    told = saved(told.select("wid", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                             F.when(has_form, -F.col("best.after")).alias("form"), F.when(has_form, F.col("best.n")).alias("form_n")), "spelling-forms")
    forms = told.where("form IS NOT NULL").select("wid", "form")
    names = words.select("wid", "word")
    named = (_roots(forms).join(forms, "wid")
             .join(names.select(F.col("wid").alias("form"), F.col("word").alias("form_word")), "form")
             .join(names.select(F.col("wid").alias("root"), F.col("word").alias("root_word")), "root")
             .select("wid", "form_word", "root_word"))
    return (told.join(named, "wid", "left")
            .select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"))


def query(documents: DataFrame) -> DataFrame:
    """Variants among the words (at least 7 code points, at least 2 occurrences) of all texts,
    one run in 31 with a code point deleted."""
    return variant_forms(word_counts(documents, damage=31).where("n >= 2"))
