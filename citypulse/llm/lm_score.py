"""Document scores of a gated recurrent language model with a unigram base.

1. Word counts of all training texts (whole corpus), combined per task first.
2. The ``HEAD`` most frequent words and the totals by word shape are read back:
   both are bounded. Rarer words stay in the counts table and are joined.
3. One pass encodes every whole text as symbols (2 bytes a token), which training
   and scoring read, and sends on the rarer words of each row.
4. The model (:mod:`citypulse.llm.gru`) starts from the corpus counts and a bounded
   sample of training texts (``WARM_TOKENS``, drawn by id and text together), and is
   then trained on all training texts, each symbol once: texts are dealt by a hash of
   id and text to shares of a fixed number of tokens, each share trains in the order of
   the hashes, and the parameters are averaged by tokens, ``FAN_IN`` shares at a time.
   So scores do not depend on how the table is split into files or tasks.
5. A join with the counts adds the rarer words' logarithms.

Rarer words are joined by a 64-bit hash of the word (chance that any two of V
words share one: V^2 / 2^65). Null text counts as empty: the end token alone.
Repeated rows and null ids are scored row by row. Other columns are ignored.
With no training text at all every count is zero and every base score is 0.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.llm import gru
from citypulse.llm.common import fold, lower_words, pieces, saved

#: Most words whose counts every task holds in memory.
HEAD = 1 << 16
#: The first training sample: expected number of texts, bound on its tokens, updates made on it.
WARM_TEXTS, WARM_TOKENS, WARM_WINDOWS = 1000, 400_000, 700
#: Tokens of one share of the training texts, and those trained on at a time, one such part after another.
SHARE_TOKENS, PART_TOKENS = 4_000_000, 2_000_000
#: Shares whose parameters are added up at a time.
FAN_IN = 32
#: Distinct words that a counting task holds before it sends them on.
HELD_WORDS = 400_000
HELD_OUT_MOD = 10
MARKS = b".,;:!?%#&$*|\"'()[]"
_JUNK = {ord(c): i for i, c in enumerate("%#&$*!|")}


def shape(word: bytes) -> int:
    """Class of a word that is not among the frequent ones: its doubled closing mark, or its last letters."""
    end = word[-1]
    if end in _JUNK and (len(word) == 1 or word[-2] == end):
        return _JUNK[end]
    return 8 + zlib.crc32(word.rstrip(MARKS)[-2:]) % (gru.SHAPES - 8)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word binary, shape, n) over all words of ``texts`` (text)."""
    def run(batches):
        held: Counter = Counter()

        def sent():
            words = list(held)
            batch = pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array([shape(w) for w in words], pa.int32()),
                 pa.array(held.values(), pa.int64())], names=["word", "shape", "n"])
            held.clear()
            return batch

        for batch in batches:
            for text in batch.column(0):
                held.update(lower_words(text.as_py()))
                if len(held) > HELD_WORDS:
                    yield sent()
        if held:
            yield sent()

    return (texts.mapInArrow(run, "word binary, shape int, n long")
            .groupBy("word", "shape").agg(F.sum("n").alias("n")))


class Vocabulary:
    """What every task needs: head words with their counts, shapes' totals, N and V."""

    def __init__(self, head: list[tuple[bytes, int, int]], shape_total: dict[int, tuple[int, int]],
                 n_texts: int, n_words: int, n_distinct: int):
        self.tokens = n_words + n_texts
        self.distinct = n_distinct + (n_texts > 0)
        self.log_z = math.log10(self.tokens + 0.1 * (self.distinct + 1))
        self.ends = n_texts
        self.index = {w: i for i, (w, _, _) in enumerate(head)}
        frequent = min(len(head), gru.END)
        counts = np.array([c for _, _, c in head], dtype=np.float64)
        shapes = np.array([s for _, s, _ in head], dtype=np.int64)
        n, v = np.zeros(gru.SHAPES), np.zeros(gru.SHAPES)
        for s, (a, b) in shape_total.items():
            n[s], v[s] = a, b
        np.subtract.at(n, shapes[:frequent], counts[:frequent])
        np.subtract.at(v, shapes[:frequent], 1)
        self.log_shape = np.log10(n + 0.1 * (v + 1))
        self.log_count = np.log10(counts + 0.1)
        self.symbol = np.where(np.arange(len(head)) < frequent, np.arange(len(head)), gru.FREQUENT + shapes)
        slots = np.full(gru.FREQUENT, -1.0)
        slots[:frequent], slots[gru.END] = counts[:frequent], n_texts
        self.start = (slots, n)

    def encode(self, words: list[bytes]):
        """Symbols (with the end), head indexes and the words beyond the head."""
        ids = np.fromiter(map(self.index.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        out = np.empty(len(words) + 1, dtype=np.int64)
        known = ids >= 0
        out[:-1][known] = self.symbol[ids[known]]
        rest = [words[i] for i in np.flatnonzero(~known).tolist()]
        out[:-1][~known] = [gru.FREQUENT + shape(w) for w in rest]
        out[-1] = gru.END
        return out, ids[known], rest


def vocabulary(train: DataFrame, counts: DataFrame) -> Vocabulary:
    """The head is cut at a count, found from the number of words in each 32nd of a doubling
    of the count, so that no task sorts the words of all others."""
    step = F.floor(F.log2("n") * 32)
    sizes = sorted(((r["s"], r["n"]) for r in counts.groupBy(step.alias("s")).agg(F.count("*").alias("n")).collect()),
                   reverse=True)
    least, held = None, 0
    for s, n in sizes:
        if held + n > HEAD:
            break
        least, held = s, held + n
    head = [] if least is None else sorted(counts.where(step >= least).collect(), key=lambda r: (-r["n"], bytes(r["word"])))
    totals = counts.groupBy("shape").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    return Vocabulary([(bytes(r["word"]), r["shape"], r["n"]) for r in head],
                      {r["shape"]: (r["n"], r["v"]) for r in totals}, train.count(),
                      sum(r["n"] for r in totals), sum(r["v"] for r in totals))


def encoded(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """One pass over the texts (id, text, held_out): each row's symbols (2 bytes each), a hash of id and
    text, what its words beyond the frequent ones add, and the words beyond the head."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def run(batches):
        vocab = shared.value
        row = TaskContext.get().partitionId() << 33
        end_known = vocab.ends > 0
        log_end = math.log10(vocab.ends + 0.1)
        for batch in pieces(batches):
            symbols, sizes, n_known, base, rest_score = [], [], [], [], []
            hashes, times, ends = [], [], [0]
            for text in batch.column(1).to_pylist():
                syms, head, rest = vocab.encode(lower_words(text))
                base.append(vocab.log_count[head].sum() + log_end - len(syms) * vocab.log_z)
                far = vocab.symbol[head] >= gru.FREQUENT
                shapes = syms[syms >= gru.FREQUENT] - gru.FREQUENT
                rest_score.append(vocab.log_count[head[far]].sum() - vocab.log_shape[shapes].sum())
                n_known.append(len(head) + end_known)
                rarer = Counter(rest)
                hashes += [xxhash.xxh3_64_intdigest(w) - (1 << 63) for w in rarer]
                times += rarer.values()
                ends.append(len(hashes))
                sizes.append(len(syms))
                symbols.append(syms.astype("<i2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(row + np.arange(batch.num_rows)), batch.column(0), batch.column(2), batch.column(3), pa.array(symbols, pa.binary()),
                 pa.array(sizes, pa.int64()), pa.array(n_known, pa.int64()),
                 pa.array(base, pa.float64()), pa.array(rest_score, pa.float64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                     [pa.array(hashes, pa.int64()), pa.array(times, pa.int32())], names=["w", "n"]))],
                names=["row", "id", "held_out", "h", "symbols", "n_tokens", "n_known", "base", "rest", "rarer"])
            row += batch.num_rows

    id_type = dict(docs.dtypes)["id"]
    return docs.select("id", "text", "held_out", F.xxhash64("id", "text", F.lit(11)).alias("h")).mapInArrow(
        run, f"row long, id {id_type}, held_out boolean, h long, symbols binary, n_tokens long, n_known long, base double, rest double, "
             "rarer array<struct<w:long,n:int>>")


def fitted(train: DataFrame, vocab: Vocabulary) -> gru.Params:
    """Model parameters from the encoded training texts (h, symbols): a start from a bounded sample,
    then all texts. Both depend on the texts alone, not on how the table is split.

    The sample is drawn by a hash of id and text, at a rate that expects ``WARM_TOKENS`` tokens
    at most; in the order of the hash, the text that goes beyond is cut there. Then every text
    goes to one of the shares of some ``SHARE_TOKENS`` tokens by its hash, equal rows one after
    another to the next shares, and each share is trained in the order of the hashes."""
    params = gru.initial(*vocab.start)
    spark = train.sparkSession
    if not vocab.ends:
        return params
    rate = min(1.0, WARM_TEXTS / vocab.ends, WARM_TOKENS / vocab.tokens)
    drawn = train.where(F.pmod(F.xxhash64("h"), F.lit(1 << 30)) < int(rate * (1 << 30))).select("h", F.substring("symbols", 1, 2 * WARM_TOKENS).alias("symbols"))
    sample, size = [], 0
    for row in sorted(drawn.collect(), key=lambda r: (r["h"], bytes(r["symbols"]))):
        symbols = np.frombuffer(bytes(row["symbols"]), "<i2").astype(np.int64)
        sample.append(symbols[:WARM_TOKENS - size])
        size += len(sample[-1])
        if size == WARM_TOKENS:
            break
    params = gru.train(params, sample, WARM_WINDOWS)
    shared = spark.sparkContext.broadcast((vocab.start, gru.pack(params)))
    shares = -(-vocab.tokens // SHARE_TOKENS)
    # equal rows become one with a count, and are dealt to one share after another
    rows = train.groupBy("h", "symbols").agg(F.count(F.lit(1)).alias("n"))
    dealt = rows.select("h", "symbols", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("k")).select(
        F.pmod(F.col("h") + F.col("k"), F.lit(shares)).alias("share"), "h", "symbols")

    def trained(table: pa.Table) -> pa.Table:
        start, raw = shared.value
        table = table.sort_by([("h", "ascending"), ("symbols", "ascending")])
        new, n, texts, size = gru.unpack(raw, gru.initial(*start)), 0, [], 0
        for part in table.to_batches(max_chunksize=1 << 12):
            for symbols in part.column("symbols"):
                texts.append(np.frombuffer(symbols.as_buffer(), "<i2"))
                size += len(texts[-1])
                if size >= PART_TOKENS:
                    new, n = gru.train_whole(new, texts), n + size
                    texts, size = [], 0
        new, n = gru.train_whole(new, texts), n + size
        return pa.table({"share": table.column("share")[:1], "n": [float(n)], "params": pa.array([(n * np.frombuffer(gru.pack(new), np.float32).astype(np.float64)).tobytes()], pa.binary())})

    def summed(table: pa.Table) -> pa.Table:
        table = table.sort_by("share")
        total = np.zeros(len(table.column("params")[0].as_buffer()) // 8)
        for x in table.column("params"):
            total += np.frombuffer(x.as_buffer())
        return pa.table({"share": table.column("up")[:1], "n": [float(table.column("n").to_numpy().sum())], "params": pa.array([total.tobytes()], pa.binary())})

    kind = "share long, n double, params binary"
    means = saved(dealt.groupBy("share").applyInArrow(trained, kind), "lm-shares")
    while shares > FAN_IN:  # sums of so many shares at a time, in their order
        means = saved(means.withColumn("up", F.floor(F.col("share") / FAN_IN).cast("long")).groupBy("up").applyInArrow(summed, kind), "lm-shares")
        shares = -(-shares // FAN_IN)
    means = sorted(means.collect(), key=lambda r: r["share"])
    total = sum(np.frombuffer(bytes(r["params"])) for r in means) / sum(r["n"] for r in means)
    return gru.unpack(total.astype(np.float32), params)


def lm_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of ``df``."""
    spark = df.sparkSession
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                     (fold(id_col, HELD_OUT_MOD) == 0).alias("held_out"))
    train = docs.where(~F.col("held_out"))
    counts = saved(word_counts(train.select("text")), "lm-counts")
    vocab = vocabulary(train, counts)
    told = saved(encoded(docs, vocab), "lm-encoded")
    params = fitted(told.where(~F.col("held_out")).select("h", "symbols"), vocab)
    shared = spark.sparkContext.broadcast((vocab.start, gru.pack(params)))

    def run(batches):
        start, raw = shared.value
        model = gru.unpack(raw, gru.initial(*start))
        for batch in pieces(batches):
            lp = gru.score_all(model, [np.frombuffer(x.as_buffer(), "<i2") for x in batch.column(1)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lp / math.log(10))], names=["row", "lp"])

    scored = saved(told.select("row", "symbols").mapInArrow(run, "row long, lp double"), "lm-scored")

    def hashed(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([xxhash.xxh3_64_intdigest(w.as_py()) - (1 << 63) for w in batch.column(0)], pa.int64()),
                 batch.column(1)], names=["w", "c"])

    least = min((int(round(10 ** x - 0.1)) for x in vocab.log_count[-1:].tolist()), default=1 << 62)
    table = counts.where(F.col("n") <= least).select("word", "n").mapInArrow(hashed, "w long, c long")
    found = (told.select("row", F.inline("rarer")).join(table, "w", "left")
             .groupBy("row").agg(F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.1))).alias("log_rest"),
                                 F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("known_rest")))
    rest = F.coalesce("log_rest", F.lit(0.0))
    return (told.select("row", "id", "held_out", "n_tokens", "n_known", "base", "rest").join(scored, "row").join(found, "row", "left")
            .select(F.col("id").alias(id_col), "held_out", "n_tokens",
                    (F.col("n_known") + F.coalesce("known_rest", F.lit(0))).alias("n_known"),
                    F.lit(vocab.tokens).cast("long").alias("train_tokens"),
                    (F.col("base") + rest).alias("base_score"), (F.col("lp") + F.col("rest") + rest).alias("score")))
