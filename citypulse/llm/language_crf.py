"""Language identification of whole texts by a linear-chain conditional random field over words.

Features of a word: byte n-grams of its lower-cased letters between two
boundary marks (those that touch a mark are its affixes), and the word itself if
it is in the lexicon of the training words. Transitions between the labels of
neighbouring words are learned too, on sequences in which runs of words of
different training texts alternate, as in code-switched text.

Forward-backward over *all* words of a text gives each word's label
probabilities; the text's language has the largest mean, which is its score.

The fit sees about ``FIT_TEXTS`` texts of each language, drawn by a hash of the
id, and of each at most ``FIT_WORDS`` words in a row; the prediction covers all rows and whole texts. A text that is null or has
no letter is ``und`` with score 0, as is every text if nothing could be learned.
Repeated rows and null ids are predicted row by row.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.llm.common import fold

#: Expected number of training texts of each language.
FIT_TEXTS = 400
#: Words taken from a training text, from a seeded place in it.
FIT_WORDS = 400
HELD_OUT_MOD = 5
ORDERS = (2, 3, 4, 5)
TABLE_BITS = 16
#: Training words seen so often are the lexicon.
LEXICON_MIN = 3
UNKNOWN = "und"
_DROP = bytes(b for b in range(128) if not (chr(b).isalpha() or b in b" \t\n\x0b\x0c\r"))


def letter_words(text: str | None) -> list[bytes]:
    """Lower-cased words without ASCII digits, marks and symbols; words without anything else go."""
    words = (text or "").lower().encode("utf-8", "replace").translate(None, _DROP).split()
    if words and not any(w[0] < 128 or w.decode("utf-8", "replace")[0].isalpha() for w in words):
        if not any(ch.isalpha() for ch in text):
            return []
    return words


def gram_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of all byte n-grams of the words, and where each word's begin."""
    blob = np.frombuffer(b"".join(b"\x01" + w + b"\x02" for w in words) + bytes(16), dtype=np.uint8)
    lens = np.array([len(w) + 2 for w in words])
    n = int(lens.sum())
    grams = np.empty(n + 8, dtype=np.uint64)
    for k in range(8):
        part = blob[k:k + (len(blob) - k) // 8 * 8].view("<u8")
        target = grams[k::8]
        target[:] = part[:len(target)]
    left = np.repeat(np.cumsum(lens), lens) - np.arange(n)  # bytes to the word's end
    word = np.repeat(np.arange(len(words)), lens)
    rows, owners = [], []
    for order in ORDERS:
        at = np.flatnonzero(left >= order)
        x = grams[at] & np.uint64((1 << (8 * order)) - 1)
        x = (x + np.uint64(order << 56)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        rows.append((x >> np.uint64(64 - TABLE_BITS)).astype(np.int32))
        owners.append(word[at])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(rows)[order], np.searchsorted(owner[order], np.arange(len(words) + 1))


def forward_backward(emit: np.ndarray, lens: np.ndarray, start: np.ndarray, move: np.ndarray):
    """Label probabilities (sum of lens, labels) of sequences laid out one after
    another, longest first; ``emit`` are log scores. All sequences go side by side."""
    first = np.cumsum(lens) - lens
    e = np.exp(emit - emit.max(axis=1, keepdims=True))
    ahead = np.empty_like(e)
    step = np.exp(move)
    live = [int(np.searchsorted(-lens, -t, side="left")) for t in range(int(lens[0]) if len(lens) else 0)]
    a = None
    for t, k in enumerate(live):
        at = first[:k] + t
        a = (np.exp(start) if a is None else a[:k] @ step) * e[at]
        a /= a.sum(axis=1, keepdims=True)
        ahead[at] = a
    b = np.ones((0, e.shape[1]), dtype=e.dtype)
    for t in range(len(live) - 1, -1, -1):
        k = live[t]
        b = np.concatenate((b, np.ones((k - len(b), e.shape[1]), dtype=e.dtype)))
        at = first[:k] + t
        ahead[at] *= b
        b = (b * e[at]) @ step.T
        b /= b.sum(axis=1, keepdims=True)
    return ahead / ahead.sum(axis=1, keepdims=True)


@dataclass
class Crf:
    labels: list[str]
    grams: np.ndarray  # (2^TABLE_BITS, labels)
    lexicon: dict[bytes, int]
    words: np.ndarray  # (lexicon, labels)
    start: np.ndarray
    move: np.ndarray

    def emissions(self, words: list[bytes], block: int = 50_000) -> np.ndarray:
        out = np.empty((len(words), len(self.labels)), dtype=np.float32)
        for lo in range(0, len(words), block):
            part = words[lo:lo + block]
            rows, bounds = gram_features(part)
            out[lo:lo + len(part)] = np.add.reduceat(self.grams[rows], bounds[:-1], axis=0)
            known = np.array([self.lexicon.get(w, -1) for w in part])
            at = np.flatnonzero(known >= 0)
            out[lo + at] += self.words[known[at]]
        return out

    def predict(self, texts: list[list[bytes]], side_by_side: int = 512) -> np.ndarray:
        """Mean label probabilities of each text (zeros for a text without words)."""
        index: dict[bytes, int] = {}
        ids = [np.array([index.setdefault(w, len(index)) for w in t], dtype=np.int32) for t in texts]
        out = np.zeros((len(texts), len(self.labels)))
        if not index:
            return out
        table = self.emissions(list(index))
        order = [i for i in np.argsort([-len(t) for t in texts], kind="stable").tolist() if texts[i]]
        for lo in range(0, len(order), side_by_side):
            group = order[lo:lo + side_by_side]
            lens = np.array([len(texts[i]) for i in group])
            p = forward_backward(table[np.concatenate([ids[i] for i in group])], lens, self.start, self.move)
            out[group] = np.add.reduceat(p, np.cumsum(lens) - lens, axis=0) / lens[:, None]
        return out


def train(texts: list[tuple[str, list[bytes]]], seed: int = 3, steps: int = 400, width: int = 64, length: int = 48,
          rate: float = 0.15) -> Crf | None:
    """A field from (language, words) by AdaGrad on the log likelihood of switched sequences."""
    texts = [(lang, w) for lang, w in texts if w]
    labels = sorted({lang for lang, _ in texts})
    if not labels:
        return None
    rng = np.random.default_rng(seed)
    of = {lang: [w for k, w in texts if k == lang] for lang in labels}
    counts = Counter(w for _, ws in texts for w in ws)
    vocabulary = list(counts)
    index = {w: i for i, w in enumerate(vocabulary)}
    lexicon = {w: i for i, w in enumerate(w for w, c in counts.items() if c >= LEXICON_MIN)}
    in_lexicon = np.array([lexicon.get(w, -1) for w in vocabulary])
    rows, bounds = gram_features(vocabulary)
    coded = {lang: [np.array([index[w] for w in ws]) for ws in group] for lang, group in of.items()}
    n = len(labels)
    p = {"grams": np.zeros((1 << TABLE_BITS, n), np.float32), "words": np.zeros((max(1, len(lexicon)), n), np.float32),
         "start": np.zeros(n, np.float32), "move": np.zeros((n, n), np.float32)}
    seen = {k: np.full(v.shape, 1e-6, np.float32) for k, v in p.items()}

    def learn(key, g, at=None):
        if at is None:
            seen[key] += g * g
            p[key] -= rate * g / np.sqrt(seen[key])
        else:
            used, inverse = np.unique(at, return_inverse=True)
            total = np.stack([np.bincount(inverse, weights=g[:, c], minlength=len(used)) for c in range(n)], axis=1)
            total = total.astype(np.float32)
            seen[key][used] += total * total
            p[key][used] -= rate * total / np.sqrt(seen[key][used])

    def sequence():
        words, gold = [], []
        while len(words) < length:
            lang = int(rng.integers(n))
            group = coded[labels[lang]]
            text = group[int(rng.integers(len(group)))]
            size = int(rng.integers(4, 2 * length))
            a = int(rng.integers(max(1, len(text) - size + 1)))
            part = text[a:a + size]
            words += part.tolist()
            gold += [lang] * len(part)
        return words[:length], gold[:length]

    for _ in range(steps):
        drawn = [sequence() for _ in range(width)]
        words = np.concatenate([w for w, _ in drawn])
        gold = np.concatenate([g for _, g in drawn])
        unique, inverse = np.unique(words, return_inverse=True)
        spans = [rows[bounds[u]:bounds[u + 1]] for u in unique]
        feats = np.concatenate(spans)
        owner = np.repeat(np.arange(len(unique)), [len(s) for s in spans])
        table = np.add.reduceat(p["grams"][feats], np.cumsum([0] + [len(s) for s in spans[:-1]]), axis=0)
        lex = in_lexicon[unique]
        table[lex >= 0] += p["words"][lex[lex >= 0]]
        emit = table[inverse]
        emit3 = emit.reshape(width, length, n)
        e = np.exp(emit3 - emit3.max(axis=2, keepdims=True))
        step = np.exp(p["move"])
        ahead = np.empty_like(e)
        a = np.exp(p["start"]) * e[:, 0]
        for t in range(length):
            if t:
                a = (a @ step) * e[:, t]
            a = a / a.sum(axis=1, keepdims=True)
            ahead[:, t] = a
        b = np.ones((width, n), np.float32)
        post = np.empty_like(e)
        pair = np.zeros((n, n), np.float32)
        for t in range(length - 1, -1, -1):
            post[:, t] = ahead[:, t] * b
            post[:, t] /= post[:, t].sum(axis=1, keepdims=True)
            if t:
                joint = ahead[:, t - 1, :, None] * step[None] * (b * e[:, t])[:, None, :]
                pair += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
                b = (b * e[:, t]) @ step.T
                b = b / b.sum(axis=1, keepdims=True)
        grad = post.reshape(-1, n).copy()
        grad[np.arange(len(gold)), gold] -= 1
        by_word = np.stack([np.bincount(inverse, weights=grad[:, c], minlength=len(unique)) for c in range(n)], axis=1)
        learn("grams", by_word[owner] / width, feats)
        if (lex >= 0).any():
            learn("words", by_word[lex >= 0] / width, lex[lex >= 0])
        gold2 = gold.reshape(width, length)
        np.subtract.at(pair, (gold2[:, :-1].ravel(), gold2[:, 1:].ravel()), 1)
        learn("move", pair / width)
        first = post[:, 0].sum(axis=0) - np.bincount(gold2[:, 0], minlength=n)
        learn("start", (first / width).astype(np.float32))
    return Crf(labels, p["grams"], lexicon, p["words"], p["start"], p["move"])


def fitted(docs: DataFrame, seed: int = 29) -> Crf | None:
    """A field from ``docs`` (id, text, lang), of which some FIT_TEXTS of each language are read."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("id", HELD_OUT_MOD) != 0))
    counts = rows.groupBy("lang").count().collect()
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, FIT_TEXTS / r["count"]))])
    # by id and text: rows that share an id are drawn one by one; equal rows are drawn together and read once
    drawn = F.xxhash64("id", "text", F.lit(seed))
    draw = F.pmod(drawn, F.lit(1 << 20)) / float(1 << 20)
    texts = []
    for r in rows.where(draw < share[F.col("lang")]).select("lang", "text", "id", drawn.alias("h")).distinct().orderBy("lang", "h", "id", "text").toLocalIterator():
        words = letter_words(r["text"])
        a = zlib.crc32(str(r["id"]).encode()) % max(1, len(words) - FIT_WORDS + 1)
        texts.append((r["lang"], words[a:a + FIT_WORDS]))
    return train(texts)


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``df`` with held_out, lang_pred, score and lang_shares (map of the mean label
    probabilities over the words); input columns of these names are replaced."""
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    shared = df.sparkSession.sparkContext.broadcast(fitted(docs))
    added = ("held_out", "lang_pred", "score", "lang_shares")
    others = [c for c in df.columns if c not in added or c in (id_col, text_col)]
    rows = df.select(F.struct(*others).alias("row"), (fold(id_col, HELD_OUT_MOD) == 0).alias("held_out"),
                     F.col(text_col).alias("text"))

    def run(batches):
        field = shared.value
        for batch in batches:
            words = [letter_words(t.as_py()) if field else [] for t in batch.column(2)]
            p = field.predict(words) if field else np.zeros((len(words), 1))
            best = p.argmax(axis=1)
            langs = [field.labels[b] if w else UNKNOWN for w, b in zip(words, best)]
            shares = [list(zip(field.labels, q)) if w else [] for w, q in zip(words, p.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(langs, pa.string()),
                 pa.array(np.clip(p[np.arange(len(p)), best], 0, 1), pa.float64()),
                 pa.array(shares, pa.map_(pa.string(), pa.float64()))],
                names=["row", "held_out", "lang_pred", "score", "lang_shares"])

    row_type = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {row_type}, held_out boolean, lang_pred string, score double, "
                                "lang_shares map<string,double>").select("row.*", *added)


def query(documents: DataFrame) -> DataFrame:
    return identify(documents.select("doc_id", "text", "lang")).select("doc_id", "held_out", "lang_pred", "score")
