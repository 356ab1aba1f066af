"""Main text of HTML pages as the maximum-scoring run of tokens.

A page is read as tokens: words score positive, tags negative. The best
contiguous run, found by one linear scan, is the content region; menus, forms,
adverts and the like inside it are left out, and what remains is its text.

Weights are log odds of a token kind inside against outside the content, from
labelled pages: those that mark their content with an ``article`` or ``main``
element. A word's kind tells whether it is inside such an element, outside it on
a page that has one, or on a page without one, and whether it is link text.
Tags are kept below zero, so that they only separate: slightly where they are
inside marked content or close an element, else by their odds.

Null html gives an empty text, as does a page without words. Broken markup is
read as far as it goes: tags may be left open or cut off. Repeated rows are
extracted alike. Whole pages are read, whatever their length.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs2>[^<>]*+)(?:>|(?=<)|\Z)|[^<]+|<", re.S)
MARKED = re.compile(r"<(article|main)[\s>]", re.I)
ATTRIBUTE = re.compile(r"(?:^|[\s\"'])(class|id|role|aria-label|style|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?",
                       re.I)
PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
CONTENT = frozenset("article main".split())
#: Elements whose text is not markup; it is never content.
RAW = frozenset("script style textarea title noscript iframe xmp template svg math object select".split())
EXCLUDED = frozenset("nav footer aside form button menu dialog fieldset label input datalist audio video canvas".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup signin login sidebar menu "
    "nav navbar navigation breadcrumb breadcrumbs footer masthead topbar comment comments respond reply replies disqus "
    "discussion related recommended recommendations teaser teasers share sharing social widget toolbar pagination pager "
    "search skip copyright contentinfo complementary form disclaimer".split())
#: Words that are joined to others in names, as in commentlist or cookiebar.
NOISE_STARTS = ("advert", "sponsor", "cookie", "newsletter", "sidebar", "breadcrumb", "navbar", "footer", "adsense", "adslot",
                "commentlist", "commentbox", "commentform", "commentarea", "sharebar", "sharebox", "popup")
#: A name with one of these tells what a page has, not what the element is.
STATES = frozenset("has with without no open closed enabled disabled layout page".split())
#: A site's header is left out; a header inside the content holds its headline.
HEADER_WORDS = frozenset(["header"])
HEADLINES = frozenset(["h1", "h2"])
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section summary table tbody td tfoot th thead title tr ul".split())
#: A new one of these ends an open one right around it.
SELF_CLOSING = frozenset("p li dt dd tr td th option".split())
LIGHT = -0.05
HEAVY = -1.5
#: Weights without labelled pages; also the tags' prior.
DEFAULTS = {"word:inside": 2.0, "word:outside": -1.0, "word:page": 1.0, "link:inside": 1.0, "link:outside": -2.0,
            "link:page": -0.5, "skipped": -0.02}
PROSE_TAGS = frozenset("p b i em strong u br h1 h2 h3 h4 h5 h6 blockquote pre code span sub sup q cite small mark abbr "
                       "article main figure figcaption".split())


def _noisy(name: str, attrs: str, in_content: bool) -> bool:
    return name in EXCLUDED or name == "header" and not in_content or _noisy_name(name, attrs, in_content)


def _noisy_name(name: str, attrs: str, in_content: bool) -> bool:
    """Whether attributes alone tell that an element is noise."""
    if name in ("html", "body", "main") or not attrs:
        return False
    for key, value in ATTRIBUTE.findall(attrs):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return True
            continue
        for label in value.split():
            words = {label.lower()} if name == "article" else {w.lower() for w in PIECES.findall(label)}
            if words & STATES:
                continue
            if words & NOISE_WORDS or not in_content and words & HEADER_WORDS or any(
                    w.startswith(NOISE_STARTS) for w in words):
                return True
    return False


def tokens(page: str, trusted: int = -1, sizes: Counter | None = None) -> list[tuple[str, str, int]]:
    """(kind, text, words): kind ``tag:<name>`` (text "/" for an end tag, "+" inside marked
    content, else empty), a word kind, or ``skipped`` for words that are never content. A run of text of one kind is one entry.

    ``sizes`` gets, by offset, the number of words from the first headline on of each element that only its
    names make noise and that lies in no other noise; the names of the one at ``trusted`` are not heeded."""
    out: list[tuple[str, str, int]] = []
    marked = MARKED.search(page) is not None
    stack: list[tuple[str, bool]] = []  # open elements and whether they are noise
    noise = content = link = 0
    begun = False  # a content element has begun
    outer = -1  # the offset of the outermost element of noise, if its names make it one
    at, n = 0, len(page)
    while at < n:
        m = TOKEN.match(page, at)
        at = m.end()
        name = m["name"] or m["name2"]
        if name is None:
            text = m[0]
            if text[0] == "<" and len(text) > 1:
                continue  # a comment or declaration
            text = html.unescape(text)
            words = len(text.split())
            if noise:
                kind = "skipped"
                if sizes is not None and outer in sizes:
                    sizes[outer] += words
            else:
                kind = ("link:" if link else "word:") + ("inside" if content else "outside" if marked else "page")
            out.append((kind, text, words))
            continue
        name = name.lower()
        if m["end"] or m["end2"]:
            if name == "a":
                link = 0
            elif any(x == name for x, _ in stack):
                while stack:
                    x, bad = stack.pop()
                    noise -= bad
                    content -= x in CONTENT and not bad
                    if x == name:
                        break
            if not noise:
                out.append((f"tag:{name}", "/", 0))
            continue
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
            at = stop.end() if stop else n
            continue
        attrs = m["attrs"] or m["attrs2"] or ""
        if name in CONTENT and noise and not begun and not _noisy(name, attrs, False):
            stack, noise = [(x, False) for x, _ in stack], 0  # the content never lies in noise: that was left open
        if stack and stack[-1][0] == name and name in SELF_CLOSING:
            noise -= stack.pop()[1]
        bad = m.start() != trusted and _noisy(name, attrs, content > 0)
        if bad and not noise:
            outer = m.start() if name not in EXCLUDED and name != "header" else -1
        if noise and name in HEADLINES and sizes is not None and outer >= 0:
            sizes[outer] += 0
        if name == "a":
            link = 1
        if name not in VOID and not attrs.endswith("/") and (name in BLOCK or bad):
            stack.append((name, bad))
            noise += bad
            content += name in CONTENT and not bad
            begun |= content > 0
        if not noise:
            out.append((f"tag:{name}", "+" if content else "", 0))
    return out


def kind_counts(page: str) -> Counter:
    """(kind, inside the content) -> count, for a page that marks its content."""
    out: Counter = Counter()
    for kind, text, words in tokens(page):
        if kind.startswith("tag:"):
            if text != "/":
                out[kind, text == "+"] += 1
        elif kind != "skipped":
            out[kind, kind.endswith("inside")] += words
    return out


def weights(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log odds by kind, with a prior of ten tokens for tags by their usual use."""
    out = dict(DEFAULTS)
    inside = sum(c for (_, i), c in counts.items() if i) + 1
    outside = sum(c for (_, i), c in counts.items() if not i) + 1
    for kind in {k for k, _ in counts}:
        a, b = counts.get((kind, True), 0), counts.get((kind, False), 0)
        if kind.startswith("tag:"):
            prior = 10 if kind[4:] in PROSE_TAGS else 1
            odds = math.log((a + prior) / (inside + 11) * (outside + 11) / (b + 11 - prior))
            out[kind] = min(LIGHT, max(HEAVY, odds))
        elif kind in DEFAULTS and a + b:
            odds = math.log((a + 1) / (inside + 2) * (outside + 2) / (b + 1))
            low, high = (0.5, 3.0) if kind.endswith("inside") else (-3.0, -0.1)
            out[kind] = min(high, max(low, odds))
    return out


def best_run(scores: list[float]) -> tuple[int, int]:
    """Bounds of the contiguous run with the largest positive sum (the first such; empty if none)."""
    best, lo, hi, total, start = 0.0, 0, 0, 0.0, 0
    for k, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += s
        if total > best:
            best, lo, hi = total, start, k + 1
    return lo, hi


def main_text(page: str | None, weight: dict[str, float]) -> str:
    """The text of the best run. If names of elements leave a page without text, the one with a
    headline and the most words is content after all (as in class="content ad-free")."""
    sizes: Counter = Counter()
    text = _run_text(tokens(page or "", sizes=sizes), weight)
    if not text and any(sizes.values()):
        text = _run_text(tokens(page or "", max(sizes, key=lambda k: (sizes[k], -k))), weight)
    return text


def _run_text(toks: list[tuple[str, str, int]], weight: dict[str, float]) -> str:
    lo, hi = best_run([(LIGHT if text else weight.get(kind, LIGHT if kind[4:] in PROSE_TAGS else HEAVY))
                       if kind.startswith("tag:") else weight[kind] * words for kind, text, words in toks])
    blocks, parts = [], []
    for kind, text, _ in toks[lo:hi]:
        if kind.startswith("tag:"):
            if kind[4:] in BLOCK:
                blocks.append("".join(parts))
                parts = []
        elif kind != "skipped":
            parts.append(text)
        else:
            parts.append(" ")
    blocks.append("".join(parts))
    return "\n".join(t for t in (" ".join(b.split()) for b in blocks) if t)


def learned_weights(pages: DataFrame, html_col: str) -> dict[str, float]:
    """Weights from all pages with an article or main element; one row per token kind
    and task is shuffled, and tag names not in use in HTML count as one kind."""
    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for page in batch.column(0):
                for (kind, inside), c in kind_counts(page.as_py()).items():
                    if kind.startswith("tag:") and kind[4:] not in BLOCK | PROSE_TAGS | VOID and kind != "tag:a":
                        kind = "tag:other"
                    held[kind, inside] += c
        if held:
            keys = list(held)
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in keys]), pa.array([i for _, i in keys]),
                                              pa.array([held[k] for k in keys], pa.int64())], names=["kind", "inside", "n"])

    marked = pages.select(F.col(html_col).alias("html")).where(F.rlike("html", F.lit(r"(?i)<(article|main)[\s>]")))
    rows = (marked.mapInArrow(run, "kind string, inside boolean, n long")
            .groupBy("kind", "inside").agg(F.sum("n").alias("n")).collect())
    return weights({(r["kind"], r["inside"]): r["n"] for r in rows})


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with text and n_chars (code points); input columns of these names are replaced."""
    shared = pages.sparkSession.sparkContext.broadcast(learned_weights(pages, html_col))
    others = [c for c in pages.columns if c not in ("text", "n_chars") or c == html_col]
    rows = pages.select(F.struct(*others).alias("row"), F.col(html_col).alias("html"))

    def run(batches):
        weight = shared.value
        for batch in batches:
            texts = [main_text(p.as_py(), weight) for p in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()),
                                              pa.array(map(len, texts), pa.int64())], names=["row", "text", "n_chars"])

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, text string, n_chars long").select("row.*", "text", "n_chars")


def query(pages: DataFrame) -> DataFrame:
    return extract(pages.select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
