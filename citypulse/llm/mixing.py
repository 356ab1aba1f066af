"""Mixing sources to target weights by hierarchical budgeting.

Leaves are (domain, language, source). A leaf can give its tokens ``max_epochs``
times; an inner node as much as its leaves. From the root down each node's
budget is shared among its children by weight; a child that cannot give its
share gives all it has, and the shortage goes to its siblings by weight. Only
what the siblings cannot give either is missing at the parent, and was therefore
already handed to the parent's siblings (capacities are summed upwards first).
Shares are rounded down to whole tokens, exact integers throughout.

A leaf's tokens are read epoch by epoch; every epoch is a seeded order of its
documents. Whole epochs take every document; the last one a prefix: documents
until the tokens before them reach the rest of the budget (an overshoot of less
than one document). The prefix is found from token sums of ``BUCKETS`` hash
ranges per leaf, so only the documents of one range of each leaf are ever
ordered, however large the leaf.

Null text counts as no tokens. Null language, source or id are values of their
own. Repeated rows are documents of their own. Nodes of weight zero give nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citypulse.llm.common import WORD_REGEX, saved

LEVELS = ("__domain", "__lang", "__source")
BUCKETS = 1024
SEED = "mix-1"
MAX_EPOCHS = 2
#: Target tokens as parts of a hundred of the input's tokens.
BUDGET_PCT = 90
#: Integer weights by level and name; others have weight 1.
WEIGHTS = {"__domain": {"web": 5, "books": 3, "forum": 2}, "__lang": {"en": 5, "de": 2, "fr": 2, "es": 1}, "__source": {}}


def domain_of(source: Column) -> Column:
    """Default domain: by the number that ends the source's name."""
    number = F.regexp_extract(source, r"([0-9]{1,9})$", 1)
    return (F.when(F.coalesce(number, F.lit("")) == "", "other").when(number.cast("long") < 10, "web")
            .when(number.cast("long") < 15, "books").otherwise("forum"))


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    out = F.lit(1)
    for name, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == name, w).otherwise(out)
    return out.cast("long")


def _filled(nodes: DataFrame, parent: list[str], level: str) -> DataFrame:
    """``nodes`` (parent, level, cap, w, budget of the parent) with ``given``: the children
    that are full, in order of capacity over weight, come first; the rest share by weight."""
    siblings = Window.partitionBy(*parent, F.lit(0)).orderBy(F.col("cap") / F.col("w"), level)
    before = siblings.rowsBetween(Window.unboundedPreceding, -1)
    onward = siblings.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rest = F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    step = (nodes.where("w > 0").withColumn("rest", rest).withColumn("shares", F.sum("w").over(onward))
            .withColumn("full", F.col("cap") * F.col("shares") <= F.col("rest") * F.col("w")))
    whole = Window.partitionBy(*parent, F.lit(0))
    # the first child that is not full sets the price for all that follow
    first = F.min(F.when(~F.col("full"), F.struct((F.col("cap") / F.col("w")).alias("r"), F.col(level).alias("k"),
                                                  "rest", "shares"))).over(whole)
    return (step.withColumn("first", first)
            .withColumn("given", F.when(F.col("full"), F.col("cap"))
                        .otherwise(F.expr("(w * first.rest) div first.shares")))
            .drop("rest", "shares", "full", "first"))


def budgets(leaves: DataFrame, budget: int, max_epochs: int, weights: dict[str, dict[str, int]]) -> DataFrame:
    """(leaf, tokens, given) from ``leaves`` (leaf levels, tokens)."""
    caps = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    given = None
    for depth, level in enumerate(LEVELS):
        parent = list(LEVELS[:depth])
        nodes = caps.groupBy(*parent, level).agg(F.sum("cap").alias("cap")).withColumn("w", _weight(level, weights))
        if given is None:
            nodes = nodes.withColumn("budget", F.lit(budget).cast("long"))
        else:
            nodes = nodes.join(given, parent)
        given = _filled(nodes, parent, level).select(*parent, level, F.col("given").alias("budget"))
    return leaves.join(given, list(LEVELS)).select(*LEVELS, "tokens", F.col("budget").alias("given"))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
        domain: Column | None = None, token_col: str | None = None, budget_pct: int = BUDGET_PCT,
        max_epochs: int = MAX_EPOCHS, weights: dict[str, dict[str, int]] | None = None, seed: str = SEED) -> DataFrame:
    """The selected documents: the columns of ``df`` with domain, epoch and n_tokens (input
    columns of these names are replaced), one row for each epoch a document is taken in.

    ``token_col``: tokens already counted, else words of ``text_col``. ``budget_pct``: target
    tokens in percent of all tokens of ``df``."""
    spark = df.sparkSession
    weights = WEIGHTS if weights is None else weights
    domain = domain_of(F.col(source_col)) if domain is None else domain
    tokens = F.col(token_col) if token_col else F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD_REGEX))
    added = ("domain", "epoch", "n_tokens")
    others = [c for c in df.columns if c not in added or c in (id_col, text_col, lang_col, source_col)]
    # values of their own for nulls: a name cannot begin with this mark
    named = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))
    marked = {lvl: {f"={k}": v for k, v in weights.get(lvl, {}).items()} for lvl in LEVELS}
    rows = df.select(F.struct(*others).alias("__row"), domain.alias("__d"), F.col(id_col).cast("string").alias("__id"),
                     named(domain).alias("__domain"), named(F.col(lang_col)).alias("__lang"),
                     named(F.col(source_col)).alias("__source"), F.coalesce(tokens, F.lit(0)).cast("long").alias("__n"),
                     *([F.xxhash64(text_col).alias("__tie")] if text_col in df.columns else [F.lit(0).alias("__tie")]))
    leaves = saved(rows.groupBy(*LEVELS).agg(F.sum("__n").alias("tokens")), "mix-leaves")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    plan = saved(budgets(leaves, total * budget_pct // 100, max_epochs, marked)
                 .where("tokens > 0")
                 .withColumn("__epochs", F.expr("given div tokens")).withColumn("__rest", F.expr("given % tokens"))
                 .drop("tokens", "given"), "mix-plan")
    order = F.md5(F.concat_ws(":", F.lit(seed), F.col("__epochs").cast("string"), F.coalesce("__id", F.lit("-"))).cast("binary"))
    bucket = F.floor(F.conv(F.substring(order, 1, 8), 16, 10).cast("long") * BUCKETS / F.lit(float(1 << 32)))
    planned = rows.join(plan, list(LEVELS))
    dealt = planned.withColumn("__order", order).withColumn("__bucket", bucket)
    sums = dealt.where("__rest > 0").groupBy(*LEVELS, "__bucket").agg(F.sum("__n").alias("n"))
    upto = Window.partitionBy(*LEVELS).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    # the range in which the prefix ends: the last one that begins before the rest is reached
    ends = saved(sums.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0))).join(plan, list(LEVELS))
                 .where(F.col("before") < F.col("__rest")).groupBy(*LEVELS)
                 .agg(F.max(F.struct("__bucket", "before")).alias("e"))
                 .select(*LEVELS, F.col("e.__bucket").alias("__end"), F.col("e.before").alias("__before")), "mix-ends")
    cut = dealt.where("__rest > 0").join(ends, list(LEVELS))
    below = cut.where(F.col("__bucket") < F.col("__end"))
    inside = Window.partitionBy(*LEVELS).orderBy("__order", "__id", "__n", "__tie").rowsBetween(Window.unboundedPreceding, -1)
    edge = (cut.where(F.col("__bucket") == F.col("__end"))
            .withColumn("__sum", F.col("__before") + F.coalesce(F.sum("__n").over(inside), F.lit(0)))
            .where(F.col("__sum") < F.col("__rest")))
    whole = planned.where("__epochs > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__epochs") - 1)))
    out = ["__row", "__d", "epoch", "__n"]
    return (whole.select(*out).union(below.withColumn("epoch", F.col("__epochs")).select(*out))
            .union(edge.withColumn("epoch", F.col("__epochs")).select(*out))
            .select("__row.*", F.col("__d").alias("domain"), F.col("epoch").cast("long").alias("epoch"),
                    F.col("__n").alias("n_tokens")))


def query(documents: DataFrame) -> DataFrame:
    """One row per selected (document, epoch). The words are counted once; the plan works on the counts."""
    counted = saved(documents.select("doc_id", "lang", "source", F.regexp_count(
        F.coalesce("text", F.lit("")), F.lit(WORD_REGEX)).alias("n_tokens")), "mix-tokens")
    return mix(counted.withColumnRenamed("n_tokens", "tokens"), token_col="tokens").select(
        "doc_id", "domain", "lang", "source", "epoch", "n_tokens")


def _case(level: str) -> str:
    whens = " ".join(f"WHEN {level[2:]} = '{k}' THEN {v}" for k, v in WEIGHTS[level].items())
    return f"CASE {whens} ELSE 1 END" if whens else "1"


def _fill_sql(name: str, nodes: str, parent: list[str], key: str) -> str:
    part = f"PARTITION BY {', '.join(parent)} " if parent else ""
    return f"""
{name}_a AS (SELECT *, budget - coalesce(sum(cap) OVER ({part}ORDER BY cap / w, {key} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(w) OVER ({part}ORDER BY cap / w, {key} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS shares FROM ({nodes}) WHERE w > 0),
{name}_b AS (SELECT *, cap * shares <= rest * w AS is_full FROM {name}_a),
{name}_c AS (SELECT *, first_value(CASE WHEN NOT is_full THEN rest END IGNORE NULLS) OVER ({part}ORDER BY cap / w, {key} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS frest,
    first_value(CASE WHEN NOT is_full THEN shares END IGNORE NULLS) OVER ({part}ORDER BY cap / w, {key} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS fshares FROM {name}_b),
{name} AS (SELECT {', '.join([*parent, key])}, (CASE WHEN is_full THEN cap ELSE (w * frest) // fshares END)::BIGINT AS budget FROM {name}_c)"""


def oracle_sql(documents: str = "documents") -> str:
    """The query in DuckDB SQL over the relation ``documents`` (its lang and source are not null)."""
    lv = ["domain", "lang", "source"]
    return rf"""
WITH d AS (SELECT doc_id, lang, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens,
    CASE WHEN regexp_extract(source, '([0-9]{{1,9}})$', 1) = '' THEN 'other'
         WHEN regexp_extract(source, '([0-9]{{1,9}})$', 1)::BIGINT < 10 THEN 'web'
         WHEN regexp_extract(source, '([0-9]{{1,9}})$', 1)::BIGINT < 15 THEN 'books' ELSE 'forum' END AS domain FROM {documents}),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, (sum(n_tokens) * {MAX_EPOCHS})::BIGINT AS cap FROM d GROUP BY ALL),
{_fill_sql("g1", f"SELECT domain, sum(cap)::BIGINT AS cap, any_value({_case('__domain')}) AS w, (SELECT (sum(tokens) * {BUDGET_PCT} // 100)::BIGINT FROM leaves) AS budget FROM leaves GROUP BY domain", [], "domain")},
{_fill_sql("g2", f"SELECT domain, lang, sum(cap)::BIGINT AS cap, any_value({_case('__lang')}) AS w, any_value(budget) AS budget FROM leaves JOIN g1 USING (domain) GROUP BY domain, lang", ["domain"], "lang")},
{_fill_sql("g3", f"SELECT domain, lang, source, sum(cap)::BIGINT AS cap, any_value({_case('__source')}) AS w, any_value(budget) AS budget FROM leaves JOIN g2 USING (domain, lang) GROUP BY ALL", ["domain", "lang"], "source")},
plan AS (SELECT domain, lang, source, budget // tokens AS epochs, budget % tokens AS rest FROM g3 JOIN leaves USING (domain, lang, source) WHERE tokens > 0),
o AS (SELECT d.*, epochs, rest, coalesce(sum(n_tokens) OVER (PARTITION BY {', '.join('d.' + x for x in lv)}
    ORDER BY md5('{SEED}:' || epochs || ':' || doc_id), doc_id, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM d JOIN plan USING (domain, lang, source))
SELECT doc_id, domain, lang, source, epoch::BIGINT AS epoch, n_tokens::BIGINT AS n_tokens FROM (
  SELECT *, unnest(range(0, epochs)) AS epoch FROM o WHERE epochs > 0
  UNION ALL SELECT *, epochs AS epoch FROM o WHERE before < rest)
"""


ORACLE_SQL = oracle_sql()
