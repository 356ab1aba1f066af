"""Sampling, splits, unions and de-duplication.

Random choices are seeded hashes of a row key (``xxhash64(key, seed)``), so
they do not depend on partition layout, survive executor loss (recomputed
tasks draw the same values) and need no driver-side state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citypulse import contract as C
from citypulse.session import materialize, stored


def hash_key(key_cols, seed: int = C.SEED):
    cols = [F.col(k) for k in ([key_cols] if isinstance(key_cols, str) else key_cols)]
    return F.xxhash64(F.lit(int(seed)), *cols)


def first_k_by_hash(df: DataFrame, k_of_n, group=(), key_cols="dr_no", seed: int = C.SEED,
                    flag: str = "__selected", levels: int = 20) -> DataFrame:
    """Flag, per group, the first ``k`` rows in (seeded hash, key) order.

    ``k_of_n`` maps the group's row count (a Column) to k. The k-th row is
    found without sorting a group in one task: rows are bucketed by the top
    ``levels`` bits of their hash, bucket counts (a table bounded by
    2^levels per group) are prefix-summed to find the boundary bucket, and
    only rows of the boundary bucket are ranked with a window. Rows before the
    boundary are selected outright, rows after it are not.
    """
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    group = list(group)
    h = hash_key(keys, seed)
    d = df.withColumns({"__h": h, "__b": F.shiftright(h, 64 - levels)})
    if not group:
        d = d.withColumn("__g", F.lit(0))
        group = ["__g"]
    counts = d.groupBy(*group, "__b").agg(F.count(F.lit(1)).alias("__c"))
    n_group = counts.groupBy(*group).agg(F.sum("__c").alias("__n"))
    wcum = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    cum = (counts.join(F.broadcast(n_group), group)
           .withColumns({"__hi": F.sum("__c").over(wcum), "__k": k_of_n(F.col("__n")).cast("bigint")}))
    cum = cum.withColumn("__lo", F.col("__hi") - F.col("__c"))
    boundary = cum.where((F.col("__lo") < F.col("__k")) & (F.col("__hi") >= F.col("__k"))).select(
        *group, F.col("__b").alias("__bb"), (F.col("__k") - F.col("__lo")).alias("__need"))
    j = d.join(F.broadcast(boundary), group, "left")
    at = F.col("__bb").isNotNull() & (F.col("__b") == F.col("__bb"))
    decided = j.where(~at).withColumn(flag, F.col("__bb").isNotNull() & (F.col("__b") < F.col("__bb")))
    edge = j.where(at)
    wedge = Window.partitionBy(*group).orderBy("__h", *keys)
    edge = edge.withColumn(flag, F.row_number().over(wedge) <= F.col("__need"))
    out = decided.unionByName(edge).drop("__h", "__b", "__bb", "__need")
    return out.drop("__g") if "__g" not in df.columns else out


def first_k_one_pass(df: DataFrame, k_of_n, group=(), key_cols="dr_no", seed: int = C.SEED,
                     flag: str = "__selected", levels: int = 14) -> DataFrame:
    """The flags of :func:`first_k_by_hash`, the rows left in their own partitions and read once.

    ``k_of_n`` maps the group's row count (a Column) to k. The k-th row is
    found without sorting a group in one task, on group and key columns alone:
    rows are bucketed by the top ``levels`` bits of their hash, bucket counts (a
    table bounded by 2^levels per group, small enough to be combined map-side)
    are prefix-summed to find the boundary bucket, and only rows of that bucket
    are put in order. Then the whole rows are compared with their group's k-th
    row, in one pass without a shuffle. Only rows equal to a k-th row that comes
    several times, of which some are selected, are numbered (a second pass), in
    the order of a hash of all columns.
    """
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    group = list(group)
    h = hash_key(keys, seed)
    d = df.withColumn("__place", F.struct(h.alias("h"), *keys))
    if not group:
        d = d.withColumn("__g", F.lit(0))
        group = ["__g"]
    narrow = d.select(*group, "__place", F.shiftright("__place.h", 64 - levels).alias("__b"))
    counts = narrow.groupBy(*group, "__b").agg(F.count(F.lit(1)).alias("__c"))
    n_group = counts.groupBy(*group).agg(F.sum("__c").alias("__n"))
    wcum = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    cum = (counts.join(F.broadcast(n_group), group)
           .withColumns({"__hi": F.sum("__c").over(wcum), "__k": k_of_n(F.col("__n")).cast("bigint")}))
    cum = cum.withColumn("__lo", F.col("__hi") - F.col("__c"))
    boundary = materialize(cum.where((F.col("__lo") < F.col("__k")) & (F.col("__hi") >= F.col("__k"))).select(
        *group, "__b", (F.col("__k") - F.col("__lo")).alias("__need")))
    wedge = Window.partitionBy(*group).orderBy("__place").rowsBetween(Window.unboundedPreceding, 0)
    edge = narrow.join(F.broadcast(boundary), [*group, "__b"]).groupBy(*group, "__need", "__place").agg(F.count(F.lit(1)).alias("__c"))
    edge = edge.withColumn("__take", F.col("__need") - F.sum("__c").over(wedge) + F.col("__c"))
    ends = materialize(edge.where((F.col("__take") > 0) & (F.col("__take") <= F.col("__c"))).select(
        *group, F.col("__place").alias("__end"), "__take", (F.col("__take") < F.col("__c")).alias("__part")))
    j = d.join(F.broadcast(ends), group, "left")
    upto = F.coalesce(F.col("__place") <= F.col("__end"), F.lit(False))
    out = j.withColumn(flag, upto)
    if not ends.where("__part").isEmpty():
        at = F.coalesce(F.col("__part") & (F.col("__place") == F.col("__end")), F.lit(False))
        wtied = Window.partitionBy(*group).orderBy(F.xxhash64(*df.columns))  # the same rows in every reading of the result
        tied = j.where(at).withColumn(flag, F.row_number().over(wtied) <= F.col("__take"))
        out = out.where(~at).unionByName(tied)
    out = out.drop("__place", "__end", "__take", "__part")
    return out.drop("__g") if "__g" not in df.columns else out


def exact_sample(df: DataFrame, n: int | None, key_cols="dr_no", seed: int = C.SEED, first_k=first_k_by_hash) -> DataFrame:
    """Exactly ``n`` rows (all rows if fewer), the first n in seeded hash order.

    Selection is a hash threshold found with bucket counts (see
    :func:`first_k_by_hash`), so no task ever merges n rows per partition.
    ``first_k`` names another way to the same rows (:func:`first_k_one_pass`).
    ``n=None`` keeps all rows.
    """
    if n is None:
        return df
    flagged = first_k(df, lambda cnt: F.least(cnt, F.lit(int(n))), (), key_cols, seed)
    return flagged.where(F.col("__selected")).drop("__selected")


def stratified_split(df: DataFrame, label: str, train_frac: float = 0.8, key_cols="dr_no",
                     seed: int = C.SEED, split_col: str = "split", levels: int = 20, first_k=first_k_by_hash) -> DataFrame:
    """Exact per-class train/test split by seeded hash order.

    Within each class the first ``round(train_frac * n_class)`` rows in
    (hash, key) order go to train (see :func:`first_k_by_hash`).
    """
    flagged = first_k(df, lambda cnt: F.round(cnt * F.lit(train_frac)), (label,), key_cols, seed, "__train", levels)
    return (flagged.withColumn(split_col, F.when(F.col("__train"), F.lit("train")).otherwise(F.lit("test")))
            .drop("__train"))


def forward_chained_split(p: DataFrame, test_days: int = 60, val_days: int = 60,
                          date: str = "date", unit_days: int = 1, split_col: str = "split") -> DataFrame:
    """train <= val_cutoff < val <= test_cutoff < test, cut-offs counted back
    from the latest date of ``p`` (one-row aggregate, broadcast)."""
    cut = p.agg(F.max(date).alias("__max")).select(
        F.date_sub("__max", test_days * unit_days).alias("__test_cut"),
        F.date_sub("__max", (test_days + val_days) * unit_days).alias("__val_cut"))
    d = F.col(date)
    return (p.crossJoin(F.broadcast(cut))
            .withColumn(split_col, F.when(d <= F.col("__val_cut"), "train")
                        .when(d <= F.col("__test_cut"), "val").otherwise("test"))
            .drop("__test_cut", "__val_cut"))


def union_history(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name; missing columns are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def distinct_pairs(df: DataFrame, cols, first_by=None) -> DataFrame:
    """Drop duplicates on a column subset.

    With ``first_by`` the kept row is the first in that order (pandas keeps
    the first occurrence); it is picked by an aggregate (``min_by``), which
    combines map-side, so a hot key never lands whole in one task.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    if first_by is None:
        return df.select(*cols).distinct()
    first_by = [first_by] if isinstance(first_by, str) else list(first_by)
    rest = [c for c in df.columns if c not in cols]
    if not rest:
        return df.select(*cols).distinct()
    picked = df.groupBy(*cols).agg(
        F.min_by(F.struct(*rest), F.struct(*first_by)).alias("__row"))
    return picked.select(*cols, *[F.col(f"__row.{c}").alias(c) for c in rest])


def area_code_map(df: DataFrame, id_col: str = "area_id", out: str = "area_code") -> DataFrame:
    """area id -> dense 0-based code in id order (the same map for fit and predict).

    Ranks the distinct ids, a table bounded by the number of areas.
    """
    ids = df.where(F.col(id_col).isNotNull()).select(id_col).distinct()
    return ids.withColumn(out, (F.dense_rank().over(Window.orderBy(id_col)) - 1).cast("int"))


def row_numbers(df: DataFrame, order, out: str = "number") -> DataFrame:
    """0-based positions of the rows in the order of the columns ``order`` (ties: any order).

    Rows are dealt in ranges of that order and stored; each range numbers its own rows, and
    the sizes of the ranges before it (one row a range) are added. No window holds all rows.
    """
    order = [order] if isinstance(order, str) else list(order)
    dealt = stored(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "row-numbers")
    sizes = dealt.groupBy("__range").agg(F.count(F.lit(1)).alias("__size"))
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("__range", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__before"))
    own = Window.partitionBy("__range").orderBy(*order)
    return (dealt.withColumn("__own", F.row_number().over(own)).join(F.broadcast(before), "__range")
            .withColumn(out, F.col("__before") + F.col("__own") - 1).drop("__range", "__own", "__before"))
