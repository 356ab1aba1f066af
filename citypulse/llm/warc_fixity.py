"""WARC archives and a Merkle audit of their replicas.

*Writing.* Pages become WARC ``resource`` records in archives of about
``PER_ARCHIVE`` records (an archive is a gzip file that ends every record with an
empty line, as the format asks). Identical pages are one record with a count,
combined before the shuffle, so copies never pile up in one archive.

*Audit.* The records of the first replica give the ordered offset ranges. Each
range is hashed in both replicas; ranges are the leaves of one tree per archive
and replica, every inner node hashing ``FANOUT`` children in order. Roots are
compared, and only children of differing nodes are looked at on the way down,
so what is compared follows the damage, not the archive.

A range that the other replica does not have whole is ``missing``; one that has
other bytes is ``corrupt``. Bytes that shift in the second replica count as
corrupt up to its end. Null html is an empty block, a null url or id an empty
header. Damaged headers in the first replica are skipped up to the next record.
"""

from __future__ import annotations

import gzip
import hashlib
import math
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse.llm.common import saved, scratch, shuffles_dropped

PER_ARCHIVE = 2000
FANOUT = 16
END = "\r\n\r\n"
_START = re.compile(rb"(?:\A|\r\n\r\n)(?=WARC/1\.0\r\n)")
_LENGTH = re.compile(rb"\r\nContent-Length: (\d+)")
_PAGE = re.compile(rb"\r\nX-Page-Id: ([^\r\n]*)")
_COPIES = re.compile(rb"\r\nX-Copies: (\d+)")


def record(key: Column, page_id: Column, url: Column, html: Column, copies: Column) -> Column:
    """A WARC record without the empty line that ends it."""
    line = lambda name, value: F.concat(F.lit(f"\r\n{name}: "), value)
    one_line = lambda c: F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), "[\r\n]", " ")
    block = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0"), line("WARC-Type", F.lit("resource")), line("WARC-Record-ID", F.concat(F.lit("<urn:md5:"), key, F.lit(">"))),
        line("WARC-Target-URI", one_line(url)), line("X-Page-Id", one_line(page_id)), line("X-Copies", copies.cast("string")),
        line("Content-Type", F.lit("text/html; charset=utf-8")), line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(END), block)


def page_key() -> Column:
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    return F.md5(F.concat_ws("\n", part("page_id"), part("url"), part("html")).cast("binary"))


def hex_number(key: Column, at: int, digits: int) -> Column:
    return F.conv(F.substring(key, at, digits), 16, 10).cast("long")


def records(pages: DataFrame, per_archive: int = PER_ARCHIVE) -> DataFrame:
    """(archive, key, record) of ``pages`` (page_id, url, html)."""
    archives = max(1, math.ceil(pages.count() / per_archive))
    keyed = pages.select("page_id", "url", "html", page_key().alias("key"))
    # only keys are counted, so that pages without a copy are shuffled once, to their archive
    repeated = saved(keyed.groupBy("key").agg(F.count("*").alias("copies")).where("copies > 1"), "warc-copies")
    page = F.struct("page_id", "url", "html").alias("p")
    single = keyed.join(repeated, "key", "left_anti").select("key", F.lit(1).cast("long").alias("copies"), page)
    several = keyed.join(repeated, "key").groupBy("key", "copies").agg(F.any_value(page).alias("p"))
    return single.union(several).select(
        (hex_number(F.col("key"), 1, 8) % archives).alias("archive"), "key",
        record(F.col("key"), F.col("p.page_id"), F.col("p.url"), F.col("p.html"), F.col("copies")).alias("record"))


def write_archives(recs: DataFrame, path: str, *parts: str, change: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Write (archive, key, record) as ``<path>/<parts>/archive=N/*.txt.gz``, records in order
    of their key. ``change`` may replicate or alter the records once they are in place."""
    placed = recs.repartition("archive")
    placed = (change(placed) if change else placed).sortWithinPartitions(*parts, "archive", "key")
    with shuffles_dropped(recs.sparkSession):
        (placed.select(*parts, "archive", F.col("record").alias("value"))
         .write.partitionBy(*parts, "archive").option("lineSep", END).option("compression", "gzip").text(path))


def _parse(data: bytes):
    """(offset, length with the ending empty line, header) of every record that can be read."""
    at = 0
    while True:
        start = _START.search(data, at)
        if not start:
            return
        begin = start.end()
        head = data.find(b"\r\n\r\n", begin)
        size = _LENGTH.search(data, begin, head if head >= 0 else begin)
        if size is None:
            at = begin + 1
            continue
        end = head + 4 + int(size[1])
        yield begin, end + 4 - begin, data[begin:head]
        at = max(end, begin + 1)


def archive_files(spark: SparkSession, path: str, *parts: str) -> DataFrame:
    """(parts, archive, content) of the files that :func:`write_archives` wrote below ``path``
    (one at least)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").load(path)
    return files.select(*parts, F.col("archive").cast("long").alias("archive"), "content")


def read_records(files: DataFrame) -> DataFrame:
    """(archive, pos, offset, length, page_id, copies, hash) of archives (archive, content)."""
    def run(batches):
        for batch in batches:
            for archive, content in zip(batch.column(0), batch.column(1)):
                data = gzip.decompress(content.as_py())
                rows = [(archive.as_py(), k, o, n, _field(_PAGE, h), int(_field(_COPIES, h) or 1),
                         hashlib.sha256(data[o:o + n]).hexdigest()) for k, (o, n, h) in enumerate(_parse(data))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 7, kinds)], names=names)

    names = ["archive", "pos", "offset", "length", "page_id", "copies", "hash"]
    kinds = [pa.int64()] * 4 + [pa.string(), pa.int64(), pa.string()]
    return files.select("archive", "content").mapInArrow(
        run, "archive long, pos long, offset long, length long, page_id string, copies long, hash string")


def _field(pattern: re.Pattern, header: bytes) -> str | None:
    m = pattern.search(header)
    return m[1].decode("utf-8", "replace") or None if m else None


def hash_ranges(files: DataFrame, ranges: DataFrame) -> DataFrame:
    """(archive, pos, hash) of given ``ranges`` (archive, pos, offset, length) in archives
    (archive, content); no row for a range that is not whole there."""
    wanted = ranges.groupBy("archive").agg(F.collect_list(F.struct("pos", "offset", "length")).alias("ranges"))

    def run(batches):
        for batch in batches:
            for archive, content, parts in zip(*batch.columns):
                data = gzip.decompress(content.as_py())
                rows = [(archive.as_py(), r["pos"], hashlib.sha256(data[r["offset"]:r["offset"] + r["length"]]).hexdigest())
                        for r in parts.as_py() if r["offset"] + r["length"] <= len(data)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))],
                    names=["archive", "pos", "hash"])

    return (files.join(wanted, "archive").select("archive", "content", "ranges")
            .mapInArrow(run, "archive long, pos long, hash string"))


def locate(leaves: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(archive, pos) of the leaves whose hashes a and b differ. ``leaves``: (archive, pos,
    a, b), b null where the second replica has nothing."""
    levels = [leaves.select("archive", F.col("pos").alias("node"), "a", F.coalesce("b", F.lit("")).alias("b"))]
    width = (leaves.agg(F.max("pos")).first()[0] or 0) + 1
    while width > 1:
        children = F.array_sort(F.collect_list(F.struct("node", "a", "b")))  # fanout of them at most
        levels.append(levels[-1].groupBy("archive", F.expr(f"node div {fanout}").alias("parent")).agg(children.alias("c"))
                      .select("archive", F.col("parent").alias("node"),
                              *[F.sha2(F.array_join(F.transform("c", _side(s)), "").cast("binary"), 256).alias(s) for s in "ab"]))
        width = -(-width // fanout)
    bad = levels[-1].where("a != b").select("archive", "node")
    for level in reversed(levels[:-1]):
        parents = bad.select("archive", F.col("node").alias("parent"))
        bad = (level.withColumn("parent", F.expr(f"node div {fanout}")).join(parents, ["archive", "parent"])
               .where("a != b").select("archive", "node"))
    return bad.select("archive", F.col("node").alias("pos"))


def _side(name: str):
    return lambda x: x[name]


def audit(files_a: DataFrame, files_b: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Every record of the replica ``files_a`` (archive, content) with the columns of
    :func:`read_records` and its ``status`` in ``files_b``: ok, corrupt or missing."""
    first = saved(read_records(files_a), "warc-a")
    second = hash_ranges(files_b, first.select("archive", "pos", "offset", "length"))
    leaves = saved(first.select("archive", "pos", F.col("hash").alias("a")).join(
        second.withColumnRenamed("hash", "b"), ["archive", "pos"], "left"), "warc-leaves")
    bad = locate(leaves, fanout).join(leaves, ["archive", "pos"]).select(
        "archive", "pos", F.when(F.col("b").isNull(), "missing").otherwise("corrupt").alias("status"))
    return first.join(bad, ["archive", "pos"], "left").withColumn("status", F.coalesce("status", F.lit("ok")))


def with_faults(recs: DataFrame) -> DataFrame:
    """Two replicas of ``recs`` (column ``replica``), the second with planted faults: a changed
    byte in one of 256 records, and every seventh archive without its last records."""
    faulty = hex_number(F.col("key"), 9, 4) % 256 == 0
    cut_off = (F.col("archive") % 7 == 3) & (F.col("key") >= "ff")
    flipped = F.when((F.col("replica") == "b") & faulty, F.replace("record", F.lit("WARC-Type: resource"), F.lit("WARC-Type: resourcf")))
    return (recs.withColumn("replica", F.explode(F.array(F.lit("a"), F.lit("b"))))
            .where((F.col("replica") == "a") | ~cut_off).withColumn("record", flipped.otherwise(F.col("record"))))


def query(pages: DataFrame) -> DataFrame:
    """Write all pages as two replicas of WARC archives, the second with planted faults, and audit them."""
    spark = pages.sparkSession
    if pages.isEmpty():
        return spark.createDataFrame([], "page_id long, copies long, archive long, pos long, offset long, length long, "
                                         "hash string, status string")
    path = scratch(spark, "warc")
    write_archives(records(pages.select("page_id", "url", "html")), path, "replica", change=with_faults)
    files = archive_files(spark, path, "replica")
    return audit(files.where("replica = 'a'"), files.where("replica = 'b'")).select(
        F.col("page_id").cast("long").alias("page_id"), "copies", "archive", "pos", "offset", "length", "hash", "status")


_LINE = "chr(13) || chr(10) ||"
ORACLE_SQL = f"""
WITH k AS (SELECT page_id, url, coalesce(html, '') AS html, md5(coalesce('=' || page_id, '-') || chr(10) || coalesce('=' || url, '-')
    || chr(10) || coalesce('=' || html, '-')) AS key FROM pages),
d AS (SELECT key, count(*) AS copies, any_value(page_id) AS page_id, any_value(url) AS url, any_value(html) AS html FROM k GROUP BY key),
r AS (SELECT key, copies, page_id, ('0x' || substr(key, 1, 8))::BIGINT % (SELECT greatest(1, ceil(count(*) / {PER_ARCHIVE})::BIGINT) FROM pages) AS archive,
  'WARC/1.0' || {_LINE} 'WARC-Type: resource' || {_LINE} 'WARC-Record-ID: <urn:md5:' || key || '>'
  || {_LINE} 'WARC-Target-URI: ' || coalesce(regexp_replace(url, '[\\r\\n]', ' ', 'g'), '') || {_LINE} 'X-Page-Id: ' || coalesce(page_id::VARCHAR, '')
  || {_LINE} 'X-Copies: ' || copies || {_LINE} 'Content-Type: text/html; charset=utf-8'
  || {_LINE} 'Content-Length: ' || strlen(html) || {_LINE} {_LINE} html || {_LINE} chr(13) || chr(10) AS rec FROM d),
o AS (SELECT *, row_number() OVER w - 1 AS pos, strlen(rec) AS length,
  coalesce(sum(strlen(rec)) OVER (PARTITION BY archive ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "offset"
  FROM r WINDOW w AS (PARTITION BY archive ORDER BY key))
SELECT page_id, copies, archive, pos, "offset"::BIGINT AS "offset", length, sha256(rec) AS hash,
  CASE WHEN archive % 7 = 3 AND key >= 'ff' THEN 'missing' WHEN ('0x' || substr(key, 9, 4))::BIGINT % 256 = 0 THEN 'corrupt' ELSE 'ok' END AS status
FROM o
"""
