"""WARC round trip and Merkle audit: SQL oracle, every planted fault found, edge rows."""

import gzip
import hashlib
import os
import random

from citypulse.llm import queries, warc_fixity
from citypulse.llm.common import scratch, table
from conftest import SF001, SMOKE
from oracle import compare, duck


def test_query_matches_sql(spark):
    rep = compare(spark, "op9", queries.QUERIES["op9_warc_fixity"], queries.ORACLES["op9_warc_fixity"], SF001, duck(SF001))
    assert rep["ok"], rep


def local_files(path):
    path = path.removeprefix("file:")
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".gz"))


def test_round_trip_and_any_flipped_byte(spark):
    pages = table(spark, SMOKE, "pages").select("page_id", "url", "html")
    recs = warc_fixity.records(pages, per_archive=60)
    paths = [scratch(spark, "warc-test") for _ in range(2)]
    for p in paths:
        warc_fixity.write_archives(recs, p)
    want = {hashlib.sha256((r["record"] + warc_fixity.END).encode()).hexdigest() for r in recs.collect()}
    files = [warc_fixity.archive_files(spark, p) for p in paths]
    rows = warc_fixity.read_records(files[0]).collect()
    assert {r["hash"] for r in rows} == want and len(rows) == len(want)
    assert {r["status"] for r in warc_fixity.audit(*files).collect()} == {"ok"}
    rng = random.Random(2)
    damaged = {}
    for f in local_files(paths[1])[::2]:
        archive = int(f.split("archive=")[1].split("/")[0])
        data = bytearray(gzip.decompress(open(f, "rb").read()))
        spots = [rng.randrange(len(data) * 3 // 4) for _ in range(3)]
        for s in spots:
            data[s] ^= 1
        del data[len(data) * 9 // 10:]
        open(f, "wb").write(gzip.compress(bytes(data)))
        crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
        damaged[archive] = (spots, len(data))
    for r in warc_fixity.audit(*[warc_fixity.archive_files(spark, p) for p in paths], fanout=4).collect():
        spots, size = damaged.get(r["archive"], ([], 1 << 60))
        end = r["offset"] + r["length"]
        status = "missing" if end > size else "corrupt" if any(r["offset"] <= s < end for s in spots) else "ok"
        assert r["status"] == status


def test_edge_rows(spark):
    body = "text with an empty line\r\n\r\nWARC/1.0\r\nContent-Length: 5\r\n\r\ninside"
    rows = [(1, "u", body), (1, "u", body), (2, None, None), (None, "a\r\nb", ""), (3, "u", "é" * 200_000), (2, "u", body)]
    df = spark.createDataFrame([(*r, 7) for r in rows], "page_id long, url string, html string, copies int")
    got = {(r["page_id"], r["copies"], r["length"] > 100_000) for r in warc_fixity.query(df).collect()}
    assert got == {(1, 2, False), (2, 1, False), (None, 1, False), (3, 1, True)}
    assert warc_fixity.query(df).count() == 5
    assert warc_fixity.query(df.limit(0)).collect() == []
