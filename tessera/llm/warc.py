"""Operator 4: WARC archives with deduplicated payloads and an externally merged capture index.

Writing.  The payload digest of every page is grouped with its smallest page id: that page becomes a response record, later
pages with the same payload become revisit records that refer to it.  Each writer task sorts its captures by (URL key,
timestamp, page id) and writes them as one archive, so every archive is a locally sorted run.  Archives are
written by Spark's text writer: a record is one value, and the line separator is the blank lines that end a WARC record.  An
archive is one gzip stream; offsets and lengths in the index are those of the records inside it.

Reading.  Whole archives are read by Spark, records are cut by their Content-Length, response payloads are digested again and
compared with the header.  The index entries of an archive come in run order.

Merging.  Entries are range-partitioned by (URL key, timestamp, page id), so a hot URL spans several ranges; every range
holds a segment of each run, and a loser tree merges the k segments.  Ranges in order give the globally ordered captures.

Bounded: archives hold about ``archive_bytes`` of payload (one page at least), ranges about ``range_rows`` entries; payloads are
shuffled once, by page.

Defined cases: a null html is an empty payload; a null url has an empty key and no target header; pages with null id are responses
that nothing refers to unless a page with an id has their payload; repeated rows are captures like others; an
empty table gives no archives and no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
from uuid import uuid4

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

END = "\r\n\r\n"  # between header and block, and after a record
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
ENTRY = ("run string, offset long, length long, page_id long, url string, ts timestamp, payload_bytes long, payload_digest string, "
         "record_type string, refers_to long")


def url_key(url: Column) -> Column:
    """Host labels in reverse order, then path and query: com,example,www)/a?b=1; scheme, user, port and fragment are left out."""
    bare = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://|#.*$", "")
    host = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*", 0), r"^.*@|:[0-9]*$", "")
    rest = F.regexp_extract(bare, r"^[^/?]*(.*)$", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def _base32(hexes: pd.Series) -> pd.Series:
    return hexes.map(lambda h: base64.b32encode(bytes.fromhex(h)).decode())


def _header(*fields: tuple[str, Column]) -> Column:
    """Lines of a header; a field whose value is null is left out."""
    return F.concat(*[F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value.cast("string")), F.lit("")) for name, value in fields])


def records(pages: DataFrame, min_bytes: int, parts: int) -> DataFrame:
    """(key, ts, page_id, value): every page as a WARC record, without the blank lines at its end, in ``parts`` sorted runs."""
    rows = pages.select("page_id", F.translate("url", "\r\n", "  ").alias("url"), "ts", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1("html")).withColumn("bytes", F.octet_length("html"))
    # the page id as a key that is never null, so that the payloads' own exchange serves the join
    rows = rows.withColumn("pk", F.coalesce(F.concat(F.lit("="), F.col("page_id").cast("string")), F.lit("")))
    firsts = rows.where(F.col("bytes") >= min_bytes).groupBy("sha").agg(F.min("page_id").alias("first"))
    refers = (rows.select("page_id", "pk", "sha").distinct().join(firsts, "sha")
              .where(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))).select("pk", "sha", "first"))
    r = rows.repartition(parts, "pk", "sha").join(refers.hint("shuffle_hash"), ["pk", "sha"], "left")
    again = F.col("first").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    block = F.concat(http, F.when(again, "").otherwise(F.col("html")))
    urn = lambda c: F.concat(F.lit("<urn:x-page:"), c.cast("string"), F.lit(">"))
    head = _header(("WARC-Type", F.when(again, "revisit").otherwise("response")), ("WARC-Record-ID", urn(F.col("page_id"))),
                   ("WARC-Date", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")), ("WARC-Target-URI", F.col("url")),
                   ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.pandas_udf(_base32, "string")("sha"))), ("WARC-Refers-To", urn(F.col("first"))),
                   ("WARC-Profile", F.when(again, PROFILE)), ("Content-Type", F.lit("application/http; msgtype=response")),
                   ("Content-Length", F.octet_length("block")))
    return (r.withColumn("block", block).select(url_key(F.col("url")).alias("key"), "ts", "page_id",
                                                F.concat(F.lit("WARC/1.0"), head, F.lit(END), F.col("block")).alias("value"))
            .sortWithinPartitions("key", "ts", "page_id"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, archive_bytes: int = 16 << 20) -> None:
    """Writes ``pages`` (page_id, url, html, ts) as WARC archives into the folder ``path``."""
    size = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    parts = max(1, math.ceil(size / archive_bytes))
    records(pages, min_bytes, parts).select("value").write.option("lineSep", END).option("compression", "gzip").text(path)


def parse_archive(run: str, data: bytes):
    """Index entries of an archive; raises ValueError when a record is cut off or a payload does not fit its digest."""
    at = 0
    while at < len(data):
        start = data.index(END.encode(), at)
        lines = data[at:start].decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        end = start + len(END) + int(fields["Content-Length"])
        if lines[0] != "WARC/1.0" or data[end:end + len(END)] != END.encode():
            raise ValueError(f"broken record at {at} of {run}")
        http, payload = data[start + len(END):end].split(END.encode(), 1)
        size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
        digest, number = fields["WARC-Payload-Digest"].removeprefix("sha1:"), lambda name: int(v[12:-1]) if (v := fields.get(name)) else None
        if fields["WARC-Type"] == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
            raise ValueError(f"payload at {at} of {run} does not fit its digest")
        yield (run, at, end + len(END) - at, number("WARC-Record-ID"), fields.get("WARC-Target-URI"),
               pd.Timestamp(d.rstrip("Z")) if (d := fields.get("WARC-Date")) else None, size, digest, fields["WARC-Type"], number("WARC-Refers-To"))
        at = end + len(END)


def _parse(batches):
    names = [x.split()[0] for x in ENTRY.split(", ")]
    for pdf in batches:
        for run, data in zip(pdf["path"], pdf["content"]):
            rows = pd.DataFrame(list(parse_archive(run, gzip.decompress(data))), columns=names)
            yield rows.astype({c: "Int64" for c in ("page_id", "refers_to")}).assign(ts=pd.to_datetime(rows["ts"]))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of all archives in ``path``, each archive's in its own order."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInPandas(_parse, ENTRY).withColumn("url_key", url_key(F.col("url")))


class LoserTree:
    """Merges sorted lists: every inner node keeps the loser of its match, the winner moves on; a step costs log2 k matches."""

    def __init__(self, runs: list[list]):
        self.runs, self.k = runs, max(1, len(runs))
        self.at = [0] * self.k
        self.losers = [0] * self.k
        winners = [0] * self.k + list(range(self.k))
        for node in range(self.k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.winner = winners[1] if self.k > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        done_a, done_b = self.at[a] >= len(self.runs[a]), self.at[b] >= len(self.runs[b])
        if done_a or done_b:
            return not done_a
        return (self.runs[a][self.at[a]], a) < (self.runs[b][self.at[b]], b)

    def __iter__(self):
        while self.runs and self.at[self.winner] < len(self.runs[self.winner]):
            w = self.winner
            yield self.runs[w][self.at[w]]
            self.at[w] += 1
            node = (w + self.k) // 2
            while node >= 1 and self.k > 1:
                if self._before(self.losers[node], w):
                    self.losers[node], w = w, self.losers[node]
                node //= 2
            self.winner = w


def _merge(batches):
    """Captures of one range, merged from the segments of its runs."""
    parts = [pdf for pdf in batches if len(pdf)]
    if not parts:
        return
    rows = pd.concat(parts, ignore_index=True)
    low = -(1 << 63)
    keys = list(zip(rows["url_key"], rows["ts"].astype("int64").where(rows["ts"].notna(), low), rows["page_id"].fillna(low).astype("int64"), range(len(rows))))
    runs: dict[str, list] = {}
    for run, key in zip(rows["run"], keys):
        runs.setdefault(run, []).append(key)
    for segment in runs.values():
        if any(a > b for a, b in zip(segment, segment[1:])):
            segment.sort()  # a shuffle need not keep the order of a run
    order = [key[-1] for key in LoserTree([runs[r] for r in sorted(runs)])]
    yield rows.iloc[order]


def merge_index(entries: DataFrame, range_rows: int = 100_000) -> DataFrame:
    """The entries in global order of (url_key, ts, page_id): sorted inside a partition, and partitions in order."""
    parts = max(1, math.ceil(entries.count() / range_rows))
    return entries.repartitionByRange(parts, "url_key", "ts", "page_id").mapInPandas(_merge, entries.schema)


def archive_and_index(pages: DataFrame, path: str | None = None, **kw) -> DataFrame:
    """Writes the archives, reads them back and returns the merged index."""
    spark = pages.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark)}/warc-{uuid4().hex}"
    write_archives(pages, f"{path}/archives", **kw)
    read_archives(spark, f"{path}/archives").write.parquet(f"{path}/runs")
    return merge_index(spark.read.parquet(f"{path}/runs"))


ORACLE = """WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, cast(strlen(html) AS bigint) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (cast('0x' || substr(h, cast(i // 4 * 5 + 1 AS bigint), 5) AS bigint) >> cast(15 - 5 * (i % 4) AS bigint)) % 32 + 1, 1)), '')
    AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f USING (h)"""
