"""Operator 11: WARC archives with revisit records, and their capture index by external merge.

Writing: a row becomes a WARC/1.1 record around an HTTP response.  Of rows with equal payloads of at least ``least`` bytes, the
one of the smallest id is a response; the others are revisits (profile identical-payload-digest) without the payload.
Payloads never move by themselves: (digest, id) rows are aggregated, and only payloads that occur more than once come
back, as a written table that Spark joins by its measured size.

Reading: all records of an archive name the same random warcinfo record right after their version line.  These two
lines cannot be in a payload written before, so they are the reader's record separator: files are read record by record,
in parallel and split where they are not compressed, whatever their size.  Each record is checked against its length,
and each response's payload against its digest.

Index: tasks that read the archives sort bounded runs of captures by (URL key, time, id) and write them.  Runs are then cut
into ranges of that key, and each range of all runs is merged by a loser tree; ranges follow one another, so
the merged captures are ordered over the whole archive, and ``place`` numbers them.

Defined results: NULL payloads are empty, as are empty ones; a NULL id is larger than any other, and has no id in its record;
rows of equal id and payload are one capture seen several times: all of the smallest id are responses, and so are all where every id is
NULL; a NULL URL has the key ')'; blanks and control characters in a URL are escaped or, other than CR, LF, tab and space, left out;
without a time column, the time is EPOCH plus the id in seconds (modulo 10**9); an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portal_metrics.llm import common as C

#: Shortest payload that is not written again; captures of a run, and of a range of the merge.
LEAST, RUN_ROWS, RANGE_ROWS = 100, 50_000, 50_000
#: 2000-01-01T00:00:00Z.
EPOCH = 946_684_800
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CRLF = "\r\n"


def separator(archive: str) -> str:
    """The version line and the archive's name, with which every record starts."""
    return f"WARC/1.1{_CRLF}WARC-Warcinfo-ID: <urn:uuid:{archive}>{_CRLF}"


def url_key(url: Column) -> Column:
    """Host labels from the last to the first, then ')' and the rest: com,example,www)/path?query."""
    host = F.translate(F.regexp_extract(url, r"^[^:]*://([^/?#]*)", 1), _UPPER, _LOWER)
    rest = F.regexp_extract(url, r"^[^:]*://[^/?#]*(?s:(.*))$", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def _uri(url: Column) -> Column:
    for raw, said in (("\r", "%0D"), ("\n", "%0A"), ("\t", "%09"), (" ", "%20")):
        url = F.replace(url, F.lit(raw), F.lit(said))
    return F.regexp_replace(url, r"[\x00-\x1f\x7f]", "")


def _field(name: str, value: Column) -> Column:
    """A header line; none for a NULL value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(_CRLF)), F.lit(""))


def _record_id(archive: str, page: Column, digest: Column) -> Column:
    """A record id, from which a revisit can name its response."""
    h = F.md5(F.concat_ws(":", F.lit(archive), F.coalesce(page.cast("string"), F.lit("")), digest).cast("binary"))
    cut = [F.substring(h, s, n) for s, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  time_col: str | None = None, least: int = LEAST, compression: str | None = "gzip") -> str:
    """Write a record per row under ``path``; the archive's name, which readers need.  ``path``/warcinfo describes it."""
    archive = str(uuid.uuid4())
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    time = F.col(time_col) if time_col else F.timestamp_seconds(F.lit(EPOCH) + F.coalesce(F.pmod(F.col(id_col), F.lit(10 ** 9)), F.lit(0)))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), _uri(F.col(url_col)).alias("url"), payload.alias("payload"),
                        F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"), F.sha2(payload.cast("binary"), 256).alias("digest"))
    again = C.saved(rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("rows"))
                    .where("rows > 1 AND first IS NOT NULL").select("digest", "first"))
    rows = rows.join(again, "digest", "left")
    rows = rows.withColumn("refers", F.when(F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")), F.col("first")))
    new = F.col("refers").isNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}"), _field("Content-Length", F.octet_length("payload")), F.lit(_CRLF))
    block = F.concat(http, F.when(new, F.col("payload")).otherwise(""))
    record = F.concat(
        F.lit(separator(archive)), _field("WARC-Type", F.when(new, "response").otherwise("revisit")),
        _field("WARC-Record-ID", _record_id(archive, F.col("id"), F.col("digest"))), _field("WARC-Date", F.col("date")),
        _field("WARC-Target-URI", F.col("url")), _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _field("WARC-Page-ID", F.col("id")), _field("WARC-Profile", F.when(~new, PROFILE)),
        _field("WARC-Refers-To", F.when(~new, _record_id(archive, F.col("refers"), F.col("digest")))), _field("WARC-Refers-To-Page-ID", F.col("refers")),
        F.lit(f"Content-Type: application/http; msgtype=response{_CRLF}"), _field("Content-Length", F.octet_length(block)), F.lit(_CRLF),
        # the text writer's line end closes the record
        block, F.lit("\r\n\r"))
    options = {"compression": compression} if compression else {}
    rows.select(record).write.options(**options, lineSep="\n").text(f"{path}/records")
    said = f"software: portal_metrics{_CRLF}format: WARC File Format 1.1{_CRLF}"
    info = (f"WARC/1.1{_CRLF}WARC-Type: warcinfo{_CRLF}WARC-Record-ID: <urn:uuid:{archive}>{_CRLF}WARC-Date: 2000-01-01T00:00:00Z{_CRLF}"
            f"Content-Type: application/warc-fields{_CRLF}Content-Length: {len(said)}{_CRLF}{_CRLF}{said}\r\n\r")
    pages.sparkSession.createDataFrame([(info,)], "value string").coalesce(1).write.option("lineSep", "\n").text(f"{path}/warcinfo")
    return archive


def read_archive(spark: SparkSession, path: str, archive: str) -> DataFrame:
    """(page_id, url, date, record_type, refers_to, payload_bytes, payload_digest, payload) of every record; payload is NULL in revisits."""
    rows = spark.read.option("lineSep", separator(archive)).text(f"{path}/records").where("value <> ''")
    head = F.substring_index("value", _CRLF * 2, 1)
    block = F.substr(F.col("value"), F.length(head) + 5)
    rows = rows.select(F.concat(F.lit(_CRLF), head, F.lit(_CRLF)).alias("head"), block.alias("block"))

    def field(name: str, text: str = "head") -> Column:
        found = F.regexp_extract(text, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
        return F.when(found != "", found)

    whole = (F.octet_length("block") == field("Content-Length").cast("long") + 4) & F.endswith("block", F.lit(_CRLF * 2))
    block = F.when(whole, F.expr("left(block, length(block) - 4)")).otherwise(F.raise_error(F.lit("a WARC record differs from its Content-Length")))
    rows = rows.withColumn("block", block)
    http = F.substring_index("block", _CRLF * 2, 1)
    rows = rows.select(
        field("WARC-Page-ID").cast("long").alias("page_id"), field("WARC-Target-URI").alias("url"), field("WARC-Date").alias("date"),
        field("WARC-Type").alias("record_type"), field("WARC-Refers-To-Page-ID").cast("long").alias("refers_to"),
        F.concat(http, F.lit(_CRLF)).alias("http"), F.substring(field("WARC-Payload-Digest"), 8, 64).alias("said"),
        F.substr(F.col("block"), F.length(http) + 5).alias("payload"))
    new = F.col("record_type") == "response"
    digest = F.when(new, F.sha2(F.col("payload").cast("binary"), 256)).otherwise(F.col("said"))
    rows = rows.withColumn("payload_digest", digest)
    digest = F.when(F.col("payload_digest") == F.col("said"), F.col("payload_digest")).otherwise(F.raise_error(F.lit("a WARC payload differs from its digest")))
    return rows.select("page_id", "url", "date", "record_type", "refers_to",
                       F.when(new, F.octet_length("payload")).otherwise(field("Content-Length", "http")).cast("long").alias("payload_bytes"),
                       digest.alias("payload_digest"), F.when(new, F.col("payload")).alias("payload"))


_END = (1,)


class LoserTree:
    """Merge of k sorted sources: inner nodes hold the losers of their matches, so a step plays one match a level."""

    def __init__(self, sources: Iterable[Iterable[tuple]]):
        self.sources = [iter(s) for s in sources]
        self.heads = [self._next(i) for i in range(len(self.sources))]
        k = len(self.heads)
        self.loser = [-1] * max(k, 1)
        self.winner = 0
        for i in range(k):
            self._play(i)

    def _next(self, i: int) -> tuple:
        key = next(self.sources[i], None)
        return _END if key is None else (0, key, i)

    def _play(self, i: int) -> None:
        """Source ``i`` goes up from its leaf; where nobody waits yet, it waits."""
        node = (i + len(self.heads)) >> 1
        while node:
            other = self.loser[node]
            if other < 0:
                self.loser[node] = i
                return
            if self.heads[other] < self.heads[i]:
                self.loser[node], i = i, other
            node >>= 1
        self.winner = i

    def __iter__(self) -> Iterator[tuple[tuple, int]]:
        """(key, source), in order; equal keys by source."""
        while self.heads and self.heads[self.winner] is not _END:
            _, key, i = self.heads[self.winner]
            yield key, i
            self.heads[i] = self._next(i)
            self._play(i)


_INDEX = "url_key string, captured string, page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string"


def _key(table: pa.Table) -> list[tuple]:
    """(URL key, time, NULL id last, id) of each row."""
    ids = table.column("page_id").to_pylist()
    return list(zip(table.column("url_key").to_pylist(), table.column("captured").to_pylist(), [i is None for i in ids], [i or 0 for i in ids]))


def runs(captures: DataFrame, rows: int = RUN_ROWS) -> DataFrame:
    """Captures in sorted runs of at most ``rows``, numbered by run and place in it."""
    def work(batches):
        no = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []

        def sorted_run():
            nonlocal no
            t = pa.Table.from_batches(held)
            key = _key(t)
            t = t.take(pa.array(sorted(range(len(key)), key=key.__getitem__), pa.int64()))
            t = t.append_column("run", pa.array(np.full(len(t), no))).append_column("at", pa.array(np.arange(len(t))))
            no += 1
            held.clear()
            return t.combine_chunks().to_batches()

        for b in batches:
            for s in range(0, b.num_rows, rows):
                part = b.slice(s, rows)
                if held and sum(x.num_rows for x in held) + part.num_rows > rows:
                    yield from sorted_run()
                held.append(part)
        if held:
            yield from sorted_run()

    return captures.mapInArrow(work, f"{_INDEX}, run long, at long")


def merged(sorted_runs: DataFrame, rows: int = RANGE_ROWS) -> DataFrame:
    """The captures of all runs (saved) in one order: range by range, each merged by a loser tree; ``place`` counts from 0."""
    spark = sorted_runs.sparkSession
    total = sorted_runs.count()
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // rows))
    dealt = sorted_runs.repartitionByRange(ranges, "url_key", "captured", F.col("page_id").asc_nulls_last(), "run", "at").sortWithinPartitions("run", "at")

    def work(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held).combine_chunks()
        run = np.asarray(t.column("run"))
        starts = np.concatenate([[0], np.flatnonzero(run[1:] != run[:-1]) + 1, [len(run)]]).tolist()
        key = _key(t)
        at = starts[:-1]
        order = np.empty(len(run), np.int64)
        for k, (_, i) in enumerate(LoserTree(key[s:e] for s, e in zip(starts, starts[1:]))):
            order[k] = at[i]
            at[i] += 1
        t = t.take(pa.array(order)).select(names).append_column("range", pa.array(np.full(len(run), TaskContext.get().partitionId())))
        yield from t.append_column("in_range", pa.array(np.arange(len(run)))).combine_chunks().to_batches()

    names = [f.split()[0] for f in _INDEX.split(", ")]
    index = C.saved(dealt.mapInArrow(work, f"{_INDEX}, range long, in_range long"))
    # one row a range
    before = index.groupBy("range").agg(F.count("*").alias("n"))
    before = before.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))
    return index.join(F.broadcast(before), "range").select(*names, (F.col("before") + F.col("in_range")).alias("place"))


def capture_index(records: DataFrame, run_rows: int = RUN_ROWS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """url_key, captured, page_id, record_type, refers_to, payload_bytes, payload_digest, place of every record of an archive."""
    captures = records.select(F.coalesce(url_key(F.col("url")), F.lit(")")).alias("url_key"), F.col("date").alias("captured"), "page_id", "record_type",
                              "refers_to", "payload_bytes", "payload_digest")
    return merged(C.saved(runs(captures, run_rows)), range_rows)


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url_key, captured, place of every page."""
    path = C.scratch_dir(spark)
    archive = write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return capture_index(read_archive(spark, path, archive)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "place")


OP11_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, regexp_replace(replace(replace(replace(replace(url, chr(13), '%0D'), chr(10), '%0A'),
    chr(9), '%09'), ' ', '%20'), '[\x00-\x1f\x7f]', '', 'g') AS url FROM pages),
f AS (SELECT html, min(page_id) AS first FROM p WHERE strlen(html) >= 100 GROUP BY html HAVING count(*) > 1),
r AS (SELECT p.page_id, strlen(p.html) AS payload_bytes, sha256(p.html) AS payload_digest,
  CASE WHEN f.first IS NOT NULL AND p.page_id IS DISTINCT FROM f.first THEN f.first END AS refers_to,
  coalesce(array_to_string(list_reverse(string_split(translate(regexp_extract(p.url, '^[^:]*://([^/?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '.')), ','), '') || ')' ||
    coalesce(regexp_extract(p.url, '(?s)^[^:]*://[^/?#]*(.*)$', 1), '') AS url_key,
  strftime(to_timestamp(946684800 + coalesce(((p.page_id % 1000000000) + 1000000000) % 1000000000, 0)) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS captured
  FROM p LEFT JOIN f ON p.html = f.html)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to, url_key, captured,
  row_number() OVER (ORDER BY url_key, captured, page_id NULLS LAST) - 1 AS place
FROM r
"""
