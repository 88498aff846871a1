"""WARC archives with identical-payload revisits, and their index merged from sorted runs.

Writing. Payloads are told by their SHA-256; of equal ones of at least ``least`` bytes the page with the
smallest id becomes a response record, the others revisit it. A record is one text row; the record
separator of the format is the line separator of the text writer, so files are committed as any of
Spark's output and survive lost tasks. Pages are written by the tasks that scan them; only payloads far longer
than the mean are dealt out anew, so that no archive file grows with its longest records.

Reading. Every archive file is cut by the records' own lengths, payloads are digested anew, and the
captures of a task form a run, sorted (and spilled, where it is long) by URL key, time and record. Boundaries
between ranges come from a bounded sample of the captures. Runs are read in batches, each of which sends every
range its sorted slice, and the range's task merges the slices with a loser tree, so the ranges in order are one
ordered history of all captures. A URL captured very often spreads over ranges by time and record. A payload
longer than a file should be has a file of its own; a task holds one file at a time.

A null payload is the empty payload; equal empty payloads revisit each other if ``least`` is 0. A null URL
has the empty key. Control characters of a URL are percent-encoded in the archive. Rows with a null id
are written without one and read back so; they come last among equals and share one place there. A page
repeated with the same id and payload is a response each time. An empty table gives no archive and an
empty index. Capture times come from a column if one is named, in UTC; a null time, or no such column, is the fixed
date, and then captures of a URL stand in the order of their ids. Columns other than those named are not read, so their names cannot clash.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import itertools
import re
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medalstar.llm.common import ROW, among_first, broadcast_if_few, map_arrow, ship, small_batches, staged, with_rows
from medalstar.session import new_shared_folder

# Separator of records, digits of base 32 and the signs that stand for them in digests.
SEPARATOR = "\r\n\r\n"
_DIGITS, _SIGNS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 16 << 20  # that an archive file has on average at most, unless one record is larger
LONG = 16  # times the mean size beyond which a page is not written where it is read
RANGE_CAPTURES = 200_000  # captures a range should have
SAMPLE = 20_000  # captures from which the boundaries of ranges are taken
CAPTURE = (
    "urlkey string, time string, page_id {id}, url string, record_type string, refers_to {id}, "
    "payload_bytes bigint, payload_digest string, file string, offset bigint, length bigint")


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 160 bits are four times ten hex digits, eight base-32 digits each."""
    hexed = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexed, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), _DIGITS, _SIGNS)


def warc_date(time: Column, date: str) -> Column:
    """Capture time as a WARC date with microseconds, so that dates as texts stand in the order of time."""
    return F.date_format(F.coalesce(time.cast("timestamp"), F.to_timestamp(F.lit(date))), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def with_revisits(
    pages: DataFrame, page_id: str, payload: str, least: int, date: str = "2025-01-01T00:00:00Z", time: str | None = None
) -> DataFrame:
    """``page_id``, ``url`` and payload as text, ``date``, ``name`` that tells the row, and the page that a revisit refers to."""
    # Name and content stay the same whenever a task is tried again; rows that repeat a page differ in their place.
    rows = with_rows(pages).select(
        F.col(page_id).alias("page_id"), "url", F.coalesce(payload, F.lit("")).alias("payload"),
        (F.lit(date) if time is None else warc_date(F.col(time), date)).alias("date"),
        F.sha1(F.to_json(F.struct(F.col(page_id).alias("a"), F.col("url").alias("b"), F.sha2(F.coalesce(payload, F.lit("")), 256).alias("c"),
                                  F.col(ROW).alias("d")))).alias("name"))
    rows = rows.withColumn("content", F.unhex(F.sha2("payload", 256)))
    # Only contents that repeat take part in the join; copies collapse before the shuffle.
    repeated = rows.filter(F.octet_length("payload") >= least).groupBy("content").agg(
        F.min("page_id").alias("original"), F.count("*").alias("copies")).filter("copies > 1").drop("copies")
    repeated = broadcast_if_few(staged(repeated, "repeated"), 128)
    joined = rows.join(repeated, "content", "left").drop("content")
    other = F.col("page_id").isNull() | (F.col("page_id") != F.col("original"))
    return joined.withColumn("refers_to", F.when(F.col("original").isNotNull() & other, F.col("original"))).drop("original")


def record_id(name: Column) -> Column:
    """A name-based UUID (version 5) from a SHA-1 in hex."""
    part = lambda at, n: F.substring(name, at, n)
    variant = F.translate(part(17, 1), _DIGITS[:16].lower(), "89ab" * 4)
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(18, 3),
                    F.lit("-"), part(21, 12))


def record() -> Column:
    """A whole record but for its closing separator."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))
    optional = lambda name, value: F.coalesce(line(name, value), F.lit(""))
    revisit = F.col("refers_to").isNotNull()
    length = F.octet_length("payload")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    length.cast("string"), F.lit(SEPARATOR))
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    # Control characters would end a header line, and a percent sign marks an encoded one.
    url = F.regexp_replace("url", "%", "%25")
    for code in (*range(0x20), 0x7F):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), record_id(F.col("name")), F.lit(">"))),
        optional("WARC-Target-URI", url),
        line("WARC-Date", F.col("date")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("payload")))),
        F.when(revisit, line("WARC-Profile", F.lit(PROFILE))).otherwise(F.lit("")),
        optional("X-Page-Id", F.col("page_id")), optional("X-Refers-To-Page", F.col("refers_to")),
        optional("X-Payload-Length", F.when(revisit, length)),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length(block)), F.lit("\r\n"))
    return F.concat(head, block)


def write_archives(
    pages: DataFrame, path: str, page_id: str = "page_id", payload: str = "html", least: int = 0,
    date: str = "2025-01-01T00:00:00Z", time: str | None = None,
) -> None:
    """Write one record per page below ``path``, captured at ``time``; at ``date`` without that column or a value."""
    records = with_revisits(pages, page_id, payload, least, date, time)
    bytes_ = F.coalesce(F.octet_length(payload), F.lit(0)) + 1024
    facts = pages.agg(F.sum(bytes_).alias("all"), F.count("*").alias("n"), F.max(bytes_).alias("most")).first()
    mean = max(1, (facts["all"] or 0) // max(1, facts["n"]))
    if (facts["most"] or 0) > LONG * mean:
        # Dealt out by name: a task tried again sends every record where it went before.
        long = F.octet_length("payload") + 1024 > LONG * mean
        held = pages.filter(bytes_ > LONG * mean).agg(F.sum(bytes_)).first()[0]
        records = records.filter(~long).unionByName(
            records.filter(long).repartition(max(1, held // FILE_BYTES), F.xxhash64("name")))
    writer = records.select(record().alias("value")).write
    writer.option("lineSep", SEPARATOR).option("maxRecordsPerFile", max(1, FILE_BYTES // mean)).text(path)


def parse(data: bytes) -> Iterator[tuple[int, int, dict, bytes]]:
    """(offset, length, headers, block) of every record of an archive file."""
    at = 0
    while at < len(data):
        end = data.index(SEPARATOR.encode(), at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at offset {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        begin = end + len(SEPARATOR)
        stop = begin + int(headers["Content-Length"])
        yield at, stop - at, headers, data[begin:stop]
        at = stop + len(SEPARATOR)


def url_key(url: str | None) -> str:
    """The host's parts from the top down, then path and query: captures of a site stand together."""
    if not url:
        return ""
    try:
        parts = urlsplit(url)
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return url
    default = {"http": 80, "https": 443}.get(parts.scheme)
    shown = ",".join(reversed(host.split("."))) + (f":{port}" if port not in (None, default) else "")
    return f"{shown}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


_ENCODED = re.compile(r"%(25|[01][0-9A-F]|7F)")


def captures(spark: SparkSession, path: str, id_type: str) -> DataFrame:
    """One row per record of the archives below ``path``, the rows of each task sorted: a run."""
    numeric = id_type in ("tinyint", "smallint", "int", "bigint")
    as_id = lambda x: x if x is None or not numeric else int(x)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []

        def packed() -> pa.RecordBatch:
            arrays = [pa.array(c, f.type) for c, f in zip(zip(*found), schema)]
            found.clear()
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                name = path.as_py().rsplit("/", 1)[-1]
                for offset, length, headers, block in parse(content.as_py()):
                    payload = block[block.index(SEPARATOR.encode()) + len(SEPARATOR) :]
                    digest, size = headers["WARC-Payload-Digest"].removeprefix("sha1:"), len(payload)
                    if headers["WARC-Type"] == "revisit":
                        size = int(headers["X-Payload-Length"])
                    elif base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"payload of the record at {offset} of {name} is damaged")
                    url = headers.get("WARC-Target-URI")
                    url = url and _ENCODED.sub(lambda m: chr(int(m[1], 16)), url)
                    found.append((url_key(url), headers["WARC-Date"], as_id(headers.get("X-Page-Id")), url,
                                  headers["WARC-Type"], as_id(headers.get("X-Refers-To-Page")), size, digest,
                                  name, offset, length))
                    if len(found) == 10_000:
                        yield packed()
        if found:
            yield packed()

    kind = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}.get(id_type, pa.string())
    schema = pa.schema([
        (n, {"{id}": kind, "string": pa.string(), "bigint": pa.int64()}[t])
        for n, t in (c.split(" ") for c in CAPTURE.split(", "))])
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    rows = map_arrow(files, read, CAPTURE.replace("{id}", id_type if numeric else "string"))
    # Place in the history. Spark compares texts by bytes of UTF-8, which is by code points too.
    return rows.sortWithinPartitions("urlkey", "time", F.asc_nulls_last("page_id"), "file", "offset")


class LoserTree:
    """Merges sorted runs. Every inner node keeps the loser of its match, so the next winner takes one
    path from leaf to root, a comparison per level."""

    def __init__(self, runs: list[Iterator], key: Callable):
        self.runs, self.key, self.k = runs, key, len(runs)
        self.heads = [self._next(i) for i in range(self.k)]
        self.losers = [-1] * self.k  # losers[0] is the overall winner
        for i in range(self.k):
            self._play(i)

    def _next(self, i: int) -> tuple | None:
        item = next(self.runs[i], None)
        return None if item is None else (self.key(item), i, item)

    def _beats(self, a: int, b: int) -> bool:
        """Whether run a's head goes before run b's; a run that has ended loses."""
        if self.heads[a] is None or self.heads[b] is None:
            return self.heads[a] is not None
        return self.heads[a][:2] < self.heads[b][:2]

    def _play(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node > 0:
            if self.losers[node] == -1:  # still building: wait for the opponent
                self.losers[node] = winner
                return
            if self._beats(self.losers[node], winner):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.k and self.heads[self.losers[0]] is not None:
            winner = self.losers[0]
            yield self.heads[winner][2]
            self.heads[winner] = self._next(winner)
            self._play(winner)


def merged_index(runs: DataFrame) -> DataFrame:
    """All captures with ``range`` and ``place``: ordered by them, they are one sorted history."""
    ship(runs.sparkSession)
    names = runs.columns
    keyed = [names.index(c) for c in ("urlkey", "time", "page_id", "file", "offset")]

    def places(columns: list) -> list[tuple]:
        return [(u, t, p is None, p or 0, f, o) for u, t, p, f, o in zip(*(columns[i].to_pylist() for i in keyed))]

    total = runs.count()
    spread = F.xxhash64("file", "offset")
    sampled = runs.filter(among_first(spread, SAMPLE, F.lit(float(total)))).select(
        "urlkey", "time", "page_id", "file", "offset").orderBy(spread).limit(SAMPLE).collect()
    keys = sorted((u, t, p is None, p or 0, f, o) for u, t, p, f, o in sampled)
    ranges = max(1, -(-total // RANGE_CAPTURES), min(8, len(keys)))
    bounds = [keys[i * len(keys) // ranges] for i in range(1, ranges)] if keys else []

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, pieces = places(batch.columns), []
            # A batch may hold the end of a run and the begin of the next.
            turns = [0, *(i for i in range(1, len(own)) if own[i] < own[i - 1]), len(own)]
            for first, last in zip(turns, turns[1:]):
                ends = [first, *(bisect.bisect_left(own, b, first, last) for b in bounds), last]
                pieces += [(i, batch.slice(a, b - a)) for i, (a, b) in enumerate(zip(ends, ends[1:])) if a < b]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in pieces], pa.int32()),
                 pa.array([_packed(pa.Table.from_batches([x])) for _, x in pieces], pa.binary())], names=["range", "slice"])

    def merge(key: tuple[pa.Scalar, ...], group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [pa.ipc.open_stream(x.as_buffer()).read_all().combine_chunks() for b in group for x in b.column("slice")]
        heads = [zip(places(x.columns), itertools.repeat(i), itertools.count()) for i, x in enumerate(slices)]
        merged, begin = iter(LoserTree(heads, lambda head: head[0])), 0
        held = pa.Table.from_batches([x.to_batches()[0] for x in slices])
        starts = [0, *itertools.accumulate(x.num_rows for x in slices)]
        while rows := [starts[i] + j for _, i, j in itertools.islice(merged, 10_000)]:
            out = held.take(pa.array(rows)).combine_chunks().to_batches()[0]
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array([key[0].as_py()] * len(rows), pa.int32()),
                 pa.array(range(begin, begin + len(rows)), pa.int64())], names=[*names, "range", "place"])
            begin += len(rows)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in runs.schema)
    return map_arrow(runs, cut, "range int, slice binary").groupBy("range").applyInArrow(
        merge, f"{kinds}, range int, place bigint")


def _packed(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def archive_and_index(
    pages: DataFrame, page_id: str = "page_id", payload: str = "html", least: int = 0,
    date: str = "2025-01-01T00:00:00Z", path: str | None = None, time: str | None = None,
) -> DataFrame:
    """Write the archives (to the shared folder unless ``path`` names another), read them back, and merge their index."""
    spark, id_type = pages.sparkSession, pages.schema[page_id].dataType.simpleString()
    path = path or new_shared_folder(spark, "warc")
    write_archives(pages, path, page_id, payload, least, date, time)
    with small_batches(spark):
        runs = staged(captures(spark, path, id_type), "runs")
    return merged_index(runs)
