"""WARC archives with revisit records, and a capture index merged from sorted runs by URL key and timestamp.

Archives are rows of a table in the shared folder (name, content, index run), content being a valid .warc.gz byte string: a gzip
member for each record. Spark's commit protocol keeps each archive exactly once when tasks are retried.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from datetime import datetime, timedelta, timezone
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociq.llm.common import shuffle_partitions, staged
from lociq.llm.suffix import front_code, front_decode, merge_runs

ARCHIVE_BYTES = 16 << 20  # of payload in an archive
EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def url_key(url: str) -> str:
    """Sort key of a URL: host labels reversed, then port, path and sorted query, in lower case, without fragment and a leading www."""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return url.strip().lower()
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port and (parts.scheme, port) not in (("http", 80), ("https", 443)) else "")
    query = "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    return f"{key}){parts.path.rstrip('/') or '/'}".lower() + (f"?{query}".lower() if query else "")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def clean(value: str) -> str:
    return "".join(c if c.isprintable() else "%" + c.encode("utf-8", "replace").hex().upper() for c in value)


def write_record(page_id: int | None, url: str, date: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record, or a revisit record where refers_to is given, as a gzip member."""
    name = lambda i: f"<urn:page:{'none' if i is None else i}>"
    head = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": name(page_id), "WARC-Date": date, "WARC-Target-URI": clean(url)}
    head |= {"WARC-Payload-Digest": f"sha1:{digest}", "X-Payload-Length": str(len(payload)), "Content-Type": "application/http; msgtype=response"}
    if refers_to is not None:
        head |= {"WARC-Refers-To": name(refers_to), "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
    block = HTTP if refers_to is not None else HTTP + payload
    head["Content-Length"] = str(len(block))
    raw = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"
    press = zlib.compressobj(3, zlib.DEFLATED, 31)
    return press.compress(raw) + press.flush()


def read_record(member: bytes) -> dict:
    """The facts of a record; of a response, length and digest are taken from the payload and held against the header."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    number = lambda v: None if v is None or v.endswith(":none>") else int(v[:-1].rpartition(":")[2])
    out = {"page_id": number(fields["WARC-Record-ID"]), "record_type": fields["WARC-Type"], "refers_to": number(fields.get("WARC-Refers-To")), "url": fields["WARC-Target-URI"]}
    length, digest = int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if out["record_type"] == "response":
        payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]
        if len(payload) != length or base32_sha1(payload) != digest:
            raise ValueError(f"damaged record of page {out['page_id']}")
    return out | {"payload_bytes": length, "payload_digest": digest}


def sort_key(url: str, stamp: str, page_id: int | None) -> bytes:
    return b"\x00".join([url_key(url).replace("\x00", "").encode("utf-8", "replace"), stamp.encode(), b"%020d" % ((page_id or 0) + (1 << 63))])


def _archives(batches):
    task = TaskContext.get().partitionId()
    held, size, count = [], 0, 0

    def flush():
        held.sort(key=lambda r: r[0])
        at, members, index = 0, [], []
        for key, *record in held:
            member = write_record(*record)
            members.append(member)
            index.append({"key": key, "at": at, "size": len(member)})
            at += len(member)
        return pa.RecordBatch.from_pylist([{"archive": f"{task:06d}-{count:05d}", "content": b"".join(members), "index": index}], ARCHIVE)

    for batch in batches:
        for row in batch.to_pylist():
            payload = (row["html"] or "").encode("utf-8")
            when = EPOCH + timedelta(seconds=(row["page_id"] or 0) % (1 << 31))
            url = row["url"] or ""
            key = sort_key(url, when.strftime("%Y%m%d%H%M%S"), row["page_id"])
            held.append((key, row["page_id"], url, when.strftime("%Y-%m-%dT%H:%M:%SZ"), payload, base64.b32encode(row["digest"]).decode(), row["refers_to"]))
            size += len(payload) + 500
            if size >= ARCHIVE_BYTES:
                yield flush()
                held, size, count = [], 0, count + 1
    if held:
        yield flush()


ARCHIVE = pa.schema([("archive", pa.string()), ("content", pa.binary()), ("index", pa.list_(pa.struct([("key", pa.binary()), ("at", pa.int64()), ("size", pa.int64())])))])
ARCHIVE_DDL = "archive string, content binary, index array<struct<key: binary, at: bigint, size: bigint>>"


def _cut(bounds: list[bytes]):
    """Each archive's sorted index run, cut at the range bounds and front-coded."""
    import bisect

    def run(batches):
        for batch in batches:
            rows = []
            for archive, index in zip(batch.column("archive").to_pylist(), batch.column("index").to_pylist(), strict=True):
                keys = [x["key"] for x in index]
                ends = [bisect.bisect_left(keys, b) for b in bounds] + [len(keys)]
                begin = 0
                for part, end in enumerate(ends):
                    if end > begin:
                        lcp, rest = front_code(keys[begin:end])
                        rows.append({"part": part, "archive": archive, "lcp": lcp.tolist(), "length": [len(k) for k in keys[begin:end]], "rest": rest, "at": [x["at"] for x in index[begin:end]], "size": [x["size"] for x in index[begin:end]]})
                    begin = max(begin, end)
            yield pa.RecordBatch.from_pylist(rows, RUN)

    return run


RUN = pa.schema([("part", pa.int64()), ("archive", pa.string()), ("lcp", pa.list_(pa.int32())), ("length", pa.list_(pa.int32())), ("rest", pa.binary()), ("at", pa.list_(pa.int64())), ("size", pa.list_(pa.int64()))])
RUN_DDL = "part long, archive string, lcp array<int>, length array<int>, rest binary, at array<long>, size array<long>"


def _merge(batches):
    """The runs of each range, which come together, merged by a loser tree: the range's captures in order."""

    def captures(part: int, runs: list[dict]):
        strings = [front_decode(np.array(r["lcp"]), np.array(r["length"]), r["rest"]) for r in runs]
        which, index, _ = merge_runs([(s, r["lcp"]) for s, r in zip(strings, runs, strict=True)])
        for start in range(0, len(which), 8192):
            rows = []
            for k in range(start, min(start + 8192, len(which))):
                r, i = which[k], index[k]
                key, stamp, _ = strings[r][i].rsplit(b"\x00", 2)
                rows.append({"range_id": part, "position": k, "url_key": key.decode("utf-8", "replace"), "timestamp": stamp.decode(), "archive": runs[r]["archive"], "at": runs[r]["at"][i], "size": runs[r]["size"][i]})
            yield pa.RecordBatch.from_pylist(rows, HISTORY)

    runs: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if runs and row["part"] != runs[0]["part"]:
                yield from captures(runs[0]["part"], runs)
                runs = []
            runs.append(row)
    if runs:
        yield from captures(runs[0]["part"], runs)


HISTORY = pa.schema([("range_id", pa.int64()), ("position", pa.int64()), ("url_key", pa.string()), ("timestamp", pa.string()), ("archive", pa.string()), ("at", pa.int64()), ("size", pa.int64())])
HISTORY_DDL = "range_id long, position long, url_key string, timestamp string, archive string, at long, size long"
READ = pa.schema([("archive", pa.string()), ("at", pa.int64()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
READ_DDL = "archive string, at long, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _read(batches):
    """The records of each archive, read member by member at the places of its index run."""
    for batch in batches:
        for archive, content, index in zip(batch.column("archive").to_pylist(), batch.column("content"), batch.column("index").to_pylist(), strict=True):
            raw, rows = content.as_buffer(), []
            for e in sorted(index, key=lambda e: e["at"]):
                rows.append({"archive": archive, "at": e["at"]} | read_record(raw.slice(e["at"], e["size"]).to_pybytes()))
            yield pa.RecordBatch.from_pylist([{k: r[k] for k in READ.names} for r in rows], READ)


def write_archives(pages: DataFrame, least_bytes: int = 0, salts: int = 16) -> DataFrame:
    """Write a record for each row of ``pages`` (page_id, url, html, any more columns); the archive table.

    Payload is the html in UTF-8 (null: empty). Of rows with equal payloads of ``least_bytes`` or more, that of the largest
    page_id is the response and the others revisit it; rows that repeat it (page_id and html) are responses too. Rows without
    page_id never serve as response for others; a group of nothing else is all responses. A null url is an empty one. An empty table gives no archives.

    Pages are matched by digest and length without their html, in ``salts`` parts of each group of copies; html moves once, by page.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    pages = pages.withColumn("digest", F.unhex(F.sha1("html"))).withColumn("bytes", F.octet_length("html"))
    narrow = pages.where(F.col("bytes") >= least_bytes).select("page_id", "digest", "bytes")
    groups = narrow.groupBy("digest", "bytes").agg(F.max("page_id").alias("best"), F.count("*").alias("n")).where("n > 1 and best is not null")
    groups = groups.select("digest", "bytes", "best", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    again = narrow.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(salts)).cast("int")).join(groups, ["digest", "bytes", "salt"]).where("not (page_id <=> best)")
    again = again.select(F.col("page_id").alias("id"), F.col("digest").alias("same"), F.col("best").alias("refers_to")).distinct()
    marked = pages.join(again, pages.page_id.eqNullSafe(again.id) & (pages.digest == again.same), "left").select("page_id", "url", "html", "digest", "refers_to")
    return staged(marked.mapInArrow(_archives, ARCHIVE_DDL), "archives", batch_rows=256)


def capture_history(archives: DataFrame, sample_archives: int = 2000, sample_keys: int = 64) -> DataFrame:
    """Global capture order (range_id, position) with url_key, timestamp and place of each record.

    Range bounds come from at most ``sample_keys`` keys, evenly spaced, of at most ``sample_archives`` archives; every record is merged.
    Records without url come first, repeated ones stay next to each other, and no archives give no rows.
    """
    spark = archives.sparkSession
    keys = F.transform(F.sequence(F.lit(0), F.lit(sample_keys - 1)), lambda i: F.get("index", F.floor(i * F.size("index") / sample_keys).cast("int"))["key"])
    sample = archives.orderBy(F.xxhash64("archive")).limit(sample_archives).select(F.explode(F.array_distinct(keys)).alias("key")).where("key is not null")
    found = sorted({bytes(r["key"]) for r in sample.collect()})
    parts = shuffle_partitions(spark)
    bounds = sorted({found[k * len(found) // parts] for k in range(1, parts)}) if found else []
    runs = archives.select("archive", "index").mapInArrow(_cut(bounds), RUN_DDL)
    return runs.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_merge, HISTORY_DDL)


def read_archives(archives: DataFrame) -> DataFrame:
    """Read every record back and match it with the merged index: a row for each page with its place in the capture histories; null and empty html have 0 bytes.

    Archives are read where they are scanned and only a record's facts meet its index entry, by archive and place, so no content is shuffled.
    """
    history = capture_history(archives).select("archive", "at", "url_key", "timestamp", "range_id", "position")
    records = archives.select("archive", "content", "index").mapInArrow(_read, READ_DDL)
    return records.join(history, ["archive", "at"]).drop("archive", "at")


def export(archives: DataFrame, folder: str) -> None:
    """For a look at small outputs: write archives as .warc.gz files of a folder of the driver, one at a time."""
    import pathlib

    out = pathlib.Path(folder)
    out.mkdir(parents=True, exist_ok=True)
    for row in archives.select("archive", "content").toLocalIterator():
        (out / f"{row['archive']}.warc.gz").write_bytes(row["content"])
