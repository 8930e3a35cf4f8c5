"""WARC archives of pages, and one index of all captures merged from sorted runs."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerstar.llm.attach import attach
from ledgerstar.llm.common import File, ready_workers
from ledgerstar.session import materialize

#: A task begins a new archive, and with it a new run of the index, beyond so many bytes.
ARCHIVE_BYTES = 64 << 20
#: Captures that a merging task holds at most, on average.
MERGE_ROWS = 200_000

_RUN = (
    "run string, url_key string, second bigint, page_id bigint, position bigint, length bigint, "
    "kind string, digest string, time string"
)
_KEY = ["url_key", "second", "run", "position"]
_READ = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, run string, position bigint"
)
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value


def url_key(url: str | None) -> str:
    """The sort key of a URL: host labels from the top down, then path and query, lower case.

    Scheme, user, default port, ``www`` and fragment do not count; null and empty are "-".
    """
    if not url or not url.strip():
        return "-"
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return re.sub(r"\s+", "%20", url.strip().lower())
    labels = host.split(".")
    if labels[0] == "www" and len(labels) > 1:
        labels = labels[1:]
    default = (parts.scheme, port) in {("http", 80), ("https", 443)}
    shown = f":{port}" if port and not default else ""
    query = f"?{parts.query}" if parts.query else ""
    key = f"{','.join(labels[::-1])}{shown}){parts.path or '/'}{query}"
    return re.sub(r"\s+", "%20", key.lower())


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(value: str) -> str:
    """A header value on one line."""
    escaped = ("".join(f"%{b:02X}" for b in c.encode()) for c in value)
    return "".join(c if c.isprintable() else e for c, e in zip(value, escaped))


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def record(
    page_id: int | None,
    url: str | None,
    time: str,
    payload: bytes,
    refers_to: int | None,
    revisit: bool,
) -> tuple[bytes, str]:
    """One WARC record and its payload digest; a revisit leaves the payload out."""
    digest = base32_sha1(payload)
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Date: {time}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", digest


def packed(data: bytes) -> bytes:
    """A record as a gzip member of its own, so that it can be read alone; always the same."""
    return gzip.compress(data, compresslevel=4, mtime=0)


def members(stream: pa.NativeFile, chunk: int = 1 << 16) -> Iterator[tuple[int, bytes]]:
    """Position and content of each gzip member of an archive."""
    position, waiting = 0, stream.read(chunk)
    while waiting:
        unpack, parts, size = zlib.decompressobj(wbits=31), [], 0
        while not unpack.eof:
            if not waiting and not (waiting := stream.read(chunk)):
                raise ValueError("the archive ends inside a record")
            try:
                parts.append(unpack.decompress(waiting))
            except zlib.error as error:
                raise ValueError(f"the record at {position} is damaged") from error
            size += len(waiting) - len(unpack.unused_data)
            waiting = unpack.unused_data
        yield position, b"".join(parts)
        position += size
        waiting = waiting or stream.read(chunk)


def parse(stream: pa.NativeFile) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Position, headers and block of each record of an archive; damage is an error."""
    for position, data in members(stream):
        head, _, rest = data.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        if version != "WARC/1.1":
            raise ValueError(f"no record at {position}")
        fields = dict(line.split(": ", 1) for line in lines)
        length = int(fields["Content-Length"])
        if rest[length:] != b"\r\n\r\n":
            raise ValueError(f"the record at {position} has another length")
        yield position, fields, rest[:length]


def _page(name: str) -> int | None:
    found = name.removeprefix("<urn:page:").removesuffix(">")
    return None if found == "none" else int(found)


#: Second 0 of a capture, and the seconds whose dates a record can print.
BEGIN = datetime(2026, 1, 1, tzinfo=timezone.utc)
_FIRST = -((BEGIN - datetime(1, 1, 1, tzinfo=timezone.utc)) // timedelta(seconds=1))
_LAST = (datetime(9999, 12, 31, 23, 59, 59, tzinfo=timezone.utc) - BEGIN) // timedelta(seconds=1)


def printed(second: int) -> str:
    """The date of a capture; beyond the years 1 to 9999 the first or last second of them."""
    moment = BEGIN + timedelta(seconds=min(max(second, _FIRST), _LAST))
    return f"{moment.year:04d}{moment:-%m-%dT%H:%M:%SZ}"


def with_roles(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages with ``keep_id`` (largest page_id of their payload, which holds it) and ``revisit``.

    Payloads are told apart by SHA-256. Payloads below ``least_bytes`` are responses each. A
    null id is below all others; rows that repeat an id and its payload are alike.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    keyed = pages.withColumn("payload", payload).withColumn("same", F.sha2("payload", 256))
    groups = keyed.groupBy("same").agg(
        F.max("page_id").alias("keep_id"), F.count(F.lit(1)).alias("captures")
    )
    groups = materialize(groups, "payloads")
    total = groups.agg(F.sum("captures")).first()[0] or 0
    found = attach(keyed, groups, "same", "captures", total)
    other = ~F.col("page_id").eqNullSafe(F.col("keep_id"))
    return found.withColumn("revisit", other & (F.length("payload") >= least_bytes))


def write_archives(
    pages: DataFrame, path: str, time: Column | None = None, least_bytes: int = 0
) -> DataFrame:
    """Write each page as a record below ``path``; returns the runs of the capture index.

    Archives are ``.warc.gz``, each record a gzip member of its own at its ``position``.

    Columns ``page_id, url, html``, all nullable; a null html is empty. ``time`` is the second
    of the capture, by default ``page_id``, counted from 2026 and null as 0. Captures are in
    order of that whole number; the date that a record prints stays within the years 1 to 9999
    (see ``printed``). Every archive has a run: its captures sorted by URL key and second. The
    runs are a Parquet table that Spark commits, and only archives it names count, so a task
    that runs again leaves nothing double.
    """
    ready_workers(pages.sparkSession)
    folder = f"{path}/archives"
    second = F.coalesce(time if time is not None else F.col("page_id"), F.lit(0))
    narrow = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        "url",
        "html",
        second.cast("bigint").alias("second"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, rows = TaskContext.get().partitionId(), None, []

        def run() -> pa.RecordBatch:
            out.close()
            rows.sort(key=lambda r: (r[1], r[2], r[4]))
            return _batch(rows, _RUN)

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    file, position = f"{folder}/{part:06d}-{uuid.uuid4().hex}.warc.gz", 0
                    out = File.create(file)
                time = printed(row["second"])
                data, digest = record(
                    row["page_id"], row["url"], time, row["payload"], row["keep_id"], row["revisit"]
                )
                data = packed(data)
                out.write(data)
                kind = "revisit" if row["revisit"] else "response"
                key, size = url_key(row["url"]), len(data)
                found = row["second"], row["page_id"], position, size, kind, digest, time
                rows.append((file, key, *found))
                position += len(data)
                if position >= ARCHIVE_BYTES:
                    yield run()
                    out, rows = None, []
        if out is not None:
            yield run()

    wanted = with_roles(narrow, least_bytes)
    wanted = wanted.select("page_id", "url", "second", "payload", "keep_id", "revisit")
    return materialize(wanted.mapInArrow(write, _RUN), "runs")


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64()}
    names, types = zip(*[column.split() for column in schema.split(", ")])
    columns = [pa.array(c, kinds[t]) for c, t in zip(zip(*rows), types)]
    return pa.RecordBatch.from_arrays(columns, list(names))


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the top the winner.

    The next item costs one match per level, against the losers on the winner's own path.
    """

    def __init__(self, runs: list[Iterator]):
        self.runs = runs
        self.heads = [next(run, None) for run in runs]
        size = len(runs)
        self.losers = [0] * size
        winners = [0] * size + list(range(size))
        for node in range(size - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            first = self._first(a, b)
            winners[node], self.losers[node] = first, b if first == a else a
        self.winner = winners[1] if size > 1 else 0

    def _first(self, a: int, b: int) -> int:
        """An exhausted run loses; ties go to the earlier run."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return a if y is None and (x is not None or a < b) else b
        return a if (x, a) < (y, b) else b

    def __iter__(self) -> Iterator:
        while self.runs and (head := self.heads[self.winner]) is not None:
            yield head
            run = self.winner
            self.heads[run] = next(self.runs[run], None)
            node = (run + len(self.runs)) // 2
            while node:
                if self._first(run, self.losers[node]) != run:
                    run, self.losers[node] = self.losers[node], run
                node //= 2
            self.winner = run


def merge_runs(runs: DataFrame) -> DataFrame:
    """All captures in order of URL key and time, with ``place`` (from 0) in that order.

    Tasks own ranges of the whole key, so one URL or host with very many captures is cut as
    well. A task holds its piece of each run in the run's order and merges them by a loser tree.
    """
    rows = runs.count()
    fewest = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(fewest, -(-rows // MERGE_ROWS))
    schema = f"{_RUN}, part int, at bigint"

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = list(batches)
        if not tables:
            return
        held = pa.Table.from_batches(tables).combine_chunks()
        keys = list(zip(*[held.column(c).to_pylist() for c in _KEY]))
        edges = [i for i in range(1, len(keys)) if keys[i][2] != keys[i - 1][2]]
        pieces = [
            zip(keys[a:b], range(a, b)) for a, b in zip([0, *edges], [*edges, len(keys)])
        ]
        order = [at for _, at in LoserTree(pieces)]
        part = TaskContext.get().partitionId()
        merged = held.take(order)
        merged = merged.append_column("part", pa.array([part] * len(order), pa.int32()))
        yield from merged.append_column("at", pa.array(range(len(order)), pa.int64())).to_batches()

    dealt = runs.repartitionByRange(parts, *_KEY).sortWithinPartitions("run", *_KEY)
    merged = materialize(dealt.mapInArrow(merge, schema), "captures")
    sizes = merged.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    return (
        merged.join(F.broadcast(base), "part")  # a row per merging task
        .withColumn("place", F.col("base") + F.col("at"))
        .drop("part", "at", "base")
    )


def read_archives(runs: DataFrame) -> DataFrame:
    """Read every archive that the runs name, record by record, and check payloads and counts."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in (r for batch in batches for r in batch.to_pylist()):
            rows = []
            with File.open(run["run"]) as stream:
                for position, fields, block in parse(stream):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind, refers = fields["WARC-Type"], fields.get("WARC-Refers-To")
                    found = len(payload), base32_sha1(payload)
                    if kind == "response" and found != (length, digest):
                        raise ValueError(f"the payload at {position} is damaged")
                    page_id = _page(fields["WARC-Record-ID"])
                    refers_to = _page(refers) if refers else None
                    rows.append((page_id, length, digest, kind, refers_to, run["run"], position))
            if len(rows) != run["records"]:
                raise ValueError(f"{run['run']} does not hold what the index says")
            yield _batch(rows, _READ)

    files = runs.groupBy("run").agg(F.count(F.lit(1)).alias("records"))
    tasks = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(tasks).mapInArrow(read, _READ)
