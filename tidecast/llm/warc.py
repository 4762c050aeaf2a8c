"""WARC archives of pages and a two-level index over their urls."""

from __future__ import annotations

import gzip
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.session import fresh_folder

from .common import saved
from .url_rules import url_host, url_rest

#: Payloads below this many bytes are always stored.
LEAST_SHARED = 100
#: Captures in a compressed index block, and bytes of an archive that one read takes at most.
BLOCK_CAPTURES = 256
READ_BYTES = 4 << 20
#: Bytes of an archive that one task reads.
STRETCH = 64 << 20
#: Unwanted bytes that a read may take along.
READ_GAP = 16 << 10
LEVEL = 4
#: A fixed date keeps archives of the same pages the same.
DATE = "2024-01-01T00:00:00Z"

Key = tuple[bytes, bool, object]


def url_key(url: Column) -> Column:
    """Sort key of a url: reversed host, then path and query; empty for a null url or one without ``://``."""
    host = F.array_join(F.reverse(F.split(url_host(url), r"\.")), ",")
    rest = F.regexp_extract(url_rest(url), r"^[^/?#]*([^#]*)", 1)
    return F.when(url_rest(url).isNull(), F.lit("")).otherwise(F.concat(host, F.lit(")"), rest))


def captures(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(key, id, url, html, digest, bytes, record, refers): what to write for each page.

    Of pages with one payload of ``LEAST_SHARED`` bytes or more the one with the smallest id
    is a response (every row of that id is), the others revisit it and carry no payload. A
    null id is larger than all others.

    Which pages revisit is found without their html; only that list is joined to the pages.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        url_key(F.col(url_col)).alias("key"),
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        html.alias("html"),
        F.sha2(html.cast("binary"), 256).alias("digest"),
        F.octet_length(html).cast("long").alias("bytes"),
    )
    large = saved(rows.where(F.col("bytes") >= LEAST_SHARED).select("id", "digest").distinct(), "page-digests")
    first = large.groupBy("digest").agg(F.min("id").alias("refers"), F.count("*").alias("pages")).where("pages > 1 and refers is not null")
    again = large.join(first.select("digest", "refers"), "digest").where(~F.col("id").eqNullSafe(F.col("refers")))
    again = saved(again.select(F.col("id").alias("other"), F.col("digest").alias("same"), "refers"), "page-revisits")
    joined = rows.join(again, (F.col("digest") == F.col("same")) & F.col("id").eqNullSafe(F.col("other")), "left")
    return joined.select(
        "key",
        "id",
        "url",
        F.when(F.col("same").isNull(), F.col("html")).alias("html"),
        "digest",
        "bytes",
        F.when(F.col("same").isNull(), "response").otherwise(F.lit("revisit")).alias("record"),
        "refers",
    )


def order_key(key: str, ident: object) -> Key:
    """Python's order of (key, id) as Spark sorts them, nulls first."""
    return (key.encode(), ident is not None, ident if ident is not None else 0)


def record_bytes(ident: object, url: str | None, html: str | None, digest: str, size: int, record: str, refers: object) -> bytes:
    """One gzip member with a WARC record."""
    lines = ["WARC/1.1", f"WARC-Type: {record}", f"WARC-Record-ID: <urn:page:{'' if ident is None else quote(str(ident), safe='')}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}")
    lines += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Payload-Length: {size}"]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if record == "revisit":
        lines += [f"WARC-Refers-To: <urn:page:{quote(str(refers), safe='')}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        block = head + b"\r\n"
    else:
        block = head + f"Content-Length: {size}\r\n\r\n".encode() + (html or "").encode()
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", LEVEL, mtime=0)


def parsed(member: bytes) -> tuple[str | None, int, str, str, str | None, bytes | None]:
    """(id, payload bytes, digest, record type, id referred to, payload) of a record; a payload must fit its digest."""
    data = gzip.decompress(member)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    named = {k: unquote(fields[k][len("<urn:page:") : -1]) for k in ("WARC-Record-ID", "WARC-Refers-To") if k in fields}
    ident, digest = named["WARC-Record-ID"] or None, fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "revisit":
        return ident, int(fields["WARC-Payload-Length"]), digest, "revisit", named["WARC-Refers-To"], None
    payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]
    found = hashlib.sha256(payload).hexdigest()
    if found != digest:
        raise ValueError(f"record {ident} doesn't fit its digest")
    return ident, len(payload), found, "response", None, payload


def _store(folder: str):
    """(file system, path in it) of a folder that Spark names."""
    from pyarrow import fs

    if folder.startswith("file:"):
        folder = "/" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder)


def write_archives(rows: DataFrame, folder: str, parts: int) -> DataFrame:
    """Write captures to an archive per task and index them in ``parts`` sorted parts.

    Records stay where their rows are; only their places are sorted by key and id. Returns
    the table of the parts, see ``write_index``.
    """
    kind = rows.schema["id"].dataType
    schema = T.StructType(
        [T.StructField("key", T.StringType()), T.StructField("id", kind), T.StructField("archive", T.StringType())]
        + [T.StructField(c, T.LongType()) for c in ("offset", "length")]
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        name = f"{uuid.uuid4().hex}.warc.gz"
        archive, offset = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if archive is None:
                store.create_dir(root, recursive=True)
                archive = store.open_output_stream(f"{root}/{name}", compression=None)
            lengths = []
            for row in zip(*(c.to_pylist() for c in batch.columns[1:])):
                data = record_bytes(*row)
                archive.write(data)
                lengths.append(len(data))
            ends = offset + pa.array(lengths, pa.int64()).to_numpy().cumsum()
            offsets = pa.array(ends - lengths, pa.int64())
            offset = int(ends[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([name] * len(lengths)), offsets, pa.array(lengths, pa.int64())], names=schema.names
            )
        if archive is not None:
            archive.close()

    columns = ("key", "id", "url", "html", "digest", "bytes", "record", "refers")
    # written by Spark, so only archives of tasks that succeeded are named
    return write_index(saved(rows.select(*columns).mapInArrow(write, schema), "archive-entries"), folder, parts)


def write_index(entries: DataFrame, folder: str, parts: int) -> DataFrame:
    """Write entries, sorted by key and id, as index files of two levels.

    A file holds compressed blocks of entries and, at its end, the sparse directory: first
    key and id, place and length of each block, and the names of the archives. Returns a
    table with a row a file: (first, index, directory_at, directory_bytes).
    """
    schema = "first string, index string, directory_at long, directory_bytes long"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        name = f"{uuid.uuid4().hex}.index"
        index, at = None, 0
        block: list[tuple] = []
        directory: list[tuple] = []
        archives: dict[str, int] = {}

        def close_block() -> None:
            nonlocal at
            data = zlib.compress("\n".join(json.dumps(x) for x in block).encode(), LEVEL)
            directory.append((*block[0][:2], at, len(data)))
            block.clear()
            index.write(data)
            at += len(data)

        for batch in batches:
            for key, ident, archive, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if index is None:
                    store.create_dir(root, recursive=True)
                    index = store.open_output_stream(f"{root}/{name}", compression=None)
                block.append((key, ident, archives.setdefault(archive, len(archives)), offset, length))
                if len(block) == BLOCK_CAPTURES:
                    close_block()
        if index is not None:
            if block:
                close_block()
            data = zlib.compress(json.dumps([directory, list(archives)]).encode(), LEVEL)
            index.write(data)
            index.close()
            row = [json.dumps(directory[0][:2]), name, at, len(data)]
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["first", "index", "directory_at", "directory_bytes"])

    spread = entries.repartitionByRange(parts, "key", "id").sortWithinPartitions("key", "id")
    return saved(spread.mapInArrow(write, schema), "index-parts")


class PartReader:
    """Range reads of one index part: its directory once, then the blocks that hold wanted keys."""

    def __init__(self, file, at: int, size: int):
        self.file = file
        self.directory, self.archives = json.loads(zlib.decompress(file.read_at(size, at)))
        self.firsts = [order_key(k, i) for k, i, _, _ in self.directory]

    def block(self, number: int) -> list[list]:
        _, _, at, size = self.directory[number]
        return [json.loads(line) for line in zlib.decompress(self.file.read_at(size, at)).decode().split("\n")]

    def entries(self, wanted: list[Key]) -> Iterator[tuple[str, int, int]]:
        """(archive, offset, length) of sorted keys: binary search in the directory, then in the block."""
        current, entries, keys = -1, [], []
        for key in wanted:
            number = max(0, bisect_left(self.firsts, key) - 1)  # equal keys may begin in the block before
            while number < len(self.firsts) and self.firsts[number] <= key:
                if number != current:
                    current, entries = number, self.block(number)
                    keys = [order_key(e[0], e[1]) for e in entries]
                for e in entries[bisect_left(keys, key) : bisect_right(keys, key)]:
                    yield self.archives[e[2]], e[3], e[4]
                number += 1


def read_runs(file, places: list[tuple[int, int]]) -> Iterator[bytes]:
    """The records at sorted (offset, length) places, neighbours in one read."""
    start = 0
    for i, (offset, length) in enumerate(places):
        begin, end = places[start][0], offset + length
        following = places[i + 1] if i + 1 < len(places) else None
        if following is None or following[0] > end + READ_GAP or following[0] + following[1] - begin > READ_BYTES:
            data = memoryview(file.read_at(end - begin, begin))
            for at, size in places[start : i + 1]:
                yield bytes(data[at - begin : at - begin + size])
            start = i + 1


def looked_up(requests: DataFrame, parts: DataFrame, folder: str, id_type: T.DataType, payload: bool = False) -> DataFrame:
    """The records of (key, id) requests: (id, payload_bytes, payload_digest, record_type, refers_to, payload).

    Every request goes to the index part whose range holds it, found by binary search in the
    table of parts; that table has a row per index file, as many as the writing job was asked
    for, and is all that the driver and the executors hold. A task reads the directories and
    blocks of its parts by ranges. The places found are sorted by archive and offset, and
    records are read from there in runs. A request without a record gives no row, equal
    requests count once. Payloads are null for revisits and unless asked for.
    """
    listed = sorted(
        ((json.loads(r["first"]), r["index"], r["directory_at"], r["directory_bytes"]) for r in parts.collect()), key=lambda x: order_key(*x[0])
    )
    firsts = [order_key(*x[0]) for x in listed]
    shared = requests.sparkSession.sparkContext.broadcast((firsts, listed))
    request = T.StructType([T.StructField("part", T.LongType()), T.StructField("key", T.StringType()), T.StructField("id", id_type)])
    answer = T.StructType(
        [T.StructField("id", T.StringType()), T.StructField("payload_bytes", T.LongType())]
        + [T.StructField(c, T.StringType()) for c in ("payload_digest", "record_type", "refers_to")]
        + [T.StructField("payload", T.BinaryType())]
    )

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins = shared.value[0]
        for batch in batches:
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            part = [max(0, bisect_right(begins, order_key(k, i)) - 1) for k, i in keys]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), batch.column(0), batch.column(1)], names=["part", "key", "id"])

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        for part, rows in _runs(batches):
            _, index, at, size = shared.value[1][part]
            with store.open_input_file(f"{root}/{index}") as file:
                found = list(PartReader(file, at, size).entries([order_key(*r) for r in rows]))
            kinds = [pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([f[j] for f in found], k) for j, k in enumerate(kinds)], names=["archive", "offset", "length"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        for archive, places in _runs(batches, 2000):
            with store.open_input_file(f"{root}/{archive}") as file:
                found = [parsed(m) for m in read_runs(file, places)]
            columns = [[r[j] for r in found] for j in range(5)] + [[r[5] if payload else None for r in found]]
            kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=answer.names)

    asked = requests.select("key", "id").distinct().mapInArrow(assign, request)
    places = asked.repartition("part").sortWithinPartitions("part", "key", "id").mapInArrow(locate, "archive string, offset long, length long")
    # a fixed number of tasks: places are narrow, and merged by their own bytes they would be read by one
    tasks = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = places.repartition(tasks, "archive", F.expr(f"offset div {STRETCH}"))
    found = dealt.sortWithinPartitions("archive", "offset").mapInArrow(read, answer)
    return found.select(F.col("id").cast(id_type).alias("id"), *answer.names[1:4], F.col("refers_to").cast(id_type).alias("refers_to"), "payload")


def _runs(batches: Iterator[pa.RecordBatch], most: int = 100_000) -> Iterator[tuple[object, list[tuple]]]:
    """(first column, other columns) of sorted rows, in runs of bounded length."""
    current, held = None, []
    for batch in batches:
        for first, *rest in zip(*(c.to_pylist() for c in batch.columns)):
            if held and (first != current or len(held) >= most):
                yield current, held
                held = []
            current = first
            held.append(tuple(rest))
    if held:
        yield current, held


def archived_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", parts: int | None = None) -> DataFrame:
    """Write a WARC record per page to the shared folder, then find and read every page by its url and id.

    Returns (id, payload_bytes, payload_digest, record_type, refers_to), as read from the
    archives; a response's size and digest are those of the payload that was read. A null
    html is an empty payload. A null url, or one without ``://``, has the empty key and is
    found by its id; the null id sorts first and is no page that others refer to. Repeated
    rows are records of their own, other columns are left out, an empty table gives no rows.
    """
    spark = pages.sparkSession
    folder = fresh_folder(spark, "archives")
    written = write_archives(captures(pages, id_col, url_col, html_col), folder, parts or int(spark.conf.get("spark.sql.shuffle.partitions")))
    requests = pages.select(url_key(F.col(url_col)).alias("key"), F.col(id_col).alias("id"))
    found = looked_up(requests, written, folder, pages.schema[id_col].dataType)
    return found.select(F.col("id").alias(id_col), "payload_bytes", "payload_digest", "record_type", "refers_to")
