"""WARC archives of pages, and a two-level index of their captures.

``write`` makes WARC 1.1 files, one a task: Spark's text writer ends each record
with the two line ends that the format asks for. Of pages with equal payloads of
at least ``LEAST`` bytes the one with the smallest id is a response, the others
are revisits that refer to it and leave the payload out.

``index`` reads the archives' headers and sorts the captures by reversed-host key
into compressed blocks of ``LINES`` lines; a directory keeps the first key of each
block and its place. ``lookup`` deals the keys of a table of urls to the parts of the
directory, each of which a task holds and bisects; the blocks found are read once
each, and ``records`` reads the byte ranges of the captures.

Null html is an empty payload; a null url gives a record without target and an
empty key; null ids refer to and are referred to by none. Rows with equal ids and
payloads are all responses; of rows with one id and different payloads each is
judged by its own. Archives are read in tasks by pyarrow's file systems,
which know local, HDFS, S3 and GCS addresses.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import groupby
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.spread import join_unique
from quayside.sources.relations import written

LEAST, LINES = 100, 3_000
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = (
    "key string, page_id bigint, url string, record_type string, refers_to bigint, payload_digest string,"
    " payload_bytes bigint, file string, offset bigint, length bigint"
)
_FIELDS = [f.split()[0] for f in CAPTURE.split(", ")]
_TYPES = [pa.int64() if f.endswith("bigint") else pa.string() for f in CAPTURE.split(", ")]
#: Bytes read for a record's headers; more are read where they are longer.
_HEAD = 2_048


def surt(url: str | None) -> str:
    """Key that sorts by site: host parts from the last to the first, then the path."""
    if not url:
        return ""
    try:
        parts = urlsplit(url)
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url
    turned = ",".join(reversed(host.split(".")))
    return f"{turned}{f':{port}' if port else ''}){parts.path or '/'}{f'?{parts.query}' if parts.query else ''}"


def revisits(pages: DataFrame, page_id: str = "page_id", html: str = "html", least: int = LEAST) -> DataFrame:
    """``(page_id, digest, refers_to)`` of the pages that repeat an earlier one's payload."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    digests = written(
        pages.where((F.octet_length(payload) >= least) & F.col(page_id).isNotNull())
        .select(F.col(page_id).alias("page_id"), F.unhex(F.sha2(payload, 256)).alias("digest")),
        "payloads",
    )
    groups = digests.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("share"))
    facts = written(groups.where("share > 1"), "repeated")
    found = join_unique(digests, facts, "digest", "share").where("page_id > refers_to")
    return written(found.select("page_id", "digest", "refers_to").distinct(), "revisits")


def escaped(url: str) -> Column:
    """A url as records hold it, on one line."""
    return F.replace(F.replace(F.col(url).cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def record(page_id: str, url: str, html: str, refers_to: str, date: str) -> Column:
    """The text of a record, without the two line ends after it."""
    payload = F.coalesce(F.col(html), F.lit(""))
    again = F.col(refers_to).isNotNull()
    size = F.octet_length(payload).cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit("\r\n\r\n"))
    block = F.when(again, http).otherwise(F.concat(http, payload))
    target = escaped(url)

    def line(name: str, *value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), *value, F.lit("\r\n")), F.lit(""))

    def urn(column: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.col(column).cast("string"), F.lit(">"))

    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.coalesce(urn(page_id), F.lit("<urn:page:none>"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", target),
        line("WARC-Payload-Digest", F.lit("sha256:"), F.sha2(payload.cast("binary"), 256)),
        line("WARC-Refers-To", urn(refers_to)),
        F.when(again, F.lit(f"WARC-Profile: {PROFILE}\r\n")).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )


def write(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    date: str = "2024-01-01T00:00:00Z", least: int = LEAST,
) -> None:
    """Write the archives of ``pages`` to the new folder ``path``."""
    again = revisits(pages, page_id, html, least).withColumnRenamed("page_id", "of")
    digest = F.unhex(F.sha2(F.coalesce(F.col(html), F.lit("")).cast("binary"), 256))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), digest.alias("_digest"))
    marked = rows.join(again, (F.col("page_id") == F.col("of")) & (F.col("_digest") == F.col("digest")), "left")
    marked.select(record("page_id", "url", "html", "refers_to", date).alias("value")).write.option("lineSep", END.decode()).text(path)


def opened(uri: str) -> pa.NativeFile:
    uri = re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+", "file:///", uri))
    files, path = pyarrow.fs.FileSystem.from_uri(uri)
    return files.open_input_file(path)


def _headers(text: bytes) -> dict[str, str]:
    lines = text.decode().split("\r\n")[1:]
    return {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if re.fullmatch(r"-?\d+", number) else None


def captures_of(uri: str) -> Iterator[tuple]:
    """The captures of one archive, by its headers alone."""
    with opened(uri) as file:
        at, size = 0, file.size()
        while at < size:
            head = file.read_at(min(_HEAD, size - at), at)
            while (end := head.find(END)) < 0 or (inner := head.find(END, end + 4)) < 0:
                if len(head) >= size - at:
                    raise ValueError(f"{uri}: broken record at {at}")
                head = file.read_at(min(2 * len(head), size - at), at)
            warc, http = _headers(head[:end]), _headers(head[end + 4 : inner])
            length = end + 4 + int(warc["content-length"])
            url = warc.get("warc-target-uri")
            yield (
                surt(url), _page(warc["warc-record-id"]), url, warc["warc-type"], _page(warc.get("warc-refers-to")),
                warc["warc-payload-digest"].removeprefix("sha256:"), int(http["content-length"]), uri, at, length,
            )
            at += length + len(END)


def _batches(rows: Iterator[tuple], size: int = 10_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*held)) or [()] * len(_FIELDS)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=_FIELDS)

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch()
            held.clear()
    yield batch()


def files(spark: SparkSession, path: str) -> DataFrame:
    """Addresses of the files of a folder, a task for each few."""
    listed = spark.read.format("binaryFile").load(path).where("length > 0").select("path")
    return listed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")


def captures(spark: SparkSession, path: str) -> DataFrame:
    """Captures of all archives in a folder."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(row for b in batches for uri in b.column(0).to_pylist() for row in captures_of(uri))

    return files(spark, path).mapInArrow(read, CAPTURE)


#: Between the key and the rest of a line. No url of a record holds it: ``record`` escapes it.
GAP = "\r"


def line(row: tuple) -> bytes:
    """A capture as its key and the rest as JSON, on one line."""
    return f"{row[0]}{GAP}{json.dumps(row[1:])}\n".encode()


def capture(text: str) -> tuple:
    key, _, rest = text.partition(GAP)
    return (key, *json.loads(rest))


def index(spark: SparkSession, archives: str, path: str, lines: int = LINES) -> None:
    """Index the archives in a folder: ``path``/blocks and ``path``/directory."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = written(captures(spark, archives), "captures")
    order = ["key", "page_id", "file", "offset"]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []

        def block() -> pa.RecordBatch:
            squeezer = zlib.compressobj(wbits=31)
            data = squeezer.compress(b"".join(held)) + squeezer.flush()
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["value"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(line(row))
                if len(held) == lines:
                    yield block()
        if held:
            yield block()

    ordered = found.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(*_FIELDS)
    blocks = ordered.mapInArrow(packed, "value binary")
    # The text writer writes the bytes of a block as they are.
    blocks.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\n").text(f"{path}/blocks")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                with opened(uri) as file:
                    at, size = 0, file.size()
                    while at < size:
                        first, length = _first_line(file, at, size)
                        row = [[first.partition(GAP)[0]], [uri], [at], [length]]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(row, (pa.string(), pa.string(), pa.int64(), pa.int64()))],
                            names=["first_key", "file", "offset", "length"],
                        )
                        at += length + 1

    directory = files(spark, f"{path}/blocks").mapInArrow(listed, "first_key string, file string, offset bigint, length bigint")
    directory.orderBy("first_key", "file", "offset").write.parquet(f"{path}/directory")


def _first_line(file: pa.NativeFile, at: int, size: int) -> tuple[str, int]:
    """First line of the block at a place, and the block's length."""
    reader, text, read = zlib.decompressobj(wbits=31), b"", 0
    while not reader.eof:
        piece = file.read_at(min(1 << 16, size - at - read), at + read)
        if not piece:
            raise ValueError(f"broken block at {at}")
        more = reader.decompress(piece)
        if b"\n" not in text:
            text += more
        read += len(piece)
    return text[: text.index(b"\n")].decode(), read - len(reader.unused_data)


def indexed(spark: SparkSession, path: str) -> DataFrame:
    """All captures of an index."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(
            row for b in batches for uri, at, length in zip(*(c.to_pylist() for c in b.columns)) for row in block_at(uri, at, length)
        )

    entries = spark.read.parquet(f"{path}/directory").select("file", "offset", "length")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return entries.repartition(parts, "file", "offset").mapInArrow(read, CAPTURE)


def block_at(uri: str, at: int, length: int) -> list[tuple]:
    """The captures of one block."""
    with opened(uri) as file:
        text = zlib.decompress(file.read_at(length, at), wbits=31).decode()
    return [capture(found) for found in text.split("\n")[:-1]]


def keys_of(urls: DataFrame, url: str = "url") -> DataFrame:
    """``key`` of each different url."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(map(surt, batch.column(0).to_pylist()), pa.string())], names=["key"])

    return urls.select(escaped(url)).distinct().mapInArrow(keyed, "key string").distinct()


def blocks_of(key: str, firsts: list[str]) -> range:
    """Blocks, by number, that can hold a key: the last that begins before it, and those that begin with it."""
    return range(max(0, bisect_left(firsts, key) - 1), bisect_right(firsts, key))


def lookup(spark: SparkSession, path: str, urls: DataFrame, url: str = "url") -> DataFrame:
    """Captures of a table of urls, however many; each capture once.

    The driver holds the first key of each part of the directory. A key goes to the parts
    that can have its blocks; a task has the entries of one part and bisects them.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    directory = spark.read.parquet(f"{path}/directory").select("first_key", "file", "offset", "length", F.input_file_name().alias("part"))
    begins = directory.groupBy("part").agg(F.min(F.struct("first_key", "file", "offset")).alias("first")).orderBy("first").collect()
    names, fences = [row.part for row in begins], [row["first"].first_key for row in begins]
    kind = "part string, key string, file string, offset bigint, length bigint"

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(names[i], key) for key in batch.column(0).to_pylist() for i in blocks_of(key, fences)]
            to, keys = (list(c) for c in zip(*found)) if found else ([], [])
            none = [pa.nulls(len(to), t) for t in (pa.string(), pa.int64(), pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.string()), pa.array(keys, pa.string()), *none], names=["part", "key", "file", "offset", "length"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, firsts, places = None, [], []
        for batch in batches:
            found = []
            for part, key, file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if part != of:
                    of, firsts, places = part, [], []
                if file is not None:  # entries of a part stand before its keys
                    firsts.append(key)
                    places.append((file, offset, length))
                else:
                    found += [(part, key, *places[i]) for i in blocks_of(key, firsts)]
            columns = list(zip(*found)) or [()] * 5
            types = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["part", "key", "file", "offset", "length"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            asked = (row for batch in batches for row in zip(*(batch.column(n).to_pylist() for n in ("file", "offset", "length", "key"))))
            for place, keys in groupby(asked, key=lambda row: row[:3]):
                wanted = {row[3] for row in keys}
                yield from (found for found in block_at(*place) if found[0] in wanted)

        yield from _batches(rows())

    entries = directory.select("part", F.col("first_key").alias("key"), "file", "offset", "length")
    sent = keys_of(urls, url).mapInArrow(dealt, kind)
    both = entries.unionByName(sent).repartition(parts, "part")
    searched = both.sortWithinPartitions("part", F.col("file").isNull(), "key", "file", "offset").mapInArrow(search, kind)
    blocks = searched.select("file", "offset", "length", "key").distinct().repartition(parts, "file", "offset")
    return blocks.sortWithinPartitions("file", "offset", "length").mapInArrow(read, CAPTURE)


def records(found: DataFrame) -> DataFrame:
    """``found`` captures with ``payload``: the bytes of responses, null for revisits.

    Each archive's ranges are read in the order they have there.
    """
    spark = found.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = found.repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset").select(*_FIELDS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, of = None, None
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                payloads = []
                for kind, uri, at, length in zip(*(part.column(n).to_pylist() for n in ("record_type", "file", "offset", "length"))):
                    if uri != of:
                        if file is not None:
                            file.close()
                        file, of = opened(uri), uri
                    body = file.read_at(length, at).split(END, 2)[2]
                    payloads.append(body if kind == "response" else None)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(payloads, pa.binary())], names=[*_FIELDS, "payload"])
        if file is not None:
            file.close()

    return ordered.mapInArrow(read, f"{CAPTURE}, payload binary")
