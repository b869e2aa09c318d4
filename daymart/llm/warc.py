"""WARC archives: a writer, and a reader that splits files by byte ranges.

The writer makes one gzip member for each record. The first record of a payload
(that of the smallest page_id) is a response, later ones are revisits that name
it. The reader deals byte ranges of all files to tasks. A task looks for the
gzip magic from its first byte on, takes a candidate for a record only when its
header decodes to a WARC version line, owns every record that begins in its
range and follows the last one past the range's end. So each record is read
once, whatever the ranges.

Defined results: a null html is an empty payload; page_ids that are null are
written without an id and come back null, and are only referred to by nobody;
rows with one page_id and payload are a response each when theirs is the
smallest; urls may be null or hold any characters (they are percent-encoded);
very long html is one record, held whole by the task that owns it; an empty
table gives no file and no rows. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymart.llm.files import file_system, finished_file, listed
from daymart.operators.scratch import scratch_path

MAGIC = b"\x1f\x8b\x08"
SUFFIX = ".warc.gz"
#: Compressed bytes of one range.
RANGE_BYTES = 2 << 20
DATE = "2024-01-01T00:00:00Z"
_VERSION = b"WARC/1."
_STEP = 1 << 16
_ID = "urn:page:"
_SAFE = "/:?&=#%+,;@!$'()*[]~"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member of its own; ``refers_to`` makes it a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = {
        "WARC-Type": "revisit" if refers_to is not None else "response",
        "WARC-Record-ID": None if page_id is None else f"<{_ID}{page_id}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": None if url is None else quote(url, safe=_SAFE),
        "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
        "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if refers_to is not None else None,
        "WARC-Refers-To": None if refers_to is None else f"<{_ID}{refers_to}>",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None) + "\r\n"
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode().split(":", 1) for line in lines if b":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def _page(value: str | None) -> int | None:
    return int(value.strip("<>").removeprefix(_ID)) if value else None


def parse(data: bytes) -> tuple:
    """The row of one record from its uncompressed bytes."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head.split(b"\r\n")[1:])
    block = rest[: int(fields["content-length"])]
    http_head, _, payload = block.partition(b"\r\n\r\n")
    http = _fields(http_head.split(b"\r\n")[1:])
    kind = fields["warc-type"]
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response":
        if payload_digest(payload) != digest:
            raise ValueError(f"payload of {fields.get('warc-record-id')} does not fit its digest")
        length = len(payload)
    else:
        length, payload = int(http["content-length"]), None
    page_id, refers_to = _page(fields.get("warc-record-id")), _page(fields.get("warc-refers-to"))
    return page_id, fields.get("warc-target-uri"), kind, refers_to, length, digest, payload


class _Window:
    """A file read forward in steps, addressed by its own offsets."""

    def __init__(self, stream, start: int):
        stream.seek(start)
        self.stream, self.start, self.data, self.done = stream, start, b"", False

    def fill(self, end: int) -> None:
        while self.start + len(self.data) < end and not self.done:
            more = self.stream.read(_STEP)
            self.done = not more
            self.data += more

    def drop(self, before: int) -> None:
        self.data = self.data[before - self.start :]
        self.start = before

    def find(self, at: int, end: int) -> int | None:
        """The first magic that begins in [at, end)."""
        while at < end:
            self.fill(min(end, at + _STEP) + len(MAGIC))
            place = self.data.find(MAGIC, at - self.start)
            if place >= 0:
                return self.start + place if self.start + place < end else None
            stop = self.start + len(self.data)
            if self.done:
                return None
            at = max(at, stop - len(MAGIC) + 1)
            self.drop(min(at, stop))
        return None

    def member(self, at: int) -> tuple[bytes, int] | None:
        """Content and end of the record that begins at ``at``, if one does."""
        unpacker = zlib.decompressobj(31)
        parts, place, checked = [], at, False
        while not unpacker.eof:
            self.fill(place + _STEP)
            piece = self.data[place - self.start : place - self.start + _STEP]
            if not piece:
                return None
            try:
                out = unpacker.decompress(piece)
            except zlib.error:
                return None
            place += len(piece)
            parts.append(out)
            if not checked and (seen := b"".join(parts)) and len(seen) >= len(_VERSION):
                if not seen.startswith(_VERSION):
                    return None
                checked = True
        return (b"".join(parts), place - len(unpacker.unused_data)) if checked else None


def records_of_range(stream, start: int, end: int) -> Iterator[bytes]:
    """Records that begin in [start, end) of an archive."""
    window = _Window(stream, start)
    at = window.find(start, end)
    while at is not None:
        found = window.member(at)
        if found is None:
            # Magic inside of something else: go on behind it.
            at = window.find(at + 1, end)
            continue
        content, stop = found
        yield content
        window.drop(stop)
        at = window.find(stop, end) if stop < end else None


def write_warc(pages: DataFrame, folder: str, *, min_bytes: int = 0) -> None:
    """Write a record for each row of ``pages`` (page_id, url, html)."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(F.encode(html, "UTF-8")).alias("digest"))
    # Copies of a payload meet in a partial minimum; only digests are joined.
    first = rows.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    first = first.filter("n > 1").select("digest", "first")
    long_enough = F.octet_length("html") >= min_bytes
    later = long_enough & (~F.col("page_id").eqNullSafe(F.col("first")))
    refers_to = F.when(later, F.col("first")).alias("refers_to")
    joined = rows.join(first, "digest", "left").select("page_id", "url", "html", refers_to)
    # The join deals the rows already; a task writes as it reads, so a part of
    # any size is one file.
    dealt = joined.withColumn("part", F.spark_partition_id())

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stream, held, n = None, None, 0
        try:
            for frame in frames:
                for page_id, url, html, refers, part in frame.itertuples(index=False, name=None):
                    if held is None:
                        held = finished_file(f"{folder}/part-{part:08d}{SUFFIX}")
                        stream = held.__enter__()
                    known = None if pd.isna(page_id) else int(page_id)
                    target = None if pd.isna(refers) else int(refers)
                    stream.write(record(known, url, html.encode("utf-8", "surrogatepass"), target))
                    n += 1
        except BaseException as error:
            if held is not None:
                held.__exit__(type(error), error, error.__traceback__)
            raise
        if held is not None:
            held.__exit__(None, None, None)
        yield pd.DataFrame({"records": [n]})

    dealt.mapInPandas(write, "records long").agg(F.sum("records")).first()


def read_warc(spark: SparkSession, folder: str, *, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of all archives of a folder."""
    files = listed(spark, folder, f"*{SUFFIX}")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes)))
    ranges = files.select("path", "length", starts.alias("start"))
    # A row is a few bytes here and some MB of work in its task.
    size = files.agg(F.sum("length")).first()[0] or 0
    dealt = ranges.repartition(size // range_bytes + 1, F.xxhash64("path", "start"))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
        for frame in frames:
            for path, length, start in frame.itertuples(index=False, name=None):
                system, name = file_system(path)
                rows, held = [], 0
                with system.open_input_file(name) as stream:
                    for content in records_of_range(stream, start, min(start + range_bytes, length)):
                        rows.append(parse(content))
                        held += len(content)
                        if held > 8 << 20:
                            yield _frame(rows, names)
                            rows, held = [], 0
                yield _frame(rows, names)

    return dealt.mapInPandas(read, RECORD)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    for name in ("page_id", "refers_to"):
        frame[name] = frame[name].astype("Int64")
    return frame


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write the table as archives in the shared folder and read them back."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    write_warc(pages, folder)
    if not has_archive(folder):
        return spark.createDataFrame([], RECORD)
    return read_warc(spark, folder)


def has_archive(folder: str) -> bool:
    from pyarrow import fs

    system, path = file_system(folder)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return any(f.path.endswith(SUFFIX) for f in found)
