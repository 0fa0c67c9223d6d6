"""WARC archives with a Zstandard dictionary, written and read by Spark.

An archive starts with a skippable frame that holds the dictionary; every record is a frame
of its own. Spark's text writer commits the files, so a lost executor leaves no torn archive
and any file system will do. The writer needs a line separator; an empty skippable frame,
which happens to consist of ASCII bytes, is one, and readers of the format pass over it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from levygrid.llm.common import Scratch, slices
from levygrid.operators.lookup import Dimension, lookup_join
from levygrid.operators.stages import scratch_path

#: Fixed values of the formats.
_FRAME = 0xFD2FB528
_SKIPPABLE = range(0x184D2A50, 0x184D2A60)
_DICTIONARY = 0x184D2A5D
_EMPTY_FRAME = struct.pack("<II", 0x184D2A50, 0).decode("ascii")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD_ID = "urn:page:"

#: The dictionary is trained on about this many records, of each a block of ``SAMPLE_BYTES`` characters at most.
SAMPLE_RECORDS = 512
SAMPLE_BYTES = 32 << 10
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
#: Payloads from here on may be revisits.
MIN_REVISIT_BYTES = 0
_BROADCAST = 16 << 20
_SALTS = 64
_BATCH_BYTES = 4 << 20


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """A response record, or a revisit record without payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<{_RECORD_ID}{'' if page_id is None else page_id}>",
        "WARC-Date": date,
        "WARC-Target-URI": target,
        "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
        "WARC-Block-Digest": f"sha1:{payload_digest(block)}",
    }
    if revisit:
        fields["WARC-Profile"] = _PROFILE
        fields["WARC-Refers-To"] = f"<{_RECORD_ID}{'' if refers_to is None else refers_to}>"
    fields["Content-Type"] = "application/http; msgtype=response"
    fields["Content-Length"] = str(len(block))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def frame_end(data: bytes, at: int) -> int:
    """Where the frame at ``at`` ends, by its header and the heads of its blocks."""
    (magic,) = struct.unpack_from("<I", data, at)
    if magic in _SKIPPABLE:
        return at + 8 + struct.unpack_from("<I", data, at + 4)[0]
    if magic != _FRAME:
        raise ValueError(f"no frame at byte {at}")
    mark = data[at + 4]
    single, checksum = mark >> 5 & 1, mark >> 2 & 1
    size = (0, 2, 4, 8)[mark >> 6] or single
    at += 5 + (not single) + (0, 1, 2, 4)[mark & 3] + size
    while True:
        block = int.from_bytes(data[at : at + 3], "little")
        at += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
        if block & 1:
            return at + 4 * checksum


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary of the samples; the samples themselves if they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def _shared_dictionary(pages: DataFrame) -> bytes:
    """Trained on the driver from a sample of bounded number and size, taken by hash.

    Of a record longer than ``SAMPLE_BYTES`` one of its blocks is taken, by another hash, so that records
    of any size take part and the sample's size stays bounded.
    """
    rows = pages.agg(F.count(F.lit(1)).alias("n")).first()["n"]

    def drawn(*columns: str):
        return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / (1 << 30)

    blocks = F.greatest(F.lit(1), F.ceil(F.length("html") / SAMPLE_BYTES))
    place = (F.floor(drawn("page_id", "html") * blocks) * SAMPLE_BYTES + 1).cast("int")
    sample = pages.where(drawn("html", "page_id") < SAMPLE_RECORDS / max(1, rows)).select(
        "page_id", "url", F.col("html").substr(place, F.lit(SAMPLE_BYTES)).alias("block")
    )
    return train_dictionary([
        record(r["page_id"], r["url"], r["block"].encode("utf-8", "surrogatepass"), None, False, "")
        for r in sample.limit(2 * SAMPLE_RECORDS).collect()
    ])


def revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(row, refers_to) of the pages whose payload another page archives.

    Of equal payloads that of the greatest page_id is archived, of equal ids the first row.
    Payloads are grouped by digest with partial sums; only digests that occur twice
    or more are joined back, to rows of a digest and two numbers.
    """
    narrow = pages.where(F.octet_length("html") >= min_bytes).select(
        "row", "page_id", F.unhex(F.sha1(F.col("html").cast("binary"))).alias("digest")
    )
    narrow = Scratch(pages.sparkSession).write(narrow)
    archived = (
        narrow.groupBy("digest")
        .agg(F.max(F.struct("page_id", (-F.col("row")).alias("row"))).alias("top"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .select("digest", F.col("top.page_id").alias("refers_to"), (-F.col("top.row")).alias("kept"))
    )
    dim = Dimension(archived, ["digest"], _BROADCAST, _SALTS)
    joined = lookup_join(narrow, dim, {"digest": F.col("digest")}, "inner", ["row"])
    return joined.where(F.col("row") != F.col("kept")).select("row", "refers_to")


def write_archives(
    df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    min_bytes: int = MIN_REVISIT_BYTES, date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Archive every row of ``df`` in the files of a new folder, one file for each task.

    A null payload is empty, a null url is ``about:blank``, a null id has an empty record
    id. Repeated rows are archived each, as revisits but for one. ``df`` must give the same rows
    in the same order when read again, as tables do. Other columns of ``df`` are not read.
    """
    pages = df.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
        F.monotonically_increasing_id().alias("row"),
    )
    dictionary = _shared_dictionary(pages)
    dim = Dimension(revisits(pages, min_bytes).select(F.col("row").alias("__of"), "refers_to", F.lit(True).alias("revisit")), ["__of"], _BROADCAST, _SALTS)
    decided = lookup_join(pages, dim, {"__of": F.col("row")}, "left", ["row"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        as_dictionary = zstandard.ZstdCompressionDict(dictionary)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=as_dictionary)
        started = False
        for batch in slices(batches, 2, _BATCH_BYTES):
            out = []
            if not started:
                started = True
                out.append(struct.pack("<II", _DICTIONARY, len(dictionary)) + dictionary)
                info = "WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:page:info>\r\n"
                info += f"WARC-Date: {date}\r\nContent-Type: application/warc-fields\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
                out.append(packer.compress(info.encode()))
            html = batch.column(2).cast(pa.binary())
            rest = (batch.column(i).to_pylist() for i in (0, 1, 3, 4))
            for page_id, url, refers_to, revisit, payload in zip(*rest, html):
                out.append(packer.compress(record(page_id, url, payload.as_py(), refers_to, revisit, date)))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    frames = decided.select(
        "page_id", "url", "html", "refers_to", F.coalesce("revisit", F.lit(False)).alias("revisit")
    ).mapInArrow(run, "frame binary")
    frames.select(F.col("frame").cast("string").alias("value")).write.text(path, lineSep=_EMPTY_FRAME)


_FIELDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _parsed(raw: bytes) -> tuple | None:
    """The columns of ``_FIELDS`` from a record; None for other types of records."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(re.findall(r"(?m)^([\w-]+): (.*?)\r?$", head.decode("utf-8", "replace")))
    kind = fields["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(re.search(rb"(?mi)^Content-Length: (\d+)", http)[1])
    if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")

    def page(name: str) -> int | None:
        number = fields.get(name, "").strip("<>").removeprefix(_RECORD_ID)
        return int(number) if number else None

    return page("WARC-Record-ID"), size, digest, kind, page("WARC-Refers-To") if kind == "revisit" else None


def records_of(data: bytes) -> Iterator[bytes]:
    """The records of an archive's bytes."""
    at, unpacker = 0, zstandard.ZstdDecompressor()
    while at < len(data):
        end = frame_end(data, at)
        (magic,) = struct.unpack_from("<I", data, at)
        if magic == _DICTIONARY:
            unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[at + 8 : end]))
        elif magic == _FRAME:
            yield unpacker.decompress(data[at:end])
        at = end


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row for each response or revisit record; payloads are checked against their digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _FIELDS.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            for data in batch.column(0):
                rows = [r for r in map(_parsed, records_of(data.as_py())) if r]
                columns = zip(*rows) if rows else [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, _FIELDS)


def archived(df: DataFrame, **options) -> DataFrame:
    """Write ``df`` as archives to the shared folder and read them back; see ``read_archives``."""
    path = scratch_path(df.sparkSession, "warc")
    write_archives(df, path, **options)
    return read_archives(df.sparkSession, path)
