"""WARC archives with an index that comes first.

Tasks write archives of single gzip members and return one index row per record: file, offset, length, url and digest.
Reading starts from index rows, whichever are wanted: sorted by file and offset, near records are fetched with one
byte-range read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import store
from panelmill.session import scratch_path

RESPONSE, REVISIT = "response", "revisit"
#: A file is closed when it reaches this size; a range read fetches at most RANGE bytes and skips gaps up to GAP.
ROLL, RANGE, GAP = 256 << 20, 8 << 20, 64 << 10
DATE = "2020-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + uri)


def _one_line(s: str) -> str:
    return s.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str, payload: bytes, sha: str, refers_to: int | None) -> bytes:
    """One gzip member. A revisit has no payload of its own, only the digest and length of the full one."""
    revisit = refers_to is not None
    head = [
        "WARC/1.1", f"WARC-Type: {REVISIT if revisit else RESPONSE}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {_one_line(url)}", f"WARC-Payload-Digest: sha1:{sha}",
        f"X-Payload-Length: {len(payload)}", "Content-Type: text/html; charset=utf-8",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    body = b"" if revisit else payload
    head.append(f"Content-Length: {len(body)}")
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + pack.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    return fields, rest[: int(fields["Content-Length"])]


def _page(urn: str | None) -> int | None:
    value = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value else None


INDEX = "page_id bigint, url string, file string, offset bigint, length bigint, digest string"


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write (page_id, url, payload, refers_to) to archives in ``folder``, a shared one; the stored index comes back.

    Every task attempt writes files under new names and the index names only those of attempts that ended, so a lost
    executor or a second attempt leaves at worst a file that nothing refers to.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = open_folder(folder)
        out, name, at = None, "", 0
        try:
            for b in batches:
                rows = []
                for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in b.columns)):
                    if out is None or at >= ROLL:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        where.create_dir(root, recursive=True)
                        out = where.open_output_stream(f"{root}/{name}", compression=None)
                    sha = digest(payload)
                    data = record(page_id, url, payload, sha, refers_to)
                    out.write(data)
                    rows.append((page_id, url, name, at, len(data), sha))
                    at += len(data)
                cols = list(zip(*rows)) or [[]] * 6
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds)], ["page_id", "url", "file", "offset", "length", "digest"])
        finally:
            if out is not None:
                out.close()

    return store(records.select("page_id", "url", "payload", "refers_to").mapInArrow(write, INDEX), "warc-index").df


READ = "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that ``index`` names, as page_id, url, payload (null for a revisit), payload_bytes, payload_digest, ...

    Rows are dealt by file and stretch of RANGE bytes and sorted by offset; records at most GAP bytes apart are read
    together. A payload that does not have the digest of its index row raises.
    """
    dealt = (index.select("file", "offset", "length", "digest")
             .repartition(F.col("file"), F.floor(F.col("offset") / RANGE)).sortWithinPartitions("file", "offset"))

    def ranges(rows: list[tuple]) -> Iterator[list[tuple]]:
        run: list[tuple] = []
        for r in rows:
            end = run[-1][1] + run[-1][2] if run else 0
            if run and (r[0] != run[0][0] or r[1] - end > GAP or r[1] + r[2] - run[0][1] > RANGE):
                yield run
                run = []
            run.append(r)
        if run:
            yield run

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = open_folder(folder)
        for b in batches:
            for run in ranges(list(zip(*(c.to_pylist() for c in b.columns)))):
                with where.open_input_file(f"{root}/{run[0][0]}") as source:
                    start = run[0][1]
                    data = source.read_at(run[-1][1] + run[-1][2] - start, start)
                rows = []
                for _, offset, length, sha in run:
                    fields, body = parse(data[offset - start: offset - start + length])
                    refers_to, kind = _page(fields.get("WARC-Refers-To")), fields["WARC-Type"]
                    if fields["WARC-Payload-Digest"] != f"sha1:{sha}" or kind == RESPONSE and digest(body) != sha:
                        raise ValueError(f"{run[0][0]} at {offset}: the payload does not match the index")
                    rows.append((_page(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], body if kind == RESPONSE else None,
                                 int(fields["X-Payload-Length"]), sha, kind, refers_to))
                cols = list(zip(*rows))
                kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], [x.split()[0] for x in READ.split(", ")])

    return dealt.mapInArrow(read, READ)


def archive_pages(
    pages: DataFrame, folder: str | None = None, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> tuple[DataFrame, str]:
    """Write one record per page and return the index and the folder.

    Null html is an empty payload, a null url an empty one. Of pages with equal payloads of at least ``least_bytes``
    bytes the one with the smallest id is a response and the others are revisits that refer to it; shorter payloads
    are all responses. Rows that repeat the smallest id are responses too; pages without an id come last and cannot be
    referred to. No pages: an empty index. Runs the writing when called.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"))
    keyed = rows.withColumn("same", F.unhex(F.sha2("payload", 256)))
    repeated = store(
        keyed.where(F.octet_length("payload") >= least_bytes).groupBy("same")
        .agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first"))
        .where("n > 1 and first is not null").select("same", "first"),
        "warc-repeats").df
    records = keyed.join(repeated, "same", "left").select(
        "page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))
    return write_archives(records, folder), folder
