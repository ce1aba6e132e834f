"""Operator 9, WARC archives with a two-level capture index.

``write`` puts one WARC/1.1 record per page into gzip members of archive
files (one file per task and ``ARCHIVE_BYTES``) and builds the index:

* level 2: index lines sorted by reversed-host URL key, ``BLOCK_LINES`` lines
  to a compressed block, the blocks of a partition in one file;
* level 1: the sparse block directory, one row (first key, file, offset,
  length) per block, kept as a small table.

``lookup`` finds records by their URLs: a key is binary-searched among the
bounds of the index files (one pair per ``FILE_LINES`` captures, the only part
of the index that the driver sees), goes to the tasks of the files that may hold
it, is binary-searched there in the file's part of the directory, then in the
lines of the blocks it names, which are read by range, and so are the records.
``read`` goes through all blocks and reads every record back, in archive order.

Files are written by the tasks through ``pyarrow.fs`` into the shared folder
(any URI it knows: file, hdfs, s3, gs).  A file's name holds a fresh id and is
only known through the row its task returns, so a lost or repeated task
leaves at most a file that nothing refers to.

Of records with equal payloads of ``REVISIT_BYTES`` or more, the one with the
largest page_id is a response, the others are revisits without payload that
refer to it; smaller ones are all responses.

Defined results: null html is an empty payload; a null url has the empty key;
a null page_id is written as an empty id and never referred to (equal
payloads whose ids are all null are all responses); rows that repeat the
largest page_id are all responses; an empty table writes no file; other
columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import arrow_session, materialize, shared_path

REVISIT_BYTES = 1000
READ_BYTES = 64 << 20         # archive bytes that one task reads back
ARCHIVE_BYTES = 64 << 20      # compressed bytes of an archive file
BLOCK_LINES = 1000            # index lines in a block
FILE_LINES = 250_000          # index lines, about, of an index file
LEVEL = 1                     # zlib level of records and blocks
DATE = "1970-01-01T00:00:00Z"  # the tables have no capture time


def url_key(url: str | None) -> str:
    """Reversed-host key: ``http://www.a.example.com:80/x?q#f`` becomes
    ``com,example,a,www)/x?q``; scheme, port and fragment play no part."""
    rest = (url or "").split("#", 1)[0]
    rest = rest.split("://", 1)[-1]
    cut = min((i for i in (rest.find("/"), rest.find("?")) if i >= 0), default=len(rest))
    host, path = rest[:cut].rsplit("@", 1)[-1].split(":", 1)[0].lower(), rest[cut:]
    return f"{','.join(reversed(host.split('.')))}){path or '/'}" if host or path else ""


def _open(path: str):
    fs, base = pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return fs, base


class _Out:
    """A file being written in the shared folder."""

    def __init__(self, folder: str, suffix: str):
        self.name = f"{folder}/{uuid.uuid4().hex}{suffix}"
        fs, base = _open(self.name)
        fs.create_dir(base.rsplit("/", 1)[0], recursive=True)
        self.stream, self.size = fs.open_output_stream(base, compression=None), 0

    def write(self, data: bytes) -> tuple[int, int]:
        at, self.size = self.size, self.size + len(data)
        self.stream.write(data)
        return at, len(data)


class _In:
    """Open files of a task; a range read seeks and reads only the range."""

    def __init__(self):
        self.files: dict = {}

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name not in self.files:
            if len(self.files) >= 64:
                self.files.pop(next(iter(self.files))).close()
            fs, base = _open(name)
            self.files[name] = fs.open_input_file(base)
        return self.files[name].read_at(length, offset)


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _gunzip(data: bytes) -> bytes:
    return zlib.decompress(data, 31)


def _clean(value: str) -> str:
    """A header value in one line: control characters and % are escaped."""
    return "".join(f"%{ord(c):02X}" if c < " " or c in "%\x7f" else c for c in value)


def _unclean(value: str) -> str:
    head, *rest = value.split("%")
    return head + "".join(chr(int(x[:2], 16)) + x[2:] for x in rest)


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record.  A revisit keeps digest and length of the payload it
    leaves out; WARC-Refers-To names the response's record."""
    kind = "response" if refers_to is None else "revisit"
    block = payload if refers_to is None else b""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page_id)}",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {_clean(url or '')}",
            f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {len(payload)}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_record_id(refers_to)}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def _record_id(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def parse(data: bytes) -> tuple[dict, bytes]:
    """(headers, block) of a record, its length taken from Content-Length."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    n = int(headers["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return headers, rest[:n]


def _id_of(value: str):
    x = value[len("<urn:page:"):-1]
    return int(x) if x else None


class Archive:
    """A written archive: its folder, record lines and block directory."""

    def __init__(self, lines: DataFrame, directory: DataFrame):
        self.lines, self.directory = lines, directory


_LINE = "key string, page_id long, file string, offset long, length long"
_DIRECTORY = "first_key string, last_key string, file string, offset long, length long, lines long"


def write(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html",
          archive_bytes: int = ARCHIVE_BYTES, block_lines: int = BLOCK_LINES) -> Archive:
    """Write archives and index of all ``pages`` into the shared folder."""
    spark = arrow_session(pages)
    folder = shared_path(spark, "warc")
    page = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
                        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    page = page.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    # the responses of repeated payloads; copies are pre-aggregated in the tasks
    again = (page.where(F.col("size") >= REVISIT_BYTES).groupBy("digest")
             .agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1").drop("n"))
    page = page.join(again, "digest", "left").withColumn(
        "refers_to", F.when((F.col("size") >= REVISIT_BYTES) & F.col("last").isNotNull()
                            & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")))

    def records(batches):
        out = None
        for b in batches:
            rows = [[] for _ in range(5)]
            for pid, u, body, digest, ref in zip(*(b.column(i).to_pylist() for i in range(5))):
                if out is None or out.size >= archive_bytes:
                    if out is not None:
                        out.stream.close()
                    out = _Out(folder, ".warc.gz")
                at, size = out.write(_gzip(record(pid, u, body, digest, ref)))
                for x, y in zip(rows, (url_key(u), pid, out.name, at, size)):
                    x.append(y)
            yield _batch(rows, (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()),
                         ("key", "page_id", "file", "offset", "length"))
        if out is not None:
            out.stream.close()

    lines = materialize(page.select("page_id", "url", "payload", "digest", "refers_to")
                        .mapInArrow(records, _LINE), "lines")

    def blocks(batches):
        out, held, rows = None, [], []
        for b in batches:
            held += zip(*(c.to_pylist() for c in b.columns))
            while len(held) >= block_lines:
                out = _block(folder, out, held[:block_lines], rows)
                held = held[block_lines:]
        if held:
            out = _block(folder, out, held, rows)
        if out is not None:
            out.stream.close()
            yield _batch(list(zip(*rows)), (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()),
                         ("first_key", "last_key", "file", "offset", "length", "lines"))

    # long runs of one key spread over several partitions: the page id and
    # the place are part of the order
    order = ["key", "page_id", "file", "offset"]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-lines.count() // FILE_LINES))
    directory = materialize(lines.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                            .mapInArrow(blocks, _DIRECTORY), "directory")
    return Archive(lines, directory)


def _batch(columns, types, names):
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=list(names))


def _block(folder, out, lines, rows):
    if out is None:
        out = _Out(folder, ".idx")
    text = "\n".join("\t".join([_clean(k), "" if p is None else str(p), f, str(o), str(n)])
                     for k, p, f, o, n in lines)
    at, size = out.write(zlib.compress(text.encode(), LEVEL))
    rows.append((lines[0][0], lines[-1][0], out.name, at, size, len(lines)))
    return out


def read_block(files: _In, name: str, offset: int, length: int) -> list[tuple]:
    """(key, page_id, file, offset, length) of a block's lines, in order."""
    text = zlib.decompress(files.read(name, offset, length)).decode()
    out = []
    for line in text.split("\n"):
        k, p, f, o, n = line.split("\t")
        out.append((_unclean(k), int(p) if p else None, f, int(o), int(n)))
    return out


_CAPTURE = ("page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
            "record_type string, refers_to long")


def _captures(batches):
    """Read the records at (file, offset, length)."""
    files = _In()
    for b in batches:
        for lo in range(0, b.num_rows, 256):
            part = b.slice(lo, 256)
            rows = [[] for _ in range(7)]
            for f, o, n in zip(*(part.column(i).to_pylist() for i in range(3))):
                h, body = parse(_gunzip(files.read(f, o, n)))
                kind, digest = h["WARC-Type"], h["WARC-Payload-Digest"].split(":", 1)[1]
                size = int(h["WARC-Payload-Length"])
                if kind == "response" and (hashlib.sha1(body).hexdigest() != digest or len(body) != size):
                    raise ValueError(f"record at {f}:{o} does not match its digest")
                ref = _id_of(h["WARC-Refers-To"]) if kind == "revisit" else None
                for x, y in zip(rows, (_id_of(h["WARC-Record-ID"]), _unclean(h["WARC-Target-URI"]),
                                       body if kind == "response" else None, size, digest, kind, ref)):
                    x.append(y)
            yield _batch(rows, (pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()),
                         ("page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def read(archive: Archive) -> DataFrame:
    """Every capture, found through the directory and its blocks and read from
    the archives in file order."""
    spark = arrow_session(archive.directory)

    def lines(batches):
        files = _In()
        for b in batches:
            for f, o, n in zip(*(b.column(i).to_pylist() for i in range(3))):
                got = list(zip(*read_block(files, f, o, n)))
                yield _batch(got[2:], (pa.string(), pa.int64(), pa.int64()), ("file", "offset", "length"))

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = (archive.directory.select("file", "offset", "length").repartition(parts, "file", "offset")
          .mapInArrow(lines, "file string, offset long, length long"))
    return _records(archive, at)


def _records(archive: Archive, at: DataFrame) -> DataFrame:
    """The captures at (file, offset, length).  The places are small, what they
    point to is not: partitions by the bytes of all records (a stated number is
    not coalesced)."""
    parts = int(at.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = archive.lines.agg(F.sum("length")).first()[0] or 0
    return (at.repartitionByRange(max(parts, -(-size // READ_BYTES)), "file", "offset")
            .sortWithinPartitions("file", "offset").mapInArrow(_captures, _CAPTURE))


def lookup(archive: Archive, urls: DataFrame, *, url: str = "url") -> DataFrame:
    """The captures of the given urls (distinct keys), by binary search.  A key
    with very many captures has lines in several index files, whose tasks each
    find their part of them."""
    spark = arrow_session(urls)
    bounds = sorted(tuple(r) for r in archive.directory.groupBy("file")
                    .agg(F.min("first_key"), F.max("last_key")).select("min(first_key)", "max(last_key)", "file").collect())
    known = spark.sparkContext.broadcast(bounds)

    def files(batches):
        first, last = [b[0] for b in known.value], [b[1] for b in known.value]
        for b in batches:
            rows = []
            for key in map(url_key, b.column(0).to_pylist()):
                # files are ranges of the order, so both bounds ascend
                for i in range(bisect.bisect_left(last, key), bisect.bisect_right(first, key)):
                    rows.append((key, known.value[i][2]))
            yield _batch(list(zip(*rows)) or [[], []], (pa.string(), pa.string()), ("key", "file"))

    keys = urls.select(F.col(url).alias("u")).distinct().mapInArrow(files, "key string, file string").distinct()
    at = (keys.groupBy("file").cogroup(archive.directory.groupBy("file"))
          .applyInArrow(_search, "file string, offset long, length long"))
    return _records(archive, at)


def _search(keys: pa.Table, directory: pa.Table) -> pa.Table:
    """The lines of ``keys`` in one index file."""
    blocks = sorted(zip(*(directory[c].to_pylist() for c in ("first_key", "last_key", "file", "offset", "length"))),
                    key=lambda b: b[3])
    last = [b[1] for b in blocks]
    files, at, lines, rows = _In(), None, [], [[], [], []]
    for key in sorted(keys["key"].to_pylist()):
        i = bisect.bisect_left(last, key)              # first block that may hold it
        while i < len(blocks) and blocks[i][0] <= key:
            if at != i:
                at, lines = i, read_block(files, *blocks[i][2:5])
            k = bisect.bisect_left(lines, key, key=lambda x: x[0])
            while k < len(lines) and lines[k][0] == key:
                for x, y in zip(rows, lines[k][2:]):
                    x.append(y)
                k += 1
            i += 1
    return pa.table({"file": pa.array(rows[0], pa.string()), "offset": pa.array(rows[1], pa.int64()),
                     "length": pa.array(rows[2], pa.int64())})


ORACLE = f"""
WITH p AS (SELECT page_id, sha1(encode(coalesce(html, ''))) AS payload_digest,
                  CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes FROM pages),
r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {REVISIT_BYTES} AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {REVISIT_BYTES} AND page_id <> last THEN last END AS refers_to
FROM r"""
