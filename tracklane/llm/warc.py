"""WARC archives with a two-level capture index.

Every page becomes a gzip member with one WARC/1.1 record, members of a task follow each
other as in a file, and the archive is a table of (archive, offset, length, member), which
any store that Spark writes to can hold; members in order of offset are a ``.warc.gz``.
Equal payloads of at least ``MIN_REVISIT`` bytes are stored once: the others are revisit
records that refer to the smallest page id.

The index has two levels. Lines (reversed-host URL key, place, page) are sorted over all
archives and cut into compressed blocks; a sparse directory keeps the first and last key of
every block. A look-up searches the directory, then the lines of the blocks it names, and
only then gets the members at the places found: a few by a filter on the table, more by
a join with it. The directory has at most about ``DIRECTORY_BLOCKS``
entries with keys cut to ``DIRECTORY_KEY`` characters, whatever the archive's size; blocks
grow instead. It is the only thing that is sent to all tasks.

Defined cases: null html is an empty payload; a null url is an empty one; a null page id is
no candidate for the smallest, unless all are null, and then all are responses; rows that
repeat the smallest id are all responses; other columns are ignored whatever their names;
empty tables give empty results; payloads of any length are stored whole.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklane.session import settle

MIN_REVISIT = 100
BLOCK_LINES = 3000
DIRECTORY_BLOCKS = 100_000
DIRECTORY_KEY = 256
#: Copies of a block of index lines, among which its look-ups are dealt.
BLOCK_COPIES = 4
#: Look-ups with fewer captures filter the table for them; others read the archives through.
RANGE_READS = 1000

_RECORD = (
    "archive long, offset long, length long, page_id long, uri string, key string, "
    "payload_bytes long, payload_digest string, record_type string, refers_to long"
)
_CONTROL = re.compile("[\x00-\x20\x7f]")


# ---- records ---------------------------------------------------------------------


def target_uri(url: str | None) -> str:
    """The URL as a header may hold it: white space and control characters escaped."""
    return _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url or "")


def url_key(uri: str) -> str:
    """Sort key: host labels from right to left, then the rest: ``com,example,www)/path``."""
    _, found, rest = uri.partition("://")
    if not found:
        return uri
    end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    return ",".join(reversed(rest[:end].lower().split("."))) + ")" + rest[end:]


def record(page_id, uri: str, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record: a response with its payload, or a revisit with just the HTTP head."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Target-URI": uri,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Type": "application/http; msgtype=response",
    }
    if refers_to is not None:
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        head["WARC-Refers-To"] = f"<urn:page:{refers_to}>"
        payload = b""
    head["Content-Length"] = str(len(http) + len(payload))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode("utf-8", "surrogatepass") + http + payload + b"\r\n\r\n"


def _headers(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    return dict(line.split(": ", 1) if ": " in line else (line[:-1], "") for line in lines), rest


def _page(urn: str | None) -> int | None:
    return int(urn[10:-1]) if urn and urn != "<urn:page:>" else None


def parsed(member: bytes) -> dict:
    """A record read back; a stored payload that its digest does not fit is an error."""
    head, rest = _headers(gzip.decompress(member))
    http, body = _headers(rest[: int(head["Content-Length"])])
    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
    if head["WARC-Type"] == "response" and hashlib.sha256(body).hexdigest() != digest:
        raise ValueError(f"payload of {head['WARC-Record-ID']} does not fit its digest")
    return {
        "page_id": _page(head["WARC-Record-ID"]),
        "uri": head["WARC-Target-URI"],
        "key": url_key(head["WARC-Target-URI"]),
        "payload_bytes": int(http["Content-Length"]),
        "payload_digest": digest,
        "record_type": head["WARC-Type"],
        "refers_to": _page(head.get("WARC-Refers-To")),
        "payload": body,
    }


# ---- archives --------------------------------------------------------------------


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> None:
    """Write the table of archive members at ``path``."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        html.alias("html"),
        F.sha2(html, 256).alias("digest"),
    )
    # copies are counted per map task first, so a payload with very many is a few rows
    firsts = (
        rows.where(F.octet_length("html") >= MIN_REVISIT)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first_id")
    )
    known = rows.join(firsts, "digest", "left").select(
        "page_id", "url", "html", "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
        .alias("refers_to"),
        F.spark_partition_id().cast("long").alias("archive"),
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offset = 0
        for batch in batches:
            members, offsets = [], []
            for page_id, url, text, digest, refers_to in zip(
                *[batch.column(i) for i in range(5)], strict=True
            ):
                raw = record(
                    page_id.as_py(), target_uri(url.as_py()), text.as_py().encode("utf-8"),
                    digest.as_py(), refers_to.as_py(),
                )
                members.append(gzip.compress(raw, 6, mtime=0))
                offsets.append(offset)
                offset += len(members[-1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(5),
                    pa.array(offsets, pa.int64()),
                    pa.array([len(m) for m in members], pa.int64()),
                    pa.array(members, pa.binary()),
                ],
                names=["archive", "offset", "length", "member"],
            )

    known.mapInArrow(pack, "archive long, offset long, length long, member binary").write.option(
        "compression", "uncompressed"
    ).parquet(path)


def read_archives(archives: DataFrame) -> DataFrame:
    """Records of a table of members, without payloads; payload digests are verified."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, text = pa.int64(), pa.string()
        types = {
            "page_id": number, "uri": text, "key": text, "payload_bytes": number,
            "payload_digest": text, "record_type": text, "refers_to": number,
        }
        names = list(types)
        for batch in batches:
            rows = [[] for _ in names]
            for member in batch.column(3):
                found = parsed(member.as_py())
                for column, name in zip(rows, names, strict=True):
                    column.append(found[name])
            columns = [pa.array(c, t) for c, t in zip(rows, types.values(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *columns], names=["archive", "offset", "length", *names]
            )

    return archives.select("archive", "offset", "length", "member").mapInArrow(read, _RECORD)


# ---- index -----------------------------------------------------------------------


def build_index(records: DataFrame) -> DataFrame:
    """Blocks of sorted lines: block, first_key, last_key, lines (compressed)."""
    lines = settle(records.select("key", "archive", "offset", "length"))
    per_block = max(BLOCK_LINES, -(-lines.count() // DIRECTORY_BLOCKS))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        part = number = 0

        def block(rows: list[tuple]) -> pa.RecordBatch:
            text = "\n".join(json.dumps(r, separators=(",", ":")) for r in rows)
            return pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([(part << 32) + number], pa.int64()),
                    "first_key": [rows[0][0]],
                    "last_key": [rows[-1][0]],
                    "lines": pa.array([zlib.compress(text.encode())], pa.binary()),
                }
            )

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            part = columns[4][0] if columns[4] else part
            held += zip(*columns[:4], strict=True)
            while len(held) >= per_block:
                yield block(held[:per_block])
                number, held = number + 1, held[per_block:]
        if held:
            yield block(held)

    # places end the order, so a key with very many captures can span several ranges
    ordered = lines.orderBy("key", "archive", "offset").withColumn(
        "part", F.spark_partition_id().cast("long")
    )
    return settle(
        ordered.mapInArrow(cut, "block long, first_key string, last_key string, lines binary")
    )


class Directory:
    """The sparse level: which blocks may hold a key."""

    def __init__(self, entries: list[tuple[int, str, str]]):
        entries = sorted(entries, key=lambda e: (e[1], e[2]))
        self.blocks = [e[0] for e in entries]
        self.first = [e[1] for e in entries]
        self.last = [e[2] for e in entries]

    def blocks_of(self, key: str) -> list[int]:
        key = key[:DIRECTORY_KEY]
        return self.blocks[bisect.bisect_left(self.last, key) : bisect.bisect_right(self.first, key)]


def directory(index: DataFrame) -> Directory:
    short = [F.substring(c, 1, DIRECTORY_KEY) for c in ("first_key", "last_key")]
    return Directory([tuple(r) for r in index.select("block", *short).toLocalIterator()])


def look_up(index: DataFrame, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Captures of the distinct URLs: uri, archive, offset, length."""
    known = directory(index)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks, uris = [], []
            for url in batch.column(0).to_pylist():
                uri = target_uri(url)
                for block in known.blocks_of(url_key(uri)):
                    blocks.append(block)
                    uris.append(uri)
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int64()), pa.array(uris, pa.string())], names=["block", "uri"]
            )

    asked = urls.select(url_col).distinct().mapInArrow(find, "block long, uri string").distinct()
    asked = asked.select(
        "block", F.pmod(F.xxhash64("uri"), F.lit(BLOCK_COPIES)).alias("copy"), "uri",
        F.lit(None).cast("binary").alias("lines"),
    )
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(BLOCK_COPIES - 1).cast("long")))
    blocks = index.select("block", copies.alias("copy"), F.lit(None).cast("string").alias("uri"), "lines")
    # a block's lines come first, then the keys that are sought in it
    met = blocks.unionByName(asked).repartition("block", "copy")
    met = met.sortWithinPartitions("block", "copy", F.col("lines").isNull())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list] = []
        for batch in batches:
            out: list[tuple] = []
            for uri, lines in zip(batch.column(2).to_pylist(), batch.column(3), strict=True):
                if lines.is_valid:
                    rows = [json.loads(x) for x in zlib.decompress(lines.as_py()).split(b"\n")]
                    continue
                key = url_key(uri)
                at = bisect.bisect_left(rows, key, key=lambda r: r[0])
                while at < len(rows) and rows[at][0] == key:
                    out.append((uri, *rows[at][1:]))
                    at += 1
            columns = list(zip(*out, strict=True)) or [[]] * 4
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=["uri", "archive", "offset", "length"],
            )

    return met.mapInArrow(search, "uri string, archive long, offset long, length long")


def fetch(archives: DataFrame, captures: DataFrame) -> DataFrame:
    """Records at captures. For a few, a filter on archive and offset reaches the table's
    files. Many are read in one pass and joined by place."""
    places = settle(captures.select("archive", "offset").distinct())
    some = places.limit(RANGE_READS).collect()
    if len(some) < RANGE_READS:
        archives = archives.where(
            F.col("archive").isin([r.archive for r in some])
            & F.col("offset").isin([r.offset for r in some])
        )
    return read_archives(archives).join(places, ["archive", "offset"])
