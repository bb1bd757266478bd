"""WARC archives: a writer with revisit records, and a salvage reader that gets past damage."""

from __future__ import annotations

import hashlib
import re
import zlib
from base64 import b32encode
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import IO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import slices
from loomline.llm.files import attempt_name, create, open_at
from loomline.session import cut, ship

REVISIT_LEAST = 1000
ARCHIVE_BYTES = 256 << 20
LEVEL = 3
CHUNK = 1 << 18
BATCH_BYTES, BATCH_ROWS = 16 << 20, 2000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
#: By which a record is checked; a revisit only by the last.
DIGESTS = ("warc-payload-digest", "warc-block-digest")
#: Content of a member that is kept; of more, the member is unpacked once more.
HELD = 16 << 20


def record(page: int | None, uri: str, payload: bytes, kind: str, refers: int | None) -> bytes:
    """One WARC/1.1 record; a revisit holds the HTTP header alone, whose Content-Length is that of the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if kind == "response" else b"")
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:page:{'' if page is None else page}>",
        "WARC-Target-URI": re.sub(r"[\r\n]", " ", uri),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Payload-Digest": f"sha1:{hashlib.sha1(payload).hexdigest()}",
        "WARC-Block-Digest": f"sha1:{hashlib.sha1(block).hexdigest()}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if kind == "revisit":
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:page:{'' if refers is None else refers}>"}
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Archives of one gzip member per row below ``folder``; returns (path, records) of each, written already.

    Of rows with equal payloads of at least REVISIT_LEAST bytes the one with the largest id is a response and the
    others revisit it; of several rows with that id, one with the first url. All other rows, and so null and empty texts,
    are responses. A null id is smaller than any other, and a null url is an empty one. Urls and texts are written whole,
    whatever their length, and are read back whole. Further columns have no part, whatever their names. An empty table
    has no archives.
    """
    ship(pages.sparkSession)
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.coalesce(F.col(url_col), F.lit("")).alias("uri"), payload.alias("html"))
    rows = rows.withColumn("digest", F.when(F.octet_length("html") >= REVISIT_LEAST, F.sha1("html")))
    copies = rows.where("digest is not null").groupBy("digest").agg(F.max("page").alias("top"), F.count("*").alias("n")).where("n > 1")
    copies = cut(copies.select(F.col("digest").alias("copied"), "top"))
    joined = rows.join(copies, F.col("digest") == F.col("copied"), "left").withColumn("first", F.col("page").eqNullSafe(F.col("top")))
    again = rows.where("digest is not null").groupBy("digest", "page").count().where("count > 1")
    if not again.isEmpty():
        # of those with the first url, which are all the same, one
        tops = joined.where("copied is not null and first")
        least = tops.groupBy("digest").agg(F.min("uri").alias("least")).withColumnRenamed("digest", "of")
        told = tops.join(cut(least), F.col("digest") == F.col("of")).drop("of")
        same = told.where("uri = least").groupBy("digest").agg(
            F.count("*").alias("n"), *(F.first(x).alias(x) for x in joined.columns if x not in ("digest", "first"))
        )
        one = same.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).withColumn("first", F.col("k") == 1)
        others = told.where("uri <> least").withColumn("first", F.lit(False))
        joined = one.select(joined.columns).unionByName(others.select(joined.columns)).unionByName(joined.where("copied is null or not first"))
    kinds = joined.select(
        "page", "uri", "html", F.when(F.col("copied").isNotNull() & ~F.col("first"), "revisit").otherwise("response").alias("kind"), "top"
    )

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, n, size, done = None, "", 0, 0, []
        for batch in slices(batches):
            for row in batch.to_pylist():
                if out is None:
                    path = attempt_name(folder, ".warc.gz")
                    out, n, size = create(path), 0, 0
                pack = zlib.compressobj(LEVEL, wbits=31)
                member = pack.compress(record(row["page"], row["uri"], row["html"].encode(), row["kind"], row["top"])) + pack.flush()
                out.write(member)
                n, size = n + 1, size + len(member)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    out = done.append((path, n))
        if out is not None:
            out.close()
            done.append((path, n))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64())], ["path", "records"]
        )

    return cut(kinds.mapInArrow(write, "path string, records long"))


@dataclass
class Found:
    """A record, or a gap where ``headers`` is None: the bytes of the file from offset on, and why they are no record."""

    offset: int
    length: int
    headers: dict[str, str] | None = None
    payload: bytes = b""
    reason: str = ""


def claimed_end(data: bytes, at: int) -> int | None:
    """Where the record at ``at`` ends by its content length; None without one."""
    cut_at = data.find(b"\r\n\r\n", at)
    length = re.search(rb"(?i)\r\ncontent-length:\s*([0-9]{1,18})\s*\r\n", data[at : cut_at + 4] if cut_at >= 0 else b"")
    return cut_at + 4 + int(length[1]) + 4 if length else None


def parsed(data: bytes, at: int) -> tuple[dict[str, str], bytes, int] | str:
    """Headers, block and end of the record at ``at``; or what is wrong with it."""
    if not VERSION.match(data, at):
        return "no version line"
    cut_at = data.find(b"\r\n\r\n", at)
    if cut_at < 0:
        return "no end of the header"
    if VERSION.search(data, at + 1, cut_at + 2):
        return "a version line within the header"
    lines = data[at:cut_at].decode("utf-8", "replace").split("\r\n")[1:]
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    if not re.fullmatch(r"[0-9]{1,18}", headers.get("content-length", "")):
        return "no content length"
    start, end = cut_at + 4, cut_at + 4 + int(headers["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        return "no end of the record where its length puts it"
    return headers, bytes(data[start:end]), end + 4


def checked(headers: dict[str, str], block: bytes) -> bytes | str:
    """The payload; or which digest is wrong. A block without an HTTP header is its own payload."""
    payload = block
    if "application/http" in headers.get("content-type", ""):
        payload = block.partition(b"\r\n\r\n")[2]
    whole = [("warc-block-digest", block)]
    if headers.get("warc-type") != "revisit":
        whole.append(("warc-payload-digest", payload))
    for name, data in whole:
        algorithm, _, value = headers.get(name, "").partition(":")
        if algorithm.lower() == "sha1" and value and value.upper() != b32encode(hashlib.sha1(data).digest()).decode() and value.lower() != hashlib.sha1(data).hexdigest():
            return f"wrong {name}"
    if headers.get("warc-type") == "revisit" and (length := re.search(rb"(?i)^content-length:\s*([0-9]+)", block, re.M)):
        headers["http-content-length"] = length[1].decode()
    return payload


def before_error(unpack, data: bytes, most: int) -> tuple[bytes, object, str]:
    """At most ``most`` bytes that ``data`` unpacks to, up to an error; the unpacker, and the error."""
    saved = unpack.copy()
    try:
        return unpack.decompress(data, most), unpack, ""
    except zlib.error as e:
        problem = f"a damaged member ({str(e)[:60]})"
    parts, unpack = [], saved
    while most > 1:
        part, unpack, failed = before_error(unpack, data, max(1, most // 16))
        parts.append(part)
        data = unpack.unconsumed_tail
        if failed or unpack.eof or not part and not data:
            break
    return b"".join(parts), saved if most == 1 else unpack, problem


class Member:
    """The gzip member at ``at``: its content in pieces, its size, where it ends or was found damaged, and how."""

    def __init__(self, file: IO[bytes], at: int):
        self.file, self.at, self.end, self.problem = file, at, at, ""
        self._take(False)
        if self.problem:
            self._take(True)

    def _bare(self) -> int:
        """Where the member's deflated data begin, which can be unpacked whatever its checksum is."""
        self.file.seek(self.at)
        head = self.file.read(CHUNK)
        flags, n = head[3] if len(head) > 3 else 0, 10
        if flags & 4:
            n += 2 + int.from_bytes(head[n : n + 2], "little")
        for flag in (8, 16):
            if flags & flag:
                n = (head.find(b"\0", n) + 1) or len(head)
        return self.at + n + (2 if flags & 2 else 0)

    def _take(self, careful: bool) -> None:
        self.size, self.held = 0, []
        for piece in self._unpacked(careful):
            self.size += len(piece)
            if self.held is not None:
                self.held = [*self.held, piece] if self.size <= HELD else None

    def _unpacked(self, careful: bool) -> Iterator[bytes]:
        unpack, read, step, tail = zlib.decompressobj(wbits=31), self.at, CHUNK >> 5, b""
        if careful:
            unpack, read = zlib.decompressobj(wbits=-15), self._bare()
        while not unpack.eof:
            data = tail
            if not data:
                self.file.seek(read)
                data = self.file.read(step)
                read, step = read + len(data), min(2 * step, CHUNK)
            failed = ""
            if careful:
                piece, unpack, failed = before_error(unpack, data, CHUNK)
            else:
                try:
                    piece = unpack.decompress(data, CHUNK)
                except zlib.error as e:
                    piece, failed = b"", f"a damaged member ({str(e)[:60]})"
            if piece:
                yield piece
            tail = unpack.unconsumed_tail
            if failed or not piece and not data and not unpack.eof:
                self.end, self.problem = read, self.problem or failed or "a member cut short"
                return
        self.end = read - len(unpack.unused_data)

    def pieces(self) -> Iterator[bytes]:
        return iter(self.held) if self.held is not None else self._unpacked(bool(self.problem))

    def reached(self, size: int) -> int:
        """Where in the file the first ``size`` bytes of the content end, or a few bytes before."""
        unpack, read, tail = zlib.decompressobj(wbits=-15), self._bare(), b""
        while size:
            data = tail
            if not data:
                self.file.seek(read)
                data = self.file.read(CHUNK)
                read += len(data)
            size -= len(unpack.decompress(data, min(size, CHUNK)))
            tail = unpack.unconsumed_tail
        return max(self.at + 1, read - len(tail) - len(unpack.unused_data) - 8)


def within(pieces: Iterator[bytes], size: int, damaged: bool) -> Iterator[tuple[int, int, dict[str, str] | None, bytes, str]]:
    """(start, end, headers, payload, reason) of the records and gaps in a member's content of ``size`` bytes.

    After a record that fails a check the next version line that begins a valid one is searched. In a damaged member
    only a digest tells that a record is right.
    """
    data, base, at, gap, why = bytearray(), 0, 0, -1, ""

    def fill(n: int) -> bool:
        while len(data) < n:
            piece = next(pieces, b"")
            if not piece:
                return False
            data.extend(piece)
        return True

    def one() -> tuple[dict[str, str], bytes, int] | str:
        look = at
        while data.find(b"\r\n\r\n", look) < 0 and VERSION.match(data, at):
            look = max(at, len(data) - 3)
            if not fill(len(data) + 1):
                break
        claimed = claimed_end(data, at)
        if claimed is not None and (base + claimed > size or not fill(claimed)):
            return "no end of the record where its length puts it"
        got = parsed(data, at)
        if isinstance(got, str):
            return got
        headers, block, end = got
        payload = checked(headers, block)
        if damaged and isinstance(payload, bytes) and not any(headers.get(x, "").lower().startswith("sha1:") for x in DIGESTS[headers.get("warc-type") == "revisit" :]):
            return "no digest in a damaged member"
        return payload if isinstance(payload, str) else (headers, payload, end)

    while True:
        if at > CHUNK:
            del data[:at]
            base, at = base + at, 0
        if not fill(at + 10) and at >= len(data):
            break
        got = one()
        if isinstance(got, str):
            if gap < 0:
                gap, why = base + at, got
            at += 1
            while not (hit := VERSION.search(data, at)):
                at = max(at, len(data) - 9)
                del data[:at]
                base, at = base + at, 0
                if not fill(len(data) + 1):
                    at = len(data)
                    break
            else:
                at = hit.start()
            continue
        if gap >= 0:
            yield gap, base + at, None, b"", why
            gap = -1
        headers, payload, end = got
        yield base + at, base + end, headers, payload, ""
        at = end
    if gap >= 0:
        yield gap, base + at, None, b"", why


def plain(file: IO[bytes], at: int, size: int) -> tuple[bytes, int] | str:
    """The bytes that the record at ``at`` of an archive without compression claims, and their end."""
    file.seek(at)
    head = bytearray(file.read(CHUNK >> 2))
    while (cut_at := head.find(b"\r\n\r\n", max(0, len(head) - CHUNK - 3))) < 0:
        # only lines of a header are read on
        more = file.read(CHUNK) if all(b":" in x for x in head.split(b"\r\n")[1:-1]) else b""
        if not more:
            return "no end of the header"
        head += more
    claimed = claimed_end(head, 0)
    if claimed is None:
        return "no content length"
    end = at + claimed
    if end > size:
        return "a record cut short"
    file.seek(at)
    return file.read(end - at), end


def next_start(file: IO[bytes], at: int, size: int) -> int:
    """Where the next gzip member or version line may begin, ``size`` if nowhere."""
    while at < size:
        file.seek(at)
        data = file.read(CHUNK)
        if hit := START.search(data):
            return at + hit.start()
        if at + len(data) >= size:
            break
        at += len(data) - 9  # what may begin at the chunk's end
    return size


def salvage(file: IO[bytes], size: int) -> Iterator[Found]:
    """Records and gaps of an archive in their order. Holds one record, or HELD bytes, at a time.

    What fails a check is left at its start; from there the next member or version line is searched that holds a
    valid record, and the bytes between are a gap. The content of a member is searched likewise. A record or gap
    within a member has the member's offset and length; a gap's reason tells the bytes of the content. Of a damaged
    member the records with right digests ahead of the damage are kept, and the gap begins after the last of them.
    """
    at, gap, why = 0, -1, ""
    while at < size:
        file.seek(at)
        head = file.read(10)
        kept = 0
        if head[:3] == b"\x1f\x8b\x08":
            member = Member(file, at)
            end, wrong, lost = member.end, member.problem, None
            for start, stop, headers, payload, reason in within(member.pieces(), member.size, bool(wrong)):
                if headers is None:
                    lost = Found(at, end - at, None, b"", f"{reason} (content {start} to {stop} of {member.size})")
                    if wrong:
                        continue  # a gap, if a record follows
                if gap >= 0:
                    yield Found(gap, at - gap, None, b"", why)
                    gap = -1
                if lost:
                    yield lost
                    lost = None
                if headers is not None:
                    yield Found(at, end - at, headers, payload)
                    kept = stop
        else:
            got = plain(file, at, size) if START.match(head) else "neither a member nor a version line"
            one = got if isinstance(got, str) else parsed(got[0], 0)
            payload = one if isinstance(one, str) else checked(*one[:2])
            wrong = payload if isinstance(payload, str) else ""
            if not wrong:
                end = got[1]
                if gap >= 0:
                    yield Found(gap, at - gap, None, b"", why)
                    gap = -1
                yield Found(at, end - at, one[0], payload)
        if wrong:
            rest = member.reached(kept) if kept else at
            if gap < 0:
                gap, why = rest, wrong
            at = next_start(file, max(rest, at + 1), size)
            continue
        if gap >= 0:  # a member without content
            yield Found(gap, at - gap, None, b"", why)
            gap = -1
        at = end
    if gap >= 0:
        yield Found(gap, size - gap, None, b"", why)


SCHEMA = "path string, offset long, length long, gap string, headers map<string,string>, payload binary"
_SCHEMA = pa.schema(
    [
        ("path", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("gap", pa.string()),
        ("headers", pa.map_(pa.string(), pa.string())),
        ("payload", pa.binary()),
    ]
)


def read_warc(paths: DataFrame) -> DataFrame:
    """Records and quarantined gaps of the archives in column ``path``.

    A gap has its reason in ``gap`` and neither headers nor payload; a record has ``gap`` null. Archives may be
    compressed by member, plain, or both; an empty file has no rows.
    """
    ship(paths.sparkSession)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with open_at(path) as file:
                    rows, size = [], 0
                    for x in salvage(file, file.size()):
                        good = x.headers is not None
                        rows.append(
                            {
                                "path": path,
                                "offset": x.offset,
                                "length": x.length,
                                "gap": None if good else x.reason,
                                "headers": list(x.headers.items()) if good else None,
                                "payload": x.payload if good else None,
                            }
                        )
                        size += len(x.payload)
                        if size >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                            yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, _SCHEMA)

    return paths.select("path").mapInArrow(read, SCHEMA)


def record_digest(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of each record that was read."""
    head = lambda name: F.try_element_at("headers", F.lit(name))
    page = lambda name: F.nullif(F.regexp_extract(head(name), "^<urn:page:(-?[0-9]*)>$", 1), F.lit("")).cast("long")
    revisit = head("warc-type") == "revisit"
    return records.where("gap is null").select(
        page("warc-record-id").alias("page_id"),
        F.when(revisit, head("http-content-length").cast("long")).otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(revisit, F.substring_index(head("warc-payload-digest"), ":", -1)).otherwise(F.sha1("payload")).alias("payload_digest"),
        head("warc-type").alias("record_type"),
        F.when(revisit, page("warc-refers-to")).alias("refers_to"),
    )


def all_read(files: DataFrame, found: DataFrame) -> None:
    """Fails unless ``found`` has as many rows as records were written to ``files``."""
    written, read = files.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0], found.count()
    if written != read:
        raise ValueError(f"{written} records were written and {read} read")
