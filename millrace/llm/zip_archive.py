"""Web archives in ZIP packages: a writer of WARC records, and a reader that extracts nothing.

A package holds, all stored and not compressed by ZIP: ``archive/data.warc.gz``, in which each record is
a gzip member of its own; ``indexes/index.cdx``, a line for each record with its offset and length
in that member; and ``datapackage.json``. The reader finds the end record of the ZIP file (ZIP64 where
the plain one says so), walks the central directory, locates the stored members by their local
headers, and reads a part of the index and then records with range reads. The lines of an index have one width; it is
dealt out in spans, so that several tasks can read one package, and each reads its own lines only.

Payloads: null counts as empty. Of records with equal payloads of at least ``least`` bytes, the one
with the smallest page_id is a response and the others revisit it; a revisit keeps the headers of
the response but no payload. Repeated rows each get a record, and all are responses where their page_id is that
smallest one. Null page_ids are written with an empty id, come last, and read back as
null. Long pages are one record each. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Work, file_system, table

LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
FULL, FULL16 = 0xFFFFFFFF, 0xFFFF
DATE = "2024-01-01T00:00:00Z"
#: Bytes of records that are read at a time, and records of one span of an index.
READ, SPAN = 4 << 20, 2000
#: Bytes of a line of the index: page_id, offset and length in 20 characters each, and the digest.
LINE = 96


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- writing ------------------------------------------------------------------------------------


def record(page_id, url: str | None, payload: bytes, refers_to) -> tuple[bytes, str]:
    """A WARC record, not yet compressed, and its digest."""
    found = digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    kind = "response" if refers_to is None else "revisit"
    body = http + payload if refers_to is None else http
    name = "" if page_id is None else page_id
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{found}", f"Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    if url:
        head.insert(2, "WARC-Target-URI: " + "".join(url.split()))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n", found


class Package:
    """Writes stored members one after the other to a stream, sizes after the data where they are not known before."""

    def __init__(self, out):
        self.out, self.at, self.members = out, 0, []

    def put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def member(self, name: str, chunks) -> None:
        where, crc, size, raw = self.at, 0, 0, name.encode()
        # flag 8: a descriptor with the sizes follows; the ZIP64 field says that they have 8 bytes
        self.put(struct.pack("<4s5H3L2H", LOCAL, 45, 0x0808, 0, 0, 33, 0, FULL, FULL, len(raw), 20) + raw + struct.pack("<2H2Q", 1, 16, 0, 0))
        for chunk in chunks:
            crc, size = zlib.crc32(chunk, crc), size + len(chunk)
            self.put(chunk)
        self.put(struct.pack("<4sL2Q", b"PK\x07\x08", crc, size, size))
        self.members.append((raw, crc, size, where))

    def end(self) -> None:
        at = self.at
        for raw, crc, size, where in self.members:
            extra = struct.pack("<2H3Q", 1, 24, size, size, where)
            self.put(struct.pack("<4s6H3L5H2L", CENTRAL, 45, 45, 0x0808, 0, 0, 33, crc, FULL, FULL, len(raw), len(extra), 0, 0, 0, 0, FULL) + raw + extra)
        size, n = self.at - at, len(self.members)
        end = self.at
        self.put(struct.pack("<4sQ2H2L4Q", END64, 44, 45, 45, 0, 0, n, n, size, at))
        self.put(struct.pack("<4sLQL", LOCATOR64, 0, end, 1))
        self.put(struct.pack("<4s4H2LH", END, 0, 0, FULL16, FULL16, FULL, FULL, 0))


def first_pages(pages: DataFrame, least: int) -> DataFrame:
    """payload digest and smallest page_id of payloads that occur more than once."""
    keyed = pages.select("page_id", _payload().alias("p")).select("page_id", F.sha2("p", 256).alias("d"), F.octet_length("p").alias("n"))
    same = keyed.filter(F.col("n") >= least).groupBy("d").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    return same.filter("n > 1").select("d", "first")


def _payload():
    return F.coalesce(F.col("html"), F.lit(""))


def write(pages: DataFrame, work: Work, least: int = 0) -> DataFrame:
    """Writes packages; gives a row for each: path and n, its number of records."""
    folder = work.folder("packages")
    first = work.write(first_pages(pages, least), "first")
    rows = pages.select("page_id", "url", _payload().alias("html")).withColumn("d", F.sha2("html", 256))
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") > F.col("first")), F.col("first"))
    rows = rows.join(first.hint("merge"), "d", "left").select(F.col("page_id").cast("long"), "url", "html", refers.cast("long").alias("refers_to"))

    def put(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        path, index, n = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:8]}.wacz", [], 0

        def members():
            at = 0
            for batch in batches:
                for page, url, html, to in zip(*(c.to_pylist() for c in batch.columns)):
                    data, found = record(page, url, html.encode("utf-8", "surrogatepass"), to)
                    packed = gzip.compress(data, 5, mtime=0)
                    index.append(f"{'' if page is None else page:>20} {at:>20} {len(packed):>20} {found}\n")
                    at += len(packed)
                    yield packed

        batch = next(batches, None)
        while batch is not None and not batch.num_rows:
            batch = next(batches, None)
        if batch is None:
            return
        rest = batches

        def whole():
            yield batch
            yield from rest

        batches = whole()
        system, where = file_system(path)
        system.create_dir(where.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(where, buffer_size=1 << 20) as out:
            package = Package(out)
            package.member("archive/data.warc.gz", members())
            n = len(index)
            package.member("indexes/index.cdx", ["".join(index[i : i + 10_000]).encode() for i in range(0, n, 10_000)])
            package.member("datapackage.json", [json.dumps({"profile": "data-package", "resources": [{"path": m[0].decode(), "bytes": m[2]} for m in package.members]}).encode()])
            package.end()
        yield pa.RecordBatch.from_pydict({"path": [path], "n": [n]}, schema=pa.schema({"path": pa.string(), "n": pa.int64()}))

    return work.write(rows.mapInArrow(put, "path string, n long"), "manifest")


# --- reading ------------------------------------------------------------------------------------


def directory(f, size: int) -> dict[str, tuple[int, int]]:
    """Offset and size of the data of every stored member of a ZIP file."""
    tail = f.read_at(min(size, 65_557), max(0, size - 65_557))
    k = tail.rfind(END)
    if k < 0:
        raise ValueError("no end record: not a ZIP file")
    n, length, at = struct.unpack_from("<H2L", tail, k + 10)
    if n == FULL16 or length == FULL or at == FULL:
        k = size - len(tail) + k - 20
        sign, _, where, _ = struct.unpack("<4sLQL", f.read_at(20, k))
        if sign != LOCATOR64:
            raise ValueError("no ZIP64 locator")
        sign, n, length, at = struct.unpack("<4s28xQ2Q", f.read_at(56, where))
        if sign != END64:
            raise ValueError("no ZIP64 end record")
    found, raw, k = {}, f.read_at(length, at), 0
    for _ in range(n):
        sign, _, _, _, method, _, _, _, packed, full, n_name, n_extra, n_note, _, _, _, where = struct.unpack_from("<4s6H3L5H2L", raw, k)
        if sign != CENTRAL:
            raise ValueError("a broken central directory")
        name = raw[k + 46 : k + 46 + n_name].decode("utf-8", "replace")
        extra, e = raw[k + 46 + n_name : k + 46 + n_name + n_extra], 0
        while e + 4 <= len(extra):
            tag, n_tag = struct.unpack_from("<2H", extra, e)
            if tag == 1:
                values = iter(struct.unpack_from(f"<{n_tag // 8}Q", extra, e + 4))
                full = next(values) if full == FULL else full
                packed = next(values) if packed == FULL else packed
                where = next(values) if where == FULL else where
            e += 4 + n_tag
        if method == 0 and not name.endswith("/"):
            n_name2, n_extra2 = struct.unpack("<2H", f.read_at(4, where + 26))
            found[name] = (where + 30 + n_name2 + n_extra2, packed)
        k += 46 + n_name + n_extra + n_note
    return found


def parse(data: bytes) -> dict:
    """The fields of a WARC record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    body = rest[: int(fields["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    sizes = [int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    page = lambda k: (int(x) if (x := fields[k].removeprefix("<urn:page:").rstrip(">")) else None) if k in fields else None
    out = {"page_id": page("warc-record-id"), "url": fields.get("warc-target-uri"), "record_type": fields["warc-type"], "refers_to": page("warc-refers-to")}
    if out["record_type"] == "response":
        found = digest(payload)
        if fields["warc-payload-digest"] != f"sha1:{found}":
            raise ValueError("a payload differs from its digest")
        return out | {"payload": payload, "payload_bytes": len(payload), "payload_digest": found}
    return out | {"payload": None, "payload_bytes": sizes[0], "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:")}


READ_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def read(spark: SparkSession, manifest: DataFrame, payload: bool = False) -> DataFrame:
    """The records of packages, by range reads; ``payload`` adds their payloads."""
    spans = manifest.select("path", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(SPAN))).alias("span"))
    names = [x.split()[0] for x in READ_SCHEMA.split(", ")] + ["payload"] * payload

    def get(batches):
        import pyarrow as pa

        ints, texts = pa.int64(), pa.string()
        types = [ints, ints, texts, texts, ints, texts, pa.binary()]
        for batch in batches:
            for path, span in zip(*(c.to_pylist() for c in batch.columns)):
                system, where = file_system(path)
                with system.open_input_file(where) as f:
                    inside = directory(f, f.size())
                    base, _ = inside["archive/data.warc.gz"]
                    at, n = inside["indexes/index.cdx"]
                    # lines of the index have one width, so only those of the span are read
                    lines = f.read_at(min(n - span * LINE, SPAN * LINE), at + span * LINE)
                    places = [(int(lines[k + 21 : k + 41]), int(lines[k + 42 : k + 62])) for k in range(0, len(lines), LINE)]
                    i = 0
                    while i < len(places):
                        j = i + 1
                        while j < len(places) and places[j][0] + places[j][1] - places[i][0] <= READ:
                            j += 1
                        data = f.read_at(places[j - 1][0] + places[j - 1][1] - places[i][0], base + places[i][0])
                        rows = [parse(gzip.decompress(data[o - places[i][0] : o - places[i][0] + n])) for o, n in places[i:j]]
                        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(names, types)], names=names)
                        i = j

    # spans differ little in size; a shuffle of a few rows deals them out
    return spans.repartition("path", "span").mapInArrow(get, READ_SCHEMA + ", payload binary" * payload)


def op2_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all pages to packages and reads them back."""
    return read(spark, write(table(spark, sf_dir, "pages"), Work(spark, "warc")))


_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
SQL = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first, list_transform(range(8), lambda k: ('0x' || substr(x, 5 * k + 1, 5))::BIGINT) AS g FROM p)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
    array_to_string(list_transform(g, lambda v: substr('{_CHARS}', (v // 32768 % 32 + 1)::INT, 1) || substr('{_CHARS}', (v // 1024 % 32 + 1)::INT, 1) || substr('{_CHARS}', (v // 32 % 32 + 1)::INT, 1) || substr('{_CHARS}', (v % 32 + 1)::INT, 1)), '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to, url
FROM q
"""
