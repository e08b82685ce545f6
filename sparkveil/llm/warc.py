"""WARC archives: a Spark data source that writes one gzip member a record and reads archives one after another (operator 13)."""

import hashlib
import json
import re
import uuid
import zlib
from base64 import b32decode
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from ..sources.tables import delete, new_folder
from .common import name, saved, split_join, table

CHUNK, MOST_HEADER, MAGIC = 1 << 16, 1 << 20, b"\x1f\x8b\x08"
ARCHIVE_BYTES = 1 << 30  # an archive is closed once it is this long
BATCH_ROWS, BATCH_BYTES = 256, 1 << 24
DIGESTS = {"sha1", "sha256", "md5"}
TO_WRITE = "record_type string, record_id string, date string, target_uri string, content_type string, fields map<string,string>, block binary"
READ = "file string, offset bigint, length bigint, record_type string, record_id string, date string, target_uri string, content_type string, content_length bigint, payload_bytes bigint, payload_sha256 string, fields map<string,string>, block binary, problem string"
ARROW_READ = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("date", pa.string()), ("target_uri", pa.string()), ("content_type", pa.string()), ("content_length", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("fields", pa.map_(pa.string(), pa.string())), ("block", pa.binary()), ("problem", pa.string())])


def opened(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


def field_value(text: str) -> bytes:
    """Printable ASCII as it is, all else by percent sign, so that no value can end its line."""
    return re.sub(rb"[^\x20-\x7e]", lambda m: b"%%%02X" % m[0][0], text.encode())


def framed(record_type: str, record_id: str, date: str, target_uri: str | None, content_type: str | None, fields: list[tuple[str, str]] | None, block: bytes | None) -> bytes:
    """A record as a gzip member of its own."""
    block = block or b""
    lines = [b"WARC/1.1"]
    own = {"WARC-Type": record_type, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": date, "WARC-Target-URI": target_uri and re.sub(r"\s", lambda m: "%%%02X" % ord(m[0]), target_uri, flags=re.A), "Content-Type": content_type}
    for key, value in [*own.items(), *(fields or ())]:
        if value is not None:
            lines.append(key.encode() + b": " + field_value(value))
    lines += [b"WARC-Block-Digest: sha256:" + hashlib.sha256(block).hexdigest().encode(), b"Content-Length: %d" % len(block), b"", b""]
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return b"".join([deflate.compress(b"\r\n".join(lines)), deflate.compress(block), deflate.compress(b"\r\n\r\n"), deflate.flush()])


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Each task writes archives under names of its own; a last file lists those of the tasks that counted. Archives of
    tasks that failed or ran twice are in no list, so that readers pass them over."""

    def __init__(self, path: str, archive_bytes: int, overwrite: bool):
        self.path, self.archive_bytes, self.overwrite, self.id = path.rstrip("/"), archive_bytes, overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = opened(self.path)
        system.create_dir(root)
        files, stream = [], None
        for batch in iterator:
            columns = [batch.column(k) for k in range(batch.num_columns)]
            for i in range(batch.num_rows):
                if stream is None:
                    files.append(f"{self.id}-{uuid.uuid4().hex}.warc.gz")
                    stream = system.open_output_stream(f"{root}/{files[-1]}", compression=None)
                stream.write(framed(*(c[i].as_py() for c in columns)))
                if stream.tell() >= self.archive_bytes:
                    stream.close()
                    stream = None
        if stream is not None:
            stream.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = opened(self.path)
        system.create_dir(root)
        kept = {f for m in messages if m for f in m.files}
        before = [x.base_name for x in system.get_file_info(pa.fs.FileSelector(root)) if x.is_file]
        with system.open_output_stream(f"{root}/_archives-{self.id}", compression=None) as out:
            out.write(json.dumps(sorted(kept)).encode())
        for x in before:
            if x not in kept and (self.overwrite or x.startswith(self.id)):
                system.delete_file(f"{root}/{x}")

    def abort(self, messages: list[Written | None]) -> None:
        system, root = opened(self.path)
        for x in system.get_file_info(pa.fs.FileSelector(root, allow_not_found=True)):
            if x.base_name.startswith(self.id):
                system.delete_file(x.path)


class RecordParser:
    """Takes the bytes of one record as they come: header, block of its content length, blank lines. Digests grow with
    the block, which is kept only if asked for."""

    def __init__(self, keep: bool):
        self.keep, self.head, self.fields, self.block = keep, bytearray(), None, bytearray()
        self.length = self.seen = self.payload_bytes = 0
        self.http: bytearray | None = None  # the HTTP header so far, where the block begins with one
        self.tail, self.problem = b"", None
        self.payload_sum = hashlib.sha256()
        self.sums: dict[str, object] = {}

    def feed(self, data: bytes) -> None:
        if self.problem or not data:
            return
        if self.fields is None:
            searched = max(0, len(self.head) - 3)
            self.head += data
            end = self.head.find(b"\r\n\r\n", searched)
            if end < 0:
                if len(self.head) > MOST_HEADER:
                    self.problem = "header without end"
                return
            data = bytes(self.head[end + 4 :])
            self.begin(bytes(self.head[:end]))
            if self.problem:
                return
        part, rest = data[: self.length - self.seen], data[self.length - self.seen :]
        if part:
            self.seen += len(part)
            if self.keep:
                self.block += part
            if (own := self.sums.get("warc-block-digest")) is not None:
                own.update(part)
            self.body(part)
        if len(self.tail) <= 4:
            self.tail += rest[:5]

    def begin(self, head: bytes) -> None:
        lines = head.split(b"\r\n")
        if not re.fullmatch(rb"WARC/[0-9]+\.[0-9]+", lines[0]):
            self.problem = "no WARC version"
            return
        self.fields, last = {}, None
        for line in lines[1:]:
            key, colon, value = line.partition(b":")
            if line[:1] in (b" ", b"\t") and last:
                self.fields[last] += " " + line.strip().decode("utf-8", "replace")
            elif colon:
                last = key.strip().decode("utf-8", "replace").lower()
                value = value.strip().decode("utf-8", "replace")
                self.fields[last] = f"{self.fields[last]}, {value}" if last in self.fields else value
        length = self.fields.get("content-length", "")
        if not re.fullmatch(r"[0-9]{1,18}", length, re.A):
            self.problem = "no content length"
            return
        self.length = int(length)
        revisit = self.fields.get("warc-type") == "revisit"
        if self.fields.get("content-type", "").startswith("application/http"):
            self.http = bytearray()
        for key in ("warc-block-digest", "warc-payload-digest"):
            kind = self.fields.get(key, "").partition(":")[0].lower()
            if kind in DIGESTS and not (revisit and key == "warc-payload-digest"):  # that is the digest of the other record
                self.sums[key] = hashlib.new(kind)

    def body(self, part: bytes) -> None:
        """What follows the HTTP header, if there is one, is payload."""
        if self.http is not None:
            searched = max(0, len(self.http) - 3)
            self.http += part
            end = self.http.find(b"\r\n\r\n", searched)
            if end < 0:
                if len(self.http) > MOST_HEADER:
                    self.problem = "HTTP header without end"
                return
            part, self.http = bytes(self.http[end + 4 :]), None
        self.payload_bytes += len(part)
        self.payload_sum.update(part)
        if (own := self.sums.get("warc-payload-digest")) is not None:
            own.update(part)

    def finish(self) -> None:
        """Checks of the whole record."""
        if self.problem:
            return
        if self.fields is None:
            self.problem = "header without end"
        elif self.seen < self.length:
            self.problem = f"{self.seen} of {self.length} bytes"
        elif self.tail != b"\r\n\r\n":
            self.problem = "content longer than its length"
        for key, own in self.sums.items():
            value = self.fields[key].partition(":")[2].strip()
            hexadecimal = value.lower()
            if len(value) * 5 // 8 == own.digest_size and len(value) != own.digest_size * 2:
                try:
                    hexadecimal = b32decode(value.upper() + "=" * (-len(value) % 8)).hex()
                except ValueError:
                    pass
            if not self.problem and hexadecimal != own.hexdigest():
                self.problem = f"{key} does not match"


def next_member(stream, at: int) -> int | None:
    """The first place from at on where a member begins that holds a record, after one that was damaged."""
    stream.seek(at)
    base, window = at, b""
    while True:
        more = stream.read(CHUNK)
        window += more
        found = -1
        while (found := window.find(MAGIC, found + 1)) >= 0:
            if len(window) - found < 512 and more:
                break  # look at it with more behind it
            try:
                if zlib.decompressobj(31).decompress(window[found : found + 512], 5) == b"WARC/":
                    return base + found
            except zlib.error:
                pass
        if not more:
            return None
        cut = found if found >= 0 else max(0, len(window) - 2)
        base, window = base + cut, window[cut:]


def read_records(stream, keep: bool) -> Iterator[tuple[int, int, RecordParser]]:
    """(offset, compressed length, record) of each member of an archive, in its order, in the memory of one chunk (and of
    one block, if kept). After a damaged member the next one that holds a record is looked for."""
    buffer, at = b"", 0
    while True:
        if not buffer and not (buffer := stream.read(CHUNK)):
            return
        start, inflate, parser = at, zlib.decompressobj(31), RecordParser(keep)
        try:
            while True:
                given = len(buffer)
                parser.feed(inflate.decompress(buffer, CHUNK))
                buffer = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
                at += given - len(buffer)
                if inflate.eof:
                    break
                if not buffer and not (buffer := stream.read(CHUNK)):
                    parser.feed(inflate.flush())
                    if not inflate.eof:
                        raise zlib.error("member cut off")
                    break
            parser.finish()
        except zlib.error as e:
            parser.problem = f"damaged member: {e}"
            yield start, at - start, parser
            if (following := next_member(stream, start + 1)) is None:
                return
            stream.seek(following)
            at, buffer = following, b""
            continue
        yield start, at - start, parser


@dataclass
class Archive(InputPartition):
    path: str


class WarcReader(DataSourceReader):
    """One task an archive. Where lists of committed archives are found, those alone are read."""

    def __init__(self, path: str, keep: bool):
        self.path, self.keep = path.rstrip("/"), keep

    def partitions(self) -> list[Archive]:
        system, root = opened(self.path)
        if system.get_file_info(root).is_file:
            return [Archive(self.path)]
        files = sorted(x.base_name for x in system.get_file_info(pa.fs.FileSelector(root)) if x.is_file)
        if lists := [x for x in files if x.startswith("_archives-")]:
            listed = [f for x in lists for f in json.loads(system.open_input_stream(f"{root}/{x}", compression=None).read())]
            if lost := set(listed) - set(files):
                raise FileNotFoundError(f"archives lost from {self.path}: {sorted(lost)[:5]}")
            files = sorted(listed)
        return [Archive(f"{self.path}/{f}") for f in files if f.endswith(".warc.gz")]

    def read(self, partition: Archive | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # there are no archives
            return
        system, path = opened(partition.path)
        rows, held = [], 0
        with system.open_input_file(path) as stream:
            for offset, length, p in read_records(stream, self.keep):
                f = p.fields or {}
                rows.append({"file": partition.path, "offset": offset, "length": length, "record_type": f.get("warc-type"), "record_id": f.get("warc-record-id", "").strip("<>") or None, "date": f.get("warc-date"), "target_uri": f.get("warc-target-uri"), "content_type": f.get("content-type"), "content_length": p.length, "payload_bytes": p.payload_bytes, "payload_sha256": p.payload_sum.hexdigest(), "fields": list(f.items()), "block": bytes(p.block) if self.keep else None, "problem": p.problem})
                held += len(p.block)
                if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=ARROW_READ)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=ARROW_READ)


class WarcSource(DataSource):
    """format("warc"): option archive_bytes to write, option blocks (true or false) to read."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("blocks", "false").lower() == "true")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], int(self.options.get("archive_bytes", ARCHIVE_BYTES)), overwrite)


def read_warc(spark: SparkSession, path: str, blocks: bool = False) -> DataFrame:
    """Records of the archives in a folder, or of one archive: a row a member. problem tells what is wrong with a record:
    a damaged member, a wrong content length, a digest (sha1, sha256, md5; hexadecimal or base 32) that does not match."""
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("blocks", str(blocks).lower()).load(path)


def write_warc(records: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Records, in the columns of TO_WRITE, as archives in a folder."""
    records.sparkSession.dataSource.register(WarcSource)
    records.select(*(x.split()[0] for x in TO_WRITE.split(", "))).write.format("warc").option("archive_bytes", archive_bytes).mode("append").save(path)


def page_records(pages: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html", least: int = 100, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """A response record for each page, and a revisit record, without payload, for one that repeats the payload of a page
    with a smaller id. Payloads under least bytes are written whole.

    A null html is an empty payload; a null url becomes one made of the id. Rows that share the smallest id are all
    responses; a null id is larger than all others, and where all are null all are responses.
    """
    rows = pages.select(pages[name(id_column)].cast("bigint").alias("id"), pages[name(url)].alias("url"), F.coalesce(pages[name(html)], F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    firsts = saved(rows.where(F.length("payload") >= least).groupBy("digest").agg(F.count("*").alias("n"), F.min("id").alias("first")).where("n > 1 AND first IS NOT NULL"))
    joined = split_join(rows, firsts, ["digest"], rows.count(), "left")
    again = F.coalesce(F.col("first") != F.coalesce("id", F.col("first") + 1), F.lit(False))
    shown = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    key = lambda c: F.regexp_replace(F.md5(F.concat_ws("|", shown(c), "digest")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "urn:uuid:$1-$2-$3-$4-$5")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.length("payload").cast("string"), F.lit("\r\n\r\n")).cast("binary")
    fields = F.map_concat(
        F.create_map(F.lit("X-Page-Id"), shown(F.col("id")), F.lit("WARC-Payload-Digest"), F.concat(F.lit("sha256:"), "digest")),
        F.when(again, F.create_map(F.lit("WARC-Refers-To"), F.concat(F.lit("<"), key(F.col("first")), F.lit(">")), F.lit("WARC-Profile"), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(F.create_map().cast("map<string,string>")),
    )
    return joined.select(F.when(again, "revisit").otherwise("response").alias("record_type"), key(F.col("id")).alias("record_id"), F.lit(date).alias("date"), F.coalesce("url", F.concat(F.lit("urn:page:"), shown(F.col("id")))).alias("target_uri"), F.lit("application/http;msgtype=response").alias("content_type"), fields.alias("fields"), F.when(again, head).otherwise(F.concat(head, "payload")).alias("block"))


def resolved_pages(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the records of pages: a revisit takes its payload
    from the record that it refers to. A record with a problem, a revisit without its response and one whose digest is
    not that of the response end the job."""
    page = F.nullif(F.element_at("fields", "x-page-id"), F.lit("")).cast("bigint")
    sound = F.when(F.col("problem").isNotNull(), F.raise_error(F.concat(F.col("file"), F.lit(" at "), F.col("offset").cast("string"), F.lit(": "), F.col("problem")))).otherwise(F.col("record_type"))
    other = F.regexp_replace(F.element_at("fields", "warc-refers-to"), "[<>]", "")
    declared = F.element_at(F.split(F.element_at("fields", "warc-payload-digest"), ":"), -1)
    rows = saved(records.select(sound.alias("record_type"), "record_id", page.alias("page_id"), "payload_bytes", "payload_sha256", declared.alias("declared"), other.alias("other")))
    responses, revisits = rows.where("record_type = 'response'"), rows.where("record_type = 'revisit'")
    asked = revisits.groupBy("other").agg(F.count("*").alias("n"))
    known = responses.groupBy(F.col("record_id").alias("other")).agg(F.min("page_id").alias("refers_to"), F.min(F.struct("payload_bytes", "payload_sha256")).alias("whole"))
    found = saved(known.join(asked, "other"))
    joined = split_join(revisits.drop("payload_bytes", "payload_sha256"), found, ["other"], rows.count(), "left")
    bytes_ = F.when(F.col("whole.payload_sha256") == F.col("declared"), F.col("whole.payload_bytes")).otherwise(F.raise_error(F.concat(F.lit("revisit without its payload: "), "record_id")).cast("bigint"))
    bytes_ = F.coalesce(bytes_, F.raise_error(F.concat(F.lit("revisit without its response: "), "record_id")).cast("bigint"))
    first = responses.select("page_id", "payload_bytes", F.col("payload_sha256").alias("payload_digest"), "record_type", F.lit(None).cast("bigint").alias("refers_to"))
    return first.unionByName(joined.select("page_id", bytes_.alias("payload_bytes"), F.col("declared").alias("payload_digest"), "record_type", "refers_to"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages table written as archives and read back. The archives go once their records are in a table."""
    path = new_folder(spark, "warc")
    write_warc(page_records(table(spark, sf_dir, "pages")), path)
    out = resolved_pages(read_warc(spark, path))
    delete(spark, path)
    return out
