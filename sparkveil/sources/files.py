"""Files of an extract: what they hold, in one pass over their bytes, and their rows under their own headers."""

import codecs
import csv
import gzip
import hashlib
import io
import re
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.schema import ContractError, normalized

CHUNK = 1 << 22
MOST_HEADER = 1 << 24  # bytes; a header that is longer is refused
SCAN = "path string, source_file_hash string, bytes bigint, header array<string>, quoted boolean, format string"
SOURCE = "__source_file_path"  # the file that a stored row came from


def listed(spark: SparkSession, path: str) -> list[str]:
    """URIs of a file, or of all files beneath a folder but those that writers keep for themselves. Empty files are none."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(target):
        raise ContractError(f"{path} does not exist")
    top, found, each = system.getFileStatus(target).getPath().toString().rstrip("/"), [], system.listFiles(target, True)
    while each.hasNext():
        status = each.next()
        own = status.getPath().toString()
        if status.getLen() > 0 and not any(step.startswith(("_", ".")) for step in own.removeprefix(top).split("/")):
            found.append(own)
    return sorted(found)


def header_of(stream) -> tuple[list[str], bytes, bool]:
    """The first record of a CSV stream, by RFC 4180, the bytes that were read for it, and whether it ends in CR LF."""
    held = b""
    while True:
        more = stream.read(CHUNK)
        held += more
        # Quotes within quotes come in pairs, so that an even number of them closes the record at a line feed.
        end, quotes = -1, 0
        for m in re.finditer(rb'["\n]', held):
            if m[0] == b'"':
                quotes += 1
            elif quotes % 2 == 0:
                end = m.end()
                break
        if end >= 0 or not more:
            text = (held[:end] if end >= 0 else held).removeprefix(codecs.BOM_UTF8).decode("utf-8", "replace")
            return next(csv.reader(io.StringIO(text, newline=""), strict=False), []), held, held[max(0, end - 2) : max(0, end)] == b"\r\n"
        if len(held) > MOST_HEADER:
            raise ContractError("a header without end")


class Counted:
    """A stream whose bytes are hashed and counted as they pass."""

    def __init__(self, stream):
        self.stream, self.total, self.size = stream, hashlib.md5(), 0

    def read(self, n: int) -> bytes:
        held = self.stream.read(n)
        self.total.update(held)
        self.size += len(held)
        return held


def scanned_file(path: str) -> tuple[str, int, list[str], bool, str]:
    """MD5, bytes, header, whether a cell may hold a line feed, and format of a file of any size, in the memory of a chunk.
    MD5 and bytes are those of the file as it lies there, the rest is of what a .gz file holds."""
    system, place = pa.fs.FileSystem.from_uri(quote(re.sub(r"^s3[an]://", "s3://", path), safe="/:@"))
    quoted = False
    with system.open_input_file(place) as stream:
        raw = Counted(stream)
        text = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw
        if path.endswith(".parquet"):
            schema = pa.parquet.read_schema(stream)
            header, held, kind = list(schema.names), b"", f"parquet {schema.remove_metadata()}"
            stream.seek(0)
        else:
            header, held, returns = header_of(text)
            kind = "csv crlf" if returns else "csv"
        while held or (held := text.read(CHUNK)):
            quoted = quoted or b'"' in held
            held = b""
    return raw.total.hexdigest(), raw.size, header, quoted, kind


def reachable(path: str) -> bool:
    """Whether executors can open the path themselves."""
    try:
        pa.fs.FileSystem.from_uri(quote(re.sub(r"^s3[an]://", "s3://", path), safe="/:@"))
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


class HadoopStream:
    """A stream of Hadoop's that reads like Python's."""

    def __init__(self, jvm, stream):
        self.jvm, self.stream = jvm, stream

    def read(self, n: int) -> bytes:
        return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(self.jvm.org.apache.commons.io.input.BoundedInputStream(self.stream, n)))


def scanned_by_hadoop(spark: SparkSession, path: str) -> tuple[str, int, list[str], bool, str]:
    """As scanned_file, for stores that only Hadoop opens: by its streams, in the driver, one file after another. Quotes
    are taken for granted, so that only the header's bytes come to Python."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    size, stream = system.getFileStatus(target).getLen(), system.open(target)
    try:
        total = jvm.org.apache.commons.codec.digest.DigestUtils.md5Hex(stream)
        if path.endswith(".parquet"):
            schema = spark.read.parquet(path).schema
            return total, size, schema.names, False, f"parquet {schema.simpleString()}"
        stream.seek(0)
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(target)
        header, _, returns = header_of(HadoopStream(jvm, codec.createInputStream(stream) if codec and path.endswith(".gz") else stream))
    finally:
        stream.close()
    return total, size, header, True, "csv crlf" if returns else "csv"


def scanned(spark: SparkSession, path: str) -> DataFrame:
    """SCAN of the files of an extract, a task a few files. Their paths are listed by the driver, their bytes are read by
    executors, once (by the driver, where executors cannot open their store)."""
    paths = listed(spark, path)
    types = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.bool_(), pa.string()]

    def task(batches):
        for batch in batches:
            rows = [(p, *scanned_file(p)) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=[x.split()[0] for x in SCAN.split(", ")])

    if not paths:
        return spark.createDataFrame([], SCAN)
    if not reachable(paths[0]):
        return spark.createDataFrame([(p, *scanned_by_hadoop(spark, p)) for p in paths], SCAN)
    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(min(len(paths), 10_000)).mapInArrow(task, SCAN)


def read_group(spark: SparkSession, paths: list[str], header: list[str], names: list[str], quoted: bool, kind: str) -> DataFrame:
    """Files of one header and format under names. Only CSV files that hold a quote are read whole by a task, as their
    cells may hold line feeds. An empty cell is null, in quotes or not. A row with more or fewer cells than the header ends
    the job."""
    source = F.col("_metadata.file_path").alias(SOURCE)
    if not kind.startswith("csv"):
        rows = spark.read.parquet(*paths)
        return rows.select(*(rows[f"`{c.replace('`', '``')}`"].cast("string").alias(n) for c, n in zip(header, names, strict=True)), source)
    # Headers may hold any character: columns are read by place and named afterwards.
    places = ", ".join(f"c{i} string" for i in range(len(names)))
    options = {"header": True, "quote": '"' if quoted else "", "escape": '"', "multiLine": quoted, "mode": "FAILFAST", "maxCharsPerColumn": -1, "maxColumns": max(20480, len(names) + 1)}
    if quoted:
        options["lineSep"] = "\r\n" if kind == "csv crlf" else "\n"  # else it is guessed from the first line feed, which may stand in a cell
    rows = spark.read.schema(places).options(**options).csv(paths)
    return rows.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names)), source)


def read_files(spark: SparkSession, found: list, style: str = "ingest") -> DataFrame:
    """Rows of scanned files, all columns as text under normalised names, with SOURCE. Each file is read by its own header:
    columns may stand in another order from file to file, and one that a file lacks is null there. A header that holds a
    name twice is refused."""
    groups: dict[tuple, list[str]] = {}
    for f in found:
        groups.setdefault((tuple(f.header), f.quoted, f.format), []).append(f.path)
    parts = []
    for (header, quoted, kind), paths in sorted(groups.items()):
        names = normalized(list(header), style)
        if SOURCE in names:
            raise ContractError(f"a column may not be called {SOURCE}")
        parts.append(read_group(spark, paths, list(header), names, quoted, kind))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
