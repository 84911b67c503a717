"""Operator 7, WARC files: writing, reading and a Merkle fixity audit of replicas.

A record's leaf is the SHA-256 of its offset, length and content digest. The address space (file number
times ``FILE_SPAN`` plus offset) is cut into ranges of ``RANGE`` bytes; a range's hash covers its leaves
in the order of offsets, and every ``FANOUT`` neighbouring hashes make one of the next level, up to the
file's and on to the archive's root. An audit compares the roots of two replicas and descends, level by
level, only below hashes that differ; records are compared in differing ranges alone.

Every group is bounded: a range by its bytes, an inner node by its fan-out.

Defined results: null url or html counts as empty; rows that repeat are records of their own, one after
the other; empty replicas have no root and compare equal to each other, and against a filled one every record is
missing or extra; extra columns of the pages are not stored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

RANGE, FANOUT = 1 << 16, 256
FILE_SPAN = 1 << 40  # more than a file's length; RANGE * FANOUT ** 3
PER_FILE = 1000
END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"


def record_of(page_id: Column, url: Column, html: Column) -> Column:
    """A resource record as text, without the two line ends that close it."""
    key = F.md5(F.concat_ws(":", page_id.cast("string"), url))
    parts = [F.substring(key, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:"), F.concat_ws("-", *parts),
        F.lit(f">\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), F.regexp_replace(url, r"[\r\n]", ""),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit(END), html)


def _records(pages: DataFrame, page_id: str, url: str, html: str, per_file: int) -> DataFrame:
    """page_id, uri, file, record: a file is chosen by a hash."""
    clean = pages.select(F.col(page_id).alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("uri"),
                         F.coalesce(F.col(html), F.lit("")).alias("html"))
    files = max(1, -(-clean.count() // per_file))
    place = F.conv(F.substring(F.md5(F.concat_ws(":", F.col("page_id").cast("string"), "uri")), 1, 8), 16, 10).cast("long")
    return clean.select("page_id", "uri", (place % files).alias("file"),
                        record_of(F.col("page_id"), F.col("uri"), F.col("html")).alias("record"))


def _laid(rows: DataFrame, order: list[str]) -> DataFrame:
    """file, offset, length, page_id, uri, digest, record: records hashed and laid one after the other in ``order``."""
    rows = rows.withColumn("length", (F.octet_length("record") + len(END)).cast("long")).withColumn("digest", F.sha2("record", 256))
    before = Window.partitionBy("file").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")) \
        .select("file", "offset", "length", "page_id", "uri", "digest", "record")


def pack(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", per_file: int = PER_FILE) -> DataFrame:
    """file, offset, length, page_id, uri, digest, record: pages as records of files of about ``per_file``.

    A file is chosen by a hash; inside, records stand in the order of id and digest.
    """
    return _laid(_records(pages, page_id, url, html, per_file), ["page_id", "digest"])


def pack_damaged(pages: DataFrame, *, changed: Column, lost: Column, again: Column, page_id: str = "page_id", url: str = "url",
                 html: str = "html", per_file: int = PER_FILE) -> DataFrame:
    """As :func:`pack`, of a replica with damage: the last character of ``changed`` records is another one, ``lost``
    records are left out, and ``again`` records stand there (unharmed) once more at the end of their file.

    The conditions are on ``page_id`` and ``uri``; null is false. Digests and offsets are those of the altered text.
    """
    rows = _records(pages, page_id, url, html, per_file).withColumn("was", F.sha2("record", 256))
    text = F.col("record")
    other = F.concat(F.substring(text, F.lit(1), F.char_length(text) - 1), F.when(F.right(text, F.lit(1)) == "#", "@").otherwise("#"))
    no = F.lit(False)
    copies = F.concat(F.when(F.coalesce(lost, no), F.array().cast("array<int>")).otherwise(F.array(F.lit(0))),
                      F.when(F.coalesce(again, no), F.array(F.lit(1))).otherwise(F.array().cast("array<int>")))
    rows = rows.withColumn("copy", F.explode(copies)).withColumn("record", F.when(F.coalesce(changed, no) & (F.col("copy") == 0), other).otherwise(text))
    return _laid(rows, ["copy", "page_id", "was"])


def write_warc(packed: DataFrame, path: str) -> None:
    """Write the records of :func:`pack` as WARC files below ``path``, one folder a file."""
    packed.repartition("file").sortWithinPartitions("file", "offset").select("file", "record") \
        .write.partitionBy("file").option("lineSep", END).text(path)


def parse_warc(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, payload) of the records of a file, plain or gzipped record by record."""
    if data[:2] == b"\x1f\x8b":
        at = 0
        while at < len(data):
            z = zlib.decompressobj(31)
            body = z.decompress(data[at:]) + z.flush()
            used = len(data) - at - len(z.unused_data)
            for _, _, headers, payload in parse_warc(body):
                yield at, used, headers, payload
            at += used
        return
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        headers = {}
        for line in data[at:end].split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            headers[name.decode().strip().lower()] = value.decode("utf-8", "replace").strip()
        length = headers.get("content-length", "")
        size = int(length) if length.isdigit() else 0
        payload = data[end + 4: end + 4 + size]
        stop = min(end + 4 + size + 4, len(data))
        yield at, stop - at, headers, payload
        at = stop


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """path, offset, length, type, uri, payload of all records of the files below ``path``; a file is read whole
    by one task, as gzipped ones must be, so memory follows the largest file."""
    schema = "path string, offset bigint, length bigint, type string, uri string, payload binary"

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                rows = [(path, at, n, h.get("warc-type"), h.get("warc-target-uri"), p) for at, n, h, p in parse_warc(content)]
                cols = list(zip(*rows)) or [()] * 6
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[x.split()[0] for x in schema.split(", ")])

    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content").mapInArrow(run, schema)


def _stretches(data: bytes) -> Iterator[tuple[int, int, str | None]]:
    """(offset, length, uri) of everything that a stored file holds, without a gap: records, gzip members, and with
    a null uri what no record begins (damaged heads, damaged members, bytes behind the last record)."""
    def found() -> Iterator[tuple[int, int, str | None]]:
        if data[:2] != b"\x1f\x8b":
            yield from ((at, n, h.get("warc-target-uri")) for at, n, h, _ in parse_warc(data))
            return
        at = 0
        while at >= 0:
            z, body, pos = zlib.decompressobj(31), [], at
            try:
                while pos < len(data) and not z.eof:
                    body.append(z.decompress(data[pos:pos + RANGE]))
                    pos += RANGE
            except zlib.error:
                pass
            if z.eof:
                pos = min(pos, len(data)) - len(z.unused_data)
                yield at, pos - at, next((h.get("warc-target-uri") for _, _, h, _ in parse_warc(b"".join(body))), None)
            at = data.find(b"\x1f\x8b\x08", pos if z.eof else at + 1)

    end = 0
    for at, n, uri in found():
        if at > end:
            yield end, at - end, None
        yield at, n, uri
        end = at + n
    if end < len(data):
        yield end, len(data) - end, None


def stored_index(spark: SparkSession, path: str) -> DataFrame:
    """file, offset, length, uri, digest of the WARC files that :func:`write_warc` wrote below ``path``, for :func:`audit`.

    ``digest`` is the SHA-256 of the stored bytes, from the record's first to its last, as in :func:`pack` without the two line
    ends if they are whole (with what stands there otherwise). Every byte of a file is in one row, so no changed byte
    goes unseen. ``file`` is the number in the folder's name; a file is read whole by one task."""
    schema = "file bigint, offset bigint, length bigint, uri string, digest string"
    end = END.encode()

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                number = re.search(r"/file=(\d+)/[^/]*$", path)
                if number is None:
                    raise ValueError(f"no folder file=N: {path}")
                rows = [(int(number[1]), at, n, uri, hashlib.sha256(content[at: at + n].removesuffix(end)).hexdigest())
                        for at, n, uri in _stretches(content)]
                cols = list(zip(*rows)) or [()] * 5
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[x.split()[0] for x in schema.split(", ")])

    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content").mapInArrow(run, schema)


def _leaves(replica: DataFrame, name: str) -> DataFrame:
    address = F.col("file") * F.lit(FILE_SPAN) + F.col("offset")
    return replica.select(F.lit(name).alias("replica"), "file", "offset", "length", "digest",
                          F.floor(address / F.lit(RANGE)).cast("long").alias("node"))


def levels(leaves: DataFrame) -> list[DataFrame]:
    """Tables (replica, node, hash) of the tree, ranges first, the root last."""
    leaf = F.sha2(F.concat_ws(":", "offset", "length", "digest"), 256)
    ranges = leaves.select("replica", "node", "offset", leaf.alias("leaf")).groupBy("replica", "node").agg(
        F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("offset", "leaf"))), lambda x: x["leaf"]), ","), 256).alias("hash"))
    out = [materialise(ranges, "merkle_ranges")]
    top = out[0].agg(F.max("node").alias("n")).first()["n"] or 0
    while top > 0:
        top //= FANOUT
        up = out[-1].select("replica", F.floor(F.col("node") / FANOUT).cast("long").alias("up"), "node", "hash").groupBy("replica", "up").agg(
            F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", "hash"))),
                                            lambda x: F.concat_ws("=", x["node"].cast("string"), x["hash"])), ","), 256).alias("hash"))
        out.append(materialise(up.withColumnRenamed("up", "node"), "merkle_level"))
    return out


def _differing(level: DataFrame) -> DataFrame:
    """Nodes whose hashes differ or that one replica lacks."""
    return level.groupBy("node").agg(F.count("*").alias("n"), F.min("hash").alias("lo"), F.max("hash").alias("hi")) \
        .where("n < 2 or lo != hi").select("node")


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """file, offset, length, fault, digest, other_digest of the records in which two replicas differ.

    ``fault``: changed (other content at the offset), moved (the same content elsewhere in the file; one row
    per record of the first replica), missing (only in the first), extra (only in the second).
    """
    leaves = materialise(_leaves(first, "a").union(_leaves(second, "b")), "merkle_leaves")
    tree = levels(leaves)
    bad = _differing(tree[-1])
    for level in reversed(tree[:-1]):
        below = level.withColumn("up", F.floor(F.col("node") / FANOUT).cast("long")).join(bad.withColumnRenamed("node", "up"), "up", "left_semi")
        bad = _differing(below.drop("up"))
    near = leaves.join(materialise(bad, "merkle_bad"), "node", "left_semi")
    nth = Window.partitionBy("replica", "file", "offset").orderBy("digest")
    near = near.withColumn("nth", F.row_number().over(nth))

    def side(name: str, tag: str) -> DataFrame:
        return near.where(F.col("replica") == name).select("file", "offset", "nth", F.col("length").alias(f"length{tag}"), F.col("digest").alias(f"digest{tag}"))

    both = side("a", "").join(side("b", "_b"), ["file", "offset", "nth"], "full")
    same = (F.col("digest") == F.col("digest_b")) & (F.col("length") == F.col("length_b"))
    differ = materialise(both.where(~F.coalesce(same, F.lit(False))), "merkle_differ")
    gone = differ.where("digest is not null").select("file", "digest").distinct()
    come = differ.where("digest_b is not null").select("file", F.col("digest_b").alias("digest")).distinct()
    moved = materialise(gone.join(come, ["file", "digest"], "left_semi"), "merkle_moved")

    def with_moved(df: DataFrame, digest: str, tag: str) -> DataFrame:
        """``tag``: whether this digest left or came to another place of the file."""
        other = moved.select(F.col("file").alias("m_file"), F.col("digest").alias("m_digest"), F.lit(True).alias(tag))
        return df.join(other, (F.col("file") == F.col("m_file")) & (F.col(digest) == F.col("m_digest")), "left").drop("m_file", "m_digest")

    here = with_moved(with_moved(differ, "digest", "moved"), "digest_b", "moved_2")
    fault = (
        F.when(F.col("moved").isNotNull(), "moved").when(F.col("digest").isNull() & F.col("moved_2").isNull(), "extra")
        .when(F.col("digest").isNull(), F.lit(None)).when(F.col("digest_b").isNull() | F.col("moved_2").isNotNull(), "missing").otherwise("changed"))
    return here.select("file", "offset", F.coalesce("length", "length_b").alias("length"), fault.alias("fault"), "digest",
                       F.col("digest_b").alias("other_digest")).where("fault is not null")
