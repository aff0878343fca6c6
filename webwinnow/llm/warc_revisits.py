"""WARC archives: writing, reading, and revisit resolution.

Archives are gzipped WARC 1.1 files, written by Spark's text writer (a record per row, two line ends after each), so
files are committed as a whole and survive lost executors. They are read as binary files and parsed record by record.

Deduplication shuffles headers only: records meet by payload digest, one response per digest stays, and the others are
written as revisits that refer to it. Payloads go from the archives that are read straight into the ones that are
written, all with fresh headers: source files are worked off in blocks whose list of revisits has a bounded size and is
sent to the tasks that read the block.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from webwinnow.llm.common import saved, shared_folder
from webwinnow.plans.session import lookup_join

_END = "\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_HEADERS = {
    "record_id": "warc-record-id", "record_type": "warc-type", "page_id": "x-page-id", "uri": "warc-target-uri",
    "digest": "warc-payload-digest", "refers_to": "warc-refers-to",
}


@dataclass(frozen=True)
class Archive:
    """Payloads of at least ``least`` bytes are deduplicated; an archive file holds at most ``records`` records.

    A block of source files has about ``verdicts`` new revisits (some 200 bytes each, sent to every executor).
    """

    least: int = 1000
    records: int = 500
    verdicts: int = 500_000


def _header(name: str, value: Column) -> Column:
    """A header line; nothing for a null. Line ends in values become blanks."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), r"[\r\n]+", " "), F.lit(_END)), F.lit(""))


def _record(record_type: Column, payload: Column) -> Column:
    """The text of a record from columns ``record_id, page_id, uri, digest, refers_to``; a null payload leaves none."""
    block = F.concat(F.lit(_HTTP), F.coalesce(payload, F.lit("")))
    return F.concat(
        F.lit("WARC/1.1" + _END), _header("WARC-Type", record_type),
        _header("WARC-Record-ID", F.concat(F.lit("<"), "record_id", F.lit(">"))), _header("WARC-Target-URI", F.col("uri")),
        _header("WARC-Date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(record_type == "revisit", F.concat(_header("WARC-Profile", F.lit(_PROFILE)), _header("WARC-Refers-To", F.concat(F.lit("<"), "refers_to", F.lit(">"))))).otherwise(""),
        _header("X-Page-Id", F.col("page_id")), _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(block)), F.lit(_END), block,
    )


def _write(records: DataFrame, path: str, archive: Archive, mode: str = "errorifexists") -> str:
    (
        records.write.option("lineSep", _END * 2).option("compression", "gzip").option("maxRecordsPerFile", archive.records)
        .option("zlib.compress.level", "BEST_SPEED").mode(mode).text(path)
    )
    return path


def write_responses(pages: DataFrame, path: str, archive: Archive = Archive(), id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> str:
    """One response record per row; a null html is an empty payload, null ids and urls have no header."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.concat(F.lit("urn:uuid:"), F.uuid()).alias("record_id"), F.col(id_col).alias("page_id"), F.col(url_col).alias("uri"),
        F.sha1(html.cast("binary")).alias("digest"), F.lit(None).cast("string").alias("refers_to"), html.alias("payload"),
    )
    return _write(rows.select(_record(F.lit("response"), F.col("payload")).alias("value")), path, archive)


def _records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    with io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)), 1 << 16) as file:
        while line := file.readline():
            if not line.startswith(b"WARC/"):
                continue
            headers = {}
            while (line := file.readline().rstrip(b"\r\n")):
                name, _, value = line.decode().partition(":")
                headers[name.lower()] = value.strip()
            block = file.read(int(headers["content-length"]))
            yield headers, block[block.index(b"\r\n\r\n") + 4 :]


def _block(file: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(file), F.lit(blocks))


def _files(spark: SparkSession, path: str, block: tuple[int, int] | None) -> DataFrame:
    """``(file, content)`` of the archives under *path*; of block ``(n, blocks)`` only, other files are not opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    if block:
        files = files.where(_block(F.col("_metadata.file_path"), block[1]) == block[0])
    return files.select(F.col("_metadata.file_path").alias("file"), "content")


def read_archives(spark: SparkSession, path: str, payloads: bool, block: tuple[int, int] | None = None) -> DataFrame:
    """Headers and files of all records, bytes and digest of their payloads, and with *payloads* the payloads."""
    names = [*_HEADERS, "file", "payload_bytes", "payload_sha1"] + ["payload"] * payloads
    kinds = [pa.string()] * (len(_HEADERS) + 1) + [pa.int64(), pa.string()] + [pa.binary()] * payloads

    def parse(batches):
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, held = [], 0
                for headers, payload in _records(content.as_py()):
                    values = [headers.get(x) for x in _HEADERS.values()]
                    values = [v.strip("<>") if v and n in ("record_id", "refers_to") else v for n, v in zip(_HEADERS, values)]
                    rows.append([*values, file, len(payload), hashlib.sha1(payload).hexdigest()] + [payload] * payloads)
                    held += len(payload) * payloads + 400
                    if held > 2 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    schema = ", ".join(f"{n} {'bigint' if k == pa.int64() else 'binary' if k == pa.binary() else 'string'}" for n, k in zip(names, kinds))
    read = _files(spark, path, block).mapInArrow(parse, schema).withColumn("digest", F.regexp_replace("digest", "^sha1:", ""))
    return read.withColumn("payload", F.col("payload").cast("string")) if payloads else read


def _fresh(record_id: Column) -> Column:
    """The id of a record's copy in the deduplicated archives."""
    h = F.md5(F.concat(record_id, F.lit(":deduplicated")))
    return F.concat(F.lit("urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"))


def deduplicate(spark: SparkSession, source: str, target: str, archive: Archive = Archive(), id_type: str = "bigint") -> str:
    """Archives in *target* with the records of *source*, equal long payloads once.

    The response of a digest is the record with a payload whose page id is largest (null lowest, then the largest
    record id). Revisits in *source* take part by their digest header and stay revisits; one whose response is nowhere
    in *source* is kept as it is.
    """
    headers = saved(read_archives(spark, source, payloads=False).withColumn("page_id", F.expr(f"try_cast(page_id as {id_type})")), "headers")
    original = F.struct("page_id", "record_id")
    full = headers.where(F.col("record_type") != "revisit").where(F.col("payload_bytes") >= archive.least)
    known = headers.where(F.col("record_type") == "revisit").select(F.col("digest").alias("d")).distinct()
    groups = full.groupBy("payload_sha1").agg(F.max(original)["record_id"].alias("original"), F.count("*").alias("n"))
    groups = groups.join(known, groups["payload_sha1"] == known["d"], "left").where((F.col("n") > 1) | F.col("d").isNotNull())
    groups = saved(groups.select(F.col("payload_sha1").alias("of"), "original"), "originals")
    keyed = headers.select("file", "record_id", _digest().alias("of"))
    met = lookup_join(keyed, groups, "of", "record_id").where(F.col("original") != F.col("record_id"))
    verdicts = saved(met.select("file", "record_id", "of", "original").distinct(), "verdicts")

    blocks = max(1, -(-verdicts.count() // archive.verdicts))
    at = _block(F.col("file"), blocks)
    sizes = dict(verdicts.groupBy(at).count().collect())  # a row per block
    for n in range(blocks):
        again = verdicts.where(at == n).select("record_id", "of", "original").distinct()
        rows = _rewritten(spark, source, again, sizes.get(n, 0), (n, blocks), archive)
        _write(rows.select(_record(F.col("kind"), F.col("payload")).alias("value")), target, archive, "append" if n else "errorifexists")
    return target


def _digest() -> Column:
    """What a record is told by: a revisit by its header, a response by the bytes that were read."""
    return F.when(F.col("record_type") == "revisit", F.col("digest")).otherwise(F.col("payload_sha1"))


def _rewritten(spark: SparkSession, source: str, verdicts: DataFrame, size: int, block: tuple[int, int], archive: Archive) -> DataFrame:
    """The records of a block with fresh headers; *verdicts* name its new revisits.

    The list is broadcast up to twice the size that blocks are planned for; only a block of files so full of copies
    that it is longer joins by key.
    """
    records = read_archives(spark, source, True, block if block[1] > 1 else None).withColumn("digest", _digest())
    listed = verdicts.withColumnRenamed("of", "digest")
    met = records.join(F.broadcast(listed) if size <= 2 * archive.verdicts else listed, ["record_id", "digest"], "left")
    again = F.col("original").isNotNull()
    kind = F.when(again | (F.col("record_type") == "revisit"), "revisit").otherwise("response")
    refers = F.when(again, _fresh(F.col("original"))).otherwise(F.col("refers_to"))
    return met.select("page_id", "uri", "digest", kind.alias("kind"), F.when(kind == "response", F.col("payload")).alias("payload"), refers.alias("refers_to"), _fresh(F.col("record_id")).alias("record_id"))


def resolved(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """Per record: page id, bytes and SHA-1 of its payload, its type, and the page that a revisit refers to.

    Revisits are joined to their responses; what is told of a payload comes from the bytes that were read.
    """
    rows = read_archives(spark, path, payloads=False).withColumn("page_id", F.expr(f"try_cast(page_id as {id_type})"))
    rows = saved(rows, "records")
    responses = rows.where(F.col("record_type") != "revisit")
    found = F.struct(F.col("page_id").alias("p"), F.col("payload_bytes").alias("b"), F.col("payload_sha1").alias("s"))
    originals = responses.groupBy(F.col("record_id").alias("refers_to")).agg(F.max(found).alias("found"))
    revisits = lookup_join(rows.where(F.col("record_type") == "revisit"), originals, "refers_to", "record_id").select(
        "page_id", F.col("found.b").alias("payload_bytes"), F.coalesce("found.s", "digest").alias("payload_digest"), "record_type", F.col("found.p").alias("refers_to"))
    plain = responses.select("page_id", "payload_bytes", F.col("payload_sha1").alias("payload_digest"), "record_type", F.lit(None).cast(id_type).alias("refers_to"))
    return plain.unionByName(revisits)


def revisit_table(pages: DataFrame, archive: Archive = Archive(), id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write *pages* as archives, deduplicate them, read them back; one row per page.

    Repeated rows are records each: one stays a response, the others revisit it. Null ids stay null, extra columns are
    ignored; an empty table gives an empty result.
    """
    spark, kind = pages.sparkSession, dict(pages.dtypes)[id_col]
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    raw = write_responses(pages, f"{folder}/raw", archive, id_col, url_col, html_col)
    return resolved(spark, deduplicate(spark, raw, f"{folder}/deduplicated", archive, kind), kind)
