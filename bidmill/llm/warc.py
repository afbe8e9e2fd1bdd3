"""Web archives: pages written as WARC records, and archives read back into one
nested row for each capture.

A page becomes a transaction of three records: a request, a response (or a
revisit) and a metadata record, where request and metadata name the response
in WARC-Concurrent-To. Of pages with equal payloads of at least ``MIN_REVISIT``
bytes the one with the smallest id is a response, the others are revisits with
its payload digest and no payload of their own.

Writing is a plan of built-in functions ending in Spark's text writer (one row
holds one transaction, the line end is part of its last record), compressed as
``.warc.gz``. Payloads aren't shuffled unless the repeated digests exceed the
broadcast bound. Reading takes Spark's text reader with the start of a record
as line separator; a task reads an archive in order, puts lines together until
a record has its Content-Length, checks its digest, and holds one record at a
time. Records are joined on the concurrent-to identifiers of either side.

Defined cases: a NULL payload is empty and an empty one has no bytes; a very
long payload is one record, held whole by a task; a NULL page id stays NULL and
is nobody's first; a NULL URL is written as ``about:invalid`` and read back as
NULL, line breaks in a URL are percent-encoded; rows that repeat an id are captures of their own, and of equal payloads all rows with the
smallest id are responses; an empty table gives an empty archive and no
captures; other columns are ignored. Bytes that are no record, a record that
ends early and a wrong payload digest are errors. A request or metadata record
without its response is in ``unmatched``; of several requests for a response
the one with the smallest record id is in the capture, with their number.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidmill.joins import broadcast_if_small
from bidmill.llm.store import discard, stored
from bidmill.session import ensure_checkpoint_dir

MIN_REVISIT = 100
CAPTURES_PER_FILE = 4096
OUT_BYTES = 8 << 20   # payloads of an output batch

# Fixed values of the format.
START = "WARC/1."     # both versions
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LINE = "\r\n"
NO_URL = "about:invalid"

RECORDS = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("target_uri", T.StringType()), T.StructField("date", T.StringType()),
    T.StructField("concurrent_to", T.ArrayType(T.StringType())),
    T.StructField("refers_to_uri", T.StringType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("http_header", T.StringType()),
    T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
    T.StructField("payload", T.BinaryType())])
ARROW = {"concurrent_to": pa.list_(pa.string()), "payload_bytes": pa.int64(),
         "fields": pa.map_(pa.string(), pa.string()), "payload": pa.binary()}


def _field(name: str, value: Column | str) -> Column:
    """A header line; none where the value is NULL."""
    value = F.lit(value) if isinstance(value, str) else value
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(LINE)), F.lit(""))


def _record(kind: Column | str, own_id: Column, content_type: str, fields: list[Column],
            block: Column, end: str = LINE * 2) -> Column:
    return F.concat(
        F.lit(f"{START}1{LINE}"), _field("WARC-Type", kind), _field("WARC-Record-ID", own_id),
        *fields, _field("Content-Type", content_type),
        _field("Content-Length", F.octet_length(block).cast("string")),
        F.lit(LINE), block, F.lit(end))


def write(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url",
          payload_col: str = "html", date: str = "2024-01-01T00:00:00Z",
          min_revisit: int = MIN_REVISIT, captures_per_file: int = CAPTURES_PER_FILE) -> str:
    """Write the archives of ``pages`` and return their folder (by default a
    new one below ``spark.checkpoint.dir``)."""
    spark = pages.sparkSession
    if path is None:
        path = f"{ensure_checkpoint_dir(spark)}/llm-tables/warc-{uuid.uuid4().hex}"
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    url = F.replace(F.replace(F.col(url_col).cast("string"), F.lit("\r"), F.lit("%0D")),
                    F.lit("\n"), F.lit("%0A"))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"),
                        payload.alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload"),
                             "digest": F.sha2(F.col("payload").cast("binary"), 256)})
    firsts = stored(rows.where(F.col("size") >= min_revisit).groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.min_by("url", "page_id").alias("first_url"),
        F.count("*").alias("copies")).where("copies > 1").drop("copies"), "warc-firsts")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    made = (rows.join(broadcast_if_small(firsts), "digest", "left")
            .withColumn("again", F.coalesce(again, F.lit(False)))
            .withColumns({c: F.expr("concat('<urn:uuid:', uuid(), '>')")
                          for c in ("response_id", "request_id", "metadata_id")}))
    head = [_field("WARC-Date", date),
            _field("WARC-Target-URI", F.coalesce("url", F.lit(NO_URL)))]
    host = F.regexp_extract("url", "://([^/?#]*)", 1)
    target = F.regexp_extract("url", "://[^/?#]*([^#]*)", 1)
    request = F.concat(F.lit("GET "), F.when(target.startswith("/"), target).otherwise(
        F.concat(F.lit("/"), F.coalesce(target, F.lit("")))), F.lit(f" HTTP/1.1{LINE}"),
        _field("Host", host), F.lit(LINE))
    answer = F.concat(F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}"),
                      _field("Content-Length", F.col("size").cast("string")), F.lit(LINE),
                      F.when(F.col("again"), F.lit("")).otherwise(F.col("payload")))
    beside = [*head, _field("WARC-Concurrent-To", F.col("response_id"))]
    text = F.concat(
        _record("request", F.col("request_id"), "application/http; msgtype=request", beside,
                request),
        _record(F.when(F.col("again"), "revisit").otherwise("response"), F.col("response_id"),
                "application/http; msgtype=response",
                [*head, _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
                 F.when(F.col("again"), F.concat(
                     _field("WARC-Profile", PROFILE),
                     _field("WARC-Refers-To-Target-URI", F.coalesce("first_url", F.lit(NO_URL))),
                     _field("WARC-Refers-To-Date", date))).otherwise("")], answer),
        _record("metadata", F.col("metadata_id"), "application/warc-fields", beside,
                _field("pageId", F.col("page_id").cast("string")),
                end=f"{LINE}\r"))    # the text writer adds the last byte
    (made.select(text.alias("text")).write.option("compression", "gzip")
     .option("lineSep", "\n").option("maxRecordsPerFile", captures_per_file).text(path))
    discard(firsts)
    return path


def _parsed(head: bytes, block: bytes, where: str) -> dict:
    """One record as a row of RECORDS."""
    row: dict = {"concurrent_to": []}
    names = {b"warc-record-id": "record_id", b"warc-type": "type",
             b"warc-target-uri": "target_uri", b"warc-date": "date",
             b"warc-payload-digest": "payload_digest",
             b"warc-refers-to-target-uri": "refers_to_uri"}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        name, value = name.lower(), value.removeprefix(b" ").decode("utf-8", "replace")
        if name == b"warc-concurrent-to":
            row["concurrent_to"].append(value)
        elif name in names:
            row[names[name]] = value
    if row.get("target_uri") == NO_URL:
        row["target_uri"] = None
    kind, digest = row.get("type"), row.get("payload_digest")
    row["payload_digest"] = digest = digest and digest.removeprefix("sha256:")
    if kind in ("request", "response", "revisit"):
        header, _, payload = block.partition(b"\r\n\r\n")
        row["http_header"] = header.decode("utf-8", "replace")
        if kind == "response":
            row["payload"], row["payload_bytes"] = payload, len(payload)
            own = hashlib.sha256(payload).hexdigest()
            if digest is None or len(digest) != len(own):
                row["payload_digest"] = own      # none, or of another kind
            elif digest != own:
                raise ValueError(f"wrong payload digest of {row.get('record_id')} in {where}")
    elif kind == "metadata":
        fields = (line.partition(b": ") for line in block.split(b"\r\n") if line)
        row["fields"] = {k.decode("utf-8", "replace"): v.decode("utf-8", "replace")
                         for k, _, v in fields}
    return row


def _records(pieces: Iterator[tuple[str, bytes]]) -> Iterator[dict]:
    """Records from the pieces of archives between two starts of a record; a
    piece may also end at such bytes inside a record."""
    file, held, size, need = None, [], 0, None
    for where, piece in pieces:
        if where != file:
            if held:
                raise ValueError(f"the last record of {file} ends early")
            file = where
            if not piece:        # before the first record
                continue
        held.append(piece)
        size += len(piece) + (len(START) if len(held) > 1 else 0)
        if need is not None and size < need:
            continue
        whole = START.encode().join(held)
        held, size = [whole], len(whole)
        end = whole.find(b"\r\n\r\n")
        if end < 0:
            continue
        head, block = whole[:end], end + 4
        length = [line.partition(b":")[2] for line in head.split(b"\r\n")
                  if line[:15].lower() == b"content-length:"]
        if head[:1] not in (b"0", b"1") or len(length) != 1 or not length[0].strip().isdigit():
            raise ValueError(f"no WARC record in {where}: {head[:80]!r}")
        need = block + int(length[0]) + 4
        if size < need:
            continue
        if size > need or whole[-4:] != b"\r\n\r\n":
            raise ValueError(f"a record in {where} isn't as long as it says: {head[:80]!r}")
        yield _parsed(head, whole[block:-4], where)
        held, size, need = [], 0, None
    if held:
        raise ValueError(f"the last record of {file} ends early")


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([(list(r[f].items()) if f == "fields" and f in r else r.get(f)) for r in rows],
                  ARROW.get(f, pa.string())) for f in RECORDS.fieldNames()],
        names=RECORDS.fieldNames())


def _reading(batches):
    pieces = ((file, line) for b in batches
              for file, line in zip(b.column("file").to_pylist(), b.column("line").to_pylist()))
    rows, size = [], 0
    for row in _records(pieces):
        rows.append(row)
        size += 1000 + (row.get("payload_bytes") or 0)
        if size >= OUT_BYTES:
            yield _batch(rows)
            rows, size = [], 0
    if rows:
        yield _batch(rows)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records (``RECORDS``) of compressed archives; a task reads a file
    from its start, so files that Spark would split are refused."""
    lines = spark.read.option("lineSep", START).text(path)
    split = [f for f in lines.inputFiles() if not f.endswith(".gz")]
    if split:
        raise ValueError(f"archives must be compressed (.gz): {split[0]}")
    return lines.select(F.col("_metadata.file_path").alias("file"),
                        F.col("value").cast("binary").alias("line")).mapInArrow(_reading, RECORDS)


def _beside(records: DataFrame, kind: str, columns: list[Column]) -> DataFrame:
    """One record of a kind for each response: the one with the smallest record
    id that names the response, or that the response names."""
    own = records.where(F.col("type") == kind).select(
        "record_id", F.struct("record_id", *columns).alias(kind), "concurrent_to")
    named = records.where(F.col("type").isin("response", "revisit")).select(
        F.col("record_id").alias("of"), F.explode("concurrent_to").alias("record_id"))
    both = own.select(F.explode("concurrent_to").alias("of"), kind).unionByName(
        named.join(own, "record_id").select("of", kind))
    return both.groupBy("of").agg(F.min_by(kind, f"{kind}.record_id").alias(kind),
                                  F.count_distinct(f"{kind}.record_id").alias(f"n_{kind}"))


def captures(records: DataFrame) -> DataFrame:
    """capture: one nested row (response, request, metadata) for each response
    or revisit, with n_request and n_metadata."""
    main = records.where(F.col("type").isin("response", "revisit")).select(
        F.col("record_id").alias("of"), F.struct(
            "record_id", "type", "target_uri", "date", "refers_to_uri", "payload_digest",
            "payload_bytes", "http_header", "payload").alias("response"))
    asked = _beside(records, "request", [F.col("target_uri"), F.col("http_header")])
    told = _beside(records, "metadata", [
        F.element_at("fields", "pageId").cast("long").alias("page_id"), F.col("fields")])
    return (main.join(asked, "of", "left").join(told, "of", "left")
            .select(F.struct("response", "request", "metadata").alias("capture"),
                    F.coalesce("n_request", F.lit(0)).alias("n_request"),
                    F.coalesce("n_metadata", F.lit(0)).alias("n_metadata")))


def unmatched(records: DataFrame) -> DataFrame:
    """Request and metadata records that share no identifier with a response."""
    main = records.where(F.col("type").isin("response", "revisit"))
    asked = records.where(F.col("type").isin("request", "metadata"))
    linked = asked.select("record_id", F.explode("concurrent_to").alias("of")).join(
        main.select(F.col("record_id").alias("of")), "of", "left_semi").select("record_id")
    named = main.select(F.explode("concurrent_to").alias("record_id"))
    return asked.join(linked.unionByName(named), "record_id", "left_anti")


def resolved(found: DataFrame) -> DataFrame:
    """Captures with payload_bytes, payload_digest and refers_to: for a revisit,
    those of the response with its payload digest and the smallest page id."""
    flat = found.select("capture.response.type", "capture.response.payload_digest",
                        "capture.response.payload_bytes", "capture.metadata.page_id")
    again = flat.where(F.col("type") == "revisit").select("payload_digest").distinct()
    firsts = stored(flat.where(F.col("type") == "response")
                    .join(again, "payload_digest", "left_semi").groupBy("payload_digest")
                    .agg(F.min("page_id").alias("refers_to"),
                         F.max("payload_bytes").alias("_bytes"))
                    .withColumnRenamed("payload_digest", "_digest"), "warc-originals")
    response = F.col("capture.response")
    # a response has no original: its own record id meets no digest
    key = F.when(response["type"] == "revisit", response["payload_digest"]).otherwise(
        response["record_id"])
    return (found.withColumn("_key", key)
            .join(broadcast_if_small(firsts), F.col("_key") == F.col("_digest"), "left")
            .withColumns({"payload_bytes": F.coalesce(response["payload_bytes"], "_bytes"),
                          "payload_digest": response["payload_digest"]})
            .drop("_key", "_digest", "_bytes"))
