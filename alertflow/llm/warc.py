"""WARC archives: writing with segments and chunked bodies, reading, and putting records together.

Archives are written and read by Spark's text source, with the end and the start of a record as line
separators, so any file system that Spark knows will do. A record whose body is longer than
``segment_bytes`` becomes a first segment and continuation records, which share an origin identifier.
Reading groups the segments by origin, orders them by number, checks the total length and takes off
the HTTP head and the chunked transfer framing.

Defined results: a null payload is empty and has a record without chunks but the last; a repeated segment
counts once, a record without segments as often as it is stored; a record with a missing segment, a wrong total length or broken framing is kept, with
``problem`` saying so and a null payload; revisits have no payload of their own; equal rows get
records of their own; an empty table gives an empty archive and no records.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertflow.llm.common import written

VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = "name string, type string, uri string, digest string, refers_to string, segment long, total long, content binary"


def chunked(payload: bytes, size: int) -> bytes:
    """Chunked transfer framing, with a cut inside every text that starts a record."""
    cuts = set(range(size, len(payload), size))
    mark, at = VERSION.encode(), -1
    while (at := payload.find(mark, at + 1)) >= 0:
        cuts.add(at + 4)
    out, start = [], 0
    for end in [*sorted(cuts), len(payload)]:
        if end > start:
            out.append(b"%x\r\n%b\r\n" % (end - start, payload[start:end]))
            start = end
    return b"".join(out) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload inside chunked framing; raises ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(out)
        if size < 0 or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk without its end")
        out.append(body[at : at + size])
        at += size + 2


def payload_of(http: bytes) -> bytes:
    head, found, body = http.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("no HTTP head")
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def mark_revisits(pages: DataFrame, key: str, payload: Column, least_bytes: int) -> DataFrame:
    """``pages`` with payload, digest, ``type`` and ``refers_to``.

    Of equal payloads with at least ``least_bytes``, the row with the largest key is the response and
    the others revisit it. Largest keys are found with partial aggregation; the join back holds no
    payloads on its small side, so Spark splits a hot digest.
    """
    full = pages.withColumn("payload", payload).withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= least_bytes
    first = full.filter(large).groupBy("digest").agg(F.max(key).alias("_first"))
    joined = full.join(first.filter("_first IS NOT NULL"), "digest", "left")
    again = large & (F.col(key) < F.col("_first"))
    return joined.select(
        *pages.columns, "payload", "digest", F.when(again, "revisit").otherwise("response").alias("type"),
        F.when(again, F.col("_first")).alias("refers_to"),
    )


def records(rows: DataFrame, segment_bytes: int = 1 << 16, chunk_bytes: int = 1 << 13) -> DataFrame:
    """One text per record of ``rows`` (name, uri, type, digest, refers_to, payload), without its ends."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                head = [f"WARC-Target-URI: {row.uri}", f"WARC-Payload-Digest: sha1:{row.digest}"]
                if row.type == "revisit":
                    head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{row.refers_to}>"]
                    out.append(record("revisit", row.name, head, HTTP_HEAD))
                    continue
                block = HTTP_HEAD + chunked(row.payload, chunk_bytes)
                parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
                for k, part in enumerate(parts):
                    more = list(head)
                    if len(parts) > 1:
                        more.append(f"WARC-Segment-Number: {k + 1}")
                    if k:
                        more.append(f"WARC-Segment-Origin-ID: <{row.name}>")
                    if k and k == len(parts) - 1:
                        more.append(f"WARC-Segment-Total-Length: {len(block)}")
                    name = f"{row.name}:{k + 1}" if k else row.name
                    out.append(record("continuation" if k else "response", name, more, part))
            yield pd.DataFrame({"value": out})

    text = rows.select("name", "uri", "type", "digest", "refers_to", "payload").mapInPandas(build, "value binary")
    return text.select(F.col("value").cast("string").alias("value"))


def record(kind: str, name: str, head: list[str], block: bytes) -> bytes:
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", *head, f"Content-Length: {len(block)}", "", ""]
    return VERSION.encode() + "\r\n".join(lines).encode() + block


def write_archive(rows: DataFrame, folder: str, file_records: int = 100_000, **sizes) -> None:
    """Compressed files of at most ``file_records`` records, since a compressed file is read by one task."""
    out = records(rows, **sizes).write.option("lineSep", END).option("maxRecordsPerFile", file_records)
    out.text(folder, compression="gzip")


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """The records of an archive as ``RECORD``, one row per segment.

    Text between two record starts is a record, unless its Content-Length says that a start stands
    inside its block; the pieces of such files are joined again, by lengths alone.
    """
    lines = spark.read.option("lineSep", VERSION).text(folder)
    pieces = lines.select(
        F.col("value").cast("binary").alias("piece"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"),
    ).filter(F.octet_length("piece") > 0)
    text = F.col("piece").cast("string")
    declared = F.regexp_extract(F.substring_index(text, "\r\n\r\n", 1), r"(?i)(?:^|\n)Content-Length: *(\d+)", 1)
    head_bytes = F.octet_length(F.substring_index(text, "\r\n\r\n", 1)) + 4
    sized = pieces.withColumn("need", head_bytes + F.when(declared != "", declared).cast("long") + len(END))
    whole = F.col("need").eqNullSafe(F.octet_length("piece").cast("long"))
    # Known before the pieces are read, so that archives without such files shuffle none.
    torn = written(sized.filter(~whole).select("file").distinct(), "torn")
    if torn.isEmpty():
        return sized.select("piece").mapInPandas(_parse, RECORD)
    good = sized.join(torn, "file", "left_anti").select("piece")
    narrow = sized.join(torn, "file").select("file", "block", "line", "need", F.octet_length("piece").cast("long").alias("size"))

    def starts(key, lengths: pd.DataFrame) -> pd.DataFrame:
        """Number each piece by the record it belongs to."""
        lengths = lengths.sort_values(["block", "line"])
        number, missing, out = -1, 0, []
        for need, size in zip(lengths["need"], lengths["size"], strict=True):
            if missing <= 0:
                number, missing = number + 1, (0 if pd.isna(need) else need) - size
            else:
                missing -= size + len(VERSION)
            out.append(number)
        return lengths.assign(record=out)[["file", "block", "line", "record"]]

    placed = narrow.groupBy("file").applyInPandas(starts, "file string, block long, line long, record long")
    parts = sized.join(placed, ["file", "block", "line"]).groupBy("file", "record")
    joined = parts.agg(F.array_sort(F.collect_list(F.struct("block", "line", "piece"))).alias("all"))
    bodies = F.transform("all", lambda p: p["piece"].cast("string"))
    mended = joined.select(F.concat_ws(VERSION, bodies).cast("binary").alias("piece"))
    return good.unionByName(mended).mapInPandas(_parse, RECORD)


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [part.split()[0] for part in RECORD.split(", ")]
    for batch in batches:
        rows = []
        for piece in batch["piece"]:
            head, _, block = piece.partition(b"\r\n\r\n")
            fields = dict(
                (k.strip().lower(), v.strip().strip("<>"))
                for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n"))
            )
            size = int(fields.get("content-length") or 0)
            rows.append(
                (
                    fields.get("warc-segment-origin-id") or fields.get("warc-record-id"), fields.get("warc-type"),
                    fields.get("warc-target-uri"), fields.get("warc-payload-digest", "").removeprefix("sha1:"),
                    fields.get("warc-refers-to"),
                    int(fields["warc-segment-number"]) if "warc-segment-number" in fields else None,
                    int(fields["warc-segment-total-length"]) if "warc-segment-total-length" in fields else None,
                    block[:size],
                )
            )
        yield pd.DataFrame(rows, columns=names).astype({"segment": "Int64", "total": "Int64"})


def reassemble(segments: DataFrame) -> DataFrame:
    """(name, type, uri, digest, refers_to, payload, problem): segments put together by origin.

    Grouped by origin identifier, ordered by segment number, checked against the total length. Records
    without a segment number are whole and stay where they are.
    """
    single = F.col("segment").isNull() & ~F.col("type").eqNullSafe("continuation")
    grouped = segments.filter(~single).groupBy("name").agg(
        F.max(F.when(F.col("type") != "continuation", F.col("type"))).alias("type"),
        F.max("uri").alias("uri"), F.max("digest").alias("digest"), F.max("refers_to").alias("refers_to"),
        F.max("total").alias("total"),
        F.array_sort(F.collect_set(F.struct("segment", "content"))).alias("parts"),
    )
    numbers = F.transform("parts", lambda p: p["segment"])
    ordered = numbers == F.sequence(F.lit(1).cast("long"), F.size("parts").cast("long"))
    whole = F.concat_ws("", F.transform("parts", lambda p: p["content"].cast("string"))).cast("binary")
    joined = grouped.withColumn("block", whole).withColumn(
        "problem",
        F.when(F.col("type").isNull(), "no first segment")
        .when(~ordered, "segments missing")
        .when((F.size("parts") > 1) & F.col("total").isNull(), "no last segment")
        .when(F.col("total").isNotNull() & (F.octet_length("block") != F.col("total")), "wrong total length"),
    )

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            payloads, problems = [], []
            for kind, block, problem in zip(batch["type"], batch["block"], batch["problem"], strict=True):
                payload = None
                if problem is None and kind != "revisit":
                    try:
                        payload = payload_of(block)
                    except ValueError:
                        problem = "broken framing"
                payloads.append(payload)
                problems.append(problem)
            yield batch.drop(columns="block").assign(payload=payloads, problem=problems)

    columns = ["name", "type", "uri", "digest", "refers_to", "block", "problem"]
    schema = "name string, type string, uri string, digest string, refers_to string, problem string, payload binary"
    alone = segments.filter(single).withColumn("block", F.col("content")).withColumn("problem", F.lit(None).cast("string"))
    return alone.select(*columns).unionByName(joined.select(*columns)).mapInPandas(decode, schema)


def payload_facts(found: DataFrame) -> DataFrame:
    """(name, type, refers_to, payload_bytes, payload_digest) of reassembled records.

    The digest is taken of the payload that was read; a revisit has those of the record it refers to.
    """
    own = found.select(
        "name", "type", "refers_to", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
    )
    own = written(own, "facts")
    original = own.filter("type <> 'revisit'").select(
        F.col("name").alias("refers_to"), F.col("payload_bytes").alias("_bytes"), F.col("payload_digest").alias("_digest")
    )
    return own.join(original, "refers_to", "left").select(
        "name", "type", "refers_to", F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"),
        F.coalesce("payload_digest", "_digest").alias("payload_digest"),
    )
