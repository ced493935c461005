"""Convert legacy ARC archives to WARC, and read WARC archives back.

Three passes, none of which shuffles payloads:

1. ``index`` parses each ARC file (``arc_files``) and keeps one small row per record: its place, URL, date, digest and
   the identifier that the converter will give it.
2. ``choose_types`` decides from these rows alone what each record becomes. Of records with equal payloads the first
   one stays a response and the others become revisits of it.
3. ``convert`` deals the rows by ranges of their place over tasks, and each task fetches its records from the ARC files
   by place and writes a WARC file. A range may begin inside an ARC file, so one large file is no single task's work.

What ARC lacks is synthesised: the identifier is the UUID of the file's name and the record's place, so converting again
gives the same one; the date is the archive date in ISO 8601 (of the version block, if a record has none); a stored HTTP
response becomes a ``response``, the version block a ``warcinfo``, anything else a ``resource``; digests are SHA-256
of payload and block. Damaged records are left out of the archives; ``index`` returns them with their ``error``.

NULLs: an archived row without a URL gets ``about:blank``, one without a body an empty payload, one without a key has
none when it is read back. Rows with equal keys or URLs stay as many as they are. Other columns play no part. A table
without rows gives no file.
"""

from __future__ import annotations

import hashlib
import io
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.llm.arc_files import ArcReader, ArcWriter, gzip_member, gzip_members, http_response, iso_date, one_line, record_at, record_key, split_http
from tiermill.llm.files import new_file, reading, rows_per_batch, writing
from tiermill.llm.hot_keys import attach
from tiermill.llm.workers import ship
from tiermill.sources.scratch import materialize, scratch_path

FILE_BYTES = 128 << 20
LEAST_PAYLOAD = 100
_ROWS = 4096

INDEX = (
    "arc string, at long, size long, record_id string, kind string, uri string, date string, ip string, "
    "content_type string, key string, payload_bytes long, payload_digest string, error string"
)
RECORDS = (
    "file string, at long, kind string, record_id string, date string, uri string, refers_to string, key string, "
    "payload_bytes long, payload_digest string, intact boolean"
)


def _batches(rows: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    fields = [part.split() for part in schema.split(", ")]
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])

    for row in rows:
        held.append(row)
        if len(held) == _ROWS:
            yield batch()
            held = []
    if held:
        yield batch()


def _tasks(df: DataFrame, size: int) -> int:
    """Enough tasks for ``size`` bytes, and not fewer than shuffle partitions."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES))


def write_arc(
    df: DataFrame,
    key: str = "page_id",
    url: str = "url",
    body: str = "html",
    content_type: str = "text/html",
    date: str = "20000101000000",
    versions: Sequence[int] = (1, 2),
    level: int | None = 2,
) -> DataFrame:
    """Store rows as ARC files of ``FILE_BYTES`` at most, or one record; every task goes through the ``versions`` in turn.

    ``level`` is that of gzip, None for plain files. Gives one row per file: ``file``, ``n_records``.
    """
    spark = df.sparkSession
    ship(spark)
    folder = scratch_path(spark, "arc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        row = next(rows, None)
        files = 0
        while row is not None:
            path, n = new_file(folder, "pages"), 0
            with writing(path) as out:
                archive = ArcWriter(out, path.rsplit("/", 1)[-1], versions[files % len(versions)], date, level)
                while row is not None and (n == 0 or archive.size < FILE_BYTES // 4):
                    payload = (row[2] or "").encode()
                    archive.add(one_line(row[1], "about:blank"), date, content_type, http_response(payload, content_type, row[0]))
                    n, row = n + 1, next(rows, None)
            files += 1
            yield pa.RecordBatch.from_pydict({"file": [path], "n_records": pa.array([n], pa.int64())})

    chosen = df.select(F.col(key).cast("string"), F.col(url).cast("string"), F.col(body).cast("string"))
    with rows_per_batch(spark, 500):
        return materialize(chosen.mapInArrow(write, "file string, n_records long"), "arc-files").df


def index(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """One row per record of the ARC files named in ``file``, stored. Equal places cannot occur; damaged records have an ``error``."""
    spark = files.sparkSession
    ship(spark)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with reading(path) as source:
                    began = None
                    for r in ArcReader(source):
                        head, payload = split_http(r.body)
                        own = iso_date(r.date)
                        if r.is_description:
                            began, kind = own, "warcinfo"
                        else:
                            kind = "damaged" if r.error else "response" if head else "resource"
                        identity = uuid.uuid5(uuid.NAMESPACE_URL, f"{path.rsplit('/', 1)[-1]}#{r.at}")
                        yield (
                            path, r.at, r.size, f"<urn:uuid:{identity}>", kind, r.uri, own or began or "1970-01-01T00:00:00Z", r.ip,
                            r.content_type, record_key(head), len(payload), hashlib.sha256(payload).hexdigest(), r.error,
                        )

    spread = files.select("file").repartitionByRange(tasks or _tasks(files, 0), "file")
    return materialize(spread.mapInArrow(lambda batches: _batches(rows(batches), INDEX), INDEX), "arc-index").df


def choose_types(records: DataFrame, order: Sequence[Column] = (), least: int = LEAST_PAYLOAD) -> DataFrame:
    """Add ``first_id``, ``first_uri`` and ``first_date``: the record that a revisit repeats, NULL for all others.

    Of responses with equal payloads of ``least`` bytes or more, the first in ``order`` (then by date and place) is kept.
    """
    sized = records.withColumn("__payload", F.when((F.col("kind") == "response") & (F.col("payload_bytes") >= least), F.col("payload_digest")))
    place = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col("date"), F.col("arc"), F.col("at"), F.col("record_id"), F.col("uri"))
    groups = sized.filter("__payload IS NOT NULL").groupBy("__payload").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    several = groups.filter("n > 1").select("__payload", "n", *[F.col(f"first.{c}").alias(f"first_{c}") for c in ("record_id", "uri", "date")])
    stored = materialize(several, "equal-payloads").df
    joined = attach(sized, stored, "__payload", F.col("n"), records.count(), ["first_record_id", "first_uri", "first_date"])
    other = F.col("first_record_id") != F.col("record_id")
    return joined.select(*records.columns, *[F.when(other, F.col(c)).alias(c) for c in ("first_record_id", "first_uri", "first_date")])


class WarcWriter:
    """Writes one WARC file, a gzip member per record."""

    def __init__(self, out, level: int):
        self._out, self._level = out, level

    def add(self, kind: str, record_id: str, date: str, fields: dict[str, str | None], block: bytes) -> None:
        own = {"WARC-Type": kind, "WARC-Record-ID": record_id, "WARC-Date": date} | fields
        own |= {"WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}", "Content-Length": str(len(block))}
        head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in own.items() if v is not None)
        self._out.write(gzip_member(b"".join((head.encode(), b"\r\n", block, b"\r\n\r\n")), self._level))


def convert(chosen: DataFrame, level: int = 2) -> DataFrame:
    """Write WARC files from rows of ``choose_types``: ``file``, ``n_records`` per file."""
    spark = chosen.sparkSession
    ship(spark)
    folder = scratch_path(spark, "warc")
    columns = ["arc", "at", "size", "record_id", "kind", "uri", "date", "ip", "content_type", "payload_digest", "first_record_id", "first_uri", "first_date"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, path, opened = 0, new_file(folder, "converted"), None
        rows = (row for batch in batches for row in batch.to_pylist())
        row = next(rows, None)
        if row is None:
            return
        with writing(path) as out:
            archive = WarcWriter(out, level)
            while row is not None:
                arc = row["arc"]
                with reading(arc) as opened:
                    while row is not None and row["arc"] == arc:
                        _add(archive, row, record_at(opened, row["at"], row["size"]))
                        n, row = n + 1, next(rows, None)
        yield pa.RecordBatch.from_pydict({"file": [path], "n_records": pa.array([n], pa.int64())})

    whole = materialize(chosen.filter("kind <> 'damaged'").select(*columns), "chosen").df
    size = whole.agg(F.sum("size")).first()[0] or 0
    placed = whole.repartitionByRange(_tasks(whole, size), "arc", "at").sortWithinPartitions("arc", "at")
    return materialize(placed.mapInArrow(write, "file string, n_records long"), "warc-files").df


def _add(archive: WarcWriter, row: dict, data: bytes) -> None:
    """One record in the words of WARC."""
    line, _, body = data.lstrip(b"\r\n").partition(b"\n")
    body = body[: int(line.split()[-1])]
    head, _ = split_http(body)
    fields = {"WARC-Target-URI": row["uri"], "WARC-IP-Address": None if row["ip"] == "0.0.0.0" else row["ip"]}
    if row["kind"] == "warcinfo":
        about = f"software: tiermill\r\nformat: WARC File Format 1.1\r\ndescription: converted from {row['uri']}\r\n".encode()
        archive.add("warcinfo", row["record_id"], row["date"], {"Content-Type": "application/warc-fields"}, about)
        return
    fields["WARC-Payload-Digest"] = f"sha256:{row['payload_digest']}"
    fields["Content-Type"] = "application/http; msgtype=response" if head else row["content_type"]
    if row["first_record_id"] is None:
        archive.add(row["kind"], row["record_id"], row["date"], fields, body)
        return
    fields |= {
        "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        "WARC-Refers-To": row["first_record_id"],
        "WARC-Refers-To-Target-URI": row["first_uri"],
        "WARC-Refers-To-Date": row["first_date"],
    }
    archive.add("revisit", row["record_id"], row["date"], fields, head)


def parse_warc(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields, in lower case, and block of one record."""
    end = data.index(b"\r\n\r\n")
    lines = data[:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    return fields, data[end + 4 : end + 4 + int(fields["content-length"])]


def read_warc(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """One row per record of the WARC files named in ``file``, stored.

    ``payload_bytes`` and ``payload_digest`` are found anew from the block; a revisit has none of its own, so it has the
    digest that it declares and no size until ``resolve``. ``intact``: block and payload have the digests declared.
    """
    spark = files.sparkSession
    ship(spark)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with reading(path) as source:
                    for at, _, data, error in gzip_members(io.BufferedReader(source)):
                        if error:
                            raise ValueError(f"{path} at {at}: {error}")
                        own, block = parse_warc(data)
                        kind = own["warc-type"]
                        head, payload = split_http(block)
                        declared = own.get("warc-payload-digest", "").removeprefix("sha256:")
                        digest, size = hashlib.sha256(payload).hexdigest(), len(payload)
                        intact = own["warc-block-digest"] == f"sha256:{hashlib.sha256(block).hexdigest()}"
                        if kind == "revisit":
                            digest, size = declared, None
                        elif declared:
                            intact = intact and declared == digest
                        yield (
                            path, at, kind, own["warc-record-id"], own["warc-date"], own.get("warc-target-uri"), own.get("warc-refers-to"),
                            record_key(head), size, digest, intact,
                        )

    spread = files.select("file").repartitionByRange(tasks or _tasks(files, 0), "file")
    return materialize(spread.mapInArrow(lambda batches: _batches(rows(batches), RECORDS), RECORDS), "warc-records").df


def resolve(records: DataFrame) -> DataFrame:
    """Give revisits what they refer to: ``refers_to_key`` and ``payload_bytes`` of the response with their payload.

    A revisit whose response is missing or has another payload is not ``intact``.
    """
    revisits = records.filter("kind = 'revisit'")
    wanted = revisits.groupBy("refers_to").agg(F.count(F.lit(1)).alias("n"))
    firsts = records.filter("kind = 'response'").select(
        F.col("record_id").alias("refers_to"),
        F.col("key").alias("refers_to_key"),
        F.col("payload_bytes").alias("__bytes"),
        F.col("payload_digest").alias("__digest"),
    )
    known = materialize(wanted.join(firsts, "refers_to"), "referred").df
    found = ["refers_to_key", "__bytes", "__digest"]
    joined = attach(revisits, known, "refers_to", F.col("n"), records.count(), found)
    joined = joined.withColumn("payload_bytes", F.col("__bytes"))
    joined = joined.withColumn("intact", F.col("intact") & F.col("payload_digest").eqNullSafe(F.col("__digest")))
    rest = records.filter("kind <> 'revisit'").withColumn("refers_to_key", F.lit(None).cast("string"))
    return rest.unionByName(joined.drop("__bytes", "__digest").select(*rest.columns))
