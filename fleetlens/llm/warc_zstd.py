"""WARC archives compressed with Zstandard: writer and reader.

An archive starts with a skippable frame that holds its dictionary, then has one frame
per record. Payloads of at least ``min_bytes`` that occur more than once are stored with
the smallest page_id only; the others are revisit records that refer to it.

Every task writes archives of bounded size through its own streams and reports them in a
manifest; a retried task writes new files and only its manifest counts. The reader takes
the manifest, streams each archive, decodes frame by frame, and checks version, headers,
block length, payload length and digest. A record that fails has its reason in ``error``.

A null payload is empty. Rows that share the smallest page_id of a payload are all
responses; a payload whose ids are all null is stored with each. A null URL has no
header. Row order does not matter. An empty table gives no archive and no row. Ids travel
as text, so nulls beside them don't round large ones.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.shared import shared_root, small, written

SKIPPABLE = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
CHUNK = 1 << 20
MANIFEST = "path string, records long, bytes long"
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, error string"
)


def plan_records(pages: DataFrame, min_bytes: int = 100, max_broadcast: int = 200_000) -> DataFrame:
    """page_id, url, payload (null in revisits), payload_bytes, payload_digest, record_type, refers_to."""
    payload = F.coalesce(F.encode("html", "utf-8"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.length("payload").cast("long"), "payload_digest": F.sha2("payload", 256)})
    repeated = (
        rows.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1 AND first_id IS NOT NULL")
        .drop("n")
    )
    joined = rows.join(small(written(repeated, "repeated"), max_broadcast), "payload_digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def _urn(page_id) -> str:
    return "<urn:page:{}>".format("" if pd.isna(page_id) else int(page_id))


def _page_of(urn: str) -> int | None:
    text = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def render(row, date: str = "2000-01-01T00:00:00Z") -> bytes:
    """One WARC record, with the HTTP head and, in responses, the payload as its block."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row.payload_bytes}\r\n\r\n".encode()
    headers = [("WARC-Type", row.record_type), ("WARC-Record-ID", _urn(row.page_id)), ("WARC-Date", date)]
    if row.url is not None:
        headers.append(("WARC-Target-URI", row.url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")))
    headers += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha256:{row.payload_digest}")]
    if row.record_type == "revisit":
        headers += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", _urn(row.refers_to)),
        ]
    else:
        block += row.payload
    headers.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode("utf-8", "replace") + block + b"\r\n\r\n"


def parse(record: bytes) -> tuple:
    """The fields of ``RECORDS``; ``error`` tells what is wrong with a record."""
    try:
        head, mark, rest = record.partition(b"\r\n\r\n")
        version, *lines = head.decode("utf-8").split("\r\n")
        if not mark or version not in ("WARC/1.0", "WARC/1.1"):
            raise ValueError("no WARC header")
        fields = {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in lines)}
        for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
            if name not in fields:
                raise ValueError(f"no {name}")
        size = int(fields["content-length"])
        if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
            raise ValueError("block length differs from content-length")
        http, mark, payload = rest[:size].partition(b"\r\n\r\n")
        if not mark or not http.startswith(b"HTTP/"):
            raise ValueError("no HTTP header")
        stated = next(int(line.split(b":")[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
        digest = fields["warc-payload-digest"].removeprefix("sha256:")
        if fields["warc-type"] == "response":
            if len(payload) != stated:
                raise ValueError("payload length differs from its header")
            if hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError("payload digest differs")
        elif fields["warc-type"] != "revisit" or payload or "warc-refers-to" not in fields:
            raise ValueError("neither response nor revisit")
        url = fields.get("warc-target-uri")
        url = url and url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
        refers = _page_of(fields["warc-refers-to"]) if fields["warc-type"] == "revisit" else None
        return _page_of(fields["warc-record-id"]), url, stated, digest, fields["warc-type"], refers, None
    except (ValueError, KeyError, IndexError, StopIteration) as problem:
        return None, None, None, None, None, None, str(problem) or type(problem).__name__


def dictionary(samples: list[bytes], size: int) -> bytes:
    """A dictionary trained on a bounded number of records; empty if they are too few."""
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


class Archive:
    """One file: the dictionary in a skippable frame, then a frame per record."""

    def __init__(self, folder: str, samples: list[bytes], dictionary_bytes: int, level: int) -> None:
        system, base = pyarrow.fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc.zst"
        self.path, self.records, self.bytes = f"{folder}/{name}", 0, 0
        self.out = system.open_output_stream(f"{base}/{name}", compression=None)
        trained = dictionary(samples, dictionary_bytes)
        packed = zstandard.ZstdCompressor(level=level).compress(trained) if trained else b""
        self._write(SKIPPABLE.to_bytes(4, "little") + len(packed).to_bytes(4, "little") + packed)
        given = zstandard.ZstdCompressionDict(trained) if trained else None
        self.compressor = zstandard.ZstdCompressor(level=level, dict_data=given, write_checksum=True)

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def add(self, record: bytes) -> None:
        self._write(self.compressor.compress(record))
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        return self.path, self.records, self.bytes


def write_archives(
    records: DataFrame,
    folder: str,
    archive_bytes: int = 64 << 20,
    samples: int = 128,
    sample_bytes: int = 4096,
    dictionary_bytes: int = 16384,
    level: int = 3,
) -> DataFrame:
    """Writes the planned records below ``folder``; returns the manifest (path, records, bytes), written."""

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done, archive, waiting = [], None, []
        for frame in frames:
            for row in frame.itertuples(index=False):
                record = render(row)
                if archive is None:
                    waiting.append(record)
                    if len(waiting) < samples and sum(map(len, waiting)) < samples * sample_bytes:
                        continue
                    archive = Archive(folder, [w[:sample_bytes] for w in waiting], dictionary_bytes, level)
                    for w in waiting:
                        archive.add(w)
                    waiting = []
                else:
                    archive.add(record)
                if archive.bytes >= archive_bytes:
                    done.append(archive.close())
                    archive = None
        if waiting:
            archive = Archive(folder, [w[:sample_bytes] for w in waiting], dictionary_bytes, level)
            for w in waiting:
                archive.add(w)
        if archive:
            done.append(archive.close())
        yield pd.DataFrame(done, columns=["path", "records", "bytes"])

    as_text = {c: F.col(c).cast("string") for c in ("page_id", "refers_to")}
    return written(records.withColumns(as_text).mapInPandas(write, MANIFEST), "manifest", merged=False)


def frames_of(stream) -> Iterator[bytes]:
    """The content of each frame of an open archive, one at a time."""
    def exactly(n: int) -> bytes:
        data = stream.read(n)
        if len(data) != n:
            raise ValueError("archive ends within its dictionary")
        return data

    given, magic = None, stream.read(4)
    if len(magic) == 4 and 0x184D2A50 <= int.from_bytes(magic, "little") <= 0x184D2A5F:
        packed = exactly(int.from_bytes(exactly(4), "little"))
        if packed:
            trained = zstandard.ZstdDecompressor().decompress(packed) if packed[:4] == ZSTD_MAGIC else packed
            given = zstandard.ZstdCompressionDict(trained)
        magic = b""
    reader, rest = zstandard.ZstdDecompressor(dict_data=given), magic
    while data := rest or stream.read(CHUNK):
        frame, parts = reader.decompressobj(), []
        while data:
            parts.append(frame.decompress(data))
            if frame.eof:
                break
            data = stream.read(CHUNK)
        if not frame.eof:
            raise ValueError("archive ends within a frame")
        rest = frame.unused_data
        yield b"".join(parts)


def read_archives(manifest: DataFrame, rows_at_once: int = 2000) -> DataFrame:
    """The records of all archives of a manifest; archives are dealt over the tasks."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split(" ")[0] for c in RECORDS.split(", ")]
        for frame in frames:
            for path in frame["path"]:
                system, at = pyarrow.fs.FileSystem.from_uri(path)
                with system.open_input_stream(at, compression=None) as stream:
                    out = []
                    for record in frames_of(stream):
                        out.append(parse(record))
                        if len(out) >= rows_at_once:
                            yield _typed(out, columns)
                            out = []
                    yield _typed(out, columns)

    def _typed(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
        found = pd.DataFrame(rows, columns=columns, dtype=object)
        return found.astype({c: "Int64" for c in ("page_id", "payload_bytes", "refers_to")})

    spark = manifest.sparkSession
    tasks = max(1, min(manifest.count(), 8 * spark.sparkContext.defaultParallelism))
    return manifest.repartition(tasks, "path").mapInPandas(read, RECORDS)


def round_trip(pages: DataFrame, folder: str | None = None, min_bytes: int = 100) -> DataFrame:
    """Writes the pages as archives in the shared folder and reads them back."""
    folder = folder or f"{shared_root(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    return read_archives(write_archives(plan_records(pages, min_bytes), folder))
