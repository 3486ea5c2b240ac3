"""Fill-in-the-middle texts by secondary-sort assembly.

A text is cut into prefix, middle and suffix at two places drawn from its id. Its output, in one
of two forms, is ``<P>prefix<S>suffix<M>middle`` (psm) or ``<S>suffix<P>prefix<M>middle`` (spm);
some texts stay as they are (plain). No task puts a whole output together to digest it: every text
is emitted as pieces of at most ``units`` code points, keyed by the document and the piece's
position in the output. ``repartitionAndSortWithinPartitions`` brings each document's pieces in
that order to one task, which streams them into a SHA-256. From the sorted output and its form
alone the same task finds the sections again by their marks and keys their pieces by section and
position in the original text; a second sort streams them into the digest of the restored text.

Pieces travel compressed by Zstandard with a dictionary, trained on the beginnings of a bounded
number of texts; it changes only the size of the shuffle. The number of partitions follows the
bytes of all texts. A sort that outgrows a worker's memory spills.

A null text is empty. Empty texts and those that hold a mark are plain. Rows without an id are
cut by the digest of an empty id. Repeated rows (equal id and text) travel under one key; each
gives a row. Rows of equal id and different texts are documents of their own. Very long texts are
many pieces of one key: their digest needs them in order, in one task, but piece by piece. Ties
can't occur, positions are distinct. An empty table gives no row.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator
from itertools import groupby

import zstandard
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from fleetlens.llm.warc_zstd import dictionary

PREFIX, MIDDLE, SUFFIX = "<P>", "<M>", "<S>"
MARKS = (PREFIX, MIDDLE, SUFFIX)
#: The order of sections in an output, and in the text it was made of.
FORMS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
#: Sorts after every section: what is known of a document once its output was read.
END = len(MARKS)


def plan(doc_id, text: str, seed: int = 1, plain: int = 10, spm: int = 20) -> tuple[str, int | None, int | None]:
    """(form, end of the prefix, end of the middle) in code points; ends are None in plain texts.

    ``plain`` percent of the texts stay as they are; of the others ``spm`` percent begin with the suffix.
    """
    drawn = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(drawn[i : i + 8], 16) for i in range(0, 32, 8)]
    if not text or any(mark in text for mark in MARKS) or h[2] % 100 >= 100 - plain:
        return "plain", None, None
    first, last = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    return ("spm" if h[3] % 100 < spm else "psm"), first, last


def output_pieces(text: str, form: str, first: int | None, last: int | None, units: int) -> Iterator[str]:
    """The output in pieces; a mark is the beginning of its section's first piece."""
    spans = [("", 0, len(text))]
    if form != "plain":
        ends = {PREFIX: (0, first), MIDDLE: (first, last), SUFFIX: (last, len(text))}
        spans = [(mark, *ends[mark]) for mark in FORMS[form]]
    for mark, a, b in spans:
        yield mark + text[a : min(b, a + units)]
        for i in range(a + units, b, units):
            yield text[i : min(b, i + units)]


def sections(pieces: Iterator[str], form: str) -> Iterator[tuple[int, int, str]]:
    """(section, position, piece) of an output in order: sections as they are numbered in the text."""
    section = 0
    for position, piece in enumerate(pieces):
        if form != "plain" and piece[:3] in MARKS:
            section, piece = MARKS.index(piece[:3]), piece[3:]
        yield section, position, piece


@functools.cache
def _coder(trained: bytes) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    given = {"dict_data": zstandard.ZstdCompressionDict(trained)} if trained else {}
    return zstandard.ZstdCompressor(level=6, write_checksum=False, write_dict_id=False, **given), zstandard.ZstdDecompressor(**given)


def _packed(text: str, trained: bytes) -> bytes:
    return _coder(trained)[0].compress(text.encode("utf-8", "replace"))


def _unpacked(packed: bytes, trained: bytes) -> str:
    return _coder(trained)[1].decompress(packed).decode("utf-8")


def _home(key: tuple) -> int:
    return int.from_bytes(key[0][:7], "big")


def _sample(docs: DataFrame, rows: int, chars: int) -> bytes:
    """The dictionary, from the beginnings of the first ``rows`` texts."""
    begun = docs.select(F.substring("text", 1, chars).alias("t")).where("t <> ''").limit(rows).collect()
    return dictionary([r["t"].encode("utf-8", "replace") for r in begun], 1 << 17)


class Assembly:
    """The sorted output pieces of a table of documents (id, text)."""

    def __init__(self, docs: DataFrame, units: int, seed: int, plain: int, spm: int, partition_bytes: int) -> None:
        self.spark = docs.sparkSession
        total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.parts = max(self.spark.sparkContext.defaultParallelism, math.ceil(total / partition_bytes))
        self.trained = trained = _sample(docs, 2048, 2048)

        def emit(rows: Iterator) -> Iterator[tuple]:
            for doc_id, text in rows:
                text = text or ""
                form, first, last = plan(doc_id, text, seed, plain, spm)
                key = hashlib.sha256(f"{'' if doc_id is None else doc_id}\0{text}".encode("utf-8", "replace")).digest()[:16]
                middle = None if first is None else last - first
                yield (key, -1), (doc_id, len(text), form, first, middle)
                for position, piece in enumerate(output_pieces(text, form, first, last, units)):
                    yield (key, position), _packed(piece, trained)

        self.pieces: RDD = docs.select("id", "text").rdd.mapPartitions(emit).repartitionAndSortWithinPartitions(self.parts, _home)

    def documents(self) -> RDD:
        """(key, document, number of equal rows, iterator of output pieces); each must be read before the next."""
        trained = self.trained

        def read(pairs: Iterator[tuple]) -> Iterator[tuple]:
            for key, found in groupby(pairs, lambda pair: pair[0][0]):
                # Equal rows have equal pieces; those of one position stand together.
                by_position = groupby(found, lambda pair: pair[0][1])
                _, heads = next(by_position)
                document, copies = next(heads)[1], 1 + sum(1 for _ in heads)
                yield key, document, copies, (_unpacked(next(same)[1], trained) for _, same in by_position)

        return self.pieces.mapPartitions(read)


ROW = [
    StructField("n", LongType()),
    StructField("form", StringType()),
    StructField("prefix_chars", LongType()),
    StructField("middle_chars", LongType()),
]


def _assembly(docs: DataFrame, id_col: str, text_col: str, units: int, seed: int, plain: int, spm: int, partition_bytes: int) -> Assembly:
    return Assembly(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), units, seed, plain, spm, partition_bytes)


def transformed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", units: int = 1 << 16, seed: int = 1,
    plain: int = 10, spm: int = 20, partition_bytes: int = 1 << 25,
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every document: the texts themselves."""
    made = _assembly(docs, id_col, text_col, units, seed, plain, spm, partition_bytes)

    def join(found: Iterator[tuple]) -> Iterator[tuple]:
        for _, document, copies, pieces in found:
            output = "".join(pieces)
            for _ in range(copies):
                yield *document, output

    schema = StructType([StructField(id_col, docs.schema[id_col].dataType), *ROW, StructField("output", StringType())])
    return made.spark.createDataFrame(made.documents().mapPartitions(join), schema)


def digests(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", units: int = 1 << 16, seed: int = 1,
    plain: int = 10, spm: int = 20, partition_bytes: int = 1 << 25,
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of every document."""
    made = _assembly(docs, id_col, text_col, units, seed, plain, spm, partition_bytes)
    trained = made.trained

    def take_apart(found: Iterator[tuple]) -> Iterator[tuple]:
        for key, document, copies, pieces in found:
            whole = hashlib.sha256()

            def read(pieces=pieces, whole=whole) -> Iterator[str]:
                for piece in pieces:
                    whole.update(piece.encode("utf-8", "replace"))
                    yield piece

            for section, position, piece in sections(read(), document[2]):
                yield (key, section, position), _packed(piece, trained)
            yield (key, END, 0), (*document, whole.hexdigest(), copies)

    def restore(pairs: Iterator[tuple]) -> Iterator[tuple]:
        whole = hashlib.sha256()
        for (_, section, _), value in pairs:
            if section < END:
                whole.update(_unpacked(value, trained).encode("utf-8", "replace"))
                continue
            *row, copies = value
            for _ in range(copies):
                yield *row, whole.hexdigest()
            whole = hashlib.sha256()

    schema = StructType(
        [StructField(id_col, docs.schema[id_col].dataType), *ROW, StructField("output_sha256", StringType()), StructField("restored_sha256", StringType())]
    )
    restored = made.documents().mapPartitions(take_apart).repartitionAndSortWithinPartitions(made.parts, _home).mapPartitions(restore)
    return made.spark.createDataFrame(restored, schema)
