"""Token ids as length-delimited binary records, with a separate offset index.

One record per document, in ascending doc_id order over files and inside them:

    length   u64 LE   bytes of the payload
    check    u32 LE   masked CRC-32 of the 8 length bytes
    payload  flags u8 (1: doc_id is null, 2: ids are 4 bytes wide), doc_id i64 LE,
             then the ids, u16 or u32 LE
    check    u32 LE   masked CRC-32 of the payload
    0x0A     end of the record

The mask is the usual rotation by 15 bits plus a constant, so that a checksum stored in
checked data does not disturb it.  Records are written by Spark's own file writer (its
commit protocol keeps a lost executor from leaving half a file), ``records_per_file``
at most in one file, so that one file is one bounded read.

Defined cases: a null text is empty and gives the end id alone; rows with null doc_id
come first; rows that share a doc_id keep one record each, ordered by text; an empty table
writes no record; other columns are not read.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from strata.session import scratch_path

from ._common import free_name, shuffle_partitions, text_slices, write_table
from ._pieces import PieceTable



def masked_crc(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    n = len(payload).to_bytes(8, "little")
    return b"".join((n, masked_crc(n).to_bytes(4, "little"), payload, masked_crc(payload).to_bytes(4, "little"), b"\n"))


def frames(data: memoryview) -> Iterator[tuple[int, memoryview]]:
    """(offset, payload) of each record of a file; raises on a wrong checksum or a cut file."""
    at = 0
    while at < len(data):
        head = bytes(data[at:at + 8])
        n = int.from_bytes(head, "little")
        if masked_crc(head) != int.from_bytes(data[at + 8:at + 12], "little"):
            raise ValueError(f"wrong length checksum at byte {at}")
        body = data[at + 12:at + 12 + n]
        if len(body) != n or masked_crc(body) != int.from_bytes(data[at + 12 + n:at + 16 + n], "little"):
            raise ValueError(f"wrong payload checksum at byte {at}")
        yield at, body
        at += n + 17


class Encoder:
    """Byte-level BPE ids of whole texts by the tokenizers library.

    Its pre-tokenizer always cuts before a single space, around a single line break, and
    between a letter and an ASCII mark other than the apostrophe.  A text is cut there and
    each distinct piece is encoded once; new pieces go to the library as lines of one string.
    Texts with other white space, or runs of it, and texts that hold the string of an added
    token go to the library whole.  ``added_tokens``: such a string gets the token's id, as the
    library's plain call has it; otherwise those of special tokens are ordinary text.
    """

    PLAIN = re.compile(r"\S+(?:[ \n]\S+)*", re.UNICODE)

    def __init__(self, path: str, added_tokens: bool = False):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added_tokens
        added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.kind = "<u4" if self.wide else "<u2"
        line = self._whole("\n")
        self.cut = line[0]
        parts = ["ab", ",", " cd", "!?", "\n", "ß", ".", " é", "%"]
        self.cuts = len(line) == 1 and np.array_equal(self._whole("".join(parts)), np.concatenate([self._whole(x) for x in parts]))
        self.table = PieceTable(self._pieces, self.kind)
        ascii_letter, mark = np.zeros(256, bool), np.zeros(256, bool)
        ascii_letter[[*range(65, 91), *range(97, 123)]] = True
        mark[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'"]] = True
        self.letter, self.mark = ascii_letter, mark

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)

    def _pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        out: list = [None] * len(pieces)
        lone = [i for i, x in enumerate(pieces) if x == b"\n"]
        for i in lone:
            out[i] = np.array([self.cut], self.kind)
        rest = [i for i in range(len(pieces)) if out[i] is None]
        for k in range(0, len(rest), 2048):
            some = rest[k:k + 2048]
            ids = self._whole(b"\n".join([pieces[i] for i in some]).decode())
            ends = np.flatnonzero(ids == self.cut).tolist()
            for i, a, b in zip(some, [0, *[e + 1 for e in ends]], [*ends, len(ids)]):
                out[i] = ids[a:b]
        return out

    def _starts(self, data: np.ndarray) -> np.ndarray:
        """Where the pieces of joined plain texts begin."""
        cut = (data == 32) | (data == 10)
        cut[1:] |= data[:-1] == 10
        latin = np.zeros(len(data), bool)  # last byte of a letter U+00C0..U+00FF
        latin[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        cut[1:] |= self.mark[data[1:]] & (self.letter[data[:-1]] | latin[:-1])
        if len(cut):
            cut[0] = True
        return np.flatnonzero(cut)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        out: list = [None] * len(texts)
        plain = []
        for i, t in enumerate(texts):
            if self.cuts and self.PLAIN.fullmatch(t) and not (self.added and self.added.search(t)):
                plain.append(i)
            else:
                out[i] = self._whole(t)
        if plain:
            # joined by line breaks, whose ids are left out again
            raw = [texts[i].encode() for i in plain]
            data = np.frombuffer(b"\n".join(raw), np.uint8)
            start = self._starts(data)
            ids, count = self.table.ids(data, start)
            begin = np.cumsum([0, *[len(r) + 1 for r in raw]])
            piece = np.searchsorted(start, begin[:-1])
            at = np.append(0, np.cumsum(count))
            for k, i in enumerate(plain):
                last = piece[k + 1] - 1 if k + 1 < len(plain) else len(start)
                out[i] = ids[at[piece[k]]:at[last]]
        return out


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def _encoder(path: str, added_tokens: bool) -> Encoder:
    if (path, added_tokens) not in _ENCODERS:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has one task a core already
        _ENCODERS[path, added_tokens] = Encoder(path, added_tokens)
    return _ENCODERS[path, added_tokens]


def write_records(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, records_per_file: int = 8192,
                  added_tokens: bool = True) -> None:
    """Encode every text and write the record files below ``path``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(tokenizer, added_tokens)
        end = np.array([end_id], enc.kind).tobytes()
        for batch in batches:
            ids = batch.column(0)
            for a, b, _, _ in text_slices(batch.column(1)):
                texts = [x or "" for x in batch.column(1).slice(a, b - a).to_pylist()]
                out = [frame(struct.pack("<Bq", (doc is None) + 2 * enc.wide, doc or 0) + packed.tobytes() + end)[:-1]  # the writer ends the record
                       for doc, packed in zip(ids.slice(a, b - a).to_pylist(), enc.encode(texts))]
                yield pa.record_batch([pa.array(out, pa.binary())], ["value"])
        enc.table.clear()

    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
     .repartitionByRange(shuffle_partitions(docs.sparkSession), F.col("doc_id").asc_nulls_first())
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
     .mapInArrow(encode, "value binary")
     .select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", "\n").option("compression", "none").option("maxRecordsPerFile", records_per_file).text(path))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the files below ``path``, checksums verified: file, offset, length (whole
    record), doc_id, n_tokens, ids_crc32 (of the ids as u32 LE), before (ids ahead of it in the file)."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, before = [], 0
                for at, body in frames(memoryview(content.as_buffer())):
                    flags, doc = struct.unpack_from("<Bq", body)
                    ids = np.frombuffer(body, "<u4" if flags & 2 else "<u2", offset=9)
                    rows.append((name, at, len(body) + 17, None if flags & 1 else doc, len(ids),
                                 zlib.crc32(ids.astype("<u4").tobytes()), before))
                    before += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.string()), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(1, 7))],
                    ["file", "offset", "length", "doc_id", "n_tokens", "ids_crc32", "before"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return (files.filter("length > 0").select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
            .mapInArrow(parse, "file string, offset long, length long, doc_id long, n_tokens long, ids_crc32 long, before long"))


def write_index(spark: SparkSession, path: str, index_path: str) -> DataFrame:
    """The offset index of the record files, written as Parquet next to them: for each record its
    file, offset and length (one ranged read), and ``start``, the ids of all documents before it."""
    found = write_table(read_records(spark, path), "records-read")
    # One row per file: the only rows that one task orders.
    files = found.groupBy("file").agg(F.sum("n_tokens").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    order = Window.orderBy(F.col("low").asc_nulls_first(), F.col("high").asc_nulls_first(), "file").rowsBetween(Window.unboundedPreceding, 0)
    starts = files.select("file", (F.sum("n").over(order) - F.col("n")).alias("base"))
    (found.join(starts, "file").withColumn("start", F.col("base") + F.col("before")).drop("base", "before")
     .write.parquet(index_path))
    return spark.read.parquet(index_path)


def read_at(path: str, wanted: DataFrame) -> DataFrame:
    """The records that ``wanted`` names by the index's columns file, offset and length, with their token
    ids in a column ``ids`` (``_ids`` where that name is taken): one ranged read a record, in the order
    of the rows, so an index in shuffled order is a shuffled read of the corpus.

    ``path`` is the folder of the record files, on a file system that pyarrow opens.  Checksums are
    verified.  A row that is named twice is read twice; one without a file has null ids; other columns
    pass through.
    """
    name = free_name("ids", wanted.columns)
    out = StructType([*wanted.schema.fields, StructField(name, ArrayType(IntegerType()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(path)
        for whole in batches:
            for a in range(0, len(whole), 256):     # the ids of so many records are held at once
                batch, found = whole.slice(a, 256), []
                for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                    if file is None:
                        found.append(None)
                        continue
                    with system.open_input_file(f"{root}/{file}") as source:
                        _, body = next(frames(memoryview(source.read_at(length, offset))))
                    found.append(np.frombuffer(body, "<u4" if body[0] & 2 else "<u2", offset=9).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int32()))], [*batch.schema.names, name])

    return wanted.mapInArrow(read, out)


def encode_corpus(docs: DataFrame, tokenizer: str, end_id: int = 2, path: str | None = None,
                  added_tokens: bool = True) -> DataFrame:
    """Write record files and index below ``path`` (by default a fresh shared folder); returns the index."""
    spark = docs.sparkSession
    path = path or f"{scratch_path(spark, 'llm')}/records-{uuid.uuid4().hex[:12]}"
    write_records(docs, f"{path}/records", tokenizer, end_id, added_tokens=added_tokens)
    return write_index(spark, f"{path}/records", f"{path}/index")
