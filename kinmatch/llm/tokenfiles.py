"""Token files: patched frame-of-reference blocks with an index of block starts.

A file holds whole documents in order. All numbers are little-endian::

    magic "PFOR" | block size u32 | tokens u64 | documents u64 | blocks u64
    document ids i64[documents] | document lengths u64[documents]
    block minimum u32[blocks] | width u8[blocks] | exceptions u16[blocks]
    block start u64[blocks], bytes from the start of the payload
    payload: per block the low ``width`` bits of every value minus the minimum,
             then exception positions u16[] and their high parts u32[]

The width of a block is that of its 90th percentile; larger values are exceptions.
The last block is filled up with its minimum.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import make_folder, per_worker, put_file
from .tokens import SpaceDroppingEncoder

MAGIC = b"PFOR"
BLOCK = 256
PERCENTILE = 0.9
# Tokens after which a file ends with its current document.
FILE_TOKENS = 1 << 21
# Blocks packed or unpacked in one step; bounds the bit matrix.
STEP = 1 << 12


def _bit_length(values: np.ndarray) -> np.ndarray:
    """Bits needed by unsigned integers below 2**32."""
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.uint8)


def _pack(low: np.ndarray, width: int) -> np.ndarray:
    """Rows of values below 2**width as rows of bytes."""
    kind = "<u2" if width <= 16 else "<u4"
    raw = np.ascontiguousarray(low.astype(kind)).view(np.uint8)
    bits = np.unpackbits(raw, axis=1, bitorder="little").reshape(len(low), -1, np.dtype(kind).itemsize * 8)
    return np.packbits(bits[:, :, :width].reshape(len(low), -1), axis=1, bitorder="little")


def _unpack(packed: np.ndarray, width: int, block: int) -> np.ndarray:
    kind = np.dtype("<u2" if width <= 16 else "<u4")
    bits = np.zeros((len(packed), block, kind.itemsize * 8), np.uint8)
    bits[:, :, :width] = np.unpackbits(packed, axis=1, bitorder="little", count=block * width).reshape(-1, block, width)
    return np.packbits(bits.reshape(len(packed), -1), axis=1, bitorder="little").view(kind)


def encode_file(names: list[int], lengths: list[int], ids: np.ndarray, block: int = BLOCK) -> bytes:
    """The bytes of a file that holds documents with these names and lengths and all their token ids."""
    n = -(-len(ids) // block)
    head = [MAGIC, struct.pack("<IQQQ", block, len(ids), len(lengths), n)]
    head += [np.asarray(names, "<i8").tobytes(), np.asarray(lengths, "<u8").tobytes()]
    if not n:
        return b"".join(head)
    values = np.full(n * block, ids[-1], np.uint32)
    values[: len(ids)] = ids
    values = values.reshape(n, block)
    if fill := n * block - len(ids):
        values[-1, block - fill:] = values[-1, : block - fill].min()
    low = values.min(axis=1)
    values = values - low[:, None]
    rank = min(block - 1, int(np.ceil(PERCENTILE * block)) - 1)
    width = _bit_length(np.partition(values, rank, axis=1)[:, rank])
    patched = values >> width[:, None].astype(np.uint32) != 0
    exceptions = patched.sum(axis=1).astype(np.uint16)
    size = (width.astype(np.int64) * block + 7) // 8 + 6 * exceptions.astype(np.int64)
    start = np.cumsum(size) - size
    payload = np.zeros(int(size.sum()), np.uint8)
    for w in np.unique(width):
        if w == 0:
            continue
        of_width = np.flatnonzero(width == w)
        for rows in np.array_split(of_width, -(-len(of_width) // STEP)):
            packed = _pack(values[rows] & np.uint32((1 << int(w)) - 1), int(w))
            payload[start[rows, None] + np.arange(packed.shape[1])] = packed
    row, place = np.nonzero(patched)
    if len(row):
        first = np.cumsum(exceptions, dtype=np.int64) - exceptions
        nth = np.arange(len(row)) - first[row]
        at = start[row] + (width[row].astype(np.int64) * block + 7) // 8
        high = (values[row, place] >> width[row].astype(np.uint32)).astype("<u4")
        payload[(at + 2 * nth)[:, None] + np.arange(2)] = place.astype("<u2").view(np.uint8).reshape(-1, 2)
        after = at + 2 * exceptions[row].astype(np.int64) + 4 * nth
        payload[after[:, None] + np.arange(4)] = high.view(np.uint8).reshape(-1, 4)
    parts = [low.astype("<u4"), width, exceptions.astype("<u2"), start.astype("<u8"), payload]
    return b"".join([*head, *[p.tobytes() for p in parts]])


class TokenFile:
    """Reader of one file's bytes: whole or any range of tokens."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token file")
        self.block, self.tokens, documents, self.blocks = struct.unpack_from("<IQQQ", data, 4)
        at = 32
        found = []
        for kind, count in (("<i8", documents), ("<u8", documents), ("<u4", self.blocks), ("u1", self.blocks), ("<u2", self.blocks), ("<u8", self.blocks)):
            found.append(np.frombuffer(data, kind, count, at))
            at += found[-1].nbytes
        self.names, self.lengths, self.low, self.width, exceptions, start = found
        self.exceptions, self.start = exceptions.astype(np.int64), start.astype(np.int64)
        self.payload = np.frombuffer(data, np.uint8, offset=at)

    def read(self, first: int = 0, count: int | None = None) -> np.ndarray:
        """``count`` tokens from token ``first`` on; only their blocks are unpacked."""
        count = self.tokens - first if count is None else count
        if count <= 0:
            return np.zeros(0, "<u4")
        a, b = first // self.block, (first + count - 1) // self.block + 1
        width, start = self.width[a:b], self.start[a:b]
        out = np.zeros((b - a, self.block), np.uint32)
        for w in np.unique(width):
            if w == 0:
                continue
            of_width = np.flatnonzero(width == w)
            n_bytes = (int(w) * self.block + 7) // 8
            for rows in np.array_split(of_width, -(-len(of_width) // STEP)):
                packed = self.payload[start[rows, None] + np.arange(n_bytes)]
                out[rows] = _unpack(packed, int(w), self.block)
        count_of = self.exceptions[a:b]
        row = np.repeat(np.arange(b - a), count_of)
        if len(row):
            nth = np.arange(len(row)) - np.repeat(np.cumsum(count_of) - count_of, count_of)
            at = start[row] + (width[row].astype(np.int64) * self.block + 7) // 8
            place = self.payload[(at + 2 * nth)[:, None] + np.arange(2)].view("<u2").ravel()
            high = self.payload[(at + 2 * count_of[row] + 4 * nth)[:, None] + np.arange(4)].view("<u4").ravel()
            out[row, place] |= high << width[row].astype(np.uint32)
        out += self.low[a:b, None]
        skip = first - a * self.block
        return out.reshape(-1)[skip: skip + count].astype("<u4", copy=False)


def _id_ranges(docs: DataFrame, id: str, ranges: int) -> list:
    """Ids that cut the documents into about equal ranges; only the id column is read."""
    cuts = docs.select(F.col(id).cast("double").alias("i")).approxQuantile(
        "i", [k / ranges for k in range(1, ranges)], 0.1 / ranges
    ) if ranges > 1 else []
    return sorted(set(cuts))


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, id: str = "doc_id", text: str = "text", end_id: int = 2,
    file_tokens: int = FILE_TOKENS,
) -> None:
    """Tokenize every text, append ``end_id``, and write token files in ascending order of an integer id.

    ``folder`` must be reachable by all executors and by pyarrow. A task writes each of
    its files under a name of its own and lists it in the Parquet table
    ``<folder>/manifest``, which Spark commits: files of lost or repeated attempts are in
    no list and are never read. Documents are cut into ranges of ids, one range lies in
    one partition, and a file never spans two. Ids of the narrowest unsigned width
    travel through the one shuffle.

    A NULL or empty text is its end id alone. NULL ids come first; rows that share an
    id stay apart, ordered by their tokens. An empty table gives an empty list.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id].dataType.simpleString()
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = _id_ranges(docs, id, ranges)
    make_folder(folder)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = per_worker(("words", tokenizer), lambda: SpaceDroppingEncoder(tokenizer))
        narrow = max(words.size, end_id + 1) <= 1 << 16
        kind, lead = ("<u2", b"2") if narrow else ("<u4", b"4")
        end = np.asarray([end_id], kind).tobytes()
        for batch in batches:
            found, counts = words(batch.column(1))
            raw, width = found.astype(kind).tobytes(), np.dtype(kind).itemsize
            ends = width * np.cumsum(counts)
            ids = [lead + raw[a:b] + end for a, b in zip((ends - width * counts).tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["__id", "ids"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size, names, part = None, [], 0, [], 0

        def flush():
            name = f"{uuid.uuid4().hex}.pfor"
            put_file(folder, name, encode_file(names, [len(x) for x in held], np.concatenate(held)))
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int32()), pa.array([part], pa.int32()), pa.array([name]), pa.array([size], pa.int64())],
                names=["range", "part", "file", "n_tokens"],
            )

        for batch in batches:
            for bucket, name, raw in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if held and (bucket != now or size >= file_tokens):
                    yield flush()
                    part, held, size, names = (part + 1 if bucket == now else 0), [], 0, []
                now = bucket
                held.append(np.frombuffer(raw, "<u2" if raw[:1] == b"2" else "<u4", offset=1))
                size += len(held[-1])
                names.append(name or 0)
        if held:
            yield flush()

    bucket = F.lit(0)
    if cuts:
        # the number of cuts up to the id
        bounds = F.array(*[F.lit(float(c)) for c in cuts])
        bucket = F.size(F.filter(bounds, lambda c: c <= F.col("__id").cast("double"))).cast("int")
    bucket = F.when(F.col("__id").isNull(), -1).otherwise(bucket).cast("int")
    encoded = docs.select(F.col(id).alias("__id"), F.col(text).alias("__text")).mapInArrow(
        encode, schema=f"__id {id_type}, ids binary"
    )
    ranged = encoded.select(bucket.alias("range"), "__id", "ids")
    # a partition for each range, that of NULL ids included
    placed = ranged.repartitionById(len(cuts) + 2, F.col("range") + 1)
    ordered = placed.sortWithinPartitions("range", "__id", "ids")
    ordered.mapInArrow(
        write, schema="range int, part int, file string, n_tokens bigint"
    ).write.parquet(f"{folder}/manifest")


def read_tokens(spark: SparkSession, folder: str, id: str = "doc_id") -> DataFrame:
    """Documents of a folder of token files: the id, ``start`` and ``ids``.

    ``start`` is the number of tokens in all documents before; ``ids`` are
    little-endian unsigned 32-bit integers. Files that the manifest does not list are skipped.
    """
    manifest = spark.read.parquet(f"{folder}/manifest")
    # one row per file: few enough to be ordered in one task
    before = W.orderBy("range", "part").rowsBetween(W.unboundedPreceding, -1)
    listed = manifest.select(
        "file", "range", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first")
    )
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pfor").load(folder)
    found = files.select(F.substring_index("path", "/", -1).alias("file"), "content").join(listed, "file")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, of, first in zip(*[batch.column(i) for i in range(3)]):
                data = TokenFile(content.as_buffer())
                tokens, lengths = data.read(), data.lengths.astype(np.int64)
                ends = np.cumsum(lengths)
                starts, raw = ends - lengths, tokens.tobytes()
                unnamed = np.full(len(lengths), of.as_py() == -1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(data.names, pa.int64(), mask=unnamed), pa.array(first.as_py() + starts, pa.int64()),
                     pa.array([raw[4 * a: 4 * b] for a, b in zip(starts.tolist(), ends.tolist())], pa.binary())],
                    names=["__id", "start", "ids"],
                )

    decoded = found.select("content", "range", "first").mapInArrow(decode, schema="__id bigint, start bigint, ids binary")
    return decoded.withColumnRenamed("__id", id)
