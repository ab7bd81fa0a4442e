"""Token-id tables in Simple-8b: ids packed into 64-bit words, decoded by vectors.

A word holds a selector in its low 4 bits and 60 bits of values above them. Selector ``s``
means ``COUNTS[s]`` values of ``WIDTHS[s]`` bits each, the first in the lowest bits. Selector
15 is the escape: the next word is one raw value. Ids are coded in blocks of ``BLOCK``; a
block starts on a word, and its first word's index stands in ``block_offsets``, so any block
can be decoded alone. Spare places of a block's last word are zero.

The table is Parquet, so that any file system Spark knows can hold it and a lost executor
costs a retried task only. One row is a segment: whole documents, in order, up to about
``SEGMENT`` ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.llm.common import arrow_schema, documents_of, map_batches, sized_slices, slices
from prefspark.llm.tokenization import word_coder

# The layouts of a word, by selector.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = 15

BLOCK = 128
SEGMENT = 262_144

SEGMENTS = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("segment", T.IntegerType()),
        T.StructField("start_in_part", T.LongType()),
        T.StructField("n_ids", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("lengths", T.ArrayType(T.LongType())),
        T.StructField("block_offsets", T.BinaryType()),
        T.StructField("words", T.BinaryType()),
    ]
)
DIGESTS = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("start_in_part", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words (uint64) and the first word's index of each block (uint32).

    All blocks advance together, a word at a time: the Python loop has at most ``BLOCK``
    steps, whatever the number of values.
    """
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    blocks = -(-n // BLOCK)
    if not blocks:
        return np.empty(0, np.uint64), np.empty(0, np.uint32)
    grid = np.zeros((blocks, BLOCK), np.uint64)
    grid.reshape(-1)[:n] = values
    sizes = np.full(blocks, BLOCK)
    sizes[-1] = n - (blocks - 1) * BLOCK
    choice = _choices(grid)
    steps, width = np.array((*COUNTS, 1, 1)), np.array((*[1] * (len(COUNTS) + 1), 2))
    at, filled, live = np.zeros(blocks, np.int64), np.zeros(blocks, np.int64), np.arange(blocks)
    chosen: list[tuple[np.ndarray, ...]] = []
    while len(live):
        place, used = at[live], filled[live]
        s = choice[place, live]
        chosen.append((live, place, s, used))
        at[live] = place = place + steps[s]
        filled[live] = used + width[s]
        live = live[place < sizes[live]]
    block, place, selector, used = (np.concatenate(x) for x in zip(*chosen))
    offsets = np.cumsum(filled) - filled
    first = offsets[block] + used
    words = np.zeros(int(filled.sum()), np.uint64)
    padded = np.zeros((blocks, BLOCK + max(COUNTS)), np.uint64)
    padded[:, :BLOCK] = grid
    cells, start = padded.reshape(-1), block * padded.shape[1] + place
    for s in np.unique(selector):
        mine = np.flatnonzero(selector == s)
        if s == ESCAPE:
            words[first[mine]] = ESCAPE
            words[first[mine] + 1] = cells[start[mine]]
            continue
        word = np.full(len(mine), s, np.uint64)
        for i in range(COUNTS[s]):
            word |= cells[start[mine] + i] << np.uint64(4 + WIDTHS[s] * i)
        words[first[mine]] = word
    return words, offsets.astype(np.uint32)


#: For values of up to 16 bits: the first width that holds the value.
_NEED = np.searchsorted(1 << np.array(WIDTHS, np.uint64), np.arange(1 << 16, dtype=np.uint64), "right").astype(np.uint8)


def _choices(grid: np.ndarray) -> np.ndarray:
    """The best selector for a word that starts at each place: ``choice[place, block]``.

    A selector fits where the widest of its values fits. The maxima over windows of each
    length come from those of shorter windows, for all places at once.
    """
    places = grid.shape[1]
    values = grid.T
    if grid.max() < len(_NEED):
        own = _NEED[values]
    else:
        own = np.searchsorted(1 << np.array(WIDTHS, np.uint64), values.ravel(), "right").astype(np.uint8).reshape(values.shape)
    need = np.zeros((places + max(COUNTS), grid.shape[0]), np.uint8)  # places after the block are free
    need[:places] = own
    choice = np.full(own.shape, ESCAPE, np.uint8)
    widest, length = need, 1
    for s in range(len(COUNTS) - 1, -1, -1):
        while length < COUNTS[s]:
            step = min(length, COUNTS[s] - length)
            shifted = np.zeros_like(widest)
            shifted[:-step] = widest[step:]
            widest, length = np.maximum(widest, shifted), length + step
        fits = widest[:places] <= s
        if not fits.any():
            break  # still narrower words fit even less
        choice[fits] = s
    return choice


def unpack(words: np.ndarray, block_offsets: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values (uint64) of :func:`pack`, a vector operation per selector."""
    blocks = len(block_offsets)
    if not blocks:
        return np.empty(0, np.uint64)
    selector = (words & np.uint64(15)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    # Only a word after an escape can be raw, and a raw word may look like anything.
    for i in np.flatnonzero(selector == ESCAPE):
        if not raw[i]:
            raw[i + 1] = True
    heads = np.flatnonzero(~raw)
    selector = selector[heads]
    count = np.array((*COUNTS, 1, 1))[selector]
    block = np.searchsorted(block_offsets, heads, "right") - 1
    total = np.cumsum(count)
    first_word = np.searchsorted(block, np.arange(blocks))
    base = np.concatenate(([0], total))[first_word]
    place = total - count - base[block]
    grid = np.zeros((blocks, BLOCK + max(COUNTS)), np.uint64)
    for s in np.unique(selector):
        mine = selector == s
        if s == ESCAPE:
            grid[block[mine], place[mine]] = words[heads[mine] + 1]
            continue
        shifts = (4 + WIDTHS[s] * np.arange(COUNTS[s])).astype(np.uint64)
        cells = (words[heads[mine]][:, None] >> shifts) & np.uint64((1 << WIDTHS[s]) - 1)
        grid[block[mine][:, None], place[mine][:, None] + np.arange(COUNTS[s])] = cells
    return grid[:, :BLOCK].reshape(-1)[:n]


def write_token_table(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Write the ids of all documents, in ascending ``doc_id`` order, as a Simple-8b table.

    Each document is its text's ids and ``end_id``; a null or empty text has the end id only.
    A null ``doc_id`` comes first; rows with equal ids are ordered by text, so repeated rows
    stay beside each other. Other columns are not read. An empty table gives an empty table.
    The texts move once, to range partitions of about equal size.
    """
    end = np.array([end_id], "<u4").tobytes()
    schema = arrow_schema(SEGMENTS)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = word_coder(tokenizer), TaskContext.get().partitionId()
        number, start = 0, 0
        doc_ids: list[int | None] = []
        coded: list[bytes] = []
        size = 0

        def segment() -> pa.RecordBatch:
            values = np.frombuffer(b"".join(coded), "<u4")
            words, offsets = pack(values)
            lengths = [len(c) // 4 for c in coded]
            row = [part, number, start, len(values), doc_ids, lengths, offsets.astype("<u4").tobytes(), words.astype("<u8").tobytes()]
            return pa.record_batch([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in sized_slices(batches, 1):
            for doc_id, ids in zip(batch.column(0).to_pylist(), coder.encode_column(batch.column(1))):
                coded.append(ids + end)
                doc_ids.append(doc_id)
                size += len(coded[-1]) // 4
                if size >= SEGMENT:
                    yield segment()
                    number, start, size = number + 1, start + size, 0
                    doc_ids, coded = [], []
        if doc_ids:
            yield segment()

    rows = documents_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    # A repeated or null doc_id spreads by the start of its text: texts that differ there are
    # ordered by it, equal starts share a part and are sorted in it, so the order stays (doc_id, text).
    ordered = rows.repartitionByRange("doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")
    map_batches(ordered, encode, SEGMENTS).write.option("compression", "uncompressed").parquet(path)


def read_token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Decode a table of :func:`write_token_table`: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before. Only one number per written part is
    summed over the table, and there are no more parts than tasks that wrote.
    """
    schema = arrow_schema(DIGESTS)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4):
            for row in batch.to_pylist():
                offsets = np.frombuffer(row["block_offsets"], "<u4")
                ids = unpack(np.frombuffer(row["words"], "<u8"), offsets, row["n_ids"]).astype("<u4")
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)]
                count = len(crcs)
                yield pa.record_batch(
                    [
                        pa.array([row["part"]] * count, pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts + row["start_in_part"], pa.int64()),
                        pa.array(row["lengths"], pa.int64()),
                        pa.array(crcs, pa.int64()),
                    ],
                    schema=schema,
                )

    segments = spark.read.schema(SEGMENTS).parquet(path)
    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("offset"))
    digests = map_batches(segments, decode, DIGESTS)
    return digests.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("start_in_part") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )
