"""Packing of token sequences by Karmarkar-Karp multiway differencing.

Documents are cut into pieces of full windows and short remainders. Full pieces fill a window
alone. Remainders are dealt into groups of bounded size, and each group is partitioned into
near-equal windows: every item starts as a partition of its own, and the two partial
partitions with the largest imbalance are merged again and again, the largest window of one
with the smallest of the other. If a window exceeds the capacity, the group is partitioned
anew into more windows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.llm.common import arrow_schema, documents_of, first_row_id, map_batches, ship_library, sized_slices
from prefspark.llm.tokenization import word_coder
from prefspark.storage import durable

CAPACITY = 2048
#: Longest remainder that is packed in one piece; shorter items balance better.
REMAINDER = 512
#: Remainders in a group, on average.
GROUP = 1024

PIECES = T.StructType(
    [
        T.StructField("piece_id", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)
PLACES = "piece_id long, sequence_id long, offset long"


def _differenced(lengths: list[int], windows: int) -> list[tuple[int, object]]:
    """Sums and members of near-equal windows, empty ones left out.

    A partial partition lists its non-empty windows, largest first; ``windows`` minus their
    number are empty. Members are nested pairs of item numbers.
    """
    heap = [(-length, i, [(length, i)]) for i, length in enumerate(lengths)]
    heapq.heapify(heap)
    count = len(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        # Opposite orders: the largest of one meets the smallest, perhaps empty, of the other.
        shared = len(a) + len(b) - windows
        if shared > 0:
            met = [(x[0] + y[0], (x[1], y[1])) for x, y in zip(a[len(a) - shared :], reversed(b[len(b) - shared :]))]
            merged = a[: len(a) - shared] + b[: len(b) - shared] + met
        else:
            merged = a + b
        merged.sort(key=_size, reverse=True)
        spread = merged[0][0] - (merged[-1][0] if len(merged) == windows else 0)
        heapq.heappush(heap, (-spread, count, merged))
        count += 1
    return heap[0][2] if heap else []


def _size(window: tuple[int, object]) -> int:
    return window[0]


def _members(tree: object) -> list[int]:
    found, rest = [], [tree]
    while rest:
        x = rest.pop()
        if isinstance(x, tuple):
            rest.extend(x)
        else:
            found.append(x)
    return sorted(found)


def balanced_windows(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Item numbers of each window; the window count rises until all fit."""
    windows = max(1, -(-sum(lengths) // capacity))
    while True:
        found = _differenced(lengths, windows)
        largest = found[0][0] if found else 0
        if largest <= capacity:
            return [_members(tree) for _, tree in found]
        windows += max(1, windows * (largest - capacity) // (2 * capacity))


def cut_lengths(tokens: int, capacity: int = CAPACITY, remainder: int = REMAINDER) -> list[int]:
    """Full windows, then the rest in the fewest near-equal pieces of at most ``remainder``."""
    full, rest = divmod(tokens, capacity)
    if not rest:
        return [capacity] * full
    parts = -(-rest // remainder)
    small, longer = divmod(rest, parts)
    return [capacity] * full + [small + 1] * longer + [small] * (parts - longer)


def cut_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY, remainder: int = REMAINDER) -> DataFrame:
    """Pieces of all documents with their ids (little-endian uint32), written once.

    A document is its text's ids and ``end_id``; a null or empty text is the end id alone.
    Repeated rows give pieces of their own with equal content; a null ``doc_id`` stays null;
    other columns are not read; an empty table has no pieces.
    """
    end = np.array([end_id], "<u4").tobytes()
    schema = arrow_schema(PIECES)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, piece_id = word_coder(tokenizer), first_row_id()
        for batch in sized_slices(batches, 1):
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), coder.encode_column(batch.column(1))):
                ids += end
                tokens, start = len(ids) // 4, 0
                for length in cut_lengths(tokens, capacity, remainder):
                    own = ids[4 * start : 4 * (start + length)]
                    rows.append((piece_id, doc_id, start, length, tokens, own))
                    piece_id, start = piece_id + 1, start + length
            if rows:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    rows = documents_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return durable(map_batches(rows, cut, PIECES), compression="zstd")


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``piece_id, sequence_id, offset`` of stored pieces.

    Only lengths are shuffled. Groups are dealt by a hash of the piece's number, so they have
    about ``group`` items whatever document, source or length is frequent. Full windows get
    even sequence numbers, shared ones odd numbers.
    """
    lengths = pieces.select("piece_id", "length")
    full = lengths.where(F.col("length") >= capacity).select(
        "piece_id", (F.col("piece_id") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    short = lengths.where(F.col("length") < capacity)
    groups = max(1, round(short.count() / group))

    def pack(key: tuple, items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values("piece_id", ignore_index=True)
        piece_ids, sizes = items["piece_id"].to_numpy(), items["length"].tolist()
        rows = []
        for number, members in enumerate(balanced_windows(sizes, capacity)):
            offset = 0
            for i in members:
                rows.append((piece_ids[i], ((int(key[0]) << 24) + number) * 2 + 1, offset))
                offset += sizes[i]
        return pd.DataFrame(rows, columns=["piece_id", "sequence_id", "offset"])

    ship_library(pieces.sparkSession)
    grouped = short.withColumn("group", F.pmod(F.xxhash64("piece_id"), F.lit(groups).cast("long"))).groupBy("group")
    return full.unionByName(grouped.applyInPandas(pack, PLACES))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: its ids, its document and its place in a sequence.

    Sequences are the groups of equal ``sequence_id``; ``offset`` runs gapless from 0.
    """
    pieces = cut_documents(docs, tokenizer, end_id, capacity)
    return pieces.join(place_pieces(pieces, capacity), "piece_id")
