"""Packing of token sequences by shortest-pack-first over the length histogram.

Krell et al., "Efficient Sequence Packing without Cross-contamination" (2021). A document's ids are
cut into pieces of the full length and one rest. The histogram of piece lengths, one number per
length, is packed on the driver: lengths go longest first into the shortest pack that is open, and
the work is on counts of equal packs, not on packs. Pieces then find their place by their length
and their rank among the pieces of that length.

Ranks need no task that holds all pieces of a length: pieces are dealt into salted groups, ranked
inside, and each group starts after the groups before it. Rows with null or empty text have the end
id alone. Repeated rows and null ids are packed like any others. An empty table gives no pieces.
Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm import tokens
from wattline.llm.tables import picked, stored

LENGTH = 1024
GROUP = 8192
PIECES = pa.schema(
    [(c, pa.int64()) for c in ("id", "start", "length", "ids_crc32", "doc_tokens")] + [("ids", pa.binary())]
)
PIECE_SQL = "id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


def spfhp(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[list[int], int]]:
    """Packing patterns and how often each is used. ``histogram`` has the number of pieces by length."""
    open_packs: dict[int, list[tuple[list[int], int]]] = defaultdict(list)  # by the room left
    for size in sorted((s for s, c in histogram.items() if c), reverse=True):
        left = histogram[size]
        room = length
        while left:
            while room >= size and not open_packs.get(room):
                room -= 1
            if room < size:
                open_packs[length - size].append(([size], left))
                break
            pattern, count = open_packs[room].pop()
            used = min(count, left)
            left -= used
            if count > used:
                open_packs[room].append((pattern, count - used))
            open_packs[room - size].append(([*pattern, size], used))
    return [pack for packs in open_packs.values() for pack in packs]


class Places:
    """Where the piece of a given length and rank goes."""

    def __init__(self, patterns: list[tuple[list[int], int]]):
        slots: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        taken: dict[int, int] = defaultdict(int)
        sequence = 0
        for pattern, count in patterns:
            offset = 0
            for size in pattern:
                slots[size].append((taken[size], sequence, offset))
                taken[size] += count
                offset += size
            sequence += count
        self.slots = {size: np.array(found, np.int64).T for size, found in slots.items()}
        self.sequences = sequence

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for size in np.unique(length).tolist():
            own = np.flatnonzero(length == size)
            first, begin, at = self.slots[size]
            slot = np.searchsorted(first, rank[own], "right") - 1
            sequence[own] = begin[slot] + rank[own] - first[slot]
            offset[own] = at[slot]
        return sequence, offset


def _cutter(path: str, length: int, with_ids: bool):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for low, found in tokens.encoded(batch.column(1), path):
                rows = []
                for doc, ids in zip(batch.column(0).slice(low, len(found)).to_pylist(), found):
                    wide = ids.astype("<u4")
                    for start in range(0, len(ids), length):
                        piece = wide[start : start + length]
                        raw = piece.tobytes()
                        kept = ids[start : start + length].tobytes() if with_ids else None
                        rows.append((doc, start, len(piece), zlib.crc32(raw), len(ids), kept))
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), PIECES)], schema=PIECES)

    return run


def pieces(
    docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None, length: int = LENGTH,
    with_ids: bool = False,
) -> DataFrame:
    """Every document's ids cut at multiples of ``length``, stored; ``ids`` is null unless asked for."""
    rows = picked(docs, id=id, text=text).withColumn("id", F.col("id").cast("long"))
    cutter = _cutter(path or tokens.tokenizer_path(), length, with_ids)
    return stored(rows.mapInArrow(cutter, PIECE_SQL), "pieces")


def ranked(cut: DataFrame, groups: int) -> DataFrame:
    """Add ``rank``, 0 to n - 1 among the pieces of a length."""
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("id", "start", "ids_crc32"), F.lit(groups)))
    counts = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    begin = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    inside = Window.partitionBy("length", "salt").orderBy("id", "start", "ids_crc32")
    placed = salted.withColumn("place", F.row_number().over(inside) - 1)
    return placed.join(begin, ["length", "salt"]).withColumn("rank", F.col("begin") + F.col("place"))


def pack(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """Stored pieces with ``sequence_id`` and ``offset``; the driver sees one count per length."""
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = Places(spfhp(histogram, length))
    rows = ranked(cut, max(16, sum(histogram.values()) // GROUP))

    def place(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            sequence, offset = places.find(
                batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            )
            kept = batch.drop_columns(["rank"])
            yield kept.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    columns = [f.name for f in PIECES]
    return rows.select(*columns, "rank").mapInArrow(place, f"{PIECE_SQL}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed ids of every sequence, and how many; for pieces that carry their ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "id", "start", "length", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("length")).select(
        "sequence_id", "length", F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), "").alias("hex"),
        F.transform("parts", lambda p: F.struct(p["id"].alias("doc_id"), p["start"].alias("start"))).alias("parts"),
    ).withColumn("ids", F.unhex("hex")).drop("hex")
