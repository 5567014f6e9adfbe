"""Token ids on disk in ascending key order, with keyed access through minimal perfect hashes.

A store is a folder of Parquet files. Each row is a shard: a run of documents in key order with

- ``part, seq``: its place; parts and the shards of a part ascend with the keys (null keys first),
- ``before``: ids of the part in front of the shard, ``n_docs``, ``n_ids``, ``first_key``, ``last_key``,
- ``payload``: the raw little-endian ids of all its documents, ``width`` bytes each,
- ``keys``, ``has_key``: the documents' keys as raw 64-bit integers, and which are not null,
- ``index``: a minimal perfect hash of the shard's keys. A key's slot holds a 32-bit fingerprint, the
  number of the key's first document in the shard, how many documents have the key, and the first
  id's place in the payload. ``ends`` has each document's end in the payload.

The hash is built level by level (Limasset et al., "Fast and Scalable Minimal Perfect Hashing",
2017): keys alone in their place on a level stay, the others go on. A look-up reads one bit per
level, the bits of at most 64 bytes behind the last stored count, and one slot; nothing is unpacked
when a shard is opened, so a look-up takes the same time in a shard of any size. A shard is found by
its key range, which Parquet keeps as statistics.

Texts are encoded where they are read, and only ids are shuffled. The limits of the parts come from a
bounded sample of keys and text hashes, weighted by text size. A key that fills several parts is dealt
over them by the hash of the text, and copies of one text by their place, as their order is no matter.

Documents with null or empty text have the end id alone. Repeated keys are kept, one behind the
other. An empty table gives an empty store. Other columns are ignored. A shard holds about
``SHARD_IDS`` ids, or one document. Files are written by Spark's writer, so a lost executor leaves
no half shard.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import tokens
from wattline.llm.tables import picked, share_below, stored
from wattline.llm.words import mix, stream

SHARD_IDS = 1 << 20
LEVELS = 64
RANK_BYTES = 64  # bytes of bits between two stored counts
SAMPLE = 50  # rows per part, for the limits
FEW_SHARDS = 10_000  # shards of a look-up that are named to every task
FEW_PARTS = 1_000
SHARD = pa.schema(
    [("part", pa.int32()), ("seq", pa.int32())]
    + [(c, pa.int64()) for c in ("before", "n_docs", "n_ids", "first_key", "last_key")]
    + [("width", pa.int32())]
    + [(c, pa.binary()) for c in ("keys", "has_key", "ends", "index", "payload")]
)
SHARD_SQL = (
    "part int, seq int, before long, n_docs long, n_ids long, first_key long, last_key long, width int, "
    "keys binary, has_key binary, ends binary, index binary, payload binary"
)
SLOT = np.dtype([("print", "<u4"), ("row", "<u4"), ("rows", "<u4"), ("at", "<u8")])


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys + stream(7, LEVELS)[level]) % np.uint64(size)).astype(np.int64)


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(~keys) >> np.uint64(32)).astype(np.uint32)


_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)
_HEAD = np.array([(0xFF00 >> k) & 0xFF for k in range(8)], np.uint8)  # the first k bits of a byte


class PerfectHash:
    """Distinct 64-bit keys to 0 .. n - 1, about three bits a key."""

    def __init__(self, levels: list[tuple[int, np.ndarray, np.ndarray]]):
        self.levels = levels  # places, bits in whole blocks of RANK_BYTES, bits set in front of each block

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left, base = [], keys, 0
        while len(left):
            if len(levels) == LEVELS:
                raise ValueError("keys are not distinct")
            size = max(8, -(-2 * len(left) // 8) * 8)
            place = _place(left, len(levels), size)
            alone = np.bincount(place, minlength=size) == 1
            bits = np.packbits(np.pad(alone, (0, -size % (8 * RANK_BYTES))))
            ones = _ONES[bits].reshape(-1, RANK_BYTES).sum(1, dtype=np.int64)
            levels.append((size, bits, (base + np.cumsum(ones) - ones).astype("<u4")))
            base += int(ones.sum())
            left = left[~alone[place]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where no level knows it. A foreign key may get any slot."""
        found = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (size, bits, ranks) in enumerate(self.levels):
            if not len(left):
                break
            place = _place(keys[left], level, size)
            byte, bit = place >> 3, place & 7
            hit = (bits[byte] >> (7 - bit).astype(np.uint8)) & 1 == 1
            byte, bit = byte[hit], bit[hit]
            block = byte // RANK_BYTES
            near = bits.reshape(-1, RANK_BYTES)[block]
            before = np.arange(RANK_BYTES)[None, :] < (byte % RANK_BYTES)[:, None]
            ones = (_ONES[near] * before).sum(1, dtype=np.int64) + _ONES[bits[byte] & _HEAD[bit]]
            found[left[hit]] = ranks[block] + ones
            left = left[~hit]
        return found

    def tobytes(self) -> bytes:
        head = np.array([len(self.levels), *(size for size, _, _ in self.levels)], "<u4").tobytes()
        return head + b"".join(bits.tobytes() + ranks.tobytes() for _, bits, ranks in self.levels)

    @classmethod
    def read(cls, raw: bytes) -> tuple[PerfectHash, int]:
        """The hash and the number of bytes it took. Nothing but the sizes of the levels is read."""
        count = int(np.frombuffer(raw, "<u4", 1)[0])
        at, levels = 4 + 4 * count, []
        for size in np.frombuffer(raw, "<u4", count, 4).tolist():
            blocks = -(-size // (8 * RANK_BYTES))
            bits = np.frombuffer(raw, np.uint8, blocks * RANK_BYTES, at)
            levels.append((size, bits, np.frombuffer(raw, "<u4", blocks, at + len(bits))))
            at += len(bits) + 4 * blocks
        return cls(levels), at


def build_index(keys: np.ndarray, begin: np.ndarray) -> bytes:
    """Index of sorted keys, which may repeat; ``begin`` has each document's place in the payload."""
    distinct, row, rows = np.unique(keys, return_index=True, return_counts=True)
    code = distinct.view(np.uint64)
    hashed = PerfectHash.build(code)
    slots = np.zeros(len(distinct), SLOT)
    at = hashed.slots(code)
    slots["print"][at], slots["row"][at], slots["rows"][at] = fingerprint(code), row, rows
    slots["at"][at] = begin[row]
    return hashed.tobytes() + slots.tobytes()


class Shard:
    """One row of a store, as Arrow or dict values."""

    def __init__(self, row: dict):
        self.keys = np.frombuffer(row["keys"], "<i8")
        self.has_key = np.frombuffer(row["has_key"], bool)
        self.ends = np.frombuffer(row["ends"], "<u8").astype(np.int64)
        self.ids = np.frombuffer(row["payload"], f"<u{row['width']}")
        self.hashed, at = PerfectHash.read(row["index"])
        self.slots = np.frombuffer(row["index"], SLOT, -1, at)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First document, number of documents and first id of each key; zero documents if unknown.

        The fingerprint turns away all but one in 2^32 foreign keys; the stored key settles those.
        """
        code = keys.astype(np.int64).view(np.uint64)
        slot = self.hashed.slots(code)
        known = slot >= 0
        if not len(self.slots):
            none = np.zeros(len(keys), np.int64)
            return none, none, none
        entry = self.slots[np.where(known, slot, 0)]
        offset = int(np.searchsorted(self.has_key, True))  # null keys come first
        row = entry["row"].astype(np.int64) + offset
        known &= (entry["print"] == fingerprint(code)) & (self.keys[row] == keys)
        return row, np.where(known, entry["rows"], 0).astype(np.int64), entry["at"].astype(np.int64)

    def document(self, row: int, at: int | None = None) -> np.ndarray:
        begin = at if at is not None else (int(self.ends[row - 1]) if row else 0)
        return self.ids[begin : int(self.ends[row])]


def _shard_row(part: int, seq: int, before: int, keys: list, ids: list[np.ndarray]) -> dict:
    has_key = np.array([k is not None for k in keys], bool)
    solid = np.array([0 if k is None else k for k in keys], "<i8")
    ends = np.cumsum([len(x) for x in ids])
    nulls = int((~has_key).sum())  # they sort first
    known = solid[has_key]
    index = build_index(known, np.concatenate([[0], ends[:-1]])[nulls:])
    payload = np.concatenate(ids)
    return {
        "part": part, "seq": seq, "before": before, "n_docs": len(keys), "n_ids": len(payload),
        "first_key": int(known[0]) if len(known) else None, "last_key": int(known[-1]) if len(known) else None,
        "width": payload.dtype.itemsize, "keys": solid.tobytes(), "has_key": has_key.tobytes(),
        "ends": ends.astype("<u8").tobytes(), "index": index, "payload": payload.tobytes(),
    }


_ENCODED_SQL = "part int, key long, hash long, ids binary"


def _limits(rows: DataFrame, parts: int) -> np.ndarray:
    """Keys and text hashes, in order, at which the parts begin but the first; at most ``parts`` - 1.

    From a sample of about ``SAMPLE`` rows a part, taken by their place in the table and weighted by
    size. A null key is below all others, told by the first column.
    """
    sized = rows.select(
        F.col("key").isNotNull().alias("known"), F.coalesce("key", F.lit(0)).alias("key"), "hash",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("size"), F.monotonically_increasing_id().alias("at"),
    )
    total = rows.select("key").count()
    chosen = F.pmod(F.xxhash64("at"), F.lit(1 << 32)) < share_below(SAMPLE * parts, total)
    found = sized.where(chosen).select("known", "key", "hash", "size").toArrow()
    table = np.rec.fromarrays([found.column(c).to_numpy().astype(np.int64) for c in range(4)], names="known,key,hash,size")
    table.sort(order=["known", "key", "hash"])
    through = np.cumsum(table["size"])
    if not len(table):
        return table[["known", "key", "hash"]]
    at = np.searchsorted(through, through[-1] * np.arange(1, parts) / parts)
    return table[["known", "key", "hash"]][np.minimum(at, len(table) - 1)]


def _encoder(path: str, limits: np.ndarray):
    """(key, hash, text) to (part, key, hash, ids)."""
    schema = pa.schema([("part", pa.int32()), ("key", pa.int64()), ("hash", pa.int64()), ("ids", pa.binary())])
    kind = limits.dtype

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in source:
            for low, found in tokens.encoded(batch.column(2), path):
                part = batch.slice(low, len(found))
                own = np.zeros(len(found), kind)
                own["known"] = part.column(0).is_valid().to_numpy(zero_copy_only=False)
                own["key"] = part.column(0).fill_null(0).to_numpy()
                own["hash"] = part.column(1).to_numpy()
                first, last = (np.searchsorted(limits, own, side) for side in ("left", "right"))
                # A row that is itself the limit of several parts may go to any of them.
                place = first + (seen + np.arange(len(own))) % (last - first + 1)
                place = np.where(first < last, place, last)
                seen += len(own)
                ids = pa.array([x.tobytes() for x in found], pa.binary())
                yield pa.record_batch([place.astype(np.int32), part.column(0), part.column(1), ids], schema=schema)

    return run


def _writer(width: int, shard_ids: int):
    """(part, key, hash, ids) in order to shards."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list = []
        held: list[np.ndarray] = []
        part, size, seq, before = -1, 0, 0, 0

        def flush() -> pa.RecordBatch:
            row = _shard_row(part, seq, before, keys, held)
            return pa.RecordBatch.from_pylist([row], schema=SHARD)

        for batch in source:
            for own, key, raw in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3))):
                ids = np.frombuffer(raw, f"<u{width}")
                if held and (own != part or size + len(ids) > shard_ids):
                    yield flush()
                    seq, before, keys, held, size = seq + 1, before + size, [], [], 0
                if own != part:
                    part, seq, before = own, 0, 0
                keys.append(key)
                held.append(ids)
                size += len(ids)
        if held:
            yield flush()

    return run


def write(
    docs: DataFrame, out: str, id: str = "doc_id", text: str = "text", path: str | None = None,
    shard_ids: int = SHARD_IDS, parts: int | None = None,
) -> None:
    """Encode whole texts and write them in ascending order of the key, then of the text's hash.

    There are as many ``parts`` as the session has shuffle partitions, if not told otherwise.
    """
    rows = picked(docs, key=id, text=text).withColumn("key", F.col("key").cast("long"))
    rows = rows.select("key", F.xxhash64("text").alias("hash"), "text")
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    path = path or tokens.tokenizer_path()
    coded = rows.mapInArrow(_encoder(path, _limits(rows, parts)), _ENCODED_SQL)
    dealt = coded.repartitionById(parts, F.col("part"))
    ordered = dealt.sortWithinPartitions("part", F.col("key").asc_nulls_first(), "hash")
    shards = ordered.mapInArrow(_writer(tokens.id_width(path), shard_ids), SHARD_SQL)
    shards.write.option("compression", "zstd").parquet(out)


def shards(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(SHARD_SQL).parquet(out)


def part_starts(spark: SparkSession, out: str) -> dict[int, int]:
    """Ids in front of each part; one number per written part comes to the driver."""
    found = shards(spark, out).groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    starts, total = {}, 0
    for row in found:
        starts[row["part"]] = total
        total += row["n"]
    return starts


DIGESTS = pa.schema([(c, pa.int64()) for c in ("key", "start", "n_tokens", "ids_crc32")])


def digests(spark: SparkSession, out: str) -> DataFrame:
    """``key, start, n_tokens, ids_crc32`` of every document, each fetched by its key."""
    starts = part_starts(spark, out)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for row in batch.to_pylist():
                shard = Shard(row)
                first, _, at = shard.find(shard.keys)
                base = starts[row["part"]] + row["before"]
                rows = []
                for i, key in enumerate(shard.keys.tolist()):
                    # The key leads to its first document; repeated ones follow, null keys are read in order.
                    keyed = shard.has_key[i] and first[i] == i
                    begin = int(at[i]) if keyed else int(shard.ends[i - 1]) if i else 0
                    ids = shard.document(i, begin).astype("<u4")
                    rows.append((key if shard.has_key[i] else None, base + begin, len(ids), zlib.crc32(ids.tobytes())))
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows)], schema=DIGESTS)

    return shards(spark, out).mapInArrow(run, "key long, start long, n_tokens long, ids_crc32 long")


def _asked(spark: SparkSession, out: str, keys: DataFrame) -> DataFrame:
    """``part, seq, wanted`` for the shards whose key range holds any of ``key``."""
    places = shards(spark, out).where("last_key IS NOT NULL").select("part", "seq", "first_key", "last_key")
    ranges = places.groupBy("part").agg(F.min("first_key").alias("low"), F.max("last_key").alias("high"))
    # One row per written part comes to the driver, as in part_starts.
    known = sorted(map(tuple, ranges.collect()), key=lambda r: r[1:])
    part, low, high = (np.array([r[k] for r in known], np.int64) for k in range(3))
    schema = pa.schema([("part", pa.int32()), ("key", pa.int64())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            own = batch.column(0).to_numpy()
            first, behind = np.searchsorted(high, own), np.searchsorted(low, own, "right")
            count = np.maximum(behind - first, 0)
            at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
            yield pa.record_batch([part[at].astype(np.int32), np.repeat(own, count)], schema=schema)

    dealt = keys.mapInArrow(run, "part int, key long")
    inside = dealt.join(places, "part").where("key BETWEEN first_key AND last_key")
    return inside.groupBy("part", "seq").agg(F.sort_array(F.collect_list("key")).alias("wanted"))


def fetch(spark: SparkSession, out: str, keys: DataFrame | Sequence[int]) -> DataFrame:
    """``key, ids`` of the documents with one of the keys, the first column; unknown keys give no row.

    The keys are brought to the shards whose range holds them, and only these are opened. If they are
    few, the shards stay where they are, and files of other parts are skipped by their statistics.
    """
    if not isinstance(keys, DataFrame):
        keys = spark.createDataFrame([(int(k),) for k in keys], "key long")
    wanted = keys.select(F.col(f"`{keys.columns[0]}`").cast("long").alias("key")).dropna().distinct()
    asked = stored(_asked(spark, out, wanted), "asked")
    rows = shards(spark, out)
    if asked.count() <= FEW_SHARDS:
        named = [r["part"] for r in asked.select("part").distinct().limit(FEW_PARTS + 1).collect()]
        if len(named) <= FEW_PARTS:
            rows = rows.where(F.col("part").isin(named))
        asked = F.broadcast(asked)
    columns = ["has_key", "keys", "ends", "index", "payload", "width", "wanted"]
    opened = rows.join(asked, ["part", "seq"]).select(*columns)
    schema = pa.schema([("key", pa.int64()), ("ids", pa.list_(pa.int64()))])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for row in batch.to_pylist():
                shard, own = Shard(row), np.array(row["wanted"], np.int64)
                first, count, _ = shard.find(own)
                rows = [
                    {"key": key, "ids": shard.document(i).tolist()}
                    for key, f, n in zip(own.tolist(), first.tolist(), count.tolist())
                    for i in range(f, f + n)
                ]
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return opened.mapInArrow(run, "key long, ids array<long>")
