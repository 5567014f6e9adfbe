"""Vector codes of one byte per part, from codebooks of Lloyd's rounds over members that stay put.

Every component x becomes ``floor(4096 * x)`` and every vector is cut into equal consecutive parts. Each
part position has its own codebook, which starts as that part of the vectors with the smallest ids.

The members of a codebook entry lie with their owner: rows of parts are dealt by (position, entry,
salt), and the salts of an entry are so many that even one which holds all parts of its position is
spread over owners of about ``RESIDENTS`` rows. A round has two steps, each with tables in the shared
folder at both ends:

1. Owners add up their resident members; the sums of an entry give its new value. The driver sees one
   number per component of a codebook, whatever the number of vectors.
2. Every owner looks for the nearest entry of its members under the new codebook. Members whose entry
   stays are written where they are, without a shuffle. Only those whose entry changes go into the
   shuffle, to the owner of the new entry.

Last, the vectors themselves are coded in one pass, so their parts never have to be brought together.
All arithmetic is on whole numbers and exact, so no result depends on the order of the rows.

Rows are dropped as told in ``integer_vectors``. A component counts as non-finite as well if an error
made of such components might pass 64 bits (beyond 32,768 for 64 dimensions). Copies and repeated rows
count each. A null id is larger than every other; rows with equal ids are ordered by their components.
Null labels are one label. With fewer vectors than entries the codebooks are smaller. A width that the
number of parts does not divide raises ValueError. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.integer_vectors import as_integers, matrix, usual_width, vectors_of
from wattline.session import fresh_dir, remove_dir

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
RESIDENTS = 1024
EXACT = 1 << 53

MEMBERS = pa.schema(
    [("position", pa.int32()), ("entry", pa.int32()), ("salt", pa.int32()), ("part", pa.list_(pa.int32()))]
)
MEMBERS_SQL = "position int, entry int, salt int, part array<int>"
SEEN_SQL = f"{MEMBERS_SQL}, moved boolean"
CODED_SQL = "id long, label string, code string, error long"


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry, the lower of two, and its squared distance; all whole numbers."""
    largest = max(int(np.abs(parts).max(initial=0)), int(np.abs(book).max(initial=0)))
    kind = np.float64 if 4 * parts.shape[1] * largest**2 < EXACT else np.int64
    own, other = parts.astype(kind), book.astype(kind)
    far = (own**2).sum(1)[:, None] - 2 * (own @ other.T) + (other**2).sum(1)[None, :]
    best = far.argmin(1)
    return best, far[np.arange(len(far)), best].astype(np.int64)


def _lists(values: np.ndarray) -> pa.Array:
    ends = np.arange(0, values.size + 1, values.shape[1] if values.size else 1, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32).ravel()))


def _settle(books: np.ndarray):
    """Vectors (x, salt) to the members that their parts become under the first codebooks."""
    positions, _, size = books.shape

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            parts = matrix(batch.column(0), positions * size).reshape(-1, positions, size)
            for p in range(positions):
                entry, _ = nearest(parts[:, p].astype(np.int64), books[p])
                place = np.full(len(parts), p, np.int32)
                yield pa.record_batch(
                    [place, entry.astype(np.int32), batch.column(1), _lists(parts[:, p])], schema=MEMBERS
                )

    return run


def _review(books: np.ndarray):
    """Members with their entry under new codebooks, and whether it is another one."""
    seen = MEMBERS.append(pa.field("moved", pa.bool_()))
    size = books.shape[2]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            position, before = (batch.column(k).to_numpy() for k in (0, 1))
            parts = matrix(batch.column(3), size).astype(np.int64)
            entry = np.zeros(len(parts), np.int32)
            for p in np.unique(position):
                own = position == p
                entry[own] = nearest(parts[own], books[p])[0]
            yield pa.record_batch([batch.column(0), entry, *batch.columns[2:], entry != before], schema=seen)

    return run


def _tally(positions: int, entries: int, size: int):
    """One row per entry that a task's members have: position, entry, members, sum per component."""
    schema = pa.schema(
        [("position", pa.int32()), ("entry", pa.int32()), ("members", pa.int64()), ("sums", pa.list_(pa.int64()))]
    )

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(positions * entries, np.int64)
        total = np.zeros((positions * entries, size), np.int64)
        for batch in source:
            owner = batch.column(0).to_numpy().astype(np.int64) * entries + batch.column(1).to_numpy()
            count += np.bincount(owner, minlength=len(count))
            np.add.at(total, owner, matrix(batch.column(3), size).astype(np.int64))
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_pylist(
            [
                {"position": int(k) // entries, "entry": int(k) % entries, "members": int(count[k]), "sums": total[k]}
                for k in some
            ],
            schema=schema,
        )

    return run


def updated(members: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry as the floor of the mean of its resident members; unused entries stay."""
    tallies = members.mapInArrow(_tally(*books.shape), "position int, entry int, members long, sums array<long>")
    each = tallies.select("position", "entry", "members", F.posexplode("sums").alias("at", "value"))
    found = each.groupBy("position", "entry", "at").agg(
        F.sum(F.col("members").cast("decimal(38,0)")).alias("members"), F.sum(F.col("value").cast("decimal(38,0)")).alias("total")
    )
    books = books.copy()
    for row in found.collect():
        books[row["position"], row["entry"], row["at"]] = int(row["total"]) // int(row["members"])
    return books


def _store(df: DataFrame, label: str, *by: str) -> tuple[DataFrame, str]:
    path = fresh_dir(df.sparkSession, label)
    df.write.partitionBy(*by).parquet(path) if by else df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _arrived(members: DataFrame) -> tuple[DataFrame, str]:
    """The migration: members shuffled to the owner of their entry."""
    return _store(members.select("position", "entry", "salt", "part").repartition("position", "entry", "salt"), "arrived")


def first_books(whole: DataFrame, width: int, parts: int, entries: int) -> np.ndarray:
    """``parts x entries x size`` components of the vectors with the smallest ids."""
    rows = whole.orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).collect()
    return np.array([r["x"] for r in rows], np.int64).reshape(-1, parts, width // parts).transpose(1, 0, 2)


def train(whole: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks after all rounds; ``whole`` has ``id, x``."""
    spark = whole.sparkSession
    books = first_books(whole, width, parts, entries)
    if not books.size:
        return books
    salts = max(1, math.ceil(whole.count() / RESIDENTS))
    salt = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(salts)).cast("int")
    settled = whole.select("x", salt.alias("salt")).mapInArrow(_settle(books), MEMBERS_SQL)
    members, path = _arrived(settled)
    paths = [path]
    for k in range(rounds):
        books = updated(members, books)
        if k + 1 == rounds:
            break
        seen, stayed = _store(members.mapInArrow(_review(books), SEEN_SQL), "seen", "moved")
        arrived, moved = _arrived(seen.where("moved"))
        members = seen.where("not moved").drop("moved").unionByName(arrived)
        for old in paths:
            remove_dir(spark, old)
        paths = [stayed, moved]
    for old in paths:
        remove_dir(spark, old)
    return books


def _coder(books: np.ndarray):
    schema = pa.schema([("id", pa.int64()), ("label", pa.string()), ("code", pa.string()), ("error", pa.int64())])
    positions, _, size = books.shape
    names = np.array([f"{k:02x}" for k in range(256)])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            parts = matrix(batch.column(2), positions * size).reshape(-1, positions, size).astype(np.int64)
            code, error = np.full(len(parts), "", dtype=f"<U{2 * positions}"), np.zeros(len(parts), np.int64)
            for p in range(positions):
                entry, far = nearest(parts[:, p], books[p])
                code = np.char.add(code, names[entry])
                error += far
            yield pa.record_batch([batch.column(0), batch.column(1), code.tolist(), error], schema=schema)

    return run


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components of the codebooks, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(
    vectors: DataFrame, id: str = "vec_id", embedding: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """``id, code, error, label_error, codebooks_sha256`` of every usable row."""
    rows = vectors_of(vectors, embedding, id=id, label=label)
    rows = rows.withColumn("id", F.col("id").cast("long")).withColumn("label", F.col("label").cast("string"))
    width = usual_width(rows)
    if width % parts:
        raise ValueError(f"vectors of {width} components can't be cut into {parts} equal parts")
    if entries > 256:
        raise ValueError("an index has two hex digits: at most 256 entries")
    if not width:
        return rows.sparkSession.createDataFrame([], "id long, code string, error long, label_error long, codebooks_sha256 string")
    bound = math.isqrt((1 << 62) // width) // 2 // SCALE
    whole = as_integers(rows, width, SCALE, 0, float(bound)).select("id", "label", "x")
    books = train(whole.select("id", "x"), width, parts, entries, rounds)
    if not books.size:
        return rows.sparkSession.createDataFrame([], "id long, code string, error long, label_error long, codebooks_sha256 string")
    coded = whole.mapInArrow(_coder(books), CODED_SQL)
    sums = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("sum"))
    # Joined on the label and its hash: the sums are dealt anew, so that AQE may split a frequent label.
    keyed = coded.withColumn("k", F.hash("label")).alias("c")
    each = sums.withColumn("k", F.hash("label")).alias("s")
    same = (F.col("c.k") == F.col("s.k")) & F.col("c.label").eqNullSafe(F.col("s.label"))
    return keyed.join(each, same).select(
        "c.id", "c.code", "c.error", F.col("s.sum").try_cast("long").alias("label_error"), F.lit(digest(books)).alias("codebooks_sha256")
    )
