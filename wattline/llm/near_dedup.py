"""Near duplicates by SetSketch registers, bands, joint likelihood and exact shingle sets.

Ertl, "SetSketch: Filling the Gap between MinHash and HyperLogLog" (2021). A register holds the
truncated logarithm, to a base near 1, of the least exponential variate over a document's shingles.
Registers of a union are the maxima of the registers, and two sets agree in a register with a
probability that grows with their similarity.

1. One pass over the texts: set size, 128-bit digest and registers of each document.
2. Documents with equal sets become one class. What follows sees classes, not copies.
3. Classes that share a band of registers are dealt into blocks. Inside a block the joint likelihood
   of all registers keeps the pairs that may reach the threshold; every class comes out with the first
   one that it is connected with. Then every two blocks meet in a cell, where only classes that are not
   yet connected are compared. Components of these links are groups: sets that can be linked lie in one
   group.
4. Groups are dealt into blocks in the same way, with their full sets. Pairs not yet connected are
   confirmed by exact intersection, first inside the blocks, then across them. The components of these
   links are the result.

No cell holds more than two blocks, whatever the size of a bucket or group. No pair is dropped for
being one of many. A group of g classes gives about g links and one for each two of its blocks, as a
block that is connected needs no more than one link to another. Its classes still meet all its blocks,
which copies g * g / BLOCK rows in a single group of g distinct near copies.

Rows with null or empty text have size 0 and are linked with nothing. Repeated rows are copies of
each other. A null id takes part in links, and a component whose ids are all null has no id. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm import words as W
from wattline.llm.cells import Forest, cross_cells, in_blocks, per_cell, small_pairs, with_blocks
from wattline.llm.components import components
from wattline.llm.tables import picked, quoted, stored

NO_ID = (1 << 63) - 1
BLOCK = 128  # classes with their sets
BUCKET_BLOCK = 512  # classes with their registers


@dataclass(frozen=True)
class Setting:
    """Words per shingle, threshold in percent, registers and bands.

    A pair at the threshold misses all bands with a probability below ``miss``; the rows per band
    follow from it.
    """

    words: int = 3
    percent: int = 85
    registers: int = 120
    base: float = 1.05
    rate: float = 20.0
    miss: float = 1e-4

    @property
    def threshold(self) -> float:
        return self.percent / 100

    @property
    def rows(self) -> int:
        fitting = [
            r
            for r in range(1, self.registers + 1)
            if self.registers % r == 0 and (1 - self.threshold**r) ** (self.registers // r) < self.miss
        ]
        return max(fitting, default=1)

    @property
    def bands(self) -> int:
        return self.registers // self.rows


def registers_of(shingles: np.ndarray, setting: Setting) -> np.ndarray:
    """Registers of one set of 64-bit hashes; the empty set has all zero."""
    if not len(shingles):
        return np.zeros(setting.registers, np.uint16)
    factors = (W.stream(5, setting.registers) | np.uint64(1)).astype(np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(setting.registers, np.iinfo(np.uint32).max, np.uint32)
    for low in range(0, len(short), 4096):
        np.minimum(least, (short[low : low + 4096, None] * factors).min(0), out=least)
    # The least of uniform numbers gives the least of exponential variates.
    variate = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**32) / setting.rate
    value = np.floor(1 - np.log(variate) / math.log(setting.base))
    return np.clip(value, 0, 65535).astype(np.uint16)


def _order_probability(x: np.ndarray, base: float) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0, 1) * (base - 1) / base) / math.log(base)


def log_likelihood(above, below, equal, sizes_a, sizes_b, similarity, base: float) -> np.ndarray:
    """Log likelihood of a similarity, given in how many registers the first set is above, below or equal."""
    total = sizes_a + sizes_b
    more = _order_probability((sizes_a - sizes_b * similarity) / total, base)
    less = _order_probability((sizes_b - sizes_a * similarity) / total, base)
    tiny = 1e-9
    return (
        above * np.log(np.maximum(more, tiny))
        + below * np.log(np.maximum(less, tiny))
        + equal * np.log(np.maximum(1 - more - less, tiny))
    )


def estimate(a: np.ndarray, b: np.ndarray, sizes_a, sizes_b, base: float) -> np.ndarray:
    """Most likely similarity of pairs of sets from their registers and sizes, on a grid of 1/100."""
    above, below = (a > b).sum(-1), (a < b).sum(-1)
    equal = a.shape[-1] - above - below
    grid = np.linspace(0, 1, 101)[:, None] * np.minimum(sizes_a / sizes_b, sizes_b / sizes_a)[None, :]
    return np.take_along_axis(
        grid, log_likelihood(above, below, equal, sizes_a, sizes_b, grid, base).argmax(0)[None, :], 0
    )[0]


def plausible(a: np.ndarray, b: np.ndarray, sizes_a, sizes_b, setting: Setting, deviations: float = 5.0):
    """Whether the threshold or more is within ``deviations`` of the most likely similarity."""
    above, below = (a > b).sum(-1), (a < b).sum(-1)
    equal = a.shape[-1] - above - below
    most = np.minimum(sizes_a / sizes_b, sizes_b / sizes_a)
    step = np.linspace(0, 1, 13)[:, None]

    def best(similarity: np.ndarray) -> np.ndarray:
        return log_likelihood(above, below, equal, sizes_a, sizes_b, similarity, setting.base).max(0, initial=-np.inf)

    inside = np.clip(setting.threshold + step * (most - setting.threshold), 0, 1)
    reachable = most >= setting.threshold - 1e-12
    return reachable & (best(inside) >= best(step * most) - deviations**2 / 2)


SKETCH = pa.schema(
    [
        ("id", pa.int64()),
        ("key", pa.int64()),
        ("hash", pa.int64()),
        ("n", pa.int64()),
        ("c1", pa.int64()),
        ("c2", pa.int64()),
        ("regs", pa.binary()),
    ]
)
LINKS = pa.schema(
    [(f"{side}_{part}", pa.int64()) for side in "ab" for part in ("lo", "c1", "c2")]
)


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums over the set, each of differently mixed hashes."""
    sums = np.stack(
        [W.mix(shingles + W.GAMMA).sum(dtype=np.uint64), W.mix(shingles ^ W.GAMMA).sum(dtype=np.uint64)]
    )
    return tuple(W.mix(sums).view(np.int64).tolist())


def sketcher(setting: Setting):
    """Arrow batches of (id, key, hash, text) to (id, key, hash, n, digest, registers)."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for low, high in W.batches(batch.column(3)):
                part = batch.slice(low, high - low)
                sizes, digests, regs = [], [], []
                for found in W.shingle_sets(part.column(3), setting.words):
                    sizes.append(len(found))
                    digests.append(_digest(found))
                    regs.append(registers_of(found, setting).tobytes() if len(found) else None)
                c1, c2 = zip(*digests)
                yield pa.record_batch(
                    [*part.columns[:3], sizes, list(c1), list(c2), pa.array(regs, pa.binary())],
                    schema=SKETCH,
                )

    return run


def _documents(docs: DataFrame, id: str, text: str) -> DataFrame:
    """Id, a key to find the row again by, the text and its hash."""
    rows = picked(docs, id=id, text=text).withColumn("id", F.col("id").cast("long"))
    code = F.xxhash64("text")
    return rows.select("id", F.coalesce(F.col("id"), code).alias("key"), code.alias("hash"), "text")


def sketches(docs: DataFrame, setting: Setting, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with set size, digest and registers, stored."""
    schema = "id long, key long, hash long, n long, c1 long, c2 long, regs binary"
    return stored(_documents(docs, id, text).mapInArrow(sketcher(setting), schema), "sketches")


def classes(sketched: DataFrame) -> DataFrame:
    """One row per distinct set: the smallest id that has it, and where to find its text."""
    found = (
        sketched.where("n > 0")
        .groupBy("c1", "c2")
        .agg(
            F.min("id").alias("lo"),
            F.min_by("key", F.struct(F.coalesce("id", F.lit(NO_ID)), "key")).alias("key"),
            F.first("n").alias("n"),
            F.first("regs").alias("regs"),
        )
        .withColumn("lo", F.coalesce("lo", F.lit(NO_ID)))
    )
    return stored(found, "classes")


def _linked(nodes: np.ndarray, pairs: list[tuple[int, int]]) -> pa.Table:
    a, b = (nodes[[p[side] for p in pairs]].reshape(-1, 3) for side in (0, 1))
    return pa.Table.from_arrays([pa.array(x[:, k]) for x in (a, b) for k in range(3)], schema=LINKS)


def _nodes(table: pa.Table) -> np.ndarray:
    return np.stack([table.column(c).to_numpy() for c in ("lo", "c1", "c2")], 1)


def _least_equal(small: np.ndarray, large: np.ndarray, setting: Setting, deviations: float = 5.0) -> np.ndarray:
    """Fewest equal registers that two sets of these sizes at the threshold show, all but surely."""
    total = small + large
    more = _order_probability((large - small * setting.threshold) / total, setting.base)
    less = _order_probability((small - large * setting.threshold) / total, setting.base)
    equal = np.clip(1 - more - less, 0, 1)
    m = setting.registers
    return m * equal - deviations * np.sqrt(m * equal * (1 - equal))


def _may_link(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, setting: Setting) -> np.ndarray:
    """Pairs of rows whose sizes allow the threshold."""
    small, large = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
    return 100 * small >= setting.percent * large


def _walk(limits: np.ndarray, most: int, forest: Forest, compare) -> list[tuple[int, int]]:
    """Links that span what is connected in every group. ``compare(a, b)`` picks the links among pairs.

    A link joins the first rows of two connected parts, so that another bucket with the same rows gives
    the same links. Small groups are compared all at once. In a larger one each row in turn is compared with the
    rows behind it that it isn't connected with yet.
    """
    kept = []

    def keep(a: np.ndarray, b: np.ndarray) -> None:
        for pair in zip(a.tolist(), b.tolist()):
            firsts = forest.root(pair[0]), forest.root(pair[1])
            if forest.join(*pair):
                kept.append(firsts)

    left, right = small_pairs(limits, most)
    for low in range(0, len(left), 16384):
        keep(*compare(left[low : low + 16384], right[low : low + 16384]))
    for low, high in zip(limits[:-1].tolist(), limits[1:].tolist()):
        if high - low <= most:
            continue
        for i in range(low, high - 1):
            others = forest.apart(i, np.arange(i + 1, high))
            if len(others):
                keep(*compare(np.full(len(others), i), others))
    return kept


def _bucket_compare(table: pa.Table, setting: Setting, forest: Forest):
    """Picks the pairs that may be similar enough, going by all their registers."""
    sizes = table.column("n").to_numpy().astype(float)
    regs = np.frombuffer(b"".join(table.column("regs").to_pylist()), np.uint16).reshape(len(sizes), -1)

    def compare(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        fit = _may_link(a, b, sizes, setting)
        a, b = a[fit], b[fit]
        agree = (regs[a] == regs[b]).sum(1)
        fit = agree >= _least_equal(np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b]), setting)
        a, b = a[fit], b[fit]
        if not len(a):
            return a, b
        fit = plausible(regs[a], regs[b], sizes[a], sizes[b], setting)
        return a[fit], b[fit]

    return compare


def _set_compare(table: pa.Table, setting: Setting, forest: Forest):
    """Picks the pairs whose full sets are similar enough, but for those connected already."""
    sets = [np.frombuffer(x, np.uint64) for x in table.column("members").to_pylist()]
    sizes = np.array([len(s) for s in sets])
    regs = np.stack([registers_of(s, setting) for s in sets])

    def compare(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        fit = _may_link(a, b, sizes, setting)
        a, b = a[fit], b[fit]
        agree = (regs[a] == regs[b]).sum(1)
        fit = agree >= _least_equal(np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b]), setting)
        a, b, agree = a[fit], b[fit], agree[fit]
        links = []
        for k in np.argsort(-agree, kind="stable").tolist():
            x, y = int(a[k]), int(b[k])
            if forest.root(x) == forest.root(y):
                continue
            both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if 100 * both >= setting.percent * (len(sets[x]) + len(sets[y]) - both):
                links.append((x, y))
        found = np.array(links, int).reshape(-1, 2)
        return found[:, 0], found[:, 1]

    return compare


def _inside(comparer, setting: Setting, most: int, payload: str):
    """Compare the rows of each block: out come the rows with the first row that they are connected with.

    Only rows that are not their own, and those of groups of several blocks, come out; the others have
    nothing to tell. What the cells across blocks need stays in ``payload``, else null.
    """

    def run(table: pa.Table, limits: np.ndarray) -> pa.Table:
        forest = Forest(table.num_rows)
        _walk(limits, most, forest, comparer(table, setting, forest))
        roots = forest.roots()
        several = table.column("blocks").to_numpy() > 1
        rows = np.flatnonzero(several | (roots != np.arange(len(roots))))
        nodes, found = _nodes(table)[roots[rows]], table.take(pa.array(rows))
        at = found.schema.get_field_index(payload)
        wide = pc.if_else(pa.array(several[rows]), found.column(payload), pa.scalar(None, found.column(payload).type))
        found = found.set_column(at, payload, wide)
        for k, name in enumerate(("to_lo", "to_c1", "to_c2")):
            found = found.append_column(name, pa.array(nodes[:, k]))
        return found

    return run


def _across(comparer, setting: Setting, most: int):
    """Links between the rows of two blocks, as many as it takes to connect what is not connected yet."""

    def run(table: pa.Table, limits: np.ndarray) -> pa.Table:
        own, forest = table.column("own").to_numpy(), Forest(table.num_rows)
        cell = np.repeat(np.arange(len(limits) - 1), np.diff(limits))
        known = np.stack([cell, own, *(table.column(c).to_numpy() for c in ("to_lo", "to_c1", "to_c2"))], 1)
        _, first, of = np.unique(known, axis=0, return_index=True, return_inverse=True)
        forest.up = first[of.ravel()]
        compare = comparer(table, setting, forest)

        def apart(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            fit = own[a] != own[b]
            return compare(a[fit], b[fit])

        return _linked(_nodes(table), _walk(limits, most, forest, apart))

    return run


NODE = ("lo", "c1", "c2")
LINK_SQL = ", ".join(f"{f.name} long" for f in LINKS)


def _as_links(rows: DataFrame) -> DataFrame:
    """Both ends as structs that sort by the smallest id of the class."""
    ends = [F.struct(*(F.col(f"{s}_{p}").alias(p) for p in ("lo", "c1", "c2"))).alias(s) for s in "ab"]
    return rows.select(*ends)


def _group_links(members: DataFrame, group: str, comparer, setting: Setting, most: int, payload: str) -> DataFrame:
    """Links that connect what is similar in each group: inside its blocks first, then across them.

    A block's rows are known as connected when two blocks meet, so that a group of g rows gives about
    g links and one for each two blocks.
    """
    # A power of two, so that buckets of much the same rows have the same blocks and give the same links.
    members = members.withColumn("blocks", F.expr("int(shiftleft(1, int(ceil(log2(blocks)))))"))
    dealt = in_blocks(members, F.hash("c1", "c2"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema)
    inside = _inside(comparer, setting, most, payload)
    schema = f"{schema}, to_lo long, to_c1 long, to_c2 long"
    found = stored(per_cell(dealt, [group, "own"], inside, schema, NODE), "blocks")
    ends = [F.col(c).alias(f"a_{c}") for c in NODE] + [F.col(f"to_{c}").alias(f"b_{c}") for c in NODE]
    own = found.where("NOT (lo = to_lo AND c1 = to_c1 AND c2 = to_c2)").select(*ends)
    across = per_cell(cross_cells(found), [group, "i", "j"], _across(comparer, setting, most), LINK_SQL, NODE)
    return _as_links(own.unionByName(across))


def candidate_links(reps: DataFrame, setting: Setting) -> DataFrame:
    """Links that connect every two classes which share a band and may reach the threshold."""
    width = 2 * setting.rows
    keys = F.array(
        *(
            F.struct(F.lit(band).alias("band"), F.xxhash64(F.substring("regs", band * width + 1, width)).alias("of"))
            for band in range(setting.bands)
        )
    )
    banded = reps.select("lo", "c1", "c2", "n", "regs", F.explode(keys).alias("bucket"))
    met = with_blocks(banded, "bucket", BUCKET_BLOCK, least=2)
    return _group_links(met, "bucket", _bucket_compare, setting, 16, "regs")


def _set_reader(setting: Setting):
    """Texts to their sets, where the digest is the one asked for."""
    schema = pa.schema(
        [("root", pa.struct([(c, pa.int64()) for c in ("lo", "c1", "c2")])), ("blocks", pa.int32())]
        + [(c, pa.int64()) for c in ("lo", "c1", "c2")]
        + [("members", pa.binary())]
    )

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            texts = batch.column(batch.schema.get_field_index("text"))
            for low, high in W.batches(texts, 2 << 20):
                part = pa.Table.from_batches([batch.slice(low, high - low)])
                sets = list(W.shingle_sets(texts.slice(low, high - low), setting.words))
                own = list(zip(part.column("c1").to_pylist(), part.column("c2").to_pylist()))
                fit = np.array([_digest(s) == d for s, d in zip(sets, own)])
                part = part.append_column("members", pa.array([s.tobytes() for s in sets], pa.binary()))
                yield from part.filter(pa.array(fit)).select(schema.names).cast(schema).to_batches()

    return run


def confirmed_links(docs: DataFrame, groups: DataFrame, reps: DataFrame, setting: Setting) -> DataFrame:
    """Links confirmed on full sets that connect every two classes of a group which are similar."""
    members = groups.select("root", "node.lo", "node.c1", "node.c2")
    wanted = with_blocks(members, "root", BLOCK)
    wanted = wanted.join(reps.select("lo", "c1", "c2", "key"), ["lo", "c1", "c2"])
    texts = docs.join(wanted, "key").select("root", "blocks", "lo", "c1", "c2", "text")
    schema = "root struct<lo:long,c1:long,c2:long>, blocks int, lo long, c1 long, c2 long, members binary"
    return _group_links(texts.mapInArrow(_set_reader(setting), schema), "root", _set_compare, setting, 2, "members")


def near_duplicates(
    docs: DataFrame, setting: Setting = Setting(), id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``id, key, hash, n_shingles, component_id, c1, c2`` of every row; equal (c1, c2) are equal sets.

    ``hash`` is xxhash64 of the text.
    """
    sketched = sketches(docs, setting, id, text)
    reps = classes(sketched)
    groups = components(candidate_links(reps, setting))
    found = components(confirmed_links(_documents(docs, id, text).drop("id", "hash"), groups, reps, setting))
    roots = reps.select("lo", "c1", "c2").join(
        found.select("node.lo", "node.c1", "node.c2", F.col("root.lo").alias("up")), ["lo", "c1", "c2"], "left"
    )
    component = F.nullif(F.coalesce("up", "lo"), F.lit(NO_ID))
    roots = roots.select("c1", "c2", component.alias("component_id"))
    own = ["id", "key", "hash", "n", "c1", "c2"]
    full = sketched.where("n > 0").select(*own).join(roots, ["c1", "c2"])
    bare = sketched.where("n = 0").select(*own, F.col("id").alias("component_id"))
    columns = ["id", "key", "hash", F.col("n").alias("n_shingles"), "component_id", "c1", "c2"]
    return full.select(*columns).unionByName(bare.select(*columns))


def keep_one(docs: DataFrame, setting: Setting, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with the smallest id.

    Null ids come last, and among equal ids the text with the smaller hash. Of rows repeated in id and
    text one stays. Rows without words stay, as they are linked with nothing.
    """
    kept = near_duplicates(docs, setting, id, text).where("n_shingles > 0")
    # The component is known by its smallest id; where all ids are null, by the set itself.
    group = F.struct("component_id", *(F.when(F.col("component_id").isNull(), F.col(c)).alias(c) for c in ("c1", "c2")))
    first = kept.groupBy(group.alias("g")).agg(F.min(F.struct(F.coalesce("id", F.lit(NO_ID)).alias("id"), "key", "hash")).alias("m"))
    chosen = first.select(F.col("m.id").alias("__wl_id"), F.col("m.hash").alias("__wl_hash"))
    words = F.coalesce(quoted(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    keyed = docs.withColumns(
        {"__wl_id": F.coalesce(quoted(id).cast("long"), F.lit(NO_ID)), "__wl_hash": F.xxhash64(quoted(text))}
    )
    once = Window.partitionBy("__wl_id", "__wl_hash").orderBy(F.lit(0))
    rows = keyed.where(words).join(chosen, ["__wl_id", "__wl_hash"], "left_semi")
    one = rows.withColumn("__wl_row", F.row_number().over(once)).where("__wl_row = 1")
    return one.select(*map(quoted, docs.columns)).unionByName(docs.where(~words))
