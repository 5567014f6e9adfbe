"""Benchmark decontamination by SimHash windows, multi-index Hamming blocks and exact similarity.

1. Every window of a document that is as long as a benchmark item gets a 64-bit SimHash of its words.
   Lengths are grouped so that a window is at most one word, or 5 % of its words, longer or shorter
   than the items it stands for, and windows start as close to each other, from the document's first
   word on; one more ends with the document. Items of fewer than SHORT words have windows of just
   their length.
2. Fingerprints are cut into n blocks. If two differ in at most RADIUS bits, they differ in at most
   RADIUS // n bits of some block. Every value within that distance of an item's block leads to the
   item, so the look-up finds all pairs within RADIUS, and a full comparison drops the others.
3. A candidate is verified on the document's words: of the windows of exactly the item's length around
   the place, the best weighted similarity of 5-word shingles counts: the sum of the smaller over the
   sum of the larger counts of every shingle. Items or windows of fewer words count as one shingle.

Items go to the tasks in blocks of bounded size, each compared with all windows; the blocks are read
from the benchmark one at a time, so its size bounds neither the driver nor a task. An item that can
have no window as its text is null or empty never matches. A document that is shorter than an item's
windows needs no SimHash: it is a candidate if it has one of the item's first shingles, of which a
similar one can't lack all. A document that repeats an item gives one row, at the most similar and
then first place. Null and empty texts give no row, repeated rows each give theirs, empty tables none.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm import words as W
from wattline.llm.tables import picked

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 11
FEW_ITEMS = 64
SHORT = 15
ITEMS_PER_BLOCK = 1024
WORDS_AT_ONCE = 1 << 14

_SPREAD = np.zeros(256, np.uint64)
for _bit in range(8):
    _SPREAD |= ((np.arange(256, dtype=np.uint64) >> np.uint64(_bit)) & np.uint64(1)) << np.uint64(8 * _bit)
_ORDER = np.arange(64, dtype=np.uint64) % np.uint64(8) * np.uint64(8) + np.arange(64, dtype=np.uint64) // np.uint64(8)


def counters(words: np.ndarray) -> np.ndarray:
    """Running totals of the 64 bits of the word hashes: eight numbers of eight 8-bit lanes each.

    A lane may overflow into the next, but differences of totals over fewer than 128 words are exact.
    """
    lanes = np.empty((8, len(words) + 1), np.uint64)
    lanes[:, 0] = 0
    for k in range(8):
        lanes[k, 1:] = _SPREAD[(words >> np.uint64(8 * k)) & np.uint64(255)]
    return np.cumsum(lanes, axis=1, out=lanes)


def window_starts(limits: np.ndarray, width: int, step: int, low: int, high: int) -> np.ndarray:
    """First words, from ``low`` to before ``high``, of windows every ``step`` words and at the end of each document."""
    near = slice(np.searchsorted(limits, low, "right") - 1, np.searchsorted(limits, high, "left"))
    begin, last = limits[:-1][near], limits[1:][near] - width
    first = begin + np.maximum(0, -((begin - low) // step)) * step
    count = np.maximum(0, (np.minimum(last, high - 1) - first) // step + 1)
    place = np.repeat(first - step * (np.cumsum(count) - count), count) + step * np.arange(count.sum())
    ends = last[(last >= np.maximum(begin, low)) & (last < high) & ((last - begin) % step > 0)]
    return np.concatenate([place, ends])


def window_hashes(total: np.ndarray, width: int, start: np.ndarray) -> np.ndarray:
    """SimHash of the windows of fewer than 128 words at the given starts: a bit is set if most words have it."""
    found: np.ndarray | None = None
    lift = np.uint64(int("01" * 8, 16) * (127 - width // 2))
    end = start + width
    for k in range(8):
        row = total[k]
        flags = row.take(end) - row.take(start)
        flags += lift
        flags >>= np.uint64(7 - k)
        flags &= np.uint64(int("01" * 8, 16) << k)
        found = flags if found is None else np.bitwise_or(found, flags, out=found)
    return found


def simhash(words: np.ndarray) -> int:
    """SimHash of any number of words, bit by bit; the bits stand in the order of ``window_hashes``."""
    bits = (words[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    most = bits.sum(0) > len(words) // 2
    return int((most.astype(np.uint64) << _ORDER).sum())


def slack(length: int) -> int:
    """Words by which a window may be off; a short item's windows are of just its length."""
    return max(1, length // 20) if length >= SHORT else 0


def least_words(length: int) -> int:
    """Words of the shortest document that can be similar to an item of this length."""
    return int(np.ceil(SIMILARITY * (length - SHINGLE + 1) - 1e-9)) + SHINGLE - 1 if length >= SHINGLE else length


def width_classes(lengths: list[int]) -> dict[int, int]:
    """Window width for each item length: at most ``slack`` words off."""
    width_of: dict[int, int] = {}
    for length in sorted(set(lengths)):
        width = max(width_of.values(), default=0)
        width_of[length] = width if width and abs(length - width) <= slack(length) else length + slack(length)
    return width_of


def _near(width: int, most: int) -> np.ndarray:
    """All values of ``width`` bits with at most ``most`` bits set."""
    return np.array(
        [sum(1 << b for b in bits) for n in range(most + 1) for bits in combinations(range(width), n)], np.uint64
    )


class HammingIndex:
    """Finds all stored 64-bit fingerprints within RADIUS bits of a query.

    Four blocks have small tables; more items need the larger tables of three blocks to stay selective.
    """

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        self.blocks = []
        cuts = [0, 16, 32, 48, 64] if len(prints) <= FEW_ITEMS else [0, 21, 42, 64]
        for low, high in zip(cuts, cuts[1:]):
            width = high - low
            own = (prints >> np.uint64(low)) & np.uint64((1 << width) - 1)
            near = _near(width, RADIUS // (len(cuts) - 1))
            value = (own[:, None] ^ near[None, :]).ravel().astype(np.int64)
            item = np.repeat(np.arange(len(prints)), len(near))
            order = np.argsort(value, kind="stable")
            count = np.bincount(value, minlength=1 << width)
            first = (np.cumsum(count) - count).astype(np.int32)
            self.blocks.append((low, width, count > 0, first, count.astype(np.int32), item[order].astype(np.int32)))

    def search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of query number and item number, each once."""
        found = []
        for low, width, some, first, count, item in self.blocks:
            value = ((queries >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64)
            at = np.flatnonzero(some[value])
            times = count[value[at]]
            query = np.repeat(at, times)
            behind = np.cumsum(times, dtype=np.int64)
            place = np.repeat(first[value[at]] - (behind - times), times) + np.arange(len(query))
            items = item[place]
            close = np.bitwise_count(queries[query] ^ self.prints[items]) <= RADIUS
            found.append(np.stack([query[close], items[close]]))
        pairs = np.unique(np.concatenate(found, 1), axis=1)
        return pairs[0], pairs[1]


def bag(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(W.shingles(words, SHINGLE), return_counts=True)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the smaller over sum of the larger counts of all shingles."""
    _, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][ia], b[1][ib]).sum()
    return float(both / max(a[1].sum() + b[1].sum() - both, 1))


@dataclass(frozen=True)
class Items:
    """One block of the benchmark: ids and word hashes."""

    ids: list
    words: list[np.ndarray]

    def bags(self) -> list:
        return [bag(w) for w in self.words]


class Matcher:
    """Compares documents with one block of items."""

    def __init__(self, items: Items):
        self.items, self.bags = items, items.bags()
        self.length = np.array([len(w) for w in items.words])
        prints = np.array([simhash(w) for w in items.words], np.uint64)
        width_of = width_classes(self.length.tolist())
        widths = np.array([width_of[n] for n in self.length.tolist()])
        self.classes = []
        for width in np.unique(widths).tolist():
            own = np.flatnonzero(widths == width)
            self.classes.append((width, max(1, slack(width)), own, HammingIndex(prints[own])))
        # A similar text lacks at most a fifth of the item's shingles, so it has one of any fifth and one more.
        self.width, self.least = widths, np.array([least_words(n) for n in self.length.tolist()])
        firsts = [W.shingles(w, SHINGLE)[: int((1 - SIMILARITY) * (len(w) - SHINGLE + 1) + 1e-9) + 1] for w in items.words]
        of, value = np.repeat(np.arange(len(firsts)), list(map(len, firsts))), np.concatenate([np.zeros(0, np.uint64), *firsts])
        order = np.argsort(value, kind="stable")
        self.first, self.first_of = value[order], of[order]

    def candidates(self, words: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First words, counted from the first document's, and items."""
        places, items = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

        def search(own: np.ndarray, index: HammingIndex, place: np.ndarray, prints: np.ndarray) -> None:
            query, item = index.search(prints)
            places.append(place[query])
            items.append(own[item])

        longest = max((w for w, *_ in self.classes), default=0)
        doc, item = self.short(words, limits, longest)
        places.append(limits[doc])
        items.append(item)
        for low in range(0, len(words), WORDS_AT_ONCE):
            total = counters(words[low : low + WORDS_AT_ONCE + longest])
            for width, step, own, index in self.classes:
                place = window_starts(limits, width, step, low, min(low + WORDS_AT_ONCE, len(words)))
                if not len(place):
                    continue
                if width < 128:
                    prints = window_hashes(total, width, place - low)
                else:
                    prints = np.array([simhash(words[p : p + width]) for p in place.tolist()], np.uint64)
                search(own, index, place, prints)
        return np.concatenate(places), np.concatenate(items)

    def short(self, words: np.ndarray, limits: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that are shorter than an item's windows and have one of its first shingles, and these items."""
        size = np.diff(limits)
        docs = np.flatnonzero((size >= SHINGLE) & (size < longest))
        count = size[docs] - SHINGLE + 1
        doc = np.repeat(docs, count)
        at = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + limits[doc]
        total = np.zeros(len(at), np.uint64)
        for i, factor in enumerate(W.stream(3, SHINGLE) | np.uint64(1)):
            total += words[at + i] * factor
        value = W.mix(total + np.uint64(SHINGLE))
        low, high = (np.searchsorted(self.first, value, side) for side in ("left", "right"))
        some = np.flatnonzero(high > low)
        doc, low, high = np.unique(np.stack([doc[some], low[some], high[some]]), axis=1)
        times = high - low
        item = self.first_of[np.repeat(low - (np.cumsum(times) - times), times) + np.arange(times.sum())]
        doc = np.repeat(doc, times)
        fits = (size[doc] >= self.least[item]) & (size[doc] < self.width[item])
        pairs = np.unique(np.stack([doc[fits], item[fits]]), axis=1)
        return pairs[0], pairs[1]

    def matches(self, words: np.ndarray, limits: np.ndarray) -> list[tuple[int, int, float, int]]:
        """(document, item, similarity, first word) of the best place of each pair that matches."""
        place, item = self.candidates(words, limits)
        best: dict[tuple[int, int], tuple[float, int]] = {}
        for own in np.unique(item).tolist():
            length, items = int(self.length[own]), self.bags[own]
            doc = np.searchsorted(limits, place[item == own], "right") - 1
            reach = np.arange(-3 * max(1, slack(length)), 3 * max(1, slack(length)) + 1)
            begin, last = limits[doc], np.maximum(limits[doc + 1] - length, limits[doc])
            start = np.unique(np.clip(place[item == own][:, None] + reach, begin[:, None], last[:, None]))
            doc = np.searchsorted(limits, start, "right") - 1
            for low in range(0, len(start), 4096):
                self._verify(own, words, limits, doc[low : low + 4096], start[low : low + 4096], best)
        return [(doc, own, value, at) for (doc, own), (value, at) in sorted(best.items())]

    def _verify(self, own: int, words, limits, doc: np.ndarray, start: np.ndarray, best: dict) -> None:
        """Exact similarity of the windows that have enough shingles of the item."""
        length, wanted = int(self.length[own]), self.bags[own]
        if length >= SHINGLE:
            whole = limits[doc + 1] - start >= length
            inner = start[whole][:, None] + np.arange(length)
            total = np.zeros((len(inner), length - SHINGLE + 1), np.uint64)
            for i, factor in enumerate(W.stream(3, SHINGLE) | np.uint64(1)):
                total += words[inner[:, i : length - SHINGLE + 1 + i]] * factor
            known = np.isin(W.mix(total + np.uint64(SHINGLE)), wanted[0]).sum(1)
            enough = np.ones(len(start), bool)
            enough[whole] = known >= SIMILARITY * (length - SHINGLE + 1) - 1e-9
            doc, start = doc[enough], start[enough]
        for d, at in zip(doc.tolist(), start.tolist()):
            value = similarity(wanted, bag(words[at : min(at + length, limits[d + 1])]))
            first = int(at - limits[d])
            if value >= SIMILARITY and ((d, own) not in best or (-value, first) < (-best[d, own][0], best[d, own][1])):
                best[d, own] = value, first


def item_blocks(benchmark: DataFrame, id: str, text: str) -> Iterator[Items]:
    """The benchmark in blocks of ITEMS_PER_BLOCK items, read one at a time."""
    rows = picked(benchmark, id=id, text=text).where("text is not null")
    ids: list = []
    texts: list[str] = []

    def block() -> Items:
        words, limits = W.word_hashes(pa.array(texts, pa.string()))
        some = [i for i in range(len(ids)) if limits[i + 1] > limits[i]]
        return Items([ids[i] for i in some], [words[limits[i] : limits[i + 1]] for i in some])

    for row in rows.orderBy("id", "text").toLocalIterator():
        ids.append(row["id"])
        texts.append(row["text"])
        if len(ids) == ITEMS_PER_BLOCK:
            yield block()
            ids, texts = [], []
    if ids:
        yield block()


MATCHES = pa.schema(
    [("id", pa.int64()), ("key", pa.int64()), ("item_id", pa.int64()), ("similarity", pa.float64()), ("first_word", pa.int64())]
)


def _scanner(blocks: list[Items]):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matchers = [Matcher(b) for b in blocks if b.ids]
        for batch in source:
            for low, high in W.batches(batch.column(2)):
                part = batch.slice(low, high - low)
                words, limits = W.word_hashes(part.column(2))
                for matcher in matchers:
                    found = matcher.matches(words, limits)
                    if not found:
                        continue
                    rows = pa.array([doc for doc, *_ in found])
                    yield pa.record_batch(
                        [
                            part.column(0).take(rows),
                            part.column(1).take(rows),
                            pa.array([matcher.items.ids[i] for _, i, *_ in found], pa.int64()),
                            pa.array([value for *_, value, _ in found]),
                            pa.array([start for *_, start in found], pa.int64()),
                        ],
                        schema=MATCHES,
                    )

    return run


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", key: str | None = None,
) -> DataFrame:
    """``id, key, item_id, similarity, first_word`` for every document and item that match.

    ``key`` names a long column that comes along, null if none is named. One pass over the documents
    serves up to four blocks of items.
    """
    rows = picked(docs, id=id, key=key or id, text=text)
    rows = rows.withColumns({c: F.col(c).cast("long") for c in ("id", "key")})
    found: list[DataFrame] = []
    held: list[Items] = []

    def scan() -> None:
        schema = "id long, key long, item_id long, similarity double, first_word long"
        found.append(rows.mapInArrow(_scanner(list(held)), schema))
        held.clear()

    for block in item_blocks(benchmark, item, item_text):
        held.append(block)
        if len(held) == 4:
            scan()
    if held or not found:
        scan()
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result
