"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

Words are runs of letters and apostrophes, lower-cased as far as ASCII goes. A word enters as its own
vector, if the training sample has it often enough, and as the mean of the vectors of its character
trigrams. The network reads windows of WINDOW words that begin every STRIDE words, so every stretch of
WINDOW - STRIDE + 1 words lies whole in one; attention pools each window's states to one score. A
document's score is that of its highest window, whatever its length.

Training is on the driver, from a bounded sample: about SAMPLE documents per label, drawn by a hash of
the id, of at most SAMPLE_BYTES each. A clean document's windows are all clean; of a toxic document the
window that scores highest so far is taken as toxic, at first by the words' log odds, later by the
network. Word vectors begin with the log odds, shrunk by two standard errors.

Null and empty texts and texts without a word score 0, and so does everything if the sample lacks one
of the labels. Repeated rows score alike. Labels of unknown documents, null labels and repeated labels
do no harm. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm import words as W
from wattline.llm.tables import hash32, picked, share_below

WINDOW = 32
STRIDE = 20
SAMPLE = 1200
SAMPLE_BYTES = 20_000
LEAST_DOCUMENTS = 3
VOCABULARY = 20_000
WORD_DIM, CHAR_DIM, CHAR_ROWS, HIDDEN = 8, 6, 2048, 8
CLEAN_WINDOWS = 5
EPOCHS = 6
BATCH = 256

_GAP = np.ones(256, bool)
_GAP[[*range(65, 91), *range(97, 123), 39, *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = _LOWER[97:123]


def split(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, limits of the rows among them, and the first byte and size of each word."""
    data, rows = W.utf8(column)
    code, first, limits = W.spans(data, rows, _GAP)
    solid = np.concatenate([[0], np.cumsum(~_GAP[data])])
    # A word ends where the count of letters up to the next word's first byte runs out.
    until = np.append(first[1:], len(data)) if len(first) else first
    return code, limits, first, solid[until] - solid[first]


def trigrams(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the byte trigrams of each word, ends marked, and the words' limits among them."""
    limits = np.concatenate([[0], np.cumsum(size)])
    word = np.repeat(np.arange(len(size)), size)
    at = np.arange(limits[-1]) - limits[:-1][word]
    place = first[word] + at
    letter = _LOWER[data[place]].astype(np.uint32) + np.uint32(1)
    before = np.where(at > 0, np.roll(letter, 1), 0).astype(np.uint32)
    behind = np.where(at + 1 < size[word], np.roll(letter, -1), 0).astype(np.uint32)
    value = (before * np.uint32(66049) + letter * np.uint32(257) + behind) * np.uint32(2654435769)
    return (value >> np.uint32(32 - CHAR_ROWS.bit_length() + 1)).astype(np.int64), limits


def window_starts(limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and row of every window; the last window ends with the text."""
    size = np.diff(limits)
    count = np.where(size > 0, 1 + -(-np.maximum(size - WINDOW, 0) // STRIDE), 0)
    row = np.repeat(np.arange(len(size)), count)
    number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = np.minimum(number * STRIDE, np.maximum(size[row] - WINDOW, 0))
    return limits[:-1][row] + start, np.minimum(size[row], WINDOW), row


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _padded(words: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Word numbers of the windows, -1 behind a short one's end."""
    at = start[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < size[:, None]
    return np.where(inside, words[np.minimum(at, max(len(words) - 1, 0))], -1)


SIDES = ("f", "b")


class Network:
    """Parameters by name; ``vocabulary`` has the sorted hashes of the known words."""

    def __init__(self, vocabulary: np.ndarray, odds: np.ndarray, seed: int = 1):
        rng = np.random.default_rng(seed)

        def small(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) * 0.3 / np.sqrt(shape[0])).astype(np.float32)

        self.vocabulary = vocabulary
        word = (rng.standard_normal((len(vocabulary) + 1, WORD_DIM)) * 0.05).astype(np.float32)
        word[:, 0] = np.append(odds, 0)
        self.p = {"word": word, "char": (rng.standard_normal((CHAR_ROWS, CHAR_DIM)) * 0.05).astype(np.float32)}
        for s in SIDES:
            self.p[f"x{s}"] = 3 * small(WORD_DIM + CHAR_DIM, 3 * HIDDEN)
            self.p[f"h{s}"] = small(HIDDEN, 3 * HIDDEN)
            self.p[f"c{s}"] = np.zeros(3 * HIDDEN, np.float32)
        self.p["attend"] = small(2 * HIDDEN)
        self.p["out"] = 4 * small(2 * HIDDEN)
        self.p["bias"] = np.full(1, -1, np.float32)

    def numbers(self, code: np.ndarray) -> np.ndarray:
        """Row of each word in the word table; the last row is for unknown words."""
        at = np.searchsorted(self.vocabulary, code)
        known = at < len(self.vocabulary)
        known[known] = self.vocabulary[at[known]] == code[known]
        return np.where(known, at, len(self.vocabulary))

    def inputs(self, number: np.ndarray, gram: np.ndarray, limits: np.ndarray) -> np.ndarray:
        """Vector of each different word: its own and the mean of its trigrams'."""
        if not len(number):
            return np.zeros((0, WORD_DIM + CHAR_DIM), np.float32)
        chars = np.add.reduceat(self.p["char"][gram], limits[:-1], axis=0) / np.diff(limits)[:, None]
        return np.concatenate([self.p["word"][number], chars], 1).astype(np.float32)

    def _read(self, side: str, gates: np.ndarray, at: np.ndarray, keep: list | None) -> np.ndarray:
        """States after each word, padded places passing the state on. ``gates`` is by word."""
        n = len(at)
        state = np.zeros((n, HIDDEN), np.float32)
        states = np.zeros((WINDOW, n, HIDDEN), np.float32)
        weight = self.p[f"h{side}"]
        for t in range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1):
            own = at[:, t]
            x, inner = gates[own], state @ weight
            zr = _sigmoid(x[:, : 2 * HIDDEN] + inner[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            fresh = np.tanh(x[:, 2 * HIDDEN :] + r * inner[:, 2 * HIDDEN :])
            real = (own >= 0)[:, None]
            after = np.where(real, fresh + z * (state - fresh), state)
            if keep is not None:
                keep.append((t, state, z, r, fresh, inner[:, 2 * HIDDEN :], real))
            state = after
            states[t] = state
        return states

    def forward(self, x: np.ndarray, at: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Margin of each window. ``x`` is by different word, ``at`` points into it, -1 for none."""
        states = []
        for s in SIDES:
            gates = np.concatenate([x @ self.p[f"x{s}"] + self.p[f"c{s}"], np.zeros((1, 3 * HIDDEN), np.float32)])
            trace = [] if keep is not None else None
            states.append(self._read(s, gates, at, trace))
            if keep is not None:
                keep[s] = trace
        both = np.concatenate(states, 2)
        weight = both @ self.p["attend"]
        weight[(at < 0).T] = -1e9
        weight = np.exp(weight - weight.max(0))
        weight /= weight.sum(0)
        pooled = (weight[:, :, None] * both).sum(0)
        if keep is not None:
            keep |= {"both": both, "weight": weight, "pooled": pooled}
        return pooled @ self.p["out"] + self.p["bias"][0]

    def gradients(self, x: np.ndarray, at: np.ndarray, target: np.ndarray, scale: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted log loss, by parameter, and by word input under ``x``."""
        kept: dict = {}
        error = ((_sigmoid(self.forward(x, at, kept)) - target) * scale).astype(np.float32)
        both, weight, pooled = kept["both"], kept["weight"], kept["pooled"]
        g = {"out": pooled.T @ error, "bias": error.sum(keepdims=True)}
        d_pooled = error[:, None] * self.p["out"]
        d_both = weight[:, :, None] * d_pooled
        d_weight = (both * d_pooled).sum(2)
        d_weight = weight * (d_weight - (weight * d_weight).sum(0))
        g["attend"] = np.einsum("tn,tnh->h", d_weight, both)
        d_both = d_both + d_weight[:, :, None] * self.p["attend"]
        g["x"] = np.zeros_like(x)
        for k, s in enumerate(SIDES):
            d_gates = np.zeros((len(x) + 1, 3 * HIDDEN), np.float32)
            g[f"h{s}"] = np.zeros_like(self.p[f"h{s}"])
            d_state = np.zeros((len(at), HIDDEN), np.float32)
            for t, state, z, r, fresh, inner, real in reversed(kept[s]):
                d_state = d_state + d_both[t][:, k * HIDDEN : (k + 1) * HIDDEN]
                own = np.where(real, d_state, 0)
                d_fresh = own * (1 - z) * (1 - fresh * fresh)
                d_z = own * (state - fresh) * z * (1 - z)
                d_r = d_fresh * inner * r * (1 - r)
                d_x = np.concatenate([d_z, d_r, d_fresh], 1)
                d_in = np.concatenate([d_z, d_r, d_fresh * r], 1)
                np.add.at(d_gates, at[:, t], d_x)
                g[f"h{s}"] += state.T @ d_in
                d_state = np.where(real, own * z, d_state) + d_in @ self.p[f"h{s}"].T
            d_gates = d_gates[:-1]
            g[f"c{s}"] = d_gates.sum(0)
            g[f"x{s}"] = x.T @ d_gates
            g["x"] += d_gates @ self.p[f"x{s}"].T
        return g


@dataclass
class Texts:
    """Words of some texts, and what the network needs of each different one."""

    which: np.ndarray  # different word of each word
    limits: np.ndarray
    code: np.ndarray  # hash of each different word
    gram: np.ndarray
    gram_limits: np.ndarray

    @classmethod
    def read(cls, column: pa.Array) -> Texts:
        data, _ = W.utf8(column)
        code, limits, first, size = split(column)
        values, sample, which = np.unique(code, return_index=True, return_inverse=True)
        return cls(which, limits, values, *trigrams(data, first[sample], size[sample]))


def margins(network: Network, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Margin, row and start of every window."""
    start, size, row = window_starts(texts.limits)
    x = network.inputs(network.numbers(texts.code), texts.gram, texts.gram_limits)
    found = [network.forward(x, _padded(texts.which, start[k : k + 4096], size[k : k + 4096])) for k in range(0, len(start), 4096)]
    return np.concatenate([np.zeros(0, np.float32), *found]), row, start


def word_odds(texts: Texts, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of the words of enough documents, two standard errors closer to 0."""
    row = np.repeat(np.arange(len(label)), np.diff(texts.limits))
    pairs = np.unique(row * len(texts.code) + texts.which) if len(texts.code) else np.zeros(0, int)
    word, toxic = pairs % max(len(texts.code), 1), label[pairs // max(len(texts.code), 1)]
    hits = np.bincount(word[toxic == 1], minlength=len(texts.code)) + 0.5
    misses = np.bincount(word[toxic == 0], minlength=len(texts.code)) + 0.5
    odds = np.log(hits / (label.sum() + 1)) - np.log(misses / ((1 - label).sum() + 1))
    sure = np.maximum(np.abs(odds) - 2 * np.sqrt(1 / hits + 1 / misses), 0)
    odds = np.clip(np.sign(odds) * sure, -3, 3)
    common = np.flatnonzero(hits + misses - 1 >= LEAST_DOCUMENTS)
    common = common[np.argsort(-np.abs(odds[common]), kind="stable")[:VOCABULARY]]
    common.sort()
    return common, odds[common].astype(np.float32)


def fit(column: pa.Array, label: np.ndarray, epochs: int = EPOCHS, seed: int = 1) -> Network | None:
    """Train on whole texts with labels 0 and 1; None if one of them is missing."""
    texts = Texts.read(column)
    filled = np.diff(texts.limits) > 0
    if len(set(label[filled].tolist())) < 2:
        return None
    common, odds = word_odds(texts, label)
    network = Network(texts.code[common], odds, seed)
    rng = np.random.default_rng(seed)
    start, size, row = window_starts(texts.limits)
    by_word = np.zeros(len(texts.code), np.float32)
    by_word[common] = odds
    along = np.concatenate([[0], np.cumsum(np.maximum(by_word[texts.which], 0))])
    height = along[start + size] - along[start]
    number = network.numbers(texts.code)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.p.items()}
    step = 0
    for epoch in range(epochs):
        if epoch >= 2:
            height = margins(network, texts)[0]
        # The highest window of each toxic text; of each clean one its highest and some others.
        order = np.lexsort([rng.random(len(row)), row])
        place = np.arange(len(order)) - np.searchsorted(row[order], row[order])
        few = order[(place < CLEAN_WINDOWS) & (label[row[order]] == 0)]
        top = np.lexsort([-height, row])
        top = top[np.searchsorted(row[top], np.unique(row))]
        chosen = rng.permutation(np.unique(np.concatenate([top, few])))
        for low in range(0, len(chosen), BATCH):
            own = chosen[low : low + BATCH]
            at = _padded(texts.which, start[own], size[own])
            used, inverse = np.unique(at, return_inverse=True)
            inverse = inverse.reshape(at.shape)
            if used[0] < 0:
                used, inverse = used[1:], inverse - 1
            lengths = np.diff(texts.gram_limits)[used]
            gram = np.concatenate([texts.gram[a:b] for a, b in zip(texts.gram_limits[used], texts.gram_limits[used + 1])])
            limits = np.concatenate([[0], np.cumsum(lengths)])
            x = network.inputs(number[used], gram, limits)
            target = label[row[own]].astype(np.float32)
            g = network.gradients(x, inverse, target, np.full(len(own), 1 / len(own), np.float32))
            d_x = g.pop("x")
            g["word"], g["char"] = np.zeros_like(network.p["word"]), np.zeros_like(network.p["char"])
            np.add.at(g["word"], number[used], d_x[:, :WORD_DIM])
            np.add.at(g["char"], gram, np.repeat(d_x[:, WORD_DIM:] / lengths[:, None], lengths, 0))
            step += 1
            for k, v in g.items():  # Adam
                first, second = moment[k]
                first += 0.1 * (v - first)
                second += 0.01 * (v * v - second)
                rate = 0.01 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                network.p[k] -= (rate * first / (np.sqrt(second) + 1e-6)).astype(np.float32)
    return network


def score(network: Network | None, column: pa.Array) -> np.ndarray:
    """Highest window's probability of each text."""
    found = np.zeros(len(column))
    if network is not None:
        margin, row, _ = margins(network, Texts.read(column))
        best = np.full(len(column), -np.inf)
        np.maximum.at(best, row, margin.astype(float))
        found = np.where(np.isfinite(best), _sigmoid(best), 0.0)
    return found


def train(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
    sample_size: int = SAMPLE,
) -> Network | None:
    """Fit on a bounded sample of the documents that have a label of 0 or 1."""
    marked = picked(labels, id=id, label=label).where("label IN (0, 1) AND id IS NOT NULL")
    counts = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return None
    limit = F.when(F.col("label") == 1, share_below(sample_size, counts[1])).otherwise(share_below(sample_size, counts[0]))
    drawn = marked.where(hash32("id") < limit).distinct()
    rows = picked(docs, id=id, text=text).where(f"octet_length(text) BETWEEN 1 AND {SAMPLE_BYTES}")
    # About 2 * sample_size ids, whatever the size of the tables.
    found = rows.join(F.broadcast(drawn), "id").select("text", F.col("label").cast("int").alias("label"))
    table = found.distinct().orderBy("text", "label").toArrow()
    return fit(table.column("text").combine_chunks(), table.column("label").to_numpy().astype(int)) if table.num_rows else None


SCORED = pa.schema([("id", pa.int64()), ("score", pa.float64())])


def _scorer(network: Network | None):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for low, high in W.batches(batch.column(1)):
                part = batch.slice(low, high - low)
                yield pa.record_batch([part.column(0), pa.array(score(network, part.column(1)))], schema=SCORED)

    return run


def score_documents(docs: DataFrame, network: Network | None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, score`` of every row."""
    rows = picked(docs, id=id, text=text).withColumn("id", F.col("id").cast("long"))
    return rows.mapInArrow(_scorer(network), "id long, score double")
