"""Language identification: family first, then linear support vector machines inside the family.

A family is a group of closely related languages (FAMILIES; a language not listed there is a family
of its own). Families are told apart by one-versus-one linear support vector machines over byte
n-gram frequencies, and so are the languages of a family. The machine outputs of a pair are turned
into a probability by a logistic curve fitted on the training rows; a class's probability is the
mean over its pairs, so that of the best one is at least a half, and the score is the family's times
the language's. The score tells languages apart, not texts from junk. On demand one more machine per
language does that: it learns the language's texts and short cuttings of them against junk made of them
(shuffled letters, base64, hex, random letters), half of the texts fitting it and half setting the limits,
one for each band of lengths: at most REJECTED of their cuttings lie below. A language has none if it has
fewer than LEAST_TEXTS texts, or if the machine finds less than TOLD of a kind of held-out junk.

The machines are fitted on the driver on a bounded sample: at most about SAMPLE texts per language,
drawn by a hash from the rows that may be learnt from, and of those only texts of at most SAMPLE_BYTES.
Every text is scored whole: the features are means over all its positions.

``und`` with score 0 for null, empty and letterless texts, for junk if the model judges it, and for every text if nothing can be learnt
from. With one language learnt, all other texts get it. Repeated rows are scored alike; other columns
are ignored.
"""

from __future__ import annotations

import base64
import random
import string
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm import words as W
from wattline.llm.tables import hash32, picked, share_below

# Families of closely related languages by their ISO 639-1 codes.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv",
    "romance": "ca es fr gl it oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "indic": "bn gu hi mr ne pa ur",
    "semitic": "am ar he mt",
    "cjk": "ja ko zh",
}
UNKNOWN = "und"
SAMPLE = 400
SAMPLE_BYTES = 20_000
FEATURES = 1 << 12
SIZES = (1, 2, 3)
EPOCHS = 30
LEAST_TEXTS = 20
REJECTED = 0.005
TOLD = 0.9
# Least bytes of the bands of lengths.
BANDS = (1, 20, 45)
CUTTING = 60
_LETTER = regex.compile(r"\p{L}")


def family_of(lang: str) -> str:
    return next((name for name, codes in FAMILIES.items() if lang.lower()[:2] in codes.split()), lang)


def grams(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature number of the byte n-grams at each position, one row per size, and where they are whole.

    A-Z count as a-z, a byte of white space or a digit as a blank.
    """
    code = _FOLD[data].astype(np.uint32)
    found = np.zeros((len(SIZES), len(data)), np.int32)
    whole = np.zeros((len(SIZES), len(data)), bool)
    end = np.repeat(rows[1:], np.diff(rows)) if len(data) else np.zeros(0, np.int64)
    room = end - np.arange(len(data))
    value = np.zeros(len(data), np.uint32)
    for i, size in enumerate(SIZES):
        value[: len(data) - size + 1] = value[: len(data) - size + 1] * np.uint32(257) + code[size - 1 :]
        mixed = (value * np.uint32(2654435769) + np.uint32(size * 40503)) * np.uint32(2246822519)
        found[i] = (mixed >> np.uint32(32 - FEATURES.bit_length() + 1)).astype(np.int32)
        whole[i] = room >= size
    return found, whole


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] = _FOLD[97:123]
_FOLD[[*range(0x09, 0x0E), *range(0x30, 0x3A)]] = 0x20


def features(texts: list[bytes]) -> np.ndarray:
    """Share of each n-gram among a text's n-grams of its size."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    for i, text in enumerate(texts):
        data = np.frombuffer(text, np.uint8)
        found, whole = grams(data, np.array([0, len(data)]))
        for row, fit in zip(found, whole):
            if fit.any():
                out[i] += np.bincount(row[fit], minlength=FEATURES) / fit.sum()
    return out


@dataclass
class Machine:
    """One linear support vector machine; positive for ``yes``. ``slope, shift`` give probabilities."""

    yes: str
    no: str
    weight: np.ndarray
    bias: float
    slope: float
    shift: float


def fit_machine(x: np.ndarray, y: np.ndarray, yes: str, no: str, epochs: int = EPOCHS) -> Machine:
    """Squared hinge loss by gradient steps of fixed size with momentum; then a logistic curve."""
    count = np.where(y > 0, (y > 0).sum(), (y < 0).sum())
    share = 1 / (2 * np.maximum(count, 1))
    weight, speed = np.zeros((2, x.shape[1]), np.float32)
    bias = drift = 0.0
    scale = max(float((x * x).sum(1).mean()), 1e-6)
    for _ in range(epochs * 10):
        gap = (np.maximum(0, 1 - y * (x @ weight + bias)) * y * share).astype(np.float32)
        speed = np.float32(0.9) * speed + (gap @ x) / np.float32(scale) - np.float32(1e-4) * weight
        drift = 0.9 * drift + float(gap.sum())
        weight, bias = weight + np.float32(0.5) * speed, bias + 0.05 * drift
    margin = x @ weight + bias
    slope, shift = 1.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + shift, -30, 30)))
        error = ((y > 0) - p) * share
        slope, shift = slope + 5 * (error * margin).sum() - 1e-3 * slope, shift + 5 * error.sum()
    return Machine(yes, no, weight, bias, max(slope, 1e-3), shift)


def fit_pairs(x: np.ndarray, label: np.ndarray) -> list[Machine]:
    """One machine for every two classes."""
    found = []
    for yes, no in combinations(sorted(set(label.tolist())), 2):
        own = (label == yes) | (label == no)
        found.append(fit_machine(x[own], np.where(label[own] == yes, 1.0, -1.0), yes, no))
    return found


def cutting(text: str, rng: random.Random, length: int = CUTTING) -> str:
    """About ``length`` characters of whole words, if there are blanks."""
    at = text.find(" ", rng.randrange(max(1, len(text) - length))) + 1
    end = text.find(" ", at + length)
    return text[at : end if 0 <= end < at + 2 * length else at + length]


def junk(text: str, rng: random.Random) -> list[str]:
    """Texts of the same length that are of no language."""
    letters = [c for c in text if not c.isspace()]
    rng.shuffle(letters)
    mixed = iter(letters)
    raw = text.encode()
    noise = " ".join("".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(2, 10))) for _ in range(len(text) // 7 + 1))
    coded = base64.b64encode(rng.randbytes(len(raw) * 3 // 4)).decode()
    return ["".join(c if c.isspace() else next(mixed) for c in text), coded, raw.hex()[: len(raw)], noise]


def fit_genuine(texts: list[str], lang: str) -> tuple[Machine, np.ndarray] | None:
    """A machine that is positive for texts of the language, and for each band the limit below which a text is junk."""
    if len(texts) < LEAST_TEXTS:
        return None
    rng = random.Random(lang)
    x, y = [], []
    for text in texts[::2]:
        for clean in (text, cutting(text, rng)):
            rows = [clean, *junk(clean, rng)]
            x += [t.encode() for t in rows]
            y += [1.0] + [-1.0] * (len(rows) - 1)
    machine = fit_machine(features(x), np.array(y), lang, UNKNOWN)
    limits = []
    for least in BANDS:
        held = [cutting(t, rng, least).encode() for t in texts[1::2] for _ in range(4)]
        held = [t for t in held if _LETTER.search(t.decode())]
        held += [t.encode() for t in texts[1::2]] if least == BANDS[-1] else []
        margin = features(held) @ machine.weight + machine.bias
        limits.append(min(0.0, float(np.quantile(margin, REJECTED))) if held else -np.inf)
    # One that can't tell every kind of junk made of the held-out texts rejects nothing.
    for made in zip(*(junk(cutting(t, rng), rng) for t in texts[1::2])):
        if (features([t.encode() for t in made]) @ machine.weight + machine.bias < limits[-1]).mean() < TOLD:
            return None
    return machine, np.minimum.accumulate(limits[::-1])[::-1]


@dataclass
class Model:
    families: dict[str, list[str]]
    between: list[Machine]
    inside: dict[str, list[Machine]]
    genuine: dict[str, tuple[Machine, np.ndarray]] = field(default_factory=dict)

    @classmethod
    def fit(cls, texts: list[bytes], langs: list[str]) -> Model:
        x, lang = features(texts), np.array(langs, object)
        family = np.array([family_of(v) for v in langs], object)
        families = {f: sorted(set(lang[family == f].tolist())) for f in sorted(set(family.tolist()))}
        inside = {f: fit_pairs(x[family == f], lang[family == f]) for f in families}
        return cls(families, fit_pairs(x, family), inside)

    def machines(self) -> list[Machine]:
        return self.between + [m for group in self.inside.values() for m in group]


def _chances(classes: list[str], machines: list[Machine], outputs: dict[int, np.ndarray], rows: int):
    """Probability of each class: the mean over its pairs."""
    total = {c: np.zeros(rows) for c in classes}
    for m in machines:
        p = 1 / (1 + np.exp(-np.clip(m.slope * outputs[id(m)] + m.shift, -30, 30)))
        total[m.yes] += p
        total[m.no] += 1 - p
    if len(classes) == 1:
        return np.zeros(rows, int), np.ones(rows)
    table = np.stack([total[c] for c in classes])
    best = table.argmax(0)
    return best, table.max(0) / (len(classes) - 1)


def predict(model: Model, column: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    data, rows = W.utf8(column)
    size = np.diff(rows)
    machines = model.machines()
    outputs = {id(m): np.full(len(size), m.bias) for m in machines}
    for low, high in _runs(rows):
        limits = rows[low : high + 1] - rows[low]
        found, whole = grams(data[rows[low] : rows[high]], limits)
        filled = np.flatnonzero(np.diff(limits) > 0)
        for i in range(len(SIZES)):
            n = np.maximum(np.diff(limits) - SIZES[i] + 1, 0)
            for m in machines:
                value = np.where(whole[i], m.weight[found[i]], np.float32(0))
                if len(filled):
                    sums = np.add.reduceat(value, limits[:-1][filled], dtype=np.float64)
                    outputs[id(m)][low + filled] += sums / np.maximum(n[filled], 1)
    names = list(model.families)
    best, score = _chances(names, model.between, outputs, len(size))
    lang = np.full(len(size), UNKNOWN, object)
    for k, name in enumerate(names):
        own = best == k
        inner, chance = _chances(model.families[name], model.inside[name], outputs, len(size))
        lang[own] = np.array(model.families[name], object)[inner[own]]
        score = np.where(own, score * chance, score)
    return lang.tolist(), score


def is_genuine(model: Model, column: pa.Array, langs: list[str]) -> np.ndarray:
    """Whether each text is more than junk, by the machine of its language."""
    data, rows = W.utf8(column)
    names = sorted(model.genuine)
    kept = np.ones(len(langs), bool)
    if not names:
        return kept
    weight = np.stack([model.genuine[v][0].weight for v in names])
    start = np.stack([model.genuine[v][0].bias - model.genuine[v][1] for v in names])
    number = np.array([names.index(v) if v in model.genuine else -1 for v in langs], int)
    for low, high in _runs(rows):
        limits = rows[low : high + 1] - rows[low]
        size = np.diff(limits)
        found, whole = grams(data[rows[low] : rows[high]], limits)
        own = np.repeat(np.maximum(number[low:high], 0), size)
        filled = np.flatnonzero(size > 0)
        margin = start[np.maximum(number[low:high], 0), np.maximum(np.searchsorted(BANDS, size, "right") - 1, 0)]
        for i in range(len(SIZES)):
            value = np.where(whole[i], weight[own, found[i]], np.float32(0))
            if len(filled):
                sums = np.add.reduceat(value, limits[:-1][filled], dtype=np.float64)
                margin[filled] += sums / np.maximum(size[filled] - SIZES[i] + 1, 1)
        kept[low:high] = (margin >= 0) | (number[low:high] < 0)
    return kept


def _runs(rows: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    low = 0
    while low < len(rows) - 1:
        high = max(low + 1, int(np.searchsorted(rows, rows[low] + most, "right")) - 1)
        yield low, min(high, len(rows) - 1)
        low = high


def sample(rows: DataFrame, sample_size: int = SAMPLE) -> list:
    """About ``sample_size`` rows of ``text, lang`` per language, drawn by a hash of the text."""
    known = rows.where("lang is not null and octet_length(text) between 1 and " + str(SAMPLE_BYTES))
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    if not counts:
        return []
    limit = F.create_map(*(F.lit(v) for r in counts for v in (r["lang"], share_below(sample_size, r["n"]))))
    return known.where(hash32("text") < limit[F.col("lang")]).select("text", "lang").distinct().collect()


def train(
    docs: DataFrame, text: str = "text", lang: str = "lang", sample_size: int = SAMPLE, genuine: bool = False
) -> Model | None:
    """Fit on the given rows; None if they hold nothing to learn from. ``genuine`` adds the machines against junk."""
    drawn = sample(picked(docs, text=text, lang=lang), sample_size)
    drawn = [(r["text"].encode(), r["lang"]) for r in drawn if _LETTER.search(r["text"])]
    if not drawn:
        return None
    model = Model.fit(*map(list, zip(*sorted(drawn))))
    for name in sorted({v for _, v in drawn}) if genuine else ():
        fitted = fit_genuine([t.decode() for t, v in sorted(drawn) if v == name], name)
        if fitted is not None:
            model.genuine[name] = fitted
    return model


def _scorer(model: Model | None, at: int, schema: pa.Schema):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for low, high in W.batches(batch.column(at)):
                part = batch.slice(low, high - low)
                texts = part.column(at)
                lettered = [bool(t and _LETTER.search(t)) for t in texts.to_pylist()]
                langs, scores = predict(model, texts) if model else ([UNKNOWN] * len(texts), np.zeros(len(texts)))
                if model and model.genuine:
                    lettered = (np.array(lettered, bool) & is_genuine(model, texts, langs)).tolist()
                langs = [v if ok else UNKNOWN for v, ok in zip(langs, lettered)]
                scores = np.where(np.array(lettered, bool) & (model is not None), scores, 0.0)
                columns = [c for i, c in enumerate(part.columns)]
                yield pa.record_batch([*columns, pa.array(langs), pa.array(scores)], names=schema.names)

    return run


def identify(
    docs: DataFrame, model: Model | None, text: str = "text", lang: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """The rows with two more columns, which must not be among the given ones."""
    clash = {lang.lower(), score.lower()} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are there already; name others")
    names = [*docs.columns, lang, score]
    inner = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    more = inner.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    schema = pa.schema([(n, pa.null()) for n in more.names])
    return inner.mapInArrow(_scorer(model, docs.columns.index(text), schema), more).toDF(*names)
