"""Personal data: base patterns, and boosted trees over the spans of high-recall generators.

Base spans follow fixed patterns and checks and are always reported. Generators propose more and
overlapping spans: addresses written out with "at" and "dot", digit groups with and without a country
code, dotted numbers, also with their dots in brackets or written out. Boosted trees score a proposal by its format and its context. A proposal becomes
a span of its kind if it overlaps no base span and its calibrated probability reaches the kind's
threshold.

There are no labels, so the trees learn from the texts themselves: a proposal that is a base span is an
example, all others are counter-examples, but for written-out addresses and numbers that may well be
some. What gives a base span away is taken from the examples first: a phone loses its plus and country
code, an address its sign and an address or number its dots, which are written out in some way, so that
the shape and the words around it must decide. As texts have few counter-examples of these two kinds,
some are made of each text: its own words around "at" and "dot", versions and numbers out of range. Half of the sample fits the trees, half calibrates: a logistic curve gives probabilities,
and the threshold is the least that keeps the share of true examples among those above it at PRECISION.
A kind without enough examples adds nothing.

The sample is bounded: about SAMPLE documents of at most SAMPLE_BYTES, drawn by a hash of the text, and
for every kind about SAMPLE / 4 more of those that may hold it.
Null and empty texts have no spans. Repeated rows are scanned each. Other columns are ignored, or kept
by ``redact``. An empty table gives an empty result. Positions are code points, the end exclusive.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm import boosting
from wattline.llm import words as W
from wattline.llm.tables import hash32, picked, quoted, share_below

SAMPLE = 2000
SAMPLE_BYTES = 20_000
PRECISION = 0.98
LEAST_EXAMPLES = 30

# The kinds in their order, and the base patterns.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match begins a run of digits: if it fails at the run's start, it fails inside the run as well.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _emails(text: str) -> list[tuple[int, int]]:
    """From each sign: the domain behind it, and the characters in front of it back to the match before."""
    found, done = [], 0
    at = text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                done = domain.end()
                found.append((start, done))
        at = text.find("@", max(at + 1, done))
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))


def _card(text: str) -> bool:
    digits = _digits(text)
    return 16 <= len(digits) <= 19 and luhn(digits)


def _phone(text: str) -> bool:
    return 8 <= len(_digits(text)) <= 15


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by kind, then start."""
    found = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for kind, pattern, check in (("ip", _IP, _ip), ("card", _CARD, _card), ("phone", _PHONE, _phone)):
            if (kind == "ip" and "." not in text) or (kind == "phone" and "+" not in text):
                continue
            found += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if check(m.group())]
    return found


# ---- proposals ----

_SPELLED = re.compile(
    r"[A-Za-z0-9._%+-]{1,64}[ ]?(?:\(at\)|\[at\]| at )[ ]?[A-Za-z0-9-]{1,63}[ ]?(?:\(dot\)|\[dot\]| dot |\.)[ ]?[A-Za-z]{2,}"
    r"(?:(?:[ ]?(?:\(dot\)|\[dot\]| dot )[ ]?|\.)[A-Za-z]{2,63}){0,3}"
)
_GROUPS = re.compile(r"\(?[0-9](?:[ ().-]{0,2}[0-9]){6,}")
_QUAD = re.compile(r"(?<![0-9])[0-9]{1,20}(?:\.[0-9]{1,20}){3,}")
_SPREAD = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:[ ]?(?:\[\.\]|\(\.\)|\[dot\]|\(dot\)| dot | \. )[ ]?[0-9]{1,3}){3}(?![0-9])")
_WORD = re.compile(r"[A-Za-z]{2,20}")
_LABEL = re.compile(r"[A-Za-z]+$")
_ATS = (" at ", " (at) ", "(at)", "[at]", " [at] ")
_DOTS = (" dot ", " (dot) ", "(dot)", "[dot]", " [dot] ")
_POINTS = ("[.]", "(.)", " . ", *_DOTS)
_DOMAINS = frozenset("com org net edu gov info biz io eu uk de fr es it nl ch at example test".split())
_NUMBERED = ("version", "release", "section", "chapter", "kapitel", "build", "firmware")
_HINTS = {
    "email": ("mail", "contact", "write", "kontakt", "correo", "courriel"),
    "ip": ("ip", "host", "server", "addr"),
    "card": ("card", "visa", "karte", "tarjeta", "carte"),
    "phone": ("tel", "phone", "call", "fax", "mobil", "anruf"),
}
BEFORE = 24


@dataclass(frozen=True)
class Proposal:
    kind: str
    start: int
    end: int
    text: str
    before: str
    after: str


def proposals(text: str) -> list[Proposal]:
    """Spans of every generator; they may overlap each other and base spans."""
    spans = []
    if "dot" in text or "(at)" in text or "[at]" in text:
        spans += [("email", m.start(), m.end()) for m in _SPELLED.finditer(text)]
    if _DIGIT.search(text):
        spans += [(k, m.start(), m.end()) for m in _GROUPS.finditer(text) for k in ("card", "phone")]
        spans += [("ip", m.start(), m.end()) for m in _QUAD.finditer(text)]
        if "dot" in text or "[.]" in text or "(.)" in text or " . " in text:
            spans += [("ip", m.start(), m.end()) for m in _SPREAD.finditer(text)]
    return [Proposal(k, a, b, text[a:b], text[max(0, a - BEFORE) : a], text[b : b + 4]) for k, a, b in spans]


def unsure(p: Proposal) -> bool:
    """Whether a proposal beside the base spans may well be personal data by its form."""
    if p.kind == "ip":
        return _SPREAD.fullmatch(p.text) is not None
    label = _LABEL.search(p.text.lower())
    return p.kind == "email" and ("(" in p.text or "[" in p.text or (label is not None and label.group() in _DOMAINS))


def made(text: str, rng: random.Random) -> list[Proposal]:
    """Hard counter-examples: prose around "at" and "dot", versions, numbers out of range."""
    words = [m for _, m in zip(range(200), _WORD.finditer(text))]
    found = []
    for _ in range(2 if len(words) > 2 else 0):
        at = rng.randrange(len(words) - 2)
        a, b, c = words[at : at + 3]
        before, after = text[max(0, a.start() - BEFORE) : a.start()], text[c.end() : c.end() + 4]
        number = str(rng.randrange(1000)) if rng.random() < 0.3 else ""
        own = f"{a.group()}{number}{rng.choice((' at ', *_ATS))}{b.group()}{rng.choice(('. ', '.', *_DOTS))}{c.group()}"
        p = Proposal("email", a.start(), c.end(), own, before, after)
        found += [] if c.group().lower() in _DOMAINS else [p]
        if rng.random() < 0.5:
            before, parts = f"{before}{rng.choice(_NUMBERED)} "[-BEFORE:], [str(rng.randrange(30)) for _ in range(4)]
        else:
            parts = [str(rng.randrange(256)) for _ in range(4)]
            parts[rng.randrange(4)] = str(rng.randrange(256, 1000))
        own = rng.choice((".", *_POINTS)).join(parts)
        found.append(Proposal("ip", a.start(), a.end(), own, before, text[a.end() : a.end() + 4]))
    return found


def examples(text: str) -> list[tuple[Proposal, bool]]:
    """Proposals with a weak label. Base spans lose what gives them away."""
    base = base_spans(text)
    rng = random.Random(zlib.crc32(text.encode(errors="replace")))
    found = []
    for kind, a, b in base:
        own, before, after = text[a:b], text[max(0, a - BEFORE) : a], text[b : b + 4]
        if kind == "phone":
            shorter = re.sub(r"^\+[0-9]{1,3}[ .-]?", "", own) if re.match(r"\+[0-9]{1,3}[ .(-]", own) else own[1:]
            own = shorter or own
        elif kind == "email":
            local, _, domain = own.rpartition("@")
            if rng.random() < 0.5:  # else digits would decide where all addresses have some
                local = re.sub("[^A-Za-z.]", "", local).strip(".") or local
                domain = re.sub("[0-9]", "", ".".join(domain.split(".")[-2:])).strip(".") or domain
            own = local + rng.choice(_ATS) + domain.replace(".", rng.choice((".", *_DOTS)))
        elif kind == "ip":
            own = own.replace(".", rng.choice(_POINTS))
        found.append((Proposal(kind, a, b, own, before, after), True))
    taken = {(k, a) for k, a, _ in base}
    covered = Covered(base)
    found += [(p, False) for p in proposals(text) if (p.kind, p.start) not in taken and covered.free(p.start, p.end) and not unsure(p)]
    found += [(p, False) for p in made(text, rng)]
    # A base span of another kind is a counter-example of the kinds that its digits could be.
    for kind, a, b in base:
        for other in ("card", "phone"):
            if other != kind and kind != "email":
                found.append((Proposal(other, a, b, text[a:b], text[max(0, a - BEFORE) : a], text[b : b + 4]), False))
    return found


def features(p: Proposal) -> list[float]:
    """Format of the span and the characters and words around it."""
    digits = _digits(p.text)
    groups = re.findall(r"[0-9]+", p.text)
    gap = re.sub(r"[0-9A-Za-z]", "", p.text)
    around = p.before.lower()
    low = p.text.lower()
    label = _LABEL.search(low)
    label = label.group() if label else ""
    local = re.split(r" ?[\[(]at[\])]| at ", low, maxsplit=1)[0]
    return [
        len(p.text),
        len(digits),
        len(groups),
        max(map(len, groups), default=0),
        min(map(len, groups), default=0),
        len(groups[-1]) if groups else 0,
        gap.count(" "),
        gap.count("-"),
        gap.count("."),
        gap.count("(") + gap.count(")"),
        len(set(digits)),
        sum(c.isalpha() for c in p.text),
        float(luhn(digits)) if digits else 0.0,
        float(bool(digits) and digits[0] == "0"),
        float(p.before[-1:].isalnum()),
        float(p.after[:1].isalnum()),
        float(p.before[-1:] in (" ", "\n", "")),
        float(any(h in around for h in _HINTS[p.kind])),
        float(sum(c.isdigit() for c in p.before)),
        float(all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or 0) <= 255 for g in groups)),
        float("(at)" in low or "[at]" in low),
        float("(dot)" in low or "[dot]" in low) + 2 * float(" dot " in low),
        float(gap.count("[")),
        float(len(label)),
        float(label in _DOMAINS),
        float(any(c in "._%+-0123456789" for c in local)),
        float(any(h in around for h in _NUMBERED)),
    ]


@dataclass
class Scorer:
    """Trees, logistic curve and threshold of one kind."""

    trees: boosting.Boosted
    slope: float
    shift: float
    threshold: float

    def chance(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.trees.margin(x) + self.shift, -30, 30)))


def fit_scorer(x: np.ndarray, y: np.ndarray, group: np.ndarray) -> Scorer | None:
    """Trees on the rows of group 0, curve and threshold on those of group 1."""
    own, rest = group == 0, group == 1
    if min(y[own].sum(), y[rest].sum(), (1 - y[own]).sum(), (1 - y[rest]).sum()) < LEAST_EXAMPLES:
        return None
    trees = boosting.fit(x[own], y[own])
    margin, target = trees.margin(x[rest]), y[rest]
    slope, shift = 1.0, 0.0
    for _ in range(300):
        error = target - 1 / (1 + np.exp(-np.clip(slope * margin + shift, -30, 30)))
        slope, shift = slope + 0.1 * (error * margin).mean(), shift + 0.1 * error.mean()
    found = Scorer(trees, max(float(slope), 1e-3), float(shift), 2.0)
    p = found.chance(x[rest])
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(target[order]) / np.arange(1, len(order) + 1)
    last = np.append(p[order][1:] < p[order][:-1], True)  # equal chances stand or fall together
    good = np.flatnonzero(last & (right >= PRECISION))
    if len(good):
        found.threshold = float(max(p[order][good[-1]], 0.5))
    return found


def fit(texts: list[str]) -> dict[str, Scorer]:
    rows: dict[str, list] = {k: [] for k in KINDS}
    for number, text in enumerate(sorted(texts)):
        for p, label in examples(text):
            rows[p.kind].append((features(p), float(label), number % 2))
    found = {}
    for kind, seen in rows.items():
        if seen:
            x, y, group = (np.array(c) for c in zip(*seen))
            scorer = fit_scorer(x, y, group)
            if scorer is not None:
                found[kind] = scorer
    return found


_MAY_HOLD = {
    "email": "[A-Za-z0-9._%+-]@[A-Za-z0-9-]+[.][A-Za-z0-9-]",
    "ip": "[0-9][.][0-9]+[.][0-9]+[.][0-9]",
    "card": "[0-9]([ -]?[0-9]){15}",
    "phone": "[+][0-9][ ().0-9-]{7}",
}


def train(docs: DataFrame, text: str = "text", sample_size: int = SAMPLE) -> dict[str, Scorer]:
    """Fit on a bounded sample of the texts that have a digit or an at sign."""
    rows = picked(docs, text=text).where(f"octet_length(text) <= {SAMPLE_BYTES} AND text RLIKE '[0-9@]'")
    holds = [F.lit(True), *(F.col("text").rlike(_MAY_HOLD[k]) for k in KINDS)]
    counts = rows.agg(*(F.count_if(h) for h in holds)).first()
    drawn = F.lit(False)
    for h, n, size in zip(holds, counts, [sample_size, *[sample_size // len(KINDS)] * len(KINDS)]):
        drawn = drawn | (h & (hash32("text") < share_below(size, n)))
    return fit([r["text"] for r in rows.where(drawn).distinct().collect()])


class Covered:
    """Places of a text that spans lie on, as disjoint stretches in order."""

    def __init__(self, spans: list[tuple[str, int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, a, b in sorted(spans, key=lambda s: s[1:]):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def free(self, a: int, b: int) -> bool:
        before = bisect_left(self.starts, b)
        return before == 0 or self.ends[before - 1] <= a

    def add(self, a: int, b: int) -> None:
        """Cover a free stretch."""
        at = bisect_left(self.starts, a)
        self.starts.insert(at, a)
        self.ends.insert(at, b)


def all_spans(text: str, scorers: dict[str, Scorer]) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and base and added spans by kind, then start."""
    base = base_spans(text)
    covered = Covered(base)
    more: list[tuple[float, str, int, int]] = []
    if scorers:
        near = [p for p in proposals(text) if p.kind in scorers and covered.free(p.start, p.end)]
        for kind in {p.kind for p in near}:
            own = [p for p in near if p.kind == kind]
            chance = scorers[kind].chance(np.array([features(p) for p in own]))
            more += [(-c, kind, p.start, p.end) for c, p in zip(chance, own) if c >= scorers[kind].threshold]
    spans = list(base)
    for _, kind, a, b in sorted(more):  # of overlapping ones the surest
        if covered.free(a, b):
            covered.add(a, b)
            spans.append((kind, a, b))
    return base, sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
FOUND = pa.schema([("id", pa.int64()), ("base", pa.list_(SPAN)), ("spans", pa.list_(SPAN))])
FOUND_SQL = ", ".join(f"{c} array<struct<kind:string,start:long,end:long>>" for c in ("base", "spans"))


def _rows(spans: list[tuple[str, int, int]]) -> list[dict]:
    return [{"kind": k, "start": a, "end": b} for k, a, b in spans]


def _finder(scorers: dict[str, Scorer]):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for low, high in W.batches(batch.column(1)):
                part = batch.slice(low, high - low)
                found = [all_spans(t or "", scorers) for t in part.column(1).to_pylist()]
                base, spans = ([_rows(f[k]) for f in found] for k in (0, 1))
                yield pa.record_batch([part.column(0), pa.array(base, pa.list_(SPAN)), pa.array(spans, pa.list_(SPAN))], schema=FOUND)

    return run


def find(docs: DataFrame, scorers: dict[str, Scorer], id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, base, spans`` of every row."""
    rows = picked(docs, id=id, text=text).withColumn("id", F.col("id").cast("long"))
    return rows.mapInArrow(_finder(scorers), f"id long, {FOUND_SQL}")


def redacted(text: str, spans: list[tuple[str, int, int]], mark: Callable[[str], str]) -> str:
    """The text with a mark in place of every span; overlapping spans become one mark, of the first."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], mark(kind)]
        done = max(done, b)
    return "".join([*out, text[done:]])


def _mark(kind: str) -> str:
    return f"[{kind.upper()}]"


def _redactor(scorers: dict[str, Scorer], at: int):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for low, high in W.batches(batch.column(at)):
                part = batch.slice(low, high - low)
                texts = [
                    None if t is None else redacted(t, all_spans(t, scorers)[1], _mark)
                    for t in part.column(at).to_pylist()
                ]
                columns = list(part.columns)
                columns[at] = pa.array(texts, part.column(at).type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return run


def redact(docs: DataFrame, scorers: dict[str, Scorer], text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The rows with every span replaced by its kind; ``length``, if there, follows the text."""
    at = docs.columns.index(text)
    # Under plain names: Spark hands over columns by name, and a name may hold dots.
    inner = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    done = inner.mapInArrow(_redactor(scorers, at), inner.schema).toDF(*docs.columns)
    if length in docs.columns:
        done = done.withColumn(length, F.length(quoted(text)).cast(docs.schema[length].dataType))
    return done
