"""Language identification: the family first, then one-versus-one linear SVMs inside it."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meshfeed.llm.arrow_text import (
    class_table,
    map_texts,
    schema_with,
    sliced,
    text_bytes,
    with_columns,
    without,
)

#: Rows that the machines are fitted on (the same number for each language, drawn by a hash of the id
#: and the text) and the longest text among them in bytes. They bound what goes to the driver.
SAMPLE_ROWS, SAMPLE_TEXT_BYTES = 2400, 1 << 15

#: Buckets of the byte n-grams, steps and step size of the fit, weight decay.
BUCKET_BITS, STEPS, RATE, DECAY = 13, 150, 0.05, 1e-3

#: Families of ISO 639-1 codes. A language that is not listed is its own family.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk",
    "iranian": "fa ku ps tg",
    "indic": "hi bn ur mr gu pa ne si",
    "semitic": "ar he mt am",
    "celtic": "ga cy gd br",
}
UNKNOWN = "und"

_LETTER = class_table(b"abcdefghijklmnopqrstuvwxyz", True)
ADDED = {"lang_pred": "string", "lang_score": "double"}


def family_of(language: str) -> str:
    return next((f for f, members in FAMILIES.items() if language in members.split()), language)


def _ngrams(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the 3- and 4-byte sequences that begin at each letter byte, other bytes seen as one
    space; and where each text's begin (one more than texts)."""
    letter = _LETTER[data]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    kept = np.where(letter, data, 32)[keep].astype(np.uint32)
    cuts = np.concatenate([[0], np.cumsum(keep)])[cuts]
    b = np.concatenate([kept, np.zeros(3, np.uint32)])
    three = b[:-3] << np.uint32(16) | b[1:-2] << np.uint32(8) | b[2:-1]
    four = three << np.uint32(8) | b[3:]
    shift = np.uint32(32 - BUCKET_BITS)
    return three * np.uint32(0x9E3779B1) >> shift, four * np.uint32(0x85EBCA6B) >> shift, cuts


def _ranges(cuts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Begin and end of the whole 3- and of the whole 4-byte sequences of each text."""
    return [(cuts[:-1], np.maximum(cuts[1:] - n + 1, cuts[:-1])) for n in (3, 4)]


@dataclass(frozen=True)
class Machine:
    """One linear SVM: above zero for ``one``, below for ``other``; ``slope`` makes it a probability."""

    one: str
    other: str
    weights: np.ndarray
    bias: float
    slope: float


@dataclass(frozen=True)
class Model:
    """Machines between families, and for each family between its languages."""

    families: dict[str, list[str]]
    between: list[Machine]
    within: dict[str, list[Machine]]

    def machines(self) -> list[Machine]:
        return [*self.between, *(m for f in self.families for m in self.within[f])]


def _sample_vectors(buckets: int):
    """Of each row: the language, and its bucket frequencies as numbers and values."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, cuts in sliced(_lowered(batches, "text"), "text"):
            three, four, cuts = _ngrams(data, cuts)
            places, values = [], []
            for (a, b), (c, d) in zip(*(zip(*r, strict=True) for r in _ranges(cuts)), strict=True):
                v = np.bincount(three[a:b], minlength=buckets) / max(1, b - a)
                v += np.bincount(four[c:d], minlength=buckets) / max(1, d - c)
                at = np.flatnonzero(v)
                places.append(at.astype("<i4").tobytes())
                values.append(v[at].astype("<f4").tobytes())
            language = rows.column(rows.schema.get_field_index("lang"))
            yield pa.RecordBatch.from_arrays(
                [language, pa.array(places, pa.binary()), pa.array(values, pa.binary())], ["lang", "place", "value"]
            )

    return run


def _lowered(batches: Iterable[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index(text)
        lower = pc.utf8_lower(batch.column(at).cast(pa.large_string()))
        yield pa.RecordBatch.from_arrays(
            [lower if k == at else c for k, c in enumerate(batch.columns)], batch.schema.names
        )


def _machine(one: str, other: str, x: np.ndarray, y: np.ndarray) -> Machine:
    """Squared hinge loss by Adam on scaled features, classes weighted alike; then the slope of a
    logistic curve through the margins."""
    spread = x.std(axis=0)
    scale = (1 / (spread + np.median(spread[spread > 0]) if (spread > 0).any() else spread + 1)).astype(np.float32)
    middle = x.mean(axis=0)
    z = (x - middle) * scale
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    mean, square = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, STEPS + 1):
        slack = np.maximum(0, 1 - y * (z @ w + b)) * share * y
        grad = np.append(-2 * (z.T @ slack.astype(np.float32)) + DECAY * w, -2 * slack.sum())
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        move = RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        w, b = w - (move[:-1] / np.sqrt(len(w))).astype(np.float32), b - move[-1] / np.sqrt(len(w))
    margin = y * (z @ w + b)
    slope = max((0.5, 1, 2, 3, 5, 8), key=lambda s: -float((share * np.logaddexp(0, -s * margin)).sum()))
    weights = w * scale
    return Machine(one, other, weights, float(b - middle @ weights), float(slope))


def _pairs(names: list[str], of: np.ndarray, x: np.ndarray) -> list[Machine]:
    machines = []
    for a, b in combinations(names, 2):
        rows = (of == a) | (of == b)
        machines.append(_machine(a, b, x[rows], np.where(of[rows] == a, 1, -1).astype(np.float32)))
    return machines


def fit(
    docs: DataFrame,
    held_out: Column | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
    sample_text_bytes: int = SAMPLE_TEXT_BYTES,
) -> Model:
    """Fits the machines to the labelled documents that ``held_out`` does not name.

    At most ``sample_rows`` different rows (one of each language at least) are drawn by a hash of id and
    text, as many of each language as there are; what comes back of each is a sparse vector. Rows with
    a null text or language, or a text of over ``sample_text_bytes``, are not learned from, and of rows
    equal in id, text and language one is. No rows give a model without languages, one language one
    without machines.
    """
    known = docs if held_out is None else docs.where(F.coalesce(~held_out, F.lit(True)))
    known = known.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    known = known.where(F.col("lang").isNotNull() & (F.octet_length("text") <= sample_text_bytes))
    known = known.withColumn("drawn", F.xxhash64("id", "text", F.lit(11)))
    counts = dict(known.groupBy("lang").agg(F.approx_count_distinct("drawn", 0.02)).collect())
    if not counts:
        return Model({}, [], {})
    each = max(1, sample_rows // len(counts))
    # half more different rows than are kept: the sort of one language is over few
    rate = F.create_map(*[F.lit(v) for n, c in counts.items() for v in (n, int(min(1.0, 1.5 * each / c) * (1 << 30)))])
    drawn = known.where(F.pmod("drawn", F.lit(1 << 30)) < rate[F.col("lang")]).distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("drawn", "id", "text"))
    drawn = drawn.withColumn("place", place).where(F.col("place") <= each)
    buckets = 1 << BUCKET_BITS
    rows = (
        drawn.select("lang", "text")
        .mapInArrow(_sample_vectors(buckets), "lang string, place binary, value binary")
        .collect()
    )
    x = np.zeros((len(rows), buckets), np.float32)
    for k, row in enumerate(rows):
        x[k, np.frombuffer(row.place, "<i4")] = np.frombuffer(row.value, "<f4")
    language = np.array([r.lang for r in rows], object)
    families: dict[str, list[str]] = {}
    for name in sorted(set(language)):
        families.setdefault(family_of(name), []).append(name)
    family = np.array([family_of(n) for n in language], object)
    return Model(
        families,
        _pairs(sorted(families), family, x),
        {f: _pairs(members, language, x) for f, members in families.items()},
    )


def _shares(names: list[str], machines: list[Machine], margins: np.ndarray) -> np.ndarray:
    """Each name's share of the pairwise probabilities, one row for each text."""
    if len(names) == 1:
        return np.ones((len(margins), 1))
    votes = np.zeros((len(margins), len(names)))
    for k, m in enumerate(machines):
        p = 1 / (1 + np.exp(-np.clip(m.slope * margins[:, k], -50, 50)))
        votes[:, names.index(m.one)] += np.log(p + 1e-12)
        votes[:, names.index(m.other)] += np.log(1 - p + 1e-12)
    votes = np.exp((votes - votes.max(axis=1, keepdims=True)) / max(1, len(names) - 1))
    return votes / votes.sum(axis=1, keepdims=True)


def _decide(model: Model, margins: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The best language of the best family for each text, and the product of the two shares. Of equal
    shares the first name in order wins."""
    names = sorted(model.families)
    share = _shares(names, model.between, margins)
    best = share.argmax(axis=1)
    score = share[np.arange(len(share)), best]
    language = np.empty(len(margins), object)
    at = len(model.between)
    for f, members in model.families.items():
        machines = model.within[f]
        rows = np.flatnonzero(best == names.index(f))
        inner = _shares(members, machines, margins[rows, at : at + len(machines)])
        language[rows] = np.array(members, object)[inner.argmax(axis=1)]
        score[rows] *= inner.max(axis=1)
        at += len(machines)
    return language.tolist(), score


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, a language of the model, and ``lang_score`` from 0 to 1.

    The whole lower-cased text counts: every machine's weights are averaged over all its 3- and
    4-byte sequences. A null text and one without any letter are ``und`` with score 0, as is
    everything if the model knows no language. No shuffle; columns of the added names are replaced.
    """
    docs = without(docs, *ADDED)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        machines = known.machines()
        for rows, _, _ in sliced(batches, text):
            column = rows.column(rows.schema.get_field_index(text)).cast(pa.large_string())
            letters = np.array([t is not None and any(map(str.isalpha, t)) for t in column.to_pylist()], bool)
            if not known.families:
                letters[:] = False
                languages, score = [UNKNOWN] * rows.num_rows, np.zeros(rows.num_rows)
            else:
                three, four, cuts = _ngrams(*text_bytes(pc.utf8_lower(column)))
                margins = np.zeros((rows.num_rows, len(machines)))
                for k, m in enumerate(machines):
                    for grams, (a, b) in zip((three, four), _ranges(cuts), strict=True):
                        total = np.concatenate([[0.0], np.cumsum(m.weights[grams], dtype=np.float64)])
                        margins[:, k] += (total[b] - total[a]) / np.maximum(1, b - a)
                    margins[:, k] += m.bias
                languages, score = _decide(known, margins)
            predicted = [n if ok else UNKNOWN for n, ok in zip(languages, letters, strict=True)]
            yield with_columns(
                rows, lang_pred=pa.array(predicted, pa.string()), lang_score=pa.array(np.where(letters, score, 0.0))
            )

    return map_texts(docs, run, schema_with(docs, **ADDED))
