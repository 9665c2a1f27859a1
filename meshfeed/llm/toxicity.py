"""Toxicity by multiple-instance learning: sentence scores, a noisy-or, document labels."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshfeed.llm.arrow_text import (
    LOWER,
    SMALL_SLICE_BYTES,
    WORD,
    class_table,
    map_texts,
    restored,
    run_hashes,
    runs,
    same_pieces,
    schema_with,
    set_aside,
    sliced,
    text_bytes,
    with_columns,
    without,
)
from meshfeed.session import stage

#: Labelled documents that the model is fitted on at most, half of each label where there are as many,
#: and the longest text among them in bytes. They bound what goes to the driver.
SAMPLE_ROWS, SAMPLE_TEXT_BYTES = 8000, 1 << 16

#: What a toxic document counts in the fit against a clean one: more finds more and rejects more.
TOXIC_WEIGHT = 3.0

#: Steps and step size of the fit, and the weight decay that keeps chance words near zero.
STEPS, RATE, DECAY = 600, 0.1, 1e-5

#: A feature is chosen if it is in so many toxic rows of the sample and its chi-squared (one degree of
#: freedom) is far above chance for the number of words tried.
LEAST_ROWS, LEAST_CHI = 4, 25.0

_PREFIXES = (3, 4, 5, 6, 7, 8)
_WHOLE = np.uint64(0x5851F42D4C957F2D)
_SENTENCE_END = class_table(b".!?\n", False)
_ASCII_UPPER, _ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_OFFENDING = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
ADDED = {"toxicity": "double", "offending": "array<struct<start:bigint,end:bigint,score:double>>"}


@dataclass(frozen=True)
class Model:
    """A sentence is toxic with probability sigmoid(bias + weights of its features); a document is,
    unless all its sentences are not and the leak (labels with no sentence to blame) is not at work.

    A feature is a word, written with a space after it, or the first 3 to 8 characters of a word,
    for the languages whose words take endings.
    """

    features: list[str]
    weights: np.ndarray
    bias: float
    leak: float

    def table(self) -> Features:
        data, cuts = text_bytes(pa.array([f.rstrip(" ") for f in self.features], pa.string()))
        pieces = np.stack([cuts[:-1], cuts[1:]], axis=1)
        whole = np.array([f.endswith(" ") for f in self.features], bool)
        hashes = run_hashes(data, cuts[:-1], cuts[1:]) ^ np.where(whole, _WHOLE, np.uint64(0))
        order = np.argsort(hashes)
        seen = np.zeros(1 << 16, bool)
        seen[(hashes & np.uint64(0xFFFF)).astype(np.int64)] = True
        return Features(hashes[order], seen, data, pieces[order], np.asarray(self.weights)[order])


@dataclass(frozen=True)
class Features:
    """A model's features sorted by hash; ``seen`` marks the low bits of the hashes."""

    hashes: np.ndarray
    seen: np.ndarray
    data: np.ndarray
    pieces: np.ndarray
    weights: np.ndarray


def _sentences(data: np.ndarray, cuts: np.ndarray, table: Features) -> tuple[np.ndarray, ...]:
    """Sentences with a word: first word and document of each; starts and ends of words; and the
    distinct pairs of a sentence and a feature in it."""
    low = LOWER[data]
    starts, ends, first = runs(WORD[low], cuts)
    breaks = np.cumsum(_SENTENCE_END[data])
    doc = np.repeat(np.arange(len(cuts) - 1), np.diff(first))
    mark = breaks[starts] if len(starts) else np.zeros(0, np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (mark[1:] != mark[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(new)
    sentence = np.cumsum(new) - 1
    chars = np.flatnonzero((data & 0xC0) != 0x80)
    char = np.searchsorted(chars, starts)
    chars = np.concatenate([chars, np.full(max(_PREFIXES) + 1, len(data))])
    n = len(table.hashes)
    pairs = [np.zeros(0, np.int64)]
    for size in (None, *_PREFIXES) if n else ():
        stop = ends if size is None else chars[char + size]
        words = np.flatnonzero(stop <= ends)
        hashes = run_hashes(low, starts[words], stop[words])
        if size is None:
            hashes = hashes ^ _WHOLE
        maybe = np.flatnonzero(table.seen[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        place = np.minimum(np.searchsorted(table.hashes, hashes[maybe]), n - 1)
        hit = table.hashes[place] == hashes[maybe]
        words, place = words[maybe[hit]], place[hit]
        pieces = np.stack([starts, stop], axis=1)
        same = same_pieces(low, pieces, words, table.data, table.pieces, place)
        pairs.append(sentence[words[same]] * n + place[same])
    pairs = np.unique(np.concatenate(pairs))
    return head, doc[head], starts, ends, pairs // max(1, n), pairs % max(1, n)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _training_rows(features: list[str], text: str):
    """Of each row: how many sentences have no feature, and the others' features."""
    table = Model(features, np.arange(len(features)), 0, 0).table

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = table()
        for rows, data, cuts in sliced(batches, text, SMALL_SLICE_BYTES):
            head, doc, _, _, sentence, place = _sentences(data, cuts, known)
            number = known.weights[place].astype(np.int64)
            touched = np.unique(sentence)
            plain = np.bincount(doc, minlength=rows.num_rows) - np.bincount(doc[touched], minlength=rows.num_rows)
            lists: list[list[int]] = [[] for _ in range(rows.num_rows)]
            last = None
            for s, f in zip(sentence.tolist(), number.tolist(), strict=True):
                lists[doc[s]] += [f] if s == last else [-1, f]  # -1 opens a sentence
                last = s
            toxic = rows.column(rows.schema.get_field_index("toxic"))
            yield pa.RecordBatch.from_arrays(
                [toxic, pa.array(plain), pa.array(lists, pa.list_(pa.int32()))], ["toxic", "plain", "words"]
            )

    return run


def _fit_weights(
    rows: list[tuple[int, int, list[int]]], n_features: int, by_label: tuple[float, float] = (1.0, 1.0)
) -> tuple[np.ndarray, float, float]:
    """Adam on the likelihood of the documents' labels under the noisy-or with a leak. A row counts as
    ``by_label`` says for its label, so that a sample with more of one label has the rates of all rows."""
    y = np.array([r[0] for r in rows], float)
    counts = np.array([by_label[r[0]] for r in rows])
    counts /= counts.mean()
    plain = np.array([r[1] for r in rows], float)
    flat = np.array([w for r in rows for w in r[2]], np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r[2]) for r in rows])
    opens = flat < 0
    doc = owner[opens]  # of each sentence with known words
    sentence = (np.cumsum(opens) - 1)[~opens]
    word = flat[~opens]
    value = np.concatenate([np.zeros(n_features), [-6.0, -4.0]])  # weights, bias, leak
    mean, square = np.zeros_like(value), np.zeros_like(value)
    for step in range(1, STEPS + 1):
        weights, bias, leak = value[:-2], value[-2], _sigmoid(value[-1])
        z = bias + np.bincount(sentence, weights[word], minlength=len(doc))
        p, p0 = _sigmoid(z), _sigmoid(bias)
        clean = np.log1p(-leak) + plain * np.log1p(-p0) + np.bincount(doc, np.log1p(-p), minlength=len(y))
        rest = np.exp(np.minimum(clean, -1e-9))
        slope = counts * (y * rest / (1 - rest) - (1 - y)) / len(y)  # of the loss, by log(clean)
        by_z = -p * slope[doc]
        grad = np.concatenate(
            [
                np.bincount(word, by_z[sentence], minlength=n_features) + DECAY * weights,
                [by_z.sum() - p0 * (slope * plain).sum(), -leak * slope.sum()],
            ]
        )
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad**2
        value -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return value[:-2], float(value[-2]), float(_sigmoid(value[-1]))


def _beginnings(words: Column, n: int) -> Column:
    return F.transform(F.filter(words, lambda w: F.length(w) >= n), lambda w: F.substring(w, 1, n))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    sample_text_bytes: int = SAMPLE_TEXT_BYTES,
    toxic_weight: float = TOXIC_WEIGHT,
) -> Model:
    """Fits sentence scores to document labels.

    ``held_out`` is a condition on ``labels`` whose rows are not learned from. Of the other labelled
    documents at most ``sample_rows`` are drawn by a hash of the id, as many of either label as there are
    up to half, without texts of over ``sample_text_bytes``; the fit weighs the labels by their numbers
    among all, label 1 ``toxic_weight`` times. The features are all those whose presence raises a label's odds in the sample beyond
    chance (chi-squared). Null labels, ids and texts are left out; of repeated labels of an id the
    highest counts, of repeated texts the first in text order. Without rows of both labels nothing
    can be learned: no features, and the leak is the rate of label 1.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    if held_out is not None:
        known = known.where(~held_out)
    known = known.groupBy(F.col(doc_id).alias("id")).agg(F.max(F.col(label).cast("int")).alias("toxic"))
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    texts = texts.where(F.col("text").isNotNull() & (F.octet_length("text") <= sample_text_bytes))
    totals = {r.toxic: r["count"] for r in known.where("toxic in (0, 1)").groupBy("toxic").count().collect()}
    fewer = min(totals.get(0, 0), totals.get(1, 0), sample_rows // 2)
    quota = {t: min(n, sample_rows - fewer) for t, n in totals.items()}
    drawn = [
        known.where(F.col("toxic") == t).orderBy(F.xxhash64("id", F.lit(7)), "id").limit(n) for t, n in quota.items()
    ]
    if not drawn:
        return Model([], np.zeros(0), -35.0, 0.0)
    ids = F.broadcast(reduce(DataFrame.union, drawn))  # at most sample_rows
    sample = texts.join(ids, "id").groupBy("id", "toxic").agg(F.min("text").alias("text"))
    sample = stage(sample.select("text", "toxic"), "toxicity-sample")
    ones, zeros = sample.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    if not ones or not zeros:
        return Model([], np.zeros(0), -35.0, ones / (ones + zeros) if ones + zeros else 0.0)
    parts = F.split(F.translate("text", _ASCII_UPPER, _ASCII_LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = F.filter(F.array_distinct(parts), lambda w: w != "")
    beginnings = [_beginnings(words, n) for n in _PREFIXES]
    features = F.array_distinct(F.concat(F.transform(words, lambda w: F.concat(w, F.lit(" "))), *beginnings))
    words = sample.select("toxic", F.explode(features).alias("word"))
    a, b = F.col("ones") * 1.0, F.col("zeros") * 1.0
    margin = (a + b) * (F.lit(float(ones + zeros)) - a - b) * float(ones) * float(zeros)
    lean = a * zeros - b * ones  # above zero: label 1 is likelier with the feature
    chi = lean * F.abs(lean) * float(ones + zeros) / F.greatest(margin, F.lit(1.0))
    best = (
        words.groupBy("word")
        .agg(F.sum("toxic").alias("ones"), F.sum(1 - F.col("toxic")).alias("zeros"))
        .where(F.col("ones") >= LEAST_ROWS)
        .select("word", chi.alias("chi"))
        .where(F.col("chi") >= LEAST_CHI)
        .orderBy(F.desc("chi"), "word")
    )
    # a sample row has at most sample_text_bytes of features, so there are boundedly many
    chosen = [r.word for r in best.collect()]
    rows = map_texts(sample, _training_rows(chosen, "text"), "toxic int, plain bigint, words array<int>").collect()
    by_label = (totals[0] / quota[0], toxic_weight * totals[1] / quota[1])
    weights, bias, leak = _fit_weights(rows, len(chosen), by_label)
    return Model(chosen, weights, bias, leak)


def score(docs: DataFrame, model: Model, text: str = "text", offending_from: float = 0.3) -> DataFrame:
    """``docs`` with ``toxicity``, the noisy-or over the sentences of the whole text, and ``offending``: start,
    end (code points, end exclusive) and score of each sentence of at least ``offending_from``.

    Sentences end at ``. ! ?`` and line ends and have a word. A null or empty text has none, so its
    score is the leak. No shuffle; columns of the added names are replaced.
    """
    docs = without(docs, *ADDED)
    shared = docs.sparkSession.sparkContext.broadcast((model.table(), model.bias, model.leak))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias, leak = shared.value
        quiet = float(np.log1p(-_sigmoid(bias)))
        for rows, data, cuts in sliced(batches, text, SMALL_SLICE_BYTES):
            head, doc, starts, ends, owner, feature = _sentences(data, cuts, table)
            touched, back = np.unique(owner, return_inverse=True)
            p = _sigmoid(bias + np.bincount(back, table.weights[feature], minlength=len(touched)))
            clean = np.log1p(-leak) + quiet * np.bincount(doc, minlength=rows.num_rows)
            clean += np.bincount(doc[touched], np.log1p(-p) - quiet, minlength=rows.num_rows)
            offending: list[list[dict]] = [[] for _ in range(rows.num_rows)]
            bad = np.flatnonzero(p >= offending_from)
            last = np.append(head[1:], len(starts)) - 1
            for d in np.unique(doc[touched[bad]]):
                chars = np.cumsum((data[cuts[d] : cuts[d + 1]] & 0xC0) != 0x80)
                for k in bad[doc[touched[bad]] == d]:
                    a, b = starts[head[touched[k]]] - cuts[d], ends[last[touched[k]]] - cuts[d]
                    offending[d].append({"start": int(chars[a]) - 1, "end": int(chars[b - 1]), "score": float(p[k])})
            yield with_columns(
                rows,
                toxicity=pa.array(1 - np.exp(clean), pa.float64()),
                offending=pa.array(offending, _OFFENDING),
            )

    return map_texts(docs, run, schema_with(docs, **ADDED))


def drop_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The documents that score less than ``threshold``, columns unchanged."""
    renamed, now = set_aside(docs, *ADDED)
    found = score(renamed, model, now.get(text, text)).where(F.col("toxicity") < threshold)
    return restored(found, docs.columns, now)
