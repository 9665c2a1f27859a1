"""Importance resampling towards a target text: hashed n-grams, Gumbel noise, the best share."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meshfeed.llm.arrow_text import LOWER, WORD, fresh, map_texts, runs, schema_with, sliced, with_columns, without
from meshfeed.session import stage

#: Words whose running values are numbers of Python at once, and n-grams looked at together.
_CHUNK = 1 << 17

#: Columns that :func:`weigh` adds.
ADDED = {"n_words": "bigint", "n_features": "bigint", "weight": "bigint"}


@lru_cache(maxsize=1)
def _byte_steps() -> np.ndarray:
    """What each byte value contributes to a CRC-32 that moves on by one byte."""
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & 1, (steps >> 1) ^ np.uint32(0xEDB88320), steps >> 1).astype(np.uint32)
    return steps


def _past_zero(crc: np.ndarray) -> np.ndarray:
    return _byte_steps()[crc & np.uint32(255)] ^ (crc >> np.uint32(8))


def _looked_up(table: np.ndarray, amount, crc: np.ndarray) -> np.ndarray:
    parts = [table[amount, n, (crc >> np.uint32(8 * n)) & np.uint32(255)] for n in range(4)]
    return parts[0] ^ parts[1] ^ parts[2] ^ parts[3]


@lru_cache(maxsize=4)
def _shift_table(level: int) -> np.ndarray:
    """``[amount, n, value]``: byte n of a CRC moved past ``amount`` * 256**level zero bytes. Moving is
    linear over GF(2), so a CRC's four bytes are looked up and added (exclusive-or)."""
    table = np.empty((256, 4, 256), np.uint32)
    table[0] = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]
    for amount in range(1, 256):
        before = table[amount - 1]
        if level == 0:
            table[amount] = _past_zero(before)
        else:
            lower = _shift_table(level - 1)
            table[amount] = _looked_up(lower, 1, _looked_up(lower, 255, before))
    return table


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Each CRC moved past ``length`` zero bytes."""
    level = 0
    while length.any():
        crc = _looked_up(_shift_table(level), length & 255, crc)
        length, level = length >> 8, level + 1
    return crc


@dataclass(frozen=True)
class Running:
    """The words of some texts, joined by one space, and the CRC-32 of all that precedes each
    word's first byte and of all up to its last one."""

    starts: np.ndarray
    ends: np.ndarray
    before: np.ndarray
    after: np.ndarray
    #: number of each text's first word, one more entry than texts
    first: np.ndarray

    def crcs(self, word: np.ndarray, n: int) -> np.ndarray:
        """CRC-32 of the ``n`` words from each ``word`` on: the part before it is moved past the n-gram
        and cancelled from the value at its end."""
        last = word + n - 1
        return self.after[last] ^ shifted(self.before[word], self.ends[last] - self.starts[word])


def running(data: np.ndarray, cuts: np.ndarray) -> Running:
    """Scans the lower-cased words of a batch of texts once."""
    begin, end, first = runs(WORD[LOWER[data]], cuts)
    lengths = end - begin
    starts = np.cumsum(lengths + 1) - lengths  # the separator stands before a word
    spaced = np.full(int((lengths + 1).sum()), 32, np.uint8)
    inside = np.arange(int(lengths.sum())) + np.repeat(np.arange(1, len(begin) + 1), lengths)
    spaced[inside] = LOWER[data][WORD[LOWER[data]]]
    after = np.empty(len(begin), np.uint32)
    view, value = memoryview(spaced), 0
    for k in range(0, len(begin), _CHUNK):
        a, b = (starts[k : k + _CHUNK] - 1).tolist(), (starts + lengths)[k : k + _CHUNK].tolist()
        pieces = (view[i:j] for i, j in zip(a, b, strict=True))
        values = accumulate(pieces, lambda crc, piece: crc32(piece, crc), initial=value)
        next(values)
        after[k : k + len(a)] = np.fromiter(values, np.uint32, len(a))
        value = int(after[k + len(a) - 1])
    # from the end of the word before it, over the space
    full = np.uint32(0xFFFFFFFF)
    state = np.concatenate([np.zeros(1, np.uint32), after])[: len(after)] ^ full
    before = _past_zero(state ^ np.uint32(32)) ^ full
    return Running(starts, starts + lengths, before, after, first)


def feature_counts(words: np.ndarray, least: int, most: int) -> np.ndarray:
    return sum(np.maximum(words - n + 1, 0) for n in range(least, most + 1))


def features(
    data: np.ndarray, cuts: np.ndarray, least: int, most: int, buckets: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text number and bucket of every run of ``least`` to ``most`` consecutive words, in chunks."""
    scan = running(data, cuts)
    words = np.diff(scan.first)
    for n in range(least, most + 1):
        grams = np.maximum(words - n + 1, 0)
        ends = np.cumsum(grams)
        for k in range(0, int(ends[-1]) if len(ends) else 0, _CHUNK):
            place = np.arange(k, min(k + _CHUNK, int(ends[-1])))
            text = np.searchsorted(ends, place, "right")
            word = place - (ends - grams)[text] + scan.first[text]
            yield text, scan.crcs(word, n).astype(np.int64) % buckets


def bucket_counts(texts: DataFrame, text: str = "text", least: int = 1, most: int = 1, buckets: int = 10000) -> DataFrame:
    """``bucket``, ``n``: how many n-grams of all whole texts fall into each bucket (those with any).

    Every task adds up its own texts first, so the shuffle carries at most ``buckets`` rows of each.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, data, cuts in sliced(batches, "text"):
            for _, found in features(data, cuts, least, most, buckets):
                total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    slim = texts.select(F.col(f"`{text.replace('`', '``')}`").alias("text"))
    return map_texts(slim, run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Model:
    """How much a feature of each bucket speaks for the target, in thousandths, rounded down."""

    least: int
    most: int
    gains: np.ndarray


def fit(
    docs: DataFrame,
    target: DataFrame,
    text: str = "text",
    target_text: str = "text",
    least: int = 1,
    most: int = 1,
    buckets: int = 10000,
) -> Model:
    """Logarithms of the ratio of both tables' bucket shares, one added to each count.

    All whole texts of both tables are counted; the driver gets one number for each bucket. Null and
    empty texts add nothing; two empty tables give gains of 0.
    """
    if not 1 <= least <= most:
        raise ValueError("at least one word, and no more than the most")
    counts = []
    for table, name in ((docs, text), (target, target_text)):
        found = np.zeros(buckets, np.int64)
        for row in bucket_counts(table, name, least, most, buckets).collect():
            found[row.bucket] = row.n
        counts.append(found)
    raw, goal = (float(c.sum() + buckets) for c in counts)
    gains = [
        math.floor(1000 * math.log(float(t + 1) * raw / (float(s + 1) * goal)))
        for s, t in zip(counts[0].tolist(), counts[1].tolist(), strict=True)
    ]
    return Model(least, most, np.array(gains, np.int64))


def weigh(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_features`` and ``weight``, the sum of the gains of all features of
    the whole text (0 if there is none). Columns of these names are replaced. No shuffle.

    A text is scanned once: the CRC-32 of any n-gram follows from the running values at its two ends.
    Null and empty texts have no words.
    """
    out = without(docs, *ADDED)
    shared = out.sparkSession.sparkContext.broadcast(model.gains)
    least, most, buckets = model.least, model.most, len(model.gains)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, cuts in sliced(batches, text):
            weight = np.zeros(rows.num_rows, np.int64)
            for of, found in features(data, cuts, least, most, buckets):
                np.add.at(weight, of, shared.value[found])
            words = np.diff(runs(WORD[LOWER[data]], cuts)[2])
            yield with_columns(
                rows,
                n_words=pa.array(words, pa.int64()),
                n_features=pa.array(feature_counts(words, least, most), pa.int64()),
                weight=pa.array(weight),
            )

    return map_texts(out, run, schema_with(out, **ADDED))


def noisy_score(doc_id: str, weight: str, seed: int) -> Column:
    """``weight`` plus Gumbel noise in thousandths, rounded down; the noise follows from seed and id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((drawn + 0.5) / F.lit(4294967296.0))))
    return F.col(weight) + noise.cast("bigint")


def ranked(scored: DataFrame, percent: int, eligible: Column, order: list[Column], rank: str = "rank") -> DataFrame:
    """All rows of ``scored`` with ``rank``: 1, 2, 3, ... for the first ``percent`` of a hundred of the
    ``eligible`` rows (rounded down) by ``order``, null for all others.

    Rows are written under a unique number, which ends the sort key, so that no set of equal rows is
    more than one range; then each task's part of the sorted table is counted, and sums over those
    counts, one row for each part, give every row its rank.
    """
    number, part, place = (fresh(scored, n) for n in ("row_number_", "sorted_part", "sorted_place"))
    chosen = F.coalesce(eligible, F.lit(False))
    rows = stage(
        scored.withColumn(rank, chosen).withColumn(number, F.monotonically_increasing_id()), "scored"
    )
    sorted_ = rows.where(F.col(rank)).orderBy(*order, number).withColumn(place, F.monotonically_increasing_id())
    sorted_ = stage(
        sorted_.withColumn(part, F.shiftright(place, 33)).withColumn(place, F.col(place).bitwiseAND((1 << 33) - 1)),
        "ranked",
    )
    counts = sorted_.groupBy(part).agg(F.count("*").alias("size"))
    quota = F.lit((counts.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] * percent) // 100)
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    bases = counts.select(part, F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"))
    at = F.col("base") + F.col(place) + 1
    columns = [c for c in scored.columns if c != rank]
    drawn = sorted_.join(F.broadcast(bases), part).select(*columns, F.when(at <= quota, at).alias(rank))
    others = rows.where(~F.col(rank)).select(*columns, F.lit(None).cast("bigint").alias(rank))
    return drawn.unionByName(others)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    least: int = 1,
    most: int = 1,
    buckets: int = 10000,
    least_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """The documents drawn without replacement towards the distribution of ``target``: ``percent`` of
    a hundred of those with ``least_words`` words, columns unchanged.

    Scores are exact sums of hashed n-gram gains plus Gumbel noise, so the best ones are a draw by
    weight. Ties go to the smaller id (null last); of rows equal in id and score any may be the
    last to be drawn. Documents with fewer words, null and empty texts are never drawn.

    Only numbers are sorted. Texts are written once with their scores; those at or above the last
    score drawn are joined with their ranks.
    """
    number, score, words = (fresh(docs, n) for n in ("row_of_input", "score_of_row", "words_of_row"))
    model = fit(docs, target, text, target_text, least, most, buckets)
    slim = docs.select("*")
    taken = [c for c in docs.columns if c.lower() in ADDED]
    renamed = {c: fresh(docs, f"{c}_of_input") for c in taken}
    weighed = weigh(slim.withColumnsRenamed(renamed), model, renamed.get(text, text))
    scored = weighed.withColumn(score, noisy_score(renamed.get(doc_id, doc_id), "weight", seed))
    rows = stage(
        scored.withColumn(words, F.col("n_words")).drop(*ADDED).withColumn(number, F.monotonically_increasing_id()),
        "resample",
    )
    key = F.col(renamed.get(doc_id, doc_id))
    places = ranked(
        rows.select(number, score, words, key.alias("id")),
        percent,
        F.col(words) >= least_words,
        [F.desc(score), F.asc_nulls_last("id")],
    ).where("rank is not null")
    places = stage(places.select(number, F.col(score).alias("drawn_score")), "drawn")
    last = places.agg(F.min("drawn_score")).first()[0]
    if last is None:
        return docs.limit(0)
    drawn = rows.where(F.col(score) >= last).join(places.select(number), number, "left_semi")
    back = {v: k for k, v in renamed.items()}
    return drawn.drop(number, score, words).withColumnsRenamed(back).select(*docs.columns)
