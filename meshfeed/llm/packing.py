"""Best-fit packing of tokenized documents into sequences, large items first."""

from __future__ import annotations

import os
import re
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator, Mapping
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meshfeed.llm.arrow_text import (
    fresh,
    gather,
    map_texts,
    schema_with,
    sliced,
    with_columns,
    without,
)
from meshfeed.session import stage

#: Distinct words whose ids a task keeps from one batch to the next.
WORD_CACHE = 150_000
#: Words encoded in one call.
_WORDS_A_CALL = 400

# letters, numbers and white space up to U+024F as the vocabulary file's pattern sees them
_LETTERS = "a-zªµºß-öø-ɏ"
_NUMBERS = "0-9²³¹¼½¾"
_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+")
#: Characters that the quick way does not know for certain; also a special token's opening.
_UNUSUAL = re.compile("[^\t\n\r -~\xa0-įı-ɏ‐-‧‰-›€™]|<\\|")


class WordTokenizer:
    """Ids of texts by a vocabulary of words with word ends (``word_bpe_49k.json``).

    Texts of usual characters are cut into words by a pattern; each distinct word is encoded once
    and kept. Others go through the tokenizer whole. Both give the tokenizer's own ids.
    """

    def __init__(self, path: str) -> None:
        # tasks are parallel already, and threads' memory pools add up
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.path = path
        self.words = Tokenizer.from_file(path)
        self.words.normalizer = None
        self.words.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.words.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.forget()

    @cached_property
    def whole(self):
        """The tokenizer as it is."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.cuts = np.zeros(1, np.int64)

    def _learn(self, words: list[str]) -> None:
        calls = [" ".join(words[k : k + _WORDS_A_CALL]) for k in range(0, len(words), _WORDS_A_CALL)]
        coded = self.words.encode_batch_fast(calls, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(e.ids for e in coded), np.uint32)
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words):
            raise ValueError("the vocabulary does not end every word")
        for word in words:
            self.place[word] = len(self.place)
        self.cuts = np.concatenate([self.cuts, ends + self.cuts[-1]])
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and each text's offset in them (one more than texts)."""
        if len(self.place) > WORD_CACHE:
            self.forget()
        quick = [_UNUSUAL.search(t) is None for t in texts]
        words = [_WORD.findall(t.lower()) if q else [] for t, q in zip(texts, quick, strict=True)]
        new = set(chain.from_iterable(words)).difference(self.place)
        if new:
            self._learn(list(new))
        n_words = np.fromiter(map(len, words), np.int64, len(words))
        place = self.place
        which = np.fromiter((place[w] for w in chain.from_iterable(words)), np.int64, int(n_words.sum()))
        at, n_ids = gather(self.cuts, which)
        ids = self.ids[at]
        sums = np.concatenate([[0], np.cumsum(n_ids)])
        first = np.concatenate([[0], np.cumsum(n_words)])
        cuts = sums[first]
        if all(quick):
            return ids, cuts
        slow = [k for k, q in enumerate(quick) if not q]
        coded = {k: np.array(self.whole.encode(texts[k], add_special_tokens=False).ids, np.uint32) for k in slow}
        parts = [coded[k] if k in coded else ids[cuts[k] : cuts[k + 1]] for k in range(len(texts))]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


@lru_cache(maxsize=1)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = 4096,
    end_id: int = 1,
    numbered: tuple[str, str] | None = None,
) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids`` (little-endian 32-bit numbers): each
    document's ids and ``end_id`` after them, cut after every ``capacity`` ids.

    A null or empty text has ``end_id`` alone, so every row gives at least one piece. Special
    tokens' strings in a text are encoded as the tokenizer does. ``numbered`` names two columns more:
    the task, and a piece's number among the task's pieces of its length.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    more = numbered or ()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(capacity + 1, np.int64)
        for rows, _, _ in sliced(batches, "text"):
            texts = [t or "" for t in rows.column(1).to_pylist()]
            ids, cuts = tokenizer(tokenizer_path).encode(texts)
            ids = np.insert(ids, cuts[1:], end_id).astype("<u4")
            cuts = cuts + np.arange(len(cuts))
            lengths = np.diff(cuts)
            pieces = -(-lengths // capacity)
            owner = np.repeat(np.arange(len(lengths)), pieces)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            size = np.minimum(capacity, lengths[owner] - start)
            ends = np.concatenate([[0], np.cumsum(size)])  # pieces stand in order
            data = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(owner), [None, pa.py_buffer(ends.astype(np.int64) * 4), pa.py_buffer(ids)]
            ).cast(pa.binary())
            columns = [rows.column(0).take(pa.array(owner)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(size), data]
            if more:
                task = np.full(len(owner), TaskContext.get().partitionId(), np.int32)
                columns += [pa.array(task), pa.array(_numbers(size, seen))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids", *more])

    kind = slim.schema["doc_id"].dataType.simpleString()
    kinds = "".join(f", `{n}` {t}" for n, t in zip(more, ("int", "bigint"), strict=False))
    return map_texts(slim, run, f"doc_id {kind}, piece int, start bigint, length bigint, ids binary{kinds}")


def _numbers(sizes: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Each size's number among the equal ones before it; ``seen`` counts those of earlier calls, and is
    brought up to date."""
    counts = np.bincount(sizes, minlength=len(seen))
    order = np.argsort(sizes, kind="stable")
    numbers = np.empty(len(sizes), np.int64)
    numbers[order] = np.arange(len(sizes)) - np.repeat(np.cumsum(counts) - counts, counts)
    numbers += seen[sizes]
    seen += counts
    return numbers


def plan_bins(counts: Mapping[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Bins as (how many, lengths inside), for so many pieces of each length.

    Large items, above a third of the capacity, are matched first: from the longest down, each
    takes the longest other large one that still fits, so a bin has at most two. Smaller ones then
    go, from the longest down, into the smallest gap that holds them, or a new bin. Equal pieces
    are handled together, so the work depends on the number of different lengths, at most
    ``capacity``, not on that of pieces.
    """
    left = {n: c for n, c in counts.items() if c}
    large = sorted(n for n in left if 3 * n > capacity)
    bins: list[list] = []  # how many, lengths
    for n in reversed(large):
        while left.get(n):
            k = bisect_left(large, capacity - n + 1)
            partner = next((m for m in reversed(large[: min(k, len(large))]) if left.get(m)), None)
            if partner is None or (partner == n and left[n] == 1):
                others = [m for m in large[:k] if m != n and left.get(m)]
                partner = others[-1] if others else None
            if partner is None:
                bins.append([left.pop(n), (n,)])
            elif partner == n:
                bins.append([left[n] // 2, (n, n)])
                left[n] %= 2
            else:
                many = min(left[n], left[partner])
                bins.append([many, (n, partner)])
                left[n] -= many
                left[partner] -= many
    gaps: list[tuple[int, int]] = []  # (gap, bin), sorted
    for k, (_, inside) in enumerate(bins):
        insort(gaps, (capacity - sum(inside), k))
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        rest = left[n]
        while rest:
            at = bisect_left(gaps, (n, -1))
            if at == len(gaps):
                bins.append([-(-rest // (capacity // n)), ()])
                insort(gaps, (capacity, len(bins) - 1))
                at = len(gaps) - 1
            gap, k = gaps.pop(at)
            many, inside = bins[k]
            each = min(gap // n, rest)  # best fit puts the next one in the same bin while it fits
            filled = min(many, rest // each)
            bins[k] = [filled, (*inside, *[n] * each)]
            insort(gaps, (gap - each * n, k))
            if filled < many:
                bins.append([many - filled, inside])
                insort(gaps, (gap, len(bins) - 1))
            rest -= filled * each
    return [(many, inside) for many, inside in bins if many and inside]


def _slots(bins: list[tuple[int, tuple[int, ...]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: where runs of its slots begin, and each run's first sequence, offset, and
    how many slots of the run stand in one sequence, one after the other."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for many, inside in bins:
        offset = 0
        k = 0
        while k < len(inside):
            n = inside[k]
            same = 1
            while k + same < len(inside) and inside[k + same] == n:
                same += 1
            runs.setdefault(n, []).append((used.get(n, 0), sequence, offset, same))
            used[n] = used.get(n, 0) + many * same
            offset += n * same
            k += same
        sequence += many
    return {n: tuple(np.array(x, np.int64) for x in zip(*r, strict=True)) for n, r in runs.items()}


def pack(pieces: DataFrame, capacity: int = 4096, length: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: sequences of at most ``capacity`` tokens, filled
    without gaps from 0 on.

    Only the number of pieces of each length goes to the driver, at most ``capacity`` rows, and the
    plan made of it is broadcast: some thousand runs of slots. A piece's slot follows from its
    number among the pieces of its length. Tasks count their own pieces of each length while the
    table is written once; sums over the tasks' counts then say where each task's numbers begin.
    So no length is gathered in one task, however many pieces have it, and a repeated task finds
    its numbers again. A null length or one over the capacity or below 1 is an error; an empty
    table gives no rows. Columns named ``sequence_id`` and ``offset`` are replaced.
    """
    pieces = without(pieces, "sequence_id", "offset")
    part, local = (fresh(pieces, f"pack_{n}") for n in ("part", "local"))
    kinds = schema_with(pieces, **{part: "int", local: "bigint"})
    return _packed(pieces.mapInArrow(_count_within_task(length, part, local), kinds), capacity, length, part, local)


def _packed(numbered: DataFrame, capacity: int, length: str, part: str, local: str) -> DataFrame:
    """:func:`pack` of pieces that have their task's number and their own in it already."""
    counted = stage(numbered, "pieces")
    kept = [n for n in counted.columns if n not in (part, local)]
    before = fresh(counted, "pack_before")
    counts = dict(counted.groupBy(length).count().collect())
    if any(n is None or not 0 < n <= capacity for n in counts):
        raise ValueError(f"a piece has no length from 1 to {capacity}")
    slots = counted.sparkSession.sparkContext.broadcast(_slots(plan_bins(counts, capacity)))
    earlier = Window.partitionBy(length).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = counted.groupBy(part, length).agg(F.count("*").alias(before))
    bases = bases.withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0)))
    rows = counted.join(bases, [part, length])
    rows = rows.withColumn(local, F.col(local) + F.col(before)).select(*kept, local)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, rank = (batch.column(batch.schema.get_field_index(n)).to_numpy() for n in (length, local))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(sizes):
                own = np.flatnonzero(sizes == n)
                begin, first, at, same = slots.value[int(n)]
                run = np.searchsorted(begin, rank[own], "right") - 1
                into = rank[own] - begin[run]
                sequence[own] = first[run] + into // same[run]
                offset[own] = at[run] + into % same[run] * n
            yield with_columns(batch, sequence_id=pa.array(sequence), offset=pa.array(offset))

    kinds = schema_with(rows, sequence_id="bigint", offset="bigint")
    return rows.mapInArrow(place, kinds).drop(local)


def _count_within_task(length: str, part: str, local: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen: dict[int | None, int] = {}
        for batch in batches:
            numbers = []
            for n in batch.column(batch.schema.get_field_index(length)).to_pylist():
                numbers.append(seen.get(n, 0))
                seen[n] = numbers[-1] + 1
            yield with_columns(
                batch,
                **{part: pa.array([task] * batch.num_rows, pa.int32()), local: pa.array(numbers, pa.int64())},
            )

    return run


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = 4096,
    end_id: int = 1,
    content: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Pieces of :func:`token_pieces` with their places by :func:`pack`.

    ``content`` says what is kept of each piece's ``ids``, by default the ids; a digest of them makes
    the stored table small. Repeated rows and ids are packed row by row.
    """
    kept = {"ids": F.col("ids")} if content is None else content
    columns = ["doc_id", "piece", "start", "length", *[c.alias(n) for n, c in kept.items()]]
    plain = token_pieces(docs, tokenizer_path, doc_id, text, capacity, end_id).select(*columns)
    part, local = (fresh(plain, f"pack_{n}") for n in ("part", "local"))
    # numbered by the Python that makes the pieces: a second one behind it would be a worker more for each core
    pieces = token_pieces(docs, tokenizer_path, doc_id, text, capacity, end_id, numbered=(part, local))
    return _packed(without(pieces.select(*columns, part, local), "sequence_id", "offset"), capacity, "length", part, local)
