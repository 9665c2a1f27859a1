"""Arrow string columns as numpy bytes: cutting, words, hashes. Used inside ``mapInArrow`` tasks.

Texts are UTF-8. Every byte of a character beyond ASCII is 0x80 or more, so a class of ASCII
characters can be told byte by byte.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text bytes that a task holds as numpy arrays at once; a longer text is held alone.
SLICE_BYTES = 1 << 20
#: The same where a task holds many numbers for each byte.
SMALL_SLICE_BYTES = 1 << 18

#: Rows that Spark hands to a task's Python at once, instead of its default of 10,000.
BATCH_ROWS = 1000

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def lower_table() -> np.ndarray:
    """Maps each byte to itself, A-Z to a-z."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def class_table(ascii_chars: bytes, above_ascii: bool) -> np.ndarray:
    """True for the given ASCII bytes, and for all bytes of other characters if asked for."""
    table = np.zeros(256, dtype=bool)
    table[list(ascii_chars)] = True
    table[128:] = above_ascii
    return table


LOWER = lower_table()
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing
WORD = class_table(b"0123456789abcdefghijklmnopqrstuvwxyz", True)
#: ``[^\x20\x09-\x0D]``
NOT_SPACE = ~class_table(b" \t\n\x0b\x0c\r", False)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their offsets (one more than rows); null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    cuts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if cuts[-1] == cuts[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[cuts[0] : cuts[-1]], cuts - cuts[0]


def sliced(
    batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row ranges of the batches of at most ``limit`` text bytes (or one row), with their bytes."""
    for batch in batches:
        data, cuts = text_bytes(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(cuts, cuts[at] + limit, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield (
                batch.slice(at, end - at),
                data[cuts[at] : cuts[end]],
                cuts[at : end + 1] - cuts[at],
            )
            at = end


def runs(inside: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of true bytes that do not cross a text's end: starts, ends, and for each text
    the index of its first run (one more entry than texts)."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(cuts), np.int64)
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[cuts[:-1][cuts[:-1] < len(inside)]] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[cuts[1:][cuts[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    return starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, cuts)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    one = np.ones(1, np.uint64)
    return tuple(
        np.cumprod(np.concatenate([one, np.full(n, x & _MASK, np.uint64)])) for x in (_BASE, inverse)
    )


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte run. Equal runs have equal hashes; to tell unequal ones for
    certain, compare the bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = 1 << max(16, int(len(data) - 1).bit_length())
    up, down = _powers(size)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    value = (total[ends] - total[starts]) * down[starts]
    value ^= value >> np.uint64(29)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    value ^= (ends - starts).astype(np.uint64) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(32))


def gather(cuts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the members of lists ``which`` of a table of lists given by ``cuts``, one list
    after the other, and the length of each."""
    lengths = cuts[which + 1] - cuts[which]
    total = int(lengths.sum())
    first = np.repeat(cuts[which] - (np.cumsum(lengths) - lengths), lengths)
    return np.arange(total) + first, lengths


def gather_pieces(pieces: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in pieces (start, end) ``which``, one piece after the other, and their lengths."""
    lengths = pieces[which, 1] - pieces[which, 0]
    first = np.repeat(pieces[which, 0] - (np.cumsum(lengths) - lengths), lengths)
    return np.arange(int(lengths.sum())) + first, lengths


def same_pieces(
    a: np.ndarray, a_pieces: np.ndarray, x: np.ndarray, b: np.ndarray, b_pieces: np.ndarray, y: np.ndarray
) -> np.ndarray:
    """Whether non-empty pieces ``x`` of ``a`` equal pieces ``y`` of ``b``, byte by byte."""
    same = (a_pieces[x, 1] - a_pieces[x, 0]) == (b_pieces[y, 1] - b_pieces[y, 0])
    at = np.flatnonzero(same)
    if len(at):
        i, lengths = gather_pieces(a_pieces, x[at])
        j, _ = gather_pieces(b_pieces, y[at])
        same[at] = ~np.logical_or.reduceat(a[i] != b[j], np.cumsum(lengths) - lengths)
    return same


def with_columns(batch: pa.RecordBatch, **new: pa.Array) -> pa.RecordBatch:
    """The batch with columns added; one of the same name is replaced."""
    kept = [n for n in batch.schema.names if n not in new]
    return pa.RecordBatch.from_arrays(
        [batch.column(n) for n in kept] + list(new.values()), kept + list(new)
    )


def schema_with(df: DataFrame, **new: str) -> str:
    """DDL of ``df`` followed by the columns ``new``; columns of the same names are left out."""
    kept = {f.name: f.dataType.simpleString() for f in df.schema if f.name not in new}
    return ", ".join(f"`{n.replace('`', '``')}` {t}" for n, t in {**kept, **new}.items())


def map_texts(
    df: DataFrame, run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with batches of few rows: a row may hold a long text, and a task holds a batch
    several times over, in the JVM and in Python. A session that sets the number itself keeps it."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(key) == "10000":
        conf.set(key, str(BATCH_ROWS))
    return df.mapInArrow(run, schema)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that an operator is about to add."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns if c.lower() not in gone])


def set_aside(df: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns of these names renamed, and what each of them is called now."""
    taken = {n.lower() for n in names}
    now = {c: fresh(df, f"{c}_of_input") for c in df.columns if c.lower() in taken}
    return df.withColumnsRenamed(now), now


def restored(df: DataFrame, columns: list[str], now: dict[str, str]) -> DataFrame:
    """The input's ``columns`` again, under their own names."""
    quoted = {c: f"`{now.get(c, c).replace('`', '``')}`" for c in columns}
    return df.select(*[F.col(q).alias(c) for c, q in quoted.items()])
