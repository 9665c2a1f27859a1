"""Fill-in-the-middle: texts cut in three and put together again in another order, and back."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshfeed.llm.arrow_text import class_table, fresh, map_texts, schema_with, sliced, with_columns, without

#: Bytes whose displacements are in memory at once.
_CHUNK = 1 << 20

_LETTER = class_table(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", False)

PLAIN, PSM, SPM = "plain", "psm", "spm"

#: Columns that :func:`transform` adds.
ADDED = {
    "n_units": "bigint",
    "form": "string",
    "prefix_chars": "bigint",
    "middle_chars": "bigint",
    "fim_text": "string",
}


@dataclass(frozen=True)
class Marks:
    """What stands before each part. No mark may overlap another or itself, else a text could not be
    taken apart again."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        marks = self.as_bytes()
        for a in marks:
            for b in marks:
                if not a or any(a[-n:] == b[:n] for n in range(1, min(len(a), len(b)) + (a is not b))):
                    raise ValueError(f"marks overlap: {a!r}, {b!r}")
                if a is not b and a in b:
                    raise ValueError(f"a mark holds another: {a!r}, {b!r}")

    def as_bytes(self) -> tuple[bytes, bytes, bytes]:
        return self.prefix.encode(), self.suffix.encode(), self.middle.encode()


def unit_starts(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where units begin, and for each text the number of its first one (one more entry than texts).

    A unit is a run of ASCII letters or one other character.
    """
    letter = _LETTER[data]
    inside = np.empty_like(letter)
    inside[:1] = False
    inside[1:] = letter[1:] & letter[:-1]
    inside[cuts[:-1][cuts[:-1] < len(data)]] = False
    starts = np.flatnonzero(((data & 0xC0) != 0x80) & ~inside)
    return starts, np.searchsorted(starts, cuts)


def places(data: np.ndarray, cuts: np.ndarray, mark: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where ``mark`` stands inside a text, and in which text."""
    at = np.flatnonzero(data[: max(0, len(data) - len(mark) + 1)] == mark[0])
    for n, byte in enumerate(mark[1:], 1):
        at = at[data[at + n] == byte]
    text = np.searchsorted(cuts, at, "right") - 1
    whole = at + len(mark) <= cuts[text + 1]
    return at[whole], text[whole]


def _displacements(starts: np.ndarray, shift: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every position below ``size`` and its displacement, in chunks: ``shift`` holds from each of the
    ``starts`` on (in order; the last of equal ones counts) until the next.

    The steps between the shifts are scattered into a difference array, whose running sum is the
    displacement of every byte.
    """
    steps = np.diff(shift, prepend=0)
    carry = 0
    for k in range(0, size, _CHUNK):
        end = min(k + _CHUNK, size)
        low, high = np.searchsorted(starts, [k, end])
        difference = np.zeros(end - k, np.int64)
        np.add.at(difference, starts[low:high] - k, steps[low:high])
        difference[0] += carry
        moved = np.cumsum(difference)
        carry = int(moved[-1])
        yield np.arange(k, end), moved


def scatter(
    data: np.ndarray, cuts: np.ndarray, first: np.ndarray, second: np.ndarray, form: np.ndarray, marks: Marks
) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a batch in their new order, as bytes and offsets. ``first`` and ``second`` are the
    byte positions of the two cuts; ``form`` 0 leaves a text as it is, 1 is prefix, suffix, middle,
    2 is suffix, prefix, middle."""
    p, s, m = marks.as_bytes()
    begin, end = cuts[:-1], cuts[1:]
    moved = form > 0
    first, second = np.where(moved, first, end), np.where(moved, second, end)
    left, right = first - begin, end - second
    sizes = end - begin + np.where(moved, len(p) + len(s) + len(m), 0)
    out_cuts = np.concatenate([[0], np.cumsum(sizes)])
    base = out_cuts[:-1]
    psm, spm = form == 1, form == 2
    at_prefix = base + np.select([psm, spm], [len(p), len(s) + right + len(p)], 0)
    at_suffix = base + np.select([psm, spm], [len(p) + left + len(s), len(s)], left)
    at_middle = base + np.where(moved, len(p) + len(s) + len(m) + left + right, left)
    starts = np.stack([begin, first, second], axis=1).ravel()
    goals = np.stack([at_prefix, at_middle, at_suffix], axis=1).ravel()
    out = np.empty(int(out_cuts[-1]), np.uint8)
    for at, shift in _displacements(starts, goals - starts, len(data)):
        out[at + shift] = data[at]
    for mark, goal in ((p, at_prefix), (s, at_suffix), (m, at_middle)):
        for n, byte in enumerate(mark):
            out[goal[moved] - len(mark) + n] = byte
    return out, out_cuts


def gather_back(
    data: np.ndarray, cuts: np.ndarray, form: np.ndarray, marks: Marks
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts that :func:`scatter` made ``data`` of, as bytes and offsets, and whether each could be
    told: a text that is not plain must have each mark once, in the order of its form."""
    p, s, m = marks.as_bytes()
    begin, end = cuts[:-1], cuts[1:]
    moved, sound = form > 0, np.ones(len(form), bool)
    at = {}
    for mark in (p, s, m):
        where, text = places(data, cuts, mark)
        sound &= ~moved | (np.bincount(text, minlength=len(form)) == 1)
        at[mark] = np.zeros(len(form), np.int64)
        at[mark][text] = where
    heads = np.where(form == 1, at[p], at[s]), np.where(form == 1, at[s], at[p])
    sound &= ~moved | ((heads[0] == begin) & (heads[0] < heads[1]) & (heads[1] < at[m]))
    usable = moved & sound
    prefix, suffix, middle = (np.where(usable, at[x] + len(x), begin) for x in (p, s, m))
    prefix_end = np.where(usable, np.where(form == 1, at[s], at[m]), np.where(sound, end, begin))
    suffix_end = np.where(usable, np.where(form == 1, at[m], at[p]), begin)
    middle_end = np.where(usable, end, begin)
    lengths = np.stack([prefix_end - prefix, middle_end - middle, suffix_end - suffix], axis=1)
    back = np.concatenate([[0], np.cumsum(lengths.sum(axis=1))])
    starts = np.concatenate([[0], np.cumsum(lengths.ravel())])[:-1]
    sources = np.stack([prefix, middle, suffix], axis=1).ravel()
    out = np.empty(int(back[-1]), np.uint8)
    for to, shift in _displacements(starts, sources - starts, len(out)):
        out[to] = data[to + shift]
    return out, back, sound


def _strings(data: np.ndarray, cuts: np.ndarray, known: np.ndarray | None = None) -> pa.Array:
    """Texts of an Arrow column; null where not ``known``."""
    valid = None if known is None else pa.py_buffer(np.packbits(known, bitorder="little").tobytes())
    offsets, text = pa.py_buffer(cuts.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())
    return pa.StringArray.from_buffers(len(cuts) - 1, offsets, text, valid)


def _draws(doc_id: str, seed: int) -> list[Column]:
    """The first four 32-bit numbers of the SHA-256 of seed and id."""
    quoted = f"`{doc_id.replace('`', '``')}`"
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(quoted).cast("string"), F.lit("")))
    digest = F.sha2(key, 256)
    return [F.conv(F.substring(digest, 8 * n + 1, 8), 16, 10).cast("bigint") for n in range(4)]


def transform(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    seed: int = 1,
    percent: int = 90,
    suffix_first_percent: int = 20,
    marks: Marks = Marks(),
) -> DataFrame:
    """``docs`` with each whole text rearranged as ``fim_text``, and how.

    A text is cut between units (a run of ASCII letters, or one other character) at two places that
    follow from ``seed`` and id. ``percent`` of the texts are rearranged, ``suffix_first_percent`` of
    those as suffix, prefix, middle (``form`` spm), the others as prefix, suffix, middle (psm), each
    part behind its mark; the rest, empty texts and texts that hold a mark stay ``plain``. Added
    besides are ``n_units``, and ``prefix_chars`` and ``middle_chars`` in code points (null if
    plain). Columns of these names are replaced.

    The whole batch is moved at once: the cuts give difference arrays, their running sum the
    displacement of every byte, and the bytes are scattered to their places. No shuffle; a task holds
    a slice of about a megabyte of text or one longer text. A null text counts as empty and a null id
    as an empty one; equal ids are cut alike; an empty table gives no rows.
    """
    out = without(docs, *ADDED)
    names = [fresh(out, f"draw_{n}") for n in range(4)]
    drawn = out.select("*", *[c.alias(n) for c, n in zip(_draws(doc_id, seed), names, strict=True)])
    kinds = np.array([PLAIN, PSM, SPM])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, cuts in sliced(batches, text):
            one, two, three, four = (
                rows.column(rows.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names
            )
            starts, unit = unit_starts(data, cuts)
            units = np.diff(unit)
            form = np.where(four % 100 < suffix_first_percent, 2, 1)
            form[(units == 0) | (three % 100 >= percent)] = 0
            for mark in marks.as_bytes():
                form[places(data, cuts, mark)[1]] = 0
            ends = np.append(starts, len(data))

            def cut(n, unit=unit, units=units, ends=ends, cuts=cuts):
                return np.where(n < units, ends[unit[:-1] + np.minimum(n, np.maximum(units - 1, 0))], cuts[1:])

            a, b = one % (units + 1), two % (units + 1)
            first, second = cut(np.minimum(a, b)), cut(np.maximum(a, b))
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            plain = form == 0
            yield with_columns(
                rows.select([n for n in rows.schema.names if n not in names]),
                n_units=pa.array(units, pa.int64()),
                form=pa.array(kinds[form]),
                prefix_chars=pa.array(chars[first] - chars[cuts[:-1]], pa.int64(), mask=plain),
                middle_chars=pa.array(chars[second] - chars[first], pa.int64(), mask=plain),
                fim_text=_strings(*scatter(data, cuts, first, second, form, marks)),
            )

    return map_texts(drawn, run, schema_with(out, **ADDED))


def restore(
    docs: DataFrame, text: str = "fim_text", form: str = "form", out: str = "restored_text", marks: Marks = Marks()
) -> DataFrame:
    """``docs`` with the original text of each ``text`` as ``out``, from that text and its form alone.

    The places of the marks give the parts; every byte of the original is gathered from its place.
    A null text gives an empty one, as :func:`transform` took it. A text that is no output of its
    form, or whose form is unknown or null, gives null. A column named ``out`` is replaced.
    """
    docs = without(docs, out)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, cuts in sliced(batches, text):
            names = rows.column(rows.schema.get_field_index(form)).to_pylist()
            kind = np.array([{PLAIN: 0, PSM: 1, SPM: 2}.get(n, -1) for n in names], np.int64)
            back, back_cuts, sound = gather_back(data, cuts, np.maximum(kind, 0), marks)
            yield with_columns(rows, **{out: _strings(back, back_cuts, sound & (kind >= 0))})

    return map_texts(docs, run, schema_with(docs, **{out: "string"}))
