"""SimHash near-duplicates: fingerprints of word shingles, linked by tiled exact comparison."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshfeed.llm.arrow_text import (
    LOWER,
    SMALL_SLICE_BYTES,
    NOT_SPACE,
    fresh,
    map_texts,
    runs,
    schema_with,
    sliced,
    with_columns,
    without,
)
from meshfeed.llm.components import components
from meshfeed.session import stage

#: Shingles whose bits are counted at once.
_CHUNK = 1 << 17
#: Fingerprints of a tile that one comparison holds, and others that it meets.
TILE_ROWS, MET_ROWS = 4096, 65536
#: Comparisons whose results are in memory at once.
_PAIRS = 1 << 21


def _fingerprints(data: np.ndarray, cuts: np.ndarray, shingle_words: int, seed: int) -> np.ndarray:
    starts, ends, first = runs(NOT_SPACE[data], cuts)
    # words with one space between, so that a shingle is one piece of bytes
    lengths = ends - starts
    at = np.cumsum(lengths + 1) - lengths - 1
    spaced = np.full(int((lengths + 1).sum()), 32, np.uint8)
    spaced[np.arange(int(lengths.sum())) + np.repeat(np.arange(len(starts)), lengths)] = LOWER[data][
        NOT_SPACE[data]
    ]
    spaced = spaced.tobytes()
    words = np.diff(first)
    shingles = np.where(words > 0, np.maximum(words - shingle_words + 1, 1), 0)
    begin = np.arange(int(shingles.sum())) + np.repeat(first[:-1] - (np.cumsum(shingles) - shingles), shingles)
    end = np.minimum(begin + shingle_words, np.repeat(first[1:], shingles)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(spaced[a:b], seed) for a, b in zip(at[begin].tolist(), (at[end] + lengths[end]).tolist(), strict=True)),
        np.uint64,
        len(begin),
    )
    bits = np.zeros((len(words), 64), np.int64)
    owner = np.repeat(np.arange(len(words)), shingles)
    for k in range(0, len(hashes), _CHUNK):
        part = np.unpackbits(hashes[k : k + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = owner[k : k + _CHUNK]
        heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        bits[own[heads]] += np.add.reduceat(part, heads, axis=0, dtype=np.int64)
    return np.packbits(bits * 2 > shingles[:, None], axis=1, bitorder="little").view(np.int64).ravel()


def add_fingerprint(
    docs: DataFrame, text: str = "text", out: str = "simhash", shingle_words: int = 3, seed: int = 42
) -> DataFrame:
    """``docs`` with the 64-bit fingerprint of each whole text as a long.

    A bit is set if it is set in over half of the XXH64 values of the text's shingles of
    ``shingle_words`` lower-cased (A-Z) words, repeats included; of all words if there are fewer.
    A null text and one without words have fingerprint 0. A column named ``out`` is replaced.
    """
    docs = without(docs, out)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, cuts in sliced(batches, text, SMALL_SLICE_BYTES):
            yield with_columns(rows, **{out: pa.array(_fingerprints(data, cuts, shingle_words, seed))})

    return map_texts(docs, run, schema_with(docs, **{out: "bigint"}))


def _quarter_counts(fingerprint: str) -> list[Column]:
    return [
        F.bit_count(F.shiftrightunsigned(fingerprint, 16 * q).bitwiseAND(0xFFFF)).cast("int") for q in range(4)
    ]


def _code(counts: list[Column]) -> Column:
    code = counts[0]
    for c in counts[1:]:
        code = code * 17 + c
    return code


def _join_up(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unites the groups of each a and b in place; a label is the least member's index."""
    while len(a):
        x, y = labels[a], labels[b]
        open_ = x != y
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        if not len(a):
            return
        low = np.minimum(x, y)
        np.minimum.at(labels, np.maximum(x, y), low)
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels[:] = up


def _linked(home: np.ndarray, met: np.ndarray, radius: int, inner: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links of ``home`` with ``met`` (and within, if ``inner``) as a spanning forest: each group's members
    linked to its least, so that comparisons which share that one agree."""
    values = np.concatenate([home, met])
    bits = values.view(np.uint64)  # of a signed number numpy counts the bits of its absolute value
    labels = np.arange(len(values))
    against = bits if inner else bits[len(home) :]
    shift = 0 if inner else len(home)
    step = max(1, _PAIRS // max(1, len(against)))
    for k in range(0, len(home), step):
        near = np.bitwise_count(bits[k : min(k + step, len(home)), None] ^ against[None, :]) <= radius
        i, j = np.nonzero(near)
        _join_up(labels, i + k, j + shift)
    roots = values.copy()
    np.minimum.at(roots, labels, values)
    roots = roots[labels]
    moved = np.flatnonzero(roots != values)
    return values[moved], roots[moved]


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Rows of one tile, block and part, which stand together: fingerprints, whether at home, part."""
    held: list[list[np.ndarray]] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        tile, block, part, home, value = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        change = np.flatnonzero((np.diff(tile) != 0) | (np.diff(block) != 0) | (np.diff(part) != 0)) + 1
        cuts = [0, *change.tolist(), len(tile)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            now = (int(tile[a]), int(block[a]), int(part[a]))
            if now != key and held:
                yield *(np.concatenate(x) for x in zip(*held, strict=True)), key[2]
                held = []
            key = now
            held.append([value[a:b], home[a:b]])
    if held:
        yield *(np.concatenate(x) for x in zip(*held, strict=True)), key[2]


def near_links(prints: DataFrame, fingerprint: str, radius: int = 2) -> DataFrame:
    """Links ``a``, ``b`` that join exactly the distinct fingerprints reachable over steps of at most
    ``radius`` differing bits.

    Fingerprints are dealt to tiles by the population counts of their four 16-bit quarters. Those
    counts differ by no more in total than the fingerprints do in bits, so two tiles whose counts
    differ beyond the radius are skipped, and only they; all others are compared by exclusive-or
    and bit count. A fingerprint stays in its tile and visits the lesser tiles in reach (20 at
    radius 2). A tile with many rows is cut into blocks, those that visit it into parts, so a
    comparison holds ``TILE_ROWS`` and ``MET_ROWS`` or so. The table of tile sizes has at most
    17**4 rows and is broadcast. A comparison returns a spanning forest of its links: at most a row
    for each fingerprint, however many pairs are near.
    """
    base = prints.select(F.col(fingerprint).alias("f")).where("f is not null").distinct()
    counts = _quarter_counts("f")
    base = base.select("f", *[c.alias(f"q{i}") for i, c in enumerate(counts)])
    base = base.withColumn("tile", _code([F.col(f"q{i}") for i in range(4)]))
    reach = [d for d in product(range(-radius, radius + 1), repeat=4) if 0 < sum(map(abs, d)) <= radius]
    less = [d for d in reach if d < (0, 0, 0, 0)]

    def neighbours(steps: list[tuple[int, ...]]) -> Column:
        inside = [
            F.when(
                F.greatest(*[F.col(f"q{i}") + d[i] for i in range(4)]).between(0, 16)
                & (F.least(*[F.col(f"q{i}") + d[i] for i in range(4)]) >= 0),
                _code([F.col(f"q{i}") + d[i] for i in range(4)]),
            )
            for d in steps
        ]
        return F.array_compact(F.array(*inside))

    sizes = base.groupBy("tile", "q0", "q1", "q2", "q3").count()
    visits = (
        sizes.select(F.explode(neighbours(less)).alias("tile"), "count")
        .groupBy("tile")
        .agg(F.sum("count").alias("met"))
    )
    tiles = sizes.join(visits, "tile", "left").select(
        "tile",
        F.ceil(F.col("count") / TILE_ROWS).cast("int").alias("blocks"),
        F.greatest(
            F.lit(1), F.ceil((F.coalesce("met", F.lit(0)) + F.col("count")) / MET_ROWS).cast("int")
        ).alias("parts"),
    )
    tiles = F.broadcast(stage(tiles, "tiles"))
    spread = F.xxhash64("f")
    at_home = base.join(tiles, "tile").select(
        "f", "tile", "parts", F.pmod(spread, F.col("blocks")).cast("int").alias("block")
    )
    home = at_home.select(
        "tile", "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("home"), "f"
    )
    part = F.pmod(F.xxhash64("f", F.lit(1)), F.col("parts")).cast("int").alias("part")
    own = at_home.where("block > 0").select(
        "tile", F.explode(F.sequence(F.lit(0), F.col("block") - 1)).alias("block"), part, F.lit(False).alias("home"), "f"
    )
    away = (
        base.select("f", F.explode(neighbours(less)).alias("tile"))
        .join(tiles, "tile")
        .select("tile", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), part, F.lit(False).alias("home"), "f")
    )
    dealt = home.union(own).union(away)
    dealt = dealt.repartition("tile", "block", "part").sortWithinPartitions("tile", "block", "part")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for value, is_home, of in _groups(batches):
            a, b = _linked(value[is_home], value[~is_home], radius, inner=of == 0)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return dealt.mapInArrow(compare, "a bigint, b bigint")


def rooted(prints: DataFrame, doc_id: str, fingerprint: str, radius: int = 2) -> DataFrame:
    """``fingerprint``, ``root``, ``least`` for each distinct fingerprint: the fingerprint that names its
    class, and the smallest id of its own documents. Copies of a text share a fingerprint and are
    merged before anything is compared."""
    least = stage(prints.groupBy(fingerprint).agg(F.min(doc_id).alias("least")), "fingerprints")
    roots = components(near_links(least, fingerprint, radius)).withColumnRenamed("node", fingerprint)
    return stage(
        least.join(roots, fingerprint, "left").withColumn("root", F.coalesce("root", fingerprint)), "classes"
    )


def classes(prints: DataFrame, doc_id: str, fingerprint: str, radius: int = 2) -> DataFrame:
    """``fingerprint``, ``component_id`` for each distinct fingerprint: the smallest id of the
    documents reachable over links of at most ``radius`` bits."""
    joined = rooted(prints, doc_id, fingerprint, radius)
    ids = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    return joined.join(ids, "root").select(fingerprint, "component_id")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle_words: int = 3,
    radius: int = 2,
    seed: int = 42,
) -> DataFrame:
    """``doc_id``, ``simhash`` (a long) and ``component_id`` of every document.

    Null and empty texts and texts without words have fingerprint 0 and are linked like any other.
    Documents with the same fingerprint share a class, repeated rows and ids included; each row
    returns one row. A null id is never the smallest; a class of null ids only has a null
    ``component_id``. An empty table gives no rows.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    prints = stage(add_fingerprint(slim, "text", "simhash", shingle_words, seed).drop("text"), "simhash")
    return prints.join(classes(prints, "doc_id", "simhash", radius), "simhash").select(
        "doc_id", "simhash", "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle_words: int = 3,
    radius: int = 2,
    seed: int = 42,
) -> DataFrame:
    """One document of each class of :func:`near_duplicates`, all columns kept: that with the smallest
    id, a null one last; of rows equal in that any one.

    An id that stands on texts of several classes is kept in each of which it is the smallest. Rows
    are written once with their fingerprint and a unique number; classes are settled on those
    numbers, and the number of the row that stays joins it, so no key is hot.
    """
    mark, number = fresh(docs, "simhash_of_row"), fresh(docs, "number_of_row")
    numbered = docs.withColumn(number, F.monotonically_increasing_id())
    rows = stage(add_fingerprint(numbered, text, mark, shingle_words, seed), "fingerprinted")
    key = F.col(f"`{doc_id.replace('`', '``')}`")
    prints = rows.select(key.alias("doc_id"), F.col(mark).alias("simhash"), F.col(number).alias("number"))
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "number")
    first = prints.groupBy("simhash").agg(F.min(place).alias("place"))
    roots = rooted(prints, "doc_id", "simhash", radius).select("simhash", "root")
    kept = first.join(roots, "simhash").groupBy("root").agg(F.min("place")["number"].alias(number))
    return rows.join(kept.select(number), number, "left_semi").select(*docs.columns)
