"""Benchmark decontamination by suffix arrays over shards of the training text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshfeed.llm.arrow_text import (
    LOWER,
    WORD,
    fresh,
    gather,
    gather_pieces,
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

#: Benchmark text that one pass over the documents searches; the driver and each task hold as much.
BLOCK_BYTES = 8 << 20

#: Words that are compared at once, over all pairs of suffixes.
_COMPARED = 1 << 18

#: Columns that :func:`find_contamination` adds.
ADDED = {
    "n_words": "bigint",
    "n_hit": "bigint",
    "hit_spans": "array<struct<first:bigint,last:bigint>>",
    "items": "array<string>",
    "longest": "struct<item:string,words:bigint,at:bigint>",
}
_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
_LONGEST = pa.struct([("item", pa.string()), ("words", pa.int64()), ("at", pa.int64())])
_HITS = "hit_spans array<struct<first:bigint,last:bigint>>, items array<string>, longest struct<item:string,words:bigint,at:bigint>"


def _keys(ids: np.ndarray, at: np.ndarray, left: np.ndarray, window: int) -> np.ndarray:
    """The first ``window`` words of the suffixes ``at`` as byte strings that sort like the words;
    beyond the ``left`` words of a suffix stands 0, which is no word."""
    padded = np.concatenate([ids, np.zeros(window, ids.dtype)])
    columns = [np.where(left > k, padded[at + k], 0).astype(">u4") for k in range(window)]
    return np.ascontiguousarray(np.stack(columns, axis=1)).view(f"S{4 * window}").ravel()


def _suffix_ranks(ids: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Each suffix's rank among all, equal ones alike; a suffix ends after its ``left`` words. The words
    compared double with each round."""
    rank, span = ids.astype(np.int64), 1
    while span < int(left.max()):
        ahead = np.where(left > span, np.concatenate([rank, np.zeros(span, np.int64)])[span:], 0)
        rank = np.unique(rank * (int(rank.max()) + 2) + ahead, return_inverse=True)[1] + 1
        span *= 2
    return rank


@dataclass(frozen=True)
class Block:
    """Benchmark items, ready to be searched for."""

    window: int
    items: list[str]
    least: int  # words of the shortest window
    word_hash: np.ndarray  # of distinct words, sorted; a word's id is its place here plus one
    word_data: np.ndarray
    word_cuts: np.ndarray
    key: np.ndarray  # distinct windows
    key_top: np.ndarray  # the greatest suffix that begins so
    key_words: np.ndarray
    key_items: np.ndarray
    key_item_cuts: np.ndarray
    ids: np.ndarray  # all items' words
    left: np.ndarray  # words from here to the item's end
    item: np.ndarray
    order: np.ndarray  # the suffixes of ``ids`` in order, so that a shard is searched in order


def build_block(items: list[tuple[str, str]], window: int) -> Block | None:
    """None if no item has a word."""
    data, cuts = text_bytes(pa.array([t for _, t in items], pa.string()))
    data = LOWER[data]
    starts, ends, first = runs(WORD[data], cuts)
    if not len(starts):
        return None
    hashes, place, back = np.unique(run_hashes(data, starts, ends), return_index=True, return_inverse=True)
    ids = (back + 1).astype(np.int64)
    item = np.repeat(np.arange(len(items)), np.diff(first))
    left = first[1:][item] - np.arange(len(ids))
    heads = (left >= window) | (np.arange(len(ids)) == first[:-1][item])
    at = np.flatnonzero(heads)
    length = np.minimum(left[at], window)
    key, of = np.unique(_keys(ids, at, left[at], window), return_inverse=True)
    pairs = np.unique(of * len(items) + item[at])
    key_words = np.zeros(len(key), np.int64)
    key_words[of] = length
    raw = np.frombuffer(key.tobytes(), np.uint8).reshape(len(key), 4 * window).copy()
    raw[np.arange(4 * window)[None, :] >= 4 * key_words[:, None]] = 255
    return Block(
        window, [i for i, _ in items], int(length.min()),
        hashes, data, np.stack([starts, ends], axis=1)[place],
        key, raw.view(f"S{4 * window}").ravel(), key_words,
        pairs % len(items), np.searchsorted(pairs // len(items), np.arange(len(key) + 1)),
        ids, left, item, np.argsort(_suffix_ranks(ids, left), kind="stable"),
    )


def _common(ids: np.ndarray, left: np.ndarray, p: np.ndarray, block: Block, q: np.ndarray) -> np.ndarray:
    """How many first words document suffixes p and item suffixes q have in common."""
    n, limit = np.zeros(len(p), np.int64), np.minimum(left[p], block.left[q])
    going, step = np.flatnonzero(limit > 0), 1
    while len(going):
        step = max(1, min(2 * step, 64, _COMPARED // len(going)))
        k = n[going][:, None] + np.arange(step)
        of_p = ids[np.minimum(p[going][:, None] + k, len(ids) - 1)]
        of_q = block.ids[np.minimum(q[going][:, None] + k, len(block.ids) - 1)]
        same = (of_p == of_q) & (k < limit[going][:, None])
        whole = same.all(axis=1)
        n[going] += np.where(whole, step, same.argmin(axis=1))
        going = going[whole]
        going = going[n[going] < limit[going]]
    return n


def _places(ids: np.ndarray, left: np.ndarray, array: np.ndarray, block: Block, tests: np.ndarray) -> np.ndarray:
    """Binary search of test suffixes in a shard's suffix array: how many of its suffixes are less."""
    low, high = np.zeros(len(tests), np.int64), np.full(len(tests), len(array))
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        p, q = array[middle], tests[open_]
        n = _common(ids, left, p, block, q)
        ends, word = left[p] == n, ids[np.minimum(p + n, len(ids) - 1)]
        less = np.where(ends, block.left[q] > n, (block.left[q] > n) & (word < block.ids[np.minimum(q + n, len(block.ids) - 1)]))
        low[open_] = np.where(less, middle + 1, low[open_])
        high[open_] = np.where(less, high[open_], middle)
        open_ = open_[low[open_] < high[open_]]
    return low


def _longest(ids: np.ndarray, left: np.ndarray, array: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix of a shard's suffix ``array`` the longest match with any test suffix: its words, and
    the test suffix.

    Every test suffix is searched in the array, but for those whose first word begins none of its
    suffixes. A suffix shares most with the test suffixes that come to stand next to it."""
    begins = np.zeros(len(block.word_hash) + 1, bool)
    begins[ids[array]] = True
    tests = block.order[begins[block.ids[block.order]]]
    if not len(tests):
        return np.zeros(len(array), np.int64), np.zeros(len(array), np.int64)
    after = np.searchsorted(_places(ids, left, array, block, tests), np.arange(len(array)), "right")
    best, where = np.zeros(len(array), np.int64), np.zeros(len(array), np.int64)
    for beside in (after - 1, after):
        q = tests[np.clip(beside, 0, len(tests) - 1)]
        n = _common(ids, left, array, block, q)
        where = np.where(n > best, q, where)
        best = np.maximum(best, n)
    return best, where


def _search(block: Block, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, dict[int, tuple]]:
    """Words of each document; for documents with a hit their spans, items and longest match."""
    data = LOWER[data]
    starts, ends, first = runs(WORD[data], cuts)
    n_words = np.diff(first)
    if not len(starts):
        return n_words, {}
    hashes = run_hashes(data, starts, ends)
    place = np.minimum(np.searchsorted(block.word_hash, hashes), len(block.word_hash) - 1)
    known = block.word_hash[place] == hashes
    pieces = np.stack([starts, ends], axis=1)
    for exact in (False, True):
        begin, end, _ = runs(known, first)
        long = end - begin >= block.least
        begin, end = begin[long], end[long]
        at, lengths = gather_pieces(np.stack([begin, end], axis=1), np.arange(len(begin)))
        if not exact and len(at):  # a word counts as known only if its bytes say so
            known[at] = same_pieces(data, pieces, at, block.word_data, block.word_cuts, place[at])
    if not len(at):
        return n_words, {}
    # words of known runs only, each run followed by nothing: the shard's suffixes
    ids = place[at] + 1
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(at))
    suffix = np.flatnonzero(left >= block.least)
    keys = _keys(ids, suffix, left[suffix], block.window)
    order = np.argsort(keys, kind="stable")
    keys, suffix = keys[order], suffix[order]
    low = np.searchsorted(keys, block.key, "left")
    high = np.searchsorted(keys, block.key_top, "right")
    found = np.flatnonzero(high > low)
    if not len(found):
        return n_words, {}
    hit, counts = gather_pieces(np.stack([low, high], axis=1), found)
    hit, key = suffix[hit], np.repeat(found, counts)
    word = at[hit]
    doc = np.searchsorted(first, word, "right") - 1
    change = np.zeros(len(starts) + 1, np.int64)
    np.add.at(change, word, 1)
    np.add.at(change, word + block.key_words[key], -1)
    begin, end, of = runs(np.cumsum(change[:-1]) > 0, first)
    pairs = np.unique(doc * len(block.key) + key)
    members, counts = gather(block.key_item_cuts, pairs % len(block.key))
    owner = np.repeat(pairs // len(block.key), counts)
    touched = np.unique(owner * len(block.items) + block.key_items[members])
    owner, item = touched // len(block.items), touched % len(block.items)
    # the runs with a window, their suffixes from a window on sorted whole
    one, back = np.unique(hit, return_index=True)
    run = np.repeat(np.arange(len(lengths)), lengths)
    with_hit = np.zeros(len(lengths), bool)
    with_hit[run[one]] = True
    inside = np.flatnonzero(with_hit[run])
    own_ids, own_left = ids[inside], left[inside]
    own = np.searchsorted(inside, one)
    array = np.argsort(_suffix_ranks(own_ids, own_left)[own], kind="stable")
    words, where = np.zeros(len(one), np.int64), np.zeros(len(one), np.int64)
    words[array], where[array] = _longest(own_ids, own_left, own[array], block)
    best = np.lexsort((at[one], -words, doc[back]))
    ahead = np.concatenate([[True], np.diff(doc[back][best]) != 0])
    result = {}
    for k in best[ahead]:
        d = int(doc[back][k])
        spans = [(int(a - first[d]), int(b - 1 - first[d])) for a, b in zip(begin[of[d] : of[d + 1]], end[of[d] : of[d + 1]], strict=True)]
        a, b = np.searchsorted(owner, [d, d + 1])
        result[d] = (
            spans,
            sorted({block.items[i] for i in item[a:b]}),
            (block.items[block.item[where[k]]], int(words[k]), int(at[one[k]] - first[d])),
        )
    return n_words, result


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _blocks(benchmark: DataFrame, block_bytes: int) -> tuple[int, Iterator[list[tuple[str, str]]]]:
    """How many blocks the different items make, and the blocks; one is collected at a time."""
    size = F.octet_length("text") + F.octet_length("item") + 16
    n = max(1, -(-(benchmark.agg(F.sum(size)).first()[0] or 0) // block_bytes))
    if n > 1:
        benchmark = stage(benchmark, "benchmark")
    of = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    return n, ([tuple(r) for r in benchmark.where(of == b).collect()] for b in range(n))


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with what each whole text shares with the benchmark.

    Words are runs of letters and digits (and all characters beyond ASCII), A-Z lower-cased. A
    window is ``window`` consecutive words of an item, or a whole shorter item. Added are
    ``n_words``; ``n_hit``, the words inside any occurrence of a window; ``hit_spans``, those as
    merged spans of word positions from 0 (last inclusive); ``items``, the ids (as text, distinct,
    sorted) of the items with an occurring window; ``longest``, the longest verbatim match from a
    hit on: item, words and position (null if there is none). Columns of these names are replaced.

    A shard is some megabytes of whole texts. The suffixes that can match at all, those that begin
    with enough words of the benchmark, are sorted into the shard's suffix array by their first
    ``window`` words, and the beginning of every test suffix is looked up in it by binary search.
    Where there is an occurrence, the suffixes are sorted whole, and every test suffix is searched in
    that array: the longest match of a document's suffix is with a test suffix that falls beside it.

    The benchmark's different items are searched in blocks of about ``block_bytes``, so neither driver
    nor tasks hold more of it. With one block nothing is written or shuffled. With more the documents
    are written once, numbered; each further pass reads the texts alone and writes what it finds in the few
    documents with a hit, and what was found joins the documents by their numbers at the end.

    Null and empty texts have no words. Null and empty items, and those with a null id, match
    nothing. Repeated items and ids count once. An empty benchmark leaves all documents clean.
    """
    out = without(docs, *ADDED)
    bench = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text"))
    bench = bench.where("item is not null and text is not null").distinct()
    n, blocks = _blocks(bench, block_bytes)
    context = out.sparkSession.sparkContext
    shared = (context.broadcast(build_block(rows, window)) for rows in blocks)
    if n == 1:
        return map_texts(out, _whole_rows(next(shared), text), schema_with(out, **ADDED))
    number = fresh(out, "number")
    rows = stage(out.withColumn(number, F.monotonically_increasing_id()), "decontaminate")
    texts = rows.select(number, f"`{text}`")
    passes = [stage(map_texts(texts, _hits(block, number, text), f"`{number}` bigint, {_HITS}"), "hits") for block in shared]
    parts = fresh(out, "parts_found")
    found = F.collect_list(F.struct("hit_spans", "items", "longest")).alias(parts)  # one a block
    found = reduce(DataFrame.union, passes).groupBy(number).agg(found)
    return map_texts(rows.join(found, number, "left").drop(number), _united(text, parts), schema_with(out, **ADDED))


Found = tuple[list[tuple[int, int]], list[str], tuple[str, int, int]]


def _columns(found: dict[int, Found], rows: Iterable[int]) -> dict[str, pa.Array]:
    """The columns of hits for the given rows; one that is not in ``found`` has none."""
    of = [found.get(d, ([], [], None)) for d in rows]
    return {
        "hit_spans": pa.array([[{"first": a, "last": b} for a, b in s] for s, _, _ in of], _SPANS),
        "items": pa.array([i for _, i, _ in of], pa.list_(pa.string())),
        "longest": pa.array([l and dict(zip(("item", "words", "at"), l, strict=True)) for _, _, l in of], _LONGEST),
    }


def _with_hits(rows: pa.RecordBatch, n_words: np.ndarray, found: dict[int, Found]) -> pa.RecordBatch:
    hits = [sum(b - a + 1 for a, b in found[d][0]) if d in found else 0 for d in range(rows.num_rows)]
    added = {"n_words": pa.array(n_words, pa.int64()), "n_hit": pa.array(hits, pa.int64())}
    return with_columns(rows, **added, **_columns(found, range(rows.num_rows)))


def _counted(data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return np.diff(runs(WORD[LOWER[data]], cuts)[2])


def _whole_rows(block, text: str):
    """Documents with all added columns, for a benchmark of one block."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, cuts in sliced(batches, text):
            if block.value is None:
                yield _with_hits(rows, _counted(data, cuts), {})
            else:
                yield _with_hits(rows, *_search(block.value, data, cuts))

    return run


def _hits(block, number: str, text: str):
    """Numbers of the documents with a hit in this block, and what it is."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, cuts in sliced(batches, text):
            found = _search(block.value, data, cuts)[1] if block.value else {}
            if found:
                numbers = rows.column(rows.schema.get_field_index(number)).take(pa.array(list(found), pa.int64()))
                columns = {number: numbers, **_columns(found, found)}
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def _united(text: str, parts: str):
    """Documents with all added columns, from what each block found in them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, cuts in sliced(batches, text):
            found: dict[int, Found] = {}
            for d, own in enumerate(rows.column(rows.schema.get_field_index(parts)).to_pylist()):
                if own:
                    spans = _merged([(s["first"], s["last"]) for part in own for s in part["hit_spans"]])
                    items = sorted({i for part in own for i in part["items"]})
                    longest = max((part["longest"] for part in own), key=lambda x: (x["words"], -x["at"]))
                    found[d] = spans, items, (longest["item"], longest["words"], longest["at"])
            kept = rows.select([n for n in rows.schema.names if n != parts])
            yield _with_hits(kept, _counted(data, cuts), found)

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents without any window of the benchmark, columns unchanged; options as in
    :func:`find_contamination`. Documents without words stay."""
    renamed, now = set_aside(docs, *ADDED)
    found = find_contamination(renamed, benchmark, text=now.get(text, text), **options)
    return restored(found.where("n_hit = 0"), docs.columns, now)
