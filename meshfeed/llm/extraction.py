"""Main text of web pages: a bidirectional LSTM labels every block with the whole page in view."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshfeed.llm.arrow_text import (
    LOWER,
    WORD,
    map_texts,
    run_hashes,
    runs,
    schema_with,
    sliced,
    text_bytes,
    with_columns,
    without,
)
from meshfeed.llm.html_blocks import (
    ADVERT_NAMES,
    COMMENT_NAMES,
    FOOTER_NAMES,
    FORM_NAMES,
    HEADER_NAMES,
    HIDDEN_NAMES,
    MAIN_NAMES,
    MENU_NAMES,
    NOTICE_NAMES,
    PATH_BUCKETS,
    SIDE_NAMES,
    Block,
    bucket,
    parse,
)

#: Pages that the labeller is fitted on (about; drawn by a hash of the id) and the longest among them
#: in bytes and blocks. They bound what goes to the driver.
SAMPLE_PAGES, SAMPLE_HTML_BYTES, SAMPLE_BLOCKS = 300, 1 << 16, 200
#: Pages made up of layout names alone, which the labeller sees besides.
MADE_PAGES = 300

WORD_BITS, DIM, HIDDEN, NUMBERS = 10, 8, 16, 4
STEPS, RATE, BATCH, DECAY = 450, 0.02, 24, 1e-4
#: Padded blocks that are labelled at once.
_AT_ONCE = 20_000

ADDED = {"main_text": "string"}

# fixed values: kinds of names that are never main text, and leaf tags of made pages
_NEVER = [MENU_NAMES, HEADER_NAMES, FOOTER_NAMES, SIDE_NAMES, ADVERT_NAMES, NOTICE_NAMES, FORM_NAMES, COMMENT_NAMES]
_LEAVES = {"content": "p p p p p h1 h2 h3 li blockquote pre td div".split(), "other": "li li p div span h3 h4 label td".split()}


def _names(*lists: list[str]) -> frozenset[int]:
    return frozenset(bucket(n) for names in lists for n in names)


_MAIN_IDS, _OTHER_IDS = _names(["article", "main", ".main", ".article"]), _names(*_NEVER, HIDDEN_NAMES)


def teacher(blocks: list[Block]) -> np.ndarray | None:
    """Labels for training from pages that say themselves what is what: inside an ``article`` or ``main``
    and inside nothing that is named as something else. None for a page without either."""
    main = np.array([not _MAIN_IDS.isdisjoint(b.path) for b in blocks])
    if not main.any():
        return None
    return (main & np.array([_OTHER_IDS.isdisjoint(b.path) for b in blocks])).astype(float)


@dataclass(frozen=True)
class Features:
    """Blocks as arrays: distinct paths as bucket lists, each block's path and leaf, word buckets, numbers."""

    path_ids: np.ndarray
    path_cuts: np.ndarray
    path: np.ndarray
    leaf: np.ndarray
    word_ids: np.ndarray
    word_cuts: np.ndarray
    numbers: np.ndarray


def featurize(blocks: list[Block]) -> Features:
    paths: dict[frozenset[int], int] = {}
    path = np.array([paths.setdefault(b.path, len(paths)) for b in blocks], np.int64)
    ids = [sorted(p) or [0] for p in paths]
    data, cuts = text_bytes(pa.array([b.text for b in blocks], pa.string()))
    low = LOWER[data]
    starts, ends, first = runs(WORD[low], cuts)
    words = (run_hashes(low, starts, ends) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    length = np.diff(cuts)
    numbers = np.stack(
        [
            np.log1p(length) / 5 - 1,
            np.minimum(1, np.array([b.link_chars for b in blocks], float) / np.maximum(1, length)),
            np.array([b.text[-1] in ".!?:;…" for b in blocks], float),
            np.log1p(np.diff(first)) / 3 - 1,
        ],
        axis=1,
    )
    return Features(
        np.array([i for p in ids for i in p], np.int64), np.cumsum([0, *map(len, ids)]),
        path, np.array([bucket(b.leaf) for b in blocks], np.int64), words, first, numbers,
    )


def _shapes() -> dict[str, tuple[int, ...]]:
    size = 3 * DIM + NUMBERS
    return {
        "path": (PATH_BUCKETS, DIM), "leaf": (PATH_BUCKETS, DIM), "word": (1 << WORD_BITS, DIM),
        **{f"{k}{d}": s for d in "fb" for k, s in (("x", (size, 4 * HIDDEN)), ("h", (HIDDEN, 4 * HIDDEN)), ("c", (4 * HIDDEN,)))},
        "out": (2 * HIDDEN,), "skip": (size,), "bias": (1,),
    }


Weights = dict[str, np.ndarray]


def _means(table: np.ndarray, ids: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Mean of the table's rows for each list of ids; zeros for an empty list."""
    out = np.zeros((len(cuts) - 1, table.shape[1]), table.dtype)
    some = np.flatnonzero(np.diff(cuts))
    if len(some):
        out[some] = np.add.reduceat(table[ids], cuts[some], axis=0) / np.diff(cuts)[some, None]
    return out


def _inputs(w: Weights, f: Features) -> np.ndarray:
    path = _means(w["path"], f.path_ids, f.path_cuts)[f.path]
    words = _means(w["word"], f.word_ids, f.word_cuts)
    return np.concatenate([path, w["leaf"][f.leaf], words, f.numbers.astype(path.dtype)], axis=1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _direction(w: Weights, d: str, x: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """Hidden states of one direction over (time, pages, inputs); padding leaves the state as it is."""
    steps = range(len(x)) if d == "f" else range(len(x) - 1, -1, -1)
    h = c = np.zeros((x.shape[1], HIDDEN), x.dtype)
    out, tape = np.empty((*x.shape[:2], HIDDEN), x.dtype), []
    pre = x @ w[f"x{d}"] + w[f"c{d}"]
    for t in steps:
        z = pre[t] + h @ w[f"h{d}"]
        gates, g = _sigmoid(z[:, : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN :])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        m = mask[t][:, None]
        c_new = np.where(m, f * c + i * g, c)
        tanh_c = np.tanh(c_new)
        h_new = np.where(m, o * tanh_c, h)
        if keep:
            tape.append((t, h, c, i, f, o, g, tanh_c))
        h, c = h_new, c_new
        out[t] = h
    return out, tape


def _backward(w: Weights, d: str, x: np.ndarray, mask: np.ndarray, tape: list, up: np.ndarray, grad: Weights) -> np.ndarray:
    """Gradients of one direction; returns that of the inputs."""
    dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN), x.dtype)
    dh = dc = np.zeros((x.shape[1], HIDDEN), x.dtype)
    for t, h, c, i, f, o, g, tanh_c in reversed(tape):
        m = mask[t][:, None]
        dh = dh + up[t]
        live = np.where(m, dh, 0)
        dct = np.where(m, dc + live * o * (1 - tanh_c**2), 0)
        dz = np.concatenate(
            [dct * g * i * (1 - i), dct * c * f * (1 - f), live * tanh_c * o * (1 - o), dct * i * (1 - g**2)], axis=1
        )
        dz_all[t] = dz
        grad[f"h{d}"] += h.T @ dz
        dh = np.where(m, dz @ w[f"h{d}"].T, dh)
        dc = np.where(m, dct * f, dc)
    flat = dz_all.reshape(-1, 4 * HIDDEN)
    grad[f"x{d}"] += x.reshape(-1, x.shape[2]).T @ flat
    grad[f"c{d}"] += flat.sum(axis=0)
    return dz_all @ w[f"x{d}"].T


def _padded(rows: np.ndarray, cuts: np.ndarray, pages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the pages as (time, page, input) with zeros behind their ends, and where rows are."""
    lengths = np.diff(cuts)[pages]
    at = np.arange(int(lengths.max()))[:, None]
    mask = at < lengths[None, :]
    x = np.where(mask[:, :, None], rows[np.where(mask, cuts[pages][None, :] + at, 0)], 0)
    return x, mask


def probabilities(w: Weights, f: Features, cuts: np.ndarray) -> np.ndarray:
    """The chance of each block to be main text; ``cuts``: where each page's blocks begin."""
    out = np.zeros(int(cuts[-1]))
    if not len(out):
        return out
    rows = _inputs(w, f)
    lengths = np.diff(cuts)
    order = np.argsort(lengths, kind="stable")
    order = order[lengths[order] > 0]
    a = 0
    while a < len(order):
        b = a + 1
        while b < len(order) and (b + 1 - a) * lengths[order[b]] <= _AT_ONCE:
            b += 1
        pages = order[a:b]
        x, mask = _padded(rows, cuts, pages)
        h = np.concatenate([_direction(w, d, x, mask, keep=False)[0] for d in "fb"], axis=2)
        p = _sigmoid(h @ w["out"] + x @ w["skip"] + w["bias"][0])
        time, page = np.nonzero(mask)
        out[cuts[pages][page] + time] = p[time, page]
        a = b
    return out


def _made_page(rng: np.random.Generator) -> tuple[list[Block], list[float]]:
    """A page of layout names and invented words: boilerplate around main text, and also inside it."""
    pick = lambda names: names[int(rng.integers(len(names)))]
    outer = [["html", "body"], ["html", "body", "div"], ["html", "body", "div", ".wrapper"], ["html", "body", "div", ".container"]]
    base = outer[int(rng.integers(4))]
    blocks: list[Block] = []
    labels: list[float] = []

    def add(names: list[str], kind: str, many: int, words: tuple[int, int], label: float) -> None:
        around = [*base, *names, *(["div"] if any(n[0] == "." for n in names) else [])]
        for _ in range(many):
            # text may also stand in the named element itself, as in <footer>text</footer>
            leaf = around[-1] if rng.random() < 0.2 else pick(_LEAVES["content" if kind == "content" else "other"])
            n = int(rng.integers(*words))
            text = " ".join(f"w{rng.integers(4000)}" for _ in range(n)) + ("." if rng.random() < (0.8 if kind == "content" else 0.25) else "")
            linked = kind == "menu" or (kind == "other" and rng.random() < 0.3)
            path = frozenset(bucket(x) for x in [*around, leaf, *(["ul"] if leaf == "li" else []), *(["a"] if linked else [])])
            blocks.append(Block(text, leaf, path, len(text) if linked else 0))
            labels.append(label)

    def other(inside: list[str]) -> None:
        kind = _NEVER[int(rng.integers(len(_NEVER)))]
        add([*inside, pick(kind), *([pick(kind)] if rng.random() < 0.3 else [])], "menu" if kind is MENU_NAMES else "other", int(rng.integers(1, 7)), (1, 25) if kind is not COMMENT_NAMES else (3, 60), 0.0)

    if rng.random() < 0.7:
        blocks.append(Block("w1 w2 w3", "title", frozenset(map(bucket, ["html", "head", "title"])), 0))
        labels.append(0.0)
    for _ in range(int(rng.integers(1, 4))):
        other([])
    main = [pick(MAIN_NAMES), *([pick(MAIN_NAMES)] if rng.random() < 0.4 else [])]
    for _ in range(int(rng.integers(1, 4))):
        add(main, "content", int(rng.integers(1, 8)), (1, 80), 1.0)
        if rng.random() < 0.35:
            other(main)
    for _ in range(int(rng.integers(1, 4))):
        other([])
    return blocks, labels


def _renamed(blocks: list[Block], rng: np.random.Generator) -> list[Block]:
    """The same page with other names for its parts."""
    swaps: dict[int, int] = {}
    for names in (MAIN_NAMES, *_NEVER):
        for name in names:
            if rng.random() < 0.7:
                swaps[bucket(name)] = bucket(names[int(rng.integers(len(names)))])
    return [replace(b, path=frozenset(swaps.get(i, i) for i in b.path)) for b in blocks]


def _reworded(blocks: list[Block], rng: np.random.Generator) -> list[Block]:
    """The same page with its texts exchanged among its blocks: main text may be a word, a menu long."""
    order = rng.permutation(len(blocks))
    return [replace(b, text=blocks[k].text, link_chars=blocks[k].link_chars) for b, k in zip(blocks, order, strict=True)]


def train(pages: list[tuple[list[Block], np.ndarray]], seed: int = 5) -> Weights:
    """Adam on the log loss of the blocks of all pages and of made ones."""
    rng = np.random.default_rng(seed)
    examples = [(b, np.asarray(y, float)) for b, y in (_made_page(rng) for _ in range(MADE_PAGES))]
    examples += pages + [(_reworded(b, rng), y) for b, y in pages] + [(_renamed(b, rng), y) for b, y in pages]
    w = {n: rng.normal(0, 0.15 if len(s) > 1 else 0.0, s) for n, s in _shapes().items()}
    for d in "fb":
        w[f"c{d}"][HIDDEN : 2 * HIDDEN] = 1.0  # remember at first
    mean = {n: np.zeros_like(v) for n, v in w.items()}
    square = {n: np.zeros_like(v) for n, v in w.items()}
    for step in range(1, STEPS + 1):
        chosen = [examples[k] for k in rng.integers(len(examples), size=BATCH)]
        grad = _gradient(w, chosen)
        rate = RATE * min(1.0, 3 * (1 - step / (STEPS + 1)))
        for n in w:
            g = grad[n] + DECAY * w[n]
            mean[n] = 0.9 * mean[n] + 0.1 * g
            square[n] = 0.99 * square[n] + 0.01 * g**2
            w[n] = w[n] - rate * (mean[n] / (1 - 0.9**step)) / (np.sqrt(square[n] / (1 - 0.99**step)) + 1e-8)
    return {n: v.astype(np.float32) for n, v in w.items()}


def _gradient(w: Weights, chosen: list[tuple[list[Block], np.ndarray]]) -> Weights:
    f = featurize([x for b, _ in chosen for x in b])
    cuts = np.cumsum([0, *(len(b) for b, _ in chosen)])
    y_rows = np.concatenate([y for _, y in chosen])
    grad = {n: np.zeros_like(v) for n, v in w.items()}
    rows = _inputs(w, f)
    pages = np.arange(len(chosen))
    x, mask = _padded(rows, cuts, pages)
    y, _ = _padded(y_rows[:, None], cuts, pages)
    ahead, tape_f = _direction(w, "f", x, mask, keep=True)
    back, tape_b = _direction(w, "b", x, mask, keep=True)
    h = np.concatenate([ahead, back], axis=2)
    p = _sigmoid(h @ w["out"] + x @ w["skip"] + w["bias"][0])
    d = np.where(mask, p - y[:, :, 0], 0) / mask.sum()
    grad["out"] += np.einsum("tb,tbh->h", d, h)
    grad["skip"] += np.einsum("tb,tbi->i", d, x)
    grad["bias"] += d.sum()
    dx = d[:, :, None] * w["skip"]
    up = d[:, :, None] * w["out"]
    dx = dx + _backward(w, "f", x, mask, tape_f, up[:, :, :HIDDEN], grad)
    dx = dx + _backward(w, "b", x, mask, tape_b, up[:, :, HIDDEN:], grad)
    time, page = np.nonzero(mask)
    by_row = np.zeros_like(rows)
    by_row[cuts[page] + time] = dx[time, page]
    by_path = np.zeros((len(f.path_cuts) - 1, DIM))
    np.add.at(by_path, f.path, by_row[:, :DIM])
    sizes = np.diff(f.path_cuts)
    np.add.at(grad["path"], f.path_ids, np.repeat(by_path / sizes[:, None], sizes, axis=0))
    np.add.at(grad["leaf"], f.leaf, by_row[:, DIM : 2 * DIM])
    sizes = np.diff(f.word_cuts)
    np.add.at(grad["word"], f.word_ids, np.repeat(by_row[:, 2 * DIM : 3 * DIM] / np.maximum(1, sizes)[:, None], sizes, axis=0))
    return grad


def fit(
    pages: DataFrame,
    page_id: str = "page_id",
    html: str = "html",
    sample_pages: int = SAMPLE_PAGES,
    sample_html_bytes: int = SAMPLE_HTML_BYTES,
) -> Weights:
    """Fits the labeller to pages that name their own main text, to the same pages with other names, and
    to made pages, so an empty table gives a labeller too.

    At most ``sample_pages`` different pages are drawn by a hash of id and html, none of over
    ``sample_html_bytes`` or ``SAMPLE_BLOCKS`` blocks; null pages are not. Repeated rows count once.
    """
    known = pages.select(F.col(page_id).alias("id"), F.col(html).alias("html"))
    known = known.where(F.octet_length("html") <= sample_html_bytes)
    known = known.withColumn("drawn", F.xxhash64("id", "html", F.lit(13)))
    different = known.agg(F.approx_count_distinct("drawn", 0.02)).first()[0]
    share = min(1.0, 1.5 * sample_pages / max(1, different))  # half more than are kept
    drawn = known.where(F.pmod("drawn", F.lit(1 << 30)) < int(share * (1 << 30))).distinct()
    rows = drawn.orderBy("drawn", "id", "html").limit(sample_pages).select("html").collect()
    parsed = [b for b in (parse(r.html) for r in rows) if 0 < len(b) <= SAMPLE_BLOCKS]
    return train([(b, y) for b in parsed if (y := teacher(b)) is not None])


def extract(pages: DataFrame, weights: Weights, html: str = "html") -> DataFrame:
    """``pages`` with ``main_text``: the blocks that the labeller takes for main text, in page order, one a line.

    The whole page counts, however long. A null or empty page, and one without such a block, has
    an empty text. No shuffle; a column of the added name is replaced.
    """
    pages = without(pages, *ADDED)
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, _ in sliced(batches, html):
            parsed = [parse(t or "") for t in rows.column(rows.schema.get_field_index(html)).to_pylist()]
            cuts = np.cumsum([0, *map(len, parsed)])
            blocks = [b for page in parsed for b in page]
            keep = probabilities(shared.value, featurize(blocks), cuts) >= 0.5 if blocks else np.zeros(0, bool)
            texts = ["\n".join(b.text for b, k in zip(page, keep[a:], strict=False) if k) for page, a in zip(parsed, cuts, strict=False)]
            yield with_columns(rows, main_text=pa.array(texts, pa.string()))

    return map_texts(pages, run, schema_with(pages, **ADDED))
