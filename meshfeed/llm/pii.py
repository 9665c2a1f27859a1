"""Personal data by candidate gradient boosting, in DataFrame expressions.

Generators with a high recall propose spans that may overlap; boosted trees weigh the format and the
context of each; a calibrated threshold for each kind selects. Spans of the strict base forms, values
that stand behind a secret's name and keys of a known form are always kept.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshfeed.llm.arrow_text import fresh, without
from meshfeed.llm.boosting import Tree, boost
from meshfeed.session import stage

#: The least precision that a threshold must show on the half of the cases that no tree saw.
PRECISION = 0.95
#: Trees of each kind.
ROUNDS = 12
#: Code points on each side of a span that the trees look at.
CONTEXT = 64

#: In the order of a tie between spans; the first four have base forms.
KINDS = ("email", "ip", "card", "phone", "secret")
ADDED = ("base_spans", "pii_spans")
#: Columns of :func:`propose`.
PROPOSED = ("pii_base", "pii_loose")

_SPAN = "struct<start:int,end:int,kind:int,sure:boolean,text:string,left:string,right:string>"
_CASE = "array<struct<kind:int,text:string,left:string,right:string>>"
#: A character of the private area that marks the ends of matches; in a text it counts as its neighbour.
_MARK, _OTHER = "\ue000", "\ue001"
#: Elements of an array that a running sum handles at once: appending copies what is there.
_CHUNK = 256


@dataclass(frozen=True)
class Generator:
    """A pattern for one kind. ``needs`` is a cheap pattern that any match implies. If the pattern has two
    groups the span is the second, at the match's end. Base generators have a check that their
    matches must pass; matches that fail are dropped for good. ``sure`` spans are no matter of the
    trees."""

    kind: str
    pattern: str
    needs: str
    check: Callable[[Column], Column] | None = None
    grouped: bool = False
    sure: bool = False


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_OCTETS = rf"^{_OCTET}[.,-]{_OCTET}[.,-]{_OCTET}[.,-]{_OCTET}$"

# The base forms, written so that a failed start is not tried again inside its run of characters and
# nothing nests: time follows the text's length, and no long match can exhaust the stack.
BASE = (
    Generator(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        lambda t: F.lit(True),
    ),
    Generator(
        "ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", lambda t: t.rlike(_OCTETS)
    ),
    Generator(
        "card",
        r"[0-9](?:[ -]?[0-9])++",
        r"[0-9][ -]?[0-9]",
        lambda t: F.length(_digits(t)).between(14, 19) & F.call_function("luhn_check", _digits(t)),
    ),
    Generator("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]", lambda t: F.length(_digits(t)).between(10, 15)),
)
_SECRET_WORD = "(?i:password|passwd|passphrase|pwd|token|secret|api[ _-]?key|bearer|credential)"
_RUN = "[A-Za-z0-9+/_-]"
_NAME = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++"
_LABEL = r"[\p{L}\p{N}-]++"
_DOT = r"(?:\.| ?(?:\(dot\)|\[dot\]) ?)"
LOOSE = (
    # the whole value behind a secret's name, however far the sign stands off
    Generator(
        "secret",
        rf"({_SECRET_WORD}\s*+[=:]\s*+[\"']?+)([^\s\"',;]*[^\s\"',;.:!?)\]}}>])",
        rf"{_SECRET_WORD}\s*+[=:]",
        grouped=True,
        sure=True,
    ),
    Generator("secret", r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])", "A(?:K|S)IA[A-Z0-9]{16}", sure=True),
    Generator(
        "email",
        rf"{_NAME}(?: ?(?:@|\(at\)|\[at\]) ?{_LABEL}(?:{_DOT}{_LABEL})++| at {_LABEL}(?: dot {_LABEL})++)",
        r"@|[(\[]at[)\]]| dot ",
    ),
    Generator("ip", r"(?<![0-9])[0-9]{1,3}(?:[.,-][0-9]{1,3}){3}(?![0-9])", r"[0-9][.,-][0-9]"),
    Generator("card", r"(?<![0-9])[0-9](?:[ ._-]?[0-9]){12,18}(?![0-9])", r"[0-9][ ._-]?[0-9]"),
    Generator("phone", r"(?<![0-9])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])", r"[0-9][ .-][0-9]"),
    Generator("secret", rf"(?<!{_RUN}){_RUN}{{12,}}+", rf"{_RUN}{{12}}"),
)
_KEYWORD = (
    r"(?i)(?:pass|passwd|pwd|token|secret|key|bearer|credential|mail|contact|tel|phone|call|fax|mobile|card|"
    r"visa|account|iban|ip|host|address|server)[\p{L}]*+\W*+(?:\p{L}{1,3}\W*+)?$"
)


def _between(text: Column, cuts: tuple[int, ...]) -> Column:
    """The number of ``cuts`` that a number has reached."""
    return reduce(lambda a, b: a + b, [(text >= c).cast("int") for c in cuts])


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


#: Features by name, of a candidate's struct (kind, text, left, right), with how many values each has. None
#: repeats a pattern that makes a span sure or a label.
FEATURES: dict[str, tuple[int, Callable[[Column], Column]]] = {
    "kind": (5, lambda c: c["kind"]),
    "digits": (7, lambda c: _between(F.length(_digits(c["text"])), (1, 7, 10, 12, 14, 20))),
    "length": (5, lambda c: _between(F.length(c["text"]), (14, 18, 24, 36))),
    "luhn": (2, lambda c: _flag(F.call_function("luhn_check", _digits(c["text"])))),
    "octets": (2, lambda c: _flag(c["text"].rlike(_OCTETS))),
    "separators": (3, lambda c: _flag(c["text"].rlike("[ ()-]")) + _flag(c["text"].rlike("[._,]"))),
    "head": (4, lambda c: F.when(c["text"].rlike("^[0-9]"), 0).when(c["text"].rlike("^[+]"), 1).when(c["text"].rlike(r"^\p{L}"), 2).otherwise(3)),
    "before": (3, lambda c: _side(F.right(c["left"], F.lit(1)))),
    "after": (3, lambda c: _side(F.left(c["right"], F.lit(1)))),
    "keyword": (2, lambda c: _flag(c["left"].rlike(_KEYWORD))),
    "mixed": (2, lambda c: _flag(c["text"].rlike("[0-9]") & c["text"].rlike("[A-Za-z]"))),
    "changes": (4, lambda c: _between(F.length(F.regexp_replace(c["text"], r"([0-9])(?=[A-Za-z])|([A-Za-z])(?=[0-9])|.", "$1$2")), (2, 4, 8))),
    "at": (3, lambda c: _flag(c["text"].rlike(r"[(\[]at[)\]]")) + 2 * _flag(c["text"].rlike("@"))),
}


def _side(character: Column) -> Column:
    return F.when(character.rlike(r"[\p{L}\p{N}]"), 1).when((character == "") | character.rlike(r"\s"), 0).otherwise(2)


@dataclass(frozen=True)
class Model:
    """Trees for the log odds of a candidate, and for each kind the least log odds that select it."""

    trees: list[Tree]
    thresholds: dict[str, float]


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named. Inside a lambda nothing else
    keeps an expression from being computed for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(
    items: Column, start: Column, step: Callable[[Column, Column], Column], out: Callable[[Column, Column], Column], kind: str
) -> Column:
    """``out(state, item)`` of every item of an array, where ``step`` leads from each state to the next. Items
    go in chunks, so that an array of n results is not copied n times."""
    none = F.array().cast(f"array<{kind}>")

    def one(done: Column, item: Column) -> Column:
        return F.struct(
            step(done["state"], item).alias("state"), F.concat(done["out"], F.array(out(done["state"], item))).alias("out")
        )

    def many(done: Column, chunk: Column) -> Column:
        first = F.struct(done["state"].alias("state"), none.alias("out"))
        return F.aggregate(
            chunk, first, one,
            lambda end: F.struct(end["state"].alias("state"), F.concat(done["out"], F.array(end["out"])).alias("out")),
        )

    first = F.struct(start.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("out"))
    return _let(
        items,
        lambda all_: F.when(F.size(all_) > 0, F.aggregate(_chunks(all_), first, many, lambda end: F.flatten(end["out"]))).otherwise(none),
    )


def _chunks(items: Column) -> Column:
    """A list that is not empty, in lists of at most ``_CHUNK``."""
    last = F.floor((F.size(items) - 1) / _CHUNK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(items, k * _CHUNK + 1, _CHUNK))


def _spans(parts: Column, kind: int, sure: bool) -> Column:
    """The matches among ``parts`` (text, match, text, match, ... text) with their places, in code points."""
    found = F.transform(
        F.when(F.size(parts) > 1, F.sequence(F.lit(1), F.size(parts) - 2, F.lit(2))).otherwise(F.array().cast("array<int>")),
        lambda k: F.struct(
            F.get(parts, k).alias("text"),
            F.length(F.get(parts, k)).alias("length"),
            F.length(F.get(parts, k - 1)).alias("gap"),
            F.right(F.get(parts, k - 1), F.lit(CONTEXT)).alias("left"),
            F.left(F.get(parts, k + 1), F.lit(CONTEXT)).alias("right"),
        ),
    )

    def placed(at: Column, part: Column) -> Column:
        return F.struct(
            (at + part["gap"]).alias("start"), (at + part["gap"] + part["length"]).alias("end"), F.lit(kind).alias("kind"),
            F.lit(sure).alias("sure"), part["text"].alias("text"), part["left"].alias("left"), part["right"].alias("right"),
        )

    return _running(found, F.lit(0), lambda at, p: at + p["gap"] + p["length"], placed, _SPAN)


def _candidates(docs: DataFrame, text: str, generators: tuple[Generator, ...], out: str) -> DataFrame:
    """``docs`` with all matches of the generators as one array of spans, checked ones only. A text is
    searched once for each generator: its matches are marked, and the text is cut at the marks."""
    parts = []
    whole = F.when(F.contains(F.col(text), F.lit(_MARK)), F.translate(text, _MARK, _OTHER)).otherwise(F.col(text))
    for k, g in enumerate(generators):
        cut, spans = (fresh(docs, f"{out}_{n}{k}") for n in ("parts", "spans"))
        marked = F.regexp_replace(whole, F.lit(g.pattern), F.lit(f"$1{_MARK}$2{_MARK}" if g.grouped else f"{_MARK}$0{_MARK}"))
        docs = docs.withColumn(cut, F.when(whole.rlike(g.needs), F.split(marked, _MARK, -1)))
        found = F.when(F.size(cut) > 1, _spans(F.col(cut), KINDS.index(g.kind), g.sure)).otherwise(F.array().cast(f"array<{_SPAN}>"))
        docs = docs.withColumn(spans, found).drop(cut)
        if g.check is not None:
            docs = docs.withColumn(spans, _checked(spans, g.check))
        parts.append(spans)
    return docs.withColumn(out, F.array_sort(F.concat(*parts))).drop(*parts)


def _checked(spans: str, check: Callable[[Column], Column]) -> Column:
    return F.filter(spans, lambda s: check(s["text"]))


def _features(c: Column) -> Column:
    return F.struct(*[make(c).cast("int").alias(n) for n, (_, make) in FEATURES.items()])


def _without_overlaps(docs: DataFrame, base: str, loose: str) -> DataFrame:
    """``docs`` without the spans of column ``loose`` that touch one of ``base``. Both lists in one order, looked
    through from each side: a span is free if the base spans before it end by its start, and those
    behind it start at its end."""
    shape = f"struct<start:int,loose:boolean,s:{_SPAN},fits:boolean>"
    both = fresh(docs, "pii_both")

    def tagged(spans: str, mine: bool) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(mine).alias("loose"), s.alias("s")))

    def clear(forward: bool) -> Column:
        def step(edge: Column, x: Column) -> Column:
            reached = F.greatest(edge, x["s"]["end"]) if forward else F.least(edge, x["s"]["start"])
            return F.when(x["loose"], edge).otherwise(reached)

        def out(edge: Column, x: Column) -> Column:
            fits = x["s"]["start"] >= edge if forward else x["s"]["end"] <= edge
            return F.struct(x["start"].alias("start"), x["loose"].alias("loose"), x["s"].alias("s"), (~x["loose"] | fits).alias("fits"))

        return _running(F.col(both), F.lit(-1 if forward else (1 << 31) - 1), step, out, shape)

    apart = (F.size(base) == 0) | (F.size(loose) == 0)
    some = F.when(~apart, F.array_sort(F.concat(tagged(base, False), tagged(loose, True))))
    docs = docs.withColumn(both, some)  # of an equal start the base span stands first
    docs = docs.withColumn(both, F.when(F.col(both).isNotNull(), F.reverse(F.filter(clear(True), lambda x: x["fits"]))))
    docs = docs.withColumn(both, F.when(F.col(both).isNotNull(), F.filter(clear(False), lambda x: x["fits"] & x["loose"])))
    free = F.transform(F.reverse(both), lambda x: x["s"])
    return docs.withColumn(loose, F.when(F.col(both).isNull(), F.col(loose)).otherwise(free)).drop(both)


def propose(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with all candidates of its whole texts: ``pii_base``, those of the base forms, and ``pii_loose``,
    those of the generators that touch none of them. :func:`fit` and :func:`select` take them from a
    stored table, so that texts are searched once. No shuffle and no Python."""
    docs = without(docs, *PROPOSED)
    base, loose = PROPOSED
    found = _candidates(_candidates(docs, text, BASE, base), text, LOOSE, loose)
    return _without_overlaps(found, base, loose)


def _rewritten(span: Column) -> Column:
    """A span of a base form, or a secret, as the loose generators would meet it: other separators, an
    address spelled out, a number without its country, a secret away from its name. Context as it was,
    but for secrets."""
    text = span["text"]

    def like(new: Column, left: Column | None = None) -> Column:
        return F.struct(span["kind"].alias("kind"), new.alias("text"), (span["left"] if left is None else left).alias("left"), span["right"].alias("right"))

    national = F.regexp_replace(_digits(text), "^.*([0-9]{3})([0-9]{3})([0-9]{4})$", "$1 $2 $3")
    forms = {
        "email": [like(F.replace(F.regexp_replace(text, "@", t), F.lit("."), F.lit(d))) for t, d in ((" (at) ", " (dot) "), (" [at] ", "."), ("(at)", "."))],
        "ip": [like(F.replace(text, F.lit("."), F.lit(t))) for t in (",", "-")],
        # also beside another number, with which the base form would take it together
        "card": [like(F.regexp_replace(_digits(text), "([0-9]{4})(?=[0-9])", f"$1{t}")) for t in (".", "_", "-", " ", "")],
        "phone": [
            *[like(F.replace(national, F.lit(" "), F.lit(t))) for t in (" ", "-", ".")],
            like(F.regexp_replace(national, r"^([0-9]{3}) ([0-9]{3}) ([0-9]{4})$", "($1) $2-$3")),
        ],
        "secret": [like(text, F.lit(t)) for t in ("my password is ", "use ", "", "token ")],
    }
    return reduce(
        lambda w, x: w.when(span["kind"] == KINDS.index(x[0]), F.array(*x[1]).cast(_CASE)), forms.items(), F.when(F.lit(False), F.array().cast(_CASE))
    )


def _broken(span: Column) -> Column:
    """Near misses of a base span, in its context: a card number with a wrong digit, an octet too large, a
    number with too few or too many digits."""
    text = span["text"]
    digits = _digits(text)

    def like(new: Column) -> Column:
        return F.struct(span["kind"].alias("kind"), new.alias("text"), span["left"].alias("left"), span["right"].alias("right"))

    wrong = F.concat(F.substring(digits, F.lit(1), F.length(digits) - 1), ((F.right(digits, F.lit(1)).cast("int") + 1) % 10).cast("string"))
    forms = {
        "ip": [like(F.regexp_replace(F.replace(text, F.lit("."), F.lit(t)), "^[0-9]+", "700")) for t in (".", ",", "-")],
        "card": [like(F.regexp_replace(wrong, "([0-9]{4})(?=[0-9])", f"$1{t}")) for t in (".", "_", "-", " ", "")],
        "phone": [
            like(F.regexp_replace(digits, "^.*([0-9]{3})([0-9]{3})([0-9]{3})$", f"$1{t}$2{t}$3")) for t in (" ", "-", ".")
        ] + [like(F.regexp_replace(F.concat(F.lit("70"), digits), "^.*([0-9]{4})([0-9]{4})([0-9]{4})$", f"$1{t}$2{t}$3")) for t in ("-", ".")],
    }
    none = F.array().cast(_CASE)
    return reduce(lambda w, x: w.when(span["kind"] == KINDS.index(x[0]), F.array(*x[1]).cast(_CASE)), forms.items(), F.when(F.lit(False), none)).otherwise(none)


def _proposable(c: Column) -> Column:
    """Whether a loose generator that is not sure would propose just this text."""
    tests = [(c["kind"] == KINDS.index(g.kind)) & c["text"].rlike(rf"^(?:{g.pattern})$") for g in LOOSE if not g.sure]
    return reduce(lambda a, b: a | b, tests)


def _of_kind(kind: int, tree: Tree) -> Tree:
    """The tree for candidates of one kind, nothing for others."""
    here = Tree(0.0, "kind", kind, tree, Tree())
    return Tree(0.0, "kind", kind - 1, Tree(), here) if kind else here


def fit(docs: DataFrame, text: str = "text", precision: float = PRECISION) -> Model:
    """Fits trees and thresholds to the candidates of a whole table: documents, or what :func:`propose` made of
    them.

    Nobody has labelled personal data, so cases are made: every base span, and every secret behind its
    name, is rewritten in forms that no base form matches and put back into its context. Near misses of
    base spans, and what the generators propose elsewhere, count as no cases, though some of the
    latter may be one, so precision is rather understated. Repeated candidates count once. What goes to the driver is the number of
    cases and others for each combination of features: at most the product of their numbers of
    values, whatever the input. Half of the candidates, by a hash, grow the trees; on the other half
    each kind gets the least threshold that shows ``precision``. All documents count. Without cases
    the trees select nothing.
    """
    proposed = docs if set(PROPOSED) <= set(docs.columns) else propose(docs, text)
    known = F.concat(PROPOSED[0], F.filter(PROPOSED[1], lambda s: s["sure"]))
    cases = F.filter(F.flatten(F.transform(known, _rewritten)), _proposable)
    misses = F.filter(F.flatten(F.transform(PROPOSED[0], _broken)), _proposable)
    others = F.transform(
        F.filter(PROPOSED[1], lambda s: ~s["sure"]),
        lambda s: F.struct(s["kind"].alias("kind"), s["text"].alias("text"), s["left"].alias("left"), s["right"].alias("right")),
    )
    others = F.concat(others, misses)
    both = F.concat(F.transform(cases, lambda c: F.struct(c.alias("c"), F.lit(1).alias("label"))), F.transform(others, lambda c: F.struct(c.alias("c"), F.lit(0).alias("label"))))
    # outer, or the optimizer adds a test for non-empty arrays that computes all candidates once more
    rows = proposed.select(F.explode_outer(both).alias("x")).where("x is not null").select("x.c", "x.label")
    key = F.xxhash64("c.kind", "c.text", "c.left", "c.right")
    counts = (
        rows.select(key.alias("key"), _features(F.col("c")).alias("f"), "label")
        .distinct()
        .groupBy(F.pmod("key", F.lit(2)).alias("half"), "f")
        .agg(F.sum("label").alias("ones"), F.count("*").alias("n"))
        .select("half", "f.*", "ones", "n")
        .collect()
    )
    names = list(FEATURES)
    counts.sort(key=lambda r: (r.half, *(r[n] for n in names)))
    x = np.array([[r[n] for n in names] for r in counts], int).reshape(len(counts), len(names))
    ones = np.array([r.ones for r in counts], float)
    zeros = np.array([r.n for r in counts], float) - ones
    grow = np.array([r.half == 0 for r in counts], bool)
    if not ones[grow].sum():
        return Model([], {})
    trees = []
    for k in range(len(KINDS)):
        own = grow & (x[:, names.index("kind")] == k)
        if ones[own].sum():
            # one kind's cases say nothing about another's: "no digit" speaks against a secret, not an address
            trees += [_of_kind(k, t) for t in boost(x[own], ones[own], zeros[own], names, ROUNDS)]
    odds = sum((t.score(x, names) for t in trees), np.zeros(len(x)))
    thresholds = {}
    for k, kind in enumerate(KINDS):
        own = ~grow & (x[:, names.index("kind")] == k) if len(x) else grow
        order = np.flatnonzero(own)[np.argsort(-odds[own], kind="stable")]
        right, all_ = np.cumsum(ones[order]), np.cumsum(ones[order] + zeros[order])
        last = np.append(odds[order][1:] < odds[order][:-1], True)[: len(order)]  # equal odds go together
        good = np.flatnonzero(last & (right >= precision * all_) & (odds[order] > 0))
        if len(good):
            # half way to the next lower odds, which would not do; below even odds nothing is selected
            least, below = odds[order][good[-1]], odds[order][good[-1] + 1 :]
            thresholds[kind] = max(0.0, float(least + below[0]) / 2) if len(below) else 0.0
    return Model(trees, thresholds)


def _odds_pass(s: Column, model: Model) -> Column:
    """Whether a candidate ``s.c`` with features ``s.f`` is sure or selected by the model."""
    limits = [(KINDS.index(kind), F.lit(least)) for kind, least in model.thresholds.items()]
    if not model.trees or not limits:
        return s["c"]["sure"]
    odds = reduce(lambda a, b: a + b, [t.column(s["f"]) for t in model.trees])
    least = reduce(lambda w, x: w.when(s["c"]["kind"] == x[0], x[1]), limits[1:], F.when(s["c"]["kind"] == limits[0][0], limits[0][1]))
    return s["c"]["sure"] | F.coalesce(odds >= least, F.lit(False))


def _apart(spans: Column) -> Column:
    """Spans by start, the longer first; one that begins inside an earlier one that stays is left out."""
    ordered = F.array_sort(
        spans,
        lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"])
        .when(a["end"] != b["end"], b["end"] - a["end"])
        .otherwise(a["kind"] - b["kind"]),
    )
    marked = _running(
        ordered,
        F.lit(0),
        lambda at, c: F.greatest(at, c["end"]),
        lambda at, c: F.struct(c.alias("c"), (c["start"] >= at).alias("stays")),
        f"struct<c:{_SPAN},stays:boolean>",
    )
    return F.transform(F.filter(marked, lambda m: m["stays"]), lambda m: m["c"])


def _plain(spans: Column) -> Column:
    """Spans as start, kind number and end, in that order, with the kind's name."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"), s["kind"].alias("rank"), s["end"].alias("end"), F.get(names, s["kind"]).alias("kind")
            ),
        )
    )


def select(proposed: DataFrame, model: Model) -> DataFrame:
    """:func:`find` on the candidates of :func:`propose`, which are dropped."""
    base, loose = PROPOSED
    sure = fresh(proposed, "pii_sure")
    found = proposed.withColumn(loose, F.transform(loose, lambda c: F.struct(c.alias("c"), _features(c).alias("f"))))
    found = found.withColumn(loose, F.transform(F.filter(loose, lambda s: _odds_pass(s, model)), lambda s: s["c"]))
    # a sure span comes before any other; of the rest the first one, or the longer, of those that overlap
    found = found.withColumn(sure, _apart(F.filter(loose, lambda c: c["sure"])))
    found = found.withColumn(loose, F.filter(loose, lambda c: ~c["sure"]))
    found = _without_overlaps(found, sure, loose).withColumn(loose, F.concat(sure, _apart(F.col(loose))))
    found = without(found, sure, *ADDED).withColumns(
        {"base_spans": _plain(F.col(base)), "pii_spans": _plain(F.concat(base, loose))}
    )
    return found.drop(*PROPOSED)


def find(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``pii_spans`` (all spans): start, rank, end, kind of each, by start and then
    kind; offsets in code points, end exclusive.

    Everything is expressions over the row: no shuffle and no Python. A null or empty text has no
    spans. Base spans of different kinds may overlap; the others overlap nothing. Columns of the
    added names are replaced.
    """
    return select(propose(without(docs, *ADDED), text), model)


def span_list(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _replaced(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets. Spans go in chunks, each on its own piece
    of the text, so that a place is not counted from the text's start for every span."""
    reached = _running(
        spans,
        F.lit(0),
        lambda at, s: F.greatest(at, s["end"]),
        lambda at, s: F.struct(at.alias("at"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
        "struct<at:int,start:int,end:int,kind:string>",
    )
    # of overlapping spans the first one's mark stands for all
    marks = F.filter(reached, lambda s: s["start"] >= s["at"])

    def piece(c: Column) -> Column:
        from_ = F.get(c, F.lit(0))["at"]
        return F.struct(from_.alias("from"), F.substring(text, from_ + 1, F.element_at(c, -1)["start"] - from_).alias("body"), c.alias("marks"))

    def marked(p: Column, s: Column) -> Column:
        return F.concat(F.substring(p["body"], s["at"] - p["from"] + 1, s["start"] - s["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))

    out = _let(
        marks,
        lambda all_: F.transform(
            F.transform(_chunks(all_), piece), lambda p: F.array_join(F.transform(p["marks"], lambda s: marked(p, s)), "")
        ),
    )
    end = F.array_max(F.transform(spans, lambda s: s["end"]))
    return F.concat(F.array_join(out, ""), F.substring(text, end + 1, F.length(text)))


def redact(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; overlapping spans by that of
    the first. Other columns are unchanged, and so are texts without spans, null ones included."""
    copy = fresh(docs, "pii_docs")
    rows = docs.select(F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]).alias(copy))
    return redact_proposed(propose(rows.withColumn("text", F.col(copy)[text])), model, copy, docs.columns, text)


def fit_and_redact(docs: DataFrame, text: str = "text", precision: float = PRECISION) -> DataFrame:
    """:func:`redact` with a model of the same documents. They are written once with their candidates, so
    that texts are searched once."""
    copy = fresh(docs, "pii_docs")
    rows = docs.select(F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]).alias(copy))
    proposed = stage(propose(rows.withColumn("text", F.col(copy)[text])).drop("text"), "candidates")
    proposed = proposed.withColumn("text", F.col(copy)[text])
    return redact_proposed(proposed, fit(proposed.select(*PROPOSED), precision=precision), copy, docs.columns, text)


def redact_proposed(proposed: DataFrame, model: Model, copy: str, columns: list[str], text: str) -> DataFrame:
    """The input's ``columns`` from the struct ``copy``, ``text`` redacted."""
    found = select(proposed, model)
    clean = F.when(F.size("pii_spans") > 0, _replaced(F.col("text"), F.col("pii_spans"))).otherwise(F.col("text"))
    found = found.withColumn("text", clean)
    return found.select(*[(F.col("text") if c == text else F.col(copy)[c]).alias(c) for c in columns])
