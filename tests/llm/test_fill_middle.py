"""Fill-in-the-middle against a plain version on whole strings."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from meshfeed.llm import fill_middle
from meshfeed.llm.fill_middle import Marks


def brute(doc_id, text, seed=1, percent=90, spm_percent=20, marks=("<P>", "<S>", "<M>")):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * n : 8 * n + 8], 16) for n in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    left, middle, right = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, len(units))))
    p, s, m = marks
    if not text or any(x in text for x in marks) or h3 % 100 >= percent:
        return (len(units), "plain", None, None, text)
    form = "spm" if h4 % 100 < spm_percent else "psm"
    out = s + right + p + left + m + middle if form == "spm" else p + left + s + right + m + middle
    return (len(units), form, len(left), len(middle), out)


TEXTS = [
    None, "", "a", "ab cd", "é", "Über die Brücke, 100 %\n\n", "日本語のテキスト abc 日本", "<P>", "x <M> y", "<P<S", "<", "<>",
    "word " * 5000, "a" * 300000, "\x00\x01 zero", "same", "same", "🙂🙂 ok 🙂",
]


@pytest.mark.parametrize("chunk", [1 << 20, 7])
def test_matches_plain_version(spark, monkeypatch, chunk):
    if chunk < 100:
        monkeypatch.setattr(fill_middle, "_CHUNK", chunk)  # also in the numpy parts below
    rows = [(n, t, "kept") for n, t in enumerate(TEXTS * 4)] + [(None, "null id here", "x"), (3, "again", "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, form string")
    out = fill_middle.restore(fill_middle.transform(docs)).collect()
    assert [f.name for f in docs.schema if f.name != "form"] == ["doc_id", "text"]
    got = sorted(((r.doc_id, r.text, r.n_units, r.form, r.prefix_chars, r.middle_chars, r.fim_text) for r in out), key=repr)
    assert got == sorted(((i, t, *brute(i, t)) for i, t, _ in rows), key=repr)
    assert all(r.restored_text == (r.text or "") for r in out)


def test_parameters(spark):
    rows = [(n, f"some text {n} with [M] and more") for n in range(60)]
    docs = spark.createDataFrame(rows, "key bigint, body string")
    marks = Marks("[P]", "[S]", "[MID]")
    options = {"seed": 9, "percent": 50, "suffix_first_percent": 100, "marks": marks}
    out = fill_middle.transform(docs, "key", "body", **options)
    got = {r.key: r.fim_text for r in out.collect()}
    assert got == {i: brute(i, t, 9, 50, 100, ("[P]", "[S]", "[MID]"))[4] for i, t in rows}
    back = fill_middle.restore(out, out="body", marks=marks)  # the column is replaced
    assert {r.key: r.body for r in back.collect()} == dict(rows)


def test_what_is_no_output_gives_null(spark):
    rows = [
        (1, "no marks", "psm"), (2, "<P>a<S>b", "psm"), (3, "<P>a<S>b<M>c<M>", "psm"), (4, "<S>a<P>b<M>c", "psm"),
        (5, "x<P>a<S>b<M>c", "psm"), (6, "a", "unknown"), (7, "a", None), (8, None, "plain"), (9, "<S>a<P>b<M>c", "spm"), (10, "<P><M>", "plain"),
    ]
    found = fill_middle.restore(spark.createDataFrame(rows, "id int, fim_text string, form string"))
    good = {r.id: r.restored_text for r in found.collect() if r.restored_text is not None}
    assert good == {8: "", 9: "bca", 10: "<P><M>"}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert fill_middle.restore(fill_middle.transform(docs)).collect() == []


def test_marks_that_overlap_are_refused():
    for bad in (("<P>", "P>x", "<M>"), ("aba", "c", "d"), ("<P>", "<P>", "<M>"), ("", "a", "b"), ("a<P>b", "<P>", "<M>")):
        with pytest.raises(ValueError):
            Marks(*bad)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="aZ <>é日P", max_size=12), st.integers(0, 2), st.integers(0, 12), st.integers(0, 12)), max_size=6))
def test_scatter_and_gather_are_inverse(rows):
    texts = [t.encode() for t, *_ in rows]
    cuts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    form = np.array([0 if b"<P>" in t else f for t, (_, f, _, _) in zip(texts, rows, strict=True)], np.int64)
    at = [sorted((min(a, len(t)), min(b, len(t)))) for t, (_, _, a, b) in zip(texts, rows, strict=True)]
    at = np.array(at, np.int64).reshape(-1, 2) + cuts[:-1, None]
    out, out_cuts = fill_middle.scatter(data, cuts, at[:, 0], at[:, 1], form, Marks())
    back, back_cuts, sound = fill_middle.gather_back(out, out_cuts, form, Marks())
    assert sound.all() and back.tobytes() == data.tobytes() and back_cuts.tolist() == cuts.tolist()
