"""Spans beyond the fixed patterns: other spellings on documents the tagger has not seen."""

import numpy as np
import pytest

from searchloom.llm import pii
from searchloom.llm.pii_variants import ambiguous, plausible, respell, respelt_window
from searchloom.llm.tables import read
from searchloom.llm.tagger import codes

VALUES = ["jane.doe+x@mail.example.com", "10.20.30.240", "4111 1111 1111 1111", "+1 (555) 123-4567"]


@pytest.fixture(scope="module")
def tagger(spark):
    docs = read(spark, "/root/testdata/sf0.1", "documents")
    return pii.fit_personal(docs.where("doc_id % 5 <> 0"))


def respelt(text, draw):
    """The text with its personal data spelt anew, and where it is."""
    out, at, gold = "", 0, []
    for kind, a, b in sorted(pii.base_spans(text), key=lambda s: s[1]):
        if a >= at:
            out += text[at:a]
            value = respell(kind, text[a:b], draw)
            gold.append((kind, len(out), len(out) + len(value)))
            out, at = out + value, b
    return out + text[at:], gold


@pytest.mark.parametrize("kind", range(4))
def test_spellings_are_plausible_and_new(kind):
    draw = np.random.default_rng(kind)
    made = {respell(kind, VALUES[kind], draw) for _ in range(60)}
    assert len(made) >= 5
    for value in made:
        assert plausible(kind, value), value
        assert (kind, 0, len(value)) not in pii.base_spans(value)


@pytest.mark.parametrize("value", ["2123465659789240", "3.14159", "2024", "1 2 3", "0ddae3b09ae356cbefecdd3232fa", "300.1.1.1"])
def test_plain_numbers_are_not_plausible(value):
    assert not any(plausible(kind, value) for kind in range(4))


def test_windows_are_respelt_with_their_labels():
    text = "call me at +1 (555) 123-4567 or write, says the note on the door"[:64].ljust(64)
    x = codes(text)
    y = pii._labels(len(x), pii.base_spans(text))
    for seed in range(30):
        own, labels = respelt_window(x, y, np.random.default_rng(seed))
        assert len(own) == len(labels) == 64
        shown = "".join(chr(c) for c in own)
        value = shown[int((labels % 2 == 1).argmax()) :][: int((labels > 0).sum())]
        assert plausible(3, value) and shown.startswith("call me at ")
    assert respelt_window(x, np.zeros_like(y), np.random.default_rng(1)) is None
    assert ambiguous(codes("the number 0172 555 77 39 is his")) and not ambiguous(codes("version 2.0.1 of 2024"))


def test_held_out_spellings_are_found(spark, tagger):
    draw = np.random.default_rng(99)
    held = [r.text or "" for r in read(spark, "/root/testdata/sf0.1", "documents").where("doc_id % 5 = 0").collect()]
    texts, gold = zip(*[respelt(t, draw) for t in held if pii.base_spans(t)])
    found = caught = added = right = 0
    for spans, (base, every) in zip(gold, pii.all_spans(list(texts), tagger)):
        found += len(spans)
        caught += sum(any(x < b and y > a for _, x, y in every) for _, a, b in spans)
        more = [s for s in every if s not in base]
        added += len(more)
        right += sum(any(x < b and y > a for _, a, b in spans) for _, x, y in more)
    assert found > 150 and caught >= 0.85 * found and added > 100 and right >= 0.97 * added
    # Documents as they are hold nothing beyond the patterns, and nothing is added.
    assert all(len(base) == len(every) for base, every in pii.all_spans(held, tagger))


def test_long_numeric_texts_go_in_pieces(tagger):
    table = "".join(f"{n % 97} {n % 89}.{n % 7} " for n in range(40_000))
    assert len(table) > 250_000 and pii._stretches(codes(table)) == [(0, len(table))]
    pieces = pii._pieces(0, len(table))
    assert max(b - a for a, b, _, _ in pieces) <= pii.PIECE
    assert [p[2] for p in pieces[1:]] == [p[3] for p in pieces[:-1]] and pieces[-1][3] == len(table)
    border = pieces[3][3]
    prose = "of the river stone and the cloud paper of green seven window "
    planted = f"{prose}so.42@mail7 dot example dot com {prose}"
    alone = pii.tagged_spans([planted], tagger)[0]
    assert [k for k, _, _ in alone] == [0]
    for shift in (-100, -70, 0, 500):
        at = border + shift
        spans = pii.tagged_spans([table[:at] + planted + table[at:]], tagger)[0]
        assert [(k, a - at, b - at) for k, a, b in spans if at <= a < at + len(planted)] == alone
