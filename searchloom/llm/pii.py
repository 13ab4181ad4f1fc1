"""Personal data: fixed patterns, and a tagger that adds what it has learnt from them."""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from searchloom.llm.blocks import Block, blocks
from searchloom.llm.pii_variants import ambiguous, plausible, respelt_window
from searchloom.llm.tables import bounded_sample, id_text, text_batches
from searchloom.llm.tagger import PAD, Tagger, codes, fit_tagger
from searchloom.session import stage

KINDS = ("email", "ip", "card", "phone")

_LOCAL = r"[A-Za-z0-9._%+-]"
_MAIL = _LOCAL + r"++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_MAIL_HERE = re.compile(_MAIL)
_MAIL_FIRST = re.compile(rf"(?<!{_LOCAL})" + _MAIL)
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

WINDOW, STRIDE, MARGIN = 64, 32, 24
PER_KIND = 400  # windows of each kind, and without any, that the tagger is fitted on at most
SPELLINGS = 2  # further windows made of each, its personal data spelt in another way
SURE = 0.8  # least mean chance of the labels of an added span
PIECE, OVERLAP = 4096, 256  # longer stretches are decoded in pieces, which share so many characters

_TRIGGER = np.zeros(256, bool)
_TRIGGER[0x30:0x3A] = True
_TRIGGER[ord("@")] = True

# What may hang on to either end of a span and is no part of it.
_EDGE = " \n\t,;:!?\"'<>"

Span = tuple[int, int, int]  # kind, start, end


def _emails(text: str) -> Iterable[tuple[int, int]]:
    """A run of name characters is tried from its start only: if that fails, so does the rest of it."""
    at = 0
    while True:
        found = _MAIL_HERE.match(text, at) or _MAIL_FIRST.search(text, at)
        if found is None:
            return
        yield found.span()
        at = found.end()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) << (i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _is_ip(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def _is_card(text: str) -> bool:
    digits = _NOT_DIGIT.sub("", text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def _is_phone(text: str) -> bool:
    return 9 <= len(_NOT_DIGIT.sub("", text)) <= 15


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns by kind, then start, in code points."""
    spans = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    for kind, pattern, passes in ((1, _IP, _is_ip), (2, _CARD, _is_card), (3, _PHONE, _is_phone)):
        spans += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if passes(m[0])]
    return spans


def _stretches(x: np.ndarray) -> list[tuple[int, int]]:
    """Text around digits and at-signs, where personal data of these kinds can be."""
    ascii_ = np.minimum(x, 255)
    at = np.flatnonzero(_TRIGGER[ascii_])
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > 2 * MARGIN)
    first = at[np.append(0, cut + 1)] - MARGIN
    last = at[np.append(cut, len(at) - 1)] + MARGIN + 1
    return list(zip(np.maximum(first, 0).tolist(), np.minimum(last, len(x)).tolist()))


def _windows(x: np.ndarray, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping windows over a stretch, padded at its end, and where they begin."""
    n = max(1, -(-(end - start - WINDOW) // STRIDE) + 1)
    begin = start + STRIDE * np.arange(n)
    at = begin[:, None] + np.arange(WINDOW)[None]
    return np.where(at < end, x[np.minimum(at, len(x) - 1)], PAD), begin


def _labels(length: int, spans: list[Span]) -> np.ndarray:
    """0 outside; 1 + 2 * kind where a span begins, 2 + 2 * kind inside it."""
    y = np.zeros(length, np.int64)
    for kind, a, b in sorted(spans, key=lambda s: (-s[0], s[1])):
        y[a:b] = 2 + 2 * kind
        y[a] = 1 + 2 * kind
    return y


def _texts_with_triggers(column: pa.Array) -> Iterable[tuple[int, str]]:
    for block in blocks(column):
        for row in np.flatnonzero(_triggers(block)):
            yield block.first + int(row), block.text(row).decode("utf-8", "replace")


def _triggers(block: Block) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(_TRIGGER[block.data])])
    return np.diff(sums[block.offsets])


def fit_personal(
    docs: DataFrame, per_kind: int = PER_KIND, epochs: int = 8, spellings: int = SPELLINGS
) -> Tagger | None:
    """Fit the tagger on windows of ``docs`` labelled by the fixed patterns, and on respelt ones.

    At most ``per_kind`` windows of each kind and as many without personal data, those of
    the smallest hashes; that is all that reaches the driver.  Each labelled window comes in ``spellings``
    other spellings too; windows without labels whose digits may be personal data teach nothing and are
    left out.  None without any span.
    """

    def cut(batches):
        for batch in batches:
            x_out, y_out, kind = [], [], []
            for _, text in _texts_with_triggers(batch.column(1)):
                x, spans = codes(text), base_spans(text)
                y = _labels(len(x), spans)
                for start, end in _stretches(x):
                    windows, begin = _windows(x, start, end)
                    for w, a in zip(windows, begin.tolist()):
                        own = np.zeros(WINDOW, np.int64)
                        have = y[a : min(a + WINDOW, end)]
                        own[: len(have)] = have
                        x_out.append(w.astype(np.uint8).tobytes())
                        y_out.append(own.astype(np.uint8).tobytes())
                        kind.append(int(own.max() + 1) // 2 - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x_out, pa.binary()), pa.array(y_out, pa.binary()), pa.array(kind, pa.int32())],
                names=["x", "y", "kind"],
            )

    cut_out = id_text(docs).mapInArrow(cut, "x binary, y binary, kind int")
    windows = stage(cut_out.groupBy("x", "y").agg(F.min("kind").alias("kind")), "tagger-windows")
    x, y, found = [], [], 0
    for kind in range(-1, len(KINDS)):
        rows = bounded_sample(windows.where(F.col("kind") == kind), F.xxhash64("x", "y"), per_kind).collect()
        rows.sort(key=lambda r: (r["x"], r["y"]))
        found += len(rows) if kind >= 0 else 0
        pairs = [[np.frombuffer(r[c], np.uint8).astype(np.int64) for c in "xy"] for r in rows]
        pairs = [p for p in pairs if kind >= 0 or not ambiguous(p[0])]
        draw = np.random.default_rng(kind + 2)
        more = [respelt_window(*p, draw) for p in pairs for _ in range(spellings)] if kind >= 0 else []
        pairs += [p for p in more if p is not None]
        x += [p[0] for p in pairs]
        y += [p[1] for p in pairs]
    if not found:
        return None
    return fit_tagger(np.stack(x), np.stack(y), 1 + 2 * len(KINDS), epochs=epochs)


def _pieces(start: int, end: int) -> list[tuple[int, int, int, int]]:
    """A stretch in pieces, and which places of each count: the middle of what two share divides them."""
    if end - start <= PIECE:
        return [(start, end, start, end)]
    begins = list(range(start, end - OVERLAP, PIECE - OVERLAP))
    cuts = [start, *[b + OVERLAP // 2 for b in begins[1:]], end]
    return [(b, min(b + PIECE, end), cuts[n], cuts[n + 1]) for n, b in enumerate(begins)]


def tagged_spans(texts: list[str], tagger: Tagger, batch: int = 512) -> list[list[Span]]:
    """Spans the tagger sees in each text.

    The windows of a stretch are scored apart; where they overlap their scores are
    averaged, the middle of a window counting most, and one best path is found over the
    whole stretch, so spans do not end at windows.  A stretch of more than ``PIECE`` characters is decoded
    in pieces, and a span belongs to the piece in whose part it begins; so what is
    held grows with pieces, not with the text, as long as a span is under half of ``OVERLAP``.
    """
    out: list[list[Span]] = [[] for _ in texts]
    todo = []
    for i, text in enumerate(texts):
        x = codes(text)
        todo += [(i, x, *piece) for a, b in _stretches(x) for piece in _pieces(a, b)]
    todo.sort(key=lambda s: s[3] - s[2])
    weight = 1.0 + np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])
    at = 0
    while at < len(todo):
        part, rows = [], 0
        while at < len(todo):
            i, x, a, b, low, high = todo[at]
            cut, begin = _windows(x, a, b)
            if part and rows + len(cut) > batch:
                break
            part.append((i, a, cut, begin, b, low, high))
            rows += len(cut)
            at += 1
        windows = np.concatenate([p[2] for p in part])
        scores = np.concatenate([tagger.emissions(windows[i : i + batch]) for i in range(0, len(windows), batch)])
        lengths = np.array([p[4] - p[1] for p in part])
        joined = np.zeros((len(part), int(lengths.max()), tagger.labels))
        used = 0
        for j, (_, start, _, begin, end, _, _) in enumerate(part):
            sums = np.zeros((end - start + WINDOW, tagger.labels))
            total = np.zeros(end - start + WINDOW)
            for b in begin.tolist():
                sums[b - start : b - start + WINDOW] += scores[used] * weight[:, None]
                total[b - start : b - start + WINDOW] += weight
                used += 1
            n = end - start
            joined[j, :n] = sums[:n] / total[:n, None]
        path, chance = tagger.decode(joined, lengths)
        for j, (i, start, _, _, end, low, high) in enumerate(part):
            spans = _read(path[j, : end - start], chance[j, : end - start], start, texts[i])
            out[i] += [s for s in spans if low <= s[1] < high]
    return out


def _read(path: np.ndarray, chance: np.ndarray, start: int, text: str) -> list[Span]:
    kind = np.where(path > 0, (path + 1) // 2 - 1, -1)
    begins = np.flatnonzero((path % 2 == 1) | ((kind >= 0) & (np.append(-1, kind[:-1]) != kind)))
    spans = []
    for a in begins.tolist():
        b = a + 1
        while b < len(path) and path[b] == 2 + 2 * kind[a]:
            b += 1
        if float(chance[a:b].mean()) < SURE:
            continue
        value = text[start + a : start + b]
        left = len(value) - len(value.lstrip(_EDGE))
        value = value.strip(_EDGE)
        if plausible(int(kind[a]), value):
            spans.append((int(kind[a]), start + a + left, start + a + left + len(value)))
    return spans


def all_spans(texts: list[str], tagger: Tagger | None) -> list[tuple[list[Span], list[Span]]]:
    """For each text the fixed spans, and these with the tagger's that overlap none of them."""
    base = [base_spans(t) for t in texts]
    more = tagged_spans(texts, tagger) if tagger is not None else [[] for _ in texts]
    out = []
    for text, fixed, added in zip(texts, base, more):
        taken = np.zeros(len(text), bool)
        for _, a, b in fixed:
            taken[a:b] = True
        free = [s for s in added if not taken[s[1] : s[2]].any()]
        out.append((fixed, sorted(fixed + free)))
    return out


SPANS = "array<struct<kind:int,start:bigint,stop:bigint>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64())]))


def _as_spans(rows: list[list[Span]]) -> pa.Array:
    return pa.array([[{"kind": k, "start": a, "stop": b} for k, a, b in r] for r in rows], _SPAN_TYPE)


def find_personal(
    docs: DataFrame, tagger: Tagger | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, base, spans``, one row per row of ``docs``.

    ``base`` holds the fixed patterns' spans by kind and start, in code points; ``spans``
    also those the tagger adds.  The tagger looks at all text within ``MARGIN`` characters
    of a digit or an at-sign.  Null and empty texts have no spans; ids may repeat or be
    null; other columns are not read.  Nothing is shuffled.
    """
    pointer = docs.sparkSession.sparkContext.broadcast(tagger)

    def find(batches):
        for batch in batches:
            base: list[list[Span]] = [[] for _ in range(batch.num_rows)]
            spans = [[] for _ in range(batch.num_rows)]
            rows, texts = [], []
            for row, text in _texts_with_triggers(batch.column(1)):
                rows.append(row)
                texts.append(text)
            for row, (fixed, every) in zip(rows, all_spans(texts, pointer.value)):
                base[row], spans[row] = fixed, every
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _as_spans(base), _as_spans(spans)], names=["doc_id", "base", "spans"]
            )

    return id_text(docs, id_col, text_col).mapInArrow(find, f"doc_id bigint, base {SPANS}, spans {SPANS}")


def span_text(spans: Column | str) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string")
            ),
        ),
        ",",
    )


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one."""
    merged: list[list[int]] = []
    for kind, a, b in sorted(spans, key=lambda s: (s[1], s[0])):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    out, at = [], 0
    for kind, a, b in merged:
        out += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def redact_personal(docs: DataFrame, tagger: Tagger | None, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced by ``[EMAIL]`` and the like.

    Texts without any, null and empty ones stay as they are, as do all other columns.
    """
    pointer = text_batches(docs).sparkSession.sparkContext.broadcast(tagger)
    names = docs.columns
    at = names.index(text_col)

    def clean(batches):
        for batch in batches:
            rows, texts = [], []
            for row, text in _texts_with_triggers(batch.column(at)):
                rows.append(row)
                texts.append(text)
            column = batch.column(at)
            changed = [(r, redacted(t, s)) for r, t, (_, s) in zip(rows, texts, all_spans(texts, pointer.value)) if s]
            if changed:
                mask = np.zeros(batch.num_rows, bool)
                mask[[r for r, _ in changed]] = True
                column = pc.replace_with_mask(column, pa.array(mask), pa.array([t for _, t in changed], column.type))
            columns = [column if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(clean, docs.schema)
