"""Other spellings of personal data: made from labelled spans for training, and told from plain numbers.

The fixed patterns know one spelling of each kind.  A tagger that learns from their spans alone learns to
repeat them; so each labelled window also comes in another spelling, drawn anew, with its labels.
"""

from __future__ import annotations

import re

import numpy as np

from searchloom.llm.tagger import ALPHABET, LETTER, OTHER, PAD, codes

EMAIL, IP, CARD, PHONE = range(4)
_DIGITS = re.compile(r"[0-9]+")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_DOT = r"(?: ?\. ?| ?[\[(]\.[\])] ?| ?[\[(]?dot[\])]? ?)"
_EMAIL_LIKE = re.compile(rf"[A-Za-z0-9._%+-]+ ?[\[(]?@[\])]? ?[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+")
_CARD_LIKE = re.compile(r"[0-9]+(?:(?: ?[./_-] ?| {1,2})[0-9]+)+")
_PHONE_LIKE = re.compile(r"\(?[0-9]+\)?(?:(?: ?[./-] ?| )\(?[0-9]+\)?)+")
# Digits in groups, as many as a card or a telephone has: whether it is one nobody told.
_AMBIGUOUS = re.compile(r"[0-9](?:[ ()./_-]{1,3}[0-9]+|[0-9]){8,}")


def respell(kind: int, value: str, draw: np.random.Generator) -> str:
    """Another spelling of ``value`` that the fixed patterns do not know."""

    def one(*choices: str) -> str:
        return choices[int(draw.integers(len(choices)))]

    if kind == EMAIL:
        name, _, host = value.rpartition("@")
        at = one(" @ ", "[@]", " (@) ", "@", "@ ")
        dot = one(" dot ", " . ", "[dot]", " (dot) ", "[.]") if at == "@" else one(".", " dot ", "[dot]", " . ")
        return f"{name}{at}{host.replace('.', dot)}"
    if kind == IP:
        return value.replace(".", one(" . ", "[.]", "(.)", " dot ", "[dot]"))
    digits = _NOT_DIGIT.sub("", value)
    if kind == CARD:
        sizes = one("4444", "466", "4445", "55555")
        groups, at = [], 0
        while at < len(digits):
            size = int(sizes[len(groups) % len(sizes)])
            groups.append(digits[at : at + size])
            at += size
        return one(".", "/", "_", " - ", "  ").join(groups)
    groups = _DIGITS.findall(value)
    if len(groups) < 3:
        groups = [digits[:-7], digits[-7:-4], digits[-4:]] if len(digits) > 7 else [digits[:-4], digits[-4:]]
    groups = [g for g in groups if g]
    head = one("", "00", "(")
    if head == "(" and len(groups) > 1:
        return f"({groups[0]}) " + one("-", " ", ".").join(groups[1:])
    return ("00" if head == "00" else "") + one("-", " ", ".", "/").join(groups)


def plausible(kind: int, value: str) -> bool:
    """What a span the tagger adds must be, whatever its chance."""
    if kind == EMAIL:
        return _EMAIL_LIKE.fullmatch(value) is not None
    groups = _DIGITS.findall(value)
    between = {x.strip() for x in _DIGITS.split(value)[1:-1]}
    if kind == IP:
        marks = {".", "[.]", "(.)", "dot", "[dot]", "(dot)"}
        return len(groups) == 4 and len(between) == 1 and between <= marks and all(len(g) <= 3 and int(g) <= 255 for g in groups)
    digits = "".join(groups)
    if kind == CARD:
        return 13 <= len(digits) <= 19 and _CARD_LIKE.fullmatch(value) is not None and _luhn(digits)
    like = _PHONE_LIKE.fullmatch(value) is not None
    return like and 9 <= len(digits) <= 17 and (len(groups) >= 3 or digits.startswith("00"))


def _luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def _characters(x: np.ndarray) -> str:
    """A window as text of as many characters, letters beyond ASCII as one of them."""
    return "".join({LETTER: "é", OTHER: "§", PAD: "\0"}.get(c) or chr(c) for c in x.tolist())


def ambiguous(x: np.ndarray) -> bool:
    """Whether a window without labels holds digits that may well be personal data."""
    return _AMBIGUOUS.search(_characters(x)) is not None


def respelt_window(x: np.ndarray, y: np.ndarray, draw: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """The window with its only span in another spelling; None if it has no single whole one."""
    begins = np.flatnonzero(y % 2 == 1)
    if len(begins) != 1 or (y[: begins[0]] > 0).any():
        return None
    start, kind = int(begins[0]), int(y[begins[0]]) // 2
    end = start + int((y > 0).sum())
    if end >= len(x) or (x == PAD)[: end + 1].any():
        return None
    value = respell(kind, _characters(x[start:end]), draw)
    labels = np.full(len(value), 2 + 2 * kind)
    labels[:1] = 1 + 2 * kind
    # Text in front is cut as far as the longer spelling needs it.
    skip = max(0, start + len(value) + 2 - len(x))
    if skip > start:
        return None
    own = np.concatenate([x[skip:start], codes(value), x[end:]])
    labels = np.concatenate([y[skip:start], labels, y[end:]])
    fill = max(0, len(x) - len(own))
    own = np.append(own, np.full(fill, PAD))[: len(x)]
    return own.clip(0, ALPHABET - 1), np.append(labels, np.zeros(fill, np.int64))[: len(x)]
