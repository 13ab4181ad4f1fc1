"""Token ids of whole texts, each distinct pre-token being merged once.

For the word tokenizer (lower case, white space dropped, letters in runs, digits
alone, other characters in runs) pre-tokens are found with NumPy over all texts of
a block; only pre-tokens not met before go to the tokenizer library.  Texts with
characters outside ``SIMPLE``, with strings that may be special tokens, and every
text of another tokenizer, go to the library whole, so results are always its own.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np

from searchloom.llm.blocks import Block, span_hashes

SPACE, LETTER, DIGIT, SYMBOL, ODD = range(5)

#: Code points whose class and lower case are tabled; tests compare them with the library.
SIMPLE = (
    (0x09, 0x0D),
    (0x20, 0x24F),
    (0x370, 0x3FF),
    (0x400, 0x481),
    (0x2010, 0x2027),
    (0x2030, 0x205E),
    (0x20A0, 0x20BF),
    (0x3041, 0x3096),
    (0x30A1, 0x30FA),
    (0x4E00, 0x9FA5),
    (0xAC00, 0xD7A3),
)

#: The rules of the word tokenizer, as its file states them.
WORD_RULES = {
    "normalizer": ["NFC", "Replace", "Lowercase"],
    "pattern": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
}

MOST_KNOWN = 300_000  # some 30 MB, kept as long as a worker lives


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kind = np.full(0x10000, ODD, np.uint8)
    lower = np.arange(0x10000, dtype=np.uint32)
    for first, last in SIMPLE:
        for point in range(first, last + 1):
            char = chr(point)
            category = unicodedata.category(char)
            small = char.lower()
            if len(small) != 1 or unicodedata.normalize("NFC", char) != char or category in ("Cn", "Mn"):
                continue
            lower[point] = ord(small)
            if char.isspace() and not 0x1C <= point <= 0x1F:
                kind[point] = SPACE
            elif category[0] == "L":
                kind[point] = LETTER
            elif category[0] == "N":
                kind[point] = DIGIT
            elif category[0] != "M":
                kind[point] = SYMBOL
    kind[0x7F:0xA0] = ODD
    values = np.random.default_rng(7).integers(1, 2**63, 0x10000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return kind, lower, values


def byte_letters() -> dict[int, int]:
    """The letter that byte-level vocabularies write for each byte; a line feed stays."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    table = {b: b for b in plain} | {b: 256 + i for i, b in enumerate(others)}
    table[0x0A] = 0x0A
    return table


class Tokenizer:
    """Counts and ids of whole texts; remembers the pieces of pre-tokens it has met."""

    def __init__(self, path: str, most_known: int = MOST_KNOWN):
        from tokenizers import Tokenizer as Library

        self.library = Library.from_file(path)
        model = self.library.model
        self.merge = model.tokenize
        self.letters = byte_letters()
        self.most_known = most_known
        self.kind, self.lower, self.values = _tables()
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self.words_only = self._is_word_tokenizer(rules)
        self._forget()

    @staticmethod
    def _is_word_tokenizer(rules: dict) -> bool:
        try:
            steps = [x["type"] for x in rules["normalizer"]["normalizers"]]
            split, tail = rules["pre_tokenizer"]["pretokenizers"]
            return (
                steps == WORD_RULES["normalizer"]
                and split["pattern"] == {"Regex": WORD_RULES["pattern"]}
                and tail["type"] == "ByteLevel"
                and not tail["add_prefix_space"]
                and not tail["use_regex"]
                and all(x["content"].startswith("<|") for x in rules["added_tokens"])
            )
        except (KeyError, TypeError, ValueError):
            return False

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.slots = np.zeros(0, np.int64)
        self.begin = np.zeros(1, np.int64)  # slot -> first id; one more at the end
        self.ids = np.zeros(0, np.int32)

    # -- pre-tokens -------------------------------------------------------------

    def _split(self, block: Block) -> tuple:
        """Lower-cased code points, pre-token spans with their rows, and the odd rows."""
        raw = block.data.tobytes()
        try:
            points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        except UnicodeDecodeError:
            return None
        ahead = np.zeros(len(raw) + 1, np.int64)
        np.cumsum((block.data & 0xC0) != 0x80, out=ahead[1:])
        offsets = ahead[block.offsets]
        n = len(points)
        basic = np.minimum(points, 0xFFFF)
        kind = self.kind[basic]
        small = self.lower[basic]
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True

        same = np.zeros(n, bool)  # joined with the character before
        same[1:] = (kind[1:] == kind[:-1]) & (kind[1:] != DIGIT) & ~cut[1:n]
        self._contractions(small, kind, same, cut)
        solid = kind != SPACE
        begins = solid & ~same
        ends = np.ones(n, bool)
        ends[:-1] = begins[1:] | ~solid[1:] | cut[1:n]
        ends &= solid
        starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        first = np.searchsorted(starts, offsets)

        strange = kind == ODD
        strange[:-1] |= (small[:-1] == ord("<")) & (small[1:] == ord("|"))
        at = np.flatnonzero(strange)
        odd = np.unique(np.searchsorted(offsets, at, "right") - 1) if len(at) else at
        return small, starts, stops, first, odd

    @staticmethod
    def _contractions(small, kind, same, cut) -> None:
        """A lone apostrophe takes s, t, m, d, re, ve or ll along; what follows stands alone."""
        n = len(small)
        at = np.flatnonzero(small == ord("'"))
        at = at[at + 1 < n]
        at = at[~same[at] & (kind[at + 1] == LETTER) & ~cut[at + 1]]
        if not len(at):
            return
        one = small[at + 1]
        after = np.minimum(at + 2, n - 1)
        two = np.where((at + 2 < n) & ~cut[np.minimum(at + 2, n)], small[after], 0)
        is_one = np.isin(one, [ord(c) for c in "stmd"])
        is_two = np.zeros(len(at), bool)
        for a, b in ("re", "ve", "ll"):
            is_two |= (one == ord(a)) & (two == ord(b))
        taken = np.where(is_one, 1, np.where(is_two, 2, 0))
        at, taken = at[taken > 0], taken[taken > 0]
        same[at + 1] = True
        rest = at + 1 + taken
        rest = rest[rest < n]
        same[rest] = False

    # -- pieces -----------------------------------------------------------------

    def _slots_of(self, small: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """The slot of each pre-token; new ones are merged by the library once."""
        hashes = span_hashes(self.values[small], starts, stops)
        distinct, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, distinct), max(len(self.hashes) - 1, 0))
        met = self.hashes[at] == distinct if len(self.hashes) else np.zeros(len(distinct), bool)
        if not met.all():
            new = ~met
            self._learn(small, starts[where[new]], stops[where[new]], distinct[new])
            at = np.searchsorted(self.hashes, distinct)
        return self.slots[at][back]

    def _learn(self, small, starts, stops, hashes) -> None:
        text = small.astype("<u4").tobytes().decode("utf-32-le")
        words = "\n".join([text[a:b] for a, b in zip(starts.tolist(), stops.tolist())])
        spelled = words.encode("utf-8").decode("latin-1").translate(self.letters)
        found = [[p.id for p in self.merge(word)] for word in spelled.split("\n")]
        counts = np.array([len(ids) for ids in found], np.int64)
        slots = len(self.begin) - 1 + np.arange(len(hashes))
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(counts)])
        self.ids = np.concatenate([self.ids, np.array([i for ids in found for i in ids], np.int32)])
        place = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, place, hashes)
        self.slots = np.insert(self.slots, place, slots)

    def _whole(self, text: bytes) -> list[int]:
        return self.library.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids

    def _parts(self, block: Block):
        if len(self.hashes) > self.most_known:
            self._forget()
        parts = self._split(block) if self.words_only else None
        if parts is None:
            none = np.zeros(0, np.int64)
            return none, np.zeros(block.rows + 1, np.int64), range(block.rows)
        small, starts, stops, first, odd = parts
        if len(odd):  # their pre-tokens are not looked up
            keep = ~np.isin(np.repeat(np.arange(block.rows), np.diff(first)), odd)
            starts, stops = starts[keep], stops[keep]
            counts = np.diff(first)
            counts[odd] = 0
            first = np.concatenate([[0], np.cumsum(counts)])
        slots = self._slots_of(small, starts, stops) if len(starts) else starts
        return slots, first, odd

    def count(self, block: Block) -> np.ndarray:
        """Tokens of each row; ids are not put together."""
        slots, first, odd = self._parts(block)
        pieces = np.concatenate([[0], np.cumsum(np.diff(self.begin)[slots])])
        counts = np.diff(pieces[first])
        for row in odd:
            counts[row] = len(self._whole(block.text(row)))
        return counts

    def encode(self, block: Block) -> list[np.ndarray]:
        """Token ids of each row."""
        slots, first, odd = self._parts(block)
        sizes = np.diff(self.begin)[slots]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        index = np.arange(total) + np.repeat(self.begin[slots] - (ends - sizes), sizes)
        ids = self.ids[index]
        bounds = np.concatenate([[0], ends])[first]
        rows = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        for row in odd:
            rows[row] = np.array(self._whole(block.text(row)), np.int32)
        return rows


_loaded: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """One per worker process and file; its memory of pre-tokens outlives a task."""
    if path not in _loaded:
        _loaded[path] = Tokenizer(path)
    return _loaded[path]
