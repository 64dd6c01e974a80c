"""Token ids of whole texts by the ``tokenizers`` library, with a memo of text pieces.

Whole-text encoding spends most of its time on words it has met before. Texts are
cut only where the tokenizer itself always cuts, at white space, and the ids of a
piece are remembered by the worker. A piece that is new goes to the library: one
that consists of plain letters and marks directly to its BPE model, any other
through the library's full pipeline (normalisation, special strings and all).
Where a text's white space does not allow the cut, the library gets the text whole.

Where words carry the space before them, the new plain pieces of a text go to the
model in one call: no merge of the file joins a plain character with the space of
the next piece or with a character of another kind (looked up in the file, not
taken for granted), so the ids of the row of pieces are those of the pieces in a row.
"""

from __future__ import annotations

import array
import json
import re

import numpy as np

from .common import worker_memo

# Unicode White_Space
SPACE = "\t-\r \x85\xa0  -     　"
LETTERS = "A-Za-zµÀ-ÖØ-öø-ÿ"
# ASCII marks without the apostrophe (contractions) and the angle bracket (special strings)
MARKS = "!-&(-/:;=>?@\\[-`{-~"
# pieces in the young half of the memo; the old half is as large
MEMO_PIECES = 500_000
# the same for words without the space before them; longer pieces are not remembered, so that the memo's size is bounded
WORD_PIECES, KEPT_CHARS = 250_000, 64
# new pieces that go to the model in one call at most
CALL_PIECES = 4096


def _byte_letters() -> dict[int, str]:
    """The printable stand-ins of byte-level BPE for bytes that are not printable."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(256 + k) for k, b in enumerate(others)}


class PieceMemo(dict):
    """Text piece -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.bytes = _byte_letters()
        self.old: dict[str, bytes] = {}

    def limit(self) -> int:
        return MEMO_PIECES

    def library(self, text: str) -> bytes:
        return array.array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def fresh(self, piece: str) -> bytes:
        return self.library(piece)

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.fresh(piece)
        if len(piece) <= KEPT_CHARS:
            if len(self) >= self.limit():
                self.old.clear()  # first: three halves are never held at once
                self.old.update(self)
                self.clear()
            self[piece] = ids
        return ids


# letters whose UTF-8 form begins with one and the same byte, next to the ASCII ones
SPACE_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"


class SpacePieces(PieceMemo):
    """For byte-level BPE whose words carry the space before them."""

    def __init__(self, path: str):
        super().__init__(path)
        self.words: dict[str, bytes] = {}  # marks that stand behind a word
        self.now: dict[str, bytes] = {}  # an exact dict, which a set can be compared with by look-ups
        plain = f"{SPACE_LETTERS}{MARKS}0-9"
        self.plain = re.compile(f"[{plain}](?:[{plain}]|\n(?!\n))*")
        # a row of pieces, each behind its space, of which at least one is not plain
        self.odd = re.compile(f"[^{plain}\n ]| [ \n]|\n\n| \\Z")
        # white space on both sides of a space: the tokenizer joins the run
        self.joined = re.compile(f"[{SPACE}] (?:[{SPACE}]|\\Z)")
        letters = [c for c in map(chr, range(0xC0, 0x100)) if re.match(f"[{SPACE_LETTERS}]", c)]
        self.letters = {c: c.encode("utf-8").decode("latin-1").translate(self.bytes) for c in letters}
        self.letters |= {" ": self.bytes[0x20], "\n": self.bytes[0x0A]}
        self.alone = frozenset(c for c in map(chr, range(0x21, 0x7F)) if re.match(f"[{MARKS}]", c))
        self.opens = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.opens[[k for t, k in self.tokenizer.get_vocab().items() if t.startswith(self.bytes[0x20])]] = True
        self.in_rows = self._kinds_stay_apart(path)

    def _kinds_stay_apart(self, path: str) -> bool:
        """True when no merge of the file makes a token that runs over a border between plain pieces or kinds."""
        with open(path) as file:
            merges = json.load(file)["model"]["merges"]
        back = {c: chr(b) for b, c in self.bytes.items()}
        kinds = re.compile("[\x80-\xbf]?(?: ?(?:[A-Za-z]|\xc3[\x80-\xbf])*\xc3?| ?[0-9]*| *| ?\n*| ?[!-/:-@\\[-`{-~]*)")
        possible = re.compile("[\x80-\xbf]?(?:[\n -~]|\xc3[\x80-\xbf])*\xc3?")
        for merge in merges:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            made = "".join(back.get(c, c) for c in left + right)
            if possible.fullmatch(made) and "'" not in made and not kinds.fullmatch(made):
                return False
        return True

    def fresh(self, piece: str) -> bytes:
        return self.library(" " + piece)

    def learn(self, pieces: list[str]) -> None:
        """Remember the ids of new pieces."""
        for at in range(0, len(pieces), CALL_PIECES):
            some = pieces[at:at + CALL_PIECES]
            row = " " + " ".join(some)
            if not self.in_rows or self.odd.search(row):
                odd = [p for p in some if not self.in_rows or not self.plain.fullmatch(p)]
                self.now.update((p, self.fresh(p)) for p in odd)
                some = [p for p in some if p not in self.now]
                row = " " + " ".join(some)
            if not some:
                continue
            for c in set(row).intersection(self.letters):  # for few letters far quicker than translate()
                row = row.replace(c, self.letters[c])
            ids = np.array([t.id for t in self.model.tokenize(row)], "<u4")
            starts = (4 * np.flatnonzero(self.opens[ids])).tolist()
            if len(starts) != len(some):
                raise ValueError("the tokenizer file joins pieces across spaces")
            raw = ids.tobytes()
            self.now.update(zip(some, [raw[a:b] for a, b in zip(starts, [*starts[1:], len(raw)])]))

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.joined.search(text):
            return self.library(text)
        pieces = text.split(" ")
        first = self.library(pieces[0]) if pieces[0] else b""
        del pieces[0]
        if len(self.now) >= MEMO_PIECES:
            self.old, self.now = self.now, {}
        found = list(map(self.now.get, pieces))
        if None in found:
            missing = [k for k, ids in enumerate(found) if ids is None]
            self.learn_all({pieces[k] for k in missing})
            now = self.now
            for k in missing:  # the others are not looked up again
                found[k] = now[pieces[k]]
        return first + b"".join(found)

    def learn_all(self, pieces: set[str]) -> None:
        now, old, alone, new = self.now, self.old, self.alone, []
        for p in pieces:
            ids = old.get(p)
            if ids is None and self.in_rows and p[-1:] in alone and p[-2:-1].isalnum():
                # one mark behind a plain word is a word of its own
                stem = now.get(p[:-1]) or old.get(p[:-1])
                if stem is not None and self.plain.fullmatch(p):
                    ids = stem + self.mark(p[-1])
            if ids is None:
                new.append(p)
            else:
                now[p] = ids
        if new:
            self.learn(new)

    def mark(self, mark: str) -> bytes:
        ids = self.words.get(mark)
        if ids is None:
            ids = self.words[mark] = self.library(mark)
        return ids


class WordPieces(PieceMemo):
    """For BPE with word ends that drops white space and lower-cases."""

    def __init__(self, path: str):
        super().__init__(path)
        # str.split() also cuts at these four, which are not white space to the tokenizer
        self.odd = re.compile("[\x1c-\x1f]")
        self.simple = re.compile(f"(?:[{LETTERS}]+|[{MARKS}]+)*")
        self.parts = re.compile(f"[{LETTERS}]+|[{MARKS}]+")

    def limit(self) -> int:
        return WORD_PIECES

    def by_model(self, word: str) -> bytes:
        # the stand-in of a printable ASCII byte is the character itself
        mapped = word if word.isascii() else word.encode("utf-8").decode("latin-1").translate(self.bytes)
        return array.array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def fresh(self, piece: str) -> bytes:
        if not self.simple.fullmatch(piece):
            return self.library(piece)
        parts = self.parts.findall(piece.lower())
        # a part alone is a piece like any other, held once
        return self.by_model(piece) if parts == [piece] else b"".join(map(self.__getitem__, parts))

    def encode(self, text: str) -> bytes:
        if self.odd.search(text):
            return self.library(text)
        if text.isascii() and "<" not in text:
            text = text.lower()  # fewer different pieces; special strings are matched before lower-casing
        return b"".join(map(self.__getitem__, text.split()))


class WholeTexts(PieceMemo):
    """Any other tokenizer file: the library encodes every text as it is."""

    def encode(self, text: str) -> bytes:
        return self.library(text) if text else b""


def encoder(path: str):
    """The worker's encoder for a tokenizer file; the file's own settings choose the cut."""
    memo = worker_memo("tokens")
    if ("ids", path) not in memo:
        with open(path) as file:
            settings = json.load(file)
        plain = settings["model"]["type"] == "BPE" and not any(
            t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized")
            or " " in t["content"] or "<" not in t["content"]
            for t in settings.get("added_tokens", [])
        )
        before, norm = settings.get("pre_tokenizer") or {}, settings.get("normalizer")
        kind = WholeTexts
        if plain and norm is None and before.get("type") == "ByteLevel" and not before.get("add_prefix_space"):
            kind = SpacePieces
        elif plain and settings["model"].get("end_of_word_suffix") and [
            n.get("type") for n in (norm or {}).get("normalizers", [])
        ] == ["NFC", "Replace", "Lowercase"]:
            kind = WordPieces
        memo["ids", path] = kind(path)
    return memo["ids", path]
