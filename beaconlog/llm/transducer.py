"""Token counting by a finite-state transducer that is compiled from a BPE piece list.

The transducer reads characters and says how many tokens each adds. It rests on
two properties of BPE: a prefix of a tokenization is the tokenization of that
prefix, and a sequence of pieces is a tokenization exactly if every two
neighbours are one. So the last piece of a prefix is the one suffix piece that
agrees with the last piece before it, and all the past that can still matter is
what lies inside the longest suffix that may begin a longer piece. A state is
that suffix, with the last piece and the relative token count at each of its
positions. The future depends on nothing else: equal states are one state.

Reachable states are built on demand and kept, as lazy automata do, with their
transitions' counts. A count can be negative: ``th`` may be two tokens where
``the`` is one.

A space or an unknown character ends what can merge. After it every state is the
same state, so a chunk of text acts on the incoming state only up to its first
such place: its map is (the characters before it, the tokens from there on, the
state at its end). Two maps compose into one, and composition is associative.
Maps are texts, not tables of states: composing joins the tail and the head and
reads that word from the start, so a text without spaces is read in one go, and
all chunks of a text are read and folded by one task.
"""

from __future__ import annotations

import re

SPACE = "▁"  # how the piece list writes a space
# words in the young half of the memo; the old half is as large
MEMO_WORDS = 500_000
MAX_STATES = 400_000


class Transducer:
    """``pieces``: text -> score, higher merges first; unknown characters cost their UTF-8 bytes."""

    def __init__(self, pieces: dict[str, float], max_states: int = MAX_STATES):
        self.pieces, self.max_states = pieces, max_states
        self.letters = {c for p in pieces for c in p}
        self.begins = {p[:k] for p in pieces for k in range(1, len(p))}
        self.pairs: dict[tuple[str, str], bool] = {}
        letters = "".join(map(re.escape, sorted(self.letters)))
        # a word is what follows a run of spaces; an unknown character stands alone, mostly the line feed
        self.alone = "" if "\n" in self.letters else "\n"
        self.words_of = re.compile(f"{SPACE}+[^{SPACE}{self.alone}]*|\n|[^{SPACE}{self.alone}]+").findall
        self.known = re.compile(f"[{letters}]+|[^{letters}]", re.DOTALL).findall
        self.memo: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.reset()

    def reset(self) -> None:
        # the state at the start: no suffix, nothing before it
        start = ("", (None,), (0,))
        self.states = {start: 0}
        self.contents = [start]
        self.moves: list[dict[str, tuple[int, int]]] = [{}]

    # ── compilation ─────────────────────────────────────────────────────────

    def merge(self, text: str) -> list[str]:
        """BPE by its definition, for the few characters of two pieces."""
        parts = list(text)
        while True:
            scores = [(-self.pieces[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.pieces]
            if not scores:
                return parts
            k = min(scores)[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]

    def agree(self, left: str | None, right: str) -> bool:
        key = (left or "", right)
        if key not in self.pairs:
            self.pairs[key] = self.merge(key[0] + right) == ([right] if left is None else [left, right])
        return self.pairs[key]

    def build(self, state: int, letter: str) -> tuple[int, int]:
        """The transition of ``state`` on ``letter``: next state and tokens added."""
        suffix, lasts, counts = self.contents[state]
        text = suffix + letter
        # lasts[k], counts[k]: at position k of the suffix; the longest piece that agrees is the last one
        for k in range(len(text)):
            piece = text[k:]
            if (piece in self.pieces or len(piece) == 1) and self.agree(lasts[k], piece):
                break
        else:
            raise AssertionError(f"no tokenization of a prefix ends in {text!r}")
        total = counts[k] + 1
        lasts, counts = (*lasts, piece), (*counts, total)
        drop = 0
        while drop < len(text) and text[drop:] not in self.begins:
            drop += 1
        content = (text[drop:], lasts[drop:], tuple(c - total for c in counts[drop:]))
        to = self.states.get(content)
        if to is None:
            to = self.states[content] = len(self.contents)
            self.contents.append(content)
            self.moves.append({})
        move = self.moves[state][letter] = (to, total - self.contents[state][2][-1])
        return move

    # ── running ─────────────────────────────────────────────────────────────

    def run(self, state: int, text: str) -> tuple[int, int]:
        """From ``state`` over known characters: the state reached and the tokens added."""
        tokens = 0
        for letter in text:
            state, added = self.moves[state].get(letter) or self.build(state, letter)
            tokens += added
        return state, tokens

    def word(self, word: str) -> int:
        """Tokens of a word read from the start; the same wherever the word stands."""
        found = self.memo.get(word)
        if found is None:
            found = self.old.get(word)
            if found is None:
                if len(self.contents) >= self.max_states:
                    self.reset()
                found = 0
                for part in self.known(word):
                    found += self.run(0, part)[1] if part[0] in self.letters else len(part.encode("utf-8"))
            if len(self.memo) >= MEMO_WORDS:
                self.old, self.memo = self.memo, {}
            self.memo[word] = found
        return found

    # ── chunks ──────────────────────────────────────────────────────────────

    def chunk(self, text: str) -> tuple[str, int, str | None]:
        """The map of a chunk: ``(head, tokens, tail)``.

        ``head`` continues what came before, ``tail`` is the unfinished last word,
        ``tokens`` belong to the words between. Without a place to cut all of the chunk
        is head and ``tail`` is None. The state after ``tail`` is that of reading
        it from the start.
        """
        words = self.words_of(text)
        head = words.pop(0) if words and words[0][0] != SPACE and words[0] != self.alone else ""
        if not words:
            return head, 0, None
        tail = words.pop()
        return head, sum(map(self.word, words)), tail

    def compose(self, left: tuple, right: tuple) -> tuple:
        """The map of two neighbouring chunks."""
        (a, n, x), (b, m, y) = left, right
        if x is None:
            return (a + b, m, y)
        if y is None:
            return (a, n, x + b)
        return (a, n + self.word(x + b) + m, y)

    def count(self, text: str, chunk_chars: int) -> int:
        """Tokens of a whole text, chunk maps combined pairwise, level by level."""
        if not text:
            return 0
        text = SPACE + text.replace(" ", SPACE)
        cuts = [0]
        while cuts[-1] < len(text):
            at = min(cuts[-1] + chunk_chars, len(text))
            # a run of spaces is not cut
            while at < len(text) and text[at - 1] == SPACE == text[at]:
                at += 1
            cuts.append(at)
        maps = [self.chunk(text[a:b]) for a, b in zip(cuts, cuts[1:])]
        while len(maps) > 1:
            paired = [self.compose(a, b) for a, b in zip(maps[::2], maps[1::2])]
            maps = paired + maps[len(maps) // 2 * 2:]
        head, tokens, tail = maps[0]
        return (self.word(head) if head else 0) + tokens + (self.word(tail) if tail else 0)
