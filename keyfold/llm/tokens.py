"""Token ids of a word-level BPE vocabulary, one white-space word at a time.

The vocabulary drops white space and never merges across it, so the ids of a text are those of its words in
a row. Words repeat, so their ids are kept: a dictionary lookup a word instead of a merge loop.
"""

from __future__ import annotations

import os
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, count, islice

import numpy as np

from keyfold.llm.common import slices

PART_BYTES = 1 << 20
KEPT_WORDS, KEPT_IDS = 1 << 19, 1 << 22
IDLE_WORDS = 1 << 17  # kept from task to task
# New words are encoded so many at once, with a sign between them that hardly any text has.
GROUP, SIGN = 256, "\x01"


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer:
    """Equal to ``encode(text, add_special_tokens=False)`` of the vocabulary, which takes the literals of its added
    tokens for these tokens wherever they stand."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # texts are cut at the literals first; words are put in lower case, which must not make one
        self.tokenizer.encode_special_tokens = True
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = {token.content.encode(): b" \xff%d " % number for number, token in added.items()}
        self.literals = re.compile(b"|".join(re.escape(x) for x in sorted(self.added, key=len, reverse=True)) or b"(?!)")
        # its id, if it has one to itself
        ids, other = (self.tokenizer.encode(x, add_special_tokens=False).ids for x in (SIGN, "\x02"))
        self.sign = ids[0] if len(ids) == 1 and ids != other else None
        # a word not met before gets the next number, inside the dictionary's own lookup
        self.slots: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.known = 0
        self.starts, self.lengths = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.pool, self.used = np.zeros(4096, np.uint32), 0

    def _keep(self, some: int) -> None:
        """Forgets all words but those met first, which are the most frequent."""
        self.slots = defaultdict(count(some).__next__, islice(self.slots.items(), some))
        self.known, self.used = some, int(self.starts[some]) if some < self.known else self.used

    def rest(self) -> None:
        """Makes room at the end of a task: the worker lives on and may do other work."""
        if len(self.slots) > IDLE_WORDS:
            self._keep(IDLE_WORDS)
            self.starts, self.lengths = self.starts[:IDLE_WORDS].copy(), self.lengths[:IDLE_WORDS].copy()
            self.pool = self.pool[: self.used].copy()

    def _numbers(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all words of some texts, and where each text's words end."""
        if len(self.slots) > KEPT_WORDS or self.used > KEPT_IDS:
            self._keep(min(KEPT_WORDS // 2, int(np.searchsorted(self.starts[: self.known], KEPT_IDS // 2))))
        words = separated([self._marked(t) for t in texts])
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        slots = np.fromiter(map(self.slots.__getitem__, chain.from_iterable(words)), np.int64, int(sizes.sum()))
        self._learn()
        return slots, np.cumsum(sizes)

    def _marked(self, text: bytes) -> bytes:
        """The text with a word of its own, which is no UTF-8, for the literal of each added token."""
        if not any(x in text for x in self.added):
            return text
        return self.literals.sub(lambda found: self.added[found[0]], text)

    def _learn(self) -> None:
        """Encodes the words that have a number but no ids yet."""
        first, last = self.known, len(self.slots)
        if first == last:
            return
        new = list(islice(reversed(self.slots), last - first))[::-1]
        ids, lengths = zip(*(x for at in range(0, len(new), GROUP * GROUP) for x in self._encoded(new[at : at + GROUP * GROUP])))
        ids, lengths = np.concatenate(ids), np.concatenate(lengths)
        end = self.used + len(ids)
        self.starts, self.lengths = _room(self.starts, last), _room(self.lengths, last)
        self.pool = _room(self.pool, end)
        self.starts[first:last] = self.used + np.cumsum(lengths) - lengths
        self.lengths[first:last] = lengths
        self.pool[self.used : end] = ids
        self.known, self.used = last, end

    def _encoded(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of each :data:`GROUP` of words in a row, and how many each word has."""
        groups = [words[at : at + GROUP] for at in range(0, len(words), GROUP)]
        # the literals of added tokens are no UTF-8
        texts = [f" {SIGN} ".encode().join(g).decode(errors="replace") for g in groups]
        for group, found in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, np.uint32)
            signs = np.flatnonzero(ids == (-1 if self.sign is None else self.sign))
            if len(signs) == len(group) - 1 and not any(w.startswith(b"\xff") for w in group):
                yield np.delete(ids, signs), np.diff(signs, prepend=-1, append=len(ids)) - 1
            else:
                each = [[int(w[1:])] if w.startswith(b"\xff") else self._one(w) for w in group]
                yield np.array(list(chain.from_iterable(each)), np.uint32), np.array([len(x) for x in each])

    def _one(self, word: bytes) -> list[int]:
        return self.tokenizer.encode(word.decode(), add_special_tokens=False).ids

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """Ids of each text in UTF-8."""
        for start, end in slices(np.array([len(t) for t in texts]), PART_BYTES):
            if end - start > 1:
                yield from self._ids(texts[start:end])
            else:
                yield np.concatenate([x for part in split_parts(texts[start]) for x in self._ids([part])])

    def _ids(self, texts: list[bytes]) -> list[np.ndarray]:
        slots, tops = self._numbers(texts)
        lengths = self.lengths[slots]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        places = np.arange(total) + np.repeat(self.starts[slots] - (ends - lengths), lengths)
        cuts = np.concatenate(([0], ends))[tops[:-1]]
        return np.split(self.pool[places], cuts)

    def counts(self, texts: list[bytes]) -> np.ndarray:
        """Number of ids of each text."""
        slots, tops = self._numbers(texts)
        return np.diff(np.concatenate(([0], np.cumsum(self.lengths[slots])))[np.concatenate(([0], tops))])


def separated(texts: list[bytes]) -> list[list[bytes]]:
    """The white-space words of each text with ASCII letters in lower case and ASCII signs cut off behind
    an ASCII letter or digit. The vocabulary lower-cases and cuts there too, so the ids stay the same while far
    fewer words differ."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    buffer = np.frombuffer(b"".join(texts).lower(), np.uint8)
    if not len(buffer):
        return [[] for _ in texts]
    cuts = np.flatnonzero(_LETTER[buffer[:-1]] & _SIGN[buffer[1:]]) + 1
    ends = np.cumsum(sizes)
    # a cut at a text's end goes to the text before or after; it is white space either way
    moved = (ends + np.searchsorted(cuts, ends, side="right")).tolist()
    spaced = np.insert(buffer, cuts, 32).tobytes()
    return [spaced[a:b].split() for a, b in zip([0, *moved], moved)]


_LETTER = np.array([48 <= b <= 57 or 97 <= b <= 122 for b in range(256)])
_SIGN = np.array([33 <= b < 127 and not chr(b).isalnum() for b in range(256)])


def _room(a: np.ndarray, size: int) -> np.ndarray:
    """``a`` with room for ``size`` entries, doubled when it has to grow."""
    if size <= len(a):
        return a
    out = np.zeros(max(size, 2 * len(a)), a.dtype)
    out[: len(a)] = a
    return out


def split_parts(text: bytes, size: int = PART_BYTES) -> list[bytes]:
    """A long text cut behind white space into parts of about ``size`` bytes."""
    parts = []
    while len(text) > size:
        at = max(text.rfind(c, 0, size) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
        if at < 0:
            ends = [x for x in (text.find(c, size) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if x >= 0]
            if not ends:
                break
            at = min(ends)
        parts.append(text[: at + 1])
        text = text[at + 1 :]
    return [*parts, text]


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer for each Python worker."""
    return WordTokenizer(path)
