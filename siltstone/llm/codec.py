"""Exact byte-pair encoding of whole texts through a word lexicon.

A word here is a run of visible characters with the white space before it. No
token of the byte-level pattern crosses from a visible character into white space,
so the ids of a text are the ids of its words in a row. Words repeat; each is
encoded once and kept. New words of the lexicon get their ids from the automaton,
all others are merged exactly.
"""

from __future__ import annotations

import base64
import re
from itertools import chain

import numpy as np
import tiktoken

from siltstone.llm.lexicon import Lexicon

#: Where the public tokenizer files lie unless the caller names another folder,
#: and the split pattern of the byte-level vocabularies.
TOKENIZERS = "/opt/tokenizers"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The characters with the property White_Space.
SPACE = r"\t-\r \x85\xa0  -     　"

_UNITS = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
_RARE_SPACE = re.compile(r"[\x0b\x0c\x85\xa0  -     　]")
_BLANKS = frozenset(re.findall(f"[{SPACE}]", "".join(map(chr, range(0x3001)))))
_TOUCHING = ("  ", "\n ", " \n", "\r ", " \r", "\t ", " \t")
_CODECS: dict[tuple, WordCodec] = {}


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def codec(tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS, lexicon: str | None = None) -> WordCodec:
    """This process' codec; made at the first call."""
    key = (tokenizer, folder, lexicon)
    if key not in _CODECS:
        _CODECS[key] = WordCodec(f"{folder}/{tokenizer}.tiktoken", lexicon)
    return _CODECS[key]


def single_spaced(text: str) -> bool:
    """Whether every blank stands alone between two visible characters."""
    return not (text[:1] == " " or text[-1:] == " " or any(x in text for x in _TOUCHING) or _RARE_SPACE.search(text))


class _Numbers(dict):
    """Numbers of words; one that isn't held gets the next number and is noted in ``fresh``."""

    def __init__(self, fresh: list[str], lead: str):
        self.fresh, self.lead, self.base = fresh, lead, 0

    def __missing__(self, word: str) -> int:
        number = self[word] = self.base + len(self.fresh)
        self.fresh.append(self.lead + word)
        return number


class WordCodec:
    """``encode`` and ``count`` of many texts; null and empty texts have no tokens.

    Words of up to ``short`` characters are kept between batches until there are
    ``keep`` of them; longer ones rarely come again.
    """

    def __init__(self, ranks_path: str, lexicon: str | Lexicon | None = None, keep: int = 700_000, short: int = 24):
        self.bpe = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=load_ranks(ranks_path), special_tokens={})
        self.token_bytes = np.zeros(self.bpe.n_vocab, np.int64)
        for token, rank in self.bpe._mergeable_ranks.items():
            self.token_bytes[rank] = len(token)
        self.lexicon = Lexicon(lexicon) if isinstance(lexicon, str) else lexicon
        self.keep, self.short = keep, short
        self.reset()

    def reset(self) -> None:
        self.fresh: list[str] = []  # words with a number and without ids yet
        self.plain = _Numbers(self.fresh, "")  # words as they are
        self.spaced = _Numbers(self.fresh, " ")  # words that follow one blank, without it
        self.plain.base = self.spaced.base = 0
        self.used, self.filled = 0, 0
        self.start, self.length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)
        self.pool = np.zeros(1 << 18, np.int32)

    def cut(self, text: str) -> tuple[list[str], list[str]]:
        """Words to look up as they are, then words that follow one blank, without it."""
        if single_spaced(text):
            words = text.split(" ")
            return words[:1], words[1:]
        return _UNITS.findall(text), []

    def _merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that begin with white space, merged in one go; their number of each word.

        The words are merged as one text: no token crosses from one into the next,
        so the tokens' lengths in bytes tell where each word ends.
        """
        ids = np.array(self.bpe.encode_ordinary("".join(words)), np.int64)
        ends = np.cumsum(np.fromiter((len(w) if w.isascii() else len(w.encode()) for w in words), np.int64, len(words)))
        cut = np.searchsorted(np.cumsum(self.token_bytes[ids]), ends, "left") + 1
        return ids, np.diff(cut, prepend=0)

    def _learn(self, words: list[str]) -> None:
        """Appends the ids of these words: from the automaton, else merged."""
        count = len(words)
        lengths = np.zeros(count, np.int64)
        numbers = self.lexicon.find(list(map(str.encode, words))) if self.lexicon is not None else np.full(count, -1)
        parts = []
        known = np.flatnonzero(numbers >= 0)
        if len(known):
            ids, lengths[known] = self.lexicon.outputs(numbers[known])
            parts.append((known, ids))
        unseen = np.flatnonzero(numbers < 0)
        alone = np.fromiter((w[0] not in _BLANKS or w[-1] in _BLANKS for w in words), bool, count)[unseen]
        if alone.any():  # beginnings and ends of texts may not be joined to the next word
            single, unseen = unseen[alone], unseen[~alone]
            each = [self.bpe.encode_ordinary(words[k]) for k in single.tolist()]
            lengths[single] = np.fromiter(map(len, each), np.int64, len(each))
            parts.append((single, np.fromiter(chain.from_iterable(each), np.int64, int(lengths[single].sum()))))
        if len(unseen):
            ids, lengths[unseen] = self._merge([words[k] for k in unseen.tolist()])
            parts.append((unseen, ids))
        filled = self.filled + int(lengths.sum())
        for name, need in (("start", self.used + count), ("length", self.used + count), ("pool", filled)):
            if need > len(held := getattr(self, name)):
                setattr(self, name, np.concatenate([held, np.zeros(max(need - len(held), len(held)), held.dtype)]))
        for which, ids in parts:
            own = lengths[which]
            self.pool[self.filled : self.filled + len(ids)] = ids
            self.start[self.used + which] = self.filled + np.cumsum(own) - own
            self.filled += len(ids)
        self.length[self.used : self.used + count] = lengths
        self.used += count
        self.plain.base = self.spaced.base = self.used

    def _codes(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words in a row, and how many each text has."""
        if self.used > self.keep or self.filled > 8 * self.keep:
            self.reset()
        split = [self.cut(t) if t else ([], []) for t in texts]
        counts = np.fromiter((len(a) + len(b) for a, b in split), np.int64, len(split))
        codes: list[int] = []
        one, two = self.plain.__getitem__, self.spaced.__getitem__
        for a, b in split:
            codes += map(one, a)
            codes += map(two, b)
        if self.fresh:
            self._learn(self.fresh)
            for word in self.fresh:
                if len(word) > self.short:  # seldom seen again
                    self.plain.pop(word, None)
                    self.spaced.pop(word[1:], None)
            self.fresh.clear()
        return np.array(codes, np.int64), counts

    def count(self, texts: list[str | None]) -> np.ndarray:
        """Tokens of each text."""
        codes, counts = self._codes(texts)
        total = np.concatenate([[0], np.cumsum(self.length[codes], dtype=np.int64)])
        ends = np.cumsum(counts)
        return total[ends] - total[ends - counts]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the offsets of the texts in them."""
        codes, counts = self._codes(texts)
        lengths = self.length[codes].astype(np.int64)
        total = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.pool[np.arange(total[-1]) + np.repeat(self.start[codes] - total[:-1], lengths)]
        return ids, np.concatenate([[0], total[np.cumsum(counts)]])
