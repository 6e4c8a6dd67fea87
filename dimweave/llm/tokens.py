"""Exact tokenisation with a memory of words.

Byte-level BPE never merges across the words its pattern cuts a text into, and none of these words
holds white space after anything else. So a text may be cut before each space that follows a
character other than white space; the ids of the parts, one after the other, are those of the text.
Each part is encoded once by the ``tokenizers`` library and then remembered. Where the memory is full, parts
seen once go first, then the rarer ones.

A string of an added token (such as ``<|endoftext|>``) inside a text becomes that token's id, as the library does
by default, or is plain text with ``added_tokens=False``.
"""

from __future__ import annotations

import codecs
import json
import re
from collections import defaultdict
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: What may not stand before a cut (white space by any Unicode version).
_SPACES = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u180e\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_UNCUTTABLE = [f"{c} " for c in _SPACES]
_CUT = re.compile(f"(?<![{_SPACES}]) ")

_STOPS, _CLOSING = (".", "!", "?", "。"), "\"')]"

#: Letters whose class no Unicode version disputes, and the words that byte-level BPE cuts such text into.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ž"
_EASY = re.compile(f" ?[{_LETTERS}0-9!-/:-@\\[-`{{-~\n\t]+")
_ALL_EASY = re.compile(f"{_EASY.pattern}+(?:\0{_EASY.pattern}+)*+")
#: Texts may follow each other behind a NUL, which is none of their own.
_WORDS = re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[0-9]+| ?[^\\s{_LETTERS}0-9\0]+|\\s+(?![^\\s\0])|\\s+")

MAX_PARTS = 400_000  # remembered parts of a Python worker

_encoders: dict[tuple, "PartEncoder"] = {}


def encoder(path: str, added_tokens: bool = True, sentences: bool = True) -> "PartEncoder":
    """One encoder for each Python worker, tokenizer file, treatment of added tokens and question whether sentences are marked."""
    key = path, added_tokens, sentences
    if key not in _encoders:
        _encoders[key] = PartEncoder(path, added_tokens=added_tokens, sentences=sentences)
    return _encoders[key]


def byte_letters() -> list[str]:
    """The letter that byte-level BPE writes for each byte: printable ones for themselves, the others from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = count(256)
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def ends_sentence(part: str | bytes) -> bool:
    """Whether a part ends a sentence or a line: a full stop, perhaps within quotes, or a line break."""
    part = part.decode() if isinstance(part, bytes) else part
    return "\n" in part or part[-1:] in _STOPS or part[-1:] in _CLOSING and part.rstrip(_CLOSING)[-1:] in _STOPS


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices starts[i], ..., starts[i] + lengths[i] - 1 of all i in a row."""
    before = np.cumsum(lengths) - lengths
    return np.arange(lengths.sum(), dtype=np.int64) + np.repeat(starts - before, lengths)


def cut(text: str) -> list[str]:
    """The parts of a text; all but the first had a space before them, which is left out."""
    return _CUT.split(text) if any(pair in text for pair in _UNCUTTABLE) else text.split(" ")


class Lists:
    """A growing row of lists of numbers, kept as one array."""

    def __init__(self, kind):
        self.data, self.used = np.zeros(1 << 16, kind), 0
        self.starts, self.lengths, self.n = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), 0

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        self.data = _room(self.data, self.used + len(flat))
        self.starts, self.lengths = _room(self.starts, self.n + len(lengths)), _room(self.lengths, self.n + len(lengths))
        self.data[self.used: self.used + len(flat)] = flat
        self.starts[self.n: self.n + len(lengths)] = self.used + np.cumsum(lengths) - lengths
        self.lengths[self.n: self.n + len(lengths)] = lengths
        self.used += len(flat)
        self.n += len(lengths)

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists at these places in a row, and their lengths."""
        lengths = self.lengths[at]
        return self.data[ragged(self.starts[at], lengths)], lengths

    def kept(self, at: np.ndarray) -> Lists:
        rest = Lists(self.data.dtype)
        rest.add(*self.take(at))
        return rest


def _room(array: np.ndarray, n: int) -> np.ndarray:
    while n > len(array):
        array = np.concatenate((array, np.zeros_like(array)))
    return array


class PartMemory:
    """Numbers the parts of texts and forgets the rare ones; what a part means is up to the subclass."""

    def __init__(self, max_parts: int):
        self.max_parts = max_parts
        self.numbers: dict = defaultdict(count().__next__)
        self.uses = np.zeros(1 << 16, np.int64)
        self.known = 0

    def learn(self, new: list) -> None:
        """Store what belongs to parts with the next numbers."""
        raise NotImplementedError

    def keep(self, at: np.ndarray) -> None:
        """Only parts with these numbers stay; they are numbered anew in this order."""
        raise NotImplementedError

    def number(self, parts: list, times: np.ndarray | int = 1) -> np.ndarray:
        """The number of each part, which was used so many times; valid until the next call of ``tidy``."""
        found = np.fromiter(map(self.numbers.__getitem__, parts), np.int64, len(parts))
        new = list(islice(reversed(self.numbers), len(self.numbers) - self.known))[::-1]
        if new:
            self.learn(new)
            self.known += len(new)
            self.uses = _room(self.uses, self.known)
        np.add.at(self.uses, found, times)
        return found

    def tidy(self) -> None:
        """Make room if the memory is full."""
        if self.known <= self.max_parts:
            return
        uses = self.uses[: self.known]
        at = np.flatnonzero(uses > 1)
        if len(at) > self.max_parts // 2:
            at = np.sort(at[np.argpartition(-uses[at], self.max_parts // 2)[: self.max_parts // 2]])
        keys = list(self.numbers)
        kept = [keys[i] for i in at.tolist()]
        self.keep(at)
        self.numbers = defaultdict(count(len(kept)).__next__, zip(kept, range(len(kept)), strict=True))
        self.known = len(kept)
        self.uses = _room(uses[at] // 2, 1 << 16)


class WordIds:
    """Ids of parts by the ``tokenizers`` library: its whole work, or its model alone where a part's words are plain."""

    def __init__(self, path: str, added_tokens: bool):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added_tokens
        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        cutter = described["pre_tokenizer"] or {}
        usual = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter["add_prefix_space"] and not described["normalizer"]
        self.model = None
        if usual:
            self.model = Tokenizer.from_file(path)
            self.model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
            self.model.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.sizes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)  # in bytes, one letter of an entry each
        self.sizes[list(vocabulary.values())] = list(map(len, vocabulary))
        letters = byte_letters()
        letters[0] = " "
        self.letters = "".join(letters)
        self.added = {t["content"]: t["id"] for t in described["added_tokens"]} if added_tokens else {}
        if any(t[flag] for t in described["added_tokens"] for flag in ("lstrip", "rstrip", "single_word") if added_tokens):
            raise ValueError("added tokens that take the space or the words around them are not handled")
        self.split = re.compile("|".join(f"({re.escape(t)})" for t in sorted(self.added, key=len, reverse=True))) if self.added else None

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and their number for each text."""
        match, added = _EASY.fullmatch, self.added
        if self.model and _ALL_EASY.fullmatch("\0".join(texts)) and added.keys().isdisjoint(texts):
            ids, ends = self._of_words(texts)
            return ids, np.diff(ends)
        easy = np.fromiter((match(t) is not None and t not in added for t in texts), bool, len(texts)) if self.model else np.zeros(len(texts), bool)
        plain, hard = ([t for t, e in zip(texts, easy.tolist(), strict=True) if e == kind] for kind in (True, False))
        ids, ends = self._of_words(plain)
        rest = [e.ids for e in self.tokenizer.encode_batch_fast(hard, add_special_tokens=False)]
        starts, lengths = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        lengths[easy] = np.diff(ends)
        starts[easy] = ends[:-1]
        lengths[~easy] = own = np.fromiter(map(len, rest), np.int64, len(rest))
        starts[~easy] = len(ids) + np.cumsum(own) - own
        ids = np.concatenate((ids, np.fromiter(chain.from_iterable(rest), np.uint32, int(own.sum()))))
        return ids[ragged(starts, lengths)], lengths

    def _of_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain texts, encoded word by word in one call, and where those of each text begin, with the end."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        words = "\0".join(_WORDS.findall("\0".join(texts)))
        written = codecs.charmap_decode(words.encode(), "strict", self.letters)[0]
        ids = np.array(self.model.encode_batch_fast([written], add_special_tokens=False)[0].ids, np.uint32)
        lengths = np.fromiter(map(len, map(str.encode, texts)), np.int64, len(texts))
        return ids, np.searchsorted(np.cumsum(self.sizes[ids]), np.concatenate(([0], np.cumsum(lengths))), "right")


class PartEncoder(PartMemory):
    def __init__(self, path: str, max_parts: int = MAX_PARTS, added_tokens: bool = True, sentences: bool = True):
        super().__init__(max_parts)
        self.sentences = sentences
        self.words = WordIds(path, added_tokens)
        self.tokenizer = self.words.tokenizer
        self.ids, self.ends = Lists(np.uint32), np.zeros(1 << 16, bool)
        self.uncuttable = "|".join([f"[{_SPACES}] ", *map(re.escape, self.words.added)])

    def learn(self, new: list) -> None:
        self.ids.add(*self.words.encode([p.decode() if isinstance(p, bytes) else f" {p}" for p in new]))
        self.ends = _room(self.ends, self.known + len(new))
        if self.sentences:
            self.ends[self.known: self.known + len(new)] = [ends_sentence(p) for p in new]

    def keep(self, at: np.ndarray) -> None:
        self.ids, self.ends = self.ids.kept(at), _room(self.ends[at], 1 << 16)

    def _parts(self, text: str) -> list:
        """Keys of a text's parts: bytes where no space stands before it, as at the start and around added tokens."""
        pieces = [p for p in self.words.split.split(text) if p] if self.words.split else [text]
        found = []
        for piece in pieces:
            own = [piece] if piece in self.words.added else cut(piece)
            own[0] = own[0].encode()
            found += own
        return found

    def _numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the parts of texts that are cut at each space, and how many each text has. Equal parts are looked up once."""
        cuts = pc.split_pattern(pa.array(texts, pa.string()), " ")
        parts, bounds = cuts.flatten(), cuts.offsets.to_numpy()
        first = np.zeros(len(parts), bool)
        first[bounds[:-1]] = True
        spaced = parts.filter(pa.array(~first)).dictionary_encode()
        at = spaced.indices.to_numpy()
        number = np.zeros(len(parts), np.int64)
        number[~first] = self.number(spaced.dictionary.to_numpy(zero_copy_only=False).tolist(), np.bincount(at, minlength=len(spaced.dictionary)))[at]
        # no space before it: another key than the same word within a text
        number[first] = self.number([p.encode() for p in parts.filter(pa.array(first)).to_pylist()])
        return number, np.diff(bounds)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in a row; ids per text; where parts begin in them; parts that end a sentence (none without ``sentences``)."""
        self.tidy()
        cuttable = ~pc.match_substring_regex(pa.array(texts, pa.string()), self.uncuttable).to_numpy(zero_copy_only=False).astype(bool)
        odd = [self._parts(t) for t, c in zip(texts, cuttable.tolist(), strict=True) if not c]
        plain, parts_of_plain = self._numbers([t for t, c in zip(texts, cuttable.tolist(), strict=True) if c])
        parts_of = np.zeros(len(texts), np.int64)
        parts_of[cuttable], parts_of[~cuttable] = parts_of_plain, np.fromiter(map(len, odd), np.int64, len(odd))
        number = np.zeros(parts_of.sum(), np.int64)
        own = np.repeat(cuttable, parts_of)
        number[own], number[~own] = plain, self.number(list(chain.from_iterable(odd)))
        flat, lengths = self.ids.take(number)
        ends_at = np.concatenate(([0], np.cumsum(lengths)))
        bounds = np.concatenate(([0], np.cumsum(parts_of)))
        return flat, np.diff(ends_at[bounds]), ends_at[:-1], self.ends[number]
