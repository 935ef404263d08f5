"""Token ids of whole texts by a public tokenizer, inside Arrow batches.

A text is cut into pieces that the tokenizer treats alike wherever they stand, so each different
piece is encoded once and looked up afterwards. What is remembered is bounded: when the newer half
is full, the older half is forgotten; that changes speed only.
"""

from __future__ import annotations

import os
import re
import unicodedata
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

MOST_PIECES = 1_000_000
JOINED = 256
# Other texts are cut at the ends of runs of letters; before one, too, unless an apostrophe may bind
# it, where white space is dropped; else before a single space that follows something else.
# (This class of letters holds a few numerals, which the tokenizer parts from anything.)
_LOOSE_WORDS = re.compile(r"[^\W\d_]+|(?:'[^\W\d_]*|[^\w']|[\d_])+")
_LOOSE_SPACED = regex.compile(r"(?<!\s) ?\p{L}+|[^\p{L}](?:(?!(?<=\S) )[^\p{L}])*\p{L}*")
# A line that `_plain` accepts, in letters and digits that every version of Unicode has as such.
_WORD = "[0-9A-Za-zÀ-ÖØ-öø-ſ]+"
_PLAIN_LINE = rf"\A{_WORD}(?:[.,]? {_WORD})*[.,]?\z"
_SMALL_WORD = re.compile("[a-zß-öø-ÿ]+").fullmatch
# Put before a piece that has no space before it.
_CLOSE = "\x01"

_encoders: dict = {}


def _plain(text: str) -> bool:
    """Letters, digits, single spaces or line feeds between them, and full stops and commas that
    stand behind a letter or digit and before white space or the end: such a text may be cut at each
    of these marks."""
    bare = text.replace(" ", "").replace("\n", "").replace(".", "").replace(",", "")
    if not bare.isalnum() or text[0] in " \n" or text[-1] in " \n":
        return False
    if any(pair in text for pair in ("  ", " \n", "\n ", "\n\n", " .", " ,", "\n.", "\n,")):
        return False
    return text[0] not in ".," and all(
        text.count(m) == text.count(m + " ") + text.count(m + "\n") + text.endswith(m) for m in ".,")


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of `flat` that begin at `starts`, one after the other."""
    before = np.cumsum(sizes) - sizes
    return flat[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


def _strings(values: pa.Array) -> list[str]:
    """Strings without line feeds as a list, faster than one by one."""
    if not len(values):
        return []
    whole = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    return pc.binary_join(whole, pa.scalar("\n", values.type))[0].as_py().split("\n")


class _Memory:
    """Pieces and their ids, laid end to end."""

    def __init__(self):
        self.known: dict[str, int] = {}
        self.starts = self.sizes = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def add(self, pieces: list[str], sizes: np.ndarray, flat: np.ndarray) -> None:
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces))))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, flat])


class PieceEncoder:
    """Encodes texts with the tokenizer of `path`, adding no special tokens; those that stand in a
    text have their own id, as in the tokenizer itself, and what is around them is encoded apart.

    `spaces` says that a space belongs to the piece behind it (byte-level vocabularies); otherwise
    white space and letter case are dropped by the tokenizer itself.
    """

    def __init__(self, path: str, spaces: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks use the cores
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(a.lstrip or a.rstrip or a.single_word or a.normalized for a in added):
            raise ValueError("added tokens that are not matched as they are written")
        # The longest first, as one may begin another.
        self.added = sorted((a.content for a in added), key=len, reverse=True)
        self.cut_added = re.compile(f"({'|'.join(map(re.escape, self.added))})") if self.added else None
        self.spaces = spaces
        # Among words of letters alone, these ids are the last of one (or, behind a space, the first).
        vocabulary = self.tokenizer.get_vocab()
        self.edge = np.zeros(max(vocabulary.values()) + 1, bool)
        self.edge[[i for t, i in vocabulary.items() if (
            t.startswith("\u0120") if spaces else t.endswith("</w>"))]] = True
        # Words of small letters alone are in the form that the tokenizer brings them to, and are not parted before the
        # model: its steps before that are left out for them.
        self.simple = None
        if not spaces:
            self.simple = Tokenizer.from_file(path)
            self.simple.normalizer = None
            self.simple.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        self.new, self.old = _Memory(), _Memory()

    def pieces(self, text: str) -> list[str]:
        """Pieces in the form they are remembered in; with `spaces`, one without a space before it
        begins with a mark. Added tokens are pieces of their own."""
        if not any(a in text for a in self.added):
            return self._pieces(text)
        out = []
        for part in self.cut_added.split(text):
            if part in self.added:
                out.append(_CLOSE + part if self.spaces else part)
            elif part:
                out += self._pieces(part)
        return out

    def _pieces(self, text: str) -> list[str]:
        if self.spaces:
            if _plain(text):
                return self._spaced(text.replace("\n", f" {_CLOSE}\n {_CLOSE}"))
            lines = text.split("\n")
            if any(not line or line[0].isspace() or line[-1].isspace() for line in lines):
                return self._loose(text)
            # Single line feeds between other characters are pieces of their own.
            out = []
            for line in lines:
                out += [_CLOSE + "\n", *(self._spaced(line) if _plain(line) else self._loose(line))]
            return out[1:]
        # Parts of a text in normal form are in normal form themselves.
        if not unicodedata.is_normalized("NFC", text):
            return text.split(" ")
        if "Σ" not in text and "İ" not in text:  # their lower case depends on what is around
            text = text.lower()
        if _plain(text):
            return self._worded(text.replace("\n", " "))
        return [p for line in text.split("\n")
                for p in (self._worded(line) if _plain(line) else _LOOSE_WORDS.findall(line))]

    def _worded(self, line: str) -> list[str]:
        return line.replace(".", " .").replace(",", " ,").split(" ")

    def _spaced(self, line: str) -> list[str]:
        return (_CLOSE + line.replace(".", f" {_CLOSE}.").replace(",", f" {_CLOSE},")).split(" ")

    def _loose(self, text: str) -> list[str]:
        cut = _LOOSE_SPACED.findall(text)
        return [p[1:] if p[:1] == " " and p[1:2] != _CLOSE else _CLOSE + p for p in cut]

    def _literal(self, piece: str) -> str:
        if not self.spaces:
            return piece
        return piece[1:] if piece[:1] == _CLOSE else " " + piece

    def _encoded(self, pieces: list[str], tokenizer=None) -> tuple[np.ndarray, np.ndarray]:
        """(ids per piece, all their ids)."""
        found = (tokenizer or self.tokenizer).encode_batch_fast(pieces, add_special_tokens=False)
        ids = [np.array(e.ids, np.uint32) for e in found]
        return np.array([len(i) for i in ids], np.int64), np.concatenate([*ids, np.zeros(0, np.uint32)])

    def _encoded_words(self, words: list[str], tokenizer=None) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters alone, many to a call; the edges tell them apart."""
        joined = [" " * self.spaces + " ".join(words[i:i + JOINED]) for i in range(0, len(words), JOINED)]
        _, flat = self._encoded(joined, tokenizer)
        edges = np.flatnonzero(self.edge[flat])
        if len(edges) != len(words):
            return self._encoded(list(map(self._literal, words)))
        bounds = np.append(edges, len(flat)) if self.spaces else np.append(-1, edges)
        return np.diff(bounds), flat

    def _learn(self, fresh: list[str]) -> None:
        old = self.old.known
        again = [p for p in fresh if p in old]
        if again:
            at = np.array([old[p] for p in again], np.int64)
            sizes = self.old.sizes[at]
            self.new.add(again, sizes, _gather(self.old.flat, self.old.starts[at], sizes))
        unseen = [p for p in fresh if p not in old] if again else fresh
        if self.simple:
            small, other = [], []
            for p in unseen:
                (small if _SMALL_WORD(p) else other).append(p)
            if small:
                self.new.add(small, *self._encoded_words(small, self.simple))
            unseen = other
        words = [p for p in unseen if p.isalpha()]
        others = [p for p in unseen if not p.isalpha()]
        if words:
            self.new.add(words, *self._encoded_words(words))
        if others:
            self.new.add(others, *self._encoded(list(map(self._literal, others))))

    def _places(self, pieces: list[str]) -> np.ndarray:
        """Where the pieces are remembered; unknown ones are learned first."""
        at = np.fromiter(map(self.new.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        gaps = np.flatnonzero(at < 0)
        if len(gaps):
            missing = [pieces[i] for i in gaps.tolist()]
            self._learn(list(dict.fromkeys(missing)))
            at[gaps] = np.fromiter(map(self.new.known.__getitem__, missing), np.int64, len(missing))
        return at

    def _cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Where the pieces of the texts are remembered, and how many pieces there are up to the end of each text."""
        cut = [self.pieces(t) for t in texts]
        return self._places(list(chain.from_iterable(cut))), np.cumsum([len(ps) for ps in cut], dtype=np.int64)

    def _cut_lines(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts of `_by_lines`: all lines are cut at once, and each different piece is looked up once."""
        # Only A-Z are lowered here, whatever is around them; the tokenizer lowers the others.
        texts_lines = pc.split_pattern(pc.ascii_lower(pa.array(texts, pa.large_string())), "\n")
        lines = texts_lines.flatten()
        cut = lines
        for mark, parted in ((" ", "\n"), (".", "\n."), (",", "\n,")):
            cut = pc.replace_substring(cut, mark, parted)
        other = pc.invert(pc.match_substring_regex(lines, _PLAIN_LINE))
        loose = ["\n".join(self._worded(line) if _plain(line) else _LOOSE_WORDS.findall(line))
                 for line in _strings(lines.filter(other))]
        cut = pc.replace_with_mask(cut, other, pa.array(loose, pa.large_string()))
        lines_pieces = pc.split_pattern(cut, "\n")
        pieces = lines_pieces.flatten().dictionary_encode()
        at = self._places(_strings(pieces.dictionary))[pieces.indices.to_numpy()]
        return at, lines_pieces.offsets.to_numpy()[texts_lines.offsets.to_numpy()[1:]]

    def _by_lines(self, text: str) -> bool:
        """Without `spaces`, a text in normal form that holds no added token."""
        return not self.spaces and unicodedata.is_normalized("NFC", text) and not any(a in text for a in self.added)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.new.known) > MOST_PIECES // 2:
            self.new, self.old = _Memory(), self.new
        out: list = [None] * len(texts)
        kinds = list(map(self._by_lines, texts))
        for kind, cut in ((True, self._cut_lines), (False, self._cut)):
            chosen = [i for i, k in enumerate(kinds) if k == kind]
            if chosen:
                at, last = cut([texts[i] for i in chosen])
                sizes = self.new.sizes[at]
                ends = np.concatenate([[0], np.cumsum(sizes)])[last]
                for i, ids in zip(chosen, np.split(_gather(self.new.flat, self.new.starts[at], sizes), ends[:-1])):
                    out[i] = ids
        return out


def encoder(path: str, spaces: bool) -> PieceEncoder:
    """The encoder of this worker process."""
    key = (path, spaces)
    if key not in _encoders:
        _encoders[key] = PieceEncoder(path, spaces)
    return _encoders[key]


def forget() -> None:
    """Drop the encoders of this worker process, with all they remember."""
    _encoders.clear()
