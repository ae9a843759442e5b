"""Exact token ids and counts of whole texts, a batch at a time.

Byte-level BPE first cuts a text into pre-tokens and merges inside each one
alone. Between two characters that are not white space, a single space always
starts a pre-token and a single line feed is one; a letter and a mark after it
are never in one. So a text may be cut there and the pieces encoded apart: ids
and counts are those of the whole text. The cuts of a batch are found in its
bytes, and each distinct piece (they are mostly words) is looked up once in the
worker's bounded memo. A new piece of letters alone is one pre-token and goes to
the library's BPE model; other new pieces without white space go to the whole
library many at once, joined by line feeds, and their ids are cut at the line
feed's.
Tokenizers of another kind get whole texts.
"""

from __future__ import annotations

import functools
import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa

_BLANK = re.compile(r"\s")
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ſЀ-ѿ]+")
_MARKS = ".,;:!?)"
_PAD = b"\t\t\t"  # white space that is no cut, around the texts of a batch
JOINED_CHARS = 1 << 15  # of new pieces encoded in one go
KEY_BYTES = 15  # a piece of at most so many is looked up as two numbers
_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _table(keep: bytes) -> np.ndarray:
    return np.isin(np.arange(256), list(keep))


_ASCII_BLANK = _table(b"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f ")
_ASCII_LETTER = _table(bytes(range(65, 91)) + bytes(range(97, 123)))
_LETTER_LEADS = _table(b"\xc3\xc4\xc5\xd0\xd1")  # two-byte characters that are letters, but for U+00D7 and U+00F7
_BLANK_LEADS = _table(b"\xc2\xe1\xe2\xe3")


def _cuttable(spec: dict) -> bool:
    pre = spec.get("pre_tokenizer") or {}
    plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) and " " not in t["content"]
                and "\n" not in t["content"] and not t["content"].isalpha() for t in spec.get("added_tokens", ()))
    return (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and plain
            and not pre.get("add_prefix_space") and spec.get("normalizer") is None)


def _byte_chars() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


def _wide_blank(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Whether the three-byte characters a, b, c may be white space; some that are not count too."""
    return (((a == 0xE1) & ((b == 0x9A) | (b == 0xA0))) | ((a == 0xE2) & (b == 0x80) & ((c < 0x90) | (c >= 0xA8)))
            | ((a == 0xE2) & (b == 0x81)) | ((a == 0xE3) & (b == 0x80)))


def _inner(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Those of the positions whose character stands between two that are not white space."""
    before, after = data[at - 1], data[at + 1]
    good = ~(_ASCII_BLANK[before] | _ASCII_BLANK[after])
    wide = np.flatnonzero(good & (before >= 0x80))
    if len(wide):
        i = at[wide]
        x, y, z = data[i - 3], data[i - 2], data[i - 1]
        good[wide] = ~((y == 0xC2) | _wide_blank(x, y, z))
    wide = np.flatnonzero(good & _BLANK_LEADS[after])
    if len(wide):
        i = at[wide]
        x, y, z = data[i + 1], data[i + 2], data[i + 3]
        good[wide] = ~((x == 0xC2) & ((y == 0x85) | (y == 0xA0)) | _wide_blank(x, y, z))
    return at[good]


def _keys(text: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Strings of at most ``KEY_BYTES`` bytes as two numbers: the bytes, and the size last."""
    text = np.concatenate([text, np.zeros(16, np.uint8)])
    eight = np.ndarray(len(text) - 7, "<u8", text, strides=(1,))  # the eight bytes from each on
    low = eight[starts] & _BYTES[np.minimum(sizes, 8)]
    high = eight[starts + 8] & _BYTES[np.maximum(sizes, 8) - 8] | sizes.astype(np.uint64) << np.uint64(56)
    return low, high


class Slots:
    """Numbers by key, looked up and added many at once: open addressing in
    arrays that stay at most half full. Keys are pairs of 64-bit numbers, the
    second not 0."""

    def __init__(self, bits: int = 16):
        self.n, self.bits = 0, bits
        self.low, self.high = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint64)
        self.slot = np.full(1 << bits, -1, np.int32)

    def _home(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mixed = (low ^ high * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xC2B2AE3D27D4EB4F)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for one that is not there."""
        out = np.full(len(low), -1, np.int64)
        left, at = np.arange(len(low)), self._home(low, high)
        while len(left):
            there = self.high[at]
            same = (there == high[left]) & (self.low[at] == low[left])
            out[left[same]] = self.slot[at[same]]
            on = ~same & (there != 0)
            left, at = left[on], at[on] + 1 & len(self.slot) - 1
        return out

    def add(self, low: np.ndarray, high: np.ndarray, slots: np.ndarray) -> None:
        """Distinct keys that are not there yet, with distinct numbers."""
        if 2 * (self.n + len(low)) > len(self.slot):
            held = np.flatnonzero(self.high)
            old = self.low[held], self.high[held], self.slot[held]
            self.__init__((2 * (self.n + len(low)) - 1).bit_length())
            self.add(*old)
        self.n += len(low)
        left, at = np.arange(len(low)), self._home(low, high)
        while len(left):
            free = self.high[at] == 0
            self.slot[at[free]] = slots[left[free]]
            won = self.slot[at] == slots[left]  # of several for one place the last
            self.low[at[won]], self.high[at[won]] = low[left[won]], high[left[won]]
            left, at = left[~won], at[~won] + 1 & len(self.slot) - 1


class Encoder:
    """Ids (as little-endian unsigned 32-bit bytes) or counts of texts by the
    library of the tokenizer file: tokenizers for .json, sentencepiece for
    .model; no begin, end or added special tokens, no truncation or padding."""

    def __init__(self, path: str, ids: bool, memo_entries: int = 1_200_000, memo_bytes: int = 64):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task owns one core
        self.ids, self.memo_entries, self.memo_bytes = ids, memo_entries, memo_bytes
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.cut, self.library = False, lambda texts: model.encode(texts, num_threads=1)
        else:
            from tokenizers import Tokenizer

            with open(path, encoding="utf-8") as f:
                spec = json.load(f)
            self.cut = _cuttable(spec)
            tok = Tokenizer.from_file(path)
            tok.no_truncation()
            tok.no_padding()
            self.library = lambda texts: [
                e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)]

        if self.cut:
            self.merge, self.byte_chars = tok.model.tokenize, dict(enumerate(_byte_chars()))
            self.marks = _table("".join(
                m for m in _MARKS if all(m not in t["content"] for t in spec.get("added_tokens", ()))).encode())
            feed = self.library(["\n"])[0]
            self.joins, self.feed_id = len(feed) == 1, feed[0]  # a line feed is a token of its own
            # the memo: a piece's slot, and by slot where its ids are in ``known``
            self.held, self.words, self.longer = 0, Slots(), {}
            self.known, self.starts = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64)

    def _encode(self, texts: list[str]) -> list:
        found = self.library(texts)
        return [np.asarray(x, "<u4").tobytes() for x in found] if self.ids else [len(x) for x in found]

    def _joined(self, pieces: list[str]) -> list[list[int]]:
        """Ids of pieces without white space but at their front: encoded as
        lines of a text. A piece that holds the line feed's id itself makes the
        lines too many, and the pieces are encoded apart."""
        ids = self.library(["\n".join(pieces)])[0]
        feeds = [i for i, x in enumerate(ids) if x == self.feed_id]
        if len(feeds) != len(pieces) - 1:
            return self.library(pieces)
        return [ids[lo:hi] for lo, hi in zip([0, *(i + 1 for i in feeds)], [*feeds, len(ids)])]

    def _results(self, pieces: list[str]) -> list[list[int]]:
        """Ids of any pieces: words by the model, others without inner white
        space many at once."""
        out: list[list[int] | None] = [None] * len(pieces)
        plain, other, merge, space = [], [], self.merge, self.byte_chars[32]
        for i, p in enumerate(pieces):
            word = p[1:] if p[0] == " " else p
            if word.isascii() and word.isalpha():
                out[i] = [t.id for t in merge(p if word is p else space + word)]
            elif _LETTERS.fullmatch(word):
                out[i] = [t.id for t in merge(p.encode().decode("latin-1").translate(self.byte_chars))]
            elif self.joins and word and not _BLANK.search(word):
                plain.append(i)
            else:
                other.append(i)
        lo = size = 0
        for hi, i in enumerate(plain, 1):
            size += len(pieces[i]) + 1
            if size >= JOINED_CHARS or hi == len(plain):
                for j, ids in zip(plain[lo:hi], self._joined([pieces[j] for j in plain[lo:hi]])):
                    out[j] = ids
                lo, size = hi, 0
        for i, ids in zip(other, self.library([pieces[i] for i in other]) if other else ()):
            out[i] = ids
        return out

    def _slots(self, pieces: pa.LargeBinaryArray) -> np.ndarray:
        """Slots of distinct pieces. New short ones enter the memo while there
        is room, as the first seen are mostly the frequent ones; the others'
        slots come after and hold until the next call."""
        if not len(pieces):
            return np.empty(0, np.int64)
        edges = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset:pieces.offset + len(pieces) + 1]
        sizes = np.diff(edges)
        short, slots = sizes <= KEY_BYTES, np.full(len(pieces), -1, np.int64)
        low, high = np.zeros((2, len(pieces)), np.uint64)
        low[short], high[short] = _keys(np.frombuffer(pieces.buffers()[2], np.uint8), edges[:-1][short], sizes[short])
        slots[short] = self.words.find(low[short], high[short])
        slots[~short] = [self.longer.get(p, -1) for p in _bytes(pieces, np.flatnonzero(~short))]
        new = np.flatnonzero(slots < 0)
        if not len(new):
            return slots
        lasting = sizes[new] <= self.memo_bytes
        kept = min(int(np.count_nonzero(lasting)), max(self.memo_entries - self.held, 0))
        new = new[np.argsort(~lasting, kind="stable")]
        names = _bytes(pieces, new)
        ids = self._results([p.decode() for p in names])
        first, past = self.held, self.held + len(new)
        ends = self.starts[first] + np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
        self.starts, self.known = _grown(self.starts, past + 1), _grown(self.known, int(ends[-1]))
        self.starts[first + 1:past + 1] = ends
        self.known[self.starts[first]:ends[-1]] = np.fromiter(chain.from_iterable(ids), np.uint32)
        slots[new] = np.arange(first, past)
        stay = new[:kept]
        self.longer.update((p, first + i) for i, p in enumerate(names[:kept]) if len(p) > KEY_BYTES)
        stay = stay[short[stay]]
        self.words.add(low[stay], high[stay], slots[stay])
        self.held += kept
        return slots

    def _edges(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where pieces start or end: all edges, ascending."""
        edge = np.zeros(len(data), bool)
        edge[starts] = edge[ends] = True
        edge[_inner(data, np.flatnonzero(data == 32))] = True
        feeds = _inner(data, np.flatnonzero(data == 10))
        edge[feeds] = edge[feeds + 1] = True
        at = np.flatnonzero(self.marks[data])
        x, y = data[at - 2], data[at - 1]
        edge[at[_ASCII_LETTER[y] | _LETTER_LEADS[x] & (y >= 0x80) & ((y & 0xDF) != 0x97)]] = True
        return np.flatnonzero(edge)

    def __call__(self, texts: list[str]) -> list:
        """One result per text: bytes of ids, or the count."""
        if not self.cut or not texts:
            return self._encode(texts)
        raw = [t.encode() for t in texts]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        text = _PAD + b"\t".join(raw) + _PAD
        ends = len(_PAD) - 1 + np.cumsum(sizes + 1)
        starts = ends - sizes
        data = np.frombuffer(text, np.uint8)
        edges = self._edges(data, starts, ends)
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(text)]).dictionary_encode()
        slots = self._slots(pieces.dictionary)
        first, at = self.starts[slots], pieces.indices.to_numpy()
        lengths = (self.starts[slots + 1] - first)[at]
        lo, hi = np.searchsorted(edges, starts), np.searchsorted(edges, ends)
        lengths[hi[:-1]] = 0  # between two texts
        before = np.concatenate([[0], np.cumsum(lengths)])
        if not self.ids:
            return (before[hi] - before[lo]).tolist()
        ids = self.known[np.repeat(first[at] - before[:-1], lengths) + np.arange(before[-1])].astype("<u4", copy=False)
        return [ids[a:b].tobytes() for a, b in zip(before[lo].tolist(), before[hi].tolist())]


def _bytes(pieces: pa.LargeBinaryArray, at: np.ndarray) -> list[bytes]:
    return pieces.take(pa.array(at)).to_numpy(zero_copy_only=False).tolist()


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    """The array, or a larger copy with room for ``size`` entries."""
    return array if size <= len(array) else np.resize(array, max(size, len(array) * 3 // 2))


@functools.cache
def encoder(path: str, ids: bool) -> Encoder:
    """The encoder of this Python worker, kept between its tasks."""
    return Encoder(path, ids)
