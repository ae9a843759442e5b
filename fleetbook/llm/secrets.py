"""Secret scans: fixed patterns, and a linear-chain conditional random field.

Patterns find assignments to secret-like names, access keys and long
hexadecimal strings. The field adds what they miss. It reads every line as a
chain of all its tokens (runs of letters and digits, and each other sign that
is not blank) and tags each token as begin, inside or outside from its shape,
the neighbouring words and signs, and features of the whole text. Tokens found
by the patterns in a bounded sample of documents are its training labels; each
chain is also learnt without its neighbours, so that shape alone can decide.
So that it knows more than the patterns do, every secret found is also learnt
in made-up variants (``variants``: re-cased, re-cut, of other alphabets), each
put between the words of a line that holds no secret.
Decoding is Viterbi, over the parts of the lines that can hold a secret under
the field (``_undecided``); all else is outside on the best path.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetbook.llm.common import text_batches, written

# Fixed patterns: kind, expression, least length of what is meant by the group
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the same matches as [0-9a-f]+ of 24 or more
KINDS = ("assign", "access", "hex", "crf")
NAMES = ("password", "passwd", "secret", "token", "api")

B, I, O = 0, 1, 2
BUCKETS = 1 << 14
SAMPLE_DOCS, SAMPLE_CHAINS, CHAIN_PIECES = 20_000, 20_000, 64  # bounds of the training sample
CHUNK = 2 << 20  # bytes of text tokenised at once
DOC_CHAINS = 64  # chains of a class that one document stands for, at most
VARIANTS, SAMPLE_VARIANTS = 48, 6_000  # of one secret, and of all, at most
AROUND = 12      # words on either side of a variant
# Alphabets of variants: hexadecimal, capitals with digits, letters with digits, the same with signs
ALPHABETS = ("0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
             "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
             "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-")
LENGTHS = (16, 18, 20, 24, 32, 40, 52, 64, 80)  # of a variant, or up to 6 characters more

_LINE = re.compile(r"[^\n]+")
_PIECE = re.compile(r"[^\W_]+|[^\w\s]|_")
_TILE = re.compile(r" ?(?:[^\W_]+|[^\w\s]|_)|\s+")  # the same and blanks: covers every text
WORD, SIGN, BLANK, BREAK = range(4)
_SHAPE = str.maketrans({**{c: "a" for c in "abcdefghijklmnopqrstuvwxyz"},
                        **{c: "A" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}, **{c: "9" for c in "0123456789"}})


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind index, end, start of the secret itself), in order."""
    out = []
    low = text.lower()
    if any(name in low for name in NAMES):
        out += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(out)


def _size(n: int) -> int:
    return min(n.bit_length() * 2 + (n >> max(0, n.bit_length() - 2) & 1), 20)


def _hashed(*parts) -> int:
    return zlib.crc32("\x1f".join(map(str, parts)).encode()) % BUCKETS


N_FEATURES, N_CONTEXT, N_OWN = 14, 5, 6  # the word's own come first, the context last
NO_CONTEXT = [_hashed("none", i) for i in range(N_CONTEXT)]
_SIZES = np.array([_size(n) for n in range(1024)], np.uint32)  # the same from 1024 on


def _word(tile: str) -> tuple:
    """What is known of a tile alone: kind, length, whether it has a blank in
    front, code of the word, code of its characters' classes, its features as
    the word before and after, and its own."""
    if tile.isspace():
        return (BREAK if "\n" in tile else BLANK, len(tile), 0, *[0] * (4 + N_OWN))
    word = tile.removeprefix(" ")
    code = zlib.crc32(word.lower().encode("utf-8", "surrogatepass"))
    front = (len(tile), len(tile) - len(word), code)
    if not word.isalnum():
        return (SIGN, *front, code, *_NO_WORD, *(_hashed(i, word) for i in range(N_OWN)))
    shape = word.translate(_SHAPE) if word.isascii() else "".join(
        c.translate(_SHAPE) if c.isascii() else "9" if c.isdigit() else "e" for c in word)
    hexa = not word.strip("0123456789abcdef")
    return (WORD, *front, *_shaped(shape, hexa, len(set(word)), code % BUCKETS, (code >> 16 ^ code * 31) % BUCKETS))


def _shaped(shape: str, hexa: bool, distinct: int, last: int, after: int) -> tuple:
    kinds, *own = (_own if len(shape) <= 32 else _own.__wrapped__)(shape, hexa, distinct)
    return (kinds, last, after, *own)


@lru_cache(1 << 16)
def _own(shape: str, hexa: bool, distinct: int) -> tuple:
    runs = 1 + sum(map(str.__ne__, shape, shape[1:]))
    kinds = "".join(sorted(set(shape)))
    n, digits = len(shape), shape.count("9")
    size = _size(n)
    return (zlib.crc32(kinds.encode()),
            _hashed("shape", kinds, size), _hashed("hex", hexa, size), _hashed("digits", kinds, 8 * digits // n),
            _hashed("runs", _size(runs), size), _hashed("distinct", 8 * distinct // n, size),
            _hashed("start", shape[:4]))


_NO_WORD = _hashed("last", 0), _hashed("after", 0)


class Vocabulary(dict):
    """The tiles seen by this process, with a row of ``_word`` each; begun anew
    when it grows large."""

    table, field, own = np.zeros((0, 7 + N_OWN), np.int64), None, None

    def __missing__(self, tile: str) -> int:
        n = self[tile] = len(self)
        self.new.append(_word(tile))
        return n

    def ids(self, tiles: list[str]) -> np.ndarray:
        if len(self) > 400_000 or self.table[:, 1].sum() > 1 << 25:
            self.clear()
            self.table, self.field = Vocabulary.table, None
        self.new = []
        ids = np.fromiter(map(self.__getitem__, tiles), np.int64, len(tiles))
        if self.new:
            self.table = np.concatenate([self.table, np.array(self.new, np.int64)])
        return ids

    def scores(self, field: Field, pairs: np.ndarray) -> np.ndarray:
        """The sums of the tiles' own features."""
        if self.field is not field:
            self.field, self.own = field, np.zeros(0, complex)
        new = self.table[len(self.own):, -N_OWN:]
        self.own = np.concatenate([self.own, pairs[new].sum(1)])
        return self.own


_VOCABULARY = Vocabulary()


def _mixed(tag: int, *codes: np.ndarray) -> np.ndarray:
    """Buckets of rows of codes."""
    x = np.full(len(codes[0]), tag * 0x85EBCA6B & 0xFFFFFFFF, np.uint32)
    for c in codes:
        x ^= c.astype(np.uint32, copy=False)
        x *= np.uint32(0x9E3779B1)
        x ^= x >> np.uint32(15)
    return (x & np.uint32(BUCKETS - 1)).astype(np.uint16)


class Tokens:
    """All tokens of some texts, in order, as arrays with an entry each."""

    def __init__(self, texts: list[str], whole: list[tuple[int, int, bool]] | None = None):
        """``whole`` describes what each text is a part of (see ``_parts``)."""
        tiles, counts = [], []
        for t in texts:
            got = _TILE.findall(t)
            tiles += got
            counts.append(len(got))
        ids = _VOCABULARY.ids(tiles)
        self.table = _VOCABULARY.table
        kind, sizes, text = self.table[ids, 0], self.table[ids, 1], np.repeat(np.arange(len(texts)), counts)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        end = np.cumsum(sizes) - (np.cumsum(lengths) - lengths)[text]
        at = np.flatnonzero(kind < BLANK)
        line = np.cumsum(kind == BREAK) + text
        self.id, self.text, self.kind, self.end = ids[at], text[at], kind[at], end[at]
        blank = self.table[self.id, 2]
        self.start = self.end - sizes[at] + blank
        n = len(at)
        self.first = np.ones(n, bool)       # of its line
        self.first[1:] = np.diff(line[at]) > 0
        self.glued = np.zeros(n, bool)      # to the token before
        self.glued[1:] = (np.diff(at) == 1) & ~self.first[1:] & (blank[1:] == 0)
        self.bounds = np.searchsorted(self.text, np.arange(len(texts) + 1))  # of each text's tokens
        if whole is None:
            lines = np.bincount(self.text[self.first], minlength=len(texts))
            whole = zip(lengths.tolist(), lines.tolist(), ("=" in t for t in texts))
        about = np.array(list(whole), np.int64).reshape(-1, 3)
        self.file = (_SIZES[np.minimum(about[:, 0], 1023)], _SIZES[np.minimum(about[:, 1], 1023)],
                     about[:, 2].astype(np.uint32))

    def _near(self, i: np.ndarray, values: np.ndarray, none: int = 0) -> np.ndarray:
        """``values`` at ``i``, ``none`` where that is no token of the same text."""
        ok = (i >= self.low) & (i < self.high)
        return np.where(ok, values.take(i, mode="clip"), values.dtype.type(none))

    def columns(self):
        """The features but the words' own, one array at a time."""
        n = len(self.id)
        if not n:
            return
        self.low, self.high = self.bounds[self.text], self.bounds[self.text + 1]
        code, kinds = (self.table[:, j].astype(np.uint32)[self.id] for j in (3, 4))
        here, is_word = np.arange(n), self.kind == WORD
        sign = np.where(is_word, np.uint32(1), code)
        before, further, next_ = (self._near(here + d, sign) for d in (-1, -2, 1))
        unit = np.cumsum(~self.glued) - 1   # tokens without a blank between them
        edges = np.append(np.flatnonzero(~self.glued), n)
        count = np.minimum(np.diff(edges), 8)[unit]
        size = np.minimum(self.end[edges[1:] - 1] - self.start[edges[:-1]], 1023)[unit]
        last = np.concatenate([[-1], np.maximum.accumulate(np.where(is_word, here, -1))[:-1]])
        after = np.concatenate([np.minimum.accumulate(np.where(is_word, here, n)[::-1])[::-1][1:], [n]])
        one = self._near(last, code)
        two = self._near(np.where(last >= 0, last.take(last, mode="clip"), -1), code)
        file = _mixed(3, *self.file)
        yield _mixed(1, np.where(self.glued, before, np.uint32(2)), kinds)
        yield _mixed(2, count, _SIZES[size])
        yield file[self.text]
        yield self._near(last, self.table[:, 5].astype(np.uint16)[self.id], _NO_WORD[0])
        yield _mixed(5, one, before)
        yield _mixed(6, two, one)
        yield _mixed(7, before, further, next_)
        yield self._near(after, self.table[:, 6].astype(np.uint16)[self.id], _NO_WORD[1])

    def features(self) -> np.ndarray:
        return np.hstack([self.table[self.id, -N_OWN:].astype(np.uint16), *(c[:, None] for c in self.columns())])

    def emissions(self, field: Field) -> np.ndarray:
        """Scores of begin and inside over outside; that of outside is 0."""
        pairs = np.ascontiguousarray(field.emit[:, :O] - field.emit[:, O:]).view(complex)[:, 0]
        own = (_VOCABULARY.scores(field, pairs) if _VOCABULARY.table is self.table
               else pairs[self.table[:, -N_OWN:]].sum(1))
        out = own[self.id]
        for column in self.columns():
            out += pairs[column]
        return np.column_stack([out.real, out.imag, np.zeros(len(out))])

    def tags(self, bases: list) -> np.ndarray:
        """The tags of all tokens, by the patterns' spans of each text."""
        owner = np.concatenate([_owners(base, self.start[lo:hi], self.end[lo:hi])
                                for base, lo, hi in zip(bases, self.bounds, self.bounds[1:])] or [np.empty(0, int)])
        same = np.zeros(len(owner), bool)
        same[1:] = (owner[1:] == owner[:-1]) & ~self.first[1:]
        return np.where(owner < 0, O, np.where(same, I, B))

    def cuts(self) -> np.ndarray:
        """The first tokens of the lines' cuts of ``CHAIN_PIECES``."""
        here = np.arange(len(self.id))
        since = here - np.maximum.accumulate(np.where(self.first, here, 0))
        return np.flatnonzero(since % CHAIN_PIECES == 0)


def chains_of(text: str) -> list[tuple[re.Match, list[re.Match]]]:
    """Every line that is not blank, with its tokens."""
    return [(c, pieces) for c in _LINE.finditer(text) if (pieces := list(_PIECE.finditer(c[0])))]


def _rows(text: str, chains) -> list[np.ndarray]:
    if not chains:
        return []
    return np.split(Tokens([text]).features(), np.cumsum([len(pieces) for _, pieces in chains])[:-1])


def _owners(base, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """The first of ``base`` whose secret meets each token, -1 for none."""
    owner = np.full(len(lows), -1)
    if base:
        edges = np.array([(b[3], b[2]) for b in base])
        los, his = np.searchsorted(highs, edges[:, 0], "right"), np.searchsorted(lows, edges[:, 1], "left")
        for k in range(len(base) - 1, -1, -1):
            owner[los[k]:his[k]] = k
    return owner


def _tags(base, chain: re.Match, pieces: list[re.Match]) -> list[int]:
    at = chain.start()
    owner = _owners(base, np.array([at + p.start() for p in pieces]), np.array([at + p.end() for p in pieces]))
    same = np.concatenate([[False], owner[1:] == owner[:-1]])
    return np.where(owner < 0, O, np.where(same, I, B)).tolist()


@dataclass
class Field:
    """Weights: [bucket, tag] per feature, [tag, tag] between neighbours."""

    emit: np.ndarray
    move: np.ndarray

    # A secret begins with B: no I at the start of a chain or after O
    START = np.array([0.0, -1e9, 0.0])
    BAR = np.array([[0.0, 0.0, 0.0], [0.0, 0.0, 0.0], [0.0, -1e9, 0.0]])


class Batch:
    """Chains laid side by side, the longest first, one array per position."""

    def __init__(self, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1][self.order]
        sorted_ = lengths[self.order]
        self.at = [starts[:int(np.searchsorted(-sorted_, -t, side="left"))] + t
                   for t in range(int(sorted_[0]) if len(sorted_) else 0)]


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def _emissions(emit: np.ndarray, features: np.ndarray) -> np.ndarray:
    out = np.zeros((len(features), 3))
    for k in range(features.shape[1]):
        out += emit[features[:, k]]
    return out


def viterbi(field: Field, features: np.ndarray, batch: Batch) -> np.ndarray:
    """The best tags of every token."""
    return _decoded(field, _emissions(field.emit, features), batch)


def _decoded(field: Field, emit: np.ndarray, batch: Batch) -> np.ndarray:
    move = field.move + Field.BAR
    back, score = [], None
    best = np.zeros(len(emit), np.int8)
    finals = np.empty((len(batch.at[0]) if batch.at else 0, 3))
    for t, at in enumerate(batch.at):
        if t == 0:
            score = Field.START + emit[at]
        else:
            ways = score[:len(at), :, None] + move
            back.append(ways.argmax(1))
            score = ways.max(1) + emit[at]
        finals[:len(at)] = score
    tag = finals.argmax(1)
    for t in range(len(batch.at) - 1, -1, -1):
        at = batch.at[t]
        best[at] = tag[:len(at)]
        if t:
            tag[:len(at)] = back[t - 1][np.arange(len(at)), tag[:len(at)]]
    return best


def _gradient(field: Field, features: np.ndarray, tags: np.ndarray, batch: Batch,
              weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of the log-likelihood by forward and backward sums: per piece
    and tag, and per pair of neighbouring tags; ``weights`` are per piece."""
    weights = np.ones(len(features)) if weights is None else weights
    emit, move = _emissions(field.emit, features), field.move + Field.BAR
    forward, n = np.empty((len(features), 3)), len(batch.at)
    for t, at in enumerate(batch.at):
        if t == 0:
            forward[at] = Field.START + emit[at]
        else:
            forward[at] = _logsum(forward[at - 1][:, :, None] + move, 1) + emit[at]
    backward, pairs = np.zeros((len(features), 3)), np.zeros((3, 3))
    for t in range(n - 1, 0, -1):
        at = batch.at[t]
        ahead = move + (emit[at] + backward[at])[:, None, :]
        backward[at - 1] = _logsum(ahead, 2)
        joint = forward[at - 1][:, :, None] + ahead
        joint -= _logsum(joint.reshape(len(at), 9), 1)[:, None, None]
        pairs -= np.tensordot(weights[at], np.exp(joint), 1)
        np.add.at(pairs, (tags[at - 1], tags[at]), weights[at])
    both = forward + backward
    unary = np.eye(3)[tags] - np.exp(both - _logsum(both, 1)[:, None])
    return unary * weights[:, None], pairs


def _undecided(field: Field, emit: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The tokens that Viterbi must read; on the best path all others are
    outside, and so are the ends of every run of those returned, unless a run
    ends with its line or at a token that may be in a secret.

    Scores are taken relative to the path that is outside throughout. Every
    token in a secret adds ``most`` or less, its moves included. Where that is
    below 0 the token is cold. A secret (or several that touch) of cold tokens
    alone loses against outside. One that reaches from a warm token over cold
    ones to the right can be cut off behind the warm token for ``cut`` at
    worst; one that reaches over them from the left can begin at the warm token
    instead, for ``begin`` at worst. So neither reaches past the cold token
    where the sum of ``most`` falls below that bound."""
    move = field.move - field.move[O, O]
    most = (emit[:, :O] - emit[:, O:]).max(1) + max(0, move[:, B].max(), move[B, I], move[I, I]) + max(0, move[:O, O].max())
    warm = most >= -1e-6
    cut = min(0, move[:O, O].min())
    begin = np.minimum(move[O, B] - max(move[B, B], move[I, B]),
                       emit[:, B] - emit[:, I] + move[O, B] - max(move[B, I], move[I, I]) + min(0, (move[B] - move[I]).min()))
    need = warm.copy()
    ends = np.concatenate([first[1:], [True]])[:len(first)]
    for step, barred, bound in ((1, ends, np.full(len(emit), cut)), (-1, first, np.minimum(0, begin))):
        at = np.flatnonzero(warm)
        left = bound[at] - 1e-6
        while len(at):
            go = ~barred[at]
            at, left = at[go] + step, left[go]
            go = ~warm[at]
            at, left = at[go], left[go]
            need[at] = True
            left = left - most[at]  # at or below 0: the sum is not yet below the bound
            go = left <= 0
            at, left = at[go], left[go]
    return need


def fit(chains: list[tuple[np.ndarray, np.ndarray]], rounds: int = 60, rate: float = 0.3, l2: float = 0.05,
        weights: np.ndarray | None = None) -> Field:
    """A field from (features, tags) chains, each also without its context, by
    AdaGrad with a Gaussian prior; from 2,500 chains on each round reads the
    next of several equal parts of them. ``weights`` say how many chains each
    stands for. Without chains everything is outside."""
    field = Field(np.zeros((BUCKETS, 3)), np.zeros((3, 3)))
    if not chains:
        field.emit[:, O] = 1
        return field
    weights = np.ones(len(chains)) if weights is None else weights
    n_parts, parts = max(1, len(chains) // 1250), []
    for k in range(n_parts):
        own = chains[k::n_parts]
        full = np.vstack([f for f, _ in own]).astype(np.uint16)
        bare = full.copy()
        bare[:, -N_CONTEXT:] = NO_CONTEXT
        lengths = np.tile([len(t) for _, t in own], 2)
        parts.append((np.vstack([full, bare]), np.tile(np.concatenate([t for _, t in own]), 2), Batch(lengths),
                      np.repeat(np.tile(weights[k::n_parts], 2), lengths)))
    squares, move_squares = np.full((BUCKETS, 3), 1e-3), np.full((3, 3), 1e-3)
    for r in range(rounds):
        features, tags, batch, weight = parts[r % n_parts]
        unary, pairs = _gradient(field, features, tags, batch, weight)
        grad = np.stack([sum(np.bincount(features[:, j], unary[:, k], BUCKETS) for j in range(N_FEATURES)) for k in range(3)], 1)
        grad -= l2 / n_parts * field.emit
        pairs -= l2 / n_parts * field.move
        squares += grad ** 2
        move_squares += pairs ** 2
        field.emit += rate * grad / np.sqrt(squares)
        field.move += rate * pairs / np.sqrt(move_squares)
    return field


def _parts(text: str) -> Iterator[tuple[int, str]]:
    """A text in parts of about ``CHUNK`` characters, cut behind line ends, with
    the place of each; a longer line is a part of its own. No span crosses a
    line end. The words before a cut are not seen by the line after it."""
    lo = 0
    while len(text) - lo > CHUNK:
        hi = text.rfind("\n", lo, lo + CHUNK) + 1 or text.find("\n", lo) + 1 or len(text)
        yield lo, text[lo:hi]
        lo = hi
    yield lo, text[lo:]


def long_spans(text: str, field: Field) -> list[tuple[int, int, int]]:
    """``spans_of`` for one text of any length, read part by part."""
    about = len(text), sum(1 for line in _LINE.finditer(text) if not line[0].isspace()), "=" in text
    return [(lo + a, k, lo + b) for lo, part in _parts(text) for a, k, b in spans_of([part], field, [about])[0]]


def spans_of(texts: list[str], field: Field,
             whole: list[tuple[int, int, bool]] | None = None) -> list[list[tuple[int, int, int]]]:
    """Per text, all spans as (start, kind index, end), in order: the patterns'
    and the field's that meet none of them."""
    bases = [base_spans(t) for t in texts]
    out = [[s[:3] for s in base] for base in bases]
    starts = [[b[0] for b in base] for base in bases]
    ends = [list(accumulate((b[2] for b in base), max)) for base in bases]  # furthest so far

    def meets(i, lo, hi):
        n = bisect_left(starts[i], hi)
        return n > 0 and ends[i][n - 1] > lo

    tokens = Tokens(texts) if whole is None else Tokens(texts, whole)
    emit = tokens.emissions(field)
    need = _undecided(field, emit, tokens.first)
    at = np.flatnonzero(need)
    if not len(at):
        return out
    begins = np.flatnonzero(np.concatenate([[True], (np.diff(at) > 1) | tokens.first[at[1:]]]))
    tags = np.full(len(need), O, np.int8)
    tags[at] = _decoded(field, emit[at], Batch(np.diff(np.append(begins, len(at)))))
    opened = np.flatnonzero(tags == B)
    closed = np.flatnonzero((tags != O) & np.append((tags[1:] != I) | tokens.first[1:], True))
    for lo, hi in zip(opened.tolist(), closed.tolist()):
        i, span = int(tokens.text[lo]), (int(tokens.start[lo]), int(tokens.end[hi]))
        if not meets(i, *span):
            out[i].append((span[0], 3, span[1]))
    return [sorted(s) for s in out]


def variants(secret: str, n: int, seed: int) -> list[str]:
    """``n`` strings like a secret and unlike it: its case swapped, then random
    ones of other lengths and alphabets in turn, fixed by ``seed``."""
    rng, out = random.Random(seed), [secret.swapcase()]
    for i in range(n - 1):
        out.append("".join(rng.choices(ALPHABETS[(seed + i) % len(ALPHABETS)], k=rng.choice(LENGTHS) + rng.randrange(7))))
    return out[:n]


def _placed(secrets: list[tuple[str, int]], lines: list[tuple[int, str]], n: int) -> tuple[list[str], list[list], list[int]]:
    """New lines for (secret, seed) pairs: ``n`` variants of each between the
    words of one of ``lines`` (text, line); with the place of the variant in
    each as a span, and the text that the words are from."""
    made, spans, source = [], [], []
    for secret, seed in secrets:
        for j, v in enumerate(variants(secret, n, seed)):
            i, line = lines[(seed >> 3) * 31 % len(lines) - j % len(lines)] if lines else (-1, "")
            words = line.split()
            at = (seed >> 7) % (len(words) + 1) if words else 0
            before = " ".join([*words[max(0, at - AROUND):at], ""])
            made.append(before + " ".join([v, *words[at:at + AROUND]]))
            spans.append([(len(before), 0, len(before) + len(v), len(before))])
            source.append(i)
    return made, spans, source


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """The field, from lines of the ``SAMPLE_DOCS`` documents of least hashed
    id, ``SAMPLE_CHAINS`` chains of ``CHAIN_PIECES`` tokens at most (a longer
    line is cut for training). At most half of them hold a secret. A document
    gives the same bounded number of each class, those of least hash, and
    stands for ``DOC_CHAINS`` chains of a class at most, so that one document
    cannot fill the sample; weights restore the ratio of the classes. Variants
    of the secrets come on top, ``SAMPLE_VARIANTS`` at most. Texts of more than
    ``CHUNK`` characters do not train. Of an id
    with several texts the one of least hash trains. Only hashed features
    leave the executors."""
    sample = written(docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id")).distinct()
                     .orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS), "secret-sample")
    per_doc = max(4, SAMPLE_CHAINS // max(1, sample.count()))
    kind = docs.schema[id_col].dataType.simpleString()
    texts = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
             .where(F.length("text") <= CHUNK)
             .join(F.broadcast(sample), "id").select("id", F.xxhash64("text").alias("version"), "text"))
    chain_type = pa.list_(pa.struct([("at", pa.int64()), ("secret", pa.bool_()), ("stands", pa.float64())]))

    def choose(batches):
        for batch, got in text_batches(batches, CHUNK):
            tokens = Tokens(got)
            cuts, out = tokens.cuts(), [[] for _ in got]
            if len(cuts):
                secret = np.logical_or.reduceat(tokens.tags([base_spans(t) for t in got]) != O, cuts)
                text, at = tokens.text[cuts], tokens.start[cuts]
                order = np.lexsort((at, _mixed(9, at, at >> 32), secret, text))
                edges = np.flatnonzero(np.diff(text[order] * 2 + secret[order], prepend=-1))
                for lo, hi in zip(edges, np.append(edges[1:], len(order))):
                    stands = min(hi - lo, max(DOC_CHAINS, per_doc)) / min(hi - lo, per_doc)
                    out[text[order[lo]]] += [{"at": int(at[j]), "secret": bool(secret[j]), "stands": float(stands)}
                                             for j in order[lo:min(hi, lo + per_doc)]]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(out, chain_type)], names=["id", "version", "chains"])

    chains = written(
        texts.mapInArrow(choose, f"id {kind}, version long, chains array<struct<at:long,secret:boolean,stands:double>>")
        .groupBy("id").agg(F.min(F.struct("version", "chains")).alias("m"))
        .select("id", "m.version", F.explode("m.chains").alias("c")).select("id", "version", "c.*"), "secret-chains")
    totals = {r.secret: r.n for r in chains.groupBy("secret").agg(F.sum("stands").alias("n")).collect()}
    if not totals:
        return fit([])
    order = (F.xxhash64("id", "at"), "id", "at")
    secret = written(chains.where("secret").orderBy(*order).limit(SAMPLE_CHAINS // 2), "secret-half")
    n_secret = secret.count()
    outside = chains.where("NOT secret").orderBy(*order).limit(SAMPLE_CHAINS - n_secret)
    n_variants = min(VARIANTS, SAMPLE_VARIANTS // max(1, n_secret))
    picked = written(secret.unionByName(outside).groupBy("id", "version").agg(
        F.collect_list(F.struct("at", "secret", "stands")).alias("chains")), "secret-picked")

    def features(batches):
        for batch, got in text_batches(batches, CHUNK):
            tokens, bases = Tokens(got), [base_spans(t) for t in got]
            tags, rows, cuts, out = tokens.tags(bases), tokens.features(), tokens.cuts(), []
            ids, wanted = batch.column(0).to_pylist(), [{c["at"]: c for c in x} for x in batch.column(1).to_pylist()]
            found, lines = [], []
            for lo, hi in zip(cuts, np.append(cuts[1:], len(tags))):
                i, at = int(tokens.text[lo]), int(tokens.start[lo])
                if at in wanted[i]:
                    own = tags[lo:hi].astype(np.int8)
                    own[0] = B if own[0] == I else own[0]
                    out.append({"id": ids[i], "made": False, **wanted[i][at], "tags": own.tobytes(), "features": rows[lo:hi].tobytes()})
                    end = int(tokens.end[hi - 1])
                    if not wanted[i][at]["secret"]:
                        lines.append((i, got[i][at:end]))
                    elif of := [b for b in bases[i] if b[3] >= at and b[2] <= end]:
                        found.append((i, at, got[i][of[0][3]:of[0][2]]))
            if found and n_variants:
                seeds = [zlib.crc32(f"{ids[i]}:{at}".encode()) for i, at, _ in found]
                texts_, spans, source = _placed([(x, n) for (_, _, x), n in zip(found, seeds)], lines, n_variants)
                new = Tokens(texts_)
                new.file = tuple(np.where(np.array(source) >= 0, column[source], own) for column, own in zip(tokens.file, new.file))
                own, made = new.tags(spans), new.features()
                for k, (lo, hi) in enumerate(zip(new.bounds, new.bounds[1:])):
                    i, at, _ = found[k // n_variants]
                    out.append({"id": ids[i], "made": True, "at": -(at * VARIANTS + k % n_variants) - 1, "secret": True,
                                "stands": 1.0, "tags": own[lo:hi].astype(np.int8).tobytes(), "features": made[lo:hi].tobytes()})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("id", batch.schema.field(0).type), ("made", pa.bool_()), *chain_type.value_type, ("tags", pa.binary()),
                ("features", pa.binary())]))

    rows = (texts.join(F.broadcast(picked), ["id", "version"]).select("id", "chains", "text")
            .mapInArrow(features, f"id {kind}, made boolean, at long, secret boolean, stands double, tags binary, features binary")
            .dropDuplicates(["id", "at"]).orderBy(*order).drop("id", "at").collect())
    held = {c: sum(r.stands for r in rows if r.secret == c and not r.made) for c in totals}
    weights = np.array([r.stands if r.made else r.stands * totals[r.secret] / held[r.secret] for r in rows])
    return fit([(np.frombuffer(r.features, np.uint16).reshape(-1, N_FEATURES), np.frombuffer(r.tags, np.int8)) for r in rows],
               weights=weights / weights.mean())


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id and ``spans``, an array of (kind, start, end) by start,
    then kind in the order of ``KINDS``; offsets in code points, end
    exclusive. Overlapping matches of different patterns are all kept; spans
    of the field that meet one of a pattern are not.

    A null or empty text has no spans. A very long text is read in parts (see
    ``_parts``). Repeated rows are each returned and
    train once; a null id is scanned but does not train. An empty table gives
    no rows. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, id_col, text_col))  # fixed size
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def find(batches):
        for batch, texts in text_batches(batches, CHUNK):
            long = len(texts) == 1 and len(texts[0]) > CHUNK  # text_batches gives it alone
            found = [long_spans(texts[0], shared.value)] if long else spans_of(texts, shared.value)
            spans = [[{"kind": KINDS[k], "start": lo, "end": hi} for lo, k, hi in s] for s in found]
            yield pa.record_batch([batch.column(0), pa.array(spans, span)], names=["id", "spans"])

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string"))
            .mapInArrow(find, f"id {kind}, spans array<struct<kind:string,start:long,end:long>>")
            .withColumnRenamed("id", id_col))


def span_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
