"""A quality classifier from weak labels.

1. Heuristic labellers each vote good, bad or nothing on every document.
2. Expectation-maximisation over the counts of vote rows (there are at most
   3 ** labellers, whatever the corpus) estimates how often each labeller is
   right on good documents and on those with either fault (odd characters, or
   repetition), and the share of each.
3. The posterior of its vote row labels a document. A bounded sample of them
   trains a logistic scorer over hashed words and word shapes.
4. The scorer reads every whole document and keeps or rejects it.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetbook.llm.common import text_batches, written

GOOD, BAD, NONE = 2, 0, 1  # digits of a vote row
BUCKETS = 1 << 14
SAMPLE_ROWS = 4_000        # documents that train the scorer, at most
SAMPLE_FEATURES = 1 << 22  # and their features, which come to the driver

_SYMBOLS = np.frombuffer(b"#$%&*<>\\^`{|}~", np.uint8)
# Letters by case, digits; other bytes as they are, those of non-ASCII letters as small ones
_SHAPES = bytes(65 if 65 <= c < 91 else 97 if 97 <= c < 123 or c > 127 else 48 if 48 <= c < 58 else c
                for c in range(256))


@dataclass
class Facts:
    """What the labellers look at, from one count of a text's bytes and words."""

    words: int
    chars: int           # bytes that are not blank
    letters: int         # bytes of letters, all of a non-ASCII character's
    capitals: int
    plain: int           # words of letters alone, but for marks at the end
    symbols: int
    shouts: int          # exclamation marks
    stops: int           # full stops
    distinct: float      # distinct words over the number expected of prose this long
    repeats: float       # words equal to the word before
    pairs: float         # distinct pairs of neighbouring words
    lines: int
    distinct_lines: int


def facts_of(text: str) -> Facts:
    raw = text.encode()
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.lower().split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n = len(words)
    same = sum(map(bytes.__eq__, words, words[1:]))
    plain = sum(w.rstrip(b".,;:?").isalpha() for w in raw.translate(_SHAPES).split())
    return Facts(
        words=n, chars=int(counts.sum() - counts[9:14].sum() - counts[32]),
        letters=int(counts[65:91].sum() + counts[97:123].sum() + counts[128:].sum()),
        capitals=int(counts[65:91].sum()), plain=plain,
        symbols=int(counts[_SYMBOLS].sum()), shouts=int(counts[33]), stops=int(counts[46]),
        distinct=len(set(words)) / max(1.0, n ** 0.8), repeats=same / max(1, n - 1),
        pairs=len(set(zip(words, words[1:]))) / max(1, n - 1),
        lines=len(lines), distinct_lines=len(set(lines)))


def _vote(bad: bool, good: bool) -> int:
    return BAD if bad else GOOD if good else NONE


GOOD_CLASS, ODD, REPEATS = 0, 1, 2  # latent classes of documents
# The fault that a labeller looks for, and its vote; it abstains between its
# two bounds and where it has too little to see
LABELLERS = (
    (ODD, lambda f: _vote(f.symbols > 0.10 * f.words, f.symbols <= 0.03 * f.words)),
    (ODD, lambda f: _vote(f.letters < 0.9 * f.chars, f.letters > 0.94 * f.chars) if f.words >= 12 else NONE),
    (ODD, lambda f: _vote(f.plain < 0.7 * f.words, f.plain > 0.9 * f.words) if f.words >= 12 else NONE),
    (ODD, lambda f: _vote(f.capitals > 0.5 * f.letters, f.capitals < 0.2 * f.letters) if f.letters else NONE),
    (ODD, lambda f: _vote(f.shouts > 0.2 * f.words, f.shouts < 0.05 * f.words)),
    (REPEATS, lambda f: _vote(f.repeats > 0.2, f.repeats < 0.05) if f.words >= 5 else NONE),
    (REPEATS, lambda f: _vote(f.pairs < 0.4, f.pairs > 0.7) if f.words >= 10 else NONE),
    (REPEATS, lambda f: _vote(f.distinct < 0.25, f.distinct > 0.5) if f.words >= 50 else NONE),
    (REPEATS, lambda f: _vote(f.distinct_lines < 0.6 * f.lines, f.distinct_lines > 0.9 * f.lines) if f.lines >= 3 else NONE),
)
FAULTS = np.array([fault for fault, _ in LABELLERS])


def vote_row(text: str) -> int:
    """All votes as one number in base 3, the first labeller lowest."""
    f = facts_of(text)
    return sum(vote(f) * 3 ** i for i, (_, vote) in enumerate(LABELLERS)) if f.words else EMPTY_ROW


EMPTY_ROW = sum(NONE * 3 ** i for i in range(len(LABELLERS)))


def _votes_of(rows: np.ndarray) -> np.ndarray:
    return rows[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


@dataclass
class LabelModel:
    shares: np.ndarray        # of each class
    tables: np.ndarray        # [class, labeller, vote]: probability of the vote

    def classes(self, rows: np.ndarray) -> np.ndarray:
        """Probability of each class, [class, row]."""
        votes = _votes_of(rows)
        log = np.log(self.shares)[:, None] + sum(
            np.log(self.tables[:, i, votes[:, i]]) for i in range(len(LABELLERS)))
        odds = np.exp(log - log.max(0))
        return odds / odds.sum(0)

    def posterior(self, rows: np.ndarray) -> np.ndarray:
        """Probability of good for each vote row."""
        return self.classes(rows)[GOOD_CLASS]


def no_labels() -> LabelModel:
    return LabelModel(np.full(3, 1 / 3), np.ones((3, len(LABELLERS), 3)))


def fit_labels(rows: np.ndarray, counts: np.ndarray, rounds: int = 100) -> LabelModel:
    """Expectation-maximisation; a labeller that abstains says nothing about
    the class. Half a vote of smoothing. A document starts in the class of a
    fault when two labellers of that fault object."""
    votes = _votes_of(rows)
    objections = np.stack([(votes[:, FAULTS == fault] == BAD).sum(1) for fault in (ODD, REPEATS)])
    odds = np.concatenate([np.ones((1, len(rows))), np.exp(2 * objections - 3.0)])
    post = odds / odds.sum(0)
    model = no_labels()
    for _ in range(rounds):
        share = post * counts
        model.shares = (share.sum(1) + 0.5) / (counts.sum() + 1.5)
        for i in range(len(LABELLERS)):
            said = np.stack([share[:, votes[:, i] == vote].sum(1) + 0.5 for vote in (BAD, GOOD)], 1)
            model.tables[:, i, [BAD, GOOD]] = said / said.sum(1, keepdims=True)
        post = model.classes(rows)
    return model


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed buckets of a whole text and their values: its words, the shape
    of each word's start and end, and whether a word repeats the one before;
    values are square roots of frequencies."""
    raw = text.encode()
    words = raw.lower().split()
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    crc = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    shapes = [s[:2] + b"~" + s[-3:] for s in raw.translate(_SHAPES).split()]
    shape = np.fromiter(map(zlib.crc32, shapes), np.uint32, len(words))
    again = int((crc[1:] == crc[:-1]).sum())
    counts = np.bincount(crc % (BUCKETS // 2), minlength=BUCKETS).astype(float)
    counts += np.bincount(BUCKETS // 2 + shape % (BUCKETS // 2 - 1), minlength=BUCKETS)
    counts[BUCKETS - 1] = again
    at = np.flatnonzero(counts)
    return at, np.sqrt(counts[at] / len(words))


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, passes: int = 12,
               rate: float = 0.5, l2: float = 1e-6) -> np.ndarray:
    """Weights (the last is the bias) of a logistic scorer on soft labels, by
    AdaGrad over the rows in the order given."""
    weights, squares = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 1e-4)
    for _ in range(passes):
        for (at, x), y in zip(rows, labels):
            p = 1 / (1 + np.exp(-np.clip(weights[at] @ x + weights[-1], -30, 30)))
            grad = np.append((p - y) * x, p - y)
            at = np.append(at, BUCKETS)
            grad[:-1] += l2 * weights[at[:-1]]
            squares[at] += grad ** 2
            weights[at] -= rate * grad / np.sqrt(squares[at])
    return weights


def scores(texts: list[str], weights: np.ndarray) -> list[float]:
    out = []
    for text in texts:
        at, x = features(text)
        out.append(float(1 / (1 + np.exp(-np.clip(weights[at] @ x + weights[-1], -30, 30)))))
    return out


def votes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, votes): every document's vote row, from its whole text."""
    def label(batches):
        for rows, texts in text_batches(batches, 4 << 20):
            yield pa.record_batch([rows.column(0), pa.array([vote_row(t) for t in texts], pa.int32())],
                                  names=["id", "votes"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string")).mapInArrow(
        label, f"id {kind}, votes int")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          sample_rows: int = SAMPLE_ROWS) -> tuple[LabelModel, np.ndarray]:
    """The label model from the votes of all documents, and the scorer's
    weights from the ``sample_rows`` documents of least hashed id among those
    with words (the only part fitted on a sample), fewer where their features
    are more than ``SAMPLE_FEATURES``. Texts stay on the executors: features
    come back. Of an id with several texts one trains."""
    voted = written(votes(docs, id_col, text_col), "votes")
    table = (voted.where(F.col("votes") != EMPTY_ROW).groupBy("votes").agg(F.count("*").alias("n"))
             .orderBy("votes").collect())  # at most 3 ** labellers rows
    if not table:
        return no_labels(), np.zeros(BUCKETS + 1)
    model = fit_labels(np.array([r.votes for r in table]), np.array([r.n for r in table], float))
    sample = written(voted.where(F.col("id").isNotNull() & (F.col("votes") != EMPTY_ROW))
                     .groupBy("id").agg(F.min("votes").alias("votes"))  # an id once, however often it is there
                     .orderBy(F.xxhash64("id"), "id").limit(sample_rows), "quality-sample")

    def feature_rows(batches):
        for rows, texts in text_batches(batches, 4 << 20):
            got = [features(t) for t in texts]
            yield pa.record_batch(
                [rows.column(0), rows.column(1), pa.array([a.astype(np.int32) for a, _ in got], pa.list_(pa.int32())),
                 pa.array([x.astype(np.float32) for _, x in got], pa.list_(pa.float32()))],
                names=["id", "votes", "at", "x"])

    kind = docs.schema[id_col].dataType.simpleString()
    chosen = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
              .join(F.broadcast(sample), "id").select("id", "votes", "text")
              .mapInArrow(feature_rows, f"id {kind}, votes int, at array<int>, x array<float>"))
    order = (F.xxhash64("id"), "id")
    drawn = written(chosen.dropDuplicates(["id"]).withColumn("size", F.size("at")), "quality-features")
    sizes = drawn.select("id", "size").orderBy(*order).limit(sample_rows).toArrow()
    fit = np.cumsum(sizes.column("size").to_numpy()) <= SAMPLE_FEATURES
    bound = int(fit.sum()) or 1
    table = drawn.orderBy(*order).limit(bound).drop("size").toArrow()
    labels = model.posterior(table.column("votes").to_numpy())
    rows = [(at.values.to_numpy(), x.values.to_numpy().astype(float))
            for at, x in zip(table.column("at"), table.column("x"))]
    return model, fit_scorer(rows, labels)


def classify(docs: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
             sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row: the id, ``votes`` (the vote row), ``posterior`` (of the vote
    row), ``score`` and ``kept`` (score of ``threshold`` or more).

    A text that is null, empty or without words has no votes, posterior and
    score 0, and is rejected. Repeated rows count in the label model and are
    each returned, a repeated id trains once; a null id is scored but does not
    train. An empty table gives no rows. Other columns are not read.
    """
    model, weights = train(docs, id_col, text_col, sample_rows)
    shared = docs.sparkSession.sparkContext.broadcast((model, weights))  # fixed size

    def score(batches):
        labels, scorer = shared.value
        for rows, texts in text_batches(batches, 4 << 20):
            voted = np.array([vote_row(t) for t in texts])
            empty = np.array([not t.strip(" \t\n\x0b\x0c\r") for t in texts])
            got = np.where(empty, 0.0, scores(texts, scorer))
            yield pa.record_batch(
                [rows.column(0), pa.array(voted, pa.int32()), pa.array(np.where(empty, 0.0, labels.posterior(voted))),
                 pa.array(got), pa.array(got >= threshold)], names=["id", "votes", "posterior", "score", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string"))
            .mapInArrow(score, f"id {kind}, votes int, posterior double, score double, kept boolean")
            .withColumnRenamed("id", id_col))


def keep_good(docs: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
              sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that ``classify`` keeps, with all their columns, in
    one map over the scan."""
    _, weights = train(docs, id_col, text_col, sample_rows)
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    columns = [c for c in docs.columns if c != text_col]

    def pick(batches):
        for rows, texts in text_batches(batches, 4 << 20):
            got = scores(texts, shared.value)
            yield rows.filter(pa.array([bool(t.strip(" \t\n\x0b\x0c\r")) and s >= threshold for t, s in zip(texts, got)]))

    out = docs.select(*columns, text_col)
    return out.mapInArrow(pick, out.schema).select(*docs.columns)
