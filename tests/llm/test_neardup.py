"""Near-duplicate components against a brute-force comparison of all pairs."""

import random
import re

import pytest

from fleetbook.llm import neardup
from fleetbook.llm.components import components


def sets_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    return frozenset({tuple(words)} if len(words) < 5 else {tuple(words[i:i + 5]) for i in range(len(words) - 4)})


def brute(rows):
    sets = [(d, sets_of(t)) for d, t in rows if d is not None]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    want = []
    for d, t in rows:
        c = None if d is None else find(d)
        want.append((d, len(sets_of(t)), c, d is None or c == d))
    return sorted(want, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int")
    return sorted((tuple(r) for r in neardup.near_duplicates(df).collect()), key=str)


def texts(seed, n_base=12):
    rng = random.Random(seed)
    vocab = [f"W{i}" if i % 7 == 0 else f"w{i}é" for i in range(400)]
    out = []
    for _ in range(n_base):
        base = rng.choices(vocab, k=rng.choice([3, 5, 30, 90, 200]))
        for _ in range(rng.choice([1, 2, 6])):
            words = list(base)
            for _ in range(rng.choice([0, 1, 2, 4])):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            out.append(" ".join(words))
    return out


def test_matches_brute_force(spark):
    rows = list(enumerate(texts(1) + ["", None, " \t\n", "one", "ONE", "a b c d", "a B c  d"], 100))
    rng = random.Random(2)
    rng.shuffle(rows)
    rows += [rows[0], (None, rows[1][1]), (5000, rows[2][1] + " "), (5000, rows[2][1])]
    assert run(spark, rows) == brute(rows)


def test_chain_is_found_past_the_hub(spark, monkeypatch):
    """A chain whose ends are not alike, in buckets split into small blocks."""
    monkeypatch.setattr(neardup, "BLOCK", 3)
    rng = random.Random(3)
    words = [f"t{i}" for i in range(120)]
    rows = []
    for step in range(10):
        rows.append((step * 7 % 10, " ".join(words)))
        at = rng.randrange(len(words))
        words = list(words)
        words[at] = f"new{step}"
        words[(at + 40) % 120] = f"other{step}"
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_components_of_a_path(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(5, 5), (100, 90), (90, 100)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 100: 90}


@pytest.mark.parametrize("kind", [neardup.ROUGH, neardup.FINE])
def test_sketch_bound_keeps_pairs_at_the_threshold(kind):
    rng = random.Random(4)
    kept = 0
    for _ in range(200):
        words = [str(rng.random()) for _ in range(704)]
        other = words[:604] + [str(rng.random()) for _ in range(100)]  # similarity 0.75
        x, y = (neardup._fold(neardup._samples(neardup.shingles(" ".join(w)), kind[0]), kind[1]).view("uint64")
                for w in (words, other))
        kept += bool(neardup.similar_enough(neardup.np.bitwise_count(x ^ y).sum(), 0.75, kind))
    assert kept == 200


def test_an_id_with_several_texts_is_one_document(spark):
    t, u, v = ("alpha beta gamma delta epsilon", "one two three four five six", "red green blue black white")
    rows = [(5, t), (9, t), (9, u), (11, u), (11, v), (20, v), (9, ""), (30, "lone words that match nothing else"),
            (31, "x y"), (31, None), (40, ""), (40, "p q r s t")]
    got = run(spark, rows)
    assert got == brute(rows)
    assert {r[2] for r in got if r[0] in (5, 9, 11, 20)} == {5}


def test_repeated_ids_against_brute_force(spark):
    rng = random.Random(8)
    rows = [(rng.randrange(20), t) for t in texts(9, 14)]
    assert run(spark, rows) == brute(rows)
