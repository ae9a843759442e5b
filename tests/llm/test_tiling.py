"""Greedy string tiling against a plain longest-first tiling."""

import random
import re

from fleetbook.llm import tiling


def plain_tiles(pattern, runs, least):
    """Longest-first tiling by comparing every position with every other."""
    text = [w for run in runs for w in [*run, None]]
    p_used, t_used, out = set(), set(), []
    while True:
        best = (0, 0, 0)
        for p in range(len(pattern)):
            for t in range(len(text)):
                n = 0
                while (p + n < len(pattern) and t + n < len(text) and pattern[p + n] == text[t + n]
                       and p + n not in p_used and t + n not in t_used):
                    n += 1
                if n > best[0]:
                    best = (n, p, t)
        if best[0] < least:
            return out
        n, p, t = best
        p_used.update(range(p, p + n))
        t_used.update(range(t, t + n))
        out.append(best)


def test_tiles_match_plain_tiling():
    rng = random.Random(5)
    for _ in range(150):
        vocab = [f"w{i}" for i in range(rng.choice([2, 6, 40]))]
        pattern = rng.choices(vocab, k=rng.randrange(1, 30))
        runs = [rng.choices(vocab, k=rng.randrange(1, 25)) for _ in range(rng.randrange(4))]
        runs += [pattern[i:i + rng.randrange(1, 12)] for i in (rng.randrange(len(pattern)),)]
        assert tiling.tiles(pattern, runs, 3) == plain_tiles(pattern, runs, 3)


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute(docs, items, least, percent):
    texts = {}
    for d, t in docs:
        if d is not None:
            texts.setdefault(d, set()).add(t)
    out = set()
    for i, t in set(items):
        pattern = words(t)
        size = min(least, len(pattern))
        for d, versions in texts.items():
            if size:
                got = plain_tiles(pattern, [words(v) for v in sorted(versions, key=str)], size)
                covered = sum(n for n, _, _ in got)
                if covered and 100 * covered >= percent * len(pattern):
                    out.add((d, i, len(pattern), covered))
    return sorted(out, key=str)


def run(spark, docs, items):
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, item long, words string")
    b = spark.createDataFrame([(*r, "y") for r in items], "item_id long, text string, doc string")
    got = tiling.contaminated(d, b, 4, 50).collect()
    return sorted(((r.doc_id, r.item_id, r.item_words, r.covered) for r in got), key=str)


def test_matches_brute_force(spark):
    rng = random.Random(6)
    vocab = [f"word{i}" for i in range(50)] + ["É", "der"]

    def prose(n):
        return [rng.choice(vocab) for _ in range(n)]

    items = [(i, " ".join(prose(n))) for i, n in enumerate([20, 31, 45, 8, 4, 3, 1])]
    items += [(50, None), (51, " ,. "), (None, "null item of six words here"), items[0], (52, items[1][1])]
    docs = [(i, " ".join(prose(60))) for i in range(10)]
    for i, t in items[:5]:
        w = t.split()
        h = len(w) // 2
        docs.append((100 + i, " ".join(prose(9) + w + prose(9))))
        docs.append((200 + i, " ".join(prose(5) + w[h:] + prose(20) + w[:h])))  # reordered
        docs.append((300 + i, " ".join(prose(5) + w[:h - 1] + prose(5))))
        docs.append((400 + i, ", ".join(x.upper() for x in w) + "!"))
    docs += [(600, ""), (601, None), (602, "null item, of six WORDS here."), (None, items[0][1]),
             (603, items[0][1]), (603, items[0][1]), (604, items[2][1][:100]), (604, items[2][1][100:]),
             (605, " ".join(prose(3000) + items[1][1].split() * 3))]
    assert run(spark, docs, items) == brute(docs, items, 4, 50)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b c d e")]) == []
    assert run(spark, [(1, "a b c d e")], []) == []


def test_a_run_that_all_documents_hold_makes_no_pairs(spark, monkeypatch):
    rng = random.Random(7)
    common = "this run of words is everywhere"
    items = [(i, f"{common} " + " ".join(f"i{i}w{j}" for j in range(14))) for i in range(12)]
    items.append((90, common))  # an item of nothing else is in all of them
    docs = [(i, " ".join(rng.choice("abcdefgh") for _ in range(20)) + f" {common} end") for i in range(50)]
    docs += [(100 + i, " ".join(t.split()[6:]) + f" and {common}") for i, t in items[:4]]
    docs += [(200, " ".join(items[5][1].split()[10:17])), (201, items[6][1])]
    seen, write = {}, tiling.written
    monkeypatch.setattr(tiling, "written", lambda df, name: seen.setdefault(name, write(df, name)))
    assert run(spark, docs, items) == brute(docs, items, 4, 50)
    pairs = {tuple(r) for r in seen["near-items"].collect()}
    assert len(pairs) <= 55 + 5 + 4


def test_the_bitmap_grows_with_the_seeds(spark, monkeypatch):
    monkeypatch.setattr(tiling, "BITMAP_LOG2", (6, 27))
    seeds = spark.range(1000).selectExpr("xxhash64(id) as seed")
    k, bitmap = tiling._bitmap(seeds)
    assert k == 14 and len(bitmap) == (1 << 14) // 64
    have = tiling.np.unpackbits(bitmap.view("uint8"), bitorder="little")
    at = [(r.seed & (1 << 64) - 1) >> 50 for r in seeds.collect()]
    assert have[at].all() and have.sum() == len(set(at))
