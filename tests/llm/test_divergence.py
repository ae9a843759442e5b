import random
import re

from fleetbook.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, value int"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}
ONE = 10**9


def brute(rows, min_docs=3, top=200):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df, total = {}, {}
        for _, _, words in mine:
            for w in set(words):
                df[w] = df.get(w, 0) + 1
            for w in words:
                total[w] = total.get(w, 0) + 1
        kept = sorted(w for w in df if df[w] >= min_docs)
        counts = {}
        for _, source, words in mine:
            group = counts.setdefault(source, dict.fromkeys(kept, 0))
            for w in words:
                if w in group:
                    group[w] += 1

        def p(held):
            n = sum(held.values()) + len(kept)
            return {w: 1 + ONE * (held[w] + 1) // n for w in kept}

        def f(a, b):
            return (a - b) ** 2 // b

        ps, q = {s: p(g) for s, g in counts.items()}, p({w: total[w] for w in kept})
        for s in ps:
            pair = [(-sum(f(ps[s][w], ps[o][w]) for w in kept), o.encode(), o) for o in ps if o != s]
            term = [(-f(ps[s][w], q[w]), w.encode(), w) for w in kept if counts[s][w] and ps[s][w] > q[w]]
            for part, items in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
                out += [(lang, s, part, item, -v, r) for r, (v, _, item) in enumerate(items, 1)]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    return sorted(tuple(r) for r in divergence.source_divergence(df, **kw).collect())


def corpus(n, seed):
    rng = random.Random(seed)
    words = ["the", "The", "éa", "Éa", "x", "zz", "日本", "\U0001f600b", "ß", "ﬀ", "q"] + [f"w{a}{b}" for a in "abcd" for b in "efgh"]
    return [(i, rng.choice([" ", "\n", "-1_", "\x7f"]).join(rng.choices(words, k=rng.randint(0, 40))),
             rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c", None, "É"])) for i in range(n)]


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(divergence, "FLUSH_TERMS", 7)
    monkeypatch.setattr(divergence, "WINDOW_BYTES", 11)
    rows = corpus(120, 1)
    assert run(spark, rows) == brute(rows)


def test_few_ranks_and_ties(spark):
    rows = [(i, " ".join(f"{a}{b}" for a in "abcdefgh" for b in "xyz") + " own" * (i % 2), "en", "ab"[i % 2]) for i in range(8)]
    rows += corpus(60, 2)
    for top in (1, 5, 30):
        assert run(spark, rows, top=top) == brute(rows, top=top)


def test_no_kept_terms_nulls_and_empty(spark):
    rows = [(1, None, None, None), (2, "once", "", "b"), (3, "", "de", "a"), (None, "12 _-", "de", "b"), (4, "alone", "it", "a")]
    got = run(spark, rows)
    assert got == brute(rows)
    assert all(r[4] == 0 for r in got)
    assert run(spark, []) == []


def test_repeated_rows_count_each_and_long_texts(spark):
    rows = [(1, "again B", "en", "a")] * 5 + [(2, "b " * 300_000 + "z" * 3_000_000, "en", "b"), (3, "B", "en", "b")]
    assert run(spark, rows) == brute(rows)


def test_large_counts_are_exact(spark):
    from pyspark.sql import functions as F

    n, total = 987_654_321_012, 123_456_789_012_345
    df = spark.createDataFrame([(n, total, 77)], "n long, total long, kept long")
    assert df.select(divergence._p(F.col("n"), F.col("total"), F.col("kept"))).first()[0] == 1 + ONE * (n + 1) // (total + 77)
