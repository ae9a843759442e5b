import hashlib
import random
import zlib

from fleetbook.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, name string"


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in convs.items()}
    made = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = tuple(convs.get(c - c % 100, [])[:h] + own[h:])
    members, ends = {}, {}
    for c in sorted(made):
        for d in range(len(made[c]) + 1):
            members.setdefault(made[c][:d], []).append(c)
        ends.setdefault(made[c], []).append(str(c))
    children = {}
    for n in members:
        if n:
            children.setdefault(n[:-1], []).append(n)
    out = []
    for n, m in members.items():
        todo, leaves, saved = [n], 0, 0
        while todo:
            x = todo.pop()
            todo += children.get(x, [])
            leaves += x not in children
            saved += (len(members[x]) - 1) * len(x[-1][1]) if x else 0
        out.append((m[0], len(n), members[n[:-1]][0] if n else None, len(m), len(children.get(n, [])), leaves, saved,
                    hashlib.sha256(",".join(ends.get(n, [])).encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in trie.prefix_trie(df).collect()), key=repr)


def talk(rng, c, n, words):
    return [(c, t, rng.choice(["user", "assistant"]), " ".join(rng.choice("ab") for _ in range(words)))
            for t in range(n)]


def test_shared_openings_against_brute_force(spark):
    rng = random.Random(3)
    rows = [x for c in [*range(0, 130), *range(200, 260), 305, 406]
            for x in talk(rng, c, rng.randint(1, 9), rng.randint(0, 1))]
    rng.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_copies_and_long_conversations(spark):
    long = [(7, t, "user", f"turn {t % 5}") for t in range(70)]
    rows = long + [(107, *r[1:]) for r in long[:33]] + [(c, t, "user", "same") for c in range(500, 560) for t in range(4)]
    assert run(spark, rows) == brute(rows)


def test_a_conversation_over_several_partitions(spark):
    rows = [(5, t, "user", f"x{t % 3}") for t in range(3000)] + [(1, 0, "user", "a"), (9, 0, "user", "b")]
    got = {(r[0], r[1]): r for r in run(spark, rows)}
    turns = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    pos = trie.numbered(turns, "conv_id", "turn", "role", "text").where("conv = 5").select("pos").collect()
    assert sorted(p[0] for p in pos) == list(range(3000))
    h = zlib.crc32(b"5") % 6  # conversation 0 is not there
    assert max(d for c, d in got if c == 5) == 3000 - h


def test_nulls_ties_and_repeats(spark):
    rows = [(3, None, None, None), (3, 1, "user", None), (3, 1, "user", None), (3, 1, "a", "é\U0001f600"),
            (None, 0, "user", "lost"), (0, 0, "user", "x" * 5000), (0, None, "user", ""), (-7, 0, "user", "n"),
            (4, 0, "user", "one"), (104, 0, "user", "one"), (101, 0, "", ""), (101, 1, "", "")]
    assert run(spark, [r for r in rows if r[0] != -7]) == brute([r for r in rows if r[0] != -7])
    assert run(spark, rows)


def test_empty(spark):
    assert run(spark, []) == []


def test_turnless_conversations_end_at_the_root(spark):
    short = [c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 >= 2]
    rows = [(c, 0, "user", "hi") for c in short]
    got = run(spark, rows)
    assert got == brute(rows)
    assert len(got) == 1 and got[0][3] == len(short)
