import hashlib
import re
from collections import defaultdict

from fleetbook.llm import lines


def key_of(line):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), line)
    return low.strip(" \t\n\x0b\x0c\r")


def brute(rows, min_docs, min_chars):
    docs = defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key_of(x)) >= min_chars:
                docs[key_of(x)].add(d)
    out = []
    for d, t in rows:
        all_ = (t or "").split("\n")
        kept = [x for x in all_ if len(docs[key_of(x)]) < min_docs]
        out.append((d, len(all_), len(all_) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, min_docs, min_chars):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(*r, "x", 9) for r in rows], "doc_id long, text string, pos string, n_lines int")
    out = lines.drop_shared_lines(df, min_docs, min_chars)
    return sorted((tuple(r) for r in out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256)).collect()), key=str)


def test_matches_brute_force(spark):
    rows = [(i, f"own {i}\n  Shared É line\t\n\nshared É LINE\nlast{i % 3}") for i in range(6)]
    rows += [(6, "shared é line"), (7, ""), (8, None), (9, "\n\n"), (10, "a\r\nShared É line"), (11, " own 1 ")]
    rows += [rows[0], (0, "shared É line\nother"), (None, "shared É line\nx"), (None, "y")]
    rows += [(20, "\n".join(f"own {i % 7}" for i in range(20000)))]
    for min_docs, min_chars in ((3, 1), (2, 1), (8, 1), (2, 6), (2, 0)):
        assert run(spark, rows, min_docs, min_chars) == brute(rows, min_docs, min_chars)


def test_empty_table(spark):
    assert run(spark, [], 2, 1) == []
