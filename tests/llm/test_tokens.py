"""Token counts and token-ID shards against the library on whole texts."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from fleetbook.llm import counts, wavelet
from fleetbook.llm.encoding import KEY_BYTES, Encoder, Slots
from fleetbook.llm.queries import BYTE_BPE, tokenizer_path
from fleetbook.session import scratch_path

TEXTS = [
    "Plain words here.", "", None, "a  b\n\n c\td ", "x <|endoftext|> y", "é ü don't 'll 　 \x1c z",
    "word " * 5000, "q" * 9000, "Plain words here.", " lead", "trail ", "\u0085 a \u0085",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(0, "again", "x"), (None, "no id", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")


def ids_of(text):
    return Tokenizer.from_file(tokenizer_path(BYTE_BPE)).encode(text or "", add_special_tokens=False).ids


def test_counts_match_library(docs):
    got = sorted(tuple(r) for r in counts.token_counts(docs, tokenizer_path(BYTE_BPE), chunk_bytes=64)
                 .na.fill(-1, ["doc_id"]).collect())
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    want = sorted((-1 if d is None else d, len(t.encode()), len(ids_of(t)), len(ids_of(t)) > 512) for d, t in rows)
    assert got == want


def test_sentencepiece_counts(docs):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    got = sorted((r.n_bytes, r.n_tokens) for r in counts.token_counts(docs, path).collect())
    assert got == sorted((len((r.text or "").encode()), len(sp.encode(r.text or ""))) for r in docs.collect())


def test_empty_table(spark, docs):
    none = docs.where("false")
    assert counts.token_counts(none, tokenizer_path(BYTE_BPE)).count() == 0
    path = scratch_path(spark, "test-shards")
    wavelet.write_shards(none, path, tokenizer_path(BYTE_BPE))
    assert wavelet.read_documents(spark, path).count() == 0


@pytest.mark.parametrize("shard_tokens", [40, 1 << 20])
def test_shards_round_trip(spark, docs, shard_tokens):
    path = scratch_path(spark, "test-shards")
    wavelet.write_shards(docs, path, tokenizer_path(BYTE_BPE), shard_tokens=shard_tokens)
    rows = sorted(((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in docs.collect()))
    want, start = [], 0
    for doc, text in rows:
        ids = np.array([*ids_of(text), 2], "<u4")
        want.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.start, r.n_tokens, r.ids_crc32)
                 for r in wavelet.read_documents(spark, path).collect())
    assert got == sorted(want)


@pytest.mark.parametrize("shard_tokens", [40, 1 << 20])
def test_lookups_over_shards(spark, docs, shard_tokens):
    path = scratch_path(spark, "test-shards")
    wavelet.write_shards(docs, path, tokenizer_path(BYTE_BPE), shard_tokens=shard_tokens)
    rows = sorted(((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in docs.collect()))
    every, where = [], []
    for doc, text in rows:
        for offset, token in enumerate([*ids_of(text), 2]):
            where.append((token, None if doc < 0 else doc, offset, len(every)))
            every.append(token)
    asked = [2, every[3], every[len(every) // 2], 49_999, 1 << 20]
    got = sorted((tuple(r) for r in wavelet.occurrences(spark, path, asked).collect()), key=str)
    assert got == sorted((w for w in where if w[0] in asked), key=str)
    for lo, hi in ((0, None), (7, 61), (5000, 5001), (10**9, None)):
        n = {r.token: r.n for r in wavelet.token_frequencies(spark, path, asked, lo, hi).collect()}
        assert n == {t: every[lo:hi].count(t) for t in asked}
    at = [0, 1, len(every) - 1, len(every), len(every) // 3, 10**9]
    got = {r.position: r.token for r in wavelet.tokens_at(spark, path, at).collect()}
    assert got == {p: every[p] for p in at if p < len(every)}


def test_a_lookup_opens_few_chunks():
    ids = np.random.default_rng(5).integers(0, 50_000, 1 << 20).astype("<u4")
    data = wavelet.pack([1], [len(ids)], ids, 16)
    for use in (lambda wm: wm.access(700_000), lambda wm: wm.count(int(ids[5])), lambda wm: wm.select(int(ids[5]), 0)):
        wm = wavelet.unpack(data)[2]
        assert not any(p.open for p in wm.planes)
        use(wm)
        assert sum(len(p.open) for p in wm.planes) <= 3 * 16 < sum(len(p.chunks) for p in wm.planes)
    assert wm.select(int(ids[5]), 0) == np.flatnonzero(ids == ids[5])[0]


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 3000, 300_000])
def test_wavelet_rank_select(n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, 40, n).astype("<u4") * 1201
    docs, lengths, wm = wavelet.unpack(wavelet.pack([7, None], [n, 0], ids, 16))
    assert docs == [7, None] and lengths.tolist() == [n, 0]
    assert wm.to_ids().tolist() == ids.tolist()
    for v in {*ids[:5].tolist(), 3}:
        at = np.flatnonzero(ids == v)
        if n <= 3000:
            assert wm.occurrences(v) == at.tolist()
        assert [wm.select(v, k) for k in range(0, len(at), 999)] == at[::999].tolist()
        assert wm.count(v, n // 3, n) == (at >= n // 3).sum()
    for i in range(0, n, max(97, n // 200)):
        assert wm.access(i) == ids[i]
    with pytest.raises(IndexError):
        wm.select(3, 0)


AWKWARD = ["word", "the", "É", "×", "÷", "ž", "Ж", "ѿ", "Ҁ", "中", "　", "\u2003", "\u0085", "\u1680", "\u200b", "“", "—",
           "«", "°", "½", "١", "e\u0301", "😀", "\x00", "\x1c", "\t", "\r", "\n", "\n\n", " ", "  ", ".", ",", ":", "!", ")",
           "'", "'s", "'S", "<|endoftext|>", "<|", "|>", "7", "3.5", "_", "Ġ", "Ċ", "q" * 20, "ab" * 9, "ª", "\xa0"]


@pytest.mark.parametrize("memo", [{}, {"memo_entries": 0}, {"memo_entries": 40}, {"memo_bytes": 4}])
def test_awkward_texts_match_library(memo):
    path, rng = tokenizer_path(BYTE_BPE), random.Random(7)
    library = Tokenizer.from_file(path)
    ids, n = Encoder(path, ids=True, **memo), Encoder(path, ids=False, **memo)

    def word():
        return "".join(rng.choices("abcdeéñжя", k=rng.randint(1, 2 * KEY_BYTES)))

    def text():
        return "".join(rng.choice([rng.choice(AWKWARD), " ", "\n", ". ", " " + word()]) for _ in range(rng.choice([0, 1, 3, 80])))

    assert ids([]) == n([]) == []
    for _ in range(30):
        texts = [text() for _ in range(rng.choice([1, 40]))]
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(x, "<u4").tolist() for x in ids(texts)] == want
        assert n(texts) == [len(x) for x in want]
    if "memo_entries" in memo:
        assert ids.held == memo["memo_entries"] == ids.words.n + len(ids.longer)


def test_slots_of_crowded_keys():
    rng, slots = np.random.default_rng(3), Slots(bits=4)
    keys = np.unique(rng.integers(0, 60, (4000, 2)).astype(np.uint64), axis=0) + np.array([0, 1], np.uint64)
    rng.shuffle(keys)
    low, high = keys.T.copy()
    for lo, hi in ((0, 1), (1, 1000), (1000, 1500)):
        assert (slots.find(low[lo:], high[lo:]) == -1).all()
        slots.add(low[lo:hi], high[lo:hi], np.arange(lo, hi))
        assert slots.find(low[:hi], high[:hi]).tolist() == list(range(hi))


def test_words_skip_the_splitting_and_are_looked_up_once():
    """New words of letters alone do not go through the library's splitting,
    and a batch asks the memo once for each distinct piece."""
    rng = random.Random(11)
    words = ["".join(rng.choices("etaoinshré", k=rng.randint(2, 12))) for _ in range(2_000)]
    texts = [" ".join(rng.choices(words, k=500)) + "." for _ in range(60)]
    encode = Encoder(tokenizer_path(BYTE_BPE), ids=True)
    library, find, asked, sought = encode.library, encode.words.find, [], []
    encode.library = lambda pieces: asked.extend(pieces) or library(pieces)
    encode.words.find = lambda low, high: sought.append(len(low)) or find(low, high)
    got = encode(texts)
    assert sum(map(len, asked)) < 100
    assert sum(sought) <= 2 * len(set(words)) + 1 < 60 * 500
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == library(texts)
