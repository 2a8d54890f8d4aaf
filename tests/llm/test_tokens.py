"""Token ids, packing and token files against plain brute force."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
from statflow.llm import packing, token_store
from statflow.llm.tokens import TextEncoder, default_tokenizer

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, piece string, length string"
ROWS = [(1, "Hello there", "a", "x", "y"), (1, "Hello there", "a", "x", "y"),
        (None, None, None, None, None), (2, "", "a", "", ""), (3, "  \n ", "b", "", ""),
        (4, "word " * 6000, "b", "", ""), (5, "naïve — “quoted” 12's\tx  y", "c", "", "")]


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(default_tokenizer())
    t.encode_special_tokens = True
    return t


def plain(tok, text, end):
    return tok.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_ids_equal_whole_text_encoding(tok):
    rng = random.Random(7)
    letters = "ab'sZ  \n\t 　é“,.$12\x85\x1f中Á<|"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
             for _ in range(4000)] + ["<|endoftext|> x", "", "it's we'll 'S", "x" * 5000]
    enc = TextEncoder(default_tokenizer(), limit=3000, piece=500)
    ids, bounds = enc.encode(texts)
    for i, t in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == plain(tok, t, 0)[:-1], repr(t)


def check_packing(rows, want, capacity):
    """Every piece once, bins contiguous from 0 and within capacity."""
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["piece"], r["start"],
                  r["length"], r["ids_crc32"]) for r in rows)
    assert got == sorted(want)
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def pieces_of(tok, rows, capacity, end=0):
    for doc_id, text in rows:
        ids = plain(tok, text, end)
        cuts = list(range(len(ids) % capacity, len(ids) + 1, capacity))
        cuts = ([0] if cuts[0] else []) + cuts
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            yield (-1 if doc_id is None else doc_id, k, a, b - a, crc(ids[a:b]))


def test_pack_small_and_odd_rows(spark, tok):
    df = spark.createDataFrame(ROWS, DOCS)
    rows = packing.pack_documents(df, default_tokenizer(), 64).collect()
    check_packing(rows, list(pieces_of(tok, [(r[0], r[1]) for r in ROWS], 64)), 64)
    full = packing.pack_documents(df, default_tokenizer(), 64, with_ids=True).collect()
    assert all(len(r["ids"]) == r["length"] and crc(r["ids"]) == r["ids_crc32"] for r in full)
    assert packing.pack_documents(df.limit(0), default_tokenizer()).count() == 0


def test_op7_against_brute_force(spark, tok):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = entry.queries()["op7_best_two_fit"](spark, SF).collect()
    want = list(pieces_of(tok, [(r["doc_id"], r["text"]) for r in docs], 2048))
    bins = check_packing(rows, want, 2048)
    assert bins <= 1 + 1.02 * sum(w[3] for w in want) / 2048 + 2


def test_plan_replaces_the_smallest_piece():
    # Greedy fills 10 with 6 + 3; two unpacked pieces 2 + 2 fit the gap of 4 exactly.
    counts = [0] * 11
    counts[6], counts[3], counts[2] = 1, 1, 2
    bins = packing.plan_bins(counts, 10)
    assert bins == [([6, 2, 2], 1), ([3], 1)]


@pytest.mark.parametrize("seed", range(5))
def test_plan_packs_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    counts = np.r_[0, rng.integers(0, 40, 100)]
    bins = packing.plan_bins(counts, 100)
    used = np.zeros(101, int)
    for lengths, times in bins:
        assert sum(lengths) <= 100
        for x in lengths:
            used[x] += times
    assert used.tolist() == counts.tolist()
    gaps = []  # best fit, longest first
    for x in np.repeat(np.arange(101), counts)[::-1].tolist():
        fits = [(g, i) for i, g in enumerate(gaps) if g >= x]
        if fits:
            gaps[min(fits)[1]] -= x
        else:
            gaps.append(100 - x)
    assert sum(t for _, t in bins) <= 1.01 * len(gaps) + 1


def test_bad_lengths_are_refused(spark):
    with pytest.raises(ValueError):
        packing.best_two_fit(spark.createDataFrame([(None,)], "n long"), "n", 8)


def brute_store(tok, rows):
    at, out = 0, []
    key = lambda r: (r[0] is not None, r[0] or 0)
    for doc_id, text in sorted(rows, key=key):
        ids = plain(tok, text, 2)
        out.append((doc_id, at, len(ids), crc(ids)))
        at += len(ids)
    return out


def test_op10_against_brute_force(spark, tok):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = [tuple(r) for r in entry.queries()["op10_seekable_tokens"](spark, SF).collect()]
    want = brute_store(tok, [(r["doc_id"], r["text"]) for r in docs])
    assert sorted(got) == sorted(want)


def test_store_small_files_and_random_access(spark, tok):
    df = spark.createDataFrame(ROWS + [(9, f"doc {i}", "s", "", "") for i in range(30)], DOCS)
    manifest = token_store.write_token_files(df, default_tokenizer(), 2, file_text_bytes=4000)
    assert manifest.count() > 2
    got = token_store.read_token_files(manifest, with_ids=True).orderBy("start").collect()
    at = 0
    for r in got:
        assert r["start"] == at and crc(r["ids"]) == r["ids_crc32"]
        at += r["n_tokens"]
    want = brute_store(tok, [(r["doc_id"], r["text"]) for r in df.collect()])
    key = lambda x: (x[0] is not None, x[0] or 0, x[2], x[3])
    assert sorted([(r[0], 0, r[2], r[3]) for r in got], key=key) == \
        sorted([(w[0], 0, w[2], w[3]) for w in want], key=key)
    empty = token_store.write_token_files(df.limit(0), default_tokenizer(), 2)
    assert token_store.read_token_files(empty).count() == 0


def test_reader_touches_only_wanted_frames(tmp_path):
    w = token_store.TokenFileWriter(str(tmp_path), "a.tok", 50257, frame_bytes=100)
    docs = [np.arange(i, i + 40, dtype=np.uint32) for i in range(20)]
    for i, d in enumerate(docs):
        w.add(i, d)
    w.close()
    f = token_store.TokenFile(w.uri)
    assert len(f.frames) == 10
    assert [x.tolist() for x in f.read([19, 3])] == [docs[19].tolist(), docs[3].tolist()]
    assert f.frames_read == 2
    data = bytearray((tmp_path / "a.tok").read_bytes())
    data[int(f.frames[1][0]) + 9] ^= 1  # damage frame 1 only
    (tmp_path / "a.tok").write_bytes(bytes(data))
    g = token_store.TokenFile(w.uri)
    assert g.read([0])[0].tolist() == docs[0].tolist()
    with pytest.raises(ValueError):
        g.read([3])
