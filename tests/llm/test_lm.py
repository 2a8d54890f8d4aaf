"""The backoff automaton against counting by hand, and language ID on held-out rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
from statflow.llm import language, ngram_lm

SF = "/root/testdata/sf0.001"


def brute_lm(rows, a, b, order=2):
    def tokens(t):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x20\x09-\x0D]+", low) + ["</s>"]

    grams, follow = Counter(), Counter()  # n-grams and how often a history is followed
    fold = [zlib.crc32((b"" if i is None else str(i).encode())) % 7 == 2 for i, _ in rows]
    for (_, t), held in zip(rows, fold):
        if not held:
            w = tokens(t)
            line = ["</s>"] + w
            for k in range(1, order + 1):
                for i in range(1, len(line)):
                    if i - k + 1 >= 0:
                        grams[tuple(line[i - k + 1:i + 1])] += 1
                        follow[tuple(line[i - k + 1:i])] += 1
    uni = Counter({g[0]: c for g, c in grams.items() if len(g) == 1})
    n, v = sum(uni.values()), len(uni)

    def prob(h, x):
        if not h:
            return (uni[x] + 1) / (n + v + 1)
        seen = follow[h]
        m = a * seen ** b if seen else 1
        return ((grams[h + (x,)] if seen else 0) + m * prob(h[1:], x)) / (seen + m)

    out = []
    for (i, t), held in zip(rows, fold):
        w, score, base = tokens(t), 0.0, 0.0
        line = ["</s>"] + w
        for k, x in enumerate(w):
            base += math.log10(prob((), x))
            score += math.log10(prob(tuple(line[max(0, k + 2 - order):k + 1]), x))
        out.append((i, held, len(w), sum(uni[x] > 0 for x in w), n, base, score))
    return out


def same(got, want):
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[5])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9)


def test_op3_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = entry.queries()["op3_backoff_lm"](spark, SF).collect()
    a, b = rows[0]["mass_a"], rows[0]["mass_b"]
    same([tuple(r)[:7] for r in rows], brute_lm(docs, a, b, order=3))
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_lm_many_blocks_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(ngram_lm, "BLOCK_BYTES", 300)
    rng = np.random.default_rng(0)
    docs = [(i, " ".join(rng.choice(["a", "B", "cc", "é", "x1"], rng.integers(0, 30)))) for i in range(120)]
    docs += [(None, None), (7, "a  b\tc\n"), (7, "a  b\tc\n"), (200, "z " * 4000), (201, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(ngram_lm, "LANE_TOKENS", 50)
    for order in (2, 3, 4):
        rows = ngram_lm.score_documents(df, group_bytes=500, order=order).collect()
        same([tuple(r)[:7] for r in rows], brute_lm(docs, rows[0]["mass_a"], rows[0]["mass_b"], order))
    assert ngram_lm.score_documents(df.limit(0)).count() == 0


def small_block(seed=3, vocabulary=5):
    rng = np.random.default_rng(seed)
    size = rng.integers(0, 60, 40)
    bounds = np.r_[0, np.cumsum(size + 1)]
    words = np.sort(np.r_[rng.integers(1, 1 << 62, vocabulary).astype(np.uint64), ngram_lm._END])
    end = int(np.searchsorted(words, ngram_lm._END))
    word = rng.choice(np.delete(np.arange(vocabulary + 1), end), bounds[-1])
    word[bounds[1:] - 1] = end
    train = np.arange(40) % 7 != 2
    return ngram_lm.Block(np.arange(40), np.ones(40, bool), train, bounds, words, word)


def automaton(block, order, a, b):
    grams = block.grams()
    while grams.order < order:
        grams.extend()
    counts = [None] + [grams.counts(k, block.learn) for k in range(1, order + 1)]
    return ngram_lm.Automaton(grams, counts, int(counts[1].sum()), int((counts[1] > 0).sum()), a, b)


@pytest.mark.parametrize("order", [2, 3])
def test_each_state_sums_to_one(order):
    block = small_block()
    v = len(block.words)
    for a, b in ngram_lm.GRID:
        m = automaton(block, order, a, b)
        lower = {w: m.p[1][w] for w in range(v)}  # p(w | h), arc or failure, state by state
        table = {(): lower}
        for k in range(2, order + 1):
            # p of every word after every state: seen n-grams by their arcs, others by failure.
            states = {}
            for g in range(len(m.p[k])):
                states.setdefault(int(m.grams.prefix[k][g]), {})[g] = m.p[k][g]
            for h, arcs in states.items():
                if m.counts[k - 1][h] == 0:
                    continue
                shorter = lower if k == 2 else table[k - 1, int(m.grams.suffix[k - 1][h])]
                last = {g: int(m.grams.index[1][np.flatnonzero(m.grams.index[k] == g)[0]]) for g in arcs}
                own = {w: 10 ** m.fail[k - 1][h] * shorter[w] for w in range(v)}
                own.update({last[g]: p for g, p in arcs.items()})
                table[k, h] = own
                unknown = 10 ** m.fail[k - 1][h] * (1 / (m.tokens + m.distinct + 1) if k == 2 else
                                                   1 - sum(shorter.values()))
                assert abs(sum(own.values()) + unknown - 1) < 1e-9


@pytest.mark.parametrize("lane", [1, 3, 1024])
def test_the_walk_carries_the_longest_seen_history(lane):
    block = small_block(vocabulary=12)
    m = automaton(block, 3, 2.0, 0.8)
    depth, taken = ngram_lm.walk(m.grams, m.counts, lane)
    line = lambda d: [int(m.grams.end), *block.word[block.bounds[d]:block.bounds[d + 1]].tolist()]
    seen = {()}
    for d in np.flatnonzero(block.train):
        w = line(d)
        seen |= {tuple(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w)) if i + k <= len(w)}
    for d in range(40):
        w = line(d)
        for i in range(1, len(w)):
            longest = max(k for k in (0, 1, 2) if k <= i and tuple(w[i - k:i]) in seen)
            at = block.bounds[d] + i - 1
            assert depth[at] == longest
            arcs = [k for k in range(2, longest + 2) if tuple(w[i - k + 1:i + 1]) in seen]
            assert taken[at] == max(arcs, default=1)
    # The weights on the path add up to the interpolated probability.
    assert np.allclose(m.scores((depth, taken)), np.log10(m.grams.by_token(m.p)))
    assert {0, 1, 2} >= set(depth.tolist()) and {1, 2, 3} == set(taken.tolist())


def test_ngrams_no_other_block_can_hold_are_not_asked_for():
    block = small_block(vocabulary=12)
    grams = block.grams()
    grams.extend()
    grams.extend()
    shared = np.zeros(len(grams.hashes[2]), bool)
    assert len(ngram_lm._open(3, grams, [None, None, shared])) == 0  # this block is the corpus
    shared[[grams.prefix[3][0], grams.suffix[3][0]]] = True
    asked = ngram_lm._open(3, grams, [None, None, shared])
    assert 0 in asked and len(asked) < len(grams.hashes[3])
    kept = ngram_lm.Block.load(memoryview(block.dump()))
    for name in ("doc_ids", "valid", "train", "bounds", "words", "word"):
        assert (getattr(kept, name) == getattr(block, name)).all()


def test_op9_accuracy_on_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = entry.queries()["op9_language_mixture"](spark, sf).collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(lang)
    held = [r for r in rows if r["held_out"] and lang[r["doc_id"]] is not None]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def brute_language(counts, probs, penalty, rounds=12):
    """One document by loops over all sizes of its language set, without any bound:
    (index of the language, proportion, languages in the set)."""
    n_lang = probs.shape[1]

    def fit(pi):
        total = sum(counts.values())
        for _ in range(rounds):
            new = [0.0] * n_lang
            for b, c in counts.items():
                z = sum(probs[b, l] * pi[l] for l in range(n_lang))
                for l in range(n_lang):
                    new[l] += c * probs[b, l] * pi[l] / max(z, 1e-300)
            pi = [x / total for x in new]
        return pi, sum(c * math.log(max(sum(probs[b, l] * pi[l] for l in range(n_lang)), 1e-300))
                       for b, c in counts.items())

    single = [sum(c * math.log(probs[b, l]) for b, c in counts.items()) for l in range(n_lang)]
    best = max(range(n_lang), key=single.__getitem__)
    found, top = (best, 1.0, 1), single[best]
    cost = penalty * math.log(max(sum(counts.values()), 2))
    pi, _ = fit([1 / n_lang] * n_lang)
    order = sorted(range(n_lang), key=lambda l: -pi[l])
    for k in range(2, n_lang + 1):
        start = [pi[l] + 1e-6 if l in order[:k] else 0.0 for l in range(n_lang)]
        share, score = fit([x / sum(start) for x in start])
        if score - (k - 1) * cost > top:
            top, found = score - (k - 1) * cost, (share.index(max(share)), max(share), k)
    return found


def test_op9_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    # Texts in two languages are among those predicted.
    mixed = [(10_000 + i, (a["text"] or "")[:300] + " " + (b["text"] or "")[:300], None)
             for i, (a, b) in enumerate(zip(docs[:20], docs[20:40]))]
    rows = [tuple(r) for r in docs] + mixed
    got = {r["doc_id"]: r for r in language.identify(
        spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}

    def grams(text):
        raw = np.frombuffer(f" {text.lower()} ".encode(), np.uint8)
        _, bucket, count = language.gram_counts(raw, np.array([0, len(raw)]))
        return dict(zip(bucket.tolist(), count.tolist()))

    learned = {}
    for i, text, lang in rows:
        if lang is not None and text is not None and zlib.crc32(str(i).encode()) % 5:
            into = learned.setdefault(lang, Counter())
            for b, c in grams(text).items():
                into[b] += c
    languages = sorted(learned)
    probs = np.array([[learned[l][b] + 0.5 for l in languages] for b in range(language.BUCKETS)])
    probs /= probs.sum(0)
    sizes = set()
    for i, text, _ in [*rows[::7], *mixed]:
        r = got[i]
        if not any(c.isalpha() for c in text or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        best, share, size = brute_language(grams(text), probs, language.PENALTY)
        assert r["lang_pred"] == languages[best] and r["n_langs"] == size
        assert r["score"] == pytest.approx(share, abs=1e-9)
        sizes.add(size)
    assert {1, 2} <= sizes


def test_language_odd_rows(spark):
    rows = [(i, t, l, "x") for i, (t, l) in enumerate(
        [("the cat and the dog of the house", "en"), ("le chat et le chien de la maison", "fr")] * 40)]
    rows += [(None, None, None, None), (500, "", "en", ""), (501, "123 --- ...", "fr", ""),
             (502, "the dog and the cat", None, ""), (502, "the dog and the cat", None, ""),
             (503, "le chien et le chat " * 9000, None, ""), (504, "x", None, ""),
             (505, "the cat and the dog of the house " * 30 + "le chat et le chien de la maison " * 25, None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_set string")
    got = {(r["doc_id"]): r for r in language.identify(df).collect()}
    assert language.identify(df).count() == len(rows)
    assert [got[i]["lang_pred"] for i in (None, 500, 501)] == ["und"] * 3
    assert [got[i]["score"] for i in (None, 500, 501)] == [0.0] * 3
    assert got[502]["lang_pred"] == "en" and got[503]["lang_pred"] == "fr"
    assert got[504]["lang_pred"] in ("en", "fr")
    assert got[505]["lang_pred"] == "en" and got[505]["n_langs"] == 2 and 0.5 < got[505]["score"] < 0.65
    none = language.identify(df.selectExpr("doc_id", "text", "cast(null as string) as lang"))
    assert {r["lang_pred"] for r in none.collect()} == {"und"}
    assert language.identify(df.limit(0)).count() == 0


def test_no_em_is_needed_where_the_slope_is_below_the_penalty():
    rng = np.random.default_rng(4)
    probs = rng.dirichlet(np.ones(50), 3).T
    probs = np.vstack([probs, np.full((language.BUCKETS - 50, 3), 1e-9)])
    row = np.repeat(np.arange(30), 50)
    count = np.concatenate([rng.multinomial(400, probs[:50, k % 3] / probs[:50, k % 3].sum()) for k in range(30)])
    keep = count > 0
    args = (row[keep], np.tile(np.arange(50), 30)[keep], count[keep], 30, probs)
    best, share, size = language.infer(*args, penalty=5.0)
    assert best.tolist() == [k % 3 for k in range(30)] and (size == 1).all()


def test_a_set_of_three_is_found_whatever_texts_share_the_piece():
    # Languages a, b, c use 20 n-grams each; x spreads over all 60 and is the best single one.
    probs = np.full((60, 4), 1e-7)
    for k in range(3):
        probs[20 * k:20 * k + 20, k] = 1 / 20
    probs[:, 3] = 1 / 70
    probs = np.vstack([probs, np.full((language.BUCKETS - 60, 4), 1e-9)])
    three = np.full(60, 30)                      # two languages of a, b, c are worse than x
    two = np.r_[np.full(40, 30), np.zeros(20, int)]
    one = np.r_[np.full(20, 30), np.zeros(40, int)]

    def infer(*texts):
        row, bucket = np.nonzero(np.stack(texts))
        return [x.tolist() for x in language.infer(row, bucket, np.stack(texts)[row, bucket],
                                                   len(texts), probs, penalty=5.0)]

    alone = infer(three)
    assert alone[2] == [3] and abs(alone[1][0] - 1 / 3) < 0.05
    best, share, size = infer(one, three, two)
    assert size == [1, 3, 2]
    assert (best[1], share[1]) == (alone[0][0], alone[1][0])


def test_every_labelled_row_is_learned(spark):
    # A common text makes up a third of the rows, thirty languages have one row each.
    rare = spark.range(30).selectExpr("concat('rare ', repeat(char(97 + id % 26), 4)) as text",
                                      "concat('r', id) as lang")
    many = spark.range(120_000).selectExpr(
        "if(id % 3 = 0, 'the cat', concat('dog ', char(97 + id % 26))) as text", "'en' as lang")
    languages, probs = language.learn(rare.union(many), "text", "lang")
    assert languages == sorted(["en", *[f"r{i}" for i in range(30)]])
    # Exact counts: ' the cat ' has seven n-grams, ' dog x ' has five.
    total = 40_000 * 7 + 80_000 * 5
    raw, bounds = np.frombuffer(b"the", np.uint8), np.array([0, 3])
    _, bucket, _ = language.gram_counts(raw, bounds)
    want = (40_000 + 0.5) / (total + 0.5 * language.BUCKETS)
    assert abs(probs[bucket[0], languages.index("en")] / want - 1) < 1e-9


@pytest.mark.parametrize("order", [2, 3])
def test_automata_of_all_masses_share_their_parts(order):
    block = small_block(vocabulary=12)
    one = automaton(block, order, 1.0, 0.5)
    parts = ngram_lm.Parts(one.grams, one.counts, one.tokens, one.distinct)
    path = ngram_lm.walk(one.grams, one.counts)
    parts.follow(path)
    parts.leave_out(block.learn)
    for a, b in ngram_lm.GRID:
        own = automaton(block, order, a, b)
        shared = ngram_lm.Automaton(one.grams, one.counts, one.tokens, one.distinct, a, b, parts)
        assert np.array_equal(shared.scores(), own.scores(path))
        left = shared.left_out()
        assert np.array_equal(left, own.left_out(block.learn)) and not left[~block.learn].any()
        # A token that is left out: the counts of its n-grams, one less each.
        k = order
        at = int(np.flatnonzero(block.learn & (own.grams.index[k] >= 0))[0])
        lower = max(own.counts[1][block.word[at]], 1) / (own.tokens + own.distinct)
        for j in range(2, k + 1):
            g = own.grams.index[j][at]
            n = max(own.counts[j - 1][own.grams.prefix[j][g]] - 1, 0)
            m = a * (n + 1) ** b if n else 1.0
            lower = (max(own.counts[j][g] - 1, 0) + m * lower) / (n + m)
        assert left[at] == pytest.approx(np.log10(lower))
