import random
from collections import Counter

import numpy as np

from sensorlake.llm import pseudolm as lm
from tests.llm.conftest import prose


def grammar(seed: int, n: int) -> str:
    """Words that follow from their neighbours: each comes after one certain word."""
    rng, follows = random.Random(seed), "red fox ran far and saw big sun".split()
    at, out = rng.randrange(8), []
    for _ in range(n):
        out.append(follows[at])
        at = (at + 1) % 8
    return " ".join(out)


def test_log_probabilities_are_a_distribution():
    w = lm.views(lm.with_frequencies(lm.initial(), np.random.default_rng(0).integers(0, 50, lm.CODES)))
    line = np.array([lm.EDGE, lm.EDGE, 5, 77, 4000, lm.EDGE, lm.EDGE])
    every = []
    for code in range(lm.CODES):
        line[3] = code
        every.append(lm.log_probabilities(w, line, np.array([3]))[0])
    assert abs(np.exp(every).sum() - 1) < 1e-3


def test_gradient_is_the_slope():
    rng = np.random.default_rng(3)
    flat = lm.initial().astype(np.float64)
    line = np.concatenate([[lm.EDGE] * 2, rng.integers(0, lm.CODES, 30), [lm.EDGE] * 2])
    place = np.flatnonzero(line != lm.EDGE)
    start, squares, rate = flat.copy(), np.full(len(flat), 1e12), 1e3
    lm.learn(flat, squares, line, place, rate)
    slope = (start - flat) * np.sqrt(1e12) / rate
    loss = lambda f: -lm.log_probabilities(lm.views(f), line, place).mean()
    for at in rng.choice(np.flatnonzero(np.abs(slope) > 1e-4), 12, replace=False):
        up, down = start.copy(), start.copy()
        up[at] += 1e-4
        down[at] -= 1e-4
        assert abs((loss(up) - loss(down)) / 2e-4 - slope[at]) < 1e-4 + 0.02 * abs(slope[at])


def test_learned_text_scores_higher(make_docs):
    docs = [(i, grammar(i, 400)) for i in range(120)]
    shuffled = []
    for i in range(10):
        words = grammar(i, 200).split()
        random.Random(i).shuffle(words)
        shuffled.append((1000 + i, " ".join(words)))
    got = {r["doc_id"]: r["mean_log_prob"] for r in lm.pseudo_likelihood(make_docs(docs + shuffled)).collect()}
    good, bad = [got[i] for i in range(120)], [got[1000 + i] for i in range(10)]
    assert np.mean(good) > np.mean(bad) + 0.15
    assert np.mean(good) > -np.log(8) + 0.1  # better than word frequencies allow


def test_every_context_is_learned(make_docs):
    """Codes of one residue modulo 5: a mask chosen by a sum of codes would pass over all of them."""
    words = [w for w in (f"w{i}" for i in range(200)) if lm._Codes()[w] % 5 == 3][:8]
    assert len({lm._Codes()[w] for w in words}) == 8
    docs = [(i, " ".join(words[(i + n) % 8] for n in range(400))) for i in range(120)]
    got = [r["mean_log_prob"] for r in lm.pseudo_likelihood(make_docs(docs)).collect()]
    assert np.mean(got) > -np.log(8) + 0.1


def test_rounds_share_out_all_places():
    line, place, owner = lm.laid_out([np.arange(n) for n in (7, 0, 1, 12)])
    parts = [lm.masked_places(place, owner, r, 3) for r in range(3)]
    assert sorted(np.concatenate(parts)) == sorted(place)
    assert [len(p) for p in parts] == [3 + 1 + 4, 2 + 4, 2 + 4]


def test_sums_match_single_documents(make_docs):
    docs = make_docs([(i, prose(i, 20 + i)) for i in range(30)])
    flat = lm.trained_weights(docs)
    known = lm._Codes()
    for r in lm.pseudo_likelihood(docs).collect():
        line, place, _ = lm.laid_out([lm.codes_of(r["text"], known)])
        assert r["n_words"] == len(place)
        assert abs(r["log_likelihood"] - lm.log_probabilities(lm.views(flat), line, place).sum()) < 1e-2


def test_words_that_share_a_code(make_docs, monkeypatch):
    """Every word has its own probability, looked up or joined; repeated texts count each time."""
    monkeypatch.setattr(lm, "COMMON", 20)
    rows = [(i, prose(i % 50, 60)) for i in range(80)] + [(90, None), (91, " ")]
    docs = make_docs(rows)
    words = Counter(w for _, t in rows for w in (t or "").lower().split())
    known, codes = lm._Codes(), Counter()
    for w, n in words.items():
        codes[known[w]] += n
    assert len(codes) < len(words)
    base = {r["doc_id"]: r for r in lm.pseudo_likelihood(docs).collect()}
    got = lm.word_likelihood(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        own = (dict(rows)[r["doc_id"]] or "").split()
        more = sum(np.log(words[w] / codes[known[w]]) for w in own)
        assert abs(r["log_likelihood"] - base[r["doc_id"]]["log_likelihood"] - more) < 1e-2
        assert r["n_words"] == len(own) and (r["mean_log_prob"] is None) == (not own)


def test_columns_give_the_scores_of_single_words():
    """Words scored together have the log-probabilities of both steps, written out word by word."""
    rng = np.random.default_rng(5)
    w = lm.views(lm.with_frequencies(lm.initial(), rng.integers(0, 50, lm.CODES)))
    line, place, _ = lm.laid_out([rng.integers(0, 200, 1500), rng.integers(0, lm.CODES, 300)])
    got = lm.log_probabilities(w, line, place)
    for n in rng.choice(len(place), 50, replace=False):
        at = place[n]
        _, h = lm._hidden(w, line[at + np.array([-2, -1, 1, 2])][None])
        high, low = divmod(int(line[at]), lm.HALF)
        z, y = h[0] @ w["upper"] + w["upper_bias"], h[0] @ w["lower"][high] + w["lower_bias"][high]
        assert abs(got[n] - (z[high] - np.log(np.exp(z).sum()) + y[low] - np.log(np.exp(y).sum()))) < 1e-4


def test_scores_of_any_size_are_shifted_before_their_exponentials():
    """Large scores, which alone would overflow or vanish, give the same as small ones."""
    z = np.random.default_rng(2).normal(0, 3, (50, lm.HALF)).astype(np.float32)
    for shift in (0, 300, -300):
        own = np.exp(z - z.max(axis=1, keepdims=True))
        assert np.allclose(lm._softmax(z + np.float32(shift)), own / own.sum(axis=1, keepdims=True), rtol=1e-3, atol=1e-6)
        assert np.allclose(lm._log_sums(z.T + np.float32(shift)), shift + np.log(np.exp(z).sum(axis=1)), atol=1e-3)


def test_texts_are_split_once_for_codes_and_counts(make_docs, monkeypatch):
    """One table holds the codes of every text and the exact counts of all words, over vocabularies that fill up."""
    monkeypatch.setattr(lm, "MOST_WORDS", 10)
    rows = [(i, prose(i % 50, 60)) for i in range(80)] + [(90, None), (91, " "), (92, "ǅ \u2003 x\x1cy")]
    got = lm.counted(make_docs(rows)).collect()
    known = lm._Codes()
    wanted = sorted(lm.codes_of(t, known).astype(lm.CODE).tobytes() for _, t in rows)
    assert sorted(bytes(r["codes"]) for r in got if r["word"] is None) == wanted
    counts = Counter()
    for r in got:
        if r["word"] is not None:
            counts[r["word"], r["code"]] += r["n"]
    words = Counter(w for _, t in rows for w in (t or "").lower().split())
    assert sorted((known[w], n) for w, n in words.items()) == sorted((c, n) for (_, c), n in counts.items())


def test_odd_rows(odd, nothing):
    got = lm.pseudo_likelihood(odd)
    assert sorted(got.columns) == sorted({*odd.columns, "n_words", "log_likelihood", "mean_log_prob"})
    rows = {r["doc_id"]: r for r in got.where("doc_id IN (1, 2, 3, 4, 9)").collect()}
    for i in (1, 2, 3, 9):
        assert (rows[i]["n_words"], rows[i]["log_likelihood"], rows[i]["mean_log_prob"]) == (0, 0.0, None)
    assert rows[4]["n_words"] == 100_000 and got.count() == odd.count()
    assert lm.pseudo_likelihood(nothing).collect() == []


def test_odd_rows_of_words(odd, nothing):
    every = lm.word_likelihood(odd)
    assert sorted(every.columns) == sorted({*odd.columns, "n_words", "log_likelihood", "mean_log_prob"} - {"text"})
    words = {r["doc_id"]: r for r in every.where("doc_id IN (1, 2, 3, 4, 9)").collect()}
    assert every.count() == odd.count() and words[4]["n_words"] == 100_000
    assert [(words[i]["log_likelihood"], words[i]["mean_log_prob"]) for i in (1, 2, 3, 9)] == [(0.0, None)] * 4
    assert lm.word_likelihood(nothing).collect() == []
