import random

import public_tokenizers
import pytest

from sensorlake.llm import tokencount
from sensorlake.llm.tokencount import Terminals, Vocabulary, segment_all, token_counts, zipf_vocabulary
from tests.llm.conftest import prose


@pytest.fixture(scope="module")
def vocabulary():
    return zipf_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


def brute(word, v):
    text, best = "▁" + word, [(0.0, 0)]
    for end in range(1, len(text) + 1):
        width = len(text[end - 1].encode())
        options = [(best[-1][0] + width * v.byte, -best[-1][1] - width)]
        options += [(best[s][0] + v.pieces[text[s:end]], -best[s][1] - 1) for s in range(end) if text[s:end] in v.pieces]
        score, tokens = max(options)
        best.append((score, -tokens))
    return best[-1][1], best[-1][0]


def test_against_brute_force(vocabulary):
    rng = random.Random(1)
    words = {"".join(rng.choice("abeinrst éß中🙂'") for _ in range(rng.randint(1, 12))).replace(" ", "") or "a"
             for _ in range(600)} | {"the", "then", "there", "theremin", "a"}
    for word, tokens, score in segment_all(sorted(words), vocabulary):
        want = brute(word, vocabulary)
        assert tokens == want[0] and abs(score - want[1]) < 1e-9


def test_ties_take_fewer_tokens():
    v = Vocabulary({"▁": -1.0, "a": -1.0, "b": -1.0, "ab": -2.0, "▁ab": -3.0}, -9.0, 3)
    assert list(segment_all(["ab"], v)) == [("ab", 1, -3.0)]


def test_probabilities_add_up(vocabulary):
    import math

    total = sum(map(math.exp, vocabulary.pieces.values())) + 256 * math.exp(vocabulary.byte)
    assert 0.99 < total < 1.01


def test_documents(make_docs, odd, nothing, vocabulary):
    docs = [(i, prose(i, i)) for i in range(40)] + [(100, None), (101, " \n")]
    got = {r["doc_id"]: r for r in token_counts(make_docs(docs), vocabulary).collect()}
    for i, text in docs:
        words = [brute(w, vocabulary) for w in (text or "").split()]
        assert (got[i]["n_pretokens"], got[i]["n_tokens"]) == (len(words), sum(t for t, _ in words))
        assert abs(got[i]["log_score"] - sum(s for _, s in words)) < 1e-6
    rows = token_counts(odd, vocabulary)
    assert sorted(rows.columns) == sorted({*odd.columns, "n_pretokens", "log_score"})
    assert rows.count() == odd.count() and rows.where("doc_id = 4 AND n_pretokens = 100000").count() == 1
    assert token_counts(nothing, vocabulary).collect() == []


def test_forgetting_changes_nothing(vocabulary, monkeypatch):
    texts = [prose(i, 50).split() for i in range(20)]
    one, two = Terminals(vocabulary), Terminals(vocabulary)
    one.add(texts)
    whole = [one.count(t) for t in texts]
    monkeypatch.setattr(tokencount, "MOST_KEPT", 10)
    for t, want in zip(texts, whole):
        two.add([t])
        assert two.count(t) == want
