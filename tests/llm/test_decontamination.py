import random

import numpy as np

from sensorlake.llm.decontamination import MATCH, MISMATCH, GAP, WORD, align, leaks, without_leaks
from tests.llm.conftest import prose


def brute_align(item, passage):
    best, h = 0, np.zeros((len(item) + 1, len(passage) + 1), int)
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (MATCH if a == b else MISMATCH), h[i - 1, j] + GAP, h[i, j - 1] + GAP)
            best = max(best, h[i, j])
    return best


def brute(docs, items, threshold=0.5, least=8):
    out = {}
    for d, text in docs:
        words = WORD.findall((text or "").lower())
        for i, item in items:
            own = WORD.findall((item or "").lower())
            if d is None or i is None or not own or not words:
                continue
            share = brute_align(own, words) / (MATCH * len(own))
            if share >= (threshold if len(own) >= least else 1.0):
                out[(d, i)] = max(out.get((d, i), 0), share)
    return out


def bench(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, ikey string")


def ours(docs, items):
    return {(r["doc_id"], r["item_id"]): r["score"] for r in leaks(docs, items).collect()}


def edited(text, every, rng):
    words = text.split()
    for at in range(every // 2, len(words), every):
        words[at] = rng.choice(("", "other", words[at] + " added"))
    return " ".join(words)


def test_copies_and_edited_copies(make_docs, spark):
    rng = random.Random(4)
    items = [(i, prose(1000 + i, 25 + i)) for i in range(8)]
    docs = [(100 + i, prose(i, 80)) for i in range(30)]
    for i, text in items:
        docs += [(200 + i, prose(50 + i, 40) + "\n" + text.upper() + ". " + prose(70 + i, 30)),
                 (300 + i, prose(90 + i, 40) + " " + edited(text, 7, rng) + " " + prose(80 + i, 20))]
    got = ours(make_docs(docs), bench(spark, items))
    true = brute(docs, items)
    assert got.keys() == true.keys() and all(abs(got[k] - true[k]) < 1e-9 for k in got)
    assert len(got) == 16


def test_densely_edited_copies(make_docs, spark):
    """Every fourth or fifth word changed, the last one too: no five words in a row stay, and one copy of each."""
    items = [(i, prose(1000 + i, 40 + i)) for i in range(8)]
    docs = [(100 + i, prose(i, 80)) for i in range(10)]
    for i, text in items:
        words = text.split()
        words = [f"new{n}" if (len(words) - 1 - n) % (4 + i % 2) == 0 else w for n, w in enumerate(words)]
        docs.append((200 + i, f"{prose(90 + i, 20)} {' '.join(words)} {prose(70 + i, 20)}"))
    got, true = ours(make_docs(docs), bench(spark, items)), brute(docs, items)
    assert got.keys() == true.keys() and all(abs(got[k] - true[k]) < 1e-9 for k in got)
    assert len(got) == 8


def test_common_passages_still_count(make_docs, spark):
    """An item that most documents hold has no rare n-gram, but is found in all of them."""
    item = prose(7, 30)
    docs = [(i, f"{prose(i + 10, 20)} {item} {prose(i + 500, 5)}") for i in range(120)]
    assert len(ours(make_docs(docs), bench(spark, [(1, item)]))) == 120


def test_short_items_only_in_full(make_docs, spark):
    items = [(1, "zip"), (2, "zap zop"), (3, "one two three four five"), (4, ""), (5, None), (None, "zip zap")]
    docs = [(1, "a zip here"), (2, "zap zop"), (3, "zap other zop"), (4, "one two three four six"),
            (5, "so one two three four five it is")]
    assert ours(make_docs(docs), bench(spark, items)) == {(1, 1): 1.0, (2, 2): 1.0, (5, 3): 1.0}


def test_odd_rows(odd, nothing, make_docs, spark):
    docs = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    items = [(1, prose(1, 60)), (1, prose(1, 60)), (2, prose(3, 50)), (3, prose(2499, 40)), (4, None)]
    # The long text holds the first 40 words of items 1 and 2, and item 3.
    assert ours(odd, bench(spark, items)) == {
        (5, 1): 1.0, (6, 1): 1.0, (7, 2): 1.0, (4, 1): 40 / 60, (4, 2): 40 / 50, (4, 3): 1.0}
    rest = without_leaks(odd, bench(spark, items))
    assert rest.columns == odd.columns
    assert rest.count() == len(docs) - 7  # documents 4, 6 and all rows of 5 and 7
    assert ours(nothing, bench(spark, items)) == {} == ours(odd, bench(spark, []))


def test_alignment_scores():
    rng = np.random.default_rng(2)
    for _ in range(60):
        a, b = rng.integers(0, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(1, 25))
        score, start, end = align(a, b)
        assert score == brute_align(list(a), list(b))
        if score:
            assert brute_align(list(a), list(b[start:end])) == score
