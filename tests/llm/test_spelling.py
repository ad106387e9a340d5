import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sensorlake.llm import spelling
from sensorlake.llm.spelling import cells_of, groups_for, near_words, one_edit, spelling_variants, word_counts
from tests.llm.conftest import prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(docs, least, every):
    found = Counter()
    for name, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                found[run] += 1
    return found


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute(docs, least=7, every=31, ratio=10):
    words = {w: n for w, n in counted(docs, least, every).items() if n >= 2}
    form, found = {}, {}
    for w in words:
        others = sorted((-words[o], o) for o in words if near(w, o))
        best = others[0] if others else (0, None)
        form[w] = best[1] if others and -best[0] >= ratio * words[w] else None
        found[w] = len(others), -best[0] if form[w] else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, n, found[w][0], form[w], found[w][1], root))
    return out


def edited(word, rng):
    at, letter = rng.randrange(len(word)), rng.choice("abcdeéèßÉ")
    return rng.choice([word[:at] + word[at + 1:], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1:],
                       word[:at] + word[at + 1:at + 2] + word[at:at + 1] + word[at + 2:]])


@pytest.fixture(scope="module")
def texts():
    """Words with chains of ever rarer variants, accents, capitals and runs cut by other signs."""
    rng = random.Random(3)
    docs, stems = [], ["".join(rng.choice("abcde") for _ in range(rng.randint(6, 10))) for _ in range(60)]
    stems += ["straßenbahn", "élèveÀÿ", "ÉLÈVES×÷x", "a" * 40, "b" * 300]
    for stem in stems:
        word, n = stem, rng.choice([400, 150, 30])
        while n > 1:
            docs += [(len(docs), " ".join([word] * (n // 2))), (len(docs) + 1, f"{word.upper()}, " * (n - n // 2))]
            word, n = edited(word, rng), n // rng.choice([2, 12])
    for i in range(5):  # chains of forms
        docs += [(len(docs) + k, f"letterword{'xyz'[:k]}{i} ".replace(str(i), "abcde"[i]) * n) for k, n in enumerate((500, 40, 3))]
    return [*docs, (len(docs), None), (len(docs) + 1, ""), (len(docs) + 2, "12 ?!\n中文"), (None, "straßenbahn " * 3)]


def rows(df):
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


@pytest.mark.parametrize("groups, block", [(None, 512), (3, 7)])
def test_against_brute_force(make_docs, texts, groups, block, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "TOGETHER", block)
    want = brute(texts)
    assert any(w[5] not in (w[0], w[3]) for w in want) and max(w[2] for w in want) > 3
    assert rows(spelling_variants(make_docs(texts), every=31, groups=groups)) == want


def test_other_parameters(make_docs, texts):
    assert rows(spelling_variants(make_docs(texts), least=6, every=0, ratio=2)) == brute(texts, 6, 0, 2)


def test_one_edit():
    rng = random.Random(4)
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(1, 7)))
        b = "".join(rng.choice("ab") for _ in range(len(a) - rng.randint(0, 1)))
        if b:
            codes = [np.frombuffer(x.encode(), np.uint8)[None, :] for x in (a, b)]
            assert bool(one_edit(*codes)[0]) == near(a, b)


def test_ties_take_the_smaller_word(spark):
    words = spark.createDataFrame([("abcdefg", 2), ("abcdefh", 9), ("abcdef", 9), ("abcdefgé", 9), ("bcdefg", 9)], "word string, n long")
    got = {r.word: r for r in near_words(words).collect()}
    assert (got["abcdefg"].n_near, got["abcdefg"].best_n, got["abcdefg"].best) == (4, 9, "abcdef")


def test_edits_stay_next_to_their_cell():
    """An edit moves at most one letter from a group to another."""
    rng = random.Random(6)
    for groups in (2, 4, 7):
        for _ in range(500):
            word = "".join(rng.choice("abcdefgéèÿÀ") for _ in range(8))
            other = edited(word, rng)
            if near(word, other):
                a, b = ([int(x) for x in c.split(",")] for c in cells_of([word, other], groups))
                change = sorted(x - y for x, y in zip(a, b) if x != y)
                assert change in ([], [1], [-1], [-1, 1])
    assert [groups_for(n) for n in (0, 1000, 10**6, 10**9)] == [2, 2, 4, 7]


def test_counts_are_handed_on(make_docs, texts, monkeypatch):
    monkeypatch.setattr(spelling, "MOST_KEPT", 5)
    got = {r.word: r.n for r in word_counts(make_docs(texts), every=31).collect()}
    assert got == dict(counted(texts, 7, 31))


def test_odd_rows(odd, nothing, make_docs):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert rows(spelling_variants(odd, every=31)) == brute(docs)
    assert spelling_variants(nothing).collect() == []
    assert spelling_variants(make_docs([(1, prose(1, 3)), (2, None)]), seen=2).collect() == []
