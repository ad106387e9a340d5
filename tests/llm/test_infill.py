import hashlib
import random

import pytest

from sensorlake.llm.infill import cuts, fill_in_middle, parts, restored
from tests.llm.conftest import CLASHES, prose

LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


def units(text):
    out = []
    for ch in text:
        if out and ch in LETTERS and out[-1][-1] in LETTERS:
            out[-1] += ch
        else:
            out.append(ch)
    return out


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i * 8:i * 8 + 8], 16) for i in range(4)]
    found = units(text)
    n = len(found)
    a, b = min(h[0] % (n + 1), h[1] % (n + 1)), max(h[0] % (n + 1), h[1] % (n + 1))
    head, middle, tail = "".join(found[:a]), "".join(found[a:b]), "".join(found[b:])
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(head), len(middle), "<S>" + tail + "<P>" + head + "<M>" + middle
    return n, "psm", len(head), len(middle), "<P>" + head + "<S>" + tail + "<M>" + middle


def texts():
    rng = random.Random(5)
    alphabet = "abcXYZ  \n\t<>PSM.é中🙂0"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(300)]


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_parts_change_nothing(size):
    rng = random.Random(size)
    for text in texts():
        h1, h2 = rng.getrandbits(32), rng.getrandbits(32)
        found = units(text)
        a, b = sorted((h1 % (len(found) + 1), h2 % (len(found) + 1)))
        assert cuts(text, h1, h2, size) == (len(found), len("".join(found[:a])), len("".join(found[:b])))
        assert "".join(text[i:j] for i, j in parts(text, size)) == text


def test_documents(make_docs):
    docs = [*enumerate(texts()), (900, None), (901, ""), (902, "a<P>b"), (903, "x<M>"), (904, "<S>"),
            (905, prose(1, 400)), (906, "word " * 60_000), (907, "z" * 300_000), (-5, "minus one"), (None, "no id")]
    df = fill_in_middle(make_docs(docs)).withColumn("again", restored())
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.again) for r in df.collect()), key=repr)
    want = sorted(((i, *brute(i, t), t or "") for i, t in docs), key=repr)
    assert got == want
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_shares(make_docs):
    rows = fill_in_middle(make_docs([(i, "some words here") for i in range(2000)])).groupBy("form").count().collect()
    share = {r["form"]: r["count"] / 2000 for r in rows}
    assert abs(share["plain"] - 0.1) < 0.03 and abs(share["spm"] - 0.18) < 0.04


def test_odd_rows(make_docs, odd, nothing):
    rows = fill_in_middle(odd)
    assert {"_key", "output", *CLASHES} <= set(rows.columns) and rows.count() == odd.count()
    assert rows.where("doc_id = 5").distinct().count() == 1
    clash = make_docs([(1, "a b")], ("n", "FORM", "output", "_name"))
    assert fill_in_middle(clash).select("n", "form", "output", "_name").first()[3] == "x"
    assert fill_in_middle(nothing).collect() == []
