import re
from collections import defaultdict

import pytest

from sensorlake.llm import nearcopies
from sensorlake.llm.nearcopies import one_of_similar, parities, shingle_set, similar_documents
from tests.llm.conftest import prose


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0d]+", (text or "").encode().lower().decode())
    if words and len(words) < width:
        return {tuple(words)}
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def brute(pairs, similar=0.8):
    """{doc_id: component_id} over all pairs that share a shingle (or have none)."""
    sets = {i: shingles(t) for i, t in pairs}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(set)
    for i, s in sets.items():
        for x in s or {None}:
            holders[x].add(i)
    for i, s in sets.items():
        for j in set().union(*[holders[x] for x in s or {None}]):
            both, union = len(s & sets[j]), len(s | sets[j])
            if j > i and (both >= similar * union - 1e-9):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i in sets}


def edited(text, seed, every):
    words = text.split()
    for n, at in enumerate(range(seed % every, len(words), every)):
        words[at] = f"w{seed}x{n}"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    """Edited copies at many similarities, a chain, a crowd of near copies, a crowd that shares a passage."""
    out = [prose(i, 30 + 5 * i) for i in range(40)]
    out += [edited(out[20 + i % 20], i, 30 + i) for i in range(120)]
    chain = prose(500, 300)
    for i in range(12):
        chain = edited(chain, 900 + i, 80)
        out.append(chain)
    crowd, passage = prose(600, 200), prose(700, 120)
    out += [edited(crowd, 3000 + i, 90) for i in range(150)]
    out += [passage + " " + prose(4000 + i, 60) for i in range(150)]
    out += [None, "", " \t", "one", "One", "two words", prose(1, 35)]
    return list(enumerate(out, 1))


def test_equals_brute_force(make_docs, rows):
    got = {r["doc_id"]: r["component_id"] for r in similar_documents(make_docs(rows)).collect()}
    want = brute(rows)
    assert got == want
    assert len(set(want.values())) < len(want) / 2


def test_sample_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pairs = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = {r["doc_id"]: r["component_id"] for r in similar_documents(docs).collect()}
    assert got == brute(pairs)


def test_first_stays(make_docs, rows):
    docs = make_docs(rows)
    kept = one_of_similar(docs)
    assert kept.dtypes == docs.dtypes
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(brute(rows).values()))


def test_odd_rows(odd, nothing):
    got = [(r["doc_id"], r["component_id"]) for r in similar_documents(odd).collect()]
    assert len(got) == odd.count()
    named = dict(p for p in got if p[0] not in (None, 7))
    assert named[2] == named[3] == named[9] == 1 and named[6] == 5 and named[10] == 10
    kept = one_of_similar(odd)
    assert kept.columns == odd.columns and kept.where("doc_id IS NULL").count() == 2
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [1, 4, 5, 7, 8, 10]
    assert similar_documents(nothing).collect() == [] and one_of_similar(nothing).collect() == []


def test_parities_never_exceed_the_difference():
    base = prose(800, 400)
    for i in range(40):
        a, b = shingle_set(base), shingle_set(edited(base, 5000 + i, 5 + 4 * i))
        apart = sum(bin(int(x) & (1 << 64) - 1).count("1") for x in parities(a) ^ parities(b))
        only = len(set(a.tolist()) ^ set(b.tolist()))
        assert apart <= only and (apart - only) % 2 == 0
    assert not parities(shingle_set(None)).any()


def test_crowd_of_less_similar_texts_is_not_verified_pair_by_pair(spark, monkeypatch):
    """Copies of one text that are all a little under 0.8 alike share blocks, but few pairs' texts are read."""
    base, seen = prose(900, 150), []
    crowd = [edited(base, 7000 + i, 22) for i in range(120)]
    links = [edited(crowd[i], 8000 + i, 140) for i in range(0, 120, 10)]
    rows = list(enumerate(crowd + links, 1))
    verified = nearcopies.verified
    monkeypatch.setattr(nearcopies, "verified", lambda pairs, *more: seen.append(pairs.count()) or verified(pairs, *more))
    got = dict(similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute(rows)
    assert len(set(got.values())) > 60
    assert sum(seen) < 5 * len(rows)
