import re

import xxhash

from sensorlake.llm import simhash
from sensorlake.llm.components import components
from sensorlake.llm.simhash import near_duplicates, one_of_each
from tests.llm.conftest import prose


def brute_fingerprint(text, width=3):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    runs = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    fps = [(i, brute_fingerprint(t)) for i, t in rows]
    group = list(range(len(fps)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a][1] ^ fps[b][1]).bit_count() <= 2:
                group[root(a)] = root(b)
    ids = {}
    for n, (i, _) in enumerate(fps):
        ids.setdefault(root(n), []).append(i)
    named = {r: min((i for i in g if i is not None), default=None) for r, g in ids.items()}
    return sorted(((i, f, named[root(n)]) for n, (i, f) in enumerate(fps)), key=repr)


def ours(docs):
    return sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in near_duplicates(docs).collect()),
                  key=repr)


def near_rows():
    rows = []
    for i in range(30):
        words = prose(i, 700).split()
        for j in range(i % 5):
            other = list(words)
            other[100 + j] = "changed"
            rows.append((100 * i + j, " ".join(other)))
        rows.append((100 * i + 50, " ".join(words)))
    return rows


def test_against_brute_force(make_docs):
    rows = near_rows()
    got = ours(make_docs(rows))
    assert got == brute(rows)
    assert sum(i != c for i, _, c in got) > 10


def test_odd_rows(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert ours(odd) == brute(rows)


def test_empty(nothing):
    assert ours(nothing) == [] and one_of_each(nothing).collect() == []


def test_crowded_blocks_lose_no_link(spark, monkeypatch):
    """More fingerprints under one key than are compared in pairs."""
    base = 0x0123456789ABCDEF
    fps = [base] + [base ^ 1 << a for a in range(32)] + [base ^ 1 << a ^ 1 << b for a in range(32) for b in range(a)]
    far = [base ^ 0xFFFF << s for s in (0, 16, 32)] + [base ^ 0b111 << 20, base ^ 0b11111 << 5]
    rows = [(f - (1 << 64) if f >> 63 else f,) for f in fps + far]
    monkeypatch.setattr(simhash, "SMALL", 8)
    edges = simhash.links(spark.createDataFrame(rows, "fp long"))
    got = {(r["node"], r["root"]) for r in components(edges).collect()}
    everyone = {r[0] for r in rows}
    group = {base}
    while True:
        more = {f for f in everyone if any((f ^ g).bit_count() <= 2 for g in group)}
        if more == group:
            break
        group = more
    assert {n for n, r in got if r == min(group)} == group


def test_components_of_a_long_path(spark):
    path = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1000), (5000, 5000)]
    got = {(r["node"], r["root"]) for r in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(201)} | {(1000, 1000), (1001, 1000)}


def test_one_of_each(make_docs, odd):
    rows = near_rows()
    kept = sorted(r["doc_id"] for r in one_of_each(make_docs(rows)).collect())
    assert kept == sorted({c for _, _, c in brute(rows)})
    out = one_of_each(odd)
    assert out.columns == odd.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 7, 8, 10] and ids.count(None) == 2
