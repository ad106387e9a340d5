from pyspark.sql import functions as F

from sensorlake.llm.linededup import drop_repeated_lines, keep_bitmaps
from tests.llm.conftest import prose

WHITE = " \t\n\x0b\x0c\r"


def brute(docs, min_chars=20, min_docs=3):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))

    held = {}
    for i, t in docs:
        if i is not None:
            for line in (t or "").split("\n"):
                held.setdefault(key(line), set()).add(i)
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        gone = [i is not None and len(key(x)) >= min_chars and len(held[key(x)]) >= min_docs and i < max(held[key(x)])
                for x in lines]
        kept = "\n".join(x for x, g in zip(lines, gone) if not g)
        out.append((i, kept if any(gone) else t, len(lines), sum(gone)))
    return sorted(out, key=repr)


def ours(docs):
    rows = drop_repeated_lines(docs).select("doc_id", "text", "n_lines", "n_dropped").collect()
    return sorted(map(tuple, rows), key=repr)


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def test_shared_lines(make_docs):
    shared = ["Licensed under the same Licence", "  licensed UNDER the same licence\t", "Äußerst lange Zeile ÄÖÜ hier"]
    rows = []
    for i in range(60):
        lines = [prose(i * 10 + j, 12) for j in range(i % 5)]
        lines[i % 3:i % 3] = [shared[i % 3], "short", shared[0] if i % 7 == 0 else ""]
        rows.append((i, "\n".join(lines)))
    docs = make_docs(rows)
    got = ours(docs)
    assert got == brute(rows)
    assert sum(r[3] for r in got) > 50


def test_many_lines_in_one_text(make_docs):
    lines = [prose(i, 8) for i in range(300)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(lines[::2])), (3, "\n".join(lines[::3]))]
    docs = make_docs(rows)
    assert ours(docs) == brute(rows)
    words = {r["doc_id"]: len(r["keep"]) for r in keep_bitmaps(docs).collect()}
    assert words[1] == 5 and set(words) == {1, 2}


def test_line_length_counts_code_points(make_docs):
    rows = [(i, "é" * 19 + "\n" + "é" * 20) for i in range(3)]
    assert [r[3] for r in ours(make_docs(rows))] == [1, 1, 0]


def test_odd_rows(odd):
    assert ours(odd) == brute(pairs(odd))
    out = drop_repeated_lines(odd)
    assert sorted(out.columns) == sorted({*odd.columns, "n_dropped"})
    assert {r["keep"] for r in out.select("keep").collect()} == {"x"}


def test_repeated_ids_with_other_texts(make_docs):
    line = "one and the same long line"
    rows = [(1, f"a\n{line}"), (1, f"{line}\nb"), (1, f"{line}\nb"), (2, line), (3, line)]
    assert ours(make_docs(rows)) == brute(rows)


def test_empty(nothing):
    assert ours(nothing) == [] and keep_bitmaps(nothing).collect() == []


def test_no_shuffle_carries_text(make_docs):
    plan = keep_bitmaps(make_docs([(1, "a")]))._jdf.queryExecution().optimizedPlan().toString()
    assert "text#" not in plan


def test_no_python(make_docs):
    plan = drop_repeated_lines(make_docs([(1, "a")]).where(F.col("doc_id") > 0))._jdf.queryExecution().toString()
    assert "Arrow" not in plan and "Python" not in plan
