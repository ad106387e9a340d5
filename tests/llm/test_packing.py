import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sensorlake.llm.packing import END, hilbert_index, pack
from tests.llm.conftest import prose

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def check(docs, pieces, tokenizer, length):
    """Every id of every row is in exactly one piece, and only the last sequence is short."""
    wanted = sorted((i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (END,)) for i, t in docs)
    line = sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"]))
    at = 0
    for p in line:
        assert (p["sequence_id"], p["offset"]) == divmod(at, length)
        assert 0 < p["length"] == len(p["ids"]) // 4 and p["offset"] + p["length"] <= length
        at += p["length"]
    whole, now = [], []
    for p in line:
        assert p["start"] == len(now)
        now += np.frombuffer(p["ids"], "<u4").tolist()
        if len(now) == p["doc_tokens"]:
            whole.append((p["doc_id"], tuple(now)))
            now = []
    assert not now and sorted(whole) == wanted


def test_round_trip(make_docs, tokenizer):
    odd = ["It's  a TEST,\tdon't\nworry", "naïve Ünïcode ß 中文 🙂", "<|endoftext|> a<|startoftext|>b", "x" * 500]
    docs = [(i, prose(i, 5 + 13 * i % 200)) for i in range(120)] + list(enumerate(odd, 500))
    pieces = pack(make_docs(docs), PATH, length=256, slice_tokens=1500).collect()
    check(docs, pieces, tokenizer, 256)


def test_odd_rows(odd, nothing, make_docs, tokenizer):
    docs = [(-1 if r["doc_id"] is None else r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    pieces = [{**p.asDict(), "doc_id": -1 if p["doc_id"] is None else p["doc_id"]} for p in pack(odd, PATH).collect()]
    check(docs, pieces, tokenizer, 2048)
    assert pack(nothing, PATH).collect() == []
    assert [p["doc_tokens"] for p in pack(make_docs([(1, None)]), PATH).collect()] == [1]


def test_copies_share_a_place_but_not_a_slice(make_docs, tokenizer):
    docs = [(i, "one text for all of them") for i in range(2000)]
    check(docs, pack(make_docs(docs), PATH, slice_tokens=512).collect(), tokenizer, 2048)


def test_a_task_uses_one_python_worker(make_docs):
    """The curve's key is worked out once, and the slices' totals come without Python."""
    docs = [(i, prose(i, 50)) for i in range(200)]
    plan = pack(make_docs(docs), PATH, slice_tokens=512)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert "_before" in plan and "LogicalRDD [_slice" not in plan


def test_alike_documents_are_neighbours(make_docs):
    docs = [(i, prose(0, 30) if i % 2 else "zebra quartz " * 30) for i in range(40)]
    pieces = pack(make_docs(docs), PATH, length=1 << 20).collect()
    kinds = [p["doc_id"] % 2 for p in sorted(pieces, key=lambda p: p["offset"])]
    assert sum(a != b for a, b in zip(kinds, kinds[1:])) == 1


def test_hilbert_curve_takes_unit_steps():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    index = hilbert_index(cells, 3)
    assert sorted(index) == list(range(512))
    walk = cells[np.argsort(index)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_matrix_merges_equal_the_library(tokenizer):
    import random

    from sensorlake.llm.wordbpe import ID, WordBpe

    rng = random.Random(0)
    parts = ["a", "b", "the", "'s", "É", "ß", "µ", "²", "½", "\x85", "\xa0", "\x1c", " ", "\n", "_", "-", "中", "é",
             "́", "Σ", "İ", "<|endoftext|>", "12", "!?", "ﬁ", "don't", "…", "x" * 40]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    texts += [prose(i, 200).title() for i in range(20)] + [None]
    own = WordBpe(PATH)
    assert own.matrix
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, ID).tolist() for x in own.encode(texts)] == want
    own.matrix = False
    assert [np.frombuffer(x, ID).tolist() for x in own.encode(texts)] == want


def test_a_tokeniser_is_kept_for_the_next_task(tokenizer):
    from sensorlake.llm.wordbpe import ID, word_bpe

    own = word_bpe(PATH)
    texts = ["a\0 \0b c\0\0d \0", "plain words, naïve ones; " + "y" * 31 + " " + "é" * 16 + " " + "z" * 33]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, ID).tolist() for x in own.encode(texts)] == want
    assert word_bpe(PATH) is own and "naïve" in own.new
