import numpy as np
from pyspark.sql import functions as F

from sensorlake.llm.language import identify, subwords, train
from tests.llm.conftest import CLASHES

TONGUES = {"aa": "the and of there where with from that this over".split(),
           "bb": "der die und nicht wird über schön groß eine zwischen".split(),
           "cc": "le la où être français garçon déjà avec pour très".split()}


def text(lang: str, seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(TONGUES[lang], n))


def rows(n: int):
    return [(i, text(lang, i * 3 + j, 3 + i % 40), lang) for i in range(n) for j, lang in enumerate(TONGUES)]


def test_held_out_accuracy(make_docs):
    data = [(i, t, lang) for i, (_, t, lang) in enumerate(rows(60))]
    got = identify(make_docs(data), F.col("doc_id") % 4 == 2).collect()
    held = [r for r in got if r["doc_id"] % 4 == 2]
    assert sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_prediction_reads_the_text_only(make_docs):
    data = [(i, t, lang) for i, (_, t, lang) in enumerate(rows(40))]
    other = [(i, t, lang if i % 4 != 2 else "zz") for i, t, lang in data]
    held = F.col("doc_id") % 4 == 2
    one = {r["doc_id"]: r["lang_pred"] for r in identify(make_docs(data), held).collect()}
    two = {r["doc_id"]: r["lang_pred"] for r in identify(make_docs(other), held).collect()}
    assert one == two and "zz" not in two.values()


def test_odd_rows(odd, nothing, make_docs):
    none_known = identify(odd, F.lit(False)).collect()
    assert len(none_known) == odd.count()
    assert {(r["lang_pred"], r["score"], r["rejected"]) for r in none_known} == {("und", 0.0, True)}
    known = odd.select("*").unionByName(make_docs([(100 + i, t, x) for i, (_, t, x) in enumerate(rows(20))], CLASHES))
    got = {(r["doc_id"], r["text"]): r["lang_pred"] for r in identify(known, F.lit(False)).collect()}
    assert got[(1, None)] == got[(2, "")] == got[(9, "\n\n\n")] == "und"
    assert got[(10, "a")] in TONGUES
    assert identify(nothing, F.lit(False)).collect() == []


def test_one_language_is_everyones(make_docs):
    got = identify(make_docs([(1, "abc", "aa"), (2, "xyz", None), (3, "12", None)]), F.lit(False)).collect()
    assert [r["lang_pred"] for r in sorted(got, key=lambda r: r["doc_id"])] == ["aa", "aa", "und"]


def test_long_texts_are_counted_whole():
    words = "Straße und Garçon, 12 Wörter. " * 60_000
    data = b" " + b" ".join(words.lower().encode().translate(bytes(
        b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))).split()) + b" "
    assert subwords(words).sum() == sum(len(data) - n + 1 for n in (2, 3, 4, 5))


def test_rejection_is_calibrated():
    data = rows(60)
    noisy = ["aa" if i % 9 == 0 else lang for i, (_, _, lang) in enumerate(data)]
    model = train([t for _, t, _ in data], noisy, precision=0.9)
    assert 0 <= model.threshold <= 1 and model.temperature > 0
    assert model.predict(None) == ("und", 0.0) == model.predict("123 !")
