"""The language field: whole chains, words of any letters and numbers."""

import numpy as np
import pytest

from rollcall.llm import language_crf as crf
from rollcall.llm.language_crf import Model, Words, identify_language, posteriors, words_in

ODD_WORDS = "add ½ cup of milk ² ① Ⅷ ٣ x₂ naïve ﬁne ʰa ªb ⅓tasse ǅ straße İi 你好 dog"


def whole_chain(em, trans):
    """Forward-backward over one whole text, place by place, in logarithms."""
    n, k = em.shape
    total = lambda x: np.log(np.exp(x - x.max()).sum()) + x.max()
    a, b = [em[0]], [np.zeros(k)]
    for t in range(1, n):
        a.append(np.array([total(a[-1] + trans[:, j]) for j in range(k)]) + em[t])
    for t in range(n - 2, -1, -1):
        b.insert(0, np.array([total(trans[i] + em[t + 1] + b[0]) for i in range(k)]))
    p = np.array(a) + np.array(b)
    p = np.exp(p - p.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


@pytest.mark.parametrize("chain", [1, 3, 64])
def test_posteriors_are_those_of_whole_texts(monkeypatch, chain):
    monkeypatch.setattr(crf, "CHAIN", chain)
    rng = np.random.RandomState(4)
    model = Model(["a", "b", "c"], np.empty(0, np.uint64))
    model.tri = rng.normal(0, 0.4, model.tri.shape).astype(np.float32)
    model.trans = (np.eye(3) * 2.5 + rng.normal(0, 0.5, (3, 3))).astype(np.float32)
    texts = ["", "one", " ".join(f"w{'abcdefghij'[i * 7 % 10]}{'xyz'[i % 3] * (i % 4)}" for i in range(150)), "two words", "...",
             " ".join("qrst"[i % 4] * (1 + i % 5) for i in range(64)), ODD_WORDS]
    words = Words(texts)
    em = words.emissions(model).astype(float)
    ends = np.append(words.first, len(words))
    want = [whole_chain(em[a:z], model.trans.astype(float)) for a, z in zip(ends, ends[1:]) if z > a]
    assert np.abs(posteriors(words, model) - np.concatenate(want)).max() < 1e-3


def test_training_and_prediction_split_alike():
    everything = "".join(chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(0x20, 0x20000))
    assert len(words_in(everything)) == len(Words([everything]))
    assert len(Words([" ".join(words_in(ODD_WORDS))])) == len(words_in(ODD_WORDS)) == len(Words([ODD_WORDS]))


def test_numbers_that_are_no_letters_teach_and_are_read(spark):
    rows = [(i, f"the cup of milk and the {w}", "en") for i, w in enumerate(ODD_WORDS.split())]
    rows += [(100 + i, f"die tasse mit der milch und {w}", "de") for i, w in enumerate(ODD_WORDS.split())]
    rows += [(200, "½ ² Ⅷ", "en"), (201, None, None), (202, "x " * 9000 + ODD_WORDS, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in identify_language(docs, docs.select("lang", "text")).collect()}
    assert len(got) == len(rows) and got[200].lang_pred == got[201].lang_pred == "und"
    assert [got[0].lang_pred, got[100].lang_pred] == ["en", "de"] and 0 <= got[202].score <= 1
