"""Operator 1: decoding against brute force over all paths, and held-out accuracy."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from shelfspark.llm import queries, toxicity

WORDS = "the of and to with from that this have some more over under again water stone light paper green river table window garden morning".split()
BAD = ["idiot", "moron", "worthless", "pathetic"]


@pytest.fixture(scope="module")
def model():
    rnd = random.Random(1)
    text = " ".join(rnd.choice(WORDS + BAD) for _ in range(20_000)).encode()
    return toxicity.CharModel(toxicity.trigram_counts(np.frombuffer(text, np.uint8), np.array([0, len(text)])))


@pytest.mark.parametrize("seen,meant", [("1d10t", "idiot"), ("i d i o t", "idiot"), ("mooooron", "moron"), ("w.o.r.t.h.l.e.s.s", "worthless"), ("p4th3t1c", "pathetic"), ("river", "river")])
def test_restores_swapped_spaced_and_repeated(model, seen, meant):
    assert model.restore(seen) == meant


def test_viterbi_finds_the_cheapest_path(model):
    def cost(token, path):
        total, a, b = 0.0, 0, 0
        for emit, channel in path:
            total += channel
            if emit:
                c = toxicity._CODE.get(emit, 0 if emit == " " else 27)
                total += model.cost[a][b][c]
                a, b = b, c
        return total + model.cost[a][b][0]

    for token in ("1d10t", "m0r.0n", "a-b1", "ttt0", "é1", ""):
        paths = itertools.product(*[model.options(token, k) for k in range(len(token))])
        best = min(paths, key=lambda p: cost(token, p))
        got = model.restore(token)
        same = [p for p in itertools.product(*[model.options(token, k) for k in range(len(token))]) if "".join(e for e, _ in p) == got]
        assert abs(min(cost(token, p) for p in same) - cost(token, best)) < 1e-9


def test_very_long_tokens_are_decoded_whole(model):
    assert set(model.restore("x" * 20_000)) <= {"x"}
    assert toxicity.restored_words("a1b" * 5_000, model, {})


def test_trigrams_stay_in_rows():
    data = np.frombuffer(b"abcd", np.uint8)
    both, apart = toxicity.trigram_counts(data, np.array([0, 4])), toxicity.trigram_counts(data, np.array([0, 2, 4]))
    abc = (1 << 10) + (2 << 5) + 3
    assert both[abc] == 1 and apart[abc] == 0 and apart[(1 << 5) + 2] == 1


def corpus(spark, n=900):
    rnd = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        words = [rnd.choice(WORDS) + rnd.choice(["", "s", "ed"]) for _ in range(rnd.randrange(5, 60))]
        toxic = int(rnd.random() < 0.2)
        if toxic:
            for _ in range(2):
                w = rnd.choice(BAD)
                words.insert(rnd.randrange(len(words)), rnd.choice([w, w, w.replace("o", "0").replace("i", "1"), " ".join(w)]))
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def test_op1_held_out_accuracy(spark, store):
    docs, labels, truth = corpus(spark)
    rows = queries.op1_deobfuscated_toxicity(spark, store(documents=docs, labels=labels)).collect()
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97


def test_held_out_labels_are_never_learnt(spark):
    docs, labels, truth = corpus(spark, 300)
    turned = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 3 = 1 then 1 - toxic else toxic end as toxic")
    score = lambda lab: {r.doc_id: r.score for r in toxicity.score_toxicity(docs, lab).collect()}
    assert score(labels) == score(turned)


def test_op1_edges(edge, empty, store, spark):
    labels = spark.createDataFrame([(1, 0), (2, 1), (5, 0), (None, 1), (7, None), (99, 1)], "doc_id long, toxic int")
    rows = queries.op1_deobfuscated_toxicity(spark, store(documents=edge, labels=labels)).collect()
    assert len(rows) == edge.count() and all(r.score is not None and r.held_out is not None for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    assert queries.op1_deobfuscated_toxicity(spark, store(documents=empty, labels=labels)).count() == 0
    assert {r.predicted for r in queries.op1_deobfuscated_toxicity(spark, store(documents=edge, labels=labels.limit(0))).collect()} == {0}


def test_features_ignore_case_and_slicing():
    rows, found = toxicity.features(*toxicity.tx.string_parts(pa.array(["Morons, MORONS", None, "moronic"])))
    assert set(found[rows == 0]) & set(found[rows == 2]) and not (rows == 1).any()


FORMS = ["you i d i o t.", "i d i o t, go", '"i d i o t"', "(i d i o t)", "i d i o t!", "i  d  i  o  t", "i\td\ti\to\tt", "i\nd\ni\no\nt", "i - d - i - o - t", "i--d--i--o--t", "i/d/i/o/t", "i,d,i,o,t", "iiddiioott", "idi0+", "1d10t!", "(1d10t)", "!d10t", "i d i o t. a man", "you are a i d i o t", "id--iot", "i\xa0d\xa0i\xa0o\xa0t"]


@pytest.mark.parametrize("seen", FORMS)
def test_disguised_forms_are_decoded_in_texts(model, seen):
    assert toxicity.pc.match_substring_regex(pa.array([seen]), toxicity.DISTURBED)[0].as_py()
    assert any(w.startswith("idiot") for w in toxicity.restored_words(seen, model, {}).split())


def test_short_words_and_word_ends(model):
    for seen, meant in (("t h e.", "the"), ("o f, t h e", "the"), ("a riv3r", "river"), ("tabl3", "table"), ("light mooron", "moron"), ("w4ter+", "water")):
        assert any(w.startswith(meant) for w in toxicity.restored_words(seen, model, {}).split()), seen
    assert toxicity.restored_words("the green table.", model, {}) == ""


def test_long_signs_and_words_take_linear_time(model):
    assert toxicity.restored_words("(" * 200_000, model, {}) == "" and toxicity.restored_words("ab" * 200_000, model, {}) == ""


def test_disguised_forms_score_as_the_word(spark):
    docs, labels, _ = corpus(spark)
    more = spark.createDataFrame([(10_000 + k, f"the water and stone {t} of light") for k, t in enumerate(["idiot", *FORMS, "paper"])], "doc_id long, text string")
    score = {r.doc_id: r.score for r in toxicity.score_toxicity(docs.unionByName(more), labels).filter("doc_id >= 10000").collect()}
    assert score[10_000] >= 0.7 > score[10_001 + len(FORMS)]
    assert [t for k, t in enumerate(FORMS) if score[10_001 + k] < 0.7] == []


def test_a_megabyte_without_a_match_and_with_one():
    model = toxicity.CharModel(np.zeros(1 << 15))
    for token, restored in (("xyzabc" * 170_000, 0), ("1" * 1_000_000, 0), ("abba" * 250_000, 1)):
        assert bool(toxicity.restored_words(token, model, {})) == bool(restored)


def test_an_id_that_occurs_often_is_one_labelled_row(spark):
    docs = spark.range(3000).selectExpr("id % 3 AS doc_id", "concat('text ', id) AS text")
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 0)], "doc_id long, toxic int")
    counts = toxicity.corpus_trigrams(docs)
    seen = []
    real, toxicity.fit = toxicity.fit, lambda sets, toxic: seen.append(len(sets)) or real(sets, toxic)
    try:
        toxicity.train(docs, labels, counts)
    finally:
        toxicity.fit = real
    assert seen[0] <= 3
