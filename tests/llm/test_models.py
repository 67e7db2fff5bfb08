"""The trained classifiers: held-out accuracy, gradients, odd rows."""

import random
import zlib

import numpy as np
import pytest

from countypanel.llm import quality, toxicity
from countypanel.llm.common import held_out, training_rows

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labelled(spark, documents):
    rng = random.Random(5)
    names = [f"name{i}" for i in range(300)]

    def text(kind):
        words = [rng.choice(names) for _ in range(rng.randint(20, 300))]
        if kind == "junk":
            words = [w.upper() + "!!" for w in words]
        if kind == "toxic":
            words[5:5] = ["you", "snarf", "gribble" + rng.choice(["ing", "ed", "s"])]
        return " ".join(words)

    kinds = [rng.choice(["fine", "fine", "junk", "toxic"]) for _ in range(700)]
    docs = documents([*enumerate(map(text, kinds)), (900, None), (901, ""), (None, text("junk")), (902, "x" * 300_000), (0, text(kinds[0]))])
    labels = spark.createDataFrame(
        [(i, int(k != "junk"), int(k == "toxic"), 1) for i, k in enumerate(kinds)] + [(None, 1, 1, 1), (700, None, None, 1), (1, 5, 5, 1)],
        "doc_id bigint, quality int, toxic int, text int",
    )
    return docs, labels, kinds


def test_training_rows_are_bounded_and_never_held_out(labelled):
    docs, labels, _ = labelled
    rows = training_rows(docs, labels, "quality", 100)
    assert rows.select("doc_id").distinct().count() == 100 and rows.where(held_out()).count() == 0


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_models_tell_made_up_classes_apart(labelled, module, label):
    docs, labels, kinds = labelled
    model = module.fit(docs, labels)
    rows = module.scored(docs, model).withColumn("held", held_out()).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    want = {i: (k != "junk") if label == "quality" else k == "toxic" for i, k in enumerate(kinds)}
    held = [r for r in rows if r.held and r.doc_id in want]
    right = sum((r.score >= module.THRESHOLD) == want[r.doc_id] for r in held)
    assert len(held) > 100 and right >= 0.97 * len(held)
    keep = module.keep_good if label == "quality" else module.keep_civil
    kept = keep(docs, model)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    assert kept.where("doc_id < 700").count() < docs.where("doc_id < 700").count()


@pytest.mark.parametrize("module", [quality, toxicity])
def test_models_without_labels_give_a_constant(labelled, module):
    docs, labels, _ = labelled
    for some in (labels.limit(0), labels.where("quality = 1 AND toxic = 0")):
        scores = {r.score for r in module.scored(docs, module.fit(docs, some)).collect()}
        assert len(scores) == 1 and 0 <= scores.pop() <= 1
    assert module.scored(docs.limit(0), module.fit(docs, labels.limit(0))).count() == 0


def test_gradients_lower_the_loss():
    rng = np.random.default_rng(1)
    bags = [rng.random((rng.integers(1, 5), quality.FEATURES)).tolist() for _ in range(60)]
    labels = [int(max(p[0] for p in b) > 0.8) for b in bags]
    loss = []
    for rounds in (1, 30, 300):
        p = quality.train(bags, labels, rounds=rounds).score(bags)
        loss.append(-np.mean(np.where(np.array(labels) == 1, np.log(p), np.log(1 - p))))
    assert loss[0] > loss[1] > loss[2]


def test_a_passage_counts_wherever_it_stands():
    bags = [quality.passages(" ".join(["word"] * 64 * a + ["JUNK!!"] * 64 + ["word"] * 64 * b)) for a, b in ((0, 3), (3, 0), (1, 2))]
    model = quality.train([*bags, *[quality.passages("word " * 256 + f"x{i}") for i in range(3)]], [0, 0, 0, 1, 1, 1])
    assert np.ptp(model.score(bags)) < 1e-6


def test_passages_tell_words_and_their_order_apart(monkeypatch):
    a, b, c = (quality.passages(t)[0, quality.SHAPES :] for t in ("red green blue grey", "grey blue green red", "one four nine sixteen"))
    assert 1 > a @ b > a @ c and all(abs(x @ x - 1) < 1e-5 for x in (a, b, c))
    words = [f"w{i}" for i in range(200)] * 40
    split = quality.passages(" ".join(words) + " ñandú 中文")
    many = quality.bags([" ".join(words[:n]) for n in (0, 1, 64, 65, 8_000)])
    assert [len(m) for m in many] == [1, 1, 1, 2, 125] and not many[0][:, quality.SHAPES :].any()
    assert np.array_equal(quality.passages(" ".join(words)), many[4])  # whatever else is encoded with it
    monkeypatch.setattr(quality, "RUNS_AT_ONCE", 7)
    assert np.allclose(quality.passages(" ".join(words) + " ñandú 中文"), split)


def test_hashed_words_are_those_of_brute_force():
    words = ["a", "ñandú", "word" * 30, "it's", "中文字"]
    codes, table = quality._word_table(words)
    for w, code, row in zip(words, codes, table, strict=True):
        raw = b" " + w.encode() + b" "
        want = np.zeros(quality.HASHED)
        for c in [int(code), *(int.from_bytes(raw[i : i + 3]) for i in range(len(raw) - 2))]:
            mixed = c * 0x9E3779B97F4A7C15 % (1 << 64)
            want[(mixed >> 40) % quality.HASHED] += 1 - 2 * (mixed >> 63)
        assert np.array_equal(row, want) and code == zlib.crc32(w.encode())


def test_scores_are_those_of_networks_trained_by_hand(labelled):
    """Brute force: the same networks from the same shards, one document at a time."""
    docs, labels, _ = labelled
    model = quality.fit(docs, labels, max_rows=200, shards=2)
    rows = training_rows(docs, labels, "quality", 200).selectExpr("doc_id", "text", "label", "pmod(xxhash64(doc_id), 2) AS shard").collect()
    hand = []
    for shard in (0, 1):
        part = sorted((r.doc_id, r.text, r.label) for r in rows if r.shard == shard)
        hand.append(quality.train([quality.passages(t) for _, t, _ in part], [y for _, _, y in part]))
    got = {r.doc_id: r.score for r in quality.scored(docs.where("doc_id BETWEEN 1 AND 60"), model).collect()}
    for r in docs.where("doc_id BETWEEN 1 AND 60").collect():
        bag, total = quality.passages(r.text), 0.0
        for net in hand:
            x = np.clip((bag - net.mean) / net.scale, -8, 8)
            h = np.tanh(x @ net.weights["E"] + net.weights["e"])
            raw = (np.tanh(h @ net.weights["V"]) / (1 + np.exp(-(h @ net.weights["U"])))) @ net.weights["a"]
            a = np.exp(raw) / np.exp(raw).sum()
            total += 1 / (1 + np.exp(-((a @ h) @ net.weights["c"] + net.weights["b"])))
        assert got[r.doc_id] == pytest.approx(total / 2, abs=1e-4)


@pytest.mark.parametrize("query, label, least", [(quality.op10_quality, "quality", 0.95), (toxicity.op9_toxicity, "toxic", 0.95)])
def test_held_out_accuracy_on_the_tables(spark, query, label, least):
    got = query(spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label)
    rows = got.where("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r[label] for r in rows) >= least * len(rows)


def test_lexicon_words_are_found_behind_stand_ins():
    own = toxicity.Measure(["idiot"], [])
    assert own.features("you 1d10t")[10] > 0 and own.features("iiidiooot!")[10] > 0 and own.features("i.d.i.o.t")[10] > 0
    assert own.features("an idea 1d")[10] == 0
    near, far = own.features("you idiot " + "word " * 50), own.features("you " + "word " * 50 + "idiot")
    assert near[3] > far[3] > 0
