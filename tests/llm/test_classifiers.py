"""Language, quality and toxicity: held-out accuracy, learning rules, odd inputs."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from tallybook.llm import components, language_id, quality_classifier, queries, sampling, toxicity
from tallybook.session import materialise
from tests.llm.conftest import odd_rows, prose

SF = "/root/testdata/sf0.01"


def remainder(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


@pytest.fixture(scope="module")
def tables(spark):
    queries.prepare(spark)
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")


def test_language_of_held_out_texts(spark, tables):
    lang = {r["doc_id"]: r["lang"] for r in tables("documents").select("doc_id", "lang").collect()}
    rows = queries.op3_language_id(spark, SF).collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (remainder(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 for r in rows)
    right = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]
    assert np.mean(right) > 0.97


def test_kernel_is_shared_ngrams_over_root_of_sizes():
    texts = ["abc abc", "xbc", "déjà", ""]
    grams = list(language_id.Grams(pa.array(texts)).distinct())

    def plain(text):
        symbols = language_id._SYMBOL[np.frombuffer(text.encode(), np.uint8)].tolist()
        return {tuple(symbols[i : i + n]) for n in (1, 2, 3) for i in range(len(symbols) - n + 1)}

    sets = [plain(t) for t in texts]
    assert [len(g) for g in grams] == [len(s) for s in sets]
    model = language_id.Classifier.fit(grams[:3], ["a", "b", "c"], landmarks=3)
    kernels = model.kernels(grams[:3], [len(g) for g in grams[:3]])
    want = [[len(x & y) / np.sqrt(len(x) * len(y)) for y in sets[:3]] for x in sets[:3]]
    assert np.allclose(kernels, want, atol=1e-6)


def test_language_of_odd_texts(odd, none):
    rows = language_id.predicted(odd).collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        if r["doc_id"] in (4, 5, 6):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("en", "und")
    assert language_id.predicted(none).count() == 0
    unlabelled = odd.withColumn("lang", odd["lang"].substr(9, 1).cast("int").cast("string"))
    assert {r["lang_pred"] for r in language_id.predicted(unlabelled.filter("false")).collect()} == set()
    assert {r["lang_pred"] for r in language_id.predicted(odd.filter("lang IS NULL")).collect()} == {"und"}


def test_no_letter_is_und():
    found = language_id.has_letter(pa.array(["123 !?", "1a", "—…", "é", "日", None, "Z", "[`{@"]))
    assert found.tolist() == [False, True, False, True, True, False, True, False]


def scored(rows, truth, modulus, held):
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (remainder(r["doc_id"], modulus) == held) for r in rows)
    known = [(truth[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    return np.array(known)


def test_quality_of_held_out_documents(spark, tables):
    truth = {r["doc_id"]: r["quality"] for r in tables("labels").collect()}
    found = scored(queries.op4_quality_classifier(spark, SF).collect(), truth, 3, 1)
    assert (found[:, 0] == found[:, 1]).mean() > 0.95


def test_toxicity_of_held_out_documents(spark, tables):
    truth = {r["doc_id"]: r["toxic"] for r in tables("labels").collect()}
    found = scored(queries.op6_toxicity(spark, SF).collect(), truth, 5, 0)
    assert (found[:, 0] == found[:, 1]).mean() > 0.93
    assert found[found[:, 0] == 0][:, 1].mean() < 0.03


def numeric(loss, weight, place, step=1e-3):
    weight[place] += step
    above = loss()
    weight[place] -= 2 * step
    below = loss()
    weight[place] += step
    return (above - below) / (2 * step)


def test_gradients_of_the_attention_model():
    features, first = quality_classifier.encode(pa.array(["a b! " * 90, "C D ", "x | y " * 200]))
    goal = np.array([1.0, 0.0, 1.0])
    model = quality_classifier.Model.start(features)

    def loss():
        p = model.forward(features, first)["out"]
        return -np.mean(goal * np.log(p) + (1 - goal) * np.log(1 - p))

    grads = model.gradients(model.forward(features, first), first, goal)
    for name, weight in model.weights.items():
        place = tuple(np.array(weight.shape) // 2)
        assert np.isclose(numeric(loss, weight, place), grads[name][place], rtol=1e-3, atol=1e-7), name


def test_attention_sums_to_one_and_pools():
    features, first = quality_classifier.encode(pa.array([prose(1, 300), "", None, prose(2, 64)]))
    assert np.diff(first).tolist() == [5, 1, 1, 1]
    found = quality_classifier.Model.start(features).forward(features, first)
    assert np.allclose(np.add.reduceat(found["att"], first[:-1]), 1)


def test_gradients_of_the_recurrent_network():
    read = toxicity.Read.of(pa.array(["you bad a b c", "hello world good", "bad x " * 30]))
    net = toxicity.Network(np.sort(read.identity)[:4], np.zeros(4), np.zeros(toxicity.GRAMS))
    net.p = {k: v.astype(float) for k, v in net.p.items()}
    start, length, _ = read.windows()
    steps, mask = toxicity._steps(read, start, length)
    vectors, goal = net.vectors(read).astype(float), np.arange(len(start)) % 2

    def passed():
        return net.forward([vectors @ net.p[f"w{w}"] + net.p[f"b{w}"] for w in (0, 1)], steps, mask)

    def loss():
        p = toxicity._sigmoid(passed()["logit"])
        return -(goal * np.log(p) + (1 - goal) * np.log(1 - p)).sum()

    kept = passed()
    grads, inputs = net.backward(kept, toxicity._sigmoid(kept["logit"]) - goal, mask)
    for way, to_x in enumerate(inputs):
        flat = np.zeros((len(vectors), to_x.shape[2]))
        np.add.at(flat, steps.reshape(-1), to_x.reshape(-1, to_x.shape[2]))
        grads[f"w{way}"] = vectors.T @ flat
    for name, grad in grads.items():
        place = tuple(np.array(grad.shape) // 2)
        assert np.isclose(numeric(loss, net.p[name], place, 1e-2), grad[place], rtol=0.05, atol=2e-4), name


def test_windows_cover_every_word():
    texts = ["", "a", "b " * 32, "c " * 33, "d " * 500]
    read = toxicity.Read.of(pa.array(texts))
    start, length, first = read.windows()
    for i, text in enumerate(texts):
        n = len(text.split())
        covered = {k for a, m in zip(start[first[i] : first[i + 1]], length[first[i] : first[i + 1]], strict=True)
                   for k in range(a - read.offsets[i], a - read.offsets[i] + m)}
        assert covered == set(range(n))


def test_odd_inputs(odd, none, labels):
    for predicted in (quality_classifier.predicted, toxicity.predicted):
        rows = predicted(odd, labels).collect()
        assert len(rows) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in rows)
        assert {r["score"] for r in predicted(odd, labels.filter("false")).collect()} == {0.5}
        assert predicted(none, labels).count() == 0
    one_kind = labels.filter("toxic = 1")
    assert {r["score"] for r in toxicity.predicted(odd, one_kind).collect()} == {1.0}
    assert quality_classifier.with_scores(odd, None, "score").filter("score = 0.5").count() == len(odd_rows())


def test_labels_without_documents_count_for_nothing(spark, tables):
    docs = tables("documents")
    there = docs.select("doc_id").limit(40).collect()
    one_kind = spark.createDataFrame([(r["doc_id"], 1, 1) for r in there], "doc_id long, quality int, toxic int")
    absent = spark.createDataFrame([(10**9 + i, 0, 0) for i in range(500)], one_kind.schema)
    rows, counts = sampling.labelled_sample(docs, one_kind.unionByName(absent), "quality", 100)
    assert counts == {1: 40} and rows.count() == 40
    found = quality_classifier.predicted(docs, one_kind.unionByName(absent)).collect()
    assert len(found) == docs.count() and all(r["predicted"] == 1 for r in found)
    none = quality_classifier.predicted(docs, absent).collect()
    assert {r["score"] for r in none} == {0.5}


def test_a_hot_id_gives_no_more_than_its_share(spark):
    hot = spark.range(3000).selectExpr("cast(7 as long) doc_id", "concat('text ', id) text")
    copies = spark.range(3000).selectExpr("cast(8 as long) doc_id", "'same' text")
    labels = spark.createDataFrame([(7, 1), (8, 0)], "doc_id long, quality int")
    rows, counts = sampling.labelled_sample(hot.unionByName(copies), labels, "quality", 200)
    assert counts == {0: 1, 1: 3000}
    kinds = {r[0]: r[1] for r in rows.groupBy("goal").count().collect()}
    assert kinds[0] == 1 and 60 < kinds[1] < 150


def test_links_that_do_not_settle_end_the_job(spark):
    chain = spark.range(40).selectExpr("id a", "id + 1 b")
    with pytest.raises(RuntimeError, match="settled"):
        components.components(chain, most_rounds=2)
    assert {r["root"] for r in components.components(chain).collect()} == {0}


def test_a_sample_is_chosen_from_few_files_however_many_tasks_join(spark, tables, monkeypatch):
    many = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in many}
    written = []

    def kept(df, label):
        written.append(materialise(df, label))
        return written[-1]

    monkeypatch.setattr(sampling, "materialise", kept)
    try:
        for key, value in many.items():
            spark.conf.set(key, value)
        rows, counts = sampling.labelled_sample(tables("documents"), tables("labels"), "toxic", 100)
        assert rows.count() and sum(counts.values()) == written[0][1]
        assert len(written[0][0].inputFiles()) <= sampling.LEAST_FILES
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
