"""Classifiers: exact counts, gradients, held-out accuracy, degenerate labels."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import features, ordinal_quality, quality_rules, toxicity
from strata.llm.labelled import sample
from tests.llm.helpers import awkward, empty, frame

SF = "/root/testdata/sf0.01"


def _tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = labels.where("doc_id % 4 = 1")
    return docs, labels.where("doc_id % 4 <> 1"), held


def _slow_counts(text):
    words = text.encode().split()
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def test_counts():
    texts = [t or "" for _, t in awkward() if t is None or len(t) < 5000]
    texts += ["a b c a b c", "a a a a", "a b c d", "x\n\nx\n x\nx", "é é é é é é é"]
    for t in texts:
        assert quality_rules.counts_of(t.encode()) == _slow_counts(t)


def _slow_features(text, bits):
    rows = features.hashed([text], bits, chars=True)
    return dict(zip(rows.index.tolist(), rows.value.tolist(), strict=True))


def test_features_do_not_depend_on_neighbours_and_keep_filters():
    texts = [(t or "").encode() for _, t in awkward()][:10] + [b"", b"\0", b"a\0b"]
    rows = features.hashed(texts, 16, chars=True)
    keep = np.zeros(1 << 16, bool)
    keep[::3] = True
    some = features.hashed(texts, 16, chars=True, keep=keep)
    for k, t in enumerate(texts):
        one = {int(i): v for i, v in zip(rows.index[rows.start[k]:rows.start[k + 1]],
                                         rows.value[rows.start[k]:rows.start[k + 1]], strict=True)}
        assert one == _slow_features(t, 16)
        two = {int(i): v for i, v in zip(some.index[some.start[k]:some.start[k + 1]],
                                         some.value[some.start[k]:some.start[k + 1]], strict=True)}
        assert two == {i: v for i, v in one.items() if i % 3 == 0}
    words = features.hashed([b"Good day, good day", b"good DAY , good day"], 16, pairs=False)
    a, b = (words.index[words.start[k]:words.start[k + 1]].tolist() for k in (0, 1))
    assert a == b


def test_ordinal_model_orders_its_thresholds_and_learns():
    rng = np.random.default_rng(0)
    texts, grades = [], []
    for _ in range(600):
        good = rng.integers(0, 10)
        words = ["good"] * good + ["bad"] * (9 - good) + [f"n{rng.integers(50)}" for _ in range(5)]
        texts.append(" ".join(words).encode())
        grades.append(0 if good < 3 else 1 if good < 7 else 2)
    x = ordinal_quality.featurise(texts)
    model = ordinal_quality.fit(x, np.array(grades), columns=64)
    assert (np.diff(model.thresholds) > 0).all()
    tails = model.tails(x)
    assert (tails[:, 0] >= tails[:, 1]).all()
    expected = tails.sum(axis=1)
    assert (np.abs(np.round(expected) - grades) == 0).mean() > 0.85


def test_ordinal_quality_held_out(spark):
    docs, labels, held = _tables(spark)
    out = ordinal_quality.grades(docs, labels, ordinal_quality.graded_labels())
    got = out.join(held, "doc_id").select("kept", "quality").toPandas()
    assert (got.kept == (got.quality == 1)).mean() > 0.93
    assert out.count() == docs.count()


def test_quality_rules_held_out(spark):
    docs, labels, held = _tables(spark)
    out = quality_rules.rules(docs, labels)
    got = out.where("NOT base_failed").join(held, "doc_id").toPandas()
    assert (got.kept == (got.quality == 1)).mean() > 0.93
    assert out.where("base_failed AND kept").count() == 0


def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = labels.where("doc_id % 4 = 1")
    out = toxicity.score(docs, toxicity.categories(labels.where("doc_id % 4 <> 1")),
                         ["toxic", "toxic_prose", "toxic_junk"])
    got = out.join(held, "doc_id").toPandas()
    toxic = got.toxic == 1
    # about a fifth of the labels of toxic documents show nothing of it in the text
    assert got.flagged[toxic].mean() > 0.7
    assert got.flagged[~toxic].mean() < 0.02


def test_chain_feeds_earlier_probabilities():
    rng = np.random.default_rng(1)
    texts = [(b"vile " if i % 3 == 0 else b"") + b"w%d w%d" % tuple(rng.integers(0, 30, 2))
             for i in range(400)]
    y = np.array([[i % 3 == 0, i % 3 == 0] for i in range(400)], float)
    x = toxicity.featurise(texts)
    chain = toxicity.fit(np.arange(400), x, y)
    assert len(chain[1].weights) == len(chain[1].columns) + 2
    assert chain[1].weights[-2] > 0
    p = toxicity.predict(chain, x)
    assert p.shape == (400, 2) and ((p[:, 1] > 0.5) == (y[:, 1] > 0)).all()


# ------------------------------------------------------------------ by plain Python
_M = (1 << 64) - 1


def _mix(h):
    h = ((h ^ h >> 30) * 0xBF58476D1CE4E5B9) & _M
    h = ((h ^ h >> 27) * 0x94D049BB133111EB) & _M
    return h ^ h >> 31


def _plain_features(text, bits, pairs, chars):
    """Counts by column, token by token."""
    raw = (text or "").encode()
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in raw)
    tokens = re.findall(rb"[0-9a-z_\x80-\xff]+|[!-/:-@\[-^`{-~]+", low)
    code = [_mix(sum((c + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, c in enumerate(t)) & _M)
            for t in tokens]
    out = Counter(h % (1 << bits) for h in code)
    for i in range(1, len(code)):
        if pairs:
            out[_mix((code[i - 1] * 3 + code[i]) & _M) % (1 << bits)] += 1
        if code[i] == code[i - 1] and re.match(rb"[0-9a-z_\x80-\xff]", tokens[i]):
            out[0] += 1
    if chars:
        for n in (3, 4):
            for i in range(len(low) - n + 1):
                if 0 not in low[i:i + n]:
                    gram = int.from_bytes(low[i:i + n], "big")
                    out[_mix((gram + (n << 56)) & _M) % (1 << bits)] += 1
    return out


def _plain_dot(counts, columns, weights):
    v = {c: math.log1p(counts[c]) for c in columns.tolist() if c in counts}
    norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
    return sum(x / norm * w for c, w in zip(columns.tolist(), weights.tolist(), strict=True)
               if (x := v.get(c)))


def _sigmoid(z):
    return 1 / (1 + math.exp(-z))


def _small(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars < 1500 AND doc_id < 500")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    return docs.unionByName(frame(spark, [(None, None), (-1, ""), (-2, "No no NO!! x_1 é")]).select(
        "doc_id", "text", "lang", "n_chars"), allowMissingColumns=True), labels


def test_grades_equal_plain_python(spark):
    docs, labels = _small(spark)
    grade = ordinal_quality.graded_labels()
    model = ordinal_quality.train(docs, labels, grade)
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1]
    got = {r.doc_id: r for r in ordinal_quality.grades(docs, labels, grade).collect()}
    assert len({r.kept for r in got.values()}) == 2
    for r in docs.collect():
        z = _plain_dot(_plain_features(r.text, ordinal_quality.BITS, False, False),
                       model.columns, model.weights)
        tails = [_sigmoid(z - t) for t in model.thresholds]
        assert got[r.doc_id].expected_grade == pytest.approx(sum(tails), abs=1e-6)
        assert got[r.doc_id].tail_probability == pytest.approx(tails[0], abs=1e-6)
        assert got[r.doc_id].kept == (got[r.doc_id].tail_probability >= 0.5)


def test_quality_rules_equal_plain_python(spark):
    docs, labels = _small(spark)
    model = quality_rules.train(docs, labels)
    got = {r.doc_id: r for r in quality_rules.rules(docs, labels).collect()}
    assert len({r.kept for r in got.values()}) == len({r.base_failed for r in got.values()}) == 2
    for r in docs.collect():
        g = got[r.doc_id]
        counts = _slow_counts(r.text or "")
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == counts
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        z = _plain_dot(_plain_features(r.text, quality_rules.BITS, True, True), model.columns,
                       model.weights[:-1]) + model.weights[-1]
        p = _sigmoid(model.slope * z + model.shift)
        assert g.probability == pytest.approx(p, abs=1e-6)
        assert (g.base_failed, g.kept) == (failed, not failed and g.probability >= 0.5)


def test_toxicity_equals_plain_python(spark):
    docs, labels = _small(spark)
    names = ["toxic_prose", "toxic_junk", "toxic"]
    each = toxicity.categories(labels)
    chain = toxicity.fit(*sample(docs, each, names, toxicity.SAMPLE_ROWS, toxicity.featurise))
    got = {r.doc_id: r for r in toxicity.score(docs, each, names).collect()}
    for r in docs.collect():
        counts, p = _plain_features(r.text, toxicity.BITS, False, False), []
        for link in chain:
            k = len(link.columns)
            z = _plain_dot(counts, link.columns, link.weights[:k]) + link.weights[-1]
            p.append(_sigmoid(z + sum(a * w for a, w in zip(p, link.weights[k:-1], strict=True))))
        g = got[r.doc_id]
        assert [g.p_toxic_prose, g.p_toxic_junk, g.p_toxic] == pytest.approx(p, abs=1e-6)
        assert g.flagged == (g.p_toxic >= toxicity.THRESHOLD)
    assert any(got[d].flagged for d in got)


def test_toxic_verdict_comes_through_the_chain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = labels.where("doc_id % 4 = 1").select("doc_id", "toxic")
    each = toxicity.categories(labels.where("doc_id % 4 <> 1"))
    out = {}
    for names in (["toxic_prose", "toxic_junk", "toxic"], ["toxic"]):
        scored = toxicity.score(docs, each, names).join(held, "doc_id", "left").toPandas()
        out[len(names)] = scored.set_index("doc_id").sort_index()
    # cutting the earlier links off changes verdicts, and for the worse
    assert (out[3].flagged != out[1].flagged).sum() > 20
    recall = {k: g.flagged[g.toxic == 1].mean() for k, g in out.items()}
    wrong = {k: g.flagged[g.toxic == 0].mean() for k, g in out.items()}
    assert recall[3] >= recall[1] > 0.9 and wrong[3] <= wrong[1] < 0.01


def test_sample_takes_the_smallest_text_hash_of_an_id(spark):
    rows = [(i % 20, f"word{i} text{i % 7}") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)],
                                   "doc_id long, quality int, toxic int")
    seen = []
    for parts in (1, 5):
        docs = frame(spark, rows).repartition(parts, "text")
        ids, x, y = sample(docs, labels, ["quality"], 15, toxicity.featurise)
        assert len(ids) == 15
        seen.append((ids.tolist(), x.index.tolist(), y.tolist()))
    assert seen[0] == seen[1]


@pytest.mark.parametrize("rows", [[], [(1, 1, 0), (2, 1, 0)], [(1, None, None), (None, 0, 1)],
                                  [(1, 1, 0), (1, 0, 1), (7, 0, 1), (8, 1, 0), (12, 1, 0)]])
def test_few_labels(spark, rows):
    docs = frame(spark, awkward())
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    n = docs.count()
    a = ordinal_quality.grades(docs, labels, ordinal_quality.graded_labels())
    b = quality_rules.rules(docs, labels)
    c = toxicity.score(docs, toxicity.categories(labels), ["toxic", "toxic_prose"])
    assert a.count() == b.count() == c.count() == n
    if len({q for _, q, _ in rows if q is not None}) < 2:
        assert a.where("NOT kept").count() == 0
    d = ordinal_quality.select_good(docs, labels, ordinal_quality.graded_labels())
    assert d.schema == docs.schema
    same = a.groupBy("doc_id").agg(F.countDistinct("tail_probability").alias("n"))
    assert same.where("doc_id = 9 AND n > 1").count() == 0


def test_empty_documents(spark):
    docs = empty(spark)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    assert ordinal_quality.grades(docs, labels, ordinal_quality.graded_labels()).count() == 0
    assert quality_rules.rules(docs, labels).count() == 0
    assert toxicity.score(docs, toxicity.categories(labels), ["toxic"]).count() == 0
