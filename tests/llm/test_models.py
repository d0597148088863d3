"""Toxicity lexicon and quality discriminant."""

import random
import zlib

import numpy as np
from llm_helpers import edge_docs, no_docs, prose

from tollstream.llm import quality, toxicity
from tollstream.llm.shared import table, training_fold

SF = "/root/testdata/sf0.1"


def auc(label, score):
    order = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1.0
    n1 = int(label.sum())
    return (order[label == 1].sum() - n1 * (n1 + 1) / 2) / n1 / (len(label) - n1)


def held_out(spark, query, label):
    got = query(spark, SF).toPandas()
    assert len(got) == table(spark, SF, "documents").count()
    assert got["score"].between(0, 1).all()
    assert (got["held_out"] == got["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    labels = table(spark, SF, "labels").toPandas().drop_duplicates("doc_id")
    both = got.merge(labels, on="doc_id")
    both = both[both["held_out"]]
    return auc(both[label].to_numpy(), both["score"].to_numpy())


def test_quality_held_out(spark):
    assert held_out(spark, quality.query, "quality") > 0.97


def test_toxicity_held_out(spark):
    assert held_out(spark, toxicity.query, "toxic") > 0.85


def test_discriminant_matches_plain_formula():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, (80, 4)), rng.normal(1, [1, 2, 0.5, 1], (120, 4))])
    y = np.repeat([0, 1], [80, 120])
    model = quality.fit_discriminant(x, y, 0.3, 0.1)
    z = (x - x.mean(0)) / (x.std(0) + 1e-6)
    pooled = sum(np.cov(z[y == k], rowvar=False) * (y == k).sum() for k in (0, 1)) / len(z)
    density = []
    for k in (0, 1):
        c = 0.7 * np.cov(z[y == k], rowvar=False) + 0.3 * pooled
        c = 0.9 * c + 0.1 * np.diag(np.diag(c)) + 1e-3 * np.eye(4)
        d = z - z[y == k].mean(0)
        density.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d) - 0.5 * np.linalg.slogdet(c)[1]
                       + np.log((y == k).mean()))
    want = 1 / (1 + np.exp(density[0] - density[1]))
    assert np.allclose(model.score(x), want)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, label int")


def test_odd_rows(spark):
    docs = edge_docs(spark)
    some = labels(spark, [(1, 1, 0, 0), (2, 0, 1, 0), (3, None, None, 0), (None, 1, 1, 0), (6, 1, 0, 0), (6, 1, 0, 0),
                          (8, 0, 1, 0), (11, 1, 0, 0), (9, 0, 1, 0), (99, 1, 1, 0)])
    for module, name in ((quality, "quality"), (toxicity, "toxic")):
        for given in (some, labels(spark, [])):
            model = module.fit(docs, given, name)
            out = module.score(docs, model)
            assert out.count() == docs.count()  # score replaces the column of that name
            assert all(0 <= r["score"] <= 1 for r in out.collect())
            same = {r["score"] for r in out.where("doc_id in (6, 7) and text is not null").collect()}
            assert len(same) == 1
            assert module.score(no_docs(spark), model).count() == 0


def test_folding():
    assert toxicity.fold("1D10T") == "idiot"
    assert toxicity.fold("ıdiot".replace("ı", "і")) == "idiot"  # Cyrillic i
    assert toxicity.fold("ｓｃｕｍ") == "scum"
    assert toxicity.fold("5cum tr@sh cl0wn") == "scum trash clown"
    assert toxicity.fold("in 2024, 50 of 10") == "in 2024, 50 of 10"


def test_lexicon_learns_words_and_beginnings(spark):
    rng = random.Random(2)
    docs, marks = [], []
    for i in range(400):
        toxic = i % 4 == 0
        words = prose(i, 30).split()
        if toxic:
            words.insert(rng.randrange(30), rng.choice(["grumbol", "Grumb0l", "vexa" + rng.choice("bcdfgh") + "o"]))
        if i % 7 == 1:
            words.insert(3, "nice grumbol pie")
        docs.append((i, " ".join(words)))
        marks.append((i, 1, int(toxic)))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lexicon = toxicity.fit(d, spark.createDataFrame(marks, "doc_id long, quality int, toxic int"),
                           exceptions=("nice grumbol pie",), least_weight=1.0)
    assert "vex" in lexicon.weights and "grumbol|" in lexicon.weights
    hit = lambda t: lexicon.features(t)[0] > 0
    assert hit("you grumbol") and hit("you GRUMB0L!") and hit("vexazzz") and not hit("xgrumbol") and not hit("grumbols")
    assert not hit("a nice grumbol pie") and hit("a nice grumbol pie, grumbol")
    short, long = "you grumbol", "you grumbol " + "fine words " * 200
    assert lexicon.features(short)[1] > lexicon.features(long)[1]


def test_machine_matches_plain_search():
    weights = {"abc|": 1.0, "ab": 0.5, "xyz": 2.0, "b|": 3.0}
    lexicon = toxicity.Lexicon(dict(weights), ("ab stone",), (0.0, 1.0, 0.0, 0.0))
    for text in ("abc abd xyzz b bb", "ab stone ab", "", "zzz", "b b b xyz-abc"):
        words = toxicity._WORD.findall(toxicity.fold(text))
        total = 0.0
        for k, w in enumerate(words):
            if words[k:k + 2] == ["ab", "stone"]:
                continue
            total += max([v for e, v in weights.items() if (w == e[:-1] if e.endswith("|") else w.startswith(e))],
                         default=0.0)
        assert np.isclose(lexicon.features(text)[0], np.log1p(total))


def test_repeated_rows_of_a_labelled_id_count_once(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, "one text")] * 50 + [(1, "another")] + [(k, f"text {k}") for k in range(2, 20)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 20)], "doc_id long, quality int")
    rows = quality.labelled_sample(docs, labels, "quality", 5000).collect()
    ids = {r["doc_id"] for r in labels.where(training_fold(F.col("doc_id"))).collect()}
    assert 1 in ids and len(rows) == len(ids)
    assert len(quality.labelled_sample(docs, labels, "quality", 5).collect()) == 5


def test_excused_hits_are_linear_in_the_text():
    """Very long texts full of excused phrases."""
    import time

    lexicon = toxicity.Lexicon({"ab|": 1.0, "stone": 0.5}, ("ab stone", "stone ab stone"), (0.0, 1.0, 0.0, 0.0))
    text = "ab stone other " * 43000  # 129 000 words
    began = time.process_time()
    assert lexicon.features(text)[0] == 0.0
    assert time.process_time() - began < 2
    assert lexicon.features("stone ab stone ab stone")[0] == 0.0
    assert lexicon.features("ab stone ab")[0] == np.log1p(1.0)
