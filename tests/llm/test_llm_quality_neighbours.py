import zlib

import numpy as np
import pandas as pd
import pytest
from llm_rows import ODD_ROWS
from pyspark.sql import functions as F

from tarmac.llm import quality_neighbours as Q
from tarmac.llm.queries import op11_quality_neighbours

GOOD = [f"The {a} of a {b} was {c} and so the {b} went {a} on time. It said {c} again.\nThen {b} left." for a in ("end", "way", "top") for b in ("river", "house", "garden", "book") for c in ("long", "old", "green")]
BAD = [f"{a}### {b}$$$ now%%% {a}### buy&&& {b}$$$ {c}***" for a in ("win", "pay", "get") for b in ("cash", "gold", "loan", "book") for c in ("long", "old", "green")]


def labelled(spark, n_copies=0):
    """Documents and labels; copies of one bad text make up a large part if asked for."""
    texts = [(i, t) for i, t in enumerate([*GOOD, *BAD])]
    texts += [(1000 + i, BAD[0]) for i in range(n_copies)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < len(GOOD))) for i, _ in texts], "doc_id bigint, quality int")
    return docs, labels


def test_held_out_labels_of_the_test_table(spark):
    sf = "/root/testdata/sf0.01"
    found = op11_quality_neighbours(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert found.columns[:4] == ["doc_id", "held_out", "score", "predicted"] and found.count() == docs.count()
    rows = found.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = labelled(spark)
    flipped = labels.withColumn("quality", F.when(Q.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (Q.score(docs, Q.train(docs, known)).collect() for known in (labels, flipped))
    assert one == two and {r.predicted for r in one} == {0, 1}
    assert all(r.predicted == int(r.doc_id < len(GOOD)) for r in one)


def test_votes_like_brute_force(spark):
    docs, labels = labelled(spark)
    model = Q.train(docs, labels)
    x = np.stack([Q.terms(t.encode()) for t in [*GOOD[:5], *BAD[:5], "gold of a river"]])
    y = Q.weighted(x, model.idf) @ model.basis
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    want = []
    for row in y:
        cosines = sorted(((float(row @ v), i) for i, v in enumerate(model.vectors)), reverse=True)[: Q.NEIGHBOURS]
        weights = [(min(max(c, 0), 1) ** Q.POWER * model.votes[i], model.labels[i]) for c, i in cosines]
        want.append(sum(w * k for w, k in weights) / sum(w for w, _ in weights))
    assert np.allclose(model.scores(x), want, atol=1e-4)


def test_the_space_keeps_cosines_of_training_texts(spark, monkeypatch):
    monkeypatch.setattr(Q, "LATENT", 1000)
    x = np.stack([Q.terms(t.encode()) for t in [*GOOD[:9], *BAD[:9]]])
    idf = np.ones(Q.DIM, np.float32)
    model = Q.Model(idf, x, np.ones(18))
    w = Q.weighted(x, idf)
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    assert np.allclose(model.vectors @ model.vectors.T, w @ w.T, atol=1e-3)


def test_the_sample_is_bounded_and_copies_count_once(spark):
    docs, labels = labelled(spark, n_copies=500)
    model = Q.train(docs, labels, sample=10)
    assert len(model.labels) == 20 and model.prior == pytest.approx(0.5, abs=0.15)
    whole = Q.train(docs, labels)
    assert len(whole.labels) <= len(GOOD) + len(BAD)
    copies = Q.score(docs.where("doc_id >= 1000"), whole).collect()
    assert len(copies) == 500 and len({r.score for r in copies}) == 1 and copies[0].predicted == 0


def test_odd_rows(spark, docs_of):
    docs, labels = labelled(spark)
    model = Q.train(docs, labels)
    found = Q.score(docs_of(ODD_ROWS), model).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in ODD_ROWS)
    empty = [r.score for r in found if r.doc_id in (2, 3, 4)]
    assert empty == [model.prior] * 3
    odd = labels.unionAll(spark.createDataFrame([(None, 1), (3, None), (4, 7), (5, 0)], "doc_id bigint, quality int")).withColumns({"text": F.lit("x"), "key": F.lit("y")})
    assert Q.score(docs_of(ODD_ROWS), Q.train(docs.unionAll(docs.limit(3)).withColumns({"label": F.lit("x"), "out": F.lit(1)}), odd)).count() == len(ODD_ROWS)


def test_few_or_no_labels(spark, docs_of):
    docs, labels = labelled(spark)
    for known, prior in [(labels.limit(0), 0.5), (labels.where("quality = 1"), 1.0), (labels.where("quality = 0"), 0.0)]:
        found = Q.score(docs, Q.train(docs, known)).collect()
        assert {r.score for r in found} == {prior} and {r.predicted for r in found} == {int(prior >= 0.5)}
    nothing = docs_of([])
    assert Q.score(nothing, Q.train(nothing, labels)).collect() == []


def test_long_texts_in_pieces_count_alike(monkeypatch):
    raw = ("Ab cd, 12.\n" * 500 + "x y ### z").encode()
    whole = Q._shapes(raw)
    for piece in (1, 2, 7, 100):
        monkeypatch.setattr(Q, "PIECE", piece)
        assert (Q._shapes(raw) == whole).all()


def test_term_weights_travel_without_zeros():
    given = [Q.terms(t.encode()) for t in [*GOOD, *BAD, "", "one"]]
    cells = [Q.packed(x) for x in given]
    assert (Q.unpacked(pd.Series(cells)) == np.stack(given)).all() and max(map(len, cells)) < Q.DIM


def test_a_fit_holds_its_vectors_once():
    x = np.stack([Q.terms(t.encode()) for t in [*GOOD, *BAD]])
    want = Q.weighted(x.copy(), idf := np.linspace(1, 2, Q.DIM, dtype=np.float32))
    Q.Model(idf, x, np.arange(len(x)) % 2)
    assert (x == want).all()
