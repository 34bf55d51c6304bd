import hashlib

import pytest

import corpus_pipeline
from llm_rows import ODD_ROWS
from tarmac.llm import decontaminate, language
from test_llm_decontaminate import plain as plain_hits
from test_llm_line_quality import plain as plain_quality
from test_llm_simhash import plain_components, plain_print

SF = "/root/testdata/sf0.001"


def chained(spark, tmp_path, docs, sf_dir):
    """Rows after every stage."""
    rows = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(path := str(tmp_path / name))
        docs = spark.read.parquet(path)
        rows.append(docs.collect())
    return rows


def test_stages_equal_brute_force(spark, tmp_path, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    given, known, good, single, clean, tokens = chained(spark, tmp_path, docs, SF)
    assert all(r.__fields__ == given[0].__fields__ for rows in (known, good, single, clean) for r in rows)

    model = language.train(docs.where(~language.held_out()))
    said = {r["doc_id"]: r for r in language.predict(docs, model).collect()}
    assert {r["doc_id"] for r in known} == {i for i, r in said.items() if r["lang_pred"] != "und" and not r["ambiguous"]}
    assert len(known) > 0.95 * len(given)

    assert {r["doc_id"] for r in good} <= {r["doc_id"] for r in known if not plain_quality(r["text"])[-1]}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in good}
    lost = [r for r in known if labels.get(r["doc_id"]) == 1 and r["doc_id"] not in kept and not plain_quality(r["text"])[-1]]
    assert not lost and not [i for i in kept if labels.get(i) == 0]

    parts = plain_components([plain_print(r["text"]) for r in good])
    assert {r["doc_id"] for r in single} == {min(good[i]["doc_id"] for i in part) for part in parts}

    items = [(str(r["item_id"]), decontaminate.words_of((r["text"] or "").encode())) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = set()
    for row in single:
        words = decontaminate.words_of(row["text"].encode())
        hit, _ = plain_hits(words, [i for i in items if set(i[1]) & set(words)], 13)
        if not hit or 20 * len(hit) < len(words):
            want.add(row["doc_id"])
    assert {r["doc_id"] for r in clean} == want and {r["doc_id"]: r["text"] for r in clean}.items() <= {r["doc_id"]: r["text"] for r in given}.items()

    for text, row in zip((r["text"] for r in sorted(clean, key=lambda r: r["doc_id"])), sorted(tokens, key=lambda r: r["doc_id"])):
        ids = library.encode(text, add_special_tokens=False).ids
        assert (row["n_tokens"], row["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert row["restored"] and row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("rows", [[], ODD_ROWS])
def test_odd_tables_pass_through(spark, docs_of, tmp_path, rows):
    docs = docs_of(rows)
    results = chained(spark, tmp_path, docs, SF)
    assert all(len(after) <= len(before) for before, after in zip(results, results[1:]))
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        # each stage by itself, over all rows
        found = stage(spark, docs, SF)
        assert found.columns == docs.columns and found.count() <= len(rows)


def test_names_of_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "simhash_near_dedup", "benchmark_decontamination", "bpe"]


def test_passages_below_the_limit_are_cut(spark, docs_of):
    item = next(r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if 13 <= len(decontaminate.words_of((r["text"] or "").encode())) <= 60)
    rest = " ".join(f"own{i}" for i in range(2000))
    found = corpus_pipeline.benchmark_decontamination(spark, docs_of([(1, f"{rest} {item} end"), (2, item), (3, rest)]), SF).collect()
    words = {r["doc_id"]: decontaminate.words_of(r["text"].encode()) for r in found}
    assert words == {1: [*rest.encode().split(), b"end"], 3: rest.encode().split()}
