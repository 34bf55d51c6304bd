import random

import pytest

from llm_rows import ODD_ROWS
from tarmac.llm import decontaminate as dec


def plain(words, items, window):
    hit, found = set(), set()
    for name, item in items:
        size = min(window, len(item))
        for j in range(len(item) - size + 1 if item else 0):
            for i in range(len(words) - size + 1):
                if words[i : i + size] == item[j : j + size]:
                    found.add(name)
                    hit.update(range(i, i + size))
    return hit, found


@pytest.mark.parametrize("seed", range(25))
def test_automaton_equals_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(40):
        letters = [b"a", b"b", b"c", b"d"][: rng.randint(1, 4)]
        window = rng.randint(1, 5)
        items = [(str(i), [rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 3, 5, 9]))]) for i in range(rng.randint(0, 5))]
        automaton = dec.Automaton(items, window)
        words = [rng.choice([*letters, b"z"]) for _ in range(rng.randint(0, 25))]
        spans, found = automaton.match(words, {})
        want_hit, want_items = plain(words, items, window)
        assert {x for a, b in spans for x in range(a, b)} == want_hit
        assert {automaton.names[i] for i in found} == want_items


def table(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([40, 13, 14, 5, 2, 30])] + [(50, None), (51, " ?! "), (None, text(20)), (0, text(15)), (1, "x")]
    docs = [(i, text(rng.randint(0, 120))) for i in range(40)]
    docs += [(100, f"{text(30)} {items[0][1].upper()} {text(30)}"), (101, items[1][1]), (102, text(400) + ", " + items[3][1] + "! " + text(3)), *ODD_ROWS]
    return docs, items


@pytest.mark.parametrize("portion_words", [dec.PORTION_WORDS, 20])
def test_report_equals_brute_force(spark, docs_of, portion_words):
    docs, items = table()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = dec.report(docs_of(docs), bench, portion_words=portion_words).collect()
    named = [(None if i is None else str(i), dec.words_of((t or "").encode())) for i, t in items]
    want = []
    for doc_id, text in docs:
        words = dec.words_of((text or "").encode())
        hit, names = plain(words, named, 13)
        want.append((doc_id, len(words), len(hit), sorted(names - {None}), bool(hit) and 20 * len(hit) >= len(words)))
    key = lambda r: str(r)
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in found]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert all(sum(s["stop"] - s["start"] for s in r["spans"]) == r["n_hit"] for r in found)


def test_contaminated_rows_go_and_others_are_cut(spark, docs_of):
    docs, items = table()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    frame = docs_of(docs)
    verdict = {str((r["doc_id"], r["n_words"])): r for r in dec.report(frame, bench).collect()}
    whole = dec.decontaminate(frame, bench, cut_spans=False)
    assert whole.columns == frame.columns
    assert whole.count() == sum(not verdict[str((i, len(dec.words_of((t or "").encode()))))]["contaminated"] for i, t in docs)
    cut = dec.decontaminate(frame, bench)
    assert cut.columns == frame.columns and cut.count() == whole.count()
    again = dec.report(cut, bench).collect()
    assert sum(r["n_hit"] for r in again) <= 1


def test_cutting_keeps_what_is_around():
    assert dec.cut("Aa, b-c d!é x", [1, 3]) == "Aa,  d!é x"
    assert dec.cut("a b", [0, 2]) == "" and dec.cut("", []) == ""


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert {r["n_hit"] for r in dec.report(docs_of(ODD_ROWS), none).collect()} == {0}
    assert dec.report(docs_of([]), spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")).count() == 0


@pytest.mark.parametrize("portion_words", [dec.PORTION_WORDS, 20])
def test_decontamination_is_one_pass_per_portion(spark, docs_of, portion_words):
    docs, items = table()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    frame = docs_of(docs)
    done = dec.decontaminate(frame, bench, portion_words=portion_words)
    # a second Python worker per task, and a second copy of every text, took too much of an executor's memory
    assert done._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    judged = [(r["doc_id"], t, r["contaminated"], [x for s in r["spans"] for x in (s["start"], s["stop"])])
              for r, (_, t) in zip(dec.report(frame.coalesce(1), bench, portion_words=portion_words).collect(), docs)]
    want = [(i, t if t is None else dec.cut(t, spans)) for i, t, contaminated, spans in judged if not contaminated]
    key = lambda r: str(r)
    assert sorted(((r["doc_id"], r["text"]) for r in done.collect()), key=key) == sorted(want, key=key)
