import collections
import re

import pytest

from llm_rows import ODD_ROWS
from tarmac.llm import line_quality as lq

CLEAN = "\n".join(" ".join(f"Word{chr(97 + i)}{chr(97 + j)}" for j in range(9)) + ", and so on." for i in range(12))
SYMBOLS = "\n".join(" ".join(f"w{i}x{j}$$$" for j in range(10)) for i in range(10))
SHOUTING = "\n".join(" ".join(f"WORD{chr(65 + i)}{chr(65 + j)}!!" for j in range(10)) for i in range(10))
MENU = "\n".join(" | ".join(f"entry{i}x{j}" for j in range(10)) for i in range(10))
ROWS = [(201, CLEAN), (202, SYMBOLS), (203, SHOUTING), (204, MENU), (205, CLEAN + "\nAll rights reserved.\nHome"), (206, "same word " * 100),
        (207, CLEAN + "\n" + SYMBOLS + "\n" + MENU), (208, "a b c " * 20 + CLEAN), (209, "line\nline\n\nline "), (210, "x y z x y z"), *ODD_ROWS]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    n, r = len(words), len(covered)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), r, n < 50 or 100 * r > 50 * n


def test_measures_equal_plain_python(docs_of):
    found = lq.judge(docs_of(ROWS), with_text=True).collect()
    key = lambda r: str(r)
    got = [(r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in found]
    assert sorted(got, key=key) == sorted([(i, *plain(t)) for i, t in ROWS], key=key)


def test_verdicts(docs_of):
    kept = {r["doc_id"]: r for r in lq.judge(docs_of(ROWS), with_text=True).collect()}
    assert {i for i, r in kept.items() if r["kept"]} == {201, 205, 208}
    assert not kept[202]["base_failed"] and not kept[203]["base_failed"] and not kept[204]["base_failed"] and kept[206]["base_failed"]
    assert kept[205]["cleaned"] == CLEAN and kept[205]["n_failed_lines"] == 2
    assert kept[202]["cleaned"] == "" and kept[2]["cleaned"] == ""


@pytest.mark.parametrize("line,fails", [
    ("A plain sentence, with a comma.", False), ("----- 12 34", True), ("Tom & Jerry", False), ("a$$$ b### c***", True),
    ("one | two three | four", True), ("Contact us", True), ("We contact us today for a sentence.", False), ("© 2024 Someone", True),
    ("Is it so?", False), ("  Home ", True), ("Really?! Yes!!!", True),
])
def test_single_lines(spark, line, fails):
    from pyspark.sql import functions as F

    assert spark.createDataFrame([(line,)], "l string").select(lq.line_fails(F.col("l"))).first()[0] is fails


def test_clean_keeps_rows_as_they_are(docs_of):
    docs = docs_of([*ROWS, (201, CLEAN)])
    kept = lq.clean(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [201, 201, 205, 208]
    assert lq.clean(docs_of([])).count() == 0 and lq.judge(docs_of([])).count() == 0


def test_no_python_in_the_plan(docs_of):
    plan = lq.clean(docs_of(ROWS))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_long_text_is_linear(docs_of):
    text = "\n".join(" ".join(f"word{(i * 37 + j) % 9973}" for j in range(50)) for i in range(2000)) + " the end the end the end"
    row = lq.judge(docs_of([(1, text)])).first()
    assert (row["n_words"], row["n_repeat_words"]) == plain(text)[:1] + plain(text)[4:5]
