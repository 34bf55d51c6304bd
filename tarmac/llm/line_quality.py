"""Line-first quality rules, in DataFrame functions alone.

Every line of a text is judged by itself:

* punctuation: it has no letter, or at least ``MARKS`` marks (``#*$%&|<>!?=~^_{}``) and more than one for two words;
* navigation: separators (``|``, ``>`` and the like, apart from words) divide it into three or more entries of at
  most four words on average, or it is a menu word alone;
* boilerplate: it has at most ``BOILERPLATE_WORDS`` words, and a legal, cookie or subscription phrase.

Failed lines are removed. A document is rejected if that takes away more than ``MOST_LOST`` of its words, or if the
base rules fail: too few words, or too many words in windows that occur more than once in the text.

Words are runs of anything but ASCII white space. A line is blank without a word; blank lines neither fail nor
count. Repeated windows are found inside a row, by sorting hashes of its windows, so nothing is shuffled and a
text of any length costs its own length (times its logarithm, if any window repeats).

Rows: a null or empty text has no words, fails the base rules and is not kept. Null ids and repeated rows are judged like any
other, row by row. An empty table gives an empty table. Clashing extra columns are ignored by ``judge`` and kept by ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.rows import text_of, wrapped

#: words a document needs; its largest share of words in repeated windows; words of a window
LEAST_WORDS, MOST_REPEATED, WINDOW = 50, 0.5, 3
#: largest share of words that removed lines may take
MOST_LOST = 0.5
MARKS, BOILERPLATE_WORDS = 3, 20

#: fixed values: patterns of the rules, in a syntax that Java and RE2 share
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
LINE_MARKS = r"[#*$%&|<>!?=~^_{}]+"
SEPARATORS = r"[\x20\x09-\x0D][|>»›•·/][\x20\x09-\x0D]"
MENU = (
    "^(home|menu|search|login|log in|log out|sign in|sign up|register|about|about us|contact|contact us|next|previous|"
    "back|back to top|top|share|read more|more|comments|reply|print|sitemap|site map|skip to content)[.:]?$"
)
PHRASES = (
    "all rights reserved|terms of (use|service)|privacy policy|cookie|javascript|click here|subscribe|newsletter|"
    "copyright|©|licensed under|released under the|powered by|follow us|sign up"
)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES, -1), "")


def line_fails(line: Column) -> Column:
    """Whether one line, not blank, fails a rule."""
    words = F.size(words_of(line))
    marks = F.length(line) - F.length(F.regexp_replace(line, LINE_MARKS, ""))
    entries = F.size(F.split(line, SEPARATORS, -1))
    return (
        ~line.rlike(r"\p{L}")
        | ((marks >= MARKS) & (2 * marks > words))
        | ((entries >= 3) & (words - (entries - 1) <= 4 * entries))
        | ((words <= 4) & F.lower(F.regexp_replace(line, rf"^{SPACES}|{SPACES}$", "")).rlike(MENU))
        | ((words <= BOILERPLATE_WORDS) & F.lower(line).rlike(PHRASES))
    )


def _measured(docs: DataFrame, window: int) -> DataFrame:
    """``docs`` with its column ``text`` replaced by working columns ``__*``.

    The steps are separate projections on purpose: an array that a lambda refers to must be
    a column by then, or it would be computed again for every element.
    """
    frame = docs.withColumn("text", F.coalesce("text", F.lit(""))).withColumnRenamed("text", "__text").withColumns({"__words": words_of(F.col("__text")), "__lines": F.split("__text", "\n", -1)})
    w = F.col("__words")
    parts = lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, window)])
    frame = frame.withColumns({
        "__n_words": F.size(w).cast("long"),
        "__word_chars": F.length(F.array_join(w, "")).cast("long"),
        "__n_symbols": (F.length("__text") - F.length(F.regexp_replace("__text", SYMBOLS, ""))).cast("long"),
        "__windows": F.slice(F.transform(w, parts), 1, F.greatest(F.size(w) - (window - 1), F.lit(0))),
        "__full": F.filter("__lines", lambda l: l.rlike(r"[^\x20\x09-\x0D]")),
    })
    frame = frame.withColumns({
        "__repeats": F.size(F.array_distinct("__windows")) < F.size("__windows"),
        "__n_dup_lines": (F.size("__full") - F.size(F.array_distinct("__full"))).cast("long"),
        "__failed": F.filter("__full", line_fails),
    }).drop("__words")
    # (hash, place) of all windows in order of hash: equal ones are neighbours
    placed = F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    frame = frame.withColumn("__placed", F.when(F.col("__repeats"), placed)).drop("__windows")
    p = F.col("__placed")
    same = lambda s, i: (s["h"] == F.get(p, i + 1)["h"]) | ((i > 0) & (s["h"] == F.get(p, F.greatest(i - 1, F.lit(0)))["h"]))
    places = F.sort_array(F.transform(F.filter(p, lambda s, i: F.coalesce(same(s, i), F.lit(False))), lambda s: s["i"]))
    frame = frame.withColumn("__places", places).drop("__placed")
    q = F.col("__places")
    covered = F.transform(q, lambda x, i: F.least(F.lit(window), F.coalesce(F.get(q, i + 1) - x, F.lit(window))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    lost = F.aggregate(F.transform("__failed", lambda l: F.size(words_of(l))), F.lit(0).cast("long"), lambda a, x: a + x)
    return frame.withColumns({"__n_repeat_words": F.coalesce(total, F.lit(0).cast("long")), "__n_lost_words": lost}).drop("__places")


def _verdicts(frame: DataFrame, least_words: int, most_repeated: float, most_lost: float) -> DataFrame:
    n, lost = F.col("__n_words"), F.col("__n_lost_words")
    base = (n < least_words) | (100 * F.col("__n_repeat_words") > F.lit(round(100 * most_repeated)) * n)
    return frame.withColumn("__base_failed", base).withColumn(
        "__kept", ~F.col("__base_failed") & (100 * lost <= F.lit(round(100 * most_lost)) * n)
    )


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS,
    most_repeated: float = MOST_REPEATED, most_lost: float = MOST_LOST, window: int = WINDOW, with_text: bool = False,
) -> DataFrame:
    """Per row ``id_col``, the base measures, ``base_failed``, ``kept``, counts of lines; ``cleaned`` (the text
    without failed lines) if ``with_text``."""
    kept = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    frame = _verdicts(_measured(kept, window), least_words, most_repeated, most_lost)
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lost_words"]
    cleaned = F.array_join(F.filter("__lines", lambda l: ~l.rlike(r"[^\x20\x09-\x0D]") | ~line_fails(l)), "\n")
    return frame.select(
        F.col("id").alias(id_col), *[F.col(f"__{m}").alias(m) for m in measures],
        F.size("__full").cast("long").alias("n_lines"), F.size("__failed").cast("long").alias("n_failed_lines"),
        *([cleaned.alias("cleaned")] if with_text else []),
    )


def clean(
    docs: DataFrame, text_col: str = "text", least_words: int = LEAST_WORDS,
    most_repeated: float = MOST_REPEATED, most_lost: float = MOST_LOST, window: int = WINDOW,
) -> DataFrame:
    """The rows of ``docs`` that are kept, as they are.

    The row number in the projection under the filter keeps Catalyst from moving the filter below
    it: there the measures would be expressions inside one another, computed again for every element.
    """
    frame = _verdicts(_measured(wrapped(docs, text=text_of(text_col)), window), least_words, most_repeated, most_lost)
    frame = frame.withColumn("__fence", F.monotonically_increasing_id())
    return frame.where(F.col("__kept") & (F.col("__fence") >= 0)).select("doc.*")
