"""URL filters: a list of host and path rules, then association rules mined from labelled URLs.

A listed rule such as ``example.net/en/`` fits its host and all subdomains if the URL's path starts with the rule's
path; the longest fitting rule decides. For other URLs the association rules do:

1. Every URL becomes a set of tokens: parts of its host, path and query, each marked with where it stands.
2. Tokens that occur in the same labelled URLs become one. Spark's FP-growth mines token combinations that are frequent among the URLs labelled bad, of up to ``most_tokens`` tokens, or of any length if that is None.
3. Combinations are pruned by support (bad URLs that have them) and by confidence (their share among all labelled
   URLs that have them). Of three tokens and more only those count that contain no shorter rule, which would block the same URLs.
4. An inverted index from each combination's rarest token finds the candidates of a URL; one that has all
   tokens of a combination is blocked.

Only DataFrame functions and Spark ML are used. URLs meet the index as distinct token sets, so repeated URLs cost one
row there. FP-growth returns every part of a frequent combination; parts that differ only by tokens that always occur together are one there, so copies of a
long URL do not multiply. Tokens that many bad URLs share in many different ways still do.

Rows: a null URL, or one without ``://``, has empty host, path and token set; no rule fits it and it is allowed. Null
labels and labels of null ids are ignored, an id labelled more than once is bad if any of its labels is. Repeated rows are
judged alike. Without labelled rows, or an empty table, there are no association rules. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.session import stored

#: smallest share of the bad URLs, smallest number of them, smallest confidence, most tokens of a combination (None: any number)
SUPPORT, LEAST_URLS, CONFIDENCE, MOST_TOKENS = 0.01, 10, 0.6, 2

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: fixed values: patterns in a syntax that Java and RE2 share
HOST, PATH, QUERY = "^([^/?#]*)", "^[^/?#]*([^?#]*)", r"^[^?#]*\?([^#]*)"
#: fixed value: letters and digits of all scripts make tokens
LETTERS = r"[\p{L}\p{M}\p{N}_]+"


def _rest(url: Column) -> Column:
    """What follows the first ``://``, else the empty text."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), HOST, 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), PATH, 1)


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest of the (verdict, rule) pairs that fits, and its verdict; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column) -> Column:
    """Sorted distinct tokens: parts of the host (``h:``), path (``p:``) and names in the query (``q:``), in lower case."""
    rest = F.lower(_rest(url))
    parts = lambda pattern, mark: F.transform(
        F.regexp_extract_all(F.regexp_extract(rest, pattern, 1), F.lit(f"({LETTERS})"), 1), lambda t: F.concat(F.lit(mark), t)
    )
    names = F.transform(
        F.regexp_extract_all(F.concat(F.lit("&"), F.regexp_extract(rest, QUERY, 1)), F.lit(f"&({LETTERS})"), 1), lambda t: F.concat(F.lit("q:"), t)
    )
    return F.array_sort(F.array_distinct(F.concat(parts(HOST, "h:"), parts(PATH, "p:"), names)))


def _matches(sets: DataFrame, combinations: DataFrame) -> DataFrame:
    """(``key``, ``items``) of the token sets (``key``, ``tokens``) and the combinations they have; by the rarest token."""
    index = combinations.select(F.col("rarest").alias("token"), "items")
    found = sets.select("key", "tokens", F.explode("tokens").alias("token")).join(index, "token")
    return found.where(F.size(F.array_except("items", "tokens")) == 0).select("key", "items")


def _token_classes(sets: DataFrame) -> DataFrame:
    """``token`` and ``class``, the least of the tokens that occur in the same token sets, of all tokens of ``sets`` (``key``, ``tokens``, different ones).

    Token sets are the same if their number and two sums of hashes are.
    """
    hashes = [F.sum(F.xxhash64("key", F.lit(i)).cast("decimal(38,0)")) for i in (0, 1)]
    where = sets.select("key", F.explode("tokens").alias("token")).groupBy("token").agg(F.struct(F.count("*").alias("n"), *[h.alias(f"h{i}") for i, h in enumerate(hashes)]).alias("where"))
    least = where.groupBy("where").agg(F.min("token").alias("class"))
    return where.join(least, "where").select("token", "class")


def _spelled(rules: DataFrame, classes: DataFrame, most_tokens: int | None) -> DataFrame:
    """Rules between classes as rules between tokens: one token of each class, and pairs of tokens of one class."""
    members = classes.groupBy("class").agg(F.array_sort(F.collect_list("token")).alias("members"))
    lists = (
        rules.withColumn("key", F.array_join("items", " ")).withColumn("class", F.explode("items")).join(members, "class")
        .groupBy("key", "rarest", "bad_urls", "all_urls").agg(F.array_sort(F.collect_list(F.struct("class", "members")))["members"].alias("lists"))
    )
    product = lambda done, more: F.flatten(F.transform(done, lambda head: F.transform(more, lambda token: F.concat(head, F.array(token)))))
    start = F.array(F.array().cast("array<string>"))
    out = lists.withColumn("items", F.explode(F.aggregate("lists", start, product)))
    if most_tokens is None or most_tokens > 1:
        only = F.col("lists")[0]
        pairs = F.flatten(F.transform(only, lambda a: F.transform(F.filter(only, lambda b: b > a), lambda b: F.array(a, b))))
        out = out.unionByName(lists.where(F.size("lists") == 1).withColumn("items", F.explode(pairs)))
    # the tokens of a class are equally rare
    out = out.withColumn("items", F.array_sort("items")).join(classes.withColumnRenamed("class", "of"), F.expr("array_contains(items, token)") & (F.col("of") == F.col("rarest")))
    return out.groupBy("items", "bad_urls", "all_urls").agg(F.min("token").alias("rarest")).select("items", "rarest", "bad_urls", "all_urls")


def mine(
    labelled: DataFrame, support: float = SUPPORT, least_urls: int = LEAST_URLS, confidence: float = CONFIDENCE, most_tokens: int | None = MOST_TOKENS,
) -> DataFrame:
    """Rules ``items``, ``rarest``, ``bad_urls``, ``all_urls`` from rows of ``tokens`` and ``bad``.

    Tokens that occur in the same URLs are mined as one, as every combination of them has the same URLs.
    """
    given = stored(labelled.select("tokens", "bad"), "url-labels")
    bad = given.where("bad and size(tokens) > 0")
    n_bad = bad.count()
    least = max(least_urls, -int(-support * n_bad // 1))
    empty = given.sparkSession.createDataFrame([], "items array<string>, rarest string, bad_urls bigint, all_urls bigint")
    if n_bad < least:
        return empty
    distinct = given.groupBy("tokens").agg(F.count_if("bad").alias("n_bad"), F.count_if(~F.col("bad")).alias("n_good")).withColumn("key", F.array_join("tokens", " "))
    distinct = stored(distinct, "url-sets")
    classes = stored(_token_classes(distinct), "url-classes")
    merged = distinct.select("key", "n_bad", "n_good", F.explode("tokens").alias("token")).join(classes, "token")
    merged = merged.groupBy("key", "n_bad", "n_good").agg(F.array_sort(F.collect_set("class")).alias("tokens"))
    sets = stored(merged.select("tokens", "n_bad", "n_good"), "url-class-sets")
    bad = sets.where("n_bad > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n_bad"))).select("tokens")
    # just under the least count, as FP-growth rounds the product up again
    model = FPGrowth(itemsCol="tokens", minSupport=(least - 0.5) / n_bad).fit(bad)
    frequent = model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").alias("bad_urls"))
    frequent = stored(frequent if most_tokens is None else frequent.where(F.size("items") <= most_tokens), "url-combinations")
    alone = frequent.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), F.col("bad_urls").alias("n"))
    rarest = (
        frequent.select("items", "bad_urls", F.explode("items").alias("token")).join(alone, "token")
        .groupBy("items", "bad_urls").agg(F.min(F.struct("n", "token"))["token"].alias("rarest"))
    )
    rarest = stored(rarest, "url-index")
    counted = sets.groupBy("tokens").agg(F.sum(F.col("n_bad") + F.col("n_good")).alias("count")).withColumn("key", F.array_join("tokens", " "))
    have = _matches(counted, rarest).join(counted.select("key", "count"), "key").groupBy("items").agg(F.sum("count").alias("all_urls"))
    rules = rarest.join(have, "items").where(F.col("bad_urls") >= F.lit(confidence) * F.col("all_urls"))
    rules = stored(rules.select("items", "rarest", "bad_urls", "all_urls"), "url-rules").withColumn("key", F.array_join("items", " "))
    inside = _matches(rules.where("size(items) > 2").select("key", F.col("items").alias("tokens")), rules)
    implied = inside.where(F.array_join("items", " ") != F.col("key")).select("key").distinct()
    return stored(_spelled(rules.join(implied, "key", "left_anti").drop("key"), classes, most_tokens), "url-minimal-rules")


def judge(
    pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", label_id: str = "doc_id",
    bad: str = "quality = 0 or toxic = 1", **mining,
) -> DataFrame:
    """``id_col``, ``host``, ``path``, ``rule``, ``verdict`` (allow or block) and ``n_mined`` (association rules the URL matches).

    ``bad`` is the SQL condition on ``labels`` that marks bad URLs.
    """
    url = F.col(url_col).cast("string")
    kept = pages.select(F.col(id_col).alias("id"), host(url).alias("host"), path(url).alias("path"), tokens(F.coalesce(url, F.lit(""))).alias("tokens"))
    marked = labels.select(F.col(label_id).alias("id"), F.expr(bad).alias("bad")).where("id is not null and bad is not null")
    marked = marked.groupBy("id").agg(F.max("bad").alias("bad"))
    mined = mine(kept.select("id", "tokens").join(marked, "id"), **mining)
    sets = kept.select("tokens").distinct().withColumn("key", F.array_join("tokens", " "))
    hits = _matches(sets, mined).groupBy("key").agg(F.count("*").alias("n_mined"))
    rule, verdict = fitting_rule(F.coalesce("host", F.lit("")), F.coalesce("path", F.lit("")), rules)
    named = kept.withColumn("key", F.array_join("tokens", " ")).join(hits, "key", "left").withColumn("n_mined", F.coalesce("n_mined", F.lit(0).cast("long")))
    return named.select(
        F.col("id").alias(id_col), F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("n_mined") > 0, "block").otherwise("allow")).alias("verdict"), "n_mined",
    )
