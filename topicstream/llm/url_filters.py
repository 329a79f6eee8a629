"""URL filters by association rules.

Spark's FP-growth mines combinations of URL tokens among badly labelled pages. Combinations that enough of them hold, that
come with a bad label often enough among all labelled pages, and that no shorter rule makes redundant, are matched
through an inverted index from token to rules: a rule fires on a URL that has all its tokens. Tokens that always come
together are one item, or their combinations would double with each. Given rules on hosts and paths come first.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicstream.llm.common import lower_ascii, written

#: Fixed values of the contract.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
MIN_CONFIDENCE = 0.5
MIN_PAGES = 20
MAX_RULES = 100_000


@dataclass(frozen=True)
class TokenRules:
    """Token sets that mark a URL as bad, and for each token the rules it is part of."""

    sets: tuple[tuple[str, ...], ...]

    def index(self) -> dict[str, list[int]]:
        found = defaultdict(list)
        for number, tokens in enumerate(self.sets):
            for token in tokens:
                found[token].append(number)
        return dict(found)


def host_of(url: Column) -> Column:
    """Lower-cased text after the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty for null or without ``://``."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column) -> Column:
    """Distinct tokens of a URL: its scheme, its host's labels, endings and words, words of path, query and fragment.

    Digits count as one ``0``, so that a number's shape is a token and the number is not.
    """
    shaped = F.regexp_replace(lower_ascii(F.coalesce(url, F.lit(""))), "[0-9]+", "0")
    host = F.regexp_replace(host_of(url), "[0-9]+", "0")
    path = F.regexp_replace(lower_ascii(path_of(url)), "[0-9]+", "0")
    labels = F.split(host, r"\.")
    n = F.size(labels)
    tail = F.array_join(F.slice(labels, F.greatest(n - 1, F.lit(1)), 2), ".")
    words = lambda text: F.regexp_extract_all(text, F.lit(r"[^/?#&=.:_\-]+"), F.lit(0))
    prefixed = lambda kind, found: F.transform(found, lambda x: F.concat(F.lit(kind), x))
    rest = F.regexp_extract(shaped, r"(?s)\A[^?#]*(.*)", 1)
    return F.array_distinct(
        F.concat(
            F.array(F.concat(F.lit("site="), host), F.concat(F.lit("end="), tail)),
            F.array(F.concat(F.lit("scheme="), F.regexp_extract(shaped, "^([a-z]+)://", 1))),
            prefixed("host=", words(host)),
            prefixed("path=", words(path)),
            prefixed("rest=", words(rest)),
        )
    )


def mine(
    urls: DataFrame,
    *,
    url_col: str = "url",
    bad_col: str = "bad",
    min_support: float = 0.0,
    min_confidence: float = MIN_CONFIDENCE,
    min_pages: int = MIN_PAGES,
) -> TokenRules:
    """Rules of all rows of ``urls`` whose ``bad_col`` is true or false; rows with null there are left out.

    A rule is a set of tokens that at least ``min_pages`` bad rows hold, however many rows there are, and of the rows that hold
    it a share of ``min_confidence`` is bad; with ``min_support`` they must also be that share of all rows. Of tokens
    that exactly the same bad rows hold a rule has the one that the fewest rows hold, or the first of these. Rows that
    repeat count as often as they are there, a null URL has no tokens worth a rule but its own, and without rows there are no
    rules; other columns are ignored. More than ``MAX_RULES`` sets to be looked at raise an error, as every task holds
    their index; a higher ``min_pages`` gives fewer.
    """
    bad = F.col(f"`{bad_col}`")
    rows = urls.where(bad.isNotNull()).select(
        F.monotonically_increasing_id().alias("page"),
        tokens_of(F.col(f"`{url_col}`").cast("string")).alias("tokens"),
        bad.alias("bad"),
    )
    rows = written(rows, "url-tokens")
    bad_pages = rows.where("bad").select("page", F.explode("tokens").alias("token"))
    n = rows.where("bad").count()
    min_pages = max(1, min_pages, math.ceil(min_support * rows.count()) if min_support else 0)
    if n < min_pages:
        return TokenRules(())
    # Two sums of hashes tell which bad rows hold a token: tokens that agree in them are held by the same ones. The rarest
    # of them among all rows stands for them.
    page = F.when(F.col("bad"), F.xxhash64("page"))
    other = F.when(F.col("bad"), F.xxhash64("page", F.lit(1))).cast("decimal(38,0)")
    held = rows.select("page", "bad", F.explode("tokens").alias("token")).groupBy("token")
    held = held.agg(F.count("*").alias("n"), F.count_if("bad").alias("pages"), F.bit_xor(page).alias("rows"), F.sum(other).alias("sum"))
    together = held.where(F.col("pages") >= min_pages).groupBy("pages", "rows", "sum")
    together = written(together.agg(F.min_by("token", F.struct("n", "token")).alias("item")).select("item"), "url-items")
    baskets = bad_pages.join(together, bad_pages["token"] == together["item"])
    baskets = baskets.groupBy("page").agg(F.collect_set("item").alias("items"))
    partitions = int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    baskets = written(baskets.select("items"), "url-baskets")
    known = baskets.count()
    if known < min_pages:
        return TokenRules(())
    # A hair less than the share of ``min_pages``, which rounding must not lift above it; the counts decide.
    model = FPGrowth(minSupport=(min_pages - 0.5) / known, numPartitions=partitions).fit(baskets)
    frequent = model.freqItemsets.where(F.col("freq") >= min_pages).select("items")
    found = frequent.limit(MAX_RULES + 1).collect()
    if len(found) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} sets of tokens; raise min_pages")
    sets = sorted((sorted(row["items"]) for row in found), key=lambda s: (len(s), s))
    return _confident(rows, TokenRules(tuple(map(tuple, sets))), min_confidence)


def _confident(rows: DataFrame, sets: TokenRules, min_confidence: float) -> TokenRules:
    """The shortest of ``sets`` of which a large enough share of the rows that hold them is bad."""
    shared = rows.sparkSession.sparkContext.broadcast((sets.index(), [len(s) for s in sets.sets]))

    def count(batches):
        index, sizes = shared.value
        seen, of_bad = defaultdict(int), defaultdict(int)
        for batch in batches:
            for tokens, bad in zip(batch["tokens"], batch["bad"]):
                for number in _held(tokens, index, sizes):
                    seen[number] += 1
                    of_bad[number] += bool(bad)
        yield pd.DataFrame([(k, n, of_bad[k]) for k, n in seen.items()], columns=["set", "n", "bad"], dtype="int64")

    counts = rows.select("tokens", "bad").mapInPandas(count, "set long, n long, bad long")
    sums = counts.groupBy("set").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    passed = {r.set for r in sums.where(F.col("bad") >= min_confidence * F.col("n")).select("set").collect()}
    shortest: list[frozenset] = []
    by_token: dict[str, list[frozenset]] = defaultdict(list)
    for number, tokens in enumerate(sets.sets):  # shorter ones come first
        rule = frozenset(tokens)
        if number in passed and not any(known <= rule for token in rule for known in by_token[token]):
            shortest.append(rule)
            by_token[min(rule)].append(rule)
    return TokenRules(tuple(tuple(sorted(s)) for s in shortest))


def _held(tokens, index: dict[str, list[int]], sizes: list[int]):
    """Numbers of the sets that are among ``tokens``."""
    seen: dict[int, int] = defaultdict(int)
    for token in tokens:
        for number in index.get(token, ()):
            seen[number] += 1
            if seen[number] == sizes[number]:
                yield number


def judge(
    pages: DataFrame,
    mined: TokenRules,
    *,
    rules: tuple = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """One row (page_id, host, path, rule, verdict) for every row of ``pages``.

    Of the given rules that fit a URL's host (or a domain above it) and the start of its path, the longest wins. Where
    none fits, ``rule`` is null and the mined rules decide: block if one fires, else allow. A null URL, or one without
    ``://``, has an empty host and path and is allowed unless a mined rule fires. Rows are judged one by one, so
    repeated rows and null ids have their results, and an empty table an empty one; other columns are ignored.
    """
    shared = pages.sparkSession.sparkContext.broadcast((mined.index(), [len(s) for s in mined.sets]))

    @F.pandas_udf("boolean")
    def fires(token_lists: pd.Series) -> pd.Series:
        index, sizes = shared.value
        return pd.Series([any(True for _ in _held(tokens, index, sizes)) for tokens in token_lists], dtype=bool)

    url = F.col(f"`{url_col}`").cast("string")
    rows = pages.select(
        F.col(f"`{id_col}`").alias("page_id"),
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        tokens_of(url).alias("tokens"),
    )
    rule, verdict = F.lit(None).cast("string"), F.when(fires("tokens"), "block").otherwise("allow")
    for text, outcome in sorted(rules, key=lambda r: len(r[0])):  # the longest is asked first
        host, _, path = text.partition("/")
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit(f".{host}"))) & F.startswith(
            F.col("path"), F.lit(f"/{path}")
        )
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, outcome).otherwise(verdict)
    return rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))
