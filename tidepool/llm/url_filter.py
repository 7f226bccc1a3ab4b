"""URL filter: host rules first, then a weighted vocabulary over the whole url.

The vocabulary is an Aho-Corasick automaton, built once per worker, that finds
all terms of a url in one pass. A hit counts if the characters beside it are no
ASCII letters or digits. Strict terms weigh ``REJECT_AT``, soft terms half of it,
and the weights of *distinct* terms add up: one strict or two different soft
terms reject, a soft term repeated does not.

Defined cases: a null url, or one without ``://``, has an empty host and path; a
null url has no hits and is allowed. Upper case A-Z is folded, nothing else. Rows
are judged one by one, so repeated rows repeat in the result and an empty table
gives an empty one. Only the id and the url are read.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

STRICT_TERMS = ("porn", "porno", "xxx", "hentai", "escorts", "viagra", "cialis", "warez", "malware", "phishing")
SOFT_TERMS = ("ads", "adult", "bet", "bets", "casino", "cheap", "crack", "dating", "free", "gambling", "loan",
              "nude", "pills", "poker", "promo", "sex", "slots", "spam", "track", "win")
STRICT_WEIGHT, SOFT_WEIGHT, REJECT_AT = 2, 1, 2

BOUNDARY = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


class Rule(NamedTuple):
    action: str
    host: str
    path: str


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z folded."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """(rule text, action) of the longest rule that fits the host, or a parent of it, and the path."""
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.host) + len(r.path), r)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.host + rule.path)).otherwise(text)
        action = F.when(fits, F.lit(rule.action)).otherwise(action)
    return text, action


@lru_cache(maxsize=4)
def automaton(terms: tuple[tuple[str, int], ...]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for term, weight in terms:
        found.add_word(term, (term, weight))
    found.make_automaton()
    return found


def hits(url: str | None, known: ahocorasick.Automaton) -> dict[str, int]:
    """Weight of each distinct term of the automaton that stands between boundaries in ``url``."""
    if not url:
        return {}
    folded, out = url.translate(FOLD), {}
    for last, (term, weight) in known.iter(folded):
        first = last - len(term) + 1
        if (first == 0 or folded[first - 1] not in BOUNDARY) and (
                last + 1 == len(folded) or folded[last + 1] not in BOUNDARY):
            out[term] = weight
    return out


FOLD = str.maketrans(UPPER, LOWER)


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = (), strict: tuple[str, ...] = STRICT_TERMS,
               soft: tuple[str, ...] = SOFT_TERMS, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule, verdict, strict_hits, soft_hits of every row.

    ``rules`` and the terms are the operator's configuration and travel with the
    plan; the host rules decide where one fits, the vocabulary elsewhere.
    """
    terms = tuple([(t, STRICT_WEIGHT) for t in strict] + [(t, SOFT_WEIGHT) for t in soft if t not in strict])

    @F.pandas_udf("strict_hits int, soft_hits int")
    def count_hits(urls: pd.Series) -> pd.DataFrame:
        known = automaton(terms)          # once a batch: the cost of a url does not grow with the vocabulary
        found = [hits(u, known).values() for u in urls]
        return pd.DataFrame({
            "strict_hits": [sum(w == STRICT_WEIGHT for w in x) for x in found],
            "soft_hits": [sum(w == SOFT_WEIGHT for w in x) for x in found]})

    url = F.col(url_col)
    rows = pages.select(F.col(id_col), host_of(url).alias("host"), path_of(url).alias("path"),
                        count_hits(url).alias("found"))
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    score = F.col("found.strict_hits") * STRICT_WEIGHT + F.col("found.soft_hits") * SOFT_WEIGHT
    method = F.when(score >= REJECT_AT, F.lit("block")).otherwise(F.lit("allow"))
    return rows.select(F.col(id_col), "host", "path", rule.alias("rule"),
                       F.coalesce(action, method).alias("verdict"), "found.strict_hits", "found.soft_hits")
