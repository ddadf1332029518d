"""URL verdicts: host and path rules first, a weighted vocabulary for the rest.

The vocabulary is matched by an Aho-Corasick automaton in one pass over the URL, whatever the number
of terms. A hit counts only if no ASCII letter or digit stands next to it. Each distinct term adds
its weight; from `REJECT_AT` on the URL is blocked, so one strict term does, or several soft ones.

Defined cases: a null URL and one without `://` have empty host and path and no rule; a null or empty
URL has no terms and is allowed. Repeated rows are judged one by one, an empty table gives an empty
result, and only `page_id` and `url` are read, so further columns cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.common import documents, lower_ascii

REJECT_AT = 1.0
STRICT_WEIGHT = 1.0
SOFT_WEIGHT = 0.5

STRICT_TERMS = (
    "adult", "betting", "casino", "escort", "gambling", "hentai", "malware", "phishing", "poker", "porn", "porno",
    "sex", "spam", "torrent", "viagra", "warez", "xxx",
)
SOFT_TERMS = (
    "ads", "bets", "bonus", "cheap", "cialis", "click", "coupon", "crack", "dating", "deals", "discount", "earn",
    "farm", "free", "hot", "jackpot", "loan", "lottery", "meds", "money", "nude", "offer", "pharmacy", "pills",
    "prize", "promo", "replica", "slots", "track", "webcam", "win",
)
VOCABULARY = {term: STRICT_WEIGHT for term in STRICT_TERMS} | {term: SOFT_WEIGHT for term in SOFT_TERMS}


@dataclass(frozen=True)
class Rule:
    """A host, which stands for its subdomains too, and the start of a path."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


# Fixed values of the query's contract.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty where it has none."""
    start = F.locate("://", url)
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return lower_ascii(host), path


@lru_cache(maxsize=8)
def automaton(weights: frozenset[tuple[str, float]]) -> ahocorasick.Automaton:
    """Of terms and their weights; asked for once a batch of URLs, and made once a worker."""
    machine = ahocorasick.Automaton()
    for term, weight in weights:
        machine.add_word(term, (term, weight))
    if weights:
        machine.make_automaton()
    return machine


def term_weight(url: str | None, machine: ahocorasick.Automaton) -> float:
    """Sum of the weights of the distinct terms that stand in a URL on their own."""
    if not url or not len(machine):
        return 0.0
    text = url.encode().lower().decode()

    def joins(at: int) -> bool:
        return 0 <= at < len(text) and text[at].isascii() and text[at].isalnum()

    found = {
        (term, weight)
        for end, (term, weight) in machine.iter(text)
        if not joins(end + 1) and not joins(end - len(term))
    }
    return sum(weight for _, weight in found)


def judge_urls(
    pages: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    vocabulary: dict[str, float] = VOCABULARY,
    reject_at: float = REJECT_AT,
) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, term_weight.

    The longest rule that fits decides; among rules of one length the first by name does. Without a
    rule the vocabulary does. Rows stay in the tasks that read them; nothing is shuffled.
    """

    # As large as the vocabulary the caller holds, and sent to each worker once.
    shared = pages.sparkSession.sparkContext.broadcast(frozenset(vocabulary.items()))

    @F.pandas_udf("double")
    def weight(urls: pd.Series) -> pd.Series:
        machine = automaton(shared.value)
        return pd.Series([term_weight(url, machine) for url in urls], dtype="float64")

    host, path = url_parts(F.col("url"))
    parts = documents(pages, "page_id", "url").select(
        "page_id", host.alias("host"), path.alias("path"), weight("url").alias("term_weight")
    )
    parts = parts.fillna("", ["host", "path"])
    rule, verdict = F.lit(None).cast("string"), F.when(F.col("term_weight") >= reject_at, "block").otherwise("allow")
    for candidate in sorted(rules, key=lambda r: (-len(r.name), r.name), reverse=True):
        fits = candidate.fits(F.col("host"), F.col("path"))
        rule = F.when(fits, candidate.name).otherwise(rule)
        verdict = F.when(fits, candidate.verdict).otherwise(verdict)
    return parts.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "term_weight")
