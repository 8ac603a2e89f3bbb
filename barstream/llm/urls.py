"""Operator 10: URL filters by host rules and a weighted URL vocabulary."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barstream.llm.common import long, text_rows

# Terms of the vocabulary, compared in lower case.
STRICT = ("porn", "porno", "xxx", "hentai", "camgirl", "camgirls", "escorts", "blowjob", "milf", "gangbang", "onlyfans", "sexcam", "viagra", "cialis")
SOFT = ("adult", "sex", "sexy", "nude", "nudes", "naked", "erotic", "fetish", "casino", "betting", "gamble", "poker", "slots", "jackpot", "payday", "loans", "torrent", "warez", "crack", "keygen", "pills", "pharmacy", "replica", "escort", "dating", "hookup", "webcam", "proxy")
#: Distinct soft terms that reject an address.
SOFT_LIMIT = 2

# Verdict, host and path of the address rules.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule whose host is this one or a parent of it and whose path begins this path."""
    rule = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, at, begin in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(begin)
        rule = F.when(fits, F.struct(F.lit(at + begin).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(rule)
    return rule


def term_counter(strict: tuple[str, ...], soft: tuple[str, ...]) -> Callable[[str | None], tuple[int, int]]:
    """A function from an address to its distinct strict and soft terms, found by one automaton.

    A term counts where neither neighbour is a letter or digit, of any script.
    """
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for kind, terms in (("strict", strict), ("soft", soft)):
        for term in terms:
            automaton.add_word(term.lower(), (kind, term.lower()))
    automaton.make_automaton()

    def count(url):
        text = re.sub("[A-Z]", lambda m: m[0].lower(), url or "")
        hits = set()
        for end, (kind, term) in automaton.iter(text):
            begin = end - len(term) + 1
            if not (begin and text[begin - 1].isalnum()) and not text[end + 1 : end + 2].isalnum():
                hits.add((kind, term))
        strict_hits = sum(kind == "strict" for kind, _ in hits)
        return strict_hits, len(hits) - strict_hits

    return count


def judge_urls(
    pages: DataFrame, rules=RULES, strict: tuple[str, ...] = STRICT, soft: tuple[str, ...] = SOFT, soft_limit: int = SOFT_LIMIT
) -> DataFrame:
    """page_id, host, path, rule, verdict, n_strict and n_soft of every ``url``.

    A fitting rule decides; else one strict term or ``soft_limit`` distinct
    soft terms block, and everything else is allowed.  A null or empty url, or
    one without ``://``, has an empty host and path and no rule; its terms still
    count.  Repeated rows come back as they are; other columns are not read.
    """
    rows = text_rows(pages, ["page_id", "url"], [long("n_strict"), long("n_soft")], lambda: term_counter(strict, soft), text="url")
    rows = rows.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    rows = rows.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    by_terms = F.when((F.col("n_strict") > 0) | (F.col("n_soft") >= soft_limit), "block").otherwise("allow")
    verdict = F.coalesce("found.verdict", by_terms).alias("verdict")
    return rows.select("page_id", "host", "path", F.col("found.rule").alias("rule"), verdict, "n_strict", "n_soft")
