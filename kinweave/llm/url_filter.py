"""URL filter: logistic regression on hashed character n-grams of host and path.

Fitted on a small labelled table of URLs; domain rules come before the model's verdict.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.llm.common import ship
from kinweave.llm.textvec import Spans, row_sums, texts

GRAMS = (3, 4, 5)
SLOTS = 1 << 16
# (verdict, host and path), longest fitting wins.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
# The labelled table: names of hosts to block and to allow.  Either kind gets the same prefixes,
# domains and paths by the same rule, so that only names tell them apart.
BAD_NAMES = """
best-casino casino-royal online-casino casinoworld grand-casino-slots slots-jackpot winbig win-jackpot easy-win lucky-spin
sport-bets bets-today betfair-odds free-bet-tips live-betting bookie-bets free-spins free-cash-now poker-cash lottery-prizes
cheap-meds buy-pills pills-online cheap-viagra pharma-pills diet-pills cheap-cialis discount-pharmacy generic-meds cheap-replica
spam-links link-farm spamhaus-mail content-farm spam-blast seo-farm backlink-farm bulk-spam mail-spammer click-farm
ads-server adtracker track-ads click-track banner-ads popup-ads ads-network pixel-track adserv-click track-pixel
adult-cams adult-videos xxx-tube hot-adult x-rated porn-tube free-porn sex-chat-x adult-dating-xxx nude-cams
payday-loans quick-loans fast-cash-loan warez-crack keygen-crack phish-login fake-login-bank malware-drop free-iphone-win hack-tools
""".split()
GOOD_NAMES = """
daily-news city-library weather-today garden-shop university research museum history health-clinic music-school
train-times recipes kitchen stories charity photos street-maps art-gallery parliament nature-park
the-other northern station river mountain theatre other-things southern thought thorough
children-books winter-sports farmers-market race-results adult-education freedom-press advice-line village travel cooking
football-club open-data science-forum project-docs poems learn-code space-center hospital airport harbour
nation-building tradition translation motion-pictures bakery orchestra cathedral weaving pottery sailing
teacher heather-house where-to-go within another-place townhall swimming cycling mathematics philosophy
""".split()
PREFIXES = ("", "www.", "m.", "blog.")
DOMAINS = ("example.org", "example.com", "example.net", "site.info", "pages.org")
# A URL without host or with a name of a letter or two says nothing, and is allowed.
GOOD_BARE = [("", ""), ("", "/"), ("a.b", "/"), ("x.org", "/en/1")] * 4
PATHS = ("/en/4033.html", "/fr/12", "/", "/de/507/", "/es/88.html", "/item/9", "/en/2136/")


def labelled(names: Sequence[str], each: int = 4) -> list[tuple[str, str]]:
    """(host, path) of `each` URLs of every name."""
    rows = [(name, i * each + k) for i, name in enumerate(names) for k in range(each)]
    return [(f"{PREFIXES[n % 4]}{name}.{DOMAINS[n % 5]}", PATHS[n % 7]) for name, n in rows]


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty without `://`."""
    return F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits; NULL where none does."""
    fitting = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(slash + start))
        fitting = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(fitting)
    return fitting


def _slots(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(slots of all n-grams, number of n-grams of each row), with `^` and `$` as ends."""
    marked = pa.array([f"^{x or ''}$" for x in column.to_pylist()], pa.large_string())
    data, offsets = texts(marked)
    spans, lengths = Spans(data), np.diff(offsets)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], lengths)
    left = np.repeat(lengths, lengths) - place
    kept = np.stack([left >= n for n in GRAMS], axis=1)
    every = np.stack([np.pad(spans.windows(n), (0, len(data) - max(len(data) - n + 1, 0))) for n in GRAMS], axis=1)
    counts = row_sums(kept.sum(axis=1), lengths).astype(np.int64)
    return (every[kept] % np.uint64(SLOTS)).astype(np.int64), counts


def _features(hosts: pa.Array, paths: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(slots, counts) of the n-grams of hosts, and of paths in slots of their own."""
    (host, n_host), (path, n_path) = _slots(hosts), _slots(paths)
    return [(host, n_host), (path + SLOTS, n_path)]


def _scale(counts: np.ndarray) -> np.ndarray:
    return 1 / np.sqrt(np.maximum(counts, 1))


def fit(blocked: Sequence[tuple[str, str]] = tuple(labelled(BAD_NAMES)), allowed: Sequence[tuple[str, str]] = (*labelled(GOOD_NAMES), *GOOD_BARE),
        rounds: int = 400, ridge: float = 1e-2) -> np.ndarray:
    """Weights of the slots and, last, the intercept: gradient descent on n-gram counts, those of
    host and path each divided by the root of their number."""
    rows = [*blocked, *allowed]
    wanted = np.array([1.0] * len(blocked) + [0.0] * len(allowed))
    parts = _features(pa.array([h for h, _ in rows], pa.string()), pa.array([p for _, p in rows], pa.string()))
    slots = np.concatenate([s for s, _ in parts])
    row = np.concatenate([np.repeat(np.arange(len(rows)), n) for _, n in parts])
    value = np.concatenate([np.repeat(_scale(n), n) for _, n in parts])
    weights, bias = np.zeros(2 * SLOTS), 0.0
    for _ in range(rounds):
        score = np.bincount(row, weights[slots] * value, len(rows)) + bias
        error = (1 / (1 + np.exp(-score)) - wanted) / len(rows)
        weights -= 10.0 * (np.bincount(slots, error[row] * value, 2 * SLOTS) + ridge / len(rows) * weights)
        bias -= 1.0 * error.sum()
    return np.append(weights, bias)


def score_urls(host: Column, path: Column, weights: np.ndarray) -> Column:
    """Probability that a URL is to be blocked."""

    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for hosts, paths in parts:
            found = _features(pa.array(hosts, pa.string()), pa.array(paths, pa.string()))
            z = sum(row_sums(weights[slots], counts) * _scale(counts) for slots, counts in found) + weights[-1]
            yield pd.Series(1 / (1 + np.exp(-z)))

    return score(host, path)


def judge_urls(pages: DataFrame, key: str = "page_id", url: str = "url", rules: Sequence[tuple[str, str]] = RULES,
               weights: np.ndarray | None = None) -> DataFrame:
    """key, host, path, rule, verdict and the model's score of every row.

    A rule fits its host and all subdomains when the path starts with the rule's path; the
    longest wins, and without one the model blocks from a score of 0.5.  Defined cases:
    NULL or a URL without `://` has empty host and path, which the model judges as any other;
    repeated rows are judged alike; an empty table gives no rows; other columns are not read.
    """
    ship(pages.sparkSession)
    weights = fit() if weights is None else weights
    parts = pages.select(F.col(key).alias("_key"), host_of(F.coalesce(url, F.lit(""))).alias("host"),
                         path_of(F.coalesce(url, F.lit(""))).alias("path"))
    judged = parts.withColumn("_rule", rule_for(F.col("host"), F.col("path"), rules)).withColumn(
        "score", score_urls(F.col("host"), F.col("path"), weights)
    )
    model = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return judged.select(F.col("_key").alias(key), "host", "path", F.col("_rule.rule").alias("rule"),
                         F.coalesce("_rule.verdict", model).alias("verdict"), "score")
