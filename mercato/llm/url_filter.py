"""URL verdicts by rules, else by a ratio of character language models.

Two variable-order Markov models over bytes, one of accepted and one of rejected URLs,
give each byte a probability that interpolates all context lengths up to ORDER (the
weight of a longer context grows with how often it was seen, Witten-Bell). The mean
difference of their log-likelihoods per byte, over the whole URL, is compared with a
threshold.

Labels: hosts that hold a word of REJECTED_HOSTS seed the rejected class; the others are
not yet accepted. Each is first scored by models that saw no URL of its host (folds by
host). Hosts most of whose URLs are likelier as rejected ones, unseen, join the rejected
class, so that kinds of hosts outside the seed list are found, and the others are the accepted
class. The threshold is set on scores of both classes, again by models that didn't see the
host: the fewest errors, a class counting as a whole, with at most FALSE_BLOCKS of the
accepted URLs above it.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from mercato.session import table

ORDER = 5
#: At most so many distinct URLs of a class train the models, chosen by hash.
SAMPLE = 4000
FALSE_BLOCKS = 0.01
#: Folds of hosts, and the share of a host's URLs that must score as rejected for it to be.
FOLDS, HOST_SHARE = 5, 0.5
#: Host words that seed the rejected class.
REJECTED_HOSTS = ("spam", "adult", "casino", "porn", "phish", "malware")
#: (rule, verdict): a host and a path prefix.
RULES = (
    ("com/en/", "block"),
    ("example.com/en/7", "allow"),
    ("net/de/", "allow"),
    ("example.net/de/8", "block"),
    ("org/es/", "block"),
)


class Markov:
    def __init__(self, urls: list[bytes]):
        counts: list[dict[bytes, dict[int, int]]] = [{} for _ in range(ORDER + 1)]
        for u in urls:
            u += b"\0"
            for i, c in enumerate(u):
                for k in range(min(i, ORDER) + 1):
                    d = counts[k].setdefault(u[i - k : i], {})
                    d[c] = d.get(c, 0) + 1
        self.counts = [{x: (d, sum(d.values()), len(d)) for x, d in level.items()} for level in counts]

    def log_likelihood(self, url: bytes) -> float:
        url += b"\0"
        total = 0.0
        for i, c in enumerate(url):
            p = 1 / 256
            for k in range(min(i, ORDER) + 1):
                found = self.counts[k].get(url[i - k : i])
                if found is None:
                    break
                d, n, kinds = found
                p = (d.get(c, 0) + kinds * p) / (n + kinds)
            total += np.log(p)
        return float(total)


@dataclass
class RatioModel:
    accepted: Markov
    rejected: Markov
    threshold: float

    def difference(self, url: bytes) -> float:
        return (self.rejected.log_likelihood(url) - self.accepted.log_likelihood(url)) / (len(url) + 1)


Urls = list[tuple[str, bytes]]  # (host, whole URL)


def _unseen(accepted: Urls, rejected: Urls) -> tuple[np.ndarray, np.ndarray]:
    """Differences of the URLs of both classes by models that saw no URL of the same fold of hosts.

    A fold that holds all of a class is scored by models of the other folds and all of the class.
    """
    fold = lambda host: xxhash.xxh64_intdigest(host.encode(), 3) % FOLDS
    out = [np.zeros(len(accepted)), np.zeros(len(rejected))]
    for f in range(FOLDS):
        own = [[i for i, (h, _) in enumerate(urls) if fold(h) == f] for urls in (accepted, rejected)]
        if not any(own):
            continue
        rest = [[u for h, u in urls if fold(h) != f] or [u for _, u in urls] for urls in (accepted, rejected)]
        m = RatioModel(Markov(rest[0]), Markov(rest[1]), 0.0)
        for scores, urls, some in zip(out, (accepted, rejected), own):
            scores[some] = [m.difference(urls[i][1]) for i in some]
    return out[0], out[1]


def _threshold(good: np.ndarray, bad: np.ndarray) -> float:
    """The value between scores with the least sum of both error rates, at most FALSE_BLOCKS of good above it."""
    at = np.unique(np.concatenate([good, bad]))
    at = np.concatenate([[at[0] - 1], (at[:-1] + at[1:]) / 2, [at[-1] + 1]])
    above = 1 - np.searchsorted(np.sort(good), at, "right") / len(good)
    missed = np.searchsorted(np.sort(bad), at, "right") / len(bad)
    cost = np.where(above <= FALSE_BLOCKS, above + missed, np.inf)
    return float(at[int(np.argmin(cost))])


def train(unlabelled: Urls, seeds: Urls) -> RatioModel | None:
    """None where either is empty: then nothing is blocked."""
    if not unlabelled or not seeds:
        return None
    scores, _ = _unseen(unlabelled, seeds)
    by_host: dict[str, list[bool]] = {}
    for (host, _), s in zip(unlabelled, scores):
        by_host.setdefault(host, []).append(s > 0)
    alike = {h for h, seen in by_host.items() if sum(seen) > HOST_SHARE * len(seen)}
    accepted = [x for x in unlabelled if x[0] not in alike]
    rejected = seeds + [x for x in unlabelled if x[0] in alike]
    if not accepted:
        accepted, rejected = unlabelled, seeds
    m = RatioModel(Markov([u for _, u in accepted]), Markov([u for _, u in rejected]), 0.0)
    m.threshold = _threshold(*_unseen(accepted, rejected))
    return m


def parts(url: str | Column) -> tuple[Column, Column]:
    """(host, path) of a URL column; both empty for null or where there is no `://`."""
    url = F.col(url) if isinstance(url, str) else url
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits the host or a parent domain of it and the path's start."""
    rule = verdict = F.lit(None).cast("string")
    for text, what in sorted(rules, key=lambda r: len(r[0])):  # the longest is asked last and so wins
        at, _, rest = text.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def fit(pages: DataFrame, url_col: str = "url", is_rejected: Column | None = None) -> RatioModel | None:
    """Models from SAMPLE distinct URLs, seeds of the rejected class and SAMPLE others; seeds are by REJECTED_HOSTS where is_rejected is null.

    Null and empty URLs are left out, repeated ones count once; None for an empty table.
    """
    host, _ = parts(url_col)
    some = pages.select(host.alias("host"), F.col(url_col).alias("u"), (is_rejected if is_rejected is not None else F.lit(None)).alias("given")).where("u <> ''")
    named = F.coalesce(F.col("given").cast("boolean"), F.col("host").rlike("|".join(REJECTED_HOSTS)))
    some = some.select("host", "u", named.alias("bad")).distinct()
    pick = lambda bad: [(r["host"], r["u"].encode()) for r in some.where(F.col("bad") == bad).orderBy(F.xxhash64("u"), "u").limit(SAMPLE).collect()]
    return train(pick(False), pick(True))


def judge(pages: DataFrame, model: RatioModel | None, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, difference), one row per row of pages.

    verdict is the rule's; without a rule it is block where the difference is over the
    threshold. Every byte of the URL counts, query and fragment too, and URLs without a
    `://` are scored like others. A null or empty URL has difference null and is allowed.
    Repeated rows get equal answers, an empty table none. Other columns aren't read.
    """
    held = pages.sparkSession.sparkContext.broadcast(model)  # at most 2 * SAMPLE urls' contexts
    host, path = parts(url_col)
    some = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), F.col(url_col).alias("url"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    some = some.withColumns({"rule": rule, "verdict": verdict})
    names = ["page_id", "host", "path", "rule", "verdict"]
    schema = T.StructType([*(some.schema[n] for n in names), T.StructField("difference", T.DoubleType())])

    def work(batches):
        m = held.value
        for b in batches:
            verdicts, diffs = [], []
            for u, v in zip(b.column("url").to_pylist(), b.column("verdict").to_pylist()):
                d = m.difference(u.encode()) if m and u else None
                diffs.append(d)
                verdicts.append(v or ("block" if d is not None and d > m.threshold else "allow"))
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names[:4]), pa.array(verdicts, pa.string()), pa.array(diffs, pa.float64())], names=[*names, "difference"])

    return some.mapInArrow(work, schema)


def op1_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return judge(pages, fit(pages))
