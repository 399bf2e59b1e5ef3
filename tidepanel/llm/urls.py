"""URL filter: host and path rules first, gradient-boosted trees on lexical features for the rest."""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled URLs that the trees are fitted on, at most: a sample by hash.
MAX_LABELLED = 20_000
#: Rules are compiled into the plan; more than this belong into a joined table.
MAX_RULES = 1_000

FEATURES = ("length", "host length", "path length", "depth", "digit ratio", "entropy", "parameters", "labels", "longest digits",
            "hyphens", "escapes", "fragment", "https", "upper ratio", "suffix rate", "domain rate", "suffix count")


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits (equal lengths: the first by text), as ``struct<rule, verdict>``; else null."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; {MAX_RULES} at most")
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    found = []
    for r in sorted(set(rules), key=lambda r: (-len(r.text), r.text)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        found.append(F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))))
    return F.coalesce(*found, none) if found else none


def parts(url: str) -> tuple[str, str]:
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url)
    return (m[1].lower(), m[2]) if m else ("", "")


class Suffixes(NamedTuple):
    """Smoothed block rates of host suffixes of one and two labels, learned from labelled URLs."""

    rates: dict[str, float]
    counts: dict[str, int]
    prior: float

    @classmethod
    def learn(cls, urls: Sequence[str], labels: np.ndarray, weight: float = 20.0) -> Suffixes:
        prior = float(labels.mean()) if len(labels) else 0.0
        sums: dict[str, list[float]] = {}
        for url, y in zip(urls, labels):
            names = parts(url)[0].split(".")
            for s in {names[-1], ".".join(names[-2:])}:
                t = sums.setdefault(s, [0.0, 0])
                t[0] += float(y)
                t[1] += 1
        return cls({s: (t + weight * prior) / (n + weight) for s, (t, n) in sums.items()}, {s: n for s, (_, n) in sums.items()}, prior)


def features(urls: Sequence[str], suffixes: Suffixes) -> np.ndarray:
    """One row of ``FEATURES`` per URL; an empty URL has zeros and the prior rate."""
    n = len(urls)
    raw = [u.encode("utf-8", "surrogatepass") for u in urls]
    sizes = np.array([len(r) for r in raw], dtype=np.int64)
    counts = np.bincount(np.repeat(np.arange(n), sizes) * 256 + np.frombuffer(b"".join(raw), np.uint8), minlength=256 * n).reshape(n, 256)
    share = counts / np.maximum(sizes, 1)[:, None]
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(1)
    split = [parts(u) for u in urls]
    out = np.zeros((n, len(FEATURES)))
    out[:, 0] = sizes
    out[:, 1] = [len(h) for h, _ in split]
    out[:, 2] = [len(p) for _, p in split]
    out[:, 3] = [sum(bool(s) for s in p.split("/")) for _, p in split]
    out[:, 4] = share[:, 48:58].sum(1)
    out[:, 5] = entropy
    out[:, 6] = [sum(bool(q) for q in re.split("[&;]", u.partition("?")[2].partition("#")[0])) for u in urls]
    out[:, 7] = [sum(bool(s) for s in h.split(".")) for h, _ in split]
    out[:, 8] = [max(map(len, re.findall("[0-9]+", u)), default=0) for u in urls]
    out[:, 9], out[:, 10] = counts[:, 45], counts[:, 37]
    out[:, 11] = counts[:, 35] > 0
    out[:, 12] = [u.startswith("https:") for u in urls]
    out[:, 13] = share[:, 65:91].sum(1)
    names = [h.split(".") for h, _ in split]
    out[:, 14] = [suffixes.rates.get(x[-1], suffixes.prior) for x in names]
    out[:, 15] = [suffixes.rates.get(".".join(x[-2:]), suffixes.prior) for x in names]
    out[:, 16] = [np.log1p(suffixes.counts.get(".".join(x[-2:]), 0)) for x in names]
    return out


class Trees(NamedTuple):
    """Boosted trees of one depth. Node i of a tree goes to 2i+1 if the feature is at most the cut, else to 2i+2."""

    prior: float
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of the positive class."""
        total, rows = np.full(len(x), self.prior), np.arange(len(x))
        inner = self.feature.shape[1]
        for f, c, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(inner.bit_length()):
                node = 2 * node + 2 - (x[rows, f[node]] <= c[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def boost(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.1, bins: int = 32,
          least: int = 20, ridge: float = 1.0) -> Trees:
    """Newton boosting of the logistic loss on quantile bins. One class or no rows: a constant."""
    mean = np.clip(y.mean() if len(y) else 0.0, 1e-6, 1 - 1e-6)
    prior, inner = float(np.log(mean / (1 - mean))), 2**depth - 1
    if len(y) == 0 or y.min() == y.max():
        return Trees(prior, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], 1)
    wide, k = bins + 1, x.shape[1]
    flat, total = binned + np.arange(k) * wide, np.full(len(y), prior)
    all_f, all_c, all_leaf = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        f, c, node = np.zeros(inner, int), np.full(inner, np.inf), np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            for i in range(2**level - 1, 2 ** (level + 1) - 1):
                mine = np.flatnonzero(node == i)
                if len(mine) >= 2 * least:
                    at = flat[mine].ravel()
                    sums = [np.bincount(at, np.repeat(w[mine], k), k * wide).reshape(k, wide).cumsum(1) for w in (g, h, np.ones(len(y)))]
                    (gl, hl, nl), (gt, ht, nt) = sums, [s[:, -1:] for s in sums]
                    gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                    gain[(nl < least) | (nt - nl < least)] = -1
                    for j in range(k):
                        gain[j, len(cuts[j]):] = -1
                    best = int(gain.argmax())
                    if gain.flat[best] > 1e-9:
                        f[i], c[i] = best // wide, cuts[best // wide][best % wide]
                node[mine] = 2 * i + 2 - (x[mine, f[i]] <= c[i])
        leaves = node - inner
        leaf = rate * np.bincount(leaves, g, inner + 1) / (np.bincount(leaves, h, inner + 1) + ridge)
        total += leaf[leaves]
        all_f.append(f), all_c.append(c), all_leaf.append(leaf)
    return Trees(prior, np.array(all_f), np.array(all_c), np.array(all_leaf))


class UrlModel(NamedTuple):
    suffixes: Suffixes
    trees: Trees

    def score(self, urls: Sequence[str]) -> np.ndarray:
        return self.trees.predict(features(urls, self.suffixes)) if len(urls) else np.zeros(0)


def fit(labelled: DataFrame, max_rows: int = MAX_LABELLED) -> UrlModel:
    """Learn from ``labelled(url, label)``, label 1 to block; null urls or labels are left out.

    At most ``max_rows`` rows are used, those with the least hash of the url; only they reach the driver. Suffix
    rates are learned on every other row and the trees on the rest, so that the rates are honest features there.
    Without labelled rows everything scores near 0.
    """
    rows = labelled.where("url IS NOT NULL AND label IS NOT NULL").select("url", F.col("label").cast("int").alias("label")).orderBy(
        F.xxhash64("url"), "url", "label").limit(max_rows).collect()
    urls, y = [r["url"] for r in rows], np.array([r["label"] for r in rows], dtype=float)
    suffixes = Suffixes.learn(urls[::2], y[::2])
    return UrlModel(suffixes, boost(features(urls[1::2], suffixes), y[1::2]))


def judge(pages: DataFrame, url: str, rules: Sequence[Rule], model: UrlModel, threshold: float = 0.5) -> DataFrame:
    """Add ``host, path, rule, verdict, block_score``; a rule's verdict goes before the trees'.

    The trees block from ``threshold`` on. A null url, or one without ``://``, has empty host and path, fits no
    rule, and a null one scores as the empty text. Columns of these names are replaced, others kept.
    """

    @F.pandas_udf("double")
    def block_score(urls: pd.Series) -> pd.Series:
        return pd.Series(model.score(urls.fillna("").tolist()), dtype=float)

    keep = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in {"host", "path", "rule", "verdict", "block_score"}]
    out = pages.select(*keep, host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"),
                       block_score(F.col(f"`{url}`")).alias("block_score"))
    ruled = out.withColumn("_rule", matching_rule(F.col("host"), F.col("path"), rules))
    return ruled.withColumn("rule", F.col("_rule.rule")).withColumn("verdict", F.coalesce(
        F.col("_rule.verdict"), F.when(F.col("block_score") >= threshold, "block").otherwise("allow"))).drop("_rule")
