"""URL filters: host-and-path rules first, gradient-boosted trees on lexical features for the rest.

A rule (host, path) fits a url whose host is the rule's or one of its subdomains and whose path starts with the rule's; of those that
fit, the longest (host plus path) wins, a block rule before an allow rule of the same length. Urls that a rule decides are the
labelled urls; the trees learn from a bounded sample of the distinct ones (the ``sample`` smallest hashed, default 20,000, whatever
their number of rows) and judge the rest. Features: lengths of url, host and path, path depth, shares of digits and letters, character
entropy, host labels, hyphens, query parameters, fragment, scheme, and how often other urls of the sample with the same top-level name
or path ending were allowed: each url's rates come from the folds of the sample that it is not in, so no label reaches its own features.

Edge cases: a null url, or one without "://", has an empty host and path and fits no rule; with no labelled urls, or one class only,
the trees are a constant (allow when there are none). Repeated rows are judged alike; other columns are neither read nor kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import slices, smallest_hashed

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_AFTER = re.compile(r"[/?#]")

FEATURES = ("length", "host_length", "path_length", "depth", "digit_ratio", "letter_ratio", "entropy", "host_labels", "hyphens", "params", "has_fragment", "https", "tld_rate", "ending_rate")


def split_url(url: str | None) -> tuple[str, str, str]:
    """(host, path, what follows the path)."""
    if url is None or (at := url.find("://")) < 0:
        return "", "", ""
    rest = url[at + 3 :]
    m = _AFTER.search(rest)
    host, rest = (rest[: m.start()], rest[m.start() :]) if m else (rest, "")
    m = re.search(r"[?#]", rest)
    path, tail = (rest[: m.start()], rest[m.start() :]) if m else (rest, "")
    return host.translate(_UPPER), path, tail


class Rules:
    """rules: (host, path, 'allow' or 'block'); they are held in memory, so at most ``most`` of them."""

    def __init__(self, rules: list[tuple[str, str, str]], most: int = 1_000_000):
        if len(rules) > most:
            raise ValueError(f"{len(rules)} rules; at most {most} fit")
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for host, path, verdict in rules:
            self.by_host.setdefault(host, []).append((path, host + path, verdict))

    def find(self, host: str, path: str) -> tuple[str | None, str | None]:
        best: tuple = (-1, False, None, None)
        at = host
        while at:
            for start, name, verdict in self.by_host.get(at, ()):
                if path.startswith(start):
                    best = max(best, (len(name), verdict == "block", name, verdict), key=lambda x: x[:2])
            dot = at.find(".")
            at = at[dot + 1 :] if dot >= 0 else ""
        return best[2], best[3]


def _keys(host: str, path: str) -> tuple[str, str]:
    last = path.rsplit("/", 1)[-1]
    return host.rsplit(".", 1)[-1], last.rsplit(".", 1)[-1] if "." in last else ("/" if path.endswith("/") else "")


def features(urls: list[str | None], tld: dict, ending: dict, base: float) -> np.ndarray:
    out = np.zeros((len(urls), len(FEATURES)), np.float32)
    for i, url in enumerate(urls):
        host, path, tail = split_url(url)
        u = url or ""
        raw = np.frombuffer(u.encode("utf-8", "surrogatepass"), np.uint8)
        n = max(1, len(raw))
        p = np.bincount(raw, minlength=1) / n
        p = p[p > 0]
        t, e = _keys(host, path)
        query = tail.split("#", 1)[0]
        out[i] = (len(raw), len(host), len(path), path.count("/"), ((raw >= 48) & (raw <= 57)).sum() / n, (((raw | 32) >= 97) & ((raw | 32) <= 122)).sum() / n, -(p * np.log2(p)).sum() if len(p) else 0, host.count(".") + 1 if host else 0, u.count("-"), query.count("=") if query else 0, "#" in tail, u[:8].lower() == "https://", tld.get(t, base), ending.get(e, base))
    return out


@dataclass
class Trees:
    """Boosted regression trees on the logistic loss; each is stored as arrays over a complete binary tree."""

    base: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)  # feature (-1: leaf), threshold, value

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for feature, cut, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(len(feature) + 1)) - 1):
                f = feature[at]
                down = f >= 0
                right = down & (x[np.arange(len(x)), np.maximum(f, 0)] > cut[at])
                at = np.where(down, 2 * at + 1 + right, at)
            out += value[at]
        return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 4, rate: float = 0.2, bins: int = 64, l2: float = 1.0, least: float = 5.0) -> Trees:
    """Newton boosting with histogram splits."""
    p = min(max(float(y.mean()), 1e-6), 1 - 1e-6) if len(y) else 1 - 1e-6
    model = Trees(float(np.log(p / (1 - p))))
    if len(y) == 0 or y.min() == y.max():
        return model
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    code = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    z = np.full(len(y), model.base)
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-z))
        g, h = q - y, q * (1 - q)
        size = 2 ** (depth + 1) - 1
        feature, cut, value, at = np.full(size, -1), np.zeros(size, np.float32), np.zeros(size), np.zeros(len(y), np.int64)
        for node in range(size):
            rows = np.flatnonzero(at == node)
            if not len(rows):
                continue
            gs, hs = g[rows].sum(), h[rows].sum()
            value[node] = -rate * gs / (hs + l2)
            if 2 * node + 2 >= size or hs < 2 * least / 4:
                continue
            best = (1e-6, -1, 0)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                c = code[rows, f]
                gl, hl, nl = (np.cumsum(np.bincount(c, weights=w, minlength=len(e) + 1))[:-1] for w in (g[rows], h[rows], np.ones(len(rows))))
                gain = gl**2 / (hl + l2) + (gs - gl) ** 2 / (hs - hl + l2) - gs**2 / (hs + l2)
                gain[(nl < least) | (len(rows) - nl < least)] = 0
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], f, k)
            if best[1] >= 0:
                feature[node], cut[node] = best[1], edges[best[1]][best[2]]
                at[rows] = 2 * node + 1 + (code[rows, best[1]] > best[2])
        model.trees.append((feature, cut, value))
        z = model.base * 0 + model.margin(x)
    return model


@dataclass
class UrlModel:
    tld: dict
    ending: dict
    base: float
    trees: Trees

    def allow(self, urls: list[str | None]) -> np.ndarray:
        return self.trees.margin(features(urls, self.tld, self.ending, self.base)) >= 0


def _rates(urls: list[str], y: np.ndarray, base: float, smooth: float) -> tuple[dict, dict]:
    """Smoothed share of allowed urls for each top-level name, and each path ending."""
    out: list[dict] = []
    for k in (0, 1):
        n: dict = {}
        for u, label in zip(urls, y, strict=True):
            a = n.setdefault(_keys(*split_url(u)[:2])[k], [0, 0])
            a[0] += int(label)
            a[1] += 1
        out.append({key: (a + smooth * base) / (b + smooth) for key, (a, b) in n.items()})
    return out[0], out[1]


def fit_urls(urls: list[str], y: np.ndarray, smooth: float = 20.0, folds: int = 5) -> UrlModel:
    """urls: distinct; they are in the order of their hashes, so taking every ``folds``-th one is a random fold."""
    base = float(y.mean()) if len(y) else 1.0
    fold = np.arange(len(urls)) % folds
    x = np.zeros((len(urls), len(FEATURES)), np.float32)
    for f in range(folds):
        mine, others = np.flatnonzero(fold == f), np.flatnonzero(fold != f)
        x[mine] = features([urls[i] for i in mine], *_rates([urls[i] for i in others], y[others], base, smooth), base)
    return UrlModel(*_rates(urls, y, base, smooth), base, boost(x, y.astype(np.float64)))


def labelled(pages: DataFrame, rules: Rules) -> DataFrame:
    """url, allow: the distinct urls that a rule decides."""

    def label(batches):
        for b in slices(batches, 10_000):
            urls = b.column(0).to_pylist()
            got = [(u, v == "allow") for u in urls if (v := rules.find(*split_url(u)[:2])[1])]
            yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in got], pa.string()), pa.array([a for _, a in got], pa.bool_())], ["url", "allow"])

    return pages.select("url").where("url is not null").mapInArrow(label, "url string, allow boolean").distinct()


def fit(pages: DataFrame, rules: Rules, sample: int = 20_000) -> UrlModel:
    rows = smallest_hashed(labelled(pages, rules), ["url"], sample).toArrow()  # at most ``sample`` rows
    return fit_urls(rows.column("url").to_pylist(), np.array(rows.column("allow").to_pylist(), bool))


def judge(pages: DataFrame, rules: Rules, model: UrlModel) -> DataFrame:
    """page_id, host, path, rule, verdict for every row."""

    def run(batches):
        for b in slices(batches, 10_000):
            urls = b.column(1).to_pylist()
            parts = [split_url(u) for u in urls]
            found = [rules.find(h, p) for h, p, _ in parts]
            verdict = [v for _, v in found]
            open_ = [i for i, v in enumerate(verdict) if v is None]
            if open_:
                for i, ok in zip(open_, model.allow([urls[i] for i in open_]), strict=True):
                    verdict[i] = "allow" if ok else "block"
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([p[0] for p in parts], pa.string()), pa.array([p[1] for p in parts], pa.string()), pa.array([r for r, _ in found], pa.string()), pa.array(verdict, pa.string())], ["page_id", "host", "path", "rule", "verdict"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url").mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")
