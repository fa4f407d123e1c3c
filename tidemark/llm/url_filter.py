"""URL filter: rules by host and path first, then a logistic regression on character n-grams.

Hashed character n-grams (3 to 5) of the host and of the path, each with marks at its bounds,
are the features; the weights are trained in numpy on a small labelled URL table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base, bytewords

_U = np.uint64
BITS = 16
NGRAMS = (3, 4, 5)

# Words of the labelled URL table.  The table has each unwanted word in several
# places of a host or path, and each wanted one likewise.
UNWANTED = (
    "casino poker bets betting jackpot slots gambling lottery roulette wager pills viagra pharmacy cheap-meds "
    "weight-loss ads adserver track tracker banner popup click affiliate sponsor porn xxx adult sex escort "
    "warez crack keygen torrent payday-loans free-money get-rich replica-watches spam win-prize clickbait"
).split()
WANTED = (
    "news science library museum university school research history garden music kitchen travel weather "
    "health city council journal docs wiki forum book review sports culture art energy market law "
    "community village river mountain software data project blog theory nature letter people story"
).split()
FILLERS = "win free best cheap x farm hub zone online club shop 24 now top".split()
SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()


@dataclass(frozen=True)
class Rule:
    """A rule fits a host and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the contract.
RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float


def labelled_urls() -> list[tuple[str, str, int]]:
    """The labelled table (host, path, unwanted), made from the word lists by rule."""
    rng = np.random.default_rng(5)
    tops = ("example.com", "example.org", "example.net", "com", "org", "net", "info", "co.uk", "de", "fr")
    subs = ("", "www.", "m.", "blog.", "")

    def plain() -> str:
        return "".join(rng.choice(SYLLABLES, rng.integers(2, 5)))

    def path() -> str:
        kind = int(rng.integers(5))
        number = str(rng.integers(1, 10_000))
        return ("/" + str(rng.choice(["en", "de", "fr", "es"])) + "/" + number, "/" + plain() + "/" + plain(), "/" + number + ".html", "/", "/" + plain() + ".html")[kind]

    rows = []
    for word in UNWANTED:
        for _ in range(10):
            other = str(rng.choice([plain(), plain()[: int(rng.integers(1, 4))], str(rng.choice(UNWANTED)), str(rng.choice(FILLERS))]))
            name = str(rng.choice([word, f"{word}-{other}", f"{word}-{other}", f"{other}-{word}", word + other, other + word]))
            host = str(rng.choice(subs)) + name + "." + str(rng.choice(tops))
            rows += [(host, path(), 1) for _ in range(2)]
        rows.append((str(rng.choice(subs)) + plain() + "." + str(rng.choice(tops)), f"/{word}/{plain()}", 1))
    for word in WANTED:
        for _ in range(5):
            other = str(rng.choice([plain(), str(rng.choice(WANTED))]))
            name = str(rng.choice([word, f"{word}-{other}", other + word]))
            host = str(rng.choice(subs)) + name + "." + str(rng.choice(tops))
            rows += [(host, path(), 0) for _ in range(2)]
        rows.append((str(rng.choice(subs)) + plain() + "." + str(rng.choice(tops)), f"/{word}/{plain()}", 0))
    for _ in range(1200):
        rows.append((str(rng.choice(subs)) + plain() + "." + str(rng.choice(tops)), path(), 0))
    return rows


def features(host: bytes, path: bytes) -> np.ndarray:
    """Buckets of the distinct n-grams of host and path."""
    out = []
    for salt, part in ((1, host), (2, path)):
        if not part:
            continue
        values = bytewords.BYTE[np.frombuffer(b"^" + part + b"$", np.uint8)]
        with np.errstate(over="ignore"):
            h = values
            for n in range(2, NGRAMS[-1] + 1):
                if len(values) < n:
                    break
                h = h[:-1] * _U(bytewords.RADIX) + values[n - 1 :]
                if n in NGRAMS:
                    out.append(((h + _U(8 * n + salt)) * bytewords.GOLDEN) >> _U(64 - BITS))
    return np.unique(np.concatenate(out)).astype(np.int64) if out else np.zeros(0, np.int64)


def trained(rows: Sequence[tuple[str, str, int]], epochs: int = 20, rate: float = 1.0, penalty: float = 1e-5, seed: int = 3) -> Model:
    """Logistic regression by gradient descent; features count 1 / sqrt(their number) each."""
    rng = np.random.default_rng(seed)
    data = [(features(h.encode(), p.encode()), y) for h, p, y in rows]
    weights, bias = np.zeros(1 << BITS), 0.0
    for epoch in range(epochs):
        step = rate / (1 + epoch / 5)
        for k in rng.permutation(len(data)):
            ids, y = data[k]
            x = 1 / np.sqrt(max(1, len(ids)))
            g = 1 / (1 + np.exp(-(bias + x * weights[ids].sum()))) - y
            weights[ids] -= step * (g * x + penalty * weights[ids])
            bias -= step * g
    return Model(weights.astype(np.float32), float(bias))


def probability(host: bytes, path: bytes, model: Model) -> float:
    """How likely the URL is unwanted."""
    ids = features(host, path)
    return float(1 / (1 + np.exp(-(model.bias + model.weights[ids].sum(dtype=np.float64) / np.sqrt(max(1, len(ids)))))))


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(base.lowered(rest), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits (the first of equal length), else nulls."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        text, verdict = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def judged(pages: DataFrame, model: Model | None = None, rules: Sequence[Rule] = RULES, threshold: float = 0.5) -> DataFrame:
    """``pages`` with host, path, probability (that it is unwanted), rule and verdict; such columns are replaced.

    A null url, or one without ``://``, has empty host and path; no rule fits it, and the bias
    of the model alone decides.  Rows are judged one by one and never moved: equal rows get equal
    verdicts, and an empty table gives none.  A very long URL is judged whole.  Of several rules that
    fit at the same length the first one counts.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or trained(labelled_urls()))

    def run(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        known: dict = {}
        out = []
        for h, p in zip(hosts.to_pylist(), paths.to_pylist()):
            if (h, p) not in known:
                known[h, p] = probability(h.encode(), p.encode(), shared.value)
            out.append(known[h, p])
        return pa.array(out, pa.float64())

    parts = base.with_results(pages, F.struct(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")), ["host", "path"])
    scored = base.with_results(parts, F.struct(F.arrow_udf(run, "double")(F.col("host"), F.col("path")).alias("probability")), ["probability"])
    rule, verdict = best_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("probability") >= threshold, "block").otherwise("allow")
    return base.with_results(scored, F.struct(rule.alias("rule"), F.coalesce(verdict, own).alias("verdict")), ["rule", "verdict"])
