"""Mixing sources to target shares of the total token size."""

from __future__ import annotations

import base64
import math
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.llm.sample import labelled_sample
from strandwise.session import Scratch, spread

#: Environment variable and default folder of the tokenizer files, which are read where they lie.
TOKENIZERS = os.environ.get("STRANDWISE_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Splits text before byte pairs are merged: words with a leading blank, numbers, signs, blanks.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Targets are a list on the driver, and each document carries a number for each; more domains than this are refused.
MAX_DOMAINS = 1_000


def _counter(folder: str, vocabulary: str):
    """A function that counts the tokens of a text; 0 for null and empty texts."""
    import tiktoken

    with open(os.path.join(folder, vocabulary), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda t: len(enc.encode_ordinary(t)) if t else 0


def token_counts(docs: DataFrame, text: str, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """Adds n_tokens: tokens of the whole text in a public byte-pair vocabulary; 0 for null and empty texts."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = _counter(folder, vocabulary)
        for texts in batches:
            yield pd.Series([count(t) for t in texts], dtype="int64")

    return docs.withColumn("n_tokens", F.pandas_udf(run, "long")(F.col(text)))


class DomainModel:
    """Posterior of the domain of a text: a linear softmax over hashed words, fitted on a bounded sample, with a calibrated temperature."""

    def __init__(self, domains: list[str], buckets: int = 1 << 14, seed: int = 5):
        self.domains, self.buckets, self.seed = domains, buckets, seed
        self.weight = np.zeros((buckets, len(domains)), np.float32)
        self.offset = np.zeros(len(domains), np.float32)
        self.temperature = 1.0

    def features(self, text: str) -> np.ndarray:
        return np.unique([zlib.crc32(w.encode()) % self.buckets for w in text.lower().split()] or [0])

    def fit(self, texts: list[str], labels: list[int], epochs: int = 5, rate: float = 0.5) -> DomainModel:
        """Fits on three quarters of the texts; on the others the temperature minimises the log loss.

        Labels may be wrong: first each half is read by a model of the other half, and texts that it gives to another domain
        with a probability of a half or more teach nothing and calibrate nothing.
        """
        rng = np.random.default_rng(self.seed)
        bags, y = [self.features(t) for t in texts], np.array(labels, dtype=np.int64)
        half, right = rng.random(len(bags)) < 0.5, np.ones(len(bags), bool)
        for side in (half, ~half):
            self._steps(bags, y, np.flatnonzero(side), rng, epochs, rate)
            for i in np.flatnonzero(~side):
                p = self._softmax(self._logits(bags[i]))
                right[i] = p.max() < 0.5 or p.argmax() == y[i]
        held = rng.random(len(bags)) < 0.25
        self._steps(bags, y, np.flatnonzero(~held & right), rng, epochs, rate)
        z = [(self._logits(bags[i]), y[i]) for i in np.flatnonzero(held & right)]
        if z:
            self.temperature = min((2.0**k for k in range(-2, 8)), key=lambda t: sum(-math.log(max(1e-12, self._softmax(x / t)[k])) for x, k in z))
        return self

    def _steps(self, bags: list[np.ndarray], y: np.ndarray, use: np.ndarray, rng: np.random.Generator, epochs: int, rate: float) -> None:
        """Stochastic gradient steps of the softmax from nought."""
        self.weight[:], self.offset[:] = 0.0, 0.0
        for e in range(epochs):
            for i in rng.permutation(use):
                b = bags[i]
                err = self._softmax(self._logits(b))
                err[y[i]] -= 1
                self.weight[b] -= rate / (1 + e) / math.sqrt(len(b)) * err
                self.offset -= 0.1 * rate / (1 + e) * err

    def _logits(self, bag: np.ndarray) -> np.ndarray:
        return self.weight[bag].sum(0) / math.sqrt(len(bag)) + self.offset

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max())
        return e / e.sum()

    def posterior(self, text: str) -> np.ndarray:
        return self._softmax(self._logits(self.features(text)) / self.temperature)


def membership(posterior: np.ndarray, label: int, trust: float) -> np.ndarray:
    """A text's share in each domain: the posterior with the label, where there is one (not -1), as a prior that is right with probability `trust`."""
    n = len(posterior)
    if label < 0 or n == 1:
        return posterior
    p = posterior * ((1 - trust) / (n - 1))
    p[label] = posterior[label] * trust
    return p / p.sum()


def fit_domains(docs: DataFrame, doc_id: str, text: str, source: str, domains: list[str], per_domain: int = 60) -> DomainModel:
    """Fits on the `per_domain` documents of each domain with the lowest id hash: a bounded sample of labelled rows."""
    rows = labelled_sample(docs, doc_id, text, F.when(F.col(source).isin(domains), F.col(source)), per_domain)
    return DomainModel(domains).fit([t for _, t in rows], [domains.index(s) for s, _ in rows])


def bounded_least_squares(a: np.ndarray, goal: np.ndarray, cap: np.ndarray, start: np.ndarray, iterations: int = 4000) -> np.ndarray:
    """Rates 0 <= r <= cap with the least squared distance of a'r from the goal, relative to it, by accelerated projected gradient steps.

    a has a row per class of documents and a column per domain. Columns count relative to their goal; classes are scaled to one
    length, so that small ones move as fast as large ones. A domain whose goal is 0 pulls towards 0 on the scale of the whole.
    """
    scale = np.where(goal > 0, goal, max(goal.sum(), 1.0))
    m = (a / scale).T
    size = np.maximum(np.linalg.norm(m, axis=0), 1e-12)
    m, top, x = m / size, cap * size, start * size
    want = goal / scale
    step = 1.0 / max(np.linalg.norm(m, 2) ** 2, 1e-12) if m.size else 0.0
    y, t = x.copy(), 1.0
    for _ in range(iterations):
        new = np.clip(y - step * (m.T @ (m @ y - want)), 0.0, top)
        if (y - new) @ (new - x) > 0:  # the momentum leads uphill: start it anew
            t = 1.0
        t, old = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        y = new + (old - 1) / t * (new - x)
        done = np.abs(new - x).max(initial=0.0) < 1e-12
        x = new
        if done:
            break
    return x / size


def fitted_rates(a: np.ndarray, share: np.ndarray, cap: np.ndarray, labelled: np.ndarray, total: float | None, tolerance: float = 1e-3) -> tuple[np.ndarray, float]:
    """(rates of the classes, total aimed at). Without a given total, the largest one at which every domain comes within `tolerance` of its goal.

    Classes without a label have a rate only where those with one can't meet the goals.
    """

    def at(total: float) -> tuple[np.ndarray, float]:
        goal = share * total
        r = np.clip(np.divide((a @ goal), np.maximum((a @ a.sum(0)), 1e-12)), 0.0, cap) * labelled
        for top in (cap * labelled, cap):
            r = bounded_least_squares(a, goal, top, r)
            off = float((np.abs(a.T @ r - goal)[share > 0] / np.maximum(goal[share > 0], 1e-12)).max(initial=0.0))
            if off <= tolerance or labelled.all():
                break
        return r, off

    if total is not None:
        return at(total)[0], total
    can = a.T @ cap
    reachable = (share > 0) & (can > 0)
    high = float((can[reachable] / share[reachable]).min()) if reachable.any() else 0.0
    low = 0.0
    for _ in range(24):  # halves what is left between a total that fits and one that does not
        if at(high if not low else (middle := (low + high) / 2))[1] <= tolerance:
            if not low:
                low = high
                break
            low = middle
        elif not low:
            low = high / 2
            while low > 1 and at(low)[1] > tolerance:
                high, low = low, low / 2
        else:
            high = middle
        if high - low < 1e-3 * high:
            break
    return at(low)[0], low


def mix(docs: DataFrame, doc_id: str, text: str, source: str, targets: DataFrame, total: float | None = None, trust: float = 0.99, unlabelled: bool = False, bucket_docs: int = 20_000) -> tuple[DataFrame, DataFrame]:
    """(selection, shares): how often each document is taken, and what shares come out.

    targets: source, target_share, max_repeat. selection: doc_id, source, n_tokens, rate, copies (only documents taken).
    shares: one row per source of documents or targets, with target_share, tokens available and taken, actual_share,
    expected_share (of the copies taken, by membership), documents, copies and the largest repeat.

    Every document of a listed source has a soft membership in the domains: the classifier's posterior, with
    its label as a prior that is right with probability `trust`. Documents of other sources have share 0 and are never taken; those
    without a source count as one that is not listed, unless `unlabelled` lets them in: then they are taken where a domain can't meet its target otherwise.
    Documents with the same label and the same most likely domain form a class and share a rate. One pass adds up each class's expected tokens
    by domain; on that small matrix, of at most (domains + 1) x domains classes, projected gradient least squares fits rates
    with 0 <= rate <= max_repeat (of the label, or of the most likely domain) whose expected domain totals match the
    targets. `total` is the number of tokens aimed at; where it can't be met within the repeats, the bounds bind and the shares are
    the nearest ones. By default it is the largest that meets every target. Rates become whole copies, the largest documents first,
    within buckets of about `bucket_docs` documents: each rounds up or down so that the tokens taken follow those of the rates, and what is
    missing in the end is less than one of the bucket's smallest documents. Ties and repeats of a document are rows of their own; null and empty texts have no tokens and are not taken.
    Empty tables give an empty selection.
    """
    spark = docs.sparkSession
    rows = targets.where(F.col("source").isNotNull()).groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeat").alias("cap")).orderBy("source").limit(MAX_DOMAINS + 1).collect()
    if len(rows) > MAX_DOMAINS:
        raise ValueError(f"more than {MAX_DOMAINS} domains")
    domains, n = [r["source"] for r in rows], len(rows)
    share = np.array([r["share"] or 0.0 for r in rows])
    cap = np.array([r["cap"] or 0 for r in rows], dtype=float)
    share = share / share.sum() if share.sum() else share
    model = fit_domains(docs, doc_id, text, source, domains) if domains else DomainModel([])
    shared = spark.sparkContext.broadcast(model)

    def domain_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, count, model = {d: i for i, d in enumerate(domains)}, _counter(TOKENIZERS, VOCABULARY), shared.value
        for pdf in batches:
            label, best, member = [], [], []
            for s, t in zip(pdf["source"], pdf["text"]):
                k = at.get(s, -1 if unlabelled and not s else -2)
                p = membership(model.posterior(t), k, trust) if k > -2 and t and n else None
                label.append(k)
                best.append(-1 if p is None else int(p.argmax()))
                member.append(None if p is None else p.astype(np.float32).tobytes())
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "source": pdf["source"], "n_tokens": [count(t) for t in pdf["text"]], "label": pd.Series(label, dtype="int32"), "best": pd.Series(best, dtype="int32"), "member": member})

    read = spread(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(source).alias("source")))
    table = Scratch(spark).write(read.mapInPandas(domain_of, f"doc_id {dict(docs.dtypes)[doc_id]}, source string, n_tokens long, label int, best int, member binary"))
    listed = table.where("best >= 0 and n_tokens > 0")

    classes, stats = [], []
    for r in _expected(listed.withColumn("weight", F.col("n_tokens").cast("double")), n).toLocalIterator():
        classes.append((r["label"], r["best"]))
        stats.append(np.frombuffer(r["tokens"], np.float64))
    a = np.array(stats).reshape(len(stats), n)
    most = np.array([cap[k if k >= 0 else b] for k, b in classes])
    rates, _ = fitted_rates(a, share, most, np.array([k >= 0 for k, _ in classes]), total) if len(classes) else (np.zeros(0), 0.0)

    rate_of = spark.createDataFrame([(k, b, float(r), int(c)) for (k, b), r, c in zip(classes, rates, most)] or [(-2, -2, 0.0, 0)], "label int, best int, rate double, cap int")
    # a bucket holds documents of one label, or without one of one domain
    sized = listed.select("doc_id", "source", "n_tokens", "label", "best", "member").join(F.broadcast(rate_of), ["label", "best"]).where("rate > 0").withColumn("pile", F.when(F.col("label") >= 0, F.col("label")).otherwise(-1 - F.col("best")))
    sizes = sized.groupBy("pile").agg(F.count(F.lit(1)).alias("n_docs"))
    placed = sized.join(F.broadcast(sizes), "pile").withColumn("h", F.xxhash64("doc_id")).withColumn("bucket", F.pmod("h", F.ceil(F.col("n_docs") / bucket_docs)))
    kinds = dict(placed.dtypes)
    keep = ["doc_id", "source", "n_tokens", "rate", "label", "best", "member"]
    taken_docs = placed.groupBy("pile", "bucket").applyInPandas(_whole_copies(keep), ", ".join([*(f"{c} {kinds[c]}" for c in keep), "copies int"]))
    selection = taken_docs.select("doc_id", "source", "n_tokens", "rate", "copies")

    taken = selection.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens_taken"), F.sum("copies").alias("n_copies"), F.max("copies").alias("most_copies"))
    there = table.groupBy("source").agg(F.sum("n_tokens").alias("tokens_available"), F.count(F.lit(1)).alias("n_docs"))
    soft = np.zeros(n)
    for r in _expected(taken_docs.withColumn("weight", (F.col("n_tokens") * F.col("copies")).cast("double")), n).toLocalIterator():
        soft += np.frombuffer(r["tokens"], np.float64)
    soft = soft / soft.sum() if soft.sum() else soft
    want = spark.createDataFrame([(d, float(s), int(c), float(x)) for d, s, c, x in zip(domains, share, cap, soft)] or [("", 0.0, 0, 0.0)], "source string, target_share double, max_repeat int, expected_share double").where("source <> ''")
    all_taken = taken.agg(F.sum("tokens_taken").alias("all"))
    shares = (
        there.join(want, there["source"].eqNullSafe(want["source"]), "full").select(F.coalesce(there["source"], want["source"]).alias("source"), "target_share", "max_repeat", "expected_share", "tokens_available", "n_docs")
        .join(taken.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").crossJoin(F.broadcast(all_taken))
        .select(
            "source", F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.coalesce("max_repeat", F.lit(0)).alias("max_repeat"),
            F.coalesce("tokens_available", F.lit(0)).alias("tokens_available"), F.coalesce("n_docs", F.lit(0)).alias("n_docs"), F.coalesce("tokens_taken", F.lit(0)).alias("tokens_taken"),
            F.coalesce(F.col("tokens_taken") / F.col("all"), F.lit(0.0)).alias("actual_share"), F.coalesce("n_copies", F.lit(0)).alias("n_copies"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"),
            F.coalesce("expected_share", F.lit(0.0)).alias("expected_share"),
        )
    )
    return selection, shares


def whole_copies(sizes: np.ndarray, rates: np.ndarray, caps: np.ndarray) -> np.ndarray:
    """Copies next to each rate, the last or the first whole number around it, that keep the running total of tokens nearest to that of the rates."""
    out, owed = np.zeros(len(sizes), np.int64), 0.0
    for i, (n, r, c) in enumerate(zip(sizes.tolist(), rates.tolist(), caps.tolist())):
        low = int(r + 1e-9)
        owed += r * n
        out[i] = min(c, low + 1 if r - low > 1e-9 and owed > (low + 0.5) * n else low)
        owed -= out[i] * n
    return out


def _whole_copies(keep: list[str]):
    """Of one bucket, the documents taken; the largest come first, so what is owed in the end is less than one of the smallest."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "h", "doc_id"], ascending=[False, True, True], kind="stable")
        out = pdf[keep].assign(copies=whole_copies(pdf["n_tokens"].to_numpy(), pdf["rate"].to_numpy(), pdf["cap"].to_numpy()).astype(np.int32))
        return out[out["copies"] > 0]

    return run


def _expected(rows: DataFrame, n: int) -> DataFrame:
    """(label, best, tokens): by class the sum of membership times weight, a vector of doubles; one row per task and class is shuffled."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for pdf in batches:
            for k, b, m, w in zip(pdf["label"], pdf["best"], pdf["member"], pdf["weight"]):
                if (k, b) not in total:
                    total[k, b] = np.zeros(n)
                total[k, b] += np.frombuffer(m, np.float32) * w
        yield pd.DataFrame([(k, b, v.tobytes()) for (k, b), v in total.items()], columns=["label", "best", "tokens"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.head(1).assign(tokens=[np.sum([np.frombuffer(x, np.float64) for x in pdf["tokens"]], axis=0).tobytes()])

    schema = "label int, best int, tokens binary"
    return rows.select("label", "best", "member", "weight").mapInPandas(part, schema).groupBy("label", "best").applyInPandas(add, schema)
