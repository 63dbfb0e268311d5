"""Passages of held-out items inside a corpus: latent semantic retrieval, then alignment of words."""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.session import Scratch, spread

_MARKUP = re.compile(r"<[^<>]{1,200}>|\[\d{1,4}\]|&#?\w{1,8};")
_WORD = re.compile(r"[^\W_]+")
#: The code of no word: stands between texts and equals nothing.
GAP = 0
#: Buckets of the hashed features (words and word pairs); bounds the latent space however many items there are.
BUCKETS = 1 << 19
#: Words of the items that one pass over the coded corpus looks for; more items take more passes, with the same space and thresholds.
BLOCK_WORDS = 1_000_000
#: Rows of the latent basis that travel together.
ROWS = 1024


def words(text: str) -> list[str]:
    """Words without case, accents, punctuation and markup; citation marks such as [12] are markup."""
    t = _MARKUP.sub(" ", text) if "<" in text or "[" in text or "&" in text else text
    if not t.isascii():
        t = "".join(c for c in unicodedata.normalize("NFKD", t.casefold()) if not unicodedata.combining(c))
    return _WORD.findall(t.lower())


def encode(text: str | None, memo: dict[str, int]) -> np.ndarray:
    """The words of a text as 32-bit codes, the same for all texts. Two words share a code once in four billion pairs."""
    out = []
    for w in words(text or ""):
        code = memo.get(w)
        if code is None:
            if len(memo) > 1_000_000:
                memo.clear()
            code = memo[w] = (zlib.crc32(w.encode()) - (1 << 31)) or 1
        out.append(code)
    return np.array(out, dtype=np.int32)


@dataclass(frozen=True)
class Params:
    window: int = 24  # words of a passage
    stride: int = 10  # between passages of a document; a leak of 30 words holds a passage but for 3 words
    item_stride: int = 4  # between passages of an item
    rank: int = 96  # dimensions of the latent space
    oversample: int = 16
    iterations: int = 1  # of the subspace after the first pass
    cosine: float = 0.55  # of candidates in the latent space
    known: float = 0.15  # least share of a passage's weight in features of the items; others are no candidates
    probes: int = 12  # cells of item passages that a passage is compared with
    least_words: int = 30  # of a leak
    edits: float = 0.125  # at most this share of its words replaced, added or dropped
    paraphrase: float = 0.5  # least common subsequence of an item's words for a paraphrase with its answer
    seed: int = 7


def buckets_of(t: np.ndarray) -> np.ndarray:
    """(2, n): the buckets of the word and of the word pair that begin at each place; -1 where a gap is part of it."""
    u = t.astype(np.int64) & 0xFFFFFFFF
    out = np.full((2, len(t)), -1, np.int64)
    out[0] = np.where(t != GAP, (u * 0x9E3779B1 >> 7) % BUCKETS, -1)
    if len(t) > 1:
        mixed = ((u[:-1] * 0x85EBCA6B + u[1:] * 0xC2B2AE35) >> 11) % BUCKETS
        out[1, :-1] = np.where((t[:-1] != GAP) & (t[1:] != GAP), mixed, -1)
    return out


def runs_of(t: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit code of the `n` words that begin at each place but the last n - 1."""
    if len(t) < n:
        return np.zeros(0, np.uint64)
    u, out = t.astype(np.uint64), np.zeros(len(t) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + u[k : len(t) - n + 1 + k]
        out ^= out >> np.uint64(29)
    return out


class Features:
    """Which buckets are features (those of the items), and their numbers."""

    def __init__(self, texts: list[np.ndarray]):
        used = np.zeros(BUCKETS, bool)
        for t in texts:
            b = buckets_of(t)
            used[b[b >= 0]] = True
        self.size = int(used.sum())
        self.number = np.where(used, np.cumsum(used) - 1, -1).astype(np.int32)

    def of(self, t: np.ndarray) -> np.ndarray:
        """(2, n): the features that begin at each place, -1 where the items lack them."""
        b = buckets_of(t)
        return np.where(b >= 0, self.number[b], -1)


def starts_of(n: int, window: int, stride: int) -> np.ndarray:
    """Starts of the passages of a text; the last one ends with the text."""
    if n <= window:
        return np.zeros(min(n, 1), np.int64)
    out = np.arange(0, n - window + 1, stride)
    return out if out[-1] == n - window else np.r_[out, n - window]


def joined(arrays: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All word codes one text after the other with a gap behind each, where each text begins, and where it ends."""
    lens = np.array([len(a) for a in arrays], dtype=np.int64)
    begin = np.cumsum(lens + 1) - lens - 1
    out = np.full(int(lens.sum()) + len(arrays), GAP, np.int32)
    for b, a in zip(begin, arrays):
        out[b : b + len(a)] = a
    return out, begin, begin + lens


def passages_of(begin: np.ndarray, end: np.ndarray, window: int, stride: int) -> np.ndarray:
    """(n, 3): text, place of the first word, words of each passage."""
    parts = [(i, b + starts_of(e - b, window, stride), e) for i, (b, e) in enumerate(zip(begin, end)) if e > b]
    if not parts:
        return np.zeros((0, 3), np.int64)
    at = np.concatenate([p[1] for p in parts])
    text = np.repeat([p[0] for p in parts], [len(p[1]) for p in parts])
    return np.stack([text, at, np.minimum(window, np.repeat([p[2] for p in parts], [len(p[1]) for p in parts]) - at)], axis=1)


class Passages:
    """Weighted features of passages of several texts, one after the other."""

    def __init__(self, feats: np.ndarray, starts: np.ndarray, lengths: np.ndarray, idf: np.ndarray, other: float):
        w = np.where(feats >= 0, idf[np.maximum(feats, 0)], 0.0).astype(np.float32) if len(idf) else np.zeros(feats.shape, np.float32)
        full = np.where(feats >= 0, w * w, other * other).sum(0)
        known = (w * w).sum(0)
        run = lambda x: np.concatenate([[0.0], np.cumsum(x, dtype=np.float64)])
        f, k = run(full), run(known)
        self.known_share = (k[starts + lengths] - k[starts]) / np.maximum(f[starts + lengths] - f[starts], 1e-9)
        self.feats, self.weights, self.starts, self.lengths = feats, w, starts, lengths

    def entries(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, feature, weight) of the kept passages, by row."""
        lens = self.lengths[keep]
        place = np.repeat(self.starts[keep] - np.concatenate([[0], np.cumsum(lens)[:-1]]), lens) + np.arange(lens.sum())
        row = np.repeat(np.arange(len(keep)), lens)
        f, w = self.feats[:, place].T.ravel(), self.weights[:, place].T.ravel()
        ok = (f >= 0) & (w > 0)
        return np.repeat(row, 2)[ok], f[ok], w[ok]

    def project(self, keep: np.ndarray, basis: np.ndarray) -> np.ndarray:
        """The kept passages times the basis, blockwise."""
        out = np.zeros((len(keep), basis.shape[1]), np.float32)
        for a in range(0, len(keep), 2048):
            r, f, w = self.entries(keep[a : a + 2048])
            if len(f):
                edge = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
                out[a + r[edge]] = np.add.reduceat(basis[f] * w[:, None], edge, axis=0)
        return out


def _arrays(pdf: pd.DataFrame) -> list[np.ndarray]:
    return [np.frombuffer(b, np.int32) for b in pdf["words"]]


def _cosines(a: np.ndarray) -> np.ndarray:
    return a / np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-9)


class Index:
    """Item passages in cells around centres; a query meets the passages of its nearest cells only."""

    def __init__(self, latent: np.ndarray, seed: int, rounds: int = 3):
        n = len(latent)
        cells = max(1, int(n**0.5))
        self.centres = latent[np.random.default_rng(seed).permutation(n)[:cells]].copy()
        for _ in range(rounds):
            near = self._nearest(latent)
            for c in range(cells):
                own = latent[near == c]
                if len(own):
                    self.centres[c] = own.mean(0)
            self.centres = _cosines(self.centres)
        near = self._nearest(latent)
        self.order = np.argsort(near, kind="stable")
        self.latent = latent[self.order]
        self.edge = np.searchsorted(near[self.order], np.arange(cells + 1))

    def _nearest(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([(x[a : a + 4096] @ self.centres.T).argmax(1) for a in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)

    def search(self, x: np.ndarray, probes: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, item passage) pairs with a cosine of at least `least` in the probed cells."""
        close = x @ self.centres.T
        k = min(probes, close.shape[1])
        probe = np.argpartition(-close, k - 1, axis=1)[:, :k]
        q, cell = np.repeat(np.arange(len(x)), k), probe.ravel()
        o = np.argsort(cell, kind="stable")
        q, cell = q[o], cell[o]
        edge = np.searchsorted(cell, np.arange(len(self.edge)))
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for c in range(len(self.edge) - 1):
            own = q[edge[c] : edge[c + 1]]
            a, b = self.edge[c], self.edge[c + 1]
            if len(own) and b > a:
                i, j = np.nonzero(x[own] @ self.latent[a:b].T >= least)
                out.append((own[i], self.order[a + j]))
        return np.concatenate([p[0] for p in out]), np.concatenate([p[1] for p in out])


def common_path(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(n, 2): places of a longest common subsequence of two texts of word numbers; GAP equals nothing."""
    n, m = len(a), len(b)
    best = np.zeros((n + 1, m + 1), np.int32)
    same = (a[:, None] == b[None, :]) & (a[:, None] != GAP)
    for i in range(n):
        best[i + 1, 1:] = np.maximum.accumulate(np.maximum(best[i, 1:], best[i, :-1] + same[i]))
    out, i, j = [], n, m
    while i and j:
        if same[i - 1, j - 1] and best[i, j] == best[i - 1, j - 1] + 1:
            i, j = i - 1, j - 1
            out.append((i, j))
        elif best[i - 1, j] >= best[i, j - 1]:
            i -= 1
        else:
            j -= 1
    return np.array(out[::-1], dtype=np.int64).reshape(-1, 2)


def longest_leak(path: np.ndarray, edits: float) -> tuple[int, int]:
    """(words, edits) of the longest stretch of the first text along a path with at most `edits` per word."""
    if not len(path):
        return (0, 0)
    bad = np.concatenate([[0], np.cumsum((np.diff(path, axis=0) - 1).max(1))]) if len(path) > 1 else np.zeros(1, np.int64)
    # a stretch from i to j fits if over[j] <= over[i] + edits; from the least of all later ones follows the last j of each i
    over = bad - edits * path[:, 0]
    later = np.minimum.accumulate(over[::-1])[::-1]
    last = np.searchsorted(later, over + edits + 1e-9, side="right") - 1
    span = path[last, 0] - path[:, 0] + 1
    at = int(span.argmax())
    return (int(span[at]), int(bad[last[at]] - bad[at]))


def local_leak(a: np.ndarray, b: np.ndarray, least: int, edits: float) -> tuple[int, int]:
    """(words, edits) of a stretch of `a` of at least `least` words that stands in `b` with at most `edits` per word, by edit distance; (0, 0) if there is none.

    A stretch begins and ends with equal words. One of 2 * least / (1 - edits) words or more falls into two of at least `least`, of which one has no
    more edits per word; so stretches up to that length settle whether there is any, and no more edits than that length allows are followed.
    """
    longest = int(np.ceil(2 * least / (1 - edits)))
    most = int(edits * longest)
    off, none, best = np.arange(-most, most + 1), 4 * longest, (0, 0)
    begins = np.argwhere((a[:, None] == b[None, :]) & (a[:, None] != GAP))
    for at in range(0, len(begins), 32768):
        i, j = begins[at : at + 32768].T
        # least edits between a[i : i + k + 1] and b[j : j + k + 1 + off]
        cost = np.repeat(np.where(off >= 0, off, none)[None, :], len(i), axis=0)
        for k in range(1, longest):
            live = (i + k < len(a)) & (cost.min(1) <= most)
            i, j, cost = i[live], j[live], cost[live]
            if not len(i):
                break
            to = j[:, None] + k + off
            there = (to >= j[:, None]) & (to < len(b))
            word = a[i + k][:, None]
            same = there & (word != GAP) & (b[np.clip(to, 0, len(b) - 1)] == word)
            if k + 1 >= least:
                low = int(np.where(same, cost, none).min())
                if low <= edits * (k + 1):
                    best = max(best, (k + 1, -low))
            dropped = np.concatenate([cost[:, 1:], np.full((len(i), 1), none)], axis=1) + 1
            cost = np.where(there, np.minimum(cost + ~same, dropped), none)
            cost = np.where(there, np.minimum.accumulate(cost - off, axis=1) + off, none)
    return (best[0], -best[1])


def holds(text: np.ndarray, answer: np.ndarray) -> bool:
    """Whether all words of an answer stand in a text one after the other; an empty answer stands nowhere."""
    if not len(answer) or len(answer) > len(text):
        return False
    at = np.flatnonzero(text[: len(text) - len(answer) + 1] == answer[0])
    return any(np.array_equal(text[k : k + len(answer)], answer) for k in at)


def latent_space(coded: DataFrame, features: Features, idf: np.ndarray, other: float, p: Params) -> np.ndarray:
    """Right singular vectors of the TF-IDF matrix of the corpus passages that can be candidates, by a randomised range finder.

    Each pass adds up A'(A Q) over all of them; A is never formed. A task yields the rows of its part that it touched, and
    only their sum comes to the driver: at most BUCKETS x (rank + oversample) numbers.
    """
    rng = np.random.default_rng(p.seed)
    width = min(p.rank + p.oversample, features.size)
    q = np.linalg.qr(rng.standard_normal((features.size, width)).astype(np.float32))[0]
    given = coded.sparkSession.sparkContext.broadcast((features, idf, other))

    def packed(at: np.ndarray, part: np.ndarray) -> pd.DataFrame:
        block = at // ROWS
        edge = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True]) if len(at) else np.zeros(1, int)
        cut = list(zip(edge, edge[1:]))
        return pd.DataFrame({"block": [int(block[a]) for a, _ in cut], "at": [at[a:b].astype(np.int32).tobytes() for a, b in cut], "part": [part[a:b].astype(np.float32).tobytes() for a, b in cut]})

    def gram(basis: np.ndarray) -> np.ndarray:
        shared = coded.sparkSession.sparkContext.broadcast(basis)

        def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            (features, idf, other), b = given.value, shared.value
            total, touched = np.zeros((features.size, width), np.float32), np.zeros(features.size, bool)
            for pdf in batches:
                t, begin, end = joined(_arrays(pdf))
                at = passages_of(begin, end, p.window, p.window)
                ps = Passages(features.of(t), at[:, 1], at[:, 2], idf, other)
                keep = np.flatnonzero(ps.known_share >= p.known)
                for a in range(0, len(keep), 2048):
                    k = keep[a : a + 2048]
                    z = ps.project(k, b)
                    r, f, w = ps.entries(k)
                    o = np.argsort(f, kind="stable")
                    r, f, w = r[o], f[o], w[o]
                    edge = np.flatnonzero(np.r_[True, f[1:] != f[:-1]]) if len(f) else np.zeros(0, int)
                    if len(f):
                        total[f[edge]] += np.add.reduceat(z[r] * w[:, None], edge, axis=0)
                        touched[f[edge]] = True
            at = np.flatnonzero(touched)
            yield packed(at, total[at])

        def add(pdf: pd.DataFrame) -> pd.DataFrame:
            whole, used = np.zeros((ROWS, width)), np.zeros(ROWS, bool)
            for at, x in zip(pdf["at"], pdf["part"]):
                row = np.frombuffer(at, np.int32) % ROWS
                whole[row] += np.frombuffer(x, np.float32).reshape(-1, width)
                used[row] = True
            at = np.flatnonzero(used)
            return packed(at + int(pdf["block"].iloc[0]) * ROWS, whole[at])

        schema = "block int, at binary, part binary"
        # two levels of sums, so no task adds the parts of all others
        parts = coded.select("words").mapInPandas(part, schema).withColumn("lane", F.pmod(F.spark_partition_id(), F.lit(16)))
        middle = parts.groupBy("block", "lane").applyInPandas(add, schema)
        out = np.zeros((features.size, width))
        for r in middle.groupBy("block").applyInPandas(add, schema).toLocalIterator():
            out[np.frombuffer(r["at"], np.int32)] = np.frombuffer(r["part"], np.float32).reshape(-1, width)
        shared.unpersist()
        return out

    for _ in range(p.iterations):
        q = np.linalg.qr(gram(q))[0].astype(np.float32)
    y = gram(q)
    small = q.T.astype(np.float64) @ y
    vals, vecs = np.linalg.eigh((small + small.T) / 2)
    top = np.argsort(vals)[::-1][: p.rank]
    return (q @ vecs[:, top]).astype(np.float32)


@dataclass
class Block:
    """Items that are searched for together."""

    ids: list
    texts: list[np.ndarray]
    answers: list[np.ndarray]
    item_of: np.ndarray  # by passage
    index: Index
    triples: list[np.ndarray]  # codes of the three words that begin at each place of a text
    sorted_triples: np.ndarray  # of all items, with the item of each
    triple_item: np.ndarray
    first_words: np.ndarray  # of the answers; GAP where there is none

    def shared_triples(self, there: np.ndarray) -> np.ndarray:
        """By item, at how many of its places a triple of the given (distinct) ones begins."""
        lo, hi = np.searchsorted(self.sorted_triples, there), np.searchsorted(self.sorted_triples, there, side="right")
        n = (hi - lo)[hi > lo]
        at = np.repeat(lo[hi > lo] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.bincount(self.triple_item[at], minlength=len(self.texts))


def _blocks(items: list[tuple], features: Features, idf: np.ndarray, other: float, basis: np.ndarray, p: Params) -> Iterator[Block]:
    some, size = [], 0
    for i, item in enumerate(items):
        some.append(item)
        size += len(item[1])
        if size >= BLOCK_WORDS or i == len(items) - 1:
            ids, texts, answers = map(list, zip(*some))
            t, begin, end = joined(texts)
            at = passages_of(begin, end, p.window, p.item_stride)
            latent = _cosines(Passages(features.of(t), at[:, 1], at[:, 2], idf, other).project(np.arange(len(at)), basis))
            triples = [runs_of(x, 3) for x in texts]
            flat, whose = np.concatenate(triples), np.repeat(np.arange(len(texts)), [len(x) for x in triples])
            o = np.argsort(flat, kind="stable")
            yield Block(ids, texts, answers, at[:, 0], Index(latent, p.seed), triples, flat[o], whose[o], np.array([x[0] if len(x) else GAP for x in answers], np.int32))
            some, size = [], 0


def _stretches(p: Params) -> tuple[np.ndarray, np.ndarray]:
    """(words, least triples in common) of the stretches that settle whether there is a leak, see may_leak."""
    n = np.arange(p.least_words, int(np.ceil(2 * p.least_words / (1 - p.edits))) + 1)
    return n, n - 2 - 3 * (n * p.edits).astype(int)


def may_leak(triples: np.ndarray, there: np.ndarray, p: Params) -> bool:
    """Whether a text with the (sorted, distinct) triples of words `there` can hold a passage of the item with the given triples.

    An edit breaks at most three triples of the item's words, so of a stretch of n words with e edits at least n - 2 - 3e triples
    stand in the text. Stretches of twice the least length or more fall into two (see local_leak), so shorter ones settle it.
    """
    if len(triples) < p.least_words - 2 or not len(there):
        return False
    at = np.minimum(np.searchsorted(there, triples), len(there) - 1)
    hits = np.concatenate([[0], np.cumsum(there[at] == triples)])
    n, least = _stretches(p)
    end = np.arange(len(triples))[:, None] + n - 2
    count = np.where(end < len(hits), hits[np.minimum(end, len(hits) - 1)] - hits[:-1, None], -1)
    return bool((count >= least).any())


def settle(text: np.ndarray, starts: np.ndarray, body: np.ndarray, p: Params) -> tuple[int, int, int]:
    """(words, edits, common words) of the best leak of an item near the given places of a text, however long the text is."""
    lo, hi = max(0, int(starts.min()) - 2 * len(body)), min(len(text), int(starts.max()) + 2 * len(body) + p.window)
    best, common = (0, 0), 0
    for s in range(lo, hi, 4096):  # a text with leaks far apart is compared piece by piece
        piece = text[s : min(hi, s + 4096 + 2 * len(body))]
        path = common_path(body, piece)
        best, common = max(best, longest_leak(path, p.edits)), max(common, len(path))
        # one path through the whole item may tear a leak apart; no leak has fewer words in common
        if best[0] < p.least_words and len(path) >= p.least_words * (1 - p.edits):
            best = max(best, local_leak(body, piece, p.least_words, p.edits))
    return (*best, common)


def candidates(t: np.ndarray, at: np.ndarray, features: Features, idf: np.ndarray, other: float, basis: np.ndarray, block: Block, p: Params) -> np.ndarray:
    """(n, 3): text, item, place of every passage that is close to a passage of an item in the latent space."""
    ps = Passages(features.of(t), at[:, 1], at[:, 2], idf, other)
    keep, found = np.flatnonzero(ps.known_share >= p.known), []
    for a in range(0, len(keep), 4096):
        k = keep[a : a + 4096]
        x, y = block.index.search(_cosines(ps.project(k, basis)), p.probes, p.cosine)
        found.append(np.unique(np.stack([at[k[x], 0], block.item_of[y], at[k[x], 1]], axis=1), axis=0))
    return np.concatenate(found) if found else np.zeros((0, 3), np.int64)


def leaked_items(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, answer: str, p: Params = Params()) -> DataFrame:  # noqa: B008
    """(doc_id, item_id, span_words, span_edits, common_share, has_answer, kind) of every document that leaks an item.

    kind is passage (at least `least_words` consecutive words of the item with at most `edits` of them replaced,
    added or dropped) or paraphrase (the item's answer stands in the document, all its words one after the other, together with a
    common subsequence of at least `paraphrase` of the item's words). Null and empty texts leak nothing; very long texts are searched
    whole. Documents repeated under one id give repeated rows. Items are the stated query set: their words are held by the driver and
    sent to the tasks in blocks of about BLOCK_WORDS; the corpus stays where it is.

    1. Texts become 32-bit codes of all their words, written once. 2. Document frequencies of the items' words and word pairs, hashed to
    BUCKETS, over all documents. 3. One latent space for all items (see latent_space). 4. Every passage with enough known weight
    is compared in that space with the item passages of its nearest cells (see Index). 5. Candidates with as many triples
    of the item's words as every passage leak has (see may_leak), or with its answer and as many of its words as a paraphrase has, are settled by the longest common subsequence, and where that finds no
    passage, by a local alignment.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type, item_type = dict(source.dtypes)["doc_id"], dict(items.dtypes)[item_id]
    schema = f"doc_id {id_type}, item_id {item_type}, span_words int, span_edits int, common_share double, has_answer boolean, kind string"
    memo: dict[str, int] = {}
    held = []
    for r in items.select(item_id, item_text, answer).where(F.col(item_id).isNotNull()).distinct().orderBy(item_id, item_text, answer).toLocalIterator():
        if len(code := encode(r[1], memo)):
            held.append((r[0], code, encode(r[2], memo)))
    if not held:
        return spark.createDataFrame([], schema)

    def coding(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict[str, int] = {}
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "words": [encode(t, memo).tobytes() for t in pdf["text"]]})

    coded = scratch.write(spread(source).where("text is not null").mapInPandas(coding, f"doc_id {id_type}, words binary"))
    features = Features([x[1] for x in held])
    given = spark.sparkContext.broadcast(features)

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features, n, df = given.value, 0, np.zeros(given.value.size, np.int64)
        for pdf in batches:
            t, begin, end = joined(_arrays(pdf))
            f = features.of(t)
            doc = np.repeat(np.arange(len(begin)), end - begin + 1)
            pair = np.unique((doc[None, :] * features.size + f)[f >= 0])
            df += np.bincount(pair % features.size, minlength=features.size)
            n += len(pdf)
        at = np.flatnonzero(df)
        yield pd.DataFrame({"f": np.r_[-1, at], "n": np.r_[n, df[at]]})

    df, n_docs = np.zeros(features.size), 1
    for r in coded.select("words").mapInPandas(frequencies, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).toLocalIterator():
        if r["f"] < 0:
            n_docs = max(1, r["n"])
        else:
            df[r["f"]] = r["n"]
    idf = np.log1p(n_docs / (1.0 + df)).astype(np.float32)
    other = float(idf.mean())
    basis = latent_space(coded, features, idf, other, p)
    shared = spark.sparkContext.broadcast((features, idf, other, basis))

    def finder(one):
        def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            (features, idf, other, basis), block = shared.value, one.value
            for pdf in batches:
                arrays = _arrays(pdf)
                t, begin, end = joined(arrays)
                near = candidates(t, passages_of(begin, end, p.window, p.stride), features, idf, other, basis, block, p)
                near = near[np.lexsort((near[:, 2], near[:, 1], near[:, 0]))]
                edge = np.flatnonzero(np.r_[True, (near[1:, :2] != near[:-1, :2]).any(1)]) if len(near) else np.zeros(0, int)
                res, doc = [], -1
                for a, b in zip(edge, np.r_[edge[1:], len(near)]):
                    d, i = int(near[a, 0]), int(near[a, 1])
                    if d != doc:
                        doc, known, triples = d, np.unique(arrays[d]), np.unique(runs_of(arrays[d], 3))
                        in_common, answered = block.shared_triples(triples), np.isin(block.first_words, known)
                    if in_common[i] < least and not answered[i]:
                        continue
                    body, has = block.texts[i], holds(arrays[d], block.answers[i])
                    if not may_leak(block.triples[i], triples, p) and not (has and np.isin(body, known).sum() >= p.paraphrase * len(body)):
                        continue
                    span, bad, common = settle(arrays[d], near[a:b, 2] - begin[d], body, p)
                    share = common / len(body)
                    kind = "passage" if span >= p.least_words else "paraphrase" if has and share >= p.paraphrase else None
                    if kind:
                        res.append((pdf["doc_id"].iloc[d], block.ids[i], span, bad, share, has, kind))
                yield pd.DataFrame(res, columns=["doc_id", "item_id", "span_words", "span_edits", "common_share", "has_answer", "kind"])

        return search

    least, out = int(_stretches(p)[1].min()), None
    for block in _blocks(held, features, idf, other, basis, p):
        found = coded.mapInPandas(finder(spark.sparkContext.broadcast(block)), schema)
        out = found if out is None else out.unionByName(found)
    return out
