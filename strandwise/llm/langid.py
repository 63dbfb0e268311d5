"""Languages of documents and of their segments from averaged subword embeddings with a linear softmax."""

from __future__ import annotations

import re
import sys
import unicodedata
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.llm.sample import labelled_sample
from strandwise.session import spread

# Languages with their two- and three-letter codes and English name.
LANGUAGES = {
    "en": ["en", "eng", "english"], "de": ["de", "deu", "ger", "german"], "fr": ["fr", "fra", "fre", "french"], "es": ["es", "spa", "spanish"],
    "it": ["it", "ita", "italian"], "pt": ["pt", "por", "portuguese"], "nl": ["nl", "nld", "dut", "dutch"],
}
#: A segment that the model rejects.
NONE = "und"
#: Words of texts that are segmented together; a longer text is segmented alone.
CELLS = 400_000
#: Words that a worker remembers; then it starts anew.
MEMO = 500_000


def named_language(label: Column, languages: dict[str, list[str]] = LANGUAGES) -> Column:
    """The code that a label names by one of its language's names, in any case, with or without a region; else null."""
    base = F.lower(F.regexp_extract(label, r"^\s*([A-Za-z]+)\s*(?:[-_][A-Za-z0-9]+)*\s*$", 1))
    out = F.lit(None).cast("string")
    for code, names in languages.items():
        out = F.when(base.isin(names), F.lit(code)).otherwise(out)
    return out


@dataclass(frozen=True)
class Params:
    buckets: int = 1 << 16  # of the subword hash
    dims: int = 16
    per_language: int = 3000  # documents of each label that train and calibrate; the bound of the sample
    common: int = 6  # sentences of the sample that a word must stand in to teach; names would be learned by heart
    alike: int = 50  # sentences of a label that begin with the same two words; more teach nothing new
    dropout: float = 0.4  # share of words left out of a sentence in each epoch, so that no single word carries it
    rounds: int = 2  # of training; after the first, sentences that the model contradicts are dropped
    epochs: int = 8
    rate: float = 1.0
    batch: int = 128
    stay: float = 12.0  # cost of a change of language inside a sentence, in units of word scores times `grip`
    turn: float = 4.0  # cost of one between sentences or lines
    grip: float = 0.25  # weight of a word's score against those costs
    clip: float = 12.0  # most that one word can score for or against a language
    accepted: float = 0.995  # share of held-out sentences whose best score calibration takes as the floor
    margin: float = 0.3  # share of that floor that the state without language scores per word; segments may be worse than whole sentences
    seed: int = 11


_MARKUP = re.compile(r"<[^<>]{1,200}>|\[\d{1,4}\]|\*\*")
_TOKEN = re.compile(r"\S+")
_LETTERS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_END = re.compile(r"[.!?][)\"'»”]*$")


def tokens(text: str) -> tuple[list[str], list[bool]]:
    """Words of a text (lower case; what holds no letter or digit is no word), and whether a sentence or line begins at each."""
    out, first, new = [], [], True
    for line in _MARKUP.sub(" ", text).split("\n"):
        new = True
        for t in _TOKEN.findall(line):
            m = _LETTERS.search(t)
            if m or any(ch.isdigit() for ch in t):
                out.append(sys.intern(m[0].lower()) if m and not any(ch.isdigit() for ch in t) else "")
                first.append(new)
                new = False
            if _END.search(t):
                new = True
    return out, first


def without_accents(w: str) -> str:
    return w if w.isascii() else sys.intern("".join(c for c in unicodedata.normalize("NFKD", w) if not unicodedata.combining(c)))


def subwords(word: str, buckets: int) -> list[int]:
    """Hashed word, and character sequences of two to four with word ends; nothing for numbers and codes."""
    if not word:
        return []
    w = f"<{word}>"
    grams = {w, *(w[i : i + n] for n in (2, 3, 4) for i in range(len(w) - n + 1))}
    return sorted(zlib.crc32(g.encode()) % buckets for g in grams)


@dataclass
class Model:
    """Embeddings (buckets x dims), weights (dims x languages), offsets, temperature and the least score per word of a language."""

    p: Params
    codes: list[str]
    emb: np.ndarray
    weight: np.ndarray
    offset: np.ndarray
    temperature: float = 1.0
    least: float = 0.0

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Scores of each word; a sentence's score is their mean. A word that holds no letters scores nothing."""
        out = np.zeros((len(words), len(self.codes)), np.float32)
        grams = [subwords(w, self.p.buckets) for w in words]
        lens = np.array([len(g) for g in grams], dtype=np.int64)
        full = np.flatnonzero(lens)
        if len(full):
            flat = np.array([x for g in grams for x in g])
            edge = np.cumsum(lens[full]) - lens[full]
            out[full] = np.add.reduceat(self.emb[flat], edge, axis=0) / lens[full, None] @ self.weight
        return out

    def centred(self, raw: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """Scores around their mean over the languages; words without letters stand for no language."""
        s = raw + self.offset
        s = np.clip(s - s.mean(1, keepdims=True), -self.p.clip, self.p.clip)
        return np.where(letters[:, None], s, 0.0)


class Reader:
    """Texts as numbers of words, with the scores of every number; each word is scored once per worker.

    Number 0 is any word without letters, number 1 stands behind the end of a text.
    """

    def __init__(self, model: Model):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.seen: dict[str, int] = {}  # sign sequence: (number + 1) * 2 + whether a sentence ends with it
        self.number: dict[str, int] = {"": 0}
        self.raw = np.zeros((2, len(self.model.codes)), np.float32)
        self.emit = self._emit(self.raw, np.zeros(2, bool))
        self.emit[1] = 0.0

    def _emit(self, raw: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """What a word adds to each language and, last, to none."""
        m = self.model
        return (m.p.grip * np.c_[m.centred(raw, letters), np.full(len(raw), m.least)]).astype(np.float32)

    def _learn(self, token: str, fresh: list[str]) -> int:
        m = _LETTERS.search(token)
        digit = any(ch.isdigit() for ch in token)
        code = int(bool(_END.search(token)))
        if m or digit:
            w = m[0].lower() if m and not digit else ""
            if w not in self.number:
                self.number[w] = len(self.number) + 1
                fresh.append(w)
            code += 2 * (self.number[w] + 1)
        self.seen[token] = code
        return code

    def read(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each text the numbers of its words, and whether a sentence or line begins at each."""
        if len(self.seen) > MEMO:
            self._clear()
        fresh: list[str] = []
        out = []
        for text in texts:
            ids, first, get = [], [], self.seen.get
            for line in (_MARKUP.sub(" ", text) if "<" in text or "[" in text or "**" in text else text).split("\n"):
                new = True
                for t in line.split():
                    code = get(t)
                    if code is None:
                        code = self._learn(t, fresh)
                    if code > 1:
                        ids.append(code)
                        first.append(new)
                        new = False
                    if code & 1:
                        new = True
            out.append(((np.array(ids, dtype=np.int64) >> 1) - 1, np.array(first, dtype=bool)))
        if fresh:
            raw = self.model.word_scores(fresh)
            self.raw = np.concatenate([self.raw, raw])
            self.emit = np.concatenate([self.emit, self._emit(raw, np.ones(len(raw), bool))])
        return out


def _bags(sentences: list[list[str]], p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The frequent words of all sentences as numbers, the start of each sentence, and the subwords of each number with their starts."""
    often = Counter(x for s in sentences for x in set(s))
    number: dict[str, int] = {}
    tok, start = array("i"), [0]
    for s in sentences:
        tok.extend(number.setdefault(x, len(number)) for x in s if x and often[x] >= p.common)
        start.append(len(tok))
    subs = [subwords(x, p.buckets) for x in number]
    return np.array(tok, dtype=np.int32), np.array(start), np.array([i for x in subs for i in x], dtype=np.int64), np.cumsum([0, *map(len, subs)])


def _spans(first: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The places first[i], first[i] + 1, ... of each span, one after the other."""
    return np.repeat(first - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())


def _train(sentences: list[list[str]], labels: np.ndarray, p: Params, codes: list[str]) -> Model:
    """Softmax regression on averaged embeddings by stochastic gradient descent over shuffled batches."""
    rng = np.random.default_rng(p.seed)
    tok, start, sub, sub_start = _bags(sentences, p)
    emb = np.zeros((p.buckets, p.dims), np.float32)  # subwords that never taught say nothing
    weight, offset = np.zeros((p.dims, len(codes)), np.float32), np.zeros(len(codes), np.float32)
    weight += rng.standard_normal(weight.shape).astype(np.float32) * 0.3
    share = np.bincount(labels, minlength=len(codes)).astype(np.float32)
    balance = (share.sum() / np.maximum(share, 1) / len(codes)).clip(0, 5)[labels]
    steps, total = 0, max(1, p.epochs * (len(labels) // p.batch + 1))
    for _ in range(p.epochs):
        order = rng.permutation(len(labels))
        for a in range(0, len(order), p.batch):
            rate = p.rate * (1 - steps / total)
            kept = rng.random(max(1, len(tok))) >= p.dropout if a == 0 else kept
            steps += 1
            b = order[a : a + p.batch]
            own = start[b + 1] - start[b]
            place, row = _spans(start[b], own), np.repeat(np.arange(len(b)), own)
            left = kept[place]
            word, row = tok[place[left]], row[left]
            n = sub_start[word + 1] - sub_start[word]
            f, row, g = sub[_spans(sub_start[word], n)], np.repeat(row, n), np.repeat(1.0 / (n * own[row] * (1 - p.dropout)), n).astype(np.float32)
            lens = np.bincount(row, minlength=len(b))
            vec = np.zeros((len(b), p.dims), np.float32)
            full = np.flatnonzero(lens > 0)
            if not len(full):
                continue
            edge = np.concatenate([[0], np.cumsum(lens[full])[:-1]])
            vec[full] = np.add.reduceat(emb[f] * g[:, None], edge, axis=0)
            z = vec @ weight + offset
            z = np.exp(z - z.max(1, keepdims=True))
            err = z / z.sum(1, keepdims=True)
            err[np.arange(len(b)), labels[b]] -= 1
            err *= balance[b, None] / len(b)
            back = err @ weight.T
            weight -= rate * 10 * (vec.T @ err)
            offset -= rate * err.sum(0)
            o = np.argsort(f, kind="stable")
            e2 = np.flatnonzero(np.r_[True, f[o][1:] != f[o][:-1]])
            emb[f[o][e2]] -= rate * 200 * np.add.reduceat(back[row[o]] * g[o][:, None], e2, axis=0)
    return Model(p, codes, emb, weight, offset)


def _sentences(text: str) -> list[list[str]]:
    ws, first = tokens(text)
    cut = [i for i, x in enumerate(first) if x] + [len(ws)]
    return [ws[a:b] for a, b in zip(cut, cut[1:]) if sum(bool(x) for x in ws[a:b]) >= 4]


def _scores(m: Model, sentences: list[list[str]]) -> np.ndarray:
    """Mean word scores of sentences, each of which has words."""
    number: dict[str, int] = {}
    for s in sentences:
        for x in s:
            number.setdefault(x, len(number))
    scores, out = m.word_scores(list(number)), [np.zeros((0, len(m.codes)))]
    for a in range(0, len(sentences), 20_000):
        some = sentences[a : a + 20_000]
        lens = np.array([sum(bool(x) for x in s) for s in some])
        rows = scores[np.fromiter((number[x] for s in some for x in s if x), np.int64)]
        out.append(np.add.reduceat(rows, np.cumsum(lens) - lens, axis=0) / lens[:, None] + m.offset)
    return np.concatenate(out)


def _by_word_rates(sentences: list[list[str]], y: np.ndarray, p: Params, n: int) -> np.ndarray:
    """The label under which the words of each sentence are most at home, by their rates in the sentences of each label.

    Passages that stand in documents of every language have words without a home, so their function words decide.
    """
    size = np.bincount(y, minlength=n) + 1.0
    counts: dict[str, np.ndarray] = {}
    for s, c in zip(sentences, y):
        for w in set(s) - {""}:
            if w not in counts:
                counts[w] = np.zeros(n)
            counts[w][c] += 1
    rate = {w: np.log((c + 0.1) / size) for w, c in counts.items() if c.sum() >= p.common}
    rate = {w: r - r.mean() for w, r in rate.items()}
    none = np.zeros(n)
    return np.array([sum((rate.get(w, none) for w in set(s)), none).argmax() for s in sentences])


def train(docs: DataFrame, doc_id: str, text: str, label: str, p: Params = Params(), languages: dict[str, list[str]] = LANGUAGES) -> Model:  # noqa: B008
    """Fits the model on a bounded sample of labelled documents: of each language the `per_language` with the lowest id hash.

    Labels may be wrong and documents mixed: sentences whose words are more at home under another label are left out
    first, later also those that the model contradicts, and common beginnings are thinned to `alike`.
    A tenth of the sentences calibrates: the temperature minimises their log loss, and the least score per word is
    `margin` times the score that the share `accepted` of those it gets right exceeds. Half of the training sentences also come without accents.
    """
    codes, sentences, labels = list(languages), [], []
    for code, body in labelled_sample(docs, doc_id, text, named_language(F.col(label), languages), p.per_language):
        own = _sentences(body)
        sentences += own
        labels += [codes.index(code)] * len(own)
    y = np.array(labels, dtype=np.int64)
    if not len(y):
        return Model(p, codes, np.zeros((p.buckets, p.dims), np.float32), np.zeros((p.dims, len(codes)), np.float32), np.zeros(len(codes), np.float32), least=1.0)
    held = np.random.default_rng(p.seed).random(len(y)) < 0.1
    right = _by_word_rates(sentences, y, p, len(codes)) == y
    for _ in range(p.rounds):
        use, begun = np.zeros(len(y), bool), Counter()
        for i in np.flatnonzero(right & ~held):
            begin = (y[i], *sentences[i][:2])
            begun[begin] += 1
            use[i] = begun[begin] <= p.alike
        at = np.flatnonzero(use)
        bare = at[::2]
        m = _train([sentences[i] for i in at] + [[without_accents(x) for x in sentences[i]] for i in bare], np.concatenate([y[at], y[bare]]), p, codes)
        scores = _scores(m, sentences)
        right &= scores.argmax(1) == y
    z, t = scores[held & right], y[held & right]
    if len(t):
        def loss(temp: float) -> float:
            s = z / temp
            return float((np.log(np.exp(s - s.max(1, keepdims=True)).sum(1)) + s.max(1) - s[np.arange(len(t)), t]).mean())

        m.temperature = min((0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0), key=loss)
        top = []
        for i in np.flatnonzero(held & right):
            letters = np.array([bool(x) for x in sentences[i]])
            top.append(m.centred(m.word_scores(sentences[i]), letters).mean(0).max())
        m.least = p.margin * float(np.quantile(top, 1 - p.accepted))
    return m


def segment(texts: list[str], m: Model, reader: Reader | None = None) -> list[list[tuple[int, int, int, str, float]]]:
    """Of each text its segments (first word, end, words, code, confidence), whole texts, however long.

    The best path through the words of each text, all texts of a batch at once: a word gives its centred scores times
    `grip`, a change of language costs `turn` at the begin of a sentence or line and `stay` elsewhere. A state without
    language gives the calibrated least score, so it takes what no language claims (tables, sequences).
    """
    p, reader = m.p, reader or Reader(m)
    read = reader.read(texts)
    lens = np.array([len(ids) for ids, _ in read], dtype=np.int64)
    n_states = len(m.codes) + 1
    same = np.arange(n_states, dtype=np.int8)
    out: list[list] = [[] for _ in texts]
    groups: list[list[int]] = []
    for i in np.argsort(lens, kind="stable"):  # texts of like length together, at most CELLS places at a time
        if lens[i] and groups and (len(groups[-1]) + 1) * lens[i] <= CELLS:
            groups[-1].append(i)
        elif lens[i]:
            groups.append([i])
    for rows in groups:
        longest, each = int(lens[rows[-1]]), np.arange(len(rows))
        ids = np.ones((longest, len(rows)), np.int64)
        first = np.zeros((longest, len(rows)), bool)
        for k, i in enumerate(rows):
            ids[: lens[i], k], first[: lens[i], k] = read[i]
        cost = np.where(first, np.float32(p.turn), np.float32(p.stay))
        best = reader.emit[ids[0]]
        back = np.zeros((longest, len(rows), n_states), np.int8)
        for t in range(1, longest):
            top = best.argmax(1)
            jump = (best[each, top] - cost[t])[:, None]
            back[t] = np.where(best >= jump, same, top[:, None].astype(np.int8))
            best = np.maximum(best, jump) + reader.emit[ids[t]]
        path = np.empty((longest, len(rows)), np.int8)
        path[-1] = best.argmax(1)  # what stands behind the end of a text adds nothing that tells states apart
        for t in range(longest - 1, 0, -1):
            path[t - 1] = back[t, each, path[t]]
        path = path.T
        for k, i in enumerate(rows):
            own, words = path[k, : lens[i]], read[i][0]
            edge = np.flatnonzero(np.r_[True, own[1:] != own[:-1], True])
            for s, e in zip(edge, edge[1:]):
                code, conf = NONE, 0.0
                here = words[s:e]
                here = here[here > 0]
                if own[s] < len(m.codes) and len(here):
                    sc = (reader.raw[here].mean(0) + m.offset) / m.temperature
                    probs = np.exp(sc - sc.max())
                    conf = float(probs[own[s]] / probs.sum())
                    code = m.codes[own[s]]
                out[i].append((int(s), int(e), int(e - s), code, conf))
    return out


def language_segments(docs: DataFrame, doc_id: str, text: str, model: Model) -> DataFrame:
    """(doc_id, segment_no, first_word, n_words, lang_code, confidence) of every segment of every document.

    Texts without words, empty and null ones have one segment und with 0 words. Repeated documents repeat.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(shared.value)
        for pdf in batches:
            found = segment([t or "" for t in pdf["text"]], shared.value, reader)
            rows = [(i, k, *(s[0], s[2], s[3], s[4])) for i, ss in enumerate(found) for k, s in enumerate(ss or [(0, 0, 0, NONE, 0.0)], 1)]
            out = pd.DataFrame(rows, columns=["i", "segment_no", "first_word", "n_words", "lang_code", "confidence"])
            out.insert(0, "doc_id", pdf["doc_id"].to_numpy()[out["i"].to_numpy(dtype=int)])
            yield out.drop(columns="i")

    kind = dict(docs.dtypes)[doc_id]
    return spread(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))).mapInPandas(run, f"doc_id {kind}, segment_no int, first_word int, n_words int, lang_code string, confidence double")


def document_languages(segments: DataFrame) -> DataFrame:
    """(doc_id, lang_code, confidence, share, mixed) per document: the language of most words; ties by code."""
    per = segments.groupBy("doc_id", "lang_code").agg(F.sum("n_words").alias("n"), (F.sum(F.col("confidence") * F.col("n_words")) / F.greatest(F.sum("n_words"), F.lit(1))).alias("confidence"))
    best = F.max(F.struct((F.col("lang_code") != NONE).alias("real"), "n", F.col("lang_code"), "confidence"))
    out = per.groupBy("doc_id").agg(best.alias("b"), F.sum("n").alias("all"), F.sum((F.col("lang_code") != NONE).cast("int")).alias("kinds"))
    return out.select("doc_id", F.col("b.lang_code").alias("lang_code"), F.round("b.confidence", 6).alias("confidence"), (F.col("b.n") / F.greatest("all", F.lit(1))).alias("share"), (F.col("kinds") > 1).alias("mixed"))
