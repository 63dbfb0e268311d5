"""Fields that hold several values, split by the dialect with the shortest description."""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.functions.text import no_text

#: A word that stands in at least this share of a class's fields (and in WORD_LEAST fields) is kept in shapes as it is.
WORD_SHARE, WORD_LEAST = 0.002, 5
#: Shapes that are rarer than this get the escape code; so a class has at most 1 / SHAPE_SHARE code words.
SHAPE_SHARE, SHAPE_LEAST = 2.0**-16, 2
#: Bits: of the escape code and each token or quote after it, of an empty piece, of each further piece.
ESCAPE, TOKEN, QUOTE, EMPTY, PIECE = 16.0, 2.0, 8.0, 3.0, 1.0
#: Characters without which a field can only be one value.
CANDIDATE = r"[;,|/\t\n\r \[\]{}\"]"


@dataclass(frozen=True)
class Dialect:
    """A delimiter (a literal, or a pattern if `mixed`), whether pieces may be quoted, and brackets around the list."""

    delimiter: str
    quoted: bool
    brackets: str
    mixed: bool
    bits: float


def dialects() -> list[Dialect]:
    """Every dialect with the length of its own description in bits."""
    out = []
    for quoted in (False, True):
        for d in [";", "; ", " ; ", "|", " | ", "||", ",", ", ", "/", " / ", "\t", "\n", " "]:
            out.append(Dialect(d, quoted, "", False, 6.0 + quoted))
        out.append(Dialect(r"[;,|]", quoted, "", True, 8.0 + quoted))
        out += [Dialect(",", quoted, b, False, 5.0 + quoted) for b in ("[]", "{}")]
    return out


DIALECTS = dialects()
_QUOTED = re.compile(r'\s*"((?:[^"\\]|""|\\.)*)"[^\S\n\t]*', re.DOTALL)
_ESCAPED = re.compile(r'""|\\(.)', re.DOTALL)


def parse(text: str, d: Dialect) -> list[str] | None:
    """The pieces of a text, trimmed, without quotes and escapes, empty ones kept; None if the dialect doesn't fit."""
    text = text.strip()
    if d.brackets:
        if len(text) < 2 or text[0] != d.brackets[0] or text[-1] != d.brackets[1]:
            return None
        text = text[1:-1]
    if d.quoted != ('"' in text):
        return None  # quoting is paid for where there is something to quote
    if not d.quoted:
        if d.mixed:
            return [p.strip() for p in re.split(d.delimiter, text)]
        return [p.strip() for p in text.split(d.delimiter)] if d.delimiter in text else None
    cut = re.compile(d.delimiter) if d.mixed else re.compile(re.escape(d.delimiter))
    pieces, i, n, any_quoted = [], 0, len(text), False
    while True:
        m = _QUOTED.match(text, i)
        if m:
            end = m.end()
            sep = cut.match(text, end)
            if not sep and not d.mixed:  # the blanks before a delimiter may belong to it
                end = len(text[: m.end()].rstrip(" "))
                sep = cut.match(text, end)
            if sep or not text[end:].strip():
                pieces.append(_ESCAPED.sub(lambda x: x[1] or '"', m[1]).strip())
                any_quoted = True
                if not sep:
                    break
                i = sep.end()
                continue
        sep = cut.search(text, i)
        pieces.append(text[i : sep.start() if sep else n].strip())
        if not sep:
            break
        i = sep.end()
    return pieces if any_quoted else None


_RUNS = re.compile(r"[0-9]+|[^\W\d_]+")
_TOKENS = re.compile(r"\w+|[^\w]")


def shape(text: str, words: frozenset[str]) -> str:
    """The text with digits and letters reduced to their kind, but for frequent words; all separators stay."""

    def kind(m: re.Match) -> str:
        run = m[0]
        if run[0].isdigit():
            return "9"
        if run in words:
            return run
        return "a" if run.islower() else "A" if run.isupper() else "T" if run[1:].islower() else "m"

    return _RUNS.sub(kind, text.strip())


class Codebook:
    """Code lengths of atomic shapes of one class."""

    def __init__(self, counts: dict[str, int]):
        """Keeps the shapes that are not shorter to describe as a list of other kept shapes, shortest first."""
        self.bits: dict[str, float] = {}
        everything, kept = sum(counts.values()) or 1, 0
        for s in sorted(counts, key=lambda s: (len(_TOKENS.findall(s)), -counts[s], s)):
            if s and not self._is_list(s):
                self.bits[s] = -math.log2(counts[s] / everything)
                kept += counts[s]
        share = math.log2(kept / everything) if kept else 0.0
        self.bits = {s: n + share for s, n in self.bits.items()}
        self.best: dict[str, Dialect | None] = {}

    def _is_list(self, s: str) -> bool:
        if self._shortest(s)[1]:
            return True
        for d in DIALECTS:
            filled = [p for p in parse(s, d) or [] if p]
            if len(filled) > 1 and all(p in self.bits for p in filled):
                return True
            if len(filled) == 1 and filled[0] != s and filled[0] in self.bits:
                return True  # one value with a stray separator or quotes around it
        return False

    def cost(self, s: str) -> float:
        b = self.bits.get(s)
        return ESCAPE + TOKEN * len(_TOKENS.findall(s)) + QUOTE * s.count('"') if b is None else b

    def _shortest(self, s: str) -> tuple[float, Dialect | None]:
        """The shortest description of a field of this shape and its dialect; None: it is one value."""
        least, best = self.cost(s), None
        for d in DIALECTS:
            pieces = parse(s, d)
            if not pieces or len(pieces) < 2 and not d.brackets:
                continue
            bits = d.bits + sum(PIECE + (self.cost(p) if p else EMPTY) for p in pieces)
            if d.mixed:
                bits += math.log2(3) * (len(pieces) - 1)
            if bits < least:
                least, best = bits, d
        return least, best

    def dialect(self, s: str) -> Dialect | None:
        """The dialect of a field of this shape; decided once."""
        if s not in self.best:
            if len(self.best) > 200_000:
                self.best.clear()
            self.best[s] = self._shortest(s)[1]
        return self.best[s]


def class_sizes(rows: DataFrame) -> DataFrame:
    """(class, size): fields of each class; the classes are few, so this is a small relation made of what reached the driver."""
    found = rows.groupBy("class").agg(F.count(F.lit(1)).alias("size")).collect()
    return rows.sparkSession.createDataFrame([(r["class"], r["size"]) for r in found], "class string, size long")


def frequent_words(rows: DataFrame, sizes: DataFrame) -> dict[str, frozenset[str]]:
    """By class, the lower-case words of three letters or more that stand in at least WORD_SHARE of its fields.

    At most (words per field / WORD_SHARE) per class reach the driver.
    """
    words = rows.select("class", F.explode(F.array_distinct(F.regexp_extract_all("value", F.lit(r"[a-z]{3,}"), F.lit(0)))).alias("word")).groupBy("class", "word").agg(F.count(F.lit(1)).alias("n"))
    often = words.where(F.col("n") >= WORD_LEAST).join(F.broadcast(sizes), "class").where(F.col("n") >= WORD_SHARE * F.col("size"))
    out = defaultdict(set)
    for r in often.select("class", "word").collect():
        out[r[0]].add(r[1])
    return {c: frozenset(w) for c, w in out.items()}


def shape_counts(rows: DataFrame, words: dict[str, frozenset[str]], sizes: DataFrame) -> DataFrame:
    """(class, shape, n): whole-field shapes with their counts; rare ones are left to the escape code.

    Each task counts its own shapes first. At most 1 / SHAPE_SHARE shapes of a class remain.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n: dict[tuple[str, str], int] = defaultdict(int)
        for pdf in batches:
            for c, v in zip(pdf["class"], pdf["value"]):
                n[c, shape(v, words.get(c, frozenset()))] += 1
            if len(n) > 100_000:
                yield pd.DataFrame([(*k, x) for k, x in n.items()], columns=["class", "shape", "n"])
                n.clear()
        yield pd.DataFrame([(*k, x) for k, x in n.items()], columns=["class", "shape", "n"])

    counts = rows.select("class", "value").mapInPandas(count, "class string, shape string, n long").groupBy("class", "shape").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= SHAPE_LEAST).join(F.broadcast(sizes), "class").where(F.col("n") >= SHAPE_SHARE * F.col("size")).select("class", "shape", "n")


def code_lengths(counts: DataFrame) -> dict[str, dict[str, float]]:
    """By class, the code words of its Codebook. The books of different classes are made in different tasks; a class has at most 1 / SHAPE_SHARE shapes."""

    def book(pdf: pd.DataFrame) -> pd.DataFrame:
        bits = Codebook(dict(zip(pdf["shape"], pdf["n"]))).bits
        return pd.DataFrame({"class": pdf["class"].iloc[0], "shape": list(bits), "bits": list(bits.values())})

    out: dict[str, dict[str, float]] = defaultdict(dict)
    for r in counts.groupBy("class").applyInPandas(book, "class string, shape string, bits double").toLocalIterator():
        out[r["class"]][r["shape"]] = r["bits"]
    return dict(out)


def split_packed(fields: DataFrame, keys: list[str], class_col: str, value_col: str) -> DataFrame:
    """(keys, pos_no, item_value): one row per value of every field that holds two or more.

    fields: `keys`, a class (what kind of value the field holds; the number of classes must be bounded) and the
    text. Null and blank fields and placeholders for "no value" give no row. Repeated rows count once. Extra columns are ignored.

    A field is read as one value, or as a list in one of DIALECTS. A list is as long as its dialect plus its
    pieces, a piece as long as the code of its shape in its class: minus the binary logarithm of the shape's
    share among whole fields over all data, or an escape code. Characters inside a shape cost the same in
    every reading and cancel out. Only shapes that are no list of other, shorter shapes of the class get a code
    word. The choice depends on a field's class and shape alone, so it is made once per shape and worker; then each
    text, of any length, is parsed whole.
    """
    rows = fields.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.coalesce(F.col(class_col).cast("string"), F.lit("")).alias("class"), F.col(value_col).alias("value")).where(~no_text(F.col("value")))
    sizes = class_sizes(rows)
    words = frequent_words(rows, sizes)
    shared = fields.sparkSession.sparkContext.broadcast((words, code_lengths(shape_counts(rows, words, sizes))))
    names = [f"k{i}" for i in range(len(keys))]

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, bits = shared.value
        books: dict[str, Codebook] = {}
        for pdf in batches:
            at, pos, item = [], [], []
            for i, (c, v) in enumerate(zip(pdf["class"], pdf["value"])):
                if c not in books:
                    books[c] = Codebook({})
                    books[c].bits = bits.get(c, {})
                d = books[c].dialect(shape(v, words.get(c, frozenset())))
                pieces = [p for p in parse(v, d) or [] if p] if d else []
                if len(pieces) > 1:
                    at += [i] * len(pieces)
                    pos += range(1, len(pieces) + 1)
                    item += pieces
            out = pdf[names].iloc[at].reset_index(drop=True)
            out["pos_no"], out["item_value"] = pd.array(pos, dtype="int32"), pd.array(item, dtype="object")
            yield out

    types = dict(fields.dtypes)
    schema = ", ".join([*(f"k{i} {types[k]}" for i, k in enumerate(keys)), "pos_no int", "item_value string"])
    packed = rows.where(F.col("value").rlike(CANDIDATE)).distinct()
    return packed.mapInPandas(split, schema).select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], "pos_no", "item_value")
