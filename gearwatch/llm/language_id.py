"""Language identification by error-correcting output codes.

Each language has a binary codeword; for each bit a binary character n-gram
classifier separates the languages whose bit is 1 from those whose bit is 0.  A text's
bit margins are decoded by loss-weighted distance: the codeword with
the smallest weighted sum of exponential losses wins, a bit's weight is the
accuracy it reached on the training texts, and a small gap between the two
nearest codewords flags the text as ambiguous.

Training counts hashed byte n-grams per language over all labelled texts,
one distributed pass; a task returns a fixed number of rows per language, the
model is (bits x 2^16) weights whatever the corpus size.  A second pass over the same
texts measures the bits.

Defined cases: null text and text without a letter are ``und`` with score 0
and not ambiguous; without labelled texts every text is ``und``; with one
language every text with a letter is that language; ties go to the language
that sorts first; repeated rows get equal results; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_batches

DIM_BITS = 16
DIM = 1 << DIM_BITS
SLICES = 32              # parts of a count vector, merged apart
SMOOTHING = 0.5
UNKNOWN = "und"
AMBIGUOUS_GAP = 0.2
EXHAUSTIVE_UP_TO = 6     # languages; beyond, random codewords
CODE_BITS_PER_LOG2 = 10
CHUNK_BYTES = 8 << 20
LETTER = re.compile(r"[^\W\d_]")
ODD = [np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)]


def codebook(n: int) -> np.ndarray:
    """n codewords of +1 and -1: every split of the languages up to six, else the best of some random codes."""
    if n <= EXHAUSTIVE_UP_TO:
        splits = [c for c in itertools.product((1, -1), repeat=max(1, n)) if c[0] == 1 and -1 in c]
        return np.array(splits or [(1,) * n], dtype=np.int8).T
    rng = np.random.RandomState(n)
    codes = []
    for _ in range(64):
        c = np.where(rng.rand(n, int(np.ceil(CODE_BITS_PER_LOG2 * np.log2(n)))) < 0.5, -1, 1).astype(np.int8)
        c = c[:, np.abs(c.sum(0)) < n]  # a bit that all share says nothing
        apart = (c[:, None, :] != c[None, :, :]).sum(2) + n * c.shape[1] * np.eye(n, dtype=int)
        codes.append((apart.min(), c))
    return max(codes, key=lambda x: x[0])[1]


def grams(text: bytes) -> np.ndarray:
    """Hashed byte bigrams, trigrams and 4-grams of a text (``DIM`` classes)."""
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    out, code = [], b
    for n in (2, 3, 4):
        if len(b) < n:
            break
        code = (code[:-1] << np.uint32(8)) | b[n - 1:]
        out.append((code + np.uint32(n)) * ODD[n - 2] >> np.uint32(32 - DIM_BITS))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def normal(text: str) -> Iterator[bytes]:
    """Lower-cased text in pieces of bounded size, so that a very long text needs no more memory."""
    for at in range(0, len(text), CHUNK_BYTES // 4):
        yield b" " + text[at:at + CHUNK_BYTES // 4].lower().encode("utf-8", "replace") + b" "


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray      # languages x bits
    weights: np.ndarray    # DIM x bits, log-odds of a gram under bit = +1
    trust: np.ndarray      # bits

    def margins(self, text: str) -> np.ndarray:
        """Mean log-odds of the text's grams for each bit."""
        total, n = np.zeros(self.codes.shape[1]), 0
        for piece in normal(text):
            g = grams(piece)
            total += np.bincount(g, minlength=DIM) @ self.weights if len(g) > DIM else self.weights[g].sum(0)
            n += len(g)
        return total / max(1, n)

    def decode(self, margins: np.ndarray) -> tuple[str, float, bool]:
        """Nearest codeword by weighted loss; score is its softmax share, ambiguous if the runner-up is near."""
        loss = (self.trust * np.exp(-self.codes * (4.0 * margins))).sum(1) / self.trust.sum()
        near = np.exp(-(loss - loss.min()) * 8.0)
        share = near / near.sum()
        first, *rest = np.argsort(loss, kind="stable")
        gap = share[first] - share[rest[0]] if rest else 1.0
        return self.languages[first], float(share[first]), bool(gap < AMBIGUOUS_GAP)


def train(labelled: DataFrame) -> Model | None:
    """Fit on all rows of (text, lang) with a text and a language."""
    text_batches(labelled.sparkSession)
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for b in batches:
            for text, lang in zip(b["text"], b["lang"], strict=True):
                own = totals.setdefault(lang, np.zeros(DIM, np.int64))
                for piece in normal(text):
                    own += np.bincount(grams(piece), minlength=DIM)
        for lang, own in totals.items():
            parts = [zlib.compress(part.tobytes(), 1) for part in own.reshape(SLICES, -1)]
            yield pd.DataFrame({"lang": lang, "part": range(SLICES), "counts": parts})

    def merge(key: tuple, slices: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(DIM // SLICES, np.int64)
        for s in slices:
            for c in s["counts"]:
                total += np.frombuffer(zlib.decompress(c), np.int64)
        yield pd.DataFrame({"lang": [key[0]], "part": [key[1]], "counts": [total.tobytes()]})

    # a row per language, slice and task, then per language and slice
    schema = "lang string, part int, counts binary"
    found = rows.mapInPandas(count, schema).groupBy("lang", "part").applyInPandas(merge, schema).collect()
    if not found:
        return None
    languages = sorted({r["lang"] for r in found})
    share = np.full((len(languages), SLICES, DIM // SLICES), SMOOTHING)
    for r in found:
        share[languages.index(r["lang"]), r["part"]] += np.frombuffer(r["counts"], np.int64)
    share = share.reshape(len(languages), DIM)
    share = share / share.sum(1, keepdims=True)
    codes = codebook(len(languages))
    weights = np.zeros((DIM, codes.shape[1]), np.float32)
    for bit in range(codes.shape[1]):
        one, zero = share[codes[:, bit] == 1], share[codes[:, bit] == -1]
        if len(one) and len(zero):
            weights[:, bit] = np.log(one.mean(0)) - np.log(zero.mean(0))
    model = Model(languages, codes, weights, np.ones(codes.shape[1]))
    model.trust = bit_accuracy(rows, model)
    return model


def bit_accuracy(rows: DataFrame, model: Model) -> np.ndarray:
    """Weight of each bit: its accuracy on the training texts above chance."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # size fixed by DIM and the number of languages

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        code = dict(zip(m.languages, m.codes, strict=True))
        hits, n = np.zeros(m.codes.shape[1], np.int64), 0
        for b in batches:
            for text, lang in zip(b["text"], b["lang"], strict=True):
                hits += (m.margins(text) * code[lang]) > 0
                n += 1
        yield pd.DataFrame({"bit": np.arange(len(hits)), "hits": hits, "n": n})

    got = (rows.mapInPandas(judge, "bit int, hits long, n long").groupBy("bit")
           .agg(F.sum("hits").alias("hits"), F.sum("n").alias("n")).collect())
    trust = np.zeros(model.codes.shape[1])
    for r in got:
        trust[r["bit"]] = max(r["hits"] / max(1, r["n"]) - 0.5, 0.01)
    return trust


def predict(docs: DataFrame, model: Model | None, text: Column) -> DataFrame:
    """``docs`` with lang_pred, score and ambiguous; only the text decides."""
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def classify(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for batch in texts:
            rows = [(UNKNOWN, 0.0, False) if m is None or t is None or not LETTER.search(t) else m.decode(m.margins(t))
                    for t in batch]
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "ambiguous"])

    return docs.withColumn("_p", classify(text)).select("*", "_p.*").drop("_p")
