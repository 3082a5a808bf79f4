"""Packing documents into sequences by cutting-stock column generation.

A document's ids are cut into full sequences and one remainder.  The
remainders' lengths, in classes of ``CLASS`` tokens, form a histogram; a linear
program chooses how often to use each pattern (a multiset of classes that fits
into a sequence).  New patterns are priced by knapsack dynamic programming
over the duals until none improves.  Patterns are rounded down, the few
remainders left over are packed first-fit decreasing, and pieces are assigned
by their rank within their class: rank k of a class fills the class's k-th slot.

Scale: texts are tokenised once, in the tasks, into narrow written rows.  The driver
sees the histogram (at most 256 rows) and solves a program of that size
whatever the corpus.  Ranks come from counts by (class, block) and a row number inside
each block, so a length that a third of all documents share is dealt over
many tasks; the pattern table is bounded by the number of classes.

Defined cases: null and empty text is the closing id alone; repeated rows are
packed each by themselves; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_join, text_batches, whole_numbers, written

SEQUENCE = 2048
CLASS = 8
CLASSES = SEQUENCE // CLASS
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
GAP = 1e-3               # distance from the optimum at which pricing stops, as a share
MAX_COLUMNS = 4000       # patterns priced at most; the program is feasible whenever it stops
CACHED_WORDS = 300_000   # words, and pieces of words, in a generation of a Python worker's cache
BLOCK_ROWS = 20_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


@functools.lru_cache(maxsize=2)
def tokenizer(name: str):
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path(name))


class Recent(dict):
    """A cache of two generations: what the current one lacks is looked for in the one before."""

    def __init__(self, size: int):
        super().__init__()
        self.size, self.before = size, {}

    def find(self, key: str) -> bytes | None:
        found = self.get(key)
        if found is None and (found := self.before.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key: str, value: bytes) -> None:
        if len(self) >= self.size:
            self.before = dict(self)
            self.clear()
        self[key] = value


#: Texts whose pieces are known without the tokenizer's normalisation: printable ASCII, blanks, line ends and Latin-1
#: letters, which lower-casing maps one to one.  ``<|`` may begin a special token.
PLAIN = re.compile(r"[\n -~\u00c0-\u00ff]*")
#: The tokenizer's own split, over such texts in lower case.
SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^ \na-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
END_OF_WORD = "</w>"
JOINED_PIECES = 2000     # pieces encoded as one text


class WordIds:
    """Ids of whole texts, from the ids of their pieces.

    The tokenizer drops white space, splits a text by a pattern and never joins what that parts; so a text's ids are
    its pieces' ids in turn.  New pieces are encoded together as one text, blanks between them, and
    its ids cut after every token that ends a word.  Texts with other characters go by blank-separated
    words, each encoded by itself.  Both are remembered for as long as the Python worker lives.
    """

    def __init__(self, name: str):
        self.encode = tokenizer(name)
        self.words, self.pieces = Recent(CACHED_WORDS), Recent(CACHED_WORDS)
        vocabulary = self.encode.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(END_OF_WORD)]] = True

    def one_by_one(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.encode.encode_batch(texts, add_special_tokens=False)]

    def together(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece; a text whose ids do not fall into as many words is encoded piece by piece."""
        ids = np.array(self.encode.encode(" ".join(pieces), add_special_tokens=False).ids, "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(pieces) or stops[-1] != len(ids):
            return self.one_by_one(pieces)
        data, starts = ids.tobytes(), np.concatenate([[0], stops[:-1]])
        return [data[4 * a:4 * b] for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]

    def known(self, parts: set[str], cache: Recent, learn, at_once: int) -> dict[str, bytes]:
        """Ids of each part, new ones learnt so many at once."""
        out = {p: cache.get(p) for p in parts}
        new = []
        for p in [p for p, ids in out.items() if ids is None]:
            out[p] = cache.find(p)
            if out[p] is None:
                new.append(p)
        for at in range(0, len(new), at_once):
            some = new[at:at + at_once]
            for p, ids in zip(some, learn(some), strict=True):
                out[p] = ids
                cache.put(p, ids)
        return out

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        plain = [bool(PLAIN.fullmatch(t)) and "<|" not in t for t in texts]
        split = [SPLIT.findall(t.lower()) if p else [w for w in t.replace("\n", " ").split(" ") if w]
                 for t, p in zip(texts, plain, strict=True)]
        parts = {p: set().union(*[s for s, q in zip(split, plain, strict=True) if p == q]) for p in (True, False)}
        ids = {True: self.known(parts[True], self.pieces, self.together, JOINED_PIECES),
               False: self.known(parts[False], self.words, self.one_by_one, 10_000)}
        for own, p in zip(split, plain, strict=True):
            yield b"".join(map(ids[p].__getitem__, own))


@functools.lru_cache(maxsize=2)
def word_ids(name: str) -> WordIds:
    """One for each Python worker: its caches outlive a task."""
    return WordIds(name)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = TOKENIZER) -> DataFrame:
    """Rows of ``PIECES``: full sequences and the remainder of each document."""
    text_batches(docs.sparkSession)
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = word_ids(name)
        for b in batches:
            rows = []
            for doc_id, ids in zip(b["id"], ids_of([t or "" for t in b["text"]]), strict=True):
                ids += end
                n = len(ids) // 4
                for start in range(0, n, SEQUENCE):
                    part = ids[4 * start:4 * (start + SEQUENCE)]
                    rows.append((doc_id, start, len(part) // 4, zlib.crc32(part), n))
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            out["doc_id"] = whole_numbers(out["doc_id"])
            yield out

    # an id travels as a string: pandas would make nullable ids floats
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(cut, PIECES)


def knapsack(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Best multiset of items within the capacity: its value and the count of each item."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for w in range(1, capacity + 1):
        best[w], choice[w] = best[w - 1], -1
        fit = np.searchsorted(sizes, w, side="right")  # sizes ascend
        if fit:
            gain = values[:fit] + best[w - sizes[:fit]]
            k = int(gain.argmax())
            if gain[k] > best[w] + 1e-12:
                best[w], choice[w] = gain[k], k
    counts, w = np.zeros(len(sizes), np.int64), capacity
    while w > 0:
        if choice[w] < 0:
            w -= 1
        else:
            counts[choice[w]] += 1
            w -= sizes[choice[w]]
    return float(best[capacity]), counts


def patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """(count of each size, how many sequences) covering the demand; sizes ascend, demands are positive."""
    m = len(sizes)
    columns = [np.eye(m, dtype=np.int64)[i] * (capacity // sizes[i]) for i in range(m)]
    cost = np.ones(m)
    inverse = np.diag([1.0 / c[i] for i, c in enumerate(columns)])
    x = inverse @ demand
    bound = float(sizes @ demand) / capacity  # no plan has fewer sequences
    for _ in range(MAX_COLUMNS):
        if cost @ x <= bound * (1 + GAP):
            break
        dual = cost @ inverse
        low = int(dual.argmin())
        if dual[low] < -1e-9:  # a slack of that size's demand enters
            new, price = -np.eye(m, dtype=np.int64)[low], 0.0
        else:
            value, new = knapsack(np.maximum(dual, 0), sizes, capacity)
            price = 1.0
            if value <= 1 + GAP:  # no pattern improves the program by more than that share
                break
        direction = inverse @ new
        positive = direction > 1e-9
        if not positive.any():
            break
        ratio = np.where(positive, x / np.where(positive, direction, 1), np.inf)
        out = int(ratio.argmin())
        step = max(0.0, float(ratio[out]))
        x -= step * direction
        x[out] = step
        row = inverse[out] / direction[out]
        inverse -= np.outer(direction, row)
        inverse[out] = row
        columns[out], cost[out] = new, price
    used = [(c, int(np.floor(v + 1e-6))) for c, v, p in zip(columns, x, cost, strict=True) if p and v >= 1 - 1e-6]
    left = demand - sum((c * n for c, n in used), np.zeros(m, np.int64))
    return used + leftovers(sizes, np.maximum(left, 0), capacity)


def leftovers(sizes: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """First-fit decreasing over what rounding left: no more pieces than patterns times pieces in a pattern."""
    bins: list[list] = []  # [room, counts]
    for k in range(len(sizes) - 1, -1, -1):
        n = int(left[k])
        for b in bins:
            fit = min(n, b[0] // int(sizes[k]))
            b[0] -= fit * int(sizes[k])
            b[1][k] += fit
            n -= fit
        while n > 0:
            fit = min(n, capacity // int(sizes[k]))
            counts = np.zeros(len(sizes), np.int64)
            counts[k] = fit
            bins.append([capacity - fit * int(sizes[k]), counts])
            n -= fit
    return [(counts, 1) for _, counts in bins]


def slots(histogram: dict[int, int]) -> list[tuple[int, int, int, int, int]]:
    """(class, first rank, end rank, pieces a sequence, first sequence) for a histogram of classes."""
    sizes = np.array(sorted(histogram), np.int64)
    if not len(sizes):
        return []
    demand = np.array([histogram[s] for s in sizes], np.int64)
    rows, at, sequence = [], dict.fromkeys(sizes, 0), 0
    for counts, n in patterns(sizes, demand, CLASSES):
        for size, each in zip(sizes, counts, strict=True):
            if each:
                rows.append((int(size), at[size], at[size] + int(each) * n, int(each), sequence))
                at[size] += int(each) * n
        sequence += n
    return rows


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = TOKENIZER) -> DataFrame:
    """One row per piece: ``PIECES`` and sequence_id, offset."""
    spark = docs.sparkSession
    cls = F.ceil(F.col("length") / F.lit(CLASS)).cast("int")
    cut = written(pieces(docs, id_col, text_col, name).withColumn("cls", cls), "pack-pieces")
    histogram = {r["cls"]: r["n"] for r in cut.groupBy("cls").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = spark.createDataFrame(slots(histogram), "cls int, lo long, hi long, each long, first long")

    blocks = max(64, sum(histogram.values()) // BLOCK_ROWS)
    cut = cut.withColumn("block", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(blocks)))
    before = Window.partitionBy("cls").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(cut.groupBy("cls", "block").agg(F.count(F.lit(1)).alias("n"))
                      .select("cls", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "pack-offsets")
    within = Window.partitionBy("cls", "block").orderBy(F.desc("doc_tokens"), "doc_id", "start", "ids_crc32")
    ranked = small_join(cut.withColumn("k", F.row_number().over(within) - 1), offsets, ["cls", "block"])
    ranked = ranked.withColumn("k", F.col("k") + F.col("before"))

    placed = (ranked.join(F.broadcast(table), "cls")  # bounded by the number of classes
              .where((F.col("k") >= F.col("lo")) & (F.col("k") < F.col("hi")))
              .withColumn("sequence_id", F.col("first") + F.floor((F.col("k") - F.col("lo")) / F.col("each")))
              .withColumn("place", F.pmod(F.col("k") - F.col("lo"), F.col("each"))))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("cls"), "place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset"))
