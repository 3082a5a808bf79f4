"""Substring dedup by hashing normalised paragraphs and lines.

A text is cut into units, each paragraph and each of its lines; a unit's normal form (lower case, runs of white
space as one blank, trimmed) is hashed to 128 bits.  Units of fewer than ``MIN_WORDS`` words are no passages: stock
phrases of a few words stand in many texts that have nothing else in common, so they stay.  Digests are grouped over
the whole corpus, whatever the kind of unit; the occurrence in the smallest document (and the first
inside a document) stays, later ones go, with all that lies inside them.  Removed units keep their offsets in
the original text.

A passage need not begin or end with a line.  So, if asked for, the shortest run of whole sentences from each sentence on that has
``passage_words`` words is a unit as well; the runs of a repeated passage overlap and go as one span.

Scale: only (digest, doc_id) pairs are shuffled, one per distinct unit of a
document.  Counting a digest is a hash aggregate with map-side partials (a
line in every document meets in one small row); marking the other occurrences
is a join that Spark can split at skewed digests; removals are gathered per
document, bounded by its own number of units.

Defined cases: null text has no units, result text null and a digest of the
empty text; blank units are none; lines with fewer than ``min_words`` words go only with a
paragraph that does; whole texts of any length are read, one at a time; other columns may have any names; a unit inside a removed one still counts as an occurrence; a null
doc_id ranks after all others; different texts under one doc_id (or under null) rank by their digest,
rows equal in both rank equal and are treated alike; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Collection, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed, text_batches, whole_numbers, written

MIN_WORDS = 15           # of a line or paragraph
PASSAGE_WORDS = 30       # of a run of sentences, at least, in the query
KINDS = ("paragraph", "line")

#: What ends a unit, by kind; the units and what stands between them make up the text.
BOUNDARIES = {
    "paragraph": re.compile(r"\n\s*\n"),
    "line": re.compile(r"\n"),
}
SENTENCE_END = re.compile(r"[.!?\n](?:(?<=\n)\s*|\s+)")  # one set of first characters, which is searched fast


def pieces(text: str, kind: str, start: int, stop: int) -> Iterator[tuple[int, int, str]]:
    """(start, end, normal form) of each unit of one kind that is not blank, in order."""
    at = start
    ends = [(m.start(), m.end()) for m in BOUNDARIES[kind].finditer(text, start, stop)]
    for end, after in [*ends, (stop, stop)]:
        normal = " ".join(text[at:end].lower().split())
        if normal:
            yield at, end, normal
        at = after


def units(text: str, kinds: Collection[str], min_words: int) -> Iterator[tuple[int, int, bytes]]:
    """(start, end, digest) of each unit, one that holds others before them; a line that is all of its paragraph is one unit."""
    def digest(normal: str) -> bytes:
        return hashlib.blake2b(normal.encode("utf-8", "replace"), digest_size=16).digest()

    def long_enough(normal: str) -> bool:
        return normal.count(" ") + 1 >= min_words

    for start, end, whole in pieces(text, "paragraph", 0, len(text)):
        if not long_enough(whole):
            continue
        lines = list(pieces(text, "line", start, end)) if "line" in kinds else []
        if "paragraph" in kinds and len(lines) != 1:
            yield start, end, digest(whole)
        for a, b, normal in lines:
            if long_enough(normal):
                yield a, b, digest(normal)


def passages(text: str, min_words: int | None) -> Iterator[tuple[int, int, bytes]]:
    """(start, end, digest) of the shortest run of whole sentences from each sentence on that has ``min_words`` words, if any."""
    if min_words is None:
        return
    each, at = [], 0
    ends = [(m.start() + (text[m.start()] != "\n"), m.end()) for m in SENTENCE_END.finditer(text)]
    for end, after in [*ends, (len(text), len(text))]:
        if own := text[at:end].lower().split():
            each.append((at, end, " ".join(own).encode("utf-8", "replace"), len(own)))
        at = after
    last, words = 0, 0
    for k, (start, _, _, own) in enumerate(each):
        while words < min_words and last < len(each):
            words += each[last][3]
            last += 1
        if words < min_words:
            return
        normal = b" ".join([x[2] for x in each[k:last]])
        yield start, each[last - 1][1], hashlib.blake2b(normal, digest_size=16, person=b"passage").digest()
        words -= own


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that overlap or touch as one, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def digests(docs: DataFrame, kinds: Collection[str], min_words: int, passage_words: int | None = None) -> DataFrame:
    """(rank, d1, d2): each distinct unit digest of each document, as two longs."""
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids, found = [], []
            for rank, text in zip(b["rank"], b["text"], strict=True):
                own = {d for _, _, d in (*units(text, kinds, min_words), *passages(text, passage_words))} if text else ()
                ids += [rank] * len(own)
                found += own
            d = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
            yield pd.DataFrame({"rank": np.array(ids, "int64"), "d1": d[:, 0], "d2": d[:, 1]})

    return docs.mapInPandas(emit, "rank long, d1 long, d2 long")


def dedup_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kind: str | None = None,
                min_words: int = MIN_WORDS, passage_words: int | None = None) -> DataFrame:
    """One row per document: id, n_units, kept_text, removed (spans with original offsets), n_removed chars.

    ``kind`` restricts the units to one kind; a unit that goes with a larger one has no span of its own.
    With ``passage_words``, runs of sentences with so many words are units too, wherever in a line they begin; spans that
    they touch become one.
    """
    kinds = KINDS if kind is None else (kind,)
    text_batches(docs.sparkSession)
    rows, _ = keyed(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text")
    ranked = rows.select("doc_id", "text", F.col("_key").alias("rank"))
    found = digests(ranked.select("rank", "text"), kinds, min_words, passage_words)
    if passage_words is not None:  # several times as many, so they are made once
        found = written(found, "unit-digests")
    shared = (found.groupBy("d1", "d2").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").drop("n"))
    gone = (found.join(shared, ["d1", "d2"]).where("rank > first")
            .groupBy("rank").agg(F.collect_list(F.struct("d1", "d2")).alias("gone")))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc_id, text, dup in zip(b["doc_id"], b["text"], b["gone"], strict=True):
                drop = {np.array([d["d1"], d["d2"]], "<i8").tobytes() for d in dup} if dup is not None else set()
                seen: set[bytes] = set()
                spans, at, n = [], 0, 0
                for start, end, digest in units(text, kinds, min_words) if text else ():
                    n += 1
                    if start >= at and (digest in drop or digest in seen):
                        spans.append((start, end))
                        at = end
                    seen.add(digest)
                runs: list[tuple[int, int]] = []
                ends: dict[bytes, int] = {}
                for start, end, digest in passages(text, passage_words) if text else ():
                    n += 1
                    # a run that overlaps its own first occurrence repeats nothing
                    if digest in drop or start >= ends.setdefault(digest, end):
                        runs.append((start, end))
                spans = merged(spans + runs) if runs else spans
                cuts = [0, *(x for s in spans for x in s), None]
                whole = None if text is None else "".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))
                rows.append((doc_id, n, whole, [{"start": a, "end": b} for a, b in spans], sum(b - a for a, b in spans)))
            out = pd.DataFrame(rows, columns=["doc_id", "n_units", "kept_text", "removed", "n_removed"])
            out["doc_id"] = whole_numbers(out["doc_id"])
            yield out

    # an id travels as a string: pandas would make nullable ids floats
    joined = ranked.join(gone, "rank", "left").select(F.col("doc_id").cast("string"), "text", "gone")
    return joined.mapInPandas(
        cut, "doc_id long, n_units long, kept_text string, removed array<struct<start:long,end:long>>, n_removed long")
