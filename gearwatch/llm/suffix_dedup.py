"""Exact substring dedup with suffix arrays built by two-stage sorting.

Every byte covered by a 100-byte string that also starts earlier is removed
(earlier: in a smaller document, or before in the same one).

The corpus is dealt so that equal strings meet: of the 24-byte grams inside a
100-byte window the one with the smallest hash is the window's anchor, and a
maximal run of windows with one anchor is a segment.  Equal windows have equal
anchors, so only segments of one anchor need comparing.  Segments whose anchor
occurs once are unique and drop out (unless a gram repeats inside).  Equal segments are counted first: all but
the earliest are removed whole.  The different segments of an anchor go to a
suffix array:

1. suffixes smaller than their successors are sorted directly, word by word
   while there are ties, to a depth beyond 100 bytes;
2. the others are induced by scanning the buckets of their first bytes upwards:
   a suffix stands where its successor's place says;
3. adjacent suffixes with a common prefix of 100 bytes are equal windows; all
   but the earliest of such a run are removed.

Scale: what is shuffled per text byte is about 1/39 narrow row, then the bytes of different
segments that share an anchor.  Suffix arrays are built over whole anchors of about ``BATCH_BYTES``
at a time.  Copies are pre-aggregated with map-side partials, so a passage in a
third of all documents is one segment.  An anchor with more than ``HOT``
different segments is dealt by single windows instead: equal windows are then
found by grouping, whatever their number.

Defined cases: null text is empty; texts under 100 bytes lose nothing; a null
id ranks last; different texts under one id (or under null ids) are documents of their
own, ranked by the digest of the text; rows equal in id and text are one document, and each of
them gets its result; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, doc_ids, keyed, one_of_each, text_batches, written
from .shingles import BASE, BYTE, INVERSE, mix, powers

LENGTH = 100             # bytes
GRAM = 24
SPAN = LENGTH - GRAM + 1  # grams in a window
BLOCK = 1 << 17          # bytes that are hashed at a time
LONGEST = 4096           # windows in a segment
BATCH_BYTES = 1 << 18
TAKEN_BYTES = 1 << 21    # bytes of segments that leave a task together
HOT = 20_000
U = np.uint64
SEPARATOR = b"\xff"      # no byte of UTF-8


def windows_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    size, low = 1, h
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    n = len(h) - width + 1
    return np.minimum(low[:n], low[width - size:width - size + n])


def repeats_inside(grams: np.ndarray, anchor: np.ndarray, cut: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether a gram that anchors windows stands twice in a segment: only then can its windows repeat each other."""
    most = ~windows_min(np.concatenate([np.full(SPAN - 1, ~U(0)), ~anchor, np.full(SPAN - 1, ~U(0))]), SPAN)
    spots = np.flatnonzero(grams == most)  # grams that are the smallest of a window
    value = grams[spots]
    pairs = np.cumsum(np.append(0, value[1:] == value[:-1]))
    lo, hi = np.searchsorted(spots, cut), np.searchsorted(spots, cut + n + SPAN - 1)
    return pairs[np.maximum(hi - 1, lo)] > pairs[np.minimum(lo, len(pairs) - 1)]


def segments(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text, anchor, digest, start, windows, repeats inside) of the segments of some texts, hashed together."""
    data = b"".join(texts)
    b = np.frombuffer(data, np.uint8)
    begin = np.cumsum(np.array([0] + [len(t) for t in texts], np.int64))
    if len(b) < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none.astype(U), none.astype(U), none, none, none.astype(bool)
    total = np.zeros(len(b) + 1, U)
    np.cumsum(BYTE[b] * powers(BASE, len(b)), out=total[1:])
    down = powers(INVERSE, len(b) + 1)
    grams = mix((total[GRAM:] - total[:-GRAM]) * down[:len(b) - GRAM + 1])
    anchor = windows_min(grams, SPAN)
    # windows that would reach into the next text stand apart, between the last window of one and the first of the next
    over = np.maximum(begin[1:] - LENGTH + 1, begin[:-1])
    at = np.concatenate([np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, begin[:-1], over, np.arange(0, len(anchor), LONGEST)])
    cut = np.unique(at[at < len(anchor)])
    n = np.diff(np.append(cut, len(anchor)))
    text = np.searchsorted(begin, cut, side="right") - 1
    own = cut < over[text]
    again = repeats_inside(grams, anchor, cut, n)[own]
    cut, n, text = cut[own], n[own], text[own]
    digest = mix((total[cut + n + LENGTH - 1] - total[cut]) * down[cut] + n.astype(U))
    return text, anchor[cut], digest, cut - begin[text], n, again


def text_blocks(ids: list[int], texts: list[str]) -> Iterator[tuple[list[bytes], list[int], list[int]]]:
    """(texts, ids, first bytes) to hash together; a long text comes in blocks that overlap by all but one window."""
    group, owners, offsets, size = [], [], [], 0
    for one, text in zip(ids, texts, strict=True):
        data = text.encode("utf-8", "replace")
        for at in range(0, max(1, len(data) - LENGTH + 1), BLOCK):
            block = data[at:at + BLOCK + LENGTH - 1]
            if size + len(block) > BLOCK and group:
                yield group, owners, offsets
                group, owners, offsets, size = [], [], [], 0
            group.append(block)
            owners.append(one)
            offsets.append(at)
            size += len(block)
    if group:
        yield group, owners, offsets


def dealt(docs: DataFrame) -> DataFrame:
    """(m, s, id, start, n, again): the segments of all documents (id, text)."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for texts, owners, offsets in text_blocks(list(b["id"]), list(b["text"])):
                text, m, s, start, n, again = segments(texts)
                yield pd.DataFrame({"m": m.view(np.int64), "s": s.view(np.int64), "id": np.array(owners, np.int64)[text],
                                    "start": start + np.array(offsets, np.int64)[text], "n": n, "again": again})

    return docs.select("id", "text").mapInPandas(cut, "m long, s long, id long, start long, n long, again boolean")


def suffix_array(t: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """Suffixes in order of their first 100 bytes and more; ``words[k]`` are the big-endian bytes 8k to 8k + 7 of each."""
    n = len(t)
    # smaller than the successor: by the next different byte; the end is smaller than all
    change = np.append(np.flatnonzero(t[1:] != t[:-1]), n - 1)
    run_end = change[np.searchsorted(change, np.arange(n))]
    following = np.append(t.astype(np.int16)[1:], -1)
    direct = following[run_end] > t
    order = sorted_directly(np.flatnonzero(direct), words)

    first = np.zeros(257, np.int64)
    np.cumsum(np.bincount(t, minlength=256), out=first[1:])
    split = np.searchsorted(t[order], np.arange(257))
    out = np.empty(n, np.int64)
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]

    def induce(block: np.ndarray) -> None:
        """Hand the predecessors of suffixes that have their place to the buckets of their first bytes."""
        before = block[block > 0] - 1
        before = before[~direct[before]]
        c = t[before]
        by_byte = np.argsort(c, kind="stable")
        before, c = before[by_byte], c[by_byte]
        edges = np.append(np.flatnonzero(np.append(True, c[1:] != c[:-1])), len(c)) if len(c) else []
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            waiting[c[lo]].append(before[lo:hi])

    if not direct[n - 1]:
        waiting[t[n - 1]].append(np.array([n - 1]))  # its successor is the empty suffix, before all
    for c in range(256):
        at = first[c]
        while waiting[c]:  # a suffix may be induced by one of its own bucket
            for block in (found := waiting[c]):
                out[at:at + len(block)] = block
                at += len(block)
            waiting[c] = []
            induce(np.concatenate(found))
        block = order[split[c]:split[c + 1]]
        out[at:at + len(block)] = block
        if len(block):
            induce(block)
    return out


def sorted_directly(suffixes: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """Suffixes ordered word by word; only what is still tied is sorted further."""
    order = suffixes[np.argsort(words[0][suffixes], kind="stable")]
    group = np.cumsum(np.append(True, words[0][order][1:] != words[0][order][:-1])) if len(order) else order
    for w in words[1:]:
        same = group[1:] == group[:-1]
        tied = np.flatnonzero(np.append(same, False) | np.append(False, same)) if len(order) else order
        if not len(tied):
            break
        part, g = order[tied], group[tied]
        by = np.lexsort((w[part], g))
        part = part[by]
        order[tied] = part
        new = np.append(True, (g[1:] != g[:-1]) | (w[part][1:] != w[part][:-1]))
        # a finer numbering of the tied groups that keeps their order
        fine = np.zeros(len(order), np.int64)
        fine[tied] = new
        whole = np.append(True, ~same)
        whole[tied] = False
        group = np.cumsum(fine + whole)
    return order


def repeated_windows(parts: list[bytes], ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part, first window, windows) of the runs of windows of ``parts`` that also start earlier."""
    none = np.zeros(0, np.int64)
    data = SEPARATOR.join(parts) + SEPARATOR
    t = np.frombuffer(data, np.uint8)
    padded = np.frombuffer(data + bytes(LENGTH + 8), np.uint8)
    word = np.ndarray((len(padded) - 7,), ">u8", padded, strides=(1,)).astype(U)
    depth = -(-LENGTH // 8)
    words = [word[8 * k:8 * k + len(t)] for k in range(depth)]
    sa = suffix_array(t, words)
    lengths = np.array([len(p) for p in parts], np.int64)
    begin = np.cumsum(np.append(0, lengths[:-1] + 1))
    part = np.searchsorted(begin, sa, side="right") - 1
    offset = sa - begin[part]
    whole = offset + LENGTH <= lengths[part]
    sa, part, offset = sa[whole], part[whole], offset[whole]
    if len(sa) < 2:
        return none, none, none
    common = np.ones(len(sa) - 1, bool)  # adjacent common prefix of 100 bytes
    for k in range(depth):
        w = words[k] if 8 * k + 8 <= LENGTH else words[k] >> U(8 * (8 * k + 8 - LENGTH))
        common &= w[sa[1:]] == w[sa[:-1]]
    run = np.cumsum(np.append(True, ~common))
    by = np.lexsort((starts[part] + offset, ids[part], run))
    later = np.append(False, run[by][1:] == run[by][:-1])
    # the same place may stand in two parts; it is no repeat of itself
    place_id, place = ids[part][by], (starts[part] + offset)[by]
    head = np.maximum.accumulate(np.where(later, 0, np.arange(len(by))))
    later &= (place_id != place_id[head]) | (place != place[head])
    p, o = part[by][later], offset[by][later]
    if not len(p):
        return none, none, none
    by = np.lexsort((o, p))
    p, o = p[by], o[by]
    new = np.flatnonzero(np.append(True, (p[1:] != p[:-1]) | (o[1:] != o[:-1] + 1)))
    return p[new], o[new], np.diff(np.append(new, len(p)))


RUNS = "id long, start long, n long"


def compared(parts: DataFrame) -> DataFrame:
    """Runs of repeated windows among the different segments (m, id, start, bytes) of each anchor."""
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for b in batches:
            size += int(b["bytes"].map(len).sum())
            held.append(b)
            if size >= BATCH_BYTES:
                rows = pd.concat(held)
                last = rows["m"] == rows["m"].iloc[-1]  # its anchor may go on in the next batch
                if not last.all():
                    yield runs(rows[~last])
                    rows = rows[last]
                held, size = [rows], int(rows["bytes"].map(len).sum())
        if held:
            yield runs(pd.concat(held))

    def runs(rows: pd.DataFrame) -> pd.DataFrame:
        ids, starts = rows["id"].to_numpy(), rows["start"].to_numpy()
        p, o, n = repeated_windows(list(rows["bytes"]), ids, starts)
        return pd.DataFrame({"id": ids[p], "start": starts[p] + o, "n": n})

    return parts.repartition("m").sortWithinPartitions("m").mapInPandas(compare, RUNS)


def window_digests(parts: DataFrame) -> DataFrame:
    """(d1, d2, id, start) of every single window of segments (id, start, bytes)."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for one, start, data in zip(b["id"], b["start"], b["bytes"], strict=True):
                n = len(data) - LENGTH + 1
                d = b"".join(hashlib.blake2b(data[k:k + LENGTH], digest_size=16).digest() for k in range(n))
                d = np.frombuffer(d, "<i8").reshape(-1, 2)
                yield pd.DataFrame({"d1": d[:, 0], "d2": d[:, 1], "id": one, "start": start + np.arange(n)})

    return parts.mapInPandas(cut, "d1 long, d2 long, id long, start long")


def repeats(docs: DataFrame) -> DataFrame:
    """(id, start, n): n windows from byte ``start`` of document ``id`` also start earlier; docs is (id, text), each id once."""
    seen = dealt(docs)
    anchors = (seen.groupBy("m").agg(F.count(F.lit(1)).alias("times"), F.max("again").alias("again"))
               .where((F.col("times") > 1) | F.col("again")).select("m"))
    # the kept anchors are few and have a row each, so they are hashed and the segments need no sort
    shared = written(seen.join(anchors.hint("shuffle_hash"), "m", "left_semi"), "suffix-shared")
    # the earliest of equal segments: smallest id, then smallest start within it
    first_id = shared.groupBy("m", "s").agg(F.min("id").alias("first_id"))
    at = shared.join(first_id, ["m", "s"])
    first = (at.where("id = first_id").groupBy("m", "s").agg(F.min("id").alias("first_id"), F.min("start").alias("first_start"),
                                                             F.max("n").alias("n"), F.max("again").alias("again")))
    first = written(first, "suffix-first")
    copies = (shared.join(first.select("m", "s", "first_id", "first_start"), ["m", "s"])
              .where((F.col("id") != F.col("first_id")) | (F.col("start") != F.col("first_start"))).select("id", "start", "n"))
    different = first.groupBy("m").agg(F.count(F.lit(1)).alias("kinds"))
    open_ = (first.join(different, "m").where((F.col("kinds") > 1) | F.col("again"))
             .select("m", F.col("first_id").alias("id"), F.col("first_start").alias("start"), "n", "kinds"))
    cuts = open_.groupBy("id").agg(F.collect_list(F.struct("m", "start", "n", "kinds")).alias("cuts"))  # of one text
    # a list per field: an array of numbers in Python, where a list of structs is a list of dictionaries
    wanted = cuts.select("id", "cuts.m", "cuts.start", "cuts.n", "cuts.kinds")

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            held, own, size = [], [], 0  # segments of texts that leave together: a frame for each text costs more than the cutting

            def out() -> pd.DataFrame:
                times = [len(rows["m"]) for rows in own]
                columns = {c: np.concatenate([rows[c] for rows in own]) for c in ("m", "start", "kinds")}
                return pd.DataFrame({"m": columns["m"], "id": np.repeat([rows["id"] for rows in own], times), "start": columns["start"],
                                     "bytes": held, "kinds": columns["kinds"]})

            for rows in b.to_dict("records"):
                data = rows["text"].encode("utf-8", "replace")
                for at, to in zip(rows["start"].tolist(), (rows["start"] + rows["n"] + LENGTH - 1).tolist(), strict=True):
                    held.append(data[at:to])
                    size += to - at
                own.append(rows)
                if size >= TAKEN_BYTES:
                    yield out()
                    held, own, size = [], [], 0
            if own:
                yield out()

    parts = docs.join(wanted, "id").mapInPandas(take, "m long, id long, start long, bytes binary, kinds long")
    parts = written(parts, "suffix-parts")
    found = copies.unionByName(compared(parts.where(F.col("kinds") <= HOT)))
    hot = parts.where(F.col("kinds") > HOT)
    if hot.limit(1).count():
        single = written(window_digests(hot), "suffix-windows")
        least = single.groupBy("d1", "d2").agg(F.min("id").alias("least"))
        at = single.join(least, ["d1", "d2"])
        spot = at.where("id = least").groupBy("d1", "d2").agg(F.min("start").alias("spot"))
        later = at.join(spot, ["d1", "d2"]).where((F.col("id") != F.col("least")) | (F.col("start") != F.col("spot")))
        found = found.unionByName(later.select("id", "start", F.lit(1).cast("long").alias("n")))
    return found


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, removed, kept): removed are (start, end) byte spans of the text, kept the remaining bytes."""
    text_batches(docs.sparkSession)
    rows, repeated = keyed(docs, id_col, text_col)
    once = one_of_each(rows, repeated, F.coalesce(F.col(text_col), F.lit("")))
    runs = repeats(once).groupBy("id").agg(F.collect_list(F.struct("start", "n")).alias("runs"))  # of one text

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for one, text, found in zip(b["id"], b["text"], b["runs"], strict=True):
                data = text.encode("utf-8", "replace")
                spans: list[dict] = []
                for start, n in sorted((r["start"], r["n"]) for r in found) if found is not None else ():
                    end = start + n + LENGTH - 1
                    if spans and start <= spans[-1]["end"]:
                        spans[-1]["end"] = max(end, spans[-1]["end"])
                    else:
                        spans.append({"start": start, "end": end})
                kept, at = [], 0
                for s in spans:
                    kept.append(data[at:s["start"]])
                    at = s["end"]
                rows.append((one, len(data), spans, b"".join(kept) + data[at:]))
            yield pd.DataFrame(rows, columns=["id", "n_bytes", "removed", "kept"])

    out = once.join(runs, "id", "left").mapInPandas(
        cut, "id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary")
    if repeated:
        return doc_ids(rows, id_col).join(out, "id").select("doc_id", "n_bytes", "removed", "kept")
    return out.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "n_bytes", "removed", "kept")
