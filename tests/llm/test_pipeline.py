"""Decisions of the pipeline's stages on small tables."""

import hashlib
import random
from collections import Counter

import corpus_pipeline as P
from tests.llm.test_operators import WORD, prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    w = WORD.findall((text or "").lower())
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def like(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", len(t or "")) for i, t in rows], SCHEMA).repartition(3)


def copies(r):
    """A text, a copy at a likeness of 0.82 and one at 0.78."""
    base = [f"{prose(r, 1)}{k}" for k in range(200)]
    return " ".join(base), *(" ".join([*base[:60], *["x"] * n, *base[60 + n:]]) for n in (24, 32))


def test_near_dedup_links_from_80_percent(spark):
    r = random.Random(5)
    base, near, far = copies(r)
    assert 0.8 <= like(base, near) < 0.85 and like(base, far) < 0.8
    got = P.near_dedup(spark, frame(spark, [(1, base), (2, near), (4, prose(r, 200))]), "").collect()
    assert {x["doc_id"] for x in got} == {1, 4}
    assert {x["doc_id"] for x in P.near_dedup(spark, frame(spark, [(1, base), (3, far)]), "").collect()} == {1, 3}


def test_redaction_cuts_each_row_by_its_own_spans(spark):
    key = 'password="Xk29fLmQ81zz7RtB"'
    rows = [(None, f"{key} at the front"), (None, "clean text of some length, longer than the other"), (None, f"at the end {key}"),
            (None, None), (7, f"one {key}"), (7, "seven without any of them"), (7, f"{key}, {key}"), (8, "clean"), (7, f"one {key}")]
    got = P.secrets(spark, frame(spark, rows), "").collect()
    # the match ends before a closing quote
    want = [(i, t and t.replace(key[:-1], "[SECRET]")) for i, t in rows]
    assert sorted(map(str, ((x["doc_id"], x["text"]) for x in got))) == sorted(map(str, want))
    assert all(x["n_chars"] == (x["text"] and len(x["text"])) for x in got)


def good(text):
    """The quality rules."""
    w, symbols = WORD.findall(text or ""), sum(c in "#*$%&|<>" for c in text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    again = {k + j for k in range(len(w) - 4) if grams[tuple(w[k:k + 5])] > 1 for j in range(5)}
    chars, dup = sum(map(len, w)), len(lines) - len(set(lines))
    return not (len(w) < 10 or 100 * len(again) > 20 * len(w) or chars < 2 * len(w) or chars > 20 * len(w)
                or 10 * symbols > 3 * len(w) or (dup >= 4 and 2 * dup > len(lines)))


def test_run_against_plain_python(spark, tmp_path, monkeypatch):
    from tokenizers import Tokenizer
    import public_tokenizers
    from gearwatch.llm import packing
    r = random.Random(8)
    key = 'token="Xk29fLmQ81zz7RtB"'
    base, near, far = copies(r)
    other = prose(r, 90)
    rows = [(1, base), (2, near), (None, near), (3, prose(r, 4)), (4, "word " * 40), (5, f"{prose(r, 40)} {key} {prose(r, 20)}"),
            (5, prose(r, 60)), (None, f"{key} {prose(r, 50)}"), (None, prose(r, 70)), (None, None), (6, ""), (7, other), (7, other),
            (7, f"{other} more"), (8, "# * $ % & | < > " * 5), (9, "same line here\n" * 9), (10, prose(r, 300)), (11, far)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    stages, keep = {}, P.written

    def watched(df, name):
        out = keep(df, name)
        stages[name.removeprefix("pipeline-")] = [(x["doc_id"], x["text"]) for x in out.collect()]
        return out

    monkeypatch.setattr(P, "written", watched)
    packed = P.run(spark, str(tmp_path)).collect()
    same = lambda a, b: sorted(map(repr, a)) == sorted(map(repr, b))

    want = [x for x in rows if good(x[1])]
    assert len(want) < len(rows) and same(stages["quality-rules"], want)
    each = sorted(set(want), key=lambda x: (x[0] is None, x[0] or 0, hashlib.md5(x[1].encode()).hexdigest()))
    group = {x: x for x in each}
    for n, x in enumerate(each):
        for y in each[n + 1:]:
            if like(x[1], y[1]) >= 0.8 and group[x] != group[y]:
                lo, hi = sorted((group[x], group[y]), key=each.index)
                group = {z: lo if g == hi else g for z, g in group.items()}
    want = [x for x in each if group[x] == x]
    assert len(want) < len(each) and same(stages["near-dedup"], want)
    want = [(i, t.replace(key[:-1], "[SECRET]")) for i, t in want]
    assert same(stages["secret-scan"], want) and sum("[SECRET]" in t for _, t in want) == 2

    # one source: all documents once, and again those of the smallest hashes up to half of the words
    size = lambda x: len(WORD.findall(x[1]))
    digest = lambda x: hashlib.md5(f"{'' if x[0] is None else x[0]}\x1f{x[1]}".encode()).hexdigest()[:15]
    budget, below, twice = sum(map(size, want)) / 2, 0, []
    for x in sorted(want, key=digest):
        if below + size(x) >= budget:
            twice += [x] if below + size(x) - budget < budget - below else []
            break
        twice.append(x)
        below += size(x)
    mixed = want + twice
    assert same(stages["mixing"], mixed)
    encode = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    tokens, got = Counter(), Counter()
    for i, t in mixed:
        tokens[i] += len(encode.encode(t, add_special_tokens=False).ids) + 1
    for x in packed:
        got[x["doc_id"]] += x["length"]
    assert got == tokens
