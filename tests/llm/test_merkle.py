"""op11 against a plain Merkle tree."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from gearwatch.llm import merkle
from pyspark.sql import functions as F

from .small import documents, folder, run

BIG = 2**53 + 1


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    parts = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return digest("".join("-" if p is None else f"{len(p.encode())}:{p}" for p in parts))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][k:k + 16])) for k in range(0, len(out[-1]), 16)])
    return out


def steps(tree, at):
    for level in tree[:-1]:
        run_ = level[at // 16 * 16:at // 16 * 16 + 16]
        yield "".join(run_[:at % 16]), "".join(run_[at % 16 + 1:])
        at //= 16


def plain(rows):
    by = defaultdict(list)
    for doc_id, text, lang, source, n in rows:
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        low = text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        by[source].append((doc_id, leaf(doc_id, source, lang, n, text), leaf(doc_id, source, lang, n, low if hit else text)))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[s] = levels([r[1] for r in by[s]])
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for at, (doc_id, own, found) in enumerate(by[s]):
            path = [*steps(trees[s], at), *steps(top, k)]
            fold = found
            for left, right in path:
                fold = digest(left + fold + right)
            root = top[-1][0]
            out.append((doc_id, own, trees[s][-1][0], root, digest("".join(a + b for a, b in path)), fold, fold == root))
    return sorted(out, key=repr)


def made(n_hot=700):
    rnd = random.Random(4)
    rows = [(i, f"Text {i} Ä" * rnd.randint(1, 4), "en", "hot", ) for i in range(n_hot)]
    rows += [(10_000 + i, f"t{i}", None, f"s{i:02}") for i in range(17)]                       # seventeen sources of one row
    rows += [(BIG, "Upper CASE", "en", "é"), (BIG + 2, None, "en", None), (None, "No Id", None, None), (None, None, None, None),
             (5, "twice", "de", "a"), (5, "twice", "de", "a"), (5, "Other", "de", "a"), (6, "", "de", "a"), (-3, "Minus", "fr", "Z"),
             (77, "Long text " * 30_000, "en", "z")]
    return rows


@pytest.mark.parametrize("clash", [False, True])
def test_query_equals_a_plain_tree(spark, tmp_path, clash):
    docs = documents(made())
    path = folder(spark, tmp_path, clash, documents=docs)
    got = sorted((tuple(r) for r in run(spark, "op11_merkle_manifest", path).collect()), key=repr)
    assert got == plain(docs[0])
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


@pytest.mark.parametrize("n", [0, 1, 16, 17, 257])
def test_sizes_around_a_run(spark, tmp_path, n):
    docs = documents([(i, f"A{i}", "en", "one") for i in range(n)])
    got = sorted((tuple(r) for r in run(spark, "op11_merkle_manifest", folder(spark, tmp_path, documents=docs)).collect()), key=repr)
    assert got == plain(docs[0]) if n else got == []


def test_any_changed_field_breaks_the_proof(spark):
    rows, schema = documents([(i, f"text {i}", "en", f"s{i % 3}") for i in range(40)])
    docs = spark.createDataFrame(rows, schema)
    changed = {f: merkle.leaf(*[F.lit("other") if x == f else F.col(x) for x in merkle.FIELDS]) for f in merkle.FIELDS}
    found = merkle.manifest(docs, also=changed).cache()
    assert merkle.verified(found, F.col("leaf")).where("NOT verified").count() == 0
    for f in merkle.FIELDS:
        assert merkle.verified(found, F.col(f)).where("verified").count() == 0
