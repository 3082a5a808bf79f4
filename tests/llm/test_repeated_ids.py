"""Tables with several null ids and ids on several texts, against brute force."""

import hashlib
import random

import pytest

from gearwatch.llm import hyperminhash, line_dedup, mixing, suffix_dedup
from tests.llm.test_operators import prose
from tests.llm.test_pipeline import like, shingles

SCHEMA = "doc_id long, text string"


def order(row):
    i, text = row
    return i is None, i or 0, "" if text is None else hashlib.md5(text.encode()).hexdigest()


def rows():
    r = random.Random(3)
    word = lambda k: f"{prose(r, 1)}{k}"
    a, b, c, d = ([word(k) for k in range(120)] for _ in range(4))
    near = lambda w, k: " ".join([*w[:k], "changed", *w[k + 1:]])
    line = "all of this line stands in several texts"
    out = [(5, " ".join(a)), (None, near(a, 50)), (900, " ".join(b)), (None, near(b, 60)), (None, " ".join(c)), (None, near(c, 40)),
           (None, near(c, 80)), (None, f"{line}\nalone"), (None, f"{line}\nelsewhere"), (None, None), (None, ""), (7, " ".join(d)),
           (7, near(d, 30)), (7, near(b, 20)), (8, near(d, 90)), (3, f"{line}\nnumber three"), (3, f"other\n{line}"), (3, ""), (-4, "lone text")]
    return out + [out[0], out[4], out[11]]  # repeated rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(4)


def text_rows(found):
    return sorted(map(repr, found))


def test_near_duplicates_of_rows_that_share_ids(docs):
    each = sorted(set(rows()), key=order)
    root = {x: x for x in each}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, x in enumerate(each):
        for y in each[n + 1:]:
            if shingles(x[1]) and shingles(y[1]) and like(x[1], y[1]) >= 0.85:
                p, q = sorted((find(x), find(y)), key=order)
                root[q] = p
    got = hyperminhash.near_duplicates(docs).collect()
    assert text_rows(map(tuple, got)) == text_rows((x[0], len(shingles(x[1])), find(x)[0], find(x) == x) for x in rows())
    assert text_rows(map(tuple, hyperminhash.keep_one(docs).collect())) == text_rows(x for x in each if find(x) == x)


def test_lines_of_rows_that_share_ids(docs):
    seen, want = set(), {}
    for x in sorted(set(rows()), key=order):
        own = list(line_dedup.units(x[1] or "", ("line",), 1))
        gone = [(a, b) for a, b, digest in own if digest in seen]
        seen.update(digest for _, _, digest in own)
        want[x] = (x[0], len(own), gone)
    got = line_dedup.dedup_units(docs, kind="line", min_words=1).collect()
    assert text_rows((r["doc_id"], r["n_units"], [tuple(s) for s in r["removed"]]) for r in got) == text_rows(want[x] for x in rows())


def test_passages_of_rows_that_share_ids(docs):
    seen, want = set(), {}
    for x in sorted(set(rows()), key=order):
        b, gone = (x[1] or "").encode(), set()
        for k in range(len(b) - 99):
            if b[k:k + 100] in seen:
                gone.update(range(k, k + 100))
            seen.add(b[k:k + 100])
        want[x] = (x[0], len(b), bytes(c for k, c in enumerate(b) if k not in gone))
    got = suffix_dedup.remove_repeats(docs).collect()
    assert text_rows((r["doc_id"], r["n_bytes"], bytes(r["kept"])) for r in got) == text_rows(want[x] for x in rows())


def test_mix_takes_equal_rows_one_by_one(spark, tmp_path):
    text = "four words of text"
    odd = [(2**53 + 1, "lone row of words", "a"), (None, None, "a"), (None, None, "a"), (3, "", None)]
    table = [(1, text, "s")] * 20 + [(2, "two words", "s")] + [(1, text, "other")] * 3 + odd
    schema = "doc_id long, text string, source string, h long, src string, n long, first long, row string"
    docs = spark.createDataFrame([(*x, 7, "x", 7, 7, "x") for x in table], schema).repartition(3)
    got = mixing.mix(docs).collect()
    assert sorted((repr(r["doc_id"]), r["src"]) for r in got) == sorted((repr(i), f"1{s}" if s else "0") for i, _, s in table)
    assert len({(r["h"], r["src"], r["doc_id"]) for r in got}) == len(table)
    for src in {r["src"] for r in got}:
        own = [r for r in got if r["src"] == src]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 4 and all(r["taken"] <= 2 * r["size"] for r in own)
    again = mixing.mix(docs.repartition(5)).collect()
    assert text_rows(map(tuple, got)) == text_rows(map(tuple, again))
    rows = mixing.taken_rows(docs)
    assert rows.columns == docs.columns
    want = sum(([(r["doc_id"], r["src"][1:] or None)] * r["copies"] for r in got), [])
    assert text_rows((r["doc_id"], r["source"]) for r in rows.collect()) == text_rows(want)
    assert mixing.taken_rows(docs.limit(0)).count() == 0


def test_mix_of_equal_rows_equals_its_sql(spark, tmp_path):
    import duckdb
    from gearwatch.llm.oracle_sql import ORACLES
    from tests.llm.small import documents, folder, run
    r = random.Random(9)
    table = [(i, prose(r, r.randint(0, 30)), None, r.choice(["a", "b", None])) for i in range(40)]
    table += [table[k] for k in (0, 0, 0, 5, 7, 7)] + [(None, None, None, "a")] * 3
    path = folder(spark, tmp_path, documents=documents(table))
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{path}/documents.parquet/*.parquet'")
    want = duckdb.sql(ORACLES["op10_mix_sources"])
    got = run(spark, "op10_mix_sources", path).select(*want.columns).collect()
    assert text_rows(map(tuple, got)) == text_rows(want.fetchall())
