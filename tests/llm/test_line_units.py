"""Paragraphs and lines as units of op9, against brute force."""

import hashlib
import re

import pytest

from gearwatch.llm import line_dedup
from tests.llm.small import documents, folder, run

SCHEMA = "doc_id long, text string"
LONG = "this is a line of more than five words."
ROWS = [
    (1, f"All rights reserved.\n{LONG} Too short.\n\none\ntwo three"),
    (2, f"start\n  all  RIGHTS reserved.\nown words. {LONG} Too short."),
    (3, f"{LONG} Too short.\nToo short. But a line of its own"),
    (4, "one two\nthree\n\n \n\nall rights reserved.\nend\nend"),
    (5, f"other {LONG}\nElse. {LONG} Too short."),
    (6, None), (7, ""), (8, " \n\n \n"), (9, "\n".join(f"{LONG} {k % 40} {LONG}" for k in range(3000))),
]


def places(text, least):
    """(start, end, normal form) of all units of ``least`` words or more, by their words' positions."""
    found = {}
    for kind in ("line", "paragraph"):
        end = {"paragraph": r"\n\s*\n", "line": r"\n"}[kind]
        at = 0
        for a, b in [*((m.start(), m.end()) for m in re.finditer(end, text)), (len(text), len(text))]:
            words = text[at:a].lower().split()
            if words and len(words) >= least:
                lead = len(text[at:a]) - len(text[at:a].lstrip())
                found.setdefault((at + lead, at + len(text[at:a].rstrip())), (at, a, " ".join(words)))
            at = b
    return sorted(found.values(), key=lambda u: (u[0], -u[1]))


@pytest.mark.parametrize("least", [1, 4, line_dedup.MIN_WORDS])
def test_units_against_brute_force(spark, least):
    d = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    got = {r["doc_id"]: r for r in line_dedup.dedup_units(d, min_words=least).collect()}
    seen = set()
    for i, text in ROWS:
        want, own, at = [], places(text or "", least), 0
        for a, b, normal in own:
            if normal in seen and a >= at:
                want.append((a, b))
                at = b
            seen.add(normal)
        assert [tuple(x) for x in got[i]["removed"]] == want and got[i]["n_units"] == len(own)
        spans = iter(want)
        kept, at = [], 0
        for a, b in spans:
            kept.append(text[at:a])
            at = b
        assert got[i]["kept_text"] == (None if text is None else "".join(kept) + text[at:])
    removed = {i: [ROWS[i - 1][1][a:b] for a, b in got[i]["removed"]] for i in range(1, 6)}
    if least == 1:
        assert removed[2] == ["  all  RIGHTS reserved."] and removed[3] == [f"{LONG} Too short."]
        assert removed[4] == ["one two\nthree", "all rights reserved.", "end"]  # a paragraph with other line ends
    else:
        assert removed[2] == removed[4] == [] and (removed[3] == [f"{LONG} Too short."]) == (least == 4)


def test_query_keeps_short_lines_and_other_columns(spark, tmp_path):
    passage = " ".join(f"word{k}" for k in range(60))
    rows = [(2**53 + 1, f"a short line\n{passage}", None, None), (2**53 + 3, f"own\n{passage.upper()}\na short line", "en", "s"),
            (None, f"{passage} more\n{passage}", None, "s"), (1, None, None, None), (5, "", None, None)]
    path = folder(spark, tmp_path, clash=True, documents=documents(rows))
    got = {r["doc_id"]: r for r in run(spark, "op9_line_dedup", path).collect()}
    assert got[2**53 + 1]["removed_spans"] == got[1]["removed_spans"] == got[5]["removed_spans"] == ""
    assert got[2**53 + 3]["removed_spans"] == f"4:{4 + len(passage)}"
    assert got[None]["removed_spans"] == f"{len(passage) + 6}:{2 * len(passage) + 6}"
    for i, text, *_ in rows:
        cut = [int(x) for x in got[i]["removed_spans"].split(":") if x]
        kept = (text or "")[:cut[0]] + text[cut[1]:] if cut else text or ""
        assert got[i]["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
        assert got[i]["n_removed_units"] == bool(cut) and got[i]["n_removed_chars"] == len(text or "") - len(kept)


def test_passages_inside_lines(spark, tmp_path):
    def own(k):
        return " ".join(f"word{k}x{j}" for j in range(20))

    passage = " ".join(f"Sentence {k} of the passage has seven words." for k in range(8))
    rows = [(1, f"{own(1)}. {passage} {own(2)}.", None, None), (2, f"{own(3)}. {passage} {own(4)}.", None, None),
            (3, f"{own(5)}. Sentence 0 of the passage has seven words. {own(6)}.", None, None),
            (4, f"{own(7)}. {passage} {own(8)}. {passage}", None, None), (5, "No. " * 200, None, None), (6, None, None, None)]
    got = {r["doc_id"]: r for r in run(spark, "op9_line_dedup", folder(spark, tmp_path, documents=documents(rows))).collect()}

    def removed(i):
        spans = [tuple(map(int, s.split(":"))) for s in got[i]["removed_spans"].split(",") if s]
        return [rows[i - 1][1][a:b].strip() for a, b in spans]

    assert removed(1) == [] and removed(3) == []
    assert removed(2) == [passage] and removed(4) == [passage, passage]
    kept = rows[1][1].replace(passage, "")
    assert got[2]["n_removed_chars"] == len(passage) and got[2]["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
    assert got[5]["n_removed_chars"] < len("No. " * 200) - 80 and got[6]["n_units"] == 0
