"""op12 against a plain trie."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from .small import CONVERSATIONS, folder, run

BIG = 2**53 + 1


def plain(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(t, key=lambda y: y[:2])] for c, t in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    members, kids, below = defaultdict(list), defaultdict(list), {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    out = []
    for k in sorted(members, key=len, reverse=True):
        saved = (len(members[k]) - 1) * (len(k[-1][1]) if k else 0) + sum(below[x][0] for x in kids[k])
        leaves = sum(below[x][1] for x in kids[k]) or 1
        below[k] = saved, leaves
        ends = ",".join(map(str, sorted(c for c in members[k] if len(built[c]) == len(k))))
        out.append((min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]), len(kids[k]), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def made():
    """Families that part at every place of a block, copies, a long conversation, one that others are prefixes of."""
    rnd = random.Random(9)
    rows = []
    for c in range(260):
        base = [("user" if k % 2 else "system", f"common {k} é") for k in range(13)]
        cut = rnd.randint(0, 13)
        turns = base[:cut] + [("user", f"own {rnd.randint(0, 3)} {k}") for k in range(rnd.randint(0, 6))]
        rows += [(c, k, *t) for k, t in enumerate(turns or [("user", "only")])]
    rows += [(1000 + c, k, "user", "copy") for c in range(60) for k in range(9)]
    rows += [(2000, k, "user", f"long {k}") for k in range(900)] + [(2001, k, "user", f"long {k}") for k in range(899)]
    rows += [(BIG, 0, "user", "b"), (BIG, None, None, None), (BIG, 2, "", "x" * 50_000), (BIG + 2, 1, "user", ""),
             (None, 0, "user", "no conversation"), (3001, 5, "user", "later"), (3001, -4, "user", "earlier")]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("clash", [False, True])
def test_query_equals_a_plain_trie(spark, tmp_path, clash):
    rows = made()
    path = folder(spark, tmp_path, clash, conversations=(rows, CONVERSATIONS))
    got = sorted((tuple(r) for r in run(spark, "op12_prefix_trie", path).collect()), key=repr)
    assert got == plain(rows)


def test_only_turnless_conversations(spark, tmp_path):
    # conversations without a first of the family and with fewer turns than are cut off have none left
    rows = [(c, 0, "user", "x") for c in range(101, 140) if zlib.crc32(str(c).encode()) % 6]
    got = [tuple(r) for r in run(spark, "op12_prefix_trie", folder(spark, tmp_path, conversations=(rows, CONVERSATIONS))).collect()]
    assert got == plain(rows) and len(got) == 1


def test_equal_turns_have_a_defined_order(spark, tmp_path):
    rows = [(100, 1, "user", t) for t in ("a", "b", "a", None)] * 2
    path = folder(spark, tmp_path, conversations=(rows, CONVERSATIONS))
    first, second = (sorted(map(tuple, run(spark, "op12_prefix_trie", path).collect()), key=repr) for _ in range(2))
    assert first == second and len(first) == 9


def test_empty(spark, tmp_path):
    assert run(spark, "op12_prefix_trie", folder(spark, tmp_path, conversations=([], CONVERSATIONS))).collect() == []
