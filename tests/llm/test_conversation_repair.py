"""Repaired conversations against a search over all edits of the whole conversation."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pyarrow.dataset as ds
import pytest

from skytally.llm import conversation_repair as repair
from skytally.llm import queries

SF001 = "/root/testdata/sf0.001"
KINDS = "conv_id long, turn long, role string, text string"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        mark = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(mark.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role = "user" if fault == 4 else role
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def cheapest(faults, roles):
    """Cost and least initials, by (what is left, state) from the end; states are what the initials so far end with."""
    after = {"": {"u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    n = len(roles)
    best = {}
    for i in range(n, -1, -1):
        here = {}
        for state in after:
            options = [(0, "")] if i == n and state in ("", "a") else []
            if i < n:
                cost, edits = best[i + 1, state]
                options.append((cost + 2, "D" + edits))
                extra = 5 if faults[i] == "truncated" else 0
                if faults[i] not in ("blank", "duplicate"):
                    keep = dict(after[state], **({"s": "s"} if state == "" else {}))
                    if roles[i][:1] in keep:
                        cost, edits = best[i + 1, keep[roles[i][:1]]]
                        options.append((cost + extra, "K" + edits))
                    for to in after[state].values():
                        cost, edits = best[i + 1, to]
                        options.append((cost + extra + 1, "R" + edits))
            here[state] = min(options, default=(10**9, ""))
        for _ in range(3):
            for state in after:
                for to in after[state].values():
                    cost, edits = here[to]
                    here[state] = min(here[state], (cost + 5, "I" + edits))
        best.update({(i, state): v for state, v in here.items()})
    return best[0, ""]


def search_all(rows, original=None):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row[1:])
    out = []
    for conv in {r[0] for r in (original or rows)}:
        def digest(r):
            return hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest()

        own = sorted(groups[conv], key=lambda r: (r[0] is not None, r[0] or 0, digest(r)))
        seen, faults = set(), []
        for _, role, text in own:
            bare = re.sub(r"[\x20\x09-\x0D]+$", "", text)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        roles = [r[1] for r in own]
        cost, audit = cheapest(faults, roles)
        left, rest = [], iter(own)
        for edit in audit:
            follows = "user" if not left or left[-1][:1] != "u" else "assistant"
            if edit == "I":
                left.append(f"{follows}:")
                continue
            _, role, text = next(rest)
            if edit != "D":
                left.append(f"{role if edit == 'K' else follows}:{text}")
        turns = {r[0] for r in own if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(x[:1] + y[:1] not in ("su", "ua", "au") for x, y in zip(roles, roles[1:], strict=False))
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest()))
    return sorted(map(str, out))


def answered(found):
    return sorted(str(tuple(r)) for r in found.collect())


def drawn(seed, conversations, rows):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "", " \t", "cut off", "What?", "so. ", "é.", "Fine.\n", "ok\x0b"] + [f"Text {i}." for i in range(30)]
    roles = ["user", "assistant"] * 6 + ["system", "tool", " ", "u", "Assistant"]
    return [(rng.randrange(conversations), rng.choice([None, *range(40)]), rng.choice(roles), rng.choice(texts)) for _ in range(rows)]


ODD = [
    (None, None, None, None), (None, 3, "user", "Hi."), (1, None, "system", "Be."), (1, None, "system", "Be."), (1, 9, "assistant", None),
    (2, 5, "", "x."), (3, 5, "user", "y" * 100_000), (3, 5, "user", "y" * 100_000 + "."), (4, -3, "assistant", " "), (4, 2**40, "user", "ok?"),
]


@pytest.fixture(scope="module")
def table(spark):
    def make(rows):
        return spark.createDataFrame(rows, KINDS).selectExpr("*", "1 as rank", "2 as conv", "3 as row", "4 as codes", "5 as head")

    return make


@pytest.mark.parametrize("chunk_rows", [2, 512])
def test_conversations_of_many_chunks(table, chunk_rows):
    rows = [(c, t, r or " ", x or " ") for c, t, r, x in ODD] + drawn(1, 9, 500) + [(77, *r[1:]) for r in drawn(2, 1, 250)]
    assert answered(repair.repair_conversations(table(rows), chunk_rows=chunk_rows, chunk_chars=200_000)) == search_all(rows)


def test_orders_that_stay_apart_for_long(table):
    """Speculative vectors are wrong over many chunks: nothing but blank rows, whose deletion keeps vectors as they are."""
    rows = [(1, i, "user", " ") for i in range(60)] + [(1, 60, "assistant", "So."), (2, 0, "user", "Go.")]
    rows += [(2, i, "tool", "") for i in range(1, 60)]
    assert answered(repair.repair_conversations(table(rows), chunk_rows=4)) == search_all(rows)


def test_fix_up_equals_a_run():
    rng = random.Random(5)
    for _ in range(300):
        codes = bytes(rng.choices([0, 1, 3, 4, 5, 6, 7, 8, 9], k=rng.randrange(30)))
        right = repair.levelled(repair._with_inserts([rng.randrange(8) for _ in range(4)]))
        old = repair.run_back(codes, repair.SPECULATED)
        assert repair.fix_up(codes, repair.SPECULATED, old, right) == repair.run_back(codes, right)


def test_damage(table):
    rows = ODD + [(c, t, "assistant", f"One. Two! {c}?") for c in range(30) for t in range(8)]
    assert sorted(map(str, map(tuple, repair.damage(table(rows)).collect()))) == sorted(map(str, damaged(rows)))
    assert answered(repair.repair_damaged(table(rows))) == search_all(damaged(rows), rows)


def test_empty_table(table):
    assert answered(repair.repair_damaged(table([]))) == []


def test_registered_query(spark):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in ds.dataset(f"{SF001}/conversations.parquet").to_table().to_pylist()]
    assert answered(queries.op11_conversation_repair(spark, SF001)) == search_all(damaged(rows), rows)
