from collections import Counter
from fractions import Fraction

import pytest

from millrace.llm import op4_pfair_mix as m


@pytest.mark.parametrize("parts", [{"a": 1}, {"a": 1, "b": 1}, {"a": 7, "b": 2, "c": 1}, {"a": 5, "b": 5, "c": 3, "d": 1}, {chr(97 + i): i + 1 for i in range(13)}])
def test_less_than_one_block_after_every_slot(parts):
    total, seen = sum(parts.values()), Counter()
    for slot, name in enumerate(m.cycle(parts), 1):
        seen[name] += 1
        for other, own in parts.items():
            assert abs(seen[other] - Fraction(slot * own, total)) < 1
    assert seen == parts


def brute(counts, parts, block):
    """Slot by slot: the blocks of each source in the order they are served, with the phase."""
    left = {k: -(-n // block) for k, n in counts.items() if n}
    served = Counter()
    phase = 0
    while left:
        order = m.cycle({k: parts[k] for k in left})
        at, ended = 0, False
        while not ended:
            name = order[at % len(order)]
            at += 1
            yield name, served[name], phase
            served[name] += 1
            left[name] -= 1
            ended = not left[name]
        left = {k: n for k, n in left.items() if n}
        phase += 1


def test_rows_against_simulation(docs_of):
    counts = {"=big": 401, "=mid": 90, "=one": 1, "": 33, "=even": 32}
    rows = [(n if n % 50 else None, "t", None, k[1:] if k else None) for k in counts for n in range(counts[k])]
    weights = {"big": 3, "mid": 4, "one": 1, None: 2}
    found = m.mix(docs_of(rows), weights, block=8).orderBy("position").collect()
    assert [r["position"] for r in found] == list(range(len(rows)))
    blocks = []
    for r in found:
        mark = ("" if r["source"] is None else "=" + r["source"], r["block"], r["phase"])
        if not blocks or blocks[-1] != mark:
            blocks.append(mark)
    parts = {"=big": 3, "=mid": 4, "=one": 1, "": 2, "=even": 1}
    assert blocks == list(brute(counts, parts, 8))
    assert Counter(r["source"] for r in found) == Counter(r[3] for r in rows)
    again = m.mix(docs_of(rows[::-1]).repartition(5), weights, block=8).orderBy("position").collect()
    assert [(r["doc_id"], r["source"]) for r in again] == [(r["doc_id"], r["source"]) for r in found]


def test_empty_table_and_clash(docs_of):
    """Columns with the names of the result give way, all others stay."""
    assert m.mix(docs_of([])).count() == 0
    docs = docs_of([(n, "t", f"l{n}", "s") for n in range(20)])
    found = m.mix(docs.withColumnsRenamed({"lang": "Slot", "text": "__row"})).collect()
    assert sorted(r["position"] for r in found) == list(range(20)) and all(r["__row"] == "t" and isinstance(r["slot"], int) for r in found)


def test_native_plan(spark):
    plan = m.op4_pfair_mix(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian"))
