import math
import random
import re

import pytest

from millrace.llm import op6_token_groups as g
from millrace.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = ["".join(c.lower() if c.isascii() else c for c in w) for w in WORD.findall(text or "")]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows, percent=80):
    sets = [shingle_set(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) and sets[i]:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, *_) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted((doc_id, len(sets[i]), least[root(i)]) for i, (doc_id, *_) in enumerate(rows))


def corpus(seed, families=12, size=14):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    common = [word() for _ in range(30)]
    rows, doc_id = [], 0
    for _ in range(families):
        base = [word() for _ in range(rng.choice((3, 6, 40, 150)))]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randint(0, 1 + len(own) // 25)):
                own[rng.randrange(len(own))] = word()
            if rng.random() < 0.3:
                own += common
            rows.append((doc_id, rng.choice((" ", "\n", "  ")).join(own)))
            doc_id += 1
    rows += [(doc_id, None), (doc_id + 1, ""), (doc_id + 2, " \t\n"), (doc_id + 3, "One TWO"), (doc_id + 4, "one two"), (doc_id + 5, "é É"), (doc_id + 6, "é é")]
    return rows


@pytest.mark.parametrize("group", [3, 256])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(docs_of, monkeypatch, group, seed):
    monkeypatch.setattr(g, "GROUP", group)
    rows = corpus(seed)
    found = sorted(map(tuple, g.near_duplicates(docs_of(rows)).collect()))
    assert found == brute(rows)


def test_repeated_rows_null_ids_and_empty_table(docs_of):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text), (5, text), (7, text), (5, "something else"), (None, text), (None, None)]
    found = g.near_duplicates(docs_of(rows)).collect()
    assert len(found) == 6 and all(r["component_id"] == 5 for r in found if r["n_shingles"] == 46)
    assert g.near_duplicates(docs_of([])).count() == 0
    # one row of the four with the same words stays, whatever its id
    assert sorted(r["doc_id"] or 0 for r in g.keep_first(docs_of(rows)).collect()) == [0, 5, 5]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 102), (102, 101), (7, 7), (200, 200)]
    found = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 104)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_rows_of_null_and_shared_ids(spark, docs_of):
    text = "one two three four five six seven eight nine ten"
    rows = [(5, text), (5, "other words entirely, five of them here"), (None, text.upper()), (None, text), (3, None), (3, ""), (5, text), (None, "alone but for itself and not like others")]
    kept = sorted(((r["doc_id"], r["text"]) for r in g.keep_first(docs_of(rows).withColumnRenamed("lang", "__row")).collect()), key=repr)
    assert kept == sorted([(5, text), (5, rows[1][1]), (3, None), (3, ""), (None, rows[7][1])], key=repr)


def test_least_shared_allows_every_link(spark):
    """Of two linked sets of any sizes, at least as many index tokens are shared as pairs of groups must share."""
    rng = random.Random(5)
    for size in (1, 2, 3, 4, 5, 9, 20, 63, 200):
        for _ in range(60):
            stock = rng.sample(range(10**6), 3 * size + 20)
            shared = stock[:size]
            left = shared + stock[size : size + rng.randint(0, size // 4)]
            right = shared + stock[2 * size : 2 * size + rng.randint(0, size // 4)]
            if 100 * size < 80 * len(set(left) | set(right)):
                continue
            prefix = lambda own: sorted(own)[: len(own) - -(-80 * len(own) // 100) + g.needed(len(own), 80)]
            met = len(set(prefix(left)) & set(prefix(right)))
            low = 80 / 180 * (len(left) + len(right)) - 0.8 * max(len(left), len(right))
            s = min(g.SHARED, -(-80 * min(len(left), len(right)) // 100))
            assert met >= max(s, s - 1 + math.ceil(low - 1e-6))
    sizes = spark.createDataFrame([(10, 10, 10, 10), (100, 100, 100, 100), (80, 80, 100, 100), (1, 500, 90, 90)], "g_low int, g_high int, h_low int, h_high int")
    assert [int(r[0]) for r in sizes.selectExpr(g._least_shared(80)).collect()] == [3, 11, 3, 1]
