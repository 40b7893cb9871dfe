import hashlib
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from millrace.llm import op10_suffix_blocks as s


@pytest.mark.parametrize("order", [2, 3, 5, 7, 13])
def test_difference_cover(order):
    period, cover = s.difference_cover(order)
    assert len(cover) == order + 1
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def brute(rows, length=400):
    data = [(t or "").encode() for _, t, *_ in rows]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    for (doc_id, *_), d in zip(rows, data, strict=True):
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        yield doc_id, len(d), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()


def corpus(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdefghié ") for _ in range(n))
    shared = [text(n) for n in (350, 380, 400, 420, 700, 1500)]
    rows = []
    for doc_id in range(60):
        parts = [text(rng.randint(0, 600))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(shared), text(rng.randint(0, 300))]
        rows.append((doc_id, "".join(parts)))
    rows += [(100, rows[3][1]), (101, rows[3][1][:200]), (101, rows[3][1][:200]), (102, None), (103, ""), (104, "ab" * 600), (105, "x" * 401),
             (106, "y" * 400), (107, rows[5][1][1:]), (108, text(399) * 2), (109, text(401) * 2), (None, text(900))]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(docs_of, seed):
    rows = corpus(seed)
    found = s.remove_repeats(docs_of(rows)).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, brute(rows)))


def test_small_blocks_and_piles(docs_of, monkeypatch):
    monkeypatch.setattr(s, "BLOCK", 256)
    rows = corpus(3)[:30]
    names = [s.sample_names(s._bytes(t), 400) for _, t in rows]
    monkeypatch.undo()
    for (_, t), (own, places) in zip(rows, names, strict=True):
        whole = s.sample_names(s._bytes(t), 400)
        assert np.array_equal(np.sort(places), np.sort(whole[1])) and np.array_equal(own[np.argsort(places)], whole[0][np.argsort(whole[1])])


def test_empty_table(docs_of):
    assert s.remove_repeats(docs_of([])).count() == 0


def test_copies_of_a_passage_do_not_gather_in_a_bucket(docs_of, monkeypatch):
    rng = random.Random(6)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = text(600)
    rows = [(i, text(50) + passage + text(50)) for i in range(800)]
    whole, most = s._answer, 20_000

    def limited(*args):
        rank = whole(*args)

        def checked(group: pd.DataFrame) -> pd.DataFrame:
            assert sum(int(np.frombuffer(c, np.int32).sum()) for c in group["counts"]) < most
            return rank(group)

        return checked

    monkeypatch.setattr(s, "_answer", limited)
    found = s.remove_repeats(docs_of(rows).repartition(4)).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, brute(rows)))
