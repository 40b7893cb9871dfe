import hashlib
import random

import numpy as np

from millrace.llm import op1_winnowing as w


def gram_hashes(text, gram):
    """The hash of every gram, each taken from a text that is only that gram."""
    return [int(w.winnow(text[i : i + gram], gram, 1)[0][0]) for i in range(len(text) - gram + 1)]


def slow(text, gram, window):
    """Winnowing as defined, gram by gram."""
    hashes = gram_hashes(text, gram) if len(text) >= gram else None
    if hashes is None:
        return None
    found = []
    for at in range(max(1, len(hashes) - window + 1)):
        part = hashes[at : at + window]
        least = min(part)
        place = at + max(i for i, h in enumerate(part) if h == least)
        if not found or found[-1] != place:
            found.append(place)
    return found


def test_against_definition():
    random.seed(3)
    for size in (5, 7, 12, 30, 200):
        for letters in ("a", "ab", "abcdefgh"):
            text = "".join(random.choice(letters) for _ in range(size))
            expected = slow(text, 5, 4)
            hashes, places = w.winnow(text, 5, 4)
            assert places.tolist() == expected
            assert hashes.tolist() == [gram_hashes(text, 5)[p] for p in expected]


def test_short_and_empty():
    assert len(w.winnow(None)[0]) == len(w.winnow("")[0]) == 0
    assert len(w.winnow("abc")[0]) == 1
    assert w.likeness(*[w.winnow("")[0]] * 2) == 1.0


def test_blocks_change_nothing(monkeypatch):
    text = "".join(random.Random(1).choice("abcdé") for _ in range(5000))
    whole = w.winnow(text)
    monkeypatch.setattr(w, "BLOCK", 700)
    assert np.array_equal(w.winnow(text)[1], whole[1]) and np.array_equal(w.winnow(text)[0], whole[0])


def test_match_guarantee():
    rng = random.Random(5)
    common = "".join(rng.choice("abcdefghij ") for _ in range(w.GRAM + w.WINDOW - 1))
    left, right = ("".join(rng.choice("klmnop ") for _ in range(300)) + common + "x" * n for n in (40, 90))
    assert set(w.winnow(left)[0]) & set(w.winnow(right)[0])


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for at, (doc_id, text, *_) in enumerate(rows):
        own, following = text or "", rows[(at + 1) % len(rows)][1] or ""
        changed = own[: len(own) - len(own) // 3] + following[: len(own) // 3]
        mine = w.winnow(own)
        yield (doc_id, len(own), hashlib.sha256(changed.encode()).hexdigest(), w.written(*mine), w.written(*w.winnow(changed)),
               w.likeness(mine[0], w.winnow(changed)[0]), w.likeness(mine[0], w.winnow(following)[0]))


def test_neighbours(docs_of, monkeypatch):
    monkeypatch.setattr(w, "NEIGHBOURS", 3)
    rng = random.Random(2)
    ids = [1, 2, 3, 4, 5, 6, 900, 901, 905, 10**12, 10**12 + 1, None, -7]
    rows = [(i, "".join(rng.choice("abc é\n") for _ in range(rng.choice((0, 1, 50, 400))))) for i in ids]
    rows[3] = (rows[3][0], None)
    found = w.beside_next(docs_of(rows)).mapInPandas(w._compare, w.RESULT).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, found), key=key) == sorted(brute(rows), key=key)


def test_one_row_repeated_rows_and_empty_table(docs_of):
    run = lambda rows: w.beside_next(docs_of(rows)).mapInPandas(w._compare, w.RESULT).collect()
    assert run([]) == []
    assert [tuple(r) for r in run([(1, "abcdef" * 30)])] == list(brute([(1, "abcdef" * 30)]))
    assert len(run([(1, "same")] * 3 + [(1, "other")])) == 4


def test_operator_keeps_columns(docs_of):
    row = w.fingerprints(docs_of([(None, None, "x", "y"), (2, "z" * 100)])).orderBy("doc_id").first()
    assert (row["doc_id"], row["lang"], row["hashes"]) == (None, "x", [])
