import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from millrace.llm import op13_line_index as x


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def brute(texts, least):
    counts = Counter(k for text in texts for k in {key(line) for line in (text or "").split("\n")} if k)
    found = []
    for text in texts:
        lines = (text or "").split("\n")
        kept = [line for line in lines if counts[key(line)] < least]
        found.append((len(lines), len(lines) - len(kept), None if text is None else "\n".join(kept)))
    return sorted(found, key=repr)


def sample(rng, count):
    lines = ["", " ", "Ä line", "ä line", "Licence", " LICENCE\t", "licence\r", "x" * 3000, *(f"line {i}" for i in range(60))]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randrange(12))) for _ in range(count)]
    return [*texts, None, "", None, "\n\n", *["same\nlines"] * 12]


@pytest.mark.parametrize("sent_bytes,part_bytes,shard_lines", [(1 << 26, 1 << 26, 1 << 17), (0, 1 << 26, 8), (0, 64, 4), (1 << 26, 1, 4)])
def test_against_brute_force(spark, docs_of, sent_bytes, part_bytes, shard_lines):
    texts = sample(random.Random(4), 150)
    docs = docs_of([(i % 140 if i % 9 else None, t) for i, t in enumerate(texts)]).repartition(5)
    rows = x.drop_repeated_lines(docs, 12, sent_bytes, part_bytes, shard_lines).collect()
    assert sorted(((r["n_lines"], r["n_dropped"], r["text"]) for r in rows), key=repr) == brute(texts, 12)


def test_more_than_a_byte_counts(spark, docs_of):
    docs = docs_of([(i, "often\n" + ("rare" if i < 299 else f"own {i}")) for i in range(400)])
    for sent in (1 << 26, 0):
        rows = x.drop_repeated_lines(docs, 300, sent).collect()
        assert all(r["n_dropped"] == 1 and r["text"] == ("rare" if r["doc_id"] < 299 else f"own {r['doc_id']}") for r in rows)


def test_perfect_hash():
    rng = np.random.default_rng(3)
    for size in (0, 1, 2, 100, 50_000):
        keys = rng.integers(0, 2**63, (size, 2)).astype(np.uint64)
        counts = rng.integers(1, 1000, size)
        shard = x.Shard.unpacked(*x.Shard.of(keys, counts, 255).packed())
        assert sorted(shard.find(keys).tolist()) == list(range(size))  # minimal and perfect
        assert shard.count(keys).tolist() == np.minimum(counts, 255).tolist()
        foreign = rng.integers(0, 2**63, (20_000, 2)).astype(np.uint64)
        assert (shard.count(foreign) > 0).mean() < 0.001
        if size > 1000:
            assert sum(map(len, shard.packed())) / size < 3.7  # bytes per line


def test_clashing_and_other_columns_and_nothing(spark):
    docs = spark.createDataFrame([(1, "a\nb", 5, None, [1.5]), (None, None, 6, 2, None)], "doc_id long, text string, N_lines int, `__x y` int, other array<double>")
    for sent in (1 << 26, 0):
        rows = {r["doc_id"]: r.asDict() for r in x.drop_repeated_lines(docs, 1, sent).collect()}
        assert rows[1] == {"doc_id": 1, "text": "", "__x y": None, "other": [1.5], "n_lines": 2, "n_dropped": 2}
        assert rows[None]["text"] is None and rows[None]["n_lines"] == 1 and rows[None]["__x y"] == 2
        assert x.drop_repeated_lines(docs.limit(0), 10, sent).collect() == []


def test_query_on_nothing(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert x.op13_line_index(spark, str(tmp_path)).collect() == []


def test_query_digest_of_an_empty_text(spark, tmp_path):
    spark.createDataFrame([(1, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    row = x.op13_line_index(spark, str(tmp_path)).first()
    assert (row["n_lines"], row["n_dropped"], row["kept_sha256"]) == (1, 0, hashlib.sha256(b"").hexdigest())
