import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import op12_merkle as m

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [*row[:4], text]
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tower(nodes):
    """Levels of a tree; the last holds the root alone."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def sides(levels, at):
    found = []
    for level in levels[:-1]:
        run = at // 16 * 16
        found.append(("".join(level[run:at]), "".join(level[at + 1 : run + 16])))
        at //= 16
    return found


def lowered(text):
    return text if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(row, row[4]), row))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    towers = {name: tower([item[2] for item in sorted(trees[name], key=lambda i: i[:3])]) for name in names}
    top = tower([towers[name][-1][0] for name in names])
    found = []
    for number, name in enumerate(names):
        for at, (_, _, own, row) in enumerate(sorted(trees[name], key=lambda i: i[:3])):
            path = sides(towers[name], at) + sides(top, number)
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            again = leaf(row, lowered(row[4])) if hit else own
            for before, after in path:
                again = H(before + again + after)
            found.append((row[0], own, towers[name][-1][0], top[-1][0], H("".join(b + a for b, a in path)), again, again == top[-1][0]))
    return sorted(found, key=repr)


def ours(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in m.op12_merkle(spark, str(tmp_path)).collect()), key=repr)


def test_against_definition(spark, tmp_path):
    rng = random.Random(8)
    sizes = {"a": 1, "b": 2, "B": 16, "é": 17, "": 255, "c": 257, None: 600}
    rows, number = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            number += rng.choice((1, 3, 9000))
            rows.append((number, source, rng.choice(("en", None, "")), rng.choice((None, 0, 77)), rng.choice((None, "", "lower", "Upper É", "x" * 200))))
    rng.shuffle(rows)
    assert ours(spark, rows, tmp_path) == brute(rows)


def test_three_levels_of_blocks(spark, tmp_path, monkeypatch):
    rows = [(i, "hot" if i % 3 else f"s{i % 600}", "en", i, f"Text {i}") for i in range(3000)]
    assert ours(spark, rows, tmp_path) == brute(rows)


def test_null_and_equal_ids_and_repeated_rows(spark, tmp_path):
    rows = [(None, "a", None, None, "A")] * 40 + [(3, "a", "en", 1, "B")] * 20 + [(3, "a", "en", 1, "C"), (None, None, None, None, None)]
    assert ours(spark, rows, tmp_path) == brute(rows)


def test_one_row_and_none(spark, tmp_path):
    rows = [(7, "s", "en", 2, "Hi")]
    assert ours(spark, rows, tmp_path / "one") == brute(rows)
    found = ours(spark, rows, tmp_path / "again")[0]
    assert found[1] == found[2] == found[3] and found[4] == H("")
    assert ours(spark, [], tmp_path / "none") == []


def test_any_change_shows(spark):
    docs = spark.createDataFrame([(i, "s", "en", i, f"t{i}") for i in range(40)], SCHEMA).withColumns({"leaf": F.lit(1), "path": F.lit("x"), "tree": F.lit(2)})
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    cases = {"same": m.leaf(*values), "id": m.leaf(F.col("doc_id") + 1, *values[1:]), "source": m.leaf(values[0], F.lit(None), *values[2:]), "none": F.lit(None).cast("string")}
    for name, changed in cases.items():
        rows = m.verify(m.prove(docs, {"changed": changed}), "changed").collect()
        assert {r["verified"] for r in rows} == {name in ("same", "none")}


def test_fields_do_not_run_together(spark):
    rows = spark.createDataFrame([(1, "ab", "c", 1, ""), (1, "a", "bc", 1, ""), (1, "a", "bc", 1, None)], SCHEMA)
    assert rows.select(m.leaf(*[F.col(c) for c in rows.columns]).alias("l")).distinct().count() == 3


@pytest.mark.parametrize("nodes", [1, 16, 17, 256, 300])
def test_siblings_fold_to_the_root(spark, nodes):
    docs = spark.createDataFrame([(i, None, None, None, str(i)) for i in range(nodes)], SCHEMA)
    rows = m.prove(docs).collect()
    assert len(rows) == nodes and len({r["root"] for r in rows}) == 1
    for r in rows:
        own = r["leaf"]
        for level in r["path"]:
            own = H(level["before"] + own + level["after"])
        assert own == r["root"]
