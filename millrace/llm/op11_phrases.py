"""Phrase collocations per language by best-first branch and bound."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.session import staged

from .base import query, table
from .bitmaps import bits_for, collected, holds, slots_of
from .hashing import BASE, BASE_INVERSE, BYTE_CODES, LOWER, mixed, powers

LONGEST = 4  # words of a phrase
LEAST = 30  # occurrences of a phrase
KEPT = 2000  # phrases of a language
SCALE = 2_000_000
COVERED = 80  # percent of its occurrences that a longer phrase may take
FRONTIER = 4  # the first frontier reaches down to the score of this many times KEPT pairs; each further one, four times as many
BLOCK = 1 << 20  # bytes cut into words at once
PILE = 1 << 21  # words a task counts at once

PIECE = np.zeros(256, bool)
PIECE[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
BETWEEN = PIECE.copy()
BETWEEN[[9, 32]] = True
_NO_WORDS = np.zeros(0, np.uint64)


def salt(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little"))


def _blocks(text: bytes) -> Iterator[bytes]:
    """The text in blocks that end where a piece ends; a piece longer than a block stays whole."""
    data, at = np.frombuffer(text, np.uint8), 0
    while at < len(text):
        end = min(len(text), at + BLOCK)
        while end < len(text):
            ends = np.flatnonzero(PIECE[data[at:end]])
            if len(ends):
                end = at + int(ends[-1]) + 1
                break
            end = min(len(text), end + BLOCK)
        yield text[at:end]
        at = end


def words_of(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per word: its hash, the number of its piece, its first byte and its end."""
    data = np.frombuffer(text, np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~BETWEEN[data]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return _NO_WORDS, starts, starts, ends
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODES[LOWER[data]] * powers(BASE, len(data)), out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * powers(BASE_INVERSE, len(data))[starts])
    return hashes, np.cumsum(PIECE[data], dtype=np.int32)[starts], starts, ends


def _by_language(batch: pd.DataFrame) -> Iterator[tuple[str, bytes]]:
    for lang, texts in batch.groupby("lang")["text"]:
        for block in _blocks(b"\n".join(text.encode("utf-8", "surrogatepass") for text in texts)):
            yield lang, block


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for lang, block in _by_language(batch):
            hashes, _, starts, ends = words_of(block)
            found, first, counts = np.unique(hashes, return_index=True, return_counts=True)
            words = [block[a:b].lower().decode("utf-8", "surrogatepass") for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
            yield pd.DataFrame({"lang": lang, "w1": found.view(np.int64), "word": words, "n": counts})


def _keys(own: np.uint64, words: list[np.ndarray]) -> np.ndarray:
    """One hash per phrase, given its words column by column."""
    total = mixed(words[0] ^ own)
    for column in words[1:]:
        total = mixed(total * np.uint64(BASE) + column)
    return total


def _distinct(words: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct phrase of ``size`` words starts first, and how often it starts; compared word by word, without hashing."""
    ids = np.zeros(len(at), np.int64)
    for step in range(size):
        known, own = np.unique(words[at + step], return_inverse=True)
        ids = ids * len(known) + own
        if 0 < step < size - 1:
            ids = np.unique(ids, return_inverse=True)[1]
    _, first, counts = np.unique(ids, return_index=True, return_counts=True)
    return at[first], counts


def _names(size: int) -> list[str]:
    return [f"w{i + 1}" for i in range(size)]


def _counted(texts: DataFrame, size: int, chosen: Callable) -> DataFrame:
    """(lang, w1 .., a): how often each phrase of ``size`` words occurs, among those that ``chosen`` lets pass.

    ``chosen(own, words)`` gives a flag for each place of a word sequence; it may
    let more pass than wanted, but none of the wanted stay out.  Tasks add up piles
    of ``PILE`` words; Spark adds up the piles, before and after the shuffle.
    """
    names = _names(size)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pile: dict[str, list] = {}
        held = 0

        def flushed() -> Iterator[pd.DataFrame]:
            for lang, parts in pile.items():
                words, pieces = (np.concatenate([p[i] for p in parts]) for i in range(2))
                if len(words) < size:
                    continue
                count = len(words) - size + 1
                at = np.flatnonzero((pieces[:count] == pieces[size - 1 :]) & chosen(salt(lang), words)[:count])
                starts, counts = _distinct(words, at, size)
                columns = {name: words[starts + i].view(np.int64) for i, name in enumerate(names)}
                yield pd.DataFrame({"lang": lang, **columns, "n": counts})

        for batch in batches:
            for lang, block in _by_language(batch):
                words, pieces, _, _ = words_of(block)
                own = pile.setdefault(lang, [])
                before = own[-1][2] if own else 0
                last = before + (int(pieces[-1]) + 1 if len(pieces) else 0)
                own.append((words, pieces.astype(np.int64) + before, last))
                held += len(words)
                if held > PILE:
                    yield from flushed()
                    pile, held = {}, 0
        yield from flushed()

    schema = "lang string, " + ", ".join(f"{name} long" for name in names) + ", n long"
    return texts.mapInPandas(run, schema).groupBy("lang", *names).agg(F.sum("n").alias("a"))


def _filter(phrases: DataFrame, size: int) -> Callable[[np.uint64, list[np.ndarray]], np.ndarray]:
    """A test, fit for tasks, that every phrase of the table passes and few others do: a bitmap of at most 16 MB."""
    names = _names(size)
    bits = bits_for(phrases.count())

    def slots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, rows in batch.groupby("lang"):
                yield pd.DataFrame({"slot": slots_of(_keys(salt(lang), [rows[n].to_numpy(np.int64).view(np.uint64) for n in names]), bits)})

    sent = phrases.sparkSession.sparkContext.broadcast(collected(phrases.select("lang", *names).mapInPandas(slots, "slot long"), bits))
    return lambda own, words: holds(sent.value, slots_of(_keys(own, words), bits))


def _windows(words: np.ndarray, size: int) -> list[np.ndarray]:
    count = max(0, len(words) - size + 1)
    return [words[i : i + count] for i in range(size)]


def _score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(SCALE * a / (l + r)) in exact arithmetic."""
    a, l, r = (c.cast("decimal(19,0)") for c in (a, l, r))  # noqa: E741
    return F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * a, l + r).cast("long")


def _with_score(phrases: DataFrame, cuts: list[tuple[str, str]]) -> DataFrame:
    """Add ``l``, ``r`` and ``score`` of the lowest-scoring cut, the earliest of equal ones, and ``bound``.

    A longer phrase that starts with this one occurs at most as often, its first
    word as often as here, and no part less often than the whole.  So cut after its first word it scores
    at most SCALE * a / (f(first word) + a), and its lowest cut no more than that.
    """
    a = F.col("a")
    made = [F.struct(_score(a, F.col(l), F.col(r)).alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"), F.col(r).alias("r")) for k, (l, r) in enumerate(cuts)]
    best = F.array_min(F.array(*made)) if len(made) > 1 else made[0]
    return phrases.withColumn("best", best).withColumn("bound", _score(a, F.col(cuts[0][0]), a)).select(
        "lang", *[c for c in phrases.columns if c in _names(LONGEST)], "a", "best.l", "best.r", "best.score", "bound")


def _look_up(phrases: DataFrame, counts: DataFrame, words: list[str], name: str, how: str = "inner") -> DataFrame:
    """Add the count of the part of each phrase that ``words`` name."""
    own = counts.select(F.col("lang").alias("__lang"), *[F.col(f"w{i + 1}").alias(f"__{i}") for i in range(len(words))], F.col("a").alias(name))
    on = F.col("lang") == F.col("__lang")
    for i, word in enumerate(words):
        on &= F.col(word) == F.col(f"__{i}")
    return phrases.join(own, on, how).drop("__lang", *[f"__{i}" for i in range(len(words))])


def _covered(longer: DataFrame, size: int) -> DataFrame:
    """For every phrase of ``size`` words the highest count of a phrase with one word more that contains it."""
    names = _names(size)
    sides = [longer.select("lang", *[F.col(f"w{i + 1 + at}").alias(name) for i, name in enumerate(names)], F.col("a").alias("over")) for at in (0, 1)]
    return sides[0].union(sides[1]).groupBy("lang", *names).agg(F.max("over").alias("over"))


def _survivors(phrases: DataFrame, longer: DataFrame | None, size: int) -> DataFrame:
    names = _names(size)
    if longer is not None:
        phrases = phrases.join(_covered(longer, size), ["lang", *names], "left").where(
            f"over IS NULL OR CAST(over AS DECIMAL(20,0)) * 100 < CAST(a AS DECIMAL(20,0)) * {COVERED}").drop("over")
    filled = [F.col(n) if n in names else F.lit(None).cast("long").alias(n) for n in _names(LONGEST)]
    return phrases.select("lang", *filled, "a", "l", "r", "score")


def _wave(texts: DataFrame, words: DataFrame, pairs: DataFrame, betas: DataFrame, least: int) -> DataFrame:
    """All surviving phrases that score ``beta`` of their language or more, exactly.

    The frontier is every phrase that scores so high or may be grown into one that
    does.  Only its phrases are grown to the right; those that score high enough themselves
    are also grown to the left, to see whether a longer phrase covers them.
    """
    texts = texts.join(betas.select("lang"), "lang", "left_semi")
    own = pairs.join(betas, "lang")
    open2, high2 = own.where("greatest(bound, score) >= beta").drop("beta"), own.where("score >= beta").drop("beta")
    frequent, grown, kept = _filter(own, 2), _filter(open2, 2), _filter(high2, 2)

    def triples(salted, w):
        pair = _windows(w, 2)
        known, left, right = (test(salted, pair) for test in (frequent, grown, kept))
        return known[:-1] & known[1:] & (left[:-1] | right[1:])

    found3 = _counted(texts, 3, triples).where(F.col("a") >= least)
    for part, counts, name in ((["w1"], words, "f1"), (["w3"], words, "f3"), (["w1", "w2"], pairs, "f12"), (["w2", "w3"], pairs, "f23")):
        found3 = _look_up(found3, counts, part, name)
    three = staged(_with_score(found3, [("f1", "f23"), ("f12", "f3")]), "phrases-3")
    own3 = three.join(betas, "lang")
    open3, high3 = own3.where("greatest(bound, score) >= beta").drop("beta"), own3.where("score >= beta").drop("beta")
    grown3, kept3 = _filter(open3, 3), _filter(high3, 3)

    def fours(salted, w):
        known, triple = frequent(salted, _windows(w, 2)), _windows(w, 3)
        return known[:-2] & known[1:-1] & known[2:] & (grown3(salted, triple)[:-1] | kept3(salted, triple)[1:])

    four = staged(_counted(texts, 4, fours).where(F.col("a") >= least), "phrases-4")
    # a phrase of four that scores beta starts with a phrase of the frontier; its lowest cut but one that is not counted yet
    grown4 = _look_up(four, open3, ["w1", "w2", "w3"], "f123")
    for part, counts, name in ((["w1"], words, "f1"), (["w4"], words, "f4"), (["w1", "w2"], pairs, "f12"), (["w3", "w4"], pairs, "f34")):
        grown4 = _look_up(grown4, counts, part, name)
    a = F.col("a")
    most = F.least(_score(a, F.col("f1"), a), _score(a, F.col("f12"), F.col("f34")), _score(a, F.col("f123"), F.col("f4")))
    grown4 = grown4.join(betas, "lang").where(most >= F.col("beta")).drop("beta")
    grown4 = staged(_look_up(grown4, three, ["w2", "w3", "w4"], "f234", "left"), "phrases-4-open")
    missing = grown4.where("f234 IS NULL").select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), F.col("w4").alias("w3")).distinct()
    if not missing.isEmpty():
        wanted = _filter(missing, 3)
        rest = _counted(texts, 3, lambda salted, w: wanted(salted, _windows(w, 3)))
        grown4 = _look_up(grown4, rest, ["w2", "w3", "w4"], "rest", "left").withColumn("f234", F.coalesce("f234", "rest")).drop("rest")
    scored4 = _with_score(grown4, [("f1", "f234"), ("f12", "f34"), ("f123", "f4")]).join(betas, "lang").where("score >= beta").drop("beta")
    return _survivors(high2, three, 2).union(_survivors(high3, four, 3)).union(_survivors(scored4, None, 4))


def _score_at(pairs: DataFrame, langs: DataFrame, place: int) -> DataFrame:
    """Per language the score of the pair at this place, best first; 0 if there are not so many."""
    counts = pairs.groupBy("lang", "score").agg(F.count("*").alias("c"))  # at most SCALE / 2 scores
    upto = F.sum("c").over(Window.partitionBy("lang").orderBy(F.desc("score")))
    cut = counts.withColumn("upto", upto).where(F.col("upto") >= place).groupBy("lang").agg(F.max("score").alias("beta"))
    return langs.join(cut, "lang", "left").select("lang", F.coalesce("beta", F.lit(0).cast("long")).alias("beta"))


def collocations(docs: DataFrame, kept: int = KEPT, least: int = LEAST, frontier: int = FRONTIER) -> DataFrame:
    """The best phrases of two to four words of each language: lang, rank, phrase, a, l, r, n, score.

    Reads (lang, text); a null language is ``und``, a null or empty text has no words.
    Words, in A-Z lower-cased, are what spaces and tabs separate within pieces
    between ``.,;:!?`` and line breaks.  ``a`` is how often a phrase occurs, ``n`` how
    many words its language has.  Of its cuts into a first part (occurring ``l`` times) and a rest (``r``) the
    lowest score floor(2000000 * a / (l + r)) counts.  Phrases below ``least`` are no candidates; a
    candidate goes if one that contains it occurs at least 0.8 times as often.  (If
    one does, then so does one with only one word more, which is all that is looked at.)
    The first ``kept`` per language stay; ties go by ``a``, then by the bytes of the phrase.

    Best first: the frontier of a wave holds what scores, or may grow into what scores,
    as much as a pair at some place in the order of its language.  Everything
    above that score is then known exactly, so a language with ``kept``
    survivors there is settled, ties included; the others go on with a wider frontier, down to score 0.

    Repeated rows count as often as they are there.  A language that holds most rows is spread like the
    others, as rows are counted by phrase.  An empty table gives no rows.
    """
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").where("text IS NOT NULL")
    all_words = staged(texts.mapInPandas(_count_words, "lang string, w1 long, word string, n long").groupBy("lang", "w1").agg(F.sum("n").alias("a"), F.min("word").alias("word")), "words")
    totals = all_words.groupBy("lang").agg(F.sum("a").alias("n"))
    words = all_words.where(F.col("a") >= least)
    common = _filter(words, 1)

    def both(salted, w):
        known = common(salted, [w])
        return known[:-1] & known[1:]

    pairs = _counted(texts, 2, both).where(F.col("a") >= least)
    pairs = _look_up(_look_up(pairs, words, ["w1"], "f1"), words, ["w2"], "f2")
    pairs = staged(_with_score(pairs, [("f1", "f2")]), "phrases-2")
    langs = staged(pairs.select("lang").distinct(), "languages")
    settled: list[DataFrame] = []
    place = frontier * kept
    while not langs.isEmpty():
        betas = staged(_score_at(pairs, langs, place), "scores")
        found = staged(_wave(texts, words, pairs, betas, least), "phrases")
        counts = betas.join(found.groupBy("lang").agg(F.count("*").alias("c")), "lang", "left")
        done = staged(counts.where((F.coalesce("c", F.lit(0)) >= kept) | (F.col("beta") == 0)).select("lang"), "settled")
        settled.append(found.join(done, "lang", "left_semi"))
        langs = staged(langs.join(done, "lang", "left_anti"), "languages")
        place *= 4
    if not settled:
        return docs.sparkSession.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    found = settled[0]
    for more in settled[1:]:
        found = found.union(more)
    for name in _names(LONGEST):
        own = words.select(F.col("lang").alias("__lang"), F.col("w1").alias("__w"), F.col("word").alias(f"{name}_word"))
        found = found.join(own, (F.col("lang") == F.col("__lang")) & (F.col(name) == F.col("__w")), "left").drop("__lang", "__w")
    found = found.withColumn("phrase", F.concat_ws(" ", *[f"{name}_word" for name in _names(LONGEST)])).join(totals, "lang")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return found.withColumn("rank", rank.cast("long")).where(F.col("rank") <= kept).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _oracle() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def words(first: int, last: int) -> str:
        return " || ' ' || ".join(f"w{i}" for i in range(first, last + 1))

    counts = " UNION ALL ".join(f"SELECT lang, {words(1, k)} AS phrase, {k} AS k, count(*) AS c FROM t WHERE w{k} IS NOT NULL GROUP BY ALL" for k in range(1, 5))
    longer = [f"SELECT lang, {words(at, at + size - 1)} AS phrase, c FROM cand WHERE k = {k}" for k in (3, 4) for size in range(2, k) for at in range(1, k - size + 2)]
    cuts = [f"SELECT lang, phrase, c AS a, {cut} AS cut, lang || ': ' || {words(1, cut)} AS head, lang || ': ' || {words(cut + 1, k)} AS rest FROM cand WHERE k = {k}" for k in (2, 3, 4) for cut in range(1, k)]
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{upper}', '{lower}') AS text FROM documents),
p AS (SELECT lang, r, unnest(list_transform(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]'), lambda piece, i: {{'i': i, 'piece': piece}})) AS x FROM d),
s AS (SELECT lang, r, x.i AS i, unnest(list_transform(list_filter(string_split_regex(x.piece, '[ \\t]'), lambda w: w <> ''), lambda w, j: {{'j': j, 'w': w}})) AS y FROM p),
t AS (SELECT lang, y.w AS w1, lead(y.w, 1) OVER o AS w2, lead(y.w, 2) OVER o AS w3, lead(y.w, 3) OVER o AS w4 FROM s WINDOW o AS (PARTITION BY r, i ORDER BY y.j)),
f AS ({counts}),
cand AS (SELECT lang, phrase, k, c, split_part(phrase, ' ', 1) AS w1, split_part(phrase, ' ', 2) AS w2, split_part(phrase, ' ', 3) AS w3, split_part(phrase, ' ', 4) AS w4 FROM f WHERE k >= 2 AND c >= 30),
longer AS (SELECT lang, phrase, max(c) AS c FROM ({' UNION ALL '.join(longer)}) GROUP BY ALL),
cuts AS ({' UNION ALL '.join(cuts)}),
scored AS (SELECT lang, phrase, a, cut, x.c AS l, y.c AS r, ((2000000::HUGEINT * a) // (x.c + y.c))::BIGINT AS score
    FROM cuts JOIN (SELECT lang || ': ' || phrase AS head, c FROM f) x USING (head) JOIN (SELECT lang || ': ' || phrase AS rest, c FROM f) y USING (rest)),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
kept AS (SELECT best.* FROM best LEFT JOIN longer USING (lang, phrase) WHERE longer.c IS NULL OR 100 * longer.c < 80 * a),
n AS (SELECT lang, count(*) AS n FROM t GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
"""


@query(_oracle())
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best collocations of every language."""
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))
