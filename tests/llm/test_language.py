import math
import random

from pyspark.sql import functions as F

from millrace.llm import op8_language as lang
from millrace.llm.base import id_hash

WORDS = {"aa": "kato mira solo", "bb": "thrun gwelk drost"}


def rows(n=60):
    return [(i, " ".join(WORDS[k].split()[(i + j) % 3] for j in range(9)), k, "s") for i in range(n) for k in WORDS]


def test_words_then_grams(docs_of):
    model = lang.learn(docs_of(rows()))
    assert model.languages == ["aa", "bb"]
    texts = [(1, "KATO mira"), (2, "thrunk gwelkish"), (3, "12 !?"), (4, None), (5, ""), (6, "жжж"), (7, "kato " * 50_000)]
    found = {r["doc_id"]: r for r in lang.identify(docs_of(texts), model).collect()}
    assert [found[i]["lang_pred"] for i in range(1, 8)] == ["aa", "bb", "und", "und", "und", "aa", "aa"]
    assert found[3]["score"] == 0 and found[6]["score"] == 0.5 and all(0 <= r["score"] <= 1 for r in found.values())


class Slow:
    """The same model with dictionaries, term by term."""

    def __init__(self, rows):
        self.counts, self.totals = {}, {}
        for _, text, lang_, *_ in rows:
            for word in lang.words_of(text):
                for size in range(6):
                    marked = f"<{word}>" if size > 1 else word
                    for term in [word] if not size else [marked[i : i + size] for i in range(len(marked) - size + 1)]:
                        own = self.counts.setdefault(lang_, {})
                        own[size, term] = own.get((size, term), 0) + 1
        self.languages = sorted(self.counts)
        for name, own in self.counts.items():
            for (size, _), n in own.items():
                self.totals[name, size] = self.totals.get((name, size), 0) + n + 0.5

    def evidence(self, word):
        for size in (0, 5, 4, 3, 2, 1):
            marked = f"<{word}>" if size > 1 else word
            terms = [word] if not size else [marked[i : i + size] for i in range(len(marked) - size + 1)]
            known = [t for t in terms if any((size, t) in own for own in self.counts.values())]
            if known:
                return [sum(math.log((self.counts[n].get((size, t), 0) + 0.5) / self.totals.get((n, size), 1)) for t in known) / len(known) for n in self.languages]
        return None

    def identify(self, text):
        words = lang.words_of(text or "")
        if not words:
            return "und", 0.0
        totals = [0.0] * len(self.languages)
        for found in map(self.evidence, words):
            totals = totals if found is None else [a + b for a, b in zip(totals, found, strict=True)]
        best = max(range(len(totals)), key=lambda i: (round(totals[i], 9), -i))
        return self.languages[best], 1 / sum(math.exp(t - totals[best]) for t in totals)


def test_against_dictionaries(docs_of, monkeypatch):
    rng = random.Random(3)
    letters = {"aa": "abcdeé", "bb": "defgß", "cc": "gh𝔘жa", "dd": "ab"}
    word = lambda name: "".join(rng.choice(letters[name]) for _ in range(rng.randrange(1, 9)))
    stock = {name: [word(name) for _ in range(30)] for name in letters}
    learned = [(i, " ".join(rng.choice(stock[name]) for _ in range(rng.randrange(1, 20))), name) for i, name in enumerate(list(letters) * 20)]
    slow = Slow(learned)
    texts = [" ".join(rng.choice(stock[name]) if rng.random() < 0.5 else word(name) for _ in range(rng.randrange(40))) for name in list(letters) * 15]
    texts += [None, "", "½ ² Ⅷ", "x½y", "zzz", "1 a1 _b_"]
    for remembered, at_once in ((1 << 20, 200_000), (40, 7)):
        monkeypatch.setattr(lang, "REMEMBERED", remembered)
        monkeypatch.setattr(lang, "AT_ONCE", at_once)
        model = lang.learn(docs_of(learned))
        found = sorted(lang.identify(docs_of(list(enumerate(texts))), model).collect())
        for row, text in zip(found, texts, strict=True):
            name, score = slow.identify(text)
            assert row["lang_pred"] == name and abs(row["score"] - score) < 1e-5, text


def test_a_letter_is_needed():
    assert lang.words_of("½ ² Ⅷ 12 _") == [] and lang.words_of("x² Ä1") == ["x²", "ä"]


def test_no_cap_on_terms_or_languages(spark):
    """30 000 words of one language and 1 200 languages: all terms are known, with their counts in all languages."""
    many = [(i, " ".join(f"w{chr(97 + i % 26)}{''.join(chr(97 + int(d)) for d in str(i * 300 + j))}" for j in range(300)), "aa") for i in range(100)]
    rows = many + [(1000 + i, f"sole{''.join(chr(97 + int(d)) for d in str(i))}", f"l{i:04d}") for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang.learn(df, sample_rows=10_000_000)
    assert len(model.languages) == 1201 and (model._find(lang.Spelling(sum((lang.words_of(t) for _, t, _ in many), [])).whole()) >= 0).all()
    found = lang.identify(df.where("doc_id >= 1000"), model).collect()
    assert all(r["lang_pred"] == r["lang"] for r in found)


def test_clashing_columns_give_way(spark):
    df = spark.createDataFrame([(1, "kato mira", "aa", "x", 5)], "doc_id long, text string, lang string, Lang_Pred string, score int")
    row = lang.learn_and_identify(df.withColumn("doc_id", F.lit(2).cast("long"))).first().asDict()
    assert row["lang_pred"] == "aa" and isinstance(row["score"], float) and "Lang_Pred" not in row


def test_nothing_to_learn_from(docs_of):
    for empty in (docs_of([]), docs_of([(1, None, "aa"), (2, "text", None)])):
        result = lang.learn_and_identify(empty).collect()
        assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in result)


def test_held_out_rows_of_the_table(spark):
    result = lang.op8_language(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang")
    held = result.join(docs, "doc_id").where("held_out").collect()
    assert held and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert result.count() == docs.count()
    assert result.where((id_hash(result["doc_id"], 5) == 0) != result["held_out"]).count() == 0
