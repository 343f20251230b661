from corpus_fixtures import SMALL, made, prepared  # noqa: F401
from pyspark.sql import functions as F

from quadrille.llm.langid import identify, keep_identified, learn, least_scores, ngrams, ranked
from quadrille.llm.queries import QUERIES


def brute(text, n=3):
    counts, word = {}, "".join(c if c.isalpha() else " " for c in text.lower())
    for w in word.split():
        for size in range(1, n + 1):
            padded = w if size == 1 else f"_{w}_"
            for i in range(len(padded) - size + 1):
                counts[padded[i:i + size]] = counts.get(padded[i:i + size], 0) + 1
    return counts


def test_ngrams_are_counted_with_word_ends():
    for text in ("", "12 !", "a", "The theatre, the", "é中 x"):
        grams, counts = ngrams(text)
        assert sorted(counts.tolist()) == sorted(brute(text).values())
        assert len(ranked(grams, counts, 3)) == min(3, len(brute(text)))


def test_held_out_accuracy(spark):
    lang = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op2_language_id"](spark, SMALL).join(lang, "doc_id")
    assert found.count() == lang.count()
    assert found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.95
    assert found.where("score < 0 OR score > 1").count() == 0


def test_only_text_decides_and_odd_rows_have_a_result(spark, made):
    docs = made([(1, "the an of the and"), (2, "der die das und ein")]).withColumn("lang", F.when(F.col("doc_id") == 1, "en").otherwise("de"))
    profiles = learn(docs)
    odd = made([(1, "das und"), (None, "the and"), (3, None), (4, ""), (5, "1 2 3"), (5, "1 2 3"), (6, "the and " * 200_000)], lang="de")
    rows = [(r.doc_id, r.lang_pred) for r in identify(odd, profiles).collect()]
    assert sorted(rows, key=repr) == sorted([(1, "de"), (None, "en"), (3, "und"), (4, "und"), (5, "und"), (5, "und"), (6, "en")], key=repr)
    kept = keep_identified(odd, profiles)
    assert kept.columns == odd.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 6]
    assert identify(odd.limit(0), profiles).count() == 0
    assert {r.lang_pred for r in identify(odd, learn(odd.limit(0))).collect()} == {"und"}


FINNISH = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto."


def test_gibberish_and_unlearnt_languages_go_and_short_texts_stay(spark):
    import base64
    import random

    rng = random.Random(1)
    given = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    junk = [" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(n)) for n in (10, 30, 200)]
    junk += [base64.b64encode(rng.randbytes(2250)).decode(), FINNISH]
    short = [" ".join(r.text.split()[:n]) for r in given.orderBy("doc_id").limit(20).collect() for n in (1, 2, 5, 10)]
    profiles = learn(given)
    assert all(0.3 < score < 0.6 for score in least_scores(profiles).values())
    planted = spark.createDataFrame([(-1 - k, t, None) for k, t in enumerate(junk)] + [(10**6 + k, t, "en") for k, t in enumerate(short)], given.schema)
    assert keep_identified(given, profiles).count() == given.count()
    assert {r.doc_id for r in keep_identified(planted, profiles).collect()} == {10**6 + k for k in range(len(short))}
    both = given.union(planted)  # also where they are among the rows that are learnt from, with a wrong label
    kept = keep_identified(both, learn(both.withColumn("lang", F.coalesce("lang", F.lit("en")))))
    assert kept.where("doc_id < 0").count() == 0 and kept.count() == given.count() + len(short)


def test_long_texts_are_cut_between_words(monkeypatch):
    from quadrille.llm import langid

    texts = ["Die längsten Wörter, the theatre's 12 words ΟΔΟΣ'Α ΟΔΟΣ " * 3, "x" * 50, "ab " * 30 + "abcdefghijklmnopqrstuvwxyz" * 2, "12345 67890 " * 9, "", "a-b-c-d-" * 20]
    monkeypatch.setattr(langid, "SPAN", 10**9)
    whole = [ngrams(t) for t in texts]
    for span in (1, 10, 37):
        monkeypatch.setattr(langid, "SPAN", span)
        for (g, n), (h, m) in zip(whole, map(ngrams, texts)):
            assert g.tolist() == h.tolist() and n.tolist() == m.tolist()


def test_the_query_against_brute_force(spark):
    """Profiles, ranks, distances and held-out rows, by dictionaries."""
    import zlib

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()

    def coded(gram):  # the order of equal counts: by code points, shorter n-grams among longer ones as the numbers of the n-grams are
        a = [0 if c == "_" else ord(c) for c in gram]
        return a[0] if len(a) == 1 else a[0] << 21 | a[1] | 1 << 20 if len(a) == 2 else a[0] << 42 | a[1] << 21 | a[2]

    def top(counts):
        return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], coded(x[0])))[:400]]

    learnt = {}
    for r in docs:
        if r.text is not None and r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            for g, n in brute(r.text).items():
                learnt.setdefault(r.lang, {}).setdefault(g, 0)
                learnt[r.lang][g] += n
    ranks = {name: {g: k for k, g in enumerate(top(counts))} for name, counts in learnt.items()}
    want = {}
    for r in docs:
        own = top(brute(r.text or ""))
        held = zlib.crc32(str(r.doc_id).encode()) % 4 == 2
        if not own:
            want[r.doc_id] = (held, "und", 0.0)
            continue
        apart = {name: sum(min(abs(rank[g] - k), 400) if g in rank else 400 for k, g in enumerate(own)) for name, rank in ranks.items()}
        best = min(sorted(apart), key=apart.get)
        want[r.doc_id] = (held, best, 1 - apart[best] / (400 * len(own)))
    found = QUERIES["op2_language_id"](spark, SMALL).collect()
    assert len(found) == len(docs)
    for r in found:
        held, name, score = want[r.doc_id]
        assert (r.held_out, r.lang_pred) == (held, name) and abs(r.score - score) < 1e-12
