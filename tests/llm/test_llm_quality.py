import math

from corpus_fixtures import SMALL, made, prose, prepared  # noqa: F401
import numpy as np
from pyspark.sql import functions as F

from quadrille import session
from quadrille.llm import quality
from quadrille.llm.quality import _described, _Forms, _forms, _sampled, classify, estimate, features, votes
from quadrille.llm.queries import QUERIES


def test_accuracies_are_recovered_from_votes_alone():
    import random

    rng, counts = random.Random(1), {}
    for _ in range(20_000):
        good = rng.random() < 0.7
        said = "".join("2" if rng.random() < 0.2 else str(int(good) if rng.random() < a else 1 - int(good)) for a in (0.9, 0.8, 0.95, 0.7))
        counts[said] = counts.get(said, 0) + 1
    found = estimate(counts)
    assert abs(found.good - 0.7) < 0.03
    for labeller, a in enumerate((0.9, 0.8, 0.95, 0.7)):
        assert abs(found.accuracy[1][labeller][1] - a) < 0.03 and abs(found.accuracy[0][labeller][0] - a) < 0.04
    assert estimate({}).posterior == {}


def test_votes_do_not_depend_on_how_forms_are_remembered(prose):
    words = (prose(500, 1) + " ### !! A1 " + "x " * 50).encode().split()
    one, other = _Forms(), _Forms()
    other.look_up(prose(300, 2).encode().split())
    assert votes(*one.look_up(words)) == votes(*other.look_up(words))


def test_votes_and_features_do_not_depend_on_how_many_forms_fit(prose, monkeypatch):
    for words in ("top a " * 200 + prose(300, 1), "w " * 90 + prose(30, 2) + " ### A1 A1", " ".join(f"w{k // 3}" for k in range(999))):
        words = words.encode().split()
        large = _Forms().look_up(words)
        for forms in (20, 64, 400):
            with monkeypatch.context() as patch:
                patch.setattr(quality, "FORMS", forms)
                small = _Forms().look_up(words)
            assert votes(*small) == votes(*large) and len(small[1]) == len(large[1]) and small[2] == large[2]
            assert all((a == b).all() for a, b in zip(features(*small), features(*large)))


def test_the_commonest_word_of_a_very_long_text_counts_as_a_whole():
    words = [b"top" if k % 5 < 2 else b"w%d" % k for k in range(1_000_000)]
    forms, counts, same = _Forms().look_up(words)
    assert (counts.max(), len(counts), same) == (400_000, 600_001, 200_000)
    assert votes(forms, counts, same)[6] == "0"


def test_accuracy_against_given_labels(spark):
    folder = SMALL.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = QUERIES["op7_quality_classifier"](spark, folder)
    met = found.join(labels, "doc_id")
    assert met.agg(F.avg((F.col("good") == (F.col("quality") == 1)).cast("int"))).first()[0] >= 0.95
    assert found.where("score < 0 OR score > 1").count() == 0


def test_odd_rows(made, prose):
    docs = made([(k, prose(60, k)) for k in range(30)] + [(50, "### $$$ %%% " * 30), (None, "A"), (51, None), (52, ""), (52, ""), (53, "word " * 200_000)])
    rows = {(r.doc_id, r.good) for r in classify(docs).collect()}
    assert {(51, False), (52, False), (50, False)} <= rows and (3, True) in rows
    assert classify(docs).count() == 36 and classify(docs.limit(0)).count() == 0


def _mix(v):
    mask = (1 << 64) - 1
    v = (v ^ v >> 30) * 0xBF58476D1CE4E5B9 & mask
    v = (v ^ v >> 27) * 0x94D049BB133111EB & mask
    return v ^ v >> 31


def _word(word):
    """What the labellers and the scorer see of one word, character by character."""
    text = word.decode("utf-8", "replace")
    letters, upper = sum(c.isalpha() for c in text), sum(c.isupper() for c in text)
    marks = sum(not c.isalnum() and c not in quality._USUAL for c in text)
    bare = not any(c.isalnum() for c in text)
    signs = []
    for c in text:
        kind = "0" if c.isdecimal() else "a" if c.isalnum() else c
        if not (signs and kind in "a0" and signs[-1][0] == kind and signs[-1][1]):
            signs.append((kind, c.isalnum()))
    shape = sum(_mix(ord(s) + (k << 32)) for k, (s, _) in enumerate(reversed(signs[-12:])))
    case = 2 if upper and upper == letters and letters > 1 else 1 if upper else 0
    tail = 0
    for k in range(1, 5):
        tail = tail << 8 | (word[-k] if k <= len(word) else 0)
    return letters, upper, marks, len(text), bare, text[-1] in ".!?" and not bare, _mix((shape + case) % 2**64) % 65536, _mix(tail + (1 << 40)) % 65536


def _vote(words):
    seen, n = [_word(w) for w in words], len(words)
    letters, upper, marks, chars, bare, ends = (sum(s[c] for s in seen) for c in range(6))
    most = max(words.count(w) for w in set(words))
    same = sum(a == b for a, b in zip(words, words[1:]))

    def judged(value, bad_below, good_from, good_to, bad_above):
        return "0" if value < bad_below or value > bad_above else "1" if good_from <= value <= good_to else "2"

    out = [judged(marks / max(chars, 1), -1, 0, 0.01, 0.05), judged(upper / max(letters, 1), -1, 0, 0.2, 0.4), "2", judged(bare / n, -1, 0, 0.02, 0.1), "2",
           judged(letters / max(chars, 1), 0.75, 0.85, 1, 9), "2", "2"]
    if n >= 20:
        out[2], out[4] = judged(len(set(words)) / n, 0.25, 0.4, 1, 9), judged(same / n, -1, 0, 0.03, 0.1)
        out[6], out[7] = judged(most / n, -1, 0, 0.15, 0.3), judged(ends / n, 0.004, 0.02, 0.35, 0.7)
    return "".join(out), seen, same


def test_the_whole_query_against_brute_force(spark):
    docs = {r.doc_id: (r.text or "").encode().split() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    docs = {i: words for i, words in docs.items()}
    seen = {i: _vote(words) for i, words in docs.items() if words}
    counts = {}
    for given, _, _ in seen.values():
        counts[given] = counts.get(given, 0) + 1
    # Expectation-maximisation, document patterns one by one.
    good = {p: 0.1 if "0" in p else 0.9 for p in counts}
    for _ in range(100):
        total = sum(counts.values())
        share = (sum(counts[p] * good[p] for p in counts) + 1) / (total + 2)
        said = {}
        for c in (0, 1):
            for k in range(8):
                cast = [quality.PRIOR[c][v] + sum(n * (good[p] if c else 1 - good[p]) for p, n in counts.items() if p[k] == str(v)) for v in (0, 1)]
                said[c, k] = [x / sum(cast) for x in cast]
        new = {}
        for p in counts:
            odds = [math.log(1 - share if c == 0 else share) + sum(math.log(said[c, k][int(v)]) for k, v in enumerate(p) if v != "2") for c in (0, 1)]
            new[p] = 1 / (1 + math.exp(odds[0] - odds[1]))
        moved = max(abs(new[p] - good[p]) for p in counts)
        good = new
        if moved < 1e-9:
            break
    # The scorer on dense rows.
    order = sorted(seen)
    matrix = np.zeros((len(order), 65536 + 21))
    for row, i in zip(matrix, order):
        words = docs[i]
        for s in seen[i][1]:
            row[s[6]] += 1
            row[s[7]] += 1
        row[:] = np.sqrt(row)
        row /= np.sqrt((row**2).sum())
        row[65536 + min(9, 10 * len(set(words)) // len(words))] = 1
        row[65546 + min(9, 10 * seen[i][2] // len(words))] = 1
        row[-1] = 1
    label = np.array([good[seen[i][0]] for i in order])
    used = np.flatnonzero(matrix.any(axis=0))
    dense, weights, rate = matrix[:, used], np.zeros(len(used)), np.full(len(used), 1e-8)
    for _ in range(300):
        slope = dense.T @ (1 / (1 + np.exp(-(dense @ weights))) - label) / len(order) + 1e-4 * weights
        rate += slope**2
        weights -= 0.5 * slope / np.sqrt(rate)
    score = dict(zip(order, 1 / (1 + np.exp(-(dense @ weights)))))
    assert len(docs) <= quality.SAMPLE
    found = QUERIES["op7_quality_classifier"](spark, SMALL).collect()
    assert len(found) == len(docs)
    for r in found:
        if r.doc_id in seen:
            assert r.votes == seen[r.doc_id][0]
            assert abs(r.weak_label - good[r.votes]) < 1e-5 and abs(r.score - score[r.doc_id]) < 1e-3 and r.good == (r.score >= 0.5)
        else:
            assert (r.votes, r.weak_label, r.score, r.good) == ("2" * 8, 0.0, 0.0, False)


def test_words_are_described_alike_together_and_alone():
    words = "the The THE A1 a1b2 ### ¿Qué? naïve x² ½ a.b.c. 12.5 日本語 ΣΑΣ é́ ''' ! \xad".encode().split() + [b"\xff\xfe", b"\xc3", b"a\xe2\x82", b"z" * 300]
    found = _forms(words)
    assert [tuple(r) for r in found.tolist()] == [tuple(map(int, _word(w))) for w in words]
    assert all((_forms([w])[0] == r).all() for w, r in zip(words, found))


def test_the_sample_is_bounded_in_rows_and_counts(made, prose):
    docs = made([(k, prose(200, k)) for k in range(40)] + [(None, prose(150, 99))] * 60)
    described = _described(docs, "doc_id", "text")
    for sample, most in ((10, 10**6), (100, 1000), (100, 10**6), (5, 3)):
        rows = _sampled(described, sample, most)
        assert len(rows) <= sample and sum(len(r["places"]) for r in rows) <= most
    assert len(_sampled(described, 100, 10**6)) == 100 and len(_sampled(described, 10, 10**6)) == 10
    assert classify(docs, sample=10).count() == 100


def test_counts_are_not_written_as_text_to_be_measured(made, prose, monkeypatch):
    def measured(schema):
        raise AssertionError("the size of the counts is not used")

    monkeypatch.setattr(session, "_bytes", measured)
    # Groups of texts, among them one longer than a group, and rows without words before, between and after.
    long = " ".join(f"w{i}" for i in range(quality.AT_A_TIME + 10))
    pairs = [(0, None), (1, prose(300, 1)), (2, long), (3, ""), (4, prose(300, 2)), (5, long), (6, " ")]
    rows = {r.doc_id: r for r in classify(made(pairs)).collect()}
    assert sorted(rows) == list(range(7))
    assert [rows[i].votes == quality.SILENT for i in range(7)] == [True, False, False, True, False, False, True]
    assert (rows[2].votes, rows[2].score) == (rows[5].votes, rows[5].score)
