import hashlib
import random


from corpus_fixtures import SMALL, made, prose, prepared  # noqa: F401
from quadrille.llm.queries import QUERIES
from quadrille.llm.substring_dedup import remove_repeats


def brute(pairs, size=50):
    words = [(i, (t or "").encode().split()) for i, t in pairs]
    first = {}
    for i, w in words:
        for p in range(len(w) - size + 1) if i is not None else ():
            key = tuple(w[p:p + size])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for p in range(len(w) - size + 1) if i is not None else ():
            if first[tuple(w[p:p + size])] < i:
                gone.update(range(p, p + size))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


def test_passages_copies_and_odd_rows(made, prose):
    rng, passage = random.Random(2), prose(70, 1)
    pairs = [(k, f"{prose(rng.randint(0, 90), k + 10)} {passage if k % 3 == 0 else ''}\t{prose(rng.randint(0, 90), k + 50)}") for k in range(30)]
    pairs += [(40 + k, prose(80, 7)) for k in range(4)] + [(50, " ".join(prose(80, 7).split()[:49])), (51, "same " * 200), (52, "same " * 120), (53, "x\xa0y " * 60)]
    pairs += [(None, passage), (60, None), (61, ""), (5, passage + " again"), (5, passage + " again"), (70, prose(30_000, 3)), (71, prose(30_000, 3) + " end")]
    rng.shuffle(pairs)
    found = remove_repeats(made(pairs)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in found), key=repr) == brute(pairs)
    assert remove_repeats(made(pairs).limit(0)).count() == 0


def test_short_windows(made):
    rng = random.Random(5)
    pairs = [(k, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 25)))) for k in range(40)]
    found = remove_repeats(made(pairs), window=4).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in found), key=repr) == brute(pairs, 4)


def test_given_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    rows = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op10_substring_dedup"](spark, SMALL).collect()]
    assert sorted(rows) == sorted((i, n, g, hashlib.sha256(k).hexdigest()) for i, n, g, k in brute(docs))
