import re
from itertools import permutations

from corpus_fixtures import SMALL, made, prose, prepared  # noqa: F401
from compare import connect, difference
from pyspark.sql import functions as F

from quadrille.llm.filter_audit import audit, failing_bits
from quadrille.llm.queries import QUERIES, SQL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, labels):
    """Every order walked document by document."""
    def bits(k, i, text):
        words = WORD.findall(text)
        fails = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
                 re.search(r"[#$%&*|]", text) is not None, i is not None and any(j is not None and j < i and t == text for j, t, _ in rows)]
        return {c for c, f in zip("ABCDE", fails) if f}

    rows = [(i, t or "", p or "") for i, t, p in rows]
    failed = [(i, p, bits(k, i, t)) for k, (i, t, p) in enumerate(rows)]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    found, shapley = {}, {}
    for part in {p for _, p, _ in failed}:
        mine = [(i, f) for i, p, f in failed if p == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                gone, left = [m for m in left if letter in m[1]], [m for m in left if letter not in m[1]]
                fails = sum(letter in f for _, f in mine)
                found[part, "".join(order), step] = (
                    len(left), len(gone), fails - len(gone), sum(f == {letter} for _, f in mine), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone))
                shapley[part, letter] = shapley.get((part, letter), 0) + len(gone)
    return sorted((p, o, s, *v, shapley[p, o[s - 1]]) for (p, o, s), v in found.items())


def odd(spark, prose):
    long = prose(260, 1)
    rows = [(k, prose(150 + 20 * k, k), "web" if k % 3 else "book") for k in range(8)]
    rows += [(20 + k, long, "web") for k in range(9)] + [(3, long, "book"), (20, long, "web"), (None, long, "web"), (None, None, None)]
    rows += [(40, None, "web"), (41, "", None), (42, "", ""), (43, "word " * 3000, "book"), (44, "A" * 9 + "é" * 300, "web"), (45, "x y #", "b")]
    rows += [(46, "\t \n\x0b\x0c\r", "web"), (47, long + " ", "web"), (50, "ONLY CAPS | " * 90, "b"), (50, "ONLY CAPS | " * 90, "b"), (50, "another", "b")]
    docs = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], "doc_id long, text string, source string, row string, bits int, hash int, part string")
    labels = [(k, k % 2, k % 3 % 2) for k in range(0, 50, 2)] + [(20, 0, 1), (20, 1, None), (None, 1, 1), (50, None, 1), (21, 1, 1)]
    return rows, docs, labels, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_query_equals_its_sql(spark):
    assert difference(QUERIES["op12_filter_audit"](spark, SMALL), connect(SMALL), SQL["op12_filter_audit"]) is None


def test_against_brute_force_with_odd_rows(spark, prose):
    rows, docs, labels, marks = odd(spark, prose)
    want = brute(rows, labels)
    assert sorted(map(tuple, audit(docs, marks).collect())) == want
    assert len(want) == 600 * 4
    assert audit(docs.limit(0), marks).count() == 0
    bare = audit(docs, marks.limit(0))
    assert bare.agg(F.sum("good_lost") + F.sum("toxic_lost")).first()[0] == 0 and bare.count() == 2400


def test_texts_decide_where_hashes_do_not(spark, prose):
    rows, docs, labels, marks = odd(spark, prose)
    want = brute(rows, labels)
    for digest in (lambda c: F.length(c).cast("long"), lambda c: F.lit(7).cast("long")):
        assert sorted(map(tuple, audit(docs, marks, digest=digest).collect())) == want


def test_other_filters(spark):
    docs = spark.createDataFrame([(1, "a b", "s"), (2, "a b", "s"), (3, "c", "s")], "id long, body string, source string")
    labels = spark.createDataFrame([(2, 1, 0)], "id long, quality int, toxic int")
    found = audit(docs, labels, "id", "body", failures={"X": lambda text, words: F.size(words) > 1}, repeated="R")
    assert {(r.filter_order, r.step): (r.kept, r.removed, r.good_lost) for r in found.collect()} == {
        ("XR", 1): (1, 2, 1), ("XR", 2): (1, 0, 0), ("RX", 1): (2, 1, 1), ("RX", 2): (1, 1, 0)}
    assert failing_bits(docs, "id", "body", failures={}).where("bits = 1").count() == 1
