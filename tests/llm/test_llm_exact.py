import hashlib
import random

from corpus_fixtures import made, prepared  # noqa: F401
from quadrille.llm.exact_dedup import drop_copies, exact_groups


def want(pairs):
    norm = [(i, "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or ""))) for i, t in pairs]
    out = []
    for i, t in norm:
        same = [j for j, u in norm if u == t]
        keep = max((j for j in same if j is not None), default=None)
        out.append((i, keep, len(same), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=repr)


def test_groups_of_texts_with_many_levels_of_blocks(made):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abAB é\n") for _ in range(rng.choice([0, 1, 3, 4, 7, 8, 9, 30]))) for _ in range(60)]
    texts += [texts[5].upper().replace("É", "é"), texts[7] + "a", "x" * 100, "x" * 99, "X" * 100, None, "", "É", "é", "😀" * 7, "😀" * 7]
    pairs = list(enumerate(texts * 2))
    found = exact_groups(made(pairs), block=3)
    assert got(found) == want(pairs)
    rows = found.collect()
    names = {}
    for r in rows:
        names.setdefault((r.block_level, r.block_name), set()).add(r.text_sha256)
    assert all(len(v) == 1 for v in names.values()) and len(names) == len({r.text_sha256 for r in rows})
    assert sum(r.kept for r in rows) == len(names)


def test_nulls_repeated_rows_and_empty_tables(made):
    pairs = [(None, "a"), (4, "A"), (4, "a"), (None, None), (None, ""), (7, None)]
    found = exact_groups(made(pairs))
    assert got(found) == want(pairs)
    assert sorted((r.keep_id or 0, r.kept) for r in found.collect()) == [(4, False), (4, False), (4, True), (7, False), (7, False), (7, True)]
    assert exact_groups(made(pairs).limit(0)).count() == 0


def test_dropping_copies_keeps_columns_and_one_row_each(made):
    docs = made([(1, "One"), (2, "one"), (3, "two"), (3, "two"), (None, "three"), (None, "three"), (5, "x" * 40_000), (6, "x" * 40_000)])
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, (r.text or "")[:5].lower()) for r in kept.collect()) == [(0, "three"), (2, "one"), (3, "two"), (6, "xxxxx")]
    assert drop_copies(docs.limit(0)).count() == 0


def test_columns_of_any_name_survive_the_dropping_of_copies(spark):
    docs = spark.createDataFrame([(1, "A", 5, 6, 7), (2, "a", 6, 7, 8), (3, "b", 7, 8, 9), (3, "b", 7, 8, 9)], "doc_id long, text string, _doc long, _ID long, i long")
    kept = drop_copies(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == [(2, "a", 6, 7, 8), (3, "b", 7, 8, 9)]
