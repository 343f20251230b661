import hashlib
import random

from corpus_fixtures import SMALL, made, prose, prepared  # noqa: F401
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from quadrille.llm.bpe import EncodedText, Prefixes, TextBpe, read_ranks, spans
from quadrille.llm.queries import QUERIES
from quadrille.llm.tokens import VOCABULARY, answers, encode, encode_digests, length_histogram, token_counts

RANKS = read_ranks(public_tokenizers.path(VOCABULARY))
OURS = TextBpe(RANKS, public_tokenizers.PATTERN)
THEIRS = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
LETTERS = st.sampled_from(["a", "th", "ing", "é", "ß", " ", "  ", "\n", "1", "中", "😀", "'s", "<|endoftext|>", "\x85", "​", "\t", "…", "Ⅷ", "\xa0"])


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.lists(LETTERS, max_size=30).map("".join), st.text(max_size=40).filter(lambda t: not any("\ud800" <= c <= "\udfff" for c in t))))
def test_ids_are_those_of_the_public_library(text):
    ids = OURS.encode(text)
    assert ids == THEIRS.encode_ordinary(text)
    assert OURS.decode(ids) == text.encode()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from([b"th", b"e", b"ing", b"\xff", b" "]), min_size=1, max_size=12), st.integers(0, 10))
def test_prefixes_grow_and_shrink_exactly(parts, size):
    held = Prefixes(OURS.bpe)
    for part in parts:
        held.append(part)
    assert held.ids() == OURS.bpe.merge(held.data)
    assert held.cut(min(size, len(held.data))).append(b"er").ids() == OURS.bpe.merge(held.data)


def test_edits_encode_only_what_is_near(prose):
    text, rng = prose(2000, 1), random.Random(2)
    held = EncodedText(OURS, text)
    for _ in range(40):
        start = rng.randint(0, len(held.text))
        end, new = min(len(held.text), start + rng.randint(0, 20)), rng.choice(["", " ", "x", " new words", "\n\n", "s "])
        want = held.text[:start] + new + held.text[end:]
        assert held.replace(start, end, new).text == want
        assert held.ids() == THEIRS.encode_ordinary(want)
    assert held.append(" end").ids() == THEIRS.encode_ordinary(held.text)
    assert held.encoded < len(text) + 42 * 2000


def test_long_texts_are_split_where_pieces_end(prose):
    text = prose(3000, 5) + "\t \n" + "x" * 5000
    assert "".join(spans(text, 100)) == text
    assert [i for p in spans(text, 100) for i in THEIRS.encode_ordinary(p)] == THEIRS.encode_ordinary(text)


class Counted(dict):
    asked = 0

    def get(self, key, default=None):
        self.asked += 1
        return super().get(key, default)


def test_words_not_met_before_cost_few_look_ups():
    rng, parts = random.Random(3), ["th", "on", "tion", "ing", "é", "re", "ea", "nd", "ß", "zq", "aux", "中"]
    words = {"".join(rng.choices(parts, k=rng.randint(2, 9))) for _ in range(3000)}
    ranks = Counted(RANKS)
    ours = TextBpe(ranks, public_tokenizers.PATTERN)
    assert [ours.encode(w) for w in words] == [THEIRS.encode_ordinary(w) for w in words]
    assert ranks.asked < 3 * sum(len(w.encode()) for w in words)


@pytest.mark.parametrize("size", [1, 2, 63, 64, 65, 66, 500])
def test_short_and_long_pieces_meet(size):
    for word in ("a" * size, "tion" * (size // 4) + "x" * (size % 4), "é" * (size // 2) + "z" * (size % 2)):
        assert OURS.encode(word) == THEIRS.encode_ordinary(word)


def test_digests_of_whole_texts(spark, made):
    pairs = [(1, "some words"), (1, "some words"), (2, None), (3, ""), (None, "é  x"), (5, "ab " * 60_000)]
    rows = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encode_digests(made(pairs)).collect()}
    want = set()
    for i, t in pairs:
        ids = THEIRS.encode_ordinary(t or "")
        want.add((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert rows == want
    assert all(bytes(r.decoded) == (t or "").encode() for r, (_, t) in zip(encode(made(pairs[:4])).collect(), pairs))
    assert encode_digests(made(pairs).limit(0)).count() == 0


def test_given_documents_round_trip(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in encode_digests(docs).collect():
        ids = THEIRS.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_histogram_answers_totals_quantiles_and_limits(spark):
    rng = random.Random(1)
    sizes = [rng.choice([0, 1, 2, 5, 9000, rng.randint(0, 20_000)]) for _ in range(300)]
    table = length_histogram(spark.createDataFrame([(s,) for s in sizes] + [(None,)], "n_tokens long"), lengths=1000)
    for r in table.collect():
        over = [s for s in sizes if s >= r.n_tokens]
        assert (r.n_docs, r.docs_at_least, r.tokens_at_least) == (sizes.count(r.n_tokens), len(over), sum(over))
        assert r.truncated_tokens == sum(min(s, r.n_tokens) for s in sizes)
        assert r.share_at_most == pytest.approx(sum(s <= r.n_tokens for s in sizes) / len(sizes))
    asked = spark.createDataFrame([(x,) for x in (0, 3, 9000, 30_000, None)], "limit long")
    for r in answers(table, asked).collect():
        over = [s for s in sizes if s > r.limit]
        assert (r.docs_over, r.tokens_over, r.truncated_tokens) == (len(over), sum(over), sum(min(s, r.limit) for s in sizes))
    assert length_histogram(table.select("n_tokens").limit(0)).count() == 0


def test_counts(made):
    assert [r.n_tokens for r in token_counts(made([(1, "a b"), (2, None)])).collect()] == [2, 0]


def test_the_query_of_lengths_against_brute_force(spark):
    texts = [r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    sizes = [len(THEIRS.encode_ordinary(t)) for t in texts]
    found = {r.n_tokens: r for r in QUERIES["op1_token_counts"](spark, SMALL).collect()}
    assert sorted(found) == sorted(set(sizes))
    for n, r in found.items():
        over = [s for s in sizes if s >= n]
        assert (r.n_docs, r.docs_at_least, r.tokens_at_least, r.truncated_tokens) == (sizes.count(n), len(over), sum(over), sum(min(s, n) for s in sizes))


def test_limits_between_far_ranges(spark):
    sizes = [0, 3, 3, 17, 50, 51, 999]
    table = length_histogram(spark.createDataFrame([(s,) for s in sizes], "n_tokens long"), lengths=10)
    asked = [*range(0, 60), 500, 998, 999, 5000]
    got = {r.limit: r for r in answers(table, spark.createDataFrame([(x,) for x in asked], "limit long"), lengths=10).collect()}
    assert sorted(got) == asked
    for limit, r in got.items():
        over = [s for s in sizes if s > limit]
        assert (r.docs_over, r.tokens_over, r.truncated_tokens) == (len(over), sum(over), sum(min(s, limit) for s in sizes))
