"""A quality classifier from weak labels.

Simple labellers look at one property of a text each and vote good, bad or nothing. How far each can be trusted is not known, so
expectation-maximisation estimates for both classes how often each labeller votes what, from the counts of all vote patterns; the
posterior of a pattern is the label of its documents. On these labels a linear scorer over hashed word forms is trained,
which also scores documents where the labellers are silent.

Texts are read once: that pass writes the votes and the hashed counts of every document, from which the sample is taken and all documents
are scored. Patterns are counted over all documents; with eight labellers there are at most 6,561. The scorer is fitted on a sample of
``SAMPLE`` documents with ``SAMPLE_PLACES`` counts at most, chosen by a hash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut
from .common import id_and_bytes, mixed, texts

#: Documents of the sample, and counts of all of them together (12 bytes each), at most.
SAMPLE, SAMPLE_PLACES = 8_000, 8_000_000
BUCKETS = 1 << 16
ROUNDS, STEPS = 100, 300
#: Word forms remembered before a worker starts anew, and words that are looked up at a time.
FORMS, AT_A_TIME = 300_000, 1 << 16
PATTERNS = 3**8
#: Votes (bad, good) that each class is taken to have cast before: on a good text, hardly any is bad.
PRIOR = np.array([[1.0, 1.0], [0.05, 1.0]])

_USUAL = frozenset(".,;:!?'\"()-’“”«»…")
_ALPHA, _UPPER, _ALNUM, _DECIMAL, _MARK, _KNOWN = 1, 2, 4, 8, 16, 128
#: What is known of each character; those not met yet are zero.
_KINDS = np.zeros(0x110000, np.uint8)


def _kinds(codes: np.ndarray) -> np.ndarray:
    """Flags of characters by code point; each different character is asked once per worker."""
    kinds = _KINDS[codes]
    if not kinds.all():
        for code in np.unique(codes[kinds == 0]).tolist():
            c = chr(code)
            flags = _KNOWN | _ALPHA * c.isalpha() | _UPPER * c.isupper() | _ALNUM * c.isalnum() | _DECIMAL * c.isdecimal()
            _KINDS[code] = flags | _MARK * (not c.isalnum() and c not in _USUAL and c != "\n")
        kinds = _KINDS[codes]
    return kinds


def _forms(words: list[bytes]) -> np.ndarray:
    """A row per word: letters, capitals, unusual marks, characters, whether it has no letter or digit, whether it ends a sentence, two buckets.

    The first bucket is of the case and the last twelve signs of the shape, in which runs of letters and of digits are one sign each; the
    second is of the last four bytes. All words are described together, by tables of characters and sums over ranges.
    """
    joined = b"\n".join(words) + b"\n"
    codes = np.frombuffer(joined.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    kinds = _kinds(codes)
    ends = np.flatnonzero(codes == 10)
    starts = np.append(0, ends[:-1] + 1)

    def count(flag: int) -> np.ndarray:
        return np.add.reduceat(kinds & flag != 0, starts, dtype=np.int64)

    letters, upper, marks, bare = count(_ALPHA), count(_UPPER), count(_MARK), count(_ALNUM) == 0
    sentence = np.isin(codes[ends - 1], [ord(c) for c in ".!?"]) & ~bare
    digit, letter = kinds & _DECIMAL != 0, (kinds & _ALNUM != 0) & (kinds & _DECIMAL == 0)
    again = np.zeros(len(codes), bool)
    again[1:] = (letter[1:] & letter[:-1]) | (digit[1:] & digit[:-1])
    shown = ~again & (codes != 10)
    sizes = np.add.reduceat(shown, starts, dtype=np.int64)
    signs = np.where(letter, ord("a"), np.where(digit, ord("0"), codes))[shown].astype(np.uint64)
    upto = np.cumsum(sizes)
    behind = np.repeat(upto, sizes) - np.arange(len(signs)) - 1
    shape = np.add.reduceat(np.where(behind < 12, mixed(signs + (behind.astype(np.uint64) << np.uint64(32))), np.uint64(0)), upto - sizes)
    case = np.where((upper > 0) & (upper == letters) & (letters > 1), 2, np.where(upper > 0, 1, 0)).astype(np.uint64)
    raw = np.frombuffer(joined, np.uint8)
    last = np.flatnonzero(raw == 10)
    first = np.append(0, last[:-1] + 1)
    tail = np.zeros(len(words), np.uint64)
    for back in range(1, 5):
        at = last - back
        tail = (tail << np.uint64(8)) | np.where(at >= first, raw[np.maximum(at, 0)], 0).astype(np.uint64)
    one, two = (mixed(v) % np.uint64(BUCKETS) for v in (shape + case, tail + np.uint64(1 << 40)))
    return np.column_stack([letters, upper, marks, ends - starts, bare, sentence, one.astype(np.int64), two.astype(np.int64)]).astype(np.int32)


class _Forms(dict):
    """Numbers of word forms, and a matrix of what is known of each. New words are gathered and described together."""

    def __init__(self):
        super().__init__()
        self.table, self.fresh = np.zeros((0, 8), np.int32), []

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.fresh.append(word)
        return number

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
        """A row of the matrix per distinct form, how often each occurs, and how many words repeat the one before."""
        return self.look_up_all([words])[0]

    def look_up_all(self, bodies: list[list[bytes]]) -> list[tuple[np.ndarray, np.ndarray, int]]:
        """As :meth:`look_up` for several texts. More than ``FORMS`` are only held while the texts need them."""
        if len(self) > FORMS:
            self.clear()
            self.table = np.zeros((0, 8), np.int32)
        numbers = [np.fromiter(map(self.__getitem__, words), np.int64, len(words)) for words in bodies]
        if self.fresh:
            known = len(self) - len(self.fresh)
            if len(self) > len(self.table):
                grown = np.zeros((max(len(self), 2 * len(self.table)), 8), np.int32)
                grown[:known] = self.table[:known]
                self.table = grown
            for start in range(0, len(self.fresh), AT_A_TIME):
                some = self.fresh[start:start + AT_A_TIME]
                self.table[known + start:known + start + len(some)] = _forms(some)
            self.fresh = []
        return [self._summed(n) for n in numbers]

    def _summed(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        found, counts = np.unique(numbers, return_counts=True)
        return self.table[found], counts, int((numbers[1:] == numbers[:-1]).sum())


def _between(value: float, bad_below: float, good_from: float, good_to: float, bad_above: float) -> int:
    return 0 if value < bad_below or value > bad_above else 1 if good_from <= value <= good_to else 2


def votes(forms: np.ndarray, counts: np.ndarray, same: int) -> str:
    """One digit per labeller: 0 bad, 1 good, 2 silent."""
    words = int(counts.sum())
    letters, upper, marks, chars, bare, ends = (int((forms[:, c] * counts).sum()) for c in range(6))
    long, high = words >= 20, float("inf")
    found = [
        _between(marks / max(chars, 1), -1, 0, 0.01, 0.05),  # unusual marks
        _between(upper / max(letters, 1), -1, 0, 0.2, 0.4),  # capitals
        _between(len(counts) / max(words, 1), 0.25, 0.4, 1, high) if long else 2,  # different words
        _between(bare / max(words, 1), -1, 0, 0.02, 0.1),  # words without letters and digits
        _between(same / max(words, 1), -1, 0, 0.03, 0.1) if long else 2,  # words said twice running
        _between(letters / max(chars, 1), 0.75, 0.85, 1, high),  # share of letters
        _between(int(counts.max()) / max(words, 1), -1, 0, 0.15, 0.3) if long else 2,  # the commonest word
        _between(ends / max(words, 1), 0.004, 0.02, 0.35, 0.7) if long else 2,  # ends of sentences
    ]
    return "".join(map(str, found))


@dataclass(frozen=True)
class WeakLabels:
    """How often each labeller votes bad and good in either class (``accuracy[class][labeller][vote]``), the share of good documents, and the
    posterior of being good for every pattern seen. Silence says nothing about the class."""

    accuracy: np.ndarray
    good: float
    posterior: dict[str, float]


def estimate(patterns: dict[str, int], rounds: int = ROUNDS) -> WeakLabels:
    """Expectation-maximisation over counts of vote patterns; at the start a pattern is bad when any labeller says so."""
    names = sorted(patterns)
    if not names:
        return WeakLabels(np.empty((2, 0, 2)), 0.5, {})
    seen = np.array([[int(v) for v in p] for p in names])
    weight = np.array([patterns[p] for p in names], float)
    good = np.where((seen == 0).any(axis=1), 0.1, 0.9)
    said = np.stack([seen == v for v in range(2)], axis=2).astype(float)  # pattern, labeller, vote
    for _ in range(rounds):
        share = float((np.average(good, weights=weight) * weight.sum() + 1) / (weight.sum() + 2))
        accuracy = np.stack([np.einsum("p,plv->lv", weight * part, said) + prior for part, prior in zip((1 - good, good), PRIOR)])
        accuracy /= accuracy.sum(axis=2, keepdims=True)
        log = np.einsum("plv,clv->pc", said, np.log(accuracy)) + np.log([1 - share, share])
        new = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -700, 700)))
        if np.abs(new - good).max() < 1e-9:
            good = new
            break
        good = new
    return WeakLabels(accuracy, share, dict(zip(names, good.tolist())))


def features(forms: np.ndarray, counts: np.ndarray, same: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a document and how often each occurs; the last two are tenths of different words and of words said twice running."""
    words = counts.sum()
    repeats = np.array([BUCKETS + min(9, 10 * len(counts) // max(words, 1)), BUCKETS + 10 + min(9, 10 * same // max(words, 1))])
    found, at = np.unique(np.concatenate([forms[:, 6], forms[:, 7]]), return_inverse=True)
    amounts = np.bincount(at, np.concatenate([counts, counts])).astype(np.int64)
    return np.concatenate([found, repeats]).astype(np.int32), np.append(amounts, [1, 1])


def damped(places: np.ndarray, amounts: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Values of the buckets of documents: roots of counts, of length one per document; tenths have the value one."""
    word = places < BUCKETS
    length = np.sqrt(np.bincount(row, np.where(word, amounts, 0), rows))
    return np.where(word, np.sqrt(amounts) / np.maximum(length, 1e-9)[row], 1.0)


def fit(sizes: np.ndarray, places: np.ndarray, amounts: np.ndarray, labels: np.ndarray, steps: int = STEPS, penalty: float = 1e-4) -> np.ndarray:
    """Weights (the last one is the constant) of a logistic scorer for labels between 0 and 1, by adaptive gradient steps.

    Documents have ``sizes`` buckets each, which follow each other in ``places`` and ``amounts``.
    """
    weights, rows = np.zeros(BUCKETS + 21), len(sizes)
    if not rows:
        return weights
    row = np.repeat(np.arange(rows), sizes)
    value = damped(places, amounts, row, rows)
    rate = np.full(len(weights), 1e-8)
    for _ in range(steps):
        score = _logistic(np.bincount(row, weights[places] * value, rows) + weights[-1])
        apart = score - labels
        slope = np.bincount(places, apart[row] * value, len(weights)) / rows + penalty * weights
        slope[-1] += apart.mean()
        rate += slope**2
        weights -= 0.5 * slope / np.sqrt(rate)
    return weights


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _described(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``(doc_id, votes, places, amounts)`` per row: the only pass over the texts. Texts without words have neither votes nor counts."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([T.StructField("doc_id", docs.schema[id].dataType), T.StructField("votes", T.StringType()),
                           T.StructField("places", T.ArrayType(T.IntegerType())), T.StructField("amounts", T.ArrayType(T.LongType()))])
    arrow = to_arrow_schema(schema)

    def groups(bodies):
        """Words of texts, of about ``AT_A_TIME`` words or of one longer text."""
        held, size = [], 0
        for body in bodies:
            words = body.split()
            if held and size + len(words) > AT_A_TIME:
                yield held
                held, size = [], 0
            held.append(words)
            size += len(words)
        yield held

    def run(batches):
        forms = _Forms()
        for ids, bodies in texts(batches):
            # A batch per group of texts: the counts of all texts of a batch that was read are several times its size.
            done = 0
            for group in groups(bodies):
                said, places, amounts = [], [], []
                for words, found in zip(group, forms.look_up_all(group)):
                    said.append(votes(*found) if words else SILENT)
                    place, amount = features(*found) if words else (np.empty(0, np.int32), np.empty(0, np.int64))
                    places.append(place)
                    amounts.append(amount)
                offsets = pa.array(np.cumsum([0, *map(len, places)]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, kind), *found]))) for found, kind in ((places, np.int32), (amounts, np.int64))]
                columns = [pa.array(ids[done:done + len(group)], arrow.field(0).type), pa.array(said, pa.string()), *[c.cast(f.type) for c, f in zip(lists, list(arrow)[2:])]]
                done += len(group)
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return id_and_bytes(docs, id, text).mapInArrow(run, schema)


SILENT = "2" * 8


def _sampled(described: DataFrame, sample: int, most: int) -> list:
    """At most ``sample`` rows with votes, by the order of a hash, and as many of them as have ``most`` counts together."""
    rows = described.where(F.col("votes") != SILENT).withColumn("order", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "votes", "places"))
    sizes = [(r["order"], r["n"]) for r in rows.select("order", F.size("places").alias("n")).orderBy("order", "n").limit(sample).collect()]
    fits = int((np.cumsum([n for _, n in sizes]) <= most).sum()) if sizes else 0
    if not fits:
        return []
    return rows.where(F.col("order") <= sizes[fits - 1][0]).orderBy("order", F.size("places")).limit(fits).collect()


def classify(docs: DataFrame, id: str = "doc_id", text: str = "text", sample: int = SAMPLE, most: int = SAMPLE_PLACES) -> DataFrame:
    """``(doc_id, votes, weak_label, score, good)`` per row of ``docs``.

    ``weak_label`` is the posterior of being good, ``score`` that of the linear scorer, ``good`` whether it is 0.5 or more.
    Null texts and texts without words have no votes, label and score 0 and are not good; they are not learnt from.
    Repeated rows and null ids are rows like others. An empty table gives an empty result. At most ``sample`` documents with ``most`` counts
    of buckets together bring them to the driver.
    """
    import pyarrow as pa

    described = cut(_described(docs, id, text), "described")
    patterns = {r["votes"]: r["n"] for r in described.where(F.col("votes") != SILENT).groupBy("votes").agg(F.count(F.lit(1)).alias("n")).limit(PATTERNS).collect()}
    labels = estimate(patterns)
    rows = _sampled(described, sample, most)
    flat = [np.concatenate([np.array(r[c]) for r in rows]) if rows else np.empty(0) for c in ("places", "amounts")]
    weights = fit(np.array([len(r["places"]) for r in rows], int), *flat, np.array([labels.posterior[r["votes"]] for r in rows]))
    posterior = labels.posterior

    def scored(batches):
        for batch in batches:
            offsets, given = batch.column("places").offsets.to_numpy(), batch.column("votes").to_pylist()
            place, amount = (batch.column(c).flatten().to_numpy() for c in ("places", "amounts"))
            row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            score = _logistic(np.bincount(row, weights[place] * damped(place, amount, row, batch.num_rows), batch.num_rows) + weights[-1])
            score = np.where(np.diff(offsets) > 0, score, 0.0)
            label = [posterior.get(v, labels.good) if n else 0.0 for v, n in zip(given, np.diff(offsets).tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("votes"), pa.array(label, pa.float64()), pa.array(score)], ["doc_id", "votes", "weak_label", "score"])

    kind = described.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("votes", T.StringType()), T.StructField("weak_label", T.DoubleType()), T.StructField("score", T.DoubleType())])
    return described.mapInArrow(scored, schema).withColumn("good", F.col("score") >= 0.5)
