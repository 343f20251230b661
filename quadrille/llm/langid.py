"""Language identification by rank-order profiles.

A profile is the list of the most frequent character n-grams, in order of frequency. A document's own list is compared to
that of each language by the out-of-place distance: the sum over its n-grams of how far their ranks lie apart, and the length of
a profile where the language does not have them. The language at the least distance is chosen.

Letters are compared in lower case; everything else separates words, and the ends of words are part of n-grams.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, id_and_bytes, text_of, texts

TOP = 400
GRAMS = 3
UNKNOWN = "und"
# Characters counted at a time, as far as words end there, and n-grams a worker holds per language before it adds them up.
SPAN, HELD = 1_000_000, 250_000
SALTS = 32
#: The least score of a language is LEAST_SHARE of the score that all but LEAST_PART of its labelled texts reach; with fewer than LEAST_ROWS
#: of these, that of all languages together. Texts with fewer different n-grams than LEAST_GRAMS, two or three words, tell too little for it.
LEAST_SHARE, LEAST_PART, LEAST_ROWS, LEAST_GRAMS = 2 / 3, 0.1, 100, 40
BINS = 1000
_LETTER: list[np.ndarray] = []
_BREAK = re.compile(r"[\s0-9]")


def _is_letter() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def _added_up(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(grams, kind="stable")
    grams, counts = grams[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    return grams[first], np.add.reduceat(counts, first)


def _spans(text: str) -> list[str]:
    """The text in parts of ``SPAN`` characters and more, each up to a space or digit, which is in no word and in no context of one."""
    parts, start = [], 0
    while len(text) - start > SPAN:
        end = _BREAK.search(text, start + SPAN)
        if end is None:
            break
        parts.append(text[start:end.end()])
        start = end.end()
    return [*parts, text[start:]]


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-grams of 1 to ``GRAMS`` characters, 21 bits a character with 0 for the end of a word, and their counts."""
    if len(text) > SPAN:
        parts = [p for p in map(_counted, _spans(text)) if len(p[0])]
        return _added_up(*map(np.concatenate, zip(*parts))) if parts else _counted("")
    return _counted(text)


def _counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(_is_letter()[codes], codes, 0).astype(np.int64)
    codes = np.concatenate([[0], codes, [0]])
    codes = codes[(codes != 0) | np.concatenate([[True], codes[:-1] != 0])]
    if len(codes) < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b, c = codes, codes[1:], codes[2:]
    three = (a[:-2] << 42 | b[:-1] << 21 | c)[b[:-1] != 0]
    found = np.sort(np.concatenate([a[a != 0], a[:-1] << 21 | b | 1 << 20, three]))  # bit 20 is in no letter of one
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    return found[first], np.diff(np.concatenate([first, [len(found)]]))


def ranked(grams: np.ndarray, counts: np.ndarray, top: int = TOP) -> np.ndarray:
    """The most frequent n-grams, ties in the order of n-grams."""
    return grams[np.argsort(-counts, kind="stable")[:top]]


@dataclass(frozen=True)
class Profiles:
    languages: list[str]
    grams: np.ndarray  # sorted n-grams of all profiles
    ranks: np.ndarray  # language by n-gram, ``top`` where a profile lacks it
    top: int
    labelled: tuple[DataFrame, str, str] | None = field(default=None, compare=False, repr=False)  # what was learnt from: rows, text, language

    def closest(self, text: str) -> tuple[str, float]:
        """Language and score: 1 for the same list, 0 where no n-gram is shared; ``und`` and 0 without a letter or a profile."""
        return self.compared(text)[:2]

    def compared(self, text: str) -> tuple[str, float, int]:
        """Language, score, and how many n-grams of the text were compared."""
        own = ranked(*ngrams(text), self.top)
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0, 0
        at = np.searchsorted(self.grams, own)
        at[at == len(self.grams)] = 0
        known = self.grams[at] == own
        ranks = self.ranks[:, at[known]]  # a language that lacks an n-gram of another one is as far off as one can be
        apart = np.where(ranks == self.top, self.top, np.abs(ranks - np.flatnonzero(known))).sum(axis=1)
        distance = (apart + self.top * int((~known).sum())) / (self.top * len(own))
        best = int(np.argmin(distance))
        return self.languages[best], float(1 - distance[best]), len(own)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP) -> Profiles:
    """Profiles of all languages of ``docs`` from all its rows whose text and language are not null.

    n-grams are counted per partition and added up by a shuffle; ``top`` rows per language reach the driver, so the
    number of languages bounds it. Equal counts are ordered by n-gram, equal distances by language.
    """

    def count(batches):
        held: dict[str, list] = {}
        sizes: dict[str, int] = {}
        for langs, bodies in texts(batches):
            for name, body in zip(langs, bodies):
                found = ngrams(body.decode("utf-8", "replace"))
                if len(found[0]):
                    held.setdefault(name, []).append(found)
                    sizes[name] = sizes.get(name, 0) + len(found[0])
                    if sizes[name] > HELD:
                        held[name] = [_added_up(*map(np.concatenate, zip(*held[name])))]
                        sizes[name] = 0
        import pyarrow as pa

        for name, parts in held.items():
            grams, counts = _added_up(*map(np.concatenate, zip(*parts)))
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams)), pa.array(grams), pa.array(counts)], ["lang", "gram", "n"])

    known = docs.where(column(lang).isNotNull() & column(text).isNotNull())
    counted = id_and_bytes(known, lang, text).mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # The best of each share of a language first, so that no task sorts all n-grams of a language.
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("gram"), F.lit(SALTS))).orderBy(F.desc("n"), "gram")
    per = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = counted.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
    rows = best.withColumn("rank", F.row_number().over(per) - 1).where(F.col("rank") < top).select("lang", "gram", "rank").collect()
    languages = sorted({r["lang"] for r in rows})
    grams = np.array(sorted({r["gram"] for r in rows}), np.int64)
    ranks = np.full((len(languages), len(grams)), top, np.int64)
    number = {name: i for i, name in enumerate(languages)}
    for r in rows:
        ranks[number[r["lang"]], np.searchsorted(grams, r["gram"])] = r["rank"]
    return Profiles(languages, grams, ranks, top, (known, text, lang))


def language(profiles: Profiles, text: Column) -> Column:
    """A struct ``(lang, score)`` for each text; null, empty and letterless texts are ``und`` with score 0."""
    profiles = replace(profiles, labelled=None)

    @F.pandas_udf("lang string, score double")
    def closest(bodies: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([profiles.closest(t or "") for t in bodies], columns=["lang", "score"])

    return closest.asNondeterministic()(text)  # so that it is evaluated once a row


def held_out(id: Column) -> Column:
    """A fixed quarter of the ids, which no profile learns from; a null id counts as an empty text."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def identify(docs: DataFrame, profiles: Profiles, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` per row, repeated rows too; only the text decides. An empty table gives an empty result."""
    found = docs.select(column(id).alias("doc_id"), held_out(column(id)).alias("held_out"), language(profiles, text_of(text)).alias("_l"))
    return found.select("doc_id", "held_out", F.col("_l.lang").alias("lang_pred"), F.col("_l.score").alias("score"))


def least_scores(profiles: Profiles) -> dict[str, float]:
    """The least score of each language, from the scores of all rows that the profiles were learnt from.

    Rows count for the language they are closest to, if that is their label. Counts per language and thousandth of a score reach the driver.
    Without rows that are long enough nothing is known, and the least scores are 0.
    """
    if profiles.labelled is None or not profiles.languages:
        return dict.fromkeys(profiles.languages, 0.0)
    docs, text, lang = profiles.labelled
    bare = replace(profiles, labelled=None)

    @F.pandas_udf("lang string, bin int, grams int")
    def compared(bodies: pd.Series) -> pd.DataFrame:
        found = [bare.compared(t or "") for t in bodies]
        return pd.DataFrame([(name, int(score * BINS), grams) for name, score, grams in found], columns=["lang", "bin", "grams"])

    scored = docs.select(column(lang).alias("lang"), compared.asNondeterministic()(text_of(text)).alias("_c"))
    rows = scored.where((F.col("_c.lang") == F.col("lang")) & (F.col("_c.grams") >= LEAST_GRAMS)).groupBy("lang", F.col("_c.bin").alias("bin")).count().collect()
    counts = {name: np.zeros(BINS + 1, np.int64) for name in profiles.languages}
    for r in rows:
        counts[r["lang"]][r["bin"]] += r["count"]

    def least(seen: np.ndarray) -> float:
        return LEAST_SHARE * int(np.searchsorted(np.cumsum(seen), LEAST_PART * seen.sum(), "right")) / BINS if seen.any() else 0.0

    together = least(sum(counts.values()))
    return {name: least(seen) if seen.sum() >= LEAST_ROWS else together for name, seen in counts.items()}


def keep_identified(docs: DataFrame, profiles: Profiles, text: str = "text", least: float = 0.05) -> DataFrame:
    """``docs`` without rows whose language is undetermined, that share next to nothing with any profile (``least``), or that are further from
    the closest language than its own texts are (``least_scores``), as random letters and unknown languages are."""
    bounds = least_scores(profiles)
    bare = replace(profiles, labelled=None)

    @F.pandas_udf("boolean")
    def told(bodies: pd.Series) -> pd.Series:
        found = [bare.compared(t or "") for t in bodies]
        return pd.Series([n != UNKNOWN and score >= max(least, bounds[n] if grams >= LEAST_GRAMS else 0) for n, score, grams in found], dtype=bool)

    return docs.where(told.asNondeterministic()(text_of(text)))
