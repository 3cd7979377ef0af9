"""Toxicity by a weighted lexicon: folded text, Aho-Corasick matches, exception phrases, a length-normalised score.

Texts are folded first (case, accents, look-alike letters, digit substitutions). The lexicon has a hand-written part and
a learned part: words and word beginnings that stand almost only in toxic training documents. Evidence for an entry is
counted in distinct neighbourhoods (the words next to it), over all training documents, so that a text copied a
thousand times counts once; it alone decides which entries are learned, whatever their number. The score is a logistic function of the matched weight, normalised by the text's length.

Nulls and edge cases: a null or empty text scores as one without a match. Labels that are null are not learned from; of
several labels of a document the largest counts. Without labels the hand-written part and default slopes are used.
Repeated rows get equal scores.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.llm.codepoints import fold
from loomframe.llm.common import batches_of, col, written
from loomframe.plans.runtime import settle

# Word beginnings of these lengths can become entries, beside whole words.
STEMS = (4, 5, 6, 7)
# A learned entry's share of toxic evidence must be above HALF with this many standard errors (Wilson bound).
ERRORS, HALF = 2.5, 0.5
# Words added to every text's length, so that one match in a few words does not decide.
SHORT = 60
# The heaviest weight of an entry (its weight is the logarithm of its rates' ratio).
HEAVIEST = 5.0
# Clean neighbourhoods are counted in a part of this size first: a lower bound, which rules most words out.
PART = 4
# Neighbourhoods that a task holds at once.
MOST = 50_000
# The score's slope and intercept where no labels say otherwise.
SLOPE, INTERCEPT = 1.5, -3.0
# General insults and their weights, and harmless phrases that contain one.
SEEDS = {w: 3.0 for w in ("idiot", "idiots", "moron", "morons", "imbecile", "loser", "losers", "scum", "scumbag", "pathetic", "worthless",
                          "stupid", "dumbass", "retard", "bastard", "bitch", "asshole", "fucker", "fucking", "motherfucker", "cunt", "whore",
                          "slut", "douchebag", "wanker")} | {w: 1.5 for w in ("disgusting", "trash", "clown", "garbage", "filth", "vermin", "shit")}
EXCEPTIONS = ("trash can", "trash bin", "trash collection", "class clown", "clown fish", "circus clown", "garbage collection", "garbage collector",
              "garbage truck", "not stupid", "not a loser", "not worthless", "sore loser")


@dataclass
class ToxicLexicon:
    """Entries (folded words with a space on both sides, or beginnings with a space before) and the score's slope."""

    entries: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    slope: float = SLOPE
    intercept: float = INTERCEPT
    _automaton: object = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            a = ahocorasick.Automaton()
            for e, w in self.entries.items():
                a.add_word(e, (len(e), w))
            for e in self.exceptions:
                e = fold(e)
                a.add_word(e, (len(e), 0.0))
            a.make_automaton()
            self._automaton = a
        return self._automaton

    def matches(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of the words with a match, by start; a word within an exception phrase is none.

        Of several entries in one word the heaviest counts.
        """
        words: dict[int, tuple[int, float]] = {}
        spared = []
        for last, (size, w) in self.automaton().iter(folded):
            start = last - size + 1
            if not w:
                spared.append((start, last + 1))
            elif start not in words or words[start][1] < w:
                words[start] = (last + 1, w)
        inside = lambda a: any(s <= a < e - 1 for s, e in spared)
        return [(a, e, w) for a, (e, w) in sorted(words.items()) if not (spared and inside(a))]

    def strength(self, text: str | None) -> float:
        return self.strength_of_folded(fold(text or ""))

    def strength_of_folded(self, folded: str) -> float:
        """Matched weight per hundred words, a short text counting as longer than it is."""
        return 100.0 * sum(w for _, _, w in self.matches(folded)) / (folded.count(" ") + SHORT)

    def score(self, strength: float) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * strength + self.intercept, -40, 40))))


def with_seeds() -> dict[str, float]:
    return {fold(w): v for w, v in SEEDS.items()}


def bounded_share_of(toxic: Column, clean: Column) -> Column:
    """Lower Wilson bound of the toxic share; it falls as clean evidence is added."""
    n, z = F.greatest(toxic + clean, F.lit(1)), ERRORS
    p = toxic / n
    return (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def forms_of(word: Column) -> Column:
    """The word between spaces and its beginnings after one; null for beginnings that are the whole word."""
    return F.array(F.concat(F.lit(" "), word, F.lit(" ")), *[F.when(F.length(word) > n, F.concat(F.lit(" "), F.substring(word, 1, n))) for n in STEMS])


def strongest(entries: dict[str, float], gain: dict[str, float]) -> dict[str, float]:
    """One entry of each chain of beginnings: the one with the highest gain, the shortest of equal ones."""
    kept: dict[str, float] = {}
    longer: set[str] = set()  # the beginnings of kept entries
    for e in sorted(entries, key=lambda e: (-gain[e], len(e), e)):
        stems = [e[:1 + n] for n in STEMS if n + 1 < len(e)]
        if e not in longer and not any(s in kept for s in stems):
            kept[e] = entries[e]
            longer.update(stems)
    return kept


SEEN = pa.schema([("word", pa.string()), ("toxic", pa.int32()), ("place", pa.int64())])
STRENGTHS = pa.schema([("strength", pa.int64()), ("toxic", pa.int32()), ("n", pa.int64())])
# Strengths are counted in steps of this size for the fit of the slope.
STEP = 0.02


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicLexicon:
    """Learn entries and the score's slope from all labelled documents given."""
    marks = labels.select(col(id_col).alias("id"), col(label_col).cast("int").alias("toxic")).filter("id IS NOT NULL AND toxic IS NOT NULL")
    marks = settle(marks.groupBy("id").agg(F.max("toxic").alias("toxic"))).hinted()
    texts = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))

    def folded(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([fold(t or "") for t in b.column(0).to_pylist()], pa.string())],
                                             names=["toxic", "folded"])

    known = written(texts.join(marks, "id").select("text", "toxic").mapInArrow(folded, "toxic int, folded string"))

    def neighbourhoods(part: int, among: frozenset[str] | None = None):
        """(word, toxic, place), mostly distinct: all toxic ones and that part of the clean ones, of the words given."""
        def flush(out):
            held = [(w, t, h) for w, left, right, t in out if among is None or w in among
                    if not (h := xxhash.xxh64_intdigest(f"{left}|{w}|{right}")) % part or t]
            yield from batches_of(SEEN, [[x[0] for x in held], [x[1] for x in held], [x[2] - (1 << 63) for x in held]])

        def places(batches):
            for b in batches:
                out = set()
                for toxic, text in zip(*b.columns):
                    ws = text.as_py().split()
                    for i in range(0, len(ws), MOST):  # of a long text too, a bounded number at a time
                        part_of = ws[i:i + MOST]
                        out.update(zip(part_of, [ws[i - 1] if i else "", *part_of], [*ws[i + 1:i + MOST + 1], ""], repeat(int(toxic.as_py() > 0))))
                        if len(out) > MOST:
                            yield from flush(out)
                            out = set()
                yield from flush(out)

        return known.mapInArrow(places, "word string, toxic int, place long")

    def evidence(seen):
        """Distinct neighbourhoods of each form of the words: toxic ones and clean ones."""
        counted = seen.distinct().groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
        counted = counted.select("word", F.explode(forms_of(F.col("word"))).alias("entry"), "toxic", "clean").filter("entry IS NOT NULL")
        return counted.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))

    sizes = known.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.sum(F.length("folded") - F.length(F.replace("folded", F.lit(" "))) + 1).alias("n"))
    sizes = {r["toxic"]: r["n"] for r in sizes.collect()}
    odds = np.log(max(1, sizes.get(False, 0)) / max(1, sizes.get(True, 0)))  # of clean to toxic words in all

    # all toxic neighbourhoods and a part of the clean ones: forms below the bound on these are below it on all
    some = evidence(neighbourhoods(PART))
    likely = settle(some.filter(bounded_share_of(F.col("toxic"), F.col("clean")) > HALF).select("entry"))

    entries = with_seeds()
    if not likely.df.isEmpty():
        # then all neighbourhoods of the words that have such a form
        words = known.select(F.explode(F.split("folded", " ")).alias("word")).distinct().select("word", F.explode(forms_of(F.col("word"))).alias("entry"))
        words = settle(words.join(likely.hinted(), "entry", "left_semi").select("word").distinct())
        if words.small:
            seen = neighbourhoods(1, frozenset(r["word"] for r in words.df.collect()))
        else:
            seen = neighbourhoods(1).join(words.df, "word", "left_semi")
        found = evidence(seen).join(likely.hinted(), "entry", "left_semi")
        found = found.filter(bounded_share_of(F.col("toxic"), F.col("clean")) > HALF).toPandas()
        toxic, clean = found["toxic"].to_numpy(float), found["clean"].to_numpy(float)
        ratio = np.log((toxic + 0.5) / (clean + 0.5)) + odds
        learned = {e: float(min(w, HEAVIEST)) for e, w in zip(found["entry"], ratio) if w > 0}
        entries |= strongest(learned, dict(zip(found["entry"], toxic * ratio)))
    lexicon = ToxicLexicon(entries)

    def strengths(batches):
        counts: dict[tuple[int, int], int] = {}
        for b in batches:
            for toxic, text in zip(*(c.to_pylist() for c in b.columns)):
                key = (round(lexicon.strength_of_folded(text) / STEP), int(toxic > 0))
                counts[key] = counts.get(key, 0) + 1
        if counts:
            yield from batches_of(STRENGTHS, [*zip(*counts), list(counts.values())])

    table = (known.mapInArrow(strengths, "strength long, toxic int, n long").groupBy("strength", "toxic").agg(F.sum("n").alias("n"))).toPandas()
    lexicon.slope, lexicon.intercept = fit_slope(table["strength"].to_numpy(float) * STEP, table["toxic"].to_numpy(float), table["n"].to_numpy(float))
    return lexicon


def fit_slope(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Logistic regression of the label on the strength, by Newton steps on counts; defaults if a class is missing."""
    if not (n * y).sum() or not (n * (1 - y)).sum():
        return SLOPE, INTERCEPT
    n = n / np.where(y > 0, (n * y).sum(), (n * (1 - y)).sum())  # both classes weigh the same
    a = np.stack([x, np.ones_like(x)], axis=1)
    beta = np.array([SLOPE, INTERCEPT])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -40, 40)))
        g = a.T @ (n * (p - y)) + ridge * np.array([beta[0] - SLOPE, beta[1] - INTERCEPT])
        h = (a * (n * p * (1 - p))[:, None]).T @ a + ridge * np.eye(2)
        step = np.linalg.solve(h, g)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def toxicity_of(lexicon: ToxicLexicon, text: Column) -> Column:
    """The score (0 to 1) of a text column."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([lexicon.score(lexicon.strength(t if isinstance(t, str) else "")) for t in texts], dtype="float64")

    return score(text)
