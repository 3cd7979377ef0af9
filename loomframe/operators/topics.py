"""Topics of documents over a vocabulary that stays a table.

Expectation maximization with smoothed counts. Tasks over texts pack them into blocks: a block is one row with its words once and the
rest as numbers, and no text is shuffled. The vocabulary is dealt to parts by a hash; a part holds its words' topic counts as one
matrix, and knows where the words of each block stand in it. A step sends every block the rows that it needs, as one value per block
and part, and gets one value of summed counts back. Neither the vocabulary nor the topics pass the driver; it holds a total per topic.
What a step leaves is deleted once the next one has read it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomframe.operators.text import SPACE
from loomframe.plans.runtime import CELL_ROWS, discard, limit_of, settle, stored, stored_in

KEY = "_topic_key"
WORDS_PER_ROW = 8  # words in a block for each of cellRows
BLOCK_NUMBERS = 32_000_000  # words of a block times topics
CHUNK_NUMBERS = 2_500_000  # shares that a task holds at once
TEXTS = 1_000  # texts split at once
TOPICS, THETA, COUNTS, LIKELIHOOD = 0, 1, 2, 3  # what a value of a step holds
BLOCKS = "block long, keys array<binary>, copies array<int>, words array<string>, pairs long, packed binary"
NAMED = "part int, block long, words array<string>, df array<long>, total array<long>"
PLACES = "part int, block long, n int, places binary"
STATE = "part int, v binary, told array<double>"
STEP = "kind int, block long, part int, v binary, told array<double>"
FOUND = "_topic_key binary, v array<double>, log_likelihood double"


def _key(text: str):
    return F.unhex(F.sha2(F.col(text).cast("binary"), 256)).alias(KEY)


def _table(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.Table:
    return pa.table({name: pa.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate(schema)})


_VALUES = [("kind", pa.int32()), ("block", pa.int64()), ("part", pa.int32()), ("v", pa.binary()), ("told", pa.list_(pa.float64()))]


def _matrix(data: bytes | None, k: int) -> np.ndarray:
    return np.frombuffer(data or b"", float).reshape(-1, k)


def _compressed(numbers: np.ndarray) -> bytes:
    return pa.compress(numbers.astype("<i4").tobytes(), "zstd", asbytes=True)


def _numbers(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, 4 * n, "zstd", asbytes=True), "<i4")


def _part_of(word: bytes, parts: int) -> int:
    return zlib.crc32(word) * parts >> 32


def _dealt(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list[bytes], np.ndarray, pa.ChunkedArray]]:
    """The keys of consecutive texts, how many words each has, and these words; about `most` words at once, or one text."""
    held, size = [], 0

    def whole():
        return [k for h in held for k in h[0]], np.concatenate([h[1] for h in held]), pa.chunked_array([h[2] for h in held], pa.string())

    for batch in batches:
        for i in range(0, batch.num_rows, TEXTS):
            texts = batch.column(0).slice(i, TEXTS)
            lists = pc.split_pattern_regex(texts, SPACE)
            flat = lists.flatten()
            real = pc.not_equal(flat, "")
            row = np.repeat(np.arange(len(texts)), lists.value_lengths().to_numpy(zero_copy_only=False))
            n = np.bincount(row[real.to_numpy(zero_copy_only=False)], minlength=len(texts))
            flat, ends = flat.filter(real), np.cumsum(n)
            keys = [hashlib.sha256(t).digest() for t in texts.cast(pa.binary()).to_pylist()]
            start = 0
            while start < len(n):
                before = int(ends[start - 1]) if start else 0
                end = max(start + 1, int(np.searchsorted(ends, before + most - size, "right")))
                words = int(ends[end - 1]) - before
                held.append((keys[start:end], n[start:end], flat.slice(before, words)))
                size, start = size + words, end
                if size >= most or start < len(n):
                    yield whole()
                    held, size = [], 0
    if held:
        yield whole()


def _pack(keys: list[bytes], n: np.ndarray, words: pa.ChunkedArray) -> tuple | None:
    """(keys, copies, words, pairs, packed): equal texts are one, words are in the order of their hashes, texts without a word go."""
    first: dict[bytes, int] = {}
    which = np.array([first.setdefault(key, len(first)) for key in keys])
    new = np.append(True, np.maximum.accumulate(which)[:-1] < which[1:])
    copies = np.bincount(which)
    coded = words.dictionary_encode().combine_chunks()
    if not len(coded):
        return None
    hashes = np.array([zlib.crc32(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()], np.int64)
    order = np.lexsort((np.argsort(pc.sort_indices(coded.dictionary).to_numpy()), hashes))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    of = np.repeat(np.arange(len(keys)), n)
    kept = new[of]
    pairs, ns = np.unique(which[of[kept]] * len(order) + rank[coded.indices.to_numpy()[kept]], return_counts=True)
    doc, codes = np.divmod(pairs, len(order))
    sizes = np.bincount(doc, minlength=len(copies))
    full = np.flatnonzero(sizes)
    names = list(first)
    numbers = np.concatenate([sizes[full], codes, ns])
    return ([names[i] for i in full], copies[full].tolist(), coded.dictionary.take(pa.array(order)).to_pylist(), len(pairs), _compressed(numbers))


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block's row: words of each text, which they are, and how often each occurs."""
    texts, pairs = len(row["copies"]), row["pairs"]
    return tuple(np.split(_numbers(row["packed"], texts + 2 * pairs), [texts, texts + pairs]))


class _Block:
    """A block's texts (their known words and counts, one after another) and the topics of its words (NaN if not known)."""

    def __init__(self, row: dict, phi: np.ndarray, k: int, theta: np.ndarray | None):
        self.k, self.phi = k, np.nan_to_num(phi)
        sizes, codes, n = _unpack(row)
        known = ~np.isnan(phi[:, 0])[codes]
        of = np.repeat(np.arange(len(sizes)), sizes)[known]
        self.which, self.doc = np.unique(of, return_inverse=True)
        self.at, self.n = codes[known].astype(np.int64), n[known].astype(float)
        self.copies = np.array(row["copies"], dtype=float)[self.which]
        self.theta = np.full((len(self.which), k), 1.0 / k) if theta is None else theta
        self.starts = np.flatnonzero(np.diff(self.doc, prepend=-1))

    def chunks(self) -> Iterator[tuple[slice, slice]]:
        """Texts, and their words: a bounded number, or one text."""
        most, ends, a = max(1, CHUNK_NUMBERS // self.k), np.append(self.starts, len(self.doc)), 0
        while a < len(self.starts):
            b = max(a + 1, int(np.searchsorted(ends, ends[a] + most, "right")) - 1)
            yield slice(a, b), slice(int(ends[a]), int(ends[b]))
            a = b

    def _shares(self, texts: slice, words: slice) -> tuple[np.ndarray, np.ndarray]:
        """Expected counts per word of a text and topic, and the words' probabilities."""
        r = self.theta[self.doc[words]] * self.phi[self.at[words]]
        p = r.sum(axis=1)
        r *= (self.n[words] / p)[:, None]
        return r, p

    def move(self, alpha: float, counted: bool = False) -> tuple[np.ndarray | None, float]:
        """New shares of the texts; the words' expected counts under the old ones if wanted, and the old log likelihood."""
        counts, told, theta = np.zeros((len(self.phi), self.k)) if counted else None, 0.0, np.empty_like(self.theta)
        for texts, words in self.chunks():
            r, p = self._shares(texts, words)
            sums = np.add.reduceat(r, self.starts[texts] - words.start, axis=0) + alpha
            theta[texts] = sums / sums.sum(axis=1, keepdims=True)
            if counted:
                told += float((self.n[words] * np.log(p)) @ self.copies[self.doc[words]])
                for t in range(self.k):
                    counts[:, t] += np.bincount(self.at[words], r[:, t] * self.copies[self.doc[words]], len(self.phi))
        self.theta = theta
        return counts, told

    def likelihood(self) -> np.ndarray:
        """Per text, of all its copies."""
        out = np.zeros(len(self.which))
        for texts, words in self.chunks():
            p = self._shares(texts, words)[1]
            out[texts] = np.add.reduceat(self.n[words] * np.log(p), self.starts[texts] - words.start)
        return out * self.copies


def _told(counts: np.ndarray, beta: float) -> list[float]:
    """A part's total per topic, and the sum of the logarithms of its smoothed counts."""
    return [*counts.sum(axis=0).tolist(), float(np.log(counts + beta).sum())]


def _received(values: pa.Table, k: int) -> tuple[np.ndarray, list[tuple[int, int]], np.ndarray | None]:
    """What was sent to a block: its words' topics, (part, words) of each part, and its shares if a step has told them."""
    rows = values.to_pylist()
    sent = sorted(((r["part"], _matrix(r["v"], k)) for r in rows if r["kind"] == TOPICS), key=lambda x: x[0])
    theta = next((_matrix(r["v"], k) for r in rows if r["kind"] == THETA), None)
    phi = np.concatenate([np.empty((0, k)), *[v for _, v in sent]])
    return phi, [(part, len(v)) for part, v in sent], theta


class TopicModel:
    """Topics by expectation maximization.

    A step sets the share of a topic in a document to its expected count plus `alpha`, and that of a word in a topic to its
    expected count plus `beta`, both normalized; log likelihood plus alpha (beta) times the sum of the logarithms of the shares never
    falls. Topics start from hashes of seed, topic and word, documents with equal shares, so results do not depend on partitions.
    Equal texts are one document with a weight. Texts that are NULL or hold no word of the vocabulary get equal shares.
    """

    def __init__(self, k: int = 10, alpha: float = 0.1, beta: float = 0.01, max_iter: int = 20, seed: int = 42,
                 min_df: int | float = 1, vocabulary_size: int | None = None, inference_iter: int = 20):
        """Every step reads all documents; without vocabulary_size every word of at least min_df documents takes part."""
        if k < 1 or alpha <= 0 or beta <= 0:
            raise ValueError("k, alpha and beta must be positive")
        self.__dict__.update(locals())
        self.vocabulary = self.words = self.state = self.parts = self.totals = self.history = None

    def _blocks(self, df: DataFrame, text: str, parts: int | None = None) -> tuple[DataFrame, tuple[DataFrame, str], int]:
        """A row per block of texts; its words by (part, block), with how many texts hold them and how often they occur (and the folder of
        this table); the number of parts."""
        spark = df.sparkSession
        limit = limit_of(spark, CELL_ROWS)
        most = max(1, min(WORDS_PER_ROW * limit, BLOCK_NUMBERS // self.k))

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = TaskContext.get().partitionId() << 32
            for found in _dealt(batches, most):
                row = _pack(*found)
                if row is not None:
                    kinds = (pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((block, *row), kinds)],
                                                     names=["block", "keys", "copies", "words", "pairs", "packed"])
                    block += 1

        texts = df.select(F.col(text).cast("string").alias("_t")).filter(F.col("_t").isNotNull())
        blocks = stored(texts.mapInArrow(pack, BLOCKS))
        if parts is None:
            n = blocks.agg(F.sum(F.size("words").cast("long"))).first()[0] or 0
            parts = max(-(-n // limit), spark.sparkContext.defaultParallelism)

        def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in (r for batch in batches for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                sizes, codes, n = _unpack(row)
                copies = np.repeat(np.array(row["copies"]), sizes)
                words, w = pa.array(row["words"], pa.string()), len(row["words"])
                df, total = np.bincount(codes, copies, w).astype(np.int64), np.bincount(codes, n * copies, w).astype(np.int64)
                part = np.array([_part_of(x, parts) for x in words.cast(pa.binary()).to_pylist()])
                starts = np.flatnonzero(np.diff(part, prepend=-1))
                ends = pa.array(np.append(starts, w), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[starts], pa.int32()), pa.array([row["block"]] * len(starts), pa.int64()),
                     *[pa.ListArray.from_arrays(ends, x) for x in (words, pa.array(df), pa.array(total))]],
                    names=["part", "block", "words", "df", "total"])

        named = stored_in(blocks.select("block", "copies", "words", "pairs", "packed").mapInArrow(name, NAMED))
        return blocks, named, parts

    def _places(self, named: DataFrame, vocabulary: DataFrame) -> DataFrame:
        """Where the words of each (part, block) stand in the part's vocabulary (part, words); -1 for unknown ones."""
        def place(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            known = right["words"].combine_chunks().flatten()
            rows = []
            for part, block, words in zip(left["part"].to_pylist(), left["block"].to_pylist(), left["words"]):
                at = pc.fill_null(pc.index_in(words.values, value_set=known), -1).to_numpy(zero_copy_only=False)
                rows.append((part, block, len(at), _compressed(at)))
            return _table(rows, [("part", pa.int32()), ("block", pa.int64()), ("n", pa.int32()), ("places", pa.binary())])

        return stored(named.select("part", "block", "words").groupBy("part").cogroup(vocabulary.select("part", "words").groupBy("part"))
                      .applyInArrow(place, PLACES))

    def _below(self) -> list[float]:
        """Denominators of the words' shares of the topics."""
        return [t + self.n_words * self.beta for t in self.totals]

    def _sent(self, places: DataFrame) -> DataFrame:
        """The topics of its words for every block, a value per part."""
        k, beta = self.k, self.beta
        inverse = 1.0 / np.array(self._below()) if self.n_words else np.ones(k)

        def send(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            phi = np.concatenate([*[(_matrix(v, k) + beta) * inverse for v in right["v"].to_pylist()], np.full((1, k), np.nan)])
            rows = [(TOPICS, r["block"], r["part"], phi[_numbers(r["places"], r["n"])].tobytes(), None) for r in left.to_pylist()]
            return _table(rows, _VALUES)

        return places.groupBy("part").cogroup(self.state.select("part", "v").groupBy("part")).applyInArrow(send, STEP)

    def _take(self, state: DataFrame) -> float:
        """New counts; the sum of the logarithms of the words' shares."""
        self.state = state
        row = state.agg(*[F.sum(F.col("told")[t]).alias(f"t{t}") for t in range(self.k + 1)]).first()
        self.totals = [float(row[t] or 0.0) for t in range(self.k)]
        below = self._below()
        return float((row[self.k] or 0.0) - self.n_words * np.log(below).sum()) if self.n_words else 0.0

    @property
    def counts(self) -> DataFrame:
        """(word, v): the topic counts of each word."""
        k = self.k

        def unroll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for words, v in zip(batch.column(0), batch.column(1).to_pylist()):
                    ends = np.arange(len(words.values) + 1, dtype="int32") * k
                    yield pa.RecordBatch.from_arrays([words.values, pa.ListArray.from_arrays(ends, _matrix(v, k).ravel())], names=["word", "v"])

        return (self.words.select("part", "words").join(self.state.select("part", "v"), "part").select("words", "v")
                .mapInArrow(unroll, "word string, v array<double>"))

    def fit(self, df: DataFrame, text: str) -> "TopicModel":
        """`history` has a row per step: step, log_likelihood and objective of the topics and shares that the step began with."""
        k, alpha, beta, spark = self.k, self.alpha, self.beta, df.sparkSession
        least = int(self.min_df * df.count()) if isinstance(self.min_df, float) else self.min_df
        blocks, (named, folder), self.parts = self._blocks(df, text)

        def add_words(rows: pa.Table) -> pa.Table:
            rows = rows.combine_chunks()
            long = pa.table({"word": rows["words"].combine_chunks().flatten(), "df": rows["df"].combine_chunks().flatten(),
                             "total": rows["total"].combine_chunks().flatten()})
            found = long.group_by("word").aggregate([("df", "sum"), ("total", "sum")])
            return pa.table({"word": found["word"], "df": found["df_sum"], "total": found["total_sum"]})

        words = (named.select("part", "words", "df", "total").groupBy("part").applyInArrow(add_words, "word string, df long, total long")
                 .filter(F.col("df") >= least))
        if self.vocabulary_size is not None:
            words = words.orderBy(F.desc("total"), "word").limit(self.vocabulary_size)
        self.vocabulary = settle(words)
        self.n_words = self.vocabulary.df.count()
        draws = [(F.conv(F.substring(F.md5(F.concat(F.lit(f"{self.seed}:{t}:"), F.col("word"))), 1, 8), 16, 10).cast("double") + 1) / 2.0 ** 32
                 for t in range(k)]
        part = F.shiftright(F.crc32(F.col("word").cast("binary")) * F.lit(self.parts).cast("long"), 32).cast("int")
        drawn = self.vocabulary.df.select(part.alias("part"), "word", "total", F.array(*draws).alias("u"))

        def first_counts(rows: pa.Table) -> pa.Table:
            rows = rows.sort_by("word").combine_chunks()
            u = rows["u"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            sums = np.zeros(len(u))
            for t in range(k):
                sums = sums + u[:, t]
            v = rows["total"].to_numpy()[:, None] * u / sums[:, None]
            return pa.table({"part": rows["part"].slice(0, 1), "words": pa.array([rows["word"].to_pylist()], pa.list_(pa.string())),
                             "v": pa.array([v.tobytes()], pa.binary()), "told": pa.array([_told(v, beta)], pa.list_(pa.float64()))})

        self.words = stored(drawn.groupBy("part").applyInArrow(first_counts, "part int, words array<string>, v binary, told array<double>"))
        logs = self._take(self.words)
        places = self._places(named, self.words)
        discard(spark, folder)
        docs = blocks.select("block", "copies", "pairs", "packed")

        def work(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            row = left.to_pylist()[0]
            phi, sizes, theta = _received(right, k)
            b = _Block(row, phi, k, theta)
            shares = float((b.copies[:, None] * np.log(b.theta)).sum())
            counts, likelihood = b.move(alpha, True)
            rows, at = [(THETA, row["block"], None, b.theta.tobytes(), None), (LIKELIHOOD, row["block"], None, None, [likelihood, shares])], 0
            for part, n in sizes:
                rows.append((COUNTS, row["block"], part, counts[at:at + n].tobytes(), None))
                at += n
            return _table(rows, _VALUES)

        def add_up(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            found = {r["block"]: _matrix(r["v"], k) for r in right.to_pylist()}
            total = np.zeros((0, k))
            for r in sorted(left.to_pylist(), key=lambda r: r["block"]):
                at = _numbers(r["places"], r["n"])
                known = at >= 0
                if len(at) and at.max(initial=-1) >= len(total):
                    total = np.concatenate([total, np.zeros((at.max() + 1 - len(total), k))])
                total[at[known]] += found[r["block"]][known]  # a word stands once in a block
            return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "v": pa.array([total.tobytes()], pa.binary()),
                             "told": pa.array([_told(total, beta)], pa.list_(pa.float64()))})

        theta, history, before = None, [], []
        for step in range(self.max_iter):
            values = self._sent(places) if theta is None else self._sent(places).unionByName(theta)
            out, folder = stored_in(docs.groupBy("block").cogroup(values.groupBy("block")).applyInArrow(work, STEP))
            row = out.filter(F.col("kind") == LIKELIHOOD).agg(F.sum(F.col("told")[0]).alias("l"), F.sum(F.col("told")[1]).alias("d")).first()
            likelihood, shares = float(row["l"] or 0.0), float(row["d"] or 0.0)
            history.append((step, likelihood, likelihood + alpha * shares + beta * logs))
            theta = out.filter(F.col("kind") == THETA)
            state, after = stored_in(places.groupBy("part").cogroup(out.filter(F.col("kind") == COUNTS).select("part", "block", "v").groupBy("part"))
                                     .applyInArrow(add_up, STATE))
            logs = self._take(state)
            discard(spark, *before)
            before = [folder, after]
        self.history = spark.createDataFrame(history, "step int, log_likelihood double, objective double")
        return self

    def _inferred(self, df: DataFrame, text: str) -> DataFrame:
        """(key, v, log_likelihood) per distinct text of a block with known words: its shares with the topics held fixed."""
        if self.state is None:
            raise ValueError("fit the model first")
        k, alpha, rounds = self.k, self.alpha, self.inference_iter
        blocks, (named, folder), _ = self._blocks(df, text, self.parts)
        places = self._places(named, self.words)
        discard(df.sparkSession, folder)

        def work(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            row = left.to_pylist()[0]
            b = _Block(row, _received(right, k)[0], k, None)
            for _ in range(rounds):
                b.move(alpha)
            ends = np.arange(len(b.theta) + 1, dtype="int32") * k
            return pa.table({KEY: pa.array([row["keys"][i] for i in b.which], pa.binary()), "v": pa.ListArray.from_arrays(ends, b.theta.ravel()),
                             "log_likelihood": b.likelihood()})

        return (blocks.select("block", "keys", "copies", "pairs", "packed").groupBy("block")
                .cogroup(self._sent(places).groupBy("block")).applyInArrow(work, FOUND))

    def transform(self, df: DataFrame, text: str, out: str = "topics") -> DataFrame:
        """Add the topic shares of each document."""
        # a text that stands in several blocks has the same shares in each
        shares = self._inferred(df, text).select(KEY, F.col("v").alias("_topic_shares")).dropDuplicates([KEY])
        keyed = df.withColumn(KEY, _key(text))
        equal = F.array_repeat(F.lit(1.0 / self.k), self.k)
        return (keyed.join(shares, KEY, "left").withColumn("_topic_shares", F.coalesce("_topic_shares", equal))
                .select(*[F.col(f"`{c}`") for c in df.columns if c != out], F.col("_topic_shares").alias(out)))

    def log_likelihood(self, df: DataFrame, text: str) -> float:
        """Of all known words, with the documents' inferred shares."""
        return float(self._inferred(df, text).agg(F.sum("log_likelihood")).first()[0] or 0.0)

    def topics(self, n_words: int = 10) -> DataFrame:
        """(topic, rank, word, weight): the likeliest words of each topic, ties in order of the word."""
        below = F.lit(self._below())
        long = (self.counts.select("word", F.posexplode("v").alias("topic", "c"))
                .select("word", "topic", ((F.col("c") + self.beta) / F.get(below, F.col("topic"))).alias("weight")))
        # the filter on row_number cuts every partition before the shuffle
        first = Window.partitionBy("topic").orderBy(F.desc("weight"), "word")
        best = long.withColumn("rank", F.row_number().over(first) - 1).filter(F.col("rank") < n_words)
        return best.select("topic", "rank", "word", "weight")
