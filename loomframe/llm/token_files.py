"""Token ids of a corpus in shards, each one wavelet matrix in a compressed file, and their reader.

Documents are range-partitioned by id, so that shard after shard holds ids in ascending doc_id order. A shard is closed
at the first document end at or after `shard_tokens` ids; it is a row of a Parquet table (written through Spark's
committer, so that it works on every store and survives lost executors) with its place, the ids before it in the same
task, the documents' ids and lengths, and the bytes of the wavelet matrix.

Nulls and edge cases: a null text is empty and has the end id alone. Null doc_ids come first. Documents with equal doc_id
follow each other, ordered by the hash of the text and the text; repeated rows are all kept. An empty table gives no shard.
"""

from __future__ import annotations

import re
import zlib
from array import array
from codecs import charmap_decode
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.llm.common import col, released, text_of
from loomframe.llm.wavelet import WaveletMatrix

SHARD_TOKENS = 1 << 18
# Word encodings that one Python worker keeps.
KEPT_WORDS = 300_000
# Texts whose distinct words are looked up at once, at most so many bytes of them, and texts whose ids are put together at once.
BLOCK_TEXTS, BLOCK_BYTES, GATHERED = 2500, 8 << 20, 500
# A space before white space or the end: such texts are not cut at spaces.
ODD_SPACE = re.compile(r" (?=\s|$)")
# Marks that never join a letter before them (no bracket or bar of a special token, no apostrophe).
TAIL = ".,;:!?()[]{}*#%$&\"-_=+/\\~^@"
# Letters in every version of Unicode: a word of them is one piece of the splitting pattern, with the space before it.
LATIN = re.compile("[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
# A line break between two characters that surely are no white space is a piece of its own.
LINE = re.compile("\n(?<=[!-~\u00c0-\u024f]\n)(?=[!-~\u00c0-\u024f])")
# The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on.
PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTES = "".join(chr(b if b in PRINTED else 256 + sum(c not in PRINTED for c in range(b))) for b in range(256))


class Pieces:
    """Ids of pieces of text, one after another."""

    def __init__(self):
        self.parts: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.n = 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> range:
        """The numbers of the new pieces."""
        self.parts.append(ids)
        self.sizes.append(sizes)
        self.n += len(sizes)
        return range(self.n - len(sizes), self.n)

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where the pieces end (with a 0 before)."""
        self.parts, self.sizes = [np.concatenate([np.empty(0, "<u4"), *self.parts])], [np.concatenate([np.empty(0, np.int64), *self.sizes])]
        return self.parts[0], np.append(0, np.cumsum(self.sizes[0]))


class WordEncoder:
    """Ids of texts, with the ids of words kept.

    The vocabulary's splitting pattern never matches across a space followed by a word, so a text's ids are those of its
    words, each with the space before it. Only words not seen before go through the tokenizer, many in one call.
    """

    def __init__(self, path: str, most: int = KEPT_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        # words with their marks by number, the pieces of each (stem, marks), and the stems' and marks' pieces
        self.kept: dict[str, int] = {}
        self.pairs = np.empty((0, 2), np.int64)
        self.stems: dict[str, int] = {}
        self.marks: dict[str, int] = {}
        self.pieces = Pieces()
        vocabulary = self.tokenizer.get_vocab()
        self.starts = np.zeros(max(vocabulary.values()) + 1, bool)
        self.starts[[i for t, i in vocabulary.items() if t.startswith("Ġ")]] = True
        self.line = self._ids("\n").tolist()

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _each(self, texts: list[str], pieces: Pieces) -> range:
        found = [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return pieces.add(np.concatenate([np.empty(0, "<u4"), *found]), np.array([len(f) for f in found], np.int64))

    def _learn(self, words: list[str], pieces: Pieces) -> np.ndarray:
        """Pieces of words that follow a space or begin with a line break. Those of Latin letters are not cut by the splitting pattern
        and go to the merges at once; the others in one call for all, cut where a token starts with the space."""
        tokenize, whole = self.tokenizer.model.tokenize, LATIN.fullmatch
        sizes, ids, merged, rest, lines = array("q"), array("I"), [], [], []
        for i, w in enumerate(words):
            line = w[:1] == "\n"
            if whole(w, line):
                name = w if w.isascii() else charmap_decode(w.encode(), "strict", BYTES)[0]
                found = [t.id for t in tokenize(name[1:] if line else "Ġ" + name)]
                if line:
                    found[:0] = self.line
                merged.append(i)
                sizes.append(len(found))
                ids.extend(found)
            else:
                (lines if line else rest).append(i)
        out = np.empty(len(words), np.int64)
        out[merged] = pieces.add(np.array(ids, "<u4"), np.array(sizes, np.int64))
        out[lines] = self._each([words[i] for i in lines], pieces)
        for i in range(0, len(rest), 50_000):
            part = [words[j] for j in rest[i:i + 50_000]]
            found = self._ids(" " + " ".join(part))
            cuts = np.append(np.flatnonzero(self.starts[found]), len(found))
            if len(cuts) == len(part) + 1:
                out[rest[i:i + 50_000]] = pieces.add(found, np.diff(cuts))
            else:  # a word that holds a special token or other white space
                out[rest[i:i + 50_000]] = self._each([" " + w for w in part], pieces)
        return out

    def _pairs(self, words: list[str], here: Pieces) -> np.ndarray:
        """The pieces of words: of the stem and of the marks at the end, where the splitting pattern cuts. What there is no room to keep
        comes into `here`, which follows the pieces kept."""
        stems = [s if s and s[-1].isalpha() else w for w, s in zip(words, [w.rstrip(TAIL) for w in words])]
        marks = [w[len(s):] for w, s in zip(words, stems)]
        unseen = [s for s in dict.fromkeys(stems) if s not in self.stems]
        more = [m for m in dict.fromkeys(marks) if m not in self.marks]
        keep = len(self.stems) + len(unseen) <= self.most and len(self.marks) + len(more) <= self.most
        pieces, first = (self.pieces, 0) if keep else (here, self.pieces.n)
        learned = dict(zip(unseen, (self._learn(unseen, pieces) + first).tolist()))
        told = dict(zip(more, [first + i for i in self._each(more, pieces)]))
        if keep:
            self.stems.update(learned)
            self.marks.update(told)
        out = np.empty((len(words), 2), np.int64)
        for place, (names, known, new) in enumerate(((stems, self.stems, learned), (marks, self.marks, told))):
            out[:, place] = np.fromiter(map(known.get, names, repeat(-1)), np.int64, len(names))
            rest = np.flatnonzero(out[:, place] < 0)
            out[rest, place] = [new[names[i]] for i in rest]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text: those of its distinct words, put in the places of the words."""
        odd = [bool(ODD_SPACE.search(t)) for t in texts]
        # a line break between words begins a word of its own; no other word begins with one, as such a text is odd
        spaced = pa.array(["" if o else LINE.sub(" \n", t) for t, o in zip(texts, odd)], pa.large_string())
        lists = pc.split_pattern(spaced, " ")
        first, words = lists.offsets.to_numpy().astype(np.int64), lists.flatten()
        heads = words.take(pa.array(first[:-1])).to_pylist()
        follows = np.ones(len(words), bool)
        follows[first[:-1]] = False
        coded = words.filter(pa.array(follows)).dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        held, here = self.pieces, Pieces()
        at = np.fromiter(map(self.kept.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(at < 0)
        pairs = self._pairs([distinct[i] for i in new], here)
        at[new] = np.arange(len(self.pairs), len(self.pairs) + len(new))
        pairs = np.concatenate([self.pairs, pairs])
        if here.n == 0 and len(self.kept) + len(new) <= self.most:
            self.kept.update(zip([distinct[i] for i in new], at[new].tolist()))
            self.pairs = pairs
        head_at = self._each([t if o else h for t, o, h in zip(texts, odd, heads)], here)
        (ids, ends), (more, more_ends) = held.arrays(), here.arrays()
        ids = np.concatenate([ids, more])
        begins, sizes = np.concatenate([ends[:-1], more_ends + ends[-1]]), np.concatenate([np.diff(ends), np.diff(more_ends), [0]])
        at = at.astype(np.int32)[coded.indices.to_numpy()]
        out, after = [], 0
        for i in range(0, len(texts), GATHERED):
            starts = first[i:i + GATHERED + 1] - first[i]
            # two pieces at each place: a word and its marks, or a text's beginning and nothing
            which = np.full((starts[-1], 2), len(sizes) - 1, np.int64)
            rest = follows[first[i]:first[i] + starts[-1]]
            n_rest = int(np.count_nonzero(rest))
            which[rest] = pairs[at[after:after + n_rest]]
            which[starts[:-1], 0] = np.array(head_at[i:i + GATHERED], np.int64) + held.n
            which, after = which.ravel(), after + n_rest
            n = sizes[which]
            ends = np.cumsum(n)
            data = ids[np.repeat(begins[which] - (ends - n), n) + np.arange(n.sum())]
            ends = np.append(0, ends)[2 * starts].tolist()
            out += [data[a:b].tobytes() for a, b in zip(ends, ends[1:])]
        return out


def blocks_of(batch: pa.RecordBatch):
    """Slices of BLOCK_TEXTS rows at most, and of about BLOCK_BYTES if the rows allow it; texts are in the second column."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < batch.num_rows:
        before = int(sizes[a - 1]) if a else 0
        b = max(a + 1, min(a + BLOCK_TEXTS, int(np.searchsorted(sizes, before + BLOCK_BYTES, "right"))))
        yield batch.slice(a, b - a)
        a = b


@lru_cache(maxsize=2)
def _encoder(path: str, most: int = KEPT_WORDS) -> WordEncoder:
    return WordEncoder(path, most)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


SHARD_SCHEMA = ("part int, seq int, before long, n_tokens long, doc_ids array<long>, lengths array<long>, matrix binary")


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, shard_tokens: int = SHARD_TOKENS,
                      id_col: str = "doc_id", text_col: str = "text", kept_words: int = KEPT_WORDS) -> None:
    """Encode every text, append end_id, and write shards to `folder`. The id column is a whole number. A Python worker keeps the
    encodings of `kept_words` words."""

    def shards(batches):
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, end = _encoder(tokenizer, kept_words), int(end_id).to_bytes(4, "little")
        levels = max(len(encoder.starts) - 1, end_id).bit_length()
        part, seq, before, held, ids, lengths, size = TaskContext.get().partitionId(), 0, 0, [], [], [], 0

        def close():
            matrix = WaveletMatrix.of(np.frombuffer(b"".join(held), "<u4"), levels)
            row = [[part], [seq], [before], [size], [list(ids)], [list(lengths)], [matrix.to_bytes()]]
            return pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(row, FIELDS)], schema=FIELDS)

        for batch in batches:
            for block in blocks_of(batch):
                for doc_id, data in zip(block.column(0).to_pylist(), encoder.encode(block.column(1).to_pylist())):
                    held += (data, end)
                    ids.append(doc_id)
                    lengths.append(len(data) // 4 + 1)
                    size += lengths[-1]
                    if size >= shard_tokens:
                        yield close()
                        seq, before, held, ids, lengths, size = seq + 1, before + size, [], [], [], 0
        if ids:
            yield close()

    order = [col("doc_id").asc_nulls_first(), F.xxhash64("text"), col("text")]
    (docs.select(col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
     .repartitionByRange(*order[:2]).sortWithinPartitions(*order)
     .mapInArrow(released(shards), SHARD_SCHEMA).write.parquet(folder))


FIELDS = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("before", pa.int64()), ("n_tokens", pa.int64()),
                    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("matrix", pa.binary())])


def token_shards(spark: SparkSession, folder: str) -> DataFrame:
    """The shards with `start`: the ids in all shards before. Totals per writing task are few and are added up on the driver."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(folder)
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    before, rows = 0, []
    for r in totals:
        rows.append((r["part"], before))
        before += r["n"]
    parts = spark.createDataFrame(rows, "part int, part_start long")
    return (shards.join(F.broadcast(parts), "part")  # a row per writing task
            .withColumn("start", F.col("part_start") + F.col("before")).drop("part_start"))


def read_documents(spark: SparkSession, folder: str, tokens: bool = False) -> DataFrame:
    """Each document's place, length and checksum (and its ids on request), decoded from the shards."""
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if tokens:
        fields, schema = [*fields, ("ids", pa.list_(pa.int64()))], schema + ", ids array<long>"

    def decode(batches):
        for batch in batches:
            for start, doc_ids, lengths, data in zip(*(c.to_pylist() for c in batch.columns)):
                ids = WaveletMatrix.from_bytes(data).to_array().astype("<u4")
                ends = np.cumsum(lengths)
                crcs = [zlib.crc32(ids[b - n:b]) for b, n in zip(ends.tolist(), lengths)]
                arrays = [doc_ids, (start + ends - lengths).tolist(), lengths, crcs]
                if tokens:
                    arrays.append([ids[b - n:b].tolist() for b, n in zip(ends.tolist(), lengths)])
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, (_, t) in zip(arrays, fields)], names=[n for n, _ in fields])

    return token_shards(spark, folder).select("start", "doc_ids", "lengths", "matrix").mapInArrow(released(decode), schema)
