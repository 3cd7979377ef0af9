"""Wide SimHash: fingerprints of so many bits that a Hamming radius tells texts of a given similarity, and keys to find them by.

A bit is the sign of a sum over the bag's values (a value of each bit is +1 or -1, by hash), so bags of cosine c differ in
acos(c) / pi of their bits: 15 % at a similarity of 0.8, half between strangers. A bit whose sum is far from zero is
sure: a near bag has the same. Of GROUPS fixed groups of GROUP bits each bag is filed under the TAKEN surest ones, with
the values of their bits; near bags are sure of the same bits, so that they share about 15 keys at 0.8. Between files, Hamming
distances decide: `partnered` drops what is near to nobody of its key, on CHECKED bits that belong to no group.
"""

from __future__ import annotations

from itertools import chain
from math import erf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.llm.common import released
from loomframe.plans.runtime import settle

BITS, KEYED, CHECKED = 512, 256, 128
GROUPS, GROUP, TAKEN = 2048, 12, 96
# Differing bits of all, and of the checked ones: five deviations above the mean of pairs at a similarity of 0.8 (15.6 % in the
# worst size of bags).
FAR, CHECKED_FAR = 122, 43
LONGS, CHECKED_LONGS = BITS // 64, CHECKED // 64
# Members of a key that are compared by shifting; in larger keys those reached are not compared again.
SHIFTED = 1024
# Share of the bags on which crowded keys are told.
SAMPLED = 64

MEMBERS = np.stack([np.random.default_rng([11, g]).permutation(KEYED)[:GROUP] for g in range(GROUPS)])
IN_GROUP = np.zeros((KEYED, GROUPS), np.float32)
IN_GROUP[MEMBERS, np.arange(GROUPS)[:, None]] = 1
# The logarithm of the probability that a bit stays in a bag of cosine 8/9, by its sum over the root of the bag's size.
GRID = np.linspace(0, 6, 601)
STAYS = np.array([np.log1p(-0.5 * (1 - erf((8 / 17 ** 0.5) * z / 2 ** 0.5))) for z in GRID])
POWERS = 1 << np.arange(GROUP, dtype=np.int64)


def value_bits(values: np.ndarray) -> np.ndarray:
    """BITS bits of each 64-bit value, as bytes of eight."""
    with np.errstate(over="ignore"):
        v = values[:, None] + np.arange(1, LONGS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        v = (v ^ (v >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (v ^ (v >> np.uint64(31))).view(np.uint8)


ALWAYS = np.unpackbits(value_bits(np.array([5], np.uint64)), axis=1)[0].astype(np.int32)


def bit_sums(bag: np.ndarray) -> tuple[np.ndarray, int]:
    """The sum of +1 and -1 of each bit, and the number of values. Bags of four values or more get one more, the same for all: else
    bags of four and five values in common with all but one would differ in too many bits."""
    ones, n = np.zeros(BITS, np.int32), len(bag)
    for i in range(0, n, 255):  # sums of 255 fit into a byte
        ones += np.unpackbits(value_bits(bag[i:i + 255]), axis=1).sum(axis=0, dtype=np.uint8)
    if n > 3:
        ones, n = ones + ALWAYS, n + 1
    return 2 * ones - n, n


def sketches_and_keys(bags: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of each bag the BITS bits as longs, and the keys."""
    found = [bit_sums(b) for b in bags]
    sums = np.stack([s for s, _ in found])
    bits = (sums > 0).astype(np.uint8)
    sure = np.abs(sums[:, :KEYED]) / np.sqrt(np.maximum([[n] for _, n in found], 1))
    scores = np.interp(sure, GRID, STAYS).astype(np.float32) @ IN_GROUP
    taken = np.argpartition(-scores, TAKEN, axis=1)[:, :TAKEN]
    values = np.take_along_axis(bits, MEMBERS[taken].reshape(len(bags), -1), axis=1).reshape(len(bags), TAKEN, GROUP)
    return np.packbits(bits, axis=1).view(np.int64), taken * (1 << GROUP) + values @ POWERS


def reached(sketches: np.ndarray, far: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, the one it was reached from) that connect all sketches within the distance."""
    bits = np.ascontiguousarray(sketches).view(np.uint64)  # signed numbers would be counted by their absolute value
    left, out_a, out_b = np.arange(len(bits)), [], []
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            x = todo.pop()
            near = np.bitwise_count(bits[left] ^ bits[x]).sum(axis=1, dtype=np.int32) <= far
            found = left[near]
            if len(found):
                left = left[~near]
                out_a.append(found)
                out_b.append(np.full(len(found), x))
                todo.extend(found.tolist())
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (np.empty(0, np.int64),) * 2


def has_partner(keys: np.ndarray, sketches: np.ndarray, far: int) -> np.ndarray:
    """Whether another row of the same key is within the distance; keys are sorted."""
    out, bits = np.zeros(len(keys), bool), np.ascontiguousarray(sketches).view(np.uint64)
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    sizes = np.diff(np.append(starts, len(keys)))
    after = np.repeat(starts + sizes, sizes) - np.arange(len(keys))  # rows of the key from here on
    at, d = np.flatnonzero((after > 1) & (np.repeat(sizes, sizes) <= SHIFTED)), 1
    while len(at):
        hit = at[np.bitwise_count(bits[at] ^ bits[at + d]).sum(axis=1, dtype=np.int32) <= far]
        out[hit] = out[hit + d] = True
        d += 1
        at = at[after[at] > d]
    for s, n in zip(starts[sizes > SHIFTED], sizes[sizes > SHIFTED]):
        a, b = reached(bits[s:s + n], far)
        out[s + a] = out[s + b] = True
    return out


def partnered(distinct: DataFrame, crowd: int, far: int = CHECKED_FAR) -> DataFrame:
    """(fingerprint, key) of the bags that another one of the key is near to, on the checked bits. `distinct` has fingerprint, keys and
    sketch. Keys with more than about `crowd` members stay whole; they are told on some of the bags, and dealt out by the caller."""
    keyed = distinct.select("fingerprint", F.explode("keys").alias("key"), *[F.col("sketch")[i].alias(f"s{i}") for i in range(LONGS - CHECKED_LONGS, LONGS)])
    some = distinct.filter(F.pmod(F.xxhash64("fingerprint"), F.lit(SAMPLED)) == 0).select(F.explode("keys").alias("key"))
    crowded = settle(some.groupBy("key").count().filter(F.col("count") > max(1, crowd // (2 * SAMPLED))).select("key")).hinted()

    def run(batches):
        rest = np.empty((0, 2 + CHECKED_LONGS), np.int64)
        for batch in chain(batches, [None]):  # None: the last key has ended
            if batch is not None:
                rows = np.concatenate([rest, np.stack([c.to_numpy() for c in batch.columns], axis=1)])
                cut = int(np.searchsorted(rows[:, 1], rows[-1, 1])) if len(rows) else 0
                rows, rest = rows[:cut], rows[cut:]
            else:
                rows = rest
            if len(rows):
                rows = rows[has_partner(rows[:, 1], rows[:, 2:], far)]
                yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], names=["fingerprint", "key"])

    told = (keyed.join(crowded, "key", "left_anti").select(*keyed.columns).repartition("key").sortWithinPartitions("key")
            .mapInArrow(released(run), "fingerprint long, key long"))
    return told.unionByName(keyed.select("fingerprint", "key").join(crowded, "key", "left_semi"))

