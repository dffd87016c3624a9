"""N-gram Jaccard join by PartEnum signatures.

A document's set are its distinct five-word shingles, as 64-bit hashes. Sets are dealt to overlapping bands of similar
size, so that every pair that can be similar enough shares a band. A band's threshold bounds the symmetric difference
by k, so when the hash domain is cut into more than k parts, some parts must agree: signatures are subsets of parts
(pairs of parts for small k, single parts above) with the elements they hold. Sets that share a signature are
candidates and are verified on their whole sets.

Equal sets are one class from the start. Every class is first verified against the class that leads most of its
signature groups; what connects so is one group, and only pairs of different groups that share a signature are
verified after that. A group of thousands of near copies so costs one comparison each, and no link between different
groups is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postalith.llm.common import Scratch, components, extended

#: Words in a shingle; least similarity in hundredths.
WORDS, LEAST = 5, 80
#: A band spans sizes up to STEP ** 3 times its smallest; the next begins at STEP ** 2 times it.
STEP = Fraction(100, LEAST)
#: Up to this difference signatures are pairs of parts.
PAIRED = 5
#: Ways to cut the domain that a set tries in turn when too many of its parts are empty.
SEEDS = 4
#: Signatures that a task compares at a time, on average.
BUCKET = 1 << 18
#: 64-bit numbers in a sketch.
SKETCH = 16
#: Rounds after the first: all but the last compare with leaders drawn anew.
TURNS = 1

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n-1 of the base and of its inverse, modulo 2 ** 64."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            _powers[i] = np.cumprod(x, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word of an ASCII-lower-cased text: a polynomial over its bytes, mixed."""
    raw = np.frombuffer(text.translate(_LOWER), np.uint8)
    space = _SPACE[raw]
    edge = np.diff(space.astype(np.int8), prepend=1, append=1)
    first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _power(1 << max(12, int(len(raw)).bit_length()))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    return _mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))


_PLACES = _mix(np.arange(1, WORDS + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; fewer words than a shingle has are one; none without words."""
    h = word_hashes((text or "").encode("utf-8", "replace"))
    if not len(h):
        return h
    n = max(1, len(h) - words + 1)
    total = np.full(n, min(len(h), words), np.uint64)
    places = _PLACES if words == WORDS else _mix(np.arange(1, words + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
    for j in range(min(words, len(h))):
        total += h[j : j + n] * places[j]
    return np.unique(_mix(total))


def class_of(h: np.ndarray) -> int:
    """A signed 64-bit name for a set: equal sets have equal names."""
    with np.errstate(over="ignore"):
        total = h.sum(dtype=np.uint64) + _mix(h).sum(dtype=np.uint64) * np.uint64(_BASE) + np.uint64(len(h))
    return int(_mix(np.array([total]))[0].view(np.int64))


def _bands() -> list[tuple[int, int]]:
    """Smallest and largest size of each band."""
    found, low = [], Fraction(1)
    while low < 1 << 40:
        found.append((-(-low.numerator // low.denominator), int(low * STEP**3)))
        low *= STEP**2
    return found


BANDS = _bands()
_LOWS = np.array([a for a, _ in BANDS])


def bands_of(size: int) -> list[int]:
    at = int(np.searchsorted(_LOWS, size, side="right")) - 1
    return [i for i in range(max(0, at - 2), at + 1) if BANDS[i][0] <= size <= BANDS[i][1]]


def most_difference(size: int, largest: int) -> int:
    """Most elements by which a set of this size differs from one that is similar enough and no larger than this."""
    return (100 - LEAST) * (size + min(largest, size * 100 // LEAST)) // (100 + LEAST)


def signatures(h: np.ndarray) -> np.ndarray:
    """64-bit signatures of a sorted set: any two sets that are similar enough and not equal share one."""
    size, found = len(h), []
    for band in bands_of(size):
        largest = BANDS[band][1]
        k = most_difference(size, largest)
        if not k:
            continue  # only an equal set is similar enough
        widest = (100 - LEAST) * 2 * largest // (100 + LEAST)
        paired = widest <= PAIRED
        parts = widest + 2 + (1 if paired else widest // 50 + 2)
        for seed in range(SEEDS):
            x = h if not seed else np.sort(_mix(h + np.uint64(seed * _BASE & (2**64 - 1))))
            part = ((x >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            start = np.flatnonzero(np.diff(part, prepend=np.uint64(parts)))
            held = part[start]
            value = np.add.reduceat(_mix(x), start) + np.uint64(1)
            salt = np.uint64((band * SEEDS + seed + 1) * 0xD1342543DE82EF95 & (2**64 - 1))
            # parts that differ are at most k, so of k + 1 parts with elements one must agree; both sets go by part order
            enough = len(held) > k
            full = not enough and seed == SEEDS - 1
            if paired:
                every = np.zeros(parts, np.uint64)
                every[held.astype(np.int64)] = value
                a, b = np.array(list(combinations(range(parts), 2))).T
                some = (every[a] != 0) | (every[b] != 0) | full
                a, b = a[some], b[some]
                found.append(_mix(salt + (a * parts + b).astype(np.uint64)) + every[a] + every[b] * np.uint64(_BASE))
            else:
                if full:
                    every = np.zeros(parts, np.uint64)
                    every[held.astype(np.int64)] = value
                    held, value = np.arange(parts, dtype=np.uint64), every
                elif enough:
                    held, value = held[: k + 1], value[: k + 1]
                found.append(_mix(salt + held) + value)
            if enough:
                break
    return _mix(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def sketch(h: np.ndarray, numbers: int = SKETCH) -> np.ndarray:
    """Whether an odd number of elements fall on each bit of so many 64-bit numbers.

    Sketches of two sets differ in no more bits than the sets in elements, so they rule pairs out without error. Half
    as long a sketch is one half of the numbers xor the other.
    """
    odd = np.bincount((h & np.uint64(64 * numbers - 1)).astype(np.int64), minlength=64 * numbers) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def wide_sketch(h: np.ndarray) -> np.ndarray:
    """A sketch of about two to four bits an element, which large sets need."""
    return sketch(h, max(SKETCH, 1 << max(0, len(h) // 32).bit_length()))


def sets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, cls, shingles of every document with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(a, 512) for a in range(0, whole.num_rows, 512)):
                rows = [shingles(t) for t in batch.column(1).to_pylist()]
                some = [i for i, h in enumerate(rows) if len(h)]
                flat = np.concatenate([np.zeros(0, np.uint64), *(rows[i] for i in some)]).view(np.int64)
                ends = np.cumsum([0, *(len(rows[i]) for i in some)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(some, pa.int64())), pa.array([class_of(rows[i]) for i in some], pa.int64()), lists], names=["key", "cls", "shingles"])

    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(run, "key long, cls long, shingles array<long>")


def _ids(docs: DataFrame, key: str, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(a, 1024) for a in range(0, whole.num_rows, 1024)):
                size, name, odd, wide = [], [], [], []
                for t in batch.column(1):
                    h = shingles(t.as_py())
                    size.append(len(h)), name.append(class_of(h) if len(h) else None), odd.append(sketch(h) if len(h) else None), wide.append(wide_sketch(h) if len(h) else None)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(name, pa.int64()), *(pa.array(x, pa.list_(pa.int64())) for x in (odd, wide))], names=["key", "size", "cls", "sketch", "wide"])

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(run, "key long, size long, cls long, sketch array<long>, wide array<long>")


def _groups(docs: DataFrame, text: str, buckets: int) -> DataFrame:
    """(signature, cls, n): the classes of every signature that n, two or more, share.

    Signatures travel in blobs, one per bucket and batch; a class that a task has sent is not sent again.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for whole in batches:
            for batch in (whole.slice(a, 1024) for a in range(0, whole.num_rows, 1024)):
                sigs, names = [], []
                for t in batch.column(0):
                    h = shingles(t.as_py())
                    if len(h) and (name := class_of(h)) not in sent:
                        if len(sent) >= 1 << 20:
                            sent.clear()
                        sent.add(name)
                        s = signatures(h)
                        sigs.append(s), names.append(np.full(len(s), name, np.int64))
                if not sigs:
                    continue
                s, n = np.concatenate(sigs), np.concatenate(names)
                bucket = ((s >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                order = np.argsort(bucket, kind="stable")
                s, n, bucket = s[order], n[order], bucket[order]
                at = np.flatnonzero(np.diff(bucket, prepend=np.uint64(buckets)))
                ends = np.append(at[1:], len(s))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[at].astype(np.int32)), *(pa.array([x[a:b].tobytes() for a, b in zip(at, ends)], pa.binary()) for x in (s, n))], names=["bucket", "sigs", "names"]
                )

    def meet(table: pa.Table) -> pa.Table:
        s, n = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (("sigs", np.uint64), ("names", np.int64)))
        order = np.lexsort((n, s))
        s, n = s[order], n[order]
        if len(s):
            keep = np.append(True, (s[1:] != s[:-1]) | (n[1:] != n[:-1]))
            s, n = s[keep], n[keep]
        same = s[1:] == s[:-1]
        many = np.append(same, False) | np.append(False, same) if len(s) else np.zeros(0, bool)
        s, n = s[many], n[many]
        first = np.flatnonzero(np.append(True, s[1:] != s[:-1])) if len(s) else np.zeros(0, np.int64)
        count = np.diff(np.append(first, len(s)))
        return pa.table({"signature": pa.array(s.view(np.int64)), "cls": pa.array(n), "n": pa.array(np.repeat(count, count), pa.int64())})

    blobs = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(send, "bucket int, sigs binary, names binary")
    return blobs.groupBy("bucket").applyInArrow(meet, "signature long, cls long, n long")


def _apart(x: str, y: str, numbers: int) -> Column:
    """Bits in which the first numbers of two sketches differ."""
    return sum((F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i])) for i in range(1, numbers)), F.bit_count(F.col(x)[0].bitwiseXOR(F.col(y)[0])))


def _possible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose wide sketches do not rule them out; the longer one is folded to the shorter."""
    left = classes.select(F.col("cls").alias("a"), F.col("size").alias("na"), F.col("wide").alias("x"))
    right = classes.select(F.col("cls").alias("b"), F.col("size").alias("nb"), F.col("wide").alias("y"))
    half = lambda c, n: F.zip_with(F.slice(c, 1, n), F.slice(c, n + 1, n), lambda u, v: u.bitwiseXOR(v))
    fold = lambda c, other: F.when(F.size(c) > F.size(other), half(c, F.size(other))).otherwise(F.col(c))
    bits = F.aggregate(F.zip_with("u", "v", lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda n, x: n + x)
    met = pairs.join(left, "a").join(right, "b").where(F.least(F.size("x"), F.size("y")) * 2 >= F.greatest(F.size("x"), F.size("y")))
    met = met.select("a", "b", "na", "nb", fold("x", "y").alias("u"), fold("y", "x").alias("v"))
    return met.where(bits * (100 + LEAST) <= (F.col("na") + F.col("nb")) * (100 - LEAST)).select("a", "b")


def _verified(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose sets are similar enough."""
    left = found.select(F.col("cls").alias("a"), F.col("shingles").alias("x"))
    right = found.select(F.col("cls").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y")).cast("long")
    return pairs.join(left, "a").join(right, "b").where(both * 100 >= (F.size("x") + F.size("y") - both) * LEAST).select("a", "b")


def _led(members: DataFrame, order: Column) -> DataFrame:
    """Pairs (a, b): each class with the leader, the greatest in order, of most of its signature groups.

    members is (signature, cls, component); leaders of a class's own component do not count.
    """
    lead = members.groupBy("signature").agg(F.max_by(F.struct(F.col("cls").alias("lead"), F.col("component").alias("of")), order).alias("l"))
    votes = members.join(lead, "signature").where(F.col("component") != F.col("l.of")).groupBy("cls", F.col("l.lead").alias("lead")).agg(F.count("*").alias("n"))
    return votes.groupBy(F.col("cls").alias("a")).agg(F.max_by("lead", F.struct("n", "lead")).alias("b"))


def connect(docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id): the set size of every document and the smallest key that links reach.

    Links are pairs with 100 times the common shingles at least 80 times all shingles of both. Documents without
    words, or null, have the empty set and link with nothing. A row with a null key takes part in nothing: its
    component is null. Rows that repeat a key all take part; equal rows are copies. Other columns play no part.
    Sets, classes and signatures are compared by 64-bit hashes.
    """
    ids = scratch.keep(_ids(docs, key, text), "ids")
    worded = ids.where(F.col("cls").isNotNull() & F.col("key").isNotNull())
    classes = scratch.keep(worded.groupBy("cls").agg(F.min("key").alias("first"), F.first("size").alias("size"), F.first("sketch").alias("sketch"), F.first("wide").alias("wide")), "classes")
    total = classes.agg(F.sum("size")).first()[0] or 0
    keyed = docs.where(F.col(key).isNotNull())
    groups = scratch.keep(_groups(keyed, text, max(64, -(-int(total * 0.36) // BUCKET))), "groups")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """The pairs whose sets are similar enough; only their classes' texts are read again."""
        named = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
        needed = scratch.keep(named.join(classes.select("cls", "first"), "cls"), f"needed-{name}")
        texts = keyed.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text")).join(needed.select(F.col("first").alias("_first")).distinct(), F.col("_key") == F.col("_first"))
        found = sets(texts.select("_key", "_text"), "_key", "_text").join(needed.withColumnRenamed("first", "key"), ["cls", "key"])
        found = scratch.keep(found.select("cls", "shingles"), f"sets-{name}")
        kept = scratch.keep(_verified(pairs, found), name)
        scratch.drop(f"sets-{name}")
        return kept

    # first round: leaders are the classes that share most signatures with others, so the middle of a group of copies
    weight = groups.groupBy("cls").agg(F.sum("n").alias("weight"))
    members = groups.select("signature", "cls").join(weight, "cls").withColumn("component", F.col("cls"))
    pairs = scratch.keep(_possible(_led(members, F.struct("weight", "cls")), classes), "pairs0")
    labels = components(verified(pairs, "edges0"), scratch, "labels0")
    for turn in range(1, TURNS + 1):
        named = groups.select("signature", "cls").join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
        mixed = scratch.keep(_mixed(named), f"mixed{turn}")
        if turn < TURNS:
            pairs = _led(mixed, F.xxhash64(F.lit(turn), "cls"))
        else:  # whatever is left: all pairs of different groups that a signature joins and sketches do not rule out
            sized = mixed.join(classes.select("cls", "size", "sketch"), "cls")
            one, two = (sized.select("signature", *(F.col(c).alias(f"{c}{i}") for c in ("cls", "component", "size", "sketch"))) for i in (1, 2))
            near = (F.col("size1") * 100 >= F.col("size2") * LEAST) & (F.col("size2") * 100 >= F.col("size1") * LEAST)
            near = near & (_apart("sketch1", "sketch2", SKETCH) * (100 + LEAST) <= (F.col("size1") + F.col("size2")) * (100 - LEAST))
            pairs = one.join(two, "signature").where((F.col("component1") < F.col("component2")) & near).select(F.col("cls1").alias("a"), F.col("cls2").alias("b")).distinct()
        pairs = scratch.keep(_possible(scratch.keep(pairs, f"met{turn}"), classes), f"pairs{turn}")
        edges = verified(pairs, f"edges{turn}")
        scratch.drop(f"mixed{turn}")
        labels = extended(labels, edges, scratch, f"labels{turn}")
    scratch.drop("groups")

    of = classes.join(labels.withColumnRenamed("node", "cls"), "cls", "left").select("cls", "first", F.coalesce("component", "cls").alias("component"))
    of = scratch.keep(of, "of")
    smallest = of.groupBy("component").agg(F.min("first").alias("component_id"))
    told = of.join(smallest, "component").select("cls", "component_id")
    result = ids.select("key", "size", "cls").join(told, "cls", "left")
    own = F.when(F.col("key").isNotNull(), F.coalesce("component_id", "key"))
    return result.select(F.col("key").alias(key), F.col("size").alias("n_shingles"), own.alias("component_id"))


def _mixed(named: DataFrame) -> DataFrame:
    """(signature, cls, component) of signatures that join different components."""
    mixed = named.groupBy("signature").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("signature")
    return named.select("signature", "cls", "component").join(mixed, "signature", "left_semi")
