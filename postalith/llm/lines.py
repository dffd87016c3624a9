"""Fuzzy line dedup in DataFrame operations alone.

Lines are normalised and equal ones become one. Two of n and m words are near if their edit distance over words is at
most a fifth of the longer. Every line gets a SimHash of its words and five blocks; lines that share a block meet,
SimHashes and sketches that are too far apart rule pairs out, the edit distance decides, and one occurrence of each
connected group stays.

A block is the least of the hashed runs of four words of a line (two in short lines) under one of five hash functions,
so by the pigeonhole principle near lines are missed only if all five least ones lie on changed words. Cutting the SimHash
itself into blocks does not reach this similarity: a fifth of the words changed moves a fifth of its bits, so blocks
that stay whole are too short to tell lines apart.

Lines are first compared with the leader of those that share a block. What connects so is one group; then those outside
the leader's group and all others meet one of them, and at last what is still outside meets all others, sketches
filtering in the join. So a line with thousands of variants costs a few comparisons each. Where very many lines of a
block are still outside, as with a passage that stands in many lines, only those meet that also share one of their
rarest words: of words in any one order, near lines have one in common among the first fifth and one more, so this
loses no near pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postalith.llm.common import PART, Scratch, components, extended, join_hot, perhaps

#: Least similarity: 1 - distance / words of the longer.
SIMILAR = 0.8
#: Blocks of a line.
BLOCKS = 5
#: Lines of up to SHORT words have blocks of word pairs, lines of LONG or more blocks of four words: near lines always share a kind.
SHORT, LONG = 14, 12
#: Words are likelier to be a block the longer, hence rarer, they are: their odds double with every EACH bytes, DOUBLED times at most.
EACH, DOUBLED = 4, 6
#: A SimHash has LANES times SUMS bits. Those of near lines may differ in BITS: 9 expected where a fifth of the words
#: changed, and 3.5 deviations. A line of MOST words or more overflows the counts: its SimHash rules nothing out.
LANES, SUMS, BITS, MOST = 4, 11, 18, 1 << 16
#: Columns of a sketch.
SKETCH = tuple(f"x{i}" for i in range(8))
#: Numbers that turn the order of hashes: they differ in their first bits, one for each block.
_TURNED = [(0x9E3779B97F4A7C15 * (i + 1) + 2**63) % 2**64 - 2**63 for i in range(BLOCKS)]
#: Rounds after the first: in all but the last, lines meet one that no leader has reached yet.
TURNS = 2
#: Parts that the pairs of a line with very many are cut in.
SALTS = 64
#: Lines of a block that has so many outside its leader's group meet by their rarest words.
CROWD = 1024
#: How often words are is counted by places, a power of two, in one of so many lines; it decides the order of words, not what is found.
PLACES, ONE_OF = 1 << 15, 8
#: Lines with more rarest words than this do not carry them along; what they share is told from pairs that come twice.
CARRIED = 64


def normal(line: Column) -> Column:
    """Lower case; runs of anything but letters and digits become one space."""
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))


def compared(docs: DataFrame, key: str, text: str) -> DataFrame:
    """A row for every line with a letter or digit: key, mark (hash of the text), at (line number from 0), line (hash), norm."""
    every = F.transform(F.split(F.col(text).cast("string"), "\n"), normal)
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("mark"), F.posexplode(every).alias("at", "norm"))
    return rows.where("norm <> ''").withColumn("line", F.xxhash64("norm"))


def _shift(name: str, value: Column, by: Column | int) -> Column:
    return F.call_function(name, value, F.lit(by) if isinstance(by, int) else by)


def keyed(rows: DataFrame) -> DataFrame:
    """line, n (words), odd (a bit for each word, by parity) and blocks, for every line of rows (line, norm).

    That is one row, but two for lines that are neither short nor long, whatever the number of copies; where it is even
    their bits cancel out, and odd is null. A line of three words or fewer has no near lines but equal ones, and no blocks.
    """
    kinds = F.when(F.col("n") < LONG, F.array(F.lit(2))).when(F.col("n") > SHORT, F.array(F.lit(4))).otherwise(F.array(F.lit(2), F.lit(4)))
    sized = rows.select("line", F.split("norm", " ").alias("w")).select("line", "w", F.size("w").alias("n")).where("n >= 4")
    at = sized.select("line", "w", "n", F.explode(kinds).alias("kind")).select("line", "kind", "n", "w", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    word = lambda by: F.get("w", F.col("i") + by)
    long = F.col("kind") == 4
    words = at.select("line", "kind", "n", word(0).alias("a"), word(1).alias("b"), F.when(long, word(2)).alias("c"), F.when(long, word(3)).alias("d"))
    letters = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in "bcd"), F.octet_length("a"))
    doubled = F.least(_shift("shiftrightunsigned", letters, EACH.bit_length() - 1), F.lit(DOUBLED)) + 1
    bit = _shift("shiftleft", F.lit(1).cast("long"), F.xxhash64("a").bitwiseAND(F.lit(63)).cast("int"))
    words = words.select("line", "kind", "n", F.xxhash64(*"abcd").alias("h"), doubled.cast("int").alias("doubled"), bit.alias("bit"))
    # the order of hashes turned by different numbers is another one each time
    least = [F.min(_shift("shiftrightunsigned", F.col("h").bitwiseXOR(F.lit(turn)), F.col("doubled"))).alias(f"m{i}") for i, turn in enumerate(_TURNED)]
    found = words.groupBy("line", "kind").agg(F.max("n").alias("n"), F.count("*").alias("words"), F.bit_xor("bit").alias("odd"), *least)
    return found.select("line", "n", F.when(F.pmod(F.col("words"), F.col("n") * 2) == F.col("n"), F.col("odd")).alias("odd"), F.array(*[F.xxhash64(F.lit(i), "kind", f"m{i}") for i in range(BLOCKS)]).alias("blocks"))


def leads(blocks: DataFrame) -> DataFrame:
    """block and lead (its least line), for the blocks of rows (block, line, n, odd) that several lines share.

    Blocks of two lines that cannot be near, by their numbers of words and the bits in which they differ, are left out.
    """
    found = blocks.groupBy("block").agg(F.min("line").alias("lead"), F.count("*").alias("lines"), F.min("n").alias("n"), F.max("n").alias("m"), F.bit_xor("odd").alias("odd"), F.count("odd").alias("told"))
    apart = (F.col("n") < _alike("m")) | ((F.col("told") == 2) & (F.bit_count("odd") > F.col("n") + F.col("m") - 2 * _alike("m")))
    return found.where((F.col("lines") > 2) | ((F.col("lines") == 2) & ~apart)).select("block", "lead", (F.col("lines") > 2).alias("many"))


def _alike(n: Column | str) -> Column:
    """Of n words, how many at least a near line of no more words shares."""
    return F.ceil((F.col(n) if isinstance(n, str) else n) * SIMILAR - 1e-9)


def rarest(texts: DataFrame) -> DataFrame:
    """texts (line, norm and others) with tokens in place of norm: of its words in an order of all words, the first.

    They are a fifth and one more, so near lines share one of them: at most a fifth of a line's words are not in the
    other. A word that a line repeats is another token each time. Any order will do, and rare words first is the quickest.
    """
    place = lambda w: F.xxhash64(w).bitwiseAND(F.lit(PLACES - 1)).cast("int")
    some = texts.where(F.pmod(F.xxhash64("line"), F.lit(ONE_OF)) == 0).select(F.explode(F.split("norm", " ")).alias("a"))
    counts = some.groupBy(place(F.col("a")).cast("long").alias("id")).agg(F.count("*").alias("n"))
    every = texts.sparkSession.range(PLACES).join(counts, "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("n"))
    often = every.agg(F.sort_array(F.collect_list(F.struct("id", "n")))["n"].alias("_often"))  # one row of fixed size
    ranked = lambda w: F.sort_array(F.transform(w, lambda a: F.struct(F.get("_often", place(a)).alias("n"), F.xxhash64(a).alias("h"))))
    first = lambda o: F.slice(ranked(o["w"]), 1, (F.size(o["w"]) - _alike(F.size(o["w"])) + 1).cast("int"))
    told = lambda few: F.transform(few, lambda s, i: F.hash(s["h"], i.cast("long") - F.array_position(few, s)))
    tokens = F.transform(F.transform(F.array(F.struct(F.split("norm", " ").alias("w"))), first), told)[0]
    return texts.crossJoin(F.broadcast(often)).withColumn("tokens", tokens).drop("norm", "_often")


def _simhash(n: str) -> Column:
    """The fingerprint: each sum counts four bits of the words' hashes, in lanes 16 bits apart; a bit is set if most words have it."""
    out = None
    for i in range(SUMS):
        for lane in range(LANES):
            count = F.shiftrightunsigned(F.col(f"s{i}"), 16 * lane).bitwiseAND(F.lit(MOST - 1))
            bit = F.when(count * 2 > F.col(n), F.lit(1 << (i + 16 * lane))).otherwise(F.lit(0)).cast("long")
            out = bit if out is None else out.bitwiseOR(bit)
    return out


def prints(texts: DataFrame) -> DataFrame:
    """For every line (line, norm) of four words or more: line, n (words), simhash and sketches.

    Each word flips one bit of the sketches: an edit flips two of their 512 bits at most.
    """
    split = texts.select("line", F.split("norm", " ").alias("w")).select("line", F.size("w").alias("n"), "w").where("n >= 4")
    words = split.select("line", "n", F.explode("w").alias("a")).select("line", "n", F.xxhash64(F.lit(7), "a").alias("h"), F.shiftrightunsigned(F.xxhash64("a"), 8).bitwiseAND(F.lit(511)).alias("at"))
    bit = _shift("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(63)).cast("int"))
    words = words.select("line", "n", "h", F.shiftrightunsigned("at", 6).alias("of"), bit.alias("bit"))
    lanes = F.lit(sum(1 << 16 * lane for lane in range(LANES)))
    sums = [F.sum(F.shiftrightunsigned("h", i).bitwiseAND(lanes)).alias(f"s{i}") for i in range(SUMS)]
    odd = [F.bit_xor(F.when(F.col("of") == i, F.col("bit")).otherwise(F.lit(0).cast("long"))).alias(f"x{i}") for i in range(8)]
    return words.groupBy("line", "n").agg(*sums, *odd).select("line", "n", _simhash("n").alias("simhash"), *SKETCH)


def _met(one: str, two: str) -> Column:
    """Whether two lines may be near, by their numbers of words, sketches and SimHashes."""
    n, m = F.col(f"{one}.n"), F.col(f"{two}.n")
    alike = _alike(F.greatest(n, m))
    apart = lambda c: F.bit_count(F.col(f"{one}.{c}").bitwiseXOR(F.col(f"{two}.{c}")))
    flipped = sum((apart(c) for c in SKETCH[1:]), apart(SKETCH[0]))
    return (F.least(n, m) >= alike) & (flipped <= n + m - 2 * alike) & ((F.greatest(n, m) >= MOST) | (apart("simhash") <= BITS))


def _letters(places: Column) -> Column:
    """A text with one letter for each number below 15 * 2 ** 16: edit distance over words is then one over letters."""
    return F.decode(F.unhex(F.concat(F.lit("000"), F.array_join(F.transform(places, lambda at: F.hex(at + 0x10000)), "000"))), "UTF-32")


def near(x: Column, y: Column) -> Column:
    """Whether the edit distance of two lists of words leaves them similar enough. Different words never count as equal.

    Words become letters by a hash, which can only make lists seem nearer. Where two words of a near pair share a
    letter, letters are dealt again by the words' places among those of both.
    """
    hashed = lambda words: F.transform(words, lambda w: F.xxhash64(w).bitwiseAND(F.lit((1 << 19) - 1)))
    placed = lambda words, all_: F.transform(words, lambda w: F.array_position(all_, w))
    within = lambda u, v, most: F.call_function("levenshtein", _letters(u), _letters(v), most) >= 0
    longer = F.greatest(F.size(x), F.size(y))
    once = F.array(F.struct(x.alias("x"), y.alias("y"), hashed(x).alias("u"), hashed(y).alias("v"), (longer - _alike(longer)).cast("int").alias("most")))

    def told(s: Column) -> Column:
        names = F.array_distinct(F.concat(s["x"], s["y"]))
        apart = F.size(F.array_distinct(F.concat(s["u"], s["v"]))) == F.size(names)
        sure = apart | F.exists(F.array(names), lambda all_: within(placed(s["x"], all_), placed(s["y"], all_), s["most"]))
        # in long lines the words they do not share are a bound worth its time
        few = (s["most"] < 100) | ((F.size(F.array_except(s["u"], s["v"])) <= s["most"]) & (F.size(F.array_except(s["v"], s["u"])) <= s["most"]))
        return F.when(few & within(s["u"], s["v"], s["most"]), sure).otherwise(F.lit(False))

    # words that differ place by place are a bound on the distance
    replaced = lambda s: (F.size(s["x"]) == F.size(s["y"])) & (F.size(F.filter(F.zip_with(s["x"], s["y"], lambda u, v: u != v), lambda differs: differs)) <= s["most"])
    return F.exists(once, lambda s: replaced(s) | told(s))


def _met_by(sides: DataFrame) -> DataFrame:
    """Pairs (a, b) of lines of different groups that share a key and may be near; one of them is out.

    sides has key, own (group), out, print and keys: lines that share several keys meet in the least of them alone,
    but for those with keys null.
    """
    outer = sides.where("out").select("key", F.col("own").alias("own1"), F.col("print").alias("one"), F.col("keys").alias("keys1"))
    inner = sides.select("key", F.col("own").alias("own2"), F.col("out").alias("out2"), F.col("print").alias("two"), F.col("keys").alias("keys2"))
    once = F.coalesce(F.col("key") == F.array_min(F.array_intersect("keys1", "keys2")), F.lit(True))
    met = outer.join(inner, "key").where((F.col("own1") != F.col("own2")) & (~F.col("out2") | (F.col("own1") < F.col("own2"))) & _met("one", "two") & once)
    return met.select(F.col("one.line").alias("a"), F.col("two.line").alias("b"))


def _led_by(sides: DataFrame) -> DataFrame:
    """Pairs (a, b) of each line of sides with the least one that is out and shares its key, of another group and maybe near."""
    lead = sides.where("out").groupBy("key").agg(F.min(F.struct("print", "own")).alias("new"))
    led = sides.join(lead, "key").where((F.col("own") != F.col("new.own")) & _met("print", "new.print"))
    return led.select(F.col("print.line").alias("a"), F.col("new.print.line").alias("b"))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of lines that are near. A line b with very many pairs is salted, so they need no common task."""
    counts = pairs.groupBy(F.col("b").alias("hot")).agg(F.count("*").alias("n"))
    total = pairs.count()
    hot = F.broadcast(counts.where((F.col("n") >= PART) & (F.col("n") * PART >= total)).select("hot"))  # PART rows at most
    salt = F.when(F.col("hot").isNotNull(), F.pmod(F.xxhash64("a"), F.lit(SALTS))).otherwise(F.lit(0).cast("long"))
    salted = pairs.join(hot, F.col("b") == F.col("hot"), "left").select("a", "b", salt.alias("salt"))
    ends = texts.join(pairs.select(F.col("b").alias("line")).distinct().hint("shuffle_hash"), "line").join(hot, F.col("line") == F.col("hot"), "left")
    salts = F.when(F.col("hot").isNotNull(), F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    right = ends.select(F.col("line").alias("b"), F.col("norm").alias("y"), F.explode(salts).alias("salt"))
    both = salted.join(right, ["b", "salt"]).select("a", "b", "y")
    left = texts.select(F.col("line").alias("a"), F.col("norm").alias("x"))
    both = left.join(both.hint("shuffle_hash"), "a").select("a", "b", F.array(F.struct(F.split("x", " ").alias("x"), F.split("y", " ").alias("y"))).alias("two"))
    return both.where(F.exists("two", lambda s: near(s["x"], s["y"]))).select("a", "b")


def groups(docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two tables: places (key, mark, at, line) of all lines compared, and (node, component) of lines with near ones."""
    rows = scratch.keep(compared(docs, key, text), "rows")
    lined = scratch.keep(keyed(rows), "keyed")
    blocks = lined.select("line", "n", "odd", F.explode("blocks").alias("block"))
    # written, so that joins on a block that very many lines share can be split
    lead = scratch.keep(leads(blocks), "lead")
    shared = scratch.keep(blocks.select("line", "block").join(lead, "block"), "shared")
    scratch.drop("keyed", "lead")
    needed = scratch.keep(shared.select("line").distinct(), "needed")
    some = perhaps(rows.select("line", "norm"), needed, ["line"]).distinct().join(needed.hint("shuffle_hash"), "line")
    # bucketed by line: neither the words' aggregation nor the joins of pairs with their texts move the texts again
    texts = scratch.bucketed(some, "texts", "line", "zstd", dealt=True)
    found = scratch.keep(prints(texts), "prints")
    print_ = F.struct("line", "n", "simhash", *SKETCH)

    def verified(pairs: DataFrame, turn: int | str) -> DataFrame:
        """The pairs (a, b) that are near; prints rule most of the others out, from the last turn on before the pairs are made."""
        one, two = (found.select(F.col("line").alias(c), print_.alias(p)) for c, p in (("a", "one"), ("b", "two")))
        some = pairs.distinct() if turn == "crowd" else pairs if turn == TURNS else pairs.distinct().join(one, "a").join(two, "b").where(_met("one", "two")).select("a", "b")
        return scratch.keep(_verified(scratch.keep(some, f"pairs{turn}"), texts), f"edges{turn}")

    led = shared.where("line <> lead").select(F.col("line").alias("a"), F.col("lead").alias("b"))
    labels = components(verified(led, 0), scratch, "first")
    for turn in range(1, TURNS + 1):
        # lines of the leader's group need not meet each other: only the others meet
        own = labels.select(F.col("node").alias("line"), F.col("component").alias("own"))
        of = labels.select(F.col("node").alias("lead"), F.col("component").alias("of"))
        some = shared if turn == TURNS else shared.where("many")  # two lines have met already
        named = some.join(own, "line", "left").join(of, "lead", "left").select("block", "line", F.coalesce("own", "line").alias("own"), F.coalesce("of", "lead").alias("of"))
        named = scratch.keep(named.withColumn("out", F.col("own") != F.col("of")), f"named{turn}")
        lead = scratch.keep(named.where("out").groupBy("block").agg(F.min(F.struct("line", "own")).alias("new"), (F.count("*") >= CROWD).alias("crowded")), f"lead{turn}")
        mixed = named.join(lead, "block")
        if turn < TURNS:  # one of them leads all that are not of its group
            pairs = mixed.where(F.col("own") != F.col("new.own")).select(F.col("line").alias("a"), F.col("new.line").alias("b"))
        else:  # all that are left
            marked = found.select("line", print_.alias("print"))
            few = mixed.where("not crowded")
            sides = few.groupBy("line").agg(F.min("own").alias("own"), F.collect_list(F.struct("block", "out")).alias("at")).join(marked, "line")
            sides = sides.select("own", "print", F.col("at.block").alias("keys"), F.inline("at")).withColumnRenamed("block", "key")
            pairs = _met_by(scratch.keep(sides, "sides"))
            crowd = scratch.keep(mixed.where("crowded").groupBy("line").agg(F.max("out").alias("out")), "crowd")
            if crowd.limit(1).count():
                keys = F.when(F.size("tokens") <= CARRIED, F.col("tokens"))
                told = scratch.keep(rarest(texts.join(crowd, "line")).join(marked, "line").select("line", "out", "print", "tokens"), "tokens")
                grouped = lambda own: told.join(own, told["line"] == own["node"], "left").select(F.coalesce("component", "line").alias("own"), "out", "print", keys.alias("keys"), F.explode("tokens").alias("key"))
                # lines of a rare word meet one of them first: then most of what is near is one group
                labels = extended(labels, verified(_led_by(grouped(labels)), "crowd"), scratch, "crowded")
                pairs = pairs.unionByName(_met_by(grouped(labels))).distinct()
        labels = extended(labels, verified(pairs, turn), scratch, f"more{turn}")
        scratch.drop(f"named{turn}", f"lead{turn}")
    scratch.drop("texts", "prints", "shared", "needed", "sides", "crowd", "tokens")
    return rows.drop("norm"), labels


def dedup(docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", removed: str = "removed_lines") -> DataFrame:
    """The documents with one occurrence of every line: text without the others, and removed_lines, their number.

    Of a group of equal or near lines the occurrence in the smallest key (null first), and there the first, stays.
    Lines without a letter or digit and null texts are never touched; a text that loses nothing is unchanged, one that
    loses all is empty. Lines of fewer than five words have no near lines but equal ones and one of five words from
    which a word is gone. Rows that repeat key and text count as one row and keep the same lines. A very long line is
    a line like any other; the time of a comparison grows with the square of its words. An empty table gives an empty
    one. All columns stay; an earlier one named as removed says is replaced.
    """
    places, labels = groups(docs, scratch, key, text)
    here = F.struct("key", "mark", "at")
    lines = scratch.keep(places.groupBy("line").agg(F.min(here).alias("first"), F.count("*").alias("places")), "lines")
    several = scratch.keep(lines.join(labels.withColumnRenamed("node", "line"), "line").select("line", "first", "places", "component"), "several")
    lowest = scratch.keep(several.groupBy("component").agg(F.min("first").alias("lowest"), F.count("*").alias("lines")), "lowest")
    moved = join_hot(several, lowest, "component", "lines").select("line", "places", F.col("lowest").alias("first"))
    same = lines.where("places > 1").join(several.select("line"), "line", "left_anti").select("line", "places", "first")
    told = scratch.keep(moved.unionByName(same), "told")
    gone = join_hot(places, told, "line", "places").where(~here.eqNullSafe(F.col("first")))
    gone = gone.groupBy(F.col("key").alias("_key"), F.col("mark").alias("_mark")).agg(F.collect_set("at").alias("_gone"))
    gone = scratch.keep(gone, "gone")
    scratch.drop("rows", "lines", "several", "lowest", "told")
    docs = docs.drop(removed)
    mark = F.xxhash64(text)
    same = F.col(key).eqNullSafe(F.col("_key")) & (mark == F.col("_mark"))
    marks = gone.select(F.col("_mark").alias("_own"))
    every = F.split(F.col(text), "\n")
    rest = F.struct(every.alias("lines"), F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col("_gone")).alias("left"))
    left = F.transform(F.array(rest), lambda s: F.array_join(F.transform(s["left"], lambda i: F.get(s["lines"], i)), "\n"))[0]
    kept = F.when(F.col("_gone").isNull(), F.col(text)).otherwise(left)
    columns = [kept.alias(c) if c == text else F.col(c) for c in docs.columns]
    changed = perhaps(docs.withColumn("_own", mark), marks, ["_own"]).drop("_own").join(gone, same, "left")
    others = perhaps(docs.withColumn("_own", mark), marks, ["_own"], others=True).drop("_own")
    changed = changed.select(*columns, F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias(removed))
    return changed.unionByName(others.withColumn(removed, F.lit(0).cast("long")))
