"""Exact Jaccard join of documents on word n-grams, size-aware.

A document is the set of its distinct word n-grams, each a 64-bit hash. Two sets
link if ``den * |A and B| >= num * |A or B|``. Equal sets are one set from the start.

*Light* sets: linked sets share a subset of a size that follows from their two
sizes. All subsets of these sizes are enumerated (by the sum of their hashes, so a
subset is a sum less a few terms), and sets meet at equal subsets.

*Heavy* sets are cut into more parts of the hash space than linked sets can differ
in, so linked sets agree in at least one whole part; the parts key inverted lists,
which are scanned. Parts that hold nothing would agree by chance: a few more parts
than needed make up for them, and a set with still more empty ones is cut anew
by another hash.

*Lists by chance.* Two sets that share no more than a common passage agree in a part or
two by chance, the more often the more documents there are. So large sets are cut into
``2 * free`` more parts: linked sets share at least ``2 * free + 1`` lists of one kind (class
and cut), and each set may leave ``free`` of them unread, those whose pivots it meets
least often. One list that both read is left.

The *boundary* is the smallest size at which the subsets of a set cost more than its
entries in the lists, an entry counting ``LIST_COST`` subsets as its sets have to
be compared.

*Scanning without all pairs.* In each list every set is compared with one set only,
the one that is most at home in its lists. Let ``D(X)`` be what X and that pivot P do
not share. For X, Y of one list, what X and Y do not share is what ``D(X)`` and
``D(Y)`` do not share. If both link with P they are connected already. Otherwise
they can only link if the differences overlap, by a number that follows from the
sizes: the differences, rarest element first, are joined on their leading elements
(prefix and position filter), and the survivors compared exactly. So a group of
near copies costs its size, not its square, and no link is lost. Sets far from
their pivot, which share little but a common passage with it, meet again under another
cut, once for all such pivots. They agree by chance most of all, in each list with another
set, so that cut has small parts, of ``PART`` elements, and more of them are left unread: a
pivot takes a good share of a set's lists, and few pivots are left however large the group.

Defined results for odd input: a NULL, empty or blank text has the empty set, is
linked with nothing and its component is its own id; a row without an id links
with nothing and has no component; repeated rows are equal sets; other columns are
never read. Hashes stand for n-grams and, for a whole set, for the set: an error
needs two of 2**64 values to meet.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanvec.llm.graph import components
from spanvec.llm.labelled import texts_of
from spanvec.session import discard, materialize

LIST_COST = 4
CLASS_GROWTH = 1.25
LEVELS = 4
#: Lists of a kind that a set may leave unread, as a share of the parts that linked sets can differ in.
FREE = 0.05
#: Elements in a part of the second cut, where linked sets can spare as many parts.
PART = 3
#: The last byte of a key names its kind: class (the last ones together) and cut, or a subset.
KIND, SUBSET = 255, 255
#: As many ids are sent to the scan of the texts; for more, the texts are shuffled to them.
IDS_TO_SEND = 4_000_000
#: Sets whose differences a task holds at a time.
COMPARED_ROWS = 256
#: Bytes of text that are cut into n-grams at a time, one text at least; the arrays take a multiple.
TEXT_BYTES = 1 << 20
#: Buckets that the elements of a pivot's differences are dealt into, for a group of any size.
BUCKET = 8

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
ODD = 0x100000001B3
GOLDEN = 0x9E3779B97F4A7C15


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    h = h + np.uint64((GOLDEN * (salt + 1)) & (2**64 - 1))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text; words end at ASCII white space, A-Z are lower-cased."""
    raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    text_ends = np.cumsum([len(r) + 1 for r in raw])
    inside = ~SPACE[data]
    before = np.concatenate([[False], inside[:-1]])
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(~inside & before)
    if not len(starts):
        return [np.zeros(0, np.uint64) for _ in texts]
    lengths = ends - starts
    place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    power = np.cumprod(np.full(int(lengths.max()), ODD, np.uint64))
    letters = data[inside].astype(np.uint64) * power[place]
    words = mix(np.add.reduceat(letters, np.cumsum(lengths) - lengths) + lengths.astype(np.uint64))
    upto = np.searchsorted(starts, text_ends)
    grams = np.zeros(len(words), np.uint64)
    for i in range(min(size, len(words))):
        grams[: len(words) - i] += words[i:] * np.uint64(pow(GOLDEN, i + 1, 2**64))
    grams = mix(grams, size)
    found = []
    for begin, end in zip([0, *upto[:-1]], upto, strict=True):
        n = end - begin
        if n >= size:
            found.append(np.unique(grams[begin : end - size + 1]))
        elif n:
            places = np.array([pow(GOLDEN, i + 1, 2**64) for i in range(n)], np.uint64)
            found.append(mix(np.add.reduce(words[begin:end] * places, keepdims=True), int(n)))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


@dataclass(frozen=True)
class Jaccard:
    """A threshold ``num / den`` and the sizes, subsets and parts that follow from it."""

    num: int
    den: int

    def most_apart(self, sizes: int) -> int:
        """How many elements two linked sets of together ``sizes`` do not share, at most."""
        return sizes * (self.den - self.num) // (self.den + self.num)

    def partners(self, n: int) -> range:
        return range(max(1, -(-n * self.num // self.den)), n * self.den // self.num + 1)

    def subset_sizes(self, n: int, below: int) -> set[int]:
        """What a set of ``n`` shares, at least, with linked sets of a size under ``below``."""
        need = {-(-self.num * (n + b) // (self.num + self.den)) for b in self.partners(n) if b < below}
        return {c for c in need if 0 < c <= n}

    def classes(self, largest: int, cut: int = 0) -> list[tuple[int, int, int, int, int]]:
        """``first, last, parts, spare, free``: for linked pairs whose smaller set has ``first`` to ``last`` elements."""
        out, first = [], max(1, -(-heavy_from(self) * self.num // self.den))
        while first <= largest:
            last = int(first * CLASS_GROWTH)
            apart = last * (self.den - self.num) // self.num
            free = int((apart + 1) * FREE + 0.5)
            if cut:
                free = max(free, (first // PART - apart - 1) // 2)
            needed = apart + 1 + 2 * free
            spare = math.ceil(2 * needed * math.exp(-first / needed))
            out.append((first, last, needed + spare, spare, free))
            first = last + 1
        return out

    def free_of_kinds(self, cut: int = 0) -> list[int]:
        """How many lists of each kind a set may leave unread; none of the subsets."""
        first, free = 0, []
        while len(free) * LEVELS < KIND:
            first = first * 2 or 64
            free = [c[4] for c in self.classes(first, cut)]
        return [free[kind // LEVELS] if kind // LEVELS < KIND // LEVELS else 0 for kind in range(KIND + 1)]


@lru_cache
def heavy_from(rule: Jaccard) -> int:
    """The smallest size whose subsets cost more than its entries in the lists."""
    n = 1
    while True:
        subsets = sum(math.comb(n, c) for c in rule.subset_sizes(n, 10**9))
        if subsets > LIST_COST * 2 * (n * (rule.den - rule.num) // rule.num + 2):
            return n
        n += 1


@lru_cache
def _subset_sizes(rule: Jaccard, n: int) -> tuple[int, ...]:
    return tuple(sorted(rule.subset_sizes(n, heavy_from(rule))))


@lru_cache
def _classes_of(rule: Jaccard, n: int, cut: int) -> tuple[tuple[int, int, int, int], ...]:
    """``kind, first, parts, spare`` of the classes in which a set of ``n`` may be the smaller or the larger one."""
    classes = enumerate(rule.classes(n, cut))
    return tuple((LEVELS * min(i, KIND // LEVELS - 1), c[0], *c[2:4]) for i, c in classes if c[0] <= n <= c[1] * rule.den // rule.num)


def _of_kind(key: np.ndarray, kind: int | np.ndarray) -> np.ndarray:
    return (key & ~np.uint64(KIND)) | np.asarray(kind, np.uint64)


def _whole(h: np.ndarray) -> np.uint64:
    return np.add.reduce(mix(h, 99)) if len(h) else np.uint64(0)


def fingerprint(h: np.ndarray) -> int:
    value = mix(np.array([_whole(h) + np.uint64(len(h))], np.uint64), 98)[0]
    return int(value.astype(np.int64))


def light_keys(h: np.ndarray, rule: Jaccard) -> np.ndarray:
    """A key for each subset of each needed size."""
    n, terms = len(h), mix(h, 99)
    total, out = np.add.reduce(terms), []
    for c in _subset_sizes(rule, n):
        left_out = n - c
        if left_out == 0:
            sums = np.array([total])
        elif left_out == 1:
            sums = total - terms
        else:
            rows = np.array(list(itertools.combinations(range(n), left_out)))
            sums = total - np.add.reduce(terms[rows], 1)
        out.append(_of_kind(mix(sums, 1000 + c), SUBSET))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def heavy_keys(h: np.ndarray, rule: Jaccard, cut: int = 0) -> np.ndarray:
    """A key for each part of the set, for each class of sizes it may meet, under the first or another cut."""
    out = []
    for kind, first, parts, spare in _classes_of(rule, len(h), cut):
        edges = (np.arange(1, parts, dtype=np.float64) * (2.0**64 / parts)).astype(np.uint64)
        for level in range(cut * LEVELS, (cut + 1) * LEVELS):
            g = h if level == 0 else np.sort(mix(h, 200 + level))
            at = np.concatenate([[0], np.searchsorted(g, edges), [len(g)]])
            sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(g, 99))])
            count = np.diff(at)
            key = mix(sums[at[1:]] - sums[at[:-1]] + mix(count.astype(np.uint64), 3) + mix(np.arange(parts, dtype=np.uint64), first), 2000 + level)
            key = _of_kind(key, kind + level % LEVELS)
            # Empty parts only count where every cut has had too many of them.
            all_count = level % LEVELS == LEVELS - 1
            out.append(key if all_count else key[count > 0])
            if (count == 0).sum() <= spare:
                break
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def keys(h: np.ndarray, rule: Jaccard, cut: int = 0) -> np.ndarray:
    n = len(h)
    if not n:
        return np.zeros(0, np.uint64)
    light = light_keys(h, rule) if n < heavy_from(rule) else np.zeros(0, np.uint64)
    return np.unique(np.concatenate([light, heavy_keys(h, rule, cut)]))


def _lists(lists: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    flat = np.concatenate(lists) if lists else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64), pa.int64()))


def _text_hash() -> Column:
    return F.xxhash64(F.col("text").cast("string")).alias("hash")


def read_sets(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, hash, n, fp`` of every document: a hash of its text, size and fingerprint of its set."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in texts_of(batches, 2, TEXT_BYTES):
            sets = shingle_sets(texts, size)
            sizes, prints = pa.array([len(h) for h in sets], pa.int64()), pa.array([fingerprint(h) for h in sets], pa.int64())
            yield pa.RecordBatch.from_pydict({"doc_id": part.column(0), "hash": part.column(1), "n": sizes, "fp": prints})

    return docs.select("doc_id", _text_hash(), F.col("text").cast("string")).mapInArrow(run, f"doc_id {kind}, hash bigint, n bigint, fp bigint")


def read_entries(docs: DataFrame, size: int, rule: Jaccard) -> DataFrame:
    """``key, fp``: the subsets and parts of every set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in texts_of(batches, 0, TEXT_BYTES):
            sets = shingle_sets(texts, size)
            prints = pa.array([fingerprint(h) for h in sets], pa.int64())
            yield pa.RecordBatch.from_pydict({"fp": prints, "keys": _lists([keys(h, rule) for h in sets])})

    texts = docs.where("doc_id is not null").select(F.col("text").cast("string"))
    return texts.mapInArrow(run, "fp bigint, keys array<bigint>").select(F.explode("keys").alias("key"), "fp")


def texts_by_set(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """``fp, text``: a text of each set of some documents; it takes less room than the set's elements."""
    texts = docs.select("doc_id", F.col("text").cast("string"))
    few = ids.count() <= IDS_TO_SEND
    texts = texts.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in texts_of(batches, 0, TEXT_BYTES):
            sets = shingle_sets(texts, size)
            prints = pa.array([fingerprint(h) if len(h) else None for h in sets], pa.int64())
            yield pa.RecordBatch.from_pydict({"fp": prints, "text": part.column(0)})

    named = texts.mapInArrow(run, "fp bigint, text string").where("fp is not null")
    return named.groupBy("fp").agg(F.first("text").alias("text"))


_COMPARED = "x bigint, p bigint, nx bigint, np bigint, apart bigint, d array<bigint>, keys array<bigint>"


def _compare(rule: Jaccard, size: int, last: bool):
    """What a set and its pivot do not share, if that is little, and new keys, if it is much.

    Let the pivot have n elements. A set within ``near`` of it and one beyond ``far``
    differ too much to link, as differences add up; sets between the two count as both.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Differences are handed on a few at a time: a row may hold thousands of elements.
        parts = (batch.slice(at, COMPARED_ROWS) for batch in batches for at in range(0, batch.num_rows, COMPARED_ROWS))
        for batch, texts in texts_of(parts, 2, TEXT_BYTES):
            x, p = batch.column(0), batch.column(1)
            sets, of_pivots = shingle_sets(texts, size), shingle_sets(batch.column(3).to_pylist(), size)
            rows: list[tuple] = []
            for own, other in zip(sets, of_pivots, strict=True):
                apart = np.setxor1d(own, other, assume_unique=True)
                near = 2 * len(other) * (rule.den - rule.num) // rule.num
                far = near + (len(other) + near) * (rule.den - rule.num) // rule.num + 1
                again = None
                if len(apart) > near and not last:
                    again = keys(own, rule, 1).view(np.int64)
                rows.append((len(own), len(other), len(apart), apart.view(np.int64) if last or len(apart) <= far else None, again))
            nx, n_p, apart, d, again = zip(*rows, strict=True) if rows else [()] * 5
            kind = pa.list_(pa.int64())
            counts = [pa.array(c, pa.int64()) for c in (nx, n_p, apart)]
            yield pa.RecordBatch.from_arrays([x, p, *counts, pa.array(d, kind), pa.array(again, kind)], ["x", "p", "nx", "np", "apart", "d", "keys"])

    return run


def _most_apart(sizes: Column, rule: Jaccard) -> Column:
    return F.floor(sizes * (rule.den - rule.num) / F.lit(float(rule.den + rule.num)) + F.lit(1e-9))


def _linked(rule: Jaccard) -> Column:
    return F.col("apart") <= _most_apart(F.col("nx") + F.col("np"), rule)


_DEALT = "p bigint, s bigint, x bigint, nx bigint, apart bigint, linked boolean, es array<bigint>"


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``p, s, x, nx, apart, linked, es``: the elements of each difference that fall into bucket ``s`` of its pivot."""
    for batch in batches:
        d = batch.column("d")
        e = d.flatten().to_numpy()
        row = np.repeat(np.arange(batch.num_rows), d.value_lengths().to_numpy())
        bucket = (e.view(np.uint64) % np.uint64(BUCKET)).astype(np.int64)
        order = np.lexsort((bucket, row))
        e, row, bucket = e[order], row[order], bucket[order]
        new = np.concatenate([[True], (row[1:] != row[:-1]) | (bucket[1:] != bucket[:-1])])[: len(e)]
        starts = np.flatnonzero(new)
        part = batch.select(["p", "x", "nx", "apart", "linked"]).take(pa.array(row[starts]))
        es = pa.ListArray.from_arrays(pa.array(np.append(starts, len(e)), pa.int32()), pa.array(e, pa.int64()))
        columns = {name: part.column(name) for name in ("x", "nx", "apart", "linked")}
        yield pa.RecordBatch.from_pydict({"p": part.column("p"), "s": pa.array(bucket[starts], pa.int64()), **columns, "es": es})


def links_by_difference(compared: DataFrame, rule: Jaccard) -> DataFrame:
    """``x, y``: links between sets of one pivot that are not both linked with it.

    Elements move as lists: the elements of a difference are dealt into ``BUCKET`` rows at
    most, however large its group, so the rows grow with the sets. A bucket is sorted and
    streamed, never held.
    """
    linked = _linked(rule).alias("linked")
    of_pivot = compared.where("d is not null").select("p", "apart", linked).groupBy("p")
    several = of_pivot.agg(F.count("*").alias("n"), F.bool_and("linked").alias("all"))
    several = _step(several.where("n > 1 and not all").select("p"))
    rows = compared.where("d is not null").select("x", "p", "nx", "apart", "d", linked)
    dealt = rows.join(several, "p").mapInArrow(_deal, _DEALT).repartition(F.col("p"), F.col("s"))
    # Only elements of several sets, one of them not linked with the pivot, make candidates.
    of_element = Window.partitionBy("p", "s", "e")
    own = dealt.select("p", "s", "x", "nx", "apart", "linked", F.explode("es").alias("e"))
    own = own.withColumn("often", F.count("*").over(of_element)).withColumn("all", F.bool_and("linked").over(of_element))
    own = own.where("often > 1 and not all").groupBy("p", "s", "x", "nx", "apart", "linked")
    shared = own.agg(F.collect_list(F.struct("often", "e")).alias("es")).groupBy("p", "x", "nx", "apart", "linked")
    # The rarest elements come first; the others are known by their number.
    shared = shared.agg(F.sort_array(F.flatten(F.collect_list("es"))).alias("es"))
    reach = F.floor(F.col("nx") * (rule.den - rule.num) / F.lit(float(rule.num)) + F.lit(1e-9))
    overlap = F.greatest(F.lit(1), F.col("apart") - reach)
    leading = (F.size("es") - overlap + 1).cast("int")
    place = (F.col("apart") - F.col("count") + F.col("at") + 1).alias("place")
    prefix = shared.withColumn("count", F.size("es")).where(leading > 0)
    prefix = prefix.select("p", "x", "nx", "apart", "linked", "count", F.posexplode(F.slice("es", F.lit(1), leading)).alias("at", "of"))
    # Written, as both sides of a join may each explode the differences anew.
    prefix = _step(prefix.select("p", F.col("of.e").alias("e"), "x", "nx", "apart", "linked", place))
    a, b = prefix.alias("a"), prefix.alias("b")
    rest = F.lit(1) + F.least(F.col("a.apart") - F.col("a.place"), F.col("b.apart") - F.col("b.place"))
    need = F.col("a.apart") + F.col("b.apart") - _most_apart(F.col("a.nx") + F.col("b.nx"), rule)
    met = (F.col("a.p") == F.col("b.p")) & (F.col("a.e") == F.col("b.e")) & (F.col("a.x") < F.col("b.x"))
    met = met & ~(F.col("a.linked") & F.col("b.linked")) & (2 * rest >= need)
    pairs = _step(a.join(b, met).select("a.p", F.col("a.x").alias("x"), F.col("b.x").alias("y")).distinct())
    discard(several, prefix)
    of_x = rows.select("p", "x", "nx", F.col("d").alias("dx"))
    of_y = rows.select("p", F.col("x").alias("y"), F.col("nx").alias("ny"), F.col("d").alias("dy"))
    both = pairs.join(of_x, ["p", "x"]).join(of_y, ["p", "y"])
    between = F.size("dx") + F.size("dy") - 2 * F.size(F.array_intersect("dx", "dy"))
    return both.where(between <= _most_apart(F.col("nx") + F.col("ny"), rule)).select("x", "y")


def _step(df: DataFrame) -> DataFrame:
    """A written table; the shuffle files behind it are then no longer needed.

    Spark deletes them when the driver's garbage is collected, which may else take
    until the disks are full.
    """
    out = materialize(df)
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def pivot_pairs(entries: DataFrame, rule: Jaccard, cut: int = 0) -> DataFrame:
    """``x, p``: each set and the pivot of each list that it shares with another set and reads.

    Of each kind a set leaves as many lists unread as linked sets can spare, pivots of
    the fewest lists first. The entries are dealt out once, for the count of each list and for its entries. A
    document has many entries and a list at most one of them, so even a list that a third
    of all documents share is a small part of the rows; it is streamed, never held.
    """
    dealt = entries.repartition(F.col("key"))
    met = dealt.groupBy("key").agg(F.count("*").alias("often"), F.min("fp").alias("a"), F.max("fp").alias("b"))
    met = met.where("a < b").select("key", "often")
    listed = _step(dealt.join(met, "key").groupBy("key", "fp").agg(F.first("often").alias("often")))
    home = listed.groupBy("fp").agg(F.sum("often").alias("home"))
    shared = _step(listed.join(home, "fp").select("key", "fp", "home"))
    discard(listed)
    best = shared.groupBy("key").agg(F.max(F.struct("home", "fp")).alias("best"))
    pivots = best.select("key", F.col("best.fp").alias("p"))
    kind = F.col("key").bitwiseAND(F.lit(KIND)).cast("int").alias("kind")
    lists = shared.join(pivots, "key").where("fp <> p").groupBy("fp", kind, "p").agg(F.count("*").alias("lists"))
    fewest = Window.partitionBy("fp", "kind").orderBy("lists", "p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    free = F.element_at(F.lit(rule.free_of_kinds(cut)), F.col("kind") + 1)
    read = lists.withColumn("upto", F.sum("lists").over(fewest)).where(F.col("upto") > free)
    pairs = _step(read.select(F.col("fp").alias("x"), "p").distinct())
    discard(shared)
    return pairs


def compare_pairs(docs: DataFrame, sets: DataFrame, pairs: DataFrame, size: int, rule: Jaccard, last: bool) -> DataFrame:
    ends = pairs.select(F.col("x").alias("fp")).unionByName(pairs.select(F.col("p").alias("fp"))).distinct()
    ids = sets.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("doc_id")).join(ends, "fp", "left_semi")
    wanted = materialize(ids.select("doc_id").distinct())
    found = texts_by_set(docs, wanted, size)
    by_pivot = pairs.join(found.select(F.col("fp").alias("p"), F.col("text").alias("tp")), "p")
    both = by_pivot.join(found.select(F.col("fp").alias("x"), F.col("text").alias("tx")), "x").select("x", "p", "tx", "tp")
    compared = _step(both.mapInArrow(_compare(rule, size, last), _COMPARED))
    discard(wanted)
    return compared


def linked_sets(docs: DataFrame, sets: DataFrame, size: int, rule: Jaccard) -> DataFrame:
    """``id, component`` of the fingerprints that have links."""
    entries, links, compared = read_entries(docs, size, rule), [], None
    for last in (False, True):
        pairs, before = pivot_pairs(entries, rule, int(last)), compared
        compared = compare_pairs(docs, sets, pairs, size, rule, last)
        by_difference = links_by_difference(compared, rule)
        links.append(_step(compared.where(_linked(rule)).select("x", F.col("p").alias("y")).unionByName(by_difference)))
        # Sets that are far from a pivot meet again under another cut; a set has the same keys at each of its pivots.
        entries = compared.where("keys is not null").select("x", "keys").dropDuplicates(["x"]).select(F.explode("keys").alias("key"), F.col("x").alias("fp"))
        discard(pairs, *([before] if before is not None else []))
    discard(compared)
    return components(reduce(DataFrame.unionByName, links))


def named_sets(docs: DataFrame, size: int, rule: Jaccard) -> DataFrame:
    """``doc_id, hash, n, fp, component`` of every document; the component is a fingerprint."""
    sets = materialize(read_sets(docs, size))
    linked = materialize(linked_sets(docs, sets, size, rule))
    named = sets.join(linked.select(F.col("id").alias("fp"), "component"), "fp", "left")
    return named.withColumn("component", F.coalesce("component", "fp"))


def jaccard_components(docs: DataFrame, *, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``doc_id, n_shingles, component_id``: set size and smallest id that links reach, itself included."""
    named = named_sets(docs, size, Jaccard(num, den))
    first = named.where("n > 0 and doc_id is not null").groupBy("component").agg(F.min("doc_id").alias("first"))
    out = named.join(first, "component", "left")
    own = F.when((F.col("n") == 0) | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("first"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def one_of_each(docs: DataFrame, *, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The documents, all their columns, that are the first of their component, by id and then by text.

    Texts of one id are documents of their own, as far as they are no near copies. Documents
    without words stay; repeated rows of a kept id and text stay one row; rows without an id stay.
    """
    named = named_sets(docs, size, Jaccard(num, den)).where("doc_id is not null")
    key = F.struct("doc_id", "hash")
    first = named.where("n > 0").groupBy("component").agg(F.min(key).alias("first")).select("first.*")
    keep = first.unionByName(named.where("n = 0").select("doc_id", "hash").distinct())
    own = "hash"
    while own in docs.columns:
        own += "_"
    keep = keep.select("doc_id", F.col("hash").alias(own))
    kept = docs.where("doc_id is not null").withColumn(own, _text_hash())
    kept = kept.join(keep, ["doc_id", own], "left_semi").dropDuplicates(["doc_id", own]).select(*docs.columns)
    return kept.unionByName(docs.where("doc_id is null"))
