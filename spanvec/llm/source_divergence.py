"""How far the sources of a language diverge in their terms, with strings joined back late.

Terms are maximal runs of letters and of characters beyond ASCII, A-Z lower-cased. Each
language keeps the terms that occur in at least ``least_docs`` of its documents, V of them.
A group is a language with one of its sources; a group, and the language as a whole, gives
each kept term the share ``p = 1 + floor(10**9 * (count + 2) / (N + 2 * V))``, N being the
group's count over all kept terms. Two shares diverge by
``floor((p - q) * (p - q) / (p + q))``. All arithmetic is in integers.

* part ``pair``: the divergence of each other source of the language, summed over all kept terms;
* part ``term``: the divergence from the language of the terms that a group has more of than the
  language has, the ``top`` largest.

*Late strings.* Tasks count their terms in bounded tables and write them once, by a 64-bit
digest of each term, with the string once for each language. What is shuffled, summed, joined
and ranked from there on are digests; equal values keep their place until the end. The
smallest and the largest string of each digest that is kept show whether terms collide: the
terms of such digests are counted by their strings, from the texts, and told apart by a
number besides the digest. The strings come back only for the rows that may be among the
``top``.

*Pairs of sources* share all kept terms, so the terms of a language are dealt into buckets of
bounded size (by terms and sources), sources into blocks. A task sums the pairs of two
blocks over the terms of a bucket as a matrix; sums of tasks are added up.

Defined results for odd input: a NULL text, language or source is the empty string; a group
without terms has its rows all the same; a language with one source has no pair; equal values
are ranked by item in order of UTF-8; repeated rows are documents of their own; rows without an
id count; only ``text``, ``lang``, ``source`` are read. A count may reach 10**15.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanvec.llm.labelled import texts_of
from spanvec.llm.runs import runs
from spanvec.session import materialize

CHUNK = 4 << 20
#: Counted terms and groups that a task holds before it hands them on.
HELD = 1 << 20
#: Shares of a bucket, and sources of a block.
CELLS = 1 << 17
BLOCK = 256

#: Bytes in lower case, those that are in no term as spaces.
CLEAN = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Numbers(dict):
    """A number for each key, in the order of first use."""

    def __missing__(self, key) -> int:
        self[key] = number = len(self)
        return number


class Counter:
    """Occurrences and documents of the terms of each group."""

    def __init__(self):
        self.terms, self.groups = Numbers(), Numbers()
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, groups: list[tuple[str, str]], texts: list[str | None]) -> None:
        split = [(t or "").encode("utf-8", "surrogatepass").translate(CLEAN).split() for t in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        term = np.fromiter((n for words in split for n in map(self.terms.__getitem__, words)), np.int64, int(sizes.sum()))
        group = np.fromiter(map(self.groups.__getitem__, groups), np.int64, len(groups))
        many = max(len(self.terms), 1)
        in_doc, n = np.unique(np.repeat(np.arange(len(split)), sizes) * many + term, return_counts=True)
        self._keep(group[in_doc // many], in_doc % many, n, np.ones(len(n), np.int64))
        if self.size > HELD:
            self._sum()

    def _keep(self, group, term, n, docs) -> None:
        self.parts.append((group, term, n, docs))
        self.size += len(n)

    def _sum(self) -> None:
        group, term, n, docs = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        many = max(len(self.terms), 1)
        keys, at = np.unique(group * many + term, return_inverse=True)
        sums = np.zeros((2, len(keys)), np.int64)
        np.add.at(sums[0], at, n)
        np.add.at(sums[1], at, docs)
        self.parts, self.size = [], 0
        self._keep(keys // many, keys % many, sums[0], sums[1])

    @property
    def full(self) -> bool:
        return self.size > HELD or len(self.terms) > HELD // 2

    def rows(self, bits: int, strings: bool) -> Iterator[pa.RecordBatch]:
        """Sums by group and digest, and by language and digest with the string; with ``strings`` all by group and string."""
        if not self.size:
            return
        self._sum()
        group, term, n, docs = self.parts[0]
        names = pa.array([t.decode("utf-8", "replace") for t in self.terms], pa.string())
        digests = np.fromiter(map(xxhash.xxh64_intdigest, self.terms), np.uint64, len(self.terms)) & np.uint64((1 << bits) - 1)
        digests = digests.view(np.int64)
        langs, sources = (pa.array([g[i] for g in self.groups], pa.string()) for i in (0, 1))
        for span in _slices(len(n)):
            of, t = pa.array(group[span]), term[span]
            yield _rows(langs.take(of), sources.take(of), digests[t], names.take(pa.array(t)) if strings else None, n[span], docs[span] if strings else None)
        if strings:
            return
        numbers, many = Numbers(), max(len(self.terms), 1)
        lang = np.array([numbers[g[0]] for g in self.groups], np.int64)[group]
        keys, at = np.unique(lang * many + term, return_inverse=True)
        sums = np.zeros(len(keys), np.int64)
        np.add.at(sums, at, docs)
        langs = pa.array(list(numbers), pa.string())
        for span in _slices(len(keys)):
            t = keys[span] % many
            yield _rows(langs.take(pa.array(keys[span] // many)), None, digests[t], names.take(pa.array(t)), None, sums[span])


def _slices(size: int) -> list[slice]:
    return [slice(at, at + 65_536) for at in range(0, size, 65_536)]


def _rows(lang, source, digest, term, n, docs) -> pa.RecordBatch:
    nothing = {"source": pa.string(), "term": pa.string(), "n": pa.int64(), "docs": pa.int64()}
    held = {"lang": lang, "source": source, "digest": pa.array(digest, pa.int64()), "term": term, "n": n, "docs": docs}
    return pa.RecordBatch.from_pydict({c: pa.nulls(len(digest), nothing[c]) if v is None else v for c, v in held.items()})


def _count(batches: Iterator[pa.RecordBatch], bits: int = 64, strings: bool = False) -> Iterator[pa.RecordBatch]:
    counter = Counter()
    for part, texts in texts_of(batches, 2, CHUNK):
        counter.add(list(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)), texts)
        if counter.full:
            yield from counter.rows(bits, strings)
            counter = Counter()
    yield from counter.rows(bits, strings)


def plain(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def counted_terms(docs: DataFrame, bits: int, strings: bool = False) -> DataFrame:
    """``lang, source, digest, term, n, docs``: sums of single tasks, with digests of ``bits`` bits."""
    schema = "lang string, source string, digest bigint, term string, n bigint, docs bigint"
    return plain(docs).mapInArrow(lambda batches: _count(batches, bits, strings), schema)


def kept_terms(docs: DataFrame, least_docs: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """``lang, source, digest, sub, n`` of the kept terms, and the ``term`` of each ``digest, sub``.

    ``sub`` is 0, but for digests that several terms share; these are counted by term.
    """
    counted = materialize(counted_terms(docs, bits))
    of_lang, of_group = counted.where("source is null"), counted.where("source is not null")

    def often(sums: DataFrame, *key: str) -> DataFrame:
        return sums.groupBy("lang", *key).agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs).select("lang", *key)

    kept = materialize(often(of_lang, "digest"))
    strings = of_lang.join(kept.select("digest").distinct(), "digest", "left_semi").groupBy("digest").agg(F.min("term").alias("term"), F.max("term").alias("last"))
    strings = materialize(strings)
    shared = strings.where("term < last").select("digest")
    sums = of_group.join(kept, ["lang", "digest"], "left_semi").groupBy("lang", "source", "digest").agg(F.sum("n").alias("n"))
    sums = sums.select("lang", "source", "digest", F.lit(0).alias("sub"), "n")
    names = strings.select("digest", F.lit(0).alias("sub"), "term")
    if not shared.isEmpty():
        apart = materialize(counted_terms(docs, bits, strings=True).join(shared, "digest", "left_semi"))
        kept = often(apart, "digest", "term")
        place = F.row_number().over(Window.partitionBy("digest").orderBy("term"))
        subs = materialize(kept.select("digest", "term").distinct().withColumn("sub", place))
        split = apart.join(kept, ["lang", "digest", "term"], "left_semi").groupBy("lang", "source", "digest", "term").agg(F.sum("n").alias("n"))
        split = split.join(subs, ["digest", "term"]).select("lang", "source", "digest", "sub", "n")
        sums = sums.join(shared, "digest", "left_anti").unionByName(split)
        names = names.join(shared, "digest", "left_anti").unionByName(subs)
    return materialize(sums), names


def _share(count: str, total: str) -> str:
    """``1 + floor(10**9 * (count + 2) / total)`` as SQL: three digits at a time, so that nothing overflows."""
    rest, value = f"({count} + 2)", "0L"
    for _ in range(3):
        value = f"({value} * 1000L + ({rest} * 1000L) div {total})"
        rest = f"(({rest} * 1000L) % {total})"
    return f"(1L + {value})"


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The same for arrays."""
    rest, value = count + 2, np.zeros_like(count)
    for _ in range(3):
        value = value * 1000 + rest * 1000 // total
        rest = rest * 1000 % total
    return 1 + value


def totals(docs: DataFrame, kept: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Written tables of languages (``lang, terms, total, sources``) and groups (``lang, source, number, total``).

    ``total`` is N + 2 * V, ``number`` counts the sources of a language from 0.
    """
    groups = plain(docs.select("lang", "source", F.lit("").alias("text"))).select("lang", "source").distinct()
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = materialize(groups.withColumn("number", number))
    # Sums of terms first, then of languages: both are combined before they move.
    by_term = kept.groupBy("lang", "digest", "sub").agg(F.sum("n").alias("n"))
    of_lang = by_term.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("n"))
    sizes = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    zero = F.lit(0).cast("bigint")
    langs = sizes.join(of_lang, "lang", "left").select("lang", F.coalesce("terms", zero).alias("terms"), F.coalesce("n", zero).alias("n"), "sources")
    langs = materialize(langs.select("lang", "terms", (F.col("n") + 2 * F.col("terms")).alias("total"), "sources"))
    of_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    held = groups.join(of_group, ["lang", "source"], "left").join(langs.select("lang", "terms"), "lang")
    held = held.select("lang", "source", "number", (F.coalesce("n", zero) + 2 * F.col("terms")).alias("total"))
    return langs, materialize(held)


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the terms of one bucket for the sources of two blocks.

    Rows of sources (side 0: number, total, terms of the bucket), then of terms (side 1: number, digest, sub, count).
    """
    for group in runs(batches, 4):
        lang = group.column(0)[0].as_py()
        a, b = group.column(2)[0].as_py(), group.column(3)[0].as_py()
        side, number, x, y, n = (group.column(i).to_numpy() for i in range(4, 9))
        head = side == 0
        sources = number[head]
        order = np.argsort(sources)
        sources, total, terms = sources[order], x[head][order], int(y[head][0]) if head.any() else 0
        _, term = np.unique(np.stack([x[~head], y[~head]], 1), axis=0, return_inverse=True)
        seen = int(term.max(initial=-1)) + 1
        count = np.zeros((len(sources), seen + 1), np.int64)
        count[np.searchsorted(sources, number[~head]), term.reshape(-1)] = n[~head]
        # The last column is a term that none of these sources has, for all others of the bucket.
        often = np.ones(seen + 1, np.int64)
        often[-1] = terms - seen
        share = shares(count, np.maximum(total, 1)[:, None])
        block = sources // BLOCK
        right = np.flatnonzero(block == b)
        for i in np.flatnonzero(block == a):
            others = right[right > i] if a == b else right
            if not len(others):
                continue
            value = np.zeros(len(others), np.int64)
            step = max(1, CELLS // (seen + 1))
            for at in range(0, len(others), step):
                q = share[others[at : at + step]]
                value[at : at + step] = ((share[i] - q) ** 2 // (share[i] + q)) @ often
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([lang] * len(others), pa.string()), "x": pa.array(np.full(len(others), sources[i]), pa.int64()), "y": pa.array(sources[others], pa.int64()), "value": pa.array(value)}
            )


def pair_rows(kept: DataFrame, langs: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value``: every other source of each group."""
    size = langs.select("lang", F.greatest(F.lit(1), F.ceil(F.col("terms") * F.col("sources") / CELLS)).alias("buckets"), F.ceil(F.col("sources") / BLOCK).alias("blocks"))
    bucket = F.pmod(F.xxhash64("digest", "sub"), F.col("buckets")).alias("bucket")
    in_bucket = kept.select("lang", "digest", "sub").distinct().join(size, "lang").select("lang", bucket).groupBy("lang", "bucket").agg(F.count("*").alias("terms"))
    own, zero = F.floor(F.col("number") / BLOCK), F.lit(0).cast("bigint")
    other = F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("other")
    meets = [F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b")]
    heads = groups.join(size, "lang").select("lang", "number", "total", "blocks", own.alias("own"), F.explode(F.sequence(zero, F.col("buckets") - 1)).alias("bucket"))
    heads = heads.join(in_bucket, ["lang", "bucket"], "left").select("lang", "bucket", "own", other, "number", "total", F.coalesce("terms", zero).alias("terms"))
    heads = heads.select("lang", "bucket", *meets, F.lit(0).alias("side"), "number", F.col("total").alias("x"), F.col("terms").alias("y"), zero.alias("n"))
    cells = kept.join(groups.select("lang", "source", "number"), ["lang", "source"]).join(size, "lang")
    cells = cells.select("lang", bucket, own.alias("own"), other, "number", "digest", F.col("sub").cast("bigint").alias("sub"), "n")
    cells = cells.select("lang", "bucket", *meets, F.lit(1).alias("side"), "number", F.col("digest").alias("x"), F.col("sub").alias("y"), "n")
    keys = ["lang", "bucket", "a", "b"]
    met = heads.unionByName(cells).withColumn("number", F.col("number").cast("bigint")).repartition(*keys).sortWithinPartitions(*keys, "side")
    sums = met.mapInArrow(_pair_sums, "lang string, x bigint, y bigint, value bigint").groupBy("lang", "x", "y").agg(F.sum("value").alias("value"))
    both = sums.select("lang", F.explode(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))).alias("of"), "value").select("lang", "of.x", "of.y", "value")
    named = both.join(groups.select("lang", F.col("number").cast("bigint").alias("x"), "source"), ["lang", "x"])
    return named.join(groups.select("lang", F.col("number").cast("bigint").alias("y"), F.col("source").alias("item")), ["lang", "y"]).select("lang", "source", "item", "value")


def _diverge(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def term_rows(kept: DataFrame, names: DataFrame, langs: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """``lang, source, item, value, rank``: the terms a group has more of than its language."""
    overall = kept.groupBy("lang", "digest", "sub").agg(F.sum("n").alias("all"))
    overall = overall.join(langs.select("lang", "total"), "lang").select("lang", "digest", "sub", F.expr(_share("all", "total")).alias("q"))
    own = kept.where("n > 0").join(groups.select("lang", "source", "total"), ["lang", "source"])
    own = own.select("lang", "source", "digest", "sub", F.expr(_share("n", "total")).alias("p"))
    found = own.join(overall, ["lang", "digest", "sub"]).where("p > q").select("lang", "source", "digest", "sub", _diverge("p", "q").alias("value"))
    # Ties stay until their strings are there.
    tied = F.rank().over(Window.partitionBy("lang", "source").orderBy(F.desc("value")))
    found = found.withColumn("tied", tied).where(F.col("tied") <= top).drop("tied")
    named = found.join(names, ["digest", "sub"]).select("lang", "source", F.col("term").alias("item"), "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return named.withColumn("rank", rank).where(F.col("rank") <= top)


def divergence(docs: DataFrame, *, least_docs: int = 10, top: int = 10, bits: int = 64) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every group of ``text, lang, source``."""
    kept, names = kept_terms(docs, least_docs, bits)
    langs, groups = totals(docs, kept)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = pair_rows(kept, langs, groups).withColumn("rank", rank)
    both = pairs.withColumn("part", F.lit("pair")).unionByName(term_rows(kept, names, langs, groups, top).withColumn("part", F.lit("term")))
    return both.select("lang", "source", "part", "item", "value", "rank")
