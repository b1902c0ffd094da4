"""Benchmark decontamination by a generalised suffix automaton.

Texts are words: maximal runs of digits, letters and characters beyond ASCII, A-Z
lower-cased. A *window* is every run of ``window`` consecutive words of an item; an
item with fewer words, but not none, is one window as a whole. A word of a document is
*hit* if it lies in an occurrence of a window.

The items' words build one generalised suffix automaton, a state of which stands for
runs of words that end at the same places. A document's words are streamed through it:
each word leads to the longest run that ends there and occurs in an item. Where that
run reaches ``window`` words, the last ``window`` are hit, and the state up the suffix
links that holds exactly these words names the items; short items are found on the
same links. Words that no item has, and neighbours that no item has next to each other,
end every run, so only stretches of known neighbours are streamed.

Items are cut into pieces that overlap by a window less a word and dealt into blocks of
about ``block_words`` words, each with an automaton of its own, which is built in a task
and sent to all others: a block has a bounded size. ``BLOCKS`` automata are asked in one
pass over the documents; more blocks take more passes, each with a written table.

``cut`` removes the stretches of hit words that hold a run of at least ``longest`` words,
and drops a document of whose words more than ``coverage`` are hit.

Defined results for odd input: a NULL or empty text has no words and is not hit; an item
without words has no window; an item without an id hits but is not named; items of one
id are one item; repeated rows are matched each; very long texts are one stream. Only
``text`` is read, and ``item_id``, ``text`` of the items; all other columns stay.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanvec.functions.vectors import run_once
from spanvec.llm.runs import runs
from spanvec.session import materialize

BLOCK_WORDS = 200_000
PIECE_WORDS = 4096
BLOCKS = 4
CHUNK = 4 << 20

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Bytes in lower case, those that are in no word as spaces.
CLEAN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SPANS = "array<struct<first:int,last:int,begin:int,end:int,longest:int>>"
FOUND = f"struct<n_words:bigint,spans:{SPANS},items:array<string>>"
_SPAN = pa.struct([(name, pa.int32()) for name in ("first", "last", "begin", "end", "longest")])
_FOUND = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(_SPAN)), ("items", pa.list_(pa.string()))])


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(CLEAN).split()


class Vocabulary(dict):
    """Numbers of the items' words; any other word is -1."""

    def __missing__(self, word: bytes) -> int:
        return -1


@dataclass(frozen=True)
class Automaton:
    """A generalised suffix automaton over word numbers, with the items that each window names."""

    window: int
    least: int  # words of the shortest window
    words: Vocabulary
    go: dict[int, int]  # state * number of words + word
    link: list[int]
    length: list[int]
    anchor: list[int]  # the state up the links that holds the last `window` words
    named: dict[int, list[str | None]]  # items by anchor
    short: dict[int, list[tuple[int, str | None]]]  # whole short items by state
    upper: list[int]  # the nearest state up the links, itself included, with a short item; 0 for none
    pairs: np.ndarray  # known neighbours, sorted

    @staticmethod
    def of(items: list[tuple[str | None, list[bytes]]], window: int) -> Automaton:
        words = Vocabulary()
        link, length, after = [-1], [0], [{}]

        def state(n: int, moves: dict[int, int], up: int) -> int:
            length.append(n)
            after.append(moves)
            link.append(up)
            return len(link) - 1

        def split(at: int, c: int, q: int) -> int:
            """A state for the run of ``at`` and ``c`` alone, taken out of ``q``."""
            clone = state(length[at] + 1, dict(after[q]), link[q])
            link[q] = clone
            while at >= 0 and after[at].get(c) == q:
                after[at][c] = clone
                at = link[at]
            return clone

        def extend(last: int, c: int) -> int:
            q = after[last].get(c)
            if q is not None:
                return q if length[q] == length[last] + 1 else split(last, c, q)
            new, at = state(length[last] + 1, {}, 0), last
            while at >= 0 and c not in after[at]:
                after[at][c] = new
                at = link[at]
            if at >= 0:
                q = after[at][c]
                link[new] = q if length[q] == length[at] + 1 else split(at, c, q)
            return new

        runs_ = []
        for name, item in items:
            numbers = []
            for w in item:
                if w not in words:
                    words[w] = len(words)
                numbers.append(words[w])
            last = 0
            for c in numbers:
                last = extend(last, c)
            if numbers:
                runs_.append((name, numbers))
        anchor, upper = [0] * len(link), [0] * len(link)
        order = sorted(range(1, len(link)), key=length.__getitem__)
        for s in order:
            if length[s] >= window:
                anchor[s] = s if length[link[s]] < window else anchor[link[s]]
        named: dict[int, set] = {}
        short: dict[int, set] = {}
        for name, numbers in runs_:
            s = 0
            for i, c in enumerate(numbers, 1):
                s = after[s][c]
                if i >= window:
                    named.setdefault(anchor[s], set()).add(name)
            if len(numbers) < window:
                short.setdefault(s, set()).add((len(numbers), name))
        for s in order:
            upper[s] = s if s in short else upper[link[s]]
        n = max(len(words), 1)
        pairs = [a * n + b for a, s in after[0].items() for b in after[s]]
        go = {s * n + c: t for s, moves in enumerate(after) for c, t in moves.items()}
        listed = lambda found: {s: sorted(names, key=str) for s, names in found.items()}
        least = min([window, *(m for held in short.values() for m, _ in held)])
        return Automaton(window, least, words, go, link, length, anchor, listed(named), listed(short), upper, np.sort(np.array(pairs, np.int64)))

    def stretches(self, numbers: np.ndarray) -> Iterator[tuple[int, int]]:
        """Begin and end of the stretches of known neighbours that may hold a window."""
        known = numbers >= 0
        pair = numbers[:-1] * max(len(self.words), 1) + numbers[1:]
        place = np.minimum(np.searchsorted(self.pairs, pair), max(len(self.pairs) - 1, 0))
        linked = known[:-1] & known[1:] & (self.pairs[place] == pair) if len(self.pairs) else np.zeros(len(pair), bool)
        begins = np.flatnonzero(known & ~np.concatenate([[False], linked]))
        ends = np.flatnonzero(known & ~np.concatenate([linked, [False]])) + 1
        long = ends - begins >= self.least
        return zip(begins[long].tolist(), ends[long].tolist(), strict=True)

    def stream(self, numbers: list[int]) -> Iterator[tuple[int, int, int, list[str | None]]]:
        """For each window that occurs: the words before its end, its length, the longest match there, its items."""
        n = max(len(self.words), 1)
        at, matched = 0, 0
        for i, c in enumerate(numbers, 1):
            to = self.go.get(at * n + c)
            while to is None and at:
                at = self.link[at]
                matched = self.length[at]
                to = self.go.get(at * n + c)
            at, matched = (0, 0) if to is None else (to, matched + 1)
            if matched >= self.window:
                # The match may be a shorter run of its state, yet holds the window.
                yield i, self.window, matched, self.named.get(self.anchor[at], [])
            up = self.upper[at]
            while up:
                for m, name in self.short[up]:
                    if m <= matched:
                        yield i, m, matched, [name]
                up = self.upper[self.link[up]]


def match_texts(texts: list[str | None], automata: list[Automaton], earlier: list[dict | None]) -> list[dict]:
    """``n_words, spans, items`` of each text, joined with what earlier passes found."""
    raw = [(t or "").encode("utf-8", "surrogatepass").translate(CLEAN) for t in texts]
    split = [r.split() for r in raw]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    # A place that is no word parts the texts.
    starts = np.cumsum(sizes + 1) - sizes - 1
    total = int(sizes.sum()) + len(split)
    longest = np.zeros(total, np.int32)
    items: dict[int, set] = {}
    for automaton in automata:
        numbers = np.full(total, -1, np.int64)
        number = automaton.words.__getitem__
        for start, words in zip(starts.tolist(), split, strict=True):
            numbers[start : start + len(words)] = np.fromiter(map(number, words), np.int64, len(words))
        for begin, end in automaton.stretches(numbers):
            text = int(np.searchsorted(starts, begin, side="right")) - 1
            for i, m, matched, names in automaton.stream(numbers[begin:end].tolist()):
                at = slice(begin + i - m, begin + i)
                np.maximum(longest[at], matched, out=longest[at])
                items.setdefault(text, set()).update(names)
    for text, had in enumerate(earlier):
        if had and had["spans"]:
            items.setdefault(text, set()).update(had["items"])
            for s in had["spans"]:
                at = slice(int(starts[text]) + s["first"], int(starts[text]) + s["last"] + 1)
                np.maximum(longest[at], s["longest"], out=longest[at])
    out = [{"n_words": int(n), "spans": [], "items": []} for n in sizes]
    for text, names in items.items():
        out[text]["items"] = sorted(n for n in names if n is not None)
        out[text]["spans"] = _spans(longest[starts[text] : starts[text] + sizes[text]], raw[text])
    return out


def _spans(longest: np.ndarray, raw: bytes) -> list[dict[str, int]]:
    """Stretches of hit words: words and bytes from first to last, and the longest match."""
    hit = np.flatnonzero(longest)
    places = [m.span() for m in WORD.finditer(raw)]
    parts = np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1)
    return [{"first": int(p[0]), "last": int(p[-1]), "begin": places[p[0]][0], "end": places[p[-1]][1], "longest": int(longest[p].max())} for p in parts if len(p)]


def automata_of(items: DataFrame, window: int, block_words: int) -> DataFrame:
    """``block, automaton``: a written table of serialised automata, each over about ``block_words`` words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = PIECE_WORDS
        for batch in batches:
            names, pieces = [], []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                for at in range(0, max(len(words) - window, 0) + 1 if words else 0, step):
                    names.append(name)
                    pieces.append(b" ".join(words[at : at + step + window - 1]))
            yield pa.RecordBatch.from_pydict({"item": pa.array(names, pa.string()), "piece": pa.array(pieces, pa.binary())})

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, 1):
            held = zip(group.column(1).to_pylist(), group.column(2).to_pylist(), strict=True)
            packed = pickle.dumps(Automaton.of([(name, piece.split()) for name, piece in held], window))
            yield pa.RecordBatch.from_pydict({"block": pa.array([group.column(0)[0].as_py()], pa.int64()), "automaton": pa.array([packed], pa.binary())})

    plain = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    pieces = materialize(plain.mapInArrow(cut, "item string, piece binary").distinct())
    size = pieces.agg(F.sum(F.size(F.split(F.col("piece").cast("string"), " "))).alias("n")).first().n or 0
    blocks = -(-size // block_words) or 1
    dealt = pieces.select(F.pmod(F.xxhash64("item", "piece"), F.lit(blocks)).alias("block"), "item", "piece")
    dealt = dealt.repartition("block").sortWithinPartitions("block", "item", "piece")
    return materialize(dealt.mapInArrow(build, "block bigint, automaton binary"))


def matcher(automata: list[Automaton], docs: DataFrame):
    """A function of a text and of what was found in it before."""
    sent = docs.sparkSession.sparkContext.broadcast(automata)

    def scan(texts: pa.Array, earlier: pa.Array) -> pa.Array:
        out: list[dict] = []
        begin, size = 0, 0
        for i, text in enumerate(texts):
            n = text.as_buffer().size if text.is_valid else 0
            if i > begin and size + n > CHUNK:
                out += match_texts(texts[begin:i].to_pylist(), sent.value, earlier[begin:i].to_pylist())
                begin, size = i, 0
            size += n
        out += match_texts(texts[begin:].to_pylist(), sent.value, earlier[begin:].to_pylist())
        return pa.array(out, _FOUND)

    return run_once(F.arrow_udf(scan, FOUND))


def find(docs: DataFrame, items: DataFrame, name: str, *, window: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents, all their columns, with what was found in them as column ``name``."""
    table = automata_of(items, window, block_words)
    blocks = sorted(r.block for r in table.select("block").collect()) or [None]
    out = docs.withColumn(name, F.lit(None).cast(FOUND))
    for at in range(0, len(blocks), BLOCKS):
        # At most BLOCKS automata of bounded size are on the driver at a time.
        held = table.where(F.col("block").isin(blocks[at : at + BLOCKS])).orderBy("block").collect()
        scan = matcher([pickle.loads(r.automaton) for r in held], docs)
        out = out.withColumn(name, scan(F.col("text").cast("string"), F.col(name)))
        if at + BLOCKS < len(blocks):
            out = materialize(out)
    return out


def hit_words(found: Column) -> Column:
    """Number of hit words."""
    return F.aggregate(found["spans"], F.lit(0).cast("bigint"), lambda n, s: n + s["last"] - s["first"] + 1)


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``doc_id, n_words, n_hit, items, spans`` of every document of ``doc_id, text``."""
    found = find(docs.select("doc_id", "text"), items, "found", **options)
    f = F.col("found")
    return found.select("doc_id", f["n_words"].alias("n_words"), hit_words(f).alias("n_hit"), f["items"].alias("items"), f["spans"].alias("spans"))


def cut(docs: DataFrame, items: DataFrame, *, longest: int = 10, coverage: float = 0.5, **options) -> DataFrame:
    """The documents, all their columns, without the stretches and documents that exceed the limits."""
    name = "found"
    while name in docs.columns:
        name += "_"
    found = find(docs, items, name, **options)
    f = F.col(name)
    found = found.where(hit_words(f) <= F.lit(coverage) * f["n_words"])

    def without(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, held in zip(texts, spans, strict=True):
            held = [s for s in held.as_py() or [] if s["longest"] >= longest]
            if not held:
                out.append(text.as_py())
                continue
            raw = text.as_py().encode("utf-8", "surrogatepass")
            ends = [0, *(s["end"] for s in held)]
            begins = [*(s["begin"] for s in held), len(raw)]
            out.append(b"".join(raw[a:b] for a, b in zip(ends, begins, strict=True)).decode("utf-8", "surrogatepass"))
        return pa.array(out, pa.string())

    kept = run_once(F.arrow_udf(without, "string"))(F.col("text").cast("string"), f["spans"])
    return found.withColumn("text", kept).select(*docs.columns)
