"""Language of words and documents by a linear-chain conditional random field.

A chain is a line of a text, its items are the words, its labels the languages.
The emission of a word is the sum of the weights of its affixes, its character
n-grams and the word itself as a lexicon entry (hashed into one table); learned
transitions say how likely the language changes from word to word. Forward and
backward passes give each word its chance of each language, so a text that
switches languages is labelled word by word. A document's language has the
largest sum over the words that have a letter, and its score is the share of it.

Learning takes at most ``per_language`` documents of each language, of at most
``most_chars`` characters each and ``chars_per_language`` together, and steps through them in
batches of bounded words; prediction reads every text whole. A line of more than ``LONG``
words is run as several chains, each with ``MARGIN`` words of its neighbours before and after
it, as far as the chance of a word depends on others at all.

Defined results for odd input: a text that is NULL or has no letter is ``und``
with score 0, as is every text if nothing can be learned; equal sums go to the
language that is first by code point; repeated rows are predicted each; only
``doc_id``, ``text`` and, for learning, ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanvec.llm.labelled import held_out, texts_of

UNKNOWN = "und"
TABLE = 1 << 16
#: Words a worker remembers.
REMEMBERED = 400_000
CHUNK = 1 << 20
#: Words of a chain, and words that it sees of its neighbours.
LONG, MARGIN = 2048, 64
#: Words times languages of a batch that is learned from.
BATCH_CELLS = 1 << 20

PUNCTUATION = ".,;:!?\"'()*$%&#|-_"
AFFIX = 4


def _slots(code: np.ndarray, kind: int) -> np.ndarray:
    """Places in the table of features of one kind."""
    h = (code + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(48)).astype(np.int64) % TABLE


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features, the number of the word that has each, and the features per word.

    Features are bytes in lower case between two marks: prefixes and suffixes of up to
    four, all pairs and triples, and the whole as lexicon entry. A word without a letter has none.
    """
    clean = [w.lower().strip(PUNCTUATION) for w in words]
    lettered = np.array([w.isalpha() or any(map(str.isalpha, w)) for w in clean], bool)
    marked = [b"^%b$" % w.encode("utf-8", "replace") for w in clean]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    data = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(data)) - starts[owner]
    power = np.cumprod(np.full(int(sizes.max(initial=1)), 0x100000001B3, np.uint64))
    slots, owners = [], []

    def add(code: np.ndarray, of: np.ndarray, kind: int) -> None:
        slots.append(_slots(code, kind << 56)[lettered[of]])
        owners.append(of[lettered[of]])

    for n in (2, 3):
        at = np.flatnonzero(sizes[owner] - place >= n)
        add(sum(data[at + i] << np.uint64(8 * i) for i in range(n)), owner[at], n)
    for n in range(1, AFFIX + 1):
        at = np.flatnonzero(sizes - 2 >= n)
        add(sum(data[starts[at] + 1 + i] << np.uint64(8 * i) for i in range(n)), at, 10 + n)
        add(sum(data[starts[at] + sizes[at] - 2 - i] << np.uint64(8 * i) for i in range(n)), at, 20 + n)
    if len(words):
        add(np.add.reduceat(data * power[place], starts), np.arange(len(words)), 30)
    flat, owner = np.concatenate(slots), np.concatenate(owners)
    return flat, owner, np.bincount(owner, minlength=len(words))


class Words(dict):
    """Number of each word in the order of first use; new ones are noted."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.fresh.append(word)
        return number


@dataclass(frozen=True)
class Chains:
    """Items of many chains, laid out step by step: first the first items of all chains, longest chain first."""

    place: np.ndarray  # of each item, in the order of the texts
    starts: np.ndarray  # of each step
    active: np.ndarray  # chains that have the step

    @staticmethod
    def of(lengths: np.ndarray) -> Chains:
        rank = np.empty(len(lengths), np.int64)
        rank[np.argsort(-lengths, kind="stable")] = np.arange(len(lengths))
        most = int(lengths.max(initial=0))
        active = len(lengths) - np.cumsum(np.bincount(lengths, minlength=most + 1))[:most]
        starts = np.concatenate([[0], np.cumsum(active)]).astype(np.int64)
        total = int(lengths.sum())
        step = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        return Chains(starts[step] + np.repeat(rank, lengths), starts, active)

    def forward_backward(self, emission: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chances of the labels of each item, in step order; expected moves; log of each item's scale.

        ``emission`` and ``move`` are exponentials; each step is scaled to sum 1.
        """
        forward, scale = np.empty_like(emission), np.empty(len(emission))
        starts, active = self.starts, self.active
        for t, n in enumerate(active):
            at = slice(starts[t], starts[t] + n)
            now = emission[at] if t == 0 else (forward[starts[t - 1] : starts[t - 1] + n] @ move) * emission[at]
            s = now.sum(1)
            scale[at] = s
            forward[at] = now / s[:, None]
        backward = np.ones_like(emission)
        for t in range(len(active) - 2, -1, -1):
            n = active[t + 1]
            at = slice(starts[t + 1], starts[t + 1] + n)
            backward[starts[t] : starts[t] + n] = ((backward[at] * emission[at]) @ move.T) / scale[at, None]
        later = np.concatenate([np.arange(starts[t], starts[t] + active[t]) for t in range(1, len(active))] or [np.zeros(0, np.int64)])
        before = np.concatenate([np.arange(starts[t - 1], starts[t - 1] + active[t]) for t in range(1, len(active))] or [np.zeros(0, np.int64)])
        moves = move * (forward[before].T @ (emission[later] * backward[later] / scale[later, None]))
        chances = forward * backward
        return chances / chances.sum(1, keepdims=True), moves, np.log(scale)


def read_texts(texts: list[str | None], words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of all lines in order, words per line, lines per text."""
    numbers: list[int] = []
    lengths: list[int] = []
    lines: list[int] = []
    number = words.__getitem__
    for text in texts:
        had = len(lengths)
        for line in (text or "").split("\n"):
            items = line.split()
            if items:
                lengths.append(len(items))
                numbers.extend(map(number, items))
        lines.append(len(lengths) - had)
    return np.array(numbers, np.int64), np.array(lengths, np.int64), np.array(lines, np.int64)


def pieces(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chains of lines: the word that each begins with, its words, and which of all its words are its own."""
    if lengths.max(initial=0) <= LONG:
        return np.cumsum(lengths) - lengths, lengths, np.ones(int(lengths.sum()), bool)
    many = -(-lengths // LONG)
    line = np.repeat(np.arange(len(lengths)), many)
    first = LONG * (np.arange(len(line)) - np.repeat(np.cumsum(many) - many, many))
    last = np.minimum(first + LONG, lengths[line])
    begin, end = np.maximum(first - MARGIN, 0), np.minimum(last + MARGIN, lengths[line])
    sizes = end - begin
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes - begin, sizes)
    own = (place >= np.repeat(first, sizes)) & (place < np.repeat(last, sizes))
    return begin + (np.cumsum(lengths) - lengths)[line], sizes, own


def _sums(weights: np.ndarray, flat: np.ndarray, owner: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Weights of each word's features, over the root of their number, so that long words do not drown short ones."""
    total = np.empty((len(sizes), weights.shape[1]))
    for k in range(weights.shape[1]):
        total[:, k] = np.bincount(owner, weights[flat, k], len(sizes))
    return total / np.sqrt(np.maximum(sizes, 1))[:, None]


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    weights: np.ndarray
    moves: np.ndarray


@dataclass(frozen=True)
class Batch:
    """Documents to learn from: words and labels in the order of the chains' steps, features of the words."""

    chains: Chains
    numbers: np.ndarray
    flat: np.ndarray
    owner: np.ndarray
    sizes: np.ndarray
    truth: np.ndarray  # how often each word has each label
    moves: np.ndarray  # how often each label follows itself

    @staticmethod
    def of(texts: list[str], labels: list[int], size: int) -> Batch | None:
        words = Words()
        numbers, lengths, lines = read_texts(texts, words)
        if not len(numbers):
            return None
        label = np.repeat(np.repeat(labels, lines), lengths)
        begin, sizes, own = pieces(lengths)
        # Every word is learned from once: chains without the words of their neighbours.
        sizes = np.add.reduceat(own, np.cumsum(sizes) - sizes, dtype=np.int64)
        chains = Chains.of(sizes)
        order = np.empty_like(chains.place)
        order[chains.place] = np.arange(len(order))
        numbers, label = numbers[order].astype(np.int32), label[order]
        flat, owner, sizes = word_features(list(words))
        truth = np.bincount(numbers * size + label, minlength=len(sizes) * size).reshape(-1, size).astype(np.float32)
        moves = np.diag(np.bincount(label[chains.active[0] :], minlength=size).astype(float))
        return Batch(chains, numbers, flat.astype(np.int32), owner.astype(np.int32), sizes, truth, moves)

    def slopes(self, weights: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slopes of the mean log-likelihood of a word, by weights and by moves."""
        size = len(moves)
        raw = _sums(weights, self.flat, self.owner, self.sizes)
        emission = np.exp(raw - raw.max(1, keepdims=True))[self.numbers]
        chances, expected, _ = self.chains.forward_backward(emission, np.exp(moves))
        root = np.sqrt(np.maximum(self.sizes, 1))
        slope = np.empty_like(weights)
        for k in range(size):
            lacking = (self.truth[:, k] - np.bincount(self.numbers, chances[:, k], len(self.sizes))) / root
            slope[:, k] = np.bincount(self.flat, lacking[self.owner], TABLE)
        return slope / len(self.numbers), (self.moves - expected) / len(self.numbers)


def batches_of(texts: list[str], labels: list[int], size: int) -> Iterator[Batch]:
    """Documents in turn, as many to a batch as its words and the languages allow."""
    held, cells = [], 0
    for i, text in enumerate(texts):
        n = (len(text.split()) + 1) * size
        if held and cells + n > BATCH_CELLS:
            yield from filter(None, [Batch.of([texts[j] for j in held], [labels[j] for j in held], size)])
            held, cells = [], 0
        held.append(i)
        cells += n
    yield from filter(None, [Batch.of([texts[j] for j in held], [labels[j] for j in held], size)])


def fit(texts: list[str], langs: list[str], *, steps: int = 25, rate: float = 0.3, ridge: float = 1e-4) -> LanguageModel:
    """Weights by gradient steps (Adam) on the chains' log-likelihood, ``steps`` over each batch."""
    languages = tuple(sorted(set(langs)))
    size = len(languages)
    weights, moves = np.zeros((TABLE, size)), np.zeros((size, size))
    if size < 2:
        return LanguageModel(languages, weights, moves)
    held = list(batches_of(texts, [languages.index(x) for x in langs], size))
    state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(moves), np.zeros_like(moves)]
    for step in range(1, steps * len(held) + 1):
        slope, move_slope = held[step % len(held)].slopes(weights, moves)
        slope -= ridge * weights
        move_slope -= 1e-2 * moves
        for value, g, m, v in ((weights, slope, state[0], state[1]), (moves, move_slope, state[2], state[3])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            value += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return LanguageModel(languages, weights, moves)


class Labeller:
    """Chances of words and texts under a model; remembers the emissions of words."""

    def __init__(self, model: LanguageModel):
        self.model, self.move = model, np.exp(model.moves)
        self._forget()

    def _forget(self) -> None:
        self.words, self.known = Words(), 0
        self.emission = np.zeros((1024, len(self.model.languages)))
        self.lettered = np.zeros(1024, bool)

    def _learn_words(self) -> None:
        fresh, at = self.words.fresh, self.known
        self.words.fresh = []
        self.known = at + len(fresh)
        if self.known > len(self.emission):
            grow = max(self.known, 2 * len(self.emission))
            self.emission = np.concatenate([self.emission[:at], np.zeros((grow - at, self.emission.shape[1]))])
            self.lettered = np.concatenate([self.lettered[:at], np.zeros(grow - at, bool)])
        for begin in range(0, len(fresh), 20_000):
            flat, owner, sizes = word_features(fresh[begin : begin + 20_000])
            raw = _sums(self.model.weights, flat, owner, sizes)
            span = slice(at + begin, at + begin + len(sizes))
            self.emission[span] = np.exp(raw - raw.max(1, keepdims=True))
            self.lettered[span] = sizes > 0

    def words_of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Chances of each word in order, whether it has a letter, words per line, lines per text."""
        if len(self.words) > REMEMBERED:
            self._forget()
        numbers, lengths, lines = read_texts(texts, self.words)
        self._learn_words()
        chances = np.zeros((len(numbers), len(self.model.languages)))
        if len(numbers):
            begin, sizes, own = pieces(lengths)
            chains = Chains.of(sizes)
            word = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes - begin, sizes)
            laid = np.empty_like(word)
            laid[chains.place] = numbers[word]
            chances = chains.forward_backward(self.emission[laid], self.move)[0][chains.place[own]]
        return chances, self.lettered[numbers], lengths, lines

    def documents(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if not self.model.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        chances, lettered, lengths, lines = self.words_of(texts)
        owner = np.repeat(np.repeat(np.arange(len(texts)), lines), lengths)[lettered]
        sums = np.stack([np.bincount(owner, chances[lettered, k], len(texts)) for k in range(chances.shape[1])], 1)
        total = sums.sum(1)
        best = sums.argmax(1)
        score = np.where(total > 0, sums[np.arange(len(texts)), best] / np.maximum(total, 1e-300), 0.0)
        return [self.model.languages[b] if t > 0 else UNKNOWN for b, t in zip(best, total, strict=True)], np.minimum(score, 1.0)


def learn(
    docs: DataFrame, *, per_language: int = 200, most_chars: int = 50_000, chars_per_language: int = 500_000, seed: int = 3, **options
) -> LanguageModel:
    """A model from documents outside the held-out fold whose id and language are known.

    The driver holds at most ``chars_per_language`` characters of each language and a text more.
    """
    known = docs.select("doc_id", F.col("text").cast("string"), F.col("lang").cast("string"))
    known = known.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.length("text") <= most_chars))
    turn = F.xxhash64("doc_id", F.lit(seed))
    order = Window.partitionBy("lang").orderBy(turn, "doc_id", F.xxhash64("text"))
    rows = known.withColumn("_turn", F.row_number().over(order)).where(F.col("_turn") <= per_language)
    before = F.sum(F.length("text")).over(Window.partitionBy("lang").orderBy("_turn")) - F.length("text")
    rows = rows.withColumn("_before", before).where(F.col("_before") < chars_per_language)
    # Languages in turn, so that each batch has some of all.
    taken = sorted(rows.select("_turn", "lang", "doc_id", "text").collect(), key=lambda r: (r[0], r[1]))
    return fit([r[3] for r in taken], [r[1] for r in taken], **options)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(sent.value)
        for part, texts in texts_of(batches, 1, CHUNK):
            langs, scores = labeller.documents(texts)
            yield pa.RecordBatch.from_pydict({"doc_id": part.column(0), "lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64())})

    found = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def label_words(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, line, langs``: the language of each word of each line that has words."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(sent.value)
        names = np.array([*sent.value.languages, UNKNOWN], object)
        for part, texts in texts_of(batches, 1, CHUNK):
            chances, lettered, lengths, lines = labeller.words_of(texts)
            best = np.where(lettered, chances.argmax(1), len(names) - 1) if chances.shape[1] else np.zeros(len(lettered), int)
            ids = np.repeat(np.arange(len(texts)), lines)
            line = np.arange(len(lengths)) - np.repeat(np.cumsum(lines) - lines, lines)
            langs = [list(names[x]) for x in np.split(best, np.cumsum(lengths)[:-1])] if len(lengths) else []
            yield pa.RecordBatch.from_pydict({"doc_id": part.column(0).take(pa.array(ids)), "line": pa.array(line, pa.int64()), "langs": pa.array(langs, pa.list_(pa.string()))})

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {kind}, line bigint, langs array<string>")


def keep_known(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The documents, all their columns, whose language is found; one in several languages stays."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(sent.value)
        for part, texts in texts_of(batches, text_at, CHUNK):
            langs, _ = labeller.documents(texts)
            yield part.filter(pa.array(np.array(langs, object) != UNKNOWN))

    return docs.mapInArrow(run, docs.schema)
