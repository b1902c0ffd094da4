"""Byte-level BPE by longest matches and backtracking, and back to bytes.

A sequence of tokens is what the merges make of a text exactly if each token is
what the merges make of its own bytes and each adjacent pair is what they make of
the pair's bytes. So the merges are never run over a text: an Aho-Corasick
automaton over the tokens, bytes as Latin-1 characters, gives the longest token
at each place, and a walk takes it if it goes with the token before it, else the
next shorter one, else steps back; a place once left is never tried again, so the
walk is linear. Whether two tokens go together is found by merging their few
bytes once and remembered: the tokens of the two that ever met at the border are
looked up, from the last merge back to the first.

Defined results for odd input: a NULL text is an empty one; an empty text has no
ids and the digest of nothing; repeated rows are encoded each; only the two
columns asked for are read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A worker remembers this many words, pieces and pairs each, and as many that it used before those.
REMEMBERED = 250_000
#: Longer pieces are encoded each time.
LONG_PIECE = 64


class Memory:
    """A bounded dictionary in two generations: what is still used moves to the new one."""

    def __init__(self, most: int = REMEMBERED):
        self.most, self.new, self.old = most, {}, {}

    def get(self, key):
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.new) >= self.most:
            self.old, self.new = self.new, {}
        self.new[key] = value


def read_ranks(text: str) -> dict[bytes, int]:
    """Token to rank from the lines ``base64 rank`` of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in text.splitlines() if line.strip())}


class ByteBpe:
    """Encoder and decoder of one table of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.pieces = regex.compile(pattern).findall
        # Tokens that the merges never make can only be whole pieces.
        self.made = {token for token in ranks if self.merge(token) == [token]}
        self.spines: dict[bytes, tuple[list[bytes], list[bytes]]] = {}
        self.automaton = ahocorasick.Automaton()
        for token in self.made:
            self.automaton.add_word(token.decode("latin-1"), (len(token) - 1, token))
        self.automaton.make_automaton()
        self.longest_prefix = {token: self._prefix(token) for token in self.made}
        self.pairs, self.known, self.words = Memory(), Memory(), Memory()

    def _halves(self, token: bytes) -> tuple[bytes, bytes]:
        """The two tokens that the last merge joins."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts[0], parts[1]

    def _spines(self, token: bytes) -> tuple[list[bytes], list[bytes]]:
        """What stood at the left and at the right border of the token, from its last merge back."""
        if token not in self.spines:
            left, right = [token], [token]
            while len(left[-1]) > 1:
                left.append(self._halves(left[-1])[0])
            while len(right[-1]) > 1:
                right.append(self._halves(right[-1])[1])
            self.spines[token] = left, right
        return self.spines[token]

    def _prefix(self, token: bytes) -> bytes | None:
        return next((token[:n] for n in range(len(token) - 1, 0, -1) if token[:n] in self.made), None)

    def merge(self, text: bytes) -> list[bytes]:
        """The definition, for a few bytes: merge the adjacent pair of lowest rank, the leftmost first."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
            joined = parts[best] + parts[best + 1]
            if joined not in self.ranks:
                break
            parts[best : best + 2] = [joined]
        return parts

    def go_together(self, left: bytes, right: bytes) -> bool:
        pair = (left, right)
        found = self.pairs.get(pair)
        if found is None:
            found = self._stay_apart(self._spines(left)[1], self._spines(right)[0])
            self.pairs.put(pair, found)
        return found

    def _stay_apart(self, lefts: list[bytes], rights: list[bytes]) -> bool:
        """Whether no merge ever joins what meets at the border.

        ``before`` is the rank of the merge that ends the meeting of the two; of equal
        merges the left one runs first.
        """
        ranks, i, j, before = self.ranks, 0, 0, 1 << 60
        while True:
            a, b = lefts[i], rights[j]
            if ranks.get(a + b, before) < before:
                return False
            made_a = ranks[a] if len(a) > 1 else -1
            made_b = ranks[b] if len(b) > 1 else -1
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:
                i, before = i + 1, made_a
            else:
                j, before = j + 1, made_b + 1

    def longest_matches(self, text: bytes) -> dict[int, bytes]:
        """The longest token that begins at each byte.

        The automaton reports matches by their ends, so the last of a begin is the longest.
        """
        return {end - n: token for end, (n, token) in self.automaton.iter(text.decode("latin-1"))}

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        longest = self.longest_matches(piece)
        size, at = len(piece), 0
        dead = bytearray(size + 1)
        tokens: list[bytes] = []
        trial = longest.get(0)
        while at < size:
            if trial is not None:
                end = at + len(trial)
                if not dead[end] and (not tokens or self.go_together(tokens[-1], trial)):
                    tokens.append(trial)
                    at = end
                    trial = longest.get(at)
                else:
                    trial = self.longest_prefix[trial]
                continue
            dead[at] = 1
            if not tokens:
                raise ValueError("the ranks lack a byte of the text")
            last = tokens.pop()
            at -= len(last)
            trial = self.longest_prefix[last]
        return [self.ranks[t] for t in tokens]

    def _piece(self, piece: str) -> str:
        found = self.known.get(piece)
        if found is None:
            found = ",".join(map(str, self.encode_piece(piece.encode())))
            if len(piece) <= LONG_PIECE:
                self.known.put(piece, found)
        return found

    def _pieces_of(self, text: str) -> str:
        return ",".join(map(self._piece, self.pieces(text)))

    def _word(self, word: str) -> str:
        """Ids of a word with the space before it; nothing if more white space touches that space."""
        found = self.words.get(word)
        if found is None:
            if word.isalpha():  # one piece
                found = self._piece(" " + word)
            elif word and not word[0].isspace() and not word[-1].isspace():
                found = self._pieces_of(" " + word)
            else:
                found = ""
            if len(word) <= LONG_PIECE:
                self.words.put(word, found)
        return found

    def encode_text(self, text: str) -> str:
        """Decimal ids joined by commas.

        No piece crosses a lone space between two words, so words are remembered whole;
        a text with other white space beside a space goes piece by piece.
        """
        first, *words = text.split(" ")
        if words and first and not first[-1].isspace():
            get = self.words.new.get
            out = [get(word) for word in words]
            if None in out:
                out = [self._word(word) if ids is None else ids for word, ids in zip(words, out, strict=True)]
            if "" not in out:
                return ",".join([self._pieces_of(first), *out])
        return self._pieces_of(text)

    def encode(self, text: str) -> list[int]:
        joined = self.encode_text(text)
        return [int(i) for i in joined.split(",")] if joined else []

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


_loaded: dict[tuple[int, str], ByteBpe] = {}


def loaded(ranks: dict[bytes, int], pattern: str) -> ByteBpe:
    """One encoder for each worker; building it takes a second."""
    key = (hash(frozenset(ranks.items())), pattern)
    if key not in _loaded:
        _loaded[key] = ByteBpe(ranks, pattern)
    return _loaded[key]


def _over_batches(make: Callable[[], ByteBpe], with_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = make()
        names = {str(i): token for i, token in bpe.token.items()}
        for batch in batches:
            n_tokens, ids_sha, text_sha, ids = [], [], [], []
            for text in batch.column(1):
                joined = bpe.encode_text(text.as_py() or "")
                numbers = joined.split(",") if joined else []
                n_tokens.append(len(numbers))
                ids_sha.append(hashlib.sha256(joined.encode()).hexdigest())
                text_sha.append(hashlib.sha256(b"".join(map(names.__getitem__, numbers))).hexdigest())
                if with_ids:
                    ids.append([int(i) for i in numbers])
            columns = {
                "doc_id": batch.column(0),
                "n_tokens": pa.array(n_tokens, pa.int64()),
                "ids_sha256": pa.array(ids_sha, pa.string()),
                "decoded_sha256": pa.array(text_sha, pa.string()),
            }
            if with_ids:
                columns["ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    return run


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, with_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``, with the ids themselves if asked for.

    The ranks are a vocabulary file, 50,000 tokens here: they travel as one broadcast.
    """
    sent = docs.sparkSession.sparkContext.broadcast((ranks, pattern))
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(_over_batches(lambda: loaded(*sent.value), with_ids), schema)


def decode_documents(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; the inverse of ``encode_documents``."""
    sent = encoded.sparkSession.sparkContext.broadcast({rank: token for token, rank in ranks.items()})
    kind = dict(encoded.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = sent.value
        for batch in batches:
            texts = [b"".join(map(token.__getitem__, ids.as_py() or [])).decode("utf-8", "replace") for ids in batch.column(1)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "text": pa.array(texts, pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")
