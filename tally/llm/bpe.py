"""Byte-pair encoding by forced boundaries, and decoding.

Two bytes that stand next to each other in no vocabulary token can never be
merged into one symbol, so the place between them is a certain cut: the
fragments on both sides are encoded independently and their ids concatenated.
A byte of white space is in no token of the word-end vocabularies read here,
so white space always cuts; inside a word the table of byte pairs decides.
Fragments recur, so each process keeps what it has encoded.

Read from a ``tokenizers`` file: vocabulary, merges, special tokens, and the
normaliser and pre-tokeniser, which run on each word seen for the first time.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm.shared import ship_package

REMEMBERED = 150_000  # words, and as many pre-tokens, in each of a process's two generations (some 100 MB in all)
LATIN_END = "\u0250"   # below: letters that are composed already, with settled classes and lower cases
LONG_FRAGMENT = 100   # letters from which a heap finds the next merge
WORD_END = "</w>"

#: Unicode white space, and of it what str.split() takes but the pattern ``\s`` doesn't.
_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_SPLIT_ONLY = re.compile("[\x1c-\x1f]")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class _Memo(dict):
    """Values by key, made on first use; what the last ``REMEMBERED`` or so uses didn't need is forgotten."""

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class WordBpe:
    """Encoder and decoder for a byte-level BPE file whose words end in a suffix."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        spec = json.loads(definition)
        model = spec["model"]
        rules = [r["type"] for r in spec["normalizer"]["normalizers"]], [r["type"] for r in spec["pre_tokenizer"]["pretokenizers"]]
        if model.get("end_of_word_suffix") != WORD_END or rules != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]):
            raise ValueError("a lower-casing byte-level BPE with word ends is needed")
        self.vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {pair: i for i, pair in enumerate(merges)}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        library = Tokenizer.from_str(definition)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        # The file's own pattern finds the pre-tokens of Latin words without the library.
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        self.latin_pattern = regex.compile(split["pattern"]["Regex"])

        self.letters = _byte_letters()
        self.latin_letters = dict(enumerate(self.letters))
        of_letter = {c: b for b, c in enumerate(self.letters)}
        #: joined[a, b]: some token has byte b right after byte a.
        self.joined = np.zeros((256, 256), dtype=bool)
        for token in {x + y for x, y in merges}:
            body = [of_letter[c] for c in token.removesuffix(WORD_END)]
            self.joined[body[:-1], body[1:]] = True
        self.joined_letters = {a + self.letters[int(b)] for a in self.letters for b in np.flatnonzero(self.joined[of_letter[a]])}
        self.id_bytes = {text: np.array([i], dtype="<u4").tobytes() for text, i in self.vocab.items()}

        top = max([*self.vocab.values(), *special.values()], default=-1) + 1
        self.surface = [b""] * top
        for text, i in [*self.vocab.items(), *special.items()]:
            self.surface[i] = text.encode()
        self.pieces = _Memo(self._encode_piece)
        self.words = _Memo(self._encode_word)

    def _merge(self, letters: str, is_end: bool) -> list[str]:
        """Tokens of one fragment (letters for bytes; whether its end is a word's end): lowest rank first, leftmost first."""
        parts = list(letters)
        if is_end:
            parts[-1] += WORD_END
        if len(parts) > LONG_FRAGMENT:
            parts = self._merge_long(parts)
        else:
            get, none = self.rank.get, len(self.rank)
            ranks = [get(pair, none) for pair in zip(parts, parts[1:])]
            while ranks:
                best = min(ranks)
                if best == none:
                    break
                i = ranks.index(best)
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
                del ranks[i]
                if i < len(ranks):
                    ranks[i] = get((parts[i], parts[i + 1]), none)
                if i:
                    ranks[i - 1] = get((parts[i - 1], parts[i]), none)
        return parts

    def _merge_long(self, parts: list[str]) -> list[str]:
        """The same merges in n log n steps: a heap of pairs over a linked list."""
        n, get = len(parts), self.rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, pair) for i, pair in enumerate(zip(parts, parts[1:])) if (r := get(pair)) is not None]
        heapq.heapify(heap)
        gone = [False] * n
        while heap:
            _, i, (left, right) = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or parts[i] != left or parts[j] != right:
                continue
            parts[i], gone[j], after[i] = left + right, True, after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (r := get(pair := (parts[k], parts[after[k]]))) is not None:
                    heapq.heappush(heap, (r, k, pair))
        return [p for p, out in zip(parts, gone) if not out]

    def cut(self, letters: str) -> list[tuple[str, bool]]:
        """The fragments of one pre-token between its certain cuts."""
        joined = self.joined_letters
        cuts = [i for i in range(1, len(letters)) if letters[i - 1:i + 1] not in joined]
        if not cuts:
            return [(letters, True)]
        edges = [0, *cuts, len(letters)]
        return [(letters[x:y], y == len(letters)) for x, y in zip(edges, edges[1:])]

    def _encode_piece(self, letters: str) -> bytes:
        """Ids of one pre-token, its bytes as letters: fragment by fragment."""
        parts: list[str] = []
        for fragment, is_end in self.cut(letters):
            parts += self._merge(fragment, is_end)
        return b"".join([self.id_bytes[p] for p in parts])

    def _encode_word(self, word: str) -> bytes:
        """Ids of one word between white space, as little-endian 32-bit integers."""
        if word.isalpha() and word.isascii():
            return self.pieces[word.lower()]
        if "<|" not in word and word.isprintable() and max(word) < LATIN_END:
            # Composed Latin letters: the normaliser only lowers them, one by one.
            found = self.latin_pattern.findall(word.lower())
            if word.isascii():
                return b"".join([self.pieces[x] for x in found])
            letters = self.latin_letters
            return b"".join([self.pieces[x.encode().decode("latin-1").translate(letters)] for x in found])
        out = []
        for piece in self.special_pattern.split(word) if self.special_pattern else [word]:
            if piece in self.special:
                out.append(np.array([self.special[piece]], dtype="<u4").tobytes())
            elif piece:
                split = self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(piece))
                out += [self.pieces[letters] for letters, _ in split]
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        parts = filter(None, _SPACE.split(text)) if _SPLIT_ONLY.search(text) else text.split()
        return b"".join(map(self.words.__getitem__, parts))

    def decode(self, ids: bytes) -> bytes:
        """The tokens of the ids as the vocabulary writes them, between blanks: files of this kind name no decoder."""
        return b" ".join(map(self.surface.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=2)
def _codec(definition: str) -> WordBpe:
    return WordBpe(definition)


def codec_of(path: str) -> WordBpe:
    """The codec of a ``tokenizers`` file."""
    with open(path, encoding="utf-8") as file:
        return _codec(file.read())


def share_tokenizer(spark: SparkSession, path: str):
    """The tokenizer file's text as a broadcast: some MB, the same for any input."""
    ship_package(spark)
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def shared_codec(shared) -> WordBpe:
    """The codec of a broadcast definition, made once in each process."""
    return _codec(shared.value)


def encode_text(docs: DataFrame, tokenizer: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with ``out``: the ids of the whole text, little-endian 32-bit, as binary. Null is empty."""
    shared = share_tokenizer(docs.sparkSession, tokenizer)

    @F.arrow_udf("binary")
    def ids(column: pa.Array) -> pa.Array:
        codec = shared_codec(shared)
        return pa.array([codec.encode(x.as_py() or "") for x in column], pa.binary())

    return docs.withColumn(out, ids(F.col(text)))


def decode_ids(docs: DataFrame, tokenizer: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with ``out``: the text of the ids in column ``ids``, special tokens included. Null is empty."""
    shared = share_tokenizer(docs.sparkSession, tokenizer)

    @F.arrow_udf("string")
    def decoded(column: pa.Array) -> pa.Array:
        codec = shared_codec(shared)
        return pa.array([codec.decode(x.as_py() or b"").decode() for x in column], pa.string())

    return docs.withColumn(out, decoded(F.col(ids)))


def round_trip(docs: DataFrame, tokenizer: str, text: str = "text", out: str = "coded") -> DataFrame:
    """``docs`` with a struct ``out`` of ``ids`` (binary, as ``encode_text``) and ``decoded``, the text of those ids.

    Null and empty texts have no ids and decode to the empty text. An existing
    column ``out`` is replaced; all others pass unchanged.
    """
    shared = share_tokenizer(docs.sparkSession, tokenizer)

    @F.arrow_udf("ids binary, decoded string")
    def coded(column: pa.Array) -> pa.Array:
        codec = shared_codec(shared)
        ids = [codec.encode(x.as_py() or "") for x in column]
        return pa.StructArray.from_arrays(
            [pa.array(ids, pa.binary()), pa.array([codec.decode(x).decode() for x in ids], pa.string())],
            names=["ids", "decoded"])

    return docs.withColumn(out, coded(F.col(text)))
