"""BPE encoding by backtracking over longest matches, decoding by offset table.

A token sequence is the merge result exactly when every token encodes to
itself and every neighbouring pair encodes to that pair.  An Aho-Corasick
automaton finds the longest vocabulary match at each position; a match is
kept if it is compatible with the token before it, else the next shorter
match is tried, else the previous token is given up.  The merge result of a
prefix is unique, so a position given up once is never visited again and the
work is linear in the word's length.  Compatibility answers are kept in a
pair table that fills as pairs occur.

The vocabulary file is a parameter; nothing of it is stored here.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylake.llm.common import emit, ship

# --- fixed values: must equal what the vocabulary file's library does ---
WORD_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|"
                r"[^\t-\r \x85\xa0  -     　\p{L}\p{N}]+")
# str.split() also cuts at these, the library's white space does not hold them.
SEPARATORS_ONLY_PYTHON = re.compile("[\x1c-\x1f]")
SPACES = re.compile("[\t-\r \x85\xa0  -     　]+")
WORD_END = "</w>"
# --- end of fixed values ---

END = " "  # stands for the word-end mark; byte characters never include it
MARKS = ".,;:!?"
CACHE_ENTRIES = 400_000
CACHE_CHARS = 64
DECODE_IDS = 1 << 16


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    table = {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}
    return [table[b] for b in range(256)]


def unknown_characters() -> frozenset[str]:
    """Characters that Python's own character table does not know.

    Tables of a later Unicode version may hold letters among them; the
    vocabulary file's library decides how these are folded and split.
    """
    return frozenset(c for c in map(chr, range(0x80, 0x40000)) if unicodedata.category(c) == "Cn")


class WordBpe:
    """Encoder and decoder for one vocabulary file with word-end marks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["end_of_word_suffix"] != WORD_END or spec["decoder"] is not None:
            raise ValueError(f"{path}: not a vocabulary with word-end marks")
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = re.compile(
            "(" + "|".join(re.escape(s) for s in self.special) + ")") if self.special else None
        self.ids = {self._surface(t): i for t, i in vocab.items() if t not in self.special}
        self.ranks = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[self._surface(left), self._surface(right)] = rank
        self.bytes = byte_characters()
        self.words = regex.compile(WORD_PATTERN)
        self.unknown = unknown_characters()
        self.from_unknown = re.compile(f"[{min(self.unknown)}-{max(self.unknown)}]")
        library = tokenizers.Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.automaton = ahocorasick.Automaton()
        for surface in self.ids:
            self.automaton.add_word(surface, len(surface))
        self.automaton.make_automaton()
        self.pairs: dict[str, dict[str, bool]] = {}
        self.whole: dict[str, bool] = {}
        self.shorter: dict[str, str | None] = {}
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}
        self._offset_table(vocab)

    @staticmethod
    def _surface(token: str) -> str:
        return token[:-len(WORD_END)] + END if token.endswith(WORD_END) else token

    def _offset_table(self, vocab: dict[str, int]) -> None:
        """All tokens in one byte string, each with a space; their offsets."""
        by_id = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        size = max(by_id) + 1
        parts = [(by_id[i] + " ").encode() if i in by_id else b"" for i in range(size)]
        self.blob = np.frombuffer(b"".join(parts), dtype=np.uint8)
        self.lengths = np.array([len(p) for p in parts], dtype=np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])

    # -- merges on short strings, for the compatibility table only --

    def _symbols(self, surface: str) -> list[str]:
        return [*surface[:-2], surface[-2:]] if surface.endswith(END) else list(surface)

    def _merge(self, symbols: list[str]) -> list[str]:
        while len(symbols) > 1:
            rank, at = min(((self.ranks.get(p, 1 << 60), n)
                            for n, p in enumerate(zip(symbols, symbols[1:]))))
            if rank == 1 << 60:
                break
            symbols = [*symbols[:at], symbols[at] + symbols[at + 1], *symbols[at + 2:]]
        return symbols

    def _stands_alone(self, token: str) -> bool:
        known = self.whole.get(token)
        if known is None:
            known = self.whole[token] = self._merge(self._symbols(token)) == [token]
        return known

    def _compatible(self, left: str, right: str) -> bool:
        row = self.pairs.setdefault(left, {})
        known = row.get(right)
        if known is None:
            known = row[right] = self._merge(
                self._symbols(left) + self._symbols(right)) == [left, right]
        return known

    def _next_shorter(self, token: str) -> str | None:
        """The longest vocabulary entry that is a proper prefix."""
        if token not in self.shorter:
            self.shorter[token] = next(
                (token[:n] for n in range(len(token) - 1, 0, -1) if token[:n] in self.ids), None)
        return self.shorter[token]

    def encode_word(self, surface: str) -> list[int]:
        """Ids of one word given in byte characters with the end mark."""
        whole, pairs, shorter = self.whole, self.pairs, self.shorter
        if surface in self.ids and self._stands_alone(surface):
            return [self.ids[surface]]
        # Matches come by their end, so the longest of a start comes last.
        longest = {end - length: length for end, length in self.automaton.iter(surface)}
        taken: list[str] = []
        starts: list[int] = []
        dead: set[int] = set()
        at, size, before = 0, len(surface), None
        token = surface[:longest[-1]]
        while True:
            while token is not None:
                end = at + len(token)
                if end not in dead:
                    fits = whole.get(token)
                    if fits is None:
                        fits = self._stands_alone(token)
                    if fits and before is not None:
                        row = pairs.get(before)
                        fits = row.get(token) if row is not None else None
                        if fits is None:
                            fits = self._compatible(before, token)
                    if fits:
                        break
                token = shorter[token] if token in shorter else self._next_shorter(token)
            if token is None:
                if not taken:
                    raise ValueError(f"no encoding for {surface!r}")
                dead.add(at)
                at, token = starts.pop(), taken.pop()
                before = taken[-1] if taken else None
                token = self._next_shorter(token)
                continue
            taken.append(token)
            starts.append(at)
            before, at = token, end
            if at == size:
                return [self.ids[t] for t in taken]
            length = longest.get(at - 1)
            token = surface[at:at + length] if length else None

    def _encode_chunk(self, chunk: str) -> tuple[int, ...]:
        """A run without white space, already normalised."""
        found = self.old.get(chunk)
        if found is None:
            if len(chunk) > 1 and chunk[-1] in MARKS and chunk[-2].isalnum():
                # the mark is a word of its own; only the word is worth caching
                return ((self.young.get(chunk[:-1]) or self._encode_chunk(chunk[:-1]))
                        + (self.young.get(chunk[-1]) or self._encode_chunk(chunk[-1])))
            out: list[int] = []
            if chunk.isascii() or not self._holds_unknown(chunk):
                words = self.words.findall(chunk)
            else:
                words = [chunk[b:e] for _, (b, e) in self.pre_tokenizer.pre_tokenize_str(chunk)]
            for word in words:
                if word != chunk:  # cached under its own name
                    out += self.young.get(word) or self._encode_chunk(word)
                    continue
                if word.isascii() and word.isprintable():
                    surface = word + END  # these characters stand for themselves
                else:
                    surface = "".join(self.bytes[b] for b in word.encode()) + END
                out += self.encode_word(surface)
            found = tuple(out)
        if len(chunk) <= CACHE_CHARS:
            if len(self.young) >= CACHE_ENTRIES:
                self.old, self.young = self.young, {}
            self.young[chunk] = found
        return found

    def _holds_unknown(self, text: str) -> bool:
        return not self.unknown.isdisjoint(self.from_unknown.findall(text))

    @staticmethod
    def _folded(text: str) -> str:
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def _encode_plain(self, text: str) -> Iterator[int]:
        if text.isascii():
            text = text.lower()
        elif self._holds_unknown(text):
            text = " ".join(self.normalizer.normalize_str(part) if self._holds_unknown(part)
                            else self._folded(part) for part in SPACES.split(text))
        else:
            text = self._folded(text)
        chunks = (SPACES.split(text) if SEPARATORS_ONLY_PYTHON.search(text) else text.split())
        young, full = self.young.get, self._encode_chunk
        return chain.from_iterable(
            found if (found := young(c)) is not None else full(c) for c in chunks)

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; special strings in it are their own ids."""
        if not text:
            return np.zeros(0, dtype=np.int32)
        if self.special_pattern is None or "<|" not in text:
            return np.fromiter(self._encode_plain(text), dtype=np.int32)
        ids: list[int] = []
        for part in self.special_pattern.split(text):
            ids += [self.special[part]] if part in self.special else self._encode_plain(part)
        return np.array(ids, dtype=np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """Tokens joined by one space, gathered through the offset table."""
        parts = []
        for begin in range(0, len(ids), DECODE_IDS):
            part = ids[begin:begin + DECODE_IDS]
            lengths = self.lengths[part]
            ends = np.cumsum(lengths)
            where = np.arange(ends[-1]) + np.repeat(
                self.offsets[part] - (ends - lengths), lengths)
            parts.append(self.blob[where].tobytes())
        return b"".join(parts)[:-1].decode() if parts else ""


@lru_cache(maxsize=4)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Encode and decode every row: (id, ids array<int>, decoded string).

    A null or empty text gives no ids and an empty decoded text.  Repeated
    rows and null ids each give their own row; other columns are ignored.
    One scan without a shuffle; a task holds one batch of texts and a cache
    of bounded size.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(vocabulary)

        def rows(schema):
            for batch in batches:
                schema = schema or batch.schema
                for key, text in zip(batch.column(0), batch.column(1)):
                    ids = model.encode(text.as_py())
                    decoded = model.decode(ids)
                    yield 4 * len(ids) + 2 * len(decoded), (key.as_py(), ids, decoded)

        first = next(batches, None)
        if first is None:
            return
        id_type = first.schema.field(0).type
        batches = chain([first], batches)
        yield from emit(rows(None), pa.schema(
            [("id", id_type), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())]))

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = picked.mapInArrow(run, f"id {kind}, ids array<int>, decoded string")
    return out.withColumnRenamed("id", id_col)


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """n_tokens and the digests of ids and decoded text."""
    return encoded.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
