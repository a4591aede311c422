"""Byte-pair encoding and decoding with a segment tree over the ranks of adjacent pairs.

A pre-token starts as one symbol per byte. The leaves of a tree hold, for each adjacent pair, its
merge rank and position (a pair without a merge: infinity), every inner node the least of its two
children. The root is thus the leftmost pair of the lowest rank. A merge changes three leaves (the
merged pair, the one before and the one that vanishes), each in a logarithmic number of steps, until
the root is infinite. Many pre-tokens of a like length are merged side by side: one numpy operation
moves all their trees by one step.

Pre-tokens recur, so each Python worker keeps a bounded cache of encoded ones; it is a cache only and
may be emptied at any time. White space always separates pre-tokens, so whole white-space separated
chunks are cached as well.

Defined results: null and empty texts have no ids and decode to the empty text; texts of any length
are encoded whole; the same text always gets the same ids; the strings of special tokens in a text
become those tokens, as the tokenizers library has it; an empty table gives an empty table. Ids
without a token are left out by decoding, a null array decodes as an empty one.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import compress, repeat
from operator import is_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from loanrisk.llm.common import arrow_pass, map_texts

NO_PAIR = np.int64(1) << 62
#: Entries of a worker's caches; a chunk over the length limit is never kept. A full cache takes no
#: more, and starts anew when most of what is asked for is not in it.
CACHED_CHUNKS, CACHED_PIECES, CACHED_LENGTH = 450_000, 250_000, 64
#: Ids below this (a power of two) have their pairs' ranks in a plain table.
SMALL_IDS = 1024
#: Symbols merged side by side.
MERGED_AT_ONCE = 1 << 17

# Chunks of printable ASCII and precomposed Latin letters: normal already but for their case.
LATIN = re.compile("[!-~À-ÖØ-öø-įı-ſ]*")
# A capital before a letter or mark that may join it: the file composes first and lowers the case then,
# and some small letters have a composed form where the capital has none. Marks begin with \xcc at least.
MAY_JOIN = re.compile(rb"[A-Z][\xc6-\xff]")
# The split pattern of the vocabulary file for these, in lower case; a line end closes a chunk.
LATIN_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|\n|[^a-zß-öø-ſ0-9\n]+")
# Stands behind each chunk's ids while many are put together; no id of a vocabulary.
CLOSED = 0xFFFFFFFF


class PairMerger:
    """Merges of a vocabulary: which adjacent symbols join, in which order, and into what."""

    def __init__(self, merges: Iterable[tuple[int, int, int]]):
        """merges: (left id, right id, joined id) in the order of their ranks."""
        table = np.array(list(merges), dtype=np.int64).reshape(-1, 3)
        keys = table[:, 0] << 32 | table[:, 1]
        keys, first = np.unique(keys, return_index=True)
        self.keys = np.append(keys, np.iinfo(np.int64).max)
        self.ranks = np.append(first, 0)
        self.joined = table[:, 2]
        # Ranks of pairs of small ids, which bytes have, as a plain table; the last id of it is none (-1).
        self.small = np.full(SMALL_IDS * SMALL_IDS, -1, dtype=np.int32)
        some = np.flatnonzero((table[:, :2] < SMALL_IDS - 1).all(axis=1))[::-1]  # the first of a pair stays
        self.small[table[some, 0] * SMALL_IDS + table[some, 1]] = some

    def _first_leaves(self, symbols: np.ndarray, width: int) -> np.ndarray:
        """Leaves of all adjacent symbols before any merge."""
        position = np.arange(width - 1, dtype=np.int64)
        if symbols.max() >= SMALL_IDS - 1:
            return self._leaves(symbols[:, :-1], symbols[:, 1:], position, width)
        ids = symbols & (SMALL_IDS - 1)
        rank = self.small[ids[:, :-1] * SMALL_IDS + ids[:, 1:]].astype(np.int64)
        return np.where(rank >= 0, rank * width + position, NO_PAIR)

    def _leaves(self, left: np.ndarray, right: np.ndarray, position: np.ndarray, width: int):
        """Rank and position of pairs as one number that sorts by both; negative ids never pair."""
        key = left << 32 | right
        found = np.searchsorted(self.keys, key)
        hit = (self.keys[found] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.ranks[found] * width + position, NO_PAIR)

    def merge(self, symbols: np.ndarray) -> np.ndarray:
        """Merge rows of ids, padded with -1 to a width that is a power of two; in place.

        Joined ids stay at the place of their left part, the right part's place becomes -1.
        """
        rows, width = symbols.shape
        if width == 1 or not rows:
            return symbols
        tree = np.full((rows, 2 * width), NO_PAIR)
        tree[:, width:-1] = self._first_leaves(symbols, width)
        level = width
        while level > 1:
            pairs = tree[:, level : 2 * level]
            level //= 2
            np.minimum(pairs[:, ::2], pairs[:, 1::2], out=tree[:, level : 2 * level])
        # One place more on either side, so that neighbours always exist: ids there are -1.
        wide = width + 2
        ids = np.full((rows, wide), -1, dtype=np.int64)
        ids[:, 1:-1] = symbols
        after = np.tile(np.arange(1, wide + 1, dtype=np.int64), rows)
        before = np.tile(np.arange(-1, wide - 1, dtype=np.int64), rows)
        # From here on all are flat; a row's part begins at its base.
        row = np.flatnonzero(tree[:, 1] < NO_PAIR)
        tree, flat = tree.ravel(), ids.ravel()
        while row.size:
            base, root = row * wide, row * (2 * width)
            rank, place = np.divmod(tree[root + 1], width)
            here = base + place + 1
            right = after[here]
            beyond = np.minimum(after[base + right], wide - 1)
            previous = np.maximum(before[here], 0)
            new = self.joined[rank]
            flat[here] = new
            flat[base + right] = -1
            after[here] = beyond
            before[base + beyond] = place + 1
            tree[root + width + right - 1] = NO_PAIR
            tree[root + width + place] = self._leaves(new, flat[base + beyond], place, width)
            # Without a previous symbol, the pair before has no leaf; the own leaf is then set again.
            ahead = np.where(previous > 0, previous - 1, place)
            left_id = np.where(previous > 0, flat[base + previous], new)
            right_id = np.where(previous > 0, new, flat[base + beyond])
            tree[root + width + ahead] = self._leaves(left_id, right_id, ahead, width)
            nodes = [width + right - 1, width + place, width + ahead]
            level = width
            while level > 1:
                level //= 2
                for k, node in enumerate(nodes):
                    nodes[k] = node = node >> 1
                    below = root + 2 * node
                    tree[root + node] = np.minimum(tree[below], tree[below + 1])
            row = row[tree[root + 1] < NO_PAIR]
        symbols[:] = ids[:, 1:-1]
        return symbols


class Encoder:
    """Encoding by a tokenizers file of byte-level merges with word ends."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            description = json.load(file)
        model = description["model"]
        vocab = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        alphabet = _byte_alphabet()
        self.byte_of = {letter: byte for byte, letter in enumerate(alphabet)}
        self.inner = np.array([vocab[letter] for letter in alphabet], dtype=np.int64)
        self.final = np.array([vocab[letter + end] for letter in alphabet], dtype=np.int64)
        pairs = (pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"])
        self.merger = PairMerger((vocab[a], vocab[b], vocab[a + b]) for a, b in pairs)
        self.special = {token["content"]: token["id"] for token in description["added_tokens"]}
        self.tokens = {number: token for token, number in vocab.items()}
        self.tokens |= {number: token for token, number in self.special.items()}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.marker = b"<|"
        self.chunks: dict[bytes, bytes] = {}
        self.pieces: dict[bytes, bytes] = {}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each whole text."""
        split = list(map(self._chunks, texts))
        known = self.chunks
        found = [list(map(known.get, chunks)) for chunks in split]
        gaps = [list(compress(range(len(ids)), map(is_, ids, repeat(None)))) if None in ids else [] for ids in found]
        missing = {chunks[k] for chunks, holes in zip(split, gaps) for k in holes}
        if missing:
            fresh = dict(zip(missing, self._encode_chunks(list(missing))))
            for chunks, ids, holes in zip(split, found, gaps):
                for k in holes:
                    ids[k] = fresh[chunks[k]]
            if len(known) > CACHED_CHUNKS and 2 * len(missing) > len(set().union(*split)):
                known.clear()
                for chunks, ids in zip(split, found):
                    fresh.update(zip(chunks, ids))
            if len(known) <= CACHED_CHUNKS:
                known.update((chunk, ids) for chunk, ids in fresh.items() if len(chunk) <= CACHED_LENGTH)
        return list(map(b"".join, found))

    def _chunks(self, text: bytes) -> list[bytes]:
        """Chunks between white space, in lower case where that changes no id."""
        if self.marker in text:
            return text.split()
        if text.isascii() or not MAY_JOIN.search(text):
            return text.lower().split()
        return [chunk if MAY_JOIN.search(chunk) else chunk.lower() for chunk in text.split()]

    def _encode_chunks(self, chunks: list[bytes]) -> Iterator[bytes]:
        """Ids of each chunk; all are cut in one pass and put together in one."""
        flat = self._split(chunks)
        distinct = set(flat)
        missing = distinct.difference(self.pieces)
        if len(self.pieces) > CACHED_PIECES and 2 * len(missing) > len(distinct):
            self.pieces = {p: self.pieces[p] for p in distinct.difference(missing)}
        known = self.pieces
        missing.discard("\n")
        numbers = {p for p in missing if type(p) is int}
        fresh = dict(self._merge(missing - numbers))
        fresh.update((p, p.to_bytes(4, "little")) for p in numbers)
        fresh["\n"] = CLOSED.to_bytes(4, "little")
        if len(known) <= CACHED_PIECES:
            known.update((p, ids) for p, ids in fresh.items() if type(p) is int or len(p) <= CACHED_LENGTH)
        ids = b"".join([known.get(p) or fresh[p] for p in flat])
        stops = (4 * np.flatnonzero(np.frombuffer(ids, dtype="<u4") == CLOSED)).tolist()
        begin = 0
        for stop in stops:
            yield ids[begin:stop]
            begin = stop + 4

    def _split(self, chunks: list[bytes]) -> list[str | bytes | int]:
        """Pre-tokens of all chunks as text or UTF-8, special tokens as their ids; "\\n" closes each chunk."""
        flat: list[str | bytes | int] = []
        plain: list[str] = []  # chunks in a row that the one pattern cuts
        for text in (b"\n".join(chunks)).decode("utf-8", "replace").split("\n"):
            if LATIN.fullmatch(text) and "<|" not in text:
                plain.append(text)
                continue
            if plain:
                flat += LATIN_PIECES.findall("\n".join([*plain, ""]).lower())
                plain = []
            flat += (piece for part in self.special_split.split(text) for piece in self._parts(part))
            flat.append("\n")
        if plain:
            flat += LATIN_PIECES.findall("\n".join([*plain, ""]).lower())
        return flat

    def _parts(self, part: str) -> Iterator[bytes | int]:
        if part in self.special:
            yield self.special[part]
        elif part:
            normal = self.tokenizer.normalizer.normalize_str(part)
            for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal):
                yield bytes([self.byte_of[letter] for letter in piece])

    def _merge(self, pieces: Iterable[str | bytes]) -> Iterator[tuple[str | bytes, bytes]]:
        """Ids of distinct pre-tokens, those of like length side by side."""
        names = list(pieces)
        raw = [piece.encode() if type(piece) is str else piece for piece in names]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        levels = np.ceil(np.log2(lengths)).astype(np.int64)
        for level in np.unique(levels).tolist():
            width = 1 << level
            of_width = np.flatnonzero(levels == level)
            step = max(1, MERGED_AT_ONCE // width)
            for start in range(0, len(of_width), step):
                some = of_width[start : start + step]
                places = some.tolist()
                letters = np.frombuffer(b"".join([raw[place] for place in places]), dtype=np.uint8)
                held = lengths[some]
                symbols = np.full((len(some), width), -1, dtype=np.int64)
                symbols[np.arange(width) < held[:, None]] = self.inner[letters]
                symbols[np.arange(len(some)), held - 1] = self.final[letters[np.cumsum(held) - 1]]
                self.merger.merge(symbols)
                left = symbols >= 0
                flat = symbols[left].astype("<u4").tobytes()
                begin = 0
                for place, stop in zip(places, (4 * np.cumsum(left.sum(axis=1))).tolist()):
                    yield names[place], flat[begin:stop]
                    begin = stop

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens' strings with single spaces between: the vocabulary file names no decoder."""
        tokens = self.tokens
        try:
            return " ".join([tokens[number] for number in ids])
        except KeyError:
            return " ".join([tokens[number] for number in ids if number in tokens])


def _byte_alphabet() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(byte if byte in printable else next(spare)) for byte in range(256)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file."""
    return Encoder(path)


def id_lists(encoded: list[bytes]) -> pa.Array:
    offsets = np.cumsum([0, *(len(ids) // 4 for ids in encoded)], dtype=np.int32)
    values = np.frombuffer(b"".join(encoded), dtype="<i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """docs with an array of token ids of each whole text (a column of that name is replaced)."""
    kept = [docs[f"`{name}`"] for name in docs.columns if name.lower() != ids.lower()]
    return map_texts(
        docs, kept, docs[f"`{text}`"],
        lambda _, texts: [id_lists(encoder(path).encode(texts))],
        [T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)],
    )


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """df with the text of each array of ids in place of the array."""
    kept = [df[f"`{name}`"] for name in df.columns if name.lower() not in (text.lower(), ids.lower())]
    source = df.select(*kept, F.coalesce(df[f"`{ids}`"], F.array().cast("array<int>")).alias(ids))
    schema = T.StructType([*df.select(*kept).schema.fields, T.StructField(text, T.StringType(), False)])
    last = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                decoded = [encoder(path).decode(x) for x in part.column(last).to_pylist()]
                yield [*part.columns[:last], pa.array(decoded, pa.string())]

    return arrow_pass(source, run, schema)


def ids_digest(ids: Column) -> Column:
    """SHA-256 of the decimal ids joined by single spaces."""
    return F.sha2(F.array_join(ids.cast("array<string>"), " ").cast("binary"), 256)
