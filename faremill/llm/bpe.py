"""BPE encoding and decoding by batched merge rounds over flat numpy arrays.

The symbols of many words lie in one flat array. A round looks up every adjacent pair by binary search
in the sorted pair keys, takes the lowest rank of each word and merges its occurrences from left to
right; words without a pair left drop out. Merging all occurrences of a word's lowest pair at once
equals merging one at a time because no merge uses a symbol that a later merge makes; this is checked
when a vocabulary is read.

Words already seen are kept in two caches of bounded size, a young and an older one (one batch of
PIECE_CHARS characters comes on top), so most of a text costs one lookup a word.
Texts are cut at white space into pieces of bounded length, so a text of any length needs bounded
memory besides its own ids.

Null texts and ids count as empty: no ids, and the empty text. Other columns pass through unread.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

CACHED_WORDS = 80_000
CACHED_LENGTH = 48
PIECE_CHARS = 1 << 20
NO_RANK = np.iinfo(np.int64).max

#: White space as tokenizer patterns count it; str.split() also splits at four control characters.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_SPACES = re.compile(f"[{_SPACE}]+")
_CONTROL = re.compile("[\x1c-\x1f]")


def _byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = itertools.count(256)
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class WordBPE:
    """A lower-casing BPE with word ends, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"]
        self.special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.tokens = {number: token for token, number in [*vocab.items(), *self.special.items()]}
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.special_at = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        symbols = _byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + end] for s in symbols], np.int64)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made: dict[str, int] = {}
        for rank, (left, right) in enumerate(merges):
            if made.setdefault(left + right, rank) != rank:
                raise ValueError("two merges make the same symbol")
        if any(made.get(part, -1) > rank for rank, pair in enumerate(merges) for part in pair):
            raise ValueError("a merge uses a symbol that a later one makes")
        self.size = max(self.tokens) + 1
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        self.rank_of = np.argsort(keys)
        self.keys = keys[self.rank_of]
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ranks(self, ids: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank of the pair that begins at each given place; NO_RANK where no merge has it or the word ends."""
        inside = at[word[at] == word[np.minimum(at + 1, len(word) - 1)]]
        inside = inside[inside + 1 < len(word)]
        key = ids[inside] * self.size + ids[inside + 1]
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = self.keys[place] == key
        found = np.full(len(ids), NO_RANK)
        found[inside[known]] = self.rank_of[place[known]]
        return found[at]

    def merge_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and the number of ids of each word."""
        raw = [word.encode() for word in words]
        lengths = np.array([len(w) for w in raw], np.int64)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        ids = self.inner[flat]
        ends = np.cumsum(lengths)
        ids[ends - 1] = self.last[flat[ends - 1]]
        word = np.repeat(np.arange(len(words)), lengths)
        rank = self._ranks(ids, word, np.arange(len(ids)))
        done_ids, done_words = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        while len(ids):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            low = np.repeat(lowest, np.diff(np.r_[starts, len(ids)]))
            active = low != NO_RANK
            if not active.all():
                done_ids.append(ids[~active])
                done_words.append(word[~active])
                ids, word, rank, low = ids[active], word[active], rank[active], low[active]
            hits = np.flatnonzero(rank == low)
            if not len(hits):
                break
            # of a run of overlapping pairs (a a a) every other one is merged, from the left
            order = np.arange(len(hits))
            first = np.maximum.accumulate(np.where(np.r_[True, np.diff(hits) != 1], order, 0))
            hits = hits[(order - first) % 2 == 0]
            ids[hits] = self.made[rank[hits]]
            stay = np.ones(len(ids), bool)
            stay[hits + 1] = False
            ids, word, rank = ids[stay], word[stay], rank[stay]
            hits -= np.arange(len(hits))
            changed = np.concatenate([hits, hits[hits > 0] - 1])
            rank[changed] = self._ranks(ids, word, changed)
        all_words = np.concatenate(done_words)
        order = np.argsort(all_words, kind="stable")
        return np.concatenate(done_ids)[order].astype(np.int32), np.bincount(all_words, minlength=len(words))

    def _learn(self, chunks: list[str]) -> None:
        """Put the ids of new chunks into the cache; their new words go through the merge rounds together."""
        known = self.cache
        mixed = [chunk for chunk in chunks if not chunk.isalpha()]  # letters only: one word
        found = list(map(self.words.findall, mixed))
        words = list(({c for c in chunks if c.isalpha()} | set(itertools.chain.from_iterable(found))) - known.keys())
        ids, counts = self.merge_words(words)
        raw, stops = ids.tobytes(), (np.cumsum(counts) * 4).tolist()
        known.update(zip(words, map(raw.__getitem__, map(slice, [0, *stops[:-1]], stops)), strict=True))
        for chunk, parts in zip(mixed, found, strict=True):
            known[chunk] = b"".join(map(known.__getitem__, parts))

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Ids as bytes of texts that hold no special token."""
        pieces = []
        for text in texts:
            text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ").lower()  # no special form at the end of a word
            pieces.append(_SPACES.split(text) if _CONTROL.search(text) else text.split())
        needed = set().union(*pieces)
        new = needed - self.cache.keys()
        if len(self.cache) + len(new) > CACHED_WORDS:
            self.older = {chunk: ids for chunk, ids in self.cache.items() if len(chunk) <= CACHED_LENGTH}
            self.cache, new = {}, needed
        again = new & self.older.keys()
        self.cache.update((chunk, self.older[chunk]) for chunk in again)
        if len(again) < len(new):
            self._learn(list(new - again))
        return [b"".join(map(self.cache.__getitem__, piece)) for piece in pieces]

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text, as the bytes of an int32 array."""
        units: list[str] = []
        plan: list[list[int | bytes]] = []
        for text in texts:
            steps: list[int | bytes] = []
            for part in self.special_at.split(text) if text and "<|" in text else [text or ""]:
                if part in self.special:
                    steps.append(np.int32(self.special[part]).tobytes())
                    continue
                for piece in _cut(part):
                    steps.append(len(units))
                    units.append(piece)
            plan.append(steps)
        ids: list[bytes] = []
        begin = 0
        while begin < len(units):
            stop, chars = begin, 0
            while stop < len(units) and (stop == begin or chars + len(units[stop]) <= PIECE_CHARS):
                chars += len(units[stop])
                stop += 1
            ids += self._plain(units[begin:stop])
            begin = stop
        return [b"".join(step if isinstance(step, bytes) else ids[step] for step in steps) for steps in plan]

    def decode_one(self, ids: np.ndarray) -> str:
        """Tokens of the ids, joined by a space; ids that the vocabulary does not have are left out."""
        numbers, tokens = ids.tolist(), self.tokens
        try:
            return " ".join(map(tokens.__getitem__, numbers))
        except KeyError:
            return " ".join(tokens[number] for number in numbers if number in tokens)


def _cut(text: str) -> list[str]:
    """Pieces of about PIECE_CHARS characters, cut at white space only."""
    if len(text) <= PIECE_CHARS:
        return [text] if text else []
    pieces, begin = [], 0
    while begin < len(text):
        found = _SPACES.search(text, begin + PIECE_CHARS) if begin + PIECE_CHARS < len(text) else None
        stop = found.start() if found else len(text)
        pieces.append(text[begin:stop])
        begin = found.end() if found else stop
    return pieces


def slices(texts: pa.Array, chars: int = PIECE_CHARS) -> Iterator[list[str | None]]:
    """The texts in order, in lists of bounded total length (or of one text)."""
    part: list[str | None] = []
    size = 0
    for one in texts:
        text = one.as_py()
        if part and size + len(text or "") > chars:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text or "")
    if part:
        yield part


@functools.cache
def tokenizer(path: str) -> WordBPE:
    """One per Python worker."""
    return WordBPE(path)


def _id_lists(encoded: list[bytes]) -> pa.Array:
    offsets = np.r_[0, np.cumsum([len(ids) // 4 for ids in encoded])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(encoded), np.int32)))


def encode(text: Column, path: str) -> Column:
    """The token ids of a text as array<int>."""

    @F.arrow_udf("array<int>")
    def token_ids(texts: pa.Array) -> pa.Array:
        return _id_lists([ids for part in slices(texts) for ids in tokenizer(path).encode_batch(part)])

    return token_ids(text)


def encode_decode(text: Column, path: str) -> Column:
    """A struct of the token ids of a text and the text they decode to, in one pass over the text."""

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def round_trip(texts: pa.Array) -> pa.Array:
        bpe = tokenizer(path)
        encoded = [ids for part in slices(texts) for ids in bpe.encode_batch(part)]
        decoded = [bpe.decode_one(np.frombuffer(ids, np.int32)) for ids in encoded]
        return pa.StructArray.from_arrays([_id_lists(encoded), pa.array(decoded, pa.string())], ["ids", "decoded"])

    return round_trip(text)


def decode(ids: Column, path: str) -> Column:
    """The text of token ids, special tokens included."""

    @F.arrow_udf("string")
    def decoded_text(lists: pa.Array) -> pa.Array:
        bpe, nothing = tokenizer(path), np.empty(0, np.int32)
        arrays = (one.values.to_numpy(zero_copy_only=False) if one.is_valid else nothing for one in lists)
        return pa.array([bpe.decode_one(ids) for ids in arrays], pa.string())

    return decoded_text(ids)
