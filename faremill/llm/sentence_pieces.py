"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

White space becomes the space symbol and one is put before the text. The text falls into words that no piece of the
vocabulary crosses: a space symbol after another character begins a word, and a character that is in no longer piece is a word
of its own. The symbols of many new words lie in one flat numpy array. A round looks up every adjacent pair by binary search
in the sorted pair keys, takes the minimum pair rank of each word's segment, merges its leftmost occurrences and compacts the
arrays, until no pair remains.

All occurrences of a word's lowest rank are merged at once only if that equals merging them one by one: the merged symbol
must not begin or end a piece of the same or a lower rank (``alone`` marks the others, of which a round takes the leftmost
only). Words of many symbols that come to such a rank are finished with a heap, so a long run of spaces is not quadratic.

Characters outside of the vocabulary become their UTF-8 bytes. Decoding joins pieces, drops the space put before the text, and
shows bytes that are no UTF-8 as U+FFFD, one each. Null texts and null id lists count as empty: no ids, and the empty text.
A text is read in cuts of about a million characters at word borders, and the words already seen are kept in two caches of bounded size,
so a long text needs bounded memory besides its ids (one word without a border is read whole). Rows are independent: repeated rows,
ties and empty tables need no rule, and other columns are not read.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import re

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column
from pyspark.sql import functions as F

from faremill.llm.bpe import slices

SPACE = "▁"
CACHED_WORDS = 120_000
CACHED_LENGTH = 48
CUT_CHARS = 1 << 20
#: Words of more symbols are finished with a heap once a rank allows only one merge a round.
LONG_WORD = 64
NO_RANK = np.iinfo(np.int32).max
_BORDER = re.compile(f"(?<=[^ {SPACE}])[ {SPACE}]")


def _char_class(chars: set[str]) -> str:
    return "".join(map(re.escape, sorted(chars)))


class PieceBPE:
    """The pieces, pair ranks and caches of one model file."""

    def __init__(self, path: str):
        # the library reads the file; encoding and decoding are ours
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.vocab_size()
        pieces = [model.id_to_piece(i) for i in range(self.size)]
        self.unknown = model.unk_id()
        self.control = {i for i in range(self.size) if model.is_control(i)}
        self.byte_ids = np.full(256, -1, np.int32)
        for i in range(self.size):
            if model.is_byte(i):
                self.byte_ids[int(pieces[i][3:5], 16)] = i
        if (self.byte_ids < 0).any() or any(model.is_unused(i) for i in range(self.size)):
            raise ValueError("the model needs byte pieces and no unused ones")
        skipped = {self.unknown, *self.control, *self.byte_ids.tolist()}
        normal = {piece: i for i, piece in enumerate(pieces) if i not in skipped}
        if any(SPACE in piece.lstrip(SPACE) for piece in normal):
            raise ValueError("a piece goes over the beginning of a word")
        self.tokens = [piece.replace(SPACE, " ").encode() for piece in pieces]
        for byte, i in enumerate(self.byte_ids):
            self.tokens[i] = bytes([byte])
        for i in self.control:
            self.tokens[i] = b""
        self.tokens[self.unknown] = " ⁇ ".encode()
        self.leading = {i for piece, i in normal.items() if piece.startswith(SPACE)}

        # equal scores have one rank; a symbol is the id of its piece, or size + code point
        scores = {piece: model.get_score(i) for piece, i in normal.items()}
        rank_of = {score: rank for rank, score in enumerate(sorted(set(scores.values()), reverse=True))}
        rank = {piece: rank_of[scores[piece]] for piece in normal}
        symbol = normal | {c: self.size + ord(c) for piece in normal for c in piece if c not in normal}
        self.base = self.size + 0x110000
        pairs = [(a, b, piece) for piece in normal for k in range(1, len(piece)) if (a := piece[:k]) in symbol and (b := piece[k:]) in symbol]
        keys = np.array([symbol[a] * self.base + symbol[b] for a, b, _ in pairs], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.made = np.array([normal[piece] for _, _, piece in pairs], np.int32)[order]
        self.pair_rank = np.array([rank[piece] for _, _, piece in pairs], np.int32)[order]
        ends = {part for piece in normal for k in range(1, len(piece)) for part in (piece[:k], piece[k:]) if rank.get(part, -1) >= rank[piece]}
        self.alone = np.zeros(self.size, bool)
        self.alone[[normal[part] for part in ends]] = True

        self.first = np.arange(0x110000, dtype=np.int32) + self.size
        for piece, i in normal.items():
            if len(piece) == 1:
                self.first[ord(piece)] = i
        joining = {c for piece in normal if len(piece) > 1 for c in piece} - {SPACE}
        inner = _char_class(joining)
        self.words = re.compile(f"{SPACE}*[{inner}]+|{SPACE}+|[^{inner}{SPACE}]")
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _pairs(self, ids: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Number of the pair that begins at each given place; -1 where no piece is made of it or the word ends."""
        nxt = np.minimum(at + 1, len(ids) - 1)
        key = ids[at].astype(np.int64) * self.base + ids[nxt]
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[place] == key) & (word[at] == word[nxt]) & (nxt > at), place, -1)

    def _one_by_one(self, ids: list[int]) -> list[int]:
        """The symbols of one word after all merges, by a heap of (rank, place)."""
        after, before = [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)]
        heap: list[tuple[int, int, int, int, int]] = []

        def push(places: list[int]) -> None:
            places = [at for at in places if at >= 0 and after[at] >= 0]
            key = np.array([ids[at] * self.base + ids[after[at]] for at in places], np.int64)
            found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            for at, pair in zip(np.array(places)[self.keys[found] == key].tolist() if places else [], found[self.keys[found] == key].tolist(), strict=True):
                heapq.heappush(heap, (int(self.pair_rank[pair]), at, ids[at], ids[after[at]], pair))

        push(list(range(len(ids))))
        while heap:
            _, at, left, right, pair = heapq.heappop(heap)
            if ids[at] != left or after[at] < 0 or ids[after[at]] != right:
                continue
            gone = after[at]
            ids[at], ids[gone], after[at] = int(self.made[pair]), -1, after[gone]
            if after[at] >= 0:
                before[after[at]] = at
            push([before[at], at])
        return [i for i in ids if i >= 0]

    def merge_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words one after another after all merges, and the number of the word of each."""
        lengths = np.array([len(w) for w in words], np.int64)
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        ids, word = self.first[flat], np.repeat(np.arange(len(words)), lengths)
        pair = self._pairs(ids, word, np.arange(len(ids)))
        done_ids, done_words = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        while len(ids):
            rank = np.where(pair >= 0, self.pair_rank[pair], NO_RANK)
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            sizes = np.diff(np.r_[starts, len(ids)])
            lowest = np.minimum.reduceat(rank, starts)
            hits = np.flatnonzero((rank == np.repeat(lowest, sizes)) & (rank != NO_RANK))
            segment = np.searchsorted(starts, hits, "right") - 1
            single = np.zeros(len(starts), bool)
            single[segment[self.alone[self.made[pair[hits]]]]] = True
            finished = (lowest == NO_RANK) | (single & (sizes > LONG_WORD))
            for nth in np.flatnonzero(finished & (lowest != NO_RANK)):
                rest = np.array(self._one_by_one(ids[starts[nth] : starts[nth] + sizes[nth]].tolist()), np.int32)
                done_ids.append(rest)
                done_words.append(np.full(len(rest), word[starts[nth]]))
            plain = np.repeat(lowest == NO_RANK, sizes)
            done_ids.append(ids[plain])
            done_words.append(word[plain])
            # of a run of overlapping pairs every other one is merged, from the left; of words marked single the first one only
            order = np.arange(len(hits))
            new_run = np.r_[True, (np.diff(hits) != 1) | (np.diff(segment) != 0)][: len(hits)]
            run = np.maximum.accumulate(np.where(new_run, order, 0)) if len(hits) else order
            leading = np.r_[True, np.diff(segment) != 0][: len(hits)]
            take = ((order - run) % 2 == 0) & (~single[segment] | leading) & ~finished[segment]
            hits = hits[take]
            ids = ids.copy()
            ids[hits] = self.made[pair[hits]]
            stay = np.repeat(~finished, sizes)
            changed = np.zeros(len(ids), bool)
            changed[hits] = True
            changed[hits[hits > 0] - 1] = True
            stay[hits + 1] = False
            # the symbol before a merged one may itself be gone: the one before that has the new neighbour
            before = hits[hits > 1]
            changed[before[~stay[before - 1]] - 2] = True
            ids, word, pair, changed = ids[stay], word[stay], pair[stay], changed[stay]
            if len(ids):
                at = np.flatnonzero(changed)
                pair[at] = self._pairs(ids, word, at)
        every = np.concatenate(done_words)
        order = np.argsort(every, kind="stable")
        return np.concatenate(done_ids)[order], every[order]

    def _with_bytes(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols outside of the vocabulary replaced by the ids of their UTF-8 bytes."""
        code = symbols - self.size
        if (code < 0).all():
            return symbols, word
        length = np.where(code < 0, 1, 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000))
        ids, code = np.repeat(symbols, length), np.repeat(code, length)
        nth = np.arange(len(ids)) - np.repeat(np.cumsum(length) - length, length)
        rest = np.repeat(length, length) - 1 - nth
        lead = np.array([0, 0xC0, 0xE0, 0xF0])[np.repeat(length, length) - 1]
        byte = np.where(nth > 0, 0x80 | ((code >> (6 * rest)) & 0x3F), lead | (code >> (6 * rest)))
        return np.where(code < 0, ids, self.byte_ids[np.where(code < 0, 0, byte)]), np.repeat(word, length)

    def _learn(self, words: list[str]) -> None:
        if not words:
            return
        ids, word = self._with_bytes(*self.merge_words(words))
        raw = ids.astype(np.int32).tobytes()
        stops = (np.cumsum(np.bincount(word, minlength=len(words))) * 4).tolist()
        self.cache.update(zip(words, map(raw.__getitem__, map(slice, [0, *stops[:-1]], stops)), strict=True))

    def _encode_words(self, lists: list[list[str]]) -> list[bytes]:
        needed = set().union(*lists)
        new = needed - self.cache.keys()
        if len(self.cache) + len(new) > CACHED_WORDS:
            self.older = {word: ids for word, ids in self.cache.items() if len(word) <= CACHED_LENGTH}
            self.cache, new = {}, needed
        again = new & self.older.keys()
        self.cache.update((word, self.older[word]) for word in again)
        self._learn(list(new - again))
        return [b"".join(map(self.cache.__getitem__, words)) for words in lists]

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text, as the bytes of an int32 array."""
        short = [nth for nth, text in enumerate(texts) if text and len(text) <= CUT_CHARS]
        made = dict(zip(short, self._encode_words([self.words.findall(SPACE + texts[nth].replace(" ", SPACE)) for nth in short]), strict=True))
        return [made[nth] if nth in made else self._long(text) if text else b"" for nth, text in enumerate(texts)]

    def _long(self, text: str) -> bytes:
        out, begin = [], 0
        while begin < len(text):
            border = _BORDER.search(text, begin + CUT_CHARS) if begin + CUT_CHARS < len(text) else None
            stop = border.start() if border else len(text)
            part = text[begin:stop].replace(" ", SPACE)
            out += self._encode_words([self.words.findall(part if begin else SPACE + part)])
            begin = stop
        return b"".join(out)

    def decode_one(self, ids: np.ndarray) -> str:
        """The text of the ids. Ids that the vocabulary does not have are an error, as in the library."""
        numbers = ids.tolist()
        first = next((i for i in numbers if i not in self.control), None)
        # bytes on either side of a control piece do not make one character
        runs = [numbers] if self.control.isdisjoint(numbers) else [[*run] for cut, run in itertools.groupby(numbers, self.control.__contains__) if not cut]
        text = "".join(_shown(b"".join(map(self.tokens.__getitem__, run))) for run in runs)
        return text[1:] if first in self.leading else text


def _shown(raw: bytes) -> str:
    """Decoded bytes; every byte that belongs to no whole character is shown as U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode())
            break
        except UnicodeDecodeError as wrong:
            out += [raw[at : at + wrong.start].decode(), "�"]
            at += wrong.start + 1
    return "".join(out)


@functools.cache
def model(path: str) -> PieceBPE:
    """One per Python worker."""
    return PieceBPE(path)


def _id_lists(encoded: list[bytes]) -> pa.Array:
    offsets = np.r_[0, np.cumsum([len(ids) // 4 for ids in encoded])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(encoded), np.int32)))


def encode(text: Column, path: str) -> Column:
    """The piece ids of a text as array<int>."""

    @F.arrow_udf("array<int>")
    def piece_ids(texts: pa.Array) -> pa.Array:
        return _id_lists([ids for part in slices(texts) for ids in model(path).encode_batch(part)])

    return piece_ids(text)


def decode(ids: Column, path: str) -> Column:
    """The text of piece ids."""

    @F.arrow_udf("string")
    def decoded_text(lists: pa.Array) -> pa.Array:
        bpe, nothing = model(path), np.empty(0, np.int32)
        arrays = (one.values.to_numpy(zero_copy_only=False) if one.is_valid else nothing for one in lists)
        return pa.array([bpe.decode_one(ids) for ids in arrays], pa.string())

    return decoded_text(ids)


def encode_decode(text: Column, path: str) -> Column:
    """A struct of the piece ids of a text and the text they decode to, in one pass over the text."""

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def round_trip(texts: pa.Array) -> pa.Array:
        bpe = model(path)
        encoded = [ids for part in slices(texts) for ids in bpe.encode_batch(part)]
        decoded = [bpe.decode_one(np.frombuffer(ids, np.int32)) for ids in encoded]
        return pa.StructArray.from_arrays([_id_lists(encoded), pa.array(decoded, pa.string())], ["ids", "decoded"])

    return round_trip(text)
