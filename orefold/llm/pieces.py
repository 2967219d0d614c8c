"""SentencePiece encoding and decoding with a max-plus parallel scan.

A vocabulary gives pieces and scores; an encoding is the segmentation of greatest total score, a path through a lattice in the
semiring (max, +). The vocabulary is read from a model file and never changed; its scores are taken as they are, also
those of a model that was made for merging pairs (for it the ids are this best path's, not those of its merges).

A space is the piece character for white space, and one more stands before the text, as SentencePiece has it. Characters
without a piece, and that character itself, are spelled in byte pieces, so decoding gives the text back exactly.
Equal sums are told apart by the sum of a hash of each piece, and then by the sum of hash times place; both stand in the lower
bits of one whole number with the score. So the best path is unique and the same however the text is cut.

Where white space starts no piece can cross, nor where two characters meet that stand side by side in no piece; the lattice falls apart at the former into words,
and words that are long at the latter, too, so text without white space is no dearer. A batch's words are numbered by
64-bit hashes (two words of a task fall together once in 2^64), new ones are solved together, place by place, and the ids of those
used lately are kept for later batches. Documents above ``GIANT`` characters are cut into chunks, each a row of its own:
1. Each chunk gives its transfer matrix: best sum from "the first piece boundary at or after my start is i characters on" to
   the same for the next chunk's start.
2. The matrices are multiplied in (max, +), ``FAN`` neighbours into one, level by level until a document has one group left. From there the states at
   a group's ends give the states between its members, down to the chunks: products of the members before and after each
   boundary tell its state. A task holds ``FAN`` matrices of a document at a time.
3. Each chunk is backtraced by itself between its two states, and the ids are put together by chunk number. What lies between
   the first and the last place of a chunk that no piece crosses is the same for all states, so step 1 has its ids already.

Cases: null text is empty and has no ids; repeated rows are encoded one by one; an empty table gives an empty result; decoding unknown
or null ids skips them; of the input only the kept and the named columns are read, and a kept column can't be called ids.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .base import slices, staged, trim
from .langid import HashArray, mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
GIANT, CHUNK = 32_768, 16_384
KEPT_WORDS, LONG_WORD = 400_000, 64
#: Matrices that are multiplied at a time; ids that are decoded together.
FAN, PART = 16, 1 << 18
SPACE = "▁"
SCORE_BIT, HASH_BIT = 180, 100


_PRIME, _SALT, _ALL = 0x100000001B3, 0x9E3779B97F4A7C15, (1 << 64) - 1


def _hash(number: int) -> int:
    return int.from_bytes(hashlib.blake2b(str(number).encode(), digest_size=5).digest(), "big")


@lru_cache(1)
def _powers() -> np.ndarray:
    return np.array([pow(_PRIME, i, 1 << 64) for i in range(LONG_WORD)], np.uint64)


def _utf8_size(codes: np.ndarray) -> np.ndarray:
    """A space stands for the white-space character here."""
    return 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000) + 2 * (codes == 0x20)


def _runs(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, one run after the other."""
    return np.arange(int(count.sum())) + np.repeat(start - np.cumsum(count) + count, count)


class Memo:
    """Ids of words, by sorted 64-bit hashes; above ``most`` words, those go that weren't asked for in the latest calls."""

    def __init__(self, most: int):
        self.most, self.turn = most, 0
        self.keys, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.start, self.count, self.last = (np.zeros(0, np.int32) for _ in range(3))

    def missing(self, keys: np.ndarray) -> np.ndarray:
        """Which of the sorted keys aren't here; the others stay through the next ``add``."""
        self.turn += 1
        if not len(self.keys):
            return np.arange(len(keys))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        here = self.keys[at] == keys
        self.last[at[here]] = self.turn
        return np.flatnonzero(~here)

    def add(self, keys: np.ndarray, ids: np.ndarray, start: np.ndarray, count: np.ndarray) -> None:
        if len(self.keys) and len(self.keys) + len(keys) > self.most:
            half = len(self.last) // 2
            stay = np.flatnonzero(self.last > min(int(np.partition(self.last, half)[half]), self.turn - 1))
            self.ids = self.ids[_runs(self.start[stay], self.count[stay])]
            self.keys, self.count, self.last = self.keys[stay], self.count[stay], self.last[stay]
            self.start = (np.cumsum(self.count) - self.count).astype(np.int32)
        at = np.searchsorted(self.keys, keys)
        self.start, self.count = np.insert(self.start, at, start + len(self.ids)), np.insert(self.count, at, count)
        self.keys, self.last = np.insert(self.keys, at, keys), np.insert(self.last, at, self.turn)
        self.ids = np.concatenate([self.ids, ids])

    def look(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, and where those of each key begin and how many they are; each key must be here."""
        at = np.searchsorted(self.keys, keys)
        return self.ids, self.start[at], self.count[at]


class Vocabulary:
    def __init__(self, pieces: list[tuple[str, float, str]]):
        """(piece, score, kind) by id; kinds: piece, byte, other."""
        self.pieces = pieces
        scores = [s for _, s, k in pieces if k == "piece"]
        unknown = min(scores, default=0.0) - 10
        self.ids: dict[str, int] = {}
        self.weight: dict[str, int] = {}
        self.bytes = {int(p[1:-1], 16): i for i, (p, _, k) in enumerate(pieces) if k == "byte"}
        for i, (p, s, k) in enumerate(pieces):
            if k == "piece" and p not in self.ids:
                self.ids[p] = i
                self.weight[p] = self._weigh(s, i)
        self.turn = {p: _hash(i) & 0xFFFFFF for p, i in self.ids.items()}
        self.byte_weight, self.byte_turn = self._weigh(unknown, -1), _hash(-1) & 0xFFFFFF
        self.byte_score, self.byte_tie = round(unknown * 1000), _hash(-1)
        self.longest = max(map(len, self.ids), default=1)
        self.free = not any(SPACE in p.lstrip(SPACE) for p in self.ids)  # no piece has white space after another character
        self.line = not any("\n" in p for p in self.ids)
        self.memo = Memo(KEPT_WORDS)
        self._arrays(unknown)
        inner = {ord(a) << 21 | ord(b) for p in self.ids for a, b in zip(p[:-1], p[1:], strict=True)}
        self.inner = np.array(sorted(inner), np.int64)  # two characters that stand side by side in some piece
        spelled = [bytes([int(p[1:-1], 16)]) if k == "byte" else p.replace(SPACE, " ").encode() if k == "piece" else b"" for p, _, k in pieces] + [b""]
        self.spelled, self.spelled_size = np.frombuffer(b"".join(spelled), np.uint8), np.array([len(b) for b in spelled])
        self.spelled_start = np.cumsum(self.spelled_size) - self.spelled_size

    def _arrays(self, unknown: float) -> None:
        """Scores, hashes, turns and lengths by id; and by a hash of what pieces begin with, the id of the piece that it is, or -1."""
        n = len(self.pieces)
        self.score, self.tie, self.turns, self.length = (np.zeros(n, np.int64) for _ in range(4))
        for p, i in self.ids.items():
            self.score[i], self.tie[i], self.turns[i], self.length[i] = round(self.pieces[i][1] * 1000), _hash(i), self.turn[p], len(p)
        for b, i in self.bytes.items():  # a character's first byte stands for it, the others only add their weight
            lead = not 0x80 <= b < 0xC0
            self.score[i], self.tie[i], self.turns[i], self.length[i] = round(unknown * 1000), _hash(-1), self.byte_turn * lead, lead
        begun = sorted({p[:k] for p in self.ids for k in range(1, len(p) + 1)}, key=lambda p: (len(p), p))
        hashes: dict[str, int] = {"": 0}
        for p in begun:
            hashes[p] = (hashes[p[:-1]] * _PRIME + ord(p[-1])) & _ALL
        self.table = HashArray(np.array([(hashes[p] + len(p) * _SALT) & _ALL for p in begun], np.uint64))
        self.id_at = np.array([self.ids.get(p, -1) for p in begun], np.int32)[self.table.order]

    def apart(self, codes: np.ndarray) -> np.ndarray:
        """Whether no piece can hold both characters on either side, for each place between two characters."""
        pair = codes[:-1].astype(np.int64) << 21 | codes[1:]
        if not len(self.inner):
            return np.ones(len(pair), bool)
        return self.inner[np.minimum(np.searchsorted(self.inner, pair), len(self.inner) - 1)] != pair

    @staticmethod
    def _weigh(score: float, number: int) -> int:
        return (round(score * 1000) << SCORE_BIT) + (_hash(number) << HASH_BIT)

    def __reduce__(self):
        return Vocabulary, (self.pieces,)

    def mask(self, text: str) -> str:
        """The text as the lattice sees it: spaces become the white-space character, and that one a space, which no piece has."""
        return SPACE + (text.translate({0x20: 0x2581, 0x2581: 0x20}) if SPACE in text else text.replace(" ", SPACE))

    def step(self, s: str, i: int, j: int, at: int) -> int | None:
        """Weight of s[i:j], which stands at place ``at`` of the text, as one piece; one character without a piece in bytes."""
        piece = s[i:j]
        w = self.weight.get(piece)
        if w is not None:
            return w + self.turn[piece] * at
        return self.byte_weight * len(self.plain(piece).encode()) + self.byte_turn * at if j == i + 1 else None

    @staticmethod
    def plain(c: str) -> str:
        return SPACE if c == " " else c

    def spell(self, piece: str) -> list[int]:
        i = self.ids.get(piece)
        return [i] if i is not None else [self.bytes[b] for b in self.plain(piece).encode() if b in self.bytes]

    def forward(self, s: str, start: int, stop: int, origin: int = 0) -> tuple[list[int | None], list[int]]:
        """Best sums to start..stop, and where the last piece of each begins; s starts at place ``origin`` of the text."""
        best: list[int | None] = [None] * (stop - start + 1)
        back = [0] * (stop - start + 1)
        best[0] = 0
        get, turn, longest = self.weight.get, self.turn, self.longest
        for i in range(start, stop):
            at = best[i - start]
            if at is None:
                continue
            place = origin + i
            for j in range(i + 1, min(i + longest, stop) + 1):
                piece = s[i:j]
                w = get(piece)
                if w is None:
                    if j > i + 1:
                        continue
                    w = self.step(s, i, j, place) + at
                else:
                    w += at + turn[piece] * place
                k = j - start
                if best[k] is None or w > best[k]:
                    best[k], back[k] = w, i
        return best, back

    def solve(self, s: str, start: int, stop: int, origin: int = 0) -> tuple[list[int], int]:
        """Ids and sum of the best path."""
        best, back = self.forward(s, start, stop, origin)
        return self.read(s, start, [stop], back), best[-1]

    def read(self, s: str, start: int, cuts: list[int], back: list[int]) -> list[int]:
        """Ids along ``back`` from the last of ``cuts`` to start."""
        while cuts[-1] > start:
            cuts.append(back[cuts[-1] - start])
        cuts.reverse()
        return [i for a, b in zip(cuts[:-1], cuts[1:], strict=True) for i in self.spell(s[a:b])]

    def solve_words(self, codes: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best ids of the words codes[first : first + size], all at once: ids, and where each word's begin and how many it has."""
        order = np.argsort(size, kind="stable")
        start, count, out, done, held = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64), [], 0, 0
        while done < len(order):
            cells = np.arange(1, len(order) - done + 1) * size[order[done:]]
            part = order[done : done + max(1, int((cells <= 100_000).sum()))]
            ids, n = self._solve_some(codes, first[part], size[part])
            start[part], count[part] = held + np.cumsum(n) - n, n
            out.append(ids)
            done, held = done + len(part), held + len(ids)
        return np.concatenate(out) if out else np.zeros(0, np.int32), start, count

    def _solve_some(self, codes: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, most = len(first), int(sizes.max())
        least = np.int64(-(1 << 61))
        best, tie, place = np.full((most + 1, n), least), np.zeros((most + 1, n), np.int64), np.zeros((most + 1, n), np.int64)
        best[0] = 0
        came, piece = np.zeros((most + 1, n), np.int32), np.full((most + 1, n), -1, np.int32)
        # by size: the word and piece of each place, place by place; what no piece begins with isn't looked at further
        begins, word = np.nonzero(np.arange(most)[:, None] < sizes)
        h, found, odd = np.zeros(len(word), np.uint64), [], False
        for size in range(1, min(self.longest, most) + 1):
            char = codes[first[word] + begins + size - 1].astype(np.uint64)
            h = h * np.uint64(_PRIME) + char
            at = self.table.find(h + np.uint64(size * _SALT & _ALL))
            ids = np.where(at >= 0, self.id_at[at], -1)
            if size == 1:  # a character without a piece is -2 less its code point
                ids = np.where(ids < 0, -2 - char.astype(np.int32), ids)
                odd = bool((ids < -1).any())
            real = np.flatnonzero(ids != -1)
            found.append((word[real], ids[real], np.searchsorted(begins[real], np.arange(most + 1)).tolist()))
            on = np.flatnonzero((at >= 0) & (begins + size < sizes[word]))
            begins, word, h = begins[on], word[on], h[on]
        for i in range(most):
            for size in range(1, min(self.longest, most - i) + 1):
                word, ids, from_place = found[size - 1]
                here = slice(from_place[i], from_place[i + 1])
                if here.start == here.stop:
                    continue
                j, k, own = i + size, word[here], ids[here]
                if i:
                    met = best[i, k] > least
                    k, own = k[met], own[met]
                known = np.maximum(own, 0) if odd else own
                score, more_tie, turns = self.score[known], self.tie[known], self.turns[known]
                if odd and size == 1:
                    spelled = own < 0
                    n_bytes = _utf8_size(-2 - own)
                    score = np.where(spelled, self.byte_score * n_bytes, score)
                    more_tie, turns = np.where(spelled, self.byte_tie * n_bytes, more_tie), np.where(spelled, self.byte_turn, turns)
                new, new_tie, new_place = best[i, k] + score, tie[i, k] + more_tie, place[i, k] + turns * i
                old = best[j, k]
                wins = (new > old) | ((new == old) & ((new_tie > tie[j, k]) | ((new_tie == tie[j, k]) & (new_place > place[j, k]))))
                k = k[wins]
                best[j, k], tie[j, k], place[j, k], came[j, k], piece[j, k] = new[wins], new_tie[wins], new_place[wins], i, own[wins]
        at, rows, order = sizes.copy(), [], []
        live = np.arange(n)
        while len(live):
            rows.append(live)
            order.append(piece[at[live], live])
            at[live] = came[at[live], live]
            live = live[at[live] > 0]
        row, ids = np.concatenate(rows), np.concatenate(order)
        by = np.lexsort((np.arange(len(row))[::-1], row))
        ids, count = ids[by], np.bincount(row, minlength=n)
        if odd:
            times = np.ones(len(ids), np.int64)
            spelled = np.flatnonzero(ids < 0)
            own = [self.spell(chr(-2 - i)) for i in ids[spelled].tolist()]
            times[spelled] = [len(o) for o in own]
            count = np.add.reduceat(np.append(times, 0), np.cumsum(count) - count)
            ids = np.repeat(ids, times)
            ids[ids < 0] = [i for o in own for i in o]
        return ids, count

    def encode_all(self, masked: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Texts as the lattice sees them to their ids, one after the other, and how many each has."""
        codes = np.frombuffer("".join(masked).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.array([len(m) for m in masked], np.int64)
        if not len(codes):
            return np.zeros(0, np.int32), np.zeros(len(masked), np.int64)
        ends = np.cumsum(lengths)
        edge = np.zeros(len(codes), bool)
        edge[(ends - lengths)[lengths > 0]] = True
        if self.free:
            gap = codes == ord(SPACE)
            edge |= gap
            edge[1:] &= ~(gap[1:] & gap[:-1])
            if self.line:
                lone = codes == 10
                edge |= lone
                edge[1:] |= lone[:-1]
            edge[(ends - lengths)[lengths > 0]] = True
        first = np.flatnonzero(edge)
        size = np.diff(np.append(first, len(codes)))
        if int(size.max()) > LONG_WORD:  # such words fall apart wherever no piece holds two neighbouring characters
            inside = np.flatnonzero(np.repeat(size > LONG_WORD, size) & ~edge)
            edge[inside] = self.apart(codes[np.stack([inside - 1, inside])].T.reshape(-1))[::2]
            first = np.flatnonzero(edge)
            size = np.diff(np.append(first, len(codes)))
        short = np.flatnonzero(size <= LONG_WORD)
        at = np.arange(len(codes)) - np.repeat(first, size)
        hashes = np.add.reduceat(mix(codes + np.uint32(1)) * _powers()[at & (LONG_WORD - 1)], first)[short]
        some, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        new = self.memo.missing(some)
        self.memo.add(some[new], *self.solve_words(codes, first[short][where[new]], size[short][where[new]]))
        ids, start, count = self.memo.look(some)
        starts, counts = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        starts[short], counts[short] = start[back], count[back]
        if len(short) < len(first):
            long = np.flatnonzero(size > LONG_WORD)
            own: dict[bytes, np.ndarray] = {}
            parts, held = [ids], len(ids)
            for k in long.tolist():
                word = codes[first[k] : first[k] + size[k]].tobytes()
                if word not in own:
                    s = word.decode("utf-32-le", "surrogatepass")
                    own[word] = np.array(self.solve(s, 0, len(s))[0], np.int32)
                parts.append(own[word])
                starts[k], counts[k] = held, len(own[word])
                held += len(own[word])
            ids = np.concatenate(parts)
        text_of = np.searchsorted(ends, first, "right")
        return ids[_runs(starts, counts)], np.bincount(text_of, weights=counts, minlength=len(masked)).astype(np.int64)

    def encode_texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        return self.encode_all([self.mask(t) if t else "" for t in texts])

    def encode(self, text: str | None) -> list[int]:
        return self.encode_texts([text])[0].tolist()

    def decode_all(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of ids that stand one after the other, ``counts`` of them each; ids that are none have no text."""
        own = np.where((ids >= 0) & (ids < len(self.pieces)), ids, len(self.pieces))
        size = self.spelled_size[own]
        data = self.spelled[_runs(self.spelled_start[own], size)].tobytes()
        ends = np.append(0, np.cumsum(size))[np.append(0, np.cumsum(counts))].tolist()
        texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return [t.removeprefix(" ") for t in texts]

    def decode(self, ids: list[int | None] | None) -> str:
        own = np.array([-1 if i is None else i for i in ids or []], np.int64)
        return self.decode_all(own, np.array([len(own)]))[0]

    # chunks of a giant document: s has the chunk's own ``size`` characters and what the next chunk begins with

    def chokes(self, s: str, size: int) -> list[int]:
        """Places in 0..size that no piece can cross, other than by starting or ending there."""
        out = set()
        for m in re.finditer(f"{SPACE}+|\n" if self.line else f"{SPACE}+", s) if self.free else ():
            lonely = m[0] == "\n"
            if m.start() <= size and (m.start() or lonely):
                out.add(m.start())
            if lonely and m.end() <= size:
                out.add(m.end())
        between = np.flatnonzero(self.apart(np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32))) + 1
        return sorted(out.union(between[between <= size].tolist()))

    def exits(self, s: str, start: int, size: int, origin: int) -> tuple[dict[int, tuple[int, int]], list[int]]:
        """From start to the first boundary at or after size: by its distance the best sum and where the last piece begins."""
        if start >= size:
            return {start - size: (0, start)}, []
        inner, back = self.forward(s, start, size, origin)
        out: dict[int, tuple[int, int]] = {}
        for i in range(max(start, size - self.longest), size):
            at = inner[i - start]
            for j in range(size, min(i + self.longest, len(s)) + 1):
                w = None if at is None else self.step(s, i, j, origin + i)
                if w is not None and (j - size not in out or at + w > out[j - size][0]):
                    out[j - size] = (at + w, i)
        return out, back

    def total(self, ids: np.ndarray, place: int) -> int:
        """Sum of a path of these ids that starts at a place of the text."""
        at = place + np.cumsum(self.length[ids]) - self.length[ids]
        turns = int((self.turns[ids].astype(object) * at).sum()) if place > 1 << 30 else int((self.turns[ids] * at).sum())
        return (int(self.score[ids].sum()) << SCORE_BIT) + (int(self.tie[ids].sum()) << HASH_BIT) + turns

    def transfer(self, s: str, size: int, origin: int) -> tuple[dict[tuple[int, int], int], int, int, np.ndarray]:
        """(entry, exit) to best sum; the first and the last choke (or -1); the ids between these.

        An entry is among the chunk's first characters and not beyond the first choke, as no piece crosses that.
        """
        chokes = self.chokes(s, size)
        if not chokes:
            none = {(i, j): v for i in range(min(self.longest, size + 1)) for j, (v, _) in self.exits(s, i, size, origin)[0].items()}
            return none, -1, -1, np.zeros(0, np.int32)
        first, last = chokes[0], chokes[-1]
        ids = self.encode_all([s[first:last]])[0]
        middle = self.total(ids, origin + first)
        tail = self.exits(s, last, size, origin)[0]
        out = {}
        for i in range(min(self.longest, first + 1)):
            head = self.forward(s, i, first, origin)[0][-1] + middle
            out.update({(i, j): head + v for j, (v, _) in tail.items()})
        return out, first, last, ids

    def ends(self, head: str, tail: str, first: int, last: int, size: int, origin: int, entry: int, leave: int) -> tuple[list[int], list[int]]:
        """Ids before the first choke and after the last one, of the best path from an entry to an exit."""
        if first < 0:
            return [], self._out(tail, entry, size, origin, leave) if entry < size else []
        return self.solve(head, entry, first, origin)[0], self._out(tail, 0, size - last, origin + last, leave) if last < size else []

    def _out(self, s: str, start: int, size: int, origin: int, leave: int) -> list[int]:
        best, back = self.exits(s, start, size, origin)
        return self.read(s, start, [size + leave, best[leave][1]], back)

    def chunk_path(self, s: str, size: int, origin: int, entry: int, leave: int) -> list[int]:
        """Ids of a chunk's best path from an entry to an exit."""
        _, first, last, ids = self.transfer(s, size, origin)
        before, after = self.ends(s[: max(first, 0)], s[max(last, 0) :], first, last, size, origin, entry, leave)
        return before + ids.tolist() + after


def load(path: str = MODEL) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    kind = lambda i: "byte" if sp.is_byte(i) else "other" if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) else "piece"
    return Vocabulary([(sp.id_to_piece(i), sp.get_score(i), kind(i)) for i in range(sp.get_piece_size())])


Matrix = dict[tuple[int, int], int]


def product(a: Matrix, b: Matrix) -> Matrix:
    """The (max, +) product: from an entry of a to an exit of b over the best state between."""
    rows: dict[int, list[tuple[int, int]]] = {}
    for (k, j), v in b.items():
        rows.setdefault(k, []).append((j, v))
    out: Matrix = {}
    for (i, k), u in a.items():
        for j, v in rows.get(k, ()):
            if (i, j) not in out or u + v > out[i, j]:
                out[i, j] = u + v
    return out


def scan(matrices: list[Matrix]) -> list[Matrix]:
    """Products of the first one, the first two, ..., by pairs: log n rounds, as the product is associative."""
    out, step = list(matrices), 1
    while step < len(out):
        out = out[:step] + [product(out[k - step], out[k]) for k in range(step, len(out))]
        step *= 2
    return out


def combine(matrices: list[Matrix], entry: int = 0, leave: int = 0) -> list[tuple[int, int]]:
    """(entry, exit) of each matrix on the best path from an entry of the first to an exit of the last.

    The state at a boundary is the one at which the product up to it and the product from it on have the greatest sum; as the best path
    is unique, each boundary can be looked at by itself.
    """
    upto = scan(matrices)
    turned = scan([{(j, i): v for (i, j), v in m.items()} for m in reversed(matrices)])
    states = [entry]
    for k in range(len(matrices) - 1):
        left, right = upto[k], turned[len(matrices) - 2 - k]
        sums = {j: v + right[leave, j] for (i, j), v in left.items() if i == entry and (leave, j) in right}
        states.append(max(sums, key=sums.__getitem__))
    return list(zip(states, [*states[1:], leave], strict=True))


def chunks(vocabulary: Vocabulary, text: str, chunk: int) -> list[tuple[int, str, int]]:
    """(number, characters with what follows, own size)."""
    s = vocabulary.mask(text)
    ahead = vocabulary.longest - 1
    return [(k, s[a : a + chunk + ahead], min(chunk, len(s) - a)) for k, a in enumerate(range(0, len(s), chunk))]


def encode(docs: DataFrame, vocabulary: Vocabulary, *keep: Column, text_col: str = "text", giant: int = GIANT, chunk: int = CHUNK, decoded: str | None = None) -> DataFrame:
    """The kept columns and ids (array of int); ``decoded``: the name of a column for the text that these ids decode to."""
    if chunk < vocabulary.longest:
        raise ValueError("a chunk must be as long as the longest piece")
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    long = F.coalesce(F.length(text_col), F.lit(0)) > giant
    own = docs.select(*keep, F.col(text_col).alias("__text"), long.alias("__long"))
    names = own.columns[:-2]
    fields = own.schema.fields[:-2]
    if "ids" in names or decoded in names:
        raise ValueError("a kept column has the name of a result")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text", 1 << 19):
            ids = shared.value.encode_texts(batch.column("__text").to_pylist())
            texts = [pa.array(shared.value.decode_all(*ids), pa.string())] if decoded else []
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), _lists(*ids), *texts], names=results)

    results = [*names, "ids", *([decoded] if decoded else [])]
    more = [StructField("ids", ArrayType(IntegerType())), *([StructField(decoded, StringType())] if decoded else [])]
    small = own.where("not __long").drop("__long").mapInArrow(run, StructType([*fields, *more]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), strict=True):
                got = chunks(shared.value, text, chunk)
                yield pa.RecordBatch.from_arrays([pa.array([row] * len(got), pa.int64()), pa.array([g[0] for g in got], pa.int32()), pa.array([g[1] for g in got]), pa.array([g[2] for g in got], pa.int32())], names=["row", "chunk", "part", "size"])

    giants = own.where("__long").drop("__long").withColumn("__row", F.monotonically_increasing_id())
    giants = staged(giants, "giants")
    parts = giants.select(F.col("__row").alias("row"), F.col("__text").alias("text")).mapInArrow(cut, "row bigint, chunk int, part string, size int").repartition("row", "chunk")

    def transfer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(k, 16) for k in range(0, batch.num_rows, 16)):
                texts, sizes, numbers = (part.column(c).to_pylist() for c in ("part", "size", "chunk"))
                got = [shared.value.transfer(t, n, k * chunk) for t, n, k in zip(texts, sizes, numbers, strict=True)]
                cols = [
                    part.column("row"), part.column("chunk"), part.column("size"), pa.array([t[: max(g[1], 0)] for t, g in zip(texts, got, strict=True)]), pa.array([t[max(g[2], 0) :] for t, g in zip(texts, got, strict=True)]),
                    pa.array([g[1] for g in got], pa.int32()), pa.array([g[2] for g in got], pa.int32()), _joined([g[3] for g in got]), pa.array([_cells(g[0]) for g in got], pa.list_(_CELL)),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=["row", "chunk", "size", "head", "tail", "first", "last", "middle", "cells"])
        trim()

    kept = f"row bigint, chunk int, size int, head string, tail string, first int, last int, middle array<int>, {_CELLS}"
    parts = staged(parts.mapInArrow(transfer, kept), "transfers")
    states = _states(parts.select("row", "chunk", "cells"))

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["head", "tail", "first", "last", "size", "chunk", "entry", "leave", "middle"]
        for batch in batches:
            ids = []
            for head, tail, first, last, size, k, a, b, middle in zip(*(batch.column(c) for c in names), strict=True):
                before, after = shared.value.ends(head.as_py(), tail.as_py(), first.as_py(), last.as_py(), size.as_py(), k.as_py() * chunk, a.as_py(), b.as_py())
                ids.append(np.concatenate([np.array(before, np.int32), middle.values.to_numpy(), np.array(after, np.int32)]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("chunk"), _joined(ids)], names=["row", "chunk", "part"])

    traced = parts.drop("cells").join(states, ["row", "chunk"]).mapInArrow(trace, "row bigint, chunk int, part array<int>")
    ids = traced.groupBy(F.col("row").alias("__row")).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "part"))), lambda x: x["part"])).alias("ids"))
    large = giants.drop("__text").join(ids, "__row").drop("__row")
    return small.unionByName(decode(large, vocabulary, to=decoded) if decoded else large)


def _grouped(level: DataFrame) -> DataFrame:
    """row, above (number of the group), all (chunk, cells); a group has at most ``FAN`` matrices."""
    return level.groupBy("row", F.floor(F.col("chunk") / FAN).cast("int").alias("above")).agg(F.array_sort(F.collect_list(F.struct("chunk", "cells"))).alias("all"))


def _states(level: DataFrame) -> DataFrame:
    """row, chunk, entry, leave of all chunks, from the stored matrices of the chunks.

    Upwards, groups of ``FAN`` neighbouring matrices are multiplied into one, until a document has one group only. Downwards, the states at
    a group's ends give those between its members.
    """

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [_cells(reduce(product, [_matrix(m["cells"]) for m in group])) for group in batch.column("all").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("above"), pa.array(got, pa.list_(_CELL))], names=["row", "chunk", "cells"])

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, group, a, b in zip(*(batch.column(c).to_pylist() for c in ("row", "all", "entry", "leave")), strict=True):
                got = combine([_matrix(m["cells"]) for m in group], a, b)
                cols = [[row] * len(got), [m["chunk"] for m in group], [g[0] for g in got], [g[1] for g in got]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int32(), pa.int32(), pa.int32()], strict=True)], names=["row", "chunk", "entry", "leave"])

    most = level.agg(F.coalesce(F.max("chunk"), F.lit(0))).first()[0]
    levels = [level]
    while most >= FAN:
        levels.append(staged(_grouped(levels[-1]).mapInArrow(multiply, f"row bigint, chunk int, {_CELLS}"), "products"))
        most //= FAN
    states = None
    for level in reversed(levels):
        groups = _grouped(level)
        if states is None:
            groups = groups.withColumns({"entry": F.lit(0), "leave": F.lit(0)})
        else:
            groups = groups.join(states.withColumnRenamed("chunk", "above"), ["row", "above"])
        states = groups.mapInArrow(between, "row bigint, chunk int, entry int, leave int")
    return states


_CELL = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("sum", pa.binary())])
_CELLS = "cells array<struct<a:int,b:int,sum:binary>>"


def _cells(m: Matrix) -> list[dict]:
    return [{"a": i, "b": j, "sum": v.to_bytes(40, "big", signed=True)} for (i, j), v in sorted(m.items())]


def _matrix(cells: list[dict]) -> Matrix:
    return {(c["a"], c["b"]): int.from_bytes(c["sum"], "big", signed=True) for c in cells}


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(ids.astype(np.int32), pa.int32()))


def _joined(ids: list[np.ndarray]) -> pa.ListArray:
    return _lists(np.concatenate([np.zeros(0, np.int32), *ids]), np.array([len(i) for i in ids], np.int64))


def decode(rows: DataFrame, vocabulary: Vocabulary, *, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """``rows`` and the text of their ids, as the column ``to``, which must be a new one."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)
    names = rows.columns
    if to in names:
        raise ValueError(f"there is a column {to}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch.column(names.index(ids_col))), 0).to_numpy().astype(np.int64)
            first = 0
            while first < batch.num_rows:  # as many rows as have ``PART`` ids, or one
                count = max(1, int((np.cumsum(lengths[first:]) <= PART).sum()))
                part = batch.slice(first, count)
                ids = pc.fill_null(pc.list_flatten(part.column(names.index(ids_col))), -1).to_numpy(zero_copy_only=False)
                texts = shared.value.decode_all(ids, lengths[first : first + count])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*names, to])
                first += count
        trim()

    return rows.mapInArrow(run, StructType([*rows.schema.fields, *StructType.fromDDL(f"`{to}` string").fields]))
