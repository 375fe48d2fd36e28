"""SentencePiece encoding, by merges or as a max-plus scan, and decoding.

``encoded_documents`` follows the type of the model, so its ids are the library's ids.

BPE: the merges of a text leave the one sequence of pieces in which every two neighbours are what
the merges give for their two texts together. So a cut is best if all its neighbours are such pairs: a pair weighs 0
if it is one and minus infinity if not. Which pairs are allowed is found by merging them, and remembered. Words that
lie inside a chunk are merged directly, which gives the same pieces and is faster for short texts; the words that
meet its borders, of whatever length, are cut by pairs. A text for which no sequence is found would be
merged as a whole; none is known.

Unigram: the encoding of a text is its best-scoring cut into pieces of the model: the sum of the piece
scores is largest, and where sums are equal the longer last piece wins. Scores are taken to integers,
so results do not depend on how a text was cut into chunks. ``encode`` does this with the pieces of any
model unless told to merge.

Texts of up to ``CHUNK`` characters are decoded where they are read. Longer ones become chunks. What a
chunk needs to know of what lies before it is a state: for unigram models the best scores of the last L text
positions, L being the longest piece; for BPE the last place at the border or before it where a piece ended, and
that piece. A chunk is a matrix from states entered to states left in the (max, +) algebra. Chunks yield their
matrices independently; groups of neighbours are multiplied, level by level; from the top the vectors
at the chunk borders are handed down. With its vector a chunk says for each state it may be left in
in which it was entered; following these from the end of the text fixes all borders, and every
chunk then traces its own pieces back independently. A word may be as long as the text.

No piece continues a word into the next one (checked against the model), so words are cut once and
remembered, and inside a chunk only its first and last word meet the borders.

NULL texts are empty and have no pieces. Repeated rows and NULL identifiers keep their own rows.
An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import itertools
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F, types as T
from sentencepiece import sentencepiece_model_pb2

from rostra.llm.common import prepare, table
from rostra.session import staged

CHUNK = 1 << 15
FANOUT = 32
SPACE = "▁"
GAP = "\0"
NONE = -(1 << 60)
REMEMBERED = 1 << 19  # words kept in a task; memory only, no effect on results
SHORT_WORD = 40  # characters up to which the best neighbours are looked for in a list


@dataclass(frozen=True)
class Model:
    """Pieces with integer scores, as shipped to tasks."""

    pieces: tuple[str, ...]
    scores: tuple[int, ...]
    byte_ids: tuple[int, ...]  # 256 of them, or none
    unknown: int
    unknown_score: int
    longest: int
    prefix: bool

    def table(self) -> dict[str, tuple[int, int]]:
        special = {*self.byte_ids, self.unknown}
        return {p: (i, self.scores[i]) for i, p in enumerate(self.pieces) if p and i not in special}


def load_model(path: str) -> Model:
    """Read a model file on the driver."""
    own = sentencepiece.SentencePieceProcessor(model_file=path)
    n = own.get_piece_size()
    raw = [own.get_score(i) for i in range(n)]
    normal = [
        i for i in range(n) if not (own.is_control(i) or own.is_unknown(i) or own.is_unused(i) or own.is_byte(i))
    ]
    scale = 1 if all(float(raw[i]).is_integer() for i in normal) else 1 << 20
    scores = [round(s * scale) for s in raw]
    usable = set(normal)
    pieces = [own.id_to_piece(i) if i in usable else "" for i in range(n)]
    byte_ids = {int(own.id_to_piece(i)[3:5], 16): i for i in range(n) if own.is_byte(i)}
    return Model(
        tuple(pieces),
        tuple(scores),
        tuple(byte_ids[b] for b in range(256)) if len(byte_ids) == 256 else (),
        own.unk_id(),
        min(scores[i] for i in normal) - 10 * scale,
        max(map(len, pieces)),
        own.encode("a", out_type=str)[0].startswith(SPACE),
    )


def merges_needed(path: str) -> bool:
    """Whether a model file is of BPE type. Models whose ids would not be the library's are errors."""
    spec = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        spec.ParseFromString(f.read())
    kinds, types = sentencepiece_model_pb2.TrainerSpec, sentencepiece_model_pb2.ModelProto.SentencePiece
    kind, normal = spec.trainer_spec.model_type, spec.normalizer_spec
    if kind not in (kinds.UNIGRAM, kinds.BPE):
        raise ValueError(f"{kinds.ModelType.Name(kind)} models are not supported")
    if normal.precompiled_charsmap or normal.remove_extra_whitespaces or spec.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("models that normalise texts are not supported")
    if kind == kinds.BPE:
        own = {p.type for p in spec.pieces}
        if own & {types.USER_DEFINED, types.UNUSED} or types.BYTE not in own:
            raise ValueError("BPE models need byte pieces, and no user-defined or unused ones")
    return kind == kinds.BPE


class Lattice:
    """Best cuts of texts into pieces."""

    def __init__(self, model: Model):
        self.model, self.entries, self.longest = model, model.table(), model.longest
        self.words: dict[str, tuple[bytes, int]] = {}
        # Pieces and their beginnings; a beginning that is no piece has id -1.
        self.prefixes = {p[:k]: (-1, 0) for p in self.entries for k in range(1, len(p))} | self.entries
        self._automaton = None
        alone = all("\n" not in p for p in self.entries)
        inside = any(SPACE in p.lstrip(SPACE) for p in self.entries)
        end = "\n" if alone else ""
        if inside:
            self.cut = re.compile("[^\n]+|\n" if alone else "(?s).+")
        else:
            self.cut = re.compile(f"{SPACE}+[^{SPACE}{end}]*|[^{SPACE}{end}]+" + ("|\n" if alone else ""))

    def normal(self, text: str) -> str:
        return (SPACE if self.model.prefix and text else "") + text.replace(" ", SPACE)

    def forward(self, text: str, known: list[int]) -> tuple[list[int], list[int]]:
        """Best score of every position and where its last piece starts, from known scores on.

        Of pieces that end at a position the one that starts first is tried first and kept on ties.
        """
        n, given = len(text), len(known)
        best, back = known + [NONE] * (n + 1 - given), [-1] * (n + 1)
        find, unknown, longest = self.prefixes.get, self.model.unknown_score, self.longest
        for start in range(max(0, given - longest), n):
            before = best[start]
            if before == NONE:
                continue
            alone = True
            for end in range(start + 1, min(n, start + longest) + 1):
                entry = find(text[start:end])
                if entry is None:
                    break
                if entry[0] >= 0:
                    if end == start + 1:
                        alone = False
                    score = before + entry[1]
                    if end >= given and score > best[end]:
                        best[end], back[end] = score, start
            if alone and start + 1 >= given and before + unknown > best[start + 1]:
                best[start + 1], back[start + 1] = before + unknown, start
        return best, back

    def trace(self, text: str, back: list[int], end: int, stop: int) -> bytes:
        """Ids of the pieces from the first position of at most ``stop`` on the way back to ``end``."""
        spans = []
        while end > stop:
            spans.append((back[end], end))
            end = back[end]
        ids: list[int] = []
        for s, e in reversed(spans):
            entry = self.entries.get(text[s:e])
            if entry is not None:
                ids.append(entry[0])
            elif self.model.byte_ids:
                ids += [self.model.byte_ids[b] for b in text[s:e].encode()]
            else:
                ids.append(self.model.unknown)
        return array("i", ids).tobytes()

    def word(self, text: str) -> tuple[bytes, int]:
        """Ids of a word by itself, as 32-bit integers, and its score."""
        known = self.words.get(text)
        if known is None:
            best, back = self.forward(text, [0])
            known = self.trace(text, back, len(text), 0), best[-1]
            if len(self.words) >= REMEMBERED:
                self.words.clear()
            self.words[text] = known
        return known

    @property
    def automaton(self) -> ahocorasick.Automaton:
        """Finds all pieces in a text; of pieces that end together the longest comes first."""
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for p, (i, score) in self.entries.items():
                self._automaton.add_word(p, (i, score, len(p)))
            self._automaton.make_automaton()
        return self._automaton

    def learn(self, words: Iterable[str]) -> None:
        """Cut many words at once: their pieces are found in one run of an automaton.

        The words stand one after the other with a sign between them that is in no piece.
        """
        new = [w for w in set(words) if w not in self.words and GAP not in w]
        if len(self.words) + len(new) > REMEMBERED:
            self.words.clear()
        if not new or GAP in self.prefixes:
            return
        text = GAP.join(new)
        best, back, ids = [0] * (len(text) + 1), [0] * (len(text) + 1), [0] * (len(text) + 1)
        unknown, done, alone, top, origin, piece = self.model.unknown_score, 1, False, NONE, 0, -1
        for at, (i, score, size) in itertools.chain(self.automaton.iter(text), [(len(text), (-1, 0, 1))]):
            while done <= at:  # no more pieces end at this place
                if not alone and best[done - 1] + unknown > top:
                    top, origin, piece = best[done - 1] + unknown, done - 1, -1
                best[done], back[done], ids[done] = top, origin, piece
                done, alone, top, origin, piece = done + 1, False, NONE, 0, -1
            if at == len(text):
                break
            score += best[at + 1 - size]
            if score > top:
                top, origin, piece = score, at + 1 - size, i
            if size == 1:
                alone = True
        end = 0
        for word in new:
            start, end = end, end + len(word)
            own, at = [], end
            while at > start:
                i = ids[at]
                if i >= 0:
                    own.append(i)
                elif self.model.byte_ids:
                    own += [self.model.byte_ids[b] for b in reversed(text[at - 1].encode())]
                else:
                    own.append(self.model.unknown)
                at = back[at]
            own.reverse()
            self.words[word] = array("i", own).tobytes(), best[end] - best[start]
            end += 1

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        found = [self.cut.findall(self.normal(t)) for t in texts]
        self.learn(w for words in found for w in words)
        word = self.word
        return [b"".join([word(w)[0] for w in words]) for words in found]


class Merges(Lattice):
    """Cuts of texts into pieces by the merges of a BPE model."""

    def learn(self, words: Iterable[str]) -> None:
        """Words are cut when they are asked for."""

    @cached_property
    def ranks(self) -> dict[str, int]:
        """Scores of the pieces."""
        return {p: score for p, (_, score) in self.entries.items()}

    def merged(self, text: str) -> list[str]:
        """The pieces of a word, and single characters that are in no piece."""
        if len(text) > SHORT_WORD:
            return self._merged_by_queue(text)
        parts, find = list(text), self.ranks.get
        scores = [find(a + b, NONE) for a, b in itertools.pairwise(parts)]
        while scores and (top := max(scores)) != NONE:
            at = scores.index(top)  # the first of equals
            parts[at] = piece = parts[at] + parts[at + 1]
            del parts[at + 1], scores[at]
            if at:
                scores[at - 1] = find(parts[at - 1] + piece, NONE)
            if at < len(scores):
                scores[at] = find(piece + parts[at + 1], NONE)
        return parts

    def _merged_by_queue(self, text: str) -> list[str]:
        """The same for a word of any length: looking through all neighbours for the best would take its square."""
        parts, find = list(text), self.entries.get
        before, after = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        queue = []
        for at, (a, b) in enumerate(itertools.pairwise(parts)):
            if (entry := find(a + b)) is not None:
                queue.append((-entry[1], at, a + b))
        heapq.heapify(queue)
        n = len(parts)
        while queue:
            _, at, piece = heapq.heappop(queue)
            other = after[at]
            # A part only grows, and '' is a part that was merged away, so lengths tell stale pairs.
            if not parts[at] or other == n or len(parts[at]) + len(parts[other]) != len(piece):
                continue
            parts[at], parts[other] = piece, ""
            after[at] = right = after[other]
            if right < n:
                before[right] = at
                if (entry := find(piece + parts[right])) is not None:
                    heapq.heappush(queue, (-entry[1], at, piece + parts[right]))
            left = before[at]
            if left >= 0 and (entry := find(parts[left] + piece)) is not None:
                heapq.heappush(queue, (-entry[1], left, parts[left] + piece))
        return [p for p in parts if p]

    def word(self, text: str) -> tuple[bytes, int]:
        """Ids of a word as 32-bit integers; merges have no score to add up."""
        known = self.words.get(text)
        if known is None:
            ids: list[int] = []
            for part in self.merged(text):
                entry = self.entries.get(part)
                if entry is not None:
                    ids.append(entry[0])
                else:
                    ids += [self.model.byte_ids[b] for b in part.encode()]
            known = array("i", ids).tobytes(), 0
            if len(self.words) >= REMEMBERED:
                self.words.clear()
            self.words[text] = known
        return known


State = tuple[int, int]  # how far before the border a piece ended, and its length; 0 where no neighbour counts


class _Known(dict):
    """Ids of words, cut when they are first asked for."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> bytes:
        self[word] = found = self.make(word)
        return found


class Pairs(Merges):
    """Cuts of texts into pieces of a BPE model as best paths over pairs of neighbours."""

    def __init__(self, model: Model):
        super().__init__(model)
        self.known, self.wrong, self.pairs = _Known(self._ids_of_word), set(), {}
        self.by_space = self.cut.pattern.startswith(SPACE)
        self.by_line = "\n" in self.cut.pattern
        self.numbers = {p: i for p, (i, _) in self.entries.items()}
        self.bytes_of = [p.replace(SPACE, " ").encode() for p in model.pieces]
        for b, i in enumerate(model.byte_ids):
            self.bytes_of[i] = bytes([b])

    def allowed(self, left: str, right: str) -> bool:
        """Whether the merges of both texts together leave just these two."""
        key = left, right
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            both = left + right
            found = self.pairs[key] = both not in self.entries and self.merged(both) == [left, right]
        return found

    def is_border(self, before: str, after: str) -> bool:
        """Whether a word ends between two characters."""
        if self.by_line and (before == "\n" or after == "\n"):
            return True
        return self.by_space and after == SPACE != before

    def sizes(self, text: str) -> list[list[int]]:
        """Lengths of the pieces that end at each place, longest first; a single character always counts."""
        out: list[list[int]] = [[] for _ in range(len(text) + 1)]
        for at, (_, _, size) in self.automaton.iter(text):
            out[at + 1].append(size)
        for place, own in enumerate(out):
            if place and (not own or own[-1] != 1):
                own.append(1)
        return out

    def paths(self, text: str, base: int, starts: list[State], sizes: list[list[int]]) -> tuple[list[int], list[list[int]]]:
        """Lengths of the last pieces at each place after ``base``, by front; and each start's front, -1 if it has none.

        A start is the last place at ``base`` or before it where a piece ended. Starts whose last pieces have been
        the same for as many places as a piece can have go on as one front.
        """
        n, longest, allowed = len(text), self.longest, self.allowed
        fronts, owner = [], list(range(len(starts)))
        for back, size in starts:
            last = [-1] * (n + 1)  # -1: no piece ends here
            last[base - back] = size
            fronts.append(last)
        alive, joined, step = list(range(len(starts))), {}, 2 * longest
        places = [base - back for back, _ in starts]
        for q in range(base + 1, n + 1):
            for f in alive:
                last, place = fronts[f], places[f]
                for size in sizes[q]:
                    s = q - size
                    if s < base and s != place or s == base and place != base or last[s] < 0:
                        continue
                    if last[s] == 0 or allowed(text[s - last[s] : s], text[s:q]):
                        last[q] = size
                        break
            if len(alive) > 1 and (q - base) % step == 0:
                groups: dict[tuple, int] = {}
                for f in alive:
                    window = tuple(fronts[f][q - longest : q + 1])
                    if max(window) >= 0:
                        joined[f] = groups.setdefault(window, f)
                alive = list(groups.values())
        heads = set(alive)
        for i in range(len(starts)):
            f = i
            while f not in heads and joined.get(f, f) != f:
                f = joined[f]
            owner[i] = f if f in heads else -1
        return owner, fronts

    def back(self, text: str, last: list[int], end: int, stop: int) -> list[str]:
        """The pieces from ``stop`` to ``end``."""
        out = []
        while end > stop:
            out.append(text[end - last[end] : end])
            end -= last[end]
        return out[::-1]

    def ids_of(self, parts: list[str]) -> list[int]:
        ids: list[int] = []
        for part in parts:
            entry = self.entries.get(part)
            if entry is not None:
                ids.append(entry[0])
            else:
                ids += [self.model.byte_ids[b] for b in part.encode()]
        return ids

    def blob(self, parts: list[str]) -> bytes:
        return array("i", self.ids_of(parts)).tobytes()

    def _ids_of_word(self, text: str) -> bytes:
        try:
            ids = [self.numbers[part] for part in self.merged(text)]
            right = "".join([self.model.pieces[i] for i in ids]) == text
        except KeyError:  # a character in no piece: its bytes
            ids = self.ids_of(self.merged(text))
            right = b"".join([self.bytes_of[i] for i in ids]) == text.replace(SPACE, " ").encode()
        if not right:
            self.wrong.add(text)
        return array("i", ids).tobytes()

    def word(self, text: str) -> tuple[bytes, int]:
        return self.known[text], 0

    def encode_checked(self, texts: list[str]) -> tuple[list[bytes], list[bool]]:
        """Ids of the texts, and whether they decode to them. Words are decoded when they are first cut."""
        blobs, right = [], []
        for text in texts:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
                self.wrong.clear()
            words = self.cut.findall(self.normal(text))
            blobs.append(b"".join(map(self.known.__getitem__, words)))
            right.append(SPACE not in text and not (self.wrong and any(w in self.wrong for w in words)))
        return blobs, right

    def encode_all(self, texts: list[str]) -> list[bytes]:
        return self.encode_checked(texts)[0]

    def states(self, window: str) -> list[State]:
        """States that a text may be in after ``window``, of which all but its last 2 L characters are cut off."""
        if not window:
            return [(0, 0)]
        out = []
        for back in range(min(self.longest, len(window))):
            place = len(window) - back
            if back and self.is_border(window[place - 1], window[place]):
                out.append((back, 0))
                break  # nothing before the start of a word is the last place
            out += [
                (back, k) for k in range(1, min(self.longest, place) + 1) if k == 1 or window[place - k : place] in self.entries
            ]
        else:
            if len(window) < self.longest:
                out.append((len(window), 0))  # the text's start
        return out


class Piecewise:
    """A chunk of a text for ``Pairs``: its first and last words, between the 2 L characters before each border.

    ``whole``: no word starts in the chunk, and the head is all of it.
    """

    def __init__(self, pairs: Pairs, before: str, after: str, head: str, tail: str, whole: bool):
        self.pairs, self.before, self.head, self.tail, self.whole = pairs, before, head, tail, whole
        self.entries, self.exits = pairs.states(before), pairs.states(after)

    def _heads(self, starts: list[State]) -> list[list[int] | None]:
        """For each start the last pieces at the places of the head; None where it leads nowhere."""
        if not self.head:  # a word starts at the border itself
            return [[] if back == 0 else None for back, _ in starts]
        text = self.before + self.head
        owner, fronts = self.pairs.paths(text, len(self.before), starts, self.pairs.sizes(text))
        return [fronts[f] if f >= 0 else None for f in owner]

    def _tails(self) -> list[int]:
        return self.pairs.paths(self.tail, 0, [(0, 0)], self.pairs.sizes(self.tail))[1][0]

    def matrix(self) -> np.ndarray:
        """Row: state left, column: state entered; 0 where the one leads to the other."""
        out = np.full((len(self.exits), len(self.entries)), NONE, dtype=np.int64)
        heads = self._heads(self.entries)
        if not self.whole:
            last, size = self._tails(), len(self.tail)
            fine = [e for e, (left, own) in enumerate(self.exits) if left <= size and last[size - left] == own]
            for j, own in enumerate(heads):
                if own is not None and (not self.head or own[-1] >= 0):
                    out[fine, j] = 0
            return out
        length, base = len(self.head), len(self.before)
        for j, (back, size) in enumerate(self.entries):
            for e, (left, own) in enumerate(self.exits):
                if left < length:
                    if heads[j] is not None and heads[j][base + length - left] == own:
                        out[e, j] = 0
                elif left == back + length and own == size:
                    out[e, j] = 0  # no piece ends in the chunk
        return out

    def ids(self, entered: int, left: int, middle: bytes) -> bytes:
        """Ids of the pieces that end in the chunk on the way between two states."""
        pairs, (back, _), gone = self.pairs, self.entries[entered], self.exits[left][0]
        text, base = self.before + self.head, len(self.before)
        last = self._heads([self.entries[entered]])[0]
        if self.whole:
            end = len(text) - gone
            return pairs.blob(pairs.back(text, last, end, base - back) if end > base else [])
        head = pairs.back(text, last, len(text), base - back) if self.head else []
        tail = pairs.back(self.tail, self._tails(), len(self.tail) - gone, 0)
        return pairs.blob(head) + middle + pairs.blob(tail)


def split_chunk(pairs: Pairs, window: str, text: str) -> tuple[str, str, bool, bytes]:
    """Head, tail, whether the head is all, and the ids of the words between them."""
    before = window[-1:]
    first = 0 if not before or pairs.is_border(before, text[0]) else -1
    starts = [m.start() for m in pairs.cut.finditer(text)]
    if first < 0:
        starts = [p for p in starts if p > 0 and pairs.is_border(text[p - 1], text[p])]
    if not starts:
        return text, "", True, b""
    middle = [text[a:b] for a, b in itertools.pairwise(starts)]
    if len(pairs.known) >= REMEMBERED:
        pairs.known.clear()
    return text[: starts[0]], text[starts[-1] :], False, b"".join(map(pairs.known.__getitem__, middle))


class Ends:
    """First and last word of a chunk, the only ones that meet its borders.

    ``head`` begins with the ``longest - 1`` characters before the chunk, so that the chunk starts at
    its place L-1. Without a cut in the chunk there is no tail, and the head is all of it.
    """

    def __init__(self, lattice: Lattice, head: str, tail: str, tail_at: int, size: int):
        self.lattice, self.states = lattice, lattice.longest
        self.head, self.tail, self.tail_at, self.size = head, tail, tail_at, size

    def matrix(self, middle: int) -> np.ndarray:
        """Row: state left, column: state entered; a state is one of the last L positions."""
        out = np.full((self.states, self.states), NONE, dtype=np.int64)
        tail = self.lattice.forward(self.tail, [0])[0] if self.tail_at >= 0 else None
        for i in range(self.states):
            best, _ = self.lattice.forward(self.head, [0 if j == i else NONE for j in range(self.states)])
            for j in range(self.states):
                place = self.size - self.states + 1 + j  # in the chunk's text
                if tail is None:
                    out[j, i] = best[place + self.states - 1] if place + self.states - 1 >= 0 else NONE
                elif place >= self.tail_at and best[-1] != NONE:
                    out[j, i] = best[-1] + middle + tail[place - self.tail_at]
        return out

    def entered(self, entry: list[int]) -> list[int]:
        """For each state left, the state entered."""
        _, back = self.lattice.forward(self.head, entry)
        stop = self.states - 1

        def origin(end: int) -> int:
            while end > stop:
                end = back[end]
            return end

        places = [self.size - self.states + 1 + j for j in range(self.states)]
        if self.tail_at < 0:
            return [origin(p + stop) if p + stop >= 0 else -1 for p in places]
        via = origin(len(self.head))
        return [via if p >= self.tail_at else -1 for p in places]  # nobody leaves from a middle word

    def ids(self, entry: list[int], left: int, middle: bytes) -> bytes:
        _, back = self.lattice.forward(self.head, entry)
        place = self.size - self.states + 1 + left
        if self.tail_at < 0:
            return self.lattice.trace(self.head, back, place + self.states - 1, self.states - 1)
        head = self.lattice.trace(self.head, back, len(self.head), self.states - 1)
        _, back = self.lattice.forward(self.tail, [0])
        return head + middle + self.lattice.trace(self.tail, back, place - self.tail_at, 0)


def chunk_ends(lattice: Lattice, before: str, text: str) -> tuple[Ends, bytes, int]:
    """Ends of a chunk, and the ids and the score of the words between them."""
    own = [m.span() for m in lattice.cut.finditer(text)]
    head = before.rjust(lattice.longest - 1, "\0") + text[: own[0][1]]
    words = [text[s:e] for s, e in own[1:-1]]
    lattice.learn(words)
    known = [lattice.word(w) for w in words]
    tail_at = own[-1][0] if len(own) > 1 else -1
    ends = Ends(lattice, head, text[tail_at:] if tail_at >= 0 else "", tail_at, len(text))
    return ends, b"".join([ids for ids, _ in known]), sum(score for _, score in known)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product in the (max, +) algebra; what cannot be reached stays so."""
    sums = a[:, :, None] + b[None, :, :]
    out = sums.max(axis=1)
    return np.where(out <= NONE // 2, NONE, out)


def _packed(matrix: np.ndarray) -> bytes:
    """A matrix with its number of columns in front."""
    return np.int64(matrix.shape[1]).tobytes() + matrix.tobytes()


def _matrix(blob: bytes) -> np.ndarray:
    values = np.frombuffer(blob, "<i8")
    return values[1:].reshape(-1, values[0])


def _apply(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    return times(matrix, vector[:, None])[:, 0]


def _start(states: int) -> np.ndarray:
    vector = np.full(states, NONE, dtype=np.int64)
    vector[-1] = 0
    return vector


def _cut_chunks(model: Model, size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice = Lattice(model)
        for batch in batches:
            for row, text in zip(batch["__row"], batch["__text"], strict=True):
                text = lattice.normal(text)
                for k, at in enumerate(range(0, len(text), size)):
                    yield pd.DataFrame({
                        "row": [row], "k": [k],
                        "before": [text[max(0, at - model.longest + 1) : at]],
                        "text": [text[at : at + size]],
                    })

    return run


def border_vectors(matrices: DataFrame, first: np.ndarray, fanout: int = FANOUT) -> DataFrame:
    """(row, k, entry): the vector at the start of each chunk, by a scan over (row, k, matrix); ``first`` is a text's."""
    levels = [staged(matrices, "transfer")]

    def product(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("k")
        out = _matrix(rows["matrix"].iloc[0])
        for blob in rows["matrix"].iloc[1:]:
            out = times(_matrix(blob), out)
        return pd.DataFrame({"row": rows["row"].iloc[:1], "k": rows["k"].iloc[:1] // fanout, "matrix": [_packed(out)]})

    while (levels[-1].agg(F.max("k")).first()[0] or 0) >= fanout:
        grouped = levels[-1].groupBy("row", F.floor(F.col("k") / fanout).alias("g"))
        levels.append(staged(grouped.applyInPandas(product, "row bigint, k bigint, matrix binary"), "transfer"))

    start = first.astype("<i8").tobytes()

    def hand_down(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("k")
        vector, out = np.frombuffer(rows["entry"].iloc[0], "<i8"), []
        for blob in rows["matrix"]:
            out.append(vector.tobytes())
            vector = _apply(_matrix(blob), vector)
        return pd.DataFrame({"row": rows["row"], "k": rows["k"], "entry": out})

    above = levels[-1].select("row").distinct().select("row", F.lit(0).cast("long").alias("g"), F.lit(start).alias("entry"))
    for level in reversed(levels):
        keyed = level.withColumn("g", F.floor(F.col("k") / fanout)).join(above, ["row", "g"])
        down = keyed.groupBy("row", "g").applyInPandas(hand_down, "row bigint, k bigint, entry binary")
        above = down.select("row", F.col("k").alias("g"), "entry")
    return staged(down, "borders")


def _encode_long(rows: DataFrame, model: Model, size: int, fanout: int) -> DataFrame:
    """(row, ids as bytes) for (__row, __text)."""
    states = model.longest
    shape = "row bigint, k bigint, before string, text string"
    chunked = rows.mapInPandas(_cut_chunks(model, size), shape).repartition("row", "k")

    def transfer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice = Lattice(model)
        for batch in batches:
            out = []
            for before, text in zip(batch["before"], batch["text"], strict=True):
                ends, middle, score = chunk_ends(lattice, before, text)
                out.append((ends.head, ends.tail, ends.tail_at, ends.size, middle, _packed(ends.matrix(score))))
            columns = ["head", "tail", "tail_at", "size", "middle", "matrix"]
            found = pd.DataFrame(out, columns=columns)
            yield pd.concat([batch[["row", "k"]].reset_index(drop=True), found], axis=1)

    ends = "head string, tail string, tail_at bigint, size bigint"
    known = staged(chunked.mapInPandas(transfer, f"row bigint, k bigint, {ends}, middle binary, matrix binary"), "chunks")
    borders = border_vectors(known.select("row", "k", "matrix"), _start(states), fanout)
    with_entry = known.drop("matrix").join(borders, ["row", "k"])

    def each(batch: pd.DataFrame, lattice: Lattice) -> Iterator[tuple[Ends, list[int]]]:
        for row in batch.itertuples():
            own = Ends(lattice, row.head, row.tail, row.tail_at, row.size)
            yield own, np.frombuffer(row.entry, "<i8").tolist()

    def entered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice = Lattice(model)
        for batch in batches:
            found = [own.entered(entry) for own, entry in each(batch, lattice)]
            yield pd.DataFrame({"row": batch["row"], "k": batch["k"], "via": found})

    def follow(rows: pd.DataFrame) -> pd.DataFrame:
        # A text has 2 ** 31 bytes at the most, hence 65,536 chunks, with one short list each.
        rows = rows.sort_values("k", ascending=False)
        state, out = states - 1, []
        for via in rows["via"]:
            out.append(state)
            state = via[state]
        return pd.DataFrame({"row": rows["row"], "k": rows["k"], "left": out})

    ways = with_entry.drop("middle").mapInPandas(entered, "row bigint, k bigint, via array<int>")
    exits = ways.groupBy("row").applyInPandas(follow, "row bigint, k bigint, left int")

    def traced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice = Lattice(model)
        for batch in batches:
            found = [
                own.ids(entry, int(x), bytes(m))
                for (own, entry), x, m in zip(each(batch, lattice), batch["left"], batch["middle"], strict=True)
            ]
            yield pd.DataFrame({"row": batch["row"], "k": batch["k"], "ids": found})

    return _joined(with_entry.join(staged(exits, "exits"), ["row", "k"]).mapInPandas(traced, "row bigint, k bigint, ids binary"))


def _joined(done: DataFrame) -> DataFrame:
    """(row, ids) of whole texts from (row, k, ids) of their chunks."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("k", "ids"))), lambda s: s["ids"])
    whole = F.aggregate(listed, F.lit(b""), lambda a, b: F.concat(a, b))
    return done.groupBy("row").agg(whole.alias("ids"))


def _pair_long(rows: DataFrame, model: Model, size: int, fanout: int) -> DataFrame:
    """(row, ids as bytes) for (__row, __text), by pairs; NULL ids where no sequence of pairs leads to the end."""
    reach = 2 * model.longest

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice = Lattice(model)
        for batch in batches:
            for row, text in zip(batch["__row"], batch["__text"], strict=True):
                text = lattice.normal(text)
                for k, at in enumerate(range(0, len(text), size)):
                    end = min(at + size, len(text))
                    yield pd.DataFrame({
                        "row": [row], "k": [k], "before": [text[max(0, at - reach) : at]],
                        "after": [text[max(0, end - reach) : end]], "text": [text[at:end]],
                    })

    def transfer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs = Pairs(model)
        for batch in batches:
            out = []
            for before, after, text in zip(batch["before"], batch["after"], batch["text"], strict=True):
                head, tail, whole, middle = split_chunk(pairs, before, text)
                own = Piecewise(pairs, before, after, head, tail, whole)
                out.append((head, tail, whole, middle, _packed(own.matrix())))
            found = pd.DataFrame(out, columns=["head", "tail", "whole", "middle", "matrix"])
            yield pd.concat([batch[["row", "k", "before", "after"]].reset_index(drop=True), found], axis=1)

    shape = "row bigint, k bigint, before string, after string"
    chunked = rows.mapInPandas(cut, f"{shape}, text string").repartition("row", "k")
    ends = "head string, tail string, whole boolean, middle binary, matrix binary"
    known = staged(chunked.mapInPandas(transfer, f"{shape}, {ends}"), "chunks")
    borders = border_vectors(known.select("row", "k", "matrix"), np.zeros(1, np.int64), fanout)

    def entered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs = Pairs(model)
        for batch in batches:
            via, last = [], []
            for after, matrix, entry in zip(batch["after"], batch["matrix"], batch["entry"], strict=True):
                ways = _matrix(matrix) + np.frombuffer(entry, "<i8")[None, :]
                own = np.where(ways.max(axis=1) == 0, ways.argmax(axis=1), -1)
                via.append(own.tolist())
                last.append(next((e for e, (left, _) in enumerate(pairs.states(after)) if left == 0 and own[e] >= 0), -1))
            yield pd.DataFrame({"row": batch["row"], "k": batch["k"], "via": via, "last": last})

    def follow(rows: pd.DataFrame) -> pd.DataFrame:
        # A text has 2 ** 31 bytes at the most, hence 65,536 chunks, with one short list each.
        rows = rows.sort_values("k", ascending=False)
        state, gone, came = int(rows["last"].iloc[0]), [], []
        for via in rows["via"]:
            gone.append(state)
            state = int(via[state]) if state >= 0 else -1
            came.append(state)
        return pd.DataFrame({"row": rows["row"], "k": rows["k"], "gone": gone, "came": came})

    ways = known.select("row", "k", "after", "matrix").join(borders, ["row", "k"]).mapInPandas(
        entered, "row bigint, k bigint, via array<int>, last int"
    )
    exits = staged(ways.groupBy("row").applyInPandas(follow, "row bigint, k bigint, gone int, came int"), "exits")

    def traced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs = Pairs(model)
        for batch in batches:
            found = [
                Piecewise(pairs, r.before, r.after, r.head, r.tail, r.whole).ids(r.came, r.gone, bytes(r.middle)) if r.came >= 0 else None
                for r in batch.itertuples()
            ]
            yield pd.DataFrame({"row": batch["row"], "k": batch["k"], "ids": found})

    return _joined(known.drop("matrix").join(exits, ["row", "k"]).mapInPandas(traced, "row bigint, k bigint, ids binary"))


def decoder(model: Model):
    """A function from ids to the text."""
    parts = [p.replace(SPACE, " ").encode() for p in model.pieces]
    for b, i in enumerate(model.byte_ids):
        parts[i] = bytes([b])
    if not model.byte_ids:
        parts[model.unknown] = " ⁇ ".encode()

    def decode(ids: Iterable[int]) -> str:
        text = b"".join([parts[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if model.prefix and text.startswith(" ") else text

    return decode


def encode(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", size: int = CHUNK, fanout: int = FANOUT,
    by_merges: bool = False,
) -> DataFrame:
    """One row per document: identifier, ``ids`` (array of int), ``round_trip``: they decode to the text.

    ``by_merges``: as the library does for BPE models, instead of the best sum of scores.
    """
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # Characters of the normalised text, which has one more than the text.
    short, long = source.where(F.length("text") < size), source.where(F.length("text") >= size)
    kind = source.schema["id"]
    shape = T.StructType([
        kind, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType())
    ])
    names = [f.name for f in shape]

    def as_lists(blobs: list[bytes]) -> pa.ListArray:
        ends = np.cumsum([0] + [len(b) // 4 for b in blobs]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(blobs), "<i4")))

    def checked(owners: pa.Array, texts: list[str], blobs: list[bytes], back) -> pa.RecordBatch:
        right = [back(np.frombuffer(b, "<i4").tolist()) == t for b, t in zip(blobs, texts, strict=True)]
        return pa.RecordBatch.from_arrays([owners, as_lists(blobs), pa.array(right, pa.bool_())], names)

    def here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, back = (Pairs if by_merges else Lattice)(model), decoder(model)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            if by_merges:
                blobs, right = lattice.encode_checked(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0), as_lists(blobs), pa.array(right, pa.bool_())], names)
            else:
                yield checked(batch.column(0), texts, lattice.encode_all(texts), back)

    held = staged(long.withColumn("row", F.monotonically_increasing_id()), "long-texts")
    rows = held.select(F.col("row").alias("__row"), F.col("text").alias("__text"))
    found = (_pair_long if by_merges else _encode_long)(rows, model, size, fanout)

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back, merges = decoder(model), None
        for batch in batches:
            texts, blobs = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            if None in blobs:
                merges = merges or Merges(model)
                blobs = [merges.encode(t) if b is None else b for b, t in zip(blobs, texts, strict=True)]
            yield checked(batch.column(0), texts, blobs, back)

    long_done = held.join(found, "row", "left").select("id", "text", "ids").mapInArrow(lists, shape)
    return short.mapInArrow(here, shape).union(long_done).select(F.col("id").alias(id_col), "ids", "round_trip")


def decode(encoded: DataFrame, model: Model, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """All rows and columns, and ``to``, the text the ids stand for ('' for no or NULL ids)."""
    names = [c for c in encoded.columns if c != to]
    shape = T.StructType([*[encoded.schema[c] for c in names], T.StructField(to, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = decoder(model)
        for batch in batches:
            place = batch.schema.get_field_index(ids_col)
            texts = [back(ids or ()) for ids in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, to])

    return encoded.select(*names).mapInArrow(run, shape)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encoded_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids, and whether the ids decode to the text."""
    path = path or model_path()
    encoded = encode(docs, load_model(path), by_merges=merges_needed(path))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


def op8_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether they decode to its text."""
    return encoded_documents(table(prepare(spark), sf_dir, "documents"))
