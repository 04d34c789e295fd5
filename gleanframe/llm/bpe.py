"""Byte-level BPE as a lazily determinised transducer, and its streaming decoder.

A sequence of tokens is the BPE encoding of its bytes exactly when each two neighbours are
(each pair encodes to itself). So the last token of every prefix is unique, and it is found
from the tokens that end there and the last tokens of earlier prefixes. The transducer's
state holds what later bytes can still need of that: the longest suffix that may begin a
token, and the last token at each place where one may begin. The part that the paths to all
these places share is settled and is emitted, so output lags behind by a bounded lookahead.
States and arcs are made when text first needs them and are kept in a table of bounded size.
"""

from __future__ import annotations

import base64
import codecs
import gc
import hashlib
import math
import re
import sys
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bounds of the tables in each Python worker. Remembered texts go by halves: those not met since the last one go.
MAX_ARCS = 400_000
MAX_PIECES = 400_000
MAX_PAIRS = 300_000
#: Bytes read before what is settled is given out.
SETTLE_EVERY = 1024
#: Pieces of up to so many bytes are read side by side, many at once.
SHORT = 64
#: Bytes of text that are coded side by side.
SLICE = 4 << 20
#: Bytes that the decoder takes at a time.
DECODE_EVERY = 1 << 16


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a .tiktoken file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Recent(dict):
    """A table of at most ``limit`` entries that forgets those longest unused, half the table at a time."""

    def __init__(self, limit: int):
        super().__init__()
        self.half, self.older = max(1, limit // 2), {}

    def known(self, keys: Iterable) -> tuple[dict, list]:
        """The entries of ``keys`` that are remembered, and the keys that are not."""
        found, new, get, older = {}, [], self.get, self.older.get
        for key in keys:
            value = get(key)
            if value is None:
                value = older(key)
                if value is None:
                    new.append(key)
                    continue
                self.keep(key, value)
            found[key] = value
        return found, new

    def keep(self, key, value) -> None:
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[key] = value


class Transducer:
    """Encodes byte strings by the ranks of ``vocabulary``."""

    def __init__(self, vocabulary: dict[bytes, int]):
        self.vocabulary = vocabulary
        self.bytes_of = {i: b for b, i in vocabulary.items()}
        self.length = {i: len(b) for b, i in vocabulary.items()}
        self.next: dict[int, int] = {}
        self.depth, self.token, self.fail = [0], [-1], [0]
        for text, number in vocabulary.items():
            node = 0
            for byte in text:
                key = node << 8 | byte
                node = self.next.get(key) or self._new_node(key)
            self.token[node] = number
        self.lengths = np.array([len(self.bytes_of.get(i, b"")) for i in range(max(self.bytes_of, default=0) + 1)], np.int64)
        self._link()
        self.pairs: dict[int, bool] = {}
        self.plans: dict[int, tuple] = {}
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.places: dict[int, list[int]] = {}
        self.reset()

    def _new_node(self, key: int) -> int:
        self.next[key] = node = len(self.depth)
        self.depth.append(self.depth[key >> 8] + 1)
        self.token.append(-1)
        self.fail.append(0)
        return node

    def _link(self) -> None:
        for key, node in sorted(self.next.items(), key=lambda kv: self.depth[kv[1]]):
            parent, byte = key >> 8, key & 255
            if parent:
                self.fail[node] = self._go(self.fail[parent], byte)

    def _go(self, node: int, byte: int) -> int:
        while True:
            found = self.next.get(node << 8 | byte)
            if found is not None or not node:
                return found or 0
            node = self.fail[node]

    def merge(self, text: bytes, least: int = 1) -> list[int]:
        """BPE of a short string by its definition, up to where ``least`` parts are left."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > least:
            ranked = [(self.vocabulary.get(a + b, sys.maxsize), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            rank, i = min(ranked)
            if rank == sys.maxsize:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.vocabulary[p] for p in parts]

    def _parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; (-1, -1) for a byte, None if merges never make it."""
        if token not in self.parts:
            text, parts = self.bytes_of[token], (-1, -1)
            if len(text) > 1:
                last = self.merge(text, 2)
                parts = (last[0], last[1]) if len(last) == 2 else None
            self.parts[token] = parts
        return self.parts[token]

    def _apart(self, x: int, y: int, limit: float) -> bool:
        """Whether ``x`` and ``y`` are both made, side by side, by merges of ranks below ``limit``.

        Goes back in time: of the two edges at the border the one made last is taken apart,
        and before that merge the border's own must not have come. Equal ranks merge from the
        left, so a border goes before the right edge's merge of its rank, not before the left's.
        """
        while True:
            rank = self.vocabulary.get(self.bytes_of[x] + self.bytes_of[y])
            if rank is not None and rank < limit:
                return False
            left, right = self._parts(x), self._parts(y)
            if left is None or right is None:
                return False
            if right[0] >= 0 and (y >= x or left[0] < 0):
                y, limit = right[0], y + 1
            elif left[0] >= 0:
                x, limit = left[1], x
            else:
                return True

    def _follows(self, left: int, right: int) -> bool:
        """Whether ``right`` may stand after ``left`` (-1: at the start)."""
        if len(self.pairs) >= MAX_PAIRS:
            self.pairs.clear()
        out = self._parts(right) is not None if left < 0 else self._apart(left, right, math.inf)
        self.pairs[left << 20 | right] = out
        return out

    def reset(self) -> None:
        #: A state: trie node and the last token at each place where a token may have begun.
        self.states: list[tuple[int, tuple[int, ...]]] = [(0, (-1,))]
        self.numbers: dict[tuple, int] = {(0, -1): 0}
        #: From state and byte to the next state and the last token of the prefix read.
        self.arcs: dict[int, int] = {}

    def _places(self, node: int) -> list[int]:
        """How far back a token may have begun, farthest first."""
        if node not in self.places:
            out, at = [], node
            while at:
                out.append(self.depth[at])
                at = self.fail[at]
            self.places[node] = [*out, 0]
        return self.places[node]

    def _plan(self, node: int, byte: int) -> tuple[int, list[tuple[int, int]], list[int]]:
        """What an arc does whatever the last tokens are.

        The next node, the tokens that may end here with the index of the place each begins
        at, and the indexes of the places that stay open.
        """
        index = {place: i for i, place in enumerate(self._places(node))}
        to = probe = self._go(node, byte)
        ends = []
        while probe:
            if (token := self.token[probe]) >= 0:
                ends.append((token, index[self.depth[probe] - 1]))
            probe = self.fail[probe]
        return to, ends, [index[place - 1] for place in self._places(to)[:-1]]

    def _arc(self, state: int, byte: int) -> int:
        node, lasts = self.states[state]
        if (plan := self.plans.get(node << 8 | byte)) is None:
            if len(self.plans) >= MAX_ARCS:
                self.plans.clear()
            plan = self.plans[node << 8 | byte] = self._plan(node, byte)
        to, ends, stay = plan
        pairs = self.pairs
        for token, at in ends:
            follows = pairs.get(lasts[at] << 20 | token)
            if follows or (follows is None and self._follows(lasts[at], token)):
                break
        key = (to, *[lasts[i] for i in stay], token)
        if (number := self.numbers.get(key)) is None:
            self.numbers[key] = number = len(self.states)
            self.states.append((to, key[1:]))
        self.arcs[state << 8 | byte] = arc = number << 24 | token
        return arc

    def _path(self, tokens: list[int], end: int) -> list[int]:
        """The tokens that lead to place ``end``."""
        out, length = [], self.length
        while end:
            token = tokens[end]
            out.append(token)
            end -= length[token]
        return out[::-1]

    def _settled(self, tokens: list[int], places: set[int]) -> int:
        """The last place that the paths to all ``places`` have in common."""
        while len(places) > 1:
            last = max(places)
            places = places - {last} | {last - self.length[tokens[last]]}
        return places.pop()

    def encode(self, text: bytes) -> list[int]:
        """Tokens of one piece of text; memory beyond the output is bounded by the lookahead."""
        if (token := self.vocabulary.get(text)) is not None:
            return [token]
        if len(self.arcs) >= MAX_ARCS:
            self.reset()
        state, out, tokens, get, make = 0, [], [-1], self.arcs.get, self._arc
        for at in range(0, len(text), SETTLE_EVERY):
            for byte in text[at : at + SETTLE_EVERY]:
                arc = get(state << 8 | byte) or make(state, byte)
                state = arc >> 24
                tokens.append(arc & 0xFFFFFF)
            if at + SETTLE_EVERY < len(text):
                end = len(tokens) - 1
                border = self._settled(tokens, {end - place for place in self._places(self.states[state][0])})
                out += self._path(tokens, border)
                del tokens[1 : border + 1]
        return out + self._path(tokens, len(tokens) - 1)


    def encode_many(self, texts: list[bytes]) -> list[list[int]]:
        """Tokens of each of many pieces; those of up to ``SHORT`` bytes go through the arcs together, byte by byte."""
        out: list[list[int]] = [[] for _ in texts]
        short = []
        for i, text in enumerate(texts):
            if (token := self.vocabulary.get(text)) is not None:
                out[i] = [token]
            elif len(text) > SHORT:
                out[i] = self.encode(text)
            elif text:
                short.append(i)
        short.sort(key=lambda i: -len(texts[i]))
        if not short:
            return out
        if len(self.arcs) >= MAX_ARCS:
            self.reset()
        sizes = np.array([len(texts[i]) for i in short])
        width = int(sizes[0])
        read = np.frombuffer(b"".join(texts[i].ljust(width, b"\0") for i in short), np.uint8).reshape(len(short), width)
        states, tokens = np.zeros(len(short), np.int64), np.zeros((len(short), width), np.int64)
        for at in range(width):
            n = int(np.searchsorted(-sizes, -at, "left"))  # pieces of more than ``at`` bytes come first
            keys, where = np.unique(states[:n] << 8 | read[:n, at], return_inverse=True)
            keys = keys.tolist()
            arcs = [arc or self._arc(key >> 8, key & 255) for key, arc in zip(keys, map(self.arcs.get, keys), strict=True)]
            step = np.array(arcs, np.int64)[where]
            tokens[:n, at], states[:n] = step & 0xFFFFFF, step >> 24
        # back from the ends, a token at a time
        ends, rows, paths = sizes.copy(), np.arange(len(short)), []
        while len(rows):
            last = tokens[rows, ends[rows] - 1]
            paths.append((rows, last))
            ends[rows] -= self.lengths[last]
            rows = rows[ends[rows] > 0]
        for rows, last in reversed(paths):
            for i, token in zip(rows.tolist(), last.tolist(), strict=True):
                out[short[i]].append(token)
        return out


class Pieces(Recent):
    """Packets of stretches of text, remembered up to a bound: decimal ids joined by one space, and their bytes.

    A place before a space or line end that follows a character that is no white space is a
    border of the pattern's matches, whatever stands around it. So a stretch from one such
    place to the next is coded on its own.
    """

    def __init__(self, transducer: Transducer, split: Callable[[str], list[str]]):
        super().__init__(MAX_PIECES)
        self.transducer, self.split = transducer, split
        self.matches = Recent(MAX_PIECES)

    def packets(self, matches: Iterable[str]) -> dict[str, tuple[str, bytes]]:
        """The packet of each match."""
        known, new = self.matches.known(set(matches))
        bytes_of = self.transducer.bytes_of
        for match, ids in zip(new, self.transducer.encode_many([m.encode() for m in new]), strict=True):
            known[match] = packet = (" ".join(map(str, ids)), b"".join([bytes_of[i] for i in ids]))
            if len(match) <= SHORT:
                self.matches.keep(match, packet)
        return known

    def learn(self, stretches: Iterable[str]) -> dict[str, tuple[str, bytes]]:
        """The packet of each stretch."""
        out, new = self.known(stretches)
        # side by side these keep their borders; the others are split one by one
        plain = [s for s in new if s[0] in " \n" and not s[-1].isspace()]
        matches = self.split("".join(plain))
        others = [(s, self.split(s)) for s in new if s[0] not in " \n" or s[-1].isspace()]
        known = self.packets(chain(matches, *[found for _, found in others]))
        at = 0
        for stretch in plain:
            first, size = at, len(matches[at])
            at += 1
            if size == len(stretch):
                packet = known[matches[first]]
            else:
                while size < len(stretch):
                    size += len(matches[at])
                    at += 1
                packet = _joined([known[match] for match in matches[first:at]])
            out[stretch] = packet
            if len(stretch) <= SHORT:
                self.keep(stretch, packet)
        for stretch, found in others:
            out[stretch] = packet = _joined([known[match] for match in found])
            if len(stretch) <= SHORT:
                self.keep(stretch, packet)
        return out

    def of(self, texts: list[str]) -> list[list[tuple[str, bytes]]]:
        """The packets of each text's stretches, in order; of a whole text if white space stands side by side in it."""
        stretches = [[t] if t and _SPACES_MEET(t) else _STRETCHES(t) for t in texts]
        packet_of = self.learn(set(chain.from_iterable(stretches))).__getitem__
        return [list(map(packet_of, found)) for found in stretches]


def _joined(parts: list[tuple[str, bytes]]) -> tuple[str, bytes]:
    return " ".join([ids for ids, _ in parts]), b"".join([data for _, data in parts])


#: White space of any kind, the separators that only some libraries count among it included.
_SPACES_MEET = re.compile(r"[\s\x1c-\x1f\x85\xa0]{2}").search
_STRETCHES = re.compile(r"[ \n]?[^ \n]+|[ \n]").findall


class Decoder:
    """Bytes of tokens through an incremental UTF-8 machine, whose state is the start of an unfinished character.

    ``push`` takes a packet, decimal ids joined by one space, and gives the characters that it
    finishes; ``end`` gives U+FFFD for a character that never ended. Bytes that cannot be UTF-8
    become U+FFFD.
    """

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, packet: str) -> str:
        return self.machine.decode(b"".join([self.bytes_of[int(token)] for token in packet.split()]))

    def end(self) -> str:
        text = self.machine.decode(b"", True)
        self.machine.reset()
        return text

    def text(self, data: bytes) -> str:
        """What the bytes of a whole text's tokens decode to."""
        parts = [self.machine.decode(data[at : at + DECODE_EVERY]) for at in range(0, len(data), DECODE_EVERY)]
        return "".join([*parts, self.end()])


_coders: dict[tuple, tuple[Pieces, Decoder]] = {}


def coder(path: str, pattern: str) -> tuple[Pieces, Decoder]:
    """Encoder and decoder of a vocabulary, made once in each Python worker."""
    key = (path, pattern)
    if key not in _coders:
        import regex

        transducer = Transducer(load_ranks(path))
        _coders[key] = Pieces(transducer, regex.compile(pattern).findall), Decoder(transducer.bytes_of)
    return _coders[key]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows that follow each other, with about ``SLICE`` bytes of text or one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def _coded(docs: DataFrame, path: str, pattern: str, id_col: str, text_col: str, row: Callable, schema: str) -> DataFrame:
    names = ["doc_id", *(field.split()[0] for field in schema.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, decoder = coder(path, pattern)
        gc.disable()  # the large tables hold no cycles, and going through them again and again is slow
        try:
            for batch in batches:
                for some in _slices(batch):
                    rows = []
                    for packets in pieces.of([text or "" for text in some.column(1).to_pylist()]):
                        ids, data = _joined(packets)
                        rows.append(row(ids, decoder.text(data)))
                    yield pa.RecordBatch.from_arrays([some.column(0), *map(pa.array, zip(*rows, strict=True))], names)
        finally:
            gc.enable()

    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, f"doc_id {chosen.schema['doc_id'].dataType.simpleString()}, {schema}")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's token ids by the ranks in ``path`` and the text that the ids decode to.

    ``ids`` is the decimal ids joined by one space. Null and empty texts have no ids and decode
    to the empty text. Rows are coded one by one, so repeats, ties and null ids need no rule;
    other columns are left out, and an empty table gives an empty result.
    """
    return _coded(docs, path, pattern, id_col, text_col, lambda ids, text: (ids, text), "ids string, decoded string")


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Like ``round_trip``, but only the number of ids and the SHA-256 of ids and of decoded bytes."""

    def row(ids: str, text: str) -> tuple[int, str, str]:
        n = ids.count(" ") + 1 if ids else 0
        return n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()

    return _coded(docs, path, pattern, id_col, text_col, row, "n_tokens long, ids_sha256 string, decoded_sha256 string")
