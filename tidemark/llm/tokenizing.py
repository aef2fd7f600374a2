"""SentencePiece BPE encoding by a prefix table, and decoding.

A merge-type (BPE) encoding has a property that makes it computable from left
to right: a sequence of pieces is the encoding of its text exactly when every
piece encodes as itself and every neighbouring pair encodes as that pair.  So
each prefix of a word has one last piece, and it is the only piece that ends
there and is compatible with the last piece of the prefix before it.  An
Aho-Corasick automaton over the pieces gives, for each position, the pieces
that end there; the table keeps the one that passes, and the ids are read off
the table backwards.

A text falls apart where no piece can reach: between two characters that stand
side by side in no piece, so before each word's space mark, around characters
outside the vocabulary (which become byte pieces), and in many words.  Runs of
space marks share one score in the vocabularies this is made for, so their
merges are all of the lowest priority; they are merged directly, by run length.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Callable, Iterator, Sequence
from functools import partial

import ahocorasick
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2

from tidemark.llm.common import from_texts

MARK = "▁"
#: Encodings of words that a worker keeps, twice: when full, those not used since the last time go.
KEPT_WORDS = 3 << 16
#: Words longer than this are encoded without being kept.
KEPT_CHARS = 64
_NORMAL, _BYTE = 1, 6


class PieceEncoder:
    """Encoder and decoder for one SentencePiece BPE model file.

    The model must be BPE with byte fallback, an identity normaliser that keeps
    white space, and a leading space mark (checked).
    """

    def __init__(self, model_file: str):
        proto = sentencepiece_model_pb2.ModelProto()
        processor = sentencepiece.SentencePieceProcessor(model_file=model_file)
        proto.ParseFromString(processor.serialized_model_proto())
        trainer, normal = proto.trainer_spec, proto.normalizer_spec
        if (trainer.model_type != 2 or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix
                or normal.precompiled_charsmap or normal.remove_extra_whitespaces
                or not normal.add_dummy_prefix or not normal.escape_whitespaces
                or any(p.type not in (1, 2, 3, _BYTE) for p in proto.pieces)):
            raise ValueError("not a byte-fallback BPE model with an identity normaliser")
        self.end_id = processor.eos_id()
        self.score = {p.piece: p.score for p in proto.pieces if p.type == _NORMAL}
        self.id = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == _NORMAL}
        self.byte_id = [0] * 256
        self.surface: list[bytes] = []  # UTF-8 of each id; control pieces have none
        for i, p in enumerate(proto.pieces):
            if p.type == _BYTE:
                value = int(p.piece[1:-1], 16)
                self.byte_id[value] = i
                self.surface.append(bytes([value]))
            elif p.type == _NORMAL:
                self.surface.append(p.piece.replace(MARK, " ").encode())
            else:
                self.surface.append(trainer.unk_surface.encode() if p.type == 2 else b"")
        lowest = min((s for p, s in self.score.items() if p.strip(MARK)), default=0.0)
        runs = [p for p in self.score if not p.strip(MARK) and len(p) > 1]
        if any(MARK in p[1:] for p in self.score if p.strip(MARK)) or any(self.score[p] >= lowest for p in runs):
            raise ValueError("space marks inside pieces, or runs of them that outrank words")
        self.piece = [p.piece for p in proto.pieces]
        self.automaton = ahocorasick.Automaton()
        for piece in self.score:  # runs of marks are merged directly; some pieces never come out of merges
            if (piece.strip(MARK) or piece == MARK) and self.merged(piece) == [piece]:
                self.automaton.add_word(piece, (self.id[piece], len(piece)))
        self.automaton.make_automaton()
        self.fits: dict[int, bool] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.spaces: dict[int, tuple[int, ...]] = {}
        self.joined = {p[i:i + 2] for p in self.score for i in range(len(p) - 1)}
        known = {c for p in self.score for c in p}
        apart = "".join(re.escape(c) for c in map(chr, range(32)) if c not in known)
        self.parts = re.compile(f"{MARK}*[^{MARK}{apart}]+|{MARK}+|[{apart}]" if apart else f"{MARK}*[^{MARK}]+|{MARK}+")

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by the merges themselves: best score first, leftmost among equals."""
        piece = list(text)
        after = list(range(1, len(piece) + 1))
        before = list(range(-1, len(piece) - 1))
        heap: list[tuple[float, int, int]] = []

        def offer(left: int) -> None:
            right = after[left]
            if right < len(piece):
                score = self.score.get(both := piece[left] + piece[right])
                if score is not None:
                    heapq.heappush(heap, (-score, left, len(both)))

        for i in range(len(piece)):
            offer(i)
        while heap:
            _, left, size = heapq.heappop(heap)
            right = after[left]
            if not piece[left] or right >= len(piece) or len(piece[left]) + len(piece[right]) != size:
                continue  # one of the two has been merged meanwhile
            piece[left] += piece[right]
            piece[right] = ""
            after[left] = after[right]
            if after[left] < len(piece):
                before[after[left]] = left
            if before[left] >= 0:
                offer(before[left])
            offer(left)
        return [p for p in piece if p]

    def _fit(self, pair: int, left: int, right: int) -> bool:
        """Whether the two pieces side by side encode as themselves."""
        if len(self.fits) > 1 << 20:
            self.fits.clear()
        both = [self.piece[left], self.piece[right]]
        found = self.fits[pair] = self.merged(both[0] + both[1]) == both
        return found

    def _word(self, word: str) -> tuple[int, ...]:
        """Ids of a word: at most one space mark, at its start."""
        last = [-1] * (len(word) + 1)  # the last piece of each prefix; -1: a character outside the vocabulary
        size = [1] * (len(word) + 1)
        fits = self.fits
        for end, (piece, length) in self.automaton.iter(word):
            end += 1
            if last[end] >= 0:
                continue
            start = end - length
            before = last[start]
            if before >= 0:
                pair = before << 32 | piece
                found = fits.get(pair)
                if not (self._fit(pair, before, piece) if found is None else found):
                    continue
            last[end] = piece
            size[end] = length
        at, back = len(word), []
        while at:
            if last[at] >= 0:
                back.append(last[at])
            else:
                back.extend(self.byte_id[b] for b in reversed(word[at - 1].encode()))
            at -= size[at]
        back.reverse()
        return tuple(back)

    def _run(self, n: int) -> tuple[int, ...]:
        """Ids of n space marks."""
        found = self.spaces.get(n)
        if found is None:
            found = tuple(self.id[p] for p in self.merged(MARK * n))
            if len(self.spaces) < 1024:
                self.spaces[n] = found
        return found

    def _bound(self, part: str) -> tuple[int, ...]:
        """Ids of a run of space marks and the characters behind it."""
        marks = len(part) - len(part.lstrip(MARK))
        if marks == len(part):
            return self._run(marks)
        if marks < 2:
            return self._word(part)
        tail = self._word(part[marks - 1:])
        if tail[0] == self.id[MARK]:  # the word did not take the mark: it belongs to the run
            return self._run(marks) + tail[1:]
        return self._run(marks - 1) + tail

    def _kept(self, part: str) -> tuple[int, ...] | None:
        found = self.words.get(part)
        if found is None:
            found = self.older.get(part)
            if found is not None:
                self._keep(part, found)
        return found

    def _keep(self, part: str, ids: tuple[int, ...]) -> None:
        if len(part) <= KEPT_CHARS:
            if len(self.words) >= KEPT_WORDS:
                self.words, self.older = {}, self.words
            self.words[part] = ids

    def _part(self, part: str) -> tuple[int, ...]:
        """Ids of a part: taken apart where no piece reaches across."""
        found = self.older.get(part)
        if found is None:
            joined, at, whole = self.joined, 0, []
            for i in range(1, len(part) + 1):
                if part[i - 1:i + 1] not in joined:  # at the end: one character
                    span = part[at:i]
                    ids = self._kept(span)
                    if ids is None:
                        ids = self._bound(span)
                        self._keep(span, ids)
                    whole.extend(ids)
                    at = i
            found = tuple(whole)
        self._keep(part, found)
        return found

    def encode(self, text: str) -> list[int]:
        """Ids of the whole text, with the end id."""
        ids: list[int] = []
        if text:
            get, extend = self.words.get, ids.extend
            for part in self.parts.findall(MARK + text.replace(" ", MARK)):
                found = get(part)
                if found is None:
                    found = self._part(part)
                    get = self.words.get
                extend(found)
        ids.append(self.end_id)
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of the ids: the leading space that encoding adds is taken off again.

        Bytes that are no UTF-8 each become U+FFFD, as in the library.
        """
        raw = b"".join(map(self.surface.__getitem__, ids))
        if raw[:1] == b" ":
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return "".join(_repaired(raw))


def _repaired(raw: bytes) -> Iterator[str]:
    at = 0
    while at < len(raw):
        try:
            yield raw[at:].decode()
            return
        except UnicodeDecodeError as e:
            yield raw[at:at + e.start].decode()
            yield "�"
            at += e.start + 1


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(model_file: str) -> PieceEncoder:
    """The worker's encoder for a model file."""
    if model_file not in _ENCODERS:
        _ENCODERS[model_file] = PieceEncoder(model_file)
    return _ENCODERS[model_file]


#: What :func:`tokenize` can add, with its type.
OUTPUTS = {"ids": "array<int>", "decoded": "string", "n_tokens": "bigint",
           "ids_sha256": "string", "decoded_sha256": "string"}


def _tokenized(model_file: str, outputs: Sequence[str]) -> Callable[[list[str]], list[list]]:
    pieces = encoder(model_file)
    digits = [str(i) for i in range(len(pieces.surface))].__getitem__
    made = {"ids": lambda ids, text: ids, "decoded": lambda ids, text: text,
            "n_tokens": lambda ids, text: len(ids),
            "ids_sha256": lambda ids, text: hashlib.sha256(" ".join(map(digits, ids)).encode()).hexdigest(),
            "decoded_sha256": lambda ids, text: hashlib.sha256(text.encode()).hexdigest()}

    def score(texts: list[str]) -> list[list]:
        columns: list[list] = [[] for _ in outputs]
        for text in texts:
            ids = pieces.encode(text)
            back = pieces.decode(ids)
            for column, name in zip(columns, outputs, strict=True):
                column.append(made[name](ids, back))
        return columns

    return score


def tokenize(docs: DataFrame, model_file: str, keep: Sequence[str],
             outputs: Sequence[str] = ("ids", "decoded"), text: str = "text") -> DataFrame:
    """The columns ``keep`` and, from the whole text, the ``outputs`` named in :data:`OUTPUTS`.

    ``ids`` ends with the end id; ``decoded`` is the text that the ids stand
    for.  A null text counts as empty (the end id alone).  Rows are independent:
    repeated rows, ties and empty tables need nothing special, and a lost task
    runs again.  Kept columns named like an output are replaced.
    """
    return from_texts(docs, text, keep, {name: OUTPUTS[name] for name in outputs},
                      partial(_tokenized, model_file, tuple(outputs)))
