"""SentencePiece encoding and decoding by a weighted finite-state transducer.

Three machines are compiled from a model: the normaliser (white space to its mark, a mark
in front), the pieces (a trie whose states read characters and, where a piece ends, return
to the start and write its id) and the byte fallback (a character that is no piece writes
its UTF-8 bytes). Composed with a text they give a lattice; the encoding is its shortest
path in the tropical semiring, where weights add along a path and the minimum wins.

In a unigram model a piece weighs its negative log probability. A BPE model has only an
order of merges. Its encoding is the one path on which every two neighbours are what the
merges make of their joined text, so the pieces are composed with an acceptor of such
pairs: the state remembers the last piece, and a pair that merges further weighs infinity.
That gives the ids of the reference library exactly.

The lattice falls into parts where no piece can cross (before a white-space mark that
follows text, and around characters that only occur alone). Parts recur, so each worker
remembers the paths of a bounded number of them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.llm.text import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
REMEMBERED_PARTS, REMEMBERED_LENGTH, REMEMBERED_PAIRS = 250_000, 24, 400_000
UNKNOWN_PENALTY = 10.0


class Vocabulary(NamedTuple):
    """What is compiled: ordinary pieces with scores, ids of the 256 bytes (or none), the
    id of the unknown piece, whether the scores are merge priorities, and whether a mark is
    put in front."""

    pieces: tuple[tuple[int, str, float], ...]
    byte_ids: tuple[int, ...]
    unknown: int
    merges: bool
    dummy_prefix: bool


def read_vocabulary(path: str = MODEL) -> Vocabulary:
    """The vocabulary of a model file, read on the driver; workers get it by broadcast.

    Models with a character map (other than identity), white-space removal or marks behind
    words are refused: their normalisers are not compiled here.
    """
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    rules, trained = model.normalizer_spec, model.trainer_spec
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or trained.treat_whitespace_as_suffix:
        raise ValueError(f"the normaliser of {path} is not supported")
    known = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(known.get_piece_size())
    special = {i for i in ids if known.is_byte(i) or known.is_control(i) or known.is_unknown(i) or known.is_unused(i)}
    return Vocabulary(
        tuple((i, known.id_to_piece(i), known.get_score(i)) for i in ids if i not in special),
        tuple(i for i in ids if known.is_byte(i)),
        known.unk_id(),
        trained.model_type == trained.BPE,
        rules.add_dummy_prefix,
    )


class Transducer:
    """The compiled machines of a vocabulary; see the module."""

    START = ""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.ids = {piece: i for i, piece, _ in vocabulary.pieces}
        self.scores = {piece: score for _, piece, score in vocabulary.pieces}
        self.surface = {i: piece.encode() for i, piece, _ in vocabulary.pieces}
        self.surface |= {i: bytes([b]) for b, i in enumerate(vocabulary.byte_ids)}
        # The trie: arcs by character, and the piece that ends in a state.
        self.arcs: list[dict[str, int]] = [{}]
        self.ends: list[str | None] = [None]
        for _, piece, _ in vocabulary.pieces:
            state = 0
            for char in piece:
                if char not in self.arcs[state]:
                    self.arcs[state][char] = len(self.arcs)
                    self.arcs.append({})
                    self.ends.append(None)
                state = self.arcs[state][char]
            self.ends[state] = piece
        self.fallback_weight = UNKNOWN_PENALTY - min(self.scores.values(), default=0.0)
        self.built: dict[str, tuple[list[tuple[str, float]], list[tuple[str, float]], bool]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.parts: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.cut = self._cutter()

    def _cutter(self) -> re.Pattern[str] | None:
        """Finds the parts of a normalised text, or None if pieces may cross any place."""
        several = [p for p in self.ids if len(p) > 1]
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in several):
            return None
        joins = "".join(sorted(set("".join(several)) - {MARK}))
        cls = "".join(map(re.escape, joins))
        return re.compile(f"{MARK}*[{cls}]+|{MARK}+|[^{MARK}{cls}]" if cls else f"{MARK}+|[^{MARK}]", re.S)

    def normalised(self, text: str) -> str:
        if not text:
            return ""
        return (MARK if self.vocabulary.dummy_prefix else "") + text.replace(" ", MARK)

    def spines(self, piece: str) -> tuple[list[tuple[str, float]], list[tuple[str, float]], bool]:
        """How the merges build a piece, seen from its ends: the parts at the left end from
        the first character on, the same at the right end, each with the score at which it
        is there (the lowest of the merges it waits for); and whether it gets whole at all.

        The best-scored neighbours join, leftmost first, until none do.
        """
        known = self.built.get(piece)
        if known is None:
            parts, ready = list(piece), [0.0] * len(piece)
            left, right = [(parts[0], 0.0)], [(parts[-1], 0.0)]
            while True:
                best, at = None, -1
                for i in range(len(parts) - 1):
                    score = self.scores.get(parts[i] + parts[i + 1])
                    if score is not None and (best is None or score > best):
                        best, at = score, i
                if best is None:
                    break
                when = min(best, ready[at], ready[at + 1])
                parts[at : at + 2], ready[at : at + 2] = [parts[at] + parts[at + 1]], [when]
                if at == 0:
                    left.append((parts[0], when))
                if at == len(parts) - 1:
                    right.append((parts[-1], when))
            known = self.built[piece] = (left, right, len(parts) == 1)
        return known

    def follows(self, last: str, piece: str) -> bool:
        """The acceptor of neighbours: whether ``piece`` may come after ``last``.

        The merges of the joined text build both sides at their own scores. They stay
        apart unless, at some moment, the two parts that meet join at a better score than
        the next merge of either.
        """
        pair = (last, piece)
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= REMEMBERED_PAIRS:
                self.pairs.clear()
            known = self.pairs[pair] = self._apart(last, piece)
        return known

    def _apart(self, last: str, piece: str) -> bool:
        never = float("-inf")
        starts, _, whole = self.spines(piece)
        if last == self.START or not whole:
            return whole
        ends, get = self.spines(last)[1], self.scores.get
        i = j = 0
        while True:
            next_left = ends[i + 1][1] if i + 1 < len(ends) else never
            next_right = starts[j + 1][1] if j + 1 < len(starts) else never
            across = get(ends[i][0] + starts[j][0])
            # At equal scores the merge further left comes first.
            if across is not None and across > next_left and across >= next_right:
                return False
            if next_left == never and next_right == never:
                return True
            if next_left >= next_right:
                i += 1
            else:
                j += 1

    def leaving(self, text: str, at: int) -> list[tuple[int, str]]:
        """Arcs of the composed machine from a position, as (end, piece), shorter first.
        Without a piece for the character itself the fallback has an arc."""
        out: list[tuple[int, str]] = []
        arcs, ends, state, end, size = self.arcs, self.ends, 0, at, len(text)
        while end < size:
            state = arcs[state].get(text[end], 0)
            if not state:
                break
            end += 1
            piece = ends[state]
            if piece is not None:
                out.append((end, piece))
        if at < size and (not out or out[0][0] != at + 1):
            out.insert(0, (at + 1, text[at]))
        return out

    def weight(self, piece: str) -> float:
        """Negative log probability of a piece, or the weight of the fallback."""
        score = self.scores.get(piece)
        return self.fallback_weight if score is None else -score

    def shortest(self, text: str) -> list[str]:
        """Pieces on the shortest path through the lattice of a part."""
        return self._only_path(text) if self.vocabulary.merges else self._least_path(text)

    def _least_path(self, text: str) -> list[str]:
        """Shortest path by position; of equal weights the path found first stays."""
        best: list[tuple[float, int, str] | None] = [None] * (len(text) + 1)
        best[0] = (0.0, -1, "")
        for at in range(len(text)):
            for end, piece in self.leaving(text, at):
                cost = best[at][0] + self.weight(piece)
                if best[end] is None or cost < best[end][0]:
                    best[end] = (cost, at, piece)
        at, path = len(text), []
        while at:
            _, at, piece = best[at]
            path.append(piece)
        return path[::-1]

    def _only_path(self, text: str) -> list[str]:
        """The path of finite weight where neighbours are restricted. There is exactly one,
        so the search goes depth first, longest pieces first, and never enters a state
        (position and last piece) twice."""
        pairs, follows, leaving, size = self.pairs, self.follows, self.leaving, len(text)
        path: list[str] = []
        ends, dead = [0], set()
        last, at = self.START, 0
        open_ = [leaving(text, 0)]
        while at < size:
            arcs = open_[-1]
            while arcs:
                end, piece = arcs.pop()
                known = pairs.get((last, piece))
                if known is None:
                    known = follows(last, piece)
                if known and (not dead or (end, piece) not in dead):
                    path.append(piece)
                    ends.append(end)
                    open_.append(leaving(text, end))
                    last, at = piece, end
                    break
            else:
                open_.pop()
                dead.add((ends.pop(), path.pop()))
                last, at = path[-1] if path else self.START, ends[-1]
        return path

    def written(self, piece: str) -> tuple[int, ...]:
        """Output of an arc: the piece's id, or the ids of its bytes."""
        if piece in self.ids:
            return (self.ids[piece],)
        if not self.vocabulary.byte_ids:
            return (self.vocabulary.unknown,)
        return tuple(self.vocabulary.byte_ids[b] for b in piece.encode())

    def part_ids(self, part: str) -> tuple[int, ...]:
        """Ids of a part. Two generations are remembered: when the younger is full it
        becomes the older, so what recurs stays."""
        found = self.parts.get(part)
        if found is None:
            found = self.older.get(part)
            if found is None:
                found = tuple([i for piece in self.shortest(part) for i in self.written(piece)])
            if len(part) <= REMEMBERED_LENGTH:
                if len(self.parts) >= REMEMBERED_PARTS:
                    self.older, self.parts = self.parts, {}
                self.parts[part] = found
        return found

    def encode(self, text: str) -> list[int]:
        whole = self.normalised(text)
        if not whole:
            return []
        out: list[int] = []
        extend = out.extend
        for part in self.cut.findall(whole) if self.cut else [whole]:
            extend(self.parts.get(part) or self.part_ids(part))
        return out

    def decode(self, ids: list[int]) -> str:
        """The inverse machine: bytes of the pieces, marks to spaces, the front mark gone.
        Ids without a surface (control, unknown) write nothing; broken UTF-8 is replaced."""
        surface = self.surface
        text = b"".join([surface.get(i, b"") for i in ids]).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.vocabulary.dummy_prefix and text.startswith(" ") else text


_compiled: dict[int, Transducer] = {}


def compiled(vocabulary: Vocabulary) -> Transducer:
    """One transducer a worker, so that what it remembers serves its next tasks as well."""
    key = hash(vocabulary)
    if key not in _compiled:
        _compiled.clear()
        _compiled[key] = Transducer(vocabulary)
    return _compiled[key]


def encode_texts(docs: DataFrame, vocabulary: Vocabulary, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id and ids, array<int>. A null text has no ids."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(shared.value)
        for batch in slices(batches, 128):
            ids = [machine.encode(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col(id).cast("bigint"), F.col(text).cast("string")).mapInArrow(
        encoded, "doc_id bigint, ids array<int>"
    )


def decode_ids(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids); null ids give an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(shared.value)
        for batch in slices(batches, 128):
            texts = [machine.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decoded, "doc_id bigint, text string")


SCHEMA = (
    "doc_id bigint, n_chars bigint, n_pieces bigint, n_byte_pieces bigint, ids_sha256 string, "
    "decoded_sha256 string, round_trip boolean, ids array<int>"
)


def encode_and_decode(
    docs: DataFrame, vocabulary: Vocabulary, *, id: str = "doc_id", text: str = "text", with_ids: bool = True
) -> DataFrame:
    """One row per row of ``docs``: the digests of its ids (as little-endian 32-bit numbers)
    and of the text decoded from them, whether that is the text again, and, if asked for,
    the ids.

    Only a text that holds the white-space mark U+2581 itself does not come back: it reads
    as a space, as in the reference library. Null and empty texts have no ids. Rows are
    encoded alone, whole; repeated rows and null ids give a row each; other columns are not
    read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(shared.value)
        bytes_ = np.array(shared.value.byte_ids, np.int32)
        for batch in slices(batches, 128):
            rows = []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                value = value or ""
                ids = machine.encode(value)
                back = machine.decode(ids)
                numbers = np.array(ids, "<i4")
                rows.append(
                    (key, len(value), len(ids), int(np.isin(numbers, bytes_).sum()),
                     hashlib.sha256(numbers.tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), back == value,
                     ids if with_ids else None)
                )
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.bool_(), pa.list_(pa.int32())]
            columns = [list(c) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=[p.split()[0] for p in SCHEMA.split(", ")],
            )

    out = docs.select(F.col(id).cast("bigint"), F.col(text).cast("string")).mapInArrow(done, SCHEMA)
    return out if with_ids else out.drop("ids")
