"""Phrase collocations as in Apriori: only phrases whose parts are frequent can be.

1. Texts are cut once into blocks of numbered words, which are written; all passes read those.
2. Words are counted.
3. For each number of words from two up a pass counts, by a 64-bit hash, the windows whose
   shorter windows are all frequent by their hashes.
4. Windows with a frequent hash are the candidates; one pass collects them. Of all blocks with a
   hash only its owner, the one with the least checksum, sends the words, so a candidate
   does not leave every task.
5. The candidates become double-array tries in as many groups as their number needs. One pass
   deals the windows with a frequent hash to the groups, each different one of a block once with
   its number. Then one group after the other has its tries broadcast, and its own windows alone
   advance their states together, level by level; accepting states are counted. So all groups
   together read every window once. Only these exact counts, summed over the tasks, decide. A
   hash that counts for more than the candidates found for it stands for several phrases; all
   blocks are asked for those once more.

Between passes Bloom filters of a bounded size tell what may be frequent. They let too much
through, never too little, so a filter that runs full costs time and loses nothing. A trie
holds a bounded number of candidates. Words are cut, numbered and looked up by Arrow and numpy
for a whole block at once; Python sees each different word of a block once. What is counted is
shuffled as arrays, a row for each block and part of the hashes, and merged by numpy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.functions.keys import aside, lookup
from tallywork.functions.running import running_total
from tallywork.llm.double_array import DoubleArray
from tallywork.llm.text import LOWER, LOWER_BYTES, UPPER, small_pieces, tasks_for
from tallywork.session import written

# Between pieces and between texts; bytes that UTF-8 does not have.
BREAK, END = b"\xff", b"\xfe"
CUTS = b".,;:!?\n\x0b\x0c\r"
FOLD = bytes(BREAK[0] if c in CUTS else LOWER_BYTES[c] for c in range(256))
BATCH_BYTES = 8 << 20
# Words of text for each part in which counts are merged.
PART_TOKENS = 1 << 22


class Settings(NamedTuple):
    """The defaults are those of the registered query.

    ``held`` rows at most wait in a task before they are combined (a block has twice as many bytes
    of text, or BATCH_BYTES if that is less), ``trie_phrases`` and ``trie_bytes`` bound one trie, ``filter_bits`` one Bloom filter. ``hash_bits`` of the windows' hashes are
    used; fewer only mean that more phrases share one.
    """

    max_words: int = 3
    min_count: int = 10
    scale: int = 1_000_000
    covered_percent: int = 50
    top: int = 2000
    held: int = 1 << 22
    trie_phrases: int = 1 << 20
    trie_bytes: int = 1 << 25
    filter_bits: int = 1 << 26
    hash_bits: int = 64


class Block(NamedTuple):
    """Texts of one language: token i is word codes[i], BREAK and END included; ``hashes`` has the
    words' hashes, 0 for those two. ``owner`` is a checksum of the texts."""

    lang: str
    owner: int
    hashes: np.ndarray
    codes: np.ndarray
    words: list[bytes]


def _dictionary(raw: bytes) -> tuple[pa.Array, np.ndarray]:
    """The different tokens of folded text, and for each token which it is."""
    data = np.frombuffer(raw, np.uint8)
    apart = data >= END[0]
    kept = (data != 32) & (data != 9)
    starts = kept.copy()
    starts[1:] &= apart[1:] | apart[:-1] | ~kept[:-1]
    packed = data[kept]
    offsets = np.append(np.flatnonzero(starts[kept]), len(packed)).astype(np.int32)
    flat = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
    encoded = flat.dictionary_encode()
    return encoded.dictionary, encoded.indices.to_numpy()


def _encoded(raw: bytes) -> tuple[list[bytes], np.ndarray]:
    words, codes = _dictionary(raw)
    return _listed(words), codes


def _listed(words: pa.Array) -> list[bytes]:
    return words.to_numpy(zero_copy_only=False).tolist()


def _pack(values: bytes | np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values)


def _unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _joined(words: pa.Array, bounds: np.ndarray) -> pa.Array:
    """The words between each two bounds in one binary, a space between them."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), words), b" ")


def _arrays(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The numbers between each two bounds as one binary."""
    offsets = pa.py_buffer((bounds * values.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(values))])


def _rows(**columns: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


_BLOCKS = "lang string, owner bigint, tokens bigint, words binary, hashes binary, counts binary, codes binary"
# Rows are large: without these, a hundred of them would be gathered before a look at their size.
_LARGE_ROWS = {"parquet.block.size": str(32 << 20), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}


def encoded(docs: DataFrame, settings: Settings) -> DataFrame:
    """The texts in blocks of one language: different words, their hashes and counts, and the
    tokens by number; ``tokens`` is the number of words in the block. Written."""
    most = min(BATCH_BYTES, 2 * settings.held)

    def block(lang: str, texts: list[bytes]) -> pa.RecordBatch:
        raw = b"".join(t.translate(FOLD) + END for t in texts)
        words, codes = _dictionary(raw)
        seed, names = lang_seed(lang), _listed(words)
        hashes = np.fromiter((word_hash(seed, w) for w in names), np.uint64, len(names))
        counts = np.bincount(codes, minlength=len(names))
        for mark in (BREAK, END):
            if mark in names:
                hashes[names.index(mark)] = counts[names.index(mark)] = 0
        return _rows(
            lang=pa.array([lang], pa.string()),
            owner=[xxhash.xxh32_intdigest(raw)],
            tokens=[int(counts.sum())],
            words=[_pack(b" ".join(names))],
            hashes=[hashes.tobytes()],
            counts=[_pack(counts.astype(np.int64))],
            codes=[_pack(codes.astype(np.uint32))],
        )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        for batch in small_pieces(batches, 1, most, 1 << 14):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                held.setdefault(lang, []).append(text)
                sizes[lang] = sizes.get(lang, 0) + len(text) + 1
                if sizes[lang] >= most:
                    sizes.pop(lang)
                    yield block(lang, held.pop(lang))
            while sum(sizes.values()) > 2 * most:
                largest = max(sizes, key=sizes.get)
                sizes.pop(largest)
                yield block(largest, held.pop(largest))
        while held:
            yield block(*held.popitem())

    return written(docs.mapInArrow(encode, _BLOCKS), **_LARGE_ROWS)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """The blocks of :func:`encoded`; words only where that column is read."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            words = _unpack(row["words"]).split(b" ") if "words" in row else []
            yield Block(row["lang"], row["owner"], np.frombuffer(row["hashes"], np.uint64), np.frombuffer(_unpack(row["codes"]), np.uint32), words)
            # Workers are kept for other tasks; so would be what Arrow has freed.
            pa.default_memory_pool().release_unused()


def parts_for(texts: DataFrame) -> int:
    """In how many parts the counts of :func:`encoded` texts are merged, by the number of words."""
    tokens = texts.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).first()["n"]
    return tasks_for(texts.sparkSession, tokens, PART_TOKENS)


# Counting words ------------------------------------------------------------------------------


def count_words(texts: DataFrame, parts: int, settings: Settings) -> DataFrame:
    """(lang, word, f): frequent words; a null word has the number of all words of its language."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                counts, hashes = np.frombuffer(_unpack(row["counts"]), np.int64), np.frombuffer(row["hashes"], np.uint64)
                part = ((hashes >> np.uint64(1)) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                order = order[counts[order] > 0]
                bounds = np.searchsorted(part[order], np.arange(parts + 1))
                words = pa.array(_unpack(row["words"]).split(b" "), pa.binary()).take(pa.array(order))
                full = np.flatnonzero(np.diff(bounds))
                yield _rows(
                    part=pa.array(full, pa.int32()),
                    lang=pa.array([row["lang"]] * len(full), pa.string()),
                    words=_joined(words, bounds).take(pa.array(full)),
                    counts=_arrays(counts[order], bounds).take(pa.array(full)),
                )

    def add(key: tuple, table: pa.Table) -> pa.Table:
        out = []
        for lang in table["lang"].unique().to_pylist():
            mine = table.filter(pc.equal(table["lang"], lang))
            words = pa.array([w for joined in mine["words"].to_pylist() for w in joined.split(b" ")], pa.binary())
            n = np.concatenate([np.frombuffer(c, np.int64) for c in mine["counts"].to_pylist()])
            found = pa.table({"word": words, "n": n}).group_by("word").aggregate([("n", "sum")])
            found = found.filter(pc.greater_equal(found["n_sum"], settings.min_count))
            names = found["word"].cast(pa.string())
            out.append(pa.table({"lang": pa.array([lang] * len(names), pa.string()), "word": names, "f": found["n_sum"]}))
        return pa.concat_tables(out)

    dealt = texts.select("lang", "words", "hashes", "counts").mapInArrow(deal, "part int, lang string, words binary, counts binary")
    counted = dealt.groupBy("part").applyInArrow(add, "lang string, word string, f bigint")
    totals = texts.groupBy("lang").agg(F.sum("tokens").alias("f")).select("lang", F.lit(None).cast("string").alias("word"), "f")
    return written(counted.unionByName(totals))


# Hashes and filters --------------------------------------------------------------------------

STEP, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def word_hash(lang_seed: int, word: bytes) -> int:
    """Never 0, which stands for a word that cannot be part of a frequent phrase."""
    return xxhash.xxh64_intdigest(word, lang_seed) or 1


def lang_seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode())


def combined(columns: list[np.ndarray], bits: int = 64) -> np.ndarray:
    """A hash, never 0, of the hashes in equal places of the columns; 0 where one of them is."""
    out, whole = columns[0].copy(), columns[0] != 0
    for following in columns[1:]:
        whole &= following != 0
        out = (out * STEP + following) * SPREAD
        out ^= out >> np.uint64(31)
    out >>= np.uint64(64 - bits)
    out[out == 0] = 1
    out[~whole] = 0
    return out


def windows(hashes: np.ndarray, words: int, bits: int = 64) -> np.ndarray:
    """A hash for every window of ``words`` words; 0 where a word's hash is 0."""
    n = max(len(hashes) - words + 1, 0)
    return combined([hashes[i : i + n] for i in range(words)], bits)


def owned(hashes: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """The hash of a window together with the text it lies in."""
    return hashes ^ (owners << np.uint64(32)) ^ owners


class Filter:
    """A Bloom filter with two positions for a hash."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.mask = words, np.uint64(bits - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each hash may be in."""
        found = np.ones(len(hashes), bool)
        for shift in (0, 32):
            at = (hashes >> np.uint64(shift)) & self.mask
            found &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return found


class Both(NamedTuple):
    """Two filters of the same hashes, the second by other bits of them. What one that is half full
    lets through by chance in a fourth of all cases, both do in a sixteenth."""

    first: Filter
    second: Filter

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = self.first.has(hashes)
        at = np.flatnonzero(found)
        found[at] = self.second.has((hashes[at] >> np.uint64(16)) | (hashes[at] << np.uint64(48)))
        return found


def make_both(hashes: DataFrame, settings: Settings) -> Both:
    """Both filters of a written column ``h``."""
    turned = F.shiftrightunsigned("h", 16).bitwiseOR(F.shiftleft("h", 48))
    return Both(make_filter(hashes, settings), make_filter(hashes.select(turned.alias("h")), settings))


CHUNK_BITS = 1 << 17


def make_filter(hashes: DataFrame, settings: Settings) -> Filter:
    """The filter of a written column ``h``: about 16 bits for each, ``filter_bits`` at most.

    Tasks set the bits of a chunk each; the driver receives the filter, at most filter_bits / 8 bytes.
    """
    hashes = hashes.select("h")
    bits, count = 1 << 16, hashes.count()
    while bits < min(16 * count, settings.filter_bits):
        bits *= 2

    def position(shift: int) -> Column:
        return F.shiftrightunsigned("h", shift).bitwiseAND(F.lit(bits - 1))

    chunk = min(bits, CHUNK_BITS)

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        flags = np.zeros(chunk, np.uint8)
        flags[table["p"].to_numpy() % chunk] = 1
        raw = np.packbits(flags, bitorder="little").tobytes()
        return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([raw], pa.binary())], names=["chunk", "raw"])

    positions = hashes.select(F.explode(F.array(position(0), position(32))).alias("p"))
    split = positions.withColumn("chunk", F.floor(F.col("p") / F.lit(chunk)).cast("bigint"))
    words = np.zeros(bits // 64, np.uint64)
    for row in split.groupBy("chunk").applyInArrow(pack, "chunk bigint, raw binary").collect():
        at = row["chunk"] * chunk // 64
        words[at : at + chunk // 64] = np.frombuffer(row["raw"], np.uint64)
    return Filter(words, bits)


def phrase_hashes(phrases: DataFrame, bits: int = 64) -> DataFrame:
    """Rows (lang, phrase, ...) with ``h``, the hash :func:`windows` gives the phrase; written.
    All phrases have the same number of words."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds: dict[str, int] = {}
        for batch in batches:
            rows = []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seed = seeds.get(lang)
                if seed is None:
                    seed = seeds[lang] = lang_seed(lang)
                rows.append([word_hash(seed, w) for w in phrase.encode().split(b" ")])
            columns = np.array(rows, np.uint64).reshape(batch.num_rows, -1).T
            found = combined(list(columns), bits) if len(columns) else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))], names=[*batch.schema.names, "h"])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in phrases.schema)
    return written(phrases.mapInArrow(hashed, f"{kept}, h bigint"))


# Candidates ----------------------------------------------------------------------------------


class Levels(NamedTuple):
    """What tells the windows that may be frequent: a filter of single words and, for numbers of
    words from two up, of the hashes of windows."""

    frequent: Filter
    shorter: dict[int, Filter]
    bits: int

    def walk(self, batches: Iterator[pa.RecordBatch], levels: list[int]) -> Iterator[tuple[Block, list[np.ndarray]]]:
        """Blocks and, for each of ``levels``, the hashes of the windows of so many words that
        start at each token; 0 where a window cannot be frequent."""
        for block in blocks(batches):
            hashes = np.where(self.frequent.has(block.hashes), block.hashes, np.uint64(0))[block.codes]
            found = []
            for k in levels:
                found.append(windows(hashes, k, self.bits))
                if k - 1 in self.shorter:
                    parts = windows(hashes, k - 1, self.bits)
                    safe = np.zeros(len(parts), bool)
                    at = np.flatnonzero(parts)
                    safe[at] = self.shorter[k - 1].has(parts[at])
                    found[-1][~(safe[:-1] & safe[1:])[: len(found[-1])]] = 0
            yield block, found


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of equal values begin, and how long they are."""
    starts = np.flatnonzero(np.concatenate([[len(values) > 0], values[1:] != values[:-1]])[: len(values)])
    return starts, np.diff(np.append(starts, len(values)))


def frequent_hashes(texts: DataFrame, levels: Levels, words: int, parts: int, settings: Settings) -> DataFrame:
    """(h, n, key): hashes of windows of ``words`` words that count often enough together with all
    that share the hash, how often, and the key of the hash with its owner; written."""
    shared = texts.sparkSession.sparkContext.broadcast(levels)
    # A part is a range of hashes, so sorted ones are cut without another order.
    edges = np.array([(part << settings.hash_bits) // parts for part in range(1, parts)], np.uint64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, (found,) in shared.value.walk(batches, [words]):
            hashes = np.sort(found[found != 0])
            starts, counts = _runs(hashes)
            hashes = hashes[starts]
            bounds = np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]])
            full = np.flatnonzero(np.diff(bounds))
            yield _rows(
                part=pa.array(full, pa.int32()),
                owner=pa.array(np.full(len(full), block.owner)),
                hashes=_arrays(hashes, bounds).take(pa.array(full)),
                counts=_arrays(counts.astype(np.uint32), bounds).take(pa.array(full)),
            )

    dealt = texts.select("lang", "owner", "hashes", "codes").mapInArrow(count, "part int, owner bigint, hashes binary, counts binary")
    counted = dealt.groupBy("part").applyInArrow(_merger(settings.min_count), "h bigint, n bigint, owner bigint")
    key = F.col("h").bitwiseXOR(F.shiftleft("owner", 32)).bitwiseXOR(F.col("owner"))
    often = written(counted.select("h", "n", key.alias("key")))
    shared.destroy()
    return often


def _merger(min_count: int) -> Callable[[tuple, pa.Table], pa.Table]:
    """The hashes of a part that count ``min_count`` times, and the least of their owners."""

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        arrays = [np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist()]
        hashes = np.concatenate(arrays)
        counts = np.concatenate([np.frombuffer(x, np.uint32) for x in table["counts"].to_pylist()]).astype(np.int64)
        owners = np.repeat(table["owner"].to_numpy(), [len(x) for x in arrays])
        order = np.argsort(hashes)
        hashes, counts, owners = hashes[order], counts[order], owners[order]
        starts, _ = _runs(hashes)
        n = np.add.reduceat(counts, starts)
        often = n >= min_count
        least = np.minimum.reduceat(owners, starts)
        return pa.table({"h": hashes[starts][often].view(np.int64), "n": n[often], "owner": least[often]})

    return merge


def _different(codes: np.ndarray, at: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """One of the positions ``at`` for every different sequence of ``words`` codes there, and how
    many there are of it; exact."""
    radix = int(codes.max(initial=0)) + 1
    names, high = codes[at].astype(np.int64), radix
    for i in range(1, words):
        if high * radix >= 1 << 63:
            different, names = np.unique(names, return_inverse=True)
            high = len(different)
        names, high = names * radix + codes[at + i], high * radix
    order = np.argsort(names)
    starts, counts = _runs(names[order])
    return at[order[starts]], counts


def candidates(texts: DataFrame, levels: Levels, likely: dict[int, Filter | Both], settings: Settings, *, by_owner: bool = True) -> DataFrame:
    """(words, lang, phrase, h, id): for each number of words in ``likely`` the windows whose hash,
    together with its owner or alone, passes the filter, once; written, so that ids stay."""
    shared, numbers = texts.sparkSession.sparkContext.broadcast((levels, likely)), sorted(likely)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, likely = shared.value
        for block, windows_ in levels.walk(batches, numbers):
            for k, found in zip(numbers, windows_, strict=True):
                at = np.flatnonzero(found)
                at = at[likely[k].has(owned(found[at], np.uint64(block.owner)) if by_owner else found[at])]
                if not len(at):
                    continue
                first, _ = _different(block.codes, at, k)
                rows = zip(*(block.codes[first + i].tolist() for i in range(k)), strict=True)
                yield _rows(
                    words=pa.array(np.full(len(first), k, np.int32)),
                    lang=pa.array([block.lang] * len(first), pa.string()),
                    phrase=pa.array([b" ".join([block.words[c] for c in row]).decode() for row in rows], pa.string()),
                    h=pa.array(found[first].view(np.int64)),
                )

    found = texts.select("lang", "owner", "hashes", "codes", "words").mapInArrow(collect, "words int, lang string, phrase string, h bigint").distinct()
    collected = written(found.withColumn("id", F.monotonically_increasing_id()))
    shared.destroy()
    return collected


# Counting candidates -------------------------------------------------------------------------


class Trie(NamedTuple):
    """A double-array trie with the numbers of the words and languages in it."""

    words: int
    array: DoubleArray
    symbols: dict[bytes, int]

    @classmethod
    def of(cls, langs: pa.Array | list[str], phrases: pa.Array | list[str], ids: np.ndarray) -> Trie:
        of_lang, phrases = (pa.array(x, pa.string()).cast(pa.binary()) for x in (langs, phrases))
        of_lang = of_lang.dictionary_encode()
        words = pc.list_flatten(pc.split_pattern(phrases, b" ")).dictionary_encode()
        names = [*(b"\n" + lang for lang in of_lang.dictionary.to_pylist()), *_listed(words.dictionary)]
        numbers = words.indices.to_numpy().reshape(len(phrases), -1) + (len(of_lang.dictionary) + 1)
        rows = np.column_stack([of_lang.indices.to_numpy() + 1, numbers])
        del words, numbers, of_lang, phrases
        # What Arrow keeps of freed memory would stand beside the arrays of the trie.
        pa.default_memory_pool().release_unused()
        return cls(rows.shape[1] - 1, DoubleArray.of(rows, ids, len(names)), {w: i for i, w in enumerate(names, 1)})

    def start(self, lang: str) -> int | None:
        symbol = self.symbols.get(b"\n" + lang.encode())
        if symbol is None:
            return None
        states, _ = self.array.step(np.zeros(1, np.int32), np.zeros(1, np.int64), np.array([symbol]))
        return int(states[0])


_TRIE = "words int, base binary, check binary, accepting binary, ids binary, width int, symbols binary"


def _built(key: tuple, table: pa.Table) -> pa.Table:
    """A group of candidates of one length as one row: the arrays of its trie, compressed."""
    trie = Trie.of(table["lang"].combine_chunks(), table["phrase"].combine_chunks(), table["id"].to_numpy())
    a = trie.array
    # Symbols count from 1 in order, so the names alone will do; a space is in none of them.
    row = [key[0].as_py(), trie.words, *(_pack(x.tobytes()) for x in (a.base, a.check, a.accepting, a.ids)), a.width, _pack(b" ".join(trie.symbols))]
    types = [pa.int32() if isinstance(v, int) else pa.binary() for v in row]
    names = ["g", *(p.split()[0] for p in _TRIE.split(", "))]
    return pa.table([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=names)


def _read(row: dict) -> Trie:
    arrays = [np.frombuffer(_unpack(row[c]), np.int64 if c == "ids" else np.int32) for c in ("base", "check", "accepting", "ids")]
    symbols = {w: i for i, w in enumerate(_unpack(row["symbols"]).split(b" "), 1)}
    return Trie(row["words"], DoubleArray(*arrays, row["width"]), symbols)


class Tally:
    """The accepting states of one trie, counted."""

    def __init__(self, trie: Trie, most_held: int):
        self.trie, self.most = trie, most_held
        self.total, self.held, self.size = np.zeros(len(trie.array.ids), np.int64), [], 0
        self.starts: dict[str, int | None] = {}

    def add(self, lang: str, words: list[bytes], windows: np.ndarray, counts: np.ndarray) -> None:
        """``windows`` are rows of places in ``words``; there are ``counts`` of each."""
        if lang not in self.starts:
            self.starts[lang] = self.trie.start(lang)
        start, known = self.starts[lang], self.trie.symbols
        if start is None:
            return
        numbers = np.array([known.get(w, 0) for w in words], np.int64)
        states, rows = self.trie.array.reached(start, numbers[windows])
        self.held.append((states, counts[rows]))
        self.size += len(states)
        if self.size > self.most:
            self.settle()

    def settle(self) -> None:
        states = np.concatenate([np.zeros(0, np.int32), *(s for s, _ in self.held)])
        counts = np.concatenate([np.zeros(0, np.int64), *(n for _, n in self.held)])
        np.add.at(self.total, np.searchsorted(self.trie.array.accepting, states), counts)
        self.held, self.size = [], 0

    def rows(self) -> pa.RecordBatch:
        self.settle()
        met = np.flatnonzero(self.total)
        return _rows(id=pa.array(self.trie.array.ids[met]), n=pa.array(self.total[met]))


_WINDOWS = "slot int, words int, lang string, names binary, windows binary, counts binary, g int"


def deal_windows(texts: DataFrame, levels: Levels, likely: dict[int, Filter], groups: dict[int, int], parts: int) -> DataFrame:
    """The windows whose hash passes the filter, dealt by hash to the ``groups`` of their number of
    words, and within one to slots. A row has those of a block: the words they are made of, the
    windows as places among those, and how often each occurs. Written, a folder for each group."""
    shared, numbers = texts.sparkSession.sparkContext.broadcast((levels, likely)), sorted(groups)
    slots = -(-parts // max(groups.values()))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, likely = shared.value
        for block, windows_ in levels.walk(batches, numbers):
            words, number = pa.array(block.words, pa.binary()), np.zeros(len(block.words), np.uint32)
            for k, found in zip(numbers, windows_, strict=True):
                at = np.flatnonzero(found)
                at = at[likely[k].has(found[at])]
                if not len(at):
                    continue
                first, counts = _different(block.codes, at, k)
                group, rest = _group(found[first], groups[k])
                part = (group * slots + rest % slots).astype(np.int64)
                order = np.argsort(part, kind="stable")
                codes = block.codes[first[order][:, None] + np.arange(k)]
                starts, lengths = _runs(part[order])
                names, used = [], np.zeros(len(number), bool)
                for start, length in zip(starts.tolist(), lengths.tolist(), strict=True):
                    some = codes[start : start + length]
                    used[some] = True
                    mine = np.flatnonzero(used)
                    used[mine] = False
                    number[mine] = np.arange(len(mine))
                    codes[start : start + length] = number[some]
                    names.append(mine)
                bounds = np.append(starts, len(order))
                here = part[order][starts]
                yield _rows(
                    slot=pa.array(here % slots, pa.int32()),
                    words=pa.array(np.full(len(here), k, np.int32)),
                    lang=pa.array([block.lang] * len(here), pa.string()),
                    names=_joined(words.take(pa.array(np.concatenate(names))), np.cumsum([0, *map(len, names)])),
                    windows=_arrays(codes.reshape(-1), bounds * k),
                    counts=_arrays(counts[order].astype(np.uint32), bounds),
                    g=pa.array(here // slots, pa.int32()),
                )

    dealt = texts.select("lang", "owner", "hashes", "codes", "words").mapInArrow(deal, _WINDOWS).repartition(parts, "g", "slot")
    kept = written(dealt, by="g", **_LARGE_ROWS)
    shared.destroy()
    return kept


def _group(hashes: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """The group of each hash, as :func:`count_candidates` has it, and what is left of the hash."""
    rest, group = np.divmod(hashes >> np.uint64(1), np.uint64(groups))
    return group, rest


def count_candidates(texts: DataFrame, found: DataFrame, levels: Levels, likely: dict[int, Filter], parts: int, settings: Settings) -> DataFrame:
    """(words, lang, phrase, h, f): the exact number of occurrences of each candidate that has any
    and whose hash passes the filter; written.

    Each number of words has as many tries as its candidates need. The windows are dealt to them
    by hash; a trie of each number of words is broadcast to the windows of its group only.
    """
    size = found.groupBy("words").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("phrase")).alias("b")).collect()
    groups = {r["words"]: max(-(-r["n"] // settings.trie_phrases), -(-r["b"] // settings.trie_bytes)) for r in size}
    if not groups:
        return found.select("words", "lang", "phrase", "h", F.lit(0).cast("bigint").alias("f"))
    of_words = F.create_map(*[F.lit(x).cast("bigint") for pair in groups.items() for x in pair])[F.col("words").cast("bigint")]
    group = (F.shiftrightunsigned("h", 1) % of_words).cast("int")
    tries = written(found.select(group.alias("g"), "words", "lang", "phrase", "id").groupBy("g", "words").applyInArrow(_built, f"g int, {_TRIE}"))
    dealt = deal_windows(texts, levels, likely, groups, parts)
    spark, counts = texts.sparkSession, None
    for g in range(max(groups.values())):
        # One trie of bounded size for each number of words.
        shared = spark.sparkContext.broadcast([r.asDict() for r in tries.filter(F.col("g") == g).collect()])
        mine = dealt.filter(F.col("g") == g).select("words", "lang", "names", "windows", "counts")
        part = written(mine.mapInArrow(_counter(shared, settings), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("f")))
        shared.destroy()
        counts = part if counts is None else counts.unionByName(part)
    return written(found.join(counts, "id").select("words", "lang", "phrase", "h", "f"))


def _counter(shared, settings: Settings):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies: dict[int, Tally] | None = None
        for batch in batches:
            if tallies is None:
                tallies = {trie.words: Tally(trie, settings.held) for trie in map(_read, shared.value)}
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["words"] in tallies:
                    windows = np.frombuffer(row["windows"], np.uint32).reshape(-1, row["words"])
                    counts = np.frombuffer(row["counts"], np.uint32).astype(np.int64)
                    tallies[row["words"]].add(row["lang"], row["names"].split(b" "), windows, counts)
        for tally in (tallies or {}).values():
            yield tally.rows()

    return count


def missed(counted: DataFrame, likely: DataFrame, words: int) -> DataFrame:
    """(h): frequent hashes whose count the candidates with that hash do not make up, because
    a phrase that shares it lies in none of its owner's texts; written."""
    made = counted.filter(F.col("words") == words).groupBy("h").agg(F.sum("f").alias("f"))
    return written(lookup(likely.select("h", "n"), *aside(made, ["h"])).filter(~F.col("f").eqNullSafe(F.col("n"))).select("h"))


def frequent_windows(texts: DataFrame, frequent: Filter, parts: int, settings: Settings) -> DataFrame:
    """(words, lang, phrase, f): the phrases of two and more words that occur ``min_count`` times."""
    levels, likely = Levels(frequent, {}, settings.hash_bits), {}
    for k in range(2, settings.max_words + 1):
        likely[k] = frequent_hashes(texts, levels, k, parts, settings)
        levels.shorter[k] = make_filter(likely[k], settings)
    owners = {k: make_both(df.select(F.col("key").alias("h")), settings) for k, df in likely.items()}
    found = candidates(texts, levels, owners, settings)
    counted = count_candidates(texts, found, levels, levels.shorter, parts, settings)
    rest = {k: missed(counted, df, k) for k, df in likely.items()}
    again = {k: make_filter(df, settings) for k, df in rest.items() if not df.isEmpty()}
    if again:
        more = candidates(texts, levels, again, settings, by_owner=False)
        new = written(lookup(more, *aside(found.select("lang", "phrase"), ["lang", "phrase"]), "left_anti"))
        counted = counted.unionByName(count_candidates(texts, new, levels, again, parts, settings))
    return counted.filter(F.col("f") >= settings.min_count).select("words", "lang", "phrase", "f")


def frequent_phrases(docs: DataFrame, *, lang: str = "lang", text: str = "text", settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """The frequent words with the totals (:func:`count_words`), and the frequent phrases of two and
    more words (words, lang, phrase, f)."""
    folded = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    texts = encoded(folded, settings)
    parts = parts_for(texts)
    words = count_words(texts, parts, settings)
    names = words.dropna().select("lang", F.col("word").alias("phrase"))
    return words, frequent_windows(texts, make_filter(phrase_hashes(names), settings), parts, settings)


# Scores --------------------------------------------------------------------------------------


def _words(phrase: Column) -> Column:
    return F.split(phrase, " ")


def _scored(words: DataFrame, phrases: DataFrame, settings: Settings) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the lowest cut of every phrase."""
    parts = words.dropna().select("lang", F.col("word").alias("part"), "f")
    shorter = phrases.filter(F.col("words") < settings.max_words)
    parts = parts.unionByName(shorter.select("lang", F.col("phrase").alias("part"), "f"))
    cut = (
        phrases.select("lang", "phrase", F.col("f").alias("a"), _words(F.col("phrase")).alias("w"))
        .select("*", F.explode(F.expr("sequence(1, size(w) - 1)")).alias("k"))
        .withColumn("first", F.expr("array_join(slice(w, 1, k), ' ')"))
        .withColumn("rest", F.expr("array_join(slice(w, k + 1, size(w)), ' ')"))
        .drop("w")
    )
    for side, out in (("first", "l"), ("rest", "r")):
        known = parts.select("lang", F.col("part").alias(side), F.col("f").alias(out))
        cut = lookup(cut, *aside(known, ["lang", side]), "inner")
    # 10^6 a^2 has up to 6 + 2 x 15 digits; l and r are at least a, so the quotient is at most
    # ``scale``, and a cut's number fits below it.
    whole = "CAST({} AS DECIMAL(15,0))".format
    score = F.expr(f"({settings.scale} * ({whole('a')} * {whole('a')})) div ({whole('l')} * {whole('r')})")
    ordered = cut.withColumn("key", score * settings.max_words + F.col("k"))
    lowest = ordered.groupBy("lang", "phrase", "a").agg(
        F.min("key").alias("key"), F.min_by("l", "key").alias("l"), F.min_by("r", "key").alias("r")
    )
    return lowest.withColumn("score", F.expr(f"(key - 1) div {settings.max_words}")).drop("key")


def _uncovered(scored: DataFrame, phrases: DataFrame, settings: Settings) -> DataFrame:
    """Without phrases that a longer one holds often enough."""
    longer = phrases.filter(F.col("words") > 2).withColumn("w", _words(F.col("phrase")))
    inner = longer.select("*", F.explode(F.expr("sequence(2, words - 1)")).alias("k"))
    placed = inner.select("*", F.explode(F.expr("sequence(1, words - k + 1)")).alias("at"))
    subs = placed.select("lang", F.expr("array_join(slice(w, at, k), ' ')").alias("phrase"), "f")
    most = subs.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    covered = 100 * F.coalesce(F.col("most"), F.lit(0)) >= settings.covered_percent * F.col("a")
    return lookup(scored, *aside(most, ["lang", "phrase"])).filter(~covered).drop("most")


def _ranked(scored: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language, numbered in slices, so no task orders all phrases of one."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    ranked = running_total(scored, F.lit(1).cast("bigint"), "rank", order_by=order, partition_by=["lang"])
    return ranked.filter(F.col("rank") <= top)


def mine_phrases(docs: DataFrame, *, lang: str = "lang", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The best collocations of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), cut at ``.,;:!?`` and line ends into pieces and those at
    spaces and tabs into words; all counts are of one language (null: ``und``). A phrase of
    2 to ``max_words`` words that occurs at least ``min_count`` times scores
    floor(scale * a^2 / (l * r)), with l and r the counts of its two parts, at the cut with
    the lowest score (ties: the earliest). Phrases inside a longer one that has at least
    ``covered_percent`` of their occurrences are left out. Ties in score are ordered by a,
    then by phrase. Null and empty texts count nothing; repeated rows count each time; an
    empty table gives no rows; other columns are not read. Starts jobs when the plan is built.
    """
    words, phrases = frequent_phrases(docs, lang=lang, text=text, settings=settings)
    scored = _uncovered(_scored(words, phrases, settings), phrases, settings)
    totals = words.filter(F.col("word").isNull()).select("lang", F.col("f").alias("n"))
    ranked = lookup(_ranked(scored, settings.top), *aside(totals, ["lang"]), "inner")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = rf"""
WITH w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)),
f AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS f
  FROM (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
        FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w CROSS JOIN (VALUES (1), (2), (3)) s(k)))
  GROUP BY ALL HAVING count(*) >= 10),
c AS (
  SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS p FROM f WHERE k > 1),
cut AS (
  SELECT c.lang, c.phrase, c.a, i, l.f AS l, r.f AS r, (1000000 * c.a::HUGEINT * c.a // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS i FROM c) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.p[1:i], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.p[i + 1:], ' ')),
best AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
inner_ AS (
  SELECT lang, phrase, max(a) AS most
  FROM (SELECT lang, a, array_to_string(p[1:2], ' ') AS phrase FROM c WHERE k = 3
        UNION ALL SELECT lang, a, array_to_string(p[2:3], ' ') FROM c WHERE k = 3) GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank,
       b.phrase, b.a, b.l, b.r, n.n, b.score
FROM best b LEFT JOIN inner_ i ON i.lang = b.lang AND i.phrase = b.phrase
JOIN (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang) n ON n.lang = b.lang
WHERE 100 * coalesce(i.most, 0) < 50 * b.a
QUALIFY rank <= 2000"""
