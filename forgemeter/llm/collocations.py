"""Phrase collocation mining by SON partitioning.

Documents are dealt into a few shards. Each shard is mined completely: every phrase that reaches the shard's
share of the support there is found, level by level (words, pairs of locally frequent words, triples of locally frequent
pairs). A phrase with the whole support reaches its share in one shard at least, so the union of what the shards
find holds every frequent phrase; all of the union is then counted over all documents, exactly.

A shard is no task: it is mined by grouping over all tasks that hold its documents, so a handful of shards does
for any size, and the local support stays above one. While mining, 64-bit hashes stand for phrases, which can only add
candidates; the count over all documents is by the words themselves.

What a shard found, and the union, meet the texts again as a filter of bits with a bounded size (``FILTER_BITS``).
A phrase that passes by chance is counted like any other, in full, and goes for its count. Where there are more
candidates than the filter can tell apart, more phrases are counted; results stay the same.

Texts are cut in Arrow batches, in stretches of ``CHUNK`` bytes; a stretch is reduced to its distinct phrases
before anything is shuffled, so a very common phrase is one row per stretch. The first 2,000 of a language come from the
first 2,000 of each of ``BINS`` hash bins.

Defined cases: a null text has no words; a null language is ``und``; repeated rows count again; a text of any length is
read whole, with phrases across the edges of stretches; ids are not used but for dealing; an empty table gives no
rows; extra columns are ignored. Counts may reach 10^15 (decimals of 38 digits hold the products).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored

SUPPORT = 10
SHARDS = 4
ABSORBED_PERCENT = 50
TOP = 2000
BINS = 32
CHUNK = 3_000_000  # bytes of text mined at a time
HELD = 10_000_000  # characters that wait in a task for others of their language and shard
FILTER_BITS = 28  # 2^28 bits, 32 MB, at most

_BREAK = b"\xff"  # no byte of UTF-8; stands between pieces
_CUTS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" ")
_ROW_BITS = 15  # a row of the filter as Spark builds it: 2^15 bits
_MIX = np.uint64(0x9E3779B97F4A7C15)
_FIRST_BYTES = np.array([2 ** (8 * n) - 1 for n in range(9)], np.uint64)
_SALTS = [((n + 1) * 0xD1342543DE82EF95) % 2**64 for n in range(64)]  # one a shard

_MINED = "lang string, part long, phrase string, key long, n long"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Words:
    """The words of a stretch in order, breaks among them, as numbers of a vocabulary; number 0 is the break."""

    def __init__(self, raw: bytes):
        tokens = pc.split_pattern(pa.array([_BREAK + b"  " + raw], pa.binary()), " ").values
        coded = tokens.dictionary_encode()  # a break is number 0, and what lies between two spaces number 1
        ids = coded.indices.to_numpy()[2:]
        ids = ids[ids != 1].astype(np.int64)
        self.ids = ids - (ids > 1)
        self.vocabulary = pa.concat_arrays([coded.dictionary.slice(0, 1), coded.dictionary.slice(2)])

    def __len__(self) -> int:
        return len(self.ids)

    def __getitem__(self, at: slice) -> list[bytes]:
        return self.vocabulary.take(pa.array(self.ids[at])).to_pylist()

    def phrases(self, *numbers: np.ndarray) -> pa.Array:
        """Words by their numbers, one of each argument, joined by spaces."""
        words = [self.vocabulary.take(pa.array(n)) for n in numbers]
        return pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.binary())).cast(pa.string())


class Filter:
    """A set of 64-bit keys in a bounded number of bits; a key that was put in is always found."""

    def __init__(self, bits: np.ndarray, width: int):
        self.bits, self.width = bits, width

    def has(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for place in places(keys, self.width):
            found &= (self.bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return found


def places(keys: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << width) - 1)
    return keys & mask, (keys >> np.uint64(64 - width)) & mask


def build_filter(keys: DataFrame) -> Filter:
    """The filter of a column ``key``; its width goes by the number of keys up to the bound."""
    n = keys.count()
    width = max(_ROW_BITS + 1, min(FILTER_BITS, (16 * n).bit_length()))
    low, high = F.col("key").bitwiseAND(F.lit((1 << width) - 1)), F.shiftrightunsigned("key", 64 - width)
    place = keys.select(F.explode(F.array(low, high)).alias("place"))
    row, bit = F.shiftright("place", _ROW_BITS), F.col("place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    rows = place.groupBy(row.alias("row")).agg(F.bitmap_construct_agg(bit).alias("bits"))
    bits = np.zeros((1 << width) // 8, np.uint8)
    step = (1 << _ROW_BITS) // 8
    for r in rows.collect():  # FILTER_BITS bits at most
        bits[r["row"] * step : (r["row"] + 1) * step] = np.frombuffer(r["bits"], np.uint8)[:step]
    return Filter(bits, width)


def part_number(lang: str, shard: int) -> int:
    """A signed 64-bit number for a language's shard: rows that are shuffled carry it in place of both."""
    number = xxhash.xxh3_64_intdigest(lang.encode()) ^ _SALTS[shard]
    return number - 2**64 if number >= 2**63 else number


def word_keys(vocabulary: pa.Array, lang: str) -> np.ndarray:
    """Hashes of the chunk's words, told apart by language: eight bytes of every word are mixed in at a time."""
    _, offsets, data = vocabulary.buffers()
    ends = np.frombuffer(offsets, np.int32)[vocabulary.offset : vocabulary.offset + len(vocabulary) + 1].astype(np.int64)
    at, left, rows = ends[:-1], np.diff(ends), np.arange(len(vocabulary))
    raw = np.frombuffer((b"" if data is None else data.to_pybytes()) + bytes(8), np.uint8)
    eight = np.lib.stride_tricks.sliding_window_view(raw, 8)
    keys = _mixed(np.uint64(xxhash.xxh3_64_intdigest(lang.encode())) ^ (left.astype(np.uint64) * _MIX))
    while len(rows):
        word = np.ascontiguousarray(eight[at]).view("<u8")[:, 0] & _FIRST_BYTES[np.minimum(left, 8)]
        keys[rows] = _mixed((keys[rows] ^ word) * _MIX)
        more = left > 8
        rows, at, left = rows[more], at[more] + 8, left[more] - 8
    return keys


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return _mixed(left * _MIX + (right ^ (right >> np.uint64(29))))


def salted(keys: np.ndarray, part: int) -> np.ndarray:
    """Keys told apart by the shard as well."""
    return keys ^ np.uint64(part % 2**64)


def _salted(key: Column, part: Column) -> Column:
    return key.bitwiseXOR(part)


class Chunk:
    """Words of one language and shard: numbers of the words, keys, and which places start a pair or a triple."""

    def __init__(self, lang: str, shard: int, words: Words, own: int):
        self.lang, self.part = lang, part_number(lang, shard)
        self.words, self.ids, self.own = words, words.ids, own
        self.size = len(words.vocabulary)
        if self.size >= 1 << 21:
            raise ValueError("a triple of word numbers must fit 63 bits: take a smaller CHUNK")
        self.keys = word_keys(words.vocabulary, lang)
        is_word = self.ids > 0
        self.pair = is_word[:-1] & is_word[1:]
        self.triple = self.pair[:-1] & self.pair[1:]
        self.pair[own:] = False
        self.triple[own:] = False

    def pair_places(self) -> np.ndarray:
        """The keys of all neighbours."""
        keys = self.keys[self.ids]
        return pair_keys(keys[:-1], keys[1:])

    def distinct(self, at: np.ndarray, length: int) -> tuple[list[np.ndarray], np.ndarray]:
        """Distinct phrases of so many words that start at the places: the numbers of their words, count."""
        places = np.flatnonzero(at)
        codes = self.ids[places]
        for n in range(1, length):
            codes = codes * self.size + self.ids[places + n]
        codes, count = np.unique(codes, return_counts=True)
        words = []
        for _ in range(length):
            codes, last = np.divmod(codes, self.size)
            words.insert(0, last)
        return words, count


def _rows(n: np.ndarray, lang: str | None = None, part: int | None = None, phrases: pa.Array | None = None, keys: np.ndarray | None = None) -> pa.RecordBatch:
    def same(value, kind: pa.DataType) -> pa.Array:
        return pa.nulls(len(n), kind) if value is None else pa.repeat(pa.scalar(value, kind), len(n))

    columns = [
        same(lang, pa.string()),
        same(part, pa.int64()),
        pa.nulls(len(n), pa.string()) if phrases is None else phrases,
        pa.nulls(len(n), pa.int64()) if keys is None else pa.array(keys.view(np.int64)),
        pa.array(n.astype(np.int64)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "part", "phrase", "key", "n"])


def mine_words(chunk: Chunk) -> Iterator[pa.RecordBatch]:
    n = np.bincount(chunk.ids[: chunk.own], minlength=chunk.size)
    n[0] = 0
    seen = np.flatnonzero(n)
    yield _rows(n[seen], chunk.lang, chunk.part, chunk.words.phrases(seen), chunk.keys[seen])


def mine_pairs(chunk: Chunk, frequent_words: Filter) -> Iterator[pa.RecordBatch]:
    """Pairs whose words are both frequent in the shard, by their hashes."""
    frequent = frequent_words.has(salted(chunk.keys, chunk.part))[chunk.ids]
    (left, right), n = chunk.distinct(chunk.pair & frequent[:-1] & frequent[1:], 2)
    yield _rows(n, part=chunk.part, keys=pair_keys(chunk.keys[left], chunk.keys[right]))


def mine_triples(chunk: Chunk, frequent_pairs: Filter, candidates: Filter) -> Iterator[pa.RecordBatch]:
    """Counts of candidate pairs; triples whose pairs are both frequent in the shard, by their hashes."""
    places = chunk.pair_places()
    words, n = chunk.distinct(chunk.pair & candidates.has(places), 2)
    yield _rows(n, chunk.lang, phrases=chunk.words.phrases(*words))
    frequent = frequent_pairs.has(salted(places, chunk.part))
    (a, b, c), n = chunk.distinct(chunk.triple & frequent[:-1] & frequent[1:], 3)
    yield _rows(n, part=chunk.part, keys=pair_keys(pair_keys(chunk.keys[a], chunk.keys[b]), chunk.keys[c]))


def count_triples(chunk: Chunk, candidates: Filter) -> Iterator[pa.RecordBatch]:
    keys = pair_keys(chunk.pair_places()[:-1], chunk.keys[chunk.ids[2:]])
    words, n = chunk.distinct(chunk.triple & candidates.has(keys), 3)
    yield _rows(n, chunk.lang, phrases=chunk.words.phrases(*words))


def stretches(texts: list[str]) -> Iterator[tuple[Words, int]]:
    """Words of the texts in order, a break after every piece, in stretches of bounded length.

    Phrases begin in the first ``own`` words of a stretch; the two words after them are those that the next one
    begins with, so a phrase across an edge is found once.
    """
    raw = ("\n".join(texts).encode() + b"\n").lower().translate(_CUTS).replace(b"\n", b" " + _BREAK + b" ")
    carried = b""
    start = 0
    while start < len(raw):
        stop = start + CHUNK
        stop = (raw.find(b" ", stop) if stop < len(raw) else len(raw)) + 1 or len(raw)
        words = Words(carried + raw[start:stop])
        start = stop
        own = len(words) if start >= len(raw) else max(0, len(words) - 2)
        carried = b" ".join(words[own:]) + b" "
        yield words, own


def _stream(mine: Callable[..., Iterator[pa.RecordBatch]], *filters) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Reads (lang, shard, text) and mines chunks of one language and shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = [f.value for f in filters]
        held: dict[tuple[str, int], list[str]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, shard), texts in held.items():
                for words, own in stretches(texts):
                    if own > 0:
                        yield from mine(Chunk(lang, shard, words, own), *loaded)
            held.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                for lang, shard, text in zip(*(rows.column(c).to_pylist() for c in ("lang", "shard", "text"))):
                    held.setdefault((lang, shard), []).append(text)
                    size += len(text)
                if size > HELD:
                    yield from flush()
                    size = 0
        yield from flush()

    return run


def _mined(dealt: DataFrame, mine, *filters: Filter) -> DataFrame:
    context = dealt.sparkSession.sparkContext
    shared = [context.broadcast(f) for f in filters]
    return dealt.mapInArrow(_stream(mine, *shared), _MINED)


def phrases(docs: DataFrame, support: int = SUPPORT) -> DataFrame:
    """lang, words (array), f of every phrase of one to three words; those of two or three with f >= support only."""
    dealt = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(SHARDS)).cast("int").alias("shard"),
        F.col("text").cast("string").alias("text"),
    ).filter("text IS NOT NULL")

    words = stored(_mined(dealt, mine_words).groupBy("lang", "part", "phrase", "key").agg(F.sum("n").alias("n")), "phrase-words")
    sizes = words.groupBy("lang", "part").agg(F.sum("n").alias("in_shard"))
    shares = sizes.join(sizes.groupBy("lang").agg(F.sum("in_shard").alias("in_lang")), "lang")
    shares = stored(shares.select("part", "in_shard", "in_lang"), "phrase-shares")

    def frequent(counts: DataFrame) -> DataFrame:
        """What reaches the shard's share of the support: n / in_shard >= support / in_lang."""
        wide = "decimal(19,0)"
        reached = F.col("n").cast(wide) * F.col("in_lang").cast(wide) >= F.lit(support).cast(wide) * F.col("in_shard").cast(wide)
        return counts.join(shares, "part").filter(reached).select("part", "key")

    def in_shards(found: DataFrame) -> Filter:
        return build_filter(found.select(_salted(F.col("key"), F.col("part")).alias("key")))

    pairs = _mined(dealt, mine_pairs, in_shards(frequent(words))).groupBy("part", "key").agg(F.sum("n").alias("n"))
    pairs = stored(frequent(pairs), "phrase-pairs")
    both = _mined(dealt, mine_triples, in_shards(pairs), build_filter(pairs.select("key").distinct()))
    both = stored(both.groupBy("lang", "part", "phrase", "key").agg(F.sum("n").alias("n")), "phrase-triples")
    triples = stored(frequent(both.filter("key IS NOT NULL")).select("key").distinct(), "phrase-candidates")
    counted = _mined(dealt, count_triples, build_filter(triples)).groupBy("lang", "phrase").agg(F.sum("n").alias("f"))

    single = words.groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
    double = both.filter("phrase IS NOT NULL").select("lang", "phrase", F.col("n").alias("f"))
    return single.union(double.filter(F.col("f") >= support)).union(counted.filter(F.col("f") >= support))


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)): a whole number of at most a million, since a is at most l and r."""
    wide = "decimal(16,0)"
    top = (F.lit(1_000_000).cast("decimal(7,0)") * a.cast(wide)) * a.cast(wide)
    below = left.cast(wide) * right.cast(wide)
    rest = F.pmod(top, below)
    return ((top - rest) / below).cast("long")


def collocations(docs: DataFrame, support: int = SUPPORT, absorbed: int = ABSORBED_PERCENT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language."""
    known = stored(phrases(docs, support).withColumn("w", F.split("phrase", " ")), "phrases")
    single = known.filter(F.size("w") == 1).select("lang", "phrase", "f")
    several = known.filter(F.size("w") > 1)
    part = known.filter(F.size("w") < 3).select("lang", F.col("phrase"), "f")

    def cut(k: int, candidates: DataFrame) -> DataFrame:
        first = F.array_join(F.slice("w", 1, k), " ")
        rest = F.array_join(F.slice("w", F.lit(k + 1), F.size("w") - k), " ")
        sides = candidates.withColumn("first", first).withColumn("rest", rest)
        left = part.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
        right = part.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
        found = sides.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
        return found.select("lang", "phrase", F.struct(_score(F.col("f"), F.col("l"), F.col("r")).alias("score"), F.lit(k).alias("k"), "l", "r").alias("cut"))

    longer = several.filter(F.size("w") == 3)
    cuts = cut(1, several).union(cut(2, longer))
    lowest = cuts.groupBy("lang", "phrase").agg(F.min("cut").alias("cut"))
    inside = longer.select("lang", F.explode(F.array(F.array_join(F.slice("w", 1, 2), " "), F.array_join(F.slice("w", 2, 2), " "))).alias("phrase"), F.col("f").alias("over"))
    most = inside.groupBy("lang", "phrase").agg(F.max("over").alias("over"))
    kept = several.join(most, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("over"), F.lit(0)) < absorbed * F.col("f"))
    scored = kept.join(lowest, ["lang", "phrase"]).select("lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "cut.score")

    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    binned = scored.withColumn("bin", F.pmod(F.xxhash64("phrase"), F.lit(BINS)))
    near = binned.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "bin").orderBy(*order))).filter(F.col("rank") <= top)
    best = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    sizes = single.groupBy("lang").agg(F.sum("f").alias("n"))
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
