"""Phrase collocation mining: exact phrase counts by HAT-tries, then scores of the best cut.

A task counts phrases of word ids in a HAT-trie: a shallow trie over the first word ids whose
leaves are hash containers; a container that grows too large bursts into a trie node. When the
tries of a task hold too many entries, whole subtrees leave as runs sorted by phrase and their
memory is free again. The runs are merged per prefix partition: a phrase's first two words and a
salt decide the partition, so a frequent prefix is spread over SALTS of them.

Two passes. The first counts all words, and all pairs of words by their place among 2^PLACE
hashes: sorted runs of places that are merged per prefix too and take three bytes an entry. The
second counts phrases of two to five words in tries, if their words and the places of their pairs
are frequent. A phrase is never more frequent than its parts, so nothing is lost, and counts are
of words, not of hashes. What is frequent enters the second pass as two tables of 2^BITS bits (8
MB each whatever the corpus is): a bit that two share makes a task count a phrase which the sum
then drops, so a full table costs time, not results.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import LOWER, stored

MIN_COUNT, TOP, LONGEST = 100, 2000, 5
PLACE, BITS, SALTS = 40, 26, 16
#: Bytes of text whose pairs share a prefix partition, and least bits of a prefix.
PREFIX_BYTES, LEAST_PREFIX = 1 << 26, 10
UNKNOWN_LANGUAGE = "und"


@dataclass(frozen=True)
class Sizes:
    """What bounds the memory of a task; results do not depend on it.

    burst: entries of a container that bursts. budget: entries of all tries together. lexicon:
    different words known of all languages together before they begin anew. chunk: words that are
    counted together. pairs: pairs that make a run. part: bytes of a text that are read together.
    """

    burst: int = 1 << 12
    budget: int = 1 << 20
    lexicon: int = 1 << 19
    chunk: int = 1 << 18
    pairs: int = 1 << 20
    part: int = 1 << 20


#: Lower-cases A-Z, makes every end of a piece a full stop and every tab a blank.
END = b"."
_PIECES = LOWER.translate(bytes(b"."[0] if chr(c) in ".,;:!?\n\x0b\x0c\r" else 0x20 if c == 9 else c
                                for c in range(256)))
COUNTS = "lang string, phrase string, n bigint"
RUNS = "key bigint, lang string, phrase string, n bigint, run binary"
#: A merged count of a phrase, or the place of a frequent pair.
MERGED = "lang string, phrase string, n bigint, place bigint"
_MIX = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


# ---- within a task


class HatTrie:
    """Counts of tuples of word ids.

    depth: how many leading ids trie nodes may stand for. The first one always has a node; below
    it, tuples of the remaining ids are counted in a dict that bursts, down to that depth.
    """

    class Node(dict):
        """Word id to a deeper node, or to the container of what follows it."""

    def __init__(self, depth: int, burst: int = Sizes.burst):
        self.depth, self.burst = depth, burst
        self.root = self.Node()
        self.sizes: dict[int, int] = {}  # entries per first id
        self.entries = 0

    def add(self, key: tuple, n: int) -> None:
        first, level, node = key[0], 1, self.root
        below = node.get(first)
        if below is None:
            below = node[first] = {}
            self.sizes[first] = 0
        while type(below) is self.Node:
            node, word = below, key[level]
            level += 1
            below = node.get(word)
            if below is None:
                below = node[word] = {}
        rest = key[level:]
        before = below.get(rest)
        if before is not None:
            below[rest] = before + n
            return
        below[rest] = n
        self.entries += 1
        self.sizes[first] += 1
        if len(below) > self.burst and level < self.depth:
            node[key[level - 1]] = self._burst(below)

    def _burst(self, container: dict) -> Node:
        node = self.Node()
        for rest, n in container.items():
            node.setdefault(rest[0], {})[rest[1:]] = n
        return node

    def spill(self, keep: int) -> Iterator[tuple[tuple, int]]:
        """Take out the largest subtrees until at most `keep` entries stay."""
        for first in sorted(self.sizes, key=self.sizes.__getitem__, reverse=True):
            if self.entries <= keep:
                return
            self.entries -= self.sizes.pop(first)
            yield from _walk(self.root.pop(first), (first,))


def _walk(below: dict, key: tuple) -> Iterator[tuple[tuple, int]]:
    if type(below) is HatTrie.Node:
        for word, child in below.items():
            yield from _walk(child, (*key, word))
    else:
        for rest, n in below.items():
            yield key + rest, n


class _Lexicon(dict):
    """Word to id from 1, or to 0 where the known words lack it. The end of a piece is 0."""

    def __init__(self, lang: str, known: bytes | None):
        self.lang, self.known = lang, known
        self.words, self.hashes = [END], array("Q", [0])
        self[END] = 0

    def __missing__(self, word: bytes) -> int:
        h = word_hash(self.lang, word)
        found = 0
        if self.known is None or _has(self.known, h >> 64 - BITS):
            found = len(self.words)
            self.words.append(word)
            self.hashes.append(h)
        self[word] = found
        return found


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, xxhash.xxh32_intdigest(lang.encode()))


def _has(bits: bytes, position: int) -> bool:
    return bits[position >> 3] >> (position & 7) & 1 > 0


def pair_places(first, second):
    """The places of pairs among 2^PLACE, from arrays of their words' hashes."""
    import numpy as np

    mixed = (first * np.uint64(_MIX[0]) + second) * np.uint64(_MIX[1])
    return mixed >> np.uint64(64 - PLACE)


def pack_run(places, counts) -> bytes:
    """Sorted places below 2^32 and their counts: the steps between places byte by byte, the low
    ones first, so that the high bytes, mostly zero, stand together and compress; then counts."""
    import numpy as np

    steps = np.diff(places, prepend=places.dtype.type(0)).astype("<u4")
    planes = steps.view(np.uint8).reshape(-1, 4).T
    return planes.tobytes() + counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack_run(run: bytes):
    import numpy as np

    planes = np.frombuffer(run, np.uint8).reshape(8, -1)
    steps, counts = (np.ascontiguousarray(x.T).view("<u4").reshape(-1) for x in (planes[:4], planes[4:]))
    return np.cumsum(steps, dtype=np.uint64), counts.astype(np.int64)


def merge_runs(runs: list[bytes]):
    """(places, counts) of runs of one prefix, each place once."""
    import numpy as np

    places, counts = (np.concatenate(x) for x in zip(*map(unpack_run, runs)))
    order = np.argsort(places, kind="stable")
    places, counts = places[order], counts[order]
    first = np.flatnonzero(np.diff(places, prepend=places[0] + np.uint64(1)))
    return places[first], np.add.reduceat(counts, first)


class _Language:
    """What a task holds of one language: its words, its trie and ids not counted yet.

    Without tables (the first pass) words are counted in an array by id, and pairs are handed on
    by place; with them phrases of two to LONGEST words go into the trie.
    """

    def __init__(self, lang: str, tables: tuple[bytes, bytes] | None, sizes: Sizes):
        import numpy as np

        self.lang, self.tables, self.sizes = lang, tables, sizes
        self.word_counts = np.zeros(0, np.int64)
        self.lexicon = _Lexicon(lang, tables and tables[0])
        self.trie = HatTrie(2, sizes.burst)
        self.waiting: list = []
        self.n_waiting = 0
        self.places: list = []

    def read(self, text: bytes) -> None:
        import numpy as np

        tokens = text.translate(_PIECES).replace(END, b" . ").split()
        tokens.append(END)
        ids = np.fromiter(map(self.lexicon.__getitem__, tokens), np.int64, len(tokens))
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= self.sizes.chunk:
            self.count()

    def count(self) -> None:
        """Count what is waiting."""
        import numpy as np

        if not self.waiting:
            return
        ids = np.concatenate(self.waiting)
        self.waiting, self.n_waiting = [], 0
        linked = (ids[:-1] > 0) & (ids[1:] > 0)
        hashes = np.frombuffer(self.lexicon.hashes, np.uint64)[ids]
        places = pair_places(hashes[:-1], hashes[1:])
        if self.tables is None:
            self.places.append(places[linked])
            counts = np.bincount(ids, minlength=len(self.lexicon.words))
            counts[: len(self.word_counts)] += self.word_counts
            self.word_counts = counts
            return
        table, bit = np.frombuffer(self.tables[1], np.uint8), places >> np.uint64(PLACE - BITS)
        linked &= (table[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0
        shift = int(ids.max()).bit_length()
        joined, number = linked, ids  # number: of the phrase but for its last word
        for m in range(2, LONGEST + 1):
            start = np.flatnonzero(joined)
            if not len(start):
                return
            key = number[start] << shift | ids[start + m - 1]
            _, first, which, counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            phrases = ids[start[first][:, None] + np.arange(m)]
            for phrase, n in zip(phrases.tolist(), counts.tolist()):
                self.trie.add(tuple(phrase), n)
            number = np.zeros(len(ids), np.int64)
            number[start] = which
            joined = joined[:-1] & linked[m - 1 :]

    def run(self, keep: int = 0) -> list[tuple[bytes, int]]:
        """Spilled subtrees as one run, sorted by phrase."""
        words = self.lexicon.words
        return sorted((b" ".join([words[i] for i in key]), n) for key, n in self.trie.spill(keep))

    def counted_words(self, size: int) -> Iterator[list[tuple[bytes, int]]]:
        """The words counted by id, `size` at a time."""
        words, counts = self.lexicon.words, self.word_counts
        for at in range(1, len(counts), size):
            own = zip(words[at : at + size], counts[at : at + size].tolist())
            yield [(word, n) for word, n in own if n]


def _parts(text: bytes, size: int) -> Iterator[bytes]:
    """A text in parts of about `size` bytes that end where a piece ends; a piece stays whole."""
    at = 0
    while len(text) - at > size:
        end = min((k for k in (text.find(c, at + size) for c in (b".", b",", b"\n", b";", b":", b"!", b"?"))
                   if k >= 0), default=len(text))
        yield text[at:end]
        at = end
    yield text[at:]


def _runs(
    texts: DataFrame, prefix_bits: int, tables: tuple[bytes, bytes] | None, sizes: Sizes
) -> DataFrame:
    """RUNS of what the tasks counted: phrases with n, and of the first pass pairs by prefix."""
    held = texts.sparkSession.sparkContext.broadcast(tables)

    def count(batches):
        import pyarrow as pa

        known = held.value
        languages: dict[str, _Language] = {}

        def emit(language: _Language, keep: int = 0):
            run = language.run(keep)
            for at in range(0, len(run), 1 << 15):
                yield _phrase_batch(language.lang, run[at : at + (1 << 15)])

        def emit_all():
            for language in languages.values():
                language.count()
                yield from emit(language)
                for words in language.counted_words(1 << 15):
                    if words:
                        yield _phrase_batch(language.lang, words)
            yield from emit_pairs()

        def emit_pairs():
            found = [x for language in languages.values() for x in language.places]
            for language in languages.values():
                language.places = []
            if found:
                yield _pair_batch(found, prefix_bits)

        for batch in batches:
            texts_ = batch.column("text").cast(pa.binary())
            for lang, text in zip(batch.column("lang").to_pylist(), texts_):
                language = languages.get(lang)
                if language is None:
                    language = languages[lang] = _Language(lang, known, sizes)
                for part in _parts(text.as_py(), sizes.part):
                    language.read(part)
                    if sum(len(x.lexicon) for x in languages.values()) > sizes.lexicon:
                        yield from emit_all()
                        languages.clear()
                        language = languages[lang] = _Language(lang, known, sizes)
                if sum(x.trie.entries + x.n_waiting for x in languages.values()) > sizes.budget:
                    for x in languages.values():
                        x.count()
                    over = sum(x.trie.entries for x in languages.values()) - sizes.budget // 2
                    for x in languages.values():
                        if over > 0:
                            before = x.trie.entries
                            yield from emit(x, max(0, before - over))
                            over -= before - x.trie.entries
                if sum(len(p) for x in languages.values() for p in x.places) > sizes.pairs:
                    yield from emit_pairs()
        yield from emit_all()

    return texts.mapInArrow(count, RUNS)


def _batch(**columns):
    import pyarrow as pa

    kinds = {"key": pa.int64(), "lang": pa.string(), "phrase": pa.string(), "n": pa.int64(), "run": pa.binary()}
    rows = max(map(len, columns.values()))
    arrays = [columns.get(name, pa.nulls(rows, kind)) for name, kind in kinds.items()]
    return pa.RecordBatch.from_arrays(arrays, names=list(kinds))


def _phrase_batch(lang: str, run: list[tuple[bytes, int]]):
    import pyarrow as pa

    phrases, counts = zip(*run)
    phrases = pa.array(phrases, pa.binary()).cast(pa.string())
    return _batch(lang=pa.array([lang] * len(run)), phrase=phrases, n=pa.array(counts, pa.int64()))


def _pair_batch(found: list, prefix_bits: int):
    """One run per prefix of the places found, keyed below zero."""
    import numpy as np
    import pyarrow as pa

    places, counts = np.unique(np.concatenate(found), return_counts=True)
    prefixes = places >> np.uint64(PLACE - prefix_bits)
    edges = np.flatnonzero(np.diff(prefixes, prepend=prefixes[:1] + np.uint64(1))).tolist() + [len(places)]
    rest = places & np.uint64((1 << PLACE - prefix_bits) - 1)
    runs = [pack_run(rest[a:b], counts[a:b]) for a, b in zip(edges, edges[1:])]
    keys = [-1 - int(prefixes[a]) for a in edges[:-1]]
    return _batch(key=pa.array(keys, pa.int64()), run=pa.array(runs, pa.binary()))


# ---- plan


def _merged(runs: DataFrame, prefix_bits: int, min_count: int, all_phrases: bool) -> DataFrame:
    """MERGED from the runs of all tasks, each prefix partition by itself.

    Phrases are summed as they come in order; a prefix of pairs is held by itself. Those under
    min_count are left out, but phrases (then words) only unless all_phrases.
    """
    prefix = F.xxhash64("lang", F.substring_index("phrase", " ", 2))
    salted = F.xxhash64(prefix, F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    # phrases share the partitions of 2^20 keys; keys below zero are pairs
    dealt = runs.withColumn("key", F.coalesce("key", F.shiftrightunsigned(salted, 44)))

    def merge(batches):
        import numpy as np
        import pyarrow as pa

        least = 1 if all_phrases else min_count
        key, pending = None, []
        last, total = None, 0
        done: list[tuple] = []

        def close_pairs():
            if pending:
                places, counts = merge_runs(pending)
                often = places[counts >= min_count].astype(np.int64)
                offset = (-1 - key) << (PLACE - prefix_bits)
                done.extend((None, None, None, int(p) + offset) for p in often)
                pending.clear()

        def batch_of(rows):
            columns = list(zip(*rows)) or [[]] * 4
            kinds = pa.string(), pa.string(), pa.int64(), pa.int64()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "phrase", "n", "place"]
            )

        names = ("key", "lang", "phrase", "n", "run")
        for batch in batches:
            for k, lang, phrase, n, run in zip(*(batch.column(c).to_pylist() for c in names)):
                if k < 0:
                    if k != key:
                        close_pairs()
                        key = k
                    pending.append(run)
                    continue
                if (lang, phrase) != last:
                    if total >= least:
                        done.append((*last, total, None))
                    last, total = (lang, phrase), 0
                total += n
            if len(done) > 1 << 15:
                yield batch_of(done)
                done.clear()
        close_pairs()
        if last is not None and total >= least:
            done.append((*last, total, None))
        yield batch_of(done)

    ordered = dealt.repartition("key").sortWithinPartitions("key", "lang", "phrase")
    return ordered.mapInArrow(merge, MERGED)


def _table(bits: DataFrame) -> bytes:
    """2^BITS bits from rows of (bit); they reach the driver as blocks of 4 KB."""
    # bitmap functions count from one
    place = F.col("bit") + 1
    blocks = bits.groupBy(F.bitmap_bucket_number(place).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    table = bytearray(1 << BITS - 3)
    for block, held in blocks.collect():
        table[(block - 1) * len(held) : block * len(held)] = held
    return bytes(table)


def _word_bits(words: DataFrame) -> DataFrame:
    def find(batches):
        import pyarrow as pa

        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("lang", "phrase")))
            found = [word_hash(lang, word.encode()) >> 64 - BITS for lang, word in rows]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["bit"])

    return words.select("lang", "phrase").mapInArrow(find, "bit bigint")


def phrase_counts(
    docs: DataFrame, min_count: int = MIN_COUNT, sizes: Sizes = Sizes()
) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, n) of all phrases of up to five words with n >= min_count, (lang, n) of
    all word occurrences). Counts are per language and exact; phrases do not cross pieces."""
    texts = docs.select(
        F.coalesce("lang", F.lit(UNKNOWN_LANGUAGE)).alias("lang"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # the more text, the more prefixes, so that one of them stays small
    bits = max(LEAST_PREFIX, (size // PREFIX_BYTES).bit_length())
    first = stored(_merged(_runs(texts, bits, None, sizes), bits, min_count, True), "words")
    words = first.filter("phrase is not null").drop("place")
    frequent = words.filter(F.col("n") >= min_count)
    pairs = first.filter("place is not null").select(F.shiftright("place", PLACE - BITS).alias("bit"))
    tables = _table(_word_bits(frequent)), _table(pairs)
    longer = _merged(_runs(texts, bits, tables, sizes), bits, min_count, False).drop("place")
    every = frequent.unionByName(stored(longer, "phrases"))
    return every, words.groupBy("lang").agg(F.sum("n").alias("n"))


def _scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score) of phrases of two words and more."""
    phrases = counts.select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = (
        phrases.filter(F.size("words") > 1)
        .select("*", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
        .withColumns(
            {
                "left": F.array_join(F.slice("words", 1, F.col("k")), " "),
                "right": F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " "),
            }
        )
    )
    left, right = (
        counts.select("lang", F.col("phrase").alias(side), F.col("n").alias(name))
        for side, name in (("left", "l"), ("right", "r"))
    )
    cuts = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(totals, "lang")
    # 1000 * a * n may pass 64 bits
    score = F.expr("(cast(a as decimal(18, 0)) * 1000 * n) div (cast(l as decimal(19, 0)) * r)")
    return (
        cuts.withColumn("score", score)
        .groupBy("lang", "phrase", "words", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "words", "a", "cut.l", "cut.r", "n", "cut.score")
    )


def collocations(
    docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, sizes: Sizes = Sizes()
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases.

    Texts are lower-cased (A-Z), cut into pieces at . , ; : ! ? and line ends, and pieces into
    words at blanks and tabs. Candidates are phrases of two to five words that occur a >= min_count
    times in a language (null: und). Of the cuts of a candidate into two parts that occur l and r
    times the one with the least floor(1000 a n / (l r)) counts, of equal ones the first; n are
    the language's words. A candidate goes if a longer one holds its words side by side and is as
    frequent. The `top` best by score, then a, then phrase in byte order are ranked from 1; equal
    phrases cannot occur, repeated rows count as often as they stand there. Null and empty texts
    hold no words, an empty table gives no rows, very long texts are read in parts. Only lang and
    text are read.
    """
    counts, totals = phrase_counts(docs, min_count, sizes)
    scored = _scored(counts, totals)
    longer = counts.select("lang", "n", F.split("phrase", " ").alias("w")).filter(F.size("w") > 2)
    size = F.size("w")
    inside = (
        longer.select("*", F.explode(F.sequence(F.lit(2), size - 1)).alias("m"))
        .select("*", F.explode(F.sequence(F.lit(1), size - F.col("m") + 1)).alias("i"))
        .select("lang", F.array_join(F.slice("w", F.col("i"), F.col("m")), " ").alias("phrase"), "n")
        .groupBy("lang", "phrase")
        .agg(F.max("n").alias("longest"))
    )
    whole = F.col("longest").isNull() | (F.col("longest") * 100 < F.col("a") * 100)
    kept = scored.join(inside, ["lang", "phrase"], "left").filter(whole)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
