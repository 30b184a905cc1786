"""Benchmark decontamination by winnowing, in DataFrame operations only.

A window is a run of consecutive benchmark words. Of the k-grams of every window the one with the
smallest hash is its fingerprint, chosen in the same way in documents and benchmark; so an equal
window has an equal fingerprint. Fingerprints of documents join those of the benchmark, and every
place that meets one is extended to its window, whose words are compared as text. Windows shorter
than the full length (short items) are fingerprinted whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import stored, unused

WINDOW = 10
GRAM = 5
#: A side of a join with up to so many rows is broadcast (some 50 bytes each, or 50 a place);
#: a larger one is joined by a shuffle. The result and the steps are the same.
BROADCAST_ROWS = 500_000

# Everything in ASCII but letters and digits separates words.
_BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    """The words of a text, in its own case; an empty array for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _BREAKS), "")


def _exact_lower(text: Column) -> Column:
    """A-Z only, so that other letters keep their case; lower() is quicker where it is the same."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def _gram(codes: list[Column]) -> Column:
    """A hash of consecutive words: their hashes, each turned by its place."""
    out = None
    for j, code in enumerate(codes):
        turn = 11 * j + 1
        turned = F.shiftleft(code, turn).bitwiseOR(F.shiftrightunsigned(code, 64 - turn))
        out = turned if out is None else out.bitwiseXOR(turned)
    return out


def _fingerprint(codes: list[Column], gram: int) -> Column:
    """The least hash of the grams of a window, from the hashes of its words."""
    k = min(gram, len(codes))
    grams = [_gram(codes[j : j + k]) for j in range(len(codes) - k + 1)]
    return F.least(*grams) if len(grams) > 1 else grams[0]


def _windows(texts: DataFrame, words: str, size: int) -> DataFrame:
    """texts without the array `words`, by run of `size` of its values: at, and w.c0, w.c1, ...

    A row carries the window's own values only, so that it stays small however long the text is.
    """
    # no filter on the size: it would split the text a second time
    number = F.greatest(F.lit(0), F.size(words) - size + 1)
    shifted = [F.slice(words, j + 1, number).alias(f"c{j}") for j in range(size)]
    zipped = texts.withColumn("zipped", F.arrays_zip(*shifted))
    kept = [c for c in texts.columns if c != words]
    # outer, or a check for empty arrays would compute them twice; such rows have no window
    return zipped.select(*kept, F.posexplode_outer("zipped").alias("at", "w"))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(item_id, size, fp, phrase): the distinct windows of all items; phrase: words and blanks."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words"))
    lowered = F.transform("words", _exact_lower)
    coded = F.transform(lowered, lambda w: F.struct(w.alias("word"), F.xxhash64(w).alias("code")))
    items = items.select("item_id", coded.alias("words"))
    values = [F.col(f"w.c{j}") for j in range(window)]
    long = _windows(items, "words", window).filter("at is not null")
    long = long.select(
        "item_id",
        F.lit(window).alias("size"),
        _fingerprint([w["code"] for w in values], gram).alias("fp"),
        F.concat_ws(" ", *[w["word"] for w in values]).alias("phrase"),
    )
    short = items.withColumn("size", F.size("words")).filter(F.col("size").between(1, window - 1))
    codes = [F.get("words", F.lit(j))["code"] for j in range(window)]
    by_size = [F.when(F.col("size") == n, _fingerprint(codes[:n], gram)) for n in range(1, window)]
    short = short.select(
        "item_id",
        "size",
        F.coalesce(*by_size, F.lit(0)).alias("fp"),
        F.array_join(F.transform("words", lambda w: w["word"]), " ").alias("phrase"),
    )
    return long.unionByName(short).distinct()


def _item_sets(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(size, phrase, items) per distinct window, and (items, item_id): who is in that set.

    Windows of the same items share one set, so that a passage that many items hold meets a
    document once, not once a window and item. A set is named by the number of its items and
    three sums over their hashes.
    """
    h = [F.xxhash64("item_id", F.lit(j)) for j in range(3)]
    named = found.groupBy("size", "phrase").agg(
        F.concat_ws(
            ":",
            F.count("*"),
            F.sum(h[0].cast("decimal(20,0)")),
            F.sum(h[1].cast("decimal(20,0)")),
            F.bit_xor(h[2]),
        ).alias("items")
    )
    named = stored(named, "benchmark_phrases")
    return named, found.join(named, ["size", "phrase"]).select("items", "item_id").distinct()


def _hinted(frame: DataFrame, rows: int) -> DataFrame:
    """frame, to be broadcast where it is known to be small."""
    return F.broadcast(frame) if rows <= BROADCAST_ROWS else frame


def fingerprint_hits(docs: DataFrame, found: DataFrame, window: int, gram: int) -> DataFrame:
    """(doc_id, code, size, at): windows of docs whose fingerprint a benchmark window has."""
    marks = stored(found.select("size", "fp").distinct(), "fingerprints")
    # one small job: the sizes that occur, and how many fingerprints there are
    sizes = {r["size"]: r["n"] for r in marks.groupBy("size").agg(F.count("*").alias("n")).collect()}
    words = docs.select("doc_id", F.xxhash64("text").alias("code"), words_of(F.col("text")).alias("words"))
    codes = F.transform("words", lambda w: F.xxhash64(_exact_lower(w)))
    texts = words.select("doc_id", "code", codes.alias("codes"))
    every = None
    for size in sorted(sizes) or [window]:
        own = marks.filter(F.col("size") == size).select("fp")
        fp = _fingerprint([F.col(f"w.c{j}") for j in range(size)], gram)
        rows = _windows(texts, "codes", size).select(
            "doc_id",
            "code",
            F.lit(size).alias("size"),
            "at",
            # never null, or a join's null check would compute it twice
            F.coalesce(fp, F.lit(0)).alias("fp"),
        )
        hits = rows.join(_hinted(own, sizes.get(size, 0)), "fp", "left_semi")
        hits = hits.filter("at is not null").select("doc_id", "code", "size", "at")
        every = hits if every is None else every.unionByName(hits)
    return every


def window_hits(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> tuple[DataFrame, DataFrame]:
    """Places of benchmark windows in documents, and the items behind them.

    (doc_id, code, at, size, items): every place once; at: the first word, from 0; code: a hash
    of the text, so that rows that share a doc_id but not their text stay apart. (items, item_id):
    the items of each set that a place names.
    """
    found = stored(benchmark_windows(benchmark, window, gram), "benchmark_windows")
    phrases, members = _item_sets(found)
    hits = fingerprint_hits(docs, found, window, gram)
    places = stored(
        hits.groupBy("doc_id", "code", "size").agg(F.collect_set("at").alias("places")), "places"
    )
    met = places.agg(F.count("*") + F.coalesce(F.sum(F.size("places")), F.lit(0)))
    few = _hinted(
        places.select(F.col("doc_id").alias("_id"), F.col("code").alias("_code"), "size", "places"),
        met.first()[0],
    )
    texts = docs.select("doc_id", F.xxhash64("text").alias("code"), "text").join(
        few, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("code") == F.col("_code"))
    )
    texts = texts.select("doc_id", "code", "size", "places", words_of(F.col("text")).alias("words"))
    spans = F.transform(
        "places", lambda a: _exact_lower(F.concat_ws(" ", F.slice("words", a + 1, F.col("size"))))
    )
    # the words are named twice, or the text would be split again for every place
    spans = F.when(F.size("words") > 0, spans)
    extended = texts.select(
        "doc_id", "code", "size", F.arrays_zip(F.col("places").alias("at"), spans.alias("phrase")).alias("all")
    )
    extended = extended.select("doc_id", "code", "size", F.explode_outer("all").alias("x"))
    extended = extended.select("doc_id", "code", "size", "x.at", "x.phrase")
    kept = extended.join(phrases, ["size", "phrase"])
    return kept.select("doc_id", "code", "at", "size", "items").distinct(), members


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """(doc_id, code, n_words, n_hit, n_items, items, items_sha256, contaminated) per row of docs.

    Any shared run of `window` words is found, whatever surrounds it. Null and empty texts have
    no words; items without words are left out; an empty benchmark hits nothing; a null item_id
    counts as an item and is not listed. Rows that repeat a doc_id are judged by their own text,
    and repeated rows are returned as often as they occur. Other columns of either table are not
    read.
    """
    from pyspark.sql import Window

    hits, members = window_hits(docs, benchmark, window, gram)
    hits = stored(hits, "hits")
    key = ["doc_id", "code"]
    # words covered: each window adds what reaches beyond all windows before it
    before = Window.partitionBy(*key).orderBy("at", "size")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    places = hits.select(*key, "at", "size").distinct()
    reach = F.coalesce(F.max(F.col("at") + F.col("size")).over(before), F.lit(0))
    added = F.greatest(F.lit(0), F.col("at") + F.col("size") - F.greatest("at", "reach"))
    covered = places.withColumn("reach", reach).groupBy(*key).agg(F.sum(added).alias("n_hit"))
    named = hits.select(*key, "items").distinct().join(members, "items")
    items = named.select(*key, "item_id").distinct().groupBy(*key).agg(
        F.count("*").alias("n_items"),
        F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("items"),
    )
    found = covered.join(items, [same_key(covered, items, c) for c in key]).select(
        covered["doc_id"].alias("hit_id"), covered["code"].alias("hit_code"), "n_hit", "n_items", "items"
    )
    every = docs.select(
        "doc_id",
        F.xxhash64("text").alias("code"),
        F.size(words_of(F.col("text"))).cast("bigint").alias("n_words"),
    )
    met = (F.col("doc_id").eqNullSafe(F.col("hit_id"))) & (F.col("code") == F.col("hit_code"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return every.join(found, met, "left").select(
        "doc_id",
        "code",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        items.alias("items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def same_key(left: DataFrame, right: DataFrame, name: str) -> Column:
    return left[name].eqNullSafe(right[name])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs without the rows that hold a benchmark window, with all their columns."""
    hits, _ = window_hits(docs, benchmark, window)
    keys = stored(hits.select("doc_id", "code").distinct(), "contaminated")
    own, code = unused(docs, "_id", "_code")  # docs may have columns of any name
    few = _hinted(
        keys.select(F.col("doc_id").alias(own), F.col("code").alias(code)), keys.count()
    )
    met = F.col("doc_id").eqNullSafe(F.col(own)) & (F.xxhash64("text") == F.col(code))
    return docs.join(few, met, "left_anti")
