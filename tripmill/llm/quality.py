"""Quality rules: counts over a text, and n-gram perplexity inside bands of its language.

The language model is a modified Kneser-Ney model over 5-grams of the texts' bytes, all 256 of
them: every 5-gram of every text is counted, and a model has an entry for each that occurs, so it
grows with what the corpus holds. Spark counts the 5-grams and fits one model per language; a
model is kept as sorted arrays of n-gram keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tripmill.llm.common import SPACE, arrow_rows, stored, unused, utf8

ORDER = 5
SYMBOLS = 256
#: The most frequent languages, whose models are broadcast with one of all other texts together:
#: the probability of each 5-gram that occurs, in at most 17 models. Any further language has a
#: model of its own as well, which only the tasks get that score its texts.
LANGUAGES = 16
OTHER = "*"
#: Bytes of such a language that one task scores; one of no more is also counted and fitted there.
RARE_BYTES = 32 << 20
#: Width of the bands, in quartile distances from the median of the language.
BAND = 5.0
#: No band is narrower than so many nats a byte, widened for short texts.
FLOOR = 0.03

#: Stands before a text; no byte of UTF-8.
PAD = b"\xff" * (ORDER - 1)
#: 5-grams that a task gathers before it counts them, and different ones that it holds of all languages.
GATHERED, HELD = 1 << 21, 1 << 21


def _keys(text: bytes):
    """The 5-gram key of every byte, the first ones with edge symbols before them."""
    import numpy as np

    s = np.frombuffer(PAD + text, dtype=np.uint8).astype(np.uint64)
    two = (s[:-1] << np.uint64(8)) | s[1:]
    four = (two[:-2] << np.uint64(16)) | two[2:]
    return (four[:-1] << np.uint64(8)) | s[4:]


COUNTS = "lang string, gram bigint, n bigint"


def _summed(keys, counts):
    """(keys, counts): sorted, each key once."""
    import numpy as np

    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def _added(total, waiting: list):
    """total, None or as _summed gives it, with the keys of the arrays in waiting."""
    import numpy as np

    found, counts = np.unique(np.concatenate(waiting), return_counts=True)
    if total is None:
        return found, counts
    return _summed(np.concatenate([total[0], found]), np.concatenate([total[1], counts]))


def count_grams(docs: DataFrame, gathered: int = GATHERED, held: int = HELD) -> DataFrame:
    """(lang, gram, n): every 5-gram of every text; docs has (lang, text).

    Tasks add up their own counts first. gathered and held bound their memory, not the result: when
    a task holds more than `held` different 5-grams it sends them on and begins anew.
    """

    def count(batches):
        import numpy as np
        import pyarrow as pa

        totals: dict[str, tuple] = {}
        waiting: dict[str, list] = {}
        n_waiting = 0

        def add():
            for lang, keys in waiting.items():
                totals[lang] = _added(totals.get(lang), keys)
            waiting.clear()

        def emit():
            for lang, (keys, counts) in totals.items():
                for at in range(0, len(keys), 1 << 16):
                    own = keys[at : at + (1 << 16)].astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.repeat(pa.scalar(lang, pa.string()), len(own)),
                            pa.array(own),
                            pa.array(counts[at : at + (1 << 16)].astype(np.int64)),
                        ],
                        names=["lang", "gram", "n"],
                    )
            totals.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), utf8(batch)):
                if not text:
                    continue
                waiting.setdefault(lang, []).append(_keys(text))
                n_waiting += len(text)
                if n_waiting > gathered:
                    add()
                    n_waiting = 0
                    if sum(len(keys) for keys, _ in totals.values()) > held:
                        yield from emit()
        add()
        yield from emit()

    parts = docs.mapInArrow(count, COUNTS)
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _discounts(counts) -> list[float]:
    """Of counts 0, 1, 2 and 3 or more, by how many n-grams occur once, twice, ..."""
    import numpy as np

    n1, n2, n3, n4 = (float(np.count_nonzero(counts == k)) for k in (1, 2, 3, 4))
    if not n1 or not n2:
        return [0.0, 0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [0.0, *(min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1))]


def _levels(grams, counts, symbols: int, order: int) -> list[tuple]:
    """(keys, counts) by order from 1, sorted by key: below the top, how many symbols may stand before
    an n-gram. Contexts that follow nothing, as edge symbols make, and single symbols count 0."""
    import numpy as np

    by_key = np.argsort(grams)
    levels = [(np.asarray(grams, np.int64)[by_key], np.asarray(counts, np.int64)[by_key])]
    for k in range(order - 1, 0, -1):
        keys, c = levels[-1]
        own, c_own = np.unique(keys[c > 0] % symbols**k, return_counts=True)
        every = np.union1d(own, np.arange(symbols) if k == 1 else keys // symbols)
        c_every = np.zeros(len(every), np.int64)
        c_every[np.searchsorted(every, own)] = c_own
        levels.append((every, c_every))
    return levels[::-1]


def fit_kneser_ney(grams, counts, symbols: int = 32, order: int = 4) -> list[tuple]:
    """(order, keys, log_p, log_backoff) of a modified Kneser-Ney model, sorted by key.

    grams: different n-grams of `order` symbols as numbers of base `symbols`. log_p: interpolated,
    of each n-gram that occurs or is a context, and of all single symbols; log_backoff: of each
    such n-gram as a context (0 where it is none). An n-gram that is not there has the log_p of the
    next lower order plus the log_backoff of its context.
    """
    import numpy as np

    fitted: list[tuple] = []
    for k, (keys, c) in enumerate(_levels(grams, counts, symbols, order), 1):
        lower = np.exp(_log_p(fitted, keys % symbols ** (k - 1), symbols)) if fitted else 1 / symbols
        d = np.array(_discounts(c))
        off = d[np.minimum(c, 3)]
        contexts, which = np.unique(keys // symbols, return_inverse=True)
        total = np.bincount(which, c)
        gamma = np.where(total > 0, np.bincount(which, off) / np.maximum(total, 1), 1.0)
        p = (c - off) / np.maximum(total, 1)[which] + gamma[which] * lower
        if fitted:
            fitted[-1][3][np.searchsorted(fitted[-1][1], contexts)] = np.log(gamma)
        fitted.append((k, keys, np.log(p), np.zeros(len(keys))))
    return fitted


def _log_p(model: list[tuple], grams, symbols: int):
    """The log-probability of n-grams of the model's highest order."""
    import numpy as np

    out = model[0][2][grams % symbols]
    contexts = model[0]
    for order, keys, log_p, log_backoff in model[1:]:
        own = grams % symbols**order
        _, below, _, backoff = contexts
        out = out + _found(own // symbols, below, backoff, 0.0)
        out = np.where(_has(own, keys), _found(own, keys, log_p, 0.0), out)
        contexts = (order, keys, log_p, log_backoff)
    return out


def expand(model: list[tuple], grams=None, symbols: int = 32):
    """The log-probability of each of the grams; without them, of all that there could be."""
    import numpy as np

    grams = np.arange(symbols ** len(model)) if grams is None else grams
    return _log_p(model, grams, symbols).astype(np.float32)


def _has(values, keys):
    import numpy as np

    if not len(keys):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return keys[at] == values


def _found(values, keys, results, default: float):
    import numpy as np

    if not len(keys):
        return np.full(len(values), default)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return np.where(keys[at] == values, results[at], default)


def packed(lang: str, model: list[tuple]) -> list[tuple]:
    """The rows of MODEL: 12 bytes an n-gram."""
    import numpy as np

    rows = []
    for k, keys, log_p, log_backoff in model:
        last = k == len(model)  # the top order is no context
        arrays = keys.astype(np.int64 if last else np.uint32), log_p, log_backoff[: 0 if last else None]
        own = arrays[0], *(x.astype(np.float32) for x in arrays[1:])
        rows.append((lang, k, *(x.tobytes() for x in own)))
    return rows


MODEL = "lang string, order int, keys binary, log_p binary, log_backoff binary"


def fit_models(counts: DataFrame) -> DataFrame:
    """One row of sorted arrays per language and order; a group has the different 5-grams of a
    language, which are far fewer than its bytes, in one task."""

    def fit(pdf):
        import pandas as pd

        fitted = fit_kneser_ney(pdf["gram"].to_numpy(), pdf["n"].to_numpy(), SYMBOLS, ORDER)
        return pd.DataFrame(packed(pdf["lang"].iloc[0], fitted), columns=[f.split()[0] for f in MODEL.split(", ")])

    return counts.groupBy("lang").applyInPandas(fit, MODEL)


def own_languages(docs: DataFrame, most: int = LANGUAGES) -> list[str]:
    """The most frequent languages, ties by name."""
    counts = docs.filter("lang is not null").groupBy("lang").count()
    rows = counts.orderBy(F.desc("count"), "lang").limit(most).collect()
    return [r["lang"] for r in rows]


# ---- counts over one text

SCORED = (
    "doc_id bigint, lang string, n_words bigint, word_chars bigint, n_symbols bigint,"
    " n_dup_lines bigint, n_repeat_words bigint, n_bytes bigint, log_ppl double, log_mix double, code bigint"
)
_SYMBOL_BYTES = b"#*$%&|<>"


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a 5-word window occurring at least twice."""
    import numpy as np

    n = len(words) - 4
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.uint64, len(words))
    if len(known) == len(words):
        return 0
    # ranks of pairs, then of pairs of pairs, then with the fifth word: exact, no hashing
    base = np.uint64(len(known))
    two = np.unique(ids[:-1] * base + ids[1:], return_inverse=True)[1].astype(np.uint64)
    four = two[: n + 1][:-1] * np.uint64(two.max() + 1) + two[2:][: n]
    four = np.unique(four, return_inverse=True)[1].astype(np.uint64)
    _, which, times = np.unique(four * base + ids[4:], return_inverse=True, return_counts=True)
    often = times[which] > 1
    if not often.any():
        return 0
    covered = np.zeros(len(words), dtype=bool)
    for j in range(5):
        covered[j : j + n] |= often
    return int(covered.sum())


def text_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of UTF-8 text."""
    words = text.split()
    inner = text.translate(None, SPACE)
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (
        len(words),
        len(inner.decode("utf-8", "replace")) if not inner.isascii() else len(inner),
        len(inner) - len(inner.translate(None, _SYMBOL_BYTES)),
        len(lines) - len(set(lines)),
        repeat_words(words),
    )


def score_texts(docs: DataFrame, sent, rate, schema) -> DataFrame:
    """What rate(batch, [models]) makes of the rows of docs; sent: a broadcast of Scores."""

    def score(batches):
        tables = sent.value
        for batch in batches:
            yield rate(batch, [tables])

    return docs.mapInArrow(score, schema)


def _score_large(rare: DataFrame, sent, rate, schema, task_bytes: int) -> DataFrame:
    """score_rare of languages that more than one task scores: the model is sent ahead of the rows to
    each of these tasks, and a task holds one at a time; none passes through the driver."""
    grams = stored(count_grams(rare.select("lang", "row.text")), "rare_grams")
    parts = grams.groupBy("lang").agg((F.sum("n") / task_bytes).cast("int").alias("parts"))
    arrays = [f for f in StructType.fromDDL(MODEL).fields if f.name.startswith(("keys", "log"))]
    row = rare.schema["row"].dataType
    models = fit_models(grams).join(parts, "lang").select(
        "lang", F.explode(F.sequence(F.lit(0), "parts")).alias("part"), "order",
        *[f.name for f in arrays], F.lit(None).cast(row).alias("row"),
    )
    part = F.pmod(F.xxhash64("row"), F.coalesce("parts", F.lit(0)) + 1).cast("int")
    rows = rare.join(parts, "lang", "left").select(
        "lang", part.alias("part"), F.lit(ORDER + 1).alias("order"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in arrays], "row",
    )

    def score(batches):
        import pyarrow as pa

        tables = sent.value
        lang, model, own = None, {}, None
        for batch in batches:
            langs, orders = (batch.column(c).to_pylist() for c in ("lang", "order"))
            at = 0
            while at < len(langs):
                if langs[at] != lang:
                    lang, model, own = langs[at], {}, None
                end = at + 1
                if orders[at] <= ORDER:
                    if own is None:
                        found = (batch.column(f.name)[at].as_py() for f in arrays)
                        model[orders[at]] = lang, orders[at], *found
                else:
                    while end < len(langs) and langs[end] == lang and orders[end] > ORDER:
                        end += 1
                    own = own or Scores(list(model.values()))
                    texts = pa.RecordBatch.from_struct_array(batch.column("row").slice(at, end - at))
                    yield rate(texts, [tables, own], lang)
                at = end

    both = models.unionByName(rows).repartition("lang", "part")
    return both.sortWithinPartitions("lang", "part", "order").mapInArrow(score, schema)


def _runs(langs: list):
    """(start, end) of equal neighbours."""
    edges = [k for k in range(1, len(langs)) if langs[k] != langs[k - 1]]
    return zip([0, *edges], [*edges, len(langs)])


def _score_small(rare: DataFrame, sent, rate, schema) -> DataFrame:
    """score_rare of languages that one task can hold, which counts, fits and scores each in turn."""

    def score(batches):
        import pyarrow as pa

        tables = sent.value
        lang, held, total, waiting, n_waiting = None, [], None, [], 0

        def scored():
            grams = _added(total, waiting) if waiting else total
            own = Scores(packed(lang, fit_kneser_ney(*grams, SYMBOLS, ORDER)) if grams else [])
            for texts in held:
                yield rate(texts, [tables, own], lang)

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for at, end in _runs(langs) if langs else ():
                if langs[at] != lang:
                    yield from scored()
                    lang, held, total, waiting, n_waiting = langs[at], [], None, [], 0
                held.append(pa.RecordBatch.from_struct_array(batch.column("row").slice(at, end - at)))
                for text in filter(None, utf8(held[-1])):
                    waiting.append(_keys(text))
                    n_waiting += len(text)
                    if n_waiting > GATHERED:
                        total, waiting, n_waiting = _added(total, waiting), [], 0
        yield from scored()

    return rare.repartition("lang").sortWithinPartitions("lang").mapInArrow(score, schema)


def score_rare(rare: DataFrame, sent, rate, schema, task_bytes: int = RARE_BYTES) -> DataFrame:
    """What rate(batch, [models, own], lang) makes of the rows of rare: (lang, row), a struct with text.

    Each language has a model, `own`, fitted to every 5-gram of all of its texts. Languages of up to
    `task_bytes` are shuffled once as texts, others have `task_bytes` of text scored by a task.
    """
    sizes = rare.groupBy("lang").agg(F.sum(F.octet_length("row.text")).alias("size"))
    large = stored(sizes.filter(F.col("size") > task_bytes).select("lang"), "large_languages")
    if large.isEmpty():
        return _score_small(rare, sent, rate, schema)
    # at most one language per `task_bytes` of the corpus
    small = rare.join(F.broadcast(large), "lang", "left_anti")
    rest = rare.join(F.broadcast(large), "lang", "left_semi")
    whole = _score_small(small, sent, rate, schema)
    return whole.union(_score_large(rest, sent, rate, schema, task_bytes))


def _scored(rows: DataFrame, rare, sent, rate, schema) -> DataFrame:
    """What rate makes of all rows, written; rare: see _prepared."""
    if rare is None:
        return stored(score_texts(rows, sent, rate, schema), "scores")
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row")
    own = rows.filter(rare).select(F.col("lang").cast("string").alias("lang"), row)
    common = score_texts(rows.filter(~rare), sent, rate, schema)
    return stored(common.union(score_rare(own, sent, rate, schema)), "scores")


def perplexities(text: bytes, lang: str, tables: list[Scores]) -> tuple:
    """Mean negative log-probability a byte: in lang, and with each line in its best language."""
    import numpy as np

    if not text:
        return None, None
    keys = _keys(text)
    breaks = np.flatnonzero(np.frombuffer(text, dtype=np.uint8)[:-1] == 10) + 1
    lines = np.concatenate([[0], breaks])
    sums = {}
    for table in tables:
        at = table.places(keys)
        for k, t in table.by_lang.items():
            sums[k] = np.add.reduceat(t[at], lines, dtype=np.float64)
    best = np.max(list(sums.values()), axis=0)
    return -float(sums[lang].sum()) / len(text), -float(best.sum()) / len(text)


class Scores:
    """The log-probabilities, in every model, of all 5-grams that any model has counted.

    The 5-grams are found by their place in a table of hashes at most a quarter full, one look-up for
    all models. A text that was not counted may have others: these are as likely as any byte.
    """

    def __init__(self, rows: list[tuple]):
        import numpy as np

        models: dict[str, list] = {}
        for lang, order, keys, log_p, log_backoff in rows:
            kind = np.int64 if order == ORDER else np.uint32
            arrays = (np.frombuffer(x, np.float32) for x in (log_p, log_backoff))
            models.setdefault(lang, []).append((order, np.frombuffer(keys, kind).astype(np.int64), *arrays))
        models = {lang: sorted(own, key=lambda r: r[0]) for lang, own in models.items()}
        tops = [own[-1][1] for own in models.values()]
        grams = np.unique(np.concatenate(tops)) if tops else np.zeros(0, np.int64)
        flat = np.float32(-np.log(SYMBOLS))
        self.by_lang = {
            lang: np.append(expand(own, grams, SYMBOLS), flat) for lang, own in models.items()
        }
        # the last one stands for all that were not counted; no key is so large
        self.grams = np.append(grams.astype(np.uint64), np.uint64(0xFFFFFFFFFFFFFFFF))
        self.bits = max(4, (4 * len(grams)).bit_length())
        self.slots = np.full(1 << self.bits, len(grams), dtype=np.int32)
        left = np.arange(len(grams))
        place = self._hash(self.grams[:-1])
        while len(left):
            free = self.slots[place] == len(grams)
            self.slots[place[free]] = left[free]  # of several the last one stays
            still = self.slots[place] != left
            left, place = left[still], (place[still] + 1) & ((1 << self.bits) - 1)

    def _hash(self, keys):
        import numpy as np

        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def places(self, keys):
        """Where the arrays of by_lang have the keys."""
        import numpy as np

        place = self._hash(keys)
        found = self.slots[place]
        last = len(self.grams) - 1
        left = np.flatnonzero((self.grams[found] != keys) & (found != last))
        while len(left):
            place[left] = (place[left] + 1) & ((1 << self.bits) - 1)
            here = self.slots[place[left]]
            found[left] = here
            left = left[(self.grams[here] != keys[left]) & (here != last)]
        return found


BASE_FAILED = "n_words < 10 or 100 * n_repeat_words > 20 * n_words"


def _prepared(docs: DataFrame, languages: int):
    """(named, texts, rare, sent): the language whose model a text has, the texts, which of them are
    of a language beyond those with a broadcast model (None: no text is), and the broadcast models."""
    texts = docs.withColumn("lang", F.col("lang").cast("string")).withColumn(
        "text", F.coalesce("text", F.lit(""))
    )
    own = own_languages(texts, languages)
    named = F.when(F.col("lang").isin(own), F.col("lang")).otherwise(OTHER) if own else F.lit(OTHER)
    counted = texts.select(named.alias("lang"), "text")
    models = fit_models(stored(count_grams(counted), "grams"))
    models = Scores([tuple(r) for r in models.collect()])
    rare = F.coalesce(~F.col("lang").cast("string").isin(*own, OTHER), F.lit(False))
    if len(own) < languages or texts.filter(rare).isEmpty():
        rare = None
    else:
        named = F.when(rare, F.col("lang")).otherwise(named)
    return named, texts, rare, docs.sparkSession.sparkContext.broadcast(models)


def _bands(scored: DataFrame) -> DataFrame:
    """(lang, q, r): quartiles of log_ppl and log_mix over texts that do not fail."""
    quartiles = [
        F.percentile_approx(c, [0.25, 0.5, 0.75], 10000).alias(q)
        for c, q in (("log_ppl", "q"), ("log_mix", "r"))
    ]
    return scored.filter("not base_failed").groupBy("lang").agg(*quartiles)


def _inside_bands(scored: DataFrame, band: float) -> DataFrame:
    """scored with base_failed, low, high and kept; see judge."""
    scored = scored.withColumn("base_failed", F.expr(BASE_FAILED))
    loose = F.lit(FLOOR) + 2.0 / F.sqrt(F.greatest("n_bytes", F.lit(1)))
    q, r = F.col("q"), F.col("r")
    low = q[1] - F.greatest(F.lit(band) * (q[1] - q[0]), loose)
    high = r[1] + F.greatest(F.lit(band) * (r[2] - r[1]), loose)
    inside = (F.col("log_ppl") >= F.col("low")) & (F.col("log_mix") <= F.col("high"))
    bands = stored(_bands(scored), "bands")  # a row per language
    banded = scored.join(F.broadcast(bands), "lang", "left")
    banded = banded.select(*scored.columns, low.alias("low"), high.alias("high"))
    return banded.withColumn("kept", ~F.col("base_failed") & inside)


def judge(docs: DataFrame, band: float = BAND, languages: int = LANGUAGES) -> DataFrame:
    """Counts, log_ppl, its band, base_failed and kept, one row per row of docs (doc_id, lang, text).

    base_failed: fewer than 10 words, or over a fifth of them in repeated 5-word windows. kept:
    not base_failed, log_ppl not below the band of its language, and log_mix not above: lines in
    another language that has a model are no fault. A band reaches `band` quartile distances from
    the median of the texts that do not fail, at least FLOOR and more for short texts. A null
    or empty text has no words, no log_ppl, and fails. Each language has a model and a band; texts
    of none have those of the texts beyond the `languages` most frequent languages. log_mix looks at
    the models of these, of the others together, and of the text's own language. Repeated rows
    are judged alike. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "text")
    named, texts, rare, sent = _prepared(rows, languages)
    texts = texts.withColumn("lang", named).withColumn("code", F.xxhash64("text"))

    def rate(batch, tables, _=None):
        rows = []
        columns = [batch.column(c).to_pylist() for c in ("doc_id", "lang", "code")]
        for doc_id, lang, code, text in zip(*columns, utf8(batch)):
            fit = perplexities(text, lang, tables)
            rows.append((doc_id, lang, *text_counts(text), len(text), *fit, code))
        return arrow_rows(rows, SCORED)

    return _inside_bands(_scored(texts, rare, sent, rate, SCORED), band)


def keep_good(docs: DataFrame, band: float = BAND, languages: int = LANGUAGES) -> DataFrame:
    """The rows of docs that judge keeps, with all their columns, of whatever names.

    The texts are scored once and written with what the bands need to know of them; once the
    bands are known, the written rows are filtered. Nulls, empty texts and repeated rows as in
    judge.
    """
    _, _, rare, sent = _prepared(docs.select("lang", "text"), languages)
    mark = unused(docs, "_score")[0]
    own = "lang string, n_words bigint, n_repeat_words bigint, n_bytes bigint, log_ppl double, log_mix double"
    schema = StructType([*docs.schema.fields, StructField(mark, StructType.fromDDL(own))])

    def rate(batch, tables, rare_lang=None):
        import pyarrow as pa

        has_model = tables[0].by_lang
        rows = []
        for lang, text in zip(batch.column("lang").to_pylist(), utf8(batch)):
            lang = str(lang) if str(lang) in has_model else OTHER
            lang = lang if rare_lang is None else rare_lang
            n_words, _, _, _, n_repeat = text_counts(text)
            rows.append((lang, n_words, n_repeat, len(text), *perplexities(text, lang, tables)))
        scores = arrow_rows(rows, own).to_struct_array()
        return pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, mark])

    scored = _scored(docs, rare, sent, rate, schema)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return _inside_bands(scored.select(row, f"{mark}.*"), band).filter("kept").select("row.*")
