"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into overlapping chunks of CHUNK bytes that cover all of it, the last one filled up
with zeros. Bytes become learned vectors; FILTERS learned filters of WIDTH bytes slide over a chunk
in steps of STEP, and the largest response of each (not below zero) describes the chunk. A hidden
layer reads a chunk's responses; its mean over all chunks and its largest values in any chunk give
one probability. A chunk that repeats itself has few different windows and so low maxima.

The network is fitted in one task by Adam to a bounded sample: of each label the SAMPLE labelled
documents with the least key hash, and SHOWN chunks of each, evenly spread over the whole text.
Scoring reads every chunk of every text, a few hundred at a time.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import arrow_rows, documents, utf8

CHUNK, OVERLAP, WIDTH, STEP = 512, 64, 8, 2
EMBED, FILTERS, HIDDEN = 8, 32, 16
#: Labelled documents of each label that the network is fitted to, and chunks of each.
SAMPLE, SHOWN = 1500, 8
#: A small sample is gone through more often, until STEPS batches have been learned from.
EPOCHS, STEPS, BATCH, RATE, DECAY = 10, 600, 32, 3e-3, 1e-4
HELD_OUT = 5
THRESHOLD = 0.3
#: Chunks that are scored at once.
SLAB = 256

SCORES = "doc_id bigint, score double"
PARTS = "doc_id bigint, quality int, k int, part binary"
SHAPES = {
    "embed": (256, EMBED),
    "filters": (WIDTH * EMBED, FILTERS),
    "filter_bias": (FILTERS,),
    "hidden": (FILTERS, HIDDEN),
    "hidden_bias": (HIDDEN,),
    "mean_out": (HIDDEN,),
    "max_out": (HIDDEN,),
    "bias": (1,),
}


# ---- the network


def starts(length: int) -> range:
    """Where overlapping chunks begin that cover a whole text; a short one has one chunk."""
    return range(0, max(1, length - OVERLAP), CHUNK - OVERLAP)


def chunks(text: bytes) -> Iterator[bytes]:
    return (text[at : at + CHUNK] for at in starts(len(text)))


def _matrix(parts: list[bytes]):
    import numpy as np

    filled = b"".join(p.ljust(CHUNK, b"\0") for p in parts)
    return np.frombuffer(filled, np.uint8).reshape(-1, CHUNK)


def initial(seed: int = 7) -> dict:
    import numpy as np

    rng = np.random.default_rng(seed)
    scale = {"embed": 0.5, "filters": (WIDTH * EMBED) ** -0.5, "hidden": FILTERS**-0.5}
    return {
        name: (rng.standard_normal(shape) * scale.get(name, 0.0 if "bias" in name else 0.25)).astype(np.float32)
        for name, shape in SHAPES.items()
    }


def responses(net: dict, matrix, places: bool = False):
    """The largest response of each filter per chunk, and where it stands.

    Windows that start WIDTH bytes apart do not overlap, so each of the WIDTH / STEP phases is a
    plain matrix product over the bytes' vectors as they lie in memory.
    """
    import numpy as np

    vectors = net["embed"][matrix].reshape(len(matrix), CHUNK * EMBED)
    best, where = None, None
    for start in range(0, WIDTH, STEP):
        count = (CHUNK - start) // WIDTH
        phase = vectors[:, start * EMBED : (start + count * WIDTH) * EMBED]
        found = phase.reshape(len(matrix), count, WIDTH * EMBED) @ net["filters"]
        top = found.max(axis=1)
        if places:
            at = found.argmax(axis=1) * WIDTH + start
            where = at if best is None else np.where(top > best, at, where)
        best = top if best is None else np.maximum(best, top)
    return np.maximum(best + net["filter_bias"], 0), where


def hidden(net: dict, pooled):
    import numpy as np

    return np.maximum(pooled @ net["hidden"] + net["hidden_bias"], 0)


def probability(logit):
    import numpy as np

    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def fit(texts: list[list[bytes]], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> dict:
    """Weights from documents, each a list of its chunks. Both labels weigh the same."""
    import numpy as np

    net, rng = initial(seed), np.random.default_rng(seed)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.items()}
    y = np.array(labels, dtype=np.float32)
    ones = y.mean() if len(y) else 0
    if not 0 < ones < 1:  # nothing to tell apart: the same score for every text
        net["mean_out"][:], net["max_out"][:] = 0, 0
        net["bias"][:] = 0 if not len(y) else 30 if ones else -30
        return net
    weight = np.where(y == 1, 0.5 / ones, 0.5 / (1 - ones)).astype(np.float32)
    steps, epochs = 0, max(epochs, -(-STEPS * BATCH // len(texts)))
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            owner = np.repeat(np.arange(len(rows)), [len(texts[i]) for i in rows])
            matrix = _matrix([c for i in rows for c in texts[i]])
            slopes = _slopes(net, matrix, owner, y[rows], weight[rows])
            steps += 1
            rate = RATE * (1 - epoch / epochs)
            for name, slope in slopes.items():
                if name in ("filters", "hidden"):
                    slope += DECAY * net[name]
                first, second = moments[name]
                first += 0.1 * (slope - first)
                second += 0.001 * (slope * slope - second)
                net[name] -= rate * (first / (1 - 0.9**steps)) / (np.sqrt(second / (1 - 0.999**steps)) + 1e-8)
    return net


def _slopes(net: dict, matrix, owner, y, weight) -> dict:
    """Gradients of the weighted log loss over one batch."""
    import numpy as np

    n = len(y)
    pooled, where = responses(net, matrix, places=True)
    units = hidden(net, pooled)
    size = np.bincount(owner, minlength=n).astype(np.float32)
    mean = np.zeros((n, HIDDEN), units.dtype)
    np.add.at(mean, owner, units)
    mean /= size[:, None]
    most = np.zeros((n, HIDDEN), units.dtype)  # units are not below zero
    np.maximum.at(most, owner, units)
    logit = mean @ net["mean_out"] + most @ net["max_out"] + net["bias"][0]
    error = (probability(logit) - y) * weight / n
    # the first chunk that holds a document's largest value gets its slope
    flat = np.flatnonzero(units == most[owner])
    owners, unit = owner[flat // HIDDEN], flat % HIDDEN
    _, first = np.unique(owners * HIDDEN + unit, return_index=True)
    d_units = (error / size)[owner][:, None] * net["mean_out"]
    chunk = flat[first] // HIDDEN
    d_units[chunk, unit[first]] += error[owner[chunk]] * net["max_out"][unit[first]]
    d_units[units <= 0] = 0
    d_pooled = d_units @ net["hidden"].T
    d_pooled[pooled <= 0] = 0
    # only the window of each maximum has a slope
    at = where[:, :, None] + np.arange(WIDTH)
    seen = matrix[np.arange(len(matrix))[:, None, None], at]
    vectors = net["embed"][seen].reshape(len(matrix), FILTERS, WIDTH * EMBED)
    d_filters = np.einsum("cfw,cf->wf", vectors, d_pooled)
    d_vectors = d_pooled[:, :, None] * net["filters"].T
    d_embed = np.zeros_like(net["embed"])
    np.add.at(d_embed, seen.reshape(-1), d_vectors.reshape(-1, EMBED))
    return {
        "embed": d_embed,
        "filters": d_filters,
        "filter_bias": d_pooled.sum(axis=0),
        "hidden": pooled.T @ d_units,
        "hidden_bias": d_units.sum(axis=0),
        "mean_out": mean.T @ error,
        "max_out": most.T @ error,
        "bias": np.array([error.sum()]),
    }


def score_texts(net: dict, texts: list[bytes]) -> list[float]:
    """One probability per text, from all of its chunks."""
    import numpy as np

    total = np.zeros((len(texts), HIDDEN))
    most = np.zeros((len(texts), HIDDEN))
    size = np.zeros(len(texts))
    parts: list[bytes] = []
    owner: list[int] = []

    def read():
        units = hidden(net, responses(net, _matrix(parts))[0])
        np.add.at(total, owner, units)
        np.maximum.at(most, owner, units)
        np.add.at(size, owner, 1)
        parts.clear()
        owner.clear()

    for i, text in enumerate(texts):
        for part in chunks(text):
            parts.append(part)
            owner.append(i)
            if len(parts) == SLAB:
                read()
    if parts:
        read()
    logit = (total / size[:, None]) @ net["mean_out"] + most @ net["max_out"] + net["bias"][0]
    # sums of a slab may differ in their last bits with what else is in it
    return probability(logit).round(6).tolist()


# ---- plan


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from the fit: one in five, by the crc32 of its id as text."""
    text = F.coalesce(doc_id.cast("bigint").cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % HELD_OUT == 0


def shown(text: bytes) -> list[bytes]:
    """The chunks that a text is learned from: at most SHOWN, evenly spread over all of it."""
    every = starts(len(text))
    few = range(min(SHOWN, len(every)))
    places = [every[k * (len(every) - 1) // max(1, len(few) - 1)] for k in few]
    return [text[at : at + CHUNK] for at in places]


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS) -> dict:
    """The network, fitted now to at most `sample` documents of each quality label.

    Held-out documents are never taken. A label that is null is none; of several labels of one
    document the least counts, of several texts the least in byte order. Of more documents those
    with the least hashes of their ids are taken, so the sample does not depend on partitioning.
    The task that fits holds at most 2 x sample x SHOWN chunks, 12 MB by default.
    """
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    least = [
        known.filter(F.col("quality") == quality).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        for quality in (0, 1)
    ]
    chosen = F.broadcast(least[0].unionByName(least[1]))  # at most 2 x sample rows

    def cut(batches):
        for batch in batches:
            ids, quality = (batch.column(c).to_pylist() for c in ("doc_id", "quality"))
            rows = [
                (i, q, k, part)
                for i, q, text in zip(ids, quality, utf8(batch))
                for k, part in enumerate(shown(text))
            ]
            yield arrow_rows(rows, PARTS)

    def fitted(frames):
        import numpy as np
        import pandas as pd

        held = list(frames)
        if not held:
            return
        rows = pd.concat(held).sort_values(["doc_id", "k"], kind="stable")
        groups = [(g["quality"].iloc[0], list(g["part"])) for _, g in rows.groupby("doc_id")]
        net = fit([[bytes(p) for p in parts] for _, parts in groups], [int(q) for q, _ in groups], epochs)
        blob = io.BytesIO()
        np.savez(blob, **net)
        yield pd.DataFrame({"net": [blob.getvalue()]})

    texts = documents(docs).join(chosen, "doc_id")
    texts = texts.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    parts = texts.mapInArrow(cut, PARTS).repartition(1)
    return _loaded(parts.mapInPandas(fitted, "net binary").collect())


def _loaded(rows: list) -> dict:
    import numpy as np

    if not rows:
        return fit([], [])
    with np.load(io.BytesIO(bytes(rows[0]["net"]))) as stored:
        return {name: stored[name] for name in SHAPES}


def score(docs: DataFrame, net: dict) -> DataFrame:
    """(doc_id, score) per row of docs: the probability of label 1 from the whole text."""

    def rate(batches):
        for batch in batches:
            scores = score_texts(net, utf8(batch))
            yield arrow_rows(list(zip(batch.column("doc_id").to_pylist(), scores)), SCORES)

    return documents(docs).mapInArrow(rate, SCORES)


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if score >= 0.3) per row of docs.

    Only the text is read for a score. A null or empty text is one chunk of zeros and has the
    score of that; long texts are read whole, a slab of chunks at a time. Equal texts have equal
    scores, to six decimals. Rows without doc_id are scored and held out. An
    empty table gives no rows; without labels of both kinds every text has the same score (0.5
    without any). Other columns are not read.
    """
    scored = score(docs, train(docs, labels, sample, epochs))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
