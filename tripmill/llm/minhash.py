"""MinHash near-duplicates: universal hash minima in bands, verified, and connected components.

Exact copies are folded first. Every other text gets BANDS x ROWS minima of universal hashes of
its shingles; texts that share a band are joined to the smallest of the band, which costs a row
per text and band however large the band is. The components of these candidate links are small
groups; inside a group signatures rule out pairs, and full sets confirm links until the group's
components are known, so a group never turns into all of its pairs. Large groups are cut into
blocks, and every two blocks meet in a task of bounded size.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import LOWER, arrow_rows, documents, stored, unused, utf8

SHINGLE = 5
#: A pair at the threshold shares a band but for (1 - 0.75^5)^40 = 2e-5 of the cases.
BANDS, ROWS = 40, 5
#: 100 * intersection >= SIMILAR * union.
SIMILAR = 75
#: Documents and shingles of a group that one task compares; more are cut into blocks.
BLOCK_DOCS, BLOCK_SHINGLES = 2048, 2_000_000
#: Minima of the signatures that rule out pairs; a linked pair falls below RULED_OUT in 1e-7 cases.
CHECKS, RULED_OUT = 128, 0.55
NULL_ID = -(1 << 63)

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


class _Powers:
    """Powers of _BASE and of its inverse modulo 2^64, as far as the longest text so far."""

    up = down = None

    @classmethod
    def upto(cls, n: int):
        import numpy as np

        if cls.up is None or len(cls.up) < n:
            size = max(n, 1 << 16)
            inverse = pow(_BASE, -1, 1 << 64)
            cls.up, cls.down = (np.full(size, b, dtype=np.uint64) for b in (_BASE, inverse))
            for powers in (cls.up, cls.down):
                powers[0] = 1
                np.multiply.accumulate(powers, out=powers)
        return cls.up, cls.down


def _mix(x):
    import numpy as np

    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def shingles(text: bytes, size: int = SHINGLE) -> tuple[bytes, object]:
    """(normal form, sorted distinct 64-bit shingle hashes) of UTF-8 text."""
    import numpy as np

    words = text.translate(LOWER).split()
    joined = b" ".join(words)
    if not words:
        return joined, np.zeros(0, dtype=np.uint64)
    a = np.frombuffer(joined, dtype=np.uint8)
    up, down = _Powers.upto(len(a) + 1)
    sums = np.zeros(len(a) + 1, dtype=np.uint64)
    np.cumsum((a.astype(np.uint64) + np.uint64(1)) * up[: len(a)], out=sums[1:])
    blanks = np.flatnonzero(a == 32)
    starts = np.concatenate([[0], blanks + 1])
    ends = np.concatenate([blanks, [len(a)]])
    n = max(len(words) - size + 1, 1)
    first, last = starts[:n], ends[min(size, len(words)) - 1 :]
    return joined, np.unique(_mix((sums[last] - sums[first]) * down[first]))


def _universal(number: int):
    """Multipliers and offsets of `number` fixed universal hashes."""
    import numpy as np

    made = [hashlib.blake2b(b"%d" % k, digest_size=16).digest() for k in range(number)]
    pairs = np.frombuffer(b"".join(made), dtype="<u8").reshape(number, 2)
    return pairs[:, 0] | np.uint64(1), pairs[:, 1]


def minima(sets: list, number: int):
    """Minima of `number` hashes over each set of a list of non-empty sets: sets x number."""
    import numpy as np

    a, b = _universal(number)
    out = np.empty((len(sets), number), dtype=np.uint64)
    at = 0
    while at < len(sets):
        end, total = at, 0  # as many sets as stay in the cache
        while end < len(sets) and (end == at or total + len(sets[end]) <= 32_768):
            total += len(sets[end])
            end += 1
        flat = np.concatenate(sets[at:end])
        offsets = np.cumsum([0] + [len(s) for s in sets[at : end - 1]])
        held = np.empty_like(flat)
        for j in range(number):
            np.multiply(flat, a[j], out=held)
            np.add(held, b[j], out=held)
            out[at:end, j] = np.minimum.reduceat(held, offsets)
        at = end
    return out


def band_keys(signatures, bands: int, rows: int):
    """A 64-bit key per set and band; equal keys mean equal minima in that band."""
    import numpy as np

    parts = signatures.reshape(len(signatures), bands, rows)
    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(rows):
        keys = _mix(keys * np.uint64(_BASE) + parts[:, :, r])
    return keys.astype(np.int64)


SIGNED = "id bigint, code bigint, digest binary, n_shingles bigint, bands array<bigint>"


def _signed(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    def sign(batches):
        import pyarrow as pa

        for batch in batches:
            found = [shingles(text) for text in utf8(batch)]
            full = [s for _, s in found if len(s)]
            keys = iter(band_keys(minima(full, bands * rows), bands, rows))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("code"),
                    pa.array([hashlib.blake2b(j, digest_size=16).digest() for j, _ in found]),
                    pa.array([len(s) for _, s in found], pa.int64()),
                    pa.array([next(keys) if len(s) else None for _, s in found], pa.list_(pa.int64())),
                ],
                names=["id", "code", "digest", "n_shingles", "bands"],
            )

    return docs.mapInArrow(sign, SIGNED)


# ---- connected components


def connected_components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, component) of all nodes of edges (a, b); a component is named by its least node.

    Alternates large-star (larger neighbours to the least of the neighbourhood) and small-star
    (smaller neighbours and oneself to the least), until every edge ends at a root. A round
    shuffles the edges twice; minima are combined before shuffling, so a hub of many edges costs
    a row per task, and its join is one that adaptive execution can split.
    """
    now = stored(_falling(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))), "edges")
    mark = _mark(now)
    for _ in range(rounds):
        if not mark[0]:
            break
        now = stored(_small_star(_large_star(now)), "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components are not stable after {rounds} rounds")
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def _falling(edges: DataFrame) -> DataFrame:
    """Edges as (u, v) with u > v, each once."""
    return edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


# ---- verification


class Union:
    """Disjoint sets of 0 .. n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def group_links(sets: list, sides: list[int] | None = None, similar: int = SIMILAR):
    """Pairs of indices, enough to connect all sets of a group that links connect.

    sides: with 0 and 1, only pairs across are looked at. Pairs are tried by falling similarity
    of signatures and only while their ends are not connected.
    """
    import numpy as np

    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    signatures = minima(sets, CHECKS).astype(np.uint32)
    union = Union(n)
    side = np.zeros(n, dtype=np.int8) if sides is None else np.array(sides, dtype=np.int8)
    for i in range(n - 1):
        rest = np.arange(i + 1, n)
        if sides is not None:
            rest = rest[side[rest] != side[i]]
        small, large = np.minimum(sizes[rest], sizes[i]), np.maximum(sizes[rest], sizes[i])
        rest = rest[100 * small >= similar * large]
        if not len(rest):
            continue
        alike = (signatures[rest] == signatures[i]).mean(axis=1)
        for j in rest[np.argsort(-alike, kind="stable")[: np.count_nonzero(alike >= RULED_OUT)]]:
            if union.find(i) == union.find(int(j)):
                continue
            both = np.intersect1d(sets[i], sets[j], assume_unique=True).size
            if 100 * both >= similar * (sizes[i] + sizes[j] - both):
                union.join(i, int(j))
                yield i, int(j)


LINKS = "a bigint, b bigint"


def _verified(members: DataFrame) -> DataFrame:
    """Links (a, b) inside groups: rows (component, one, two, block, id, code, text), in any order.

    Texts that share an id are members of their own; links name ids.
    """

    def verify(batches):
        import numpy as np

        key, held = None, {}

        def links():
            own = sorted(held)
            sides = None if key[1] == key[2] else [int(held[m][0] == key[2]) for m in own]
            found = group_links([held[m][1] for m in own], sides)
            return [(own[i][0], own[j][0]) for i, j in found if own[i][0] != own[j][0]]

        out: list[tuple] = []
        for batch in batches:
            names = ("component", "one", "two", "block", "id", "code")
            columns = [batch.column(c).to_pylist() for c in names]
            for *own, block, i, code, text in zip(*columns, utf8(batch)):
                if own != key:
                    if key is not None:
                        out += links()
                    key, held = own, {}
                held[i, code] = block, shingles(text)[1]
            if len(out) > 4096:
                yield arrow_rows(out, LINKS)
                out = []
        if key is not None:
            out += links()
        yield arrow_rows(out, LINKS)

    group = ["component", "one", "two"]
    return members.repartition(*group).sortWithinPartitions(*group).mapInArrow(verify, LINKS)


def near_duplicates(
    docs: DataFrame,
    bands: int = BANDS,
    rows: int = ROWS,
    block_docs: int = BLOCK_DOCS,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """(doc_id, code, n_shingles, component_id, kept) per row of docs; code is a hash of the text.

    Texts without words are linked with nothing. Rows that share a doc_id count as one document,
    linked with whatever any of its rows is linked with; a null doc_id counts as the least one.
    An empty table gives an empty result. Other columns are not read.
    """
    texts = documents(docs).select(
        F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"), "text", F.xxhash64("text").alias("code")
    )
    signed = stored(_signed(texts, bands, rows), "signed")
    full = signed.filter("n_shingles > 0")
    folded = full.groupBy("digest").agg(
        F.min(F.struct("id", "code")).alias("first"),
        F.first("n_shingles").alias("n"),
        F.first("bands").alias("bands"),
    )
    folded = folded.select("digest", "first.id", "first.code", "n", "bands")
    singles = stored(folded, "singles")

    # a row per text and band; each joins the least id of its band
    buckets = singles.select("id", F.explode("bands").alias("key"))
    heads = buckets.groupBy("key").agg(F.min("id").alias("a"), F.count("*").alias("k"))
    near = buckets.join(heads.filter("k > 1").select("key", "a"), "key").filter("id <> a")
    groups = stored(
        connected_components(near.select("a", F.col("id").alias("b")).distinct()), "groups"
    ).withColumnRenamed("node", "id")

    sized = groups.join(singles.select("id", "code", "n"), "id")
    totals = sized.groupBy("component").agg(F.count("*").alias("docs"), F.sum("n").alias("total"))
    blocks = F.greatest(
        F.ceil(F.col("docs") / block_docs), F.ceil(F.col("total") / block_shingles)
    ).cast("int")
    placed = sized.join(totals.select("component", blocks.alias("blocks")), "component")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    meets = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = placed.select("id", "code", "component", "block", meets).select(
        "id", "code", "component", "block",
        F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
    )
    links = stored(_verified(pairs.join(texts, ["id", "code"])), "links")

    # rows that share an id but not their text
    owners = full.select("id", "digest").join(
        singles.select("digest", F.col("id").alias("least")), "digest"
    )
    owners = stored(owners.distinct(), "owners")
    shared = owners.groupBy("id").agg(F.min("least").alias("a"), F.max("least").alias("z"))
    several = shared.filter("a <> z").select("id", "a")
    same_id = owners.join(several, "id").filter("least <> a").select("a", F.col("least").alias("b"))
    components = connected_components(links.unionByName(same_id))

    least = owners.groupBy("id").agg(F.min("least").alias("node"))
    named = least.join(components, "node", "left").select(
        "id", F.coalesce("component", "node").alias("component")
    )
    result = signed.select("id", "code", "n_shingles").join(named, "id", "left")
    component = F.coalesce("component", "id")
    return result.select(
        F.nullif("id", F.lit(NULL_ID)).alias("doc_id"),
        "code",
        "n_shingles",
        F.nullif(component, F.lit(NULL_ID)).alias("component_id"),
        (component == F.col("id")).alias("kept"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """docs with one row of every group of near duplicates, the one with the least doc_id.

    Of rows that share that doc_id too, one stays: the one of the least text hash, any of equals.
    """
    found = stored(near_duplicates(docs), "near")
    firsts = found.filter("kept").groupBy("doc_id").agg(
        F.min("code").alias("code"), F.count("*").alias("copies")
    )
    # docs may have columns of any name
    own, code, copies = unused(docs, "_id", "_code", "_copies")
    firsts = firsts.select(
        F.col("doc_id").alias(own), F.col("code").alias(code), F.col("copies").alias(copies)
    )
    met = F.col("doc_id").eqNullSafe(F.col(own)) & (
        F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(code)
    )
    rows = docs.join(firsts, met)
    once = rows.filter(F.col(copies) == 1).drop(own, code, copies)
    again = rows.filter(F.col(copies) > 1).dropDuplicates([own]).drop(own, code, copies)
    return once.unionByName(again)
