"""Removal of repeated byte strings by sorted suffixes.

A byte goes when a string of LENGTH bytes that covers it also starts somewhere else. Only suffixes
at anchors are sorted: the k-gram with the smallest hash of every window of LENGTH bytes. Equal
windows have equal anchors at equal offsets, so all repeats of a window meet where its anchor's
hash is shared. Anchors of one hash and one digest of the bytes under all of their windows (their
context) are copies: all those bytes are repeated, and one of the copies stands for them where
other contexts share the hash. Only these, one per different context, are shipped with their bytes.
The texts right of the anchor are ordered deep-shallow (multikey quicksort to a shallow depth,
blind tries below it), and those left of it, read backwards, as well; common prefixes of the two
orders tell which windows occur twice. Where a hash has too many different contexts for one task,
digests of ever smaller blocks of their windows are counted instead.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import arrow_rows, documents, stored, utf8

LENGTH = 400
GRAM = 64
#: Suffixes are told apart by quicksort up to here, by blind tries beyond.
SHALLOW = 128
#: Different contexts of a hash that one task sorts (some 30 MB).
GROUP = 50_000
#: Groups of up to so many different contexts are resolved pair by pair, larger ones by distance.
PAIRED = 64
#: Periods up to here are looked for where anchors lie closer than usual.
PERIOD = 32
#: Windows of a hash with too many contexts are looked at in blocks of so many.
BLOCK_WIDTHS = (48, 8, 1)
NULL_ID = -(1 << 63)


# ---- anchors


def _sliding(a, width: int, pick):
    """pick (minimum or maximum) of every run of `width` values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        a = pick(a[:-step], a[step:])
        done += step
    return a


def gram_hashes(text: bytes, size: int):
    """A hash of the `size` bytes from every position; size is a power of two."""
    import numpy as np

    h = np.frombuffer(text, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    factor, done = 0x9E3779B97F4A7C15, 1
    while done < size:
        h = h[:-done] * np.uint64(factor) + h[done:]
        h ^= h >> np.uint64(31)
        factor = factor * factor % (1 << 64) | 1
        done *= 2
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def anchors(text: bytes, length: int = LENGTH):
    """(hash, position, left, back) arrays of the anchors of a text, and its periodic stretches.

    The windows that an anchor stands for start from `left` to `back` bytes before it. Inside a
    stretch of a short period, which covers itself (see periodic), only the anchors near its ends
    are needed by other texts.
    """
    import numpy as np

    if len(text) < length:
        return np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3, []
    gram = min(GRAM, 1 << (length.bit_length() - 2))
    h = gram_hashes(text, gram)
    width = length - gram + 1
    least = _sliding(h, width, np.minimum)  # of the window that starts here
    # the greatest of the least values of all windows around a gram: its own hash, if chosen
    around = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    at = np.flatnonzero(_sliding(around, width, np.maximum) == h)
    stretches = periodic(text, at, length) if len(at) > 64 else []
    if stretches:
        for start, end in stretches:
            at = at[(at < start + 2 * length) | (at > end - 2 * length)]
    # windows [lo, hi] in which no gram is smaller; least falls and rises around the anchor
    starts = at[:, None] - np.arange(width)[None, :] if len(at) < 4096 else None
    if starts is not None:
        inside = (starts >= 0) & (starts < len(least))
        own = inside & (least[np.clip(starts, 0, len(least) - 1)] == h[at][:, None])
        left = width - 1 - np.argmax(own[:, ::-1], axis=1)
        back = np.argmax(own, axis=1)
    else:
        left = np.minimum(at, width - 1)
        back = np.maximum(at - (len(least) - 1), 0)
    return h[at], at, left, back, stretches


def periodic(text: bytes, at, length: int = LENGTH) -> list[tuple[int, int]]:
    """Stretches [start, end) of a period up to PERIOD, long enough to repeat in themselves."""
    import numpy as np

    gaps = np.diff(at)
    periods = [p for p in range(1, PERIOD + 1) if np.count_nonzero(gaps == p) > 32]
    out = []
    a = np.frombuffer(text, dtype=np.uint8)
    for p in periods:
        same = np.concatenate([[False], a[p:] == a[:-p], [False]])
        turns = np.flatnonzero(same[1:] != same[:-1])
        for start, end in zip(turns[::2].tolist(), turns[1::2].tolist()):
            if end - start >= length + p:  # every window occurs a period on or back
                out.append((start, end + p))
    return out


# ---- deep-shallow suffix sorting


def common(a: bytes, b: bytes, at: int = 0) -> int:
    """Length of the common prefix, known to be at least `at`."""
    n = min(len(a), len(b))
    if a[at:n] == b[at:n]:
        return n
    low, high = at, n  # equal up to low, not up to high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class BlindTrie:
    """Orders strings that share a long prefix: nodes keep the depth and bytes where strings part,
    not the text between; an insertion compares with one string only."""

    def __init__(self, strings: list[bytes], depth: int):
        self.strings, self.depth, self.root = strings, depth, None

    def insert(self, k: int) -> None:
        s = self.strings[k]
        if self.root is None:
            self.root = [k]
            return
        node, path = self.root, []
        while isinstance(node, tuple):
            path.append(node)
            byte = s[node[0]] if node[0] < len(s) else -1
            node = node[1].get(byte) or next(iter(node[1].values()))
        other = self.strings[node[0]]
        depth = common(s, other, self.depth)
        if depth == len(s) == len(other):
            node.append(k)  # the same string
            return
        place = next((i for i, n in enumerate(path) if n[0] >= depth), len(path))
        key, old = (x[depth] if depth < len(x) else -1 for x in (s, other))
        if place < len(path) and path[place][0] == depth:
            path[place][1][key] = [k]
            return
        below = path[place] if place < len(path) else node
        made = (depth, {old: below, key: [k]})
        if place:
            above = path[place - 1]
            above[1][s[above[0]] if above[0] < len(s) else -1] = made
        else:
            self.root = made

    def order(self) -> list[int]:
        out, todo = [], [self.root]
        while todo:
            node = todo.pop()
            if isinstance(node, tuple):
                todo += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                out += node
        return out


def deep_shallow(strings: list[bytes], shallow: int = SHALLOW, word: int = 8) -> list[int]:
    """Indices in the order of the strings: multikey quicksort, eight bytes a key, then tries."""
    out: list[int] = []
    todo = [(list(range(len(strings))), 0)]
    while todo:
        group, depth = todo.pop()
        if len(group) < 2:
            out += group
        elif depth >= shallow:
            trie = BlindTrie(strings, depth)
            for k in group:
                trie.insert(k)
            out += trie.order()
        else:
            keys = {k: strings[k][depth : depth + word] for k in group}
            pivot = sorted(keys[k] for k in (group[0], group[len(group) // 2], group[-1]))[1]
            less = [k for k in group if keys[k] < pivot]
            same = [k for k in group if keys[k] == pivot]
            more = [k for k in group if keys[k] > pivot]
            todo.append((more, depth))
            if len(pivot) < word:  # all of these end here
                todo += [([k], depth) for k in reversed(same)]
            else:
                todo.append((same, depth + word))
            todo.append((less, depth))
    return out


def _steps(strings: list[bytes]):
    """(order, common prefix with the one before) of the sorted strings."""
    order = deep_shallow(strings)
    held = [strings[k] for k in order]
    return order, [0] + [common(x, y) for x, y in zip(held, held[1:])]


def group_repeats(members: list[tuple[bytes, int, int]], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """Per member (context, left, back) of one anchor hash: runs (least, greatest) of distances
    from the anchor at which windows start that another member has too."""
    import numpy as np

    known: dict[tuple[bytes, int, int], list[int]] = {}
    for k, m in enumerate(members):
        known.setdefault(m, []).append(k)
    out: list[list[tuple[int, int]]] = [[] for _ in members]
    distinct = list(known)
    if len(distinct) < 2:
        if len(members) > 1:
            _, left, back = distinct[0]
            out = [[(back, left)] for _ in members]
        return out
    rights = [c[left:] for c, left, _ in distinct]
    lefts = [c[:left][::-1] for c, left, _ in distinct]
    if len(distinct) == 2:
        (_, left0, back0), (_, left1, back1) = distinct
        low = max(back0, back1, length - common(*rights))
        high = min(left0, left1, common(*lefts))
        for m, held in known.items():
            if len(held) > 1:
                runs = [(m[2], m[1])]
            else:
                runs = [(low, high)] if low <= high else []
            for k in held:
                out[k] = runs
        return out
    n = len(distinct)
    ranks = []
    for strings in (rights, lefts):
        order, steps = _steps(strings)
        place = np.empty(n, dtype=np.int64)
        place[order] = np.arange(n)
        ranks.append((place, np.array(steps)))
    left, back = (np.array([m[i] for m in distinct]) for i in (1, 2))
    often = np.array([len(held) > 1 for held in known.values()])
    span = np.arange(int(back.min()), int(left.max()) + 1)
    if n <= PAIRED:
        twice = _by_pairs(ranks, left, back, span, length)
        twice |= often[:, None] & (back[:, None] <= span) & (span <= left[:, None])
    else:
        twice = np.zeros((n, len(span)), dtype=bool)
        (right_place, right_steps), (left_place, left_steps) = ranks
        for column, distance in enumerate(span):
            alike_right = np.cumsum(right_steps < length - distance)[right_place]
            alike_left = np.cumsum(left_steps < distance)[left_place]
            here = np.flatnonzero((back <= distance) & (distance <= left))
            keys = alike_right[here] * (n + 1) + alike_left[here]
            _, which, times = np.unique(keys, return_inverse=True, return_counts=True)
            twice[here, column] = (times[which] > 1) | often[here]
    for row, held in zip(twice, known.values()):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], row.view(np.int8), [0]])))
        runs = [(int(span[a]), int(span[b - 1])) for a, b in zip(edges[::2], edges[1::2])]
        for k in held:
            out[k] = runs
    return out


def _by_pairs(ranks, left, back, span, length: int):
    """Per member and distance, whether another one has the same window, from common prefixes:
    of two suffixes, the least step between their places in the order."""
    import numpy as np

    n = len(left)
    shared = []
    for place, steps in ranks:
        common_ = np.zeros((n, n), dtype=np.int64)
        for k in range(n - 1):
            common_[k, k + 1 :] = np.minimum.accumulate(steps[k + 1 :])
        common_ = np.maximum(common_, common_.T)
        shared.append(common_[np.ix_(place, place)])
    low = np.maximum(np.maximum(back[:, None], back[None, :]), length - shared[0])
    high = np.minimum(np.minimum(left[:, None], left[None, :]), shared[1])
    np.fill_diagonal(low, length)
    np.fill_diagonal(high, -1)
    one, other = np.nonzero(low <= high)
    turns = np.zeros((n, len(span) + 1), dtype=np.int32)
    np.add.at(turns, (one, low[one, other] - span[0]), 1)
    np.add.at(turns, (one, high[one, other] + 1 - span[0]), -1)
    return np.cumsum(turns, axis=1)[:, :-1] > 0


# ---- plan

ANCHORS = "h bigint, d bigint, id bigint, code bigint, place bigint"
CONTEXTS = "h bigint, id bigint, code bigint, pos bigint, left bigint, back bigint, context binary"
BLOCKS = "h bigint, id bigint, code bigint, place bigint, core binary, whole binary"
RUNS = "id bigint, code bigint, start bigint, end bigint"
REMOVED = (
    "doc_id bigint, code bigint, n_bytes bigint, n_removed bigint, n_spans bigint,"
    " kept_sha256 string, kept_bytes binary"
)


def _anchor_rows(texts: DataFrame, length: int) -> DataFrame:
    """place: position, left and back packed into one number; d: digest of the context, left and
    back. A periodic stretch has its start for h and its end, negated, for place."""

    def find(batches):
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh3_64_intdigest as digest

        for batch in batches:
            parts = []
            columns = batch.column("id").to_pylist(), batch.column("code").to_pylist()
            for i, code, text in zip(*columns, utf8(batch)):
                h, at, left, back, stretches = anchors(text, length)
                place = (at << 24) | (left << 12) | back
                cuts = ((at - left).tolist(), (at - back + length).tolist(), (place & 0xFFFFFF).tolist())
                d = np.array([digest(text[a:b], seed) for a, b, seed in zip(*cuts)], dtype=np.uint64)
                own = np.array(stretches, dtype=np.int64).reshape(-1, 2)
                h = np.concatenate([h.view(np.int64), own[:, 0]])
                d = np.concatenate([d.view(np.int64), np.zeros(len(own), np.int64)])
                place = np.concatenate([place, -own[:, 1]])
                parts.append((h, d, np.full(len(h), i), np.full(len(h), code), place))
            if parts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts)],
                    names=["h", "d", "id", "code", "place"],
                )

    return texts.mapInArrow(find, ANCHORS)


def _placed(batch):
    """(id, code, text, [(hash, position, left, back)]) of joined rows."""
    names = ("id", "code", "hashes", "places")
    columns = [batch.column(c).to_pylist() for c in names]
    for i, code, hashes, places, text in zip(*columns, utf8(batch)):
        found = [(h, p >> 24, p >> 12 & 4095, p & 4095) for h, p in zip(hashes, places)]
        yield i, code, text, found


def _contexts(joined: DataFrame, length: int) -> DataFrame:
    def cut(batches):
        for batch in batches:
            rows = []
            for i, code, text, found in _placed(batch):
                for h, pos, left, back in found:
                    context = text[pos - left : pos - back + length]
                    rows.append((h, i, code, pos, left, back, context))
                if len(rows) > 8192:
                    yield arrow_rows(rows, CONTEXTS)
                    rows = []
            yield arrow_rows(rows, CONTEXTS)

    return joined.mapInArrow(cut, CONTEXTS)


def _group_runs(contexts: DataFrame, length: int) -> DataFrame:
    def sort(batches):
        rows: list[tuple] = []
        key, held = None, []

        def runs():
            found = group_repeats([m[3:] for m in held], length)
            for (i, code, pos, *_), own in zip(held, found):
                for low, high in own:
                    rows.append((i, code, pos - high, pos - low + length))

        names = ("h", "id", "code", "pos", "context", "left", "back")
        for batch in batches:
            for h, *member in zip(*(batch.column(c).to_pylist() for c in names)):
                if h != key:
                    runs()
                    key, held = h, []
                held.append(tuple(member))
            if len(rows) > 8192:
                yield arrow_rows(rows, RUNS)
                rows.clear()
        runs()
        yield arrow_rows(rows, RUNS)

    return contexts.repartition("h").sortWithinPartitions("h").mapInArrow(sort, RUNS)


def _block_rows(hot: DataFrame, length: int, width: int) -> DataFrame:
    """A row per context and block of `width` distances, which start at multiples of it.

    whole: digest of the bytes under all of the anchor's windows in the block, and of their
    distances; core: digest of those that every window of the block covers, or of the anchor hash
    where there are none, and of the block's place. Equal windows are at equal distances.
    """

    def cut(batches):
        for batch in batches:
            rows = []
            for i, code, text, found in _placed(batch):
                for h, pos, left, back in found:
                    for low in range(back - back % width, left + 1, width):
                        far, near = min(left, low + width - 1), max(back, low)
                        core = text[pos - low : max(pos - low - width + 1 + length, 0)]
                        core = core or h.to_bytes(8, "little", signed=True)
                        whole = text[pos - far : pos - near + length]
                        digests = [
                            hashlib.blake2b(x, digest_size=16, salt=b"%d %d" % at).digest()
                            for x, at in ((core, (low, width)), (whole, (far, near)))
                        ]
                        rows.append((h, i, code, pos << 24 | far << 12 | near, *digests))
                if len(rows) > 8192:
                    yield arrow_rows(rows, BLOCKS)
                    rows = []
            yield arrow_rows(rows, BLOCKS)

    return hot.mapInArrow(cut, BLOCKS)


def _block_runs(contexts: DataFrame, length: int) -> DataFrame:
    """Runs of contexts whose hash has too many for one task, by ever smaller blocks of windows.

    Contexts differ, but their windows need not. Where a block's whole stretch occurs again, all of
    its windows do. One of each different stretch goes on to smaller blocks, if its core occurs in
    another stretch as well, so only stretches that differ near their ends reach single windows.
    The contexts are stored once and cut like texts, each named by its hash and digest.
    """
    contexts = stored(
        contexts.withColumn("name", F.xxhash64("context", "left", "back")), "contexts"
    )
    texts = contexts.select(
        F.col("h").alias("id"), F.col("name").alias("code"), F.col("context").alias("text")
    ).dropDuplicates(["id", "code"])
    place = F.expr("left << 24 | left << 12 | back")  # the anchor is `left` bytes into its context
    hot = contexts.select("h", F.col("h").alias("id"), F.col("name").alias("code"), place.alias("place"))
    runs = None
    for width in BLOCK_WIDTHS:
        rows = stored(_block_rows(_with_text(texts, hot), length, width), "blocks")
        # one row per different stretch; map-side combined
        first = [F.first(c).alias(c) for c in ("h", "id", "code", "place")]
        wholes = rows.groupBy("core", "whole").agg(F.count("*").alias("k"), *first)
        wholes = stored(wholes, "stretches")
        again = rows.join(wholes.filter("k > 1").select("whole").distinct(), "whole")
        pos, far, near = (F.expr(x) for x in ("place >> 24", "place >> 12 & 4095", "place & 4095"))
        own = again.select(
            "id", "code", (pos - far).alias("start"), (pos - near + length).alias("end")
        )
        runs = own if runs is None else runs.unionByName(own)
        if width < length:
            shared = wholes.groupBy("core").agg(F.count("*").alias("kinds")).filter("kinds > 1")
            wholes = wholes.join(shared.select("core"), "core")
        hot = wholes.select("h", "id", "code", "place")
    runs = runs.select(F.col("id").alias("h"), F.col("code").alias("name"), "start", "end").distinct()
    from_text = F.col("pos") - F.col("left")
    return contexts.join(runs, ["h", "name"]).select(
        "id", "code", (F.col("start") + from_text).alias("start"), (F.col("end") + from_text).alias("end")
    )


def _with_text(texts: DataFrame, found: DataFrame) -> DataFrame:
    """The texts that have anchors in `found`, with the anchors' places and hashes."""
    per_text = (
        found.groupBy("id", "code")
        .agg(F.sort_array(F.collect_set(F.struct("place", "h"))).alias("a"))
        .select("id", "code", F.col("a.h").alias("hashes"), F.col("a.place").alias("places"))
    )
    return texts.join(per_text, ["id", "code"])


def repeated_runs(texts: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """(id, code, start, end): bytes covered by repeated strings; runs may overlap.

    Hashes of up to `group` different contexts are sorted, each in one task; others go by blocks.
    The anchors are joined by sorting at every size, so a hot hash can be split between tasks.
    """
    rows = stored(_anchor_rows(texts, length), "anchors")
    found = rows.filter("place >= 0")
    often = found.groupBy("h").agg(
        F.count("*").alias("k"), (F.min("d") != F.max("d")).alias("mixed")
    )
    often = often.filter("k > 1").select("h", "mixed")
    shared = stored(found.join(often.hint("merge"), "h"), "shared")
    first = F.min(F.struct("id", "code", "place")).alias("m")
    classes = shared.filter("mixed").groupBy("h", "d").agg(F.count("*").alias("k"), first)
    classes = stored(classes.select("h", "d", "k", "m.*"), "classes")
    copied = classes.filter("k > 1").select("h", "d").hint("merge")
    copies = shared.filter("not mixed").unionByName(
        shared.filter("mixed").join(copied, ["h", "d"], "left_semi")
    )
    pos, left, back = (F.expr(x) for x in ("place >> 24", "place >> 12 & 4095", "place & 4095"))
    runs = copies.select(
        "id", "code", (pos - left).alias("start"), (pos - back + length).alias("end")
    )
    sizes = classes.groupBy("h").agg(F.count("*").alias("n"))
    greatest = sizes.agg(F.max("n")).first()[0] or 0
    cold = classes
    if greatest > group:
        # at most one hash per `group` contexts
        hot = stored(sizes.filter(F.col("n") > group).select("h"), "hot")
        cold = classes.join(hot, "h", "left_anti")
        hot = classes.join(hot, "h", "left_semi")
        runs = runs.unionByName(_block_runs(_contexts(_with_text(texts, hot), length), length))
    runs = runs.unionByName(_group_runs(_contexts(_with_text(texts, cold), length), length))
    stretches = rows.filter("place < 0")
    return runs.unionByName(
        stretches.select("id", "code", F.col("h").alias("start"), (-F.col("place")).alias("end"))
    )


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, with_bytes: bool = True, group: int = GROUP
) -> DataFrame:
    """doc_id, code, n_bytes, n_removed, n_spans, kept_sha256 and kept_bytes per row of docs.

    Every text is UTF-8 bytes, null is empty; matches do not cross texts. Bytes go if a string
    of `length` bytes over them starts anywhere else in the table as given. Rows that repeat a
    document are repeats of each other; other rows that share a doc_id are judged by their own
    text. Texts shorter than `length` stay as they are; so does an empty table. Other columns
    are not read. kept_bytes is null unless with_bytes.
    """
    texts = documents(docs).select(
        F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"), "text", F.xxhash64("text").alias("code")
    )
    runs = repeated_runs(texts, length, group)
    per_text = runs.groupBy("id", "code").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("a")
    )
    per_text = per_text.select(
        "id", "code", F.col("a.start").alias("starts"), F.col("a.end").alias("ends")
    )

    def cut(batches):
        for batch in batches:
            rows = []
            names = ("id", "code", "starts", "ends")
            columns = [batch.column(c).to_pylist() for c in names]
            for i, code, starts, ends, text in zip(*columns, utf8(batch)):
                spans = merged(list(zip(starts or (), ends or ())))
                kept, at = [], 0
                for start, end in spans:
                    kept.append(text[at:start])
                    at = end
                whole = b"".join([*kept, text[at:]])
                digest = hashlib.sha256(whole).hexdigest()
                counts = len(text), len(text) - len(whole), len(spans), digest
                rows.append((None if i == NULL_ID else i, code, *counts, whole if with_bytes else None))
            yield arrow_rows(rows, REMOVED)

    return texts.join(per_text, ["id", "code"], "left").mapInArrow(cut, REMOVED)


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal spans of sorted runs."""
    out: list[list[int]] = []
    for start, end in runs:
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]
