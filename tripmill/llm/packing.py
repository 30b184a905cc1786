"""Packing of token sequences: bounded-space online best fit.

Every partition keeps a fixed number of open windows. A document's rest (what is left after its
whole windows) goes into the open window that it fills best; when none has room, the fullest is
topped up with the head of the rest, if its gap is worth a cut, and emitted. The windows that
are open at the end of a partition are merged with those of a few neighbouring partitions.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
import zlib
from array import array

import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tripmill.llm.common import arrow_rows, documents, stored

END_ID = 2
SEQ_LEN = 4096
OPEN_WINDOWS = 32
#: A gap of at most so many tokens is left as padding rather than filled by a cut.
SLACK = 16
#: Partitions whose open windows are merged by one task: at most 8 x 32 windows of 16 KB.
MERGED = 8

PIECE = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,"
    " sequence_id bigint, offset bigint, ids binary"
)
_PARTS = PIECE + ", open_group bigint, window int"

# The steps of the vocabulary file for which the short way below holds.
_NORMALIZER = ["NFC", "Replace", "Lowercase"]
_END = b"\xff"
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PATTERN = regex.compile(_SPLIT)


class Ids:
    """Token ids of texts, equal to tokenizers' encode(text, add_special_tokens=False).

    If the file splits texts at white space and lower-cases them, words are looked up in a
    bounded cache, and only new words are merged. Texts with special tokens or
    with characters whose normalisation differs between libraries are encoded whole.
    """

    # beyond Latin letters and general punctuation, or with separators of Python's alone
    UNUSUAL = re.compile("[^\x00-\x1b\x20-ɏ‐-‧‰-⁞]")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = (spec.get("normalizer") or {}).get("normalizers", [])
        splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        self.short = (
            [s["type"] for s in steps] == _NORMALIZER
            and splits[0].get("pattern") == {"Regex": _SPLIT}
            and bool(splits[0].get("invert"))
        )
        self.special = [t["content"] for t in spec["added_tokens"]]
        if self.short:
            self.words = WordIds(spec["model"]["vocab"])

    def batch(self, texts: list[str]) -> list:
        """One array of unsigned 32-bit ids per text."""
        import numpy as np

        if not self.short:
            found = self.whole.encode_batch(texts, add_special_tokens=False)
            return [np.array(e.ids, dtype="<u4") for e in found]
        out: list = [None] * len(texts)
        for k, text in enumerate(texts):
            if self.UNUSUAL.search(text) or any(s in text for s in self.special):
                ids = self.whole.encode(text, add_special_tokens=False).ids
                out[k] = np.array(ids, dtype="<u4")
            else:
                found = b"".join(map(self.words.__getitem__, text.lower().split()))
                out[k] = np.frombuffer(found, dtype="<u4")
        return out


class WordIds(dict):
    """Ids of lower-case words as little-endian bytes, merged when first asked for."""

    LIMIT = 800_000

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self.merge = _merger(vocabulary)

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.LIMIT:
            self.clear()
        parts = (word,) if word.isalpha() else _PATTERN.findall(word)
        merge = self.merge
        self[word] = ids = array("I", [i for p in parts for i in merge(p.encode() + _END)]).tobytes()
        return ids


def _merger(vocabulary: dict[str, int]):
    """Merges a word's bytes by the vocabulary's ranks; the word end is a byte UTF-8 never has.

    The library merges by pairs, this by what a pair spells. Both give the same ids (tests), and
    this takes a quarter of the time.
    """
    import tiktoken

    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}
    ranks = {}
    for token, i in vocabulary.items():
        ends = token.endswith("</w>") and token != "</w>"
        spelled = bytes(byte[c] for c in (token[:-4] if ends else token))
        ranks[spelled + _END * ends] = i
    encoding = tiktoken.Encoding(
        "words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={}
    )
    return encoding._core_bpe.encode_single_piece


@functools.cache
def _tokenizer(path: str) -> Ids:
    return Ids(path)


class OpenWindows:
    """A fixed number of windows that are being filled; emit gets each full one."""

    def __init__(self, size: int, number: int, slack: int, emit):
        self.size, self.number, self.slack, self.emit = size, number, slack, emit
        self.fills: list[int] = []
        self.windows: list[list[tuple]] = []

    def place(self, doc, start: int, length: int) -> None:
        while length:
            if length >= self.size:
                self.emit([(doc, start, self.size)])
                start, length = start + self.size, length - self.size
                continue
            room = self.size - length
            best = max((f for f in self.fills if f <= room), default=None)
            if best is not None:
                k = self.fills.index(best)
                self.windows[k].append((doc, start, length))
                self.fills[k] += length
                return
            if len(self.fills) < self.number:
                self.fills.append(length)
                self.windows.append([(doc, start, length)])
                return
            k = self.fills.index(max(self.fills))
            gap = self.size - self.fills[k]
            if gap > self.slack:
                self.windows[k].append((doc, start, gap))
                start, length = start + gap, length - gap
            self.emit(self.windows[k])
            del self.fills[k], self.windows[k]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    seq_len: int = SEQ_LEN,
    end_id: int = END_ID,
    open_windows: int = OPEN_WINDOWS,
    slack: int = SLACK,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    A document is the ids of its text and then end_id, so a null or empty text has one id. Every
    id lies in one piece; a sequence's pieces lie without gaps from offset 0. All sequences are
    meant to be padded to seq_len, but for the last ones of a merge, which are cut at powers of
    two and need no padding. Repeated rows are packed once each; a null doc_id stays null. ids
    are little-endian unsigned 32-bit, null unless with_ids.

    One pass over the texts; the windows open at a partition's end (at most open_windows) are
    merged in groups of MERGED partitions, so no task sees more than a few MB of them.
    """

    def pack_partition(batches):
        import numpy as np

        part = TaskContext.get().partitionId()
        ids_of = _tokenizer(tokenizer_path)
        rows: list[tuple] = []
        count = itertools.count()

        def write(pieces, group=None):
            number = next(count)
            at = 0
            for (doc_id, ids), start, length in pieces:
                own = ids[start : start + length].tobytes()
                rows.append(
                    (doc_id, start, length, zlib.crc32(own), len(ids))
                    + ((part << 33) + number, at)
                    + (own if with_ids or group is not None else None, group, number)
                )
                at += length

        def flush():
            out = arrow_rows(rows, _PARTS)
            rows.clear()
            return out

        windows = OpenWindows(seq_len, open_windows, slack, write)
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            texts = batch.column("text").to_pylist()
            for at in range(0, len(texts), 256):
                found = ids_of.batch(texts[at : at + 256])
                for doc_id, ids in zip(doc_ids[at : at + 256], found):
                    ids = np.append(ids, np.array([end_id], dtype="<u4"))
                    windows.place((doc_id, ids), 0, len(ids))
                if len(rows) > 4096:
                    yield flush()
        for pieces in windows.windows:
            write(pieces, part // MERGED)
        yield flush()

    def merge(key, pdf):
        import numpy as np
        import pandas as pd

        pdf = pdf.sort_values(["sequence_id", "offset"], kind="stable")
        left = int(pdf["length"].sum())
        rows, at, number, room = [], 0, 0, 0
        base = (1 << 62) + (int(key[0]) << 24)
        for doc_id, start, length, total, ids in zip(
            pdf["doc_id"], pdf["start"], pdf["length"], pdf["doc_tokens"], pdf["ids"]
        ):
            ids = np.frombuffer(ids, dtype="<u4")
            done = 0
            while done < length:
                if not room:  # the next sequence: whole, or the largest power of two that is left
                    room = seq_len if left >= seq_len else 1 << (left.bit_length() - 1)
                    left, at, number = left - room, 0, number + 1
                n = min(room, length - done)
                own = ids[done : done + n].tobytes()
                rows.append(
                    (doc_id, start + done, n, zlib.crc32(own), total, base + number, at)
                    + (own if with_ids else None,)
                )
                at, room, done = at + n, room - n, done + n
        out = pd.DataFrame(rows, columns=[f.split()[0] for f in PIECE.split(", ")])
        return out.astype({"doc_id": "Int64"})

    parts = stored(documents(docs).mapInArrow(pack_partition, _PARTS), "packing")
    whole = parts.filter("open_group is null").drop("open_group", "window")
    left = parts.filter("open_group is not null")
    merged = left.groupBy("open_group").applyInPandas(merge, PIECE)
    return whole.unionByName(merged)
