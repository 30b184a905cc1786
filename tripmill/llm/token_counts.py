"""Token counts under a unigram vocabulary by dynamic programming shared over a trie.

The distinct words of a batch are put into a trie. Walking it, the best score of every prefix is
computed once, whatever number of words share it, and each word's token count is kept at its
terminal. A text's count is the sum over its words.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import DataFrame

from tripmill.llm.common import arrow_rows, documents, utf8

#: Words whose counts a task remembers from one batch to the next.
REMEMBERED = 500_000
#: Longer words are counted whole as well, but not remembered.
LONG = 4096
MARK = "▁"


class Vocabulary:
    """Pieces with log-probabilities by rank (Zipf's law with offset 2.7), and a byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        own = range(model.get_piece_size())
        plain = [i for i in own if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.scores = {model.id_to_piece(i): -math.log(k + 2.7) for k, i in enumerate(plain)}
        self.longest = max(map(len, self.scores), default=1)
        # a character without a piece: a token a byte, each less likely than any piece
        self.byte = -math.log(len(self.scores) + 2.7) - 1.0

    def character(self, c: str) -> tuple[float, int]:
        n = len(c.encode("utf-8", "surrogatepass"))
        return n * self.byte, n


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def count_words(words: list[str], v: Vocabulary) -> dict[str, int]:
    """Tokens of the likeliest segmentation of each word, the fewest among equals.

    Sorted words are the trie in depth-first order: the states of the prefix that a word shares
    with the one before it are still on the stack.
    """
    scores, longest = v.scores, v.longest
    best, tokens = [0.0], [0]
    last = ""
    out = {}
    for word in sorted(words):
        n, shared = len(word), 0
        limit = min(n, len(last))
        while shared < limit and word[shared] == last[shared]:
            shared += 1
        del best[shared + 1 :], tokens[shared + 1 :]
        for end in range(shared + 1, n + 1):
            top, least = -math.inf, 0
            for start in range(max(0, end - longest), end):
                p = scores.get(word[start:end])
                if p is not None:
                    p += best[start]
                    if p > top or (p == top and tokens[start] + 1 < least):
                        top, least = p, tokens[start] + 1
            if word[end - 1] not in scores:
                p, k = v.character(word[end - 1])
                p += best[end - 1]
                if p > top or (p == top and tokens[end - 1] + k < least):
                    top, least = p, tokens[end - 1] + k
            best.append(top)
            tokens.append(least)
        out[word] = tokens[n]
        last = word
    return out


COUNTED = "doc_id bigint, code bigint, n_bytes bigint, n_words bigint, n_tokens bigint"


def count_tokens(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """(doc_id, code, n_bytes, n_words, n_tokens) per row of docs; code is a hash of the text.

    Words are what ASCII white space separates, each with the word mark before it. Null and empty
    texts have no words and no tokens; repeated rows are counted alike; other columns are not
    read. A task remembers a bounded number of words.
    """
    from pyspark.sql import functions as F

    def count(batches):
        v = vocabulary(vocabulary_path)
        known: dict[str, int] = {}
        for batch in batches:
            ids, codes = batch.column("doc_id").to_pylist(), batch.column("code").to_pylist()
            rows = []
            raw = utf8(batch)
            for at in range(0, len(raw), 500):
                split = [(len(b), _words(b)) for b in raw[at : at + 500]]
                if len(known) > REMEMBERED:
                    known.clear()
                new = {w for _, words in split for w in words if w not in known}
                known.update(count_words(list(new), v))
                for i, code, (size, words) in zip(ids[at : at + 500], codes[at : at + 500], split):
                    rows.append((i, code, size, len(words), sum(map(known.__getitem__, words))))
                for word in [w for w in new if len(w) > LONG]:
                    del known[word]
            yield arrow_rows(rows, COUNTED)

    texts = documents(docs).withColumn("code", F.xxhash64("text"))
    return texts.mapInArrow(count, COUNTED)


def _words(text: bytes) -> list[str]:
    return [MARK + word.decode("utf-8", "replace") for word in text.split()]
