"""Secret scan: fixed patterns, and formats learned by grammar inference.

Credentials that the fixed patterns find are labelled examples. Per kind, a prefix tree of a
bounded sample of them is generalised by merging states whose futures are statistically
compatible (the ALERGIA scheme); the result is a probabilistic automaton over character classes.
Every token that could be a credential and is not all found by them is scored by the likelihood of its format under the
automata against that of ordinary tokens, and added as kind "format" above a threshold.
"""

from __future__ import annotations

import hashlib
import math
import re
from functools import lru_cache, partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import LOWER, arrow_rows, documents, stored, utf8

# The base kinds in the order of the report, their patterns and least lengths.
KINDS = ("assign", "access", "hex", "format")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}

#: Tokens that may be credentials, of the least length of the base kinds; the likelihood decides.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{8,}")
#: Tokens known to be no credential, by kind: words, numbers, and paths or hosts of both. A token
#: is of the first kind that matches all of it. No other unlabelled token is learned from, as it may
#: be a credential that the fixed patterns do not know.
_SEP, _WORD = "[+/_.=-]", "(?:[A-Z]?[a-z]{1,24}(?:[A-Z][a-z]{2,24}){0,4}|[A-Z]{1,24})"
_PART = f"(?:{_WORD}[0-9]{{0,3}}|[0-9]{{1,8}})"
ORDINARY = {
    "": re.compile(f"{_SEP}*{_WORD}(?:{_SEP}+{_WORD})*{_SEP}*"),
    "number": re.compile(f"{_SEP}*[0-9]{{1,20}}(?:{_SEP}+[0-9]{{1,20}})*{_SEP}*"),
    "path": re.compile(f"{_SEP}*{_PART}(?:{_SEP}+{_PART})+{_SEP}*"),
}
#: Labelled credentials of each kind, and ordinary tokens, that automata are fitted to.
SAMPLE = 500
#: Confidence of the compatibility test of two states.
ALPHA = 0.05
#: A format counts from this log-likelihood ratio per character on.
THRESHOLD = 0.5
#: Characters of an example that are learned; formats repeat within fewer. Scores read whole tokens.
SCORED = 256

_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_HEX_RUN = bytes(0x78 if chr(b) in "0123456789abcdef" else 0x20 for b in range(256))
_LONG_RUN = bytes(
    0x78 if b < 128 and (chr(b).isalnum() or chr(b) in "+/_.=-") else 0x20 for b in range(256)
)


def base_spans(text: str, raw: bytes) -> list[tuple[int, str, int, str]]:
    """(start, kind, end, credential) of the base kinds; raw is the text in UTF-8, a gate."""
    found = []
    if (b"=" in raw or b":" in raw) and any(w in (low := raw.translate(LOWER)) for w in _WORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST["assign"]:
                found.append((m.start(), "assign", m.end(), m[2]))
    if b"AKIA" in raw:
        for m in ACCESS.finditer(text):
            if len(m[0]) >= LEAST["access"]:
                found.append((m.start(), "access", m.end(), m[0]))
    if b"x" * LEAST["hex"] in raw.translate(_HEX_RUN):
        for m in HEX.finditer(text):
            if len(m[0]) >= LEAST["hex"]:
                found.append((m.start(), "hex", m.end(), m[0]))
    return found


def candidates(text: str, raw: bytes) -> list[tuple[int, int]]:
    """Spans of tokens with the characters and least length of a credential."""
    if b"x" * LEAST["assign"] not in raw.translate(_LONG_RUN):
        return []
    spans = ((m.start(), m.end(), m[0]) for m in CANDIDATE.finditer(text))
    return [(a, b) for a, b, token in spans if token.strip("+/_.=-")]


def ordinary_kind(token: str) -> str | None:
    """The kind of ordinary token that this one is known to be, if any."""
    return next((kind for kind, shape in ORDINARY.items() if shape.fullmatch(token)), None)


def symbols(token: str) -> str:
    """Character classes: 0 digit, a hex letter, l other letter, A and L in upper case, or itself."""
    return token.translate(_CLASSES)


_CLASSES = {
    **{ord(c): "0" for c in "0123456789"},
    **{c: "a" if c <= ord("f") else "l" for c in range(ord("a"), ord("z") + 1)},
    **{c: "A" if c <= ord("F") else "L" for c in range(ord("A"), ord("Z") + 1)},
}
#: Digits, two kinds of letters in two cases, and + / _ . = -, and the end of the token.
ALPHABET = 12
END = "$"


class Automaton:
    """Probabilistic deterministic automaton: per state, counts and targets by symbol."""

    def __init__(self, strings: list[str]):
        self.counts: list[dict[str, int]] = [{}]
        self.next: list[dict[str, int]] = [{}]
        for s in strings:
            state = 0
            for c in s:
                self.counts[state][c] = self.counts[state].get(c, 0) + 1
                if c not in self.next[state]:
                    self.next[state][c] = len(self.next)
                    self.counts.append({})
                    self.next.append({})
                state = self.next[state][c]
            self.counts[state][END] = self.counts[state].get(END, 0) + 1

    def merge_compatible(self, alpha: float = ALPHA) -> Automaton:
        """Red-blue merging in breadth-first order: each new state folds into the first red one
        whose futures do not differ by more than the Hoeffding bound, or becomes red itself."""
        red, blue = [0], sorted((t, 0, c) for c, t in self.next[0].items())
        while blue:
            state, parent, symbol = blue.pop(0)
            for other in red:
                if self._compatible(other, state, alpha):
                    self.next[parent][symbol] = other
                    self._fold(other, state)
                    break
            else:
                red.append(state)
            known = set(red)
            blue = sorted(
                {(t, r, c) for r in red for c, t in self.next[r].items() if t not in known}
            )
        return self

    def _compatible(self, a: int, b: int, alpha: float) -> bool:
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            m, n = sum(self.counts[a].values()), sum(self.counts[b].values())
            if m and n:
                bound = math.sqrt(0.5 * math.log(2 / alpha)) * (m**-0.5 + n**-0.5)
                for c in self.counts[a].keys() | self.counts[b].keys():
                    if abs(self.counts[a].get(c, 0) / m - self.counts[b].get(c, 0) / n) > bound:
                        return False
            pairs += [(self.next[a][c], t) for c, t in self.next[b].items() if c in self.next[a]]
        return True

    def _fold(self, a: int, b: int) -> None:
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            for c, n in self.counts[b].items():
                self.counts[a][c] = self.counts[a].get(c, 0) + n
            for c, t in self.next[b].items():
                if c in self.next[a]:
                    pairs.append((self.next[a][c], t))
                else:
                    self.next[a][c] = t

    def table(self) -> list[dict[str, tuple[float, int]]]:
        """Per reachable state: symbol to (smoothed log-probability, next state)."""
        order, place = [0], {0: 0}
        for state in order:
            for t in self.next[state].values():
                if t not in place:
                    place[t] = len(order)
                    order.append(t)
        out = []
        for state in order:
            total = sum(self.counts[state].values()) + 0.1 * ALPHABET
            out.append(
                {
                    c: (math.log((n + 0.1) / total), place.get(self.next[state].get(c), 0))
                    for c, n in self.counts[state].items()
                }
                | {"": (math.log(0.1 / total), 0)}  # a symbol never seen in this state
            )
        return out


def log_likelihood(table: list[dict], string: str) -> float:
    """Of a whole string of symbols with its end."""
    state, out = 0, 0.0
    for c in string + END:
        row = table[state]
        p, state = row.get(c) or row[""]
        out += p
    return out


def learn(examples: dict[str, list[str]]) -> dict[str, list]:
    """One automaton table per kind of examples; those of ORDINARY hold ordinary tokens."""
    return {
        kind: Automaton([symbols(x) for x in sorted(own)]).merge_compatible().table()
        for kind, own in sorted(examples.items())
    }


def format_score(tables: dict[str, list], token: str) -> float:
    """Greatest log-likelihood ratio per character of a learned format to ordinary tokens."""
    return symbols_score(tables, symbols(token))


def symbols_score(tables: dict[str, list], s: str) -> float:
    own = [log_likelihood(t, s) for k, t in tables.items() if k in ORDINARY]
    plain = max(own, default=(len(s) + 1) * -math.log(ALPHABET))
    best = max((log_likelihood(t, s) for k, t in tables.items() if k not in ORDINARY), default=-math.inf)
    return (best - plain) / (len(s) + 1)


def scorer(tables: dict[str, list]):
    """format_score of tokens; most tokens are words, which share few strings of symbols."""
    short = lru_cache(1 << 16)(partial(symbols_score, tables))

    def score(token: str) -> float:
        s = symbols(token)
        return short(s) if len(s) <= 32 else symbols_score(tables, s)

    return score if tables else None


EXAMPLES = "kind string, bin bigint, h bigint, token string"
SPANS = (
    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string,"
    " spans string, code bigint"
)


def labelled(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(kind, token): at most `sample` different tokens per base kind and kind of ordinary token.

    Which ones is decided by their hash alone, so it does not depend on order or partitions: the
    least hash of each of `sample` bins. A task sends on its own least ones, a few thousand rows
    however long its texts are.
    """

    def find(batches):
        best: dict[tuple[str, int], tuple[int, str]] = {}
        for batch in batches:
            rows = set()
            for raw in utf8(batch):
                text = raw.decode("utf-8", "replace")
                base = base_spans(text, raw)
                rows |= {(kind, token[:SCORED]) for _, kind, _, token in base}
                for a, b in candidates(text, raw):
                    if (kind := ordinary_kind(text[a:b])) is not None:
                        if not any(a < y and x < b for x, _, y, _ in base):
                            rows.add((kind, text[a:b][:SCORED]))
            for kind, token in rows:
                digest = hashlib.blake2b(token.encode("utf-8", "replace"), digest_size=15).digest()
                at = kind, int.from_bytes(digest[8:], "little") % sample
                own = int.from_bytes(digest[:8], "little", signed=True), token
                if at not in best or own < best[at]:
                    best[at] = own
        yield arrow_rows([(k, b, h, t) for (k, b), (h, t) in sorted(best.items())], EXAMPLES)

    tokens = docs.mapInArrow(find, EXAMPLES)
    least = F.min(F.struct("h", "token")).alias("x")
    return tokens.groupBy("kind", "bin").agg(least).select("kind", "x.token")


def scan(docs: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and code per row of docs.

    spans: kind:start:end of all spans by start, then kind, in code points, end exclusive. base
    spans are those of the fixed patterns and stay; a "format" span may reach beyond one, where
    more of its token scores or is glued to a run of the access or hex pattern. Null and empty texts have no spans; tables without any credential learn nothing and add nothing; repeated rows are scanned alike; other columns are not read. code is a hash of the text.

    The sample (at most 6 x `sample` tokens) is learned from on the driver, once.
    """
    texts = documents(docs).withColumn("code", F.xxhash64("text"))
    tables = learned(texts.select("text"), sample)

    def scan_batches(batches):
        score = scorer(tables)
        for batch in batches:
            rows = []
            ids, codes = batch.column("doc_id").to_pylist(), batch.column("code").to_pylist()
            for doc_id, code, raw in zip(ids, codes, utf8(batch)):
                rows.append((doc_id, *_report(raw, score, threshold), code))
            yield arrow_rows(rows, SPANS)

    return texts.mapInArrow(scan_batches, SPANS)


def learned(texts: DataFrame, sample: int = SAMPLE) -> dict[str, list]:
    """Automata of the credentials in texts; none without any credential."""
    examples: dict[str, list[str]] = {}
    for kind, token in stored(labelled(texts, sample), "credentials").collect():
        examples.setdefault(kind, []).append(token)
    return learn(examples) if any(examples) else {}


def redact_documents(
    docs: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD, mark: str = "[secret]"
) -> DataFrame:
    """docs with every span that scan reports replaced by a mark, and n_chars of the new text.

    Null texts stay null; all other columns stay as they are.
    """
    tables = learned(docs.select("text"), sample)

    def redact_batches(batches):
        import pyarrow as pa

        score = scorer(tables)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for k, text in enumerate(texts):
                if text:
                    spans = _report(text.encode("utf-8", "replace"), score, threshold)[-1]
                    texts[k] = redact(text, spans, mark) if spans else text
            columns = {"text": texts, "n_chars": [None if t is None else len(t) for t in texts]}
            arrays = [
                pa.array(columns[f.name], f.type) if f.name in columns else batch.column(f.name)
                for f in batch.schema
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return docs.mapInArrow(redact_batches, docs.schema)


def _report(raw: bytes, score, threshold: float) -> tuple:
    text = raw.decode("utf-8", "replace")
    base = base_spans(text, raw)
    found = [(a, KINDS.index(kind), b) for a, kind, b, _ in base]
    added = set()
    for a, b in candidates(text, raw) if score or found else []:
        touched = [(x, k, y) for x, k, y in found if a < y and x < b]
        if any(x <= a and b <= y for x, _, y in touched):
            continue
        if score and score(text[a:b]) >= threshold:
            added.add((a, 3, b))
            continue
        # letters and digits that an access or hex run is glued to belong to it
        for x, k, y in touched:
            low, high = x, y
            while k and low > a and text[low - 1].isalnum():
                low -= 1
            while k and high < b and text[high].isalnum():
                high += 1
            if (low, high) != (x, y):
                added.add((low, 3, high))
    n = [sum(k == kind for _, k, _ in found) for kind in range(3)]
    return *n, hashlib.sha256(_join(found).encode()).hexdigest(), _join([*found, *added])


def _join(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def redact(text: str, spans: str, mark: str = "[secret]") -> str:
    """The text with every span of a report replaced by a mark; overlapping spans as one."""
    cuts: list[list[int]] = []
    for span in filter(None, spans.split(",")):
        _, a, b = span.split(":")
        if cuts and int(a) < cuts[-1][1]:
            cuts[-1][1] = max(cuts[-1][1], int(b))
        else:
            cuts.append([int(a), int(b)])
    out, at = [], 0
    for a, b in cuts:
        out += [text[at:a], mark]
        at = b
    return "".join([*out, text[at:]])
