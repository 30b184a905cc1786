"""Operators over documents against brute-force versions, with nulls, ties and repeated rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmill.llm import decontam, licenses, minhash, packing, quality, secrets, suffixes
from tripmill.llm.queries import tokenizer_file

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SCHEMA = "doc_id bigint, text string, lang string, code string, at int"


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def texts():
    rng = random.Random(5)
    pool = [" ".join(rng.choice("ab cd é fg Éx the of".split()) + str(rng.randint(0, 30))
                     for _ in range(60)) for _ in range(4)]
    made = []
    for i in range(60):
        words = " ".join(rng.choice(pool).split()[rng.randint(0, 5) : rng.randint(6, 60)]
                         + ["w%d" % rng.randint(0, 99) for _ in range(rng.randint(0, 30))]).split()
        made.append((i, " ".join(words)))
    base = made[0][1]
    return made + [(7, base), (100, base), (100, base), (101, None), (None, ""), (None, base),
                   (102, "one two"), (103, "ONE two"), (104, "a " * 300), (105, "x" * 700),
                   (106, "ab" * 400 + base), (107, base + " " + pool[1] * 3)]


@pytest.fixture(scope="module")
def rows():
    return texts()


@pytest.fixture(scope="module")
def docs(spark, rows):
    # code and at are names that the operators use inside
    return spark.createDataFrame([(i, t, "en", "x", 1) for i, t in rows], SCHEMA)


def same(found, expected):
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


def test_packing_keeps_every_id_once(docs, rows):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    own = Tokenizer.from_file(path)
    found = packing.pack(docs, path, seq_len=64, open_windows=3).collect()
    ids = [own.encode(t or "", add_special_tokens=False).ids + [2] for _, t in rows]
    assert sum(r.length for r in found) == sum(map(len, ids))
    by_doc = collections.defaultdict(list)
    for r in found:
        own_ids = [int.from_bytes(r.ids[k : k + 4], "little") for k in range(0, len(r.ids), 4)]
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(own_ids) == r.length
        by_doc[r.doc_id].append((r.start, own_ids))
    once = {i for i, n in collections.Counter(i for i, _ in rows).items() if n == 1}
    for (i, _), expected in zip(rows, ids):
        if i in once:
            assert [x for _, part in sorted(by_doc[i]) for x in part] == expected
    sequences = collections.defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
        padding += 0 if at & (at - 1) == 0 else 64 - at
    assert padding <= 16 * len(sequences)


def test_token_ids_equal_the_library():
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    hard = ["It's don't we'll 'S ''s x'sy 12ab _a_b İx ΑΣ ſt ﬁ é na\xa0x\x1cy \x85 <|endoftext|> ª²",
            "", " ", "日本語 🙂", "can't'll ŉ ǅ"]
    rng = random.Random(2)
    hard += ["".join(rng.choice("aeinorst") for _ in range(rng.randint(1, 20))) for _ in range(2000)]
    library = Tokenizer.from_file(path).encode_batch(hard, add_special_tokens=False)
    assert [a.tolist() for a in packing.Ids(path).batch(hard)] == [e.ids for e in library]


def test_decontamination(spark, docs, rows):
    items = [(1, rows[0][1]), (2, "one two"), (3, rows[3][1].upper()), (4, None), (5, "!!"), (6, "É x")]
    windows = collections.defaultdict(set)
    for i, t in items:
        w = WORD.findall(lower(t))
        n = min(10, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[a : a + n])].add(i)
    expected = []
    for i, t in rows:
        w, hit, named = WORD.findall(lower(t)), set(), set()
        for n in {len(k) for k in windows}:
            for a in range(len(w) - n + 1):
                if tuple(w[a : a + n]) in windows:
                    hit |= set(range(a, a + n))
                    named |= windows[tuple(w[a : a + n])]
        digest = hashlib.sha256(",".join(sorted(map(str, named))).encode()).hexdigest()
        expected.append((i, len(w), len(hit), len(named), digest, bool(hit)))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    same(decontam.decontaminate(docs, bench).drop("code", "items").collect(), expected)
    assert decontam.drop_contaminated(docs, bench).count() == sum(not e[-1] for e in expected)


def test_large_benchmark_takes_the_shuffled_way(spark, docs, rows, monkeypatch):
    bench = spark.createDataFrame([(1, rows[0][1])], "item_id bigint, text string")
    few = decontam.decontaminate(docs, bench).collect()
    left = decontam.drop_contaminated(docs, bench).count()
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    same(decontam.decontaminate(docs, bench).collect(), list(map(tuple, few)))
    assert decontam.drop_contaminated(docs, bench).count() == left


def test_decontamination_of_odd_benchmarks(spark):
    run = [f"word{i}" for i in range(30)]
    texts = [(1, " ".join(run)), (1, "other words"), (None, "Alpha beta"), (2, ""), (3, None), (4, "alpha")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").withColumn("items", F.lit("x"))

    def report(items):
        bench = spark.createDataFrame(items, "item_id bigint, text string")
        rows = decontam.decontaminate(docs, bench).collect()
        return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r["items"]) for r in rows)

    clean = [("1", 2, 0, 0, []), ("1", 30, 0, 0, []), ("2", 0, 0, 0, []), ("3", 0, 0, 0, []),
             ("4", 1, 0, 0, []), ("None", 2, 0, 0, [])]
    assert report([]) == clean
    # a null item counts and is not listed; repeated ones count once; many share one passage
    shared = [(i, " ".join(run[5:20])) for i in (7, 7, 8, 9, None)] + [(7, "ALPHA! beta")]
    assert report(shared) == [("1", 2, 0, 0, []), ("1", 30, 15, 4, ["7", "8", "9"]), *clean[2:5],
                              ("None", 2, 2, 1, ["7"])]


def test_a_shared_fingerprint_alone_is_no_hit(spark):
    # the window's least 5-gram is kept, its other words are changed
    bench = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(10)))], "item_id bigint, text string")
    near = []
    for a in range(6):
        words = [f"w{i}" if a <= i < a + 5 else f"other{i}" for i in range(10)]
        near.append((a, " ".join(words)))
    docs = spark.createDataFrame(near, "doc_id bigint, text string")
    found = decontam.benchmark_windows(bench)
    assert found.count() == 1
    assert decontam.fingerprint_hits(docs, found, 10, 5).count() > 0
    assert decontam.decontaminate(docs, bench).filter("contaminated").count() == 0


def test_licenses(spark):
    rows = [(1, "x MIT License, mit-license mit license"), (2, None), (3, ""),
            (4, "Licensed under the Apache License, Version 2.0."), (5, "Licensed under CC BY-NC 4.0."),
            (6, "GNU General\nPublic License v3"), (7, "a plain text")]
    found = {r.doc_id: r for r in licenses.scan(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    r = found[1]
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (7, 3, 1, 5, "mit")
    assert (found[2].n_words, found[2].n_base, found[2].first_word, found[2].score) == (0, 0, None, 0)
    assert found[4].labels == "apache,apache-2.0" and found[5].labels == "cc-by-nc-4.0"
    assert found[6].base_labels == "gpl" and "gpl-3" in found[6].labels and found[7].labels == ""
    assert len(licenses.rules()) > 300


def example(pattern):
    """A text that a rule's pattern matches: first branches, no optional parts."""
    from re import _parser

    def words(parsed):
        out = []
        for op, arg in parsed:
            name = str(op)
            if name == "LITERAL":
                out.append(chr(arg))
            elif name == "NOT_LITERAL":
                out.append("x")
            elif name == "BRANCH":
                out.append(words(arg[1][0]))
            elif name == "SUBPATTERN":
                out.append(words(arg[3]))
            elif name == "MAX_REPEAT":
                out.append(words(arg[2]) * arg[0])
            elif name == "IN":
                out.append(chr(arg[0][1]) if str(arg[0][0]) == "LITERAL" else "x")
        return "".join(out)

    return words(_parser.parse(pattern))


def test_every_license_rule_is_reached_through_the_prefilter(monkeypatch):
    rules = licenses.rules()
    samples = [example(r.pattern.pattern.decode()) + " " for r in rules]
    rng = random.Random(2)
    pool = [w for s in samples for w in s.split()]
    mixed = [" " + " ".join(rng.choice(pool) for _ in range(400)) + " " for _ in range(40)]
    for rule, sample in zip(rules, samples):
        assert rule.pattern.search(sample.encode()) and rule in licenses.candidates(sample.encode())
    every = [t.encode() for t in samples + mixed + [" ".join(rng.sample(samples, 30))]]
    gated = [licenses.detections(t) for t in every]
    assert all(gated[: len(samples)])
    monkeypatch.setattr(licenses, "candidates", lambda text: rules)
    assert gated == [licenses.detections(t) for t in every]


def test_license_names_without_the_word_license(spark):
    want = {"released under apache 2.0": "apache-2.0", "distributed under the boost software 1.0": "bsl-1.0",
            "published under openrail": "openrail", "artistic 2.0": "artistic-2.0", "under osl 3.0": "osl-3.0",
            "available under bsd 3 clause": "bsd-3-clause", "mozilla public 2.0": "mpl-2.0", "GPLv3": "gpl-3",
            "LGPLv2.1+": "lgpl-2.1", "gpl3": "gpl-3", "mit dem Zug": ""}
    rows = [(None if i == 3 else i, t, "x", "y") for i, t in enumerate(want)] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, labels string, spans string")
    found = licenses.scan(docs).collect()
    held = collections.Counter((r.doc_id, r.labels) for r in found)
    assert held == {(None if i == 3 else i, x): 2 for i, x in enumerate(want.values())}


def test_license_base_columns_equal_brute_force(spark):
    rng = random.Random(4)
    pool = "mit apache general public license License LICENSE the é x1 gpl".split()
    rows = [(i, "".join(rng.choice(pool) + rng.choice([" ", " ", "-", "\n", "__"])
                        for _ in range(rng.choice([0, 5, 300])))) for i in range(60)]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    for r, (_, text) in zip(sorted(found), rows):
        words = WORD.findall(lower(text))
        places = sorted((a, label) for phrase, label in licenses.BASE.items() for a in range(len(words))
                        if words[a : a + len(phrase.split())] == phrase.split())
        labels = sorted({label for _, label in places})
        ends = (places[0][0], places[-1][0]) if places else (None, None)
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(places), *ends)
        assert r.base_labels == ",".join(labels) and set(labels) <= set(r.labels.split(",") if r.labels else [])


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    windows = collections.defaultdict(list)
    for a in range(len(words) - 4):
        windows[tuple(words[a : a + 5])].append(a)
    often = {a + j for at in windows.values() if len(at) > 1 for a in at for j in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(often)


def test_quality_counts_and_verdicts(spark, docs, rows):
    for text in [t for _, t in rows] + ["é b\x0bc # a\n\n\na\n a\na", "a b c d e a b c d e f"]:
        assert quality.text_counts((text or "").encode()) == brute_counts(text)
    found = quality.judge(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)
    assert quality.keep_good(docs).count() == sum(r.kept for r in found)


def test_kneser_ney_sums_to_one():
    import numpy as np

    rng = np.random.default_rng(1)
    grams = np.unique(rng.integers(0, 32**4, 3000) % 90000)
    model = quality.fit_kneser_ney(grams, rng.integers(1, 9, len(grams)))
    table = np.exp(quality.expand(model).astype(float)).reshape(-1, 32)
    assert np.allclose(table.sum(axis=1), 1, atol=1e-3)


def test_kneser_ney_over_all_bytes_equals_a_model_by_dictionary():
    """Sums, back-off and interpolation of unfolded 5-grams, against plain recursion."""
    texts = [b"the cat sat.", b"THE Cat, the c\xc3\xa0t", b"", b"\x00\x01 a", b"the the the cat #%$ 0189"]
    counts = collections.Counter()
    for t in texts:
        counts.update(quality._keys(t).tolist())
        assert len(quality._keys(t)) == len(t)
    padded = [b"\xff" * 4 + t for t in texts]
    level = {5: collections.Counter(p[a : a + 5] for p in padded for a in range(len(p) - 4))}
    assert counts == {int.from_bytes(g, "big"): n for g, n in level[5].items()}  # no two bytes alike
    for k in range(4, 0, -1):
        level[k] = collections.Counter(g[1:] for g, n in level[k + 1].items() if n)
        level[k].update({g[:-1]: 0 for g in level[k + 1]})
    level[1].update({bytes([b]): 0 for b in range(256)})
    discount = {k: quality._discounts(np.array(list(level[k].values()))) for k in level}

    def p(gram):
        lower = p(gram[1:]) if len(gram) > 1 else 1 / 256
        own = {g: n for g, n in level[len(gram)].items() if g[:-1] == gram[:-1]}
        total, off = sum(own.values()), discount[len(gram)]
        if not total:
            return lower
        here = level[len(gram)][gram]
        return (here - off[min(here, 3)] + sum(off[min(n, 3)] for n in own.values()) * lower) / total

    model = quality.fit_kneser_ney(np.array(list(counts)), np.array(list(counts.values())), 256, 5)
    scores = quality.Scores(quality.packed("en", model))
    keys = np.array(list(counts), dtype=np.uint64)
    found = np.exp(scores.by_lang["en"][scores.places(keys)].astype(float))
    assert np.allclose(found, [p(int(k).to_bytes(5, "big")) for k in counts], rtol=1e-4)
    for context in (b"the ", b"zzzz", b"\xff" * 4, b"zthe", b" the"):
        every = [int.from_bytes(context + bytes([b]), "big") for b in range(256)]
        table = np.exp(quality.expand(model, np.array(every), 256).astype(float))
        assert abs(table.sum() - 1) < 1e-3
        assert np.allclose(table, [p(k.to_bytes(5, "big")) for k in every], rtol=1e-4)
    unseen = scores.places(np.array([int.from_bytes(b"zzzzz", "big")], np.uint64))
    assert np.allclose(scores.by_lang["en"][unseen], -np.log(256))


def test_scores_find_every_counted_gram():
    grams = np.unique(np.random.default_rng(3).integers(0, 256**5, 20_000))
    model = quality.fit_kneser_ney(grams, np.ones(len(grams), np.int64), 256, 5)
    scores = quality.Scores(quality.packed("x", model))
    assert (scores.places(grams.astype(np.uint64)) == np.arange(len(grams))).all()


@pytest.mark.parametrize("bounds", [(1 << 21, 1 << 21), (50, 30)])
def test_every_gram_of_every_byte_is_counted(spark, bounds):
    rows = [("en", "a%b$c aB"), ("en", "A%b$C ab" * 20), ("fr", "été\x00\x01"), ("fr", ""), ("fr", None), ("en", "a%b$c aB")]
    frame = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    found = {(r.lang, r.gram): r.n for r in quality.count_grams(frame, *bounds).collect()}
    brute = collections.Counter()
    for lang, text in rows:
        padded = b"\xff" * 4 + (text or "").encode()
        brute.update((lang, int.from_bytes(padded[a : a + 5], "big")) for a in range(len(padded) - 4))
    assert found == brute


@pytest.mark.parametrize("task_bytes", [quality.RARE_BYTES, 3000, 300])
def test_languages_beyond_the_most_frequent_have_models_of_their_own(spark, monkeypatch, task_bytes):
    """The bound on broadcast models decides no text's own model, whatever part of a language a task scores."""
    rng = np.random.default_rng(5)
    words = [["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(30)] for _ in range(7)]
    names = ["l0", "l1", "l2", "l3", "", "None", "l6"]
    rows = [
        (k, names[k % 7 if k < 70 else 0], "\n".join(" ".join(rng.choice(words[k % 7], 15)) for _ in range(3)))
        for k in range(100)
    ]
    rows += [(100, None, "of no language, but of more than ten words for all that it says"), (101, "l3", None),
             (102, "l3", ""), (103, "only empty", ""), (rows[6]), (rows[6]), (None, "l6", rows[6][2])]
    frame = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    whole = quality.judge(frame, languages=20).collect()
    scored = quality.score_rare
    monkeypatch.setattr(quality, "score_rare", lambda *a: scored(*a, task_bytes=task_bytes))
    bounded = quality.judge(frame, languages=2)
    found = bounded.collect()

    def own(judged):
        return sorted((str(r.doc_id), r.lang, r.n_words, r.log_ppl and round(r.log_ppl, 9)) for r in judged
                      if r.doc_id not in (100, 103))

    assert len(found) == len(rows) and own(found) == own(whole)
    assert {r.lang for r in found} == {*names, "only empty", quality.OTHER}
    kept = quality.keep_good(frame.withColumn("_score", frame.lang), languages=2)
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(r.doc_id) for r in found if r.kept)
    assert kept.columns == ["doc_id", "lang", "text", "_score"]
    assert all(r.low is not None and r.low <= r.log_ppl for r in found if r.kept)


def brute_removed(rows, length):
    count = collections.Counter()
    for _, t in rows:
        b = (t or "").encode()
        count.update(b[a : a + length] for a in range(len(b) - length + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for a in range(len(b) - length + 1):
            if count[b[a : a + length]] > 1:
                gone[a : a + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("group", [50_000, 3])
def test_suffix_dedup(docs, rows, group):
    found = suffixes.remove_repeats(docs, 60, False, group).drop("code", "kept_bytes")
    same(found.collect(), brute_removed(rows, 60))


@pytest.mark.parametrize("group", [50_000, 3])
def test_suffix_dedup_removes_planted_passages_and_nothing_else(spark, group):
    rng = random.Random(8)

    def prose(size):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(size))

    # a passage in three texts each, with other text around it, some copies among them
    planted = {k: prose(size) for k, size in enumerate((399, 400, 401, 450, 550, 700))}
    rows, want = [], {}
    for k, passage in planted.items():
        for n in range(3):
            doc_id = 10 * k + n
            rows.append((doc_id, f"{prose(300 + n)}{n}{passage}{n}{prose(200)}"))
            want[doc_id] = len(passage) if len(passage) >= 400 else 0
    rows += [(100 + n, prose(900)) for n in range(5)]
    want |= {100 + n: 0 for n in range(5)}
    rows += [(200 + n, rows[18][1]) for n in range(4)]  # copies of document 100
    want |= {200 + n: 900 for n in range(4)} | {100: 900}
    # one passage, a third of all rows, always another context
    rows += [(300 + n, f"{prose(150)}{chr(65 + n)}{planted[5][:420]}{chr(65 + n)}{prose(150)}") for n in range(12)]
    want |= {300 + n: 420 for n in range(12)}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = suffixes.remove_repeats(docs, 400, False, group).drop("code", "kept_bytes").collect()
    assert {r.doc_id: r.n_removed for r in found} == want
    same(found, brute_removed(rows, 400))


def test_deep_shallow_sorts():
    rng = random.Random(3)
    for _ in range(100):
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 40))) for _ in range(25)]
        order = suffixes.deep_shallow(strings, shallow=8)
        assert [strings[k] for k in order] == sorted(strings)


def test_secrets(spark, docs):
    text = 'é password: "abcdefgh1" API_KEY=short token = \'0123456789abcdef0123456789abcdef\' AKIA0123456789ABCD'
    one = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id bigint, text string")
    found = {r.doc_id: r for r in secrets.scan(one).collect()}
    r = found[1]
    assert (r.n_assign, r.n_access, r.n_hex) == (2, 1, 1)
    base = [s for s in r.spans.split(",") if not s.startswith("format")]
    assert hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256
    assert found[2].spans == "" and found[3].n_hex == 0
    assert "abcdefgh1" not in secrets.redact(text, r.spans)
    assert secrets.redact_documents(docs).columns == docs.columns


def test_learned_formats_tell_credentials_from_words():
    rng = random.Random(0)
    keys = ["AKIA" + "".join(rng.choice("ABCDEFGHXYZ0123456789") for _ in range(16)) for _ in range(200)]
    plain = [f"einheitkeitundsch{k}" for k in range(200)]
    tables = secrets.learn({"access": keys[:100], "": plain[:100]})
    assert all(secrets.format_score(tables, k) > secrets.THRESHOLD for k in keys[100:])
    assert all(secrets.format_score(tables, k) < secrets.THRESHOLD for k in plain[100:])


def keys_in_words(n, labelled, wrap="{}", length=20):
    """Texts of ordinary words; every one holds a key, and the first ones name it a token."""
    rng = random.Random(4)
    key = lambda: "".join(rng.choice("abcxyzABCXYZ0123456789") for _ in range(length))
    keys = [key() for _ in range(n)]
    words = ["".join(rng.choice("aeinorstlm") for _ in range(rng.randint(4, 22))) for _ in range(400)]
    made = []
    for i, k in enumerate(keys):
        own = [*rng.sample(words, 12), "10.2.33.%d" % i, "mail%d.example.com" % (i % 9), "98079157%08d" % i]
        made.append((i, " ".join([*own, ("token: " if i < labelled else "") + wrap.format(k)])))
    return keys, made


def test_unlabelled_credentials_do_not_teach_what_is_ordinary(spark):
    keys, made = keys_in_words(400, 40)
    found = secrets.redact_documents(
        spark.createDataFrame([(i, t, len(t)) for i, t in made], "doc_id bigint, text string, n_chars int")
    ).collect()
    for r in found:
        assert keys[r.doc_id] not in r.text
        assert r.text.count("[secret]") == 1


def test_short_and_letters_only_credentials_are_scored(spark):
    keys, made = keys_in_words(300, 60, length=12)
    letters = [(300 + i, "reinten XaBcYzAbXcYa sentiontor") for i in range(3)]
    keys += ["XaBcYzAbXcYa"] * 3
    found = secrets.redact_documents(
        spark.createDataFrame([(i, t, 0) for i, t in made + letters], "doc_id bigint, text string, n_chars int")
    ).collect()
    for r in found:
        assert keys[r.doc_id] not in r.text
        assert r.text.count("[secret]") == 1


@pytest.mark.parametrize("wrap", ["{}ZQKWXYZ", "QZ{}XKWY", "remainder{}remainderofit"])
def test_token_around_a_hex_run_is_masked_whole(spark, wrap):
    rng = random.Random(6)
    _, made = keys_in_words(40, 40)
    runs = ["".join(rng.choice("0123456789abcdef") for _ in range(32)) for _ in range(40)]
    # what is glued is no hex letter, so that the run ends where it does
    made = [(i, f"{t} xx {wrap.format('0' + h[1:-1] + '9')} yy") for (i, t), h in zip(made, runs)]
    one = spark.createDataFrame(made, "doc_id bigint, text string")
    for r in secrets.redact_documents(one.withColumn("n_chars", one.doc_id.cast("int"))).collect():
        assert r.text.endswith(" xx [secret] yy")
    base = {r.doc_id: (r.n_hex, r.spans) for r in secrets.scan(one).collect()}
    assert all(n == 1 and "hex:" in spans for n, spans in base.values())


def brute_components(rows):
    sets = []
    for i, t in rows:
        w = tuple((t or "").encode().translate(minhash.LOWER).split())
        s = {w[a : a + 5] for a in range(len(w) - 4)} if len(w) >= 5 else {w} if w else set()
        sets.append((i, s))
    up = {i: i for i, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    least = lambda x: -(1 << 63) if x is None else x
    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = sorted((find(i), find(j)), key=least)
                up[y] = x
    return [(i, len(s), find(i), find(i) == i) for i, s in sets]


@pytest.mark.parametrize("block", [2048, 2])
def test_near_duplicates(docs, rows, block):
    found = minhash.near_duplicates(docs, block_docs=block).drop("code")
    same(found.collect(), brute_components(rows))
    assert {r.doc_id for r in minhash.keep_one(docs).select("doc_id").collect()} == {
        i for i, _, c, kept in brute_components(rows) if kept
    }


def test_texts_of_one_group_that_share_an_id_are_all_compared(spark):
    one = [f"a{k}" for k in range(60)]
    two = [f"b{k}" for k in range(60)]
    # 3 is near the first text of 1 and 4 near the second; 2 bridges the texts into one group
    mixed = one[:30] + two[:30]
    rows = [(1, "\t".join(one)), (1, "\t".join(two)), (3, " ".join(one[:-1])), (4, " ".join(two[:-1])),
            (2, " ".join(mixed))]
    members = [(7, 0, 0, 0, i, k, " ".join(t.split())) for k, (i, t) in enumerate(rows)]
    schema = "component int, one int, two int, block int, id bigint, code bigint, text string"
    links = minhash._verified(spark.createDataFrame(members, schema)).collect()
    assert {tuple(sorted((r.a, r.b))) for r in links} == {(1, 3), (1, 4)}


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    bench = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    path = tokenizer_file("word_bpe_49k.json")
    for found in (packing.pack(none, path), decontam.decontaminate(none, bench), licenses.scan(none),
                  quality.judge(none), suffixes.remove_repeats(none), secrets.scan(none),
                  minhash.near_duplicates(none)):
        assert found.count() == 0
