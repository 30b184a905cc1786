"""Conversation repair, phrase mining and the byte network against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tripmill.llm import byte_network, phrases, repair
from tripmill.llm.common import table

NEXT = {"": "us", "s": "u", "u": "a", "a": "u"}
SPACE = re.compile("[^\x20\x09-\x0d]")


# ---- conversation structure repair


def cheapest(rows):
    """(cost, audit) of [(initial, fault)] by dynamic programming from the end."""
    never = (1 << 30, "")
    best = None
    for i in range(len(rows), -1, -1):
        here = {}
        for last in NEXT:
            options = [never]
            if i == len(rows):
                options += [(0, "")] if last in ("", "a") else []
            else:
                initial, fault = rows[i]
                late = fault == "truncated"
                options.append((best[last][0] + 3, "D" + best[last][1]))
                if fault not in ("blank", "duplicate"):
                    if initial and initial in NEXT[last]:
                        options.append((best[initial][0] + late, "K" + best[initial][1]))
                    for new in set(NEXT[last]) & set("ua"):
                        options.append((best[new][0] + 2 + late, "R" + best[new][1]))
            here[last] = min(options)
        for _ in range(5):  # insertions, some of them one after another
            for last in NEXT:
                new = NEXT[last][0]
                here[last] = min(here[last], (here[new][0] + 2, "I" + here[new][1]))
        best = here
    return best[""]


def faults_of(rows):
    """The fault of each (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        shown = SPACE.findall(text)
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else ""
        out.append(fault or ("truncated" if shown[-1] not in ".!?" else ""))
        seen.add((role, text))
    return out


def expected_report(rows):
    """All columns but the id, from the damaged (turn, role, text) of a conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults = faults_of([r[1:] for r in rows])
    initials = [r[1][:1] for r in rows]
    cost, audit = cheapest(list(zip([x if x in ("s", "u", "a") else "" for x in initials], faults)))
    turns = {r[0] for r in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    last, out, at = "", [], 0
    for letter in audit:
        if letter == "I" or letter == "R":
            last = NEXT[last][0]
            out.append({"u": "user", "a": "assistant"}[last] + ":" + (rows[at][2] if letter == "R" else ""))
        elif letter == "K":
            last = initials[at]
            out.append(f"{rows[at][1]}:{rows[at][2]}")
        at += letter != "I"
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, digest), out


def damaged(conv_id, turn, role, text):
    """The rows that take a row's place."""
    role, text = (" " if x is None else x for x in (role, text))
    key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
    kind = zlib.crc32(key.encode()) % 20
    if kind == 1:
        text = ""
    if kind == 2:
        text = re.sub("[.!?]", "", text)
    return [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)


def conversation_rows():
    rng = random.Random(3)
    rows = []
    for conv in range(150):
        for turn in range(rng.randint(1, 14)):
            role = ("user", "assistant")[turn % 2] if rng.random() < 0.8 else rng.choice(
                ["system", "tool", "", None, "user"])
            text = rng.choice(["Yes.", "No", " \t\n", "", None, "Why?", "é!", f"text {turn}.", f"end {conv}. \v"])
            rows.append((conv, turn * rng.choice([1, 1, 1, 2]), role, text))
    rows += [(200, None, "user", "a."), (200, None, "assistant", "b."), (200, None, "user", "a.")]
    rows += [(None, 3, "user", "x."), (None, None, None, None), (201, 5, "assistant", "z" * 300_000 + ".")]
    rows += [(300 + i, 0, "user", "Hi.") for i in range(40)]  # some of these lose their only row
    return rows


SCHEMA = "conv_id bigint, turn bigint, role string, text string, present_ string, kind string, audit int"


@pytest.fixture(scope="module")
def conversations(spark):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in conversation_rows()], SCHEMA)


@pytest.fixture(scope="module")
def by_conversation():
    out = collections.defaultdict(list)
    for conv, *row in conversation_rows():
        out[conv] += damaged(conv, *row)
    return out


def test_search_equals_dynamic_programming():
    rng = random.Random(1)
    for _ in range(1500):
        rows = [(rng.choice(["s", "u", "u", "a", "a", ""]), rng.choice(["", "", "blank", "truncated"]))
                for _ in range(rng.randint(0, 11))]
        symbols = bytes(repair.SYMBOLS.get(x, repair.OTHER) for x, _ in rows)
        kinds = {"": repair.FINE, "blank": repair.GONE, "truncated": repair.TRUNCATED}
        faults = bytes(kinds[f] for _, f in rows)
        expected = cheapest(rows)
        assert repair.repair(symbols, faults) == expected
        # blocks of a few rows give the answer of the whole
        assert repair.repair(symbols, faults, block=rng.randint(1, 4)) == expected


def test_repair_equals_brute_force(conversations, by_conversation):
    found = repair.reports(repair.damage(conversations), block=5).collect()
    assert {r.conv_id for r in found} == set(by_conversation) and len(found) == len(by_conversation)
    for r in found:
        assert tuple(r)[1:] == expected_report(by_conversation[r.conv_id])[0], r
    empty = [r for r in found if not by_conversation[r.conv_id]]
    assert empty and {(r.cost, r.audit, r.repaired_sha256) for r in empty} == {
        (0, "", hashlib.sha256(b"").hexdigest())
    }


def test_repaired_turns_are_what_was_hashed(conversations, by_conversation):
    turns = repair.damage(conversations)
    rows = repair.repaired_turns(turns, repair.audits(turns)).collect()
    found = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: r.position):
        assert r.position == len(found[r.conv_id]) + 1
        found[r.conv_id].append(f"{r.role}:{r.text}")
    for conv, own in by_conversation.items():
        assert found[conv] == expected_report(own)[1]


def test_repair_of_whole_rows_and_of_none(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello.")]
    (one,) = repair.reports(spark.createDataFrame(rows, schema)).collect()
    assert (one.cost, one.audit, one.gaps) == (0, "KKK", 0)
    assert repair.reports(spark.createDataFrame([], schema)).collect() == []
    # the only row of a conversation is a system turn: nothing may stay alone
    (one,) = repair.reports(spark.createDataFrame(rows[:1], schema)).collect()
    assert (one.cost, one.audit) == (3, "D")


def test_one_message_said_very_often(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    rows = [(1, i, "user", "Again.") for i in range(3000)] + [(2, 0, "user", "a.")]
    found = {r.conv_id: r for r in repair.reports(spark.createDataFrame(rows, schema)).collect()}
    assert found[1].duplicate == 2999 and found[1].cost == 3 * 2999 + 2
    assert found[1].audit == "KD" + "D" * 2998 + "I"


# ---- phrases


def phrase_table(rows, least, top):
    lower = {c: c + 32 for c in range(65, 91)}
    counts, totals = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = lang or "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for m in range(1, 6):
                for i in range(len(words) - m + 1):
                    counts[lang, tuple(words[i : i + m])] += 1
    often = {k: n for k, n in counts.items() if n >= least and len(k[1]) > 1}
    out = collections.defaultdict(list)
    for (lang, w), a in often.items():
        score, k = min((1000 * a * totals[lang] // (counts[lang, w[:k]] * counts[lang, w[k:]]), k)
                       for k in range(1, len(w)))
        longer = [n for (other, v), n in often.items() if other == lang and len(v) > len(w)
                  and any(v[i : i + len(w)] == w for i in range(len(v)))]
        if not longer or 100 * max(longer) < 100 * a:
            out[lang].append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
    return {
        (lang, rank, p.decode(), -a, l, r, totals[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1)
    }


@pytest.fixture(scope="module")
def phrase_rows():
    rng = random.Random(11)
    rows = []
    for _ in range(120):
        words = [rng.choice("to be or not é ou Die X w1 w2".split()) for _ in range(rng.randint(0, 60))]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "!", "\x85"]) for w in words)
        rows.append((rng.choice(["en", "de", None]), text))
    rows += [("en", "so it goes on " * 40), ("en", None), (None, ""), ("fr", "x"), ("en", "A a a a a " * 30)]
    rows += [("de", "very long text without any end " * 400)] * 3  # copies count each time
    return rows


def phrase_frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, x, 0, "p", 2) for i, (x, t) in enumerate(rows)],
        "doc_id bigint, text string, lang string, n bigint, phrase string, rank int",
    )


SMALL = phrases.Sizes(burst=3, budget=40, lexicon=9, chunk=30, pairs=100, part=50)


@pytest.mark.parametrize("sizes", [phrases.Sizes(), SMALL])
def test_phrases_equal_brute_force(spark, phrase_rows, sizes):
    # the small sizes burst, spill, begin anew and read in parts all the time
    frame = phrase_frame(spark, phrase_rows).repartition(3)
    for least, top in ((5, 20), (12, 1000)):
        found = phrases.collocations(frame, least, top, sizes).collect()
        assert {tuple(r) for r in found} == phrase_table(phrase_rows, least, top) and len(found) > 10


class Held:
    """A frame and a context that hand back the function of a task, or a value."""

    sparkContext = sparkSession = property(lambda self: self)

    def mapInArrow(self, task, schema):
        return task

    def broadcast(self, value):
        return type("Sent", (), {"value": value})


def word_batches(n, langs, rows=50):
    words = [f"w{k:07d}" for k in range(n)]
    step = max(1, n // rows)
    for a in range(0, n, step):
        text = " ".join(words[a : a + step])
        yield pa.RecordBatch.from_pylist([{"lang": lang, "text": text} for lang in langs])


def test_first_pass_holds_few_bytes_a_word():
    import tracemalloc

    task = phrases._runs(Held(), 10, None, phrases.Sizes())
    tracemalloc.start()
    try:
        found = sum(b.num_rows - b.column("phrase").null_count for b in task(word_batches(60_000, ["en"])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # what counting takes whatever the words: pairs, waiting ids, an emitted batch
    assert found == 60_000 and peak < 60_000 * 400 + (4 << 20)


def test_words_of_all_languages_share_one_bound():
    seen, sizes = [], phrases.Sizes(lexicon=1000)

    def batches():
        for batch in word_batches(900, [f"l{k}" for k in range(8)]):
            seen.append(batch)
            yield batch

    counts, early = collections.Counter(), None
    for b in phrases._runs(Held(), 10, None, sizes)(batches()):
        early = early or len(seen)
        for lang, phrase, n in zip(*(b.column(c).to_pylist() for c in ("lang", "phrase", "n"))):
            if phrase:
                counts[lang, phrase] += n
    assert early < len(seen) and len(counts) == 8 * 900 and set(counts.values()) == {1}


def test_phrases_of_an_empty_table(spark, phrase_rows):
    assert phrases.collocations(phrase_frame(spark, phrase_rows).limit(0)).collect() == []


def test_trie_counts_bursts_and_spills():
    rng = random.Random(2)
    keys = [tuple(rng.randint(1, 5) for _ in range(rng.randint(3, 5))) for _ in range(4000)]
    trie, spilled = phrases.HatTrie(2, burst=8), collections.Counter()
    for key in keys:
        trie.add(key, 1)
        if trie.entries > 100:
            taken = list(trie.spill(50))
            assert {k[0] for k, _ in taken}.isdisjoint(trie.root)  # whole subtrees
            for k, n in taken:
                spilled[k] += n
    assert any(type(x) is phrases.HatTrie.Node for x in trie.root.values())
    for k, n in trie.spill(0):
        spilled[k] += n
    assert spilled == collections.Counter(keys) and trie.entries == 0


def test_runs_of_places_come_back_merged():
    rng = np.random.default_rng(4)
    runs, expected = [], collections.Counter()
    for _ in range(6):
        places = np.unique(rng.integers(0, 1 << 30, 500) // 100_000 * 100_000).astype(np.uint64)
        counts = rng.integers(1, 100_000, len(places))
        runs.append(phrases.pack_run(places, counts))
        expected.update(dict(zip(places.tolist(), counts.tolist())))
    places, counts = phrases.merge_runs(runs)
    assert dict(zip(places.tolist(), counts.tolist())) == expected and (np.diff(places) > 0).all()


def test_scores_beyond_64_bits(spark):
    counts = spark.createDataFrame(
        [("en", "a b", 3 * 10**12), ("en", "a", 4 * 10**12), ("en", "b", 5 * 10**12)],
        "lang string, phrase string, n bigint",
    )
    totals = spark.createDataFrame([("en", 10**14)], "lang string, n bigint")
    (row,) = phrases._scored(counts, totals).collect()
    assert row.score == 1000 * 3 * 10**12 * 10**14 // (4 * 10**12 * 5 * 10**12) == 15000


# ---- byte network


def test_chunks_cover_every_byte():
    for n in (0, 1, 63, 64, 65, 448, 511, 512, 513, 960, 961, 5000):
        text = bytes(i % 251 for i in range(n))
        covered = np.zeros(n, bool)
        for at, part in zip(byte_network.starts(n), byte_network.chunks(text)):
            assert text[at : at + len(part)] == part and len(part) <= byte_network.CHUNK
            covered[at : at + len(part)] = True
        assert covered.all()
        assert len(byte_network.shown(text)) == min(byte_network.SHOWN, len(byte_network.starts(n)))


def test_responses_equal_a_plain_convolution():
    net = byte_network.initial()
    rng = np.random.default_rng(0)
    matrix = rng.integers(0, 256, (3, byte_network.CHUNK), dtype=np.uint8)
    found, where = byte_network.responses(net, matrix, places=True)
    for c in range(3):
        windows = [net["embed"][matrix[c, i : i + byte_network.WIDTH]].reshape(-1)
                   for i in range(0, byte_network.CHUNK - byte_network.WIDTH + 1, byte_network.STEP)]
        plain = np.stack(windows) @ net["filters"]
        assert np.allclose(found[c], np.maximum(plain.max(axis=0) + net["filter_bias"], 0), atol=1e-5)
        assert (where[c] == plain.argmax(axis=0) * byte_network.STEP).all()


def test_slopes_equal_differences():
    rng = np.random.default_rng(1)
    net = {k: v.astype(np.float64) for k, v in byte_network.initial().items()}
    for name in ("mean_out", "max_out"):
        net[name] = rng.standard_normal(net[name].shape)
    matrix = rng.integers(0, 256, (5, byte_network.CHUNK), dtype=np.uint8)
    owner, y, weight = np.array([0, 0, 1, 2, 2]), np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])

    def loss():
        units = byte_network.hidden(net, byte_network.responses(net, matrix)[0])
        logits = [units[owner == d].mean(axis=0) @ net["mean_out"] + units[owner == d].max(axis=0) @ net["max_out"]
                  + net["bias"][0] for d in range(3)]
        p = byte_network.probability(np.array(logits))
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).mean()

    slopes = byte_network._slopes(net, matrix, owner, y, weight)
    for name, slope in slopes.items():
        for at in rng.choice(net[name].size, min(6, net[name].size), replace=False):
            place = np.unravel_index(at, net[name].shape)
            before = net[name][place]
            net[name][place] = before + 1e-5
            up = loss()
            net[name][place] = before - 1e-5
            down = loss()
            net[name][place] = before
            assert slope[place] == pytest.approx((up - down) / 2e-5, abs=2e-4), (name, place)


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = byte_network.classify(docs, labels).collect()
    assert len(rows) == docs.count()
    quality = {r.doc_id: r.quality for r in labels.collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1
    judged = [(r.predicted, quality[r.doc_id]) for r in rows if r.held_out and r.doc_id in quality]
    assert len(judged) > 500
    kept, junk = ([p for p, q in judged if q == label] for label in (1, 0))
    assert sum(kept) / len(kept) >= 0.98
    assert sum(junk) / len(junk) <= 0.1


def test_network_over_odd_rows(spark):
    clean = "the men went over the hill and came home again before it was dark. "
    rows = [(i, clean * 3 if i % 3 else "BUY!! NOW!! $$$ " * 12, "a", "b") for i in range(200)]
    rows += [(300, None, None, None), (301, "", "x", "y"), (None, clean, "x", "y"), (302, clean * 5000, "x", "y"),
             (302, clean * 5000, "x", "y")]
    # score and quality are columns of the documents too, and must not be read
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string, quality string")
    labels = spark.createDataFrame(
        [(i, int(i % 3 > 0), "z") for i in range(200)] + [(5, None, "z"), (None, 1, "z")],
        "doc_id bigint, quality int, text string",
    )
    found = byte_network.classify(docs, labels, epochs=8).collect()
    assert len(found) == len(rows)
    by = collections.defaultdict(list)
    for r in found:
        by[r.doc_id].append(r)
    assert by[302][0] == by[302][1] and by[300][0].score == by[301][0].score
    assert by[None][0].held_out and by[None][0].predicted == 1
    right = [by[i][0].predicted == int(i % 3 > 0) for i in range(200)]
    assert sum(right) / len(right) > 0.97
    assert byte_network.classify(docs.limit(0), labels, epochs=1).collect() == []
    # without labels of both kinds every text has the same score
    assert {r.score for r in byte_network.classify(docs, labels.limit(0)).collect()} == {0.5}
