"""The chain of stages against the single operators, with columns of clashing names."""

import collections

import corpus_pipeline
import numpy as np
import pytest

from tripmill.llm import decontam, minhash, quality
from tripmill.llm import common
from tripmill.llm.common import stored, table

SF_DIR = "/root/testdata/sf0.001"
#: Names that the operators use inside.
CLASHES = ("_id", "_code", "_copies", "copies", "code", "kept", "score", "id", "spans", "_ID_")


@pytest.fixture(scope="module")
def documents(spark):
    docs = table(spark, SF_DIR, "documents")
    odd = spark.createDataFrame(
        [(900001, None, None, None, None), (900002, "", "en", "s", 0), (None, "short text", "en", "s", 10),
         (900003, "w " * 50_000, "en", "s", 100_000)], docs.schema,
    )
    twice = docs.orderBy("doc_id").limit(5)  # repeated rows
    every = docs.unionByName(odd).unionByName(twice)
    return every.selectExpr("*", *[f"'x' as `{c}`" for c in CLASHES if c != "_ID_"])


def ids(df):
    return collections.Counter(r["doc_id"] for r in df.select("doc_id").collect())


def test_every_stage_keeps_what_its_operator_says(spark, documents):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_dedup", "decontamination", "secret_scan", "packing"]
    docs = stored(documents, "documents")
    after = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stored(stage(spark, docs, SF_DIR), name)
        assert sorted(kept.columns) == sorted(documents.columns), name
        if name == "quality_rules":
            assert ids(kept) == ids(quality.judge(docs).filter("kept"))
        elif name == "near_dedup":
            found = minhash.near_duplicates(docs)
            assert ids(kept) == collections.Counter(set(ids(found.filter("kept"))))
        elif name == "decontamination":
            found = decontam.decontaminate(docs, table(spark, SF_DIR, "benchmark"))
            assert ids(kept) == ids(found.filter("not contaminated"))
        else:
            assert ids(kept) == ids(docs)
        after[name] = kept.count()
        docs = kept
    assert documents.count() > after["quality_rules"] > after["near_dedup"] >= after["decontamination"] > 0
    pieces = stages["packing"](spark, docs, SF_DIR).collect()
    assert {r.doc_id for r in pieces} == set(ids(docs))
    by = collections.defaultdict(list)
    for r in pieces:
        by[r.doc_id].append(r)
    for own in by.values():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at
            at += r.length
        assert at == own[0].doc_tokens


def test_an_empty_table_goes_through(spark, documents):
    docs = documents.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), name)
        assert docs.count() == 0


def test_stages_hand_over_small_batches(spark, documents):
    """A worker gets 2 MB at a time, not the 64 MB of the default, and all rows."""
    rows = spark.range(0, 3000, 1, 1).selectExpr(
        "id doc_id", "repeat(concat('w', id, ' '), 700) text", "'en' lang", "'s' source", "0 n_chars"
    )

    def sizes(batches):
        for batch in batches:
            yield common.arrow_rows([(batch.num_rows, batch.nbytes)], "n bigint, size bigint")

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    for before, most in ((None, common.BATCH_BYTES), ("1g", common.BATCH_BYTES), ("256KB", 256 << 10)):
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
        for stage in ("quality_rules", "near_dedup", "secret_scan", "packing"):
            kept = dict(corpus_pipeline.STAGES)[stage](spark, documents.limit(0), SF_DIR)
            assert kept.count() == 0
            found = rows.mapInArrow(sizes, "n bigint, size bigint").collect()
            assert sum(r.n for r in found) == 3000
            assert max(r.size for r in found) < most + 50_000, (before, stage)


def test_the_quality_stage_counts_every_byte_of_every_language(spark, monkeypatch):
    """No language, case, mark or control character is left out of what the models are fitted to."""
    rows = [(k, f"Abc {k}% dé\x01 " * (k % 7 + 1), f"l{k % 20}") for k in range(200)]
    rows += [(900, "no language, aB", None), (901, None, "l1"), (902, "", "l2"), (900, "no language, aB", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    counted = []
    fit = quality.fit_models
    monkeypatch.setattr(quality, "fit_models", lambda counts: counted.append(counts) or fit(counts))
    corpus_pipeline.quality_rules(spark, docs, SF_DIR)
    own = quality.own_languages(docs)
    assert len(own) == 16
    brute = collections.Counter()
    for _, text, lang in rows:
        padded = b"\xff" * 4 + (text or "").encode()
        brute.update(
            (lang if lang in own else quality.OTHER, int.from_bytes(padded[a : a + 5], "big"))
            for a in range(len(padded) - 4)
        )
    assert {(r.lang, r.gram): r.n for r in counted[0].collect()} == brute
    assert sum(brute.values()) == sum(len((text or "").encode()) for _, text, _ in rows)


def test_the_quality_stage_fits_a_model_to_each_language(spark, monkeypatch):
    """Also to those beyond the languages whose models are broadcast."""
    rows = [(k, f"Abc {k}% dé\x01 " * (k % 7 + 1), f"l{k % 20}") for k in range(200)]
    rows += [(900, "no language, aB", None), (901, None, "l1"), (902, "", "l19"), (903, "one text", "l99")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = []
    inside = quality._inside_bands
    monkeypatch.setattr(quality, "_inside_bands", lambda scored, band: found.append(scored) or inside(scored, band))
    corpus_pipeline.quality_rules(spark, docs, SF_DIR)
    found = found[0].collect()
    assert len(found) == len(rows)
    brute = collections.defaultdict(collections.Counter)
    for _, text, lang in rows:
        padded = b"\xff" * 4 + (text or "").encode()
        brute[lang].update(int.from_bytes(padded[a : a + 5], "big") for a in range(len(padded) - 4))
    scores = {}
    for lang, counts in brute.items():
        model = quality.fit_kneser_ney(np.array(list(counts)), np.array(list(counts.values())), 256, 5)
        scores[lang] = quality.Scores(quality.packed(lang, model))
    for r in found:
        text = (r.row.text or "").encode()
        assert r.lang == (r.row.lang or quality.OTHER)
        if r.row.lang and text:
            log_p = scores[r.lang].by_lang[r.lang][scores[r.lang].places(quality._keys(text))]
            assert abs(r.log_ppl + log_p.sum(dtype=np.float64) / len(text)) < 1e-9
        else:
            assert (r.log_ppl is None) == (not text)
