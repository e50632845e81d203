"""The pipeline, stage by stage, against plain versions of its decisions."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

import corpus_pipeline
from ridelake.llm import langid, minhash, mixing
from ridelake.llm.steps import Scratch
from tests.llm import brute


def one_of_each(rows):
    """The first row, by doc_id (null last), of every group of near-duplicates of any ids; rows without words all stay."""
    numbered = list(enumerate(sorted(rows, key=lambda row: (row[0] is None, row[0] or 0))))
    of = brute.near_components([(n, t) for n, (_, t) in numbered], 80)
    return [row for n, row in numbered if of[n] == n]


def by_row(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


def test_each_stage_decides_like_brute_force(spark, corpus, folder):
    scratch = Scratch(spark, "test-pipeline")
    docs, kept = corpus, []
    for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = scratch.freeze(stage(spark, docs, folder), f"stage-{place}")
        kept.append(docs)
    assert all(df.columns == corpus.columns for df in kept[:-1])

    rows = [(k, t) for k, t in by_row(corpus) if re.search(r"[^\W\d_]", t or "")]
    assert by_row(kept[0]) == sorted(rows, key=repr)
    assert kept[0].where("lang IS NULL").isEmpty()

    rows = one_of_each(rows)
    assert by_row(kept[1]) == sorted(rows, key=repr)

    edited = [(k, t if not gone else text, n, gone) for (k, t), (_, n, gone, text) in zip(rows, brute.word_dedup(rows))]
    rows = [(k, t) for k, t, n, gone in edited if not n or gone < n]
    assert by_row(kept[2]) == sorted(rows, key=repr)

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    clean = [not hit[-1] for hit in brute.leaks(rows, items)]
    rows = [row for row, ok in zip(rows, clean) if ok]
    assert by_row(kept[3]) == sorted(rows, key=repr)

    # The mix, by the queues of what is left; equal ranks are rows of one doc_id and text.
    ranked = kept[3].select("doc_id", "text", "source", F.xxhash64(F.lit(7), "doc_id", "text").alias("rank")).collect()
    assert len({r.rank for r in ranked}) == len(rows)
    goal, taken = brute.fair_queue([((r.doc_id, r.text), r.source, len(brute.solid(r.text)), r["rank"]) for r in ranked])
    mixed = kept[4].collect()
    column = "mix_taken" if "mix_taken" in kept[4].columns else "taken"
    assert sorted(((r.doc_id, r.text), r[column]) for r in mixed if r.doc_id) == sorted((k, n) for k, n in taken.items() if n and k[0])
    for s in goal:
        short = sum(max(g / mixing.GRAIN, mixing.LEAST) + 1 for g in goal.values())
        assert abs(sum(r[column] for r in mixed if r.source == s) - goal[s]) <= short


def test_run_gives_the_last_stage(spark, folder):
    done = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "text", "taken", "position"} <= set(done.columns) and done.count() > 100


def test_near_copies_go_from_four_fifths_on(spark, folder):
    """Sets of 96 shingles: with k words replaced far from each other, 5 k of them differ."""
    base = [f"word{k}" for k in range(100)]

    def edited(name, k):
        words = [f"{name}{w}" for w in base]
        other = [f"{w}x" if i in range(10, 10 + 10 * k, 10) else w for i, w in enumerate(words)]
        return " ".join(words), " ".join(other)

    # (96 - 5 k) / (96 + 5 k): 0.90, 0.81 and 0.73; and 8 of 10 shingles, 0.8 to the point
    pairs = [edited("a", 1), edited("b", 2), edited("c", 3), (" ".join(base[:13]), " ".join([*base[:12], "x"]))]
    rows = [(2 * k + side, text) for k, two in enumerate(pairs) for side, text in enumerate(two)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, folder).collect())
    of = brute.near_components(rows, 80)
    assert left == sorted(k for k, _ in rows if of[k] == k) == [0, 2, 4, 5, 6]
    at_85 = sorted(r.doc_id for r in minhash.near_duplicates(docs).where("kept").collect())
    assert at_85 == [0, *range(2, 8)]


def test_stages_after_near_duplicates_of_four_fifths(spark, corpus, folder):
    """As in the test of each stage above, with links of 0.8."""
    scratch = Scratch(spark, "test-pipeline")
    docs, kept = corpus, []
    for place, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        docs = scratch.freeze(stage(spark, docs, folder), f"stage-{place}")
        kept.append(docs)
    rows = one_of_each(by_row(kept[0]))
    assert by_row(kept[1]) == sorted(rows, key=repr)
    edited = [(k, t if not gone else text, n, gone) for (k, t), (_, n, gone, text) in zip(rows, brute.word_dedup(rows))]
    rows = [(k, t) for k, t, n, gone in edited if not n or gone < n]
    assert by_row(kept[2]) == sorted(rows, key=repr)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    rows = [row for row, hit in zip(rows, brute.leaks(rows, items)) if not hit[-1]]
    assert by_row(kept[3]) == sorted(rows, key=repr)


def test_one_row_of_each_group_whatever_its_doc_id(spark, folder):
    """Null ids, repeated rows, near copies under one id, and different texts under one id, which stay apart."""
    words = [f"word{k}" for k in range(60)]
    near = " ".join([*words[:58], "other", "end"])
    rows = [
        (None, " ".join(words)), (None, " ".join(words)), (7, "one two three four five six"), (7, "one two three four five six"),
        (7, "seven eight nine ten eleven twelve"), (8, near + " x"), (8, near + " y"), (9, " ".join(words)), (10, None), (10, None),
        (None, "alone without a number at all"), (None, "alone without a number at all"), (11, ""), (11, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(c) for c in ("node", "row", "goes", "version", "number")})
    done = minhash.one_of_each(docs, 80)
    assert done.columns == docs.columns
    left = sorted(((r.doc_id, r.text) for r in done.collect()), key=repr)
    # word.. and near (8, 9, null) are one group, of which 8 is least; which text of 8 stays depends on its hash.
    assert [row for row in left if row[0] != 8] == sorted(
        [(7, "one two three four five six"), (7, "seven eight nine ten eleven twelve"), (10, None), (10, None),
         (None, "alone without a number at all"), (11, ""), (11, "")], key=repr)
    assert [row[1] in (near + " x", near + " y") for row in left if row[0] == 8] == [True]
    assert minhash.one_of_each(docs.where("false")).count() == 0


def test_the_parse_overrules_a_wrong_label(spark):
    stored = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    wrong = stored.where("lang = 'en' AND length(text) > 200").where(langid.held_out(F.col("doc_id")))  # none of them is learned from
    wrong = wrong.orderBy("doc_id").limit(20).select("doc_id").collect()
    ids = [r.doc_id for r in wrong]
    docs = stored.withColumn("lang", F.when(F.col("doc_id").isin(ids), F.lit("de")).otherwise(F.col("lang")))
    done = langid.identified(docs)
    assert done.count() == docs.count()
    found = {r.doc_id: r.lang for r in done.collect()}
    assert sum(found[k] == "en" for k in ids) >= 18
    same = stored.where(~F.col("doc_id").isin(ids)).collect()
    assert sum(found[r.doc_id] == r.lang for r in same) >= 0.995 * len(same)


def test_empty_documents_pass_all_stages(spark, none, folder):
    docs = none
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0
