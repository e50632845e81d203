"""Every corpus operator against a plain version of itself, on stored and odd documents, and on no documents."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ridelake.llm import (
    decontaminate, langid, licenses, minhash, mixing, preferences, quality, recompress, suffixes, tokencounts,
)
from ridelake.llm.components import components
from ridelake.llm.queries import ORACLE, QUERIES
from ridelake.llm.steps import Scratch
from tests.compare import difference, sql_session
from tests.conftest import plan_of
from tests.llm import brute

NATIVE = ("op2_chat_format", "op5_quality_rules", "op10_decontaminate")


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, folder, name):
    assert difference(spark, sql_session(folder), QUERIES[name], ORACLE[name], folder) is None


@pytest.mark.parametrize("name", NATIVE)
def test_native_operators_run_no_python(spark, folder, name):
    assert not any(bad in plan_of(QUERIES[name](spark, folder)) for bad in ("Python", "Pandas", "Arrow", "CartesianProduct"))


# Language ID


def naive_phrases(text: bytes, learned: bytes) -> int:
    n, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in learned:
            size += 1
        n, at = n + 1, at + size
    return n


def test_cross_parsing_counts_longest_phrases():
    random.seed(3)
    learned = {k: bytes(random.choice(b"abcd ") for _ in range(300)) for k in ("a", "b")}
    texts = [bytes(random.choice(b"abcde ") for _ in range(n)) for n in (1, 2, 50, 255, 256)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = langid.Parser(learned).phrases(data, at)
    assert found.tolist() == [[naive_phrases(t, learned[k]) for k in ("a", "b")] for t in texts]


def test_blocks_add_up():
    learned = {"a": b"the rain in spain stays mainly", "b": b"der regen in spanien"}
    text = b"the rain stays in spain " * 40
    parser = langid.Parser(learned)
    parts = [text[k : k + langid.BLOCK] for k in range(0, len(text), langid.BLOCK)]
    expected = [sum(naive_phrases(p, learned[k]) for p in parts) for k in ("a", "b")]
    assert parser.phrases(np.frombuffer(text, np.uint8), np.array([0, len(text)])).tolist() == [expected]


def test_normalised_keeps_letters_only():
    data, at = langid.normalised(pa.array(["a1 b", None, "--", "é, c"]))
    assert [data[a:b].tobytes().decode() for a, b in zip(at, at[1:])] == ["a b", "", "", "é c"]


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_language_defined_cases(corpus, none):
    found = langid.identify(corpus).collect()
    assert len(found) == corpus.count()
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[k].lang_pred == "und" and by_id[k].score == 0 for k in (100_001, 100_002, 100_003, 100_004))
    assert all(0 <= r.score <= 1 for r in found)
    assert by_id[None].held_out is False and by_id[100_007].lang_pred != "und"
    assert langid.identify(none).count() == 0


def test_language_learns_only_from_labelled_documents_not_held_out(corpus):
    held = langid.held_out(F.col("doc_id"))
    known = table(langid.identify(corpus).select("doc_id", "lang_pred", "score"))
    hidden = corpus.withColumn("lang", F.when(held, "wrong").otherwise(F.col("lang"))).withColumn("source", F.lit("x"))
    assert table(langid.identify(hidden).select("doc_id", "lang_pred", "score")) == known
    unlabelled = langid.identify(corpus.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


# Chat formatting


TURNS = "pair_id long, side string, turn int, role string, text string"


def test_pairs_share_their_longest_common_prefix(spark):
    turns = [
        (1, "chosen", 0, "user", "hi"), (1, "chosen", 1, "assistant", "yes"), (1, "chosen", 2, "user", "ok"),
        (1, "rejected", 5, "user", "hi"), (1, "rejected", 6, "assistant", "no"),
        (2, "chosen", 0, "user", None), (2, "rejected", 0, "user", None),
        (3, "chosen", 0, None, "a"), (4, "other", 0, "user", "a"), (None, "chosen", 0, "user", "a"),
        (5, "chosen", 0, "user", "t"), (5, "chosen", 0, "user", "t"), (5, "rejected", 0, "user", "t"),
    ]
    done = {r.pair_id: r for r in preferences.format_pairs(spark.createDataFrame(turns, TURNS)).collect()}
    assert set(done) == {1, 2, 3, 5}
    first = done[1]
    assert (first.n_common, first.prompt) == (1, "<|user|>\nhi<|end|>\n")
    assert first.chosen == "<|assistant|>\nyes<|end|>\n<|user|>\nok<|end|>\n"
    assert [first.chosen[a : a + n] for a, n in first.chosen_mask] == ["yes<|end|>\n"]
    assert [first.rejected[a : a + n] for a, n in first.rejected_mask] == ["no<|end|>\n"]
    assert (done[2].n_common, done[2].chosen, done[2].rejected) == (1, "", "")
    assert (done[3].n_common, done[3].chosen, done[3].rejected) == (0, "<|unknown|>\na<|end|>\n", "")
    assert (done[5].n_common, done[5].chosen, done[5].rejected) == (1, "<|user|>\nt<|end|>\n", "")
    assert preferences.format_pairs(spark.createDataFrame([], TURNS)).count() == 0


def test_stale_replies_of_null_and_tied_turns(spark):
    turns = [
        (1, None, "assistant", "a"), (1, 1, "user", "q"), (1, 2, "assistant", "b"),
        (2, None, "user", "y"), (2, None, "assistant", "x"),
        (3, 1, "assistant", "b"), (3, 1, "assistant", "a"), (3, None, "user", "q"),
        (4, 1, "assistant", "a"), (4, 2, "assistant", "z"), (4, 2, "assistant", "z"), (4, 3, "user", "q"),
        (5, None, "user", "q"),
    ]
    pairs = preferences.stale_replies(spark.createDataFrame(turns, "conv_id long, turn int, role string, text string"))
    sides = {}
    for r in pairs.orderBy("pair_id", "side", "turn").collect():
        sides.setdefault((r.pair_id, r.side), []).append(r.text)
    assert sides == {
        (1, "chosen"): ["a", "q", "b"], (1, "rejected"): ["a", "q", "a"],
        (2, "chosen"): ["x"],
        (3, "chosen"): ["q", "a", "b"], (3, "rejected"): ["q", "a", "a"],
        (4, "chosen"): ["a", "z", "z"], (4, "rejected"): ["a", "z", "z"],
    }
    assert {r.pair_id for r in preferences.format_pairs(pairs).collect()} == {1, 2, 3, 4}


# Mixing


def test_mix_meets_targets(corpus, none):
    taken = mixing.taken_words(corpus).collect()
    assert len(taken) == corpus.count()
    sizes, source_of = {}, {}
    for r in corpus.select("doc_id", "source", "text").collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(brute.solid(r.text))
        source_of[r.doc_id] = r.source
    goal = brute.targets(sizes)
    words = dict.fromkeys(sizes, 0)
    for r in taken:
        source = source_of[r.doc_id]
        assert (r.source_size, r.target) == (sizes[source], pytest.approx(goal[source], abs=1e-6))
        assert 0 <= r.taken <= 2 * r["size"]
        words[source] += r.taken
    # At the end of the budget every source may lack a packet, and have what the others lack.
    assert all(abs(words[s] - goal[s]) <= sum(max(g / mixing.GRAIN, mixing.LEAST) + 1 for g in goal.values()) for s in sizes)
    assert table(mixing.taken_words(corpus)) == sorted((tuple(r) for r in taken), key=repr)
    assert mixing.taken_words(none).count() == 0


def queued(docs):
    """The mix by row, and what plain queues of the same rows give."""
    entries = mixing.mix(docs).collect()
    rows = {(r.row, r.source, r["size"], r.shuffled) for r in entries}
    found = dict.fromkeys((r[0] for r in rows), 0)
    for r in entries:
        found[r.row] += r.taken
    return entries, rows, found


def test_mix_is_in_order_of_virtual_finish(corpus):
    entries, rows, found = queued(corpus)
    goal, plain = brute.fair_queue([(row, source, size, (rank, row)) for row, source, size, rank in rows])
    assert found == plain
    entries.sort(key=lambda r: (r.position, r.virtual_finish))
    assert all(a.position + a.words == b.position for a, b in zip(entries, entries[1:]) if b.words)
    assert all(a.virtual_finish <= b.virtual_finish for a, b in zip(entries, entries[1:]) if a.words and b.words)
    taken = [r for r in entries if r.taken]
    assert [r.taken for r in taken[:-1]] == [r.words for r in taken[:-1]]
    assert sum(r.taken for r in taken) == -(-sum(goal.values()) // 1) > sum(r.words for r in entries) / 2


def test_the_order_alone_decides_the_mix(corpus, monkeypatch):
    """In another order the same budget goes to other sources: nothing is cut before the sort."""
    _, _, found = queued(corpus)
    plain = mixing.running_total

    def by_source(scratch, name, df, order, value, out):
        return plain(scratch, name, df, [c for c in order if c != "virtual_finish"] if name == "order" else order, value, out)

    monkeypatch.setattr(mixing, "running_total", by_source)
    _, _, other = queued(corpus)
    assert sum(other.values()) == sum(found.values()) and sorted(other.values()) != sorted(found.values())


def test_mixed_keeps_rows_and_columns(spark):
    """Equal ids, texts and whole rows in several sources, and columns named like those that are added."""
    rows = [(1, "a b c d", "s1"), (1, "a b c d", "s2"), (2, "e f", "s1"), (2, "e f", "s1"), (None, "g h i", None), (3, None, "s3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    clashing = {c: F.lit(c) for c in ("size", "source_size", "target", "taken", "position", "__id", "row", "key", "nth", "at", "rest")}
    done = mixing.mixed(docs.withColumns(clashing))
    assert done.columns == [*docs.columns, *clashing, *(f"mix_{c}" for c in ("size", "source_size", "target", "taken", "position"))]
    out = done.collect()
    assert all(r[c] == c for r in out for c in clashing)
    assert all(0 < r.mix_taken <= 2 * r.mix_size == 2 * len(r.text.split()) for r in out)
    whole = {"s1": 8, "s2": 4, None: 3}
    assert {r.source: r.mix_source_size for r in out} == whole
    by_source = dict.fromkeys(whole, 0)
    for r in out:
        by_source[r.source] += r.mix_taken
    assert sum(by_source.values()) == 23 and len(out) == 5  # half as much again as 15 words, rounded up
    assert mixing.mixed(docs.where("false")).count() == 0
    plain = mixing.mixed(docs).columns
    assert plain == [*docs.columns, "size", "source_size", "target", "taken", "position"]


# Deduplication


def test_bytes_like_brute_force(corpus, rows, none):
    done = suffixes.remove_repeats(corpus).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert table(done) == sorted(brute.byte_dedup(rows), key=repr)
    assert suffixes.remove_repeats(none).count() == 0


def test_suffixes_of_a_hot_seed_meet_in_no_bucket(spark, corpus, rows, monkeypatch):
    """A passage between distinct words in many documents: their windows are counted by Spark."""
    random.seed(7)
    passage = "".join(random.choice("abcdefgh ") for _ in range(230))

    def other(n):
        return "".join(random.choice("ijklmnop ") for _ in range(n))

    texts = [other(random.randint(0, 200)) + passage[: random.choice((150, 199, 230))] + other(random.randint(0, 200)) for _ in range(120)]
    more = [*enumerate(texts, 200_000), (200_500, texts[0]), (200_501, texts[0][:-30]), (200_502, texts[3][5:])]
    docs = corpus.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string")).repartition(5)
    expected = sorted(brute.byte_dedup([*rows, *more]), key=repr)
    plain = suffixes._merged

    def merged(key, table):  # in the tasks: no bucket is to hold many suffixes of one seed
        groups = {}
        for entries in table.column("entries"):
            for suffix, *_ in suffixes.decode(entries.as_py()):
                groups[suffix[: suffixes.SEED]] = groups.get(suffix[: suffixes.SEED], 0) + 1
        assert max(groups.values()) <= bound, max(groups.values())
        return plain(key, table)

    for bound, at_once in ((1, 3), (4, 4_096), (40, 10)):
        monkeypatch.setattr(suffixes, "HOT_SEED", bound)
        monkeypatch.setattr(suffixes, "HOT_ENTRIES", at_once)
        monkeypatch.setattr(suffixes, "_merged", merged)
        done = suffixes.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
        assert table(done) == expected


def test_known_prefixes_tell_which_windows_repeat(monkeypatch):
    """Entries in order, known by the prefix each shares with the one before, against all windows themselves."""
    random.seed(9)
    for at_once in (1 << 18, 200):
        monkeypatch.setattr(suffixes, "NAMES_AT_ONCE", at_once)
        for _ in range(12):
            made = {tuple((random.choice((b"aab", b"ab", b"b")) * 200)[random.randint(0, 2) :][: n - random.choice((0, 0, 0, 9, 50))] for n in (200, 136)) for _ in range(40)}
            cut = [(s[: random.randint(64, 200)] + b"xyz" * 50, b) for s, b in made]  # the same start, then others
            entries = sorted({(s[:200], b) for s, b in [*made, *cut]})
            times = [random.choice((1, 1, 1, 2)) for _ in entries]
            shared = [0, *(suffixes.common(a[0], b[0], 0) for a, b in zip(entries, entries[1:]))]
            windows = [{d: b[:d][::-1] + s[: 200 - d] for d in range(137) if len(b) >= d and len(s) >= 200 - d} for s, b in entries]
            seen = {}
            for mine, n in zip(windows, times):
                for d, w in mine.items():
                    seen[d, w] = seen.get((d, w), 0) + n
            repeated = [[d for d, w in mine.items() if seen[d, w] > 1] for mine in windows]
            to_left, to_right = suffixes.reaches(np.array(shared), np.array([len(s) for s, _ in entries]), [b for _, b in entries], np.array(times))
            assert to_left.tolist() == [max(ds, default=-1) for ds in repeated]
            assert to_right.tolist() == [max((200 - d for d in ds), default=-1) for ds in repeated]
            assert max(to_left) > 0


def test_runs_survive_their_encoding():
    entries = [(b"abc", b"", 0, 1), (b"abd", b"xy", 3, 2), (b"abdz" * 40, b"xz", 1, 1)]
    assert [e[:4] for e in suffixes.decode(suffixes.encode(entries))] == entries


def test_loser_tree_merges_in_order_with_shared_prefixes():
    random.seed(5)
    runs = [sorted({bytes(random.choice(b"ab") for _ in range(random.randint(0, 70))) for _ in range(n)}) for n in (40, 0, 1, 25, 33)]
    coded = [suffixes.decode(suffixes.encode([(s, b"", k, 1) for k, s in enumerate(run)])) for run in runs]
    merged = [(shared, entry[0]) for shared, _, entry in suffixes.merge(coded)]
    assert [s for _, s in merged] == sorted(s for run in runs for s in run)
    for (_, a), (shared, b) in zip(merged, merged[1:]):
        assert shared == suffixes.common(a, b, 0)


def test_words_like_brute_force(corpus, rows, none):
    done = recompress.remove_repeats(corpus)
    assert table(done) == sorted(brute.word_dedup(rows), key=repr)
    assert recompress.remove_repeats(none).count() == 0


def test_edited_documents_keep_their_columns(corpus):
    done = recompress.deduplicated(corpus)
    assert done.columns == corpus.columns
    before = {(r.doc_id, r.text) for r in corpus.collect()}
    lost = {k: (n, text) for k, _, n, text in brute.word_dedup([(k, t) for k, t in before])}
    for r in done.collect():
        n, text = lost[r.doc_id]
        assert r.text == text if n else (r.doc_id, r.text) in before


def test_near_duplicates_like_brute_force(corpus, rows, none):
    found = minhash.near_duplicates(corpus).collect()
    of = brute.near_components(rows)
    assert sorted(((r.doc_id, r.component_id) for r in found), key=repr) == sorted(
        ((k, None if k is None else of[k]) for k, _ in rows), key=repr
    )
    assert sorted(r.n_shingles for r in found) == sorted(len(brute.shingle_set(t)) for _, t in rows)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in found)
    assert minhash.near_duplicates(none).count() == 0


def test_a_family_of_edited_copies(spark):
    """Links that no star finds: copies of one text, edited so much that only some pairs are alike."""
    random.seed(11)
    base = [f"word{k}" for k in range(120)]
    rows = []
    for k in range(300):
        words = list(base)
        for _ in range(random.randint(0, 9)):
            words[random.randrange(len(words))] = f"x{random.randrange(40)}"
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert found == brute.near_components(rows)
    assert 1 < len(set(found.values())) < 300


# Quality, licences, decontamination, token counts


def test_quality_like_brute_force(corpus, rows, none):
    book = quality.ledger(corpus)
    judged = quality.judge(book).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    )
    assert table(judged) == sorted(((k, *brute.quality(t)) for k, t in rows), key=repr)
    assert all(r.kept == (not r.base_failed and r.failed == 0) for r in quality.judge(book).collect())
    assert quality.ledger(none).count() == 0


def test_policies_and_ablations_are_bit_arithmetic(spark):
    book = spark.createDataFrame([(1, 0), (2, 1), (3, 4), (4, 12), (5, 8)], "doc_id long, failed long")
    kept = {v: [r.doc_id for r in quality.judge(book, v).where("kept").orderBy("doc_id").collect()] for v in (1, 2)}
    assert kept == {1: [1, 3, 4, 5], 2: [1]}
    out = {r.rule: (r.n_failed, r.n_only) for r in quality.ablation(book, 2).collect()}
    assert out["symbols"] == (2, 1) and out["repeated_lines"] == (2, 1) and out["few_words"] == (1, 1) and out["long_words"] == (0, 0)


def test_strict_policy_drops_what_the_loose_one_keeps(spark):
    few = " ".join(f"word{k}" for k in range(40))
    texts = {
        "clean": few,
        "some_symbols": few.replace("word3", "| word3"),
        "some_repeated_lines": "same few words\nthen three others\nsame few words\nand some more\nsame few words",
        "short_mean_word": " ".join(chr(97 + k % 26) + chr(97 + k // 26) for k in range(60)),
        "long_mean_word": " ".join(f"unbrokenword{k}" for k in range(40)),
    }
    book = quality.ledger(spark.createDataFrame(list(texts.items()), "doc_id string, text string"))
    kept = {v: {r.doc_id for r in quality.judge(book, v).where("kept").collect()} for v in (2, 3)}
    assert kept == {2: set(texts), 3: {"clean"}}
    out = {r.rule: (r.n_failed, r.n_only) for r in quality.ablation(book, 3).collect()}
    assert all(out[name] == (1, 1) for name in texts if name != "clean")


def test_licenses_like_brute_force(corpus, rows, none):
    found = {(r.doc_id, r.license, round(r.dice, 9)) for r in licenses.scan(corpus).collect()}
    expected = {(k, *brute.license_of(t, licenses.TEMPLATES, licenses.THRESHOLD)) for k, t in rows}
    assert found == {(k, name, round(dice, 9)) for k, name, dice in expected}
    assert licenses.scan(none).count() == 0


def test_a_long_template_is_found_across_lines(spark):
    words = licenses.TEMPLATES["MIT-text"].split()
    text = "intro line here\n\n" + "\n".join(" ".join(words[k : k + 9]) for k in range(0, len(words), 9)) + "\n \nend of it"
    (row,) = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert (row.license, row.dice, row.n_units) == ("MIT-text", 1.0, 2)


def scanned(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.license, round(r.dice, 3), r.n_units) for r in licenses.scan(docs).orderBy("doc_id").collect()]


def test_notices_that_are_no_unit_are_found(spark):
    header = licenses.TEMPLATES["GPL-3.0-header"].split()
    wrapped = "\n".join("# " + " ".join(header[k : k + 8]) for k in range(0, len(header), 8))
    code = "\n".join(f"x{k} = call{k}(y{k}, z{k})" for k in range(60))
    assert scanned(spark, [
        "The tool is small. Released under the MIT License. Have fun with it.",
        f"{wrapped}\n{code}",
        f"{code}\n{wrapped}\n{code} Licensed under CC BY 4.0. {code}",
        "The tool is small. It is not under any license. Have fun with it.",
    ]) == [("MIT", 1, 1), ("GPL-3.0-header", 1, 1), ("CC-BY-4.0", 1, 2), (None, 0, 0)]


def test_whole_licences_are_found(spark):
    names = sorted(n for n in licenses.TEMPLATES if n.endswith("-text"))
    assert {n.split("-")[0] for n in names} >= {"MIT", "BSD", "ISC", "LGPL", "AGPL", "Apache", "GPL", "MPL"}
    around = " ".join(f"other{k}" for k in range(6_000))
    one_line = [" ".join(licenses.TEMPLATES[n].split()) for n in names]
    found = scanned(spark, [*one_line, *(f"{around} {t} {around}" for t in one_line)])
    assert [(name, dice) for name, dice, _ in found] == [(n, 1) for n in names] * 2


def test_windows_like_all_of_their_size(monkeypatch):
    random.seed(13)
    template = " ".join(random.choice("abcdefg") for _ in range(14))
    matcher = licenses.Matcher({"t": template}, 0.6)
    for _ in range(200):
        words = [random.choice("abcdefghij") for _ in range(random.randint(15, 60))]
        at = random.randrange(len(words))
        words[at:at] = template.split()[: random.randint(8, 14)]
        best = max(brute.license_of(" ".join(words[k : k + 14]), {"t": template}, 0.6)[1] for k in range(len(words) - 13))
        whole = brute.license_of(" ".join(words), {"t": template}, 0.6)[1]
        found = matcher.best(pa.array([" ".join(words)]))[0][1]
        assert found == (whole if whole else best)


ITEMS = [
    (1, "w1 w4 w9 w16 w25 w36 w49 w64 w81 w100 w121"), (2, "Only three WORDS"), (2, "only three words"), (3, None), (4, "..."),
    (None, "no no no no"), (5, "two roads met in a wood and the one less worn was"), (6, "three"), (7, "never seen words of an item that is long"),
]


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_SHINGLES, 0])
def test_leaks_like_brute_force(spark, corpus, rows, none, limit, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_SHINGLES", limit)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.decontaminate(corpus, items)
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert table(found.select(*columns)) == sorted(brute.leaks(rows, ITEMS), key=repr)
    if limit:
        assert decontaminate.decontaminate(none, items).count() == 0
        assert decontaminate.decontaminate(corpus, items.where("false")).where("contaminated").count() == 0


def test_token_counts_like_encoding_all(corpus, rows, none):
    encode = tokencounts._encoder(open(tokencounts.TOKENIZER, "rb").read()).encode_ordinary
    sizes = sorted(len(encode(t or "")) for _, t in rows)
    counts = tokencounts.histogram(corpus).cache()
    for r in counts.collect():
        up_to = [n for n in sizes if n <= r.n_tokens]
        assert (r.n_docs, r.docs_up_to, r.tokens_up_to) == (sizes.count(r.n_tokens), len(up_to), sum(up_to))
        assert (r.docs_beyond, r.truncated_total) == (len(sizes) - len(up_to), sum(min(n, r.n_tokens) for n in sizes))
    cut = {r["limit"]: (r.tokens, r.docs_cut) for r in tokencounts.truncated_totals(counts, [0, 100, 10**9]).collect()}
    assert cut == {k: (sum(min(n, k) for n in sizes), sum(n > k for n in sizes)) for k in (0, 100, 10**9)}
    assert tokencounts.quantile(counts, 0.5) == sizes[-(-len(sizes) // 2) - 1]
    assert tokencounts.histogram(none).count() == 0 and tokencounts.quantile(tokencounts.histogram(none), 0.5) is None


# Recompression


def test_symbols_of_all_rounds_stand_for_what_they_say(spark):
    """The table of names: runs, pairs and pairs of pairs; equal words get equal symbols in every document."""
    random.seed(3)
    words = [f"w{k}" for k in range(60)]
    base = [random.choice(words) for _ in range(80)]
    texts = [base, ["x", *base], [*base[:40], "y", "y", "y", *base[40:]], base[11:70], ["a"] * 20, [], ["one"]]
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    rows = recompress.symbols(docs).collect()
    by_level = [{r.symbol: r for r in rows if r.level == level} for level in range(recompress.ROUNDS + 1)]
    assert [len(level) for level in by_level] == [sum(r.level == k for r in rows) for k in range(len(by_level))]  # one name, one meaning
    assert sum(r.n * r.n_words for r in rows if r.level == 2) == sum(map(len, texts))
    assert {r.n_words for r in by_level[0].values() if r.n_words > 1} >= {3, 20}
    for below, level in zip(by_level, by_level[1:]):
        for r in level.values():
            if r.symbol in below:
                assert (r.left, r.right, r.n_words) == (below[r.symbol].left, below[r.symbol].right, below[r.symbol].n_words)
            else:
                assert r.n_words == below[r.left].n_words + below[r.right].n_words
    assert max(r.n_docs for r in by_level[2].values() if r.n_words > 2) >= 4


def test_every_window_without_runs_holds_a_symbol_that_it_alone_decides():
    random.seed(5)
    vocabulary = [f"w{k}" for k in range(300)]
    base = [random.choice(vocabulary) for _ in range(400)]
    base = [w for w, before in zip(base, [None, *base]) if w != before]
    parse = recompress.Parse(pa.array([" ".join(base)]))
    assert (parse.border >= 0).all() and len(parse.border) == len(base) - 12
    assert max(parse.levels[-1].end - parse.levels[-1].begin) == 4
    for at in range(0, len(base) - 12, 7):  # in any surroundings the same symbol, at the same place
        window = base[at : at + 13]
        for before, after in ([], []), (["p", "q"], ["r"]), (window[:1], window[-1:]), (window[-1:], window[:1]):
            other = recompress.Parse(pa.array([" ".join([*before, *window, *after])]))
            assert other.name[len(before)] == parse.name[at]
            assert other.border[len(before)] - len(before) == parse.border[at] - at


def test_long_turns_and_other_columns_of_conversations(spark):
    long = "a long turn " * 50_000
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", long), (1, 2, "user", long + "?"), (1, 3, "assistant", "b"), (None, 0, "user", "x")]
    clashing = {c: F.lit(c) for c in ("pair_id", "side", "last", "before", "place", "chosen", "n_common", "of", "is_reply")}
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumns(clashing)
    (row,) = preferences.format_pairs(preferences.stale_replies(turns)).collect()
    assert (row.pair_id, row.n_common, row.chosen) == (1, 3, "<|assistant|>\nb<|end|>\n")
    assert row.rejected == f"<|assistant|>\n{long}<|end|>\n" and len(row.prompt) > 2 * len(long)
    assert [row.rejected[a : a + n] for a, n in row.rejected_mask] == [long + "<|end|>\n"]
    assert preferences.format_pairs(preferences.stale_replies(turns.where("false"))).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    random.seed(21)
    chain = [(k, k + 1) for k in range(0, 60)]
    star = [(100, k) for k in range(101, 160)]
    loop = [(200 + k, 200 + (k + 1) % 30) for k in range(30)]
    links = [(b, a) if random.random() < 0.5 else (a, b) for a, b in [*chain, *star, *loop, (300, 300), (5, 105)] * 2]
    random.shuffle(links)
    scratch = Scratch(spark, "test-components")
    stored = scratch.freeze(spark.createDataFrame(links, "a long, b long").repartition(3), "links")
    found = {r.node: r.component for r in components(scratch, "found", stored).collect()}
    assert found == {n: 0 if n < 200 else 200 if n < 300 else 300 for n in {n for link in links for n in link}}
    assert components(scratch, "none", stored.where("false")).count() == 0
